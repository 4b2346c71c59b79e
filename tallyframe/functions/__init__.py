"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from tallyframe.functions.numeric import complement_pct, is_rejected, pct, tolerant_cast
from tallyframe.functions.rowwise import row_argmax, row_max, row_top_k
from tallyframe.functions.text import clean_header, fold_accents, fold_table, fold_text

__all__ = [
    "pct", "complement_pct", "tolerant_cast", "is_rejected",
    "row_max", "row_argmax", "row_top_k",
    "clean_header", "fold_accents", "fold_table", "fold_text",
]
