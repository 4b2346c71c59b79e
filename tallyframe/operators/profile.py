"""Types of text columns, found in one pass over the data.

Every value of a text column fits some types; what a column needs is the
narrowest type that all its values fit.  Counting the values per kind is a
mergeable summary: tasks add up their counts, and one row per column and task is
shuffled.  The result yields the declared schema for later scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.types import _parse_datatype_string as parse_type

# The kinds of text, narrowest first, as whole-value patterns (white space around a value doesn't count).
PATTERNS = {
    "bigint": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$",
    "boolean": r"^(?i)(true|false)$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$",
}
#: Relative error of the distinct counts.
DISTINCT_ERROR = 0.02


def _kind(text: Column) -> Column:
    """The narrowest kind of a trimmed text that is not empty."""
    out = F.when(text.rlike(PATTERNS["bigint"]), "bigint").when(text.rlike(PATTERNS["double"]), "double")
    out = out.when(text.rlike(PATTERNS["boolean"]), "boolean")
    for name in ("date", "timestamp"):
        out = out.when(text.rlike(PATTERNS[name]) & text.try_cast(name).isNotNull(), name)
    return out.otherwise("string")


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: position, column, n_rows, n_null, n_blank, a count per kind, min_chars, max_chars, approx_distinct, type.

    ``type`` joins the kinds of all values that are neither null nor blank:
    whole numbers and decimals make ``double``, dates and timestamps make
    ``timestamp``, any other mixture and a column without values ``string``.  A number
    with leading zeros counts as a whole number, one of over 18 digits as ``double``.  The
    distinct count is a sketch (relative error ``DISTINCT_ERROR``).  Columns of other types are read as their text.
    """
    columns = list(columns or df.columns)
    if not columns:
        raise ValueError("no columns to profile")
    entries = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
               for i, c in enumerate(columns)]
    values = df.select(F.explode(F.array(*entries)).alias("v")).select("v.*").withColumn("text", F.trim("value"))
    values = values.withColumn("kind", F.when(F.col("text") != "", _kind(F.col("text"))))
    kinds = [*PATTERNS, "string"]
    counted = values.groupBy("position", "column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("value").isNull()).alias("n_null"),
        F.count_if(F.col("text") == "").alias("n_blank"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in kinds],
        F.min(F.char_length("value")).alias("min_chars"), F.max(F.char_length("value")).alias("max_chars"),
        F.approx_count_distinct("value", DISTINCT_ERROR).alias("approx_distinct"))
    filled = F.col("n_rows") - F.col("n_null") - F.col("n_blank")

    def all_are(*names: str) -> Column:
        return sum((F.col(f"n_{k}") for k in names), F.lit(0)) == filled

    return counted.withColumn("type", F.when(filled == 0, "string").when(all_are("bigint"), "bigint").when(all_are("bigint", "double"), "double")
                              .when(all_are("boolean"), "boolean").when(all_are("date"), "date")
                              .when(all_are("date", "timestamp"), "timestamp").otherwise("string"))


def declared_schema(profile: DataFrame) -> StructType:
    """The schema that a profile (one row per column) declares, in column order."""
    return StructType([StructField(r["column"], parse_type(r["type"])) for r in profile.select("position", "column", "type").orderBy("position").collect()])
