"""Declared schemas of the input tables.

Reading with a declared schema skips schema discovery (footer reads and, for
text, an inference pass over the data), and a schema restricted to the
needed columns is also the pruned read schema.
"""

from __future__ import annotations

from pyspark.sql.types import StructType, _parse_datatype_string

# Column names and types of the provided test tables.
TABLE_DDL = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def table_schema(name: str, columns: list[str] | None = None) -> StructType | None:
    """The declared schema of ``name`` (only ``columns``, in that order), or None if unknown."""
    ddl = TABLE_DDL.get(name)
    if ddl is None:
        return None
    full: StructType = _parse_datatype_string(ddl)
    if not columns:
        return full
    by_name = {f.name: f for f in full.fields}
    if any(c not in by_name for c in columns):
        return None
    return StructType([by_name[c] for c in columns])
