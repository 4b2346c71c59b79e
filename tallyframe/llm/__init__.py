"""Training-data operators: tokenising, packing, extraction, deduplication, filtering, archives and sharding.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` holds the thin
``opN_<name>`` queries and ``oracle`` their DuckDB SQL where SQL can say it.
"""
