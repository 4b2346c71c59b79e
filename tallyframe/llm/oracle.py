"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others are tested in ``tests/llm`` against brute force, round trips or
held-out labels.
"""

from __future__ import annotations

OP4 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

OP6 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS s FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS f FROM d)
SELECT page_id, n AS payload_bytes, s AS payload_digest,
       CASE WHEN n >= 100 AND page_id > f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id > f THEN f END AS refers_to
FROM f
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_content_sort": OP4, "op6_warc": OP6}
