"""Independent SQL answers (DuckDB dialect) for the registered queries.

Written from the question, not from the Spark plans: the base table is a
plain join + GROUP BY, winners are CASE chains, per-group firsts use QUALIFY.
Column names and types are aligned with the Spark results (sums of BIGINT
cast back to BIGINT, money as DECIMAL, ratios as DOUBLE).
"""

from __future__ import annotations

from tallyframe.plans.testbed import (BAND_CUT, COHORT_SIZE, PARTIES, PRIORITIES, SMALL_BELOW, TOP_N,
                                      TOP_PARTIES)

P = list(PARTIES)
PLIST = ", ".join(P)
HUNDRED = "CAST(100 AS DOUBLE)"


def pct(num: str, den: str) -> str:
    return f"(({num}) / NULLIF({den}, 0) * {HUNDRED})"


MAXP = f"greatest({PLIST})"
ARGMAX = ("CASE WHEN " + MAXP + " > 0 THEN CASE "
          + " ".join(f"WHEN {p} = {MAXP} THEN '{p}'" for p in P) + " END END")

_PARTY_COUNTS = ",\n    ".join(
    f"count(*) FILTER (WHERE o.o_orderstatus = 'F' AND o.o_orderpriority = '{prio}') AS {p}"
    for prio, p in zip(PRIORITIES, P))

BASE = f"""results_wide AS (
  SELECT c.c_custkey AS unit_id, c.c_name AS unit, n.n_name AS province, r.r_name AS community,
    CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS population,
    count(*) AS census,
    count(*) FILTER (WHERE o.o_orderstatus IN ('F', 'O')) AS voters,
    count(*) FILTER (WHERE o.o_orderstatus = 'F') AS valid,
    {_PARTY_COUNTS}
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY c.c_custkey, c.c_name, n.n_name, r.r_name)"""

PLACE = "unit_id, unit, community, province"

CONC = f"""conc AS (
  SELECT {PLACE}, {ARGMAX} AS party, {MAXP} AS winner_votes, valid, {pct(MAXP, 'valid')} AS max_share
  FROM results_wide WHERE valid > 0)"""

UNITS = """units AS (
  SELECT community, unit_id, unit, max(population) AS population
  FROM results_wide GROUP BY community, unit_id, unit)"""

TOT = """tot AS (SELECT community, sum(population) AS group_population FROM units GROUP BY community)"""

GROUP_SUMS = "g AS (SELECT community, " + ", ".join(f"CAST(sum({p}) AS BIGINT) AS {p}" for p in P) + \
    " FROM results_wide GROUP BY community)"

REP = f"""rep AS (
  SELECT b.community, b.unit_id, b.unit, b.unit_party, b.unit_votes, gw.group_party, gw.group_votes,
         (b.unit_party = gw.group_party) AS coincides,
         {pct('CAST(b.population AS DOUBLE)', 'CAST(t.group_population AS DOUBLE)')} AS population_share
  FROM (SELECT community, unit_id, unit, population, {ARGMAX} AS unit_party, {MAXP} AS unit_votes
        FROM results_wide
        QUALIFY row_number() OVER (PARTITION BY community ORDER BY population DESC NULLS LAST, unit_id) = 1) b
  JOIN (SELECT community, {ARGMAX} AS group_party, {MAXP} AS group_votes FROM g) gw USING (community)
  JOIN tot t USING (community))"""

COHORTS = f"""coh AS (
  SELECT *, {pct('voters', 'census')} AS turnout FROM (
    SELECT * FROM (SELECT 'large' AS cohort, * FROM results_wide
                   ORDER BY population DESC NULLS LAST, unit_id LIMIT {COHORT_SIZE})
    UNION ALL
    SELECT * FROM (SELECT 'small' AS cohort, * FROM results_wide WHERE population < {SMALL_BELOW}
                   ORDER BY population DESC NULLS LAST, unit_id LIMIT {COHORT_SIZE})))"""

COHORT_COLS = f"unit_id, unit, province, community, population, turnout, {PLIST}"


def _cut() -> str:
    return str(BAND_CUT) if BAND_CUT is not None else "(SELECT median(population_share) FROM rep)"


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _turnout_units() -> str:
    return f"""tu AS (
  SELECT {PLACE}, turnout, {HUNDRED} - turnout AS abstention
  FROM (SELECT {PLACE}, {pct('voters', 'census')} AS turnout FROM results_wide WHERE census > 0))"""


def _by_province() -> str:
    return f"""bp AS (
  SELECT province, total_voters, total_census, {pct('total_voters', 'total_census')} AS turnout_index
  FROM (SELECT province, CAST(sum(voters) AS BIGINT) AS total_voters, CAST(sum(census) AS BIGINT) AS total_census
        FROM results_wide GROUP BY province))"""


def _hits_or_top(source: str) -> str:
    return f"""SELECT {PLACE}, party, max_share FROM {source} WHERE winner_votes = valid
UNION ALL
SELECT * FROM (SELECT {PLACE}, party, max_share FROM {source}
               ORDER BY max_share DESC NULLS LAST, unit_id LIMIT {TOP_N})
WHERE NOT EXISTS (SELECT 1 FROM {source} WHERE winner_votes = valid)"""


def _reject_rows(col: str, dtype: str) -> str:
    raw = f"trim({col})"
    typed = f"TRY_CAST(trim({col}) AS {dtype})"
    return (f"SELECT '{col}' AS column_name, count(*) AS n_rows, "
            f"count(*) FILTER (WHERE {raw} IS NULL OR {raw} = '') AS n_blank, "
            f"count(*) FILTER (WHERE {typed} IS NOT NULL) AS n_ok, "
            f"count(*) FILTER (WHERE {raw} IS NOT NULL AND {raw} <> '' AND {typed} IS NULL) AS n_rejected FROM d")


def _profile_sql() -> str:
    """Each text column of the orders with the kind of its values, and its type from them."""
    texts = {
        "order_key": "CAST(o_orderkey AS VARCHAR)", "customer": "' ' || CAST(o_custkey AS VARCHAR)", "status": "o_orderstatus",
        "price": "price", "number_or_none": "CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 1 THEN price END",
        "ordered": "day", "seen": "CASE o_orderkey % 3 WHEN 0 THEN day ELSE day || ' 10:30:00' END",
        "day_or_blank": "CASE o_orderkey % 3 WHEN 0 THEN '' ELSE day END",
        "mixed": "CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderpriority END",
        "final": "CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END", "blank": "''"}
    values = " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS \"column\", {e} AS value FROM o" for i, (c, e) in enumerate(texts.items()))
    return f"""WITH o AS (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders),
k AS (SELECT *, CASE WHEN trim(value) = '' THEN NULL WHEN TRY_CAST(value AS BIGINT) IS NOT NULL AND value NOT LIKE '%.%' THEN 'bigint'
  WHEN TRY_CAST(value AS DOUBLE) IS NOT NULL THEN 'double' WHEN value IN ('true', 'false') THEN 'boolean'
  WHEN length(value) = 10 AND TRY_CAST(value AS DATE) IS NOT NULL THEN 'date'
  WHEN TRY_CAST(value AS TIMESTAMP) IS NOT NULL THEN 'timestamp' WHEN value IS NOT NULL THEN 'string' END AS kind FROM ({values}))
SELECT position, "column", n_rows, n_null, n_blank, n_bigint, n_double, n_boolean, n_date, n_timestamp, n_string, min_chars, max_chars,
  CASE WHEN filled = 0 THEN 'string' WHEN n_bigint = filled THEN 'bigint' WHEN n_bigint + n_double = filled THEN 'double'
       WHEN n_boolean = filled THEN 'boolean' WHEN n_date = filled THEN 'date' WHEN n_date + n_timestamp = filled THEN 'timestamp'
       ELSE 'string' END AS type
FROM (SELECT position, "column", count(*) AS n_rows, count(*) FILTER (WHERE value IS NULL) AS n_null,
  count(*) FILTER (WHERE trim(value) = '') AS n_blank, {', '.join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}"
  for k in ('bigint', 'double', 'boolean', 'date', 'timestamp', 'string'))}, CAST(min(length(value)) AS INTEGER) AS min_chars,
  CAST(max(length(value)) AS INTEGER) AS max_chars, count(kind) AS filled
  FROM k GROUP BY position, "column")"""


SQL: dict[str, str] = {
    "raw_delimited_scan": with_ctes(BASE, body=f"""SELECT unit_id, unit, province, community,
  CAST(floor(population) AS BIGINT) AS population, census, voters, valid, {PLIST} FROM results_wide"""),
    "dim_fact_join": with_ctes(BASE, body="SELECT * FROM results_wide"),
    "view_scan": with_ctes(BASE, body="SELECT * FROM results_wide"),
    "join_coverage": """WITH
d AS (SELECT c_custkey AS k, count(*) AS n FROM customer GROUP BY c_custkey),
f AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY user_id)
SELECT 'dimension_only' AS side, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_keys
FROM d WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.k = d.k)
UNION ALL
SELECT 'fact_only' AS side, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows, count(*) AS n_keys
FROM f WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.k = f.k)""",
    "population_top10": with_ctes(BASE, body=f"""SELECT {PLACE}, population FROM results_wide
ORDER BY population DESC NULLS LAST, unit_id LIMIT {TOP_N}"""),
    "population_bottom10": with_ctes(BASE, body=f"""SELECT {PLACE}, population FROM results_wide
ORDER BY population ASC NULLS LAST, unit_id LIMIT {TOP_N}"""),
    "turnout_top10": with_ctes(BASE, _turnout_units(), body=f"""SELECT * FROM tu
ORDER BY turnout DESC NULLS LAST, unit_id LIMIT {TOP_N}"""),
    "turnout_top10_ties": with_ctes(BASE, _turnout_units(), body=f"""SELECT * FROM (
  SELECT *, rank() OVER (ORDER BY turnout DESC) AS rank FROM tu WHERE turnout IS NOT NULL) WHERE rank <= {TOP_N}"""),
    "abstention_top10": with_ctes(BASE, _turnout_units(), body=f"""SELECT * FROM tu
ORDER BY abstention DESC NULLS LAST, unit_id LIMIT {TOP_N}"""),
    "turnout_by_province": with_ctes(BASE, _by_province(), body="SELECT * FROM bp ORDER BY turnout_index DESC, province"),
    "turnout_rollup": with_ctes(BASE, body=f"""SELECT community, province, total_voters, total_census, level,
  {pct('total_voters', 'total_census')} AS turnout_index
FROM (SELECT community, province, CAST(sum(voters) AS BIGINT) AS total_voters,
             CAST(sum(census) AS BIGINT) AS total_census,
             CAST(grouping(community) AS INTEGER) + CAST(grouping(province) AS INTEGER) AS level
      FROM results_wide GROUP BY ROLLUP (community, province))"""),
    "cohort_by_list": with_ctes(BASE, _by_province(), body="""SELECT * FROM (
  SELECT *, CASE WHEN strip_accents(province) IN ('NATION_3', 'NATION_7', 'NATION_11', 'NATION_19', 'NATION_23')
                 THEN 'sparse'
                 WHEN strip_accents(province) IN ('NATION_0', 'NATION_5', 'NATION_8', 'NATION_14')
                 THEN 'dense' END AS cohort
  FROM bp) WHERE cohort IS NOT NULL"""),
    "cohort_by_table": with_ctes(BASE, _by_province(), """members AS (
  SELECT n_name AS place, min(cohort) AS cohort FROM (
    SELECT n_name, CASE n_nationkey % 4 WHEN 0 THEN 'coast' WHEN 1 THEN 'inland' END AS cohort FROM nation
    UNION ALL SELECT n_name, 'island' FROM nation WHERE n_nationkey % 8 = 0)
  WHERE cohort IS NOT NULL GROUP BY n_name)""", body="SELECT bp.*, cohort FROM bp JOIN members ON province = place"),
    "profile_columns": _profile_sql(),
    "bucketed_join": f"""SELECT c_custkey AS unit_id, c_name AS unit, census, voters, {pct('voters', 'census')} AS turnout
FROM customer JOIN (SELECT o_custkey, count(*) AS census, count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS voters
                    FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "party_share_wide": with_ctes(BASE, body="SELECT unit_id, unit, valid, "
                                  + ", ".join(f"{pct(p, 'valid')} AS {p}_pct" for p in P)
                                  + " FROM results_wide WHERE valid > 0"),
    "unpivot_parties": with_ctes(BASE, body=f"""SELECT unit_id, unit, province, community, party, votes
FROM (UNPIVOT (SELECT unit_id, unit, province, community, {PLIST} FROM results_wide)
      ON {PLIST} INTO NAME party VALUE votes)
WHERE votes IS NOT NULL"""),
    "concentration_top10": with_ctes(BASE, CONC, body=f"""SELECT {PLACE}, party, max_share FROM conc
ORDER BY max_share DESC NULLS LAST, unit_id LIMIT {TOP_N}"""),
    "unanimous_units": with_ctes(BASE, CONC, body=f"SELECT {PLACE}, party, max_share FROM conc WHERE winner_votes = valid"),
    "unanimous_or_top10": with_ctes(BASE, CONC, body=_hits_or_top("conc")),
    "unanimous_or_top10_contested": with_ctes(
        BASE, CONC, "conc2 AS (SELECT * FROM conc WHERE winner_votes < valid)", body=_hits_or_top("conc2")),
    "largest_unit_per_group": with_ctes(BASE, body="""SELECT community, unit_id, unit, province, population
FROM results_wide
QUALIFY row_number() OVER (PARTITION BY community ORDER BY population DESC NULLS LAST, unit_id) = 1"""),
    "winner_per_unit": with_ctes(BASE, body=f"""SELECT unit_id, unit, province, community,
  {ARGMAX} AS party, {MAXP} AS votes FROM results_wide"""),
    "winner_per_group": with_ctes(BASE, GROUP_SUMS, body=f"SELECT community, {ARGMAX} AS party, {MAXP} AS votes FROM g"),
    "max_row_per_group": with_ctes(BASE, body=f"""SELECT community, unit_id, unit, party, votes
FROM (SELECT community, unit_id, unit, {ARGMAX} AS party, {MAXP} AS votes FROM results_wide)
QUALIFY row_number() OVER (PARTITION BY community ORDER BY votes DESC NULLS LAST, unit_id) = 1"""),
    "population_by_group": with_ctes(BASE, UNITS, body="""SELECT community,
  CAST(sum(population) AS DECIMAL(38,2)) AS group_population, count(*) AS n_units
FROM units GROUP BY community"""),
    "share_of_group": with_ctes(BASE, UNITS, TOT, body=f"""SELECT u.community, u.unit_id, u.unit, u.population,
  CAST(t.group_population AS DECIMAL(38,2)) AS group_population,
  {pct('CAST(u.population AS DOUBLE)', 'CAST(t.group_population AS DOUBLE)')} AS population_share
FROM units u JOIN tot t USING (community)"""),
    "representativeness": with_ctes(BASE, UNITS, TOT, GROUP_SUMS, REP, body="SELECT * FROM rep"),
    "representativeness_by_band": with_ctes(BASE, UNITS, TOT, GROUP_SUMS, REP, body=f"""SELECT
  CASE WHEN population_share >= {_cut()} THEN 'high' ELSE 'low' END AS share_band,
  count(*) AS n_groups,
  count(*) FILTER (WHERE coincides) AS n_coinciding,
  {pct('count(*) FILTER (WHERE coincides)', 'count(*)')} AS match_rate
FROM rep GROUP BY 1"""),
    "large_units_top20": with_ctes(BASE, COHORTS, body=f"SELECT {COHORT_COLS} FROM coh WHERE cohort = 'large'"),
    "small_units_top20": with_ctes(BASE, COHORTS, body=f"SELECT {COHORT_COLS} FROM coh WHERE cohort = 'small'"),
    "large_vs_small_union": with_ctes(BASE, COHORTS, body=f"SELECT cohort, {COHORT_COLS} FROM coh"),
    "cohort_summary": with_ctes(BASE, COHORTS, body="""SELECT cohort, count(turnout) AS n_units,
  round(avg(turnout), 6) AS avg_turnout, min(turnout) AS min_turnout, max(turnout) AS max_turnout,
  round(stddev_samp(turnout), 6) AS stddev_turnout
FROM coh GROUP BY cohort"""),
    "cohort_top_parties": with_ctes(BASE, COHORTS, body=f"""SELECT * FROM (
  SELECT cohort, party, votes,
         CAST(row_number() OVER (PARTITION BY cohort ORDER BY votes DESC NULLS LAST, party) AS INTEGER) AS party_rank
  FROM (SELECT cohort, party, CAST(sum(votes) AS BIGINT) AS votes
        FROM (UNPIVOT (SELECT cohort, {PLIST} FROM coh) ON {PLIST} INTO NAME party VALUE votes)
        GROUP BY cohort, party))
WHERE party_rank <= {TOP_PARTIES}"""),
    "unit_top_parties": with_ctes(BASE, body=f"""SELECT * FROM (
  SELECT unit_id, unit, party, votes,
         CAST(row_number() OVER (PARTITION BY unit_id ORDER BY votes DESC NULLS LAST, party) AS INTEGER) AS party_rank
  FROM (UNPIVOT (SELECT unit_id, unit, {PLIST} FROM results_wide) ON {PLIST} INTO NAME party VALUE votes))
WHERE party_rank <= {TOP_PARTIES}"""),
    "cohort_party_wins": with_ctes(BASE, COHORTS, body=f"""SELECT cohort, party, count(*) AS n_units
FROM (SELECT cohort, {ARGMAX} AS party FROM coh) WHERE party IS NOT NULL GROUP BY cohort, party"""),
    "turnout_by_winner": with_ctes(BASE, body=f"""SELECT party, count(*) AS n_units,
  round(avg(turnout), 6) AS avg_turnout, round(avg(share), 6) AS avg_winner_share
FROM (SELECT {ARGMAX} AS party, {pct('voters', 'census')} AS turnout, {pct(MAXP, 'valid')} AS share
      FROM results_wide)
WHERE party IS NOT NULL AND turnout IS NOT NULL GROUP BY party"""),
    "turnout_explained": with_ctes(BASE, f"""u AS (
  SELECT {ARGMAX} AS winner, province, community, {pct('voters', 'census')} AS v FROM results_wide WHERE census > 0)""", """f AS (
  SELECT 'winner' AS factor, winner AS level, v FROM u UNION ALL SELECT 'province', province, v FROM u
  UNION ALL SELECT 'community', community, v FROM u)""", """m AS (
  SELECT factor, level, v, avg(v) OVER (PARTITION BY factor, level) AS lm, avg(v) OVER (PARTITION BY factor) AS gm FROM f)""",
        body="""SELECT factor, count(*) AS n_units, count(DISTINCT level) + max(CASE WHEN level IS NULL THEN 1 ELSE 0 END) AS n_levels,
  round(sum((lm - gm) * (lm - gm)) / sum((v - gm) * (v - gm)), 6) AS explained FROM m GROUP BY factor"""),
    "turnout_share_corr": with_ctes(BASE, body=f"""SELECT community, count(*) AS n_units,
  round(corr(turnout, share), 6) AS corr_turnout_share
FROM (SELECT community, {pct('voters', 'census')} AS turnout, {pct(MAXP, 'valid')} AS share
      FROM results_wide WHERE census > 0 AND valid > 0)
GROUP BY community"""),
    "clean_strings": """SELECT doc_id, trim(text) AS text, trim('  ' || lang || ' ') AS lang,
  trim(' ' || source || '   ') AS source, n_chars FROM documents""",
    "fold_accents": "SELECT doc_id, lang, strip_accents(text) AS text FROM documents",
    "clean_headers": """SELECT c_custkey AS cdigocliente, c_name AS nombrec, c_nationkey AS c_nationkey,
  c_acctbal AS saldo, c_mktsegment AS segmentomercado FROM customer""",
    "typed_cast": """SELECT o_orderkey, o_custkey AS custkey_text,
  TRY_CAST(o_orderpriority AS BIGINT) AS priority_text, TRY_CAST(format('{:,.2f}', o_totalprice) AS DOUBLE) AS price_text,
  concat_ws(',', CASE WHEN trim(o_orderpriority) <> '' AND TRY_CAST(o_orderpriority AS BIGINT) IS NULL THEN 'priority_text' END,
            CASE WHEN TRY_CAST(format('{:,.2f}', o_totalprice) AS DOUBLE) IS NULL THEN 'price_text' END) AS rejected
FROM orders""",
    "reject_report": "WITH d AS (SELECT ' ' || CAST(o_custkey AS VARCHAR) || ' ' AS custkey_text, "
                  "o_orderpriority AS priority_text, format('{:,.2f}', o_totalprice) AS price_text FROM orders)\n"
                  + "\nUNION ALL\n".join([_reject_rows("custkey_text", "BIGINT"), _reject_rows("priority_text", "BIGINT"),
                                          _reject_rows("price_text", "DOUBLE")]),
    "delimited_roundtrip": with_ctes(BASE, body=f"""SELECT {PLACE}, population FROM results_wide
ORDER BY population DESC NULLS LAST, unit_id LIMIT {TOP_N}"""),
    "managed_table_roundtrip": with_ctes(BASE, body="SELECT * FROM results_wide"),
}


def oracle_sql() -> dict[str, str]:
    from tallyframe.streaming.oracle import STREAM_SQL

    return {**SQL, **STREAM_SQL}
