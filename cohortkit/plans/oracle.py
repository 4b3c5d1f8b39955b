"""DuckDB oracle: for each query key an independent ANSI-SQL statement.

Written against the raw test tables only (pre-registered views), so it
checks the Spark library end to end.  Percentages use exact integer
half-up rounding: ``(20000*n + t) // (2*t) / 100``.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

# --- expected values, written out here so that a wrong constant in the library is noticed
LEGAL_SUFFIX_PATTERN = r"(?i)\s*(inc|corp|corporation|llc|ltd|limited)\.?$"
NAME_SUFFIXES = [" Inc", " Corp.", ", LLC", " Limited", " corporation", " Ltd. "]
TEST_ALIASES = {"customer#000000002,": "customer#000000002", "customer#000000005 ltd.": "customer#000000005"}
STATUS_INDUSTRY = {"F": "000000", "O": "510000", "P": "520000"}
INDUSTRY_BY_CODE = {"000000": "Total Nonfarm", "510000": "Information"}
METRIC_BY_ELEMENT = {"JO": "job_openings_rate", "HI": "hires_rate", "LD": "layoffs_discharges_rate"}
SERIES_IDS = ["JTS000000000000000JOR", "JTS000000000000000HIR", "JTS000000000000000LDR",
              "JTS510000000000000JOR", "JTS510000000000000HIR", "JTS510000000000000LDR"]
PRIORITY_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
LEVEL_COLUMNS = {"1-URGENT": "pct_1_urgent", "2-HIGH": "pct_2_high", "3-MEDIUM": "pct_3_medium",
                 "4-NOT SPECIFIED": "pct_4_not_specified", "5-LOW": "pct_5_low"}
TYPE_SETS = {"core": ["ECONOMY", "SMALL"], "narrow": ["ECONOMY"], "wide": ["ECONOMY", "SMALL", "STANDARD"]}


def pct(n: str, t: str) -> str:
    return f"(CAST((20000 * CAST({n} AS HUGEINT) + ({t})) // (2 * ({t})) AS DOUBLE) / 100)"


def ratio(num: str, den: str, scale: int, factor: int = 1) -> str:
    """factor*num/den rounded half-up (away from zero) to ``scale`` places, exact."""
    m = factor * 10 ** scale
    a, b = f"(CAST({num} AS HUGEINT) * {m})", f"CAST({den} AS HUGEINT)"
    q = f"((2 * abs({a}) + abs({b})) // (2 * abs({b})))"
    return f"(CASE WHEN {b} = 0 THEN NULL ELSE CAST(sign({a}) * sign({b}) * {q} AS DOUBLE) / {10 ** scale} END)"


def lit_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def case_map(expr: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"COALESCE(CASE {expr} {whens} END, {default})"


MEMBERS = ("SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL AND value IS NOT NULL "
           f"AND event_type = 'error' AND value > 8.0")
COHORT_EVENTS = f"SELECT * FROM events WHERE event_type = 'error' AND value > 8.0"
TAGGED = (f"SELECT o.*, CASE WHEN m.user_id IS NOT NULL THEN 'flagged' ELSE 'rest' END AS cohort "
          f"FROM orders o LEFT JOIN ({MEMBERS}) m ON o.o_custkey = m.user_id WHERE o.o_custkey IS NOT NULL")

_suffix_cases = " ".join(f"WHEN {i} THEN c.c_name || '{s}'" for i, s in enumerate(NAME_SUFFIXES))
DIRTY_CUSTOMERS = f"""
SELECT c.c_custkey, c.c_name,
       CASE c.c_custkey % 8 {_suffix_cases} WHEN 6 THEN '' ELSE NULL END AS dirty_name,
       CASE WHEN c.c_custkey % 3 = 0 THEN n.n_name ELSE n.n_name || ', ' || r.r_name END AS location,
       c.c_nationkey, c.c_mktsegment
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

KEY = f"lower(trim(regexp_replace(dirty_name, '{LEGAL_SUFFIX_PATTERN}', '')))"

DIRTY_ORDERS = """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice * CAST(0.9 AS DOUBLE) END AS lo,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN o_totalprice * CAST(0.5 AS DOUBLE)
            ELSE o_totalprice * CAST(1.1 AS DOUBLE) END AS hi,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS val,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS a,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_totalprice END AS b,
       CASE o_orderkey % 5 WHEN 0 THEN '1' WHEN 1 THEN '1.0' WHEN 2 THEN '0' WHEN 3 THEN '' ELSE NULL END AS flag_text
FROM orders"""

LO, HI = 10000.0, 1000000.0
RULE_INVERTED = "(lo IS NOT NULL AND hi IS NOT NULL AND lo > hi)"
RULE_BOUNDS = f"(val IS NOT NULL AND NOT (val BETWEEN {LO} AND {HI}))"
RULE_ALLNULL = "(a IS NULL AND b IS NULL)"
CLEAN_ORDERS = f"SELECT * FROM ({DIRTY_ORDERS}) WHERE NOT {RULE_INVERTED} AND NOT {RULE_BOUNDS} AND NOT {RULE_ALLNULL}"

_status_code = case_map("o_orderstatus", STATUS_INDUSTRY, "'999999'")
_counts = ("COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS jo, "
           "COUNT(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS hi, "
           "COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS ld, "
           "COUNT(*) FILTER (WHERE o_totalprice > 250000) AS qu")
_elements = " UNION ALL ".join(
    f"SELECT y, period, code, '{de}' AS de, (2000 * {c} + n) // (2 * n) AS v10 FROM c"
    for de, c in (("JO", "jo"), ("HI", "hi"), ("LD", "ld"), ("QU", "qu")))
RAW_SERIES = f"""
WITH o AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderstatus, o_orderpriority, o_totalprice
           FROM orders),
b AS (SELECT y, 'M' || lpad(CAST(m AS VARCHAR), 2, '0') AS period, o_orderstatus, {_counts}
      FROM o GROUP BY y, m, o_orderstatus
      UNION ALL
      SELECT y, 'M13' AS period, o_orderstatus, {_counts} FROM o GROUP BY y, o_orderstatus),
c AS (SELECT y, period, {_status_code} AS code, n, jo, hi, ld, qu FROM b),
e AS ({_elements})
SELECT 'JTS' || code || '000000000' || de || 'R' AS series_id, CAST(y AS VARCHAR) AS year, period,
       CAST(v10 // 10 AS VARCHAR) || '.' || CAST(v10 % 10 AS VARCHAR) AS value
FROM e"""

FILTERED_SERIES = (f"SELECT * FROM ({RAW_SERIES}) WHERE series_id IN ({lit_list(SERIES_IDS)}) "
                   "AND period <> 'M13'")


def decoded(src: str, keep_id: bool = False) -> str:
    ind = case_map("substr(sid, 4, 6)", INDUSTRY_BY_CODE, "substr(sid, 4, 6)")
    met = case_map("substr(sid, 19, 2)", METRIC_BY_ELEMENT, "substr(sid, 19, 2)")
    sid_col = "sid AS series_id, " if keep_id else ""
    return f"""
SELECT {sid_col}CASE WHEN month BETWEEN 1 AND 12 AND year IS NOT NULL THEN make_date(year, month, 1) END AS obs_date,
       year, month, {ind} AS industry, {met} AS metric, value
FROM (SELECT trim(series_id) AS sid, TRY_CAST(trim(year) AS INTEGER) AS year,
             TRY_CAST(substr(trim(period), 2, 2) AS INTEGER) AS month,
             TRY_CAST(trim(value) AS DOUBLE) AS value FROM ({src}))"""


SERIES = decoded(FILTERED_SERIES)


def q(name: str, sql: str) -> None:
    SQL[name] = sql.strip()


# ---------------------------------------------------------------- sources/sinks
q("scan_project", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
q("csv_multiline_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
q("tsv_padded_read", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
q("parquet_roundtrip", "SELECT * FROM supplier")
q("union_by_name", """
SELECT c_custkey AS key, c_name AS name, c_acctbal AS acctbal, 'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey AS key, s_name AS name, s_acctbal AS acctbal, 'supplier' AS source FROM supplier""")


# ---------------------------------------------------------------- profiling
def _profile_sql(src: str, dataset: str, cols: list[str], distinct: list[str], blank: bool,
                 string_cols: set[str]) -> str:
    parts = [f"SELECT '{dataset}' AS dataset, '_dataset' AS \"column\", 'row_count' AS metric, "
             f"CAST(COUNT(*) AS VARCHAR) AS value FROM ({src})"]
    metric = "null_or_blank_count" if blank else "null_count"
    for c in cols:
        cond = f"{c} IS NULL" + (f" OR {c} = ''" if blank and c in string_cols else "")
        parts.append(f"SELECT '{dataset}', '{c}', '{metric}', CAST(COUNT(*) FILTER (WHERE {cond}) AS VARCHAR) "
                     f"FROM ({src})")
    for c in distinct:
        parts.append(f"SELECT '{dataset}', '{c}', 'distinct_count', CAST(COUNT(DISTINCT {c}) + "
                     f"MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS VARCHAR) FROM ({src})")
    return "\nUNION ALL\n".join(parts)


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
q("profile_long", _profile_sql("SELECT * FROM orders", "orders", ORDER_COLS,
                               ["o_orderstatus", "o_orderpriority", "o_custkey"], False, set()))
q("profile_null_or_blank", _profile_sql(DIRTY_CUSTOMERS, "customers_dirty",
                                        ["c_name", "dirty_name", "location", "c_mktsegment"], [], True,
                                        {"c_name", "dirty_name", "location", "c_mktsegment"}))
q("profile_schema", f"""
WITH nn AS (UNPIVOT (SELECT {", ".join(f"COUNT({c}) AS {c}" for c in ORDER_COLS)} FROM orders)
            ON {", ".join(ORDER_COLS)} INTO NAME column_name VALUE non_null)
SELECT 'orders' AS dataset, c.column_name AS "column",
       CASE c.data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
            WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP_NS' THEN 'timestamp_ntz'
            WHEN 'TIMESTAMP_US' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(c.data_type) END AS data_type,
       CAST(c.ordinal_position AS INTEGER) AS position, nn.non_null
FROM information_schema.columns c JOIN nn ON c.column_name = nn.column_name
WHERE c.table_name = 'orders'""")
q("null_rates", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, COUNT(*) AS row_count, "
    f"{pct(f'COUNT(*) FILTER (WHERE {c} IS NULL)', 'COUNT(*)')} AS null_pct FROM ({DIRTY_ORDERS})"
    for c in ["lo", "hi", "val", "a", "b", "flag_text"]))
q("top_values", """
WITH v AS (SELECT 'p_brand' AS "column", CAST(p_brand AS VARCHAR) AS value FROM part
           UNION ALL SELECT 'p_type', CAST(p_type AS VARCHAR) FROM part
           UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part),
c AS (SELECT "column", value, COUNT(*) AS n FROM v GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY n DESC, value ASC NULLS FIRST) AS rank FROM c)
SELECT "column", value, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
q("numeric_summary", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", metric, value FROM (SELECT CAST(COUNT({c}) AS DOUBLE) AS \"count\", "
    f"ROUND(AVG({c}), 4) AS mean, ROUND(STDDEV_SAMP({c}), 4) AS stddev, MIN({c}) AS min, MAX({c}) AS max "
    f"FROM lineitem) UNPIVOT (value FOR metric IN (\"count\", mean, stddev, min, max))"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
q("ordered_sample", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5")

q("row_sample", "SELECT * FROM orders ORDER BY sha256('11:' || o_orderkey) LIMIT 500")
q("row_sample_by_level", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY sha256('11:' || o_orderkey)) AS place FROM orders) WHERE place <= 40""")
_SKETCHED = ["o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderkey"]
q("distinct_sketch_merge", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", (SELECT COUNT(*) FROM (SELECT DISTINCT {c} FROM orders)) AS exact, true AS merges_agree, true AS within_error"
    for c in _SKETCHED))
q("frequent_values", """
WITH v AS (SELECT 'l_partkey' AS "column", CAST(l_partkey AS VARCHAR) AS value FROM lineitem
           UNION ALL SELECT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders
           UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR) FROM events),
c AS (SELECT "column", value, COUNT(*) AS n FROM v GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY n DESC, value ASC NULLS FIRST) AS rank FROM c)
SELECT "column", value, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")

# ---------------------------------------------------------------- scalar cleaning
q("split_location", f"""
SELECT c_custkey, location, lower(trim(string_split(location, ',')[1])) AS city,
       lower(trim(string_split(location, ',')[2])) AS state
FROM ({DIRTY_CUSTOMERS})""")
q("epoch_millis_date", """
SELECT event_id, millis_text,
       CAST(make_timestamp(CAST(TRY_CAST(millis_text AS DOUBLE) AS BIGINT) * 1000) AS DATE) AS event_date
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) || '.0' END
             AS millis_text FROM events)""")
q("parse_date_lenient", """
SELECT o_orderkey, date_text, CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE) AS parsed_date
FROM (SELECT o_orderkey,
             CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'n/a'
                  WHEN 2 THEN CAST(month(o_orderdate) AS VARCHAR) || '/31/' || CAST(year(o_orderdate) AS VARCHAR)
                  WHEN 3 THEN '13/' || CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR)
                  ELSE CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR) || '/'
                       || CAST(year(o_orderdate) AS VARCHAR) END AS date_text
      FROM orders)""")
q("typed_casts", """
SELECT l_orderkey, l_linenumber, code, qty_text,
       TRY_CAST(trunc(TRY_CAST(qty_text AS DOUBLE)) AS INTEGER) AS as_int,
       TRY_CAST(qty_text AS DOUBLE) AS as_double
FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS code,
             CASE l_linenumber % 5 WHEN 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
                  WHEN 1 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0'
                  WHEN 2 THEN 'x' WHEN 3 THEN ''
                  ELSE '0.' || lpad(CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR), 2, '0') END AS qty_text
      FROM lineitem)""")
q("flag_coerce", f"""
SELECT o_orderkey, flag_text, COALESCE(TRY_CAST(flag_text AS DOUBLE) = 1, false) AS flag FROM ({DIRTY_ORDERS})""")
q("normalize_key", f"SELECT c_custkey, dirty_name, {KEY} AS key FROM ({DIRTY_CUSTOMERS})")
_alias_case = case_map("key", TEST_ALIASES, "key")
q("alias_map", f"SELECT c_custkey, key, {_alias_case} AS canonical FROM (SELECT c_custkey, {KEY} AS key FROM ({DIRTY_CUSTOMERS}))")
ALIAS_TABLE = (f"SELECT {KEY} AS alias, lower(c_name) AS canonical FROM ({DIRTY_CUSTOMERS}) "
               f"WHERE dirty_name IS NOT NULL AND {KEY} <> lower(c_name) AND {KEY} <> ''")
q("alias_dictionary", f"""
WITH d AS (SELECT c_custkey, {KEY} AS key FROM ({DIRTY_CUSTOMERS})),
f AS (SELECT o.o_orderkey, d.key FROM orders o JOIN d ON o.o_custkey = d.c_custkey),
a AS (SELECT alias, MIN(canonical) AS canonical FROM ({ALIAS_TABLE}) WHERE alias IS NOT NULL GROUP BY alias)
SELECT f.o_orderkey, f.key, COALESCE(a.canonical, f.key) AS resolved FROM f LEFT JOIN a ON f.key = a.alias""")

# ---------------------------------------------------------------- series decode / filters
q("series_code_decode", decoded(RAW_SERIES, keep_id=True))
q("series_filter", FILTERED_SERIES)

# ---------------------------------------------------------------- row rules and audit
q("drop_inverted_range", f"SELECT o_orderkey, lo, hi FROM ({DIRTY_ORDERS}) WHERE NOT {RULE_INVERTED}")
q("drop_out_of_bounds", f"SELECT o_orderkey, val FROM ({DIRTY_ORDERS}) WHERE NOT {RULE_BOUNDS}")
q("drop_all_null", f"SELECT o_orderkey, a, b FROM ({DIRTY_ORDERS}) WHERE NOT {RULE_ALLNULL}")


def _audit_sql(src: str, dataset: str, named_rules: list[tuple[str, str]]) -> str:
    first = "CASE " + " ".join(f"WHEN COALESCE({cond}, false) THEN {i}"
                               for i, (_, cond) in enumerate(named_rules, 1)) + " END"
    cols = ["COUNT(*) AS raw_row_count", "COUNT(*) FILTER (WHERE r IS NULL) AS final_row_count"]
    cols += [f"COUNT(*) FILTER (WHERE r = {i}) AS dropped_{n}" for i, (n, _) in enumerate(named_rules, 1)]
    names = ["raw_row_count", "final_row_count"] + [f"dropped_{n}" for n, _ in named_rules] + ["total_dropped"]
    return (f"SELECT '{dataset}' AS dataset, metric, CAST(value AS BIGINT) AS value FROM "
            f"(SELECT *, raw_row_count - final_row_count AS total_dropped FROM "
            f"(SELECT {', '.join(cols)} FROM (SELECT {first} AS r FROM ({src})))) "
            f"UNPIVOT (value FOR metric IN ({', '.join(names)}))")


q("clean_audit", _audit_sql(DIRTY_ORDERS, "orders_dirty",
                            [("inverted_range", RULE_INVERTED), ("out_of_bounds", RULE_BOUNDS),
                             ("all_measures_null", RULE_ALLNULL)])
  + "\nUNION ALL\n" +
  _audit_sql(RAW_SERIES, "series_raw",
             [("non_target_series", f"NOT COALESCE(series_id IN ({lit_list(SERIES_IDS)}), false)"),
              ("period_m13", "NOT COALESCE(period <> 'M13', false)")]))

q("clean_write_audit", f"""
WITH a AS ({SQL["clean_audit"]})
SELECT dataset, metric, value FROM a
UNION ALL SELECT dataset, 'written_row_count', value FROM a WHERE metric = 'final_row_count'
UNION ALL SELECT 'orders_dirty', 'all_null_measures', 0""")

# ---------------------------------------------------------------- lookups, bridge
q("lookup_left_join", "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_type, p.p_brand FROM lineitem l "
  "LEFT JOIN part p ON l.l_partkey = p.p_partkey")
NO_ORPHANS = ("SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_type FROM lineitem l "
              "JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_size <= 40 AND p.p_type IS NOT NULL")
q("lookup_drop_orphans", NO_ORPHANS)
DEDUP = f"SELECT l_orderkey, p_type, MIN(l_partkey) AS l_partkey FROM ({NO_ORPHANS}) GROUP BY l_orderkey, p_type"
q("dedup_pairs", DEDUP)

# ---------------------------------------------------------------- cohort core
q("cohort_members", MEMBERS)
q("cohort_tag", f"SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, cohort FROM ({TAGGED})")
q("cohort_tag_prefiltered", SQL["cohort_tag"])
q("semi_join_count", f"SELECT COUNT(*) AS matched_facts FROM orders f WHERE f.o_custkey IN ({MEMBERS})")
_diag_keys = f"SELECT DISTINCT user_id AS k FROM ({COHORT_EVENTS}) WHERE user_id IS NOT NULL"
_diag_fk = f"SELECT o_custkey AS k, COUNT(*) AS rows FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey"
q("join_hit_rate", f"""
WITH ev AS ({_diag_keys}), fk AS ({_diag_fk}),
s AS (SELECT (SELECT COUNT(*) FROM ev) AS distinct_member_keys, (SELECT COUNT(*) FROM fk) AS distinct_fact_keys,
             (SELECT COUNT(*) FROM ev JOIN fk USING (k)) AS matched_keys,
             (SELECT COUNT(*) FROM orders) AS total_facts,
             (SELECT COALESCE(SUM(rows), 0) FROM ev JOIN fk USING (k)) AS matched_facts),
p AS (SELECT *, COALESCE({pct('matched_keys', 'distinct_member_keys')}, 0.0) AS key_hit_pct,
             COALESCE({pct('matched_facts', 'total_facts')}, 0.0) AS fact_share_pct FROM s)
SELECT 1 AS position, 'distinct_member_keys' AS metric, CAST(distinct_member_keys AS VARCHAR) AS value FROM p
UNION ALL SELECT 2, 'distinct_fact_keys', CAST(distinct_fact_keys AS VARCHAR) FROM p
UNION ALL SELECT 3, 'matched_keys', CAST(matched_keys AS VARCHAR) FROM p
UNION ALL SELECT 4, 'key_hit_pct', CAST(key_hit_pct AS VARCHAR) FROM p
UNION ALL SELECT 5, 'total_facts', CAST(total_facts AS VARCHAR) FROM p
UNION ALL SELECT 6, 'matched_facts', CAST(matched_facts AS VARCHAR) FROM p
UNION ALL SELECT 7, 'fact_share_pct', CAST(fact_share_pct AS VARCHAR) FROM p""")
q("unmatched_top", f"""
SELECT c_custkey, c_name, c_acctbal FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM ({COHORT_EVENTS}) e WHERE e.user_id = c.c_custkey)
ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 20""")

# ---------------------------------------------------------------- cohort measures
q("median_by_level", f"""
SELECT cohort, o_orderpriority AS level, quantile_disc(o_totalprice, 0.5) AS median, COUNT(*) AS n
FROM ({TAGGED}) WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY 1, 2""")
q("median_exact", f"""
SELECT cohort, o_orderpriority AS level, median(CAST(round(o_totalprice * 100) AS BIGINT)) / 100 AS median,
       COUNT(*) AS n
FROM ({TAGGED}) WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY 1, 2""")
LEVEL_COUNTS = (f"SELECT cohort, o_orderpriority AS level, COUNT(*) AS n FROM ({TAGGED}) "
                f"WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2")
SHARE = (f"SELECT cohort, level, n, {pct('n', 'SUM(n) OVER (PARTITION BY cohort)')} AS pct_of_cohort "
         f"FROM ({LEVEL_COUNTS})")
q("category_share", SHARE)
BRAND_COUNTS = (f"SELECT t.cohort, p.p_brand, COUNT(*) AS n FROM ({TAGGED}) t "
                f"JOIN lineitem l ON l.l_orderkey = t.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey "
                f"GROUP BY 1, 2")


def topk(counts: str, cat_col: str, k: int = 10) -> str:
    return (f"SELECT cohort, {cat_col}, n, pct_of_cohort, CAST(rank AS INTEGER) AS rank FROM "
            f"(SELECT *, {pct('n', 'SUM(n) OVER (PARTITION BY cohort)')} AS pct_of_cohort, "
            f"ROW_NUMBER() OVER (PARTITION BY cohort ORDER BY n DESC, {cat_col}) AS rank FROM ({counts})) "
            f"WHERE rank <= {k}")


q("median_sketch_merge", """
SELECT o_orderpriority AS level, COUNT(*) AS n, true AS within_error FROM orders WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY 1""")
q("topk_tags", topk(BRAND_COUNTS, "p_brand"))
q("topk_tags_bucketed", SQL["topk_tags"])
REGION_COUNTS = (f"SELECT t.cohort, upper(n.n_name) AS region, COUNT(*) AS n FROM ({TAGGED}) t "
                 f"JOIN customer c ON c.c_custkey = t.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey "
                 f"WHERE n.n_name IS NOT NULL AND n.n_name <> '' GROUP BY 1, 2")
q("topk_region", topk(REGION_COUNTS, "region"))
q("tag_set_share", f"""
SELECT cohort, total, set_n, total - set_n AS other_n, {pct('set_n', 'total')} AS set_pct
FROM (SELECT t.cohort, COUNT(*) AS total, COUNT(*) FILTER (WHERE p.p_type IN ({lit_list(["ECONOMY", "SMALL"])})) AS set_n
      FROM ({TAGGED}) t JOIN lineitem l ON l.l_orderkey = t.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
      GROUP BY 1)""")
q("flag_rate", f"""
SELECT cohort, total, fulfilled_n, {pct('fulfilled_n', 'total')} AS fulfilled_pct
FROM (SELECT cohort, COUNT(*) AS total, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS fulfilled_n
      FROM ({TAGGED}) GROUP BY 1)""")
RANKED_LEVELS = (f"SELECT *, CAST(list_position([{lit_list(PRIORITY_ORDER)}], level) AS INTEGER) AS level_rank "
                 f"FROM ({LEVEL_COUNTS})")
q("ordinal_levels", f"SELECT cohort, level, level_rank, n FROM ({RANKED_LEVELS})")
q("ladder_cumulative", f"""
SELECT cohort, level, level_rank, n, cum_n, {pct('cum_n', 'total')} AS at_or_above_pct
FROM (SELECT *, CAST(SUM(n) OVER (PARTITION BY cohort ORDER BY level_rank DESC
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_n,
             SUM(n) OVER (PARTITION BY cohort) AS total FROM ({RANKED_LEVELS}))""")
q("cumulative_topk", f"""
SELECT cohort, p_brand, CAST(rank AS INTEGER) AS rank, n, cum_n, {pct('cum_n', 'total')} AS cum_pct
FROM (SELECT *, CAST(SUM(n) OVER (PARTITION BY cohort ORDER BY rank
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_n,
             SUM(n) OVER (PARTITION BY cohort) AS total
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cohort ORDER BY n DESC, p_brand) AS rank
            FROM ({BRAND_COUNTS})))
WHERE rank <= 10""")

# ---------------------------------------------------------------- series figures
q("series_select", f"""
SELECT obs_date, year, month, industry, value AS layoffs_discharges_rate FROM ({SERIES})
WHERE metric = 'layoffs_discharges_rate' ORDER BY industry, obs_date""")
PIVOT = f"""
SELECT obs_date, year, month, industry,
       MAX(CASE WHEN metric = 'job_openings_rate' THEN value END) AS job_openings_rate,
       MAX(CASE WHEN metric = 'hires_rate' THEN value END) AS hires_rate
FROM ({SERIES}) WHERE metric IN ('job_openings_rate', 'hires_rate')
GROUP BY obs_date, year, month, industry"""
q("series_pivot", PIVOT + " ORDER BY industry, obs_date")
W0, W1 = "1999-01-01", "2000-12-31"
INSIDE = f"obs_date BETWEEN DATE '{W0}' AND DATE '{W1}'"
PY = 1997
q("window_stats", f"""
WITH s AS ({SERIES}),
a AS (SELECT industry, metric, ROUND(median(value), 4) AS median_all,
             ROUND(median(value) FILTER (WHERE {INSIDE}), 4) AS window_median,
             MIN(value) FILTER (WHERE {INSIDE}) AS window_min, MAX(value) FILTER (WHERE {INSIDE}) AS window_max,
             MAX(value) FILTER (WHERE year = {PY}) AS peak_value
      FROM s GROUP BY industry, metric)
SELECT a.*, (SELECT MIN(s.obs_date) FROM s WHERE s.industry = a.industry AND s.metric = a.metric
             AND s.year = {PY} AND s.value = a.peak_value) AS peak_date
FROM a""")
q("peak_drop", f"""
WITH s AS (SELECT *, CAST(round(value * 10) AS BIGINT) AS t FROM ({SERIES})),
a AS (SELECT industry, metric, MAX(value) FILTER (WHERE year = {PY}) AS peak_value,
             median(value) FILTER (WHERE {INSIDE}) AS wm,
             SUM(t) FILTER (WHERE year = {PY}) AS a_sum, COUNT(value) FILTER (WHERE year = {PY}) AS a_n,
             SUM(t) FILTER (WHERE {INSIDE}) AS b_sum, COUNT(value) FILTER (WHERE {INSIDE}) AS b_n
      FROM s GROUP BY industry, metric)
SELECT industry, metric, peak_value, ROUND(wm, 4) AS window_median,
       ROUND(100.0 * (peak_value - wm) / peak_value, 2) AS drop_pct,
       {ratio('b_sum * a_n - a_sum * b_n', 'a_sum * b_n', 2, 100)} AS period_change_pct
FROM a""")
q("annual_average", f"""
SELECT industry, metric, year, months, {ratio('s', 'months * 10', 2)} AS avg_value
FROM (SELECT industry, metric, year, SUM(CAST(round(value * 10) AS BIGINT)) AS s, COUNT(*) AS months
      FROM ({SERIES}) WHERE value IS NOT NULL GROUP BY industry, metric, year)""")
q("series_crosscheck", f"""
SELECT industry, COUNT(*) AS periods, COALESCE(bool_and(job_openings_rate > hires_rate), false) AS always_above,
       COUNT(*) FILTER (WHERE NOT COALESCE(job_openings_rate > hires_rate, false)) AS exceptions
FROM ({PIVOT}) GROUP BY industry""")
q("series_completeness", f"""
SELECT *, months = expected_months AND rows = expected_months AS complete
FROM (SELECT industry, metric, COUNT(*) AS rows, COUNT(DISTINCT obs_date) AS months,
             MIN(obs_date) AS first_month, MAX(obs_date) AS last_month,
             CAST(datediff('month', MIN(obs_date), MAX(obs_date)) + 1 AS INTEGER) AS expected_months
      FROM ({SERIES}) WHERE obs_date IS NOT NULL GROUP BY industry, metric)""")
q("series_missing_months", f"""
WITH kept AS (SELECT industry, metric, obs_date FROM ({SERIES}) WHERE obs_date IS NOT NULL AND strftime(obs_date, '%Y-%m') NOT IN ('1993-04', '1995-11', '1995-12', '1997-06')),
ends AS (SELECT industry, metric, MIN(obs_date)::TIMESTAMP AS lo, MAX(obs_date)::TIMESTAMP AS hi FROM kept GROUP BY ALL),
calendar AS (SELECT industry, metric, unnest(generate_series(lo, hi, INTERVAL 1 MONTH))::DATE AS missing_month FROM ends)
SELECT c.* FROM calendar c ANTI JOIN kept k ON k.industry = c.industry AND k.metric = c.metric AND k.obs_date = c.missing_month""")
_weights_label = case_map(case_map("o_orderstatus", STATUS_INDUSTRY, "NULL"), INDUSTRY_BY_CODE,
                          case_map("o_orderstatus", STATUS_INDUSTRY, "NULL"))
q("series_composite", f"""
WITH w AS (SELECT industry, weight FROM (SELECT {_weights_label} AS industry, COUNT(*) AS weight
                                        FROM orders GROUP BY o_orderstatus) WHERE industry IS NOT NULL)
SELECT obs_date, metric, total_weight, industries, {ratio('wv', 'total_weight * 10', 2)} AS weighted_value
FROM (SELECT s.obs_date, s.metric, SUM(CAST(round(s.value * 10) AS BIGINT) * w.weight) AS wv,
             CAST(SUM(w.weight) AS BIGINT) AS total_weight, COUNT(*) AS industries
      FROM ({SERIES}) s JOIN w ON s.industry = w.industry WHERE s.value IS NOT NULL GROUP BY 1, 2)""")

# ---------------------------------------------------------------- cohort contrasts
MEDIANS = f"""
SELECT cohort, o_orderpriority AS level, quantile_disc(o_totalprice, 0.5) AS median, COUNT(*) AS n
FROM ({TAGGED}) WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL GROUP BY 1, 2"""
q("level_matrix", f"""
SELECT level, median_flagged, median_rest, n_flagged, n_rest,
       ROUND(100.0 * (median_flagged - median_rest) / median_rest, 2) AS premium_pct
FROM (SELECT level, MAX(median) FILTER (WHERE cohort = 'flagged') AS median_flagged,
             MAX(median) FILTER (WHERE cohort = 'rest') AS median_rest,
             MAX(n) FILTER (WHERE cohort = 'flagged') AS n_flagged, MAX(n) FILTER (WHERE cohort = 'rest') AS n_rest
      FROM ({MEDIANS}) GROUP BY level)""")
_levels = list(reversed(PRIORITY_ORDER))
q("share_matrix", "SELECT cohort, " + ", ".join(
    f"COALESCE(MAX(pct_of_cohort) FILTER (WHERE level = '{lv}'), 0.0) AS {LEVEL_COLUMNS[lv]}" for lv in _levels)
  + f" FROM ({SHARE}) GROUP BY cohort")
q("cohort_contrast", f"""
SELECT level, pct_flagged, pct_rest, ROUND(pct_flagged - pct_rest, 2) AS gap_pp,
       ROUND(pct_flagged / pct_rest, 3) AS ratio, (SELECT MAX(pct_of_cohort) FROM ({SHARE})) AS max_pct
FROM (SELECT level, MAX(pct_of_cohort) FILTER (WHERE cohort = 'flagged') AS pct_flagged,
             MAX(pct_of_cohort) FILTER (WHERE cohort = 'rest') AS pct_rest FROM ({SHARE}) GROUP BY level)""")
q("topk_rank_compare", f"""
WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cohort ORDER BY n DESC, p_brand) AS rank FROM ({BRAND_COUNTS})),
c AS (SELECT DISTINCT p_brand FROM r WHERE rank <= 10),
w AS (SELECT c.p_brand,
             MAX(r.n) FILTER (WHERE r.cohort = 'flagged') AS n_flagged,
             CAST(MAX(r.rank) FILTER (WHERE r.cohort = 'flagged') AS INTEGER) AS rank_flagged,
             MAX(r.n) FILTER (WHERE r.cohort = 'rest') AS n_rest,
             CAST(MAX(r.rank) FILTER (WHERE r.cohort = 'rest') AS INTEGER) AS rank_rest
      FROM c JOIN r ON r.p_brand = c.p_brand GROUP BY c.p_brand)
SELECT *, COALESCE(rank_flagged <= 10, false) AS top_flagged, COALESCE(rank_rest <= 10, false) AS top_rest,
       COALESCE(rank_flagged <= 10, false) <> COALESCE(rank_rest <= 10, false) AS missing_from_other
FROM w""")
q("member_totals", f"""
WITH ev AS (SELECT user_id, COUNT(*) AS n_events, SUM(CAST(value AS DECIMAL(18, 2))) AS total_value
            FROM ({COHORT_EVENTS}) GROUP BY user_id),
o AS (SELECT o_custkey AS user_id, COUNT(*) AS n_orders FROM orders GROUP BY 1)
SELECT CAST(ROW_NUMBER() OVER (ORDER BY total_value DESC, ev.user_id) AS INTEGER) AS rank, ev.user_id, n_events,
       CAST(total_value AS DOUBLE) AS total_value, COALESCE(n_orders, 0) AS n_orders
FROM ev LEFT JOIN o ON ev.user_id = o.user_id
ORDER BY total_value DESC, ev.user_id LIMIT 20""")
q("weighted_hit_rate", f"""
WITH ev AS (SELECT user_id, SUM(CAST(round(value * 100) AS BIGINT)) AS w FROM ({COHORT_EVENTS}) GROUP BY user_id),
s AS (SELECT CAST(COALESCE(SUM(w) FILTER (WHERE user_id IN (SELECT o_custkey FROM orders)), 0) AS BIGINT)
             AS matched_weight, CAST(SUM(w) AS BIGINT) AS total_weight FROM ev)
SELECT matched_weight, total_weight, {pct('matched_weight', 'total_weight')} AS weighted_pct FROM s""")

# ---------------------------------------------------------------- integrity
q("orphan_tags", f"""
SELECT orphan_rows, bridge_rows, {pct('orphan_rows', 'bridge_rows')} AS orphan_pct
FROM (SELECT COUNT(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM ({CLEAN_ORDERS}))) AS orphan_rows,
             COUNT(*) AS bridge_rows FROM lineitem)""")
q("integrity_checks", f"""
SELECT 'no_duplicate_keys' AS "check", dups = 0 AS passed, CAST(dups AS BIGINT) AS observed
FROM (SELECT COUNT(*) FILTER (WHERE c > 1) AS dups FROM (SELECT COUNT(*) AS c FROM ({DEDUP}) GROUP BY l_orderkey, p_type))
UNION ALL
SELECT 'no_all_null_measures', bad = 0, CAST(bad AS BIGINT)
FROM (SELECT COUNT(*) FILTER (WHERE a IS NULL AND b IS NULL) AS bad FROM ({CLEAN_ORDERS}))
UNION ALL
SELECT 'cohorts_reconcile', gap = 0, CAST(gap AS BIGINT)
FROM (SELECT (SELECT COUNT(*) FROM orders) - (SELECT COUNT(*) FROM ({TAGGED}))
             - (SELECT COUNT(*) FROM orders WHERE o_custkey IS NULL) AS gap)""")

# ---------------------------------------------------------------- proposed (tier P)
q("recency_cohort", f"""
WITH last AS (SELECT user_id, MAX(ts) AS last_ts FROM events WHERE event_type = 'error'
              AND user_id IS NOT NULL GROUP BY user_id),
t AS (SELECT o.o_orderkey, o.o_custkey,
             CASE WHEN l.last_ts IS NULL THEN 'none' WHEN l.last_ts >= TIMESTAMP '2024-01-15' THEN 'recent'
                  ELSE 'lapsed' END AS cohort
      FROM orders o LEFT JOIN last l ON o.o_custkey = l.user_id WHERE o.o_custkey IS NOT NULL)
SELECT cohort, COUNT(*) AS n_orders, COUNT(DISTINCT o_custkey) AS n_customers FROM t GROUP BY cohort""")
q("matched_strata", f"""
WITH c AS (SELECT cu.c_mktsegment, t.cohort, COUNT(*) AS n, COUNT(*) FILTER (WHERE t.o_orderstatus = 'F') AS fulfilled_n
           FROM ({TAGGED}) t JOIN customer cu ON cu.c_custkey = t.o_custkey GROUP BY 1, 2),
k AS (SELECT c_mktsegment FROM c GROUP BY 1 HAVING MIN(cohort) <> MAX(cohort))
SELECT c.c_mktsegment, c.cohort, c.n, c.fulfilled_n, {pct('c.fulfilled_n', 'c.n')} AS fulfilled_pct
FROM c JOIN k USING (c_mktsegment)""")
_nullable_flag = ("CASE WHEN flag_text IS NULL OR trim(flag_text) = '' THEN NULL "
                  "ELSE COALESCE(TRY_CAST(flag_text AS DOUBLE) = 1, false) END")
q("null_aware_rate", f"""
SELECT cohort, total, known, flag_n, {pct('flag_n', 'known')} AS flag_pct_known, {pct('flag_n', 'total')} AS flag_pct_all
FROM (SELECT cohort, COUNT(*) AS total, COUNT(f) AS known, COUNT(*) FILTER (WHERE f) AS flag_n
      FROM (SELECT CASE WHEN m.user_id IS NOT NULL THEN 'flagged' ELSE 'rest' END AS cohort, {_nullable_flag} AS f
            FROM ({DIRTY_ORDERS}) d LEFT JOIN ({MEMBERS}) m ON d.o_custkey = m.user_id WHERE d.o_custkey IS NOT NULL)
      GROUP BY cohort)""")
q("small_cells", f"""
SELECT cohort, region, n, CASE WHEN n < 50 THEN NULL ELSE pct_of_cohort END AS pct_of_cohort,
       n < 50 AS small_cell
FROM (SELECT *, {pct('n', 'SUM(n) OVER (PARTITION BY cohort)')} AS pct_of_cohort FROM ({REGION_COUNTS}))""")
_sets = " UNION ALL ".join(f"SELECT '{name}' AS set_name, '{code}' AS p_type"
                           for name, codes in TYPE_SETS.items() for code in codes)
q("set_sensitivity", f"""
WITH j AS (SELECT t.cohort, p.p_type FROM ({TAGGED}) t JOIN lineitem l ON l.l_orderkey = t.o_orderkey
           JOIN part p ON p.p_partkey = l.l_partkey),
tot AS (SELECT cohort, COUNT(*) AS total FROM j GROUP BY cohort),
s AS (SELECT st.set_name, j.cohort, COUNT(*) AS set_n FROM j JOIN ({_sets}) st ON st.p_type = j.p_type GROUP BY 1, 2)
SELECT s.set_name, s.cohort, tot.total, s.set_n, {pct('s.set_n', 'tot.total')} AS set_pct
FROM s JOIN tot USING (cohort)""")
R = 200


def _u(*parts: str) -> str:
    """A uniform number from the first 13 hex digits of a hash."""
    return f"('0x' || substr(sha256(concat_ws(':', {', '.join(parts)})), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE"


def _choose(n: str, k: str) -> str:
    return f"(lgamma({n} + 1) - lgamma({k} + 1) - lgamma({n} - {k} + 1))"


# Outward order from the mode: mode, mode + 1, mode - 1, mode + 2, ..
_OUTWARD = "2 * abs(x - mode) - (x > mode)::INT"


def _sample_ranks(start: str, mode: str, low: str, high: str, weight: str, seed: str) -> str:
    """Ranks ``r`` (from 1) of ``start`` (rep, low, size, held, k): halve the ranks, draw the sampled rows of the lower half.

    ``mode``, ``low``, ``high`` and ``weight`` (a logarithm) give the law of x among ``held`` for the half ``g`` of ``size``.
    """
    return f"""
halved AS (
  SELECT rep, k AS want, low, size, held, k FROM ({start})
  UNION ALL
  SELECT rep, want, IF(k <= h, low, low + g), IF(k <= h, g, size - g), IF(k <= h, h, held - h), IF(k <= h, k, k - h) FROM (
    SELECT rep, want, low, size, held, k, g, arg_min(x, place) FILTER (u * total < upto) AS h FROM (
      SELECT *, sum(p) OVER (PARTITION BY rep, want ORDER BY place) AS upto, sum(p) OVER (PARTITION BY rep, want) AS total FROM (
        SELECT *, {_OUTWARD} AS place, exp({weight}) AS p FROM (
          SELECT *, unnest(range(greatest({low}, mode - far), least({high}, mode + far) + 1)) AS x FROM (
            SELECT *, {mode} AS mode, (9 * sqrt(held) / 2)::BIGINT + 40 AS far, {_u(seed, 'rep', 'low', 'size')} AS u
            FROM (SELECT *, size // 2 AS g FROM halved WHERE size > 1)))))
    GROUP BY ALL)),
ranks AS (SELECT rep, want, low + 1 AS r FROM halved WHERE size <= 1)"""


_WITH_REPLACEMENT = dict(
    mode="((held + 1) * g // size)", low="0", high="held", weight=f"{_choose('held', 'x')} + x * ln(g / size) + (held - x) * ln((size - g) / size)")
# Equal-size draws: in each replicate the rows with the smallest 32-bit draws, ties by id.
_DRAWN = """
reps AS (SELECT range AS rep FROM range(1, 1001)),
blocks AS (SELECT p.*, b.range AS block, sha256(CAST(p.o_orderkey AS VARCHAR) || ':' || CAST(b.range AS VARCHAR)) AS h
           FROM pop p, range(0, 125) b),
d AS (SELECT blocks.*, block * 8 + j.range + 1 AS rep, substr(h, CAST(8 * j.range + 1 AS INTEGER), 8) AS draw FROM blocks, range(0, 8) j),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY rep ORDER BY draw, o_orderkey) AS rank FROM d),
taken AS (SELECT * FROM r WHERE rank <= (SELECT observed_total FROM obs))"""
q("bootstrap_rate", f"""
WITH t AS ({TAGGED}),
obs AS (SELECT COUNT(*) AS observed_total, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS observed_n
        FROM t WHERE cohort = 'flagged'),
pop AS (SELECT o_orderkey, COALESCE(o_orderstatus = 'F', false) AS flag FROM t WHERE cohort = 'rest'), {_DRAWN},
per AS (SELECT reps.rep, COUNT(taken.rep) AS d, COUNT(*) FILTER (WHERE taken.flag) AS k
        FROM reps LEFT JOIN taken ON reps.rep = taken.rep GROUP BY reps.rep)
SELECT COUNT(*) AS reps, (SELECT observed_total FROM obs) AS observed_total, (SELECT observed_n FROM obs) AS observed_n,
       {pct('(SELECT observed_n FROM obs)', '(SELECT observed_total FROM obs)')} AS observed_pct,
       CAST(SUM(d) AS BIGINT) AS drawn_rows,
       COUNT(*) FILTER (WHERE d > 0 AND k * (SELECT observed_total FROM obs) >= (SELECT observed_n FROM obs) * d) AS reach,
       {ratio('COUNT(*) FILTER (WHERE d > 0 AND k * (SELECT observed_total FROM obs) >= (SELECT observed_n FROM obs) * d)', 'COUNT(*)', 4)} AS reach_share
FROM per""")
q("bootstrap_median_baseline", f"""
WITH t AS (SELECT o_orderkey, cohort, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM ({TAGGED}) WHERE o_totalprice IS NOT NULL),
obs AS (SELECT COUNT(*) AS observed_total, median(cents) AS m FROM t WHERE cohort = 'flagged'),
pop AS (SELECT o_orderkey, cents FROM t WHERE cohort = 'rest'), {_DRAWN},
per AS (SELECT rep, COUNT(*) AS d, median(cents) AS m FROM taken GROUP BY rep)
SELECT COUNT(*) AS reps, (SELECT observed_total FROM obs) AS observed_n, (SELECT m FROM obs) AS observed_median,
       CAST(SUM(d) AS BIGINT) AS drawn_rows, COUNT(*) FILTER (WHERE m >= (SELECT m FROM obs)) AS reach,
       {ratio('COUNT(*) FILTER (WHERE m >= (SELECT m FROM obs))', 'COUNT(*)', 4)} AS reach_share
FROM per""")
q("bootstrap_median", f"""
WITH RECURSIVE cell AS (SELECT CAST(round(o_totalprice * 100) AS BIGINT) AS x FROM ({TAGGED})
                        WHERE cohort = 'flagged' AND o_orderpriority = '1-URGENT' AND o_totalprice IS NOT NULL),
s AS (SELECT COUNT(*) AS n, median(x) AS m FROM cell),
pop AS (SELECT x AS cents, ROW_NUMBER() OVER (ORDER BY x) AS r FROM cell),
{_sample_ranks(f"SELECT range AS rep, 0::BIGINT AS low, n AS size, n AS held, unnest(list_distinct([(n - 1) // 2 + 1, n // 2 + 1])) AS k FROM range(1, {R + 1}), s WHERE n > 0",
               seed="'cell'", **_WITH_REPLACEMENT)},
per AS (SELECT rep, (MIN(cents) + MAX(cents)) / 2.0 AS m FROM ranks JOIN pop USING (r) GROUP BY rep)
SELECT 'flagged' AS cohort, '1-URGENT' AS level, MAX(s.n) AS n, COUNT(*) AS reps, ROUND(MAX(s.m) / 100, 2) AS median,
       ROUND(quantile_cont(per.m, 0.025) / 100, 2) AS ci_low, ROUND(quantile_cont(per.m, 0.975) / 100, 2) AS ci_high
FROM per, s""")
q("fuzzy_key_match", f"""
WITH d AS ({DIRTY_CUSTOMERS}),
k AS (SELECT DISTINCT {KEY} AS key FROM d WHERE {KEY} IS NOT NULL AND {KEY} <> ''),
c AS (SELECT DISTINCT lower(c_name) AS canonical FROM d WHERE c_name IS NOT NULL),
u AS (SELECT key FROM k WHERE key NOT IN (SELECT canonical FROM c))
SELECT u.key AS left_key, c.canonical AS right_key, levenshtein(u.key, c.canonical) AS distance
FROM u JOIN c ON abs(length(u.key) - length(c.canonical)) <= 1
WHERE levenshtein(u.key, c.canonical) <= 1 AND u.key <> c.canonical""")

# ---------------------------------------------------------------- results written and read back, long profile, sample
q("result_csv", SHARE)
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_null_rows = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", 'null_count' AS metric, CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS VARCHAR) AS value FROM orders"
    for c in _ORDER_COLUMNS)
_distinct_rows = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", 'distinct_count' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM (SELECT DISTINCT {c} FROM orders)"
    for c in ("o_orderstatus", "o_orderpriority"))
_top_rows = " UNION ALL ".join(f"""
SELECT '{c}' AS "column", metric, value FROM (
  SELECT unnest(['top_' || rank || '_value', 'top_' || rank || '_count']) AS metric,
         unnest([v, CAST(n AS VARCHAR)]) AS value
  FROM (SELECT v, n, ROW_NUMBER() OVER (ORDER BY n DESC, v NULLS FIRST) AS rank
        FROM (SELECT CAST({c} AS VARCHAR) AS v, COUNT(*) AS n FROM orders GROUP BY 1)) WHERE rank <= 3)"""
                               for c in ("o_orderstatus", "o_orderpriority"))
_sum_rows = """
SELECT 'o_totalprice' AS "column", metric, value FROM (
  SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS metric,
         unnest([CAST(COUNT(o_totalprice) AS VARCHAR), printf('%.2f', AVG(o_totalprice)), printf('%.2f', stddev_samp(o_totalprice)),
                 printf('%.2f', MIN(o_totalprice)), printf('%.2f', MAX(o_totalprice))]) AS value FROM orders)"""
LONG_PROFILE = f"""
SELECT 'orders' AS dataset, "column", metric, value FROM (
  SELECT '_dataset' AS "column", 'row_count' AS metric, CAST(COUNT(*) AS VARCHAR) AS value FROM orders
  UNION ALL {_null_rows} UNION ALL {_distinct_rows} UNION ALL {_top_rows} UNION ALL {_sum_rows})"""
q("profile_table", LONG_PROFILE)
q("profile_csv", LONG_PROFILE)
