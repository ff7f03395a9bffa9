"""Joins (X) and window functions (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators import checks, joins, windows
from palimpsest.plans.fixtures import sql, table, with_fixtures


#: Dated rows some of whose times are null, on both sides.
DATED = "SELECT series_id, vintage, CASE WHEN day(obs_date) <> 9 THEN obs_date END AS obs_date FROM obs"
FULL = "SELECT series_id, CASE WHEN day(vintage) <> 11 THEN vintage END AS full_at FROM obs WHERE units = 'USD'"


def x1_asof_backward(spark, d):
    return joins.asof_join(sql(spark, d, DATED), sql(spark, d, FULL), "obs_date", "full_at", ["series_id"], ["full_at"], ranges=8).select("series_id", "obs_date", "vintage", "full_at")


def x2_asof_forward(spark, d):
    return joins.asof_by_distinct(table(spark, d, "facts").select("filed").distinct(), "filed", table(spark, d, "sessions"), "session", "available_date")


def x3_asof_by_distinct(spark, d):
    return joins.asof_by_distinct(table(spark, d, "facts").select("cik", "accession", "concept", "filed", "val"), "filed", table(spark, d, "sessions"), "session", "available_date")


def x4_window_join(spark, d):
    w = sql(spark, d, "SELECT series_id, vintage AS win_start, coalesce(lead(vintage) OVER (PARTITION BY series_id ORDER BY vintage) - INTERVAL 1 DAY, DATE '9999-12-31') AS win_end FROM (SELECT DISTINCT series_id, vintage FROM obs) v")
    w = w.withColumn("win_end", F.col("win_end").cast("date"))
    return joins.window_join(table(spark, d, "obs").select("series_id", "obs_date", "value"), w, "series_id", "obs_date", "win_start", "win_end")


def x5_expand_sessions(spark, d):
    w = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day"))
    return joins.expand_sessions(w, table(spark, d, "sessions"), "session", "first_day", "last_day").groupBy("o_custkey").agg(F.count("*").alias("sessions"))


def x6_null_safe_anti(spark, d):
    a = sql(spark, d, "SELECT DISTINCT CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE s_nationkey END AS k FROM supplier")
    b = sql(spark, d, "SELECT DISTINCT CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer WHERE c_nationkey < 15")
    return joins.null_safe_join(a, b, ["k"], "anti")


def x7_reconcile_full(spark, d):
    a = sql(spark, d, "SELECT run_id, dataset, rows_downloaded AS n FROM loads WHERE dataset <> 'view'")
    b = sql(spark, d, "SELECT run_id, dataset, rows_written AS n FROM loads WHERE run_id <> 'r3'")
    return joins.reconcile_full(a, b, ["run_id", "dataset"], ["n"])


def x9_not_exists(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


def x12_due_sessions(spark, d):
    last = sql(spark, d, "SELECT ticker, max(obs_date) AS last_date FROM prices WHERE ticker <> 'LOW' OR obs_date < DATE '1998-06-01' GROUP BY ticker")
    return joins.due_sessions(last, table(spark, d, "sessions"), "session", F.lit("1998-07-15").cast("date"), ["ticker"])


def x14_period_average(spark, d):
    periods = sql(spark, d, "SELECT DISTINCT CAST(date_trunc('year', obs_date) AS DATE) AS p_start, CAST(date_trunc('year', obs_date) + INTERVAL 1 YEAR AS DATE) AS p_end FROM prices")
    out = joins.period_average(periods, table(spark, d, "prices"), "obs_date", "close", ["ticker"], "p_start", "p_end")
    return out.withColumn("mean", F.round("mean", 4))


def x15_orphan_keys(spark, d):
    child = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderdate")
    return joins.orphan_keys(child, table(spark, d, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k")), "k", F.year("o_orderdate"))


def x17_safe_filing_join(spark, d):
    facts = sql(spark, d, "SELECT cik, accession, count(*) AS n_facts FROM facts GROUP BY cik, accession")
    return joins.safe_filing_join(facts, table(spark, d, "facts").filter("form = '10-K/A'"), ["cik", "accession"])


def x19_array_membership(spark, d):
    lists = sql(spark, d, "SELECT l_orderkey AS o_orderkey, collect_list(l_suppkey) AS suppliers FROM lineitem GROUP BY l_orderkey")
    rows = sql(spark, d, "SELECT o_orderkey, o_custkey % 10 AS supplier FROM orders")
    return joins.array_membership(rows, lists, ["o_orderkey"], "supplier", "suppliers")


def x18_list_overlap(spark, d):
    a = sql(spark, d, "SELECT cik, year(filed) AS y, accession FROM facts WHERE accession % 3 <> 0")
    b = sql(spark, d, "SELECT cik, year(filed) AS y, accession FROM facts WHERE accession % 5 <> 0")
    return joins.list_overlap(a, b, ["accession"], ["y"])


def e1_top_row(spark, d):
    return windows.top_row(table(spark, d, "facts"), ["cik", "concept"], [F.desc("filed"), F.desc("accession"), F.desc("val")]).select("cik", "concept", "accession", "filed", "val")


def e2_at_max(spark, d):
    return windows.at_max(table(spark, d, "obs"), ["series_id"], "vintage").select("series_id", "obs_date", "vintage")


def e3_neighbours(spark, d):
    return windows.neighbours(table(spark, d, "prices"), ["ticker"], ["obs_date"], ["close"])


#: Split factors, some of them 0, negative or null.
FACTORS = """SELECT ticker, obs_date, CASE WHEN obs_date BETWEEN DATE '1997-06-01' AND DATE '1997-06-04' THEN 0.0 WHEN obs_date BETWEEN DATE '1998-08-01' AND DATE '1998-08-04' AND ticker = 'LOW' THEN CAST(NULL AS DOUBLE)
 WHEN day(obs_date) = 5 THEN -1.0 * split_factor ELSE split_factor END AS factor FROM ref_prices"""


def e5_cum_factor_after(spark, d):
    return windows.cum_factor_after(sql(spark, d, FACTORS), ["ticker"], "obs_date", "factor").select("ticker", "obs_date", F.round(F.col("factor_after") + 0.0, 6).alias("factor_after"))


def e7_rank_in_group(spark, d):
    return windows.rank_in_group(table(spark, d, "company_years").withColumn("rev", F.col("revenue").cast("double")), ["sic", "yr"], "rev").select("cik", "yr", F.round("pct_rank", 6).alias("pct_rank"), "n_peers", F.round(F.col("peer_median") * 2, 2).alias("twice_median"))


def e8_weighted_position(spark, d):
    return windows.weighted_position(table(spark, d, "company_years"), ["yr"], ["revenue", "cik"], "revenue").select("cik", "yr", F.round(F.col("position").cast("double"), 6).alias("position"))


def e9_weighted_percentiles(spark, d):
    return windows.weighted_percentiles(table(spark, d, "company_years"), ["yr"], "net_income", ["cik"], "revenue", [0.25, 0.5, 0.75])


def e10_weight_groups(spark, d):
    return windows.weight_groups(table(spark, d, "company_years"), ["yr"], ["net_income", "cik"], "revenue", 5).select("cik", "yr", "weight_group")


def e12_rollup_levels(spark, d):
    rows = sql(spark, d, "SELECT r_name, n_name, c_mktsegment AS seg, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS bal FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
    return windows.rollup_levels(rows, ["r_name", "n_name", "seg"], "bal", "c_name").withColumn("total", F.col("total").cast("decimal(22,2)"))


def e14_seeded_sample(spark, d):
    return windows.seeded_sample(table(spark, d, "prices"), ["ticker"], ["obs_date"], "run7", 10, "obs_date").select("ticker", "obs_date")


def e15_increments(spark, d):
    totals = sql(spark, d, "SELECT ticker, year(obs_date) AS y, obs_date, CAST(sum(CAST(close AS DECIMAL(14,2))) OVER (PARTITION BY ticker, year(obs_date) ORDER BY obs_date) AS DECIMAL(22,2)) AS total FROM prices")
    return windows.increments(totals, ["ticker", "y"], "obs_date", "total").select("ticker", "obs_date", F.col("increment").cast("decimal(22,2)").alias("increment"))


def x8_left_or_empty(spark, d):
    clock = spark.sql("SELECT TIMESTAMP '2024-01-05 00:00:00' AS clock")
    return joins.left_or_empty(clock, table(spark, d, "loads"), "loaded_at >= clock + INTERVAL 400 DAY").groupBy("clock").agg(F.max("loaded_at").alias("newest"), F.count("run_id").alias("n"))


def x10_expected_product(spark, d):
    wanted = checks.expected_product(table(spark, d, "series_catalog").select("source"), "units", ["USD", "Index", "EUR"])
    served = table(spark, d, "obs").filter("value > 490").select(F.split_part("series_id", F.lit(":"), F.lit(2)).alias("source"), "units")
    return wanted.join(served, ["source", "units"], "left_anti")


def x11_lateral(spark, d):
    return joins.lateral(table(spark, d, "company_years"), ratio="try_divide(CAST(net_income AS DOUBLE), CAST(revenue AS DOUBLE))", margin="round(ratio, 6)").select("cik", "yr", "margin")


SHARES = "SELECT ticker, obs_date AS from_date, CAST(1000 + day(obs_date) AS DOUBLE) AS shares FROM ref_prices WHERE split_factor <> 1"
ANNUAL = "SELECT substr(o_orderpriority, 3) AS ticker, CAST(o_orderdate AS DATE) AS filed, max(o_totalprice) AS val FROM orders WHERE month(o_orderdate) = 3 AND day(o_orderdate) = 15 GROUP BY 1, 2"


def x13_asof_valuation(spark, d):
    out = joins.asof_valuation(table(spark, d, "prices"), sql(spark, d, SHARES), sql(spark, d, ANNUAL))
    return out.withColumns({"market_value": F.round("market_value", 2), "multiple": F.round("multiple", 6)})


def x16_lines_wide(spark, d):
    rows = table(spark, d, "facts").groupBy("cik", F.year("end_date").alias("yr"), "concept").agg(F.max("val").alias("val"))
    return joins.lines_wide(rows, ["cik", "yr"], "concept", "val", {"af": "AF", "no": "NO"})


def e4_window_agg_if(spark, d):
    return windows.window_agg_if(table(spark, d, "obs"), ["series_id"], "max", "value", "units = 'USD'", "top_usd").select("series_id", "obs_date", "vintage", "top_usd")


def e6_first_in(spark, d):
    return windows.first_in(table(spark, d, "facts"), ["cik", "concept"], ["filed", "accession", "val"], "val", "first_val").select("cik", "concept", "accession", "first_val", "val")


def e11_weight_slices(spark, d):
    return windows.weight_slices(table(spark, d, "company_years"), ["yr"], ["revenue", "cik"], "revenue", 20).select("cik", "yr", "slice")


def e13_running_total(spark, d):
    return windows.running_total(table(spark, d, "company_years"), ["cik"], ["yr"], "revenue", "running").select("cik", "yr", F.col("running").cast("decimal(38,2)").alias("running"))


QUERIES = {k: f for k, f in globals().items() if k[:1] in "xe" and k[1:2].isdigit()}
ORACLES = {
    "x8_left_or_empty": "SELECT TIMESTAMP '2024-01-05 00:00:00' AS clock, max(loaded_at) AS newest, count(*) AS n FROM loads WHERE loaded_at >= TIMESTAMP '2024-01-05 00:00:00' + INTERVAL 400 DAY",
    "x10_expected_product": "SELECT source, units FROM (SELECT DISTINCT source, unnest(['USD', 'Index', 'EUR']) AS units FROM series_catalog) WHERE (source, units) NOT IN (SELECT (split_part(series_id, ':', 2), units) FROM obs WHERE value > 490)",
    "x11_lateral": "SELECT cik, yr, round(CAST(net_income AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0), 6) AS margin FROM company_years",
    "x13_asof_valuation": f"""SELECT p.ticker, p.obs_date, p.close, s.shares, a.val, round(p.close * s.shares, 2) AS market_value, round(p.close * s.shares / nullif(a.val, 0), 6) AS multiple
 FROM prices p ASOF LEFT JOIN ({SHARES}) s ON s.ticker = p.ticker AND s.from_date <= p.obs_date ASOF LEFT JOIN ({ANNUAL}) a ON a.ticker = p.ticker AND a.filed <= p.obs_date""",
    "x16_lines_wide": "SELECT cik, year(end_date) AS yr, max(val) FILTER (WHERE concept = 'AF') AS af, max(val) FILTER (WHERE concept = 'NO') AS no FROM facts WHERE concept IN ('AF', 'NO') GROUP BY 1, 2",
    "e4_window_agg_if": "SELECT o.series_id, obs_date, vintage, top_usd FROM obs o JOIN (SELECT series_id, max(value) FILTER (WHERE units = 'USD') AS top_usd FROM obs GROUP BY 1) t ON t.series_id = o.series_id",
    "e6_first_in": "SELECT f.cik, f.concept, accession, first_val, val FROM facts f JOIN (SELECT cik, concept, arg_min(val, row(filed, accession, val)) AS first_val FROM facts GROUP BY 1, 2) g ON g.cik = f.cik AND g.concept = f.concept",
    "e11_weight_slices": "SELECT cik, yr, CAST(least(floor(20 * CAST(running AS DOUBLE) / CAST(total AS DOUBLE)), 19) AS INTEGER) AS slice FROM (SELECT cik, yr, sum(revenue) OVER (PARTITION BY yr ORDER BY revenue, cik ROWS UNBOUNDED PRECEDING) - revenue AS running, sum(revenue) OVER (PARTITION BY yr) AS total FROM company_years)",
    "e13_running_total": "SELECT a.cik, a.yr, CAST(sum(b.revenue) AS DECIMAL(38,2)) AS running FROM company_years a JOIN company_years b ON a.cik = b.cik AND b.yr <= a.yr GROUP BY a.cik, a.yr",

    "x1_asof_backward": f"""SELECT o.series_id, o.obs_date, o.vintage, (SELECT max(f.full_at) FROM ({FULL}) f WHERE f.series_id = o.series_id AND f.full_at <= o.obs_date) AS full_at FROM ({DATED}) o""",
    "x2_asof_forward": "SELECT filed, (SELECT min(session) FROM sessions WHERE session > filed) AS available_date FROM (SELECT DISTINCT filed FROM facts)",
    "x3_asof_by_distinct": "SELECT cik, accession, concept, filed, val, s AS available_date FROM facts LEFT JOIN (SELECT filed AS f, (SELECT min(session) FROM sessions WHERE session > filed) AS s FROM (SELECT DISTINCT filed FROM facts)) ON f = filed",
    "x4_window_join": """SELECT o.series_id, o.obs_date, o.value, w.win_start, w.win_end FROM obs o JOIN (
 SELECT series_id, vintage AS win_start, CAST(coalesce(lead(vintage) OVER (PARTITION BY series_id ORDER BY vintage) - INTERVAL 1 DAY, DATE '9999-12-31') AS DATE) AS win_end FROM (SELECT DISTINCT series_id, vintage FROM obs)) w
 ON o.series_id = w.series_id AND o.obs_date BETWEEN w.win_start AND w.win_end""",
    "x5_expand_sessions": """SELECT o_custkey, count(*) AS sessions FROM (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY o_custkey) w
 JOIN sessions ON session BETWEEN a AND b GROUP BY o_custkey""",
    "x6_null_safe_anti": """SELECT k FROM (SELECT DISTINCT CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE s_nationkey END AS k FROM supplier) a
 WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT CASE WHEN c_nationkey % 7 = 0 THEN NULL ELSE c_nationkey END AS j FROM customer WHERE c_nationkey < 15) b WHERE a.k IS NOT DISTINCT FROM b.j)""",
    "x7_reconcile_full": """SELECT coalesce(a.run_id, b.run_id) AS run_id, coalesce(a.dataset, b.dataset) AS dataset,
 CASE WHEN a.run_id IS NULL THEN 'missing_left' WHEN b.run_id IS NULL THEN 'missing_right' ELSE 'n' END AS problem
 FROM (SELECT run_id, dataset, rows_downloaded AS n FROM loads WHERE dataset <> 'view') a FULL JOIN (SELECT run_id, dataset, rows_written AS n FROM loads WHERE run_id <> 'r3') b
 ON a.run_id = b.run_id AND a.dataset = b.dataset WHERE a.run_id IS NULL OR b.run_id IS NULL OR a.n <> b.n""",
    "x9_not_exists": "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "x12_due_sessions": """SELECT ticker, last_date, (SELECT max(session) FROM sessions WHERE session <= DATE '1998-07-15') AS due,
 (SELECT count(*) FROM sessions WHERE session <= DATE '1998-07-15' AND session > last_date) AS behind
 FROM (SELECT ticker, max(obs_date) AS last_date FROM prices WHERE ticker <> 'LOW' OR obs_date < DATE '1998-06-01' GROUP BY ticker)""",
    "x14_period_average": """SELECT ticker, CAST(date_trunc('year', obs_date) AS DATE) AS p_start, CAST(date_trunc('year', obs_date) + INTERVAL 1 YEAR AS DATE) AS p_end, round(avg(close), 4) AS mean, count(close) AS n FROM prices GROUP BY ALL""",
    "x15_orphan_keys": """WITH p AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0), r AS (SELECT 'child' AS side, CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey AS k, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT k FROM p) GROUP BY ALL
 UNION ALL SELECT 'parent', NULL, k, count(*) FROM p WHERE k NOT IN (SELECT o_custkey FROM orders) GROUP BY ALL), q AS (SELECT *, row_number() OVER (PARTITION BY side, year ORDER BY n DESC, k) AS rk FROM r)
SELECT side, year, count(*) AS keys, CAST(sum(n) AS BIGINT) AS n_rows, string_agg(CAST(k AS VARCHAR), ',' ORDER BY rk) FILTER (WHERE rk <= 3) AS examples FROM q GROUP BY side, year""",
    "x17_safe_filing_join": """SELECT f.*, n.filings_of_key FROM (SELECT cik, accession, count(*) AS n_facts FROM facts GROUP BY ALL) f
 LEFT JOIN (SELECT cik, accession, count(*) AS filings_of_key FROM facts WHERE form = '10-K/A' GROUP BY ALL) n ON f.cik = n.cik AND f.accession = n.accession""",
    "x19_array_membership": "SELECT o_orderkey, o_custkey % 10 AS supplier, list_contains(s, o_custkey % 10) AS listed FROM orders LEFT JOIN (SELECT l_orderkey, list(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey) x ON l_orderkey = o_orderkey",
    "x18_list_overlap": """SELECT y, count(*) FILTER (WHERE l AND r) AS in_both, count(*) FILTER (WHERE l AND NOT r) AS left_only, count(*) FILTER (WHERE r AND NOT l) AS right_only FROM (
 SELECT year(filed) AS y, accession, bool_or(accession % 3 <> 0) AS l, bool_or(accession % 5 <> 0) AS r FROM facts WHERE accession % 3 <> 0 OR accession % 5 <> 0 GROUP BY ALL) GROUP BY y""",
    "e1_top_row": "SELECT cik, concept, accession, filed, val FROM (SELECT *, row_number() OVER (PARTITION BY cik, concept ORDER BY filed DESC, accession DESC, val DESC) AS n FROM facts) WHERE n = 1",
    "e2_at_max": "SELECT series_id, obs_date, vintage FROM obs QUALIFY vintage = max(vintage) OVER (PARTITION BY series_id)",
    "e3_neighbours": "SELECT ticker, obs_date, close, lag(close) OVER (PARTITION BY ticker ORDER BY obs_date) AS prev_close, lead(close) OVER (PARTITION BY ticker ORDER BY obs_date) AS next_close FROM prices",
    "e5_cum_factor_after": f"""SELECT ticker, obs_date, CASE WHEN count(*) FILTER (WHERE factor IS NULL) OVER w = 0 THEN round(coalesce(product(factor) OVER w, 1.0) + 0.0, 6) END AS factor_after
 FROM ({FACTORS}) WINDOW w AS (PARTITION BY ticker ORDER BY obs_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    "e7_rank_in_group": """SELECT cik, yr, round(percent_rank() OVER (PARTITION BY sic, yr ORDER BY revenue), 6) AS pct_rank, count(revenue) OVER (PARTITION BY sic, yr) AS n_peers,
 round(median(CAST(revenue AS DOUBLE)) OVER (PARTITION BY sic, yr) * 2, 2) AS twice_median FROM company_years""",
    "e8_weighted_position": "SELECT cik, yr, round(CAST(sum(revenue) OVER (PARTITION BY yr ORDER BY revenue, cik ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY yr) AS DOUBLE), 6) AS position FROM company_years",
    "e9_weighted_percentiles": """SELECT yr, min(net_income) FILTER (WHERE p >= 0.25) AS p25, min(net_income) FILTER (WHERE p >= 0.5) AS p50, min(net_income) FILTER (WHERE p >= 0.75) AS p75 FROM (
 SELECT yr, net_income, CAST(sum(revenue) OVER (PARTITION BY yr ORDER BY net_income, cik ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY yr) AS DOUBLE) AS p FROM company_years) GROUP BY yr""",
    "e10_weight_groups": """SELECT cik, yr, CAST(least(floor(5 * CAST(sum(revenue) OVER (PARTITION BY yr ORDER BY net_income, cik ROWS UNBOUNDED PRECEDING) - revenue AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY yr) AS DOUBLE)), 4) AS INTEGER) AS weight_group FROM company_years""",
    "e12_rollup_levels": """SELECT r_name, n_name, c_mktsegment AS seg, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total, count(*) AS members, arg_max(c_name, row(c_acctbal, c_name)) AS top_member
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY GROUPING SETS ((r_name), (r_name, n_name), (r_name, n_name, c_mktsegment), ())""",
    "e14_seeded_sample": """SELECT ticker, obs_date FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY md5('run7|' || ticker || '|' || CAST(obs_date AS VARCHAR)), obs_date) AS n, max(obs_date) OVER (PARTITION BY ticker) AS last FROM prices) WHERE n <= 10 OR obs_date = last""",
    "e15_increments": "SELECT ticker, obs_date, CAST(CAST(close AS DECIMAL(14,2)) AS DECIMAL(22,2)) AS increment FROM prices",
}
ORACLES = {k: with_fixtures(v) for k, v in ORACLES.items()}
