"""Aggregations (D), top-k (F) and set operations (G) through palimpsest.functions, scalar function families (H) as Spark SQL.

A value of SQL is DuckDB's text for the same rows; for scalar functions, which are Spark's own, it may be a pair of Spark's and DuckDB's.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.functions import aggregates as A
from palimpsest.plans.fixtures import sql, table, with_fixtures

SQL: dict[str, str | tuple[str, str]] = {
    "d1_arg_max_composite": "SELECT cik, concept, arg_max(val, row(filed, accession, val)) AS latest, arg_min(val, row(filed, accession, val)) FILTER (WHERE form = '10-K') AS first_10k FROM facts GROUP BY cik, concept",
    "d2_filtered_aggregates": "SELECT series_id, count(*) FILTER (WHERE value IS NULL) AS withdrawn, max(value) FILTER (WHERE units = 'USD') AS top_usd, min(vintage) FILTER (WHERE value > 100) AS first_large FROM obs GROUP BY series_id",
    "d3_any_bool_count": "SELECT series_id, bool_or(value > 490) AS any_large, bool_and(value IS NOT NULL) AS all_known, count(*) AS n, count(value) AS n_known FROM obs GROUP BY series_id",
    "d4_duplicate_count": "SELECT count(*) - count(DISTINCT row(series_id, obs_date, vintage)) AS duplicates FROM obs_raw",
    "d5_approx_distinct": "SELECT series_id, count(DISTINCT obs_date) AS exact, TRUE AS close_enough FROM obs GROUP BY series_id",
    "d6_quantiles": "SELECT cik, median(val) AS med, quantile_cont(val, 0.1) AS p10, quantile_cont(val, 0.9) AS p90 FROM facts GROUP BY cik",
    "d7_mode_by_count_then_value": "SELECT cik, concept AS top_concept FROM (SELECT cik, concept, row_number() OVER (PARTITION BY cik ORDER BY count(*) DESC, concept) AS n FROM facts GROUP BY cik, concept) x WHERE n = 1",
    "d8_series_fit": "SELECT a.ticker, round(corr(a.close, b.close), 6) AS fit, count(*) AS n, any_value(l.fit) AS fit_lag7, any_value(l.n) AS n_lag7 FROM prices a JOIN ref_prices b ON a.ticker = b.ticker AND a.obs_date = b.obs_date JOIN (SELECT p.ticker, round(corr(p.close, r.close), 6) AS fit, count(*) AS n FROM prices p JOIN ref_prices r ON p.ticker = r.ticker AND p.obs_date = r.obs_date + 7 GROUP BY p.ticker) l ON l.ticker = a.ticker GROUP BY a.ticker",
    "d9_group_having": "SELECT series_id, obs_date, count(DISTINCT vintage) AS vintages FROM obs GROUP BY ALL HAVING count(DISTINCT vintage) > 2",
    "d10_ordered_list": "SELECT dataset, string_agg(DISTINCT run_id, ',' ORDER BY run_id) AS runs FROM loads GROUP BY dataset",
    "d11_weighted_share": "SELECT yr, round(CAST(sum(CASE WHEN net_income < 0 THEN revenue ELSE 0 END) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 6) AS losing_share FROM company_years GROUP BY yr",
    "d12_histogram": "SELECT CAST(floor(log10(val) * 5) AS BIGINT) AS bin, count(*) AS n FROM facts WHERE val > 0 GROUP BY 1",
    "d13_bucketize": "SELECT CASE WHEN revenue < 100000 THEN 'small' WHEN revenue < 1000000 THEN 'middle' WHEN revenue < 3000000 THEN 'large' ELSE 'giant' END AS size_class, count(*) AS n FROM company_years GROUP BY 1",
    "d14_cagr": "SELECT cik, round(exp(ln(CAST(max(CASE WHEN yr = 1999 THEN revenue END) AS DOUBLE) / CAST(max(CASE WHEN yr = 1996 THEN revenue END) AS DOUBLE)) / 3) - 1, 6) AS cagr FROM company_years GROUP BY cik HAVING max(CASE WHEN yr = 1999 THEN 1 END) = 1 AND max(CASE WHEN yr = 1996 THEN 1 END) = 1",
    "d15_resample_complete": "SELECT ticker, CAST(date_trunc('quarter', m) AS DATE) AS q, count(*) AS months, CAST(sum(total) AS DECIMAL(28,2)) AS total FROM (SELECT ticker, CAST(date_trunc('month', obs_date) AS DATE) AS m, sum(CAST(close AS DECIMAL(14,2))) AS total FROM prices GROUP BY 1, 2) x GROUP BY 1, 2 HAVING count(*) = 3",
    "d16_resample_last_in": "SELECT ticker, year(obs_date) AS y, CAST(sum(CAST(close AS DECIMAL(14,2))) AS DECIMAL(28,2)) AS total FROM prices GROUP BY ticker, year(obs_date) HAVING max(month(obs_date)) = 12",
    "d17_profile": "WITH v AS (SELECT 'series_id' AS col, series_id AS v FROM obs UNION ALL SELECT 'obs_date', CAST(obs_date AS VARCHAR) FROM obs UNION ALL SELECT 'units', units FROM obs UNION ALL SELECT 'run_id', run_id FROM obs), c AS (SELECT col, v, count(*) AS n FROM v WHERE v IS NOT NULL GROUP BY col, v), r AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, v) AS rk FROM c) SELECT col, CAST(sum(n) AS BIGINT) AS filled, count(*) AS n_distinct, min(v) AS lo, max(v) AS hi, string_agg(v || ' (' || n || ')', ', ' ORDER BY rk) FILTER (WHERE rk <= 3) AS top FROM r GROUP BY col",
    "d18_pivot_wide": "SELECT cik, year(end_date) AS yr, max(val) FILTER (WHERE concept = 'AF') AS af, max(val) FILTER (WHERE concept = 'NF') AS nf, max(val) FILTER (WHERE concept = 'NO') AS no, max(val) FILTER (WHERE concept = 'RF') AS rf FROM facts GROUP BY 1, 2",
    "d19_unpivot_years": "SELECT cik, yr AS year, CAST(revenue AS VARCHAR) AS raw, CAST(revenue AS DOUBLE) AS value FROM company_years WHERE yr IN (1995, 1996)",
    "d20_distinct": "SELECT DISTINCT cik, concept, form FROM facts",
    "f1_top_k": "SELECT cik, concept, accession, end_date, val FROM facts ORDER BY val DESC NULLS LAST, accession, cik, concept, end_date LIMIT 50",
    "f2_top_share": "SELECT yr, round(CAST(sum(CASE WHEN rk <= 10 THEN revenue ELSE 0 END) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 6) AS top10, round(CAST(sum(CASE WHEN rk <= 50 THEN revenue ELSE 0 END) AS DOUBLE) / CAST(sum(revenue) AS DOUBLE), 6) AS top50 FROM (SELECT *, row_number() OVER (PARTITION BY yr ORDER BY revenue DESC, cik) AS rk FROM company_years) x GROUP BY yr",
    "f3_top_n_other": "SELECT coalesce(t.sic, -1) AS sic, count(*) AS n FROM company_years c LEFT JOIN (SELECT sic FROM company_years GROUP BY sic ORDER BY count(*) DESC, sic LIMIT 5) t ON c.sic = t.sic GROUP BY coalesce(t.sic, -1)",
    "f4_head_tail": "SELECT cik, yr, revenue FROM (SELECT *, row_number() OVER (ORDER BY revenue DESC, cik, yr) AS a, row_number() OVER (ORDER BY revenue, cik, yr) AS b FROM company_years) x WHERE a <= 5 OR b <= 5",
    "f5_examples": "SELECT cik, concept, accession, end_date, filed, val FROM facts WHERE val > 90000 ORDER BY filed DESC, accession, cik, concept, val LIMIT 20",
    "g1_union_by_name": "SELECT o_orderkey AS k, o_custkey AS c, NULL AS line FROM orders UNION ALL BY NAME SELECT l_linenumber AS line, l_suppkey AS c, l_orderkey AS k FROM lineitem",
    "g2_key_union": "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey AS k FROM supplier",
    "g3_table_diff": "SELECT 'only_a' AS side, a.* FROM (SELECT id, val FROM landings WHERE run_id = 'r1' EXCEPT ALL SELECT id, val FROM landings WHERE run_id = 'r2') a UNION ALL SELECT 'only_b' AS side, b.* FROM (SELECT id, val FROM landings WHERE run_id = 'r2' EXCEPT ALL SELECT id, val FROM landings WHERE run_id = 'r1') b",
    "g4_unknown_keys": "SELECT DISTINCT form FROM landings EXCEPT SELECT * FROM (VALUES ('O'), ('F')) known(form)",
    "h1_string": "SELECT s_suppkey, split_part(s_name, '#', 2) AS num, upper(substr(s_name, 1, 3)) AS head, lpad(CAST(s_nationkey AS VARCHAR(3)), 3, '0') AS nat, replace(trim(s_name), '#', '-') AS dashed, right(s_name, 4) AS tail, s_name LIKE '%#0000000%1' AS ends FROM supplier",
    "h2_regex": ("SELECT doc_id, regexp_extract(text, '([0-9]+)[.]([0-9]+)', 1) AS num, text RLIKE 'https?://' AS url, regexp_replace(text, '[aeiou]+', '*') AS masked FROM documents", "SELECT doc_id, regexp_extract(text, '([0-9]+)[.]([0-9]+)', 1) AS num, regexp_matches(text, 'https?://') AS url, regexp_replace(text, '[aeiou]+', '*', 'g') AS masked FROM documents"),
    "h3_date": ("SELECT o_orderkey, make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1) AS q, dayofweek(o_orderdate) - 1 AS dow, (year(o_orderdate) * 12 + month(o_orderdate)) - 24000 AS m, CAST(date_trunc('week', o_orderdate) AS DATE) AS wk, try_to_date(o_orderpriority, 'M/d/yyyy') AS bad FROM orders", "SELECT o_orderkey, make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1) AS q, dayofweek(o_orderdate) AS dow, (year(o_orderdate) * 12 + month(o_orderdate)) - 24000 AS m, CAST(date_trunc('week', o_orderdate) AS DATE) AS wk, CAST(try_strptime(o_orderpriority, '%m/%d/%Y') AS DATE) AS bad FROM orders"),
    "h4_mmwr_week": ("SELECT y, w, date_add(date_sub(make_date(y, 1, 4), dayofweek(make_date(y, 1, 4)) - 1), 7 * (w - 1)) AS starts FROM (SELECT DISTINCT year(o_orderdate) AS y, CAST(o_orderkey % 52 AS INT) + 1 AS w FROM orders) x", "SELECT y, w, CAST(make_date(y, 1, 4) - CAST(dayofweek(make_date(y, 1, 4)) AS INTEGER) + CAST(7 * (w - 1) AS INTEGER) AS DATE) AS starts FROM (SELECT DISTINCT year(o_orderdate) AS y, CAST(o_orderkey % 52 AS INT) + 1 AS w FROM orders) x"),
    "h5_math": ("SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) AS l, CAST(floor(l_quantity / 7) AS BIGINT) AS f, greatest(l_tax, l_discount, NULL) AS g, l_orderkey div 7 AS d, round(power(l_discount, 2), 8) AS p, try_divide(l_extendedprice, l_tax * 0) AS z FROM lineitem", "SELECT l_orderkey, l_linenumber, round(ln(l_extendedprice), 6) AS l, CAST(floor(l_quantity / 7) AS BIGINT) AS f, greatest(l_tax, l_discount, NULL) AS g, l_orderkey // 7 AS d, round(power(l_discount, 2), 8) AS p, l_extendedprice / nullif(l_tax * 0, 0) AS z FROM lineitem"),
    "h6_nulls": "SELECT series_id, obs_date, vintage, coalesce(value, -1) AS v, nullif(units, 'USD') AS u, value IS DISTINCT FROM 5 AS d, TRY_CAST(series_id AS INTEGER) AS bad FROM obs",
    "h7_array": ("SELECT doc_id, size(w) AS n, array_contains(w, 'the') AS has, array_join(slice(w, 1, 3), '-') AS head, arrays_overlap(w, array('of', 'de')) AS any_of, size(filter(w, x -> length(x) > 8)) AS long_words, element_at(w, 1) AS first_word FROM (SELECT doc_id, split(text, ' ') AS w FROM documents) x", "SELECT doc_id, len(w) AS n, list_contains(w, 'the') AS has, array_to_string(w[1:3], '-') AS head, list_has_any(w, ['of', 'de']) AS any_of, len([x FOR x IN w IF length(x) > 8]) AS long_words, w[1] AS first_word FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents) x"),
    "h8_json": ("SELECT event_id, get_json_object(concat('{\"a\":{\"b\":', CAST(user_id AS STRING), '}}'), '$.a.b') AS b, x.k AS k FROM events LATERAL VIEW inline(from_json(concat('[{\"k\":', CAST(event_id % 9 AS STRING), '},{\"k\":7}]'), 'array<struct<k:int>>')) x AS k", "SELECT event_id, json_extract_string('{\"a\":{\"b\":' || CAST(user_id AS VARCHAR) || '}}', '$.a.b') AS b, CAST(unnest([event_id % 9, 7]) AS INTEGER) AS k FROM events"),
    "h9_generators": ("SELECT o_orderkey, m FROM (SELECT o_orderkey, explode(sequence(CAST(date_trunc('month', o_orderdate) AS DATE), CAST(date_trunc('month', o_orderdate) + INTERVAL 3 MONTH AS DATE), INTERVAL 1 MONTH)) AS m FROM orders) x", "SELECT o_orderkey, CAST(unnest(generate_series(date_trunc('month', o_orderdate), date_trunc('month', o_orderdate) + INTERVAL 3 MONTH, INTERVAL 1 MONTH)) AS DATE) AS m FROM orders"),
    "h10_error_raising": ("SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O', 'P') THEN o_orderstatus ELSE CAST(raise_error('unknown status') AS STRING) END AS status FROM orders", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O', 'P') THEN o_orderstatus ELSE error('unknown status') END AS status FROM orders"),
}


def d1_arg_max_composite(spark, d):
    by = ["filed", "accession", "val"]
    return table(spark, d, "facts").groupBy("cik", "concept").agg(A.arg_max("val", by).alias("latest"), A.arg_min("val", by, "form = '10-K'").alias("first_10k"))


def d2_filtered_aggregates(spark, d):
    return A.agg_where(table(spark, d, "obs"), ["series_id"], withdrawn=("count", "*", "value IS NULL"), top_usd=("max", "value", "units = 'USD'"), first_large=("min", "vintage", "value > 100"))


def d3_any_bool_count(spark, d):
    return A.agg_bool(table(spark, d, "obs"), ["series_id"], {"any_large": "value > 490"}, {"all_known": "value IS NOT NULL"}, {"n_known": "value"})


def d4_duplicate_count(spark, d):
    return A.duplicate_count(table(spark, d, "obs_raw"), ["series_id", "obs_date", "vintage"])


def d5_approx_distinct(spark, d):
    obs = table(spark, d, "obs")
    both = A.approx_distinct(obs, ["series_id"], ["obs_date"], 0.02).join(obs.groupBy("series_id").agg(F.count_distinct("obs_date").alias("exact")), "series_id")
    return both.select("series_id", "exact", (F.abs(F.col("approx_obs_date") - F.col("exact")) <= 0.06 * F.col("exact")).alias("close_enough"))


def d6_quantiles(spark, d):
    return A.quantiles(table(spark, d, "facts"), "val", {"med": 0.5, "p10": 0.1, "p90": 0.9}, ["cik"])


def d7_mode_by_count_then_value(spark, d):
    return A.mode_of(table(spark, d, "facts"), "concept", ["cik"], "top_concept")


def d8_series_fit(spark, d):
    a, b = table(spark, d, "prices"), table(spark, d, "ref_prices")
    now, late = (A.series_fit(a, b, ["ticker"], "obs_date", "close", lag).withColumn("fit", F.round("fit", 6)) for lag in (0, 7))
    return now.join(late.withColumnsRenamed({"fit": "fit_lag7", "n": "n_lag7"}), "ticker")


def d9_group_having(spark, d):
    return A.group_having(table(spark, d, "obs"), ["series_id", "obs_date"], {"vintages": F.count_distinct("vintage")}, "vintages > 2")


def d10_ordered_list(spark, d):
    return A.ordered_list(table(spark, d, "loads"), ["dataset"], "run_id", "runs")


def d11_weighted_share(spark, d):
    return A.weighted_share(table(spark, d, "company_years"), "revenue", {"losing_share": "net_income < 0"}, ["yr"]).withColumn("losing_share", F.round("losing_share", 6))


def d12_histogram(spark, d):
    return A.histogram(table(spark, d, "facts").filter("val > 0"), "log10(val)", 5)


def d13_bucketize(spark, d):
    return A.bucketize(table(spark, d, "company_years"), "revenue", [(100_000, "small"), (1_000_000, "middle"), (3_000_000, "large")], "giant", "size_class")


def d14_cagr(spark, d):
    return A.cagr(table(spark, d, "company_years"), ["cik"], "yr", "revenue", 1996, 1999).withColumn("cagr", F.round("cagr", 6))


def d15_resample_complete(spark, d):
    prices = table(spark, d, "prices").withColumn("close", F.col("close").cast("decimal(14,2)"))
    return A.resample(prices, ["ticker"], "obs_date", "close").select("ticker", F.col("period").alias("q"), F.col("parts").alias("months"), F.col("value").cast("decimal(28,2)").alias("total"))


def d16_resample_last_in(spark, d):
    prices = table(spark, d, "prices").withColumn("close", F.col("close").cast("decimal(14,2)"))
    return A.resample_last_in(prices, ["ticker"], "obs_date", "close").withColumn("total", F.col("total").cast("decimal(28,2)"))


def d17_profile(spark, d):
    return A.profile(table(spark, d, "obs"), ["series_id", "obs_date", "units", "run_id"])


def d18_pivot_wide(spark, d):
    return A.pivot_wide(table(spark, d, "facts").withColumn("yr", F.year("end_date")), ["cik", "yr"], "concept", "val", {"AF": "af", "NF": "nf", "NO": "no", "RF": "rf"})


def d19_unpivot_years(spark, d):
    wide = A.pivot_wide(table(spark, d, "company_years"), ["cik"], "yr", "revenue", {1995: "y1995", 1996: "y1996"})
    return A.unpivot_years(wide, ["cik"], "y[0-9]{4}")


def d20_distinct(spark, d):
    return table(spark, d, "facts").select("cik", "concept", "form").distinct()


def f1_top_k(spark, d):
    order = [F.desc_nulls_last("val"), "accession", "cik", "concept", "end_date"]
    return A.top_k(table(spark, d, "facts").select("cik", "concept", "accession", "end_date", "val"), order, 50)


def f2_top_share(spark, d):
    out = A.top_share(table(spark, d, "company_years"), ["yr"], "revenue", ["cik"], [10, 50])
    return out.select("yr", F.round("top10", 6).alias("top10"), F.round("top50", 6).alias("top50"))


def f3_top_n_other(spark, d):
    return A.top_n_other(table(spark, d, "company_years"), "sic", 5, F.lit(-1))


def f4_head_tail(spark, d):
    return A.head_tail(table(spark, d, "company_years").select("cik", "yr", "revenue"), ["cik", "yr"], "revenue", 5, 5)


def f5_examples(spark, d):
    return A.examples(table(spark, d, "facts").select("cik", "concept", "accession", "end_date", "filed", "val"), "val > 90000", [F.desc("filed"), "accession", "cik", "concept", "val"], 20)


def g1_union_by_name(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"))
    return A.union_by_name(orders, table(spark, d, "lineitem").select(F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("c"), F.col("l_orderkey").alias("k")))


def g2_key_union(spark, d):
    return A.key_union(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


def g3_table_diff(spark, d):
    rows = table(spark, d, "landings")
    return A.table_diff(*(rows.filter(F.col("run_id") == r).select("id", "val") for r in ("r1", "r2")))


def g4_unknown_keys(spark, d):
    return A.unknown_keys(table(spark, d, "landings"), "form", spark.createDataFrame([("O",), ("F",)], "form string"))


def _scalar(text):
    return lambda spark, d: sql(spark, d, text)


QUERIES = {k: f for k, f in globals().items() if k[:1] in "dfg" and k[1:2].isdigit()}
QUERIES |= {k: _scalar(v if isinstance(v, str) else v[0]) for k, v in SQL.items() if k not in QUERIES}
ORACLES = {k: with_fixtures(v if isinstance(v, str) else v[1]) for k, v in SQL.items()}
