"""Views over the driver's tables that stand for the platform's own inputs (FIXTURES.md).

Each view is written once, in SQL that Spark and DuckDB read alike, so a query and its oracle start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "obs_raw": """
SELECT 'ev:' || event_type || ':' || CAST(user_id % 20 AS VARCHAR(10)) AS series_id,
 CAST(ts AS DATE) AS obs_date,
 CASE WHEN event_id % 37 = 0 THEN NULL ELSE value END AS value,
 CASE WHEN user_id % 2 = 0 THEN 'USD' ELSE 'Index' END AS units,
 CAST(CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) AS DATE) AS vintage,
 'r' || CAST(event_id % 3 AS VARCHAR(10)) AS run_id
 FROM events""",
    "obs": """
SELECT series_id, obs_date, vintage, vintage AS available_date, max(value) AS value, min(units) AS units, min(run_id) AS run_id
 FROM obs_raw GROUP BY series_id, obs_date, vintage""",
    "series_catalog": """
SELECT series_id, split_part(series_id, ':', 2) AS source, 'D' AS frequency, min(obs_date) AS active_from,
 CASE WHEN split_part(series_id, ':', 3) = '7' THEN DATE '2024-01-15' END AS active_to, 2 AS expected_lag_days
 FROM obs GROUP BY series_id""",
    "sessions": """
SELECT d AS session FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x WHERE d NOT IN (DATE '1998-01-01', DATE '1999-07-05')""",
    "prices": """
SELECT substr(o_orderpriority, 3) AS ticker, CAST(o_orderdate AS DATE) AS obs_date, max(o_totalprice) AS close
 FROM orders GROUP BY substr(o_orderpriority, 3), CAST(o_orderdate AS DATE)""",
    "ref_prices": """
SELECT ticker, obs_date, close * (CASE WHEN day(obs_date) = 13 THEN 1.01 ELSE 1.0 END) AS close,
 CAST(CASE WHEN month(obs_date) = 6 AND day(obs_date) = 1 THEN 2.0 ELSE 1.0 END AS DOUBLE) AS split_factor,
 CAST(CASE WHEN day(obs_date) = 20 THEN 5.0 ELSE 0.0 END AS DOUBLE) AS div_cash FROM prices WHERE day(obs_date) <> 28""",
    "facts": """
SELECT l_suppkey AS cik, l_returnflag || l_linestatus AS concept, l_orderkey AS accession,
 CAST(l_shipdate AS DATE) AS end_date, CAST(CAST(l_shipdate AS DATE) + CAST(l_orderkey % 90 AS INTEGER) AS DATE) AS filed,
 CASE WHEN l_linenumber = 7 THEN '10-K/A' ELSE '10-K' END AS form, l_extendedprice AS val,
 CAST(CAST(l_shipdate AS DATE) - CAST(340 + l_orderkey % 60 AS INTEGER) AS DATE) AS start_date FROM lineitem""",
    "company_years": """
SELECT l_suppkey AS cik, CAST(year(l_shipdate) AS INTEGER) AS yr, s_name AS name, s_nationkey AS sic,
 CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue,
 CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(CASE WHEN l_discount > 0.05 THEN -l_discount ELSE l_discount END AS DECIMAL(4,2))) AS DECIMAL(28,4)) AS net_income
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, year(l_shipdate), s_name, s_nationkey""",
    "landings": """
SELECT o_orderkey AS id, o_custkey AS cik, o_orderstatus AS form,
 CASE WHEN r.n = 2 AND o_orderkey % 5 = 0 THEN o_totalprice + 1 WHEN r.n = 3 AND o_orderkey % 10 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS val,
 'r' || CAST(r.n AS VARCHAR(10)) AS run_id, CAST(year(o_orderdate) AS VARCHAR(10)) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR(10)) AS quarter
 FROM orders CROSS JOIN (SELECT 1 AS n UNION ALL SELECT 2 UNION ALL SELECT 3) r
 WHERE NOT (r.n = 3 AND o_orderkey % 7 = 0) AND NOT (r.n = 1 AND o_orderkey % 11 = 0)""",
    "edges": """
SELECT s_suppkey AS o, CAST(floor(s_suppkey / 3) AS BIGINT) AS a FROM supplier WHERE s_suppkey > 0""",
    "loads": """
SELECT 'r' || CAST(event_id % 30 AS VARCHAR(10)) AS run_id, event_type AS dataset, count(*) AS rows_downloaded,
 count(*) - CASE WHEN event_type = 'error' AND event_id % 30 = 7 THEN 1 ELSE 0 END AS rows_written, max(ts) AS loaded_at
 FROM events GROUP BY event_id % 30, event_type""",
    "raw_macro": """
SELECT event_type || CAST(user_id % 20 AS VARCHAR(10)) AS fred_id, CAST(ts AS DATE) AS obs_date, CAST(CAST(ts AS DATE) + CAST(event_id % 4 AS INTEGER) AS DATE) AS realtime_start,
 CASE WHEN event_id % 37 = 0 THEN '.' ELSE CAST(event_id % 1000 AS VARCHAR(10)) END AS value, 'r' || CAST(event_id % 3 AS VARCHAR(10)) AS run_id FROM events""",
    "raw_macro_series": """
SELECT fred_id, CASE WHEN w.n = 1 THEN DATE '2000-01-01' ELSE DATE '2024-01-10' END AS realtime_start, CASE WHEN w.n = 1 THEN DATE '2024-01-09' ELSE DATE '9999-12-31' END AS realtime_end,
 w.units AS units, fred_id || ' title' AS title, 'D' AS frequency_short, 'NSA' AS seasonal_adjustment_short, '2000-01-01' AS observation_start, w.run_id AS run_id
 FROM (SELECT DISTINCT fred_id FROM raw_macro) x
 CROSS JOIN (SELECT 1 AS n, 'r1' AS run_id, '2012 dollars' AS units UNION ALL SELECT 2, 'r1', '2017 dollars' UNION ALL SELECT 2, 'r0', '2012 dollars') w""",
    "raw_bars": """
SELECT substr(o_orderpriority, 3) AS ticker, CAST(o_orderdate AS DATE) AS obs_date, max(o_totalprice) AS close, CAST(date_trunc('month', o_orderdate) AS DATE) AS pull_end,
 CASE WHEN month(o_orderdate) % 4 = 1 THEN 'rebase' ELSE 'incremental' END AS pull_reason
 FROM orders GROUP BY substr(o_orderpriority, 3), CAST(o_orderdate AS DATE), CAST(date_trunc('month', o_orderdate) AS DATE), CASE WHEN month(o_orderdate) % 4 = 1 THEN 'rebase' ELSE 'incremental' END""",
    "raw_index": """
SELECT o_custkey AS cik, 'Company ' || CAST(o_custkey AS VARCHAR(10)) AS company_name, o_orderstatus AS form_type, CAST(o_orderdate AS DATE) AS date_filed,
 'edgar/data/' || CAST(o_custkey AS VARCHAR(10)) || '/' || lpad(CAST(o_orderkey AS VARCHAR(10)), 10, '0') || '-97-000001.txt' AS filename,
 CAST(year(o_orderdate) AS VARCHAR(10)) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR(10)) AS quarter FROM orders""",
    "raw_facts": """
SELECT l_suppkey AS cik, 'us-gaap' AS taxonomy, l_returnflag || l_linestatus AS concept, 'USD' AS unit, CAST(NULL AS VARCHAR(10)) AS start_text, CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS end_text,
 CAST(l_partkey AS VARCHAR(10)) AS val, CAST(l_orderkey AS VARCHAR(10)) AS accn, l_linenumber AS fy, 'FY' AS fp, '10-K' AS form,
 CAST(CAST(CAST(l_shipdate AS DATE) + CAST(l_orderkey % 90 AS INTEGER) AS DATE) AS VARCHAR(10)) AS filed, CAST(NULL AS VARCHAR(10)) AS frame FROM lineitem""",
    "raw_years": """
SELECT year(o_orderdate) AS fy, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o, count(*) FILTER (WHERE o_orderstatus = 'P') AS p,
 CAST(max(o_orderdate) AS DATE) AS retrieved FROM orders GROUP BY year(o_orderdate)""",
    "fiscal_quarters": """
SELECT cik, fy, fq, CAST(make_date(CAST(floor(mi / 12) AS INTEGER), CAST(mi % 12 + 1 AS INTEGER), 1) - off AS DATE) AS start_date,
 CAST(make_date(CAST(floor((mi + 3) / 12) AS INTEGER), CAST((mi + 3) % 12 + 1 AS INTEGER), 1) - 1 - off AS DATE) AS end_date, v, c
 FROM (SELECT *, CAST(floor((mi - shift) / 12) AS INTEGER) AS fy, CAST(floor(((mi - shift) % 12) / 3) AS INTEGER) + 1 AS fq FROM (
 SELECT l_suppkey AS cik, CAST(year(l_shipdate) * 12 + quarter(l_shipdate) * 3 - 3 AS INTEGER) AS mi, CAST(l_suppkey % 4 * 3 AS INTEGER) AS shift, CAST(l_suppkey % 3 AS INTEGER) AS off,
 sum(CAST(l_quantity AS DECIMAL(14,2))) AS v, sum(CAST(l_linenumber AS DECIMAL(14,2))) AS c FROM lineitem GROUP BY 1, 2, 3, 4) x) y""",
    "fiscal_spans": """
SELECT a.cik, a.fy, k.k, min(a.start_date) AS start_date, max(a.end_date) AS end_date, sum(a.v) AS v, sum(a.c) AS c
 FROM fiscal_quarters a JOIN (SELECT 2 AS k UNION ALL SELECT 3 UNION ALL SELECT 4) k ON a.fq <= k.k GROUP BY a.cik, a.fy, k.k HAVING count(*) = k.k""",
    "tags": """
SELECT cik, concept, accession, form, start_date, end_date, filed, CAST(val AS DOUBLE) AS val, frame FROM (
 SELECT cik, 'Revenues' AS concept, cik * 100000 + fy * 10 + fq AS accession, CASE WHEN fq = 4 THEN '10-K' ELSE '10-Q' END AS form, start_date, end_date, CAST(end_date + 40 AS DATE) AS filed,
  CASE WHEN fq = 4 AND cik % 10 = 0 THEN v + 7 ELSE v END AS val, 'CY' || CAST(year(CAST(end_date - 45 AS DATE)) AS VARCHAR(4)) || 'Q' || CAST(quarter(CAST(end_date - 45 AS DATE)) AS VARCHAR(4)) AS frame FROM fiscal_quarters WHERE (fq < 4 OR cik % 5 = 0) AND NOT (fq = 2 AND cik % 11 = 0)
 UNION ALL SELECT cik, 'Sales', cik * 100000 + fy * 10 + fq, '10-Q', start_date, end_date, CAST(end_date + 40 AS DATE), v * (1 + cik % 2) / 2 + fq - 2, 'CY' || CAST(year(CAST(end_date - 45 AS DATE)) AS VARCHAR(4)) || 'Q' || CAST(quarter(CAST(end_date - 45 AS DATE)) AS VARCHAR(4)) FROM fiscal_quarters WHERE fq < 4 AND fy % 2 = 0
 UNION ALL SELECT cik, 'Revenues', cik * 100000 + fy * 10 + k, '10-Q', start_date, end_date, CAST(end_date + 40 AS DATE), CASE WHEN k = 3 AND cik % 7 = 0 THEN v + 10 ELSE v END, NULL FROM fiscal_spans WHERE k < 4
 UNION ALL SELECT cik, 'Revenues', cik * 100000 + fy * 10 + 4, '10-K', start_date, end_date, CAST(end_date + 40 AS DATE), v, 'CY' || CAST(year(CAST(end_date - 182 AS DATE)) AS VARCHAR(4)) FROM fiscal_spans WHERE k = 4
 UNION ALL SELECT a.cik, 'Revenues', a.cik * 100000 + b.fy * 10 + 4, '10-K', a.start_date, a.end_date, CAST(b.end_date + 40 AS DATE), CASE WHEN a.cik % 6 = 0 THEN a.v * 2 ELSE a.v END, NULL FROM fiscal_spans a JOIN fiscal_spans b ON a.cik = b.cik AND a.k = 4 AND b.k = 4 AND b.fy = a.fy + 1
 UNION ALL SELECT cik, m.concept, cik * 100000 + fy * 10 + 4, '10-K', start_date, end_date, CAST(end_date + 40 AS DATE), v * m.a + c * m.b + m.d, NULL FROM fiscal_spans JOIN (
  SELECT 'CostOfRevenue' AS concept, 0 AS a, 2 AS b, 1 AS d UNION ALL SELECT 'CostOfGoods', 0, 3, 0 UNION ALL SELECT 'OperatingIncome', 1, -2, -60 UNION ALL SELECT 'NetIncome', 1, -3, -90 UNION ALL SELECT 'Capex', 0, 1, 0 UNION ALL SELECT 'Depreciation', 0, 0, 5 UNION ALL SELECT 'DepreciationAndAmortization', 0, 1, 2) m
  ON k = 4 AND NOT (m.concept = 'CostOfRevenue' AND cik % 2 = 0) AND NOT (m.concept = 'Capex' AND cik % 9 = 0)
 UNION ALL SELECT x.cik, m.concept, x.cik * 100000 + x.of_fy * 10 + 4, '10-K', NULL, x.end_date, CAST(x.of_end + 40 AS DATE), x.v * m.a + x.c * m.b + m.d, NULL FROM (
  SELECT cik, fy AS of_fy, end_date, end_date AS of_end, v, c FROM fiscal_spans WHERE k = 4 UNION ALL
  SELECT a.cik, b.fy, a.end_date, b.end_date, a.v, a.c FROM fiscal_spans a JOIN fiscal_spans b ON a.cik = b.cik AND a.k = 4 AND b.k = 4 AND b.fy = a.fy + 1) x JOIN (
  SELECT 'Assets' AS concept, 2 AS a, 1 AS b, 0 AS d UNION ALL SELECT 'Equity', 1, -4, -400 UNION ALL SELECT 'Receivables', 0, 2, 3 UNION ALL SELECT 'Inventory', 0, 1, 9 UNION ALL SELECT 'Payables', 0, 1, 4 UNION ALL SELECT 'PPE', 1, 1, 1 UNION ALL SELECT 'CurrentAssets', 1, 0, 8
  UNION ALL SELECT 'CurrentLiabilities', 0, 3, -60) m ON NOT (m.concept = 'Inventory' AND x.cik % 8 = 0)) z""",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Words that follow a table without an alias of its own.
AFTER_TABLE = set("WHERE GROUP ORDER LIMIT JOIN LEFT RIGHT FULL CROSS INNER ON UNION EXCEPT HAVING LATERAL PIVOT UNPIVOT QUALIFY WINDOW".split())


def _needs(sql: str, views: dict[str, str]) -> list[str]:
    """Fixture views that the SQL names, each after those that it needs itself."""
    found: list[str] = []
    for name, body in views.items():
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql, re.I):
            found += [x for x in [*_needs(body, views), name] if x not in found]
    return found


def with_fixtures(sql: str, stored: dict[str, str] | None = None) -> str:
    """SQL over fixture views as SQL over the driver's tables alone: the views come first, as common table expressions. Those in `stored` (name: folder) are read from there instead of derived."""
    views = VIEWS | {x: f"SELECT * FROM parquet.`{path}`" for x, path in (stored or {}).items()}
    names = _needs(sql, views)
    if not names:
        return sql
    ctes = ",\n".join(f"{x} AS ({views[x].strip()})" for x in names)
    m = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql, re.I)
    return f"WITH {m[1] or ''}{ctes},\n{sql[m.end():]}" if m else f"WITH {ctes}\n{sql}"


def table(spark: SparkSession, sf_dir: str, name: str, stored: dict[str, str] | None = None) -> DataFrame:
    """A driver table or a fixture view over the driver's tables, as a lazy DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return sql(spark, sf_dir, f"SELECT * FROM {name}", stored)


def sql(spark: SparkSession, sf_dir: str, text: str, stored: dict[str, str] | None = None) -> DataFrame:
    """Run SQL over driver tables and fixture views, without temporary views in the session's catalog. Views in `stored` (name: folder) are read, not derived."""
    text = with_fixtures(text, stored)
    used = {t for t in TABLES if re.search(rf"\b(FROM|JOIN)\s+{t}\b", text, re.I)}
    for t in used:
        named = lambda m, t=t: f"{m[1]} parquet.`{sf_dir}/{t}.parquet`" + ("" if m[2] and m[2].upper() not in AFTER_TABLE else f" AS {t}")
        text = re.sub(rf"\b(FROM|JOIN)\s+{t}\b(?=(?:\s+(\w+))?)", named, text, flags=re.I)
    return spark.sql(text)
