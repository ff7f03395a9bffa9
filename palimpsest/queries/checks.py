"""Quality checks (C), their shared inputs (J) and publication records (K): operators over the fixture views, each with DuckDB SQL of its own for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators import quality
from palimpsest.operators import checks as C
from palimpsest.plans.fixtures import sql, table, with_fixtures

QUERIES, ORACLES = {}, {}
CLOCK, TODAY = "2024-02-01 00:00:00", "2024-02-01"
LATEST = "(SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY series_id, obs_date ORDER BY vintage DESC) = 1)"
#: A catalog whose series are daily, monthly, quarterly or of a frequency that can't be counted.
CATALOG = "SELECT series_id, source, CASE WHEN split_part(series_id, ':', 3) IN ('3', '4') THEN 'M' WHEN split_part(series_id, ':', 3) = '5' THEN 'Q' WHEN split_part(series_id, ':', 3) = '6' THEN 'X' ELSE 'D' END AS frequency, active_from, active_to, CAST(split_part(series_id, ':', 3) AS INTEGER) % 4 AS expected_lag_days FROM series_catalog"
SEEN = "SELECT * FROM obs WHERE NOT (split_part(series_id, ':', 3) = '8' AND obs_date > DATE '2024-01-25') AND split_part(series_id, ':', 3) <> '9'"
DAYS = "SELECT DISTINCT obs_date AS session FROM obs WHERE dayofweek(obs_date) <> {sunday}"
MANIFEST = "(SELECT run_id, dataset, rows_downloaded, rows_written, loaded_at, CASE WHEN rows_downloaded <> rows_written THEN 'blocked' WHEN rows_downloaded % 7 = 0 THEN 'carried_forward' ELSE 'published' END AS outcome FROM loads)"
EXPECTED = f"""WITH c AS (SELECT c.*, coalesce(active_to, (SELECT max(obs_date) FROM obs o WHERE o.series_id = c.series_id)) AS stop FROM ({CATALOG}) c),
e AS (SELECT series_id, session AS obs_date FROM c JOIN ({DAYS.format(sunday=0)}) d ON session BETWEEN active_from AND stop WHERE frequency = 'D'
 UNION ALL SELECT series_id, CAST(m AS DATE) FROM c, generate_series(DATE '2023-01-01', DATE '2025-01-01', INTERVAL 1 MONTH) g(m) WHERE frequency = 'M' AND m BETWEEN active_from AND stop
 UNION ALL SELECT series_id, CAST(m AS DATE) FROM c, generate_series(DATE '2023-01-01', DATE '2025-01-01', INTERVAL 3 MONTH) g(m) WHERE frequency = 'Q' AND m BETWEEN active_from AND stop),
j1 AS (SELECT e.series_id, e.obs_date, o.series_id IS NOT NULL AS present FROM e LEFT JOIN (SELECT DISTINCT series_id, obs_date FROM obs) o ON o.series_id = e.series_id AND o.obs_date = e.obs_date)"""
BEHIND = f"""WITH c AS (SELECT c.*, (SELECT max(obs_date) FROM ({SEEN}) o WHERE o.series_id = c.series_id) AS last_date, DATE '{TODAY}' - CAST(expected_lag_days AS INTEGER) AS until FROM ({CATALOG}) c WHERE active_to IS NULL),
b AS (SELECT series_id, frequency, last_date, CASE frequency WHEN 'D' THEN (SELECT max(session) FROM ({DAYS.format(sunday=0)}) WHERE session <= until) WHEN 'M' THEN CAST(date_trunc('month', until) - INTERVAL 1 MONTH AS DATE) WHEN 'Q' THEN CAST(date_trunc('quarter', until) - INTERVAL 3 MONTH AS DATE) END AS due,
 (SELECT count(*) FROM ({DAYS.format(sunday=0)}) WHERE session <= until AND session > last_date) AS missed FROM c),
n AS (SELECT series_id, frequency, last_date, due, CASE WHEN last_date IS NULL THEN NULL WHEN frequency = 'D' THEN missed WHEN frequency = 'M' THEN greatest(date_diff('month', date_trunc('month', last_date), due), 0) WHEN frequency = 'Q' THEN greatest(CAST(floor(date_diff('month', date_trunc('month', last_date), due) / 3) AS BIGINT), 0) END AS behind FROM b)"""
RECON = """(SELECT p.ticker, p.obs_date, p.close, r.ref_close, abs(p.close - r.ref_close) / p.close AS gap FROM prices p JOIN (SELECT ticker, obs_date, close / exp(coalesce(sum(ln(f)) OVER (PARTITION BY ticker ORDER BY obs_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)) AS ref_close FROM (
 SELECT *, split_factor / coalesce(1 - CASE WHEN month(obs_date) = 3 AND day(obs_date) = 20 THEN div_cash END / lag(close) OVER (PARTITION BY ticker ORDER BY obs_date), 1) AS f FROM ref_prices)) r ON p.ticker = r.ticker AND p.obs_date = r.obs_date)"""


def query(oracle: str):
    """Registers a query of the platform with DuckDB SQL for its rows."""

    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, with_fixtures(oracle)
        return f

    return add


def manifest(spark, d):
    state = F.when(F.col("rows_downloaded") != F.col("rows_written"), "blocked").when(F.col("rows_downloaded") % 7 == 0, "carried_forward").otherwise("published")
    return table(spark, d, "loads").withColumn("outcome", state)


def newest(spark, d):
    return bitemporal_latest(table(spark, d, "obs"))


def bitemporal_latest(obs):
    """The newest vintage of each date, withdrawn values among them."""
    return obs.groupBy("series_id", "obs_date").agg(F.max(F.struct("vintage", "value")).alias("x")).select("series_id", "obs_date", "x.vintage", "x.value")


def calendar(spark, d):
    return table(spark, d, "obs").select(F.col("obs_date").alias("session")).distinct().filter(F.dayofweek("session") != 1)


def behind(spark, d):
    return C.periods_behind(sql(spark, d, CATALOG), sql(spark, d, SEEN), calendar(spark, d), TODAY)


def expected(spark, d):
    return C.expected_dates(table(spark, d, "obs"), sql(spark, d, CATALOG), calendar(spark, d))


def reviewed(spark, d):
    return table(spark, d, "ref_prices").filter("month(obs_date) = 3 AND day(obs_date) = 20").select("ticker", "obs_date", F.col("div_cash").alias("amount"))


def reconciled(spark, d):
    return C.reconcile_prices(table(spark, d, "prices"), table(spark, d, "ref_prices"), reviewed(spark, d))


@query(f"SELECT newest FROM (SELECT max(loaded_at) AS newest FROM {MANIFEST} WHERE outcome = 'published') WHERE newest IS NULL OR newest < TIMESTAMP '{CLOCK}' - INTERVAL 26 HOUR")
def c01_last_publish_age(spark, d):
    return C.last_publish_age(manifest(spark, d), CLOCK, 26)


@query(f"{BEHIND} SELECT * FROM n WHERE behind = 1")
def c02_late_series(spark, d):
    return C.late_series(behind(spark, d))


@query("""SELECT p.source, p.units FROM (SELECT DISTINCT source, unnest(['USD', 'Index', 'EUR']) AS units FROM series_catalog) p LEFT JOIN (SELECT DISTINCT split_part(series_id, ':', 2) AS source, units FROM obs) o ON o.source = p.source AND o.units = p.units
 WHERE o.source IS NULL AND NOT (p.source = 'error' AND p.units = 'EUR')""")
def c03_required_series(spark, d):
    served = table(spark, d, "obs").select(F.split_part("series_id", F.lit(":"), F.lit(2)).alias("source"), "units")
    required = C.expected_product(table(spark, d, "series_catalog").select("source"), "units", ["USD", "Index", "EUR"])
    return C.required_series(served, required, spark.createDataFrame([("error", "EUR")], "source string, units string"), ["source", "units"])


@query(f"{EXPECTED} SELECT series_id, obs_date FROM j1 WHERE NOT present")
def c04_missing_dates(spark, d):
    return C.missing_dates(expected(spark, d))


FILES = "SELECT event_type AS dataset, CAST(event_id % 30 AS INTEGER) AS run, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS hash FROM events GROUP BY 1, 2"
RECORDS = "SELECT event_type AS dataset, CAST(event_id % 30 AS INTEGER) AS run, count(*) + CASE WHEN event_type = 'error' AND event_id % 30 = 7 THEN 1 ELSE 0 END AS rows, CAST(sum(event_id) AS BIGINT) + CASE WHEN event_type = 'view' AND event_id % 30 = 3 THEN 1 ELSE 0 END AS hash FROM events WHERE NOT (event_type = 'click' AND event_id % 30 = 5) GROUP BY 1, 2, event_id % 30"


@query("SELECT dataset, run, problem FROM (SELECT DISTINCT event_type AS dataset, CAST(event_id % 30 AS INTEGER) AS run, CASE WHEN event_type = 'click' AND event_id % 30 = 5 THEN 'no_record' WHEN event_type = 'purchase' AND event_id % 30 = 11 THEN 'missing' WHEN event_type = 'error' AND event_id % 30 = 7 THEN 'count' WHEN event_type = 'view' AND event_id % 30 = 3 THEN 'hash' END AS problem FROM events) WHERE problem IS NOT NULL")
def c05_raw_reconciliation(spark, d):
    files = sql(spark, d, FILES).filter("NOT (dataset = 'purchase' AND run = 11)")
    return C.raw_reconciliation(sql(spark, d, RECORDS), files, ["dataset", "run"])


@query("SELECT run_id, dataset, rows_downloaded, rows_written FROM loads WHERE rows_downloaded IS DISTINCT FROM rows_written")
def c06_load_control_total(spark, d):
    return C.control_totals(table(spark, d, "loads"))


@query("SELECT series_id, obs_date, vintage, value, count(*) AS n FROM obs_raw GROUP BY series_id, obs_date, vintage, value HAVING count(*) > 1")
def c07_duplicate_rows(spark, d):
    return C.repeated(table(spark, d, "obs_raw"), ["series_id", "obs_date", "vintage", "value"])


@query("""SELECT coalesce(a.c, b.c) AS "column", CASE WHEN a.c IS NULL THEN 'absent' WHEN b.c IS NULL THEN 'undeclared' ELSE 'type' END AS problem FROM (
 SELECT unnest(['series_id', 'obs_date', 'vintage', 'available_date', 'value', 'units', 'run_id']) AS c, unnest(['string', 'date', 'date', 'date', 'double', lower(any_value(typeof(units))), 'string']) AS t FROM obs) a
 FULL JOIN (VALUES ('series_id', 'string'), ('obs_date', 'date'), ('vintage', 'date'), ('value', 'double'), ('units', 'int'), ('loaded_at', 'timestamp')) b(c, t) ON a.c = b.c WHERE a.t IS DISTINCT FROM b.t""")
def c08_schema_contract(spark, d):
    """Columns of `obs` that differ from the declared ones, both ways."""
    declared = {"series_id": "string", "obs_date": "date", "vintage": "date", "value": "double", "units": "int", "loaded_at": "timestamp"}
    return quality.schema_differences(spark, table(spark, d, "obs"), declared)


#: Observations with faults of every kind: prices of 0, below, missing and NaN; missing, future and early dates.
FAULTY = """SELECT series_id, CASE WHEN day(obs_date) = 11 THEN NULL ELSE obs_date END AS obs_date, vintage, CASE WHEN day(obs_date) = 12 THEN CAST(obs_date - 1 AS DATE) ELSE available_date END AS available_date,
 CASE WHEN day(vintage) = 13 THEN 0.0 WHEN day(vintage) = 14 THEN -value WHEN day(vintage) = 15 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value FROM obs"""


@query(f"""SELECT series_id, obs_date, vintage, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, available_date, r AS rule FROM (SELECT *, unnest([CASE WHEN p AND (value IS NULL OR isnan(value)) THEN 'missing_price' END, CASE WHEN p AND NOT isnan(value) AND value <= 0 THEN 'price_not_above_0' END,
 CASE WHEN obs_date IS NULL OR available_date IS NULL OR vintage IS NULL THEN 'missing_date' END, CASE WHEN obs_date > DATE '2024-01-20' THEN 'future' END, CASE WHEN available_date < obs_date THEN 'look_ahead' END]) AS r
 FROM (SELECT *, split_part(series_id, ':', 2) IN ('purchase', 'click') AS p FROM ({FAULTY}))) WHERE r IS NOT NULL""")
def c09_impossible_values(spark, d):
    """One row for each rule that a row breaks; purchases and clicks stand for prices."""
    found = quality.impossible_values(sql(spark, d, FAULTY), "2024-01-20", "split_part(series_id, ':', 2) IN ('purchase', 'click')")
    return found.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


@query("SELECT ticker, obs_date, close, prev FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY obs_date) AS prev FROM prices) WHERE abs(close / prev - 1) > 0.4")
def c10_price_jumps(spark, d):
    return C.price_jumps(table(spark, d, "prices"), "ticker", "obs_date", "close", 0.4)


@query("""SELECT DISTINCT series_id, 'no_catalog_row' AS problem FROM obs WHERE value > 400 AND series_id NOT IN (SELECT series_id FROM series_catalog WHERE source <> 'error') UNION ALL SELECT series_id, 'no_rows' FROM series_catalog WHERE source <> 'error' AND active_to IS NULL AND series_id NOT IN (SELECT series_id FROM obs WHERE value > 400)""")
def c11_catalog_integrity(spark, d):
    return C.catalog_integrity(table(spark, d, "obs").filter("value > 400"), table(spark, d, "series_catalog").filter("source <> 'error'"))


@query(f"SELECT ticker, obs_date, 'gap' AS problem FROM {RECON} WHERE gap > 0.005 UNION ALL SELECT 'GONE', NULL, 'no_common_dates'")
def c12_second_source(spark, d):
    watch = sql(spark, d, "SELECT DISTINCT ticker FROM prices UNION SELECT 'GONE' AS ticker")
    return C.second_source(reconciled(spark, d), watch, 0.005)


@query("""WITH n AS (SELECT series_id, min(obs_date) AS a, count(DISTINCT obs_date) AS n FROM obs GROUP BY 1), w AS (SELECT series_id, min(obs_date) AS a, count(DISTINCT obs_date) AS n FROM obs WHERE vintage > DATE '2024-01-03' GROUP BY 1)
SELECT c.series_id, n.n AS baseline, coalesce(w.n, 0) AS now, CASE WHEN n.series_id IS NULL THEN 'no_baseline' WHEN coalesce(w.n, 0) < n.n THEN 'fewer_dates' ELSE 'later_start' END AS problem FROM series_catalog c LEFT JOIN w ON w.series_id = c.series_id LEFT JOIN (SELECT * FROM n WHERE split_part(series_id, ':', 2) <> 'error') n ON n.series_id = c.series_id
 WHERE n.series_id IS NULL OR coalesce(w.n, 0) < n.n OR w.a > n.a""")
def c13_baseline_drift(spark, d):
    obs, catalog = table(spark, d, "obs"), table(spark, d, "series_catalog")
    recorded = C.baseline_metrics(obs, catalog).filter("split_part(series_id, ':', 2) <> 'error'")
    return C.baseline_drift(C.baseline_metrics(obs.filter("vintage > DATE '2024-01-03'"), catalog), recorded)


@query("SELECT series_id, obs_date, vintage, min(value) AS lo, max(value) AS hi, bool_or(value IS NULL) AS some_null FROM obs_raw GROUP BY series_id, obs_date, vintage HAVING min(value) <> max(value) OR (bool_or(value IS NULL) AND count(value) > 0)")
def c14_silent_corrections(spark, d):
    return C.silent_corrections(table(spark, d, "obs_raw"), ["series_id", "obs_date", "vintage"], "value")


@query("SELECT series_id FROM series_catalog WHERE active_to IS NOT NULL AND source <> 'view'")
def c15_source_missing(spark, d):
    served = table(spark, d, "obs").filter("split_part(series_id, ':', 2) = 'view' OR split_part(series_id, ':', 3) <> '7'")
    return C.source_missing(served, table(spark, d, "series_catalog"))


@query(f"SELECT l.series_id, l.obs_date, l.vintage FROM {LATEST} l JOIN series_catalog c ON l.series_id = c.series_id WHERE l.value IS NULL AND l.obs_date >= c.active_from AND (c.active_to IS NULL OR l.obs_date <= c.active_to)")
def c16_withdrawn_values(spark, d):
    return C.withdrawn_values(newest(spark, d), table(spark, d, "series_catalog"))


@query(f"{BEHIND} SELECT *, CASE WHEN last_date IS NULL THEN 'no_rows' WHEN behind IS NULL THEN 'uncountable' ELSE 'stale' END AS problem FROM n WHERE last_date IS NULL OR behind IS NULL OR behind >= 2")
def c17_stale_series(spark, d):
    return C.stale_series(behind(spark, d))


@query("SELECT DISTINCT ticker FROM prices WHERE ticker = 'LOW'")
def c18_reference_completeness(spark, d):
    return C.reference_completeness(table(spark, d, "prices"), table(spark, d, "ref_prices").filter("ticker <> 'LOW'"))


@query("SELECT substr(o_orderpriority, 3) AS ticker, CAST(o_orderdate AS DATE) AS obs_date, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def c19_reference_uniqueness(spark, d):
    return C.repeated(sql(spark, d, "SELECT substr(o_orderpriority, 3) AS ticker, CAST(o_orderdate AS DATE) AS obs_date FROM orders"), ["ticker", "obs_date"])


@query("SELECT ticker, newest, due FROM (SELECT ticker, max(obs_date) AS newest FROM ref_prices GROUP BY ticker), (SELECT max(session) AS due FROM sessions WHERE session <= DATE '2001-07-15') WHERE newest < due")
def c20_reference_freshness(spark, d):
    return C.reference_freshness(table(spark, d, "ref_prices"), table(spark, d, "sessions"), "2001-07-15")


@query(f"SELECT newest, weekdays FROM (SELECT newest, (SELECT count(*) FROM generate_series(newest + INTERVAL 1 DAY, TIMESTAMP '{TODAY}', INTERVAL 1 DAY) g(x) WHERE dayofweek(x) BETWEEN 1 AND 5) AS weekdays FROM (SELECT max(filed) AS newest FROM facts)) WHERE weekdays > 3")
def c25_index_freshness(spark, d):
    return C.index_freshness(table(spark, d, "facts"), "filed", TODAY, 3)


@query(f"SELECT dataset, max(loaded_at) AS newest FROM loads GROUP BY dataset HAVING max(loaded_at) < TIMESTAMP '{CLOCK}' - INTERVAL 36 HOUR UNION ALL SELECT 'submissions', NULL")
def c31_landing_age(spark, d):
    return C.landing_age(table(spark, d, "loads"), CLOCK, 36, ["click", "view", "purchase", "error", "signup", "submissions"])


@query("SELECT 'view' AS dataset, max(loaded_at) AS newest FROM loads WHERE dataset = 'view' HAVING max(loaded_at) < TIMESTAMP '2024-03-01 00:00:00' - INTERVAL 336 HOUR")
def c34_ticker_file_age(spark, d):
    return C.landing_age(table(spark, d, "loads"), "2024-03-01 00:00:00", 336, ["view"])


@query(f"SELECT run_id, dataset FROM {MANIFEST} WHERE outcome = 'carried_forward' AND run_id = (SELECT arg_max(run_id, row(loaded_at, run_id)) FROM loads)")
def c35_carried_forward(spark, d):
    return C.carried_forward(manifest(spark, d))


@query(f"""SELECT dataset, CAST(min(rk) FILTER (WHERE outcome = 'published') - 1 AS BIGINT) AS runs_ago FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY loaded_at DESC, run_id) AS rk FROM {MANIFEST} WHERE dataset <> 'click' OR outcome <> 'published') GROUP BY dataset
 HAVING coalesce(min(rk) FILTER (WHERE outcome = 'published') - 1, 99) >= 2""")
def c36_group_stale(spark, d):
    return C.group_stale(manifest(spark, d).filter("dataset <> 'click' OR outcome <> 'published'"), 2)


@query(f"SELECT 'purchase' AS dataset, max(loaded_at) AS newest FROM loads WHERE dataset = 'purchase' HAVING max(loaded_at) < TIMESTAMP '{CLOCK}' - INTERVAL 36 HOUR")
def c40_facts_landing_age(spark, d):
    return C.landing_age(table(spark, d, "loads"), CLOCK, 36, ["purchase"])


@query("SELECT run_id, unnest([dataset, 'all']) AS series, unnest(['short', 'late']) AS error FROM loads WHERE run_id = 'r7'")
def c41_series_failed(spark, d):
    notes = sql(spark, d, "SELECT run_id, '[{\"series\":\"' || dataset || '\",\"error\":\"short\"},{\"series\":\"all\",\"error\":\"late\"}]' AS note FROM loads")
    return C.series_failed(notes, "r7", "note")


@query("SELECT run_id, max(loaded_at) AS ended FROM loads WHERE CAST(substr(run_id, 2) AS INTEGER) % 5 = 0 GROUP BY run_id HAVING max(loaded_at) < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 6 HOUR")
def c42_run_not_recorded(spark, d):
    return C.run_not_recorded(table(spark, d, "loads"), manifest(spark, d).filter("CAST(substr(run_id, 2) AS INT) % 5 <> 0"), "2024-01-31 00:00:00", 6)


@query("WITH h AS (SELECT DISTINCT CAST(date_trunc('quarter', end_date) AS DATE) AS q FROM facts WHERE month(end_date) > 3 OR year(end_date) < 1998) SELECT CAST(g.q AS DATE) AS q FROM generate_series((SELECT min(q) FROM h), (SELECT max(q) FROM h), INTERVAL 3 MONTH) g(q) WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.q = g.q)")
def c43_quarter_missing(spark, d):
    return C.quarters_missing(table(spark, d, "facts").filter("month(end_date) > 3 OR year(end_date) < 1998"), "end_date")


@query("SELECT cik, accession, count(*) AS n FROM facts GROUP BY cik, accession HAVING count(*) > 1")
def c44_filing_key(spark, d):
    return C.repeated(table(spark, d, "facts"), ["cik", "accession"])


@query(f"SELECT newest FROM (SELECT max(filed) AS newest FROM facts) WHERE newest < DATE '{TODAY}' - INTERVAL 7 MONTH")
def c45_edition_age(spark, d):
    return C.edition_age(table(spark, d, "facts"), "filed", TODAY, 7)


@query("SELECT max(year(o_orderdate)) AS y FROM orders HAVING max(year(o_orderdate)) <= 2024 - 3")
def c46_revision_age(spark, d):
    return C.revision_age(sql(spark, d, "SELECT 'WPP' || CAST(year(o_orderdate) AS VARCHAR(4)) || '_Medium' AS name FROM orders"), "name", TODAY, 3)


@query(f"SELECT newest FROM (SELECT max(CAST(date_trunc('quarter', end_date) AS DATE)) AS newest FROM facts) WHERE newest < CAST(date_trunc('quarter', DATE '{TODAY}') - INTERVAL 3 MONTH AS DATE)")
def c47_quarter_served(spark, d):
    return C.quarter_served(table(spark, d, "facts"), "end_date", TODAY)


@query(f"SELECT yr FROM (SELECT max(yr) AS yr FROM company_years) WHERE make_date(yr, 9, 30) < DATE '{TODAY}' - INTERVAL 24 MONTH")
def c48_fiscal_year_age(spark, d):
    return C.fiscal_year_age(table(spark, d, "company_years"), "yr", TODAY, 24)


@query(f"{EXPECTED} SELECT * FROM j1")
def j1_expected_dates(spark, d):
    return expected(spark, d)


@query("SELECT c.series_id, min(o.obs_date) AS first_date, max(o.obs_date) AS last_date, count(DISTINCT o.obs_date) AS n_dates FROM series_catalog c LEFT JOIN obs o ON o.series_id = c.series_id GROUP BY c.series_id")
def j2_baseline_metrics(spark, d):
    return C.baseline_metrics(table(spark, d, "obs"), table(spark, d, "series_catalog"))


@query(f"SELECT ticker, obs_date, close, round(ref_close / close, 6) AS ratio, round(gap, 6) AS gap FROM {RECON}")
def j3_reconcile_prices(spark, d):
    return reconciled(spark, d).select("ticker", "obs_date", "close", F.round(F.col("ref_close") / F.col("close"), 6).alias("ratio"), F.round("gap", 6).alias("gap"))


@query(f"SELECT ticker, obs_date, CASE WHEN coalesce(NOT before, TRUE) AND coalesce(NOT after, TRUE) THEN 'isolated' ELSE 'not_isolated' END AS kind FROM (SELECT *, gap > 0.005 AS over, lag(gap > 0.005) OVER (PARTITION BY ticker ORDER BY obs_date) AS before, lead(gap > 0.005) OVER (PARTITION BY ticker ORDER BY obs_date) AS after FROM {RECON}) WHERE over UNION ALL SELECT ticker, NULL, 'too_few' FROM (SELECT ticker, max(n) AS n FROM (SELECT ticker, count(gap) AS n FROM {RECON} GROUP BY ticker UNION ALL SELECT DISTINCT mktsegment, 0 FROM (SELECT c_mktsegment AS mktsegment FROM customer)) GROUP BY ticker) WHERE n < 50")
def j4_audit(spark, d):
    """Market segments stand for watched tickers without any price."""
    return C.audit(reconciled(spark, d), 0.005, 50, table(spark, d, "customer").select(F.col("c_mktsegment").alias("ticker")).distinct())


@query(f"SELECT ticker, count(*) AS common_dates, count(*) - count(gap) AS nulls, round(median(gap), 6) AS median_gap, round(max(gap), 6) AS max_gap, arg_max(obs_date, row(round(gap, 9), obs_date)) AS worst_date, count(*) FILTER (WHERE gap > 0.005) AS over FROM {RECON} GROUP BY ticker")
def j5_reconcile_summary(spark, d):
    return C.reconcile_summary(reconciled(spark, d), 0.005).withColumns({"median_gap": F.round("median_gap", 6), "max_gap": F.round("max_gap", 6)})


@query("""SELECT coalesce(a.ticker, b.ticker) AS ticker, count(*) FILTER (WHERE a.d IS NOT NULL AND b.d IS NOT NULL) AS both_have, count(*) FILTER (WHERE b.d IS NULL) AS only_a, count(*) FILTER (WHERE a.d IS NULL) AS only_b
 FROM (SELECT ticker, obs_date AS d FROM ref_prices WHERE div_cash > 0) a FULL JOIN (SELECT ticker, obs_date AS d FROM prices WHERE day(obs_date) IN (20, 21) AND month(obs_date) <> 7) b ON a.ticker = b.ticker AND a.d = b.d GROUP BY 1""")
def j6_compare_events(spark, d):
    paid = table(spark, d, "ref_prices").filter("div_cash > 0")
    return C.compare_events(paid, table(spark, d, "prices").filter("day(obs_date) IN (20, 21) AND month(obs_date) <> 7"), "ticker", "obs_date")


#: Checks as declared files: name and text.
FILES_OF_CHECKS = {
    "C06_load_control_total": "-- id: C06\n-- severity: error\n-- gate: yes\n-- group: loads\n-- description: rows downloaded and written differ\n\nSELECT * FROM loads WHERE rows_downloaded IS DISTINCT FROM rows_written;\n",
    "C16": "-- id: C16\n-- severity: warn\n-- gate: no\n-- group: macro\n-- ack_key: series_id, obs_date\n-- description: newest value withdrawn\n"
    "SELECT l.series_id, l.obs_date FROM (SELECT series_id, obs_date, max_by(value, vintage) AS value FROM obs GROUP BY series_id, obs_date) l JOIN series_catalog c ON l.series_id = c.series_id WHERE l.value IS NULL AND l.obs_date >= c.active_from AND (c.active_to IS NULL OR l.obs_date <= c.active_to)",
    "C44_filing_key": "-- id: C44\n-- severity: error\n-- gate: no\n-- group: sec\n-- description: filing named twice\nSELECT cik, accession, count(*) AS n FROM facts GROUP BY cik, accession HAVING count(*) > 1",
    "X1_negative": "-- id: X1\n-- severity: error\n-- gate: yes\n-- group: sec\n-- description: negative value\nSELECT cik, concept FROM facts WHERE val < 0",
    "X2": "-- id: X2\n-- severity: error\n-- gate: yes\n-- group: macro\n-- description: reads a column that isn't there\nSELECT no_such_column FROM obs",
}


def results(spark, d):
    return quality.run_checks(spark, quality.declared_checks(FILES_OF_CHECKS, ["loads", "macro", "sec"], lambda text: sql(spark, d, text)))


RESULTS_SQL = """SELECT 'C06' AS check_id, 'loads' AS source_group, 'error' AS severity, TRUE AS gate, CASE WHEN n > 0 THEN 'error' ELSE 'passed' END AS status, n AS failing_rows FROM (SELECT count(*) AS n FROM loads WHERE rows_downloaded <> rows_written) UNION ALL
 SELECT 'C16', 'macro', 'warn', FALSE, CASE WHEN n > 0 THEN 'warn' ELSE 'passed' END, n FROM (SELECT count(*) AS n FROM {latest} l JOIN series_catalog c ON l.series_id = c.series_id WHERE l.value IS NULL AND l.obs_date >= c.active_from AND (c.active_to IS NULL OR l.obs_date <= c.active_to)) UNION ALL
 SELECT 'C44', 'sec', 'error', FALSE, CASE WHEN n > 0 THEN 'error' ELSE 'passed' END, n FROM (SELECT count(*) AS n FROM (SELECT cik FROM facts GROUP BY cik, accession HAVING count(*) > 1)) UNION ALL
 SELECT 'X1', 'sec', 'error', TRUE, CASE WHEN n > 0 THEN 'error' ELSE 'passed' END, n FROM (SELECT count(*) AS n FROM facts WHERE val < 0) UNION ALL
 SELECT 'X2', 'macro', 'error', TRUE, 'broken', NULL""".format(latest=LATEST)


@query(RESULTS_SQL)
def j7_run_checks(spark, d):
    return results(spark, d).select("check_id", "source_group", "severity", "gate", "status", "failing_rows")


@query(f"WITH r AS ({RESULTS_SQL}) SELECT source_group, CASE WHEN bool_or(gate AND status = 'broken') THEN 'failed' WHEN bool_or(gate AND status = 'error') THEN 'blocked' ELSE 'passed' END AS verdict FROM r GROUP BY source_group UNION ALL SELECT 'run', CASE WHEN bool_or(gate AND status = 'broken') THEN 'failed' WHEN bool_or(gate AND status = 'error') THEN 'blocked' ELSE 'passed' END FROM r")
def j8_verdicts(spark, d):
    return quality.with_run_verdict(quality.verdicts(results(spark, d)))


@query(f"SELECT check_id, CASE WHEN status = 'warn' THEN 'acknowledged' ELSE status END AS status FROM ({RESULTS_SQL}) UNION ALL SELECT 'unmatched_reviews', 'warn'")
def j9_acknowledge(spark, d):
    failing = quality.failing_keys(spark, quality.declared_checks(FILES_OF_CHECKS, ["loads", "macro", "sec"], lambda text: sql(spark, d, text)))
    seen = failing.unionByName(spark.createDataFrame([("C16", "gone|2020-01-01")], "check_id string, ack_key string"))
    return quality.acknowledge(results(spark, d), failing, seen).select("check_id", "status")


@query(f"SELECT coalesce(nullif(split_part(series_id, ':', 2), ''), 'run') AS source, count(*) AS failing FROM {LATEST} WHERE value IS NULL GROUP BY 1")
def j10_rows_by_source(spark, d):
    return C.rows_by_source(newest(spark, d).filter("value IS NULL"), F.split_part("series_id", F.lit(":"), F.lit(2)))


@query("""SELECT * FROM (SELECT 'o_orderpriority' AS "column", 'type' AS problem, count(*) - count(TRY_CAST(o_orderpriority AS INTEGER)) AS n FROM orders UNION ALL SELECT 'o_clerk', 'absent', 1 UNION ALL SELECT 'o_orderstatus', 'undeclared', 1 UNION ALL SELECT 'o_orderpriority', 'length', count(*) FILTER (WHERE length(o_orderpriority) > 10) FROM orders
 UNION ALL SELECT 'o_custkey', 'repeated', count(*) - count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'o_custkey', 'orphan', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)) WHERE n > 0""")
def j11_conform(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    declared = {"o_orderkey": ("bigint", 10), "o_custkey": ("bigint", None), "o_orderpriority": ("int", 10), "o_clerk": ("string", None)}
    return C.conform(orders, declared, ["o_custkey"], table(spark, d, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@query("""SELECT * FROM (SELECT 'filed_early' AS rule, count(*) AS n, min(accession) AS example FROM facts WHERE filed <= end_date UNION ALL SELECT 'huge', count(*), min(accession) FROM facts WHERE val > 90000 UNION ALL SELECT 'negative', count(*), min(accession) FROM facts WHERE val < 0) WHERE n > 0""")
def j12_oddities(spark, d):
    out = C.oddities(table(spark, d, "facts"), {"negative": "val < 0", "filed_early": "filed <= end_date", "huge": "val > 90000"}, ["accession"])
    return out.select("rule", "n", F.get_json_object("example", "$.accession").cast("long").alias("example"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def j13_coverage_gaps(spark, d):
    return C.coverage_gaps(table(spark, d, "customer"), table(spark, d, "orders").filter("o_orderstatus = 'P'"), "c_custkey", "o_custkey")


GROUPS = ("SELECT DISTINCT dataset AS source_group FROM loads UNION SELECT 'idle' AS source_group", "SELECT dataset AS source_group, CASE WHEN dataset = 'error' THEN 'blocked' WHEN dataset = 'view' THEN 'failed' ELSE 'passed' END AS verdict FROM (SELECT DISTINCT dataset FROM loads WHERE dataset <> 'purchase') x")


@query("""SELECT g AS source_group, CASE WHEN g IN ('error', 'idle') THEN 'carried_forward' WHEN g = 'view' THEN 'failed' WHEN g = 'purchase' THEN 'never_published' ELSE 'published' END AS outcome, CASE WHEN g IN ('error', 'idle') THEN 'r0' WHEN g IN ('view', 'purchase') THEN NULL ELSE 'r9' END AS source_run,
 CASE g WHEN 'error' THEN 'blocked' WHEN 'idle' THEN 'not_run' WHEN 'view' THEN 'failed' WHEN 'purchase' THEN 'no_verdict' END AS reason FROM (SELECT DISTINCT dataset AS g FROM loads UNION SELECT 'idle')""")
def k2_compose(spark, d):
    groups, verdict = (sql(spark, d, x) for x in GROUPS)
    return C.compose(groups, verdict, groups.filter("source_group <> 'idle'"), spark.createDataFrame([("error", "r0"), ("idle", "r0")], "source_group string, run_id string"), "r9")


@query("""WITH r AS (SELECT event_type AS dataset, count(*) AS checks, count(*) FILTER (WHERE event_id % 11 = 0) AS not_passed FROM events WHERE event_type <> 'click' GROUP BY 1)
SELECT l.dataset, CAST(sum(rows_downloaded) AS BIGINT) AS downloaded, CAST(sum(rows_written) AS BIGINT) AS landed, max(loaded_at) AS newest, any_value(s.o) AS latest_obs, coalesce(any_value(r.checks), 0) AS checks, coalesce(any_value(r.not_passed), 0) AS not_passed, CASE l.dataset WHEN 'view' THEN 'blocked' WHEN 'error' THEN 'not_run' ELSE 'published' END AS outcome
 FROM loads l LEFT JOIN (SELECT split_part(series_id, ':', 2) AS dataset, max(obs_date) AS o FROM obs GROUP BY 1) s ON s.dataset = l.dataset LEFT JOIN r ON r.dataset = l.dataset GROUP BY l.dataset""")
def k3_run_manifest(spark, d):
    staged = sql(spark, d, "SELECT split_part(series_id, ':', 2) AS dataset, max(obs_date) AS latest_obs FROM obs GROUP BY 1")
    checked = sql(spark, d, "SELECT event_type AS dataset, CASE WHEN event_id % 11 = 0 THEN 'warn' ELSE 'passed' END AS status FROM events WHERE event_type <> 'click'")
    outcomes = sql(spark, d, "SELECT DISTINCT dataset, CASE dataset WHEN 'view' THEN 'blocked' ELSE 'published' END AS outcome FROM loads WHERE dataset <> 'error'")
    return C.run_manifest(table(spark, d, "loads"), staged, checked, outcomes)


@query("""WITH a AS (SELECT id, val FROM landings WHERE run_id = 'r1'), b AS (SELECT id, val FROM landings WHERE run_id = 'r3')
SELECT 'landings' AS "table", (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a, (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b UNION ALL SELECT 'regions', 0, (SELECT count(*) FROM region) UNION ALL SELECT 'same', 0, 0""")
def k4_compare_versions(spark, d):
    rows, nation = table(spark, d, "landings"), table(spark, d, "nation")
    a, b = (rows.filter(F.col("run_id") == r).select("id", "val") for r in ("r1", "r3"))
    return C.compare_versions({"landings": a, "same": nation}, {"landings": b, "regions": table(spark, d, "region"), "same": nation})


@query(f"""WITH m AS (SELECT dataset, arg_max(outcome, loaded_at) AS s FROM {MANIFEST} WHERE run_id = 'r7' GROUP BY 1) SELECT 'K' || g AS check_id, g AS source_group, CASE WHEN g = 'view' THEN 'not_served' ELSE coalesce(m.s, 'broken') END AS status
 FROM (SELECT DISTINCT dataset AS g FROM loads UNION SELECT 'other') LEFT JOIN m ON m.dataset = g""")
def k5_recorded_gates(spark, d):
    checks = sql(spark, d, "SELECT 'K' || g AS check_id, g AS source_group FROM (SELECT DISTINCT dataset AS g FROM loads UNION SELECT 'other' AS g) x")
    recorded = manifest(spark, d).select(F.concat(F.lit("K"), "dataset").alias("check_id"), "run_id", F.col("outcome").alias("status"), F.col("loaded_at").alias("at"))
    served = checks.filter("source_group <> 'view'").select("source_group", F.lit("r7").alias("source_run"))
    return C.recorded_gates(recorded, checks, served)


@query(f"SELECT CASE WHEN bool_or(status IN ('error', 'broken')) THEN 'red' WHEN bool_or(status = 'warn') THEN 'yellow' ELSE 'green' END AS health FROM ({RESULTS_SQL})")
def k6_health(spark, d):
    return quality.health(results(spark, d), not manifest(spark, d).filter("outcome = 'published'").isEmpty())


@query(f"""SELECT 'run ' || run_id AS name, CAST(sum(rows_written) AS BIGINT) AS n, CASE WHEN sum(rows_written) <> sum(rows_downloaded) THEN 'red' ELSE 'green' END AS color FROM loads GROUP BY run_id
 UNION ALL SELECT 'strip ' || run_id, NULL, CASE WHEN bool_or(outcome = 'blocked') THEN 'red' WHEN bool_or(outcome = 'carried_forward') THEN 'yellow' ELSE 'green' END FROM {MANIFEST} GROUP BY run_id UNION ALL SELECT 'source ' || split_part(series_id, ':', 2), count(*), NULL FROM obs GROUP BY 1""")
def k7_rows_by_run(spark, d):
    runs = C.rows_by_run(table(spark, d, "loads")).select(F.concat(F.lit("run "), "run_id").alias("name"), F.col("landed").alias("n"), "color")
    strip = C.run_strip(manifest(spark, d)).select(F.concat(F.lit("strip "), "run_id").alias("name"), F.lit(None).cast("long").alias("n"), "color")
    served = C.served_summary(table(spark, d, "obs"), F.split_part("series_id", F.lit(":"), F.lit(2)))
    return runs.unionByName(strip).unionByName(served.select(F.concat(F.lit("source "), "source").alias("name"), F.col("n_rows").alias("n"), F.lit(None).cast("string").alias("color")))


@query(f"{EXPECTED} SELECT j1.series_id, CAST(m AS DATE) AS month, round(avg(CASE WHEN present THEN 1.0 ELSE 0.0 END), 6) AS share FROM (SELECT j1.*, unnest(CASE WHEN c.frequency = 'Q' THEN [date_trunc('month', obs_date), date_trunc('month', obs_date) + INTERVAL 1 MONTH, date_trunc('month', obs_date) + INTERVAL 2 MONTH] ELSE [date_trunc('month', obs_date)] END) AS m FROM j1 JOIN c USING (series_id)) j1 GROUP BY 1, 2")
def k8_coverage(spark, d):
    return C.coverage(expected(spark, d), sql(spark, d, CATALOG)).withColumn("share", F.round("share", 6))


@query("SELECT p.ticker, p.obs_date, p.close FROM prices p JOIN (SELECT ticker, max(obs_date) AS last FROM prices GROUP BY ticker) m ON p.ticker = m.ticker WHERE p.obs_date > m.last - INTERVAL 365 DAY")
def k9_trailing_year(spark, d):
    return C.trailing_year(table(spark, d, "prices"), "ticker", "obs_date").select("ticker", "obs_date", "close")


@query(f"SELECT c.series_id, min(l.obs_date) AS first_date, max(l.obs_date) AS last_date, count(l.value) AS n, count(l.obs_date) > 0 AS served FROM series_catalog c LEFT JOIN (SELECT * FROM {LATEST} WHERE split_part(series_id, ':', 3) <> '9') l ON l.series_id = c.series_id GROUP BY c.series_id")
def k10_series_inventory(spark, d):
    return C.series_inventory(newest(spark, d).filter("split_part(series_id, ':', 3) <> '9'"), table(spark, d, "series_catalog"))


@query("""SELECT 'obs' AS name, count(*) AS n, min(obs_date) AS first_date, max(obs_date) AS last_date, CAST(NULL AS BIGINT) AS series FROM obs UNION ALL SELECT 'prices', count(*), min(obs_date), max(obs_date), NULL FROM prices UNION ALL SELECT 'facts', count(*), min(filed), max(filed), NULL FROM facts
 UNION ALL SELECT 'clicks', count(*), min(obs_date), max(obs_date), count(DISTINCT series_id) FROM obs WHERE series_id LIKE 'ev:click:%' UNION ALL SELECT 'none', 0, NULL, NULL, 0""")
def k11_table_catalog(spark, d):
    tables = {"obs": (table(spark, d, "obs"), "obs_date"), "prices": (table(spark, d, "prices"), "obs_date"), "facts": (table(spark, d, "facts"), "filed")}
    return C.table_catalog(tables, {"clicks": ("obs", "ev:click"), "none": ("obs", "ev:cli")})


#: Groups of runs by outcome, some runs without any, and results of checks.
GROUPS_OF_RUNS = "SELECT run_id, dataset, CASE WHEN rows_downloaded % 3 = 0 THEN 'blocked' WHEN rows_downloaded % 11 = 0 THEN 'failed' WHEN rows_downloaded % 7 = 0 THEN 'carried_forward' ELSE 'published' END AS outcome FROM loads WHERE CAST(substr(run_id, 2) AS INTEGER) % 5 <> 0"
RUN_RESULTS = "SELECT run_id, 'C' || dataset AS check_id, CASE WHEN rows_downloaded % 4 = 0 THEN 'error' WHEN rows_downloaded % 4 = 1 THEN 'warn' WHEN rows_downloaded % 4 = 2 THEN 'acknowledged' ELSE 'passed' END AS status FROM loads"


@query(f"""WITH g AS ({GROUPS_OF_RUNS}), m AS (SELECT run_id, CASE WHEN bool_and(outcome IN ('blocked', 'failed')) THEN CASE WHEN bool_or(outcome = 'failed') THEN 'failed' ELSE 'blocked' END WHEN bool_or(outcome IN ('blocked', 'failed')) OR (bool_or(outcome = 'carried_forward') AND bool_or(outcome = 'published')) THEN 'partial' WHEN bool_or(outcome = 'published') THEN 'published' ELSE 'carried' END AS o,
 count(*) FILTER (WHERE outcome = 'blocked') AS blocked, count(*) FILTER (WHERE outcome = 'failed') AS failed FROM g GROUP BY run_id), l AS (SELECT run_id, min(loaded_at) AS a, max(loaded_at) AS b FROM loads GROUP BY run_id)
SELECT l.run_id, coalesce(o, 'died') AS outcome, a AS started, b AS ended, CAST(epoch(date_trunc('second', b)) - epoch(date_trunc('second', a)) AS BIGINT) AS seconds, coalesce(blocked, 0) AS blocked, coalesce(failed, 0) AS failed, f.x AS failing_checks FROM l LEFT JOIN m ON m.run_id = l.run_id
 LEFT JOIN (SELECT run_id, string_agg(check_id, ',' ORDER BY check_id) AS x FROM ({RUN_RESULTS}) WHERE status IN ('error', 'warn') GROUP BY run_id) f ON f.run_id = l.run_id""")
def k12_run_log(spark, d):
    return C.run_log(sql(spark, d, GROUPS_OF_RUNS), table(spark, d, "loads"), sql(spark, d, RUN_RESULTS))


@query("""WITH r AS (SELECT CAST(max(loaded_at) AS DATE) AS d FROM loads GROUP BY run_id) SELECT CAST(x AS DATE) AS d FROM generate_series(CAST((SELECT min(d) FROM r) AS TIMESTAMP), CAST((SELECT max(d) FROM r) AS TIMESTAMP), INTERVAL 1 DAY) g(x) WHERE CAST(x AS DATE) NOT IN (SELECT d FROM r)""")
def k12_days_without_run(spark, d):
    return C.days_without_run(C.run_log(sql(spark, d, GROUPS_OF_RUNS), table(spark, d, "loads")))
