"""Sources (A), transforms (B), the streamed merge (I13) and version writing (K1). Files to read are first written from the given tables into the shared folder."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from palimpsest.operators import publish, quality, transforms
from palimpsest.plans.fixtures import sql, table, with_fixtures
from palimpsest.queries.bitemporal import COLS, MERGED
from palimpsest.sources import ingest, raw
from palimpsest.streaming.landings import stream_merge

LOADED = datetime.datetime(2024, 2, 1)
BY_ORDER = "SELECT l_orderkey AS cik, count(*) AS n, array_sort(collect_list(struct(l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS d, l_returnflag, l_suppkey))) AS lines FROM lineitem GROUP BY l_orderkey"


def _fresh(spark) -> str:
    return f"{raw.shared_folder(spark)}/{uuid.uuid4().hex}"


def _landed(spark, d, runs):
    root, rows = _fresh(spark), table(spark, d, "landings")
    return root, [raw.land_raw(rows.filter(F.col("run_id") == r).drop("run_id"), root, "sec", "filings", r, LOADED) for r in runs]


def a1_scan_table(spark, d):
    return raw.scan_table(spark, d, "orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


def a2_raw_snapshots(spark, d):
    root, _ = _landed(spark, d, ["r1", "r2", "r3"])
    return raw.raw_snapshots(spark, root, "sec", "filings", ["r1", "r3"], {"act": "string", "val": "double"}).select("id", "val", "run_id", "act")


def a3_land_raw(spark, d):
    _, loads = _landed(spark, d, ["r1", "r2", "r9"])
    return loads[0].union(loads[1]).union(loads[2]).select("dataset", "run_id", "rows_downloaded", "rows_written", F.col("path").isNotNull().alias("has_file"))


def a4_write_partitioned(spark, d):
    path = _fresh(spark)
    raw.write_partitioned(table(spark, d, "landings"), path, "quarter")
    return spark.read.parquet(path).select(*COLS)


def a5_file_ledger(spark, d):
    root, _ = _landed(spark, d, ["r1", "r2"])
    files = raw.file_ledger(spark, root)
    return files.agg(F.sum("rows").alias("n_rows"), F.bool_and((F.length("sha256") == 64) & (F.col("bytes") > 0)).alias("all_hashed"))


def a7_ingest_index(spark, d):
    path, lines = _fresh(spark), table(spark, d, "raw_index")
    body = lines.select(F.concat_ws("|", "cik", "company_name", "form_type", "date_filed", "filename").alias("value"), "quarter")
    head = lines.select("quarter").distinct().select(F.explode(F.array(*map(F.lit, ["Description: Master Index", "", "CIK|Company Name|Form Type|Date Filed|Filename", "-" * 40]))).alias("value"), "quarter")
    head.union(body).write.partitionBy("quarter").text(path)
    return ingest.ingest_index(spark, path, r"/quarter=(\d{4}Q\d)/")


def a8_ingest_submissions(spark, d):
    path = _fresh(spark)
    of = lambda e: F.transform("lines", e)
    recent = F.struct(of(lambda x: F.concat(F.col("cik"), F.lit("-"), x.l_linenumber)).alias("accessionNumber"), of(lambda x: x.d.cast("string")).alias("filingDate"), of(lambda x: F.lit("")).alias("reportDate"), of(lambda x: x.l_returnflag).alias("form"), of(lambda x: F.lit("")).alias("items"))
    sql(spark, d, BY_ORDER).select("cik", F.concat(F.lit("Company "), "cik").alias("name"), F.array(F.lit("T")).alias("tickers"), F.struct(recent.alias("recent")).alias("filings")).write.json(path)
    details, filings = ingest.ingest_submissions(spark, path, multi_line=False)
    return details.join(filings, "cik").select("cik", "name", F.element_at("tickers", 1).alias("ticker"), F.col("accessionNumber").alias("accession"), F.col("filingDate").cast("date").alias("filed"), "form")


def a9_ingest_companyfacts(spark, d):
    path = _fresh(spark)
    rows = F.transform("lines", lambda x: F.struct(x.d.cast("string").alias("end"), x.l_partkey.alias("val"), x.l_linenumber.alias("fy"), x.d.cast("string").alias("filed")))
    concept = F.create_map(F.lit("Assets"), F.struct(F.lit("Total").alias("label"), F.create_map(F.lit("USD"), rows).alias("units")))
    sql(spark, d, BY_ORDER).select("cik", F.lit("C").alias("entityName"), F.create_map(F.lit("us-gaap"), concept).alias("facts")).write.json(path)
    facts, concepts, changes = ingest.ingest_companyfacts(spark, path, multi_line=False)
    # Changes are a row for each document in a few packed bytes: by its files' size their table looks small enough to broadcast, by its rows it isn't.
    named = concepts.join(changes.hint("merge"), "cik")  # facts, the most rows, are shuffled for one join only
    return facts.join(named, ["cik", "taxonomy", "concept"]).select("cik", "taxonomy", "concept", "label", "unit", "end", "val", "fy", "document_found")


def a10_ingest_fred(spark, d):
    a, b = _fresh(spark), _fresh(spark)
    docs = sql(spark, d, BY_ORDER).withColumn("id", F.col("cik").cast("string"))
    obs = F.transform("lines", lambda x: F.struct(x.d.alias("date"), x.d.alias("realtime_start"), x.d.alias("realtime_end"), x.l_partkey.cast("string").alias("value")))
    docs.select(F.col("id").alias("series_id"), F.col("n").alias("count"), obs.alias("observations")).write.json(a)
    docs.select(F.array(F.struct("id", F.concat(F.lit("title "), "id").alias("title"))).alias("seriess")).write.json(b)
    rows, meta = ingest.ingest_fred(spark, a, b, multi_line=False)
    return rows.join(meta.select("fred_id", "title"), "fred_id").select("fred_id", "title", "obs_date", "value")


def a11_ingest_bars(spark, d):
    path = _fresh(spark)
    table(spark, d, "prices").select("ticker", F.col("obs_date").cast("timestamp").alias("Date"), F.col("close").alias("Close")).write.option("header", True).csv(path)
    return ingest.ingest_bars(spark, path, "ticker string, Date timestamp, Close double", {"Close": "close"}, "Date")


def a12_ingest_sdmx(spark, d):
    path, docs = _fresh(spark), sql(spark, d, BY_ORDER)
    obs = F.transform("lines", lambda x: F.struct((x.l_linenumber + 1990).alias("_TIME_PERIOD"), x.l_partkey.alias("_OBS_VALUE")))
    series = docs.select(F.concat(F.lit("C"), "cik").alias("_COUNTRY"), F.lit("GDP").alias("_INDICATOR"), F.lit("A").alias("_FREQUENCY"), obs.alias("Obs"))
    series.write.format("xml").option("rowTag", "Series").save(path)
    notes = docs.filter("cik % 2 = 0").select(F.concat(F.lit("C"), "cik").alias("_COUNTRY"), F.lit("GDP").alias("_INDICATOR"), F.concat(F.lit("note "), "cik").alias("_NOTE"))
    notes.write.format("xml").option("rowTag", "Group").mode("append").save(path)
    key = "_COUNTRY string, _INDICATOR string"
    values, heads = ingest.ingest_sdmx(spark, path, f"{key}, _FREQUENCY string", "_TIME_PERIOD int, _OBS_VALUE double", f"{key}, _NOTE string")
    return values.join(heads, ["country", "indicator"]).select("country", "indicator", "frequency", "time_period", "obs_value", "note")


def a13_ingest_csv_strict(spark, d):
    path = _fresh(spark)
    table(spark, d, "supplier").write.option("header", True).csv(path)
    return ingest.ingest_csv_strict(spark, path, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")


def a14_ingest_tsv_text(spark, d):
    path = _fresh(spark)
    table(spark, d, "raw_index").select("cik", "form_type", F.lower("quarter").alias("q")).write.partitionBy("q").option("header", True).option("sep", "\t").csv(path)
    return ingest.ingest_tsv_text(spark, path, ["cik", "form_type"], r"/q=(\d{4}q\d)/")


def a15_ingest_csv_optional(spark, d):
    a, b, rows = _fresh(spark), _fresh(spark), table(spark, d, "supplier")
    rows.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("KEY"), F.format_number("s_suppkey", 0).alias("Amount")).write.option("header", True).csv(a)
    rows.filter("s_suppkey % 2 = 1").select(F.col("s_suppkey").alias("key"), "s_name").write.option("header", True).csv(b)
    return ingest.ingest_csv_optional(spark, [a, b], ["key"], {"key": "long", "amount": "long", "s_name": "string"})


def a17_trading_days(spark, d):
    holidays = sql(spark, d, "SELECT DISTINCT CAST(o_orderdate AS DATE) AS h FROM orders WHERE day(o_orderdate) = 25")
    return raw.trading_days(spark, F.lit("1994-01-01").cast("date"), F.lit("1996-12-31").cast("date"), holidays)


def a18_due_quarters(spark, d):
    landed = sql(spark, d, "SELECT DISTINCT quarter FROM raw_index WHERE month(date_filed) > 3")
    return raw.due_quarters(spark, F.lit("1998-05-20").cast("date"), F.lit("1993-01-01").cast("date"), landed)


def a19_past_watermark(spark, d):
    rows = table(spark, d, "raw_index").select("filename", "date_filed")
    return raw.past_watermark(rows, rows.filter("date_filed < DATE '1997-01-01'"), "date_filed", 30)


def a20_drop_stale(spark, d):
    rows = table(spark, d, "raw_index").select("cik", "filename", "date_filed")
    return raw.drop_stale(rows, rows.filter("date_filed < DATE '1996-01-01'"), "cik", "date_filed")


def a21_complete_runs(spark, d):
    return raw.complete_runs(table(spark, d, "loads").filter("rows_written % 3 > 0"), ["click", "view", "error"])


def b1_fred_observations(spark, d):
    return transforms.fred_observations(table(spark, d, "raw_macro"), table(spark, d, "raw_macro_series"))


def b2_price_observations(spark, d):
    return transforms.price_observations(table(spark, d, "raw_bars"))


def b3_full_pull_flag(spark, d):
    return transforms.full_pull_flag(table(spark, d, "raw_bars")).groupBy("pull_reason", "is_full_pull").agg(F.count("*").alias("n"))


def b4_series_catalog(spark, d):
    watch = sql(spark, d, "SELECT ticker, lower(ticker) AS yahoo_symbol, min(obs_date) AS first_expected, CAST(NULL AS DATE) AS active_to, 1 AS expected_lag_days FROM raw_bars GROUP BY ticker")
    expected = sql(spark, d, "SELECT DISTINCT fred_id, 2 AS expected_lag_days FROM raw_macro UNION ALL SELECT 'ABSENT', 3")
    return transforms.series_catalog(watch, expected, table(spark, d, "raw_macro_series"))


def b5_filings(spark, d):
    return transforms.filings(table(spark, d, "raw_index"), table(spark, d, "sessions"))


def b6_submission_filings(spark, d):
    rows = sql(spark, d, "SELECT cik, filename AS accession_number, CAST(date_filed AS VARCHAR(10)) AS filing_date, CASE WHEN cik % 2 = 0 THEN '' ELSE CAST(date_filed AS VARCHAR(10)) END AS report_date, CAST(date_filed AS VARCHAR(10)) || 'T10:00:00Z' AS acceptance_date_time, form_type AS form FROM raw_index")
    return transforms.submission_filings(rows, table(spark, d, "sessions")).drop("acceptance").select("cik", "accession", "filing_date", "report_date", "form", "quarter", "obs_date", "available_date", "vintage")


def b7_submission_details(spark, d):
    return transforms.submission_details(sql(spark, d, "SELECT s_suppkey AS cik, s_name AS name, '20240105T010203Z' AS run_id FROM supplier"))


def b8_company_facts(spark, d):
    rows = table(spark, d, "raw_facts").withColumnsRenamed({"start_text": "start", "end_text": "end"})
    return transforms.company_facts(rows, table(spark, d, "sessions"))


def b9_company_concepts(spark, d):
    return transforms.company_concepts(sql(spark, d, "SELECT DISTINCT cik, taxonomy, concept, 'Label ' || concept AS label, '20240105T010203Z' AS run_id FROM raw_facts"))


def b10_weo_observations(spark, d):
    return transforms.weo_observations(sql(spark, d, "SELECT user_id AS country, event_type AS indicator, 'A' AS frequency, CAST(2000 + event_id % 25 AS INTEGER) AS year, value, ts AS publication_date, event_id AS update_date FROM events"))


def b11_weo_series(spark, d):
    return transforms.weo_series(sql(spark, d, "SELECT user_id AS country, event_type AS indicator, CAST(month(ts) AS VARCHAR(2)) || '/' || CAST(day(ts) AS VARCHAR(2)) || '/' || CAST(year(ts) AS VARCHAR(4)) AS country_update_date, ts AS publication_date FROM events"))


def b12_wpp_population(spark, d):
    return transforms.wpp_population(sql(spark, d, "SELECT c_nationkey AS LocID, CAST(1990 + c_custkey % 30 AS INTEGER) AS Time, c_acctbal AS PopTotal, 'wpp2024' AS revision, TIMESTAMP '2024-07-11 20:00:00' AS last_modified FROM customer"))


def b13_fsds_pre(spark, d):
    return transforms.fsds_pre(
        sql(
            spark, d, "SELECT CAST(l_orderkey AS VARCHAR(10)) AS adsh, CAST(l_linenumber AS VARCHAR(10)) AS report, CASE WHEN l_partkey % 50 = 0 THEN 'x' ELSE CAST(l_partkey AS VARCHAR(10)) END AS line, l_returnflag AS stmt, CASE WHEN l_linestatus = 'O' THEN '1' ELSE '0' END AS inpth, 'H' AS rfile, l_returnflag || l_linestatus AS tag, 'v' AS version, 'p' AS plabel, '0' AS negating, CAST(year(l_shipdate) AS VARCHAR(4)) || 'q' || CAST(quarter(l_shipdate) AS VARCHAR(1)) AS quarter, l_shipdate AS last_modified FROM lineitem"
        )
    )


def b15_ftc_merger_actions(spark, d):
    return transforms.fiscal_table(sql(spark, d, "SELECT fy AS FY, f AS consents, o AS injunctions, p AS part3, 0 AS abandoned, total, retrieved FROM raw_years"), "ftc_merger_actions")


def b14_hsr_fiscal_year(spark, d):
    cols = ", ".join(f"total AS {c}" for c in list(transforms.FISCAL["hsr_fiscal_year"])[1:])
    return transforms.fiscal_table(sql(spark, d, f"SELECT fy AS FY, {cols}, retrieved FROM raw_years"), "hsr_fiscal_year")


def b16_doj_merger_outcomes(spark, d):
    return transforms.fiscal_table(sql(spark, d, "SELECT fy AS FY, f AS complaints, o AS litigation_complaints, p AS simultaneous_settlement, 0 AS abandoned, f AS resolved_concerns, total AS merger_outcomes, retrieved FROM raw_years"), "doj_merger_outcomes")


def b17_ftc_hmid_hhi(spark, d):
    return transforms.fiscal_table(sql(spark, d, "SELECT fy AS edition_end_fy, 1 AS `table`, 'all' AS markets, f AS post_merger_hhi, o AS delta_hhi, p AS enforced, total AS closed, retrieved FROM raw_years"), "ftc_hmid_hhi")


def b18_ftc_hmid_competitors(spark, d):
    return transforms.fiscal_table(sql(spark, d, "SELECT fy AS edition_end_fy, 2 AS `table`, 'all' AS markets, f AS significant_competitors, p AS enforced, total AS closed, retrieved FROM raw_years"), "ftc_hmid_competitors")


def b19_tickers(spark, d):
    return transforms.tickers(sql(spark, d, "SELECT c_custkey AS cik, upper(c_mktsegment) AS ticker, c_name AS title, '20240105T010203Z' AS run_id FROM customer"))


def b20_row_preserving(spark, d):
    rows = table(spark, d, "raw_macro")
    return quality.assert_row_preserving(rows, transforms.fred_observations(rows, table(spark, d, "raw_macro_series"))).groupBy("series_id").agg(F.count("*").alias("n"))


def b21_require_none(spark, d):
    return quality.require_none(table(spark, d, "prices"), {"no_price": "close IS NULL OR close <= 0", "no_ticker": "ticker IS NULL"})


def b22_assert_catalog(spark, d):
    return transforms.assert_catalog(table(spark, d, "series_catalog"), ["purchase", "click", "view", "error", "signup"], ["D", "M", "Q"]).select("series_id", "source", "frequency")


def b23_assert_sums(spark, d):
    return transforms.assert_sums(table(spark, d, "raw_years"), {"total": "f + o + p"}, "fy = 1900")


def i13_stream_merge(spark, d):
    root, rows = _fresh(spark), table(spark, d, "landings").select(*COLS)
    for runs in (["r1"], ["r2", "r3"]):
        rows.filter(F.col("run_id").isin(runs)).write.parquet(f"{root}/in/{runs[0]}")
        served = stream_merge(spark, f"{root}/in", f"{root}/out", f"{root}/state", ["id"], ["run_id"], ", ".join(f"{n} {t}" for n, t in rows.dtypes), part="quarter")
    return served.select(*COLS)


def k1_build_version(spark, d):
    """Two runs of two groups. The second run's catalog is blocked, so the version serves its observations beside the first run's catalog."""
    root, obs, known = _fresh(spark), sql(spark, d, "SELECT series_id, obs_date, vintage, value FROM obs"), table(spark, d, "series_catalog").select("series_id", "source")
    verdict = lambda macro, ref: spark.createDataFrame([("macro", macro), ("ref", ref)], "source_group string, verdict string")
    publish.publish_groups(spark, root, "r1", {"macro": {"obs": obs.filter("vintage < DATE '2024-01-10'")}, "ref": {"catalog": known.filter("source <> 'view'")}}, verdict("passed", "passed"), ["macro", "ref"])
    publish.publish_groups(spark, root, "r2", {"macro": {"obs": obs}, "ref": {"catalog": known}}, verdict("passed", "blocked"), ["macro", "ref"])
    return publish.served_group(spark, root, "macro", "obs").join(publish.served_group(spark, root, "ref", "catalog"), "series_id", "left")


QUERIES = {k: f for k, f in globals().items() if k[:1] in "abik" and k[1:2].isdigit() and callable(f)}
DATED = "make_date(CAST(fy AS INTEGER), 9, 30) AS obs_date, retrieved AS available_date, retrieved AS vintage FROM raw_years"
SESSION = "(SELECT x.d, min(s.session) AS next FROM (SELECT DISTINCT {0} AS d FROM {1}) x LEFT JOIN sessions s ON s.session > x.d GROUP BY x.d)"
ORACLES = {
    "a1_scan_table": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "a2_raw_snapshots": "SELECT id, val, run_id, CAST(NULL AS VARCHAR) AS act FROM landings WHERE run_id IN ('r1', 'r3')",
    "a3_land_raw": "SELECT 'filings' AS dataset, r.run_id, count(l.id) AS rows_downloaded, count(l.id) AS rows_written, count(l.id) > 0 AS has_file FROM (VALUES ('r1'), ('r2'), ('r9')) r(run_id) LEFT JOIN landings l ON l.run_id = r.run_id GROUP BY r.run_id",
    "a4_write_partitioned": "SELECT id, cik, form, val, quarter, run_id FROM landings",
    "a5_file_ledger": "SELECT count(*) AS n_rows, TRUE AS all_hashed FROM landings WHERE run_id IN ('r1', 'r2')",
    "a7_ingest_index": "SELECT cik, company_name, form_type, date_filed, filename, quarter FROM raw_index",
    "a8_ingest_submissions": "SELECT l_orderkey AS cik, 'Company ' || l_orderkey AS name, 'T' AS ticker, l_orderkey || '-' || l_linenumber AS accession, CAST(l_shipdate AS DATE) AS filed, l_returnflag AS form FROM lineitem",
    "a9_ingest_companyfacts": "SELECT l_orderkey AS cik, 'us-gaap' AS taxonomy, 'Assets' AS concept, 'Total' AS label, 'USD' AS unit, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS \"end\", CAST(l_partkey AS VARCHAR) AS val, l_linenumber AS fy, TRUE AS document_found FROM lineitem",
    "a10_ingest_fred": "SELECT CAST(l_orderkey AS VARCHAR) AS fred_id, 'title ' || l_orderkey AS title, CAST(l_shipdate AS DATE) AS obs_date, CAST(l_partkey AS VARCHAR) AS value FROM lineitem",
    "a11_ingest_bars": "SELECT ticker, obs_date, close FROM prices",
    "a12_ingest_sdmx": "SELECT 'C' || l_orderkey AS country, 'GDP' AS indicator, 'A' AS frequency, CAST(l_linenumber + 1990 AS INTEGER) AS time_period, CAST(l_partkey AS DOUBLE) AS obs_value, CASE WHEN l_orderkey % 2 = 0 THEN 'note ' || l_orderkey END AS note FROM lineitem",
    "a13_ingest_csv_strict": "SELECT * FROM supplier",
    "a14_ingest_tsv_text": "SELECT CAST(cik AS VARCHAR) AS cik, form_type, lower(quarter) AS quarter FROM raw_index",
    "a15_ingest_csv_optional": "SELECT s_suppkey AS key, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey END AS amount, CASE WHEN s_suppkey % 2 = 1 THEN s_name END AS s_name FROM supplier",
    "a17_trading_days": "SELECT CAST(x AS DATE) AS session FROM generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '1996-12-31', INTERVAL 1 DAY) g(x) WHERE dayofweek(x) BETWEEN 1 AND 5 AND CAST(x AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE day(o_orderdate) = 25)",
    "a18_due_quarters": "SELECT DISTINCT year(x) || 'Q' || quarter(x) AS quarter FROM generate_series(TIMESTAMP '1993-01-01', TIMESTAMP '1998-05-20', INTERVAL 3 MONTH) g(x) WHERE x >= DATE '1998-01-01' OR year(x) || 'Q' || quarter(x) NOT IN (SELECT quarter FROM raw_index WHERE month(date_filed) > 3)",
    "a19_past_watermark": "SELECT filename, date_filed FROM raw_index WHERE date_filed >= (SELECT max(date_filed) - 30 FROM raw_index WHERE date_filed < DATE '1997-01-01')",
    "a20_drop_stale": "SELECT r.cik, r.filename, r.date_filed FROM raw_index r LEFT JOIN (SELECT cik, max(date_filed) AS m FROM raw_index WHERE date_filed < DATE '1996-01-01' GROUP BY cik) n ON n.cik = r.cik WHERE n.m IS NULL OR r.date_filed >= n.m",
    "a21_complete_runs": "SELECT run_id FROM loads WHERE rows_written % 3 > 0 AND dataset IN ('click', 'view', 'error') GROUP BY run_id HAVING count(DISTINCT dataset) = 3",
    "b1_fred_observations": "SELECT 'fred:' || o.fred_id AS series_id, o.obs_date, CASE WHEN o.value <> '.' THEN CAST(o.value AS DOUBLE) END AS value, CASE WHEN o.realtime_start <= DATE '2024-01-09' THEN '2012 dollars' ELSE '2017 dollars' END AS units, o.realtime_start AS available_date, o.realtime_start AS vintage, o.run_id FROM raw_macro o",
    "b2_price_observations": "SELECT 'yf:close:' || b.ticker AS series_id, b.obs_date, b.close AS value, 'USD' AS units, b.obs_date AS available_date, (SELECT max(p.pull_end) FROM raw_bars p WHERE p.ticker = b.ticker AND p.pull_reason = 'rebase' AND p.pull_end <= b.pull_end) AS vintage FROM raw_bars b",
    "b3_full_pull_flag": "SELECT pull_reason, pull_reason = 'rebase' AS is_full_pull, count(*) AS n FROM raw_bars GROUP BY pull_reason",
    "b4_series_catalog": """SELECT 'yf:close:' || ticker AS series_id, ticker || ' close' AS name, 'yf' AS source, lower(ticker) AS source_key, 'security' AS entity_type, ticker AS entity_id, 'close' AS measure, 'USD' AS units, 'D' AS frequency,
 'split_adjusted' AS adjustment, 'raw' AS kind, min(obs_date) AS active_from, CAST(NULL AS DATE) AS active_to, 1 AS expected_lag_days FROM raw_bars GROUP BY ticker
 UNION ALL SELECT 'fred:' || fred_id, fred_id || ' title', 'fred', fred_id, 'macro', NULL, fred_id, '2017 dollars', 'D', 'NSA', 'raw', DATE '2000-01-01', NULL, 2 FROM (SELECT DISTINCT fred_id FROM raw_macro) m
 UNION ALL SELECT 'fred:ABSENT', NULL, 'fred', 'ABSENT', 'macro', NULL, 'ABSENT', NULL, NULL, NULL, 'raw', NULL, NULL, 3""",
    "b5_filings": f"SELECT r.cik, regexp_extract(r.filename, '([0-9]+-97-000001)', 1) AS accession, r.form_type AS form, r.company_name AS name, r.date_filed, r.filename, r.quarter, r.cik AS path_cik, r.date_filed AS obs_date, n.next AS available_date, r.date_filed AS vintage FROM raw_index r JOIN {SESSION.format('date_filed', 'raw_index')} n ON n.d = r.date_filed",
    "b6_submission_filings": f"SELECT r.cik, r.filename AS accession, r.date_filed AS filing_date, CASE WHEN r.cik % 2 <> 0 THEN r.date_filed END AS report_date, r.form_type AS form, r.quarter, r.date_filed AS obs_date, n.next AS available_date, r.date_filed AS vintage FROM raw_index r JOIN {SESSION.format('date_filed', 'raw_index')} n ON n.d = r.date_filed",
    "b7_submission_details": "SELECT s_suppkey AS cik, s_name AS name, DATE '2024-01-05' AS obs_date, DATE '2024-01-05' AS available_date, DATE '2024-01-05' AS vintage, '20240105T010203Z' AS run_id FROM supplier",
    "b8_company_facts": f"SELECT r.cik, r.taxonomy, r.concept, r.unit, CAST(NULL AS DATE) AS start_date, CAST(r.end_text AS DATE) AS end_date, CAST(r.val AS DOUBLE) AS val, r.val AS val_sent, r.accn AS accession, r.fy, r.fp, r.form, CAST(r.filed AS DATE) AS filed, r.frame, CAST(r.end_text AS DATE) AS obs_date, n.next AS available_date, CAST(r.filed AS DATE) AS vintage FROM raw_facts r JOIN {SESSION.format('CAST(filed AS DATE)', 'raw_facts')} n ON n.d = CAST(r.filed AS DATE)",
    "b9_company_concepts": "SELECT DISTINCT cik, taxonomy, concept, 'Label ' || concept AS label, DATE '2024-01-05' AS obs_date, DATE '2024-01-05' AS available_date, DATE '2024-01-05' AS vintage, '20240105T010203Z' AS run_id FROM raw_facts",
    "b10_weo_observations": "SELECT user_id AS country, event_type AS indicator, 'A' AS frequency, CAST(2000 + event_id % 25 AS INTEGER) AS year, value, event_id AS update_date, make_date(CAST(2000 + event_id % 25 AS INTEGER), 1, 1) AS obs_date, CAST(ts AS DATE) AS available_date, CAST(ts AS DATE) AS vintage FROM events",
    "b11_weo_series": "SELECT user_id AS country, event_type AS indicator, CAST(ts AS DATE) AS country_update_date, CAST(ts AS DATE) AS obs_date, CAST(ts AS DATE) AS available_date, CAST(ts AS DATE) AS vintage FROM events",
    "b12_wpp_population": "SELECT c_nationkey AS loc_id, CAST(1990 + c_custkey % 30 AS INTEGER) AS year, c_acctbal AS pop_total, 'wpp2024' AS revision, make_date(CAST(1990 + c_custkey % 30 AS INTEGER), 7, 1) AS obs_date, DATE '2024-07-11' AS available_date, DATE '2024-07-11' AS vintage FROM customer",
    "b13_fsds_pre": "SELECT CAST(l_orderkey AS VARCHAR) AS adsh, CAST(l_linenumber AS INTEGER) AS report, CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_partkey AS INTEGER) END AS line, l_returnflag AS stmt, l_linestatus = 'O' AS inpth, 'H' AS rfile, l_returnflag || l_linestatus AS tag, 'v' AS version, 'p' AS plabel, FALSE AS negating, year(l_shipdate) || 'q' || quarter(l_shipdate) AS quarter, CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS obs_date, CAST(l_shipdate AS DATE) AS available_date, CAST(l_shipdate AS DATE) AS vintage FROM lineitem",
    "b14_hsr_fiscal_year": f"SELECT fy AS fiscal_year, total AS transactions_reported, total AS filings_received, total AS adjusted_transactions, total AS second_requests, total AS second_requests_ftc, total AS second_requests_doj, total AS early_termination_requested, total AS early_termination_granted, total AS early_termination_not_granted, {DATED}",
    "b15_ftc_merger_actions": f"SELECT fy AS fiscal_year, f AS consents, o AS injunctions, p AS part3, 0 AS abandoned, total, {DATED}",
    "b16_doj_merger_outcomes": f"SELECT fy AS fiscal_year, f AS complaints, o AS litigation_complaints, p AS simultaneous_settlement, 0 AS abandoned, f AS resolved_concerns, total AS merger_outcomes, {DATED}",
    "b17_ftc_hmid_hhi": f"SELECT fy AS edition_end_fy, 1 AS table_no, 'all' AS markets, f AS post_merger_hhi, o AS delta_hhi, p AS enforced, total AS closed, {DATED}",
    "b18_ftc_hmid_competitors": f"SELECT fy AS edition_end_fy, 2 AS table_no, 'all' AS markets, f AS significant_competitors, p AS enforced, total AS closed, {DATED}",
    "b19_tickers": "SELECT c_custkey AS cik, upper(c_mktsegment) AS ticker, c_name AS title, DATE '2024-01-05' AS obs_date, DATE '2024-01-05' AS available_date, DATE '2024-01-05' AS vintage, '20240105T010203Z' AS run_id FROM customer",
    "b20_row_preserving": "SELECT 'fred:' || fred_id AS series_id, count(*) AS n FROM raw_macro GROUP BY fred_id",
    "b21_require_none": "SELECT ticker, obs_date, close FROM prices",
    "b22_assert_catalog": "SELECT series_id, source, frequency FROM series_catalog",
    "b23_assert_sums": "SELECT fy, total, f, o, p, retrieved FROM raw_years",
    "i13_stream_merge": f"SELECT * FROM {MERGED}",
    "k1_build_version": "SELECT o.series_id, obs_date, vintage, value, CASE WHEN split_part(o.series_id, ':', 2) <> 'view' THEN split_part(o.series_id, ':', 2) END AS source FROM obs o",
}
ORACLES = {k: with_fixtures(v) for k, v in ORACLES.items()}
