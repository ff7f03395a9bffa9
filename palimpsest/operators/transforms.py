"""Raw rows to bitemporal rows, one output row for each input row: what a value describes (obs_date), when it could be known (available_date), which revision it is (vintage)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.joins import asof_by_distinct, asof_join
from palimpsest.operators.quality import require_none

LINEAGE = ["run_id", "loaded_at"]
OPEN_END = "9999-12-31"


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def _dated(df: DataFrame, cols: list[Column | str], obs_date: Column, known: Column) -> DataFrame:
    """`cols`, the three dates (known and revised on one day) and lineage."""
    return df.select(*cols, obs_date.alias("obs_date"), known.alias("available_date"), known.alias("vintage"), *_lineage(df))


def _utc_date(stamp: str) -> Column:
    """The date of a stamp in UTC, whatever the session's zone is."""
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(stamp).cast("timestamp_ntz")))


def fred_observations(raw_obs: DataFrame, raw_series: DataFrame) -> DataFrame:
    """Macro vintages: "." is a withdrawn value, any other text must be a number. Units are those of the window, in the newest run's metadata, that holds the vintage."""
    newest = raw_series.withColumn("_newest", F.max("run_id").over(Window.partitionBy("fred_id"))).filter("run_id = _newest")
    windows = newest.select(F.col("fred_id").alias("_id"), F.col("realtime_start").alias("_from"), F.col("realtime_end").alias("_to"), "units").distinct()
    met = raw_obs.join(windows, (F.col("fred_id") == F.col("_id")) & F.col("realtime_start").between(F.col("_from"), F.col("_to")), "left")
    value = F.when(F.col("value") != ".", F.col("value")).cast("double")
    return met.select(
        F.concat(F.lit("fred:"), "fred_id").alias("series_id"), "obs_date", value.alias("value"), "units", F.col("realtime_start").alias("available_date"), F.col("realtime_start").alias("vintage"), *_lineage(raw_obs)
    )


def full_pull_flag(df: DataFrame, reason: str = "pull_reason", full: tuple[str, ...] = ("bootstrap", "rebase", "correction", "split_flag", "no_overlap", "window_extended"), part: tuple[str, ...] = ("incremental",)) -> DataFrame:
    """`is_full_pull` from the reason of the pull; an unknown reason raises."""
    r = F.col(reason)
    unknown = F.raise_error(F.concat(F.lit("unknown pull reason: "), F.coalesce(r, F.lit("null"))))
    return df.withColumn("is_full_pull", F.when(r.isin(*full), True).when(r.isin(*part), False).otherwise(unknown))


def price_observations(raw: DataFrame, source: str = "yf") -> DataFrame:
    """Bars as observations. A vintage is the day of the ticker's latest full pull at or before the bar's own pull: later incremental bars belong to it.

    Distinct pulls are looked up and joined back by equality, so a ticker of very many bars isn't one task's work."""
    flagged = full_pull_flag(raw)
    pulls = flagged.filter("is_full_pull").select("ticker", F.col("pull_end").alias("vintage")).distinct()
    asked = flagged.select("ticker", "pull_end").distinct()
    met = flagged.join(asof_join(asked, pulls, "pull_end", "vintage", ["ticker"], ["vintage"]), ["ticker", "pull_end"], "left")
    series = F.concat(F.lit(f"{source}:close:"), "ticker")
    return met.select(series.alias("series_id"), "obs_date", F.col("close").alias("value"), F.lit("USD").alias("units"), F.col("obs_date").alias("available_date"), "vintage", *_lineage(raw))


def series_catalog(watchlist: DataFrame, expected: DataFrame, raw_series: DataFrame) -> DataFrame:
    """A row for every expected series: watched tickers, and configured macro series with their current metadata (open window, newest run), which may be absent."""
    w = Window.partitionBy("fred_id").orderBy(F.desc("run_id"))
    current = raw_series.filter(F.col("realtime_end") == F.lit(OPEN_END).cast("date")).withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("run_id", "_n")
    text = lambda c: F.lit(c).cast("string")
    tickers = watchlist.select(
        F.concat(F.lit("yf:close:"), "ticker").alias("series_id"), F.concat("ticker", F.lit(" close")).alias("name"), text("yf").alias("source"), F.col("yahoo_symbol").alias("source_key"), text("security").alias("entity_type"),
        F.col("ticker").alias("entity_id"), text("close").alias("measure"), text("USD").alias("units"), text("D").alias("frequency"), text("split_adjusted").alias("adjustment"), text("raw").alias("kind"),
        F.col("first_expected").alias("active_from"), "active_to", "expected_lag_days",
    )
    macro = expected.join(current, "fred_id", "left").select(
        F.concat(F.lit("fred:"), "fred_id").alias("series_id"), F.col("title").alias("name"), text("fred").alias("source"), F.col("fred_id").alias("source_key"), text("macro").alias("entity_type"), text(None).alias("entity_id"),
        F.col("fred_id").alias("measure"), "units", F.col("frequency_short").alias("frequency"), F.col("seasonal_adjustment_short").alias("adjustment"), text("raw").alias("kind"),
        F.col("observation_start").cast("date").alias("active_from"), F.lit(None).cast("date").alias("active_to"), "expected_lag_days",
    )
    return tickers.unionByName(macro)


def filings(raw: DataFrame, sessions: DataFrame) -> DataFrame:
    """Filing index rows: accession and company number from the path, public from the next session on."""
    met = asof_by_distinct(raw, "date_filed", sessions, "session", "available_date")
    accession = F.regexp_extract("filename", r"^edgar/data/\d+/(\d{10}-\d\d-\d{6})\.txt$", 1)
    path_cik = F.regexp_extract("filename", r"^edgar/data/(\d+)/", 1).try_cast("long")
    return met.select(
        "cik", accession.alias("accession"), F.col("form_type").alias("form"), F.col("company_name").alias("name"), "date_filed", "filename", "quarter", path_cik.alias("path_cik"),
        F.col("date_filed").alias("obs_date"), "available_date", F.col("date_filed").alias("vintage"), *_lineage(raw),
    )


def submission_filings(raw: DataFrame, sessions: DataFrame) -> DataFrame:
    """Filing history rows: dates from text (an empty report date is none), acceptance as a stamp, quarter YYYYQn; other columns pass through."""
    day = F.col("filing_date").cast("date")
    typed = raw.withColumns({"filing_date": day, "report_date": F.nullif(F.col("report_date"), F.lit("")).cast("date"), "acceptance": F.col("acceptance_date_time").cast("timestamp"), "obs_date": day, "vintage": day})
    named = typed.withColumn("quarter", F.concat(F.year("filing_date"), F.lit("Q"), F.quarter("filing_date"))).withColumnRenamed("accession_number", "accession").drop("acceptance_date_time")
    return asof_by_distinct(named, "filing_date", sessions, "session", "available_date")


def submission_details(raw: DataFrame) -> DataFrame:
    """Company details, dated by the run that landed them."""
    day = F.to_date(F.to_timestamp_ntz("run_id", F.lit("yyyyMMdd'T'HHmmss'Z'")))
    return _dated(raw, [c for c in raw.columns if c not in LINEAGE], day, day)


def company_facts(raw: DataFrame, sessions: DataFrame) -> DataFrame:
    """Facts: typed dates, the value as a number beside the text that was sent, public from the session after the filing."""
    typed = raw.select("cik", "taxonomy", "concept", "unit", F.col("start").cast("date").alias("start_date"), F.col("end").cast("date").alias("end_date"), F.col("val").cast("double").alias("val"),
                       F.col("val").alias("val_sent"), F.col("accn").alias("accession"), "fy", "fp", "form", F.col("filed").cast("date").alias("filed"), "frame", *_lineage(raw))
    met = asof_by_distinct(typed, "filed", sessions, "session", "available_date")
    return met.withColumns({"obs_date": F.col("end_date"), "vintage": F.col("filed")})


def company_concepts(raw: DataFrame) -> DataFrame:
    """Concept labels as of the run that landed them."""
    return submission_details(raw)


def weo_observations(raw: DataFrame) -> DataFrame:
    """Yearly values: the period is January 1, the vintage the UTC date of publication."""
    cols = ["country", "indicator", "frequency", "year", "value", "update_date"]
    return _dated(raw, cols, F.make_date("year", F.lit(1), F.lit(1)), _utc_date("publication_date"))


def weo_series(raw: DataFrame) -> DataFrame:
    """Series notes of an edition; the country's update date must read month/day/year."""
    typed = raw.withColumn("country_update_date", F.to_date("country_update_date", "M/d/yyyy"))
    return _dated(typed, [c for c in raw.columns if c not in [*LINEAGE, "publication_date"]], _utc_date("publication_date"), _utc_date("publication_date"))


#: Column names of the published population file and the names used here.
POPULATION = {
    "SortOrder": "sort_order", "LocID": "loc_id", "Notes": "notes", "ISO3_code": "iso3_code", "ISO2_code": "iso2_code", "SDMX_code": "sdmx_code", "LocTypeID": "loc_type_id", "LocTypeName": "loc_type_name", "ParentID": "parent_id",
    "Location": "location", "VarID": "var_id", "Variant": "variant", "Time": "year", "MidPeriod": "mid_period", "PopMale": "pop_male", "PopFemale": "pop_female", "PopTotal": "pop_total", "PopDensity": "pop_density",
}


def wpp_population(raw: DataFrame) -> DataFrame:
    """Population at July 1, known since the file's last change."""
    cols = [F.col(c).alias(n) for c, n in POPULATION.items() if c in raw.columns]
    return _dated(raw, [*cols, "revision"], F.make_date(F.col("Time").cast("int"), F.lit(7), F.lit(1)), _utc_date("last_modified"))


def fsds_pre(raw: DataFrame) -> DataFrame:
    """Presentation rows: numbers that aren't become null, flags are true for 1, the period is the last day of the quarter (2026q3)."""
    q = F.col("quarter")
    ends = F.last_day(F.make_date(F.left(q, F.lit(4)).cast("int"), F.right(q, F.lit(1)).cast("int") * 3, F.lit(1)))
    cols = ["adsh", F.col("report").try_cast("int").alias("report"), F.col("line").try_cast("int").alias("line"), "stmt", (F.col("inpth") == "1").alias("inpth"), "rfile", "tag", "version", "plabel",
            (F.col("negating") == "1").alias("negating"), "quarter"]
    return _dated(raw, cols, ends, _utc_date("last_modified"))


#: Yearly merger files; published column names and the names used here. A fiscal year ends on September 30.
FISCAL = {
    "hsr_fiscal_year": {
        "FY": "fiscal_year", "TransactionsReported": "transactions_reported", "FilingsReceived": "filings_received", "AdjustedTransactions": "adjusted_transactions", "SecondRequestTotal": "second_requests",
        "SecondRequestFTC": "second_requests_ftc", "SecondRequestDOJ": "second_requests_doj", "EarlyTerminationTransactions": "early_termination_requested",
        "EarlyTerminationTransactionsGranted": "early_termination_granted", "EarlyTerminationTransactionsNotGranted": "early_termination_not_granted",
    },
    "ftc_merger_actions": {"FY": "fiscal_year", "consents": "consents", "injunctions": "injunctions", "part3": "part3", "abandoned": "abandoned", "total": "total"},
    "doj_merger_outcomes": {
        "FY": "fiscal_year", "complaints": "complaints", "litigation_complaints": "litigation_complaints", "simultaneous_settlement": "simultaneous_settlement", "abandoned": "abandoned",
        "resolved_concerns": "resolved_concerns", "merger_outcomes": "merger_outcomes",
    },
    "ftc_hmid_hhi": {"edition_end_fy": "edition_end_fy", "table": "table_no", "markets": "markets", "post_merger_hhi": "post_merger_hhi", "delta_hhi": "delta_hhi", "enforced": "enforced", "closed": "closed"},
    "ftc_hmid_competitors": {"edition_end_fy": "edition_end_fy", "table": "table_no", "markets": "markets", "significant_competitors": "significant_competitors", "enforced": "enforced", "closed": "closed"},
}


def fiscal_table(raw: DataFrame, name: str) -> DataFrame:
    """A yearly merger file under the names of FISCAL, dated by the end of its fiscal year and known since it was retrieved."""
    names = FISCAL[name]
    return _dated(raw, [F.col(c).alias(n) for c, n in names.items()], F.make_date(F.col(next(iter(names))).cast("int"), F.lit(9), F.lit(30)), F.col("retrieved"))


def tickers(raw: DataFrame) -> DataFrame:
    """A ticker list, dated by the run that landed it."""
    return submission_details(raw)


def assert_catalog(df: DataFrame, sources: list[str], frequencies: list[str]) -> DataFrame:
    """The catalog, if every row has a start and a frequency, and only known sources and frequencies occur."""
    listed = lambda xs: ", ".join(f"'{x}'" for x in xs)
    return require_none(df, {"no_frequency": "frequency IS NULL", "no_start": "active_from IS NULL", "unknown_source": f"NOT coalesce(source IN ({listed(sources)}), false)", "unknown_frequency": f"frequency NOT IN ({listed(frequencies)})"})


def assert_sums(df: DataFrame, rules: dict[str, str], exempt: str = "false") -> DataFrame:
    """df, if its totals are the sums of their parts in all rows but the exempt ones. rules: total column to the SQL of its parts; null totals equal null sums."""
    return require_none(df, {f"{total}_off": f"NOT ({total} <=> ({parts})) AND NOT ({exempt})" for total, parts in rules.items()})
