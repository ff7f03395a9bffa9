"""The platform's checks: each gives the rows that fail, none if it passes. Clocks, limits and tables are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.joins import CALENDAR_DAYS
from palimpsest.operators.windows import product


def day(text: str) -> Column:
    return F.lit(text).cast("date")


# Dates of series


def due_period(frequency: Column, lag: Column, today: str) -> Column:
    """First day of the last month or quarter that is over and whose lag has passed; null for other frequencies."""
    at = F.date_sub(day(today), lag.cast("int"))
    return F.when(frequency == "M", F.add_months(F.trunc(at, "month"), -1)).when(frequency == "Q", F.add_months(F.trunc(at, "quarter"), -3))


def periods_behind(catalog: DataFrame, obs: DataFrame, calendar: DataFrame, today: str) -> DataFrame:
    """Active series with their last date, due date and how many periods they are behind it; null where the frequency can't be counted or there is no row.

    Daily series count sessions of the calendar up to today less their lag, monthly and quarterly ones periods. The calendar travels as one array; one of more than CALENDAR_DAYS days stops.
    """
    days = F.array_sort(F.collect_set("session"))
    sessions = calendar.agg(F.when(F.count_distinct("session") > CALENDAR_DAYS, F.raise_error(F.lit("a calendar of too many days")).cast("array<date>")).otherwise(days).alias("_days"))
    last = obs.groupBy("series_id").agg(F.max("obs_date").alias("last_date"))
    rows = catalog.filter(F.col("active_to").isNull()).join(last, "series_id", "left").join(F.broadcast(sessions))  # one row
    until = F.date_sub(day(today), F.col("expected_lag_days").cast("int"))
    in_time = F.filter("_days", lambda x: x <= until)
    due = F.when(F.col("frequency") == "D", F.try_element_at(in_time, F.lit(-1))).otherwise(due_period(F.col("frequency"), F.col("expected_lag_days"), today))
    missed = F.size(F.filter(in_time, lambda x: x > F.col("last_date")))
    months = F.months_between(due, F.trunc("last_date", "month"))
    behind = F.when(F.col("frequency") == "D", missed).when(F.col("frequency") == "M", months).when(F.col("frequency") == "Q", F.floor(months / 3))
    return rows.select("series_id", "frequency", "last_date", due.alias("due"), F.greatest(F.when(F.col("last_date").isNotNull(), behind), F.lit(0)).cast("long").alias("_b")).select(
        "series_id", "frequency", "last_date", "due", F.when(F.col("last_date").isNotNull() & F.col("frequency").isin("D", "M", "Q"), F.col("_b")).alias("behind")
    )


def late_series(behind: DataFrame) -> DataFrame:
    return behind.filter("behind = 1")


def stale_series(behind: DataFrame) -> DataFrame:
    """Two or more periods behind, or not to be counted."""
    problem = F.when(F.col("last_date").isNull(), "no_rows").when(F.col("behind").isNull(), "uncountable").when(F.col("behind") >= 2, "stale")
    return behind.withColumn("problem", problem).filter("problem IS NOT NULL")


def expected_dates(obs: DataFrame, catalog: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dates that each series should have, with `present`: sessions for daily series, months or every third month for others, from active_from to active_to or the last row of any vintage.

    Every series spells out its own days, which meet the calendar by equality: no range join.
    """
    last = obs.groupBy("series_id").agg(F.max("obs_date").alias("_last"))
    rows = catalog.join(last, "series_id").withColumn("_end", F.coalesce("active_to", "_last"))
    days = rows.filter("frequency = 'D' AND active_from <= _end").select("series_id", F.explode(F.sequence("active_from", "_end")).alias("obs_date"))
    days = days.join(calendar.select(F.col("session").alias("obs_date")).distinct(), "obs_date", "left_semi")
    periods = []
    for frequency, unit, months in (("M", "month", 1), ("Q", "quarter", 3)):
        first = F.when(F.trunc("active_from", unit) < F.col("active_from"), F.add_months(F.trunc("active_from", unit), months)).otherwise(F.col("active_from"))
        some = rows.filter(F.col("frequency") == frequency).withColumn("_first", first).filter("_first <= _end")
        periods.append(some.select("series_id", F.explode(F.sequence("_first", "_end", F.expr(f"INTERVAL {months} MONTH"))).alias("obs_date")))
    every = days.select("series_id", "obs_date").unionByName(periods[0]).unionByName(periods[1])
    held = obs.select("series_id", "obs_date").distinct().withColumn("_held", F.lit(True))
    return every.join(held, ["series_id", "obs_date"], "left").select("series_id", "obs_date", F.coalesce("_held", F.lit(False)).alias("present"))


def missing_dates(expected: DataFrame) -> DataFrame:
    return expected.filter("NOT present").drop("present")


def baseline_metrics(obs: DataFrame, catalog: DataFrame) -> DataFrame:
    spans = obs.groupBy("series_id").agg(F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"), F.count_distinct("obs_date").alias("n_dates"))
    return catalog.select("series_id").join(spans, "series_id", "left").withColumn("n_dates", F.coalesce("n_dates", F.lit(0)))


def baseline_drift(metrics: DataFrame, recorded: DataFrame) -> DataFrame:
    """Series whose history shrank against the recorded metrics (fewer dates or a later start), or that have none recorded."""
    old = recorded.select("series_id", F.col("n_dates").alias("baseline"), F.col("first_date").alias("_first"), F.lit(True).alias("_recorded"))
    rows = metrics.join(old, "series_id", "left")
    problem = F.when(F.col("_recorded").isNull(), "no_baseline").when(F.col("n_dates") < F.col("baseline"), "fewer_dates").when(F.col("first_date") > F.col("_first"), "later_start")
    return rows.select("series_id", "baseline", F.col("n_dates").alias("now"), problem.alias("problem")).filter("problem IS NOT NULL")


# Series and catalog


def required_series(catalog: DataFrame, required: DataFrame, excused: DataFrame, keys: list[str]) -> DataFrame:
    """Required rows of entity and measure that the catalog lacks and no load error excuses."""
    return required.join(catalog.select(*keys).distinct(), keys, "left_anti").join(excused.select(*keys).distinct(), keys, "left_anti")


def expected_product(entities: DataFrame, name: str, measures: list[str]) -> DataFrame:
    """Every entity with every one of a short list of measures; the list is written out per row, nothing is joined."""
    return entities.distinct().withColumn(name, F.explode(F.array(*map(F.lit, measures))))


def catalog_integrity(obs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Series with rows but no catalog row, and active ones with neither."""
    a, b = obs.select("series_id").distinct(), catalog.filter(F.col("active_to").isNull()).select("series_id")
    return a.join(catalog, "series_id", "left_anti").withColumn("problem", F.lit("no_catalog_row")).unionByName(b.join(a, "series_id", "left_anti").withColumn("problem", F.lit("no_rows")))


def source_missing(obs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Ended series that were never served."""
    return catalog.filter(F.col("active_to").isNotNull()).join(obs.select("series_id").distinct(), "series_id", "left_anti").select("series_id")


def withdrawn_values(latest: DataFrame, catalog: DataFrame) -> DataFrame:
    """Dates inside the active window whose latest vintage has no value."""
    rows = latest.filter("value IS NULL").join(catalog.select("series_id", "active_from", "active_to"), "series_id")
    return rows.filter("obs_date >= active_from AND (active_to IS NULL OR obs_date <= active_to)").select("series_id", "obs_date", "vintage")


# Rows


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; null is a key like any other."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def silent_corrections(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with different values, or with a value and none."""
    sums = df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.bool_or(F.col(value).isNull()).alias("some_null"))
    return sums.filter("lo <> hi OR (some_null AND lo IS NOT NULL)")


def price_jumps(prices: DataFrame, by: str, at: str, close: str, limit: float) -> DataFrame:
    rows = prices.withColumn("prev", F.lag(close).over(Window.partitionBy(by).orderBy(at)))
    return rows.filter(F.abs(F.try_divide(close, "prev") - 1) > limit).select(by, at, close, "prev")


def oddities(df: DataFrame, rules: dict[str, str], keys: list[str]) -> DataFrame:
    """Per rule that rows meet: how many, and the least key as an example. One pass counts for all rules."""
    met = F.array_compact(F.array(*(F.when(F.expr(c), F.lit(n)) for n, c in rules.items())))
    return df.select(F.explode(met).alias("rule"), F.struct(*keys).alias("_k")).groupBy("rule").agg(F.count("*").alias("n"), F.to_json(F.min("_k")).alias("example"))


def conform(df: DataFrame, declared: dict[str, tuple[str, int | None]], key: list[str], parent: DataFrame | None = None, parent_key: str | None = None) -> DataFrame:
    """Departures from a declared schema, per column and problem with their number: undeclared and absent columns, values that aren't of the type or too long, repeated keys, orphans."""
    problems = [(c, "undeclared") for c in df.columns if c not in declared] + [(c, "absent") for c in declared if c not in df.columns]
    there = {c: x for c, x in declared.items() if c in df.columns}
    counts = [F.struct(F.lit(c).alias("column"), F.lit("type").alias("problem"), F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias("n")) for c, (t, _) in there.items()]
    counts += [F.struct(F.lit(c).alias("column"), F.lit("length").alias("problem"), F.count_if(F.char_length(F.col(c).cast("string")) > n).alias("n")) for c, (_, n) in there.items() if n]
    out = df.agg(F.array(*counts).alias("x")).select(F.inline("x"))
    schema = "column string, problem string, n long"
    out = out.unionByName(df.sparkSession.createDataFrame([(c, p, 1) for c, p in problems], schema))
    name = ",".join(key)
    out = out.unionByName(df.groupBy(*key).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n")).select(F.lit(name).alias("column"), F.lit("repeated").alias("problem"), "n"))
    if parent is not None:
        orphans = df.join(parent.select(F.col(parent_key).alias(parent_key)).distinct(), parent_key, "left_anti").agg(F.count("*").alias("n"))
        out = out.unionByName(orphans.select(F.lit(parent_key).alias("column"), F.lit("orphan").alias("problem"), "n"))
    return out.filter("n > 0")


def coverage_gaps(df: DataFrame, evidence: DataFrame, left: str, right: str) -> DataFrame:
    """Members without evidence."""
    return df.join(evidence.select(F.col(right).alias("_r")), F.col(left) == F.col("_r"), "left_anti").select(left)


# Loads, runs and files


def control_totals(loads: DataFrame) -> DataFrame:
    return loads.filter("NOT (rows_downloaded <=> rows_written)").select("run_id", "dataset", "rows_downloaded", "rows_written")


def raw_reconciliation(loads: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Files against the load log, by keys: missing files, files without a record, changed counts or hashes. Both hold rows and hash."""
    a, b = (d.select(*keys, F.struct("rows", "hash").alias(n)) for d, n in ((loads, "_a"), (files, "_b")))
    problem = (
        F.when(F.col("_a").isNull(), "no_record").when(F.col("_b").isNull(), "missing").when(~F.col("_a.rows").eqNullSafe(F.col("_b.rows")), "count").when(~F.col("_a.hash").eqNullSafe(F.col("_b.hash")), "hash")
    )
    return a.join(b, keys, "full").select(*keys, problem.alias("problem")).filter("problem IS NOT NULL")


def last_publish_age(manifest: DataFrame, clock: str, hours: int) -> DataFrame:
    """One row if the last published run is older than the limit or there is none."""
    newest = manifest.agg(F.max(F.when(F.col("outcome") == "published", F.col("loaded_at"))).alias("newest"))
    return newest.filter(F.col("newest").isNull() | (F.col("newest") < F.expr(f"TIMESTAMP '{clock}' - INTERVAL {hours} HOUR")))


def landing_age(loads: DataFrame, clock: str, hours: int, datasets: list[str]) -> DataFrame:
    """Datasets whose newest landing is older than the limit or that have none."""
    newest = loads.filter(F.col("dataset").isin(datasets)).groupBy("dataset").agg(F.max("loaded_at").alias("newest"))
    wanted = loads.sparkSession.createDataFrame([(d,) for d in datasets], "dataset string").join(newest, "dataset", "left")
    return wanted.filter(F.col("newest").isNull() | (F.col("newest") < F.expr(f"TIMESTAMP '{clock}' - INTERVAL {hours} HOUR")))


def carried_forward(manifest: DataFrame) -> DataFrame:
    """Groups carried forward in the latest run of all."""
    latest = manifest.agg(F.max_by("run_id", F.struct("loaded_at", "run_id")).alias("run_id"))
    return manifest.filter("outcome = 'carried_forward'").join(F.broadcast(latest), "run_id", "left_semi").select("run_id", "dataset")  # one row


def group_stale(manifest: DataFrame, runs: int = 2) -> DataFrame:
    """Groups that weren't published in their last `runs` runs, with how many runs ago they were, or never."""
    ranked = manifest.withColumn("_rk", F.row_number().over(Window.partitionBy("dataset").orderBy(F.desc("loaded_at"), "run_id")))
    fresh = ranked.groupBy("dataset").agg((F.min(F.when(F.col("outcome") == "published", F.col("_rk"))) - 1).cast("long").alias("runs_ago"))
    return fresh.filter(F.col("runs_ago").isNull() | (F.col("runs_ago") >= runs))


def run_not_recorded(loads: DataFrame, manifest: DataFrame, clock: str, hours: int) -> DataFrame:
    """Runs that loaded data, have no manifest and ended too long ago to be running still."""
    ended = loads.groupBy("run_id").agg(F.max("loaded_at").alias("ended"))
    return ended.join(manifest.select("run_id").distinct(), "run_id", "left_anti").filter(F.col("ended") < F.expr(f"TIMESTAMP '{clock}' - INTERVAL {hours} HOUR"))


def series_failed(loads: DataFrame, run_id: str, notes: str) -> DataFrame:
    """Series left out of a run's load, with their errors, from the load's JSON notes."""
    parsed = F.from_json(notes, "array<struct<series string, error string>>")
    return loads.filter(F.col("run_id") == run_id).select("run_id", F.inline(parsed))


# Publications


def index_freshness(filings: DataFrame, at: str, today: str, weekdays: int) -> DataFrame:
    """The latest filing, if more weekdays than allowed have passed since."""
    newest = filings.agg(F.max(at).alias("newest"))
    passed = F.when(F.col("newest") < day(today), F.size(F.filter(F.sequence(F.date_add("newest", 1), day(today)), lambda x: F.dayofweek(x).between(2, 6)))).otherwise(0)
    return newest.withColumn("weekdays", passed.cast("long")).filter(F.col("weekdays") > weekdays)


def edition_age(df: DataFrame, at: str, today: str, months: int) -> DataFrame:
    return df.agg(F.max(at).alias("newest")).filter(F.col("newest") < F.add_months(day(today), -months))


def revision_age(df: DataFrame, name: str, today: str, years: int) -> DataFrame:
    """The newest revision, if the year in its name lies too far back."""
    year = F.regexp_extract(name, "([0-9]{4})", 1).try_cast("int")
    return df.agg(F.max(year).alias("y")).filter(F.col("y") <= F.year(day(today)) - years)


def quarter_served(df: DataFrame, at: str, today: str) -> DataFrame:
    """The newest quarter served, if it is before the last complete one."""
    return df.agg(F.trunc(F.max(at), "quarter").alias("newest")).filter(F.col("newest") < F.add_months(F.trunc(day(today), "quarter"), -3))


def fiscal_year_age(df: DataFrame, year: str, today: str, months: int) -> DataFrame:
    """The newest fiscal year, if it ended (30 September) too long ago."""
    return df.agg(F.max(year).alias(year)).filter(F.make_date(F.col(year), F.lit(9), F.lit(30)) < F.add_months(day(today), -months))


def quarters_missing(df: DataFrame, at: str) -> DataFrame:
    """Quarters without rows between the first and the last."""
    held = df.select(F.trunc(at, "quarter").alias("q")).filter("q IS NOT NULL").distinct()
    span = held.agg(F.min("q").alias("a"), F.max("q").alias("b")).filter("a IS NOT NULL")
    return span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 3 MONTH"))).alias("q")).join(held, "q", "left_anti")


# Prices of two sources


def reconcile_prices(obs: DataFrame, ref: DataFrame, reclassified: DataFrame) -> DataFrame:
    """Both closes on every common date, the second source's brought to the first's basis, and their gap.

    A close is divided by the split factors of later dates; where one of them is 0, or a distribution takes the whole close, there is no close to compare. A reviewed distribution (ticker, obs_date, amount) makes a factor of the close before it: 1 - amount / previous close.
    """
    w = Window.partitionBy("ticker").orderBy("obs_date")
    rows = ref.join(reclassified.select("ticker", "obs_date", "amount"), ["ticker", "obs_date"], "left").withColumn("_prev", F.lag("close").over(w))
    own = F.try_divide(F.coalesce(F.col("split_factor"), F.lit(1.0)), F.coalesce(1 - F.try_divide("amount", "_prev"), F.lit(1.0)))
    rows = rows.withColumn("_own", own)
    later = product(F.col("_own"), w.rowsBetween(1, Window.unboundedFollowing))
    adjusted = rows.select("ticker", "obs_date", F.try_divide("close", later).alias("ref_close"))
    both = obs.select("ticker", "obs_date", "close").join(adjusted, ["ticker", "obs_date"])
    return both.withColumn("gap", F.try_divide(F.abs(F.col("close") - F.col("ref_close")), F.col("close")))


def second_source(reconciled: DataFrame, watch: DataFrame, tolerance: float) -> DataFrame:
    """Dates whose gap is above the tolerance, and watched tickers without a common date."""
    off = reconciled.filter(F.col("gap") > tolerance).select("ticker", "obs_date", F.lit("gap").alias("problem"))
    none = watch.select("ticker").distinct().join(reconciled.select("ticker").distinct(), "ticker", "left_anti")
    return off.unionByName(none.select("ticker", F.lit(None).cast("date").alias("obs_date"), F.lit("no_common_dates").alias("problem")))


def audit(reconciled: DataFrame, tolerance: float, least: int = 0, watch: DataFrame | None = None) -> DataFrame:
    """Each date above the tolerance: isolated if neither neighbour is, else not. A ticker with fewer than `least` dates compared has one row of its own, too_few, without a date; `watch` names tickers that may have none."""
    w = Window.partitionBy("ticker").orderBy("obs_date")
    over = F.col("gap") > tolerance
    rows = reconciled.withColumn("_over", over).withColumn("_near", F.coalesce(F.lag(over).over(w), F.lit(False)) | F.coalesce(F.lead(over).over(w), F.lit(False)))
    found = rows.filter("_over").select("ticker", "obs_date", F.when(F.col("_near"), "not_isolated").otherwise("isolated").alias("kind"))
    if not least:
        return found
    names = reconciled.select("ticker") if watch is None else reconciled.select("ticker").unionByName(watch.select("ticker"))
    compared = reconciled.filter("gap IS NOT NULL").groupBy("ticker").agg(F.count("*").alias("_n"))
    few = names.distinct().join(compared, "ticker", "left").filter(F.coalesce("_n", F.lit(0)) < least)
    return found.unionByName(few.select("ticker", F.lit(None).cast("date").alias("obs_date"), F.lit("too_few").alias("kind")))


def reconcile_summary(reconciled: DataFrame, tolerance: float) -> DataFrame:
    """Per ticker: dates compared, those without a gap, median and largest gap, the date of the largest (gaps are told apart to nine digits, the later date of equal ones), dates above the tolerance."""
    where = F.max_by("obs_date", F.struct(F.round("gap", 9), "obs_date"))
    return reconciled.groupBy("ticker").agg(F.count("*").alias("common_dates"), F.count_if(F.col("gap").isNull()).alias("nulls"), F.median("gap").alias("median_gap"), F.max("gap").alias("max_gap"), where.alias("worst_date"), F.count_if(F.col("gap") > tolerance).alias("over"))


def compare_events(a: DataFrame, b: DataFrame, key: str, at: str) -> DataFrame:
    """Per key: events of both sources, of the first alone, of the second alone."""
    both = a.select(key, at, F.lit(True).alias("_a")).join(b.select(key, at, F.lit(True).alias("_b")), [key, at], "full")
    return both.groupBy(key).agg(F.count_if(F.col("_a") & F.col("_b")).alias("both_have"), F.count_if(F.col("_b").isNull()).alias("only_a"), F.count_if(F.col("_a").isNull()).alias("only_b"))


def reference_completeness(active: DataFrame, ref: DataFrame) -> DataFrame:
    return active.select("ticker").distinct().join(ref.select("ticker").distinct(), "ticker", "left_anti")


def reference_freshness(ref: DataFrame, calendar: DataFrame, today: str) -> DataFrame:
    """Tickers whose latest date is before the last session up to today."""
    due = calendar.filter(F.col("session") <= day(today)).agg(F.max("session").alias("due"))
    return ref.groupBy("ticker").agg(F.max("obs_date").alias("newest")).join(F.broadcast(due)).filter("newest < due")  # one row


# Versions and runs


def rows_by_source(rows: DataFrame, name: Column) -> DataFrame:
    """Failing rows of each source; rows without one belong to the run."""
    return rows.groupBy(F.coalesce(F.nullif(name, F.lit("")), F.lit("run")).alias("source")).agg(F.count("*").alias("failing"))


def compose(groups: DataFrame, verdicts: DataFrame, attempted: DataFrame, previous: DataFrame, run_id: str) -> DataFrame:
    """Per group its outcome, the run whose data are served, and the reason.

    published if its verdict passed; blocked or failed if its verdict says so and nothing was served before; carried_forward, with that reason, if something was; a group that wasn't
    attempted is not_run, or carried forward too; one that was attempted without a verdict and never served is never_published.
    """
    rows = groups.join(verdicts, "source_group", "left").join(attempted.withColumn("_tried", F.lit(True)), "source_group", "left").join(previous.select("source_group", F.col("run_id").alias("_previous")), "source_group", "left")
    reason = F.when(F.col("_tried").isNull(), "not_run").when(F.col("verdict").isNull(), "no_verdict").otherwise(F.col("verdict"))
    outcome = F.when(reason == "passed", "published").when(F.col("_previous").isNotNull(), "carried_forward").when(reason == "no_verdict", "never_published").otherwise(reason)
    return rows.select("source_group", outcome.alias("outcome"), F.when(outcome == "published", run_id).otherwise(F.col("_previous")).alias("source_run"), F.when(reason != "passed", reason).alias("reason"))


def run_manifest(loads: DataFrame, staged: DataFrame, results: DataFrame, composition: DataFrame) -> DataFrame:
    """One row for each dataset: counts of its loads, latest date staged, counts of its checks, outcome of its group."""
    l = loads.groupBy("dataset").agg(F.sum("rows_downloaded").alias("downloaded"), F.sum("rows_written").alias("landed"), F.max("loaded_at").alias("newest"))
    c = results.groupBy("dataset").agg(F.count("*").alias("checks"), F.count_if(F.col("status") != "passed").alias("not_passed"))
    return l.join(staged, "dataset", "left").join(c, "dataset", "left").join(composition, "dataset", "left").select(
        "dataset", "downloaded", "landed", "newest", "latest_obs", *(F.coalesce(x, F.lit(0)).alias(x) for x in ("checks", "not_passed")), F.coalesce("outcome", F.lit("not_run")).alias("outcome")
    )


def compare_versions(a: dict[str, DataFrame], b: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows that only the one or only the other version has; a table that one lacks differs by all its rows."""
    out = None
    for name in sorted({*a, *b}):
        x, y = a.get(name), b.get(name)
        x, y = x if x is not None else y.limit(0), y if y is not None else x.limit(0)
        rows = x.exceptAll(y).select(F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(y.exceptAll(x).select(F.lit(0).alias("_a"), F.lit(1).alias("_b")))
        one = rows.agg(F.coalesce(F.sum("_a"), F.lit(0)).alias("only_a"), F.coalesce(F.sum("_b"), F.lit(0)).alias("only_b")).select(F.lit(name).alias("table"), "only_a", "only_b")
        out = one if out is None else out.unionByName(one)
    return out


def recorded_gates(results: DataFrame, checks: DataFrame, composition: DataFrame) -> DataFrame:
    """Each check's newest result for its group's source run; broken if none is recorded, not_served if the group has no source run."""
    newest = results.groupBy("check_id", "run_id").agg(F.max_by("status", "at").alias("_status"))
    rows = checks.join(composition.select("source_group", "source_run"), "source_group", "left").join(newest, (checks["check_id"] == newest["check_id"]) & (F.col("source_run") == F.col("run_id")), "left")
    return rows.select(checks["check_id"], "source_group", F.when(F.col("source_run").isNull(), "not_served").otherwise(F.coalesce("_status", F.lit("broken"))).alias("status"))


def rows_by_run(loads: DataFrame) -> DataFrame:
    color = F.when(F.sum("rows_written") != F.sum("rows_downloaded"), "red").otherwise("green")
    return loads.groupBy("run_id").agg(F.sum("rows_written").alias("landed"), F.count("*").alias("datasets"), color.alias("color"))


def served_summary(obs: DataFrame, source: Column) -> DataFrame:
    return obs.groupBy(source.alias("source")).agg(F.count_distinct("series_id").alias("series"), F.count("*").alias("n_rows"), F.max("obs_date").alias("last_date"))


def run_strip(manifest: DataFrame) -> DataFrame:
    """A color for each run: red if a group is blocked, yellow if one was carried forward, else green."""
    color = F.when(F.bool_or(F.col("outcome") == "blocked"), "red").when(F.bool_or(F.col("outcome") == "carried_forward"), "yellow").otherwise("green")
    return manifest.groupBy("run_id").agg(F.max("loaded_at").alias("ended"), color.alias("color"))


def coverage(expected: DataFrame, catalog: DataFrame) -> DataFrame:
    """Share of expected dates present by series and month; a quarterly date covers its three months."""
    rows = expected.join(catalog.select("series_id", "frequency"), "series_id")
    month = F.trunc("obs_date", "month")
    spread = F.when(F.col("frequency") == "Q", F.sequence(month, F.add_months(month, 2), F.expr("INTERVAL 1 MONTH"))).otherwise(F.array(month))
    return rows.select("series_id", F.explode(spread).alias("month"), "present").groupBy("series_id", "month").agg(F.avg(F.when(F.col("present"), 1.0).otherwise(0.0)).alias("share"))


def trailing_year(df: DataFrame, by: str, at: str, days: int = 365) -> DataFrame:
    last = df.groupBy(by).agg(F.max(at).alias("_last"))
    return df.join(last, by).filter(F.col(at) > F.date_sub("_last", days)).drop("_last")


def series_inventory(latest: DataFrame, catalog: DataFrame) -> DataFrame:
    """Span and values of each catalogued series at the latest vintage, and whether it is served at all."""
    spans = latest.groupBy("series_id").agg(F.min("obs_date").alias("first_date"), F.max("obs_date").alias("last_date"), F.count("value").alias("n"))
    return catalog.select("series_id").join(spans, "series_id", "left").select("series_id", "first_date", "last_date", F.coalesce("n", F.lit(0)).alias("n"), F.col("first_date").isNotNull().alias("served"))


def table_catalog(tables: dict[str, tuple[DataFrame, str]], prefixes: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Rows, first and last date of each table (name: table, date column), and of parts of a table by the prefix of their series_id, with the number of series.

    prefixes: name to table and prefix, which ends at a colon. All parts of a table come from one pass over it.
    """
    parts = prefixes or {}
    out = None
    for name, (df, at) in tables.items():
        kinds = {name: F.lit(True)} | {p: F.col("series_id").startswith(f"{prefix}:") for p, (t, prefix) in parts.items() if t == name}
        series = {k: F.col("series_id") if k in parts else F.lit(None).cast("string") for k in kinds}
        rows = df.select(F.inline(F.filter(F.array(*(F.struct(F.lit(k).alias("name"), c.alias("_in"), series[k].alias("_s"), F.col(at).alias("_at")) for k, c in kinds.items())), lambda x: x["_in"])))
        one = rows.groupBy("name").agg(F.count("*").alias("n"), F.min("_at").alias("first_date"), F.max("_at").alias("last_date"), F.count_distinct("_s").alias("series"))
        known = df.sparkSession.createDataFrame([(k, k in parts) for k in kinds], "name string, _part boolean")
        one = known.join(one, "name", "left").select("name", F.coalesce("n", F.lit(0)).alias("n"), "first_date", "last_date", F.when(F.col("_part"), F.coalesce("series", F.lit(0))).alias("series"))
        out = one if out is None else out.unionByName(one)
    return out


def run_log(manifest: DataFrame, loads: DataFrame, results: DataFrame | None = None) -> DataFrame:
    """One row for each run of the manifest or the loads: outcome, start and end of its loads, seconds between them, groups that were blocked or failed, and failing checks.

    Outcome: died if there is no manifest; failed or blocked if all groups are, whichever is worse; partial if some are or are carried forward; published if some group is; else carried. results: run_id,
    check_id, status; failing checks are those neither passed nor acknowledged, in order, joined by commas.
    """
    bad, worst = F.col("outcome").isin("blocked", "failed"), F.bool_or(F.col("outcome") == "failed")
    held = F.col("outcome").isin("carried_forward", "never_published")
    m = manifest.groupBy("run_id").agg(
        F.when(F.bool_and(bad), F.when(worst, "failed").otherwise("blocked")).when(F.bool_or(bad) | (F.bool_or(held) & F.bool_or(F.col("outcome") == "published")), "partial").when(F.bool_or(F.col("outcome") == "published"), "published").otherwise("carried").alias("_outcome"),
        F.count_if(F.col("outcome") == "blocked").alias("_blocked"), F.count_if(F.col("outcome") == "failed").alias("_failed"),
    )
    l = loads.groupBy("run_id").agg(F.min("loaded_at").alias("started"), F.max("loaded_at").alias("ended"))
    out = l.join(m, "run_id", "full")
    out = out.select("run_id", F.coalesce("_outcome", F.lit("died")).alias("outcome"), "started", "ended", (F.unix_timestamp("ended") - F.unix_timestamp("started")).alias("seconds"), F.coalesce("_blocked", F.lit(0)).alias("blocked"), F.coalesce("_failed", F.lit(0)).alias("failed"))
    if results is None:
        return out
    failing = results.filter(~F.col("status").isin("passed", "acknowledged")).groupBy("run_id").agg(F.array_join(F.array_sort(F.collect_set("check_id")), ",").alias("failing_checks"))
    return out.join(failing, "run_id", "left")


def days_without_run(log: DataFrame) -> DataFrame:
    """Days between the first and the last run on which none ended."""
    held = log.select(F.to_date("ended").alias("d")).filter("d IS NOT NULL").distinct()
    span = held.agg(F.min("d").alias("a"), F.max("d").alias("b")).filter("a IS NOT NULL")
    return span.select(F.explode(F.sequence("a", "b")).alias("d")).join(held, "d", "left_anti")
