"""As-of, window, null-safe and reconciling joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: list[str], take: list[str], direction: str = "backward", inclusive: bool = True, ranges: int = 1) -> DataFrame:
    """Each left row with the columns `take` of the nearest right row of its key: the last at or before it, or the first at or after it.

    Both sides are laid in one order per key and the nearest right row is carried along, so there is one shuffle on the key and no range join.
    With several `ranges` the shuffle is on the key and a range of time (about equally many rows each), so one key that holds all rows fills as many tasks; the last
    right row of each key and range is then handed on to the ranges after it.
    Among right rows of one time the largest payload wins (backward) or the smallest (forward). Left rows without a match keep nulls. A null time or key,
    on either side, matches nothing.
    """
    back = direction == "backward"
    known = F.lit(True)
    for c in by:
        known = known & F.col(c).isNotNull()
    payload = F.struct(F.col(right_on).alias("_t"), *take)
    r = right.filter(known & F.col(right_on).isNotNull()).groupBy(*by, F.col(right_on).alias("_at")).agg((F.max if back else F.min)(payload).alias("_p"))
    # Right rows stand before left rows of the same time if they may match them.
    first, second = (0, 1) if inclusive == back else (1, 0)
    l = left.select(*by, F.col(left_on).alias("_at"), F.lit(second).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(r.schema["_p"].dataType).alias("_p"))
    r = r.select(*by, "_at", F.lit(first).alias("_side"), F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), "_p")
    both, parts = l.unionByName(r), list(by)
    if ranges > 1:
        cuts = _cuts(both, "_at", ranges)
        both, parts = both.withColumn("_range", cuts), [*by, "_range"]
    w = Window.partitionBy(*parts).orderBy("_at", "_side")
    w = w.rowsBetween(Window.unboundedPreceding, 0) if back else w.rowsBetween(0, Window.unboundedFollowing)
    near = F.last if back else F.first
    rows = both.withColumn("_found", near("_p", ignorenulls=True).over(w))
    if ranges > 1:
        ends = both.groupBy(*parts).agg((F.max if back else F.min)("_p").alias("_p"))
        beyond = Window.partitionBy(*by).orderBy("_range")
        beyond = beyond.rowsBetween(Window.unboundedPreceding, -1) if back else beyond.rowsBetween(1, Window.unboundedFollowing)
        handed = ends.select(*parts, near("_p", ignorenulls=True).over(beyond).alias("_handed"))
        rows = rows.filter(F.col("_row").isNotNull()).join(handed, parts, "left").withColumn("_found", F.coalesce("_found", "_handed"))
    # Rows without a time stand first in the order, those without a key in a group of their own.
    met = rows.filter(F.col("_row").isNotNull()).withColumn("_found", F.when(F.col("_at").isNotNull() & known, F.col("_found")))
    return met.select("_row.*", *(F.col(f"_found.{c}").alias(c) for c in take))


def _cuts(df: DataFrame, at: str, ranges: int) -> Column:
    """Number of the range that a time stands in: ranges of about equally many rows, by approximate quantiles; a null time is in the first."""
    when = F.col(at) if dict(df.dtypes)[at] not in ("date",) else F.unix_date(F.col(at))
    when = F.unix_micros(when) if dict(df.dtypes)[at] == "timestamp" else when
    marks = df.agg(F.percentile_approx(when, [k / ranges for k in range(1, ranges)], 1000)).first()[0] or []
    return sum((F.coalesce((when > m).cast("int"), F.lit(0)) for m in sorted(set(marks))), F.lit(0))


#: A calendar is broadcast; so many days are some centuries.
CALENDAR_DAYS = 100_000


def calendar_days(calendar: DataFrame, session: str, name: str) -> DataFrame:
    """The calendar's days, marked for broadcast once it is known to be no larger than a calendar."""
    days = calendar.select(F.col(session).alias(name)).distinct()
    if days.limit(CALENDAR_DAYS + 1).count() > CALENDAR_DAYS:
        raise ValueError(f"a calendar of more than {CALENDAR_DAYS} days")
    return F.broadcast(days)


def asof_by_distinct(df: DataFrame, date_col: str, calendar: DataFrame, session: str, name: str) -> DataFrame:
    """The next session after each row's date: every distinct date is looked up once in the small calendar and joined back by equality."""
    dates = df.select(F.col(date_col).alias("_d")).distinct()
    found = dates.join(calendar_days(calendar, session, "_s"), F.col("_s") > F.col("_d"), "left").groupBy("_d").agg(F.min("_s").alias(name))
    return df.join(found, df[date_col] == F.col("_d"), "left").drop("_d")


def window_join(df: DataFrame, windows: DataFrame, key: str, at: str, start: str, end: str, exactly_one: bool = False) -> DataFrame:
    """Rows with the window of their key that contains them, both ends included. If exactly one is required, rows in none or in several stop, with how many there are."""
    w = windows.withColumnRenamed(key, "_key")
    inside = (F.col(key) == F.col("_key")) & F.col(at).between(F.col(start), F.col(end))
    if exactly_one:
        rows = df.withColumn("_row", F.xxhash64(*df.columns))
        none, several = rows.join(w, inside, "left_anti").count(), rows.groupBy("_row", key, at).agg(F.count("*").alias("_times")).join(w, inside).groupBy("_row", key, at).agg(F.count("*").alias("n")).filter("n > 1").count()
        if none or several:
            raise ValueError(f"{none} rows in no window, {several} in several")
    return df.join(w, inside).drop("_key")


def expand_sessions(windows: DataFrame, calendar: DataFrame, session: str, start: str, end: str) -> DataFrame:
    """Every session inside each window; the calendar, a few thousand days, is broadcast."""
    return windows.join(calendar_days(calendar, session, session), F.col(session).between(F.col(start), F.col(end)))


def null_safe_join(l: DataFrame, r: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join in which null equals null."""
    r = r.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return l.join(r, on, f"left_{how}")


def reconcile_full(l: DataFrame, r: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """Full outer comparison of two ledgers: keys with `problem` missing_left, missing_right or the first column that differs."""
    a, b = (d.select(*keys, F.struct(*(F.col(c) for c in compare), F.lit(1).alias("_")).alias(n)) for d, n in ((l, "_a"), (r, "_b")))
    differs = F.coalesce(*(F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in compare))
    problem = F.when(F.col("_a").isNull(), "missing_left").when(F.col("_b").isNull(), "missing_right").otherwise(differs)
    return a.join(b, keys, "full").select(*keys, problem.alias("problem")).filter("problem IS NOT NULL")


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, year: Column, top: int = 3) -> DataFrame:
    """Keys that only one side has, both ways and by the child's year: side, year, distinct keys, rows, and the `top` most frequent keys (the smallest of equals) as examples."""
    rows = child.select(F.lit("child").alias("side"), year.alias("year"), key).join(parent.select(key).distinct(), key, "left_anti")
    rows = rows.unionByName(parent.select(F.lit("parent").alias("side"), F.lit(None).cast("int").alias("year"), key).join(child.select(key).distinct(), key, "left_anti"))
    counts = rows.groupBy("side", "year", key).agg(F.count("*").alias("n"))
    ranked = counts.withColumn("_rk", F.row_number().over(Window.partitionBy("side", "year").orderBy(F.desc("n"), key)))
    shown = F.array_sort(F.collect_list(F.when(F.col("_rk") <= top, F.struct("_rk", F.col(key).alias("k")))))
    return ranked.groupBy("side", "year").agg(F.count("*").alias("keys"), F.sum("n").alias("n_rows"), F.array_join(F.transform(shown, lambda x: x["k"].cast("string")), ",").alias("examples"))


def left_or_empty(clock: DataFrame, df: DataFrame, cond: str) -> DataFrame:
    """Every row of a one-row clock with the rows that meet a condition on both, or with nulls if none does."""
    return clock.join(df, F.expr(cond), "left")


def lateral(df: DataFrame, **named: str) -> DataFrame:
    """Rows with derived columns, each of which may use those before it."""
    for name, expr in named.items():
        df = df.withColumn(name, F.expr(expr))
    return df


def lines_wide(df: DataFrame, keys: list[str], line: str, value: str, lines: dict[str, str]) -> DataFrame:
    """Lines of a long table side by side, null where a key lacks one; two values of a line stop."""
    sums = df.filter(F.col(line).isin(list(lines.values()))).groupBy(*keys, line).agg(F.max(value).alias("_v"), F.min(value).alias("_w"))
    checked = F.when(F.col("_v") == F.col("_w"), F.col("_v")).otherwise(F.raise_error(F.lit("a line has two values")).cast(dict(df.dtypes)[value]))
    return sums.groupBy(*keys).agg(*(F.max(F.when(F.col(line) == code, checked)).alias(name) for name, code in lines.items()))


def asof_valuation(prices: DataFrame, shares: DataFrame, annual: DataFrame) -> DataFrame:
    """Each price day with the share count in force, the annual value filed last by then, market value and the value's multiple. shares: ticker, from_date, shares; annual: ticker, filed, val."""
    rows = asof_join(prices, shares, "obs_date", "from_date", ["ticker"], ["shares"])
    rows = asof_join(rows, annual, "obs_date", "filed", ["ticker"], ["val"])
    worth = F.col("close") * F.col("shares")
    return rows.select("ticker", "obs_date", "close", "shares", "val", worth.alias("market_value"), F.try_divide(worth, F.col("val")).alias("multiple"))


def list_overlap(a: DataFrame, b: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Per group: distinct keys in both lists, in the left one only, in the right one only."""
    l, r = (d.select(*by, *keys).distinct().withColumn(n, F.lit(True)) for d, n in ((a, "_l"), (b, "_r")))
    both = l.join(r, [*by, *keys], "full")
    return both.groupBy(*by).agg(
        F.count_if(F.col("_l") & F.col("_r")).alias("in_both"), F.count_if(F.col("_l") & F.col("_r").isNull()).alias("left_only"), F.count_if(F.col("_l").isNull()).alias("right_only")
    )


def array_membership(df: DataFrame, lists: DataFrame, keys: list[str], value: str, array: str) -> DataFrame:
    """Each row with `listed`: whether the list of its key holds its value; null if the key has no list."""
    return df.join(lists.select(*keys, F.col(array).alias("_list")), keys, "left").withColumn("listed", F.array_contains("_list", F.col(value))).drop("_list")


def period_average(periods: DataFrame, series: DataFrame, date_col: str, value_col: str, keys: list[str], start: str, end: str) -> DataFrame:
    """Mean and number of a series' values within each period [start, end). Periods spell out their months, which meet those of the series by equality."""
    months = periods.filter(F.col(start) < F.col(end)).select("*", F.explode(F.sequence(F.trunc(start, "month"), F.trunc(F.date_sub(end, 1), "month"), F.expr("INTERVAL 1 MONTH"))).alias("_m"))
    inside = (F.col(date_col) >= F.col(start)) & (F.col(date_col) < F.col(end))
    return months.join(series.withColumn("_m", F.trunc(date_col, "month")), "_m").filter(inside).groupBy(*keys, start, end).agg(F.avg(value_col).alias("mean"), F.count(value_col).alias("n"))


def due_sessions(df: DataFrame, calendar: DataFrame, session: str, until: Column, keys: list[str]) -> DataFrame:
    """Per row the last session up to `until` and the number of sessions after its own last one; the calendar is broadcast."""
    met = df.join(calendar_days(calendar, session, session), F.col(session) <= until, "left")
    return met.groupBy(*keys, "last_date").agg(F.max(session).alias("due"), F.count_if(F.col(session) > F.col("last_date")).alias("behind"))


def safe_filing_join(facts: DataFrame, filings: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on the whole key after repeated keys of the right side were made one, so no fact fans out; `filings_of_key` tells how many there were."""
    one = filings.groupBy(*keys).agg(F.count("*").alias("filings_of_key"))
    return facts.join(one, keys, "left")
