"""Financial and statistical analytics over the caller's tables. Amounts are summed as they come (decimals stay exact); ratios are doubles, null where undefined."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.aggregates import arg_max
from palimpsest.operators.joins import period_average
from palimpsest.operators.ranges import dealt, running


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles, null if b is 0 or either is null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def fiscal_year(end: str) -> Column:
    """The calendar year that holds most of a fiscal year."""
    return F.year(F.date_sub(end, 182))


# Panels of companies


def company_years(facts: DataFrame, details: DataFrame, priority: list[str], shells: list[int]) -> DataFrame:
    """One value for each company and fiscal year: cik, fy, concept, end_date, val.

    Yearly flows of 10-K filings (350 to 380 days, ended when filed, above 0); of each concept and period the value filed last; of a fiscal year that which ends last, and there
    the concept that stands first in `priority`. Companies whose industry code is in `shells` are left out.
    """
    flows = facts.filter("form = '10-K' AND end_date <= filed AND val > 0 AND datediff(end_date, start_date) BETWEEN 350 AND 380").filter(F.col("concept").isin(priority))
    newest = flows.groupBy("cik", "concept", "end_date").agg(arg_max("val", ["filed", "accession", "val"]).alias("val"))
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("concept"))
    best = newest.groupBy("cik", fiscal_year("end_date").alias("fy")).agg(F.max(F.struct("end_date", (-rank).alias("rank"), "concept", "val")).alias("b"))
    return best.join(details.filter(F.col("sic").isin(shells)).select("cik"), "cik", "left_anti").select("cik", "fy", "b.concept", "b.end_date", "b.val")


def with_shares(df: DataFrame, by: list[str], value: str, tie: list[str]) -> DataFrame:
    """Each row with rank (`rk`), share of its group and shares up to it (`cum`)."""
    w = Window.partitionBy(*by)
    share = ratio(F.col(value), F.sum(value).over(w))
    ranked = df.withColumn("share", share).withColumn("rk", F.row_number().over(w.orderBy(F.desc(value), *tie)))
    return ranked.withColumn("cum", F.sum("share").over(w.orderBy("rk").rowsBetween(Window.unboundedPreceding, 0)))


def concentration(df: DataFrame, by: list[str], value: str, tie: list[str], label: str | None = None) -> DataFrame:
    """Per group: companies, top1, cr4, hhi, to_half (members that make up half) and, if asked for, the label of the largest member."""
    named = [F.max(F.struct(value, *tie, label))[label].alias("label")] if label else []
    return with_shares(df, by, value, tie).groupBy(*by).agg(
        F.count("*").alias("companies"), F.max("share").alias("top1"), F.sum(F.when(F.col("rk") <= 4, F.col("share")).otherwise(0.0)).alias("cr4"),
        (F.sum(F.col("share") * F.col("share")) * 10_000).alias("hhi"), F.min(F.when(F.col("cum") >= 0.5, F.col("rk"))).alias("to_half"), *named,
    )


#: SIC divisions by the code's first two digits, both ends included.
DIVISIONS = [("A", 1, 9), ("B", 10, 14), ("C", 15, 17), ("D", 20, 39), ("E", 40, 49), ("F", 50, 51), ("G", 52, 59), ("H", 60, 67), ("I", 70, 89), ("J", 91, 97), ("K", 99, 99)]
#: Classes of exchanges, the first that an exchange of the company's list is in.
EXCHANGES = [("NYSE", ["NYSE", "NYSE American", "NYSE Arca"]), ("Nasdaq", ["Nasdaq"]), ("OTC", ["OTC"])]


def industry_codes(df: DataFrame, code: str, bounds: list[tuple[int, str]], last: str, value: str, large: float, exchanges: str | None = None) -> DataFrame:
    """Each row with its four-digit code's first digits (`sic2`, `sic3`), division (null where no division holds it), the sector whose bound the code lies below, a size class and, from a list of exchanges, its class."""
    sector, two = F.lit(last), F.floor(F.col(code) / 100)
    for bound, name in reversed(bounds):
        sector = F.when(F.col(code) < bound, name).otherwise(sector)
    division = F.coalesce(*(F.when(two.between(lo, hi), letter) for letter, lo, hi in DIVISIONS))
    out = df.withColumns({"sic2": two, "sic3": F.floor(F.col(code) / 10), "division": division, "sector": sector, "size": F.when(F.col(value) < large, "small").otherwise("large")})
    if exchanges is None:
        return out
    listed = F.filter(F.col(exchanges), lambda x: x.isNotNull())
    named = [F.when(F.arrays_overlap(listed, F.array(*map(F.lit, xs))), n) for n, xs in EXCHANGES]
    return out.withColumn("exchange", F.coalesce(*named, F.when(F.size(listed) > 0, "Other exchange"), F.lit("No ticker listed")))


def grain_table(df: DataFrame, member: str, grains: dict[str, Column], least: int) -> DataFrame:
    """Per grain: groups, groups with `least` members, members that those cover, groups of one. One pass writes every row once for each grain."""
    rows = df.select(F.col(member).alias("_m"), F.inline(F.array(*(F.struct(F.lit(n).alias("grain"), c.cast("string").alias("g")) for n, c in grains.items()))))
    sizes = rows.groupBy("grain", "g").agg(F.count_distinct("_m").alias("n"))
    return sizes.groupBy("grain").agg(
        F.count("*").alias("n_groups"), F.count_if(F.col("n") >= least).alias("large_groups"), F.sum(F.when(F.col("n") >= least, F.col("n")).otherwise(0)).alias("covered"), F.count_if(F.col("n") == 1).alias("singletons")
    )


def size_curve(df: DataFrame, by: list[str], value: str, tie: list[str], marks: list[float]) -> DataFrame:
    """Rank at which the largest members reach each share of the total. A group's members are spread over ranges of their size."""
    rows = running(df, by, [F.desc(value), *tie], {"rk": F.lit(1), "cum": value})
    cum = ratio(F.col("cum"), F.col("cum_total"))
    return rows.groupBy(*by).agg(*(F.min(F.when(cum >= m - 1e-12, F.col("rk"))).alias(f"r{round(100 * m)}") for m in marks))


def mix_table(df: DataFrame, by: list[str], of: list[str], value: str, income: str) -> DataFrame:
    """Per group: members, value, share of the value of its `of`, median, share of members with a loss."""
    sums = df.groupBy(*of, *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.median(F.col(value).cast("double")).alias("median"), ratio(F.count_if(F.col(income) < 0), F.count("*")).alias("losing"))
    return sums.withColumn("share", ratio(F.col("total"), F.sum("total").over(Window.partitionBy(*of))))


def profitability(df: DataFrame, by: list[str], value: str, income: str) -> DataFrame:
    return df.groupBy(*by).agg(ratio(F.sum(income), F.sum(value)).alias("margin"), F.count_if(F.col(income) < 0).alias("losing"), F.count("*").alias("n"))


def concentration_over_time(df: DataFrame, year: str, group: str, value: str, tie: list[str], least: int = 10) -> DataFrame:
    """Each year's companies with a value above 0, the shares of the 10 and the 100 largest, how many groups have at least `least` companies, and the median of those groups' indices (squares of shares, times 10,000).

    The largest are found by top-k in each task first; a group's index comes from sums alone. Rows without a group count in the shares.
    """
    rows = df.filter(F.col(value) > 0)
    top = rows.withColumn("_rk", F.row_number().over(Window.partitionBy(year).orderBy(F.desc(value), *tie))).filter("_rk <= 100")
    largest = top.groupBy(year).agg(F.sum(F.when(F.col("_rk") <= 10, F.col(value))).alias("_10"), F.sum(value).alias("_100"))
    totals = rows.groupBy(year).agg(F.count("*").alias("companies"), F.sum(value).alias("_t"))
    sums = rows.filter(F.col(group).isNotNull()).groupBy(year, group).agg(F.count("*").alias("_n"), F.sum(value).alias("_s"), F.sum(F.col(value).cast("double") * F.col(value).cast("double")).alias("_q")).filter(F.col("_n") >= least)
    groups = sums.groupBy(year).agg(F.count("*").alias("groups"), F.median(F.round(F.try_divide("_q", F.col("_s").cast("double") * F.col("_s").cast("double")) * 10_000, 3)).alias("median_hhi"))
    out = totals.join(largest, year).join(groups, year, "left")
    return out.select(year, "companies", ratio(F.col("_10"), F.col("_t")).alias("top10"), ratio(F.col("_100"), F.col("_t")).alias("top100"), F.coalesce("groups", F.lit(0)).alias("groups"), "median_hhi")


def share_at_grains(df: DataFrame, member: str, key: int, year: str, value: str, grains: dict[str, str]) -> DataFrame:
    """One member's share, each year, of all and of the group it is in at each grain (name: column)."""
    own = df.filter(F.col(member) == key)
    shares = [ratio(F.sum(F.when(F.col(member) == key, F.col(value)).otherwise(0)), F.sum(value)).alias("of_all")]
    for name, col in grains.items():
        df = df.join(own.select(col).distinct().withColumn(f"_in_{name}", F.lit(True)), col, "left")
        shares.append(ratio(F.sum(F.when(F.col(member) == key, F.col(value)).otherwise(0)), F.sum(F.when(F.col(f"_in_{name}"), F.col(value)).otherwise(0))).alias(f"of_{name}"))
    return df.groupBy(year).agg(*shares)


# Companies beside the economy


def filers_vs_macro(filings: DataFrame, forms: list[str], macro: DataFrame, at: str, value: str) -> DataFrame:
    """Filers of the forms in each year beside the year's mean of a series."""
    filers = filings.filter(F.col("form").isin(forms)).groupBy(F.year("filed").alias("y")).agg(F.count_distinct("cik").alias("filers"))
    return filers.join(macro.groupBy(F.year(at).alias("y")).agg(F.avg(value).alias("macro")), "y")


def deflate(rev: DataFrame, start: str, end: str, value: str, index: DataFrame, at: str, level: str, base_year: int) -> DataFrame:
    """Each row's value at the price level of a calendar year (`real`), with the months of the index inside its own period [start, end) and their mean (`index_months`, `index_mean`).

    Months of a period meet those of the index by equality, so no range is joined. A period without a month of the index has no row; without the base year real is null.
    """
    base = index.filter(F.year(at) == base_year).agg(F.avg(level).alias("_b"))
    spans = rev.select(start, end).distinct()
    met = period_average(spans, index.filter(F.col(level).isNotNull()), at, level, [], start, end).withColumnsRenamed({"mean": "index_mean", "n": "index_months"})
    rows = rev.join(met, [start, end]).join(F.broadcast(base))  # one base row
    return rows.withColumn("real", ratio(F.col(value), F.col("index_mean")) * F.col("_b")).drop("_b")


def ratio_by_group(facts: DataFrame, details: DataFrame, top: str, bottom: str, frame: tuple[str, str], by: str) -> DataFrame:
    """Sum of one concept over sum of another by the companies' group, of values that end within the frame; a company counts with its largest value of each."""
    rows = facts.filter(F.col("end_date").between(*(F.lit(x).cast("date") for x in frame)))
    each = rows.groupBy("cik").agg(*(F.max(F.when(F.col("concept") == c, F.col("val").cast("decimal(14,2)"))).alias(n) for n, c in (("_a", top), ("_b", bottom))))
    return each.join(details, "cik").groupBy(by).agg(ratio(F.sum("_a"), F.sum("_b")).alias("ratio"))


def frame_totals(df: DataFrame, year: str, value: str, tie: list[str], k: int, macro: DataFrame) -> DataFrame:
    """Each year's total, that of the k largest, and the total's ratio to a yearly macro value (columns year, macro)."""
    top = df.withColumn("_rk", F.row_number().over(Window.partitionBy(year).orderBy(F.desc(value), *tie))).filter(F.col("_rk") <= k).groupBy(year).agg(F.sum(value).alias("top"))
    return df.groupBy(year).agg(F.sum(value).alias("total")).join(top, year).join(macro, year, "left").withColumn("of_macro", ratio(F.col("total"), F.col("macro"))).drop("macro")


def filing_lag(facts: DataFrame, by: list[str], late: int) -> DataFrame:
    """Days from the period's end to the filing: median, tenth and ninetieth percentile, and the share above `late`."""
    days = F.datediff("filed", "end_date")
    return facts.groupBy(*by).agg(*(F.percentile(days, p).alias(n) for n, p in (("p10", 0.1), ("med", 0.5), ("p90", 0.9))), ratio(F.count_if(days > late), F.count("*")).alias("late"))


def coverage_ratios(panel: DataFrame, year: str, value: str, macro: DataFrame) -> DataFrame:
    """Total of the panel each year over each of the other columns of macro (one row a year)."""
    bases = [c for c in macro.columns if c != year]
    return panel.groupBy(year).agg(F.sum(value).alias("_t")).join(macro, year).select(year, *(ratio(F.col("_t"), F.col(b)).alias(f"of_{b}") for b in bases))


def sector_shares(df: DataFrame, other: DataFrame, key: str, value: str) -> DataFrame:
    """Each sector's share of the value in either table, zero where a table lacks it."""
    sums = [d.groupBy(key).agg(F.sum(value).alias(n)) for d, n in ((df, "_a"), (other, "_b"))]
    totals = [d.agg(F.sum(value).alias(n)) for d, n in ((df, "_ta"), (other, "_tb"))]
    both = sums[0].join(sums[1], key, "full").join(F.broadcast(totals[0])).join(F.broadcast(totals[1]))  # totals are one row each
    return both.select(key, *(F.coalesce(ratio(F.col(v), F.col(t)), F.lit(0.0)).alias(n) for v, t, n in (("_a", "_ta", "share"), ("_b", "_tb", "other_share"))))


# Peers and restatements


def peer_ranks(df: DataFrame, ids: list[str], measures: list[str], rungs: list[str]) -> DataFrame:
    """Each known measure of each row at each rung: percent rank, number and median of its peers."""
    long = df.unpivot([*ids, *rungs], measures, "measure", "value").filter("value IS NOT NULL")
    long = long.select(*ids, "measure", "value", F.inline(F.array(*(F.struct(F.lit(r).alias("rung"), F.col(r).cast("string").alias("peers")) for r in rungs)))).filter("peers IS NOT NULL")
    w = Window.partitionBy("rung", "peers", "measure")
    return long.select("*", F.percent_rank().over(w.orderBy("value")).alias("pct"), F.count("*").over(w).alias("n"), F.median("value").over(w).alias("peer_median"))


def restatements(facts: DataFrame, keys: list[str], bands: list[float]) -> DataFrame:
    """Periods whose value changed: first and last value, number of filings, the first filing that disagreed, size, its band and how it came about.

    How: scale if the values are a power of a thousand apart, amended if the first filing that disagreed is an amendment, else later. Periods are dealt out by the number of filings, which are counted first.
    """
    w = Window.partitionBy(*keys).orderBy("filed", "accession", "val")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = dealt(facts.select(*keys, "filed", "accession", "val", "form"), keys).select("*", F.first("val").over(whole).alias("first_val"), F.last("val").over(whole).alias("last_val"))
    differs = F.when(F.col("val") != F.col("first_val"), F.struct("filed", "accession", "val", "form"))
    found = rows.groupBy(*keys).agg(F.first("first_val").alias("first_val"), F.first("last_val").alias("last_val"), F.count("*").alias("n"), F.min(differs).alias("_d")).filter("first_val <> last_val")
    size, times = F.abs(ratio(F.col("last_val"), F.col("first_val")) - 1), F.abs(ratio(F.col("last_val"), F.col("first_val")))
    scale = F.exists(F.array(*(F.lit(x) for x in (1e-6, 1e-3, 1e3, 1e6))), lambda x: F.abs(times / x - 1) < 0.01)
    return found.select(
        *keys, "first_val", "last_val", "n", F.col("_d.filed").alias("disagreed"), size.alias("size"), F.size(F.filter(F.array(*map(F.lit, bands)), lambda b: b <= size)).alias("band"),
        F.when(scale, "scale").when(F.col("_d.form").endswith("/A"), "amended").otherwise("later").alias("how"),
    )


def restatement_summary(changed: DataFrame, year: str) -> DataFrame:
    """Changed periods and companies of each fiscal year."""
    return changed.groupBy(year).agg(F.count("*").alias("restated"), F.count_distinct("cik").alias("companies"))


def years_changed(facts: DataFrame, changed: DataFrame, year: str, last: int, span: int = 10) -> DataFrame:
    """Of companies with a value in every one of the `span` years up to the last: how many had how many of those years changed, 0 to span.

    facts: cik and year of every value reported; changed: those of the values that changed.
    """
    window = F.col(year).between(last - span + 1, last)
    whole = facts.filter(window).groupBy("cik").agg(F.count_distinct(year).alias("_n")).filter(F.col("_n") == span).select("cik")
    each = whole.join(changed.filter(window).groupBy("cik").agg(F.count_distinct(year).alias("years")), "cik", "left")
    counts = each.groupBy(F.coalesce("years", F.lit(0)).alias("years")).agg(F.count("*").alias("companies"))
    every = facts.sparkSession.range(span + 1).select(F.col("id").alias("years"))
    return every.join(counts, "years", "left").select("years", F.coalesce("companies", F.lit(0)).alias("companies"))


# Quarters


def same_company_growth(q: DataFrame, key: str) -> DataFrame:
    """Growth over the quarter a year earlier, of the companies that have both."""
    before = q.select(key, F.add_months("q", 12).alias("q"), F.col("v").alias("_before"))
    return q.join(before, [key, "q"]).groupBy("q").agg(F.count("*").alias("n"), (ratio(F.sum("v"), F.sum("_before")) - 1).alias("growth"))


def annual_tie(quarters: DataFrame, years: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Years whose four quarters are there, and how many of them differ from the quarters' sum by more than the tolerance."""
    four = quarters.groupBy(*keys, F.year("q").alias("yr")).agg(F.sum("v").alias("_s"), F.count("*").alias("_n")).filter("_n = 4")
    gap = F.abs(ratio(F.col("_s"), F.col("v")) - 1)
    return years.join(four, [*keys, "yr"]).agg(F.count("*").alias("n"), F.count_if(gap > tolerance).alias("off"))


def growth_fit(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Correlation of two sources' growth over the quarter a year earlier (keys, q, v), with all quarters and without fourth ones, and the pairs of each."""

    def growth(df: DataFrame, name: str) -> DataFrame:
        before = df.select(*keys, F.add_months("q", 12).alias("q"), F.col("v").alias("_b"))
        return df.join(before, [*keys, "q"]).select(*keys, "q", (ratio(F.col("v"), F.col("_b")) - 1).alias(name))

    rows = growth(a, "_x").join(growth(b, "_y"), [*keys, "q"]).filter("_x IS NOT NULL AND _y IS NOT NULL")
    early = F.quarter("q") != 4
    return rows.agg(F.count("*").alias("n"), F.corr("_x", "_y").alias("fit"), F.count_if(early).alias("n_early"), F.corr(F.when(early, F.col("_x")), F.when(early, F.col("_y"))).alias("fit_early"))


# Returns on capital


def return_on_capital(df: DataFrame, key: str, year: str, income: str, capital: str) -> DataFrame:
    """Income over the capital at the year's start, which is that of the year before; companies with the same year, income and capital are one, that of the smallest key."""
    opening = df.select(key, (F.col(year) + 1).alias(year), F.col(capital).alias("opening"))
    rows = df.join(opening, [key, year]).select(key, year, income, "opening")
    return rows.groupBy(year, income, "opening").agg(F.min(key).alias(key)).withColumn("ret", ratio(F.col(income), F.col("opening")))


def capital_percentiles(df: DataFrame, by: list[str], value: str, tie: list[str], weight: str, income: str, marks: list[float]) -> DataFrame:
    """Smallest value at which the weight reaches each mark, and the pooled return. A group's rows are spread over ranges of the value."""
    pos = running(df, by, [value, *tie], {"_run": weight})
    at = ratio(F.col("_run"), F.col("_run_total"))
    return pos.groupBy(*by).agg(*(F.min(F.when(at >= m, F.col(value))).alias(f"p{round(100 * m)}") for m in marks), ratio(F.sum(income), F.sum(weight)).alias("pooled"))


def cohort_track(df: DataFrame, key: str, year: str, base: int, value: str, weight: str, income: str, n: int) -> DataFrame:
    """Members sorted once by a value in the base year into n groups of about equal weight, followed over all years: income, pooled return.

    Groups come from the weight below a value, summed up by distinct value first and then over ranges of values.
    """
    at = df.filter((F.col(year) == base) & F.col(value).isNotNull()).select(key, F.round(value, 4).alias("_v"), F.col(weight).alias("_w"))
    by_value = running(at.groupBy("_v").agg(F.sum("_w").alias("_w")), [], ["_v"], {"_run": "_w"})
    below = F.col("_run") - F.col("_w")
    placed = by_value.select("_v", (F.least(F.floor(n * below.cast("double") / F.col("_run_total").cast("double")), F.lit(n - 1)) + 1).alias("g"))
    return at.join(placed, "_v").select(key, "g").join(df, key).groupBy("g", year).agg(F.sum(income).alias("income"), ratio(F.sum(income), F.sum(weight)).alias("pooled"))


def industry_returns(df: DataFrame, by: str, year: str, income: str, capital: str, spans: dict[str, tuple[int, int]]) -> DataFrame:
    """Pooled return of each industry over each span of years."""
    inside = {n: F.col(year).between(*span) for n, span in spans.items()}
    return df.groupBy(by).agg(*(ratio(F.sum(F.when(c, F.col(income))), F.sum(F.when(c, F.col(capital)))).alias(n) for n, c in inside.items()))


def top_industries(df: DataFrame, members: DataFrame, key: str, by: str, year: str, income: str, capital: str, entry: int, exit_year: int, n: int) -> DataFrame:
    """Industries of a cohort's members (key) by their capital in the entry year, the n largest: members, capital, share of the cohort's, return, and members and return in the exit year (null if none is left)."""
    rows = df.join(members.select(key).distinct(), key, "left_semi")
    at = lambda y: rows.filter(F.col(year) == y).groupBy(by).agg(F.count("*").alias("n"), F.sum(capital).alias("capital"), ratio(F.sum(income), F.sum(capital)).alias("ret"))
    total = rows.filter(F.col(year) == entry).agg(F.sum(capital).alias("_t"))
    late = at(exit_year).select(by, F.col("n").alias("exit_n"), F.col("ret").alias("exit_ret"))
    first = at(entry).orderBy(F.desc("capital"), by).limit(n).join(F.broadcast(total))  # one row
    return first.join(late, by, "left").select(by, "n", "capital", ratio(F.col("capital"), F.col("_t")).alias("share"), "ret", "exit_n", "exit_ret")


def peak_order(df: DataFrame, key: str, year: str, a: str, b: str) -> DataFrame:
    """Years of the best `a` and `b` of each member, which came first, and whether either peak is at the panel's edge (censored)."""
    best = df.groupBy(key).agg(F.max_by(year, F.struct(a, year)).alias("best_a"), F.max_by(year, F.struct(b, year)).alias("best_b"), F.max(year).alias("_last"), F.min(year).alias("_first"))
    order = F.when(F.col("best_a") < F.col("best_b"), "a_first").when(F.col("best_a") > F.col("best_b"), "b_first").otherwise("same")
    edge = F.col("best_a").isin(F.col("_last"), F.col("_first")) | F.col("best_b").isin(F.col("_last"), F.col("_first"))
    return best.select(key, "best_a", "best_b", order.alias("order"), edge.alias("censored"))


def share_crossing(df: DataFrame, year: str, group: str, value: str, a: int, b: int) -> DataFrame:
    """Shares of two groups each year, and whether the first passed the second in that year."""
    sums = df.groupBy(year).agg(*(ratio(F.sum(F.when(F.col(group) == g, F.col(value)).otherwise(0)), F.sum(value)).alias(n) for n, g in (("share_a", a), ("share_b", b))))
    w = Window.partitionBy(F.lit(0)).orderBy(year)  # one row a year
    ahead = F.col("share_a") > F.col("share_b")
    return sums.withColumn("crossed", ahead & ~F.coalesce(F.lag(ahead).over(w), F.lit(True)))
