"""Analytics of series, populations, hierarchies and registers over the caller's tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.aggregates import classed
from palimpsest.operators.finance import ratio
from palimpsest.operators.ranges import cut, quantiles, running
from palimpsest.operators.statements import filed_spans, quarters


# Monthly and yearly series


def monthly(df: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """Means by month: by, m, v."""
    return df.groupBy(*by, F.date_trunc("month", at).cast("date").alias("m")).agg(F.avg(value).alias("v"))


def yoy(df: DataFrame, by: list[str], lag: int = 12) -> DataFrame:
    """Each month with the growth over that `lag` months earlier (`growth`), where both are there."""
    before = df.select(*by, F.add_months("m", lag).alias("m"), F.col("v").alias("_v"))
    return df.join(before, [*by, "m"]).withColumn("growth", ratio(F.col("v"), F.col("_v")) - 1).drop("_v")


def last_as_high(df: DataFrame, by: list[str], at: str, value: str, name: str) -> DataFrame:
    """Each row with the last earlier `at` of its group whose value was at least as high, null if there is none. A null value has none and is none.

    A group's rows pass once, in order, over a stack of those that may still be the answer for a later row: each is put there and taken off once, so work and memory are
    linear in a group's rows (a series has one a month).
    """
    kind = dict(df.dtypes)[at]

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows, stack, found = rows.sort_values(at, kind="stable"), [], []
        for t, v in zip(rows[at], rows[value]):
            if pd.isna(v):
                found.append(None)
                continue
            while stack and stack[-1][1] < v:
                stack.pop()
            found.append(stack[-1][0] if stack else None)
            stack.append((t, v))
        rows[name] = pd.Series(found, index=rows.index, dtype=object)
        return rows

    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + f", `{name}` {kind}"
    return df.groupBy(*by).applyInPandas(walk, schema)


def real_growth(series: DataFrame, index: DataFrame, by: list[str]) -> DataFrame:
    """Growth over the year of a series deflated by an index (m, level), and the last earlier month in which it was at least as high."""
    real = series.join(index, "m").select(*by, "m", ratio(F.col("v"), F.col("level")).alias("v"))
    return yoy(last_as_high(real, by, "m", "v", "last_as_high"), by).select(*by, "m", "growth", "last_as_high")


def pair_fit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two monthly series over their common span: months, correlation of their growth over the year, median gap of the growth, mean ratio of the levels."""
    both = a.select("m", F.col("v").alias("_a")).join(b.select("m", F.col("v").alias("_b")), "m")
    grown = [yoy(both.select("m", F.col(c).alias("v")), []).select("m", F.col("growth").alias(f"_g{c}")) for c in ("_a", "_b")]
    rows = both.join(grown[0], "m", "left").join(grown[1], "m", "left")
    return rows.agg(F.count("*").alias("n"), F.corr("_g_a", "_g_b").alias("fit"), F.median(F.abs(F.col("_g_a") - F.col("_g_b"))).alias("gap"), F.avg(ratio(F.col("_a"), F.col("_b"))).alias("level_ratio"))


def annual_table(m: DataFrame, by: list[str], need: int = 12) -> DataFrame:
    """Means of complete years and the change on the year before, where that is complete too."""
    years = m.groupBy(*by, F.year("m").alias("y")).agg(F.count("*").alias("months"), F.avg("v").alias("mean")).filter(F.col("months") >= need)
    w = Window.partitionBy(*by).orderBy("y")
    return years.withColumn("change", F.when(F.lag("y").over(w) == F.col("y") - 1, ratio(F.col("mean"), F.lag("mean").over(w)) - 1))


def period_averages(df: DataFrame, by: list[str], year: Column, flow: str, stock: str, at: str, spans: dict[str, tuple[int, int]]) -> DataFrame:
    """Per span: mean of the flow and the change of the stock from its first to its last value. A row is written for each of the few spans it lies in, so nothing is joined."""
    inside = F.array_compact(F.array(*(F.when(year.between(*span), n) for n, span in spans.items())))
    rows = df.withColumn("span", F.explode(inside))
    return rows.groupBy(*by, "span").agg(F.avg(flow).alias("mean"), (F.max_by(stock, at) - F.min_by(stock, at)).alias("change"))


def index_base(m: DataFrame, by: list[str], base_year: int) -> DataFrame:
    """Months as an index to the mean of the base year, which is 100."""
    base = m.filter(F.year("m") == base_year).groupBy(*by).agg(F.avg("v").alias("_b"))
    return m.join(base, by).select(*by, "m", (ratio(F.col("v"), F.col("_b")) * 100).alias("idx"))


def seasonality(m: DataFrame, by: list[str], high: tuple[int, int] = (1, 4), low: tuple[int, int] = (6, 10)) -> DataFrame:
    """Per year the peak of the high months over the low of the low ones, and how many months there are."""
    month = F.month("m")
    return m.groupBy(*by, F.year("m").alias("y")).agg(ratio(F.max(F.when(month.between(*high), F.col("v"))), F.min(F.when(month.between(*low), F.col("v")))).alias("ratio"), F.count("*").alias("months"))


def survey_against_census(survey: DataFrame, census: DataFrame, year: int) -> DataFrame:
    """Per month of a year: the survey's value, the census's, and how far the census is from it as a share.

    survey: m (first of month), v. census: y, q and the values of the quarter's months, m1, m2, m3.
    """
    months = census.filter(F.col("y") == year).select("y", "q", F.posexplode(F.array("m1", "m2", "m3")).alias("_i", "census"))
    dated = months.select(F.make_date("y", (F.col("q") - 1) * 3 + F.col("_i") + 1, F.lit(1)).alias("m"), "census")
    return survey.join(dated, "m").select("m", F.col("v").alias("survey"), "census", (ratio(F.col("census"), F.col("v")) - 1).alias("gap"))


def suppression_counts(df: DataFrame, level: str, hidden: str) -> DataFrame:
    """Per level: areas, and those whose figures are withheld."""
    return df.groupBy(level).agg(F.count("*").alias("areas"), F.count_if(F.expr(hidden)).alias("withheld"))


def seasonal_states(df: DataFrame, area: str, quarter: str, value: str, high: int = 1, low: int = 3) -> DataFrame:
    """Per area the value of the high quarter over that of the low one, of areas that show both and have some in the low one. Withheld values are null."""
    of = lambda q: F.max(F.when(F.col(quarter) == q, F.col(value)))
    both = df.groupBy(area).agg(of(high).alias("high"), of(low).alias("low")).filter("high IS NOT NULL AND low > 0")
    return both.withColumn("ratio", ratio(F.col("high"), F.col("low")))


def identity_gap(wide: DataFrame, by: list[str], at: str, orders: str, shipments: str, backlog: str) -> DataFrame:
    """Orders against shipments plus the change in backlog: median and largest absolute gap as a share of orders."""
    w = Window.partitionBy(*by).orderBy(at)
    gap = F.abs(F.col(orders) - F.col(shipments) - (F.col(backlog) - F.lag(backlog).over(w)))
    return wide.withColumn("_gap", ratio(gap, F.col(orders))).groupBy(*by).agg(F.count("_gap").alias("n"), F.median("_gap").alias("median_gap"), F.max("_gap").alias("worst"))


def fiscal_series(df: DataFrame, year: str, revenue: str, spending: str, jump: float) -> DataFrame:
    """Balance of each year that has both, its change, and whether both sides jumped by more than a share at once."""
    w = Window.partitionBy(F.lit(0)).orderBy(year)  # one row a year
    rows = df.filter(F.col(revenue).isNotNull() & F.col(spending).isNotNull()).withColumn("balance", F.col(revenue) - F.col(spending))
    moved = [F.abs(ratio(F.col(c), F.lag(c).over(w)) - 1) > jump for c in (revenue, spending)]
    return rows.select(year, "balance", (F.col("balance") - F.lag("balance").over(w)).alias("change"), F.coalesce(moved[0] & moved[1], F.lit(False)).alias("jump"))


def spending_shares(wide: DataFrame, year: str, total: str, parts: list[str], tolerance: float = 0.001) -> DataFrame:
    """Shares of the parts, and whether they add up to the total within the tolerance."""
    gap = F.abs(F.col(total) - sum((F.col(p) for p in parts[1:]), F.col(parts[0])))
    return wide.select(year, *(ratio(F.col(p), F.col(total)).alias(f"{p}_share") for p in parts), (gap <= tolerance * F.col(total)).alias("adds_up"))


def decompose_growth(df: DataFrame, year: str, people: str, employed: str, output: str, spans: list[tuple[int, int]]) -> DataFrame:
    """Log changes between the ends of each span that has both: people, employed share and output for each one employed."""
    ends = df.filter(F.col(year).isin([y for s in spans for y in s])).select(year, *(F.log(F.col(c).cast("double")).alias(c) for c in (people, employed, output)))
    marked = ends.withColumn("_s", F.explode(F.array(*(F.struct(F.lit(a).alias("first"), F.lit(b).alias("last")) for a, b in spans)))).filter(F.col(year).isin(F.col("_s.first"), F.col("_s.last")))

    def moved(c: Column) -> Column:
        return F.max(F.when(F.col(year) == F.col("_s.last"), c)) - F.max(F.when(F.col(year) == F.col("_s.first"), c))

    parts = {"people": F.col(people), "employed_share": F.col(employed) - F.col(people), "output": F.col(output) - F.col(employed)}
    both = marked.groupBy(F.col("_s.first").alias("first"), F.col("_s.last").alias("last")).agg(F.count_distinct(year).alias("_n"), *(moved(c).alias(n) for n, c in parts.items()))
    return both.filter("_n = 2").drop("_n")


# Companies' growth beside the economy


def growth_vs_economy(panel: DataFrame, key: str, year: str, value: str, macro: DataFrame) -> DataFrame:
    """Members with both years: pairs, share that grew faster than the economy, quartiles of growth, growth of their sum, and of what is left after inflation: median, share that grew, growth of the sum.

    macro: year, macro and, for the last three, prices.
    """
    before = panel.select(key, (F.col(year) + 1).alias(year), F.col(value).alias("_b"))
    growth = [(ratio(F.col(c), F.col(f"_{c}")) - 1).alias(n) for c, n in (("macro", "_e"), ("prices", "_i"))]
    economy = macro.join(macro.select((F.col(year) + 1).alias(year), F.col("macro").alias("_macro"), F.col("prices").alias("_prices")), year).select(year, *growth)
    rows = panel.join(before, [key, year]).join(economy, year).withColumn("_g", ratio(F.col(value), F.col("_b")) - 1)
    rows = rows.withColumn("_r", (1 + F.col("_g")) / (1 + F.col("_i")) - 1)
    aggregate = ratio(F.sum(value), F.sum("_b")) - 1
    return rows.groupBy(year).agg(
        F.count("*").alias("pairs"), ratio(F.count_if(F.col("_g") > F.col("_e")), F.count("*")).alias("beat"), F.percentile("_g", 0.25).alias("q1"), F.percentile("_g", 0.75).alias("q3"),
        aggregate.alias("aggregate"), F.median("_r").alias("real_median"), ratio(F.count_if(F.col("_r") > 0), F.count("*")).alias("real_up"), ((1 + aggregate) / (1 + F.first("_i")) - 1).alias("real_aggregate"),
    )


def scorecard_distribution(panel: DataFrame, key: str, year: str, value: str, macro: DataFrame, first: int, last: int) -> DataFrame:
    """Members with growth in every year of a span: how many outgrew the economy in how many of its years, 0 to all."""
    before = panel.select(key, (F.col(year) + 1).alias(year), F.col(value).alias("_b"))
    economy = macro.join(macro.select((F.col(year) + 1).alias(year), F.col("macro").alias("_m")), year).select(year, (ratio(F.col("macro"), F.col("_m")) - 1).alias("_e"))
    rows = panel.join(before, [key, year]).join(economy, year).filter(F.col(year).between(first, last))
    beat = ratio(F.col(value), F.col("_b")) - 1 > F.col("_e")
    each = rows.groupBy(key).agg(F.count("*").alias("_n"), F.count_if(beat).alias("beat")).filter(F.col("_n") == last - first + 1)
    every = panel.sparkSession.range(last - first + 2).select(F.col("id").alias("beat"))
    return every.join(each.groupBy("beat").agg(F.count("*").alias("members")), "beat", "left").select("beat", F.coalesce("members", F.lit(0)).alias("members"))


def sector_scorecard(panel: DataFrame, sector: str, year: str, value: str) -> DataFrame:
    """Per sector: years, years in which it grew faster than all together, and its cumulative growth relative to them."""
    own = panel.groupBy(sector, year).agg(F.sum(value).alias("_s"))
    every = own.groupBy(year).agg(F.sum("_s").alias("_s"))

    def growth(df: DataFrame, by: list[str], name: str) -> DataFrame:
        return df.join(df.select(*by, (F.col(year) + 1).alias(year), F.col("_s").alias("_b")), [*by, year]).select(*by, year, ratio(F.col("_s"), F.col("_b")).alias(name))

    rows = growth(own, [sector], "_g").join(growth(every, [], "_t"), year)
    return rows.groupBy(sector).agg(F.count("*").alias("years"), F.count_if(F.col("_g") > F.col("_t")).alias("beat"), F.exp(F.sum(F.log("_g") - F.log("_t"))).alias("relative"))


def foreign_share(parts: DataFrame, by: list[str], foreign: str, domestic: str, total: str, tolerance: float) -> DataFrame:
    """Foreign share of the rows whose two parts add up to the total within the tolerance."""
    fits = F.abs(F.col(total) - F.col(foreign) - F.col(domestic)) <= tolerance * F.abs(F.col(total))
    return parts.filter(fits).groupBy(*by).agg(F.count("*").alias("n"), ratio(F.sum(foreign), F.sum(F.col(foreign) + F.col(domestic))).alias("foreign_share"))


# Indices of what is there


def concept_index(facts: DataFrame, statements: DataFrame) -> DataFrame:
    """Per concept: facts, instants (facts without a start) and whether most are, filers, first and last year, most frequent unit (the smallest of equals) and the statement that most filings place it in. statements: accession, concept, stmt."""

    def most(df: DataFrame, col: str) -> DataFrame:
        return df.groupBy("concept", col).agg(F.count("*").alias("_n")).groupBy("concept").agg(F.min(F.struct((-F.col("_n")).alias("_n"), col))[col].alias(col))

    year = F.year("end_date")
    instants = F.count_if(F.col("start_date").isNull())
    index = facts.groupBy("concept").agg(F.count("*").alias("n_facts"), instants.alias("instants"), (instants * 2 > F.count("*")).alias("point_in_time"), F.count_distinct("cik").alias("filers"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))
    return index.join(most(facts, "unit"), "concept").join(most(statements.select("accession", "concept", "stmt").distinct(), "stmt"), "concept", "left")


def company_index(facts: DataFrame, details: DataFrame, recent: str) -> DataFrame:
    """Per company: industry, first and last date, and whether it filed since a date."""
    spans = facts.groupBy("cik").agg(F.min("end_date").alias("first_date"), F.max("end_date").alias("last_date"), (F.max("filed") >= F.lit(recent).cast("date")).alias("recent"))
    return spans.join(details, "cik", "left")


def form_mix(facts: DataFrame, top_n: int = 12) -> DataFrame:
    """Facts by year of filing and form; forms beyond the top_n most frequent are together as other."""
    sums = facts.groupBy(F.year("filed").alias("y"), "form").agg(F.count("*").alias("n"))
    top = sums.groupBy("form").agg(F.sum("n").alias("_n")).orderBy(F.desc("_n"), "form").limit(top_n).select("form", F.lit(True).alias("_top"))
    return sums.join(F.broadcast(top), "form", "left").groupBy("y", F.when(F.col("_top"), F.col("form")).otherwise("other").alias("form")).agg(F.sum("n").alias("n"))


def company_profile(facts: DataFrame, cik: int) -> DataFrame:
    """One company's periods: distinct values of each concept and date, the last filed, and whether two values are tagged."""
    own = facts.filter(F.col("cik") == cik)
    return own.groupBy("concept", "end_date").agg(F.count_distinct(F.abs("val")).alias("n_values"), F.max_by("val", F.struct("filed", "accession", "val")).alias("latest")).withColumn("two_values", F.col("n_values") > 1)


def company_years_and_quarters(facts: DataFrame, cik: int, items: dict[str, list[str]]) -> DataFrame:
    """One company's annual values and quarters, the fourth worked out where it isn't filed: item, period (year or quarter), end_date, val, source.

    items: name to concepts in order of preference. Quarters are those of statements.quarters; of a year the value filed last counts.
    """
    spans = filed_spans(facts.filter(F.col("cik") == cik), items)
    years = spans.filter("quarters = 4 AND annual").select("item", F.lit("year").alias("period"), "end_date", "val", F.lit("reported").alias("source"))
    return years.unionByName(quarters(spans).select("item", F.lit("quarter").alias("period"), "end_date", "val", "source"))


# Populations, places and lineages


def per_person(values: DataFrame, population: DataFrame, key: str, years: list[int]) -> DataFrame:
    """Value for each person with its rank within the year. A member without a value or population in one of the years stops."""
    rows = values.join(population, [key, "year"], "full").filter(F.col("year").isin(years))
    missing = rows.groupBy(key).agg(F.count(F.when(F.col("value").isNotNull() & (F.col("people") > 0), 1)).alias("_n")).filter(F.col("_n") < len(years)).limit(5).collect()
    if missing:
        raise ValueError(f"years are missing for {[r[0] for r in missing]}")
    each = rows.withColumn("per_person", ratio(F.col("value"), F.col("people")))
    return each.withColumn("rk", F.rank().over(Window.partitionBy("year").orderBy(F.desc("per_person")))).select(key, "year", "per_person", "rk")


def latest_actual(df: DataFrame, label: str, rule: str) -> DataFrame:
    """`latest_actual`: the year in a label, which is a year or a fiscal year FYyyyy/yy or SYyyyy/yy, of which the rule says how many years to add; null for any other."""
    fiscal = F.regexp_extract(label, "^[FS]Y([0-9]{4})/[0-9]{2}$", 1).try_cast("int")
    return df.withColumn("latest_actual", F.coalesce(F.when(F.col(label).rlike("^[0-9]{4}$"), F.col(label).try_cast("int")), F.col(rule) + fiscal))


def newest_edition(df: DataFrame, vintage: str, revision: str | None = None) -> DataFrame:
    """Rows of the newest edition. If a revision column is given, more than one revision in it stops."""
    newest = df.agg(F.max(vintage).alias("_newest"))
    rows = df.join(F.broadcast(newest), F.col(vintage) == F.col("_newest"), "left_semi")  # one row
    if revision and (n := rows.agg(F.count_distinct(revision)).first()[0]) > 1:
        raise ValueError(f"{n} revisions in the newest edition")
    return rows


def population_panel(df: DataFrame, key: str, year: str, value: str, projected: str, years: list[int]) -> DataFrame:
    """Wide by year, with the first projected year."""
    first = F.min(F.when(F.col(projected), F.col(year))).alias("first_projected")
    return df.groupBy(key).agg(first, *(F.max(F.when(F.col(year) == y, F.col(value))).alias(f"y{y}") for y in years))


def location_region(locations: DataFrame, level: str, wanted: str) -> DataFrame:
    """Each location with the ancestor of the wanted level, the nearest one, itself included; null if there is none. locations: id (unique), parent, name and a level.

    Links double: a round joins each open location with what its ancestor so far knows, so rounds grow with the logarithm of the deepest one; each starts from a checkpoint. Locations that
    are still open when a round settles none walk in a cycle: an error names some. A parent that isn't there ends the walk.
    """
    region = F.when(F.col(level) == wanted, F.col("name"))
    state = cut(locations.select(F.col("id").alias("_id"), region.alias("region"), F.when(region.isNull(), F.col("parent")).alias("_at")))
    open_rows = state.filter("_at IS NOT NULL").count()
    while open_rows:
        far = state.select(F.col("_id").alias("_far"), F.col("region").alias("_region"), F.col("_at").alias("_next"))
        state = cut(state.join(far, F.col("_at") == F.col("_far"), "left").select("_id", F.coalesce("region", "_region").alias("region"), "_next").withColumnRenamed("_next", "_at"))
        left = state.filter("_at IS NOT NULL").count()
        if left == open_rows:
            some = [r[0] for r in state.filter("_at IS NOT NULL").select("_id").orderBy("_id").limit(5).collect()]
            raise ValueError(f"{left} locations lead into a cycle of parents, among them {some}")
        open_rows = left
    return locations.join(state.select("_id", "region"), F.col("id") == F.col("_id"), "left").drop("_id")


def growth_ranks(panel: DataFrame, key: str, year: str, value: str) -> DataFrame:
    """Each year's rank, growth on the year before, multiple of the first year, and whether it is the member's largest drop."""
    w = Window.partitionBy(key).orderBy(year)
    rows = panel.withColumn("rk", F.rank().over(Window.partitionBy(year).orderBy(F.desc(value)))).withColumn("growth", ratio(F.col(value), F.lag(value).over(w)) - 1)
    rows = rows.withColumn("multiple", ratio(F.col(value), F.first(value).over(w)))
    least = F.min("growth").over(Window.partitionBy(key))
    return rows.withColumn("largest_drop", F.coalesce((F.col("growth") == least) & (F.col("growth") < 0), F.lit(False))).select(key, year, "rk", "growth", "multiple", "largest_drop")


def lineage(edges: DataFrame) -> DataFrame:
    """Each member `o` with its last acquirer (`survivor`) and the steps to it. edges: o, a (one acquirer each).

    `looped`: the walk leads into a cycle; the survivor is then the smallest member of that cycle, which names it, and steps are null.
    Links double: a round joins each open member with where its acquirer so far has got, so rounds grow with the logarithm of the longest walk, and each starts from a checkpoint. When a
    round ends no walk, those left are the ones that loop; their links double until they reach further than there are such members, so that the members passed hold the whole cycle.
    """
    own = edges.filter("o IS NOT NULL").select("o", F.col("a").alias("cur"), F.lit(1).cast("long").alias("steps"))
    known = own.select(F.col("o").alias("_o"))
    state = cut(own.join(known, F.col("cur") == F.col("_o"), "left").select("o", "cur", "steps", F.col("_o").isNotNull().alias("open")))
    left = state.filter("open").count()
    while left:
        far = state.select(F.col("o").alias("_o"), F.col("cur").alias("_cur"), F.col("steps").alias("_steps"), F.col("open").alias("_open"))
        moved = state.filter("open").join(far, F.col("cur") == F.col("_o")).select("o", F.col("_cur").alias("cur"), (F.col("steps") + F.col("_steps")).alias("steps"), F.col("_open").alias("open"))
        state = cut(state.filter("NOT open").unionByName(moved))
        after = state.filter("open").count()
        if after == left:
            break
        left = after
    ended = state.filter("NOT open").select("o", F.col("cur").alias("survivor"), "steps", F.lit(False).alias("looped"))
    if not left:
        return ended
    loops = cut(own.join(state.filter("open").select(F.col("o").alias("_in")), F.col("o") == F.col("_in"), "left_semi").select("o", "cur", F.col("cur").alias("least")))
    reach = 1
    while reach < left:
        far = loops.select(F.col("o").alias("_o"), F.col("cur").alias("_cur"), F.col("least").alias("_least"))
        loops = cut(loops.join(far, F.col("cur") == F.col("_o")).select("o", F.col("_cur").alias("cur"), F.least("least", "_least").alias("least")))
        reach *= 2
    # Where a walk has got by now lies in its cycle, and as many steps on pass all of it.
    named = loops.select("o", "cur").join(loops.select(F.col("o").alias("_o"), F.col("least").alias("survivor")), F.col("cur") == F.col("_o"))
    return ended.unionByName(named.select("o", "survivor", F.lit(None).cast("long").alias("steps"), F.lit(True).alias("looped")))


def survivors(lines: DataFrame) -> DataFrame:
    """Members that ended in each survivor, and the longest walk; loops have none."""
    return lines.filter("NOT looped").groupBy("survivor").agg(F.count_distinct("o").alias("merged"), F.max("steps").alias("longest"))


def tree_rows(lines: DataFrame, edges: DataFrame, least: int = 1) -> DataFrame:
    """The tree of each survivor with at least so many members: survivor, member, its acquirer and the steps left. Every member is in one tree, once."""
    large = survivors(lines).filter(F.col("merged") >= least).select("survivor")
    return lines.filter("NOT looped").join(large, "survivor").join(edges, "o").select("survivor", F.col("o").alias("member"), F.col("a").alias("acquirer"), "steps")


def alive_by_year(entities: DataFrame, start: str, end: str) -> DataFrame:
    """Entities alive at each year. Each is written once a year of its life; sums are combined before their shuffle."""
    return entities.select(F.explode(F.sequence(start, end)).alias("y")).groupBy("y").agg(F.count("*").alias("alive"))


def impute_location(places: DataFrame, events: DataFrame, key: str, city: str, cols: list[str]) -> DataFrame:
    """Places with coordinates, those of their city's mean where they lack them; places known from events alone are added. `imputed` tells them apart."""
    rows = places.select(key, city, *cols).unionByName(events.select(key, city).distinct().join(places, key, "left_anti"), allowMissingColumns=True)
    means = rows.groupBy(city).agg(*(F.avg(c).alias(f"_{c}") for c in cols))
    return rows.join(means, city, "left").select(key, city, *(F.coalesce(c, f"_{c}").alias(c) for c in cols), F.col(cols[0]).isNull().alias("imputed"))


def weekly_cases(counts: DataFrame, area: str, at: str, total: str, folded: dict[str, str], left_out: list[str]) -> DataFrame:
    """Cumulative counts as weekly cases: some areas are folded into another, roll-up areas are left out, and the last count of each week less that of the week before stands."""
    mapped = F.coalesce(F.create_map(*(F.lit(x) for pair in folded.items() for x in pair))[F.col(area)], F.col(area)) if folded else F.col(area)
    rows = counts.filter(~F.col(area).isin(left_out))
    last = rows.groupBy(area, F.date_trunc("week", at).cast("date").alias("wk")).agg(F.max_by(total, at).alias("n"))
    steps = last.withColumn("_new", F.col("n") - F.coalesce(F.lag("n").over(Window.partitionBy(area).orderBy("wk")), F.lit(0)))
    return steps.groupBy(mapped.alias("area"), "wk").agg(F.sum("_new").alias("new_cases"))


def case_comparison(a: DataFrame, b: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """Sums of two sources side by side, both cut to the last day that they have in common; zero where one lacks a group."""
    last = a.agg(F.max(at).alias("_a")).join(b.agg(F.max(at).alias("_b"))).select(F.least("_a", "_b").alias("_last"))  # one row each
    sums = [d.join(F.broadcast(last), F.col(at) <= F.col("_last")).groupBy(*by).agg(F.sum(value).alias(n)) for d, n in ((a, "left_n"), (b, "right_n"))]
    return sums[0].join(sums[1], by, "full").select(*by, *(F.coalesce(n, F.lit(0)).alias(n) for n in ("left_n", "right_n")))


def division_gaps(counts: DataFrame, divisions: DataFrame, area: str, at: list[str], total: str) -> DataFrame:
    """Times at which a division's own count isn't the sum of its areas': division, time, both. counts has both kinds of area; divisions: division, member. Areas that report nothing then count with zero."""
    own = counts.join(divisions.select(F.col("division").alias(area)).distinct(), area).select(F.col(area).alias("division"), *at, F.col(total).alias("own"))
    parts = counts.join(divisions.select("division", F.col("member").alias(area)), area).groupBy("division", *at).agg(F.sum(total).alias("parts"))
    return own.join(parts, ["division", *at], "left").withColumn("parts", F.coalesce("parts", F.lit(0))).filter("own <> parts")


def monthly_breadth(df: DataFrame, at: str, area: str, place: str, value: str) -> DataFrame:
    """Per month: sum, areas and places with a value above 0."""
    some = F.col(value) > 0
    return df.groupBy(F.date_trunc("month", at).cast("date").alias("m")).agg(F.sum(value).alias("total"), F.count_distinct(F.when(some, F.col(area))).alias("areas"), F.count_distinct(F.when(some, F.col(place))).alias("places"))


def yearly_places(df: DataFrame, at: str, place: str, value: str, many: float) -> DataFrame:
    """Per year: places, and those whose sum is at least `many`."""
    sums = df.groupBy(F.year(at).alias("y"), place).agg(F.sum(value).alias("_t"))
    return sums.groupBy("y").agg(F.count("*").alias("places"), F.count_if(F.col("_t") >= many).alias("over"))


def income_shares(df: DataFrame, year: str, place: str, income: str, total: str, jump: float) -> DataFrame:
    """Each place's share of the year's total, its change on the year before, and whether that is a jump."""
    sums = df.groupBy(year, place).agg(F.sum(income).alias("_i"), F.sum(total).alias("_t"))
    rows = sums.withColumn("share", ratio(F.col("_i"), F.sum("_t").over(Window.partitionBy(year))))
    change = F.col("share") - F.lag("share").over(Window.partitionBy(place).orderBy(year))
    return rows.select(year, place, "share", change.alias("change"), F.coalesce(F.abs(change) > jump, F.lit(False)).alias("jumped"))


def share_deciles(rows: DataFrame, year: str, share: str) -> DataFrame:
    """Per year the tenth, fiftieth and ninetieth percentile of the places' shares, exact."""
    return quantiles(rows, [year], share, {"p10": 0.1, "p50": 0.5, "p90": 0.9})


def hierarchy_ties(parts: DataFrame, totals: DataFrame, parent: str, value: str, tolerance: float) -> DataFrame:
    """Parents whose parts don't add up to their total, with both; a parent that either side lacks counts with zero there."""
    sums = parts.groupBy(parent).agg(F.sum(value).alias("parts")).join(totals.select(parent, F.col(value).alias("total")), parent, "full")
    sums = sums.select(parent, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("parts", "total")))
    return sums.withColumn("ties", F.abs(F.col("parts") - F.col("total")) <= tolerance)


def file_vintage_diff(a: DataFrame, b: DataFrame, keys: list[str], by: list[str], value: str) -> DataFrame:
    """Two vintages of a file: rows in common, changed ones, median and largest change in percent, and the key where it is largest."""
    both = a.join(b.select(*keys, F.col(value).alias("_b")), keys).withColumn("_pct", F.abs(ratio(F.col("_b"), F.col(value)) - 1) * 100)
    where = F.max_by(F.struct(*keys), F.struct("_pct", *keys))
    return both.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col(value) != F.col("_b")).alias("changed"), F.median("_pct").alias("median_pct"), F.max("_pct").alias("max_pct"), where[keys[0]].alias("where"))


def band_shares(df: DataFrame, by: list[str], value: str, edges: list[tuple[float, str]], last: str) -> DataFrame:
    """Members, value and share of each band of each group."""
    bands = df.groupBy(*by, classed(F.col(value), edges, last).alias("band")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return bands.withColumn("share", ratio(F.col("total"), F.sum("total").over(Window.partitionBy(*by))))


def band_ties(bands: DataFrame, by: list[str], national: DataFrame, value: str) -> DataFrame:
    """Per group the bands' sum less the national total (`gap`), null where one of them is missing. national: by, value."""
    sums = bands.groupBy(*by).agg(F.sum("total").alias("bands"))
    return sums.join(national.select(*by, F.col(value).alias("national")), by, "full").withColumn("gap", F.col("bands") - F.col("national"))


# Registers


def preparers(df: DataFrame, name: str, credentials: str, firms: dict[str, str], wanted: list[str], edges: list[tuple[float, str]], last: str) -> DataFrame:
    """Per name, normalized: the firm of the first pattern that it matches, rows, rows with one of the wanted credentials of a comma list, and a size class."""
    plain = F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " "))
    firm = F.coalesce(*(F.when(F.col("name").rlike(p), n) for n, p in firms.items()), F.lit("other"))
    listed = F.transform(F.split(credentials, ","), lambda x: F.trim(x))
    rows = df.select(plain.alias("name"), F.arrays_overlap(listed, F.array(*map(F.lit, wanted))).alias("_has")).groupBy("name").agg(F.count("*").alias("n"), F.count_if("_has").alias("credentialed"))
    return rows.select("name", firm.alias("firm"), "n", "credentialed", classed(F.col("n"), edges, last).alias("size_class"))


def preparers_by_state(df: DataFrame, state: str, credentials: str, codes: list[str], returns: DataFrame) -> DataFrame:
    """Per state that has returns: preparers, those with each code of a comma list (`has_<code>`), those without any, paid returns for each preparer. returns: state, paid."""
    listed = F.filter(F.transform(F.split(F.coalesce(credentials, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    counts = df.select(state, listed.alias("_l")).groupBy(state).agg(
        F.count("*").alias("preparers"), *(F.count_if(F.array_contains("_l", c)).alias(f"has_{c}") for c in codes), F.count_if(F.size("_l") == 0).alias("none")
    )
    return counts.join(returns.select(state, "paid"), state).withColumn("paid_each", ratio(F.col("paid"), F.col("preparers"))).drop("paid")


def mine_text(docs: DataFrame, id_col: str, text: str, patterns: dict[str, str]) -> DataFrame:
    """Per text and pattern that it matches: how many figures there are and the first; patterns have one group. Whole texts are read."""
    found = F.array(*(F.struct(F.lit(n).alias("pattern"), F.regexp_extract_all(text, F.lit(p), 1).alias("all")) for n, p in patterns.items()))
    return docs.select(id_col, F.inline(found)).filter(F.size("all") > 0).select(id_col, "pattern", F.size("all").alias("n"), F.element_at("all", 1).alias("first"))


def survey_groups(df: DataFrame, by: list[str], order: list[str], weight: str, answer: str, flag: str, slices: int) -> DataFrame:
    """Slices of equal weight: members, weighted share of those who answer yes, and how many answers differ from the source's own flag."""
    at = ratio(F.col("_run"), F.col("_run_total"))
    rows = running(df, by, order, {"_run": weight}).withColumn("slice", F.least(F.floor(at * slices), F.lit(slices - 1)).cast("int"))
    return rows.groupBy(*by, "slice").agg(F.count("*").alias("n"), ratio(F.sum(F.when(F.col(answer), F.col(weight)).otherwise(0)), F.sum(weight)).alias("used"), F.count_if(F.col(answer) != F.col(flag)).alias("differs"))


def adviser_table(df: DataFrame, by: list[str], value: str, flags: dict[str, str], small: float) -> DataFrame:
    """Per group: firms, median and ninetieth percentile (values that occur), small firms, share of the firms with each flag, and of those with one flag alone."""
    set_ = [F.expr(c).cast("int") for c in flags.values()]
    rows = df.withColumn("_flags", sum(set_[1:], set_[0]))
    disc = {p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY CAST(`{value}` AS DOUBLE))") for p in (0.5, 0.9)}
    return rows.groupBy(*by).agg(
        F.count("*").alias("firms"), disc[0.5].alias("med"), disc[0.9].alias("p90"), F.count_if(F.col(value) < small).alias("small"),
        *(ratio(F.count_if(F.expr(c)), F.count("*")).alias(n) for n, c in flags.items()), ratio(F.count_if(F.col("_flags") == 1), F.count("*")).alias("only_one"),
    )


def adviser_buckets(df: DataFrame, assets: str, clients: str, edges: list[tuple[float, str]], last: str, least: int = 5) -> DataFrame:
    """Firms, clients and assets by assets for each client, of firms with at least `least` clients and some assets."""
    rows = df.filter((F.col(clients) >= least) & (F.col(assets) > 0))
    each = ratio(F.col(assets), F.col(clients))
    return rows.groupBy(classed(each, edges, last).alias("bucket")).agg(F.count("*").alias("firms"), F.sum(clients).alias("clients"), F.sum(assets).alias("assets"))


def top_firms(df: DataFrame, name: str, clients: str, assets: str, n: int) -> DataFrame:
    """The n firms with the most clients: clients, share of all clients, assets for each client."""
    total = df.filter(F.col(clients) > 0).agg(F.sum(clients).alias("_t"))
    best = df.filter(F.col(clients) > 0).orderBy(F.desc(clients), name).limit(n).join(F.broadcast(total))  # one row
    return best.select(name, clients, ratio(F.col(clients), F.col("_t")).alias("share"), ratio(F.col(assets), F.col(clients)).alias("each"))


def insider_stats(trades: DataFrame, by: str) -> DataFrame:
    """Days from trade to filing (median, ninetieth percentile), filings and joint ones, which have several owners. trades: accession, cik, filed, end_date."""
    owners = trades.groupBy("accession").agg(F.count_distinct("cik").alias("_owners"))
    days = F.datediff("filed", "end_date")
    joint = F.count_distinct(F.when(F.col("_owners") > 1, F.col("accession")))
    return trades.join(owners, "accession").groupBy(by).agg(F.count("*").alias("trades"), F.percentile(days, 0.5).alias("med_lag"), F.percentile(days, 0.9).alias("p90_lag"), F.count_distinct("accession").alias("filings"), joint.alias("joint"))


def code_counts(trades: DataFrame, owners: DataFrame, code: str, relationship: str) -> DataFrame:
    """How many trades have each code, and owners each relationship: kind, label, n. A missing label is (blank)."""
    one = lambda df, c, kind: df.groupBy(F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("(blank)")).alias("label")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "label", "n")
    return one(trades, code, "code").unionByName(one(owners, relationship, "relationship"))


def crosswalk(df: DataFrame, listed: DataFrame, name: str, key: str) -> DataFrame:
    """Each name with the key of the listed name that is equal once normalized, or a problem: unknown, or ambiguous where several keys share it."""

    def plain(c: str) -> Column:
        return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))

    keys = listed.groupBy(plain(name).alias("norm")).agg(F.min(key).alias("_key"), F.count_distinct(key).alias("_n"))
    problem = F.when(F.col("_n").isNull(), "unknown").when(F.col("_n") > 1, "ambiguous")
    return df.withColumn("norm", plain(name)).join(keys, "norm", "left").select(*df.columns, "norm", F.when(F.col("_n") == 1, F.col("_key")).alias(key), problem.alias("problem"))


def merger_stats(df: DataFrame, year: Column, value: str, edges: list[tuple[float, str]], last: str, enforced: str) -> DataFrame:
    """Cases, enforced ones and their rate by year and band."""
    return df.groupBy(year.alias("y"), classed(F.col(value), edges, last).alias("band")).agg(F.count("*").alias("n"), F.count_if(F.expr(enforced)).alias("enforced"), ratio(F.count_if(F.expr(enforced)), F.count("*")).alias("rate"))


def price_population(prices: DataFrame, ref: DataFrame, watch: DataFrame) -> DataFrame:
    """Per watched ticker rows and span in both sources, splits and dividends; zero where a source lacks it."""
    a = prices.groupBy("ticker").agg(F.count("*").alias("n"), F.min("obs_date").alias("a"), F.max("obs_date").alias("b"))
    b = ref.groupBy("ticker").agg(F.count("*").alias("ref_n"), F.count_if(F.col("split_factor") != 1).alias("splits"), F.count_if(F.col("div_cash") > 0).alias("dividends"))
    rows = watch.select("ticker").distinct().join(a, "ticker", "left").join(b, "ticker", "left")
    return rows.select("ticker", F.coalesce("n", F.lit(0)).alias("n"), "a", "b", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("ref_n", "splits", "dividends")))


def regional_mean(panel: DataFrame, by: list[str], region: str, value: str, weight: str, world: str, member: str | None = None) -> DataFrame:
    """Weighted mean of each region and of all together, of rows that have both value and weight.

    With `member`, over a balanced panel: only members with a value and weight for every one of the panel's `by`.
    """
    rows = panel.filter(F.col(value).isNotNull() & F.col(weight).isNotNull())
    if member is not None:
        every = panel.select(*by).distinct().agg(F.count("*").alias("_all"))
        whole = rows.groupBy(member).agg(F.count_distinct(F.struct(*by)).alias("_n")).join(F.broadcast(every))  # one row
        rows = rows.join(whole.filter("_n = _all").select(member), member, "left_semi")
    sums = rows.groupBy(region, *by).agg(F.sum(F.col(value) * F.col(weight)).alias("_v"), F.sum(weight).alias("_w"))
    every = sums.groupBy(*by).agg(F.sum("_v").alias("_v"), F.sum("_w").alias("_w"))
    return sums.select(F.col(region).cast("string").alias(region), *by, "_v", "_w").unionByName(every.select(F.lit(world).alias(region), *by, "_v", "_w")).select(region, *by, ratio(F.col("_v"), F.col("_w")).alias("weighted"))


def domicile_matrix(details: DataFrame, codes: DataFrame, addresses: str) -> DataFrame:
    """Companies by country of incorporation and of the head office, from a JSON of codes (home, office) through one code table joined twice; an unknown code is its own name."""
    parsed = details.select(F.from_json(addresses, "struct<home string, office string>").alias("_x")).select("_x.home", "_x.office")
    for side in ("home", "office"):
        parsed = parsed.join(codes.select(F.col("code").alias(side), F.col("name").alias(f"_{side}")), side, "left")
    return parsed.groupBy(*(F.coalesce(f"_{s}", s).alias(s) for s in ("home", "office"))).agg(F.count("*").alias("n"))


def trade_flows(flows: DataFrame, gdp: DataFrame) -> DataFrame:
    """Of the latest year that flows and gdp share: each origin's partners, exports, openness (exports over gdp), largest partner and its share, and balance. flows: year, origin, dest, v; gdp: year, place, gdp."""
    latest = flows.select("year").distinct().join(gdp.select("year").distinct(), "year").agg(F.max("year").alias("year"))
    rows = flows.join(F.broadcast(latest), "year", "left_semi")  # one row
    out = rows.groupBy(F.col("origin").alias("place")).agg(F.count_distinct("dest").alias("partners"), F.sum("v").alias("exports"), F.max(F.struct("v", "dest")).alias("_top"))
    back = rows.groupBy(F.col("dest").alias("place")).agg(F.sum("v").alias("imports"))
    both = out.join(back, "place", "full").join(gdp.join(F.broadcast(latest), "year", "left_semi").select("place", "gdp"), "place", "left")
    exports, imports = F.coalesce("exports", F.lit(0)), F.coalesce("imports", F.lit(0))
    return both.select(
        "place", F.coalesce("partners", F.lit(0)).alias("partners"), exports.alias("exports"), (exports - imports).alias("balance"), ratio(exports, F.col("gdp")).alias("openness"),
        F.col("_top.dest").alias("largest"), ratio(F.col("_top.v"), F.col("exports")).alias("largest_share"),
    )


def partner_coverage(flows: DataFrame, totals: DataFrame, members: int) -> DataFrame:
    """Of the latest year in which `members` places report both exports and imports to the world: each place and direction, its world total and the share of it that the named partners make up.

    flows: year, place, direction, partner, v. totals: year, place, direction, v.
    """
    complete = totals.groupBy("year").agg(F.count_distinct("place", "direction").alias("_n")).filter(F.col("_n") == 2 * members).agg(F.max("year").alias("year"))
    latest = lambda df: df.join(F.broadcast(complete), "year", "left_semi")  # noqa: E731  one row
    parts = latest(flows).groupBy("place", "direction").agg(F.sum("v").alias("_p"))
    whole = latest(totals).groupBy("year", "place", "direction").agg(F.sum("v").alias("total"))
    return whole.join(parts, ["place", "direction"], "left").select("year", "place", "direction", "total", ratio(F.coalesce("_p", F.lit(0)), F.col("total")).alias("covered"))
