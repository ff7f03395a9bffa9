"""Statements, fiscal calendars and quarters from tagged facts.

facts: cik, concept, accession, form, start_date (null for a balance), end_date, filed, val and, where SEC's calendar frames count, frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.aggregates import arg_max
from palimpsest.operators.finance import fiscal_year, ratio

#: Days of a span of one to four quarters, of 52 or 53 weeks.
SPANS = {1: (80, 100), 2: (170, 190), 3: (260, 280), 4: (350, 380)}
#: Dates of spans that are meant to touch may be so many days apart.
SLACK = 7
ANNUAL_FORMS = ("10-K", "10-K/A")


def days_of(start: str = "start_date", end: str = "end_date") -> Column:
    return F.datediff(end, start)


def is_span(quarters: int) -> Column:
    return days_of().between(*SPANS[quarters])


# Statements of the newest annual report


def latest_reports(facts: DataFrame, as_of: str, form: str = "10-K") -> DataFrame:
    """Each company's annual report (cik, accession, period_end, filed) filed last in the year before as_of.

    Its period ends where its last full-year flow ends, for a later balance, as of a subsequent event, is not the year's; a report without one ends at its last date. Dates after the filing don't count.
    """
    day = F.lit(as_of).cast("date")
    own = facts.filter((F.col("form") == form) & (F.col("end_date") <= F.col("filed")) & (F.col("filed") <= day))
    reports = own.groupBy("cik", "accession").agg(F.coalesce(F.max(F.when(is_span(4), F.col("end_date"))), F.max("end_date")).alias("period_end"), F.min("filed").alias("filed"))
    best = reports.filter(F.col("filed") > F.add_months(day, -12)).groupBy("cik").agg(F.max(F.struct("filed", "accession", "period_end")).alias("b"))
    return best.select("cik", "b.accession", "b.period_end", "b.filed")


def statements(facts: DataFrame, lines: dict[str, tuple[str, list[str]]], as_of: str, largest: tuple[str, ...] = ()) -> DataFrame:
    """Per company the lines of its newest annual report: cik, accession, period_end, filed, a column for each line, avg_<line> for balances, and days.

    lines: name to period (annual or instant) and concepts in order of preference. A line is that of the first concept with a value for the report's own period; of the lines in `largest`, that of the
    concept with the largest. A balance's opening value is of the same concept and report, at the last date about a year before; avg_<line> is the mean of both, null if either lacks. days: length of
    the period of the line `revenue`. One pass: values of all concepts are put side by side per company.
    """
    reports = latest_reports(facts, as_of)
    kinds = {c: kind for kind, cs in lines.values() for c in cs}
    rows = facts.filter(F.col("concept").isin(sorted(kinds))).join(reports.drop("filed"), ["cik", "accession"])
    here, span = F.col("end_date") == F.col("period_end"), days_of("end_date", "period_end")
    balance, aggs = F.col("start_date").isNull(), []
    for c, kind in kinds.items():
        own = F.col("concept") == c
        shown = own & here & (is_span(4) if kind == "annual" else balance)
        before = own & balance & span.between(*SPANS[4])
        aggs.append(F.max(F.when(shown, F.struct("val", (days_of() + 1).alias("days")))).alias(f"c_{c}"))
        aggs.append(F.max(F.when(before, F.struct("end_date", "val")))["val"].alias(f"o_{c}"))
    wide = rows.groupBy("cik").agg(*aggs)
    out = []
    for name, (kind, concepts) in lines.items():
        found = [F.struct(F.col(f"c_{c}.val").alias("close"), F.lit(-n).alias("rank"), F.col(f"o_{c}").alias("opening"), F.col(f"c_{c}.days").alias("days")) for n, c in enumerate(concepts)]
        known = F.filter(F.array(*found), lambda x: x["close"].isNotNull())
        pick = F.array_max(known) if name in largest else F.get(known, F.lit(0))
        out.append(pick["close"].alias(name))
        if kind == "instant":
            out.append(((pick["close"] + pick["opening"]) / 2).alias(f"avg_{name}"))
        if name == "revenue":
            out.append(pick["days"].alias("days"))
    return reports.join(wide.select("cik", *out), "cik")


#: Ratios over the columns of statements(). Balances over a year's flow are the mean of opening and close, days are the period's own.
RATIOS = {
    "gross_margin": ("revenue - cost_of_revenue", "revenue"),
    "operating_margin": ("operating_income", "revenue"),
    "net_margin": ("net_income", "revenue"),
    "return_on_assets": ("net_income", "avg_total_assets"),
    "return_on_equity": ("net_income", "CASE WHEN equity > 0 AND avg_equity > 0 THEN avg_equity END"),
    "receivable_days": ("avg_receivables * days", "revenue"),
    "inventory_days": ("avg_inventory * days", "cost_of_revenue"),
    "payable_days": ("avg_payables * days", "cost_of_revenue"),
    "cash_cycle": ("receivable_days + inventory_days - payable_days", "1"),
    "capex_to_revenue": ("capex", "revenue"),
    "capex_to_depreciation": ("capex", "d_and_a"),
    "ppe_turnover": ("revenue", "avg_net_ppe"),
    "asset_turnover": ("revenue", "avg_total_assets"),
    "current_ratio": ("current_assets", "current_liabilities"),
    "assets_to_equity": ("total_assets", "CASE WHEN equity > 0 THEN equity END"),
}


def ratios(rows: DataFrame, ids: list[str]) -> DataFrame:
    """The ratios of each statement with revenue above 0, null where a part is missing or the denominator is 0; those over equity are null where that is not positive."""
    out = rows.filter("revenue > 0")
    for name, (top, bottom) in RATIOS.items():
        out = out.withColumn(name, ratio(F.expr(top), F.expr(bottom)))
    return out.select(*ids, *RATIOS)


# Panels by fiscal year


def anchored_panel(facts: DataFrame, concepts: list[str], ciks: DataFrame | None = None) -> DataFrame:
    """Each company's values at its own fiscal year ends: cik, yr, end_date, concept, val.

    Year ends are those of a company's reports: in each, the last end of a full-year flow. So 52- and 53-week years and a changed year end are followed, and year-long figures to other dates, which some reports
    show too, drop out. Of each concept and year end the value filed last counts; of two year ends in one fiscal year (the calendar year that holds most of it) the later.
    """
    rows = facts.filter(F.col("form").isin(*ANNUAL_FORMS) & (F.col("end_date") <= F.col("filed")) & F.col("concept").isin(concepts) & (F.col("start_date").isNull() | is_span(4)))
    rows = rows if ciks is None else rows.join(ciks.select("cik").distinct(), "cik", "left_semi")
    ends = rows.filter("start_date IS NOT NULL").groupBy("cik", "accession").agg(F.max("end_date").alias("end_date")).select("cik", "end_date").distinct()
    newest = rows.join(ends, ["cik", "end_date"], "left_semi").groupBy("cik", "concept", "end_date").agg(arg_max("val", ["filed", "accession", "val"]).alias("val"))
    last = Window.partitionBy("cik", "yr")
    dated = newest.withColumn("yr", fiscal_year("end_date")).withColumn("_last", F.max("end_date").over(last))
    return dated.filter(F.col("end_date") == F.col("_last")).select("cik", "yr", "end_date", "concept", "val")


def exits(panel: DataFrame, filings: DataFrame, details: DataFrame, before: int, still: str) -> DataFrame:
    """Companies whose last year is before `before`: cik, name, last_year, last_end, peak_year, last_report and why they left.

    panel: cik, yr, end_date, value. filings: cik, form, filing_date, items (comma list). details: cik, name, former_names (JSON list of name, from, to). The name is the one in use at the last annual report,
    as shells are renamed after a sale. why: still_files if an annual report was filed on `still` or later, bankruptcy or taken_over if a current report with item 1.03 or 5.01 was filed from 365 days before the
    last period's end on, in this order; else unknown.
    """
    known = panel.filter("value IS NOT NULL").groupBy("cik").agg(F.max("yr").alias("last_year"), F.max_by("end_date", "yr").alias("last_end"), F.max_by("yr", F.struct("value", (-F.col("yr")).alias("_first"))).alias("peak_year")).filter(F.col("last_year") < before)
    current = F.col("form").startswith("8-K")
    item = lambda n: F.max(F.when(current & F.array_contains(F.split("items", ","), n), F.col("filing_date")))
    trail = filings.groupBy("cik").agg(F.max(F.when(F.col("form").isin("10-K", "10-KT"), F.col("filing_date"))).alias("last_report"), item("1.03").alias("_bankrupt"), item("5.01").alias("_control"))
    rows = known.join(trail, "cik", "left").join(details.select("cik", "name", "former_names"), "cik", "left")
    names = F.from_json("former_names", "array<struct<name string, `from` string, `to` string>>")
    used = F.filter(names, lambda x: (F.substring(x["from"], 1, 10).cast("date") <= F.col("last_report")) & (F.substring(x["to"], 1, 10).cast("date") >= F.col("last_report")))
    since = F.date_sub("last_end", 365)
    why = F.when(F.col("last_report") >= F.lit(still).cast("date"), "still_files").when(F.col("_bankrupt") >= since, "bankruptcy").when(F.col("_control") >= since, "taken_over").otherwise("unknown")
    return rows.select("cik", F.coalesce(F.get(used, F.lit(0))["name"], "name").alias("name"), "last_year", "last_end", "peak_year", "last_report", why.alias("why"))


def split_adjusted(rows: DataFrame, split_date: str, by: float, counts: list[str], per_share: list[str]) -> DataFrame:
    """Values on the basis after a split, by when they were filed: before it, counts of shares are multiplied and figures per share divided. `adjusted` holds them."""
    old = F.col("filed") < F.lit(split_date).cast("date")
    value = F.when(old & F.col("concept").isin(counts), F.col("val") * by).when(old & F.col("concept").isin(per_share), F.col("val") / by).otherwise(F.col("val"))
    return rows.withColumn("adjusted", value)


def working_capital(rows: DataFrame) -> DataFrame:
    """Rows of a year's figures with days of inventory, receivables and payables at the year's end and the cash cycle, by a year of 365 days; the cycle is null if one of them is."""
    out = rows
    for name, (stock, flow) in {"dio": ("inventory", "cost"), "dso": ("receivables", "revenue"), "dpo": ("payables", "cost")}.items():
        out = out.withColumn(name, ratio(F.col(stock), F.col(flow)) * 365)
    return out.withColumn("ccc", F.col("dio") + F.col("dso") - F.col("dpo"))


# Quarters


def filed_spans(facts: DataFrame, items: dict[str, list[str]]) -> DataFrame:
    """Flows of one to four quarters: cik, item, start_date, end_date, quarters, val, annual (whether an annual report shows it).

    items: name to concepts in order of preference. Of each concept, span and kind of report the value filed last counts; of an item's concepts the preferred one that has the span.
    """
    length = F.coalesce(*(F.when(is_span(k), F.lit(k)) for k in SPANS))
    names = F.coalesce(*(F.when(F.col("concept").isin(cs), F.struct(F.lit(i).alias("item"), F.array_position(F.array(*map(F.lit, cs)), F.col("concept")).alias("rank"))) for i, cs in items.items()))
    rows = facts.filter(F.col("form").isin("10-Q", *ANNUAL_FORMS)).select("*", names.alias("_i"), length.alias("quarters"), F.col("form").isin(*ANNUAL_FORMS).alias("annual")).filter("_i IS NOT NULL AND quarters IS NOT NULL")
    newest = rows.groupBy("cik", "_i", "annual", "quarters", "start_date", "end_date").agg(arg_max("val", ["filed", "accession", "val"]).alias("val"))
    best = newest.groupBy("cik", F.col("_i.item").alias("item"), "annual", "quarters", "start_date", "end_date").agg(F.max_by("val", -F.col("_i.rank")).alias("val"))
    return best


def _near(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b)) <= SLACK


def quarter_of(end: str) -> Column:
    """First day of the calendar quarter that holds the middle of a fiscal quarter."""
    return F.trunc(F.date_sub(end, 45), "quarter")


def quarters(spans: DataFrame) -> DataFrame:
    """Every quarter that the filed spans give: cik, item, q (calendar quarter of its middle), start_date, end_date, val, source.

    source: reported (a span of one quarter in a quarterly report, else in an annual one), less_quarters (a year less exactly three reported ones inside it that are its first), difference (a span less a
    filed one shorter by a quarter, that begins or ends with it). A quarter of several sources has the first of this order, of equal ones the shorter span's. Dates that should touch may differ by SLACK days, so
    years of 52 and 53 weeks and any year end will do. Spans meet within a company and item.
    """
    one = spans.filter("quarters = 1").withColumn("_order", F.col("annual").cast("int"))
    reported = one.select("cik", "item", "start_date", "end_date", "val", F.lit("reported").alias("source"), "_order")
    quarterly = one.filter("NOT annual")
    year, long = spans.filter("quarters = 4 AND annual"), spans.filter("quarters > 1")
    inner = quarterly.select("cik", "item", F.col("start_date").alias("_s"), F.col("end_date").alias("_e"), F.col("val").alias("_v"))
    inside = (F.col("_s") >= F.date_sub("start_date", SLACK)) & (F.col("_e") <= F.date_add("end_date", SLACK))
    met = year.join(inner, ["cik", "item"]).filter(inside).groupBy("cik", "item", "start_date", "end_date", "val").agg(F.count("*").alias("_n"), F.max("_e").alias("_last"), F.sum("_v").alias("_sum"))
    rest = met.filter((F.col("_n") == 3) & F.datediff("end_date", "_last").between(*SPANS[1]))
    less = rest.select("cik", "item", F.date_add("_last", 1).alias("start_date"), "end_date", (F.col("val") - F.col("_sum")).alias("val"), F.lit("less_quarters").alias("source"), F.lit(2).alias("_order"))
    part = spans.select("cik", "item", F.col("quarters").alias("_k"), F.col("start_date").alias("_s"), F.col("end_date").alias("_e"), F.col("val").alias("_v"))
    pairs = long.join(part, ["cik", "item"]).filter(F.col("_k") == F.col("quarters") - 1)
    begins = pairs.filter(_near(F.col("_s"), F.col("start_date"))).select("cik", "item", F.date_add("_e", 1).alias("start_date"), "end_date", (F.col("val") - F.col("_v")).alias("val"), "quarters")
    ends = pairs.filter(_near(F.col("_e"), F.col("end_date")) & ~_near(F.col("_s"), F.col("start_date"))).select("cik", "item", "start_date", F.date_sub("_s", 1).alias("end_date"), (F.col("val") - F.col("_v")).alias("val"), "quarters")
    apart = begins.unionByName(ends).filter(is_span(1)).select("cik", "item", "start_date", "end_date", "val", F.lit("difference").alias("source"), (F.col("quarters") + 1).alias("_order"))
    every = reported.unionByName(less).unionByName(apart).withColumn("q", quarter_of("end_date"))
    best = every.groupBy("cik", "item", "q").agg(F.min(F.struct("_order", "end_date", "start_date", "val", "source")).alias("b"))
    return best.select("cik", "item", "q", "b.start_date", "b.end_date", "b.val", "b.source")


def quarter_checks(spans: DataFrame, tolerance: float) -> DataFrame:
    """Per annual span with three quarters inside (cik, item, end_date): sum of the three, the nine months filed, the year's fourth quarter worked out and as tagged, and whether each pair agrees.

    Values agree within the tolerance's share of the filed one; where none is filed, that is null.
    """
    year = spans.filter("quarters = 4 AND annual").select("cik", "item", F.col("start_date").alias("_ys"), F.col("end_date").alias("_ye"), F.col("val").alias("year"))
    inside = (F.col("start_date") >= F.date_sub("_ys", SLACK)) & (F.col("end_date") <= F.date_add("_ye", SLACK))
    first = F.datediff("_ye", "end_date") > SLACK
    rows = year.join(spans.filter("quarters IN (1, 3)"), ["cik", "item"]).filter(inside)
    three = (F.col("quarters") == 1) & ~F.col("annual") & first
    sums = rows.groupBy("cik", "item", F.col("_ye").alias("end_date"), "year").agg(
        F.count_if(three).alias("_n"), F.sum(F.when(three, F.col("val"))).alias("three"), F.max(F.when((F.col("quarters") == 3) & ~F.col("annual") & _near(F.col("start_date"), F.col("_ys")), F.col("val"))).alias("nine_months"),
        F.max(F.when((F.col("quarters") == 1) & F.col("annual") & ~first, F.col("val"))).alias("tagged"),
    )
    agree = lambda a, b: F.abs(a - b) <= tolerance * F.abs(b)
    fourth = F.col("year") - F.col("three")
    out = sums.filter("_n = 3").select("cik", "item", "end_date", "three", "nine_months", fourth.alias("fourth"), "tagged")
    return out.select("*", agree(F.col("three"), F.col("nine_months")).alias("nine_agrees"), agree(F.col("fourth"), F.col("tagged")).alias("tagged_agrees"))


def quarterly_revenue(facts: DataFrame, concepts: list[str], start: str | None = None) -> DataFrame:
    """Per company and calendar quarter the largest of the concepts, from facts with SEC's calendar frames: cik, q, v, derived.

    A missing fourth quarter is a year's frame less exactly three quarters' frames that lie inside its dates (SLACK days aside) and end a quarter before it; it stands where the middle of that quarter lies. derived: the
    largest is such a one. A company's concept with two facts in a frame stops. start: the first quarter kept.
    """
    rows = facts.filter(F.col("concept").isin(concepts) & F.col("frame").rlike("^CY[0-9]{4}(Q[1-4])?$"))
    twice = rows.groupBy("cik", "concept", "frame").agg(F.count("*").alias("n")).filter("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"frames with more than one fact: {[tuple(r)[:3] for r in twice]}")
    year, number = F.substring("frame", 3, 4).cast("int"), F.substring("frame", 8, 1).cast("int")
    own = rows.filter(F.length("frame") == 8).select("cik", "concept", "start_date", "end_date", "val", F.make_date(year, number * 3 - 2, F.lit(1)).alias("q"))
    whole = rows.filter(F.length("frame") == 6).select("cik", "concept", F.col("start_date").alias("_ys"), F.col("end_date").alias("_ye"), F.col("val").alias("_y"))
    inside = (F.col("start_date") >= F.date_sub("_ys", SLACK)) & (F.col("end_date") <= F.date_add("_ye", SLACK))
    three = whole.join(own, ["cik", "concept"]).filter(inside).groupBy("cik", "concept", "_ys", "_ye", "_y").agg(F.count("*").alias("_n"), F.max("q").alias("_last"), F.sum("val").alias("_s"))
    three = three.withColumn("q", quarter_of("_ye")).filter((F.col("_n") == 3) & (F.col("_last") == F.add_months("q", -3)))
    made = three.select("cik", "concept", "q", (F.col("_y") - F.col("_s")).alias("val")).join(own.select("cik", "concept", "q"), ["cik", "concept", "q"], "left_anti")
    every = own.select("cik", "q", "val", F.lit(False).alias("derived")).unionByName(made.select("cik", "q", "val", F.lit(True).alias("derived")))
    every = every if start is None else every.filter(F.col("q") >= F.lit(start).cast("date"))
    sums = every.groupBy("cik", "q").agg(F.max("val").alias("v"), F.max(F.when(~F.col("derived"), F.col("val"))).alias("_r"))
    return sums.select("cik", "q", "v", F.coalesce(F.col("_r") < F.col("v"), F.lit(True)).alias("derived"))
