"""Statements, fiscal calendars and quarters on small fixtures."""

import datetime

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import statements as S

SCHEMA = "cik int, concept string, accession int, form string, start_date string, end_date string, filed string, val double, frame string"


def facts(spark, rows):
    df = spark.createDataFrame([(*r, None)[:9] for r in rows], SCHEMA)
    return df.withColumns({c: F.col(c).cast("date") for c in ("start_date", "end_date", "filed")})


def day(text):
    return datetime.date.fromisoformat(text)


def test_statements_follow_the_newest_report(spark):
    rows = [
        # an older report, an amendment and one filed after the day don't count; a later balance isn't the year's end
        (1, "Rev", 1, "10-K", "2020-01-01", "2020-12-31", "2021-02-01", 5.0), (1, "Rev", 2, "10-K", "2021-01-01", "2021-12-31", "2022-02-01", 10.0), (1, "Rev", 3, "10-K/A", "2021-01-01", "2021-12-31", "2022-03-01", 99.0),
        (1, "Rev", 4, "10-K", "2022-01-01", "2022-12-31", "2023-02-01", 98.0), (1, "Assets", 2, "10-K", None, "2022-01-15", "2022-02-01", 1.0), (1, "Assets", 2, "10-K", None, "2021-12-31", "2022-02-01", 30.0),
        (1, "Assets", 2, "10-K", None, "2020-12-31", "2022-02-01", 10.0), (1, "Assets", 1, "10-K", None, "2020-12-31", "2021-02-01", 500.0), (1, "Assets", 2, "10-K", None, "2019-12-31", "2022-02-01", 700.0),
        (1, "DepPart", 2, "10-K", "2021-01-01", "2021-12-31", "2022-02-01", 1.0), (1, "DepAll", 2, "10-K", "2021-01-01", "2021-12-31", "2022-02-01", 4.0), (1, "Cost", 2, "10-K", "2021-10-01", "2021-12-31", "2022-02-01", 3.0),
        # 53 weeks; the second concept, whose opening is its own; nothing filed in the year before the day
        (2, "Sales", 5, "10-K", "2021-01-03", "2022-01-08", "2022-03-01", 7.0), (2, "Cash", 5, "10-K", None, "2022-01-08", "2022-03-01", 2.0), (2, "Assets", 5, "10-K", None, "2021-01-02", "2022-03-01", 9.0),
        (3, "Rev", 6, "10-K", "2018-01-01", "2018-12-31", "2019-02-01", 5.0),
    ]
    lines = {"revenue": ("annual", ["Rev", "Sales"]), "cost": ("annual", ["Cost"]), "total_assets": ("instant", ["Assets", "Cash"]), "d_and_a": ("annual", ["DepPart", "DepAll"])}
    got = {r.cik: r for r in S.statements(facts(spark, rows), lines, "2022-06-01", ("d_and_a",)).collect()}
    assert set(got) == {1, 2}
    a, b = got[1], got[2]
    assert (a.accession, a.period_end, a.revenue, a.days, a.total_assets, a.avg_total_assets, a.d_and_a, a.cost) == (2, day("2021-12-31"), 10.0, 365, 30.0, 20.0, 4.0, None)
    assert (b.period_end, b.revenue, b.days, b.total_assets, b.avg_total_assets) == (day("2022-01-08"), 7.0, 371, 2.0, None)
    assert S.statements(facts(spark, rows).limit(0), lines, "2022-06-01").count() == 0


def test_panel_is_anchored_at_own_year_ends(spark):
    rows = [
        (1, "Rev", 1, "10-K", "2019-02-03", "2020-02-01", "2020-03-01", 1.0), (1, "Rev", 1, "10-K", "2018-07-01", "2019-06-30", "2020-03-01", 9.0),  # also tagged: a year to a quarter's end
        (1, "Rev", 2, "10-K", "2020-02-02", "2021-01-30", "2021-03-01", 2.0), (1, "Rev", 2, "10-K", "2019-02-03", "2020-02-01", "2021-03-01", 1.5), (1, "Inv", 2, "10-K", None, "2020-06-30", "2021-03-01", 8.0), (1, "Inv", 2, "10-K", None, "2020-02-01", "2021-03-01", 4.0),
        (2, "Rev", 3, "10-K", "2019-01-01", "2019-12-31", "2020-03-01", 5.0), (2, "Rev", 4, "10-K", "2019-04-01", "2020-03-31", "2020-05-01", 6.0),  # a changed year end: two reports in one fiscal year
        (3, "Rev", 5, "10-Q", "2019-01-01", "2019-12-31", "2020-03-01", 5.0), (3, "Rev", 6, "10-K", "2019-01-01", "2019-12-31", "2019-11-01", 5.0),
    ]
    got = {(r.cik, r.yr, str(r.end_date), r.concept, r.val) for r in S.anchored_panel(facts(spark, rows), ["Rev", "Inv"]).collect()}
    assert got == {(1, 2019, "2020-02-01", "Rev", 1.5), (1, 2019, "2020-02-01", "Inv", 4.0), (1, 2020, "2021-01-30", "Rev", 2.0), (2, 2019, "2020-03-31", "Rev", 6.0)}
    assert {r.cik for r in S.anchored_panel(facts(spark, rows), ["Rev"], spark.createDataFrame([(2,)], "cik int")).collect()} == {2}


def test_exits(spark):
    panel = spark.createDataFrame([(c, y, f"{y}-12-31", v) for c in range(1, 6) for y, v in ((2009, 4.0), (2010, 9.0), (2011, 9.0))], "cik int, yr int, end_date string, value double").withColumn("end_date", F.col("end_date").cast("date"))
    filings = spark.createDataFrame(
        [(1, "8-K", "2011-01-05", "1.03,9.01"), (2, "8-K", "2012-05-01", "5.01"), (2, "8-K", "2010-05-01", "1.03"), (3, "8-K", "2012-05-01", "15.01,1.031"), (3, "6-K", "2012-05-01", "1.03"), (4, "10-K", "2025-03-01", ""), (4, "8-K", "2012-01-01", "1.03"), (2, "10-K", "2012-02-01", "")],
        "cik int, form string, filing_date string, items string",
    ).withColumn("filing_date", F.col("filing_date").cast("date"))
    names = '[{"name":"Was","from":"2005-01-01T00:00:00.000Z","to":"2012-02-01T00:00:00.000Z"}]'
    details = spark.createDataFrame([(c, "Now", names if c == 2 else "[]" if c == 1 else None) for c in range(1, 5)], "cik int, name string, former_names string")
    got = {r.cik: (r.name, r.last_year, r.peak_year, r.why) for r in S.exits(panel, filings, details, 2012, "2025-01-01").collect()}
    assert got == {1: ("Now", 2011, 2010, "bankruptcy"), 2: ("Was", 2011, 2010, "taken_over"), 3: ("Now", 2011, 2010, "unknown"), 4: ("Now", 2011, 2010, "still_files"), 5: (None, 2011, 2010, "unknown")}
    assert S.exits(panel, filings, details, 2011, "2025-01-01").count() == 0


def test_quarters_from_any_two_spans(spark):
    span = lambda start, end, v, form="10-Q", cik=1, concept="New": (cik, concept, 1, form, start, end, "2030-01-01", v)
    rows = [
        # 52/53-week year from the end of January; the second quarter only as the half less the first, the third as nine months less the half, the fourth as the year less nine months
        span("2020-02-02", "2020-05-02", 1.0), span("2020-02-02", "2020-08-01", 3.0), span("2020-02-02", "2020-10-31", 6.0), span("2020-02-02", "2021-01-30", 10.0, "10-K"),
        # a year less three reported quarters, which disagree with the nine months; the tagged fourth differs too; an older concept only where the new one lacks the span
        span("2021-01-31", "2021-05-01", 1.0), span("2021-05-02", "2021-07-31", 2.0), span("2021-08-01", "2021-10-30", 3.0), span("2021-01-31", "2021-10-30", 7.0), span("2021-01-31", "2022-01-29", 10.0, "10-K"), span("2021-01-31", "2021-05-01", 100.0, concept="Old"),
        # the first quarter as the half less the second, and spans of other companies and lengths
        span("2019-02-03", "2019-08-03", 5.0, concept="Old"), span("2019-05-05", "2019-08-03", 2.0), span("2019-02-03", "2019-04-10", 50.0), span("2021-11-01", "2022-01-29", 4.5, "10-K", cik=2), span("2021-02-01", "2022-01-29", 9.0, "10-K", cik=2),
    ]
    spans = S.filed_spans(facts(spark, rows), {"rev": ["New", "Old"]})
    got = {(r.cik, str(r.q)): (r.val, r.source, str(r.start_date), str(r.end_date)) for r in S.quarters(spans).collect()}
    want = {
        (1, "2019-01-01"): (3.0, "difference", "2019-02-03", "2019-05-04"), (1, "2019-04-01"): (2.0, "reported", "2019-05-05", "2019-08-03"),
        (1, "2020-01-01"): (1.0, "reported", "2020-02-02", "2020-05-02"), (1, "2020-04-01"): (2.0, "difference", "2020-05-03", "2020-08-01"), (1, "2020-07-01"): (3.0, "difference", "2020-08-02", "2020-10-31"),
        (1, "2020-10-01"): (4.0, "difference", "2020-11-01", "2021-01-30"), (1, "2021-01-01"): (1.0, "reported", "2021-01-31", "2021-05-01"), (1, "2021-04-01"): (2.0, "reported", "2021-05-02", "2021-07-31"),
        (1, "2021-07-01"): (3.0, "reported", "2021-08-01", "2021-10-30"), (1, "2021-10-01"): (4.0, "less_quarters", "2021-10-31", "2022-01-29"), (2, "2021-10-01"): (4.5, "reported", "2021-11-01", "2022-01-29"),
    }
    assert got == want
    (check,) = S.quarter_checks(spans, 0.01).collect()
    assert (check.three, check.nine_months, check.nine_agrees, check.fourth, check.tagged, check.tagged_agrees) == (6.0, 7.0, False, 4.0, None, None)
    assert S.quarters(spans.limit(0)).count() == 0


def test_quarterly_revenue_of_frames(spark):
    fact = lambda concept, start, end, v, frame: (1, concept, 1, "10-Q", start, end, "2030-01-01", v, frame)
    rows = [
        fact("Rev", "2019-10-01", "2019-12-31", 1.0, "CY2019Q4"), fact("Rev", "2020-01-01", "2020-03-31", 2.0, "CY2020Q1"), fact("Rev", "2020-04-01", "2020-06-30", 3.0, "CY2020Q2"), fact("Rev", "2019-10-01", "2020-09-30", 10.0, "CY2020"),
        fact("Sales", "2020-01-01", "2020-03-31", 2.5, "CY2020Q1"), fact("Sales", "2020-07-01", "2020-09-30", 5.0, "CY2020Q3"), fact("Rev", "2021-01-01", "2021-12-31", 9.0, "CY2021"), fact("Rev", "2021-01-01", "2021-03-31", 9.0, "CY2021Q1I"),
    ]
    got = {str(r.q): (r.v, r.derived) for r in S.quarterly_revenue(facts(spark, rows), ["Rev", "Sales"]).collect()}
    assert got == {"2019-10-01": (1.0, False), "2020-01-01": (2.5, False), "2020-04-01": (3.0, False), "2020-07-01": (5.0, False)}
    got = {str(r.q): (r.v, r.derived) for r in S.quarterly_revenue(facts(spark, rows), ["Rev"], "2020-04-01").collect()}
    assert got == {"2020-04-01": (3.0, False), "2020-07-01": (4.0, True)}
    with pytest.raises(ValueError, match="more than one fact"):
        S.quarterly_revenue(facts(spark, rows + rows[:1]), ["Rev"])
