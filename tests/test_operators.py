"""Fault injection and equivalence of the merges."""

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import bitemporal, checks, economy, finance, joins, merge, quality, statements

LANDINGS = [
    ("r1", 1, "a"), ("r2", 1, "a"), ("r3", 1, "a"), ("r1", 2, "a"), ("r2", 2, "b"), ("r3", 2, "b"), ("r1", 3, "a"), ("r2", 3, "b"), ("r3", 3, "a"), ("r1", 4, "a"),
    ("r2", 5, "x"), ("r3", 5, "x"), ("r1", None, "n"), ("r3", None, None), ("r3", 6, None),
]


@pytest.mark.parametrize("base_runs", [0, 1, 2, 3])
def test_merge_into_base_equals_reading_all(spark, base_runs):
    rows = spark.createDataFrame(LANDINGS, "run_id string, id int, val string")
    whole = merge.merge_newest(rows, ["id"], ["run_id"]).collect()
    assert {(r.id, r.val): r.run_id for r in whole} == {(1, "a"): "r1", (2, "b"): "r2", (3, "a"): "r3", (4, "a"): "r1", (5, "x"): "r2", (None, None): "r3", (6, None): "r3"}
    base = merge.merge_newest(rows.filter(f"run_id <= 'r{base_runs}'"), ["id"], ["run_id"])
    got = merge.merge_into_base(rows.filter(f"run_id > 'r{base_runs}'"), base, ["id"], ["run_id"])
    assert sorted(map(str, got.select("run_id", "id", "val").collect())) == sorted(map(str, rows.sparkSession.createDataFrame(whole, rows.schema).select("run_id", "id", "val").collect()))


def test_withdrawn_value_wins_then_goes(spark):
    rows = [("s", "2024-01-01", "2024-01-01", 1.0), ("s", "2024-01-01", "2024-02-01", None), ("s", "2024-01-02", "2024-01-02", 2.0)]
    obs = spark.createDataFrame(rows, "series_id string, obs_date string, vintage string, value double")
    assert [r.value for r in bitemporal.latest_vintage(obs, ["series_id", "obs_date"]).collect()] == [2.0]


@pytest.mark.parametrize(("direction", "inclusive", "want"), [("backward", True, [None, 3, 3, 7]), ("backward", False, [None, None, 3, 3]), ("forward", True, [3, 3, 7, 7]), ("forward", False, [3, 7, 7, None])])
def test_asof(spark, direction, inclusive, want):
    left = spark.createDataFrame([("k", t) for t in (1, 3, 5, 7)], "k string, t int")
    right = spark.createDataFrame([("k", 3), ("k", 7), ("j", 4)], "k string, u int")
    got = joins.asof_join(left, right, "t", "u", ["k"], ["u"], direction, inclusive).orderBy("t").collect()
    assert [r.u for r in got] == want


def test_checks_find_faults(spark):
    good = spark.range(3)
    rules = [quality.Check("A", "error", True, "g", lambda: good.filter("id > 9")), quality.Check("B", "warn", True, "g", lambda: good), quality.Check("C", "error", True, "h", lambda: good)]
    got = {r.check_id: (r.status, r.failing_rows) for r in quality.run_checks(spark, rules).collect()}
    assert got == {"A": ("passed", 0), "B": ("warn", 3), "C": ("error", 3)}
    assert {r.source_group: r.verdict for r in quality.verdicts(quality.run_checks(spark, rules)).collect()} == {"g": "passed", "h": "blocked"}
    with pytest.raises(ValueError):
        quality.require_none(good, {"large": "id > 1"})
    with pytest.raises(ValueError):
        quality.run_checks(spark, rules[:1] * 2)
    with pytest.raises(ValueError):
        quality.assert_row_preserving(good, good.filter("id > 0"))


def test_guards_of_merges(spark):
    base = spark.createDataFrame([(1, "a", "1995Q1", "r1"), (2, "b", "1995Q2", "r1")], "id int, val string, quarter string, run_id string")
    new = spark.createDataFrame([(1, "c", "1995Q1", "r2")], base.schema)
    assert {(r.id, r.val) for r in merge.merge_partitions(new, base, ["id"], ["run_id"], "quarter").collect()} == {(1, "c")}
    for row, words in (((2, "c", "1995Q1", "r2"), "other partitions"), ((1, "c", "spring", "r2"), "labels")):
        with pytest.raises(ValueError, match=words):
            merge.merge_partitions(spark.createDataFrame([row], base.schema), base, ["id"], ["run_id"], "quarter")
    with pytest.raises(ValueError, match="repeated"):
        merge.require_unique(base.unionByName(base), ["id"])
    changes = spark.createDataFrame([("r1", 1, "full"), ("r1", 2, "incremental")], "run_id string, cik int, mode string")
    with pytest.raises(ValueError, match="two modes"):
        merge.change_set(changes, changes, "cik")
    with pytest.raises(ValueError, match="negative"):
        merge.edition_difference(spark.createDataFrame([("g", 1, 5), ("g", 2, 3)], "g string, e int, v int"), ["g"], "e", "v", 1, 2)
    pulls = merge.classify_pulls(spark.createDataFrame([("k", d, 8.0) for d in (3, 4)], "k string, d int, v double"), spark.createDataFrame([("k", d, 2.0) for d in (1, 3, 4)], "k string, d int, v double"), "k", "d", "v").first()
    assert (pulls.kind, pulls.split_flag, pulls.window_extended) == ("rebase", True, True)


def test_window_join_requires_one(spark):
    rows = spark.createDataFrame([("k", 1), ("k", 5)], "k string, t int")
    windows = spark.createDataFrame([("k", 0, 3), ("k", 4, 9)], "k string, a int, b int")
    assert joins.window_join(rows, windows, "k", "t", "a", "b", True).count() == 2
    for extra in (("k", 5, 6), ("j", 0, 9)):
        more = windows.unionByName(spark.createDataFrame([extra], windows.schema)) if extra[0] == "k" else windows.filter("a = 0")
        with pytest.raises(ValueError):
            joins.window_join(rows, more, "k", "t", "a", "b", True)


def test_company_years_rule(spark):
    """Late filings win, durations and forms are held to, the concept of priority stands, shells go."""
    rows = [
        (1, "Rev", 1, "2000-01-01", "2000-12-31", "2001-02-01", "10-K", 10.0), (1, "Rev", 2, "2000-01-01", "2000-12-31", "2002-02-01", "10-K", 11.0), (1, "Rev", 3, "2000-07-01", "2000-12-31", "2003-02-01", "10-K", 99.0),
        (1, "Rev", 4, "2000-01-01", "2000-12-31", "2004-02-01", "10-K/A", 98.0), (1, "Sales", 5, "2000-01-01", "2000-12-31", "2001-02-01", "10-K", 12.0), (1, "Sales", 6, "2001-01-01", "2001-12-31", "2002-02-01", "10-K", 13.0),
        (2, "Rev", 7, "2000-01-01", "2000-12-31", "2001-02-01", "10-K", 14.0), (3, "Rev", 8, "2000-01-01", "2000-12-31", "2000-12-01", "10-K", 15.0), (4, "Rev", 9, "2000-01-01", "2000-12-31", "2001-02-01", "10-K", 0.0),
    ]
    facts = spark.createDataFrame(rows, "cik int, concept string, accession int, start_date string, end_date string, filed string, form string, val double")
    for c in ("start_date", "end_date", "filed"):
        facts = facts.withColumn(c, F.col(c).cast("date"))
    got = finance.company_years(facts, spark.createDataFrame([(1, 10), (2, 6770)], "cik int, sic int"), ["Rev", "Sales"], [6770]).collect()
    assert sorted((r.cik, r.fy, r.concept, r.val) for r in got) == [(1, 2000, "Rev", 11.0), (1, 2001, "Sales", 13.0)]


def test_ratios_are_null_where_undefined(spark):
    lines = "revenue cost_of_revenue operating_income net_income capex d_and_a total_assets equity receivables inventory payables net_ppe current_assets current_liabilities".split()
    lines += [f"avg_{x}" for x in ("total_assets", "equity", "receivables", "inventory", "payables", "net_ppe")] + ["days"]
    rows = [(1, *[2.0] * len(lines)), (2, 2.0, *[0.0] * (len(lines) - 1)), (3, 1.0, *[-1.0] * (len(lines) - 1)), (4, 0.0, *[1.0] * (len(lines) - 1))]
    got = {r.cik: r for r in statements.ratios(spark.createDataFrame(rows, f"cik int, {', '.join(f'{c} double' for c in lines)}"), ["cik"]).collect()}
    assert len(statements.RATIOS) == 15 and set(got) == {1, 2, 3}
    assert got[1].net_margin == 1.0 and got[1].gross_margin == 0.0 and got[1].cash_cycle == 2.0 and got[1].receivable_days == 2.0
    zero = {n for n in statements.RATIOS if got[2][n] is None}
    assert zero == {"return_on_assets", "return_on_equity", "inventory_days", "payable_days", "cash_cycle", "capex_to_depreciation", "ppe_turnover", "asset_turnover", "current_ratio", "assets_to_equity"}
    assert got[3].return_on_equity is None and got[3].assets_to_equity is None and got[3].net_margin == -1.0


def test_restatements_say_how(spark):
    rows = [("a", 1, "2001-01-01", 5.0, "10-K"), ("a", 2, "2002-01-01", 5000.0, "10-K"), ("b", 1, "2001-01-01", 5.0, "10-K"), ("b", 2, "2001-06-01", 6.0, "10-K/A"), ("c", 1, "2001-01-01", 5.0, "10-K"), ("c", 2, "2002-01-01", 5.02, "10-K"), ("d", 1, "2001-01-01", 5.0, "10-K")]
    facts = spark.createDataFrame(rows, "k string, accession int, filed string, val double, form string")
    got = {r.k: (r.how, r.band) for r in finance.restatements(facts, ["k"], [0.01, 0.05, 0.2, 1.0]).collect()}
    assert got == {"a": ("scale", 4), "b": ("amended", 2), "c": ("later", 0)}


def test_lineage_and_loops(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 50)] + [(100, 101), (101, 100)], "o long, a long")
    got = {r.o: (r.survivor, r.steps, r.looped) for r in economy.lineage(edges).collect()}
    assert all(got[i] == (50, 50 - i, False) for i in range(1, 50)) and got[100][2] and got[101][2]
    assert [(r.survivor, r.merged) for r in economy.survivors(economy.lineage(edges)).collect()] == [(50, 49)]


def test_periods_behind(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-03-31')) AS session")
    catalog = spark.createDataFrame([(s, f, None, lag) for s, f, lag in (("d0", "D", 0), ("d1", "D", 0), ("m", "M", 10), ("q", "Q", 0), ("x", "X", 0), ("none", "D", 0))], "series_id string, frequency string, active_to date, expected_lag_days int")
    obs = spark.createDataFrame([("d0", "2024-03-31"), ("d1", "2024-03-30"), ("m", "2023-12-01"), ("q", "2023-07-01"), ("x", "2024-01-01")], "series_id string, obs_date string").withColumn("obs_date", F.col("obs_date").cast("date"))
    behind = checks.periods_behind(catalog, obs, days, "2024-03-31")
    assert {r.series_id: r.behind for r in behind.collect()} == {"d0": 0, "d1": 1, "m": 2, "q": 1, "x": None, "none": None}
    assert {r.series_id for r in checks.late_series(behind).collect()} == {"d1", "q"}
    assert {r.series_id: r.problem for r in checks.stale_series(behind).collect()} == {"m": "stale", "x": "uncountable", "none": "no_rows"}


def test_reconciliation_names_each_fault(spark):
    log = spark.createDataFrame([("a", 1, "h"), ("b", 2, "h"), ("c", 3, "h"), ("e", 5, "h")], "f string, rows int, hash string")
    files = spark.createDataFrame([("a", 1, "h"), ("b", 9, "h"), ("c", 3, "x"), ("d", 4, "h")], "f string, rows int, hash string")
    assert {r.f: r.problem for r in checks.raw_reconciliation(log, files, ["f"]).collect()} == {"b": "count", "c": "hash", "d": "no_record", "e": "missing"}


def test_composition(spark):
    groups = spark.createDataFrame([(g,) for g in "abcdef"], "source_group string")
    verdicts = spark.createDataFrame([("a", "passed"), ("b", "blocked"), ("c", "failed")], "source_group string, verdict string")
    got = checks.compose(groups, verdicts, groups.filter("source_group < 'e'"), spark.createDataFrame([("b", "r1"), ("e", "r1")], "source_group string, run_id string"), "r2")
    want = {"a": ("published", "r2", None), "b": ("carried_forward", "r1", "blocked"), "c": ("failed", None, "failed"), "d": ("never_published", None, "no_verdict"), "e": ("carried_forward", "r1", "not_run"), "f": ("not_run", None, "not_run")}
    assert {r.source_group: (r.outcome, r.source_run, r.reason) for r in got.collect()} == want


def test_run_log_and_days_without_run(spark):
    manifest = spark.createDataFrame([("r1", "published"), ("r1", "blocked"), ("r2", "failed"), ("r2", "blocked"), ("r3", "carried_forward"), ("r4", "published"), ("r4", "carried_forward"), ("r5", "published")], "run_id string, outcome string")
    loads = spark.createDataFrame([("r1", "2024-01-01 00:00:00"), ("r1", "2024-01-01 00:01:30"), ("r2", "2024-01-04 00:00:00"), ("r9", "2024-01-02 00:00:00")], "run_id string, loaded_at string").withColumn("loaded_at", F.col("loaded_at").cast("timestamp"))
    results = spark.createDataFrame([("r1", "B", "error"), ("r1", "A", "warn"), ("r1", "C", "acknowledged"), ("r2", "A", "passed")], "run_id string, check_id string, status string")
    got = {r.run_id: (r.outcome, r.seconds, r.blocked, r.failed, r.failing_checks) for r in checks.run_log(manifest, loads, results).collect()}
    assert got == {"r1": ("partial", 90, 1, 0, "A,B"), "r2": ("failed", 0, 1, 1, None), "r3": ("carried", None, 0, 0, None), "r4": ("partial", None, 0, 0, None), "r5": ("published", None, 0, 0, None), "r9": ("died", 0, 0, 0, None)}
    assert [str(r.d) for r in checks.days_without_run(checks.run_log(manifest, loads)).collect()] == ["2024-01-03"]


def test_audit_reports_too_few_dates(spark):
    rows = [("a", f"2024-01-0{d}", 0.1 if d == 2 else 0.0) for d in range(1, 5)] + [("b", "2024-01-01", 0.0), ("b", "2024-01-02", None)]
    gaps = spark.createDataFrame(rows, "ticker string, obs_date string, gap double").withColumn("obs_date", F.col("obs_date").cast("date"))
    got = {(r.ticker, r.obs_date and str(r.obs_date), r.kind) for r in checks.audit(gaps, 0.05, 2, spark.createDataFrame([("c",), ("a",)], "ticker string")).collect()}
    assert got == {("a", "2024-01-02", "isolated"), ("b", None, "too_few"), ("c", None, "too_few")}


def test_division_gaps_and_bands(spark):
    counts = spark.createDataFrame([("D", 1, 5), ("a", 1, 2), ("b", 1, 3), ("D", 2, 4), ("a", 2, 1), ("D", 3, 7)], "area string, w int, n int")
    divisions = spark.createDataFrame([("D", "a"), ("D", "b")], "division string, member string")
    assert sorted(map(tuple, economy.division_gaps(counts, divisions, "area", ["w"], "n").collect())) == [("D", 2, 4, 1), ("D", 3, 7, 0)]
