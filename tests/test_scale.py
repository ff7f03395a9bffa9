"""Operators that spread one group over many tasks, keep state beside partitions or iterate: each against a plain form."""

import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from palimpsest.operators import checks, economy, joins, merge, publish, quality, ranges, windows
from palimpsest.plans.fixtures import table
from palimpsest.queries import finance
from palimpsest.streaming.landings import ServedTable, stream_merge

from .conftest import SF


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Shares near a bound


def test_shares_of_large_decimal_weights_are_not_rounded_over_a_bound(spark):
    df = spark.createDataFrame([("g", 1, "1999999.50"), ("g", 2, "8000000.50")], "g string, k int, w string").withColumn("w", F.col("w").cast("decimal(28,2)"))
    assert rows_of(windows.weight_groups(df, ["g"], ["k"], "w", 5).select("k", "weight_group")) == [(1, 0), (2, 0)]
    assert rows_of(windows.weight_slices(df, ["g"], ["k"], "w", 5).select("k", "slice")) == [(1, 0), (2, 0)]
    assert rows_of(windows.weighted_position(df, ["g"], ["k"], "w").select("k", "position")) == [(1, 0.19999995), (2, 1.0)]
    assert rows_of(windows.weighted_percentiles(df, ["g"], "k", [], "w", [0.2])) == [("g", 2)]


# One hot group


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_asof_of_a_hot_key_equals_brute_force(spark, direction, inclusive):
    rnd = random.Random(1)
    some = lambda top: rnd.choice([None, *range(top)])
    left = [(i, rnd.choice(["hot"] * 8 + ["a", None]), some(60)) for i in range(400)]
    right = [(rnd.choice(["hot"] * 8 + ["a", None]), some(60), rnd.randint(0, 9)) for _ in range(70)]
    want = []
    for i, k, t in left:
        met = [(u, p) for j, u, p in right if k is not None and j == k and t is not None and u is not None and (u == t and inclusive or (u < t if direction == "backward" else u > t))]
        best = (max if direction == "backward" else min)(met, default=(None, None))
        want.append((i, k, t, *best))
    l, r = spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "k string, u int, p int")
    for n in (1, 5):
        got = joins.asof_join(l, r, "t", "u", ["k"], ["u", "p"], direction, inclusive, ranges=n)
        assert rows_of(got) == sorted(want, key=repr), n


def test_asof_ranges_spread_a_hot_key(spark):
    l = spark.range(10_000).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("t"))
    r = spark.range(0, 10_000, 7).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("u"))
    both = l.select("t").withColumn("range", joins._cuts(l, "t", 8))
    assert both.groupBy("range").count().filter("count BETWEEN 1000 AND 1500").count() == 8
    got = joins.asof_join(l, r, "t", "u", ["k"], ["u"], ranges=8).select((F.unix_seconds("t") - F.unix_seconds("u")).alias("d"), F.unix_seconds("t").alias("t"))
    assert got.filter("d <> t % 7").isEmpty() and got.count() == 10_000


def test_running_sums_equal_windows(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice([None, "hot", "hot", "hot", "b"]), rnd.choice([None, *range(20)]), rnd.choice([None, 1, 2, 3])) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, g string, o int, v int").repartition(7)
    for order in (["o", "i"], [F.desc("o"), "i"]):
        w = Window.partitionBy("g")
        want = df.withColumn("s", F.sum("v").over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).withColumn("s_total", F.sum("v").over(w))
        assert rows_of(ranges.running(df, ["g"], order, {"s": "v"})) == rows_of(want)
    got = ranges.running(df, [], ["i"], {"n": F.lit(1)})
    assert got.filter("n <> i + 1").isEmpty()
    assert ranges.running(df.limit(0), ["g"], ["i"], {"n": F.lit(1)}).count() == 0


def test_running_sums_spread_one_group(spark, monkeypatch):
    """One group fills several ranges, none of which holds most of it."""
    seen, keep = [], ranges.kept
    monkeypatch.setattr(ranges, "kept", lambda df: seen.append(keep(df)) or seen[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        df = spark.range(20_000).select(F.lit(1).alias("g"), "id")
        assert ranges.running(df, ["g"], ["id"], {"n": F.lit(1)}).filter("n <> id + 1").isEmpty()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in seen[0].groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 7000


def test_quantiles_equal_percentiles(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "b", None]), rnd.choice([None, 0.0, rnd.random(), rnd.gauss(0, 9)])) for _ in range(2000)] + [("nulls", None), ("one", 5.0), ("two", 1.0), ("two", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"lo": 0.0, "q1": 0.25, "med": 0.5, "p9": 0.9, "hi": 1.0}
    want = df.groupBy("g").agg(*(F.percentile("v", p).alias(n) for n, p in probs.items()))
    assert rows_of(ranges.quantiles(df, ["g"], "v", probs)) == rows_of(want)


def test_products_of_zeros_negatives_and_nulls(spark):
    rows = [(k, i, f) for k, fs in {"z": [2.0, 0.0, 5.0], "m": [-2.0, 3.0, -4.0, 0.5], "n": [2.0, None, 3.0]}.items() for i, f in enumerate(fs)]
    got = windows.cum_factor_after(spark.createDataFrame(rows, "k string, i int, f double"), ["k"], "i", "f")
    values = {(r.k, r.i): r.factor_after if r.factor_after is None else round(r.factor_after, 9) for r in got.collect()}
    assert values == {("z", 0): 0.0, ("z", 1): 5.0, ("z", 2): 1.0, ("m", 0): -6.0, ("m", 1): -2.0, ("m", 2): 0.5, ("m", 3): 1.0, ("n", 0): None, ("n", 1): 3.0, ("n", 2): 1.0}
    days = lambda rows, cols: spark.createDataFrame(rows, f"ticker string, obs_date string, {cols}").withColumn("obs_date", F.col("obs_date").cast("date"))
    obs = days([("t", f"2024-01-0{i}", 8.0) for i in (1, 2, 3)], "close double")
    ref = days([("t", "2024-01-01", 8.0, 1.0), ("t", "2024-01-02", 8.0, 0.0), ("t", "2024-01-03", 16.0, 2.0)], "close double, split_factor double")
    out = {str(r.obs_date): r.ref_close for r in checks.reconcile_prices(obs, ref, days([], "amount double")).collect()}
    assert {k: v and round(v, 9) for k, v in out.items()} == {"2024-01-01": None, "2024-01-02": 4.0, "2024-01-03": 16.0}


# Walks


def test_lineage_names_cycles(spark):
    chain = [(i, i + 1) for i in range(1000, 1200)]
    cycle = [(7, 3), (3, 9), (9, 7)] + [(20 + i, 21 + i) for i in range(30)] + [(50, 9)]
    edges = spark.createDataFrame(chain + cycle + [(1, 1), (2, None), (5, 1)], "o long, a long")
    got = {r.o: (r.survivor, r.steps, r.looped) for r in economy.lineage(edges).collect()}
    assert all(got[i] == (1200, 1200 - i, False) for i, _ in chain)
    assert {got[i] for i, _ in cycle} == {(3, None, True)} and got[1] == got[5] == (1, None, True) and got[2] == (None, 1, False)
    assert len(got) == edges.count() and economy.lineage(edges.limit(0)).count() == 0


def test_regions_of_deep_trees_and_cycles(spark):
    rows = [(0, None, "R", "region")] + [(i, i - 1, f"n{i}", "place") for i in range(1, 100)] + [(200, None, "S", "top"), (201, 200, "t", "place"), (300, 999, "lost", "place")]
    df = spark.createDataFrame(rows, "id long, parent long, name string, level string")
    got = {r.id: r.region for r in economy.location_region(df, "level", "region").collect()}
    assert all(got[i] == "R" for i in range(100)) and got[200] is got[201] is got[300] is None
    looped = df.unionByName(spark.createDataFrame([(400, 401, "a", "place"), (401, 400, "b", "place"), (402, 401, "c", "place")], df.schema))
    with pytest.raises(ValueError, match=r"3 locations .*\[400, 401, 402\]"):
        economy.location_region(looped, "level", "region")


def test_last_as_high_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = [(k, t, rnd.choice([None, *range(6)])) for k in ("a", "b") for t in range(200)]
    want = [(k, t, v, max((u for j, u, w in rows if j == k and u < t and w is not None and v is not None and w >= v), default=None)) for k, t, v in rows]
    df = spark.createDataFrame([(k, t, None if v is None else float(v)) for k, t, v in rows], "k string, t int, v double").repartition(3)
    got = economy.last_as_high(df, ["k"], "t", "v", "high")
    assert rows_of(got) == sorted([(k, t, None if v is None else float(v), h) for k, t, v, h in want], key=repr)


# State beside partitions


def test_key_index_prunes_the_guard(spark, tmp_path):
    base = spark.range(4000).select("id", F.concat(F.lit("v"), F.col("id")).alias("v"), F.concat(F.lit("199"), F.floor(F.col("id") / 1000), F.lit("Q1")).alias("quarter"), F.lit("r1").alias("run_id"))
    base.write.partitionBy("quarter").parquet(str(tmp_path / "base"))
    stored = spark.read.parquet(str(tmp_path / "base"))
    index = merge.key_index(stored, ["id"], "quarter")
    assert [(r.part, r.n, r.lo, r.hi) for r in index.orderBy("part").collect()] == [(f"199{i}Q1", 1000, 1000 * i, 1000 * i + 999) for i in range(4)]
    assert all(len(r.words) == r["mask"] + 1 for r in index.collect())
    present = merge.may_hold(stored.select("id"), index, ["id"]).join(stored.select("id", F.col("quarter").alias("part")), ["id", "part"])
    assert present.count() == 4000
    absent = spark.range(10_000, 20_000).withColumn("id", F.col("id") % 4000 + 0.5)
    wide = merge.key_index(stored.withColumn("id", F.col("id").cast("double")), ["id"], "quarter")
    assert merge.may_hold(absent, wide, ["id"]).count() < 0.01 * absent.select("id").distinct().count()
    new = spark.createDataFrame([(5, "new", "1990Q1", "r2"), (9000, "x", "1990Q1", "r2")], "id long, v string, quarter string, run_id string")
    assert rows_of(merge.merge_partitions(new, stored, ["id"], ["run_id"], "quarter", index=index)) == rows_of(merge.merge_partitions(new, stored, ["id"], ["run_id"], "quarter"))
    guard = merge.held_elsewhere(new, stored.filter("quarter <> '1990Q1'"), ["id"], "quarter", index.filter("part <> '1990Q1'"))
    assert guard.isEmpty() and "Scan parquet" not in guard._jdf.queryExecution().toString().split("Physical Plan")[1]
    moved = spark.createDataFrame([(2500, "new", "1990Q1", "r2")], new.schema)
    guard = merge.held_elsewhere(moved, stored.filter("quarter <> '1990Q1'"), ["id"], "quarter", index.filter("part <> '1990Q1'"))
    plan = guard._jdf.queryExecution().toString().split("Physical Plan")[1]
    assert [r.id for r in guard.collect()] == [2500] and "1992Q1" in plan and "1993Q1" not in plan
    with pytest.raises(ValueError, match="other partitions"):
        merge.merge_partitions(moved, stored, ["id"], ["run_id"], "quarter", index=index)


def test_changed_entities_take_the_newest_prior(spark):
    landed = [("e1", 1, "a", "r1"), ("e1", 1, "b", "r2"), ("e2", 2, "a", "r1"), ("e3", 3, None, "r1"), ("e4", 4, "x", "r1"), ("e5", 5, "x", "r1"), ("e5", 6, "x", "r1")]
    prior = spark.createDataFrame(landed, "e string, k int, v string, run string")
    now = [("e1", 1, "b"), ("e2", 2, "c"), ("e3", 3, None), ("e4", 4, "x"), ("e4", 40, "y"), ("e5", 5, "x"), (None, 7, "n")]
    current = spark.createDataFrame(now, "e string, k int, v string")
    manifest = merge.entity_digests(merge.newest_rows(prior, ["k"], ["run"]), "e", ["k"], ["v"])
    for kept in (None, manifest):
        got = merge.changed_entities(current, prior, "e", ["k"], ["v"], ["run"], kept)
        assert sorted(r.e or "" for r in got.collect()) == ["", "e2", "e4"]
    digests = merge.entity_digests(current.repartition(5), "e", ["k"], ["v"])
    assert rows_of(digests) == rows_of(merge.entity_digests(current.coalesce(1), "e", ["k"], ["v"]))


def files_of(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_served_table_rewrites_touched_partitions_only(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"v{i}", f"{1990 + i // 10}Q1", "r1") for i in range(50)], "id long, v string, quarter string, run_id string")
    table = ServedTable(spark, str(tmp_path), rows.schema, ["id"], ["run_id"], "quarter")
    assert table.pointers() == {} and table.read({}).count() == 0
    table.upsert(rows, 0)
    before = files_of(tmp_path / "data")
    new = spark.createDataFrame([(3, "w", "1990Q1", "r2"), (100, "n", "odd label/1", "r2")], rows.schema)
    table.upsert(new, 1)
    assert {p: b for p, b in table.pointers().items() if b == 1}.keys() == {"1990Q1", "x6F6464206C6162656C2F31"}
    assert before.items() <= files_of(tmp_path / "data").items()
    want = merge.merge_newest(rows.unionByName(new), ["id"], ["run_id"])
    assert rows_of(table.read(table.pointers())) == rows_of(want)
    table.upsert(new, 1)
    assert rows_of(table.read(table.pointers())) == rows_of(want) and [(r.batch, r.parts) for r in table.ledger().orderBy("batch").collect()] == [(0, 5), (1, 2)]
    with pytest.raises(ValueError, match="other partitions"):
        table.upsert(spark.createDataFrame([(45, "z", "1990Q1", "r3")], rows.schema), 2)
    assert rows_of(table.read(table.pointers())) == rows_of(want)
    for n in (2, 3):
        table.upsert(spark.createDataFrame([(3, f"u{n}", "1990Q1", f"r{n + 1}")], rows.schema), n)
    left = {f.split("/data/")[1].rsplit("/", 1)[0] for f in files_of(tmp_path / "data")}
    assert {f for f in left if "1990Q1" in f} == {"batch=2/part=1990Q1", "batch=3/part=1990Q1"} and "batch=0/part=1991Q1" in left
    assert table.read(table.pointers()).filter("id = 3").first().v == "u3" and table.ledger().count() == 4


def test_stream_of_nothing_is_an_empty_table(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    got = stream_merge(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), ["id"], ["run_id"], "id long, v string, run_id string")
    assert got.count() == 0 and got.columns == ["id", "v", "run_id"]


# Versions and declared checks


def test_blocked_groups_stay_on_their_run(spark, tmp_path):
    root, groups = str(tmp_path), ["a", "b", "c"]
    verdict = lambda **v: spark.createDataFrame(list(v.items()), "source_group string, verdict string")
    one = {"a": {"t": spark.range(3)}, "b": {"t": spark.range(4), "u": spark.range(1)}}
    got = publish.publish_groups(spark, root, "r1", one, verdict(a="passed", b="blocked"), groups)
    assert {(r.source_group, r.outcome, r.source_run) for r in got.collect()} == {("a", "published", "r1"), ("b", "blocked", None), ("c", "not_run", None)}
    with pytest.raises(ValueError, match="not served"):
        publish.served_group(spark, root, "b", "t")
    two = {"a": {"t": spark.range(30)}, "b": {"t": spark.range(40), "u": spark.range(10)}}
    publish.publish_groups(spark, root, "r2", two, verdict(a="failed", b="passed"), groups)
    assert publish.served_group(spark, root, "a", "t").count() == 3 and publish.served_group(spark, root, "b", "u").count() == 10
    assert {(r.source_group, r.outcome, r.source_run, r.reason) for r in publish.composition(spark, root).collect()} == {("a", "carried_forward", "r1", "failed"), ("b", "published", "r2", None), ("c", "not_run", None, "not_run")}
    publish.publish_groups(spark, root, "r3", two, verdict(a="failed", b="blocked"), groups)
    assert publish.current_version(spark, root) == "r2" and publish.served_group(spark, root, "a", "t", "r1").count() == 3
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        publish.publish_groups(spark, root, "r2", two, verdict(b="passed"), groups)
    with pytest.raises(ValueError, match="declared"):
        publish.publish_groups(spark, root, "r4", {"x": {}}, verdict(x="passed"), groups)


GOOD = "-- id: C1\n-- severity: warn\n-- gate: no\n-- group: g\n-- ack_key: id , k\n-- description: ids of note\n--\n-- more words\nSELECT id, CASE WHEN id > 1 THEN 'x' END AS k FROM range(3);\n"


@pytest.mark.parametrize(
    ("name", "change", "words"),
    [
        ("C1", ("severity: warn", "severity: bad"), "severity bad"), ("C1", ("gate: no", "gate: maybe"), "gate maybe"), ("C1", ("group: g", "group: other"), "group other"), ("C2", ("", ""), "named C2"), ("C1x", ("", ""), "named C1x"),
        ("C1", ("gate: no\n-- group: g", "gate: yes\n-- group: run"), "can't gate"), ("C1", ("severity: warn", "severity: error"), "acknowledged"), ("C1", ("-- description: ids of note\n", ""), "no description"), ("C1", ("-- id", "SELECT 1 -- id"), "no id"),
    ],
)
def test_defects_stop_discovery(spark, name, change, words):
    with pytest.raises(ValueError, match=words):
        quality.declared_checks({"C9_fine": GOOD.replace("C1", "C9"), name: GOOD.replace(*change)}, ["g"], spark.sql)


def test_declared_checks_run(spark, tmp_path):
    for n, text in {"C1_notes.sql": GOOD, "C0.sql": GOOD.replace("C1", "C0").replace("group: g", "group: run"), "readme.txt": "no check"}.items():
        (tmp_path / n).write_text(text)
    found = quality.declared_checks(quality.check_files(spark, str(tmp_path)), ["g"], spark.sql)
    assert [(c.id, c.group, c.gate, c.ack_key, c.description) for c in found] == [("C0", "run", False, ("id", "k"), "ids of note"), ("C1", "g", False, ("id", "k"), "ids of note")]
    results = quality.run_checks(spark, found)
    assert {(r.check_id, r.status, r.failing_rows) for r in results.collect()} == {("C0", "warn", 3), ("C1", "warn", 3)}
    failing = quality.failing_keys(spark, found)
    assert {(r.check_id, r.ack_key) for r in failing.collect()} == {(c, k) for c in ("C0", "C1") for k in ("0|", "1|", "2|x")}
    seen = failing.filter("check_id = 'C1' OR ack_key = '1|'")
    assert {r.check_id: r.status for r in quality.acknowledge(results, failing, seen).collect()} == {"C0": "warn", "C1": "acknowledged"}
    for files, words in (({}, "no checks"), ({"C1": GOOD, "C1_b": GOOD}, "id C1 repeats")):
        with pytest.raises(ValueError, match=words):
            quality.declared_checks(files, ["g"], spark.sql)


# Work done once


def test_tagged_facts_derive_their_quarters_once(spark, monkeypatch):
    monkeypatch.setattr(finance, "kept", lambda df: df)
    facts = finance.tags_of(spark, SF)
    assert "lineitem" not in facts._jdf.queryExecution().optimizedPlan().toString()
    assert rows_of(facts) == rows_of(table(spark, SF, "tags"))


def test_partner_coverage_sums_the_flows_once(spark):
    assert "lineitem" not in finance.l68_partner_coverage(spark, SF)._jdf.queryExecution().analyzed().toString()


def test_parts_grow_with_rows_and_keep_keys_together(spark):
    df = spark.range(100).select((F.col("id") % 30).alias("k"))
    parts = ranges.dealt(df, ["k"], 10)
    assert parts.rdd.getNumPartitions() == 10 and ranges.dealt(df, ["k"], 1000).rdd.getNumPartitions() == 4
    assert parts.select("k", F.spark_partition_id()).distinct().count() == 30


def test_restatements_deal_filings_out_by_their_number(spark):
    plan = finance.restated(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
