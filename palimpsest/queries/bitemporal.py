"""Bitemporal reads over `obs`, landing merges over `landings`."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.operators import bitemporal as op
from palimpsest.operators import merge
from palimpsest.plans.fixtures import table, with_fixtures

KEYS = ["series_id", "obs_date"]
LATEST = "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id, obs_date ORDER BY vintage DESC) AS rn FROM obs) WHERE rn = 1 AND value IS NOT NULL)"
FIRST = """(SELECT f.* FROM (SELECT series_id, obs_date, min(vintage) AS vintage, arg_min(value, vintage) AS value FROM obs WHERE value IS NOT NULL GROUP BY ALL) f
 JOIN (SELECT series_id, min(vintage) AS floor FROM obs GROUP BY ALL) s ON f.series_id = s.series_id AND f.vintage > s.floor)"""
LID, LIN = ["id"], ["run_id"]
MERGED = """(SELECT id, cik, form, val, quarter, run_id FROM (SELECT *, max(CASE WHEN starts THEN run_id END) OVER (PARTITION BY id) AS last FROM (
 SELECT *, row(cik, form, val, quarter) IS DISTINCT FROM lag(row(cik, form, val, quarter)) OVER (PARTITION BY id ORDER BY run_id) AS starts FROM landings)) WHERE starts AND run_id = last)"""
COLS = ["id", "cik", "form", "val", "quarter", "run_id"]


def i1_latest_vintage(spark, d):
    return op.latest_vintage(table(spark, d, "obs"), KEYS).select(*KEYS, "vintage", "value")


def i2_as_of(spark, d):
    return op.as_of(table(spark, d, "obs"), "2024-01-20", KEYS).select(*KEYS, "vintage", "value")


def i3_first_print(spark, d):
    return op.first_print(table(spark, d, "obs"))


def i4_revision_stats(spark, d):
    return op.revision_stats(table(spark, d, "obs"))


def i5_growth_in_vintage(spark, d):
    return op.first_vs_latest_growth(table(spark, d, "obs"))


def i6_current_vintage(spark, d):
    return op.current_vintage(table(spark, d, "obs"), F.split_part("series_id", F.lit(":"), F.lit(2)) == "purchase").select(*KEYS, "vintage", "value")


def i7_release_points(spark, d):
    return op.release_points(table(spark, d, "obs"), table(spark, d, "series_catalog"), 1)


def i8_series_window(spark, d):
    return op.series_window(op.release_points(table(spark, d, "obs"), table(spark, d, "series_catalog"), 1).select("series_id", "released", "value"), "2024-01-10", "2024-01-20")


def i9_dedup_lineage(spark, d):
    cols = ["series_id", "obs_date", "value", "units", "vintage"]
    return merge.dedup_lineage(table(spark, d, "obs_raw"), cols, "run_id").select(*cols, "run_id")


def i10_landing_conflicts(spark, d):
    return merge.landing_conflicts(table(spark, d, "obs_raw"), [*KEYS, "vintage"], ["run_id"])


def i11_merge_newest(spark, d):
    return merge.merge_newest(table(spark, d, "landings"), LID, LIN).select(*COLS)


def i12_merge_into_base(spark, d):
    rows = table(spark, d, "landings")
    return merge.merge_into_base(rows.filter("run_id <> 'r1'"), merge.merge_newest(rows.filter("run_id = 'r1'"), LID, LIN), LID, LIN).select(*COLS)


def i14_merge_partitions(spark, d):
    rows = table(spark, d, "landings")
    new = rows.filter("run_id <> 'r1' AND quarter IN ('1995Q1', '1995Q2')")
    return merge.merge_partitions(new, merge.merge_newest(rows.filter("run_id = 'r1'"), LID, LIN), LID, LIN, "quarter").select(*COLS)


def i15_replace_documents(spark, d):
    rows = table(spark, d, "landings")
    new = rows.filter("run_id = 'r2' AND cik % 3 = 0")
    changes = rows.filter("run_id = 'r2' AND cik % 3 = 0").select("cik").distinct()
    return merge.replace_documents(rows.filter("run_id = 'r1'"), new, changes, "cik", LID, LIN).select(*COLS)


def i17_collapse_conflict(spark, d):
    return merge.collapse_conflict(table(spark, d, "obs_raw"), [*KEYS, "vintage"], "units")


def i18_repeated_keys(spark, d):
    return merge.repeated_keys(table(spark, d, "obs_raw"), [*KEYS, "vintage"])


def i19_changed_entities(spark, d):
    rows = table(spark, d, "landings")
    prior, values = rows.filter("run_id IN ('r1', 'r2')"), ["form", "val", "quarter"]
    manifest = merge.entity_digests(merge.newest_rows(prior.select("cik", *LID, *values, *LIN), LID, LIN), "cik", LID, values)
    return merge.changed_entities(rows.filter("run_id = 'r3'"), prior, "cik", LID, values, LIN, manifest)


def i20_change_set(spark, d):
    rows = table(spark, d, "landings")
    changes = rows.filter("run_id = 'r3' AND cik % 5 = 0").select("cik", F.lit("full").alias("mode")).distinct()
    return merge.change_set(changes, rows.filter("run_id = 'r1'"), "cik")


def i21_classify_pulls(spark, d):
    rows = table(spark, d, "landings")
    pulls = rows.select("form", F.col("id").alias("at"), "val", "run_id")
    new = pulls.filter("run_id = 'r2'").withColumn("val", F.when(F.col("form") == "P", F.col("val") * 2).otherwise(F.col("val")))
    return merge.classify_pulls(pulls.filter("run_id = 'r1' AND form <> 'O'"), new, "form", "at", "val")


def i22_stored_basis(spark, d):
    rows = table(spark, d, "landings").withColumn("is_full", (F.col("run_id") == "r1") | ((F.col("run_id") == "r2") & (F.col("cik") % 2 == 0)))
    return merge.stored_basis(rows, "cik", "id", "run_id", "is_full").select("cik", "id", "run_id", "val", "full_from")


def i24_edition_difference(spark, d):
    return merge.edition_difference(table(spark, d, "landings").withColumn("val", F.col("val").cast("decimal(18,2)")), ["form"], "run_id", "val", "r1", "r2", "id % 13 = 0").withColumn("difference", F.col("difference").cast("decimal(28,2)"))


QUERIES = {k: f for k, f in globals().items() if k[:1] == "i" and k[1:2].isdigit()}
ORACLES = {
    "i1_latest_vintage": f"SELECT series_id, obs_date, vintage, value FROM {LATEST}",
    "i2_as_of": """SELECT series_id, obs_date, vintage, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id, obs_date ORDER BY vintage DESC) AS rn
 FROM obs WHERE available_date <= DATE '2024-01-20') WHERE rn = 1 AND value IS NOT NULL""",
    "i3_first_print": f"SELECT series_id, obs_date, vintage, value FROM {FIRST}",
    "i4_revision_stats": f"""SELECT f.series_id, count(*) AS prints, count(*) FILTER (WHERE l.vintage > f.vintage) AS revised, 0 AS rebased,
 round(median(abs((l.value - f.value) / nullif(abs(f.value), 0)) * 100), 6) AS median_pct, round(max(abs((l.value - f.value) / nullif(abs(f.value), 0)) * 100), 6) AS max_pct,
 arg_max(f.obs_date, row(abs((l.value - f.value) / nullif(abs(f.value), 0)) * 100, f.obs_date)) AS max_at
 FROM {FIRST} f JOIN {LATEST} l ON f.series_id = l.series_id AND f.obs_date = l.obs_date GROUP BY f.series_id""",
    "i5_growth_in_vintage": f"""WITH f AS (SELECT * FROM {FIRST}), n AS (SELECT * FROM {LATEST}),
 p AS (SELECT f.series_id, f.obs_date, f.value, arg_max(o.value, o.vintage) AS p FROM f JOIN obs o ON o.series_id = f.series_id AND o.obs_date + 1 = f.obs_date AND o.vintage <= f.vintage AND o.value IS NOT NULL GROUP BY ALL)
 SELECT p.series_id, p.obs_date, round(p.value / nullif(p.p, 0) - 1, 6) AS first_growth, round(n.value / nullif(b.value, 0) - 1, 6) AS latest_growth
 FROM p JOIN n ON n.series_id = p.series_id AND n.obs_date = p.obs_date JOIN n b ON b.series_id = p.series_id AND b.obs_date + 1 = p.obs_date""",
    "i6_current_vintage": """SELECT series_id, obs_date, vintage, value FROM (SELECT *, max(vintage) OVER (PARTITION BY series_id) AS newest FROM obs)
 WHERE split_part(series_id, ':', 2) <> 'purchase' OR vintage = newest""",
    "i7_release_points": f"""SELECT l.series_id, l.obs_date, l.value, CAST(CASE WHEN f - l.obs_date > 1 THEN l.obs_date + 2 ELSE f END AS DATE) AS released, f - l.obs_date > 1 AS estimated
 FROM {LATEST} l JOIN (SELECT series_id, obs_date, min(available_date) AS f FROM obs GROUP BY ALL) s ON l.series_id = s.series_id AND l.obs_date = s.obs_date""",
    "i8_series_window": f"""WITH pts AS (SELECT l.series_id, l.value, CAST(CASE WHEN f - l.obs_date > 1 THEN l.obs_date + 2 ELSE f END AS DATE) AS released
 FROM {LATEST} l JOIN (SELECT series_id, obs_date, min(available_date) AS f FROM obs GROUP BY ALL) s ON l.series_id = s.series_id AND l.obs_date = s.obs_date),
 o AS (SELECT series_id, DATE '2024-01-10' AS on_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY released DESC, value DESC) AS n FROM pts WHERE released <= DATE '2024-01-10') WHERE n = 1),
 i AS (SELECT series_id, released AS on_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id, released ORDER BY value DESC) AS n FROM pts WHERE released > DATE '2024-01-10' AND released <= DATE '2024-01-20') WHERE n = 1),
 c AS (SELECT series_id, DATE '2024-01-20' AS on_date, value FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY released DESC, value DESC) AS n FROM pts WHERE released <= DATE '2024-01-20') WHERE n = 1 AND released < DATE '2024-01-20')
 SELECT series_id, on_date, value, round(value / nullif(first_value(value) OVER (PARTITION BY series_id ORDER BY on_date), 0) * 100, 6) AS "index" FROM (SELECT * FROM o UNION SELECT * FROM i UNION SELECT * FROM c)""",
    "i9_dedup_lineage": "SELECT series_id, obs_date, value, units, vintage, min(run_id) AS run_id FROM obs_raw GROUP BY ALL",
    "i10_landing_conflicts": """SELECT series_id, obs_date, vintage, run_id, count(DISTINCT row(value, units)) AS value_sets FROM obs_raw GROUP BY ALL HAVING count(DISTINCT row(value, units)) > 1""",
    "i11_merge_newest": f"SELECT * FROM {MERGED}",
    "i12_merge_into_base": f"SELECT * FROM {MERGED}",
    "i14_merge_partitions": f"SELECT * FROM {MERGED} WHERE quarter IN ('1995Q1', '1995Q2')",
    "i15_replace_documents": """WITH b AS (SELECT * FROM landings WHERE run_id = 'r1'), n AS (SELECT * FROM landings WHERE run_id = 'r2' AND cik % 3 = 0),
 ch AS (SELECT DISTINCT cik FROM n)
 SELECT id, cik, form, val, quarter, run_id FROM b WHERE cik NOT IN (SELECT cik FROM ch)
 UNION ALL SELECT n.id, n.cik, n.form, n.val, n.quarter, CASE WHEN b.id IS NULL THEN n.run_id ELSE b.run_id END FROM n
 LEFT JOIN b ON n.id = b.id AND n.cik = b.cik AND n.form = b.form AND n.val = b.val AND n.quarter = b.quarter""",
    "i17_collapse_conflict": """SELECT series_id, obs_date, vintage, CASE WHEN count(DISTINCT units) <= 1 THEN max(units) END AS units, count(DISTINCT units) > 1 AS units_conflict, count(*) AS copies FROM obs_raw GROUP BY series_id, obs_date, vintage""",
    "i18_repeated_keys": "SELECT series_id, obs_date, vintage, count(*) AS n FROM obs_raw GROUP BY ALL HAVING count(*) > 1",
    "i19_changed_entities": """SELECT DISTINCT c.cik FROM landings c LEFT JOIN (SELECT id, max(run_id) AS run_id FROM landings WHERE run_id IN ('r1', 'r2') GROUP BY id) n ON n.id = c.id
 LEFT JOIN landings p ON p.id = n.id AND p.run_id = n.run_id WHERE c.run_id = 'r3' AND (p.id IS NULL OR row(c.form, c.val, c.quarter) IS DISTINCT FROM row(p.form, p.val, p.quarter))""",
    "i20_change_set": """SELECT cik FROM landings WHERE run_id = 'r3' AND cik % 5 = 0 UNION SELECT cik FROM landings WHERE run_id = 'r1'""",
    "i21_classify_pulls": """WITH n AS (SELECT form, id, CASE WHEN form = 'P' THEN val * 2 ELSE val END AS val FROM landings WHERE run_id = 'r2'), s AS (SELECT form, id, val FROM landings WHERE run_id = 'r1' AND form <> 'O'),
 r AS (SELECT n.form, count(n.val / s.val) AS overlap, min(n.val / s.val) AS lo, max(n.val / s.val) AS hi, min(n.id) < (SELECT min(id) FROM s t WHERE t.form = n.form) AS ext FROM n LEFT JOIN s ON n.form = s.form AND n.id = s.id GROUP BY n.form)
 SELECT form, overlap, CASE WHEN form NOT IN (SELECT form FROM s) THEN 'bootstrap' WHEN overlap = 0 THEN 'no_overlap' WHEN abs(lo - 1) <= 1e-5 AND abs(hi - 1) <= 1e-5 THEN 'incremental'
 WHEN hi - lo <= 1e-5 THEN 'rebase' ELSE 'correction' END AS kind, form = 'P' AND overlap > 0 AND hi - lo <= 1e-5 AS split_flag, coalesce(ext, FALSE) AS window_extended FROM r""",
    "i22_stored_basis": """WITH x AS (SELECT *, run_id = 'r1' OR (run_id = 'r2' AND cik % 2 = 0) AS is_full FROM landings),
 y AS (SELECT *, max(CASE WHEN is_full THEN run_id END) OVER (PARTITION BY cik) AS since FROM x), z AS (SELECT *, min(CASE WHEN run_id = since THEN id END) OVER (PARTITION BY cik) AS full_from FROM y)
 SELECT cik, id, run_id, val, full_from FROM (SELECT *, row_number() OVER (PARTITION BY cik, id ORDER BY run_id DESC) AS n FROM z WHERE run_id >= since) WHERE n = 1""",
    "i24_edition_difference": """SELECT form, CAST(coalesce(sum(CASE WHEN run_id = 'r2' THEN CAST(val AS DECIMAL(18,2)) END), 0) - coalesce(sum(CASE WHEN run_id = 'r1' THEN CAST(val AS DECIMAL(18,2)) END), 0) AS DECIMAL(28,2)) AS difference FROM landings WHERE id % 13 <> 0 GROUP BY form""",
}
ORACLES = {k: with_fixtures(v) for k, v in ORACLES.items()}
