"""Bitemporal reads: what a series says now, what it said on a date, and how it was revised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_vintage(obs: DataFrame, keys: list[str], vintage: str = "vintage", value: str = "value") -> DataFrame:
    """Newest vintage of every key; a withdrawn (null) value wins the pick and is dropped only afterwards."""
    w = Window.partitionBy(*keys).orderBy(F.col(vintage).desc())
    return obs.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn").filter(F.col(value).isNotNull())


def as_of(obs: DataFrame, date: str | Column, keys: list[str], available: str = "available_date") -> DataFrame:
    """The series as known on a date: rows available by then, newest vintage each."""
    date = F.lit(date).cast("date") if isinstance(date, str) else date
    return latest_vintage(obs.filter(F.col(available) <= date), keys)


def first_print(obs: DataFrame) -> DataFrame:
    """First non-null value of each period, but not of periods that the series' earliest vintage already held."""
    floor = obs.groupBy("series_id").agg(F.min("vintage").alias("_floor"))
    first = obs.filter("value IS NOT NULL").groupBy("series_id", "obs_date").agg(F.min(F.struct("vintage", "value")).alias("_f"))
    return first.join(floor, "series_id").filter("_f.vintage > _floor").select("series_id", "obs_date", F.col("_f.vintage").alias("vintage"), F.col("_f.value").alias("value"))


def revision_stats(obs: DataFrame) -> DataFrame:
    """Per series: prints, periods revised, median and largest absolute change in percent between first print and latest value, and where.

    A period whose units differ between the two was rebased, which is no revision: such periods are counted apart.
    """
    latest = latest_vintage(obs, ["series_id", "obs_date"]).select("series_id", "obs_date", F.col("value").alias("_now"), F.col("vintage").alias("_v"), F.col("units").alias("_u"))
    units = obs.select("series_id", "obs_date", "vintage", "units")
    met = first_print(obs).join(units, ["series_id", "obs_date", "vintage"]).join(latest, ["series_id", "obs_date"]).withColumn("same", F.col("units").eqNullSafe(F.col("_u")))
    met = met.withColumn("pct", F.when(F.col("same"), F.abs(F.try_divide(F.col("_now") - F.col("value"), F.abs("value"))) * 100))
    return met.groupBy("series_id").agg(
        F.count("*").alias("prints"), F.count_if(F.col("same") & (F.col("_v") > F.col("vintage"))).alias("revised"), F.count_if(~F.col("same")).alias("rebased"), F.round(F.median("pct"), 6).alias("median_pct"), F.round(F.max("pct"), 6).alias("max_pct"),
        F.max(F.struct("pct", "obs_date"))["obs_date"].alias("max_at"),
    )


def first_vs_latest_growth(obs: DataFrame, step: int = 1) -> DataFrame:
    """Growth of each first print over the period before as known in that vintage, beside today's growth."""
    f = first_print(obs)
    known = obs.filter("value IS NOT NULL").select(F.col("series_id").alias("_s"), F.date_add("obs_date", step).alias("_d"), F.col("vintage").alias("_v"), F.col("value").alias("_p"))
    prior = f.join(known, (F.col("series_id") == F.col("_s")) & (F.col("obs_date") == F.col("_d")) & (F.col("_v") <= F.col("vintage"))).groupBy("series_id", "obs_date", "value").agg(F.max(F.struct("_v", "_p"))["_p"].alias("_p"))
    now = latest_vintage(obs, ["series_id", "obs_date"]).select("series_id", "obs_date", F.col("value").alias("_now"))
    before = now.select("series_id", F.date_add("obs_date", step).alias("obs_date"), F.col("_now").alias("_then"))
    met = prior.join(now, ["series_id", "obs_date"]).join(before, ["series_id", "obs_date"])
    return met.select("series_id", "obs_date", F.round(F.try_divide(F.col("value"), F.col("_p")) - 1, 6).alias("first_growth"), F.round(F.try_divide(F.col("_now"), F.col("_then")) - 1, 6).alias("latest_growth"))


def current_vintage(obs: DataFrame, is_price: Column) -> DataFrame:
    """Price rows of their series' newest vintage only; all rows of other series."""
    newest = F.max("vintage").over(Window.partitionBy("series_id"))
    return obs.withColumn("_newest", newest).filter(~is_price | (F.col("vintage") == F.col("_newest"))).drop("_newest")


def release_points(obs: DataFrame, catalog: DataFrame, late_days: int = 90) -> DataFrame:
    """Each latest value at its first availability, or at period end plus its series' lag in the catalog where that lies more than late_days after the period."""
    seen = obs.groupBy("series_id", "obs_date").agg(F.min("available_date").alias("_first"))
    lags = catalog.select("series_id", F.col("expected_lag_days").cast("int").alias("_lag"))
    met = latest_vintage(obs, ["series_id", "obs_date"]).select("series_id", "obs_date", "value").join(seen, ["series_id", "obs_date"]).join(lags, "series_id", "left")
    late = F.datediff("_first", "obs_date") > late_days
    return met.select("series_id", "obs_date", "value", F.when(late & F.col("_lag").isNotNull(), F.date_add("obs_date", F.col("_lag"))).otherwise(F.col("_first")).alias("released"), late.alias("estimated"))


def series_window(points: DataFrame, start: str, end: str, key: str = "series_id", at: str = "released") -> DataFrame:
    """A step function between two dates: the value in force at the start, the points inside, and the last one carried to the end; `index` is 100 at the first."""
    a, b = F.lit(start).cast("date"), F.lit(end).cast("date")
    tie = points.columns
    w = Window.partitionBy(key).orderBy(F.col(at).desc(), *(F.col(c).desc() for c in tie))
    last = lambda d: d.withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    opening = last(points.filter(F.col(at) <= a)).select(key, a.alias("on_date"), "value")
    inside = points.filter((F.col(at) > a) & (F.col(at) <= b)).withColumn("_n", F.row_number().over(Window.partitionBy(key, at).orderBy(*(F.col(c).desc() for c in tie)))).filter("_n = 1")
    closing = last(points.filter(F.col(at) <= b)).filter(F.col(at) < b).select(key, b.alias("on_date"), "value")
    rows = opening.unionByName(inside.select(key, F.col(at).alias("on_date"), "value")).unionByName(closing).distinct()
    base = F.first("value").over(Window.partitionBy(key).orderBy("on_date"))
    return rows.withColumn("index", F.round(F.try_divide(F.col("value"), base) * 100, 6))
