"""Window operators: picks, neighbours, cumulative factors, weighted positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.finance import ratio
from palimpsest.operators.ranges import running


def top_row(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_n = 1").drop("_n")


def at_max(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """Rows at their group's maximum, ties kept."""
    return df.withColumn("_m", F.max(col).over(Window.partitionBy(*by))).filter(F.col(col) == F.col("_m")).drop("_m")


def neighbours(df: DataFrame, by: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """Each row with the previous and next values of `cols`."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.select("*", *(F.lag(c).over(w).alias(f"prev_{c}") for c in cols), *(F.lead(c).over(w).alias(f"next_{c}") for c in cols))


def product(factor: Column, over=None) -> Column:
    """Product of a column over a group or a window, from sums of logarithms beside counts of zeros and of signs; 1 over no rows, null if any factor is null."""
    of = (lambda c: c.over(over)) if over is not None else (lambda c: c)
    nulls, zeros, minus = (F.coalesce(of(F.count_if(c)), F.lit(0)) for c in (factor.isNull(), factor == 0, factor < 0))
    size = F.exp(F.coalesce(of(F.sum(F.when(factor != 0, F.log(F.abs(factor))))), F.lit(0.0)))
    return F.when(nulls > 0, F.lit(None)).when(zeros > 0, F.lit(0.0)).otherwise(F.when(minus % 2 == 1, -size).otherwise(size))


def cum_factor_after(df: DataFrame, by: list[str], order: str, factor: str) -> DataFrame:
    """Product of the factors on later rows, 1 after the last; null if any of them is null, 0 if any is 0."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn("factor_after", product(F.col(factor), w))


def rank_in_group(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """percent_rank, number and median of a value among its peers."""
    w = Window.partitionBy(*group)
    return df.select("*", F.percent_rank().over(w.orderBy(value)).alias("pct_rank"), F.count(value).over(w).alias("n_peers"), F.median(value).over(w).alias("peer_median"))


def weighted_position(df: DataFrame, by: list[str], order: list[str], weight: str) -> DataFrame:
    """`position`: share of the group's weight at or before a row, as a double (a quotient of decimals keeps six digits). A group's rows are spread over ranges of the order."""
    rows = running(df, by, order, {"running": weight})
    return rows.withColumn("position", ratio(F.col("running"), F.col("running_total"))).drop("running_total")


def weighted_percentiles(df: DataFrame, by: list[str], value: str, tie: list[str], weight: str, probs: list[float]) -> DataFrame:
    """Smallest value whose cumulative share of the weight reaches each probability."""
    pos = weighted_position(df, by, [value, *tie], weight)
    return pos.groupBy(*by).agg(*(F.min(F.when(F.col("position") >= p, F.col(value))).alias(f"p{round(100 * p)}") for p in probs))


def weight_groups(df: DataFrame, by: list[str], order: list[str], weight: str, n: int) -> DataFrame:
    """Equal-weight groups 0 .. n - 1 by running weight before the row. Shares are doubles, as a quotient of decimals keeps six digits and would lift a row just below a bound over it."""
    rows = running(df, by, order, {"_run": weight})
    below = (F.col("_run") - F.col(weight)).cast("double")
    group = F.least(F.floor(ratio(F.lit(n) * below, F.col("_run_total"))), F.lit(n - 1)).cast("int")
    return rows.withColumn("weight_group", group).drop("_run", "_run_total")


def seeded_sample(df: DataFrame, by: list[str], keys: list[str], seed: str, n: int, latest: str) -> DataFrame:
    """n rows of each group in the order of a seeded hash, and always its latest row."""
    text = F.concat_ws("|", F.lit(seed), *(F.col(k).cast("string") for k in [*by, *keys]))
    drawn = F.row_number().over(Window.partitionBy(*by).orderBy(F.md5(text), *keys))
    newest = F.max(latest).over(Window.partitionBy(*by))
    return df.withColumn("_n", drawn).withColumn("_newest", newest).filter((F.col("_n") <= n) | (F.col(latest) == F.col("_newest"))).drop("_n", "_newest")


def window_agg_if(df: DataFrame, by: list[str], agg: str, col: str, cond: str, name: str) -> DataFrame:
    """Each row with an aggregate of its group's rows that meet a condition."""
    return df.withColumn(name, getattr(F, agg)(F.when(F.expr(cond), F.col(col))).over(Window.partitionBy(*by)))


def first_in(df: DataFrame, by: list[str], order: list[str], col: str, name: str) -> DataFrame:
    """Each row with its group's first value in an order."""
    return df.withColumn(name, F.first(col).over(Window.partitionBy(*by).orderBy(*order)))


def weight_slices(df: DataFrame, by: list[str], order: list[str], weight: str, n: int) -> DataFrame:
    """Equal slices 0 .. n - 1 by the share of the group's weight before a row."""
    return weight_groups(df, by, order, weight, n).withColumnRenamed("weight_group", "slice")


def running_total(df: DataFrame, by: list[str], order: list[str], col: str, name: str) -> DataFrame:
    """Sum of a column up to each row."""
    return running(df, by, order, {name: col}).drop(f"{name}_total")


def increments(df: DataFrame, by: list[str], order: str, total: str) -> DataFrame:
    """A cumulative counter as increments; it starts anew in each group."""
    return df.withColumn("increment", F.col(total) - F.coalesce(F.lag(total).over(Window.partitionBy(*by).orderBy(order)), F.lit(0)))


def rollup_levels(df: DataFrame, levels: list[str], value: str, name: str) -> DataFrame:
    """Totals at each level of a hierarchy and overall, with the member of the largest value there."""
    sets = [levels[: i + 1] for i in range(len(levels))] + [[]]
    member = F.max(F.struct(value, name))[name]
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in levels)).agg(F.sum(value).alias("total"), F.count("*").alias("members"), member.alias("top_member"))
