"""Aggregations, top-k and set operations as functions over the caller's own tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators import ranges


def _key(value: str, by: list[str], where: str | None) -> Column:
    known = F.col(value).isNotNull() if where is None else F.col(value).isNotNull() & F.expr(where)
    return F.when(known, F.struct(*by))


def arg_max(value: str, by: list[str], where: str | None = None) -> Column:
    """The value at the largest composite of `by`, among rows where it is known and `where` holds."""
    return F.max_by(value, _key(value, by, where))


def arg_min(value: str, by: list[str], where: str | None = None) -> Column:
    """As arg_max, at the smallest."""
    return F.min_by(value, _key(value, by, where))


def agg_bool(df: DataFrame, by: list[str], any_of: dict[str, str], all_of: dict[str, str], counts: dict[str, str]) -> DataFrame:
    """Per group whether any or all rows meet named conditions, its rows (`n`) and the known values of columns."""
    return df.groupBy(*by).agg(
        *(F.bool_or(F.expr(c)).alias(n) for n, c in any_of.items()), *(F.bool_and(F.expr(c)).alias(n) for n, c in all_of.items()), F.count("*").alias("n"), *(F.count(c).alias(n) for n, c in counts.items())
    )


def agg_where(df: DataFrame, by: list[str], **named: tuple[str, str, str]) -> DataFrame:
    """Aggregates over the rows that meet a condition each: name=(function, column, condition). count takes any column."""
    return df.groupBy(*by).agg(*(getattr(F, f)(F.when(F.expr(cond), F.lit(1) if col == "*" else F.col(col))).alias(n) for n, (f, col, cond) in named.items()))


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows are there beyond one for each key; null is a key like any other. Counts are combined before their shuffle."""
    return df.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))


def approx_distinct(df: DataFrame, by: list[str], cols: list[str], rsd: float = 0.02) -> DataFrame:
    """Per group an estimate of each column's distinct values (`approx_<column>`), of the given relative standard deviation."""
    return df.groupBy(*by).agg(*(F.approx_count_distinct(c, rsd).alias(f"approx_{c}") for c in cols))


def quantiles(df: DataFrame, col: str, probs: dict[str, float], by: list[str]) -> DataFrame:
    """Continuous quantiles by name, exact. Values are placed over ranges, so a group of any size needs no more memory than its ranges' tasks."""
    return ranges.quantiles(df, by, col, probs)


def mode_of(df: DataFrame, col: str, by: list[str], name: str) -> DataFrame:
    """The most frequent value of each group, the smallest of equally frequent ones."""
    return df.groupBy(*by, col).agg(F.count("*").alias("_n")).groupBy(*by).agg(F.min(F.struct((-F.col("_n")).alias("_n"), col))[col].alias(name))


def series_fit(a: DataFrame, b: DataFrame, by: list[str], at: str, value: str, lag: int = 0) -> DataFrame:
    """Correlation (`fit`) and number (`n`) of the pairs of two daily series, the second taken `lag` days earlier."""
    later = b.select(*by, F.date_add(at, lag).alias(at), F.col(value).alias("_b"))
    return a.join(later, [*by, at]).groupBy(*by).agg(F.corr(value, "_b").alias("fit"), F.count("*").alias("n"))


def group_having(df: DataFrame, by: list[str], aggs: dict[str, Column], having: str) -> DataFrame:
    return df.groupBy(*by).agg(*(c.alias(n) for n, c in aggs.items())).filter(having)


def ordered_list(df: DataFrame, by: list[str], col: str, name: str, sep: str = ",") -> DataFrame:
    """Distinct values of each group in order, joined."""
    return df.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set(col)), sep).alias(name))


def weighted_share(df: DataFrame, weight: str, flags: dict[str, str], by: list[str]) -> DataFrame:
    """Share of a group's weight on the rows that meet each named condition; null where the weights add up to nothing."""
    total = F.sum(weight).cast("double")
    return df.groupBy(*by).agg(*(F.try_divide(F.sum(F.when(F.expr(c), F.col(weight)).otherwise(0)).cast("double"), total).alias(n) for n, c in flags.items()))


def histogram(df: DataFrame, expr: str, bins: float) -> DataFrame:
    """Number of rows of each bin of an expression, `bins` to a unit; rows without a value have none."""
    return df.select(F.floor(F.expr(expr) * bins).alias("bin")).filter("bin IS NOT NULL").groupBy("bin").agg(F.count("*").alias("n"))


def classed(expr: Column, edges: list[tuple[float, str]], last: str) -> Column:
    """Label of the first edge that a value lies below, else the last."""
    out = None
    for edge, label in edges:
        out = F.when(expr < edge, label) if out is None else out.when(expr < edge, label)
    return out.otherwise(last)


def bucketize(df: DataFrame, col: str, edges: list[tuple[float, str]], last: str, name: str) -> DataFrame:
    """Rows of each class."""
    return df.groupBy(classed(F.col(col), edges, last).alias(name)).agg(F.count("*").alias("n"))


def cagr(df: DataFrame, by: list[str], year: str, value: str, first: int, last: int) -> DataFrame:
    """Mean growth a year between two years, of the groups that have both."""
    at = {y: F.max(F.when(F.col(year) == y, F.col(value))) for y in (first, last)}
    both = df.filter(F.col(year).isin(first, last)).groupBy(*by).agg(at[first].alias("_a"), at[last].alias("_b"), F.count_distinct(year).alias("_n")).filter("_n = 2")
    return both.select(*by, (F.exp(F.log(F.col("_b").cast("double") / F.col("_a").cast("double")) / (last - first)) - 1).alias("cagr"))


def resample(df: DataFrame, by: list[str], at: str, value: str, freq: str = "quarter", of: str = "month", need: int = 3, how: str = "sum") -> DataFrame:
    """Values rolled up from periods `of` to periods `freq` by sum, mean or last; a period with fewer than `need` parts is dropped."""
    inner = F.sum(value) if how == "sum" else F.avg(value) if how == "mean" else F.max_by(value, at)
    parts = df.groupBy(*by, F.date_trunc(of, at).cast("date").alias("_part")).agg(inner.alias("_v"))
    outer = F.sum("_v") if how == "sum" else F.avg("_v") if how == "mean" else F.max_by("_v", "_part")
    return parts.groupBy(*by, F.date_trunc(freq, "_part").cast("date").alias("period")).agg(F.count("*").alias("parts"), outer.alias("value")).filter(F.col("parts") >= need)


def resample_last_in(df: DataFrame, by: list[str], at: str, value: str, last_month: int = 12) -> DataFrame:
    """Years summed up once their last month is in, other months may be missing."""
    years = df.groupBy(*by, F.year(at).alias("y")).agg(F.sum(value).alias("total"), F.max(F.month(at)).alias("_last"))
    return years.filter(F.col("_last") == last_month).drop("_last")


def profile(df: DataFrame, cols: list[str], top_n: int = 3) -> DataFrame:
    """Per column: filled, n_distinct, least and greatest value and the top_n most frequent ones with their counts, all as text. One row for each distinct value passes one shuffle."""
    ends = df.agg(*(f(c).cast("string").alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))))
    ends = ends.select(F.inline(F.array(*(F.struct(F.lit(c).alias("col"), F.col(f"lo_{c}").alias("lo"), F.col(f"hi_{c}").alias("hi")) for c in cols))))
    values = df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("v")) for c in cols)))).filter("v IS NOT NULL").groupBy("col", "v").agg(F.count("*").alias("n"))
    counts = values.groupBy("col").agg(F.sum("n").alias("filled"), F.count("*").alias("n_distinct"))
    ranked = values.withColumn("rk", F.row_number().over(Window.partitionBy("col").orderBy(F.desc("n"), "v"))).filter(F.col("rk") <= top_n)
    said = F.transform(F.array_sort(F.collect_list(F.struct("rk", "v", "n"))), lambda x: F.concat(x["v"], F.lit(" ("), x["n"].cast("string"), F.lit(")")))
    return ends.join(counts, "col", "left").join(ranked.groupBy("col").agg(F.array_join(said, ", ").alias("top")), "col", "left").select("col", F.coalesce("filled", F.lit(0)).alias("filled"), F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "lo", "hi", "top")


def pivot_wide(df: DataFrame, keys: list[str], name: str, value: str, names: dict[str, str]) -> DataFrame:
    """One column for each of the given names of a long table, the largest value if there are several."""
    return df.groupBy(*keys).agg(*(F.max(F.when(F.col(name) == n, F.col(value))).alias(c) for n, c in names.items()))


def unpivot_years(df: DataFrame, ids: list[str], pattern: str) -> DataFrame:
    """Columns whose names match, as rows: year (the digits of the name), raw text and its value as a double, null if it is none. Empty cells are left out."""
    cols = [c for c in df.columns if re.fullmatch(pattern, c)]
    long = df.select(*ids, *(F.col(c).cast("string").alias(c) for c in cols)).unpivot(ids, cols, "_name", "raw").filter("raw IS NOT NULL")
    return long.select(*ids, F.regexp_extract("_name", "([0-9]+)", 1).cast("int").alias("year"), "raw", F.col("raw").try_cast("double").alias("value"))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_share(df: DataFrame, by: list[str], value: str, tie: list[str], ks: list[int]) -> DataFrame:
    """Share of each group's total that its k largest rows hold. Only they are ranked: each task first cuts its rows to the largest k."""
    ranked = df.withColumn("_rk", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(value), *tie))).filter(F.col("_rk") <= max(ks))
    tops = ranked.groupBy(*by).agg(*(F.sum(F.when(F.col("_rk") <= k, F.col(value))).alias(f"_top{k}") for k in ks))
    totals = df.groupBy(*by).agg(F.sum(value).alias("_total"))
    return totals.join(tops, by).select(*by, *(F.try_divide(F.col(f"_top{k}").cast("double"), F.col("_total").cast("double")).alias(f"top{k}") for k in ks))


def top_n_other(df: DataFrame, cat: str, n: int, other: Column, weight: Column | None = None) -> DataFrame:
    """Rows (or weight) of the n heaviest categories; the rest, nulls among them, together as `other`."""
    weight = F.count("*") if weight is None else F.sum(weight)
    sums = df.groupBy(cat).agg(weight.alias("n"))
    ranked = sums.filter(F.col(cat).isNotNull()).orderBy(F.desc("n"), cat).limit(n).select(cat, F.lit(True).alias("_top"))
    return sums.join(F.broadcast(ranked), cat, "left").groupBy(F.when(F.col("_top"), F.col(cat)).otherwise(other).alias(cat)).agg(F.sum("n").alias("n"))


def head_tail(df: DataFrame, order: list[str], value: str, h: int, t: int) -> DataFrame:
    """The h largest and t smallest rows by a value, ties in the order of `order`; each task hands on its best only."""
    return df.orderBy(F.desc(value), *order).limit(h).union(df.orderBy(value, *order).limit(t)).distinct()


def examples(df: DataFrame, cond: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of a rule, in an order that says which."""
    return df.filter(cond).orderBy(*order).limit(k)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """All rows of tables whose columns are named alike, in whatever order; columns that one lacks are null there."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def key_union(*keys: DataFrame) -> DataFrame:
    out = keys[0]
    for df in keys[1:]:
        out = out.union(df)
    return out.distinct()


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one table has more often than the other, with their side."""
    return a.exceptAll(b).select(F.lit("only_a").alias("side"), "*").unionByName(b.exceptAll(a).select(F.lit("only_b").alias("side"), "*"))


def unknown_keys(df: DataFrame, col: str, known: DataFrame) -> DataFrame:
    """Distinct values of a column that a list of known ones lacks; null is unknown too."""
    return df.select(col).distinct().join(known.select(F.col(col).alias("_known")), F.col(col) == F.col("_known"), "left_anti")


def require_known(df: DataFrame, col: str, known: DataFrame) -> DataFrame:
    """df, if its column holds known values only; else an error that names some."""
    bad = [r[0] for r in unknown_keys(df, col, known).limit(10).collect()]
    if bad:
        raise ValueError(f"unknown {col}: {bad}")
    return df
