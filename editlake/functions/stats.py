"""Statistics as Column expressions or window recipes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlake.scratch import materialize

# The rational approximation of the upper normal tail by Hart (1968) as given by West (2005).
TAIL_P = [
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
TAIL_Q = [
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]
TAIL_TURN = 7.0710678


def _horner(x: Column, coefficients: list[float]) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def normal_tail(x: Column) -> Column:
    """P(Z > x) for a standard normal Z."""
    a = F.abs(x)
    density = F.exp(-a * a / 2)
    near = density * _horner(a, TAIL_P) / _horner(a, TAIL_Q)
    fraction = a + 0.65
    for k in (4, 3, 2, 1):
        fraction = a + F.lit(float(k)) / fraction
    far = density / (fraction * 2.506628274631)
    tail = F.when(a < TAIL_TURN, near).otherwise(far)
    return F.when(x < 0, 1 - tail).otherwise(tail)


def normal_tail_sql(x: str) -> str:
    """The same as :func:`normal_tail` in SQL."""
    def horner(cs: list[float]) -> str:
        out = repr(cs[0])
        for c in cs[1:]:
            out = f"({out}*abs({x})+{c!r})"
        return out

    d = f"exp(-abs({x})*abs({x})/2)"
    f = f"(abs({x})+0.65)"
    for k in (4, 3, 2, 1):
        f = f"(abs({x})+{k}.0/{f})"
    tail = f"(CASE WHEN abs({x}) < {TAIL_TURN} THEN {d}*{horner(TAIL_P)}/{horner(TAIL_Q)} ELSE {d}/({f}*2.506628274631) END)"
    return f"(CASE WHEN {x} < 0 THEN 1-{tail} ELSE {tail} END)"


def bh_fdr(df: DataFrame, p: str, rank: str, fdr: str, by: list[str], tie: list[str]) -> DataFrame:
    """Adds ``rank`` by ascending ``p`` and the Benjamini-Hochberg ``fdr`` (not cut at 1) inside each ``by`` group.

    Ties in p go by ``tie``. The window is over genes or guides, never over reads.
    """
    order = Window.partitionBy(*by).orderBy(p, *tie)
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    df = df.withColumn(rank, F.row_number().over(order))
    raw = F.col(p) * n / F.col(rank)
    above = Window.partitionBy(*by).orderBy(rank).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(fdr, F.min(raw).over(above))


def global_rank(df: DataFrame, rank: str, order: list[str]) -> DataFrame:
    """Adds ``rank``, from 1, by ascending ``order`` over all rows: ranges of the order are ranked each by itself, so no task sees all rows.

    The ranges are written once, so that their limits are the same for counts and rows.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # a row a range
    sizes = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    here = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return rows.join(F.broadcast(sizes), "_range").withColumn(rank, F.col("_before") + here).drop("_range", "_before")


def quantiles(df: DataFrame, names: list[str], q: float) -> DataFrame:
    """One row: the exact ``q`` quantile of each of the columns ``names``, interpolated between neighbours as ``percentile`` does; nulls don't count.

    Values are ranked over ranges, so no task holds a whole column.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("x")) for c in names])).alias("v")).select("v.*")
    rows = global_rank(long.filter("x is not null"), "r", ["name", "x"])
    sizes = rows.groupBy("name").agg(F.min("r").alias("first"), ((F.count(F.lit(1)) - 1) * q).alias("place"))  # a row a name
    rows = rows.join(F.broadcast(sizes), "name").withColumn("k", F.col("r") - F.col("first"))
    low, high = F.floor("place"), F.ceil("place")
    ends = rows.filter((F.col("k") == low) | (F.col("k") == high)).groupBy("name", "place").agg(
        F.max(F.when(F.col("k") == low, F.col("x"))).alias("a"), F.max(F.when(F.col("k") == high, F.col("x"))).alias("b")
    )
    between = (high - F.col("place")) * F.col("a") + (F.col("place") - low) * F.col("b")
    value = F.when((low == high) | (F.col("a") == F.col("b")), F.col("a")).otherwise(between)
    return ends.agg(*[F.max(F.when(F.col("name") == c, value)).alias(c) for c in names])


def zscore(x: Column, by: list[str]) -> Column:
    """(x - mean) / population SD inside each group."""
    w = Window.partitionBy(*by)
    return (x - F.avg(x).over(w)) / F.stddev_pop(x).over(w)


def log_factorials(n: Column) -> Column:
    """Array of ln k! for k = 0..n."""
    return F.aggregate(
        F.sequence(F.lit(1), n),
        F.array(F.lit(0.0)),
        lambda acc, k: F.concat(acc, F.array(F.element_at(acc, -1) + F.ln(k.cast("double")))),
    )


def poisson_neg_log_tail(edges: Column, mean: Column) -> Column:
    """-ln P(X >= edges) for Poisson X in log space. 0 for edges <= 0.

    The ratio of neighbouring terms is mean / k, so each sum starts from one term and goes away from the mean, where
    terms fall: up from ``edges`` if that is above the mean, else down to 0, and the rest to 1 is the tail. Terms are
    summed until what is left of them is too small to change the sum.
    """
    # So many steps away a term is less than exp(-40) of the first.
    near = F.least(edges, F.floor(F.sqrt(mean * 80)) + 80).cast("int")
    far = (F.floor(F.sqrt(edges * 80.0)) + 80).cast("int")
    first = F.aggregate(F.sequence(F.lit(1), F.greatest(edges, F.lit(1))), F.lit(0.0), lambda a, k: a + F.ln(k.cast("double")))
    start = -mean + edges * F.ln(mean) - first
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))

    def total(n: Column, ratio) -> Column:
        step = lambda a, k: F.struct(
            (a["term"] * ratio(k.cast("double"))).alias("term"), (a["total"] + a["term"] * ratio(k.cast("double"))).alias("total")
        )
        return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), zero, step, lambda a: a["total"])

    upper = -(start + F.log1p(total(far, lambda k: mean / (edges + k))))
    lower = -F.log1p(-F.exp(start + F.ln(total(near, lambda k: (edges - k + 1) / mean))))
    value = F.when(mean > edges, lower).otherwise(upper)
    return F.when((edges <= 0) | (mean <= 0), F.lit(0.0)).otherwise(F.greatest(value, F.lit(0.0)))


def scott_bandwidth(n: Column, sd: Column) -> Column:
    """Scott's rule for one dimension."""
    return F.pow(n.cast("double"), F.lit(-0.2)) * sd


def fibonacci(n: int) -> list[float]:
    """The first ``n`` Fibonacci numbers 1, 1, 2, 3, ..."""
    out, a, b = [], 1.0, 1.0
    for _ in range(n):
        out.append(a)
        a, b = b, a + b
    return out


def fold_change_threshold(n: Column) -> Column:
    """The density below which fold changes are not trusted, from the number of non-essential genes."""
    return F.pow(F.lit(2.0), F.lit(-1.1535) * F.ln(n + F.lit(13.324)) + F.lit(0.7728))


LN2 = math.log(2)
