"""The algebra of sample tuples: routing, grouping, joining and checking rows keyed by sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def branch(df: DataFrame, routes: dict[str, Column]) -> DataFrame:
    """Adds route: the first rule that holds; rows that meet none are dropped."""
    route = None
    for name, rule in routes.items():
        route = F.when(rule, name) if route is None else route.when(rule, name)
    return df.withColumn("route", route).filter("route is not null")


def mix(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, repeats kept."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def concat(*parts: DataFrame) -> DataFrame:
    """Like :func:`mix`, with the part's number in ``part``."""
    return mix(*[p.withColumn("part", F.lit(k)) for k, p in enumerate(parts)])


def group_tuple(df: DataFrame, keys: list[str], order: str, size: int | None = None) -> DataFrame:
    """One row a key with lists of the other columns, in ``order``; with ``size`` only complete groups."""
    others = [c for c in df.columns if c not in keys]
    packed = F.array_sort(F.collect_list(F.struct(order, *[c for c in others if c != order])))
    rows = df.groupBy(*keys).agg(packed.alias("x"))
    if size is not None:
        rows = rows.filter(F.size("x") == size)
    return rows.select(*keys, *[F.col(f"x.{c}").alias(c) for c in others])


def transpose(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each place of the lists."""
    rest = [c for c in df.columns if c not in columns]
    rows = df.select(*rest, F.explode(F.arrays_zip(*columns)).alias("e"))
    return rows.select(*rest, *[F.col(f"e.{c}").alias(c) for c in columns])


def multi_map(df: DataFrame, outputs: dict[str, dict[str, Column]]) -> dict[str, DataFrame]:
    """Several tables of one: for each output the columns that it has."""
    return {name: df.select(*[x.alias(c) for c, x in columns.items()]) for name, columns in outputs.items()}


def tap(df: DataFrame, *aggregates: Column) -> tuple[DataFrame, DataFrame]:
    """The rows unchanged, and one row of aggregates over them."""
    return df, df.agg(*aggregates)


def flatten(df: DataFrame, column: str) -> DataFrame:
    """One row for each element of a list; empty and null lists give none."""
    return df.withColumn(column, F.explode(column))


def unique(df: DataFrame, keys: list[str] | None = None, order: str | None = None) -> DataFrame:
    """Different rows; with ``keys`` the first row of each by ``order`` (nulls last), ties by the other columns."""
    if keys is None:
        return df.distinct()
    others = [c for c in df.columns if c not in keys and c != order]
    first = F.min(F.struct(F.col(order).isNull().alias("_null"), order, *others)).alias("_first")
    rows = df.groupBy(*keys).agg(first)
    return rows.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def of(spark: SparkSession, values: list[tuple], schema: str) -> DataFrame:
    """A table of given values; no values give an empty one."""
    return spark.createDataFrame(values, schema)


def counted(df: DataFrame, keys: list[str], predicates: dict[str, Column]) -> DataFrame:
    """(keys, n, ...): rows of each key, and those of them that meet each predicate."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(p).alias(c) for c, p in predicates.items()])


def collect_values(df: DataFrame, column: str) -> DataFrame:
    """One row: the sorted list of a short column's different values (samples, references)."""
    return df.agg(F.array_sort(F.collect_set(column)).alias(column))


def interleave(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """(keys, order, k, value): the columns' values of a key's rows in turn, row by row; nulls keep their place but have no row."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1
    rows = df.withColumn("_at", at).select(*keys, order, "_at", F.posexplode(F.array(*columns)).alias("_k", "value"))
    rows = rows.filter("value is not null")
    return rows.select(*keys, order, (F.col("_at") * len(columns) + F.col("_k") + 1).alias("k"), "value")


def unique_join(left: DataFrame, right: DataFrame, keys: list[str], remainder: bool = False) -> DataFrame:
    """Join on keys that are unique on the right; unmatched left rows are kept with ``remainder``. A key that comes twice on the
    right makes the job fail."""
    rest = [c for c in right.columns if c not in keys]
    row = F.struct(*rest) if rest else F.lit(True)
    once = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(row).alias("_row"))
    once = once.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(F.lit("a key of the right side comes more than once")).cast("boolean")))
    once = once.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
    return left.join(once, keys, "left" if remainder else "inner")


def full_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of either side, nulls where the other has none."""
    return left.join(right, keys, "full_outer")


def combine(left: DataFrame, small: DataFrame) -> DataFrame:
    """Every pair of the rows of both sides. The product is what is asked for; Spark broadcasts a side whose size it knows to be
    small, and nothing is broadcast beyond that."""
    return left.crossJoin(small)


def merge(left: DataFrame, right: DataFrame, left_order: str, right_order: str) -> DataFrame:
    """Positional zip of two short tables in their orders."""
    at = lambda df, o: df.withColumn("place", F.row_number().over(Window.orderBy(o)))
    return at(left, left_order).join(at(right, right_order), "place").drop("place")


def inconsistent(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, column, n): groups in which a column has more than one value, null counted as one."""
    as_text = {c: F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns}
    rows = df.groupBy(key).agg(*[F.count_distinct(v).alias(c) for c, v in as_text.items()])
    rows = rows.unpivot([key], columns, "column", "n")
    return rows.filter("n > 1")


def override(df: DataFrame, values: dict[str, str | None]) -> DataFrame:
    """A given parameter beats the sheet's column."""
    return df.withColumns({c: F.coalesce(F.lit(v).cast("string"), F.col(c)) for c, v in values.items()})


def first_last(df: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """(key, first, last) of a column in the order of another."""
    return df.groupBy(*key).agg(F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))


def cluster_routes(members: DataFrame, least: int = 1) -> DataFrame:
    """(cluster, size, route): single for clusters of one, cluster for larger ones; those below ``least`` are dropped."""
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= least)
    return sizes.withColumn("route", F.when(F.col("size") == 1, "single").otherwise("cluster"))


def condition_label(sheet: DataFrame) -> DataFrame:
    """(endedness, label): the samples of either endedness, comma-joined in order."""
    rows = sheet.groupBy("single_end").agg(F.array_join(F.array_sort(F.collect_list("sample")), ",").alias("label"))
    return rows.withColumn("endedness", F.when(F.col("single_end"), "single").otherwise("paired")).select("endedness", "label")
