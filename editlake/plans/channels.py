"""Registered queries of the sample-tuple algebra: suppliers and nations stand for sample sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from editlake.operators import channels as c

from .bindings import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query under the function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


SHEET = """sheet AS (SELECT 's' || (s_suppkey % 40) AS sample, s_suppkey AS run, 'f' || s_suppkey AS fastq_1, CASE WHEN s_suppkey % 3 = 0 THEN 'r' || s_suppkey END AS fastq_2,
  s_nationkey, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'REF' || (s_nationkey % 3) END AS reference FROM supplier)"""


def sheet(spark, sf_dir):
    k = F.col("s_suppkey")
    text = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    return table(spark, sf_dir, "supplier").select(
        text("s", k % 40).alias("sample"), k.alias("run"), text("f", k).alias("fastq_1"),
        F.when(k % 3 == 0, text("r", k)).alias("fastq_2"), "s_nationkey",
        F.when(k % 4 != 0, text("REF", F.col("s_nationkey") % 3)).alias("reference"),
    )


@query(f"WITH {SHEET} SELECT sample, array_to_string(list(run ORDER BY run), ',') AS runs, array_to_string(list(fastq_1 ORDER BY run), ',') AS files FROM sheet GROUP BY sample")
def group_tuple(spark, sf_dir):
    rows = c.group_tuple(sheet(spark, sf_dir).select("sample", "run", "fastq_1"), ["sample"], "run")
    return rows.select("sample", F.array_join(F.col("run").cast("array<string>"), ",").alias("runs"), F.array_join("fastq_1", ",").alias("files"))


@query(f"WITH {SHEET} SELECT run, CASE WHEN fastq_2 IS NOT NULL THEN 'paired' ELSE 'single' END AS route FROM sheet WHERE fastq_2 IS NOT NULL OR run % 2 = 0")
def branch_route(spark, sf_dir):
    routes = {"paired": F.col("fastq_2").isNotNull(), "single": F.col("run") % 2 == 0}
    return c.branch(sheet(spark, sf_dir), routes).select("run", "route")


@query(f"WITH {SHEET} SELECT sample, fastq_1 AS f FROM sheet UNION ALL SELECT sample, fastq_2 FROM sheet WHERE fastq_2 IS NOT NULL")
def mix(spark, sf_dir):
    s = sheet(spark, sf_dir)
    return c.mix(s.select("sample", F.col("fastq_1").alias("f")), s.filter("fastq_2 is not null").select("sample", F.col("fastq_2").alias("f")))


@query(f"WITH {SHEET} SELECT sample, 0 AS part FROM sheet WHERE run % 2 = 0 UNION ALL SELECT sample, 1 FROM sheet WHERE run % 2 = 1")
def concat_parts(spark, sf_dir):
    s = sheet(spark, sf_dir).select("sample", "run")
    return c.concat(s.filter("run % 2 = 0"), s.filter("run % 2 = 1")).select("sample", "part")


@query(f"WITH {SHEET} SELECT run, n_name FROM sheet LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) n ON n_nationkey = s_nationkey")
def join_remainder(spark, sf_dir):
    n = table(spark, sf_dir, "nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return c.unique_join(sheet(spark, sf_dir), n, ["s_nationkey"], True).select("run", "n_name")


@query("""SELECT coalesce(a.k, b.k) AS k, a.n AS suppliers, b.n AS customers FROM (SELECT s_nationkey * 7 + s_suppkey % 5 AS k, count(*) AS n FROM supplier GROUP BY 1) a
FULL JOIN (SELECT c_nationkey * 7 + c_custkey % 9 AS k, count(*) AS n FROM customer GROUP BY 1) b ON a.k = b.k""")
def full_outer(spark, sf_dir):
    """Keys of two kinds that overlap in part."""
    key = lambda nation, k, n: (F.col(nation) * 7 + F.col(k) % n).alias("k")
    a = table(spark, sf_dir, "supplier").groupBy(key("s_nationkey", "s_suppkey", 5)).agg(F.count(F.lit(1)).alias("suppliers"))
    b = table(spark, sf_dir, "customer").groupBy(key("c_nationkey", "c_custkey", 9)).agg(F.count(F.lit(1)).alias("customers"))
    return c.full_join(a, b, ["k"])


@query(f"WITH {SHEET} SELECT run, v.reference AS control, treatment FROM sheet CROSS JOIN (VALUES ('AF,AO', 'RF,RO'), ('AF', 'NO')) v(reference, treatment)")
def contrast_cross(spark, sf_dir):
    contrasts = spark.createDataFrame([("AF,AO", "RF,RO"), ("AF", "NO")], "control string, treatment string")
    return c.combine(sheet(spark, sf_dir).select("run"), contrasts)


@query(f"WITH {SHEET} SELECT sample, run, fastq_1 FROM sheet WHERE sample IN (SELECT sample FROM sheet GROUP BY sample HAVING count(*) = 3)")
def transpose(spark, sf_dir):
    rows = c.group_tuple(sheet(spark, sf_dir).select("sample", "run", "fastq_1"), ["sample"], "run", 3)
    return c.transpose(rows, ["run", "fastq_1"])


@query(f"""WITH {SHEET}, x AS (SELECT sample, count(DISTINCT fastq_2 IS NULL) AS a, count(DISTINCT coalesce(reference, 'null')) AS b FROM sheet GROUP BY sample)
SELECT sample, 'ended' AS "column", a AS n FROM x WHERE a > 1 UNION ALL SELECT sample, 'reference', b FROM x WHERE b > 1""")
def consistency_check(spark, sf_dir):
    rows = sheet(spark, sf_dir).withColumn("ended", F.col("fastq_2").isNull())
    return c.inconsistent(rows, "sample", ["ended", "reference"])


@query(f"WITH {SHEET} SELECT run, coalesce('GIVEN', reference) AS reference, fastq_2 FROM sheet")
def override(spark, sf_dir):
    return c.override(sheet(spark, sf_dir), {"reference": "GIVEN", "fastq_2": None}).select("run", "reference", "fastq_2")


@query(f"WITH {SHEET} SELECT sample, arg_min(fastq_1, run) AS first, arg_max(fastq_1, run) AS last FROM sheet GROUP BY sample")
def first_last(spark, sf_dir):
    return c.first_last(sheet(spark, sf_dir), ["sample"], "run", "fastq_1")


@query(f"WITH {SHEET} SELECT 'c' || s_nationkey AS cluster, count(*) AS size, CASE WHEN count(*) = 1 THEN 'single' ELSE 'cluster' END AS route FROM sheet GROUP BY s_nationkey HAVING count(*) >= 1")
def cluster_routes(spark, sf_dir):
    return c.cluster_routes(sheet(spark, sf_dir).select(F.concat(F.lit("c"), F.col("s_nationkey").cast("string")).alias("cluster")))


@query(f"WITH {SHEET} SELECT CASE WHEN fastq_2 IS NULL THEN 'single' ELSE 'paired' END AS endedness, string_agg(sample, ',' ORDER BY sample) AS label FROM sheet GROUP BY fastq_2 IS NULL")
def condition_label(spark, sf_dir):
    return c.condition_label(sheet(spark, sf_dir).withColumn("single_end", F.col("fastq_2").isNull()))


@query(f"WITH {SHEET}, a AS (SELECT run, row_number() OVER (ORDER BY run) AS k FROM sheet), n AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) AS k FROM nation) SELECT run, n_name FROM a JOIN n USING (k)")
def merge_zip(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.merge(sheet(spark, sf_dir).select("run"), n, "run", "n_nationkey").select("run", "n_name")


@query(f"WITH {SHEET} SELECT run, 'reads' AS output, fastq_1 AS value FROM sheet UNION ALL SELECT run, 'reference', reference FROM sheet")
def multi_map(spark, sf_dir):
    parts = c.multi_map(sheet(spark, sf_dir), {"reads": {"run": F.col("run"), "value": F.col("fastq_1")}, "reference": {"run": F.col("run"), "value": F.col("reference")}})
    return c.mix(*[rows.withColumn("output", F.lit(name)) for name, rows in parts.items()])


@query(f"WITH {SHEET} SELECT count(*) AS seen, count(fastq_2) AS paired FROM sheet")
def tap(spark, sf_dir):
    """The rows on their way, and what was seen of them."""
    rows, seen = c.tap(sheet(spark, sf_dir), F.count(F.lit(1)).alias("seen"), F.count("fastq_2").alias("paired"))
    assert rows.columns == sheet(spark, sf_dir).columns
    return seen


@query(f"WITH {SHEET} SELECT sample, unnest([fastq_1, fastq_2]) AS f FROM sheet")
def flatten(spark, sf_dir):
    return c.flatten(sheet(spark, sf_dir).select("sample", F.array("fastq_1", "fastq_2").alias("f")), "f")


@query(f"WITH {SHEET} SELECT DISTINCT sample, s_nationkey FROM sheet")
def unique(spark, sf_dir):
    return c.unique(sheet(spark, sf_dir).select("sample", "s_nationkey"))


@query(f"WITH {SHEET} SELECT sample, min(run) AS run FROM sheet GROUP BY sample")
def unique_by(spark, sf_dir):
    return c.unique(sheet(spark, sf_dir).select("sample", "run"), ["sample"], "run")


@query("SELECT * FROM (VALUES ('hg38', 1), ('mm10', 2)) v(name, place)")
def of_values(spark, sf_dir):
    return c.mix(c.of(spark, [("hg38", 1), ("mm10", 2)], "name string, place int"), c.of(spark, [], "name string, place int"))


@query(f"WITH {SHEET} SELECT sample, count(*) AS n, count(fastq_2) AS paired, count(*) = 3 AND count(fastq_2) > 0 AS kept FROM sheet GROUP BY sample")
def count_predicate(spark, sf_dir):
    rows = c.counted(sheet(spark, sf_dir), ["sample"], {"paired": F.col("fastq_2").isNotNull()})
    return rows.withColumn("kept", (F.col("n") == 3) & (F.col("paired") > 0))


@query(f"WITH {SHEET} SELECT string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples, count(DISTINCT sample) AS n FROM sheet")
def collect_list(spark, sf_dir):
    rows = c.collect_values(sheet(spark, sf_dir), "sample")
    return rows.select(F.array_join("sample", ",").alias("samples"), F.size("sample").cast("bigint").alias("n"))


@query(f"WITH {SHEET} SELECT sample, run, k, f FROM (SELECT sample, run, 2 * row_number() OVER w - 1 AS k, fastq_1 AS f FROM sheet WINDOW w AS (PARTITION BY sample ORDER BY run) UNION ALL SELECT sample, run, 2 * row_number() OVER w, fastq_2 FROM sheet WINDOW w AS (PARTITION BY sample ORDER BY run)) WHERE f IS NOT NULL")
def interleave_mates(spark, sf_dir):
    """Files of the runs of a sample, first mates at odd places and second ones at even places."""
    rows = c.interleave(sheet(spark, sf_dir), ["sample"], "run", ["fastq_1", "fastq_2"])
    return rows.select("sample", "run", F.col("k").cast("bigint").alias("k"), F.col("value").alias("f"))
