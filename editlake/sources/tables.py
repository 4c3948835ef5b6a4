"""Readers of sample sheets, count tables, libraries, contrasts, gene sets and networks; writers of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHEET = T.StructType([T.StructField(c, T.StringType()) for c in ("sample", "fastq_1", "fastq_2", "reference", "protospacer", "template", "condition")])
DNA = r"^[ACTGNactgn]+$"


def _must_be_empty(bad: DataFrame, what: str) -> None:
    found = bad.limit(3).collect()
    if found:
        raise ValueError(f"{what}: {[tuple(r) for r in found]}")


def read_samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """The sheet with its seven columns, null where the file lacks one, checked: sample and fastq_1 given, no blanks in
    sample, sequences of A, C, G, T and N."""
    raw = spark.read.csv(path, header=True)
    unknown = set(raw.columns) - set(SHEET.names)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    rows = raw.select([F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in SHEET.names])
    _must_be_empty(rows.filter("sample is null or fastq_1 is null"), "sample and fastq_1 are required")
    _must_be_empty(rows.filter(F.col("sample").rlike(r"\s")), "sample must not contain blanks")
    for c in ("reference", "protospacer", "template"):
        _must_be_empty(rows.filter(~F.col(c).rlike(DNA)).select("sample", c), f"{c} is not DNA")
    return rows


def read_counts(spark: SparkSession, path: str, guide: str = "sgRNA", gene: str = "Gene", missing_gene: str | None = "NO_GENE_NAME") -> DataFrame:
    """A wide tab-separated table as (guide, gene, sample, count); null counts are 0, null genes ``missing_gene``."""
    wide = spark.read.csv(path, sep="\t", header=True)
    samples = [c for c in wide.columns if c not in (guide, gene)]
    long = wide.unpivot([guide, gene], samples, "sample", "count")
    name = F.coalesce(F.col(gene), F.lit(missing_gene)) if missing_gene else F.col(gene)
    return long.select(F.col(guide).alias("guide"), name.alias("gene"), "sample", F.coalesce(F.col("count").cast("double"), F.lit(0.0)).alias("count"))


def read_fold_changes(spark: SparkSession, path: str) -> DataFrame:
    """(guide, gene, sample, fc) of a fold-change table; a guide that stands twice is an error."""
    wide = spark.read.csv(path, sep="\t", header=True)
    guide, gene, *samples = wide.columns
    _must_be_empty(wide.groupBy(guide).count().filter("count > 1"), "guides must be unique")
    long = wide.unpivot([guide, gene], samples, "sample", "fc")
    return long.select(F.col(guide).alias("guide"), F.col(gene).alias("gene"), "sample", F.col("fc").cast("double").alias("fc"))


def read_library(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(guide, sequence, gene); the first of rows with equal guide."""
    rows = spark.read.csv(path, sep=sep, header=True)
    a, s, g = rows.columns[:3]
    named = rows.select(F.col(a).alias("guide"), F.upper(F.col(s)).alias("sequence"), F.col(g).alias("gene"), reading_order().alias("at"))
    return first_wins(named, ["guide"], "at").drop("at")


def reading_order() -> Column:
    """Where a row of a file stands: by the file's name, its block, and the place in that."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key by ``order``."""
    others = [c for c in df.columns if c not in keys]
    rows = df.withColumn("at", F.col(order))
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*others), "at").alias("x")).select(*keys, *[F.col(f"x.{c}").alias(c) for c in others])


def read_contrasts(spark: SparkSession, path: str) -> DataFrame:
    """(contrast, reference array, treatment array) of a semicolon-separated file with comma lists."""
    rows = spark.read.csv(path, sep=";", header=True)
    cut = lambda c: F.transform(F.split(c, ","), F.trim)
    return rows.select(
        F.concat_ws("_vs_", F.replace("treatment", F.lit(","), F.lit("_")), F.replace("reference", F.lit(","), F.lit("_"))).alias("contrast"),
        cut("reference").alias("reference"), cut("treatment").alias("treatment"),
    )


def read_gene_set(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(gene): the first tab field of each line, without the header line."""
    if header:
        rows = spark.read.csv(path, sep="\t", header=True)
        return rows.select(F.col(rows.columns[0]).alias("gene")).distinct()
    return spark.read.text(path).select(F.split("value", "\t")[0].alias("gene")).distinct()


def read_network(spark: SparkSession, path: str, genes: DataFrame | None = None) -> DataFrame:
    """(u, v) of a headerless tab-separated file, both ends among ``genes`` if given. Each edge comes in both directions, and an
    edge that the file has several times, in either direction, once each way."""
    rows = spark.read.csv(path, sep="\t", schema="u string, v string").select("u", "v")
    rows = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    for c in ("u", "v") if genes is not None else ():
        rows = rows.join(genes.select(F.col("gene").alias(c)), c, "left_semi")
    return rows.select("u", "v")


def read_align_info(spark: SparkSession, path: str) -> DataFrame:
    """(guide, perfect, mismatch): numbers of perfect and one-mismatch loci; an empty list is 0."""
    names = ["guide", "perfect_loci", "perfect_genes", "mismatch_loci", "mismatch_genes"]
    rows = spark.read.csv(path, sep="\t", schema=", ".join(f"{c} string" for c in names))
    n = lambda c: F.size(F.filter(F.split(F.coalesce(c, F.lit("")), ","), lambda x: x != "")).cast("bigint")
    return rows.select("guide", n("perfect_loci").alias("perfect"), n("mismatch_loci").alias("mismatch"))


def read_gene_names(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, gene_id, symbol, previous, aliases) of a tab-separated gene catalogue, in its order."""
    rows = spark.read.csv(path, sep="\t", header=True)
    get = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    return rows.select(reading_order().alias("ordinal"), get("hgnc_id").alias("gene_id"), get("symbol").alias("symbol"), get("prev_symbol").alias("previous"), get("alias_symbol").alias("aliases"))


def read_interactions(spark: SparkSession, path: str, names: tuple[str, str]) -> DataFrame:
    """(u, v) of a comma-separated interaction catalogue, from its two columns ``names``; rows without either are left out."""
    rows = spark.read.csv(path, header=True)
    return rows.select(F.col(names[0]).alias("u"), F.col(names[1]).alias("v")).dropna()


def read_alignment_csv(spark: SparkSession, path: str) -> DataFrame:
    """(sample, qname, pos, raw_cigar, seq) of comma-separated alignments (pos, cigar, id, seq); the sample is the file's name."""
    rows = spark.read.csv(path, header=True)
    sample = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.csv)?(\.gz)?$", 1)
    return rows.select(sample.alias("sample"), F.col("id").alias("qname"), F.col("pos").cast("bigint").alias("pos"), F.col("cigar").alias("raw_cigar"), "seq")


def columns_by(header: list[str], asked: list[str | int]) -> list[str]:
    """Names of the columns asked for by number (from 1, as a number or digits) or by name; both ``guide`` columns come before number 1."""
    out = []
    for x in asked:
        if isinstance(x, int) or x.isdigit():
            if not 1 <= int(x) <= len(header):
                raise ValueError(f"no column number {x}")
            out.append(header[int(x) - 1])
        elif x in header:
            out.append(x)
        else:
            raise ValueError(f"no column {x}")
    return out


def genome_entry(catalogue: dict[str, dict[str, str]], genome: str | None, attribute: str) -> str | None:
    """What a genome catalogue has for a genome and attribute; null without genome or entry."""
    return catalogue.get(genome or "", {}).get(attribute)


def significant(x: Column, digits: int = 3) -> Column:
    """A number as text of so many significant digits."""
    return F.format_string(f"%.{digits}g", x)


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated files with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def fixed(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Doubles as text with so many decimals, for export only."""
    return df.withColumns({c: F.format_string(f"%.{n}f", F.col(c)) for c, n in digits.items()})


def write_tsv(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Tab-separated files with a header, a folder for each value of ``by``."""
    w = df.write.mode("overwrite").option("sep", "\t").option("header", True)
    (w.partitionBy(*by) if by else w).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.write.mode("overwrite").json(path)


def upsert_stage(summary: DataFrame, new: DataFrame) -> DataFrame:
    """A stage summary (sample, stage, n, pct) in which rows of ``new`` replace those of equal sample and stage."""
    rows = summary.withColumn("at", F.lit(0)).unionByName(new.withColumn("at", F.lit(1)))
    return rows.groupBy("sample", "stage").agg(F.max_by(F.struct("n", "pct"), "at").alias("x")).select("sample", "stage", "x.n", "x.pct")
