"""Whole runs: parameters and inputs to result tables. Nothing is computed before :func:`publish`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editlake.operators import align, models, screening, targeted
from editlake.params import Params, validate


def screen(p: Params, counts: DataFrame, contrasts: list[tuple[list[str], list[str]]], gene_sets: tuple[DataFrame, DataFrame] | None = None, network: DataFrame | None = None, controls: DataFrame | None = None) -> dict[str, DataFrame]:
    """Result tables by name from (guide, gene, sample, count); contrasts are (reference, treatment) samples.

    ``controls`` (guide): the regression takes its size factors and a second p from these guides.
    """
    validate(p)
    counts = screening.remove_genes(counts, [])
    out = {"count_summary": screening.count_summary(counts), "size_factors": screening.median_ratio(counts)}
    for k, (reference, treatment) in enumerate(contrasts):
        if p.drugz:
            kept = screening.remove_genes(counts, p.drugz_remove_genes)
            paired = len(reference) == len(treatment)
            rows = (screening.paired_changes if paired else screening.unpaired_changes)(kept, reference, treatment)
            out[f"drugz_{k}"] = screening.drug_scores(rows)
        if p.rra:
            out[f"rra_{k}"] = models.rra(counts, reference, treatment)
        if p.mle:
            design = {x: [1.0, 0.0] for x in reference} | {x: [1.0, 1.0] for x in treatment}
            known = out["size_factors"] if controls is None else screening.median_ratio(counts.join(controls.select("guide").distinct(), "guide", "left_semi"))
            dispersion = models.dispersion_trend(counts, design, known)
            fits = models.mle_fits(counts, design, known, dispersion)
            null = None
            if controls is not None:
                nums = [r.num for r in fits.select("num").distinct().orderBy("num").collect()]  # the few sizes of a library's genes
                null = models.control_fits(counts, controls, nums, design, known, dispersion=dispersion)
            out[f"mle_{k}"], out[f"mle_guides_{k}"] = models.effect_table(fits, null), models.guide_efficiency(fits)
        if p.bagel2 and gene_sets:
            fc = screening.pooled_changes(counts, reference, treatment).persist()  # guide-level
            both = screening.densities(fc, *gene_sets).persist()
            ends = screening.valid_interval(both, fc, gene_sets[1])
            fit = screening.ratio_fit(fc, screening.ratio_lookup(both, ends), ends)
            out[f"bagel_{k}"] = screening.bayes_factors(fc, fit, ["gene"])
            out[f"bagel_pr_{k}"] = screening.precision_recall(out[f"bagel_{k}"], *gene_sets)
        if p.hitselection and network is not None and p.drugz:
            ranked = out[f"drugz_{k}"].select("gene", F.col("rank_synth").alias("rank"))
            most = p.hit_selection_iteration_nb
            out[f"hits_{k}"] = screening.hit_scores(screening.prefix_edges(ranked, network, most), screening.expected_edges(ranked, network, most))
    return out


def amplicons(p: Params, alignments: DataFrame) -> dict[str, DataFrame]:
    """Result tables by name from alignments (sample, qname, pos, raw_cigar, seq, qual, mapq)."""
    validate(p)
    rows = targeted.explode_cigars(alignments)
    samples = alignments.select("sample").distinct()
    called = targeted.call_variants(targeted.collapse(rows))
    reads = targeted.reads_of(targeted.all_events(called), rows)
    wild = targeted.wild_type_counts(called)
    flagged = targeted.flag_reads(reads, targeted.error_filter(reads, wild), targeted.peak_filter(reads))
    edits = targeted.edit_summary(samples, reads, wild)
    out = {"indels": flagged, "edits": edits, "qc": targeted.qc_crosstab(samples, flagged, called), "genotypes": targeted.genotypes(reads)}
    if not p.skip_clonality:
        ins = targeted.insertion_context(reads.filter("modification = 'ins'"))
        out["clonality"] = targeted.clonality(targeted.percentages(edits), targeted.indel_groups(reads, ins))
    return out


def align_amplicons(p: Params, reads: DataFrame, references: DataFrame) -> DataFrame:
    """Reads (sample, read_id, seq, qual) against their sample's reference, masked first, with the aligner's scores."""
    masked = targeted.quality_mask(reads)
    pairs = masked.join(references, "sample")  # one reference a sample
    rows = align.align_pairs(pairs, "seq", "reference", "local", align.PROFILES[p.aligner])
    return rows.select("sample", F.col("read_id").cast("string").alias("qname"), F.col("start").alias("pos"), F.lit(60).alias("mapq"), F.col("cigar").alias("raw_cigar"), "seq", "qual")


def publish(tables: dict[str, DataFrame], outdir: str) -> None:
    """Write every table once, as Parquet under its name."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{outdir}/{name}")
