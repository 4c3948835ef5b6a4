"""Run parameters with their defaults and the rules they must meet."""

from __future__ import annotations

import re
from dataclasses import dataclass, field


@dataclass
class Params:
    """One run: what to analyse, with which callers and thresholds."""

    input: str | None = None
    outdir: str | None = None
    analysis: str = "targeted"
    # amplicons
    overrepresented: bool = False
    umi_clustering: bool = False
    skip_clonality: bool = False
    umi_bin_size: int = 1
    vsearch_minseqlength: int = 55
    vsearch_maxseqlength: int = 57
    vsearch_id: float = 0.99
    keep_singletons: bool = False
    aligner: str = "minimap2"
    reference: str | None = None
    protospacer: str | None = None
    # screens
    library: str | None = None
    count_table: str | None = None
    fasta: str | None = None
    five_prime_adapter: str | None = None
    three_prime_adapter: str | None = None
    contrasts: str | None = None
    mle_design_matrix: str | None = None
    mle_control_sgrna: str | None = None
    day0_label: str | None = None
    rra: bool = False
    mle: bool = False
    bagel2: bool = False
    drugz: bool = False
    drugz_remove_genes: list[str] = field(default_factory=list)
    bagel_reference_essentials: str | None = None
    bagel_reference_nonessentials: str | None = None
    crisprcleanr: str | None = None
    min_reads: int = 30
    min_targeted_genes: int = 3
    hitselection: bool = False
    hit_selection_iteration_nb: int = 1000


def validate(p: Params) -> list[str]:
    """Raises ValueError for what can't run; returns warnings."""
    warnings = []
    if p.analysis not in ("targeted", "screening"):
        raise ValueError("analysis is targeted or screening")
    if p.aligner not in ("minimap2", "bwa", "bowtie2"):
        raise ValueError("aligner is minimap2, bwa or bowtie2")
    if p.protospacer and not re.fullmatch("[ACGTacgt]+", p.protospacer):
        raise ValueError("protospacer is not DNA")
    if p.analysis == "screening":
        if p.input and p.count_table:
            raise ValueError("give reads or a count table, not both")
        if not p.input and not p.count_table:
            raise ValueError("give reads or a count table")
        if p.input and not p.library:
            raise ValueError("counting reads needs a library")
        for caller in ("rra", "bagel2", "drugz"):
            if getattr(p, caller) and not p.contrasts:
                raise ValueError(f"{caller} needs contrasts")
        if p.mle and not (p.contrasts or p.mle_design_matrix or p.day0_label):
            raise ValueError("mle needs contrasts, a design matrix or a day-0 label")
        if p.mle_design_matrix and p.contrasts:
            warnings.append("mle uses the design matrix and the contrasts")
        if p.mle and p.crisprcleanr:
            warnings.append("counts are normalised already: mle doesn't normalise them again")
        if p.bagel2 and not (p.bagel_reference_essentials and p.bagel_reference_nonessentials):
            raise ValueError("bagel2 needs both gene sets")
    return warnings
