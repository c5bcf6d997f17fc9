"""Key tuples and the feature dictionary."""

from __future__ import annotations

from collections.abc import Sequence

LOCUS = ("study_id", "chrom", "pos", "ref", "alt")
LOCUS_GENE = (*LOCUS, "gene_id")
#: The same key with its most varied column first, a number, which sorts far faster than study names do.
LOCUS_SORT = ("pos", "chrom", "study_id", "ref", "alt")
TAG = ("tag_chrom", "tag_pos", "tag_ref", "tag_alt")
LEAD = ("lead_chrom", "lead_pos", "lead_ref", "lead_alt")
VARIANT = ("chrom", "pos", "ref", "alt")
QTL_TYPES = ("eqtl", "sqtl", "pqtl")
CHROMOSOMES = (*[str(i) for i in range(1, 23)], "X")

#: The feature columns by family.
EVIDENCE_COLUMNS = {
    "dhs_prmtr": ("dhs_prmtr_max", "dhs_prmtr_max_nbh", "dhs_prmtr_ave", "dhs_prmtr_ave_nbh"),
    "enhc_tss": ("enhc_tss_max", "enhc_tss_max_nbh", "enhc_tss_ave", "enhc_tss_ave_nbh"),
    "pchicJung": ("pchicJung_max", "pchicJung_max_nbh", "pchicJung_ave", "pchicJung_ave_nbh"),
    "vep": ("vep_credset_max", "vep_credset_max_nbh", "vep_ave", "vep_ave_nbh"),
    "polyphen": ("polyphen_credset_max", "polyphen_credset_max_nbh", "polyphen_ave", "polyphen_ave_nbh"),
}
DISTANCE_SENTINEL = ("dist_foot_sentinel", "dist_foot_sentinel_nbh", "dist_tss_sentinel", "dist_tss_sentinel_nbh")
DISTANCE_SETS = ("dist_foot_min", "dist_foot_min_nbh", "dist_foot_ave", "dist_foot_ave_nbh", "dist_tss_min", "dist_tss_min_nbh", "dist_tss_ave", "dist_tss_ave_nbh")
COLOC = tuple(f"{t}_coloc_llr_{x}" for t in QTL_TYPES for x in ("max", "max_neglogp", "max_nbh"))
CLPP = tuple(f"{t}_pics_clpp_{x}" for t in QTL_TYPES for x in ("max", "max_neglogp", "max_nhb"))
DENSITY = tuple(f"gene_count_lte_{k}k" for k in (50, 100, 250, 500))
HELPERS = ("count_credset_95", "has_sumstats", *DENSITY, "proteinAttenuation")


def sort_order(keys: Sequence[str]) -> list[str]:
    """The keys, with ``LOCUS_SORT`` in place of a locus among them; for windows and joins, whose results don't depend on the order."""
    if not set(LOCUS) <= set(keys):
        return list(keys)
    return [*LOCUS_SORT, *[k for k in keys if k not in LOCUS]]


def feature_groups() -> dict[str, tuple[str, ...]]:
    """Group name -> columns, as the feature sets combine them."""
    e = EVIDENCE_COLUMNS
    return {
        "distance": DISTANCE_SETS,
        "molecularQTL": COLOC + CLPP,
        "interaction": e["dhs_prmtr"] + e["enhc_tss"] + e["pchicJung"],
        "pathogenicity": e["vep"] + e["polyphen"],
        "helper": HELPERS,
    }


def feature_sets() -> dict[str, tuple[str, ...]]:
    """The eleven sets: full, two of one distance, leave-one-group-out, and one group with the helpers."""
    groups = feature_groups()
    evidence = [g for g in groups if g != "helper"]
    sets = {"full_model": sum(groups.values(), ()), "dist_foot": ("dist_foot_sentinel_nbh",), "dist_tss": ("dist_tss_sentinel_nbh",)}
    sets |= {f"logo_{g}": sum((c for n, c in groups.items() if n != g), ()) for g in evidence}
    sets |= {f"group_{g}": groups[g] + groups["helper"] for g in evidence}
    return sets


def missing_features(columns: list[str]) -> set[str]:
    """Columns that some feature set needs and a matrix lacks."""
    return {c for s in feature_sets().values() for c in s} - set(columns)
