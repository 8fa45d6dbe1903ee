"""Rating and finding rules as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Allele counts above which a frequency is flagged, by how the count is taken.
FLAG_ABOVE = {"hom": 15, "hemi": 30, "het": 30}


def association_rating(a: Column, b: Column, c: Column, d: Column, e: Column, families: Column) -> Column:
    """3 with (A or B or C) and D and E; else 2 with more than one family; else 1."""
    yes = lambda x: F.coalesce(x, F.lit(False))
    return F.when((yes(a) | yes(b) | yes(c)) & yes(d) & yes(e), 3).when(F.coalesce(families, F.lit(0)) > 1, 2).otherwise(1)


def finding(rating: Column, listed: Column, reviewed: Column, new_mode: Column, families: Column, older_only: Column | None = None) -> Column:
    """Reviewed entries, and in a monthly run those that rest on older literature only, give none; unlisted
    genes are new; a new mode needs two families; a higher rating is an upgrade."""
    older = F.lit(False) if older_only is None else F.coalesce(older_only, F.lit(False))
    return (
        F.when(F.coalesce(reviewed, F.lit(False)) | older, F.lit(None).cast("string"))
        .when(listed.isNull(), "new_gene")
        .when(F.coalesce(new_mode, F.lit(False)) & (F.coalesce(families, F.lit(0)) >= 2), "new_mode")
        .when(rating > listed, "upgrade")
    )


def preprint_gate(is_preprint: Column, families: Column, least: int = 5) -> Column:
    """Why a paper's evidence is left out, or null: preprints need families, and enough of them."""
    return F.when(~is_preprint, F.lit(None).cast("string")).when(families.isNull(), "preprint without family counts").when(families < least, F.lit(f"preprint with fewer than {least} families"))


def frequency_flag(mode: Column, het: Column, hom: Column, hemi: Column) -> Column:
    """Which count a mode of inheritance goes by, if it lies above that count's limit."""
    metric = F.when(mode == "BIALLELIC", "hom").when(mode == "X-LINKED", "hemi").otherwise("het")
    count = F.when(metric == "hom", hom).when(metric == "hemi", hemi).otherwise(het)
    limit = F.when(metric == "hom", FLAG_ABOVE["hom"]).when(metric == "hemi", FLAG_ABOVE["hemi"]).otherwise(FLAG_ABOVE["het"])
    return F.when(count > limit, metric)


def derived_families(reported: Column, families: Column, independent: Column) -> Column:
    """How an independent count was come by: not known, as reported, or fewer than reported."""
    return F.when(independent.isNull(), "unknown").when(reported.isNotNull() & (independent == reported), "reported").when(families.isNotNull() & (independent < families), "reduced").otherwise("derived")


# The modes of panels, and phrases that say which allele of an imprinted gene is expressed.
PATERNAL, MATERNAL = "imprinted, paternal allele expressed", "imprinted, maternal allele expressed"
IMPRINTED = {
    PATERNAL: "MONOALLELIC, autosomal or pseudoautosomal, maternally imprinted (paternal allele expressed)",
    MATERNAL: "MONOALLELIC, autosomal or pseudoautosomal, paternally imprinted (maternal allele expressed)",
}
IMPRINTED_UNKNOWN = "MONOALLELIC, autosomal or pseudoautosomal, imprinted status unknown"
NOT_IMPRINTED = "MONOALLELIC, autosomal or pseudoautosomal, NOT imprinted"


def mode_of_inheritance(modes: Column) -> Column:
    """One mode for a set: not reported drops out, Other gives way to what is specific, and MONOALLELIC and
    BIALLELIC, or BOTH with either, meet in BOTH; any other mixture is Other."""
    known = F.array_except(F.array_distinct(modes), F.array(F.lit("NR")))
    specific = F.array_except(known, F.array(F.lit("Other")))
    known = F.when(F.size(specific) > 0, specific).otherwise(known)
    has = lambda m: F.array_contains(known, m)
    rest = F.size(F.array_except(known, F.array(F.lit("BOTH"), F.lit("MONOALLELIC"), F.lit("BIALLELIC"))))
    return F.when(F.size(known) == 0, "Unknown").when(F.size(known) == 1, known[0]).when((rest == 0) & (has("BOTH") | (has("MONOALLELIC") & has("BIALLELIC"))), "BOTH").otherwise("Other")


def panel_mode(rows: Column) -> Column:
    """The mode on a panel of associations (mode, details): of a monoallelic gene also its imprinting, by the
    phrases in its monoallelic associations' details (joined by "; "): one direction, both (unknown) or none."""
    mode = mode_of_inheritance(F.transform(rows, lambda r: r["mode"]))
    single = F.filter(rows, lambda r: r["mode"] == "MONOALLELIC")
    said = F.flatten(F.transform(single, lambda r: F.transform(F.split(F.coalesce(r["details"], F.lit("")), ";"), lambda x: F.trim(x))))
    paternal, maternal = F.array_contains(said, PATERNAL), F.array_contains(said, MATERNAL)
    imprinted = F.when(paternal & maternal, IMPRINTED_UNKNOWN).when(paternal, IMPRINTED[PATERNAL]).when(maternal, IMPRINTED[MATERNAL]).otherwise(NOT_IMPRINTED)
    return F.when(mode == "MONOALLELIC", imprinted).otherwise(mode)


def gene_group(novel: Column, best: Column, unreviewed: Column) -> Column:
    """Where a gene stands in a report, by whether it is on no panel, the rating of its strongest finding
    (null: none), and whether nobody has reviewed one of its entries."""
    colour = F.when(best >= 3, "green").when(best == 2, "amber").otherwise("red")
    with_findings = F.when(novel, F.concat(F.lit("new-"), colour)).otherwise(F.concat(F.lit("finding-"), colour))
    return F.when(best.isNotNull(), with_findings).when(novel, "new-older").when(unreviewed, "unreviewed").otherwise("reviewed")


def contribution(group: Column) -> Column:
    """What a paper that adds to a gene of a group counts for, as a number that orders the buckets."""
    return F.when(group.startswith("new-"), 0).when(group.startswith("finding-"), 1).when(group == "unreviewed", 2).otherwise(3)


# The buckets of papers that add to genes, in the order of ``contribution``.
CONTRIBUTIONS = ("novel", "findings", "unreviewed", "already_reviewed")


def featured_bucket(best: Column, filtered: Column, assessed: Column, read: Column, in_corpus: Column, manual: Column, refused: Column) -> Column:
    """The bucket of a featured journal's paper; null for what is on its way and left out.

    ``best`` is the least contribution to a gene (null: none), ``filtered``
    whether its evidence was left out everywhere; then papers without a
    relevance result are left out, those read have no evidence, those of the
    corpus wait for a manual download or are left out, and others were refused
    or screened out.
    """
    known = F.element_at(F.array(*map(F.lit, CONTRIBUTIONS)), best + 1)
    outside = F.when(refused, "refused").otherwise("not_relevant")
    waiting = F.when(in_corpus, F.when(manual, "manual_download")).otherwise(outside)
    return F.when(best.isNotNull(), known).when(filtered, "filtered").when(assessed, F.when(read, "read_no_evidence").otherwise(waiting))


def best_candidate(rows: Column, count: str, key: str) -> Column:
    """The row of the greatest count (none counts as -1), ties by the smallest key."""
    worth: Callable[[Column], Column] = lambda r: F.struct((-F.coalesce(r[count], F.lit(-1))).alias("w"), r[key].alias("k"), r.alias("r"))
    return F.array_min(F.transform(rows, worth))["r"]


def stage_state(stored: Column, refused: Column, failed: Column) -> Column:
    return F.when(stored, "stored").when(refused, "refused").when(failed, "failed").otherwise("not_run")
