"""Carrier screening: from genotypes and a variant list to carriers by gene and ancestry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from locusweave.operators import alleles, coverage, probes, reports
from locusweave.plans.stages import StageStore, digest, fingerprint
from locusweave.sources.shared import new_folder


def corrected_genotypes(genotype: DataFrame, pvar: DataFrame, snp_list: DataFrame) -> DataFrame:
    """Harmonized dosages, turned where the allele frequency of a source is over one half."""
    return alleles.corrected(genotype, alleles.harmonize(pvar, snp_list))


@dataclass
class Screening:
    """Stored results of a screening; a report that was left out is None."""

    genotype: DataFrame
    carriers: DataFrame
    probe_selection: DataFrame | None
    locus_report: DataFrame | None
    variant_report: DataFrame | None
    coverage: DataFrame | None
    stages: StageStore


def screen(
    genotype: DataFrame, pvar: DataFrame, snp_list: DataFrame, samples: DataFrame, visits: DataFrame, folder: str | None = None,
    merge_ancestries: bool = True, select_probes: bool = True, report: tuple[str, ...] = ("locus", "variant", "coverage"),
) -> Screening:
    """The whole screening, stage by stage: correction by file, merge of the ancestries, probe selection (NBA rows are kept for the probes that agree best with WGS), carriers and reports.

    Corrected and merged genotypes are kept in buckets of variants, carriers in buckets of samples, so that rows are dealt anew only where a step needs another key. Every stage is a stored table below ``folder`` under a key of its inputs and options. With the folder of an earlier run, stages whose inputs are the same are read, and only what has changed
    and what stands on it is computed. Merge, probe selection and each report can be left out.
    """
    spark = genotype.sparkSession
    store = StageStore(spark, folder or new_folder(spark, "screening"))
    genotype = genotype if "source" in genotype.columns else alleles.with_source(genotype, samples)
    listed, known, seen = (fingerprint(df) for df in (snp_list, samples, visits))
    at = digest(fingerprint(genotype), fingerprint(pvar), listed)
    corrected = store.get("corrected", at, lambda: corrected_genotypes(genotype, pvar, snp_list), "data_type", dealt="variant_id")
    merged, by_file = corrected, at
    if merge_ancestries:
        at = digest("merged", at)
        metadata = [c for c in corrected.columns if c not in (*alleles.KEYS, "data_type", "sample_id", "dosage")]
        merged = store.get("merged", at, lambda: alleles.merge_sources(corrected, "source", ["data_type", *alleles.KEYS], *metadata, dealt=True), "data_type", dealt="variant_id")
    chosen, kept = None, merged
    if select_probes:
        at = digest("probes", at)
        chosen = store.get("probes", at, lambda: probes.selection_map(probes.consensus(probes.probe_metrics(probes.probe_grid(merged, least_probes=2)))))
        kept = probes.probe_filter(merged, chosen, "NBA")
    at = digest("carriers", at, listed, known, seen)
    rows = store.get("carriers", at, lambda: reports.carriers(kept, snp_list, samples.hint("merge"), visits, alleles.harmonize(pvar, snp_list)), dealt="sample_id")
    wgs = merged.where("data_type = 'WGS'").select("sample_id").distinct()
    by = [c for c in ("data_type", "source") if c in corrected.columns]
    once = store.get("list_rows", digest("once", at), lambda: reports.by_list_row(rows.drop(*reports.METADATA), wgs), dealt="sample_id") if "variant" in report else None
    builds = {
        "locus": (at, lambda: reports.locus_report(rows)),
        "variant": (at, lambda: reports.report_of(once, snp_list)),
        "coverage": (digest(by_file, listed), lambda: coverage.coverage_by_source(snp_list, covered_sites(corrected, pvar), *by)),
    }
    found = {name: store.get(f"{name}_report", digest(name, key), build) for name, (key, build) in builds.items() if name in report}
    return Screening(kept, rows, chosen, *(found.get(name) for name in builds), store)


def covered_sites(genotype: DataFrame, pvar: DataFrame) -> DataFrame:
    """Sites at which a data type and ancestry have a call."""
    by = [c for c in ("data_type", "source") if c in genotype.columns]
    called = genotype.where("dosage IS NOT NULL").select(*by, "variant_id").distinct()
    return called.join(pvar.select("variant_id", "chromosome", "position", "ref", "alt"), "variant_id")


def comparison(rows: DataFrame, reference: str, other: str) -> DataFrame:
    """Locus measures of one source over the samples that another source has too."""
    shared = rows.where(rows.data_type == other).select("sample_id").distinct()
    return reports.locus_report(rows.where(rows.data_type == reference).join(shared, "sample_id", "left_semi"))
