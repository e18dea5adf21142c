"""Duplicate samples by a hash of their alleles at fully called sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.functions import sites as s
from locusweave.operators import digests


def perfect_sites(genotype: DataFrame, sites: DataFrame) -> DataFrame:
    """Sites without a missing call whose position occurs once."""
    full = genotype.groupBy("variant_id").agg(F.bool_and(F.col("dosage").isNotNull()).alias("__ok")).where("__ok").select("variant_id")
    kept = sites.join(full, "variant_id", "left_semi")
    once = kept.groupBy("chromosome", "position").agg(F.count(F.lit(1)).alias("__n")).where("__n = 1")
    return kept.join(once, ["chromosome", "position"], "left_semi")


def fingerprints(genotype: DataFrame, sites: DataFrame) -> DataFrame:
    """MD5 of each sample's allele pairs in the order of the sites, and their number. The pairs stream by; a sample may have any number of sites."""
    pairs = genotype.join(sites.select("variant_id", "chromosome", "position", "ref", "alt"), "variant_id")
    pairs = pairs.select("sample_id", "variant_id", "chromosome", "position", s.allele_pair("dosage", "alt", "ref").alias("pair"))
    return digests.ordered_md5(pairs, "sample_id", [s.chromosome_rank("chromosome"), F.col("position"), F.col("variant_id")], "pair")


def missing_alleles(genotype: DataFrame, sites: DataFrame) -> DataFrame:
    """Missing calls at the sites: variant_id, sample_id."""
    return genotype.join(sites.select("variant_id"), "variant_id").where("dosage IS NULL").select("variant_id", "sample_id")


def members(prints: DataFrame) -> DataFrame:
    """sample_id, hash and group size n of each sample whose hash another sample has too, a row a sample."""
    shared = prints.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return prints.join(shared, "hash").select("sample_id", "hash", "n")


def duplicate_groups(prints: DataFrame) -> DataFrame:
    """Hashes of two samples or more. Groups of equal hashes are copies of one person's sample, a handful."""
    return prints.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("sample_id")), ",").alias("sample_ids")).where("n > 1")
