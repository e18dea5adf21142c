"""Counts, frequencies and quality statistics of genotypes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.functions import sites as s

MISSING = F.isnull  # a missing call is NULL


def call_counts(genotype: DataFrame, *keys: str, het: float = s.HET, hom: float = s.HOM) -> DataFrame:
    """het, hom and carriers by key."""
    d = F.col("dosage")
    n_het, n_hom = s.count_if((d >= het) & (d < hom)), s.count_if(d >= hom)
    return genotype.groupBy(*keys).agg(n_het.alias("het_count"), n_hom.alias("hom_count"), (n_het + n_hom).alias("carrier_count"))


def allele_freq(genotype: DataFrame, *keys: str) -> DataFrame:
    """ALT_FREQS and OBS_CT."""
    n = F.count("dosage")
    return genotype.groupBy(*keys).agg((F.sum("dosage") / (2 * F.nullif(n, F.lit(0)))).alias("alt_freqs"), (2 * n).alias("obs_ct"))


def missing_rate(genotype: DataFrame, *keys: str) -> DataFrame:
    return genotype.groupBy(*keys).agg(F.avg(F.isnull("dosage").cast("double")).alias("f_miss"))


def variant_stats(genotype: DataFrame, *keys: str) -> DataFrame:
    """Frequency, observations and missing rate in one aggregate."""
    n = F.count("dosage")
    return genotype.groupBy(*keys).agg((F.sum("dosage") / (2 * F.nullif(n, F.lit(0)))).alias("alt_freqs"), (2 * n).alias("obs_ct"), F.avg(F.isnull("dosage").cast("double")).alias("f_miss"))


def geno_filter(genotype: DataFrame, most: float, key: str = "variant_id") -> DataFrame:
    """Rows of variants (or samples) whose missing rate is at most ``most``."""
    ok = missing_rate(genotype, key).where(F.col("f_miss") <= most).select(key)
    return genotype.join(ok, key, "left_semi")


def carrier_statistics(genotype: DataFrame, *keys: str) -> DataFrame:
    d = F.col("dosage")
    n = F.count("dosage")
    return genotype.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_samples"),
        s.count_if((d >= s.HET) & (d < s.HOM)).alias("heterozygous"),
        s.count_if(d >= s.HOM).alias("homozygous"),
        s.count_if(d.isNull()).alias("missing"),
        (F.sum("dosage") / (2 * F.nullif(n, F.lit(0)))).alias("allele_frequency"),
    )


def weighted_combine(stats: DataFrame, *keys: str, null_mode: str = "skip") -> DataFrame:
    """OBS-weighted means of alt_freqs and f_miss over labels.

    ``skip`` leaves labels with a null value out of its mean; ``zero`` counts a value as 0 where there are observations.
    """
    out = [F.sum("obs_ct").alias("obs_ct")]
    for c in ("alt_freqs", "f_miss"):
        weight = F.when(F.col(c).isNotNull(), F.col("obs_ct")) if null_mode == "skip" else F.col("obs_ct")
        out.append((F.sum(F.coalesce(F.col(c), F.lit(0.0)) * weight) / F.nullif(F.sum(weight), F.lit(0))).alias(c))
    return stats.groupBy(*keys).agg(*out)


def minor_allele_frequency(genotype: DataFrame, *keys: str) -> DataFrame:
    af = F.avg("dosage") / 2
    return genotype.groupBy(*keys).agg(F.least(af, 1 - af).alias("maf"))


def hardy_weinberg(genotype: DataFrame, *keys: str, chi2_limit: float = 15.137) -> DataFrame:
    """Chi-square with one degree of freedom against expected genotype counts; ``passes`` under the limit."""
    d = F.col("dosage")
    counts = genotype.groupBy(*keys).agg(s.count_if(d == 0).alias("n0"), s.count_if(d == 1).alias("n1"), s.count_if(d == 2).alias("n2"))
    n = F.col("n0") + F.col("n1") + F.col("n2")
    p = (F.col("n1") + 2 * F.col("n2")) / (2.0 * F.nullif(n, F.lit(0)))
    expected = {"n0": n * (1 - p) * (1 - p), "n1": n * 2 * p * (1 - p), "n2": n * p * p}
    terms = [F.when(e > 0, (F.col(c) - e) * (F.col(c) - e) / e).otherwise(F.lit(0.0)) for c, e in expected.items()]
    return counts.withColumn("chi2", terms[0] + terms[1] + terms[2]).withColumn("passes", F.coalesce(F.col("chi2") < chi2_limit, F.lit(True)))


def heterozygosity(genotype: DataFrame, limit: float = 0.25) -> DataFrame:
    """Per sample F = 1 - observed / expected heterozygotes; ``passes`` inside (-limit, limit)."""
    af = genotype.groupBy("variant_id").agg((F.avg("dosage") / 2).alias("af"))
    called = genotype.where("dosage IS NOT NULL").join(af, "variant_id")
    per = called.groupBy("sample_id").agg(s.count_if(F.col("dosage") == 1).alias("observed"), F.sum(2 * F.col("af") * (1 - F.col("af"))).alias("expected"))
    f = F.when(F.col("expected") > 0, 1 - F.col("observed") / F.col("expected"))
    return per.withColumn("f", f).withColumn("passes", F.coalesce((F.col("f") > -limit) & (F.col("f") < limit), F.lit(False)))


def case_control_missing(genotype: DataFrame, samples: DataFrame, chi2_limit: float = 15.137) -> DataFrame:
    """Chi-square of missing calls by case status for each variant; ``samples``: sample_id, is_case."""
    rows = genotype.join(samples, "sample_id").select("variant_id", F.isnull("dosage").alias("m"), F.col("is_case").alias("c"))
    n = rows.groupBy("variant_id").agg(
        s.count_if(F.col("m") & F.col("c")).alias("a"), s.count_if(~F.col("m") & F.col("c")).alias("b"), s.count_if(F.col("m") & ~F.col("c")).alias("x"), s.count_if(~F.col("m") & ~F.col("c")).alias("y")
    )
    a, b, x, y = (F.col(k).cast("double") for k in "abxy")
    below = (a + b) * (x + y) * (a + x) * (b + y)
    chi2 = F.when(below > 0, (a + b + x + y) * (a * y - b * x) * (a * y - b * x) / below).otherwise(F.lit(0.0))
    return n.select("variant_id", F.col("a").alias("case_missing"), F.col("x").alias("control_missing"), chi2.alias("chi2"), (chi2 < chi2_limit).alias("passes"))
