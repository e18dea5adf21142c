"""Cohort statistics: recruitment, distributions, pruning, relatedness, model metrics, browser tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusweave.functions import sites as s
from locusweave.operators import alleles

#: Order of the sample steps of pruning; what each is called.
PRUNE_STEPS = {"callrate_prune": "Call Rate Prune", "sex_prune": "Sex Prune", "het_prune": "Heterozygosity Prune"}
#: Codes of sex.
SEX = {"1": "Male", "2": "Female", "0": "Unknown"}


def value_counts(df: DataFrame, *columns: str, unknown: str | None = None) -> DataFrame:
    """Rows by value, most frequent first; ties by value."""
    named = df.select(*(F.coalesce(F.col(c), F.lit(unknown)).alias(c) if unknown else F.col(c) for c in columns))
    return named.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), *columns)


def shares(df: DataFrame, column: str) -> DataFrame:
    """Counts and shares of a column's values. The total is an aggregate of the counts, of which there are few."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("share", F.col("count") / counts.agg(F.sum("count")).scalar())


def unpruned(samples: DataFrame) -> DataFrame:
    return samples.where("prune_reason IS NULL")


def multi_select(df: DataFrame, **chosen: list) -> DataFrame:
    """Each list that isn't empty restricts its column."""
    for column, values in chosen.items():
        if values:
            df = df.where(F.col(column).isin(values))
    return df


def text_search(df: DataFrame, text: str, *columns: str) -> DataFrame:
    """Rows with the text in any of the columns, whatever its case."""
    test = F.lit(False)
    for c in columns:
        test = test | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(text.lower())), F.lit(False))
    return df.where(test)


def clean_master(samples: DataFrame, release: int) -> DataFrame:
    """Key rows with release, the first token of the prune reason and a duplicate flag."""
    reason = F.substring_index(F.substring_index("prune_reason", "-", 1), " ", 1)
    dup = F.coalesce(F.contains(F.lower("prune_reason"), F.lit("duplicate")).cast("int"), F.lit(0))
    return samples.select("sample_id", "study", F.col("nba_label").alias("label"), "sex", reason.alias("prune_reason"), dup.alias("dup"), "related", F.lit(release).alias("release"))


def code_map(column: str | Column, codes: dict[str, str], keep_unknown: bool = True) -> Column:
    """Names of codes; an unknown code stays, or becomes null."""
    found = F.try_element_at(F.create_map(*(F.lit(x) for kv in codes.items() for x in kv)), s.col(column))
    return F.coalesce(found, s.col(column)) if keep_unknown else found


def clinical_derived(rows: DataFrame) -> DataFrame:
    """Age at visit, and disease duration from the age at visit, else from the baseline ages."""
    at_visit = F.col("age_at_sample_collection") + F.col("visit_month") / 12
    return rows.withColumns({"age_at_visit": at_visit, "disease_duration": F.coalesce(at_visit - F.col("age_of_onset"), F.col("age_at_sample_collection") - F.col("age_of_onset"))})


def recruitment_join(clinical: DataFrame, carriers: DataFrame) -> DataFrame:
    """Carriers with their clinical row; of several the one of the first visit."""
    order = ["visit_month", "moca_total_score", "hoehn_and_yahr_stage", "dat_sbr_caudate_mean"]
    once = alleles.first_per_key(clinical, ["sample_id"], *(F.asc_nulls_last(c) for c in order))
    return carriers.join(once, "sample_id", "left")


def recruitment_stats(rows: DataFrame, *keys: str) -> DataFrame:
    """Measures by locus and ancestry over one row per sample."""
    hy, moca, dat = F.col("hoehn_and_yahr_stage"), F.col("moca_total_score"), F.col("dat_sbr_caudate_mean")
    duration, age, onset = F.col("disease_duration"), F.col("age_at_sample_collection"), F.col("age_of_onset")
    r = lambda c: F.round(c, 4)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), s.count_if(F.col("phenotype") == "PD").alias("pd_count"),
        r(F.avg(age)).alias("age_mean"), r(F.stddev_samp(age)).alias("age_std"), r(F.avg(onset)).alias("aao_mean"), r(F.stddev_samp(onset)).alias("aao_std"),
        F.count(hy).alias("hy_available"), s.count_if(hy <= 2).alias("hy_le_2"), s.count_if(hy <= 3).alias("hy_le_3"), s.count_if(hy.isNull()).alias("hy_missing"),
        r(F.avg(moca)).alias("moca_mean"), F.count(moca).alias("moca_available"), s.count_if(moca >= 20).alias("moca_ge_20"), s.count_if(moca >= 24).alias("moca_ge_24"),
        r(F.avg(dat)).alias("dat_mean"), F.count(dat).alias("dat_available"), s.count_if(dat.isNull()).alias("dat_missing"),
        s.count_if(duration <= 5).alias("duration_le_5"), s.count_if(duration <= 7).alias("duration_le_7"), s.count_if(duration.isNull()).alias("duration_missing"),
    )


def locus_carriers(genotype: DataFrame, variants: DataFrame, below: float = 2.0) -> DataFrame:
    """Samples with any variant of a locus under ``below`` (the dosage counts reference alleles)."""
    return genotype.join(variants.select("variant_id", "locus").distinct(), "variant_id").where(F.col("dosage") < below).select("sample_id", "locus").distinct()


def recruitment_summary(flags: DataFrame, samples: DataFrame) -> DataFrame:
    """Loci, carriers, and the largest cohort."""
    sizes = samples.groupBy(F.coalesce("study", F.lit("Unknown")).alias("study")).agg(F.count(F.lit(1)).alias("n"))
    cohorts = sizes.agg(F.count(F.lit(1)).alias("cohorts"), F.max_by("study", F.struct("n", "study")).alias("largest_cohort"), F.max("n").alias("largest_size"))
    one = flags.agg(F.countDistinct("locus").alias("loci"), F.countDistinct("sample_id").alias("carriers"), F.count(F.lit(1)).alias("locus_carriers"))
    return one.withColumn("__k", F.lit(1)).join(cohorts.withColumn("__k", F.lit(1)), "__k").drop("__k")


def prune_funnel(qc: DataFrame, total: int) -> DataFrame:
    """Samples left after each step of pruning, in the order of the steps; other sample steps sort last, without a name."""
    steps = qc.where("level = 'sample' AND step <> 'related_prune'").groupBy("step").agg(F.sum("pruned_count").alias("pruned_count"))
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, PRUNE_STEPS)), F.col("step")).cast("int"), F.lit(0))
    rank = F.when(rank > 0, rank).otherwise(99)
    w = Window.orderBy("rank", "step").rowsBetween(Window.unboundedPreceding, 0)  # a row per step
    return steps.withColumn("rank", rank).select("step", code_map("step", PRUNE_STEPS, False).alias("step_name"), "rank", "pruned_count", (F.lit(total) - F.sum("pruned_count").over(w)).alias("remaining"))


def variant_qc(qc: DataFrame, metrics: list[str]) -> DataFrame:
    """Variant metrics side by side by ancestry; absent ones are null."""
    return qc.where("level = 'variant'").groupBy("ancestry").pivot("metric", metrics).agg(F.sum("pruned_count"))


def related_counts(pairs: DataFrame) -> DataFrame:
    """By ancestry, different first ids of first- and second-degree pairs; null as 0. An id counts in its first ancestry."""
    first = pairs.where("REL IN ('first_deg', 'second_deg')").groupBy("REL", "IID1").agg(F.min("ancestry").alias("ancestry"))
    n = lambda kind: s.count_if(F.col("REL") == kind)
    return first.groupBy("ancestry").agg(n("first_deg").alias("first_degree"), n("second_deg").alias("second_degree"))


def related_dup_per_label(samples: DataFrame) -> DataFrame:
    """Related and duplicate samples by label, for labels with any related."""
    dup = F.contains(F.lower("prune_reason"), F.lit("duplicate"))
    out = samples.groupBy("nba_label").agg(F.sum("related").cast("long").alias("related_count"), s.count_if(dup).alias("duplicated_count"))
    return out.where("related_count > 0")


def group_sums(samples: DataFrame) -> DataFrame:
    """Each sample with its label's sums (an aggregate joined back; labels are few)."""
    sums = samples.groupBy("nba_label").agg(F.sum("related").cast("long").alias("label_related"), F.count(F.lit(1)).alias("label_samples"))
    return samples.join(sums, "nba_label").select("sample_id", "nba_label", "label_related", "label_samples")


def symmetric_pairs(pairs: DataFrame) -> DataFrame:
    swapped = pairs.select(F.col("IID2").alias("IID1"), F.col("IID1").alias("IID2"), "REL", "ancestry")
    return pairs.select("IID1", "IID2", "REL", "ancestry").unionByName(swapped)


def duplicate_report(pruned: DataFrame, clinical: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pruned samples with their duplicate partner and both sides' sex and study, and the same with sides swapped; then the samples that failed by sex.

    ``pruned``: sample_id, step; steps other than callrate and sex are named duplicate.
    """
    p = pruned.select(F.col("sample_id").alias("IID1"), F.when(F.col("step").isin("callrate", "sex"), F.col("step")).otherwise("duplicate").alias("pruned_reason"))
    side = lambda k: clinical.select(F.col("sample_id").alias(f"IID{k}"), F.col("sex").alias(f"sex{k}"), F.col("study").alias(f"study{k}"))
    one = p.where("pruned_reason = 'duplicate'").join(side(1), "IID1").join(pairs.where("REL = 'duplicate'").select("IID1", "IID2"), "IID1").join(side(2), "IID2")
    one = one.select("IID1", "IID2", "sex1", "sex2", "study1", "study2", "pruned_reason")
    other = one.select(F.col("IID2").alias("IID1"), F.col("IID1").alias("IID2"), F.col("sex2").alias("sex1"), F.col("sex1").alias("sex2"), F.col("study2").alias("study1"), F.col("study1").alias("study2"), "pruned_reason")
    na = F.lit("na")
    failed = p.where("pruned_reason = 'sex'").join(side(1), "IID1").select("IID1", na.alias("IID2"), "sex1", na.alias("sex2"), "study1", na.alias("study2"), "pruned_reason")
    return one.unionByName(other).unionByName(failed).orderBy("IID1", "IID2")


def phenotype_by_sex(rows: DataFrame) -> DataFrame:
    out = rows.groupBy("phenotype").pivot("sex", ["Male", "Female"]).count()
    male, female = (F.coalesce(c, F.lit(0)).cast("long") for c in ("Male", "Female"))
    return out.select("phenotype", male.alias("male"), female.alias("female"), (male + female).alias("total")).orderBy(F.desc("total"), "phenotype")


def histogram(rows: DataFrame, column: str, lo: float, hi: float, bins: int, *by: str) -> DataFrame:
    """Counts by bin of equal width; nulls are left out, the upper end belongs to the last bin."""
    x = F.col(column)
    bin_of = F.least(F.floor((x - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")
    return rows.where(x.between(lo, hi)).groupBy(*by, bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def genotype_frequencies(metrics: DataFrame, snp: str) -> DataFrame:
    """Counts and shares of the genotypes of one SNP within each phenotype."""
    n = metrics.where(F.col("snpID") == snp).groupBy("phenotype", "GT").agg(F.count(F.lit(1)).alias("count"))
    return n.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy("phenotype")))


def model_metrics(confusion: DataFrame) -> DataFrame:
    """Balanced accuracy with its margin, mean precision and mean F1 of a confusion table (actual, predicted, n)."""
    hit = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    recall = confusion.groupBy(F.col("actual").alias("label")).agg((hit / F.sum("n")).alias("recall"), F.sum("n").alias("of"))
    precision = confusion.groupBy(F.col("predicted").alias("label")).agg((hit / F.sum("n")).alias("precision"))
    per = recall.join(precision, "label")
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
    one = per.agg(F.avg("recall").alias("ba"), F.avg("precision").alias("p"), F.avg(f1).alias("f1"), F.sum("of").alias("total"))
    return one.select(F.round("ba", 6).alias("balanced_accuracy"), F.round(1.96 * F.sqrt(F.col("ba") * (1 - F.col("ba")) / F.col("total")), 6).alias("margin"), F.round("p", 6).alias("mean_precision"), F.round("f1", 6).alias("mean_f1"))


def confusion_percent(confusion: DataFrame) -> DataFrame:
    return confusion.select("actual", "predicted", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy("actual")), 1).alias("pct"))


def study_sum(cohort: DataFrame, column: str, studies: list[str] | None = None) -> DataFrame:
    rows = cohort.where(F.col("study_code").isin(studies)) if studies else cohort
    return rows.groupBy("study_code").agg(F.sum(column).alias("total")).orderBy(F.desc("total"), "study_code")


def typed_cohort(rows: DataFrame, today: Column | None = None) -> DataFrame:
    """Cohort rows with defaults for nulls: empty text, 0, false, and a date (today unless given)."""
    out = []
    for name, kind in rows.dtypes:
        empty = {"string": F.lit(""), "boolean": F.lit(False), "date": today if today is not None else F.current_date()}.get(kind, F.lit(0))
        out.append(F.coalesce(F.col(name), empty).cast(kind).alias(name))
    return rows.select(*out)
