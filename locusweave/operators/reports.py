"""Carrier rows, clinical measures by gene and ancestry, and the per-sample variant report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusweave.functions import sites as s
from locusweave.operators import alleles


def baseline(visits: DataFrame) -> DataFrame:
    """Visits of month 0."""
    return visits.where("visit_month = 0").drop("visit_month")


def carriers(genotype: DataFrame, snp_list: DataFrame, samples: DataFrame, visits: DataFrame | None = None, matches: DataFrame | None = None) -> DataFrame:
    """Rows with dosage > 0, with gene, sample labels, ancestry and, if given, baseline measures.

    Carriers are filtered first, as they are rare; the list and the sample key are joined to what is left. With the ``matches`` of the rows' variants and list rows the list is joined by variant: rows that
    are dealt so stay where they are.
    """
    listed = snp_list.select("snp_list_id", "gene", "moi", *(c for c in METADATA if c in snp_list.columns))
    rows = genotype.where(alleles.is_carrier())
    out = (rows.join(listed, "snp_list_id", "left") if matches is None else _named(rows, listed, matches)).join(samples, "sample_id", "left")
    out = out.withColumn("ancestry", s.ancestry("data_type", "nba_label", "wgs_label"))
    return out if visits is None else out.join(baseline(visits).drop("phenotype"), "sample_id", "left")


def _named(rows: DataFrame, listed: DataFrame, matches: DataFrame) -> DataFrame:
    """``rows`` with the columns of their list rows, of which a variant has a handful."""
    more = [c for c in listed.columns if c != "snp_list_id"]
    of = matches.select("variant_id", "snp_list_id").distinct().join(listed, "snp_list_id").groupBy("variant_id").agg(F.collect_list(F.struct("snp_list_id", *more)).alias("__listed"))
    found = rows.join(of, "variant_id", "left").withColumn("__mine", F.explode_outer(F.filter("__listed", lambda x: x["snp_list_id"] == F.col("snp_list_id"))))
    return found.select(*rows.columns, *(F.col(f"__mine.{c}").alias(c) for c in more))


def _measures(strict: bool = True) -> list[Column]:
    hy, moca, dat = F.col("hoehn_and_yahr_stage"), F.col("moca_total_score"), F.col("dat_sbr_caudate_mean")
    duration = F.col("age_at_sample_collection") - F.col("age_of_onset")
    valid = duration >= 0
    return [
        F.count(F.lit(1)).alias("total_carriers"),
        F.sum(F.coalesce("extended_clinical_data", F.lit(0))).cast("long").alias("carriers_with_clinical_data"),
        F.count(hy).alias("hy_available"),
        s.count_if(hy < 2).alias("hy_less_than_2"),
        s.count_if(hy < 3).alias("hy_less_than_3"),
        F.count(moca).alias("moca_available"),
        s.count_if(moca >= 20).alias("moca_gte_20"),
        s.count_if(moca >= 24).alias("moca_gte_24"),
        F.count(dat).alias("dat_caudate_available"),
        *(s.count_if(valid & (duration <= y)).alias(f"disease_duration_lte_{y}_years") for y in (3, 5, 7)),
    ]


#: What decides between several rows of a sample.
ROW_ORDER = ["data_type", "variant_id", "snp_list_id"]


#: What the measures read of a row.
MEASURED = ["extended_clinical_data", "hoehn_and_yahr_stage", "moca_total_score", "dat_sbr_caudate_mean", "age_at_sample_collection", "age_of_onset"]


def _once(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each sample in a group the first row by ROW_ORDER, as ``row``; combined in the map tasks. ``rows`` may have such rows or plain ones."""
    row = F.col("row") if "row" in rows.columns else F.struct(F.struct(*ROW_ORDER).alias("order"), *MEASURED)
    order = F.col("row.order") if "row" in rows.columns else F.struct(*ROW_ORDER)
    return rows.groupBy(*keys, "sample_id").agg(F.min_by(row, order).alias("row"))


def locus_metrics(carrier_rows: DataFrame, total: bool = False) -> DataFrame:
    """Measures by gene and ancestry over different samples; with ``total`` by gene over all ancestries, null ones included.

    The total isn't the sum of the ancestries: a sample counts once in it.
    """
    keys = ["gene"] if total else ["gene", "ancestry"]
    return _measured(_once(carrier_rows.dropna(subset=keys), keys), total)


def _measured(once: DataFrame, total: bool) -> DataFrame:
    out = once.select(*(c for c in once.columns if c != "row"), "row.*").groupBy("gene" if total else ["gene", "ancestry"]).agg(*_measures())
    return out.withColumn("ancestry", F.lit("TOTAL")) if total else out


def locus_report(carrier_rows: DataFrame) -> DataFrame:
    """By ancestry and in total. The rows are reduced to one for each gene, ancestry and sample once, and the total is made from these in the same pass: rows that are dealt by sample stay where they are."""
    once = _once(carrier_rows.dropna(subset=["gene"]), ["gene", "ancestry"])
    both = once.groupBy("gene", "sample_id").agg(F.collect_list(F.struct("ancestry", F.lit(False).alias("total"), "row")).alias("own"), F.min_by("row", "row.order").alias("first"))
    own = F.filter("own", lambda x: x["ancestry"].isNotNull())
    levels = both.select("gene", F.explode(F.concat(own, F.array(F.struct(F.lit("TOTAL").alias("ancestry"), F.lit(True).alias("total"), F.col("first").alias("row"))))).alias("level"))
    return levels.select("gene", "level.ancestry", "level.total", "level.row.*").groupBy("gene", "ancestry", "total").agg(*_measures()).drop("total")


def locus_grouping_sets(carrier_rows: DataFrame) -> DataFrame:
    """Different carriers by gene and ancestry, and by gene, in one pass; ``is_total`` tells the total from a null ancestry."""
    return (
        carrier_rows.groupingSets([["gene", "ancestry"], ["gene"]], "gene", "ancestry")
        .agg(F.countDistinct("sample_id").alias("carriers"), F.grouping_id().cast("int").alias("is_total"))
    )


def locus_variants(carrier_rows: DataFrame) -> DataFrame:
    return carrier_rows.groupBy("gene").agg(F.countDistinct("variant_id").alias("n_variants"), F.array_join(F.array_sort(F.collect_set("variant_id")), ",").alias("variant_ids"))


def locus_summary(carrier_rows: DataFrame) -> DataFrame:
    with_clinical = F.when(F.col("extended_clinical_data") == 1, F.col("sample_id"))
    return carrier_rows.agg(
        F.countDistinct("gene").alias("total_loci"),
        F.countDistinct("sample_id").alias("total_carriers"),
        F.countDistinct(with_clinical).alias("total_with_clinical"),
        F.countDistinct("variant_id").alias("total_variants"),
        F.countDistinct("ancestry").alias("ancestries"),
    )


def locus_flatten(metrics: DataFrame) -> DataFrame:
    """Percentages of the carriers beside the counts."""
    n = F.col("total_carriers")
    pct = lambda c: F.round(100 * s.ratio(F.col(c), n), 6).alias(f"{c}_pct")
    return metrics.select("gene", "ancestry", "total_carriers", *(pct(c) for c in ("carriers_with_clinical_data", "hy_available", "moca_available", "dat_caudate_available")))


def as_percent(column: str) -> Column:
    """Text of a percentage, for sinks."""
    return F.format_string("%.1f%%", column)


def top_loci(metrics: DataFrame, n: int = 10) -> DataFrame:
    return metrics.groupBy("gene").agg(F.sum("total_carriers").alias("carriers")).orderBy(F.desc("carriers"), "gene").limit(n)


def data_type_label(carrier_rows: DataFrame) -> DataFrame:
    """Sources of each sample and list row, joined in order. A sample has a handful of rows there, a probe and source each."""
    kinds = F.collect_set("data_type").over(Window.partitionBy("sample_id", "snp_list_id"))
    return carrier_rows.withColumn("data_types", F.array_join(F.array_sort(kinds), ", "))


def by_list_row(carrier_rows: DataFrame, wgs_samples: DataFrame) -> DataFrame:
    """One row per sample and list row, in one aggregate: what a report has of the first of its rows (NBA before WGS), its sources, and whether the sample has WGS data (``in_wgs``)."""
    keys = ["sample_id", "snp_list_id"]
    row = F.struct(*(c for c in carrier_rows.columns if c in REPORTED or c in METADATA))
    kind = lambda name: F.bool_or(F.col("data_type") == name)
    out = carrier_rows.groupBy(*keys).agg(F.min_by(row, F.struct("data_type", "variant_id")).alias("row"), F.array_join(F.array_sort(F.collect_set("data_type")), ", ").alias("data_types"), kind("WGS").alias("has_wgs"), kind("NBA").alias("has_nba"))
    return out.select(*keys, "row.*", "data_types", "has_wgs", "has_nba").join(wgs_samples.select("sample_id").distinct().withColumn("in_wgs", F.lit(True)), "sample_id", "left")


def variant_report(carrier_rows: DataFrame, wgs_samples: DataFrame) -> DataFrame:
    """One row per sample and list row, NBA before WGS, with zygosity, biallelic flag, WGS validation and concordance, and what metadata the rows have.

    ``wgs_samples`` holds the sample_id of everyone with WGS data, carrier or not. The report reads its rows three times; ``report_of`` takes them stored.
    """
    return report_of(by_list_row(carrier_rows, wgs_samples))


def report_of(once: DataFrame, snp_list: DataFrame | None = None) -> DataFrame:
    """The report from ``by_list_row``'s rows. With ``snp_list`` the metadata come from there, where the rows of a list row lie together already, and the rows needn't carry them."""
    applies = F.col("in_wgs").isNotNull() & (F.col("data_types") != "WGS")
    report = once.withColumn("zygosity", s.zygosity("dosage")).withColumn("validated_by_wgs", F.when(applies, F.col("has_wgs") & F.col("has_nba")))
    # rows are dealt by list row next: what isn't reported stays behind, and of the dosage its text is made there
    report = biallelic(report).withColumn("nba_probe_name", F.when(F.col("data_type") == "NBA", F.col("variant_id")).otherwise(""))
    more = [c for c in METADATA if c in (once if snp_list is None else snp_list).columns]
    report = report.drop("data_type", "variant_id", "zygosity", *(METADATA if snp_list is not None else ())).join(_concordance(once), "snp_list_id", "left")
    if snp_list is not None:
        report = report.join(snp_list.select("snp_list_id", *more).dropDuplicates(["snp_list_id"]), "snp_list_id", "left")
    return report.select("sample_id", "ancestry", "gene", "snp_list_id", "nba_probe_name", s.zygosity("dosage").alias("zygosity"), "moi", F.col("data_types").alias("data_type"), "potential_biallelic", "validated_by_wgs", "wgs_carrier_concordance", *more)


#: Columns of a carrier row that a report reads, beside its keys.
REPORTED = ["data_type", "variant_id", "dosage", "ancestry", "gene", "moi"]
#: Columns of the variant list that a report carries on where the list has them.
METADATA = ["hg38", "aa_change", "rsid", "pathogenicity", "pathogenicity_source", "variant_interpretation"]


def _concordance(once: DataFrame) -> DataFrame:
    both = F.when(F.col("has_wgs"), 1).otherwise(0)
    return once.where("has_nba AND in_wgs").groupBy("snp_list_id").agg((F.sum(both) / F.count(F.lit(1))).alias("wgs_carrier_concordance"))


def biallelic(report: DataFrame) -> DataFrame:
    """Recessive and homozygous, or one of two or more heterozygous recessive rows of a sample in a gene."""
    recessive = F.coalesce(F.col("moi").contains("AR"), F.lit(False))
    het = recessive & (F.col("zygosity") == "het")
    # the genes of the few samples with two such rows, joined back by sample: rows that are dealt so stay where they are
    twice = report.where(het & F.col("gene").isNotNull()).groupBy("sample_id", "gene").agg(F.count(F.lit(1)).alias("__n")).where("__n >= 2")
    genes = twice.groupBy("sample_id").agg(F.collect_list("gene").alias("__genes"))
    again = F.coalesce(F.array_contains("__genes", F.col("gene")), F.lit(False))
    return report.join(genes, "sample_id", "left").withColumn("potential_biallelic", (recessive & (F.col("zygosity") == "hom")) | (het & again)).drop("__genes")


def wgs_concordance(carrier_rows: DataFrame, wgs_samples: DataFrame) -> DataFrame:
    """By list row, the share of NBA carriers with WGS data who are WGS carriers."""
    return _concordance(by_list_row(carrier_rows, wgs_samples))


def carrier_filter(strings: DataFrame, samples: DataFrame, variants: DataFrame, ancestry: str = "All", zygosity: str = "All") -> DataFrame:
    """Genotypes at all selected variants of the samples that carry any of them, of an ancestry and with a zygosity (``All``, ``Homozygous``, ``Heterozygous``).

    ``strings``: sample_id, variant_id, genotype (text). A sample that carries one variant in the wanted way is shown with its calls at the others too.
    """
    label = samples if ancestry == "All" else samples.where(F.col("ancestry") == ancestry)
    rows = strings.join(variants.select("variant_id").distinct(), "variant_id", "left_semi").join(label.select("sample_id", "ancestry", "study"), "sample_id")
    allele = F.split("genotype", "/")
    hom = (F.get(allele, F.lit(0)) == F.get(allele, F.lit(1))) & (F.get(allele, F.lit(0)) != ".")
    wanted = ~F.col("genotype").isin("WT/WT", "./.") & {"All": F.lit(True), "Homozygous": hom, "Heterozygous": ~hom}[zygosity]
    return rows.join(rows.where(wanted).select("sample_id").distinct(), "sample_id", "left_semi")


def report_sort(report: DataFrame) -> DataFrame:
    return report.orderBy(F.asc_nulls_last("ancestry"), F.asc_nulls_last("gene"), F.asc_nulls_last("sample_id"))
