"""Queries over variant lists, genotypes, carriers and probes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusweave.functions import sites as s
from locusweave.operators import alleles, coverage, frequencies, probes, reports
from locusweave.plans import carriers
from locusweave.plans.registry import query
from locusweave.sources import bucketed
from locusweave.sources.fixtures import Fixtures
from locusweave.sources.shared import new_folder, stored


def matches(fx: Fixtures) -> DataFrame:
    return alleles.harmonize(fx.pvar, fx.snp_list)


def dosages(fx: Fixtures) -> DataFrame:
    return alleles.harmonize_dosage(alleles.with_source(fx.gt, fx.sample), matches(fx))


def corrected(fx: Fixtures) -> DataFrame:
    """By file, so by source and ancestry."""
    return carriers.corrected_genotypes(fx.calls, fx.pvar, fx.snp_list)


def carrier_rows(fx: Fixtures, clinical: bool = False) -> DataFrame:
    return reports.carriers(corrected(fx), fx.snp_list, fx.sample, fx.visit if clinical else None)


def kept_calls(fx: Fixtures) -> DataFrame:
    """The calls in buckets of variants, for the correction and for the samples with WGS data."""
    return bucketed.keep(fx.calls, new_folder(fx.spark, "calls"), "variant_id")


def report_rows(fx: Fixtures) -> DataFrame:
    """``by_list_row`` of all carriers, stored, as a report reads it more than once. Metadata are left to the report."""
    calls = kept_calls(fx)
    listed = fx.snp_list.drop(*reports.METADATA)
    rows = reports.carriers(carriers.corrected_genotypes(calls, fx.pvar, fx.snp_list), listed, fx.sample.hint("merge"), None, matches(fx))
    return bucketed.keep(reports.by_list_row(rows, calls.where("data_type = 'WGS'")), new_folder(fx.spark, "list-rows"), "sample_id")


def screened(fx: Fixtures, **options) -> carriers.Screening:
    return carriers.screen(fx.calls, fx.pvar, fx.snp_list, fx.sample, fx.visit, **options)


def wgs_samples(fx: Fixtures) -> DataFrame:
    return fx.gt.where("data_type = 'WGS'").select("sample_id").distinct()


# sites and keys

@query("normalize_site", "SELECT variant_id, chromosome, position, ref, alt FROM fx_pvar WHERE position % 7 <> 0")
def normalize_site(fx):
    messy = fx.pvar.select("variant_id", F.concat(F.lit(" chr"), "chromosome", F.lit(" ")).alias("chromosome"), F.when(F.col("position") % 7 == 0, "n/a").otherwise(F.col("position").cast("string")).alias("position"), F.lower("ref").alias("ref"), F.concat(F.lit(" "), "alt").alias("alt"))
    return alleles.normalize_sites(messy)


@query("valid_variants", "SELECT snp_list_id, chromosome, position, ref, alt FROM (SELECT snp_list_id, CASE WHEN position % 5 = 0 THEN 'UN' ELSE chromosome END AS chromosome, position, CASE WHEN position % 3 = 0 THEN '<DEL>' ELSE ref END AS ref, alt FROM fx_snp_list) t WHERE chromosome <> 'UN' AND ref <> '<DEL>'")
def valid_variants(fx):
    rows = fx.snp_list.select("snp_list_id", F.when(F.col("position") % 5 == 0, "UN").otherwise(F.col("chromosome")).alias("chromosome"), "position", F.when(F.col("position") % 3 == 0, "<DEL>").otherwise(F.col("ref")).alias("ref"), "alt")
    return alleles.valid_variants(rows)


@query("normalize_chr_prefix", "SELECT variant_id, 'chr' || chromosome AS chromosome FROM fx_pvar")
def normalize_chr_prefix(fx):
    return fx.pvar.select("variant_id", s.prefixed_chromosome(F.when(F.col("position") % 2 == 0, F.concat(F.lit("chr"), "chromosome")).otherwise(F.col("chromosome"))).alias("chromosome"))


@query("variant_keys", "SELECT snp_list_id, hg38 AS variant_key, split_part(hg38, ':', 1) || ':' || split_part(hg38, ':', 2) AS pos_key FROM fx_snp_list")
def variant_keys(fx):
    return coverage.variant_keys(fx.snp_list).select("snp_list_id", "variant_key", "pos_key")


_RAW_IDS = "SELECT CASE n % 3 WHEN 0 THEN '0_' || sample_id WHEN 1 THEN 'A_' || sample_id || '_A_' || sample_id ELSE sample_id || '_x' END AS raw, CASE n % 3 WHEN 1 THEN 'A_' || sample_id WHEN 0 THEN sample_id ELSE sample_id || '_x' END AS sample_id FROM (SELECT sample_id, CAST(substr(sample_id, 2) AS BIGINT) AS n FROM fx_sample) t"


def raw_ids(fx):
    n = F.substring("sample_id", 2, 20).cast("bigint") % 3
    return fx.sample.select(F.when(n == 0, F.concat(F.lit("0_"), "sample_id")).when(n == 1, F.concat(F.lit("A_"), "sample_id", F.lit("_A_"), "sample_id")).otherwise(F.concat("sample_id", F.lit("_x"))).alias("raw"))


@query("normalize_sample_id", _RAW_IDS)
def normalize_sample_id(fx):
    return raw_ids(fx).withColumn("sample_id", s.normalized_sample_id("raw"))


@query("dedup_normalized_samples", "SELECT sample_id AS id, min(raw) AS raw FROM (SELECT sample_id, sample_id AS raw FROM fx_sample UNION ALL SELECT sample_id, '0_' || sample_id FROM fx_sample) t GROUP BY sample_id")
def dedup_normalized_samples(fx):
    raw = fx.sample.select(F.col("sample_id").alias("raw")).unionByName(fx.sample.select(F.concat(F.lit("0_"), "sample_id").alias("raw")))
    return alleles.first_per_key(raw.withColumn("id", s.normalized_sample_id("raw")), ["id"], "raw")


@query("strip_zero_prefix_all", "SELECT raw, replace(raw, '0_', '') AS sample_id FROM (SELECT sample_id || '_0' AS raw FROM fx_sample UNION ALL SELECT '0_' || sample_id || '_A' FROM fx_sample) t")
def strip_zero_prefix_all(fx):
    raw = fx.sample.select(F.concat("sample_id", F.lit("_0")).alias("raw")).unionByName(fx.sample.select(F.concat(F.lit("0_"), "sample_id", F.lit("_A")).alias("raw")))
    return raw.withColumn("sample_id", F.replace("raw", F.lit("0_"), F.lit("")))


@query("chromosome_rank", "SELECT variant_id, CAST(chromosome AS INTEGER) AS rank, position FROM fx_pvar")
def chromosome_rank(fx):
    return fx.pvar.select("variant_id", s.chromosome_rank("chromosome").alias("rank"), "position")


@query("unique_positions", "SELECT variant_id, chromosome, position FROM (SELECT *, count(*) OVER (PARTITION BY chromosome, position) AS n FROM (SELECT variant_id, chromosome, position + CASE WHEN CAST(substr(variant_id, 2) AS BIGINT) % 4 = 1 THEN 1 ELSE 0 END AS position FROM fx_pvar) p) t WHERE n = 1")
def unique_positions(fx):
    """Of the two probes at each site, half are moved, so that they have a position of their own."""
    moved = fx.pvar.withColumn("position", F.expr("position + CASE WHEN CAST(substr(variant_id, 2) AS BIGINT) % 4 = 1 THEN 1 ELSE 0 END"))
    return alleles.unique_positions(moved).select("variant_id", "chromosome", "position")


@query("set_intersection_sites", "SELECT DISTINCT chromosome, position FROM fx_pvar INTERSECT SELECT chromosome, position FROM fx_snp_list")
def set_intersection_sites(fx):
    return fx.pvar.select("chromosome", "position").intersect(fx.snp_list.select("chromosome", "position"))


@query("extract_variants", "SELECT variant_id, sample_id, dosage FROM fx_gt WHERE data_type = 'NBA' AND variant_id IN (SELECT p.variant_id FROM fx_pvar p JOIN fx_snp_list s ON p.chromosome = s.chromosome AND p.position = s.position)")
def extract_variants(fx):
    listed = fx.pvar.join(fx.snp_list, ["chromosome", "position"], "left_semi").select("variant_id")
    return fx.gt.where("data_type = 'NBA'").join(listed, "variant_id", "left_semi").select("variant_id", "sample_id", "dosage")


# matching and dosages

@query("site_join", "SELECT p.variant_id, s.snp_list_id, p.ref, p.alt, s.ref AS list_ref, s.alt AS list_alt FROM fx_pvar p JOIN fx_snp_list s ON p.chromosome = s.chromosome AND p.position = s.position")
def site_join(fx):
    return alleles.site_join(fx.pvar, fx.snp_list).select("variant_id", "snp_list_id", "ref", "alt", "list_ref", "list_alt")


@query("harmonize", "SELECT variant_id, snp_list_id, action, list_ref || list_alt IN ('AT', 'TA', 'CG', 'GC') AS strand_ambiguous FROM cx_match WHERE action IS NOT NULL")
def harmonize(fx):
    return matches(fx).select("variant_id", "snp_list_id", "action", "strand_ambiguous")


_WAYS = """WITH w AS (SELECT snp_list_id, chromosome, position, unnest([{'rank': 0, 'match': 'exact', 'r': ref, 'a': alt}, {'rank': 1, 'match': 'swap', 'r': alt, 'a': ref},
 {'rank': 2, 'match': 'flip', 'r': fr, 'a': fa}, {'rank': 3, 'match': 'flip_swap', 'r': fa, 'a': fr}], recursive := true) FROM (SELECT *, CASE WHEN length(ref) = 1 THEN translate(ref, 'ACGT', 'TGCA') ELSE ref END AS fr,
 CASE WHEN length(alt) = 1 THEN translate(alt, 'ACGT', 'TGCA') ELSE alt END AS fa FROM fx_snp_list) t),
b AS (SELECT *, row_number() OVER (PARTITION BY chromosome, position, r, a ORDER BY snp_list_id DESC, rank DESC) AS n FROM w)
SELECT p.variant_id, b.snp_list_id, b.match FROM fx_pvar p JOIN b ON b.n = 1 AND p.chromosome = b.chromosome AND p.position = b.position AND p.ref = b.r AND p.alt = b.a"""


@query("harmonize_by_key", _WAYS)
def harmonize_by_key(fx):
    return alleles.harmonize_by_key(fx.pvar, fx.snp_list).select("variant_id", "snp_list_id", "match")


@query("harmonization_stats", "SELECT action, count(*) AS n, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM cx_match) AS share FROM cx_match WHERE action IS NOT NULL GROUP BY action")
def harmonization_stats(fx):
    joined = alleles.site_join(fx.pvar, fx.snp_list).withColumn("action", alleles.action())
    total = joined.agg(F.count(F.lit(1)).cast("double")).scalar()
    return joined.where("action IS NOT NULL").groupBy("action").agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / total)


@query("match_info_reference", "SELECT m.variant_id, m.snp_list_id, m.action, r.ref AS r_ref FROM cx_match m JOIN fx_pvar r ON m.variant_id = r.variant_id WHERE m.action IS NOT NULL")
def match_info_reference(fx):
    return matches(fx).join(fx.pvar.select("variant_id", F.col("ref").alias("r_ref")), "variant_id").select("variant_id", "snp_list_id", "action", "r_ref")


@query("dosage_transform", "SELECT data_type, variant_id, sample_id, CASE WHEN data_type = 'NBA' THEN 2 - dosage ELSE dosage END AS dosage FROM fx_gt")
def dosage_transform(fx):
    return fx.gt.withColumn("dosage", alleles.dosage_transform("dosage", F.when(F.col("data_type") == "NBA", "2-x").otherwise("x")))


@query("harmonize_dosage", "SELECT data_type, variant_id, snp_list_id, sample_id, dosage, counted_allele, alt_allele FROM cx_dos")
def harmonize_dosage(fx):
    return dosages(fx).select("data_type", "variant_id", "snp_list_id", "sample_id", "dosage", "counted_allele", "alt_allele")


@query("maf_correction", "SELECT data_type, source, variant_id, snp_list_id, sample_id, dosage, counted_allele, alt_allele, round(original_alt_af, 9) AS original_alt_af, maf_corrected FROM cx_maf")
def maf_correction(fx):
    return corrected(fx).select("data_type", "source", "variant_id", "snp_list_id", "sample_id", "dosage", "counted_allele", "alt_allele", F.round("original_alt_af", 9).alias("original_alt_af"), "maf_corrected")


_SIX = "variant_id, snp_list_id, chromosome, position, counted_allele, alt_allele"


@query("ancestry_merge", f"""SELECT data_type, {_SIX}, sample_id, arg_min(dosage, source) FILTER (WHERE dosage IS NOT NULL) AS dosage, min(action) AS action
FROM cx_maf GROUP BY data_type, {_SIX}, sample_id""")
def ancestry_merge(fx):
    """The ancestries of a data type as one table: rows with equal keys are one, with the first value that isn't null."""
    return alleles.merge_sources(corrected(fx), "source", ["data_type", *alleles.KEYS], "action")


@query("exomes_concat_dedup", f"SELECT {_SIX}, sample_id, data_type, dosage FROM (SELECT *, row_number() OVER (PARTITION BY {_SIX}, sample_id ORDER BY data_type) AS n FROM cx_maf) t WHERE n = 1")
def exomes_concat_dedup(fx):
    keys = [*alleles.KEYS, "sample_id"]
    return alleles.first_per_key(corrected(fx), keys, "data_type").select(*keys, "data_type", "dosage")


@query("union_sources", "SELECT data_type, variant_id, sample_id, dosage, NULL::VARCHAR AS note FROM fx_gt WHERE data_type = 'NBA' UNION ALL SELECT data_type, variant_id, sample_id, dosage, 'seq' FROM fx_gt WHERE data_type = 'WGS'")
def union_sources(fx):
    return fx.gt.where("data_type = 'NBA'").unionByName(fx.gt.where("data_type = 'WGS'").withColumn("note", F.lit("seq")), allowMissingColumns=True)


@query("shared_samples", "SELECT sample_id FROM fx_gt WHERE data_type = 'NBA' INTERSECT SELECT sample_id FROM fx_gt WHERE data_type = 'WGS'")
def shared_samples(fx):
    return fx.gt.where("data_type = 'NBA'").select("sample_id").intersect(wgs_samples(fx))


@query("common_samples_merge", "SELECT variant_id, sample_id, dosage FROM fx_gt WHERE data_type = 'NBA' AND sample_id IN (SELECT sample_id FROM fx_gt WHERE data_type = 'WGS')")
def common_samples_merge(fx):
    return fx.gt.where("data_type = 'NBA'").join(wgs_samples(fx), "sample_id", "left_semi").select("variant_id", "sample_id", "dosage")


_STRING = "CASE WHEN g.dosage IS NULL THEN './.' WHEN g.dosage = 2 THEN 'WT/WT' WHEN g.dosage = 1 THEN 'WT/' || p.alt WHEN g.dosage = 0 THEN p.alt || '/' || p.alt ELSE ':/:' END"


@query("genotype_to_string", f"SELECT g.data_type, g.variant_id, g.sample_id, {_STRING} AS genotype FROM fx_gt g JOIN fx_pvar p ON g.variant_id = p.variant_id")
def genotype_to_string(fx):
    return alleles.genotype_strings(fx.gt, fx.pvar).select("data_type", "variant_id", "sample_id", "genotype")


@query("verify_genotype_string", "SELECT g.data_type, count(*) AS n, count(*) AS n_ok FROM fx_gt g JOIN fx_pvar p ON g.variant_id = p.variant_id GROUP BY g.data_type")
def verify_genotype_string(fx):
    return alleles.verify_strings(alleles.genotype_strings(fx.gt, fx.pvar)).groupBy("data_type").agg(F.count(F.lit(1)).alias("n"), s.count_if(F.col("ok")).alias("n_ok"))


@query("validate_carriers", "SELECT g.variant_id, g.sample_id FROM fx_gt g JOIN fx_pvar p ON g.variant_id = p.variant_id WHERE g.data_type = 'NBA' AND g.dosage = 1")
def validate_carriers(fx):
    texts = alleles.genotype_strings(fx.gt.where("data_type = 'NBA'"), fx.pvar)
    wrong = texts.withColumn("genotype", F.when(F.col("dosage") == 1, "WT/WT").otherwise(F.col("genotype")))
    return alleles.verify_strings(wrong).where("NOT ok").select("variant_id", "sample_id")


@query("carrier_string_predicates", f"SELECT sample_id, sum(CASE WHEN gt NOT IN ('WT/WT', './.') THEN 1 ELSE 0 END)::BIGINT AS carriers, sum(CASE WHEN split_part(gt, '/', 1) = split_part(gt, '/', 2) AND gt NOT IN ('WT/WT', './.') THEN 1 ELSE 0 END)::BIGINT AS homs FROM (SELECT g.sample_id, {_STRING} AS gt FROM fx_gt g JOIN fx_pvar p ON g.variant_id = p.variant_id) t GROUP BY sample_id")
def carrier_string_predicates(fx):
    g, part = F.col("genotype"), F.split("genotype", "/")
    carrier = ~g.isin("WT/WT", "./.")
    return alleles.genotype_strings(fx.gt, fx.pvar).groupBy("sample_id").agg(s.count_if(carrier).alias("carriers"), s.count_if(carrier & (F.get(part, F.lit(0)) == F.get(part, F.lit(1)))).alias("homs"))


@query("cohort_carriers", f"SELECT DISTINCT t.sample_id FROM (SELECT g.sample_id, {_STRING} AS gt FROM fx_gt g JOIN fx_pvar p ON g.variant_id = p.variant_id) t JOIN fx_sample k ON t.sample_id = k.sample_id WHERE gt NOT IN ('WT/WT', './.') AND k.study = 'BUILDING'")
def cohort_carriers(fx):
    rows = alleles.genotype_strings(fx.gt, fx.pvar).where(~F.col("genotype").isin("WT/WT", "./."))
    return rows.join(fx.sample.where("study = 'BUILDING'"), "sample_id", "left_semi").select("sample_id").distinct()


@query("update_alleles", "SELECT p.variant_id, CASE WHEN m.action IN ('FLIP', 'FLIP_SWAP') AND length(p.ref) = 1 THEN translate(p.ref, 'ACGT', 'TGCA') ELSE p.ref END AS ref, CASE WHEN m.action IN ('FLIP', 'FLIP_SWAP') AND length(p.alt) = 1 THEN translate(p.alt, 'ACGT', 'TGCA') ELSE p.alt END AS alt, m.action FROM fx_pvar p LEFT JOIN (SELECT DISTINCT variant_id, action FROM cx_match WHERE action IS NOT NULL) m ON p.variant_id = m.variant_id")
def update_alleles(fx):
    return alleles.update_alleles(fx.pvar, matches(fx)).select("variant_id", "ref", "alt", "action")


@query("call_class", "SELECT data_type, CASE WHEN d >= 1.5 THEN 'hom' WHEN d >= 0.5 THEN 'het' WHEN d IS NOT NULL THEN 'ref' END AS class, count(*) AS n FROM (SELECT data_type, dosage * 0.75 AS d FROM fx_gt) t GROUP BY 1, 2")
def call_class(fx):
    return fx.gt.select("data_type", s.call_class(F.col("dosage") * 0.75).alias("class")).groupBy("data_type", "class").agg(F.count(F.lit(1)).alias("n"))


@query("carriers_any", "SELECT data_type, variant_id, sample_id, dosage FROM fx_gt WHERE dosage > 0")
def carriers_any(fx):
    return fx.gt.where(alleles.is_carrier())


@query("zygosity_label", "SELECT data_type, variant_id, sample_id, CASE WHEN dosage IS NULL THEN '' WHEN dosage >= 1.5 THEN 'hom' ELSE 'het' END AS zygosity FROM fx_gt WHERE dosage IS NULL OR dosage > 0")
def zygosity_label(fx):
    return fx.gt.where("dosage IS NULL OR dosage > 0").select("data_type", "variant_id", "sample_id", s.zygosity("dosage").alias("zygosity"))


@query("ancestry_by_datatype", "SELECT sample_id, t.data_type, CASE t.data_type WHEN 'WGS' THEN wgs_label WHEN 'EXOMES' THEN coalesce(nba_label, wgs_label, 'Unknown') ELSE nba_label END AS ancestry FROM fx_sample, (VALUES ('NBA'), ('WGS'), ('EXOMES')) t(data_type)")
def ancestry_by_datatype(fx):
    kinds = fx.sample.withColumn("data_type", F.explode(F.array(F.lit("NBA"), F.lit("WGS"), F.lit("EXOMES"))))
    return kinds.select("sample_id", "data_type", s.ancestry("data_type", "nba_label", "wgs_label").alias("ancestry"))


@query("ancestry_lookup", "SELECT c.sample_id, coalesce(k.nba_label, 'Unknown') AS ancestry FROM (SELECT DISTINCT sample_id FROM fx_gt UNION SELECT 'S-none') c LEFT JOIN fx_sample k ON c.sample_id = k.sample_id")
def ancestry_lookup(fx):
    ids = fx.gt.select("sample_id").union(fx.gt.select(F.lit("S-none"))).distinct()
    return ids.join(fx.sample, "sample_id", "left").select("sample_id", F.coalesce("nba_label", F.lit("Unknown")).alias("ancestry"))


@query("probe_type", "SELECT name, CASE WHEN lower(name) LIKE '%seq\\_%' ESCAPE '\\' THEN 'sequencing' WHEN lower(name) LIKE '%ilmn%' THEN 'illumina_array' WHEN lower(name) LIKE '%chr%' AND name LIKE '%:%' THEN 'coordinate_based' WHEN lower(name) LIKE '%nm\\_%' ESCAPE '\\' OR lower(name) LIKE '%hgvs%' THEN 'transcript_based' ELSE 'unknown' END AS probe_type FROM (SELECT CASE position % 5 WHEN 0 THEN 'Seq_' || variant_id WHEN 1 THEN 'ILMN-' || variant_id WHEN 2 THEN 'chr' || chromosome || ':' || CAST(position AS VARCHAR) WHEN 3 THEN 'NM_' || variant_id ELSE variant_id END AS name FROM fx_pvar) t")
def probe_type(fx):
    m = F.col("position") % 5
    name = F.when(m == 0, F.concat(F.lit("Seq_"), "variant_id")).when(m == 1, F.concat(F.lit("ILMN-"), "variant_id")).when(m == 2, F.concat(F.lit("chr"), "chromosome", F.lit(":"), F.col("position").cast("string"))).when(m == 3, F.concat(F.lit("NM_"), "variant_id")).otherwise(F.col("variant_id"))
    return fx.pvar.select(name.alias("name")).withColumn("probe_type", s.probe_type("name"))


# frequencies and quality

_COUNTS = "sum(CASE WHEN dosage >= 0.5 AND dosage < 1.5 THEN 1 ELSE 0 END)::BIGINT AS het_count, sum(CASE WHEN dosage >= 1.5 THEN 1 ELSE 0 END)::BIGINT AS hom_count, sum(CASE WHEN dosage >= 0.5 THEN 1 ELSE 0 END)::BIGINT AS carrier_count"


@query("variant_call_counts", f"SELECT variant_id, {_COUNTS} FROM cx_maf GROUP BY variant_id")
def variant_call_counts(fx):
    return frequencies.call_counts(corrected(fx), "variant_id")


@query("carrier_statistics", "SELECT data_type, count(*) AS total_samples, sum(CASE WHEN dosage >= 0.5 AND dosage < 1.5 THEN 1 ELSE 0 END)::BIGINT AS heterozygous, sum(CASE WHEN dosage >= 1.5 THEN 1 ELSE 0 END)::BIGINT AS homozygous, sum(CASE WHEN dosage IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing, round(sum(dosage) / (2 * count(dosage)), 9) AS allele_frequency FROM fx_gt GROUP BY data_type")
def carrier_statistics(fx):
    return frequencies.carrier_statistics(fx.gt, "data_type").withColumn("allele_frequency", F.round("allele_frequency", 9))


@query("allele_freq", "SELECT data_type, variant_id, round(sum(dosage) / (2 * nullif(count(dosage), 0)), 9) AS alt_freqs, 2 * count(dosage) AS obs_ct FROM fx_gt GROUP BY data_type, variant_id")
def allele_freq(fx):
    return frequencies.allele_freq(fx.gt, "data_type", "variant_id").withColumn("alt_freqs", F.round("alt_freqs", 9))


@query("missing_rate", "SELECT variant_id, round(avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END), 9) AS f_miss FROM fx_gt WHERE data_type = 'NBA' GROUP BY variant_id")
def missing_rate(fx):
    return frequencies.missing_rate(fx.gt.where("data_type = 'NBA'"), "variant_id").withColumn("f_miss", F.round("f_miss", 9))


@query("geno_missing_filter", "SELECT variant_id, sample_id, dosage FROM fx_gt WHERE data_type = 'NBA' AND variant_id IN (SELECT variant_id FROM fx_gt WHERE data_type = 'NBA' GROUP BY variant_id HAVING avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END) <= 0.02)")
def geno_missing_filter(fx):
    return frequencies.geno_filter(fx.gt.where("data_type = 'NBA'"), 0.02).select("variant_id", "sample_id", "dosage")


@query("qc_sample_callrate", "SELECT sample_id, round(avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END), 9) AS f_miss, avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END) <= 0.02 AS passes FROM fx_gt WHERE data_type = 'NBA' GROUP BY sample_id")
def qc_sample_callrate(fx):
    rates = frequencies.missing_rate(fx.gt.where("data_type = 'NBA'"), "sample_id")
    return rates.select("sample_id", F.round("f_miss", 9).alias("f_miss"), (F.col("f_miss") <= 0.02).alias("passes"))


@query("qc_variant_maf", "SELECT variant_id, round(least(avg(dosage) / 2, 1 - avg(dosage) / 2), 9) AS maf FROM fx_gt WHERE data_type = 'NBA' GROUP BY variant_id")
def qc_variant_maf(fx):
    return frequencies.minor_allele_frequency(fx.gt.where("data_type = 'NBA'"), "variant_id").withColumn("maf", F.round("maf", 9))


@query("qc_hwe", """WITH c AS (SELECT g.variant_id, sum(CASE WHEN dosage = 0 THEN 1 ELSE 0 END)::DOUBLE AS n0, sum(CASE WHEN dosage = 1 THEN 1 ELSE 0 END)::DOUBLE AS n1, sum(CASE WHEN dosage = 2 THEN 1 ELSE 0 END)::DOUBLE AS n2
 FROM fx_gt g JOIN fx_sample k ON g.sample_id = k.sample_id WHERE g.data_type = 'WGS' AND k.sex = 'Female' GROUP BY g.variant_id),
p AS (SELECT *, n0 + n1 + n2 AS n, (n1 + 2 * n2) / (2.0 * nullif(n0 + n1 + n2, 0)) AS p FROM c),
x AS (SELECT variant_id, coalesce(CASE WHEN n * (1 - p) * (1 - p) > 0 THEN (n0 - n * (1 - p) * (1 - p)) * (n0 - n * (1 - p) * (1 - p)) / (n * (1 - p) * (1 - p)) ELSE 0 END
 + CASE WHEN n * 2 * p * (1 - p) > 0 THEN (n1 - n * 2 * p * (1 - p)) * (n1 - n * 2 * p * (1 - p)) / (n * 2 * p * (1 - p)) ELSE 0 END + CASE WHEN n * p * p > 0 THEN (n2 - n * p * p) * (n2 - n * p * p) / (n * p * p) ELSE 0 END, 0) AS chi2 FROM p)
SELECT variant_id, round(chi2, 6) AS chi2, chi2 < 15.137 AS passes FROM x""")
def qc_hwe(fx):
    controls = fx.gt.where("data_type = 'WGS'").join(fx.sample.where("sex = 'Female'"), "sample_id", "left_semi")
    return frequencies.hardy_weinberg(controls, "variant_id").select("variant_id", F.round("chi2", 6).alias("chi2"), "passes")


@query("qc_het_f", """WITH g AS (SELECT * FROM fx_gt WHERE data_type = 'NBA'), a AS (SELECT variant_id, avg(dosage) / 2 AS af FROM g GROUP BY variant_id),
h AS (SELECT sample_id, sum(CASE WHEN dosage = 1 THEN 1 ELSE 0 END)::BIGINT AS observed, sum(2 * af * (1 - af)) AS expected FROM g JOIN a ON g.variant_id = a.variant_id WHERE dosage IS NOT NULL GROUP BY sample_id)
SELECT sample_id, observed, round(CASE WHEN expected > 0 THEN 1 - observed / expected END, 6) AS f FROM h""")
def qc_het_f(fx):
    return frequencies.heterozygosity(fx.gt.where("data_type = 'NBA'")).select("sample_id", "observed", F.round("f", 6).alias("f"))


@query("qc_case_control_missing", """WITH t AS (SELECT g.variant_id, sum(CASE WHEN dosage IS NULL AND k.sex = 'Male' THEN 1 ELSE 0 END)::DOUBLE AS a, sum(CASE WHEN dosage IS NOT NULL AND k.sex = 'Male' THEN 1 ELSE 0 END)::DOUBLE AS b,
 sum(CASE WHEN dosage IS NULL AND k.sex = 'Female' THEN 1 ELSE 0 END)::DOUBLE AS x, sum(CASE WHEN dosage IS NOT NULL AND k.sex = 'Female' THEN 1 ELSE 0 END)::DOUBLE AS y FROM fx_gt g JOIN fx_sample k ON g.sample_id = k.sample_id WHERE data_type = 'NBA' GROUP BY g.variant_id)
SELECT variant_id, CAST(a AS BIGINT) AS case_missing, CAST(x AS BIGINT) AS control_missing, round(CASE WHEN (a + b) * (x + y) * (a + x) * (b + y) > 0 THEN (a + b + x + y) * (a * y - b * x) * (a * y - b * x) / ((a + b) * (x + y) * (a + x) * (b + y)) ELSE 0 END, 6) AS chi2 FROM t""")
def qc_case_control_missing(fx):
    status = fx.sample.select("sample_id", (F.col("sex") == "Male").alias("is_case"))
    return frequencies.case_control_missing(fx.gt.where("data_type = 'NBA'"), status).select("variant_id", "case_missing", "control_missing", F.round("chi2", 6).alias("chi2"))


@query("weighted_freq_combine", """WITH st AS (SELECT k.nba_label, g.variant_id, sum(dosage) / (2 * nullif(count(dosage), 0)) AS alt_freqs, 2 * count(dosage) AS obs_ct, avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END) AS f_miss
 FROM fx_gt g JOIN fx_sample k ON g.sample_id = k.sample_id WHERE data_type = 'NBA' GROUP BY k.nba_label, g.variant_id)
SELECT variant_id, sum(obs_ct)::BIGINT AS obs_ct, round(sum(coalesce(alt_freqs, 0) * CASE WHEN alt_freqs IS NOT NULL THEN obs_ct END) / nullif(sum(CASE WHEN alt_freqs IS NOT NULL THEN obs_ct END), 0), 6) AS alt_freqs, round(sum(f_miss * obs_ct) / nullif(sum(obs_ct), 0), 6) AS f_miss FROM st GROUP BY variant_id""")
def weighted_freq_combine(fx):
    rows = fx.gt.where("data_type = 'NBA'").join(fx.sample.select("sample_id", "nba_label"), "sample_id")
    keys = ["nba_label", "variant_id"]
    stats = frequencies.variant_stats(rows, *keys)
    return frequencies.weighted_combine(stats, "variant_id").select("variant_id", "obs_ct", F.round("alt_freqs", 6).alias("alt_freqs"), F.round("f_miss", 6).alias("f_miss"))


@query("var_stats_join", "SELECT p.variant_id, f.obs_ct, round(m.f_miss, 9) AS f_miss FROM fx_pvar p LEFT JOIN (SELECT variant_id, 2 * count(dosage) AS obs_ct FROM fx_gt WHERE data_type = 'WGS' GROUP BY variant_id) f ON p.variant_id = f.variant_id LEFT JOIN (SELECT variant_id, avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END) AS f_miss FROM fx_gt WHERE data_type = 'NBA' GROUP BY variant_id) m ON p.variant_id = m.variant_id")
def var_stats_join(fx):
    f = frequencies.allele_freq(fx.gt.where("data_type = 'WGS'"), "variant_id").select("variant_id", "obs_ct")
    m = frequencies.missing_rate(fx.gt.where("data_type = 'NBA'"), "variant_id")
    return fx.pvar.select("variant_id").join(f, "variant_id", "left").join(m, "variant_id", "left").select("variant_id", "obs_ct", F.round("f_miss", 9).alias("f_miss"))


# carriers and reports

@query("carrier_gene_join", "SELECT g.variant_id, g.sample_id, g.data_type, s.gene FROM cx_maf g LEFT JOIN fx_snp_list s ON g.snp_list_id = s.snp_list_id WHERE g.dosage > 0")
def carrier_gene_join(fx):
    return corrected(fx).where(alleles.is_carrier()).join(fx.snp_list.select("snp_list_id", "gene"), "snp_list_id", "left").select("variant_id", "sample_id", "data_type", "gene")


@query("carrier_key_join", "SELECT variant_id, sample_id, data_type, study, ancestry FROM cx_car")
def carrier_key_join(fx):
    return carrier_rows(fx).select("variant_id", "sample_id", "data_type", "study", "ancestry")


@query("carrier_clinical_join", "SELECT variant_id, sample_id, data_type, moca_total_score, hoehn_and_yahr_stage FROM cx_carv")
def carrier_clinical_join(fx):
    return carrier_rows(fx, True).select("variant_id", "sample_id", "data_type", "moca_total_score", "hoehn_and_yahr_stage")


_MEASURES = """count(*) AS total_carriers, sum(coalesce(extended_clinical_data, 0))::BIGINT AS carriers_with_clinical_data, count(hoehn_and_yahr_stage) AS hy_available,
 count(*) FILTER (WHERE hoehn_and_yahr_stage < 2) AS hy_less_than_2, count(*) FILTER (WHERE hoehn_and_yahr_stage < 3) AS hy_less_than_3, count(moca_total_score) AS moca_available,
 count(*) FILTER (WHERE moca_total_score >= 20) AS moca_gte_20, count(*) FILTER (WHERE moca_total_score >= 24) AS moca_gte_24, count(dat_sbr_caudate_mean) AS dat_caudate_available,
 count(*) FILTER (WHERE d >= 0 AND d <= 3) AS disease_duration_lte_3_years, count(*) FILTER (WHERE d >= 0 AND d <= 5) AS disease_duration_lte_5_years, count(*) FILTER (WHERE d >= 0 AND d <= 7) AS disease_duration_lte_7_years"""


def _metrics_sql(keys: str, rows: str = "cx_carv") -> str:
    some = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return f"""SELECT {keys}, {_MEASURES} FROM (SELECT *, age_at_sample_collection - age_of_onset AS d,
 row_number() OVER (PARTITION BY {keys}, sample_id ORDER BY data_type, variant_id, snp_list_id) AS n FROM {rows} WHERE {some}) t WHERE n = 1 GROUP BY {keys}"""


@query("locus_ancestry_metrics", _metrics_sql("gene, ancestry"))
def locus_ancestry_metrics(fx):
    return reports.locus_metrics(carrier_rows(fx, True))


@query("locus_total_metrics", f"SELECT *, 'TOTAL' AS ancestry FROM ({_metrics_sql('gene')}) m")
def locus_total_metrics(fx):
    return reports.locus_metrics(carrier_rows(fx, True), total=True)


@query("pipeline_locus", f"SELECT * FROM ({_metrics_sql('gene, ancestry')}) a UNION ALL BY NAME SELECT *, 'TOTAL' AS ancestry FROM ({_metrics_sql('gene')}) b")
def pipeline_locus(fx):
    return screened(fx, select_probes=False, report=("locus",)).locus_report


@query("pipeline_comparison", f"WITH sh AS (SELECT c.* FROM cx_carv c WHERE data_type = 'NBA' AND sample_id IN (SELECT sample_id FROM cx_carv WHERE data_type = 'WGS')) SELECT * FROM ({_metrics_sql('gene, ancestry', 'sh')}) a UNION ALL BY NAME SELECT *, 'TOTAL' AS ancestry FROM ({_metrics_sql('gene', 'sh')}) b")
def pipeline_comparison(fx):
    # read for the shared samples and for the measures
    rows = carrier_rows(fx, True).select("gene", "ancestry", "sample_id", *reports.ROW_ORDER, *reports.MEASURED)
    return carriers.comparison(stored(rows, "carriers"), "NBA", "WGS")


@query("locus_grouping_sets", "SELECT gene, ancestry, count(DISTINCT sample_id) AS carriers, CAST(GROUPING(ancestry) AS INTEGER) AS is_total FROM cx_car GROUP BY GROUPING SETS ((gene, ancestry), (gene))")
def locus_grouping_sets(fx):
    return reports.locus_grouping_sets(carrier_rows(fx))


@query("locus_variants", "SELECT gene, count(DISTINCT variant_id) AS n_variants, string_agg(DISTINCT variant_id, ',' ORDER BY variant_id) AS variant_ids FROM cx_car GROUP BY gene")
def locus_variants(fx):
    return reports.locus_variants(carrier_rows(fx))


@query("locus_summary", "SELECT count(DISTINCT gene) AS total_loci, count(DISTINCT sample_id) AS total_carriers, count(DISTINCT CASE WHEN extended_clinical_data = 1 THEN sample_id END) AS total_with_clinical, count(DISTINCT variant_id) AS total_variants, count(DISTINCT ancestry) AS ancestries FROM cx_car")
def locus_summary(fx):
    return reports.locus_summary(carrier_rows(fx))


_PCT = ", ".join(f"round(CASE WHEN total_carriers > 0 THEN 100 * ({c} / total_carriers) ELSE 0 END, 6) AS {c}_pct" for c in ("carriers_with_clinical_data", "hy_available", "moca_available", "dat_caudate_available"))


@query("locus_flatten", f"SELECT gene, ancestry, total_carriers, {_PCT} FROM ({_metrics_sql('gene, ancestry')}) m")
def locus_flatten(fx):
    return reports.locus_flatten(reports.locus_metrics(carrier_rows(fx, True)))


@query("top_loci", f"SELECT gene, sum(total_carriers)::BIGINT AS carriers FROM ({_metrics_sql('gene, ancestry')}) m GROUP BY gene ORDER BY carriers DESC, gene LIMIT 10")
def top_loci(fx):
    return reports.top_loci(reports.locus_metrics(carrier_rows(fx, True)))


@query("data_type_label", "SELECT c.sample_id, c.snp_list_id, c.variant_id, c.data_type, t.data_types FROM cx_car c JOIN (SELECT sample_id, snp_list_id, string_agg(DISTINCT data_type, ', ' ORDER BY data_type) AS data_types FROM cx_car GROUP BY 1, 2) t ON c.sample_id = t.sample_id AND c.snp_list_id = t.snp_list_id")
def data_type_label(fx):
    return reports.data_type_label(corrected(fx).where(alleles.is_carrier())).select("sample_id", "snp_list_id", "variant_id", "data_type", "data_types")


_REPORT = """WITH w AS (SELECT DISTINCT sample_id FROM fx_gt WHERE data_type = 'WGS'),
k AS (SELECT sample_id, snp_list_id, string_agg(DISTINCT data_type, ', ' ORDER BY data_type) AS data_types, bool_or(data_type = 'WGS') AS hw, bool_or(data_type = 'NBA') AS hn FROM cx_car GROUP BY 1, 2),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, snp_list_id ORDER BY data_type, variant_id) AS n, CASE WHEN dosage >= 1.5 THEN 'hom' ELSE 'het' END AS zygosity FROM cx_car) t WHERE n = 1),
b AS (SELECT r.*, k.data_types, CASE WHEN w.sample_id IS NULL OR k.data_types = 'WGS' THEN NULL ELSE hw AND hn END AS validated_by_wgs, count(*) FILTER (WHERE moi LIKE '%AR%' AND zygosity = 'het') OVER (PARTITION BY r.sample_id, gene) AS hets
 FROM r JOIN k ON r.sample_id = k.sample_id AND r.snp_list_id = k.snp_list_id LEFT JOIN w ON r.sample_id = w.sample_id),
c AS (SELECT a.snp_list_id, count(z.sample_id) / count(*) AS wgs_carrier_concordance FROM (SELECT DISTINCT snp_list_id, sample_id FROM cx_car WHERE data_type = 'NBA' AND sample_id IN (SELECT sample_id FROM w)) a
 LEFT JOIN (SELECT DISTINCT snp_list_id, sample_id FROM cx_car WHERE data_type = 'WGS') z ON a.snp_list_id = z.snp_list_id AND a.sample_id = z.sample_id GROUP BY a.snp_list_id)
"""


@query("pipeline_variant_report", _REPORT + "SELECT b.sample_id, ancestry, gene, b.snp_list_id, CASE WHEN data_type = 'NBA' THEN variant_id ELSE '' END AS nba_probe_name, zygosity, moi, data_types AS data_type, coalesce(moi LIKE '%AR%' AND (zygosity = 'hom' OR hets >= 2), false) AS potential_biallelic, validated_by_wgs, round(wgs_carrier_concordance, 9) AS wgs_carrier_concordance, hg38 FROM b LEFT JOIN c ON b.snp_list_id = c.snp_list_id")
def pipeline_variant_report(fx):
    return screened(fx, select_probes=False, report=("variant",)).variant_report.withColumn("wgs_carrier_concordance", F.round("wgs_carrier_concordance", 9))


@query("validated_by_wgs", _REPORT + "SELECT sample_id, snp_list_id, validated_by_wgs FROM b")
def validated_by_wgs(fx):
    return reports.report_of(report_rows(fx)).select("sample_id", "snp_list_id", "validated_by_wgs")


@query("biallelic_flag", _REPORT + "SELECT sample_id, snp_list_id, coalesce(moi LIKE '%AR%' AND (zygosity = 'hom' OR hets >= 2), false) AS potential_biallelic FROM b")
def biallelic_flag(fx):
    return reports.report_of(report_rows(fx)).select("sample_id", "snp_list_id", "potential_biallelic")


@query("wgs_concordance", _REPORT + "SELECT snp_list_id, round(wgs_carrier_concordance, 9) AS wgs_carrier_concordance FROM c")
def wgs_concordance(fx):
    calls = kept_calls(fx)
    rows = carriers.corrected_genotypes(calls, fx.pvar, fx.snp_list).where(alleles.is_carrier())
    return reports.wgs_concordance(rows, calls.where("data_type = 'WGS'")).withColumn("wgs_carrier_concordance", F.round("wgs_carrier_concordance", 9))


@query("report_sort", _REPORT + "SELECT ancestry, gene, sample_id, snp_list_id FROM b ORDER BY ancestry, gene, sample_id")
def report_sort(fx):
    return reports.report_sort(reports.report_of(report_rows(fx))).select("ancestry", "gene", "sample_id", "snp_list_id")


#: Metadata of the list that the stand-in lacks, for Spark and DuckDB.
_META = {
    "aa_change": "concat('p.', ref, CAST(position AS {t}), alt)", "rsid": "concat('rs', CAST(position AS {t}))", "pathogenicity": "CASE position % 3 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Benign' END",
    "pathogenicity_source": "CASE WHEN position % 2 = 0 THEN 'ClinVar' END", "variant_interpretation": "concat(gene, ' ', moi)",
}
_META_SQL = ", ".join(f"{e.format(t='VARCHAR')} AS {c}" for c, e in _META.items())


@query("sink_variant_report", _REPORT + f""", x AS (SELECT snp_list_id, {_META_SQL} FROM fx_snp_list)
SELECT b.sample_id AS "GP2ID", ancestry AS "Ancestry", gene AS "Gene", hg38 AS "Variant_ID", b.snp_list_id AS "Variant_Name", aa_change AS "AA_change", rsid AS "rsID", CASE WHEN data_type = 'NBA' THEN variant_id ELSE '' END AS "NBA_probe_name",
 zygosity AS "Zygosity", moi AS "MOI", data_types AS "Data_type", pathogenicity AS "Pathogenicity", pathogenicity_source AS "Pathogenicity_source", variant_interpretation AS "Variant_interpretation",
 coalesce(moi LIKE '%AR%' AND (zygosity = 'hom' OR hets >= 2), false) AS potential_biallelic, validated_by_wgs, round(wgs_carrier_concordance, 9) AS wgs_carrier_concordance
FROM b LEFT JOIN c ON b.snp_list_id = c.snp_list_id LEFT JOIN x ON b.snp_list_id = x.snp_list_id""")
def sink_variant_report(fx):
    from locusweave.sources import sinks

    listed = fx.snp_list.withColumns({c: F.expr(e.format(t="STRING")) for c, e in _META.items()})
    return sinks.variant_report_columns(reports.report_of(report_rows(fx), listed)).withColumn("wgs_carrier_concordance", F.round("wgs_carrier_concordance", 9))


@query("first_per_key", "SELECT sample_id, snp_list_id, variant_id FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, snp_list_id ORDER BY data_type, variant_id) AS n FROM cx_car) t WHERE n = 1")
def first_per_key(fx):
    return alleles.first_per_key(carrier_rows(fx), ["sample_id", "snp_list_id"], "data_type", "variant_id").select("sample_id", "snp_list_id", "variant_id")


@query("report_annotation_join", "SELECT c.sample_id, c.variant_id, c.data_type, s.hg38, s.moi AS list_moi FROM cx_car c LEFT JOIN fx_snp_list s ON c.snp_list_id = s.snp_list_id")
def report_annotation_join(fx):
    return carrier_rows(fx).drop("hg38").join(fx.snp_list.select("snp_list_id", "hg38", F.col("moi").alias("list_moi")), "snp_list_id", "left").select("sample_id", "variant_id", "data_type", "hg38", "list_moi")


@query("annotate_output", "SELECT m.variant_id, m.snp_list_id, coalesce(CASE WHEN m.position % 3 = 0 THEN NULL ELSE m.gene END, '.') AS gene FROM cx_match m WHERE action IS NOT NULL")
def annotate_output(fx):
    known = fx.snp_list.where("position % 3 <> 0").select("snp_list_id", "gene")
    return matches(fx).drop("gene").join(known, "snp_list_id", "left").select("variant_id", "snp_list_id", F.coalesce("gene", F.lit(".")).alias("gene"))


@query("sink_variant_summary", "SELECT variant_id, snp_list_id, chromosome, position, list_alt AS counted_allele, list_ref AS alt_allele, action, '.' AS rsid FROM cx_match WHERE action IS NOT NULL")
def sink_variant_summary(fx):
    from locusweave.sources import sinks

    rows = matches(fx).select("variant_id", "snp_list_id", "chromosome", "position", F.col("list_alt").alias("counted_allele"), F.col("list_ref").alias("alt_allele"), "action")
    return sinks.variant_summary(rows).select("variant_id", "snp_list_id", "chromosome", "position", "counted_allele", "alt_allele", "action", "rsid")


@query("variants_by_group", "SELECT gene, count(DISTINCT variant_id) AS variants, count(DISTINCT CASE WHEN dosage >= 1.5 THEN sample_id END) AS hom_carriers FROM cx_car GROUP BY gene")
def variants_by_group(fx):
    return carrier_rows(fx).groupBy("gene").agg(F.countDistinct("variant_id").alias("variants"), F.countDistinct(F.when(F.col("dosage") >= s.HOM, F.col("sample_id"))).alias("hom_carriers"))


@query("variant_name_map", "SELECT variant_id, arg_min(snp_list_id, CASE data_type WHEN 'WGS' THEN 0 ELSE 1 END) AS name FROM (SELECT DISTINCT variant_id, snp_list_id, data_type FROM cx_dos) t GROUP BY variant_id")
def variant_name_map(fx):
    rows = dosages(fx).select("variant_id", "snp_list_id", "data_type").distinct()
    rank = F.array_position(F.array(*map(F.lit, ("WGS", "NBA", "IMPUTED", "EXOMES"))), F.col("data_type"))
    return alleles.first_per_key(rows.where("snp_list_id <> ''"), ["variant_id"], rank, "snp_list_id").select("variant_id", F.col("snp_list_id").alias("name"))


# coverage

_COV = """WITH f AS (SELECT s.snp_list_id, s.gene, s.hg38 AS variant_key, EXISTS (SELECT 1 FROM fx_pvar p WHERE 'chr' || p.chromosome || ':' || CAST(p.position AS VARCHAR) || ':' || p.ref || ':' || p.alt = s.hg38) AS exact,
 EXISTS (SELECT 1 FROM fx_pvar p WHERE p.position % 2 = 0 AND p.chromosome = s.chromosome AND p.position = s.position) AS seq FROM fx_snp_list s),
g AS (SELECT gene, count(DISTINCT variant_key) AS n, count(DISTINCT CASE WHEN exact THEN variant_key END) AS e, count(DISTINCT CASE WHEN seq THEN variant_key END) AS q FROM f GROUP BY gene)
"""


def cover(fx):
    return coverage.coverage_by_variant(fx.snp_list, {"array": fx.pvar, "seq": fx.pvar.where("position % 2 = 0")})


@query("coverage_by_variant", _COV + "SELECT snp_list_id, exact AS array_exact, seq AS seq_position FROM f")
def coverage_by_variant(fx):
    return cover(fx).select("snp_list_id", "array_exact", "seq_position")


@query("coverage_exact", _COV + "SELECT snp_list_id FROM f WHERE exact")
def coverage_exact(fx):
    return coverage.variant_keys(fx.snp_list).join(coverage.site_keys(fx.pvar), "variant_key", "left_semi").select("snp_list_id")


@query("coverage_position", _COV + "SELECT snp_list_id FROM f WHERE seq")
def coverage_position(fx):
    return coverage.variant_keys(fx.snp_list).join(coverage.site_keys(fx.pvar.where("position % 2 = 0")), "pos_key", "left_semi").select("snp_list_id")


@query("coverage_by_locus", _COV + "SELECT gene, n AS total_variants, e AS array_exact, round(100 * (e / n), 6) AS array_exact_pct, q AS seq_position FROM g")
def coverage_by_locus(fx):
    return coverage.coverage_by_locus(cover(fx), ["array", "seq"]).select("gene", "total_variants", "array_exact", "array_exact_pct", "seq_position")


@query("coverage_summary", _COV + "SELECT sum(n)::BIGINT AS total_variants, sum(e)::BIGINT AS array_exact, round(100 * (sum(e) / sum(n)), 6) AS array_exact_pct FROM g")
def coverage_summary(fx):
    return coverage.coverage_summary(coverage.coverage_by_locus(cover(fx), ["array", "seq"]), ["array", "seq"]).select("total_variants", "array_exact", "array_exact_pct")


@query("pipeline_coverage", _COV + "SELECT gene, n AS total_variants, e AS array_exact, q AS seq_position FROM g")
def pipeline_coverage(fx):
    return coverage.coverage_by_locus(cover(fx), ["array", "seq"]).select("gene", "total_variants", "array_exact", "seq_position")


@query("coverage_by_source", """WITH t AS (SELECT DISTINCT g.data_type, coalesce(CASE WHEN g.data_type = 'WGS' THEN k.wgs_label ELSE k.nba_label END, 'Unknown') AS source, p.chromosome, p.position, p.ref, p.alt
 FROM fx_gt g JOIN fx_pvar p ON g.variant_id = p.variant_id LEFT JOIN fx_sample k ON g.sample_id = k.sample_id WHERE g.dosage IS NOT NULL),
h AS (SELECT t.data_type, t.source, s.gene, s.hg38, bool_or(t.ref = s.ref AND t.alt = s.alt) AS exact FROM fx_snp_list s JOIN t ON t.chromosome = s.chromosome AND t.position = s.position GROUP BY ALL),
n AS (SELECT gene, count(DISTINCT hg38) AS total_variants FROM fx_snp_list GROUP BY gene)
SELECT data_type, source, h.gene, total_variants, count(*) FILTER (WHERE exact) AS exact, round(100 * (count(*) FILTER (WHERE exact) / total_variants), 6) AS exact_pct, count(*) AS position, round(100 * (count(*) / total_variants), 6) AS position_pct
FROM h JOIN n ON h.gene = n.gene GROUP BY data_type, source, h.gene, total_variants""")
def coverage_by_source(fx):
    """Which list variants each data type and ancestry has calls for."""
    return coverage.coverage_by_source(fx.snp_list, carriers.covered_sites(alleles.with_source(fx.gt, fx.sample), fx.pvar), "data_type", "source")


@query("carrier_filter", f"""WITH st AS (SELECT g.sample_id, g.variant_id, {_STRING} AS genotype FROM fx_gt g JOIN fx_pvar p ON g.variant_id = p.variant_id WHERE g.data_type = 'NBA' AND g.variant_id IN (SELECT variant_id FROM cx_match WHERE moi = 'AR')),
r AS (SELECT st.sample_id, st.variant_id, st.genotype, k.nba_label AS ancestry, k.study FROM st JOIN fx_sample k ON st.sample_id = k.sample_id WHERE k.nba_label = 'ASIA')
SELECT * FROM r WHERE sample_id IN (SELECT sample_id FROM r WHERE genotype NOT IN ('WT/WT', './.') AND split_part(genotype, '/', 1) = split_part(genotype, '/', 2))""")
def carrier_filter(fx):
    """Homozygous carriers of recessive variants in one ancestry, with all their calls at such variants."""
    strings = alleles.genotype_strings(fx.gt.where("data_type = 'NBA'"), fx.pvar).select("sample_id", "variant_id", "genotype")
    recessive = fx.pvar.join(fx.snp_list.where("moi = 'AR'"), ["chromosome", "position"], "left_semi")
    return reports.carrier_filter(strings, fx.sample.withColumn("ancestry", F.col("nba_label")), recessive, "ASIA", "Homozygous")


@query("list_minus_list", "SELECT snp_list_id, hg38 FROM fx_snp_list WHERE position % 2 = 0 AND hg38 NOT IN (SELECT hg38 FROM fx_snp_list WHERE position % 3 = 0) UNION ALL SELECT snp_list_id, hg38 FROM fx_snp_list WHERE position % 3 = 0")
def list_minus_list(fx):
    rows = fx.snp_list.select("snp_list_id", "hg38")
    return coverage.list_minus_list(fx.snp_list.where("position % 2 = 0").select(*rows.columns), fx.snp_list.where("position % 3 = 0").select(*rows.columns))


_LABELS = "SELECT 'GBA (N' || CAST(CAST(floor(k / 3) AS BIGINT) AS VARCHAR) || ')' AS label, 'chr1:' || CAST(CASE WHEN k % 7 = 0 THEN k ELSE CAST(floor(k / 6) AS BIGINT) END AS VARCHAR) AS hg38, k AS rank FROM (SELECT p_partkey AS k FROM part) t"


@query("variant_list_curation", f"""WITH l AS ({_LABELS}), p AS (SELECT regexp_extract(label, '^(\\S+) \\((.*)\\)$', 2) AS name, hg38, rank FROM l),
bad AS (SELECT name FROM p GROUP BY name HAVING count(DISTINCT hg38) > 1), k AS (SELECT hg38, name, min(rank) AS rank FROM p WHERE name NOT IN (SELECT name FROM bad) GROUP BY hg38, name)
SELECT hg38, 'GBA1' AS locus, list(name ORDER BY rank)[1] AS name, list(name ORDER BY rank)[2] AS alternative_name FROM k GROUP BY hg38""")
def variant_list_curation(fx):
    k = F.col("p_partkey")
    name, place = F.floor(k / 3).cast("string"), F.when(k % 7 == 0, k).otherwise(F.floor(k / 6)).cast("string")
    labels = fx.table("part").select(F.concat(F.lit("GBA (N"), name, F.lit(")")).alias("label"), F.concat(F.lit("chr1:"), place).alias("hg38"), k.alias("rank"))
    return coverage.curate(labels)


@query("identical_columns", "SELECT * FROM (VALUES ('ref', false), ('alt', true)) t(column_name, identical)")
def identical_columns(fx):
    left = fx.pvar.select("variant_id", "ref", "alt")
    right = fx.pvar.select("variant_id", F.when(F.col("position") % 2 == 0, "N").otherwise(F.col("ref")).alias("ref"), "alt")
    return coverage.identical_columns(left, right, ["variant_id"])


# probes

_GRID = """WITH nba AS (SELECT * FROM cx_maf WHERE data_type = 'NBA'), wgs AS (SELECT * FROM cx_maf WHERE data_type = 'WGS'),
sh AS (SELECT sample_id FROM nba INTERSECT SELECT sample_id FROM wgs), pr AS (SELECT DISTINCT snp_list_id, variant_id FROM nba),
np AS (SELECT snp_list_id, count(*) AS n_probes FROM pr GROUP BY 1), tr AS (SELECT snp_list_id, min(variant_id) AS wv FROM wgs GROUP BY 1),
gr AS (SELECT pr.snp_list_id, pr.variant_id, np.n_probes, sh.sample_id, CAST(coalesce(a.dosage, 0) AS INTEGER) AS x, CAST(coalesce(b.dosage, 0) AS INTEGER) AS y
 FROM pr JOIN np ON pr.snp_list_id = np.snp_list_id JOIN tr ON pr.snp_list_id = tr.snp_list_id CROSS JOIN sh
 LEFT JOIN nba a ON a.variant_id = pr.variant_id AND a.snp_list_id = pr.snp_list_id AND a.sample_id = sh.sample_id
 LEFT JOIN wgs b ON b.variant_id = tr.wv AND b.snp_list_id = pr.snp_list_id AND b.sample_id = sh.sample_id),
ct AS (SELECT snp_list_id, variant_id, n_probes, count(*) AS samples, count(*) FILTER (WHERE x > 0 AND y > 0) AS tp, count(*) FILTER (WHERE x > 0 AND y = 0) AS fp, count(*) FILTER (WHERE x = 0 AND y > 0) AS fn,
 count(*) FILTER (WHERE x = 0 AND y = 0) AS tn, count(*) FILTER (WHERE x = y) AS same, count(*) FILTER (WHERE x = 1 AND y = 1) AS hh, count(*) FILTER (WHERE y = 1) AS h FROM gr GROUP BY 1, 2, 3),
me AS (SELECT *, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS sensitivity, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS specificity, same / samples AS overall_concordance FROM ct),
di AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snp_list_id ORDER BY sensitivity DESC, specificity DESC, variant_id) AS r FROM me WHERE n_probes > 1) t WHERE r = 1),
co AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snp_list_id ORDER BY overall_concordance DESC, sensitivity DESC, variant_id) AS r FROM me WHERE n_probes > 1) t WHERE r = 1),
ch AS (SELECT di.snp_list_id, di.n_probes, di.variant_id AS d, co.variant_id AS c, CASE WHEN di.sensitivity >= 0.8 AND di.specificity >= 0.95 THEN 0.95 WHEN di.sensitivity >= 0.8 THEN 0.8 ELSE 0.6 END::DOUBLE AS dc,
 CASE WHEN co.overall_concordance >= 0.9 THEN 0.95 WHEN co.overall_concordance >= 0.85 THEN 0.8 ELSE 0.6 END::DOUBLE AS cc, di.sensitivity AS ds, co.sensitivity AS cs, di.specificity AS dp, co.specificity AS cp,
 di.overall_concordance AS dcon, co.overall_concordance AS ccon FROM di JOIN co ON di.snp_list_id = co.snp_list_id)
"""


def probe_metrics_of(fx, rows=None):
    """Metrics over the corrected genotypes, which are written once."""
    return probes.probe_metrics(probes.probe_grid(rows or stored(corrected(fx), "genotypes", "data_type")))


@query("overview_counts", _GRID + "SELECT data_type, count(DISTINCT variant_id) AS variants, count(DISTINCT sample_id) AS samples, count(DISTINCT variant_id) - CASE WHEN data_type = 'NBA' THEN (SELECT coalesce(sum(n_probes - 1), 0) FROM ch) ELSE 0 END::BIGINT AS unique_variants FROM cx_maf GROUP BY data_type")
def overview_counts(fx):
    """By data type; of several probes for one list row only the selected one counts as unique."""
    rows = stored(corrected(fx), "genotypes", "data_type")
    extra = probes.selection_map(probes.consensus(probe_metrics_of(fx, rows))).agg(F.coalesce(F.sum("excluded"), F.lit(0))).scalar()
    n = F.countDistinct("variant_id")
    return rows.groupBy("data_type").agg(n.alias("variants"), F.countDistinct("sample_id").alias("samples")).withColumn("unique_variants", F.col("variants") - F.when(F.col("data_type") == "NBA", extra).otherwise(0))


@query("probe_wgs_join", _GRID + "SELECT snp_list_id, variant_id, count(*) FILTER (WHERE x > 0 OR y > 0) AS carriers FROM gr GROUP BY 1, 2")
def probe_wgs_join(fx):
    grid = probes.probe_grid(stored(corrected(fx), "genotypes", "data_type"))
    return grid.groupBy("snp_list_id", "variant_id").agg(s.count_if((F.col("nba") > 0) | (F.col("wgs") > 0)).alias("carriers"))


@query("diagnostic_metrics", _GRID + "SELECT snp_list_id, variant_id, tp, fp, fn, tn, round(sensitivity, 9) AS sensitivity, round(specificity, 9) AS specificity FROM me")
def diagnostic_metrics(fx):
    return probe_metrics_of(fx).select("snp_list_id", "variant_id", "tp", "fp", "fn", "tn", F.round("sensitivity", 9).alias("sensitivity"), F.round("specificity", 9).alias("specificity"))


@query("concordance_metrics", _GRID + "SELECT snp_list_id, variant_id, samples, same, hh AS nba_1_wgs_1, round(overall_concordance, 9) AS overall_concordance, round(CASE WHEN h > 0 THEN hh / h ELSE 0 END, 9) AS het_concordance, round(0.7 * overall_concordance + 0.3 * sensitivity, 9) AS quality FROM me")
def concordance_metrics(fx):
    same = F.col("nba_0_wgs_0") + F.col("nba_1_wgs_1") + F.col("nba_2_wgs_2")
    return probe_metrics_of(fx).select("snp_list_id", "variant_id", "samples", same.alias("same"), "nba_1_wgs_1", *(F.round(c, 9).alias(c) for c in ("overall_concordance", "het_concordance", "quality")))


@query("probe_rank_diagnostic", _GRID + "SELECT snp_list_id, d AS diagnostic_choice, dc AS diagnostic_confidence FROM ch")
def probe_rank_diagnostic(fx):
    return probes.rank_diagnostic(probe_metrics_of(fx).where("n_probes > 1")).select("snp_list_id", "diagnostic_choice", "diagnostic_confidence")


@query("probe_rank_concordance", _GRID + "SELECT snp_list_id, c AS concordance_choice, cc AS concordance_confidence FROM ch")
def probe_rank_concordance(fx):
    return probes.rank_concordance(probe_metrics_of(fx).where("n_probes > 1")).select("snp_list_id", "concordance_choice", "concordance_confidence")


@query("probe_consensus", _GRID + "SELECT snp_list_id, d = c AS agree, CASE WHEN d = c THEN d END AS recommended_probe, round(CASE WHEN d = c THEN (dc + cc) / 2 END, 6) AS confidence FROM ch")
def probe_consensus(fx):
    return probes.consensus(probe_metrics_of(fx)).select("snp_list_id", "agree", "recommended_probe", F.round("confidence", 6).alias("confidence"))


@query("probe_disagreement_reason", _GRID + f"SELECT snp_list_id, CASE WHEN ds > cs AND dcon < ccon THEN '{probes.REASONS["sensitivity"]}' WHEN dp > cp AND dcon < ccon THEN '{probes.REASONS["specificity"]}' WHEN abs(ds - cs) < 0.05 AND abs(dcon - ccon) < 0.05 THEN '{probes.REASONS["similar"]}' ELSE '{probes.REASONS["mixed"]}' END AS reason FROM ch WHERE d <> c")
def probe_disagreement_reason(fx):
    return probes.disagreement_reason(probes.consensus(probe_metrics_of(fx))).select("snp_list_id", "reason")


@query("probe_selection_map", _GRID + "SELECT snp_list_id, d AS selected_probe, n_probes - 1 AS excluded FROM ch")
def probe_selection_map(fx):
    return probes.selection_map(probes.consensus(probe_metrics_of(fx)))


@query("pipeline_probe", _GRID + "SELECT snp_list_id, d AS selected_probe, c AS concordance_choice, d = c AS agree FROM ch")
def pipeline_probe(fx):
    chosen = probes.consensus(probe_metrics_of(fx))
    return chosen.select("snp_list_id", F.coalesce("recommended_probe", "diagnostic_choice").alias("selected_probe"), "concordance_choice", "agree")


_FILTERED = "NOT (data_type = 'NBA' AND snp_list_id IN (SELECT snp_list_id FROM ch) AND variant_id NOT IN (SELECT d FROM ch))"


@query("probe_filter", _GRID + "SELECT snp_list_id, variant_id, sample_id, dosage FROM cx_maf WHERE data_type = 'NBA' AND " + _FILTERED)
def probe_filter(fx):
    rows = stored(corrected(fx), "genotypes", "data_type")
    chosen = probes.selection_map(probes.consensus(probe_metrics_of(fx, rows)))
    return probes.probe_filter(rows.where("data_type = 'NBA'"), chosen).select("snp_list_id", "variant_id", "sample_id", "dosage")


@query("probe_used_flags", _GRID + "SELECT pr.snp_list_id, pr.variant_id, n_probes = 1 OR pr.variant_id IN (SELECT d FROM ch) AS probe_used FROM pr JOIN np ON pr.snp_list_id = np.snp_list_id")
def probe_used_flags(fx):
    whole = stored(corrected(fx), "genotypes", "data_type")
    rows = whole.where("data_type = 'NBA'").select("snp_list_id", "variant_id").distinct()
    used = probes.probe_filter(rows, probes.selection_map(probes.consensus(probe_metrics_of(fx, whole)))).withColumn("__u", F.lit(True))
    return rows.join(used, ["snp_list_id", "variant_id"], "left").select("snp_list_id", "variant_id", F.coalesce("__u", F.lit(False)).alias("probe_used"))


@query("probe_summary", _GRID + "SELECT count(DISTINCT snp_list_id) AS mutations, count(DISTINCT CASE WHEN n_probes > 1 THEN snp_list_id END) AS multi_probe_mutations, count(*) AS comparisons, max(samples) AS shared_samples FROM me")
def probe_summary(fx):
    return probes.probe_summary(probe_metrics_of(fx))


@query("method_agreement", _GRID + "SELECT count(*) FILTER (WHERE d = c) AS agreements, count(*) FILTER (WHERE d <> c) AS disagreements, round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE d = c) / count(*) ELSE 0 END, 9) AS agreement_rate FROM ch")
def method_agreement(fx):
    return probes.method_agreement(probes.consensus(probe_metrics_of(fx))).withColumn("agreement_rate", F.round("agreement_rate", 9))


@query("pipeline_carriers", _GRID + f", sel AS (SELECT c.* FROM cx_carv c WHERE {_FILTERED}) SELECT * FROM ({_metrics_sql('gene, ancestry', 'sel')}) a UNION ALL BY NAME SELECT *, 'TOTAL' AS ancestry FROM ({_metrics_sql('gene', 'sel')}) b")
def pipeline_carriers(fx):
    return screened(fx, report=("locus",)).locus_report


@query("pipeline_results", _GRID + f", sel AS (SELECT c.* FROM cx_carv c WHERE {_FILTERED})" + """ SELECT 'corrected_genotypes' AS result, count(*) AS n FROM cx_maf UNION ALL SELECT 'carriers', count(*) FROM sel UNION ALL SELECT 'probes', count(*) FROM ch
 UNION ALL SELECT 'locus_report', (SELECT count(DISTINCT (gene, ancestry)) FROM sel WHERE gene IS NOT NULL AND ancestry IS NOT NULL) + (SELECT count(DISTINCT gene) FROM sel WHERE gene IS NOT NULL)
 UNION ALL SELECT 'variant_report', count(DISTINCT (sample_id, snp_list_id)) FROM sel""")
def pipeline_results(fx):
    """The whole screening with all its results, read back as they are stored."""
    found = screened(fx)
    tables = {"corrected_genotypes": found.stages.manifest().where("stage = 'merged'").select("n_rows"), "carriers": found.carriers, "probes": found.probe_selection, "locus_report": found.locus_report, "variant_report": found.variant_report}
    counts = [(df if name == "corrected_genotypes" else df.agg(F.count(F.lit(1)).alias("n_rows"))).select(F.lit(name).alias("result"), F.col("n_rows").alias("n")) for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("pipeline_resume", """SELECT * FROM (VALUES (1, 'corrected', 'computed'), (1, 'merged', 'computed'), (1, 'carriers', 'computed'), (1, 'locus_report', 'computed'), (2, 'corrected', 'read'), (2, 'merged', 'read'), (2, 'probes', 'computed'),
 (2, 'carriers', 'computed'), (2, 'list_rows', 'computed'), (2, 'locus_report', 'computed'), (2, 'variant_report', 'computed'), (2, 'coverage_report', 'computed'), (3, 'corrected', 'read'), (3, 'merged', 'read'), (3, 'probes', 'read'), (3, 'carriers', 'read'), (3, 'list_rows', 'read'), (3, 'locus_report', 'read'),
 (3, 'variant_report', 'read'), (3, 'coverage_report', 'read')) t(run, stage, action), (SELECT count(*) AS n_carriers FROM cx_car) c""")
def pipeline_resume(fx):
    """Three runs in one folder - without probe selection, with it, and again -: what each computed and what it read, beside the carriers of the first."""
    folder = new_folder(fx.spark, "screening")
    first = screened(fx, folder=folder, select_probes=False, report=("locus",))
    runs = [first, screened(fx, folder=folder), screened(fx, folder=folder)]
    rows = [(i + 1, stage, action) for i, r in enumerate(runs) for stage, action in r.stages.ran]
    ran = fx.spark.createDataFrame(rows, "run int, stage string, action string").withColumn("k", F.lit(1))
    return ran.join(first.carriers.agg(F.count(F.lit(1)).alias("n_carriers")).withColumn("k", F.lit(1)), "k").drop("k")
