"""Queries over sample keys, visits, metrics, VCF text, quality tables and bookkeeping."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusweave.functions import sites as s
from locusweave.operators import alleles, bookkeeping, cohort, fingerprints, vcf
from locusweave.plans.registry import query
from locusweave.sources.shared import stored
from locusweave.sources import tables

# scans over the stand-ins' text


@query("scan_psam_ids", "SELECT sample_id AS \"IID\", CASE WHEN related = 1 THEN '0_' || sample_id ELSE study || '_' || sample_id END AS sample_id FROM fx_sample")
def scan_psam_ids(fx):
    psam = fx.sample.select(F.col("study").alias("FID"), F.col("sample_id").alias("IID"), "related")
    return tables.sample_ids(psam.where("related = 0").drop("related")).unionByName(tables.sample_ids(psam.where("related = 1").select("IID")))


@query("scan_psam_map", "SELECT g.variant_id, coalesce(k.sample_id, g.raw) AS sample_id, g.dosage FROM (SELECT variant_id, dosage, CASE WHEN k.sex = 'Male' THEN k.study || '_' || g.sample_id ELSE g.sample_id END AS raw FROM fx_gt g JOIN fx_sample k ON g.sample_id = k.sample_id WHERE data_type = 'NBA') g LEFT JOIN fx_sample k ON g.raw = k.study || '_' || k.sample_id")
def scan_psam_map(fx):
    key = fx.sample.select("sample_id", "study", "sex")
    raw = fx.gt.where("data_type = 'NBA'").join(key, "sample_id").select("variant_id", F.when(F.col("sex") == "Male", F.concat_ws("_", "study", "sample_id")).otherwise(F.col("sample_id")).alias("sample_id"), "dosage")
    return tables.mapped_samples(raw, fx.sample.select(F.col("study").alias("FID"), F.col("sample_id").alias("IID")))


@query("scan_parquet_pruned", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_partkey <= 50 AND l_discount > 0.05")
def scan_parquet_pruned(fx):
    return tables.read_pruned(fx.spark, f"{fx.sf_dir}/lineitem.parquet", (F.col("l_partkey") <= 50) & (F.col("l_discount") > 0.05), ["l_orderkey", "l_quantity"])


def lines(fx):
    header = fx.vcf_line.limit(1).select(F.lit("##fileformat=VCFv4.2").alias("value"))
    return fx.vcf_line.unionByName(header)


_FIELDS = """WITH t AS (SELECT string_split(value, chr(9)) AS p FROM fx_vcf_line), r AS (SELECT replace(p[1], 'chr', '') AS chromosome, CAST(p[2] AS BIGINT) AS position, p[3] AS variant_id, p[4] AS ref, p[5] AS alt, p[6] AS qual, p[7] AS filter, p[8] AS info, string_split(p[10], ':') AS f FROM t)
"""
_GT = "CASE f[1] WHEN '0/0' THEN 0 WHEN '0/1' THEN 1 WHEN '1/0' THEN 1 WHEN '1/1' THEN 2 ELSE -9 END"


@query("scan_vcf_variants", _FIELDS + "SELECT chromosome, position, variant_id, ref, alt, qual, filter, info FROM r")
def scan_vcf_variants(fx):
    return vcf.variant_reference(lines(fx))


@query("vcf_gt_code", _FIELDS + f"SELECT {_GT} AS code, count(*) AS n FROM r GROUP BY 1")
def vcf_gt_code(fx):
    return vcf.sample_metrics(lines(fx)).groupBy(F.col("GT").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query("vcf_format_fields", _FIELDS + "SELECT variant_id, f[1] AS gt, f[2] AS gs, f[3] AS baf, nullif(f[4], '.') AS lrr FROM r")
def vcf_format_fields(fx):
    return vcf.records(lines(fx)).select("variant_id", *(vcf.format_field(k).alias(k.lower()) for k in ("GT", "GS", "BAF", "LRR")))


@query("vcf_info_fields", _FIELDS + "SELECT variant_id, regexp_extract(info, ';GC=([^;]+)', 1) AS gc, regexp_extract(info, 'N_AA=([^;]+)', 1) AS n_aa, regexp_extract(info, 'ASSAY_TYPE=([^;]+)', 1) AS assay_type FROM r")
def vcf_info_fields(fx):
    return vcf.records(lines(fx)).select("variant_id", *(vcf.info_field(k).alias(k.lower()) for k in ("GC", "N_AA", "ASSAY_TYPE")))


@query("vcf_a1_a2", _FIELDS + "SELECT variant_id, CASE WHEN info LIKE '%ALLELE_A=1%' THEN alt ELSE ref END AS a1, CASE WHEN info LIKE '%ALLELE_B=1%' THEN alt ELSE ref END AS a2 FROM r")
def vcf_a1_a2(fx):
    return vcf.allele_columns(lines(fx))


@query("genomic_sort", "SELECT chromosome, position, variant_id FROM fx_pvar ORDER BY CAST(chromosome AS INTEGER), position, variant_id")
def genomic_sort(fx):
    return vcf.genomic_sort(fx.pvar.select("chromosome", "position", "variant_id"))


@query("parse_regions", "SELECT CAST(r_regionkey + 1 AS VARCHAR) AS chromosome, CAST(100000 + 1000 * r_regionkey AS BIGINT) AS start, CAST(120000 + 1000 * r_regionkey AS BIGINT) AS \"end\" FROM region")
def parse_regions(fx):
    return vcf.parse_regions(region_lines(fx))


def region_lines(fx):
    k = F.col("r_regionkey")
    text = F.format_string("chr%d:%d-%d", k + 1, 100000 + 1000 * k, 120000 + 1000 * k)
    return fx.table("region").select(F.explode(F.array(text, F.lit("# note"), F.lit(""))).alias("value"))


@query("region_restrict", "SELECT p.variant_id FROM fx_pvar p WHERE EXISTS (SELECT 1 FROM region r WHERE CAST(r.r_regionkey + 1 AS VARCHAR) = p.chromosome AND p.position BETWEEN 100000 + 1000 * r.r_regionkey AND 120000 + 1000 * r.r_regionkey)")
def region_restrict(fx):
    return vcf.region_restrict(fx.pvar, vcf.parse_regions(region_lines(fx)), 5000).select("variant_id")


# metrics


@query("metrics_gt_distribution", 'SELECT "GT", count(*) AS n, count(DISTINCT "IID") AS samples FROM fx_metrics GROUP BY "GT"')
def metrics_gt_distribution(fx):
    return fx.metrics.groupBy("GT").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("IID").alias("samples"))


@query("metrics_coords", "SELECT chromosome || '_' || CAST(position AS VARCHAR) || '_' || ref || '_' || alt AS coord, min(variant_id) AS variant_id, position FROM fx_pvar GROUP BY chromosome, position, ref, alt")
def metrics_coords(fx):
    keys = ["chromosome", "position", "ref", "alt"]
    return alleles.first_per_key(fx.pvar, keys, "variant_id").select(F.concat_ws("_", "chromosome", F.col("position").cast("string"), "ref", "alt").alias("coord"), "variant_id", "position")


@query("snp_genotype_freq", """SELECT phenotype, "GT", count(*) AS count, round(count(*) / sum(count(*)) OVER (PARTITION BY phenotype), 9) AS share FROM fx_metrics WHERE "snpID" = 'P1' GROUP BY phenotype, "GT" """)
def snp_genotype_freq(fx):
    return cohort.genotype_frequencies(fx.metrics, "P1").withColumn("share", F.round("share", 9))


@query("maf_lookup", "SELECT t.gene, t.variant_id, round(f.af, 9) AS af, round(l.af, 9) AS america_af FROM (SELECT s.gene, min(p.variant_id) AS variant_id FROM fx_pvar p JOIN fx_snp_list s ON p.chromosome = s.chromosome AND p.position = s.position GROUP BY s.gene) t LEFT JOIN (SELECT variant_id, avg(dosage) / 2 AS af FROM fx_gt GROUP BY variant_id) f ON t.variant_id = f.variant_id LEFT JOIN (SELECT g.variant_id, avg(dosage) / 2 AS af FROM fx_gt g JOIN fx_sample k ON g.sample_id = k.sample_id WHERE k.nba_label = 'AMERICA' GROUP BY g.variant_id) l ON t.variant_id = l.variant_id")
def maf_lookup(fx):
    first = alleles.site_join(fx.pvar, fx.snp_list).groupBy("gene").agg(F.min("variant_id").alias("variant_id"))
    af = lambda rows, name: rows.groupBy("variant_id").agg(F.round(F.avg("dosage") / 2, 9).alias(name))
    there = fx.gt.join(fx.sample.where("nba_label = 'AMERICA'").select("sample_id"), "sample_id", "left_semi")
    return first.join(af(fx.gt, "af"), "variant_id", "left").join(af(there, "america_af"), "variant_id", "left").select("gene", "variant_id", "af", "america_af")


# fingerprints

_PRINTS = """WITH g AS (SELECT * FROM fx_gt WHERE data_type = 'WGS'), ok AS (SELECT variant_id FROM g GROUP BY 1 HAVING bool_and(dosage IS NOT NULL)),
k AS (SELECT chromosome, position + CASE WHEN CAST(substr(variant_id, 2) AS BIGINT) % 4 = 1 THEN 1 ELSE 0 END AS position, variant_id, ref, alt FROM fx_pvar WHERE variant_id IN (SELECT variant_id FROM ok)), u AS (SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY chromosome, position) AS n FROM k) t WHERE n = 1),
h AS (SELECT g.sample_id, count(*) AS n_sites, md5(string_agg(CASE WHEN dosage < 0.5 THEN ref || ref WHEN dosage < 1.5 THEN alt || ref ELSE alt || alt END, '' ORDER BY CAST(chromosome AS INTEGER), position, u.variant_id)) AS hash FROM g JOIN u ON g.variant_id = u.variant_id GROUP BY g.sample_id)
"""


def spread(fx):
    """Sites of which half have a position of their own."""
    return fx.pvar.withColumn("position", F.expr("position + CASE WHEN CAST(substr(variant_id, 2) AS BIGINT) % 4 = 1 THEN 1 ELSE 0 END"))


def prints(fx):
    g = fx.gt.where("data_type = 'WGS'")
    return fingerprints.fingerprints(g, fingerprints.perfect_sites(g, spread(fx)))


@query("perfect_callrate_sites", _PRINTS + "SELECT variant_id, chromosome, position FROM u")
def perfect_callrate_sites(fx):
    return fingerprints.perfect_sites(fx.gt.where("data_type = 'WGS'"), spread(fx)).select("variant_id", "chromosome", "position")


@query("fingerprint_md5", _PRINTS + "SELECT sample_id, hash, n_sites FROM h")
def fingerprint_md5(fx):
    return prints(fx)


_COPIES = ", cp AS (SELECT sample_id, hash FROM h UNION ALL SELECT sample_id || '-copy', hash FROM h), dg AS (SELECT hash, count(*) AS n, string_agg(sample_id, ',' ORDER BY sample_id) AS sample_ids FROM cp GROUP BY hash HAVING count(*) > 1)"


def copies(fx):
    """Every sample twice."""
    found = stored(prints(fx), "fingerprints")
    return found.unionByName(found.withColumn("sample_id", F.concat("sample_id", F.lit("-copy"))))


@query("duplicate_groups", _PRINTS + _COPIES + " SELECT hash, n, sample_ids FROM dg")
def duplicate_groups(fx):
    return fingerprints.duplicate_groups(copies(fx))


@query("pipeline_fingerprint", _PRINTS + _COPIES + " SELECT 'member' AS kind, sample_id, hash, (SELECT n FROM dg WHERE dg.hash = cp.hash) AS n, CAST(NULL AS VARCHAR) AS variant_id FROM cp WHERE hash IN (SELECT hash FROM dg) UNION ALL SELECT 'missing', g.sample_id, NULL, NULL, g.variant_id FROM g WHERE dosage IS NULL AND variant_id IN (SELECT variant_id FROM fx_pvar)")
def pipeline_fingerprint(fx):
    """Sites to pairs to hashes to groups, a row a member; and the missing calls at all sites of the list, a row each."""
    groups = fingerprints.members(copies(fx)).select(F.lit("member").alias("kind"), "sample_id", "hash", "n", F.lit(None).cast("string").alias("variant_id"))
    gone = fingerprints.missing_alleles(fx.gt.where("data_type = 'WGS'"), fx.pvar)
    return groups.unionByName(gone.select(F.lit("missing").alias("kind"), "sample_id", F.lit(None).cast("string").alias("hash"), F.lit(None).cast("long").alias("n"), "variant_id"))


@query("allele_pair_string", "SELECT g.data_type, g.variant_id, g.sample_id, CASE WHEN dosage IS NULL THEN 'NN' WHEN dosage < 0.5 THEN p.ref || p.ref WHEN dosage < 1.5 THEN p.alt || p.ref ELSE p.alt || p.alt END AS pair FROM fx_gt g JOIN fx_pvar p ON g.variant_id = p.variant_id")
def allele_pair_string(fx):
    return fx.gt.join(fx.pvar.select("variant_id", "ref", "alt"), "variant_id").select("data_type", "variant_id", "sample_id", s.allele_pair("dosage", "alt", "ref").alias("pair"))


# cohort


@query("unpruned_cohort", "SELECT sample_id, study FROM fx_sample WHERE prune_reason IS NULL")
def unpruned_cohort(fx):
    return cohort.unpruned(fx.sample).select("sample_id", "study")


@query("multi_select_filter", "SELECT sample_id FROM fx_sample WHERE study IN ('BUILDING', 'MACHINERY') AND nba_label IN ('ASIA')")
def multi_select_filter(fx):
    return cohort.multi_select(fx.sample, study=["BUILDING", "MACHINERY"], nba_label=["ASIA"], sex=[]).select("sample_id")


@query("text_search", "SELECT snp_list_id, gene, hg38 FROM fx_snp_list WHERE lower(gene) LIKE '%brand#1%' OR lower(hg38) LIKE '%chr3:%'")
def text_search(fx):
    both = cohort.text_search(fx.snp_list, "Brand#1", "gene", "hg38").unionByName(cohort.text_search(fx.snp_list, "CHR3:", "gene", "hg38"))
    return both.select("snp_list_id", "gene", "hg38").distinct()


@query("locus_filter", "SELECT snp_list_id FROM fx_snp_list WHERE gene = 'Brand#11'")
def locus_filter(fx):
    return cohort.multi_select(fx.snp_list, gene=["Brand#11"]).select("snp_list_id")


@query("qc_sample_subset", "SELECT ancestry, step, pruned_count FROM fx_qc WHERE level = 'sample' AND step <> 'related_prune'")
def qc_sample_subset(fx):
    return fx.qc.where("level = 'sample' AND step <> 'related_prune'").select("ancestry", "step", "pruned_count")


@query("pending_precheck", "SELECT ancestry, step FROM fx_qc WHERE step NOT IN ('callrate_prune', 'sex_prune')")
def pending_precheck(fx):
    return fx.qc.where(~F.col("step").isin("callrate_prune", "sex_prune")).select("ancestry", "step")


@query("clean_master", "SELECT sample_id, study, nba_label AS label, sex, split_part(split_part(prune_reason, '-', 1), ' ', 1) AS prune_reason, CASE WHEN lower(prune_reason) LIKE '%duplicate%' THEN 1 ELSE 0 END AS dup, related, 9 AS release FROM fx_sample")
def clean_master(fx):
    return cohort.clean_master(fx.sample, 9)


@query("code_maps", "SELECT sample_id, CASE code WHEN '1' THEN 'Male' WHEN '2' THEN 'Female' WHEN '0' THEN 'Unknown' ELSE code END AS kept, CASE code WHEN '1' THEN 'Male' WHEN '2' THEN 'Female' WHEN '0' THEN 'Unknown' END AS mapped FROM (SELECT sample_id, CAST(CAST(substr(sample_id, 2) AS BIGINT) % 4 AS VARCHAR) AS code FROM fx_sample) t")
def code_maps(fx):
    code = (F.substring("sample_id", 2, 20).cast("bigint") % 4).cast("string")
    return fx.sample.select("sample_id", cohort.code_map(code, cohort.SEX).alias("kept"), cohort.code_map(code, cohort.SEX, False).alias("mapped"))


@query("clinical_derived", "SELECT v.sample_id, v.visit_month, round(k.age_at_sample_collection + v.visit_month / 12, 6) AS age_at_visit, round(coalesce(k.age_at_sample_collection + v.visit_month / 12 - k.age_of_onset, k.age_at_sample_collection - k.age_of_onset), 6) AS disease_duration FROM fx_visit v JOIN fx_sample k ON v.sample_id = k.sample_id")
def clinical_derived(fx):
    rows = cohort.clinical_derived(fx.visit.join(fx.sample, "sample_id"))
    return rows.select("sample_id", "visit_month", F.round("age_at_visit", 6).alias("age_at_visit"), F.round("disease_duration", 6).alias("disease_duration"))


@query("clinical_subset_join", "SELECT v.sample_id, v.visit_month, v.phenotype, k.study FROM fx_visit v JOIN fx_sample k ON v.sample_id = k.sample_id WHERE k.extended_clinical_data = 1")
def clinical_subset_join(fx):
    return fx.visit.join(fx.sample.where("extended_clinical_data = 1").select("sample_id", "study"), "sample_id").select("sample_id", "visit_month", "phenotype", "study")


_FIRST_VISIT = "fv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY visit_month, moca_total_score, hoehn_and_yahr_stage, dat_sbr_caudate_mean) AS n FROM fx_visit) t WHERE n = 1)"


@query("recruitment_join", f"WITH {_FIRST_VISIT} SELECT c.sample_id, fv.visit_month, fv.phenotype FROM (SELECT DISTINCT sample_id FROM fx_sample) c LEFT JOIN fv ON c.sample_id = fv.sample_id")
def recruitment_join(fx):
    return cohort.recruitment_join(fx.visit, fx.sample.select("sample_id").distinct()).select("sample_id", "visit_month", "phenotype")


_LOCI = "lc AS (SELECT DISTINCT g.sample_id, s.gene AS locus FROM fx_gt g JOIN (SELECT DISTINCT p.variant_id, s.gene FROM fx_pvar p JOIN fx_snp_list s ON p.chromosome = s.chromosome AND p.position = s.position) s ON g.variant_id = s.variant_id WHERE g.data_type = 'WGS' AND g.dosage < 2)"


def loci(fx):
    variants = alleles.site_join(fx.pvar, fx.snp_list).select("variant_id", F.col("gene").alias("locus"))
    return cohort.locus_carriers(fx.gt.where("data_type = 'WGS'"), variants)


@query("locus_carriers", f"WITH {_LOCI} SELECT * FROM lc")
def locus_carriers(fx):
    return loci(fx)


@query("carrier_distribution", f"WITH {_LOCI} SELECT locus, coalesce(k.nba_label, 'Unknown') AS ancestry, count(*) AS count FROM lc LEFT JOIN fx_sample k ON lc.sample_id = k.sample_id GROUP BY 1, 2")
def carrier_distribution(fx):
    return cohort.value_counts(loci(fx).join(fx.sample, "sample_id", "left").withColumnRenamed("nba_label", "ancestry"), "locus", "ancestry", unknown="Unknown")


@query("study_distribution", f"WITH {_LOCI} SELECT locus, k.study, count(*) AS count FROM lc JOIN fx_sample k ON lc.sample_id = k.sample_id GROUP BY 1, 2")
def study_distribution(fx):
    return cohort.value_counts(loci(fx).join(fx.sample, "sample_id"), "locus", "study")


_RSTATS = f"""WITH {_LOCI}, {_FIRST_VISIT}, r AS (SELECT lc.locus, k.nba_label AS ancestry, fv.*, k.age_at_sample_collection AS a, k.age_of_onset AS o,
 coalesce(k.age_at_sample_collection + fv.visit_month / 12 - k.age_of_onset, k.age_at_sample_collection - k.age_of_onset) AS d FROM lc JOIN fx_sample k ON lc.sample_id = k.sample_id LEFT JOIN fv ON lc.sample_id = fv.sample_id)
SELECT locus, ancestry, count(*) AS total, count(*) FILTER (WHERE phenotype = 'PD') AS pd_count, round(avg(a), 4) AS age_mean, round(stddev_samp(a), 4) AS age_std, round(avg(o), 4) AS aao_mean, round(stddev_samp(o), 4) AS aao_std,
 count(hoehn_and_yahr_stage) AS hy_available, count(*) FILTER (WHERE hoehn_and_yahr_stage <= 2) AS hy_le_2, count(*) FILTER (WHERE hoehn_and_yahr_stage <= 3) AS hy_le_3, count(*) FILTER (WHERE hoehn_and_yahr_stage IS NULL) AS hy_missing,
 round(avg(moca_total_score), 4) AS moca_mean, count(moca_total_score) AS moca_available, count(*) FILTER (WHERE moca_total_score >= 20) AS moca_ge_20, count(*) FILTER (WHERE moca_total_score >= 24) AS moca_ge_24,
 round(avg(dat_sbr_caudate_mean), 4) AS dat_mean, count(dat_sbr_caudate_mean) AS dat_available, count(*) FILTER (WHERE dat_sbr_caudate_mean IS NULL) AS dat_missing,
 count(*) FILTER (WHERE d <= 5) AS duration_le_5, count(*) FILTER (WHERE d <= 7) AS duration_le_7, count(*) FILTER (WHERE d IS NULL) AS duration_missing FROM r GROUP BY locus, ancestry"""


def recruitment_rows(fx):
    rows = cohort.recruitment_join(fx.visit, loci(fx)).join(fx.sample, "sample_id").withColumnRenamed("nba_label", "ancestry")
    return cohort.clinical_derived(rows)


@query("recruitment_stats", _RSTATS)
def recruitment_stats(fx):
    return cohort.recruitment_stats(recruitment_rows(fx), "locus", "ancestry")


@query("recruitment_summary", f"WITH {_LOCI}, z AS (SELECT coalesce(study, 'Unknown') AS study, count(*) AS n FROM fx_sample GROUP BY 1) SELECT (SELECT count(DISTINCT locus) FROM lc) AS loci, (SELECT count(DISTINCT sample_id) FROM lc) AS carriers, (SELECT count(*) FROM lc) AS locus_carriers, (SELECT count(*) FROM z) AS cohorts, (SELECT study FROM z ORDER BY n DESC, study DESC LIMIT 1) AS largest_cohort, (SELECT max(n) FROM z) AS largest_size")
def recruitment_summary(fx):
    return cohort.recruitment_summary(loci(fx), fx.sample)


@query("cohort_distribution", "SELECT coalesce(wgs_label, 'Unknown') AS wgs_label, count(*) AS count FROM fx_sample GROUP BY 1")
def cohort_distribution(fx):
    return cohort.value_counts(fx.sample, "wgs_label", unknown="Unknown")


@query("count_desc_sort", "SELECT gene, count(*) AS count FROM fx_snp_list GROUP BY gene ORDER BY count DESC, gene")
def count_desc_sort(fx):
    return cohort.value_counts(fx.snp_list, "gene")


@query("prune_reason_counts", "SELECT prune_reason, count(*) AS count FROM fx_sample GROUP BY 1")
def prune_reason_counts(fx):
    return cohort.value_counts(fx.sample, "prune_reason")


@query("ancestry_proportions", "SELECT nba_label, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM fx_sample GROUP BY 1")
def ancestry_proportions(fx):
    return cohort.shares(fx.sample, "nba_label").withColumn("share", F.round("share", 9))


@query("cohort_counts", "SELECT count(*) AS samples, count(*) FILTER (WHERE prune_reason IS NULL) AS unpruned FROM fx_sample WHERE study = 'BUILDING'")
def cohort_counts(fx):
    return fx.sample.where("study = 'BUILDING'").agg(F.count(F.lit(1)).alias("samples"), s.count_if(F.isnull("prune_reason")).alias("unpruned"))


@query("related_counts", "SELECT ancestry, count(*) FILTER (WHERE \"REL\" = 'first_deg') AS first_degree, count(*) FILTER (WHERE \"REL\" = 'second_deg') AS second_degree FROM (SELECT \"REL\", \"IID1\", min(ancestry) AS ancestry FROM fx_related WHERE \"REL\" <> 'duplicate' GROUP BY 1, 2) t GROUP BY ancestry")
def related_counts(fx):
    return cohort.related_counts(fx.related)


@query("relatedness_merge", "SELECT coalesce(a.ancestry, b.ancestry) AS ancestry, coalesce(a.n, 0) AS first_degree, coalesce(b.n, 0) AS second_degree FROM (SELECT ancestry, count(DISTINCT \"IID1\") AS n FROM fx_related WHERE \"REL\" = 'first_deg' GROUP BY 1) a FULL JOIN (SELECT ancestry, count(DISTINCT \"IID1\") AS n FROM fx_related WHERE \"REL\" = 'second_deg' GROUP BY 1) b ON a.ancestry = b.ancestry")
def relatedness_merge(fx):
    n = lambda kind, name: fx.related.where(F.col("REL") == kind).groupBy("ancestry").agg(F.countDistinct("IID1").alias(name))
    both = n("first_deg", "first_degree").join(n("second_deg", "second_degree"), "ancestry", "full")
    return both.select("ancestry", F.coalesce("first_degree", F.lit(0)).alias("first_degree"), F.coalesce("second_degree", F.lit(0)).alias("second_degree"))


@query("related_dup_per_label", "SELECT nba_label, sum(related)::BIGINT AS related_count, count(*) FILTER (WHERE lower(prune_reason) LIKE '%duplicate%') AS duplicated_count FROM fx_sample GROUP BY 1 HAVING sum(related) > 0")
def related_dup_per_label(fx):
    return cohort.related_dup_per_label(fx.sample)


@query("group_sum_transform", "SELECT sample_id, nba_label, (sum(related) OVER (PARTITION BY nba_label))::BIGINT AS label_related, count(*) OVER (PARTITION BY nba_label) AS label_samples FROM fx_sample")
def group_sum_transform(fx):
    return cohort.group_sums(fx.sample)


@query("symmetric_pairs", 'SELECT "IID1", "IID2", "REL", ancestry FROM fx_related UNION ALL SELECT "IID2", "IID1", "REL", ancestry FROM fx_related')
def symmetric_pairs(fx):
    return cohort.symmetric_pairs(fx.related)


_PRUNED = "SELECT sample_id, CASE CAST(substr(sample_id, 2) AS BIGINT) % 3 WHEN 0 THEN 'callrate' WHEN 1 THEN 'sex' ELSE 'related' END AS step FROM fx_sample"


@query("dup_report", f"""WITH p AS (SELECT sample_id AS i1, CASE WHEN step IN ('callrate', 'sex') THEN step ELSE 'duplicate' END AS pruned_reason FROM ({_PRUNED}) t),
o AS (SELECT p.i1, r."IID2" AS i2, a.sex AS s1, b.sex AS s2, a.study AS t1, b.study AS t2, pruned_reason FROM p JOIN fx_sample a ON p.i1 = a.sample_id JOIN fx_related r ON r."IID1" = p.i1 AND r."REL" = 'duplicate' JOIN fx_sample b ON r."IID2" = b.sample_id WHERE pruned_reason = 'duplicate'),
u AS (SELECT * FROM o UNION ALL SELECT i2, i1, s2, s1, t2, t1, pruned_reason FROM o UNION ALL SELECT p.i1, 'na', a.sex, 'na', a.study, 'na', pruned_reason FROM p JOIN fx_sample a ON p.i1 = a.sample_id WHERE pruned_reason = 'sex')
SELECT i1 AS "IID1", i2 AS "IID2", s1 AS sex1, s2 AS sex2, t1 AS study1, t2 AS study2, pruned_reason FROM u""")
def dup_report(fx):
    n = F.substring("sample_id", 2, 20).cast("bigint") % 3
    pruned = fx.sample.select("sample_id", F.when(n == 0, "callrate").when(n == 1, "sex").otherwise("related").alias("step"))
    return cohort.duplicate_report(pruned, fx.sample, fx.related)


@query("phenotype_by_sex", "SELECT v.phenotype, count(*) FILTER (WHERE k.sex = 'Male') AS male, count(*) FILTER (WHERE k.sex = 'Female') AS female, count(*) AS total FROM fx_visit v JOIN fx_sample k ON v.sample_id = k.sample_id GROUP BY 1")
def phenotype_by_sex(fx):
    return cohort.phenotype_by_sex(fx.visit.select("sample_id", "phenotype").join(fx.sample.select("sample_id", "sex"), "sample_id"))


@query("age_histogram", "SELECT sex, CAST(least(floor((age_at_sample_collection - 40) * 25 / 50), 24) AS INTEGER) AS bin, count(*) AS count FROM fx_sample WHERE age_at_sample_collection BETWEEN 40 AND 90 GROUP BY 1, 2")
def age_histogram(fx):
    return cohort.histogram(fx.sample, "age_at_sample_collection", 40, 90, 25, "sex")


@query("prune_funnel", "WITH t AS (SELECT step, sum(pruned_count)::BIGINT AS pruned_count FROM fx_qc WHERE level = 'sample' AND step <> 'related_prune' GROUP BY 1), r AS (SELECT *, CASE step WHEN 'callrate_prune' THEN 1 WHEN 'sex_prune' THEN 2 WHEN 'het_prune' THEN 3 ELSE 99 END AS rank FROM t) SELECT step, CASE rank WHEN 1 THEN 'Call Rate Prune' WHEN 2 THEN 'Sex Prune' WHEN 3 THEN 'Heterozygosity Prune' END AS step_name, rank, pruned_count, (1000 - sum(pruned_count) OVER (ORDER BY rank, step))::BIGINT AS remaining FROM r")
def prune_funnel(fx):
    return cohort.prune_funnel(fx.qc, 1000)


@query("variant_qc_merge", "SELECT ancestry, sum(pruned_count) FILTER (WHERE metric = 'geno_removed_count')::BIGINT AS geno_removed_count, sum(pruned_count) FILTER (WHERE metric = 'mis_removed_count')::BIGINT AS mis_removed_count, sum(pruned_count) FILTER (WHERE metric = 'haplotype_removed_count')::BIGINT AS haplotype_removed_count, sum(pruned_count) FILTER (WHERE metric = 'hwe_removed_count')::BIGINT AS hwe_removed_count FROM fx_qc WHERE level = 'variant' GROUP BY 1")
def variant_qc_merge(fx):
    return cohort.variant_qc(fx.qc, ["geno_removed_count", "mis_removed_count", "haplotype_removed_count", "hwe_removed_count"])


_MODEL = """WITH r AS (SELECT actual AS l, sum(CASE WHEN actual = predicted THEN n ELSE 0 END) / sum(n) AS recall, sum(n) AS t FROM fx_confusion GROUP BY 1), p AS (SELECT predicted AS l, sum(CASE WHEN actual = predicted THEN n ELSE 0 END) / sum(n) AS precision FROM fx_confusion GROUP BY 1),
a AS (SELECT avg(recall) AS ba, avg(precision) AS p, avg(2 * precision * recall / (precision + recall)) AS f1, sum(t) AS t FROM r JOIN p ON r.l = p.l)
SELECT round(ba, 6) AS balanced_accuracy, round(1.96 * sqrt(ba * (1 - ba) / t), 6) AS margin, round(p, 6) AS mean_precision, round(f1, 6) AS mean_f1 FROM a"""


@query("model_metrics", _MODEL)
def model_metrics(fx):
    return cohort.model_metrics(fx.confusion)


_BROWSER = f"""SELECT 'master' AS part, study AS key, count(*)::DOUBLE AS value FROM fx_sample GROUP BY study
 UNION ALL SELECT 'related', ancestry, count(DISTINCT "IID1")::DOUBLE FROM fx_related WHERE "REL" = 'first_deg' GROUP BY ancestry
 UNION ALL SELECT 'funnel', step, sum(pruned_count)::DOUBLE FROM fx_qc WHERE level = 'sample' AND step <> 'related_prune' GROUP BY step
 UNION ALL SELECT 'variant', ancestry || ':' || metric, sum(pruned_count)::DOUBLE FROM fx_qc WHERE level = 'variant' GROUP BY ancestry, metric
 UNION ALL SELECT 'confusion', actual || ':' || predicted, round(100 * n / sum(n) OVER (PARTITION BY actual), 1)::DOUBLE FROM fx_confusion
 UNION ALL SELECT 'model', name, value FROM (UNPIVOT ({_MODEL}) ON balanced_accuracy, margin, mean_precision, mean_f1 INTO NAME name VALUE value) u
 UNION ALL SELECT 'breakdown', nba_label, round(100 * count(*) / (SELECT count(*) FROM fx_sample WHERE nba_label IS NOT NULL), 6)::DOUBLE FROM fx_sample WHERE nba_label IS NOT NULL GROUP BY nba_label"""


@query("pipeline_browser", _BROWSER)
def pipeline_browser(fx):
    """The tables of one release - master key, relatedness, prune funnel, variant QC, ancestry model and breakdown - as part, key and value."""
    metrics = ["geno_removed_count", "mis_removed_count", "haplotype_removed_count", "hwe_removed_count"]
    n = fx.sample.where("nba_label IS NOT NULL").agg(F.count(F.lit(1))).scalar()
    variant = cohort.variant_qc(fx.qc, metrics).unpivot(["ancestry"], metrics, "metric", "value")
    model = cohort.model_metrics(fx.confusion)
    parts = {
        "master": cohort.value_counts(fx.sample, "study").select(F.col("study").alias("key"), F.col("count").alias("value")),
        "related": cohort.related_counts(fx.related).where("first_degree > 0").select(F.col("ancestry").alias("key"), F.col("first_degree").alias("value")),
        "funnel": cohort.prune_funnel(fx.qc, 1000).select(F.col("step").alias("key"), F.col("pruned_count").alias("value")),
        "variant": variant.select(F.concat_ws(":", "ancestry", "metric").alias("key"), "value"),
        "confusion": cohort.confusion_percent(fx.confusion).select(F.concat_ws(":", "actual", "predicted").alias("key"), F.col("pct").alias("value")),
        "model": model.unpivot([], model.columns, "key", "value"),
        "breakdown": cohort.value_counts(fx.sample.where("nba_label IS NOT NULL"), "nba_label").select(F.col("nba_label").alias("key"), F.round(100 * F.col("count") / n, 6).alias("value")),
    }
    out = None
    for part, table in parts.items():
        one = table.select(F.lit(part).alias("part"), "key", F.col("value").cast("double").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


@query("confusion_pct", "SELECT actual, predicted, round(100 * n / sum(n) OVER (PARTITION BY actual), 1) AS pct FROM fx_confusion")
def confusion_pct(fx):
    return cohort.confusion_percent(fx.confusion)


@query("study_column_sum", "SELECT study_code, sum(n_dna_samples_attempted)::BIGINT AS total FROM fx_cohort GROUP BY 1")
def study_column_sum(fx):
    return cohort.study_sum(fx.cohort, "n_dna_samples_attempted")


@query("scan_cohort_csv", "SELECT sample_id, coalesce(prune_reason, '') AS prune_reason, coalesce(age_of_onset, 0) AS age_of_onset, CASE WHEN age_at_sample_collection IS NULL THEN false ELSE related = 1 END AS related, CAST(coalesce(extended_clinical_data, 0) AS INTEGER) AS extended_clinical_data, CASE WHEN age_of_onset IS NULL THEN DATE '2020-01-31' ELSE DATE '2019-03-04' END AS enrolled FROM fx_sample")
def scan_cohort_csv(fx):
    """A tracker file with texts, numbers, a boolean and a date, each absent in some rows."""
    from locusweave.sources import shared, tables

    path = shared.new_folder(fx.spark, "cohort")
    known = F.col("age_at_sample_collection").isNotNull()
    rows = fx.sample.select("sample_id", "prune_reason", "age_of_onset", F.when(known, (F.col("related") == 1).cast("string")).alias("related"), "extended_clinical_data", F.when(F.col("age_of_onset").isNotNull(), "2019-03-04").alias("enrolled"))
    rows.write.option("header", True).csv(path)
    read = tables.read_cohort_csv(fx.spark, path, "sample_id string, prune_reason string, age_of_onset double, related boolean, extended_clinical_data int, enrolled date")
    return cohort.typed_cohort(read, F.lit("2020-01-31").cast("date"))


@query("admixture_filter", "SELECT ancestry, step, metric FROM fx_qc WHERE ancestry = 'ASIA'")
def admixture_filter(fx):
    return cohort.multi_select(fx.qc, ancestry=["ASIA"]).select("ancestry", "step", "metric")


@query("pca_cohort_subset", "SELECT sample_id, nba_label AS label FROM fx_sample WHERE study = 'BUILDING' UNION ALL SELECT sample_id, 'Predicted' FROM fx_sample WHERE study <> 'BUILDING' AND prune_reason IS NULL")
def pca_cohort_subset(fx):
    reference = fx.sample.where("study = 'BUILDING'").select("sample_id", F.col("nba_label").alias("label"))
    chosen = cohort.unpruned(fx.sample.where("study <> 'BUILDING'")).select("sample_id")
    projected = fx.sample.select("sample_id").join(chosen, "sample_id", "left_semi").withColumn("label", F.lit("Predicted"))
    return reference.unionByName(projected)


@query("projected_labels_join", "SELECT k.study AS \"FID\", k.sample_id AS \"IID\", v.visit_month FROM fx_sample k JOIN fx_visit v ON k.sample_id = v.sample_id")
def projected_labels_join(fx):
    points = fx.visit.join(fx.sample.select("sample_id", "study"), "sample_id").select(F.col("study").alias("FID"), F.col("sample_id").alias("IID"), "visit_month")
    return points.join(fx.sample.select(F.col("study").alias("FID"), F.col("sample_id").alias("IID")), ["FID", "IID"])


@query("study_key_join", "SELECT g.variant_id, g.sample_id, k.study FROM fx_gt g LEFT JOIN fx_sample k ON g.sample_id = k.sample_id WHERE g.data_type = 'WGS'")
def study_key_join(fx):
    return fx.gt.where("data_type = 'WGS'").join(fx.sample.select("sample_id", "study"), "sample_id", "left").select("variant_id", "sample_id", "study")


@query("traw_left_join", "SELECT p.variant_id, g.sample_id, g.dosage FROM fx_pvar p LEFT JOIN (SELECT * FROM fx_gt WHERE data_type = 'NBA') g ON p.variant_id = g.variant_id")
def traw_left_join(fx):
    return fx.pvar.select("variant_id").join(fx.gt.where("data_type = 'NBA'").drop("data_type"), "variant_id", "left")


@query("pipeline_legacy_carriers", """WITH st AS (SELECT k.nba_label, g.variant_id, sum(dosage) / (2 * nullif(count(dosage), 0)) AS f, 2 * count(dosage) AS n, avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0.0 END) AS m FROM fx_gt g JOIN fx_sample k ON g.sample_id = k.sample_id WHERE data_type = 'NBA' GROUP BY k.nba_label, g.variant_id)
SELECT p.variant_id, p.chromosome, coalesce(sum(n), 0)::BIGINT AS obs_ct, round(sum(coalesce(f, 0) * n) / nullif(sum(n), 0), 6) AS alt_freqs, round(sum(m * n) / nullif(sum(n), 0), 6) AS f_miss FROM fx_pvar p LEFT JOIN st ON p.variant_id = st.variant_id GROUP BY 1, 2""")
def pipeline_legacy_carriers(fx):
    from locusweave.operators import frequencies

    rows = fx.gt.where("data_type = 'NBA'").join(fx.sample.select("sample_id", "nba_label"), "sample_id")
    keys = ["nba_label", "variant_id"]
    stats = frequencies.variant_stats(rows, *keys)
    combined = frequencies.weighted_combine(stats, "variant_id", null_mode="zero")
    return fx.pvar.select("variant_id", "chromosome").join(combined, "variant_id", "left").select("variant_id", "chromosome", F.coalesce("obs_ct", F.lit(0)).alias("obs_ct"), F.round("alt_freqs", 6).alias("alt_freqs"), F.round("f_miss", 6).alias("f_miss"))


# bookkeeping


@query("anti_processed", "SELECT sample_id, study FROM fx_sample WHERE sample_id NOT IN (SELECT sample_id FROM fx_gt WHERE data_type = 'WGS')")
def anti_processed(fx):
    return bookkeeping.pending(fx.sample, fx.gt.where("data_type = 'WGS'"), "sample_id").select("sample_id", "study")


@query("pending_batches", "SELECT sample_id, study, CAST(floor((row_number() OVER (PARTITION BY study ORDER BY sample_id) - 1) / 20) AS INTEGER) AS batch FROM fx_sample WHERE sample_id NOT IN (SELECT sample_id FROM fx_gt WHERE data_type = 'WGS')")
def pending_batches(fx):
    rows = bookkeeping.pending(fx.sample, fx.gt.where("data_type = 'WGS'"), "sample_id").select("sample_id", "study")
    return bookkeeping.batches(rows, 20, "study", "sample_id")


@query("samples_to_process", "SELECT k.study, count(DISTINCT k.sample_id) AS \"all\", count(DISTINCT g.sample_id) AS done, count(DISTINCT CASE WHEN g.sample_id IS NULL THEN k.sample_id END) AS pending FROM fx_sample k LEFT JOIN (SELECT DISTINCT sample_id FROM fx_gt WHERE data_type = 'WGS') g ON k.sample_id = g.sample_id GROUP BY 1")
def samples_to_process(fx):
    return bookkeeping.progress(fx.sample, fx.gt.where("data_type = 'WGS'"), "study", "sample_id")


@query("missing_output_stats", "SELECT study, sample_id, count(*) OVER (PARTITION BY study) AS n_missing FROM fx_sample WHERE sample_id NOT IN (SELECT sample_id FROM fx_gt WHERE data_type = 'WGS')")
def missing_output_stats(fx):
    return bookkeeping.missing_outputs(fx.sample, fx.gt.where("data_type = 'WGS'"), "study", "sample_id")


@query("retry_merge", "SELECT coalesce(a.variant_id, b.variant_id) AS variant_id, coalesce(a.sample_id, b.sample_id) AS sample_id, coalesce(b.dosage, a.dosage) AS dosage FROM (SELECT * FROM fx_gt WHERE data_type = 'NBA') a FULL JOIN (SELECT * FROM fx_gt WHERE data_type = 'WGS') b ON a.variant_id = b.variant_id AND a.sample_id = b.sample_id")
def retry_merge(fx):
    return bookkeeping.retry_merge(fx.gt.where("data_type = 'NBA'"), fx.gt.where("data_type = 'WGS'"), ["variant_id", "sample_id"])


@query("retry_failures", "SELECT coalesce(a.variant_id, b.variant_id) AS variant_id, coalesce(a.sample_id, b.sample_id) AS sample_id FROM (SELECT * FROM fx_gt WHERE data_type = 'NBA') a FULL JOIN (SELECT * FROM fx_gt WHERE data_type = 'WGS') b ON a.variant_id = b.variant_id AND a.sample_id = b.sample_id WHERE b.dosage IS NULL AND a.dosage IS NULL")
def retry_failures(fx):
    return bookkeeping.still_failing(fx.gt.where("data_type = 'NBA'"), fx.gt.where("data_type = 'WGS'"), ["variant_id", "sample_id"])


@query("preview_limit", "SELECT p[3] AS \"snpID\", replace(p[1], 'chr', '') AS chromosome, CAST(p[2] AS BIGINT) AS position, p[4] AS ref, p[5] AS alt, p[6] AS qual, p[7] AS filter, p[8] AS info FROM (SELECT string_split(value, chr(9)) AS p FROM fx_vcf_line ORDER BY value LIMIT 10) t")
def preview_limit(fx):
    return vcf.extract_columns(lines(fx).orderBy("value"), "metadata", rows=10)
