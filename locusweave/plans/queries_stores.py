"""Queries over reports in JSON, databases, input checks, bucketed storage and exports of several files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from locusweave.operators import alleles, cohort, constraints, fingerprints, vcf
from locusweave.plans.queries_carriers import corrected
from locusweave.plans.queries_cohort import _COPIES, _LOCI, _PRINTS, _RSTATS, copies, recruitment_rows
from locusweave.plans.queries_files import delivered_lines
from locusweave.plans.registry import query
from locusweave.sources import bucketed, exports, json_tables, shared, sinks, tables, vcf_files

# a quality report in JSON: seven tables in three layouts, and a value that is no table


def qc_report(fx):
    """``QC``, ``related_samples`` and ``ancestry_labels`` as lists of rows, ``confusion_matrix`` as an object of objects, the counts and the components as objects of lists."""
    path = shared.new_folder(fx.spark, "qc")
    listed = lambda df, *order: df.agg(F.transform(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*df.columns).alias("r")))), lambda x: x["r"]).alias("v"))
    rows = {
        "QC": listed(fx.qc.select("ancestry", "step", "level", "metric", "pruned_count"), "ancestry", "step", "metric"),
        "related_samples": listed(fx.related.select("IID1", "IID2", "REL"), "IID1", "IID2", "REL"),
        "ancestry_labels": listed(fx.sample.select("sample_id", F.col("nba_label").alias("label"), F.col("wgs_label").alias("wgs")), "sample_id"),
    }
    cells = fx.confusion.groupBy("predicted").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("actual", "n")))).alias("m"))
    rows["confusion_matrix"] = cells.agg(F.map_from_entries(F.collect_list(F.struct("predicted", "m"))).alias("v"))
    counts = fx.sample.groupBy(F.col("nba_label").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    for name, df in (("ancestry_counts", counts), ("projected_pcs", _components(fx, 3)), ("ref_pcs", _components(fx, 5))):
        whole = df.agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias("rows"))
        rows[name] = whole.select(F.struct(*(F.col(f"rows.{c}").alias(c) for c in df.columns)).alias("v"))
    one = None
    for name, df in rows.items():
        df = df.select(F.lit(1).alias("k"), F.col("v").alias(name))
        one = df if one is None else one.join(df, "k")
    shared.write_file(one.select(F.to_json(F.struct(*rows, F.lit("v1").alias("note"), F.lit(3).alias("release")), {"ignoreNullFields": "false"}).alias("value")), f"{path}/report.json")
    return json_tables.documents(fx.spark, path)


def _components(fx, k):
    return fx.sample.select("sample_id", *((F.length("sample_id") * k + i).alias(f"PC{i}") for i in (1, 2)))


_CELLS = """WITH o AS (SELECT 'QC' AS name, row_number() OVER (ORDER BY ancestry, step, metric) - 1 AS r, * FROM fx_qc),
 l AS (SELECT row_number() OVER (ORDER BY "IID1", "IID2", "REL") - 1 AS r, * FROM fx_related), s AS (SELECT row_number() OVER (ORDER BY sample_id) - 1 AS r, * FROM fx_sample),
 n AS (SELECT row_number() OVER (ORDER BY nba_label) - 1 AS r, * FROM (SELECT nba_label, count(*) AS n FROM fx_sample GROUP BY 1) t),
 c AS (SELECT 'QC' AS name, CAST(r AS VARCHAR) AS row, 'ancestry' AS "column", ancestry AS value FROM o UNION ALL SELECT 'QC', r::VARCHAR, 'step', step FROM o UNION ALL SELECT 'QC', r::VARCHAR, 'level', level FROM o
  UNION ALL SELECT 'QC', r::VARCHAR, 'metric', metric FROM o UNION ALL SELECT 'QC', r::VARCHAR, 'pruned_count', pruned_count::VARCHAR FROM o
  UNION ALL SELECT 'related_samples', r::VARCHAR, 'IID1', "IID1" FROM l UNION ALL SELECT 'related_samples', r::VARCHAR, 'IID2', "IID2" FROM l UNION ALL SELECT 'related_samples', r::VARCHAR, 'REL', "REL" FROM l
  UNION ALL SELECT 'ancestry_labels', r::VARCHAR, 'sample_id', sample_id FROM s UNION ALL SELECT 'ancestry_labels', r::VARCHAR, 'label', nba_label FROM s UNION ALL SELECT 'ancestry_labels', r::VARCHAR, 'wgs', wgs_label FROM s
  UNION ALL SELECT 'confusion_matrix', actual, predicted, n::VARCHAR FROM fx_confusion UNION ALL SELECT 'ancestry_counts', r::VARCHAR, 'label', nba_label FROM n UNION ALL SELECT 'ancestry_counts', r::VARCHAR, 'n', n::VARCHAR FROM n
  UNION ALL SELECT t.name, r::VARCHAR, 'sample_id', sample_id FROM s, (VALUES ('projected_pcs'), ('ref_pcs')) t(name)
  UNION ALL SELECT t.name, r::VARCHAR, 'PC' || i, (length(sample_id) * k + i)::VARCHAR FROM s, (VALUES ('projected_pcs', 3), ('ref_pcs', 5)) t(name, k), (VALUES (1), (2)) j(i)) """


@query("scan_qc_json", _CELLS + 'SELECT name, row, "column", value FROM c')
def scan_qc_json(fx):
    """Every cell of the seven tables."""
    return json_tables.cells(qc_report(fx))


@query("json_to_tables", _CELLS + 'SELECT name, count(DISTINCT row) AS n_rows, CAST(count(DISTINCT "column") AS INTEGER) AS n_columns FROM c GROUP BY name')
def json_to_tables(fx):
    """The CSV files of all tables, read back."""
    folder, out = shared.new_folder(fx.spark, "tables"), None
    for name, (path, _) in json_tables.write_tables(qc_report(fx), folder).items():
        read = fx.spark.read.option("header", True).csv(path)
        one = read.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows", F.lit(len(read.columns)).alias("n_columns"))
        out = one if out is None else out.unionByName(one)
    return out


@query("json_key_paths", """WITH p AS (SELECT 'QC' AS top, count(*) * 5 AS n, 2 AS depth_max FROM fx_qc UNION ALL SELECT 'related_samples', count(*) * 3, 3 FROM fx_related UNION ALL SELECT 'ancestry_labels', count(*) * 3, 3 FROM fx_sample
 UNION ALL SELECT 'confusion_matrix', count(*) + count(DISTINCT predicted), 3 FROM fx_confusion UNION ALL SELECT 'ancestry_counts', 2, 2 UNION ALL SELECT 'projected_pcs', 3, 2 UNION ALL SELECT 'ref_pcs', 3, 2 UNION ALL SELECT 'note', 0, 1 UNION ALL SELECT 'release', 0, 1)
 SELECT top, CAST(1 + n AS BIGINT) AS n_paths, CASE top WHEN 'note' THEN 'string' WHEN 'release' THEN 'number' WHEN 'QC' THEN 'array' WHEN 'related_samples' THEN 'array' WHEN 'ancestry_labels' THEN 'array' ELSE 'object' END AS kind FROM p""")
def json_key_paths(fx):
    """Key paths of the report by top-level key, with the kind of its value."""
    paths = json_tables.key_paths(qc_report(fx)).withColumn("top", F.regexp_extract("path", r"^[^.\[]+", 0))
    return paths.groupBy("top").agg(F.count(F.lit(1)).alias("n_paths"), F.max(F.when(F.col("depth") == 1, F.col("kind"))).alias("kind"))


# a database

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def tracker(fx):
    """The cohort tracker as a table of an embedded database, which lives in this process; on a cluster the URL names a server. Gives its URL and name."""
    url, table = f"jdbc:derby:memory:{shared.new_folder(fx.spark, 'db').rsplit('/', 1)[-1]};create=true", "COHORT"
    known = F.col("age_at_sample_collection").isNotNull()
    rows = fx.sample.select(
        F.substring("sample_id", 2, 20).cast("long").alias("number"), "sample_id", "prune_reason", "age_of_onset", F.when(known, F.col("related") == 1).alias("related"), "extended_clinical_data",
        F.when(F.col("age_of_onset").isNotNull(), F.lit("2019-03-04").cast("date")).alias("enrolled"),
    )
    rows.write.mode("overwrite").option("driver", DERBY).jdbc(url, table)
    return url, table


_TRACKED = "SELECT sample_id, coalesce(prune_reason, '') AS prune_reason, coalesce(age_of_onset, 0) AS age_of_onset, CASE WHEN age_at_sample_collection IS NULL THEN false ELSE related = 1 END AS related, CAST(coalesce(extended_clinical_data, 0) AS INTEGER) AS extended_clinical_data, CASE WHEN age_of_onset IS NULL THEN DATE '2020-01-31' ELSE DATE '2019-03-04' END AS enrolled FROM fx_sample"


@query("scan_cohort_jdbc", _TRACKED)
def scan_cohort_jdbc(fx):
    """The tracker read in ranges of its number."""
    rows = tables.read_cohort_jdbc(fx.spark, *tracker(fx), "number", driver=DERBY).drop("number")
    return cohort.typed_cohort(rows, F.lit("2020-01-31").cast("date"))


@query("scan_cohort_jdbc_pruned", "SELECT sample_id, age_of_onset FROM fx_sample WHERE extended_clinical_data = 1 AND age_of_onset > 50")
def scan_cohort_jdbc_pruned(fx):
    """Filters and columns that the database applies."""
    rows = tables.read_cohort_jdbc(fx.spark, *tracker(fx), "number", driver=DERBY)
    return rows.where("extended_clinical_data = 1 AND age_of_onset > 50").select("sample_id", "age_of_onset")


# input checks


@query("scan_snp_list", """SELECT snp_list_id, chromosome, position, ref, alt, true AS valid FROM fx_snp_list UNION ALL SELECT snp_list_id, 'Q', 7, 'A', 'G', false FROM fx_snp_list WHERE moi = 'AR'""")
def scan_snp_list(fx):
    """A list's file with rows of no coordinate, which go, and of an unknown chromosome, which aren't valid."""
    path = f"{shared.new_folder(fx.spark, 'list')}.csv"
    rows = fx.snp_list.select("snp_list_id", "gene", "moi", "hg38")
    bad = rows.where("moi = 'AR'")
    rows.unionByName(bad.withColumn("hg38", F.lit("chrQ:7:A:G"))).unionByName(bad.withColumn("hg38", F.lit("chr1:x"))).unionByName(bad.withColumn("hg38", F.lit(None).cast("string"))).write.option("header", True).csv(path)
    read = tables.read_snp_list(fx.spark, path)
    valid = alleles.valid_variants(read).select("snp_list_id", "chromosome", "position", F.lit(True).alias("valid"))
    columns = ["snp_list_id", "chromosome", "position", "ref", "alt"]
    return read.select(*columns).join(valid, columns[:3], "left").withColumn("valid", F.coalesce("valid", F.lit(False)))


MASTER = StructType([StructField("sample_id", StringType()), StructField("study", StringType()), StructField("age_at_sample_collection", DoubleType()), StructField("absent", StringType())])


@query("scan_master_key", "SELECT t.kind, sample_id, study, age_at_sample_collection, CAST(NULL AS VARCHAR) AS absent FROM fx_sample, (VALUES ('csv'), ('tsv')) t(kind)")
def scan_master_key(fx):
    """The key from a file with commas and one with tabs, told apart by their endings; columns it lacks are null, others are left out."""
    folder, out = shared.new_folder(fx.spark, "key"), None
    for kind, sep in (("csv", ","), ("tsv", "\t")):
        path = f"{folder}/master.{kind}"
        fx.sample.select("sample_id", "study", "age_at_sample_collection", "sex").write.option("header", True).option("sep", sep).csv(path)
        one = tables.conform(tables.read_delimited(fx.spark, path), MASTER, ("sample_id",)).withColumn("kind", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


@query("scan_visits_baseline", "SELECT sample_id, moca_total_score, hoehn_and_yahr_stage FROM fx_visit WHERE visit_month = 0")
def scan_visits_baseline(fx):
    """Two files of visits found by a pattern, beside a dictionary that matches it too."""
    folder = shared.new_folder(fx.spark, "visits")
    rows = fx.visit.select("sample_id", "visit_month", "moca_total_score", "hoehn_and_yahr_stage")
    late = F.col("visit_month") > 12
    for name, part in (("r11_extended_clinical_data_a", rows.where(late)), ("r11_extended_clinical_data_b", rows.where(~late)), ("r11_extended_clinical_data_Dictionary", rows.limit(3).select(F.lit("0").alias("item"), F.lit("0").alias("meaning")))):
        part.write.option("header", True).csv(f"{folder}/{name}.csv")
    return tables.read_baseline_visits(fx.spark, f"{folder}/r11_extended_clinical_data*", "sample_id string, visit_month string, moca_total_score double, hoehn_and_yahr_stage double").drop("visit_month")


@query("scan_carrier_parquet", """WITH v AS (SELECT DISTINCT p.variant_id AS id, CAST(substr(p.variant_id, 2) AS BIGINT) AS k FROM fx_pvar p), g AS (SELECT g.*, CAST(substr(sample_id, 2) AS BIGINT) AS k FROM fx_gt g WHERE data_type = 'NBA')
 SELECT 'variants' AS "table", 'null' AS rule, 'locus' AS "column", CAST(NULL AS VARCHAR) AS value, count(*) + count(*) FILTER (k % 50 = 0) AS n FROM v WHERE k % 70 = 0 HAVING count(*) > 0
 UNION ALL SELECT 'variants', 'not unique', 'id', id, 2 FROM v WHERE k % 50 = 0
 UNION ALL SELECT 'numbers', 'not double', 'dosage', 'x', count(*) FROM g WHERE k % 9 = 0 HAVING count(*) > 0
 UNION ALL SELECT 'numbers', 'not in samples', 'IID', 'Z' || substr(sample_id, 2), count(*) FROM g WHERE k % 40 = 0 GROUP BY sample_id
 UNION ALL SELECT 'numbers', 'not in variants', 'id', 'Q1', count(*) FROM g WHERE k % 25 = 0 HAVING count(*) > 0
 UNION ALL SELECT 'texts', 'absent column', 'genotype', NULL, 0""")
def scan_carrier_parquet(fx):
    """Three carrier files with planted faults - repeated and unplaced variants, texts for numbers, unknown samples and variants, a column that is missing - against what they have to hold."""
    folder = shared.new_folder(fx.spark, "carriers")
    k = F.substring("id", 2, 20).cast("long")
    variants = fx.pvar.select(F.col("variant_id").alias("id")).distinct().withColumn("locus", F.when(k % 70 != 0, F.concat(F.lit("L"), (k % 7).cast("string"))))
    variants.unionByName(variants.where(k % 50 == 0)).write.parquet(f"{folder}/var_info")
    n = F.substring("sample_id", 2, 20).cast("long")
    rows = fx.gt.where("data_type = 'NBA'").select(F.when(n % 40 == 0, F.concat(F.lit("Z"), F.substring("sample_id", 2, 20))).otherwise(F.col("sample_id")).alias("IID"), F.when(n % 25 == 0, "Q1").otherwise(F.col("variant_id")).alias("id"), F.when(n % 9 == 0, "x").otherwise(F.col("dosage").cast("string")).alias("dosage"))
    rows.write.parquet(f"{folder}/carriers_int")
    rows.select("IID", "id").distinct().write.parquet(f"{folder}/carriers_string")
    fx.sample.select(F.col("sample_id").alias("IID")).write.parquet(f"{folder}/samples")
    read = lambda name: fx.spark.read.parquet(f"{folder}/{name}")
    return constraints.violations(
        constraints.Table("variants", read("var_info"), required=("id", "locus"), not_null=("id", "locus"), unique=(("id",),)),
        constraints.Table("samples", read("samples"), required=("IID",), not_null=("IID",), unique=(("IID",),)),
        constraints.Table("numbers", read("carriers_int"), required=("IID", "id", "dosage"), types={"dosage": "double"}, not_null=("IID",), references=(("IID", "samples", "IID"), ("id", "variants", "id"))),
        constraints.Table("texts", read("carriers_string"), required=("IID", "id", "genotype"), not_null=("IID",), unique=(("IID", "id"),)),
    )


# buckets

PARTS = [str(i) for i in range(1, 23)]
_BY_PART = ", ".join(f"count(*) FILTER (p.chromosome = '{c}') AS n_{c}" for c in PARTS)
_OR_NULL = ", ".join(f"nullif(n_{c}, 0) AS chromosome_{c}" for c in PARTS)


def by_chromosome(fx):
    """Calls by sample and chromosome, in buckets of the sample."""
    rows = fx.gt.where("data_type = 'NBA'").join(fx.pvar.select("variant_id", "chromosome"), "variant_id")
    return bucketed.store(rows.select("sample_id", "chromosome", "variant_id", "dosage"), "calls", 8, "sample_id")


@query("chrom_outer_merge", f"SELECT sample_id, {_OR_NULL} FROM (SELECT g.sample_id, {_BY_PART} FROM fx_gt g JOIN fx_pvar p ON g.variant_id = p.variant_id WHERE g.data_type = 'NBA' GROUP BY 1) t")
def chrom_outer_merge(fx):
    """The calls of all chromosomes side by side by sample; null where a sample has none in a chromosome."""
    return bucketed.outer_merge(by_chromosome(fx), "sample_id", "chromosome", PARTS, F.lit(1))


@query("samples_variant_ref_join", 'SELECT m."IID", m."snpID", m."GT", p.ref, p.alt FROM fx_metrics m LEFT JOIN fx_pvar p ON m."snpID" = p.variant_id AND m.chromosome = p.chromosome')
def samples_variant_ref_join(fx):
    """Metrics and the variant reference in equal buckets, so the join has no exchange."""
    ref = bucketed.store(fx.pvar.select(F.col("variant_id").alias("snpID"), "chromosome", "ref", "alt"), "reference", 8, "chromosome", "snpID")
    metrics = bucketed.store(fx.metrics.select("IID", "snpID", "GT", "chromosome"), "metrics", 8, "chromosome", "snpID")
    return metrics.join(ref, ["chromosome", "snpID"], "left").select("IID", "snpID", "GT", "ref", "alt")


@query("merge_chunks_by_chrom", "SELECT chromosome, count(*) AS n, count(DISTINCT position) AS positions, md5(string_agg(variant_id, ',' ORDER BY variant_id)) AS ids FROM fx_pvar GROUP BY 1")
def merge_chunks_by_chrom(fx):
    """Chunks regrouped by chromosome, in files of ranges of positions."""
    path = shared.new_folder(fx.spark, "chromosomes")
    sinks.write_by_chromosome(fx.pvar.repartition(7), path)
    back = fx.spark.read.schema("position long, variant_id string, chromosome string").parquet(path)
    return back.groupBy("chromosome").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("position").alias("positions"), F.md5(F.array_join(F.array_sort(F.collect_list("variant_id")), ",")).alias("ids"))


# exports of several files


def recruitment_export(fx):
    """All files of the recruitment export, from one stored table of carriers with their clinical rows."""
    rows = shared.stored(recruitment_rows(fx), "recruitment")
    stats = shared.stored(cohort.recruitment_stats(rows, "locus", "ancestry"), "recruitment-stats")
    export = exports.Export(fx.spark, shared.new_folder(fx.spark, "export"))
    export.add("recruitment_analysis", stats, "csv", "locus")
    export.add("carriers_list", rows.select("locus", "sample_id", "ancestry", "study", "phenotype"), "csv", "locus")
    export.add("ancestry_distribution", cohort.value_counts(rows, "locus", "ancestry", unknown="Unknown"))
    export.add("study_distribution", cohort.value_counts(rows, "locus", "study"))
    export.add("locus_dataframes_json", rows.select("locus", "sample_id", "ancestry", "study", "phenotype"), "json")
    export.add("recruitment_analysis_json", stats, "json")
    export.add("analysis_summary_json", cohort.recruitment_summary(rows, fx.sample), "json")
    export.manifest()
    return export


_EXPORTED = f"WITH {_LOCI}, r AS (SELECT lc.locus, lc.sample_id, k.nba_label, k.study FROM lc JOIN fx_sample k ON lc.sample_id = k.sample_id), c(name, format, n_rows) AS (" + """
 SELECT 'recruitment_analysis', 'csv', count(DISTINCT (locus, nba_label)) FROM r UNION ALL SELECT 'carriers_list', 'csv', count(*) FROM r UNION ALL SELECT 'ancestry_distribution', 'csv', count(DISTINCT (locus, nba_label)) FROM r
 UNION ALL SELECT 'study_distribution', 'csv', count(DISTINCT (locus, study)) FROM r UNION ALL SELECT 'locus_dataframes_json', 'json', count(*) FROM r UNION ALL SELECT 'recruitment_analysis_json', 'json', count(DISTINCT (locus, nba_label)) FROM r UNION ALL SELECT 'analysis_summary_json', 'json', 1)
 SELECT *, n_rows AS n_read FROM c"""


@query("sink_recruitment", _EXPORTED)
def sink_recruitment(fx):
    return recruitment_export(fx).read_back()


@query("pipeline_recruitment", _RSTATS)
def pipeline_recruitment(fx):
    """Load, carriers by locus, statistics, export; the statistics as the exported JSON file has them."""
    path = next(p for name, _, p, _ in recruitment_export(fx).entries if name == "recruitment_analysis_json")
    schema = cohort.recruitment_stats(recruitment_rows(fx), "locus", "ancestry").schema
    return fx.spark.read.schema(schema).json(path)


@query("sink_plink_keys", "SELECT 'ids' AS name, study AS fid, sample_id AS iid, sample_id || '_1' AS value FROM fx_sample UNION ALL SELECT 'pheno', study, sample_id, CASE extended_clinical_data WHEN 1 THEN '2' ELSE '1' END FROM fx_sample UNION ALL SELECT 'sex', study, sample_id, CASE sex WHEN 'Male' THEN '1' ELSE '2' END FROM fx_sample")
def sink_plink_keys(fx):
    """The three update tables - ids, phenotype, sex - from one stored key, without headers."""
    codes = {v: k for k, v in cohort.SEX.items()}
    key = shared.stored(fx.sample.select("study", "sample_id", "sex", "extended_clinical_data"), "key")
    values = {"ids": F.concat("sample_id", F.lit("_1")), "pheno": F.when(F.col("extended_clinical_data") == 1, "2").otherwise("1"), "sex": cohort.code_map("sex", codes)}
    export, out = exports.Export(fx.spark, shared.new_folder(fx.spark, "keys")), None
    for name, value in values.items():
        path = export.add(name, key.select("study", "sample_id", value.alias("value")), "tsv")
        one = fx.spark.read.option("sep", "\t").schema("fid string, iid string, value string").csv(path).withColumn("name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    export.manifest()
    return out


@query("sink_formats", """SELECT t.format, count(*) FILTER (t.format <> 'traw') + (CASE t.format WHEN 'traw' THEN (SELECT count(*) FROM (SELECT DISTINCT variant_id, counted_allele, alt_allele, sample_id FROM cx_maf WHERE data_type = 'NBA' AND dosage IS NOT NULL) x) ELSE 0 END) AS n
 FROM cx_maf, (VALUES ('csv'), ('json'), ('parquet'), ('traw')) t(format) WHERE data_type = 'NBA' GROUP BY t.format""")
def sink_formats(fx):
    """One stored table of genotypes in four formats, each read back; of the matrix the calls that aren't missing."""
    rows = shared.stored(corrected(fx).where("data_type = 'NBA'"), "genotypes")
    export = exports.Export(fx.spark, shared.new_folder(fx.spark, "formats"))
    sinks.write_formats(export, rows, "genotypes", ["csv", "parquet", "json", "traw"], "gzip")
    export.manifest()
    matrix = tables.read_traw(fx.spark, f"{export.folder}/genotypes_traw", missing=False).agg(F.count(F.lit(1)).alias("n")).select(F.lit("traw").alias("format"), "n")
    return export.read_back().where("n_rows = n_read").select("format", F.col("n_read").alias("n")).unionByName(matrix)


_EXTRACTED = """WITH t AS (SELECT string_split(value, chr(9)) AS p FROM fx_vcf_line), r AS (SELECT p[3] AS id, replace(p[1], 'chr', '') AS chromosome, p[4] AS ref, p[5] AS alt, p[8] AS info, string_split(p[10], ':') AS f FROM t)
SELECT form, n AS "IID", id AS "snpID", chromosome, f[1] AS "GT", regexp_extract(info, 'GC=([^;]+)', 1) AS "GC", CASE WHEN info LIKE '%ALLELE_A=1%' THEN alt ELSE ref END AS a1, CASE WHEN info LIKE '%ALLELE_B=1%' THEN alt ELSE ref END AS a2
 FROM r, (VALUES ('AFRICA'), ('AMERICA'), ('MIDDLE_EAST')) t(n), (VALUES ('csv'), ('parquet')) u(form)"""


@query("vcf_extract_columns", _EXTRACTED)
def vcf_extract_columns(fx):
    """Columns of all files of one sample with the sample's id, as csv and, by chromosome, as parquet; both read back."""
    lines = shared.stored(vcf_files.one_sample_lines(delivered_lines(fx)).select("value", "IID"), "lines")
    found = vcf.extract_columns(lines, ["chromosome", "GT", "GC", "a1", "a2"], None, "IID")
    out = None
    for form in ("csv", "parquet"):
        path = shared.new_folder(fx.spark, form)
        vcf.write_columns(found, path, form, form == "parquet")
        schema = "snpID string, IID string, chromosome string, GT string, GC string, a1 string, a2 string" if form == "csv" else "snpID string, IID string, GT string, GC string, a1 string, a2 string, chromosome string"
        one = fx.spark.read.schema(schema).option("header", True).format(form).load(path).withColumn("form", F.lit(form))
        out = one if out is None else out.unionByName(one)
    return out


@query("sink_duplicates_json", _PRINTS + _COPIES + """ SELECT 'groups' AS name, '{"' || hash || '":["' || replace(sample_ids, ',', '","') || '"]}' AS value FROM dg
 UNION ALL SELECT 'missing', g.variant_id || chr(9) || g.sample_id FROM g WHERE dosage IS NULL AND g.variant_id IN (SELECT variant_id FROM fx_pvar)""")
def sink_duplicates_json(fx):
    """Groups as JSON lines and missing alleles as a table with tabs, read back as they stand."""
    groups, gone = (shared.new_folder(fx.spark, n) for n in ("groups", "missing"))
    sinks.write_groups_json(fingerprints.duplicate_groups(copies(fx)), groups)
    fingerprints.missing_alleles(fx.gt.where("data_type = 'WGS'"), fx.pvar).write.option("sep", "\t").csv(gone)
    read = lambda path, name: fx.spark.read.text(path).select(F.lit(name).alias("name"), "value")
    return read(groups, "groups").unionByName(read(gone, "missing"))


_METRICS = """WITH t AS (SELECT string_split(value, chr(9)) AS p FROM fx_vcf_line), r AS (SELECT replace(p[1], 'chr', '') AS chromosome, CAST(p[2] AS BIGINT) AS position, p[3] AS variant_id, p[4] AS ref, p[5] AS alt, p[7] AS filter, string_split(p[10], ':') AS f FROM t)
SELECT n AS "IID", variant_id AS "snpID", chromosome, position, CASE f[1] WHEN '0/0' THEN 0 WHEN '0/1' THEN 1 WHEN '1/0' THEN 1 WHEN '1/1' THEN 2 ELSE -9 END AS "GT", TRY_CAST(f[2] AS DOUBLE) AS "GS", TRY_CAST(f[3] AS DOUBLE) AS "BAF", TRY_CAST(f[4] AS DOUBLE) AS "LRR", ref, alt, filter
 FROM r, (VALUES ('AFRICA'), ('AMERICA'), ('MIDDLE_EAST')) s(n)"""


@query("pipeline_snp_metrics", _METRICS)
def pipeline_snp_metrics(fx):
    """From the delivered VCF files to the metric table of all samples and the variant reference, both written by chromosome, then read back together."""
    lines = shared.stored(vcf_files.one_sample_lines(delivered_lines(fx)).select("value", "IID"), "lines")
    metrics, reference = (shared.new_folder(fx.spark, n) for n in ("metrics", "reference"))
    sinks.write_metrics(vcf.sample_metrics(lines, "IID"), metrics)
    sinks.write_by_chromosome(vcf.variant_reference(lines).dropDuplicates(["chromosome", "variant_id"]), reference)
    rows = fx.spark.read.schema("snpID string, position long, GT int, GS double, BAF double, LRR double, IID string, chromosome string").parquet(metrics)
    known = fx.spark.read.schema("variant_id string, ref string, alt string, filter string, chromosome string").parquet(reference).withColumnRenamed("variant_id", "snpID")
    return rows.join(known, ["chromosome", "snpID"])
