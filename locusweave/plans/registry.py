"""Names of the library's queries, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from locusweave.sources.fixtures import Fixtures, with_ctes

#: Steps that several oracles share, as SQL for DuckDB.
STEPS = {
    "cx_match": """
SELECT *, CASE WHEN ref = list_ref AND alt = list_alt THEN 'EXACT' WHEN ref = list_alt AND alt = list_ref THEN 'SWAP'
  WHEN ref = fr AND alt = fa THEN 'FLIP' WHEN ref = fa AND alt = fr THEN 'FLIP_SWAP' END AS action
FROM (SELECT p.*, s.snp_list_id, s.gene, s.moi, s.ref AS list_ref, s.alt AS list_alt,
  CASE WHEN length(s.ref) = 1 THEN translate(s.ref, 'ACGT', 'TGCA') ELSE s.ref END AS fr, CASE WHEN length(s.alt) = 1 THEN translate(s.alt, 'ACGT', 'TGCA') ELSE s.alt END AS fa
  FROM fx_pvar p JOIN fx_snp_list s ON p.chromosome = s.chromosome AND p.position = s.position) t""",
    "cx_dos": """
SELECT g.data_type, coalesce(CASE WHEN g.data_type = 'WGS' THEN k.wgs_label ELSE k.nba_label END, 'Unknown') AS source, g.variant_id, g.sample_id, 2 - g.dosage AS dosage, m.snp_list_id, m.chromosome, m.position, m.action, m.list_alt AS counted_allele, m.list_ref AS alt_allele
FROM fx_gt g JOIN cx_match m ON g.variant_id = m.variant_id LEFT JOIN fx_sample k ON g.sample_id = k.sample_id WHERE m.action IS NOT NULL""",
    "cx_af": "SELECT data_type, source, variant_id, snp_list_id, avg(dosage) / 2 AS af FROM cx_dos GROUP BY data_type, source, variant_id, snp_list_id",
    "cx_maf": """
SELECT d.data_type, d.source, d.variant_id, d.sample_id, CASE WHEN a.af > 0.5 THEN 2 - d.dosage ELSE d.dosage END AS dosage, d.snp_list_id, d.chromosome, d.position, d.action,
  CASE WHEN a.af > 0.5 THEN d.alt_allele ELSE d.counted_allele END AS counted_allele, CASE WHEN a.af > 0.5 THEN d.counted_allele ELSE d.alt_allele END AS alt_allele,
  a.af AS original_alt_af, coalesce(a.af > 0.5, false) AS maf_corrected
FROM cx_dos d JOIN cx_af a ON d.data_type = a.data_type AND d.source = a.source AND d.variant_id = a.variant_id AND d.snp_list_id = a.snp_list_id""",
    "cx_car": """
SELECT g.*, s.gene, s.moi, s.hg38, k.study, k.nba_label, k.wgs_label, k.extended_clinical_data, k.age_at_sample_collection, k.age_of_onset, k.sex,
  CASE WHEN g.data_type = 'WGS' THEN k.wgs_label ELSE k.nba_label END AS ancestry
FROM cx_maf g LEFT JOIN fx_snp_list s ON g.snp_list_id = s.snp_list_id LEFT JOIN fx_sample k ON g.sample_id = k.sample_id WHERE g.dosage > 0""",
    "cx_carv": """
SELECT c.*, v.moca_total_score, v.hoehn_and_yahr_stage, v.dat_sbr_caudate_mean FROM cx_car c LEFT JOIN (SELECT * FROM fx_visit WHERE visit_month = 0) v ON c.sample_id = v.sample_id""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Fixtures], DataFrame]], Callable[[Fixtures], DataFrame]]:
    """Register a query over the stand-in tables; ``sql`` is the same query for DuckDB."""

    def add(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Fixtures(spark, sf_dir))
        if sql:
            ORACLES[name] = with_ctes(sql, STEPS, "AS MATERIALIZED")
        return build

    return add
