"""Small cases of the carrier operators, with exact expectations."""

import pytest
from pyspark.sql import functions as F

from locusweave.functions import sites as s
from locusweave.operators import alleles, bookkeeping, cohort, coverage, fingerprints, frequencies, probes, reports, vcf
from locusweave.sources import json_tables, sinks, tables, vcf_files
from locusweave.sources.fixtures import Fixtures
from locusweave.streaming import incremental


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def snp_list(spark):
    data = [("V1", "G1", "AR", "1", 100, "A", "G"), ("V2", "G1", "AD", "1", 200, "A", "T"), ("V3", "G2", "AR", "2", 300, "C", "T"), ("V4", "G2", "AR", "2", 400, "A", "AG")]
    return spark.createDataFrame(data, "snp_list_id string, gene string, moi string, chromosome string, position bigint, ref string, alt string")


def pvar(spark, *data):
    return spark.createDataFrame(list(data), "chromosome string, position bigint, variant_id string, ref string, alt string")


@pytest.mark.parametrize(
    "ref,alt,action",
    [("A", "G", "EXACT"), ("G", "A", "SWAP"), ("T", "C", "FLIP"), ("C", "T", "FLIP_SWAP"), ("A", "C", None)],
)
def test_harmonize_actions(spark, snp_list, ref, alt, action):
    got = alleles.harmonize(pvar(spark, ("1", 100, "P", ref, alt)), snp_list).collect()
    assert [r.action for r in got] == ([action] if action else [])


def test_palindromic_site_is_exact_or_swap(spark, snp_list):
    got = alleles.harmonize(pvar(spark, ("1", 200, "P", "A", "T"), ("1", 200, "Q", "T", "A")), snp_list)
    assert rows(got, "variant_id", "action", "strand_ambiguous") == [("P", "EXACT", True), ("Q", "SWAP", True)]
    legacy = alleles.harmonize_by_key(pvar(spark, ("1", 200, "P", "A", "T")), snp_list)
    assert rows(legacy, "match") == [("flip_swap",)]


def test_indel_complement_touches_single_letters_only(spark, snp_list):
    got = alleles.harmonize(pvar(spark, ("2", 400, "P", "T", "AG"), ("2", 400, "Q", "T", "TC")), snp_list)
    assert rows(got, "variant_id", "action") == [("P", "FLIP")]


def test_harmonize_is_invariant_under_strand_flip_of_both_sides(spark, snp_list):
    sites = pvar(spark, ("1", 100, "P", "A", "G"), ("2", 300, "Q", "T", "C"), ("2", 300, "R", "G", "A"))
    turned = lambda df: df.withColumns({"ref": s.complement("ref"), "alt": s.complement("alt")})
    assert rows(alleles.harmonize(sites, snp_list), "variant_id", "action") == rows(alleles.harmonize(turned(sites), turned(snp_list)), "variant_id", "action")


def test_all_actions_turn_the_dosage_and_missing_stays(spark, snp_list):
    plan = alleles.harmonize(pvar(spark, ("1", 100, "P", "A", "G"), ("2", 300, "Q", "T", "C")), snp_list)
    gt = spark.createDataFrame([("NBA", v, f"S{i}", d) for v in ("P", "Q") for i, d in enumerate((0.0, 1.0, 2.0, None))], "data_type string, variant_id string, sample_id string, dosage double")
    got = alleles.harmonize_dosage(gt, plan)
    assert rows(got, "variant_id", "sample_id", "dosage") == sorted([(v, f"S{i}", d) for v in ("P", "Q") for i, d in enumerate((2.0, 1.0, 0.0, None))], key=repr)
    assert alleles.harmonize_dosage(gt, None) is gt


def test_one_source_variant_with_two_list_rows_gives_two(spark, snp_list):
    twice = snp_list.where("snp_list_id = 'V1'").unionByName(snp_list.where("snp_list_id = 'V1'").withColumn("snp_list_id", F.lit("V1b")))
    gt = spark.createDataFrame([("NBA", "P", "S1", 0.0)], "data_type string, variant_id string, sample_id string, dosage double")
    assert alleles.harmonize_dosage(gt, alleles.harmonize(pvar(spark, ("1", 100, "P", "A", "G")), twice)).count() == 2


@pytest.mark.parametrize("dosages,flipped,af", [([1.0, 1.0], False, 0.5), ([2.0, 1.0], True, 0.75), ([0.0, 1.0, None], False, 0.25), ([None, None], False, None)])
def test_maf_correction(spark, dosages, flipped, af):
    data = [("NBA", "P", "V", "A", "G", f"S{i}", d) for i, d in enumerate(dosages)]
    gt = spark.createDataFrame(data, "data_type string, variant_id string, snp_list_id string, counted_allele string, alt_allele string, sample_id string, dosage double")
    got = alleles.maf_correction(gt).orderBy("sample_id").collect()
    assert [r.dosage for r in got] == [None if d is None else 2 - d if flipped else d for d in dosages]
    assert {(r.maf_corrected, r.original_alt_af, r.counted_allele) for r in got} == {(flipped, af, "G" if flipped else "A")}
    after = frequencies.allele_freq(alleles.maf_correction(gt), "variant_id").first().alt_freqs
    assert after is None or after <= 0.5


@pytest.mark.parametrize("raw,want", [("0_A1", "A1"), ("A_1_A_1", "A_1"), ("A_1_B_1", "A_1_B_1"), ("A1", "A1"), ("A_A", "A_A"), ("0_0_A", "0_A"), ("A_b_c_A_b_c", "A_b_c")])
def test_normalized_sample_id(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "x string").select(s.normalized_sample_id("x").alias("y")).first().y == want


def test_call_classes_and_zygosity(spark):
    df = spark.createDataFrame([(None,), (0.4,), (0.5,), (1.49,), (1.5,), (2.0,)], "d double")
    assert [r.c for r in df.select(s.call_class("d").alias("c")).collect()] == [None, "ref", "het", "het", "hom", "hom"]
    assert [r.c for r in df.select(s.zygosity("d").alias("c")).collect()] == ["", "het", "het", "het", "hom", "hom"]


def test_merge_keeps_disjoint_variants_of_same_samples(spark):
    data = [("1", f"V{v}", f"S{i}", float(i % 3)) for v in (1, 2) for i in range(5)] + [("2", f"V{v}", f"S{i}", float(i % 3)) for v in (3, 4) for i in range(5)]
    gt = spark.createDataFrame(data, "src string, variant_id string, sample_id string, dosage double")
    assert alleles.merge_sources(gt, "src", ["variant_id"]).groupBy("variant_id").count().count() == 4
    clash = spark.createDataFrame([("1", "V", "S", None), ("2", "V", "S", 1.0), ("3", "V", "S", 2.0)], "src string, variant_id string, sample_id string, dosage double")
    assert rows(alleles.merge_sources(clash, "src", ["variant_id"]), "dosage") == [(1.0,)]


def test_locus_metrics_count_a_sample_once_in_total(spark):
    data = [("NBA", "P1", "V1", "S1", "G", "EUR", 1, 1.0, 21.0, None, 60.0, 58.0), ("WGS", "P2", "V1", "S1", "G", "AJ", 1, 1.0, 21.0, None, 60.0, 58.0), ("NBA", "P1", "V1", "S2", "G", None, 0, 2.5, 25.0, 1.0, 60.0, 50.0)]
    df = spark.createDataFrame(data, "data_type string, variant_id string, snp_list_id string, sample_id string, gene string, ancestry string, extended_clinical_data int, hoehn_and_yahr_stage double, moca_total_score double, dat_sbr_caudate_mean double, age_at_sample_collection double, age_of_onset double")
    got = {r.ancestry: r for r in reports.locus_report(df).collect()}
    assert set(got) == {"EUR", "AJ", "TOTAL"}
    t = got["TOTAL"]
    assert (t.total_carriers, t.hy_less_than_2, t.hy_less_than_3, t.moca_gte_20, t.moca_gte_24, t.dat_caudate_available, t.disease_duration_lte_3_years, t.disease_duration_lte_7_years) == (2, 1, 2, 2, 1, 1, 1, 1)


def test_variant_report_flags(spark):
    data = [("NBA", "P1", "V1", "S1", "G", "AR", 1.0, "EUR"), ("WGS", "W1", "V1", "S1", "G", "AR", 1.0, "EUR"), ("NBA", "P2", "V2", "S1", "G", "AR", 1.0, "EUR"), ("WGS", "W1", "V1", "S2", "G", "AR", 2.0, "EUR"), ("NBA", "P1", "V1", "S3", "G", "AD", 1.0, "EUR")]
    df = spark.createDataFrame(data, "data_type string, variant_id string, snp_list_id string, sample_id string, gene string, moi string, dosage double, ancestry string")
    got = {(r.sample_id, r.snp_list_id): r for r in reports.variant_report(df, spark.createDataFrame([("S1",), ("S2",)], "sample_id string")).collect()}
    assert len(got) == 4
    one = got["S1", "V1"]
    assert (one.data_type, one.validated_by_wgs, one.potential_biallelic, one.nba_probe_name, one.wgs_carrier_concordance) == ("NBA, WGS", True, True, "P1", 1.0)
    assert got["S1", "V2"].validated_by_wgs is False and got["S1", "V2"].potential_biallelic
    assert got["S2", "V1"].validated_by_wgs is None and got["S2", "V1"].potential_biallelic and got["S2", "V1"].nba_probe_name == ""
    assert got["S3", "V1"].validated_by_wgs is None and not got["S3", "V1"].potential_biallelic


def test_probe_metrics_count_missing_as_reference(spark):
    nba = spark.createDataFrame([("V", "P1", "S1", 1.0), ("V", "P1", "S2", None), ("V", "P2", "S1", 0.0), ("V", "P2", "S3", 1.0), ("V", "P2", "S4", 0.0)], "snp_list_id string, variant_id string, sample_id string, dosage double")
    wgs = spark.createDataFrame([("V", "W", "S1", 1.0), ("V", "W", "S2", 2.0), ("V", "W", "S3", 0.0), ("V", "W", "S9", 1.0)], "snp_list_id string, variant_id string, sample_id string, dosage double")
    both = nba.withColumn("data_type", F.lit("NBA")).unionByName(wgs.withColumn("data_type", F.lit("WGS")))
    got = {r.variant_id: r for r in probes.probe_metrics(probes.probe_grid(both)).collect()}
    assert (got["P1"].tp, got["P1"].fp, got["P1"].fn, got["P1"].tn, got["P1"].samples) == (1, 0, 1, 1, 3)
    assert (got["P2"].tp, got["P2"].fp, got["P2"].fn, got["P2"].tn) == (0, 1, 2, 0)
    for r in got.values():
        assert sum(r[f"nba_{i}_wgs_{j}"] for i in range(3) for j in range(3)) == r.samples
    chosen = probes.consensus(probes.probe_metrics(probes.probe_grid(both)))
    assert rows(chosen, "agree", "recommended_probe") == [(True, "P1")]
    kept = probes.probe_filter(nba, probes.selection_map(chosen))
    assert rows(kept.select("variant_id").distinct(), "variant_id") == [("P1",)]


def test_probe_filter_without_recommendation_keeps_all(spark):
    nba = spark.createDataFrame([("V", "P1"), ("V", "P2"), ("U", "P3")], "snp_list_id string, variant_id string")
    none = spark.createDataFrame([], "snp_list_id string, selected_probe string")
    assert probes.probe_filter(nba, none).count() == 3


def test_weighted_combination_modes(spark):
    st = spark.createDataFrame([("V", 0.5, 0.1, 10), ("V", None, 0.3, 30)], "variant_id string, alt_freqs double, f_miss double, obs_ct bigint")
    skip, zero = (frequencies.weighted_combine(st, "variant_id", null_mode=m).first() for m in ("skip", "zero"))
    assert (skip.alt_freqs, zero.alt_freqs, skip.obs_ct) == (0.5, 0.125, 40)


def test_vcf_fields_by_each_records_own_format(spark):
    lines = ["##x", "#CHROM\tPOS", "chr1\t10\tr1\tA\tG\t.\tPASS\txGC=9;GC=5;ALLELE_A=0;ALLELE_B=1\tGT:GS\t0/1:0.5", "1\tx\tr2\tA\tG\t.\tPASS\t.\tGS:GT\t.:1|1", ""]
    got = {r.snpID: r for r in vcf.sample_metrics(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert (got["r1"].GT, got["r1"].GS, got["r1"].position, got["r1"].chromosome, got["r1"].BAF) == (1, 0.5, 10, "1", None)
    assert (got["r2"].GT, got["r2"].GS, got["r2"].position) == (-9, None, None)
    r = vcf.allele_columns(spark.createDataFrame([(lines[2],)], "value string")).first()
    assert (r.a1, r.a2) == ("A", "G")


def test_region_restrict_is_closed_and_gives_a_site_once(spark):
    sites = spark.createDataFrame([("1", p) for p in (99, 100, 150, 200, 201)], "chromosome string, position bigint")
    regions = spark.createDataFrame([("1", 100, 200), ("1", 140, 160)], "chromosome string, start bigint, end bigint")
    assert rows(vcf.region_restrict(sites, regions, 60), "position") == [(100,), (150,), (200,)]


def test_fingerprints_find_copies(spark):
    sites = pvar(spark, ("1", 1, "P1", "A", "G"), ("X", 5, "P2", "C", "T"), ("2", 9, "P3", "C", "T"), ("2", 9, "P4", "C", "T"))
    gt = spark.createDataFrame([(v, f"S{i}", float(d)) for v in ("P1", "P2", "P3", "P4") for i, d in enumerate((0, 1, 0))], "variant_id string, sample_id string, dosage double")
    good = fingerprints.perfect_sites(gt, sites)
    assert rows(good, "variant_id") == [("P1",), ("P2",)]
    assert rows(fingerprints.duplicate_groups(fingerprints.fingerprints(gt, good)), "n", "sample_ids") == [(2, "S0,S2")]


def test_curation_drops_ambiguous_names(spark):
    names = spark.createDataFrame([("GBA (N370S)", "1:1", 0), ("GBA (L444P)", "1:1", 1), ("LRRK2 (X)", "1:2", 2), ("LRRK2 (X)", "1:3", 3)], "label string, hg38 string, rank int")
    assert rows(coverage.curate(names), "hg38", "locus", "name", "alternative_name") == [("1:1", "GBA1", "N370S", "L444P")]


def test_retry_prefers_new_values(spark):
    make = lambda *r: spark.createDataFrame(list(r), "k string, dosage double")
    got = bookkeeping.retry_merge(make(("a", 1.0), ("b", 1.0)), make(("a", 2.0), ("b", None), ("c", 0.0)), ["k"])
    assert rows(got, "k", "dosage") == [("a", 2.0), ("b", 1.0), ("c", 0.0)]


def test_hwe_and_histogram_edges(spark):
    gt = spark.createDataFrame([("V", float(d)) for d in [0] * 25 + [1] * 50 + [2] * 25] + [("M", None)], "variant_id string, dosage double")
    got = {r.variant_id: r for r in frequencies.hardy_weinberg(gt, "variant_id").collect()}
    assert got["V"].chi2 == 0 and got["V"].passes and got["M"].passes
    ages = spark.createDataFrame([(40.0,), (90.0,), (None,), (41.9,)], "age double")
    assert rows(cohort.histogram(ages, "age", 40, 90, 25), "bin", "count") == [(0, 2), (24, 1)]


def test_readers_and_writers_round_trip(spark, tmp_path):
    gt = spark.createDataFrame([("1", "P", 5, "A", "G", "S1", 1.0), ("1", "P", 5, "A", "G", "S2", None)], "chromosome string, variant_id string, position bigint, counted_allele string, alt_allele string, sample_id string, dosage double")
    assert sinks.write_traw(gt, str(tmp_path / "m")) == ["S1", "S2"]
    assert rows(tables.read_traw(spark, str(tmp_path / "m")), "variant_id", "sample_id", "dosage") == [("P", "S1", 1.0), ("P", "S2", None)]
    (tmp_path / "with.pvar").write_text("##c\n#CHROM\tPOS\tID\tREF\tALT\n1\t10\tr1\tA\tG\n")
    (tmp_path / "bare.pvar").write_text("1\t10\tr1\tA\tG\n")
    assert rows(tables.read_pvar(spark, str(tmp_path / "with.pvar")), "*") == rows(tables.read_pvar(spark, str(tmp_path / "bare.pvar")), "*") == [("1", "10", "r1", "A", "G")]
    m = spark.createDataFrame([("I1", "1", 1), ("I1", "2", 2)], "IID string, chromosome string, GT int")
    sinks.write_metrics(m, str(tmp_path / "metrics"))
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        sinks.write_metrics(m, str(tmp_path / "metrics"))
    (tmp_path / "qc.json").write_text('{"counts": {"label": {"0": "EUR", "1": "AJ"}, "n": {"0": 5, "1": 6}}, "rows": [{"a": 1}, {"a": 2}], "note": "x"}')
    qc = json_tables.cells(json_tables.documents(spark, str(tmp_path / "qc.json")))
    assert rows(qc, "name", "row", "column", "value") == [("counts", "0", "label", "EUR"), ("counts", "0", "n", "5"), ("counts", "1", "label", "AJ"), ("counts", "1", "n", "6"), ("rows", "0", "a", "1"), ("rows", "1", "a", "2")]
    vcf_dir = tmp_path / "v"
    vcf_dir.mkdir()
    (vcf_dir / "S7.snv.vcf").write_text("#h\n")
    assert rows(vcf_files.read_lines(spark, str(vcf_dir)), "IID") == [("S7",)]


def test_conform(spark):
    schema = spark.createDataFrame([], "a int, b string").schema
    got = tables.conform(spark.createDataFrame([("7",), ("x",)], "a string"), schema, ("a",))
    assert rows(got, "a", "b") == [(7, None), (None, None)]
    with pytest.raises(ValueError):
        tables.conform(spark.createDataFrame([("7",)], "b string"), schema, ("a",))


def test_incremental_follow(spark, tmp_path):
    inbox, store, check = (str(tmp_path / x) for x in ("in", "store", "check"))
    make = lambda *r: spark.createDataFrame(list(r), "k string, dosage double")
    make(("a", 1.0), ("b", 1.0)).write.mode("append").parquet(inbox)
    incremental.follow(spark, inbox, "k string, dosage double", store, check, ["k"]).awaitTermination()
    make(("b", 2.0), ("a", None), ("c", 0.0)).write.mode("append").parquet(inbox)
    incremental.follow(spark, inbox, "k string, dosage double", store, check, ["k"]).awaitTermination()
    want = [("a", 1.0), ("b", 2.0), ("c", 0.0)]
    assert incremental.versions(spark, store) == [0, 1] and rows(incremental.latest(spark, store, ["k"]), "k", "dosage") == want
    incremental.compact(spark, store, f"{store}-new", ["k"])
    assert incremental.versions(spark, f"{store}-new") == [1] and rows(incremental.latest(spark, f"{store}-new", ["k"]), "k", "dosage") == want
    assert incremental.latest(spark, f"{store}-none", ["k"]) is None


def test_batches_are_numbered_over_ranges(spark):
    data = spark.createDataFrame([("a", i) for i in range(57)] + [("b", i) for i in range(3)], "g string, i int").repartition(5)
    got = bookkeeping.batches(data, 10, "g", "i").collect()
    assert len(got) == 60 and all(r.batch == r.i // 10 for r in got)


def test_retries_merge_one_row_per_key(spark):
    make = lambda *r: spark.createDataFrame(list(r), "k string, dosage double")
    old, new = make(("a", 1.0), ("b", None), ("c", None), ("c", None)), make(("a", None), ("b", 2.0), ("b", 2.0), ("c", None))
    assert rows(bookkeeping.retry_merge(old, new, ["k"]), "k", "dosage") == [("a", 1.0), ("b", 2.0), ("c", None)]
    assert rows(bookkeeping.still_failing(old, new, ["k"]), "k") == [("c",)]


def test_correction_is_by_file(spark):
    """One ancestry of a variant turns, the other doesn't; merged, they are two rows of one data type with their own alleles."""
    data = [("NBA", "EUR", "P", "V", "1", 5, f"S{i}", 2.0 if i < 3 else 1.0, "A", "G") for i in range(4)] + [("NBA", "EAS", "P", "V", "1", 5, f"T{i}", 0.0 if i else 1.0, "A", "G") for i in range(4)]
    gt = spark.createDataFrame(data, "data_type string, source string, variant_id string, snp_list_id string, chromosome string, position long, sample_id string, dosage double, counted_allele string, alt_allele string")
    got = alleles.maf_correction(gt)
    assert rows(got.select("source", "maf_corrected", "counted_allele").distinct(), "source", "maf_corrected", "counted_allele") == [("EAS", False, "A"), ("EUR", True, "G")]
    assert {r.maf_corrected for r in alleles.maf_correction(gt, "data_type").collect()} == {False}
    again = got.unionByName(got.where("source = 'EAS'").withColumns({"source": F.lit("ZZZ"), "dosage": F.lit(None).cast("double")}))
    merged = alleles.merge_sources(again, "source", ["data_type", *alleles.KEYS], "maf_corrected")
    assert merged.count() == 8 and merged.where("dosage IS NULL").count() == 0 and rows(merged.groupBy("counted_allele").count(), "counted_allele", "count") == [("A", 4), ("G", 4)]


def test_empty_tables_keep_their_columns(spark, snp_list):
    none = pvar(spark)
    assert alleles.harmonize(none, snp_list).count() == 0


def test_deliveries_are_written_by_many_tasks(spark, sf_dir, monkeypatch):
    from pathlib import Path

    from locusweave.plans import queries_files, registry

    assert queries_files.incremental is incremental
    files, follow = [], incremental.follow

    def counted(session, folder, *args, **options):
        files.append(len(list(Path(folder.removeprefix("file:")).rglob("*.parquet"))))
        return follow(session, folder, *args, **options)

    monkeypatch.setattr(incremental, "follow", counted)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        got = registry.QUERIES["incremental_stream"](spark, sf_dir)
    finally:
        spark.conf.unset(key)
    calls = registry.Fixtures(spark, sf_dir).gt.select("variant_id", "sample_id").distinct().count()
    assert files[0] > 1 and files[1] > files[0] + 1 and got.count() == calls


def test_whole_queries_take_all_samples_chromosomes_and_variants(spark, sf_dir):
    from locusweave.plans import registry
    import __spark_entry__  # noqa: F401  (registers all queries)

    fx = registry.Fixtures(spark, sf_dir)
    ids = lambda df, *c: {tuple(r) for r in df.select(*c).distinct().collect()}
    of = lambda name, *c: ids(registry.QUERIES[name](spark, sf_dir), *c)
    pvar, nba = ids(fx.pvar, "variant_id"), fx.gt.where("data_type = 'NBA'")
    assert of("sink_metrics", "IID", "chromosome") == ids(fx.metrics, "IID", "chromosome")
    merged = registry.QUERIES["chrom_outer_merge"](spark, sf_dir)
    assert merged.columns == ["sample_id", *(f"chromosome_{i}" for i in range(1, 23))] and ids(merged, "sample_id") == ids(nba, "sample_id")
    assert of("traw_left_join", "variant_id") == pvar
    assert of("extract_variants", "variant_id") == ids(nba, "variant_id") & ids(fx.pvar.join(fx.snp_list, ["chromosome", "position"]), "variant_id")
    assert of("match_info_reference", "variant_id") == of("harmonize", "variant_id")


def exchanges(df):
    """Shuffles of a plan whose joins may not broadcast."""
    import re

    return len(re.findall(r"Exchange (?:hash|range)partitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_genotype_stand_in_is_its_sql(spark, sf_dir):
    """Both data types from one join and aggregate give what the text of fx_gt does, dealt by sample."""
    fx = Fixtures(spark, sf_dir)
    got, want = fx.gt, fx.sql("SELECT * FROM fx_gt")
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert exchanges(got) < exchanges(want)


def test_calls_are_dealt_few_times(spark, sf_dir):
    """Line items, orders, calls by sample (with the labels) and by variant; the stored genotypes by sample and by list row."""
    fx = Fixtures(spark, sf_dir)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = spark.createDataFrame([], "variant_id string, snp_list_id string, chromosome string, position long, action string, list_ref string, list_alt string, ref string, alt string")
        sourced = alleles.with_source(fx.gt, spark.createDataFrame([], "sample_id string, nba_label string, wgs_label string"))
        # items, orders, calls by sample, labels; then calls by variant and the plan, twice
        assert exchanges(sourced) == 4 and exchanges(alleles.corrected(sourced, plan)) <= 7
        genotype = spark.createDataFrame([], "data_type string, snp_list_id string, variant_id string, sample_id string, dosage double")
        ranked = probes.consensus(probes.probe_metrics(probes.probe_grid(genotype)))
        # probes and their list rows; the shared samples, calls by sample and by list row, and what counts the shared samples
        assert exchanges(ranked) <= 6
        rows = spark.createDataFrame([], "data_type string, variant_id string, snp_list_id string, sample_id string, gene string, ancestry string, extended_clinical_data int, hoehn_and_yahr_stage double, moca_total_score double, dat_sbr_caudate_mean double, age_at_sample_collection double, age_of_onset double")
        assert exchanges(reports.locus_report(rows.repartition("sample_id"))) == 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
