"""Stages of a screening: what is stored is read again, what has changed is computed anew; frequencies before rows multiply."""

import pytest
from pyspark.sql import functions as F

from locusweave.operators import alleles, probes, reports
from locusweave.plans import carriers
from locusweave.sources import bucketed
from locusweave.sources.fixtures import TABLES, Fixtures


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory, sf_dir):
    """The stand-ins as files."""
    fx, root = Fixtures(spark, sf_dir), tmp_path_factory.mktemp("inputs")
    for name in ("gt", "pvar", "snp_list", "sample", "visit"):
        getattr(fx, name).write.parquet(str(root / name))
    return root


def run(spark, inputs, folder, **options):
    return carriers.screen(*(spark.read.parquet(str(inputs / n)) for n in ("gt", "pvar", "snp_list", "sample", "visit")), folder=str(folder), **options)


def actions(screening):
    return dict(screening.stages.ran)


def test_second_run_reads_stored_tables_only(spark, inputs, tmp_path, monkeypatch):
    first = run(spark, inputs, tmp_path / "run")
    assert set(actions(first).values()) == {"computed"}
    monkeypatch.setattr(carriers, "corrected_genotypes", lambda *a: pytest.fail("harmonized anew"))
    second = run(spark, inputs, tmp_path / "run")
    assert set(actions(second).values()) == {"read"} and list(actions(second)) == list(actions(first))
    for name in ("carriers", "locus_report", "variant_report", "coverage"):
        a, b = getattr(first, name), getattr(second, name)
        assert all("/run/" in f for f in b.inputFiles()) and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_stages_can_be_left_out(spark, inputs, tmp_path):
    got = run(spark, inputs, tmp_path / "run", merge_ancestries=False, select_probes=False, report=("coverage",))
    assert set(actions(got)) == {"corrected", "carriers", "coverage_report"} and got.locus_report is None and got.probe_selection is None
    again = run(spark, inputs, tmp_path / "run", select_probes=False, report=("locus",))
    assert actions(again) == {"corrected": "read", "merged": "computed", "carriers": "computed", "locus_report": "computed"}


def test_changed_inputs_are_computed_anew(spark, inputs, tmp_path):
    options = {"select_probes": False, "report": ("locus", "coverage")}
    run(spark, inputs, tmp_path / "run", **options)
    tables = [spark.read.parquet(str(inputs / n)) for n in ("gt", "pvar", "snp_list", "sample", "visit")]
    changed = carriers.screen(*tables[:4], tables[4].where("visit_month < 6"), folder=str(tmp_path / "run"), **options)
    assert actions(changed) == {"corrected": "read", "merged": "read", "carriers": "computed", "locus_report": "computed", "coverage_report": "read"}
    listed = carriers.screen(tables[0], tables[1], tables[2].where("moi = 'AR'"), *tables[3:], folder=str(tmp_path / "run"), **options)
    assert set(actions(listed).values()) == {"computed"}


def test_run_that_broke_off_is_taken_up(spark, inputs, tmp_path, monkeypatch):
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(carriers.reports, "carriers", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        run(spark, inputs, tmp_path / "run", select_probes=False, report=())
    got = actions(run(spark, inputs, tmp_path / "run", select_probes=False, report=()))
    assert got == {"corrected": "read", "merged": "read", "carriers": "computed"}


def test_corrected_is_correction_after_harmonization(spark, sf_dir):
    """Frequencies of raw calls give what frequencies of the multiplied rows do."""
    fx = Fixtures(spark, sf_dir)
    genotype, plan = alleles.with_source(fx.gt, fx.sample), alleles.harmonize(fx.pvar, fx.snp_list)
    columns = ["data_type", "source", "variant_id", "snp_list_id", "sample_id", "dosage", "chromosome", "position", "action", "counted_allele", "alt_allele", "maf_corrected", F.round("original_alt_af", 9)]
    got, want = (sorted(map(repr, df.select(*columns).collect())) for df in (alleles.corrected(genotype, plan), alleles.maf_correction(alleles.harmonize_dosage(genotype, plan))))
    assert got == want and len(got) > 1000


def test_genotypes_meet_the_plan_once(spark):
    """One join of the calls with the small table of what is to be done; the aggregate before it reads raw calls."""
    gt = spark.createDataFrame([], "data_type string, source string, variant_id string, sample_id string, dosage double")
    plan = spark.createDataFrame([], "variant_id string, snp_list_id string, chromosome string, position long, action string, list_ref string, list_alt string, ref string, alt string")
    text = alleles.corrected(gt, plan)._jdf.queryExecution().analyzed().toString()
    assert text.count("Join ") == 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stages_stay_dealt(spark, inputs, tmp_path):
    """What is built on a stage by the key of its buckets needs no exchange; a session that doesn't know the tables reads their files."""
    got = run(spark, inputs, tmp_path / "run", select_probes=False, report=("locus", "variant"))
    assert "Exchange" not in plan_of(got.genotype.groupBy("variant_id", "sample_id").count()) and "Exchange" not in plan_of(got.carriers.groupBy("sample_id", "gene").count())
    want, n = sorted(map(repr, got.variant_report.collect())), got.genotype.count()
    for path in got.stages.known.values():
        spark.sql(f"DROP TABLE IF EXISTS {bucketed.table_of(path)}")
    again = run(spark, inputs, tmp_path / "run", select_probes=False, report=("locus", "variant"))
    assert set(actions(again).values()) == {"read"} and "Exchange" in plan_of(again.genotype.groupBy("variant_id", "sample_id").count())
    assert sorted(map(repr, again.variant_report.collect())) == want and again.genotype.count() == n > 1000


def test_calls_are_labelled_genotypes(spark, sf_dir, tmp_path):
    """Labels that come by the orders are those that come by the samples, also of samples that are listed twice or not at all."""
    for name in TABLES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "customer":
            df = df.where("c_custkey % 7 <> 0").unionByName(df.where("c_custkey % 6 = 0")).unionByName(df.where("c_custkey % 11 = 0").withColumn("c_nationkey", F.col("c_nationkey") * 0))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    fx = Fixtures(spark, str(tmp_path))
    got, want = fx.calls, alleles.with_source(fx.gt, fx.sample)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert plan_of(fx.calls.groupBy("variant_id").count()).count("Exchange hashpartitioning(variant_id") == 0


def test_list_by_variant_is_list_by_row(spark):
    rows = spark.createDataFrame([("P1", "V1", "S1", "NBA", 1.0), ("P1", "V2", "S1", "NBA", 2.0), ("P2", "V1", "S2", "WGS", 1.0), ("P3", "V9", "S2", "WGS", 1.0), ("P2", "V1", "S3", "WGS", 0.0)], "variant_id string, snp_list_id string, sample_id string, data_type string, dosage double")
    listed = spark.createDataFrame([("V1", "G1", "AR", "h1"), ("V1", "G2", "AD", "h1"), ("V2", "G3", None, None)], "snp_list_id string, gene string, moi string, hg38 string")
    samples = spark.createDataFrame([("S1", "AFR", None), ("S2", "EUR", "EUR")], "sample_id string, nba_label string, wgs_label string")
    matches = rows.select("variant_id", "snp_list_id")
    got, want = reports.carriers(rows, listed, samples, None, matches), reports.carriers(rows, listed, samples)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect())) and want.count() == 6


def test_filter_keeps_other_types(spark):
    rows = spark.createDataFrame([("NBA", "P1", "V1"), ("NBA", "P2", "V1"), ("NBA", "P3", "V2"), ("WGS", "P2", "V1"), ("WGS", "P4", "V1"), ("NBA", "P2", "V3")], "data_type string, variant_id string, snp_list_id string")
    selected = spark.createDataFrame([("V1", "P1")], "snp_list_id string, selected_probe string")
    got = sorted(tuple(r) for r in probes.probe_filter(rows, selected, "NBA").collect())
    assert got == [("NBA", "P1", "V1"), ("NBA", "P2", "V3"), ("NBA", "P3", "V2"), ("WGS", "P2", "V1"), ("WGS", "P4", "V1")]
    assert sorted(tuple(r) for r in probes.probe_filter(rows.where("data_type = 'NBA'"), selected).collect()) == got[:3]


def test_calls_of_odd_items(spark, sf_dir, tmp_path):
    """Both dosages of an item travel as one number: negative and absent quantities, absent discounts and the seventh line give what the SQL does."""
    for name in TABLES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "lineitem":
            k = F.col("l_orderkey") % 7
            df = df.withColumns({"l_quantity": F.when(k == 0, -F.col("l_quantity")).when(k != 1, F.col("l_quantity")), "l_discount": F.when(k != 2, F.col("l_discount"))})
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    fx = Fixtures(spark, str(tmp_path))
    want = fx.sql("SELECT * FROM fx_gt")
    got = sorted(map(repr, fx.gt.select(*want.columns).collect()))
    assert got == sorted(map(repr, want.collect())) and sorted(map(repr, fx.calls.select(*want.columns).collect())) == got
    assert fx.gt.where("dosage < 0").count() > 0 and fx.gt.where("dosage IS NULL").count() > 0
    assert "both" in fx.calls._jdf.queryExecution().optimizedPlan().toString()


def test_report_leaves_behind_what_is_not_reported(spark):
    """Rows that are dealt by list row carry no texts that can be made there, and the report is the same."""
    rows = spark.createDataFrame(
        [("S1", "V1", "NBA", "P1", 1.0, "AFR", "G1", "AR", "NBA, WGS", True, True, True), ("S1", "V2", "WGS", "P2", 1.0, "AFR", "G1", "AR", "WGS", True, False, True), ("S2", "V1", "NBA", "P3", 2.0, None, "G1", "AD", "NBA", False, True, True), ("S3", "V3", "NBA", "P4", None, "EUR", None, None, "NBA", False, True, None)],
        "sample_id string, snp_list_id string, data_type string, variant_id string, dosage double, ancestry string, gene string, moi string, data_types string, has_wgs boolean, has_nba boolean, in_wgs boolean",
    )
    listed = spark.createDataFrame([("V1", "h1"), ("V2", "h2"), ("V2", "h2")], "snp_list_id string, hg38 string")
    report = reports.report_of(rows, listed)
    got = {(r.sample_id, r.snp_list_id): tuple(r)[4:] for r in report.collect()}
    assert got == {
        ("S1", "V1"): ("P1", "het", "AR", "NBA, WGS", True, True, 0.5, "h1"), ("S1", "V2"): ("", "het", "AR", "WGS", True, None, None, "h2"),
        ("S2", "V1"): ("P3", "hom", "AD", "NBA", False, False, 0.5, "h1"), ("S3", "V3"): ("P4", "", None, "NBA", False, None, None, None),
    }
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    left = plan[plan.index("Join LeftOuter, (snp_list_id") :].split("\n")[1:3]
    assert not any("variant_id" in line.split("AS nba_probe_name")[-1] for line in left)
