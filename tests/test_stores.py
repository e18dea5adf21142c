"""JSON reports, databases, constraints, buckets and exports."""

import json

import pytest
from pyspark.sql import functions as F

from locusweave.operators import constraints
from locusweave.plans import queries_stores
from locusweave.sources import bucketed, exports, json_tables, tables
from locusweave.sources.fixtures import Fixtures

REPORT = {
    "rows": [{"a": 1, "b": {"c": [1, {"d": "x"}]}}, {"a": None}, {}],
    "columns": {"x": {"r1": 1.5, "r2": True}, "y z": {"r1": "1"}},
    "lists": {"p": [1, 2], "q": ["s", None]},
    "single": [3, "t"],
    "empty": [],
    "note": "v.1",
    "none": None,
}


def paths_of(value, at=""):
    """All key paths by hand."""
    out = []
    if isinstance(value, dict):
        for k, v in value.items():
            path = f"{at}.{k}" if at else k
            out += [path, *paths_of(v, path)]
    elif isinstance(value, list):
        for i, v in enumerate(value):
            out += paths_of(v, f"{at}[{i}]")
    return out


@pytest.fixture(scope="module")
def report(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("json")
    (path / "r.json").write_text(json.dumps(REPORT, indent=1))
    return json_tables.documents(spark, str(path))


def test_key_paths_of_nested_json(report):
    rows = json_tables.key_paths(report).collect()
    assert sorted(r.path for r in rows) == sorted(paths_of(REPORT))
    kinds = {r.path: (r.kind, r.depth) for r in rows}
    assert kinds["rows"] == ("array", 1) and kinds["rows[0].b.c[1].d"] == ("string", 6) and kinds["rows[1].a"] == ("null", 3) and kinds["columns.x.r2"] == ("boolean", 3) and kinds["columns.x"] == ("object", 2)


def test_cells_of_all_layouts(report):
    got = {(r.name, r.row, r.column): r.value for r in json_tables.cells(report).collect()}
    assert got == {
        ("rows", "0", "a"): "1", ("rows", "0", "b"): '{"c":[1,{"d":"x"}]}', ("rows", "1", "a"): None,
        ("columns", "r1", "x"): "1.5", ("columns", "r2", "x"): "true", ("columns", "r1", "y z"): "1",
        ("lists", "0", "p"): "1", ("lists", "1", "p"): "2", ("lists", "0", "q"): "s", ("lists", "1", "q"): None, ("single", "0", "0"): "3", ("single", "1", "0"): "t",
    }


def test_one_file_a_table(spark, report, tmp_path):
    out = json_tables.write_tables(report, str(tmp_path))
    assert {n: c for n, (_, c) in out.items()} == {"rows": ["a", "b"], "columns": ["x", "y z"], "lists": ["p", "q"], "single": ["0"]}
    read = spark.read.option("header", True).csv(out["columns"][0])
    assert [tuple(r) for r in read.collect()] == [("1.5", "1"), ("true", None)]


def test_json_without_keys(spark, tmp_path):
    (tmp_path / "r.json").write_text("3")
    docs = json_tables.documents(spark, str(tmp_path))
    assert json_tables.key_paths(docs).count() == 0 and json_tables.cells(docs).count() == 0


# a database


def test_database_is_read_in_ranges_with_its_filters(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    url, table = queries_stores.tracker(fx)
    rows = tables.read_cohort_jdbc(spark, url, table, "number", 5, driver=queries_stores.DERBY)
    found = rows.where("extended_clinical_data = 1 AND age_of_onset > 50").select("sample_id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "numPartitions=5" in plan and "PushedFilters: [*" in plan and "EqualTo(extended_clinical_data,1)" in plan and "ReadSchema: struct<sample_id:string>" in plan
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 5 and sum(r["count"] for r in sizes) == fx.sample.count()
    rows.limit(0).write.mode("overwrite").option("driver", queries_stores.DERBY).jdbc(url, "NOTHING")
    assert tables.read_cohort_jdbc(spark, url, "NOTHING", "number", driver=queries_stores.DERBY).count() == 0


# constraints


def test_every_kind_of_violation(spark):
    left = spark.createDataFrame([("a", "1", None), ("a", "x", "u"), ("b", None, "v"), (None, "2", "w")], "id string, n string, ref string")
    right = spark.createDataFrame([("u",), ("v",)], "k string")
    got = constraints.violations(
        constraints.Table("left", left, required=("id", "gone"), types={"n": "int", "gone": "int"}, not_null=("id", "gone"), unique=(("id",), ("gone",)), references=(("ref", "right", "k"), ("gone", "right", "k"))),
        constraints.Table("right", right, required=("k",), not_null=("k",), unique=(("k",),)),
    )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [("left", "absent column", "gone", None, 0), ("left", "null", "id", None, 1), ("left", "not int", "n", "x", 1), ("left", "not unique", "id", "a", 2), ("left", "not in right", "ref", "w", 1)], key=repr
    )


def test_sound_tables_have_no_violation(spark):
    df = spark.createDataFrame([], "id string")
    assert constraints.violations(constraints.Table("t", df, required=("id",), types={"id": "int"}, not_null=("id",), unique=(("id",),), references=(("id", "t", "id"),))).count() == 0


def test_values_take_one_pass(spark):
    df = spark.createDataFrame([], "a string, b string")
    plan = constraints._values(constraints.Table("t", df, types={"a": "int", "b": "double"}, not_null=("a", "b")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 1 and "Join" not in plan


# buckets


def test_buckets_need_no_exchange(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = bucketed.store(spark.range(500).selectExpr("CAST(id % 40 AS STRING) AS sample_id", "CAST(id % 3 AS STRING) AS chromosome", "id AS v"), "rows", 4, "sample_id")
        other = bucketed.store(spark.range(40).selectExpr("CAST(id AS STRING) AS sample_id", "id * 2 AS w"), "other", 4, "sample_id")
        merged = bucketed.outer_merge(rows, "sample_id", "chromosome", ["0", "1", "2", "9"], F.lit(1))
        joined = rows.join(other, "sample_id")
        for df in (merged, joined):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 500
        got = {r.sample_id: tuple(r)[1:] for r in merged.collect()}
        want = {str(s): tuple(sum(1 for i in range(500) if i % 40 == s and i % 3 == c) or None for c in (0, 1, 2, 9)) for s in range(40)}
        assert got == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# exports


def test_manifest_names_what_was_written(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "CAST(id % 2 AS STRING) AS part")
    export = exports.Export(spark, str(tmp_path / "e"))
    export.add("a", df)
    export.add("b", df, "csv", "part")
    export.add("c", df, "json")
    export.add("d", df.limit(0), "parquet")
    export.add("e", df, "tsv")
    export.manifest()
    assert sorted(map(tuple, export.read_back().collect())) == [("a", "csv", 10, 10), ("b", "csv", 10, 10), ("c", "json", 10, 10), ("d", "parquet", 0, 0), ("e", "tsv", 10, 10)]
