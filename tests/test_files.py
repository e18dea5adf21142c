"""Files written and read: wide matrices, VCF files, deliveries that fail, exports with a manifest."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from locusweave.operators import digests, fingerprints, vcf
from locusweave.sources import deliveries, gather, matrix, sinks, tables, vcf_files
from locusweave.streaming import incremental

GT = "chromosome string, variant_id string, position bigint, counted_allele string, alt_allele string, sample_id string, dosage double"


def text_of(path):
    return [line for f in sorted(path.iterdir()) if f.name.startswith("part-") for line in f.read_text().split("\n")[:-1]]


# matrices


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_matrix_of_all_samples(spark, tmp_path, block):
    """Every cell of every line, whatever the blocks; repeated calls, missing calls, and variants without any call."""
    rng = random.Random(block)
    samples = [f"S{i}" for i in range(11)]
    rows = [(str(1 + v % 3), f"P{v}", 10 * v, "A", None, x, rng.choice([0.0, 1.0, 2.0, None])) for v in range(7) for x in samples if rng.random() < 0.6]
    rows += [("2", "P9", 5, "A", "G", "S3", None), ("2", "P9", 5, "A", "G", "S3", 2.0), ("2", "P9", 5, "A", "G", "S3", 1.0), ("X", "none", None, "A", "G", "S0", None)]
    df = spark.createDataFrame(rows, GT)
    names = sinks.write_traw(df, str(tmp_path / "m"), block=block)
    assert names == sorted({r[5] for r in rows})
    want = {}
    for c, v, pos, a, b, x, d in rows:
        cells = want.setdefault((c, v, "0", str(pos or 0), a, b or "."), {})
        cells[x] = min([y for y in (cells.get(x), d) if y is not None], default=None)
    lines = [tuple(line.split("\t")) for line in text_of(tmp_path / "m")]
    heads = [x for x in lines if x[0] == "CHR"]
    assert set(heads) == {("CHR", "SNP", "(C)M", "POS", "COUNTED", "ALT", *names)}
    got = {x[:6]: x[6:] for x in lines if x[0] != "CHR"}
    assert got == {k: tuple("NA" if cells.get(n) is None else str(cells[n]) for n in names) for k, cells in want.items()}
    order = [(matrix_rank(x[0]), int(x[3]), x[1]) for x in lines if x[0] != "CHR"]
    assert order == sorted(order)
    back = {(r.variant_id, r.sample_id): r.dosage for r in tables.read_traw(spark, str(tmp_path / "m")).collect()}
    assert back == {(k[1], n): cells.get(n) for k, cells in want.items() for n in names}


def matrix_rank(chromosome):
    return {"X": 23}.get(chromosome) or int(chromosome)


def test_matrix_without_rows_keeps_its_header(spark, tmp_path):
    none = spark.createDataFrame([], GT)
    sinks.write_traw(none, str(tmp_path / "m"), ["S2", "S1"])
    assert set(text_of(tmp_path / "m")) == {"CHR\tSNP\t(C)M\tPOS\tCOUNTED\tALT\tS1\tS2"}
    sinks.write_carriers_wide(none, str(tmp_path / "w"), variants=["P2", "P1"])
    assert set(text_of(tmp_path / "w")) == {"IID\tP2\tP1"}
    sinks.write_traw(none, str(tmp_path / "n"))
    assert set(text_of(tmp_path / "n")) == {"CHR\tSNP\t(C)M\tPOS\tCOUNTED\tALT"}
    assert tables.read_traw(spark, str(tmp_path / "m")).count() == 0


def test_files_with_headers_of_their_own(spark, tmp_path):
    """Columns stand in another order in each file, one of them packed."""
    (tmp_path / "a.traw").write_text("CHR\tSNP\t(C)M\tPOS\tCOUNTED\tALT\tS1\tS2\n1\tP\t0\t5\tA\tG\t0\tNA\n")
    with gzip.open(tmp_path / "b.traw.gz", "wt") as f:
        f.write("CHR\tSNP\t(C)M\tPOS\tCOUNTED\tALT\tS3\tS1\n2\tQ\t0\t6\tA\tG\t2\t1\n")
    got = {(r.variant_id, r.sample_id): r.dosage for r in tables.read_traw(spark, str(tmp_path)).collect()}
    assert got == {("P", "S1"): 0.0, ("P", "S2"): None, ("Q", "S3"): 2.0, ("Q", "S1"): 1.0}


def test_names_that_no_header_can_hold(spark):
    with pytest.raises(ValueError):
        matrix.column_names(spark.createDataFrame([("a\tb",)], "x string"), "x")


def test_lines_gather_blocks_only(spark):
    """No list of all samples of a variant is gathered: cells go by block, then blocks by line."""
    df = spark.createDataFrame([], GT)
    plan = matrix.lines(df, ["variant_id"], "sample_id", "dosage", ["S1", "S2"]).select(F.md5("cells"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 2 and "__block" in plan


# VCF files

FIXED = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"


def vcf_folder(path):
    record = lambda pos, *calls: "\t".join(["chr1", str(pos), f"P{pos}", "A", "G", ".", "PASS", ".", "GT:GS", *calls])
    (path / "one.vcf").write_text("\n".join(["##fileformat=VCFv4.2", FIXED + "\tx", record(5, "0/1:0.5"), ""]) + "\n")
    with gzip.open(path / "packed.snv.vcf.gz", "wt") as f:
        f.write("\n".join([FIXED + "\ty", record(5, "1/1:0.25"), record(6, "./.:.")]) + "\n")
    (path / "two.vcf").write_text("\n".join([FIXED + "\ta\tb", record(5, "0/0:1", "0/1:0"), record(7, "1/1:1")]) + "\n")
    (path / "bare.vcf").write_text(record(5, "0/0:1") + "\n")
    (path / "twice.vcf").write_text("\n".join([FIXED + "\tz", FIXED + "\tz", record(5, "0/0:1")]) + "\n")
    (path / "only-header.vcf").write_text(FIXED + "\tq\n")
    (path / "sites.vcf").write_text("\n".join([FIXED.removesuffix("\tFORMAT"), "\t".join(["chr1", "9", "P9", "A", "G", ".", "PASS", "."])]) + "\n")


def test_states_of_vcf_files(spark, tmp_path):
    vcf_folder(tmp_path)
    lines = vcf_files.read_lines(spark, str(tmp_path))
    got = {r.IID: (r.n_samples, r.n_records, r.state) for r in vcf_files.file_states(lines).collect()}
    assert got == {
        "one": (1, 1, "ok"), "packed": (1, 2, "ok"), "two": (2, 2, "not one sample"), "bare": (0, 1, "no header"), "twice": (1, 1, "several headers"), "only-header": (1, 0, "ok"), "sites": (0, 1, "not one sample"),
    }
    metrics = sorted((r.IID, r.snpID, r.GT, r.GS) for r in vcf_files.sample_metrics(lines).collect())
    assert metrics == [("one", "P5", 1, 0.5), ("packed", "P5", 2, 0.25), ("packed", "P6", -9, None)]


def test_calls_of_many_samples_by_position(spark, tmp_path):
    """A line that is shorter than its header has no call for the samples at its end."""
    vcf_folder(tmp_path)
    lines = vcf_files.read_lines(spark, str(tmp_path))
    got = sorted((r.sample_id, r.position, r.sample) for r in vcf_files.calls(lines).collect() if r.file.endswith("two.vcf"))
    assert got == [("a", 5, "0/0:1"), ("a", 7, "1/1:1"), ("b", 5, "0/1:0")]
    assert sorted(r[0] for r in vcf_files.samples_of(lines).collect()) == ["a", "b", "q", "x", "y", "z"]


@pytest.mark.parametrize("block", [2, 1000])
def test_merge_of_sites(spark, tmp_path, block):
    """Samples of all headers, also of a file without records; absent calls; order of the sites."""
    vcf_folder(tmp_path)
    lines = vcf_files.read_lines(spark, str(tmp_path))
    calls = vcf_files.calls(lines).select(*vcf.SITE, "sample_id", F.substring_index("sample", ":", 1).alias("call"))
    vcf.merge_sites(calls, matrix.column_names(vcf_files.samples_of(lines), "sample_id"), str(tmp_path / "out"), block)
    rows = [line.split("\t") for line in text_of(tmp_path / "out")]
    assert {tuple(r) for r in rows if r[0] == "#CHROM"} == {(*FIXED.split("\t"), "a", "b", "q", "x", "y", "z")}
    assert [(r[1], *r[9:]) for r in rows if r[0] != "#CHROM"] == [("5", "0/0", "0/1", "./.", "0/1", "1/1", "0/0"), ("6", *["./."] * 6), ("7", "1/1", *["./."] * 5)]


# deliveries, gathering, digests

CALLS = "data_type string, k string, v double"


def delivery(spark, inbox):
    rows = lambda n: spark.range(n).selectExpr("'NBA' AS data_type", "concat('k', id) AS k", "CAST(id AS DOUBLE) AS v")
    rows(3).write.parquet(f"{inbox}/a")
    rows(0).write.parquet(f"{inbox}/b")
    spark.range(2).selectExpr("'PAR1 but no table' AS value").write.text(f"{inbox}/c")
    rows(2).write.parquet(f"{inbox}/unplanned")
    return spark.createDataFrame([("NBA", x) for x in "abcd"], "data_type string, file string"), rows


def test_states_of_a_delivery(spark, tmp_path):
    planned, _ = delivery(spark, str(tmp_path / "in"))
    got = {r.file: (r.n_rows, r.state) for r in deliveries.states(spark, planned, str(tmp_path / "in"), CALLS).collect()}
    assert got == {"a": (3, "ok"), "b": (0, "empty"), "c": (0, "failed"), "d": (0, "absent")}


def test_retry_reads_what_failed_only(spark, tmp_path, monkeypatch):
    inbox, store = str(tmp_path / "in"), str(tmp_path / "store")
    planned, rows = delivery(spark, inbox)
    log = deliveries.attempt(spark, planned, inbox, CALLS, store, 0)
    rows(5).write.parquet(f"{inbox}/d")
    rows(1).write.mode("overwrite").parquet(f"{inbox}/b")
    read, tolerant = [], deliveries.tolerant
    monkeypatch.setattr(deliveries, "tolerant", lambda s, i, c, names=None: (read.append(names), tolerant(s, i, c, names))[1])
    again = deliveries.retry(spark, log, inbox, CALLS, store, 1)
    assert [n for n in read if n is not None] == [["b", "d"]]
    assert {r.file: r.state for r in again.collect()} == {"b": "ok", "c": "failed", "d": "ok"}
    assert spark.read.parquet(f"{store}/version=0").count() == 3 and spark.read.parquet(f"{store}/version=1").count() == 6
    third = deliveries.retry(spark, again, inbox, CALLS, store, 2)
    assert [tuple(r) for r in third.select("file", "state").collect()] == [("c", "failed")]


def test_gather_keeps_order_and_reports_failures(spark, tmp_path):
    shards = [(r, "1" if r < 2 else "2", p, f"{r}-{p}") for r in range(3) for p in range(r * 100 + 50, r * 100, -1)] + [(3, "9", 1, "elsewhere")]
    df = spark.createDataFrame(shards, "region int, chromosome string, position long, value string").repartition(4)
    regions = spark.createDataFrame([(0, "1", 0, 99), (1, "1", 100, 199), (2, "2", 200, 299), (3, "3", 0, 99), (4, "4", 0, 9)], "region int, chromosome string, start long, end long")
    path = tmp_path / "out"
    manifest = gather.ordered_gather(df, regions, str(path))
    assert {r.region: (r.n_rows, r.state) for r in manifest.collect()} == {0: (50, "ok"), 1: (50, "ok"), 2: (50, "ok"), 3: (1, "failed"), 4: (0, "empty")}
    lines = text_of(path)
    assert lines == [f"{r}-{p}" for r in range(3) for p in range(r * 100 + 1, r * 100 + 51)]
    key = F.struct(F.split("value", "-")[0].cast("int"), F.split("value", "-")[1].cast("int"))
    assert gather.order_breaks(spark, str(path), key).agg(F.sum("n_breaks"), F.sum("n_lines")).first()[:] == (0, 150)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0").write_text("0-1\n0-3\n0-2\n")
    (tmp_path / "bad" / "part-1").write_text("0-1\n")
    assert gather.order_breaks(spark, str(tmp_path / "bad"), key).agg(F.sum("n_breaks")).first()[0] == 2


def test_digest_streams_over_batches(spark):
    """The digest of a key that spans many batches is that of its pieces joined."""
    df = spark.range(4000).selectExpr("concat('s', id % 3) AS k", "id", "concat('p', id) AS p").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {r.k: (r.hash, r.n_sites) for r in digests.ordered_md5(df, "k", [-F.col("id")], "p").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for j in range(3):
        ids = [i for i in range(3999, -1, -1) if i % 3 == j]
        assert got[f"s{j}"] == (hashlib.md5("".join(f"p{i}" for i in ids).encode()).hexdigest(), len(ids))


def test_groups_are_rows(spark):
    prints = spark.createDataFrame([("a", "x", 1), ("b", "x", 1), ("c", "y", 1)], "sample_id string, hash string, n_sites long")
    assert sorted(map(tuple, fingerprints.members(prints).collect())) == [("a", "x", 2), ("b", "x", 2)]


def test_chromosomes_are_written_by_ranges(spark, tmp_path):
    df = spark.range(20_000).selectExpr("if(id % 10 = 0, '2', '1') AS chromosome", "id AS position")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.write_by_chromosome(df, str(tmp_path / "c"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(list((tmp_path / "c" / "chromosome=1").glob("part-*"))) > 1 and spark.read.parquet(str(tmp_path / "c")).count() == 20_000


def test_store_is_compacted_by_its_versions(spark, tmp_path):
    store = str(tmp_path / "store")
    for n in range(4):
        incremental.write_version(spark.range(n + 1).selectExpr("id", f"CAST({n} AS DOUBLE) AS dosage"), store, n)
    assert incremental.versions(spark, store) == [0, 1, 2, 3] and incremental.settled(spark, store, f"{store}-new", ["id"], 4) == store
    assert incremental.settled(spark, store, f"{store}-new", ["id"], 3) == f"{store}-new" and incremental.versions(spark, f"{store}-new") == [3]
    same = [sorted(map(tuple, incremental.latest(spark, s, ["id"]).collect())) for s in (store, f"{store}-new")]
    assert same[0] == same[1] == [(i, 3.0) for i in range(4)]
    spark.range(1).write.parquet(f"{store}/version=9")  # a version that broke off
    assert incremental.versions(spark, store) == [0, 1, 2, 3]


# matrices that are packed


def test_matrix_texts_are_made_after_the_order_and_packed(spark, tmp_path):
    """Of a sparse matrix neither the shuffles nor the files hold its size: 300 lines of 20,000 columns are 18 MB of text."""
    rows = spark.range(300).selectExpr("'1' AS chromosome", "concat('P', id) AS variant_id", "id AS position", "'A' AS counted_allele", "'G' AS alt_allele", "concat('S', id) AS sample_id", "1.0D AS dosage")
    names = sinks.write_traw(rows, str(tmp_path / "m"), [f"S{i}" for i in range(20_000)], codec="gzip")
    files = list((tmp_path / "m").glob("part-*.gz"))
    assert files and sum(f.stat().st_size for f in files) < 1_000_000
    lines = [line.split("\t") for f in sorted(files) for line in gzip.open(f, "rt").read().split("\n")[:-1]]
    body = [x for x in lines if x[0] != "CHR"]
    assert len(body) == 300 and all(len(x) == 20_006 for x in lines) and all(x[6 + names.index(f"S{x[1][1:]}")] == "1.0" and x[6:].count("NA") == 19_999 for x in body)
    assert tables.read_traw(spark, str(tmp_path / "m"), missing=False).count() == 300
    calls = spark.range(5).selectExpr("'1' AS chromosome", "id AS position", "'A' AS ref", "'G' AS alt", "concat('S', id) AS sample_id", "'0/1' AS call")
    vcf.merge_sites(calls, [f"S{i}" for i in range(5)], str(tmp_path / "v"), codec="gzip")
    assert vcf_files.calls(vcf_files.read_lines(spark, str(tmp_path / "v")), "./.").count() == 5


def test_cells_of_lines_by_their_place(spark, monkeypatch):
    """Fields by place, lines with fewer fields than others, empty fields at a line's end, and slices of one line each."""
    monkeypatch.setattr(matrix, "SLICE", 1)
    lines = spark.createDataFrame([("a", "x\ty\tNA\t1\tNA"), ("a", "p\tq\t2\t\t"), ("b", "alone"), ("b", "r\ts\tNA")], "file string, value string").coalesce(1)
    all_cells = {(r.file, r.first, r.second, r.at, r.cell) for r in matrix.cells_of(lines, ["first", "second"]).collect()}
    assert all_cells == {("a", "x", "y", 2, "NA"), ("a", "x", "y", 3, "1"), ("a", "x", "y", 4, "NA"), ("a", "p", "q", 2, "2"), ("a", "p", "q", 3, ""), ("a", "p", "q", 4, ""), ("b", "r", "s", 2, "NA")}
    assert {(r.first, r.at, r.cell) for r in matrix.cells_of(lines, ["first"], "NA").collect()} == {("x", 1, "y"), ("x", 3, "1"), ("p", 1, "q"), ("p", 2, "2"), ("p", 3, ""), ("p", 4, ""), ("r", 1, "s")}
    assert [r.second for r in matrix.cells_of(spark.createDataFrame([("one",)], "value string"), ["first", "second"]).collect()] == []


def test_cells_are_counted_in_their_text(spark):
    texts = spark.createDataFrame([("NA\tNA\t1\tNA",), ("NAN\tNA",), ("",), ("NA",), ("\t",)], "cells string")
    found = texts.select(matrix.n_cells(F.col("cells")).alias("n"), matrix.n_equal(F.col("cells"), "NA").alias("m")).collect()
    assert [(r.n, r.m) for r in found] == [(4, 3), (2, 1), (1, 0), (1, 1), (2, 0)]


def test_sparse_matrix_is_written_by_many_tasks_and_read_without_shuffling_its_lines(spark, tmp_path):
    """A matrix whose gathered cells are small has many cells all the same: as many files as shuffles have partitions, and lines that stay where they are read."""
    rows = spark.range(400).select(F.format_string("v%03d", "id").alias("v"), F.format_string("s%03d", F.col("id") % 50).alias("s"), F.lit("1").alias("x"))
    matrix.write(rows, ["v"], "s", "x", [f"s{i:03d}" for i in range(50)], {"V": F.col("v")}, str(tmp_path / "m"), [F.col("v")], codec="gzip")
    assert len(list((tmp_path / "m").glob("part-*"))) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        back = matrix.read(spark, str(tmp_path / "m"), "V\t", ["v"], "s", "x", "NA")
        assert {(r.v, r.s, r.x) for r in back.collect()} == {(r.v, r.s, r.x) for r in rows.collect()}
        plan = back._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "strategy=broadcast" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_digests_of_lines(spark):
    """Number of cells and of missing ones beside each other, and the digest of their text; fields before them that are empty or absent."""
    texts = {"a": "NA\tNA\t1\tNA", "b": "NAN\tNA", "c": "", "d": "NA", "e": "\t", "f": "ä\tNA"}
    lines = spark.createDataFrame([(f"{k}\t\t{v}",) for k, v in texts.items()] + [("alone",), ("",)], "value string")
    got = {r.x: (r.y, r.n_cells, r.n_missing, r.md5) for r in matrix.digests(lines, ["x", "y"], "NA").collect()}
    md5 = lambda v: hashlib.md5(v.encode()).hexdigest()
    want = {k: ("", v.count("\t") + 1, v.split("\t").count("NA"), md5(v)) for k, v in texts.items()}
    assert got == want | {"alone": (None, 1, 0, md5("")), "": (None, 1, 0, md5(""))}


@pytest.mark.parametrize("block", [3, 1000])
def test_lines_of_a_wide_matrix(spark, tmp_path, block):
    """Runs of missing cells at both ends and between, the least of several values, a line without values, columns that aren't named; the texts of lines and files agree, and no expression makes a text by cell."""
    names = [f"s{i:04d}" for i in range(2500)]
    cells = [("v1", "s0000", "2"), ("v1", "s0999", "1"), ("v1", "s1000", "7"), ("v1", "s1000", "3"), ("v2", "s2499", "ö"), ("v3", "s0004", None), ("v3", "other", "1")]
    rows = spark.createDataFrame(cells, "v string, s string, x string")
    want = {}
    for v, s, x in cells:
        line = want.setdefault(v, ["NA"] * len(names))
        if x is not None and s in names:
            i = names.index(s)
            line[i] = x if line[i] == "NA" else min(x, line[i])
    assert {r.v: r.cells.split("\t") for r in matrix.lines(rows, ["v"], "s", "x", names, block=block).collect()} == want
    assert "MapInArrow" in matrix.lines(rows, ["v"], "s", "x", names)._jdf.queryExecution().optimizedPlan().toString()
    matrix.write(rows, ["v"], "s", "x", names, {"V": F.col("v")}, str(tmp_path / "m"), [F.col("v")], block=block)
    files = [f.read_text().split("\n")[:-1] for f in sorted((tmp_path / "m").glob("part-*")) if f.stat().st_size]
    assert all(f[0].split("\t") == ["V", *names] for f in files)
    assert [(x.split("\t")[0], x.split("\t")[1:]) for f in files for x in f[1:]] == sorted(want.items())


def test_column_order_needs_no_lines(spark, sf_dir, monkeypatch):
    """The header alone is written, and it is that of the whole matrix."""
    from locusweave.plans import queries_files
    from locusweave.sources import shared
    from locusweave.sources.fixtures import Fixtures

    folders, new_folder = [], shared.new_folder
    monkeypatch.setattr(shared, "new_folder", lambda s, name: (folders.append(new_folder(s, name)), folders[-1])[1])
    order = [r.name for r in queries_files.column_order(Fixtures(spark, sf_dir)).orderBy("place").collect()]
    assert [r.value.split("\t") for r in spark.read.text(folders[-1]).collect()] == [order]
    sinks.write_traw(queries_files.corrected(Fixtures(spark, sf_dir)).where("data_type = 'NBA'"), f"{folders[-1]}-whole", codec="gzip")
    heads, _ = matrix.split_files(spark, f"{folders[-1]}-whole", "CHR\tSNP\t")
    assert {tuple(r.value.split("\t")) for r in heads.collect()} == {tuple(order)}


# matrices that are nearly empty


def sparse(n, cells, missing="NA"):
    """The texts of a line's ``n`` cells, of which ``cells`` has those that aren't missing."""
    found = [missing] * n
    for at, x in cells.items():
        found[at] = x
    return found


#: Runs that just are and just aren't as long as those that are copied or read at once, next to each other and at both ends; cells that begin or end like missing ones; no cell at all.
SPARSE = [
    {}, {0: "1"}, {19_999: "2"}, {127: "1", 128: "2", 257: "NAN", 386: "XNA"}, {1023: "1", 2048: "2", 3073: ""}, {i: str(i) for i in range(9000)}, {129 * 64: "1", 129 * 64 * 2 + 1: "ö", 9998: "NAN"}, {1024 * k: "7" for k in range(9)},
]


def test_runs_are_copied_and_counted(spark, tmp_path):
    """Written lines and their digests hold every cell, and no Python makes or counts them."""
    names = [f"s{i:05d}" for i in range(20_000)]
    rows = [(f"v{i}", names[at], x) for i, cells in enumerate(SPARSE) for at, x in cells.items()] + [("v0", names[3], None)]
    matrix.write(spark.createDataFrame(rows, "v string, s string, x string"), ["v"], "s", "x", names, {"V": F.col("v")}, str(tmp_path / "m"), [F.col("v")], codec="gzip")
    _, rest = matrix.split_files(spark, str(tmp_path / "m"), "V\t")
    found = matrix.digests(rest, ["v"], "NA")
    got = {r.v: (r.n_cells, r.n_missing, r.md5) for r in found.collect()}
    assert got == {f"v{i}": (20_000, 20_000 - len(cells), hashlib.md5("\t".join(sparse(20_000, cells)).encode()).hexdigest()) for i, cells in enumerate(SPARSE)}
    assert "MapInArrow" not in found._jdf.queryExecution().optimizedPlan().toString()
    files = [gzip.open(f, "rt").read().split("\n")[:-1] for f in sorted((tmp_path / "m").glob("part-*"))]
    assert all(f[0].split("\t") == ["V", *names] for f in files if f) and sum(len(f) - 1 for f in files if f) == len(SPARSE)


def test_long_runs_of_missing_cells_are_read_as_runs(spark):
    """Each cell by its place, whatever the runs before it; a line whose fields in front of its cells are missing, too."""
    wide = [(f"f{i}", "\t".join([f"v{i}", "NA" if i % 2 else "x", *sparse(20_000, cells)])) for i, cells in enumerate(SPARSE)]
    lines = spark.createDataFrame(wide, "file string, value string").coalesce(1)
    got = {(r.file, r.v, r.w, r.at - 2, r.cell) for r in matrix.cells_of(lines, ["v", "w"], "NA").collect()}
    assert got == {(f"f{i}", f"v{i}", "NA" if i % 2 else "x", at, x) for i, cells in enumerate(SPARSE) for at, x in cells.items()}
    short = spark.createDataFrame([("v\t" + "\t".join(sparse(600_000, {300_000: "1"})),)], "value string").select(F.length(matrix._squeezed(F.col("value"), "NA", 1)))
    assert short.first()[0] < 5_000


def test_packed_matrix_is_read_once(spark, tmp_path):
    """Packed files by one pass, without joins and with names from the header of each file; also of a file without one, and of several files in a task. Plain files beside them."""
    files = {"a": (["s1", "s2", "s3"], [["1", "NA", "2"], ["NA", "NA", "NA"]]), "b": (["s3", "s1"], [["5", "6", "beyond"], ["7"]]), "c": (None, [["8", "9"]]), "d": (["s9"], [["NA"], ["4"]])}
    want = set()
    for name, (header, rows) in files.items():
        text = "".join("\t".join(x) + "\n" for x in ([["V", *header]] if header else []) + [[f"{name}{i}", *cells] for i, cells in enumerate(rows)])
        (gzip.open(tmp_path / f"{name}.gz", "wt") if name != "d" else open(tmp_path / f"{name}.txt", "w")).write(text)
        want |= {(f"{name}{i}", s, x) for i, cells in enumerate(rows) for s, x in zip(header or [], cells) if x != "NA"}
    assert {(r.v, r.s, r.x) for r in matrix.read(spark, str(tmp_path), "V\t", ["v"], "s", "x", "NA").collect()} == want
    lines = spark.read.text(str(tmp_path / "*.gz")).select("value", F.col("_metadata.file_path").alias("file")).coalesce(1)
    once = matrix.named_cells(lines, "V\t", ["v"], "s", "x", "NA")
    assert {(r.v, r.s, r.x) for r in once.collect()} == {x for x in want if x[0][0] != "d"}
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_contents_of_vcf_files_in_one_pass(spark, tmp_path):
    """Calls, records and samples of packed files, read once, are those of the same files unpacked."""
    vcf_folder(tmp_path)
    with gzip.open(tmp_path / "wide.vcf.gz", "wt") as f:
        f.write("\n".join(["##x", "\t".join([FIXED, *(f"w{i}" for i in range(2000))]), "", "  ", *("\t".join(["chr2", str(p), "P", "A", "G", ".", ".", ".", "GT", *sparse(2000, {p: "0/1"}, "./.")]) for p in (5, 1999)), "\t".join(["chr3", "x", "P", "A"])]) + "\n")
    (tmp_path / "plain").mkdir()
    (tmp_path / "packed").mkdir()
    for f in list(tmp_path.glob("*.vcf*")):
        text = (gzip.open(f, "rt") if f.name.endswith("gz") else open(f)).read()
        (tmp_path / "plain" / f.name.removesuffix(".gz")).write_text(text)
        gzip.open(tmp_path / "packed" / (f.name.removesuffix(".gz") + ".gz"), "wt").write(text)
    got = [sorted(map(str, vcf_files.contents(vcf_files.read_lines(spark, str(tmp_path / k)), "./.").distinct().collect())) for k in ("plain", "packed")]
    assert got[0] == got[1]
    found = vcf_files.contents(vcf_files.read_lines(spark, str(tmp_path / "packed")), "./.")
    assert sorted((r.position, r.sample_id) for r in found.where("chromosome = '2' AND sample IS NOT NULL").collect()) == [(5, "w5"), (1999, "w1999")]
    assert [r[:] for r in found.where("chromosome = '3'").collect()] == [("3", None, "A", None, None, None)]
    assert sorted({r[0] for r in found.where("chromosome IS NULL").select("sample_id").collect()} - {f"w{i}" for i in range(2000)}) == ["a", "b", "q", "x", "y", "z"]
