"""The pipeline against what its stages decide, and against planted cases."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from locusweave.llm import exact_dedup, mixing, near_dedup, toxicity


def test_stages_on_their_own_inputs(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ids = lambda df: Counter(r.doc_id for r in df.select("doc_id").collect())
    outs = []
    for i, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < len(pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{i}")
        outs.append((docs, spark.read.parquet(f"{tmp_path}/{i}")))
        docs = outs[-1][1]
    before, after = outs[0]
    assert ids(after) == Counter(r.doc_id for r in toxicity.score(before, labels).where("predicted = 0").collect())
    before, after = outs[1]
    assert ids(after) == Counter(r.doc_id for r in exact_dedup.dedup(before).where("kept").collect())
    before, after = outs[2]
    assert ids(after) == Counter(r.doc_id for r in near_dedup.near_duplicates(before).where("kept").collect())
    before, after = outs[3]
    assert set(ids(after)) == set(ids(before))
    before, after = outs[4]
    assert sum(r.length for r in after.collect()) == sum(n * r for n, r in ((x.doc_tokens, ids(before)[x.doc_id]) for x in after.select("doc_id", "doc_tokens").distinct().collect()))
    assert pipeline.run(spark, sf_dir).select("doc_id").distinct().count() == len(ids(before))
    assert mixing.labelled_domains(before, labels).count() > 0


CLASHES = ("__size", "__keep_id", "__n", "__class", "__h", "__sha", "__doc", "__kept", "__node", "__copy", "row", "n", "h", "node", "lead", "times", "keep_id", "n_keep", "text_sha256", "class_id", "class_size", "root", "u", "order", "score")


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows, near texts of one id, and columns named as stages name theirs."""
    near = " ".join(f"word{i} thing{i * 7 % 90}" for i in range(300))
    data = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", None, 3), (3, " \n\t", None, "s", 3), (4, "long words " * 20_000, "en", "s", None), (5, near, "de", "s", 1), (5, near + " end", "de", "s", 1)]
    data += [(6, "same row here", "en", "s", 1)] * 3 + [(None, "no id at all", "fr", "s", 2)] * 2 + [(7, "same row here", "en", "t", 1), (8, "\x00 odd \ud7ff text", "en", "s", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce("source", F.lit("?"))) for c in CLASHES}).cache()


def stages(labels):
    domains = labels.select("doc_id", F.col("quality").cast("string").alias("domain"))
    return {"toxicity": lambda d: toxicity.keep_clean(d, labels), "exact": exact_dedup.keep_one, "near": near_dedup.keep_one, "mixing": lambda d: mixing.resampled(d, domains, min_rate=1.0)}


@pytest.mark.parametrize("stage", ["toxicity", "exact", "near", "mixing"])
def test_stages_keep_odd_rows_whole(spark, odd_docs, stage):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (6, 1, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    out = stages(labels)[stage](odd_docs)
    assert out.columns == odd_docs.columns and out.dtypes == odd_docs.dtypes
    before, after = Counter(map(tuple, odd_docs.collect())), Counter(map(tuple, out.collect()))
    assert set(after) <= set(before)  # every row is one of the input's, in all its columns
    texts = lambda rows: {r[1] or "" for r in rows}
    if stage == "exact":
        assert texts(after) == texts(before) and sum(after.values()) == len(texts(before))
        assert {r[0] for r in after if r[1] == "same row here"} == {7}
    if stage == "near":
        assert sum(after.values()) == len(texts(before)) - 1 and sum(r[0] == 5 for r in after) == 1
    if stage in ("toxicity", "mixing"):
        assert set(after) == set(before)


@pytest.mark.parametrize("stage", ["toxicity", "exact", "near", "mixing"])
def test_stages_take_empty_tables(spark, odd_docs, stage):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = stages(labels)[stage](odd_docs.where("false"))
    assert out.columns == odd_docs.columns and out.count() == 0
