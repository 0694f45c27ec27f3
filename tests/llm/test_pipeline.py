"""The pipeline: every stage on what the one before kept, and its decisions in effect."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from bidtrail import session
from bidtrail.llm import mixing, quality, repeats, simhash
from bidtrail.session import stored
from tests.llm.test_copies import plain_kept

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF)))
    return out


def test_stages_return_documents(steps):
    assert all(s.columns == pipeline.COLUMNS and s.dtypes == steps[0].dtypes for s in steps[:-1])


def test_decisions_take_effect(spark, steps):
    docs, good, single, cut, mixed, packed = steps
    scored = quality.score(docs, quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    assert sorted(r[0] for r in good.select("doc_id").collect()) == sorted(r[0] for r in scored.where("predicted = 1").select("doc_id").collect())
    kept = plain_kept([(r["doc_id"], r["text"]) for r in good.collect()])
    assert sorted(r[0] for r in single.select("doc_id").collect()) == kept
    classes = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(good).collect()}
    assert set(kept) <= set(classes.values())  # what 3 bits link is alike; the stage finds more
    left = {r["doc_id"]: r["kept_sha256"] for r in repeats.remove_repeats(single).where("n_removed < n_bytes OR n_bytes = 0").collect()}
    assert {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in cut.collect()}.keys() <= left.keys()
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(cut).collect() if r["taken"]}
    assert {r[0]: r[1] for r in mixing.with_sizes(mixed).groupBy("doc_id").agg(F.sum("size")).collect()} == taken
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    tokens = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert packed.agg(F.sum("length")).first()[0] == tokens


def test_clean_documents_stay(spark, steps):
    docs, good = steps[:2]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    clean = docs.join(labels.where("quality = 1"), "doc_id").select("doc_id")
    assert clean.join(good, "doc_id", "left_anti").count() <= 0.02 * clean.count()


def test_run_and_registration(spark, steps):
    assert pipeline.run(spark, SF).agg(F.sum("length")).first() == steps[-1].agg(F.sum("length")).first()
    assert "pipeline" in entry.queries() and sum(q.startswith("op") for q in entry.queries()) == 13


def test_run_leaves_its_last_table(spark, tmp_path, monkeypatch):
    """All tables of all stages stayed, more than twice the input."""
    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path / "shared"))
    rows = [(i, " ".join(f"word{(i // 2) * 7 + k * k % 41} and" for k in range(60)), "en", "web" if i % 3 else None, 0) for i in range(40)]
    spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema).withColumn("n_chars", F.length("text").cast("bigint")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in range(10)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    packed = pipeline.run(spark, str(tmp_path))
    (left,) = (tmp_path / "shared" / "bidtrail").iterdir()
    assert spark.read.parquet(str(left)).columns == pipeline.COLUMNS and packed.count() >= 0


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
    assert docs.count() == 0
