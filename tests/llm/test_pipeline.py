"""The corpus pipeline, stage by stage, and the registered queries."""

from __future__ import annotations

import os
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from serieslake.llm import ORACLES, QUERIES
from serieslake.llm.common import BATCH_BYTES, TEXT_ROWS, digest_of, select_rows, table

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables not present")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_stages(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert all(r == rows[r.doc_id] for r in kept[-1])
    good, distinct, near, mixed, encoded = kept
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    ids = {r.doc_id for r in good}
    wrong = [i for i, q in labels.items() if i in rows and (i in ids) != (q == 1)]
    assert len(wrong) <= 0.02 * len(labels)
    latest = {}
    for r in good:
        latest[r.text] = max(latest.get(r.text, -1), r.doc_id)
    assert {r.doc_id for r in distinct} == set(latest.values())
    sets = [shingles(r.text) for r in near]
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            assert not both or 100 * both < 80 * len(sets[a] | sets[b])
    alone = {r.doc_id for r in distinct} - {r.doc_id for r in near}
    near_sets = {r.doc_id: s for r, s in zip(near, sets)}
    everything = {r.doc_id: shingles(r.text) for r in distinct}
    for i in alone:  # what went had a link
        own = everything[i]
        assert any(
            100 * len(own & s) >= 80 * len(own | s) for j, s in everything.items() if j != i
        )
    words = sum(len((r.text or "").split()) for r in near)
    taken = sum(len((r.text or "").split()) for r in mixed)
    assert {r.doc_id for r in mixed} <= set(near_sets) and 1.2 * words < taken < 1.7 * words
    assert sorted(r.doc_id for r in encoded) == sorted(r.doc_id for r in mixed)
    assert all(r.n_tokens == len(r.ids) > 0 for r in encoded)


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = table(spark, FOLDER, "documents").where("false")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() == 0


def test_every_operator_has_a_query():
    numbers = {int(re.match(r"op(\d+)_", name).group(1)) for name in QUERIES}
    assert numbers == set(range(1, 11)) and set(ORACLES) <= set(QUERIES)


def test_quality_stage_scores_few_texts_at_a_time(spark, monkeypatch):
    """The scorer is handed no more texts at once than ``small_batches`` allows."""

    def widest(docs, model, text_column="text"):
        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            return pa.array([1.0 if len(texts) <= TEXT_ROWS else 0.0] * len(texts))

        return score(F.col(text_column))

    monkeypatch.setattr(corpus_pipeline.quality, "score_column", widest)
    docs = spark.range(3 * TEXT_ROWS, numPartitions=1).selectExpr("id AS doc_id", "'some words' AS text")
    assert corpus_pipeline.keep_quality(spark, docs, FOLDER).count() == 3 * TEXT_ROWS


def test_encoding_stage_takes_texts_by_bytes(spark, monkeypatch):
    """The encoder is handed few long texts at once, and many short ones."""

    def sizes(docs, path):
        def measure(batches):
            for batch in batches:
                size = [[batch.num_rows, batch.nbytes]] * batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size, pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

        return docs.select("doc_id", "text").mapInArrow(measure, "doc_id long, ids array<int>")

    monkeypatch.setattr(corpus_pipeline.pieces, "encode_documents", sizes)
    for length, rows in ((20_000, 900), (2, 5000)):
        docs = spark.range(rows, numPartitions=1).selectExpr("id AS doc_id", f"repeat('x', {length}) AS text")
        found = [r.ids for r in corpus_pipeline.encode(spark, docs, FOLDER).collect()]
        assert len(found) == rows and max(size for _, size in found) <= 1.5 * BATCH_BYTES
        assert length > 2 or found[0][0] == rows


def test_quality_stage_writes_no_copy_of_the_texts(spark, monkeypatch):
    names = []
    monkeypatch.setattr(corpus_pipeline, "cut_lineage", lambda frame, name: names.append(name) or frame)
    docs = table(spark, FOLDER, "documents")
    kept = corpus_pipeline.keep_quality(spark, docs, FOLDER)
    assert "kept" not in names and 0 < kept.count() <= docs.count()


def test_rows_are_selected_with_one_shuffle_of_the_texts(spark):
    docs = table(spark, FOLDER, "documents")
    plan = docs.select("doc_id", digest_of().alias("digest"), F.lit(1).alias("copies"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = select_rows(docs, plan)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") <= 3
