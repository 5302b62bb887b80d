"""What a task of the context trees' counting holds, in numpy's arrays, and what the pipeline's encoder remembers."""

import tracemalloc

import numpy as np
import public_tokenizers as P
import pyarrow as pa

import corpus_pipeline
from tidemark.llm import bpe, ctw


def test_counting_holds_little():
    rng = np.random.default_rng(7)
    words = np.array(["".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(2, 9, 30_000)])
    batches = [pa.RecordBatch.from_arrays([pa.array([" ".join(rng.choice(words, 2_000)) for _ in range(200)]), pa.array(rng.random(200) < 0.8)], ["text", "train"]) for _ in range(3)]
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in ctw._counter(5)(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # two tasks share an executor's 1.2 GB beside its heap with what Python and the JVM need themselves
    assert rows > 200_000 and peak < 200 << 20, peak


def test_pipeline_encoder_holds_little(spark, monkeypatch):
    """An executor's JVM grows to some 2.6 of its 3 GB over the stages before; two encoders have to fit beside it."""
    tasks, docs = [], spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plain = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, f, schema, *a, **b: tasks.append((f, schema)) or plain(df, f, schema, *a, **b))
    done = corpus_pipeline.encode(spark, docs, "")
    assert done.columns == ["doc_id", "n_tokens", "ids"]
    run, schema = tasks[0]
    assert "decoded" not in schema
    rng = np.random.default_rng(11)
    texts = [" ".join("".join(map(chr, rng.integers(97, 123, 5))) for _ in range(2_000)) for _ in range(130)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts[k : k + 10])], ["id", "text"]) for k in range(0, 130, 10)]
    next(run(iter([batches[0].slice(0, 1)])))  # the vocabulary is there
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in run(iter(batches)))
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 130 and held < 45 << 20, held


def test_encoder_keeps_what_comes_often():
    coder = bpe.Bpe(bpe.read_ranks(None, P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN, pieces=20)
    asked, plain = [], coder.piece
    coder.piece = lambda data: asked.append(data) or plain(data)
    for k in range(200):
        coder.encode(f"often q{k}zx")
        assert len(coder.memo) + len(coder.memo.older) <= 20 and len(coder.pairs) + len(coder.older) <= 20
    assert asked.count(b"often") == 1


def test_batches_are_small(spark):
    sizes = spark.range(3_000).selectExpr("id", "repeat('abcde ', 1000) AS text").coalesce(1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in bs), "n long")
    bpe.common.small_batches(spark)
    assert max(r.n for r in sizes.collect()) < 3 << 20
