"""Workers give memory back between batches, and match few new stretches at a time."""

import pyarrow as pa

from quern.llm import pieces


def test_new_stretches_are_matched_a_few_at_a_time(monkeypatch):
    vocabulary = pieces.Vocabulary()
    texts = pa.array([f"word{i} 日本{i}  x{i * 7919}" for i in range(300)] + ["", "a" * 700, None])
    want = pieces.Encoder(vocabulary).encode(texts).to_pylist()
    held, matched = [], pieces.Vocabulary.matched
    monkeypatch.setattr(pieces, "MATCHED", 200)
    monkeypatch.setattr(pieces.Vocabulary, "matched", lambda own, some: held.append(sum(len(s) + 1 for s in some)) or matched(own, some))
    assert pieces.Encoder(vocabulary).encode(texts).to_pylist() == want
    assert len(held) > 10 and sorted(held)[-2] <= 400 and max(held) < 1200


def test_workers_give_memory_back(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(20)], "doc_id long, text string").coalesce(1)
    found = pieces.tokenize(docs)
    given = []
    monkeypatch.setattr(pieces, "give_back", lambda: given.append(1))
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b", None])], ["doc_id", "text"])
    work = {}
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, f, schema: work.setdefault("f", f))
    pieces.tokenize(docs)
    assert [b.num_rows for b in work["f"](iter([rows, rows]))] == [2, 2] and len(given) == 3
    assert found.count() == 20
