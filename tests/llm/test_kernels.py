"""The inner loops of decontamination: what they hold and skip."""

import tracemalloc

import numpy as np
import pyarrow as pa

from finlake.llm import decontaminate as D


def test_passages_travel_as_bytes(spark):
    got = D.passage_rows(spark.createDataFrame([("b a b " + "c " * 63,), (None,), ("",)], "text string"))
    assert got.dtypes == [("terms", "binary"), ("values", "binary")]
    a, b, c = (int(D.hashed(D.words_of(x))[0]) for x in "abc")
    made = [dict(zip(np.frombuffer(r.terms, np.uint16).tolist(), np.frombuffer(r.values, np.float32).tolist()))
            for r in got.collect()]
    assert len(made) == 2 and {a: 1, b: 2, c: 61} in made and {c: 2} in made
    assert all(list(x) == sorted(x) for x in made)


def test_rows_are_read_packed_and_as_arrays():
    terms, values = [[1, 5, 9], [], [5]], [[1.0, 2.0, 3.0], [], [4.0]]
    packed = pa.RecordBatch.from_arrays([pa.array([np.array(x, np.uint16).tobytes() for x in terms], pa.binary()),
                                         pa.array([np.array(x, np.float32).tobytes() for x in values], pa.binary())],
                                        names=["terms", "values"])
    arrays = pa.RecordBatch.from_arrays([pa.array(terms, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                                        names=["terms", "values"])
    for batch in ([packed], [arrays], [packed.slice(0, 1), packed.slice(1, 2)]):
        rows = D.matrix_rows(batch, None)
        assert rows.n == 3 and rows.term.tolist() == [1, 5, 9, 5] and rows.row.tolist() == [0, 0, 0, 2]
        assert rows.value.tolist() == [1, 2, 3, 4]


def test_passage_needs_room_for_the_item():
    """The text has all of the item's words, one passage has them together: only that one is looked at further."""
    r = np.random.default_rng(6)
    item = np.arange(1, 25, dtype=np.uint64) << np.uint64(20)
    text = (r.integers(5000, 9000, 900).astype(np.uint64)) << np.uint64(20)
    text[10:900:40] = item[:23]  # strewn about
    text[400:424] = item  # and together
    space = D.Space(np.zeros((D.VOCAB + 1, 4), np.float32))
    block = D.make_block([D.Item(1, item, item[-5:])], space)
    n = (900 - 32) // 8 + 1
    found = D.Close(32, np.zeros(n, int), np.arange(n), np.zeros(n, int), np.ones(n))
    kept = D.with_room(found, [D.hashed(text)], block).window.tolist()
    want = [w for w in range(n)
            if D.lcs(item.tolist(), text[max(0, w * 8 - 8):w * 8 + 40].tolist())[0] >= D.LEAST_LCS * 24]
    assert want and set(want) <= set(kept) and len(kept) <= len(want) + 2


def test_the_driver_holds_the_space_once(spark, monkeypatch):
    basis = np.ones((D.VOCAB, 256), np.float32)

    def svd(*a, **k):
        tracemalloc.start()
        return basis, np.linspace(9, 1, 256)

    monkeypatch.setattr(D, "randomised_svd", svd)
    try:
        space = D.fit(spark.createDataFrame([(1, "some words")], "doc_id long, text string"),
                      spark.createDataFrame([(1, "an item")], "item_id long, text string"))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert space.table.shape == (D.VOCAB + 1, 256) and not space.table[-1].any() and peak < 60e6
