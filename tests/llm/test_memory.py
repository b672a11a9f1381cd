"""Memory of the Python workers: bounded by slices of a batch, not by the batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from textpulse.llm import chunks, langid, simhash


class Frame:
    """A stand-in that hands batches to the function of mapInArrow in this process."""

    def __init__(self, *batches):
        self.batches = batches

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run(iter(self.batches))


def texts(count, words):
    draw = random.Random(5)
    known = [f"word{i}" for i in range(3_000)]
    return [" ".join(draw.choices(known, k=words)).encode() for _ in range(count)]


def peak_mb(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def batch(values):
    return pa.record_batch([pa.array(range(len(values)), pa.int64()), pa.array(values, pa.binary())], ["row", "text"])


@pytest.mark.parametrize("rows", [chunks.chunked, simhash.fingerprints])
def test_rows_of_a_large_batch_are_taken_in_slices(spark, rows):
    values = [*texts(6_000, 150), None, b"", b"one"]
    outs = []
    assert peak_mb(lambda: outs.extend(rows(Frame(batch(values))))) < 12
    single = [out for i in (0, 5_999, 6_000, 6_001, 6_002) for out in rows(Frame(batch(values).slice(i, 1)))]
    whole = pa.Table.from_batches(outs)
    assert whole.num_rows >= 6_000
    got = [r for r in whole.to_pylist() if r.get("row", r.get("doc_id")) in (0, 5_999, 6_000, 6_001, 6_002)]
    assert got == pa.Table.from_batches(single).to_pylist()


def test_a_slice_is_small_unless_it_is_one_row(spark):
    values = [b"a " * 3_000_000, b"", None, *[b"b " * 1_000_000] * 5, *[b"c"] * 3_000]
    seen = []
    list(chunks.map_batches(Frame(batch(values)), lambda part: seen.append(part) or part, "", sliced=True))
    assert pa.Table.from_batches(seen).equals(pa.Table.from_batches([batch(values)]))
    assert all(p.num_rows == 1 or p.num_rows <= 1 << 10 and p.nbytes <= 4 << 20 for p in seen)


def test_training_holds_one_matrix_of_features():
    own = texts(400, 60)
    idf = np.linspace(1, 3, langid.DIMENSIONS).astype(np.float32)
    matrix = len(own) * langid.DIMENSIONS * 4 / 1e6
    assert peak_mb(lambda: langid._clustered(own, idf)) < 1.6 * matrix
    whole = langid.normalised(np.stack([langid.features(t) for t in own]), idf)
    assert np.array_equal(langid._vectors(own, idf), whole)
    some = np.flatnonzero(whole[:, :50].sum(axis=1) > np.median(whole[:, :50].sum(axis=1)))
    assert np.array_equal(langid._sum(whole, some), whole[some].sum(axis=0))
