"""What a Python worker holds at once, whatever the batches are that it is sent."""

import gzip

import numpy as np
import pyarrow as pa

from pagesift.functions import minhash
from pagesift.functions.hashing import PRIME31
from pagesift.llm import language, near_dedup, substring_dedup
from pagesift.operators import models as M
from pagesift.sources import warc


def test_shingles_are_hashed_in_slices():
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, PRIME31, n).tolist() for n in rng.integers(0, 90, 400)] + [None, [], [0, PRIME31 - 1], [PRIME31 - 1], [0]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows, pa.list_(pa.int64()))], ["id", "s"])
    parts = list(minhash.slices(batch, 1, 500))
    assert pa.Table.from_batches(parts).column("id").to_pylist() == list(range(len(rows)))
    assert max(len(x.column(1).flatten()) for x in parts) < 500 + 90
    pairs = [(1, 0), (PRIME31 - 1, PRIME31 - 1), *minhash.coefficients(4)]
    found = [x for part in parts for x in minhash.minima(part.column(1), pairs, 2).to_pylist()]
    flat = [[y for z in x for y in z] for x in found]
    assert flat == [[min((v * a + b) % PRIME31 for v in row) for a, b in pairs] if row else [] for row in rows]


def test_row_scores_in_parts():
    lengths = np.array([0, 7, 0, 900, 3, 3, 0, 1200, 5])
    parts = list(M._parts(lengths, 1000))
    assert [x for low, high in parts for x in range(low, high)] == list(range(len(lengths)))
    assert all(lengths[low:high].sum() < 1000 + 1200 for low, high in parts)
    table = np.log(np.array([[0.5, 0.1], [0.2, 0.4], [0.7, 0.3]]))  # priors are last
    shares = M._shares(table, np.array([0, 1, 1]), np.array([0, 2, 0, 1, 0]))
    assert np.allclose(shares[[0, 2, 4]], [0.7, 0.3])
    assert np.allclose(shares[1], np.array([0.07, 0.012]) / 0.082) and np.allclose(shares[3], np.array([0.14, 0.12]) / 0.26)


def test_archives_are_written_and_read_in_small_batches(tmp_path):
    names = ["url", "date", "content_type", "body"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([f"http://a/{i}" for i in range(200)]), pa.array([None] * 200, pa.string()), pa.array(["text/html"] * 200),
         pa.array([bytes([i]) * 100_000 if i else None for i in range(200)], pa.binary())], names,
    )

    class Schema:
        def fieldNames(self):
            return names

    writer = warc.WarcWriter(str(tmp_path), Schema())
    writer.commit([writer.write(iter([batch, batch.slice(0, 0)])), writer.write(iter([]))])
    (path,) = tmp_path.glob("*.warc.gz")
    assert gzip.decompress(path.read_bytes()).count(b"WARC-Type: response") == 200
    found = list(warc._batches("x", str(path)))
    assert [y for x in found for y in x.column("url").to_pylist()] == batch.column("url").to_pylist()
    assert [y or None for x in found for y in x.column("body").to_pylist()] == batch.column("body").to_pylist()
    assert max(x.nbytes for x in found) < 6 << 20


def test_contexts_are_sorted_in_small_groups(monkeypatch):
    sizes, repeated = [], substring_dedup.repeated

    def seen(groups, leads, data, length):
        sizes.append(sum(map(len, data)))
        return repeated(groups, leads, data, length)

    monkeypatch.setattr(substring_dedup, "repeated", seen)
    rng = np.random.default_rng(2)
    rows = [(key, 10, rng.bytes(300), 1) for key in range(2_500) for _ in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.int64()))], ["key", "lead", "data", "n"])
    list(substring_dedup._judged(200)(iter([batch])))
    assert sum(sizes) == 3_000_000 and max(sizes) < 1_100_000


def test_few_texts_are_parsed_at_once():
    """However large the batches are that a worker is sent, and whether the text rides in the row or beside it."""
    seen = []

    class Model:
        def predict(self, texts):
            seen.append(sum(len(x or "") for x in texts))
            return ["x"] * len(texts), np.zeros(len(texts))

    texts = ["a" * 50_000, None, ""] * 100
    inside = pa.StructArray.from_arrays([pa.array(range(300)), pa.array(texts, pa.string())], ["id", "text"])
    beside = pa.StructArray.from_arrays([pa.array(range(300))], ["id"])
    for batch, at in (
        (pa.RecordBatch.from_arrays([inside], ["row"]), 1),
        (pa.RecordBatch.from_arrays([beside, pa.array(texts, pa.string())], ["row", "text"]), None),
    ):
        seen.clear()
        found = pa.Table.from_batches(list(language.parsed(iter([batch]), Model(), at)))
        assert [x["id"] for x in found.column("row").to_pylist()] == list(range(300))
        assert sum(seen) == 5_000_000 and max(seen) <= 2 * language.PARSED


def test_hashes_of_a_chunk_are_sent_as_differences():
    rng = np.random.default_rng(3)
    value = np.unique(rng.integers(0, 2**64, 500_000, dtype=np.uint64))
    for some in (value, value[:1], value[:0], np.array([0, 2**64 - 1], np.uint64)):
        assert near_dedup.from_differences(pa.chunked_array([[near_dedup.differences(some)]], pa.binary())).tolist() == some.tolist()
    many = pa.chunked_array([[near_dedup.differences(value[:9]), None, near_dedup.differences(value[5:])]], pa.binary())
    assert near_dedup.from_differences(many).tolist() == [*value[:9].tolist(), *value[5:].tolist()]
    texts = pa.array([" ".join(str(x) for x in rng.integers(0, 10**6, 200_000)), "a b c d e f"])
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([1, 1]), texts, pa.array([0, 0])], ["v", "n", "text", "chunk"])
    sent = pa.Table.from_batches(list(near_dedup._counted(4, 1 << 30)(iter([batch]))))
    data = b"".join(sent.column("gs").to_pylist())
    assert len(data) == 8 * 199_998
    assert len(pa.compress(data, "lz4", asbytes=True)) < 0.85 * len(data)


def test_runs_of_words_are_hashed_from_lines():
    rng = np.random.default_rng(4)
    lines = [" ".join(["aé", "b", "日本", "word"][k] for k in rng.integers(0, 4, n)) for n in rng.integers(0, 30, 60)] + [None, "", "one", "a b c d e"]
    for array in (pa.array(lines), pa.array(["x y z", *lines])[1:]):
        found = minhash.ngram_hashes(array, 3, lambda values: np.array([len(x) for x in values], np.int64)).to_pylist()
        words = [(x or "").split() for x in lines]
        assert found == [[len(" ".join(w[i : i + 3]).encode()) for i in range(len(w) - 2)] for w in words]
