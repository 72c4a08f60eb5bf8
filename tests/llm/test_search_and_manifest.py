"""Hard negatives, the Merkle manifest and the positional index beside plain Python."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagesift.llm import hard_negatives as HN
from pagesift.llm import merkle as M
from pagesift.llm import phrase_index as P

from .conftest import ROWS, lorem

# ---- hard negatives ----


def vectors(n, dim=6, seed=3, labels=3):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=dim).tolist(), int(rng.integers(labels))) for i in range(n)]


def brute_negatives(rows, scale=16, n_positives=5, n_negatives=10):
    good = [
        (i, [math.floor(x * scale) for x in v], label) for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (a, av, al) in enumerate(good):
        if a % 10:
            continue
        scored = [
            (sum(x * y for x, y in zip(av, v)), i, label) for j, (i, v, label) in enumerate(good) if j != at and len(v) == len(av)
        ]
        positives = sorted((-s, i) for s, i, label in scored if label == al)[:n_positives]
        for ps, pid in positives:
            near = sorted((-s, i) for s, i, label in scored if label != al and 30 * -ps <= 100 * s <= 90 * -ps)[:n_negatives]
            out += [(a, pid, rank, i, -ps, -s) for rank, (s, i) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("most_rows, most_anchors", [(10_000, 1000), (40, 3)])
def test_hard_negatives(spark, most_rows, most_anchors):
    rows = vectors(300)
    rows += [(7, rows[7][1], rows[7][2]), (10, rows[10][1], rows[10][2]), (20, rows[10][1], 1)]  # repeated rows and ties
    rows += [(30, None, 1), (40, [], 1), (50, [1.0, None], 2), (60, [math.nan] * 6, 0), (70, [math.inf] * 6, 0)]
    rows += [(400, rows[1][1], None), (None, rows[1][1], 1), (410, [1.0, 2.0], 1), (411, [1.0, 1.0], 1), (412, [0.9, 0.4], 2)]
    rows += [(420, [0.0] * 6, 2), (421, [0.0] * 6, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, row string, block int")
    found = HN.hard_negatives(df, F.col("id") % 10 == 0, F.col("label"), scale=16, most_rows=most_rows, most_anchors=most_anchors)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.select(*names).collect()) == brute_negatives(rows)
    assert HN.hard_negatives(df.limit(0), F.col("id") % 10 == 0, F.col("label")).collect() == []
    assert HN.hard_negatives(df, F.col("id") < 0, F.col("label")).collect() == []


def test_index_leaves_out_covered_dimensions_and_loses_nothing():
    rng = np.random.default_rng(5)
    values = (rng.normal(size=(400, 32)) * np.geomspace(400, 1, 32) * np.linspace(0.02, 1, 400)[:, None]).astype(np.int64)
    anchors = values[-5:]
    least = 0.5 * float((anchors.astype(float) ** 2).sum(axis=1).min())
    index = HN.Index(values, anchors, least)
    assert sum(index.n_postings) < 0.5 * values.size and len(index.rows) < len(values)
    partial, rest = index.partial(slice(0, 5))
    scores = values @ anchors.T
    for a in range(5):
        assert set(np.flatnonzero(scores[:, a] >= least)) <= set(index.rows[partial[a] + rest[a] >= least])
        real = scores[index.rows, a]
        assert (np.abs(real - partial[a]) <= rest[a]).all()
        assert (index.completed(a, partial[a], np.arange(len(real))) == real).all()


def test_scores_beyond_floating_point():
    values = np.array([[1 << 30, 1], [1 << 30, 2], [1 << 30, 3]], dtype=np.int64)
    index = HN.Index(values, values[:1], -1.0)
    partial, _ = index.partial(slice(0, 1))
    got = dict(zip(index.rows.tolist(), index.completed(0, partial[0], np.arange(3)).tolist()))
    assert got == {i: (1 << 60) + i + 1 for i in range(3)}


# ---- manifest ----


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(leaves, tampered):
    """leaves: group -> ordered (key, leaf). Gives key, leaf, subroot, root, proof digest, folded root."""

    def tree(nodes):
        """Last node, and per node the steps to it."""
        paths, level, places = [[] for _ in nodes], nodes, list(range(len(nodes)))
        while len(level) > 1:
            runs = [level[i : i + 8] for i in range(0, len(level), 8)]
            for n, at in enumerate(places):
                run = runs[at // 8]
                paths[n].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
            level, places = [h(*run) for run in runs], [at // 8 for at in places]
        return level[0], paths

    groups = sorted(leaves, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for _, leaf in leaves[g]]) for g in groups}
    root, top = tree([trees[g][0] for g in groups])
    out = []
    for g, above in zip(groups, top):
        for (key, leaf), path in zip(leaves[g], trees[g][1]):
            steps = path + above
            folded = tampered.get(leaf, leaf)
            for left, right in steps:
                folded = h(left, folded, right)
            out.append((key, leaf, trees[g][0], root, h(*[x for step in steps for x in step]), folded))
    return sorted(out, key=repr)


def manifest_case(spark, rows):
    """rows: (doc_id, text, lang)."""
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda d, t: h(field(d), field(t))
    tampered, groups = {}, {}
    for d, t, g in rows:
        groups.setdefault(g, []).append((d, leaf(d, t)))
        if d is not None and d % 3 == 0:
            tampered[leaf(d, t)] = leaf(d, t if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t))
    for g in groups:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    df = spark.createDataFrame([(*r, i, "x", "y") for i, r in enumerate(rows)], "doc_id long, text string, lang string, idx int, tree string, `a.b` string")
    found = M.verified(df, ["doc_id", "text"], "lang", "doc_id", F.col("doc_id") % 3 == 0, M.lower_ascii(F.col("text")))
    found = found.withColumn("digest", M.proof_digest(F.col("proof")))
    got = [tuple(r) for r in found.select("key", "leaf", "subroot", "root", "digest", "folded_root", "verified").collect()]
    want = brute_manifest(groups, tampered)
    assert sorted([r[:-1] for r in got], key=repr) == want
    assert all(r[6] == (r[5] == r[3]) for r in got)
    return got


def test_manifest_of_odd_rows(spark):
    rows = [(r[0], r[1], r[2]) for r in ROWS] + [(30, "ÀÉ Zz", "=x"), (31, None, ""), (33, "ABC", "-")]
    got = manifest_case(spark, rows)
    assert {r[6] for r in got if r[0] == 33} == {False} and {r[6] for r in got if r[0] == 31} == {True}


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 9}, {"a": 600, "b": 1, None: 65}, {f"l{i}": 1 + i % 3 for i in range(70)}])
def test_manifest_of_many_levels(spark, sizes):
    rows = [(i * 2, f"Text {g} {i}", g) for g, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    manifest_case(spark, rows)


def test_manifest_of_no_rows(spark, none):
    assert M.verified(none, ["doc_id", "text"], "lang", "doc_id", F.lit(True), F.col("text")).collect() == []


def test_manifest_with_shuffled_ancestors(spark, monkeypatch):
    """Many nodes of one ancestor, beyond what may be broadcast."""
    from pagesift.operators import joins

    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("inner", 0, 20, None))
    manifest_case(spark, [(i, f"T{i}", "a") for i in range(700)])


# ---- positional index ----


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contaminated(docs, items, window):
    out = []
    for d, text in docs:
        w, hit, found = words_of(text), set(), set()
        for item, body in items:
            iw = words_of(body)
            n = min(window, len(iw))
            for s in range(max(1, len(iw) - window + 1) if iw else 0):
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == iw[s : s + n]:
                        hit |= set(range(at, at + n))
                        found.add(item or "")
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


ITEMS = [
    ("b1", lorem(1, 40)), ("b2", "Hello, World_again"), ("b2", "one two"), (None, "null item here"), ("b3", None), ("b4", "..."),
    ("b5", lorem(7, 60)), ("b6", "aaa " * 14), ("b7", "a-b's É日本 x"), ("b8", "word"),
]
TEXTS = [
    (1, f"x {lorem(1, 40)} y"), (2, lorem(1, 40).upper()), (3, "hello world again hello WORLD again"), (4, None), (5, ""),
    (6, "one one two null ITEM here\nword"), (7, lorem(7, 4000)), (7, lorem(7, 4000)), (None, "aaa " * 30), (8, "A b S é日本 É日本 x"),
    (9, lorem(1, 15) + " and " + " ".join(lorem(1, 40).split()[12:30])), (10, "one"), (11, "two words"),
]


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 200}])
def test_contaminated(spark, options):
    docs = spark.createDataFrame([(*x, 1, "s") for x in TEXTS], "doc_id long, text string, shard int, words string")
    bench = spark.createDataFrame([(*x, 1) for x in ITEMS], "item_id string, text string, part int")
    found = P.contaminated(docs, bench, **options)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"])) for r in found.collect()), key=repr)
    assert got == brute_contaminated(TEXTS, ITEMS, 10)
    assert P.contaminated(docs.limit(0), bench).collect() == []
    assert {r["n_hit"] for r in P.contaminated(docs, bench.limit(0)).collect()} == {0}


def test_benchmark_beyond_a_broadcast_and_in_parts(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS + [("long", lorem(7, 4000))], "item_id string, text string")
    postings = P.index(docs, shard_bytes=2000)
    wide = P.matches(postings, bench, part_bytes=50, broadcast_bytes=0)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, P.matches(postings, bench).collect()))
    assert wide.where("item_id = 'long' and exact").count() >= 2 * 3991


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "the quick brown fox"), (2, "the quick red brown fox"), (3, "quick the brown fox"), (4, "the quick brown dog"), (5, "the quick a b c d brown fox")],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame([("i", "the quick brown fox")], "item_id string, text string")
    postings = P.index(docs)
    found = P.matches(postings, bench, slack=1).join(P.documents_of(postings), ["shard", "place"])
    best = found.groupBy("doc_id").agg(F.max("exact").alias("exact"), F.min("from").alias("first")).collect()
    assert {(r["doc_id"], r["exact"]) for r in best} == {(1, True), (2, False), (3, False)}
    # Whatever a shard holds, the same places match.
    one = P.index(docs.coalesce(1))
    joined = P.matches(one, bench, slack=1).join(P.documents_of(one), ["shard", "place"])
    rows = lambda x: sorted((r["doc_id"], r["from"], r["exact"]) for r in x.collect())
    assert rows(joined) == rows(found)
    with pytest.raises(ValueError):
        P.matches(postings, bench, slack=600)


def test_index_and_lookup_hold_little_at_once(spark, monkeypatch):
    import pyarrow.parquet as pq

    rows = [(i, lorem(i % 5, 9000)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sum(len(text) for _, text in rows) > 1 << 19
    wide = P.index(docs).agg(F.max(F.octet_length("positions")), F.max(F.octet_length("counts"))).first()
    assert 0 < max(wide) < 1 << 19
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in P.index(docs.limit(20).repartition(1), shard_bytes=1).inputFiles()]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert sum(groups) == 20 and max(groups) <= 16
    held, write = {}, P.materialize

    def materialize(df, name, **options):
        held[name] = [spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize")]
        return write(df, name, **options)

    monkeypatch.setattr(P, "materialize", materialize)
    bench = spark.createDataFrame([(1, " ".join(rows[3][1].split()[100:120]))], "item_id long, text string")
    found = {r["doc_id"]: r["n_hit"] for r in P.contaminated(docs, bench).collect()}
    assert found == {i: 20 if i % 5 == 3 else 0 for i in range(20)}
    assert held["postings"][0] == str(2 << 20) and held["phrase-hits"] == [str(2 << 20), "4"]


def test_words_are_cut_like_the_pattern():
    import pyarrow as pa

    texts = [t for _, t in TEXTS] + ["\x00a\x1cb\u0085c d", "[a]^`{b}~\x7fc", "A_B-9", "  "]
    sizes, words = P.split_words(pa.array(texts))
    assert [w for t in texts for w in words_of(t)] == words.to_pylist()
    assert [len(words_of(t)) for t in texts] == sizes.tolist()
    sizes, words = P.split_words(pa.array(texts).slice(2, 5))
    assert [w for t in texts[2:7] for w in words_of(t)] == words.to_pylist()
