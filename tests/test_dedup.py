import random

import pytest
from pyspark.sql import functions as F

from pagesift.functions.hashing import md5_31, xx_31
from pagesift.functions.minhash import coefficients, minima
from pagesift.operators import dedup as D
from pagesift.operators import reorganize as R


def clusters(spark, pairs, **options):
    edges = spark.createDataFrame(pairs, "u long, v long")
    return {r["doc_id"]: (r["cluster_id"], r["dup_count"]) for r in D.dup_clusters(edges, **options).collect()}


def test_chain_pair_and_single(spark):
    got = clusters(spark, [(1, 2), (2, 3), (3, 4), (10, 11), (20, 20)])
    assert got == {1: (1, 4), 2: (1, 4), 3: (1, 4), 4: (1, 4), 10: (10, 2), 11: (10, 2)}


@pytest.mark.parametrize("limit", [3, 1000])
def test_random_graph_with_a_hub(spark, limit):
    rng = random.Random(4)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(300, 301 + i) for i in range(40)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in pairs:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    want = {}
    for x in parent:
        want.setdefault(root(x), []).append(x)
    expected = {x: (min(m), len(m)) for m in want.values() if len(m) > 1 for x in m}
    assert clusters(spark, pairs, rows_per_task=limit) == expected


def test_no_edges(spark):
    assert clusters(spark, [(5, 5)]) == {}


TEXTS = [
    (1, "one two three four five six seven eight"),
    (2, "One, two three four five six seven eight!"),
    (3, "completely different words stand in this other text here"),
    (4, "too short"),
    (5, ""),
    (6, "one two three four five six seven nine"),
]


def test_signatures_against_python(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    rows = D.minhash_signature(docs, buckets=3, hashes=2).collect()
    keys = {}
    for r in rows:
        keys.setdefault(r["doc_id"], {})[r["bucket"]] = r["bucket_key"]
    assert set(keys) == {1, 2, 3, 6}
    assert keys[1] == keys[2] != keys[3]
    shingles = docs.select("doc_id", D.shingle_hashes(F.col("text")).alias("s")).collect()
    import hashlib

    for r in shingles:
        if r["s"]:
            lows = [min((a * h + b) % (2**31 - 1) for h in r["s"]) for a, b in coefficients(6)]
            for bucket in range(3):
                text = "-".join(map(str, lows[2 * bucket : 2 * bucket + 2]))
                assert keys[r["doc_id"]][bucket] == hashlib.md5(text.encode()).hexdigest()


def test_minima_of_empty_and_null():
    import pyarrow as pa

    out = minima(pa.array([[], [5, 7], None], pa.list_(pa.int64())), [(1, 0), (2, 1)], 1)
    assert out.to_pylist() == [[], [[5], [11]], []]


@pytest.mark.parametrize("limit", [1, 1000])
def test_star_edges_of_a_large_bucket(spark, limit):
    text = "the same long sentence stands in every one of these documents"
    docs = spark.createDataFrame([(i, text) for i in range(50)], "doc_id long, text string")
    edges = D.minhash_pairs(D.minhash_signature(docs), rows_per_task=limit)
    assert sorted(map(tuple, edges.collect())) == [(0, i) for i in range(1, 50)]


@pytest.mark.parametrize("limit", [1, 1000])
def test_jaccard(spark, limit):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    edges = spark.createDataFrame([(1, 2), (1, 3), (1, 6)], "u long, v long")
    got = {(r["u"], r["v"]): r["jaccard"] for r in D.jaccard_verify(edges, docs, rows_per_task=limit).collect()}
    assert got == {(1, 2): 1.0, (1, 3): 0.0, (1, 6): 3 / 5}
    assert D.jaccard_verify(edges, docs, 0.9).count() == 1


def test_exact_dedup_local_and_global(spark):
    docs = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "a", 1), (4, "b", 1)], "doc_id long, text string, split int")
    assert {r[0] for r in D.exact_dedup(docs, ["split"]).select("doc_id").collect()} == {1, 3, 4}
    assert {r[0] for r in D.exact_dedup(docs).select("doc_id").collect()} == {1, 4}


def test_removed_and_kept_are_the_input(spark):
    docs = spark.createDataFrame([(i, f"f{i % 2}") for i in range(1, 13)], "doc_id long, source string")
    found = D.dup_clusters(spark.createDataFrame([(1, 2), (2, 3), (10, 11)], "u long, v long"))
    remove, meta = D.dup_remove_list(found, docs), D.dup_metadata(found, docs)
    kept = D.dup_removal(docs, remove, meta)
    assert {r["doc_id"]: r["dup_count"] for r in kept.collect()} == {
        1: 3, 10: 2, **{i: 1 for i in (4, 5, 6, 7, 8, 9, 12)},
    }
    assert kept.select("doc_id").union(remove.select("doc_id")).distinct().count() == 12
    merged = {r["doc_id"]: (r["to_remove"], r["dup_count"]) for r in D.merge_remove_meta(remove, meta.select("doc_id", "dup_count")).collect()}
    assert merged == {1: (False, 3), 2: (True, None), 3: (True, None), 10: (False, 2), 11: (True, None)}


def test_intervals(spark):
    counts = [1, 2, 5, 6, 10, 11, 100, 101, 1000, 1001, 10**6]
    df = spark.createDataFrame([(c,) for c in counts], "dup_count long")
    got = [r["dup_interval"] for r in R.tag_intervals(df).orderBy("dup_count").collect()]
    assert got == ["1-1", "2-5", "2-5", "6-10", "6-10", "11-100", "11-100", "101-1000", "101-1000", "1001-inf", "1001-inf"]


def test_large_folder_gets_more_files(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(1).alias("dup_count"), F.lit("d").alias("dump"))
    splits = R.merge_splits(R.tag_intervals(docs), rows_per_file=20).select("split").distinct().count()
    assert splits == 50


def near_case(spark):
    words = [f"w{i}" for i in range(40)]
    text = lambda skip: " ".join(w for i, w in enumerate(words) if i != skip)
    rows = [(1, "unlike " * 3 + " ".join(f"u{i}" for i in range(30))), (5, text(39)), (9, text(38) + " end"), (12, "x " + text(39))]
    rows += [(20 + i, " ".join(f"v{i}x{j}" for j in range(12))) for i in range(6)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_an_unlike_center_loses_no_link(spark):
    docs = near_case(spark)
    star = spark.createDataFrame([(1, 5), (1, 9), (1, 12), *((1, 20 + i) for i in range(6))], "u long, v long")
    assert D.jaccard_scores(star, docs, 0.5).collect() == []
    links = {(r["u"], r["v"]) for r in D.jaccard_verify(star, docs, 0.5).collect()}
    assert {(5, 9), (5, 12)} <= links and links <= {(5, 9), (5, 12), (9, 12)}
    found = {r["doc_id"]: (r["cluster_id"], r["dup_count"]) for r in D.verified_clusters(star, docs, 0.5).collect()}
    assert found == {5: (5, 3), 9: (5, 3), 12: (5, 3)}


@pytest.mark.parametrize("limit", [3, 100_000])
def test_verified_clusters_equal_all_pairs(spark, limit):
    """Groups of several families with an unlike center each."""
    rng = random.Random(2)
    rows, edges, number = [], [], 0
    for group in range(3):
        center, number = number, number + 1
        rows.append((center, " ".join(f"c{group}y{j}" for j in range(20))))
        for family in range(4):
            base = [f"g{group}f{family}w{j}" for j in range(30)]
            for _ in range(rng.randrange(1, 6)):
                words = list(base)
                for _ in range(rng.randrange(0, 3)):
                    words[rng.randrange(30)] = f"z{rng.randrange(10**6)}"
                rows.append((number, " ".join(words)))
                edges.append((center, number))
                number += 1
    docs, star = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(edges, "u long, v long")
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for d, t in rows}
    members = {}
    for u, v in edges:
        members.setdefault(u, {u}).add(v)
    pairs = [(a, b) for m in members.values() for a in m for b in m if a < b and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])]
    parent = {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {x for p in pairs for x in p}
    got = {r["doc_id"]: r["cluster_id"] for r in D.verified_clusters(star, docs, 0.6, rows_per_task=limit).collect()}
    assert got == {x: root(x) for x in linked}


def test_few_rounds_and_clusters_for_a_large_star_of_small_families(spark, monkeypatch):
    """The center is unlike all; members of a family are alike, also those of other lengths that stay just above the threshold."""
    rows, edges = [(0, " ".join(f"c{j}" for j in range(20)))], []
    for i in range(1, 151):
        words = [f"f{i % 60}w{j}" for j in range(24)] + [f"end{i}x{j}" for j in range(i % 4)]
        rows.append((i, " ".join(words[: 24 + i % 4])))
        edges.append((0, i))
    docs, star = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(edges, "u long, v long")
    sets = {d: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for d, t in rows}
    alike = [(a, b) for a in range(1, 151) for b in range(a + 60, 151, 60) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = {b: a for a, b in reversed(alike)} | {a: a for a, _ in alike if a <= 60}
    calls, whole = [], D.dup_clusters
    monkeypatch.setattr(D, "dup_clusters", lambda *a, **b: calls.append(1) or whole(*a, **b))
    found = {r["doc_id"]: r["cluster_id"] for r in D.verified_clusters(star, docs, 0.8).collect()}
    assert found == {x: min(want[x], want.get(want[x], want[x])) for x in want} and len(found) > 100
    assert len(calls) <= 5


@pytest.mark.parametrize("own", [md5_31, xx_31])
def test_signatures_from_lines_equal_those_of_the_expression(spark, own):
    rng = random.Random(4)
    words = ["Alpha", "beta,", "é", "日本", "x1", "-", "\u00a0", "\n"]
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (0, 3, 5, 40, 200)] + [None, "", "a b c d e"]
    docs = spark.createDataFrame([(i if i else None, x) for i, x in enumerate(texts)], "doc_id long, text string")
    plain = D.minhash_signature(docs, hash_fn=lambda gram: own(gram))
    found = D.minhash_signature(docs, hash_fn=own)
    assert found.schema == plain.schema and sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    assert found.count() >= 11


def test_curation_keeps_what_only_shares_a_bucket(spark, monkeypatch):
    from pagesift.plans import curation

    docs = near_case(spark)
    star = spark.createDataFrame([(1, 5), (1, 9), (1, 12), (20, 21)], "u long, v long")
    monkeypatch.setattr(curation.D, "minhash_pairs", lambda signed: star)
    found = {r["doc_id"]: r["cluster_id"] for r in curation.near_duplicates(docs, threshold=0.5).collect()}
    assert found == {5: 5, 9: 5, 12: 5}


def test_merged_forests_equal_the_whole(spark):
    rng = random.Random(9)
    old = [(rng.randrange(100), rng.randrange(100)) for _ in range(60)]
    new = [(rng.randrange(150), rng.randrange(150)) for _ in range(50)] + [(200, 201), (300, 300)]
    table = lambda pairs: spark.createDataFrame(pairs, "u long, v long")
    whole = clusters(spark, old + new)
    for limit in (2, 1000):
        merged = D.merge_clusters(D.dup_clusters(table(old)), table(new), limit)
        assert {r["doc_id"]: (r["cluster_id"], r["dup_count"]) for r in merged.collect()} == whole
    assert {r["doc_id"]: r["cluster_id"] for r in D.merge_clusters(D.dup_clusters(table([(1, 1)])), table([(4, 2)])).collect()} == {2: 2, 4: 2}
    kept = D.merge_clusters(D.dup_clusters(table([(1, 2)])), table([(3, 3)]))
    assert {r["doc_id"]: r["cluster_id"] for r in kept.collect()} == {1: 1, 2: 1}
