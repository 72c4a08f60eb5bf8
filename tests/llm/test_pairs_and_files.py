"""Near duplicates, suffix dedup, archives, search, and the pipeline on small tables."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagesift.session import materialize
from pagesift.llm import components, near_dedup, substring_dedup, topk, warc

from .conftest import ROWS, lorem


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (4, 5), (7, 7), (6, None)] + [(20 + i, 21 + i) for i in range(30)] + [(99, 98), (99, 97), (99, 96)]
    found = {x["v"]: x["p"] for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if b is not None and a != b]
    assert found == roots({x for pair in real for x in pair}, real)
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
    hub = [(1000, i) for i in range(400)] + [(5, 2000), (2000, 2001)]
    found = components.components(spark.createDataFrame(hub, "a long, b long")).collect()
    assert {x["v"]: x["p"] for x in found} == {v: 0 for pair in hub for v in pair}


# ---- near duplicates ----


def shingled(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_classes(rows, threshold=0.8):
    sets = [shingled(t) for _, t in rows]
    df = Counter(g for s in sets for g in s)
    weight = lambda s: {g: n * (1 + 0.5 * math.log1p(len(rows) / df[g]) / math.log1p(len(rows))) for g, n in s.items()}
    sets = [weight(s) for s in sets]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = sum(min(w, sets[j][g]) for g, w in a.items() if g in sets[j])
            if a and sets[j] and both >= threshold * (sum(a.values()) + sum(sets[j].values()) - both):
                links.append((rows[j][0], rows[i][0]))
    return roots([d for d, _ in rows], links)


def test_near_classes_equal_all_pairs(spark, none):
    rows, n = [], 0
    for base in range(6):
        words = lorem(base, 150).split()
        for k in range(12):  # copies with one to four changed words, unlike each other but like the first
            own = list(words)
            for j in range(k % 4 + 1 if k else 0):
                own[(k * 13 + j * 37) % 150] = f"x{n}y{j}"
            rows.append((n, " ".join(own)))
            n += 1
    rows += [(n + i, lorem(1000 + i, 100)) for i in range(10)] + [(n + 20, None), (n + 21, ""), (n + 22, "one two"), (n + 23, "One  two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.near_classes(docs).collect()
    wanted = brute_classes(rows)
    assert {x["doc_id"]: x["class_id"] for x in found} == wanted
    sizes = Counter(wanted.values())
    assert all(x["class_size"] == sizes[x["class_id"]] and x["kept"] == (x["doc_id"] == x["class_id"]) for x in found)
    # Without later centres every pair that is still open is compared.
    again = near_dedup.near_classes(docs, turns=1).collect()
    assert {x["doc_id"]: x["class_id"] for x in again} == wanted
    assert near_dedup.near_classes(none).collect() == []


def test_a_large_group_of_near_copies_is_not_compared_in_pairs(spark, monkeypatch):
    words, rows = lorem(3, 120).split(), []
    for k in range(160):  # copies with eight changed words each: like no other one, and in common buckets
        own = list(words)
        for j in range(8):
            own[(k * 7 + j * 15) % 120] = f"x{k}y{j}"
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, " ".join([*words[:110], *(f"z{k // 2}{c}" for c in "abcdef")])) for k in range(20)]
    made, pairs_of = [], near_dedup._pairs

    def counted(joined, tested, threshold):
        made.append(pairs_of(joined, None, threshold).count())
        return pairs_of(joined, tested, threshold)

    monkeypatch.setattr(near_dedup, "_pairs", counted)
    found = near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), turns=1).collect()
    assert {x["doc_id"]: x["class_id"] for x in found} == brute_classes(rows)
    assert sum(made) < 2 * len(rows)


def test_near_classes_of_odd_rows(odd):
    found = near_dedup.near_classes(odd).collect()
    assert len(found) == len(ROWS)
    by_id = defaultdict(set)
    for x in found:
        by_id[x["doc_id"]].add(x["class_id"])
    assert by_id[7] == by_id[8] == {7} and by_id[9] == by_id[None] == {9} and by_id[4] == {4} and by_id[5] == {5}


def test_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(1)
    shared, left, right = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (300, 60, 40))
    weights = {int(x): w for x, w in zip(np.concatenate([shared, left, right]), rng.uniform(0.5, 8, 400))}
    sides = [np.sort(np.concatenate([shared, x])) for x in (left, right)]
    made = [near_dedup.samples(x, np.array([weights[int(v)] for v in x]), np.array([0, len(x)]), 4000)[0] for x in sides]
    both = sum(weights[int(x)] for x in shared)
    want = both / sum(weights.values())
    assert abs((made[0] == made[1]).mean() - want) < 0.03


def test_frequencies_are_exact_for_any_number_of_shingles(spark):
    """More distinct shingles than a table of fixed size could hold: each has its own count."""
    rows = [(i, lorem(3000 + i, 8_000)) for i in range(140)]  # 1.1 million shingles
    rows += [(200 + i, lorem(3000 + i, 500) + f" tail{i}") for i in range(3)]
    source = spark.createDataFrame([(*r, 1 + (r[0] == 5)) for r in rows], "v long, text string, n long").repartition(4)
    texts = materialize(near_dedup.in_chunks(source, 1 << 18))
    assert texts.select("chunk").distinct().count() > 4
    lists = materialize(near_dedup.frequencies(texts, 8_000_000, 1 << 20, 50_000))
    assert lists.count() > texts.select("chunk").distinct().count()
    rows_of = near_dedup.with_frequencies(texts, lists).collect()
    found = {x["v"]: dict(zip(np.frombuffer(x["gs"], np.uint64).tolist(), np.frombuffer(x["dfs"], np.uint32).tolist())) for x in rows_of}
    sets = [set(shingled(t)) for _, t in rows]
    df = Counter(g for s in [*sets, sets[5]] for g in s)  # the text 5 stands for two documents
    assert len(df) > 1 << 20
    for (v, _), own in zip(rows, sets):
        assert sorted(found[v].values()) == sorted(df[g] for g in own)


# ---- suffix dedup ----


def brute_cut(texts, length):
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone)), kept))
    return out


@pytest.mark.parametrize("hot", [1_000, 1])
def test_suffix_dedup_equals_brute_force(spark, none, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    passage = lorem(500, 60)
    texts = [lorem(i, 40) + passage + lorem(900 + i, 30 + i) for i in range(12)]
    texts += [passage[5:150], "ab" * 150, "z" * 230, "z" * 90, None, "", lorem(3, 40), texts[4], texts[4], "é日" * 80 + passage]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit(1))
    found = substring_dedup.without_repeats(docs, length=80, gram=16).collect()
    cut = brute_cut([(t or "").encode() for _, t in rows], 80)
    wanted = sorted(((i, *x) for (i, _), x in zip(rows, cut)), key=str)
    assert sorted(((x["row"]["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], bytes(x["kept"])) for x in found), key=str) == wanted
    assert substring_dedup.without_repeats(none).collect() == []


def test_refinement_finds_equal_strings():
    a, b = b"..the quick brown fox jumps over the lazy dog", b"the quick brown fox jumps over the crazy dog"
    found = substring_dedup.repeated(np.array([0, 0]), np.array([2, 0]), [a, b], 20)
    same = [p for p in range(len(b) - 19) if a[p + 2 : p + 22] == b[p : p + 20]]
    assert found[1].tolist() == same and found[0].tolist() == [p + 2 for p in same]


def test_suffix_stage_keeps_replacement_characters(spark, tmp_path):
    passage = "p\u00e9" * 90  # cut inside a character at its end: the texts share the first byte of the next one
    texts = [f"a\ufffdb{passage}\u00e9 end\ufffd", f"c{passage}\u00e8 other"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x["doc_id"]: x["text"] for x in corpus_pipeline.no_repeated_passages(spark, docs, str(tmp_path)).collect()}
    assert found == {0: "a\ufffdb end\ufffd", 1: "c other"}
    assert substring_dedup.cut("\u00e9x\u00e9".encode(), [0], [np.array([1, 4], np.int32).tobytes()])[3] == ""  # remains do not join


# ---- archives ----


def test_archives(spark, tmp_path):
    long, short = "<p>" + "é" * 30_000, "tiny"
    rows = [(1, "http://a/1", long), (2, "http://a/ 2\n", long), (7, None, long), (3, "u", short), (4, "u", short), (5, "u", None)]
    rows += [(6, "u", "x" * 50_000), (6, "u", "x" * 50_000), (8, "u", "y" * 999), (9, "u", "y" * 999), (None, "u", long), (10, "u", "a\r\n\r\nWARC/1.0\r\n" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    warc.write_archives(pages, str(tmp_path / "w"), per_file=3)
    found = warc.read_pages(spark, str(tmp_path / "w")).collect()
    assert len(found) == len(rows) and all(x["error"] is None for x in found)
    number = lambda x: int(v) if x and (v := x.split(":")[2]) else None
    got = Counter((number(x["record_id"]), x["payload_bytes"], x["payload_digest"], x["record_type"], number(x["refers_to"])) for x in found)
    wanted = Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = html == long and page != 7
        wanted[page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 7 if revisit else None] += 1
    assert got == wanted
    assert {x["payload"] for x in found if x["record_type"] == "response"} == {(h or "").encode() for _, _, h in rows}
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_pages(spark, str(tmp_path / "none")).collect() == []


def test_broken_archives(spark, tmp_path):
    payload = b"z" * 40_000
    whole = [x + b"\r\n\r\n" for x in warc.records("5", "u", payload, None, 16_384)]
    assert len(whole) == 3
    cases = {"short": whole[0][:-90], "missing": whole[0] + whole[2], "lost": whole[1] + whole[2], "packed": b"\x1f\x8bnot gzip", "good": b"".join(whole)}
    for name, data in cases.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(data)
        found = warc.read_pages(spark, str(tmp_path / name)).collect()
        assert len(found) == 1 and (found[0]["error"] is None) == (name == "good"), name
        assert found[0]["payload"] == (payload if name == "good" else None)
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc")


# ---- search ----


def test_top_k_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.4, 8)]) for i in range(300)]
    rows += [(300 + i, rows[17][1]) for i in range(30)] + [(40, rows[40][1]), (400, None), (401, [float("nan")] * 8), (402, [None] * 8), (403, []), (None, rows[1][1]), (420, [1.0, 2.0])]
    rows += [(3, rows[3][1]), (3, rows[5][1])]  # candidates of one id, equal and not
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    found = topk.top_k(vectors, F.col("id") % 20 == 0, rows=64, queries=5).collect()
    good = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    wanted = []
    for at, (q, v) in enumerate(good):
        if q % 20 == 0:
            scored = sorted((-sum(map(lambda a, b: a * b, v, w)), i) for j, (i, w) in enumerate(good) if j != at and len(w) == len(v))
            wanted += [(q, k, i, -s) for k, (s, i) in enumerate(scored[:20], 1)]
    assert sorted(map(tuple, found)) == sorted(wanted)
    assert topk.top_k(vectors.limit(0), F.col("id") % 20 == 0).collect() == []


# ---- pipeline ----


def test_stages(spark, tmp_path):
    passage = lorem(77, 60)
    rows = [(i, lorem(i, 120), "en", f"s{i % 3}", 0) for i in range(20)]
    rows += [(30, lorem(3, 120) + " ", "en", "s1", 0), (31, lorem(4, 120) + " more", "en", "s1", 0), (32, "123 !", None, "s1", 0), (33, None, None, None, 0)]
    rows += [(40 + i, lorem(50 + i, 60) + "é" + passage + "é" + lorem(70 + i, 60), "en", "s2", 0) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    left, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, left, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        left = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert left.columns == docs.columns
            kept[name] = {x["doc_id"]: x["text"] for x in left.collect()}
    assert set(kept["language"]) == {i for i, *_ in rows} - {32, 33}
    assert set(kept["exact_dedup"]) == set(kept["language"]) - {3}  # 30 has one character more
    assert set(kept["near_dedup"]) == set(kept["exact_dedup"]) - {31}
    assert all(passage[10:] not in kept["suffix_dedup"][40 + i] and lorem(50 + i, 60)[:200] in kept["suffix_dedup"][40 + i] for i in range(3))
    assert all(kept["suffix_dedup"][i] == lorem(i, 120) for i in range(20) if i != 3)
    assert {x["doc_id"] for x in left.collect()} == set(kept["suffix_dedup"])


def test_run_equals_its_stages(spark, tmp_path):
    rows = [(i, lorem(i % 25, 90), "en", f"s{i % 2}", 0) for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x["doc_id"] for x in pieces} == set(range(25))
    assert all(0 <= x["ids_crc32"] < 2**32 for x in pieces)


def test_numbers_that_are_none_are_errors_of_a_record():
    head = b"WARC/1.0\r\nWARC-Type: response\r\n%s\r\n\r\nx\r\n\r\n"
    for line in (b"Content-Length: abc", b"WARC-Segment-Number: two\r\nContent-Length: 1"):
        assert [("error" in r, "block" in r) for r in warc.parsed(head % line)] == [(True, False)]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_of_empty_tables_and_odd_columns(spark, name, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, gone_id int, gone_t string, `a.b` int, t int, row string, v int"
    none = spark.createDataFrame([], schema)
    assert stage(spark, none, "").collect() == [] and stage(spark, none, "").columns == none.columns
    rows = [(i, lorem(i % 4, 90), "en", "s", 0, i, "g", i, i, "r", i) for i in range(6)] + [(None, None, None, None, None, 1, "g", 1, 1, "r", 1)]
    out = stage(spark, spark.createDataFrame(rows, schema), "")
    kept = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == none.columns and all(r["gone_id"] == i and r["a.b"] == i for i, r in kept.items() if i is not None)
    want = {"language": set(range(6)), "exact_dedup": {*range(4), None}, "near_dedup": {*range(4), None}, "suffix_dedup": {2, 3, None}}
    assert set(kept) == want[name]
