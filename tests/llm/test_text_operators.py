"""Exact and line dedup, tokenising, packing, language, and the language model on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pagesift.llm import byte_bpe, exact_dedup, language, line_dedup, lm, packing

from .conftest import ROWS, lorem

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def last(value):
    """Nulls after all others."""
    return (value is None, value if value is not None else 0)


# ---- exact dedup ----


def brute_groups(rows):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((doc, text or ""))
    out = []
    for bare, members in groups.items():
        keep = min(members, key=lambda x: (-len(x[1]), last(x[0])))[0]
        for i, (doc, _) in enumerate(sorted(members, key=lambda x: (-len(x[1]), last(x[0])))):
            out.append((doc, keep, len(members), i == 0, hashlib.sha256(bare.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_groups(odd, none):
    for table_bytes in (48 << 20, 2_000):  # the small one spills, again and again
        found = exact_dedup.grace_groups(odd, table_bytes=table_bytes).collect()
        assert sorted(map(tuple, found), key=str) == brute_groups(ROWS)
    assert exact_dedup.grace_groups(none).collect() == []


def test_exact_rows_keep_all_columns(odd):
    kept = exact_dedup.grace_distinct(odd, table_bytes=2_000)
    assert kept.columns == odd.columns
    wanted = sorted(x[1] for x in brute_groups(ROWS) if x[3])
    assert sorted(x["doc_id"] for x in kept.collect()) == wanted


def test_open_addressing_compares_contents():
    numbers, n = exact_dedup.numbered([b"a", b"b", b"a", b"c"], [5, 5, 5, 21])
    assert numbers.tolist() == [0, 1, 0, 2] and n == 3


# ---- line dedup ----


def brute_lines(rows):
    tr = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(tr)
    first = {}
    for doc, text in sorted(rows, key=lambda x: last(x[0])):
        for line in (text or "").split("\n"):
            first.setdefault(key(line), doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or first[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def test_lines(spark, none):
    shared, short = "The same LINE everywhere", "short"
    rows = [(i, "\n".join([shared.upper() + "\t", short, lorem(i, 5), lorem(i % 3, 4)])) for i in range(40)]
    rows += [(50, None), (51, ""), (3, shared + "\n" + shared), (3, shared + "\n" + shared), (None, shared), (60, "É" * 9 + "\n" + "é" * 10), (61, "é" * 10)]
    found = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == brute_lines(rows)
    assert line_dedup.line_dedup(none).collect() == []


def test_line_plan_has_no_python(spark, odd):
    plan = line_dedup.line_dedup(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- byte-level BPE ----


def library():
    ranks = byte_bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(odd, none):
    own = library()
    found = byte_bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN).collect()
    wanted = []
    for doc, text, *_ in ROWS:
        ids = own.encode_ordinary(text or "")
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        wanted.append((doc, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    ids = byte_bpe.encoded(odd, RANKS, public_tokenizers.PATTERN).where("doc_id = 10").first()["ids"]
    assert ids == own.encode_ordinary(ROWS[11][1])
    assert byte_bpe.encoded(none, RANKS, public_tokenizers.PATTERN).collect() == []


def test_bpe_spaces_and_odd_characters():
    own, made = library(), byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    texts = ["", " ", "  a  b", "a\n b\t\tc ", "it's  'll", "\x1c x\x85y z", "日本  語", "a" * 500, " " * 300 + "x", "\U0001f600 ́"]
    assert [[int(i) for i in x[1].split()] for x in made.apart(pa.array(texts))] == [own.encode_ordinary(x) for x in texts]
    assert [x[2] for x in made.apart(pa.array(texts))] == [x.encode() for x in texts]


def test_bpe_compatibility_is_that_of_the_merges():
    made = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    tokens = list(made.built.values())[::997]
    for left in tokens[:40]:
        for right in tokens[:40]:
            parts = made.merged(made.bytes_of[left] + made.bytes_of[right])
            assert made.compatible(left, right) == ([made.ranks[x] for x in parts] == [left, right])


# ---- packing ----


def test_packing_keeps_every_id_once(odd, none):
    own = Tokenizer.from_file(WORDS)
    own.encode_special_tokens = True
    pieces = packing.packed(odd, WORDS, sequence=64, quantum=16).collect()
    wanted = Counter()
    for doc, text, *_ in ROWS:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 1]
        wanted[doc, np.array(ids, dtype="<u4").tobytes()] += 1
    parts, sequences = defaultdict(list), defaultdict(list)
    for x in pieces:
        assert len(x["ids"]) == 4 * x["length"] > 0
        parts[x["doc_id"], x["doc_tokens"], x["start"]].append(x)
        sequences[x["sequence_id"]].append((x["offset"], x["length"]))
    for (doc, ids), n in wanted.items():  # equal rows give equal pieces, each as often as the row
        got = b"".join(bytes(v[0]["ids"]) for (d, t, s), v in sorted(parts.items(), key=lambda kv: kv[0][2]) if d == doc and t * 4 == len(ids))
        assert n > 1 or got == ids
    assert sum(x["length"] for x in pieces) == sum(len(ids) // 4 * n for (_, ids), n in wanted.items())
    for spans in sequences.values():
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
        total = spans[-1][0] + spans[-1][1]
        assert total == 64 or total & (total - 1) == 0
    assert packing.packed(none, WORDS).collect() == []


def test_packing_carries_deficits():
    totals = [70_000, 20_000, 10_000, 37]
    plan = packing.Schedule(totals, sequence=2048, quantum=256)
    taken = defaultdict(lambda: np.zeros(4))
    for queue, total in enumerate(totals):
        _, _, length, number, _ = plan.pieces(np.array([queue]), np.array([0]), np.array([total]))
        for k, n in zip(number.tolist(), length.tolist()):
            taken[k][queue] += n
    shares = np.array(totals) / sum(totals)
    run = np.zeros(4)
    for k in range(plan.full):
        assert taken[k].sum() == 2048
        assert (abs(taken[k] - 2048 * shares) <= 2 * 256).all()
        run += taken[k]
        assert (abs(run - (k + 1) * 2048 * shares) <= 2 * 256).all()  # deficits do not add up


def test_packing_deals_many_small_sources(spark):
    names = [f"s{i}" for i in range(packing.MAX_QUEUES + 6)]
    rows = [(100 * i + k, lorem(100 * i + k, 30), x) for i, x in enumerate(names) for k in range(3)]
    for big in ([], [(90_000 + k, lorem(90_000 + k, 60), "big") for k in range(100)]):
        docs = spark.createDataFrame(rows + big, "doc_id long, text string, source string").repartition(3, "doc_id")
        source = {x[0]: x[2] for x in rows + big}
        taken, parts = defaultdict(Counter), defaultdict(list)
        for x in packing.packed(docs, WORDS, sequence=64, quantum=16).collect():
            taken[x["sequence_id"]][source[x["doc_id"]]] += x["length"]
            parts[x["doc_id"]].append((x["start"], x["length"], x["doc_tokens"]))
        for own in parts.values():  # every id once
            own.sort()
            assert [a for a, _, _ in own] == [sum(n for _, n, _ in own[:i]) for i in range(len(own))]
            assert sum(n for _, n, _ in own) == own[0][2]
        assert set(parts) == set(source)
        totals = sum(taken.values(), Counter())
        everything, run = sum(totals.values()), Counter()
        for k in range(everything // 64):
            assert sum(taken[k].values()) == 64 and len(taken[k]) >= (3 if big else 4)
            run += taken[k]
            for name, n in totals.items():
                assert abs(run[name] - (k + 1) * 64 * n / everything) <= 3 * 16


# ---- language ----


def test_language(spark, odd, none):
    rows = [(i, lorem(i, 80).translate(str.maketrans("aeiou", "aeiou" if i % 2 else "áéíóú")), "xa" if i % 2 else "xb") for i in range(60)]
    rows += [(100, None, "xa"), (101, "12 34 !?", None), (102, "", "xb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fitted(docs.where("doc_id < 40"))
    found = {x["row"]["doc_id"]: x for x in language.identified(docs, model).collect()}
    assert all(found[i]["lang_pred"] == ("xa" if i % 2 else "xb") and 0 < found[i]["score"] <= 1 for i in range(40, 60))
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (100, 101, 102))
    empty = language.fitted(none)
    assert {x["lang_pred"] for x in language.identified(odd, empty).collect()} == {"und"}
    assert language.identified(none, model).collect() == []


def test_phrases_are_longest_matches():
    sample, text = "abracadabra abba", "cadabrabba"
    model = language.Model({"x": [sample]})
    phrases, at = 0, 0
    while at < len(text):
        n = max([k for k in range(1, len(text) - at + 1) if text[at : at + k] in sample], default=1)
        phrases, at = phrases + 1, at + n
    codes = model.code[language.points(text)].astype(np.int64)[:, None]
    assert model.phrases(model.tables[0], codes, np.ones(len(text), dtype=np.int64)).tolist() == [phrases]


def test_languages_of_other_scripts():
    """Two languages in non-Latin scripts beside one in Latin letters, each with more letters than a small alphabet holds."""
    rng = np.random.default_rng(5)

    def signs(first, n, seed):
        own = np.random.default_rng(seed).integers(0, 300, (60, 3))
        return " ".join("".join(chr(first + x) for x in own[i]) for i in rng.integers(0, 60, n))

    samples = {"en": [lorem(1, 4_000)], "ja": [signs(0x4E00, 300, 1)], "zh": [signs(0x4E00, 300, 2)]}
    model = language.Model(samples)
    found, score = model.predict([signs(0x4E00, 40, 1), signs(0x4E00, 40, 2), lorem(1, 60), None])
    assert found == ["ja", "zh", "en", "und"] and (score[:3] > 0.5).all()
    assert language.Model({"x": [lorem(2, 9_000)]}, sample=40_000).bits[0] == math.log2(40_000)


# ---- language model ----


def test_language_model_counts(odd, none):
    tr = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = lambda x: re.findall(r"[^\x20\x09-\x0D]+", (x or "").translate(tr)) + [""]
    held = lambda doc: doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0
    count = Counter()
    for doc, text, *_ in ROWS:
        if not held(doc):
            count.update(tokens(text))
    total, distinct = sum(count.values()), len(count)
    wanted = Counter()
    for doc, text, *_ in ROWS:
        own = tokens(text)
        base = sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in own)
        wanted[doc, held(doc), len(own), sum(count[x] > 0 for x in own), total, round(base, 6)] += 1
    for head in (lm.HEAD, 20):  # nearly all tokens are rare with the small one
        found = lm.scored(odd, lm.held_out("doc_id"), head=head, rounds=1).collect()
        assert Counter((*x[:5], round(x["base_score"], 6)) for x in found) == wanted
        assert all(math.isfinite(x["score"]) and x["score"] < 0 for x in found)
    assert lm.scored(none, lm.held_out("doc_id"), rounds=1).collect() == []


def test_language_model_learns(spark):
    rows = [(i, "red green blue yellow " * 20 if i % 2 else "one two three four " * 20) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lm.scored(docs, lm.held_out("doc_id")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > 0.8 * found[1]


def test_factors_sum_to_one():
    weights = lm.Weights(np.zeros(lm.CLASSES), np.zeros((lm.WORDS // lm.WIDTH, lm.WIDTH)))
    rows = np.arange(8).reshape(2, 4)
    target, sums, met = np.array([3, 5]), np.zeros_like(weights.tables[0]), np.zeros(lm.CLASS_ROWS, np.int64)
    weights.learn(rows, weights.class_bias, target, 0, sums, met)
    after = weights.factors(rows, weights.class_bias, 0)
    assert np.allclose(after.sum(axis=1), 1, atol=1e-5)
    assert (after[[0, 1], target] > 1 / lm.CLASSES).all() and met[:8].tolist() == [1] * 8


def test_step_is_the_sum_over_its_tokens():
    """Rows met once, twice, some times and often."""
    rng = np.random.default_rng(4)
    weights = lm.Weights(np.zeros(lm.CLASSES), np.zeros((lm.WORDS // lm.WIDTH, lm.WIDTH)))
    weights.tables[0][:] = rng.normal(size=weights.tables[0].shape)
    rows = np.minimum(rng.geometric(0.002, size=(1_500, 4)), 3_000) + np.array([0, 0, 0, 4_000])
    rows[:200, 1] = 9_000
    target, sums, met = rng.integers(0, lm.CLASSES, len(rows)), np.zeros_like(weights.tables[0]), np.zeros(lm.CLASS_ROWS, np.int64)
    gradient = weights.factors(rows, weights.class_bias, 0).astype(np.float64)
    gradient[np.arange(len(rows)), target] -= 1
    total, times = np.zeros_like(weights.tables[0], np.float64), np.bincount(rows.reshape(-1), minlength=lm.CLASS_ROWS)
    np.add.at(total, rows.reshape(-1), np.repeat(gradient, 4, axis=0))
    assert {0, 1, 2, 3} < set(times.tolist()) and times.max() > lm.MANY
    wanted = weights.tables[0] - lm.RATE * total / np.sqrt(total**2 + lm.FLOOR)
    weights.learn(rows, weights.class_bias, target, 0, sums, met)
    assert np.allclose(weights.tables[0], wanted, atol=1e-5) and (met == times).all() and np.allclose(sums, total**2, rtol=1e-4, atol=1e-5)


def test_texts_are_tokenised_before_training():
    """Training and scoring read numbers: those that the tokens of the texts have."""
    texts = pa.array(["b a zz", "", "A\tq  q zz ", "a"])
    starts, numbers, names = lm.tokens(texts)
    lexicon = lm.Lexicon(["a", "b"])
    hashes, places, classes = lexicon.look_up(names)
    codes, rare = lm.coded(starts, numbers, hashes, places, classes)
    known = lexicon.look_up(pa.array([lm.END, "a", "b"], pa.large_string()))
    part = pa.table({"codes": codes, "rare": rare})
    for low, n in ((0, 4), (1, 2), (2, 1), (4, 0)):
        batch = lm.Batch(part.slice(low, n), lm.Head(known[0], known[2]))
        own = numbers[starts[low] : starts[low + n]]
        assert (batch.starts == starts[low : low + n + 1] - starts[low]).all()
        assert (batch.hashes == hashes[own]).all() and (batch.places == places[own]).all() and (batch.classes == classes[own]).all()


def test_class_factor_has_four_features():
    """The class of a token may depend on the token before the last one alone."""
    names = pa.array(["a", "x", "y", "z", lm.END], pa.large_string())
    hashes, _, _ = lm.Lexicon([]).look_up(names)
    classes = np.array([0, 40, 41, 1, 2])  # x and y differ in class
    left, right = (lm.features(hashes[own], classes[own], np.array([0, 4])) for own in (np.array([0, 1, 3, 4]), np.array([0, 2, 3, 4])))
    assert left[0].shape == (4, 4) and left[1].shape == (4, 2)
    assert (left[0][2] == right[0][2]).sum() == 1  # only [skip w2] is shared
    assert lm.WORDS >= 1_024 and lm.TAILS >= 32


def test_line_dedup_of_ids_that_are_no_numbers(spark):
    rows = [("b", "same line here\nown b"), ("a", "Same line here \nown a"), (None, "same line here"), ("c", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = {r["doc_id"]: r["kept_text"] for r in line_dedup.line_dedup(docs).collect()}
    assert found == {"a": "Same line here \nown a", "b": "own b", None: "", "c": ""}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]
