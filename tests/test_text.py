import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pagesift.catalog.text import gram_hash
from pagesift.functions import text as T
from pagesift.functions.hashing import OF_BYTES, OF_RUNS, md5_31
from pagesift.functions.minhash import run_hashes
from pagesift.functions.unicode import classifier_text, nfkc


def letters(text):
    return F.array(*[F.lit(c) for c in text])


def test_ngrams_of_four(one):
    assert one(lambda: T.ngrams(letters("FGHIJ"), 4), t="") == ["F G H I", "G H I J"]


def test_overlap_of_four_and_five(one):
    assert one(lambda: T.overlap_ngrams(letters("ABCDE"), letters("FGHIJ"), 4), t="") == ["C D E F", "D E F G", "E F G H"]
    assert one(lambda: T.overlap_ngrams(letters("ABCDE"), letters("FGHIJ"), 5), t="") == [
        "B C D E F", "C D E F G", "D E F G H", "E F G H I",
    ]


def test_overlap_with_short_sides(one):
    assert one(lambda: T.overlap_ngrams(letters("A"), letters("FGHI"), 4), t="") == ["A F G H"]
    assert one(lambda: T.overlap_ngrams(letters("ABCD"), letters("F"), 4), t="") == ["B C D F"]
    assert one(lambda: T.overlap_ngrams(letters("A"), letters("F"), 4), t="") == []


def test_text_shorter_than_n_has_no_ngrams(one):
    assert one(lambda: T.ngrams(T.words(F.col("t")), 12), t="too short") == []
    assert one(lambda: T.ngrams(T.words(F.col("t")), 3), t="") == []


def test_simplify(one):
    assert one(lambda: T.simplify(F.col("t")), t=" Don't\tSTOP, Ünder-way! 42 ") == "dont stop ünderway 42"
    assert one(lambda: T.simplify(F.col("t"), norm_numbers=True), t="a 42 b7") == "a 0 b0"
    assert one(lambda: T.simplify(F.col("t"), remove_punctuation=False), t="A,  b!") == "a, b!"


def test_word_punct_tokens(one):
    assert one(lambda: T.word_punct_tokens(F.col("t")), t="Good muffins cost $3.88\nin naïve_x.") == [
        "Good", "muffins", "cost", "$", "3", ".", "88", "in", "naïve_x", ".",
    ]


def test_classifier_line(one):
    text = "Let X-1 = 42, y_2 < " + "z" * 101 + " été"
    assert one(lambda: T.classifier_line(F.col("t")), t=text) == "let x <NUM> <NUM> y 2 < t"


def test_long_digit_token_becomes_a_number(one):
    assert one(lambda: T.classifier_line(F.col("t")), t="1" * 200) == "<NUM>"


def test_cut_lines(one):
    assert one(lambda: T.cut_lines(F.col("t"), 2), t="a b c d e") == "a b <EOS> c d <EOS> e"
    assert one(lambda: T.cut_lines(F.col("t"), 5), t="a b c d e") == "a b c d e"
    assert one(lambda: T.cut_lines(F.col("t"), 5), t="") == ""


def test_nfkc_and_whole_preprocessing(one):
    assert one(lambda: nfkc(F.col("t")), t="ﬁ x² Ａ") == "fi x2 A"
    assert one(lambda: classifier_text(F.col("t")), t="ﬁnd x²\n= ４２") == "find x2 <NUM>"


def test_marks_can_be_dropped(one):
    assert one(lambda: T.simplify(F.col("t"), strip_diacritics=True), t="Élève, Ñandú ÅNGSTRÖM") == "eleve nandu angstrom"
    assert one(lambda: T.simplify(F.col("t")), t="Élève") == "élève"
    assert one(lambda: T.simplify(F.col("t"), strip_diacritics=True), t=None) is None


def test_cut_lines_read_their_tokens_once(spark):
    line = F.lit("a b " * 5)
    row = spark.range(1).select(
        T.cut_lines(line, 2).alias("even"), T.cut_lines(line, 4).alias("rest"), T.cut_lines(line, 10).alias("whole"),
        T.cut_lines(F.lit(" "), 2).alias("empty"), T.cut_lines(F.lit(None).cast("string"), 2).alias("none"),
    ).first()
    assert row["even"] == " <EOS> ".join(["a b"] * 5) and row["rest"] == "a b a b <EOS> a b a b <EOS> a b"
    assert row["whole"] == " ".join(["a b"] * 5) and row["empty"] == row["none"] == ""
    plan = spark.range(1).select(T.cut_lines(F.col("id").cast("string"), 2).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert "slice" not in plan  # it copies the tokens of the whole line for every piece


def test_lines_from_bytes_equal_simplify(spark):
    """Every character that the byte-wise form knows, and some that it leaves to the patterns."""
    known = [chr(x) for x in (*range(1, 0x300), *range(0x2000, 0x2080), 0x130, 0x212A, 0x3A3, 0x416, 0x65E5, 0x1F600, 0x1D7D8)]
    texts = [f"A{c}B {c} d {c}E{c}" for c in known] + [" ", "", "  a \n\t b  ", " x", "x ", "—", "é!", None, "".join(known)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)

    def lines(batches):
        for batch in batches:
            made = T.simple_lines(batch.column(1)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), made, batch.column(2)], ["id", "made", "wanted"])

    rows = df.select("id", T.half_simple(F.col("text")).alias("t"), F.coalesce(T.simplify(F.col("text")), F.lit("")).alias("wanted"))
    found = rows.mapInArrow(lines, "id long, made string, wanted string").collect()
    assert len(found) == len(texts) and [r for r in found if r["made"] != r["wanted"]] == []
    tail = pa.array(["cut, off", "A b", None, "c  d"])[1:]
    assert T.simple_lines(tail).cast(pa.string()).to_pylist() == ["A b", "", "c d"]


def test_hashes_of_runs_equal_the_expressions(spark):
    words = ["a", "Bé", "x" * 12, "y" * 60, "z" * 300, "-", "7,5"]
    texts = [" ".join(words[(i * k + i) % 7] for k in range(i)) for i in range(40)] + [None, "", "a b c d", "a b c d e", "a b c d e"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    wanted = df.select("id", F.transform(T.ngrams(T.words(F.col("text")), 5), md5_31).alias("hashes"))
    found = run_hashes(df.select("id", T.half_simple(F.col("text"))), "id", 5, OF_BYTES[md5_31])
    assert {r[0]: r[1] for r in found.collect()} == {r[0]: r[1] for r in wanted.collect()}
    data, cuts = b"".join(x.encode() for x in words) * 3, np.arange(0, 1_100)
    starts, ends = np.zeros(len(cuts), np.int64), cuts
    assert (OF_RUNS[OF_BYTES[md5_31]](data, starts, ends) == OF_BYTES[md5_31]([data[:n] for n in cuts])).all()


def test_gram_hash_works_on_bytes(spark, tmp_path):
    """No pattern replaces punctuation in usual texts, and no run of words is put together in the JVM."""
    spark.createDataFrame([(1, "One, two three four five six")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = gram_hash(spark, str(tmp_path))
    assert [r["pos"] for r in found.orderBy("pos").collect()] == [0, 1]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "concat_ws" not in plan and "md5(" not in plan
