"""Linear text classifier as tables: training, scores, top label, score of one class."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from pagesift.functions import text as T
from pagesift.functions.binding import let
from pagesift.functions.hashing import xx_31
from pagesift.operators.joins import BROADCAST_BYTES, lookup_join
from pagesift.session import materialize

#: Hashed features of a model that scores inside the row. Its size is this many weights per label, whatever the corpus.
FEATURES = 1 << 18
ENGLISH, LANG_THRESHOLD = "en", 0.65
MATH_THRESHOLD, MATH_REPORT_THRESHOLD = 0.5, 0.80


def tokens(text: Column) -> Column:
    return T.words(text)


def train_text_model(
    docs: DataFrame, label: str, id_col: str = "doc_id", text: str = "text", tokens_of: Callable[[Column], Column] = tokens
) -> DataFrame:
    """Multinomial naive Bayes with add-one smoothing: rows ``(token, weights map<label, weight>)``.

    The row with a NULL token holds the priors. Tokens are counted before the
    shuffle, so a frequent token is one row per map task. The counts are
    written once, since the vocabulary, the totals and the weights all need them.
    A map has as many entries as there are labels.
    """
    labelled = docs.where(F.col(label).isNotNull()).select(
        id_col, F.col(label).cast("string").alias("label"), tokens_of(F.col(text)).alias("tokens")
    )
    counts = materialize(
        labelled.select("label", F.explode_outer("tokens").alias("token"))
        .groupBy("label", "token")
        .agg(F.count(F.lit(1)).alias("n")),
        "token-counts",
    )
    known = counts.where(F.col("token").isNotNull())
    n_docs = docs.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("docs")
    )
    totals = known.groupBy("label").agg(F.sum("n").alias("total"))
    classes = materialize(n_docs.join(totals, "label", "left"), "classes")
    # Scalars: the number of tokens, and one entry for each label.
    vocabulary = known.agg(F.count_distinct("token").alias("v")).select("v").scalar()
    labels = classes.agg(F.array_sort(F.collect_list(F.struct("label", "total"))).alias("c")).select("c").scalar()
    per_token = known.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("n"))
    per_token = per_token.withColumns({"c": labels, "v": vocabulary})
    weight = lambda x: F.ln((F.coalesce(F.try_element_at("n", x["label"]), F.lit(0)) + 1) / (F.coalesce(x["total"], F.lit(0)) + F.col("v")))
    weights = per_token.select(
        "token", F.map_from_arrays(F.transform("c", lambda x: x["label"]), F.transform("c", weight)).alias("weights")
    )
    whole = classes.agg(F.collect_list(F.struct("label", "docs")).alias("c"), F.sum("docs").alias("all"))
    priors = whole.select(
        F.lit(None).cast("string").alias("token"),
        F.map_from_arrays(F.transform("c", lambda x: x["label"]), F.transform("c", lambda x: F.ln(x["docs"] / F.col("all")))).alias("weights"),
    )
    return weights.unionByName(priors)


@dataclass(frozen=True)
class RowModel:
    """Weights of hashed tokens, small enough to be sent to every task: texts are scored where they lie."""

    labels: list[str]
    weights: Broadcast
    features: int
    hash_fn: Callable[[Column], Column]
    prepare: Callable[[Column], Column]


def as_it_is(text: Column) -> Column:
    return text


def hashed_tokens(
    features: int, hash_fn: Callable[[Column], Column], prepare: Callable[[Column], Column] = as_it_is
) -> Callable[[Column], Column]:
    return lambda text: F.transform(tokens(prepare(text)), lambda t: (hash_fn(t) % features).cast("string"))


def train_row_model(
    docs: DataFrame, label: str, text: str = "text", features: int = FEATURES, hash_fn: Callable[[Column], Column] = xx_31,
    prepare: Callable[[Column], Column] = as_it_is,
) -> RowModel:
    """The same model over hashed tokens: at most ``features`` rows, which the driver reads.

    ``prepare`` is applied to every text, in training and in scoring, such as ``classifier_text`` for topic models.
    """
    rows = train_text_model(docs, label, text=text, tokens_of=hashed_tokens(features, hash_fn, prepare)).collect()
    priors = next(r["weights"] for r in rows if r["token"] is None)
    labels = sorted(priors)
    weights = np.zeros((features + 1, len(labels)))  # a token that training has not seen weighs nothing
    for row in rows:
        weights[features if row["token"] is None else int(row["token"])] = [row["weights"][x] for x in labels]
    return RowModel(labels, docs.sparkSession.sparkContext.broadcast(weights), features, hash_fn, prepare)


#: Numbers of tokens times labels that a worker weighs at once.
SLICE = 1 << 19


def _parts(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs [from, to) of rows with about ``most`` numbers."""
    runs = np.cumsum(lengths) // max(most, 1)
    cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(lengths)]
    return zip(cuts[:-1], cuts[1:])


def _sums(table: np.ndarray, numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``table`` that each text's numbers name; 0 without numbers."""
    out = np.zeros((len(lengths), table.shape[1]))
    filled = np.flatnonzero(lengths)
    if len(filled):
        starts = np.cumsum(lengths) - lengths
        out[filled] = np.add.reduceat(table[numbers], starts[filled], axis=0)
    return out


def _shares(table: np.ndarray, numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probabilities of the labels for several texts at once; the last row of ``table`` holds the priors."""
    logs = _sums(table, numbers, lengths) + table[-1]
    powers = np.exp(logs - logs.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _rows_of(values: np.ndarray, known: np.ndarray | None = None) -> pa.ListArray:
    """The rows of a matrix as arrays, NULL where ``known`` is false."""
    offsets = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
    mask = None if known is None or known.all() else pa.array(~known)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1)), mask=mask)


def row_scores(model: RowModel, text: Column) -> Column:
    """Probabilities of the labels, ``array<double>`` in the order of ``model.labels``; NULL for a NULL text.

    The text is taken as it is; ``with_scores`` prepares it as in training.
    """
    shared = model.weights

    def score(numbers: pa.Array) -> pa.Array:
        table = shared.value
        known = np.asarray(numbers.is_valid())
        lengths = np.asarray(numbers.value_lengths().fill_null(0)).astype(np.int64)
        out = np.empty((len(numbers), table.shape[1]))
        for low, high in _parts(lengths, SLICE // table.shape[1]):
            out[low:high] = _shares(table, np.asarray(numbers.slice(low, high - low).flatten()), lengths[low:high])
        return _rows_of(out, known)

    numbers = F.transform(tokens(text), lambda t: (model.hash_fn(t) % model.features).cast("int"))
    return F.arrow_udf(score, "array<double>")(F.when(text.isNotNull(), numbers))


def with_scores(docs: DataFrame, model: RowModel, text: str = "text", out: str = "scores") -> DataFrame:
    """``docs`` with the probabilities of the labels of their texts, prepared as the model's texts were."""
    # Preparing may take Python, as scoring does, and the one cannot stand inside the other: a generator parts them.
    ready = docs.select("*", F.explode(F.array(model.prepare(F.col(text)))).alias("_ready"))
    return ready.withColumn(out, row_scores(model, F.col("_ready"))).drop("_ready")


# ---- character n-grams ----

# Fixed values of the hash: it is a polynomial of code points, so any engine can repeat it.
GRAM_SIZES, GRAM_BASE, GRAM_PRIME = (1, 2, 3), 1_000_003, (1 << 31) - 1
MODEL_BYTES = 512 << 20
#: Counts that a task holds at once.
COUNT_BYTES = 64 << 20


@dataclass(frozen=True)
class CharModel:
    """Weights of hashed character n-grams, one column per label, small enough to be sent to every task."""

    labels: list[str]
    weights: Broadcast
    sizes: tuple[int, ...]


def gram_line(text: Column) -> Column:
    """The text whose character n-grams count: lower case, one line, a blank at both ends."""
    return F.concat(F.lit(" "), T.one_line(F.lower(text)), F.lit(" "))


def char_grams(line: str, sizes: Sequence[int] = GRAM_SIZES, features: int = FEATURES) -> np.ndarray:
    """Numbers of all n-grams of code points."""
    codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = []
    for n in sizes:
        hashes = np.full(max(len(codes) - n + 1, 0), n, dtype=np.int64)
        for k in range(n):
            hashes = (hashes * GRAM_BASE + codes[k : k + len(hashes)]) % GRAM_PRIME
        out.append(hashes % features)
    return np.concatenate(out)


def gram_pieces(line: str, sizes: Sequence[int] = GRAM_SIZES, features: int = FEATURES, most: int = 1 << 16) -> Iterator[np.ndarray]:
    """The numbers of ``char_grams`` in pieces, so a long line takes no more memory than ``most`` characters do."""
    if len(line) <= most:
        yield char_grams(line, sizes, features)
        return
    for n in sizes:
        for at in range(0, len(line) - n + 1, most):
            yield char_grams(line[at : at + most + n - 1], (n,), features)


def train_char_model(
    docs: DataFrame, label: str, text: str = "text", features: int = FEATURES, sizes: Sequence[int] = GRAM_SIZES
) -> CharModel:
    """Multinomial model over hashed character n-grams, with add-one smoothing over all ``features``.

    Tasks count the n-grams of all their texts in one array for each label, as long as these have ``COUNT_BYTES``, and
    send each number once; no text's n-grams are held longer than it is counted. The sums of a label become one binary row of
    at most ``features`` weights, which the driver puts side by side. Their size is checked before.
    """
    sizes = tuple(sizes)

    def counted(found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, counts in found.items():
            numbers = np.flatnonzero(counts)
            for at in range(0, len(numbers), 50_000):
                some = numbers[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], ["label", "f", "n"]
                )

    def count(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, line in zip(batch.column(0), batch.column(1)):
                name, line = name.as_py(), line.as_py()
                if name not in found and 8 * features * (len(found) + 1) > COUNT_BYTES:
                    yield from counted(found)
                    found = {}
                counts = found.setdefault(name, np.zeros(features, np.int64))
                for grams in gram_pieces(line or "", sizes, features):
                    if 8 * len(grams) > features:
                        counts += np.bincount(grams, minlength=features)
                    else:
                        np.add.at(counts, grams, 1)
        yield from counted(found)

    def weigh(table: pa.Table) -> pa.Table:
        n = np.zeros(features)
        np.add.at(n, table.column("f").to_numpy(), table.column("n").to_numpy())
        logs = np.log((n + 1) / (n.sum() + features))
        return pa.table({"label": table.column("label").slice(0, 1), "w": pa.array([logs.tobytes()], pa.binary())})

    labelled = docs.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), gram_line(F.col(text)).alias("line"))
    n_docs = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if 8 * features * len(n_docs) > MODEL_BYTES:
        raise ValueError(f"{len(n_docs)} labels of {features} weights are more than {MODEL_BYTES} bytes; take fewer features")
    sums = labelled.mapInArrow(count, "label string, f long, n long").groupBy("label", "f").agg(F.sum("n").alias("n"))
    rows = {r["label"]: r["w"] for r in sums.groupBy("label").applyInArrow(weigh, "label string, w binary").collect()}
    labels, every = sorted(n_docs), sum(n_docs.values())
    none = np.full(features, -np.log(features))
    weights = np.stack([np.frombuffer(rows[x]) if x in rows else none for x in labels], axis=1)
    priors = np.log([n_docs[x] / every for x in labels])
    return CharModel(labels, docs.sparkSession.sparkContext.broadcast((weights, priors)), sizes)


def char_scores(model: CharModel, text: Column) -> Column:
    """Probabilities of the labels, in their order, from the text where it lies; NULL for a NULL text."""
    shared, sizes = model.weights, model.sizes

    def score(lines: pd.Series) -> pd.Series:
        weights, priors = shared.value

        def one(line: str | None):
            if line is None:
                return None
            logs = priors + sum(weights[grams].sum(axis=0) for grams in gram_pieces(line, sizes, len(weights)))
            powers = np.exp(logs - logs.max())
            return powers / powers.sum()

        return lines.map(one)

    return F.pandas_udf(score, "array<double>")(gram_line(text))


def best_label(model: RowModel | CharModel, scores: Column) -> Column:
    """``struct(r, label, score)`` of the best label; ties go to the one that sorts last."""
    names = F.array(*[F.lit(x) for x in model.labels])
    pairs = F.zip_with(names, scores, lambda n, s: F.struct(F.round(s, 9).alias("r"), n.alias("label"), s.alias("score")))
    return F.array_max(pairs)


def label_score(model: RowModel | CharModel, scores: Column, name: str) -> Column:
    """Score of one label; 0 if the model does not know it."""
    if name not in model.labels:
        return F.when(scores.isNotNull(), F.lit(0.0))
    return F.get(scores, F.lit(model.labels.index(name)))


def model_rows(model: DataFrame) -> DataFrame:
    """The model in long form ``(token, label, weight)``."""
    return model.select("token", F.explode("weights").alias("label", "weight"))


def _by_frequency(lookup: DataFrame, names: list[str], limit: int) -> tuple[pa.Table, DataFrame | None]:
    """The rows of the most frequent tokens, of ``limit`` bytes at most, and the others, None if there are none.

    Levels of frequency are counted, not sorted: a level is taken as a whole.
    """
    share = F.aggregate(F.array(*names), F.lit(0.0), lambda a, w: a + F.exp(w))
    levelled = lookup.withColumn("level", F.floor(4 * F.ln(share)).cast("int"))
    size = F.octet_length("token").cast("long") + F.lit(48 + 8 * len(names))
    held, least = 0, None
    levels = levelled.groupBy("level").agg(F.sum(size).alias("b")).orderBy(F.desc("level")).collect()
    for row in levels:
        held += row["b"]
        if held > limit:
            break
        least = row["level"]
    taken = F.lit(False) if least is None else F.col("level") >= least
    rare = None if held <= limit else levelled.where(~taken).drop("level")
    return levelled.where(taken).drop("level").toArrow(), rare


def _frequent_sums(shared: Broadcast, names: list[str]):
    """For each text the sums of its frequent tokens' weights, and its other tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.Table.from_batches(shared.value) if shared.value else None
        n = known.num_rows if known is not None else 0
        values = known.column("token").combine_chunks() if n else pa.array([], pa.string())
        weights = np.zeros((n + 1, len(names)))  # the last row is that of all other tokens
        for i, name in enumerate(names if n else ()):
            weights[:n, i] = known.column(name).to_numpy()
        for batch in batches:
            lists = batch.column(1)
            lengths = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            for low, high in _parts(lengths, SLICE):
                flat, sizes = lists.slice(low, high - low).flatten(), lengths[low:high]
                coded = flat.dictionary_encode()
                at = np.asarray(pc.index_in(coded.dictionary, value_set=values).fill_null(n)).astype(np.int64)
                at = at[np.asarray(coded.indices)] if len(flat) else np.zeros(0, np.int64)
                columns = [_sums(weights[:, i : i + 1], at, sizes)[:, 0] for i in range(len(names))]
                left = np.concatenate([[0], np.cumsum(at == n)])[np.concatenate([[0], np.cumsum(sizes)])]
                rest = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(at == n)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *map(pa.array, columns), rest], [batch.schema.names[0], *names, "rest"])

    return run


def score_text(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """Probability of every label: ``(id, scores array<struct<label, score>>)``.

    The weights of the most frequent tokens, as many as may be broadcast, are summed in the row. Only the other
    tokens of a text meet their weights in a join. The sums per label are combined
    on the map side, so the only shuffle of documents carries one row each.
    """
    # The labels are read by the driver: there are as many as classes, not as rows.
    priors = model.where(F.col("token").isNull()).select("weights").first()["weights"]
    labels = sorted(priors)
    lookup = model.where(F.col("token").isNotNull()).select(
        "token", *[F.element_at("weights", name).alias(f"w{i}") for i, name in enumerate(labels)]
    )
    names = [f"w{i}" for i in range(len(labels))]
    frequent, rare = _by_frequency(lookup, names, limits.get("broadcast_bytes", BROADCAST_BYTES))
    shared = docs.sparkSession.sparkContext.broadcast(frequent.combine_chunks().to_batches())
    kind = S.StructType().add(docs.select(id_col).schema[0])
    for name in names:
        kind = kind.add(name, "double")
    rows = docs.select(id_col, tokens(F.col(text)).alias("tokens")).mapInArrow(_frequent_sums(shared, names), kind.add("rest", S.ArrayType(S.StringType())))
    if rare is not None:
        rows = materialize(rows, "frequent-sums")
        rest = rows.select(id_col, F.explode("rest").alias("token"))
        hits = lookup_join(rest, rare, "token", **limits)
        rows = rows.drop("rest").unionByName(hits.drop("token"))
    sums = rows.groupBy(id_col).agg(*[F.coalesce(F.sum(f"w{i}"), F.lit(0.0)).alias(f"s{i}") for i in range(len(labels))])
    logs = F.array(*[F.col(f"s{i}") + F.lit(float(priors[name])) for i, name in enumerate(labels)])

    def softmax(values: Column) -> Column:
        powers = F.transform(values, lambda v: F.exp(v - F.array_max(values)))
        names = F.array(*[F.lit(name) for name in labels])
        return let(
            powers,
            lambda e: F.zip_with(
                names,
                e,
                lambda name, x: F.struct(
                    name.alias("label"), (x / F.aggregate(e, F.lit(0.0), lambda acc, y: acc + y)).alias("score")
                ),
            ),
        )

    return sums.select(id_col, let(logs, softmax).alias("scores"))


def score_rows(scores: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Scores in long form ``(id, label, score)``."""
    return scores.select(id_col, F.inline("scores"))


def top_language(scores: DataFrame, id_col: str = "doc_id", k: int = 1) -> DataFrame:
    """The k best labels of each row; ties go to the label that sorts last."""
    ranked = F.array_sort(
        F.transform("scores", lambda s: F.struct(F.round(s["score"], 9).alias("r"), s["label"].alias("label"), s["score"].alias("score")))
    )
    best = F.slice(F.reverse(ranked), 1, k)
    rows = scores.select(id_col, F.posexplode(best).alias("rank", "b"))
    out = rows.select(
        id_col, (F.col("rank") + 1).alias("rank"), F.col("b.label").alias("lang"), F.col("b.score").alias("lang_score")
    )
    return out.drop("rank") if k == 1 else out


def class_score(scores: DataFrame, name: str, out: str = "class_score", id_col: str = "doc_id") -> DataFrame:
    """Score of one label; 0 if the model does not know it."""
    found = F.filter("scores", lambda s: s["label"] == name)
    return scores.select(id_col, F.coalesce(F.get(found, F.lit(0))["score"], F.lit(0.0)).alias(out))


def score_lang(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Best language and its score per document."""
    return top_language(score_text(docs, model, id_col, text), id_col)


def score_math(docs: DataFrame, model: DataFrame, name: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Score of the wanted class per document, as ``math_score``."""
    return class_score(score_text(docs, model, id_col, text), name, "math_score", id_col)


def lang_filter(df: DataFrame, lang: str = ENGLISH, threshold: float = LANG_THRESHOLD) -> DataFrame:
    return df.where((F.col("lang") == lang) & (F.col("lang_score") >= threshold))


def math_filter(df: DataFrame, threshold: float = MATH_THRESHOLD) -> DataFrame:
    return df.where(F.col("math_score") >= threshold)


def score_threshold_report(
    df: DataFrame, by: Sequence[str] = (), retain: float = MATH_THRESHOLD, report: float = MATH_REPORT_THRESHOLD
) -> DataFrame:
    """Documents retained at one threshold, and those reported at a higher one."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col("math_score") >= retain).alias("n_retained"),
        F.count_if(F.col("math_score") >= report).alias("math_retained"),
    )
