"""Archive listings: catalog of dumps, positions, splits, and what is left to do."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Dumps in an older format, patterns, path parts.
UNSUPPORTED_DUMPS = ("CC-MAIN-2012", "CC-MAIN-2009-2010", "CC-MAIN-2008-2009")
DUMP = r"(CC-MAIN-[0-9]{4}(?:-[0-9]+)?)"
INDEX_PAGE = "index.html"
LISTING_FILE = "warc.paths.gz"
INPUT_ROOT, TEXT_FOLDER, HTML_FOLDER, RAW_FOLDER = "crawl-data", "segments_en", "html_en", "segments"

# Number of splits each stage of the job used.
STAGE_SPLITS = {"text": 200, "quality": 20, "hashes": 20, "local_dedup": 70, "reorganize_split": 20}
MERGE_SPLITS = {"1-1": 10, "2-5": 10, "6-10": 7, "11-100": 5, "101-1000": 3, "1001-inf": 2}

SHUFFLE_DIGITS = 3  # 4,096 buckets


def dump_of(path: Column) -> Column:
    return F.regexp_extract(path, DUMP, 1)


def dump_paths(links: DataFrame, url: str = "url") -> DataFrame:
    """Dump name and listing address of an index page's address."""
    parts = F.split(F.col(url), "/")
    listing = F.concat(F.get(F.split(F.col(url), r"index\.html"), F.lit(0)), F.lit(LISTING_FILE))
    return links.select(url, F.try_element_at(parts, F.lit(-2)).alias("dump"), listing.alias("listing_url"))


def dump_filter(dumps: DataFrame, existing: DataFrame | None = None, skip: Sequence[str] = UNSUPPORTED_DUMPS) -> DataFrame:
    """Dumps to fetch: not in an unsupported format, not there already."""
    out = dumps.where(~F.col("dump").isin(list(skip)))
    return except_dumps(out, existing) if existing is not None else out


def except_dumps(dumps: DataFrame, existing: DataFrame) -> DataFrame:
    return dumps.join(existing.select("dump").distinct(), "dump", "left_anti")


def output_paths(listing: DataFrame, path: str = "cc_path", text_root: str = "extracted", math_root: str = "math") -> DataFrame:
    """Output paths that mirror the archive path, for English text, and for math text and HTML."""

    def target(root: str, folder: str) -> Column:
        out = F.replace(F.col(path), F.lit(INPUT_ROOT), F.lit(root))
        out = F.replace(out, F.lit(".gz"), F.lit(".jsonl.gz"))
        return F.replace(out, F.lit(RAW_FOLDER), F.lit(folder))

    return listing.select(
        path,
        target(text_root, TEXT_FOLDER).alias("en_text_path"),
        target(math_root, TEXT_FOLDER).alias("math_text_path"),
        target(math_root, HTML_FOLDER).alias("math_html_path"),
    )


# ---- positions ----


def number_rows(
    df: DataFrame,
    bucket: Column,
    order: Sequence[Column] = (),
    out: str = "pos",
    within: Sequence[str] = (),
    inside: Column | None = None,
) -> DataFrame:
    """Dense position from 0, over all rows or per ``within``, without sorting a whole group in one task.

    ``bucket`` must rise with ``order``. Rows are counted per bucket, the counts
    are summed up over the few buckets, and rows are numbered inside theirs.
    ``inside`` is that number where the rows have it already; no row is sorted then.
    """
    tagged = df.withColumn("_bucket", bucket)
    counts = tagged.groupBy(*within, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*within, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    if inside is None:
        inside = F.row_number().over(Window.partitionBy(*within, "_bucket").orderBy(*order)) - 1
    return (
        tagged.withColumn("_inside", inside)
        .join(offsets, [*within, "_bucket"])
        .withColumn(out, (F.col("_offset") + F.col("_inside")).cast("long"))
        .drop("_bucket", "_inside", "_offset")
    )


def shuffle_key(value: Column, seed: int) -> Column:
    """A repeatable random order: the digest of seed and value."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), value))


def number_shuffled(listing: DataFrame, seed: int = 0, value: str = "value", tie: str = "pos", out: str = "pos") -> DataFrame:
    """Positions in a random but repeatable order. Equal lines differ by their old position."""
    old = listing.withColumnRenamed(tie, "_old")
    text = F.concat_ws("#", F.col(value), F.col("_old").cast("string"))
    keyed = old.withColumn("_key", shuffle_key(text, seed))
    bucket = F.conv(F.substring("_key", 1, SHUFFLE_DIGITS), 16, 10).cast("long")
    return number_rows(keyed, bucket, [F.col("_key")], out).drop("_key", "_old")


def limit_skip(listing: DataFrame, limit: int = -1, skip: int = 0, pos: str = "pos") -> DataFrame:
    """The reader's ``skip`` and ``limit`` on positions; a negative limit reads all."""
    out = listing.where(F.col(pos) >= skip)
    return out if limit < 0 else out.where(F.col(pos) < skip + limit)


# ---- splits ----


def split_consecutive(listing: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """Add ``split``: n runs of lines, the first ``total % n`` one line longer."""
    total = listing.agg(F.count(F.lit(1)).alias("t")).select("t").scalar()
    base = F.floor(total / n)
    extra = total % n
    longer = extra * (base + 1)
    at = F.col(pos)
    split = F.when(at < longer, F.floor(at / (base + 1))).otherwise(
        extra + F.floor((at - longer) / F.greatest(base, F.lit(1)))
    )
    return listing.withColumn("split", split.cast("long"))


def split_round_robin(listing: DataFrame, n: int, pos: str = "pos") -> DataFrame:
    """Add ``split``: every n-th line."""
    return listing.withColumn("split", F.pmod(F.col(pos), F.lit(n)).cast("long"))


def split_listing(listing: DataFrame, n: int, shuffle: bool = False, consecutive: bool = False, seed: int = 0) -> DataFrame:
    numbered = number_shuffled(listing, seed) if shuffle else listing
    return split_consecutive(numbered, n) if consecutive else split_round_robin(numbered, n)


# ---- progress ----


def remaining_files(listing: DataFrame, finished: DataFrame, path: str = "cc_path") -> DataFrame:
    """Archives of the listing that have no finished result."""
    return listing.select(path).join(finished.select(path).distinct(), path, "left_anti")


def completed_by_dump(finished: DataFrame, path: str = "cc_path") -> DataFrame:
    return finished.groupBy(dump_of(F.col(path)).alias("dump")).agg(F.count_distinct(F.col(path)).alias("n_files"))


def record_ordinal(records: DataFrame, archive: str = "cc_path", order: str = "offset", span: int = 64 << 20) -> DataFrame:
    """Position of each record in its archive, for sources that do not number records themselves.

    ``order`` is a number such as the byte offset. An archive is numbered in
    stretches of ``span``, so a huge one is shared by many tasks.
    """
    stretch = F.floor(F.col(order) / span)
    return number_rows(records, stretch, [F.col(order)], "record_idx", [archive])
