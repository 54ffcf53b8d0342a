"""Importance resampling: documents are drawn by how much their n-grams look like a target's.

A text is turned to bytes, A-Z to lower case, and every run of separators (all of ASCII but letters
and digits) to one space.  ``regex.finditer`` with ``overlapped=True`` then walks it: a run of n words
starts behind a space and ends before one, as lookarounds demand, so each match is the span of an
n-gram, and overlapping ones are all met.  Spans of 1 to ``most`` words are hashed with CRC-32 as they
come, into ``buckets`` buckets; repeats count.

All documents hold S features, s of them in a bucket, the target texts T and t.  A bucket's gain is
the log ratio of both smoothed shares in thousandths, a document's weight the sum of its features'
gains.  Gumbel noise from a hash of seed and id is added, and of the documents with ``least`` words the
best ``percent`` are drawn: sampling without replacement in proportion to exp(weight / 1000).

Texts are read once: a document's buckets are kept as two or four bytes a feature.  The two tables of
counts have ``buckets`` rows; only they are broadcast.  Drawn documents are ranked by a range
partitioning on the whole order, and one count a partition, so no task sees all of them.

Null and blank texts have no feature, weight 0 and no rank.  A null id is hashed as the empty text and
comes last among equals; rows equal in id and score come by weight and number of features, and equal
rows have neighbouring ranks.  Empty tables give empty results; an empty target has T = 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellarium.llm.common import batches
from cellarium.plans.scratch import settle

WORDS = 1
BUCKETS = 10_000
LEAST = 20
PERCENT = 10
SEED = 2024

SEPARATORS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(text: str | None, patterns: list, buckets: int) -> tuple[int, np.ndarray]:
    """Words of a text, and the buckets of all its n-grams, shorter ones first."""
    separators, *grams = patterns
    line = separators.sub(b" ", (text or "").encode().lower()).strip(b" ")
    known: dict[bytes, int] = {}
    found, n_words = [], 0
    for n, gram in enumerate(grams, 1):
        for match in gram.finditer(line, overlapped=True):
            span = match.group()
            if span not in known:
                known[span] = zlib.crc32(span) % buckets
            found.append(known[span])
        n_words = len(found) if n == 1 else n_words
    return n_words, np.array(found, np.int64)


def compiled(most: int) -> list:
    """Patterns of separators, then of one word, two words and so on."""
    import regex

    grams = [rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1) for n in range(1, most + 1)]
    return [regex.compile(p) for p in (SEPARATORS, *grams)]


def scan(texts: DataFrame, most: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """Adds to rows with a ``text`` in their last column: n_words, n_features and ``features``.

    The last is the buckets in order, as little-endian unsigned numbers of two bytes, or four if
    there are over 65,536 buckets.  The text goes.
    """
    kept = texts.columns[:-1]
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def scanned(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = compiled(most)
        for batch in batches(rows, 512):
            found = [features(x.as_py(), patterns, buckets) for x in batch.column(len(kept))]
            columns = [
                *batch.columns[: len(kept)],
                pa.array([n for n, _ in found], pa.int64()),
                pa.array([len(own) for _, own in found], pa.int64()),
                pa.array([own.astype(kind).tobytes() for _, own in found], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_words", "n_features", "features"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1]]
    schema = ", ".join([*kinds, "n_words bigint", "n_features bigint", "features binary"])
    return texts.mapInArrow(scanned, schema)


def bucket_counts(scanned: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, count) over all rows; every task adds its own rows up first."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in rows:
            for own in batch.column(0):
                total += np.bincount(np.frombuffer(own.as_py(), kind), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", name])

    each = scanned.select("features").mapInArrow(counted, f"bucket bigint, {name} bigint")
    return each.groupBy("bucket").agg(F.sum(name).alias(name))


def gains(own: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, met or not, from scanned documents and scanned target texts."""
    every = own.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    counts = (
        every.join(bucket_counts(own, "s", buckets), "bucket", "left")
        .join(bucket_counts(target, "t", buckets), "bucket", "left")
        .select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")])
    )
    counts = settle(counts, "counts")
    totals = counts.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = ((F.col("t") + 1) * (F.col("all_s") + buckets)) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    gain = F.floor(1000 * F.log(ratio)).cast("bigint")
    return counts.join(F.broadcast(totals)).select("bucket", gain.alias("gain"))


def weigh(scanned: DataFrame, gain: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``weight`` in place of the features.  ``gain`` has ``buckets`` rows, the bound of what is sent."""
    kind = np.dtype("<u2") if buckets <= 1 << 16 else np.dtype("<u4")
    table = np.zeros(buckets, np.int64)
    rows = gain.toArrow()
    table[rows.column("bucket").to_numpy()] = rows.column("gain").to_numpy()
    sent = scanned.sparkSession.sparkContext.broadcast(table)
    kept = [c for c in scanned.columns if c != "features"]

    def weighed(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = sent.value
        for batch in batches_:
            weight = [int(by_bucket[np.frombuffer(own.as_py(), kind)].sum()) for own in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(weight, pa.int64())], names=[*kept, "weight"]
            )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in scanned.schema.fields if f.name != "features"]
    return scanned.select(*kept, "features").mapInArrow(weighed, ", ".join([*kinds, "weight bigint"]))


def noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def numbered(rows: DataFrame, order: list, name: str) -> DataFrame:
    """Adds the place of each row in the whole order, from 1; one count a partition goes to the driver."""
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = laid.withColumn("_at", F.monotonically_increasing_id())
    laid = settle(laid, "ordered").withColumn("_part", F.shiftright("_at", 33))
    ends = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    before = [0, *accumulate(r["n"] for r in ends)]
    first = rows.sparkSession.createDataFrame(
        [(r["_part"], b) for r, b in zip(ends, before, strict=False)], "_part bigint, _before bigint"
    )
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return laid.join(F.broadcast(first), "_part").select(*rows.columns, place.alias(name))


def resample(
    docs: DataFrame,
    target: DataFrame,
    most: int = WORDS,
    buckets: int = BUCKETS,
    least: int = LEAST,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs`` (doc_id, text).

    ``rank`` counts the drawn documents from 1, best score first, ties to the smaller id; it is null
    for the others.
    """
    own = settle(scan(docs.select("doc_id", "text"), most, buckets), "features")
    aim = settle(scan(target.select("text"), most, buckets), "target")
    scored = weigh(own, gains(own, aim, buckets), buckets)
    scored = scored.withColumn("score", F.col("weight") + noise(seed))
    scored = settle(scored.withColumn("_place", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_words") >= least)
    drawn = able.count() * percent // 100
    # The last one lets a range of equal rows be cut.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(),
             F.col("n_features").desc(), F.col("_place").asc()]
    ranked = numbered(able, order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
