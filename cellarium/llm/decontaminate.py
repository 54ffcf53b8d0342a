"""Benchmark decontamination with spaced seeds.

A mask names four or five of the words of a span; the others may be anything.  Hashes of the masked words
of every span of every benchmark item and of every document are joined.  A hit says that an item may
lie at a place of a document.  There the words of both are laid side by side, and the item overlaps
if WINDOW of its words in a row agree in four fifths or more of the places (all its words, if these
are fewer).

Two masks hit every window of 15 words with three or fewer substitutions, and SHORT names masks
that hit shorter items with all the substitutions four fifths allow (a test tries all of them).  A
mask is hashed only if some item uses it.  Items of fewer than five words are not searched for.  Words
are runs of letters and digits in lower case, so case, punctuation and white space don't matter.

All of it is DataFrame functions.  Benchmark seeds are cut into blocks of at most
``spark.cellarium.broadcastRows`` rows by their hash, and every block meets the hashes of all documents
where these lie.  Hits are reduced to distinct places before anything is sent, and only documents
with hits are met again, by id and text hash, to be verified.

Null text is empty.  Items with equal words are one item, named by the smallest id (null last), so
copies in the benchmark don't multiply hits.  Documents are named by id: ``overlaps`` reports rows
that share an id as one document, as it does those with a null id.  ``clean`` tells rows apart by id and
text, so a clean row stays whatever the others with its id hold.  Empty tables give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellarium.plans.scratch import settle
from cellarium.plans.skew import BROADCAST_ROWS_DEFAULT, BROADCAST_ROWS_SETTING, attach

MASKS = ["111011", "101111", "11111", "11100101", "1111", "11101", "11011", "10111"]
LONG = [0, 1]
# Masks of the items of so many words, where those of longer ones would miss some substitutions.
SHORT = {5: [4, 5, 6, 7], 6: [4, 6], 7: [0, 1, 2], 10: [0, 1, 3], 11: [0, 1, 2], 12: [0, 1, 2]}
WINDOW = 15
SHARE = 0.8


def tokens(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", " ")
    bare = F.btrim(plain)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def _offsets(mask: str) -> list[int]:
    return [k for k, c in enumerate(mask) if c == "1"]


def _spans(df: DataFrame, masks: list[int]) -> DataFrame:
    """A row per span and mask: the other columns of ``df``, ``seed`` and its place ``at``.

    ``words`` are hashed once each and left behind: what is exploded are numbers only.
    """
    rest = [c for c in df.columns if c != "words"]
    numbered = df.select(*rest, F.transform("words", lambda w: F.xxhash64(w)).alias("_hashes"))
    n = F.size("_hashes")

    def spans(mask: int) -> Column:
        offsets = _offsets(MASKS[mask])
        each = F.transform(
            F.sequence(F.lit(0), n - len(MASKS[mask])),
            lambda i: F.struct(
                F.xxhash64(F.lit(mask), *[F.get(F.col("_hashes"), i + k) for k in offsets]).alias("seed"),
                i.alias("at"),
            ),
        )
        empty = F.array().cast("array<struct<seed:bigint,at:int>>")
        return F.when(n >= len(MASKS[mask]), each).otherwise(empty)

    seeded = numbered.select(*rest, F.concat(*[spans(mask) for mask in masks]).alias("_seeds"))
    # The outer form keeps the optimizer from testing the arrays' size in a copy of all steps above.
    return seeded.select(*rest, F.inline_outer("_seeds"))


def _items(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id"), tokens(F.col("text")).alias("words"))
    return items.groupBy("words").agg(F.min("item_id").alias("item_id"))


def _best(same: Column, need: Column) -> Column:
    """The most agreeing words in any ``need`` words in a row; 0 where there are not enough at all."""
    zero = F.lit(0)
    total = F.aggregate(same, zero, lambda a, x: a + x)
    starts = F.sequence(zero, F.size(same) - need)
    windows = F.transform(
        starts, lambda s: F.aggregate(F.slice(same, s + 1, need), zero, lambda a, x: a + x)
    )
    enough = (F.size(same) >= need) & (total >= F.ceil(SHARE * need))
    return F.when(enough, F.array_max(windows)).otherwise(0)


def _own() -> list[Column]:
    """What tells a document's row apart: hashes of its id and of its text."""
    return [F.xxhash64("doc_id").alias("_key"), F.xxhash64("text").alias("_text")]


def _found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(_key, _text, _id, item_id, need, matched) of each row, item and place that overlap."""
    spark = docs.sparkSession
    items = settle(_items(benchmark).withColumn("item", F.xxhash64("words")), "items")
    n = F.size("words")
    using = {
        mask: n.isin([size for size, own in SHORT.items() if mask in own])
        | (F.lit(mask in LONG) & (n >= 5) & ~n.isin(list(SHORT)))
        for mask in range(len(MASKS))
    }
    seeds = [_spans(items.where(using[mask]).select("item", "words"), [mask]) for mask in using]
    seeds = reduce(DataFrame.unionByName, [x.withColumn("mask", F.lit(k)) for k, x in enumerate(seeds)])
    seeds = settle(seeds.where(F.col("seed").isNotNull()).withColumnRenamed("at", "item_at"), "seeds")
    rows = seeds.count()
    masks = sorted(r["mask"] for r in seeds.select("mask").distinct().collect()) or [0]
    limit = int(spark.conf.get(BROADCAST_ROWS_SETTING, str(BROADCAST_ROWS_DEFAULT)))
    blocks = max(1, -(-rows // max(1, limit)))
    own = docs.select(
        *_own(), F.col("doc_id").alias("_id"), tokens(F.col("text")).alias("words"),
    )
    spans = _spans(own.drop("_id"), masks)
    parts = [
        spans.join(F.broadcast(seeds.where(F.pmod("seed", F.lit(blocks)) == block)), "seed")
        for block in range(blocks)
    ]
    place = (F.col("at") - F.col("item_at")).alias("place")
    hits = reduce(DataFrame.unionByName, [x.select("_key", "_text", "item", place) for x in parts])
    asked = hits.distinct().groupBy("_key", "_text").agg(
        F.collect_list(F.struct("item", "place")).alias("asked")
    )
    met = attach(own, settle(asked, "asked"), ["_key", "_text"], "inner")
    met = met.select("_key", "_text", "_id", "words", F.inline_outer("asked"))
    listed = items.select("item", "item_id", F.col("words").alias("theirs"))
    laid = attach(met, listed, ["item"], "inner")
    cut = F.greatest(-F.col("place"), F.lit(0))
    width = F.size("theirs") - cut
    laid = laid.select(
        "_key",
        "_text",
        "_id",
        "item_id",
        F.least(F.size("theirs"), F.lit(WINDOW)).alias("need"),
        F.slice("words", F.col("place") + cut + 1, width).alias("ours"),
        F.slice("theirs", cut + 1, width).alias("theirs"),
    )
    same = F.transform(
        F.arrays_zip("ours", "theirs"),
        lambda p: F.when(F.coalesce(p["ours"] == p["theirs"], F.lit(False)), 1).otherwise(0),
    )
    laid = laid.select("_key", "_text", "_id", "item_id", "need", same.alias("same"))
    matched = _best(F.col("same"), F.col("need")).alias("matched")
    found = laid.select("_key", "_text", "_id", "item_id", "need", matched)
    return found.where(F.col("matched") >= F.ceil(SHARE * F.col("need")))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, window, similarity) for each document and item that overlap."""
    best = _found(docs, benchmark).groupBy("_id", "item_id").agg(
        F.max(F.struct(F.col("matched") / F.col("need"), "matched", "need")).alias("b")
    )
    return best.select(
        F.col("_id").alias("doc_id"),
        "item_id",
        F.col("b.matched").cast("bigint").alias("matched"),
        F.col("b.need").cast("bigint").alias("window"),
        (F.col("b.matched") / F.col("b.need")).alias("similarity"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that overlap no item, as they came."""
    found = settle(_found(docs, benchmark).select("_key", "_text").distinct(), "found")
    return attach(docs.select("*", *_own()), found, ["_key", "_text"], "left_anti").drop("_key", "_text")
