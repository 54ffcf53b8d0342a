"""Mixing sources to target weights, by apportionment of equal-token blocks.

Documents of a source are dealt to shards by a seeded hash, and laid end to end in each shard
in seeded order.  The words of a shard fall into blocks of ``block`` words (the last may be
shorter), or of a sixteenth of the smallest source's target if that is less, so that small sources get
their blocks too.  Every source's target is a number of blocks; Sainte-Lague quotients (votes over odd
numbers) give each shard a whole number of them, highest quotients first.  A shard takes as
many full rounds of its blocks as fit in its quota, and the rest of it as blocks in a row from a
seeded one, going round at the end.  Documents lie in seeded order already, so blocks in a row are
a fair choice, and at most three documents of a shard are cut.

The quotas of highest quotients are the votes divided by one common divisor and rounded, so the
divisor is found by bisection over the shard table, and ties at the last seat go by shard.

Null text has size 0; null source is a source of its own, last in order.  Repeated rows are
rows of their own, laid in the order they are stored in.  Documents without words take nothing.  An empty table gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellarium.llm.common import SPACE_RUN, words
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (3, 1, 2)  # by source in code point order, repeating
    total: float = 1.5  # words wanted, as a share of all words
    most: int = 2  # times that a source may be repeated
    block: int = 64
    shard_rows: int = 4096
    seed: int = 20


def sources(sized: DataFrame, mix: Mix) -> list[dict]:
    """Each source with size, rows and target.  Only this list of names comes to the driver."""
    found = sized.groupBy("_source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    rows = [r.asDict() for r in found.collect()]
    # Python compares strings by code point, as asked.
    rows.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    for k, r in enumerate(rows):
        r["weight"] = mix.weights[k % len(mix.weights)]
        r["cap"] = float(mix.most * r["size"])
    left, open_rows = mix.total * sum(r["size"] for r in rows), rows
    while open_rows:
        weight = sum(r["weight"] for r in open_rows)
        for r in open_rows:
            r["target"] = left * r["weight"] / weight
        full = [r for r in open_rows if r["target"] > r["cap"]]
        if not full:
            break
        for r in full:
            r["target"] = r["cap"]
            left -= r["cap"]
        open_rows = [r for r in open_rows if r["target"] < r["cap"]]
    return rows


def quotas(shards: DataFrame, mix: Mix) -> DataFrame:
    """Adds ``quota``: blocks for each shard, by highest quotients of ``votes``.

    Shards with a ``cap`` get no more; the seats go to the next quotients.
    """
    votes = shards.agg(F.sum("votes")).first()[0] or 0.0
    seats = round(votes / mix.block)
    if seats <= 0:
        return shards.withColumn("quota", F.lit(0).cast("bigint"))

    def given(divisor: float) -> Column:
        quota = F.floor(F.col("votes") / divisor + 0.5).cast("bigint")
        return F.least(quota, "cap") if "cap" in shards.columns else quota

    # Seats fall as the divisor grows; every pass over the table narrows it 32 times.
    low, high = mix.block / 1e6, 4.0 * votes
    while high > low * (1 + 1e-14):
        tried = [low * (high / low) ** (k / 32) for k in range(1, 32)]
        counts = shards.agg(*[F.sum(given(d)).alias(f"d{k}") for k, d in enumerate(tried)]).first()
        if seats in counts:
            return shards.withColumn("quota", given(tried[counts.index(seats)]))
        below = sum(n > seats for n in counts)
        ends = [low, *tried, high]
        low, high = ends[below], ends[below + 1]
    # Tied quotients: the last seats go to the first of the shards that tie.
    tied = shards.where(given(low) > given(high)).select("_key", "shard")
    spare = seats - (shards.agg(F.sum(given(high))).first()[0] or 0)
    extra = tied.orderBy("_key", "shard").limit(spare).withColumn("_extra", F.lit(1))
    out = attach(shards, extra, ["_key", "shard"])
    return out.withColumn("quota", given(high) + F.coalesce("_extra", F.lit(0))).drop("_extra")


def take(docs: DataFrame, mix: Mix = Mix(), carry: list[str] | None = None) -> DataFrame:  # noqa: B008
    """``_doc``, size, source_size, target, taken, shard, and ``runs``: the words taken, as
    (round, first word, words) in the document's own word numbers.

    ``_doc`` holds the columns to ``carry`` along (all by default)."""
    spark = docs.sparkSession
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("_doc"),
        F.col("source").alias("_source"),
        F.size(words(F.col("text"))).cast("bigint").alias("size"),
        F.xxhash64(F.lit(mix.seed), F.col("doc_id").cast("string"), F.xxhash64("text")).alias("_at"),
        F.col("doc_id").alias("_id"),
    )
    key = F.coalesce(F.concat(F.lit("="), "_source"), F.lit(""))
    # Written once: a row keeps its place however often it is read.
    sized = settle(sized.withColumns({"_key": key, "_place": F.monotonically_increasing_id()}), "sized")
    found = sources(sized, mix)
    least = min((r["target"] for r in found if r["target"] > 0), default=0)
    mix = replace(mix, block=max(1, min(mix.block, int(least // 16))))
    listed = [
        (r["_source"], r["size"], float(r["target"]), -(-r["rows"] // mix.shard_rows)) for r in found
    ]
    schema = "_source string, source_size bigint, target double, shards bigint"
    targets = spark.createDataFrame(listed, schema).withColumn("_key", key).drop("_source")
    dealt = attach(sized, targets, ["_key"], "inner")
    # The upper bits deal, the whole hash orders; the two are independent enough by mixing.
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("_at", F.lit(1)), F.col("shards")))
    totals = dealt.groupBy("_key", "shard").agg(
        F.first("_source").alias("_source"),
        F.sum("size").alias("shard_size"),
        F.first("target").alias("target"),
        F.first("source_size").alias("source_size"),
    )
    votes = F.when(F.col("shard_size") > 0, F.col("target") * F.col("shard_size") / F.col("source_size"))
    totals = totals.withColumn("votes", F.coalesce(votes, F.lit(0.0)))
    totals = totals.withColumn("blocks", F.ceil(F.col("shard_size") / mix.block))
    plan = quotas(settle(totals.withColumn("cap", mix.most * F.col("blocks")), "shards"), mix)
    seeded = F.pmod(F.xxhash64(F.lit(mix.seed), "_key", "shard"), F.greatest("blocks", F.lit(1)))
    rounds = F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(0)
    plan = plan.select(
        "_key", "shard", "shard_size", "blocks", rounds.cast("int").alias("rounds"),
        (F.col("quota") - rounds * F.col("blocks")).alias("extra"), seeded.alias("offset"),
    )
    inside = Window.partitionBy("_key", "shard").orderBy("_at", "_id", "size", "_place")
    before = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = dealt.withColumn("_from", F.coalesce(before, F.lit(0).cast("bigint")))
    return _taken(attach(placed, settle(plan, "plan"), ["_key", "shard"], "inner"), mix)


def _taken(placed: DataFrame, mix: Mix) -> DataFrame:
    start, end = F.col("_from"), F.col("_from") + F.col("size")
    low = F.col("offset") * mix.block
    high = (F.col("offset") + F.col("extra")) * mix.block
    over = (F.col("offset") + F.col("extra") - F.col("blocks")) * mix.block

    def run(a, b):
        a, b = F.greatest(a, start), F.least(b, end)
        return F.struct(
            F.col("rounds").alias("round"),
            (a - start).cast("int").alias("first"),
            F.greatest(b - a, F.lit(0)).cast("int").alias("words"),
        )

    zero = F.lit(0).cast("bigint")
    whole = F.transform(
        F.when(F.col("rounds") > 0, F.sequence(F.lit(0), F.col("rounds") - 1)).otherwise(
            F.array().cast("array<int>")
        ),
        lambda r: F.struct(
            r.alias("round"), F.lit(0).alias("first"), F.col("size").cast("int").alias("words")
        ),
    )
    both = F.concat(whole, F.array(run(zero, F.greatest(over, zero)), run(low, high)))
    placed = placed.withColumn("runs", F.filter(both, lambda r: r["words"] > 0))
    taken = F.aggregate("runs", zero, lambda a, r: a + r["words"])
    return placed.select("_doc", "size", "source_size", "target", taken.alias("taken"), "shard", "runs")


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:  # noqa: B008
    """The mix as documents: a row per document and round, with the words taken in that round.

    A document taken whole keeps its text; one that is taken in part keeps the words taken,
    with one space between them.  ``n_chars`` follows the text.
    """
    rows = take(docs, mix).where(F.size("runs") > 0)
    rows = rows.withColumn("_round", F.explode(F.array_distinct(F.transform("runs", lambda r: r["round"]))))
    rows = rows.withColumn("_own", F.filter("runs", lambda r: r["round"] == F.col("_round")))
    count = F.aggregate("_own", F.lit(0).cast("bigint"), lambda a, r: a + r["words"])
    bare = F.split(F.btrim(F.col("_doc.text"), F.lit(" \t\n\x0b\x0c\r")), SPACE_RUN)
    parts = F.flatten(
        F.transform("_own", lambda r: F.slice(bare, r["first"] + 1, r["words"]))
    )
    text = F.when(count == F.col("size"), F.col("_doc.text")).otherwise(F.array_join(parts, " "))
    rows = rows.withColumn("_text", text)
    new = {"text": F.col("_text"), "n_chars": F.length("_text").cast("bigint")}
    return rows.select(*[new.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])
