"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Five statistics of a text (length, word length, symbols, repeated lines, repeated windows) are
put on a log scale in whole thousandths.  For each (language, source) the centre and scatter are
the minimum-covariance-determinant estimates: from medians and median deviations, repeat
concentration steps, each taking mean and covariance of the SHARE of rows that lie nearest by
the last estimate.  A document whose squared Mahalanobis distance is above CUTOFF goes.

A step needs no sorting and no row leaves its place: every task sums counts, values and products
by (group, distance bin), and the nearest rows are a prefix of the bins.  A group of any size ships
a few hundred sums per task.  Values are whole numbers, so the sums don't depend on their order.

Null text counts as empty and fails the fixed limits; null language or source is a value of
its own.  Sources with fewer than LEAST_ROWS passing rows are estimated together with others of
their language, and if these are too few with those of all languages; where all are too few only
the fixed limits count.  Repeated rows count as often as they occur and get the same verdict.
An empty table gives an empty one.  Windows are compared by 64-bit hashes inside one text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellarium.llm.common import words
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
DIMS = range(5)
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words

MEDIAN_CHI2 = 4.351  # of a chi-square variable with five degrees of freedom
BINS = 20  # of squared distance, per factor e


@dataclass(frozen=True)
class Limits:
    share: float = 0.75  # of rows that an estimate rests on
    steps: int = 4
    cutoff: float = 70.0  # squared distance; real statistics have longer tails than a chi-square
    least_rows: int = 40
    floor: int = 250  # least standard deviation of a statistic, in thousandths


def statistics(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``_doc`` (the columns to carry, all by default), the counts, n_lines and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("_doc"),
        words(F.col("text")).alias("_words"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"),
    )
    n = F.size("_words")
    base = base.select(
        "_doc",
        "n_symbols",
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _window_hashes("_words").alias("_hashes"),
    )
    placed = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    again = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    base = base.withColumn("_sorted", F.when(again, F.sort_array(placed)).otherwise(empty))
    base = base.drop("_hashes")

    def repeated(x: Column, k: Column) -> Column:
        near = [F.get(F.col("_sorted"), k - 1), F.get(F.col("_sorted"), k + 1)]
        return reduce(lambda a, b: a | b, [F.coalesce(y["h"] == x["h"], F.lit(False)) for y in near])

    starts = F.array_sort(F.transform(F.filter("_sorted", repeated), lambda x: x["i"]))
    base = base.withColumn("_starts", starts).drop("_sorted")
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
        lambda a, i: F.struct(
            i.alias("last"),
            (a["n"] + F.least(F.lit(3), i - a["last"])).cast("bigint").alias("n"),
        ),
        lambda a: a["n"],
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    stats = base.withColumn("n_repeat_words", covered).withColumn("base_failed", failed)
    return stats.select("_doc", *STATS, "n_lines", "base_failed")


def _window_hashes(name: str) -> Column:
    """A hash for each three words that follow one another."""
    n = F.size(name)
    windows = F.arrays_zip(*[F.slice(name, 1 + k, n - 2) for k in range(3)])
    hashes = F.transform(windows, lambda w: F.xxhash64(w["0"], w["1"], w["2"]))
    return F.when(n >= 3, hashes).otherwise(F.array().cast("array<bigint>"))


def _vector() -> list[Column]:
    """The statistics on a log scale, in whole thousandths, as columns z0 to z4."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    # Shares are taken in parts that good texts have a few of: symbols in a hundredth, repeats,
    # such as a line of boilerplate that comes back, in a tenth.
    raw = [
        F.col("n_words"),
        F.col("word_chars") / n,
        100 * F.col("n_symbols") / n,
        10 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        10 * F.col("n_repeat_words") / n,
    ]
    return [F.round(1000 * F.log1p(x)).cast("bigint").alias(f"z{k}") for k, x in enumerate(raw)]


def _groups(rows: DataFrame, least: int) -> DataFrame:
    """The group (``_group``, null if none) of each language and source (``_own``)."""
    sizes = rows.groupBy("_lang", "_own").agg(F.count(F.lit(1)).alias("n"))
    alone = F.col("n") >= least
    few = F.sum(F.when(~alone, F.col("n")).otherwise(0))
    langs = sizes.groupBy("_lang").agg(few.alias("lang_n"))
    rest = F.col("lang_n") < least
    total = langs.agg(F.sum(F.when(rest, F.col("lang_n")).otherwise(0))).scalar()
    return attach(sizes, langs, ["_lang"]).select(
        "_own",
        F.when(alone, F.concat(F.lit("own "), "_own"))
        .when(~rest, F.concat(F.lit("language "), "_lang"))
        .when(total >= least, F.lit("all"))
        .alias("_group"),
    )


def _start(rows: DataFrame, limits: Limits) -> DataFrame:
    """Per group: medians as centre, median deviations on the diagonal of the root."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"z{k}").alias("v")) for k in DIMS]))
    counts = rows.select("_group", pairs.alias("p")).groupBy("_group", "p.k", "p.v")
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    found = _median(counts, "v", "centre")
    off = counts.join(found, ["_group", "k"]).withColumn("off", F.abs(F.col("v") - F.col("centre")))
    off = off.groupBy("_group", "k", "off").agg(F.sum("n").alias("n"))
    both = found.join(_median(off, "off", "spread"), ["_group", "k"])
    width = F.greatest(1.4826 * F.col("spread"), F.lit(float(limits.floor)))
    at = lambda k, c: F.max(F.when(F.col("k") == k, c))
    return both.groupBy("_group").agg(
        *[at(k, F.col("centre").cast("double")).alias(f"m{k}") for k in DIMS],
        *[
            (at(k, 1 / width) if j == k else F.lit(0.0)).alias(f"w{k}{j}")
            for k in DIMS
            for j in range(k + 1)
        ],
    )


def _median(counts: DataFrame, value: str, name: str) -> DataFrame:
    keys = ["_group", "k"]
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy(value)
    return (
        counts.withColumn("_upto", F.sum("n").over(upto))
        .withColumn("_all", F.sum("n").over(whole))
        .where(2 * F.col("_upto") >= F.col("_all"))
        .groupBy(*keys)
        .agg(F.min(value).alias(name))
    )


def distance() -> Column:
    """Squared distance from centre ``m`` by the inverse root ``w`` of the scatter."""
    parts = [
        F.pow(
            reduce(
                lambda a, b: a + b,
                [F.col(f"w{k}{j}") * (F.col(f"z{j}") - F.col(f"m{j}")) for j in range(k + 1)],
            ),
            2,
        )
        for k in DIMS
    ]
    return reduce(lambda a, b: a + b, parts)


def _step(rows: DataFrame, estimate: DataFrame, limits: Limits) -> DataFrame:
    """Mean and scatter of the nearest rows, and the median distance by the given estimate."""
    placed = attach(rows, estimate, ["_group"])
    placed = placed.withColumn("_bin", F.floor(BINS * F.log1p(distance())).cast("int"))
    sums = placed.groupBy("_group", "_bin").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"z{k}").alias(f"s{k}") for k in DIMS],
        *[F.sum(F.col(f"z{k}") * F.col(f"z{j}")).alias(f"p{k}{j}") for k in DIMS for j in range(k + 1)],
    )
    whole = Window.partitionBy("_group")
    upto = whole.orderBy("_bin")
    names = [c for c in sums.columns if c not in ("_group", "_bin")]
    run = sums.select(
        "_group", "_bin",
        F.sum("n").over(whole).alias("_all"),
        *[F.sum(c).over(upto).alias(c) for c in names],
    )
    near = run.where(F.col("n") >= limits.share * F.col("_all")).groupBy("_group").agg(
        *[F.min_by(c, "_bin").alias(c) for c in names]
    )
    middle = run.where(2 * F.col("n") >= F.col("_all")).groupBy("_group").agg(
        F.min("_bin").alias("_middle")
    )
    mean = [F.col(f"s{k}") / F.col("n") for k in DIMS]
    near = near.select(
        "_group",
        *[mean[k].alias(f"m{k}") for k in DIMS],
        *[
            (
                F.col(f"p{k}{j}") / F.col("n")
                - mean[k] * mean[j]
                + F.lit(float(limits.floor**2) if j == k else 0.0)
            ).alias(f"c{k}{j}")
            for k in DIMS
            for j in range(k + 1)
        ],
    )
    return _inverse_root(near).join(middle, "_group")


def _inverse_root(scatter: DataFrame) -> DataFrame:
    """The inverse of the Cholesky factor of c, as columns w; a row per group."""
    total = lambda terms: reduce(lambda a, b: a + b, terms, F.lit(0.0))
    out = scatter
    for k in DIMS:
        for j in range(k + 1):
            known = F.col(f"c{k}{j}") - total([F.col(f"l{k}{i}") * F.col(f"l{j}{i}") for i in range(j)])
            out = out.withColumn(f"l{k}{j}", F.sqrt(known) if j == k else known / F.col(f"l{j}{j}"))
    for j in DIMS:
        out = out.withColumn(f"w{j}{j}", 1 / F.col(f"l{j}{j}"))
        for k in range(j + 1, len(DIMS)):
            terms = [F.col(f"l{k}{i}") * F.col(f"w{i}{j}") for i in range(j, k)]
            out = out.withColumn(f"w{k}{j}", -total(terms) / F.col(f"l{k}{k}"))
    return out.select(
        "_group", *[f"m{k}" for k in DIMS], *[f"w{k}{j}" for k in DIMS for j in range(k + 1)]
    )


def judge(
    docs: DataFrame,
    limits: Limits = Limits(),  # noqa: B008
    carry: list[str] | None = None,
) -> DataFrame:
    """``_doc``, the counts, base_failed, distance (null where none is due) and kept.

    ``_doc`` has the columns to ``carry`` along (all by default), lang and source among them."""
    own = F.to_json(F.struct(F.col("_doc.lang").alias("l"), F.col("_doc.source").alias("s")))
    lang = F.to_json(F.struct(F.col("_doc.lang").alias("l")))
    # The counts are needed in every step; the text is read once.
    stats = settle(statistics(docs, carry).select("*", *_vector(), own.alias("_own"), lang.alias("_lang")))
    passing = stats.where(~F.col("base_failed")).select("_own", "_lang", *[f"z{k}" for k in DIMS])
    groups = settle(_groups(passing, limits.least_rows).where(F.col("_group").isNotNull()))
    rows = settle(attach(passing, groups, ["_own"], "inner").drop("_own", "_lang"))
    estimate = settle(_start(rows, limits))
    for _ in range(limits.steps):
        estimate = settle(_step(rows, estimate.drop("_middle"), limits))
    # Scatter of the nearest rows is too small; the median distance says by how much.
    last = _step(rows, estimate.drop("_middle"), limits).select(
        "_group",
        F.greatest(F.expm1((F.col("_middle") + 0.5) / BINS) / MEDIAN_CHI2, F.lit(1.0)).alias("_scale"),
    )
    estimate = settle(estimate.drop("_middle").join(last, "_group"))
    known = attach(groups, estimate, ["_group"], "inner")
    placed = attach(stats, known, ["_own"])
    far = F.when(~F.col("base_failed"), distance() / F.col("_scale"))
    placed = placed.withColumn("distance", far)
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= limits.cutoff)
    return placed.select("_doc", *STATS, "base_failed", "distance", kept.alias("kept"))


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:  # noqa: B008
    """The documents that are kept, as they came."""
    return judge(docs, limits).where("kept").select("_doc.*")
