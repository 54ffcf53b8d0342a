"""Near copies among embeddings by iterative quantisation and multi-index Hamming tables.

**Codes.**  On a sample of ``SAMPLE`` vectors (by hash of the vector) principal directions are found, and a
rotation of them that brings projections close to the corners of a cube (iterative quantisation: signs
and the best rotation to them, by turns).  The signs of the rotated projections are a code of up to
64 bits.  Every vector is coded; only the fit uses the sample.

**Tables.**  A code is cut into substrings, as wide as the logarithm of the number of vectors, and each
is the key of a table.  Vectors stand under their own substring and under those one bit away, so two
meet when some substring differs in two bits or fewer.  Sample vectors, each turned by exactly the
limiting angle in a random direction, tell how many pairs at the limit meet; further rotations are
learned, each with tables of its own, until ``RECALL`` of them do.  Met pairs go on if their whole codes
differ no more than 99.9% of such turned pairs do.

**Dense groups.**  Before that, crowded keys choose a leader, and vectors within half the limiting angle
of it form its ball.  Any two of a ball are linked, by the triangle inequality, so a ball of thousands is
one entry of the tables, with its radius.  Two balls may be linked or unlinked as a whole by their
leaders' angle and radii; only those in between are opened, in chunks of ``CHUNK`` vectors.  Rounds stop
when no ball is found; they save work and never decide a link.

**Reranking.**  Every link is decided by the original vectors in double precision.  Equal vectors (by
two 64-bit hashes) are one from the start, and counted.  Keys with over ``BLOCK`` balls are compared
block by block in tasks of their own, so none of them is left out.

Null vectors, zero vectors and those with null or non-finite components link with nothing; nor do
vectors of different lengths link.  A null id is ignored where the smallest is asked, unless all are.
Repeated rows, equal ids or not, are vectors of their own.  Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellarium.llm.common import batches
from cellarium.llm.graph import components
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach, ranked

COSINE = 0.9
BITS = 64
SAMPLE = 10_000
STEPS = 40
RECALL = 0.98
MOST_ROTATIONS = 16
CROWD = 64  # entries under one key from which balls are looked for
ROUNDS = 8
BLOCK = 4096
CHUNK = 512
SEED = 42
MARGIN = 1e-6  # radians, far above what doubles lose

SAME = ["h1", "h2"]


# ---- learning ---------------------------------------------------------------


def units(vectors: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very large or small components would leave the range of doubles.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def learn_rotation(sample: np.ndarray, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (one column a bit) of unit vectors."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    _, axes = np.linalg.eigh((sample - mean).T @ (sample - mean))
    axes = axes[:, ::-1][:, :bits]
    low = (sample - mean) @ axes
    turn, _ = np.linalg.qr(rng.standard_normal((bits, bits)))
    for _ in range(STEPS):
        corners = np.where(low @ turn > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(low.T @ corners)
        turn = left @ right
    return mean, axes @ turn


def turned(vectors: np.ndarray, angle: float, rng) -> np.ndarray:
    """Unit vectors turned by an angle, each in a random direction."""
    if vectors.shape[1] < 2:
        return vectors
    other = rng.standard_normal(vectors.shape)
    other -= (other * vectors).sum(axis=1, keepdims=True) * vectors
    return math.cos(angle) * vectors + math.sin(angle) * units(other)


class Index:
    """Rotations learned, the width of their tables, and how far codes of a given angle differ."""

    def __init__(self, sample: np.ndarray, n: int, cosine: float):
        rng = np.random.default_rng(SEED)
        self.width = sample.shape[1]
        self.bits = min(BITS, self.width)
        self.sub = min(self.bits, max(8, math.ceil(math.log2(max(n, 2)))))
        self.tables = self.bits // self.sub
        self.limit = math.acos(cosine)
        near = turned(sample, self.limit, rng)
        self.rotations: list[tuple[np.ndarray, np.ndarray]] = []
        met = np.zeros(len(sample), bool)
        while len(self.rotations) < MOST_ROTATIONS and (not self.rotations or met.mean() < RECALL):
            self.rotations.append(learn_rotation(sample, self.bits, SEED + len(self.rotations)))
            a, b = (self.code(x, len(self.rotations) - 1) for x in (sample, near))
            for table in range(self.tables):
                met |= np.bitwise_count(self._cut(a ^ b, table)) <= 2
        self.recall = float(met.mean())
        first = self.code(sample, 0)
        # By whole degrees above the limit, for balls of some radius.
        self.apart = np.maximum.accumulate([
            int(np.quantile(np.bitwise_count(first ^ self.code(turned(sample, self.limit + math.radians(k), rng), 0)), 0.999))
            for k in range(2 + math.ceil(math.degrees(self.limit)))
        ])

    def code(self, vectors: np.ndarray, rotation: int) -> np.ndarray:
        mean, project = self.rotations[rotation]
        bits = (vectors - mean) @ project > 0
        return bits.astype(np.uint64) @ (np.uint64(1) << np.arange(self.bits, dtype=np.uint64))

    def _cut(self, codes: np.ndarray, table: int) -> np.ndarray:
        return (codes >> np.uint64(table * self.sub)) & np.uint64((1 << self.sub) - 1)

    def keys(self, near: bool) -> Column:
        """Keys of a vector with ``codes`` and ``dim``; with those one bit away if ``near``."""
        found = []
        for rotation in range(len(self.rotations)):
            for table in range(self.tables):
                own = F.shiftrightunsigned(F.col("codes")[rotation], table * self.sub)
                own = own.bitwiseAND((1 << self.sub) - 1)
                flips = [0, *[1 << bit for bit in range(self.sub)]] if near else [0]
                found.append(_hashed(own, rotation * self.tables + table, flips))
        return F.concat(*found)


def _hashed(own: Column, table: int, flips: list[int]) -> Column:
    return F.transform(
        F.lit(flips).cast("array<bigint>"), lambda flip: F.xxhash64("dim", F.lit(table), own.bitwiseXOR(flip))
    )


def fit(vectors: DataFrame, n: int, cosine: float = COSINE, sample: int = SAMPLE) -> Index:
    """The index of distinct ``vectors`` (h1, vector), from the ``sample`` with the smallest hashes."""
    share = min(1.0, 1.5 * sample / n + 50 / n)
    few = vectors.where(F.col("h1") <= min(2**63 - 1, int(2**64 * share) - 2**63)).orderBy(*SAME).limit(sample)
    lists = few.select("vector").toArrow().column(0).to_pylist()
    width = max(vectors.agg(F.max(F.size("vector"))).first()[0], 1)
    if not lists:  # none fell below the bound: possible for a handful of vectors only
        lists = vectors.orderBy(*SAME).limit(sample).select("vector").toArrow().column(0).to_pylist()
    return Index(units(np.array([x + [0.0] * (width - len(x)) for x in lists], np.float64)), n, cosine)


# ---- vectors ----------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, filled up with zeros."""
    lengths = np.asarray(column.value_lengths())
    values = np.zeros((len(column), width))
    values[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return values


def coded(vectors: DataFrame, index: Index) -> DataFrame:
    """Adds ``codes`` to vectors (place, dim, vector) and drops the vector."""

    def code(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 4096):
            values = units(_matrix(batch.column(2), index.width))
            codes = np.stack([index.code(values, k) for k in range(len(index.rotations))], axis=1)
            flat = pa.array(codes.view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1], flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], lists], names=["place", "dim", "codes"])

    return vectors.select("place", "dim", "vector").mapInArrow(code, "place bigint, dim int, codes array<bigint>")


def with_cosine(pairs: DataFrame, width: int) -> DataFrame:
    """Adds ``cosine`` to rows that end in two vectors, which go."""
    kept = pairs.columns[:-2]

    def measure(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 4096):
            a, b = (units(_matrix(batch.column(k), width)) for k in (len(kept), len(kept) + 1))
            cosine = pa.array(np.einsum("ij,ij->i", a, b))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], cosine], names=[*kept, "cosine"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields[:-2]]
    return pairs.mapInArrow(measure, ", ".join([*kinds, "cosine double"]))


# ---- dense groups -----------------------------------------------------------


def balls(codes: DataFrame, vectors: DataFrame, index: Index) -> DataFrame:
    """place, ball (its leader's place) and angle to the leader, of vectors that a leader has taken."""
    half = math.cos(index.limit / 2 - MARGIN)
    own = vectors.select("place", F.col("vector").alias("_own"))
    theirs = vectors.select(F.col("place").alias("ball"), F.col("vector").alias("_theirs"))
    pool = settle(codes.select("place", index.keys(near=False).alias("keys")), "pool")
    found: list[DataFrame] = []
    for turn in range(ROUNDS):
        keyed = pool.select("place", F.explode("keys").alias("key"))
        lead = F.min(F.struct(F.xxhash64("place", F.lit(turn)), "place"))["place"].alias("ball")
        crowded = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), lead)
        crowded = settle(crowded.where(F.col("n") >= CROWD).select("key", "ball"), "crowded")
        if crowded.isEmpty():
            break
        tried = attach(keyed, crowded, ["key"], "inner").where(F.col("place") != F.col("ball"))
        tried = attach(tried.select("place", "ball").distinct(), theirs, ["ball"], "inner").join(own, "place")
        near = with_cosine(tried.select("place", "ball", "_own", "_theirs"), index.width)
        near = settle(near.where(F.col("cosine") >= half), "near")
        # A leader that another one could take leads nobody this time.
        taken = near.select(F.col("place").alias("ball")).distinct()
        near = near.join(near.select("ball").distinct().join(taken, "ball", "left_anti"), "ball")
        chosen = near.groupBy("place").agg(F.max_by("ball", F.struct("cosine", "ball")).alias("ball"), F.max("cosine").alias("_c"))
        angle = F.acos(F.least(F.col("_c"), F.lit(1.0)))
        chosen = chosen.select("place", "ball", angle.alias("angle"))
        leaders = chosen.select(F.col("ball").alias("place"), "ball").distinct().withColumn("angle", F.lit(0.0))
        chosen = settle(chosen.unionByName(leaders), "chosen")
        if chosen.isEmpty():
            break
        found.append(chosen)
        pool = settle(pool.join(chosen.select("place"), "place", "left_anti"), "pool")
    empty = codes.sparkSession.createDataFrame([], "place bigint, ball bigint, angle double")
    return reduce(DataFrame.unionByName, found, empty)


# ---- candidates -------------------------------------------------------------


def _meet(apart: np.ndarray):
    """Pairs of balls under one key; rows (key, block, other, side, ball, code, reach) come by key and blocks."""

    def pairs(key: np.ndarray, side: np.ndarray, ball: np.ndarray, code: np.ndarray, reach: np.ndarray):
        at, step, found = np.arange(len(ball)), 1, []
        while True:
            at = at[at + step < len(ball)]
            at = at[key[at] == key[at + step]]
            if not len(at):
                break
            to = at + step
            extra = np.ceil(np.degrees(reach[at] + reach[to])).astype(np.int64)
            close = np.bitwise_count(code[at] ^ code[to]) <= apart[np.minimum(extra, len(apart) - 1)]
            close &= side[at] != side[to]
            found.append((ball[at][close], ball[to][close]))
            step += 1
        a, b = (np.concatenate([np.zeros(0, np.int64), *[f[k] for f in found]]) for k in (0, 1))
        low = pa.array(np.minimum(a, b))
        return pa.RecordBatch.from_arrays([low, pa.array(np.maximum(a, b))], names=["a", "b"])

    def meet(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in rows:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            cut = int((held[0] == held[0][-1]).argmax())  # the last key may go on
            if cut:
                done, held = [x[:cut] for x in held], [x[cut:] for x in held]
                yield pairs(*done[:3], done[3].view(np.uint64), done[4])
        if held is not None and len(held[0]):
            yield pairs(*held[:3], held[3].view(np.uint64), held[4])

    return meet


def candidates(members: DataFrame, index: Index) -> DataFrame:
    """Pairs (a, b) of balls that meet in a table, from members (ball, dim, codes, code, reach)."""
    keyed = members.select("ball", "code", "reach", F.explode(index.keys(near=True)).alias("key"))
    # One entry for a ball under a key, however many of its members stand there.
    keyed = settle(keyed.groupBy("key", "ball").agg(F.first("code").alias("code"), F.first("reach").alias("reach")), "keyed")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    large = settle(sizes.select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")), "large")
    # Within a small key all are met; sides differ by ball.
    columns = ["key", "side", "ball", "code", "reach"]
    small, hot = keyed, None
    if not large.isEmpty():
        small = attach(keyed, large, ["key"], "left_anti")
        cut = attach(keyed, large, ["key"], "inner")
        block = F.pmod(F.xxhash64("ball"), F.col("blocks"))
        cut = cut.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        pair = F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other"))
        side = F.when(F.col("block") == F.col("other"), F.col("ball")).otherwise(-1 - F.col("block"))
        hot = cut.select(pair.alias("key"), side.alias("side"), "ball", "code", "reach")
    small = small.withColumn("side", F.col("ball")).select(*columns)
    every = small if hot is None else small.unionByName(hot)
    dealt = every.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_meet(index.apart), "a bigint, b bigint").distinct()


def _opened(open_pairs: DataFrame, members: DataFrame, vectors: DataFrame, cosine: float, width: int) -> DataFrame:
    """Of pairs of balls between linked and unlinked: (a, b, place, n), with the links of each member."""
    wanted = open_pairs.select(F.col("a").alias("ball")).unionByName(open_pairs.select(F.col("b").alias("ball")))
    own = attach(members.select("place", "ball", "size"), wanted.distinct(), ["ball"], "left_semi")
    placed = ranked(own, ["ball"], [F.col("place")]).join(vectors.select("place", "vector"), "place")
    chunks = settle(
        placed.groupBy("ball", F.floor((F.col("rank") - 1) / CHUNK).alias("chunk"))
        .agg(F.collect_list(F.struct("place", "size", "vector")).alias("rows")),
        "chunks",
    )
    left = chunks.select(F.col("ball").alias("a"), F.col("rows").alias("ours"))
    right = chunks.select(F.col("ball").alias("b"), F.col("rows").alias("theirs"))
    met = open_pairs.select("a", "b").join(left, "a").join(right, "b")

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1):
            a, b = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            sides = [batch.column(k).flatten() for k in (2, 3)]
            places, sizes, values = zip(*[
                (s.field(0).to_numpy(), s.field(1).to_numpy(), units(_matrix(s.field(2), width))) for s in sides
            ], strict=True)
            linked = values[0] @ values[1].T >= cosine
            n = np.concatenate([linked @ sizes[1], linked.T @ sizes[0]])
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), a)), pa.array(np.full(len(some), b)),
                 pa.array(np.concatenate(places)[some]), pa.array(n[some])], names=["a", "b", "place", "n"],
            )

    return met.select("a", "b", "ours", "theirs").mapInArrow(count, "a bigint, b bigint, place bigint, n bigint")


# ---- links ------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Vectors that can link at all."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def links(each: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """h1, h2, n_links (of one vector) and component (a number) of rows (h1, h2, vector), which may repeat."""
    vectors = each.groupBy(*SAME).agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("size"))
    vectors = vectors.select("*", F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("place"))
    vectors = settle(vectors, "vectors")  # a vector keeps its place however often it is read
    n = vectors.count()
    if not n:
        return vectors.select(*SAME, F.col("size").alias("n_links"), F.col("place").alias("component"))
    index = fit(vectors, n, cosine, sample)
    codes = settle(coded(vectors, index), "codes")
    taken = balls(codes, vectors, index)
    members = vectors.select("place", *SAME, "size", "dim").join(taken, "place", "left")
    members = members.withColumns(
        {"ball": F.coalesce("ball", "place"), "angle": F.coalesce("angle", F.lit(0.0))}
    ).join(codes.select("place", "codes"), "place")
    members = settle(members, "members")
    leads = members.where(F.col("ball") == F.col("place")).select("ball", F.col("codes")[0].alias("code"))
    grown = members.groupBy("ball").agg(F.max("angle").alias("reach"), F.sum("size").alias("weight"))
    leads = settle(leads.join(grown, "ball").join(vectors.select(F.col("place").alias("ball"), "vector"), "ball"), "balls")
    about = attach(members, leads.select("ball", "code", "reach"), ["ball"], "inner")
    pairs = settle(candidates(about, index), "pairs")

    def side(name: str) -> DataFrame:
        return leads.select(F.col("ball").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("reach", "weight", "vector")])

    met = attach(attach(pairs, side("a"), ["a"], "inner"), side("b"), ["b"], "inner")
    met = with_cosine(met.select("a", "b", "reach_a", "reach_b", "weight_a", "weight_b", "vector_a", "vector_b"), index.width)
    radius = F.col("reach_a") + F.col("reach_b")
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "cosine")))
    judged = met.withColumn(
        "linked",
        F.when(radius == 0, F.col("cosine") >= cosine)
        .when(angle + radius <= index.limit - MARGIN, True)
        .when(angle - radius > index.limit + MARGIN, False),
    )
    judged = settle(judged.where(F.col("linked").isNull() | F.col("linked")).drop("reach_a", "reach_b", "cosine"), "judged")
    whole = judged.where("linked")
    opened = settle(_opened(judged.where("linked IS NULL"), members, vectors, cosine, index.width), "opened")
    edges = whole.select("a", "b").unionByName(opened.select("a", "b"))
    roots = components(edges).withColumnRenamed("node", "ball")
    by_ball = (
        whole.select(F.col("a").alias("ball"), F.col("weight_b").alias("n"))
        .unionByName(whole.select(F.col("b").alias("ball"), F.col("weight_a").alias("n")))
        .groupBy("ball").agg(F.sum("n").alias("_whole"))
    )
    by_place = opened.groupBy("place").agg(F.sum("n").alias("_part"))
    about_ball = settle(
        leads.select("ball", "weight").join(by_ball, "ball", "left").join(roots, "ball", "left"), "rooted"
    )
    named = attach(members.select("place", *SAME, "ball"), about_ball, ["ball"], "inner").join(by_place, "place", "left")
    zero = F.lit(0).cast("bigint")
    return named.select(
        *SAME,
        (F.col("weight") - 1 + F.coalesce("_whole", zero) + F.coalesce("_part", zero)).alias("n_links"),
        F.coalesce("root", "ball").alias("component"),
    )


def dedup(rows: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row (vec_id, embedding)."""
    vector = F.when(usable(F.col("embedding")), F.col("embedding"))
    stored = rows.select("vec_id", vector.alias("vector"))
    stored = stored.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(SEED), "vector")})
    stored = settle(stored, "rows")
    able = stored.where(F.col("vector").isNotNull())
    found = settle(links(able.select(*SAME, "vector"), cosine, sample), "links")
    named = attach(able.select("vec_id", *SAME), found, SAME, "inner")
    named = settle(named.select("vec_id", "n_links", "component"), "named")
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    linked = attach(named, least, ["component"], "inner").select("vec_id", "n_links", "component_id")
    rest = stored.where(F.col("vector").isNull()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    every = linked.unionByName(rest)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
