"""Conditional mutations: apply a row's mutations if one of its columns passes a test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cellarium.model import CELL, COLUMN, FAMILY, LATEST, ROW
from cellarium.operators.filters import newest
from cellarium.operators.mutate import (
    APPEND,
    DELETE_VERSION,
    INCREMENT,
    MAX_CELL_BYTES,
    PUT,
    as_log,
    only,
)
from cellarium.operators.sequential import piece_pass, row_pass
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach, hot_keys, last_before, measured

# Columns of a check.  ``expected`` NULL or empty asks for absence, or for presence
# with "!=".  The time range is tested on the newest version.
CHECK = ["seq", *COLUMN, "op", "expected", "not_before", "before"]


def holds(check: tuple, ts: int | None, stored: bytes | None) -> bool:
    """The test of one check (op, expected, not_before, before) against the newest version of its column.

    The comparison reads "expected OP stored value", the reverse of a value filter.
    """
    op, expected, start, stop = check
    in_time = stored is not None and ts >= (start or 0) and (stop in (None, LATEST) or ts < stop)
    if not expected:
        return in_time == (op == "!=")
    compare = {
        "=": expected == stored, "!=": expected != stored,
        "<": in_time and expected < stored, "<=": in_time and expected <= stored,
        ">": in_time and expected > stored, ">=": in_time and expected >= stored,
    }
    return in_time and compare.get(op, False)


def check_and_mutate(
    base: DataFrame, checks: DataFrame, mutations: DataFrame, now: int
) -> tuple[DataFrame, DataFrame]:
    """Returns one (seq, applied) per check, and the log of the mutations that apply.

    ``mutations`` carry the seq of their check, and must stay in its row.  Puts
    without a timestamp get ``now``.  Checks of a row see what earlier checks of the
    batch changed, and each reads the newest version of its column at its place in the order.

    A row's checks are judged in one ordered pass, whatever their mutations are.  Hot rows don't fit one
    task: they are cut into pieces, each judged for the versions that come in by the present guess, until
    no guess changes.
    """
    moved = mutations.alias("m").join(
        checks.select("seq", F.col("row").alias("_row")), ["seq"]
    ).where(F.col("row") != F.col("_row"))
    if not moved.isEmpty():
        raise ValueError("a conditional mutation must stay in the checked row")
    mutations = mutations.withColumn("ts", F.coalesce("ts", F.lit(now).cast("bigint")))
    if "amount" not in mutations.columns:
        mutations = mutations.withColumn("amount", F.lit(None).cast("bigint"))
    hot, pieces = hot_keys(checks.select(*ROW).unionAll(mutations.select(*ROW)), ROW)
    if hot is None:
        flags = settle(_in_order(base, checks, mutations), "checks")
    else:
        side = measured(hot)
        cold, large = (
            [side.join(df, ROW, how) for df in (base.select(*CELL), checks, mutations)]
            for how in ("left_anti", "left_semi")
        )
        flags = settle(_in_order(*cold).unionByName(_in_pieces(*large, pieces)), "checks")
    accepted = flags.where("applied").select("seq")
    return flags, mutations.join(accepted, ["seq"], "left_semi")


FIELDS = ["row", "seq", "kind", "family", "qualifier", "op", "ts", "value", "amount",
          "expected", "not_before", "before"]


def _event(df: DataFrame, kind: str, place, **known) -> DataFrame:
    types = {"family": "string", "qualifier": "binary", "op": "string", "ts": "bigint",
             "value": "binary", "amount": "bigint", "expected": "binary",
             "not_before": "bigint", "before": "bigint"}
    none = F.lit(None)
    blank = {k: none.cast(t) for k, t in types.items() if k not in df.columns and k not in known}
    return df.withColumns({"kind": F.lit(kind), "_place": place, **known, **blank}).select(*FIELDS, "_place")


def _given(checks: DataFrame, mutations: DataFrame) -> DataFrame:
    """Checks and mutations in one table; ``_place`` orders those of one seq."""
    # As in a replay, a delete also covers what its own seq puts.
    by_kind = F.when(F.col("op").startswith("DELETE"), 4).when(F.col("op") == PUT, 2).otherwise(3)
    return _event(checks, "check", F.lit(1)).unionByName(_event(mutations, "mutation", by_kind))


def _in_order(base: DataFrame, checks: DataFrame, mutations: DataFrame) -> DataFrame:
    """One pass over the checks and mutations of each row; only columns that are read are kept."""
    read = checks.select(*COLUMN).unionAll(only(mutations, INCREMENT, APPEND).select(*COLUMN)).distinct()
    stored = attach(base.select(*CELL), read, COLUMN, "left_semi")
    events = _event(as_log(stored), "stored", F.lit(0), op=F.lit(PUT)).unionByName(_given(checks, mutations))
    ordered = events.repartition("row").sortWithinPartitions("row", "seq", "_place", "ts").drop("_place")
    seq = checks.schema["seq"].dataType.simpleString()
    return ordered.mapInArrow(row_pass(holds, MAX_CELL_BYTES), f"seq {seq}, applied boolean")


VERSIONS = "array<struct<ts: bigint, value: binary, pinned: boolean>>"


def _in_pieces(base: DataFrame, checks: DataFrame, mutations: DataFrame, pieces: int) -> DataFrame:
    """Rows cut into pieces by seq; all are judged at once, for guesses of what comes into them.

    What comes into a piece are the versions of the columns it names, no others: those the last
    piece before has left that wrote or deleted there, or else the stored ones.  The first guess is that
    nothing changes on the way.  Pieces are judged again while their guess was wrong; the first
    one's never is, so the pieces of a row are right after as many rounds at most, and after two where no
    piece's answers depend on the one before.
    """
    parts = max(pieces, int(base.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    # The mutations of a check stay in its piece.
    laid = _given(checks, mutations).repartitionByRange(parts, "row", "seq")
    laid = laid.sortWithinPartitions("row", "seq", "_place", "ts").drop("_place")
    laid = settle(laid.withColumn("pos", F.monotonically_increasing_id()), "history")
    laid = laid.withColumn("piece", F.shiftright("pos", 33))
    columns = laid.where(F.col("family").isNotNull() & F.col("qualifier").isNotNull())
    named = settle(columns.select(*COLUMN, F.col("piece").alias("seq")).distinct(), "named")

    point = only(laid, DELETE_VERSION).select(*COLUMN, "ts").distinct().withColumn("pinned", F.lit(True))
    stored = attach(base, named.select(*COLUMN).distinct(), COLUMN, "left_semi")
    stored = attach(stored, point, [*COLUMN, "ts"]).withColumn("pinned", F.coalesce("pinned", F.lit(False)))
    stored = newest(stored.where("NOT pinned")).unionByName(stored.where("pinned"))
    stored = stored.groupBy(*COLUMN).agg(
        F.array_sort(F.collect_list(F.struct("ts", "value", "pinned"))).alias("_stored")
    )
    named = settle(attach(named, stored, COLUMN), "named")
    laid = attach(laid, point, [*COLUMN, "ts"])

    none = F.array().cast(VERSIONS)
    came = settle(named.withColumn("versions", F.coalesce("_stored", none)), "came")
    told, dirty = None, came
    while True:
        now = settle(_judged(laid, dirty), "judged")
        again = measured(dirty.select("row", F.col("seq").alias("piece")).distinct())
        told = now if told is None else settle(again.join(told, ["row", "piece"], "left_anti").unionByName(now), "told")
        guess = settle(_coming(named, told), "came")
        before = came.select(*COLUMN, "seq", F.col("versions").alias("_was"))
        wrong = guess.join(before, [*COLUMN, "seq"]).where(F.col("versions") != F.col("_was"))
        wrong = settle(wrong.select("row", "seq").distinct(), "wrong")
        if wrong.isEmpty():
            return told.where("kind = 'answer'").select("seq", "applied")
        came, dirty = guess, attach(guess, wrong, ["row", "seq"], "left_semi")


def _judged(laid: DataFrame, came: DataFrame) -> DataFrame:
    """Answers of the pieces something comes into, and what they leave."""
    state = came.select(
        *COLUMN, F.col("seq").alias("piece"), F.lit(-1).cast("bigint").alias("pos"),
        F.lit("state").alias("kind"), "versions",
    )
    pieces = measured(came.select("row", F.col("seq").alias("piece")).distinct())
    events = pieces.join(laid, ["row", "piece"], "left_semi").unionByName(state, allowMissingColumns=True)
    events = events.repartition("row", "piece").sortWithinPartitions("row", "piece", "pos")
    seq = laid.schema["seq"].dataType
    arrow = to_arrow_type(seq)
    kinds = (
        f"row binary, piece bigint, kind string, seq {seq.simpleString()}, applied boolean, family string, "
        f"qualifier binary, versions {VERSIONS}"
    )
    events = events.select("row", "piece", *[c for c in FIELDS if c != "row"], "pinned", "versions")
    return events.mapInArrow(piece_pass(holds, MAX_CELL_BYTES, arrow), kinds)


def _coming(named: DataFrame, told: DataFrame) -> DataFrame:
    """What comes into every piece, by what the pieces before it leave."""
    order = F.col("piece").alias("seq")
    left = told.where("kind = 'left'").select(*COLUMN, order, F.struct("piece", "versions").alias("_event"))
    found = last_before(named, left, COLUMN, "_column")
    empty = F.struct("piece", F.array().cast(VERSIONS).alias("versions")).alias("_event")
    for keys, name in ((FAMILY, "_family"), (ROW, "_row")):
        gone = told.where((F.col("kind") == "cleared") & (F.col("family").isNotNull() if keys == FAMILY else F.col("family").isNull()))
        found = last_before(found, gone.select(*keys, order, empty), keys, name)
    # A piece that names a column tells of it, so no piece counts twice for one.
    last = F.greatest(*[F.coalesce(F.col(f"{c}.piece"), F.lit(-1).cast("bigint")) for c in ("_column", "_family", "_row")])
    came = F.when(last == -1, F.col("_stored")).when(last == F.col("_column.piece"), F.col("_column.versions"))
    return found.select(*COLUMN, "seq", F.coalesce(came, F.array().cast(VERSIONS)).alias("versions"))
