"""Ordered mutations applied as set-based jobs.

A mutation log has the cell columns plus ``seq`` (the order of application), ``op``
and, for increments, ``amount``.  Nothing is folded row by row: what a mutation does
to a cell depends only on the *last* delete that covers it, the last put of the same
version, or a sum since its column's newest put, so each of those is an aggregate on its own
scope.  The exceptions are walked in order (``operators.histories``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellarium.functions.bytewise import bytes_to_long, long_to_bytes, put_cell_size
from cellarium.model import CELL, COLUMN, FAMILY, LATEST, ROW, VERSION
from cellarium.operators import histories
from cellarium.operators.filters import newest
from cellarium.plans.keyspace import KeySet
from cellarium.plans.scratch import settle
from cellarium.plans.skew import (
    Side,
    attach,
    hot_keys,
    last_before,
    lookup,
    measured,
    row_bytes,
    running,
    topmost,
    within_broadcast,
)

PUT = "PUT"
DELETE_ROW = "DELETE_ROW"
DELETE_FAMILY = "DELETE_FAMILY"
DELETE_COLUMN = "DELETE_COLUMN"
DELETE_COLUMN_TO = "DELETE_COLUMN_TO"
DELETE_VERSION = "DELETE_VERSION"
INCREMENT = "INCREMENT"
APPEND = "APPEND"
GET = "GET"

# Deletes of everything in a scope, whatever the timestamp.
COVERING = {DELETE_ROW: ROW, DELETE_FAMILY: FAMILY, DELETE_COLUMN: COLUMN}

BASE_SEQ = -1
LOG = [*CELL, "seq", "op", "amount"]
MAX_CELL_BYTES = 100 << 20

SCOPES = {**COVERING, DELETE_COLUMN_TO: VERSION, DELETE_VERSION: VERSION}

# A column with more undominated "up to a timestamp" marks than this is walked in
# order instead of carrying its marks to every cell.
CARRIED_MARKS = 1000


def only(log: DataFrame, *ops: str) -> DataFrame:
    return log.where(F.col("op").isin(*ops))


def as_log(cells: DataFrame, seq: int = BASE_SEQ) -> DataFrame:
    """A table's cells as puts older than every logged mutation."""
    return cells.select(*CELL, F.lit(seq).cast("bigint").alias("seq"))


class Marks:
    """The delete marks of a log: the last one of every scope, written once.

    Every later step joins with these few records instead of reading the log again,
    and their measured size decides between broadcast and shuffle.
    """

    def __init__(self, log: DataFrame):
        op = F.col("op")
        reduced = (
            only(log, *SCOPES)
            .groupBy(
                "op",
                "row",
                F.when(op != DELETE_ROW, F.col("family")).alias("family"),
                F.when(~op.isin(DELETE_ROW, DELETE_FAMILY), F.col("qualifier")).alias("qualifier"),
                F.when(~op.isin(*COVERING), F.col("ts")).alias("ts"),
            )
            .agg(F.max("seq").alias("seq"))
        )
        self.table = settle(reduced, "marks")
        sizes = self.table.groupBy("op").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(self.table)).alias("bytes")
        )
        self.small = {
            found["op"]: within_broadcast(log, found["rows"], found["bytes"])
            for found in sizes.collect()
        }

    def __contains__(self, op: str) -> bool:
        return op in self.small

    def of(self, op: str, name: str = "seq") -> DataFrame:
        return only(self.table, op).select(*SCOPES[op], F.col("seq").alias(name))

    def join(self, df: DataFrame, op: str, name: str) -> DataFrame:
        """Adds the seq of the last mark of this kind over each record."""
        return Side(self.of(op, name), self.small[op]).join(df, SCOPES[op])


def last_cover(df: DataFrame, marks: Marks) -> DataFrame:
    """Adds ``_cover``: seq of the last delete covering the whole column, else NULL."""
    names = []
    for op in COVERING:
        if op in marks:
            names.append(f"_{op.lower()}")
            df = marks.join(df, op, names[-1])
    none = F.lit(None).cast("bigint")
    return df.withColumn("_cover", F.greatest(none, none, *names)).drop(*names)


def last_writes(puts: DataFrame) -> DataFrame:
    """The last put of every version.

    Whether a delete covers a put depends on its version and its place in the
    order, so a put older than a dead put is dead too: reducing first is safe.
    """
    last = puts.groupBy(*VERSION).agg(F.max(F.struct("seq", "value")).alias("_w"))
    return last.select(*VERSION, "_w.value", "_w.seq")


def survivors(puts: DataFrame, marks: Marks) -> DataFrame:
    """Puts (with seq) no later delete of the log removes."""
    live = last_cover(puts, marks)
    live = live.where(F.col("_cover").isNull() | (F.col("seq") > F.col("_cover"))).drop("_cover")
    if DELETE_VERSION in marks:
        live = marks.join(live, DELETE_VERSION, "_point")
        live = live.where(F.col("_point").isNull() | (F.col("seq") > F.col("_point")))
    live = live.select(*puts.columns)
    # Stored, as the columns are counted before they are joined.
    return _drop_older(settle(live, "live"), marks) if DELETE_COLUMN_TO in marks else live


def _drop_older(puts: DataFrame, marks: Marks) -> DataFrame:
    """Deletes up to a timestamp: a put dies if a later mark reaches its timestamp.

    Two orders are involved, so one largest mark per column is not enough.  A mark
    counts only if no later mark reaches as far; the few that are left go to every
    cell of their column.  A column with many of them is walked backwards in seq
    instead, where the largest mark so far decides.
    """
    reach = running(
        marks.of(DELETE_COLUMN_TO),
        COLUMN,
        [F.col("seq").desc()],
        {"_later": ("max", F.col("ts"), False)},
    ).where(F.col("_later").isNull() | (F.col("ts") > F.col("_later")))
    reach = settle(reach.select(*VERSION, "seq"), "reach")
    counts = reach.groupBy(*COLUMN).agg(F.count(F.lit(1)).alias("_n"))
    long = counts.where(F.col("_n") > CARRIED_MARKS).select(*COLUMN)
    if long.isEmpty():
        return _carry_marks(puts, reach)
    long = measured(long)
    rest, walked = (
        step(long.join(puts, COLUMN, how), long.join(reach, COLUMN, how))
        for step, how in ((_carry_marks, "left_anti"), (_walk_marks, "left_semi"))
    )
    return rest.unionByName(walked)


def _carry_marks(puts: DataFrame, reach: DataFrame) -> DataFrame:
    carried = reach.groupBy(*COLUMN).agg(F.collect_list(F.struct("seq", "ts")).alias("_marks"))
    dead = F.exists(
        "_marks", lambda mark: (mark["seq"] > F.col("seq")) & (mark["ts"] >= F.col("ts"))
    )
    kept = lookup(puts, carried, COLUMN).where(F.col("_marks").isNull() | ~dead)
    return kept.select(*puts.columns)


def _walk_marks(puts: DataFrame, reach: DataFrame) -> DataFrame:
    none = F.lit(None)
    events = puts.withColumn("_mark", none.cast("bigint")).unionByName(
        reach.select(*VERSION, none.cast("binary").alias("value"), "seq", F.col("ts").alias("_mark"))
    )
    walked = running(
        events, COLUMN, [F.col("seq").desc()], {"_reach": ("max", F.col("_mark"), False)}
    )
    kept = walked.where(
        F.col("_mark").isNull() & (F.col("_reach").isNull() | (F.col("ts") > F.col("_reach")))
    )
    return kept.select(*puts.columns)


# ---- increments and appends -------------------------------------------------


def by_op(log: DataFrame) -> DataFrame:
    """The log written once, a folder per operation.

    Every step reads its own operations and columns only, instead of deriving the
    whole log again.
    """
    return settle(log.select(*LOG), "log", by="op")


def read_modify_write(
    base: DataFrame,
    log: DataFrame,
    marks: Marks | None = None,
    max_bytes: int = MAX_CELL_BYTES,
    wanted: str | None = None,
) -> DataFrame:
    """What every increment and append does: column, seq, op, ts, value, or ``error``.

    Each reads the newest version of its column at its place in the order, and writes its
    result at its own timestamp, or at the newest one if that is later.  Columns with
    increments only are running sums between the puts that became newest; a column where appends, deletes
    by timestamp or values that are no counters occur is walked in order.  With ``wanted`` (one of
    the two) only that operation's columns are taken, and its results given.
    """
    marks = Marks(log) if marks is None else marks
    ops = only(log, INCREMENT, APPEND)
    kinds = ops.groupBy(*COLUMN).agg(
        F.max(F.col("op") == APPEND).alias("_append"), F.max(F.col("op") == INCREMENT).alias("_increment")
    )
    kinds = settle(kinds, "columns")
    columns = measured((kinds if wanted is None else kinds.where(f"_{wanted.lower()}")).select(*COLUMN, "_append"))
    if wanted is not None:
        ops = measured(kinds.where(f"NOT _{wanted.lower()}").select(*COLUMN)).join(ops, COLUMN, "left_anti")
    # Read once each: every step below would derive them again.
    stored = settle(columns.join(base.select(*CELL), COLUMN, "left_semi"), "stored")
    puts = settle(columns.join(only(log, PUT).select(*CELL, "seq"), COLUMN, "left_semi"), "puts")
    odd_value = F.octet_length("value") != 8
    walked = (
        columns.df.where("_append").select(*COLUMN)
        .unionByName(only(marks.table, DELETE_COLUMN_TO, DELETE_VERSION).select(*COLUMN))
        .unionByName(stored.where(odd_value).select(*COLUMN))
        .unionByName(puts.where(odd_value).select(*COLUMN))
    )
    walked = measured(settle(columns.join(walked, COLUMN, "left_semi").distinct(), "walked"))

    def part(df: DataFrame, how: str) -> DataFrame:
        return walked.join(df, COLUMN, how)

    passed = _walk(
        part(stored, "left_semi"), part(puts, "left_semi"), part(ops, "left_semi"), walked, marks, log, max_bytes
    )
    if wanted != APPEND:  # appended columns are all walked
        sums = _sums(
            newest(part(stored, "left_anti")), part(puts, "left_anti"), part(ops, "left_anti"), marks, log
        )
        passed = sums.unionByName(passed)
    return passed if wanted is None else only(passed, wanted)


def _covers(events: DataFrame, marks: Marks, log: DataFrame) -> DataFrame:
    """Adds ``_cover``: seq of the last delete before each event (by seq) that covers its column."""
    never = F.lit(BASE_SEQ - 1).cast("bigint")
    found = [op for op in COVERING if op in marks]
    deletes = only(log, *found).select(*COLUMN, "seq", "op")
    both = events.withColumn("_event", F.lit(None).cast("string")).unionByName(
        deletes.withColumnRenamed("op", "_event"), allowMissingColumns=True
    )
    hot, _ = hot_keys(both, ROW)
    covers = []
    if hot is None:
        # One shuffle by row serves all scopes; a delete with the seq of an event comes after it.
        for op in found:
            covers.append(f"_{op.lower()}")
            order = Window.partitionBy(*COVERING[op]).orderBy("seq", F.col("_event").isNotNull())
            upto = order.rowsBetween(Window.unboundedPreceding, 0)
            own = F.when(F.col("_event") == op, F.col("seq"))
            both = both.withColumn(covers[-1], F.max(own).over(upto))
        events = both.where("_event IS NULL").drop("_event")
    else:
        for op in found:
            scope = COVERING[op]
            covers.append(f"_{op.lower()}")
            own = only(deletes, op).select(*scope, "seq", F.struct("seq").alias("_event"))
            events = last_before(events, own, scope, covers[-1])
            events = events.withColumn(covers[-1], F.col(f"{covers[-1]}.seq"))
    return events.withColumn("_cover", F.greatest(never, never, *covers)).drop(*covers)


def _sums(stored, puts, ops, marks: Marks, log: DataFrame) -> DataFrame:
    """Increments of columns that hold counters only and lose them to covering deletes only."""
    none = F.lit(None)
    number, own = bytes_to_long(F.col("value")).alias("put"), [*COLUMN, "seq", "ts"]
    events = as_log(stored).select(*own, number).unionByName(puts.select(*own, number))
    events = events.withColumn("amount", none.cast("bigint")).unionByName(
        ops.select(*own, none.cast("bigint").alias("put"), "amount")
    )
    events = settle(events, "sums")
    if any(op in marks for op in COVERING):
        events = settle(_covers(events, marks, log), "events")
    else:
        events = events.withColumn("_cover", F.lit(BASE_SEQ - 1).cast("bigint"))
    keys, order = [*COLUMN, "_cover"], [F.col("seq").asc()]
    hot = hot_keys(events, keys)
    totals = running(
        events, keys, order,
        {"_top": ("max", F.col("ts"), False), "_sum": ("sum", F.col("amount"))}, hot,
    )
    # A put that is older than the newest version is no start for later increments.
    leads = F.col("put").isNotNull() & (F.col("_top").isNull() | (F.col("ts") >= F.col("_top")))
    start = F.when(leads, F.struct("put", "_sum"))
    placed = running(totals, keys, order, {"_start": ("last", start)}, hot)
    value = (
        F.coalesce(F.col("_start.put"), F.lit(0))
        + F.col("_sum")
        - F.coalesce(F.col("_start._sum"), F.lit(0))
    )
    return placed.where(F.col("amount").isNotNull()).select(
        *COLUMN, "seq", F.lit(INCREMENT).alias("op"), F.greatest("ts", "_top").alias("ts"),
        long_to_bytes(value).alias("value"), none.cast("string").alias("error"),
    )


def _walk(stored, puts, ops, walked: Side, marks: Marks, log: DataFrame, max_bytes: int) -> DataFrame:
    none = F.lit(None)
    fields = [*COLUMN, "seq", "op", "ts", "value", "amount"]
    no_amount = none.cast("bigint").alias("amount")
    put = {"op": F.lit(PUT), "amount": no_amount}
    stored = _pinned(as_log(stored).withColumns(put).select(*fields), marks)
    # Of stored versions the newest is read, and what deletes of single versions can bring back.
    stored = newest(stored.where(~F.coalesce("pinned", F.lit(False)))).unionByName(stored.where("pinned"))
    events = puts.select(*CELL, "seq").withColumns(put).select(*fields).unionByName(ops.select(*fields))
    for op, scope in SCOPES.items():
        if op in marks:
            # Each delete is copied to the walked columns of its scope only.
            scope = [c for c in scope if c in COLUMN]
            met = walked.df.select(*COLUMN).join(only(log, op).select(*scope, "seq", "op", "ts"), scope)
            blank = {"value": none.cast("binary"), "amount": no_amount}
            events = events.unionByName(met.withColumns(blank).select(*fields))
    # Stored, as the walk counts the hot columns first and would derive all events twice.
    return histories.walk(settle(stored.unionByName(_pinned(events, marks)), "events"), max_bytes)


def _pinned(df: DataFrame, marks: Marks) -> DataFrame:
    """Adds whether a delete of a single version names this one; null where its column has none."""
    if DELETE_VERSION not in marks:
        return df.withColumn("pinned", F.lit(None).cast("boolean"))
    columns = measured(marks.of(DELETE_VERSION).select(*COLUMN).distinct().withColumn("_any", F.lit(True)))
    named = columns.join(marks.join(df, DELETE_VERSION, "_point"), COLUMN)
    return named.withColumn("pinned", F.when(F.col("_any"), F.col("_point").isNotNull())).drop("_any", "_point")


def _written(results: DataFrame) -> DataFrame:
    return results.where("error IS NULL").select(*CELL, "seq")


def increments(base: DataFrame, log: DataFrame) -> DataFrame:
    """After-images of counters: the put that each increment amounts to."""
    log = by_op(log)
    return _written(read_modify_write(base, log, wanted=INCREMENT))


def appends(base: DataFrame, log: DataFrame, max_bytes: int = MAX_CELL_BYTES) -> DataFrame:
    """After-images of appended columns: the put that each append amounts to.

    One that would make a cell larger than ``max_bytes`` writes nothing.
    """
    log = by_op(log)
    return _written(read_modify_write(base, log, max_bytes=max_bytes, wanted=APPEND))


def after_images(base: DataFrame, log: DataFrame) -> DataFrame:
    """Increments and appends as the puts a second copy of the table needs."""
    both = _written(read_modify_write(base, by_op(log)))
    return both.withColumn("op", F.lit(PUT)).withColumn("amount", F.lit(None).cast("bigint"))


# ---- replay -----------------------------------------------------------------


def replay(base: DataFrame, log: DataFrame) -> DataFrame:
    """The table after all mutations, in ``seq`` order.

    Rows the log does not name are passed through; when the log's keys are few
    that costs the table no shuffle.
    """
    log = by_op(log)
    marks = Marks(log)
    rows = measured(settle(log.select("row").distinct(), "rows"))
    touched = rows.join(base.select(*CELL), ROW, "left_semi")
    untouched = rows.join(base.select(*CELL), ROW, "left_anti")
    puts = as_log(touched).unionByName(only(log, PUT).select(*CELL, "seq"))
    if not only(log, INCREMENT, APPEND).isEmpty():
        puts = puts.unionByName(_written(read_modify_write(touched, log, marks)))
    return untouched.unionByName(survivors(last_writes(puts), marks).select(*CELL))


def apply_puts(base: DataFrame, puts: DataFrame) -> DataFrame:
    """Upsert on the version key; the last put wins."""
    return last_writes(as_log(base).unionByName(puts.select(*CELL, "seq"))).select(*CELL)


def apply_deletes(base: DataFrame, log: DataFrame) -> DataFrame:
    return survivors(as_log(base), Marks(log)).select(*CELL)


def drop_rows(cells: DataFrame, rows: KeySet) -> DataFrame:
    return cells.where(rows.complement().test(F.col("row")))


def drop_families(cells: DataFrame, *families: str) -> DataFrame:
    return cells.where(~F.col("family").isin(*families))


def fill_timestamps(log: DataFrame, batch_ts: int) -> DataFrame:
    """Puts without a timestamp get the batch's; deletes keep theirs."""
    unset = (F.col("op") == PUT) & (F.col("ts").isNull() | (F.col("ts") == LATEST))
    return log.withColumn("ts", F.when(unset, F.lit(batch_ts)).otherwise(F.col("ts")))


def last_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """Input of one operation with repeated keys: the last one counts."""
    rest = ["seq", *[name for name in df.columns if name not in (*keys, "seq")]]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_last"))
    return picked.select(*keys, "_last.*").select(*df.columns)


def runs(log: DataFrame, same: Column) -> DataFrame:
    """Numbers the runs of neighbouring mutations of a row that agree in ``same``."""
    order = [F.col("seq").asc()]
    marked = log.withColumn("_same", same)
    before = running(marked, ROW, order, {"_prev": ("last", F.col("_same"), False)})
    edge = F.when(F.col("_prev").eqNullSafe(F.col("_same")), 0).otherwise(1).cast("bigint")
    return running(before, ROW, order, {"run": ("sum", edge)}).drop("_prev", "_same")


# ---- batches ----------------------------------------------------------------

KNOWN_OPS = [PUT, GET, INCREMENT, APPEND, DELETE_ROW, DELETE_FAMILY, DELETE_COLUMN,
             DELETE_COLUMN_TO, DELETE_VERSION]


def problem(max_put_bytes: int = MAX_CELL_BYTES) -> Column:
    """Why a mutation is refused, or NULL."""
    op, ts = F.col("op"), F.col("ts")
    return (
        F.when(~op.isin(*KNOWN_OPS), F.lit("unknown operation"))
        .when((op == PUT) & (F.col("value").isNull() | F.col("qualifier").isNull()), F.lit("empty put"))
        .when((op == PUT) & (put_cell_size() > max_put_bytes), F.lit("put too large"))
        .when(op.isin(DELETE_ROW, DELETE_FAMILY) & (ts != LATEST), F.lit("scope delete at a timestamp"))
        .when((op == DELETE_VERSION) & (ts == LATEST), F.lit("delete of the single latest version"))
        .when((op == INCREMENT) & F.col("amount").isNull(), F.lit("increment without amount"))
    )


def checked(log: DataFrame, max_put_bytes: int = MAX_CELL_BYTES) -> tuple[DataFrame, DataFrame]:
    """Accepted and refused mutations; one failure does not stop the others."""
    judged = log.withColumn("error", problem(max_put_bytes))
    return judged.where("error IS NULL").drop("error"), judged.where("error IS NOT NULL")


def batch_results(
    base: DataFrame,
    log: DataFrame,
    max_put_bytes: int = MAX_CELL_BYTES,
    max_bytes: int = MAX_CELL_BYTES,
) -> DataFrame:
    """One outcome per action: ok, error, and the result of gets, increments and appends.

    Gets read the table as it was before the batch.  An increment of a value that is no
    counter, or an append past ``max_bytes``, fails alone.
    """
    good, _ = checked(log, max_put_bytes)
    asked = only(good, GET).select("seq", *COLUMN)
    wanted = asked.select(*COLUMN).distinct()
    stored = newest(attach(base.select(*CELL), wanted, COLUMN, "left_semi"))
    got = lookup(asked, stored.select(*COLUMN, "value"), COLUMN).select("seq", "value")
    done = read_modify_write(base, by_op(good), max_bytes=max_bytes).select("seq", "value", "error")
    results = got.withColumn("error", F.lit(None).cast("string")).unionByName(done).select(
        "seq", F.col("value").alias("result"), F.col("error").alias("_failed")
    )
    judged = log.select("seq", "op", problem(max_put_bytes).alias("_refused"))
    error = F.coalesce("_refused", "_failed")
    return judged.join(results, ["seq"], "left").select(
        "seq", "op", error.isNull().alias("ok"), error.alias("error"), "result"
    )


# ---- retention --------------------------------------------------------------


def apply_retention(
    cells: DataFrame, rules: dict[str, tuple[int | None, int | None, int | None]], now: int
) -> DataFrame:
    """Rules per family: (max versions, min versions, time to live in ms).

    A version goes when it is beyond max versions, or when it is older than the
    time to live and (if min versions is set) also beyond min versions.  Families
    without a rule keep everything.
    """
    if not rules:
        return cells
    for most, least, _ in rules.values():
        if least is not None and most is not None and least >= most:
            raise ValueError("min versions must be less than max versions")

    def ruled(rule) -> Column:
        """The rule of a cell's family; NULL where there is none."""
        chosen = F.lit(None).cast("bigint")
        for family, values in rules.items():
            own = F.lit(rule(*values)).cast("bigint")
            chosen = F.when(F.col("family") == family, own).otherwise(chosen)
        return chosen

    # Ranks beyond the largest number of versions any rule asks for don't matter.
    deepest = max(max(most or 0, least or 0) for most, least, _ in rules.values())
    young = F.coalesce(F.col("ts") >= ruled(lambda most, least, ttl: None if ttl is None else now - ttl), F.lit(True))
    if not deepest:
        return cells.where(young)
    ranked_cells = topmost(cells.where(F.col("family").isin(*rules)), COLUMN, [F.col("ts").desc()], deepest, "_rank")
    most = ruled(lambda most, least, ttl: most)
    least = ruled(lambda most, least, ttl: least if ttl is not None else None)
    rank = F.col("_rank")
    kept = ranked_cells.where(
        F.coalesce(rank <= most, F.lit(True)) & (young | F.coalesce(rank <= least, F.lit(False)))
    ).drop("_rank")
    # Families without a limit on versions keep the young ones whatever their rank.
    unlimited = F.col("family").isin(*[name for name, (most, _, _) in rules.items() if most is None])
    rest = cells.where(~F.col("family").isin(*rules) | (unlimited & young))
    return kept.where(~unlimited | ~young).unionByName(rest)
