"""Structured Streaming jobs over change logs.

A copy is kept as an append-only log of mutations, one folder per micro-batch, over a
base table.  A repeated micro-batch overwrites its own folder, so nothing is applied
twice, increments included; nothing is rewritten per batch.  Reading replays the log;
``compact`` folds it into a new base from time to time.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from cellarium.functions.bytewise import long_to_bytes
from cellarium.model import CELL_SCHEMA, COLUMN, LATEST, ROW
from cellarium.operators import mutate as m
from cellarium.operators.sequential import act
from cellarium.plans.skew import measured
from cellarium.streaming import changes as ch

LOG_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        *CELL_SCHEMA.fields,
        T.StructField("seq", ch.SEQ),
        T.StructField("op", T.StringType()),
        T.StructField("amount", T.LongType()),
    ]
)
BASE_SCHEMA = T.StructType([T.StructField("table", T.StringType()), *CELL_SCHEMA.fields])


def _with(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, T.LongType())])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    # The folder is made when the first batch is; until then there is nothing.
    reader = spark.read.schema(schema).option("ignoreMissingFiles", "true")
    try:
        return reader.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


class Copy:
    """A table kept up to date by micro-batches, under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, log: DataFrame, batch_id: int) -> None:
        log = log.withColumn("seq", F.col("seq").cast(ch.SEQ)).select(*LOG_SCHEMA.fieldNames())
        log.write.mode("overwrite").parquet(f"{self.path}/log/batch_id={batch_id}")

    def start_from(self, tables: DataFrame, batch_id: int = -1) -> None:
        """Stores a base (cells with ``table``) holding every batch up to ``batch_id``."""
        tables.select("table", *CELL_SCHEMA.fieldNames()).write.mode("overwrite").parquet(
            f"{self.path}/base/upto={batch_id}"
        )

    def _read(self, folder: str, schema: T.StructType) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/{folder}", schema)

    def _state(self, before: int | None) -> tuple[DataFrame, DataFrame]:
        """Newest base and the log since, all tables in one, up to a micro-batch."""
        bases = self._read("base", _with(BASE_SCHEMA, "upto"))
        upto = bases.agg(F.max("upto")).first()[0]
        base = bases.where(F.col("upto") == upto) if upto is not None else bases.limit(0)
        log = self._read("log", _with(LOG_SCHEMA, "batch_id"))
        if upto is not None:
            log = log.where(F.col("batch_id") > upto)
        if before is not None:
            log = log.where(F.col("batch_id") < before)
        return base.drop("upto"), log.drop("batch_id")

    def log(self) -> DataFrame:
        return self._read("log", _with(LOG_SCHEMA, "batch_id"))

    def read(self, table: str, before: int | None = None) -> DataFrame:
        """One table now, or as it was before a micro-batch."""
        base, log = (side.where(F.col("table") == table).drop("table") for side in self._state(before))
        return m.replay(base, log)

    def read_all(self, before: int | None = None, rows: DataFrame | None = None) -> DataFrame:
        """Every table, with ``table``; one replay however many tables there are.

        With ``rows`` (keys as ``table_key`` makes them) only those are read and replayed.
        """
        base, log = (table_key(side) for side in self._state(before))
        if rows is not None:
            side = measured(rows)
            base, log = (side.join(part, ROW, "left_semi") for part in (base, log))
        return split_key(m.replay(base, log))

    def compact(self, batch_id: int) -> None:
        """Folds batches up to ``batch_id`` into a new base; later batches stay log."""
        self.start_from(self.read_all(before=batch_id + 1), batch_id)


def table_key(df: DataFrame) -> DataFrame:
    """Puts the table in front of the row key, so rows of many tables replay together."""
    row = F.concat(F.col("table").cast("binary"), F.lit(b"\x00"), F.col("row"))
    return df.withColumn("row", row).drop("table")


def split_key(df: DataFrame) -> DataFrame:
    bytewise = F.substring_index(F.decode("row", "ISO-8859-1"), "\x00", 1)
    table = F.encode(bytewise, "ISO-8859-1")
    return df.withColumn("table", table.cast("string")).withColumn(
        "row", F.substring(F.col("row"), F.octet_length(table) + 2, F.octet_length("row"))
    )


def _run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Processes all available input in micro-batches; an error fails the batch."""
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def replicate(
    entries: DataFrame,
    copy: Copy,
    checkpoint: str,
    loop_tag: bytes | str | None = None,
    origin_tag: bytes | str | None = None,
    tests: list[Column] = (),
) -> None:
    """Applies a stream of log entries to a copy, all tables of a batch or none."""

    def each(batch: DataFrame, batch_id: int) -> None:
        log = ch.to_log(ch.classify(ch.entry_filter(batch, *tests), loop_tag))
        if origin_tag is not None:
            log = log.unionByName(ch.origin_tags(log, origin_tag))
        copy.append(log, batch_id)

    _run(entries, each, checkpoint)


def dry_run(
    entries: DataFrame, checkpoint: str, loop_tag: bytes | str | None = None
) -> dict[str, int]:
    """Classifies and counts a stream of entries, and writes no entry.

    The counters of a micro-batch are a folder beside the progress: a repeated one overwrites its own, and a
    later start goes on from those before.
    """
    counters = f"{checkpoint}/counters"

    def each(batch: DataFrame, batch_id: int) -> None:
        counted = ch.metrics(ch.classify(batch, loop_tag), loop_tag is not None)
        counted.write.mode("overwrite").parquet(f"{counters}/batch_id={batch_id}")

    _run(entries, each, checkpoint)
    kept = read_or_empty(entries.sparkSession, counters, "metric string, n bigint")
    return {r["metric"]: r["n"] for r in kept.groupBy("metric").agg(F.sum("n").alias("n")).collect()}


# ---- two copies -------------------------------------------------------------

# A failed write: the log record as it was (bytes in base64), why and when it failed.
DEAD_LETTER = T.StructType(
    [
        T.StructField("failed_at", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch", T.LongType()),
        *[
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.BinaryType) else f.dataType)
            for f in LOG_SCHEMA.fields
        ],
    ]
)


def dead_letters(failed: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Failed writes (log columns and ``error``) as records of the failure log."""
    return failed.select(
        F.current_timestamp().cast("string").alias("failed_at"),
        F.col("error").alias("reason"),
        F.lit(batch_id).cast("bigint").alias("batch"),
        *[
            (F.base64(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name).cast(f.dataType))
            .alias(f.name)
            for f in LOG_SCHEMA.fields
        ],
    )


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """The failure log as a mutation log again."""
    return spark.read.schema(DEAD_LETTER).json(path).select(
        *[
            F.unbase64(f.name).alias(f.name) if isinstance(f.dataType, T.BinaryType) else F.col(f.name)
            for f in LOG_SCHEMA.fields
        ]
    )


def write_dead_letters(failed: DataFrame, path: str, batch_id: int) -> None:
    """The usual consumer of failed writes: a folder of records per micro-batch."""
    dead_letters(failed, batch_id).write.mode("overwrite").json(f"{path}/batch_id={batch_id}")


def dual_write(
    mutations: DataFrame,
    primary: Copy,
    secondary: Copy,
    letters: str | Callable[[DataFrame, int], None],
    checkpoint: str,
    refuses: Column,
    concurrent: bool = False,
    max_put_bytes: int = m.MAX_CELL_BYTES,
) -> None:
    """Writes a stream of mutations (log columns) to two copies.

    A mutation that no copy could take (``mutate.problem``) is refused before either write.  One after
    the other: the second copy gets what the first accepted, increments and appends as puts of
    their results.  Concurrent: both get the accepted mutations as they are, which only puts
    and deletes allow; a batch with other operations is written one after the other.
    ``refuses`` gives the second copy's reason to refuse a mutation, or NULL; those go
    to the failure log ``letters``: a folder, or what is called with them (log columns and
    ``error``) and the number of the micro-batch.
    """
    consume = letters if callable(letters) else partial(write_dead_letters, path=letters)
    results = [m.INCREMENT, m.APPEND]

    def each(batch: DataFrame, batch_id: int) -> None:
        judged = batch.withColumn("error", m.problem(max_put_bytes))
        good = judged.where("error IS NULL").drop("error")
        primary.append(good, batch_id)
        plain = good.where(~F.col("op").isin(*results))
        if concurrent and good.where(F.col("op").isin(*results)).isEmpty():
            offered = good
        else:
            offered = plain.unionByName(_images(primary, good, batch_id))
        second = offered.withColumn("error", refuses)
        failed = second.where("error IS NOT NULL")
        consume(failed, batch_id=batch_id)
        secondary.append(second.where("error IS NULL"), batch_id)

    _run(mutations, each, checkpoint)


def _images(primary: Copy, good: DataFrame, batch_id: int) -> DataFrame:
    """Results of a batch's increments and appends.

    They start from the state before the batch, also when the batch is repeated.  A row's
    state depends on that row alone, so no other is read back.
    """
    log = table_key(good)
    asked = m.only(log, m.INCREMENT, m.APPEND).select(*ROW).distinct()
    base = table_key(primary.read_all(before=batch_id, rows=asked))
    return split_key(m.after_images(base, log)).select(*good.columns)


# ---- counters ---------------------------------------------------------------


def count_stream(increments: DataFrame, path: str, checkpoint: str) -> None:
    """Running totals per column, kept in streaming state; one folder per micro-batch."""
    totals = increments.groupBy("table", *COLUMN).agg(
        F.sum("amount").alias("total"), F.max("seq").alias("seq")
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        totals.writeStream.outputMode("update")
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest total of every column."""
    kept = spark.read.parquet(path)
    return kept.groupBy("table", *COLUMN).agg(F.max_by("total", "batch_id").alias("total"))


# ---- newest versions --------------------------------------------------------


def _follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A row's live versions through one micro-batch; the newest ones of the columns it touched."""
    columns = pickle.loads(state.get[0]) if state.exists else {}
    # Rows are many and their events few: plain tuples cost a fraction of a frame's own steps.
    names = ["seq", "op", "family", "qualifier", "ts", "value"]
    events = [e for frame in frames for e in zip(*[frame[c].tolist() for c in names], strict=True)]
    events.sort(key=lambda e: (pd.isna(e[0]), e[0]))
    touched: dict[tuple, None] = {}
    for _, op, family, qualifier, ts, value in events:
        if op in (m.DELETE_ROW, m.DELETE_FAMILY):
            touched.update(dict.fromkeys(c for c in columns if op == m.DELETE_ROW or c[0] == family))
        else:
            touched[(family, qualifier)] = None
        amount = int.from_bytes(value, "big", signed=True) if op == m.INCREMENT else None
        act(columns, family, qualifier, op, ts, value, amount, m.MAX_CELL_BYTES)
    state.update((pickle.dumps({c: live for c, live in columns.items() if live.times}),))
    newest = [(c, columns[c].newest() if c in columns else (None, None)) for c in touched]
    yield pd.DataFrame(
        [(*key, *c, 0 if value is None else ts, value) for c, (ts, value) in newest],
        columns=["table", *COLUMN, "ts", "value"],
    )


def follow(mutations: DataFrame, path: str, checkpoint: str) -> None:
    """The newest version of every column, kept by a stream of mutations of all kinds.

    Live versions are streaming state, by row, so deletes reach all they cover and bring older versions
    back; a folder per micro-batch holds the columns it touched, with no value where none is left.
    Mutations that are refused, or increments and appends that fail, change nothing.
    Within a micro-batch seq orders a row's mutations; later micro-batches come after it.
    """
    good = mutations.where(m.problem().isNull())
    # Whole numbers with nulls would become doubles in pandas.
    value = F.when(F.col("op") == m.INCREMENT, long_to_bytes(F.col("amount"))).otherwise(F.col("value"))
    good = good.select(
        "table", *COLUMN, F.coalesce("ts", F.lit(LATEST)).alias("ts"), value.alias("value"), "seq", "op"
    )
    kinds = "table string, row binary, family string, qualifier binary, ts bigint, value binary"
    newest = good.groupBy("table", "row").applyInPandasWithState(
        _follow, kinds, "columns binary", "update", "NoTimeout"
    )

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (
        newest.writeStream.outputMode("update")
        .foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """Cells (with ``table``) that ``follow`` has left: the newest version of every column."""
    kinds = "table string, row binary, family string, qualifier binary, ts bigint, value binary, batch_id bigint"
    told = read_or_empty(spark, path, kinds)
    last = told.groupBy("table", *COLUMN).agg(F.max_by(F.struct("ts", "value"), "batch_id").alias("_new"))
    return last.select("table", *COLUMN, "_new.*").where(F.col("value").isNotNull())
