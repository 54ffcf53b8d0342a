"""Small expressions the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words: space, and the controls 09 to 0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
SPACES_SQL = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def id_number(doc_id: Column) -> Column:
    """CRC-32 of the id as text; a null id counts as the empty text (0)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def batches(rows: Iterator, size: int) -> Iterator:
    """Arrow record batches cut so that none has more than ``size`` rows."""
    for batch in rows:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mixing step on an array of unsigned integers."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
