"""Token ids in binary blocks, found through a minimal perfect hash of the document keys.

Files of a store, all Parquet so that any path Spark can reach will do:

* ``payload``: shard, block, n_ids (length of each document), ids (the documents' ids as
  little-endian unsigned 32-bit integers, end id included, without gaps).  Documents lie in
  ascending key order over shards and blocks, null keys first.
* ``index``: a row per bucket of keys.  The hash is a cascade of bit arrays: a key belongs to the
  first level on which no other key of the bucket shares its bit, and its slot is the number of
  set bits before that one.  A slot holds the key's fingerprint and where its documents lie.

Keys are placed by a 64-bit hash.  A key with several documents (repeated rows) has one entry
for their contiguous run.  Null text is the empty text and has the end id only.  An empty table
gives a store without rows.  Keys not in the store are not found, but for a fingerprint that
agrees by chance (2**-32).
"""

from __future__ import annotations

import array
import codecs
import functools
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex as re
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellarium.llm.common import batches, mix

END_ID = 1
BLOCK_IDS = 1 << 18  # a block is closed once it has so many ids
BUCKET_KEYS = 20_000  # keys of an index bucket, on average
CACHED_WORDS = 300_000  # words of a generation whose ids a task remembers, some 60 MB
LEVELS = 24
SPREAD = 2.0  # bits of a level per key still without one

PAYLOAD = "shard int, block int, key_hashes array<bigint>, n_ids array<int>, ids binary"
INDEX = (
    "bucket bigint, buckets bigint, n_keys int, levels array<binary>, prints binary, "
    "places binary, late array<bigint>"
)
PLACE = ["first_doc", "n_docs", "start", "n_ids", "shard", "block", "at"]
FOUND = ", ".join(f"{c} bigint" for c in ["key_hash", "bucket", "slot", *PLACE])
DOCUMENTS = (
    "shard int, block int, nth bigint, key_hash bigint, at bigint, n_tokens bigint, "
    "ids_crc32 bigint"
)


# The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on.
PLAIN_BYTES = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b and b != 0xAD)]
OTHER_BYTES = [b for b in range(256) if b not in PLAIN_BYTES]
LETTERS = "".join(chr(b) if b in PLAIN_BYTES else chr(256 + OTHER_BYTES.index(b)) for b in range(256))
# Signs that end a piece of letters or a digit and are one piece; no apostrophe, which may begin an ending.
SIGNS = string.punctuation.replace("'", "")
# Characters that normalization leaves alone but for their case, one for one (the dotted capital I gives two).
LATIN = re.compile(r"[!-~\u00a1-\u012f\u0131-\u024f]+")
# How the tokenizer cuts a lower-cased word.
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


class WordIds(dict):
    """Packed ids by word.

    Words here are runs between ASCII white space.  The tokenizer drops white space before it
    looks at pieces, and no piece, normalization or merge reaches over it, so a text's ids
    are those of its words, one after the other.  Letter case is dropped, and a word of Latin characters
    is cut into pieces as the tokenizer cuts it (runs of letters, digits one by one, runs of other signs,
    short English endings), so such words are put together from known pieces; a piece goes to the
    tokenizer's model directly.  Any other word goes through all of the tokenizer.

    The words met lately are kept, in two generations: a full one becomes the old one.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            packed = self._encode(word)
        if len(self) >= CACHED_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = packed
        return packed

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def _encode(self, word: bytes) -> bytes:
        text = word.decode()
        latin = text.isprintable() if word.isascii() else LATIN.fullmatch(text)
        if not latin or b"<|" in word:
            return array.array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        lower = text.lower()
        if lower != text:
            return self[lower.encode()]
        if not text.isalpha():
            stem = text.rstrip(SIGNS)
            if stem and stem != text and stem[-1].isalnum():
                return self[stem.encode()] + self[text[len(stem) :].encode()]
            pieces = PIECES.findall(text)
            if len(pieces) > 1:
                return b"".join([self[piece.encode()] for piece in pieces])
        letters = text if word.isascii() else codecs.charmap_decode(word, "strict", LETTERS)[0]
        return array.array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()


@functools.lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def encoder(path: str, remember: bool = True):
    end = END_ID.to_bytes(4, "little")

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path)
        shard = TaskContext.get().partitionId()
        block, hashes, lengths, pieces, held = 0, [], [], [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([hashes], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([b"".join(pieces)], pa.binary()),
                ],
                names=["shard", "block", "key_hashes", "n_ids", "ids"],
            )

        for batch in batches(rows, 512):
            for key_hash, text in zip(*batch.columns, strict=True):
                ids = b"".join(map(known.__getitem__, (text.as_py() or "").encode().split())) + end
                hashes.append(key_hash.as_py())
                pieces.append(ids)
                lengths.append(len(ids) // 4)
                held += len(ids) // 4
                if held >= BLOCK_IDS:
                    yield closed()
                    block, hashes, lengths, pieces, held = block + 1, [], [], [], 0
        if lengths:
            yield closed()
        if not remember:
            known.forget()

    return encode


def _bits(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes, level + 1) % np.uint64(size)).astype(np.int64)


def _prints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes, 1000) >> np.uint64(32)).astype("<u4")


def build_bucket(hashes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Bit arrays by level, the slot of each key, and the keys left after the last level."""
    levels, slots, base = [], np.full(len(hashes), -1, dtype=np.int64), 0
    left = np.arange(len(hashes))
    for level in range(LEVELS):
        if not len(left):
            break
        size = max(8, -(-int(len(left) * SPREAD) // 8) * 8)
        at = _bits(hashes[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        own = alone[at]
        slots[left[own]] = base + (np.cumsum(alone) - 1)[at[own]]
        base += int(alone.sum())
        levels.append(alone)
        left = left[~own]
    order = left[np.argsort(hashes[left], kind="stable")]
    slots[order] = base + np.arange(len(order))
    return levels, slots, hashes[order]


def find_slots(levels: list[np.ndarray], late: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Slots of hashes, -1 where no level knows them."""
    slots, base = np.full(len(hashes), -1, dtype=np.int64), 0
    left = np.arange(len(hashes))
    for level, bits in enumerate(levels):
        at = _bits(hashes[left], level, len(bits))
        own = bits[at]
        slots[left[own]] = base + (np.cumsum(bits) - 1)[at[own]]
        base += int(bits.sum())
        left = left[~own]
    if len(late) and len(left):
        at = np.minimum(np.searchsorted(late, hashes[left]), len(late) - 1)
        same = late[at] == hashes[left]
        slots[left[same]] = base + at[same]
    return slots


def _build(entries: pd.DataFrame) -> pd.DataFrame:
    hashes = entries["key_hash"].to_numpy(np.int64).view(np.uint64)
    levels, slots, late = build_bucket(hashes)
    order = np.argsort(slots)
    return pd.DataFrame(
        {
            "bucket": [int(entries["bucket"].iloc[0])],
            "buckets": [int(entries["buckets"].iloc[0])],
            "n_keys": [len(entries)],
            "levels": [[np.packbits(x).tobytes() for x in levels]],
            "prints": [_prints(hashes[order]).tobytes()],
            "places": [entries[PLACE].to_numpy("<i8")[order].tobytes()],
            "late": [late.view(np.int64).tolist()],
        }
    )


def _find(asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    if not len(asked) or not len(index):
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ["key_hash", "bucket", "slot", *PLACE]})
    row = index.iloc[0]
    hashes = asked["key_hash"].to_numpy(np.int64).view(np.uint64)
    levels = [np.unpackbits(np.frombuffer(x, np.uint8)).astype(bool) for x in row["levels"]]
    slots = find_slots(levels, np.array(list(row["late"]), np.int64).view(np.uint64), hashes)
    prints = np.frombuffer(row["prints"], "<u4")
    found = slots >= 0
    found[found] = prints[slots[found]] == _prints(hashes[found])
    out = pd.DataFrame(
        np.frombuffer(row["places"], "<i8").reshape(-1, len(PLACE))[slots[found]], columns=PLACE
    )
    out.insert(0, "key_hash", hashes[found].view(np.int64))
    out.insert(1, "bucket", int(row["bucket"]))
    out.insert(2, "slot", slots[found])
    return out


def _digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for r in range(batch.num_rows):
            shard, block, hashes, n_ids, ids = (column[r] for column in batch.columns)
            n = np.array(n_ids.values, dtype=np.int64)
            at = np.concatenate([[0], np.cumsum(n)])
            raw = memoryview(ids.as_buffer())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), shard.as_py(), np.int32)),
                    pa.array(np.full(len(n), block.as_py(), np.int32)),
                    pa.array(np.arange(len(n), dtype=np.int64)),
                    hashes.values,
                    pa.array(at[:-1]),
                    pa.array(n),
                    pa.array(crc, pa.int64()),
                ],
                names=["shard", "block", "nth", "key_hash", "at", "n_tokens", "ids_crc32"],
            )


def write_store(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", remember: bool = True
) -> None:
    """Encodes ``text`` of all documents and writes payload and index under ``path``.

    Words met are remembered from task to task, unless other work is to have their memory.

    Rows are cut by range of (key, text hash), so one key's repeats spread over shards too;
    the text is shuffled once.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col("text"))
    cut = rows.repartitionByRange("_key", F.xxhash64("text")).sortWithinPartitions("_key", "text")
    hashed = cut.select(F.xxhash64("_key").alias("key_hash"), "text")
    hashed.mapInArrow(encoder(tokenizer, remember), PAYLOAD).write.parquet(f"{path}/payload")
    _write_index(docs.sparkSession, path)


def _bases(blocks: DataFrame) -> DataFrame:
    """First document and first id of each block, by running sums over shards, then in them."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def running(name: str, window) -> Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    shards = blocks.groupBy("shard").agg(F.sum("docs").alias("d"), F.sum("ids").alias("i"))
    shards = shards.select("shard", running("d", before).alias("d0"), running("i", before).alias("i0"))
    local = blocks.select(
        "shard", "block", running("docs", inside).alias("d1"), running("ids", inside).alias("i1")
    )
    return local.join(shards, "shard").select(
        "shard", "block", (F.col("d0") + F.col("d1")).alias("doc0"),
        (F.col("i0") + F.col("i1")).alias("id0"),
    )


def _directory(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The payload, and the first document and id of each of its blocks."""
    payload = spark.read.schema(PAYLOAD).parquet(f"{path}/payload")
    zero = F.lit(0).cast("bigint")
    blocks = payload.select(
        "shard", "block", F.size("n_ids").cast("bigint").alias("docs"),
        F.aggregate("n_ids", zero, lambda total, n: total + n).alias("ids"),
    )
    return payload, _bases(blocks)


def _write_index(spark: SparkSession, path: str) -> None:
    payload, bases = _directory(spark, path)
    each = payload.join(bases, ["shard", "block"]).select(
        "shard", "block", "doc0", "id0", F.posexplode(F.arrays_zip("key_hashes", "n_ids"))
    )
    inside = Window.partitionBy("shard", "block").orderBy("pos")
    n = F.col("col.n_ids").cast("bigint")
    each = each.withColumn("at", F.sum(n).over(inside) - n)
    doc_no = F.col("doc0") + F.col("pos")
    docs = bases.sparkSession.read.schema(PAYLOAD).parquet(f"{path}/payload")
    n_docs = docs.agg(F.sum(F.size("n_ids"))).scalar()
    buckets = F.greatest(F.ceil(F.coalesce(n_docs, F.lit(0)) / BUCKET_KEYS), F.lit(1))
    entries = each.groupBy(F.col("col.key_hashes").alias("key_hash")).agg(
        F.min(doc_no).alias("first_doc"),
        F.count(F.lit(1)).alias("n_docs"),
        F.min(F.col("id0") + F.col("at")).alias("start"),
        F.sum(n).alias("n_ids"),
        *[F.min_by(c, doc_no).cast("bigint").alias(c) for c in ("shard", "block", "at")],
    )
    entries = entries.withColumn("buckets", buckets.cast("bigint"))
    entries = entries.withColumn("bucket", F.pmod("key_hash", "buckets"))
    entries.groupBy("bucket").applyInPandas(_build, INDEX).write.parquet(f"{path}/index")


def lookup(keys: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """The asked keys that the store has, each once, with bucket, slot and place."""
    spark = keys.sparkSession
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    buckets = index.select(F.max("buckets")).first()[0] or 1
    asked = keys.select(F.col(key)).distinct().withColumn("key_hash", F.xxhash64(key))
    hashes = asked.select("key_hash", F.pmod("key_hash", F.lit(buckets)).alias("bucket"))
    found = hashes.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(_find, FOUND)
    return asked.join(found, "key_hash").drop("key_hash")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Every stored document: doc_no, start, shard, block, at, n_tokens, ids_crc32."""
    payload, bases = _directory(spark, path)
    return payload.mapInArrow(_digests, DOCUMENTS).join(bases, ["shard", "block"]).select(
        (F.col("doc0") + F.col("nth")).alias("doc_no"),
        (F.col("id0") + F.col("at")).alias("start"),
        "shard", "block", "at", "n_tokens", "ids_crc32",
    )


def fetch(keys: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """All documents of the asked keys, found by the index, with what their payload holds."""
    found = lookup(keys, path, key)
    last = F.col("first_doc") + F.col("n_docs") - 1
    wanted = found.select(key, "bucket", "slot", F.explode(F.sequence("first_doc", last)).alias("doc_no"))
    return wanted.join(read_documents(keys.sparkSession, path), "doc_no")
