"""Language identification from averaged hashed subword embeddings.

Subwords are the runs of two to four bytes inside a word, its ends marked, hashed to BUCKETS rows
of an embedding table.  A text is the average of its subwords' rows; a linear softmax over it gives
the languages.  Both are fitted by stochastic gradient descent in numpy on at most
``rows_per_language`` rows of each language, chosen by the smallest hash of their ids, then texts.  A fifth of them
is held back to calibrate: a temperature makes scores probabilities, and the least score at which
errors among accepted texts stay within ``error`` is the limit below which ``accepted`` is false.

At prediction table and softmax are one product, so a text costs one look-up per subword.  Whole
texts are read, in training too.  Text that is null or has no letter is ``und`` with score 0, as is
any text if no row has a language.  Null languages are not learned.  Repeated rows count each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellarium.llm.common import batches
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach, topmost

BUCKETS = 1 << 16
SIZES = (2, 3, 4)
UNKNOWN = "und"
# Bytes that can't be part of a word become spaces; UTF-8 beyond ASCII is left to be learned.
WORD_BYTES = bytes(c if chr(c).isalpha() or c >= 0x80 else 0x20 for c in range(256))


@dataclass(frozen=True)
class Fit:
    rows_per_language: int = 1500
    width: int = 16
    passes: int = 6
    batch: int = 32
    rate: float = 4.0
    error: float = 0.01
    seed: int = 7


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of the texts in turn, and how many each text has."""
    raw = [t.lower().encode("utf-8", "replace").translate(WORD_BYTES) for t in texts]
    buffer = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8).astype(np.uint32)
    ends = np.cumsum([len(r) + 1 for r in raw])  # a subword belongs where its first byte lies
    found, owners = [], []
    space = buffer == 0x20
    for size in SIZES:
        n = len(buffer) - size + 1
        if n <= 0:
            continue
        code = buffer[:n].copy()
        for k in range(1, size):
            code = (code << np.uint32(8)) | buffer[k : k + n]
        inner = np.zeros(n, dtype=bool)
        for k in range(1, size - 1):
            inner |= space[k : k + n]
        if size == 2:
            inner = space[:n] & space[1 : n + 1]
        at = np.flatnonzero(~inner)
        code = code[at]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D + 2 * size)
        code ^= code >> np.uint32(13)
        found.append(code & np.uint32(BUCKETS - 1))
        owners.append(np.searchsorted(ends, at, side="right"))
    if not found:
        return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
    owner = np.minimum(np.concatenate(owners), len(texts) - 1)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.bincount(owner, minlength=len(texts))


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # embedding rows times softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    limit: float = 0.0

    def logits(self, texts: list[str]) -> np.ndarray:
        out = np.tile(self.bias, (len(texts), 1)).astype(np.float64)
        buckets, counts = subwords(texts)
        starts = np.cumsum(counts) - counts
        full = np.flatnonzero(counts)
        for k in range(len(self.languages)):
            if len(full):
                sums = np.add.reduceat(self.table[k][buckets], starts[full], dtype=np.float64)
                out[full, k] += sums / counts[full]
        return out

    def probabilities(self, texts: list[str]) -> np.ndarray:
        return _softmax(self.logits(texts) / self.temperature)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sampled(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets with their share of the text, for rows to learn from."""
    for batch in batches(rows, 128):
        texts = [x.as_py() or "" for x in batch.column(0)]
        buckets, counts = subwords(texts)
        lists, shares = [], []
        for one in np.split(buckets, np.cumsum(counts)[:-1]):
            own, n = np.unique(one, return_counts=True)
            lists.append(own.astype(np.int32))
            shares.append((n / max(1, len(one))).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(lists, pa.list_(pa.int32())),
                pa.array(shares, pa.list_(pa.float32())),
                *batch.columns[1:],
            ],
            names=["buckets", "shares", "lang", "at", "also"],
        )


def _sample(rows: DataFrame, fit: Fit) -> tuple[DataFrame, list[str]]:
    """rows_per_language rows (text, lang, at, also) of each language, or all of fewer; the languages.

    Rows go by hash of the id, then of the text; where rows are equal in both, as many as are wanted.
    """
    at, also = F.xxhash64(F.lit(fit.seed), "doc_id").alias("at"), F.xxhash64("text").alias("also")
    marked = rows.select("text", "lang", at, also)
    first = topmost(marked.drop("text"), ["lang"], [F.col("at"), F.col("also")], fit.rows_per_language)
    counted = first.groupBy("lang", "at", "also").agg(F.count(F.lit(1)).alias("wanted"))
    ends = counted.groupBy("lang").agg(F.max(F.struct("at", "also", "wanted")).alias("end"))
    ends = settle(ends, "ends")
    own = F.struct("at", "also")
    end = F.struct("end.at", "end.also")
    inside = attach(marked, ends, ["lang"], "inner").where(own <= end)
    # Equal rows are added up before they are shuffled, however many they are.
    found = inside.groupBy("lang", "at", "also").agg(
        F.first("text").alias("text"), F.count(F.lit(1)).alias("n"), F.first("end").alias("end")
    )
    copies = F.when(own == end, F.col("end.wanted")).otherwise(F.col("n"))
    found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    return found.select("text", "lang", "at", "also"), sorted(r["lang"] for r in ends.select("lang").collect())


def learn(rows: DataFrame, fit: Fit = Fit()) -> Model:  # noqa: B008
    """Fits on rows with text and lang; the sample is rows_per_language rows of each language."""
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample, languages = _sample(rows, fit)
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    schema = "buckets array<int>, shares array<float>, lang string, at bigint, also bigint"
    return _fit(sample.mapInArrow(_sampled, schema).toArrow(), languages, fit)


def _fit(sample: pa.Table, languages: list[str], fit: Fit) -> Model:
    # The order of arrival must not matter: rows equal in both hashes are equal.
    sample = sample.take(np.lexsort((sample["also"].to_numpy(), sample["at"].to_numpy())))
    order = np.arange(sample.num_rows)
    number = {x: k for k, x in enumerate(languages)}
    label = np.array([number[x.as_py()] for x in sample["lang"]])
    buckets = [np.array(x.values) for x in sample["buckets"]]
    shares = [np.array(x.values, dtype=np.float32) for x in sample["shares"]]
    rng = np.random.default_rng(fit.seed)
    n, classes = len(label), len(languages)
    held = order[::5] if n >= 25 else order[:0]
    used = np.setdiff1d(order, held)
    embed = rng.normal(0, 0.1, (BUCKETS, fit.width)).astype(np.float32)
    weight = np.zeros((fit.width, classes), np.float32)
    bias = np.zeros(classes, np.float32)
    weight += rng.normal(0, 0.1, weight.shape).astype(np.float32)
    steps = max(1, fit.passes * -(-len(used) // fit.batch))
    step = 0
    for _ in range(fit.passes):
        for rows in np.array_split(rng.permutation(used), max(1, len(used) // fit.batch)):
            if not len(rows):
                continue
            rate = fit.rate * (1 - step / steps)
            step += 1
            sizes = [len(buckets[r]) for r in rows]
            ids = np.concatenate([buckets[r] for r in rows])
            part = np.concatenate([shares[r] for r in rows])[:, None]
            owner = np.repeat(np.arange(len(rows)), sizes)
            hidden = np.zeros((len(rows), fit.width), np.float32)
            np.add.at(hidden, owner, embed[ids] * part)
            miss = _softmax(hidden @ weight + bias).astype(np.float32)
            miss[np.arange(len(rows)), label[rows]] -= 1
            miss /= len(rows)
            back = miss @ weight.T
            weight -= rate * (hidden.T @ miss)
            bias -= rate * 0.1 * miss.sum(axis=0)
            # Rows of the table have small shares of a text, so they get a longer step.
            np.subtract.at(embed, ids, 20 * rate * part * back[owner])
    model = Model(languages, np.ascontiguousarray((embed @ weight).T), bias)
    return _calibrate(model, buckets, shares, label, held, fit)


def _calibrate(model: Model, buckets, shares, label, held, fit: Fit) -> Model:
    if not len(held):
        return model
    logits = np.array([(model.table[:, buckets[r]] * shares[r]).sum(axis=1) + model.bias for r in held])
    truth = label[held]
    rows = np.arange(len(held))

    def loss(temperature: float) -> float:
        return -np.log(_softmax(logits / temperature)[rows, truth] + 1e-12).mean()

    model.temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    chances = _softmax(logits / model.temperature)
    score, right = chances.max(axis=1), chances.argmax(axis=1) == truth
    order = np.argsort(-score)
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    fine = np.flatnonzero(wrong <= fit.error)
    model.limit = float(score[order[fine[-1]]]) if len(fine) else 1.0
    return model


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key``, lang_pred, score and accepted for every document; reads only key and text."""
    rows = docs.select(
        F.col(key).alias("_id"), F.col("text"), F.col("text").rlike("\\p{L}").alias("_letters")
    )
    kind = rows.schema["_id"].dataType.simpleString()

    def label(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(found, 256):
            texts = [x.as_py() or "" for x in batch.column(1)]
            letters = np.array([bool(x.as_py()) for x in batch.column(2)])
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if model.languages:
                chances = model.probabilities(texts)
                best = chances.argmax(axis=1)
                scores = np.where(letters, chances.max(axis=1), 0.0)
                names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
            taken = [bool(s >= model.limit and x != UNKNOWN) for s, x in zip(scores, names, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names), pa.array(scores, pa.float64()), pa.array(taken)],
                names=["_id", "lang_pred", "score", "accepted"],
            )

    out = rows.mapInArrow(label, f"_id {kind}, lang_pred string, score double, accepted boolean")
    return out.withColumnRenamed("_id", key)
