from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellarium.llm import substrings as s


def prose(rng, n):
    return "".join(rng.choice("abcdefgh é\n") for _ in range(n))


def plain(texts, keep):
    """Spans by looking at every window of every text, in order."""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for k, raw in enumerate(raws):
        for a in range(len(raw) - s.LEAST + 1):
            seen.setdefault(raw[a : a + s.LEAST], []).append((k, a))
    out = []
    for k, raw in enumerate(raws):
        gone = np.zeros(len(raw), bool)
        for a in range(len(raw) - s.LEAST + 1):
            at = seen[raw[a : a + s.LEAST]]
            if len(at) > 1 and (keep == "none" or at[0] != (k, a)):
                gone[a : a + s.LEAST] = True
        edge = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(int)))
        out.append((list(zip(edge[::2].tolist(), edge[1::2].tolist())), hashlib.sha256(raw[:0] + bytes(np.frombuffer(raw, np.uint8)[~gone])).hexdigest()))
    return out


def corpus(rng):
    shared = [prose(rng, n) for n in (395, 400, 430, 700, 1500)]
    texts = [None, "", "short", prose(rng, 399), "ab" * 500, "x" * 900, "xyz" * 300 + prose(rng, 100)]
    for k in range(40):
        parts = [prose(rng, rng.randrange(0, 300))]
        for _ in range(rng.randrange(0, 3)):
            piece = rng.choice(shared)
            if rng.random() < 0.4:
                at = rng.randrange(len(piece))
                piece = piece[:at] + "#" + piece[at + 1 :]
            parts += [piece, prose(rng, rng.randrange(0, 250))]
        texts.append("".join(parts))
    # A copy with every kind of change, a whole copy, and a text that holds another twice.
    return [*texts, texts[20], texts[21] + "!", shared[4] + "--" + shared[4], "é" * 450, "z" + "é" * 300]


@pytest.mark.parametrize("keep", ["first", "none"])
@pytest.mark.parametrize("hot", [2000, 1])
def test_spans_match_a_plain_version(make_docs, monkeypatch, keep, hot):
    monkeypatch.setattr(s, "HOT_CLASSES", hot)
    texts = corpus(random.Random(hot))
    docs = make_docs(texts).withColumn("seed", F.lit("clash"))
    rows = {r["doc_id"]: r for r in s.repeats(docs, keep).collect()}
    assert len(rows) == len(texts)
    for k, (spans, digest) in enumerate(plain(texts, keep)):
        got = [(x["start"], x["end"]) for x in rows[k]["spans"]]
        assert got == spans, k
        assert rows[k]["kept_sha256"] == digest and rows[k]["n_bytes"] == len((texts[k] or "").encode())


def test_runs_do_not_depend_on_the_piece(monkeypatch):
    raw = prose(random.Random(3), 5000).encode() + b"q" * 3000
    whole = s.runs(raw)
    monkeypatch.setattr(s, "PIECE", 700)
    s._powers.cache_clear()
    pieces = s.runs(raw)
    s._powers.cache_clear()
    for a, b in zip(whole, pieces, strict=True):
        assert (a == b).all()


def test_longest_previous_factors_of_a_plain_version():
    rng = np.random.default_rng(4)
    place = rng.permutation(500)
    kind = np.sort(rng.integers(0, 120, 500))
    want_first = np.array([any(place[j] < place[k] and kind[j] == kind[k] for j in range(500)) for k in range(500)])
    order = np.lexsort((place, kind))
    got = s.copied(place[order], kind[order])
    assert (got == want_first[order]).all()
    near = s.nearest_smaller(place)
    for k in range(500):
        smaller = [j for j in range(k) if place[j] < place[k]]
        assert near[k] == (smaller[-1] if smaller else -1)


def test_repeated_rows_null_ids_and_empty_tables(make_docs):
    text = prose(random.Random(5), 600)
    docs = make_docs([(1, text, "en", "a"), (1, text, "en", "a"), (None, text, None, None), (2, None, None, None)])
    gone = {"none": [0, 600, 600, 600], "first": [0, 0, 0, 600]}
    for keep, want in gone.items():
        found = [sum(x["end"] - x["start"] for x in r["spans"]) for r in s.repeats(docs, keep).collect()]
        size = len(text.encode())
        assert sorted(found) == [size if n else 0 for n in want]
    assert s.repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("keep", ["first", "none"])
def test_runs_of_hot_classes_match_a_plain_version(make_docs, monkeypatch, keep):
    monkeypatch.setattr(s, "HOT_ROWS", 2, raising=False)
    texts = corpus(random.Random(6))
    texts += [texts[20]] * 3
    rows = {r["doc_id"]: r for r in s.repeats(make_docs(texts), keep).collect()}
    assert len(rows) == len(texts)
    for k, (spans, digest) in enumerate(plain(texts, keep)):
        assert [(x["start"], x["end"]) for x in rows[k]["spans"]] == spans, k
        assert rows[k]["kept_sha256"] == digest


def test_runs_of_a_hot_class_do_not_meet_in_one_task(spark):
    place = F.struct(F.lit(False).alias("_none"), F.lit(0).cast("bigint").alias("_id"), F.lit(0).cast("bigint").alias("_text"), F.lit(0).alias("nth"))
    rows = spark.range(0, 6000, 1, 8).select(F.col("id").alias("_id"), F.col("id").alias("_text"), F.lit(0).alias("nth"))
    # One class of 5,900 runs, 50 of two.
    number = F.when(F.col("_id") < 5900, F.lit(0)).otherwise(F.floor(F.col("_id") / 2)).cast("bigint")
    shared = rows.withColumn("seed", number).withColumn("stretch", number)
    classes = shared.groupBy("seed", "stretch").agg(F.count(F.lit(1)).alias("n")).withColumn("place", place)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = s._copies(shared, classes, "none").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(r["count"] for r in parts) == 6000
    assert max(r["count"] for r in parts) < 2000
