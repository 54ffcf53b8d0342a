from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from cellarium.llm import decontaminate as d
from cellarium.plans.skew import BROADCAST_ROWS_SETTING


def words(rng, n, vocabulary=3000):
    return [f"v{rng.randrange(vocabulary)}" for _ in range(n)]


def plain(docs, items):
    """Every document and item with a window that agrees in four fifths of its words."""
    import re

    def split(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    found = set()
    for doc_id, text in docs:
        t = split(text)
        for item_id, item in items:
            i = split(item)
            need = min(len(i), d.WINDOW)
            if len(i) < 5:
                continue
            for shift in range(-len(i), len(t)):
                same = [0 <= k + shift < len(t) and t[k + shift] == i[k] for k in range(len(i))]
                inside = [0 <= k + shift < len(t) for k in range(len(i))]
                for a in range(len(i) - need + 1):
                    if all(inside[a : a + need]) and sum(same[a : a + need]) >= 0.8 * need:
                        found.add((doc_id, item_id))
    return found


def test_masks_hit_every_window_with_three_substitutions():
    for gone in itertools.combinations(range(d.WINDOW), 3):
        assert any(
            all(at + k not in gone for k in d._offsets(mask))
            for mask in d.MASKS
            for at in range(d.WINDOW - len(mask) + 1)
        ), gone


@pytest.mark.parametrize("rows", [100_000, 50])
def test_planted_passages_are_found_and_clean_texts_left(make_docs, spark, rows):
    rng = random.Random(1)
    items = [(k, " ".join(words(rng, rng.randrange(15, 50)))) for k in range(12)]
    docs = [(k, " ".join(words(rng, rng.randrange(5, 300)))) for k in range(30)]
    for k, (_, item) in enumerate(items):
        own = item.split()
        for s in rng.sample(range(len(own)), k % 4):
            own[s] = f"new{s}"
        text = words(rng, 20) + own + words(rng, 20 * (k % 2))
        docs.append((100 + k, " ".join(text).upper() if k == 5 else ", ".join(text)))
    docs.append((200, " ".join(items[0][1].split()[:15])))
    docs.append((201, " ".join(items[1][1].split()[-12:])))
    spark.conf.set(BROADCAST_ROWS_SETTING, str(rows))
    try:
        bench = spark.createDataFrame([*items, (50, items[3][1])], "item_id bigint, text string")
        frame = make_docs([(k, t, "en", "a") for k, t in docs])
        found = {(r["doc_id"], r["item_id"]) for r in d.overlaps(frame, bench).collect()}
        left = {r["doc_id"] for r in d.clean(frame, bench).collect()}
    finally:
        spark.conf.unset(BROADCAST_ROWS_SETTING)
    want = plain(docs, items)
    assert found == want
    assert {(100 + k, k) for k in range(12)} <= want and (200, 0) in want
    assert left == {k for k, _ in docs} - {k for k, _ in want}


def test_short_items_nulls_and_empty_tables(make_docs, spark):
    bench = spark.createDataFrame(
        [(1, "one two three four"), (None, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f")],
        "item_id bigint, text string",
    )
    docs = make_docs([(1, "one two three four", "en", "a"), (None, "x a b c d e f", None, None), (2, None, "en", "a")])
    docs = docs.withColumn("item_id", F.lit("clash"))
    assert [(r["doc_id"], r["item_id"]) for r in d.overlaps(docs, bench).collect()] == [(None, 3)]
    kept = d.clean(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 2}
    assert d.overlaps(docs.limit(0), bench).count() == 0
    assert d.clean(docs, bench.limit(0)).count() == 3


def test_no_python_in_the_plan(make_docs, spark):
    bench = spark.createDataFrame([(1, " ".join("abcdefghijklmnopqrst"))], "item_id bigint, text string")
    plan = d.overlaps(make_docs(["a"]), bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_masks_hit_every_allowed_substitution_of_short_items():
    for size in range(5, d.WINDOW):
        masks = [d.MASKS[k] for k in d.SHORT.get(size, d.LONG)]
        for gone in itertools.combinations(range(size), size - -(-4 * size // 5)):
            assert any(
                all(at + k not in gone for k in d._offsets(mask))
                for mask in masks
                for at in range(size - len(mask) + 1)
            ), (size, gone)


def test_short_items_are_found_with_every_allowed_substitution(make_docs, spark):
    rng = random.Random(8)
    items = [(size, " ".join(words(rng, size, 10**6))) for size in range(5, d.WINDOW)]
    docs = []
    for size, item in items:
        for gone in itertools.combinations(range(size), size - -(-4 * size // 5)):
            own = [f"new{k}" if k in gone else w for k, w in enumerate(item.split())]
            docs.append((len(docs), " ".join([*words(rng, 9), *own, *words(rng, 9)])))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    frame = make_docs([(k, t, "en", "a") for k, t in docs])
    found = {(r["doc_id"], r["item_id"]) for r in d.overlaps(frame, bench).collect()}
    assert found == plain(docs, items) and len(found) == len(docs)


def test_a_clean_row_stays_beside_a_dirty_one_with_its_id(make_docs, spark):
    item = "a b c d e f g h i j k l m n o p"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    texts = [(None, f"x {item}"), (None, "clean"), (None, None), (3, item), (3, "clean too"), (3, None)]
    kept = d.clean(make_docs([(k, t, None, "a") for k, t in texts]), bench)
    found = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert found == [(0, ""), (0, "clean"), (3, ""), (3, "clean too")]
