from __future__ import annotations

import random

from pyspark.sql import functions as F

from cellarium.llm import mixing
from cellarium.llm.mixing import Mix


def corpus(rng, sizes):
    rows, k = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((k, " ".join(f"w{k}x{j}" for j in range(rng.randrange(0, 200))), "en", source))
            k += 1
    return rows


def plain_targets(rows, mix):
    size = {}
    for _, text, _, source in rows:
        size[source] = size.get(source, 0) + len((text or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: mix.weights[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), mix.total * sum(size.values())
    while True:
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            return size, target | share
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
            free.discard(s)


def test_each_source_comes_near_its_target(make_docs):
    rows = corpus(random.Random(1), {"b": 40, "a": 300, None: 90, "é": 15, "z": 60})
    docs = make_docs(rows)
    mix = Mix(shard_rows=50)
    found = mixing.take(docs, mix).select("_doc.doc_id", "_doc.source", "size", "target", "taken", "source_size").collect()
    size, target = plain_targets(rows, mix)
    assert len(found) == len(rows)
    for source in size:
        own = [r for r in found if r["source"] == source]
        assert all(r["source_size"] == size[source] for r in own)
        assert all(abs(r["target"] - target[source]) < 1e-6 * target[source] + 1e-9 for r in own)
        shards = -(-len(own) // 50)
        assert abs(sum(r["taken"] for r in own) - target[source]) <= 2 * mix.block * shards
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    again = mixing.take(docs.repartition(3), mix).select("_doc.doc_id", "taken").collect()
    assert {tuple(r) for r in again} == {(r["doc_id"], r["taken"]) for r in found}


def test_documents_of_the_mix_hold_the_words_taken(make_docs):
    rows = corpus(random.Random(2), {"a": 60, "b": 60, "c": 8})
    docs = make_docs(rows).withColumn("size", F.lit("clash"))
    taken = {r["doc_id"]: r["taken"] for r in mixing.take(docs).select("_doc.doc_id", "taken").collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    seen, text = {}, dict((r[0], r[1]) for r in rows)
    for r in out.collect():
        words = r["text"].split()
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + len(words)
        assert r["n_chars"] == len(r["text"]) and r["size"] == "clash"
        own = text[r["doc_id"]].split()
        assert set(words) <= set(own) and len(set(words)) == len(words)
    assert seen == {k: n for k, n in taken.items() if n}


def test_quotas_are_highest_quotients(spark):
    rng = random.Random(3)
    for case in range(4):
        votes = [float(rng.randrange(0, 5000)) for _ in range(40)] if case < 3 else [640.0] * 7
        rows = [("k", k, v, "s") for k, v in enumerate(votes)]
        shards = spark.createDataFrame(rows, "_key string, shard int, votes double, _source string")
        mix = Mix(block=64 if case < 3 else 1000)
        got = {r["shard"]: r["quota"] for r in mixing.quotas(shards, mix).collect()}
        seats = round(sum(votes) / mix.block)
        best = sorted(((-v / (2 * n + 1), k) for k, v in enumerate(votes) for n in range(seats)))[:seats]
        assert sum(got.values()) == seats
        assert got == {k: sum(1 for _, s in best if s == k) for k in range(len(votes))}


def test_nulls_repeats_and_empty_tables(make_docs):
    rows = [(1, "a b c", "en", "x"), (1, "a b c", "en", "x"), (None, None, None, None), (2, "", "en", "y")]
    docs = make_docs(rows)
    found = mixing.take(docs, Mix(block=1)).collect()
    assert len(found) == 4 and sum(r["taken"] for r in found) == 9
    assert {r["target"] for r in found} == {0.0, 9.0}
    assert mixing.take(docs.limit(0)).count() == 0
    assert mixing.mixed(make_docs([(1, None, None, None)])).count() == 0


def test_small_sources_and_equal_rows_come_near_their_targets(make_docs):
    rows = [(k, "ten words " * 5, "en", f"s{k:02d}") for k in range(60)]
    rows += [(None, "same text here", "en", "big")] * 40 + [(7, None, "en", "big"), (8, "w " * 300, "en", "big")]
    found = mixing.take(make_docs(rows)).select("_doc.source", "size", "target", "taken").collect()
    size, target = plain_targets(rows, Mix())
    for source in size:
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - target[source]) <= max(1, 0.1 * target[source])
    assert all(r["taken"] <= 2 * r["size"] for r in found)


def test_seats_over_a_cap_go_to_the_next_quotients(spark):
    rows = [("k", k, v, c) for k, (v, c) in enumerate([(1000.0, 2), (300.0, 9), (200.0, 9)])]
    shards = spark.createDataFrame(rows, "_key string, shard int, votes double, cap bigint")
    got = {r["shard"]: r["quota"] for r in mixing.quotas(shards, Mix(block=150)).collect()}
    assert sum(got.values()) == 10 and got[0] == 2 and got[1] >= got[2]
