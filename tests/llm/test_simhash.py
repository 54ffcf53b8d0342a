from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cellarium.llm import simhash
from cellarium.llm.graph import components


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(k) for k in range(len(prints))]


def flipped(rng, value, most):
    for _ in range(rng.randrange(most + 1)):
        value ^= 1 << rng.randrange(64)
    return value


def test_fingerprints_match_a_plain_version(make_docs):
    texts = [None, "", " \t", "One", "one TWO", "a b c", "a b c a b c d", "É é X", "x\x0by z\x1cw", "w " * 500]
    rows = simhash.classes(make_docs(texts)).collect()
    assert {r["doc_id"]: r["fp"] % 2**64 for r in rows} == dict(enumerate(map(plain_fingerprint, texts)))
    assert {r["component_id"] for r in rows if not (texts[r["doc_id"]] or "").split()} == {0}


@pytest.mark.parametrize("hot", [20_000, 3])
def test_links_join_the_same_components_as_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_BLOCK", hot)
    rng = random.Random(hot)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for centre in list(prints)[:8]:
        chain = centre
        for _ in range(25):
            chain = flipped(rng, chain, 3)
            prints |= {chain, flipped(rng, centre, 3)}
    prints = sorted(prints | {0, 3, 1 << 63})
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint"))
    found = {r["node"] % 2**64: r["root"] for r in components(edges).collect()}
    want = plain_components(prints)
    label = [found.get(p, p if p < 2**63 else p - 2**64) for p in prints]
    assert len(set(zip(label, want, strict=True))) == len(set(label)) == len(set(want))


def test_dense_and_sparse_blocks_match_all_pairs():
    rng = random.Random(5)
    for spread, size in ((3, 400), (8, 700), (32, 900)):
        base = rng.getrandbits(32)
        block = {base ^ sum(1 << rng.randrange(spread) for _ in range(rng.randrange(6))) for _ in range(size)}
        block = np.array(sorted(block), np.uint64)
        block = block[np.argsort(simhash.gray_rank(block))]
        root = simhash.link_block(block)
        want = plain_components([int(x) for x in block])
        assert len(set(zip(root.tolist(), want, strict=True))) == len(set(want)) == len(set(root.tolist()))


def test_gray_rank_inverts_the_gray_code():
    n = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(200, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_group_stays(make_docs):
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(900)}" for _ in range(2000))
    near = long + " tail"
    rows = [(9, long, "en", "a"), (4, near, "en", "b"), (4, near, "en", "b"), (7, "quite another text", "en", "a")]
    rows += [(None, long, None, None), (8, None, "en", "a"), (6, "", "en", "a")]
    docs = make_docs(rows).withColumn("fp", F.lit("clash"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 6, 7]
    assert simhash.keep_one(docs.limit(0)).count() == 0
    assert simhash.classes(docs.limit(0)).count() == 0
