from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cellarium.llm import near_copies, simhash


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def plain_classes(texts):
    """The smallest place of each text's class, by comparing all pairs."""
    sets = [plain_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            both, every = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if 5 * both >= 4 * every and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(k) for k in range(len(sets))]


def changed(rng, text, share):
    words = text.split()
    for k in rng.sample(range(len(words)), max(1, int(share * len(words)))):
        words[k] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def texts_of(seed):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(n)) for n in (4, 30, 80, 200, 500, 900)]
    texts = [None, "", "one", "One", *base]
    for text in base[1:]:
        texts += [changed(rng, text, s) for s in (0.002, 0.005, 0.01, 0.02, 0.02, 0.05, 0.1)]
        # A chain: its ends need not be alike.
        step = text
        for _ in range(6):
            step = changed(rng, step, 0.02)
            texts.append(step)
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_match_all_pairs(spark, seed):
    texts = texts_of(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "place bigint, text string")
    found = {r["place"]: r["component_id"] for r in near_copies.classes(docs).collect()}
    assert [found[k] for k in range(len(texts))] == plain_classes(texts)


@pytest.mark.parametrize("block", [150_000, 700])
def test_pairs_missed_by_the_first_of_a_bucket_are_compared(spark, monkeypatch, block):
    """All texts share every bucket; only neighbours in pairs link, and never with the first."""
    texts = ["a b c d e"]
    for k in range(12):
        own = " ".join(f"t{k}x{i}" for i in range(60))
        texts += [own, own + " tail"]
    rng = random.Random(3)
    rng.shuffle(texts)
    monkeypatch.setattr(near_copies, "BLOCK", block)
    monkeypatch.setattr(near_copies, "COLUMNS", 64)
    docs = spark.createDataFrame(list(enumerate(texts)), "place bigint, text string").repartition(3)
    each = docs.select("place", F.lit(57).cast("bigint").alias("n"), F.array(F.lit(7).cast("bigint")).alias("bands"))
    edges = {(min(r["a"], r["b"]), max(r["a"], r["b"])) for e in near_copies.links(each, docs) for r in e.collect()}
    pairs = {(a, b) for a in range(25) for b in range(a + 1, 25)}
    assert edges == {(a, b) for a, b in pairs if texts[a].split()[0] == texts[b].split()[0]}


def test_near_copies_beyond_two_bits_go(make_docs):
    texts = texts_of(4)
    apart = [simhash.fingerprint(t) for t in texts]
    want = plain_classes(texts)
    assert any(bin(apart[k] ^ apart[w]).count("1") > 2 for k, w in enumerate(want))
    kept = sorted(r["doc_id"] for r in simhash.keep_one(make_docs(texts)).collect())
    assert kept == sorted(set(want))


def test_fingerprints_of_the_index_are_candidates_without_any_common_band(spark):
    own = " ".join(f"w{k}" for k in range(5000))
    texts = [own, own + " tail", " ".join(f"v{k}" for k in range(5000)), own + " end"]
    sets = [near_copies.shingles(t) for t in texts]
    prints = [near_copies.simhash_of(s) for s in sets]
    assert all(bin((prints[0] ^ prints[k]) % 2**64).count("1") <= 2 for k in (1, 3))
    rows = [(k, len(s), prints[k], [k], texts[k]) for k, s in enumerate(sets)]
    docs = spark.createDataFrame(rows, "place bigint, n bigint, fp bigint, bands array<bigint>, text string")
    found = near_copies.links(docs.drop("text"), docs, simhash.links)
    ends = {end for edges in found for r in edges.collect() for end in (r["a"], r["b"])}
    assert ends == {0, 1, 3}
