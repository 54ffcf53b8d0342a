from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellarium.llm import quality

SPACE = " \t\n\x0b\x0c\r"


def counts(text):
    text = text or ""
    words = [w for w in re.split(f"[{SPACE}]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    windows = {}
    for k in range(len(words) - 2):
        windows.setdefault(tuple(words[k : k + 3]), []).append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


def prose(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary):04d}" for _ in range(n))


def test_counts_match_a_plain_version(make_docs):
    rng = random.Random(1)
    texts = [
        None, "", " \n ", "a", "a b", "a b c", "a b c a b c", "x x x x x", "a\n\na\n a\nb#|\n",
        "é\x85ü ßß x", prose(rng, 300, 5), prose(rng, 300, 20), "the end " * 400,
        "l1 a\nl2 b\nl1 a\n" * 30, prose(rng, 3000, 60),
    ]
    docs = make_docs(texts).withColumn("n_words", F.lit("clash"))
    rows = quality.judge(docs).select("_doc.doc_id", "_doc.text", *quality.STATS, "base_failed").collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = counts(r["text"])
        assert {k: r[k] for k in want} == want, r["text"]


def planted(rng):
    rows = [(k, prose(rng, rng.randrange(150, 250)), "en", "a" if k % 3 else "b") for k in range(400)]
    bad = [
        (1000, " ".join("$$$ &&& ###".split() * 20) + " " + prose(rng, 150), "en", "a"),
        (1001, prose(rng, 60) + "\n" + "same line here\n" * 12, "en", "b"),
        (1002, " ".join("x" * 90 for _ in range(60)) + prose(rng, 60), "en", "a"),
    ]
    return rows, bad


def test_outliers_go_and_clean_texts_stay(make_docs):
    rows, bad = planted(random.Random(2))
    found = quality.keep_good(make_docs(rows + bad + rows[:5]))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = [r["doc_id"] for r in found.collect()]
    assert sorted(kept) == sorted([r[0] for r in rows] + [r[0] for r in rows[:5]])


def test_estimates_match_a_plain_version(make_docs, spark):
    rows, bad = planted(random.Random(3))
    limits = quality.Limits()
    judged = quality.judge(make_docs(rows + bad), limits)
    got = {r["doc_id"]: r["distance"] for r in judged.select("_doc.doc_id", "distance").collect()}
    for source in "ab":
        part = [r for r in rows + bad if r[3] == source]
        stats = quality.statistics(make_docs(part)).select("_doc.doc_id", *quality._vector()).collect()
        z = np.array([list(r)[1:] for r in stats], float)
        want = plain_distance(z, limits)
        for r, d in zip(stats, want, strict=True):
            assert got[r["doc_id"]] == pytest.approx(d, rel=1e-6, abs=1e-9)


def plain_distance(z, limits):
    def middle(x):
        return np.sort(x, axis=0)[(len(x) + 1) // 2 - 1]

    centre = middle(z)
    spread = np.maximum(1.4826 * middle(np.abs(z - centre)), limits.floor)
    scatter = np.diag(spread**2)

    def far():
        off = z - centre
        return np.einsum("ij,jk,ik->i", off, np.linalg.inv(scatter), off)

    def bins():
        return np.floor(quality.BINS * np.log1p(far())).astype(int)

    def upto(share):
        b = bins()
        for x in np.unique(b):
            if (b <= x).sum() >= share * len(b):
                return b, x

    for _ in range(limits.steps):
        b, x = upto(limits.share)
        near = z[b <= x]
        centre, scatter = near.mean(axis=0), np.cov(near.T, bias=True) + np.eye(5) * limits.floor**2
    _, x = upto(0.5)
    return far() / max(1.0, np.expm1((x + 0.5) / quality.BINS) / quality.MEDIAN_CHI2)


def test_small_sources_nulls_and_empty_tables(make_docs):
    rng = random.Random(4)
    rows = [(k, prose(rng, 120), "fr", f"s{k % 20}") for k in range(60)]
    rows += [(100, prose(rng, 120), None, None), (None, prose(rng, 120), "de", "x"), (101, None, None, "x")]
    docs = make_docs(rows)
    judged = quality.judge(docs).select("_doc.doc_id", "kept", "distance").collect()
    kept = {r["doc_id"]: r["kept"] for r in judged}
    assert kept[101] is False and sum(kept.values()) == 62
    # Pooled by language; the lone ones have no estimate.
    assert all(r["distance"] is not None for r in judged if r["doc_id"] is not None and r["doc_id"] < 60)
    assert {r["doc_id"]: r["distance"] for r in judged}[100] is None
    assert quality.keep_good(docs.limit(0)).count() == 0
