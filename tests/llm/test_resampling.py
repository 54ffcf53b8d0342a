from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cellarium.llm import resampling


def plain_features(text, most):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    runs = [b" ".join(words[k : k + n]) for n in range(1, most + 1) for k in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(run) % 50 for run in runs]


def plain(docs, target, most, least, percent, seed):
    met = [(doc_id, *plain_features(text, most)) for doc_id, text in docs]
    s = Counter(b for _, _, own in met for b in own)
    t = Counter(b for text in target for b in plain_features(text, most)[1])
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, n, own in met:
        weight = sum(
            math.floor(1000 * math.log(((t[b] + 1) * (S + 50)) / ((s[b] + 1) * (T + 50)))) for b in own
        )
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, n])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0], -r[2]))
    drawn = able[: len(able) * percent // 100]
    rank = {id(r): k for k, r in enumerate(drawn, 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=str)


TEXTS = [
    None, "", " \t--", "One", "one,two;one", "ONE two\nthree four", "é É one", "a\x00b\x1cc", "x1 X1 x2",
    "w " * 3000, "long" * 5000, *[f"word{k} two three one four {k % 3}" for k in range(40)],
]


@pytest.mark.parametrize("most", [1, 3])
def test_same_as_a_plain_version(spark, make_docs, most):
    docs = [(k if k != 20 else None, text, "en", "a") for k, text in enumerate(TEXTS)]
    docs += [docs[12], docs[12], (None, "two three", "en", "a")]  # repeated rows and a repeated null id
    target = ["one two three", None, "TWO-three"]
    bench = spark.createDataFrame([(k, x) for k, x in enumerate(target)], "item_id bigint, text string")
    found = resampling.resample(make_docs(docs), bench, most, 50, least=2, percent=30, seed=7).collect()
    wanted = plain([d[:2] for d in docs], target, most, 2, 30, 7)
    assert sorted(map(tuple, found), key=str) == wanted
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 1 + sum(r[4] is not None for r in wanted)))


def test_empty_tables_and_clashing_columns(spark, make_docs):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert resampling.resample(make_docs([]), bench).collect() == []
    docs = make_docs(["one two " * 20]).withColumns({c: F.lit("x") for c in ("rank", "bucket", "_place", "n_words")})
    rows = resampling.resample(docs, bench, percent=100).collect()
    assert [(r["doc_id"], r["n_features"], r["rank"]) for r in rows] == [(0, 40, 1)]


def test_many_equal_rows_are_ranked_in_many_tasks(spark, make_docs):
    docs = make_docs([(7, "one two three", "en", "a")] * 500)
    bench = spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    rows = resampling.resample(docs, bench, least=1, percent=50).collect()
    assert sorted(r["rank"] for r in rows if r["rank"] is not None) == list(range(1, 251))
