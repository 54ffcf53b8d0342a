from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellarium.llm import ppm
from cellarium.llm.common import id_number


def plain_model(texts):
    """Context counts by dictionary; contexts are tuples of bytes back to the word's start."""
    trie = {}
    for text in texts:
        for symbol, context in symbols(text):
            for k in range(len(context) + 1):
                seen = trie.setdefault(context[len(context) - k :], {})
                seen[symbol] = seen.get(symbol, 0) + 1
    return trie


def symbols(text):
    for word in (text or "").encode().lower().split():
        raw = b" " + word + b" "
        for k in range(1, len(raw)):
            yield raw[k], raw[max(0, k - ppm.ORDER) : k]
    yield ppm.END, b" "


def plain_log10(trie, symbol, context):
    total, out = 0.0, set()
    for k in range(len(context), -1, -1):
        seen = trie.get(context[len(context) - k :])
        if not seen:
            continue
        here = {s: n for s, n in seen.items() if s not in out}
        if here:
            mass = sum(here.values())
            if symbol in here:
                return total + math.log10((here[symbol] - 0.5) / mass)
            total += math.log10(len(here) / 2 / mass)
        out |= set(seen)
    return total - math.log10(256 - len(out))


def corpus(rng):
    texts = [None, "", " \n", "\x01 odd\xff", "Ça É été", "a" * 300, "x " * 2000]
    for _ in range(80):
        parts = [rng.choice(["the", "then", "ther", "a", "An", "ing", "über", "x" * rng.randrange(1, 12)]) for _ in range(30)]
        texts.append(" ".join(rng.choice(parts) + rng.choice(["", "s", ",", str(rng.randrange(99))]) for _ in range(40)))
    return texts


@pytest.mark.parametrize("words", [250_000, 50])
def test_scores_match_a_plain_trie(make_docs, monkeypatch, words):
    monkeypatch.setattr(ppm, "CHUNK_WORDS", words)
    texts = corpus(random.Random(1))
    rows = [(k, t, "en", "a") for k, t in enumerate(texts)] + [(None, "the end", None, None)]
    docs = make_docs(rows).withColumn("score", F.lit("clash"))
    held = lambda k: zlib.crc32(str(k).encode() if k is not None else b"") % 10 == 0
    found = ppm.score(docs, id_number(F.col("doc_id")) % 10 == 0).collect()
    train = [t for k, t, _, _ in rows if not held(k)]
    trie = plain_model(train)
    count = {}
    for t in train:
        for w in [*(t or "").encode().lower().split(), None]:
            count[w] = count.get(w, 0) + 1
    tokens, kinds = sum(count.values()), len(count)
    assert len(found) == len(rows)
    text_of = {k: t for k, t, _, _ in rows}
    for r in found:
        text = text_of[r["doc_id"]]
        own = [*(text or "").encode().lower().split(), None]
        assert r["held_out"] == held(r["doc_id"])
        assert (r["n_tokens"], r["train_tokens"]) == (len(own), tokens)
        assert r["n_known"] == sum(w in count for w in own)
        base = sum(math.log10((count.get(w, 0) + 0.1) / (tokens + 0.1 * (kinds + 1))) for w in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        want = sum(plain_log10(trie, s, c) for s, c in symbols(text))
        assert r["score"] == pytest.approx(want, rel=1e-9)


def test_probabilities_of_a_context_sum_to_one():
    rng = random.Random(2)
    words = [bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 6))) for _ in range(200)] + [ppm.END_WORD] * 9
    codes, _ = ppm.codes_of(words)
    train, n = np.unique(codes, return_counts=True)
    pairs = np.bincount((codes & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)
    low = ppm.Low(pairs.reshape(256, 256))
    for context in (b" ", b" a", b"ab", b" abcab", b"zz"):
        high = int.from_bytes(context, "big") << 8
        asked = np.array([high | s for s in range(256)], np.uint64)
        every = np.unique(np.concatenate([train, asked]))
        counts = np.zeros(len(every), np.int64)
        counts[np.searchsorted(every, train)] = n
        # Contexts that end in other bytes play no part, as in the parts of the trie.
        mask = (every >> np.uint64(8)) & np.uint64(0xFFFF) == np.uint64((high >> 8) & 0xFFFF)
        value = ppm.log10_of(every[mask], counts[mask], low)
        got = value[np.searchsorted(every[mask], asked)]
        assert (10**got).sum() == pytest.approx(1.0)


def test_nothing_learned_and_empty_tables(make_docs):
    docs = make_docs(["abc d", None])
    rows = {r["doc_id"]: r for r in ppm.score(docs, F.lit(True)).collect()}
    assert rows[0]["train_tokens"] == 0 and rows[0]["n_known"] == 0
    assert rows[0]["score"] == pytest.approx(-7 * math.log10(256))
    assert ppm.score(docs.limit(0), F.lit(False)).count() == 0


def across_words(text):
    """Bytes of a text's stream with the ORDER bytes before them; zero bytes and a space come first."""
    words = [*(text or "").encode().lower().split(), bytes([ppm.END])]
    raw = bytes(ppm.ORDER - 1) + b" " + b" ".join(words)
    for k in range(ppm.ORDER, len(raw)):
        yield raw[k], raw[k - ppm.ORDER : k]


def test_contexts_reach_across_words(make_docs):
    texts = [*corpus(random.Random(3)), "the then ther", "ther the then", "then   the\n\nther", "\x00\x00 a"]
    docs = make_docs([(k, t, "en", "a") for k, t in enumerate(texts)])
    held = lambda k: k % 10 == 3 or k >= len(texts) - 4
    held_out = (F.col("doc_id") % 10 == 3) | (F.col("doc_id") >= len(texts) - 4)
    trie = {}
    for k, text in enumerate(texts):
        if not held(k):
            for symbol, context in across_words(text):
                for n in range(ppm.ORDER + 1):
                    seen = trie.setdefault(context[ppm.ORDER - n :], {})
                    seen[symbol] = seen.get(symbol, 0) + 1
    found = {r["doc_id"]: r["score"] for r in ppm.score(docs, held_out, across=True).collect()}
    assert len(found) == len(texts)
    for k, text in enumerate(texts):
        want = sum(plain_log10(trie, s, c) for s, c in across_words(text))
        assert found[k] == pytest.approx(want, rel=1e-9)
    assert len({found[k] for k in range(len(texts) - 4, len(texts) - 1)}) == 3


def test_pieces_of_chunks_match_one_pass(monkeypatch):
    words = [[*(t or "").encode().lower().split(), ppm.END_WORD] for t in corpus(random.Random(4))]
    listed = sorted({w for ws in words for w in ws})
    numbers = np.array([listed.index(w) for ws in words for w in ws], np.uint32)
    lengths = np.array([len(ws) for ws in words], np.int64)
    chunk = ppm.Chunk(ppm._zip(b" ".join(listed)), ppm._pack_planes(numbers), ppm._pack(lengths))
    held_out = np.arange(len(words)) % 3 == 0
    for across in (False, True):
        lines = [b" ".join(ws) for ws in words]
        codes, place = ppm.codes_of(lines, across)
        with monkeypatch.context() as patch:
            patch.setattr(ppm, "PIECE", 100)
            patch.setattr(ppm, "MERGED", 1000)
            cut = ppm.codes_of(lines, across)
            distinct, counts = chunk.codes(held_out, across)
        assert (cut[0] == codes).all() and (cut[1] == place).all()
        every, own = np.unique(codes.byteswap(), return_inverse=True)
        assert (distinct == every).all()
        assert (counts == np.bincount(own, weights=~held_out[place])).all()


def test_a_chunk_makes_its_codes_once_to_be_scored(monkeypatch):
    texts = [[*(t or "").encode().lower().split(), ppm.END_WORD] for t in corpus(random.Random(5))]
    listed = sorted({w for ws in texts for w in ws})
    numbers = np.array([listed.index(w) for ws in texts for w in ws], np.uint32)
    lengths = np.array([len(ws) for ws in texts], np.int64)
    held_out = np.arange(len(texts)) % 3 == 0
    row = {
        "chunk": "0-0", "words": ppm._zip(b" ".join(listed)), "numbers": ppm._pack_planes(numbers),
        "n_words": ppm._pack(lengths), "ids": list(range(len(texts))), "held_out": held_out.tolist(),
    }
    dealt = pd.DataFrame([row])
    lines = [b" ".join(ws) for ws in texts]
    codes, place = ppm.codes_of(lines, True)
    runs, counts = np.unique(codes[~held_out[place]] & np.uint64(0xFFFFFF), return_counts=True)
    price = ppm._price(ppm.Low.of(runs, counts))
    sent = pd.concat(ppm._contexts(3, True)(iter([dealt])))
    answers = [price(part) for _, part in sent.groupby("trie")]
    for _, part in pd.concat(ppm._words(2)(iter([dealt]))).groupby("bucket"):
        found = ppm._vocabulary(part).dropna(subset="chunk").rename(columns={"bucket": "part"})
        answers.append(found.assign(kind="counts")[["chunk", "kind", "part", "counts"]])
    made, plain = [], ppm.pieces

    def counted(*given):
        for found in plain(*given):
            made.append(len(found))
            yield found

    monkeypatch.setattr(ppm, "PIECE", 1000)
    monkeypatch.setattr(ppm, "pieces", counted)
    scored = ppm._scores(1000, 100, 2, 3, True)(dealt, pd.concat(answers))
    assert sum(made) == len(codes)
    trie = {}
    for ws, held in zip(texts, held_out, strict=True):
        for symbol, context in across_words(b" ".join(ws[:-1]).decode()) if not held else ():
            for n in range(ppm.ORDER + 1):
                seen = trie.setdefault(context[ppm.ORDER - n :], {})
                seen[symbol] = seen.get(symbol, 0) + 1
    for ws, score in zip(texts, scored["score"], strict=True):
        want = sum(plain_log10(trie, s, c) for s, c in across_words(b" ".join(ws[:-1]).decode()))
        assert score == pytest.approx(want, rel=1e-9)


def test_no_piece_is_empty(monkeypatch):
    monkeypatch.setattr(ppm, "PIECE", 3)
    assert [len(found) for found in ppm.pieces([b"a " + ppm.END_WORD], True)] == [3]
