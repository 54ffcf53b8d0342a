from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellarium.llm import token_store
from cellarium.llm.queries import tokenizer_path

TEXTS = [
    "The cat, the dog.", None, "", "  \n\t ", "Ça va? It's naïve, étude ſ İ ﬁ",
    "<|endoftext|> x<|ENDOFTEXT|>, a.,b 3.5 don't", "word " * 3000, "日本語 テキスト。 ok",
    "tab\x1cseparated\xa0nbsp em", "The cat, the dog.",
]


def expected(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def stored(docs, path):
    token_store.write_store(docs, path, tokenizer_path())
    rows = token_store.fetch(docs.select("doc_id"), path)
    return sorted(
        (tuple(r) for r in rows.select("doc_id", "start", "n_tokens", "ids_crc32").collect()),
        key=lambda r: r[1],
    )


def test_round_trip_in_order(make_docs, tmp_path):
    rows = [((7 * k) % 10 * 3, t, "en", "a") for k, t in enumerate(TEXTS)]
    found = stored(make_docs(rows), str(tmp_path / "s"))
    assert found == expected([r[:2] for r in rows])


def test_repeated_and_null_keys(make_docs, tmp_path):
    rows = [(5, "a b", None, None), (5, "a b", None, None), (None, "x", "en", "b"), (1, None, "en", "b")]
    docs = make_docs(rows).withColumn("key_hash", F.lit(1)).withColumn("shard", F.lit("x"))
    found = stored(docs, str(tmp_path / "s"))
    want = expected([r[:2] for r in rows])
    assert [r[0] for r in found] == [None, 1, 5, 5]
    assert [r[1:] for r in found] == [r[1:] for r in want]


def test_absent_keys_and_empty_store(make_docs, tmp_path, spark):
    docs = make_docs(["a", "b c"])
    path = str(tmp_path / "s")
    token_store.write_store(docs, path, tokenizer_path())
    asked = spark.range(0, 50).select(F.col("id").alias("doc_id"))
    assert {r["doc_id"] for r in token_store.lookup(asked, path).collect()} == {0, 1}
    empty = str(tmp_path / "e")
    token_store.write_store(docs.limit(0), empty, tokenizer_path())
    assert token_store.fetch(asked, empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 1000, 30_000])
def test_hash_is_minimal_and_perfect(n):
    hashes = np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64)
    levels, slots, late = token_store.build_bucket(hashes)
    assert sorted(slots.tolist()) == list(range(n))
    assert (token_store.find_slots(levels, late, hashes) == slots).all()


def test_keys_past_the_last_level_are_listed():
    hashes = np.repeat(np.array([5], np.uint64), 1)
    levels, slots, late = token_store.build_bucket(np.concatenate([hashes, hashes]))
    assert len(late) == 2 and sorted(slots.tolist()) == [0, 1]
    assert len(levels) == token_store.LEVELS


def test_words_agree_with_the_whole_tokenizer():
    known = token_store.WordIds(tokenizer_path())
    for text in TEXTS:
        ids = known.tokenizer.encode(text or "", add_special_tokens=False).ids
        packed = b"".join(known[w] for w in (text or "").encode().split())
        assert np.frombuffer(packed, "<u4").tolist() == ids


def test_any_latin_word_agrees_with_the_whole_tokenizer():
    known = token_store.WordIds(tokenizer_path())
    rng = random.Random(3)
    signs = [chr(c) for c in range(0x21, 0x250)] + ["'s", "'LL", "'re", "###", "abc", "Éa", "12", "İ", "\u0301", "<|", "日"]
    words = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 9))) for _ in range(20_000)]
    words += signs
    for word in words:
        # Some signs are white space to the tokenizer, or join with what comes before them.
        ids = known.tokenizer.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(b"".join(known[w] for w in word.encode().split()), "<u4").tolist() == ids, word


@pytest.mark.parametrize("remember", [True, False])
def test_a_task_gives_its_words_back_unless_they_are_to_stay(monkeypatch, remember):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(token_store, "TaskContext", Task)
    monkeypatch.setattr(token_store, "CACHED_WORDS", 2)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one two three four", None])], names=["k", "text"])
    (block,) = token_store.encoder(tokenizer_path(), remember)(iter([batch]))
    assert block["n_ids"].to_pylist()[0][1] == 1
    known = token_store.word_ids(tokenizer_path())
    assert bool(known or known.old) is remember
