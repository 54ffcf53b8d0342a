"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ORDER long, counted over the byte streams of all training
texts.  A byte is coded in the longest context that was seen; a byte that is new there costs an escape to the
next shorter context, where the bytes already ruled out are left out of the counts; last come all bytes
not seen anywhere, evenly.  Of every kind of byte half a count goes to the escape (method D).

The stream of a text is its words, each closed by one space whatever white space follows it, then an
end byte; before it are zero bytes and a space.  With ``across`` a context is the ORDER bytes before,
whatever words they are of, so the order of words counts.  Without, it reaches back to the
start of its word.

1. Every task deals its texts into chunks: a dictionary, the texts as word numbers, and the counts of
   three-byte runs.  Only these are written.
2. Dictionaries are merged by word hash, for the training counts of the base score.
3. A chunk's contexts with the byte that follows, each once with its training count, are sent to the part of
   the trie that has all contexts ending in the same three bytes.  Shorter contexts are the table
   of the runs that occur.
4. Counts and log probabilities go back to the chunks, in the order in which the chunk sent what was asked,
   and every byte of every text is looked up.

All of them travel as packed arrays.  No part of the trie or vocabulary is held whole anywhere.

Null text is empty and has its end only; so has a text of white space.  Null ids count as the empty
text where ids are hashed.  Repeated rows are learned and scored as often as they occur.  With
nothing to learn from, all bytes are equally likely.  An empty table gives an empty one.
"""

from __future__ import annotations

import ctypes
import itertools
import sys
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellarium.llm.common import batches, mix
from cellarium.plans.scratch import settle

ORDER = 7  # with the byte that follows, a context is one 64-bit number
CHUNK_WORDS = 500_000  # distinct words at which a chunk is closed
CHUNK_BYTES = 12_000_000
PIECE = 1 << 20  # bytes whose contexts are made at once
MERGED = 1 << 21  # codes that are sorted at once
PART_BYTES = 32 << 20  # of text, for each part of the trie
SPACE, END = 0x20, 0xFF  # closes a word; closes a text (not a byte of UTF-8)
END_WORD = bytes([END])

# Words, numbers of the words of all texts, lengths of the texts in words, runs of three training bytes.
CHUNKS = (
    "chunk string, words binary, numbers binary, n_words binary, runs binary, run_counts binary, "
    "ids array<string>, held_out array<boolean>"
)
U64 = np.uint64
# Of a code, what is known after so many bytes from the start, which itself comes after a space.
KNOWN = np.array([(1 << (8 * min(k + 2, ORDER + 1))) - 1 for k in range(ORDER)], U64)


def _zip(raw: bytes) -> bytes:
    import zstandard

    # A copy, as the compressor's own result keeps the room of the whole input.
    return bytes(memoryview(zstandard.ZstdCompressor(level=1).compress(raw)))


def _unzip(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(raw)


def _give_back() -> None:
    """Returns freed memory to the system: Python workers outlive their tasks, two of them beside one JVM."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def _pack(array: np.ndarray) -> bytes:
    return _zip(np.ascontiguousarray(array).tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(_unzip(raw), dtype=kind)


def _pack_planes(array: np.ndarray) -> bytes:
    """First bytes together, then second bytes: most of the high ones are equal."""
    return _pack(array.view(np.uint8).reshape(-1, array.itemsize).T)


def _unpack_planes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(_unpack(raw, np.uint8).reshape(size, -1).T).reshape(-1).view(kind)


def dealer(across: bool):
    """Chunks of texts, see ``CHUNKS``."""
    schema = pa.schema(
        [
            ("chunk", pa.string()), ("words", pa.binary()), ("numbers", pa.binary()),
            ("n_words", pa.binary()), ("runs", pa.binary()), ("run_counts", pa.binary()),
            ("ids", pa.list_(pa.string())), ("held_out", pa.list_(pa.bool_())),
        ]
    )

    def deal(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back()
        task = TaskContext.get().partitionId()

        def fresh() -> tuple:
            known = defaultdict(itertools.count().__next__)
            known[END_WORD]
            return known, [], [], [], [], 0

        def closed() -> pa.RecordBatch:
            runs, counts = np.zeros(0, U64), np.zeros(0, np.int64)
            for codes in pieces(train, across):
                more, their = np.unique((codes & U64(0xFFFFFF)).astype(np.uint32), return_counts=True)
                runs, counts = _summed(runs, counts, more.astype(U64), their)
            row = {
                "chunk": f"{task}-{nth}", "words": _zip(b" ".join(known)),
                "numbers": _pack_planes(np.concatenate(texts)),
                "n_words": _pack(np.array([len(t) for t in texts], np.int64)),
                "runs": _pack(runs), "run_counts": _pack(counts), "ids": ids, "held_out": held_out,
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        (known, texts, ids, held_out, train, size), nth = fresh(), 0
        for batch in batches(given, 256):
            for key, text, held in zip(*batch.columns, strict=True):
                words = (text.as_py() or "").encode().lower().split()
                words.append(END_WORD)
                texts.append(np.fromiter(map(known.__getitem__, words), np.uint32, len(words)))
                ids.append(key.as_py())
                held_out.append(held.as_py())
                line = b" ".join(words)
                size += len(line)
                if not held_out[-1]:
                    train.append(line)
                if len(known) >= CHUNK_WORDS or size >= CHUNK_BYTES:
                    yield closed()
                    (known, texts, ids, held_out, train, size), nth = fresh(), nth + 1
        if texts:
            yield closed()

    return deal


def _summed(keys, counts, more, their) -> tuple[np.ndarray, np.ndarray]:
    """Two lists of distinct ascending keys as one, with their counts; takes the first ``counts`` over."""
    place = np.searchsorted(keys, more)
    has = place < len(keys)
    has[has] = keys[place[has]] == more[has]
    counts[place[has]] += their[has]
    new = place[~has] + np.arange(len(more) - np.count_nonzero(has))
    old = np.ones(len(keys) + len(new), bool)
    old[new] = False
    every, sums = np.empty(len(old), keys.dtype), np.empty(len(old), counts.dtype)
    every[new], sums[new] = more[~has], their[~has]
    every[old], sums[old] = keys, counts
    return every, sums


class Chunk:
    """A chunk's words and texts, as they were dealt."""

    def __init__(self, words: bytes, numbers: bytes, n_words: bytes):
        self.words = np.array(_unzip(words).split(b" "), object)
        self.numbers = _unpack_planes(numbers, np.uint32)
        self.n_words = _unpack(n_words, np.int64)
        self.ends = np.cumsum(self.n_words)

    def texts(self) -> list[np.ndarray]:
        return np.split(self.numbers, self.ends[:-1])

    def lines(self, wanted: np.ndarray) -> Iterator[list[bytes]]:
        """The streams of the texts wanted, some at a time."""
        found, size = [], 0
        for text, want in zip(self.texts(), wanted, strict=True):
            if want:
                found.append(b" ".join(self.words[text].tolist()))
                size += len(found[-1])
            if size >= PIECE:
                yield found
                found, size = [], 0
        yield found

    def codes(self, held_out: np.ndarray, across: bool) -> tuple[np.ndarray, np.ndarray]:
        """All distinct codes with their training counts, ascending by their bytes from the last one back."""
        codes, counts = np.zeros(0, U64), np.zeros(0, np.uint32)
        for wanted in (~held_out, held_out):
            waiting, size = [], 0
            for found in itertools.chain((c for x in self.lines(wanted) for c in pieces(x, across)), [None]):
                if found is not None:
                    waiting.append(found.byteswap())
                    size += len(found)
                if waiting and (found is None or size >= MERGED):
                    every = np.concatenate(waiting)
                    waiting, size, total = [], 0, size
                    every.sort()
                    every, first = _distinct(every)
                    n = np.diff(first, append=total).astype(np.uint32) * np.uint32(wanted is not held_out)
                    codes, counts = _summed(codes, counts, every, n)
        return codes, counts

    def uses(self, across: bool) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """All distinct codes as ``codes`` gives them, and of each piece its own, in bits where each one's uses begin, and their texts."""
        used, first, kind = [], 0, np.min_scalar_type(len(self.n_words))
        for lines in self.lines(np.ones(len(self.n_words), bool)):
            for asked in pieces(lines, across):
                place = _place(asked, first)
                first = int(place[-1] + (asked[-1] & U64(0xFF) == END))
                asked.byteswap(inplace=True)
                order = np.argsort(asked)
                own, begin = _distinct(asked[order])
                starts = np.zeros(len(asked), bool)
                starts[begin] = True
                used.append((own, np.packbits(starts), place.astype(kind)[order]))
        codes = np.concatenate([own for own, _, _ in used])
        codes.sort()
        return codes[np.append(True, codes[1:] != codes[:-1])], used

    def buckets(self, buckets: int) -> np.ndarray:
        """The vocabulary bucket of each word."""
        return np.fromiter(map(zlib.crc32, self.words), np.int64, len(self.words)) % buckets


def _groups(to: np.ndarray) -> list[np.ndarray]:
    """Places by the part they go to, ascending."""
    order = np.argsort(to.astype(np.min_scalar_type(to.max(initial=0))), kind="stable")  # 16 bits are sorted by digits
    return np.split(order, np.flatnonzero(np.diff(to[order])) + 1)


def _trie_of(codes: np.ndarray, tries: int) -> np.ndarray:
    """The part of the trie, by the last three bytes of context; ``codes`` as ``Chunk.codes`` gives them."""
    return (mix((codes >> U64(32)) & U64(0xFFFFFF), 3) % U64(tries)).astype(np.int64)


def _rows_of(part: pd.DataFrame) -> Iterator[tuple[str, np.ndarray, Chunk]]:
    for row in part.itertuples():
        yield row.chunk, np.array(row.held_out, bool), Chunk(row.words, row.numbers, row.n_words)


def _words(buckets: int):
    """The words of the chunks with their training counts, by vocabulary bucket."""

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, held_out, chunk in _rows_of(part):
                train = chunk.numbers[np.repeat(~held_out, chunk.n_words)]
                counts = np.bincount(train, minlength=len(chunk.words))
                to = chunk.buckets(buckets)
                groups = _groups(to)
                yield pd.DataFrame(
                    {
                        "chunk": name,
                        "bucket": [int(to[g[0]]) for g in groups],
                        "words": [_zip(b" ".join(chunk.words[g].tolist())) for g in groups],
                        "counts": [_pack(counts[g]) for g in groups],
                    }
                )

    return split


def _vocabulary(parts: pd.DataFrame) -> pd.DataFrame:
    """Training counts of one bucket's words, for each chunk in its own order; a row with their sums."""
    total: dict[bytes, int] = defaultdict(int)
    for words, counts in zip(parts["words"], parts["counts"], strict=True):
        for word, n in zip(_unzip(words).split(b" "), _unpack(counts, np.int64).tolist(), strict=True):
            total[word] += n
    found = [
        _pack_planes(np.array([total[w] for w in _unzip(words).split(b" ")], np.int64)) for words in parts["words"]
    ]
    counts = np.array(list(total.values()), np.int64)
    return pd.DataFrame(
        {
            "chunk": [*parts["chunk"], None],
            "bucket": [*parts["bucket"], int(parts["bucket"].iloc[0])],
            "counts": [*found, None],
            "tokens": int(counts.sum()),
            "kinds": int((counts > 0).sum()),
        }
    )


def pieces(words: list[bytes], across: bool) -> Iterator[np.ndarray]:
    """Every byte of the words with the ORDER bytes before it, as one number.

    ``words`` may be whole streams of texts.  Each is followed by a space, which is coded but after an end,
    where the next text starts.  Before the start of a text, or of a word if contexts are not to reach
    ``across`` words, there is one space and then nothing (zero bytes).
    """
    if not words:
        return
    stream = bytes(ORDER - 1) + b" " + b" ".join(words) + b" "
    raw = np.frombuffer(stream, np.uint8, offset=ORDER - 1)
    starts = np.append(1, np.flatnonzero(raw == END) + 2) if across else np.flatnonzero(raw == SPACE) + 1
    for at in range(1, len(raw), PIECE):
        until = min(at + PIECE, len(raw))
        # The eight bytes up to each one, read as they lie.
        codes = np.ndarray(until - at, ">u8", stream, at - 1, (1,)).astype(U64)
        for k in range(ORDER - 1):
            # Where the next start comes sooner, its own bytes are masked to fewer.
            first, last = np.searchsorted(starts, [at - k, until - k])
            codes[starts[first:last] + k - at] &= KNOWN[k]
        codes = codes[raw[at - 1 : until - 1] != END]
        if len(codes):  # a piece may be the space after an end alone
            yield codes


def _place(codes: np.ndarray, first: int) -> np.ndarray:
    """The place of each code's text, of which ``first`` is the first one's."""
    ends = codes & U64(0xFF) == END
    return first + np.cumsum(ends) - ends


def codes_of(words: list[bytes], across: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All that ``pieces`` gives, and the place of the text."""
    codes = np.concatenate(list(pieces(words, across)))
    return codes, _place(codes, 0)


def _mask(order: int) -> np.uint64:
    return U64((1 << (8 * (order + 1))) - 1)


class Low:
    """Counts of bytes after one byte, and after none; after two bytes if their runs are given."""

    def __init__(self, pairs: np.ndarray, triples: tuple[np.ndarray, np.ndarray] | None = None):
        self.pairs = pairs  # 256 x 256
        self.single = pairs.sum(axis=0)
        self.triples = triples  # ascending, with counts

    @classmethod
    def of(cls, triples: np.ndarray, counts: np.ndarray) -> Low:
        order = np.argsort(triples)
        triples, counts = triples[order].astype(U64), counts[order].astype(np.int64)
        ends = (triples & U64(0xFFFF)).astype(np.int64)
        pairs = np.zeros(1 << 16, np.int64)
        np.add.at(pairs, ends, counts)
        return cls(pairs.reshape(256, 256), (triples, counts))


def log10_of(codes: np.ndarray, counts: np.ndarray, low: Low) -> np.ndarray:
    """Log probability of the last byte of each distinct code, ascending, after the bytes before it.

    ``counts`` are training counts; all codes with the same three bytes of context are at hand (two, if
    ``low`` has no runs of three).
    """
    result = np.zeros(len(codes))
    left = np.arange(len(codes))  # not coded yet
    # Of the context one longer: how many kinds of bytes it rules out here, with what counts.
    kinds_out, counts_out = np.zeros(len(codes)), np.zeros(len(codes))
    seen = counts > 0
    edges, weight = codes[seen], counts[seen]
    for order in range(ORDER, 0, -1):
        contexts, first = _distinct(edges >> U64(8))
        kinds = np.diff(first, append=len(edges))
        # What a context rules out in the next shorter one.
        shorter, shorter_weight, passed = _shorter(edges, weight, order, low)
        total, gone = (np.add.reduceat(x, first) if len(x) else x for x in (weight, passed))
        asked = codes[left] & _mask(order)
        context, known = _find(contexts, asked >> U64(8))
        edge, hit = _find(edges, asked)
        found = known, hit, _at(weight, edge), _at(total, context), _at(kinds, context)
        still = _code(result, left, *found, kinds_out, counts_out)
        kinds_out = np.where(known, _at(kinds, context), 0.0)[still]
        counts_out = np.where(known, _at(gone, context), 0.0)[still]
        left = left[still]
        edges, weight = shorter, shorter_weight
    single = low.single[(codes[left] & U64(0xFF)).astype(np.int64)]
    everything = np.full(len(left), low.single.sum(), float)
    met = int((low.single > 0).sum())
    known = np.full(len(left), met > 0)
    still = _code(result, left, known, single > 0, single, everything, np.full(len(left), met), kinds_out, counts_out)
    result[left[still]] -= np.log10(max(1, 256 - met))
    return result


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of ascending keys, and where each begins."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], first


def _shorter(edges: np.ndarray, weight: np.ndarray, order: int, low: Low) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts one shorter with their next byte, ascending, with counts; the count of each edge's own."""
    if order == 1:
        return edges, weight, low.single[(edges & U64(0xFF)).astype(np.int64)]
    masked = edges & _mask(order - 1)
    if order == 2 or (order == 3 and low.triples is not None):
        if order == 3:
            shorter, counts = low.triples
        else:
            before, after = np.nonzero(low.pairs)
            shorter, counts = (before.astype(U64) << U64(8)) | after.astype(U64), low.pairs[before, after]
        place, has = _find(shorter, masked)
        return shorter, counts, np.where(has, _at(counts, place), 0)
    by = np.argsort(masked, kind="stable")  # at most 256 ascending runs
    shorter, first = _distinct(masked[by])
    counts = np.add.reduceat(weight[by], first) if len(by) else weight
    passed = np.empty(len(by), counts.dtype)
    passed[by] = np.repeat(counts, np.diff(first, append=len(by)))
    return shorter, counts, passed


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


def _at(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    return values[places] if len(values) else np.zeros(len(places))


def _code(result, left, known, hit, weight, total, kinds, kinds_out, counts_out) -> np.ndarray:
    """One step: codes the bytes that the context knows, charges an escape to the others, which are given."""
    mass, new = total - counts_out, kinds - kinds_out
    here = known & (new > 0)
    coded = here & hit
    result[left[coded]] += np.log10((weight[coded] - 0.5) / mass[coded])
    escaped = here & ~hit
    result[left[escaped]] += np.log10(new[escaped] / 2 / mass[escaped])
    return ~coded


def _contexts(tries: int, across: bool):
    """The distinct codes of the chunks, by the part of the trie that has them."""

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, held_out, chunk in _rows_of(part):
                _give_back()
                codes, counts = chunk.codes(held_out, across)
                to = _trie_of(codes, tries)
                groups = _groups(to)
                yield pd.DataFrame(
                    {
                        "chunk": name,
                        "trie": [int(to[g[0]]) for g in groups],
                        "codes": [_pack_planes(np.diff(codes[g], prepend=U64(0))) for g in groups],
                        "counts": [_pack(counts[g].astype(np.int64)) for g in groups],
                    }
                )
                del chunk, codes, counts, to, groups  # before the next chunk is made

    return split


def _runs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Training counts of runs of three bytes, summed over some chunks."""
    for part in parts:
        runs, counts = np.zeros(0, U64), np.zeros(0, np.int64)
        for more, their in zip(part["runs"], part["run_counts"], strict=True):
            runs, counts = _summed(runs, counts, _unpack(more, U64), _unpack(their, np.int64))
        yield pd.DataFrame({"run": runs.astype(np.int32), "n": counts})


def _price(low: Low):
    """What codes one part of the trie, for the chunks that asked.

    Counts of the code and of its context, which give the log probability of a code that was learned, and
    log probabilities of the others: whole numbers take less room.
    """

    def price(parts: pd.DataFrame) -> pd.DataFrame:
        _give_back()
        codes = [np.cumsum(_unpack_planes(x, U64), dtype=U64) for x in parts["codes"]]
        # In the order in which they were asked the look-ups are neighbours.
        distinct = np.concatenate(codes)
        distinct.sort()
        distinct, _ = _distinct(distinct)
        places = [np.searchsorted(distinct, c) for c in codes]
        del codes
        n = np.zeros(len(distinct), np.int64)
        for place, counts in zip(places, parts["counts"], strict=True):
            n[place] += _unpack(counts, np.int64)
        distinct = distinct.byteswap()
        order = np.argsort(distinct)
        distinct, counts = distinct[order], n[order]
        _, first = _distinct(distinct >> U64(8))
        total, value = np.empty(len(n), np.int64), np.empty(len(n))
        total[order] = np.repeat(np.add.reduceat(counts, first), np.diff(first, append=len(n)))
        value[order] = log10_of(distinct, counts, low)
        learned = [p[n[p] > 0] for p in places]
        return pd.DataFrame(
            {
                "chunk": parts["chunk"],
                "kind": "prices",
                "part": parts["trie"],
                "counts": [_pack_planes(n[p]) for p in places],
                "totals": [_pack_planes(total[p]) for p in learned],
                "prices": [_pack(value[p[n[p] == 0]]) for p in places],
            }
        )

    return price


def _prices(counts: bytes, totals: bytes, prices: bytes) -> np.ndarray:
    n = _unpack_planes(counts, np.int64)
    result = np.empty(len(n))
    result[n > 0] = np.log10((n[n > 0] - 0.5) / _unpack_planes(totals, np.int64))
    result[n == 0] = _unpack(prices, np.float64)
    return result


def _scores(tokens: int, kinds: int, buckets: int, tries: int, across: bool):
    below = tokens + 0.1 * (kinds + 1)

    def answered(found: Iterator[np.ndarray], to: np.ndarray, dtype) -> np.ndarray:
        """What came back from the parts, at the places that asked."""
        result = np.empty(len(to), dtype)
        for places, values in zip(_groups(to), found, strict=True):
            result[places] = values
        return result

    def score(dealt: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        _give_back()
        _, held_out, chunk = next(_rows_of(dealt))
        answers = answers.sort_values("part")
        found = answers[answers["kind"] == "counts"]
        found = (_unpack_planes(x, np.int64) for x in found["counts"])
        counts = answered(found, chunk.buckets(buckets), np.int64)
        codes, used = chunk.uses(across)
        found = answers[answers["kind"] == "prices"]
        found = map(_prices, found["counts"], found["totals"], found["prices"])
        prices = answered(found, _trie_of(codes, tries), np.float64)
        total = np.zeros(len(held_out))
        for own, starts, place in used:
            begin = np.flatnonzero(np.unpackbits(starts, count=len(place)))
            value = np.repeat(prices[np.searchsorted(codes, own)], np.diff(begin, append=len(place)))
            total += np.bincount(place, weights=value, minlength=len(total))
        plain, known = np.log10((counts + 0.1) / below)[chunk.numbers], (counts > 0)[chunk.numbers]
        starts = chunk.ends - chunk.n_words
        return pd.DataFrame(
            {
                "id": list(dealt["ids"].iloc[0]),
                "held_out": list(dealt["held_out"].iloc[0]),
                "n_tokens": chunk.n_words,
                "n_known": np.add.reduceat(known.astype(np.int64), starts),
                "train_tokens": tokens,
                "base_score": np.add.reduceat(plain, starts),
                "score": total,
            }
        )

    return score


def score(
    docs: DataFrame, held_out, key: str = "doc_id", buckets: int | None = None, across: bool = False
) -> DataFrame:
    """Scores all documents by a model of those that are not ``held_out`` (a column).

    ``buckets`` is the number of parts of the vocabulary, and the least number of parts of the trie (the
    session's shuffle partitions).  Contexts reach ``across`` words if asked.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    tries = max(buckets, -(-size // PART_BYTES))
    # Ids travel as text: pandas would turn whole numbers beside nulls into floating point.
    own_id = F.col(key).cast("string")
    rows = docs.select(own_id.alias("id"), F.col("text"), held_out.alias("held_out"))
    dealt = settle(rows.mapInArrow(dealer(across), CHUNKS), "dealt")
    chunks = dealt.drop("runs", "run_counts")
    parts = chunks.mapInPandas(_words(buckets), "chunk string, bucket int, words binary, counts binary")
    vocabulary = parts.groupBy("bucket").applyInPandas(
        _vocabulary, "chunk string, bucket int, counts binary, tokens bigint, kinds bigint"
    )
    vocabulary = settle(vocabulary, "vocabulary")
    sums = vocabulary.where("chunk IS NULL").agg(F.sum("tokens"), F.sum("kinds"))
    tokens, kinds = sums.first()
    runs = dealt.select("runs", "run_counts").mapInPandas(_runs, "run int, n bigint")
    runs = runs.groupBy("run").agg(F.sum("n").alias("n")).toArrow()  # 16,777,216 rows at most
    low = Low.of(runs["run"].to_numpy(), runs["n"].to_numpy())
    contexts = chunks.mapInPandas(
        _contexts(tries, across), "chunk string, trie int, codes binary, counts binary"
    )
    prices = contexts.groupBy("trie").applyInPandas(
        _price(low), "chunk string, kind string, part int, counts binary, totals binary, prices binary"
    )
    counts = vocabulary.where("chunk IS NOT NULL").select(
        "chunk", F.lit("counts").alias("kind"), F.col("bucket").alias("part"), "counts"
    )
    schema = (
        "id string, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double"
    )
    both = chunks.groupBy("chunk").cogroup(prices.unionByName(counts, allowMissingColumns=True).groupBy("chunk"))
    scored = both.applyInPandas(_scores(tokens or 0, kinds or 0, buckets, tries, across), schema)
    scored = scored.withColumn("id", F.col("id").cast(docs.schema[key].dataType))
    return scored.withColumnRenamed("id", key)
