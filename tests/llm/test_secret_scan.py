from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from cellarium.llm import secret_scan as s

ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(ASSIGN, text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    found.sort()
    return found


def pieces(rng):
    some = [
        'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "PassWord:hunter2hunter2", "secret=short",
        "api_key='aaaa.bbbb=cc'", "APIKEY : x-y_z/123456", "token token=abcdefgh", "AKIA" + "A1B2" * 4, "AKIA12",
        "xAKIA" + "Z" * 20, "0123456789abcdef" * 2, "0123456789abcdef" * 2 + "g", "deadbeef" * 3, "ſecret=abcdefghij",
        "toKen=abcdefgh12", "passwd\t=abcdefghi", "é" * 5, "ghp_" + "a1" * 20, "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12,
        "-----BEGIN RSA PRIVATE KEY-----", "https://me:pw@host/x", "xoxb-" + "1" * 12, "AIza" + "x" * 35,
    ]
    return " ".join(rng.choice(some) if rng.random() < 0.6 else "word" for _ in range(rng.randrange(1, 12)))


def test_spans_match_a_plain_version(make_docs):
    rng = random.Random(1)
    texts = [None, "", "x", *[pieces(rng) for _ in range(400)], "a" * 100_000 + " token=abcdefgh", "token=abcdefgh"]
    rows = {r["doc_id"]: r for r in s.digest(s.spans(make_docs(texts))).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        want = plain(text)
        written = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in want)
        r = rows[k]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(x[3] == kind for x in want) for kind in s.BASE
        )
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        every = [m.start() for rule in s.RULES[3:] for m in rule.regex().finditer(text or "")]
        assert len(r["spans"].split(",")) == max(1, len(want) + len(every))
        base = [x for x in r["spans"].split(",") if x.split(":")[0] in s.BASE]
        assert ",".join(base) == written


def test_queries_name_every_text_that_matches():
    assert s.trigram_query(r"[0-9a-f]{32,}") is True
    assert s.trigrams(s.trigram_query(s.RULES[0].pattern)) >= {b"pas", b"oke", b"api"}
    patterns = [r.pattern for r in s.RULES] + [r"ab(cd|ce)f+g?hij", r"(x|yz)?abc", r"(?:abc)+d", r"a.c|xyz", r"ab*c"]
    rng = random.Random(2)
    for pattern in patterns:
        query, regex = s.trigram_query(pattern), re.compile(pattern)
        wanted = np.zeros(1 << 24, bool)
        for t in s.trigrams(query):
            wanted[s._code(t)] = True
        letters = "abcdefghijxyz"
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 30))) for _ in range(500)]
        texts += [pieces(rng) for _ in range(200)]
        found = set(s.Index([t.encode().lower() for t in texts], wanted).answer(query).tolist())
        assert {k for k, t in enumerate(texts) if regex.search(t)} <= found


def test_empty_table(make_docs):
    assert s.digest(s.spans(make_docs([]).limit(0))).count() == 0


def test_logins_of_any_length(make_docs):
    texts = [f"see https://me:{'p' * 150}@host/x", f"ftp://{'u' * 5000}:{'p' * 50_000}@h", "http://host:80/a@b", "a://b" * 30_000]
    rows = sorted(s.digest(s.spans(make_docs(texts))).collect(), key=lambda r: r["doc_id"])
    assert [r["spans"] for r in rows] == ["login:4:166", "login:0:55008", "", ""]
