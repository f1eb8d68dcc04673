"""Periodic runs against brute force and on odd rows."""

import hashlib
import random
import zlib

import pytest

from docketry.llm import runs as module
from docketry.llm.queries import QUERIES
from docketry.llm.runs import base_words, collapse_runs, collapsed, text_runs

DOCS = "doc_id bigint, text string, runs string, n int"


def brute_runs(words, repeats=4, least=6):
    """Every stretch of every period by comparison with itself shifted; the smallest period of a stretch counts."""
    n, out = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(least, repeats * q):
                out.setdefault((start, length), q)
    return sorted(((s, size, q) for (s, size), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in dropped)


def random_texts(rng):
    texts = []
    for _ in range(rng.randint(1, 5)):
        kinds, text = rng.choice([1, 2, 3, 8]), []
        for _ in range(rng.randint(0, 12)):
            unit = [b"%d" % rng.randrange(kinds) for _ in range(rng.randint(1, 5))]
            text += (unit * rng.randint(1, 8))[: rng.randint(1, 30)] if rng.random() < 0.5 else unit
        texts.append(text)
    return texts


@pytest.mark.parametrize("many", [32, 0])
@pytest.mark.parametrize(("repeats", "least"), [(4, 6), (2, 2), (3, 1), (4, 12)])
def test_runs_equal_brute_force(monkeypatch, many, repeats, least):
    monkeypatch.setattr(module, "MANY_CLASSES", many)
    rng = random.Random(repeats * 100 + least)
    for _ in range(150):
        texts = random_texts(rng)
        got = text_runs(texts, repeats, least)
        assert got == [brute_runs(t, repeats, least) for t in texts]
        assert [collapsed(t, r) for t, r in zip(texts, got)] == [brute_collapsed(t, r) for t, r in zip(texts, got)]


def test_long_runs_and_many_left_words():
    assert text_runs([[b"a"] * 20_000, [b"x", *[b"a", b"b"] * 9_000, b"a", b"y"]]) == [[(0, 20_000, 1)], [(1, 18_001, 2)]]
    scattered = [w for i in range(5_000) for w in (b"%d" % i, b"p", b"q", b"r", b"s", b"t", b"u")]
    assert text_runs([scattered]) == [[]]
    assert text_runs([scattered + [b"z"] * 6]) == [[(35_000, 6, 1)]]
    assert base_words(4, 6) == 5


def test_runs_of_odd_rows(spark):
    words = "a b a b a b a b"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, words), (4, words), (None, "x " * 7), (5, "\u00a0 " * 6), (6, "q\x1cq " * 5 + "end")]
    made = collapse_runs(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS))
    got = sorted([(r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in made.collect()])
    assert got == [
        (0, [(0, 7, 1)], "x"), (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 8, 2)], "a b"), (4, [(0, 8, 2)], "a b"),
        (5, [(0, 6, 1)], "\u00a0"), (6, [], "q\x1cq q\x1cq q\x1cq q\x1cq q\x1cq end"),
    ]
    assert collapse_runs(spark.createDataFrame([], DOCS)).collect() == []
    with pytest.raises(ValueError):
        collapse_runs(spark.createDataFrame([], DOCS), repeats=1)


def test_op13_equals_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    want = {}
    for doc, text in docs.select("doc_id", "text").collect():
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1_500:
            continue  # brute force takes the square of the words
        runs = brute_runs(words)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        want[doc] = (
            len(runs), start, length, period, 1000 * length // period if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(brute_collapsed(words, runs)).hexdigest(),
        )
    rows = QUERIES["op13_periodic_runs"](spark, data)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r[0]: tuple(r[1:]) for r in rows.collect()}
    assert len(got) == docs.count() and sum(w[0] for w in want.values()) > 5
    assert {d: got[d] for d in want} == want
