"""Cuckoo filters and incremental line deduplication against brute force."""

import random

import numpy as np
import pytest

from compare import connection, difference
from docketry.llm.cuckoo import Cuckoo
from docketry.llm.line_dedup import LineIndex, dedup_lines
from docketry.llm.queries import ORACLES, QUERIES

DOCS = "doc_id bigint, text string, key string, kept int"


def brute_dedup(held, rows, least=3, chars=20):
    """``held`` documents are in the index; ``rows`` are deduplicated."""

    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
        return bare if len(bare) >= chars else None

    having = {}
    for doc, text in held:
        for line in (text or "").split("\n"):
            if doc is not None and key(line):
                having.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if doc is None or len(having.get(key(x), ())) < least or doc not in having[key(x)] or doc == max(having[key(x)])]
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(parts)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    lines = [f"a line that documents share, number {i}" for i in range(12)] + ["short", "", "   ", "\u00e9" * 20, "\u00e9" * 19, "z" * 20]
    change = [str, str.upper, lambda x: f"  {x}\t", lambda x: f"\u00a0{x}"]
    docs = []
    for i in range(n):
        own = [rng.choice(change)(rng.choice(lines)) for _ in range(rng.choice([0, 1, 4, 9]))] + [f"only document {i} has this line"]
        rng.shuffle(own)
        docs.append((i * 7 % 101, "\n".join(own)))
    return docs


def test_filter_keeps_what_is_added_and_forgets_what_is_removed():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    made = Cuckoo.of(np.append(hashes, hashes[:50]))  # some twice
    assert made.has(hashes).all() and made.entries == 20_050
    others = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert made.has(others).mean() < 0.002
    made.remove(np.append(hashes[:10_000], hashes[:50]))
    assert made.entries == 10_000 and made.has(hashes[10_000:]).all() and made.has(hashes[:10_000]).mean() < 0.002
    assert made.add(others[:5_000]) and Cuckoo.from_bytes(made.to_bytes()).has(np.append(hashes[10_000:], others[:5_000])).all()
    with pytest.raises(KeyError):
        Cuckoo.sized(10).remove(hashes[:1])
    small = Cuckoo.sized(8)
    assert not small.add(hashes[:1_000])
    assert Cuckoo.of(np.repeat(hashes[:2], 4)).entries == 8
    assert Cuckoo.of(hashes[:0]).has(hashes).sum() == 0


def test_batches_and_deletions_equal_brute_force(spark, tmp_path):
    docs = corpus(1)
    index = LineIndex(spark, str(tmp_path / "lines"), shards=4)
    everything = table(spark, docs)
    assert got(index.dedup(everything)) == brute_dedup([], docs)  # nothing is in the index yet
    assert index.insert("first", table(spark, docs[:25]))
    assert got(index.dedup(everything)) == brute_dedup(docs[:25], docs)
    assert index.insert("second", table(spark, docs[25:]))
    assert not index.insert("second", table(spark, docs[:5]))
    assert got(index.dedup(everything)) == brute_dedup(docs, docs)
    gone = {d for d, _ in docs if d % 2 or d > 90}
    assert index.delete("third", spark.createDataFrame([(d,) for d in [*gone, 1_000, None]], "doc_id bigint"))
    left = [d for d in docs if d[0] not in gone]
    assert got(index.dedup(table(spark, left))) == brute_dedup(left, left)
    # What was deleted comes back, and all is as if nothing had happened.
    assert index.insert("fourth", table(spark, [d for d in docs if d[0] in gone]))
    assert got(index.dedup(everything)) == brute_dedup(docs, docs)
    counts = {bytes(r["key"]): (r["n_docs"], r["last_doc"]) for r in index.counts().collect()}
    fresh = LineIndex(spark, str(tmp_path / "fresh"), shards=4)
    fresh.insert("all", everything)
    assert counts == {bytes(r["key"]): (r["n_docs"], r["last_doc"]) for r in fresh.counts().collect()}
    assert index.committed() == ["first", "second", "third", "fourth"]
    # The filters hold the keys of the exact table, and hardly any other.
    filters = {r["shard"]: Cuckoo.from_bytes(bytes(r["cells"])) for r in index.filters().collect()}
    assert sum(f.entries for f in filters.values()) == sum(n >= 3 for n, _ in counts.values())
    with pytest.raises(ValueError):
        LineIndex(spark, str(tmp_path / "fresh"), shards=8)
    with pytest.raises(ValueError):
        index.insert("../x", everything)


def test_a_failed_batch_leaves_the_index_as_it_was(spark, tmp_path, monkeypatch):
    docs = corpus(2)
    index = LineIndex(spark, str(tmp_path / "lines"), shards=2)
    index.insert("first", table(spark, docs[:30]))
    monkeypatch.setattr(LineIndex, "_new_filters", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        index.insert("second", table(spark, docs[30:]))
    monkeypatch.undo()
    everything = table(spark, docs)
    assert got(index.dedup(everything)) == brute_dedup(docs[:30], docs)
    assert index.insert("second", table(spark, docs[30:]))
    assert got(index.dedup(everything)) == brute_dedup(docs, docs)


def test_lines_of_odd_rows(spark):
    line = "this line is in all documents of the table"
    docs = [(1, None), (2, ""), (3, line), (3, line + "\nother text of the same document"), (4, f"{line}\n{line}\n"), (None, line), (5, f" {line.upper()} \nx"), (5, line)]
    assert got(dedup_lines(table(spark, docs))) == brute_dedup(docs, docs)
    assert dedup_lines(table(spark, [], 1)).collect() == []
    long = "\n".join(f"line {i % 3000} of a very long document" for i in range(9000))
    docs = [(i, long) for i in range(4)]
    assert got(dedup_lines(table(spark, docs))) == brute_dedup(docs, docs)


def test_op11_equals_sql(spark, data):
    assert difference(QUERIES["op11_line_dedup"](spark, data), connection(data), ORACLES["op11_line_dedup"]) is None
