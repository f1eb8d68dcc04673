"""Importance resampling against brute force and on odd rows."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docketry.llm.common import text_buffer
from docketry.llm.queries import QUERIES
from docketry.llm.resampling import features, gain_planes, importance_resample, ranked, sliced_weights

DOCS = "doc_id bigint, text string, weight string, rank int"


def words_of(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def buckets_of(text):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i: i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_resample(docs, target, percent=5, least=20):
    s, t = [0] * 10000, [0] * 10000
    for _, text in docs:
        for b in buckets_of(text):
            s[b] += 1
    for text in target:
        for b in buckets_of(text):
            t[b] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for doc, text in docs:
        found = buckets_of(text)
        weight = sum(gain[b] for b in found)
        if doc is None:
            rows.append([doc, len(found), weight, None, None])
            continue
        h = int(hashlib.sha256(f"42:{doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = [r for r, (doc, text) in zip(rows, docs) if doc is not None and len(words_of(text)) >= least]
    may.sort(key=lambda r: (-r[3], r[0]))
    for n, row in enumerate(may[: percent * len(may) // 100], 1):
        row[4] = n
    return sorted(map(tuple, rows), key=repr)


def test_features_equal_crc32():
    rng = random.Random(3)
    texts = [None, "", "a", "A b", "x" * 70, "x" * 64 + " " + "y" * 65 + " z", "\u00e9 " * 3, "ab CD 12-3 " + "q" * 200 + " w \u65e5 t"]
    texts += ["".join(rng.choice("ab1 -Z\u00e9\u65e5") for _ in range(rng.randint(0, 200))) for _ in range(200)]
    texts += [" ".join("w" * rng.randint(1, 140) for _ in range(50))]
    for size in (1, 3, 64):
        got = []
        for low in range(0, len(texts), size):
            owner, bucket, words = features(*text_buffer(pa.array(texts[low: low + size], pa.string())))
            got += [(int(n), sorted(bucket[owner == k].tolist())) for k, n in enumerate(words)]
        assert got == [(len(words_of(t)), sorted(buckets_of(t))) for t in texts]


def test_sliced_weights_equal_products():
    rng = np.random.default_rng(5)
    counts = rng.choice([0, 0, 0, 1, 2, 3, 700, 70_000], (7, 1000))
    counts[3] = 0
    gains = rng.integers(-15_000, 9_000, 1000)
    for g in (gains, abs(gains), gains * 0, np.where(gains > 0, 0, -1), np.full(1000, -8), np.full(1000, 7)):
        assert (sliced_weights(counts, *gain_planes(g)) == counts @ g).all()


def test_ranks_over_many_partitions(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id", "id * 7919 % 101 AS score")
    got = ranked(rows.repartition(9), [rows["score"].desc(), rows["id"].asc()]).collect()
    want = sorted(((r["id"], r["score"]) for r in rows.collect()), key=lambda r: (-r[1], r[0]))
    assert sorted((r["rank"], r["id"], r["score"]) for r in got) == [(n, *r) for n, r in enumerate(want, 1)]


@pytest.mark.parametrize("percent", [5, 50, 100])
def test_resampling_of_odd_rows(spark, percent):
    rng = random.Random(percent)
    docs = [(n, " ".join(rng.choice(["one", "Two", "drei", "\u00e9t\u00e9"]) for _ in range(rng.choice([0, 3, 19, 20, 21, 60])))) for n in range(60)]
    docs += [(70, None), (71, ""), (None, "word " * 30), (5, docs[5][1]), (72, "long " * 3000)]
    target = ["one one Two", None, "", "neu"]
    made = importance_resample(
        spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS).repartition(5),
        spark.createDataFrame([(t,) for t in target], "text string"), percent=percent,
    )
    assert made.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, made.collect()), key=repr) == brute_resample(docs, target, percent)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    some = spark.createDataFrame([(1, "a " * 40, "x", 1)], DOCS)
    assert importance_resample(none, some.select("text")).collect() == []
    (row,) = importance_resample(some, none.select("text"), percent=100).collect()
    assert row["n_features"] == 40 + 39 + 38 and row["rank"] == 1


def test_op12_equals_brute_force(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    rows = QUERIES["op12_importance_resampling"](spark, data)
    assert dict(rows.dtypes) == dict.fromkeys(rows.columns, "bigint")
    assert sorted(map(tuple, rows.collect()), key=repr) == brute_resample(docs, target)
