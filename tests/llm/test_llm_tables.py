"""Vectors, revisits, tool calls, mixing, rollups and the pipeline."""

import datetime
import json

import numpy as np
import pytest

import corpus_pipeline
from compare import connection, difference
from docketry.llm import ann
from docketry.llm.ann import SAMPLE, learn_router, nearest_neighbours, partitions_for
from docketry.llm.embedding_dedup import near_duplicate_vectors
from docketry.llm.mixing import DOMAINS, fit_rates, mix_report, soft_mixing
from docketry.llm.queries import ORACLES, QUERIES
from docketry.llm.revisits import canonical_url, resolve_revisits
from docketry.llm.rollups import Rollup
from docketry.llm.tool_calls import link_tool_calls
from docketry.llm.vectors import unit
from pyspark.sql import functions as F

VECTORS = "vec_id bigint, embedding array<float>, label int, id string, cell int, links int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "a", 1, 1) for i, v in rows], VECTORS)


def brute_links(ids, x, threshold):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    top = list(range(len(ids)))

    def root(i):
        return i if top[i] == i else root(top[i])

    for a, b in zip(*np.nonzero(near)):
        p, q = sorted((root(a), root(b)), key=lambda i: ids[i])
        top[q] = p
    return {(int(ids[i]), int(near[i].sum()), int(ids[root(i)]), ids[root(i)] == ids[i]) for i in range(len(ids))}


def clouds(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 12))
    for i in range(0, n, 3):
        x[i] = x[i % 30] * rng.uniform(0.5, 3) + rng.normal(size=12) * rng.choice([0, 0.1, 0.3])
    return np.arange(n) * 2 + 1, x.astype(np.float32).astype(np.float64)


@pytest.mark.parametrize("cell", [4096, 40])
def test_vector_links_equal_brute_force(spark, monkeypatch, cell):
    import docketry.llm.embedding_dedup as module

    monkeypatch.setattr(module, "CELL", cell)
    ids, x = clouds(300, 1)
    found = near_duplicate_vectors(vectors(spark, list(zip(ids.tolist(), x.tolist()))), 0.95).collect()
    assert {tuple(r) for r in found} == brute_links(ids, x, 0.95)


def test_op3_on_the_given_table(spark, data):
    rows = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    want = brute_links(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64), 0.95)
    assert {tuple(r) for r in QUERIES["op3_embedding_dedup"](spark, data).collect()} == want


ODD = [(1, [1, 0]), (2, [1, 0]), (2, [1, 0]), (3, [0, 0]), (4, None), (5, [float("nan"), 1]), (6, [None, 1]), (7, [float("inf"), 1]), (8, [2e-30, 0]), (9, [1, 2, 3]), (10, []), (None, [1, 0])]


def test_vectors_of_odd_rows(spark):
    found = {r["vec_id"]: tuple(r)[1:] for r in near_duplicate_vectors(vectors(spark, ODD)).collect()}
    assert found == {1: (2, 1, True), 2: (2, 1, False), 8: (2, 1, False), **{i: (0, i, True) for i in (3, 4, 5, 6, 7, 9, 10)}}
    assert near_duplicate_vectors(vectors(spark, [])).collect() == []
    near = [tuple(r) for r in nearest_neighbours(vectors(spark, ODD), F.col("vec_id") % 2 == 0, 3).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in near] == [(2, 1, 1), (2, 2, 8), (8, 1, 1), (8, 2, 2)]
    assert nearest_neighbours(vectors(spark, []), F.lit(True)).collect() == []


def test_op10_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)
    found = {}
    for r in QUERIES["op10_nearest_neighbours"](spark, sf).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    hits = total = 0
    at = {i: n for n, i in enumerate(ids.tolist())}
    for q in ids[ids % 20 == 0].tolist():
        scores = x @ x[at[q]]
        scores[at[q]] = -np.inf
        best = ids[np.lexsort((ids, -scores))][:20]
        got = found[q]
        assert [r for _, _, r in got] == list(range(1, 21))
        assert got == sorted(got, key=lambda g: (-g[1], g[0]))
        assert all(abs(s - scores[at[v]]) < 1e-12 for v, s, _ in got)
        hits += len(set(best.tolist()) & {v for v, _, _ in got})
        total += 20
    assert hits / total >= 0.9


def clustered(n, dims, clusters, seed, norms=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (clusters, dims))
    x = centres[rng.integers(0, clusters, n)] + rng.normal(0, 0.25, (n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x * rng.uniform(0.8, 1.2, (n, 1)) if norms else x


@pytest.mark.parametrize(("clusters", "norms"), [(300, False), (1_500, False), (300, True)])
def test_recall_of_rows_that_nothing_was_fitted_on(clusters, norms):
    n = 48_000
    x = clustered(n, 48, clusters, clusters, norms)
    sample, others = x[:2 * SAMPLE], x[2 * SAMPLE:]
    router = learn_router(sample[::2], sample[1::2], 20, partitions_for(n), total=n)
    parts = router.outer.shape[1]
    assert parts == partitions_for(n) > 64 >= partitions_for(2_000)
    placed = router.ranked(unit(x))[:, 0]
    sizes = np.bincount(placed, minlength=parts)
    queries = np.arange(2 * SAMPLE, 2 * SAMPLE + 400)
    visited = router.ranked(unit(x[queries]))[:, : router.probes]
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -np.inf
    best = np.argpartition(-scores, 20, axis=1)[:, :20]
    met = [np.isin(placed[b], v).mean() for b, v in zip(best, visited)]
    assert np.mean(met) >= 0.9
    assert sizes[visited].sum(axis=1).mean() <= n / 5


def test_only_structure_is_worth_more_partitions():
    structured = clustered(8_192, 32, 400, 6)
    chosen = ann.cheapest_router(structured[::2], structured[1::2], 20, 0.95, 100_000)
    assert chosen.outer.shape[1] > ann.LEAST_PARTITIONS and chosen.share < 0.2
    plain = np.random.default_rng(7).normal(0, 1, (4_096, 48))
    chosen = ann.cheapest_router(plain[::2], plain[1::2], 20, 0.95, 100_000)
    assert chosen.outer.shape[1] == ann.LEAST_PARTITIONS


def test_search_beyond_the_sample(spark, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE", 256)
    monkeypatch.setattr(ann, "BLOCK", 512)
    x = clustered(4_096, 16, 40, 3)
    x[1_000:1_400] = x[1_000]  # equal vectors in many blocks
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(5)
    found = {}
    for r in ann.nearest_neighbours(rows, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, len(x), 20):
        scores = (x * x[q]).sum(axis=1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -scores))[:20]
        hits += len({v for v, _ in found[q]} & set(best.tolist()))
        assert found[q] == sorted(found[q], key=lambda g: (-g[1], g[0])) and all(s == scores[v] for v, s in found[q])
        if 1_000 <= q < 1_400:
            assert [v for v, _ in found[q]] == best.tolist()
    assert hits >= 0.9 * 20 * len(found) and len(found) == 205


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, data, name):
    assert difference(QUERIES[name](spark, data), connection(data), ORACLES[name]) is None


def test_urls(spark):
    urls = {
        "HTTP://WWW.Ex.com:80/A/?b=2&utm_x=1&a=1#top": "ex.com/A?a=1&b=2", "ex.com": "ex.com", "https://ex.com/?ref=x": "ex.com",
        " ": None, None: None,
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", canonical_url(F.col("u")).alias("c")).collect()
    assert {r["u"]: r["c"] for r in rows} == urls


def test_revisits_of_odd_rows(spark):
    day = datetime.datetime(2024, 1, 1)
    at = lambda h: day + datetime.timedelta(hours=h)
    tag = 'ETag: "{}"\r\nContent-Length: 5\r\nSet-Cookie: a'
    rows = [
        (1, "response", "http://a/x", at(0), 200, tag.format("v1")), (2, "response", "http://a/x", at(9), 200, tag.format("v2")),
        (3, "response", "http://a/x", at(9), 200, tag.format("v3")), (4, "response", "http://a/x", at(12), 206, tag.format("v4")),
        (10, "revisit", "https://www.a/x/", at(9), 304, 'etag: W/"v1"\nContent-Length: 0\nset-cookie: b\nset-cookie: c'),
        (11, "revisit", "http://a/x", at(30), 304, 'etag: "v3"'), (11, "revisit", "http://a/x", at(30), 304, 'etag: "v3"'),
        (12, "revisit", "http://a/x", at(10), 304, 'etag: "v2"'), (13, "revisit", "http://a/x", at(-1), 304, 'etag: "v1"'),
        (14, "revisit", "http://a/x", at(10), 304, None), (15, "revisit", "http://a/x", at(10), None, ""),
        (16, "revisit", None, at(10), 304, ""), (17, "revisit", "http://a/x", None, 304, ""), (None, "revisit", "http://a/x", at(1), 304, ""),
    ]
    records = spark.createDataFrame([(*r, 0, "u") for r in rows], "record_id bigint, warc_type string, target_uri string, warc_date timestamp, status int, headers string, at int, url string")
    found = {r["record_id"]: tuple(r)[2:] for r in resolve_revisits(records).collect()}
    assert found[10] == ("resolved", 1, 'content-length: 5\netag: W/"v1"\nset-cookie: b\nset-cookie: c')
    assert found[11][:2] == ("resolved", 3) and found[14][:2] == ("unvalidated", 3)
    assert {i: found[i] for i in (12, 13, 15, 16, 17)} == {
        12: ("changed", None, None), 13: ("orphan", None, None), 15: ("not_304", None, None), 16: ("incomplete", None, None), 17: ("incomplete", None, None),
    }
    assert len(found) == 8 and resolve_revisits(records.where("false")).collect() == []


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, 1, "a", "add", '{"y": 2, "x": 1}', None, "z"), (1, 1, "a", "add", '{"y": 2, "x": 1}', None, "z"),
            (1, 3, "b", "add", '{"x": "1", "w": null}', ["a", "gone"], "z"), (1, 2, "c", "add", '{"x": 1.5, "v": [1]}', ["a", "b"], "z"),
            (2, 1, "d", "nope", "{}", ["e"], "z"), (2, 2, "e", "add", '{"x": 1}', ["d"], "z"), (3, 1, "f", "add", "[1", [None], "z"),
            (3, 2, "g", "add", None, [], "z"), (3, 3, None, "add", "{}", None, "z"), (None, None, "h", "add", '{"x": 1}', None, "z"),
        ],
        "conv_id bigint, turn bigint, call_id string, name string, arguments string, after array<string>, status string",
    )
    results = spark.createDataFrame([("a", 'say "é"\n', 1), ("a", 'say "é"\n', 1), ("h", None, 1), ("zz", "lost", 1), (None, "x", 1)], "call_id string, content string, level int")
    schemas = spark.createDataFrame([("add", "x", "integer", True), ("add", "y", "number", None), ("add", "v", "array", False)], "name string, argument string, type string, required boolean")
    found = {r["call_id"]: r for r in link_tool_calls(calls, results, schemas).collect()}
    assert {k: (r["level"], r["status"], r["violations"]) for k, r in found.items()} == {
        "a": (0, "ok", ""), "b": (1, "invalid", "x: not integer"), "c": (2, "invalid", "x: not integer"),
        "d": (None, "cycle", ""), "e": (None, "cycle", ""), "f": (0, "invalid", "arguments: no JSON object"),
        "g": (0, "invalid", "arguments: no JSON object"), "h": (0, "ok", ""), "zz": (None, "no_call", ""),
    }
    text = found["a"]["json"]
    assert text == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(text) == {"arguments": {"x": 1, "y": 2}, "call_id": "a", "level": 0, "name": "add", "result": 'say "é"\n', "status": "ok"}
    assert link_tool_calls(calls.where("false"), results.where("false"), schemas).collect() == []


def test_op7_keeps_every_call(spark, data):
    conversations = spark.read.parquet(f"{data}/conversations.parquet")
    found = QUERIES["op7_tool_calls"](spark, data)
    assert found.where("status not in ('no_call', 'turn')").count() == conversations.where("role = 'assistant'").count()
    # Every turn is somewhere: as a call, as the result of one, or by itself.
    said = {}
    for r in found.collect():
        told = json.loads(r["json"])
        for text in (told.get("content"), told.get("result"), (told.get("arguments") or {}).get("text")):
            said[text] = said.get(text, 0) + 1
    assert all(said.get(t, 0) >= 1 for t, in conversations.select("text").collect())
    rest = found.where("status = 'turn'")
    assert rest.count() == conversations.where("role = 'system' or (role = 'user' and turn = 0)").count()
    level = {r["call_id"]: r["level"] for r in found.where("call_id is not null").collect()}
    for conv, turn in conversations.where("role = 'assistant' and turn >= 3").select("conv_id", "turn").collect():
        before = f"c{conv}-{2 * (((turn - 1) // 2 - 1) // 2) + 1}"
        assert before not in level or level[before] < level[f"c{conv}-{turn}"]


def test_rates_equal_projected_gradient_in_numpy(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([4, 1, 1], 200)
    t = rng.integers(1, 900, 200)
    weights = {"clean": 0.7, "toxic": 0.12, "low": 0.18}
    rows = [(i, int(t[i]), *map(float, p[i])) for i in range(200)]
    found = fit_rates(spark.createDataFrame(rows, "doc_id bigint, tokens bigint, " + ", ".join(f"p_{d} double" for d in DOMAINS)), weights, 40)
    got = np.array([r["rate"] for r in found.orderBy("doc_id").collect()])
    want = np.ones(200)
    target = np.array(list(weights.values())) * t.sum()
    norm = np.linalg.inv((p.T * t) @ p)
    for _ in range(40):
        want = np.maximum(0, want - p @ (norm @ ((want * t) @ p - target)))
    assert (got >= 0).all() and np.allclose(got, want, atol=1e-3)
    assert np.allclose((got * t) @ p, target, rtol=0.02)


def test_a_target_of_nothing_is_a_target(spark):
    rng = np.random.default_rng(2)
    rows = []
    for n in range(400):
        p = rng.dirichlet([0.1, 0.1, 0.1]).tolist()
        rows.append((n, int(rng.integers(1, 500)), *p))
    members = spark.createDataFrame(rows, "doc_id bigint, tokens bigint, p_clean double, p_toxic double, p_low double")
    for weights in ({"clean": 1.0, "toxic": 0.0, "low": 0.0}, {"clean": 0.7, "toxic": 0.3, "low": 0}):
        rates = fit_rates(members, weights, steps=40)
        report = {r["domain"]: r for r in mix_report(rates, weights).collect()}
        assert all(abs(report[d]["share"] - w / sum(weights.values())) < 0.06 for d, w in weights.items())
        assert report["low"]["share"] < 0.03  # without a target it would be a third
        assert all(abs(r["miss"] - (r["share"] - r["target"])) < 1e-12 for r in report.values())
        assert rates.where("rate < 0 or rate is null").count() == 0
    free = {r["domain"]: r["target"] for r in mix_report(fit_rates(members, {"clean": 1.0, "toxic": 0.0}), {"clean": 1.0, "toxic": 0.0}).collect()}
    assert free == {"clean": 1.0, "toxic": 0.0, "low": None}
    for bad in ({}, {"clean": 0.0}, {"clean": 1.0, "low": -0.1}):
        with pytest.raises(ValueError):
            fit_rates(members, bad)


def test_mixing_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "a good text", 5), (3, "a good text", 5), (None, "x", 5), (4, "w " * 50_000, 5)], "doc_id bigint, text string, tokens int")
    none = spark.createDataFrame([(None, None, None), (9, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = soft_mixing(docs, none, {"clean": 0.9, "toxic": 0.1}).collect()
    assert len(found) == 6 and all(abs(sum(r[f"p_{d}"] for d in DOMAINS) - 1) < 1e-9 and r["rate"] >= 0 for r in found)
    assert soft_mixing(docs.where("false"), none, {"clean": 1.0}).collect() == []


def test_mixing_tells_domains_and_meets_targets(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: "low" if r["quality"] == 0 else "toxic" if r["toxic"] else "clean" for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = QUERIES["op5_soft_mixing"](spark, sf).collect()
    assert len(found) == 10_000
    best = [max(DOMAINS, key=lambda d: r[f"p_{d}"]) == labels[r["doc_id"]] for r in found if r["doc_id"] in labels]
    assert np.mean(best) > 0.9
    mixed = np.array([[r["rate"] * r["tokens"] * r[f"p_{d}"] for d in DOMAINS] for r in found]).sum(axis=0)
    assert np.allclose(mixed / sum(r["tokens"] for r in found), [0.94, 0.03, 0.03], atol=1e-4)


def test_mixing_runs_no_python(spark, data):
    plan = QUERIES["op5_soft_mixing"](spark, data)._jdf.queryExecution().executedPlan().toString()
    plan += QUERIES["op7_tool_calls"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_rollups_count_once(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"))
    assert rollup.totals().collect() == []
    changes = "op string, source string, lang string, version string, tokens bigint, old_tokens bigint, docs string"
    load = spark.createDataFrame([("insert", "s", None, "v", 5, None, "x"), ("INSERT", "s", None, "v", 7, None, "x"), ("insert", "s", "en", "v", None, None, "x")], changes)
    assert rollup.apply("one", load) and not rollup.apply("one", load)
    # A batch that failed before its commit is written anew.
    load.limit(1).write.parquet(str(tmp_path / "r/batches/two"))
    more = spark.createDataFrame([("revise", "s", None, "v", 9, 7, "x"), ("delete", "s", "en", "v", None, None, "x")], changes)
    assert rollup.apply("two", more)
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", None, "v", 2, 14)]
    assert rollup.apply("three", load.where("false")) and rollup.committed() == ["one", "three", "two"]
    with pytest.raises(Exception, match="unknown change"):
        rollup.apply("four", load.withColumn("op", F.lit("swap")))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", None, "v", 2, 14)]
    with pytest.raises(ValueError):
        rollup.apply("../x", load)


def test_folded_batches_count_once(spark, tmp_path, monkeypatch):
    rollup = Rollup(spark, str(tmp_path / "r"))
    assert not rollup.compact()
    changes = "op string, source string, lang string, version string, tokens bigint, old_tokens bigint"
    batch = lambda *rows: spark.createDataFrame(list(rows), changes)
    got = lambda: sorted(map(tuple, rollup.totals().collect()), key=repr)
    rollup.apply("one", batch(("insert", "s", "en", "v", 5, None), ("insert", "t", None, "v", 2, None)))
    rollup.apply("two", batch(("delete", "t", None, "v", 2, None)))
    before = got()
    assert rollup.compact() and not rollup.compact() and got() == before == [("s", "en", "v", 1, 5)]
    assert len(rollup._rows().inputFiles()) < 3 and not rollup.apply("one", batch(("insert", "s", "en", "v", 9, None)))
    rollup.apply("three", batch(("revise", "s", "en", "v", 8, 5), ("insert", "t", None, "v", 2, None)))
    after = [("s", "en", "v", 1, 8), ("t", None, "v", 1, 2)]
    assert got() == after
    # A marker whose writer died half way counts for nothing.
    (tmp_path / "r/compactions/000000001").write_text("totals/none\none\n")
    assert got() == after and rollup.compact() and got() == after and rollup.committed() == ["one", "three", "two"]


def test_pipeline_equals_its_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    n = docs.count()
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, data)
        assert docs.columns == columns, name
        rows = docs.collect()
        assert 0 < len(rows) <= n * 1.3, name
        docs = spark.createDataFrame(rows, docs.schema)
    want = sorted(corpus_pipeline.STAGES[-1][1](spark, docs, data).collect())
    assert sorted(corpus_pipeline.run(spark, data).collect()) == want
    assert len({r["doc_id"] for r in want}) > 0.6 * n
