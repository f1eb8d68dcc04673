"""Quality, language, BPE and n-gram operators against brute force and on odd rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docketry.llm.bpe import ChunkEncoder, cut_points, encode_documents, prepared, public_tokenizer
from docketry.llm.common import components, text_buffer, text_pieces
from docketry.llm.langid import predict_languages, train_languages
from docketry.llm.ngram_join import ngram_jaccard_join, search_block, shingle_hashes
from docketry.llm.quality import STEP, WIDTH, fit_network, fold, score_quality, score_texts, train_quality
from docketry.llm.queries import QUERIES

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, tokens int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", None, None, "x", 1) for i, t in rows], DOCS)


def brute_components(docs, words, percent):
    sets = {}
    for doc, text in docs:
        found = (text or "").encode().lower().split()
        grams = {tuple(found[i: i + words]) for i in range(len(found) - words + 1)} or ({tuple(found)} if found else set())
        sets.setdefault(doc, grams)
    top = {d: d for d in sets}

    def root(d):
        return d if top[d] == d else root(top[d])

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((root(a), root(b)))
                top[q] = p
    return {(d, len(sets[d]), root(d)) for d in ids}


def near_copies(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 3)))
    passage = [word() for _ in range(30)]
    docs = []
    for base in range(12):
        text = [word() for _ in range(rng.choice([2, 9, 40, 120]))]
        for _ in range(rng.choice([1, 2, 14])):
            copy = list(text)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = word()
            docs.append((len(docs) * 3 + 1, " ".join(copy + passage * (base % 3 == 0))))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("words, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 60, 3)])
def test_join_equals_brute_force(spark, words, percent, seed):
    docs = near_copies(seed)
    found = ngram_jaccard_join(table(spark, docs), words, percent).collect()
    assert {tuple(r) for r in found} == brute_components(docs, words, percent)


def test_join_of_split_blocks(spark, monkeypatch):
    import docketry.llm.ngram_join as module

    monkeypatch.setattr(module, "BLOCK_DOCS", 5)
    docs = near_copies(4)
    found = ngram_jaccard_join(table(spark, docs), 3, 80).collect()
    assert {tuple(r) for r in found} == brute_components(docs, 3, 80)


def test_join_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (9, "one\x0btwo"), (5, long), (6, long + " end"), (6, long + " end"), (None, long)]
    found = sorted(tuple(r) for r in ngram_jaccard_join(table(spark, rows), 3, 90).collect())
    assert found == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 29_998, 5), (6, 29_999, 5), (9, 1, 4)]
    assert ngram_jaccard_join(table(spark, []), 3, 90).collect() == []


def test_texts_of_one_set_are_compared_once(spark):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(4, long), (4, long), (4, long.upper()), (4, long.replace(" ", "  ")), (2, long + " end"), (2, long + " END"), (3, "else")]
    found = sorted(tuple(r) for r in ngram_jaccard_join(table(spark, rows), 3, 90).collect())
    assert found == [(2, 299, 2), (3, 1, 3), (4, 298, 2)]


@pytest.mark.parametrize("docs", [4_096, 7])
def test_blocks_that_overlap_are_one(spark, monkeypatch, docs):
    import docketry.llm.ngram_join as module

    monkeypatch.setattr(module, "BLOCK_DOCS", docs)
    rng = random.Random(5)
    blocks = [[i for i in range(20) if i == 0 or rng.random() < 0.9] for _ in range(30)] + [[30, 31, 32], [31, 32], [40], [50, 51]]
    keys = spark.createDataFrame([(1000 + k, i) for k, block in enumerate(blocks) for i in block], "key long, id long")
    sets = spark.createDataFrame([(i, i // 2 * (i >= 50) or i, 9) for i in range(60)], "id long, label long, weight int")
    sent = module._sent(module._parts(keys, sets)).collect()
    met = {frozenset((a["id"], b["id"])) for a in sent for b in sent if (a["key"], a["i"], a["j"]) == (b["key"], b["i"], b["j"])}
    assert all({frozenset((a, b)) for a in block for b in block} <= met for block in blocks[:-2])
    assert {r["id"] for r in sent} == {*range(20), 30, 31, 32}
    assert len(sent) == (25 if docs > 20 else 65)  # 20 and 3 and 2 rows, or the 20 three times


def test_tokens_are_shuffled_once(spark, monkeypatch):
    import docketry.llm.ngram_join as module

    plans, stage = {}, module.stage

    def staged(df, name):
        df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return stage(df, name)

    monkeypatch.setattr(module, "stage", staged)
    module.ngram_jaccard_join(table(spark, near_copies(1)), 3, 90)
    assert all("ReusedExchange" in plans[name] for name in ("able", "ranked"))


def test_documents_of_two_texts_link_by_both(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    rows = [(5, a), (5, b), (1, a), (9, b), (7, b + " eleven"), (8, ""), (8, a)]
    got = sorted(map(tuple, ngram_jaccard_join(table(spark, rows).repartition(4), 3, 60).collect()))
    assert got == [(1, 3, 1), (5, 3, 1), (5, 3, 5), (7, 4, 5), (8, 0, 8), (8, 3, 1), (9, 3, 5)]


def test_block_search_equals_brute_force():
    rng = np.random.default_rng(1)
    base = rng.choice(10_000, 200, replace=False)
    tokens = [np.unique(np.where(rng.random(200) < 0.04, rng.integers(0, 10_000, 200), base)) for _ in range(90)]
    sizes = np.array([len(t) for t in tokens])
    ids = np.arange(90)[::-1] + 5
    need = lambda n, m: -(-90 * (n + m) // 190)
    a, b = search_block(ids, sizes, np.zeros(90, int), tokens, lambda n: -(-90 * n // 100), need, 90, False)
    top = dict(zip(ids.tolist(), ids.tolist())) | dict(zip(a.tolist(), b.tolist()))
    want = {i: i for i in ids.tolist()}

    def root(i):
        return i if want[i] == i else root(want[i])

    for i in range(90):
        for j in range(i):
            both = len(np.intersect1d(tokens[i], tokens[j]))
            if 100 * both >= 90 * (sizes[i] + sizes[j] - both):
                p, q = sorted((root(int(ids[i])), root(int(ids[j]))))
                want[q] = p
    assert top == {i: root(i) for i in want}


def test_shingles_do_not_cross_texts():
    data, offsets = text_buffer(pa.array(["a b c", None, "", "D e", "a B c d"]))
    sets = shingle_hashes(data, offsets, 3)
    assert [len(s) for s in sets] == [1, 0, 0, 1, 2]
    assert sets[0][0] in sets[4]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


PARTS = ["a", "B", "é", "É", ".", ",", "'", "'s", "1", " ", "\n", " ", "J̌", "<|endoftext|>", "<|ENDOFTEXT|>", "ß", "İ", "Σ", "漢", "é", "\x1c", "\x85", "|", "don't", "×", "÷", "ÿ", "🙂"]


@pytest.fixture(scope="module")
def tokenizer():
    return public_tokenizer("word_bpe_49k.json")()


def whole(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), tokenizer.decode(ids, skip_special_tokens=False).encode()


def test_chunks_encode_as_whole_texts(tokenizer):
    rng = random.Random(5)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 60)))
        coder = ChunkEncoder(tokenizer, max_cached=rng.choice([0, 1 << 20]), average=rng.choice([2, 8, 64]))
        own = prepared(*text_buffer(pa.array([text])))[0]
        coder.learn([own])
        assert coder.encode(own, np.frombuffer(own, np.uint8)) == whole(tokenizer, text), text


def test_shared_chunks_are_cut_alike():
    rng = np.random.default_rng(2)
    shared = rng.integers(97, 123, 4000).astype(np.uint8)
    a = np.concatenate([rng.integers(97, 123, 333).astype(np.uint8), shared])
    cuts, moved = set(cut_points(shared, 64).tolist()), {c - 333 for c in cut_points(a, 64).tolist()}
    assert {c for c in cuts if c > 600} == {c for c in moved if c > 600} != set()


def test_encoded_table(spark, tokenizer):
    run = "x" * 50_000
    rows = [(1, None), (2, ""), (3, "Hello, World."), (3, "Hello, World."), (None, "  "), (4, run), (5, "It's 2 << 3 |é|")]
    found = encode_documents(table(spark, rows), public_tokenizer("word_bpe_49k.json"), keep_ids=True).collect()
    want = sorted(((i, *whole(tokenizer, t or "")) for i, t in rows), key=str)
    got = sorted(((r["doc_id"], np.array(r["ids"], "<u4").tobytes(), r["decoded"].encode()) for r in found), key=str)
    assert got == want
    for r in found:
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest()
    assert encode_documents(table(spark, []), public_tokenizer("word_bpe_49k.json")).collect() == []


def test_op6_on_the_given_table(spark, data, tokenizer):
    texts = dict(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect())
    found = QUERIES["op6_bpe_encoding"](spark, data).collect()
    assert len(found) == len(texts)
    for r in found:
        ids, said = whole(tokenizer, texts[r["doc_id"]])
        assert (r["ids_sha256"], r["decoded_sha256"]) == (hashlib.sha256(ids).hexdigest(), hashlib.sha256(said).hexdigest())


def test_op4_on_the_given_table(spark, data):
    docs = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in QUERIES["op4_ngram_jaccard_join"](spark, data).collect()} == brute_components(docs, 3, 90)


def test_op2_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    found = QUERIES["op2_quality_classifier"](spark, sf).collect()
    assert len(found) == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert np.mean([b for a, b in held if a == 1]) > 0.98


def test_quality_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (3, "ab"), (4, "word " * 200_000), (None, "!!")]
    docs = table(spark, rows)
    none = train_quality(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    assert {r["score"] for r in score_quality(docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1, None), (2, None, 0), (None, 0, 0), (3, 7, 0)], "doc_id bigint, quality int, toxic int")
    network = train_quality(docs, odd)
    kept = score_quality(docs, network, keep=True)
    assert kept.columns == [*[c for c in docs.columns if c != "score"], "score"]
    assert kept.count() == 6 and all(r["score"] > 0.5 for r in kept.collect())
    assert score_quality(table(spark, []), network).collect() == []


def test_score_does_not_depend_on_batches(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    network = train_quality(docs, spark.read.parquet(f"{data}/labels.parquet"), fold("doc_id", 3) == 1, max_sample=60)
    one = dict(score_quality(docs.coalesce(1), network).collect())
    many = dict(score_quality(docs.repartition(7), network).collect())
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-5 for k in one)


def test_op8_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    langs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect())
    found = QUERIES["op8_language_id"](spark, sf).collect()
    assert len(found) == 10_000 and all(0 <= r["score"] <= 1 for r in found)
    held = [langs[r["doc_id"]] == r["lang_pred"] for r in found if r["held_out"]]
    assert np.mean(held) > 0.97


def test_language_of_odd_rows(spark):
    text = {"en": "the cat and the dog with that ", "de": "der hund und die katze nicht ", "xx": None}
    rows = [(i, text["de" if i % 3 else "en"] * (1 + i % 4), "de" if i % 3 else "en") for i in range(60)]
    docs = spark.createDataFrame([(i, t, x, None, None, "s", 0) for i, t, x in rows] + [(70, None, "en", None, None, "s", 0), (71, "42 !", None, None, None, "s", 0), (72, "", "de", None, None, "s", 0), (73, "the dog " * 50_000, None, None, None, "s", 0), (73, "the dog", None, None, None, "s", 0)], DOCS)
    found = [(r["doc_id"], r["lang_pred"], r["score"]) for r in predict_languages(docs, train_languages(docs)).collect()]
    by_id = {i: (x, s) for i, x, s in found}
    assert [by_id[i] for i in (70, 71, 72)] == [("und", 0.0)] * 3
    assert by_id[73][0] == "en" and len(found) == 65
    assert all(by_id[i][0] == x for i, _, x in rows)
    nothing = train_languages(docs.where("doc_id < 0"))
    assert {r["lang_pred"] for r in predict_languages(docs, nothing).collect()} == {"und"}
    assert predict_languages(docs.where("doc_id < 0"), nothing, keep=True).columns == [*[c for c in docs.columns if c != "score"], "lang_pred", "score"]


def plain_score(network, text):
    """The network by its definition, position by position, for one text alone."""
    data = (text or "").encode()
    padded, positions = data + bytes(WIDTH), len(data) + 1
    pooled = []
    for start in range(0, positions, STEP):
        responses = [
            [sum(float(network.table[k, padded[p + k], f]) for k in range(WIDTH)) for f in range(len(network.bias))]
            for p in range(start, min(start + STEP, positions))
        ]
        pooled.append([max(0.0, max(r[f] for r in responses) + float(network.bias[f])) for f in range(len(network.bias))])
    mean = [sum(c[f] for c in pooled) / len(pooled) for f in range(len(network.bias))]
    most = [max(c[f] for c in pooled) for f in range(len(network.bias))]
    z = sum(w * x for w, x in zip(network.weights.tolist(), mean + most)) + network.offset
    return 1 / (1 + math.exp(-z))


def test_scores_equal_the_network_on_the_text_alone():
    rng = random.Random(8)
    texts = [None, "", "a", "é", "x" * 249, "x" * 250, "x" * 251, "zzzzzzzz", "!!!!!!!!"]
    texts += ["".join(rng.choice("ab cdé.\n") for _ in range(rng.choice([3, 90, 300, 700]))) for _ in range(25)]
    network = fit_network([(t or "").encode() for t in texts], np.arange(len(texts)) % 2)
    got = score_texts(network, pa.array(texts, pa.string()))
    assert got == pytest.approx([plain_score(network, t) for t in texts], abs=1e-5)
    for order in (texts[::-1], [t for t in texts for _ in (0, 1)]):
        again = dict(zip(order, score_texts(network, pa.array(order, pa.string())).tolist()))
        assert all(abs(again[t] - score) < 1e-9 for t, score in zip(texts, got.tolist()))
    long = "many words of a text that takes several slices. " * 20_000
    assert score_texts(network, pa.array([long, "b", long]))[[0, 2]] == pytest.approx(score_texts(network, pa.array([long])).repeat(2), abs=1e-9)


def test_rows_are_bounded_where_results_are():
    column = pa.array(["x"] * 10 + ["y" * 50] + [None] * 3)
    assert list(text_pieces(column, 40, 4)) == [(0, 4), (4, 8), (8, 10), (10, 11), (11, 14)]
