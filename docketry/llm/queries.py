"""The dealt operators as registered queries, each over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.expr import bind
from docketry.llm.ann import nearest_neighbours
from docketry.llm.bpe import encode_documents, public_tokenizer
from docketry.llm.common import read_table, shared_folder
from docketry.llm.embedding_dedup import near_duplicate_vectors
from docketry.llm.langid import predict_languages, train_languages
from docketry.llm.line_dedup import dedup_lines
from docketry.llm.mixing import soft_mixing
from docketry.llm.ngram_join import ngram_jaccard_join
from docketry.llm.quality import fold, score_quality, train_quality
from docketry.llm.resampling import importance_resample
from docketry.llm.revisits import CAPTURES, resolve_revisits
from docketry.llm.rollups import Rollup, piece_tokens, word_tokens
from docketry.llm.runs import collapse_runs
from docketry.llm.tool_calls import link_tool_calls, other_turns

Query = Callable[[SparkSession, str], DataFrame]


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labelled rows outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 3) == 1
    network = train_quality(docs, read_table(spark, sf_dir, "labels"), held_out)
    return score_quality(docs, network).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose sets of three-word shingles overlap by nine tenths."""
    return ngram_jaccard_join(read_table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, percent=90)


def op6_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids and decoded text of every document, as digests."""
    return encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 5) == 0
    model = train_languages(docs, held_out)
    return predict_languages(docs.drop("lang"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and fate of every vector at a cosine of 0.95."""
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors and rates of every document for a mix of 94, 3 and 3 per cent of the tokens."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return soft_mixing(docs, read_table(spark, sf_dir, "labels"), {"clean": 0.94, "toxic": 0.03, "low": 0.03})


def op9_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all documents came in, a fifth moved to another tokenizer version, a seventh were
    counted anew and an eleventh went, with batches that ran twice."""
    docs = read_table(spark, sf_dir, "documents")
    counted = docs.select("doc_id", "source", "lang", word_tokens(F.col("text")).alias("words"), piece_tokens(F.col("text")).alias("pieces"))
    none = F.lit(None).cast("bigint")

    def change(rows: DataFrame, op: str, version: str, tokens, old=none) -> DataFrame:
        return rows.select(F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("version"), tokens.alias("tokens"), old.alias("old_tokens"))

    words, pieces = F.col("words"), F.col("pieces")
    moved = counted.where("doc_id % 5 = 0")
    batches = {
        "b1-load": change(counted, "insert", "words-1", words),
        "b2-move": change(moved, "delete", "words-1", words).union(change(moved, "insert", "pieces-1", pieces)),
        "b3-recount": change(counted.where("doc_id % 7 = 0 and doc_id % 5 != 0"), "revise", "words-1", pieces, words),
        "b4-drop": change(counted.where("doc_id % 11 = 0 and doc_id % 5 = 0"), "delete", "pieces-1", pieces),
    }
    rollup = Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid4().hex}")
    for name, changes in batches.items():
        rollup.apply(name, changes)
    for name in ("b1-load", "b3-recount"):
        rollup.apply(name, batches[name])
    return rollup.totals()


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\r\x0B\f]+'))"
_PIECES = r"len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+|[^A-Za-z0-9 \t\n\r\x0B\f]+'))"
OP9_SQL = f"""
WITH counted AS (SELECT doc_id, source, lang, {_WORDS} AS words, {_PIECES} AS pieces FROM documents),
left_over AS (
    SELECT source, lang, CASE WHEN doc_id % 5 = 0 THEN 'pieces-1' ELSE 'words-1' END AS version,
        CASE WHEN doc_id % 5 = 0 OR doc_id % 7 = 0 THEN pieces ELSE words END AS tokens
    FROM counted WHERE NOT (doc_id % 11 = 0 AND doc_id % 5 = 0))
SELECT source, lang, version, count(*) AS docs, cast(sum(tokens) AS bigint) AS tokens
FROM left_over GROUP BY ALL"""

def op1_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the revisits among the captures of all pages stand for."""
    hashed = read_table(spark, sf_dir, "pages").select("page_id", "url", F.md5("html").alias("digest"), F.length("html").alias("size"))
    records = spark.sql(CAPTURES.replace("FROM hashed", "FROM {hashed}"), hashed=hashed)
    return resolve_revisits(records.withColumn("warc_date", F.timestamp_seconds("seconds")))


OP1_SQL = rf"""
WITH hashed AS (SELECT page_id, url, md5(html) AS digest, length(html) AS size FROM pages),
records AS ({CAPTURES.replace("LATERAL VIEW explode(array(0, 1, 2, 3)) kinds AS k", ", (SELECT unnest([0, 1, 2, 3]) AS k) AS kinds")}),
bare AS (SELECT *, regexp_replace(regexp_replace(trim(target_uri), '#.*$', ''), '^[a-z][a-z0-9+.-]*://', '', 'i') AS b FROM records),
pieces AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(b, '\?(.*)$', 1), '&'),
    lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS q FROM bare),
placed AS (SELECT *, regexp_replace(lower(regexp_extract(b, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g')
        || regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '')
        || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical,
    nullif(regexp_replace(regexp_extract(headers, '(?im)^etag[ 	]*:[ 	]*([^
]*)', 1), '^W/', ''), '') AS etag,
    nullif(trim(regexp_extract(headers, '(?im)^last-modified[ 	]*:[ 	]*([^
]*)', 1)), '') AS modified FROM pieces),
found AS (SELECT v.record_id, v.canonical AS url, v.status, v.etag, v.modified, v.headers, arg_max(r.record_id, (r.seconds, r.record_id)) AS stored_id
    FROM placed v LEFT JOIN placed r ON r.canonical = v.canonical AND r.seconds < v.seconds AND r.warc_type = 'response' AND r.status = 200
    WHERE v.warc_type = 'revisit' GROUP BY ALL),
judged AS (SELECT f.*, r.headers AS stored, CASE WHEN f.status <> 304 THEN 'not_304' WHEN stored_id IS NULL THEN 'orphan'
    WHEN f.etag IS NOT NULL AND r.etag IS NOT NULL THEN CASE WHEN f.etag = r.etag THEN 'resolved' ELSE 'changed' END
    WHEN f.modified IS NOT NULL AND r.modified IS NOT NULL THEN CASE WHEN f.modified = r.modified THEN 'resolved' ELSE 'changed' END
    ELSE 'unvalidated' END AS outcome FROM found f LEFT JOIN placed r ON r.record_id = f.stored_id),
fields AS (SELECT *, list_transform(string_split(headers, chr(10)), lambda x: {{'name': lower(trim(split_part(x, ':', 1))), 'value': trim(regexp_replace(x, '^[^:]*:', ''))}}) AS new,
    list_transform(string_split(stored, chr(10)), lambda x: {{'name': lower(trim(split_part(x, ':', 1))), 'value': trim(regexp_replace(x, '^[^:]*:', ''))}}) AS old FROM judged),
fresh AS (SELECT *, list_filter(new, lambda f: f.name NOT IN ('connection', 'content-encoding', 'content-length', 'content-md5', 'content-range', 'content-type',
    'keep-alive', 'proxy-authenticate', 'proxy-connection', 'te', 'trailer', 'transfer-encoding', 'upgrade')) AS kept FROM fields)
SELECT record_id, url, outcome, CASE WHEN outcome IN ('resolved', 'unvalidated') THEN stored_id END AS refers_to,
    CASE WHEN outcome IN ('resolved', 'unvalidated') THEN array_to_string(list_sort(list_transform(list_concat(
        list_filter(old, lambda f: NOT list_contains(list_transform(kept, lambda g: g.name), f.name)), kept), lambda f: f.name || ': ' || f.value)), chr(10)) END AS headers
FROM fresh"""


# Tools that the turns of conversations call; arguments go wrong in ways that a schema tells.
CALLS = """
SELECT conv_id, turn, concat('c', CAST(conv_id AS string), '-', CAST(turn AS string)) AS call_id,
    CASE turn % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'summarize' ELSE 'translate' END AS name,
    CASE WHEN turn >= 3 THEN concat('c', CAST(conv_id AS string), '-', CAST(2 * floor(((turn - 1) / 2 - 1) / 2) + 1 AS bigint)) END AS follows, text
FROM conversations WHERE role = 'assistant'"""


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole chats: calls made of all assistant turns, their results of the user turns that follow, and all other turns."""
    conversations = read_table(spark, sf_dir, "conversations")
    made = spark.sql(
        CALLS.replace("FROM conversations", "FROM {conversations}").replace("((turn - 1) / 2 - 1) / 2", "(((turn - 1) div 2) - 1) / 2"),
        conversations=conversations,
    )
    arguments = F.expr("""to_json(CASE WHEN conv_id % 9 = 0 THEN named_struct('turn', CAST(turn AS string), 'text', text, 'strict', null, 'extra', null)
        WHEN conv_id % 10 = 0 THEN named_struct('turn', CAST(null AS string), 'text', text, 'strict', true, 'extra', 'x')
        ELSE named_struct('turn', CAST(null AS string), 'text', text, 'strict', conv_id % 2 = 0, 'extra', CAST(null AS string)) END)""")
    number = F.when(F.expr("conv_id % 9 <> 0"), F.concat(F.expr("left(a, length(a) - 1)"), F.lit(',"turn":'), F.col("turn").cast("string"), F.lit("}"))).otherwise(F.col("a"))
    calls = made.withColumn("a", arguments).select(
        "conv_id", "turn", "call_id", "name", number.alias("arguments"), F.array("follows").alias("after")
    )
    results = conversations.where("role = 'user' and turn > 0").select(
        F.expr("concat('c', CAST(conv_id AS string), '-', CAST(turn - 1 AS string))").alias("call_id"), F.col("text").alias("content")
    )
    schemas = spark.sql("""SELECT t.name, r.* FROM VALUES ('search'), ('summarize') AS t(name)
        LATERAL VIEW inline(array(struct('text', 'string', true), struct('turn', 'integer', true), struct('strict', 'boolean', false))) r AS argument, type, required""")
    linked = link_tool_calls(calls, results, schemas)
    rest = conversations.where("role not in ('assistant', 'user') or role is null or (role = 'user' and turn = 0) or turn is null")
    return linked.unionByName(other_turns(rest))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that three of them or more have, but for the last that has them."""
    kept = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), least=3, least_chars=20)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = r"""
WITH whole AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
placed AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS place, unnest(string_split(text, chr(10))) AS line FROM whole),
keyed AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM placed),
counted AS (SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.*, coalesce(k.doc_id < c.last_doc, false) AS dropped FROM keyed k LEFT JOIN counted c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A twentieth of the longer documents, drawn to look like the benchmark."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance_resample(docs, read_table(spark, sf_dir, "benchmark").select("text"), percent=5, least_words=20)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every document; a tenth of them is first made periodic from some word on."""
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(words):
        n = F.size(words).cast("bigint")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.transform(
            F.sequence(F.lit(0).cast("bigint"), n - 1),
            lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")),
        )

    found = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    made = bind(found, lambda words: F.when(F.size(words) > 0, F.array_join(periodic(words), " ")).otherwise(""))
    runs = collapse_runs(docs.withColumn("text", F.when(h % 10 == 0, made).otherwise(F.col("text"))))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    told = runs.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    return told.select(
        "doc_id", "n_runs", (-F.col("best.back")).alias("start"), "best.length", (-F.col("best.short")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.short")).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_revisit_resolution, op2_quality_classifier, op3_embedding_dedup, op4_ngram_jaccard_join, op5_soft_mixing, op6_bpe_encoding,
        op7_tool_calls, op8_language_id, op9_token_rollup, op10_nearest_neighbours,
        op11_line_dedup, op12_importance_resampling, op13_periodic_runs,
    )
}
ORACLES: dict[str, str] = {"op1_revisit_resolution": OP1_SQL, "op9_token_rollup": OP9_SQL, "op11_line_dedup": OP11_SQL}
