"""Keyword evidence and the model-free classifier built on it.

A keyword counts when it occurs as a whole word, ignoring case: on both sides there is an end
of the text or one character that is neither letter nor digit.

A small taxonomy becomes part of the plan: each text is normalised once, with a mark at both ends of
every run of letters and digits, and then searched for marked keywords, which are constants. A large
one is joined: texts are cut into grams of the lengths that keywords have, and grams and keywords
meet by equality.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.functions.expr import compute_once
from docketry.sources.taxonomy import MAX_LABELS

FALLBACK_LABEL = "Other"
MOST_CONSTANTS = 500  # keywords that a plan holds at most; more are joined
TASK_CHARACTERS = 8_000_000  # of text whose grams one task sorts and counts

_RUN = r"[\p{L}\p{N}]+"
_TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]"
_MARK = "\x01"
_ALNUM = r"[\p{L}\p{N}]"


def _marked(text: Column) -> Column:
    """Lower case, with a mark at both ends of every run of letters and digits."""
    bare = F.translate(F.lower(text), _MARK, "\x02")
    return F.regexp_replace(bare, f"({_RUN})", f"{_MARK}$1{_MARK}")


def _keywords(taxonomy: DataFrame) -> DataFrame:
    """``ordinal, event_type, relevant, word, marked, plain`` of all keywords, each once for a label.

    ``plain`` keywords begin and end with a letter or digit, so that their marks are those of the text.
    """
    named = taxonomy.select(
        "ordinal", "event_type", "relevant", F.explode_outer(F.array_distinct(F.transform("keywords", F.lower))).alias("word")
    )
    edges = F.rlike(F.substring("word", 1, 1), F.lit(_ALNUM)) & F.rlike(F.right(F.col("word"), F.lit(1)), F.lit(_ALNUM))
    return named.withColumns({"marked": _marked(F.col("word")), "plain": edges})


def _occurs(marked: Column, lowered: Column, word: str, mark: str, plain: bool) -> Column:
    if plain:
        return F.contains(marked, F.lit(mark))
    if not word:
        pattern = r"(?:\A|[^\p{L}\p{N}])(?:\z|[^\p{L}\p{N}])"
    else:
        quoted = "".join(c if c.isalnum() else rf"\x{{{ord(c):x}}}" for c in word)
        pattern = rf"(?<![\p{{L}}\p{{N}}]){quoted}(?![\p{{L}}\p{{N}}])"
    return F.contains(lowered, F.lit(word)) & F.rlike(lowered, F.lit(pattern))


def _constants(taxonomy: DataFrame) -> list | None:
    """All keywords, label by label; none if they are too many to be part of a plan."""
    found = _keywords(taxonomy).orderBy("ordinal", "event_type", "word").limit(MOST_CONSTANTS + 1).collect()
    return None if len(found) > MOST_CONSTANTS else found


def _hits(found: list) -> Column:
    """``array<struct<ordinal, event_type, relevant, hits>>`` from ``__marked`` and ``__lowered``."""
    labels: dict[tuple, list] = {}
    for row in found:
        labels.setdefault((row["ordinal"], row["event_type"], row["relevant"]), [])
        if row["word"] is not None:
            labels[row["ordinal"], row["event_type"], row["relevant"]].append(row)
    entries = []
    for (ordinal, label, relevant), words in labels.items():
        tests = [_occurs(F.col("__marked"), F.col("__lowered"), r["word"], r["marked"], r["plain"]).cast("int") for r in words]
        entries.append(
            F.struct(
                F.lit(ordinal).cast("int").alias("ordinal"), F.lit(label).alias("event_type"),
                F.lit(relevant).cast("boolean").alias("relevant"), reduce(add, tests, F.lit(0)).alias("hits"),
            )
        )
    return F.array(*entries)


def with_keyword_hits(
    df: DataFrame, taxonomy: DataFrame, text_col: str = "text", out: str = "keyword_hits"
) -> DataFrame:
    """X1 as one array per document, in taxonomy order; no join, no shuffle.

    The taxonomy, which may have MOST_CONSTANTS keywords here, is read when this is called. See
    :func:`keyword_hits` for larger ones. A null text has a null array.
    """
    found = _constants(taxonomy)
    if found is None:
        raise ValueError(f"more than {MOST_CONSTANTS} keywords: use keyword_hits or give keyword_classify a key")
    text = F.col(text_col)
    both = F.struct(_marked(text).alias("marked"), F.lower(text).alias("lowered"))
    normal = compute_once(df, "__normal", both)
    normal = normal.withColumns({"__marked": F.col("__normal.marked"), "__lowered": F.col("__normal.lowered")})
    hits = F.when(F.col(text_col).isNotNull(), _hits(found))
    return compute_once(normal, out, hits).drop("__normal", "__marked", "__lowered")


def _joined_hits(df: DataFrame, taxonomy: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """Rows of ``keys, ordinal, event_type, relevant, hits`` by equality of grams and keywords.

    Partitions are as many as the texts are long, so that a task holds no more where there are more texts.
    """
    tokens_of = lambda text: F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    words = _keywords(taxonomy).filter("word != ''").select("ordinal", "event_type", "relevant", "word", F.size(tokens_of(F.col("word"))).alias("size"))
    # One row for each length that keywords have, in tokens.
    sizes = sorted(r["size"] for r in words.select("size").distinct().limit(MAX_LABELS).collect())
    texts = compute_once(df.select(*keys, F.lower(text_col).alias("__text")), "__tokens", tokens_of(F.col("__text")))
    alnum = F.transform("__tokens", lambda t: F.rlike(F.substring(t, 1, 1), F.lit(_ALNUM)))
    texts = compute_once(texts.drop("__text"), "__alnum", alnum)

    def grams(size: int) -> Column:
        """Grams of so many tokens that are whole words: no letter or digit next to their ends."""
        starts = F.sequence(F.lit(0), F.size("__tokens") - size)

        def whole(i: Column) -> Column:
            inside, count = F.col("__alnum"), F.size("__tokens")
            before = F.when(i > 0, ~(F.get(inside, i - 1))).otherwise(True) | F.get(inside, i)
            after = F.when(i + size < count, ~(F.get(inside, i + size))).otherwise(True) | F.get(inside, i + size - 1)
            return before & after

        made = F.transform(F.filter(starts, whole), lambda i: F.array_join(F.slice("__tokens", i + 1, F.lit(size)), ""))
        return F.when(F.size("__tokens") >= size, made).otherwise(F.array().cast("array<string>"))

    every = F.array_distinct(F.concat(*[grams(size) for size in sizes])) if sizes else F.array().cast("array<string>")
    cut = texts.select(*keys, F.explode(every).alias("word"))
    length = df.agg(F.sum(F.length(text_col))).first()[0] or 0
    tasks = length // TASK_CHARACTERS + 1
    met = cut.repartition(tasks, "word").join(words.drop("size").repartition(tasks, "word"), "word")
    return met.groupBy(*keys, "ordinal", "event_type", "relevant").agg(F.count_distinct("word").cast("int").alias("hits"))


def keyword_hits(
    df: DataFrame, taxonomy: DataFrame, key: str | list[str], text_col: str = "text"
) -> DataFrame:
    """X1 as rows: distinct keywords found per document and label, zero hits left out.

    Beyond MOST_CONSTANTS keywords, texts meet them by an equi-join on grams; rows with one key then
    count as one document, an empty keyword finds nothing. ``df`` is then read twice, first for the length
    of its texts: write it down before if it is costly.
    """
    keys = [key] if isinstance(key, str) else key
    if _constants(taxonomy) is None:
        return _joined_hits(df, taxonomy, keys, text_col).select(*keys, "event_type", "hits")
    found = with_keyword_hits(df, taxonomy, text_col).select(
        *keys, F.inline(F.filter("keyword_hits", lambda h: h["hits"] > 0))
    )
    return found.select(*keys, "event_type", "hits")


def _fallback(taxonomy: DataFrame) -> Column:
    first = F.min_by(F.struct("event_type", "relevant"), "ordinal")
    return taxonomy.filter(F.col("event_type") == FALLBACK_LABEL).agg(first.alias("other")).scalar()


def keyword_classify(
    df: DataFrame, taxonomy: DataFrame, text_col: str = "text", key: str | list[str] | None = None
) -> DataFrame:
    """Add ``event_type``, ``relevant`` and ``hits`` by the label with most keywords.

    Ties go to the earlier label. Without any hit the label is ``Other`` if the taxonomy has
    it, else null. Null text stays unclassified. A taxonomy of more than MOST_CONSTANTS keywords needs
    a ``key`` that is different for every row, to join on.
    """
    best = F.struct("hits", (-F.col("ordinal")).alias("rank"), "event_type", "relevant")
    if _constants(taxonomy) is None and key is not None:
        keys = [key] if isinstance(key, str) else key
        top = _joined_hits(df, taxonomy, keys, text_col).groupBy(*keys).agg(F.max(best).alias("__best"))
        scored = df.join(top, keys, "left")
    else:
        scored = with_keyword_hits(df, taxonomy, text_col, "__hits")
        ranked = F.transform(
            F.filter("__hits", lambda h: h["hits"] > 0),
            lambda h: F.struct(h["hits"].alias("hits"), (-h["ordinal"]).alias("rank"), h["event_type"].alias("event_type"), h["relevant"].alias("relevant")),
        )
        scored = scored.withColumn("__best", F.array_max(ranked))
    scored = scored.withColumn("__other", F.when(F.col(text_col).isNotNull(), _fallback(taxonomy)))

    def pick(field: str) -> Column:
        return F.coalesce(f"__best.{field}", f"__other.{field}").alias(field)

    no_hits = F.when(F.col(text_col).isNotNull(), F.lit(0))
    return scored.select(
        *df.columns,
        pick("event_type"),
        pick("relevant"),
        F.coalesce("__best.hits", no_hits).alias("hits"),
    )
