"""Mixing sources to target weights by soft membership.

A classifier learned from the labelled table gives every document a posterior for each domain. A
document that is taken r times adds r times its tokens, shared among the domains by its posteriors.
Projected gradient descent on the weighted squared distance of the domains' totals from their targets
finds a rate r >= 0 for every document.

All of it is DataFrame and SQL work: features are counted by built-in functions, class statistics and
every step of the descent are aggregates, and only a few numbers for each domain reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import stage

DOMAINS = ("clean", "toxic", "low")
MAX_SAMPLE = 2_000  # labelled rows of a domain from which marker words are learned, at most
MARKERS = 40  # marker words of a domain, at most
STEPS = 25
TOLERANCE = 1e-6  # of the totals, relative to all tokens

# Labelled rows as domains: of low quality first, then toxic.
DOMAIN = "CASE WHEN quality = 0 THEN 'low' WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'clean' END"


def _labelled(labels: DataFrame) -> DataFrame:
    """doc_id and domain; the greatest domain of rows that share an id, none without labels."""
    rows = labels.select(
        labels["doc_id"].cast("bigint").alias("doc_id"), labels["quality"].cast("int").alias("quality"),
        labels["toxic"].cast("int").alias("toxic"),
    ).where("doc_id is not null")
    return rows.select("doc_id", F.expr(DOMAIN).alias("domain")).where("domain is not null").groupBy("doc_id").agg(
        F.max("domain").alias("domain")
    )


def _words(text: Column) -> Column:
    """Words between white space, with their punctuation."""
    return F.filter(F.split(F.translate(text, "\t\n\r\v\f", "     "), " "), lambda w: w != "")


def _markers(texts: DataFrame, labelled: DataFrame) -> dict[str, list[str]]:
    """Words that more of the sampled documents of a domain have than of the others.

    The sample has at most MAX_SAMPLE rows of each domain, by a hash of their ids; a marker is in a
    twentieth of its domain's rows and five times as frequent there as elsewhere.
    """
    parts = [
        labelled.where(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_SAMPLE)
        for d in DOMAINS
    ]
    sample = parts[0].union(parts[1]).union(parts[2])
    rows = texts.join(F.broadcast(sample), "doc_id").select("domain", "doc_id", F.explode(F.array_distinct(_words(F.col("text")))).alias("word"))
    rows = rows.where(F.length("word") > 2)
    sizes = {r["domain"]: r["n"] for r in sample.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = rows.groupBy("word").agg(
        *[F.count(F.when(F.col("domain") == d, 1)).alias(d) for d in DOMAINS]
    )
    share = {d: F.col(d) / float(sizes.get(d, 0) or 1) for d in DOMAINS}
    found = {}
    for d in DOMAINS:
        others = F.greatest(*[share[o] for o in DOMAINS if o != d])
        lead = share[d] / (others + 0.002)
        # At most MARKERS rows come back.
        top = words.where((share[d] >= 0.05) & (lead >= 5)).orderBy(F.desc(lead), "word").limit(MARKERS).collect()
        found[d] = [r["word"] for r in top]
    return found


def _features(text: Column, words: Column, markers: dict[str, list[str]]) -> dict[str, Column]:
    """What a document is judged by: counts over its whole text, on scales that suit normal laws."""
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    length = F.length(text) + 20.0
    features = {
        "other": F.sqrt(F.length(F.translate(text, lower + upper + " \n", "")) / length),
        "capital": F.sqrt((F.length(text) - F.length(F.translate(text, upper, ""))) / length),
        "variety": F.log((F.size(F.array_distinct(words)) + 1.0) / (F.size(words) + 1.0)),
    }
    for domain, found in markers.items():
        if found:
            marks = F.array(*[F.lit(w) for w in found])
            features[f"marks_{domain}"] = F.sqrt(F.size(F.array_intersect(words, marks)).cast("double"))
    return features


def domain_posteriors(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, tokens, p_clean, p_toxic, p_low of every document; the last three add up to 1.

    tokens is the number of words between white space. Features follow a normal law in every domain
    (naive Bayes), with the means and variances of all labelled documents; priors are their shares.
    Without labelled documents all domains are equally likely.
    """
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    labelled = _labelled(labels)
    markers = _markers(texts, labelled)
    text = F.coalesce("text", F.lit(""))
    features = _features(F.col("text"), F.col("words"), markers)
    # A one-element explode computes the words once for all features.
    split = texts.select("doc_id", text.alias("text")).select("doc_id", "text", F.explode(F.array(_words(F.col("text")))).alias("words"))
    tokens = F.size("words").cast("bigint")
    counted = stage(
        split.select("doc_id", tokens.alias("tokens"), *[c.cast("double").alias(n) for n, c in features.items()]), "features"
    )
    # One row for each domain comes back.
    stats = {
        r["domain"]: r
        for r in counted.join(labelled, "doc_id").groupBy("domain").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(n).alias(f"{n}_mean") for n in features], *[F.var_pop(n).alias(f"{n}_var") for n in features],
        ).collect()
    }
    all_rows = sum(r["n"] for r in stats.values())
    logs = {}
    for d in DOMAINS:
        if d not in stats:
            logs[d] = F.lit(-700.0) if stats else F.lit(0.0)
            continue
        log = F.lit(math.log(stats[d]["n"] / all_rows))
        for n in features:
            variance = stats[d][f"{n}_var"] + 1e-5
            log = log - (F.col(n) - stats[d][f"{n}_mean"]) ** 2 / (2 * variance) - 0.5 * math.log(variance)
        logs[d] = log
    given = counted.select("doc_id", "tokens", *[c.alias(f"l_{d}") for d, c in logs.items()])
    top = F.greatest(*[F.col(f"l_{d}") for d in DOMAINS])
    weighed = given.select("doc_id", "tokens", *[F.exp(F.col(f"l_{d}") - top).alias(f"e_{d}") for d in DOMAINS])
    total = sum((F.col(f"e_{d}") for d in DOMAINS[1:]), F.col(f"e_{DOMAINS[0]}"))
    return weighed.select("doc_id", "tokens", *[(F.col(f"e_{d}") / total).alias(f"p_{d}") for d in DOMAINS])


def _inverse(m: list[list[float]]) -> list[list[float]]:
    """Gauss-Jordan with a small ridge, for as many rows as there are domains."""
    n = len(m)
    scale = max(max(abs(x) for x in row) for row in m) or 1.0
    a = [[m[i][j] + (1e-9 * scale if i == j else 0.0) for j in range(n)] + [float(i == j) for j in range(n)] for i in range(n)]
    for i in range(n):
        pivot = max(range(i, n), key=lambda r: abs(a[r][i]))
        a[i], a[pivot] = a[pivot], a[i]
        a[i] = [x / a[i][i] for x in a[i]]
        for r in range(n):
            if r != i:
                a[r] = [x - a[r][i] * y for x, y in zip(a[r], a[i])]
    return [row[n:] for row in a]


def fit_rates(members: DataFrame, weights: dict[str, float], steps: int = STEPS) -> DataFrame:
    """Adds ``rate``: tokens times rate, shared by the posteriors, add up to the target of a domain.

    The targets share the present number of tokens by ``weights``; a target of 0 is one as well, a domain
    without a weight has none. See :func:`mix_report` for what is left to miss. With A the tokens of each document
    and domain, W the inverse of sum(tokens * p * p') and the documents measured by their tokens, the
    gradient of the squared distance in the norm of W is p . W (A r - target), and a step of length 1
    cannot overshoot. Each step is one aggregate over the documents; r starts at 1 and is cut at 0.
    """
    names = [d for d in DOMAINS if weights.get(d) is not None]
    share = sum(weights[d] for d in names)
    if not share > 0 or min(weights[d] for d in names) < 0:
        raise ValueError("targets must be 0 or more, one of them more")
    held = stage(members, "members")
    p = {d: F.col(f"p_{d}") for d in names}
    pairs = [(a, b) for a in names for b in names]
    row = held.agg(F.sum("tokens").alias("all"), *[F.sum(F.col("tokens") * p[a] * p[b]).alias(f"{a}_{b}") for a, b in pairs]).first()
    tokens = float(row["all"] or 0)
    if not tokens:
        return held.withColumn("rate", F.lit(1.0))
    norm = _inverse([[row[f"{a}_{b}"] / tokens for b in names] for a in names])
    target = [weights[d] / share for d in names]
    rate = F.lit(1.0)
    for _ in range(steps):
        totals = held.agg(*[F.sum(rate * F.col("tokens") * p[d]).alias(d) for d in names]).first()
        miss = [totals[d] / tokens - t for d, t in zip(names, target)]
        if max(abs(x) for x in miss) < TOLERANCE:
            break
        slope = [sum(norm[i][j] * miss[j] for j in range(len(names))) for i in range(len(names))]
        rate = F.greatest(F.lit(0.0), rate - sum((p[d] * s for d, s in zip(names, slope)), F.lit(0.0)))
    return held.withColumn("rate", rate)


def mix_report(rates: DataFrame, weights: dict[str, float]) -> DataFrame:
    """domain, share, target and miss: expected shares of the tokens taken, beside their targets.

    A domain without a target has none to miss. Shares are null where nothing is taken.
    """
    asked = sum(w for w in weights.values() if w) or 1.0
    taken = F.col("rate") * F.col("tokens")
    sums = rates.agg(F.sum(taken).alias("all"), *[F.sum(taken * F.col(f"p_{d}")).alias(d) for d in DOMAINS])
    lines = [
        F.struct(
            F.lit(d).alias("domain"), F.try_divide(F.col(d), F.col("all")).alias("share"),
            F.lit(None if weights.get(d) is None else weights[d] / asked).cast("double").alias("target"),
        )
        for d in DOMAINS
    ]
    return sums.select(F.inline(F.array(*lines))).withColumn("miss", F.col("share") - F.col("target"))


def soft_mixing(docs: DataFrame, labels: DataFrame, weights: dict[str, float]) -> DataFrame:
    """doc_id, tokens, posteriors and rate of every document, one row per document row.

    ``weights`` are the shares of tokens that clean, toxic and low documents shall have. A null text
    has no tokens and is judged as an empty one; repeated rows count each; other columns are not
    read; null labels teach nothing; rows without a doc_id keep their place and are never labelled.
    """
    return fit_rates(domain_posteriors(docs, labels), weights)


def copies_of(rate: str, doc_id: str) -> Column:
    """A whole number of copies with the rate as its mean: the fraction is decided by a hash of the id."""
    uniform = F.pmod(F.xxhash64(F.col(doc_id), F.lit("copies")), F.lit(1 << 40)) / float(1 << 40)
    return F.floor(F.col(rate) + uniform).cast("int")
