"""N-gram Jaccard join by T-occurrence search (DivideSkip).

Two documents link if the overlap of their sets of word n-grams reaches the similarity. The search
is exact and goes in two steps of the same kind.

1. Signatures. Of a set of n hashed n-grams, the 2 * (n - ceil(s * n)) + 1 smallest hashes are its
   signature; two sets that link have a certain number k of them in common. A count of all signature
   tokens tells which occur in one set alone. Only documents with enough shared tokens go on (few of
   them do, if their texts are their own); each is sent to the blocks of its rarest tokens (tokens of
   the same documents make one block), and a T-occurrence search in each block finds which signatures
   have k tokens in common. Two blocks for each document connect most of what belongs together; the
   others are searched for documents with k tokens that other components have, too, and there only
   between components. Blocks that overlap a lot become one.
2. Whole sets. The components of the first step are the blocks of the second, which gets each set
   once and searches for the overlap that the similarity asks for.

In a block, its most typical documents first meet all others, which connects large groups of
near-copies. Then the inverted lists of a query's tokens are divided: short lists are merged, which leaves
the documents that can still reach the threshold T, and these are looked up in the long lists by
binary search. A document that is already connected to the query is not looked at again, so a block
gives back a forest of links and never all pairs of a group. Blocks that would grow large are split:
every two parts of a group meet in one block.

Documents with equal sets are one class from the beginning; copies are not compared.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import (
    U64, Forest, components, drop_staged, in_groups, mix, stage, text_buffer, text_pieces, tidy,
)

WORDS = 5
PERCENT = 80
BLOCK_DOCS = 4_096  # documents of one part of a block
BLOCK_TOKENS = 1 << 22
PIECE_BYTES = 2 << 20
PROBES = 128  # long lists that are probed in one call
CENTRES = 48  # documents of a block that are compared with all of it before the search
SHORT = 0.0085  # weighs probing against merging, as published for DivideSkip

BUCKETS = 1_024  # bitmaps of 4,096 bytes in a filter, so that it never takes more than 4 MB
BITS = 32_768

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_BASE = U64(0xD1342543DE82EF95)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([np.ones(1, U64), np.full(max(n - 1, 0), _BASE, U64)]))


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's n-grams of ``words`` lower-cased words.

    A text with fewer words is one n-gram; a text without words has none.
    """
    empty = np.zeros(0, np.int64)
    out = [empty] * (len(offsets) - 1)
    if not len(data):
        return out
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] = solid[inner]  # words end with their text
    starts = np.flatnonzero(begins)
    if not len(starts):
        return out
    run = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data)))) if starts[0] == 0 else None
    if run is None:
        run = np.arange(len(data))
        run[starts[0]:] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    value = np.where(solid, _BYTES[_LOWER[data]] * _powers(int(run.max()) + 1)[run], U64(0))
    word = mix(np.add.reduceat(value, starts))
    of = np.searchsorted(offsets, starts, "right") - 1
    edges = np.searchsorted(of, np.arange(len(offsets)))
    gram = np.zeros(max(len(word) - words + 1, 0), U64)
    for k in range(words):
        gram = gram * _BASE + word[k: k + len(gram)]
    gram = mix(gram ^ U64(words))
    for doc in np.unique(of).tolist():
        a, b = int(edges[doc]), int(edges[doc + 1])
        if b - a >= words:
            out[doc] = np.unique(gram[a: b - words + 1].view(np.int64))
        else:
            few = word[a:b] * _powers(b - a)[::-1]
            out[doc] = mix(few.sum(keepdims=True, dtype=U64) ^ U64(b - a)).view(np.int64)
    return out


def required(n: int, percent: int) -> int:
    """The overlap that a set of n needs with any set that links to it: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


def shared_tokens(n: int, percent: int) -> int:
    """How many signature tokens a set of n and a linked set of no other k have in common."""
    return n - required(n, percent) + 1


def least_shared(n: int, percent: int) -> int:
    """The same with the smallest set that can link to it."""
    return shared_tokens(required(n, percent), percent)


def divide_skip(
    posting: np.ndarray, starts: np.ndarray, lengths: np.ndarray, need: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges the short of the lists that begin in ``posting`` at ``starts``: members that can reach
    ``need``, their counts so far, and which long lists are left to probe, the shortest first."""
    order = np.argsort(lengths, kind="stable")
    longest = int(lengths[order[-1]])
    aside = min(int(need / (SHORT * np.log2(longest + 1) + 1)), need - 1, len(order) - 1)
    short, long = order[: len(order) - aside], order[len(order) - aside:]
    begins, sizes = starts[short], lengths[short]
    total = int(sizes.sum())
    if total <= 256:
        lists = [posting[a: a + n].tolist() for a, n in zip(begins.tolist(), sizes.tolist())]
        runs = [(k, len(list(g))) for k, g in groupby(heapq.merge(*lists))]
        members, counts = np.array([r[0] for r in runs], np.int64), np.array([r[1] for r in runs], np.int64)
    else:  # numpy's stable sort merges the sorted runs, as the heap does
        within = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        merged = np.sort(posting[np.repeat(begins, sizes) + within], kind="stable")
        first = np.flatnonzero(np.append(True, merged[1:] != merged[:-1]))
        members, counts = merged[first].astype(np.int64), np.diff(np.append(first, total))
    able = counts >= need - aside
    return members[able], counts[able], long


def centres(
    sizes: np.ndarray, label: np.ndarray, token: np.ndarray, lengths: np.ndarray,
    needed: Callable[[int, np.ndarray], np.ndarray], percent: int,
) -> np.ndarray:
    """Labels after the most typical documents of a block met all the others.

    Near-copies of one text mostly link to the one with the most common tokens, so a few passes over
    the tokens connect a large group; only documents of other labels are left to search for. What
    these passes miss, the search finds.
    """
    if not lengths.all():  # an empty set has nothing to add up
        return label
    starts = np.cumsum(lengths) - lengths
    common = np.add.reduceat(np.bincount(token)[token], starts) / lengths
    for _ in range(min(CENTRES, len(sizes))):
        c = int(np.argmax(common))
        n = int(sizes[c])
        mark = np.zeros(int(token.max()) + 1, np.int32)
        mark[token[starts[c]: starts[c] + lengths[c]]] = 1
        shared = np.add.reduceat(mark[token], starts)
        small, large = np.minimum(sizes, n), np.maximum(sizes, n)
        met = (shared >= needed(n, sizes)) & (100 * small >= percent * large)
        met[c] = True
        common[met] = -1
        joined = np.unique(label[met])
        if len(joined) > 1:
            label = np.where(np.isin(label, joined), joined[0], label)
        if common.max() < 0 or (label == label[0]).all():
            break
    return label


def search_block(
    ids: np.ndarray, sizes: np.ndarray, parts: np.ndarray, tokens: list[np.ndarray],
    least: Callable[[int], int], needed: Callable[[int, np.ndarray], np.ndarray], percent: int, across: bool,
    labels: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the links of a block, as (member, smallest member of its tree).

    ``least`` is the least overlap a document of that size needs, ``needed`` the overlap with
    documents of given sizes. With ``across``, only documents of different ``parts`` are compared.
    Documents of one label are known to be connected: by ``labels``, or by the centres of the block.
    The most frequent label is only searched, never a query, as every pair of different labels has a
    document of another one.
    """
    labels = ids if labels is None else labels
    if len(ids) == 2:  # one list each: the merge is the whole search
        n = int(sizes.max())
        known = labels[0] == labels[1] or (across and parts[0] == parts[1])
        if known or sizes.min() < required(n, percent) or (
            len(np.intersect1d(*tokens, assume_unique=True)) < needed(n, sizes.min(keepdims=True))[0]
        ):
            return ids[:0], ids[:0]
        return ids.max(keepdims=True), ids.min(keepdims=True)
    _, label, count = np.unique(labels, return_inverse=True, return_counts=True)
    if len(count) == 1:
        return ids[:0], ids[:0]
    lengths = np.array([len(t) for t in tokens])
    token = np.unique(np.concatenate(tokens), return_inverse=True)[1]
    label = centres(sizes, label, token, lengths, needed, percent)
    _, label, count = np.unique(label, return_inverse=True, return_counts=True)
    order = np.lexsort((ids, sizes, label != np.argmax(count)))
    searched = int(count.max())
    ids, sizes, parts, label = ids[order], sizes[order], parts[order], label[order]
    begins, lengths = (np.cumsum(lengths) - lengths)[order], lengths[order]
    token = token[np.repeat(begins - np.cumsum(lengths) + lengths, lengths) + np.arange(len(token))]
    owner = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
    by_token = np.argsort(token, kind="stable")
    posting = owner[by_token]
    entries = token[by_token].astype(np.int64) * len(ids) + posting  # all lists as one sorted one
    start = np.concatenate([[0], np.cumsum(np.bincount(token))])
    ends = np.cumsum(lengths)
    filled = np.bincount(token[: ends[searched - 1]], minlength=len(start) - 1)  # entries before the query
    forest = Forest(len(ids))
    _, first = np.unique(label, return_index=True)
    for x, y in enumerate(first[label].tolist()):
        forest.join(x, y)
    for x in range(searched, len(ids)):
        own = token[ends[x] - lengths[x]: ends[x]]
        live = own[filled[own] > 0]
        n = int(sizes[x])
        need = least(n)
        if len(live) >= need:
            found, counts, long = divide_skip(posting, start[live], filled[live], need)
            long = live[long].astype(np.int64)
            if len(found):
                near = (label[found] != label[x]) & (sizes[found] >= required(n, percent)) & (percent * sizes[found] <= 100 * n)
                if across:
                    near &= parts[found] != parts[x]
                found, counts = found[near], counts[near]
            best = np.argsort(-counts, kind="stable")
            found, counts = found[best], counts[best]
            while len(found):
                batch, held = found[:64], counts[:64].copy()
                found, counts = found[64:], counts[64:]
                reach = needed(n, sizes[batch])
                for at in range(0, len(long), PROBES):
                    able = held + len(long) - at >= reach
                    if not able.all():
                        batch, held, reach = batch[able], held[able], reach[able]
                    if not len(batch):
                        break
                    probes = long[at: at + PROBES, None] * len(ids) + batch
                    place = np.minimum(np.searchsorted(entries, probes), len(entries) - 1)
                    held += (entries[place] == probes).sum(axis=0)
                for y in batch[held >= reach].tolist():
                    forest.join(x, y)
                if len(found):
                    mine = forest.root(x)
                    apart = np.fromiter((forest.root(y) != mine for y in found.tolist()), bool, len(found))
                    found, counts = found[apart], counts[apart]
        filled[own] += 1
    roots = forest.roots()
    smallest = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(smallest, roots, ids)
    top = smallest[roots]
    linked = top != ids
    return ids[linked], top[linked]


def _parts(keys: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (key, id, s, part): the blocks of ``keys`` (key, id) with ``sets`` (id, label, weight), and which
    of s parts of a block a set belongs to.

    A block has sets of different labels; others have nothing left to connect. Keys with the same documents are
    one block, named by the least of them, since rare tokens of near-copies mostly come together. So are blocks
    with the same least id, where a set is then sent less often: near-copies have many keys that all but a few of
    them share. A group within the bounds has one part; those of a larger one go by a hash of the id. Only ids and
    weights are grouped.
    """
    def parts(docs: str, weight: str) -> Column:
        return F.ceil(F.greatest(F.col(docs) / BLOCK_DOCS, F.col(weight) / BLOCK_TOKENS))

    keys = keys.join(sets, "id")
    groups = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("weight").alias("weight"), F.min("id").alias("first"),
        F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("two"),
        F.min("label").alias("low"), F.max("label").alias("high"),
    ).where("low != high")
    once = groups.groupBy("docs", "first", "one", "two").agg(
        F.min("key").alias("key"), F.max(parts("docs", "weight")).alias("s"),
    )
    held = stage(keys.select("key", "id", "weight").join(once.select("key", "first", "s"), "key"), "held")
    joint = (
        held.groupBy("first", "id").agg(F.min("key").alias("key"), F.max("weight").alias("weight"), F.sum("s").alias("sent"))
        .groupBy("first").agg(
            F.min("key").alias("least"), F.count(F.lit(1)).alias("docs"), F.sum("weight").alias("weight"), F.sum("sent").alias("sent"),
        )
        .select("first", "least", "docs", "sent", parts("docs", "weight").alias("all")).where("docs * all <= sent")
    )
    blocks = held.join(joint.select("first", "least", "all"), "first", "left").select(
        F.coalesce("least", "key").alias("key"), "id", F.coalesce("all", "s").alias("s"),
    )
    placed = stage(blocks.distinct().select("*", F.pmod(F.xxhash64("id"), F.col("s")).alias("part")), "blocks")
    drop_staged(held)
    return placed


def _sent(placed: DataFrame) -> DataFrame:
    """Every row of (s, part, ...) for each of the s blocks (i, j) in which its part meets all parts."""
    others = [name for name in placed.columns if name != "s"]
    each = placed.select(*others, F.explode(F.sequence(F.lit(0), F.col("s").cast("int") - 1)).alias("k"))
    return each.select(*others, F.least("part", "k").alias("i"), F.greatest("part", "k").alias("j"))


def _search(sent: DataFrame, percent: int, whole: bool) -> DataFrame:
    """Links (a, b) of all blocks of ``sent`` (key, i, j, part, id, label, n, tokens); on whole sets, or on signatures.

    Sets of one ``label`` are known to be connected. A set that a block has twice is looked at once.
    """
    def least(n: int) -> int:
        return required(n, percent) if whole else least_shared(n, percent)

    def needed(n: int, sizes: np.ndarray) -> np.ndarray:
        if whole:
            return -(-percent * (n + sizes) // (100 + percent))
        smaller = np.minimum(sizes, n)  # k grows with the size of the set
        return smaller - -(-percent * smaller // 100) + 1

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), group in in_groups(batches, ["key", "i", "j"]):
            columns: list[list] = [[], [], [], []]
            tokens: list[np.ndarray] = []
            seen: set[int] = set()
            for batch in group:
                new = []
                for x in batch.column("id").to_pylist():
                    new.append(x not in seen)
                    seen.add(x)
                if not all(new):
                    batch = batch.filter(pa.array(new))
                for held, name in zip(columns, ("id", "n", "part", "label")):
                    held.append(np.asarray(batch.column(name)))
                lists = batch.column("tokens")
                flat = np.asarray(lists.flatten())
                tokens += np.split(flat, np.cumsum(np.asarray(pa.compute.list_value_length(lists)))[:-1])
            if len(tokens) < 2:
                continue
            ids, sizes, parts, labels = (np.concatenate(c).astype(np.int64) for c in columns)
            a, b = search_block(ids, sizes, parts, tokens, least, needed, percent, i != j, labels)
            if len(a):
                yield pa.RecordBatch.from_pydict({"a": a, "b": b})

    sent = sent.select("key", "i", "j", "part", "id", "label", "n", "tokens")
    sent = sent.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return sent.mapInArrow(tidy(search), "a bigint, b bigint")


def _search_signatures(keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of ``sets`` (id, label, n, tokens) that meet by ``keys`` (key, id).

    Tokens are attached at the end, so that only ids are grouped.
    """
    placed = _sent(_parts(keys, sets.select("id", "label", F.size("tokens").alias("weight"))))
    return _search(placed.join(sets.select("id", "label", "n", "tokens"), "id"), percent, False)


def _sets(docs: DataFrame, words: int, percent: int, whole: bool) -> DataFrame:
    """Hashed sets, with the other columns of ``docs``, all bigint. ``whole``: all hashes; else signatures.

    The 128-bit fingerprint of a set tells equal sets.
    """
    front = [name for name in docs.columns if name != "text"]
    out = ", ".join(f"{name} bigint" for name in front) + ", n bigint, set_hash binary, tokens array<bigint>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in text_pieces(batch.column("text"), PIECE_BYTES):
                part = batch.slice(start, end - start)
                sets = shingle_hashes(*text_buffer(part.column("text")), words)
                sizes = [len(s) for s in sets]
                prints = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                if not whole:
                    # Hashes are signed here; any order that is the same everywhere does.
                    sets = [s[: 2 * (n - required(n, percent)) + 1] for s, n in zip(sets, sizes)]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                known = {name: part.column(name) for name in front}
                yield pa.RecordBatch.from_pydict({**known, "n": pa.array(sizes, pa.int64()), "set_hash": prints, "tokens": lists})

    return docs.mapInArrow(tidy(cut), out)


def _likely(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``members`` (rep), and a few others.

    Texts of other documents then stay out of the shuffle of the join that follows. The filter is a
    bitmap of hashed ids with a fixed size; where members fill it up, more rows pass.
    """
    def place(name: str) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(name), F.lit(BUCKETS * BITS))
        return F.floor(at / BITS).alias("bucket"), (at % BITS).alias("bit")

    bitmaps = members.select(*place("rep")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.expr("substring(bits, int(bit div 8) + 1, 1)")), 16, 10).cast("int")
    set_ = F.when(byte.bitwiseAND(F.expr("shiftleft(1, int(bit % 8))")) != 0, True)
    return docs.select("*", *place("doc_id")).join(F.broadcast(bitmaps), "bucket").where(set_).select(*docs.columns)


def _least_shared(n: Column, percent: int) -> Column:
    small = F.ceil(n * percent / 100.0).cast("bigint")
    return small - F.ceil(small * percent / 100.0).cast("bigint") + 1


def token_of(sets: DataFrame) -> Column:
    """One row for each token of a set."""
    return F.explode(sets["tokens"]).alias("h")


def _tokens(sets: DataFrame, *names: str) -> DataFrame:
    """(``names``, h): a row for each token, dealt by it. Two readers of all its columns share one shuffle."""
    return sets.select(*names, token_of(sets)).where("id is not null and h is not null").repartition("h")


def _enough(sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """``sets`` with the tokens that ``found`` (id, h) has of them, where two linked sets could have so many in common."""
    held = found.groupBy("id").agg(F.collect_set("h").alias("tokens"))
    return held.join(sets, "id").where(F.size("tokens") >= _least_shared(F.col("n"), percent))


def _across(sets: DataFrame, percent: int) -> DataFrame:
    """``sets`` (id, n, label, tokens) with the tokens that other labels have, too, where these are enough.

    A link between two labels is by such tokens alone. ids are counted so that both readers need the same columns.
    """
    tokens = _tokens(sets, "id", "label")
    mixed = tokens.groupBy("h").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("id").alias("ids"),
    ).where("low != high and ids > 1")
    return _enough(sets.drop("tokens"), tokens.join(mixed.select("h"), "h"), percent)


def _ranked(able: DataFrame, percent: int) -> DataFrame:
    """The columns of ``able`` with tokens (those that two sets of it have) and keys: the rarest n - k + 1 of them.

    A linked document can't miss all keys. Tokens of one set alone would be keys without a partner.
    """
    tokens = _tokens(able, "id")
    counts = tokens.groupBy("h").agg(F.count("id").alias("count")).where("count > 1")
    ranked = (
        tokens.join(counts, "h")
        .groupBy("id").agg(F.sort_array(F.collect_set(F.struct("count", "h"))).alias("ranked"))
        .join(able.drop("tokens"), "id")
        .withColumn("keys", F.size("ranked") - _least_shared(F.col("n"), percent) + 1).where("keys > 0")
    )
    return ranked.select(
        *(name for name in able.columns if name != "tokens"), F.col("ranked.h").alias("tokens"),
        F.expr("slice(ranked.h, 1, int(keys))").alias("keys"),
    )


def ngram_jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: who is linked by sets of ``words`` words that reach
    ``percent`` per cent of Jaccard similarity.

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased; a text of fewer
    words is one n-gram; a null text or one without words has an empty set and links with nothing.
    component_id is the smallest doc_id that links reach. Rows without a doc_id are left out;
    repeated rows give one row; rows that share a doc_id but not their set are one row each, which link
    by their own sets. Other columns are not read. An empty table gives an empty table.

    Sets take part once, under an id made of their hash, however many documents have them; documents
    come back at the end. n-grams are compared by 64-bit hashes, sets by 128-bit ones whose 64-bit
    hashes are the ids. The result is exact but for collisions of these.
    """
    given = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    given = given.where("doc_id is not null")
    id_ = F.xxhash64("set_hash").alias("id")
    sets = stage(_sets(given, words, percent, False), "sets")
    filled = sets.where("n > 0").select(id_, "doc_id", "n", "tokens")
    classes = stage(filled.groupBy("id").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "classes")

    # Tokens of one class alone can't be shared with another. One document of a class is enough to tell, so the
    # tokens of most copies stay out of the shuffle.
    firsts = _likely(filled, classes)
    tokens = _tokens(firsts, "id")
    shared = tokens.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low != high")
    able = stage(_enough(classes.select("id", "n"), tokens.join(shared.select("h"), "h"), percent), "able")

    # First the most inclusive of the keys alone: they connect most of what belongs together.
    ranked = stage(_ranked(able, percent).withColumn("label", F.col("id")), "ranked")
    drop_staged(able)
    some = ranked.select("id", F.explode(F.expr("slice(keys, greatest(1, size(keys) - 1), 2)")).alias("key"))
    near = stage(_search_signatures(some, ranked, percent), "near")
    labels = stage(components(near), "labels")
    # A document can only have a partner elsewhere by k tokens that other components have, too.
    labelled = (
        ranked.select("id", "n", "tokens").join(labels, F.col("id") == F.col("node"), "left")
        .select("id", "n", "tokens", F.coalesce("component", "id").alias("label"))
    )
    rest = stage(_across(labelled, percent), "rest")
    again = stage(_ranked(rest, percent), "again")
    more = _search_signatures(again.select("id", F.explode("keys").alias("key")), again, percent)
    clusters = stage(components(near.union(more)), "clusters")
    drop_staged(ranked, near, labels, rest, again)

    # Whole sets of the few classes that are left, each from one document. Where that has other texts,
    # too, their sets have other ids. Blocks are known before the sets, which then move but once.
    wanted = clusters.select(F.col("node").alias("id"), F.col("component").alias("key")).join(classes, "id")
    parts = _parts(wanted.select("key", "id"), wanted.select("id", F.col("id").alias("label"), F.col("n").alias("weight")))
    placed = stage(parts.join(classes.select("id", "rep"), "id").withColumnRenamed("id", "node"), "placed")
    drop_staged(clusters)
    texts = _likely(given, placed).join(placed, F.col("doc_id") == F.col("rep"))
    texts = texts.withColumn("one", F.xxhash64("text")).dropDuplicates(["rep", "node", "one"])
    wholes = _sets(texts.select("key", "node", "s", "part", "text"), words, percent, True)
    wholes = wholes.select("key", "node", "s", "part", id_, "n", "tokens").where("id = node")
    links = _search(_sent(wholes.withColumnRenamed("node", "label")), percent, True)
    linked = stage(components(links), "components")
    of = linked.join(classes, F.col("node") == F.col("id"))
    least = of.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = of.join(least, "component").select("id", "component_id")
    found = (
        sets.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, id_).alias("id")).distinct()
        .join(classes, "id", "left").join(named, "id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "rep", "doc_id").alias("component_id"))
    )
    found = stage(found, "linked")
    drop_staged(sets, classes, placed, linked)
    return found
