"""Periodic runs of words by enumerating maximal pairs in an LCP-interval tree.

A run is a stretch of words with smallest period q that no neighbouring word extends. Where its length
is at least twice q, the words of the run without its last q and those without its first q are a
maximal pair of distance q: two equal stretches with different words on both sides. Every maximal pair
that is long enough for its distance is therefore exactly a run, and nothing needs to be extended.

Texts are worked on where they are, about a megabyte at a time. Words become numbers; only words at
which a gram of ``base`` words begins that its text has twice can belong to a run, so only their
suffixes are sorted (by doubling the compared length) and get common-prefix lengths. A stack then
walks the tree of LCP intervals from the bottom up. Each interval keeps its places in lists by the
word to their left; when two children meet, places of different children and different left words
that are near enough are the maximal pairs.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import U64, mix, text_buffer, text_pieces

MIN_REPEATS = 4
MIN_WORDS = 6
PIECE_BYTES = 1 << 20
MANY_CLASSES = 32  # beyond, neighbours are sought among all places instead of in each class


def base_words(repeats: int, words: int) -> int:
    """Words that the equal stretches of any run have at least."""
    return max(1, min(max((repeats - 1) * q, words - q) for q in range(1, max(words, 1) + 1)))


def number_words(texts: list[list[bytes]], base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of texts laid out one after the other, the text of each place, and their starts.

    A 0 stands before, between and (``base`` times) after the texts; equal words have equal numbers.
    """
    flat = list(chain.from_iterable(texts))
    number = {word: n for n, word in enumerate(dict.fromkeys(flat), 1)}
    counts = np.array([len(w) for w in texts], np.int64)
    starts = 1 + np.concatenate([[0], np.cumsum(counts + 1)[:-1]]).astype(np.int64)
    ids = np.zeros(1 + int((counts + 1).sum()) + base, np.int64)
    owner = np.zeros(len(ids), np.int64)
    owner[1: 1 + int((counts + 1).sum())] = np.repeat(np.arange(len(texts)), counts + 1)
    ids[np.arange(len(flat)) + np.repeat(np.arange(len(texts)), counts) + 1] = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    owner[int(starts[-1] + counts[-1]) + 1:] = len(texts)
    return ids, owner, starts


def repeated_grams(ids: np.ndarray, owner: np.ndarray, base: int) -> np.ndarray:
    """Places whose next ``base`` words occur again in their text (a few others may be among them)."""
    n = len(ids) - base + 1
    h = owner[:n].astype(U64)
    for k in range(base):
        h = h * U64(0x9E3779B97F4A7C15) + ids[k: k + n].astype(U64)
    h = mix(h)
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64)
    marks = np.zeros(1 << 20, bool)
    marks[twice & U64(len(marks) - 1)] = True
    likely = np.flatnonzero(marks[h & U64(len(marks) - 1)])
    spot = np.minimum(np.searchsorted(twice, h[likely]), len(twice) - 1)
    likely = likely[twice[spot] == h[likely]]
    return likely[ids[likely] > 0]


def sorted_suffixes(ids: np.ndarray, owner: np.ndarray, active: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the active places in order, text by text, and the words each shares with the next.

    The places ``base`` words behind an active one take part, so that all that is compared has a rank.
    """
    places = np.unique(np.concatenate([active, active + base]))
    places = places[places <= len(ids) - base]
    columns = [ids[places + k] for k in range(base)]
    order = np.lexsort([*columns[::-1], owner[places]])
    suffixes = places[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = owner[suffixes[1:]] != owner[suffixes[:-1]]
    for column in columns:
        fresh[1:] |= column[order][1:] != column[order][:-1]
    group = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    rank = np.full(len(ids) + 1, -1, np.int32)
    rank[suffixes] = group
    levels = [(base, rank.copy())]
    size = base
    while True:
        alone = fresh & np.append(fresh[1:], True)
        todo = np.flatnonzero(~alone)
        if not len(todo):
            break
        key = (group[todo] << 32) + rank[suffixes[todo] + size] + 1
        by = np.argsort(key, kind="stable")
        suffixes[todo], key = suffixes[todo][by], key[by]
        new = np.append(True, key[1:] != key[:-1])
        fresh[todo] = new
        group[todo] = todo[np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))]
        rank[suffixes[todo]] = group[todo]
        size *= 2
        levels.append((size, rank.copy()))
    a, b = suffixes[:-1], suffixes[1:]
    shared = np.zeros(len(a), np.int64)
    for size, rank in reversed(levels):
        left = rank[a + shared]
        shared += size * ((left == rank[b + shared]) & (left >= 0))
    more = np.ones(len(a), bool)
    for _ in range(base - 1):
        more &= (ids[a + shared] == ids[b + shared]) & (ids[a + shared] > 0)
        shared += more
    shared[owner[a] != owner[b]] = 0
    shared[shared < base] = 0
    return suffixes, np.append(shared, 0)


class Interval:
    """Places of an LCP interval in lists by the word to their left; in one list, too, if these are many."""

    __slots__ = ("size", "classes", "places")

    def __init__(self, place: int, word: int):
        self.size = 1
        self.classes = {word: [place]}
        self.places: list[int] | None = None

    def near(self, place: int, word: int, reach: int, left: dict[int, int]) -> Iterator[int]:
        """Places within ``reach`` of ``place`` that have another word to their left.

        Of near places all but the first of a periodic stretch have the same left word, so either way
        few are looked at in vain.
        """
        if self.places is None:
            lists = [places for other, places in self.classes.items() if other != word]
        else:
            lists = [self.places]
        for places in lists:
            at = bisect_left(places, place - reach)
            while at < len(places) and places[at] <= place + reach:
                if left[places[at]] != word:
                    yield places[at]
                at += 1

    def take(self, word: int, places: list[int]) -> None:
        """Adds places that have ``word`` to their left."""
        self.size += len(places)
        mine = self.classes.get(word)
        if mine is None:
            self.classes[word] = places
        else:
            _merge(mine, places)
        if self.places is not None:
            _merge(self.places, places)
        elif len(self.classes) > MANY_CLASSES:
            self.places = sorted(place for places in self.classes.values() for place in places)


def _merge(many: list[int], few: list[int]) -> None:
    if len(few) * 16 < len(many):
        for place in few:
            insort(many, place)
    else:
        many.extend(few)
        many.sort()


def tree_runs(suffixes: list[int], shared: list[int], left: dict[int, int], repeats: int, words: int, found: dict) -> None:
    """Adds ``(start, end): period`` for the runs of one subtree whose suffixes are given in order."""

    def meet(held: Interval, places: list[int], word: int, length: int) -> None:
        """Maximal pairs of an interval with places of another child, which all follow ``word``."""
        if len(held.classes) == 1 and word in held.classes:
            return
        reach = length // (repeats - 1)
        for place in places:
            for other in held.near(place, word, reach, left):
                first, period = (place, other - place) if place < other else (other, place - other)
                if length + period >= words:
                    key = (first, first + period + length)
                    if found.get(key, period) >= period:
                        found[key] = period

    def join(held: Interval, child: Interval | int, length: int) -> Interval:
        if isinstance(child, int):
            word = left[child]
            meet(held, [child], word, length)
            held.take(word, [child])
            return held
        few, many = (held, child) if held.size <= child.size else (child, held)
        for word, places in few.classes.items():
            meet(many, places, word, length)
        for word, places in few.classes.items():
            many.take(word, places)
        return many

    lengths: list[int] = []
    held: list[Interval] = []
    for place, common in zip(suffixes, shared):
        node: Interval | int = place
        while lengths and lengths[-1] > common:
            node = join(held.pop(), node, lengths.pop())
        if not common:
            continue
        if lengths and lengths[-1] == common:
            held[-1] = join(held[-1], node, common)
        else:
            lengths.append(common)
            held.append(Interval(node, left[node]) if isinstance(node, int) else node)


def text_runs(texts: list[list[bytes]], repeats: int = MIN_REPEATS, words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start and period.

    A run has its smallest period at least ``repeats`` times (2 or more) and ``words`` words.
    """
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not texts:
        return runs
    base = base_words(repeats, words)
    ids, owner, starts = number_words(texts, base)
    active = repeated_grams(ids, owner, base)
    if not len(active):
        return runs
    suffixes, shared = sorted_suffixes(ids, owner, active, base)
    # Suffixes with their first gram in common are a subtree of their own.
    heads = np.flatnonzero(np.append(True, shared[:-1] == 0))
    tree = np.cumsum(np.append(True, shared[:-1] == 0)) - 1
    longest = np.maximum.reduceat(shared, heads)
    ordered = suffixes[np.lexsort([suffixes, tree])]
    gaps = np.full(len(suffixes), 1 << 40)
    gaps[:-1] = np.where(tree[1:] == tree[:-1], np.diff(ordered), 1 << 40)
    # No pair of a subtree is near enough if not even the nearest places are for the longest prefix.
    hopeful = np.flatnonzero(np.minimum.reduceat(gaps, heads) * (repeats - 1) <= longest)
    ends = np.append(heads[1:], len(suffixes))
    found: dict[tuple[int, int], int] = {}
    for n in hopeful.tolist():
        part = slice(int(heads[n]), int(ends[n]))
        own = suffixes[part]
        left = dict(zip(own.tolist(), ids[own - 1].tolist()))
        tree_runs(own.tolist(), shared[part].tolist(), left, repeats, words, found)
    for (start, end), period in found.items():
        text = int(owner[start])
        runs[text].append((start - int(starts[text]), end - start, period))
    for one in runs:
        one.sort(key=lambda run: (run[0], run[2]))
    return runs


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """Words joined by one space, without those that a run contains after its first period."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def collapse_runs(docs: DataFrame, repeats: int = MIN_REPEATS, words: int = MIN_WORDS) -> DataFrame:
    """doc_id, ``runs`` (array of start, length, period) and ``collapsed`` text of every document row.

    Words are what ASCII white space separates; ``runs`` are by start, then period; ``collapsed`` is
    the words joined by one space, of each run only its first period. A null or empty text has no
    runs and collapses to an empty text. Repeated rows give repeated rows, an empty table gives an
    empty one, other columns are not carried. One text is held whole, however long.
    """
    if repeats < 2:
        raise ValueError("a run repeats its period at least twice")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            for start, end in text_pieces(column, PIECE_BYTES):
                data, offsets = text_buffer(column.slice(start, end - start))
                whole, bounds = data.tobytes(), offsets.tolist()
                texts = [whole[a:b].split() for a, b in zip(bounds, bounds[1:])]
                runs = text_runs(texts, repeats, words)
                flat = np.array([r for one in runs for r in one], np.int64).reshape(-1, 3)
                places = np.concatenate([[0], np.cumsum([len(one) for one in runs])]).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
                left = pa.array([collapsed(w, r) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, end - start), pa.ListArray.from_arrays(places, fields), left],
                    ["doc_id", "runs", "collapsed"],
                )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(find, "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
