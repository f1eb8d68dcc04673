"""A cuckoo filter over 64-bit hashes: a set that may claim too much, never too little, and can forget.

A bucket has four slots for 16-bit fingerprints. A fingerprint may stand in two buckets; the second
follows from the first and the fingerprint alone, so that entries can be moved without their hashes.
All operations work on whole arrays.
"""

from __future__ import annotations

import numpy as np

from docketry.llm.common import U64, mix

SLOTS = 4
FULL = 0.9  # share of the slots that are filled at most
ROUNDS = 500


class Cuckoo:
    """``table`` has a row of slots for each bucket, 0 where a slot is free; the rows are a power of two."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, entries: int) -> Cuckoo:
        """An empty filter with room for so many entries."""
        buckets = 4
        while buckets * SLOTS * FULL < entries:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    @classmethod
    def of(cls, hashes: np.ndarray) -> Cuckoo:
        """A filter of these hashes, as large as they need."""
        room = len(hashes)
        while True:
            made = cls.sized(room)
            if made.add(hashes):
                return made
            room = int(len(made.table) * SLOTS * FULL) + 1

    @classmethod
    def from_bytes(cls, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @property
    def entries(self) -> int:
        return int(np.count_nonzero(self.table))

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        jump = mix(prints.astype(U64) * U64(0x9E3779B97F4A7C15)) & U64(len(self.table) - 1)
        return bucket ^ jump.astype(np.int64)

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spread = mix(hashes.astype(U64, copy=False))
        prints = (spread >> U64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        bucket = (spread & U64(len(self.table) - 1)).astype(np.int64)
        return prints, bucket, self._other(bucket, prints)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes may be in the set; all that were added and not removed are."""
        prints, one, two = self._places(hashes)
        return (self.table[one] == prints[:, None]).any(axis=1) | (self.table[two] == prints[:, None]).any(axis=1)

    def add(self, hashes: np.ndarray) -> bool:
        """Adds every hash, repeated ones as often as they stand here; False (and unusable) if there is no room."""
        if self.entries + len(hashes) > len(self.table) * SLOTS * FULL:
            return False
        prints, here, two = self._places(hashes)
        rng = np.random.default_rng(len(hashes))
        for turn in range(ROUNDS):
            order = np.argsort(here, kind="stable")
            prints, here = prints[order], here[order]
            new = np.append(True, here[1:] != here[:-1]) if len(here) else np.zeros(0, bool)
            nth = np.arange(len(here)) - np.maximum.accumulate(np.where(new, np.arange(len(here)), 0))
            free = np.cumsum(self.table[here] == 0, axis=1)
            fits = nth < free[:, -1]
            slot = (free[fits] <= nth[fits, None]).sum(axis=1)
            self.table[here[fits], slot] = prints[fits]
            prints, here = prints[~fits], here[~fits]
            if not len(here):
                return True
            if turn == 0:
                here = self._other(here, prints)
                continue
            # One entry of every full bucket gives way to the first that waits for it.
            heads = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
            slot = rng.integers(0, SLOTS, len(heads))
            evicted = self.table[here[heads], slot]
            self.table[here[heads], slot] = prints[heads]
            prints[heads] = evicted
            here[heads] = self._other(here[heads], evicted)
        return False

    def remove(self, hashes: np.ndarray) -> None:
        """Takes out hashes that were added, each as often as it stands here."""
        prints, one, two = self._places(hashes)
        left = np.arange(len(hashes))
        while len(left):
            # Equal fingerprints of the same two buckets go one after the other.
            key = np.minimum(one[left], two[left]) << 16 | prints[left]
            _, first = np.unique(key, return_index=True)
            turn = left[first]
            for bucket in (one, two):
                match = self.table[bucket[turn]] == prints[turn, None]
                hit = match.any(axis=1)
                self.table[bucket[turn[hit]], match[hit].argmax(axis=1)] = 0
                turn = turn[~hit]
            if len(turn):
                raise KeyError("a hash that is not in the filter cannot be removed")
            keep = np.ones(len(left), bool)
            keep[first] = False
            left = left[keep]
