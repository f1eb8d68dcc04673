"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last eight bytes of a text proposes cuts; a proposed cut becomes one at the
next white space, or where it stands if none is near. Equal chunks of different documents of a task
are encoded once. A chunk that is new is put together from its pieces between white space, and these
too are encoded once. Cuts at white space are exact joins, because the tokenizer never lets a token
or a merge cross white space; every other cut is repaired: the text around it is encoded again, from
white space to white space, until the ids on both sides agree with those of the chunks.

Memory is bounded: the tables of chunks and pieces start anew when they hold ``max_cached`` bytes,
and one document at a time is put together.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docketry.llm.common import U64, mix, text_buffer, text_pieces, tidy

WINDOW = 8
AVERAGE = 1024  # bytes between proposed cuts
REACH = 256  # bytes within which a cut looks for white space
MAX_CACHED = 40 << 20
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"): ord("z") + 1] = True
_LETTER[ord("A"): ord("Z") + 1] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord(",")]] = True
# Pieces of lower-case Latin-1 letters alone; in UTF-8 those beyond ASCII begin with C3.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
# Byte-level vocabularies write each byte as a character: printable ones stand for themselves,
# the others follow from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
BYTE_LEVEL = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + n) for n, b in enumerate(_OTHERS)}
_GEAR = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def cut_points(data: np.ndarray, average: int = AVERAGE, reach: int = REACH) -> np.ndarray:
    """Where chunks of one text begin, without 0: places that depend on the bytes nearby alone."""
    n = len(data)
    if n <= WINDOW:
        return np.zeros(0, np.int64)
    gear = _GEAR[data]
    rolling = np.zeros(n - WINDOW + 1, U64)
    for k in range(WINDOW):
        rolling += gear[k: n - WINDOW + 1 + k] << U64(WINDOW - 1 - k)
    proposed = np.flatnonzero((rolling >> U64(20)) % U64(average) == 0) + WINDOW
    proposed = proposed[proposed < n]
    if not len(proposed):
        return proposed
    space = np.append(np.flatnonzero(_SPACE[data]), n + reach)
    after = space[np.searchsorted(space, proposed)]
    cuts = np.where(after - proposed <= reach, after, proposed)
    # A cut inside a character moves to its first byte.
    for _ in range(3):
        inside = (data[np.minimum(cuts, n - 1)] & 0xC0) == 0x80
        cuts = cuts - inside
    return np.unique(cuts[(cuts > 0) & (cuts < n)])


def ids_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    return np.array(ids, "<u4").tobytes()


class PlainWords:
    """The merges of a tokenizer alone, for words that its other steps leave whole.

    Lower-case letters pass the normalizer unchanged and make one word, so only the merges matter;
    many words are then encoded in one call and told apart by the suffix that ends a word.
    """

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer, pre_tokenizers

        self.merges = Tokenizer(tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = tokenizer.get_vocab()
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, id_ in vocabulary.items():
            self.tokens[id_] = token.encode()
        suffix = (getattr(tokenizer.model, "end_of_word_suffix", None) or "").encode()
        self.ends = np.array([bool(suffix) and t.endswith(suffix) for t in self.tokens])

    def encode(self, words: list[bytes]) -> list[tuple[bytes, bytes]] | None:
        """Ids and decoded text of each word; none if the words can't be told apart."""
        spelled = [w.decode("latin-1").translate(BYTE_LEVEL) for w in words]
        found = self.merges.encode_batch_fast(
            [" ".join(spelled[n: n + 200]) for n in range(0, len(spelled), 200)], add_special_tokens=False
        )
        ids = np.concatenate([np.array(f.ids, "<u4") for f in found])
        stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(stops) != len(words):
            return None
        whole, tokens = ids.tobytes(), [self.tokens[i] for i in ids.tolist()]
        return [(whole[4 * a: 4 * b], b" ".join(tokens[a:b])) for a, b in zip([0, *stops], stops)]


class ChunkEncoder:
    """Encodes and decodes whole texts through tables of chunks and pieces.

    ``tokenizer`` is one of the tokenizers library. If its decoder sets one space between tokens,
    decoded chunks can be joined; otherwise the ids of the whole text are decoded.
    """

    PROBE = [b"the", b"onnttion", "\xe9\xe0\xe4\xf1ment".encode(), b"s", "\xdfk".encode(), b"whthtionandzuq"]

    def __init__(self, tokenizer, max_cached: int = MAX_CACHED, average: int = AVERAGE):
        self.tokenizer = tokenizer
        self.spaced = tokenizer.decoder is None
        self.max_cached, self.average = max_cached, average
        self.pieces: dict[bytes, tuple[bytes, bytes]] = {}
        self.chunks: dict[bytes, tuple[bytes, bytes]] = {}
        self.held = self.held_chunks = 0
        self.encoded = 0  # pieces that went through the tokenizer
        self.plain = PlainWords(tokenizer) if self.spaced else None
        if self.plain and self.plain.encode(self.PROBE) != self._whole(self.PROBE):
            self.plain = None

    def _whole(self, pieces: list[bytes]) -> list[tuple[bytes, bytes]]:
        out = []
        for found in self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False):
            ids = found.ids
            said = self.tokenizer.decode(ids, skip_special_tokens=False).encode() if ids and self.spaced else b""
            out.append((ids_bytes(ids), said))
        return out

    def _learn(self, pieces: list[bytes]) -> None:
        words: list[bytes] = []
        rest: list[bytes] = []
        for piece in pieces:
            (words if self.plain and _PLAIN.fullmatch(piece) else rest).append(piece)
        entries = self.plain.encode(words) if words else []
        if entries is None:
            words, entries, rest = [], [], pieces
        if rest:
            words, entries = words + rest, entries + self._whole(rest)
        for piece, entry in zip(words, entries):
            self.pieces[piece] = entry
            self.held += len(piece) + len(entry[0]) + len(entry[1]) + 300
        self.encoded += len(pieces)

    def learn(self, texts: list[bytes]) -> None:
        """Encodes the new pieces of several texts in few calls."""
        if self.held > self.max_cached * 3 // 4:
            self.pieces, self.held = {}, 0
        new: set[bytes] = set()
        for text in texts:
            new.update(text.split())
        new.difference_update(self.pieces)
        new = list(new)
        for start in range(0, len(new), 20_000):
            self._learn(new[start: start + 20_000])

    def chunk(self, chunk: bytes) -> tuple[bytes, bytes]:
        """Ids and decoded text of one chunk, looked up or put together from its pieces."""
        found = self.chunks.get(chunk)
        if found is None:
            pieces = chunk.split()
            try:
                parts = [self.pieces[p] for p in pieces]
            except KeyError:
                self._learn([p for p in set(pieces) if p not in self.pieces])
                parts = [self.pieces[p] for p in pieces]
            found = b"".join([p[0] for p in parts]), b" ".join([p[1] for p in parts if p[0]])
            if self.held_chunks > self.max_cached // 4:
                self.chunks, self.held_chunks = {}, 0
            self.chunks[chunk] = found
            self.held_chunks += len(chunk) + len(found[0]) + len(found[1]) + 300
        return found

    def encode(self, text: bytes, data: np.ndarray) -> tuple[bytes, bytes]:
        """Ids as little-endian 32-bit integers, and the decoded text."""
        cuts = [0, *cut_points(data, self.average).tolist(), len(text)]
        spans = list(zip(cuts, cuts[1:]))
        ids: list[bytes] = []
        said: list[bytes] = []
        at = 0
        while at < len(spans):
            start, end = spans[at]
            # Chunks whose join is not at white space are repaired together with their neighbours.
            last = at
            while last + 1 < len(spans) and not _SPACE[data[spans[last][1]]] and not _SPACE[data[spans[last][1] - 1]]:
                last += 1
            parts = [self.chunk(text[start:end])] if last == at else self.repair(text, spans[at: last + 1])
            for part in parts:
                if part[0]:
                    ids.append(part[0])
                    said.append(part[1])
            at = last + 1
        whole = b"".join(ids)
        if self.spaced:
            return whole, b" ".join(said)
        return whole, self.tokenizer.decode(np.frombuffer(whole, "<u4").tolist(), skip_special_tokens=False).encode()

    def repair(self, text: bytes, spans: list[tuple[int, int]]) -> list[tuple[bytes, bytes]]:
        """Chunks that meet inside a run without white space: each such run is encoded as a whole.

        What precedes the run in the first chunk and what follows it in the last keep the ids of
        their pieces, so the ids agree on both sides of every repaired join.
        """
        out: list[tuple[bytes, bytes]] = []
        start = spans[0][0]
        for _, cut in spans[:-1]:
            if cut <= start:
                continue
            left = max((text.rfind(bytes([c]), start, cut) for c in (9, 10, 11, 12, 13, 32)), default=-1) + 1
            left = max(left, start)
            found = [p for c in (9, 10, 11, 12, 13, 32) if (p := text.find(bytes([c]), cut)) >= 0]
            right = min(found, default=len(text))
            right = min(right, spans[-1][1])
            if left > start:
                out.append(self.chunk(text[start:left]))
            out.append(self.chunk(text[left:right]))
            start = right
        if start < spans[-1][1]:
            out.append(self.chunk(text[start: spans[-1][1]]))
        return out


def prepared(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The texts, spelled so that more pieces are equal; the ids are the same.

    A space goes between a letter and a full stop or comma that ends a word, where the tokenizer
    splits anyway. Texts of Latin-1 characters without the opening of a special token are in lower
    case, as the tokenizer would have them next.
    """
    out = []
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        b = data[start:end]
        if len(b) > 2:
            stop = np.flatnonzero(_STOP[b[1:]]) + 1
            stop = stop[_LETTER[b[stop - 1]]]
            stop = stop[_SPACE[b[np.minimum(stop + 1, len(b) - 1)]] | (stop == len(b) - 1)]
            b = np.insert(b, stop, 32)
        text = b.tobytes()
        if len(b) and (top := b.max()) <= 0xC3 and b"<|" not in text:
            text = text.lower()
            if top == 0xC3:
                b = np.frombuffer(text, np.uint8).copy()
                after = np.flatnonzero(b[:-1] == 0xC3) + 1
                capital = after[(b[after] >= 0x80) & (b[after] <= 0x9E) & (b[after] != 0x97)]
                b[capital] += 0x20
                text = b.tobytes()
        out.append(text)
    return out


def encode_documents(
    docs: DataFrame,
    open_tokenizer: Callable[[], object],
    normalizes_case: bool = True,
    keep_ids: bool = False,
    max_cached: int = MAX_CACHED,
) -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` to doc_id, one row per document row.

    ``open_tokenizer`` is called once a task. ``keep_ids`` adds the ids and the decoded text. The
    other columns of ``docs`` are not carried, so names cannot clash. A null text counts as empty
    and has no tokens; repeated rows give repeated rows; an empty table gives an empty table.
    ``normalizes_case`` says that the tokenizer lower-cases and splits words from punctuation, which
    makes more pieces equal; without it, pieces are taken as they stand.
    """
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<bigint>, decoded string"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in batches:
            column = batch.column("text")
            for start, end in text_pieces(column, PIECE_BYTES):
                coder = coder or ChunkEncoder(open_tokenizer(), max_cached)
                part = column.slice(start, end - start)
                data, offsets = text_buffer(part)
                if normalizes_case:
                    texts = prepared(data, offsets)
                else:
                    texts = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                coder.learn(texts)
                ids, said = [], []
                counts, ids_hex, said_hex = [], [], []
                for text in texts:
                    found = coder.encode(text, np.frombuffer(text, np.uint8))
                    counts.append(len(found[0]) // 4)
                    ids_hex.append(hashlib.sha256(found[0]).hexdigest())
                    said_hex.append(hashlib.sha256(found[1]).hexdigest())
                    if keep_ids:
                        ids.append(np.frombuffer(found[0], "<u4").astype(np.int64))
                        said.append(found[1].decode())
                columns = {
                    "doc_id": batch.column("doc_id").slice(start, end - start),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_sha256": ids_hex,
                    "decoded_sha256": said_hex,
                }
                if keep_ids:
                    columns |= {"ids": pa.array(ids, pa.list_(pa.int64())), "decoded": said}
                yield pa.RecordBatch.from_pydict(columns)

    narrow = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return narrow.mapInArrow(tidy(encode), schema)


def public_tokenizer(name: str) -> Callable[[], object]:
    """Opens a tokenizer file of the installed public_tokenizers; parameter ``name``.

    The library then works in the thread that calls it: a task has one core, and each further thread
    would keep memory of its own for as long as the worker lives.
    """

    def opened():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"

        import public_tokenizers
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    return opened
