"""Language identification with blended-spectrum presence kernels.

The kernel of two texts is the number of n-grams (of 1 to ``ORDER`` letters, each counted once) that
both have, divided by the geometric mean of their own numbers. A bounded sample of labelled texts
gives the Nystroem landmarks and, by kernel ridge regression of every language against the others,
one weight vector for each language. A batch of texts is scored by two matrix products: n-gram
presence times landmark presence gives kernel values, and these times the weights give the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import text_pieces, tidy

ORDER = 3
PER_LANGUAGE = 250  # sampled rows of a language, about
LANDMARKS = 50  # of them landmarks
MAX_LANGUAGES = 100  # languages that can be learned
SAMPLE_CHARS = 3_000  # characters of a sampled row, from three places of its text
ALPHABET = 96  # letters with a code of their own; others share SHARED codes by their Unicode block
SHARED = 16
RIDGE = 1e-3
SHARPNESS = 6.0  # of the score: how fast it nears 1 as the best language leads
PIECE_BYTES = 1 << 20
PRESENCE_BYTES = 8 << 20  # of the presence matrix of the texts scored at a time
UNDETERMINED = "und"


def letter_table(sample: list[str]) -> np.ndarray:
    """Code of every character: 0 for all that are not letters, the same for both cases."""
    table = np.zeros(0x110000, np.uint8)
    letters = [c for c in range(0x110000) if chr(c).isalpha()]
    codes = np.array(letters)
    table[codes] = ALPHABET + 1 + (codes >> 7) % SHARED
    lower = "".join(sample).lower()
    values, counts = np.unique(np.frombuffer(lower.encode("utf-32-le", "replace"), np.uint32), return_counts=True)
    kept = sorted((v for v in zip(-counts, values) if chr(v[1]).isalpha()))[:ALPHABET]
    for code, (_, value) in enumerate(kept, 1):
        table[value] = code
        for variant in {chr(value).upper(), chr(value).title()}:
            if len(variant) == 1:
                table[ord(variant)] = code
    return table


@dataclass
class LanguageModel:
    """``table`` codes characters; ``slots`` numbers the n-grams that landmarks have."""

    languages: list[str]
    table: np.ndarray
    slots: list[np.ndarray]  # for each order: column of the n-gram, or -1
    landmarks: np.ndarray  # (n-grams, landmarks), presence over the root of a landmark's own number
    weights: np.ndarray  # (landmarks, languages)
    offsets: np.ndarray

    def codes(self, text: str) -> np.ndarray:
        """Letter codes with one 0 for each run of other characters, and one at both ends."""
        code = self.table[np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)]
        keep = np.ones(len(code), bool)
        keep[1:] = (code[1:] != 0) | (code[:-1] != 0)
        return code[keep].astype(np.int64)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A value for each text and language, and which texts have letters."""
        presence = np.zeros((len(texts), self.landmarks.shape[0]), np.float32)
        lettered = np.zeros(len(texts), bool)
        seen = [np.zeros(len(s), np.int32) for s in self.slots]
        for row, text in enumerate(texts):
            code = self.codes(text)
            lettered[row] = len(code) > 1
            if not lettered[row]:
                continue
            own, columns = ngrams(code, self.slots, seen)
            presence[row, columns] = 1 / np.sqrt(own)
        return (presence @ self.landmarks) @ self.weights + self.offsets, lettered


def base() -> int:
    return ALPHABET + SHARED + 1


def ngrams(code: np.ndarray, slots: list[np.ndarray], seen: list[np.ndarray]) -> tuple[int, np.ndarray]:
    """The number of different n-grams of a text, and the columns of those that landmarks have.

    ``seen`` is scratch: the last place of an n-gram overwrites the others, so each counts once
    without sorting.
    """
    own, found = 0, []
    gram = np.zeros(len(code), np.int64)
    for n, (slot, last) in enumerate(zip(slots, seen), 1):
        if len(code) < n:
            break
        gram = gram[: len(code) - n + 1] * base() + code[n - 1:]
        place = np.arange(len(gram), dtype=np.int32)
        last[gram] = place
        once = gram[last[gram] == place]
        own += len(once)
        column = slot[once]
        found.append(column[column >= 0])
    return own, np.concatenate(found)


def fit_languages(texts: list[str], languages: list[str]) -> LanguageModel:
    """Fits the model on sampled rows, in their given order. Rows without letters teach nothing."""
    names = sorted(set(languages))
    table = letter_table(texts)
    model = LanguageModel(names, table, [], np.zeros((0, 0)), np.zeros((0, len(names))), np.zeros(len(names)))
    rows = [(model.codes(t), names.index(x)) for t, x in zip(texts, languages)]
    rows = [r for r in rows if len(r[0]) > 1]
    if not rows:
        model.slots = [np.full(base() ** n, -1, np.int32) for n in range(1, ORDER + 1)]
        model.landmarks, model.weights = np.zeros((0, 1), np.float32), np.zeros((1, len(names)), np.float32)
        return model
    taken = dict.fromkeys(range(len(names)), 0)
    chosen = []
    for i, (_, y) in enumerate(rows):
        if taken[y] < LANDMARKS:
            taken[y] += 1
            chosen.append(i)
    # Columns for all n-grams of the landmarks.
    grams = []
    for n in range(1, ORDER + 1):
        here = []
        for i in chosen:
            code = rows[i][0]
            gram = np.zeros(max(len(code) - n + 1, 0), np.int64)
            for k in range(n):
                gram = gram * base() + code[k: k + len(gram)]
            here.append(gram)
        grams.append(np.unique(np.concatenate(here)))
    at = 0
    for n, known in enumerate(grams, 1):
        slot = np.full(base() ** n, -1, np.int32)
        slot[known] = np.arange(at, at + len(known))
        at += len(known)
        model.slots.append(slot)
    seen = [np.zeros(len(s), np.int32) for s in model.slots]
    presence = np.zeros((len(rows), at), np.float32)
    for row, (code, _) in enumerate(rows):
        own, columns = ngrams(code, model.slots, seen)
        presence[row, columns] = 1 / np.sqrt(own)
    marks = presence[chosen]
    among = (marks @ marks.T).astype(np.float64)
    values, vectors = np.linalg.eigh(among)
    good = values > 1e-6 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = (presence @ marks.T).astype(np.float64) @ whiten
    targets = np.full((len(rows), len(names)), -1.0)
    y = np.array([r[1] for r in rows])
    targets[np.arange(len(rows)), y] = 1.0
    weight = np.sqrt(1 / np.bincount(y, minlength=len(names))[y])[:, None]
    mean = np.average(features, axis=0, weights=weight[:, 0] ** 2)
    aim = np.average(targets, axis=0, weights=weight[:, 0] ** 2)
    left = (features - mean) * weight
    ridge = np.linalg.solve(left.T @ left + RIDGE * np.eye(left.shape[1]), left.T @ ((targets - aim) * weight))
    model.landmarks = np.ascontiguousarray(marks.T)
    model.weights = (whiten @ ridge).astype(np.float32)
    model.offsets = aim - mean @ ridge
    return model


def sampled(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """About ``per_language`` rows of each of the MAX_LANGUAGES most frequent languages, by a hash.

    The share to take follows from a count of each language; a row is taken if the hash of its id
    falls below it, so no group is gathered or sorted.
    """
    count = F.count(F.lit(1))
    rate = (
        docs.groupBy("lang").agg(count.alias("rows"), (F.lit(float(per_language)) / count).alias("rate"))
        .orderBy(F.desc("rows"), "lang").limit(MAX_LANGUAGES).select("lang", "rate")
    )
    uniform = F.pmod(F.xxhash64("doc_id", F.lit("lang-sample")), F.lit(1 << 30)) / float(1 << 30)
    length, part = F.length("text"), SAMPLE_CHARS // 3
    step = (length - part) / 2
    spread = F.concat(*[F.substr(F.col("text"), (step * k).cast("int") + 1, F.lit(part)) for k in range(3)])
    text = F.when(length <= SAMPLE_CHARS, F.col("text")).otherwise(spread)
    return docs.join(F.broadcast(rate), "lang").where(uniform < F.col("rate")).select("doc_id", "lang", text.alias("text"))


def train_languages(docs: DataFrame, held_out: Column | None = None, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fits the model on a bounded sample of the rows that have text and language.

    ``held_out`` (on doc_id) names rows that are never learned from. Sampled texts are cut to
    ``SAMPLE_CHARS`` characters from their beginning, middle and end; half of the sample learns from a
    short excerpt, so that short texts are known too. Only this sample comes to the driver.
    """
    rows = docs.select(
        docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"),
        docs["lang"].cast("string").alias("lang"),
    ).where("text is not null and lang is not null and doc_id is not null")
    if held_out is not None:
        rows = rows.where(~held_out)
    got = sampled(rows, per_language).orderBy(F.xxhash64("doc_id"), "doc_id", "text").collect()
    texts = []
    for n, r in enumerate(got):
        size = 20 + r["doc_id"] * 37 % 180
        texts.append(r["text"][len(r["text"]) // 3:][:size] if n % 2 and len(r["text"]) > 3 * size else r["text"])
    return fit_languages(texts, [r["lang"] for r in got])


def predict_languages(docs: DataFrame, model: LanguageModel, keep: bool = False) -> DataFrame:
    """doc_id, ``lang_pred`` and ``score`` (0 to 1) of every document, from its whole text alone.

    A text that is null or has no letter is ``und`` with score 0, as is every text if nothing could
    be learned. Repeated rows give repeated rows. With ``keep``, all columns of ``docs`` stay
    (columns of the two new names are replaced).
    """
    new = ("lang_pred", "score")
    columns = [c for c in docs.columns if c not in new] if keep else ["doc_id", "text"]
    given = docs.select(*[docs[c] for c in columns])
    if not keep:
        given = given.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = given.schema if keep else given.select("doc_id").schema
    names = out.names

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, PRESENCE_BYTES // (4 * max(1, model.landmarks.shape[0])))
        for batch in batches:
            for start, end in text_pieces(batch.column("text"), PIECE_BYTES, rows):
                part = batch.slice(start, end - start)
                texts = [t or "" for t in part.column("text").to_pylist()]
                values, lettered = model.scores(texts)
                if model.languages:
                    best = values.argmax(axis=1)
                    lead = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
                    score = np.where(lettered, 1 / lead.sum(axis=1), 0.0)
                    names_of = np.where(lettered, np.array(model.languages, object)[best], UNDETERMINED)
                else:
                    score = np.zeros(len(texts))
                    names_of = np.full(len(texts), UNDETERMINED, object)
                arrays = [part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(names_of, pa.string()), pa.array(score.astype(np.float64))], [*names, *new]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out)
    return given.mapInArrow(tidy(predict), f"{schema}, lang_pred string, score double")
