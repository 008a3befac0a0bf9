"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import map_batches, texts

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"
FOLDS, HELD = 4, 2
UNKNOWN = "und"
SYMBOLS = 64  # 0 is the gap between words, 1-26 are a-z, the rest is shared by all other letters
GRAM = 3
N_GRAMS = SYMBOLS ** GRAM
DIMENSIONS = 2048
PIECE = 1 << 20  # characters of a text counted at once


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD, F.lit(False))


_TABLE: list[np.ndarray] = []


def _symbols() -> np.ndarray:
    """Code point to symbol; what is no letter is a gap."""
    if not _TABLE:
        table = np.zeros(0x110000, np.uint8)
        letters = np.array([i for i in range(0x110000) if chr(i).isalpha()])
        table[letters] = 27 + (letters * 2654435761 >> 7) % (SYMBOLS - 27)
        table[97:123] = np.arange(1, 27)
        _TABLE.append(table)
    return _TABLE[0]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letter trigrams of a whole text, in ascending order, and how often each occurs.

    Letters are lower-cased, anything between them is one gap, and a text begins and ends with one. Very long texts
    are counted piece by piece; a piece's last two symbols open the next.
    """
    table, total, tail = _symbols(), None, np.zeros(1, np.uint8)
    for a in range(0, len(text), PIECE):
        part = text[a:a + PIECE].lower().encode("utf-32-le", "surrogatepass")
        last = [np.zeros(1, np.uint8)] if a + PIECE >= len(text) else []
        s = np.concatenate([tail, table[np.frombuffer(part, "<u4")], *last])
        s = s[np.concatenate(([True], (s[1:] > 0) | (s[:-1] > 0)))]
        tail, s = s[-2:], s.astype(np.int32)
        codes, counts = np.unique((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], return_counts=True)
        if total is None and last:
            return _with_letters(codes, counts)
        total = np.zeros(N_GRAMS, np.int64) if total is None else total
        total[codes] += counts
    if total is None:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.flatnonzero(total)
    return _with_letters(codes, total[codes])


def _with_letters(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    some = codes > 0
    return codes[some].astype(np.int64), counts[some].astype(np.int64)


_LETTERS: list[np.ndarray] = []


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bipolar vectors of trigrams: random letter vectors, rotated by their place and multiplied element by element."""
    if not _LETTERS:
        random = np.random.default_rng(42)
        base = random.choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
        _LETTERS.extend(np.roll(base, GRAM - 1 - place, axis=1) for place in range(GRAM))
    a, b, c = codes // SYMBOLS ** 2, codes // SYMBOLS % SYMBOLS, codes % SYMBOLS
    return _LETTERS[0][a] * _LETTERS[1][b] * _LETTERS[2][c]


def bundle(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sums of the gram vectors of several texts: one row of a text each."""
    if not rows:
        return np.empty((0, DIMENSIONS), np.float32)
    codes, at = np.unique(np.concatenate([c for c, _ in rows]), return_inverse=True)
    out = np.zeros((len(rows), DIMENSIONS), np.float32)
    counts = np.zeros((len(rows), len(codes)), np.float32)
    counts[np.repeat(np.arange(len(rows)), [len(c) for c, _ in rows]), at] = np.concatenate([n for _, n in rows])
    for k in range(0, len(codes), 4096):
        out += counts[:, k:k + 4096] @ gram_vectors(codes[k:k + 4096]).astype(np.float32)
    return out


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Prototype of every language: the bundle of all its documents outside the held-out fold.

    Tasks sum trigram counts by language, so at most ``SYMBOLS`` cubed rows for each language and task are shuffled
    and one vector for each language reaches the driver.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.filter("doc_id is not null and text is not null and lang is not null")
    rows = rows.filter(~held_out(F.col("doc_id"))).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, counts = gram_counts(text)
                if lang not in sums:
                    sums[lang] = np.zeros(N_GRAMS, np.int64)
                sums[lang][codes] += counts
        for lang, total in sums.items():
            codes = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)),
                                              pa.array(total[codes])], ["lang", "code", "n"])

    def prototype(key, frame):
        import pandas as pd

        vector = bundle([(frame.code.to_numpy(), frame.n.to_numpy())])[0]
        return pd.DataFrame({"lang": [key[0]], "vector": [(vector / max(np.linalg.norm(vector), 1e-9)).tolist()]})

    counted = rows.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    found = counted.groupBy("lang").applyInPandas(prototype, "lang string, vector array<float>").collect()
    found.sort(key=lambda r: r.lang)
    return [r.lang for r in found], np.array([r.vector for r in found], np.float32).reshape(len(found), DIMENSIONS)


def identify(docs: DataFrame) -> DataFrame:
    """Language of every whole text: the prototype with the largest cosine, ties to the first in alphabetical order.

    Learnt from text and lang of the documents outside the held-out fold; lang, source and doc_id are no inputs of a
    prediction. ``score`` is the cosine, 0 where it is negative.

    Texts that are null, empty or without a letter, and all texts if nothing could be learnt: ``und`` with score 0.
    A null doc_id is kept, not held out and not learnt from. Repeated rows give a row each. Other columns are
    ignored. An empty table gives an empty result.
    """
    names, prototypes = train(docs)

    def rows(batch: pa.RecordBatch):
        column = batch.column(2).to_pylist()
        predicted, scores = [UNKNOWN] * len(column), np.zeros(len(column))
        for a in range(0, len(column), 128):
            counted = [(i, gram_counts(column[i])) for i in range(a, min(a + 128, len(column))) if column[i]]
            counted = [(i, grams) for i, grams in counted if len(grams[0])]
            if not counted or not names:
                continue
            vectors = bundle([grams for _, grams in counted])
            cosines = vectors @ prototypes.T / np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
            for (i, _), best, value in zip(counted, cosines.argmax(1), cosines.max(1), strict=True):
                predicted[i], scores[i] = names[best], min(max(float(value), 0.0), 1.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(predicted, pa.string()), pa.array(scores)],
            ["doc_id", "held_out", "lang_pred", "score"])

    return map_batches(texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), rows, SCHEMA)
