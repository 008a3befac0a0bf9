"""Token counts: batch encoding that returns lengths only."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from seawake.llm.common import map_batches, texts

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
#: A single space between two letters or digits. The model's pieces hold a space at their start only, and a text's
#: start counts as one, so both parts encode to the same tokens as the whole.
SAFE = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


def split_safely(text: str, most: int) -> list[str]:
    """Parts of about ``most`` characters, cut at safe boundaries; a stretch without one stays whole."""
    parts, begin = [], 0
    while len(text) - begin > most:
        cut = SAFE.search(text, begin + most)
        if not cut:
            break
        parts.append(text[begin:cut.start()])
        begin = cut.end()
    return [*parts, text[begin:]]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, part_chars: int = 1 << 15,
                 batch_bytes: int = 1 << 20) -> DataFrame:
    """Tokens of every whole text under the sentencepiece model at ``model_path``.

    Texts longer than ``part_chars`` are cut at safe boundaries; parts are then encoded in batches of about
    ``batch_bytes``, whatever the number of rows, and only their lengths are kept. No rows are moved.

    Null and empty texts: 0 bytes, 0 tokens. A null doc_id is kept. Repeated rows give a row each. Other columns are
    ignored. An empty table gives an empty result.
    """
    def rows(batch: pa.RecordBatch):
        encoder = _encoder(model_path)
        column = batch.column(1).fill_null("")
        counts = np.zeros(batch.num_rows, np.int64)
        parts: list[str] = []
        owners: list[int] = []
        size = 0

        def flush():
            nonlocal size
            if parts:
                np.add.at(counts, owners, [len(ids) for ids in encoder.encode(parts, num_threads=1)])
            parts.clear()
            owners.clear()
            size = 0

        for row, text in enumerate(column.to_pylist()):
            for part in split_safely(text, part_chars) if len(text) > part_chars else (text,) if text else ():
                parts.append(part)
                owners.append(row)
                size += len(part) if part.isascii() else len(part.encode())
                if size >= batch_bytes:
                    flush()
        flush()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pc.binary_length(column).cast(pa.int64()), pa.array(counts), pa.array(counts > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return map_batches(texts(docs), rows, SCHEMA)


_LOADED: dict = {}


def _encoder(path: str):
    """One model per worker process."""
    if path not in _LOADED:
        import sentencepiece

        _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[path]
