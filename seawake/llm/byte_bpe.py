"""Byte-level BPE by a sentencepiece model that is made from the vocabulary alone.

A rank file lists byte strings by rank. Each becomes a piece: its bytes are mapped to printable characters, its score is
the negative rank, and text is left as it is (identity normalisation). The library's BPE then merges the pair with the
highest score first, the leftmost of equal ones, which is what the ranks ask for. Pre-tokens are encoded one by one;
decoding maps the pieces' characters back to bytes.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import map_batches, texts
from seawake.llm.token_counts import split_safely

SCHEMA = "doc_id long, n_tokens long, ids binary"
PART_CHARS = 1 << 17  # characters of a long text that are matched at once
REMEMBERED = 1 << 17  # pre-tokens whose ids a worker keeps
LONGEST_KEPT = 64  # characters of a pre-token that is kept
UNKNOWN = "⁇"


def byte_characters() -> list[str]:
    """A printable character for every byte: the byte's own Latin-1 one if that is visible, else one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


CHARACTER = byte_characters()
BYTE = {c: b for b, c in enumerate(CHARACTER)}
_MAPPED = {b: c for b, c in enumerate(CHARACTER)}


def mapped(data: bytes) -> str:
    """Bytes as the characters that stand for them."""
    return data.decode("latin-1").translate(_MAPPED)


def unmapped(piece: str) -> bytes:
    """The bytes that a piece's characters stand for."""
    return bytes(BYTE[c] for c in piece)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 byte string and its rank on every line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def piece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model; piece ids follow the order of the ranks, the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        model.pieces.add(piece=mapped(token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece=UNKNOWN, score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_piece = UNKNOWN
    model.trainer_spec.unk_id = len(ranks)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes pre-tokens and decodes ids with the model of one rank file."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.words = regex.compile(pattern)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model(ranks))
        self.ranks = ranks
        self.rank_of_piece = np.array(sorted(ranks.values()), "<u4")
        self.bytes_of = {int(rank): unmapped(self.pieces.id_to_piece(i)) for i, rank in enumerate(self.rank_of_piece)}
        self.known: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        """Ids of pre-tokens not met before; one that is an entry of the vocabulary is that entry."""
        whole = {w: self.ranks.get(w.encode()) for w in words}
        self.known.update((w, rank.to_bytes(4, "little")) for w, rank in whole.items() if rank is not None)
        parts = [w for w, rank in whole.items() if rank is None]
        for word, ids in zip(parts, self.pieces.encode([mapped(w.encode()) for w in parts], num_threads=1), strict=True):
            if len(self.rank_of_piece) in ids:
                raise ValueError("the vocabulary lacks a single byte")
            self.known[word] = self.rank_of_piece[ids].tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as unsigned little-endian 32-bit integers."""
        out = []
        for k, part in enumerate(split_safely(text, PART_CHARS)):
            words = self.words.findall(" " + part if k else part)
            if len(self.known) > REMEMBERED:
                self.known.clear()
            new = set(words).difference(self.known)
            if new:
                self._learn(new)
            out.append(b"".join(map(self.known.__getitem__, words)))
            for word in new:
                if len(word) > LONGEST_KEPT:
                    del self.known[word]
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[tuple[str, str], Codec] = {}


def _codec(path: str, pattern: str) -> Codec:
    """One codec per worker process."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


def encoded(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and ids of every whole text; ``ids`` are unsigned little-endian 32-bit integers.

    ``pattern`` cuts a text into pre-tokens (the matches, in order); text between matches has no tokens. Long texts are
    matched part by part, cut where a single space stands between two letters or digits, so that the parts give the
    tokens of the whole: this holds for patterns that take a space together with the word behind it. No rows are moved.

    Null and empty texts: no ids. A null doc_id is kept. Repeated rows give a row each. Other columns are ignored. An
    empty table gives an empty result. Special strings are ordinary text.
    """
    def rows(batch: pa.RecordBatch):
        codec = _codec(ranks_path, pattern)
        ids = [codec.encode(text) if text else b"" for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
            ["doc_id", "n_tokens", "ids"])

    return map_batches(texts(docs), rows, SCHEMA)


def decoded(ids: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds ``decoded``, the bytes that the ids stand for; null ids give no bytes. Takes what :func:`encoded` returns."""
    def rows(batch: pa.RecordBatch):
        codec = _codec(ranks_path, pattern)
        data = [codec.decode(x) if x else b"" for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())],
                                         ["doc_id", "n_tokens", "ids", "decoded"])

    return map_batches(ids.select("doc_id", "n_tokens", "ids"), rows, f"{SCHEMA}, decoded binary")


def digests(round_trip: DataFrame) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes."""
    return round_trip.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                             F.sha2("decoded", 256).alias("decoded_sha256"))
