"""Alignment of two tokenizers' tokens over the same bytes.

The texts' character offsets (tokenizers) and the spans of sentencepiece's proto give the byte at which most tokens end.
Tokens that end inside a character, which two or more of them share, and byte-fallback tokens, whose span is empty, are
placed by their decoded bytes, counted from the last end that is known. Where tokens of both sides end, a group ends.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.byte_bpe import unmapped
from seawake.llm.common import map_batches, texts, written

SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
          "links array<struct<a:int,b:int,times:long>>")
PART_CHARS, BATCH_CHARS = 1 << 13, 1 << 19  # characters encoded as one text, and held at once unless one text is longer
LARGE_GROUP = 1 << 16  # links of a group beyond which its ids are counted before they are paired
REMEMBERED, LONGEST_KEPT = 1 << 19, 60  # stretches of text whose alignment a worker keeps, and their characters
FREQUENT = 1 << 18  # id pairs whose counts are sent to all tasks; the others are joined
SPACE = "▁"


class Tokens:
    """Tokens of a text: ids, the byte at which each ends, and whether they spell the text's bytes."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, known: np.ndarray, lengths: np.ndarray):
        """``ends`` hold where ``known``; other tokens end as many bytes later as were decoded since."""
        upto = np.cumsum(lengths)
        last = np.maximum.accumulate(np.where(known, np.arange(len(ids)), -1))
        self.ids = ids
        self.ends = np.where(last < 0, upto, ends[last] + upto - np.where(last < 0, 0, upto[last]))


class ByteLevel:
    """A byte-level BPE of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.encoder.encode_special_tokens = True
        size = self.encoder.get_vocab_size(with_added_tokens=True)
        self.names = [str(i) for i in range(size)]
        self.bytes = [self._decoded(i) for i in range(size)]
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)

    def _decoded(self, i: int) -> bytes:
        piece = self.encoder.id_to_token(i)
        try:
            return unmapped(piece)
        except KeyError:  # an added token; no text has it
            return piece.encode()

    def encode(self, parts: list[str], data: list[bytes]) -> Iterator[Tokens | None]:
        """Tokens of a space and each part (``data``, in UTF-8); None if they spell something else."""
        for part, spelt, found in zip(parts, data, self.encoder.encode_batch([" " + x for x in parts],
                                                                             add_special_tokens=False), strict=True):
            ids = found.ids
            if b"".join([self.bytes[i] for i in ids]) != spelt:
                yield None
                continue
            ids, spans = np.array(ids, np.int64), np.fromiter(chain.from_iterable(found.offsets), np.int64).reshape(-1, 2)
            if len(spelt) > len(part) + 1:
                spans = _character_begins(spelt)[spans]
            # A token that the next one begins before the end of shares its last character.
            known = np.append(spans[1:, 0] >= spans[:-1, 1], True)
            yield Tokens(ids, spans[:, 1], known, self.lengths[ids])


class Pieces:
    """A sentencepiece model that puts a space before the text and falls back to bytes."""

    def __init__(self, path: str):
        import sentencepiece

        self.encoder = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.encoder.get_piece_size()
        self.names = [str(i) for i in range(size)]
        self.bytes = [bytes([int(self.encoder.id_to_piece(i)[3:-1], 16)]) if self.encoder.is_byte(i)
                      else self.encoder.id_to_piece(i).replace(SPACE, " ").encode() for i in range(size)]
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)

    def encode(self, parts: list[str], data: list[bytes]) -> Iterator[Tokens | None]:
        found = self.encoder.encode(parts, return_type="proto", num_threads=1)
        for spelt, proto in zip(data, found, strict=True):
            numbers = [n for x in proto.pieces for n in (x.id, x.end)]
            ids = numbers[::2]
            if b"".join([self.bytes[i] for i in ids]) != spelt:
                yield None
                continue
            ids = np.array(ids, np.int64)
            ends = np.array(numbers[1::2], np.int64)  # in bytes of the text, the added space not counted
            known = np.diff(ends, prepend=0) > 0  # spans follow each other; that of a byte before the last is empty
            yield Tokens(ids, ends + 1, known, self.lengths[ids])


def _character_begins(data: bytes) -> np.ndarray:
    """The byte at which each character begins, and the number of bytes."""
    at = np.frombuffer(data, np.uint8)
    return np.append(np.flatnonzero((at & 0xC0) != 0x80), len(data))


def _linked(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, size_b: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair, times) of the links of groups that begin at ``cut_a`` and ``cut_b``, group by group; a pair, which is
    a * ``size_b`` + b, may come more than once. Large groups come last, their ids counted first."""
    n_a, n_b = np.diff(cut_a), np.diff(cut_b)
    large = np.flatnonzero(n_a * n_b > LARGE_GROUP)
    some = np.ones(len(n_a), bool)
    some[large] = False
    group = np.repeat(np.arange(len(n_a)), n_a)
    left = np.flatnonzero(some[group])
    times = n_b[group[left]]
    first = cut_b[:-1][group[left]]
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    parts = [(np.repeat(a[left] * size_b, times) + b[np.repeat(first, times) + within], np.ones(len(within), np.int64))]
    for g in large:
        ids_a, count_a = np.unique(a[cut_a[g]:cut_a[g + 1]], return_counts=True)
        ids_b, count_b = np.unique(b[cut_b[g]:cut_b[g + 1]], return_counts=True)
        parts.append(((ids_a[:, None] * size_b + ids_b).ravel(), np.outer(count_a, count_b).ravel()))
    return tuple(np.concatenate(x) for x in zip(*parts))


#: A single space between two characters that are no spaces: tokens of both sides end before it (a byte-level word takes
#: the space before it along, a piece has spaces at its start only), and what follows is encoded as if it stood alone.
SAFE = re.compile(rf" (?<=[^\s{SPACE}] )(?=[^\s{SPACE}])")
EDGE = re.compile(rf"[^\s{SPACE}](?s:.*[^\s{SPACE}])?")  # what may stand next to such a space
NOTHING = ("", b"", 0, 0, 0, 0, False)


class Aligner:
    """Aligns texts stretch by stretch; a worker keeps the alignments of stretches it has met.

    A text is cut at every safe boundary, mostly into words. New stretches are encoded together, joined by the spaces
    that such boundaries are, so that a batch costs a few calls of either library. An alignment is (groups, links in
    bytes, numbers of A tokens, B tokens, groups and links, whether the tokens spell the text).
    """

    def __init__(self, byte_level: str, pieces: str):
        self.left, self.right = ByteLevel(byte_level), Pieces(pieces)
        self.known: dict[str, tuple] = {}

    def learn(self, stretches: Iterable[str]) -> None:
        joined, length, parts = [], 0, []
        for x in stretches:
            if len(x) <= LONGEST_KEPT and EDGE.fullmatch(x):
                joined.append(x)
                length += len(x) + 1
                if length >= PART_CHARS:
                    parts.append(joined)
                    joined, length = [], 0
            else:
                parts.append([x])
        self._align([*parts, joined] if joined else parts)

    def _align(self, parts: list[list[str]]) -> None:
        alone = []
        text = [" ".join(p) for p in parts]
        data = [b" " + x.encode() for x in text]
        for part, a, b in zip(parts, self.left.encode(text, data), self.right.encode(text, data), strict=True):
            if a is not None and b is not None:
                self._keep(part, a, b)
            elif len(part) == 1:
                self.known[part[0]] = NOTHING
            else:
                alone += [[x] for x in part]
        if alone:
            self._align(alone)

    def _keep(self, part: list[str], a: Tokens, b: Tokens) -> None:
        both = np.intersect1d(a.ends, b.ends, assume_unique=True)
        cut_a = np.concatenate(([0], np.searchsorted(a.ends, both, "right")))
        cut_b = np.concatenate(([0], np.searchsorted(b.ends, both, "right")))
        upto = np.concatenate(([0], np.cumsum(np.diff(cut_a) * np.diff(cut_b))))
        names_a, names_b = self.left.names, self.right.names
        text_a, text_b = [names_a[i] for i in a.ids.tolist()], [names_b[i] for i in b.ids.tolist()]
        at_a, at_b = cut_a.tolist(), cut_b.tolist()
        groups = [
            (text_a[i] if j - i == 1 else ",".join(text_a[i:j])) + "|" + (text_b[k] if m - k == 1 else ",".join(text_b[k:m]))
            for i, j, k, m in zip(at_a, at_a[1:], at_b, at_b[1:])]
        links = np.stack(_linked(a.ids, b.ids, cut_a, cut_b, len(names_b)), axis=1).tobytes()
        if len(part) == 1:
            self.known[part[0]] = (";".join(groups), links, len(a.ids), len(b.ids), len(both), int(upto[-1]), True)
            return
        # Small stretches have no large groups, so their links lie in the order of the groups.
        end = np.cumsum([len(x.encode()) + 1 for x in part])
        group = np.searchsorted(both, end, "right")
        edges = [np.concatenate(([0], x)).tolist() for x in (group, cut_a[group], cut_b[group], upto[group])]
        for x, g, h, i, j, k, m, low, high in zip(part, *(y for e in edges for y in (e, e[1:]))):
            self.known[x] = (";".join(groups[g:h]), links[16 * low:16 * high], j - i, m - k, h - g, high - low, True)

    def document(self, stretches: list[str]) -> tuple[np.ndarray, str, np.ndarray, np.ndarray]:
        """Numbers, groups and links (pair, times; each pair once) of a text whose stretches are known."""
        if stretches:
            groups, links, *numbers, whole = zip(*map(self.known.__getitem__, stretches))
            if all(whole):
                link = np.frombuffer(b"".join(links), np.int64).reshape(-1, 2)
                pair, at = np.unique(link[:, 0], return_inverse=True)
                times = np.bincount(at, weights=link[:, 1]).astype(np.int64)
                return np.array([sum(x) for x in numbers]), ";".join(groups), pair, times
        return np.zeros(4, np.int64), "", np.empty(0, np.int64), np.empty(0, np.int64)

    def documents(self, batch: list[list[str]]) -> list[tuple]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = set().union(*batch).difference(self.known)
        self.learn(new)
        out = [self.document(x) for x in batch]
        for x in new:
            if len(x) > LONGEST_KEPT:
                del self.known[x]
        return out


_LOADED: dict[tuple[str, str], Aligner] = {}


def _aligner(byte_level: str, pieces: str) -> Aligner:
    """One aligner per worker process."""
    if (byte_level, pieces) not in _LOADED:
        _LOADED[byte_level, pieces] = Aligner(byte_level, pieces)
    return _LOADED[byte_level, pieces]


def aligned(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """The alignment of every whole text: A is the byte-level tokenizer on a space and the text, B the sentencepiece model.

    Returns doc_id, the numbers of tokens, groups and links, ``groups`` (``a1,a2|b1;a3|b2,b3``: ids in order) and
    ``links`` (each linked pair of ids once, with its number of links in the document). No rows are moved.

    Texts that are null or empty, or whose tokens on either side spell other bytes than the text's (normalisation, a
    ``▁`` in the text), have zeros, an empty ``groups`` and no links. A null doc_id is kept. Repeated rows give a row
    each. Other columns are ignored. An empty table gives an empty result. Special strings are ordinary text.
    """
    def rows(batch: pa.RecordBatch):
        aligner = _aligner(byte_level, pieces)
        found: list[tuple] = []
        waiting: list[list[str]] = []
        size = 0
        for text in batch.column(1).to_pylist():
            waiting.append(SAFE.split(text) if text else [])
            size += len(text or "")
            if size >= BATCH_CHARS:
                found += aligner.documents(waiting)
                waiting, size = [], 0
        found += aligner.documents(waiting) if waiting else []
        yield _batch(batch.column(0), found, len(aligner.right.names))

    return map_batches(texts(docs), rows, SCHEMA)


def _batch(ids: pa.Array, found: list[tuple], size_b: int) -> pa.RecordBatch:
    numbers, groups, pairs, times = zip(*found)
    pair = np.concatenate(pairs)
    offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in pairs]))), pa.int32())
    struct = pa.StructArray.from_arrays([pa.array(pair // size_b, pa.int32()), pa.array(pair % size_b, pa.int32()),
                                         pa.array(np.concatenate(times))], ["a", "b", "times"])
    return pa.RecordBatch.from_arrays(
        [ids, *(pa.array(n) for n in np.array(numbers).T), pa.array(groups, pa.string()),
         pa.ListArray.from_arrays(offsets, struct)], [part.split()[0] for part in SCHEMA.split(", ")])


def pair_counts(links: DataFrame) -> DataFrame:
    """(a, b, count, best): in how many documents a pair of ids is linked, and whether no other b is linked with a in
    more of them. Takes a column ``links``. Counting starts in the map tasks; what is moved then has the size of the
    pairs, and each a has at most as many of them as there are b."""
    counts = links.select(F.inline("links")).groupBy("a", "b").agg(F.count("*").alias("count"))
    counts = written(counts, "pair_counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def _least_size(counts: DataFrame, most: int) -> int:
    """The smallest size (a logarithm of the count) from which on there are no more than ``most`` pairs."""
    number = {r["size"]: r["count"] for r in counts.groupBy("size").count().collect()}  # a few hundred rows
    least, taken = max(number, default=0) + 1, 0
    for size in sorted(number, reverse=True):
        taken += number[size]
        if taken > most:
            break
        least = size
    return least


def with_counts(found: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` to what :func:`aligned` returns: the links whose pair is the most frequent one
    of its a, and the pairs' counts added up over the links.

    The ``frequent`` most frequent pairs go to all tasks (a bounded table), so that a pair which most documents have is
    never the key of a shuffle; the other pairs, which by then are rare, are joined by key.
    """
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = written(pair_counts(found).withColumn("size", F.floor(F.log2("count") * 8).cast("int")), "pairs")
    least = _least_size(counts, frequent)
    top, rest = F.broadcast(counts.filter(F.col("size") >= least)), counts.filter(F.col("size") < least)
    each = found.select("row", F.inline("links"))
    rare = each.join(F.broadcast(top.select("a", "b")), ["a", "b"], "left_anti")
    scored = each.join(top, ["a", "b"]).unionByName(rare.join(rest, ["a", "b"]))
    sums = scored.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                     F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    return found.drop("links").join(sums, "row", "left").drop("row").fillna(0, ["n_best", "count_sum"])


def digests(found: DataFrame) -> DataFrame:
    """Replaces ``groups`` by its digest; no tokens, no digest."""
    empty = F.col("n_a") == 0
    return found.withColumn("groups_sha256", F.when(empty, "").otherwise(F.sha2("groups", 256))).drop("groups")
