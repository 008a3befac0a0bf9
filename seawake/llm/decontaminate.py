"""Benchmark decontamination: prefix-filtered join of document shingles with windows of benchmark items."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.llm.common import map_batches, texts, written
from seawake.llm.words import ALNUM, hashed_windows, hashed_words

WINDOW, SHINGLE = 10, 3
BLOCK_BYTES = 4 << 20  # of benchmark text whose windows are searched for at once
FOUND = "doc_id long, row binary, n_words long, spans array<long>, items array<string>"
RESULT = "doc_id long, row binary, n_words long, n_hit long, spans array<long>, items array<string>"


@dataclass(frozen=True)
class Windows:
    """Windows of one length: their word hashes, a row each, and the items that hold each."""
    size: int
    words: np.ndarray
    items: list[tuple[str, ...]]

    @property
    def shingle(self) -> int:
        return min(SHINGLE, self.size)

    def shingles(self) -> np.ndarray:
        """A row of shingle hashes for each window."""
        n = len(self.words)
        flat, _ = hashed_windows(self.words.ravel(), np.arange(n + 1) * self.size, self.shingle)
        return flat.reshape(n, -1)


def item_windows(items: list[tuple[str | None, str]], size: int = WINDOW) -> list[Windows]:
    """Distinct windows of a block of items, by length. An item shorter than ``size`` is one window; one without an id
    has windows, and names no item."""
    held: dict[int, dict[bytes, set[str | None]]] = defaultdict(lambda: defaultdict(set))
    for a, b, words, offsets in hashed_words(pa.array([t for _, t in items], pa.string()), ALNUM):
        for row in range(a, b):
            own = words[offsets[row - a]:offsets[row - a + 1]]
            n = min(size, len(own))
            for k in range(len(own) - n + 1 if n else 0):
                held[n][own[k:k + n].tobytes()].add(items[row][0])
    return [Windows(n, np.array([np.frombuffer(w, np.uint64) for w in found]).reshape(-1, n),
                    [tuple(sorted(x - {None})) for x in found.values()]) for n, found in sorted(held.items())]


class Members:
    """Tells which 64-bit hashes belong to a set, and where: a bit table first, then binary search."""

    def __init__(self, hashes: np.ndarray):
        self.values = np.unique(hashes)
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.values >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that hold members, and the members' numbers."""
        maybe = np.flatnonzero(self.table[(hashes >> np.uint64(44)).astype(np.int64)])
        if not len(maybe):
            return maybe, maybe
        at = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
        good = self.values[at] == hashes[maybe]
        return maybe[good], at[good]


def shingle_counts(docs: DataFrame, windows: list[Windows]) -> dict[int, int]:
    """How often each benchmark shingle stands in the whole corpus; a block's shingles at most come back."""
    wanted = {k: Members(np.concatenate([w.shingles().ravel() for w in windows if w.shingle == k]))
              for k in {w.shingle for w in windows}}

    def count(batches: Iterator[pa.RecordBatch]):
        sums = {k: np.zeros(len(m.values), np.int64) for k, m in wanted.items()}
        for batch in batches:
            for _, _, words, offsets in hashed_words(batch.column(0), ALNUM):
                for k, members in wanted.items():
                    _, which = members.find(hashed_windows(words, offsets, k)[0])
                    sums[k] += np.bincount(which, minlength=len(members.values))
        for k, total in sums.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(wanted[k].values[some].view(np.int64)), pa.array(total[some])],
                                             ["shingle", "n"])

    rows = docs.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {r.shingle: r.n for r in rows.collect()}


@dataclass(frozen=True)
class Prefixes:
    """The rarest shingle of every window of one length: for exact containment a prefix of one is enough."""
    windows: Windows
    members: Members
    first: np.ndarray  # of each member's windows in the two arrays below
    window: np.ndarray
    offset: np.ndarray


def prefixes(windows: Windows, counts: dict[int, int]) -> Prefixes:
    grid = windows.shingles()
    df = np.array([counts.get(int(x), 0) for x in grid.ravel().view(np.int64)]).reshape(grid.shape)
    hash_order = np.argsort(np.argsort(grid, axis=None)).reshape(grid.shape)
    offset = np.lexsort((hash_order, df), axis=1)[:, 0]
    chosen = grid[np.arange(len(grid)), offset]
    members = Members(chosen)
    which = np.searchsorted(members.values, chosen)
    order = np.argsort(which, kind="stable")
    return Prefixes(windows, members, np.searchsorted(which[order], np.arange(len(members.values) + 1)), order,
                    offset[order])


def occurrences(words: np.ndarray, offsets: np.ndarray, search: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """Where windows occur: their first words' positions and the windows' numbers."""
    size, k = search.windows.size, search.windows.shingle
    counts = np.diff(offsets)
    hashes, at = hashed_windows(words, offsets, k)
    spot, member = search.members.find(hashes)
    if not len(spot):
        return spot, spot
    row = np.searchsorted(at, spot, "right") - 1
    full = counts[row] >= k  # shorter rows have one hash of all their words, which is no shingle
    spot, member, row = spot[full], member[full], row[full]
    position = spot - at[row] + offsets[row]
    many = search.first[member + 1] - search.first[member]
    row, position = np.repeat(row, many), np.repeat(position, many)
    ends = np.cumsum(many)
    entry = np.repeat(search.first[member] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)
    begin, window = position - search.offset[entry], search.window[entry]
    inside = (begin >= offsets[row]) & (begin + size <= offsets[row + 1])  # the window's other words are in the text
    begin, window = begin[inside], window[inside]
    same = np.ones(len(begin), bool)
    for j in range(size):
        same &= words[np.minimum(begin + j, len(words) - 1)] == search.windows.words[window, j]
    return begin[same], window[same]


def row_digest(text: Column) -> Column:
    """Tells rows that share a doc_id apart by their text."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def scan(docs: DataFrame, searches: list[Prefixes]) -> DataFrame:
    """Hit spans (pairs of first word and word after the last, merged) and items of every document for one block."""
    def rows(batch: pa.RecordBatch):
        n = batch.num_rows
        n_words, spans, items = np.zeros(n, np.int64), [[] for _ in range(n)], [[] for _ in range(n)]
        for a, b, words, offsets in hashed_words(batch.column(1), ALNUM):
            n_words[a:b] = np.diff(offsets)
            cover = np.zeros(len(words) + 1, np.int64)
            held: dict[int, set[str]] = defaultdict(set)
            for search in searches:
                begin, window = occurrences(words, offsets, search)
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + search.windows.size, -1)
                rows_hit = np.searchsorted(offsets, begin, "right") - 1
                for pair in np.unique(np.column_stack((rows_hit, window)), axis=0) if len(begin) else ():
                    held[int(pair[0])].update(search.windows.items[pair[1]])
            if not held:
                continue
            hit = np.concatenate(([False], np.cumsum(cover[:-1]) > 0, [False]))
            for row, names in held.items():
                lo, hi = offsets[row], offsets[row + 1]
                own = np.concatenate(([False], hit[lo + 1:hi + 1], [False]))
                spans[a + row] = np.flatnonzero(own[1:] != own[:-1]).tolist()
                items[a + row] = sorted(names)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n_words), pa.array(spans, pa.list_(pa.int64())),
             pa.array(items, pa.list_(pa.string()))], ["doc_id", "row", "n_words", "spans", "items"])

    keyed = docs.select("doc_id", "text", row_digest(F.col("text")).alias("row"))
    return map_batches(keyed, rows, FOUND)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """Items in blocks of about ``block_bytes``, so that what is sent to the tasks is bounded for any benchmark."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // block_bytes + 1
    for k in range(n):
        yield [(r.item_id, r.text) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
               .dropDuplicates().collect()]


def _searches(docs: DataFrame, items: list[tuple[str | None, str]], size: int) -> list[Prefixes]:
    windows = item_windows(items, size)
    counts = shingle_counts(docs, windows) if windows else {}
    return [prefixes(w, counts) for w in windows]


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, with all their columns, in whose text no benchmark window occurs.

    Every row is judged by its own text where it lies; nothing is shuffled. Rows without words are clean. A block's
    clean rows are what the next block is searched for in.
    """
    schema, at = docs.schema, docs.columns.index("text")
    left, last = docs, None
    for items in _blocks(benchmark, block_bytes):
        left = left if last is None else written(last, "clean")
        last = _without(left, _searches(texts(left), items, size), at, schema)
    return last


def _without(docs: DataFrame, searches: list[Prefixes], at: int, schema: T.StructType) -> DataFrame:
    def rows(batch: pa.RecordBatch):
        keep = np.ones(batch.num_rows, bool)
        for a, _, words, offsets in hashed_words(batch.column(at), ALNUM):
            for search in searches:
                begin, _ = occurrences(words, offsets, search)
                keep[a + np.searchsorted(offsets, begin, "right") - 1] = False
        if keep.any():
            yield batch.filter(pa.array(keep))

    return map_batches(docs, rows, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Words of every whole document that lie inside an occurrence of a benchmark window.

    Shingles of the windows are counted in the corpus; each window is looked up by its rarest one, then checked for
    room before and behind it and compared word by word. The benchmark is the query set: it is sent to the tasks in
    blocks of ``block_bytes`` of text, one after the other, and documents stay where they are.

    Returns doc_id, row (a digest of the text), n_words, n_hit, spans (first word and word after the last of each hit stretch, in turn) and items
    (ids as sorted strings). Null and empty texts: no words. Null doc_ids are kept, repeated rows give a row each.
    Items without text or words match nothing; the windows of an item without an id count, and only its id is missing
    in ``items``; items that share an id count once. Other columns are ignored.
    """
    docs = texts(docs)
    parts: list[DataFrame] = []
    for items in _blocks(benchmark, block_bytes):
        if len(parts) == 1:
            parts = [written(parts[0], "found")]
        part = scan(docs, _searches(docs, items, size))
        parts.append(written(part, "found") if parts else part)  # a block is dropped before the next one is built
    found, blocks = reduce(DataFrame.unionByName, parts), len(parts)
    if blocks > 1:  # a group has a row for each block and repeated row
        found = found.groupBy("doc_id", "row", "n_words").agg(
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count("*") / blocks).cast("int").alias("copies"))
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*_names(FOUND))

    def finish(batch: pa.RecordBatch):
        merged = [_merged(x) for x in batch.column(3).to_pylist()]
        n_hit = [sum(x[1::2]) - sum(x[::2]) for x in merged]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(n_hit, pa.int64()),
             pa.array(merged, pa.list_(pa.int64())), batch.column(4)], _names(RESULT))

    return map_batches(found, finish, RESULT)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _merged(spans: list[int]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def with_digests(found: DataFrame) -> DataFrame:
    """The operator's result with digest columns in place of its lists."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))
