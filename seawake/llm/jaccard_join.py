"""Set join on word shingles by Jaccard similarity: a size-aware heavy-light join.

Sets up to a boundary size are joined on fixed-size subsets (pairs) of their rarest shingles, larger ones by scanning
inverted lists of single shingles; a cost model picks the boundary. Shingles are ordered by rarity, so either way only
the rare ones of a set are looked at. Everything is exact: order, boundary and sketch only change the work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seawake.llm.common import map_batches, texts, written
from seawake.llm.components import components
from seawake.llm.words import SPACED, hashed_windows, hashed_words, mix

SHINGLE = 5
SHARE = 75  # documents link when 100 * intersection >= SHARE * union
SUBSET = 2
LARGEST_SMALL = 64
WORDS = 4  # of 64 bits, of the bitmap of a set's listed tokens
SELDOM = 16  # sets of equal size that link share about a tenth of their shingles in their prefixes
RECENT = 8  # lists before one that are searched for an earlier meeting of a pair
CELLS, BLOCK = 1 << 20, 1 << 14  # of the count sketch, and of a row that carries a part of it
BITS = 1 << 24  # of the bitmap of candidates
ENTRY = np.dtype([("token", "<u8"), ("id", "<i8"), ("n", "<i4"), ("place", "<i4")])
SINGLE, PAIR, COMMON = 0, 1, 2

PARITY = [f"p{k}" for k in range(8)]  # 64 bits each: whether an odd number of a set's shingles falls on a bit
KEYS = "doc_id long, n_shingles long, k1 long, k2 long, block int, cells binary, " + ", ".join(f"{p} long" for p in PARITY)
SIGNED = "doc_id long, n_shingles long, k1 long, k2 long, common int, singles int, tokens binary"
ENTRIES = "token long, id long, n int, place int, kind int"


def doc_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct shingle hashes in ascending order) of every text."""
    for a, b, words, offsets in hashed_words(column, SPACED):
        hashes, at = hashed_windows(words, offsets, SHINGLE)
        for row in range(a, b):
            yield row, np.unique(hashes[at[row - a]:at[row - a + 1]])


def least_overlap(n: int) -> int:
    """Shingles that a set of ``n`` has to share with any set it links with."""
    return -(-SHARE * n // 100)


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    first = np.bitwise_xor.reduce(mix(hashes))
    second = mix(hashes + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
    return int(first.astype(np.int64)), int(second.astype(np.int64))


def parity(hashes: np.ndarray) -> np.ndarray:
    """The parity bitmap of a set. Two sets differ in at least as many shingles as their bitmaps differ in bits."""
    bits = 64 * len(PARITY)
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """Set size, set key and parity bitmap of each document and, in rows of their own, each task's counts of shingles by cell of a
    fixed-size sketch; the block after the last counts small sets by size."""
    def run(batches: Iterator[pa.RecordBatch]):
        cells, sizes = np.zeros(CELLS, np.uint32), np.zeros(BLOCK, np.uint32)
        nothing = [pa.int32(), pa.binary()]
        for batch in batches:
            n = batch.num_rows
            size, k1, k2 = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            odd = np.zeros((len(PARITY), n), np.int64)
            for row, hashes in doc_sets(batch.column(1)):
                size[row] = len(hashes)
                if len(hashes):
                    odd[:, row] = parity(hashes)
                    np.add.at(cells, _cell(hashes), 1)
                    k1[row], k2[row] = set_key(hashes)
                sizes[min(len(hashes), LARGEST_SMALL + 1)] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(k1), pa.array(k2), *(pa.nulls(n, t) for t in nothing),
                 *(pa.array(p) for p in odd)], names)
        parts = [p.tobytes() for p in (*cells.reshape(-1, BLOCK), sizes)]
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(len(parts), pa.int64()) for _ in range(4)), pa.array(range(len(parts)), pa.int32()),
             pa.array(parts, pa.binary()), *(pa.nulls(len(parts), pa.int64()) for _ in PARITY)], names)

    names = [part.split()[0] for part in KEYS.split(", ")]
    return docs.mapInArrow(run, KEYS)


def summed_sketch(keys: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The tasks' sketches added up, and the small sets by size. Equal blocks meet in streams; one sketch reaches the
    driver."""
    def add(batches: Iterator[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(data.as_buffer(), np.uint32)
                sums[block] = sums[block] + part if block in sums else part.copy()
        for block, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             ["block", "cells"])

    blocks = keys.filter("block is not null").select("block", "cells").repartition(F.col("block"))
    parts = {r.block: np.frombuffer(r.cells, np.uint32) for r in blocks.mapInArrow(add, "block int, cells binary").collect()}
    n, none = CELLS // BLOCK, np.zeros(BLOCK, np.uint32)
    return np.concatenate([parts.get(k, none) for k in range(n)]), parts.get(n, none)[:LARGEST_SMALL + 2]


def ranks(cells: np.ndarray) -> np.ndarray:
    """Rarity of a cell: 0 unless its count stands out from the mean, then the logarithm of the excess."""
    mean = cells.mean()
    return np.log2(np.maximum(cells - (mean + 4 * math.sqrt(mean) + 4), 1)).astype(np.uint8)


def boundary(sizes: np.ndarray, cells: np.ndarray) -> int:
    """The size up to which sets are joined on subsets, where the two kinds of work together cost the least.

    Subsets cost one entry each. A single shingle costs an entry and the scan of its list, whose mean length is
    estimated from the sketch: cells of rare shingles vary more than by chance as far as shingles recur. Sets of three
    quarters of the boundary and more also need singles, so that larger sets find them.
    """
    rare = cells[ranks(cells) == 0].astype(np.float64)
    length = max(1.0, rare.var() / max(rare.mean(), 1e-9)) if len(rare) else 1.0
    n = np.arange(len(sizes))
    prefix = n - np.array([least_overlap(int(k)) for k in n]) + 1
    subsets, singles = sizes * (prefix + 1) * prefix / 2, sizes * prefix * (1 + length)
    costs = [subsets[2:x + 1].sum() + singles[max(2, least_overlap(x + 1)):].sum() for x in range(1, LARGEST_SMALL + 1)]
    return 1 + int(np.argmin(costs))


def signed(docs: DataFrame, rank, small: int) -> DataFrame:
    """The tokens that each document is looked up by, with its set size and key.

    ``tokens`` holds ``singles`` shingles, the last ``common`` of which are frequent ones, then subsets.
    """
    def rows(batch: pa.RecordBatch):
        table = rank.value
        n_docs = batch.num_rows
        size, k1, k2 = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
        common, singles, tokens = np.zeros(n_docs, np.int32), np.zeros(n_docs, np.int32), [b""] * n_docs
        for row, hashes in doc_sets(batch.column(1)):
            n = len(hashes)
            if not n:
                continue
            size[row] = n
            k1[row], k2[row] = set_key(hashes)
            order = table[_cell(hashes)]
            prefix = n - least_overlap(n) + 1
            hashes = hashes[np.argsort(order, kind="stable")[:prefix + 1]]
            parts = []
            if n > small or n >= least_overlap(small + 1):
                parts.append(hashes[:prefix])
                singles[row] = prefix
                common[row] = np.count_nonzero(table[_cell(hashes[:prefix])])
            if 1 < n <= small:
                i, j = np.triu_indices(len(hashes), 1)
                parts.append(mix(hashes[i] * np.uint64(0xD6E8FEB86659FD93) + mix(hashes[j])))
            tokens[row] = np.concatenate(parts).tobytes() if parts else b""
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size), pa.array(k1), pa.array(k2), pa.array(common), pa.array(singles),
             pa.array(tokens, pa.binary())], ["doc_id", "n_shingles", "k1", "k2", "common", "singles", "tokens"])

    return map_batches(docs, rows, SIGNED)


def _packed(entries: np.ndarray) -> bytes:
    """Entries field by field: all but the tokens then compress well."""
    return b"".join(entries[name].tobytes() for name in ENTRY.names)


def _unpacked(data: pa.Buffer) -> np.ndarray:
    out, at = np.empty(len(data) // ENTRY.itemsize, ENTRY), 0
    for name in ENTRY.names:
        out[name] = np.frombuffer(data, ENTRY[name], len(out), at)
        at += len(out) * ENTRY[name].itemsize
    return out


def shared_entries(sets: DataFrame, buckets: int) -> DataFrame:
    """(token, id, n, place, kind) of the tokens that two sets or more have.

    Tokens travel packed, by bucket. A token that the sketch calls common is passed on as it is, over many buckets; any
    other one's list is no longer than its cell's count, so a bucket's task stays small.
    """
    def pack(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            parts, where = [], []
            for doc_id, n, common, singles, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                token = np.frombuffer(data, np.uint64)
                entry = np.empty(len(token), ENTRY)
                place = np.arange(len(token), dtype=np.int64)
                kind = np.where(place >= singles, PAIR, np.where(place >= singles - common, COMMON, SINGLE))
                entry["token"], entry["id"], entry["n"] = token, doc_id, n
                entry["place"] = np.where(kind == PAIR, 0, place) * 4 + kind
                key = np.where(kind == COMMON, np.uint64(doc_id & 0xFFFFFFFF), token)
                parts.append(entry)
                where.append(mix(key.astype(np.uint64)) % np.uint64(buckets))
            if not sum(map(len, parts)):
                continue
            entry, where = np.concatenate(parts), np.concatenate(where)
            order = np.argsort(where, kind="stable")
            entry, where = entry[order], where[order]
            bucket, first = np.unique(where, return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.astype(np.int32)), pa.array([_packed(x) for x in np.split(entry, first[1:])], pa.binary())],
                ["bucket", "entries"])

    def live(batches: Iterator[pa.RecordBatch]):
        parts = [_unpacked(x.as_buffer()) for b in batches for x in b.column(1)]
        if not parts:
            return
        entry = np.concatenate(parts)
        kind = entry["place"] & 3
        entry = entry[np.lexsort((kind, entry["token"]))]
        token = entry["token"]
        same = token[1:] == token[:-1]
        keep = (entry["place"] & 3) == COMMON
        keep[1:] |= same
        keep[:-1] |= same
        entry = entry[keep]
        for a in range(0, len(entry), 1 << 16):
            x = entry[a:a + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x["token"].astype(np.int64)), pa.array(x["id"]), pa.array(x["n"]), pa.array(x["place"] >> 2),
                 pa.array(x["place"] & 3)], ["token", "id", "n", "place", "kind"])

    packed = sets.select("doc_id", "n_shingles", "common", "singles", "tokens").mapInArrow(
        pack, "bucket int, entries binary")
    return packed.repartition(buckets, "bucket").mapInArrow(live, ENTRIES)


def _prefix(n: F.Column) -> F.Column:
    return n - F.ceil(n * SHARE / 100) + 1


def _outside(n: F.Column, m: F.Column) -> F.Column:
    """The most shingles that two sets can share outside their prefixes."""
    return F.greatest(n - _prefix(n), m - _prefix(m))


def _enough(shared: F.Column, n: F.Column, m: F.Column) -> F.Column:
    """Whether so many shared prefix tokens are enough for a link."""
    return (shared + _outside(n, m)) * (100 + SHARE) >= (n + m) * SHARE


def _most_shared() -> F.Column:
    """The most listed tokens that two sets can share: no more than either has, nor than their bitmaps have in common
    and one of them has on bits that are taken already."""
    common = sum(F.bit_count(F.col(f"a.w{k}").bitwiseAND(F.col(f"b.w{k}"))) for k in range(WORDS))
    return F.least(F.col("a.live"), F.col("b.live"), common + F.least(F.col("a.twice"), F.col("b.twice")))


def parities(sets: DataFrame) -> DataFrame:
    """The parity bitmap of each id (NULL for an id of different sets, which is then compared whatever the bits say)."""
    one = (F.min("k1") == F.max("k1")) & (F.min("k2") == F.max("k2"))
    return sets.filter("n_shingles > 0 and doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        *[F.when(one, F.first(p)).alias(p) for p in PARITY])


def _near_enough() -> F.Column:
    """Whether the whole sets, by their sizes and parity bitmaps, can share enough for a link."""
    apart = sum(F.bit_count(F.col(f"a.{p}").bitwiseXOR(F.col(f"b.{p}"))) for p in PARITY)
    both = F.col("a.n") + F.col("b.n")
    return (both - F.coalesce(apart, F.lit(0))) * (100 + SHARE) >= both * 2 * SHARE


def _may_link() -> F.Column:
    """Whether a pair's sizes, shared prefix tokens (``c``) and the last of their places leave room for a link.

    Whatever else the two have in common stands behind the last shared token in both, and behind the prefix of at
    least one of them.
    """
    behind = F.least(F.col("n") - F.col("place_a"), F.col("m") - F.col("place_b")) - 1
    most = F.col("c") + F.least(behind, _outside(F.col("n"), F.col("m")))
    return (F.col("subsets") > 0) | ((F.col("c") > 0) & (most * (100 + SHARE) >= (F.col("n") + F.col("m")) * SHARE))


def linked(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose documents really link, by their whole texts.

    The texts of documents in a pair are picked by a bitmap of fixed size, written once and joined on either side.
    """
    spark = docs.sparkSession
    bit = F.pmod(F.xxhash64("id"), F.lit(BITS))
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    words = ids.select((bit / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {BITS}) % 64 as int))").alias("bit"))
    set_words = words.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toPandas()  # at most BITS / 64 rows
    bitmap = np.zeros(BITS // 64, np.int64)
    bitmap[set_words.word.to_numpy(np.int64)] = set_words.bits.to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(np.unpackbits(bitmap.view(np.uint8), bitorder="little").view(bool))

    def chosen(batch: pa.RecordBatch):
        keep = shared.value[batch.column(2).to_numpy()]
        if keep.any():
            yield batch.select([0, 1]).filter(pa.array(keep))

    known = docs.filter("doc_id is not null").select(
        "doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(BITS)).alias("bit"))
    picked = written(map_batches(known, chosen, "doc_id long, text string"), "picked")
    both = pairs.join(picked.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(picked.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def check(batch: pa.RecordBatch):
        left = dict(doc_sets(batch.column(2)))
        keep = np.zeros(batch.num_rows, bool)
        for row, right in doc_sets(batch.column(3)):
            mine = left[row]
            shared_n = len(np.intersect1d(mine, right, assume_unique=True))
            keep[row] = shared_n > 0 and 100 * shared_n >= SHARE * (len(mine) + len(right) - shared_n)
        if keep.any():
            yield batch.select([0, 1]).filter(pa.array(keep))

    return map_batches(both.select("a", "b", "text_a", "text_b"), check, "a long, b long").distinct()


def near_copies(entries: DataFrame) -> DataFrame:
    """One promising partner (b) for each set (a): the leader it meets most often.

    A token's leader is the set for which it is among the rarest; in a group of near copies that is one with few
    changes of its own. The number of pairs grows with the entries, not with their square. A set that meets its leader
    too seldom for a link is left to the second step, as are all other partners.
    """
    leader = entries.groupBy("token").agg(
        F.min_by("id", F.shiftleft(F.col("place").cast("long"), 40) + F.pmod(F.xxhash64("id"), F.lit(1 << 40))).alias("b"),
        F.count("*").alias("length")).filter("length > 1").drop("length")
    met = entries.join(leader, "token").filter("id <> b").groupBy("id", "b").agg(
        F.count("*").alias("times"), F.first("n").alias("n"))
    met = met.filter(F.col("times") * SELDOM >= F.col("n"))
    return met.groupBy(F.col("id").alias("a")).agg(F.max_by("b", "times").alias("b"))


def cross_pairs(entries: DataFrame, groups: DataFrame, small: int, bitmaps: DataFrame) -> DataFrame:
    """All pairs that share tokens, may link by their number and places and by their parity bitmaps, and are not yet in
    one group.

    Tokens with equal lists are taken together: their common list is joined once. In each list the largest group is set
    aside: its sets meet those of other groups, never one another. Lists have one order, and a pair is not made again
    in a list if one of the RECENT lists before it has already brought the two together; so near copies, which share
    hundreds of lists, are made a few times only. The first list that two sets share always makes the pair, and the
    other conditions are the same in each of their lists.
    """
    entries = entries.join(groups.withColumnRenamed("component", "own"), "id", "left")
    entries = written(entries.withColumn("own", F.coalesce("own", "id")).withColumn("subset", F.col("kind") == PAIR), "entries")
    lists = entries.groupBy("token", "subset").agg(
        F.min("own").alias("lo"), F.max("own").alias("hi"), F.expr("bit_xor(xxhash64(id))").alias("list1"),
        F.expr("bit_xor(xxhash64(id, 1))").alias("list2")).filter("lo < hi").drop("lo", "hi")
    entries = entries.join(lists, ["token", "subset"])
    spot = f"pmod(xxhash64(token, 1), {64 * WORDS})"
    marks = [F.expr(f"bit_or(if({spot} div 64 = {k}, shiftleft(1L, cast({spot} % 64 as int)), 0L))").alias(f"w{k}")
             for k in range(WORDS)]
    singles = entries.filter("not subset").groupBy("id").agg(
        F.count("*").alias("live"), *marks, F.array_sort(F.collect_list(F.struct("place", "token"))).alias("listed"))
    singles = singles.withColumn("twice", F.col("live") - sum(F.bit_count(f"w{k}") for k in range(WORDS)))
    singles = written(singles, "singles")
    alike = ["list1", "list2", "subset"]
    entries = entries.groupBy("id", *alike).agg(F.max("n").alias("n"), F.max("own").alias("own"))
    before = Window.partitionBy("id").orderBy(F.desc("subset"), "list1", "list2").rowsBetween(-RECENT, -1)
    entries = entries.withColumn("recent", F.collect_list("list1").over(before))
    entries = written(entries.join(singles.drop("listed"), "id", "left").join(bitmaps, "id", "left"), "lists")
    largest = entries.groupBy(*alike, "own").agg(F.count("*").alias("sets")).groupBy(*alike).agg(
        F.max_by("own", "sets").alias("main"))
    entries = entries.join(largest, alike)
    a, b = entries.filter("own <> main").alias("a"), entries.alias("b")
    once = (F.col("b.own") == F.col("b.main")) | (F.col("a.id") < F.col("b.id"))
    subset = F.col("a.subset")
    needed = subset | (F.col("a.n") > small) | (F.col("b.n") > small)
    sized = (F.col("a.n") * 100 >= F.col("b.n") * SHARE) & (F.col("b.n") * 100 >= F.col("a.n") * SHARE)
    met = a.join(b, (F.col("a.list1") == F.col("b.list1")) & (F.col("a.list2") == F.col("b.list2"))
                 & (F.col("a.subset") == F.col("b.subset")) & (F.col("a.own") != F.col("b.own")) & once & needed & sized
                 & _near_enough() & (subset | _enough(_most_shared(), F.col("a.n"), F.col("b.n")))
                 & ~F.arrays_overlap("a.recent", "b.recent"))
    pairs = met.groupBy(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).agg(
        F.max(F.when(F.col("a.id") < F.col("b.id"), F.col("a.n")).otherwise(F.col("b.n"))).alias("n"),
        F.max(F.when(F.col("a.id") < F.col("b.id"), F.col("b.n")).otherwise(F.col("a.n"))).alias("m"),
        F.max(subset.cast("int")).alias("subsets"))
    held = singles.select("id", F.col("listed.token").alias("tokens"), F.col("listed.place").alias("places"))
    for x in "ab":
        pairs = pairs.join(held.select(F.col("id").alias(x), F.col("tokens").alias(f"tokens_{x}"),
                                       F.col("places").alias(f"places_{x}")), x, "left")
    shared = F.array_intersect("tokens_a", "tokens_b")
    pairs = pairs.withColumn("c", F.coalesce(F.size(shared), F.lit(0))).withColumn("last", F.try_element_at(shared, F.lit(-1)))
    for x in "ab":
        place = F.try_element_at(f"places_{x}", F.array_position(f"tokens_{x}", F.col("last")).cast("int"))
        pairs = pairs.withColumn(f"place_{x}", F.when(F.col("last").isNotNull(), place))
    return pairs.filter(_may_link()).select("a", "b")


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """Set size and group of every document: documents link when 100 * intersection >= 75 * union of their shingles.

    Returns doc_id, n_shingles and component_id, the smallest doc_id that can be reached by links. Equal sets are
    joined by a key first. Of groups of near copies only one link for each set is looked for at first; then sets of
    different groups are compared, so that no group's pairs are written out and yet no link between groups is lost.

    Texts that are null, empty or without words: 0 shingles, a group of their own. A null doc_id: the group of the
    documents with an equal set, else null; it makes no links. Rows that share a doc_id are ends of the same links.
    Other columns are ignored. An empty table gives an empty result.
    """
    docs = texts(docs)
    spark = docs.sparkSession
    keys = written(keyed(docs), "keys")
    cells, sizes = summed_sketch(keys)
    small = boundary(sizes, cells)
    sets = keys.filter("block is null").select("doc_id", "n_shingles", "k1", "k2", *PARITY)
    classes = sets.filter("n_shingles > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    tokens = signed(docs, spark.sparkContext.broadcast(ranks(cells)), small)
    reps = classes.filter("rep is not null").select("k1", "k2", F.col("rep").alias("doc_id"))
    reps = tokens.filter("n_shingles > 0 and doc_id is not null").join(reps, ["k1", "k2", "doc_id"], "left_semi")
    entries = written(shared_entries(reps, _buckets(sets)), "entries").dropDuplicates(["token", "id", "kind"])

    links = written(linked(near_copies(entries), docs), "links")
    links = links.unionByName(written(linked(written(
        cross_pairs(entries, components(links), small, parities(sets)), "pairs"), docs), "links"))
    groups = components(links)

    kept = classes.join(groups, classes.rep == groups.id, "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("group"))
    out = sets.select("doc_id", "n_shingles", "k1", "k2").join(kept, ["k1", "k2"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("group")).otherwise(
        F.col("doc_id")).alias("component_id"))


def _buckets(sets: DataFrame) -> int:
    """Buckets of about half a million entries, and one for each shuffle partition at least."""
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    least = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, int(total * (100 - SHARE) / 100) // 500_000 + 1)
