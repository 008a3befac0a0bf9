"""Token-ID output: flat unsigned integers with 64-bit document offsets, memory-mapped."""

from __future__ import annotations

import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seawake.llm.common import posix_dir, texts

PARTS = "part int, n_docs long, n_ids long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"
READ_DOCS = 4096
#: Characters of the fast path: below the combining marks, and lower-cased one for one.
SLOW = re.compile("[^\x00-įı-ſ]|<\\|")
SPACE_AFTER = re.compile(r"(?<=[^\W_]) (?=[^\W_])")
LETTER, NUMBER, OTHER = 1, 2, 3
CONTRACTIONS = {"s": 1, "t": 1, "re": 2, "ve": 2, "m": 1, "ll": 2, "d": 1}


class WordEncoder:
    """Ids of texts under a tokenizers file whose words are encoded one by one.

    The library encodes each distinct word once per worker; known words are found by a 64-bit hash of their
    characters. Texts with characters outside Latin, or with what may be a special token, go to the library whole.
    ``most_words`` bounds the table of known words, which is then begun anew.
    """

    def __init__(self, path: str, most_words: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.most_words = most_words
        random = np.random.default_rng(7)
        self.value = random.integers(1, 2**63, 0x180, dtype=np.uint64) | np.uint64(1)
        self.kind = np.array([_kind(chr(c)) for c in range(0x180)], np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.begin, self.length = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool, self.used = np.empty(1 << 16, np.uint32), 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        fast = []
        for i, text in enumerate(texts):
            if SLOW.search(text):
                whole = self.tokenizer.encode_batch_fast(_cut(text, 1 << 16), add_special_tokens=False)
                out[i] = np.concatenate([np.array(e.ids, np.uint32) for e in whole])
            else:
                fast.append(i)
        group: list[int] = []
        size = 0
        for i in fast:  # about half a million characters at a time
            if len(texts[i]) > 1 << 20:
                out[i] = np.concatenate([self._encode([part])[0] for part in _cut(texts[i], 1 << 20)])
                continue
            group.append(i)
            size += len(texts[i])
            if size >= 1 << 19:
                self._store(out, texts, group)
                group, size = [], 0
        self._store(out, texts, group)
        return out

    def _store(self, out: list, texts: list[str], group: list[int]) -> None:
        for i, ids in zip(group, self._encode([texts[i] for i in group]), strict=True):
            out[i] = ids

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        lowered = [t.lower() for t in texts]
        joined = "\n".join(lowered)
        codes = np.frombuffer(joined.encode("utf-16-le"), "<u2")
        bounds = np.cumsum([0, *(len(t) + 1 for t in lowered)])
        begin, key, length = self._words(joined, codes)
        known, first, each = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) + len(known) > self.most_words:
            self._forget()
        at = np.searchsorted(self.keys, known)
        new = np.ones(len(known), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != known[inside]
        if new.any():
            spots = first[new]
            self._learn(known[new], [joined[b:b + n] for b, n in zip(begin[spots].tolist(), length[spots].tolist())])
            at = np.searchsorted(self.keys, known)
        where, count = self.begin[at][each], self.length[at][each]
        ends = np.cumsum(count)
        flat = self.pool[np.repeat(where - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate(([0], ends))[np.searchsorted(begin, bounds)]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _words(self, joined: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where words begin, their hashes and lengths: runs of letters, single digits, runs of other characters,
        and the contractions of the tokenizer's pattern."""
        kind = self.kind[codes]
        first = kind > 0
        first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        quotes = np.flatnonzero(first[:-1] & (codes[:-1] == 39) & (kind[1:] == LETTER)) if len(codes) else []
        for q in quotes:
            n = CONTRACTIONS.get(joined[q + 1]) or CONTRACTIONS.get(joined[q + 1:q + 3])
            if n:
                first[q + 1] = False
                if q + 1 + n < len(codes) and kind[q + 1 + n] == LETTER:
                    first[q + 1 + n] = True
        inside = kind > 0
        begin = np.flatnonzero(first)
        if not len(begin):
            return begin, np.empty(0, np.uint64), begin
        packed = np.cumsum(inside)[begin] - 1
        length = np.diff(packed, append=int(inside.sum()))
        values = self.value[codes[inside]]
        power = np.full(int(length.max()), 0x9E3779B97F4A7C15, np.uint64)
        power[0] = 1
        values *= np.multiply.accumulate(power)[np.arange(len(values)) - np.repeat(packed, length)]
        key = np.add.reduceat(values, packed)
        key ^= key >> np.uint64(32)
        return begin, (key * np.uint64(0xBF58476D1CE4E5B9)) ^ length.astype(np.uint64), length

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        ids, counts = [], []
        lines = [words[i:i + 256] for i in range(0, len(words), 256)]
        whole = self.tokenizer.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)
        for line, encoding in zip(lines, whole, strict=True):
            got = np.array(encoding.ids, np.uint32)
            ends = np.flatnonzero(self.ends[got]) + 1
            if len(ends) != len(line) or (len(ends) and ends[-1] != len(got)):
                each = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in line]
                got, ends = np.array(sum(each, []), np.uint32), np.cumsum([len(x) for x in each])
            ids.append(got)
            counts.append(np.diff(ends, prepend=0))
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.empty_like(self.pool)))
        self.pool[self.used:self.used + len(ids)] = ids
        begin = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.begin, self.length = (
            np.insert(old, at, x) for old, x in ((self.keys, keys), (self.begin, begin), (self.length, counts)))


def _kind(c: str) -> int:
    import unicodedata

    if c.isspace() and c not in "\x1c\x1d\x1e\x1f":
        return 0
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER)


def _cut(text: str, most: int) -> list[str]:
    """Parts cut between two words; neither normalisation nor a special token reaches over a single space."""
    parts, begin = [], 0
    while len(text) - begin > most:
        cut = SPACE_AFTER.search(text, begin + most)
        if not cut:
            break
        parts.append(text[begin:cut.start()])
        begin = cut.end()
    return [*parts, text[begin:]]


_LOADED: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Encodes every whole text, adds ``end_id`` to each and writes the ids in ascending order of doc_id.

    ``folder`` has to be mounted on every machine. Part ``k`` has four files: ``ids`` (flat unsigned 16- or 32-bit
    integers, by the size of the vocabulary), ``off`` (64-bit offsets of its documents, counted from the part's
    start, one more than documents), ``doc`` (64-bit doc_ids) and ``has`` (a byte each: 0 for a null doc_id). A
    task writes under a name of its own and renames at its end, so that a repeated task replaces equal files.
    Returns the parts with ``base``, the ids before each: prefix sums over the parts' counts.

    Null and empty texts: the end id alone. Null doc_ids come first; equal doc_ids are ordered by text, and repeated
    rows are written again. Other columns are ignored. An empty table gives no parts.
    """
    spark = docs.sparkSession
    root = posix_dir(folder)

    def write(batches):
        encoder = None
        done = TaskContext.get()
        part, own = done.partitionId(), uuid.uuid4().hex
        files, n_docs, n_ids = {}, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if encoder is None:
                encoder = _encoder(tokenizer_path)
                kind = np.dtype("<u2" if encoder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
                os.makedirs(root, exist_ok=True)
                files = {x: open(f"{root}/.{own}.{x}", "wb") for x in ("ids", "off", "doc", "has")}
                files["off"].write(np.zeros(1, "<i8").tobytes())
            ids = encoder.encode(batch.column(1).fill_null("").to_pylist())
            for x in ids:
                files["ids"].write(x.astype(kind).tobytes())
                files["ids"].write(np.array([end_id], kind).tobytes())
            ends = n_ids + np.cumsum([len(x) + 1 for x in ids])
            files["off"].write(ends.astype("<i8").tobytes())
            files["doc"].write(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            files["has"].write(batch.column(0).is_valid().to_numpy(zero_copy_only=False).astype("u1").tobytes())
            n_docs, n_ids = n_docs + batch.num_rows, int(ends[-1])
        for x, file in files.items():
            file.close()
            os.replace(file.name, f"{root}/part-{part:06d}.{x}")
        if files:
            with open(f"{root}/.{own}.kind", "w") as out:
                out.write(kind.str)
            os.replace(out.name, f"{root}/part-{part:06d}.kind")
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([n_docs]), pa.array([n_ids])], ["part", "n_docs", "n_ids"])

    ordered = texts(docs).repartitionByRange(F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(write, PARTS).write.parquet(f"{folder}/counts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    parts = spark.read.schema(PARTS).parquet(f"{folder}/counts").withColumn(
        "base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    parts.write.parquet(f"{folder}/parts")
    return read_parts(spark, folder)


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{PARTS}, base long").parquet(f"{folder}/parts")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each document, from the memory-mapped files: where its ids start, how many, and their crc32."""
    root = posix_dir(folder)

    def read(batches):
        for batch in batches:
            for part, n_docs, base in zip(*(batch.column(x).to_pylist() for x in ("part", "n_docs", "base"))):
                path = f"{root}/part-{part:06d}"
                with open(f"{path}.kind") as file:
                    kind = file.read()
                ids, offsets = np.memmap(f"{path}.ids", kind, "r"), np.memmap(f"{path}.off", "<i8", "r")
                docs, has = np.memmap(f"{path}.doc", "<i8", "r"), np.memmap(f"{path}.has", "u1", "r")
                for a in range(0, n_docs, READ_DOCS):
                    off = np.array(offsets[a:a + READ_DOCS + 1])
                    mine = np.array(ids[off[0]:off[-1]]).astype("<u4")
                    crc = [zlib.crc32(mine[i:j]) for i, j in zip(off[:-1] - off[0], off[1:] - off[0])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.array(docs[a:a + READ_DOCS]), mask=np.array(has[a:a + READ_DOCS]) == 0),
                         pa.array(off[:-1] + base), pa.array(np.diff(off)), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    parts = read_parts(spark, folder)
    return parts.repartition(F.col("part")).mapInArrow(read, ROWS)
