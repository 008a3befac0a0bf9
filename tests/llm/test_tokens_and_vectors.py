"""Alignment of tokenizers, byte-level BPE and whitening, against brute force and the libraries."""

import base64
import collections
import hashlib
import math

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seawake.llm import alignment, byte_bpe, registry, whitening
from tests.conftest import SMALL
from tests.llm.test_llm import AWKWARD, SCHEMA, awkward  # noqa: F401

HARD = [
    "", " ", "\n", "a", "é", "漢字かな", "👩‍👩‍👧 family 🇫🇷", "naïve café déjà vu — “quotes” … ½ ²³ Ⅷ",
    "x" * 3000, "ab " * 2000, "  two  spaces\n\n\nand lines \t tabs", "▁ already here", "ﬁ ligature ①", "İıßẞ",
    "<|endoftext|> and </s> <s> <unk> <0x41>", "\u0000\u0001\x7f\x80\xa0 　end", "don't we'll I'VE 'tis 's",
    "1234567890 12,345.67 1e-9", "🇩🇪" * 300, "混ざった text with 漢字 and emoji 😀😀 ok", "۱۲۳ ١٢٣ १२३", "é combining",
    " leading", "trailing ", "a" * 70 + " " + "b" * 70, "\U0001F600" * 50 + "x", "ÃÂ Ã© â\x80\x99", "\r\n\r\n x \r y",
]


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    hard = spark.createDataFrame([(10**7 + i, t) for i, t in enumerate(HARD)], "doc_id long, text string")
    return docs.unionByName(hard).withColumn("a", F.lit(1)).withColumn("ids", F.lit("x"))


# --- byte-level BPE ------------------------------------------------------------

@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path(registry.BYTE_RANKS))


def own_encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_matches_the_library(spark, corpus, ranks):
    library = own_encoding(ranks)
    path = public_tokenizers.path(registry.BYTE_RANKS)
    ids = byte_bpe.encoded(corpus, path, public_tokenizers.PATTERN)
    got = byte_bpe.decoded(ids, path, public_tokenizers.PATTERN).collect()
    texts = {r.doc_id: r.text or "" for r in corpus.collect()}
    assert len(got) == len(texts)
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(texts[r.doc_id]), texts[r.doc_id][:80]
        assert r.n_tokens == len(r.ids) // 4 and bytes(r.decoded) == texts[r.doc_id].encode()


def test_byte_bpe_every_character(ranks):
    """Classes of the pattern and merges, for every character in three settings."""
    library, codec = own_encoding(ranks), byte_bpe.Codec(public_tokenizers.path(registry.BYTE_RANKS), public_tokenizers.PATTERN)
    for begin in range(0, 0x110000, 0x400):
        block = [chr(c) for c in range(begin, begin + 0x400) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1 {c}{c}.{c} {c}b" for c in block)
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text), hex(begin)


def test_byte_bpe_parts_of_long_texts(ranks, monkeypatch):
    monkeypatch.setattr(byte_bpe, "PART_CHARS", 40)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 20)
    library, codec = own_encoding(ranks), byte_bpe.Codec(public_tokenizers.path(registry.BYTE_RANKS), public_tokenizers.PATTERN)
    rng = np.random.default_rng(5)
    pool = list("abcé漢1²  '\n.,") + ["word", " it's", "  ", "\t"]
    for _ in range(500):
        text = "".join(rng.choice(pool, 300))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_byte_bpe_entries_that_no_merge_reaches(tmp_path):
    """A pre-token that is an entry is that entry, though no pair of shorter entries makes it."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 257, b"abc": 300}
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(k) + b" " + str(r).encode() for k, r in ranks.items()))
    library, codec = own_encoding(ranks), byte_bpe.Codec(str(path), public_tokenizers.PATTERN)
    for text in ("xyz", "xyzx", "abcabc", "abab xyz", "abc"):
        ids = np.frombuffer(codec.encode(text), "<u4").tolist()
        assert ids == library.encode_ordinary(text) and codec.decode(np.array(ids, "<u4").tobytes()) == text.encode()


def test_byte_bpe_awkward_rows(spark, awkward):  # noqa: F811
    path = public_tokenizers.path(registry.BYTE_RANKS)
    out = byte_bpe.digests(byte_bpe.decoded(byte_bpe.encoded(awkward, path, public_tokenizers.PATTERN), path,
                                            public_tokenizers.PATTERN)).collect()
    want = collections.Counter((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in AWKWARD)
    assert collections.Counter((r.doc_id, r.decoded_sha256) for r in out) == want
    none = byte_bpe.encoded(awkward.limit(0), path, public_tokenizers.PATTERN)
    assert byte_bpe.digests(byte_bpe.decoded(none, path, public_tokenizers.PATTERN)).count() == 0


# --- alignment -------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path(registry.BYTE_TOKENIZER))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(registry.PIECE_TOKENIZER))


def token_bytes(tokenizers, text):
    """(ids, bytes of each token) on both sides; None without tokens."""
    a, b = tokenizers
    if not text:
        return None
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [byte_bpe.unmapped(a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in ids_b]
    whole = (" " + text).encode()
    return (ids_a, bytes_a, ids_b, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else None


def brute_alignment(tokenizers, rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of every row."""
    docs = []
    for doc_id, text in rows:
        found = token_bytes(tokenizers, text)
        groups = []
        if found:
            ids_a, bytes_a, ids_b, bytes_b = found
            end_a, end_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
            i = k = 0
            for end in sorted(set(end_a) & set(end_b)):
                j, m = end_a.index(end, i) + 1, end_b.index(end, k) + 1
                groups.append((ids_a[i:j], ids_b[k:m]))
                i, k = j, m
        docs.append((doc_id, groups))
    count = collections.Counter()
    links = [collections.Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in docs]
    for found in links:
        count.update(found.keys())
    most = collections.Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc_id, groups), found in zip(docs, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(found.values()),
                    sum(n for (x, y), n in found.items() if count[x, y] == most[x]),
                    sum(n * count[p] for p, n in found.items()), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return collections.Counter(out)


FIELDS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 300, 0])
def test_alignment(spark, corpus, tokenizers, frequent):
    found = alignment.aligned(corpus, registry.tokenizer(registry.BYTE_TOKENIZER), registry.tokenizer(registry.PIECE_TOKENIZER))
    got = alignment.with_counts(alignment.digests(found), frequent).collect()
    want = brute_alignment(tokenizers, [(r.doc_id, r.text) for r in corpus.collect()])
    assert collections.Counter(tuple(r[f] for f in FIELDS) for r in got) == want
    assert any(r.n_a == 0 for r in got) and sum(r.n_groups for r in got) > 1000


def test_alignment_awkward_rows(spark, awkward, tokenizers):  # noqa: F811
    paths = registry.tokenizer(registry.BYTE_TOKENIZER), registry.tokenizer(registry.PIECE_TOKENIZER)
    got = alignment.with_counts(alignment.digests(alignment.aligned(awkward, *paths))).collect()
    want = brute_alignment(tokenizers, [(r[0], r[1]) for r in AWKWARD])
    assert collections.Counter(tuple(r[f] for f in FIELDS) for r in got) == want
    assert alignment.with_counts(alignment.digests(alignment.aligned(awkward.limit(0), *paths))).count() == 0


def test_alignment_in_parts_and_large_groups(tokenizers, monkeypatch):
    """Stretches and counted groups give what whole texts and single links give."""
    aligner = alignment.Aligner(registry.tokenizer(registry.BYTE_TOKENIZER), registry.tokenizer(registry.PIECE_TOKENIZER))
    rng = np.random.default_rng(3)
    pool = list("abcé漢1²  '\n.,😀$") + ["word", " it", "the ", "\t", "🇫🇷", " one two ", " 's ", "\u00a0", "\u200b", "\x1c", "\x85"]
    texts = ["".join(rng.choice(pool, 400)) for _ in range(1000)] + [x for x in HARD if x]

    def align(text, cut):
        numbers, groups, pair, times = aligner.documents([alignment.SAFE.split(text) if cut else [text]])[0]
        return numbers.tolist(), groups, pair.tolist(), times.tolist()

    whole = [align(t, False) for t in texts]
    assert [align(t, True) for t in texts] == whole
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    monkeypatch.setattr(alignment, "PART_CHARS", 20)
    assert [align(t, True) for t in texts] == whole
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    assert [align(t, False) for t in texts] == whole
    for text, found in zip(texts, whole):
        assert (found[0][0] == 0) == (token_bytes(tokenizers, text) is None)
        assert found[0][3] == sum(found[3])


# --- whitening --------------------------------------------------------------------

def brute_whitening(rows):
    """numpy's own decomposition of the distinct whole-number vectors."""
    x = {i: tuple(math.floor(64 * c) + 1_000_000 for c in v) for i, v in rows}
    fit = sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    v = np.cov(np.array(fit).T, bias=True).reshape(len(sums), -1)
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)
    return x, n, sums, values[order], vectors[:, order]


def check_whitening(got, rows, components):
    x, n, sums, values, vectors = brute_whitening(rows)
    assert len(got) == len(rows) * components
    mean = np.array(sums) / n
    for r in got:
        k = r.component - 1
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert math.isclose(r.explained, values[k] / values.sum(), rel_tol=1e-9) and r.identity_error < 1e-9
        want = (np.array(x[r.vec_id]) - mean) @ vectors[:, k] / math.sqrt(values[k])
        assert math.isclose(abs(r.whitened), abs(want), rel_tol=1e-6, abs_tol=1e-6)
    by = {(r.vec_id, r.component): r.whitened for r in got}
    for k in range(1, components + 1):  # one sign for all rows
        want = np.array([(np.array(x[i]) - mean) @ vectors[:, k - 1] for i, _ in rows])
        assert abs(np.corrcoef(want, [by[i, k] for i, _ in rows])[0, 1]) > 1 - 1e-9


def test_whitening(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    more = table.limit(20).withColumn("vec_id", F.col("vec_id") + 10**6)
    table = table.unionByName(more).withColumn("x", F.lit(1)).withColumn("component", F.lit("c"))
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    check_whitening(whitening.whitened(table).collect(), rows, 16)


def test_whitening_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), i * 0.25, (i * i) % 7 - 3.0]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 2.0]), (103, [inf, 1.0, 2.0]), (104, []), (105, [1.0]),
           (106, [1e30, 0.0, 0.0])]
    schema = "vec_id long, embedding array<float>"
    repeated = [*good, good[3], (None, good[4][1])]
    got = whitening.whitened(spark.createDataFrame([*repeated, *bad], schema)).collect()
    assert collections.Counter(r.vec_id for r in got) == {**{i: 3 for i, _ in good}, 3: 6, None: 3}
    alone = [r for r in got if r.vec_id is not None and r.vec_id != 3]
    check_whitening(alone + [r for r in got if r.vec_id == 3][:3], good, 3)
    for rows in ([], [(1, [1.0, 2.0])] * 3, bad[:3]):
        assert whitening.whitened(spark.createDataFrame(rows, schema)).count() == 0
    flat = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]  # one direction only
    check_whitening(whitening.whitened(spark.createDataFrame(flat, schema)).collect(), flat, 1)


def test_deviations_beyond_64_bits_are_null():
    model = whitening.Whitening(10**9, np.zeros(2, np.int64), np.zeros(2, np.int64), np.zeros((2, 0)), np.zeros(0), np.zeros(0))
    assert model.deviation(np.array([[1, 2], [10, 0]])).to_pylist() == [5 * 10**18, None]


@pytest.mark.parametrize("size", [1, 2, 3, 8, 33])
def test_eigen(size):
    rng = np.random.default_rng(size)
    for rank in {1, size // 2 + 1, size}:
        factor = rng.normal(size=(size, rank)) * 10.0 ** rng.integers(-2, 3, rank)
        matrix = factor @ factor.T
        lower, order = whitening.pivoted_cholesky(matrix, 1e-13 * matrix.diagonal().max())
        assert np.allclose(np.triu(lower, 1), 0) and np.allclose(lower @ lower.T, matrix[np.ix_(order, order)])
        values, vectors = whitening.eigen(matrix)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:len(values)], rtol=1e-8, atol=1e-10 * values[0])
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
        assert np.allclose(matrix @ vectors, vectors * values, atol=1e-10 * values[0])
