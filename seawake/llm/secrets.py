"""Secret scans: keyword automaton, anchored expressions at its hits, then checksums inside the match."""

from __future__ import annotations

import binascii
import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from seawake.llm.common import map_batches, texts

SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
BASE = ("assign", "access", "hex")
MORE = ("github", "npm", "pem")
ORDER = {kind: i for i, kind in enumerate((*BASE, *MORE))}

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
CHECKED = re.compile(r"(gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9_])")
PEM = re.compile(r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----\s+([A-Za-z0-9+/=\s]+?)-----END ([A-Z]+ )*PRIVATE KEY-----")
#: Keyword, and the expression tried where it is found.
KEYWORDS = {
    "password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
    "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github",
    "ghr_": "github", "npm_": "npm", "-----begin ": "pem",
}
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
_HEX = np.zeros(256, bool)
_HEX[[*b"0123456789abcdef"]] = True


def checksum_holds(body: str, check: str) -> bool:
    """The last six characters are the base-62 crc32 of the body."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, d = divmod(value, 62)
        digits = DIGITS[d] + digits
    return digits.rjust(6, "0") == check


def key_length_holds(body: str) -> bool:
    """The decoded key is one DER sequence whose own length field covers it."""
    try:
        der = binascii.a2b_base64("".join(body.split()), strict_mode=True)
    except binascii.Error:
        return False
    if len(der) < 2 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    n = der[1] & 0x7F
    return len(der) == 2 + n + int.from_bytes(der[2:2 + n], "big")


def find_spans(text: str, automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret of a text, in code points, ordered by start and kind.

    Each kind is scanned from left to right without overlaps: a hit inside an earlier match of its kind, also one
    that failed, is passed over.
    """
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower().decode("utf-8", "surrogatepass")  # ASCII letters only, so positions stay
    spans: list[tuple[int, int, str]] = []
    passed = dict.fromkeys(ORDER, 0)
    hits = sorted((end - length + 1, kind) for end, (length, kind) in automaton.iter(low))
    for at, kind in hits:
        if at < passed[kind]:
            continue
        if kind == "assign":
            found = ASSIGN.match(text, at)
            good = found and len(found[2]) >= MIN_ASSIGN
        elif kind == "access":
            found = ACCESS.match(text, at)
            good = found and found.end() - at >= MIN_ACCESS
        elif kind == "pem":
            found = PEM.match(text, at)
            good = found and key_length_holds(found[2])
        else:
            found = CHECKED.match(text, at)
            good = found and checksum_holds(found[2], found[3])
        if found:
            passed[kind] = found.end()
        if good:
            spans.append((at, found.end(), kind))
    spans.extend(_hex_runs(raw, len(raw) != len(text)))
    return sorted(spans, key=lambda s: (s[0], ORDER[s[2]]))


def _hex_runs(raw: bytes, wide: bool) -> list[tuple[int, int, str]]:
    """Runs of lower-case hexadecimal digits: no keyword announces them, so they are found over the bytes at once."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], _HEX[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= MIN_HEX
    if not long.any():
        return []
    begin, end = begin[long], end[long]
    if wide:  # byte positions to code points
        points = np.cumsum((data & 0xC0) != 0x80)
        begin, end = points[begin] - 1, points[end - 1]
    return [(int(a), int(b), "hex") for a, b in zip(begin, end)]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


_BUILT: list = []


def _automaton():
    if not _BUILT:
        import ahocorasick

        made = ahocorasick.Automaton()
        for word, kind in KEYWORDS.items():
            made.add_word(word, (len(word), kind))
        made.make_automaton()
        _BUILT.append(made)
    return _BUILT[0]


def secret_scan(docs: DataFrame) -> DataFrame:
    """Secrets of every whole text: base kinds assign, access and hex, and the kinds that carry their own check.

    github and npm tokens end in a base-62 crc32; private keys (pem) hold a DER length. Spans of those are added only
    when the check holds; base spans never depend on it.

    Null and empty texts: no secrets. A null doc_id is kept. Repeated rows give a row each. Other columns are
    ignored. An empty table gives an empty result. No rows are moved.
    """
    def rows(batch: pa.RecordBatch):
        automaton = _automaton()
        counts = {kind: [] for kind in BASE}
        digests, joined = [], []
        for text in batch.column(1).to_pylist():
            spans = find_spans(text, automaton) if text else []
            base = [s for s in spans if s[2] in BASE]
            for kind in BASE:
                counts[kind].append(sum(s[2] == kind for s in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            joined.append(_joined(spans))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE), pa.array(digests, pa.string()),
             pa.array(joined, pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return map_batches(texts(docs), rows, SCHEMA)
