"""Toxicity by compression distance: two zstandard dictionaries, compared window by window."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import map_batches, texts

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
FOLDS, HELD = 5, 0
WINDOW, OVERLAP = 256, 32
PIECE = 1 << 20  # bytes of a text brought into compared form at once
#: Upper-case letters become lower-case ones, all other ASCII a space.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class Bounds:
    """Bounds of the sample that is fitted on: the labelled rows with the smallest hashes of their ids."""
    toxic: int = 2500
    ordinary: int = 4000
    chars: int = 1 << 15  # of a training text
    ordinary_words: int = 8000
    toxic_words: int = 1000


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]  # of the features, and the constant


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD, F.lit(False))


def plain(text: str) -> bytes:
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_PLAIN).split()) + b" "


def _contexts(samples: list[bytes]) -> dict[bytes, set[int]]:
    """Words and the distinct neighbourhoods they stand in: copies of a text count once."""
    found: dict[bytes, set[int]] = defaultdict(set)
    for text in samples:
        words = [b"", *text.split(), b""]
        for before, word, after in zip(words, words[1:], words[2:], strict=False):
            found[word].add(hash((before, after)))
    return found


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes], bounds: Bounds) -> tuple[bytes, bytes]:
    """Raw-content dictionaries of either kind of text.

    The ordinary one holds the words that stand in the most neighbourhoods of ordinary text; the toxic one puts before
    it the words whose share of the toxic neighbourhoods is at least twenty times their ordinary share. As both end
    alike, ordinary text compresses alike under both, and only toxic words make a difference.
    """
    by_toxic, by_ordinary = _contexts(toxic), _contexts(ordinary)
    n_toxic, n_ordinary = (max(1, sum(map(len, x.values()))) for x in (by_toxic, by_ordinary))
    least = max(4, len(toxic) * 0.004)
    words = [w for w, seen in by_toxic.items() if len(seen) >= least
             and len(seen) / n_toxic >= 20 * (len(by_ordinary.get(w, ())) + 0.5) / n_ordinary]
    words = sorted(words, key=lambda w: (-len(by_toxic[w]), w))[:bounds.toxic_words]
    common = sorted(by_ordinary, key=lambda w: (-len(by_ordinary[w]), w))[:bounds.ordinary_words]
    tail = b" " + b" ".join(reversed(common)) + b" "
    head = b" " + b" ".join(reversed(words)) if words else b""
    head = b" " * (-len(head) % 12) + head  # the compressor indexes every third byte: keep the ends in step
    return head + tail, tail


class Distance:
    """Compressed lengths of windows under either dictionary. Literals are left as they are, so that lengths count
    matches alone."""

    def __init__(self, model: Model):
        import zstandard as z

        settings = z.ZstdCompressionParameters(
            window_log=19, hash_log=18, chain_log=17, search_log=1, min_match=6, target_length=1,
            strategy=z.STRATEGY_FAST, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.toxic, self.ordinary = (z.ZstdCompressor(
            dict_data=z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=settings)
            for content in (model.toxic, model.ordinary))

    def features(self, text: str) -> tuple[float, float]:
        """Largest and mean saving of the windows of a whole text."""
        largest, total, n = 0, 0, 0
        for a in range(0, max(len(text), 1), PIECE):
            data = plain(text[max(0, a - 64):a + PIECE])
            for k in range(0, max(len(data) - OVERLAP, 1), WINDOW - OVERLAP):
                window = data[k:k + WINDOW]
                saved = len(self.ordinary.compress(window)) - len(self.toxic.compress(window))
                largest, total, n = max(largest, saved), total + saved, n + 1
        return largest / 8, max(total, 0) / n


def fit_weights(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton's method, so that 0.5 is the calibrated threshold; the rarer class weighs more, by
    the root of the ratio. A feature that would lower the score as savings grow is left out."""
    full, x = np.column_stack((x, np.ones(len(x)))), np.column_stack((x, np.ones(len(x))))
    ratio = np.sqrt((1 - y).sum() / max(y.sum(), 1))
    share = np.where(y == 1, ratio, 1.0)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + np.eye(len(w)) * 0.1,
                               x.T @ (share * (y - p)) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    if (w[:-1] < 0).any() and full[:, :-1].any():
        used = full[:, :-1] * (w[:-1] > 0)
        if (w[:-1] > 0).any():
            return fit_weights(used, y, steps)
        w[:-1] = 0
    return tuple(float(v) for v in w)


def train(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds()) -> Model | None:
    """Fits dictionaries on three quarters of the bounded sample and the threshold on the rest; None without rows of
    both kinds."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.filter("toxic = 1").orderBy(*order).limit(bounds.toxic).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(bounds.ordinary))
    rows = texts(docs).join(F.broadcast(chosen), "doc_id").select(  # at most toxic + ordinary ids
        "doc_id", "toxic", F.substring("text", 1, bounds.chars).alias("text")).filter("text is not null")
    rows = rows.orderBy("doc_id", "text").limit(bounds.toxic + bounds.ordinary).collect()
    fit = [r for i, r in enumerate(rows) if i % 4]
    kinds = [[plain(r.text) for r in fit if r.toxic == k] for k in (1, 0)]
    if not all(kinds):
        return None
    model = Model(*train_dictionaries(*kinds, bounds), ())
    rest = [r for i, r in enumerate(rows) if not i % 4]
    if len({r.toxic for r in rest}) < 2:
        rest = rows
    distance = Distance(model)
    x = np.array([distance.features(r.text) for r in rest])
    return Model(model.toxic, model.ordinary, fit_weights(x, np.array([r.toxic for r in rest])))


def toxicity(docs: DataFrame, labels: DataFrame, bounds: Bounds = Bounds()) -> DataFrame:
    """Toxicity score of every whole text.

    Every window is compressed under the toxic and the ordinary dictionary; a logistic curve over the savings gives
    the score, calibrated so that 0.5 is the threshold. Fitted only on labelled rows outside the held-out fold, and
    on no more than ``bounds`` says; the score sees nothing but the text.

    Null, empty and letterless texts: the score of a text without savings. Null doc_ids are kept and not held out.
    Repeated rows give a row each; a document labelled twice counts as toxic if one label says so. Labels that are
    null are passed over. Without labels of both kinds every score is 0. Other columns are ignored.
    """
    model = train(docs, labels, bounds)

    def rows(batch: pa.RecordBatch):
        scores = np.zeros(batch.num_rows)
        if model is not None:
            distance = _distance(model)
            x = np.array([distance.features(t or "") for t in batch.column(2).to_pylist()])
            scores = 1 / (1 + np.exp(-np.clip(np.column_stack((x, np.ones(len(x)))) @ np.array(model.weights), -30, 30)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"])

    return map_batches(texts(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), rows, SCHEMA)


_LOADED: dict = {}


def _distance(model: Model) -> Distance:
    if model not in _LOADED:
        _LOADED.clear()
        _LOADED[model] = Distance(model)
    return _LOADED[model]
