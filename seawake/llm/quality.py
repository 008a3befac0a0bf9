"""Quality rules: base counts, then a hashed n-gram log-likelihood ratio. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Units of the n-grams are whole runs of letters and digits (all beyond ASCII count as such), and whole runs of these.
#: White space aside, every character of a text is in one, so junk is seen at any place of a word.
SYMBOL_RUN = r"[\x00-\x08\x0E-\x1F\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_WORDS, REPEAT_WINDOW, MOST_REPEATED = 20, 8, 30
SCREEN = 4


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    trusted_rows: int = 16_384  # bound of the trusted sample: labelled rows with the smallest hashes of their ids
    least_ratio: float = -0.35  # mean log-likelihood ratio of an n-gram below which a document is rejected


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once for a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _joined(hashes: Column, step: int) -> Column:
    """Hashes of neighbouring runs, of which the second begins ``step`` places after the first."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + step), n), lambda a, b: F.xxhash64(a, b))


def _repeats(words: Column) -> Column:
    """Words in repeated windows. Each word is hashed once; runs of two, four and eight follow by joining hashes.

    A window that occurs twice repeats all the runs of four inside it, so their distinct number tells most texts apart
    at a lower cost.
    """
    def screened(runs: Column) -> Column:
        may = F.size(runs) - F.size(F.array_distinct(runs)) > REPEAT_WINDOW - SCREEN
        return F.when(may, let(_joined(runs, SCREEN), _repeated_words)).otherwise(F.lit(0))

    pairs = let(_hashes(words), lambda h: _joined(h, 1))
    return let(let(pairs, lambda h: _joined(h, 2)), screened)


def _repeated_words(hashes: Column) -> Column:
    """Words inside windows that occur twice or more: windows are sorted, equal neighbours keep their places, and each
    place counts the words up to the next one."""
    def covered(places: Column) -> Column:
        def step(acc, p):
            return F.struct((acc["n"] + F.least(F.lit(REPEAT_WINDOW), p - acc["last"])).alias("n"), p.alias("last"))
        start = F.struct(F.lit(0).alias("n"), F.lit(-REPEAT_WINDOW).alias("last"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def places(ordered: Column) -> Column:
        def same(i, j):
            return F.try_element_at(ordered, i)["h"] == F.try_element_at(ordered, j)["h"]
        twice = F.filter(F.sequence(F.lit(1), F.size(ordered)),
                         lambda i: ((i > 1) & same(i, F.greatest(i - 1, F.lit(1))))
                         | ((i < F.size(ordered)) & same(i, i + 1)))
        return F.array_sort(F.transform(twice, lambda i: F.element_at(ordered, i)["p"]))

    keyed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    return let(F.array_sort(keyed), lambda o: covered(places(o)))


def base_counts(text: Column, words: Column) -> list[Column]:
    """The base counts of a text and its words."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return [
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeats(words).cast("long").alias("n_repeat_words")]


def split_units(text: Column) -> Column:
    """Runs of symbols are set apart by spaces first: a split costs less than extracting every unit."""
    return split_words(F.regexp_replace(text, SYMBOL_RUN, " $0 "))


def gram_buckets(units: Column, buckets: int) -> Column:
    """Buckets of the whole units, and of the pairs of neighbouring ones. A pair's hash joins those of its units."""
    return F.transform(let(_hashes(units), lambda h: F.concat(h, _joined(h, 1))),
                       lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def ratios(docs: DataFrame, labels: DataFrame, settings: Settings) -> str:
    """Log-likelihood ratios of the buckets, trusted multinomial over the raw corpus', as a comma-joined text.

    The corpus is counted whole; the trusted part is a bounded sample of the documents labelled good. ``buckets``
    rows of counts reach the driver, whatever the corpus' size.
    """
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    good = good.filter("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    good = good.filter("quality = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.trusted_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(good.select("doc_id", F.lit(True).alias("trusted"))), "doc_id", "left")  # trusted_rows ids at most
    offset = F.when(F.col("trusted"), F.lit(settings.buckets)).otherwise(F.lit(0))
    grams = rows.select(offset.alias("offset"), F.explode(gram_buckets(
        split_units(_text()), settings.buckets)).alias("bucket")).select((F.col("offset") + F.col("bucket")).alias("cell"))
    counts = {r.cell: r.n for r in grams.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    trusted = [counts.get(settings.buckets + b, 0) for b in range(settings.buckets)]
    raw = [counts.get(b, 0) + trusted[b] for b in range(settings.buckets)]
    shift = log(sum(raw) + settings.buckets) - log(sum(trusted) + settings.buckets)
    return ",".join(f"{log((t + 1) / (r + 1)) + shift if any(trusted) else 0.0:.4f}"
                    for t, r in zip(trusted, raw, strict=True))


def quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All columns of ``docs`` and, as the struct ``quality_rules``, the counts and verdicts of every whole text.

    ``base_failed`` marks fewer than 20 words, or more than 30 % of words in repeated windows. ``ratio`` is the sum of
    the n-grams' log-likelihood ratios over their number; a document is ``kept`` if it passes the base rules and its
    ratio is at least ``least_ratio``.

    Null and empty texts: no words, ratio 0, base_failed. Null doc_ids and repeated rows are kept as they are. Without
    trusted documents every ratio is 0 and the base rules decide alone. No rows are moved.
    """
    weights = F.split(F.lit(ratios(docs, labels, settings)), ",").cast("array<double>")

    def ratio(units: Column) -> Column:
        return let(gram_buckets(units, settings.buckets), lambda g: F.when(F.size(g) > 0, F.aggregate(
            g, F.lit(0.0), lambda acc, b: acc + weights[b]) / F.size(g)).otherwise(F.lit(0.0)))

    counts = let(split_words(_text()), lambda w: F.struct(
        *base_counts(_text(), w), ratio(split_units(_text())).alias("ratio")))
    return docs.select("*", let(counts, _verdict).alias("quality_rules"))


def _verdict(found: Column) -> Column:
    failed = (found["n_words"] < LEAST_WORDS) | (found["n_repeat_words"] * 100 > found["n_words"] * MOST_REPEATED)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio")
    return F.struct(*[found[c].alias(c) for c in names], failed.alias("base_failed"))


def report(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each document: doc_id, counts, ratio and verdicts."""
    found = quality(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, settings)
    return found.select("doc_id", "quality_rules.*").withColumn(
        "kept", ~F.col("base_failed") & (F.col("ratio") >= settings.least_ratio))


def kept(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that pass, with their columns."""
    found = quality(docs, labels, settings)
    passed = ~F.col("quality_rules.base_failed") & (F.col("quality_rules.ratio") >= settings.least_ratio)
    return found.filter(passed).drop("quality_rules")
