"""Line dedup by site spread: sketches per line hash, exact counts near the threshold, then removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seawake.llm.common import written

SITES = 5  # a line found on so many sites is boilerplate
SKETCH_BITS = 8  # 256 registers: a standard error of 6.5 %
DOUBT = 0.3  # estimates so far from SITES, in its parts, are counted exactly


def line_key(line: Column) -> list[Column]:
    """96 bits of a line's hash."""
    return [F.xxhash64(line).alias("h1"), F.hash(line).alias("h2")]


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """h1 and h2 of the lines that stand on at least ``sites`` distinct sites.

    ``lines`` has h1, h2 and site. Lines with fewer occurrences than ``sites`` are dropped after a plain count, which
    combines before it is shuffled. The others' sites go into a HyperLogLog sketch for each line, merged by
    aggregation; where the estimate is within ``DOUBT`` of the threshold, distinct sites are counted exactly.
    """
    common = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= sites).select("h1", "h2")
    seen = lines.join(common, ["h1", "h2"])
    spread = written(seen.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS)))
                                                  .alias("sites")), "spread")
    sure = spread.filter(F.col("sites") > sites * (1 + DOUBT)).select("h1", "h2")
    doubtful = spread.filter(F.col("sites").between(sites * (1 - DOUBT), sites * (1 + DOUBT))).select("h1", "h2")
    exact = lines.join(doubtful, ["h1", "h2"]).select("h1", "h2", "site").distinct()
    exact = exact.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") >= sites).select("h1", "h2")
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """doc_id, n_lines, n_removed and the text without the lines that stand on ``sites`` or more distinct sites.

    A line is what stands between line feeds, white space at its ends aside; every line that is not empty counts.
    The site is the document's source; a null source is a site of its own.

    A null text: no lines and a null text. Null doc_ids and repeated rows are kept, a row each. Other columns are
    ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("source").cast("string"), F.lit("(none)")).alias("site"))
    key = [F.coalesce("doc_id", F.lit(-1)).alias("k1"), F.xxhash64("text").alias("k2")]
    split = rows.select(*key, "site", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    split = split.withColumn("line", F.regexp_replace("line", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))
    lines = split.filter(F.length("line") > 0).select("k1", "k2", "place", "site", *line_key(F.col("line")))
    lines = written(lines, "lines")
    hit = lines.join(boilerplate(lines, sites), ["h1", "h2"], "left_semi")
    # The removed places of a text as a bitmap, 64 to a number: a line's bit is looked up, not searched for.
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place") % 64)
    words = hit.groupBy("k1", "k2", (F.col("place") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    removed = words.groupBy("k1", "k2").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"), F.max("word").alias("last"),
        F.sum(F.bit_count("bits")).alias("n_removed"))
    removed = removed.select("k1", "k2", "n_removed", F.transform(
        F.sequence(F.lit(0), "last"), lambda w: F.coalesce(F.try_element_at("words", w), F.lit(0))).alias("gone"))
    joined = rows.select("doc_id", "text", *key).join(removed, ["k1", "k2"], "left")
    parts = F.split("text", "\n")

    def stays(_: Column, i: Column) -> Column:
        word = F.coalesce(F.get("gone", (i / 64).cast("int")), F.lit(0))
        return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i % 64)) == 0

    left = F.when(F.col("n_removed").isNull(), F.col("text")).otherwise(F.array_join(F.filter(parts, stays), "\n"))
    return joined.select("doc_id", F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
                         F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), left.alias("text"))


ORACLE = rf"""
WITH d AS (SELECT doc_id, text, coalesce(source, '(none)') AS site, string_split(text, chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, site, unnest(parts) AS part, generate_subscripts(parts, 1) AS place FROM d),
m AS (SELECT *, regexp_replace(part, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM l),
b AS (SELECT line FROM m WHERE length(line) > 0 GROUP BY line HAVING count(DISTINCT site) >= {SITES}),
k AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE line IN (SELECT line FROM b)) AS n_removed,
  string_agg(part, chr(10) ORDER BY place) FILTER (WHERE line NOT IN (SELECT line FROM b)) AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.kept, '') END AS text FROM d LEFT JOIN k USING (doc_id)
"""
