"""Short lines, long texts and unusual white space in line dedup and mixture."""

import time

import duckdb
from pyspark.sql import functions as F

from seawake.llm import line_dedup, mixture, registry
from tests.helpers import as_multiset

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_sql_of_short_lines_and_all_white_space(spark):
    """The queries' SQL on VT, FF and CR between words, and on lines of a few characters that stand everywhere."""
    rows = [(i, "Les.\nOwn line %d\none two\rthree\x0bfour\x0cfive\nOk" % i, ("en", "de")[i % 2], f"src{i % 7}", 9) for i in range(40)]
    rows += [(100, "Les.", "en", "src1", 4), (101, None, None, None, None), (102, "", "fr", "src2", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    for name, got in (("op9_line_dedup", line_dedup.remove_boilerplate(docs)), ("op1_mixture", mixture.mixture(docs, registry.MIX))):
        want = con.execute(registry.ORACLE[name])
        columns = [c[0] for c in want.description]
        assert as_multiset(got.columns, got.collect()) == as_multiset(columns, want.fetchall()), name
    texts = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(docs).collect()}
    assert texts[3] == "Own line 3" and texts[100] == ""


def test_many_removed_lines_of_one_text(spark):
    """A text of 10^5 lines, every second of which is boilerplate, takes seconds."""
    lines = [f"shared {i}" if i % 2 else f"own {i}" for i in range(100_000)]
    rows = [(k, "\n".join(x if x.startswith("s") else f"{x} {k}" for x in lines), "en", f"src{k}", 1) for k in range(6)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    begin = time.perf_counter()
    got = line_dedup.remove_boilerplate(docs).collect()
    assert time.perf_counter() - begin < 60
    assert all((r.n_lines, r.n_removed) == (100_000, 50_000) and "shared" not in r.text for r in got)
    assert got[0].text.split("\n")[1].startswith("own 2 ")
