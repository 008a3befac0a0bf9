"""Links among the members of a hot group, against brute force."""

import random

import numpy as np

from seawake.llm import jaccard_join
from tests.llm.test_llm import groups, shingles


def test_hot_group_of_near_copies(spark):
    """A third of all rows are near copies that drift apart, so that many don't link with one leader; others share a
    long passage but don't link."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**6)}"
    base = [word() for _ in range(120)]
    rows, current = [], list(base)
    for i in range(80):  # each changes a few words of the one before
        current = list(current)
        for _ in range(2):
            current[rng.randrange(len(current))] = word()
        rows.append((i, " ".join(current)))
    passage = [word() for _ in range(90)]
    rows += [(100 + i, " ".join(passage + [word() for _ in range(60)])) for i in range(60)]
    rows += [(200 + i, " ".join(base[:7] + [word() for _ in range(2)])) for i in range(40)]
    rows += [(300 + i, " ".join(word() for _ in range(100))) for i in range(40)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(docs).collect()}
    want = groups(rows)
    assert got == want
    sizes = [list(want.values()).count(c) for c in set(want.values())]
    assert max(sizes) > 20 and sizes.count(1) > 90


def test_every_link_is_made_once(spark, monkeypatch):
    """Without a first step the second one has to find every link by itself, each pair in few of its shared lists."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    rows = []
    for g in range(6):
        base = [word() for _ in range(rng.choice((12, 60, 300, 700)))]
        for _ in range(14):
            text = list(base)
            for _ in range(rng.randrange(1 + len(text) // 30)):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    step, found = jaccard_join.linked, []

    def linked(pairs, docs):
        found.append((pairs.collect(), step(pairs, docs).collect()))
        return step(pairs, docs)

    monkeypatch.setattr(jaccard_join, "near_copies", lambda entries: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(jaccard_join, "linked", linked)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_groups(docs).collect()}
    assert got == groups(rows)
    pairs, links = found[-1]
    assert len({(r.a, r.b) for r in pairs}) == len(pairs)
    sets = {i: shingles(text) for i, text in rows}
    reps = {}
    for i, s in sets.items():
        reps.setdefault(frozenset(s), i)
    ids = sorted(reps.values())
    want = {(i, j) for i in ids for j in ids if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert {(r.a, r.b) for r in links} == want and len(want) > 100


def test_parity_bounds_the_difference():
    rng = np.random.default_rng(2)
    for n in (1, 5, 60, 400, 3000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[: n // 2], rng.integers(0, 2**63, n // 3 + 1, dtype=np.uint64))))
        bits = int(np.bitwise_count((jaccard_join.parity(a) ^ jaccard_join.parity(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b)) and (len(np.setxor1d(a, b)) - bits) % 2 == 0
        assert not (jaccard_join.parity(a) ^ jaccard_join.parity(a)).any()
