"""Near duplicates against all pairs of full sets; components against a graph search."""

import random
import re

import pytest

from tideline.llm import components as C
from tideline.llm import neardup
from tideline.llm._shared import Scratch
from tideline.llm.neardup import drop_near_duplicates, near_duplicate_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows, threshold=75):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if both and 100 * both >= threshold * (len(s) + len(t) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {(i, len(s), find(i), find(i) == i) for i, s in sets}


def corpus(rng, n):
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n):
        if rows and rng.random() < 0.7:
            w = (rng.choice(rows)[1] or "x").split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 6, 40, 80, 150]))]
        rows.append((len(rows) * 3, rng.choice([" ", "\n", "  "]).join(w)))
    return rows


def groups(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {tuple(r) for r in near_duplicate_groups(df).collect()}


def test_matches_all_pairs(spark):
    rows = corpus(random.Random(11), 300) + [(10_000, None), (10_001, ""), (10_002, " \t"), (10_003, "A b"), (10_004, "a  B")]
    assert groups(spark, rows) == brute(rows)


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 7)
    rng = random.Random(2)
    base = [f"v{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(60)] = f"n{rng.random()}"
        rows.append((i, " ".join(w)))
    assert groups(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (9, "z " * 60_000)]
    got = sorted(groups(spark, rows), key=str)
    assert got == sorted({(5, 2, 2, False), (2, 2, 2, True), (None, 2, None, True), (9, 1, 9, True)}, key=str)
    assert groups(spark, []) == set()
    df = spark.createDataFrame([(1, "a b", "k"), (2, "a b", "k"), (None, None, "k")], "doc_id long, text string, kept string")
    assert sorted(map(str, drop_near_duplicates(df).collect())) == sorted(["Row(doc_id=1, text='a b', kept='k')", "Row(doc_id=None, text=None, kept='k')"])


def test_rows_that_share_an_id_follow_their_own_groups(spark):
    rows = [(5, "a b c d e f"), (7, "A b c d e f"), (5, "p q r s t u"), (2, "p q r s t u"), (2, "p q r s t u")]
    df = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "doc_id long, text string, n long, id string").repartition(2)
    assert sorted((r.doc_id, r.text, r.n) for r in drop_near_duplicates(df).collect()) == [(2, "p q r s t u", 3), (2, "p q r s t u", 4), (5, "a b c d e f", 0)]
    assert drop_near_duplicates(df).columns == df.columns


@pytest.mark.parametrize("most", [1_000, 0])
def test_components_of_a_long_chain(spark, monkeypatch, most):
    monkeypatch.setattr(C, "ONE_TASK", most)
    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = list(zip(order, order[1:], strict=False)) + [(1000, 1001), (1001, 1002), (1002, 1000)]
    with Scratch(spark) as scratch:
        got = {r.id: r.root for r in C.components(spark.createDataFrame(edges, "u long, v long").repartition(4), scratch).collect()}
        assert C.components(spark.createDataFrame([], "u long, v long"), scratch).count() == 0
    assert got == {i: 0 for i in range(1, 200)} | {1001: 1000, 1002: 1000}


def test_many_edges_take_rounds(spark, monkeypatch):
    monkeypatch.setattr(C, "ONE_TASK", 5)
    rows = corpus(random.Random(5), 150)
    assert groups(spark, rows) == brute(rows)
