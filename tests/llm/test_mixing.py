"""The source mix against plain counting, and the budget table against all sums."""

import itertools
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from bronzeway.llm import mixing
from bronzeway.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DDL = "doc_id bigint, text string, source string"


def plain_targets(sizes):
    """Target of each source, by sharing what full ones leave again and again."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, left = set(), Fraction(sum(sizes.values()))
    while True:
        open_ = [s for s in order if s not in full]
        each = left / sum(weight[s] for s in open_) if open_ else 0
        above = [s for s in open_ if weight[s] * each > 3 * sizes[s]]
        if not above:
            return {s: 3 * sizes[s] if s in full else weight[s] * each for s in order}
        full.update(above)
        left -= sum(3 * sizes[s] for s in above)


def check(rows, got, near=None):
    """Everything that must hold; ``near`` bounds how far a source is from its target."""
    size = {i: len(WORD.findall(t or "")) for i, (_, t, _) in enumerate(rows)}
    expected = Counter((k, size[i], s) for i, (k, _, s) in enumerate(rows))
    assert Counter((r.doc_id, r.size, r.source) for r in got) == expected
    sizes = defaultdict(int)
    for i, (_, _, s) in enumerate(rows):
        sizes[s] += size[i]
    goal, taken = plain_targets(sizes), defaultdict(int)
    by_length = defaultdict(list)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(goal[r.source]), rel=1e-12, abs=1e-9)
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        by_length[r.source, r.size].append(r.copies)
    for copies in by_length.values():
        assert max(copies) - min(copies) <= 1
    for s in sizes:
        if near is not None:
            assert abs(taken[s] - goal[s]) <= near, s


def mixed(spark, rows, ddl=DDL, parts=3):
    return mixing.mix(spark.createDataFrame(rows, ddl).repartition(parts)).collect()


def test_table_finds_the_nearest_sum():
    draw = random.Random(1)
    for _ in range(200):
        n = draw.randint(1, 5)
        sizes = np.array(draw.sample(range(1, 30), n))
        counts = np.array([draw.randint(0, 3) for _ in range(n)])
        budget = draw.randint(0, 80)
        sums = [sum(c * s for c, s in zip(pick, sizes)) for pick in itertools.product(*(range(c + 1) for c in counts))]
        got = mixing.knapsack(sizes, counts, budget)
        assert (got <= counts).all() and (got >= 0).all()
        best = min(abs(s - budget) for s in sums)
        assert (got * sizes).sum() == min(s for s in sums if abs(s - budget) == best)


@pytest.mark.parametrize("budget", [0, 1, 9_999, 1_234_567, 30_000_000])
def test_counts_fit_the_budget(budget):
    draw = np.random.default_rng(2)
    sizes = np.unique(np.append(draw.integers(0, 40_000, 3000), 1))
    counts = draw.integers(1, 5, len(sizes))
    budget = min(budget, int((sizes * counts).sum()))
    got = mixing.chosen_counts(sizes, counts, budget)
    assert (0 <= got).all() and (got <= counts).all() and (got * sizes).sum() == budget
    # Long documents only: the nearest that they allow.
    long = mixing.chosen_counts(np.array([100_000, 300_001]), np.array([3, 2]), 400_000)
    assert long.tolist() == [1, 1]


def test_odd_rows(spark):
    rows = [
        (None, None, None), (None, "", "s"), (1, " \t\n", "s"), (1, "a b", None), (1, "a b", None), (2, "a", ""),
        (2, " ", "é"), (3, "ü " * 700_000, "z"), (4, "a " * 7, "s"), (5, "b " * 7, "s"), (6, "b " * 5, "T"),
    ]
    check(rows, mixed(spark, rows))
    assert mixed(spark, []) == []
    wordless = [(1, None, "a"), (2, " ", None)]
    check(wordless, mixed(spark, wordless), near=0)


def test_mix_and_reruns(spark, monkeypatch):
    draw = random.Random(4)
    rows = [
        (i, "w " * draw.randint(0, 40), None if i % 11 == 0 else f"s{min(9, int(draw.expovariate(0.6)))}")
        for i in range(1500)
    ]
    got = mixed(spark, rows)
    check(rows, got, near=0.5)
    monkeypatch.setattr(mixing, "PART_ROWS", 4)
    again = mixing.mix(spark.createDataFrame(rows, DDL).orderBy("text").repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    other = mixing.mix(spark.createDataFrame(rows, DDL), seed=1).collect()
    assert sorted(map(repr, got)) != sorted(map(repr, other))


def test_a_row_given_very_often(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE_ROWS", 16)
    monkeypatch.setattr(mixing, "PART_ROWS", 8)
    rows = [(1, "a b c", "x")] * 333 + [(i, "a " * (i % 9), "yz"[i % 2]) for i in range(600)]
    check(rows, mixed(spark, rows), near=1.5)


def test_clashing_names_do_not_matter(spark):
    names = ["size", "n", "place", "of", "long", "part", "k", "target", "source_size", "taken", "passes", "id"]
    ddl = DDL + "".join(f", `{n}` string" for n in names)
    rows = [(i, "a " * (i % 5), f"s{i % 3}") for i in range(40)]
    check(rows, mixed(spark, [r + ("1",) * len(names) for r in rows], ddl))


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()
    got = QUERIES["op13_source_mix"](spark, sf).collect()
    check([tuple(r) for r in docs], got, near=1)
