"""Hard negatives against scores of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bronzeway.llm import negatives
from bronzeway.llm.queries import QUERIES

DDL = "vec_id bigint, embedding array<double>, label int"


def plain(vector):
    return [math.floor(256 * x) for x in vector]


def by_hand(rows, step=50):
    """Every row (id, vector, label); equal rows count once, shorter vectors end in zeros."""
    there = {
        (i, tuple(plain(v)), y)
        for i, v, y in rows
        if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }

    def score(a, b):
        return sum(x * y for x, y in zip(a[1], b[1]))

    def ordered(a, others):
        return sorted(others, key=lambda b: (-score(a, b), b[0] is None, b[0] or 0))

    out = []
    for a in there:
        if a[0] is None or a[0] % step:
            continue
        for p in ordered(a, [b for b in there if b[2] == a[2] and b != a])[:5]:
            ps = score(a, p)
            fit = [b for b in there if b[2] != a[2] and 50 * ps <= 100 * score(a, b) <= 95 * ps]
            for rank, n in enumerate(ordered(a, fit)[:3], 1):
                out.append((a[0], p[0], rank, n[0], ps, score(a, n)))
    return sorted(map(repr, out))


def mined(spark, rows, step=50, ddl=DDL):
    rows = [(r[0], r[1] and [None if x is None else float(x) for x in r[1]], *r[2:]) for r in rows]
    df = spark.createDataFrame(rows, ddl)
    got = negatives.hard_negatives(df, F.col("vec_id") % step == 0, F.col("label"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(repr(tuple(r)) for r in got.collect())


def vectors(n, dim, seed, spread=1.0, centres=1):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centres, dim)) * (0 if centres == 1 else 2)
    points = middle[draw.integers(centres, size=n)] + draw.normal(size=(n, dim)) * spread
    return [(i, p.tolist(), int(y)) for i, (p, y) in enumerate(zip(points, draw.integers(4, size=n)))]


@pytest.mark.parametrize("leaf_rows", [4096, 20, 2])
def test_any_depth(spark, monkeypatch, leaf_rows):
    monkeypatch.setattr(negatives, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(negatives, "FANOUT", 4)
    rows = vectors(400, 6, 1) + [(1000 + i, [0.5, 0.25, 0, 0, 0, 0], i % 3) for i in range(120)]
    assert mined(spark, rows, 25) == by_hand(rows, 25)


def test_blocks_of_one_leaf(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 30)
    rows = [(i, [1.0, i % 3, 0.5], i % 4) for i in range(300)]
    assert mined(spark, rows) == by_hand(rows)


@pytest.mark.parametrize("group_rows, groups", [(1 << 18, 1), (40, 64), (1, 64)])
def test_any_groups(spark, monkeypatch, group_rows, groups):
    for name, value in (("GROUP_ROWS", group_rows), ("GROUPS", groups), ("LEAF_ROWS", 20), ("BLOCK_ROWS", 30), ("QUERY_ROWS", 7)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(300, 4, 5) + [(1000 + i, [0.5, 0.25, 0, 0], i % 3) for i in range(120)]
    assert mined(spark, rows, 20) == by_hand(rows, 20)


def test_chunks_are_grouped():
    counts = {3: 20_000, 0: 5, 7: 300_000}
    found = negatives.grouped(counts)
    assert {leaf: len(parts) for leaf, parts in found.items()} == {0: 1, 3: 3, 7: 37}
    everything = [part for leaf in sorted(found) for part in found[leaf]]
    assert everything == sorted(everything) and 30 < len(set(everything)) <= negatives.GROUPS
    assert max(p for parts in negatives.grouped({i: 4096 for i in range(4096)}).values() for p in parts) == 63


def test_what_is_sent_is_no_broadcast(spark):
    rows = vectors(200, 4, 6)
    df = spark.createDataFrame([(i, [float(x) for x in v], y) for i, v, y in rows], DDL)
    prepared = negatives.prepared(df, "embedding", "vec_id", F.col("label"), F.col("vec_id") % 10 == 0)
    index = negatives.build(prepared)
    near, far = (F.array(F.lit(float(x))) for x in ("-inf", "inf"))
    queries = prepared.filter("anchor").select(F.col("id").alias("q"), "id", "label", "vec", near.alias("lows"), far.alias("highs"))
    for home in (True, False):
        plan = negatives.search(index, queries, 5, True, home)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 1.0], 1), (0, [1.0, 1.0], 1), (0, [1.0, 0.9], 1), (0, [0.9, 1.0], 2),
        (None, [1.0, 0.8], 1), (None, [0.9, 0.8], 2), (3, [0.9, 0.8], 2), (4, [1.0], 2), (5, [], 2),
        (6, None, 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 2), (9, [None, 1.0], 2), (10, [1.0, 1.0], None),
        (50, [], 2), (100, [-1.0, -1.0], 3), (101, [-1.0, -1.0, 0.0, 0.5], 3), (102, [0.7, 0.7], 3),
    ]
    assert mined(spark, rows) == by_hand(rows)
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == [] == mined(spark, [(0, None, None)])
    huge = [(0, [1e300, 1.0], 1), (1, [1e300, 1.0], 1), (2, [1e299, 1.0], 2), (3, [-1e300, 1.0], 2)]
    assert isinstance(mined(spark, huge), list)


def test_clashing_names_do_not_matter(spark):
    rows = vectors(60, 3, 2)
    names = ["id", "vec", "anchor", "q", "w", "rank", "leaf", "chunk", "score"]
    ddl = DDL + "".join(f", `{n}` int" for n in names)
    assert mined(spark, [r + (1,) * len(names) for r in rows], 7, ddl) == by_hand(rows, 7)


def test_ranges_rule_subtrees_out():
    draw = random.Random(3)
    centres = [[draw.gauss(0, 60) for _ in range(8)] for _ in range(16)]
    rows = np.array([[c + draw.gauss(0, 1) for c in centres[i % 16]] for i in range(1600)]).round()
    top = float((rows * rows).sum(axis=1).max())
    lifted = negatives.lifted(rows, top)
    tree = negatives.fit(lifted, 2)
    low, high = np.full(tree.first_slot[-1], np.inf), np.full(tree.first_slot[-1], -np.inf)
    negatives.seen_ranges(tree, lifted, low, high)
    leaf = negatives.route(tree, lifted)
    anchors = rows[:40]
    scores = anchors @ rows.T
    squares = (anchors * anchors).sum(axis=1)
    # The ten best rows of each anchor, and a ring further out.
    tenth, far = np.sort(scores)[:, -10], np.sort(scores)[:, -300]
    for least, most in ((tenth, np.full(40, np.inf)), (far, tenth)):
        reach = negatives.annulus(least[:, None], squares, top, 1e-6)
        near = negatives.annulus(most[:, None], squares, top, -1e-6)
        kept = negatives.surviving(tree, low, high, np.column_stack([anchors, np.zeros(40)]), near, reach)
        seen = np.zeros((40, len(rows)), bool)
        for number, at in kept:
            seen[np.ix_(at, leaf == number)] = True
        wanted = (scores >= least[:, None]) & (scores <= most[:, None])
        assert not (wanted & ~seen).any()
        assert seen.mean() < 0.5


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [
        (r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ]
    got = QUERIES["op12_hard_negatives"](spark, sf).collect()
    assert sorted(repr(tuple(r)) for r in got) == by_hand(rows)
