"""Hard negatives by a multiway tree over split points that know their siblings' ranges.

Vectors are cut into subtrees by their nearest split point. Of each subtree the
smallest and largest distance to every sibling's split point is kept, over all
rows. A window of scores around an anchor is an annulus of distances; a subtree
whose range from any sibling's split point misses it is left out. In the leaves
that remain all rows are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bronzeway.operators.ranking import with_position
from bronzeway.sources.tables import stored

#: Children of a node, and levels at most.
FANOUT, DEEPEST = 16, 3
#: Rows a leaf should hold; decides how many levels the tree gets.
LEAF_ROWS = 4096
#: Rows that split points are chosen from, the first by a hash of id and vector.
SAMPLE = 8192
#: Rows of a block, the part of a leaf that a task scores at once.
BLOCK_ROWS = 8192
#: Rows at most of the blocks that an anchor is sent to together, and how many such groups
#: there should be.
GROUP_ROWS, GROUPS = 1 << 18, 64
#: Anchors that travel together, and those scored at once.
QUERY_ROWS, SCORED = 2048, 256
#: Components are kept whole up to this size.
LARGEST = 2.0**62
LAST = 2**63 - 1

_ROW = "id bigint, label bigint, vec binary, anchor boolean"


class Node(NamedTuple):
    """Split points, and for each of them a node's or a leaf's number."""

    points: np.ndarray
    children: list[int]


class Tree(NamedTuple):
    """Nodes, the first being the root; ``first_slot`` of a node's ranges; the levels."""

    nodes: list[Node]
    first_slot: list[int]
    leaves: int
    depth: int


def packed(vector: np.ndarray) -> bytes:
    """Whole numbers as two bytes each, or as doubles if they don't fit."""
    small = len(vector) == 0 or np.abs(vector).max() < 32768
    return b"h" + vector.astype("<i2").tobytes() if small else b"d" + vector.astype("<f8").tobytes()


def unpacked(vectors: list[bytes], dim: int) -> np.ndarray:
    """A matrix of the vectors; shorter ones end in zeros."""
    out = np.zeros((len(vectors), dim))
    for i, data in enumerate(vectors):
        values = np.frombuffer(data, "<i2" if data[:1] == b"h" else "<f8", offset=1)
        out[i, : len(values)] = values
    return out


def quantised(column: pa.Array) -> list[bytes | None]:
    """Every vector as the whole numbers below 256 times its components; None if one isn't finite."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    with np.errstate(over="ignore", invalid="ignore"):
        flat = np.clip(np.floor(256 * flat), -LARGEST, LARGEST)
    found, start = [], 0
    for end in ends.tolist():
        found.append(packed(flat[start:end]) if bad[end] == bad[start] else None)
        start = end
    return found


def prepared(vectors: DataFrame, vector: str, id: str, label: Column, anchor: Column) -> DataFrame:
    """(id, label, vec, anchor) of all rows that take part."""

    def run(batches):
        for batch in batches:
            vec = pa.array(quantised(batch.column("vec")), pa.binary())
            rows = pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), vec, batch.column("anchor")],
                names=["id", "label", "vec", "anchor"],
            )
            yield rows.filter(vec.is_valid())

    rows = vectors.select(
        F.col(id).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vec"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    return rows.filter("label IS NOT NULL AND vec IS NOT NULL").mapInArrow(run, _ROW)


def lifted(rows: np.ndarray, top: float) -> np.ndarray:
    """Rows with one more component, so that all have the same length ``sqrt(top)``.

    The distance to an anchor (which gets a zero) then falls as the score rises:
    it is the root of the anchor's square plus ``top`` less twice the score.
    """
    rest = np.maximum(top - (rows * rows).sum(axis=1), 0)
    return np.column_stack([rows, np.sqrt(rest)])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def fit(sample: np.ndarray, depth: int) -> Tree:
    """Split points far from each other, chosen from a sample of lifted rows."""
    nodes: list[Node] = []
    leaves = 0

    def grow(points: np.ndarray, left: int) -> int:
        nonlocal leaves
        chosen = [0]
        near = distances(points, points[:1])[:, 0]
        near[0] = 0
        while len(chosen) < FANOUT and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, distances(points, points[chosen[-1:]])[:, 0])
            near[chosen] = 0
        own = distances(points, points[chosen]).argmin(axis=1)
        own[chosen] = np.arange(len(chosen))
        me = len(nodes)
        nodes.append(Node(points[chosen], []))
        for j in range(len(chosen)):
            if left > 1:
                nodes[me].children.append(grow(points[own == j], left - 1))
            else:
                nodes[me].children.append(leaves)
                leaves += 1
        return me

    grow(np.unique(sample, axis=0), depth)
    slots = np.cumsum([0, *(len(n.points) ** 2 for n in nodes)])
    return Tree(nodes, slots.tolist(), leaves, depth)


def route(tree: Tree, rows: np.ndarray, visit=None) -> np.ndarray:
    """The leaf of every row; ``visit(node, rows, distances, children)`` sees each step."""
    leaf = np.zeros(len(rows), np.int64)

    def down(number: int, at: np.ndarray, left: int) -> None:
        node = tree.nodes[number]
        far = distances(rows[at], node.points)
        child = far.argmin(axis=1)
        if visit:
            visit(number, far, child)
        for j in np.unique(child):
            here = at[child == j]
            if left > 1:
                down(node.children[j], here, left - 1)
            else:
                leaf[here] = node.children[j]

    if len(rows):
        down(0, np.arange(len(rows)), tree.depth)
    return leaf


def seen_ranges(tree: Tree, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
    """Widen the ranges by rows: slot ``i * m + j`` of a node is split point i to subtree j."""

    def visit(number, far, child):
        m = len(tree.nodes[number].points)
        for j in np.unique(child):
            inside = far[child == j]
            at = tree.first_slot[number] + np.arange(m) * m + j
            low[at] = np.minimum(low[at], inside.min(axis=0))
            high[at] = np.maximum(high[at], inside.max(axis=0))

    route(tree, rows, visit)


def surviving(
    tree: Tree, low: np.ndarray, high: np.ndarray, anchors: np.ndarray, near: np.ndarray, far: np.ndarray
) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows of anchors) that no range rules out.

    ``near`` and ``far`` are the annuli of each anchor, one for a window. By the
    triangle inequality a row inside is at a distance from a split point of no less
    than ``max(d - far, near - d)`` and no more than ``d + far``, d being the anchor's.
    """
    found = []

    def down(number: int, at: np.ndarray, left: int) -> None:
        node = tree.nodes[number]
        m = len(node.points)
        d = distances(anchors[at], node.points)[:, None, :]
        least = np.maximum(d - far[at][:, :, None], near[at][:, :, None] - d)
        most = d + far[at][:, :, None]
        slots = slice(tree.first_slot[number], tree.first_slot[number] + m * m)
        lows, highs = low[slots].reshape(m, m), high[slots].reshape(m, m)
        for j in range(m):
            meets = (least <= highs[:, j]) & (most >= lows[:, j])
            here = at[meets.all(axis=2).any(axis=1)]
            if not len(here):
                continue
            if left > 1:
                down(node.children[j], here, left - 1)
            else:
                found.append((node.children[j], here))

    down(0, np.arange(len(anchors)), tree.depth)
    return found


class Index(NamedTuple):
    """All rows as blocks of leaves, the tree and what is known of its leaves.

    ``groups`` has the group of every chunk of a leaf.
    """

    blocks: DataFrame
    tree: Tree
    low: np.ndarray
    high: np.ndarray
    groups: dict[int, list[int]]
    dim: int
    top: float


def grouped(counts: dict[int, int]) -> dict[int, list[int]]:
    """The group of every chunk of each leaf: chunks of BLOCK_ROWS, neighbours together."""
    share = min(GROUP_ROWS, max(LEAF_ROWS, -(-sum(counts.values()) // GROUPS)))
    found, start = {}, 0
    for leaf, n in sorted(counts.items()):
        chunks = -(-n // BLOCK_ROWS)
        found[leaf] = [(start + n * i // chunks) // share for i in range(chunks)]
        start += n
    return found


def build(rows: DataFrame) -> Index | None:
    """Index of rows (id, label, vec); rows equal in all three count once. None without rows."""

    def measured(batches):
        for batch in batches:
            found = [unpacked([v], (len(v) - 1) // (2 if v[:1] == b"h" else 8)) for v in batch.column("vec").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v.shape[1] for v in found], pa.int32()), pa.array([float((v * v).sum()) for v in found], pa.float64())],
                names=["dim", "norm"],
            )

    size = (
        rows.select("vec").mapInArrow(measured, "dim int, norm double")
        .agg(F.count("*").alias("n"), F.max("dim").alias("dim"), F.max("norm").alias("top")).first()
    )
    if not size.n:
        return None
    n, dim, top = size
    first = rows.select("id", "vec").orderBy(F.xxhash64("id", "vec"), "id", "vec").limit(SAMPLE)
    sample = lifted(unpacked([bytes(r.vec) for r in first.collect()], dim), top)
    depth = 1
    while depth < DEEPEST and FANOUT**depth * LEAF_ROWS < n:
        depth += 1
    tree = fit(sample, depth)

    def routed(batches):
        for batch in batches:
            leaf = route(tree, lifted(unpacked(batch.column("vec").to_pylist(), dim), top))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "label", "vec")), pa.array(leaf, pa.int32())],
                names=["id", "label", "vec", "leaf"],
            )

    placed = stored(
        rows.select("id", "label", "vec").mapInArrow(routed, "id bigint, label bigint, vec binary, leaf int"),
        "routed",
    )

    def ranges(batches):
        low = np.full(tree.first_slot[-1], np.inf)
        high = np.full(tree.first_slot[-1], -np.inf)
        for batch in batches:
            seen_ranges(tree, lifted(unpacked(batch.column("vec").to_pylist(), dim), top), low, high)
        at = np.flatnonzero(high >= low)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(low[at]), pa.array(high[at])], names=["slot", "low", "high"]
        )

    low = np.full(tree.first_slot[-1], np.inf)
    high = np.full(tree.first_slot[-1], -np.inf)
    # One pair of numbers for each pair of siblings of the tree.
    for r in (
        placed.select("vec").mapInArrow(ranges, "slot int, low double, high double")
        .groupBy("slot").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    ):
        low[r.slot], high[r.slot] = r.low, r.high
    counts = placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()
    groups = grouped({r.leaf: r.n for r in counts})
    # A leaf that most rows are in is cut by the ids' hashes.
    chunks = [len(groups.get(i, "1")) for i in range(tree.leaves)]
    parts = F.get(F.from_json(F.lit(str(chunks)), "array<int>"), F.col("leaf"))
    dealt = (
        placed.withColumn("chunk", F.pmod(F.xxhash64("id"), parts).cast("int"))
        .repartition("leaf", "chunk")
        .sortWithinPartitions("leaf", "chunk", F.asc_nulls_last("id"), "label", "vec")
    )

    def pack(batches):
        held, key, last = [], None, None
        for batch in batches:
            for leaf, chunk, *row in zip(*(batch.column(c).to_pylist() for c in ("leaf", "chunk", "id", "label", "vec"))):
                if held and (key != (leaf, chunk) or len(held) == BLOCK_ROWS):
                    yield block(groups[key[0]][key[1]], key[0], held, dim)
                    held = []
                if key == (leaf, chunk) and row == last:
                    continue
                key, last = (leaf, chunk), row
                held.append(row)
        if held:
            yield block(groups[key[0]][key[1]], key[0], held, dim)

    blocks = dealt.select("leaf", "chunk", "id", "label", "vec").mapInArrow(
        pack, "part int, leaf int, ids binary, labels binary, vecs binary"
    )
    return Index(stored(blocks, "blocks"), tree, low, high, groups, dim, top)


def block(part: int, leaf: int, rows: list[list], dim: int) -> pa.RecordBatch:
    ids = np.array([LAST if r[0] is None else r[0] for r in rows], "<i8")
    labels = np.array([r[1] for r in rows], "<i8")
    vecs = unpacked([r[2] for r in rows], dim)
    made = [[part], [leaf], [ids.tobytes()], [labels.tobytes()], [packed(vecs.ravel())]]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(made, kinds)], names=["part", "leaf", "ids", "labels", "vecs"]
    )


def annulus(scores: np.ndarray, squares: np.ndarray, top: float, slack: float) -> np.ndarray:
    """Distance of a score from an anchor of a square, with ``slack`` for rounding."""
    with np.errstate(invalid="ignore"):
        return np.sqrt(np.maximum(squares[:, None] + top - 2 * scores, 0)) + slack


class Best:
    """The first k rows so far in every window of anchors, by score and then id."""

    def __init__(self, lows: np.ndarray, highs: np.ndarray, k: int):
        self.lows, self.highs, self.k = lows.copy(), highs, k
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Rows of a block for anchor i; a full window asks for its last score at least."""
        lows, highs = self.lows[i], self.highs[i]
        there = np.flatnonzero(allowed & (scores >= lows.min()) & (scores <= highs.max()))
        if not len(there):
            return
        scores, ids = scores[there], ids[there]
        for w in range(len(lows)):
            at = np.flatnonzero((scores >= lows[w]) & (scores <= highs[w]))
            if not len(at):
                continue
            if len(at) > self.k:
                at = at[scores[at] >= np.partition(scores[at], -self.k)[-self.k]]
            s, r = scores[at], ids[at]
            if (i, w) in self.found:
                s, r = (np.concatenate(both) for both in zip(self.found[i, w], (s, r)))
            order = np.lexsort((r, -s))[: self.k]
            self.found[i, w] = s[order], r[order]
            if len(order) == self.k:
                lows[w] = s[order[-1]]

    def rows(self, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not self.found:
            return
        sizes = [len(s) for s, _ in self.found.values()]
        anchors, windows = np.repeat(np.array(list(self.found)), sizes, axis=0).T
        scores, ids = (np.concatenate(c) for c in zip(*self.found.values()))
        # 2.0 ** 63 itself isn't a long.
        whole = np.clip(scores, -(2.0**63), np.nextafter(2.0**63, 0)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(q[anchors]), pa.array(windows, pa.int32()), pa.array(whole), pa.array(ids, mask=ids == LAST)],
            names=["q", "w", "score", "id"],
        )


def search(index: Index, queries: DataFrame, k: int, same: bool, home: bool) -> DataFrame:
    """(q, w, score, id): the first k rows in every window of every query, by group of blocks.

    ``queries`` has q, id, label, vec and ``lows`` and ``highs``, the scores of its
    windows. ``same`` asks for rows of the query's label, the query itself left out,
    else for those of others. Looks only at the leaf of the query, or, if not
    ``home``, only at all others whose ranges allow a row.

    Queries go once to each group of blocks that has a leaf for them, so what moves is
    their number times that of the groups. A task holds the blocks of a group, some
    queries at a time, and the first rows of these.
    """
    _, tree, low, high, groups, dim, top = index
    fields = ["q", "id", "label", "vec", "lows", "highs"]
    # Rounding of distances stays far below this.
    slack = 1e-6 * (1 + top**0.5)

    def sent(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_ROWS):
                cut = batch.slice(at, QUERY_ROWS)
                rows = [cut.column(c).to_pylist() for c in fields]
                if not rows[0]:
                    continue
                plain = unpacked(rows[3], dim)
                lifted_up = np.column_stack([plain, np.zeros(len(plain))])
                own = route(tree, lifted_up)
                windows = max(map(len, rows[4]))
                lows = np.array([[*v, *[np.inf] * (windows - len(v))] for v in rows[4]], float).reshape(-1, windows)
                highs = np.array([[*v, *[-np.inf] * (windows - len(v))] for v in rows[5]], float).reshape(-1, windows)
                if home:
                    targets = [(int(leaf), np.flatnonzero(own == leaf)) for leaf in np.unique(own)]
                else:
                    squares = (plain * plain).sum(axis=1)
                    far = annulus(lows, squares, top, slack)
                    near = annulus(highs, squares, top, -slack)
                    # Windows without a score meet nothing.
                    far[lows > highs] = -np.inf
                    targets = [
                        (leaf, at[own[at] != leaf])
                        for leaf, at in surviving(tree, low, high, lifted_up, near, far)
                    ]
                to: dict[int, list[tuple[int, np.ndarray]]] = {}
                for leaf, at in targets:
                    for part in set(groups.get(leaf, ())) if len(at) else ():
                        to.setdefault(part, []).append((leaf, at))
                for part, asked in to.items():
                    at = np.unique(np.concatenate([a for _, a in asked]))
                    marks = np.array([np.isin(at, a) for _, a in asked])
                    payload = [
                        np.array([rows[0][i] for i in at], "<i8").tobytes(),
                        np.array([LAST if rows[1][i] is None else rows[1][i] for i in at], "<i8").tobytes(),
                        np.array([rows[2][i] for i in at], "<i8").tobytes(),
                        packed(plain[at].ravel()),
                        lows[at].tobytes(),
                        highs[at].tobytes(),
                        np.array([leaf for leaf, _ in asked], "<i4").tobytes(),
                        np.packbits(marks, axis=1).tobytes(),
                    ]
                    made = [pa.array([part], pa.int32()), *(pa.array([p], pa.binary()) for p in payload)]
                    yield pa.RecordBatch.from_arrays(made, names=["part", *(f"q_{c}" for c in sent_fields)])

    sent_fields = [*fields, "leaves", "marks"]
    columns = ", ".join(f"q_{c} binary" for c in sent_fields)
    asked = queries.select(*fields).mapInArrow(sent, f"part int, {columns}")
    # Small as the file of the queries may be, what is sent is not, so it is never broadcast.
    # A join by sorting holds the blocks of a group, and one row of queries after the other.
    pairs = asked.hint("merge").join(index.blocks.hint("merge"), "part")

    def matrix(data, width):
        return np.frombuffer(data, "<i2" if data[:1] == b"h" else "<f8", offset=1).reshape(-1, width).astype(float)

    def scored(batches):
        key, best = None, None
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in ("part", "leaf", "ids", "labels", "vecs", "q_q")}
                if best is None or key != (row["part"], row["q_q"]):
                    if best is not None:
                        yield from best.rows(q)
                    key = row["part"], row["q_q"]
                    told = {c: batch.column(f"q_{c}")[n].as_py() for c in sent_fields}
                    q, own, kinds = (np.frombuffer(told[c], "<i8") for c in ("q", "id", "label"))
                    queried = matrix(told["vec"], dim) if dim else np.zeros((len(q), 0))
                    best = Best(*(np.frombuffer(told[c], "<f8").reshape(len(q), -1) for c in ("lows", "highs")), k)
                    leaves = np.frombuffer(told["leaves"], "<i4").tolist()
                    bits = np.frombuffer(told["marks"], np.uint8).reshape(len(leaves), -1)
                    marks = np.unpackbits(bits, axis=1, count=len(q)).astype(bool)
                if row["leaf"] not in leaves:
                    continue
                here = np.flatnonzero(marks[leaves.index(row["leaf"])])
                ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
                vecs = matrix(row["vecs"], dim) if dim else np.zeros((len(ids), 0))
                fits = {kind: (labels == kind) == same for kind in np.unique(kinds[here]).tolist()}
                for start in range(0, len(here), SCORED):
                    some = here[start : start + SCORED]
                    for i, scores in zip(some.tolist(), queried[some] @ vecs.T):
                        allowed = fits[int(kinds[i])]
                        if same:
                            itself = [j for j in np.flatnonzero(ids == own[i]) if allowed[j] and (vecs[j] == queried[i]).all()]
                            if itself:
                                allowed = allowed.copy()
                                allowed[itself] = False
                        best.add(i, scores, ids, allowed)
        if best is not None:
            yield from best.rows(q)

    return pairs.mapInArrow(scored, "q bigint, w int, score bigint, id bigint")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q", "w").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(index: Index, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """(q, w, score, id, rank): the first k rows in every window of every query.

    What a query's own leaf has in a window narrows the search of the others.
    """
    queries = stored(queries, "queries")
    own = stored(_first(search(index, queries, k, same, home=True), k), "found")
    full = own.filter(F.col("rank") == k).groupBy("q").agg(
        F.map_from_entries(F.collect_list(F.struct("w", F.col("score").cast("double").alias("score")))).alias("kth")
    )
    narrowed = queries.join(full.hint("merge"), "q", "left").withColumn(
        "lows", F.transform("lows", lambda low, w: F.greatest(low, F.try_element_at("kth", w)))
    )
    rest = search(index, narrowed, k, same, home=False)
    return stored(_first(own.drop("rank").union(rest), k), "found")


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    label: Column,
    vector: str = "embedding",
    id: str = "vec_id",
    positives: int = 5,
    negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows for which ``anchor`` holds. Components count as the whole
    number below 256 times their value; a score is the inner product of two rows,
    higher ones come first, ties by id (NULL last). An anchor's positives are its
    first ``positives`` other rows of its label; for each of them the first
    ``negatives`` rows of other labels follow whose score is between
    ``least_percent`` and ``most_percent`` of the positive's.

    Rows with a NULL label, a NULL vector, or a component that is NULL or not finite
    take no part. Rows equal in id, label and vector count once, others with the same
    id are rows of their own. Shorter vectors, empty ones too, count as if they ended
    in zeros. An anchor without positives or negatives gives no row, and no rows give
    none. Other columns of ``vectors`` are left out, whatever their names. Labels are
    whole numbers. Results are exact as long as scores stay below 2**46; larger ones
    are rounded.
    """
    rows = stored(prepared(vectors, vector, id, label, anchor), "vectors")
    spark = rows.sparkSession
    index = build(rows)
    names = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if index is None:
        return spark.createDataFrame([], names)
    chosen = rows.filter("anchor").select("id", "label", "vec").distinct()
    anchors = stored(with_position(chosen, ["id", "label", "vec"], "q"), "anchors")
    bounds = {"lows": F.array(F.lit(float("-inf"))), "highs": F.array(F.lit(float("inf")))}
    near = nearest(index, anchors.withColumns(bounds), positives, same=True)
    near = near.select("q", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    share = F.col("positive_score").cast("double")
    windows = near.groupBy("q").agg(
        F.array_sort(
            F.collect_list(
                F.struct("w", F.ceil(share * least_percent / 100).cast("double").alias("low"),
                         F.floor(share * most_percent / 100).cast("double").alias("high"))
            )
        ).alias("windows")
    ).select("q", F.col("windows.low").alias("lows"), F.col("windows.high").alias("highs"))
    found = nearest(index, anchors.join(windows.hint("merge"), "q"), negatives, same=False)
    return (
        found.select("q", "w", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(near.hint("merge"), ["q", "w"])
        .join(anchors.select("q", F.col("id").alias("anchor_id")).hint("merge"), "q")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )
