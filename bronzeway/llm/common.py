"""Helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bronzeway.sources.tables import stored


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package, as ``--py-files`` does elsewhere."""
    root = str(Path(__file__).resolve().parents[2])
    known = os.environ.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def fresh(wanted: str, taken: Iterable[str]) -> str:
    """A column name that no column of the caller has."""
    used = {c.lower() for c in taken}
    while wanted.lower() in used:
        wanted = f"_{wanted}"
    return wanted


def with_fields(df: DataFrame, **types: str) -> StructType:
    """Schema of ``df`` with columns behind it, given as name and type text."""
    added = StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in types.items()))
    return StructType(df.schema.fields + added.fields)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, capitals, capitals.lower())


def row_mapper(
    per_row: Callable[..., tuple],
    inputs: list[str],
    out: pa.Schema,
    keep: list[str],
    start: Callable[[], tuple] = tuple,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for ``mapInArrow`` that calls ``per_row(*state, *values)`` for each row.

    ``keep`` columns pass through, in front; ``start`` makes what a task needs
    once. ``out`` names the columns that ``per_row`` returns a tuple for.
    """

    def run(batches):
        state = start()
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in inputs]
            made = [per_row(*state, *values) for values in zip(*columns)]
            arrays = [batch.column(c) for c in keep]
            arrays += [
                pa.array([row[i] for row in made], type=field.type)
                for i, field in enumerate(out)
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=keep + out.names)

    return run


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits (wraps on purpose)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Keys that a task gathers before it hands them out.
GATHERED = 1 << 18


def repeated_keys(
    df: DataFrame,
    columns: list[str],
    make: Callable[..., tuple[np.ndarray, np.ndarray]],
    payload: np.dtype,
    ddl: str,
    by_batch: bool = False,
) -> DataFrame:
    """(key, first, *payload) for all keys that occur twice or more in ``df``.

    ``make(*values)`` gives a row's keys (uint64) and its payloads (a structured
    array whose first field ``who`` tells the rows apart); with ``by_batch``,
    ``make(batch)`` gives those of all its rows. Each task sorts what
    it gathers by key; of every key one entry goes to the bucket of the key,
    with a mark if the task has others, and the others pass through any bucket.
    So a key that a third of all rows have reaches its bucket as one entry of
    each task's share, and all entries move once, packed. ``first`` is ``who``
    of an entry all entries of the key hang together by.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    packed = np.dtype([("key", "<u8"), ("more", "u1"), ("first", payload["who"]), *payload.descr])
    # An entry that leads its key is its own first; one that passes has others.
    lead_names = ["key", "more", *payload.names]
    pass_names = ["key", "first", *payload.names]
    lead_type = np.dtype([(c, packed[c]) for c in lead_names])
    pass_type = np.dtype([(c, packed[c]) for c in pass_names])
    names = ["key", "first", *payload.names]

    def hand_out(parts):
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        held = np.empty(len(keys), packed)
        held["key"] = keys[order]
        data = np.concatenate([p for _, p in parts])[order]
        for name in payload.names:
            held[name] = data[name]
        del keys, data
        leads = np.ones(len(held), bool)
        leads[1:] = held["key"][1:] != held["key"][:-1]
        group = np.cumsum(leads) - 1
        sizes = np.bincount(group) if len(held) else group
        held["more"] = (sizes > 1)[group]
        held["first"] = held["who"][np.flatnonzero(leads)][group]
        bucket = (mix64(held["key"]) % np.uint64(n)).astype(np.int32)
        bucket[~leads] = np.arange((~leads).sum()) // 4096 % n  # any will do
        order = np.argsort(bucket, kind="stable")
        held, bucket, leads = held[order], bucket[order], leads[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(edges[1:], len(held))
        rows = []
        for a, b in zip(edges, ends):
            cut, lead = held[a:b], leads[a:b]
            lead_part = cut[lead][lead_names].astype(lead_type)
            pass_part = cut[~lead][pass_names].astype(pass_type)
            rows.append((int(bucket[a]), lead_part.tobytes(), pass_part.tobytes()))
        b, leading, passing = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(b, pa.int32()), pa.array(leading, pa.binary()), pa.array(passing, pa.binary())],
            names=["bucket", "leading", "passing"],
        )

    def spread(batches):
        parts, held = [], 0
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in columns)) if not by_batch else ()
            for made in make(batch) if by_batch else (make(*values) for values in rows):
                if len(made[0]):
                    parts.append(made)
                    held += len(made[0])
                if held >= GATHERED:
                    yield hand_out(parts)
                    parts, held = [], 0
        if parts:
            yield hand_out(parts)

    def as_rows(entries):
        for at in range(0, len(entries), 1 << 16):
            cut = entries[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [_column(cut[name]) for name in names], names=names
            )

    def meet(batches):
        leading = []
        for batch in batches:
            for lead, rest in zip(batch.column("leading").to_pylist(), batch.column("passing").to_pylist()):
                leading.append(np.frombuffer(lead, lead_type))
                yield from as_rows(np.frombuffer(rest, pass_type))
        if not leading:
            return
        entries = np.concatenate(leading)
        del leading
        entries = entries[np.argsort(entries["key"], kind="stable")]
        leads = np.ones(len(entries), bool)
        leads[1:] = entries["key"][1:] != entries["key"][:-1]
        group = np.cumsum(leads) - 1
        kept = (np.bincount(group)[group] > 1) | (entries["more"] > 0)
        out = np.empty(int(kept.sum()), pass_type)
        for name in ("key", *payload.names):
            out[name] = entries[name][kept]
        out["first"] = entries["who"][np.flatnonzero(leads)][group[kept]]
        yield from as_rows(out)

    handed = df.select(*columns).mapInArrow(spread, "bucket int, leading binary, passing binary")
    return handed.repartition("bucket").mapInArrow(meet, ddl)


def _column(values: np.ndarray) -> pa.Array:
    if values.dtype.kind == "u" and values.dtype.itemsize == 8:
        return pa.array(np.ascontiguousarray(values).view(np.int64))
    if values.dtype.kind == "V" or values.dtype.kind == "S":
        width = values.dtype.itemsize
        data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
        fixed = pa.Array.from_buffers(pa.binary(width), len(values), [None, data])
        return fixed.cast(pa.binary())
    return pa.array(values.astype(np.int64) if values.dtype.kind in "ui" else values)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is one of its nodes.

    Each round every node joins its smallest neighbour and the graph shrinks to
    what is left between the joined ones. Nodes should be hashes: in random order
    a round removes a fixed share of them, so the rounds grow with the logarithm.
    Edges and labels of each round are written, none is collected.
    """
    edges = stored(edges.select("a", "b").distinct(), "edges")
    labels = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = stored(labels.withColumn("root", F.col("node")), "labels")
    left = edges.filter("a <> b")
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        up = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("up"))
        up = stored(up.select(F.col("a").alias("v"), "up"), "up")
        twice = up.join(up.select(F.col("v").alias("up"), F.col("up").alias("up2")), "up")
        up = stored(twice.select("v", F.col("up2").alias("up")), "up")
        left = stored(
            left.join(up.withColumnRenamed("v", "a"), "a")
            .select(F.col("up").alias("a2"), "b")
            .join(up.withColumnRenamed("v", "b"), "b")
            .select(F.col("a2").alias("a"), F.col("up").alias("b"))
            .filter("a <> b")
            .distinct(),
            "edges",
        )
        labels = stored(
            labels.join(up.withColumnRenamed("v", "root"), "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")
            ),
            "labels",
        )
    return labels
