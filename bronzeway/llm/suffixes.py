"""Exact removal of long repeated strings by a distributed suffix sort.

A string of ``length`` bytes that occurs twice holds, at the same place of both
occurrences, the same anchor: the smallest hash of its ``gram``-byte strings.
So only suffixes at anchors need to be compared, and of these only the ones
whose first ``gram`` bytes occur twice, which hashes tell before any text moves.
These suffixes are sorted within tasks, exchanged as front-coded runs and merged
by loser trees that know the common prefixes and never compare them again. The
merged order, with the common prefixes of neighbours, shows which windows of
``length`` bytes repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeway.llm.common import fresh, mix64, repeated_keys, stored

LENGTH = 200
GRAM = 100
#: Different surroundings of one anchor that are compared in one task: a few MB of
#: suffixes. An anchor with more has its windows counted by their hashes instead,
#: over all tasks, which moves a row for each window.
CLASS_LIMIT = 1 << 13

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(0, 2**64, 256, np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the longest text so far."""
    if not _powers or len(_powers[0]) <= n:
        size = max(1 << 16, 1 << (n + 1).bit_length())
        _powers[:] = [
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]))
            for base in (_BASE, _BACK)
        ]
    return _powers[0], _powers[1]


class Anchors(NamedTuple):
    """Windows of one text by anchor: those at ``start`` and ``count - 1`` after it."""

    gram: np.ndarray  # hash of the bytes at the anchor
    segment: np.ndarray  # hash of all bytes of the windows
    start: np.ndarray
    count: np.ndarray
    at: np.ndarray  # the anchor


def _prefix_hashes(data: np.ndarray) -> np.ndarray:
    up, _ = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return sums


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Anchors:
    """Anchors of the windows of a text (uint8); none if it is shorter than a window."""
    n, width = len(data), length - gram + 1
    windows = n - length + 1
    if windows < 1:
        none = np.empty(0, np.int64)
        return Anchors(none.view(np.uint64), none.view(np.uint64), none, none, none)
    _, back = _power_tables(n)
    sums = _prefix_hashes(data)
    grams = mix64((sums[gram:] - sums[:-gram]) * back[: n - gram + 1])
    # High bits order the strings, low bits the places of equal ones.
    order = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    fill = np.full(-len(order) % width, 2**64 - 1, np.uint64)
    rows = np.concatenate([order, fill]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(rows, axis=1).ravel()
    least = np.minimum(ahead[:windows], behind[width - 1 : width - 1 + windows])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.diff(at, prepend=-1))
    count = np.diff(start, append=windows)
    at = at[start]
    last = start + count - 1
    segment = mix64((sums[last + length] - sums[start]) * back[start] + count.astype(np.uint64))
    return Anchors(grams[at], segment, start, count, at)


def window_hashes(data: np.ndarray, start: int, count: int, length: int) -> np.ndarray:
    part = data[start : start + count - 1 + length]
    sums = _prefix_hashes(part)
    _, back = _power_tables(len(part))
    return mix64((sums[length:] - sums[:-length]) * back[: len(sums) - length])


# --- sorted runs ---------------------------------------------------------------

#: Bytes of a tag in front of the text: windows (2), text key (8), start (4).
HEAD = 14


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that agree in ``known`` bytes."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def front_code(suffixes: list[tuple[bytes, bytes]]) -> bytes:
    """A sorted run of (suffix, tag): each as what it shares with the one before, and the rest."""
    out, before = [], b""
    for suffix, tag in suffixes:
        shared = common_prefix(before, suffix, 0)
        rest = suffix[shared:]
        out.append(np.array([shared, len(rest), len(tag)], "<u2").tobytes() + rest + tag)
        before = suffix
    return b"".join(out)


def read_run(run: bytes) -> Iterator[tuple[bytes, int, bytes]]:
    """(suffix, bytes shared with the one before, tag) of a front-coded run."""
    at, before = 0, b""
    while at < len(run):
        shared, n, m = (int.from_bytes(run[at + i : at + i + 2], "little") for i in (0, 2, 4))
        at += 6
        before = before[:shared] + run[at : at + n]
        yield before, shared, run[at + n : at + n + m]
        at += n + m


def merge_runs(runs: list[bytes]) -> Iterator[tuple[bytes, int, bytes]]:
    """Sorted runs as one, in the form of ``read_run``: a loser tree with known prefixes.

    A player carries how far it agrees with the last winner. Of two players the
    one that agrees further is smaller; only if both agree equally far are their
    strings compared, and from there on.
    """
    streams = [read_run(r) for r in runs]
    size = 1 << max(0, len(streams) - 1).bit_length()
    heads: list[tuple[bytes, bytes] | None] = [None] * size
    agree = [0] * size

    def advance(i: int) -> None:
        found = next(streams[i], None) if i < len(streams) else None
        if found is None:
            heads[i], agree[i] = None, -1
        else:
            heads[i], agree[i] = (found[0], found[2]), found[1]

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)"""
        if heads[a] is None or heads[b] is None:
            return (b, a) if heads[a] is None else (a, b)
        if agree[a] != agree[b]:
            return (a, b) if agree[a] > agree[b] else (b, a)
        x, y = heads[a][0], heads[b][0]
        shared = common_prefix(x, y, agree[a])
        if len(x) == shared or (len(y) > shared and x[shared] < y[shared]):
            agree[b] = shared
            return a, b
        agree[a] = shared
        return b, a

    for i in range(size):
        advance(i)
        if heads[i] is not None:
            agree[i] = 0
    losers = [0] * size
    level = list(range(size))
    first = size
    while len(level) > 1:
        first //= 2
        played = [play(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        for i, (_, loser) in enumerate(played):
            losers[first + i] = loser
        level = [winner for winner, _ in played]
    winner = level[0]
    while heads[winner] is not None:
        suffix, tag = heads[winner]
        yield suffix, agree[winner], tag
        advance(winner)
        node = (winner + size) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2


def repeated_windows(
    merged: Iterable[tuple[bytes, int, bytes]], length: int, gram: int, across: bool = False
) -> Iterator[tuple[int, int]]:
    """(position in the merged order, bytes left of the anchor) of windows that occur twice.

    A tag holds the number of windows (u2), HEAD - 2 bytes that tell the suffix
    apart, and the bytes left of the anchor. Two suffixes share a window with ``left`` bytes before the anchor if they agree in
    ``length - left`` bytes from it and in ``left`` before it. With ``across`` the
    two must be in different texts.
    """
    right, lefts, lowest, texts = [], [], [], []
    for _, shared, tag in merged:
        right.append(shared)
        texts.append(tag[2:10])
        left = tag[HEAD:]
        lowest.append(len(left) - int.from_bytes(tag[:2], "little") + 1)
        lefts.append(left[::-1])
    n = len(right)
    if n < 2:
        return
    right = np.array(right)
    right[0] = 0
    text_number = np.unique(np.array(texts, "S8"), return_inverse=True)[1] if across else None
    most = np.array([len(x) for x in lefts])
    lowest = np.array(lowest)
    group = np.cumsum(right < gram)
    order = np.array(sorted(range(n), key=lambda i: (group[i], lefts[i])))
    widest = length - gram
    table = np.frombuffer(b"".join(x.ljust(widest, b"\0") for x in lefts), np.uint8)
    table = table.reshape(n, widest)[order] if widest else np.empty((n, 0), np.uint8)
    same = np.ones((n - 1, widest + 1), bool)
    same[:, :widest] = table[1:] == table[:-1]
    same[:, widest] = False
    shared = np.concatenate([[0], np.argmin(same, axis=1)])
    shared[1:] = np.minimum(shared[1:], np.minimum(most[order][1:], most[order][:-1]))
    new_group = np.diff(group[order], prepend=0) != 0
    at_order = np.empty(n, np.int64)
    at_order[order] = np.arange(n)
    for left in range(widest + 1):
        inside = np.flatnonzero((lowest <= left) & (left <= most))
        if len(inside) < 2:
            continue
        by_right = np.cumsum(right < length - left)[inside]
        by_left = np.cumsum(new_group | (shared < left))[at_order[inside]]
        pair = by_right * np.int64(n + 1) + by_left
        _, which, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if across:  # count texts
            once = np.unique(which * np.int64(n) + text_number[inside]) // n
            counts = np.bincount(once, minlength=len(counts))
        for i in inside[counts[which] > 1].tolist():
            yield i, left


# --- the distributed job ---------------------------------------------------------

PAYLOAD = np.dtype(
    [("who", "<u8"), ("segment", "<u8"), ("start", "<u4"), ("count", "u1"), ("left", "u1")]
)
#: Suffixes that a task sorts at once into runs.
RUN_ROWS = 1 << 15


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def candidates(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(key, who, segment, start, count, left) of all anchors whose bytes occur twice."""

    def make(short, text):
        found = anchors(_bytes(text), length, gram)
        held = np.empty(len(found.start), PAYLOAD)
        held["who"] = np.uint64(short & 0xFFFFFFFFFFFFFFFF)
        held["segment"], held["start"], held["count"] = found.segment, found.start, found.count
        held["left"] = found.at - found.start
        return found.gram, held

    names = ("key", "first", *PAYLOAD.names)
    return repeated_keys(
        texts, ["short", "text"], make, PAYLOAD, ", ".join(f"{n} bigint" for n in names)
    ).drop("first")


def sorted_windows(wanted: DataFrame, length: int, gram: int, across: bool) -> DataFrame:
    """(who, start, n): repeated windows among the suffixes in ``wanted``.

    ``wanted`` has short, text and segments (key, start, count, left). Suffixes
    with equal first ``gram`` bytes meet in the bucket of their key.
    """
    n = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4

    def hand_out(held):
        held.sort()
        rows, at = [], 0
        while at < len(held):
            end = at
            while end < len(held) and held[end][0] == held[at][0]:
                end += 1
            rows.append((held[at][0], front_code([(s, t) for _, s, t in held[at:end]])))
            at = end
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in rows], pa.int32()), pa.array([r for _, r in rows], pa.binary())],
            names=["bucket", "run"],
        )

    def runs(batches):
        held = []
        for batch in batches:
            for short, text, segments in zip(*(batch.column(c).to_pylist() for c in ("short", "text", "segments"))):
                data = (text or "").encode()
                for s in segments:
                    start, count, anchor = s["start"], s["count"], s["start"] + s["left"]
                    tag = int(count).to_bytes(2, "little") + short.to_bytes(8, "little", signed=True)
                    tag += int(start).to_bytes(4, "little") + data[start:anchor]
                    held.append((s["key"] % n, data[anchor : start + count - 1 + length], tag))
                if len(held) >= RUN_ROWS:
                    yield hand_out(held)
                    held = []
        if held:
            yield hand_out(held)

    def merge(batches):
        buckets: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, run in zip(batch.column("bucket").to_pylist(), batch.column("run").to_pylist()):
                buckets.setdefault(bucket, []).append(run)
        for bucket in sorted(buckets):
            merged = list(merge_runs(buckets.pop(bucket)))
            found = np.array(list(repeated_windows(merged, length, gram, across)), np.int64).reshape(-1, 2)
            if not len(found):
                continue
            # Neighbouring windows of a suffix as one span.
            found = found[np.lexsort((-found[:, 1], found[:, 0]))]
            breaks = (np.diff(found[:, 0], prepend=-1) != 0) | (np.diff(found[:, 1], prepend=0) != -1)
            first = np.flatnonzero(breaks)
            count = np.diff(first, append=len(found))
            who, start = [], []
            for i, left in found[first].tolist():
                tag = merged[i][2]
                who.append(int.from_bytes(tag[2:10], "little", signed=True))
                start.append(int.from_bytes(tag[10:14], "little") + len(tag) - HEAD - left)
            yield pa.RecordBatch.from_arrays(
                [pa.array(who, pa.int64()), pa.array(start, pa.int64()), pa.array(count, pa.int64())],
                names=["who", "start", "n"],
            )

    handed = wanted.select("short", "text", "segments").mapInArrow(runs, "bucket int, run binary")
    return handed.repartition("bucket").mapInArrow(merge, "who bigint, start bigint, n bigint")


def counted_windows(wanted: DataFrame, length: int, across: bool) -> DataFrame:
    """(who, start, n): repeated windows of the suffixes in ``wanted``, by their hashes."""
    kind = np.dtype([("who", "<u8"), ("start", "<u4")])

    def make(short, text, segments):
        data = _bytes(text)
        keys = [window_hashes(data, s["start"], s["count"], length) for s in segments]
        held = np.empty(sum(map(len, keys)), kind)
        held["who"] = np.uint64(short & 0xFFFFFFFFFFFFFFFF)
        starts = [np.arange(s["start"], s["start"] + s["count"]) for s in segments]
        if keys:
            held["start"] = np.concatenate(starts)
        return np.concatenate(keys) if keys else np.empty(0, np.uint64), held

    found = repeated_keys(
        wanted,
        ["short", "text", "segments"],
        make,
        kind,
        "key bigint, first bigint, who bigint, start bigint",
    )
    if across:
        wide = found.groupBy("key").agg(F.min("who").alias("a"), F.max("who").alias("b"))
        found = found.join(wide.filter("a <> b").select("key"), "key")
    return found.select("who", "start", F.lit(1).cast("bigint").alias("n"))


def covered_spans(
    rows: DataFrame, texts: DataFrame, length: int, gram: int, limit: int, across: bool = False
) -> DataFrame:
    """(short, spans) of the texts with repeated windows: arrays of (start, n) windows.

    ``rows`` has short and text of every row, ``texts`` one row of each text. With
    ``across`` a window counts as repeated only if another text has it.
    """
    found = stored(candidates(rows, length, gram), "anchors")
    kinds = found.groupBy("key", "segment").agg(
        (F.count_distinct("who") if across else F.count("*")).alias("m"), F.min(F.struct("who", "start", "count", "left")).alias("one")
    )
    kinds = stored(kinds, "segments")
    classes = kinds.groupBy("key").agg(F.min("m").alias("least"), F.count("*").alias("n_kinds"))
    # Segments that occur twice as a whole: all their windows repeat.
    whole = found.join(kinds.filter("m > 1").select("key", "segment"), ["key", "segment"]).select(
        "who", "start", F.col("count").alias("n")
    )
    # Where only a part can repeat, one suffix of each kind is compared.
    mixed = kinds.join(classes.filter("least = 1"), "key").select(
        F.col("one.who").alias("short"),
        F.struct("key", "one.start", "one.count", "one.left").alias("segment"),
        (F.col("n_kinds") > limit).alias("large"),
    )
    lists = mixed.groupBy("short").agg(
        *(
            F.collect_list(F.when(F.col("large") == flag, F.col("segment"))).alias(name)
            for name, flag in (("segments", False), ("large", True))
        )
    )
    wanted = texts.join(lists, "short")
    counted = wanted.filter(F.size("large") > 0).select("short", "text", F.col("large").alias("segments"))
    spans = (
        whole.union(sorted_windows(wanted, length, gram, across))
        .union(counted_windows(counted, length, across))
        .distinct()
    )
    return spans.groupBy(F.col("who").alias("short")).agg(
        F.collect_list(F.struct("start", "n")).alias("spans")
    )


def removed_runs(spans: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of the bytes that windows (start, n) cover."""
    runs: list[list[int]] = []
    for start, n in sorted(spans):
        end = start + n - 1 + length
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


RESULT = "short bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


RESULT_NAMES = [column.split()[0] for column in RESULT.split(", ")]


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    limit: int = CLASS_LIMIT,
) -> DataFrame:
    """Add ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept``.

    A byte is removed if a string of ``length`` bytes that covers it also starts
    anywhere else, in the same text or another one, on the input. Matches never
    cross texts. ``kept`` is the rest as text; where a run ends inside of a
    character, the other bytes of that character are left out of it, though
    ``kept_sha256`` is the digest of exactly the bytes that aren't removed.

    A NULL text is an empty one. Repeated rows and equal texts repeat each other,
    so texts of at least ``length`` bytes go wholly. Input columns of the added
    names are replaced, and other columns pass through, whatever their names. Texts of
    any length are cut whole; no rows give none. Texts are told apart by 64-bit hashes: two among a billion are confused with probability 1/37.
    """
    key = fresh("text_key", [*docs.columns, *RESULT_NAMES])
    rows = docs.withColumn(key, F.xxhash64(F.coalesce(text, F.lit(""))))
    plain = rows.select(F.col(key).alias("short"), F.coalesce(text, F.lit("")).alias("text"))
    texts = plain.dropDuplicates(["short"])
    spans = covered_spans(plain, texts, length, gram, limit)

    def cut(batches):
        for batch in batches:
            out = []
            for short, value, found in zip(*(batch.column(c).to_pylist() for c in ("short", "text", "spans"))):
                data = value.encode()
                runs = removed_runs([(s["start"], s["n"]) for s in found or ()], length)
                edges = [0, *(e for run in runs for e in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                digest = hashlib.sha256(kept).hexdigest()
                n = sum(b - a for a, b in runs)
                out.append((short, len(data), n, len(runs), digest, kept.decode(errors="ignore") if runs else value))
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=RESULT_NAMES)

    judged = texts.join(spans, "short", "left").select("short", "text", "spans").mapInArrow(cut, RESULT)
    return (
        rows.drop(*RESULT_NAMES[1:])
        .join(judged.withColumnRenamed("short", key), key)
        .drop(key)
    )
