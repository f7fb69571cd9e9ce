"""Similarity join of word n-gram sets by Jaccard, exact, with its components.

The shingles' universe is cut into segments by hash, so many for a band of set
sizes that a linked pair, which differs in few shingles, must agree on some
segment (or, in a double segment, differ in one shingle at most). Texts that
share an indexed segment form families, in which all links are verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bronzeway.llm.common import components, fresh, mix64, repeated_keys, stored, with_fields

ANY_WORD = r"[^\x20\x09-\x0D]"
#: A band of set sizes ends at so many times the end of the one before.
BAND_RATIO = 1.3
#: What an entry that unlike sets share costs, in index entries, and the chance
#: that unlike sets with a common passage share a shingle.
FALSE_COST = 400.0
SHARED = 0.4
#: Characters of a block, and the first texts of a family that go to all its blocks.
BLOCK_CHARS = 4 << 20
FIRST_TEXTS = 4


#: Bytes whose words are hashed at once; a longer text is cut between words.
HASHED_BYTES = 1 << 20
#: Odd, so that its powers can be undone among the 64-bit numbers.
BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for every byte, A-Z as a-z, and powers of BASE and of its inverse."""
    letters = np.arange(256, dtype=np.uint64)
    letters[65:91] += np.uint64(32)
    return mix64(letters + np.uint64(BASE)), *_powers(HASHED_BYTES)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    return tuple(np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)]) for x in (BASE, inverse))


def _word_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word of UTF-8 bytes; no word goes over a break.

    A word's hash is the sum of its bytes' numbers times powers of BASE, shifted back to
    its start, so it is the same wherever the word stands.
    """
    values, powers, inverse = _tables()
    if len(data) > len(powers):
        powers, inverse = _powers(len(data))
    inside = ~_SPACE[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    before[breaks[breaks < len(data)]] = False
    after[breaks[breaks > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values[data] * powers[: len(data)])])
    hashes = (sums[ends] - sums[starts]) * inverse[starts] if len(starts) else np.empty(0, np.uint64)
    return mix64(hashes + (ends - starts).astype(np.uint64)), starts


def _long_text_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text of any length, in pieces that end between words."""
    found, at = [], 0
    while at < len(data):
        end = min(at + HASHED_BYTES, len(data))
        if end < len(data):
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                # One word: up to its end, however far.
                later = (i + HASHED_BYTES for i in range(end, len(data), HASHED_BYTES))
                cut = next((i for i in later if _SPACE[data[i - HASHED_BYTES : i]].any()), None)
                end = len(data) if cut is None else cut - HASHED_BYTES + int(_SPACE[data[cut - HASHED_BYTES : cut]].argmax()) + 1
        found.append(_word_hashes(data[at:end], np.empty(0, np.int64))[0])
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _windows(ids: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive ids."""
    total = np.full(max(0, len(ids) - width + 1), width, np.uint64)
    for i in range(width):
        total = mix64(total + ids[i : i + len(total)])
    return total


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Hashes (sorted, distinct) of the n-word shingles of each text; A-Z count as a-z.

    With fewer words the whole sequence is one shingle; without words the set is
    empty, also for NULL.
    """
    return list(each_shingle_set(texts, n))


def each_shingle_set(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """``shingle_sets`` one after the other: those of about HASHED_BYTES are held at once."""
    column = texts.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        # Texts of about HASHED_BYTES together; a longer one is alone.
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + HASHED_BYTES, "right")) - 1)
        own = offsets[first : last + 1] - offsets[first]
        held = data[offsets[first] : offsets[last]]
        if len(held) > HASHED_BYTES:
            ids = _long_text_hashes(held)
            edges = np.array([0, len(ids)])
        else:
            ids, starts = _word_hashes(held, own)
            edges = np.searchsorted(starts, own)
        all_windows = _windows(ids, n)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            found = all_windows[a : b - n + 1] if b - a >= n else _windows(ids[a:b], b - a) if b > a else ids[:0]
            yield np.unique(found)
        first = last


def shingles(text: str | None, n: int) -> np.ndarray:
    """The shingles of one text."""
    return shingle_sets(pa.array([text], pa.string()), n)[0]


class Plan(NamedTuple):
    """How a band is indexed: ``units`` of the universe, of which the first
    ``2 * doubles`` make double segments and the others single ones; the
    ``skipped`` smallest single segments of a set stay out of the index."""

    units: int
    doubles: int
    skipped: int


@lru_cache(maxsize=4096)
def allocate(size: int, errors: int) -> Plan:
    """The cheapest plan for sets of up to ``size`` that differ in ``errors`` shingles.

    A segment that agrees exactly uses up one error less than it could, a double
    one tolerates one difference: units = errors + 1 + skipped. Of the agreeing
    single segments of a pair each set skips its smallest; as both sort them by
    size and number, the larger of the two choices covers the other, so one
    agreeing segment is left.
    """
    best = None
    for doubles in sorted({0, 1, 2, (errors + 1) // 2}):
        for extra in (0, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0):
            skipped = math.ceil(extra * (errors + 1))
            units = errors + 1 + skipped
            singles = units - 2 * doubles
            if singles < skipped:
                continue
            mean = 0.85 * size / units
            false, drop, p, k = 0.0, skipped / singles if singles else 0.0, math.exp(-mean), 0
            while k < 60:
                kept = max(0.0, p - drop)
                drop = max(0.0, drop - p)
                false += kept * SHARED**k
                k += 1
                p *= mean / k
            twice = 2 * mean
            false2 = math.exp((SHARED - 1) * twice) * (twice + 1)
            cost = (singles - skipped) * (1 + FALSE_COST * false)
            cost += doubles * (twice + 1 + FALSE_COST * false2)
            if best is None or cost < best[0]:
                best = (cost, Plan(units, doubles, skipped))
    return best[1]


@lru_cache(maxsize=65536)
def bands(size: int, percent: int) -> tuple[tuple[int, int], ...]:
    """(end of band, errors) of all bands in which a set of ``size`` may have partners.

    A pair belongs to the band of its larger set.
    """
    found, end = [], 1
    largest = size * 100 // percent
    while True:
        if end >= size:
            found.append((end, 2 * end * (100 - percent) // (100 + percent)))
        if end >= largest:
            return tuple(found)
        end = max(end + 1, int(end * BAND_RATIO))


def index_keys(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Keys under which a set is indexed."""
    found = []
    for end, errors in bands(len(tokens), percent):
        plan = allocate(end, errors)
        seed = np.uint64(end * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        mixed = mix64(tokens ^ seed)
        unit = ((mixed >> np.uint64(32)) * np.uint64(plan.units) >> np.uint64(32)).astype(np.int64)
        n = plan.units - plan.doubles
        segment = np.where(unit < 2 * plan.doubles, unit >> 1, unit - plan.doubles)
        sums = np.zeros(n, np.uint64)
        np.add.at(sums, segment, mixed)
        sizes = np.bincount(segment, minlength=n)
        salt = mix64(np.arange(n, dtype=np.uint64) + seed)
        keys = mix64(sums ^ salt)
        d = plan.doubles
        order = np.argsort(sizes[d:], kind="stable") + d
        found.append(keys[order[plan.skipped :]])
        if d:
            found.append(keys[:d])
            inside = segment < d
            at = segment[inside]
            found.append(mix64((sums[at] - mixed[inside]) ^ salt[at]))
    return np.unique(np.concatenate(found))


def _numbered(sets: list[np.ndarray]) -> np.ndarray:
    """The shingles of all sets, one set behind the other, as the numbers of distinct ones.

    As ``np.unique`` gives them, with fewer copies at a time.
    """
    every = np.concatenate(sets)
    order = np.argsort(every).astype(np.int32)
    every = every[order]
    fresh_ones = np.ones(len(every), np.int32)
    fresh_ones[1:] = every[1:] != every[:-1]
    del every
    numbers = np.empty(len(order), np.int32)
    numbers[order] = np.cumsum(fresh_ones, dtype=np.int32) - 1
    return numbers


def verify(sets: list[np.ndarray], percent: int, core: np.ndarray | None = None) -> np.ndarray:
    """For each set the position of the first set of its component.

    Walks from set to set over the links, each time comparing one with all that
    aren't reached yet, through the lists of sets that have a shingle. Sets of the
    ``core`` are known to hang together and aren't walked from; what is linked with one
    has the first of them for its first.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    root = np.full(n, -1, np.int64)
    known = np.zeros(n, bool) if core is None else core
    # Half as wide as positions: a family's blocks have far fewer than 2^31 shingles.
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    tokens = _numbered(sets) if len(owner) else owner
    counts = np.bincount(tokens) if len(owner) else np.zeros(0, np.int64)
    shared = counts[tokens] > 1
    owner, tokens = owner[shared], tokens[shared]
    del shared
    lists = owner[np.argsort(tokens, kind="stable")]
    ends = np.cumsum(np.bincount(tokens, minlength=len(counts)))
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    own_end = np.searchsorted(owner, np.arange(n), "right")
    own_start = np.searchsorted(owner, np.arange(n), "left")
    top = int(known.argmax()) if known.any() else -1
    root[known] = top
    for first in range(n):
        if root[first] >= 0:
            continue
        root[first] = first
        front, reached, meets = [first], [first], False
        while front:
            u = front.pop()
            mine = tokens[own_start[u] : own_end[u]]
            if not len(mine):
                continue
            pieces = [lists[starts[t] : ends[t]] for t in mine]
            others = np.concatenate(pieces)
            others = others[(root[others] < 0) | (known[others] & (not meets))]
            if not len(others):
                continue
            common = np.bincount(others, minlength=n)
            near = np.flatnonzero(common)
            both = common[near]
            linked = near[100 * both >= percent * (sizes[u] + sizes[near] - both)]
            meets = meets or bool(known[linked].any())
            linked = linked[~known[linked]]
            root[linked] = first
            front.extend(linked.tolist())
            reached.extend(linked.tolist())
        if meets:
            root[reached] = top
    return root


PAYLOAD = np.dtype([("who", "<u8")])
#: Parts of the universe whose shingles are counted in a sketch.
SKETCH = 64
#: From this size on chance moves counts by more than linked sets may differ, so a sketch
#: goes on with four bits of the least shingle in each of so many parts.
LONG_SET, LEASTS = 512, 128
#: Linked sets have too few equal ones of these with a chance of at most exp(-SURE), 10^-21.
SURE = 48.0
#: Members of a key that are told apart by their sketches at once; those of a key with
#: more are cut into parts, and every two parts meet.
KEY_LIMIT = 4096


def shared_keys(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, first, who) of index keys that several texts have; ``texts`` has node and text."""

    def make(batch):
        nodes = batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for node, tokens in zip(nodes, each_shingle_set(batch.column("text"), n)):
            keys = index_keys(tokens, percent) if len(tokens) else tokens
            who = np.empty(len(keys), PAYLOAD)
            who["who"] = node
            yield keys, who

    shared = repeated_keys(
        texts, ["node", "text"], make, PAYLOAD, "key bigint, first bigint, who bigint", by_batch=True
    )
    return shared


def sketch(tokens: np.ndarray) -> bytes:
    """How many shingles fall into each part of the universe, up to 255."""
    counts = np.bincount((tokens >> np.uint64(58)).astype(np.int64), minlength=SKETCH)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def leasts(tokens: np.ndarray) -> bytes:
    """Four bits of the least shingle in each of LEASTS parts of the universe; 0 without any.

    Two sets agree on a part with the chance of their similarity.
    """
    edges = np.arange(LEASTS, dtype=np.uint64) * np.uint64((1 << 64) // LEASTS)
    at = np.searchsorted(tokens, edges)
    there = at < np.append(at[1:], len(tokens))
    told = np.zeros(LEASTS, np.uint8)
    told[there] = 1 + mix64(tokens[at[there]]) % np.uint64(15)
    return (told[::2] << 4 | told[1::2]).tobytes()


@lru_cache(maxsize=128)
def least_agreeing(percent: int) -> int:
    """How many parts linked sets agree on, but for a chance of at most exp(-SURE)."""
    p = percent / 100

    def rarity(n: int) -> float:
        # Chernoff's bound: n or fewer of LEASTS, each with a chance of p.
        q = n / LEASTS
        return LEASTS * sum(x * math.log(x / y) if x else 0 for x, y in ((q, p), (1 - q, 1 - p))) if p < 1 else math.inf

    return max((n + 1 for n in range(LEASTS) if n < p * LEASTS and rarity(n) >= SURE), default=0)


def sketch_groups(
    sketches: np.ndarray, sizes: np.ndarray, percent: int, parts: np.ndarray | None = None
) -> np.ndarray:
    """For each set the first one that it may be linked with, directly or over others.

    Linked sets differ in few shingles, so their sketches differ by no more. ``parts``
    has what ``leasts`` tells of the sets of LONG_SET shingles or more.
    """
    n = len(sizes)
    root = np.full(n, -1, np.int64)
    wide = sketches.astype(np.int16)
    long_ = sizes >= LONG_SET if parts is not None else np.zeros(n, bool)
    for first in range(n):
        if root[first] >= 0:
            continue
        root[first] = first
        front = [first]
        while front:
            u = front.pop()
            left = np.flatnonzero(root < 0)
            if not len(left):
                break
            apart = np.abs(wide[left] - wide[u]).sum(axis=1)
            near = left[apart * (100 + percent) <= (sizes[left] + sizes[u]) * (100 - percent)]
            if long_[u]:
                agree = (parts[near] == parts[u]).sum(axis=1)
                near = near[(agree >= least_agreeing(percent)) | ~long_[near]]
            root[near] = first
            front.extend(near.tolist())
    return root


def member_sets(keys: DataFrame) -> DataFrame:
    """(key, who) of one key for each set of texts that some key is shared by.

    Near copies share most of their keys, and keys with the same texts say the same: of
    these one is enough. A set is known by its size, ends and sums. A copy of a text has
    all keys of the text, so copies count alike in every key.
    """
    who = F.col("who")
    parts = {"low": who.bitwiseAND(0xFFFFFFFF), "high": F.shiftright(who, 32)}
    known = keys.groupBy("key").agg(
        F.count("*").alias("n"), F.min("who").alias("least"), F.max("who").alias("most"),
        *(F.sum(c).alias(name) for name, c in parts.items()),
    )
    sets = known.filter("least <> most").groupBy("n", "least", "most", *parts).agg(F.min("key").alias("key"))
    return keys.select("key", "who").join(sets.select("key"), "key", "left_semi").distinct()


def refined_edges(members: DataFrame, keys: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) of the members of each key whose sketches allow a link.

    ``members`` has node and text, ``keys`` distinct key and who. Members of a key with
    more than KEY_LIMIT are cut into parts by hash, and every two parts meet in a group of
    their own. A member has an edge to the first of a group that it may be linked with.
    """

    def sketched(batches):
        for batch in batches:
            sets = each_shingle_set(batch.column("text"), n)
            found = [(sketch(s) + (leasts(s) if len(s) >= LONG_SET else b""), len(s)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([told for told, _ in found], pa.binary()),
                    pa.array([size for _, size in found], pa.int64()),
                ],
                names=["who", "sketch", "size"],
            )

    sketches = members.select("node", "text").mapInArrow(
        sketched, "who bigint, sketch binary, size bigint"
    )
    parts = F.when(F.col("n") > KEY_LIMIT, F.ceil(F.col("n") * 2 / KEY_LIMIT)).otherwise(1).cast("int")
    per_key = keys.groupBy("key").agg(F.count("*").alias("n")).select("key", parts.alias("parts"))

    def split(batches):
        held: list[tuple] = []

        def edges(rows):
            who = np.array([r[1] for r in rows], np.int64)
            table = np.frombuffer(b"".join(r[2][:SKETCH] for r in rows), np.uint8).reshape(-1, SKETCH)
            packed = b"".join(r[2][SKETCH:] or bytes(LEASTS // 2) for r in rows)
            pairs = np.frombuffer(packed, np.uint8).reshape(len(rows), -1)
            told = np.concatenate([pairs >> 4, pairs & 15], axis=1)
            root = sketch_groups(table, np.array([r[3] for r in rows], np.int64), percent, told)
            apart = np.flatnonzero(root != np.arange(len(rows)))
            return np.column_stack([who[apart], who[root[apart]]])

        def all_edges(groups):
            found = [edges(g) for g in groups if len(g) > 1]
            pairs = np.unique(np.concatenate(found or [np.empty((0, 2), np.int64)]), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for batch in batches:
            key, i, j, *rest = (batch.column(c).to_pylist() for c in batch.schema.names)
            held += zip(zip(key, i, j), *rest)
            # The last group may go on in the next batch.
            last = next((i for i in range(len(held), 0, -1) if held[i - 1][0] != held[-1][0]), 0)
            yield all_edges(_runs(held[:last]))
            held = held[last:]
        yield all_edges(_runs(held))

    own = F.pmod(F.xxhash64("who"), F.col("parts")).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = (
        keys.join(per_key, "key").join(sketches, "who")
        .select("*", own.alias("own"), met.alias("other"))
        .filter("own <> other OR parts = 1")
        .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "who", "sketch", "size")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "who")
    )
    return dealt.mapInArrow(split, "a bigint, b bigint")


def _runs(rows: list[tuple]) -> list[list[tuple]]:
    return [list(group) for _, group in groupby(rows, key=lambda r: r[0])]


def _rows(docs: DataFrame, text: str, id: str) -> DataFrame:
    """(id, text, node) of every row; the node is the text's key."""
    return docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    ).withColumn("node", F.xxhash64("text"))


def _roots(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, root) of every text that may be linked; the root is a node of its component."""
    # Of equal texts one goes on; the first aggregation drops copies before the shuffle.
    texts = rows.select("node", "text").dropDuplicates(["node"])
    shared = stored(shared_keys(rows.select("node", "text"), n, percent).select("key", "who"), "keys")
    keys = stored(member_sets(shared), "sets")
    members = stored(texts.join(keys.select(F.col("who").alias("node")).distinct(), "node"), "members")
    family = components(refined_edges(members, keys, n, percent)).withColumnRenamed("root", "family")
    linked = verified_edges(members.join(family, "node"), n, percent)
    return components(linked.select("a", "b")).select("node", "root")


def link_components(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    n: int = 4,
    percent: int = 85,
) -> DataFrame:
    """One row per document: id, ``n_shingles`` and ``component_id``.

    Two texts link when ``100 * intersection >= percent * union`` of their sets
    of n-word shingles. ``component_id`` is the smallest id (NULLs last) that
    links reach, itself included. Texts without words are linked with nothing
    and keep their own id. Equal texts are one member with many rows; repeated
    rows stay repeated, and a component of NULL ids only has a NULL one.
    Other columns of ``docs`` are left out. Texts are told apart by 64-bit hashes:
    two among a billion are confused with probability 1/37.
    """
    rows = _rows(docs, text, id)
    sizes = stored(_sizes(rows, n), "sizes")
    placed = _rooted(sizes, _roots(rows, n, percent))
    smallest = placed.groupBy("root").agg(F.min("id").alias("least"))
    return placed.join(smallest, "root").select(
        F.col("id").alias(id),
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"),
    )


def one_per_component(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    n: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The rows of ``docs`` that stay if each component keeps one.

    It is the one with the smallest id (NULL is last), then key of the text; of
    rows with equal id and text any one. Texts without words are linked with
    nothing and all stay.
    """
    own, key, one, node, many = (fresh(c, docs.columns) for c in ("own", "key", "one", "node", "many"))
    rows = _rows(docs, text, id)
    placed = _rooted(rows.filter(F.col("text").rlike(ANY_WORD)).drop("text"), _roots(rows, n, percent))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    counted = placed.groupBy("root", "id", "node").agg(F.count("*").alias("n"))
    chosen = (
        counted.groupBy("root")
        .agg(F.min_by(F.struct("id", "node", "n"), order).alias("one"))
        .select(
            F.col("one.id").alias(one),
            F.col("one.node").alias(node),
            (F.col("one.n") > 1).alias(many),
        )
    )
    keyed = docs.withColumns({own: F.xxhash64(F.coalesce(text, F.lit(""))), key: F.col(id)})
    wordless = ~F.coalesce(F.col(text), F.lit("")).rlike(ANY_WORD)
    both = (F.col(own) == F.col(node)) & F.col(key).eqNullSafe(F.col(one))
    stay = keyed.filter(~wordless).join(chosen, both)
    # Only rows that are given twice move once more.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = stay.filter(~F.col(many))
    twice = stay.filter(F.col(many)).dropDuplicates([own, key])
    return once.select(*columns).union(twice.select(*columns)).union(keyed.filter(wordless).select(*columns))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with the root of their node; without links it is the node itself."""
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _sizes(rows: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            sizes = pa.array([len(s) for s in each_shingle_set(batch.column("text"), n)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("node"), sizes], names=["id", "node", "n_shingles"]
            )

    return rows.mapInArrow(run, with_fields(rows.select("id", "node"), n_shingles="bigint"))


def _weights(members: DataFrame) -> DataFrame:
    return members.groupBy("family").agg(F.sum(F.length("text") + 64).alias("chars"))


def _blocks(members: DataFrame, count: str, own: str) -> DataFrame:
    """Members of each family dealt to blocks of about BLOCK_CHARS: their count and number."""
    blocks = F.greatest(F.lit(1), F.ceil(F.col("chars") / BLOCK_CHARS)).cast("int")
    weight = _weights(members).select("family", blocks.alias(count))
    number = F.pmod(F.xxhash64("node"), F.col(count)).cast("int")
    return members.join(weight, "family").withColumn(own, number)


def verified_edges(members: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b): each text of a family (family, node, text) with one of its component.

    A family is cut into blocks of about BLOCK_CHARS; the first texts of the family go to
    each of them, and each is verified in one task. What hangs together by these texts
    already, the core, needs no comparing among itself: the blocks of all other texts of
    the family then meet each other and the blocks of its core. So all links count, and a
    family of near copies, however large, takes work in proportion. No task holds more
    than two blocks and the first texts.
    """
    cut = stored(_blocks(members, "blocks", "own"), "blocks")

    def group(table: pa.Table) -> pa.Table:
        # Only the sets are held while they are compared, and no copy of the texts before.
        nodes, once = np.unique(table["node"].to_numpy(), return_index=True)
        core = table["core"].to_numpy()[once]
        sets = [s for part in table["text"].chunks for s in each_shingle_set(part, n)]
        del table
        root = verify([sets[i] for i in once], percent, core)
        return pa.table({"a": nodes, "b": nodes[root]})

    large = cut.filter("blocks > 1")
    order = Window.partitionBy("family").orderBy("node")
    first = large.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= FIRST_TEXTS)
    sent = first.withColumn("own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    columns = ["family", "own", "node", "text"]
    dealt = cut.select(*columns).union(sent.select(*columns)).withColumn("core", F.lit(False))
    inside = stored(
        dealt.repartition("family", "own").groupBy("family", "own").applyInArrow(group, "a bigint, b bigint"),
        "linked",
    )
    if large.isEmpty():
        return inside
    of_large = large.select(F.col("node").alias("a"))
    joined = components(inside.join(of_large, "a", "left_semi"))
    placed = large.select("family", "node", "text").join(joined, "node")
    count = placed.groupBy("family", "root").agg(F.count("*").alias("n"))
    core = count.groupBy("family").agg(F.max_by("root", F.struct("n", "root")).alias("core_root"))
    told = stored(
        placed.join(core, "family").select("family", "node", "text", (F.col("root") == F.col("core_root")).alias("core")),
        "told",
    )
    core, rest = (_blocks(told.filter(F.col("core") == kind), count, own) for kind, count, own in (
        (True, "core_blocks", "i"), (False, "rest_blocks", "j")))
    cores, rests = (d.select("family", c).distinct() for d, c in ((core, "core_blocks"), (rest, "rest_blocks")))
    many = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    columns = ["family", "i", "j", "core", "node", "text"]
    pair = (F.least("j", "other").alias("i"), (-1 - F.greatest("j", "other")).alias("j"))
    met = (
        core.join(rests, "family").withColumn("j", F.explode(many("rest_blocks"))).select(*columns)
        .union(rest.join(cores, "family").withColumn("i", F.explode(many("core_blocks"))).select(*columns))
        # Blocks of the rest among themselves; their second number is told by its sign.
        .union(
            rest.withColumn("other", F.explode(many("rest_blocks")))
            .filter("other <> j OR rest_blocks = 1").select("family", *pair, "core", "node", "text")
        )
    )
    # The joins above have dealt by family alone: without this all pairs of blocks of
    # a family would be one task's.
    across = met.repartition("family", "i", "j").groupBy("family", "i", "j").applyInArrow(group, "a bigint, b bigint")
    return inside.union(across)
