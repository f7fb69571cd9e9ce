"""Benchmark decontamination by the q-gram lemma.

A region that equals a benchmark item of ``m`` characters but for ``e`` edits
shares at least ``m - q + 1 - q * e`` of its q-grams, on diagonals that lie no
more than ``e`` apart. Shared q-grams are counted in overlapping bands of
diagonals; bands that reach the bound are verified by banded alignment.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeway.llm.common import mix64

Q = 8
EDIT_RATE = 0.1
#: Characters of benchmark text whose index is sent to all executors at once; a
#: larger benchmark is searched in so many passes.
SHARD_CHARS = 4 << 20
#: Characters of documents that are looked at together.
CHUNK_CHARS = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def plain(text: str | None) -> str:
    """Lower case, with runs of white space as one space; NULL is empty."""
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    n = len(chars) - q + 1
    if n < 1:
        return np.empty(0, np.uint64)
    wide = chars.astype(np.uint64)
    total = wide[:n].copy()
    for i in range(1, q):
        total *= _STEP
        total += wide[i : i + n]
    return mix64(total)


class Index(NamedTuple):
    """q-grams of the items of a shard."""

    ids: list
    items: list[np.ndarray]
    budget: np.ndarray  # edits that an item may have
    least: np.ndarray  # q-grams that must then be left
    filled: np.ndarray  # by the low bits of a hash: whether there may be such a q-gram
    grams: np.ndarray  # sorted
    first: np.ndarray  # of a q-gram, in the places
    count: np.ndarray
    item: np.ndarray
    place: np.ndarray


def build_index(rows: list[tuple], q: int, rate: float) -> Index:
    """``rows``: (id, text). The budget leaves at least one q-gram by the lemma.

    So it is ``rate`` of an item's characters, but no more than ``(length - q) // q``: with
    8 characters and a tenth, items of 40 or more have all of it, one of 30 has two edits
    in place of three. Items of fewer than ``q`` characters have no q-gram and match nothing.
    """
    kept = [(i, codes(plain(t))) for i, t in rows]
    kept = [(i, c) for i, c in kept if len(c) >= q]
    length = np.array([len(c) for _, c in kept], np.int64)
    budget = np.minimum((length * rate).astype(np.int64), (length - q) // q)
    hashes = [gram_hashes(c, q) for _, c in kept]
    flat = np.concatenate(hashes) if kept else np.empty(0, np.uint64)
    item = np.repeat(np.arange(len(kept)), [len(h) for h in hashes])
    place = np.concatenate([np.arange(len(h)) for h in hashes]) if kept else item
    order = np.argsort(flat, kind="stable")
    grams, first, count = np.unique(flat[order], return_index=True, return_counts=True)
    bits = max(16, (8 * len(grams)).bit_length())
    filled = np.zeros(1 << bits, bool)
    filled[grams & np.uint64((1 << bits) - 1)] = True
    return Index(
        [i for i, _ in kept], [c for _, c in kept], budget, length - q + 1 - q * budget,
        filled, grams, first, count, item[order], place[order],
    )


def bands_of(
    index: Index, chars: np.ndarray, starts: np.ndarray, q: int
) -> list[tuple[int, int, int, int]]:
    """(document, item, first and last diagonal) of regions that reach their item's bound.

    ``chars`` holds documents one behind the other, at ``starts``. A band has
    ``width`` diagonals and as many more as the item's budget: it shares these
    with the next one, so any budget of diagonals lies within one band. Bands that
    reach the bound are cut to the diagonals that reach it within a budget.
    """
    hashes = gram_hashes(chars, q)
    at = np.flatnonzero(index.filled[hashes & np.uint64(len(index.filled) - 1)])
    found = np.searchsorted(index.grams, hashes[at])
    found[found == len(index.grams)] = 0
    real = index.grams[found] == hashes[at]
    at, found = at[real], found[real]
    doc = np.searchsorted(starts, at, "right") - 1
    inside = at + q <= np.append(starts[1:], len(chars))[doc]
    at, found, doc = at[inside], found[inside], doc[inside]
    count = index.count[found]
    which = np.repeat(np.arange(len(at)), count)
    entry = np.repeat(index.first[found] - (np.cumsum(count) - count), count) + np.arange(len(which))
    item, place = index.item[entry], index.place[entry]
    longest = max(map(len, index.items))
    width = 1 << int(index.budget.max()).bit_length()
    # Diagonals of documents lie apart by more than an item, and are positive.
    gap = longest + 2 * width
    diagonal = at[which] - place + (doc[which] + 1) * gap
    band = diagonal // width
    low = diagonal % width < index.budget[item]
    n = np.int64(len(index.items))
    keys = np.concatenate([band * n + item, (band[low] - 1) * n + item[low]])
    found, counts = np.unique(keys, return_counts=True)
    found = found[counts >= index.least[found % n]]
    if not len(found):
        return []
    kept = np.searchsorted(found, keys)
    kept[kept == len(found)] = 0
    kept = np.flatnonzero(found[kept] == keys)
    keys = keys[kept]
    source = np.concatenate([np.arange(len(item)), np.flatnonzero(low)])[kept]
    diagonal, doc = diagonal[source], doc[which[source]]
    order = np.lexsort((diagonal, keys))
    keys, diagonal, doc = keys[order], diagonal[order], doc[order]
    edges = np.append(np.flatnonzero(np.diff(keys, prepend=-1)), len(keys))
    regions = set()
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        i = int(keys[a] % n)
        budget = int(index.budget[i])
        own = diagonal[a:b]
        reach = np.searchsorted(own, own + budget, "right") - np.arange(b - a)
        full = np.flatnonzero(reach >= index.least[i])
        if len(full):
            first = int(own[full[0]])
            last = int(own[full[-1]]) + budget
            shift = int(starts[doc[a]]) + (int(doc[a]) + 1) * gap
            regions.add((int(doc[a]), i, first - shift, last - shift))
    return sorted(regions)


def align(
    item: np.ndarray, text: np.ndarray, low: int, high: int, anchored: bool = False
) -> tuple[int, int]:
    """(edits, end) of the best place of the whole item on diagonals low to high.

    The place may begin anywhere, or with the text if ``anchored``.
    """
    width = high - low + 1
    steps = np.arange(width)
    cost = np.maximum(low + steps, 0) if anchored else np.zeros(width, np.int64)
    outside = len(item) + len(text)
    cost[(low + steps < 0) | (low + steps > len(text))] = outside
    padded = np.full(len(item) + width + 1, -1, np.int64)
    a, b = max(0, low), min(len(text), low + len(padded))
    if b > a:
        padded[a - low : b - low] = text[a:b]
    for i, c in enumerate(item.tolist()):
        over = padded[i : i + width]
        kept = cost + (over != c)
        kept[:-1] = np.minimum(kept[:-1], cost[1:] + 1)
        # An edit for each character of the text that is passed over.
        cost = np.minimum.accumulate(kept - steps) + steps
        ends = low + i + 1 + steps
        cost[(ends < 0) | (ends > len(text))] = outside
    best = int(np.argmin(cost))
    return int(cost[best]), low + len(item) + best


def find(index: Index, texts: list[str], q: int) -> list[tuple[int, object, int, int, int]]:
    """(text, item id, start, end, edits) of the best match of every item in every text."""
    chars = [codes(t) for t in texts]
    starts = np.cumsum([0] + [len(c) for c in chars[:-1]])
    if not len(index.ids) or not sum(map(len, chars)):
        return []
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for doc, i, low, high in bands_of(index, np.concatenate(chars), starts, q):
        budget = int(index.budget[i])
        item, text = index.items[i], chars[doc]
        edits, end = align(item, text, low - budget, high + budget)
        if edits > budget:
            continue
        # The start is where the reversed item ends in the reversed text.
        reach = max(0, end - len(item) - budget)
        back = text[reach:end][::-1]
        _, length = align(item[::-1], back, -edits, edits, anchored=True)
        start = end - length
        held = best.get((doc, i))
        if held is None or (edits, start) < (held[2], held[0]):
            best[doc, i] = (start, end, edits)
    return [(doc, index.ids[i], *match) for (doc, i), match in sorted(best.items())]


def matches(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    q: int = Q,
    rate: float = EDIT_RATE,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """(id, item id, start, stop, edits): benchmark items that documents hold.

    An item matches a region that differs in at most ``rate`` of its characters,
    after case and runs of white space are evened out; ``start`` and ``stop`` count
    the characters of the document in that form. The best place of each item is
    given. All documents are searched whole for all items.

    NULL and empty texts match nothing, nor do items of fewer than ``q``
    characters. Repeated documents and items match each. The items are the query
    set: they are indexed in shards of about ``shard_chars`` characters, one pass
    over the documents each.
    """
    items = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).dropna()
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    shards = 1 + total // shard_chars
    kinds = {id: docs.schema[id].dataType, item_id: items.schema["i"].dataType}
    ddl = ", ".join(f"`{n}` {t.simpleString()}" for n, t in kinds.items())
    ddl += ", start bigint, stop bigint, edits bigint"
    names = [id, item_id, "start", "stop", "edits"]
    found = None
    for shard in range(shards):
        chosen = items.filter(F.pmod(F.xxhash64("t"), F.lit(shards)) == shard)
        rows = [(r.i, r.t) for r in chosen.collect()]  # bounded by the shard
        shipped = docs.sparkSession.sparkContext.broadcast(build_index(rows, q, rate))
        one = docs.select(id, text).mapInArrow(_searcher(shipped, id, text, q, names), ddl)
        found = one if found is None else found.union(one)
    return found


def _searcher(shipped, id, text, q, names):
    def run(batches):
        index = shipped.value
        for batch in batches:
            ids = batch.column(id)
            values = batch.column(text).to_pylist()
            at = 0
            while at < len(values):
                texts, size, end = [], 0, at
                while end < len(values) and (not texts or size < CHUNK_CHARS):
                    texts.append(plain(values[end]))
                    size += len(texts[-1])
                    end += 1
                rows = find(index, texts, q)
                if rows:
                    columns = list(zip(*rows))
                    where = pa.array([at + d for d in columns[0]], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(where), pa.array(columns[1])]
                        + [pa.array(c, pa.int64()) for c in columns[2:]],
                        names=names,
                    )
                at = end

    return run
