"""Substring dedup over sliding spans of sentences.

From every sentence a run of several consecutive sentences is hashed and joined with
all equal runs; a text too short for one is compared as a whole. The first run in
document order stays; sentences that any other repeated run covers are removed.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeway.llm.common import fresh, mix64, repeated_keys, stored, with_fields

#: A run has so many sentences at least, and goes on until it has so many words.
SENTENCES = 3
LEAST_WORDS = 18
#: Sentences of more words count as several: they are cut behind ``,``, ``;`` and ``:``
#: and behind every word whose hash says so, one in CUT_ONE_IN.
LONG_SENTENCE = 24
CUT_ONE_IN = 6
END = re.compile(r"(?<=[.!?])\s+|\s*\n\s*")
WORD = re.compile(r"\S+\s*")

PAYLOAD = np.dtype([("who", "<i8"), ("text_key", "<i8"), ("at", "<u4"), ("n", "<u4")])
LAST = 2**63 - 1
#: Marks the hashes of whole texts.
WHOLE = 1 << 32
#: Odd, so that it has an inverse among the 64-bit numbers.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
ADDED = ("n_sentences", "n_removed", "kept")


@lru_cache(maxsize=1 << 16)
def ends_part(word: str) -> bool:
    """Whether a long sentence is cut behind a word: looks at nothing but the word."""
    return word[-1] in ",;:" or xxhash.xxh3_64_intdigest(word) % CUT_ONE_IN == 0


def sentences(text: str | None) -> tuple[list[tuple[int, int]], list[int]]:
    """(start, end) of every sentence with what follows up to the next one, and its words.

    A sentence ends at white space behind ``.``, ``!`` or ``?``, and at a line
    break; parts of a long one count as sentences. Leading white space belongs to the
    first one.
    """
    if not text or text.isspace():
        return [], []
    edges = [0, *(m.end() for m in END.finditer(text))]
    if edges[-1] != len(text):
        edges.append(len(text))
    if len(edges) > 2 and not text[: edges[1]].strip():
        del edges[1]
    found, words = [], []
    for a, b in zip(edges, edges[1:]):
        cut = text[a:b]
        n = len(cut.split())
        if n <= LONG_SENTENCE:
            found.append((a, b))
            words.append(n)
            continue
        start, held, end = a, 0, a
        for m in WORD.finditer(text, a, b):
            held, end = held + 1, m.end()
            if end < b and ends_part(m.group().rstrip()):
                found.append((start, end))
                words.append(held)
                start, held = end, 0
        found.append((start, b))
        words.append(held)
    return found, words


def run_hashes(
    text: str | None, n: int = SENTENCES, least_words: int = LEAST_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of its first sentence, sentences) of all runs that are evidence.

    The shortest run from each sentence with ``n`` sentences and ``least_words``; the last
    one again up to the end of the text; or, in a text without any, the whole text. Whole texts are compared with such only.
    """
    found, words = sentences(text)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    parts = (text[a:b].strip() for a, b in found)
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(found))
    so_far = np.cumsum([0, *words])
    ends = np.searchsorted(so_far, so_far[:-1] + least_words)
    ends = np.maximum(ends, np.arange(len(found)) + n)
    starts = np.flatnonzero(ends <= len(found))
    if not len(starts):
        whole = np.full(1, WHOLE + len(found), np.uint64)
        for i in ids:
            whole = mix64(whole + i)
        return whole, np.zeros(1, np.int64), np.full(1, len(found), np.int64)
    ends = ends[starts]
    if ends[-1] < len(found):
        starts, ends = np.append(starts, starts[-1]), np.append(ends, len(found))
    # The sum of ids times powers of an odd base, shifted back to the run's start.
    powers = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), BASE, np.uint64)])
    back = np.cumprod(np.r_[np.uint64(1), np.full(len(ids), INVERSE, np.uint64)])
    sums = np.r_[np.uint64(0), np.cumsum(ids * powers[:-1])]
    sizes = ends - starts
    keys = (sums[ends] - sums[starts]) * back[starts] + sizes.astype(np.uint64)
    return mix64(keys), starts, sizes


def remove_repeated_spans(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    n: int = SENTENCES,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Add ``n_sentences``, ``n_removed`` and ``kept`` (the text without them).

    From every sentence the shortest run of ``n`` sentences with ``least_words`` words is
    compared over all documents, and within one; a text without such a run is compared
    as a whole, with others like it, however short. The first is the one with the smallest
    id (NULL is last), then text, then place; sentences covered by another one go, with the
    white space behind them. Sentences of more than LONG_SENTENCE words count as several.

    A NULL text has no sentences and stays NULL, as an empty one stays empty. Rows with the
    same id and text count as one row and get the same result. Texts may be of any length
    and are looked at whole; no rows give none. Input columns of the added names are
    replaced, all others pass through, whatever their names.
    """
    keep = [c for c in docs.columns if c.lower() not in ADDED]
    who, key, runs = (fresh(c, docs.columns) for c in ("who", "text_key", "runs"))
    rows = docs.select(
        *(F.col(f"`{c}`") for c in keep),
        F.coalesce(F.col(id).cast("bigint"), F.lit(LAST)).alias(who),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias(key),
    )

    def make(row, text_key, value):
        keys, at, size = run_hashes(value, n, least_words)
        held = np.empty(len(keys), PAYLOAD)
        held["who"], held["text_key"], held["at"], held["n"] = row, text_key, at, size
        return keys, held

    names = ("key", "first", *PAYLOAD.names)
    same = stored(
        repeated_keys(
            rows, [who, key, text], make, PAYLOAD, ", ".join(f"{c} bigint" for c in names)
        ).drop("first"),
        "runs",
    )
    place = F.struct("who", "text_key", "at")
    firsts = same.groupBy("key").agg(F.min(place).alias("least")).select("key", "least.*")
    # By the whole place, which spreads the runs of a key that most rows have.
    others = same.join(firsts, ["key", "who", "text_key", "at"], "left_anti")
    covered = (
        others.select("who", "text_key", "at", "n")
        .distinct()
        .groupBy(F.col("who").alias(who), F.col("text_key").alias(key))
        .agg(F.collect_list(F.struct("at", "n")).alias(runs))
    )
    joined = rows.join(covered, [who, key], "left").select(*(f"`{c}`" for c in keep), f"`{runs}`")

    def cut(batches):
        for batch in batches:
            out = []
            for value, gaps in zip(batch.column(text).to_pylist(), batch.column(runs).to_pylist()):
                found, _ = sentences(value)
                gone = np.zeros(len(found), bool)
                for run in gaps or ():
                    gone[run["at"] : run["at"] + run["n"]] = True
                kept = value
                if gone.any():
                    kept = "".join(value[a:b] for (a, b), g in zip(found, gone) if not g)
                out.append((len(found), int(gone.sum()), kept))
            added = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep]
                + [pa.array(added[0], pa.int64()), pa.array(added[1], pa.int64()), pa.array(added[2], pa.string())],
                names=[*keep, *ADDED],
            )

    kinds = with_fields(joined.drop(runs), n_sentences="bigint", n_removed="bigint", kept="string")
    return joined.mapInArrow(cut, kinds)
