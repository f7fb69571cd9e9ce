"""Decontamination against a full alignment of every item with every text."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bronzeway.llm import decontam


def least_edits(item: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(text, n, rng):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.choice("rid")
        if kind == "r":
            chars[at] = "z"
        elif kind == "i":
            chars.insert(at, "z")
        elif len(chars) > 1:
            del chars[at]
    return "".join(chars)


def fixture(seed=5):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.choice([8, 12, 25, 40]))) for i in range(12)] + [(90, "short"), (91, "")]
    docs = []
    for i in range(40):
        parts = [prose(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            item = rng.choice(items[:12])[1]
            parts += [edited(item, rng.randint(0, max(1, len(item) // 8)), rng), prose(rng.randint(0, 20))]
        docs.append((i, rng.choice([" ", "\n "]).join(parts)))
    return items, docs + [(40, None), (41, ""), (42, items[0][1].upper()), (42, items[0][1])]


def test_equals_full_alignment(spark):
    items, docs = fixture()
    got = decontam.matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([*items, (None, None)], "item_id long, text string"),
        shard_chars=400,
    ).collect()
    index = decontam.build_index(items, decontam.Q, decontam.EDIT_RATE)
    budget = dict(zip(index.ids, index.budget.tolist()))
    expected = set()
    for d, text in docs:
        for i, item in items:
            if i in budget:
                e = least_edits(decontam.plain(item), decontam.plain(text))
                if e <= budget[i]:
                    expected.add((d, i, e))
    assert {(r.doc_id, r.item_id, r.edits) for r in got} == expected
    assert len(expected) > 20 and len({e for *_, e in expected}) > 3
    texts = dict(docs[:42])
    for r in got:
        if r.doc_id != 42:
            place = decontam.plain(texts[r.doc_id])[r.start : r.stop]
            item = decontam.plain(dict(items)[r.item_id])
            assert least_edits(item, place) == r.edits


def test_empty_tables_and_names(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a" * 50, "x")], "doc_id long, text string, edits string")
    assert decontam.matches(docs, none).collect() == []
    assert decontam.matches(docs.limit(0), docs.selectExpr("doc_id as item_id", "text")).collect() == []
    found = decontam.matches(docs, docs.selectExpr("doc_id as item_id", "text")).collect()
    assert [(r.doc_id, r.item_id, r.start, r.stop, r.edits) for r in found] == [(1, 1, 0, 50, 0)]


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=8, max_size=60), st.text("ab", max_size=80))
def test_alignment_in_a_band_of_everything(item, text):
    edits, end = decontam.align(decontam.codes(item), decontam.codes(text), -len(item), len(text))
    assert edits == least_edits(item, text)
    assert 0 <= end <= len(text)
    assert np.all(decontam.gram_hashes(decontam.codes("aaaa"), 2) == decontam.gram_hashes(decontam.codes("aa"), 2))
