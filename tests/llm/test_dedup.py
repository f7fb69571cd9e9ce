"""Jaccard join, suffix dedup and sentence spans against brute force."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bronzeway.llm import common, jaccard, spans, suffixes

from .helpers import linked_components, repeated_bytes, shingle_set


def near_copies(seed=3, families=12):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") * rng.randint(1, 3)
    passage = [word() for _ in range(15)]
    rows = []
    for _ in range(families):
        base = [word() for _ in range(rng.choice([1, 3, 6, 12, 30, 80, 200]))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(copy) // 25)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows) * 7 % 101, " ".join(copy)))
    more = [None, "", " \t\n", "One Two", "one two", rows[0][1], rows[0][1].upper(), "x " * 3000]
    return rows + [(200 + i, t) for i, t in enumerate(more)] + [rows[1], (None, rows[2][1]), (None, "lonely")]


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_components_equal_brute_force(spark, n, percent):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.link_components(docs, n=n, percent=percent).collect()
    expected = linked_components(rows, n, percent)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(
        ((i, *e) for (i, _), e in zip(rows, expected)), key=key
    )
    assert len({c for _, c in expected}) < len(rows) - 10


def test_small_blocks_change_nothing(spark, monkeypatch):
    rows = near_copies(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: tuple((x is None, x) for x in r)
    whole = sorted(map(tuple, jaccard.link_components(docs).collect()), key=key)
    monkeypatch.setattr(jaccard, "BLOCK_CHARS", 900)
    assert sorted(map(tuple, jaccard.link_components(docs).collect()), key=key) == whole
    monkeypatch.setattr(jaccard, "KEY_LIMIT", 2)
    assert sorted(map(tuple, jaccard.link_components(docs).collect()), key=key) == whole


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1), min_size=1, max_size=10), st.integers(40, 100))
def test_sketches_part_no_linked_sets(sets, percent):
    arrays = [common.mix64(np.array(sorted(s), np.uint64) + np.uint64(7)) for s in sets]
    table = np.frombuffer(b"".join(map(jaccard.sketch, arrays)), np.uint8).reshape(-1, jaccard.SKETCH)
    root = jaccard.sketch_groups(table, np.array([len(s) for s in sets]), percent)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if 100 * len(a & b) >= percent * len(a | b):
                assert root[i] == root[j]


def test_one_row_of_each_component_stays(spark):
    rows = [(i, t, "x") for i, t in near_copies()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = jaccard.one_per_component(docs, n=5, percent=80)
    assert got.columns == docs.columns
    kept = got.collect()
    wordless = [r for r in rows if not (r[1] or "").strip()]
    components = linked_components([r[:2] for r in rows], 5, 80)
    ids = {c for (n, c) in components if n}
    assert len(kept) == len(ids) + len(wordless)
    assert {r.doc_id for r in kept if (r.text or "").strip()} == ids


def test_every_linked_pair_shares_an_index_key():
    rng = np.random.default_rng(1)
    for percent in (50, 80, 85, 95):
        for _ in range(300):
            size = int(rng.integers(1, 160))
            base = rng.integers(0, 2**63, size).astype(np.uint64)
            other = base[rng.random(size) > rng.uniform(0, 0.3)]
            other = np.concatenate([other, rng.integers(0, 2**63, int(rng.integers(0, 1 + size // 6))).astype(np.uint64)])
            a, b = np.unique(base), np.unique(other)
            if not len(b):
                continue
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both):
                shared = np.intersect1d(jaccard.index_keys(a, percent), jaccard.index_keys(b, percent))
                assert len(shared), (percent, len(a), len(b), both)


def test_allocation_covers_all_errors():
    doubles = set()
    for size in (*range(1, 60), 100, 1000):
        for errors in range(0, size // 3 + 1):
            plan = jaccard.allocate(size, errors)
            assert plan.units == errors + 1 + plan.skipped
            assert plan.units - 2 * plan.doubles >= plan.skipped
            doubles.add(plan.doubles)
    assert len(doubles) > 1  # both kinds of segments are in use


def test_shingles_are_distinct_word_runs():
    text = "A b c d a B c d a\x0b\x85é"
    assert len(jaccard.shingles(text, 4)) == len(shingle_set(text, 4))
    assert len(jaccard.shingles(None, 4)) == len(jaccard.shingles(" \n", 4)) == 0
    assert len(jaccard.shingles("one two", 4)) == 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), max_size=12), st.integers(40, 100))
def test_verification_finds_all_components(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    root = jaccard.verify(arrays, percent).tolist() if sets else []
    rows = [(i, None) for i in range(len(sets))]
    parent = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= percent * len(a | b):
                    parent[i] = parent[j] = min(parent[i], parent[j])
    assert root == parent and len(rows) == len(root)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=1, max_size=12), st.integers(40, 100), st.randoms())
def test_a_known_core_is_one_component(sets, percent, draw):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    core = np.array([draw.random() < 0.4 for _ in sets])
    root = jaccard.verify(arrays, percent, core).tolist()
    parent = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 100 * len(a & b) >= percent * len(a | b) or core[i] and core[j]:
                    parent[i] = parent[j] = min(parent[i], parent[j])
    for i in range(len(sets)):
        for j in range(len(sets)):
            assert (root[i] == root[j]) == (parent[i] == parent[j])


def near_and_far_sets(size, n=12, share=0.85, seed=7):
    """Sets without common shingles; every other one has a linked set behind it."""
    draw = np.random.default_rng(seed)
    found = []
    for i in range(n):
        own = draw.integers(1 << 63, size=size, dtype=np.uint64) << np.uint64(1)
        found.append(np.unique(own))
        if i % 2:
            kept = int(size * 2 * share / (1 + share)) + 1
            rest = draw.integers(1 << 63, size=size - kept, dtype=np.uint64) << np.uint64(1)
            found.append(np.unique(np.concatenate([own[:kept], rest])))
    return found


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("size", [600, 4000, 60000])
def test_long_unlike_sets_are_told_apart(size, percent):
    sets = near_and_far_sets(size, share=percent / 100 + 0.002)
    table = np.frombuffer(b"".join(map(jaccard.sketch, sets)), np.uint8).reshape(-1, jaccard.SKETCH)
    packed = np.frombuffer(b"".join(map(jaccard.leasts, sets)), np.uint8).reshape(len(sets), -1)
    parts = np.concatenate([packed >> 4, packed & 15], axis=1)
    root = jaccard.sketch_groups(table, np.array([len(s) for s in sets]), percent, parts).tolist()
    assert root == jaccard.verify(sets, percent).tolist()
    assert len(set(root)) == 12 and len(root) == 18


def test_linked_sets_agree_on_enough_parts():
    for percent in (40, 50, 80, 85, 99, 100):
        least, p = jaccard.least_agreeing(percent), percent / 100
        missed = sum(math.comb(jaccard.LEASTS, i) * p**i * (1 - p) ** (jaccard.LEASTS - i) for i in range(least))
        assert missed < 1e-20
    assert jaccard.least_agreeing(80) > 40 and jaccard.least_agreeing(100) == jaccard.LEASTS


@pytest.mark.parametrize("limit, words", [(4096, 3000), (2, 3000), (2, 30)])
def test_unlike_texts_of_a_key_make_no_family(spark, monkeypatch, limit, words):
    monkeypatch.setattr(jaccard, "KEY_LIMIT", limit)
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(words)) for _ in range(7)]
    texts.append(" ".join([*texts[3].split()[:-1], "other"]))
    members = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    keys = spark.createDataFrame([(1, i) for i in range(8)], "key long, who long")
    edges = jaccard.refined_edges(members, keys, 5, 80).distinct().collect()
    assert sorted(tuple(r) for r in edges) == [(7, 3)]


def test_one_set_of_texts_counts_once(spark):
    entries = [(k, w) for k in range(50) for w in (3, 5, 8)] + [(60, 3), (60, 5), (61, 9), (61, 9), (62, 3), (62, 5)]
    # Copies of a text have all its keys.
    entries += [(k, 5) for k in (*range(50), 60, 62)]
    keys = spark.createDataFrame(entries, "key long, who long")
    got = [tuple(r) for r in jaccard.member_sets(keys).collect()]
    assert sorted(got) == [(0, 3), (0, 5), (0, 8), (60, 3), (60, 5)]


def test_a_family_with_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_CHARS", 3000)
    rng = random.Random(12)
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    rows = [(i, " ".join(f"{rng.choice('xyz')}{rng.randrange(900)}" for _ in range(40))) for i in range(80)]
    for i in range(100, 160):
        words = list(base)
        words[rng.randrange(60)] = f"n{i}"
        rows.append((i, " ".join(words)))
    # A chain away from the others, each link near the one before only.
    for i in range(200, 212):
        base = [*base[2:], f"c{i}", f"d{i}"]
        rows.append((i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = linked_components(rows, 4, 80)
    got = jaccard.link_components(docs, n=4, percent=80).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(i, *e) for (i, _), e in zip(rows, expected)]
    assert max(sum(c == d for _, d in expected) for _, c in expected) >= 50


def test_one_per_component_takes_clashing_names(spark):
    names = ["_own", "_id", "_one", "_node", "_many", "own", "key", "one", "node", "many", "root", "family"]
    rows = [(i, t, *names) for i, t in near_copies()]
    ddl = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, ddl)
    kept = jaccard.one_per_component(docs, n=5, percent=80)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert found and all(tuple(r)[2:] == tuple(names) for r in found)
    assert jaccard.one_per_component(docs.limit(0)).collect() == []


# --- suffixes --------------------------------------------------------------------


def pasted(seed=3, n=60):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abc dé") for _ in range(rng.choice([150, 220, 400]))) for _ in range(6)]
    texts = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 5)):
            text += "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 200)))
            at = rng.randint(0, 60)
            text += rng.choice(passages)[at : at + rng.randint(100, 400)]
        texts.append(text)
    return texts + [texts[3], None, "", "x" * 199, "y" * 200, "z" * 201, "ab" * 500, "it. " * 300]


@pytest.mark.parametrize("limit", [suffixes.CLASS_LIMIT, 2])
def test_repeats_equal_brute_force(spark, limit):
    texts = pasted()
    docs = spark.createDataFrame(
        [(i, t, "mine", "own") for i, t in enumerate(texts)], "doc_id long, text string, kept string, short string"
    )
    got = suffixes.remove_repeats(docs, limit=limit)
    assert {"doc_id", "text", "short"} < set(got.columns)
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()}
    assert [rows[i] for i in range(len(texts))] == repeated_bytes(texts, 200)


def test_repeats_take_clashing_names_and_long_texts(spark):
    names = ["_text_key", "text_key", "short", "spans", "key", "segment", "who"]
    rng = random.Random(9)
    body = " ".join(str(rng.randrange(10**9)) for _ in range(300_000))
    rows = [(1, body, *names), (2, "own " * 9 + body[1000:2_500_000], *names), (3, None, *names)]
    ddl = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    got = {r.doc_id: r for r in suffixes.remove_repeats(spark.createDataFrame(rows, ddl)).collect()}
    assert all(tuple(r[n] for n in names) == tuple(names) for r in got.values())
    assert got[1].n_bytes == len(body) and got[1].n_removed == len(body[1000:2_500_000]) and got[1].n_spans == 1
    assert got[2].kept == "own " * 9 and got[3].n_bytes == 0


def test_repeats_of_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.remove_repeats(docs).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.binary(max_size=6), max_size=8), max_size=6))
def test_merged_runs_are_sorted_with_their_prefixes(groups):
    runs = [suffixes.front_code([(s, bytes([i])) for s in sorted(g)]) for i, g in enumerate(groups)]
    merged = list(suffixes.merge_runs(runs)) if runs else []
    assert [s for s, _, _ in merged] == sorted(s for g in groups for s in g)
    for (a, _, _), (b, shared, _) in zip(merged, merged[1:]):
        assert b[:shared] == a[:shared] and (len(a) == shared or len(b) == shared or a[shared] != b[shared])
    assert sorted(t for _, _, t in merged) == sorted(bytes([i]) for i, g in enumerate(groups) for _ in g)


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=120), st.integers(3, 12))
def test_anchors_split_all_windows(text, length):
    data = np.frombuffer(text.encode(), np.uint8)
    found = suffixes.anchors(data, length, max(1, length // 2))
    windows = [s + i for s, c in zip(found.start.tolist(), found.count.tolist()) for i in range(c)]
    assert windows == list(range(max(0, len(data) - length + 1)))
    gram = max(1, length // 2)
    for s, c, at in zip(found.start, found.count, found.at):
        assert s + c - 1 <= at <= s + length - gram


# --- sentences ---------------------------------------------------------------------


def spans_by_hand(rows, n, least):
    parts = {}
    for key, text in rows:
        cut = [(text[a:b], text[a:b].strip()) for a, b in spans.sentences(text)[0]] if text else []
        parts[key, text] = cut
    where = {}
    order = sorted(parts, key=lambda k: (k[0] is None, k[0] or 0))
    for k in order:
        plain = [p for _, p in parts[k]]
        runs = []
        for i in range(len(plain)):
            for j in range(i + n, len(plain) + 1):
                if sum(len(p.split()) for p in plain[i:j]) >= least:
                    runs.append((i, j, False))
                    break
        if runs and runs[-1][1] < len(plain):
            runs.append((runs[-1][0], len(plain), False))
        for i, j, whole in runs or [(0, len(plain), True)]:
            where.setdefault((whole, *plain[i:j]), []).append((k, i, j))
    gone = {}
    for places in where.values():
        for k, i, j in places[1:]:
            gone.setdefault(k, set()).update(range(i, j))
    return {
        k: (len(c), len(gone.get(k, ())), "".join(t for i, (t, _) in enumerate(c) if i not in gone.get(k, ())) if gone.get(k) else k[1])
        for k, c in parts.items()
    }


@pytest.mark.parametrize("least, removed", [(6, 20), (spans.LEAST_WORDS, 5)])
def test_spans_equal_brute_force(spark, least, removed):
    rng = random.Random(4)
    pool = [" ".join(rng.choice(["ab", "cd", "ef"]) for _ in range(rng.randint(1, 6))) + rng.choice(".!?") for _ in range(14)]
    rows = [(i, rng.choice(["", "\n"]) + rng.choice([" ", "\n"]).join(rng.choice(pool) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "  "), (53, "no end"), (None, rows[0][1] + " x.")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, kept string")
    got = spans.remove_repeated_spans(docs, least_words=least).collect()
    expected = spans_by_hand(rows, spans.SENTENCES, least)
    assert {(r.doc_id, r.text): (r.n_sentences, r.n_removed, r.kept) for r in got} == expected
    assert sum(n for _, n, _ in expected.values()) > removed


@settings(max_examples=100, deadline=None)
@given(st.text("ab. !\n", max_size=40))
def test_sentences_make_up_the_text(text):
    cuts, words = spans.sentences(text)
    assert "".join(text[a:b] for a, b in cuts) == ("" if text.isspace() else text)
    assert words == [len(text[a:b].split()) for a, b in cuts]


def test_long_sentences_are_cut_by_their_words_alone():
    rng = random.Random(5)
    passage = [rng.choice("abcdefgh") + str(rng.randrange(1000)) + ("," if rng.random() < 0.1 else "") for _ in range(300)]
    found = []
    for before, after in ("x " * 30, " y" * 40), ("z " * 7, ""):
        text = before + " ".join(passage) + after
        cuts, words = spans.sentences(text)
        assert max(words) < 60
        found.append([text[a:b].strip() for a, b in cuts])
    assert len(set(found[0]) & set(found[1])) >= min(map(len, found)) - 12
    assert len(spans.sentences("w " * 24)[0]) == 1


# --- helpers -------------------------------------------------------------------------


def test_connected_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 600)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == set(parent)
    pairs = {(find(x), got[x]) for x in parent}
    assert len(pairs) == len({p for p, _ in pairs}) == len({r for _, r in pairs})
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_long_runs_and_whole_short_texts_are_evidence(spark):
    long = lambda c, k=60: " ".join(f"{c}{i}" for i in range(k)) + "."
    rows = [
        (1, f"First here. {long('a')} Second here."), (2, f"Other words. {long('a')} Last of it."),  # one sentence
        (3, f"Up. {long('b', 30)} {long('c', 30)} Down."), (4, f"Left. {long('b', 30)} {long('c', 30)} Right."),  # two
        (5, "A short text of seven words here"), (6, "A short text of seven words here"), (7, "Tiny."), (8, "Tiny."),
        (9, "Two of them. It is so."), (10, "Two of them. It is so."), (11, "Tiny. Two of them. It is so."),
        (12, f"word {long('d', 70).rstrip('.')}"), (13, f"{long('d', 70).rstrip('.')} glued to more"),  # no end at all
        (14, long("e", 70).rstrip(".")), (15, long("e", 70).rstrip(".")), (15, long("e", 70).rstrip(".")),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in spans.remove_repeated_spans(docs).collect()}
    expected = {k[0]: v for k, v in spans_by_hand(rows, spans.SENTENCES, spans.LEAST_WORDS).items()}
    assert {i: (r.n_sentences, r.n_removed, r.kept) for i, r in got.items()} == expected
    left = {i: len(r.kept.split()) for i, r in got.items() if r.n_removed}
    assert {i: left[i] for i in (6, 8, 10, 15)} == {6: 0, 8: 0, 10: 0, 15: 0}
    # Of a passage with other words around it a sentence at either end may stay.
    assert set(left) == {2, 4, 6, 8, 10, 13, 15} and left[2] < 25 and left[4] < 22 and left[13] < 23


def test_spans_take_clashing_names_long_texts_and_no_rows(spark):
    names = ["who", "text_key", "runs", "key", "first", "at", "n", "_who", "_runs", "least"]
    ddl = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    rng = random.Random(8)
    body = " ".join(f"{rng.choice('abc')}{rng.randrange(50_000)}{rng.choice(['', '', '.'])}" for _ in range(400_000))
    rows = [(1, body), (2, "Own start of it. " + body), (3, None), (4, "")]
    got = spans.remove_repeated_spans(spark.createDataFrame([(*r, *names) for r in rows], ddl))
    assert got.columns == ["doc_id", "text", *names, "n_sentences", "n_removed", "kept"]
    kept = {r.doc_id: r for r in got.collect()}
    assert all(tuple(r)[2:-3] == tuple(names) for r in kept.values())
    assert kept[1].n_removed == 0 and kept[2].kept.startswith("Own start") and len(kept[2].kept) < 400
    assert (kept[3].kept, kept[4].kept) == (None, "")
    assert spans.remove_repeated_spans(spark.createDataFrame([], ddl)).collect() == []


def test_verifying_holds_few_copies_of_a_family():
    import tracemalloc

    sets = [np.arange(i * 4000, (i + 1) * 4000, dtype=np.uint64) for i in range(100)]
    tracemalloc.start()
    root = jaccard.verify(sets, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert root.tolist() == list(range(100))
    # Bytes for each of the shingles; the sets themselves aren't counted.
    assert peak < 36 * 400_000


def test_shingle_sets_come_one_by_one():
    texts = pa.array(["a b c d e"] * 3 + [None])
    sets = jaccard.each_shingle_set(texts, 4)
    assert len(next(sets)) == 2 and [len(s) for s in sets] == [2, 2, 0]
