"""The Merkle manifest against a plain one."""

import hashlib
import zlib

import pytest

from bronzeway.llm import merkle
from bronzeway.llm.queries import QUERIES, tampered_manifest

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    key, text, lang, source, n_chars = row
    n_chars = None if n_chars is None else n_chars + more
    return h(*(field(v) for v in (key, source, lang, n_chars, text)))


def tree(leaves):
    """(root, siblings of each leaf with their side)."""
    nodes, of = list(leaves), [[i] for i in range(len(leaves))]
    proofs = [[] for _ in leaves]
    while len(nodes) > 1:
        merged, members = [], []
        for i in range(0, len(nodes), 2):
            pair = nodes[i : i + 2]
            for side, me in enumerate(range(i, i + len(pair))):
                for x in of[me]:
                    proofs[x].append((1 - side, pair[1 - side]) if len(pair) == 2 else None)
            merged.append(h(*pair))
            members.append([x for me in range(i, i + len(pair)) for x in of[me]])
        nodes, of = merged, members
    return nodes[0], proofs


def by_hand(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    groups = [
        sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for lang in langs
    ]
    trees = [tree([leaf(r) for r in g]) for g in groups]
    root, above = tree([t[0] for t in trees])
    out = []
    for (subroot, proofs), group, last in zip(trees, groups, above):
        for row, proof in zip(group, proofs):
            proof = proof + last
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            fold = leaf(row, int(hit))
            for step in proof:
                fold = h(fold) if step is None else h(fold, step[1]) if step[0] else h(step[1], fold)
            siblings = h(*(s[1] for s in proof if s))
            out.append((row[0], leaf(row), subroot, root, siblings, fold, fold == root))
    return sorted(map(repr, out))


def manifest(spark, rows, ddl=DDL):
    got = tampered_manifest(spark.createDataFrame(rows, ddl))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(repr(tuple(r)) for r in got.collect())


ODD = [
    (None, None, None, None, None),
    (None, "a", None, "s", 1),
    (3, "", "en", "", 0),
    (3, None, "en", None, None),
    (3, "ü" * 3, "en", "s", 3),
    (3, "ü" * 3, "en", "s", 3),
    (7, "x", "é", "s", 1),
    (8, "x", "z", "s", 1),
    (-2, "long " * 600_000, "zz", "s", 3_000_000),
]


def test_odd_rows(spark):
    assert manifest(spark, ODD) == by_hand(ODD)
    assert manifest(spark, []) == []
    assert manifest(spark, ODD[3:4]) == by_hand(ODD[3:4])
    assert manifest(spark, ODD[4:6]) == by_hand(ODD[4:6])


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_blocks_of_any_height(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = [(i % 37, str(i), f"l{i % 5 if i % 3 else 0}", "s", i) for i in range(150)]
    assert manifest(spark, rows) == by_hand(rows)


def test_ancestors_are_joined_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SENT_BYTES", 0)
    rows = [(i, str(i), "en", "s", i) for i in range(70)] + [(1, "a", "de", "s", 1)]
    assert manifest(spark, rows) == by_hand(rows)


def test_clashing_names_do_not_matter(spark):
    names = ["leaf", "tree", "at", "pos", "digest", "group", "id", "key", "up", "steps", "of", "depth", "_carry0"]
    ddl = DDL + "".join(f", `{n}` int" for n in names)
    rows = [r + (1,) * len(names) for r in ODD[2:7]]
    assert manifest(spark, rows, ddl) == by_hand(ODD[2:7])


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*(c.split()[0] for c in DDL.split(", "))).collect()]
    got = QUERIES["op11_merkle_manifest"](spark, sf).collect()
    assert sorted(repr(tuple(r)) for r in got) == by_hand(rows)
    assert 0 < sum(not r.verified for r in got) < len(got) / 3
