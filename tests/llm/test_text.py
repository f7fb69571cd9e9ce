"""Tokens, quality rules and licences."""

import math
from collections import Counter

import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from bronzeway.llm import licences, quality, spm

from .helpers import WORD

ORIGINAL = sentencepiece.SentencePieceProcessor(model_file=spm.MODEL)
MODEL = spm.read_model()
TEXTS = ["", " ", "Hello  world\n", "naïve café ▁ x", "日本語 🙂 \x00\x01", "<s> </s> <0x41> <unk>", "a" * 5000, "ab " * 4000, "\tx\r\n y"]


@pytest.mark.parametrize("by_word", [False, True])
def test_parity_with_the_original(by_word):
    ours = spm.build_tokenizer(MODEL, by_word)
    for text in TEXTS:
        ids = ours.encode(text, add_special_tokens=False).ids
        assert ids == ORIGINAL.encode(text)
        assert ours.decode(ids, skip_special_tokens=False) == ORIGINAL.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_parity_on_any_text(text):
    ours = spm._pipelines(MODEL, 1)[0]
    ids = ours.encode(text, add_special_tokens=False).ids
    assert ids == ORIGINAL.encode(text)
    assert ours.decode(ids, skip_special_tokens=False) == ORIGINAL.decode(ids)


def test_unigram_models_give_the_best_score():
    """The public pieces with scores by rank, as a unigram model; nothing is trained."""
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(MODEL)
    proto.trainer_spec.model_type = spm.UNIGRAM
    for i, p in enumerate(proto.pieces):
        if p.type == spm.NORMAL:
            p.score = -math.log(i + 2)
    model = proto.SerializeToString()
    theirs = sentencepiece.SentencePieceProcessor(model_proto=model)
    ours = spm.build_tokenizer(model)
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()
    same = 0
    for text in [*TEXTS[:6], *texts]:
        ids, expected = ours.encode(text, add_special_tokens=False).ids, theirs.encode(text)
        assert ours.decode(ids, skip_special_tokens=False) == theirs.decode(expected)
        # Pieces like '#' and '##' score the same in either order: which comes first is open.
        score = lambda found: sum(proto.pieces[i].score for i in found)
        assert ids == expected or score(ids) == pytest.approx(score(expected), abs=1e-3)
        same += ids == expected
    assert same >= 0.95 * len(texts)


def test_encode_all_rows(spark, monkeypatch):
    monkeypatch.setattr(spm, "SLICE_CHARS", 100)
    rows = [(i, t, "own") for i, t in enumerate([*TEXTS, None, "a", "a"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in spm.encode(docs, MODEL, verify_one_in=1).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        if t is None:
            assert (got[i].ids, got[i].decoded, got[i].parity) == (None, None, None)
        else:
            assert got[i].ids == ORIGINAL.encode(t) and got[i].parity
            assert got[i].decoded == t.replace("▁", " ")
    assert spm.encode(docs.limit(0), MODEL).collect() == []


def test_every_text_is_verified_by_default(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of many") for i in range(60)], "doc_id long, text string")
    assert {r.parity for r in spm.encode(docs, MODEL).collect()} == {True}


# --- quality ---------------------------------------------------------------------


def base_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


@settings(max_examples=300, deadline=None)
@given(st.text("ab #|\n\t\x0b\x85é", max_size=80))
def test_base_equals_plain_counts(text):
    assert quality.base_measures(text) == base_by_hand(text)


def test_quality_of_rows(spark):
    prose = "The committee will meet again on Thursday to discuss the results of the survey and plan further work."
    shout = " ".join(w.upper() + "!!" for w in "zqxv wkjh qqpz vvkx jjqz xxwv zzkq ppqj hhxz kkvw mmzx wwqj".split()) + " ZXQ!!"
    rows = [(1, prose, "en", 0), (2, None, "en", 0), (3, "", None, 0), (4, shout, "en", 0), (5, "x y " * 40, "en", 0), (6, prose, None, 0), (6, prose, "xx", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    got = quality.measure(docs).collect()
    assert len(got) == len(rows)
    kept = {r.doc_id: r.kept for r in got}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True}
    for r in got:
        assert tuple(r[c] for c in list(quality.MEASURES)[:6]) == base_by_hand(r.text)
    assert quality.measure(docs.limit(0)).collect() == []


def test_fertility_by_hand():
    encoding, spelled = quality._vocabularies(quality.read_model(quality.RANKS), MODEL)
    n, chars, share, spread = quality.fertility(encoding, spelled, "abc \U0001f642" * 3)
    assert n == len(encoding.encode_ordinary("abc \U0001f642" * 3)) and chars == 15 / n and 0 < spread <= 1
    assert 0 <= share <= 3 / 15
    assert quality.fertility(encoding, spelled, None) == (0, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("lang", ["en", "de", "fr", "es"])
def test_long_clean_texts_are_inside_the_bands(lang):
    encoding, spelled = quality._vocabularies(quality.read_model(quality.RANKS), MODEL)
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text", "lang"]).to_pylist()
    clean = [r["text"] for r in table if r["lang"] == lang and r["text"] and not quality.base_measures(r["text"])[-1]]
    joined = "\n".join(t for t in clean if quality.judge(t, lang, *quality.fertility(encoding, spelled, t)))
    joined *= -(-4_000_000 // len(joined))
    for size in (10_000, 100_000, 300_000, 1_000_000, 4_000_000):
        assert quality.judge(joined[:size], lang, *quality.fertility(encoding, spelled, joined[:size]))


def test_a_long_real_document_is_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id = 634")
    row = quality.measure(docs).first()
    assert row.n_tokens > 40_000 and row.kept


def test_few_kinds_of_tokens_are_outside_of_the_bands():
    encoding, spelled = quality._vocabularies(quality.read_model(quality.RANKS), MODEL)
    for size in (100, 10_000):
        dull = "the of and to in " * size
        assert not quality.judge(dull, "en", *quality.fertility(encoding, spelled, dull))


def test_scripts():
    assert [quality.script_of(t) for t in ("abc é", "привет a", "αβγ a", "日本語 a", "123", "")] == [
        "latin", "cyrillic", "greek", "other", "other", "other",
    ]


# --- licences ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    return licences.train(docs)


def test_held_out_accuracy(model):
    assert model.accuracy > 0.97


def test_scan_of_rows(spark, model):
    plain = "It was a long walk to the river and back.\n\nNobody spoke of it again."
    rows = [
        (1, plain), (2, f"{plain}\nReleased under the MIT License.\n"), (3, None), (4, ""), (5, " \n "),
        (6, "Licensed under the Apache License, Version 2.0.\nThis work is licensed under the GNU General Public License, version 2."),
        (7, "Licensed under the Frobnitz Group Licence, see the license file for terms of use"), (7, plain),
    ]
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, licences string")
    got = licences.scan(docs, model).collect()
    found = {r.doc_id: [(x.paragraph, x.family) for x in r.licences] for r in got if r.text != plain or r.doc_id == 1}
    assert found == {
        1: [], 2: [(2, "mit")], 3: [], 4: [], 5: [], 6: [(0, "apache"), (1, "gpl")], 7: [(0, "unknown")],
    }
    assert all(0.5 <= x.probability <= 1 for r in got for x in r.licences if x.family not in ("unknown", "none"))
    assert licences.scan(docs.limit(0), model).collect() == []


MIT = """MIT License

Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software.
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:

1. Some.
"""


def test_wrapped_notices_are_found(spark, model):
    plain = "It was a long walk\nto the river and back."
    rows = [("mit", MIT), ("apache", APACHE), ("bsd", BSD), ("mit", f"{plain}\n\n{MIT}\n{plain}"), ("bsd", f"{plain}\n\n{BSD}"), ("", plain)]
    docs = spark.createDataFrame(rows, "family string, text string")
    for r in licences.scan(docs, model).collect():
        found = [x.family for x in r.licences if x.family != "unknown"]
        assert set(found) == ({r.family} if r.family else set()), r
    at = licences.scan(docs.filter("text like 'It was%Redistribution%'"), model).first().licences
    assert [(x.paragraph, x.family) for x in at if x.family == "bsd"] == [(2, "bsd")]


def test_scan_uses_no_python_workers(spark, model):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = licences.scan(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_template_is_found(spark, model):
    rows = [(f, t) for f, ts in licences.TEMPLATES.items() for t in ts]
    docs = spark.createDataFrame(rows, "family string, text string")
    got = licences.scan(docs, model).select("family", F.transform("licences", lambda x: x["family"]).alias("found"))
    wrong = [r for r in got.collect() if r.found != [r.family]]
    assert len(wrong) <= 3, wrong


def test_marking_spaces_by_hand_gives_the_same_ids():
    """The public model's normaliser only marks spaces, so the library's needn't run."""
    model = spm.read_model()
    plain, words = spm.build_tokenizer(model), spm.build_tokenizer(model, by_word=True)
    quick, quick_words, _ = spm._pipelines(model, 1)
    assert isinstance(quick, spm._Plain) and quick.tokenizer.normalizer is None
    texts = ["", " ", "  a", "a  b ", "▁", "▁ a▁▁ b", "Ação\n\té", "\U0001f600​ x", "a b"]
    ids = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert quick.encode(texts) == ids == quick_words.encode(texts)
    assert [e.ids for e in words.encode_batch(texts, add_special_tokens=False)] == ids
    assert quick.decode(ids) == plain.decode_batch(ids, skip_special_tokens=False)
