"""Held-out accuracy and edge cases of the two classifiers."""

import zlib

import numpy as np
import pytest

from tidemark.llm import features as X
from tidemark.llm import language as L
from tidemark.llm import quality as Q
from tidemark.llm.queries import op7_quality, op8_language

DIR = "/root/testdata/sf0.01"


def test_features_tell_words_and_places_apart():
    one = lambda t: X.word_buckets(X.code_points(t), 1 << 30).tolist()
    assert one("ab  ba\nab") == [one("ab")[0], one("ba")[0], one("ab")[0]] and one("ab") != one("ba")
    assert one("") == one(" \t\n") == [] and one(" x") == one("x ")
    grams = X.ngram_buckets(X.code_points("abcab"), 2, 1 << 30).tolist()
    assert grams[0] == grams[3] and len(set(grams)) == 3 and len(X.ngram_buckets(X.code_points("a"), 2, 9)) == 0


def test_quality_held_out(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    got = op7_quality(spark, DIR).collect()
    assert len(got) == spark.read.parquet(f"{DIR}/documents.parquet").count()
    hits = []
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
        if r["held_out"] and r["doc_id"] in labels:
            hits.append((labels[r["doc_id"]], r["predicted"]))
    for label in (0, 1):
        own = [p == label for y, p in hits if y == label]
        print("quality", label, len(own), np.mean(own))
        assert np.mean(own) >= 0.9


def test_language_held_out(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    got = op8_language(spark, DIR).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == len(langs) and all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in held)
    accuracy = np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held])
    print("language", len(held), accuracy, "rejected", sum(r["rejected"] for r in got))
    assert accuracy >= 0.97


ODD = [(1, None), (2, ""), (3, " \n"), (None, "good words here"), (1, "x" * 200_000), (5, "123 456"), (5, "123 456"), (6, "日本語 テキスト")]


@pytest.mark.parametrize("known", [[], [(100, 1)], [(100, 1), (101, 0), (102, None), (None, 1), (999, 0), (100, 1)]])
def test_quality_odd_rows(spark, known):
    rows = [*ODD, (100, "good words here and more"), (101, "BAD!! BAD!!")]
    docs = spark.createDataFrame([(i, t, 1.5) for i, t in rows], "doc_id long, text string, quality_score double")
    labels = spark.createDataFrame(known, "doc_id long, quality int")
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["quality_score"] <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r["text"] or "", set()).add(r["quality_score"])
    assert all(len(s) == 1 for s in by.values())
    if not known:
        assert by[""] == {0.5}
    if len(known) > 2:
        assert max(by["BAD!! BAD!!"]) < min(by["good words here"])
    assert Q.quality_scores(docs.where("doc_id < 0"), labels).count() == 0


def test_language_odd_rows(spark):
    learned = [(n, t, lang) for n, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("123", "xx"), (None, "yy"), ("der hund", None)])]
    learned = spark.createDataFrame(learned * 3, "doc_id long, text string, lang string")
    rows = [*ODD, (7, "the dog"), (8, "Le CHIEN et le chat")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, lang_pred int")
    got = L.language_scores(docs, learned).collect()
    assert len(got) == len(rows)
    for r in got:
        letters = bool(r["text"]) and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] in ("en", "fr")) == letters and (r["lang_pred"] == "und") != letters
        assert 0 <= r["lang_score"] <= 1
        if r["doc_id"] in (7, 8):
            assert r["lang_pred"] == ("en" if r["doc_id"] == 7 else "fr")
    far = {r["text"]: r["lang_pred"] for r in L.language_scores(docs, learned, reject=True).collect()}
    assert far["日本語 テキスト"] == "und" and far["the dog"] in ("en", "und")
    assert {r["lang_pred"] for r in L.language_scores(docs, learned.where("false")).collect()} == {"und"}
    assert L.language_scores(docs.where("doc_id < 0"), learned).count() == 0


def test_several_centroids():
    x = np.eye(6)[[0, 0, 1, 1, 2, 5]]
    c, own = L.clustered(x, L.Settings(centroids=4))
    assert len(c) == 4 and own[0] == own[1] and own[2] == own[3] and len(set(own)) == 4
    assert len(L.clustered(np.ones((5, 2)) / np.sqrt(2), L.Settings())[0]) == 1
