import hashlib
import random

import numpy as np

from tests.test_oracle import SF_DIR
from tidemark.llm import syncmers as Y


def points(text):
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def chosen(text, k=Y.K, s=Y.S):
    """Closed syncmers one k-mer at a time, each hashed on its own."""
    out = []
    for i in range(len(text) - k + 1):
        where, what = Y.anchors(points(text[i : i + k]))
        out += [(i, int(h)) for _, h in zip(where, what)]
    return out


def test_anchors_equal_those_of_each_kmer_alone(monkeypatch):
    random.seed(1)
    text = "".join(random.choice("abc é😀") for _ in range(600)) + "aaaa" * 30
    for block in (1 << 16, 37):
        monkeypatch.setattr(Y, "BLOCK", block)
        where, what = Y.anchors(points(text))
        assert list(zip(where.tolist(), what.tolist())) == chosen(text)
    assert 0.1 < len(where) / len(text) < 0.5


def test_closed_means_smallest_at_an_edge():
    text, window = "the quick brown fox jumps over the lazy dog " * 3, Y.K - Y.S + 1
    inner = {}
    for i in range(len(text) - Y.S + 1):  # an s-mer's hash, as the operator makes it
        h = np.zeros(1, np.uint64)
        for c in text[i : i + Y.S]:
            h = h * Y._M1 + np.uint64(ord(c)) if h.any() else np.array([ord(c)], np.uint64)
        inner[i] = int(Y._mixed(h)[0])
    want = [i for i in range(len(text) - Y.K + 1)
            if min(inner[j] for j in range(i, i + window)) in (inner[i], inner[i + window - 1])]
    assert Y.anchors(points(text))[0].tolist() == want


def test_likeness():
    random.seed(3)
    words = ["".join(random.choice("etaoins") for _ in range(random.randint(2, 8))) for _ in range(900)]
    a, b = " ".join(random.choices(words, k=700)), " ".join(random.choices(words, k=700))
    assert Y.likeness(Y.sketch(a), Y.sketch(a)) == 1
    assert Y.likeness(Y.sketch(a), Y.sketch(b)) < 0.1
    assert Y.likeness(Y.sketch(a), Y.sketch("new " + a[:100] + "X" + a[100:])) > 0.85
    assert 0.2 < Y.likeness(Y.sketch(a), Y.sketch(Y.edited(a, b))) < 0.5
    # the same passages in another order match less
    third = len(a) // 3
    assert Y.likeness(Y.sketch(a), Y.sketch(a[2 * third :] + a[third : 2 * third] + a[:third])) < 0.6
    assert Y.likeness("", "") == 1 and Y.likeness("", Y.sketch(a)) == 0
    assert Y.sketch("ab" * 5000) == Y.sketch("ab" * 5000) and len(Y.sketch("short")) == 12


def plain(rows):
    keyed = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for n, (i, t) in enumerate(keyed):
        text, following = t or "", keyed[(n + 1) % len(keyed)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        p, q, r = Y.sketch(text), Y.sketch(new), Y.sketch(following)
        out.append((i, len(text), hashlib.sha256(new.encode()).hexdigest(), p, q, Y.likeness(p, q), Y.likeness(p, r)))
    return sorted(out, key=str)


def test_documents_equal_a_plain_loop(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows += [(-5, None), (-(2**62), "x"), (2**62 + 1, "é😀" * 40), (10**6, ""), (10**7, "a" * 200_000), (None, "last")]
    random.shuffle(rows)
    for some in (rows, rows[:1], rows[:2], [(None, None)]):
        docs = spark.createDataFrame([(i, t, 1) for i, t in some], "doc_id long, text string, range int")
        got = Y.fingerprint_documents(docs.repartition(5)).collect()
        assert sorted(map(tuple, got), key=str) == plain(some)
    assert Y.fingerprint_documents(docs.where("doc_id = 1")).count() == 0


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a" * 50), (1, "a" * 50), (2, "b" * 50), (1, "c" * 50)], "doc_id long, text string")
    got = Y.fingerprint_documents(docs).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 1, 1, 2]
    assert len({r["fingerprint"] for r in got}) == 3


def test_anchor_table(spark):
    docs = spark.createDataFrame([(1, "a text of more than sixteen points"), (None, "s"), (3, None)], "doc_id long, text string")
    got = Y.anchor_table(docs).collect()
    assert {r["doc_id"] for r in got} == {1, None} and sum(r["doc_id"] is None for r in got) == 1


def test_short_texts_without_a_syncmer_are_told_apart(spark):
    a, b = "Eser thed nt of.", "Thre er. And erhe."
    assert not len(Y.anchors(points(a))[0]) and not len(Y.anchors(points(b))[0])
    assert "" not in (Y.sketch(a), Y.sketch(b)) and Y.sketch(a) == Y.sketch(a)
    assert Y.likeness(Y.sketch(a), Y.sketch(b)) == 0 and Y.likeness(Y.sketch(a), "") == 0
    got = Y.anchor_table(spark.createDataFrame([(1, a), (2, b), (3, "")], "doc_id long, text string")).collect()
    assert [r["doc_id"] for r in got] == [1, 2] and got[0]["anchor"] != got[1]["anchor"]
