"""Pieces, spans and texts against the sentencepiece library."""

import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.test_oracle import SF_DIR
from tidemark.llm import pieces as P
from tidemark.llm.queries import PIECES, op11_pieces

RAW = open(PIECES, "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=RAW)
MODEL = P.PieceModel(RAW)
TEXTS = [
    "", " ", "  a", "a ", "▁", "<s>x</s><unk>", "a\nb\tc\r\n", "\x00a", "ééé", "a  b   c", "�", "aé😀\U0001f9ffb  c ▁", "x" * 500,
    " " * 300, "é" * 250 + "\U0001f9ff" * 250, "a▁▁b", "The cat. " * 2000, "mot" * 90 + " " + "ab" * 140, "<0x41>", "ＡＢ①", "日本語テスト",
]


def library(text):
    found = LIBRARY.encode(text, return_type="proto").pieces
    return [(p.id, p.begin, p.end) for p in found]


def own(texts):
    return [list(zip(*(a.tolist() for a in done))) for done in MODEL.encode(texts)]


@pytest.mark.parametrize("long", [P.LONG, 4])
def test_pieces_and_spans_equal_the_library(monkeypatch, long):
    monkeypatch.setattr(P, "LONG", long)
    MODEL._known.clear()
    random.seed(11)
    alphabet = "ab éè ñ😀\U0001f9ff▁ the ing.\n\t1234"
    texts = TEXTS + ["".join(random.choices(alphabet, k=random.randrange(80))) for _ in range(400)]
    assert own(texts) == [library(t) for t in texts]
    MODEL._known.clear()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(text):
    assert own([text]) == [library(text)]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "nfkc", "identity"])
@pytest.mark.parametrize("collapse", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_normal_forms_and_sources_equal_the_library(rule, collapse, prefix):
    options = {"add_dummy_prefix": prefix, "remove_extra_whitespaces": collapse, "escape_whitespaces": True}
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, **options)
    spec = dict(P._fields(theirs.serialized_normalizer_spec()))
    ours = P.Normaliser(spec.get(2, b""), prefix, collapse)
    random.seed(5)
    alphabet = "a b  Áé ＡＢ①ﬁ½ 　 \t\n\x07​­가각가ß İ㍿ﷺͅ"
    texts = TEXTS + ["".join(random.choices(alphabet, k=random.randrange(30))) for _ in range(600)]
    for text in texts:
        norm, source = ours(text)
        want, offsets = theirs.normalize(text, with_offsets=True)
        assert norm == want
        # the library counts in characters
        place = [len(text.encode()[:b].decode()) for b in source.tolist()]
        assert not norm or place == list(offsets)


def test_documents_equal_the_library(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = op11_pieces(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        ids = LIBRARY.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(",".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(LIBRARY.decode(ids))


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, "", "y"), (None, "a b", "z"), (2, "a b", "z"), (2, "a b", "z"), (3, "word é😀 " * 100_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = P.encode_pieces(docs, PIECES)
    got = got.withColumn("text", P.decode_pieces(got["ids"], PIECES, spark)).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted((str(i), t or "") for i, t, _ in rows)
    for r in got:
        source = r["text"].encode()
        assert b"".join(source[a:b] for a, b in zip(r["starts"], r["ends"])) == source
    assert P.encode_pieces(docs.where("false"), PIECES).count() == 0


def test_other_kinds_of_models_are_refused():
    with pytest.raises(ValueError, match="BPE"):
        P.PieceModel(RAW + b"\x12\x02\x18\x01")
