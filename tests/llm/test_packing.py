import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, pre_tokenizers

from tests.test_oracle import SF_DIR
from tidemark.llm import packing
from tidemark.llm.packing import WordIds, lengths_of, pack_pow2, write_buckets

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "a", "don't I'LL\tgo\n\nnow", "x" * 30_000, "é ́e ́", "nbsp here wide",
    "\x1c\x1d\x85 sep", "<|endoftext|> a<|startoftext|>b", "12 345 ***", "O'NEILL's 'S we'll! x'section ab!!'s <|x|>. É! é' ǅ. ʰ. \u0345. a\u0301. Σς. ΑΣ' 1. 2's <|endoftext|>. x<|endoftext|>y|> K. ſ!", "İstanbul ﬁ", "e ̧́x", "東京 と",
]


def test_equals_the_tokenizer_on_whole_texts(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(None, "", 1), (3, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    real = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("doc_id + 1000 as doc_id", "text", "1 as length")
    docs = docs.union(real)
    tokenizer = Tokenizer.from_file(FILE)
    want = sorted(
        np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        for r in docs.collect()
    )
    got, sequences = defaultdict(dict), set()
    for r in pack_pow2(docs, FILE).collect():
        assert r["length"] == 2 ** r["bucket"] <= 4096 and 4 * r["length"] == len(r["ids"]) and r["offset"] == 0
        sequences.add(r["sequence_id"])
        got[r["sequence_id"] if r["doc_id"] in (None, 3) else r["doc_id"]][r["start"]] = bytes(r["ids"])
    assert len(sequences) == sum(map(len, got.values()))
    assert sorted(b"".join(v for _, v in sorted(d.items())) for d in got.values()) == want


def test_lengths():
    assert lengths_of(4096 * 2 + 13, 4096) == [4096, 4096, 8, 4, 1]
    assert lengths_of(1, 4096) == [1]


def test_buckets_and_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e f g")], "doc_id long, text string")
    write_buckets(pack_pow2(docs, FILE), f"{tmp_path}/b")
    assert sorted(p.name for p in (tmp_path / "b").glob("length=*")) == ["length=1", "length=4"]
    assert pack_pow2(docs.where("doc_id > 9"), FILE).count() == 0
    crc = pack_pow2(docs, FILE).selectExpr("crc32(ids) c", "ids").first()
    assert crc["c"] == zlib.crc32(bytes(crc["ids"]))


def test_words_of_letters_go_to_the_model_at_once(monkeypatch):
    """And forgetting them changes no ids."""
    tokenizer, rng = Tokenizer.from_file(FILE), np.random.default_rng(3)
    latin = [c for c in map(chr, range(ord(packing.LATIN) + 1)) if c.isalpha() and c != "İ" and c.lower() <= packing.LATIN]
    words = ["", *latin, "".join(latin), *("".join(rng.choice(latin, n)) for n in rng.integers(1, 30, 300))]
    words += ["Straße.", "ÜBUNG", 'LE!?"', "Éà.", "señor"]
    want = {w: np.array(tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in [*words, *ODD[3:]]}

    encoder, whole = WordIds(FILE), []
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda w: whole.append(w) or encode(w))
    assert {w: encoder[w] for w in words} == {w: want[w] for w in words}
    assert set(whole) == {".", "!?\""}

    monkeypatch.setattr(packing, "KNOWN_WORDS", 3)
    assert {t: encoder.ids(packing.words_of(t)) for t in want} == want
    assert len(encoder) <= 3


def test_letters_that_a_tokenizer_parts_are_none():
    """Then, and where other special tokens may stand among letters, every word is encoded whole."""
    for change in (
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.Sequence([pre_tokenizers.Split("b", "isolated"), t.pre_tokenizer])),
        lambda t: t.add_special_tokens(["bc"]),
        lambda t: setattr(t, "normalizer", None),
    ):
        tokenizer = Tokenizer.from_file(FILE)
        assert packing.letters_of(tokenizer)
        change(tokenizer)
        assert packing.letters_of(tokenizer) == {}
