"""The pipeline against a plain one, and each stage's columns."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.test_secret_ledger import plain as plain_spans
from tests.llm.test_simhash import near, plain_components, plain_fingerprint
from tests.test_oracle import SF_DIR
from tidemark.llm.packing import lengths_of
from tidemark.llm.queries import TOKENIZER, op7_quality
from tidemark.llm.shared import stage


def redacted(text):
    out, at = "", 0
    for span in filter(None, plain_spans(text).split(",")):
        _, s, e = span.split(":")
        if int(s) >= at:
            out += text[at : int(s)] + "[secret]"
        at = max(at, int(e))
    return out + text[at:] if text is not None else None


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def mixed(docs):
    """(doc_id, text) of the mix; no size is zero here and no document repeats."""
    by = defaultdict(list)
    for d in docs:
        by[d["source"]].append(d)
    names = sorted(by, key=lambda s: (s is None, s))
    size = {s: sum(len(d["text"].split()) for d in by[s]) for s in names}
    weight = {s: 1 + n % 3 for n, s in enumerate(names)}
    target, free, water = {}, set(names), sum(size.values())
    while True:
        level = water / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * size[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * size[s]
            water -= target[s]
            free.remove(s)
    target |= {s: level * weight[s] for s in free}
    out = []
    for s in names:
        copies = int(target[s]) // size[s]
        left = int(target[s]) - copies * size[s]
        for d in sorted(by[s], key=lambda d: md5(f"6:{d['doc_id']}:{md5(d['text'])}")):
            words = d["text"].split()
            out += [(d["doc_id"], d["text"])] * copies
            if left >= len(words):
                out.append((d["doc_id"], d["text"]))
            elif left > 0:
                out.append((d["doc_id"], " ".join(words[:left])))
            left = max(0, left - len(words))
    return out


def test_run_equals_a_plain_pipeline(spark):
    docs = {r["doc_id"]: r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    good = {r["doc_id"] for r in op7_quality(spark, SF_DIR).collect() if r["score"] >= 0.3}
    prints = {i: plain_fingerprint(docs[i]["text"]) for i in good}
    nodes = sorted(set(prints.values()))
    parts = plain_components(nodes, [(nodes[i], nodes[j]) for i, j in near(nodes, 3)])
    low = {}
    for i, p in prints.items():
        low[parts[p]] = min(i, low.get(parts[p], i))
    kept = [docs[i] | {"text": redacted(docs[i]["text"])} for i in low.values()]
    tokenizer, want = Tokenizer.from_file(TOKENIZER), Counter()
    for doc_id, text in mixed(kept):
        ids, start = [*tokenizer.encode(text, add_special_tokens=False).ids, 2], 0
        for n in lengths_of(len(ids), 4096):
            want[doc_id, start, np.array(ids[start : start + n], "<u4").tobytes()] += 1
            start += n
    got = Counter((r["doc_id"], r["start"], bytes(r["ids"])) for r in P.run(spark, SF_DIR).collect())
    assert got == want


def test_stages_keep_the_columns_and_odd_rows(spark):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "password=12345678 " * 3, None, "a", 1),
            (3, "a b c d e f", "en", None, 11), (3, "a b c d e f", "en", None, 11), (4, "x " * 90_000, "de", "b", 5)]
    docs = stage(spark.createDataFrame(rows, schema))
    for name, apply in P.STAGES:
        out = stage(apply(spark, docs, SF_DIR))
        if name != "pack":
            assert out.columns == docs.columns
        apply(spark, docs.where("false"), SF_DIR).collect()
        docs = out if name != "quality" else docs
    assert docs.count() > 0
    spans = P.redact_secrets(spark, spark.createDataFrame(rows, schema), SF_DIR).where("doc_id is null").first()
    assert spans["text"] == "[secret] " * 3 and spans["n_chars"] == 27


def test_stages():
    assert [name for name, _ in P.STAGES] == ["quality", "near_dedup", "secrets", "mix", "pack"]
