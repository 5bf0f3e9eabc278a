import contextlib
import random
import re

import numpy as np
import pytest
import xxhash

from tests.helpers import shuffle_joins
from tests.test_oracle import SF_DIR
from tidemark.llm import simhash as S
from tidemark.llm.components import connected_components, star_edges


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near(values, radius):
    v = np.array(values, "u8")
    x = v[:, None] ^ v[None, :]
    d = np.unpackbits(x.view(np.uint8), axis=1).reshape(len(v), len(v), 64).sum(2)
    return {(i, j) for i, j in zip(*np.nonzero(d <= radius)) if i < j}


def clustered(n, seed):
    random.seed(seed)
    out = set()
    while len(out) < n:
        base = random.getrandbits(64)
        for _ in range(random.choice([1, 1, 5])):
            out.add(base)
            base ^= 1 << random.randrange(64) | 1 << random.randrange(64)
    return sorted(out)[:n]


def test_bit_sliced_pairs_equal_brute_force():
    values = clustered(700, 3)
    m = len(values)
    for radius in (0, 1, 2, 3, 4, 7):
        a, b = S.bit_sliced_pairs(np.array(values, "u8"), np.arange(m) + 1, np.full(m, m), radius)
        assert set(zip(a.tolist(), b.tolist())) == near(values, radius) and len(a) == len(near(values, radius))
    a, _ = S.bit_sliced_pairs(np.zeros(3, "u8"), np.array([1, 3, 3]), np.array([2, 3, 3]), 3)
    assert a.tolist() == [0]


def test_masks_miss_no_pair():
    random.seed(5)
    for count in (10, 10**7, 10**10, 10**13):
        masks = S.block_masks(count, 3)
        for _ in range(300):
            x = 0
            for _ in range(3):
                x |= 1 << random.randrange(64)
            assert any(x & m == 0 for m in masks)
    assert len(S.block_masks(10, 3)) == 4 < len(S.block_masks(10**10, 3))


def test_links_with_split_buckets(spark, monkeypatch):
    values = clustered(900, 8) + [(7 << 48) + i for i in range(0, 4000, 7)]
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = plain_components(signed, [(signed[i], signed[j]) for i, j in near(values, 3)])
    for chunk in (8192, 50):
        monkeypatch.setattr(S, "CHUNK", chunk)
        got = {r["node"]: r["component"] for r in connected_components(S.fingerprint_links(fps, 3)).collect()}
        assert {v: got.get(v, v) for v in signed} == want


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, n) for n in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(5, 5), (None, 3), (999, 900)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r["node"]: r["component"] for r in got}
    want = plain_components({n for e in edges if None not in e for n in e}, [e for e in edges if None not in e])
    assert got == {n: c for n, c in want.items() if n != c}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert star_edges(np.array([3, 1]), np.array([2, 2]), 5).tolist() == [0, 1, 1, 1, 4]


def test_documents_equal_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    text = rows[0][1]
    rows += [(9000 + i, t) for i, t in enumerate([None, "", "one", "Two WORDS", "two words", "é\x0bÉ\x1c a", text, text.upper()])]
    rows += [(None, "no id"), (None, text), (9001, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    prints = [plain_fingerprint(t) for _, t in rows]
    nodes = sorted(set(prints))
    parts = plain_components(nodes, [(nodes[i], nodes[j]) for i, j in near(nodes, 3)])
    low = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            low[parts[p]] = min(i, low.get(parts[p], i))
    want = sorted(((i, p, low.get(parts[p])) for (i, _), p in zip(rows, prints)), key=str)
    got = S.simhash_groups(docs).collect()
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=str) == want
    assert S.simhash_groups(docs.where("doc_id < -1")).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_one_row_of_each_group_is_kept(spark, broadcast):
    rows = [(r["doc_id"], r["text"], "x") for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    text = rows[0][1]
    rows += [(9000 + i, t, "x") for i, t in enumerate([None, "", "one", "Two WORDS", "two words"])]
    # rows that share an id, rows that are equal, rows without an id
    rows += [(9100, "alone among its kind", "y"), (9100, "another text than that", "z"), (9002, "one", "x"), (9002, "one", "x")]
    rows += [(9200, "equal in all but a column", None), (9200, "equal in all but a column", "b"), (None, "no id"[::-1], "x"), (None, text, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string")
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    nodes = sorted(set(prints))
    parts = plain_components(nodes, [(nodes[i], nodes[j]) for i, j in near(nodes, 3)])
    best = {}
    for r, p in zip(rows, prints):
        best.setdefault(parts[p], []).append(r)
    with contextlib.nullcontext() if broadcast else shuffle_joins(spark):
        kept = [tuple(r) for r in S.keep_one(docs).collect()]
    assert len(kept) == len(best)
    by_group = {parts[plain_fingerprint(r[1])]: r for r in kept}
    for group, members in best.items():
        low = min((r[0] is None, r[0] or 0) for r in members)
        assert by_group[group] in members and by_group[group][0] == (None if low[0] else low[1])
    assert S.keep_one(docs.where("false")).count() == 0
    # rows that share an id but no content are both there
    assert sum(r[0] == 9100 for r in kept) == 2
