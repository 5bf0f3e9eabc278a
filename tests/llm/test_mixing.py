from tidemark.llm.mixing import mix_sources, repeat_documents

SCHEMA = "doc_id long, text string, source string, size string, weight int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "old", 9) for i, t, s in rows], SCHEMA)


def words(n):
    return " \t".join(["w"] * n)


def test_targets_copies_and_edges(spark):
    rows = [(i, words(10), "a") for i in range(50)] + [(100 + i, words(7), "b") for i in range(10)]
    rows += [(200, words(5), None), (None, words(5), None), (201, None, "c"), (202, " \n", "c")]
    got = mix_sources(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["source"], []).append(r)
        assert r["taken"] == r["copies"] * r["size"] + r["part"] <= 3 * r["size"]
        assert r["weight"] == 9
    # b and NULL are full at three times their words, c has none, a takes the rest
    assert by["b"][0]["target"] == 210 and by[None][0]["target"] == 30 and by["c"][0]["target"] == 0
    assert by["a"][0]["target"] == 580 - 240
    for own in by.values():
        assert sum(r["taken"] for r in own) == int(own[0]["target"])


def test_repeated_rows_share_and_reruns_agree(spark):
    rows = [(1, words(10), "a")] * 7 + [(2, words(50), "b")] * 3 + [(i, words(3), "c") for i in range(9)]
    first = sorted(mix_sources(docs(spark, rows)).collect(), key=str)
    again = sorted(mix_sources(docs(spark, rows[::-1])).repartition(3).collect(), key=str)
    assert first == again
    for s in "abc":
        own = [r for r in first if r["source"] == s]
        assert 0 <= own[0]["target"] - sum(r["taken"] for r in own) < len(own) + 1


def test_repetitions_are_rows(spark):
    rows = [(i, words(4 + i % 5), "ab"[i % 2]) for i in range(40)]
    mixed = mix_sources(docs(spark, rows))
    out = repeat_documents(mixed).collect()
    taken = sum(r["taken"] for r in mixed.collect())
    assert sum(len((r["text"] or "").split()) for r in out) == taken


def test_empty(spark):
    assert mix_sources(docs(spark, [])).count() == 0


def test_columns_named_like_internal_ones_pass_through(spark):
    rows = [(i, "a b c d", "s" if i % 2 else None, 7, "k", i, i, "n") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra long, _key string, _edge long, _source long, cap string")
    mixed = mix_sources(docs)
    assert mixed.columns[:8] == docs.columns
    assert sorted(tuple(r)[:8] for r in mixed.collect()) == sorted(rows, key=lambda r: r[0])
