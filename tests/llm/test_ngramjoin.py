import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from findery.llm import ngramjoin
from findery.llm.components import components
from tests.compare import same
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize(("seed", "group"), [(1, 256), (2, 2), (3, 3)])
def test_against_all_pairs(spark, seed, group):
    rows = brute.corpus(random.Random(seed), 160)
    got = ngramjoin.join_documents(table(spark, rows), group=group).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute.classes(rows)))


def test_query(spark):
    same(ngramjoin.op1_ngram_jaccard(spark, SMALL), ngramjoin.ORACLE_SQL, SMALL)


def test_empty_table_and_other_columns(spark):
    assert ngramjoin.join_documents(table(spark, [])).count() == 0
    rows = spark.createDataFrame([(1, "a b c", 7, "k"), (2, "A b  c", 8, None)], "doc_id long, text string, n long, key string")
    assert [r["component_id"] for r in ngramjoin.join_documents(rows).collect()] == [1, 1]


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(700):
        w = list(base)
        w[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = ngramjoin.join_documents(table(spark, rows), group=64)
    assert {r["component_id"] for r in got.collect()} == {0}


def test_trie_join_against_pairs():
    rng = random.Random(7)
    for _ in range(150):
        sets = []
        for _ in range(rng.randrange(2, 12)):
            s = set(rng.choice(sets)) if sets and rng.random() < 0.7 else set(rng.sample(range(60), rng.randrange(1, 30)))
            s ^= set(rng.sample(range(60), rng.randrange(0, 4)))
            sets.append(s or {1})
        extra = np.array([rng.randrange(0, 3) for _ in sets])  # shingles of their own, which are only counted
        sizes = np.array([len(s) for s in sets]) + extra
        rank = {t: rng.randrange(5) for t in range(60)}
        tokens = [np.array(sorted(s), dtype=np.uint64) for s in sets]
        links = ngramjoin.trie_join(tokens, [np.array([rank[int(t)] for t in x], np.uint8) for x in tokens], sizes, np.arange(len(sets)))
        label = list(range(len(sets)))

        def join(pairs, label):
            for a, b in pairs:
                old, new = label[a], label[b]
                label[:] = [new if x == old else x for x in label]
            return [label.index(x) for x in label]

        pairs = [(a, b) for a in range(len(sets)) for b in range(a) if ngramjoin.linked(len(sets[a] & sets[b]), sizes[a], sizes[b])]
        assert set(map(frozenset, links)) <= set(map(frozenset, pairs))
        assert join(links, list(label)) == join(pairs, list(label))


def test_components(spark):
    links = [(bytes([a]), bytes([b])) for a, b in [(9, 8), (8, 7), (7, 6), (6, 5), (1, 2), (3, 2), (4, 4), (20, 1)]]
    got = components(spark.createDataFrame(links, "a binary, b binary")).collect()
    assert {(r["node"][0], r["component"][0]) for r in got} == {(9, 5), (8, 5), (7, 5), (6, 5), (2, 1), (3, 1), (20, 1)}


@pytest.mark.parametrize("local", [1, 3, 1 << 18])
def test_components_by_rounds(spark, local):
    rng = random.Random(local)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(60, 90)] + [(200, i) for i in range(100, 130)]
    label = {x: x for p in pairs for x in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs], "a binary, b binary").repartition(3)
    got = {r["node"][0]: r["component"][0] for r in components(df, local).collect()}
    assert got == {x: y for x, y in label.items() if x != y}
    assert components(df.limit(0), local).count() == 0


def test_frequent_shingles_of_long_documents(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "LEAST_HOT", 20)
    shared = " ".join(f"s{i}" for i in range(50))
    docs = table(spark, [(d, shared + " " + " ".join(f"d{d}x{i}" for i in range(60_000))) for d in range(40)])
    hot, ranks = ngramjoin.frequent(docs, 5, ngramjoin.hot_count(40, 40 * 60_046))
    assert len(hot) == len(ranks) == 46 and (ranks == ngramjoin.rank_of(np.array([40]))[0]).all()


def test_frequent_shingles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "LEAST_HOT", 3)
    monkeypatch.setattr(ngramjoin, "SEEN", 2)
    rows = brute.corpus(random.Random(11), 160)
    got = ngramjoin.join_documents(table(spark, rows), group=4).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute.classes(rows)))


def test_bands_of_linked_sizes_are_neighbours(spark):
    rows = spark.range(1, 3000).select(F.col("id").alias("n"), ngramjoin.bands(F.col("id"))[0].alias("b")).collect()
    band = {r["n"]: r["b"] for r in rows}
    assert all(band[5 * n // 4] - band[n] <= 1 for n in range(1, 2399))


def test_unlike_documents_about_one_shingle_meet_by_size(spark):
    """Templated pages: one shared shingle, bodies of their own, of all sizes; some near copies among them."""
    rng, rows = random.Random(4), []
    for i in range(240):
        body = [f"b{i}x{k}" for k in range(5 + i // 4)]
        rows.append((i, " ".join(["a", "b", "c", "d", "e", *body])))
        if i % 40 == 0:
            rows.append((1000 + i, " ".join(["a", "b", "c", "d", "e", *body, "end"])))
    got = ngramjoin.join_documents(table(spark, rows), group=8).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute.classes(rows)))


def test_keep_one(spark):
    rows = [(3, "a b c d e f", "x"), (1, "A B c d e f", "y"), (1, "A B c d e f", "y"), (None, "a b c d e f", "n"), (None, "q", "n"), (5, "", "e"), (6, None, "e"), (7, "z", "s")]
    got = ngramjoin.keep_one(spark.createDataFrame(rows, "doc_id long, text string, hot string")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, [(1, "A B c d e f", "y"), (None, "q", "n"), (5, "", "e"), (6, None, "e"), (7, "z", "s")]))


def test_keep_one_of_rows_with_nested_maps(spark):
    rows = spark.createDataFrame([(1, "a b c d e f", [{"k": "v"}]), (2, "a b c d e f", None)], "doc_id long, text string, extra array<map<string,string>>")
    assert [r["doc_id"] for r in ngramjoin.keep_one(rows).collect()] == [1]
