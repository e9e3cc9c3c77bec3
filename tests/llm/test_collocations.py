import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from findery.llm import collocations as c
from tests.compare import same
from tests.llm.brute import ASCII_LOWER

SMALL = "/root/testdata/sf0.001"


def pieces(text):
    own = "".join("\n" if x in ".,;:!?\n\x0b\x0c\r" else x for x in (text or "").translate(ASCII_LOWER)).split("\n")
    return [[w for w in p.replace("\t", " ").split(" ") if w] for p in own]


def brute(rows, least, longest=3, cover=50, top=2000):
    f = defaultdict(Counter)
    for text, lang in rows:
        for p in pieces(text):
            for k in range(1, longest + 1):
                f[lang or "und" if lang is None else lang].update(tuple(p[i : i + k]) for i in range(len(p) - k + 1))
    out = []
    for lang, n in f.items():
        own = []
        total = sum(v for k, v in n.items() if len(k) == 1)
        for w, a in n.items():
            if len(w) < 2 or a < least:
                continue
            inside = lambda x: any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))  # noqa: B023, E731
            if any(len(x) > len(w) and v >= least and 100 * v >= cover * a and inside(x) for x, v in n.items()):
                continue
            score, k = min((10**6 * a * a // (n[w[:k]] * n[w[k:]]), k) for k in range(1, len(w)))
            own.append((-score, -a, " ".join(w).encode(), a, n[w[:k]], n[w[k:]], score))
        out += [(lang, i + 1, x[2].decode(), *x[3:6], total, x[6]) for i, x in enumerate(sorted(own)[:top])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(1, t, g, 0, "x") for t, g in rows], "doc_id long, text string, lang string, n int, phrase string")


def made(seed, n=80):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "é", "É", "d d", "x"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r", "\x0b", "! "]) for _ in range(rng.randrange(0, 60)))
    rows = [(text(), rng.choice(["a", "b", None, "und", ""])) for _ in range(n)]
    return rows + [(None, "a"), ("", None), (" .. ", "b"), rows[0], rows[0]]


@pytest.mark.parametrize(("seed", "least", "longest"), [(1, 10, 3), (2, 3, 3), (3, 5, 2), (4, 4, 4)])
def test_against_all_phrases(spark, seed, least, longest, monkeypatch):
    monkeypatch.setattr(c, "BLOCK_BYTES", 500)
    rows = made(seed)
    got = c.mine(table(spark, rows).repartition(3), least=least, longest=longest)
    assert sorted(map(tuple, got.collect())) == brute(rows, least, longest)


def test_top_ranks_with_ties(spark):
    rows = made(5)
    got = c.mine(table(spark, rows), least=2, top=4, salts=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, top=4)


def test_a_full_filter_loses_nothing(spark, monkeypatch):
    """Where every phrase passes, all are counted."""
    rows = made(6)
    monkeypatch.setattr(c, "bit_filter", lambda phrases, names: np.full(1 << (c.FILTER_BITS - 6), (1 << 64) - 1, np.uint64))
    assert sorted(map(tuple, c.mine(table(spark, rows), least=5).collect())) == brute(rows, 5)


def test_words_that_share_a_hash_lead_to_another_seed(spark, monkeypatch):
    rows, plain = made(7), c._words
    weak = lambda seed: plain(seed) if seed else (lambda batches: (b.set_column(0, "h0", pa.array([1] * len(b), pa.int64())) for b in plain(0)(batches)))
    monkeypatch.setattr(c, "_words", weak)
    assert sorted(map(tuple, c.mine(table(spark, rows), least=5).collect())) == brute(rows, 5)


def test_lists_are_extended_by_merging_positions():
    p = c.postings(pa.array(["a b a b. a b c", "b c a"]), pa.array(["l", "l"]), 0)
    lists = c.grouped(p.number[:, None], p.position)
    words = p.word.to_pylist()
    assert {words[k[0]]: n for k, n in zip(lists.keys, lists.lengths(), strict=True)} == {"a": 4, "b": 4, "c": 2}
    two = c.extend(lists, p, np.ones(3, bool))
    assert {tuple(words[i] for i in k): n for k, n in zip(two.keys, two.lengths(), strict=True)} == {("a", "b"): 3, ("b", "a"): 1, ("b", "c"): 2, ("c", "a"): 1}
    three = c.extend(two, p, np.ones(3, bool))
    assert {" ".join(words[i] for i in k) for k in three.keys} == {"a b a", "b a b", "a b c", "b c a"}


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**13, 2 * 10**13, 3 * 10**13), (7, 7, 7), (10, 3000000, 40)], "a long, l long, r long")
    got = [r[0] for r in df.select(c.score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [10**6 * 10**26 // (6 * 10**26), 10**6, 0]


def test_query(spark):
    got = same(c.op11_collocations(spark, SMALL), c.ORACLE_SQL, SMALL)
    assert len({r["lang"] for r in got}) == 4


def test_no_rows(spark):
    df = table(spark, made(8))
    assert c.mine(df.limit(0)).count() == 0
    assert c.mine(df.filter("text IS NULL")).count() == 0
