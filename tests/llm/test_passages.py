import hashlib
import random

import pytest
from pyspark.sql import functions as F

from findery.llm import passages
from tests.compare import same
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"


def test_lengths_double():
    assert passages.lengths(13) == [7, 13]
    assert passages.lengths(50) == [7, 13, 25, 50]
    assert passages.lengths(7) == [7]
    for window in range(2, 200):
        sizes = passages.lengths(window)
        assert sizes[-1] == window and all(a < b <= 2 * a for a, b in zip(sizes, sizes[1:]))


@pytest.mark.parametrize(("seed", "window"), [(1, 13), (2, 13), (3, 5), (4, 30)])
def test_against_all_windows(spark, seed, window):
    rows = brute.corpus(random.Random(seed), 150)
    df = spark.createDataFrame([(i, *r, "c", 5) for i, r in enumerate(rows)], "row long, doc_id long, text string, kept string, n_words int").repartition(5)
    out = {r["row"]: r for r in passages.remove_repeats(df, window).collect()}
    assert len(out) == len(rows)
    for i, (w, gone) in enumerate(brute.removals(rows, window)):
        r = out[i]
        assert (r["n_words"], r["n_removed"]) == (len(w), sum(gone))
        left = [x for x, g in zip(w, gone, strict=True) if not g]
        assert r["kept"] == (" ".join(left) if any(gone) else rows[i][1])


def test_query(spark):
    got = same(passages.op5_substring_dedup(spark, SMALL), passages.ORACLE_SQL, SMALL)
    assert any(r["n_removed"] for r in got)


def test_digest_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a  b\n"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["kept"] for r in passages.remove_repeats(df, digest=True).collect()}
    assert got == {1: hashlib.sha256(b"a b").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}
    assert passages.remove_repeats(df.limit(0)).count() == 0


def test_a_passage_in_every_document(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit(passage + " own"), F.col("id").cast("string")).alias("text")).repartition(8)
    got = passages.remove_repeats(df).filter("n_removed > 0").collect()
    assert len(got) == 499 and all(r["n_removed"] == 20 and r["kept"] == f"own{r['doc_id']}" for r in got)
