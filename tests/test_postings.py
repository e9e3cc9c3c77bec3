"""The inverted index against the scan of all chunks, and its versions against an index made anew."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from findery.functions.text import token_codes
from findery.operators import postings, retrieval

SHAPE = "ord long, chunk_id string, issuer string, text string"
WORDS = ["서버", "구축", "보안", "네트워크", "사업", "예산", "abc", "de", "f", "운영", "유지보수", "클라우드"]


def made(seed, n, first=0):
    rng = random.Random(seed)
    rows = [(first + i, f"c{first + i}", rng.choice(["가", "나", "다", None]), " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 40)))) for i in range(n)]
    return rows + [(first + n, f"c{first + n}", "가", None), (first + n + 1, f"c{first + n + 1}", "나", "!!")]


def asked(spark, n=25, seed=9):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 6))), rng.sample(["가", "나", " 다 ", "라", ""], rng.randrange(0, 4))) for i in range(n)]
    return spark.createDataFrame(rows + [(n, None, ["가"]), (n + 1, "서버", None)], "question_id long, question string, issuers array<string>")


def table(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def found(chunks, questions, **how):
    return sorted(map(tuple, retrieval.sparse_search(chunks, questions, 5, **how).collect()))


@pytest.mark.parametrize("few", [0, 10_000])
def test_equal_to_the_scan(spark, monkeypatch, few):
    monkeypatch.setattr(postings, "FEW", few)
    chunks, questions = table(spark, made(1, 300)).repartition(3), asked(spark)
    index = postings.build(chunks, shards=4, block=8)
    told = {name: spark.sparkContext.accumulator(0) for name in ("blocks", "scored")}
    assert found(chunks, questions, index=index, told=told) == found(chunks, questions)
    assert index.shards == 4 and 0 < told["scored"].value < told["blocks"].value


def test_bounds_hold_and_blocks_are_skipped():
    """A block whose bound is below the k-th best is left out, and nothing with it."""
    rng = np.random.default_rng(1)
    made = []
    for _ in range(400):
        t = np.unique(rng.zipf(1.4, rng.integers(1, 60)).astype(np.uint64))
        made.append((t, rng.integers(1, 5, len(t))))
    head, lists = postings._invert(0, "x", list(range(400)), [str(i) for i in range(400)], made, 16)
    (_, ords, _, shard), *_ = postings._shard((0, "x"), [head, lists], 16)
    skipped = 0
    for _ in range(60):
        tokens = np.unique(rng.zipf(1.4, 6).astype(np.uint64))
        times = rng.integers(1, 3, len(tokens)).astype(float)
        own = dict(zip(tokens.tolist(), times.tolist(), strict=True))
        every = sorted(((sum(min(own.get(a, 0), b) for a, b in zip(t.tolist(), n.tolist(), strict=True)) / np.sqrt(len(t)), -i) for i, (t, n) in enumerate(made)), reverse=True)[:7]
        at, score, scored, there = shard.scores(tokens, times, -np.inf, 7)
        assert sorted(zip(score.tolist(), (-ords[at]).tolist(), strict=True), reverse=True)[:7] == [x for x in every if x[0] > 0]
        skipped += there - scored
    assert skipped > 0


def test_rows_read_fall_with_selective_tokens(spark):
    rows = [(i, f"c{i}", "가", f"서버 own{i:05}") for i in range(3000)]
    index = postings.build(table(spark, rows), shards=4)
    read = lambda text: postings.wanted(index, ["가"], token_codes(text)).count()
    every = index.rows().count()
    assert read("own00042") < every // 50 and read("zzz") == 4  # what shards are made of, alone
    pushed = postings.wanted(index, ["가"], token_codes("서버"))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(token," in pushed and "EqualTo(issuer," in pushed
    assert postings.wanted(index, [], token_codes("서버")).count() == 0


def test_more_shards_than_tasks_of_their_own_numbers(spark):
    index = postings.build(table(spark, made(3, 200)), shards=16)
    heads = index.rows().filter("ords IS NOT NULL").groupBy("shard", "issuer").count().collect()
    assert all(r["count"] == 1 for r in heads) and len({r["shard"] for r in heads}) > 8


def changed(spark, rows):
    return spark.createDataFrame(rows, SHAPE + ", gone boolean")


def test_changes_between_questions_equal_a_fresh_index(spark, tmp_path):
    rows = {r[0]: r for r in made(4, 120)}
    questions = asked(spark)
    first = postings.build(table(spark, list(rows.values())), str(tmp_path / "ix"), shards=3)
    before, index = found(table(spark, list(rows.values())), questions), first
    rng = random.Random(5)
    for step in range(1, 5):
        changes = [(o, f"c{o}", rng.choice(["가", "나"]), " ".join(rng.choice(WORDS) for _ in range(12)), None) for o in rng.sample(sorted(rows), 15)]
        changes += [(1000 * step + i, f"n{step}-{i}", "다", "서버 구축 " * (i + 1), False) for i in range(5)]
        changes += [(o, None, None, None, True) for o in rng.sample(sorted(set(rows) - {c[0] for c in changes}), 10)] + [(None, "x", "가", "서버", False), (10**9, None, None, None, True)]
        index = postings.update(index, changed(spark, changes), most_parts=3, most_dead=0.9)
        for c in changes:
            if c[0] is not None:
                rows.pop(c[0], None)
                if not c[4]:
                    rows[c[0]] = c[:4]
        assert index.version == step + 1
        assert found(table(spark, list(rows.values())), questions, index=index) == found(table(spark, list(rows.values())), questions)
        assert len(index.parts) <= 3
    assert found(None, questions, index=postings.load(spark, str(tmp_path / "ix"), 1)) == before == found(None, questions, index=first)
    assert postings.versions(spark, str(tmp_path / "ix")) == [1, 2, 3, 4, 5]


def test_the_dead_are_compacted(spark, tmp_path):
    rows = made(6, 60)
    index = postings.build(table(spark, rows), str(tmp_path / "ix"))
    index = postings.update(index, changed(spark, [(o, None, None, None, True) for o in range(40)]))
    assert len(index.parts) == 1 and index.rows().filter("gone IS NOT NULL").count() == 0
    assert found(None, asked(spark), index=index) == found(table(spark, rows[40:]), asked(spark))


def test_a_failed_update_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "ix")
    index = postings.build(table(spark, made(7, 50)), path)
    before = found(None, asked(spark), index=index)
    bad = changed(spark, [(1, "c1", "가", "서버", False)]).withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        postings.update(index, bad)
    assert postings.versions(spark, path) == [1] and found(None, asked(spark), index=postings.load(spark, path)) == before
    fine = postings.update(postings.load(spark, path), changed(spark, [(1, "c1", "가", "서버", False)]))
    assert fine.version == 2
    with pytest.raises(Exception, match="v000000002"):  # a second writer of version 2
        postings.update(index, changed(spark, [(2, "c2", "가", "서버", False)]))
    with pytest.raises(ValueError, match="no version"):
        postings.load(spark, path, 7)


def test_empty_tables(spark):
    nothing = postings.build(table(spark, made(8, 10)).limit(0))
    assert nothing.shards == 0 and found(None, asked(spark), index=nothing) == []
    index = postings.update(nothing, changed(spark, [(1, "c1", "가", "서버 구축", False)]))
    assert [r[1] for r in found(None, spark.createDataFrame([(1, "서버", ["가"])], "question_id long, question string, issuers array<string>"), index=index)] == [1]
    assert found(None, asked(spark).limit(0), index=index) == []


def test_lists_are_kept_and_sent_without_their_bounds(spark):
    """Bounds are worked out where a shard is met: for each list and block the greatest worth and root of its entries."""
    rng = np.random.default_rng(2)
    size = np.sort(rng.integers(1, 50, 300)).astype(float)
    lists = [np.sort(rng.choice(300, n, replace=False)) for n in (1, 7, 64, 300)]
    count = rng.integers(1, 9, sum(map(len, lists))).astype(float)
    first = np.r_[0, np.cumsum([len(x) for x in lists])]
    block, most, root, begin = postings._bounds(np.concatenate(lists), count, first, size, 64)
    want = []
    for n, own in enumerate(lists):
        c = count[first[n] : first[n + 1]]
        want.append([(b, max(c[own // 64 == b] * (1 / np.sqrt(size[own[own // 64 == b]]))), max(1 / np.sqrt(size[own[own // 64 == b]]))) for b in sorted(set(own // 64))])
    assert [list(zip(block[i:j], most[i:j], root[i:j], strict=True)) for i, j in zip(begin[:-1], begin[1:], strict=True)] == want
    assert [len(x) for x in postings._bounds(np.zeros(0, int), np.zeros(0), np.zeros(1, int), np.zeros(0), 64)] == [0, 0, 0, 1]
    chunks = spark.createDataFrame([(1, "c1", "가", "abc abd")], "ord long, chunk_id string, issuer string, text string")
    assert {"most", "roots", "blocks"}.isdisjoint(postings.dealt(postings.build(chunks).rows()).columns)
