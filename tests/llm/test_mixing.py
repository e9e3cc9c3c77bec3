import heapq
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from findery.llm import mixing
from tests.compare import same
from tests.llm import brute

SMALL = "/root/testdata/sf0.01"


def test_query(spark):
    got = same(mixing.op4_mixing(spark, SMALL), mixing.ORACLE_SQL, SMALL)
    assert all(r["taken"] <= 2 * r["size"] for r in got)


def fill(sizes, weights):
    """Resharing step by step."""
    budget, capped = Fraction(3, 2) * sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = budget - sum(2 * sizes[i] for i in capped)
        share = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > 2 * sizes[i]}
        if not over:
            return [share.get(i, 2 * sizes[i]) for i in range(len(sizes))]
        capped |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, 10, 1000, 50000]) for _ in range(rng.randrange(1, 12))]
    names = [f"s{i:02}" for i in range(len(sizes) - 1)] + [None]
    rows = mixing.fill_targets(spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")).collect()
    got = {r["source"]: r["target"] for r in rows}
    want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))]) if sum(sizes) else [0] * len(sizes)
    assert [got[n] for n in names] == pytest.approx([float(x) for x in want])


def highest(votes, seats):
    out = [0] * len(votes)
    for _ in range(seats):
        i = max(range(len(votes)), key=lambda i: (votes[i] / (2 * out[i] + 1), -i))
        out[i] += 1
    return out


def test_apportion(spark):
    rng, rows, want = random.Random(1), [], {}
    for g in range(40):
        votes, seats = [rng.choice([0, 1, 3, 50, 1000]) * rng.random() for _ in range(rng.randrange(1, 9))], rng.randrange(0, 60)
        rows += [(g, i, v, seats) for i, v in enumerate(votes)]
        want |= {(g, i): n for i, n in enumerate(highest(votes, seats) if sum(votes) else [0] * len(votes))}
    df = spark.createDataFrame(rows, "g int, i int, v double, seats long")
    got = {(r["g"], r["i"]): r["n"] for r in mixing.apportion(df, ["g"], ["i"], "v", "seats", "n").collect()}
    assert got == want


def test_hard_rows(spark):
    rows = [(1, "a", 10), (1, "a", 10), (None, "a", 5), (2, None, 100), (3, None, 0), (4, "b", 0), (5, "c", 20000), (6, "", 7)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, size long, target string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    for source in {r["source"] for r in got}:
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= mixing.BLOCK
    again = mixing.mix(df.repartition(3)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert mixing.mix(df.limit(0)).count() == 0


def test_a_source_of_many_shards_comes_near_its_target(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "small").otherwise("large").alias("source"), (F.col("id") % 97).alias("size"))
    got = mixing.mix(df, shard_docs=256).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 64 * 25 for r in got)


def test_number_of_words(spark):
    texts = [None, "", " ", "a", " a\tb\n\nc ", "w w", "a\u00a0b c", "x\x0by\x0cz", "ww"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in rows.orderBy("i").select(mixing.n_words(F.col("t"))).collect()] == [len(brute.words(t)) for t in texts]


def test_rows_without_ids_are_spread_over_shards(spark):
    """20,000 rows of one source without an id, as many with one id: no shard has much more than its share, targets are met."""
    rows = spark.range(40000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).cast("long").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 97).alias("size"), F.col("id").cast("string").alias("text"))
    order = rows.select(mixing.shard_of(mixing.seeded(F.col("doc_id"), F.md5("text")), F.lit(10)).alias("shard")).groupBy("shard").count().collect()
    assert len(order) == 10 and max(r["count"] for r in order) < 4600
    got = mixing.mix(rows).agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).first()
    assert abs(got["taken"] - got["target"]) <= 64
    by_size = rows.select(mixing.shard_of(mixing.seeded(F.col("doc_id"), F.col("size")), F.lit(5)).alias("shard")).groupBy("shard").count().collect()
    assert len(by_size) == 5


def test_query_on_null_and_repeated_ids(spark, tmp_path):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("doc_id"), F.when(F.col("id") % 7 > 0, "s").alias("source"), F.concat(F.col("id").cast("string"), F.repeat(F.lit(" w"), (F.col("id") % 50).cast("int"))).alias("text"))
    rows.unionByName(rows.limit(20)).write.parquet(str(tmp_path / "documents.parquet"))
    same(mixing.op4_mixing(spark, str(tmp_path)), mixing.ORACLE_SQL, str(tmp_path))


def test_apportion_to_many_small_parties(spark):
    """Rounding is off by thousands of seats, and few of them are any one party's."""
    rng = random.Random(6)
    votes = [rng.choice([0.4, 0.6, 1.4, 1.6]) for _ in range(3000)] + [900.0, 2500.5]
    for seats in (sum(votes), 0.7 * sum(votes), 40):
        df = spark.createDataFrame([(0, i, float(v), int(seats)) for i, v in enumerate(votes)], "g int, i int, v double, seats long")
        got = {r["i"]: r["n"] for r in mixing.apportion(df, ["g"], ["i"], "v", "seats", "n").collect()}
        heap = [(-v, i, 0) for i, v in enumerate(votes)]
        heapq.heapify(heap)
        want = dict.fromkeys(range(len(votes)), 0)
        for _ in range(int(seats)):
            _, i, n = heapq.heappop(heap)
            want[i] += 1
            heapq.heappush(heap, (-votes[i] / (2 * n + 3), i, n + 1))
        assert got == want


def test_as_many_sources_as_documents(spark):
    df = spark.range(50_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("host"), "id").alias("source"), (F.col("id") % 97 + 1).alias("size"))
    got = mixing.mix(df).agg(F.sum("taken").alias("taken"), F.max(F.col("taken") / F.col("size")).alias("most"), F.count(F.lit(1)).alias("n")).first()
    assert got["n"] == 50_000 and got["most"] <= 2
