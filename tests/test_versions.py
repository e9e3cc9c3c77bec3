"""Tables that follow changes, against the rows that a plain program keeps."""

import random

import pytest
from pyspark.sql import functions as F

from findery.operators import fusion
from findery.plans import hybrid
from findery.sources import versions
from tests.test_retrieval import make_chunks, make_questions

SHAPE = "ord long, issuer string, v string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("by", [None, "issuer"])
def test_changes_equal_the_rows_themselves(spark, tmp_path, by):
    rng, path = random.Random(1), str(tmp_path / "t")
    own = {i: [(i, rng.choice(["가", "나/ x", None]), f"v{i}")] for i in range(40)}
    own[3].append((3, "다", "second"))
    flat = lambda: sorted((r for rs in own.values() for r in rs), key=repr)
    table = first = versions.create(spark.createDataFrame([*flat(), (None, "가", "x")], SHAPE), path, by)
    began = flat()
    for step in range(5):
        changed = {o: [(o, rng.choice(["가", "라"]), f"s{step}-{o}")] for o in [*rng.sample(sorted(own), 6), 100 + step]}
        gone = [o for o in rng.sample(sorted(own), 4) if o not in changed] + [next(iter(changed))]
        changes = [(*r, rng.choice([None, False])) for rs in changed.values() for r in rs] + [(o, None, None, True) for o in gone] + [(None, "x", "y", False)]
        table = versions.apply(table, spark.createDataFrame(changes, SHAPE + ", gone boolean"), most=3)
        for o in gone:
            own.pop(o, None)
        own |= changed
        assert table.version == step + 2 and len(table.parts) <= 3 and rows_of(table.read()) == flat()
    assert rows_of(first.read()) == rows_of(versions.load(spark, path, 1).read()) == began
    assert rows_of(versions.load(spark, path).read()) == flat() and versions.load(spark, path).by == by
    assert versions.numbers(spark, path) == [1, 2, 3, 4, 5, 6]


def test_failed_and_rival_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    table = versions.create(spark.createDataFrame([(1, "가", "a")], SHAPE), path)
    change = spark.createDataFrame([(1, "가", "b", False)], SHAPE + ", gone boolean")
    with pytest.raises(Exception, match="lost"):
        versions.apply(table, change.withColumn("v", F.raise_error(F.lit("lost")).cast("string")))
    assert rows_of(versions.load(spark, path).read()) == [(1, "가", "a")]
    assert rows_of(versions.apply(table, change).read()) == [(1, "가", "b")]
    with pytest.raises(Exception, match="v000000002"):
        versions.apply(table, change)
    with pytest.raises(ValueError, match="no version"):
        versions.load(spark, path, 9)
    empty = versions.create(spark.createDataFrame([], SHAPE))
    assert empty.read().count() == 0 and rows_of(versions.apply(empty, change).read()) == [(1, "가", "b")]


def test_filters_and_joins_prune_folders(spark):
    table = versions.create(spark.range(60).select("id", F.concat(F.lit("i"), F.col("id") % 6).alias("issuer"), F.lit("v").alias("v")).withColumnRenamed("id", "ord"), by="issuer")
    (scan,) = [x for x in table.read().filter("issuer = 'i3'")._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    assert "PartitionFilters: [isnotnull(issuer" in scan
    asked = spark.createDataFrame([("i1", 1), ("i2", 2)], "issuer string, n int").filter("n > 1")
    plan = table.read().join(F.broadcast(asked), "issuer")
    assert plan.count() == 10 and "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString().lower()


def test_kept_notices_give_what_the_texts_give(spark):
    """Through changes: a number that goes, one that comes before the others, a new first record."""
    meta = lambda i, n: {"issuer": "가나"[i % 2], "fact_type": "requirements", "doc_id": f"d{i}", "source_file": f"f{i}", "project_name": f"p{i}", "notice": n}
    make = lambda rows: make_chunks(spark, [(i, f"글 {i}", meta(i, n), None) for i, n in rows])
    before = [(i, f"공고번호: 20240000{i:03}-00" if i > 2 else "") for i in range(1, 9)]
    after = [(0, "공고번호: 20249999000-00"), *[r for r in before if r[0] not in (3, 4)], (4, "공고번호: 20240000777-00")]
    questions = make_questions(spark, [(1, "예산 글", ["가"], 5, None), (2, "예산", ["나", "가"], 5, None), (3, "예산", ["다"], 5, None), (4, "개선", ["가"], 5, None)])

    def told(chunks, **how):
        found = hybrid.retrieve(chunks, questions, 2, 2)
        return rows_of(hybrid.lookups(chunks, found, *hybrid.select(chunks, found), **how))

    kept = versions.create(hybrid.notice_rows(make(before)), by="issuer")
    assert told(make(before), notices=kept.read()) == told(make(before)) != []
    changes = hybrid.notice_rows(make([r for r in after if r[0] in (0, 4)])).withColumn("gone", F.lit(False))
    gone = hybrid.notice_rows(make([(3, "")])).withColumn("gone", F.lit(True))
    kept = versions.apply(kept, changes.unionByName(gone))
    assert told(make(after), notices=kept.read()) == told(make(after)) != told(make(before))
    assert "text" not in kept.read().columns and fusion.MOST_CONTEXTS == 8
