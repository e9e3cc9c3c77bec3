"""The store's file against the same tables as Parquet."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from findery.plans import standins
from findery.sources import eav, sqlite
from findery.sources.sqlite import Range, SqliteReader

SMALL = "/root/testdata/sf0.001"


def store(path, entities, metadata):
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE embeddings (id INTEGER PRIMARY KEY, embedding_id TEXT NOT NULL)")
    db.execute("CREATE TABLE embedding_metadata (id INTEGER REFERENCES embeddings(id), key TEXT NOT NULL, string_value TEXT, int_value INTEGER, float_value REAL, bool_value INTEGER, PRIMARY KEY (id, key))")
    db.executemany("INSERT INTO embeddings VALUES (?, ?)", entities)
    db.executemany("INSERT INTO embedding_metadata VALUES (?, ?, ?, ?, ?, ?)", metadata)
    db.commit()
    db.close()
    return str(path)


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    entities, metadata = standins.eav(spark, SMALL)
    rows = [(r["id"], r["key"], r["string_value"], r["int_value"], r["float_value"], None if r["bool_value"] is None else int(r["bool_value"])) for r in metadata.collect()]
    return store(tmp_path_factory.mktemp("store") / "chroma.sqlite3", [tuple(r) for r in entities.collect()], rows)


def test_records_equal_those_of_parquet(spark, made):
    own, want = eav.records(*sqlite.read_sqlite(spark, made, parts=5)), eav.records(*standins.eav(spark, SMALL))
    row = lambda r: (r["ord"], r["chunk_id"], r["text"], sorted(r["metadata"].items()))
    assert sorted(map(row, own.collect())) == sorted(map(row, want.collect()))
    assert sqlite.issuers(spark, made).collect() == eav.issuers(standins.eav(spark, SMALL)[1]).collect()


@pytest.mark.parametrize("parts", [1, 3, 16, 1000])
def test_ranges_cover_all_rows_once(spark, made, parts):
    entities, metadata = sqlite.read_sqlite(spark, made, parts)
    ids = [r["id"] for r in entities.collect()]
    assert len(ids) == len(set(ids)) == 200
    assert entities.rdd.getNumPartitions() <= parts
    db = sqlite3.connect(made)
    assert metadata.count() == db.execute("SELECT count(*) FROM embedding_metadata").fetchone()[0]


def test_what_is_asked_for_reaches_the_statement(spark, made):
    whole = sqlite.read_sqlite(spark, made)[1].collect()
    for keys, ids in ((["issuer"], None), (["issuer", "doc_id", "none"], [3, 7, 10**9]), (None, [1, 2]), ([], None), (None, [])):
        entities, some = sqlite.read_sqlite(spark, made, 3, keys=keys, ids=ids)
        assert sorted(map(str, some.collect())) == sorted(str(r) for r in whole if (keys is None or r["key"] in keys) and (ids is None or r["id"] in ids))
        assert entities.count() == (200 if ids is None else len({1, 2, 3, 7} & set(ids)))
    reader = SqliteReader(sqlite.read_sqlite(spark, made)[1].schema, {"path": made, "table": "embedding_metadata", "only": '{"key": ["issuer"], "id": [5]}'})
    tests, given = reader._tests(reader._declared())
    db = sqlite3.connect(made)
    (n,) = db.execute(f"SELECT count(*) FROM embedding_metadata WHERE {' AND '.join(tests)}", given).fetchone()
    assert n == 1


def test_a_table_that_is_read_again_is_whole(spark, made):
    """A filter of one query doesn't stay for the next."""
    metadata = sqlite.read_sqlite(spark, made)[1]
    n = metadata.count()
    assert metadata.filter("key = 'issuer'").count() == 200 and metadata.count() == n and metadata.filter("id = 3 AND key > 'd'").count() > 1


def test_values_stored_otherwise_than_declared(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "s.db")
    db.execute('CREATE TABLE "odd ""t" (id INTEGER, word TEXT COLLATE NOCASE, flag BOOLEAN, share REAL, raw BLOB, bare)')
    rows = [(1, "A", 1, 1.5, b"\xff", 5), ("x", b"a", 2, "y", "t", "5"), (2.0, b"\xff", 0, 3, None, None), (3.5, 7, None, None, 8, b"q"), (None, None, "1", 2, b"", "")]
    db.executemany('INSERT INTO "odd ""t" VALUES (?, ?, ?, ?, ?, ?)', rows)
    db.commit()
    spark.dataSource.register(sqlite.SqliteSource)
    df = spark.read.format("sqlite").option("path", f"file://{tmp_path}/s.db").option("table", 'odd "t').load()
    assert df.dtypes == [("id", "bigint"), ("word", "string"), ("flag", "boolean"), ("share", "double"), ("raw", "binary"), ("bare", "string")]
    got = [tuple(r) for r in df.collect()]
    assert [r[0] for r in got] == [1, None, 2, None, None]
    assert [r[1] for r in got] == ["A", "a", None, "7", None]
    assert [r[2] for r in got] == [True, None, False, None, True]
    assert [r[3] for r in got] == [1.5, None, 3.0, None, 2.0]
    assert [r[4] for r in got] == [b"\xff", b"t", None, b"8", b""]
    assert [r[5] for r in got] == ["5", "5", None, "q", ""]
    assert [r["word"] for r in df.filter("word = 'a'").collect()] == ["a"]
    assert df.filter("bare = '5'").count() == 2 and df.filter("id IS NULL").count() == 3 and df.filter("id >= 1").count() == 2
    only = spark.read.format("sqlite").schema("id long").options(path=f"{tmp_path}/s.db", table='odd "t', only='{"word": ["a", "7"], "bare": ["5", ""]}').load()
    assert [r["id"] for r in only.collect()] == [None]
    assert spark.read.format("sqlite").schema("word string, nothing long").option("path", f"{tmp_path}/s.db").option("table", 'odd "t').load().filter("nothing IS NULL").count() == 5


def test_missing_files_and_tables_give_no_rows(spark, tmp_path):
    for df in sqlite.read_sqlite(spark, str(tmp_path / "none.db")):
        assert df.count() == 0
    sqlite3.connect(tmp_path / "empty.db").execute("CREATE TABLE embeddings (id INTEGER PRIMARY KEY, embedding_id TEXT)")
    entities, metadata = sqlite.read_sqlite(spark, str(tmp_path / "empty.db"))
    assert entities.count() == metadata.count() == 0 and eav.records(entities, metadata).count() == 0


def test_distant_rowids_and_tables_without_one(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "far.db")
    db.execute("CREATE TABLE embeddings (id INTEGER PRIMARY KEY, embedding_id TEXT)")
    db.executemany("INSERT INTO embeddings VALUES (?, ?)", [(-(2**63), "a"), (0, "b"), (2**63 - 1, "c")])
    db.execute("CREATE TABLE embedding_metadata (id INTEGER, key TEXT, string_value TEXT, PRIMARY KEY (id, key)) WITHOUT ROWID")
    db.executemany("INSERT INTO embedding_metadata VALUES (?, 'issuer', 'x')", [(i,) for i in (0, 1)])
    db.commit()
    entities, metadata = sqlite.read_sqlite(spark, str(tmp_path / "far.db"), parts=3)
    assert sorted(r["embedding_id"] for r in entities.collect()) == ["a", "b", "c"]
    assert metadata.count() == 2 and [r["issuer"] for r in eav.issuers(metadata).collect()] == ["x"]
    assert list(SqliteReader(entities.schema, {"path": "none", "table": "t"}).read(Range(1, 0))) == []
