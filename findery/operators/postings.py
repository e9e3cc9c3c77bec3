"""Inverted postings of the corpus, clustered by token, with the greatest impact of each block of chunks: the sparse side's index, which follows changes.

An index is a folder of parts and versions. A part holds shards of some ``SHARD`` chunks. A shard's
chunks of one issuer are numbered by how many distinct tokens they have, and every token's list names
them in that order, in blocks of ``BLOCK`` numbers. What a single occurrence in a block can be worth at
most (the greatest tf over the root of distinct tokens), and the greatest root that divides it, are
worked out where a shard is met: kept, they were more than the lists, and went where these go. Rows are sorted by issuer and token, so a search whose tokens are few reads
their pages alone, and one of many joins them.

A search meets a shard's lists in one task. The bounds of a question's tokens, added up by block, tell
what a chunk of the block can score; blocks are worked off by falling bound, in two runs, and those
that fall under the k-th best score so far are not scored at all. What is shuffled is the lists of
tokens asked for and k rows for each question and shard.

A change set makes a new part of what was added or changed, and tombstones for what was there before,
kept with the shards they are for. A version names its parts and is there once it is written whole; a
reader keeps to the version it began with, and a failed update leaves none. Where more than ``PARTS``
parts or a larger share of dead chunks than ``DEAD`` would come together, the new version is written
anew from what is alive (``compact``), out of the index itself.

Defined results: chunks without an issuer, or without tokens, are found by nothing; chunks that share
``ord`` are each found, changed and deleted together; of changes that share ``ord``, deletions come first; null
``ord`` takes no part; an unknown version is an error; empty tables make an index without shards.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.functions.text import token_codes
from findery.scratch import remove_at_end, shared_dir, shuffle_partitions

SHARD, SHARD_BYTES, BLOCK, FEW = 4096, 1 << 23, 64, 256
PARTS, DEAD = 8, 0.3
#: ``token`` is null in the row that names a shard's chunks of an issuer (``ords, chunk_ids, sizes``), and in tombstones (``gone``).
ROW = "shard long, issuer string, token long, places array<int>, counts array<int>, ords array<long>, chunk_ids array<string>, sizes array<int>, gone array<long>"
_SCHEMA = pa.schema(
    [("shard", pa.int64()), ("issuer", pa.string()), ("token", pa.int64()), ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
    + [("ords", pa.list_(pa.int64())), ("chunk_ids", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())), ("gone", pa.list_(pa.int64()))]
)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    return np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int), len(keys)]


def _lists(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values, kind))


def _invert(shard: int, issuer: str, ords: list, ids: list, made: list, block: int = BLOCK) -> list[pa.RecordBatch]:
    """Rows of a shard's chunks of one issuer; ``made``: (distinct tokens, counts) of each. What is kept is the same for every ``block``, the search's."""
    size = np.array([len(t) for t, _ in made])
    order = np.lexsort((np.array(ords), size))
    size, made = size[order], [made[i] for i in order]
    place = np.repeat(np.arange(len(size)), size)
    token, count = (np.concatenate([m[i] for m in made]) for i in (0, 1))
    o = np.argsort(token, kind="stable")
    token, count, place = token[o], count[o].astype(np.int64), place[o]
    lists = _starts(token)
    n = len(lists) - 1
    none = lambda t: pa.nulls(n, t)
    rows = [pa.array(np.full(n, shard)), pa.array([issuer] * n), pa.array(token[lists[:-1]].view(np.int64)), _lists(place, lists, pa.int32()), _lists(count, lists, pa.int32())]
    rows += [none(_SCHEMA.field(c).type) for c in ("ords", "chunk_ids", "sizes", "gone")]
    head = {"shard": shard, "issuer": issuer, "ords": [ords[i] for i in order], "chunk_ids": [ids[i] for i in order], "sizes": size.tolist()}
    return [pa.RecordBatch.from_pylist([head], schema=_SCHEMA), pa.RecordBatch.from_arrays(rows, schema=_SCHEMA)]


def _shards(first: int):
    """A partition's chunks, sorted by issuer, are a shard of the partition's own number."""

    def run(batches):
        shard, now, own = None, None, ([], [], [])
        for b in batches:
            if shard is None and len(b):
                shard = first + b["part"][0].as_py()
            for ord_, name, issuer, text in zip(*(b[c].to_pylist() for c in ("ord", "chunk_id", "issuer", "text")), strict=True):
                if issuer != now and own[0]:
                    yield from _invert(shard, now, *own)
                    own = ([], [], [])
                now = issuer
                t, n = np.unique(token_codes(text), return_counts=True)
                if len(t):
                    for x, v in zip(own, (ord_, name, (t, n)), strict=True):
                        x.append(v)
        if own[0]:
            yield from _invert(shard, now, *own)

    return run


def inverted(chunks: DataFrame, first: int = 0, shards: int | None = None) -> DataFrame:
    """``ord, chunk_id, issuer, text`` -> rows of shards numbered from ``first`` on, sorted by issuer and token. One exchange of the texts."""
    own = chunks.select("ord", "chunk_id", "issuer", "text").filter("ord IS NOT NULL AND issuer IS NOT NULL")
    if shards is None:
        n, size = own.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
        shards = max(1, -(-n // SHARD), -(-size // SHARD_BYTES))
    dealt = own.repartitionByRange(shards, "issuer", F.xxhash64("ord"), "ord").sortWithinPartitions("issuer", "ord").withColumn("part", F.spark_partition_id())
    return dealt.mapInArrow(_shards(first), ROW)


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


@dataclass(frozen=True)
class Index:
    """A version of an index: what it reads doesn't change."""

    spark: SparkSession
    path: str
    version: int
    parts: tuple[str, ...]
    shards: int
    block: int

    def rows(self) -> DataFrame:
        """All rows of all parts, tombstones among them."""
        return self.spark.read.schema(ROW).parquet(*(f"{self.path}/{p}" for p in self.parts))

    def alive(self) -> DataFrame:
        """``shard, issuer, place, ord, chunk_id, size`` of the chunks that no tombstone is for."""
        heads = self.rows().filter("token IS NULL AND ords IS NOT NULL").select("shard", "issuer", F.explode(F.arrays_zip("ords", "chunk_ids", "sizes", F.sequence(F.lit(0), F.size("ords") - 1).alias("place"))).alias("x"))
        own = heads.select("shard", "issuer", F.col("x.place").alias("place"), F.col("x.ords").alias("ord"), F.col("x.chunk_ids").alias("chunk_id"), F.col("x.sizes").alias("size"))
        dead = self.rows().filter("gone IS NOT NULL").select("shard", F.explode("gone").alias("ord"))
        return own.join(dead.distinct(), ["shard", "ord"], "left_anti").select("shard", "issuer", "place", "ord", "chunk_id", "size")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that were written whole."""
    fs, where = _fs(spark, f"{path}/versions")
    if not fs.exists(where):
        return []
    found = []
    for s in fs.listStatus(where):
        name = s.getPath().getName()
        if name.startswith("v") and fs.exists(_fs(spark, f"{path}/versions/{name}/_SUCCESS")[1]):
            found.append(int(name[1:]))
    return sorted(found)


def load(spark: SparkSession, path: str, version: int | None = None) -> Index:
    """The newest version, or the one asked for."""
    there = versions(spark, path)
    if not there or (version is not None and version not in there):
        raise ValueError(f"no version {'' if version is None else version} of an index in {path}")
    own = there[-1] if version is None else version
    rows = spark.read.schema("part string, place int, shards long, block int").parquet(f"{path}/versions/v{own:09}").orderBy("place").collect()
    return Index(spark, path, own, tuple(r["part"] for r in rows), rows[0]["shards"], rows[0]["block"])


def _commit(spark: SparkSession, path: str, version: int, parts: list[str], shards: int, block: int) -> Index:
    """The version is there from the moment that its file is; two writers of one version can't both succeed."""
    rows = spark.createDataFrame([(p, n, shards, block) for n, p in enumerate(parts)], "part string, place int, shards long, block int")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/versions/v{version:09}")
    return load(spark, path, version)


def build(chunks: DataFrame, path: str | None = None, shards: int | None = None, block: int = BLOCK) -> Index:
    """An index's first version; without a path, in the shared folder until the application ends."""
    spark = chunks.sparkSession
    if path is None:
        path = f"{shared_dir(spark)}/findery/postings-{uuid.uuid4().hex}"
        remove_at_end(spark, path)
    part = f"parts/{uuid.uuid4().hex}"
    rows = inverted(chunks, 0, shards)
    rows.write.parquet(f"{path}/{part}")
    made = spark.read.schema(ROW).parquet(f"{path}/{part}").agg(F.max("shard")).first()[0]
    return _commit(spark, path, 1, [part], 0 if made is None else made + 1, block)


def update(index: Index, changes: DataFrame, most_parts: int = PARTS, most_dead: float = DEAD, shards: int | None = None) -> Index:
    """``changes``: ``ord, chunk_id, issuer, text, gone``: what was added or changed, whole, or is gone. The next version."""
    spark = index.spark
    changes = changes.filter("ord IS NOT NULL")
    left = index.alive().join(changes.select("ord").distinct(), "ord", "left_semi")
    stones = left.groupBy("shard", "issuer").agg(F.collect_set("ord").alias("gone"))
    part = f"parts/{uuid.uuid4().hex}"
    fresh = inverted(changes.filter("NOT coalesce(gone, false)"), index.shards, shards)
    columns = [f.name for f in _SCHEMA]
    tombs = stones.select(*(F.col(c) if c in ("shard", "issuer", "gone") else F.lit(None).alias(c) for c in columns))
    tombs = tombs.select(*(F.col(c).cast(fresh.schema[c].dataType) for c in columns))
    fresh.write.parquet(f"{index.path}/{part}")
    tombs.write.mode("append").parquet(f"{index.path}/{part}")
    made = spark.read.schema(ROW).parquet(f"{index.path}/{part}").filter("ords IS NOT NULL").agg(F.max("shard")).first()[0]
    new = Index(spark, index.path, index.version + 1, (*index.parts, part), index.shards if made is None else made + 1, index.block)
    dead, n = (new.rows().agg(F.coalesce(F.sum(F.size(F.coalesce(c, F.array()))), F.lit(0))).first()[0] for c in ("gone", "ords"))
    if len(new.parts) > most_parts or dead > most_dead * n:
        return compact(new)
    return _commit(spark, new.path, new.version, list(new.parts), new.shards, new.block)


def _rewritten():
    """Live chunks of the shards that a new one is made of: rows of a shard's chunks with their tokens -> rows of the shard."""

    def run(batches):
        shard, now, own = None, None, ([], [], [])
        for b in batches:
            if shard is None and len(b):
                shard = b["part"][0].as_py()
            for ord_, name, issuer, pairs in zip(*(b[c].to_pylist() for c in ("ord", "chunk_id", "issuer", "pairs")), strict=True):
                if issuer != now and own[0]:
                    yield from _invert(shard, now, *own)
                    own = ([], [], [])
                now = issuer
                t, n = np.array([p["token"] for p in pairs], np.int64).view(np.uint64), np.array([p["count"] for p in pairs], np.int64)
                o = np.argsort(t)
                for x, v in zip(own, (ord_, name, (t[o], n[o])), strict=True):
                    x.append(v)
        if own[0]:
            yield from _invert(shard, now, *own)

    return run


def compact(index: Index) -> Index:
    """The same version in one part, without the dead: from the lists, whatever became of the texts."""
    spark, alive = index.spark, index.alive()
    lists = index.rows().filter("token IS NOT NULL").select("shard", "issuer", "token", F.explode(F.arrays_zip("places", "counts")).alias("x"))
    lists = lists.select("shard", "issuer", F.col("x.places").alias("place"), F.struct("token", F.col("x.counts").alias("count")).alias("pair"))
    whole = lists.join(alive, ["shard", "issuer", "place"]).groupBy("shard", "issuer", "place", "ord", "chunk_id").agg(F.collect_list("pair").alias("pairs"))
    shards = max(1, -(-alive.count() // SHARD))
    dealt = whole.select("ord", "chunk_id", "issuer", "pairs").repartitionByRange(shards, "issuer", F.xxhash64("ord"), "ord").sortWithinPartitions("issuer", "ord").withColumn("part", F.spark_partition_id())
    part = f"parts/{uuid.uuid4().hex}"
    dealt.mapInArrow(_rewritten(), ROW).write.parquet(f"{index.path}/{part}")
    made = spark.read.schema(ROW).parquet(f"{index.path}/{part}").agg(F.max("shard")).first()[0]
    return _commit(spark, index.path, index.version, [part], 0 if made is None else made + 1, index.block)


def wanted(index: Index, issuers: list[str], tokens: np.ndarray, few: int = FEW) -> DataFrame:
    """Rows that questions for these issuers and tokens (``token_codes``) have to see. ``few`` tokens or less are a filter that reaches the pages; more are joined, broadcast up to 8 MB of them."""
    spark = index.spark
    own = index.rows().filter(_any("issuer", issuers))
    codes = np.unique(tokens).view(np.int64)
    if len(codes) <= few:
        return own.filter(F.col("token").isNull() | _any("token", codes.tolist()))
    asked = spark.createDataFrame(pa.table({"token": pa.array(codes)}))
    asked = F.broadcast(asked) if len(codes) <= 1 << 20 else asked
    return own.filter("token IS NULL").unionByName(own.filter("token IS NOT NULL").join(asked, "token", "left_semi"))


def _any(column: str, values: list) -> F.Column:
    """One of the values, as alternatives that reach the file's statistics (a long list would become a range)."""
    tests = [F.col(column) == v for v in values] or [F.lit(False)]
    while len(tests) > 1:
        tests = [a | b for a, b in zip(tests[::2], tests[1::2], strict=False)] + tests[len(tests) // 2 * 2 :]
    return tests[0]


@dataclass
class Shard:
    """Lists of a shard's chunks of one issuer, and what is known of the chunks."""

    tokens: np.ndarray
    place: np.ndarray
    count: np.ndarray
    first: np.ndarray
    block: np.ndarray
    most: np.ndarray
    root: np.ndarray
    block_first: np.ndarray
    size: np.ndarray
    live: np.ndarray
    width: int

    def scores(self, tokens: np.ndarray, times: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray, int, int]:
        """(places, scores, blocks scored, blocks that have a token) of the chunks that may be among the k best, given that ``least`` is reached by k already. ``tokens`` ascending."""
        at = np.minimum(np.searchsorted(self.tokens, tokens), max(0, len(self.tokens) - 1))
        have = self.tokens[at] == tokens if len(self.tokens) else np.zeros(len(tokens), bool)
        at, times = at[have], times[have]
        n = np.diff(self.block_first)[at]
        own = np.repeat(self.block_first[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        bound = np.bincount(self.block[own], np.minimum(self.most[own], np.repeat(times, n) * self.root[own]), len(self.live) // self.width + 1) * (1 + 1e-9)
        there = np.flatnonzero(bound)
        there = there[np.argsort(-bound[there], kind="stable")]
        m = np.diff(self.first)[at]
        entry = np.repeat(self.first[at] - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(m.sum())
        place, part = self.place[entry], np.minimum(np.repeat(times, m), self.count[entry])
        out, done, head = [], 0, max(1, -(-2 * k // self.width))
        for run in (there[:head], there[head:]):
            run = run[bound[run] >= least]
            if not len(run):
                continue
            done += len(run)
            chosen = np.zeros(len(bound), bool)
            chosen[run] = True
            inside = chosen[place // self.width]
            overlap = np.bincount(place[inside], part[inside], len(self.live))
            found = np.flatnonzero((overlap > 0) & self.live)
            score = overlap[found] / np.sqrt(self.size[found])
            out.append((found, score))
            if len(score) >= k:
                least = max(least, float(np.partition(score, len(score) - k)[len(score) - k]))
        places, score = (np.concatenate([o[i] for o in out]) if out else np.zeros(0, t) for i, t in ((0, np.int64), (1, np.float64)))
        return places, score, done, len(there)


def shards_of(batches, block: int):
    """Rows sorted by shard and issuer -> (issuer, ords, chunk ids, ``Shard``), one at a time."""
    held, now = [], None
    for b in batches:
        keys = list(zip(b["shard"].to_pylist(), b["issuer"].to_pylist(), strict=True))
        at = 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            if keys[at] != now and held:
                yield from _shard(now, held, block)
                held = []
            now = keys[at]
            held.append(b.slice(at, end - at))
            at = end
    if held:
        yield from _shard(now, held, block)


def _bounds(place: np.ndarray, count: np.ndarray, first: np.ndarray, size: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(blocks that each list has, what an occurrence in each can be worth at most, the greatest root that divides it, where each list's blocks begin)."""
    root = 1 / np.sqrt(size[place])
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    cell = _starts(of * (len(size) // block + 1) + place // block)[:-1]
    return place[cell] // block, np.maximum.reduceat(count * root, cell) if len(cell) else root, np.maximum.reduceat(root, cell) if len(cell) else root, np.searchsorted(cell, first)


def _shard(key: tuple, held: list[pa.RecordBatch], block: int):
    rows = pa.Table.from_batches(held).combine_chunks()
    heads = rows.filter(rows["token"].is_null())
    ords, ids, size = ([x for r in heads[c].to_pylist() for x in r or []] for c in ("ords", "chunk_ids", "sizes"))
    if not ords:
        return
    gone = {x for r in heads["gone"].to_pylist() for x in r or []}
    lists = rows.filter(rows["token"].is_valid())
    flat = lambda c: np.asarray(lists[c].combine_chunks().flatten()) if len(lists) else np.zeros(0)
    ends = lambda c: np.r_[0, np.cumsum(np.asarray(pc.list_value_length(lists[c].combine_chunks())))].astype(np.int64) if len(lists) else np.zeros(1, np.int64)
    token = np.asarray(lists["token"].combine_chunks()).view(np.uint64) if len(lists) else np.zeros(0, np.uint64)
    # Lists come in the order of signed numbers, or in none; the search wants that of unsigned ones.
    o = np.argsort(token, kind="stable")
    lists = lists.take(pa.array(o))
    place, count, first = flat("places").astype(np.int64), flat("counts").astype(np.float64), ends("places")
    yield key[1], np.array(ords), ids, Shard(
        token[o], place, count, first, *_bounds(place, count, first, np.array(size, np.float64), block), np.array(size, np.float64), np.array([x not in gone for x in ords]), block
    )


def dealt(rows: DataFrame) -> DataFrame:
    """A shard's rows one after another in one task."""
    return rows.repartition(shuffle_partitions(rows.sparkSession), "shard").sortWithinPartitions("shard", "issuer", "token")
