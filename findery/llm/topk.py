"""Exact top-k inner products over all vectors, for a stated set of queries.

Vectors are integer (``floor(scale * x)``), packed in blocks by descending length. A rotation by the
singular vectors of all vectors together puts most of every length in the first coordinates, so that
a partial sum over those plus the Cauchy-Schwarz bound on the rest leaves few candidates whose
integer product has to be taken. Every query starts with the k-th best score among the longest
vectors as its threshold.

A query block and a lane of candidate blocks make a unit: one task reads the query block, then the
lane's blocks by descending length, one at a time, its thresholds rising as it goes. A candidate block
goes only to those query blocks that its greatest length can still give a result (``LEVELS`` steps to
a doubling of the length), so that a pair that the bound rules out is never copied.

Sums are exact whatever the components: in floating point where none can leave its exact range, in
64-bit integers where none can leave theirs, else in Python's integers. An error is raised only where
a score that belongs to the result fits no long.

Defined results: vectors that are null, or hold null or non-finite components, and rows with a null
id take no part; a component whose multiple by ``scale`` is beyond double precision is an error; a
shorter vector counts as filled up with zeros; a query given by several rows is asked once, with the
smallest of their vectors (as stored bytes), and candidates with the query's id are its own; repeated
rows are candidates each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from findery.scratch import materialize, shuffle_partitions

SCALE, K, LEADING = 256, 5, 16
QUERY_BLOCK, QUERY_BYTES, BLOCK_BYTES, LANE_BLOCKS, STEP, SEEDS, LEVELS = 1 << 16, 1 << 25, 1 << 20, 16, 512, 512, 4
_ASKED, _PAIRS = 2048, 1 << 16  # queries compared at once; products taken at once
_TINY, _LOWEST = 1e-290, -(1 << 20)
_VECTOR = "vec_id long, v binary, wide boolean, dims int, norm double"


def _whole(scale: int):
    """Integer vectors: components as 32-bit integers, or where one doesn't fit, as doubles (``wide``), which hold them exactly."""

    def run(batches):
        for b in batches:
            b = b.filter(pc.and_(b["vec_id"].is_valid(), b["embedding"].is_valid()))
            lists = b["embedding"]
            sizes = np.asarray(pc.list_value_length(lists), dtype=np.int64)
            x = np.asarray(lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64)
            of = np.repeat(np.arange(len(sizes)), sizes)
            good = np.bincount(of[~np.isfinite(x)], minlength=len(sizes)) == 0
            x, of, sizes, ids = x[good[of]], of[good[of]], sizes[good], b["vec_id"].filter(pa.array(good, pa.bool_()))
            of = (np.cumsum(good) - 1)[of]
            x = np.floor(x * scale) + 0.0  # no negative zero
            if not np.isfinite(x).all():
                raise OverflowError("a component's multiple is beyond double precision")
            most = np.zeros(len(sizes))
            np.maximum.at(most, of, np.abs(x))
            unit = np.where(most > 0, most, 1)
            norm = unit * np.sqrt(np.bincount(of, (x / unit[of]) ** 2, len(sizes)))
            wide, ends = most >= 2**31, np.r_[0, np.cumsum(sizes)]
            if wide.any():
                cells = pa.array([x[a:c].astype("<f8" if w else "<i4").tobytes() for a, c, w in zip(ends[:-1], ends[1:], wide, strict=True)], pa.binary())
            else:
                cells = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((4 * ends).astype("<i4").tobytes()), pa.py_buffer(x.astype("<i4").tobytes())])
            cols = [ids.cast(pa.int64()), cells, pa.array(wide, pa.bool_()), pa.array(sizes, pa.int32()), pa.array(norm, pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "v", "wide", "dims", "norm"])

    return run


def _matrix(cells, wide, d: int) -> np.ndarray:
    """Rows of d integers, as doubles."""
    out = np.zeros((len(cells), d))
    for i, (c, w) in enumerate(zip(cells, wide, strict=True)):
        v = np.frombuffer(c, dtype="<f8" if w else "<i4")
        out[i, : len(v)] = v
    return out


def _products(d: int, unit: float):
    """Sums of x x^T of a task's rows, one output row per cell."""

    def run(batches):
        total = np.zeros((d, d))
        for b in batches:
            m = _matrix(b["v"].to_pylist(), b["wide"].to_pylist(), d) / unit
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * d), pa.int32()), pa.array(total.ravel(), pa.float64())], names=["cell", "x"])

    return run


def rotation(vectors: DataFrame, d: int, unit: float) -> np.ndarray:
    """The right singular vectors of all rows, from d x d sums: what reaches the driver is d * d numbers for any input."""
    sums = vectors.select("v", "wide").mapInArrow(_products(d, unit), "cell int, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect()
    gram = np.zeros(d * d)
    for cell, x in sums:
        gram[cell] = x
    _, vecs = np.linalg.eigh(gram.reshape(d, d))
    return vecs[:, ::-1].copy()


def level_of(norm):
    """Steps of the length, ``LEVELS`` to a doubling; nothing at all is the lowest."""
    norm = np.asarray(norm, dtype=np.float64)
    with np.errstate(divide="ignore"):
        return np.where(norm > 0, np.floor(LEVELS * np.log2(norm)), _LOWEST).astype(np.int64)


def _blocks(size: int, query: bool):
    """Packs a partition's rows, in their order, into rows of up to ``size`` vectors, numbered by ``part`` and count: of ``spark_partition_id``, which stays the partition's own where a task reads several. ``level``: of a block of candidates its greatest length's; of queries the least that can matter."""

    def run(batches):
        number, rows = None, []
        schema = pa.schema([("block", pa.int64()), ("level", pa.int64()), ("top", pa.float64()), ("ids", pa.binary()), ("cells", pa.list_(pa.binary())), ("wide", pa.list_(pa.bool_())), ("least", pa.binary())])

        def out():
            nonlocal number
            ids, cells, wide, norms, *rest = zip(*rows, strict=True)
            level = min(rest[1]) if query else int(level_of(norms[0]))
            least = np.array(rest[0], "<f8").tobytes() if query else b""
            made = pa.RecordBatch.from_pylist([{"block": number, "level": level, "top": max(norms), "ids": np.array(ids, "<i8").tobytes(), "cells": cells, "wide": wide, "least": least}], schema=schema)
            number += 1
            rows.clear()
            return made

        names = ["vec_id", "v", "wide", "norm"] + ["least", "level"] * query
        for b in batches:
            if number is None and len(b):
                number = b["part"][0].as_py() << 32
            for row in zip(*(b[c].to_pylist() for c in names), strict=True):
                rows.append(row)
                if len(rows) == size:
                    yield out()
        if rows:
            yield out()

    return run


def _numbered(rows: DataFrame, size: int, query: bool) -> DataFrame:
    return rows.withColumn("part", F.spark_partition_id()).mapInArrow(_blocks(size, query), _BLOCK)


_BLOCK = "block long, level long, top double, ids binary, cells array<binary>, wide array<boolean>, least binary"


def scores(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact inner products of rows: (as longs, beyond: -1 below all longs, 1 above, else 0, where the first holds the score)."""
    a_top, b_top = np.abs(a).max(1, initial=0), np.abs(b).max(1, initial=0)
    with np.errstate(over="ignore"):
        most = a_top * b_top * max(1, a.shape[1])
    out, beyond = np.zeros(len(a), np.int64), np.zeros(len(a), np.int8)
    small = most < 2**52
    out[small] = np.einsum("ij,ij->i", a[small], b[small]).astype(np.int64)
    middle = ~small & (most < 2**62) & (np.maximum(a_top, b_top) < 2**62)
    out[middle] = np.einsum("ij,ij->i", a[middle].astype(np.int64), b[middle].astype(np.int64))
    for i in np.flatnonzero(~small & ~middle):
        s = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[i].tolist(), strict=True))
        if -(2**63) <= s < 2**63:
            out[i] = s
        else:
            beyond[i] = 1 if s > 0 else -1
    return out, beyond


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, beyond: np.ndarray, k: int):
    """The k first of each query number by (-beyond, -score, id)."""
    o = np.lexsort((ids, -score, score == -(2**63), -beyond.astype(np.int64), query))  # the smallest long has no negative
    query, ids, score, beyond = query[o], ids[o], score[o], beyond[o]
    first = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    place = np.arange(len(query)) - np.maximum.accumulate(np.where(first, np.arange(len(query)), 0)) if len(query) else np.zeros(0, int)
    keep = place < k
    return query[keep], ids[keep], score[keep], beyond[keep]


class Search:
    """A block of queries, shown candidates by descending length. Lengths, thresholds and bounds are in units of ``unit``, sums are not."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, least: np.ndarray, turn: np.ndarray, unit: float = 1.0, k: int = K, leading: int = LEADING):
        self.ids, self.q, self.least, self.turn, self.unit, self.k = ids, q, least.astype(np.float64).copy(), turn, unit, k
        self.h = min(leading, q.shape[1])
        self.r = (q / unit) @ turn
        self.norm = np.sqrt((self.r**2).sum(1))
        self.rest = np.sqrt((self.r[:, self.h :] ** 2).sum(1))
        self.small = float(np.abs(q).max(initial=0)) * max(1, q.shape[1])
        self.found = np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int8)

    def show(self, ids: np.ndarray, p: np.ndarray, step: int = 0) -> None:
        """Candidates ``ids, p``, none longer than what was shown before (if it is, less is pruned, nothing is lost)."""
        step = step or STEP
        for at in range(0, len(ids), step):
            part, who = p[at : at + step], ids[at : at + step]
            r = (part / self.unit) @ self.turn
            norm = np.sqrt((r**2).sum(1))
            rest, top = np.sqrt((r[:, self.h :] ** 2).sum(1)), norm.max()
            for low in range(0, len(self.ids), _ASKED):
                own = slice(low, low + _ASKED)
                slack = 1e-9 * self.norm[own].max() * top + _TINY
                live = low + np.flatnonzero(self.norm[own] * top + slack >= self.least[own])
                if len(live):
                    self._compare(live, slack, who, part, r, rest)

    def _compare(self, live, slack, who, part, r, rest) -> None:
        bound = self.r[live, : self.h] @ r[:, : self.h].T
        bound += self.rest[live, None] * rest[None, :]
        qi, pj = np.nonzero((bound + slack >= self.least[live, None]) & (who[None, :] != self.ids[live, None]))
        if not len(qi):
            return
        if len(qi) > 0.1 * bound.size and self.small * float(np.abs(part).max(initial=0)) < 2**52:
            s, beyond = (self.q[live] @ part.T)[qi, pj].astype(np.int64), np.zeros(len(qi), np.int8)
        else:
            runs = [scores(self.q[live[qi[i : i + _PAIRS]]], part[pj[i : i + _PAIRS]]) for i in range(0, len(qi), _PAIRS)]
            s, beyond = (np.concatenate(x) for x in zip(*runs, strict=True))
        keep = (beyond != 0) | (s.astype(np.float64) / self.unit / self.unit + slack >= self.least[live[qi]])
        fresh = live[qi[keep]], who[pj[keep]], s[keep], beyond[keep]
        self.found = best(*(np.concatenate(x) for x in zip(self.found, fresh, strict=True)), self.k)
        numbers, first, count = np.unique(self.found[0], return_index=True, return_counts=True)
        full = (count == self.k) & (self.found[3][first + count - 1] == 0)
        last = self.found[2][first[full] + self.k - 1].astype(np.float64) / self.unit / self.unit
        own = numbers[full]
        self.least[own] = np.maximum(self.least[own], last - 1e-9 * np.abs(last) - _TINY)


def _thresholds(d: int, unit: float, seed_ids: np.ndarray, seeds: np.ndarray, k: int):
    """Adds to queries ``least``, a score that k candidates reach (in units), and ``level``, below which no candidate's length can matter."""
    longest = np.sqrt(((seeds / unit) ** 2).sum(1)).max(initial=0)

    def run(batches):
        for b in batches:
            q = _matrix(b["v"].to_pylist(), b["wide"].to_pylist(), d) / unit
            norm, least = np.sqrt((q**2).sum(1)), np.full(len(q), -np.inf)
            for at in range(0, len(q), 4096):
                own = slice(at, at + 4096)
                s = q[own] @ (seeds / unit).T
                s[seed_ids[None, :] == np.asarray(b["vec_id"])[own, None]] = -np.inf
                if s.shape[1] >= k:
                    least[own] = -np.partition(-s, k - 1, axis=1)[:, k - 1] - 1e-9 * norm[own] * longest - _TINY
            with np.errstate(divide="ignore", invalid="ignore"):
                needed = np.where((least > 0) & (norm > 0), level_of(np.where((least > 0) & (norm > 0), least / norm * unit, 1)) - 1, _LOWEST)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least, pa.float64()), pa.array(needed, pa.int64())], names=[*b.schema.names, "least", "level"])

    return run


def _unit(d: int, turn: np.ndarray, unit: float, k: int, leading: int):
    """Rows of one unit follow each other: its query block, then candidate blocks by descending length."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.int8())])

    def run(batches):
        now, search = None, None

        def close():
            qi, who, score, beyond = search.found
            return pa.RecordBatch.from_arrays([pa.array(search.ids[qi]), pa.array(who), pa.array(score), pa.array(beyond)], schema=schema)

        for b in batches:
            for i in range(len(b)):
                own = b["q"][i].as_py(), b["lane"][i].as_py()
                ids = np.frombuffer(b["ids"][i].as_py(), "<i8")
                cells, wide = b["cells"][i].as_py(), b["wide"][i].as_py()
                if own != now:
                    if search is not None:
                        yield close()
                    now, search = own, None
                if b["side"][i].as_py() == 0:
                    if search is not None:
                        raise RuntimeError("two blocks of queries have one number")
                    search = Search(ids, _matrix(cells, wide, d), np.frombuffer(b["least"][i].as_py(), "<f8"), turn, unit, k, leading)
                elif search is not None:
                    search.show(ids, _matrix(cells, wide, d))
        if search is not None:
            yield close()

    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, leading: int = LEADING) -> DataFrame:
    """``vectors`` and ``queries``: ``vec_id, embedding``. Returns ``query_id, rank, vec_id, score``.

    The driver holds d * d sums, ``SEEDS`` vectors, and a count of blocks for each level of length
    (a double has some 8,000). The unpartitioned window runs over descriptions of query blocks, one
    row for ``QUERY_BLOCK`` queries or ``QUERY_BYTES`` of them, never over vectors.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score long"
    own = materialize(vectors.select("vec_id", "embedding").mapInArrow(_whole(scale), _VECTOR), "topk-vectors")
    sizes = own.agg(F.max("dims").alias("d"), F.count(F.lit(1)).alias("n"), F.max("norm").alias("top")).first()
    d, n, unit = sizes["d"] or 0, sizes["n"], sizes["top"] or 1.0
    asked = queries.select("vec_id", "embedding").mapInArrow(_whole(scale), _VECTOR).withColumn("v", F.when(F.col("dims") <= d, F.col("v")).otherwise(F.substring("v", 1, F.lit(d) * F.when(F.col("wide"), 8).otherwise(4))))
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("v", "wide", "norm")).alias("x")).select("vec_id", "x.*")
    if not d:
        return spark.createDataFrame([], result)
    turn = rotation(own, d, unit)
    top = own.orderBy(F.desc("norm"), "vec_id", "v").limit(SEEDS).select("vec_id", "v", "wide").collect()
    seed_ids, seeds = np.array([r[0] for r in top], dtype=np.int64), _matrix([r[1] for r in top], [r[2] for r in top], d)
    asked = materialize(asked.mapInArrow(_thresholds(d, unit, seed_ids, seeds, k), "vec_id long, v binary, wide boolean, norm double, least double, level long"), "topk-queries", exchanged=True)
    n_queries = asked.count()
    if not n_queries:
        return spark.createDataFrame([], result)

    width = shuffle_partitions(spark)
    block = max(64, BLOCK_BYTES // (4 * d))
    near = own.repartitionByRange(max(1, min(4 * width, -(-n // block))), F.desc("norm"), F.xxhash64("vec_id")).sortWithinPartitions(F.desc("norm"), "vec_id", "v")
    candidates = materialize(_numbered(near, block, False), "topk-blocks", exchanged=True)
    levels = sorted(candidates.groupBy("level").count().collect())
    n_blocks = sum(r["count"] for r in levels)
    most = max(1, min(QUERY_BLOCK, QUERY_BYTES // (8 * d)))
    like = asked.repartitionByRange(-(-n_queries // most), "level", F.xxhash64("vec_id")).sortWithinPartitions("level", "vec_id")
    questions = materialize(_numbered(like, most, True), "topk-questions", exchanged=True)
    numbers = materialize(questions.select("block", "level").withColumn("q", F.row_number().over(W.orderBy("level", "block")) - 1), "topk-numbers", exchanged=True)
    n_asked = numbers.count()
    lanes = min(n_blocks, max(-(-n_blocks // LANE_BLOCKS), -(-2 * width // n_asked)))

    # A level of candidates meets the query blocks that need it or a lower one: the first so many, as they are numbered by need.
    met = numbers.join(F.broadcast(spark.createDataFrame([(r["level"],) for r in levels], "own long")), F.col("level") <= F.col("own")).groupBy("own").count().collect()
    met = {r["own"]: r["count"] for r in met}
    count = F.create_map(*(F.lit(x) for own_level in (r["level"] for r in levels) for x in (own_level, met.get(own_level, 0))))
    row = ["q", "lane", "side", "top", "ids", "cells", "wide", "least"]
    up_to = lambda x: F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(x - 1, F.lit(0)).cast("long")), lambda i: i < x))
    left = questions.join(numbers.select("block", "q"), "block").withColumn("lane", up_to(F.lit(lanes))).withColumn("side", F.lit(0)).withColumn("q", F.col("q").cast("long"))
    right = candidates.withColumn("q", up_to(count[F.col("level")])).withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes))).withColumn("side", F.lit(1))
    units = left.select(row).unionByName(right.select(row)).repartition("q", "lane").sortWithinPartitions("q", "lane", "side", F.desc("top"))
    found = units.mapInArrow(_unit(d, turn, unit, k, leading), "query_id long, vec_id long, score long, beyond byte")
    order = W.partitionBy("query_id").orderBy(F.desc("beyond"), F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    fits = F.when(F.col("beyond") == 0, F.col("score")).otherwise(F.raise_error(F.lit("a score fits no long")).cast("long"))
    return ranked.select("query_id", "rank", "vec_id", fits.alias("score"))


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLE_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= {K}
"""
