"""Exact nearest neighbours that read only the cells of the corpus which can matter.

Vectors lie in cells about centroids (fitted on ``SAMPLE`` vectors at most; every vector is in a cell),
each a partition of the written table, with the cell's radius: how far its farthest vector is from
the centroid. For a question q of length one, x . q = c . q + (x - c) . q is at most c . q + radius.
So a question reads the cells about its nearest centroids first, until they hold k vectors; the k-th
best similarity found there is what any other cell's bound has to reach to be read at all. Cells that
no question of a block wants are not opened.

The driver holds the centroids and radii, ``CELLS`` of each at most, and a block of questions. Vectors
of a length that the sample had not, or with components that aren't finite or beyond ``HUGE``, are in a
cell of their own about zero (the latter with no bound).

Defined results: those of ``retrieval.dense_search`` over the same chunks, row by row: chunks without
a vector, or with a null or NaN in it, take no part; only vectors of one length meet; questions
without issuers are asked of all. Where a question's first cells hold fewer than k chunks that its
issuers allow, it reads every cell.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from findery.scratch import materialize, remove_at_end, shared_dir, shuffle_partitions

CELLS, SAMPLE, ROUNDS, SEED, MARGIN = 4096, 1 << 15, 8, 7, 1.5
HUGE = 1e100  # components beyond, whose squares a double can't hold, are bounded by nothing


def _flat(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(components one after another, length of each vector); null vectors have none, null components are NaN."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0)).astype(np.int64)
    return np.asarray(vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)), sizes


def centroids(sample: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Means of the sample's groups about them, from rows of the sample chosen at random on."""
    rng = np.random.default_rng(seed)
    own = sample[np.sort(rng.permutation(len(sample))[:cells])].copy()
    for _ in range(rounds):
        to = nearest(sample, own)
        n = np.bincount(to, minlength=len(own))
        sums = np.zeros_like(own)
        np.add.at(sums, to, sample)
        own[n > 0] = sums[n > 0] / n[n > 0, None]
    return own


def nearest(x: np.ndarray, own: np.ndarray, step: int = 4096) -> np.ndarray:
    half = (own * own).sum(1) / 2
    return np.concatenate([np.argmax(x[a : a + step] @ own.T - half, axis=1) for a in range(0, len(x), step)] or [np.zeros(0, np.int64)])


def _assign(first: dict[int, int], means: dict[int, np.ndarray]):
    """Adds ``cell`` and ``away``, the distance to its centroid."""

    def run(batches):
        for b in batches:
            flat, sizes = _flat(b["embedding"])
            ends = np.cumsum(sizes)
            of = np.repeat(np.arange(len(sizes)), sizes)
            usual = np.bincount(of[~(np.abs(flat) < HUGE)], minlength=len(sizes)) == 0
            cell, away = -sizes - 1, np.full(len(sizes), np.inf)
            away[usual] = np.sqrt(np.bincount(of, np.where(np.abs(flat) < HUGE, flat, 0) ** 2, len(sizes)))[usual]
            for d, own in means.items():
                at = np.flatnonzero((sizes == d) & usual)
                x = flat[(ends[at] - d)[:, None] + np.arange(d)]
                to = nearest(x, own)
                cell[at] = first[d] + to
                away[at] = np.sqrt(((x - own[to]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64()), pa.array(away, pa.float64())], names=[*b.schema.names, "cell", "away"])

    return run


@dataclass(frozen=True)
class Cells:
    """A written table of vectors by cell; for each cell its centroid's number in ``means`` by length, radius and size."""

    rows: DataFrame
    means: dict[int, np.ndarray]
    first: dict[int, int]
    radius: dict[int, float]
    size: dict[int, int]
    issuers: DataFrame

    def shares(self, forms: list) -> np.ndarray:
        """Of each question, which part of all vectors its issuers allow."""
        named = sorted({x for f in forms for x in f or []})
        n = dict(self.issuers.filter(F.col("issuer").isin(*named)).collect()) if named else {}
        total = max(1, sum(self.size.values()))
        return np.array([sum(n.get(x, 0) for x in f) / total if f else 1.0 for f in forms])

    def of(self, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(cells, centroids, radii, sizes) of vectors of d components."""
        own = [c for c in range(self.first[d], self.first[d] + len(self.means[d])) if c in self.size] if d in self.means else []
        middle = self.means[d][[c - self.first[d] for c in own]] if own else np.zeros((0, d))
        if -d - 1 in self.size:
            own, middle = [*own, -d - 1], np.vstack([middle, np.zeros((1, d))])
        return np.array(own, np.int64), middle, np.array([self.radius[c] for c in own]), np.array([self.size[c] for c in own], np.int64)


def build(chunks: DataFrame, path: str | None = None, cells: int | None = None, sample: int = SAMPLE) -> Cells:
    """``ord, chunk_id, issuer, embedding`` -> their cells, written to ``path`` or, without one, to the shared folder until the application ends."""
    spark = chunks.sparkSession
    if path is None:
        path = f"{shared_dir(spark)}/findery/cells-{uuid.uuid4().hex}"
        remove_at_end(spark, path)
    own = chunks.filter("embedding IS NOT NULL").select("ord", "chunk_id", "issuer", "embedding")
    n = own.count()
    cells = min(CELLS, max(1, round(n**0.5))) if cells is None else cells
    good = own.filter(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= HUGE))).select("embedding")
    seen = good.orderBy(F.xxhash64("embedding")).limit(min(sample, 64 * cells)).collect()
    by_length: dict[int, list] = {}
    for (v,) in seen:
        by_length.setdefault(len(v), []).append(v)
    means, first, at = {}, {}, 0
    for d, vectors in sorted(by_length.items()):
        means[d] = centroids(np.array(vectors, np.float64), max(1, cells * len(vectors) // len(seen)))
        first[d], at = at, at + len(means[d])
    kind = own.schema["embedding"].dataType.simpleString()
    placed = own.mapInArrow(_assign(first, means), f"ord long, chunk_id string, issuer string, embedding {kind}, cell long, away double")
    placed.repartitionByRange(shuffle_partitions(spark), "cell", "away", "ord").sortWithinPartitions("cell", "away", "ord").write.partitionBy("cell").parquet(path)
    rows = spark.read.schema(f"ord long, chunk_id string, issuer string, embedding {kind}, away double, cell long").parquet(path)
    told = rows.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).collect() if n else []
    per = materialize(rows.groupBy("issuer").agg(F.count(F.lit(1)).alias("n")), "cells-issuers", exchanged=True)
    return Cells(rows, means, first, {r["cell"]: r["radius"] for r in told}, {r["cell"]: r["n"] for r in told}, per)


@dataclass
class Wanted:
    """Which questions want which cells: of ``bound`` (questions, cells) those that may still matter."""

    who: np.ndarray
    q: np.ndarray
    cells: np.ndarray
    bound: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, index: Cells, vectors: list) -> list[Wanted]:
        out = []
        by_length: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            if v and None not in v:
                by_length.setdefault(len(v), []).append(i)
        for d, who in by_length.items():
            q = np.array([vectors[i] for i in who], np.float64)
            q = q / np.maximum(np.sqrt((q * q).sum(1, keepdims=True)), 1e-300)
            cells, middle, radius, size = index.of(d)
            with np.errstate(invalid="ignore"):
                bound = q @ middle.T + radius[None, :] * np.sqrt((q * q).sum(1))[:, None]
            slack = 1e-9 + 1e-12 * (np.sqrt((middle * middle).sum(1)) + radius)
            out.append(cls(np.array(who), q, cells, np.nan_to_num(bound + slack, nan=np.inf, posinf=np.inf), size))
        return out

    def first(self, k: int, shares: np.ndarray) -> np.ndarray:
        """The cells of the greatest bounds that together may be taken to hold k vectors a question is allowed."""
        o = np.argsort(-self.bound, axis=1, kind="stable")
        before = np.cumsum(self.size[o], axis=1) - self.size[o]
        out = np.zeros(self.bound.shape, bool)
        share = shares[self.who, None]
        np.put_along_axis(out, o, (before * share < MARGIN * k) & (share > 0), axis=1)
        return out

    def rest(self, done: np.ndarray, least: np.ndarray, shares: np.ndarray) -> np.ndarray:
        return ~done & (self.bound >= least[self.who, None]) & (shares[self.who, None] > 0)


def _scan(asked: list[tuple[Wanted, np.ndarray]], forms: list, ids: pa.Array, k: int, digits: int, hits):
    """Batches of vectors -> the k best of each question among those of its cells that its issuers allow."""
    from findery.operators.retrieval import STEP, Best

    n = len(forms)
    every = np.array([not f for f in forms], dtype=bool)
    allowed: dict[str, np.ndarray] = {}
    for i, f in enumerate(forms):
        for form in f or []:
            allowed.setdefault(form, every.copy())[i] = True
    wants = [(w.who, w.q, {c: chosen[:, j] for j, c in enumerate(w.cells.tolist())}) for w, chosen in asked]

    def run(batches):
        for b in batches:
            found, order = Best(n, k), np.asarray(b["ord"])
            issuer, cell = b["issuer"].to_pylist(), np.asarray(b["cell"])
            flat, sizes = _flat(b["embedding"])
            ends = np.cumsum(sizes)
            whole = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[np.isnan(flat)], minlength=len(sizes)) == 0
            for who, q, want in wants:
                d = q.shape[1]
                own = np.flatnonzero((sizes == d) & whole)
                for c in np.unique(cell[own]).tolist():
                    asks = np.flatnonzero(want[c]) if c in want else ()
                    if not len(asks):
                        continue
                    here = own[cell[own] == c]
                    for a in range(0, len(here), STEP):
                        part = here[a : a + STEP]
                        score = np.round(flat[(ends[part] - d)[:, None] + np.arange(d)] @ q[asks].T, digits)
                        may = np.stack([allowed.get(issuer[j], every)[who[asks]] for j in part])
                        at, qs = np.nonzero(may & (score >= found.least[who[asks]]))
                        found.add(who[asks][qs], score[at, qs], order[part[at]], part[at])
            yield hits(b, ids, found, "similarity")

    return run


def search(index: Cells, rows: list, ids: pa.Array, k: int, digits: int, hits, told: dict | None = None) -> DataFrame:
    """Hits of a block of questions (``vector, forms`` each), first those of the nearest cells, then those of the cells that these leave open."""
    spark, forms = index.rows.sparkSession, [r["forms"] for r in rows]
    numbers = pa.array(np.arange(len(rows)), pa.int64())
    shares = index.shares(forms)
    own = [(w, w.first(k, shares)) for w in Wanted.of(index, [r["vector"] for r in rows])]

    def scan(asked: list[tuple[Wanted, np.ndarray]]) -> DataFrame:
        cells = sorted({c for w, chosen in asked for c in w.cells[chosen.any(0)].tolist()})
        read = index.rows.filter(F.col("cell").isin(*cells)) if cells else index.rows.limit(0)
        if forms and all(forms):
            read = read.filter(F.col("issuer").isin(*sorted({x for f in forms for x in f})))
        return read.select("ord", "chunk_id", "issuer", "embedding", "cell").mapInArrow(_scan(asked, forms, numbers, k, digits, hits), "question_id long, ord long, similarity double, chunk_id string")

    near = materialize(scan(own), "near-cells")
    place = F.row_number().over(W.partitionBy("question_id").orderBy(F.desc("similarity"), "ord"))
    best = near.withColumn("place", place).filter(F.col("place") == k).select("question_id", "similarity").collect()
    least = np.full(len(rows), -np.inf)
    for i, s in best:
        least[i] = s
    rest = [(w, w.rest(done, least, shares)) for w, done in own]
    if told is not None:
        told["cells"] = told.get("cells", 0) + sum(w.bound.size for w, _ in own)
        told["read"] = told.get("read", 0) + sum(int(x.sum()) for _, x in own) + sum(int(x.sum()) for _, x in rest)
    both = near.unionByName(scan(rest)) if any(x.any() for _, x in rest) else near
    named = spark.createDataFrame(pa.table({"n": numbers, "own": ids}))
    return both.join(F.broadcast(named), F.col("question_id") == F.col("n")).select(F.col("own").alias("question_id"), "ord", "similarity", "chunk_id")
