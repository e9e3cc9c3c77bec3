"""Dense and sparse retrieval for many questions in one pass over the corpus.

Questions travel in blocks of at most ``BLOCK``. For a block the corpus is scanned once, and a task
keeps the k best of a question, so that what is shuffled is k rows for each question and batch,
whatever the size of the corpus. More questions than a block are read off their table a block at a
time, and each block's results are written before the next begins: the driver holds one block, and no
plan grows with the number of questions.

Defined results: a question or chunk without text, vector or issuer is found by, and finds, nothing
that needs it; a question's issuers are stripped and empty ones left out (none left: the sparse side
finds nothing, the dense side everything); repeated chunks are found each; rows that share a
``question_id``, which may be of any type, are ranked as one list; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window as W

from findery.functions.text import token_codes
from findery.operators import filters, neighbours, postings
from findery.scratch import materialize, remove_at_end, shared_dir

DENSE_K = SPARSE_K = 50
BLOCK = 4096
STEP, PENDING = 256, 1 << 19
RUN, PAIRS = 1 << 18, 1 << 18
DIGITS = 9


def _first(q: np.ndarray, score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of each question, by descending score, then corpus order."""
    o = np.lexsort((order, -score, q))
    s = q[o]
    start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, int)
    place = np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)]))
    return o[place < k]


class Best:
    """The k best chunks of each of a block's questions so far; about ``PENDING`` new ones wait at most."""

    def __init__(self, questions: int, k: int):
        self.k, self.least, self.n = k, np.full(questions, -np.inf), 0
        self.parts: list[tuple] = []

    def add(self, q: np.ndarray, score: np.ndarray, order: np.ndarray, at: np.ndarray) -> None:
        """``order``: the corpus order of the chunks, ``at``: where they are in the batch."""
        if len(q):
            self.parts.append((q.astype(np.int32), score, order, at.astype(np.int32)))
            self.n += len(q)
            if self.n > PENDING:
                self.settle()

    def settle(self) -> tuple:
        q, score, order, at = (np.concatenate(x) for x in zip(*self.parts, strict=True)) if self.parts else (np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int32))
        o = _first(q, score, order, self.k)
        out = q[o], score[o], order[o], at[o]
        self.parts, self.n = [out], 0
        numbers, first, count = np.unique(out[0], return_index=True, return_counts=True)
        full = count == self.k
        self.least[numbers[full]] = np.maximum(self.least[numbers[full]], out[1][first[full] + self.k - 1])
        return out


def _hits(batch: pa.RecordBatch, ids: pa.Array, found: Best, score: str) -> pa.RecordBatch:
    q, s, _, at = found.settle()
    where = pa.array(at)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(q)), batch["ord"].take(where), pa.array(s, pa.float64()), batch["chunk_id"].take(where)], names=["question_id", "ord", score, "chunk_id"])


def _by_blocks(questions: DataFrame, name: str, plan: Callable[[list], DataFrame]) -> DataFrame | None:
    """``plan`` of each block of questions, together. One block's plan is returned as it is; of more, each is run and written."""
    spark = questions.sparkSession
    rows = questions.toLocalIterator()
    block, after = list(islice(rows, BLOCK)), list(islice(rows, BLOCK))
    if not after:
        return plan(block) if block else None
    path = f"{shared_dir(spark)}/findery/{name}-{uuid.uuid4().hex}"
    while block:
        hits = plan(block)
        hits.write.mode("append").parquet(path)
        block, after = after, list(islice(rows, BLOCK))
    remove_at_end(spark, path)
    return spark.read.schema(hits.schema).parquet(path)


def _ranked(hits: DataFrame, k: int, score: str, name: str) -> DataFrame:
    order = W.partitionBy("question_id").orderBy(F.desc(score), "ord")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("question_id", "ord", "chunk_id", score, "rank", F.lit(name).alias("retriever"))


def _runs(b: pa.RecordBatch):
    """(where it begins, part) of a batch, parts of about ``RUN`` bytes of text at most: what a text's tokens take is some twenty times the text."""
    size = np.asarray(pc.fill_null(pc.binary_length(b["text"]), 0)).astype(np.int64)
    number = (np.cumsum(size) - size) // RUN
    at = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(b) else np.zeros(1, int)
    for begin, end in zip(at, np.r_[at[1:], len(b)], strict=True):
        yield int(begin), b.slice(begin, end - begin)


def _indexed(b: pa.RecordBatch) -> pa.RecordBatch:
    """Texts -> rows of ``sparse_index``."""
    made = [np.unique(token_codes(t), return_counts=True) for t in b["text"].to_pylist()]
    ends = np.r_[0, np.cumsum([len(t) for t, _ in made])].astype(np.int32)
    flat = lambda i, t, k: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, t), *(m[i] for m in made)]).view(k)))
    tokens, counts = flat(0, np.uint64, np.int64), flat(1, np.int64, np.int64)
    return pa.RecordBatch.from_arrays([b["ord"], b["chunk_id"], b["issuer"], tokens, counts], names=["ord", "chunk_id", "issuer", "tokens", "counts"])


def sparse_index(chunks: DataFrame) -> DataFrame:
    """``ord, chunk_id, issuer, tokens, counts``: a chunk's distinct tokens (``token_codes``, ascending) and how often each comes.

    The sparse side's postings, kept by chunk: a task scores its chunks whole, and only the best of
    them are shuffled. To be written once where questions come more than once.
    """

    def run(batches):
        for b in batches:
            for _, part in _runs(b):
                yield _indexed(part)

    return chunks.select("ord", "chunk_id", "issuer", "text").mapInArrow(run, "ord long, chunk_id string, issuer string, tokens array<long>, counts array<long>")


def _asked(rows) -> dict[str, tuple]:
    """issuer -> (question numbers, their distinct tokens, where each token's questions begin, those, how often they have it)."""
    own: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        for issuer in {x.strip() for x in r["issuers"] or [] if x} - {""}:
            own.setdefault(issuer, []).append(i)
    codes = [np.unique(token_codes(r["question"]), return_counts=True) for r in rows]
    out = {}
    for issuer, who in own.items():
        every = np.concatenate([codes[i][0] for i in who])
        number = np.repeat(np.arange(len(who)), [len(codes[i][0]) for i in who])
        times = np.concatenate([codes[i][1] for i in who])
        o = np.argsort(every, kind="stable")
        tokens, begin = np.unique(every[o], return_index=True)
        out[issuer] = np.array(who), tokens, np.r_[begin, len(every)], number[o], times[o]
    return out


def _sparse(rows, ids: pa.Array, k: int):
    """Batches of ``sparse_index``, or of texts, which are tokenised here a run at a time -> hits."""
    asked = _asked(rows)

    def score(found: Best, b: pa.RecordBatch, first: int) -> None:
        order, issuers = np.asarray(b["ord"]), b["issuer"].to_pylist()
        ends = np.asarray(b["tokens"].offsets)
        tokens, counts = np.asarray(b["tokens"].values).view(np.uint64), np.asarray(b["counts"].values)
        for j, issuer in enumerate(issuers):
            if issuer not in asked:
                continue
            who, known, begin, number, times = asked[issuer]
            own, n = tokens[ends[j] : ends[j + 1]], counts[ends[j] : ends[j + 1]]
            at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
            both = np.flatnonzero(known[at] == own) if len(known) else at[:0]
            if not len(both):
                continue
            at, n = at[both], n[both]
            size = begin[at + 1] - begin[at]
            # A long text's tokens are met by the questions in runs of about PAIRS.
            number_of = (np.cumsum(size) - size) // PAIRS
            cut = np.r_[np.flatnonzero(np.r_[True, number_of[1:] != number_of[:-1]]), len(at)]
            overlap = np.zeros(len(who))
            for x, y in zip(cut[:-1], cut[1:], strict=True):
                m = size[x:y]
                flat = np.repeat(begin[at[x:y]] - np.r_[0, np.cumsum(m)[:-1]], m) + np.arange(m.sum())
                overlap += np.bincount(number[flat], np.minimum(times[flat], np.repeat(n[x:y], m)), len(who))
            q = np.flatnonzero(overlap)
            score = overlap[q] / np.sqrt(len(own))
            q = who[q]
            good = score >= found.least[q]
            found.add(q[good], score[good], np.full(good.sum(), order[j]), np.full(good.sum(), first + j))

    def run(batches):
        for b in batches:
            found = Best(len(rows), k)
            for first, part in [(0, b)] if "tokens" in b.schema.names else _runs(b):
                score(found, part if "tokens" in b.schema.names else _indexed(part), first)
            yield _hits(b, ids, found, "sparse_score")

    return run


def _inverted(rows, ids: pa.Array, k: int, block: int, told: dict):
    """Shards of ``postings`` -> hits; what one shard's best reach is the least that the task's next one has to."""
    codes = [np.unique(token_codes(r["question"]), return_counts=True) for r in rows]
    own: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        for issuer in {x.strip() for x in r["issuers"] or [] if x} - {""}:
            own.setdefault(issuer, []).append(i)

    def run(batches):
        least = np.full(len(rows), -np.inf)
        for issuer, order, names, shard in postings.shards_of(batches, block):
            found = Best(len(rows), k)
            found.least = least
            for i in own.get(issuer, ()):
                at, score, scored, there = shard.scores(codes[i][0], codes[i][1].astype(np.float64), least[i], k)
                for name, n in (("scored", scored), ("blocks", there)):
                    if name in told:
                        told[name].add(n)
                good = score >= least[i]
                found.add(np.full(good.sum(), i), score[good], order[at[good]], at[good])
            yield _hits(pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(names, pa.string())], names=["ord", "chunk_id"]), ids, found, "sparse_score")

    return run


def _ids(rows, kind) -> pa.Array:
    return pa.array([r["question_id"] for r in rows], to_arrow_type(kind))


def sparse_search(chunks: DataFrame, questions: DataFrame, k: int = SPARSE_K, index: DataFrame | postings.Index | None = None, told: dict | None = None) -> DataFrame:
    """Shared tokens (each as often as both have it) over the root of the chunk's distinct tokens: ``question_id, ord, chunk_id, sparse_score, rank, retriever``.

    Of a version of ``postings`` reads the lists of tokens that questions have, and scores the blocks
    that can matter; of a ``sparse_index``, or without one, all chunks (tokenised once, however many
    blocks of questions there are). Chunks of an issuer that no question of the block asks for are
    left out at the scan. ``told``: accumulators ``blocks`` (that share a token with a question) and
    ``scored``, added to where lists are read.
    """
    kind = questions.schema["question_id"].dataType
    shape = f"question_id {kind.simpleString()}, ord long, sparse_score double, chunk_id string"
    written = index

    def plan(rows):
        nonlocal written
        wanted = sorted({i for r in rows for i in r["issuers"] or [] if i})
        if isinstance(index, postings.Index):
            asked = [token_codes(r["question"]) for r in rows]
            lists = postings.wanted(index, sorted({i.strip() for i in wanted} - {""}), np.concatenate(asked) if asked else np.zeros(0, np.uint64))
            return postings.dealt(lists).mapInArrow(_inverted(rows, _ids(rows, kind), k, index.block, told or {}), shape)
        if len(rows) == BLOCK and written is None:
            written = materialize(sparse_index(chunks), "postings")
        own = filters.records_for_issuers(chunks if written is None else written, wanted)
        return own.select("ord", "chunk_id", "issuer", *(("text",) if written is None else ("tokens", "counts"))).mapInArrow(_sparse(rows, _ids(rows, kind), k), shape)

    hits = _by_blocks(questions.select("question_id", "question", "issuers"), "sparse", plan)
    return _ranked(hits if hits is not None else questions.sparkSession.createDataFrame([], shape), k, "sparse_score", "sparse")


def _dense(rows, ids: pa.Array, k: int):
    by_length: dict[int, list[int]] = {}
    for i, r in enumerate(rows):
        if r["vector"] and None not in r["vector"]:
            by_length.setdefault(len(r["vector"]), []).append(i)
    asked = {}
    for d, who in by_length.items():
        q = np.array([rows[i]["vector"] for i in who], dtype=np.float64)
        asked[d] = np.array(who), q / np.maximum(np.sqrt((q * q).sum(1, keepdims=True)), 1e-300)
    every = np.array([not r["forms"] for r in rows], dtype=bool)
    allowed = {}
    for i, r in enumerate(rows):
        for form in r["forms"] or []:
            allowed.setdefault(form, every.copy())[i] = True

    def run(batches):
        for b in batches:
            found, order = Best(len(rows), k), np.asarray(b["ord"])
            issuer, vectors = b["issuer"].to_pylist(), b["embedding"]
            flat = np.asarray(vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
            sizes = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0)).astype(np.int64)
            ends = np.cumsum(sizes)
            whole = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[np.isnan(flat)], minlength=len(sizes)) == 0
            for d, (who, q) in asked.items():
                own = np.flatnonzero((sizes == d) & whole)
                for a in range(0, len(own), STEP):
                    part = own[a : a + STEP]
                    score = np.round(flat[(ends[part] - d)[:, None] + np.arange(d)] @ q.T, DIGITS)
                    may = np.stack([allowed.get(issuer[j], every)[who] for j in part])
                    at, qs = np.nonzero(may & (score >= found.least[who]))
                    found.add(who[qs], score[at, qs], order[part[at]], part[at])
            yield _hits(b, ids, found, "similarity")

    return run


def dense_search(chunks: DataFrame, questions: DataFrame, k: int = DENSE_K, index: neighbours.Cells | None = None, told: dict | None = None) -> DataFrame:
    """Exact nearest neighbours by inner product with the normalised question vector: ``question_id, ord, chunk_id, similarity, distance, rank, retriever``.

    ``chunks`` has an ``embedding``, ``questions`` a ``vector``; rows without one, or with a null or NaN
    in it, take no part, and only vectors of one length meet. Similarities are rounded to ``DIGITS``
    decimals before they rank. With an ``index`` of ``neighbours``, the cells that can matter are read
    in place of ``chunks``; ``told`` then gets how many ``cells`` there were for the questions, and how
    many were ``read``.
    """
    kind = questions.schema["question_id"].dataType
    shape = f"question_id {kind.simpleString()}, ord long, similarity double, chunk_id string"
    asked = questions.select("question_id", "vector", filters.aliases(F.col("issuers")).alias("forms"))

    def plan(rows):
        if index is not None:
            return neighbours.search(index, rows, _ids(rows, kind), k, DIGITS, _hits, told)
        forms = [r["forms"] for r in rows]
        own = chunks if any(not f for f in forms) else chunks.filter(F.col("issuer").isin(*sorted({x for f in forms for x in f})))
        return own.filter("embedding IS NOT NULL").select("ord", "chunk_id", "issuer", "embedding").mapInArrow(_dense(rows, _ids(rows, kind), k), shape)

    hits = _by_blocks(asked, "dense", plan)
    out = _ranked(hits if hits is not None else questions.sparkSession.createDataFrame([], shape), k, "similarity", "dense")
    return out.withColumn("distance", 1 - F.col("similarity"))
