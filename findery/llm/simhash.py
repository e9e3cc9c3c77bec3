"""SimHash fingerprints, and the near ones among them by anchor points of a covering code.

A linear code is a set of anchors: with covering radius r, every fingerprint has an anchor within r,
its home. Two fingerprints that differ in t bits at most meet at the home of either, as the other
one is within r + t of it. So every fingerprint is copied to all anchors within radius plus
threshold, and at each anchor those that are at home are compared with all that came.

The code is a product of short perfect codes over parts of the 64 bits, so that homes and anchors are
read off tables of error patterns by syndrome (built from the codes' check columns), and the radius
holds for each part: a copy goes where the distances beyond the parts' radii come to t or less
together. ``COARSE`` (two Golay codes of 23 bits, Hamming codes of 15 and 3) has 2**36 anchors, of
which a fingerprint meets some 165. Where more than ``FULL`` came to one anchor, its fingerprints are
covered anew by ``FINE`` (a Hamming code of 63 bits and a bit of its own), whose anchors no more
than ``FINE.most(t)`` different fingerprints can ever reach: that bounds a task's memory and work for
any table. No pair is compared but at an anchor, and no copy is left out.

Equal fingerprints, exact copies among them, are one before anything is copied. A link is told by the
home of its smaller end alone. A fingerprint has at most 2,080 others within two bits, so links grow
with fingerprints and not with the square of a group; tasks make stars of their links before they
write them.

Defined results: null, empty and wordless texts have the fingerprint zero, which links like any other;
rows with a null id have a fingerprint and join components, whose id is the smallest that isn't null
(null where there is none); rows that share an id are told apart by their texts; a tie of votes
leaves the bit unset; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, islice
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.components import LOCAL, _stars, components
from findery.scratch import few, materialize, shuffle_partitions

SIZE, SEED, BITS, FULL = 3, 42, 64, 1 << 16
_RUN = 1 << 16
_COPIES, _PAIRS = 1 << 20, 1 << 21
_FPS, _GATHERED = 1 << 17, 1 << 22  # fingerprints copied by a task, copies gathered by one


def votes(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, the highest first."""
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)


def fingerprint(text: str | None, size: int = SIZE, seed: int = SEED) -> int:
    import xxhash

    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return 0
    shingles = zip(*(own[k:] for k in range(size)), strict=False) if len(own) >= size else iter([own])
    total, n, digest = np.zeros(BITS, np.int64), 0, xxhash.xxh64_intdigest
    while part := [digest(b" ".join(s), seed) for s in islice(shingles, _RUN)]:
        total += votes(np.array(part, np.uint64))
        n += len(part)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big")


def _fingerprints(size: int, seed: int):
    def run(batches):
        for b in batches:
            made = np.array([fingerprint(t.as_py(), size, seed) for t in b["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, size: int = SIZE, seed: int = SEED) -> DataFrame:
    """``doc_id, fp`` (64 bits as a long), a row for each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints(size, seed), "doc_id long, fp long")


class Part:
    """A perfect code on ``width`` bits from bit ``low`` on, by the check column of each bit; ``radius`` is how many errors it corrects."""

    def __init__(self, low: int, columns: list[int], radius: int, most: int):
        """``most``: distance beyond the radius up to which error patterns are listed."""
        self.low, self.columns, self.radius, self.width = low, columns, radius, len(columns)
        checks, made = np.array(columns, np.int64), []
        for weight in range(min(self.width, radius + most) + 1):
            bits = np.array(list(combinations(range(self.width), weight)), np.int64).reshape(comb(self.width, weight), weight)
            pattern = (np.uint64(1) << bits.astype(np.uint64)).sum(1, dtype=np.uint64)
            made.append((pattern, np.bitwise_xor.reduce(checks[bits], axis=1) if weight else np.zeros(1, np.int64), np.full(len(bits), max(0, weight - radius))))
        p, s, e = (np.concatenate(x) for x in zip(*made, strict=True))
        o = np.lexsort((p, e, s))
        self.patterns, self.excess = p[o] << np.uint64(low), e[o]
        n = max(1, max(columns, default=0)).bit_length()
        self.first = np.searchsorted(s[o], np.arange((1 << n) + 1))
        # count[s, x]: patterns of syndrome s with an excess of x or less, which come first
        key, ask = s[o] * (most + 1) + e[o], np.arange(1 << n)[:, None] * (most + 1) + np.arange(most + 1)
        self.count = np.searchsorted(key, ask, side="right") - self.first[:-1, None]

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for i, c in enumerate(self.columns):
            out ^= (words >> np.uint64(self.low + i) & np.uint64(1)).astype(np.int64) * c
        return out


def golay(low: int, most: int) -> Part:
    """The perfect binary Golay code of 23 bits: the check column of bit i is x**i modulo x**11 + x**10 + x**6 + x**5 + x**4 + x**2 + 1."""
    columns, x = [], 1
    for _ in range(23):
        columns.append(x)
        x <<= 1
        x ^= 0b110001110101 if x >> 11 else 0
    return Part(low, columns, 3, most)


def hamming(low: int, checks: int, most: int) -> Part:
    """The perfect Hamming code of 2**checks - 1 bits."""
    return Part(low, list(range(1, 1 << checks)), 1, most)


def free(low: int, width: int, most: int) -> Part:
    """All words of ``width`` bits, each its own anchor."""
    return Part(low, [0] * width, 0, most)


@lru_cache
def _parts(name: str, t: int) -> list[Part]:
    """Built once for each worker."""
    return [golay(0, t), golay(23, t), hamming(46, 4, t), hamming(61, 2, t)] if name == "coarse" else [hamming(0, 6, t), free(63, 1, t)]


class Code:
    """A product of codes that cover all bits, for a threshold ``t``."""

    def __init__(self, name: str, t: int):
        self.name, self.t = name, t

    @property
    def parts(self) -> list[Part]:
        return _parts(self.name, self.t)

    def homes(self, words: np.ndarray) -> np.ndarray:
        out = words.copy()
        for p in self.parts:
            out ^= p.patterns[p.first[p.syndrome(words)]]
        return out

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which word, anchor) of all anchors within radius and threshold of each word."""
        who, at, left = np.arange(len(words)), words.copy(), np.full(len(words), self.t)
        for p in self.parts:
            s = p.syndrome(words)[who]
            n = p.count[s, left]
            place = np.repeat(p.first[s] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            who, at, left = np.repeat(who, n), np.repeat(at, n) ^ p.patterns[place], np.repeat(left, n) - p.excess[place]
        return who, at

    def mean(self) -> int:
        """How many anchors a word reaches, in the mean over all words."""
        return max(1, self.most() * self._size() >> BITS)

    def _size(self) -> int:
        """How many anchors there are."""
        return 1 << sum(p.width - max(max(p.columns), 0).bit_length() for p in self.parts)

    def most(self) -> int:
        """How many different words can reach one anchor."""
        by = np.zeros(self.t + 1, np.int64)
        by[0] = 1
        for p in self.parts:
            own = np.array([sum(1 for _ in p.excess[p.excess == x]) for x in range(self.t + 1)])
            by = np.array([sum(by[i] * own[x - i] for i in range(x + 1)) for x in range(self.t + 1)])
        return int(by.sum())


def _copies(code: Code):
    def run(batches):
        step = max(1, _COPIES // 256)
        for b in batches:
            fps = np.asarray(b["fp"]).view(np.uint64)
            for a in range(0, len(fps), step):
                part = fps[a : a + step]
                who, at = code.anchors(part)
                yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), pa.array(part[who].view(np.int64))], names=["anchor", "fp"])

    return run


def near(homes: np.ndarray, came: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a of ``homes``, b of ``came``) with a < b that differ in at most t bits."""
    left, right = [], []
    rows = max(1, _PAIRS // max(1, len(came)))
    for i in range(0, len(homes), rows):
        own = homes[i : i + rows]
        a, b = np.nonzero((np.bitwise_count(own[:, None] ^ came[None, :]) <= t) & (own[:, None] < came[None, :]))
        left.append(own[a])
        right.append(came[b])
    return np.concatenate(left or [homes[:0]]), np.concatenate(right or [homes[:0]])


def _binary(x: np.ndarray) -> pa.Array:
    """Fingerprints as eight bytes that sort as they do."""
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((8 * np.arange(len(x) + 1)).astype(np.int32)), pa.py_buffer(x.astype(">u8").tobytes())])


def _meet(code: Code, full: int):
    """Rows sorted by anchor -> links ``a, b``, as stars of up to ``LOCAL`` of a task's links at a time; ``a`` alone for the fingerprints of an anchor that more than ``full`` came to."""
    none = np.zeros(0, np.uint64)
    shape = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def compared(anchors, fps) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        home = code.homes(fps) == anchors
        new = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
        size = np.diff(np.r_[new, len(anchors)])
        some = (np.add.reduceat(home.astype(np.int64), new) > 0) & (size > 1)
        for a, n in zip(new[some], size[some], strict=True):
            came = fps[a : a + n]
            yield near(came[home[a : a + n]], came, code.t)

    def pairs(batches) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """Pairs, or a crowd and nothing. What is held of one anchor never exceeds ``full`` and a batch."""
        anchors, fps, crowd = none, none, None
        for b in batches:
            anchors = np.concatenate([anchors, np.asarray(b["anchor"]).view(np.uint64)])
            fps = np.concatenate([fps, np.asarray(b["fp"]).view(np.uint64)])
            if not len(anchors):
                continue
            if crowd is not None:
                own = int(np.searchsorted(anchors.view(np.int64), crowd, side="right"))
                if own:
                    yield fps[:own], None
                anchors, fps = anchors[own:], fps[own:]
                if not len(anchors):
                    continue
                crowd = None
            signed = anchors.view(np.int64)
            new = np.flatnonzero(np.r_[True, signed[1:] != signed[:-1]])
            size = np.diff(np.r_[new, len(signed)])
            last = new[-1]
            over = size > full
            calm = np.repeat(~over, size)
            calm[last:] = False
            if calm.any():
                yield from compared(anchors[calm], fps[calm])
            for a, n in zip(new[over], size[over], strict=True):
                yield fps[a : a + n], None
            if over[-1]:
                crowd = signed[-1]
                anchors, fps = none, none
            else:
                anchors, fps = anchors[last:], fps[last:]
        if len(anchors):
            yield from compared(anchors, fps)

    def run(batches):
        held, n = [], 0
        for a, b in pairs(batches):
            if b is None:
                yield pa.RecordBatch.from_arrays([_binary(a), pa.nulls(len(a), pa.binary())], schema=shape)
            elif len(a):
                held.append((a, b))
                n += len(a)
                if n > LOCAL:
                    yield _stars(*(_binary(np.concatenate(x)) for x in zip(*held, strict=True)))
                    held, n = [], 0
        if held:
            yield _stars(*(_binary(np.concatenate(x)) for x in zip(*held, strict=True)))

    return run


def _met(fps: DataFrame, code: Code, full: int) -> DataFrame:
    """``fps``: a written table. What a task makes or gathers is bounded by dealing it to as many tasks as its count asks for."""
    spark, n = fps.sparkSession, fps.count()
    made = fps.select("fp").repartition(max(spark.sparkContext.defaultParallelism, n // _FPS))
    copies = made.mapInArrow(_copies(code), "anchor long, fp long")
    parts = max(shuffle_partitions(spark), n * code.mean() // _GATHERED)
    return copies.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(_meet(code, full), "a binary, b binary")


def links(fps: DataFrame, t: int = 2, full: int = FULL) -> DataFrame:
    """``fp``, distinct -> ``a, b`` (binary): links that join what is within ``t`` bits, as a written table."""
    fine = Code("fine", t)
    met = materialize(_met(fps, Code("coarse", t), full), "simhash-met", exchanged=True)
    crowded = met.filter("b IS NULL").select("a").distinct()
    if not crowded.limit(1).count():
        return met
    again = materialize(crowded.select(F.conv(F.hex("a"), 16, -10).cast("long").alias("fp")), "simhash-crowded", exchanged=True)
    anew = materialize(_met(again, fine, fine.most()), "simhash-anew", exchanged=True)
    return met.filter("b IS NOT NULL").unionByName(anew)


def classes(docs: DataFrame, t: int = 2, size: int = SIZE, seed: int = SEED, full: int = FULL) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, fp, component_id``: the smallest id that links lead to, a row for each row."""
    rows = materialize(fingerprints(docs, size, seed), "simhash-rows")
    own = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fingerprints", exchanged=True)
    stars = components(links(own, t, full))
    key = F.unhex(F.lpad(F.hex("fp"), 16, "0"))
    of = own.withColumn("key", key).join(stars, F.col("key") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "key").alias("component"))
    named = of.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = of.join(named, "component").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(ids, rows["fp"] == ids["_fp"]).select("doc_id", "fp", "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return few(found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
