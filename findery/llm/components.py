"""Connected components of a graph given as a table of links: contraction within tasks, then alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from findery.scratch import materialize

LOCAL = 1 << 18


def _stars(a: pa.Array, b: pa.Array) -> pa.RecordBatch:
    """(node, smallest node of its component) of every node but the smallest, by these links alone."""
    coded = pa.concat_arrays([a, b]).dictionary_encode()
    nodes = coded.dictionary.take(order := pc.array_sort_indices(coded.dictionary))
    place = np.empty(len(nodes), np.int64)
    place[np.asarray(order)] = np.arange(len(nodes))
    at = place[np.asarray(coded.indices)]
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for end in (x, y, label[x], label[y]):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([nodes.take(pa.array(own)), nodes.take(pa.array(label[own]))], names=["a", "b"])


def _contract(limit: int):
    """Every ``limit`` links of a task become stars about their components' smallest nodes."""

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for at in range(0, len(batch), limit):
                part = batch.slice(at, limit)
                if n + len(part) > limit:
                    yield _stars(*(pa.concat_arrays([h[c] for h in held]) for c in ("a", "b")))
                    held, n = [], 0
                held.append(part)
                n += len(part)
        if n:
            yield _stars(*(pa.concat_arrays([h[c] for h in held]) for c in ("a", "b")))

    return run


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _apart(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")))
    up = both.filter("b > a")
    return up.join(least, up["a"] == least["k"]).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(links: DataFrame) -> DataFrame:
    """``links``: a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    own = _apart(least)
    down = links.join(own, links["a"] == own["k"])
    return down.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _apart(least: DataFrame) -> DataFrame:
    """The key written anew, so that both sides of the join have an exchange of their own: then Spark can split the partition of a node that very many links lead to."""
    return least.select(F.concat("a", F.lit(bytearray())).alias("k"), "m")


def components(links: DataFrame, local: int = LOCAL) -> DataFrame:
    """``a, b`` (binary, a written table: it is counted, then read) -> ``node, component`` for every node but the smallest of its component, as a written table.

    Each task first contracts its own links, ``local`` at a time: up to so many links are done with
    that. More of them go on by rounds of large and small stars and contraction, each written to the
    shared folder, until a round changes nothing (the driver sees a count and a checksum); their
    number grows with the logarithm. Every exchange is by node, and no task holds more than ``local``
    links. Links of a node to itself and repeated links do nothing; no links give no rows.
    """
    shape = "a binary, b binary"
    parts = max(1, -(-links.count() // local))
    now = materialize(links.select("a", "b").coalesce(parts).mapInArrow(_contract(local), shape), "links")
    mark = lambda x: tuple(x.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())
    seen = mark(now) if parts > 1 else (0,)
    while seen[0]:
        now = materialize(_small(_large(now)).coalesce(parts).mapInArrow(_contract(local), shape).distinct(), "links")
        new = mark(now)
        if new == seen:
            break
        seen = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
