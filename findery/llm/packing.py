"""Packing token sequences by a harmonic rule, each worker on its own.

Class k takes pieces of which k fit into the capacity and k + 1 don't; a bin of class k is full with
exactly k pieces. Since documents may be cut, a document is full sequences (class
1), then the largest whole reciprocals ``capacity // k`` that fit what is left, until at most
``small`` tokens remain, which go to their own class uncut. Where a worker's rows end, the pieces
in its unfinished bins are laid end to end over sequences, and what doesn't fill one is dealt to
sequences whose lengths are powers of two, so that they need no padding.

A row is a piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``. Sequence ids are
distinct over the whole table: partition number, then a count. No shuffle takes place, memory is
bounded by one batch, one document and the unfinished bins (k - 1 pieces of each class, less than
a sequence's tokens for each class; a piece that waits is a copy, so that no document is held by it).

Defined results: a null or empty text has the closing id alone; a null or repeated ``doc_id``
is carried as it is, every row being a document of its own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.tokens import encoder

CAPACITY, SMALL, CLOSING = 2048, 64, 1
SHAPE = "doc_id long, start long, length long, ids array<int>, doc_tokens long, sequence_id long, offset long"
SUMS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


def cut(n: int, capacity: int = CAPACITY, small: int = SMALL) -> list[tuple[int, int]]:
    """(class, length) of the pieces of a document of n tokens."""
    pieces = [(1, capacity)] * (n // capacity)
    n %= capacity
    while n > small:
        length = capacity // -(-capacity // n)
        pieces.append((capacity // length, length))
        n -= length
    if n:
        pieces.append((capacity // n, n))
    return pieces


class Packer:
    """One worker's bins. ``add`` and ``finish`` return complete sequences: lists of (doc, start, length, ids), doc being what the caller likes.

    ``ids``: a document's array. Pieces of a sequence that is complete at once are views of it, those that wait are copies.
    """

    def __init__(self, capacity: int = CAPACITY, small: int = SMALL):
        self.capacity, self.small, self.open = capacity, small, {}

    def add(self, doc, ids: np.ndarray) -> list[list[tuple]]:
        full, start = [], 0
        for k, length in cut(len(ids), self.capacity, self.small):
            own = ids[start : start + length]
            if k == 1:
                full.append([(doc, start, length, own)])
            else:
                bin_ = self.open.setdefault(k, [])
                bin_.append((doc, start, length, own.copy()))
                if len(bin_) == k:
                    full.append(self.open.pop(k))
            start += length
        return full

    def waiting(self) -> int:
        """Bytes held by unfinished bins."""
        return sum((p[3] if p[3].base is None else p[3].base).nbytes for bin_ in self.open.values() for p in bin_)

    def finish(self) -> list[list[tuple]]:
        pieces = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(p[2] for p in pieces)
        sizes = [self.capacity] * (total // self.capacity) + [1 << b for b in reversed(range(self.capacity.bit_length())) if (total % self.capacity) >> b & 1]
        out = []
        for size in sizes:
            sequence, room = [], size
            while room:
                doc, start, length, ids = pieces.pop(0)
                took = min(length, room)
                sequence.append((doc, start, took, ids[:took]))
                room -= took
                if took < length:
                    pieces.insert(0, (doc, start + took, length - took, ids[took:]))
            out.append(sequence)
        return out


def _packed(name: str, capacity: int, small: int, sums: bool):
    def run(batches):
        encode, packer = encoder(name), Packer(capacity, small)
        sequence = None
        columns: list[list] = [[] for _ in range(8 if sums else 7)]
        schema = pa.schema([(n, t) for n, t in zip(["doc_id", "start", "length", "ids_crc32" if sums else "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens"], [pa.int64()] * 3 + [pa.int64() if sums else pa.list_(pa.int32())] + [pa.int64()] * 4)][: len(columns)])

        def put(sequences):
            nonlocal sequence
            for pieces in sequences:
                offset, total = 0, sum(p[2] for p in pieces)
                for (doc_id, tokens), start, length, ids in pieces:
                    row = doc_id, start, length, zlib.crc32(ids) if sums else ids, tokens, sequence, offset, total
                    for c, v in zip(columns, row, strict=False):
                        c.append(v)
                    offset += length
                sequence += 1

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            for c in columns:
                c.clear()
            return out

        for b in batches:
            if sequence is None and len(b):
                sequence = b["part"][0].as_py() << 32
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                ids = np.array([*encode(text.as_py() or ""), CLOSING], dtype="<u4")
                put(packer.add((doc_id, len(ids)), ids))
                if len(columns[0]) >= (20_000 if sums else 2_000):
                    yield flush()
        put(packer.finish())
        yield flush()

    return run


def pack(docs: DataFrame, name: str = "byte_bpe_50k.json", capacity: int = CAPACITY, small: int = SMALL) -> DataFrame:
    """Pieces with their token ids."""
    return docs.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(_packed(name, capacity, small, False), SHAPE)


def pack_sums(docs: DataFrame, name: str = "byte_bpe_50k.json", capacity: int = CAPACITY, small: int = SMALL) -> DataFrame:
    """The same pieces with the CRC-32 of their little-endian ids in place of the ids."""
    return docs.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(_packed(name, capacity, small, True), SUMS)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sums(spark.read.parquet(f"{sf_dir}/documents.parquet"))
