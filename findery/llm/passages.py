"""Removing passages that repeat across documents, by level-wise doubling.

Lengths double up to the window asked for (13 words: 7, then 13, two sevens that share a word).
At a length only those windows are looked at whose part of the length before it repeats; of the
first length, each window's part is the one with the smallest hash, so that a fraction of all
windows travels. At the last length, a window goes from every document but the one with the
smallest ``doc_id`` that has it, judged on the input alone, and every word that one of those
windows covers is removed.

Each batch of rows settles by itself what repeats within it and asks, once for a hash, the task
that has the hash's part of all hashes, so that a passage that a third of all documents share
costs a row per batch. Answers go back to the document by id and text hash.

Defined results: a null or empty text has no words; documents of fewer words than a window lose
nothing; rows with one ``doc_id`` don't take from each other; rows with a null ``doc_id`` take no
part and keep everything; an empty table gives no rows. Columns besides doc_id and text are kept
by ``remove_repeats`` and replaced where they are called n_words or n_removed.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.words import mix, slices, windows, words

WINDOW, BASE = 13, 7
PART_BYTES, SLICE_BYTES = 1 << 25, 1 << 23
_DOC = np.dtype([("doc", "<i8"), ("text", "<u8")])
_BULK = "part int, docs binary, counts binary, hashes binary, more binary, at binary"
_LOW = np.uint64(0xFFFFFFFF)
_NAMES = ["part", "docs", "counts", "hashes", "more", "at"]
_TELL = "_rep_id long, _rep_hash long, _rep_found binary"


@dataclass
class Entries:
    """Windows: hash (of ``more`` the second part, at the last length), the document's id and text hash (0: several documents), where the window starts."""

    hash: np.ndarray
    more: np.ndarray
    doc: np.ndarray
    text: np.ndarray
    at: np.ndarray

    def __getitem__(self, o) -> Entries:
        return Entries(self.hash[o], self.more[o], self.doc[o], self.text[o], self.at[o])

    def __len__(self) -> int:
        return len(self.hash)


def _joined(parts: list[Entries]) -> Entries:
    kinds = ("u8", "u4", "i8", "u8", "u4")
    return Entries(*(np.concatenate([np.zeros(0, k), *(getattr(p, f) for p in parts)]) for f, k in zip(("hash", "more", "doc", "text", "at"), kinds, strict=True)))


def lengths(window: int = WINDOW, base: int = BASE) -> list[int]:
    """Halved from ``window`` down to the first that is ``base`` or less; each is at most twice the one before."""
    out = [window]
    while out[0] > base:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _inside(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that lie in one document, and their documents (from 0)."""
    count = np.maximum(np.diff(first) - length + 1, 0)
    doc = np.repeat(np.arange(len(count)), count)
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[doc], doc


def _smallest(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n values in a row."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[: len(x) - width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


def _parts(hashes: np.ndarray, level: int, sizes: list[int]) -> np.ndarray:
    """For each run of ``sizes[level]`` words, the hash that had to repeat at the length before."""
    before = windows(hashes, sizes[level - 1])
    return _smallest(before, sizes[level] - sizes[level - 1] + 1)


def _entries(b: pa.RecordBatch, level: int, sizes: list[int]) -> Entries:
    """What a batch's documents ask at a level: at the first, the smallest hashes of the length-to-come's windows; then, windows whose part repeats."""
    ids, texts = np.asarray(b["doc_id"].fill_null(0)), np.asarray(b["_rep_text"]).view(np.uint64)
    known = np.asarray(b["doc_id"].is_valid())
    last, out = level == len(sizes) - 1, []
    found = b["_rep_found"] if level else None
    for w in words(b["text"]):
        size = sizes[1] if level == 0 and not last else sizes[level]
        if len(w.hashes) < size:
            continue
        at, doc = _inside(w.first, size)
        if level == 0 and not last:
            values = _parts(w.hashes, 1, sizes)[at]
            fresh = np.r_[True, (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])] if len(at) else np.zeros(0, bool)
            ok = known[doc + w.low] & fresh
            at, doc, values = at[ok], doc[ok], values[ok] & _LOW
        else:
            ok = known[doc + w.low]
            if level:
                values, flagged = _parts(w.hashes, level, sizes)[at] & _LOW, np.zeros(len(at), bool)
                bound = np.searchsorted(doc, np.arange(w.high - w.low + 1))
                for i in range(w.high - w.low):
                    told = found[w.low + i].as_py()
                    if told:
                        part = slice(bound[i], bound[i + 1])
                        flagged[part] = np.isin(values[part], np.frombuffer(told, "<u4").astype(np.uint64))
                ok &= flagged
            at, doc = at[ok], doc[ok]
            values = windows(w.hashes, sizes[level])[at]
            if not last:
                values = values & _LOW
        more = (windows(mix(w.hashes), sizes[level], 1)[at] >> np.uint64(32)).astype(np.uint32) if last else np.zeros(len(at), np.uint32)
        out.append(Entries(values, more, ids[doc + w.low], texts[doc + w.low], (at - w.first[doc]).astype(np.uint32)))
    e = _joined(out)
    if not last and len(e):
        e = e[np.lexsort((e.text, e.hash))]
        e = e[np.r_[True, (e.hash[1:] != e.hash[:-1]) | (e.text[1:] != e.text[:-1])]]
    return e


def _settle(e: Entries, last: bool) -> tuple[Entries, Entries]:
    """(entries answered yes, entries that stand for the rest). Same hashes form a group.

    Before the last length all of a group of two texts or more are answered, and one entry of no
    text stands for them; at the last, those of all but the smallest document are answered.
    """
    if not len(e):
        return e, e
    e = e[np.lexsort((e.doc, e.more, e.hash) if last else (e.text, e.hash))]
    first = np.r_[True, (e.hash[1:] != e.hash[:-1]) | (e.more[1:] != e.more[:-1])]
    group, start = np.cumsum(first) - 1, np.flatnonzero(first)
    if last:
        yes = e.doc > e.doc[start][group]
        return e[yes], e[~yes]
    end = np.r_[start[1:], len(e)] - 1
    yes = ((e.text[start] != e.text[end]) | (e.text[start] == 0))[group]
    stands = e[~yes | first]
    stands.text[yes[~yes | first]] = 0
    return e[yes & (e.text != 0)], stands


def _deal(e: Entries, where: np.ndarray, parts: int, last: bool, number, told: bool = False) -> list[tuple]:
    """A row per part: each document once, how many entries it has, and those. ``told``: answers, which at the last length are places alone."""
    o = np.lexsort((e.at, e.text, e.doc, where))
    e, where, rows = e[o], where[o], []
    bound = np.searchsorted(where, np.arange(parts + 1))
    for p in range(parts):
        x = e[bound[p] : bound[p + 1]]
        if len(x):
            first = np.flatnonzero(np.r_[True, (x.text[1:] != x.text[:-1]) | (x.doc[1:] != x.doc[:-1])])
            docs = np.zeros(len(first), _DOC)
            docs["doc"], docs["text"] = x.doc[first], x.text[first]
            counts = np.diff(np.r_[first, len(x)]).astype("<u4")
            step = x.at.astype(np.int64) - np.r_[0, x.at[:-1]]
            step[first] = x.at[first]
            hashes = b"" if last and told else x.hash.astype("<u8" if last else "<u4").tobytes()
            more = x.more.tobytes() if last and not told else b""
            at = step.astype("<u4").tobytes() if last else b""
            rows.append((number(p), docs.tobytes() if last else docs["text"].tobytes(), counts.tobytes(), hashes, more, at))
    return rows


def _bulk(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=_NAMES)


def _unpack(table: pa.Table, last: bool) -> Entries:
    out = []
    for docs, counts, hashes, more, at in zip(*(table[c] for c in _NAMES[1:]), strict=True):
        whole = lambda x, k: np.frombuffer(x.as_buffer(), k)
        n = whole(counts, "<u4")
        of = np.repeat(np.arange(len(n)), n)
        h = whole(hashes, "<u8" if last else "<u4").astype(np.uint64)
        if last and not len(h):
            h, more = np.zeros(len(of), np.uint64), pa.scalar(bytes(4 * len(of)), pa.binary())
        if last:
            d, step = whole(docs, _DOC), whole(at, "<u4").astype(np.int64)
            total, begin = np.cumsum(step), np.cumsum(n) - n
            out.append(Entries(h, whole(more, "<u4"), d["doc"][of], d["text"][of], (total - np.repeat(total[begin] - step[begin], n)).astype(np.uint32)))
        else:
            none = np.zeros(len(h), np.uint32)
            out.append(Entries(h, none, np.zeros(len(h), np.int64), whole(docs, "<u8")[of], none))
    return _joined(out)


def _ask(level: int, sizes: list[int], parts: int):
    """Rows to the tasks that know a part of the hashes; answers that a batch could give itself go along, in parts of their own (below 0)."""
    last = level == len(sizes) - 1

    def run(batches):
        for b in slices(batches, "text", SLICE_BYTES):
            yes, rest = _settle(_entries(b, level, sizes), last)
            rows = _deal(rest, mix(rest.hash) % np.uint64(parts), parts, last, lambda p: p)
            yield _bulk(rows + _deal(yes, yes.text % np.uint64(parts), parts, last, lambda p: -1 - p, told=True))

    return run


def _answer(last: bool, parts: int):
    """Answers to the parts of the documents."""

    def run(table: pa.Table) -> pa.Table:
        e = _unpack(table, last)
        yes = e if table["part"][0].as_py() < 0 else _settle(e, last)[0]
        return pa.Table.from_batches([_bulk(_deal(yes, yes.text % np.uint64(parts), parts, last, lambda p: p, told=True))])

    return run


def _tell(last: bool):
    """A row per document with all its answers: the hashes, or at the last length the places."""

    def run(table: pa.Table) -> pa.Table:
        e = _unpack(table, last)
        values = e.at if last else e.hash.astype(np.uint32)
        o = np.lexsort((values, e.text, e.doc))
        e, values = e[o], values[o]
        first = np.flatnonzero(np.r_[True, (e.doc[1:] != e.doc[:-1]) | (e.text[1:] != e.text[:-1])]) if len(e) else np.zeros(0, int)
        bound = np.r_[first, len(e)]
        cells = [values[a:b].tobytes() for a, b in zip(bound[:-1], bound[1:], strict=True)]
        return pa.table({"_rep_id": pa.array(e.doc[first], pa.int64()), "_rep_hash": pa.array(e.text[first].view(np.int64), pa.int64()), "_rep_found": pa.array(cells, pa.binary())})

    return run


def find(docs: DataFrame, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """``docs`` (``doc_id, text, _rep_text`` and more) with ``_rep_found``: where windows start that a document with a smaller id has too."""
    sizes = lengths(window, base)
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(16, total // PART_BYTES)
    told = docs
    for level in range(len(sizes)):
        last = level == len(sizes) - 1
        needed = ["doc_id", "text", "_rep_text"] + ["_rep_found"] * bool(level)
        asked = told.select(*needed).mapInArrow(_ask(level, sizes, parts), _BULK)
        answers = asked.groupBy("part").applyInArrow(_answer(last, parts), _BULK).groupBy("part").applyInArrow(_tell(last), _TELL)
        same = docs["_rep_text"] == answers["_rep_hash"]  # one key at all levels: the documents' exchange is made once
        if last:
            same = same & (F.abs(docs["doc_id"] - answers["_rep_id"]) < 1)
        told = docs.join(answers.hint("shuffle_hash"), same, "left").select(docs["*"], answers["_rep_found"])
    return told


def _covered(found: bytes | None, n: int, window: int) -> np.ndarray:
    change = np.zeros(n + 1, dtype=np.int64)
    if found:
        at = np.frombuffer(found, "<u4").astype(np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, np.minimum(at + window, n), -1)
    return np.cumsum(change[:n]) > 0


def _remove(window: int, digest: bool):
    def run(batches):
        for b in slices(batches, "text", SLICE_BYTES):
            n_words, n_removed, kept = [], [], []
            for text, found in zip(b["text"].to_pylist(), b["_rep_found"].to_pylist(), strict=True):
                if not found and not digest:
                    n_words.append(len((text or "").encode().split()))
                    n_removed.append(0)
                    kept.append(text)
                    continue
                ws = (text or "").encode().split()
                gone = _covered(found, len(ws), window)
                left = b" ".join([w for w, g in zip(ws, gone.tolist(), strict=True) if not g] if found else ws)
                n_words.append(len(ws))
                n_removed.append(int(gone.sum()))
                kept.append(hashlib.sha256(left).hexdigest() if digest else left.decode())
            rest = [b[c] for c in b.schema.names if c not in ("text", "_rep_text", "_rep_found")]
            names = [c for c in b.schema.names if c not in ("text", "_rep_text", "_rep_found")]
            cols = [*rest, pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "kept", "n_words", "n_removed"])

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, base: int = BASE, digest: bool = False) -> DataFrame:
    """All columns of ``docs`` but text, and ``kept`` (the words left joined by spaces, the text itself where nothing is removed, or a digest), ``n_words, n_removed``."""
    plain = docs.drop("n_words", "n_removed", "kept", "_rep_text", "_rep_found").withColumn("_rep_text", F.coalesce(F.nullif(F.xxhash64("doc_id", "text"), F.lit(0)), F.lit(1).cast("long")))
    told = find(plain, window, base)
    shape = ", ".join(f"`{c}` {t}" for c, t in plain.dtypes if c not in ("text", "_rep_text"))
    return told.mapInArrow(_remove(window, digest), f"{shape}, kept string, n_words long, n_removed long")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = remove_repeats(docs, digest=True)
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
w AS (SELECT n, doc_id, i, ws[i : i + {WINDOW - 1}] AS seq FROM (SELECT n, doc_id, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i FROM d)),
f AS (SELECT seq, min(doc_id) AS first FROM w WHERE doc_id IS NOT NULL GROUP BY seq),
r AS (SELECT DISTINCT n, unnest(generate_series(i, i + {WINDOW - 1})) AS i FROM w JOIN f USING (seq) WHERE first < doc_id),
g AS (SELECT n, list(i) AS gone FROM r GROUP BY n),
k AS (SELECT n, coalesce(array_to_string(list(word ORDER BY i), ' '), '') AS kept FROM
   (SELECT n, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS i FROM d) x WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.n = x.n AND r.i = x.i) GROUP BY n)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (n) LEFT JOIN k USING (n)
"""
