"""Phrase collocations mined from positional inverted lists.

Documents are read a block at a time. A block's words become inverted lists: for each (language,
word) the ascending positions where it stands, counted so that only neighbours within a piece are
one apart. A phrase's list is extended by merge-joining its positions, moved by its length, with the
postings of the words that may follow; what meets is the list of the longer phrase, and its length
the phrase's exact frequency in the block. Frequencies of all blocks are added by Spark, and the
phrases that reach ``least`` lead to the next length, which reads the documents anew.

A word is known by the 64-bit hash of its language and itself. The count of words has them as
strings, and is repeated with another seed if two words ever share a hash, so that a phrase's key,
the hashes of its words side by side, is exact. Blocks learn which phrases are frequent from a bit
array of ``2 ** FILTER_BITS`` bits, the same size for any corpus: a phrase that it lets through by
mistake is extended in vain and falls to its count. Where there are so many frequent phrases that the
array is full, every phrase is extended, which costs a count of all phrases of a length and nothing else.

Every key is aggregated within its block and its task before it is shuffled, so a phrase that stands
in every document is a row for each task. Joins are among frequent phrases alone; those of one
language meet only after ``salts`` of it have been cut to ``top`` each.

Defined results: a null text has no words; a null language is ``und``, together with documents whose
language is that string; repeated rows count each; null, repeated and clashing ids and other columns
don't matter; a document longer than a block is a block of its own; an empty table gives no rows.
Scores are exact for languages of up to 10**15 words, beyond which Spark's decimals raise an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from findery.llm.words import mix, slices
from findery.scratch import few, materialize

LEAST, LONGEST, COVER, TOP = 10, 3, 50, 2000
BLOCK_BYTES, FILTER_BITS, PROBES, SALTS = 1 << 21, 27, 3, 32
UNKNOWN = "und"

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_R = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Postings:
    """Words of a block in the order of their positions, by number; ``hashes`` of the numbers, and what they stand for."""

    position: np.ndarray
    number: np.ndarray
    hashes: np.ndarray
    lang: pa.Array
    word: pa.Array


@dataclass
class Lists:
    """Positional lists of phrases: ``keys`` has a row of word numbers for each, whose positions are ``at[first[i] : first[i + 1]]``, ascending."""

    keys: np.ndarray
    first: np.ndarray
    at: np.ndarray

    def lengths(self) -> np.ndarray:
        return np.diff(self.first)

    def only(self, keep: np.ndarray) -> Lists:
        n = self.lengths()
        return Lists(self.keys[keep], np.r_[0, np.cumsum(n[keep])], self.at[np.repeat(keep, n)])


def postings(texts: pa.Array, langs: pa.Array, seed: int) -> Postings:
    import xxhash

    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]]
    at, n = offsets - offsets[0], len(data)
    kind = _KIND[data]
    solid = kind == 0
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    edge = at[(at > 0) & (at < n)]
    begins[edge] |= solid[edge]
    ends[edge - 1] |= solid[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    doc = np.searchsorted(at, start, side="right") - 1
    position = np.arange(len(start)) + np.cumsum(kind == 2, dtype=np.int32)[start] + doc
    cells = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(np.r_[0, np.cumsum(end - start)].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[solid]))]).dictionary_encode()
    own = langs.fill_null(UNKNOWN).dictionary_encode()
    pair, number = np.unique(np.asarray(cells.indices).astype(np.int64) * len(own.dictionary) + np.asarray(own.indices)[doc], return_inverse=True)
    lang, word = own.dictionary.take(pa.array(pair % max(1, len(own.dictionary)))), cells.dictionary.take(pa.array(pair // max(1, len(own.dictionary))))
    text = [a.encode() + b"\xff" + w for a, w in zip(lang.to_pylist(), word.to_pylist(), strict=True)]
    hashes = np.array([xxhash.xxh64_intdigest(t, seed) for t in text], np.uint64)
    return Postings(position, number, hashes, lang, word.cast(pa.large_string()))


def grouped(keys: np.ndarray, at: np.ndarray) -> Lists:
    """Lists of occurrences given one by one in the order of their positions, with a key each."""
    code, most = keys[:, 0].astype(np.int64), int(keys[:, 0].max(initial=0)) + 1
    for j in range(1, keys.shape[1]):
        width = int(keys[:, j].max(initial=0)) + 1
        if most * width >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            most = len(code) + 1
        code, most = code * width + keys[:, j], most * width
    o = np.argsort(code, kind="stable")
    code = code[o]
    new = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, int)
    return Lists(keys[o[new]], np.r_[new, len(code)], at[o])


def extend(lists: Lists, words: Postings, may: np.ndarray) -> Lists:
    """Lists of the phrases one word longer: each list's positions, moved by its length, meet the postings of the words that ``may`` follow.

    All lists are merged in one pass: a position begins one phrase of a length, so a posting finds by
    its own position, moved back, the list that it extends.
    """
    follows = may[words.number]
    position, number = words.position[follows], words.number[follows]
    owner = np.full((int(words.position[-1]) if len(words.position) else 0) + 1, -1, np.int32)
    owner[lists.at] = np.repeat(np.arange(len(lists.keys), dtype=np.int32), lists.lengths())
    start = position - lists.keys.shape[1]
    met = start >= 0
    met[met] = owner[start[met]] >= 0
    start, number = start[met], number[met]
    return grouped(np.column_stack([lists.keys[owner[start]], number]), start)


def _probes(keys: list[np.ndarray]) -> list[np.ndarray]:
    """Where a phrase's bits are, by its words' hashes."""
    x = np.full(len(keys[0]), np.uint64(len(keys)))
    for k in keys:
        x = mix(x * _R + k)
    return [mix(x + step) >> np.uint64(64 - FILTER_BITS) for step in np.arange(PROBES, dtype=np.uint64) * _R]


def _bits(names: list[str]):
    def run(batches):
        for b in batches:
            at = np.concatenate(_probes([np.asarray(b[c]).view(np.uint64) for c in names]))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["cell", "bits"])

    return run


def bit_filter(phrases: DataFrame, names: list[str]) -> np.ndarray:
    """The bit array of the phrases' keys, or-ed together by Spark: the driver gets ``2 ** FILTER_BITS`` bits at most."""
    cells = phrases.select(names).mapInArrow(_bits(names), "cell int, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[np.asarray(cells["cell"])] = np.asarray(cells["bits"]).view(np.uint64)
    return out


def passes(bits: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
    out = np.ones(len(keys[0]), bool)
    for at in _probes(keys):
        out &= (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _names(width: int) -> list[str]:
    return [f"h{j}" for j in range(width)]


def _words(seed: int):
    def run(batches):
        for b in slices(batches, "text", BLOCK_BYTES):
            p = postings(b["text"], b["lang"], seed)
            n = np.bincount(p.number, minlength=len(p.hashes))
            yield pa.RecordBatch.from_arrays([pa.array(p.hashes.view(np.int64)), p.lang.cast(pa.string()), p.word.cast(pa.string()), pa.array(n, pa.int64())], names=["h0", "lang", "word", "f"])

    return run


def _phrases(width: int, seed: int, filters):
    """Lengths of the lists of ``width`` words in each block; ``filters``: broadcast bit arrays by length, from one word on."""

    def run(batches):
        bits = filters.value
        for b in slices(batches, "text", BLOCK_BYTES):
            p = postings(b["text"], b["lang"], seed)
            may = passes(bits[0], [p.hashes])
            lists = grouped(p.number[may[p.number], None], p.position[may[p.number]])
            for size in range(2, width + 1):
                lists = extend(lists, p, may)
                shown = min(size, width - 1)  # of the longest ones, both shorter parts have to be frequent
                if shown > 1:
                    good = np.ones(len(lists.keys), bool)
                    for j in range(size - shown + 1):
                        good &= passes(bits[shown - 1], [p.hashes[lists.keys[:, i]] for i in range(j, j + shown)])
                    lists = lists.only(good)
            cols = [pa.array(p.hashes[lists.keys[:, j]].view(np.int64)) for j in range(width)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lists.lengths(), pa.int64())], names=[*_names(width), "f"])

    return run


def frequencies(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, dict[int, DataFrame]]:
    """(``h0, lang, word, f`` of all words, by length the phrases with f >= ``least`` as ``h0.. , f``), written tables."""
    spark = docs.sparkSession
    read = docs.select("text", F.col("lang").cast("string").alias("lang"))
    for seed in range(16):
        counts = read.mapInArrow(_words(seed), "h0 long, lang string, word string, f long").groupBy("h0", "lang", "word").agg(F.sum("f").alias("f"))
        words = materialize(counts, "phrase-words", exchanged=True)
        if not words.groupBy("h0").count().filter("count > 1").limit(1).count():
            break
    else:
        raise RuntimeError("words share hashes under every seed")
    found, bits = {1: words.filter(F.col("f") >= least)}, []
    for width in range(2, longest + 1):
        bits.append(bit_filter(found[width - 1], _names(width - 1)))
        shape = ", ".join(f"{c} long" for c in [*_names(width), "f"])
        own = read.mapInArrow(_phrases(width, seed, spark.sparkContext.broadcast(bits)), shape)
        found[width] = materialize(own.groupBy(_names(width)).agg(F.sum("f").alias("f")).filter(F.col("f") >= least), "phrases", exchanged=True)
    return words, found


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), in decimals of 38 digits."""
    d = lambda c: c.cast("decimal(19,0)")
    over = (d(a) * d(a)).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", over.cast("decimal(38,0)"), (d(left) * d(right)).cast("decimal(38,0)"))


def candidates(found: dict[int, DataFrame], cover: int = COVER) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of all phrases of two words or more that no longer one covers."""
    longest = max(found)
    single = found[1]
    out = []
    for width in range(2, longest + 1):
        rows = found[width].withColumnRenamed("f", "a")
        for j in range(width):
            own = single.select(F.col("h0").alias(f"h{j}"), F.col("word").alias(f"w{j}"), F.col("f").alias(f"f{j}_{j + 1}"), *([F.col("lang")] if not j else []))
            rows = rows.join(own, f"h{j}")
        for size in range(2, width):
            for j in {0, width - size}:
                own = found[size].select(*(F.col(f"h{i}").alias(f"h{j + i}") for i in range(size)), F.col("f").alias(f"f{j}_{j + size}"))
                rows = rows.join(own, [f"h{j + i}" for i in range(size)])
        inside = None
        for size in range(width + 1, longest + 1):
            for j in range(size - width + 1):
                part = found[size].select(*(F.col(f"h{j + i}").alias(f"h{i}") for i in range(width)), F.col("f").alias("longer"))
                inside = part if inside is None else inside.unionByName(part)
        if inside is not None:
            most = inside.groupBy(_names(width)).agg(F.max("longer").alias("longer"))
            rows = rows.join(most, _names(width), "left").filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(cover) * F.col("a")))
        cuts = []
        for k in range(1, width):
            left, right = F.col(f"f0_{k}"), F.col(f"f{k}_{width}")
            cuts.append(F.struct(score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
        rows = rows.withColumn("cut", F.least(*cuts) if len(cuts) > 1 else cuts[0])
        out.append(rows.select("lang", F.concat_ws(" ", *(f"w{j}" for j in range(width))).alias("phrase"), "a", "cut.l", "cut.r", "cut.score"))
    every = out[0]
    for x in out[1:]:
        every = every.unionByName(x)
    return every


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, cover: int = COVER, top: int = TOP, salts: int = SALTS) -> DataFrame:
    """``text, lang`` -> ``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases by score."""
    words, found = frequencies(docs, least, longest)
    rows = candidates(found, cover).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    for keys in (["lang", "salt"], ["lang"]):
        rows = rows.withColumn("rank", F.row_number().over(W.partitionBy(keys).orderBy(*order))).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return rows.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few(mine(spark.read.parquet(f"{sf_dir}/documents.parquet")))


_CUT = "[.,;:!?\\x0A-\\x0D]"
ORACLE_SQL = rf"""
WITH p AS (SELECT lang, row_number() OVER () AS p, string_split_regex(x, '[\x20\x09]+') AS ws FROM (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_CUT}')) AS x FROM documents)),
w AS (SELECT lang, p, list_filter(ws, lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, unnest(ws) AS a, NULL AS b, NULL AS c FROM w
  UNION ALL SELECT lang, ws[i], ws[i + 1], NULL FROM (SELECT lang, ws, unnest(range(1, len(ws))) AS i FROM w)
  UNION ALL SELECT lang, ws[i], ws[i + 1], ws[i + 2] FROM (SELECT lang, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
f AS (SELECT lang, a, b, c, count(*) AS f FROM g GROUP BY ALL),
f1 AS (SELECT lang, a, f FROM f WHERE b IS NULL), f2 AS (SELECT lang, a, b, f FROM f WHERE b IS NOT NULL AND c IS NULL), f3 AS (SELECT * FROM f WHERE c IS NOT NULL AND f >= {LEAST}),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
cut AS (SELECT f3.lang, f3.a || ' ' || f3.b || ' ' || f3.c AS phrase, f3.f AS a, unnest([{{'k': 1, 'l': x.f, 'r': yz.f}}, {{'k': 2, 'l': xy.f, 'r': z.f}}]) AS s
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.a = f3.a JOIN f1 z ON z.lang = f3.lang AND z.a = f3.c
  JOIN f2 xy ON xy.lang = f3.lang AND xy.a = f3.a AND xy.b = f3.b JOIN f2 yz ON yz.lang = f3.lang AND yz.a = f3.b AND yz.b = f3.c
  UNION ALL SELECT f2.lang, f2.a || ' ' || f2.b, f2.f, {{'k': 1, 'l': x.f, 'r': y.f}} FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.a = f2.a JOIN f1 y ON y.lang = f2.lang AND y.a = f2.b
  WHERE f2.f >= {LEAST} AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.f >= {COVER} * f2.f AND (f3.a = f2.a AND f3.b = f2.b OR f3.b = f2.a AND f3.c = f2.b))),
scored AS (SELECT lang, phrase, a, s.k AS k, s.l AS l, s.r AS r, (1000000::HUGEINT * a * a // (s.l::HUGEINT * s.r))::BIGINT AS score FROM cut),
worst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored) WHERE nth = 1),
r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, score FROM worst)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= {TOP}
"""
