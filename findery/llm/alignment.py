"""Tokens of one tokenizer against those of another, by where they end in the text.

A slice of documents becomes the ids of its A and B tokens and the byte offsets where they end, going on
from one document to the next. Where both have an end, marked by byte, a group ends, and the tokens that
end there are linked. A token's place among all of both sides, group by group, is its number and that
of the other side's tokens in groups before it (in its own as well, for B), so no element is looked
for and nothing is sorted: some operations on whole arrays, linear in the tokens. The groups' text is
their ids' decimals, each with the sign behind it, taken from a table in that order.

Pairs of ids are counted over all links, added up within a task before they are shuffled. Counts come
back to the links in two ways that together are all of them: the ``COMMON`` most frequent pairs, a
table of bounded size, are broadcast, which deals with every pair that a task would otherwise gather
from the whole corpus; links of the other pairs are joined by pair. What is summed goes by row of
the written table, so rows that share an id are told apart.

The tokenizers are read from vocabulary files. Neither joins what is on two sides of a cut (``cuts``;
A's pattern takes white space with what follows it, and no piece of B has a space behind another
character), so a slice's distinct pieces are encoded once each; tests compare the ids with those of
whole texts.

Defined results: texts that are null or empty, or that a tokenizer doesn't give back byte for byte
(U+2581, which B takes for a space), have no tokens: zeros, and '' for the digest; rows with null or
repeated ids are documents of their own; the strings of special tokens are plain text; other columns
are ignored; an empty table gives no rows. A document's arrays are in one row, whatever its length.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from findery.llm.tokens import _shared, vocabulary
from findery.llm.words import slices
from findery.scratch import few, materialize, spread

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"
COMMON, SLICE = 1 << 17, 1 << 20
#: A tokens that are aligned at once; ids below which their decimals are kept.
RUN, LARGEST = 1 << 17, 1 << 17
_TOKENS = "doc_id long, a_ids array<int>, a_ends array<int>, b_ids array<int>, b_ends array<int>"


def _bytewise(name: str) -> tuple[Callable, np.ndarray]:
    """(pieces -> ids of each, how many bytes an id has) of a byte-level vocabulary."""
    cache = _shared()
    if ("bytewise", name) not in cache:
        import base64

        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocabulary(name.replace(".json", ".tiktoken")), "rb"))}
        bpe = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        sizes = np.zeros(max(ranks.values()) + 1, np.int32)
        for token, i in ranks.items():
            sizes[i] = len(token)
        cache["bytewise", name] = lambda pieces: list(map(bpe.encode_ordinary, pieces)), sizes
    return cache["bytewise", name]


def _piecewise(name: str) -> tuple[Callable, np.ndarray]:
    """The same of a vocabulary of pieces that puts a space before a text: it is taken off first."""
    cache = _shared()
    if ("piecewise", name) not in cache:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary(name))
        space = model.piece_to_id("▁")
        sizes = np.array([1 if model.is_byte(i) else len(model.id_to_piece(i).replace("▁", " ").encode()) for i in range(model.get_piece_size())], np.int32)
        cache["piecewise", name] = lambda pieces: [m or [space] for m in model.encode([p[1:] for p in pieces], num_threads=1)], sizes
    return cache["piecewise", name]


def cuts(data: np.ndarray) -> np.ndarray:
    """Where a space follows a character that can't be white space: neither tokenizer joins what is on its two sides."""
    back = lambda k: np.r_[np.zeros(min(k, len(data)), np.uint8), data[: max(0, len(data) - k)]]
    one, two, three = back(1), back(2), back(3)
    plain = (one > 0x20) & (one < 0x7F)
    wide = (one >= 0x80) & np.where((two >= 0x80) & (two < 0xC0), (three < 0xE1) | (three > 0xE3), two != 0xC2)
    return np.flatnonzero((data == 0x20) & (plain | wide))


def _gather(own: list[list[int]], sizes: np.ndarray, at: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, ends, where each text's begin): ``own``: ids of each distinct piece, ``at``: the texts' pieces by number, ``begin``: where each text's pieces begin."""
    lengths = np.array(list(map(len, own)), np.int64)
    first = np.r_[0, np.cumsum(lengths)]
    flat = np.array([i for o in own for i in o], np.int32)
    size = lengths[at]
    ends = np.r_[0, np.cumsum(size)]
    place = np.repeat(first[at] - ends[:-1], size)
    place += np.arange(len(place))
    ids, begin = flat[place], ends[begin]
    total = np.r_[0, np.cumsum(sizes[ids], dtype=np.int64)]
    return ids, (total[1:] - np.repeat(total[begin[:-1]], np.diff(begin))).astype(np.int32), begin


def _tokenise(a: str, b: str):
    def run(batches):
        how = _bytewise(a), _piecewise(b)
        for batch in slices(batches, "text", SLICE):
            texts = [(" " + t).encode("utf-8", "surrogatepass") if t and "▁" not in t else b"" for t in batch["text"].to_pylist()]
            size = np.array(list(map(len, texts)), np.int64)
            offsets = np.r_[0, np.cumsum(size)]
            data = np.frombuffer(b"".join(texts), np.uint8)
            edge = np.zeros(len(data) + 1, bool)
            edge[cuts(data)] = edge[offsets] = True
            edges = np.flatnonzero(edge)
            own = pa.Array.from_buffers(pa.large_binary(), max(0, len(edges) - 1), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
            pieces, at = [p.decode("utf-8", "replace") for p in own.dictionary.to_pylist()], np.asarray(own.indices).astype(np.int64)
            begin = np.searchsorted(edges, offsets)
            made = [_gather(encode(pieces), sizes, at, begin) for encode, sizes in how]
            good = np.ones(len(texts), bool)
            for _, ends, first in made:
                good &= np.where(np.diff(first) > 0, np.r_[ends, 0][first[1:] - 1], 0) == size
            columns = [batch["doc_id"]]
            for ids, ends, first in made:
                n = np.diff(first)
                keep, lists = np.repeat(good, n), pa.array(np.r_[0, np.cumsum(np.where(good, n, 0))].astype(np.int32))
                columns += [pa.ListArray.from_arrays(lists, pa.array(x[keep])) for x in (ids, ends)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a_ids", "a_ends", "b_ids", "b_ends"])

    return run


def tokens(docs: DataFrame, a: str = A, b: str = B) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, a_ids, a_ends, b_ids, b_ends``, in bytes of the text with a space before it."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenise(a, b), _TOKENS)


def _named(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, where among them each id is): all numbers up to the greatest id; of ids from no vocabulary, those there are."""
    if len(ids) and (ids.min() < 0 or ids.max() >= LARGEST):
        return np.unique(ids, return_inverse=True)
    return np.arange(LARGEST), ids


def _names(numbers: np.ndarray) -> pa.Array:
    """Each number in decimal, followed by a comma, then by ``|``, then by ``;``."""
    known = len(numbers) == LARGEST
    cache = _shared() if known else {}
    if "alignment-names" not in cache:
        cache["alignment-names"] = pa.array([f"{i}{sign}" for i in numbers.tolist() for sign in ",|;"], pa.large_string())
    return cache["alignment-names"]


def _aligned(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(which A tokens end where a B token ends, links, the groups' text by token).

    ``a``, ``b``: ids, and ends that go on from text to text; both end together where a text ends.
    """
    (x, at), (y, bt) = a, b
    last = np.zeros((max(at[-1:].max(initial=0), bt[-1:].max(initial=0)) + 1, 2), bool)
    last[at, 0] = last[bt, 1] = True
    mine, theirs = last[at, 1], last[bt, 0]
    links = x[mine].astype(np.int64) << 32 | y[theirs]
    # A group's A tokens, then its B tokens: each stands behind all of the other side's groups before.
    first = [np.r_[0, np.flatnonzero(s) + 1] for s in (mine, theirs)]
    group = [np.cumsum(s) - s for s in (mine, theirs)]
    numbers, where = _named(np.concatenate([x, y]))
    order = np.empty(len(x) + len(y), np.int64)
    order[np.arange(len(x)) + first[1][group[0]]] = where[: len(x)] * 3 + mine
    order[np.arange(len(y)) + first[0][group[1] + 1]] = where[len(x) :] * 3 + 2 * theirs
    return mine, links, _names(numbers).take(pa.array(order))


def _starts(n: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(n)].astype(np.int64)


def _texts(words: pa.Array, at: np.ndarray) -> list[bytes]:
    """What stands between the places, without the sign at its end."""
    ends, data = np.frombuffer(words.buffers()[1], np.int64)[at], words.buffers()[2]
    return [data[i : max(i, j - 1)].to_pybytes() if data is not None else b"" for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _sides(b: pa.RecordBatch) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[np.ndarray]]:
    """(ids and ends, going on from row to row, of each side; where each row's tokens begin) of a batch of ``tokens``."""
    n = [np.asarray(pc.fill_null(pc.list_value_length(b[f"{s}_ids"]), 0)).astype(np.int64) for s in "ab"]
    begin = [_starts(x) for x in n]
    flat = lambda c: np.asarray(b[c].flatten())
    ends = [flat(f"{s}_ends").astype(np.int64) for s in "ab"]
    size = np.where(n[0] > 0, np.r_[ends[0], 0][begin[0][1:] - 1], 0)
    shift = np.r_[0, np.cumsum(size)[:-1]] if len(size) else size
    return [(flat(f"{s}_ids"), e + np.repeat(shift, m)) for s, e, m in zip("ab", ends, n, strict=True)], begin


def _runs(b: pa.RecordBatch):
    """Parts of a batch of ``tokens``, of about ``RUN`` A tokens each."""
    n = np.asarray(pc.fill_null(pc.list_value_length(b["a_ids"]), 0)).astype(np.int64)
    number = (np.cumsum(n) - n) // RUN
    at = np.r_[np.flatnonzero(np.r_[True, number[1:] != number[:-1]]), len(b)] if len(b) else np.zeros(1, int)
    return (b.slice(i, j - i) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def _lists(values: np.ndarray | pa.Array, at: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values if isinstance(values, pa.Array) else pa.array(values))


def _aligning(batches):
    for whole in batches:
        for b in _runs(whole):
            sides, (begin, other) = _sides(b)
            mine, links, words = _aligned(*sides)
            at = _starts(mine)[begin]
            groups = [g for t in _texts(words, begin + other) for g in (t.decode().split(";") if t else ())]
            shared = np.asarray(b["a_ends"].flatten())[mine]
            added = [_lists(shared, at), _lists(pa.array(groups, pa.string()), at), _lists(links, at)]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*b.schema.names, "shared", "groups", "links"])


def align(tokenised: DataFrame) -> DataFrame:
    """Adds ``shared`` (where A and B tokens end together), ``groups`` (``a1,a2|b1`` each) and ``links`` (A id * 2**32 + B id each)."""
    shape = StructType([*tokenised.schema, *(StructField(n, ArrayType(t)) for n, t in (("shared", IntegerType()), ("groups", StringType()), ("links", LongType())))])
    return tokenised.mapInArrow(_aligning, shape)


def _text_aligned(a: str, b: str):
    def run(batches):
        for x in (r for t in _tokenise(a, b)(batches) for r in _runs(t)):
            sides, (begin, other) = _sides(x)
            mine, links, words = _aligned(*sides)
            columns = [x["doc_id"], pa.array(np.diff(begin)), pa.array(np.diff(other)), pa.array(_texts(words, begin + other), pa.binary()).cast(pa.string()), _lists(links, _starts(mine)[begin])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "groups", "links"])

    return run


def aligned(docs: DataFrame, a: str = A, b: str = B) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, n_a, n_b, groups, links``: ``tokens`` and ``align`` in one worker, the groups as one text (``a1,a2|b1;a3|b2``)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_text_aligned(a, b), "doc_id long, n_a long, n_b long, groups string, links array<long>")


def counts(links: DataFrame) -> DataFrame:
    """``links`` -> ``pair, n, best``: how many links hold a pair, and whether none of its B id's has more. A written table."""
    found = materialize(links.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "alignment-counts", exchanged=True)
    most = found.groupBy("b").agg(F.max("n").alias("most"))
    return materialize(found.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "alignment-pairs", exchanged=True)


def summed(rows: DataFrame, pairs: DataFrame, common: int = COMMON) -> DataFrame:
    """``row, links`` -> ``row, n_best, count_sum`` of rows with links."""
    first = materialize(pairs.orderBy(F.desc("n"), "pair").limit(common), "alignment-common", exchanged=True)
    each = rows.select("row", F.explode("links").alias("pair"))
    sums = lambda x: x.groupBy("row").agg(F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("n").alias("count_sum"))
    often = sums(each.join(F.broadcast(first), "pair"))
    rare = sums(each.join(F.broadcast(first.select("pair")), "pair", "left_anti").join(pairs, "pair"))
    return often.unionByName(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def digests(docs: DataFrame, a: str = A, b: str = B, common: int = COMMON) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, a row for each row."""
    rows = aligned(docs, a, b)
    size = F.size("links").cast("long")
    sha = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    told = rows.select("doc_id", "n_a", "n_b", size.alias("n_groups"), size.alias("n_links"), sha.alias("groups_sha256"), "links")
    told = materialize(told.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    sums = summed(told, counts(told), common)
    out = told.drop("links").join(sums.withColumnRenamed("row", "own"), F.col("row") == F.col("own"), "left")
    least = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", least("n_best"), least("count_sum"), "groups_sha256")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few(digests(spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))))
