"""N-gram Jaccard join over prefix trees.

A document's set is its distinct shingles of five lower-cased words, as 64-bit hashes. Two sets link
when ``100 * intersection >= 80 * union``. All shingles have one global order: the number of sets
that have them (in steps of a ninth), then the hash. Linked sets share one of the first
``n - ceil(0.8 n) + 1`` shingles in that order, and whatever they share is no shingle of a single set.

1. Equal sets become one node (key: hash of the whole set).
2. Shingles travel once, in blocks by part of the hash, to be counted; those in two sets or more go
   on to their node's part, where a node is left out if its first shingles are all its own.
3. Nodes sharing one of their first shingles meet in a group about the smallest of them. A group is
   joined by storing its globally ordered sets in a trie; each set is looked up by walking the trie
   with the overlap of the path so far, leaving subtrees that even the whole rest couldn't bring to
   the threshold, or that hold only sets already known to be in its component.
4. Groups beyond ``GROUP`` nodes are split by the size of the sets into bands, each node going to its
   own and the next, so that any two that can link meet in one. A band is joined in parts; then all
   nodes that aren't in its main component meet all its parts. Components of the links give the classes.

Shingles in very many sets are known to every task, so that they don't meet in one part. They are
found by counting the shingles of a part of all texts, chosen by hash, in which one of ``hot_count``
sets comes some ``SEEN`` times. A frequent one that the choice misses costs balance, never a link.
The list has no more than ``2**21`` shingles, whatever the sets: it holds those that come ``SEEN / 2``
times among at most ``SEEN * 2**20`` counted.

Defined results: a null, empty or all-white text has an empty set, links to nothing and is its own
component; fewer words than five are one shingle, the whole sequence; repeated rows are equal sets;
a row with a null ``doc_id`` links like any other but never names a component (null, if all of it
are null); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from findery.llm.components import components
from findery.llm.words import mix, slices, windows, words
from findery.scratch import few, materialize, shuffle_partitions

SIZE, NUM, DEN = 5, 4, 5
GROUP, PART, SLICE = 256, 1 << 21, 1 << 22
HOT, LEAST_HOT, SEEN = 512, 1024, 32
_KEY = 12


def prefix_length(n: int) -> int:
    """How many of the first shingles of a set of n one of them must be shared."""
    return n - -(-n * NUM // DEN) + 1


def linked(shared, n, m) -> bool:
    return DEN * shared >= NUM * (n + m - shared)


def _sets(texts: pa.Array, size: int = SIZE):
    """(row, sorted distinct shingle hashes) of every text that has words."""
    for w in words(texts, lower=True):
        grams = windows(w.hashes, size)
        for i in range(w.high - w.low):
            a, b = w.first[i], w.first[i + 1]
            if b - a >= size:
                yield w.low + i, np.unique(grams[a : b - size + 1])
            elif b > a:
                yield w.low + i, windows(w.hashes[a:b], int(b - a), seed=1)


def _key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=_KEY).digest()


def _info(size: int):
    """Per document its id, set size and key."""

    def run(batches):
        for b in slices(batches, "text", SLICE):
            n, key = [0] * len(b), [None] * len(b)
            for row, s in _sets(b["text"], size):
                n[row], key[row] = len(s), _key(s)
            cols = [b["doc_id"].cast(pa.int64()), b["text_hash"].cast(pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_hash", "n", "key"])

    return run


def hot_count(n_docs: int, n_tokens: int) -> int:
    """In how many sets a shingle is frequent: a 512th of all, or one in 2**20 of all sets' sizes together if that is more."""
    return max(LEAST_HOT, n_docs // HOT, n_tokens >> 20)


def _tokens_of(size: int):
    """The shingles of each slice's distinct sets."""

    def run(batches):
        for b in slices(batches, "text", SLICE):
            distinct = {_key(s): s for _, s in _sets(b["text"], size)}
            for s in distinct.values():
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64), pa.int64())], names=["token"])

    return run


def frequent(docs: DataFrame, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in about ``least`` sets or more, ascending, and their ranks, by a count over one text in ``least / SEEN``."""
    of = 1 << 30
    share = min(of, -(-of * SEEN // least))
    some = docs.filter(F.pmod(F.xxhash64("text", F.lit("frequent")), F.lit(of)) < share)
    counted = some.select("text").mapInArrow(_tokens_of(size), "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.filter(F.col("n") >= max(2, least * share // (2 * of))).collect()
    tokens, n = np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64)
    o = np.argsort(tokens)
    return tokens[o], np.maximum(rank_of(np.maximum(n[o] * of // share, 1)), rank_of(np.array([least]))[0])


_BULK = "part int, keys binary, sizes binary, counts binary, tokens binary, ranks binary"
_NAMES = ["part", "keys", "sizes", "counts", "tokens", "ranks"]


def _bulk(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=_NAMES)


def _deal(where: np.ndarray, parts: int, keys, sizes, doc, tokens, ranks, number):
    """Rows of equal ``where``: tokens with their documents' keys and set sizes, each key once. ``doc`` is ascending within what a part gets."""
    o = np.argsort(where, kind="stable")
    bound = np.searchsorted(where[o], np.arange(parts + 1))
    for p in range(parts):
        own = o[bound[p] : bound[p + 1]]
        if len(own):
            d = doc[own]
            at = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
            counts = np.diff(np.r_[at, len(d)]).astype("<u4")
            yield number(p), keys[d[at]].tobytes(), sizes[d[at]].tobytes(), counts.tobytes(), tokens[own].tobytes(), ranks[own].tobytes()


def _shingles(size: int, parts: int, hot: np.ndarray, hot_ranks: np.ndarray):
    """Every set's shingles to the parts by their hash; those known to be frequent to parts of their own (below 0), with their ranks."""

    def run(batches):
        for b in slices(batches, "text", SLICE):
            distinct = {}
            for _, s in _sets(b["text"], size):
                distinct.setdefault(_key(s), s)
            if not distinct:
                continue
            keys, sets = np.array(list(distinct), dtype=f"V{_KEY}"), list(distinct.values())
            sizes = np.array([len(s) for s in sets], dtype="<u4")
            doc, tokens = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
            at = np.minimum(np.searchsorted(hot, tokens), max(0, len(hot) - 1))
            often = hot[at] == tokens if len(hot) else np.zeros(len(tokens), bool)
            rare = ~often
            none = np.zeros(rare.sum(), np.uint8)
            rows = list(_deal((tokens[rare] >> np.uint64(40)) % np.uint64(parts), parts, keys, sizes, doc[rare], tokens[rare], none, lambda p: p))
            spread = mix(doc[often].astype(np.uint64)) % np.uint64(parts)
            rows += _deal(spread, parts, keys, sizes, doc[often], tokens[often], hot_ranks[at[often]] if len(hot) else none[:0], lambda p: -1 - p)
            yield _bulk(rows)

    return run


def _unpack(table: pa.Table):
    """(keys, sizes, index of each token's key, tokens, ranks) of bulk rows."""
    whole = lambda c, t: np.concatenate([np.frombuffer(x.as_buffer(), t) for x in table[c]])
    counts = whole("counts", "<u4")
    return whole("keys", f"V{_KEY}"), whole("sizes", "<u4"), np.repeat(np.arange(len(counts), dtype=np.int32), counts), whole("tokens", "<u8"), whole("ranks", "u1")


def _words_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys as two integers, for sorting."""
    raw = np.frombuffer(keys.tobytes(), dtype=np.dtype([("a", "<u8"), ("b", "<u4")]))
    return raw["a"], raw["b"]


def rank_of(count: np.ndarray) -> np.ndarray:
    """Steps of the frequency: equal counts have equal ranks, higher counts no lower ones."""
    return np.minimum(255, np.floor(6 * np.log2(count))).astype(np.uint8)


def _count(parts: int):
    """Shingles of two sets or more, with their ranks, to their sets' parts."""

    def run(table: pa.Table) -> pa.Table:
        keys, sizes, doc, tokens, ranks = _unpack(table)
        if table["part"][0].as_py() >= 0:
            a, b = _words_of(keys)
            o = np.lexsort((b, a))
            again = np.zeros(len(o), bool)  # the same set from another batch has the same tokens here
            again[o[1:]] = (a[o][1:] == a[o][:-1]) & (b[o][1:] == b[o][:-1])
            fresh = ~again[doc]
            doc, tokens = doc[fresh], tokens[fresh]
            s = np.sort(tokens)
            begin = np.flatnonzero(np.r_[len(s) > 0, s[1:] != s[:-1]])
            count = np.diff(np.r_[begin, len(s)])
            shared, count = s[begin[count > 1]], count[count > 1]  # few, next to all
            del s, begin
            at = np.minimum(np.searchsorted(shared, tokens), max(0, len(shared) - 1)).astype(np.int32)
            several = shared[at] == tokens if len(shared) else np.zeros(len(tokens), bool)
            doc, tokens, ranks = doc[several], tokens[several], rank_of(count)[at[several]] if len(shared) else ranks[:0]
        where = _words_of(keys)[0][doc] % np.uint64(parts)
        return pa.Table.from_batches([_bulk(list(_deal(where, parts, keys, sizes, doc, tokens, ranks, lambda p: p)))])

    return run


_NODE = "key binary, n long, first int, tokens binary, ranks binary"


def _gather(table: pa.Table) -> pa.Table:
    """Nodes whose first shingles aren't all their own: their shared shingles in the global order; the first of them that count, ``first``."""
    keys, sizes, doc, tokens, ranks = _unpack(table)
    a, b = _words_of(keys)
    o = np.lexsort((tokens, ranks, b[doc], a[doc]))
    doc, tokens, ranks = doc[o], tokens[o], ranks[o]
    at = np.flatnonzero(np.r_[True, (a[doc][1:] != a[doc][:-1]) | (b[doc][1:] != b[doc][:-1])]) if len(doc) else np.zeros(0, int)
    bound, out = np.r_[at, len(doc)], []
    for lo, hi in zip(bound[:-1], bound[1:], strict=True):
        t, r = tokens[lo:hi], ranks[lo:hi]
        same = np.r_[True, t[1:] != t[:-1]]  # a set that came in two batches
        t, r, n = t[same], r[same], int(sizes[doc[lo]])
        first = prefix_length(n) - (n - len(t))
        if first > 0:
            out.append({"key": keys[doc[lo]].tobytes(), "n": n, "first": first, "tokens": t.tobytes(), "ranks": r.tobytes()})
    return pa.Table.from_pylist(out, schema=pa.schema([("key", pa.binary()), ("n", pa.int64()), ("first", pa.int32()), ("tokens", pa.binary()), ("ranks", pa.binary())]))


def _firsts(batches):
    for b in batches:
        keys, sizes, tokens = [], [], []
        for key, n, first, t in zip(*(b[c].to_pylist() for c in ("key", "n", "first", "tokens")), strict=True):
            t = np.frombuffer(t, "<i8")[:first]
            keys += [key] * len(t)
            sizes += [n] * len(t)
            tokens.append(t)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*tokens, np.zeros(0, np.int64)]), pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())], names=["token", "key", "n"])


def bands(n: Column, num: int = NUM, den: int = DEN) -> Column:
    """A set's own band of sizes and the next. A band is a little wider than the largest ratio of sizes that can link, so that linked sets' bands are one apart at most."""
    own = F.floor(F.ln(n.cast("double")) / math.log(den / num * 1.01))
    return F.array(own, own + 1)


class Trie:
    """Globally ordered sets in a path-compressed trie.

    ``sets`` are ascending positions in the order; node i spans positions ``lo[i]`` to ``hi[i]`` of
    the set ``by[i]`` and covers the sets ``left[i]`` to ``right[i]`` (not itself) in trie order.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.sets, self.sizes = [sets[i] for i in self.order], sizes[self.order]
        self.lo, self.hi, self.by, self.left, self.right, self.children = [], [], [], [], [], []
        lengths = np.array([len(s) for s in self.sets])
        common = [0] * len(self.sets)
        for i in range(1, len(self.sets)):
            a, b = self.sets[i - 1], self.sets[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            common[i] = int(differ[0]) if len(differ) else m
        stack: list[int] = []
        self.roots: list[int] = []

        def node(lo, hi, by, left):
            for x, v in zip((self.lo, self.hi, self.by, self.left, self.right, self.children), (lo, hi, by, left, None, []), strict=True):
                x.append(v)
            return len(self.lo) - 1

        def shut(to, right):
            """Closes the open nodes below depth ``to``; splits the one across it."""
            while stack and self.hi[stack[-1]] > to:
                i = stack.pop()
                self.right[i] = right
                above = stack[-1] if stack else None
                if self.lo[i] < to:
                    j = node(self.lo[i], to, self.by[i], self.left[i])
                    self.lo[i] = to
                    self.children[j].append(i)
                    stack.append(j)
                    return
                if above is not None and self.hi[above] >= to:
                    self.children[above].append(i)
                elif above is None:
                    self.roots.append(i)
                else:
                    self.children[above].append(i)

        for i, s in enumerate(self.sets):
            shut(common[i], i)
            stack.append(node(common[i], len(s), i, i))
            if len(s) == common[i]:  # the same shared shingles as the set before: a leaf without a label
                leaf = stack.pop()
                self.right[leaf] = i + 1
                (self.children[stack[-1]] if stack else self.roots).append(leaf)
        shut(-1, len(self.sets))
        n = len(self.lo)
        self.least = [int(self.sizes[self.left[i] : self.right[i]].min()) for i in range(n)]
        self.rest = [int(lengths[self.left[i] : self.right[i]].max()) - self.hi[i] for i in range(n)]


def trie_join(tokens: list[np.ndarray], ranks: list[np.ndarray], sizes: np.ndarray, component: np.ndarray, num: int = NUM, den: int = DEN):
    """Links (i, j) that join the components of linked sets, starting from ``component``; sets in one component are not compared again."""
    every = np.concatenate(tokens)
    distinct, at, back = np.unique(every, return_index=True, return_inverse=True)
    place = np.empty(len(distinct), np.int64)  # most frequent first: long common paths
    place[np.lexsort((distinct, -np.concatenate(ranks)[at].astype(int)))] = np.arange(len(distinct))
    bound = np.cumsum([0] + [len(t) for t in tokens])
    trie = Trie([np.sort(place[back[a:b]]) for a, b in zip(bound[:-1], bound[1:], strict=True)], sizes)
    component = component[trie.order].copy()
    links = []
    for x, (own, n) in enumerate(zip(trie.sets, trie.sizes.tolist(), strict=True)):
        has = np.zeros(len(distinct) + 1, dtype=np.int64)
        has[own] = 1
        upto = np.cumsum(has)
        todo = [(i, 0) for i in trie.roots]
        while todo:
            i, shared = todo.pop()
            if trie.right[i] <= x + 1:  # looked up the other way, or itself
                continue
            members = component[max(trie.left[i], x + 1) : trie.right[i]]
            if (members == component[x]).all():
                continue
            lo, hi = trie.lo[i], trie.hi[i]
            if hi > lo:
                label = trie.sets[trie.by[i]][lo:hi]
                shared += int(has[label].sum())
                left = len(own) - int(upto[label[-1]])
            elif hi:
                left = len(own) - int(upto[trie.sets[trie.by[i]][hi - 1]])
            else:
                left = len(own)
            best, least = shared + min(left, trie.rest[i]), trie.least[i]
            if (num + den) * best < num * (n + least):
                continue
            if trie.children[i]:
                todo += [(c, shared) for c in trie.children[i]]
            # sets that end here: all of a leaf, and those that come before a node's children
            ends = trie.children[i][0] if trie.children[i] else None
            for y in range(trie.left[i], trie.left[ends] if ends is not None else trie.right[i]):
                if y > x and component[y] != component[x] and (num + den) * shared >= num * (n + int(trie.sizes[y])):
                    links.append((trie.order[x], trie.order[y]))
                    component[component == component[y]] = component[x]
    return links


def _join(num: int, den: int):
    """Rows of one unit follow each other; links of each come out."""

    def run(batches):
        unit, rows = None, {}

        def close():
            if len(rows) < 2:
                return []
            keys, kept = list(rows), list(rows.values())
            names, start = {}, np.array([r[3] for r in kept])
            label = np.array([names.setdefault(s, len(names)) for s in start.tolist()])
            found = trie_join([np.frombuffer(r[1], "<u8") for r in kept], [np.frombuffer(r[2], "u1") for r in kept], np.array([r[0] for r in kept]), label, num, den)
            return [(keys[a], keys[b]) for a, b in found]

        out = []
        for b in batches:
            for u, key, n, t, r, c in zip(*(b[x].to_pylist() for x in ("unit", "key", "n", "tokens", "ranks", "component")), strict=True):
                if u != unit:
                    out += close()
                    unit, rows = u, {}
                rows[key] = n, t, r, c
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], names=["a", "b"])
            out = []
        out = close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return run


def _links(units: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """``units``: ``unit`` (binary), ``key``, ``component``."""
    full = units.join(nodes.select("key", "n", "tokens", "ranks"), "key").select("unit", "key", "n", "tokens", "ranks", "component")
    return full.repartition("unit").sortWithinPartitions("unit", "key").mapInArrow(_join(num, den), "a binary, b binary")


def join_documents(docs: DataFrame, size: int = SIZE, num: int = NUM, den: int = DEN, group: int = GROUP) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, text_hash, n_shingles, component, component_id``, a row per row; ``component`` is null for an empty set."""
    spark = docs.sparkSession
    shape = "doc_id long, text_hash long, n long, key binary"
    rows = materialize(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(_info(size), shape), "ngram-info")
    n_docs, n_tokens = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot, hot_ranks = frequent(docs, size, hot_count(n_docs, n_tokens))
    parts = max(shuffle_partitions(spark), -(-int(n_tokens) // PART))
    sent = docs.select("text").mapInArrow(_shingles(size, parts, hot, hot_ranks), _BULK)
    counted = sent.groupBy("part").applyInArrow(_count(parts), _BULK)
    nodes = materialize(counted.groupBy("part").applyInArrow(_gather, _NODE), "ngram-nodes", exchanged=True)

    firsts = nodes.select("key", "n", "first", "tokens").mapInArrow(_firsts, "token long, key binary, n long")
    centres = firsts.groupBy("token").agg(F.min("key").alias("centre"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    members = materialize(firsts.join(centres, "token").select("centre", "key", "n").distinct(), "ngram-members", exchanged=True)
    sizes = members.groupBy("centre").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    met = members.join(sizes, "centre")
    banded = met.filter(F.col("m") > group).withColumn("band", F.explode(bands(F.col("n"), num, den)))
    banded = banded.select(F.concat("centre", F.encode(F.concat(F.lit("#"), F.col("band").cast("string")), "utf-8")).alias("centre"), "key")
    again = banded.groupBy("centre").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    met = met.filter(F.col("m") <= group).select("centre", "key", "m").unionByName(banded.join(again, "centre").select("centre", "key", "m"))
    dealt = met.withColumn("parts", F.ceil(F.col("m") / group)).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    unit = lambda *cs: F.concat(F.col("centre"), *(F.encode(F.concat(F.lit("/"), c.cast("string")), "utf-8") for c in cs))
    own = dealt.select(unit(F.col("part")).alias("unit"), "key", F.col("key").alias("component"))
    links = materialize(_links(own, nodes, num, den), "ngram-links", exchanged=True)
    stars = components(links)

    large = dealt.filter("parts > 1")
    if large.limit(1).count():
        named = materialize(large.join(stars, large["key"] == stars["node"], "left").select("centre", "key", "parts", "part", F.coalesce("component", "key").alias("component")), "ngram-large", exchanged=True)
        per = named.groupBy("centre", "component").agg(F.count(F.lit(1)).alias("c"))
        main = per.groupBy("centre").agg(F.max_by("component", F.struct("c", "component")).alias("main"), (F.sum("c") - F.max("c")).alias("others"))
        # Larger tiles than above, as each unit of a block and a part carries both sides' shingles.
        both = named.join(main.filter("others > 0"), "centre").withColumn("blocks", F.ceil(F.col("others") / (2 * group)))
        both = both.withColumn("parts", F.ceil(F.col("parts") / 2)).withColumn("part", F.pmod("part", F.col("parts")))
        strays = both.filter("component <> main").withColumn("block", F.pmod(F.xxhash64(F.lit(1), "key"), F.col("blocks")))
        strays = strays.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        others = both.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        units = strays.select("centre", "block", "part", "key", "component").unionByName(others.select("centre", "block", "part", "key", "component"))
        across = units.select(unit(F.col("block"), F.col("part")).alias("unit"), "key", "component").distinct()
        stars = components(links.unionByName(materialize(_links(across, nodes, num, den), "ngram-across", exchanged=True)))

    ids = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least"))
    of = ids.join(stars, ids["key"] == stars["node"], "left").select("key", "least", F.coalesce("component", "key").alias("component"))
    named = of.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = of.select("key", "component").join(named, "component").select(F.col("key").alias("_key"), "component", "component_id")
    out = rows.join(classes, rows["key"] == classes["_key"], "left")
    own_id = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component", own_id.alias("component_id"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """All columns of one row of each class: the smallest ``doc_id`` (nulls last), then text hash. Rows with empty sets stay."""
    classes = join_documents(docs, **how)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))
    first = classes.filter("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("o"))
    kept = first.select(F.col("o.doc_id").alias("_ng_id"), F.col("o.text_hash").alias("_ng_hash"))
    empty = classes.filter("component IS NULL").select(F.col("doc_id").alias("_ng_id"), F.col("text_hash").alias("_ng_hash")).distinct()
    rows = docs.withColumn("_ng_own", F.xxhash64("text"))
    same = rows["doc_id"].eqNullSafe(kept["_ng_id"]) & (rows["_ng_own"] == kept["_ng_hash"])
    once = W.partitionBy("doc_id", "_ng_own").orderBy(*(c for c, t in docs.dtypes if c not in ("doc_id", "text") and "map<" not in t and t not in ("variant", "interval")), F.lit(0))
    found = rows.join(kept, same, "left_semi").withColumn("_ng_place", F.row_number().over(once)).filter("_ng_place = 1")
    same = rows["doc_id"].eqNullSafe(empty["_ng_id"]) & (rows["_ng_own"] == empty["_ng_hash"])
    return found.select(docs.columns).unionByName(rows.filter(~F.col("text").rlike(r"[^\x20\x09-\x0D]") | F.col("text").isNull()).join(empty, same, "left_semi").select(docs.columns))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return few(join_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id"))


ORACLE_SQL = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS n, doc_id,
  coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT n, doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {SIZE} THEN [array_to_string(ws, ' ')]
  ELSE list_transform(generate_series(1, len(ws) - {SIZE - 1}), lambda i: array_to_string(ws[i : i + {SIZE - 1}], ' ')) END) AS g FROM d),
x AS (SELECT n, len(g) AS size, unnest(g) AS t FROM s),
i AS (SELECT a.n AS a, b.n AS b, a.size + b.size - count(*) AS whole, count(*) AS shared FROM x a JOIN x b USING (t) WHERE a.n <> b.n GROUP BY a.n, b.n, a.size, b.size),
l AS (SELECT a, b FROM i WHERE {DEN} * shared >= {NUM} * whole),
r(n, id) AS (SELECT n, doc_id FROM d UNION SELECT l.b, r.id FROM r JOIN l ON r.n = l.a)
SELECT doc_id, len(g)::BIGINT AS n_shingles, (SELECT min(id) FROM r WHERE r.n = s.n) AS component_id FROM s
"""
