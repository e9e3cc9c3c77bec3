"""Token counts that follow edits.

A document's pre-tokens (the pieces that the tokenizer's pattern cuts a text into, none of which
shares a token with the next) are kept in runs of about ``RUN`` characters, and the runs' lengths
and token counts in a segment tree. An edit replaces a span of characters. Only the runs that it
touches, and what stands ``LOOK`` characters around it, are cut and counted anew, further ones until the new cuts meet old
ones again; then the sums on the way to the root are brought up to date.

A pre-token depends on nothing before its start, and on the text after its end by two characters at
most (white space gives up its last character to what follows), or by those of a special token's
string, which is one piece and cuts what stands before it. So cutting may begin at any old cut that
is ``LOOK`` characters before the edit, and may end as soon as a new cut falls on an old one.

Defined results: a null text is empty and has no tokens; edits outside the text are clipped to it,
null edits do nothing, and edits apply in order, each to the result of those before; an empty table
gives no rows; a null or repeated ``doc_id`` is carried; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from findery.llm.tokens import encoder, pretokens, specials
from findery.llm.words import slices
from findery.scratch import spread

RUN, SLICE = 2048, 1 << 22
LOOK = 16  # two characters, and a special token's string before or after them


class Tree:
    """Sums of (characters, tokens) over runs, as a segment tree in an array."""

    def __init__(self, leaves: list[tuple[int, int]]):
        self.build(leaves)

    def build(self, leaves):
        self.n = max(1, len(leaves))
        self.size = 1 << (self.n - 1).bit_length()
        pad = [(0, 0)] * (self.size - len(leaves))
        self.sums = [(0, 0)] * self.size + list(leaves) + pad
        for i in range(self.size - 1, 0, -1):
            a, b = self.sums[2 * i], self.sums[2 * i + 1]
            self.sums[i] = a[0] + b[0], a[1] + b[1]

    def put(self, i: int, leaf: tuple[int, int]) -> None:
        i += self.size
        self.sums[i] = leaf
        while i > 1:
            i //= 2
            a, b = self.sums[2 * i], self.sums[2 * i + 1]
            self.sums[i] = a[0] + b[0], a[1] + b[1]

    def find(self, at: int) -> tuple[int, int]:
        """(run that holds character ``at``, where that run starts)."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at >= start + self.sums[i][0]:
                start += self.sums[i][0]
                i += 1
        return min(i - self.size, self.n - 1), start if i - self.size < self.n else start - self.sums[self.n - 1 + self.size][0]

    @property
    def total(self) -> tuple[int, int]:
        return self.sums[1]


class CountedText:
    """A text with its token count, kept right over edits. ``recounted`` is how many characters were cut and counted after the first time."""

    def __init__(self, text: str, count, cut):
        self.count, self.cut, self.recounted = count, cut, 0
        self.runs = self._runs(cut(text))
        self.tree = Tree([(len(r), n) for r, n in self.runs])

    def _runs(self, pieces: list[str]) -> list[tuple[str, int]]:
        """Whole pre-tokens in runs of about RUN characters, with their counts."""
        out, run, size = [], [], 0
        for piece in pieces:
            run.append(piece)
            size += len(piece)
            if size >= RUN:
                out.append(("".join(run), sum(map(self.count, run))))
                run, size = [], 0
        if run or not out:
            out.append(("".join(run), sum(map(self.count, run))))
        return out

    @property
    def tokens(self) -> int:
        return self.tree.total[1]

    @property
    def text(self) -> str:
        return "".join(r for r, _ in self.runs)

    def replace(self, start: int, end: int, new: str) -> None:
        """Characters ``start`` to ``end`` become ``new``."""
        length = self.tree.total[0]
        start = min(max(0, start), length)
        end = min(max(start, end), length)
        first, begin = self.tree.find(start)
        last, _ = self.tree.find(max(start, end - 1))
        while first and start - begin < LOOK:  # pre-tokens before the edit may change with what follows them
            first -= 1
            begin -= len(self.runs[first][0])
        stop = last + 1
        old = "".join(r for r, _ in self.runs[first:stop])
        text = old[: start - begin] + new + old[end - begin :]
        while True:
            after = "".join(r[:LOOK] for r, _ in self.runs[stop : stop + LOOK])[:LOOK]
            pieces, at, n = self.cut(text + after), 0, 0
            while at < len(text):
                at += len(pieces[n])
                n += 1
            if at == len(text):
                break
            text += self.runs[stop][0]  # the cut at the old edge is gone: go on to the next
            stop += 1
        self.recounted += len(text)
        fresh = self._runs(pieces[:n]) if text or len(self.runs) == stop - first else []
        if len(fresh) == stop - first:
            for i, r in enumerate(fresh):
                self.runs[first + i] = r
                self.tree.put(first + i, (len(r[0]), r[1]))
        else:
            self.runs[first:stop] = fresh
            self.tree.build([(len(r), n) for r, n in self.runs])


def counter(name: str):
    """piece -> number of its tokens, remembering the pieces seen (up to a million)."""
    encode, seen = encoder(name), {}

    def count(piece: str) -> int:
        n = seen.get(piece)
        if n is None:
            if len(seen) >= 1_000_000:
                seen.clear()
            n = seen[piece] = len(encode(piece))
        return n

    return count


SHAPE = "doc_id long, tokens_before long, tokens_after long, chars_after long, chars_recounted long"


def _count(name: str):
    def run(batches):
        count, cut = counter(name), pretokens(name)
        if any(len(s) + 2 > LOOK for s in specials(name)):
            raise ValueError(f"a special token of {name} is longer than LOOK allows")
        for b in slices(batches, "text", SLICE):
            rows = []
            for doc_id, text, edits in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["edits"].to_pylist(), strict=True):
                own = CountedText(text or "", count, cut)
                before = own.tokens
                for e in edits or []:
                    if e is not None and e["start"] is not None:
                        own.replace(e["start"], e["start"] + (e["length"] or 0), e["text"] or "")
                rows.append((doc_id, before, own.tokens, own.tree.total[0], own.recounted))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "tokens_before", "tokens_after", "chars_after", "chars_recounted"])

    return run


def count_edits(docs: DataFrame, name: str = "byte_bpe_50k.json") -> DataFrame:
    """``doc_id, text, edits`` (array of start, length, text) -> the counts before and after, the length after, and how many characters the edits had counted anew."""
    return spread(docs.select("doc_id", "text", "edits")).mapInArrow(_count(name), SHAPE)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, and three edits of it: a word put in at the middle, ten characters cut out at a quarter, the end lengthened."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    edit = lambda start, length, text: F.struct(start.cast("long").alias("start"), F.lit(length).cast("long").alias("length"), F.lit(text).alias("text"))
    edits = F.array(edit(F.floor(n / 2), 0, " corrected"), edit(F.floor(n / 4), 10, ""), edit(n, 0, " The end."))
    return count_edits(docs.withColumn("edits", edits))
