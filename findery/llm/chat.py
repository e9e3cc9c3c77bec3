r"""Chat formatting, with a grammar that reads the turns back.

One turn after another, a conversation becomes text by this grammar::

    user       <s>[INST] text [/INST]
    assistant   text </s>            (with the space before it)
    any other  <s>[ROLE] role [/ROLE] text </s>

``read_turn`` is the deterministic parser of it; it takes no control string inside a text. Every
turn is rendered, read back and compared; where that does not give the turn again, the texts'
control strings get a backslash after their bracket (those that look so already, one more), until
it does. Reading takes one backslash off.

Turns are rendered where they are read; what then meets by conversation is sorted and read as one
running text, in which nothing but the grammar says where a turn ends.

Defined results: a null text or role is empty; turns go by ``turn``, nulls first, then by what they
are formatted to; repeated rows stay repeated; rows with a null ``conv_id`` make up one conversation;
an empty table gives no rows. Only the columns conv_id, turn, role and text are used.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))")
ESCAPED = re.compile(r"([<\[])(\\*)\\(/?(?:s>|INST\]|ROLE\]))")
BARE = re.compile(r"[<\[]/?(?:s>|INST\]|ROLE\])")


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's formatted text and where in it the loss falls (nowhere, unless an assistant speaks)."""
    if role == "user":
        return f"<s>[INST] {text} [/INST]", 0, 0
    if role == "assistant":
        return f" {text} </s>", 1, 1 + len(text)
    return f"<s>[ROLE] {role} [/ROLE] {text} </s>", 0, 0


class Unended(ValueError):
    """The text may be the beginning of a turn: nothing in it is wrong, but its end is missing."""


def _until(s: str, at: int, end: str) -> tuple[str, int]:
    """The text from ``at`` to ``end``, which has to be the first control string that comes."""
    m = BARE.search(s, at)
    if not m:
        raise Unended(f"{end} expected after {at}")
    if m[0] != end or m.start() == at or s[m.start() - 1] != " ":
        raise ValueError(f"{end} expected after {at}")
    if m.start() - 1 < at:
        raise ValueError("text expected")
    return unescape(s[at : m.start() - 1]), m.end()


def read_turn(s: str, at: int = 0) -> tuple[str, str, tuple[int, int], int]:
    """(role, text, loss span, where the next turn begins)."""
    if s.startswith("<s>[INST] ", at):
        text, end = _until(s, at + 10, "[/INST]")
        return "user", text, (at, at), end
    if s.startswith("<s>[ROLE] ", at):
        role, end = _until(s, at + 10, "[/ROLE]")
        if s[end : end + 1] != " ":
            raise (ValueError if s[end:] else Unended)("a space expected")
        text, stop = _until(s, end + 1, "</s>")
        return role, text, (at, at), stop
    if s.startswith(" ", at):
        text, end = _until(s, at + 1, "</s>")
        return "assistant", text, (at + 1, end - 5), end
    if any(x.startswith(s[at:]) for x in ("<s>[INST] ", "<s>[ROLE] ")):
        raise Unended(f"no whole turn begins at {at}")
    raise ValueError(f"no turn begins at {at}")


class Reader:
    """Reads turns off a running text that comes in parts of any length."""

    def __init__(self):
        self.text = ""

    def feed(self, part: str):
        """(role, text, text under the loss mask as it is formatted) of the turns that end in what has come so far."""
        self.text += part
        at = 0
        try:
            while at < len(self.text):
                role, text, (start, end), stop = read_turn(self.text, at)
                yield role, text, self.text[start:end]
                at = stop
        except Unended:
            pass
        self.text = self.text[at:]

    def close(self) -> None:
        if self.text:
            raise ValueError(f"the text ends within a turn: {self.text[:40]!r}")


def read(s: str) -> list[tuple[str, str]]:
    """All turns of a formatted conversation."""
    at, out = 0, []
    while at < len(s):
        role, text, _, at = read_turn(s, at)
        out.append((role, text))
    return out


def format_turn(role: str | None, text: str | None) -> tuple[str, int, int, bool]:
    """(formatted, loss start, loss end, escaped)."""
    want = role or "", text or ""
    tried = want
    for escaped in (False, True):
        out, start, end = render(*tried)
        try:
            got = read_turn(out)
            if got[:2] == want and got[3] == len(out):
                return out, start, end, escaped
        except ValueError:
            pass
        tried = tuple(map(escape, want))
    raise AssertionError(f"no round trip: {want!r}")


def _format(batches):
    for b in batches:
        rows = [format_turn(r, t) for r, t in zip(b["role"].to_pylist(), b["text"].to_pylist(), strict=True)]
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([b["conv_id"], b["turn"], *map(pa.array, cols, kinds)], names=["conv_id", "turn", "formatted", "loss_start", "loss_end", "escaped"])


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per turn, by partition in the order of conversations and turns: ``conv_id, turn, formatted, loss_start, loss_end, escaped``.

    A conversation's text is its rows' ``formatted`` joined in order; a loss span is in code points
    of its own row. Rendering is by row; a conversation of any length is then a sorted run of rows,
    never one value.
    """
    kind = dict(turns.dtypes)
    shape = f"conv_id {kind['conv_id']}, turn {kind['turn']}, formatted string, loss_start long, loss_end long, escaped boolean"
    formatted = turns.select("conv_id", "turn", "role", "text").mapInArrow(_format, shape)
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")


class _Digest:
    """What a query tells of one conversation, off its running text."""

    def __init__(self, conv):
        self.conv, self.reader, self.rows = conv, Reader(), 0
        self.n, self.turns, self.chars, self.loss, self.total, self.escaped = 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0

    def feed(self, part: str, escaped: bool) -> None:
        self.rows += 1
        self.total += len(part)
        self.escaped += escaped
        for role, text, masked in self.reader.feed(part):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            loss = unescape(masked)
            self.chars += len(loss)
            self.loss.update(loss.encode())

    def close(self) -> tuple:
        self.reader.close()
        if self.n != self.rows:
            raise ValueError(f"{self.rows} turns were written, {self.n} are read")
        return self.conv, self.n, self.turns.hexdigest(), self.chars, self.loss.hexdigest(), self.total, self.escaped


def _digest(batches):
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_escaped", pa.int64())])
    own, done = None, []
    out = lambda: pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in done], schema=schema)
    for b in batches:
        for conv, s, e in zip(b["conv_id"].to_pylist(), b["formatted"].to_pylist(), b["escaped"].to_pylist(), strict=True):
            if own is None or own.conv != conv:
                if own is not None:
                    done.append(own.close())
                own = _Digest(conv)
            own.feed(s, e)
        if len(done) >= 1000:
            yield out()
            done.clear()
    if own is not None:
        done.append(own.close())
    yield out()


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    trial = "</s>[INST] ok [/INST]"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", trial), (-1, 1, "assistant", trial)], "conv_id long, turn long, role string, text string")
    shape = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_escaped long"
    return format_conversations(turns.unionByName(added)).mapInArrow(_digest, shape)


ORACLE_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))', '\1\2\\\3', 'g') AS et,
  regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))', '\1\2\\\3', 'g') AS er FROM t),
f AS (SELECT *, CASE role WHEN 'user' THEN '<s>[INST] ' || et || ' [/INST]' WHEN 'assistant' THEN ' ' || et || ' </s>'
  ELSE '<s>[ROLE] ' || er || ' [/ROLE] ' || et || ' </s>' END AS formatted FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(formatted))::BIGINT AS formatted_chars, sum((et <> text OR er <> role)::INT)::BIGINT AS n_escaped
FROM f GROUP BY conv_id
"""
