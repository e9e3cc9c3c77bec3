import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from findery.llm import chat
from tests.compare import same

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "\\", "<", "[", " ", "s>", "INST]", "/", "ok", "\n", "é", "<\\/s>"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=5))
def test_round_trip(turns):
    parts = [chat.format_turn(r, t) for r, t in turns]
    whole = "".join(p[0] for p in parts)
    assert chat.read(whole) == turns
    for (role, text), (out, start, end, escaped) in zip(turns, parts, strict=True):
        assert chat.unescape(out[start:end]) == (text if role == "assistant" else "")
        assert escaped or out == chat.render(role, text)[0]
        body = out.replace(chat.render(role, "")[0], "") if not text else chat.escape(text)
        assert not chat.BARE.search(body) or not text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=5), st.lists(st.integers(0, 200), max_size=6))
def test_turns_are_read_off_a_running_text(turns, cuts):
    """Cut anywhere, the text gives the same turns: their ends are the grammar's."""
    whole = "".join(chat.format_turn(r, t)[0] for r, t in turns)
    at = [0, *sorted(min(c, len(whole)) for c in cuts), len(whole)]
    reader = chat.Reader()
    got = [x for a, b in zip(at[:-1], at[1:], strict=True) for x in reader.feed(whole[a:b])]
    reader.close()
    assert [x[:2] for x in got] == turns
    assert all(chat.unescape(masked) == (text if role == "assistant" else "") for role, text, masked in got)


def test_text_that_no_grammar_gives_is_refused():
    reader = chat.Reader()
    assert list(reader.feed("<s>[INST] a [/INST] b")) == [("user", "a", "")]
    with pytest.raises(ValueError, match="ends within"):
        reader.close()
    for bad in ("x", "<s>[INST] a </s>", "<s>[INST] a[/INST]", " a [/INST]"):
        with pytest.raises(ValueError):
            list(chat.Reader().feed(bad))
    own = chat._Digest(1)
    own.feed("<s>[INST] a [/INST] b </s>", False)  # one row, but two turns
    with pytest.raises(ValueError, match="are read"):
        own.close()


@given(TEXT)
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and not chat.BARE.search(chat.escape(text))


def test_query(spark):
    got = same(chat.op6_chat_formatting(spark, "/root/testdata/sf0.01"), chat.ORACLE_SQL, "/root/testdata/sf0.01")
    trial = next(r for r in got if r["conv_id"] == -1)
    text = "</s>[INST] ok [/INST]"
    assert trial["n_escaped"] == 2 and trial["loss_chars"] == len(text) and trial["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_hard_rows(spark, tmp_path):
    rows = [(1, 0, "user", None, 3), (1, 1, None, "x", 3), (1, 1, None, "x", 3), (None, 0, "assistant", "a </s>", 3), (None, None, "user", "n", 3), (2, 5, "assistant", "", 3), (3, 0, "user", "long " * 50000, 3)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int").write.parquet(str(tmp_path / "conversations.parquet"))
    same(chat.op6_chat_formatting(spark, str(tmp_path)), chat.ORACLE_SQL, str(tmp_path))
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    assert chat.op6_chat_formatting(spark, str(tmp_path)).count() == 1


def test_conversations_read_back_whole(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} </s> {t}") for c in range(20) for t in range(6)]
    out = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)).collect()
    for c in range(20):
        whole = "".join(r["formatted"] for r in out if r["conv_id"] == c)
        assert chat.read(whole) == [r[2:] for r in rows if r[0] == c]


def test_turns_are_rendered_before_they_move(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.format_conversations(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("MapInArrow")
