import random

from findery.llm import counts
from findery.llm.tokens import encoder, pretokens

ALPHABET = " \n\t abcé'sdt123.,!? 汉x\u00a0"


def test_edits_against_counting_all(monkeypatch):
    encode, count, cut, rng = encoder(), counts.counter("byte_bpe_50k.json"), pretokens(), random.Random(3)
    monkeypatch.setattr(counts, "RUN", 8)
    for _ in range(1500):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(80)))
        own = counts.CountedText(text, count, cut)
        assert own.tokens == len(encode(text))
        for _ in range(rng.randrange(1, 6)):
            a = rng.randrange(len(text) + 1)
            b = min(len(text), a + rng.choice([0, 0, 1, 3, 20, 90]))
            new = "".join(rng.choice(ALPHABET) for _ in range(rng.choice([0, 1, 2, 10, 40])))
            text = text[:a] + new + text[b:]
            own.replace(a, b, new)
            assert own.text == text and own.tree.total == (len(text), len(encode(text)))


def test_edits_that_make_and_break_special_tokens(monkeypatch):
    encode, count, cut, rng = encoder(), counts.counter("byte_bpe_50k.json"), pretokens(), random.Random(8)
    monkeypatch.setattr(counts, "RUN", 4)
    parts = ["<|endoftext|>", "<|endoftext", "|>", "<", "!", " ", "  ", "a", "endoftext|>", "\n"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        own = counts.CountedText(text, count, cut)
        for _ in range(4):
            a = rng.randrange(len(text) + 1)
            b, new = min(len(text), a + rng.choice([0, 0, 1, 2, 13])), rng.choice([*parts, "", ">", "<|end"])
            text = text[:a] + new + text[b:]
            own.replace(a, b, new)
            assert own.text == text and own.tokens == len(encode(text))


def test_only_touched_runs_are_counted_anew():
    count, cut = counts.counter("byte_bpe_50k.json"), pretokens()
    own = counts.CountedText("some words here " * 20000, count, cut)
    own.replace(100_000, 100_003, "new")
    assert 0 < own.recounted < 4 * counts.RUN and own.text[100_000:100_003] == "new"


def test_tree():
    tree = counts.Tree([(3, 1), (0, 0), (4, 2)])
    assert [tree.find(i)[0] for i in (0, 2, 3, 6)] == [0, 0, 2, 2] and tree.find(7) == (2, 3)
    tree.put(0, (5, 9))
    assert tree.total == (9, 11)


def test_hard_rows(spark):
    edits = "array<struct<start: long, length: long, text: string>>"
    rows = [(1, None, [(0, 0, "abc")]), (2, "hello world", None), (3, "hello", [None, (-5, 2, None), (99, 9, "!"), (None, 1, "x"), (0, None, "y")]), (None, "", []), (3, "a", []), (4, "word " * 30000, [(10, 100000, "")])]
    df = spark.createDataFrame([(*r, 5) for r in rows], f"doc_id long, text string, edits {edits}, tokens_before int")
    got = [tuple(r)[:4] for r in counts.count_edits(df).collect()]
    n = lambda t: len(encoder()(t))
    long = "word " * 30000
    cut = long[:10] + long[100010:]
    want = [(1, 0, n("abc"), 3), (2, 2, 2, 11), (3, 1, n("yhello!"), 7), (None, 0, 0, 0), (3, 1, 1, 1), (4, n(long), n(cut), len(cut))]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert counts.count_edits(df.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    encode = encoder()
    for r in counts.op10_token_counts(spark, folder).collect():
        t, n = texts[r["doc_id"]], len(texts[r["doc_id"]])
        assert r["tokens_before"] == len(encode(t))
        t = t[: n // 2] + " corrected" + t[n // 2 :]
        t = t[: n // 4] + t[n // 4 + 10 :]
        t = t[:n] + " The end." + t[n:]
        assert r["tokens_after"] == len(encode(t)) and r["chars_after"] == len(t)
