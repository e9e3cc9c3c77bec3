import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from findery.llm import alignment as al
from findery.llm.tokens import vocabulary

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    """text -> (A's ids and bytes, B's ids and bytes), by the libraries on whole texts."""
    t = Tokenizer.from_file(vocabulary(al.A))
    t.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary(al.B))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(shown)))}
    b_bytes = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()

    def run(text):
        a, b = t.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
        return (a, [bytes(byte[c] for c in t.id_to_token(i)) for i in a]), (b, [b_bytes(i) for i in b])

    return run


def ends(parts):
    return np.cumsum([len(p) for p in parts]).tolist()


def expected(rows, plain):
    told, links = [], []
    for d, text in rows:
        (a, x), (b, y) = plain(text) if text else (([], []), ([], []))
        whole = (" " + text).encode() if text else b""
        if b"".join(x) != whole or b"".join(y) != whole or not text:
            told.append((d, 0, 0, 0, ""))
            links.append([])
            continue
        at_a, at_b = dict(zip(ends(x), range(len(a)), strict=True)), dict(zip(ends(y), range(len(b)), strict=True))
        groups, i, j = [], 0, 0
        for e in sorted(at_a.keys() & at_b.keys()):
            groups.append(",".join(map(str, a[i : at_a[e] + 1])) + "|" + ",".join(map(str, b[j : at_b[e] + 1])))
            i, j = at_a[e] + 1, at_b[e] + 1
        told.append((d, len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        links.append([(a[at_a[e]], b[at_b[e]]) for e in at_a.keys() & at_b.keys()])
    n = Counter(p for x in links for p in x)
    most = {}
    for (_, b), c in n.items():
        most[b] = max(most.get(b, 0), c)
    return sorted(((d, na, nb, g, len(x), sum(n[p] == most[p[1]] for p in x), sum(n[p] for p in x), sha) for (d, na, nb, g, sha), x in zip(told, links, strict=True)), key=repr)


HARD = [(1, None), (2, ""), (3, "a ▁ b"), (3, " "), (4, "x <|endoftext|> </s> <s> <0x0A> 한국 🙂\t\n  é "), (None, "   two  "), (None, "Hello  world"), (5, "a"), (6, "x" * 3000), (7, "né     x　 y\r\n  z"), (4, "   two  "), (8, "<unk>")]


@pytest.mark.parametrize("common", [3, al.COMMON])
def test_hard_rows(spark, plain, common):
    df = spark.createDataFrame([(*r, 1, "x", [1]) for r in HARD], "doc_id long, text string, n_a int, groups string, links array<int>").repartition(3)
    assert sorted(map(tuple, al.digests(df, common=common).collect()), key=repr) == expected(HARD, plain)


def test_no_rows(spark):
    df = spark.createDataFrame(HARD, "doc_id long, text string")
    assert al.digests(df.limit(0)).count() == 0
    assert [tuple(r)[1:] for r in al.digests(df.filter("text = ''")).collect()] == [(0, 0, 0, 0, 0, 0, "")]


def test_pieces_give_the_ids_of_whole_texts(plain):
    rng = random.Random(3)
    signs = [" ", " ", "  ", "\n", "\t", "a", "bc", "É", "1", "23", "'s", "!", "한", " ", " ", "　", "🙂", "<s>", "<0x0A>", "\x1c", "\x85", ".", "\r\n"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(1500)]
    out = next(al._tokenise(al.A, al.B)(iter([pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})]))).to_pylist()
    for text, got in zip(texts, out, strict=True):
        (a, x), (b, y) = plain(text)
        assert (got["a_ids"], got["b_ids"]) == (a, b), repr(text)
        assert (got["a_ends"], got["b_ends"]) == (ends(x), ends(y))


def test_pieces_of_real_texts(spark, plain):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, al.op13_alignment(spark, SMALL).collect()), key=repr) == expected(rows, plain)


def test_groups_and_links(spark):
    df = spark.createDataFrame([(1, [10, 11, 12, 13], [1, 3, 4, 6], [20, 21, 22], [3, 5, 6]), (2, [], [], [], []), (3, [7], [2], [8], [2])], al._TOKENS)
    got = {r["doc_id"]: (r["shared"], r["groups"], [(x >> 32, x & 0xFFFFFFFF) for x in r["links"]]) for r in al.align(df).collect()}
    assert got == {1: ([3, 6], ["10,11|20", "12,13|21,22"], [(11, 20), (13, 22)]), 2: ([], [], []), 3: ([2], ["7|8"], [(7, 8)])}


def test_groups_of_many_rows_and_any_ids(spark, plain):
    """Rows in runs, ids of no vocabulary, other columns kept; ``aligned`` holds the same as text."""
    rng = random.Random(6)
    rows = []
    for d in range(600):
        ends_of = [sorted({*rng.sample(range(1, 40), rng.randrange(8)), 40}) if d % 5 else [] for _ in "ab"]
        rows.append((d, [rng.choice((0, 7, 50_000, 2**31 - 1)) for _ in ends_of[0]], ends_of[0], [rng.randrange(9) for _ in ends_of[1]], ends_of[1], f"k{d}"))
    got = al.align(spark.createDataFrame(rows, al._TOKENS + ", other string").coalesce(1)).orderBy("doc_id").collect()
    for r, (d, a, x, b, y, other) in zip(got, rows, strict=True):
        shared, groups, links, i, j = sorted({*x} & {*y}), [], [], 0, 0
        for e in shared:
            m, n = x.index(e) + 1, y.index(e) + 1
            groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
            links.append(a[m - 1] << 32 | b[n - 1])
            i, j = m, n
        assert (r["doc_id"], r["other"], r["shared"], r["groups"], r["links"]) == (d, other, shared, groups, links)
    docs = spark.createDataFrame(HARD, "doc_id long, text string").coalesce(1)
    one, two = al.aligned(docs).collect(), al.align(al.tokens(docs)).collect()
    assert [(r["doc_id"], r["n_a"], r["n_b"], r["groups"], r["links"]) for r in one] == [(r["doc_id"], len(r["a_ids"]), len(r["b_ids"]), ";".join(r["groups"]), r["links"]) for r in two]


def test_no_element_is_interpreted(spark):
    """Groups and links cost array operations in the worker; as Spark's lambdas they took most of the time."""
    plan = al.aligned(spark.createDataFrame(HARD, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "lambda" not in plan
