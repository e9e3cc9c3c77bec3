import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from findery.llm import packing
from findery.llm.tokens import encoder, vocabulary


@pytest.fixture(scope="module")
def reference():
    """The tokenizer as its file gives it, special tokens included."""
    t = Tokenizer.from_file(vocabulary())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


ROWS = [(1, "Hello  wörld\n\n x"), (2, None), (3, ""), (None, "null id"), (1, "Hello  wörld\n\n x"), (4, "<|endoftext|> 汉字 " * 50), (5, "ab " * 9000), (6, "x" * 5000), (7, " \t\n " * 400)]


def check(rows, pieces, reference, capacity=2048):
    want = defaultdict(list)
    for doc_id, text in rows:
        want[doc_id].append(reference(text))
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
    padding = total = 0
    for s in sequences.values():
        s.sort(key=lambda p: p["offset"])
        at = 0
        for p in s:
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    for doc_id, texts in want.items():
        own = sorted((p["start"], p["length"]) for p in pieces if p["doc_id"] == doc_id)
        assert sum(n for _, n in own) == sum(map(len, texts))
        if len(texts) == 1:
            ends = 0
            for start, n in own:
                assert start == ends
                ends += n
            assert ends == len(texts[0])
    return padding, total


def test_pieces_make_up_the_documents(spark, reference):
    df = spark.createDataFrame([(*r, 9) for r in ROWS], "doc_id long, text string, length int").repartition(3)
    pieces = packing.pack(df).collect()
    padding, total = check(ROWS, pieces, reference)
    assert padding <= 0.01 * total
    for doc_id, text in ROWS:
        ids = reference(text)
        for p in pieces:
            if p["doc_id"] == doc_id:
                assert p["ids"] == ids[p["start"] : p["start"] + p["length"]] and p["doc_tokens"] == len(ids)


def test_query(spark, reference):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    pieces = packing.op2_packing(spark, folder).collect()
    padding, total = check(rows, pieces, reference)
    assert padding <= 0.01 * total
    texts = dict(rows)
    for p in pieces:
        own = np.array(reference(texts[p["doc_id"]])[p["start"] : p["start"] + p["length"]], dtype="<u4")
        assert len(own) == p["length"] and zlib.crc32(own.tobytes()) == p["ids_crc32"]


def test_harmonic_classes():
    rng = random.Random(2)
    for capacity, small in ((2048, 64), (100, 7), (1, 1), (17, 3)):
        packer, have, want = packing.Packer(capacity, small), defaultdict(int), {}
        full = []
        for doc in range(200):
            n = want[doc] = rng.randrange(0, 3 * capacity)
            for k, length in packing.cut(n, capacity, small):
                assert length * k <= capacity < length * (k + 1)
            full += packer.add(doc, np.arange(n, dtype="<u4"))
        for s in [*full, *packer.finish()]:
            size = sum(p[2] for p in s)
            assert 0 < size <= capacity
            for doc, start, length, ids in s:
                assert ids.tolist() == list(range(start, start + length))
                have[doc] += length
        assert all(have[d] == n for d, n in want.items())


def test_empty_table(spark):
    assert packing.pack_sums(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ids_are_those_of_the_tokenizer(reference):
    rng = random.Random(4)
    encode = encoder()
    for _ in range(300):
        text = "".join(rng.choice("ab '’sétŽ汉🙂\n\t 12.!\u00a0\u3000<|endoftext|>") for _ in range(rng.randrange(60)))
        assert [*encode(text), 1] == reference(text)


def test_special_tokens(reference):
    assert encoder()("a <|endoftext|> b") == [64, 220, 50256, 275]
    rng = random.Random(9)
    for _ in range(500):
        text = "".join(rng.choice(["<|endoftext|>", "<|", "|>", "endoftext", " ", "  ", "\n", "a", "!", "é", "<|endoftext"]) for _ in range(rng.randrange(12)))
        assert [*encoder()(text), 1] == reference(text)


def test_all_documents_have_the_tokenizers_ids(spark, reference):
    encode = encoder()
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect():
        assert [*encode(r["text"] or ""), 1] == reference(r["text"])


def test_what_waits_holds_no_documents():
    rng, packer = random.Random(3), packing.Packer()
    for doc in range(3000):
        packer.add(doc, np.zeros(rng.randrange(1, 60_000), dtype="<u4"))
        assert packer.waiting() <= 4 * 2048 * len(packer.open) <= 1 << 20


def test_sequences_keep_their_numbers_in_fewer_tasks(spark, reference):
    df = spark.createDataFrame([(i, f"word{i} " * (50 + i)) for i in range(64)], "doc_id long, text string").repartition(8)
    pieces = packing.pack_sums(df).coalesce(2).collect()
    check([(r["doc_id"], r["text"]) for r in df.collect()], pieces, reference)
