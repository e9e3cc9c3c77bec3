"""Searches, fusion, backfill and selection against plain Python over hand-made corpora."""

import sys
from collections import Counter
from math import sqrt

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from findery.functions import text as text_functions
from findery.functions.text import token_codes, tokens_python
from findery.operators import answers, fusion, retrieval
from findery.plans import hybrid
from findery.scratch import materialize
from findery.sources import eav

HOT = ", ".join(f"{k} string" for k in eav.HOT)


def make_chunks(spark, rows):
    """rows: (ord, text, metadata, embedding)"""
    flat = spark.createDataFrame([(o, f"c{o}", t, m, e) for o, t, m, e in rows], "ord long, chunk_id string, text string, metadata map<string,string>, embedding array<float>")
    return flat.select("*", *(F.col("metadata")[k].alias(k) for k in eav.HOT))


def make_questions(spark, rows):
    return spark.createDataFrame(rows, "question_id long, question string, issuers array<string>, max_contexts int, vector array<double>")


TEXTS = ["서버 구축 사업", "서버 서버 구축", "네트워크 보안", "", "abc abc", "서버 구축 사업", "보안 서버", "zz"]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = []
    for i, t in enumerate(TEXTS):
        meta = {"issuer": "가" if i % 2 == 0 else "나", "fact_type": "project_budget" if i in (2, 5) else "document_summary", "doc_id": f"d{i // 2}"}
        if i == 5:
            meta["budget_answer_enabled"] = "Yes "
        rows.append((i, t, meta, [float(i), 1.0] if i != 3 else None))
    return make_chunks(spark, rows)


def test_sparse_search(spark, corpus):
    questions = [(1, "서버 구축", ["가"]), (2, "서버 보안", ["가", "나 "]), (3, "없는말", ["가"]), (4, "서버", ["다"])]
    got = retrieval.sparse_search(corpus, make_questions(spark, [(*q, 5, None) for q in questions]), k=3)
    have = {}
    for r in got.orderBy("question_id", "rank").collect():
        have.setdefault(r["question_id"], []).append((r["rank"], r["ord"], r["sparse_score"]))
    for qid, question, issuers in questions:
        wanted, q = [], Counter(tokens_python(question))
        for i, t in enumerate(TEXTS):
            own = Counter(tokens_python(t))
            overlap = sum((q & own).values())
            if ("가" if i % 2 == 0 else "나") in {x.strip() for x in issuers} and overlap:
                wanted.append((-overlap / sqrt(max(1, len(own))), i))
        assert have.get(qid, []) == [(n, i, -s) for n, (s, i) in enumerate(sorted(wanted)[:3], 1)]


def test_question_blocks_give_the_same(spark, corpus, monkeypatch):
    asked = make_questions(spark, [(i, t or "x", ["가", "나"], 5, [1.0, float(i)]) for i, t in enumerate(TEXTS)])
    one = [sorted(map(tuple, f(corpus, asked).collect())) for f in (retrieval.sparse_search, retrieval.dense_search)]
    monkeypatch.setattr(retrieval, "BLOCK", 3)
    assert [sorted(map(tuple, f(corpus, asked).collect())) for f in (retrieval.sparse_search, retrieval.dense_search)] == one


def test_an_index_gives_the_same(spark, corpus, monkeypatch):
    asked = make_questions(spark, [(i, t or "x", ["가", "나"], 5, None) for i, t in enumerate(TEXTS)])
    rows = lambda **how: sorted(map(tuple, retrieval.sparse_search(corpus, asked, **how).collect()))
    one = rows()
    index = materialize(retrieval.sparse_index(corpus), "test-index")
    assert rows(index=index) == one
    for r in index.collect():
        own = Counter(tokens_python(TEXTS[r["ord"]]))
        assert sorted(r["counts"]) == sorted(own.values()) and len(r["tokens"]) == len(own)
    monkeypatch.setattr(retrieval, "sparse_index", None)  # what is tokenised already is not tokenised again
    assert rows(index=index) == one


def test_token_codes_are_the_tokens():
    texts = [*TEXTS, None, "가나다라 가나 가나다 abcd abc ab a", "e\u0301 ×÷ 1 22 333 4444", "한국어 " * 50]
    seen = {}
    for t in texts:
        words, codes = Counter(tokens_python(t)), Counter(token_codes(t).tolist())
        assert sorted(words.values()) == sorted(codes.values())
        for w in words:
            (c,) = set(token_codes(w).tolist()) & set(codes) if len(w) in (2, 3) and " " not in w and len(tokens_python(w)) == 2 else (None,)
            if c is not None:
                assert seen.setdefault(c, w) == w and codes[c] == words[w]


def test_words_that_a_worker_keeps_are_bounded():
    """However many and however long a corpus' words are, and with the same codes."""
    first = token_codes("서버구축사업 abcdef " + "x" * 5000)
    for i in range(20):
        token_codes(" ".join(f"w{i}x{k}" for k in range(10_000)))
    token_codes(" ".join("y" * 20_000 + str(k) for k in range(100)))
    kept = text_functions._WORDS
    assert sys.getsizeof(kept) + sum(map(sys.getsizeof, kept)) + sum(map(sys.getsizeof, kept.values())) < 15 << 20
    assert token_codes("서버구축사업 abcdef " + "x" * 5000).tolist() == first.tolist()


@pytest.mark.parametrize("kind", ["string", "int", "decimal(20,0)"])
def test_question_ids_of_any_type(spark, corpus, monkeypatch, kind):
    asked = make_questions(spark, [(i, t or "x", ["가", "나"], 5, [1.0, float(i)]) for i, t in enumerate(TEXTS)])
    other = asked.withColumn("question_id", F.col("question_id").cast(kind))
    for block in (4096, 3):
        monkeypatch.setattr(retrieval, "BLOCK", block)
        for search in (retrieval.sparse_search, retrieval.dense_search):
            got, want = search(corpus, other), search(corpus, asked)
            assert dict(got.dtypes)["question_id"] == kind
            assert sorted(map(tuple, got.withColumn("question_id", F.col("question_id").cast("long")).collect())) == sorted(map(tuple, want.collect()))


def test_vectors_of_several_lengths(spark):
    meta = {"issuer": "가"}
    chunks = make_chunks(spark, [(1, "t", meta, [1.0, 0.0]), (2, "t", meta, [0.0, 1.0, 0.0]), (3, "t", meta, [1.0, None]), (4, "t", meta, []), (5, "t", {"issuer": None}, [0.5, 0.5]), (6, "t", meta, [float("nan"), 1.0])])
    asked = make_questions(spark, [(1, "q", ["가"], 5, [2.0, 0.0]), (2, "q", ["가"], 5, [0.0, 3.0, 0.0]), (3, "q", [], 5, [1.0, 0.0]), (4, "q", ["가"], 5, [None, 1.0]), (5, "q", ["가"], 5, [])])
    got = retrieval.dense_search(chunks, asked).orderBy("question_id", "rank").select("question_id", "ord", "similarity").collect()
    assert list(map(tuple, got)) == [(1, 1, 1.0), (2, 2, 1.0), (3, 1, 1.0), (3, 5, 0.5)]


def test_a_full_block_takes_little_memory():
    """4,096 questions and 10,000 chunks in one batch: less than 500 MB beside the inputs."""
    import tracemalloc

    rng, words = np.random.default_rng(0), [f"w{i}x" for i in range(400)]
    rows = [{"question_id": i, "question": " ".join(rng.choice(words, 6)), "issuers": ["가"], "forms": [] if i % 2 else ["가"], "vector": rng.standard_normal(64).tolist()} for i in range(4096)]
    ids, n = pa.array(range(4096)), 10_000
    made = [np.unique(token_codes(" ".join(rng.choice(words, 60))), return_counts=True) for _ in range(200)] * 50
    ends = pa.array(np.r_[0, np.cumsum([len(t) for t, _ in made])].astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([m[i] for m in made]).view(np.int64))) for i in (0, 1)]
    base = [pa.array(range(n)), pa.array([f"c{i}" for i in range(n)]), pa.array(["가"] * n)]
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 64), pa.array(rng.standard_normal(n * 64).astype(np.float32)))
    sparse = pa.RecordBatch.from_arrays([*base, *lists], names=["ord", "chunk_id", "issuer", "tokens", "counts"]).slice(0, 1500)
    dense = pa.RecordBatch.from_arrays([*base, vectors], names=["ord", "chunk_id", "issuer", "embedding"])
    for kernel, batch in ((retrieval._sparse, sparse), (retrieval._dense, dense)):
        run = kernel(rows, ids, 50)
        tracemalloc.start()
        (out,) = run([batch])
        assert tracemalloc.get_traced_memory()[1] < 500 << 20 and len(out) == 4096 * 50
        tracemalloc.stop()


def test_texts_are_scored_in_little_memory():
    """As an index of them is, whatever a batch holds: tokens of a run of texts at a time, and of a long text in runs of pairs."""
    import tracemalloc

    rng, letters = np.random.default_rng(1), list("abcdefghijklmnopqrstuvwxyz ")
    texts = ["".join(rng.choice(letters, 2000)) for _ in range(1000)] + ["".join(rng.choice(letters, 60_000))]
    rows = [{"question_id": i, "question": texts[i][:500] if i % 2 else texts[-1][:5000], "issuers": ["가"]} for i in range(200)]
    ids, n = pa.array(range(200)), len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([f"c{i}" for i in range(n)]), pa.array(["가"] * n), pa.array(texts)], names=["ord", "chunk_id", "issuer", "text"])
    run = retrieval._sparse(rows, ids, 5)
    tracemalloc.start()
    (out,) = run([batch])
    assert tracemalloc.get_traced_memory()[1] < 48 << 20
    tracemalloc.stop()
    (want,) = run([retrieval._indexed(batch)])
    assert out.equals(want) and len(out) == 200 * 5
    assert [len(x) for x in run([batch.slice(0, 0)])] == [0]


def test_texts_reach_one_worker_a_task(spark, corpus):
    plan = retrieval.sparse_search(corpus, make_questions(spark, [(1, "서버", ["가"], 5, None)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_dense_search(spark, corpus):
    got = retrieval.dense_search(corpus, make_questions(spark, [(1, "q", ["가"], 5, [3.0, 4.0]), (2, "q", [], 5, [0.0, 2.0]), (3, "q", ["가"], 5, None)]), k=3).orderBy("question_id", "rank")
    assert [(r["question_id"], r["ord"], r["similarity"]) for r in got.collect()] == [(1, 6, 4.4), (1, 4, 3.2), (1, 2, 2.0), (2, 0, 1.0), (2, 1, 1.0), (2, 2, 1.0)]


def test_empty_tables(spark, corpus):
    none = make_questions(spark, [])
    assert hybrid.retrieve(corpus, none).merged.count() == 0
    assert hybrid.retrieve(corpus.limit(0), make_questions(spark, [(1, "서버", ["가"], 5, [1.0, 0.0])])).merged.count() == 0


def ranked_list(spark, rows, name):
    return spark.createDataFrame([(1, o, c, r, name) for r, (o, c) in enumerate(rows, 1)], "question_id long, ord long, chunk_id string, rank int, retriever string")


def test_rrf(spark):
    a = ranked_list(spark, [(1, "x"), (2, "y"), (9, ""), (3, "z")], "sparse")
    b = ranked_list(spark, [(2, "y"), (1, "x"), (4, "w")], "dense")
    got = [tuple(r) for r in fusion.rrf([a, b]).orderBy("rrf_rank").select("chunk_id", "rrf_score", "retrievers").collect()]
    assert got == [("x", 1 / 61 + 1 / 62, "dense,sparse"), ("y", 1 / 62 + 1 / 61, "dense,sparse"), ("w", 1 / 63, "dense"), ("z", 1 / 64, "sparse")]
    spread = [tuple(r) for r in fusion.rrf([a.repartition(3), b.repartition(2)]).orderBy("rrf_rank").select("chunk_id", "rrf_score", "retrievers").collect()]
    assert spread == got


def test_backfill_takes_two_a_document_in_corpus_order(spark):
    rows = [(i, "t", {"issuer": "가", "doc_id": "d", "canonical_doc_id": "" if i % 2 else "k", "fact_type": "table" if i == 3 else "document_summary"}, None) for i in range(8)]
    chunks = make_chunks(spark, rows)
    asked = hybrid.prepare(make_questions(spark, [(1, "예산", ["가"], 5, None)]))
    fused = fusion.rrf([ranked_list(spark, [(1, "c1"), (0, "c0")], "dense")])
    got = fusion.backfill(fused, asked, hybrid.facts_of(chunks)).orderBy("rank").collect()
    assert [(r["rank"], r["ord"]) for r in got] == [(1, 0), (2, 1), (3, 2), (4, 5)]


def test_budget_takes_safe_rows_alone(spark, corpus):
    asked = make_questions(spark, [(1, "서버 예산", ["가", "나"], 3, [1.0, 0.0]), (2, "서버 예산", ["가"], 3, [1.0, 0.0]), (3, "서버", ["나"], 0, [1.0, 0.0])])
    found = hybrid.retrieve(corpus, asked)
    ranked, picked = hybrid.select(corpus, found)
    rows = {}
    for r in picked.orderBy("question_id", "context_rank").collect():
        rows.setdefault(r["question_id"], []).append(r["ord"])
    assert rows[1] == [5]
    assert hybrid.lookups(corpus, found, ranked, picked).count() == 0  # looked up, as "Yes " is padded, but no number is there
    assert len(rows[2]) == 3 and rows[2][0] == 2  # no safe row: by score, the budget fact first
    assert len(rows[3]) == 4 - 1  # the vectorless, textless chunk is found by neither search
    top = ranked.filter("question_id = 1 AND ord = 5").first()
    assert top["metadata_priority"] == 130 and top["final_score"] == pytest.approx(top["rrf_score"] + 0.13)


def notices_of(spark, texts, limit=3):
    rows = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "question_id long, at int, candidate string")
    rows = rows.withColumn("numbers", answers.notice_numbers(F.col("candidate")))
    return [r["notice_number"] for r in answers.notices(rows, "at", limit=limit).orderBy("n").collect()]


def test_notice_numbers(spark):
    assert notices_of(spark, ["공고번호：1234567890-01 그리고 2024123456"]) == ["2024123456", "1234567890-01"]
    assert notices_of(spark, ["공고2024123456", "2024123456-00 2024123456-00"]) == ["2024123456-00"]
    assert notices_of(spark, ["20241234567890123"]) == []
    assert notices_of(spark, ["2024000001 2024000002", "2024000001 2024000003 2024000004"]) == ["2024000001", "2024000002", "2024000003"]


def test_ask(spark):
    meta = {"issuer": "가", "fact_type": "document_summary", "doc_id": "d", "source_file": "f.hwp", "project_name": "p", "section_type": "s"}
    chunks = make_chunks(spark, [(1, "예산 내용\n\n있음 공고번호: 1234567890", meta, [1.0, 0.0]), (2, "다른 글", {**meta, "section_path": "1/2"}, [0.0, 1.0])])
    asked = make_questions(spark, [(1, "예산", [" 가 "], 5, [1.0, 0.0]), (2, "개선", ["가"], 1, [1.0, 0.0]), (3, "아무", ["나"], 5, None), (4, "무엇 다른", ["가"], 5, [0.0, 1.0])])

    def client():
        def speak(system, prompt, tokens):
            if "무엇" in prompt:
                return f"말 {len(prompt)} {tokens}"
            raise RuntimeError("no")

        return speak

    rows = {r["question_id"]: r for r in hybrid.ask(chunks, asked, client).collect()}
    assert rows[1]["answer"].split("\n")[0] == answers.NO_BUDGET
    assert rows[1]["answer"].endswith(f"- 공고번호: 1234567890\n- 확인 경로: {answers.LOOKUP_URL}")
    assert rows[1]["route"] == ["issuer_filter", "hybrid_dense_sparse", "ngram_backfill", "metadata_rerank", "budget_strict_selection", "g2b_manual_lookup", "llm_fallback"]
    assert rows[1]["issuers"] == ["가"] and rows[1]["generator_error"] == "RuntimeError: no" and rows[1]["lookups"][0]["source_file"] == "f.hwp"
    assert rows[2]["answer"] == f"{answers.LEAD_PURPOSE}\n- 예산 내용 있음 공고번호: 1234567890\n\n출처: f.hwp" and rows[2]["selected_count"] == 1
    assert rows[3]["answer"] == answers.NO_CONTEXT and rows[3]["route"][-1] == "no_context" and rows[3]["merged_count"] == 0
    prompt = answers.PROMPT % ("무엇 다른", answers.CONTEXT % (1, "f.hwp", "가", "p", "1/2", "document_summary", "다른 글") + "\n\n" + answers.CONTEXT % (2, "f.hwp", "가", "p", "s", "document_summary", "예산 내용\n\n있음 공고번호: 1234567890"))
    assert rows[4]["answer"] == f"말 {len(prompt)} 320" and rows[4]["generator_error"] is None


def test_embed(spark):
    asked = make_questions(spark, [(1, "ab", ["가"], 5, None)])
    assert answers.embed(asked, lambda: lambda texts: [[len(t), 0.5] for t in texts]).first()["vector"] == [2.0, 0.5]
    twice = asked.unionByName(asked).withColumn("question", F.lit(None).cast("string"))
    assert [r["vector"] for r in answers.embed(twice, lambda: lambda texts: [[len(t), 0.5] for t in texts]).collect()] == [[0.0, 0.5]] * 2


def test_ask_embeds_the_questions(spark, corpus):
    asked = make_questions(spark, [(1, "서버 구축", ["가"], 5, [9.0, 9.0]), (2, "", ["가"], 5, None)])
    rows = {r["question_id"]: r for r in hybrid.ask(corpus, asked, embedder=lambda: lambda texts: [[1.0, 0.0] for _ in texts]).collect()}
    given = hybrid.ask(corpus, make_questions(spark, [(1, "서버 구축", ["가"], 5, [1.0, 0.0])])).first()
    assert rows[1]["contexts"] == given["contexts"] and rows[1]["dense_count"] == given["dense_count"] > 0 and rows[2]["status"] == "refused"

    def broken():
        raise OSError("no model")

    with pytest.warns(UserWarning, match="no model"):
        row = hybrid.ask(corpus, asked, embedder=broken).filter("question_id = 1").first()
    assert row["dense_count"] == 0 and row["sparse_count"] > 0 and "no model" in row["dense_error"]


def test_eav_pivot(spark):
    entities = spark.createDataFrame([(1, "e1"), (2, "e2"), (3, "e3")], "id long, embedding_id string")
    broken = "한국".encode().decode("latin1")
    rows = [(1, eav.TEXT_KEY, "글", None, None, None), (1, "issuer", broken, None, None, None), (1, "n", None, 3, None, None), (1, "b", None, None, None, True),
            (2, "content", "내용", None, None, None), (2, "chunk_id", "k", None, None, None), (2, "issuer", " 나 ", None, None, None), (2, None, "x", None, None, None)]
    metadata = spark.createDataFrame(rows, "id long, key string, string_value string, int_value long, float_value double, bool_value boolean")
    got = {r["ord"]: r for r in eav.records(entities, metadata).collect()}
    assert set(got) == {1, 2}
    assert (got[1]["chunk_id"], got[1]["text"], got[1]["issuer"], got[1]["metadata"]["n"], got[1]["metadata"]["b"]) == ("e1", "글", "한국", "3", "true")
    assert (got[2]["chunk_id"], got[2]["text"], got[2]["issuer"]) == ("k", "내용", " 나 ")
    assert [r[0] for r in eav.issuers(metadata).collect()] == ["나", "한국"]


def test_answer_stream(spark, corpus, tmp_path):
    from findery.streaming.questions import answer_stream

    asked = make_questions(spark, [(1, "서버 예산", ["가"], 3, [1.0, 0.0]), (2, " ", ["가"], 3, None), (3, "서버", None, 3, None)])
    asked.write.parquet(str(tmp_path / "in"))
    seen = []
    stream = spark.readStream.schema(asked.schema).parquet(str(tmp_path / "in"))
    answer_stream(stream, corpus, lambda df, n: seen.extend((r["question_id"], r["status"], r["refusal"]) for r in df.collect()), str(tmp_path / "check")).awaitTermination()
    assert sorted(seen) == [(1, "answered", None), (2, "refused", "a question is required"), (3, "refused", "an issuer is required")]


def test_a_stream_reads_the_newest_index_and_asks_nothing_twice(spark, corpus, tmp_path):
    from findery.operators import clients, postings
    from findery.streaming.questions import answer_stream

    path, calls = str(tmp_path / "index"), str(tmp_path / "calls")
    index = postings.build(corpus.filter("ord < 2"), path)
    rows = make_questions(spark, [(1, "보안", ["가"], 3, None)])

    def speaks():
        def speak(system, prompt, tokens):
            with open(calls, "a") as f:
                f.write("x")
            return "말"

        return speak

    counts, client = [], clients.Generator(speaks, "m")
    for n in range(2):
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))

        def sink(df, batch):
            counts.append([(r["sparse_count"], r["answer"]) for r in df.collect()])
            df.collect()  # as a sink that tries again

        answer_stream(stream, corpus, sink, str(tmp_path / "check"), client, path).awaitTermination()
        if not n:
            index = postings.update(index, corpus.filter("ord >= 2").select("ord", "chunk_id", "issuer", "text", F.lit(False).alias("gone")))
    assert [c[0][0] for c in counts] == [0, 2]
    assert counts[1][0][1] == "말" and len(open(calls).read()) == 1


def test_settings_and_checks(spark, corpus):
    from findery.settings import Settings

    assert Settings.of(spark) == Settings(50, 50, 5, 320)
    spark.conf.set("spark.findery.sparse_k", "1")
    try:
        asked = make_questions(spark, [(1, "서버", ["가"], 0, None)])
        row = hybrid.ask(corpus, asked, settings=Settings.of(spark)).first()
    finally:
        spark.conf.unset("spark.findery.sparse_k")
    assert (row["sparse_count"], row["dense_count"]) == (1, 0)
    assert spark.range(1).select(answers.display(F.lit("x" * 1300))).first()[0] == "x" * 1200


def test_ask_refuses_by_row(spark, corpus):
    """Bad rows among good ones: each is told, and the good ones are answered as they are alone."""
    good = [(1, "서버 구축", ["가"], 5, [1.0, 0.0]), (4, "보안", [" 나 "], 5, None)]
    bad = [(2, None, ["가"], 5, None), (3, " \u3000", ["가"], 5, None), (5, "서버", [" "], 5, None), (6, "서버", None, 5, None), (7, "", [], 5, None), (8, "서버", [None, ""], 5, [1.0, 0.0])]
    alone = {r["question_id"]: r for r in hybrid.ask(corpus, make_questions(spark, good)).collect()}
    rows = {r["question_id"]: r for r in hybrid.ask(corpus, make_questions(spark, good + bad)).collect()}
    assert {k: rows[k] for k in alone} == alone and all(r["status"] == "answered" for r in alone.values())
    told = {2: "a question is required", 3: "a question is required", 5: "an issuer is required", 6: "an issuer is required", 7: "a question is required", 8: "an issuer is required"}
    assert {k: rows[k]["refusal"] for k in rows if rows[k]["status"] == "refused"} == told
    assert rows[5]["answer"] == told[5] and rows[5]["route"] == ["refused"] and rows[5]["issuers"] == [] and rows[5]["sparse_count"] == rows[5]["lookup_count"] == 0
    assert [r["status"] for r in hybrid.ask(corpus, make_questions(spark, bad[:1])).collect()] == ["refused"]
    found = hybrid.retrieve(corpus, make_questions(spark, good + bad))
    assert {r[0] for r in found.merged.select("question_id").distinct().collect()} == {1} and found.questions.count() == 2
    with pytest.raises(Exception, match="issuer is required"):
        hybrid.prepare(make_questions(spark, bad[2:3])).collect()


def test_lists_are_counted_in_one_grouping(spark, corpus):
    found = hybrid.retrieve(corpus, make_questions(spark, [(1, "서버 구축", ["가", "나"], 5, [1.0, 0.0]), (2, "보안", ["나"], 5, None), (3, "없는말", ["가"], 5, None)]))
    hybrid.select(corpus, found)
    got = {r["question_id"]: tuple(r)[1:] for r in hybrid.counts(found).collect()}
    want = {q: tuple(getattr(found, name).filter(f"question_id = {q}").count() for name in hybrid.COUNTED) for q in (1, 2, 3)}
    assert got == {q: n for q, n in want.items() if any(n)}
    plan = hybrid.counts(found)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_a_failing_dense_search_finds_nothing(spark, corpus):
    broken = corpus.withColumn("embedding", F.when(F.col("ord") >= 0, F.raise_error(F.lit("no vectors"))).cast("array<float>"))
    asked = make_questions(spark, [(1, "서버 구축", ["가"], 5, [1.0, 0.0])])
    with pytest.warns(UserWarning, match="no vectors"):
        found = hybrid.retrieve(broken, asked)
    assert found.dense.count() == 0 and found.merged.count() == found.sparse.count() > 0 and "no vectors" in found.dense_error
    with pytest.warns(UserWarning, match="no vectors"):
        assert "no vectors" in hybrid.ask(broken, asked).first()["dense_error"]


def test_texts_of_other_chunks_do_not_move(spark, corpus, tmp_path, monkeypatch):
    corpus.write.parquet(str(tmp_path / "chunks"))
    chunks = spark.read.parquet(str(tmp_path / "chunks"))
    rows = spark.createDataFrame([(1, 3), (1, 5)], "question_id long, ord long")
    plan = lambda: hybrid.only(chunks.select("ord", "text"), rows)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan() and "SortMergeJoin" not in plan()
    assert sorted(r["ord"] for r in hybrid.only(chunks, rows).collect()) == [3, 5]
    assert sorted(r["ord"] for r in hybrid.only(chunks, rows, most=1).collect()) == [3, 5]


def test_records_take_one_exchange(spark, tmp_path):
    entities = spark.range(100).select("id", F.concat(F.lit("e"), "id").alias("embedding_id"))
    metadata = entities.select("id", F.explode(F.array(*map(F.lit, ("issuer", "content", "issuer")))).alias("key"), F.concat(F.lit("v"), F.col("id")).alias("string_value"), *(F.lit(None).cast(t).alias(n) for n, t in (("int_value", "long"), ("float_value", "double"), ("bool_value", "boolean"))))
    entities.write.parquet(str(tmp_path / "entities.parquet"))
    metadata.write.parquet(str(tmp_path / "entity_metadata.parquet"))
    rows = eav.records(*eav.read_tables(spark, str(tmp_path)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(id") == 2 == plan.count("Exchange")  # the metadata, and the entities beside it
    assert rows.count() == 100 and {(r["chunk_id"], r["issuer"], r["text"]) for r in rows.collect()} == {(f"e{i}", f"v{i}", f"v{i}") for i in range(100)}


def test_records_of_hard_rows(spark):
    shape = "id long, key string, string_value string, int_value long, float_value double, bool_value boolean, extra int"
    rows = [(1, "k", "a", None, None, None, 0), (1, "k", "b", None, None, None, 0), (1, "n", None, None, None, None, 0), (9, "k", "x", None, None, None, 0), (2, None, "x", None, None, None, 0), (None, "k", "x", None, None, None, 0)]
    entities = spark.createDataFrame([(1, "e1", 5), (1, "e1", 5), (2, "e2", 5), (None, "e", 5)], "id long, embedding_id string, ord int")
    got = eav.records(entities, spark.createDataFrame(rows, shape)).collect()
    assert [(r["ord"], r["chunk_id"], r["text"], r["metadata"]) for r in got] == [(1, "e1", "", {"k": "b"})] * 2
    assert eav.records(entities.limit(0), spark.createDataFrame([], shape)).count() == 0


def test_tables_of_a_database(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    entities = spark.createDataFrame([(10_000_000_000 + i, f"e{i}") for i in range(40)], "id long, embedding_id string")
    metadata = entities.selectExpr("id", "'issuer' AS meta_key", "embedding_id AS string_value")
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    entities.write.jdbc(url, "embeddings", properties=driver)
    metadata.write.jdbc(url, "embedding_metadata", properties=driver)
    a, b = eav.read_jdbc(spark, url, parts=4, **driver)
    assert a.count() == b.count() == 40 and a.rdd.getNumPartitions() == 4
    per = a.groupBy(F.spark_partition_id()).count().collect()
    assert len(per) == 4 and max(r["count"] for r in per) <= 12
    entities.limit(0).write.jdbc(url, "no_rows", properties=driver)
    assert eav.read_jdbc(spark, url, "no_rows", "no_rows", **driver)[0].count() == 0


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from findery import scratch

    unset = SimpleNamespace(get=lambda *a: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            scratch.shared_dir(SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master=master)))


def test_issuers_and_columns_reach_the_scan(spark, corpus, tmp_path):
    from findery.operators import filters

    corpus.write.parquet(str(tmp_path / "chunks"))
    chunks = spark.read.parquet(str(tmp_path / "chunks"))
    plan = filters.records_for_issuers(chunks, ["가", " 나"]).select("ord", "text")._jdf.queryExecution().executedPlan().toString()
    assert "In(issuer, [가,나])" in plan and "embedding" not in plan and "metadata" not in plan


def test_a_padded_flag_selects_but_still_looks_up(spark):
    meta = {"issuer": "가", "fact_type": "project_budget", "doc_id": "d", "budget_answer_enabled": " true "}
    chunks = make_chunks(spark, [(1, "예산 공고번호: 1234567890", meta, [1.0, 0.0])])
    row = hybrid.ask(chunks, make_questions(spark, [(1, "예산", ["가"], 5, [1.0, 0.0])])).first()
    assert row["route"] == ["issuer_filter", "hybrid_dense_sparse", "ngram_backfill", "metadata_rerank", "budget_strict_selection", "g2b_manual_lookup", "llm_fallback"]


def test_notices_of_all_records_where_the_results_have_none(spark):
    meta = lambda issuer, f: {"issuer": issuer, "fact_type": "table", "doc_id": "d", "source_file": f, "project_name": "p"}
    rows = [(3, "예산", meta("가", "three"), None), (5, "zz 공고번호: 2222222222", meta("나", "five"), None), (2, "zz", meta("나", "two"), None)]
    rows += [(n, f"zz 공고번호: {n}00000000", meta("가", "more"), None) for n in (21, 22, 23)] + [(1, "zz 공고번호: 3333333333", meta("다", "one"), None)]
    chunks = make_chunks(spark, rows)
    found = hybrid.retrieve(chunks, make_questions(spark, [(1, "예산", ["가", "나"], 5, None), (2, "예산", ["라"], 5, None), (3, "예산", ["다"], 5, None)]))
    got = hybrid.lookups(chunks, found, *hybrid.select(chunks, found)).orderBy("question_id", "n").collect()
    want = [(1, 1, "2222222222", "two"), (1, 2, "2100000000", "two"), (1, 3, "2200000000", "two"), (3, 1, "3333333333", "one")]
    assert [(r["question_id"], r["n"], r["notice_number"], r["source_file"]) for r in got] == want


def test_fusion_of_hard_rows(spark):
    shape = "question_id long, ord long, chunk_id string, rank int, retriever string, extra int"
    rows = spark.createDataFrame([(None, 1, "x", 1, "dense", 0), (None, 2, None, 2, "dense", 0), (1, 1, "x", 1, "dense", 0), (1, 1, "x", 3, "dense", 0)], shape)
    got = {r["question_id"]: (r["chunk_id"], r["rrf_score"]) for r in fusion.rrf([rows, rows.limit(0)]).collect()}
    assert got == {None: ("x", 1 / 61), 1: ("x", 1 / 61 + 1 / 63)}
    assert fusion.rrf([rows.limit(0)]).count() == 0
    facts = spark.createDataFrame([(1, "x", None, None, None)], "ord long, chunk_id string, issuer string, doc string, fact_type string")
    assert fusion.seeds(fusion.rrf([rows]), facts).count() == 0
    asked = spark.createDataFrame([(1, "unheard of", ["가"])], "question_id long, qtype string, issuers array<string>")
    assert fusion.backfill(fusion.rrf([rows]), asked, facts.withColumn("doc", F.lit("d"))).count() == 0


def test_answers_of_hard_rows(spark):
    rows = spark.createDataFrame([(1, 1, None, None), (1, 2, "t", {"source_file": ""})], "question_id long, context_rank int, text string, metadata map<string,string>")
    blocks = answers.contexts(rows).first()["context"].split("\n\n[")
    assert blocks[0] == answers.CONTEXT % (1, "", "", "", "", "", "") and blocks[1].endswith("\nt")
    asked = spark.createDataFrame([(1, None), (2, "purpose")], "question_id long, qtype string")
    said = {r["question_id"]: r["answer"] for r in answers.fallback(asked, rows).collect()}
    assert said[1] == f"{answers.LEAD}\n- t\n\n{answers.SOURCES}{answers.ANY_SOURCE}" and said[2] == answers.NO_CONTEXT
    texts = spark.createDataFrame([(None, None, None), ("", "", {"a": None, "b": ""}), ("c", "공고번호: 1234567890", {"a": "2024123456"})], "chunk_id string, text string, metadata map<string,string>")
    got = texts.select(answers.candidate_text(F.col("chunk_id"), F.col("text"), F.col("metadata")).alias("t")).select("t", answers.notice_numbers(F.col("t")).alias("n")).collect()
    assert [(r["t"], r["n"]) for r in got] == [("", []), ("", []), ("c\n공고번호: 1234567890\n2024123456", ["2024123456", "1234567890"])]
    assert answers.contexts(rows.limit(0)).count() == answers.fallback(asked.limit(0), rows).count() == 0
