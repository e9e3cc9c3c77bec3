"""Notice numbers, contexts, prompts and answers.

Defined results: null and empty texts, ids and metadata values hold no notice number and are empty in a
context; null metadata has no keys; numbers that repeat count once, at their first place; a question
without selected rows has no context and an answer that says so; one without notices keeps its answer;
a null prompt is passed on as it is; empty tables give no rows (``fallback`` gives one for each question).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from findery.functions.text import or_else
from findery.operators.ledger import Ledger, key_of

# How notice numbers look, where they are looked up, and the texts that answers are made of.
NOTICE_BARE = r"(?U)\b20\d{8,12}(?:-\d{2})?\b"
NOTICE_LABELLED = r"(?U)(?:G2B\s*)?(?:공고번호|입찰공고번호|공고\s*번호)\s*[:：]?\s*([0-9]{10,14}(?:-\d{2})?)"
LOOKUP_URL = "https://www.g2b.go.kr/index.jsp"
LOOKUP_TEXT = "문서에서 G2B 공고번호 %s를 확인했습니다. 나라장터에서 해당 공고번호로 직접 조회해 예산/배정금액 첨부 공고를 확인하세요."
LOOKUP_HEAD = "문서에서 확인된 나라장터 공고번호로 추가 확인할 수 있습니다."
CONTEXT = "[근거 %d]\n문서: %s\n발주기관: %s\n사업명: %s\n섹션: %s\n유형: %s\n\n본문:\n%s"
PROMPT = "질문:\n%s\n\n근거:\n%s"
SYSTEM = (
    "당신은 RFP 문서 질의응답 도우미입니다.\n"
    "반드시 제공된 근거 안에서만 답하세요.\n"
    "fact_type, answer_policy, budget_answer_enabled 같은 내부 메타데이터명은 답변에 노출하지 마세요.\n"
    "예산 질문은 안전한 사업예산 근거가 있을 때만 금액을 말하고, 없으면 확인 불가라고 답하세요.\n"
    "답변은 간결하게 작성하고 마지막에 출처를 포함하세요."
)
NO_CONTEXT = "현재 선택한 발주기관 문서군에서 답변에 필요한 근거를 찾지 못했습니다."
NO_BUDGET = "현재 문서 근거만으로는 안전하게 확정 가능한 사업예산 금액을 찾지 못했습니다."
LEAD_PURPOSE = "검색된 문서 근거 기준으로는 다음 내용이 질문과 가장 관련됩니다."
LEAD = "LLM 답변 생성에는 실패했지만, 검색된 근거에서 확인되는 핵심 내용은 다음과 같습니다."
EMPTY_BODY = "- 관련 본문을 찾았지만 요약 가능한 텍스트가 비어 있습니다."
SOURCES, ANY_SOURCE = "출처: ", "검색 문서"
NOTICES_PER_ANSWER, CONTEXT_CHARS, SNIPPET_CHARS, FALLBACK_ROWS, DISPLAY_CHARS, ANSWER_TOKENS = 3, 1800, 260, 3, 1200, 320


def candidate_text(chunk_id: Column, text: Column, metadata: Column) -> Column:
    """Everything in a record that may hold a notice number, a line each."""
    values = F.filter(F.map_values(metadata), lambda v: v.isNotNull() & (v != ""))
    return F.concat_ws("\n", F.nullif(chunk_id, F.lit("")), F.nullif(text, F.lit("")), F.nullif(F.array_join(values, "\n"), F.lit("")))


def notice_numbers(candidate: Column) -> Column:
    """All numbers in a record's text: those of the first pattern in order, then the second's."""
    return F.concat(F.regexp_extract_all(candidate, F.lit(NOTICE_BARE), F.lit(0)), F.regexp_extract_all(candidate, F.lit(NOTICE_LABELLED), F.lit(1)))


def first_notices(found: DataFrame, key: str = "question_id", limit: int = NOTICES_PER_ANSWER) -> DataFrame:
    """``key, notice_number, n, first`` of a key's first distinct numbers. ``found``: key, ``notice_number``, ``first`` (where it comes)."""
    own = found.groupBy(key, "notice_number").agg(F.min("first").alias("first"))
    return own.withColumn("n", F.row_number().over(W.partitionBy(key).orderBy("first"))).filter(F.col("n") <= limit)


def notices(rows: DataFrame, order: str, key: str = "question_id", limit: int = NOTICES_PER_ANSWER) -> DataFrame:
    """The same from ``key``, order and ``numbers`` of rows: by row, pattern, place."""
    flat = rows.select(key, F.col(order).cast("long").alias("o"), F.posexplode("numbers").alias("place", "notice_number")).filter("notice_number <> ''")
    return first_notices(flat.select(key, "notice_number", F.struct("o", "place").alias("first")), key, limit)


def lookup_contexts(found: DataFrame, first_rows: DataFrame) -> DataFrame:
    """A lookup hint per notice, with the issuer, project and file of the question's first row (``first_rows``: a row per question)."""
    out = found.join(first_rows.select("question_id", *(F.coalesce(c, F.lit("")).alias(c) for c in ("issuer", "project_name", "source_file"))), "question_id")
    return out.withColumn("g2b_url", F.lit(LOOKUP_URL)).withColumn("text", F.format_string(LOOKUP_TEXT, "notice_number"))


def _section(metadata: Column) -> Column:
    return F.when(F.map_contains_key(metadata, "section_path"), F.coalesce(metadata["section_path"], F.lit("None"))).otherwise(F.coalesce(metadata["section_type"], F.lit("")))


def context_block(rank: Column, text: Column, metadata: Column, chars: int = CONTEXT_CHARS) -> Column:
    named = lambda k: F.coalesce(metadata[k], F.lit(""))
    return F.format_string(CONTEXT, rank, named("source_file"), named("issuer"), named("project_name"), _section(metadata), named("fact_type"), F.substring(F.coalesce(text, F.lit("")), 1, chars))


def _in_order(order: str, value: Column) -> Column:
    return F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v")))), lambda x: x["v"])


def display(text: Column) -> Column:
    """As much of a context as is shown."""
    return F.substring(text, 1, DISPLAY_CHARS)


def contexts(selected: DataFrame) -> DataFrame:
    """``question_id, context``: the blocks of the selected rows (at most eight a question), in order."""
    block = context_block(F.col("context_rank"), F.col("text"), F.col("metadata"))
    return selected.groupBy("question_id").agg(F.array_join(_in_order("context_rank", block), "\n\n").alias("context"))


def fallback(questions: DataFrame, selected: DataFrame) -> DataFrame:
    """``question_id, answer``: what is said without a generator."""
    top = selected.filter(F.col("context_rank") <= FALLBACK_ROWS)
    short = F.substring(F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s+", " "), r"^ | $", ""), 1, SNIPPET_CHARS)
    source = F.coalesce(or_else(F.col("metadata")["source_file"]), F.lit(ANY_SOURCE))
    rows = top.groupBy("question_id").agg(_in_order("context_rank", short).alias("snippets"), F.array_distinct(_in_order("context_rank", source)).alias("sources"))
    rows = questions.select("question_id", "qtype").join(rows, "question_id", "left")
    lines = F.transform(F.filter("snippets", lambda s: s != ""), lambda s: F.concat(F.lit("- "), s))
    body = F.coalesce(or_else(F.array_join(lines, "\n")), F.lit(EMPTY_BODY))
    lead = F.when(F.col("qtype") == "purpose", LEAD_PURPOSE).otherwise(LEAD)
    said = F.concat(lead, F.lit("\n"), body, F.lit(f"\n\n{SOURCES}"), F.array_join("sources", ", "))
    budget = F.concat(F.lit(f"{NO_BUDGET}\n\n{SOURCES}"), F.get("sources", F.lit(0)))
    return rows.select("question_id", F.when(F.col("sources").isNull(), NO_CONTEXT).when(F.col("qtype") == "budget", budget).otherwise(said).alias("answer"))


def with_lookup(answer: Column, numbers: Column) -> Column:
    """The answer, followed by the notice numbers to look up, if any."""
    lines = F.transform(numbers, lambda n: F.concat(F.lit("- 공고번호: "), n))
    more = F.concat_ws("\n", F.regexp_replace(answer, r"(?U)\s+$", ""), F.lit(""), F.lit(LOOKUP_HEAD), F.array_join(lines, "\n"), F.lit(f"- 확인 경로: {LOOKUP_URL}"))
    return F.when(F.coalesce(F.size(numbers), F.lit(0)) > 0, more).otherwise(answer)


def _speaking(client: Callable, tokens: int, folder: str | None):
    name, parallel = getattr(client, "name", ""), max(1, getattr(client, "parallel", 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        speak, book = client(), Ledger(folder) if folder else None

        def said(prompt: str | None) -> tuple[str | None, str | None]:
            try:
                key = key_of(name, SYSTEM, prompt, tokens)
                text = book.get(key) if book else None
                if text is None:
                    text = speak(SYSTEM, prompt, tokens)
                    if book and text is not None:
                        book.put(key, text)
                return text, None
            except Exception as e:  # noqa: BLE001
                return None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(parallel) as pool:
            for b in batches:
                # A prompt that a batch has twice is asked once.
                asked = list(dict.fromkeys(b["prompt"]))
                told = dict(zip(asked, pool.map(said, asked) if parallel > 1 else map(said, asked), strict=True))
                texts, errors = zip(*(told[p] for p in b["prompt"]), strict=True) if len(b) else ((), ())
                yield pd.DataFrame({"question_id": b["question_id"], "generated": list(texts), "error": list(errors)})

    return run


def generate(prompts: DataFrame, client: Callable[[], Callable[[str, str, int], str]], tokens: int = ANSWER_TOKENS, ledger: str | None = None) -> DataFrame:
    """``question_id, prompt`` -> ``question_id, generated, error``.

    ``client()`` makes, once per task, a function (system, prompt, tokens) -> text; what it raises is
    told in ``error``. Of a ``clients.Generator`` up to ``parallel`` requests of a task are on their way
    at once. ``ledger``: a folder that keeps what was said; rows of one prompt then meet in one task,
    and neither they nor a task or batch that is run again ask twice.
    """
    kind = dict(prompts.dtypes)["question_id"]
    rows = prompts.select("question_id", "prompt")
    return (rows.repartition("prompt") if ledger else rows).mapInPandas(_speaking(client, tokens, ledger), f"question_id {kind}, generated string, error string")


def embed(questions: DataFrame, model: Callable[[], Callable[[list[str]], list[list[float]]]]) -> DataFrame:
    """Adds ``vector``, a row for each row. ``model()`` is loaded once per task; null questions are embedded as empty."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = model()
        for b in batches:
            yield pd.Series([list(map(float, v)) for v in encode(["" if x is None else x for x in b])], dtype=object)

    return questions.withColumn("vector", F.pandas_udf(run, "array<double>")("question"))
