import random
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from findery.functions import text as T
from findery.operators import filters
from findery.operators.fusion import context_limit
from findery.plans import registry

SAMPLES = [None, "", "  ", "한국 Data-센터 2024!", unicodedata.normalize("NFD", "한국어 텍스트"), "漢字 한글", "ＡＢＣ 전각", "a b", "É è ß", "a\nb\tc"]


def column(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


def test_nfc(spark):
    assert column(spark, SAMPLES, T.nfc) == [unicodedata.normalize("NFC", v or "") for v in SAMPLES]


def test_settled_characters_are_ones_that_nfc_leaves_alone():
    """By the rules of normalisation: not decomposed, of class zero, second in no composition."""
    joins = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for c in (chr(n) for n in range(0x110000) if not 0xD800 <= n < 0xE000):
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            a, b = (chr(int(x, 16)) for x in parts)
            if unicodedata.normalize("NFC", a + b) == c:
                joins.add(b)
    for low, high in T.SETTLED:
        for c in map(chr, range(low, high + 1)):
            assert unicodedata.is_normalized("NFC", c) and not unicodedata.combining(c) and c not in joins, hex(ord(c))


def test_only_doubtful_text_goes_to_python(spark, monkeypatch):
    marked = F.pandas_udf(lambda v: v.map(lambda x: "" if x is None else unicodedata.normalize("NFC", x) + "!"), "string")
    monkeypatch.setattr(T, "_nfc", marked)
    settled = ["서울특별시 정보화 사업 (2024년) ①호", "日本語、カナ・かな", "Ünïcode – “quotes” → 5 ㎡", "", None, "abc\n\t"]
    doubtful = [unicodedata.normalize("NFD", "서울"), "e\u0301", "\u212b", "か\u3099", "a\u0323\u0307", "ελλάδα", "가\u11a8"]
    assert column(spark, settled, T.nfc) == [unicodedata.normalize("NFC", v or "") for v in settled]
    assert column(spark, doubtful, T.nfc) == [unicodedata.normalize("NFC", v) + "!" for v in doubtful]


def test_norm_text_on_both_sides(spark):
    got = column(spark, SAMPLES, T.norm_text)
    assert got == [T.norm_python(v) for v in SAMPLES]
    assert got[:5] == ["", "", "", "한국 data 센터 2024", "한국어 텍스트"]


@pytest.mark.parametrize(
    ("text", "want"),
    [("", []), (None, []), ("a", []), ("ab", ["ab", "ab"]), ("abc", ["abc", "ab", "bc", "abc"]), ("a b", ["ab"]), ("ab ab", ["ab", "ab", "ab", "ba", "ab", "aba", "bab"])],
)
def test_tokens(text, want):
    assert sorted(T.tokens_python(text)) == sorted(want)


def test_number_of_grams():
    for n in range(6):
        assert len(T.tokens_python(" ".join("x" * n))) == max(0, n - 1) + max(0, n - 2)


def test_token_numbers_are_those_of_the_tokens():
    rng = random.Random(4)
    texts = [*SAMPLES, "a", "ab", "abc abc", "abc abcd ab abcd", *(" ".join("".join(rng.choice("ab가나1") for _ in range(rng.randrange(6))) for _ in range(rng.randrange(40))) for _ in range(300))]
    for text in texts:
        own = T.tokens_python(text)
        assert T.token_numbers(text) == (len(own), len(set(own))), repr(text)


def test_a_batch_of_texts_is_counted_in_little_memory():
    """Beside its own texts, those of one text at a time."""
    rng = random.Random(5)
    text = ["".join(rng.choice("abcdefgh 가나다라") for _ in range(2000)) for _ in range(500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(500)), "text": text})
    tracemalloc.start()
    (out,) = registry._numbers([batch])
    assert tracemalloc.get_traced_memory()[1] < 10 << 20 and out["n_tokens"].to_pylist() == [len(T.tokens_python(t)) for t in text]
    tracemalloc.stop()
    assert [b.num_rows for b in registry._numbers([batch.slice(0, 0)])] == [0]


def test_mojibake(spark):
    broken = "한국전력".encode().decode("latin1")
    values = [broken, "한국전력", "café Ã", "plain", "", None, "é"]
    assert column(spark, values, T.repair_mojibake) == ["한국전력", *values[1:]]
    assert column(spark, ["한국전력", "abc"], T.mojibake_alias) == [broken, "abc"]


@pytest.mark.parametrize(
    ("question", "want"),
    [("예산은 얼마", "budget"), ("예산과 목적", "comparison"), ("제안서 목록", "submission_documents"), ("면허 필요", "eligibility"), ("제출기한", "deadline"),
     ("계약기간", "duration"), ("사업 배경", "purpose"), ("둘 중 무엇", "comparison"), ("누구", "general"), ("", "general"), (None, "general"),
     (unicodedata.normalize("NFD", "예산"), "budget")],
)
def test_question_type(spark, question, want):
    assert column(spark, [question], T.question_type) == [want]


def test_to_bool(spark):
    values = ["true", " YES ", "1", "y", "1.0", "no", "", None, " True"]
    assert column(spark, values, T.to_bool) == [True, True, True, True, False, False, False, False, True]


def test_clean_issuers(spark):
    rows = spark.createDataFrame([([" a ", "b", "a", "", "　"],)], "x array<string>")
    assert rows.select(filters.clean(F.col("x"))).first()[0] == ["a", "b"]
    for bad in ([], [" "], None):
        with pytest.raises(Exception, match="issuer"):
            spark.createDataFrame([(bad,)], "x array<string>").select(filters.clean(F.col("x"))).collect()


def test_padded_issuers_are_listed_but_not_matched(spark):
    rows = spark.createDataFrame([("a",), (" a",), (None,)], "issuer string")
    assert [r[0] for r in rows.select(filters.sparse_allowed(F.col("issuer"), F.array(F.lit(" a ")))).collect()] == [True, False, False]
    assert [r[0] for r in rows.select(filters.dense_allowed(F.col("issuer"), F.array().cast("array<string>"))).collect()] == [True, True, True]


def test_aliases(spark):
    rows = spark.createDataFrame([(["한국 ", "x"],)], "x array<string>")
    assert rows.select(filters.aliases(F.col("x"))).first()[0] == ["한국", "한국".encode().decode("latin1"), "x"]


def test_context_limit(spark):
    rows = spark.createDataFrame([(None,), (0,), (-3,), (1,), (8,), (9,)], "x int")
    assert [r[0] for r in rows.select(context_limit(F.col("x"))).collect()] == [5, 5, 1, 1, 8, 8]
