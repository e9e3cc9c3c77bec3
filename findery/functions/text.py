"""Text expressions: normalisation, broken encodings, truth words, the type of a question."""

from __future__ import annotations

import hashlib
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Characters that normalised text keeps, marks of UTF-8 read as Latin-1, words for true.
KEPT = "가-힣a-zA-Z0-9"
BROKEN = "ìíêëÂÃ"
TRUE = ("true", "1", "yes", "y")

# The words that tell a question's type, in the order in which they are looked for.
BUDGET_WORDS = ("예산", "사업비", "금액", "추정가격", "기초금액", "얼마")
PURPOSE_WORDS = ("목적", "배경", "효과", "필요성", "개선")
TYPE_WORDS = (
    ("submission_documents", ("제출서류", "제안서", "구비서류")),
    ("eligibility", ("참가자격", "입찰자격", "자격요건", "면허", "실적")),
    ("deadline", ("마감", "기한", "입찰마감", "제출기한")),
    ("duration", ("사업기간", "수행기간", "계약기간", "유지보수")),
)
COMPARISON_WORDS = ("비교", "차이", "공통점", "둘 중")


@F.pandas_udf(StringType())
def _nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: "" if v is None else unicodedata.normalize("NFC", v))


#: Ranges of characters that NFC leaves as they are wherever they stand: none is decomposed, none joins
#: what is before it, none is moved. Hangul syllables are among them, jamo that could form one aren't.
SETTLED = (
    (0x0000, 0x02FF), (0x0400, 0x0482), (0x048A, 0x052F), (0x2010, 0x205E), (0x20A0, 0x20C0), (0x2190, 0x2328), (0x232B, 0x2426), (0x2460, 0x2ADB), (0x3000, 0x3029),
    (0x3041, 0x3096), (0x30A1, 0x30FF), (0x3131, 0x318E), (0x3200, 0x33FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xFF01, 0xFFEE), (0x1F300, 0x1FAFF),
)
_SETTLED = "^[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in SETTLED) + "]*$"


def nfc(value: Column) -> Column:
    """Unicode NFC, null as empty. Only text with a character outside of ``SETTLED`` is sent to Python."""
    plain = F.coalesce(value.cast("string"), F.lit(""))
    settled = plain.rlike(_SETTLED)
    return F.when(settled, plain).otherwise(_nfc(F.when(~settled, plain)))


def norm_text(value: Column) -> Column:
    """NFC, everything but Hangul syllables, ASCII letters and digits to single spaces, lower case."""
    return F.lower(F.trim(F.regexp_replace(nfc(value), f"[^{KEPT}]+", " ")))


def norm_python(value: str | None) -> str:
    """The same in Python, for code that is on a worker already."""
    return re.sub(f"[^{KEPT}]+", " ", unicodedata.normalize("NFC", value or "")).strip(" ").lower()


def tokens_python(value: str | None) -> list[str]:
    """Words of two letters or more, then all pairs and triples of neighbours in the text without spaces."""
    base = norm_python(value)
    joined = base.replace(" ", "")
    out = [w for w in base.split(" ") if len(w) > 1]
    for width in (2, 3):
        out += map("".join, zip(*(joined[k:] for k in range(width)), strict=False))
    return out


def _grams(joined: str) -> tuple[np.ndarray, np.ndarray]:
    """All pairs and triples of neighbours, letters side by side in 64-bit numbers."""
    c = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64)
    two = c[:-1] << np.uint64(21) | c[1:]
    return two, two[:-1] << np.uint64(21) | c[2:] if len(c) > 2 else two[:0]


def token_numbers(value: str | None) -> tuple[int, int]:
    """How many ``tokens_python`` there are, and how many different ones, without making them: a word of two or three letters is a pair or triple as well."""
    base = norm_python(value)
    two, three = _grams(base.replace(" ", ""))
    words = [w for w in base.split(" ") if len(w) > 1]
    return len(words) + len(two) + len(three), len(np.unique(two)) + len(np.unique(three)) + len({w for w in words if len(w) > 3})


#: Hashes of words that came lately, kept by a worker: so many, of so many letters, some 15 MB at most whatever the texts are.
KEPT_WORDS, KEPT_LETTERS = 1 << 16, 32
_WORDS: dict[str, int] = {}


def token_codes(value: str | None) -> np.ndarray:
    """``tokens_python`` as 64-bit numbers, in no order: equal tokens have equal codes.

    Two or three letters are written side by side, exactly; a longer word is a hash with the highest
    bit set, so that only two long words could ever be taken for each other (one in 2**63 a pair).
    """
    base = norm_python(value)
    two, three = _grams(base.replace(" ", ""))
    words = []
    for w in base.split(" "):
        if len(w) > 1:
            code = _WORDS.get(w)
            if code is None:
                code = 0
                for x in w if len(w) < 4 else "":
                    code = code << 21 | ord(x)
                code = code or int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") | 1 << 63
                if len(w) <= KEPT_LETTERS:
                    if len(_WORDS) >= KEPT_WORDS:
                        _WORDS.clear()
                    _WORDS[w] = code
            words.append(code)
    return np.concatenate([two, three, np.array(words, np.uint64)])


def strip(value: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def repair_mojibake(value: Column) -> Column:
    """Hangul whose UTF-8 bytes were read as Latin-1, repaired; anything else as it is."""
    narrow = ~value.rlike(r"[^\x00-\xFF]")
    read = F.when(narrow, F.try_validate_utf8(F.encode(F.when(narrow, value), "ISO-8859-1").cast("string")))
    return F.when(F.coalesce(read.rlike("[가-힣]") & value.rlike(f"[{BROKEN}]"), F.lit(False)), read).otherwise(value)


def mojibake_alias(value: Column) -> Column:
    """What the text looks like when its UTF-8 bytes are read as Latin-1."""
    return F.decode(F.encode(value, "UTF-8"), "ISO-8859-1")


def to_bool(value: Column) -> Column:
    return F.coalesce(F.lower(strip(value.cast("string"))).isin(*TRUE), F.lit(False))


def _any(text: Column, words) -> Column:
    return text.rlike("|".join(words))


def question_type(question: Column) -> Column:
    q = nfc(question)
    budget, purpose = _any(q, BUDGET_WORDS), _any(q, PURPOSE_WORDS)
    out = F.when(budget & purpose, "comparison").when(budget, "budget")
    for name, words in TYPE_WORDS:
        out = out.when(_any(q, words), name)
    return out.when(purpose, "purpose").when(_any(q, COMPARISON_WORDS), "comparison").otherwise("general")


def or_else(*values: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values))
