"""Text functions: the normaliser and the tokeniser.

Everything is a Column expression. The one thing Spark has no built-in for, Unicode NFKC, is an
Arrow-batched UDF that only receives the rows whose characters NFKC can change.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicwake.functions.stopwords import STOP_WORDS

# Character classes with the meaning of a Unicode-aware regex engine, spelled out so that they do
# not depend on flags or on the JDK: its own white space leaves out U+001C to U+001F.
_SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
_INK = f"[^{_SPACE}]"
_WORD = r"\p{L}\p{N}_"
_DIGIT = r"\p{Nd}"
_EDGE = f"(?:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))"

# Month names as the date rule knows them.
_MONTHS = (
    "january|february|march|april|may|june|july|august|september|october|november|december|"
    "jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec"
)

# The rules are written so that a long run of characters costs linear time: the e-mail rule is
# anchored at the start of a word with a possessive run, and the markup rule consumes an unclosed
# rest in one go and puts it back. The time and date rules look at the next characters first, which
# rules out most positions cheaply.
_URL = f"https?://{_INK}+"
_EMAIL = f"(?<!{_INK}){_INK}[^{_SPACE}@]*+@{_INK}+"
_TAG = r"<[^>]++>|(<[^>]*+\z)"
_TIME = f"(?={_DIGIT})(?<![{_WORD}]){_DIGIT}{{1,2}}:{_DIGIT}{{2}}:{_DIGIT}{{2}}[{_SPACE}]*(?:am|pm)?{_EDGE}"
_DATE = (
    f"(?iu)(?=[jfmasond][aepuco][nbrylgptvc])(?<![{_WORD}])(?:{_MONTHS})"
    f"[{_SPACE}]+{_DIGIT}{{1,2}}(?:,[{_SPACE}]*{_DIGIT}{{4}})?{_EDGE}"
)
_PAGE_MARK = rf"\[[{_SPACE}]*{_DIGIT}+[{_SPACE}]*\]"

# Characters that NFKC leaves alone and that never combine with a neighbour: ASCII, precomposed
# Latin letters and plain typographic marks. Text made of these only skips the UDF.
NFKC_STABLE = (
    "\\x00-\\x7f"
    "¡-§©«-®°±¶·»¿-ı"
    "Ĵ-ľŁ-ňŊ-ž"
    "‐‒-‖‘-‣€"
)


@F.pandas_udf(T.StringType())
def _nfkc_udf(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(col: Column) -> Column:
    """Unicode NFKC. Spark runs a Python UDF on every row, so rows that need none are sent as null."""
    beyond_ascii = F.octet_length(col) > F.length(col)
    return F.coalesce(_nfkc_udf(F.when(beyond_ascii & col.rlike(f"[^{NFKC_STABLE}]"), col)), col)


def strip_noise(col: Column) -> Column:
    """Drop URLs, e-mails, markup, times, dates, page marks, punctuation and digits, in this order.

    Takes lower-case NFKC text and leaves only ``a-z`` and spaces. Runs of digits vanish without a
    space, every other foreign character becomes one.
    """
    for pattern in (_URL, _EMAIL):
        col = F.regexp_replace(col, pattern, "")
    col = F.regexp_replace(col, _TAG, "$1")
    for pattern in (_TIME, _DATE, _PAGE_MARK):
        col = F.regexp_replace(col, pattern, "")
    return F.regexp_replace(F.regexp_replace(col, "[^a-z0-9]+", " "), "[0-9]+", "")


def _kept(words: Column, shortest: int, stop_words: Sequence[str]) -> Column:
    return F.filter(words, lambda w: (F.length(w) >= shortest) & ~w.isin(*stop_words))


def normalize_text(col: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Clean a text: lower case, NFKC, noise rules, stop words. Null and empty give an empty string.

    Punctuation never survives, so rules that would look for money, repeated marks, hyphens or years
    afterwards could not match and are left out.
    """
    clean = strip_noise(nfkc(F.lower(F.coalesce(col, F.lit("")))))
    return F.array_join(_kept(F.split(clean, " "), 1, stop_words), " ")


def tokenize(col: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Words of two or more letters or digits, lower case, without stop words, in text order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(f"[{_WORD}]{{2,}}"), F.lit(0))
    return _kept(words, 2, stop_words)
