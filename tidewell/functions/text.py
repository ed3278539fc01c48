"""Text expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Character classes spelled out so that Java, RE2 and Python agree.
WORD_2 = r"[\p{L}\p{N}_]{2,}"
WORD_OR_MARK = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
SPACES = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]+"
SENTENCE_END = r"(?<=[.!?])\s+"
START_MARKER = "*** START OF"
END_MARKER = "*** END OF"
TEXT_FIELDS = ["text", "sentence", "review", "content"]


def words(text: Column) -> Column:
    """Lower-case word tokens of two or more characters, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_2), F.lit(0))


def words_and_marks(text: Column) -> Column:
    """Lower-case words, and every other non-space character on its own."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_OR_MARK), F.lit(0))


def split_spaces(text: Column) -> Column:
    """Tokens between runs of white space; no empty tokens, case kept."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def sentences(text: Column) -> Column:
    """Cut after ``.``, ``!`` or ``?`` followed by white space."""
    return F.filter(F.split(text, SENTENCE_END), lambda s: F.trim(s) != "")


def title_parts(key: Column) -> Column:
    """``sao_luiz`` to ``Sao_Luiz``."""
    return F.array_join(F.transform(F.split(key, "_"), F.initcap), "_")


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z and leave every other letter alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold_accents_fixed(text: Column, accented: str, plain: str) -> Column:
    """Accent folding for a known alphabet; stays in generated code."""
    return F.translate(text, accented, plain)


@F.pandas_udf(StringType())
def fold_accents(s: pd.Series) -> pd.Series:
    """Accent folding for any script: decompose, then drop combining marks."""
    return s.map(
        lambda t: None
        if t is None
        else "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")
    )


def first_text_field(df: DataFrame, names: list[str] | None = None) -> Column:
    """The first of the usual text columns that the table has; nulls fall through to the next."""
    present = [n for n in (names or TEXT_FIELDS) if n in df.columns]
    if not present:
        raise KeyError(f"no text column among {df.columns}")
    return F.coalesce(*[F.col(n) for n in present])


def clean_book(text: Column) -> Column:
    """Keep what lies between the start and end markers; trim lines and drop blank ones."""
    begin = F.locate(START_MARKER, text)
    from_marker = F.when(begin > 0, F.substr(text, begin)).otherwise(text)
    line_end = F.locate("\n", from_marker)
    body = F.when(begin > 0, F.substr(from_marker, line_end + 1)).otherwise(text)
    stop = F.locate(END_MARKER, body)
    body = F.when(stop > 0, F.substr(body, F.lit(1), stop - 1)).otherwise(body)
    lines = F.transform(F.split(body, r"\r\n|\n|\r"), lambda s: F.regexp_replace(s, r"^\s+|\s+$", ""))
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n")


# Pattern and replacement of each clean-up step after gluing pieces.
DETOKENIZE_STEPS = [
    (r"\s+([.,!?;:])", "$1"),
    (r"\s+'\s+", "'"),
    (r"\s+-\s+", "-"),
    (r"\(\s+", "("),
    (r"\s+\)", ")"),
    (r"\s+\[", "["),
    (r"\]\s+", "]"),
]


def tidy_joined_text(text: Column) -> Column:
    """Close the gaps that joining tokens with spaces leaves around punctuation."""
    for pattern, replacement in DETOKENIZE_STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    return F.trim(text)
