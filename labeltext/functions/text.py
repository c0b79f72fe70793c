"""Text and label expressions. All of them stay inside the JVM, except accent folding of
rows that are not plain ASCII."""

from __future__ import annotations

import functools
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from labeltext.functions.batches import pieces, release

# Bytes of texts whose accents are folded at a time; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20

# Character classes that decide the results.
WHITESPACE = r"[\p{IsWhite_Space}\x1c-\x1f]+"
TOKEN = r"[\p{L}\p{N}_]{2,}"
NUMBER = r"^[+-]?(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$"
ASCII = r"^[\x00-\x7f]*$"
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def na_to_null(column: Column) -> Column:
    """Null for the spellings a raw CSV uses for a missing value."""
    return F.when(column.isin(NA_TOKENS), F.lit(None)).otherwise(column)


def strip(column: Column) -> Column:
    return F.regexp_replace(
        F.regexp_replace(column, "^" + WHITESPACE, ""), WHITESPACE + "$", ""
    )


def clean_text(
    column: Column, lowercase: bool = True, normalize_whitespace: bool = True
) -> Column:
    """Lower-case, collapse whitespace runs, strip. URLs, addresses, digits and
    punctuation stay; null becomes the empty string."""
    text = F.coalesce(column, F.lit(""))
    if lowercase:
        text = F.lower(text)
    if normalize_whitespace:
        return F.trim(F.regexp_replace(text, WHITESPACE, " "))
    return strip(text)


def normalize_label(column: Column) -> Column:
    """0 or 1 as BIGINT for any spelling of these two numbers, else null."""
    text = strip(column.cast("string"))
    number = F.when(text.rlike(NUMBER), F.regexp_replace(text, "_", "").try_cast("double"))
    return F.when(number.isin(0.0, 1.0), number.cast("bigint"))


@functools.cache
def _combining() -> str:
    """A character class of all characters with a combining class, from Python's tables."""
    codes = [k for k in range(0x110000) if unicodedata.combining(chr(k))]
    ranges, first = [], None
    for k, code in enumerate(codes):
        first = code if first is None else first
        if k + 1 == len(codes) or codes[k + 1] != code + 1:
            ranges.append(f"\\x{{{first:x}}}-\\x{{{code:x}}}")
            first = None
    return f"[{''.join(ranges)}]+"


def fold_accents(column: Column) -> Column:
    """Compatibility-decompose and drop combining marks. Spark has no such function, so rows
    with a non-ASCII character pass through Arrow; ASCII rows do not leave the JVM. Texts are
    decomposed by Python's tables (Arrow's are of another Unicode version), a text at a time."""
    marks = _combining()

    def folded(texts: pa.Array) -> pa.Array:
        plain = [t if t is None else unicodedata.normalize("NFKD", t) for t in texts.to_pylist()]
        return pc.replace_substring_regex(pa.array(plain, pa.string()), marks, "")

    @F.arrow_udf("string")
    def fold_rows(texts: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        parts = [folded(texts.slice(a, b - a)) for a, b in pieces(sizes, PIECE_BYTES)]
        out = pa.concat_arrays(parts) if parts else folded(texts)
        del parts
        release()
        return out

    return F.coalesce(fold_rows(F.when(~column.rlike(ASCII), column)), column)


def tokens(column: Column) -> Column:
    """Words of two or more letters, digits or underscores, case kept."""
    return F.regexp_extract_all(column, F.lit(TOKEN), F.lit(0))


def analyzed_text(column: Column, lowercase: bool = True, accents: bool = True) -> Column:
    """Text as the features see it: lower-cased and with accents folded."""
    text = F.lower(column) if lowercase else column
    return fold_accents(text) if accents else text
