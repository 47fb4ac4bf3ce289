"""Text expressions: tokens, terms, excerpts and scores, as columns."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ACCENTS, _NOT_TERM, _NOT_ALPHANUMERIC = re.compile("[\u0300-\u036F]+"), re.compile("[^a-z0-9]+"), re.compile(r"[\W_]+")
#: Fixed value: a word starts with a letter or number and goes on with those and marks.
WORD = r"[\p{L}\p{N}][\p{L}\p{N}\p{M}]*"
#: Fixed value: the words that content tokens leave out.
STOP_WORDS = ("a", "an", "and", "as", "at", "by", "for", "from", "in", "of", "on", "or", "the", "to", "with", "capital", "small", "letter", "sign", "symbol", "emoji", "character")


def words(text: Column) -> Column:
    """Lower-cased words in order; diacritics stay."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def characters(text: Column) -> Column:
    """The code points of a text as one-character strings."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?s)."), F.lit(0))


def code_point(char: Column) -> Column:
    return F.ascii(char)


def code_point_token(cp: Column) -> Column:
    """cp followed by six or more lower-case hex digits."""
    return F.concat(F.lit("cp"), F.lpad(F.lower(F.hex(cp.cast("long"))), 6, "0"))


def is_scalar(cp: Column) -> Column:
    """A Unicode scalar value: in range and no surrogate."""
    return cp.between(0, 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)


def glyph_tokens(text: Column) -> Column:
    """Sorted distinct code-point tokens of the non-ASCII characters, blank-separated."""
    wide = F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x7F]"), F.lit(0)))
    return F.array_join(F.array_sort(F.transform(wide, lambda c: code_point_token(code_point(c)))), " ")


def labelled_code_points(text: Column) -> Column:
    """Code points written as U+ labels of 4 to 8 hex digits, word-bounded, in order, scalar values only."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?i)(?<![\p{L}\p{N}_])U\+([0-9A-F]{4,8})(?![\p{L}\p{N}_])"), F.lit(1))
    return F.filter(F.transform(found, lambda h: F.conv(h, 16, 10).cast("long")), is_scalar)


def content_tokens(term: Column) -> Column:
    """Tokens of a normalised term longer than one character and not stop words; repeats stay."""
    return F.filter(F.split(term, " "), lambda t: (F.length(t) > 1) & ~t.isin(*STOP_WORDS))


@F.pandas_udf(T.StringType())
def normalised_term(text: pd.Series) -> pd.Series:
    """Lower case, compatibility decomposition without combining accents, everything else a blank."""

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        return _NOT_TERM.sub(" ", _ACCENTS.sub("", unicodedata.normalize("NFKD", x.lower()))).strip()

    return text.map(one)


@F.pandas_udf(T.StringType())
def normalised_record_text(text: pd.Series) -> pd.Series:
    """Compatibility composition, lower case, letters and numbers of every script."""

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        return _NOT_ALPHANUMERIC.sub(" ", unicodedata.normalize("NFKC", x).lower()).strip()

    return text.map(one)


def accent_folded(text: Column) -> Column:
    """Terms of Latin text without accents, as built-in expressions (precomposed letters of Latin-1)."""
    accented, plain = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"
    return F.trim(F.regexp_replace(F.translate(F.lower(text), accented, plain), "[^a-z0-9]+", " "))


def excerpt(text: Column, needle: str, before: int = 100, size: int = 700) -> Column:
    """The text around the first match (case folded), or its beginning without one."""
    at = F.locate(needle.lower(), F.lower(text))
    return F.substring(text, F.greatest(F.lit(1), at - before), F.lit(size))


def contains_phrase(longer: Column, shorter: Column) -> Column:
    """Does one normalised term hold another as whole tokens?"""
    return F.contains(F.concat(F.lit(" "), longer, F.lit(" ")), F.concat(F.lit(" "), shorter, F.lit(" ")))


def js_round(x: Column) -> Column:
    return F.floor(x + 0.5)


def popularity_score(popularity: Column) -> Column:
    return js_round(F.log2(1 + F.greatest(F.lit(0), popularity)) * 250).cast("long")


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def bounded_confidence(text: Column) -> Column:
    """A confidence between 0 and 1; what is no number counts as 0."""
    return clamp(F.coalesce(text.try_cast("double"), F.lit(0.0)), 0.0, 1.0)


def term_weight(confidence: Column, family_weight: Column, scope: Column, document_frequency: Column) -> Column:
    rarity = F.greatest(F.lit(1.0), F.log2(document_frequency + 1))
    return clamp(confidence * family_weight * scope / rarity, 0.25, 1.0)


def redacted_url(url: Column) -> Column:
    """A URL without credentials, query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^(\w+://)[^/@]*@", "$1")


def without_controls(text: Column) -> Column:
    """Control characters out, but for line feed and tab."""
    return F.regexp_replace(text, r"[\x00-\x08\x0B-\x1F\x7F-\x9F]", "")


def digest(*parts: Column) -> Column:
    """SHA-256 of parts joined by a unit separator; null counts as empty."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def digest_key(*columns: str) -> Column:
    """SHA-256 that tells any two rows of ``columns`` apart: each value goes with its length, null with -1."""
    parts = [x for c in columns for x in (F.coalesce(F.length(c), F.lit(-1)).cast("string"), F.coalesce(F.col(c).cast("string"), F.lit("")))]
    return F.sha2(F.concat_ws(":", *parts), 256)
