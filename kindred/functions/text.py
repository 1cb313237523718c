"""Normalising names and addresses: columns in, columns out.

Only Unicode normal forms have no builtin; they are Arrow UDFs that run once
per entity, never per pair.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that do not tell names apart (stop words in English, French and romanised Hindi,
# legal forms, generic business words, name parts of web addresses).
STOP_WORDS = (
    "the", "a", "an", "of", "in", "at", "on", "to", "for", "by", "with", "and", "or", "is", "it", "its", "this", "that", "no", "not", "are", "was",
    "were", "been", "be", "being", "have", "has", "had", "do", "does", "did", "will", "would", "could", "should", "may", "might", "shall", "can",
    "de", "la", "le", "les", "du", "des", "et", "en", "un", "une", "au", "aux", "sur", "par", "pour", "dans", "avec", "ke", "ka", "ki", "se", "ko",
    "me", "hai", "aur", "ya", "inc", "incorporated", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "llp", "lp", "plc", "pvt",
    "private", "gmbh", "ag", "sarl", "sas", "sa", "eurl", "sci", "snc", "srl", "pty", "bv", "nv", "ab", "oy", "as", "kg", "ohg", "group", "groups",
    "holdings", "holding", "enterprises", "enterprise", "industries", "industry", "industrial", "associates", "associate", "partners", "partner",
    "partnership", "international", "intl", "global", "worldwide", "services", "service", "solutions", "solution", "technologies", "technology",
    "tech", "trading", "traders", "trader", "trade", "systems", "system", "consultants", "consultant", "consulting", "consultancy", "management",
    "ventures", "venture", "products", "product", "productions", "production", "communications", "communication", "logistics", "networks", "network",
    "marketing", "advertising", "media", "agencies", "agency", "corporate", "professionals", "professional", "foundation", "institute", "institution",
    "organization", "organisation", "com", "net", "org", "io", "biz", "info",
)


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition; rows of ASCII alone are as they are."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def _folded(text: str) -> str:
    out, latin = [], False
    for c in unicodedata.normalize("NFD", text):
        if unicodedata.category(c) == "Mn":
            if latin:
                continue
        else:
            latin = c.isascii() and c.isalpha()
        out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


@F.pandas_udf(StringType())
def without_latin_marks(text: pd.Series) -> pd.Series:
    """Drops marks whose base is an ASCII letter; marks of other scripts stay."""
    return text.map(lambda t: t if t is None or t.isascii() else _folded(t))


def blank_for_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def normalized(text: Column) -> Column:
    """Composed, lower-cased, ``&`` spelled out; letters, marks, numbers and single spaces are left."""
    kept = F.regexp_replace(F.replace(F.lower(nfc(blank_for_null(text))), F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{M}\p{N} ]", " ")
    return F.trim(F.regexp_replace(kept, " +", " "))


def tokens(norm: Column) -> Column:
    """Words of a normalised text without stop words and single characters, in order, repeats kept."""
    return F.filter(F.split(norm, " "), lambda t: (F.char_length(t) > 1) & ~t.isin(*STOP_WORDS))  # hashed, as they are literals


def core(toks: Column) -> Column:
    """Distinct tokens in code-point order as one string."""
    return F.array_join(F.array_sort(F.array_distinct(toks)), " ")


def squashed(toks: Column) -> Column:
    return F.array_join(toks, "")


def numbers(norm: Column) -> Column:
    """The first five, in string order, of a normalised address's distinct numbers of two digits or more."""
    found = F.filter(F.split(norm, r"[ \p{M}]+"), lambda x: x.rlike(r"^\p{Nd}{2,}$"))
    return F.slice(F.array_sort(F.array_distinct(found)), 1, 5)


def pins(nums: Column) -> Column:
    return F.filter(nums, lambda n: F.char_length(n) == 6)


def trigrams(text: Column) -> Column:
    """Distinct trigrams of a text between ``^`` and ``$``; none for an empty one."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))
    letters = F.regexp_extract_all(framed, F.lit("(?s)."), F.lit(0))
    from_ = lambda at: F.slice(letters, at, F.size(letters) - 2)
    grams = F.zip_with(from_(1), F.zip_with(from_(2), from_(3), lambda a, b: F.concat(a, b)), lambda a, b: F.concat(a, b))  # one walk over the text, however long
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.array_distinct(grams))


def bucket(entity_id: Column, buckets: int = 100) -> Column:
    """The SHA-256 of an id as one number, modulo ``buckets``."""
    digest = F.sha2(entity_id, 256)
    out = F.lit(0).cast("long")
    for i in range(8):
        part = F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
        out = (out * ((1 << 32) % buckets) + part) % buckets
    return out
