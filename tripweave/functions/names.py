"""Latin names: Hangul romanisation and city id slugs."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Latin spelling of Hangul initials, vowels and finals.
INITIALS = (
    "g", "kk", "n", "d", "tt", "r", "m", "b", "pp", "s",
    "ss", "", "j", "jj", "ch", "k", "t", "p", "h",
)
VOWELS = (
    "a", "ae", "ya", "yae", "eo", "e", "yeo", "ye", "o", "wa",
    "wae", "oe", "yo", "u", "wo", "we", "wi", "yu", "eu", "ui", "i",
)
FINALS = (
    "", "k", "k", "k", "n", "n", "n", "t", "l", "k", "m", "l", "l", "l",
    "p", "l", "m", "p", "p", "t", "t", "ng", "t", "t", "k", "t", "p", "t",
)
SYLLABLE_FIRST, SYLLABLE_LAST = 0xAC00, 0xD7A3
RIEUL, SILENT_INITIAL = 8, 11


def romanize(title: Column) -> Column:
    """PascalCase Latin form of a Korean title, parentheses dropped.

    Works syllable by syllable with code point arithmetic, so the whole
    expression stays in the JVM.
    """
    initials, vowels, finals = (
        F.split(F.lit(" ".join(table)), " ") for table in (INITIALS, VOWELS, FINALS)
    )
    text = F.regexp_replace(F.coalesce(title, F.lit("")), r"\([^)]*\)", "")
    chars = F.split(text, "")

    def syllable_index(char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code.between(SYLLABLE_FIRST, SYLLABLE_LAST), code - SYLLABLE_FIRST)

    def spell(char: Column, i: Column) -> Column:
        index = syllable_index(char)
        following = syllable_index(F.get(chars, i + 1))
        final = index % 28
        # A final rieul is pronounced r when a vowel follows.
        linked = (final == RIEUL) & (F.floor(following / 588) == SILENT_INITIAL)
        hangul = F.concat(
            F.get(initials, F.floor(index / 588).cast("int")),
            F.get(vowels, F.floor(index % 588 / 28).cast("int")),
            F.when(linked, F.lit("r")).otherwise(F.get(finals, final)),
        )
        return (
            F.when(index.isNotNull(), hangul)
            .when(char.rlike(r"\A[A-Za-z0-9]\z"), char)
            .otherwise(F.lit(" "))
        )

    words = F.split(F.array_join(F.transform(chars, spell), ""), " ")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), ""
    )


@F.pandas_udf(T.StringType())
def ascii_fold(names: pd.Series) -> pd.Series:
    """Compatibility decomposition with everything beyond ASCII removed.

    Spark has no Unicode normalisation function, hence the Arrow UDF.
    """

    def fold(name: str | None) -> str | None:
        if name is None:
            return None
        return unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode("ascii")

    return names.map(fold, na_action="ignore")


def name_slug(name: Column) -> Column:
    """Upper-case ASCII slug; names without Latin letters get a hash slug."""
    # Only names that need it travel to Python.
    folded = F.coalesce(ascii_fold(F.when(name.rlike(r"[^\x00-\x7F]"), name)), name)
    slug = F.upper(F.regexp_replace(F.regexp_replace(folded, r"[^A-Za-z0-9]+", "-"), r"\A-+|-+\z", ""))
    hashed = F.concat(F.lit("KO-"), F.upper(F.substring(F.sha1(name), 1, 8)))
    return F.coalesce(F.nullif(slug, F.lit("")), hashed)


def city_id(region_id: Column, name_en: Column, title: Column, unknown: str = "KR-UNKNOWN") -> Column:
    """``{region}-{slug}`` of the English name, else of the title."""
    name = F.coalesce(F.nullif(name_en, F.lit("")), F.nullif(title, F.lit("")), F.lit("unknown"))
    return F.concat(F.coalesce(region_id, F.lit(unknown)), F.lit("-"), name_slug(name))
