"""Licence scan with a positional index of rare tokens, in Spark expressions only.

Templates are licence notices as word lists, each with the number of words that
must agree and the words of its mandatory key phrases; the base phrases are
templates of which every word must agree.

1. The documents that hold each licence word are counted over the whole corpus;
   few documents means high IDF.  The vocabulary is that of the templates.
2. The index maps a word to its postings, (template, position).  Of a template
   that may miss k words, the k + 2 words of highest IDF are indexed: wherever
   the template fits, at least two of them stand at their places.
3. A file looks up those of its words that the index knows, turns every posting
   into (template, start), and keeps the starts that two postings agree on:
   the intersection of postings by relative position.
4. At each such start all words are compared; the template fits if enough agree
   and all words of its mandatory key phrases do.

Nothing is missed by the choice of words, so IDF decides the cost and not the
result.  A document is judged in its own row: no shuffle but for the counts.

Defined results: null and empty texts have no words, no place and no label, and
score 0; a notice that is cut at the start or end of a text still fits if enough
words are left; repeated rows and rows without id are judged each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
AGREE = 0.8  # share of a notice's words that must agree
SHIFT = 1 << 16  # keeps starts before the text positive
WIDE = 1 << 32

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Words of public licence notices (label, notice, mandatory key phrases).
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "2 0"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     ["redistribution and use", "binary forms"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc0-1.0", "dedicated to the public domain under cc0 1 0", ["public domain", "cc0"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("lgpl-3.0", "licensed under the gnu lesser general public license version 3", ["lesser general public license version 3"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     ["hereby granted free of charge"]),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
]


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    need: int  # words that must agree
    must: tuple[int, ...]  # positions of the mandatory key phrases
    base: bool


def notice(label: str, text: str, phrases: list[str]) -> Template:
    words, must = text.split(), set()
    for phrase in phrases:
        own = phrase.split()
        at = next(i for i in range(len(words)) if words[i : i + len(own)] == own)
        must |= set(range(at, at + len(own)))
    need = max(len(words) - floor(len(words) * (1 - AGREE) + 1e-9), 2)
    return Template(label, tuple(words), need, tuple(sorted(must)), False)


TEMPLATES = [
    *(Template(label, tuple(p.split()), len(p.split()), tuple(range(len(p.split()))), True) for p, label in BASE.items()),
    *(notice(*n) for n in NOTICES),
]


def text_words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD), "")


def word_counts(docs: DataFrame, templates: list[Template]) -> dict[str, int]:
    """Number of documents that hold each word of the templates."""
    vocabulary = sorted({w for t in templates for w in t.words})
    known = F.array(*map(F.lit, vocabulary))
    held = docs.select(F.explode(F.array_intersect(text_words(F.col("text")), known)).alias("word"))
    found = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}  # template words only
    return {w: found.get(w, 0) for w in vocabulary}


def rare_postings(templates: list[Template], counts: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """(template, position) of the indexed words: of each template its rarest, as many as it may miss and two more."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(templates):
        if template.need < 2:
            raise ValueError("a template needs two words that must agree")
        by_rarity = sorted(range(len(template.words)), key=lambda p: (counts[template.words[p]], template.words[p], p))
        for place in by_rarity[: len(template.words) - template.need + 2]:
            index.setdefault(template.words[place], []).append((number, place))
    return index


def _list(values: list[Column], kind: str) -> Column:
    return F.array(*values).cast(f"array<{kind}>")


def _literal(templates: list[Template]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(t.label).alias("label"), _list([F.lit(w) for w in t.words], "string").alias("words"), F.lit(t.need).alias("need"),
                _list([F.lit(p) for p in t.must], "int").alias("must"), F.lit(t.base).alias("base"),
            )
            for t in templates
        )
    )


def scan_licenses(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    ``n_base`` counts the places of base phrases, ``first_word`` and ``last_word``
    bound their starts; ``score`` is the largest share of a fitting template's
    words that agree; ``places`` lists all fits (label, start, matched).
    """
    index = rare_postings(templates, word_counts(docs, templates))
    known = F.array(*map(F.lit, sorted(index)))
    postings = F.create_map(
        *(
            c
            for word in sorted(index)
            for c in (F.lit(word), F.array(*(F.lit(t * WIDE + SHIFT - p).cast("long") for t, p in index[word])))
        )
    )
    none = F.array().cast("array<long>")
    read = docs.select("doc_id", text_words(F.col("text")).alias("words"))
    hits = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(*index), F.struct(w.alias("word"), i.cast("long").alias("at")))),
        lambda h: h.isNotNull(),
    )
    codes = F.sort_array(
        F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(postings, h["word"]), lambda p: p + h["at"])))
    )
    looked_up = read.withColumn("codes", F.when(F.arrays_overlap("words", known), codes).otherwise(none))
    agreed = looked_up.withColumn(
        "codes", F.array_distinct(F.filter("codes", lambda c, i: (i > 0) & (c == F.get("codes", i - 1))))
    )
    table = _literal(templates)

    def fit(code: Column) -> Column:
        start = (code % WIDE - SHIFT).cast("int")
        template = F.get(table, F.shiftright(code, 32).cast("int"))
        same = lambda j, w: F.coalesce(F.get("words", start + j) == w, F.lit(False))
        return F.struct(
            template["label"].alias("label"), template["base"].alias("base"), start.alias("start"),
            F.size(F.filter(template["words"], lambda w, j: same(j, w))).alias("matched"), F.size(template["words"]).alias("size"),
            template["need"].alias("need"), F.forall(template["must"], lambda j: same(j, F.get(template["words"], j))).alias("keys"),
        )

    fits = F.filter(F.transform("codes", fit), lambda f: f["keys"] & (f["matched"] >= f["need"]))
    found = agreed.select("doc_id", F.size("words").cast("long").alias("n_words"), fits.alias("fits"))
    base = found.withColumn("base", F.filter("fits", lambda f: f["base"]))
    starts = F.transform("base", lambda f: f["start"].cast("long"))

    def labels(of: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda f: f["label"]))), ",")

    return base.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("base").alias("base_labels"), labels("fits").alias("labels"),
        F.coalesce(F.array_max(F.transform("fits", lambda f: f["matched"] / f["size"])), F.lit(0.0)).alias("score"),
        F.transform("fits", lambda f: F.struct(f["label"], f["start"], f["matched"])).alias("places"),
    )


def _sql() -> str:
    places = ", ".join(
        f"({t}, {p}, '{w}', {p in template.must})" for t, template in enumerate(TEMPLATES) for p, w in enumerate(template.words)
    )
    heads = ", ".join(
        f"({i}, '{t.label}', {len(t.words)}, {t.need}, {len(t.must)}, {t.base})" for i, t in enumerate(TEMPLATES)
    )
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM words),
places(t, p, word, must) AS (VALUES {places}),
templates(t, label, size, need, n_must, base) AS (VALUES {heads}),
aligned AS (
  SELECT doc_id, t, i - p AS start, count(*) AS matched, count(*) FILTER (WHERE must) AS held
  FROM each JOIN places USING (word) GROUP BY ALL),
fits AS (SELECT * FROM aligned JOIN templates USING (t) WHERE matched >= need AND held = n_must),
told AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word,
    max(start) FILTER (WHERE base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(matched::DOUBLE / size) AS score
  FROM fits GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM words w LEFT JOIN told USING (doc_id)"""


SQL = _sql()
