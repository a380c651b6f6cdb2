"""Licence scan against a plain comparison of every template at every start."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tripweave.llm import license_scan as scan

COLUMNS = "n_words n_base first_word last_word base_labels labels score".split()


def plain(text, templates=scan.TEMPLATES):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    starts, labels, base, score = [], set(), set(), 0.0
    for t in templates:
        for start in range(-len(t.words), len(words)):
            same = [0 <= start + j < len(words) and words[start + j] == w for j, w in enumerate(t.words)]
            if sum(same) >= t.need and all(same[j] for j in t.must):
                labels.add(t.label)
                score = max(score, sum(same) / len(same))
                if t.base:
                    starts.append(start)
                    base.add(t.label)
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score


def texts_of(seed, count):
    rng = random.Random(seed)
    notices = [" ".join(t.words) for t in scan.TEMPLATES]
    vocabulary = sorted({w for t in scan.TEMPLATES for w in t.words})
    made = []
    for _ in range(count):
        words = []
        for _ in range(rng.randrange(5)):
            own = rng.choice(notices).split()
            for _ in range(rng.randrange(3)):  # some words go, change or come in
                at = rng.randrange(len(own))
                own[at : at + rng.randrange(2)] = rng.choice([[], ["other"], [rng.choice(vocabulary)]])
                own = own or ["empty"]
            words += [rng.choice(vocabulary) for _ in range(rng.randrange(6))] + own
        made.append(" ".join(w.upper() if rng.random() < 0.2 else w for w in words) + rng.choice(["", ".", "\n"]))
    return made


ODD = [
    None, "", "...", "cc by", "CC-BY", "cc by cc by cc by", "all rights reserved", "general public license version 3", "apache license version 2.0",
    "license " * 3000 + "released under the MIT license", "ÀCC BY", "cc by", "cc_by", "by cc", "Licensed under CC BY-NC 4.0.", "ſ K cc by",
]


def table(spark, texts):
    return spark.createDataFrame(
        [(i, t, "x", 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, words string, codes int, fits int"
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_comparison(spark, seed):
    texts = ODD + texts_of(seed, 120)
    got = scan.scan_licenses(table(spark, texts)).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in got] == [plain(t) for t in texts]


def test_result_does_not_depend_on_the_words_that_are_rare(spark):
    texts = texts_of(3, 40)
    common = ["license version public the under"] * 60
    alone = scan.scan_licenses(table(spark, texts)).orderBy("doc_id").collect()
    among = scan.scan_licenses(table(spark, texts + common)).orderBy("doc_id").limit(40).collect()
    assert alone == among


def test_index_holds_the_rarest_words():
    templates = [scan.notice("x", "a b c d e f g h i j", ["a b"])]
    counts = dict(zip("abcdefghij", range(10, 0, -1), strict=True))
    assert templates[0].need == 8 and sorted(scan.rare_postings(templates, counts)) == ["g", "h", "i", "j"]


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, "cc by"), (None, None), (4, "cc by"), (4, "cc by")], "doc_id long, text string")
    assert sorted((r["doc_id"] or -1, r["labels"]) for r in scan.scan_licenses(docs).collect()) == [
        (-1, ""), (-1, "cc-by"), (4, "cc-by"), (4, "cc-by"),
    ]
    assert scan.scan_licenses(docs.where(F.lit(False))).collect() == []


def test_main_path_has_no_python(spark):
    plan = scan.scan_licenses(table(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
