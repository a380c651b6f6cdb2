"""Operators on odd tables: nulls, empty and very long texts, ties, repeated rows, no rows, clashing columns."""

import hashlib
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripweave.llm import chat, contamination, jaccard, language, mixing, nearest, quality, substrings, token_counts, url_filter
from tripweave.llm.common import components

FOLDER = "/root/testdata/sf0.001"
PHRASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ROWS = [
    (1, PHRASE + " alpha", "en", "s1"),
    (2, PHRASE + " alpha", "en", "s1"),  # a copy
    (2, PHRASE + " alpha", "en", "s1"),  # the same row again
    (3, "Before it " + PHRASE, "fr", None),
    (4, None, "en", "s2"),
    (5, "", None, "s2"),
    (6, " \n\t ", "en", "s2"),
    (7, "short one", "en", "s3"),
    (8, "12 34 !!", "en", "s3"),
    (9, "word " * 60_000, "en", "s1"),
    (None, PHRASE + " alpha", "en", "s1"),
    (None, None, None, None),
    (10, "Ünïcödé 日本語 😀 text", "fr", "s3"),
]
EXTRA = ["h", "n", "row", "kept", "n_words", "score", "component_id", "size", "rep", "sig", "best", "entropy"]
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in EXTRA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(frame):
    return {r["doc_id"]: r for r in frame.where("doc_id IS NOT NULL").collect()}


@pytest.mark.parametrize("small", [contamination.SMALL, -1])
def test_decontamination(spark, docs, none, small):
    """As suffixes in all tasks and, for a benchmark above the bound, by joins."""
    bench = spark.createDataFrame(
        [(1, PHRASE), (1, PHRASE), (2, "short one"), (None, "Ünïcödé"), (3, None), (4, ""), (5, "12")], "item_id long, text string"
    )
    found = contamination.find_contamination(docs, bench, small=small)
    assert found.count() == len(ROWS)
    got = by_id(found)
    assert (got[1]["n_words"], got[1]["n_hit"], got[1]["n_items"], got[1]["contaminated"]) == (15, 14, 1, True)
    assert got[1]["items_sha256"] == hashlib.sha256(b"1").hexdigest()
    assert (got[7]["n_hit"], got[8]["n_hit"], got[10]["n_hit"], got[10]["n_items"]) == (2, 1, 1, 0)
    assert not got[4]["contaminated"] and got[9]["n_words"] == 60_000 and got[9]["n_hit"] == 0
    assert contamination.find_contamination(none, bench, small=small).count() == 0
    assert not contamination.find_contamination(docs, bench.limit(0), small=small).where("n_hit > 0").count()
    stay = contamination.decontaminate(docs, bench, small=small)
    assert sorted(r[0] or 0 for r in stay.select("doc_id").collect()) == [0, 4, 5, 6, 9] and stay.columns == docs.columns
    match = contamination.longest_matches(docs.where("doc_id = 3"), bench, small=small).collect()
    assert [(r["item_id"], r["doc_word"], r["item_word"], r["n_words"]) for r in match] == [("1", 2, 0, 14)]


def test_jaccard(spark, docs, none):
    found = jaccard.jaccard_groups(docs)
    assert found.count() == len(ROWS)
    got = by_id(found)
    assert [got[i]["component_id"] for i in (1, 2, 3, 4, 5, 6, 7, 9)] == [1, 1, 3, 4, 5, 6, 7, 9]
    assert [got[i]["n_shingles"] for i in (1, 4, 5, 6, 7, 9)] == [13, 0, 0, 0, 1, 1]
    nameless = found.where("doc_id IS NULL").orderBy("n_shingles").collect()
    assert [(r["n_shingles"], r["component_id"]) for r in nameless] == [(0, None), (13, 1)]
    assert jaccard.jaccard_groups(none).count() == 0
    kept = jaccard.keep_one(docs)
    assert sorted(r[0] for r in kept.where("doc_id IS NOT NULL").select("doc_id").collect()) == [1, 3, 4, 5, 6, 7, 8, 9, 10]


@pytest.mark.parametrize("tile", [1000, 5])
def test_jaccard_equals_brute_force(spark, tile):
    """With tiles of five sets most groups are split, and still no link is lost."""
    random_ = np.random.default_rng(tile)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [list(random_.choice(vocabulary, 120)) for _ in range(4)]
    texts = []
    for i in range(80):
        words = list(base[i % 4])
        for _ in range(random_.integers(0, 6)):
            words[random_.integers(0, 120)] = f"x{random_.integers(0, 10**6)}"
        texts.append(" ".join(words))
    sets = [{tuple(t.split()[i : i + 3]) for i in range(118)} for t in texts]
    of = list(range(80))
    for i in range(80):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                x, y = of[i], of[j]
                of = [min(x, y) if g in (x, y) else g for g in of]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(jaccard.jaccard_groups(frame, tile=tile))
    assert [got[i]["component_id"] for i in range(80)] == of and 4 < len(set(of)) < 80


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(chain, "chain").collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}
    assert components(chain.limit(0), "chain").count() == 0


def test_substrings(spark, docs, none):
    found = substrings.remove_repeats(docs, bits=1 << 16)
    assert found.count() == len(ROWS)
    got = by_id(found.where("NOT (doc_id = 2)"))
    assert [got[i]["n_removed"] for i in (1, 3, 4, 5, 6, 7, 9)] == [0, 14, 0, 0, 0, 0, 0]
    assert got[3]["kept"] == "Before it" and got[4]["kept"] == "" and got[9]["n_words"] == 60_000
    again = found.where("doc_id = 2").collect()
    assert [(r["n_removed"], r["kept"]) for r in again] == [(15, "")] * 2
    assert [r["n_removed"] for r in found.where("doc_id IS NULL").collect()] == [0, 0]
    assert substrings.remove_repeats(none).count() == 0


@pytest.mark.parametrize("hot", [substrings.HOT, 30, 0])
def test_substrings_equal_brute_force(spark, hot):
    """Texts of three words over and over: most windows recur, within documents too; ids repeat."""
    random_ = np.random.default_rng(1)
    rows = [(int(random_.integers(0, 25)), " ".join(random_.choice(list("abc"), random_.integers(0, 40)))) for _ in range(40)]
    window = 5
    first = {}
    for doc, text in rows:
        words = text.split()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, doc), doc)
    want = []
    for doc, text in rows:
        words = text.split()
        gone = {k for i in range(len(words) - window + 1) if first[tuple(words[i : i + window])] < doc for k in range(i, i + window)}
        want.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.remove_repeats(frame, window=window, anchor=2, bits=1 << 15, hot=hot)
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()) == sorted(want)


def test_mixing(spark, docs, none):
    found = mixing.mix_sources(docs)
    assert found.count() == len(ROWS) and mixing.mix_sources(none).count() == 0
    rows = found.toPandas()
    assert (rows.taken <= 3 * rows["size"]).all() and (rows.taken == rows.copies * rows["size"]).all()
    targets = {r["source"]: r for r in mixing.source_targets(spark.createDataFrame(
        [("a", 10), ("b", 1000), (None, 200), ("c", 0)], "source string, size long")).collect()}
    # weights a 5, b 2, c 1, null 5; a stops at 30, null at 600, b takes the rest
    assert {k: round(v["target"], 6) for k, v in targets.items()} == {"a": 30.0, "b": 580.0, "c": 0.0, None: 600.0}


def test_mixing_meets_targets_and_repeats_itself(spark):
    random_ = np.random.default_rng(5)
    rows = [(i, "w " * int(random_.integers(1, 60)), f"s{int(i ** 0.5) % 7}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one, two = (mixing.mix_sources(f).toPandas().sort_values("doc_id").reset_index(drop=True) for f in (frame, frame.repartition(7)))
    assert one.equals(two)
    per = one.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(per.taken - per.target) <= 2 * 60).all() and abs(per.taken.sum() - one["size"].sum()) <= 60


def test_mixing_stage_keeps_nameless_repeated_and_clashing(docs, none, spark, tmp_path):
    import corpus_pipeline

    # one source, so that the whole input is taken once
    rows = docs.withColumn("source", F.lit("s")).withColumn("Taken", F.lit("own"))
    corpus_pipeline.mix_to_targets(spark, rows, "").write.parquet(str(tmp_path / "mixed"))
    got = spark.read.parquet(str(tmp_path / "mixed"))
    assert got.columns == [*rows.columns, "mix_size", "source_size", "target", "copies", "mix_taken"]
    want = [r for r in rows.collect() if (r["text"] or "").split()]
    assert sorted(map(str, got.select(*rows.columns).collect())) == sorted(map(str, want))
    assert {r["doc_id"] for r in want} >= {None, 2} and got.where("copies <> 1").count() == 0
    assert got.agg(F.sum("mix_taken")).first()[0] == sum(len(r["text"].encode().split()) for r in want)
    assert corpus_pipeline.mix_to_targets(spark, none, "").count() == 0


def test_language(docs, none, spark):
    found = language.identify(docs)
    assert found.count() == len(ROWS)
    got = by_id(found)
    assert all(got[i]["lang_pred"] == "und" and got[i]["rejected"] and got[i]["score"] == 0 for i in (4, 5, 6, 8))
    assert got[1]["lang_pred"] in ("en", "fr") and 0 <= got[1]["score"] <= 1
    assert language.identify(none).count() == 0
    untaught = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in untaught.collect()} == {"und"}
    with pytest.raises(ValueError, match="max_grams"):
        language.train(docs, max_grams=3)


def test_language_above_the_bound_of_a_model(docs, none, spark):
    """The joins judge like the collected model, rows without letters and columns of any name included."""
    random_ = np.random.default_rng(4)
    words = {"en": "the house and tree are over there now", "de": "das haus und der baum sind dort", "ja": "東京タワー 日本語の文 京都府の寺"}
    rows = [(i, " ".join(random_.choice(words[k].split(), 9)), k) for k in words for i in range(len(words) * 40)]
    rows += [(i, "".join(random_.choice(list("qxzjkvw"), 30)), "en") for i in range(900, 920)]
    frame = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for parts in (1, 40):  # slices of many rows, and of one row without a letter
        few, many = (language.identify(frame.repartition(parts), max_grams=b) for b in (10**6, 3))
        assert few.columns == many.columns
        order = ["doc_id", "lang_pred", "entropy"]
        few, many = (f.toPandas().sort_values(order).reset_index(drop=True) for f in (few, many))
        pd.testing.assert_frame_equal(few, many, rtol=1e-9)
        assert few.rejected.nunique() == 2 and len(few) == frame.count()
    few, many = (language.known(docs, max_grams=b) for b in (10**6, 3))
    assert many.columns == docs.columns and few.count() > 0
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))


def test_language_limits_cover_all_training_texts(spark):
    """More rows than the sample of 4,000 there once was; no text is predicted as the second of two equal languages."""
    random_ = np.random.default_rng(3)
    rows = [(i, " ".join(random_.choice(["one", "two", "three", "hat", "tree"], 4)), "en") for i in range(5000)]
    rows += [(i + 5000, t, "xx") for i, t, _ in rows] + [(None, "zwei drei vier", "de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(frame)
    assert np.isfinite(model.limits).all()
    mean = dict(language.predict(frame, model).groupBy("n_best").agg(F.avg("entropy")).collect())
    assert model.langs == ["de", "en", "xx"] and set(mean) == {0, 1}
    mean[2] = model.own[2]
    want = [mean[i] + 0.6 * max(model.noise[i] - mean[i], 0) for i in range(3)]
    assert np.allclose(model.limits, want, rtol=1e-12)
    assert abs(model.own[1] - mean[1]) < 0.01  # texts of equal length in words, learned and scored


def test_quality(docs, none, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    found = quality.classify(docs, labels)
    rows = found.toPandas()
    assert len(rows) == len(ROWS) and rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.3)).all()
    assert quality.classify(none, labels).count() == 0
    assert set(quality.classify(docs, labels.limit(0)).toPandas().score) == {0.5}


def test_token_counts(docs, none):
    tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece

    path = tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    found = token_counts.count_tokens(docs, path)
    assert found.count() == len(ROWS) and token_counts.count_tokens(none, path).count() == 0
    got = by_id(found)
    for doc_id, text, *_ in ROWS:
        if doc_id:
            n = len(library.encode(text or ""))
            assert (got[doc_id]["n_tokens"], got[doc_id]["n_bytes"], got[doc_id]["over_limit"]) == (n, len((text or "").encode()), n > 4096)


def test_chat_round_trip(spark):
    odd = ["<|im_end|>\n<|im_start|>assistant ok", "<||", "<", "|>", "\\", "<|im_sep|>", "", "a\nb\n", "<<|", "é😀\n"]
    rows = [(1, i, r, t, "x") for i, (r, t) in enumerate((r, t) for t in odd for r in ("user", "assistant", "assistant"))]
    rows += [(2, None, None, None, "x"), (2, 0, "user\n<|im_nl|>", "t", "x"), (2, 0, "user\n<|im_nl|>", "t", "x")]
    rows += [(None, 0, "assistant", "long " * 50_000, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(turns.repartition(5))
    got = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r[2], r[3]) for r in rows if r[0] == 1]
    assert got[1]["loss_texts"] == [r[3] for r in rows if r[0] == 1 and r[2] == "assistant"]
    assert got[1]["formatted"].count(chat.START) == 20  # two roles for each text, adjacent assistants in one block
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("", ""), ("user\n<|im_nl|>", "t"), ("user\n<|im_nl|>", "t")]
    assert got[None]["loss_texts"] == ["long " * 50_000]
    assert chat.chat_digest(chat.format_conversations(turns.limit(0))).count() == 0


def test_urls(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">' for h in hosts)
    rows = [
        (1, "http://good.org/fr/a", link("FRIEND.info", "far.info")),
        (2, "https://friend.info/p?q=/fr/#f", link("far.info")),
        (3, "http://bad.net/x", None),
        (4, "http://feeder.info/", link("bad.net")),
        (5, "http://far.info", link("good.org")),
        (6, None, link("bad.net")),
        (7, "no host here", ""),
        (8, "http://EXAMPLE.net/en/x", ""),
        (9, "http://www.example.net/de/x", ""),
        (10, "http://example.com/de/x", ""),
        (11, "http://notexample.com/de/x", ""),
        (12, "http://bad.net", ""),  # no path: the rule does not fit, the host is a seed
        (3, "http://bad.net/x", None),
        (None, "ftp://u/", "<a href='//bad.net'>"),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, rank string")
    found = url_filter.judge_urls(pages)
    got = {r["page_id"]: r for r in found.collect()}
    assert found.count() == len(rows)
    assert [(got[i]["host"], got[i]["path"]) for i in (2, 5, 6, 7, 8)] == [
        ("friend.info", "/p"), ("far.info", ""), ("", ""), ("", ""), ("example.net", "/en/x")
    ]
    assert [got[i]["rule"] for i in (1, 3, 8, 9, 10, 11, 12)] == ["org/fr/", "net/", "example.net/en/", "net/", "example.com/de/", None, None]
    verdict = {i: got[i]["verdict"] for i in got}
    assert [verdict[i] for i in (1, 2, 3, 4, 5, 6, 7, 8, 12, None)] == [
        "allow", "allow", "block", "block", "allow", "allow", "allow", "allow", "block", "block"
    ]
    assert got[2]["trust"] > got[2]["distrust"] and got[4]["distrust"] > got[4]["trust"]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_nearest_odd_rows(spark):
    good = [(i, [float(i % 7) - 3.5, 1.0, 0.5]) for i in range(50)]
    odd = [(100, None), (120, [0.0, 0.0, 0.0]), (140, [float("nan"), 1.0, 1.0]), (160, [float("inf"), 1.0, 1.0]),
           (180, [None, 1.0, 1.0]), (200, [1.0]), (None, [1.0, 2.0, 3.0]), (20, [float(20 % 7) - 3.5, 1.0, 0.5])]
    rows = spark.createDataFrame([(*r, "x") for r in good + odd], "vec_id long, embedding array<double>, rank string")
    found = nearest.nearest(rows, F.col("id") % 20 == 0).toPandas()
    assert sorted(set(found.query_id)) == [0, 20, 40]
    vectors = dict(good)
    for query, own in found.groupby("query_id"):
        other = sorted((-sum(a * b for a, b in zip(v, vectors[query], strict=True)), i) for i, v in good if i != query)
        own = own.sort_values("rank")
        assert list(own.vec_id) == [i for _, i in other[:20]] and list(own["rank"]) == list(range(1, 21))
    few = nearest.nearest(rows.where("vec_id < 5 OR vec_id = 20"), F.col("id") % 20 == 0)
    assert few.groupBy("query_id").count().toPandas()["count"].tolist() == [5, 5]
    assert nearest.nearest(rows.limit(0), F.col("id") % 20 == 0).count() == 0


def test_nearest_recall_with_copies(spark):
    """A third of all rows are one vector; leaves are small, so that many are left unvisited."""
    random_ = np.random.default_rng(11)
    points = random_.normal(size=(40, 16))[random_.integers(0, 40, 6000)] + 0.3 * random_.normal(size=(6000, 16))
    points[::3] = points[0]
    rows = spark.createDataFrame(pd.DataFrame({"vec_id": range(6000), "embedding": list(points)}))
    found = nearest.nearest(rows, F.col("id") % 20 == 0, block=300).toPandas().groupby("query_id")
    hits = 0
    for i in range(0, 6000, 20):
        scores = (points * points[i]).sum(axis=1)
        ids = np.delete(np.arange(6000), i)
        best = ids[np.lexsort((ids, -scores[ids]))[:20]]
        own = found.get_group(i)
        assert len(own) == 20 and np.allclose(own.score, scores[own.vec_id], rtol=1e-12)
        hits += len(set(best) & set(own.vec_id))
    assert hits >= 0.9 * 20 * 300


needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")


@needs_tables
def test_learned_operators_on_held_out_rows(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = language.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.97 and not found.rejected.any()
    found = quality.classify(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    assert (found.quality == found.predicted).mean() > 0.93


@needs_tables
def test_pipeline_equals_its_stages_by_hand(spark):
    """Language keeps texts with letters here; the other stages are redone in plain Python."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas()
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet").toPandas()
    got = corpus_pipeline.run(spark, FOLDER).toPandas().sort_values("doc_id")
    texts = {r.doc_id: r.text for r in docs.itertuples() if any(map(str.isalpha, r.text or ""))}
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, text in texts.items():
        words = text.translate(lower).encode().split()
        sets[i] = {tuple(words[k : k + 3]) for k in range(max(len(words) - 2, 1))} if words else set()
    of = {i: i for i in texts}
    for i in texts:
        for j in texts:
            if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                x, y = of[i], of[j]
                of = {k: min(x, y) if g in (x, y) else g for k, g in of.items()}
    texts = {i: t for i, t in texts.items() if of[i] == i}
    first, words = {}, {i: t.encode().split() for i, t in texts.items()}
    for i, own in words.items():
        for k in range(len(own) - 12):
            key = tuple(own[k : k + 13])
            first[key] = min(first.get(key, i), i)
    left = {}
    for i, own in words.items():
        gone = {x for k in range(len(own) - 12) if first[tuple(own[k : k + 13])] < i for x in range(k, k + 13)}
        left[i] = b" ".join(w for k, w in enumerate(own) if k not in gone).decode() if gone else texts[i]
    import re

    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(lower))
    windows = {tuple(w[k : k + min(13, len(w))]) for w in map(find, bench.text) for k in range(len(w) - min(13, len(w)) + 1) if w}
    lengths = {len(w) for w in windows}
    clean = {}
    for i, text in left.items():
        own = find(text)
        hit = {x for n in lengths for k in range(len(own) - n + 1) if tuple(own[k : k + n]) in windows for x in range(k, k + n)}
        if not hit or 20 * len(hit) < len(own):
            clean[i] = text
    sizes = {i: len(t.encode().split()) for i, t in clean.items()}
    assert dict(zip(got.doc_id, got["size"], strict=True)).items() <= sizes.items()
    assert dict(zip(got.doc_id, got.text, strict=True)).items() <= clean.items()
    assert abs(got.taken.sum() - sum(sizes.values())) <= max(sizes.values()) and set(docs.columns) <= set(got.columns)
