"""Rows are judged by their own texts: stages on rows without id, with repeated ids and with names that results use; both ways of op2."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.llm import chat, contamination, jaccard, substrings, url_filter

BENCH = "b1 b2 b3 b4 b5 b6 b7 b8 b9 b10 b11 b12 b13 b14"
CLEAN = " ".join(f"c{i}" for i in range(40))
CLASHING = ["_place", "kept", "n_words", "n_removed", "_text", "_spans", "_doc", "_lost", "doc", "number", "row", "node", "spans", "text2"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def table(spark, rows):
    """Rows (doc_id, text); every extra column has a value that tells its row."""
    made = [(i, t, "en", "s", len(t or ""), *(f"{c}-{k}" for c in CLASHING)) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(made, SCHEMA)


def numbers(frame):
    """Numbers of the rows left, after a look at all extra columns."""
    rows = frame.collect()
    for r in rows:
        assert len({r[c].rsplit("-", 1)[1] for c in CLASHING}) == 1 and all(r[c].startswith(f"{c}-") for c in CLASHING)
    return sorted(int(r["kept"].rsplit("-", 1)[1]) for r in rows)


def test_decontaminate_judges_rows(spark):
    bench = spark.createDataFrame([(1, BENCH)], "item_id long, text string")
    docs = table(spark, [(None, BENCH), (1, BENCH), (1, CLEAN), (2, BENCH + " x"), (None, CLEAN), (None, None), (2, "")])
    for small in (contamination.SMALL, -1):
        left = contamination.decontaminate(docs, bench, small=small)
        assert left.schema == docs.schema and numbers(left) == [2, 4, 5, 6]


def test_keep_one_judges_rows(spark):
    other = CLEAN.replace("c", "d")
    docs = table(spark, [
        (5, CLEAN), (5, other), (5, CLEAN), (None, CLEAN), (None, BENCH), (None, BENCH), (3, other), (7, None), (7, ""), (None, None), (9, BENCH + " y")
    ])
    left = jaccard.keep_one(docs, percent=80)
    assert left.schema == docs.schema
    kept = numbers(left)
    assert len([k for k in kept if k in (0, 2)]) == 1 and [k for k in kept if k not in (0, 2)] == [6, 7, 8, 9, 10]
    assert jaccard.keep_one(docs.where(F.lit(False))).count() == 0


def test_drop_repeats_keeps_columns(spark):
    docs = table(spark, [(1, CLEAN), (2, "own " + CLEAN + " end"), (2, "two  blanks"), (None, CLEAN), (3, None), (4, "")])
    left = substrings.drop_repeats(docs, bits=1 << 15)
    assert left.columns == docs.columns and numbers(left) == list(range(6))
    told = {int(r["kept"].rsplit("-", 1)[1]): (r["doc_id"], r["text"], r["n_chars"]) for r in left.collect()}
    assert told == {
        0: (1, CLEAN, len(CLEAN)), 1: (2, "own end", 7), 2: (2, "two  blanks", 11), 3: (None, CLEAN, len(CLEAN)), 4: (3, None, 0), 5: (4, "", 0),
    }


def test_pipeline_stages_run_on_odd_rows(spark, tmp_path):
    import corpus_pipeline

    docs = table(spark, [(None, CLEAN + " Words and so on"), (1, CLEAN), (1, BENCH + " more"), (2, None), (2, CLEAN)])
    spark.createDataFrame([(1, BENCH)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, str(tmp_path))
        assert made.columns == docs.columns and made.write.mode("overwrite").parquet(f"{tmp_path}/{name}") is None
        assert stage(spark, docs.where(F.lit(False)), str(tmp_path)).count() == 0
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert mixed.columns[: len(docs.columns)] == docs.columns and mixed.count() >= 1


def texts_of(seed, count, vocabulary):
    rng = random.Random(seed)
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40))) for _ in range(count)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_joined_benchmark_equals_suffix_arrays(spark, seed):
    """Few different words, so that most documents hold many overlapping matches of several items."""
    rng = random.Random(seed)
    words = ["aa", "Bb", "c", "日本"]
    items = [(rng.choice([None, 1, 2, 30, 4]), t) for t in texts_of(seed, 12, words)] + [(7, None), (8, ""), (9, "aa")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(rng.choice([None, *range(30)]), t) for t in texts_of(seed + 10, 60, [*words, "other"])] + [(99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    both = [
        sorted(map(str, contamination.find_contamination(docs, bench, window=4, small=small).collect())) for small in (1 << 20, -1)
    ]
    assert both[0] == both[1] and len(both[0]) == len(rows)
    names = ["doc_id", "item_id", "doc_word", "item_word", "n_words"]
    found = [
        {str(r) for r in contamination.longest_matches(docs, bench, window=4, small=small).select(names).collect()} for small in (1 << 20, -1)
    ]
    assert found[0] == found[1] and len(found[0]) > 60


def test_distrust_reaches_hosts_fifteen_links_away(spark):
    """A chain of hosts that ends at a blocked one; each host's share is its follower's times the damping."""
    link = lambda host: f'<a href="https://{host}/">x</a>'
    rows = [(i, f"https://h{i}.test/", link(f"h{i + 1}.test") if i < 15 else link("bad.net")) for i in range(16)]
    rows.append((16, "https://bad.net/", None))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, block_at=url_filter.UNIT // 100).collect()}
    rank, want = url_filter.UNIT * 15 // 100, {16: url_filter.UNIT * 15 // 100}
    for i in range(15, -1, -1):
        rank = rank * 85 // 100
        want[i] = rank
    assert {i: r["distrust"] for i, r in got.items()} == want
    assert [got[i]["verdict"] for i in range(17)] == ["block" if want[i] >= url_filter.UNIT // 100 else "allow" for i in range(17)]
    assert got[0]["distrust"] > 0 and got[1]["verdict"] == "block"


def test_ranks_settle_in_a_cycle(spark):
    """Two hosts that link to each other; the sum of the series is known."""
    rows = [(1, "https://a.net/", '<a href="https://b.test/">x</a>'), (2, "https://b.test/", '<a href="https://a.net/">x</a>')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["distrust"] for r in url_filter.judge_urls(pages).collect()}
    a = 0.15 / (1 - 0.85**2) * url_filter.UNIT
    assert abs(got[1] - a) < 1e-4 * url_filter.UNIT and abs(got[2] - 0.85 * a) < 1e-4 * url_filter.UNIT


@pytest.mark.parametrize("turns", [1, 2, 30, 20_000])
def test_chat_of_many_turns(spark, turns):
    """Long conversations come back turn by turn; the mask holds each learned text once."""
    rng = random.Random(turns)
    rows = [(5, i, rng.choice(["user", "assistant", "tool\n", None]), rng.choice([None, "", "ä😀", "<|im_end|>\n", "<||<|im_sep|>", "x" * 9])) for i in range(turns)]
    made = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).first()
    assert [tuple(t) for t in made["turns"]] == [(r or "", t or "") for _, _, r, t in rows]
    assert made["loss_texts"] == [t or "" for _, _, r, t in rows if r == "assistant"]


def test_running_totals(spark):
    rows = [([],), ([5],), ([1, 2],), (list(range(10)),), ([7] * 1000,)]
    got = spark.createDataFrame(rows, "v array<bigint>").select("v", chat.running_totals(F.col("v")).alias("s")).collect()
    assert all(r["s"] == [sum(r["v"][: i + 1]) for i in range(len(r["v"]))] for r in got)


def sets_of(rng, count, size):
    return [np.unique(rng.integers(0, 2**64, size, dtype=np.uint64)) for _ in range(count)]


@pytest.mark.parametrize("size", [10, 12, 20, 47, 100, 400, 3000])
def test_linked_sets_share_a_signature(size):
    """Neighbours at the very limit, also with hashes that leave most ranges empty."""
    rng = np.random.default_rng(size)
    for narrow in (64, 40, 8):
        for _ in range(30):
            base = np.unique(rng.integers(0, 2**narrow, 4 * size, dtype=np.uint64, endpoint=False))
            base = rng.permutation(base)[:size]
            out = int(rng.integers(0, size // 10 + 1))
            new = rng.integers(0, 2**64, int(rng.integers(0, size // 10 + 1)), dtype=np.uint64)
            one, two = np.unique(base), np.unique(np.concatenate([base[out:], new]))
            common = len(np.intersect1d(one, two))
            if 100 * common >= 90 * (len(one) + len(two) - common) and not np.array_equal(one, two):
                assert len(np.intersect1d(jaccard.signatures(one, 90), jaccard.signatures(two, 90)))


@pytest.mark.parametrize("size", [12, 20, 100, 1500])
def test_unlike_sets_share_no_signatures(size):
    """No signature grows with the number of sets: ten times as many sets, none shared by more of them."""
    rng = np.random.default_rng(size)
    most = []
    for count in (200, 2000):
        _, times = np.unique(np.concatenate([jaccard.signatures(s, 90) for s in sets_of(rng, count, size)]), return_counts=True)
        most.append(times.max())
    assert most == [1, 1]
