"""Token alignment against a plain version that goes link by link."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripweave.llm import alignment

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  two  blanks ", "a\nb\tc\r\n", "naïve café 日本語 🙂🙂", "x" * 3000, "▁ stays out", "<|endoftext|> <s> </s> <unk> <0x41>",
    "\x00\x01 control", "same text", "same text", "1234567890 12.5%", "don't can't we'll", "aaa aaaaa aaaaaaa", "é" * 50 + " é", "．全角　空白",
]


@pytest.fixture(scope="module")
def tool():
    with open(A, "rb") as a, open(B, "rb") as b:
        return alignment.Aligner(a.read(), b.read())


def plain(tool, texts):
    """One tuple per text, by pairs of byte ranges and a counter of documents."""
    docs, held = [], Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        a = tool.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tool.b.encode(text) if text else []
        if b"".join(tool.bytes_a[i] for i in a) != want or b"".join(tool.bytes_b[i] for i in b) != want:
            a, b = [], []
        spans = []
        for ids, table in ((a, tool.bytes_a), (b, tool.bytes_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own)
        links, j = [], 0
        for x in spans[0]:
            while j < len(spans[1]) and spans[1][j][1] <= x[0]:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < x[1]:
                links.append((x[2], spans[1][k][2]))
                k += 1
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        side = lambda own, low, high: ",".join(str(i) for s, e, i in own if low <= s and e <= high)
        groups = ";".join(
            f"{side(spans[0], low, high)}|{side(spans[1], low, high)}" for low, high in zip([0, *ends], ends, strict=False)
        )
        held.update(set(links))
        docs.append((len(a), len(b), len(ends), links, hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
    best = Counter()
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links), digest)
        for n_a, n_b, n_groups, links, digest in docs
    ]


def texts_of(seed, count):
    rng = random.Random(seed)
    words = ["the", "The", "tokenisation", "über", "naïve", "x1", "42", "日本", "...", "e.g.", "aaa", "aaaa", "🙂", "\n", "\t", "''", "don't", "▁"]
    return [rng.choice([" ", "", "  "]).join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(count)]


@pytest.mark.parametrize("max_frequent", [1 << 19, 40, 0])
def test_equals_plain_version(spark, tool, max_frequent):
    texts = ODD + texts_of(1, 150)
    docs = spark.createDataFrame([(i, t, i, "row") for i, t in enumerate(texts)], "doc_id long, text string, row long, pair string")
    got = alignment.align_tokens(docs.repartition(3), A, B, max_frequent).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == plain(tool, texts) and [r["doc_id"] for r in got] == list(range(len(texts)))


def test_vector_counts_only_identity_pairs(tool):
    made = tool.align(["same text here", "antidisestablishmentarianism 日本語"])
    assert all(tool.same[i] >= 0 for i in made["same"].flatten().to_pylist())
    size = len(tool.bytes_b)
    assert all(tool.same[p // size] != p % size for p in made["pair"].flatten().to_pylist())
    assert tool.bytes_a[tool.a.token_to_id("Ġthe")] == b" the" and tool.bytes_b[tool.b.piece_to_id("<0x0A>")] == b"\n"


def test_texts_are_cut_where_nothing_changes(tool, monkeypatch):
    rng = random.Random(5)
    alphabet = ["a", "B", "é", "1", ".", "日", " ", "\t", "\n", "\x1c", "\u00a0", "\u2028", "'", "🙂", "-"]
    texts = [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(300))) for _ in range(40)]
    as_lists = lambda made: {k: pa.array(v).to_pylist() if isinstance(v, np.ndarray) else v.to_pylist() for k, v in made.items()}
    cut = as_lists(tool.align(texts))
    assert tool.cuts and len(tool.number) > 1000
    monkeypatch.setattr(alignment, "MEMO", 0)  # forgets all parts between slices
    assert as_lists(tool.align(texts)) == cut
    monkeypatch.setattr(tool, "cuts", False)
    assert as_lists(tool.align(texts)) == cut


def test_odd_tables(spark):
    docs = spark.createDataFrame([(None, "one two"), (None, None), (7, "one two"), (7, "one two")], "doc_id long, text string")
    got = alignment.align_tokens(docs, A, B).collect()
    links = sorted((r["doc_id"] or -1, r["n_links"], r["count_sum"]) for r in got)
    assert links == [(-1, 0, 0), (-1, 2, 6), (7, 2, 6), (7, 2, 6)]
    assert alignment.align_tokens(docs.where(F.lit(False)), A, B).collect() == []


def test_threshold_of_frequent_pairs(spark):
    pairs = spark.createDataFrame([(i, n) for i, n in enumerate([1, 1, 1, 2, 3, 4, 9, 1024])], "pair long, n long")
    assert [alignment.frequent_from(pairs, k) for k in (0, 1, 2, 3, 5, 8)] == [1 << 62, 1024, 8, 4, 2, 1]
