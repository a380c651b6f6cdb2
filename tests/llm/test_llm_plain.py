"""Parts of the operators against brute force, without Spark where none is needed."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tripweave.llm import contamination, jaccard, language, nearest, quality, substrings, token_counts
from tripweave.llm.words import gram_hashes, words_of

TEXTS = ["a b  c\n", "", None, " x", "é à b 日本", "A\tB\x0bc\x0cd\re", "x" * 1000, "  \u0085"]


def test_words_of_whole_batches():
    words = words_of(pa.array(TEXTS))
    found = [[words.text(j) for j in range(words.first[i], words.first[i + 1])] for i in range(len(TEXTS))]
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in TEXTS]
    words = words_of(pa.array(TEXTS).slice(3), "alnum", lower=True)
    found = [[words.text(j) for j in range(words.first[i], words.first[i + 1])] for i in range(len(TEXTS) - 3)]
    assert found == [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for t in TEXTS[3:]]


def test_hashes_depend_on_the_word_alone():
    a, b = words_of(pa.array(["one two", "three one two"])), words_of(pa.array(["two", "x", "one"]))
    x, y = a.hashes(), b.hashes()
    assert x[0] == x[3] == y[2] and x[1] == x[4] == y[0] and len({*x, *y}) == 4
    assert gram_hashes(x, 2)[0] == gram_hashes(x, 2)[3]


def brute_tokens():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.TokenCounter(token_counts.read_pieces(path)), sentencepiece.SentencePieceProcessor(model_file=path)


def test_token_counts_equal_the_library():
    pytest.importorskip("public_tokenizers")
    counter, library = brute_tokens()
    random.seed(3)
    signs = list("abc the of  ▁\n\t<s></s>éüß日本語😀①　\x00ﬁÀ")
    texts = ["".join(random.choice(signs) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "\n\n", "a" * 5000, "the quick  brown fox", "▁▁x", "word " * 3000]
    assert [counter.count(t) for t in texts] == [len(x) for x in library.encode(texts)]


def test_signatures_meet_whenever_sets_link():
    random.seed(4)
    universe = np.unique(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    for size in [*range(1, 40), 55, 90, 150, 151, 400, 1000, 3000]:
        base = np.sort(np.random.default_rng(size).choice(universe, size, replace=False))
        allowed = size // 10
        for drop in {0, allowed // 2, allowed}:
            other = np.sort(np.delete(base, random.sample(range(size), drop)))
            more = np.union1d(other, universe[: max(allowed - drop, 0)])
            for a, b in ((base, other), (base, more)):
                common = len(np.intersect1d(a, b))
                if 100 * common >= 90 * (len(a) + len(b) - common):
                    assert set(jaccard.signatures(a, 90)) & set(jaccard.signatures(b, 90))


def groups(links, n):
    of = list(range(n))
    for a, b in links:
        x, y = of[a], of[b]
        of = [min(x, y) if g in (x, y) else g for g in of]
    return of


def test_tiles_connect_what_brute_force_connects():
    random.seed(5)
    for _ in range(20):
        base = [set(random.sample(range(1, 10**6), 60)) for _ in range(4)]
        sets = []
        for _ in range(40):
            s = set(random.choice(base))
            for x in random.sample(sorted(s), random.randint(0, 5)):
                s.remove(x)
            sets.append(np.array(sorted(s), np.uint64))
        brute = [
            (i, j)
            for i, j in itertools.combinations(range(40), 2)
            if 100 * len(c := np.intersect1d(sets[i], sets[j])) >= 90 * (len(sets[i]) + len(sets[j]) - len(c))
        ]
        assert groups(jaccard.tile_links(sets, 90), 40) == groups(brute, 40)


def test_bitmaps_never_differ_more_than_the_sets():
    random.seed(6)
    sets = [np.array(sorted(random.sample(range(1, 10**9), random.randint(1, 300))), np.uint64) for _ in range(30)]
    maps = jaccard.parity_bitmaps(sets, 256)
    for i, j in itertools.combinations(range(30), 2):
        assert np.bitwise_count(maps[i] ^ maps[j]).sum() <= len(np.setxor1d(sets[i], sets[j]))


def test_suffix_arrays_find_every_window():
    random.seed(7)
    for _ in range(30):
        vocabulary = np.arange(1, 6, dtype=np.uint64)
        windows = {n: np.unique(np.array([[random.randint(1, 5) for _ in range(n)] for _ in range(6)]), axis=0) for n in (1, 3, 4)}
        pairs = np.unique(np.concatenate([w[:, 0] * 7 + w[:, 1] for n, w in windows.items() if n > 1]))
        known = contamination.Suffixes(vocabulary, pairs, windows[1][:, 0], windows, {}, {}, 4)
        docs = [[random.randint(0, 5) for _ in range(random.randint(0, 40))] for _ in range(5)]
        first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        number = np.array([w for d in docs for w in d], np.int64)
        got = set(zip(*(x.tolist() for x in contamination.shard_matches(known, number, first)), strict=True))
        want = {
            (int(first[d]) + i, n, k)
            for d, doc in enumerate(docs) for n, rows in windows.items() for k, row in enumerate(rows.tolist())
            for i in range(len(doc) - n + 1) if doc[i : i + n] == row
        }
        assert got == want


def test_automata_locate_all_recurring_windows():
    """Passages as they come from one anchor: two words left and right of it, more or less."""
    random.seed(8)
    for _ in range(60):
        middle = [7, 8]
        made = {
            (*(random.randint(1, 2) for _ in range(random.randint(0, 2))), *middle, *(random.randint(1, 2) for _ in range(random.randint(0, 2))))
            for _ in range(12)
        }
        pieces = [np.array(p, np.uint32) for p in sorted(made) if len(p) >= 3]
        least = np.array([random.randint(0, 3) for _ in pieces])
        most = least + np.array([random.randint(0, 1) for _ in pieces])
        passage, begin, end, first = substrings.locate(least, most, [p.tobytes() for p in pieces], 3)
        got = {}
        for i, b, e, f in zip(passage.tolist(), begin.tolist(), end.tolist(), first.tolist(), strict=True):
            for at in range(b, e - 2):
                assert (i, at) not in got
                got[i, at] = f
        want = {}
        for i, p in enumerate(pieces):
            for at in range(len(p) - 2):
                same = [j for j, q in enumerate(pieces) if any((q[k : k + 3] == p[at : at + 3]).all() for k in range(len(q) - 2))]
                if min(least[same]) < max(most[same]):
                    want[i, at] = min(least[same])
        assert got == want


def test_equal_windows_have_equal_anchors():
    random.seed(9)
    shared = [f"s{i}" for i in range(30)]
    texts = [" ".join([*random.choices("abcdef", k=k), *shared, *random.choices("abcdef", k=5)]) for k in range(8)]
    words = words_of(pa.array(texts))
    keys, owner, start, count = substrings.anchors_of(words.hashes(), words.first, 13, 5)
    per = [
        {int(s - words.first[t]) - t + d: int(k) for k, t, s, c in zip(keys, owner, start, count, strict=True) if t == i for d in range(c)}
        for i in range(8)
    ]
    for i in range(1, 8):
        assert all(per[0][at] == per[i][at] for at in range(30 - 12))


def test_language_probabilities_add_up_to_one():
    words = ["ab", "abc", "cab", "ba", "ab", "zebra"]
    grams, _ = language.word_points(words, 4)
    rows, counts = np.unique(grams, axis=0, return_counts=True)
    model = language.fit(np.array(["x"] * len(rows), object), rows, counts.astype(float), 4)
    signs = [chr(p) for p in sorted({int(p) for p in grams[:, -1]})]
    for context in ("", "a", "ab", "zeb", "q"):
        logs = []
        for sign in [s for s in signs if ord(s) != language.FINISH] + ["一"]:
            longer, _ = model.score_words([context + sign])
            sums = longer[0, 0]
            # the end of the longer word is taken off again
            points, _ = language.word_points([context + sign], 4)
            logs.append(sums - last_log(model, points[-1]))
        shorter, _ = model.score_words([context])
        points, _ = language.word_points([context], 4)
        begun = shorter[0, 0] - last_log(model, points[-1])
        total = np.exp(np.array(logs) - begun).sum() + np.exp(last_log(model, points[-1]))
        assert abs(total - 1) < 1e-9


def last_log(model, gram):
    """Log probability of the last character of one n-gram."""
    total, row = 0.0, gram[None, :]
    for length in range(model.order, 0, -1):
        at, found = language._look_up(model.keys[length - 1], language.gram_keys(row[:, model.order - length :]))
        if found[0]:
            return total + model.logs[length - 1][at[0], 0]
        if length > 1:
            at, found = language._look_up(model.contexts[length - 1], language.gram_keys(row[:, model.order - length : -1]))
            total += model.backoffs[length - 1][at[0], 0] if found[0] else 0.0
    return total + model.floor[0]


def test_trees_learn_a_rule_and_walk_like_single_nodes():
    random_ = np.random.default_rng(2)
    rows = random_.random((2000, 5)).astype(np.float32)
    labels = ((rows[:, 1] > 0.3) & (rows[:, 3] < 0.8)).astype(float)
    trees = quality.fit_trees(rows, labels, trees=30)
    assert ((trees.score(rows) > 0.5) == labels).mean() > 0.98

    def walk(row):
        margin = trees.base
        for node in trees.roots:
            while trees.left[node] >= 0:
                node = trees.left[node] + (row[trees.feature[node]] > trees.bound[node])
            margin += trees.value[node]
        return 1 / (1 + np.exp(-margin))

    assert np.allclose(trees.score(rows[:50]), [walk(r) for r in rows[:50]])


def test_statistics_of_odd_texts():
    found = quality.text_statistics(pa.array(["", None, "A!! B!!\nA!! B!!\n", "x" * 10000]))
    assert found.shape == (4, quality.WIDTH) and np.isfinite(found).all() and (found[0] == found[1]).all()


def test_tree_opens_every_leaf_once_best_first():
    random_ = np.random.default_rng(3)
    points = random_.normal(size=(2000, 8))
    tree = nearest.fit_tree(points, 40)
    query = points[0]
    order = list(tree.best_bins(tree.centres @ query))
    assert sorted(order) == list(range(tree.leaves)) and tree.leaves == 40
    assert len(np.unique(tree.place(points))) == 40


def test_digest_of_nothing_is_that_of_the_empty_string():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
