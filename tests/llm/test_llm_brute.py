"""Language ID and quality against plain computations of whole queries and of every split."""

import random
import re
from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest

from tripweave.llm import language, quality


def words_in(text):
    found = re.findall("[A-Za-z\u0080-\U0010ffff]+", text or "")
    return [w.lower() for w in found]


def padded(word, order):
    return chr(language.BEGIN) * (order - 1) + word + chr(language.FINISH)


def plain_models(rows, order):
    """p(language, n-gram) by the definition of interpolated Kneser-Ney, from (lang, text) rows."""
    seen = {lang: Counter() for lang in sorted({lang for lang, _ in rows})}
    for lang, text in rows:
        for word in words_in(text):
            whole = padded(word, order)
            seen[lang].update(whole[i : i + order] for i in range(len(whole) - order + 1))
    letters = {g[-1] for own in seen.values() for g in own}
    tables = {}
    for lang, own in seen.items():
        counts = [dict(own)]
        for _ in range(1, order):  # kinds of characters before the shorter n-gram
            counts.insert(0, Counter(g[1:] for g in counts[0]))
        levels = []
        for c in counts:
            once, twice = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
            d = min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5
            held, kinds = Counter(), Counter()
            for g, v in c.items():
                held[g[:-1]] += v
                kinds[g[:-1]] += 1
            levels.append((c, d, held, kinds))
        tables[lang] = levels

    def p(lang, gram):
        if not gram:
            return 1 / (len(letters) + 1)
        c, d, held, kinds = tables[lang][len(gram) - 1]
        shorter = p(lang, gram[1:])
        if not held[gram[:-1]]:
            return shorter
        return max(c.get(gram, 0) - d, 0) / held[gram[:-1]] + d * kinds[gram[:-1]] / held[gram[:-1]] * shorter

    return p, list(tables)


def texts_of(seed):
    rng = random.Random(seed)
    stems = {"aa": ["the", "and", "ing", "tion", "er"], "bb": ["der", "und", "ung", "lich", "ß"], "cc": ["le", "é", "tion", "eux"]}
    rows = []
    for i in range(90):
        lang = rng.choice([*stems, None])
        own = stems[lang or "aa"]
        text = " ".join("".join(rng.choice(own) for _ in range(rng.randrange(1, 4))).capitalize() for _ in range(rng.randrange(12)))
        rows.append((i, rng.choice([text, text + " 12 !? €", text + " 日本"]), lang))
    return rows + [(90, None, "aa"), (91, "", "bb"), (92, "€€ 12", "bb"), (93, "qqq", None), (94, "THE the", "cc")]


@pytest.mark.parametrize(("seed", "max_grams"), [(1, 10**6), (2, 10**6), (3, 3)])
def test_language_query_equals_plain_models(spark, seed, max_grams):
    rows, order = texts_of(seed), 3
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r["doc_id"]: r for r in language.identify(frame, order=order, max_grams=max_grams).collect()}
    p, langs = plain_models([(lang, text) for i, text, lang in rows if lang and text is not None and not got[i]["held_out"]], order)
    assert len(got) == len(rows) and 5 < sum(r["held_out"] for r in got.values()) < 40
    for i, text, _ in rows:
        words = [w for w in words_in(text) if any(map(str.isalpha, w))]
        if not words:
            assert got[i]["lang_pred"] == "und" and got[i]["rejected"] and got[i]["entropy"] is None
            continue
        grams = [padded(w, order)[k : k + order] for w in words for k in range(len(w) + 1)]
        costs = [-sum(log(p(lang, g)) for g in grams) / len(grams) for lang in langs]
        best = min(range(len(langs)), key=costs.__getitem__)
        assert abs(got[i]["entropy"] - costs[best]) < 1e-9
        assert got[i]["lang_pred"] == langs[best] or abs(costs[langs.index(got[i]["lang_pred"])] - costs[best]) < 1e-9


@pytest.mark.parametrize("seed", range(4))
def test_every_split_is_the_best_of_all(seed):
    """Gain of every feature and bin edge, row by row; leaves hold the Newton step."""
    random_ = np.random.default_rng(seed)
    rows = np.round(random_.random((400, 4)), 1).astype(np.float32)
    labels = (random_.random(400) < np.where(rows[:, 2] > 0.5, 0.8, 0.3)).astype(float)
    bins, rate = 8, 0.2
    trees = quality.fit_trees(rows, labels, trees=1, depth=3, bins=bins, rate=rate)
    p = labels.mean()
    slope, curve = labels - p, np.full(len(labels), p * (1 - p))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])).astype(np.float32) for c in rows.T]
    found = defaultdict(int)

    def gain(members, feature, bound):
        left = members[rows[members, feature] <= bound]
        right = members[rows[members, feature] > bound]
        if min(len(left), len(right)) < quality.LEAF:
            return 0.0
        worth = lambda m: slope[m].sum() ** 2 / (curve[m].sum() + quality.SHRINK)
        return worth(left) + worth(right) - worth(members)

    def check(node, members, depth):
        best = max((gain(members, f, b) for f in range(4) for b in edges[f]), default=0.0)
        if trees.left[node] < 0:
            assert depth == 3 or len(members) < 2 * quality.LEAF or best <= 1e-6
            assert abs(trees.value[node] - rate * slope[members].sum() / (curve[members].sum() + quality.SHRINK)) < 1e-9
            found["leaf"] += 1
            return
        feature, bound = int(trees.feature[node]), trees.bound[node]
        assert abs(gain(members, feature, bound) - best) < 1e-9
        found["split"] += 1
        right = rows[members, feature] > bound
        check(int(trees.left[node]), members[~right], depth + 1)
        check(int(trees.left[node]) + 1, members[right], depth + 1)

    check(int(trees.roots[0]), np.arange(len(rows)), 0)
    assert found["split"] and found["leaf"] == found["split"] + 1
