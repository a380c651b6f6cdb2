"""Filter audit against a plain run of every order over every document."""

import random
import re
from fractions import Fraction
from itertools import permutations

from pyspark.sql import functions as F

from tripweave.llm import filter_audit as audit

ORDERS = ["".join(p) for p in permutations("ABCDE")]


def plain(docs, labels):
    """(part, order, step) -> counts; docs are (doc_id, text, source)."""
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    told = {}
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and first[text] < i,
        }
        told.setdefault(source or "", []).append(({f for f in failed if failed[f]}, i in good, i in toxic))
    made = {}
    for part, rows in told.items():
        shares = dict.fromkeys("ABCDE", 0)
        for order in ORDERS:
            left = rows
            for step, f in enumerate(order, 1):
                out = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                fails = sum(f in r[0] for r in rows)
                shares[f] += len(out)
                made[part, order, step] = [
                    len(left), len(out), fails - len(out), sum(r[0] == {f} for r in rows), sum(r[1] for r in out), sum(r[2] for r in out),
                ]
        for order in ORDERS:
            for step, f in enumerate(order, 1):
                made[part, order, step].append(shares[f])
    return {k: tuple(v) for k, v in made.items()}


def told(frame):
    names = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    rows = frame.collect()
    made = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(made) == len(rows)
    return made


def test_equals_plain_run(spark):
    rng = random.Random(4)
    texts = [None, "", "ABC", "a b c | d", "w " * 250, " ".join(map(str, range(250))), " ".join(f"W{i}" for i in range(300)), "#" + "x " * 200]
    docs = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "a", "b"])) for _ in range(300)]
    labels = [(rng.choice([None, *range(60)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(60)]
    frame = spark.createDataFrame(
        [(*d, "x", 1, 2) for d in docs], "doc_id long, text string, source string, part string, mask int, first int"
    )
    marks = spark.createDataFrame([(*x, 3) for x in labels], "doc_id long, quality int, toxic int, good int")
    assert told(audit.audit_filters(frame.repartition(3), marks)) == plain(docs, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert audit.audit_filters(docs.where(F.lit(False)), labels).collect() == []
    assert told(audit.audit_filters(docs, labels.where(F.lit(False)))) == plain([(1, "a", "s")], [])


def test_shapley_values_add_up_and_match_the_mean_over_orders():
    rng = random.Random(9)
    counts = [rng.randrange(1000) for _ in range(32)]
    values = audit.coalitions(counts)
    got = audit.shapley(values)
    want = [Fraction(0)] * 5
    for order in permutations(range(5)):
        before = 0
        for i in order:
            want[i] += Fraction(values[before | 1 << i] - values[before], 120)
            before |= 1 << i
    assert got == want and sum(got) == values[-1] == sum(counts[1:])
