"""Language identification by interpolated Kneser-Ney character models.

Learning: tasks count the character n-grams of all words (runs of letters,
lower-cased, with start and end marks) of all training texts; Spark adds the
partial counts up.  The table of distinct n-grams of the highest order holds
all that the lower orders need (Kneser-Ney counts distinct continuations).

Model: per order one sorted array of n-gram hashes with a row of log
probabilities for all languages, and per context one with back-off weights.
A word is scored once per slice of texts, its score is used for all its
occurrences.  The prediction is the language of the lowest cross-entropy per
character; ties go to the smaller name.

Tables above ``max_grams`` rows (or four times as many cells of rows and
languages) are not collected: counts, discounts and back-offs are aggregates of
the table, the probabilities of the distinct n-grams of all texts are joined
order by order, and every slice of texts is brought together with those of its
own n-grams.  The results are those of the collected model up to rounding.

Rejection: a limit lies, per language, between the mean cross-entropy of all
training texts of that prediction (where there is none, of the language's
counted n-grams) and that of random words over the language's characters, at
the share ``tolerance`` of the way; a text above the limit of its language is
rejected, as is a text without letters.

Defined results: null text and text without a letter is ``und`` with score 0
and rejected; rows with null language or text teach nothing; with no training
rows every text is ``und``; repeated rows are scored, and teach, each; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import held_out, map_text, mix, saved, text_steps
from tripweave.llm.words import Words, words_of

ORDER = 4
MAX_GRAMS = 3_000_000
TOLERANCE = 0.6
MEMO = 50_000  # words that a task remembers
BEGIN, FINISH = 2, 3  # code points that mark the edges of a word
UNKNOWN = "und"
_STEP = np.uint64(0x9E3779B97F4A7C15)


def unique_words(words: Words) -> tuple[list[str], np.ndarray]:
    """Distinct words, lower-cased, and for every word the index of its text."""
    _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return [words.text(i).lower() for i in first], which.reshape(-1)


def word_points(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams (rows of code points) of all words, and the index of the first one of each word."""
    edge = chr(BEGIN) * (order - 1)
    joined = "".join(f"{edge}{w}{chr(FINISH)}" for w in words)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + order
    begins = np.cumsum(sizes) - sizes
    if not len(points):
        return np.zeros((0, order), np.uint32), begins
    grams = np.lib.stride_tricks.sliding_window_view(points, order)
    inside = np.ones(len(grams) + order - 1, bool)
    for back in range(1, order):
        inside[begins + sizes - back] = False
    inside = inside[: len(grams)]
    made = sizes - order + 1
    return grams[inside], np.cumsum(made) - made


def gram_keys(grams: np.ndarray) -> np.ndarray:
    """64-bit hash per row of code points."""
    key = np.zeros(len(grams), np.uint64)
    with np.errstate(over="ignore"):
        for column in grams.T:
            key = mix(key * _STEP + column.astype(np.uint64) + np.uint64(1))
    return key


class WordCounts:
    """Distinct words that a task has met, with their counts per language; handed on as counts of n-grams."""

    def __init__(self, order: int):
        self.order = order
        self.empty()

    def empty(self) -> None:
        self.number: dict[str, int] = {}
        self.langs: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}  # (word number, count) of each slice

    def add(self, texts: pa.Array, langs: pa.Array) -> None:
        words = words_of(texts, "letters")
        if not len(words.start):
            return
        names, which = unique_words(words)
        numbers = np.fromiter((self.number.setdefault(n, len(self.number)) for n in names), np.int64, len(names))
        langs = langs.dictionary_encode()
        lang = langs.indices.to_numpy(zero_copy_only=False)[words.owner()]
        pairs, times = np.unique(lang.astype(np.int64) * len(names) + which, return_counts=True)
        for code, name in enumerate(langs.dictionary.to_pylist()):
            mine = pairs // len(names) == code
            self.langs.setdefault(name, []).append((numbers[pairs[mine] % len(names)], times[mine]))

    def grams(self) -> Iterator[pa.RecordBatch]:
        """Counts of the n-grams of all words held; empties itself."""
        grams, first = word_points(list(self.number), self.order)
        made = np.diff(np.append(first, len(grams)))
        distinct, at, which = np.unique(gram_keys(grams), return_index=True, return_inverse=True)
        for name, parts in self.langs.items():
            weight = np.zeros(len(first))
            for numbers, times in parts:
                np.add.at(weight, numbers, times)
            total = np.bincount(which.reshape(-1), np.repeat(weight, made), len(distinct))
            some = np.flatnonzero(total)
            columns = [
                pa.array([name] * len(some), pa.string()),
                pa.array([grams[i].tobytes() for i in at[some]], pa.binary()),
                pa.array(total[some].astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])
        self.empty()


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram (binary code points), n over all of docs (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = WordCounts(order)
        for batch in batches:
            for part in text_steps(batch):
                held.add(part.column("text"), part.column("lang"))
                if len(held.number) > MEMO:
                    yield from held.grams()
        yield from held.grams()

    partial = docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    partial = partial.mapInArrow(run, "lang string, gram binary, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Sorted hash arrays with a column per language."""

    langs: list[str]
    order: int
    keys: list[np.ndarray]  # by n-gram length - 1
    logs: list[np.ndarray]  # log probability of the last character, all languages
    contexts: list[np.ndarray]  # by context length
    backoffs: list[np.ndarray]  # log weight of the next shorter context
    floor: np.ndarray  # log probability of a character never seen
    noise: np.ndarray  # cross-entropy of random words
    own: np.ndarray  # cross-entropy of the n-grams learned
    limits: np.ndarray  # largest cross-entropy that is not rejected

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log probabilities per word and language; number of predicted characters per word."""
        grams, first = word_points(words, self.order)
        total = np.zeros((len(grams), len(self.langs)))
        open_ = np.arange(len(grams))
        for length in range(self.order, 0, -1):
            keys = gram_keys(grams[open_, self.order - length :])
            at, found = _look_up(self.keys[length - 1], keys)
            total[open_[found]] += self.logs[length - 1][at[found]]
            open_ = open_[~found]
            if length > 1:  # leave the context of length - 1 characters
                context = gram_keys(grams[open_, self.order - length : -1])
                at, found = _look_up(self.contexts[length - 1], context)
                total[open_[found]] += self.backoffs[length - 1][at[found]]
        total[open_] += self.floor
        sums = np.add.reduceat(total, first, axis=0) if len(words) else np.zeros((0, len(self.langs)))
        return sums, np.diff(np.append(first, len(grams)))


def _look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def fit(langs: np.ndarray, grams: np.ndarray, counts: np.ndarray, order: int = ORDER) -> Model:
    """Model from the rows (language, n-gram of code points, count) of all highest-order n-grams."""
    names = sorted(set(langs.tolist()))
    keys, logs, contexts, backoffs, tables = [], [], [], [], []
    for length in range(1, order + 1):
        tail = grams[:, order - length :]
        key = gram_keys(tail)
        all_keys, first = np.unique(key, return_index=True)
        all_contexts, of_gram = np.unique(gram_keys(tail[first][:, :-1]), return_inverse=True)
        keys.append(all_keys)
        contexts.append(all_contexts)
        tables.append((np.searchsorted(all_keys, key), of_gram.reshape(-1)))
        logs.append(np.zeros((len(all_keys), len(names))))
        backoffs.append(np.zeros((len(all_contexts), len(names))))
    floor = np.zeros(len(names))
    shorter = [
        np.searchsorted(keys[n - 2], gram_keys(grams[np.unique(gram_keys(grams[:, order - n :]), return_index=True)[1], order - n + 1 :]))
        if n > 1 else None for n in range(1, order + 1)
    ]
    for column, name in enumerate(names):
        mine = langs == name
        below = None
        for length in range(1, order + 1):
            number, of_gram = tables[length - 1]
            size = len(keys[length - 1])
            if length == order:
                c = np.bincount(number[mine], counts[mine], size)
            else:  # distinct characters before the n-gram
                longer = np.unique(gram_keys(grams[mine][:, order - length - 1 :]), return_index=True)[1]
                c = np.bincount(number[mine][longer], minlength=size).astype(float)
            once, twice = np.sum(c == 1), np.sum(c == 2)
            discount = min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5
            held = np.bincount(of_gram, c, len(contexts[length - 1]))
            kinds = np.bincount(of_gram, c > 0, len(contexts[length - 1]))
            free = np.where(held > 0, discount * kinds / np.maximum(held, 1), 1.0)
            if length == 1:
                below = np.full(size, 1.0 / (size + 1))
                floor[column] = np.log(free[0] / (size + 1))
            else:
                below = below[shorter[length - 1]]
            own = np.maximum(c - discount, 0) / np.maximum(held, 1)[of_gram]
            below = own + free[of_gram] * below
            logs[length - 1][:, column] = np.log(below)
            backoffs[length - 1][:, column] = np.log(free)
    none = np.full(len(names), np.inf)
    model = Model(names, order, keys, logs, contexts, backoffs, floor, none.copy(), none.copy(), none)
    random = random_words([np.unique(grams[langs == name][:, -1]) for name in names])
    for column, name in enumerate(names):
        sums, chars = model.score_words(random[column])
        model.noise[column] = -sums[:, column].sum() / chars.sum()
        mine = langs == name
        model.own[column] = -(counts[mine] * logs[-1][tables[-1][0][mine], column]).sum() / counts[mine].sum()
    return model


def random_words(points: list[np.ndarray]) -> list[list[str]]:
    """400 words per language over its sorted code points."""
    random, made = np.random.default_rng(0), []
    for own in points:
        signs = [chr(p) for p in own if p != FINISH]
        made.append(["".join(random.choice(signs, size)) for size in random.integers(3, 11, 400)])
    return made


class WordScores:
    """Scores of the words that a task has met, in sorted hash arrays; a word is scored once while it is remembered."""

    def __init__(self, model):
        self.model = model
        self.empty()

    def empty(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.sums = np.zeros((0, len(self.model.langs)))
        self.chars = np.zeros(0, np.int64)  # predicted characters; 0 for words without a letter

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums and characters of the distinct words of a slice, and for every word the index of its own."""
        hashes, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        at, found = _look_up(self.keys, hashes)
        if not found.all():
            if len(self.keys) > MEMO:
                self.empty()
                found = np.zeros(len(hashes), bool)
            names = [words.text(i).lower() for i in first[~found]]
            letters = np.fromiter((any(map(str.isalpha, w)) for w in names), bool, len(names))
            sums, chars = self.model.score_words(names)
            sums[~letters], chars = 0, np.where(letters, chars, 0)
            keys = np.concatenate([self.keys, hashes[~found]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.sums, self.chars = keys[order], np.concatenate([self.sums, sums])[order], np.concatenate([self.chars, chars])[order]
            at, _ = _look_up(self.keys, hashes)
        return self.sums[at], self.chars[at], which.reshape(-1)


def score_texts(known: WordScores, texts: pa.Array) -> dict:
    """Index of the best language (-1: no letter), cross-entropy per character, share of the best among all."""
    words = words_of(texts, "letters")
    best, entropy, share = np.full(len(texts), -1), np.full(len(texts), np.inf), np.zeros(len(texts))
    if not len(words.start) or not known.model.langs:
        return {"best": best, "entropy": entropy, "share": share}
    sums, chars, which = known.of(words)
    some = np.flatnonzero(words.counts)
    total = np.add.reduceat(sums[which], words.first[some], axis=0)
    size = np.add.reduceat(chars[which], words.first[some])
    some, total, size = some[size > 0], total[size > 0], size[size > 0]
    mean = -total / size[:, None]
    best[some] = mean.argmin(axis=1)
    entropy[some] = mean.min(axis=1)
    # odds at the length of a sentence, so that long texts do not all score 1
    share[some] = 1 / np.exp((mean.min(axis=1)[:, None] - mean) * np.minimum(size, 50)[:, None]).sum(axis=1)
    return {"best": best, "entropy": entropy, "share": share}


def fits(grams: DataFrame, max_grams: int) -> bool:
    """Whether the n-gram table makes a model that one process may hold."""
    found, langs = grams.agg(F.count("*"), F.count_distinct("lang")).first()
    return found <= max_grams and found * langs <= 4 * max_grams


def train(
    docs: DataFrame,
    order: int = ORDER,
    max_grams: int = MAX_GRAMS,
    tolerance: float = TOLERANCE,
    grams: DataFrame | None = None,
) -> Model:
    """Model of all rows of docs (doc_id, text, lang) that fits into one process, with the limits of rejection from all
    of them.  ``grams`` are their n-grams, if they are counted already.  ``identify`` and ``known`` have no bound.
    """
    grams = saved(count_grams(docs, order), "language-grams") if grams is None else grams
    if not fits(grams, max_grams):
        raise ValueError(f"the n-grams are more than max_grams={max_grams}; identify and known learn without a model")
    model = learn(grams, order)
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    scored = predict(usable.select("doc_id", "text"), model).where("n_best >= 0")
    means = dict(scored.groupBy("n_best").agg(F.avg("entropy")).collect())  # one row per language
    model.limits = np.array(rejection_limits(means, model.own, model.noise, tolerance))
    return model


def learn(grams: DataFrame, order: int) -> Model:
    """Model of an n-gram table that fits into one process, without limits of rejection."""
    rows = grams.toArrow()
    points = np.frombuffer(b"".join(rows.column("gram").to_pylist()), np.uint32).reshape(-1, order)
    return fit(np.array(rows.column("lang").to_pylist(), object), points, rows.column("n").to_numpy().astype(float), order)


def rejection_limits(means: dict[int, float], own, noise, tolerance: float) -> list[float]:
    """Limit per language; ``means`` are those of the training texts by predicted language, ``own`` stands in."""
    begin = [means.get(i, mean) for i, mean in enumerate(own)]
    return [float(b + tolerance * max(n - b, 0.0)) for b, n in zip(begin, noise, strict=True)]


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, entropy, rejected, n_best of every row of docs (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_grams
    known: list[WordScores] = []

    def step(batch: pa.RecordBatch) -> dict:
        model = shared.value
        if not known:
            known.append(WordScores(model))
        made = score_texts(known[0], batch.column("text"))
        names = np.array([*model.langs, UNKNOWN], object)
        limits = np.append(model.limits, -np.inf)
        return {
            "doc_id": batch.column("doc_id").cast(pa.int64()),
            "lang_pred": pa.array(names[made["best"]], pa.string()),
            "score": made["share"],
            "entropy": pc.if_else(pa.array(np.isfinite(made["entropy"])), pa.array(made["entropy"]), pa.scalar(None, pa.float64())),
            "rejected": pa.array(made["entropy"] > limits[made["best"]]),
            "n_best": made["best"].astype(np.int32),
        }

    schema = "doc_id long, lang_pred string, score double, entropy double, rejected boolean, n_best int"
    return map_text(docs, ["doc_id", "text"], schema, step)


def score_by_model(docs: DataFrame, model: Model) -> DataFrame:
    """doc (doc_id, lang), n_best, score, entropy of all rows of docs (doc_id, text, lang) with the model in every task, written once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_grams
    known: list[WordScores] = []

    def step(batch: pa.RecordBatch) -> dict:
        if not known:
            known.append(WordScores(shared.value))
        made = score_texts(known[0], batch.column("text"))
        entropy = pa.array(made["entropy"], mask=~np.isfinite(made["entropy"]))
        return {"doc": batch.column("doc"), "n_best": made["best"].astype(np.int32), "score": made["share"], "entropy": entropy}

    rows = docs.select(F.struct("doc_id", "lang").alias("doc"), "text")
    schema = rows.select("doc").schema.add("n_best", "integer").add("score", "double").add("entropy", "double")
    return saved(map_text(rows, ["doc", "text"], schema, step), "language-scored")


def drop_rejected(docs: DataFrame, model: Model) -> DataFrame:
    """Rows of docs (text, ...) that the model does not reject; only the texts leave the rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    known: list[WordScores] = []

    @F.arrow_udf("boolean")
    def accepted(texts: pa.Array) -> pa.Array:
        if not known:
            known.append(WordScores(shared.value))
        limits = np.append(shared.value.limits, -np.inf)
        made = [score_texts(known[0], part.column("text")) for part in text_steps(pa.RecordBatch.from_arrays([texts], names=["text"]))]
        return pa.array(np.concatenate([m["entropy"] <= limits[m["best"]] for m in made]) if made else np.zeros(0, bool))

    return docs.where(accepted(F.col("text")))


def find_limits(scored: DataFrame, own, noise, tolerance: float) -> list[float]:
    """Limit of each language from the scores of the training texts, rows (doc, n_best, entropy)."""
    teaching = scored.where("n_best >= 0 AND doc.lang IS NOT NULL").where(~held_out(F.col("doc")["doc_id"]))
    means = dict(teaching.groupBy("n_best").agg(F.avg("entropy")).collect())  # one row per language
    return rejection_limits(means, own, noise, tolerance)


def with_limits(scored: DataFrame, langs: list[str], own, noise, tolerance: float) -> DataFrame:
    """doc, lang_pred, score, entropy, rejected of scored rows (doc, n_best, score, entropy).

    The limit of a language comes from the mean of the training texts that are
    predicted as that language.
    """
    limits = find_limits(scored, own, noise, tolerance)
    names = F.get(F.array(*map(F.lit, [*langs])).cast("array<string>"), F.col("n_best"))
    beyond = F.col("entropy") > F.get(F.array(*map(F.lit, limits)).cast("array<double>"), F.col("n_best"))
    return scored.select(
        "doc",
        F.when(F.col("n_best") >= 0, names).otherwise(UNKNOWN).alias("lang_pred"),
        "score",
        "entropy",
        ((F.col("n_best") < 0) | beyond).alias("rejected"),
    )


@dataclass
class Looked:
    """The log probabilities of all n-grams of one slice of texts."""

    langs: list[str]
    order: int
    keys: np.ndarray
    logs: np.ndarray

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        grams, first = word_points(words, self.order)
        total = self.logs[np.searchsorted(self.keys, gram_keys(grams))]
        sums = np.add.reduceat(total, first, axis=0) if len(words) else np.zeros((0, len(self.langs)))
        return sums, np.diff(np.append(first, len(grams)))


def _counts(grams: DataFrame, langs: list[str], order: int) -> list[DataFrame]:
    """l (index of the language), gram, c by n-gram length - 1: Kneser-Ney counts of all seen n-grams."""
    number = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1
    counts = [grams.select(number.cast("int").alias("l"), "gram", F.col("n").alias("c"))]
    for _ in range(1, order):  # distinct characters before the n-gram
        shorter = counts[0].groupBy("l", F.expr("substring(gram, 5)").alias("gram")).agg(F.count("*").alias("c"))
        counts.insert(0, saved(shorter, "language-counts"))
    return counts


def _probabilities(counts: list[DataFrame], langs: list[str], wanted: DataFrame) -> DataFrame:
    """gram, p (array by language) of all rows of wanted (gram, distinct).

    A key of these joins has as many rows as there are characters at most.
    """
    order = len(counts)
    asked = [wanted]
    for _ in range(1, order):
        asked.insert(0, saved(asked[0].select(F.expr("substring(gram, 5)").alias("gram")).distinct(), "language-asked"))
    places = F.sequence(F.lit(0), F.lit(len(langs) - 1))
    start = 1.0 / (counts[0].select("gram").distinct().count() + 1)
    below = None
    for length, (seen, rows) in enumerate(zip(counts, asked, strict=True), 1):
        discounts = [0.5] * len(langs)
        ones = seen.groupBy("l").agg(F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice"))
        for r in ones.collect():  # one row per language
            if r["once"]:
                discounts[r["l"]] = min(max(r["once"] / (r["once"] + 2 * r["twice"]), 0.1), 0.95)
        discount = F.element_at(F.array(*map(F.lit, discounts)), F.col("l") + 1)
        context = F.expr(f"substring(gram, 1, {4 * (length - 1)})").alias("context")
        seen = seen.select("l", "gram", "c", context)
        held = seen.groupBy("l", "context").agg(F.sum("c").cast("double").alias("held"), F.count("*").alias("kinds"))
        held = saved(held.withColumn("free", discount * F.col("kinds") / F.col("held")), "language-contexts")
        own = seen.join(held, ["l", "context"]).withColumn("own", F.greatest(F.col("c") - discount, F.lit(0.0)) / F.col("held"))
        # one entry per language meets in a list
        own = own.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("l", "own"))).alias("own"))
        free = held.groupBy("context").agg(F.map_from_entries(F.collect_list(F.struct("l", "free"))).alias("free"))
        rows = rows.select("gram", context, F.expr("substring(gram, 5)").alias("shorter"))
        rows = rows.join(own, "gram", "left").join(free, "context", "left")
        if below is None:
            rows = rows.withColumn("below", F.array_repeat(F.lit(start), len(langs)))
        else:
            rows = rows.join(below.select(F.col("gram").alias("shorter"), F.col("p").alias("below")), "shorter")
        p = F.transform(
            places,
            lambda i: F.coalesce(F.try_element_at("own", i), F.lit(0.0))
            + F.coalesce(F.try_element_at("free", i), F.lit(1.0)) * F.get("below", i),
        )
        below = saved(rows.select("gram", p.alias("p")), "language-probabilities")
    return below


def _in_slices(docs: DataFrame) -> DataFrame:
    """doc (all columns of docs), slice: rows of one slice hold a bounded amount of text, or are one row."""
    schema = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).schema.add("slice", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_steps(batch):
                first = part.column("row")[0].as_py()
                names = pa.array([first] * part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc"), names], names=["doc", "slice"])

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text", F.monotonically_increasing_id().alias("row")
    )
    return saved(rows.mapInArrow(run, schema), "language-slices")


def _slice_grams(sliced: DataFrame, order: int) -> DataFrame:
    """slice, gram: distinct n-grams of the texts of every slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners = batch.column("slice").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(owners)) + 1), len(owners)]
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                words = words_of(batch.column("text").slice(begin, end - begin), "letters")
                grams, _ = word_points(unique_words(words)[0] if len(words.start) else [], order)
                grams = grams[np.unique(gram_keys(grams), return_index=True)[1]]
                names = pa.array(np.full(len(grams), owners[begin], np.int64))
                made = pa.array([g.tobytes() for g in grams], pa.binary())
                yield pa.RecordBatch.from_arrays([names, made], names=["slice", "gram"])

    texts = sliced.select("slice", F.col("doc")["text"].alias("text"))
    return saved(texts.mapInArrow(run, "slice long, gram binary").distinct(), "language-slice-grams")


def judge_by_joins(docs: DataFrame, grams: DataFrame, order: int, tolerance: float) -> DataFrame:
    """doc (all columns), lang_pred, score, entropy, rejected of all rows of docs (doc_id, text, lang) without a collected model.

    ``grams`` are those of all rows outside the held-out fold.
    """
    spark = docs.sparkSession
    langs = sorted(r[0] for r in grams.select("lang").distinct().collect())  # one row per language
    counts = _counts(grams, langs, order)
    points = [[] for _ in langs]
    for r in counts[0].collect():  # the characters of every language
        points[r["l"]].append(int.from_bytes(r["gram"], "little"))
    noise = [
        (column, gram.tobytes())
        for column, words in enumerate(random_words([np.array(sorted(p)) for p in points]))
        for gram in word_points(words, order)[0]
    ]
    noise = saved(spark.createDataFrame(noise, "l int, gram binary").groupBy("l", "gram").agg(F.count("*").alias("c")), "language-noise")
    sliced = _in_slices(docs)
    of_slices = _slice_grams(sliced, order)
    wanted = saved(of_slices.select("gram").union(noise.select("gram")).distinct(), "language-wanted")
    known = _probabilities(counts, langs, wanted)

    def score(key: tuple, texts: pa.Table, mine: pa.Table) -> pa.Table:
        found = mine.column("gram").combine_chunks()
        points = np.frombuffer(b"".join(found.to_pylist()), np.uint32).reshape(-1, order)
        chances = mine.column("p").combine_chunks().flatten().to_numpy().reshape(-1, len(langs))
        keys, first = np.unique(gram_keys(points), return_index=True)
        doc = texts.column("doc").combine_chunks()
        text = doc.field(doc.type.get_field_index("text"))
        made = score_texts(WordScores(Looked(langs, order, keys, np.log(chances[first]))), text)
        entropy = pa.array(made["entropy"], mask=~np.isfinite(made["entropy"]))
        best = pa.array(made["best"].astype(np.int32))
        return pa.table({"doc": doc, "n_best": best, "score": pa.array(made["share"]), "entropy": entropy})

    schema = sliced.select("doc").schema.add("n_best", "integer").add("score", "double").add("entropy", "double")
    mine = of_slices.join(known, "gram").select("slice", "gram", "p")
    scored = sliced.groupBy("slice").cogroup(mine.groupBy("slice")).applyInArrow(score, schema)
    scored = saved(scored, "language-scored")

    def entropies(rows: DataFrame) -> list[float]:
        rows = rows.join(known, "gram").withColumn("log", F.log(F.get("p", F.col("l"))))
        found = dict(rows.groupBy("l").agg(-F.sum(F.col("c") * F.col("log")) / F.sum("c")).collect())  # one row per language
        return [found[i] for i in range(len(langs))]

    return with_limits(scored, langs, entropies(counts[-1]), entropies(noise), tolerance)


def identify(docs: DataFrame, order: int = ORDER, max_grams: int = MAX_GRAMS, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected, entropy of all docs (doc_id, text, lang); learns outside the held-out fold."""
    docs = docs.select("doc_id", "text", "lang")
    grams = saved(count_grams(docs.where(~held_out(F.col("doc_id"))), order), "language-grams")
    if fits(grams, max_grams):
        model = learn(grams, order)
        found = with_limits(score_by_model(docs, model), model.langs, model.own, model.noise, tolerance)
    else:
        found = judge_by_joins(docs, grams, order, tolerance)
    found = found.withColumn("doc_id", F.col("doc")["doc_id"].cast("long"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected", "entropy")


def known(docs: DataFrame, order: int = ORDER, max_grams: int = MAX_GRAMS, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows of docs (doc_id, text, lang, ...) that are not rejected; learns outside the held-out fold."""
    grams = saved(count_grams(docs.where(~held_out(F.col("doc_id"))), order), "language-grams")
    if not fits(grams, max_grams):
        return judge_by_joins(docs, grams, order, tolerance).where("NOT rejected").select("doc.*")
    # Scored twice, since a copy of all documents with their scores would cost more than the words' second look-up.
    model = learn(grams, order)
    scored = score_by_model(docs.select("doc_id", "text", "lang"), model)
    model.limits = np.array(find_limits(scored, model.own, model.noise, tolerance))
    return drop_rejected(docs, model)
