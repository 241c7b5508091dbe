"""Toxicity by class-conditional Kneser-Ney models over the letters of words."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.words import mix

# Bounds of the fitted sample: labelled texts per class for the models and for calibration,
# chosen by hash of their id.
MODEL_DOCS, CALIBRATION_DOCS = 4000, 1500
ORDER, DISCOUNT = 5, 0.75
# Probability of a letter of which nothing is known.
LETTER = 1 / 5000
# Words scored at once; a longer text is scored by itself.
TOGETHER = 200_000

_WORD = re.compile(r"\w+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams(word: str, order: int = ORDER) -> list[str]:
    """Letter n-grams of a word with its start and end marked."""
    padded = "\x02" * (order - 1) + word + "\x03"
    return [padded[i:i + order] for i in range(len(padded) - order + 1)]


def _letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)


def _keys(letters: list[np.ndarray]) -> np.ndarray:
    """64-bit keys of n-grams, given their first, second, ... letters."""
    total = np.full(len(letters[0]), len(letters), np.uint64)
    with np.errstate(over="ignore"):
        for column in letters:
            total = mix(total * _STEP + column)
    return total


@dataclass
class Model:
    """Toxic less ordinary log-likelihood of the last letter of every n-gram either class has, as
    two arrays, and the calibration of a text's two features.

    What neither class has seen is no evidence: both fall back to the same shared probability,
    whatever mass they reserve for it, which only tells how large their samples are.
    """

    order: int
    keys: np.ndarray
    ratios: np.ndarray
    weights: tuple[float, float, float] = (0.0, 0.0, 0.0)
    centre: tuple[float, float, float, float] = (0.0, 0.0, 1.0, 1.0)

    def word_ratios(self, words: list[str]) -> np.ndarray:
        """Log-likelihood ratio of each word, the sum over its n-grams."""
        if not words or not len(self.keys):
            return np.zeros(len(words))
        start = "\x02" * (self.order - 1)
        letters = _letters("".join(f"{start}{w}\x03" for w in words))
        count = np.fromiter(map(len, words), np.int64, len(words)) + 1
        first = np.cumsum(count) - count
        # The n-grams of the i-th word start where those before it end, i starts of words later.
        place = np.arange(count.sum()) + np.repeat(np.arange(len(words)) * (self.order - 1), count)
        keys = _keys([letters[place + j] for j in range(self.order)])
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.add.reduceat(np.where(self.keys[at] == keys, self.ratios[at].astype(np.float64), 0.0), first)

    def features(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Of every text the difference of log-likelihoods per letter, and the logarithm of the
        mean likelihood ratio of its words, which few clear words in a long text can carry. Both
        are 0 without words."""
        number: dict[str, int] = {}
        of_word = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        per_letter, of_words = np.zeros(len(texts)), np.zeros(len(texts))
        some = np.flatnonzero(size)
        if len(some):
            n = size[some]
            starts = np.cumsum(n) - n
            value = self.word_ratios(list(number))[of_word]
            length = np.fromiter(map(len, number), np.int64, len(number))[of_word]
            per_letter[some] = np.add.reduceat(value, starts) / (np.add.reduceat(length, starts) + n)
            most = np.maximum.reduceat(value, starts)
            of_words[some] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, n)), starts) / n)
        return per_letter, of_words


def _estimate(names: list[str], counts: np.ndarray, order: int) -> Model:
    """Model from distinct n-grams and how often each class (a column of ``counts``) has them.

    Each class has its own counts of the highest order; what a class has not seen backs off to
    lower orders whose continuation counts both classes share. A rare word thus differs only as
    far as either class has evidence of its own.
    """
    seen = counts.sum(axis=1) > 0
    letters = _letters("".join(names)).reshape(-1, order)[seen].T
    counts = counts[seen]
    if not len(counts):
        return Model(order, np.zeros(0, np.uint64), np.zeros(0, np.float32))
    back = np.full(len(counts), LETTER)
    for n in range(1, order):
        # How many different letters precede the last n letters, in either class.
        longer = letters[:, np.unique(_keys(list(letters[-n - 1:])), return_index=True)[1]][-n - 1:]
        part, one, follow = np.unique(_keys(list(longer[1:])), return_index=True, return_counts=True)
        start = _keys(list(longer[1:-1, one])) if n > 1 else np.zeros(len(one), np.uint64)
        _, group, kinds = np.unique(start, return_inverse=True, return_counts=True)
        total = np.bincount(group, follow)
        at = np.searchsorted(part, _keys(list(letters[-n:])))
        back = (follow[at] - DISCOUNT + DISCOUNT * kinds[group[at]] * back) / total[group[at]]
    _, context = np.unique(_keys(list(letters[:-1])), return_inverse=True)
    p = []
    for own in counts.T:
        total, kinds = np.bincount(context, own)[context], np.bincount(context, own > 0)[context]
        known = (np.maximum(own - DISCOUNT, 0) + DISCOUNT * kinds * back) / np.maximum(total, 1)
        p.append(np.where(total > 0, known, back))
    keys = _keys(list(letters))
    sort = np.argsort(keys)
    return Model(order, keys[sort], np.log(p[1] / p[0])[sort].astype(np.float32))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    design = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(design.shape[1])
    penalty = np.diag([0.0] + [ridge] * x.shape[1])
    loss = lambda b: (weight * (np.logaddexp(0, design @ b) - y * (design @ b))).sum() + b @ penalty @ b / 2
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -500, 500)))
        slope = design.T @ (weight * (p - y)) + penalty @ beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + penalty + 1e-9 * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while loss(beta - size * step) > loss(beta) and size > 1e-6:
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return beta


def _sample(labels: DataFrame, keep: Column, n: int, part: str) -> DataFrame:
    picked = labels.where(keep).orderBy(F.xxhash64(F.col("doc_id")), "doc_id").limit(n)
    return picked.select("doc_id", "toxic", F.lit(part).alias("part"))


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, for_model: Column, id_col: str = "doc_id", text_col: str = "text",
    model_docs: int = MODEL_DOCS, calibration_docs: int = CALIBRATION_DOCS, order: int = ORDER,
) -> Model:
    """Model from labelled rows: ``labels`` has ``doc_id, toxic``, of which ``usable`` ones count.

    Usable rows for which ``for_model`` holds train the two models, the others calibrate the
    score. Of each class at most ``model_docs`` and ``calibration_docs`` labels are used, those
    with the smallest hash of their id, so the ids that pick the texts are bounded and may be
    broadcast. N-grams are counted by Spark (texts in which their word occurs, equal texts once);
    the driver gets the n-grams of those texts, one row each.

    Without labels of one class the ratio is 0 everywhere and the score is the share of toxic
    labels. Labels other than 0 and 1, and labels without a text, are ignored.
    """
    sound = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    sides = [(toxic, part) for toxic in (0, 1) for part in ("model", "calibration")]
    parts = [_sample(sound, (F.col("toxic") == t) & (for_model if p == "model" else ~for_model),
                     model_docs if p == "model" else calibration_docs, p) for t, p in sides]
    picked = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    shares = dict(sound.groupBy("toxic").count().collect())
    prior = shares.get(1, 0) / max(1, sum(shares.values()))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "doc_id")
    texts = texts.groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("key"), "toxic", "part").agg(F.first("text").alias("text"))
    texts = texts.persist()
    try:
        names, counts = _counts(texts, sides, order)
        model = _estimate(names, counts[:, [0, 2]], order)
        if not counts[:, 0].any() or not counts[:, 2].any():
            odds = math.log(max(prior, 1e-9) / max(1 - prior, 1e-9))
            return Model(order, np.zeros(0, np.uint64), np.zeros(0, np.float32), (odds, 0.0, 0.0))
        rows = features(texts.where(F.col("part") == "calibration"), model, ["toxic"]).select("row.*", "per_letter", "of_words").collect()
        if len({r["toxic"] for r in rows}) < 2:  # too few labels to set any aside
            rows = features(texts, model, ["toxic"]).select("row.*", "per_letter", "of_words").collect()
    finally:
        texts.unpersist()
    x = np.array([[r["per_letter"], r["of_words"]] for r in rows])
    y = np.array([float(r["toxic"]) for r in rows])
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    mean, spread = x.mean(0), x.std(0) + 1e-9
    # Calibrated on texts it had not seen; the final counts take those in as well.
    final = _estimate(names, counts[:, [0, 2]] + counts[:, [1, 3]], order)
    final.centre = (*mean.tolist(), *spread.tolist())
    final.weights = tuple(_logistic((x - mean) / spread, y, weight).tolist())
    return final


def _counts(texts: DataFrame, sides: list[tuple[int, str]], order: int) -> tuple[list[str], np.ndarray]:
    """Distinct n-grams, and in how many words of texts of each side they occur."""
    side = F.coalesce(*[F.when((F.col("toxic") == t) & (F.col("part") == p), F.lit(i)) for i, (t, p) in enumerate(sides)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[Counter[str]] = [Counter() for _ in sides]
            for of, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                for word in set(words_of(text)):
                    found[of].update(grams(word, order))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(sides)), [len(f) for f in found]).astype(np.int32)), pa.array([g for f in found for g in f], pa.string()),
                 pa.array([n for f in found for n in f.values()], pa.int64())],
                ["side", "gram", "n"])

    per_batch = texts.select(side.alias("side"), "text").mapInArrow(run, "side int, gram string, n bigint")
    total = per_batch.groupBy("gram").agg(*[
        F.coalesce(F.sum(F.when(F.col("side") == i, F.col("n"))), F.lit(0)).alias(f"n{i}") for i in range(len(sides))]).toArrow()
    counts = np.stack([total.column(f"n{i}").to_numpy() for i in range(len(sides))], axis=1)
    return total.column("gram").to_pylist(), counts


def features(docs: DataFrame, model: Model, keys: list[str], text_col: str = "text") -> DataFrame:
    """``row, per_letter, of_words`` of every whole text; both 0 where there is no word. ``row`` is a
    struct of the columns ``keys``, whatever their names."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    asked = docs.select(F.struct(*[F.col(k) for k in keys]).alias("row"), F.col(text_col).alias("text"))
    kind = T.StructType([asked.schema["row"], T.StructField("per_letter", T.DoubleType()), T.StructField("of_words", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found, held, size = [], [], 0
            for text in batch.column(1):
                held.append(words_of(text.as_py()))
                size += len(held[-1])
                if size >= TOGETHER:
                    found.append(own.features(held))
                    held, size = [], 0
            found.append(own.features(held))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.concatenate([f[i] for f in found])) for i in (0, 1))], ["row", "per_letter", "of_words"])

    return asked.mapInArrow(run, kind)


def score(docs: DataFrame, model: Model, keys: list[str], text_col: str = "text", name: str = "score") -> DataFrame:
    """``keys`` and the score, as column ``name``, of every row; NULL and empty texts score as texts
    without evidence. Keys may have any names but ``name``.

    Only the text decides. Rows are independent, nothing is shuffled; the model sent to the
    executors, 12 bytes an n-gram, is bounded by the sample it was fitted on.
    """
    a, b, c = model.weights
    m1, m2, s1, s2 = model.centre
    z = F.lit(a) + F.lit(b) * (F.col("per_letter") - m1) / s1 + F.lit(c) * (F.col("of_words") - m2) / s2
    return features(docs, model, keys, text_col).select("row.*", (1 / (1 + F.exp(-z))).alias(name))


def fold(doc_id: str | Column) -> Column:
    """crc32 of the id as text, modulo 4: fold 2 is held out from all fitting."""
    return F.crc32((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string").cast("binary")) % 4


def fit_from_labels(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the registered query: folds 0 and 1 train, fold 3 calibrates."""
    return fit(docs, labels, fold("doc_id") != 2, fold("doc_id") != 3)
