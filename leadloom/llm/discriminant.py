"""Quality by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import stored

SYMBOLS = "#*$%&|<>"
# Share of the pooled variances in each class covariance, and the least variance of a statistic.
SHRINKAGE, FLOOR = 0.1, 1e-6
STATISTICS = (
    "words", "letters_a_word", "symbols", "marks", "punctuation", "capitals", "shouted", "digits", "others",
    "repeats", "words_a_kind", "most_frequent", "lone", "lines", "same_lines", "words_a_line",
)


def _char_counts(text: Column) -> list[Column]:
    """Counts of single characters, taken by built-in functions."""
    without = lambda chars: F.char_length(text) - F.char_length(F.translate(text, chars, ""))
    kept = lambda pattern: F.char_length(F.regexp_replace(text, pattern, ""))
    return [without(SYMBOLS), without("!?"), without(".,;:"), kept(r"\P{Lu}+"), without("0123456789"), kept(r"\P{L}+")]


def _word_counts(text: str | None) -> tuple[int, ...]:
    words = text.split() if text else []
    if not words:
        return (0,) * 9
    kinds = Counter(words)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    shouted = sum(n for w, n in kinds.items() if len(w) > 1 and w.isupper())
    lone = sum(n for w, n in kinds.items() if not any(map(str.isalnum, w)))
    repeats = sum(map(str.__eq__, words, words[1:]))
    return (len(words), sum(map(len, words)), shouted, repeats, len(kinds), max(kinds.values()), lone, len(lines), len(set(lines)))


def transformed(counts: np.ndarray) -> np.ndarray:
    """Statistics of texts from their counts, a row per text: logarithms of sizes, arcsines of shares."""
    symbols, marks, punctuation, capitals, digits, letters, n, chars, shouted, repeats, kinds, most, lone, lines, distinct = counts.T.astype(np.float64)
    share = lambda k, of: np.arcsin(np.sqrt(np.clip(k / np.maximum(of, 1), 0, 1)))
    each = lambda a, b: np.log1p(a / np.maximum(b, 1))
    return np.column_stack([
        np.log1p(n), each(chars, n), share(symbols, chars), share(marks, chars), share(punctuation, chars), share(capitals, chars),
        share(shouted, n), share(digits, chars), share(chars - letters, chars), share(repeats, n), each(n, kinds), share(most, n),
        share(lone, n), np.log1p(lines), share(lines - distinct, lines), each(n, lines)])


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, x``: the statistics of every whole text; NULL counts as empty. No shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.array(*_char_counts(text)).alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            chars = np.array(batch.column(2).flatten()).reshape(batch.num_rows, -1)
            words = np.array([_word_counts(t) for t in batch.column(1).to_pylist()], np.int64)
            x = transformed(np.hstack([chars, words]))
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], ["doc_id", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, x array<double>")


@dataclass
class Model:
    """Mean, inverse Cholesky factor and log-weight of each class; ``None`` where a class is missing."""

    classes: list[tuple[np.ndarray, np.ndarray, float]] | None
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1: the logistic of the log-density difference per statistic.

        A class's log-density is half the squared Mahalanobis distance below its weight. The
        statistics are not independent, so the whole difference would be far too sure.
        """
        if self.classes is None:
            return np.full(len(x), self.prior)
        density = [weight - 0.5 * (((x - mean) @ factor.T) ** 2).sum(1) for mean, factor, weight in self.classes]
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / x.shape[1], -500, 500)))


def moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Number, sum and sum of products of ``x`` for each ``y`` of 0 and 1, over all rows.

    Each partition gives its own sums, which Spark adds up by class and place; the driver gets one
    number per class and entry, whatever the number of rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            y = np.array(batch.column(0))
            x = np.array(batch.column(1).flatten()).reshape(len(y), -1)
            x = np.hstack([np.ones((len(y), 1)), x])
            for k in np.unique(y):
                own[k] = own.get(k, 0.0) + x[y == k].T @ x[y == k]
        for k, sums in own.items():
            at = pa.array(range(sums.size), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([int(k)] * sums.size, pa.int32()), at, pa.array(sums.ravel())], ["y", "at", "v"])

    sums = labelled.select(F.col("y").cast("int").alias("y"), "x").mapInArrow(run, "y int, at int, v double")
    out: dict[int, np.ndarray] = {}
    d = len(STATISTICS) + 1
    for r in sums.groupBy("y", "at").agg(F.sum("v").alias("v")).collect():  # two classes times d * d entries
        out.setdefault(r["y"], np.zeros(d * d))[r["at"]] = r["v"]
    full = {k: v.reshape(d, d) for k, v in out.items()}
    return {k: (m[0, 0], m[0, 1:], m[1:, 1:]) for k, m in full.items()}


def fit(labelled: DataFrame, shrinkage: float = SHRINKAGE) -> Model:
    """Model from ``y, x``: all labelled rows count, none is sampled.

    Each covariance is drawn towards the variances of both classes together, which keeps it sound
    where a class hardly varies or has few rows. If a class is missing, every score is the share
    of label 1 (a half without labels).
    """
    found = moments(labelled)
    total = sum(n for n, _, _ in found.values())
    prior = found[1][0] / total if 1 in found else (0.0 if total else 0.5)
    if set(found) != {0, 1}:
        return Model(None, prior)
    cov = lambda n, s, p: (p - np.outer(s, s) / n) / n
    pooled = np.diag(cov(*[sum(v) for v in zip(*found.values(), strict=True)]))
    classes = []
    for k in (0, 1):
        n, s, p = found[k]
        shrunk = (1 - shrinkage) * cov(n, s, p) + np.diag(shrinkage * pooled + FLOOR)
        lower = np.linalg.cholesky(shrunk)
        weight = np.log(n / total) - np.log(np.diag(lower)).sum()
        classes.append((s / n, np.linalg.inv(lower), float(weight)))
    return Model(classes, prior)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` from ``doc_id, x``; the factors are computed once and sent along."""
    sent = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).flatten()).reshape(batch.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.scores(x))], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5: fold 0 is held out from fitting. NULL ids are in no fold."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def judge(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> DataFrame:
    """``doc_id, held_out, score`` of every row; only the text decides a score.

    ``labels``: ``doc_id, quality``; values other than 0 and 1, labels without an id and labels
    without a document are ignored, a repeated label counts once, contradicting ones both count. Texts are read once: their
    statistics are stored, joined to the labels by id, and scored. Repeated ids are scored row by
    row; empty and NULL texts get the score of empty statistics; further columns play no part.
    """
    stats = stored(statistics(docs))
    sound = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (fold() != 0)).distinct()
    model = fit(stats.join(sound, "doc_id").select("y", "x"), shrinkage)
    held_out = F.coalesce(fold() == 0, F.lit(False))
    return score(stats, model).select("doc_id", held_out.alias("held_out"), "score")
