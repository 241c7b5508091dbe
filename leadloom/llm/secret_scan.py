"""Secret scan: base patterns, and automata inferred from credentials that score every candidate."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import stored

# Kinds in their order, patterns, least lengths (of group 2 for "assign").
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
LEARNED = "learned"

# A candidate is a run of 8 or more of these characters; the likelihoods tell words from keys.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")

# Bounds of :func:`examples`: values per kind, ordinary tokens, characters of a value.
MAX_VALUES, MAX_ORDINARY, MAX_LENGTH = 1000, 3000, 200
# Scores a task remembers at a time, those of words up to MAX_LENGTH; characters of texts scored together.
MAX_KNOWN, TOGETHER_CHARS = 200_000, 1 << 20
# Characters of tokens, and tokens, that a task counts before it passes the counts on.
HELD_CHARS, HELD_TOKENS = 1 << 24, 300_000
# Times that doubtful tokens are taken out of the ordinary ones; classes of score per unit.
CLEANINGS, SCORE_CLASSES = 3, 1024

_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_HEX_LONG = re.compile("[0-9a-f]{32,}")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind number, value) of the base patterns, by start and kind.

    Substring tests only skip patterns that cannot match.
    """
    found = []
    low = text.lower()
    if any(k in low for k in _KEYS):
        found += [(m.start(), m.end(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    # Runs are maximal, so asking for their least length finds the same matches.
    found += [(m.start(), m.end(), 2, m[0]) for m in _HEX_LONG.finditer(text)]
    return sorted(found)


def candidates(text: str, taken: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """Candidates that touch no base span, left to right."""
    at = 0
    ends = sorted((s, e) for s, e, _, _ in taken)
    reach = []
    for s, e in ends:  # merged, so that one pointer is enough
        if reach and s <= reach[-1][1]:
            reach[-1] = (reach[-1][0], max(e, reach[-1][1]))
        else:
            reach.append((s, e))
    for m in CANDIDATE.finditer(text):
        while at < len(reach) and reach[at][1] <= m.start():
            at += 1
        if at == len(reach) or m.end() <= reach[at][0]:
            yield m.start(), m.end(), m[0]


# --- grammar inference --------------------------------------------------------------------

# Symbol 0 begins and ends a word; the others are the characters of candidates and of base values.
ALPHABET = "+-./0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
SYMBOLS = len(ALPHABET) + 1
STEPS = SYMBOLS ** 3
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, SYMBOLS)


def _steps(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every step of the words, ends included, as a number, and where the steps of each word begin.

    A step is the two symbols before (none yet: 0) and the symbol read.
    """
    symbols = _CODE[np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8)]
    one = np.concatenate(([0], symbols[:-1]))
    two = np.concatenate(([0], one[:-1]))
    starts = np.concatenate(([0], np.flatnonzero(symbols == 0)[:-1] + 1))
    return np.where(one == 0, 0, two * SYMBOLS + one) * SYMBOLS + symbols, starts


def count_steps(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Words with each step, by weight: a step counts once a word, so that no long word outweighs others."""
    if not words:
        return np.zeros(STEPS, np.int64)
    step, starts = _steps(words)
    word = np.repeat(np.arange(len(words)), np.diff(np.append(starts, len(step))))
    packed = np.sort(word * STEPS + step)
    once = packed[np.concatenate(([True], packed[1:] != packed[:-1]))]
    return np.bincount(once % STEPS, weights=weights[once // STEPS], minlength=STEPS).astype(np.int64)


class Automaton(NamedTuple):
    """Probabilistic finite automaton: ``state`` after each two symbols, ``counts[state, next symbol]``."""

    state: np.ndarray
    counts: np.ndarray


def _differ(a: np.ndarray, b: np.ndarray, scale: float) -> np.ndarray:
    """Hoeffding test: some next symbol comes with different frequencies in the states a and b."""
    n, m = a.sum(axis=-1, keepdims=True), b.sum(axis=-1, keepdims=True)
    n1, m1 = np.maximum(n, 1), np.maximum(m, 1)
    apart = np.abs(a / n1 - b / m1) > scale * (1 / np.sqrt(n1) + 1 / np.sqrt(m1))
    return (apart & (n > 0) & (m > 0)).any(axis=-1)


def merge(counts: np.ndarray, confidence: float = 0.05) -> Automaton:
    """Automaton of counted steps.

    Prefix-tree states that end in the same two symbols are one state. It is merged into the state
    of the last symbol alone, and that one into the state of any symbol, unless the Hoeffding test
    tells their next symbols apart. The number of states is bounded by the symbols, not by the words.
    """
    scale = math.sqrt(0.5 * math.log(2 / confidence))
    by_two = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    by_one = by_two.sum(axis=0)
    whole = by_one.sum(axis=0)
    own_two = _differ(by_two, by_one[None], scale)
    rest = (by_two * ~own_two[:, :, None]).sum(axis=0)
    one = np.where(rest.sum(axis=1, keepdims=True) > 0, rest, by_one)
    own_one = _differ(one, whole[None], scale)
    rest = (one * ~own_one[:, None]).sum(axis=0)
    ones = 1 + np.cumsum(own_one) - 1
    state = np.broadcast_to(np.where(own_one, ones, 0), (SYMBOLS, SYMBOLS)).copy()
    state[own_two] = 1 + own_one.sum() + np.arange(own_two.sum())
    base = rest if rest.sum() else whole
    return Automaton(state.ravel(), np.concatenate((base[None], one[own_one], by_two[own_two])))


def infer(words: dict[str, int], confidence: float = 0.05) -> Automaton:
    """Automaton of weighted words, see :func:`merge`."""
    return merge(count_steps(list(words), np.array(list(words.values()), np.int64)), confidence)


@dataclass
class Table:
    """Log-probabilities of an automaton, for scoring: of the steps out of each state."""

    state: np.ndarray
    steps: np.ndarray

    def dense(self) -> np.ndarray:
        return self.steps[self.state].ravel()

    def per_char(self, word: str) -> float:
        return float(self.dense()[_steps([word])[0]].mean())


def table(auto: Automaton, floor: float = 1e-4) -> Table:
    share = auto.counts / np.maximum(auto.counts.sum(axis=1, keepdims=True), 1)
    return Table(auto.state, np.log(np.maximum(share, floor)))


@dataclass
class Model:
    kinds: dict[str, Table]
    ordinary: Table
    cutoff: float
    evidence: float = 0.0

    def scorer(self) -> Callable[[list[str]], np.ndarray]:
        """Of each word the best kind's log-likelihood per character less that of ordinary tokens."""
        kinds, ordinary = [t.dense() for t in self.kinds.values()], self.ordinary.dense()

        def scores(words: list[str]) -> np.ndarray:
            if not words:
                return np.zeros(0)
            step, starts = _steps(words)
            best = np.max([np.add.reduceat(k[step], starts) for k in kinds], axis=0)
            return (best - np.add.reduceat(ordinary[step], starts)) / np.diff(np.append(starts, len(step)))

        return scores

    def passes(self, word: str, score: float) -> bool:
        """Above the cutoff, with enough evidence in all: of tokens drawn from the ordinary model
        no more than ``exp(-evidence)`` have a likelihood ratio above ``exp(evidence)``."""
        return score > self.cutoff and score * (len(word) + 1) > self.evidence


def _rank(value: str, owner: int = 0) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), 7 ^ owner) >> 1


def examples(docs: DataFrame, text_col: str = "text", values: int = MAX_VALUES, ordinary: int = MAX_ORDINARY) -> DataFrame:
    """``kind, value, rank``: sample of distinct values per kind and of occurrences of ordinary tokens,
    to look at; models are fitted on all of them (:func:`fit`).

    Base matches are the labelled credentials. Every text is read; of each kind the values with
    the smallest hashes stay, first per batch, then overall, so the sample depends on the
    contents only. Ordinary tokens are drawn by text and token: one row per text that holds the
    token, so that a token has the weight of its documents, and one found once that of one.
    """
    most = dict.fromkeys(range(3), values) | {3: ordinary}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: dict[int, dict[tuple[str, int], int]] = {k: {} for k in most}

            def add(kind: int, value: str, owner: int = 0) -> None:
                pool = kept[kind]
                if 0 < len(value) <= MAX_LENGTH and (value, owner) not in pool:
                    pool[value, owner] = _rank(value, owner)
                    if len(pool) > 4 * most[kind]:
                        kept[kind] = dict(sorted(pool.items(), key=lambda x: (x[1], x[0]))[:most[kind]])

            for text in batch.column(0).to_pylist():
                if not text:
                    continue
                spans = base_spans(text)
                for _, _, kind, value in spans:
                    add(kind, value)
                owner = _rank(text)
                for value in {v for _, _, v in candidates(text, spans)}:
                    add(3, value, owner)
            rows = [(k, v, r) for k, pool in kept.items() for (v, _), r in sorted(pool.items(), key=lambda x: (x[1], x[0]))[:most[k]]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.int64())], ["kind", "value", "rank"])

    found = stored(docs.select(text_col).mapInArrow(run, "kind int, value string, rank bigint").distinct())
    parts = [found.where(F.col("kind") == k).orderBy("rank", "value").limit(n) for k, n in most.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``kind, value, n, single``: every distinct base value (kinds 0 to 2, as in ``KINDS``) and every
    distinct ordinary candidate (kind 3) of all texts, the number of rows that hold it, and whether all of these have the same text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, str], list[int]] = {}
        size = 0

        def rows() -> pa.RecordBatch:
            keys, sums = list(found), list(found.values())
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.int32()), pa.array([v for _, v in keys], pa.string()),
                 *(pa.array([x[i] for x in sums], pa.int64()) for i in range(3))], ["kind", "value", "n", "low", "high"])

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if not text:
                    continue
                spans = base_spans(text)
                owner = _rank(text)
                for key in {(k, v) for _, _, k, v in spans} | {(3, v) for _, _, v in candidates(text, spans)}:
                    sums = found.get(key)
                    if sums is None:
                        found[key] = [1, owner, owner]
                        size += len(key[1])
                    else:
                        sums[0] += 1
                        if owner < sums[1]:
                            sums[1] = owner
                        elif owner > sums[2]:
                            sums[2] = owner
                # What was counted so far goes on when it gets large; the sums are added up below.
                if size > HELD_CHARS or len(found) > HELD_TOKENS:
                    yield rows()
                    found, size = {}, 0
        yield rows()

    counted = docs.select(text_col).mapInArrow(run, "kind int, value string, n bigint, low bigint, high bigint")
    return counted.groupBy("kind", "value").agg(
        F.sum("n").alias("n"), (F.min("low") == F.max("high")).alias("single"))


def _summed(found: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> np.ndarray:
    """Numbers ``key, n`` of all partitions, added up by key: one row per step and kind, or per class of scores, at most."""
    totals = found.select("kind", "value", "n", "single").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    return np.array([tuple(r) for r in totals.collect()], np.int64).reshape(-1, 2)


def _numbers(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["key", "n"])


def step_counts(found: DataFrame) -> np.ndarray:
    """Steps of each kind of :func:`tokens`: base values count once, ordinary tokens once a row that holds them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, STEPS), np.int64)
        for batch in batches:
            kinds, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            words = batch.column(1).to_pylist()
            for k in range(4):
                at = np.flatnonzero(kinds == k)
                total[k] += count_steps([words[i] for i in at], n[at] if k == 3 else np.ones(len(at), np.int64))
        used = np.flatnonzero(total)
        yield _numbers(used, total.ravel()[used])

    out = np.zeros(4 * STEPS, np.int64)
    sums = _summed(found, run)
    out[sums[:, 0]] = sums[:, 1]
    return out.reshape(4, STEPS)


def _judged(found: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the doubtful ordinary tokens: of one text only, and better explained by a kind; and
    the classes of score of all ordinary tokens with their numbers of rows, in order."""
    far = 2 ** 40

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = model.scorer()
        doubt, classes = np.zeros(STEPS, np.int64), Counter()
        for batch in batches:
            words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            got = scores(words)
            at = np.flatnonzero((got > 0) & batch.column(3).to_numpy(zero_copy_only=False))
            doubt += count_steps([words[i] for i in at], n[at])
            values, inverse = np.unique(np.round(got * SCORE_CLASSES).astype(np.int64), return_inverse=True)
            classes.update(dict(zip(values.tolist(), np.bincount(inverse, weights=n).astype(np.int64).tolist())))
        used = np.flatnonzero(doubt)
        yield _numbers(used, doubt[used])
        yield _numbers(np.array(list(classes), np.int64) + far, np.array(list(classes.values()), np.int64))

    sums = _summed(found.where("kind = 3"), run)
    out = np.zeros(STEPS, np.int64)
    steps = sums[:, 0] < STEPS
    out[sums[steps, 0]] = sums[steps, 1]
    rest = sums[~steps]
    return out, rest[np.argsort(rest[:, 0])] - np.array([far, 0])


def fit(docs: DataFrame, text_col: str = "text", false_rate: float = 0.001) -> Model:
    """Automata of each kind and of ordinary tokens, and the cutoff between them, from all texts.

    Every distinct base value and every ordinary token counts, the latter once a row that holds it. The
    cutoff lies where a normal distribution with the median and the upper quartile of all ordinary
    scores (in classes of 1/1024) would let ``false_rate`` pass, and never below 0. Ordinary tokens may
    hold credentials themselves: they move neither of the two as long as they are fewer than a
    quarter, and those of one text that a kind explains better do not count for the ordinary
    automaton. Kinds without examples have no automaton; without any, nothing is added. The driver
    gets one number per step of three symbols, and per class of scores.
    """
    found = stored(tokens(docs, text_col))
    counts = step_counts(found)
    kinds = {KINDS[k]: table(merge(counts[k])) for k in range(3) if counts[k].any()}
    model = Model(kinds, table(merge(counts[3])), 0.0, -math.log(false_rate))
    if kinds and counts[3].any():
        before = np.zeros(STEPS, np.int64)
        for turn in range(CLEANINGS + 1):
            doubtful, classes = _judged(found, model)
            if turn == CLEANINGS or (doubtful == before).all() or (doubtful == counts[3]).all():
                break
            before = doubtful
            model.ordinary = table(merge(counts[3] - doubtful))
        upto = np.cumsum(classes[:, 1])
        middle, upper = (float(classes[np.searchsorted(upto, upto[-1] * q // 4, "right"), 0]) / SCORE_CLASSES for q in (2, 3))
        normal = NormalDist()
        model.cutoff = max(0.0, middle + (upper - middle) * normal.inv_cdf(1 - false_rate) / normal.inv_cdf(0.75))
    return model


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans array<struct<kind, start, stop, score>>`` of every whole text.

    Base spans always stay, with score NULL; a candidate beside them whose format likelihood
    beats that of ordinary tokens by more than the cutoff and the evidence asked for is added as
    kind ``learned``. Offsets
    count code points, ``stop`` is exclusive; order is start, then kind. NULL and empty texts
    have no spans; repeated rows stay rows. No shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}  # scores of words met before
        scores = model.scorer() if model.kinds else None
        names = (*KINDS, LEARNED)

        def spans_of(texts: list[str | None]) -> list[list[dict]]:
            bases = [base_spans(t) if t else [] for t in texts]
            beside = [list(candidates(t, b)) if t and scores else [] for t, b in zip(texts, bases, strict=True)]
            new = list({v for c in beside for _, _, v in c if v not in known})
            here = dict(zip(new, scores(new).tolist(), strict=True)) if new else {}
            out = []
            for base, cands in zip(bases, beside, strict=True):
                spans = [(s, k, e, None) for s, e, k, _ in base]
                for s, e, value in cands:
                    score = known[value] if value in known else here[value]
                    if model.passes(value, score):
                        spans.append((s, 3, e, score))
                spans.sort(key=lambda x: x[:2])
                out.append([{"kind": names[k], "start": s, "stop": e, "score": v} for s, k, e, v in spans])
            if len(known) + len(here) > MAX_KNOWN:
                known.clear()
            known.update((v, x) for v, x in here.items() if len(v) <= MAX_LENGTH)
            return out

        for batch in batches:
            out, texts, size = [], [], 0
            for text in batch.column(1):
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size > TOGETHER_CHARS:  # scored together
                    out += spans_of(texts)
                    texts, size = [], 0
            out += spans_of(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(span))], [id_col, "spans"])

    schema = f"`{id_col}` {kind}, spans array<struct<kind: string, start: bigint, stop: bigint, score: double>>"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per base kind, digest of the base spans, and all spans as text."""
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] != LEARNED)
    return scanned.select(id_col, *[count(k).alias(f"n_{k}") for k in KINDS],
                          F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
