"""Stupid-backoff language-model scores of documents, from n-gram counts of the whole corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.llm.words import hash_texts, mix

ORDER, BACKOFF = 3, 0.4
# Words a batch of documents and a bucket of n-grams should hold.
BATCH_WORDS, BUCKET_NGRAMS = 1_500_000, 2_000_000


def ngrams(words: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Key of the n-gram ending at each word from the n-th on."""
    with np.errstate(over="ignore"):
        total = np.zeros(max(0, len(words) - n + 1), np.uint64)
        for j in range(n):
            total = mix(total * np.uint64(0x2545F4914F6CDD1D) + words[j:len(words) - n + 1 + j] + np.uint64(n))
    return total >> np.uint64(64 - bits)


def _pack_counts(counts: np.ndarray) -> bytes:
    """One byte per count below 255; larger ones follow in order."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype(np.uint64).tobytes()


def _unpack_counts(raw: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, np.uint64, offset=n).astype(np.int64)
    return counts


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as steps, of 4 bytes where they fit; the first byte says how many."""
    steps = np.diff(keys, prepend=np.uint64(0))
    small = not len(steps) or steps[1:].max(initial=0) < 2 ** 32
    head = keys[:1].tobytes()
    return (b"\x04" if small else b"\x08") + head + steps[1:].astype(np.uint32 if small else np.uint64).tobytes()


def _unpack_keys(raw: bytes) -> np.ndarray:
    first = np.frombuffer(raw, np.uint64, 1, 1)
    steps = np.frombuffer(raw, np.uint32 if raw[0] == 4 else np.uint64, offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate((first, steps)), dtype=np.uint64)


def _batch_tables(words: list[np.ndarray], order: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted n-grams of a batch and their counts, for n from 1 to ``order``."""
    return [np.unique(np.concatenate([ngrams(w, n, bits) for w in words]), return_counts=True) for n in range(1, order + 1)]


def word_total(docs: DataFrame) -> int:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(len((t.as_py() or b"").split()) for t in batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return docs.select("bytes").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """``doc_id, n_words, log_score, mean_log_score`` of every whole text.

    The model is the corpus without the document itself: each word scores the share of its
    longest n-gram's count in its context's count, times ``backoff`` for every shorter step; a
    word nothing else contains counts once. Counts cover all documents; the document's own are
    subtracted, so exact copies still vouch for each other. Words are white-space separated, A-Z
    lower-cased; NULL and empty texts have no words, score 0 and mean NULL. Repeated ids are
    rows of their own.

    Documents are hashed into batches of bounded size. Every batch counts its n-grams and sends
    them to buckets by hash; a bucket adds up each n-gram over all batches and returns the totals
    to the batches that asked, where they are joined to the positions and summed per document.
    So an n-gram travels once per batch, however frequent it is, and no task holds more than one
    batch or bucket. Keys have 20 bits more than the number of words, so that about one in a
    million n-grams shares a key with another.
    """
    own = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("bytes"))
    total = word_total(own)
    batches = max(1, -(-total // BATCH_WORDS))
    buckets = max(1, -(-total * order // BUCKET_NGRAMS))
    bits = min(64, max(40, total.bit_length() + 20))
    keyed = own.select(F.pmod(F.xxhash64("doc_id", "bytes"), F.lit(batches)).alias("batch"), "doc_id", "bytes")

    def bucket_of(keys: np.ndarray) -> np.ndarray:
        # By the leading bits, so that a sorted batch falls into consecutive slices.
        lead = keys >> np.uint64(bits - 32)
        return ((lead * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        batch = int(frame["batch"].iloc[0])
        for n, (keys, counts) in enumerate(_batch_tables(hash_texts(frame["bytes"].tolist()), order, bits), 1):
            bucket = bucket_of(keys)
            cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(keys) else []
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                rows.append((int(bucket[lo]), batch, n, hi - lo, _pack_keys(keys[lo:hi]), _pack_counts(counts[lo:hi])))
        return pd.DataFrame(rows, columns=["bucket", "batch", "n", "size", "keys", "counts"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for n, same in frame.groupby("n"):
            asked = [_unpack_keys(k) for k in same["keys"]]
            counts = [_unpack_counts(c, s) for c, s in zip(same["counts"], same["size"], strict=True)]
            keys, place = np.unique(np.concatenate(asked), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, place, np.concatenate(counts))
            back = np.split(sums[place], np.cumsum(same["size"])[:-1])
            parts.append(pd.DataFrame({"batch": same["batch"].to_numpy(), "n": n, "bucket": same["bucket"].to_numpy(), "size": same["size"].to_numpy(),
                                       "counts": [_pack_counts(b) for b in back]}))
        return pd.concat(parts, ignore_index=True)

    def judge(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        words = hash_texts(frame["bytes"].tolist())
        tables = []
        for n, (keys, _) in enumerate(_batch_tables(words, order, bits), 1):
            same = answers[answers["n"] == n].sort_values("bucket")
            got = [_unpack_counts(c, s) for c, s in zip(same["counts"], same["size"], strict=True)]
            tables.append((keys, np.concatenate(got) if got else np.zeros(0, np.int64)))
        scores = [_document(w, tables, total, order, backoff, bits) for w in words]
        return pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_words": [len(w) for w in words], "log_score": scores})

    asked = keyed.groupBy("batch").applyInPandas(lambda f: ask(f), "bucket bigint, batch bigint, n int, size bigint, keys binary, counts binary")
    answered = asked.groupBy("bucket").applyInPandas(lambda f: answer(f), "batch bigint, n int, bucket bigint, size bigint, counts binary")
    scored = keyed.groupBy("batch").cogroup(answered.groupBy("batch")).applyInPandas(
        lambda f, a: judge(f, a), "doc_id bigint, n_words bigint, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))


def _document(words: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]], total: int, order: int, backoff: float, bits: int) -> float:
    """Sum of the logarithms of a document's word scores."""
    size = len(words)
    if not size:
        return 0.0
    counts = []
    for n in range(1, order + 1):
        keys = ngrams(words, n, bits)
        _, place, own = np.unique(keys, return_inverse=True, return_counts=True)
        known, all_counts = tables[n - 1]
        rest = all_counts[np.searchsorted(known, keys)] - own[place] if len(keys) else np.zeros(0, np.int64)
        counts.append(np.concatenate((np.zeros(size - len(rest), np.int64), rest)))
    others = max(1, total - size)
    out = np.log(np.maximum(counts[0], 1) / others) + (order - 1) * math.log(backoff)
    for n in range(2, order + 1):
        context = np.concatenate(([1], counts[n - 2][:-1]))
        seen = counts[n - 1] > 0
        out[seen] = np.log(counts[n - 1][seen] / context[seen]) + (order - n) * math.log(backoff)
    return float(out.sum())
