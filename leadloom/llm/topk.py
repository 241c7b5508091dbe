"""Exact top-k inner-product search by columnar branch-and-bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom.llm.shared import stored

# Dimensions added between two rounds of pruning, candidates per block, queries per block.
DIMS, CANDIDATES, QUERIES_PER_BLOCK = 16, 8192, 512

# Below these bounds of all partial sums, doubles and 64-bit numbers hold them exactly.
EXACT_DOUBLE, EXACT_LONG = 2.0 ** 52, 2.0 ** 62

_BLOCK = "block bigint, dims int, ids binary, rows binary, parts binary"


def quantized(vector: str, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as a double; NULL unless all are finite numbers.

    A component whose floor is no 64-bit number raises.
    """
    x = F.col(vector)
    sound = x.isNotNull() & ~F.exists(x, lambda v: F.coalesce(
        F.isnan(v) | (F.abs(v.cast("double")) == float("inf")), F.lit(True)))
    fits = ~F.exists(x, lambda v: F.abs(v.cast("double") * scale) >= 2.0 ** 63)
    held = F.when(fits, F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("bigint")))
    return F.when(sound, F.coalesce(held, F.raise_error(F.lit("a vector component exceeds 64 bits")).cast("array<bigint>")))


def _blocks(rows: int):
    """Vectors of a partition as blocks of ``rows`` in vertical layout: one line per dimension."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flush(frame: pd.DataFrame) -> pd.DataFrame:
            dims = max(map(len, frame["v"]), default=0)
            parts = np.zeros((dims, len(frame)), np.int64)
            for i, v in enumerate(frame["v"]):
                parts[:len(v), i] = v
            ids, numbers = frame["id"].to_numpy(np.int64), frame["row"].to_numpy(np.int64)
            # Any number that spreads blocks will do; the first row's is the same on every rerun.
            return pd.DataFrame({"block": [int(numbers[0])], "dims": [dims], "ids": [ids.tobytes()], "rows": [numbers.tobytes()], "parts": [parts.tobytes()]})

        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            while len(held) >= rows:
                yield flush(held.iloc[:rows])
                held = held.iloc[rows:]
        if held is not None and len(held):
            yield flush(held)

    return run


def _unpack(width: int, ids: bytes, rows: bytes, parts: bytes, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, rows = np.frombuffer(ids, np.int64), np.frombuffer(rows, np.int64)
    parts = np.frombuffer(parts, np.int64).reshape(width, len(ids))
    if width < dims:
        parts = np.vstack([parts, np.zeros((dims - width, len(ids)), np.int64)])
    return ids, rows, parts


def _wide(query: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, parts: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """As ``best_of_block``, in Python's numbers of any size; a score beyond 64 bits raises."""
    scores = query.astype(object) @ parts.astype(object)
    order = sorted(np.flatnonzero(rows != own), key=lambda i: (-scores[i], ids[i]))[:k]
    if any(not -2 ** 63 <= scores[i] < 2 ** 63 for i in order):
        raise OverflowError("an inner product exceeds 64 bits")
    return ids[order], [int(scores[i]) for i in order]


def best_of_block(query: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, parts: np.ndarray, rest: np.ndarray,
                  k: int, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best candidates of one block (ties to the smaller id), without row ``own``.

    ``rest[b]`` holds every candidate's norm over the dimensions from block ``b`` on. After each
    block of dimensions a candidate can still reach its partial score plus the product of both
    remaining norms; those that cannot reach the k-th exact score known so far are compacted
    away. The exact scores come from completing the k candidates that lead after a block.
    """
    alive = np.flatnonzero(rows != own)
    if not len(alive):
        return ids[:0], ids[:0]
    total = len(query)
    partial = np.zeros(len(alive), parts.dtype)
    tail = np.sqrt(np.cumsum((query.astype(np.float64) ** 2)[::-1])[::-1]) if total else np.zeros(0)
    floor = None
    for b, start in enumerate(range(0, total, dims)):
        stop = min(start + dims, total)
        block = parts[start:stop] if len(alive) == parts.shape[1] else parts[start:stop][:, alive]
        partial = partial + query[start:stop] @ block
        if stop == total or len(alive) <= k:
            continue
        lead = np.argpartition(partial, len(partial) - k)[-k:]
        full = partial[lead] + query[stop:] @ parts[stop:][:, alive[lead]]
        floor = full.min() if floor is None else max(floor, full.min())
        # Norms are rounded; a part in 10**9 and one unit more keep the bound safe.
        bound = partial + tail[stop] * rest[b + 1][alive] * (1 + 1e-9) + 1
        keep = bound >= floor
        if not keep.all():
            alive, partial = alive[keep], partial[keep]
    order = np.lexsort((ids[alive], -partial))[:k]
    return ids[alive[order]], partial[order]


def _search(k: int, dims: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                width = max(row.dims, row.q_dims)
                ids, rows, parts = _unpack(row.dims, row.ids, row.rows, row.parts, width)
                query_ids, own, queries = _unpack(row.q_dims, row.q_ids, row.q_rows, row.q_parts, width)
                squares = parts.astype(np.float64) ** 2
                starts = range(0, width, dims)
                tail = np.zeros((len(starts) + 1, len(ids)))
                for b in range(len(starts) - 1, -1, -1):
                    tail[b] = tail[b + 1] + squares[starts[b]:starts[b] + dims].sum(0)
                rest = np.sqrt(tail)
                # No sum of some dimensions exceeds the product of both norms.
                reach = np.sqrt((queries.astype(np.float64) ** 2).sum(0)) * rest[0].max(initial=0)
                doubles = parts.astype(np.float64) if (reach < EXACT_DOUBLE).any() else None
                out = []
                for j in range(len(own)):
                    query = np.ascontiguousarray(queries[:, j])
                    if reach[j] < EXACT_DOUBLE:
                        found, score = best_of_block(query.astype(np.float64), own[j], ids, rows, doubles, rest, k, dims)
                    elif reach[j] < EXACT_LONG:
                        found, score = best_of_block(query, own[j], ids, rows, parts, rest, k, dims)
                    else:
                        found, score = _wide(query, own[j], ids, rows, parts, k)
                    out.append(pd.DataFrame({"query_row": own[j], "query_id": query_ids[j], "vec_id": found, "score": np.asarray(score, np.int64)}))
                yield pd.concat(out, ignore_index=True)

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 1024, dims: int = DIMS, candidates: int = CANDIDATES, queries: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest integer inner products per query row.

    Every row is a candidate for every query but the query itself. Vectors that are NULL or hold
    a NULL or non-finite component take no part, nor do rows without id; shorter vectors count as
    filled up with zeros; an empty table gives no rows. Rows sharing an id are rows of their own:
    each is a candidate, also for the others, and each that is a query has its own ranks, alike
    ones alike ranks. Scores are exact; one that exceeds 64 bits raises.

    Vectors are packed into blocks; blocks of queries and of candidates meet by an equi-join on
    (query block, slice), with query blocks repeated once per slice of the candidate blocks, so
    nothing is broadcast and no task holds more than single blocks. Each meeting passes on k rows
    per query, of which the k best per query stay.
    """
    sound = vectors.select(F.col(id_col).cast("bigint").alias("id"), quantized(vector_col, scale).alias("v"), is_query.alias("q"))
    # Written, so that a row has the same number as a query and as a candidate.
    sound = stored(sound.where(F.col("v").isNotNull() & F.col("id").isNotNull()).withColumn("row", F.monotonically_increasing_id()))
    asked = sound.where("q").select("id", "row", "v")
    # The number of query blocks is fixed before they are made: hash them into that many.
    n_blocks = max(1, -(-asked.count() // queries))
    slices = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pack = lambda df, rows: df.mapInPandas(_blocks(rows), _BLOCK)
    asked = asked.repartition(n_blocks, F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
    q = pack(asked, queries).select(*[F.col(c).alias(f"q_{c}") for c in ("block", "dims", "ids", "rows", "parts")],
                                    F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    c = pack(sound.select("id", "row", "v"), candidates).withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int"))
    # Partitions are small in bytes and long to work on: as many as asked for, none merged.
    met = c.repartition(slices, "slice").join(q.repartition(slices, "slice"), "slice")
    found = met.select("dims", "ids", "rows", "parts", "q_dims", "q_ids", "q_rows", "q_parts").mapInPandas(
        _search(k, dims), "query_row bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
