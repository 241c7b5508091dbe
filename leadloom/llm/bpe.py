"""Byte-level BPE encoding and decoding with tiktoken and a local rank file."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Longest stretch handed to the library at once. Longer texts are cut first, so its regular
# expressions never meet a stretch that exhausts their stack.
STRETCH = 16_384

_SAFE = re.compile(r"[A-Za-z0-9](?=[ \n])")
# White space as the library's engine sees it.
_SPACE = r"\t-\r \x85\xa0" + "".join(map(chr, [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """Encoding of a rank file (base64 token and rank per line), without special tokens."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _stretches(text: str, size: int) -> Iterator[str]:
    """``text`` in pieces of about ``size``, cut where no match of the pattern can span.

    A letter or digit followed by a space or newline is such a place: only a match of white
    space holds white space past its first character, and none looks behind.
    """
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size - 1)
        if cut is None:
            break
        yield text[start:cut.end()]
        start = cut.end()
    yield text[start:]


def _long_runs(size: int) -> re.Pattern[str]:
    return re.compile(f"[{_SPACE}]{{{size},}}")


def encode_text(enc: tiktoken.Encoding, text: str, size: int = STRETCH) -> list[int]:
    """Token ids of the whole text, as if the library had encoded it in one call.

    Runs of white space longer than ``size`` are one match each: all of it at the end of the
    text, all but its last character before other text.
    """
    if len(text) <= size:
        return enc.encode_ordinary(text)
    ids: list[int] = []

    def plain(part: str) -> None:
        for stretch in _stretches(part, size):
            ids.extend(enc.encode_ordinary(stretch))

    start = 0
    for run in _long_runs(size).finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        plain(text[start:run.start()])
        ids.extend(enc._encode_single_piece(text[run.start():end]))
        start = end
    plain(text[start:])
    return ids


def encode(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    decoded: bool = False, keep: list[str] | None = None,
) -> DataFrame:
    """``id_col, ids array<int>`` of every whole text; with ``decoded`` also the decoded bytes.

    A NULL text counts as empty and has no ids. Rows are independent: repeated ids stay; of the
    other columns only those in ``keep`` stay. No shuffle; the rank file is read once per Python worker.
    """
    kept = [id_col, *(keep or [])]
    types = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    schema = f"{types}, ids array<int>" + (", decoded binary" if decoded else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for part in _slices(batch):
                ids = [encode_text(enc, t or "") for t in part.column(0).to_pylist()]
                out = [*part.columns[1:], pa.array(ids, pa.list_(pa.int32()))]
                names = [*kept, "ids"]
                if decoded:
                    out.append(pa.array([enc.decode_bytes(i) for i in ids], pa.binary()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(out, names)

    return docs.select(F.col(text_col).alias("__text"), *kept).mapInArrow(run, schema)


def decode(
    tokens: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids",
) -> DataFrame:
    """``id_col, decoded binary``: the raw bytes of the ids, which need not be valid text.

    NULL ids decode to no bytes; an id outside the rank file is an error.
    """
    kind = tokens.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for part in _slices(batch):
                raw = [enc.decode_bytes(i or []) for i in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(raw, pa.binary())], [id_col, "decoded"])

    return tokens.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, decoded binary")


def _slices(batch: pa.RecordBatch, rows: int = 200) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, so that ids of one Arrow batch never pile up as Python lists."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Length and SHA-256 of the ids (decimal, joined by a space), and SHA-256 of the bytes."""
    return encoded.select(
        id_col,
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
