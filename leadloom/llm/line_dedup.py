"""Line deduplication by an exact set-similarity join with prefix, positional and length filters."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.shared import stored
from leadloom.llm.words import hash_texts, hash_words, mix, similar

# Lines match at Jaccard similarity 4/5 of their word sets.
NUMERATOR, DENOMINATOR = 4, 5
# Slots of the table that ranks words by rarity: a fixed size, counted over all lines.
SLOTS, BLOCK, TOGETHER = 2 ** 22, 2 ** 16, 64
# Words per bucket: few, so that a line already meets about as many buckets as it has prefix words
# and what travels with it no longer grows with their number.
BUCKET_ENTRIES, CHUNK_BYTES, CHUNK_LINES = 1_500_000, 1 << 20, 60_000
# Up to so many lines under one word all pairs are filtered at once; above, first those with the
# earliest line of the group, then what is still open.
DIRECT = 256
# Pairs filtered at once, about.
TRIED = 100_000
BROADCAST_IDS = 1_000_000
PAIRS_PER_SALT = 1000

# Size and document share a number; the document only chooses which pair to try first.
_LOW40, _LOW48 = (np.uint64((1 << n) - 1) for n in (40, 48))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate((np.ones(min(1, len(values)), bool), values[1:] != values[:-1]))]


class Chunk(NamedTuple):
    """Lines with enough words, of one or more documents, as flat arrays.

    ``line`` and ``word``: line and 40-bit hash of every word; ``doc`` and ``number``: place of a
    line's document among the ids of the chunk, and its number in it.
    """

    line: np.ndarray
    word: np.ndarray
    doc: np.ndarray
    number: np.ndarray
    ids: list[tuple]


def _chunk(texts: list[bytes], ids: list[tuple], least: int) -> Iterator[Chunk]:
    whole = b"\n".join(texts)
    hashes, starts = hash_words(whole)
    breaks = np.flatnonzero(np.frombuffer(whole, np.uint8) == 10)
    words = np.diff(np.searchsorted(starts, breaks), prepend=0, append=len(starts))
    enough = words >= least
    chosen = np.flatnonzero(enough)
    offsets = np.cumsum([0] + [t.count(b"\n") + 1 for t in texts])
    doc = np.searchsorted(offsets, chosen, "right") - 1
    number = chosen - offsets[doc]
    word = hashes >> np.uint64(24)
    if least > 1:
        word = word[np.repeat(enough, words)]
    line = np.repeat(np.arange(len(chosen)), words[chosen])
    for lo in range(0, len(chosen), CHUNK_LINES):
        hi = min(lo + CHUNK_LINES, len(chosen))
        at = slice(np.searchsorted(line, lo), np.searchsorted(line, hi))
        yield Chunk(line[at] - lo, word[at], doc[lo:hi], number[lo:hi], ids)


def _chunks(batches: Iterator[pa.RecordBatch], keys: int, least: int) -> Iterator[Chunk]:
    """Lines of ``least`` or more words of all texts; the last column is the text, those before it are kept as ids."""
    texts: list[bytes] = []
    ids: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(keys)]
        for i, text in enumerate(batch.column(keys)):
            text = text.as_py()
            if text:
                texts.append(text)
                ids.append(tuple(c[i] for c in columns))
                size += len(text)
            if size >= CHUNK_BYTES:
                yield from _chunk(texts, ids, least)
                texts, ids, size = [], [], 0
    if texts:
        yield from _chunk(texts, ids, least)


def _nodes(line: np.ndarray, word: np.ndarray, sketches: bool = True) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Digest, size and, if asked, 128-bit parity sketch of every line's set; pairs are distinct, by line.

    Each word flips one bit of the sketch, so sets whose sketches differ in d bits differ in at
    least d words.
    """
    starts = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
    sizes = np.diff(np.append(starts, len(line)))
    with np.errstate(over="ignore"):
        total = np.add.reduceat(mix(word), starts)
        digest = mix(total + sizes.astype(np.uint64) * np.uint64(0x632BE59BD9B4E019)).view(np.int64)
        if not sketches:
            return digest, sizes, []
        bit, low = np.uint64(1) << (word & np.uint64(63)), (word & np.uint64(64)) == 0
        sketch = [np.bitwise_xor.reduceat(np.where(side, bit, np.uint64(0)), starts).view(np.int64) for side in (low, ~low)]
    return digest, sizes, sketch


def lines_of(docs: DataFrame, least: int = 1) -> DataFrame:
    """Every line with enough words and its set: ``doc_id, version, number, node``; and, in rows
    of their own, how many words of such lines fall into the slots of the table that ranks words
    by rarity: ``block, slots, counts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int32)
        names = ["doc_id", "version", "number", "node", "block", "slots", "counts"]
        for chunk in _chunks(batches, 2, least):
            slots = np.sort((chunk.word & np.uint64(SLOTS - 1)).astype(np.uint32))
            ends = np.append(np.flatnonzero(slots[1:] != slots[:-1]), len(slots) - 1)
            total[slots[ends]] += np.diff(ends, prepend=-1).astype(np.int32)
            packed = distinct((chunk.line.astype(np.uint64) << np.uint64(40)) | chunk.word)
            node, _, _ = _nodes(packed >> np.uint64(40), packed & _LOW40, sketches=False)
            at = pa.array(chunk.doc)
            none = [pa.nulls(len(node), t) for t in (pa.int32(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i[0] for i in chunk.ids], pa.int64()).take(at), pa.array([i[1] for i in chunk.ids], pa.int64()).take(at),
                 pa.array(chunk.number.astype(np.int32)), pa.array(node), *none], names)
        rows = []
        for block in range(0, SLOTS, BLOCK):
            used = np.flatnonzero(total[block:block + BLOCK])
            if len(used):
                rows.append((block, used.astype(np.uint16).tobytes(), total[block + used].astype(np.int64).tobytes()))
        none = [pa.nulls(len(rows), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*none, pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2))], names)

    return docs.select("doc_id", "version", "bytes").mapInArrow(
        run, "doc_id bigint, version bigint, number int, node bigint, block int, slots binary, counts binary")


def rarity(counted: DataFrame) -> tuple[np.ndarray, int]:
    """Logarithmic frequency class of every slot of words, and the number of words counted.

    The table has a fixed number of slots and covers all lines; words of a slot share their
    class, which only makes the order coarser. The driver gets one number per slot.
    """
    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(BLOCK, np.int64)
        for slots, counts in zip(frame["slots"], frame["counts"], strict=True):
            total[np.frombuffer(slots, np.uint16)] += np.frombuffer(counts, np.int64)
        used = np.flatnonzero(total)
        return pd.DataFrame({"block": frame["block"].iloc[:1], "slots": [used.astype(np.uint16).tobytes()], "counts": [total[used].tobytes()]})

    kind = "block int, slots binary, counts binary"
    # Every map task has a row per block: so many that a group holds few of them are added at a time.
    rows = -(-counted.count() * BLOCK // SLOTS)
    while rows > TOGETHER:
        rows = -(-rows // TOGETHER)
        counted = stored(counted.groupBy("block", F.pmod(F.xxhash64("slots", "counts"), F.lit(rows))).applyInPandas(lambda f: add(f), kind))
    counts = np.zeros(SLOTS, np.int64)
    for block, slots, values in counted.groupBy("block").applyInPandas(lambda f: add(f), kind).collect():
        counts[block + np.frombuffer(slots, np.uint16).astype(np.int64)] = np.frombuffer(values, np.int64)
    return np.minimum(255, np.floor(8 * np.log2(counts + 1.0))).astype(np.uint8), int(counts.sum())


def _pieces(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """Rows of ``values`` between each two neighbouring cuts as one binary value."""
    raw = np.ascontiguousarray(values)
    width = raw.nbytes // max(1, len(raw))
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * width).astype(np.int32)), pa.py_buffer(raw)])


def prefixes(docs: DataFrame, classes: np.ndarray, buckets: int, least: int = 1) -> DataFrame:
    """The rarest words of every line, packed per bucket.

    Two sets at the threshold share a word among the first ``n - ceil(4n/5) + 1`` of each, in any
    order common to all lines: here by frequency class, then hash.
    """
    sent = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = sent.value
        for chunk in _chunks(batches, 1, least):
            # One number sorts by line, then rarity, then hash, and names the word by its lower 48 bits.
            of_word = (rank[(chunk.word & np.uint64(SLOTS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(40)) | chunk.word
            packed = distinct((chunk.line.astype(np.uint64) << np.uint64(48)) | of_word)
            line = (packed >> np.uint64(48)).astype(np.int64)
            node, sizes, sketch = _nodes(line, packed & _LOW40)
            place = np.arange(len(packed)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            length = sizes - (NUMERATOR * sizes + DENOMINATOR - 1) // DENOMINATOR + 1
            once = np.zeros(len(node), bool)  # equal sets of a chunk sign once
            once[np.unique(node, return_index=True)[1]] = True
            kept = (place < length[line]) & once[line]
            key, line, place = packed[kept] & _LOW48, line[kept], place[kept]
            bucket = (((mix(key) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort((bucket << 17) | line, kind="stable")
            key, line, place, bucket = key[order], line[order], place[order], bucket[order]
            changed = np.concatenate(([True], bucket[1:] != bucket[:-1]))[:len(key)]
            cut = np.append(np.flatnonzero(changed), len(key))
            # Of every line that has words in a bucket, one row there.
            fresh = changed | np.concatenate(([True], line[1:] != line[:-1]))[:len(key)]
            row = np.cumsum(fresh) - 1
            rows = np.append(row[cut[:-1]], fresh.sum())
            at = row - np.repeat(rows[:-1], np.diff(cut))
            doc = np.array([i[0] for i in chunk.ids], np.int64)[chunk.doc] & np.int64(_LOW40)
            about = np.stack([node, (sizes.astype(np.int64) << 40) | doc, *sketch], axis=1)[line[fresh]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[cut[:-1]]), _pieces(key.view(np.uint8).reshape(-1, 8)[:, :6], cut), _pieces(at.astype(np.uint16), cut),
                 _pieces(place.astype(np.uint32), cut), _pieces(about, rows)], ["bucket", "keys", "at", "places", "about"])

    return docs.select("doc_id", "bytes").mapInArrow(run, "bucket bigint, keys binary, at binary, places binary, about binary")


def _may_match(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Length, positional and sketch filter for sets a and b (columns as in ``about``) whose first
    shared word in their order is the i-th of one and the j-th of the other.

    Pairs are tried at every word they share; at the first one nothing before it is shared, so a
    pair the filter rejects everywhere is not similar.
    """
    n, m = a[:, 1] >> 40, b[:, 1] >> 40
    # Least intersection: 4/9 of both sizes, rounded up.
    least = -(-NUMERATOR * (n + m) // (NUMERATOR + DENOMINATOR))
    good = (DENOMINATOR * np.minimum(n, m) >= NUMERATOR * np.maximum(n, m)) & (1 + np.minimum(n - i - 1, m - j - 1) >= least)
    # Unsigned, as numpy counts the bits of absolute values.
    differ = np.bitwise_count((a[:, 2:] ^ b[:, 2:]).view(np.uint64)).sum(axis=1, dtype=np.int64)
    return good & (differ <= n + m - 2 * least)


PAIR, MEMBER, REST = 0, 1, 2
MET = "kind int, a bigint, b bigint, n bigint, place bigint, low bigint, high bigint"


def meet(frame: pd.DataFrame, direct: int = DIRECT) -> pd.DataFrame:
    """Candidates of one bucket: ``kind, a, b, n, place, low, high``.

    PAIR: two sets that share a word of their prefixes and pass the filters, for each set the one
    with the earliest document before its own; REST: the others. MEMBER: set b, of n
    words and with this sketch, holds word a of a group of more than ``direct`` sets at the given
    place.
    """
    parts = []
    for row in frame.itertuples():
        raw = np.frombuffer(row.keys, np.uint8).reshape(-1, 6)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :6] = raw
        about = np.frombuffer(row.about, np.int64).reshape(-1, 4)
        parts.append((wide.view(np.uint64).ravel(), about, np.frombuffer(row.at, np.uint16).astype(np.int64), np.frombuffer(row.places, np.uint32)))
    offsets = np.cumsum([0] + [len(p[1]) for p in parts])
    key, about, place = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3))
    at = np.concatenate([p[2] + o for p, o in zip(parts, offsets, strict=False)])
    del parts
    # Words of one set alone have nothing to meet.
    order = np.argsort(key)
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    # By word, then size, so that what is too long for a set is too long from there on; of equal
    # sets the one of the earliest document stays.
    order = order[np.lexsort((about[at[order], 1], about[at[order], 0], about[at[order], 1] >> 40, key[order]))]
    key, place, about = key[order], place[order].astype(np.int64), about[at[order]]
    node = about[:, 0]
    first = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))[:len(key)]
    key, place, about = key[first], place[first], about[first]
    names = ["kind", "a", "b", "n", "place", "low", "high"]
    out = [pd.DataFrame({c: np.zeros(0, np.int32 if c == "kind" else np.int64) for c in names})]
    if not len(key):
        return out[0]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    group = np.repeat(np.arange(len(starts)), sizes)
    node, size, doc = about[:, 0], about[:, 1] >> 40, about[:, 1] & np.int64(_LOW40)
    lefts, rights = [], []

    def take(x: np.ndarray, y: np.ndarray) -> None:
        good = _may_match(about.take(x, 0), place[x], about.take(y, 0), place[y]) & (node[x] != node[y])
        lefts.append(x[good])
        rights.append(y[good])

    # The intersection, 4/9 of both sizes or more, lies at and after the first shared word: this
    # bounds the size of a set that follows, and by what comes after its own word, of one before.
    fit = ((NUMERATOR + DENOMINATOR) * (size - place)) // NUMERATOR - size
    most = np.minimum(DENOMINATOR * size // NUMERATOR, fit)
    small = sizes[group] <= direct
    own = np.arange(len(key))
    ends = np.searchsorted((group << 24) + size, (group << 24) + most, "right")
    count = np.where(small, np.maximum(ends - own - 1, 0), 0)
    upto = np.cumsum(count)
    cuts = np.searchsorted(upto, np.arange(0, upto[-1] + TRIED, TRIED), "left")
    cuts[-1] = len(key)
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        x = np.repeat(own[lo:hi], count[lo:hi])
        y = np.arange(len(x)) - np.repeat(upto[lo:hi] - count[lo:hi] - (upto[lo - 1] if lo else 0) - own[lo:hi] - 1, count[lo:hi])
        able = size[x] <= fit[y]
        take(x[able], y[able])
    if not small.all():
        many = np.flatnonzero(~small)
        take(np.lexsort((node, doc, group))[starts][group[many]], many)
        out.append(pd.DataFrame({"kind": MEMBER, "a": key[many].view(np.int64), "b": node[many], "n": size[many], "place": place[many],
                                 "low": about[many, 2], "high": about[many, 3]}))
    x, y = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (lefts, rights))
    swap = (doc[x] > doc[y]) | ((doc[x] == doc[y]) & (node[x] > node[y]))
    x, y = np.where(swap, y, x), np.where(swap, x, y)
    pairs = pd.DataFrame({"x": node[x], "y": node[y], "doc": doc[x]}).drop_duplicates(["x", "y"]).sort_values(["y", "doc", "x"])
    kind = np.where(pairs["y"].duplicated(), REST, PAIR)
    out.append(pd.DataFrame({"kind": kind, "a": pairs[["x", "y"]].min(axis=1), "b": pairs[["x", "y"]].max(axis=1), "n": 0, "place": 0, "low": 0, "high": 0}))
    return pd.concat(out, ignore_index=True).astype({"kind": np.int32})


def _verified(pairs: DataFrame, docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """``earlier, later``: pairs whose word sets really are similar, from the text of each set's first line.

    Every set travels once per pair to its ``a``, the set of ``a`` once per thousand pairs, so
    that a task holds two sets at a time however many pairs an ``a`` has. The place of its first
    line goes along, so that the pair is put in order where it is compared.
    """
    pairs = stored(pairs.select("a", "b").distinct())
    crowd = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_PER_SALT).cast("int").alias("salts"))
    sent = pairs.join(crowd, "a").select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("turn"))
    leads = crowd.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("turn"))
    # A set in many pairs is asked for in several rows, each of about a thousand pairs a line.
    asked = sent.groupBy("node").agg(F.ceil(F.count("*") / PAIRS_PER_SALT).cast("int").alias("pieces")).where("pieces > 1")
    spread = sent.unionAll(leads).join(asked, "node", "left").withColumn("piece", F.pmod(
        F.xxhash64("a", "salt"), F.coalesce("pieces", F.lit(1))).cast("int"))
    wanted = spread.join(firsts, "node").groupBy("doc_id", "version", "piece").agg(
        F.collect_list(F.struct("number", "node", "a", "salt", "turn")).alias("wanted")).drop("piece")
    wanted = stored(wanted)
    # Texts are picked by a list of bounded size, or else by a shuffle.
    lists = F.broadcast(wanted) if (wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0) <= BROADCAST_IDS else wanted

    fields = [("node", "bigint"), ("a", "bigint"), ("salt", "int"), ("turn", "int"), ("doc_id", "bigint"), ("version", "bigint"), ("number", "int"), ("features", "binary")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Every line once, with the rows that ask for its set.
        lines: list[bytes] = []
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            sets = pa.array([distinct(h).tobytes() for h in hash_texts(lines)], pa.binary())
            own = list(zip(*rows, strict=True)) or [()] * 8
            arrays = [pa.array(own[k], pa.int32() if kind == "int" else pa.int64()) for k, (_, kind) in enumerate(fields[:-1])]
            return pa.RecordBatch.from_arrays([*arrays, sets.take(pa.array(own[-1], pa.int64()))], [name for name, _ in fields])

        for batch in batches:
            for doc, version, asked, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                split, at = text.as_py().split(b"\n"), {}
                for x in asked:
                    number = x["number"]
                    if number not in at:
                        at[number] = len(lines)
                        lines.append(split[number])
                    rows.append((x["node"], x["a"], x["salt"], x["turn"], doc, version, number, at[number]))
                    size += len(split[number])
                    if size >= CHUNK_BYTES:
                        yield flush()
                        lines.clear()
                        rows.clear()
                        at.clear()
                        size = 0
        yield flush()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, own, first = None, None, None
        for batch in batches:
            found = []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6)]
            for node, a, turn, *place, raw in zip(*columns, batch.column(7), strict=True):
                if turn == 0:
                    lead, own, first = a, np.frombuffer(raw.as_py(), np.uint64), place
                elif lead == a and similar(own, np.frombuffer(raw.as_py(), np.uint64), NUMERATOR, DENOMINATOR):
                    found.append((a, node) if first < place else (node, a))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["earlier", "later"])

    # Rows alike in id and text give the same sets twice, which does no harm.
    sets = docs.join(lists, ["doc_id", "version"]).select("doc_id", "version", "wanted", "bytes").mapInArrow(
        run, ", ".join(f"{name} {kind}" for name, kind in fields))
    return sets.repartition(F.col("a"), F.col("salt")).sortWithinPartitions("a", "salt", "turn").mapInArrow(compare, "earlier bigint, later bigint").distinct()


def _later(pairs: DataFrame, docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """Sets of which an earlier similar set exists, as the pairs tell."""
    return _verified(pairs, docs, firsts).select(F.col("later").alias("node")).distinct()


def repeated_lines(docs: DataFrame, least_words: int = 1) -> DataFrame:
    """``doc_id, version, numbers``: the lines of each document that match an earlier line.

    ``docs`` has ``doc_id, version, bytes``.
    """
    read = stored(lines_of(docs, least_words))
    lines = read.where("block IS NULL").select("doc_id", "version", "number", "node")
    classes, total = rarity(read.where("block IS NOT NULL").select("block", "slots", "counts"))
    firsts = stored(lines.groupBy("node").agg(
        F.min(F.struct("doc_id", "version", "number")).alias("f"), F.count("*").alias("n")).select("node", "f.*", "n"))
    buckets = max(1, -(-total // BUCKET_ENTRIES))
    met = stored(prefixes(docs, classes, buckets, least_words).groupBy("bucket").applyInPandas(lambda frame: meet(frame), MET))
    pairs = stored(met.where(F.col("kind") == PAIR).select("a", "b").distinct())
    later = stored(_later(pairs, docs, firsts))

    # The other pairs, unless both sides are known to repeat an earlier line.
    known = lambda side: later.select(F.col("node").alias(side), F.lit(True).alias(f"known_{side}"))
    rest = met.where(F.col("kind") == REST).select("a", "b").distinct()
    rest = rest.join(known("a"), "a", "left").join(known("b"), "b", "left").where("known_a IS NULL OR known_b IS NULL").select("a", "b")

    # Crowded words: any line against those not yet known to repeat an earlier one.
    member = met.where(F.col("kind") == MEMBER).select(F.col("a").alias("word"), F.col("b").alias("node"), "n", "place", "low", "high")
    if not member.isEmpty():
        still = member.join(later, "node", "left_anti").select(
            "word", F.col("node").alias("y"), F.col("n").alias("m"), F.col("place").alias("j"), F.col("low").alias("l"), F.col("high").alias("h"))
        least = F.ceil((NUMERATOR * (F.col("n") + F.col("m"))) / (NUMERATOR + DENOMINATOR))
        reach = 1 + F.least(F.col("n") - F.col("place") - 1, F.col("m") - F.col("j") - 1)
        fits = (DENOMINATOR * F.least("n", "m") >= NUMERATOR * F.greatest("n", "m")) & (reach >= least) & (
            F.bit_count(F.col("low").bitwiseXOR(F.col("l"))) + F.bit_count(F.col("high").bitwiseXOR(F.col("h"))) <= F.col("n") + F.col("m") - 2 * least)
        open_pairs = member.join(still, "word").where((F.col("node") != F.col("y")) & fits)
        rest = rest.unionAll(open_pairs.select(F.least("node", "y").alias("a"), F.greatest("node", "y").alias("b"))).distinct()
    rest = stored(rest.join(pairs, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        later = stored(later.union(_later(rest, docs, firsts)).distinct())

    # Only sets that occur again or repeat an earlier one lose lines.
    info = firsts.join(later.withColumn("later", F.lit(True)), "node", "left").where("n > 1 OR later")
    info = stored(info.select("node", F.struct("doc_id", "version", "number").alias("first"), F.coalesce("later", F.lit(False)).alias("later")))
    hit = lines.join(info, "node").where(F.col("later") | ~F.struct("doc_id", "version", "number").eqNullSafe(F.col("first")))
    # As many numbers as the document has lines.
    return hit.groupBy("doc_id", "version").agg(F.collect_set("number").alias("numbers"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 1, name: str = "n_removed") -> DataFrame:
    """All columns of ``docs`` with repeated lines taken out of the text, and their number ``name``.

    A line is removed if an earlier line, of the same or another document, has a similar set of
    words (white-space separated, A-Z lower-cased; Jaccard 4/5 or more). Earlier means a smaller
    (id, line number), NULL ids first. Lines of fewer than ``least_words`` words, and those without
    any, are left as they are. NULL texts stay NULL. Rows sharing an id are told apart by their
    text; rows alike in both count as one document and lose the same lines. Nothing else of a text
    changes. A column of ``docs`` called ``name`` is replaced; names starting with ``__`` are
    reserved.
    """
    kept_columns = [c for c in docs.columns if c != name]
    version = F.xxhash64(F.col(text_col))
    # NULL ids take the smallest number, so that joins keep them.
    number = F.coalesce(F.col(id_col).cast("bigint"), F.lit(-2 ** 63))
    own = docs.select(number.alias("doc_id"), version.alias("version"), F.col(text_col).cast("binary").alias("bytes"))
    numbers = repeated_lines(own, max(1, least_words)).select(
        F.col("doc_id").alias("__id"), F.col("version").alias("__version"), F.col("numbers").alias("__numbers"))
    # A partition's numbers are far smaller than its texts, which then need not be sorted.
    numbers = numbers.hint("shuffle_hash")
    wide = docs.select(*kept_columns, version.alias("__v"), number.alias("__i"))
    joined = wide.join(numbers, (F.col("__i") == F.col("__id")) & (F.col("__v") == F.col("__version")), "left")

    def without(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__numbers"))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    lines = F.element_at(F.transform(F.array(F.split(F.col(text_col), "\n", -1)), without), 1)
    text = F.when(F.col("__numbers").isNull(), F.col(text_col)).otherwise(lines)
    return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in kept_columns],
                         F.coalesce(F.when(F.col("__numbers").isNotNull(), F.size("__numbers")), F.lit(0)).alias(name))
