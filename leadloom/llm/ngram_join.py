"""Jaccard self-join of word shingle sets by PartEnum signatures, and its components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom.llm.components import components
from leadloom.llm.shared import stored
from leadloom.llm.words import hash_texts, hash_words, mix, pack_set, shingles, similar, unpack_set

SHINGLE = 5
# Threshold 3/4 as integers: sets link when 4 * intersection >= 3 * union.
NUMERATOR, DENOMINATOR = 3, 4
# Signatures that should meet in one bucket, and entries packed before they are passed on.
BUCKET_ENTRIES, FLUSH = 3_500_000, 1_000_000
# Groups of more sets than this are hot: sets that can spare them leave them out.
HOT = 16
# Ids that may be broadcast to pick texts; beyond that the texts are joined by shuffle.
BROADCAST_IDS = 1_000_000
PAIRS_PER_SALT = 1000
# Groups just before its own that a member of a crowded group knows of.
EARLIER = 16
NO_ID = 2 ** 63 - 1


# --- signatures -----------------------------------------------------------------------------


def schemes(size: int) -> list[int]:
    """Size bands in which a set signs: its own, [2**i, 2**(i+1)), and the one below if a set of
    that band can be similar to it."""
    own = size.bit_length() - 1
    below = own > 0 and NUMERATOR * size <= DENOMINATOR * (2 ** own - 1)
    return [own, own - 1] if below else [own]


def partitions(scheme: int) -> int:
    """Parts of the feature domain: about 2.4 features of the largest set in each."""
    return -(-(2 ** (scheme + 1)) * 5 // 9) + 6


def signatures(features: np.ndarray, scheme: int) -> tuple[np.ndarray, int]:
    """Signatures of a set (sorted hashes) in a band, and the number of its non-empty parts.

    Sets a, b at the threshold differ in at most (|a| + |b|) / 7 elements, so in no more than a
    third of the smaller and the larger. Each element falls into one part, so they agree in all
    but that many parts: every part, with what the set holds of it, is one signature. A part
    both leave empty is agreement too, but says nothing: a set with more non-empty parts than
    ``limit = |a| // 3`` agrees with each similar set in a non-empty one and signs only those;
    otherwise it signs all. By the same count it may leave out ``non-empty - limit - 1`` more,
    provided the other set leaves out the same ones; and two sets must share as many signatures
    as either has non-empty parts, less (|a| + |b|) // 7.
    """
    parts = partitions(scheme)
    limit = len(features) // 3
    # Hashes are sorted, so the part, a scaling of the hash, is too.
    part = ((features >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(mix(features ^ np.uint64(0x5DEECE66D)), starts)
        filled = part[starts]
        if len(starts) <= limit:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), filled)
            filled = np.concatenate((filled, empty))
            sums = np.concatenate((sums, np.zeros(len(empty), np.uint64)))
        keys = mix(sums + mix(filled + np.uint64(scheme + 1) * np.uint64(1 << 40)))
    return keys, len(starts)


def _sets(batch: pa.RecordBatch, column: int, size: int) -> Iterator[np.ndarray]:
    for start in range(0, batch.num_rows, 200):
        for hashes in hash_texts(batch.column(column).slice(start, 200).to_pylist()):
            yield shingles(hashes, size)


def node_of(features: np.ndarray) -> int:
    """Signed 64-bit digest of a set; 0 only for the empty one."""
    if not len(features):
        return 0
    return xxhash.xxh64_intdigest(features.tobytes() + len(features).to_bytes(8, "little")) - 2 ** 63 or 1


def profiles(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, node, sketch``: size, digest and parity sketch of every text's set.

    Each element flips one of the sketch's 1,024 bits, so sets differ in at least as many elements
    as their sketches in bits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, sketches = [], [], []
            for features in _sets(batch, 1, shingle):
                sizes.append(len(features))
                nodes.append(node_of(features))
                odd = np.bincount((features & np.uint64(1023)).astype(np.int64), minlength=1024) & 1
                sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "node", "sketch"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        run, "doc_id bigint, n_shingles bigint, node bigint, sketch array<bigint>")


def packed_signatures(docs: DataFrame, buckets: int, shingle: int = SHINGLE) -> DataFrame:
    """Signatures of all sets, packed per bucket: 48 bits of each key and a number into the list
    of (node, scheme, size, non-empty parts). Equal sets of a pack sign once."""
    def pack(keys: list[np.ndarray], owners: list[tuple[int, int, int, int]]) -> pd.DataFrame:
        at = np.repeat(np.arange(len(owners), dtype=np.uint16), [len(k) for k in keys])
        key = np.concatenate(keys)
        bucket = (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        key, at, bucket = key[order], at[order], bucket[order]
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        node = np.array([o[0] for o in owners], np.int64)
        # The scheme follows from the size, but for one bit.
        rest = np.array([(size << 1 | (size.bit_length() - 1 != scheme), filled) for _, scheme, size, filled in owners], np.int32)
        rows = []
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            used, place = np.unique(at[lo:hi], return_inverse=True)
            raw = key[lo:hi].view(np.uint8).reshape(-1, 8)[:, :6]
            rows.append((int(bucket[lo]), raw.tobytes(), place.astype(np.uint16).tobytes(), node[used].tobytes(), rest[used].tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "keys", "at", "nodes", "rest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        owners: list[tuple[int, int, int, int]] = []
        seen: set[int] = set()
        held = 0
        for batch in batches:
            for features in _sets(batch, 0, shingle):
                node = node_of(features)
                if node == 0 or node in seen:
                    continue
                seen.add(node)
                for scheme in schemes(len(features)):
                    own, filled = signatures(features, scheme)
                    keys.append(own)
                    owners.append((node, scheme, len(features), filled))
                    held += len(own)
                if held >= FLUSH or len(owners) > 60_000:
                    yield pa.RecordBatch.from_pandas(pack(keys, owners), preserve_index=False)
                    keys, owners, held = [], [], 0
                    seen.clear()
        if keys:
            yield pa.RecordBatch.from_pandas(pack(keys, owners), preserve_index=False)

    return docs.select(F.col("text").cast("binary")).mapInArrow(run, "bucket bigint, keys binary, at binary, nodes binary, rest binary")


PAIR, MEMBER, HEAT = 0, 1, 2
MET = "kind int, a bigint, b bigint, scheme int, n bigint, need bigint, size bigint, crowd bigint"


def _needed(size_a, filled_a, size_b, filled_b):
    """Signatures that two similar sets share at least."""
    return np.maximum(filled_a, filled_b) - (size_a + size_b) // 7


def meet(frame: pd.DataFrame, hot: int = HOT) -> pd.DataFrame:
    """What the signatures of one bucket say: ``kind, a, b, scheme, n, need, size, crowd``.

    PAIR: sets a < b of fitting sizes share n signatures, in groups of at most ``hot`` sets, and
    need that many in all. MEMBER: set b, of so many elements (``size``) and non-empty parts
    (``need``), is in n larger groups with the same members, ``crowd`` in number, together named
    a. HEAT: set a is in n larger groups and could spare b.
    """
    keys, nodes, rest = [], [], []
    for row in frame.itertuples():
        raw = np.frombuffer(row.keys, np.uint8).reshape(-1, 6)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :6] = raw
        at = np.frombuffer(row.at, np.uint16)
        keys.append(wide.view(np.uint64).ravel())
        nodes.append(np.frombuffer(row.nodes, np.int64)[at])
        rest.append(np.frombuffer(row.rest, np.int32).reshape(-1, 2)[at])
    key, node, rest = np.concatenate(keys), np.concatenate(nodes), np.concatenate(rest)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    same = sorted_key[1:] == sorted_key[:-1]
    order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]
    order = order[np.lexsort((node[order], key[order]))]
    key, node, rest = key[order], node[order], rest[order].astype(np.int64)
    first = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))[:len(key)]
    key, node, rest = key[first], node[first], rest[first]
    names = ["kind", "a", "b", "scheme", "n", "need", "size", "crowd"]
    out = [pd.DataFrame({c: np.zeros(0, np.int32 if c in ("kind", "scheme") else np.int64) for c in names})]
    if not len(key):
        return out[0]
    size, filled = rest[:, 0] >> 1, rest[:, 1]
    scheme = np.frexp(size)[1].astype(np.int64) - 1 - (rest[:, 0] & 1)
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    group = np.repeat(np.arange(len(starts)), sizes)
    many = sizes[group] > hot
    found = []
    for d in range(1, min(hot, len(key))):
        x = np.flatnonzero((group[:-d] == group[d:]) & ~many[:-d])
        if not len(x):
            break
        y = x + d
        fits = DENOMINATOR * np.minimum(size[x], size[y]) >= NUMERATOR * np.maximum(size[x], size[y])
        x, y = x[fits], y[fits]
        found.append((node[x], node[y], scheme[x], _needed(size[x], filled[x], size[y], filled[y])))
    if found:
        pairs = pd.DataFrame(dict(zip(("a", "b", "scheme", "need"), map(np.concatenate, zip(*found, strict=True)), strict=True)))
        pairs = pairs.groupby(["a", "b", "scheme", "need"], sort=False).size().reset_index(name="n")
        out.append(pairs.assign(kind=PAIR, size=0, crowd=0)[names])
    if many.any():
        with np.errstate(over="ignore"):
            whole = np.add.reduceat(mix(node.view(np.uint64)), starts) + scheme[starts].astype(np.uint64)
        _, kept, times = np.unique(whole, return_index=True, return_counts=True)
        number = np.zeros(len(starts), np.int64)
        number[kept] = times
        chosen = many & (number[group] > 0)
        out.append(pd.DataFrame({"kind": MEMBER, "a": whole.view(np.int64)[group][chosen], "b": node[chosen], "scheme": scheme[chosen],
                                 "n": number[group][chosen], "need": filled[chosen], "size": size[chosen], "crowd": sizes[group][chosen]}))
        heat = pd.DataFrame({"a": node[many], "b": (filled - size // 3 - 1)[many], "scheme": scheme[many]})
        heat = heat.groupby(["a", "b", "scheme"], sort=False).size().reset_index(name="n")
        out.append(heat.assign(kind=HEAT, need=0, size=0, crowd=0)[names])
    return pd.concat(out, ignore_index=True).astype({"kind": np.int32, "scheme": np.int32})


# --- verification -----------------------------------------------------------------------------


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The pairs ``a, b`` of nodes whose sets really are similar, from their texts.

    Every set travels once per pair to its ``a``, and the set of ``a`` once per thousand pairs:
    many pairs with one ``a`` are dealt out under a salt. A task sees the set of ``a`` first and
    then one ``b`` after the other, so it holds two sets at a time.
    """
    pairs = stored(pairs.select("a", "b"))
    crowd = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_PER_SALT).cast("int").alias("salts"))
    sent = pairs.join(crowd, "a").select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("turn"))
    leads = crowd.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("turn"))
    wanted = stored(sent.unionAll(leads).join(classes, "node").select("doc_id", "node", "a", "salt", "turn"))
    # Texts are picked by a list of bounded size, or else by a shuffle.
    wants = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last, raw = None, []
            for text in batch.column(0):
                text = text.as_py()
                if text is not last and text != last:
                    last, features = text, shingles(hash_words(text)[0], shingle)
                    found = (node_of(features), pack_set(features))
                raw.append(found)
            # Rows sharing an id may have other texts: only the one that gave the node counts.
            good = pa.array([n == node for (n, _), node in zip(raw, batch.column(1).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([r for _, r in raw], pa.binary())],
                                             ["node", "a", "salt", "turn", "features"]).filter(good)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, own = None, None
        for batch in batches:
            found = []
            for node, a, turn, raw in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), batch.column(4), strict=True):
                if turn == 0:
                    lead, own = a, unpack_set(raw.as_py())
                elif lead == a and similar(own, unpack_set(raw.as_py()), NUMERATOR, DENOMINATOR):
                    found.append((a, node))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(wants, "doc_id").select("text", "node", "a", "salt", "turn")
    sets = texts.mapInArrow(run, "node bigint, a bigint, salt int, turn int, features binary")
    dealt = sets.repartition(F.col("a"), F.col("salt")).sortWithinPartitions("a", "salt", "turn")
    return dealt.mapInArrow(compare, "a bigint, b bigint").distinct()


# --- operator -----------------------------------------------------------------------------------


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the components, not the links themselves.

    A set holds the distinct runs of ``shingle`` words (A-Z lower-cased) of the whole text; with
    fewer words the whole sequence is its one element; NULL and empty texts have the empty set
    and link with nothing. Rows link at Jaccard similarity 3/4 and more; ``component_id`` is the
    smallest id reachable by links. Rows with equal sets are linked through their set; repeated
    ids are rows of their own with one component; rows without id have the component of the rest
    of their group, NULL if no row of it has an id.

    Equal sets become one node. Nodes meet by signature. In groups of up to ``HOT`` nodes all
    pairs are counted, and those that share as many signatures as similar sets must are compared.
    Of its larger groups a node needs only some, the smallest (see ``signatures``); the nodes left
    in them, mostly large groups of near copies, are compared with the smallest node of their
    group, and what then still lies in different components pair by pair where sizes and sketches
    allow it. So similar pairs that already share a component may never be compared, and no list
    or number of links can be had from here. Elements are compared as hashes, of 40 bits in the
    last test.
    """
    # NULL ids take the largest number, so that joins keep them.
    own = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc_id"), F.col(text_col).alias("text"))
    profile = stored(profiles(own, shingle))
    classes = stored(profile.where("node <> 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    total = profile.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_ENTRIES))
    met = stored(packed_signatures(own, buckets, shingle).groupBy("bucket").applyInPandas(lambda frame: meet(frame), MET))

    heat = met.where(F.col("kind") == HEAT).groupBy(F.col("a").alias("node"), "scheme").agg(
        F.first("b").alias("spare"), F.sum("n").alias("heat"))
    heat = stored(heat)
    counted = met.where(F.col("kind") == PAIR).groupBy("a", "b", "scheme").agg(F.sum("n").alias("n"), F.first("need").alias("need"))
    # Groups too large to count may hold the rest of what a pair needs.
    warm = lambda side: heat.select(F.col("node").alias(side), "scheme", F.col("heat").alias(f"h{side}"))
    counted = counted.join(warm("a"), ["a", "scheme"], "left").join(warm("b"), ["b", "scheme"], "left")
    counted = stored(counted.withColumn("both", F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0)))).select("a", "b", "scheme", "n", "need", "both"))
    pairs = counted.where("n + both >= need").select("a", "b")

    # Of its crowded groups a node needs only the smallest: it can spare some, and shares one of the
    # others with every similar node it shares nothing else with, when both go by size of group.
    member = met.where(F.col("kind") == MEMBER).groupBy(F.col("a").alias("key"), "b", "scheme").agg(
        F.sum("n").alias("n"), F.first("size").alias("size"), F.min("crowd").alias("crowd"))
    member = member.join(heat.where("heat > spare").select(F.col("node").alias("b"), "scheme", (F.col("heat") - F.col("spare")).alias("due")), ["b", "scheme"])
    before = F.sum("n").over(W.partitionBy("b", "scheme").orderBy("crowd", "key")) - F.col("n")
    member = stored(member.withColumn("before", before).where("before < due").select("key", "b", "size", "scheme", "crowd"))
    stars = member.join(member.groupBy("key").agg(F.min("b").alias("a")), "key").where("a <> b").select("a", "b")
    tried = stored(pairs.union(stars).distinct())
    links = stored(verified(tried, own, classes, shingle))
    labels = stored(components(links))
    if not member.isEmpty():
        named = member.join(labels, member["b"] == labels["node"], "left").select(*member.columns, F.coalesce("component", "b").alias("component"))
        spans = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
        sketch = profile.groupBy(F.col("node").alias("b")).agg(F.first("sketch").alias("sketch"))
        # Nodes apart meet in groups that span components only. Every node goes through its groups in one
        # order; a pair that shares one of the last few before this group was listed there or earlier,
        # in the first group of all that it shares for certain.
        last = W.partitionBy("b", "scheme").orderBy("crowd", "key").rowsBetween(-EARLIER, -1)
        named = named.join(spans, "key", "left_semi").withColumn("earlier", F.collect_list("key").over(last))
        named = stored(named.join(sketch, "b").select("key", "b", "size", "component", "sketch", "earlier"))
        other = named.select("key", F.col("b").alias("a"), F.col("size").alias("sa"), F.col("sketch").alias("ka"), F.col("component").alias("ca"),
                             F.col("earlier").alias("ea"))
        differ = F.aggregate(F.zip_with("ka", "sketch", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
        apart = other.join(named, "key").where(
            F.expr("a < b AND ca <> component AND 4 * least(sa, size) >= 3 * greatest(sa, size)") & (7 * differ <= F.col("sa") + F.col("size"))
            & ~F.arrays_overlap("ea", "earlier"))
        apart = stored(apart.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
        if not apart.isEmpty():
            labels = stored(components(links.unionAll(verified(apart, own, classes, shingle))))

    named = labels.join(classes, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = labels.join(named, "component").select("node", "component_id")
    named = classes.join(named, "node", "left").select("node", F.least("doc_id", "component_id").alias("component_id"))
    # Both sides are plain exchanges, so adaptive execution can split a set owning many rows;
    # rows without words are spread by their id and match nothing.
    named = stored(named)
    key = F.when(F.col("node") == 0, F.xxhash64("doc_id")).otherwise(F.col("node"))
    probe = profile.drop("sketch").withColumn("k", key).withColumn("empty", F.col("node") == 0)
    joined = probe.join(named.select(F.col("node").alias("k"), "component_id"), "k", "left")
    component = F.when(F.col("empty"), F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id"))
    return joined.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_shingles", F.nullif(component, F.lit(NO_ID)).alias("component_id"))

