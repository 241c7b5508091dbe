"""Prefix trie of conversations, grouped by blocks of turns and refined only where siblings part.

Turns become digests, and every few turns of a conversation one block. A block's key stands for all
turns up to its end, so conversations with equal keys share a path; copies meet as one row there.
Below a block that goes on in one way only, every turn boundary belongs to the same conversations.
Only blocks with siblings are cut into turns and grouped again.

Sums over subtrees need no walk: a node's smallest member owns it, and what lies below a node is
owned by its members. Each conversation thus brings its words, the words of the nodes it owns and the
leaf it owns, and a node adds up its members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom import skew
from leadloom.llm.mixing import word_count
from leadloom.llm.ordered import ranked, running
from leadloom.llm.shared import stored

# Turns in a block; ids written as one piece of text.
BLOCK, PIECE = 4, 512
ROOT = ""
_LONG = "bigint"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, t, words``: a 128-bit digest of role and text, and the words of the text.

    NULL roles and texts are empty ones. Rows without a ``conv_id`` belong to no conversation and
    take no part; further columns play none.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast(_LONG).alias("conv_id"), F.col("turn").cast(_LONG).alias("turn"),
        F.substring(F.sha2(whole, 256), 1, 32).alias("t"), word_count("text").alias("words"))


def rebuilt(rows: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (``conv_id, part, pos, t, words``) and all ``conv_id``.

    A conversation gets the first ``head`` turns of conversation ``base`` (``head`` is at most
    ``most``), then its own turns after its first ``head``. Turns ascend by ``turn`` (NULL first; equal
    ones by digest).
    """
    placed = stored(ranked(rows, ["conv_id"], ["turn", "t", "words"]).withColumnRenamed("r", "pos"))
    convs = placed.where("pos = 0").select("conv_id")
    step = F.struct("pos", "t", "words")
    heads = placed.where(F.col("pos") < most).groupBy(F.col("conv_id").alias("of")).agg(F.collect_list(step).alias("steps"))
    lent = convs.select("conv_id", base.alias("of"), head.alias("h")).where("h > 0").join(heads, "of")
    lent = lent.select("conv_id", "h", F.inline("steps")).where("pos < h").select("conv_id", F.lit(0).alias("part"), "pos", "t", "words")
    own = placed.where(F.col("pos") >= head).select("conv_id", F.lit(1).alias("part"), "pos", "t", "words")
    return lent.unionByName(own), convs


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """A row per conversation and block: ``q`` stands for all turns up to its end, ``p`` for those before.

    Keys fold the digests of a conversation's blocks, salted by place, into 128 bits. A block that
    is not full ends its conversation, so its last turn (``end``) has a key of its own.
    """
    numbered = running(turns, ["conv_id"], ["part", "pos"], depth=("sum", F.lit(1).cast(_LONG)), upto=("sum", F.col("words")))
    rows = numbered.withColumn("blk", F.floor((F.col("depth") - 1) / F.lit(block)).cast(_LONG)).groupBy("conv_id", "blk").agg(
        F.sort_array(F.collect_list(F.struct("depth", "t", "words"))).alias("s"), F.min(F.col("upto") - F.col("words")).alias("before"), F.max("upto").alias("upto"))
    rows = rows.select("conv_id", "blk", "before", "upto", F.transform("s", lambda x: F.struct(x["t"].alias("t"), x["words"].alias("words"))).alias("steps"))
    own = F.sha2(F.concat(F.col("blk").cast("string"), F.lit(":"), F.array_join("steps.t", "")).cast("binary"), 256)
    rows = rows.withColumn("own", own).withColumns({"x1": F.xxhash64("own", F.lit(1)), "x2": F.xxhash64("own", F.lit(2))}).drop("own")
    rows = running(rows, ["conv_id"], ["blk"], q1=("xor", F.col("x1")), q2=("xor", F.col("x2")))
    key = lambda blk, a, b: F.concat_ws(":", blk.cast("string"), a.cast("string"), b.cast("string"))
    before = key(F.col("blk") - 1, F.col("q1").bitwiseXOR(F.col("x1")), F.col("q2").bitwiseXOR(F.col("x2")))
    rows = rows.withColumns({"q": key(F.col("blk"), F.col("q1"), F.col("q2")), "p": F.when(F.col("blk") > 0, before).otherwise(ROOT)})
    return rows.withColumn("end", _key(block, F.size("steps"))).drop("x1", "x2", "q1", "q2")


def _key(block: int, i: Column) -> Column:
    """Key of the node after the first ``i`` turns of a block."""
    inner = F.sha2(F.concat(F.col("p"), F.lit("|"), F.array_join(F.slice("steps.t", F.lit(1), i), "")).cast("binary"), 256)
    return F.when(i == block, F.col("q")).when(i == 0, F.col("p")).otherwise(F.substring(inner, 1, 32))


def _boundaries(groups: DataFrame, block: int) -> DataFrame:
    """A row per turn boundary of every distinct block: ``q, c, n, quiet, key, parent, depth, w, before``."""
    def one(s: Column, i: Column) -> Column:
        earlier = F.aggregate(F.slice("steps.words", F.lit(1), i), F.lit(0).cast(_LONG), lambda a, x: a + x)
        return F.struct(_key(block, i + 1).alias("key"), _key(block, i).alias("parent"), (F.col("blk") * block + i + 1).alias("depth"),
                        s["words"].alias("w"), (F.col("before") + earlier).alias("up"))

    return groups.select("q", "c", "n", (F.col("siblings") == 1).alias("quiet"), F.inline(F.transform("steps", one))).withColumnRenamed("up", "before")


def _hot(rows: DataFrame) -> int:
    """Rows a key needs to be handed out by broadcast: at most a thousand keys can have so many."""
    return max(64, rows.count() // 1000)


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie over ``turns`` (``conv_id, part, pos, t, words``) and the conversations' ends.

    Nodes: ``key, conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens``. Ends: ``key, conv_id``, the node at which each conversation ends. Conversations
    without a turn end at the root; without conversations there is no node.
    """
    cells = stored(_blocks(turns, block))
    pick = lambda *names: [F.first(c).alias(c) for c in names]
    groups = stored(cells.groupBy("q").agg(*pick("p", "blk", "before", "steps"), F.min("conv_id").alias("c"), F.count("*").alias("n")))
    siblings = groups.groupBy("p").agg(F.count("*").alias("rows"), F.count("*").alias("siblings"))
    marked = skew.attach(groups, siblings, ["p"], "rows", _hot(groups))
    path = stored(_boundaries(marked, block))

    def refined(rows: DataFrame, fixed: list[str], **sums: Column) -> DataFrame:
        """One row per node: as they are in quiet blocks, grouped by turn boundary in the others."""
        quiet = rows.where("quiet").select("key", *fixed, *sums)
        parted = rows.where("NOT quiet").groupBy("key").agg(*pick(*fixed), *[c.alias(n) for n, c in sums.items()])
        return quiet.unionByName(parted)

    top = convs.agg(F.min("conv_id").alias("c"), F.count("*").alias("n")).where("n > 0")
    zero = F.lit(0).cast(_LONG)
    root = top.select(F.lit(ROOT).alias("key"), F.lit(None).cast("string").alias("parent"), zero.alias("depth"), zero.alias("w"), zero.alias("before"), "c", "n")
    nodes = refined(path, ["parent", "depth", "w", "before"], c=F.min("c"), n=F.sum("n")).unionByName(root)
    nodes = stored(nodes)
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(kids, "key", "left").withColumn("n_children", F.coalesce("n_children", zero)))

    # Per conversation: its words, its last block, and the words and leaves of the nodes it owns.
    none = F.lit(-1).cast(_LONG)
    parts = cells.groupBy("conv_id").agg(F.max("upto").alias("words"), F.max("blk").alias("last")).select("conv_id", "words", "last", zero.alias("own"), zero.alias("leaf"))
    owned = nodes.groupBy(F.col("c").alias("conv_id")).agg(F.sum("w").alias("own"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    parts = parts.unionByName(owned.select("conv_id", zero.alias("words"), none.alias("last"), "own", "leaf"))
    parts = parts.unionByName(convs.select("conv_id", zero.alias("words"), none.alias("last"), zero.alias("own"), zero.alias("leaf")))
    facts = stored(parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in ("words", "last", "own", "leaf")]))

    lead = F.min(F.struct("conv_id", "words", "own")).alias("lead")
    adds = [F.sum("words").alias("words"), F.sum("own").alias("own"), F.sum("leaf").alias("n_leaves"), lead]
    by_block = cells.select("conv_id", "q").join(facts, "conv_id").groupBy("q").agg(*adds)
    met = path.select("q", "key", "quiet").join(by_block, "q")
    sums = refined(met, [], words=F.sum("words"), own=F.sum("own"), n_leaves=F.sum("n_leaves"), lead=F.min("lead"))
    sums = sums.unionByName(facts.agg(*adds).where("lead IS NOT NULL").select(F.lit(ROOT).alias("key"), "words", "own", "n_leaves", "lead"))
    # All words of the members below the node, less those of every distinct node below it once.
    below = F.col("words") - F.col("n") * F.col("before")
    once = F.col("own") - F.col("lead.own") + F.col("lead.words") - F.col("before")
    full = nodes.join(sums, "key").withColumn("saved_tokens", below - once)
    parents = nodes.where("n_children > 0").select(F.col("key").alias("parent"), F.col("c").alias("parent_conv_id"), "n_children")
    full = skew.attach(full, parents, ["parent"], "n_children", _hot(nodes), how="left")
    out = full.select("key", F.col("c").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens")

    last = cells.select("conv_id", "blk", "end").join(facts.select("conv_id", "last"), "conv_id").where("blk = last")
    ends = last.select(F.col("end").alias("key"), "conv_id").unionByName(facts.where("last < 0").select(F.lit(ROOT).alias("key"), "conv_id"))
    return out, ends


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each key's pieces, which arrive in order; only the key at hand is kept."""
    at, state = None, None
    done = lambda: pa.RecordBatch.from_pylist([{"key": at, "ends_sha256": state.hexdigest()}])
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != at:
                if state is not None:
                    yield done()
                at, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if state is not None:
        yield done()


def end_digests(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256``: SHA-256 of the ids of each key, ascending and joined by commas.

    Ids are numbered inside their key and written in pieces of bounded length. A key of one piece is
    digested as it is; the pieces of longer ones pass one after another through one digest.
    """
    numbered = running(ends, ["key"], ["conv_id"], at=("sum", F.lit(1).cast(_LONG)))
    pieces = numbered.groupBy("key", F.floor((F.col("at") - 1) / F.lit(PIECE)).cast(_LONG).alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = stored(pieces.select("key", "piece", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("text")))
    long = pieces.where("piece = 1").select("key")
    short = pieces.join(long, "key", "left_anti").select("key", F.sha2(F.col("text").cast("binary"), 256).alias("ends_sha256"))
    rest = pieces.join(long, "key", "left_semi").repartition("key").sortWithinPartitions("key", "piece").select("key", "text")
    return short.unionByName(rest.mapInArrow(_stream, "key string, ends_sha256 string"))
