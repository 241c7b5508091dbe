"""Merkle manifest of a dataset: leaf digests, one tree per language, one root, a proof for every row.

Rows are numbered inside their language. A rank is cut into a block number and binary digits; grouping
by all but the lowest digit left puts two nodes side by side in the struct of their parent, and
after as many groupings as a block has digits, one struct holds the tree of the block. Its
nested arrays are walked by transforms that hand the siblings down and exploded into one row per leaf.
Block roots are the leaves of the next level, up to one block per language and, over languages, one
block for all. Nothing larger than a block is ever in one row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.llm.ordered import ranked
from leadloom.llm.shared import stored

# Binary digits of a block: 64 leaves, whose nested struct takes about 8 KB.
DIGITS = 6
_STEP = "struct<left: string, right: string>"


def _none() -> Column:
    return F.lit(None).cast("string")


class Manifest(NamedTuple):
    """``proofs``: ``doc_id, lang, leaf, changed, subroot, root, path`` with a row per row of the table.

    ``path`` is the way from leaf to root, an array of (left, right) siblings; both are NULL where a
    node has none. ``subroots``: ``lang, subroot``.
    """

    proofs: DataFrame
    subroots: DataFrame


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts after one another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: every field as its byte count, a colon and its UTF-8 text; NULL as a dash."""
    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(framed, fields))


def _lifted(h: Column, times: Column) -> Column:
    steps = F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, h, lambda acc, _: digest(acc))


def _blocks(items: DataFrame, digits: int, leaf: list[str], lift: bool) -> DataFrame:
    """``g, b, still, node`` for every block of items ``g, r, h, still`` and the columns ``leaf``.

    One shuffle deals blocks; grouping digits away keeps that partitioning and its order. A node
    alone in its block stays as it is and is counted in ``still``: whether it must be hashed alone
    depends on there being other blocks, which the level above sees and makes good (``lift``).
    ``climbed`` in a node says whether its kids rose to it by a hash.
    """
    bits = {f"d{j}": F.shiftright("r", j).bitwiseAND(1).cast("int") for j in range(digits)}
    rows = items.select("g", F.floor(F.col("r") / F.lit(1 << digits)).cast("bigint").alias("b"), *[c.alias(n) for n, c in bits.items()],
                        F.struct("h", F.col("still").alias("low"), *leaf).alias("node"), F.lit(0).alias("still")).repartition("g", "b")
    for j in range(digits):
        higher = [f"d{d}" for d in range(digits - 1, j, -1)]
        side = lambda k: F.first(F.when(F.col(f"d{j}") == k, F.struct("node", "still")), ignorenulls=True)  # noqa: B023, E731
        rows = rows.groupBy("g", "b", *higher).agg(side(0).alias("zero"), side(1).alias("one"))
        zero, one = F.col("zero.node"), F.col("one.node")
        alone = one.isNull()
        for d in higher:
            alone = alone & (F.col(d) == 0)
        if lift and j == 0:
            only = alone & (F.col("b") == 0)
            raised = lambda k: k.withField("h", F.when(only, k["h"]).otherwise(_lifted(k["h"], k["low"]))).withField(  # noqa: B023, E731
                "low", F.when(only, 0).otherwise(k["low"]))  # noqa: B023
            rows = rows.withColumns({"zero": F.struct(raised(zero).alias("node"), "zero.still"),
                                     "one": F.when(one.isNotNull(), F.struct(raised(one).alias("node"), "one.still"))})
        h = F.when(alone, zero["h"]).otherwise(digest(zero["h"], F.coalesce(one["h"], F.lit(""))))
        kids = F.when(one.isNull(), F.array(zero)).otherwise(F.array(zero, one))
        rows = rows.select("g", "b", *higher, F.struct(h.alias("h"), (~alone).alias("climbed"), kids.alias("kids")).alias("node"),
                           F.when(alone, F.col("zero.still") + 1).otherwise(0).alias("still"))
    return rows


def _leaves(node: Column, digits: int, path: Column) -> Column:
    """Array of ``(item, path)`` below a block's node, given the path from the node upwards."""
    def below(node: Column, level: int, path: Column) -> Column:
        kids = node["kids"]

        def one(kid: Column, i: Column) -> Column:
            other = F.get(kids, 1 - i)["h"]
            step = F.struct(F.when(i == 1, other).alias("left"), F.when(i == 0, other).alias("right"))
            up = F.concat(F.filter(F.array(step), lambda _: node["climbed"]), path)
            if level:
                return below(kid, level - 1, up)
            lone = F.array_repeat(F.struct(_none().alias("left"), _none().alias("right")), kid["low"])
            return F.array(F.struct(kid.alias("item"), F.concat(lone, up).alias("path")))

        return F.flatten(F.transform(kids, one))

    return below(node, digits - 1, path)


def _tree(items: DataFrame, digits: int) -> list[DataFrame]:
    """Stored blocks of every level; the last level has one block in each group."""
    levels, leaf = [], [c for c in items.columns if c not in ("g", "r", "h", "still")]
    while True:
        level = stored(_blocks(items, digits, leaf, lift=bool(levels)))
        levels.append(level)
        if not level.agg(F.max("b")).first()[0]:
            return levels
        items = level.select("g", F.col("b").alias("r"), "node.h", "still", F.col("b").alias("at"))
        leaf = ["at"]


def _descend(levels: list[DataFrame], digits: int, tops: DataFrame) -> DataFrame:
    """Items of the lowest level with ``path`` and the columns of ``tops`` (``g, path, top``).

    A block and the path above it meet by grouping both under the block's key, two rows a key.
    """
    upper = tops.select("g", F.lit(0).cast("bigint").alias("b"), "path", "top")
    for k, level in reversed(list(enumerate(levels))):
        node_type, top_type = level.schema["node"].dataType, upper.schema["top"].dataType
        both = level.select("g", "b", "node", F.lit(None).cast(f"array<{_STEP}>").alias("path"), F.lit(None).cast(top_type).alias("top")).unionByName(
            upper.select("g", "b", F.lit(None).cast(node_type).alias("node"), "path", "top"))
        met = both.groupBy("g", "b").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("node", "path", "top")])
        found = met.select("g", "top", F.inline(_leaves(F.col("node"), digits, F.col("path"))))
        if k == 0:
            return found
        upper = found.select("g", F.col("item.at").alias("b"), "path", "top")
    raise ValueError("no levels")


def manifest(leaves: DataFrame, digits: int = DIGITS) -> Manifest:
    """Trees over ``leaves``: ``doc_id, lang, leaf, changed`` (any further digest, or NULL).

    Leaves ascend by ``doc_id`` (NULL first; equal ids by digest), languages by their bytes (NULL
    first). Repeated rows are leaves of their own. An empty table gives no proofs and no root.
    """
    placed = ranked(leaves.select("doc_id", "lang", "leaf", "changed"), ["lang"], ["doc_id", "leaf", "changed"])
    items = placed.select(F.struct("lang").alias("g"), "r", F.col("leaf").alias("h"), F.lit(0).alias("still"), "doc_id", "changed")
    levels = _tree(items, digits)
    subroots = levels[-1].select("g.lang", F.col("node.h").alias("subroot"))
    langs = ranked(subroots.withColumn("all", F.lit(0)), ["all"], ["lang", "subroot"])
    langs = langs.select(F.col("all").alias("g"), "r", F.col("subroot").alias("h"), F.lit(0).alias("still"), "lang")
    over = _tree(langs, digits)
    no_path = F.array().cast(f"array<{_STEP}>")
    tops = over[-1].select("g", no_path.alias("path"), F.struct(F.col("node.h").alias("root")).alias("top"))
    by_lang = _descend(over, digits, tops).select(
        F.struct("item.lang").alias("g"), "path", F.struct("top.root", F.col("item.h").alias("subroot")).alias("top"))
    proofs = _descend(levels, digits, by_lang).select(
        "item.doc_id", "g.lang", F.col("item.h").alias("leaf"), "item.changed", "top.subroot", "top.root", "path")
    return Manifest(proofs, subroots)


def siblings(path: Column) -> Column:
    """Digest of all siblings of a path, from leaf to root and left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(F.coalesce(s["left"], F.lit("")), F.coalesce(s["right"], F.lit("")))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, s: digest(F.coalesce(s["left"], F.lit("")), acc, F.coalesce(s["right"], F.lit(""))))


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, lang, leaf, changed``: digests of doc_id, source, lang, n_chars and text.

    ``changed`` is the digest with ``n_chars`` one larger where ``tampered`` holds, else NULL; a
    NULL ``n_chars`` stays NULL. Further columns play no part.
    """
    fields = lambda n: [F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text")]
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    changed = F.when(tampered, leaf_digest(*fields(more))) if tampered is not None else _none()
    return docs.select("doc_id", "lang", leaf_digest(*fields(F.col("n_chars"))).alias("leaf"), changed.alias("changed"))


def verify(found: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row."""
    rows = found.proofs.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", siblings(F.col("path")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
