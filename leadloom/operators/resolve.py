"""Entity resolution: phone keys, blocked fuzzy names, and order-exact batch resolution."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom import skew
from leadloom.constants import FUZZY_THRESHOLD, REVIEW_LOG_COLUMNS
from leadloom.functions.names import (
    entity_key,
    fuzzy_normalize_company_name,
    normalize_company_name,
    phone_key,
    token_sorted,
)
from leadloom.functions.text import blank_to_null
from leadloom.operators.leads import as_of_column
from leadloom.operators.similar import PREFIX, indexed_names, name_prefix, similar_names
from leadloom.ranges import running_sum
from leadloom.session import cut_lineage, stored

REVIEW_FLOOR = 80
FIRST_GENERATION = 100_000
GENERATION_GROWTH = 4
_NODE = ["in_form", "in_norm"]
_CAND = ["cand_form", "cand_norm"]


class RegistryIndex(NamedTuple):
    """Stored companies ready to be matched, so that no name of them is normalized again.

    ``leaders``: ``leader_key, leader_name, cand_form, cand_norm``; ``segments``: their
    :func:`~leadloom.operators.similar.segment_index` made for the threshold ``made_for``.
    """

    leaders: DataFrame
    segments: DataFrame
    made_for: float


class Resolution(NamedTuple):
    """``records``: input plus ``dedup_key, match_type, matched_name, fuzzy_score``.

    ``leaders``: every node a record could match: ``leader_key, leader_name, cand_form,
    cand_norm, leader_seq`` (existing companies carry seq -1).
    """

    records: DataFrame
    leaders: DataFrame


def fuzzy_form(name: Column | str) -> Column:
    return token_sorted(fuzzy_normalize_company_name(name))


def with_identity(records: DataFrame) -> DataFrame:
    """Add the identity columns resolution works on."""
    raw = F.coalesce(F.col("company_name"), F.lit(""))
    stored = F.coalesce(blank_to_null("company_name"), F.lit("Unknown"))
    phone = blank_to_null("phone")
    return records.withColumns(
        {
            "stored_name": stored,
            "in_norm": normalize_company_name(stored),
            "in_form": fuzzy_form(raw),
            "phone_key": phone_key(phone),
            "entity_key": entity_key(raw, phone, "website"),
        }
    )


def _identified(records: DataFrame) -> DataFrame:
    """Records with their identity columns, stored: names are normalized once, whatever reads them.

    A file of many short records is few partitions, and normalizing takes far longer than reading:
    records are dealt evenly first.
    """
    spark = records.sparkSession
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
    rows = with_identity(records.repartition(wanted))
    # Parquet has no untyped columns and none of the same name.
    plain = len({c.lower() for c in rows.columns}) == len(rows.columns) and not any("void" in t for _, t in rows.dtypes)
    return stored(rows) if plain else cut_lineage(rows)


def as_leaders(registry: DataFrame) -> DataFrame:
    """Existing companies as nodes that were there before the batch."""
    return registry.select(
        F.col("dedup_key").alias("leader_key"),
        F.coalesce("company_name", F.lit("")).alias("leader_name"),
        fuzzy_form(F.coalesce("company_name", F.lit(""))).alias("cand_form"),
        F.coalesce("normalized_name", F.lit("")).alias("cand_norm"),
        F.lit(-1).cast("bigint").alias("leader_seq"),
    )


# --- single operators against a fixed registry -------------------------------------------


def phone_match(batch: DataFrame, registry: DataFrame) -> DataFrame:
    """Batch records with the company whose key equals their phone key (NULL if none)."""
    known = registry.select(
        F.col("dedup_key").alias("matched_key"), F.col("company_name").alias("matched_name")
    )
    keyed = batch.withColumn("phone_key", phone_key(blank_to_null("phone")))
    # Records without a phone key spread out instead of sharing the NULL partition.
    alone = F.concat(F.lit("\u0001"), F.col("seq").cast("string"))
    return keyed.join(known, F.coalesce("phone_key", alone) == F.col("matched_key"), "left")


def block_sizes(batch: DataFrame, registry: DataFrame) -> DataFrame:
    """Prefix block of every batch record and how many companies it would be compared with.

    Counted from per-prefix totals, so no pair is ever formed. Each company counts for its
    prefixes of length 0..3, which covers short and empty incoming names too.
    """
    norm = F.coalesce("normalized_name", F.lit(""))
    lengths = F.sequence(F.lit(0), F.least(F.length(norm), F.lit(PREFIX)))
    totals = (
        registry.select(F.explode(F.transform(lengths, lambda n: F.substring(norm, F.lit(1), n))).alias("prefix"))
        .groupBy("prefix")
        .agg(F.count("*").alias("candidates"))
    )
    blocked = with_identity(batch).withColumn("prefix", name_prefix(F.col("in_norm")))
    sizes = blocked.groupBy("prefix").agg(F.count("*").alias("block_rows")).join(totals, "prefix", "left")
    return skew.attach(blocked, sizes, ["prefix"], "block_rows").withColumn(
        "candidates", F.coalesce("candidates", F.lit(0))
    )


def _best(score: str = "score") -> Column:
    """Order of preference among matching leaders; the smallest struct is the best."""
    return F.struct(
        (-F.col(score)).alias("neg_score"), F.col("leader_name"), F.col("leader_seq"),
        F.col("leader_key"),
    )


def best_fuzzy(
    batch: DataFrame, registry: DataFrame, threshold: float = FUZZY_THRESHOLD
) -> DataFrame:
    """Best company by name similarity: highest score, then smaller name, then key."""
    records = with_identity(batch)
    nodes = records.groupBy(*_NODE).agg(F.count("*").alias("node_rows"))
    leaders = as_leaders(registry)
    pairs = similar_names(nodes.select(*_NODE), leaders.select(*_CAND).distinct(), threshold)
    best = pairs.join(leaders, _CAND).groupBy(*_NODE).agg(F.min(_best()).alias("b"))
    picked = nodes.join(best, _NODE).select(
        *_NODE, "node_rows",
        F.col("b.leader_key").alias("matched_key"), F.col("b.leader_name").alias("matched_name"),
        (-F.col("b.neg_score")).alias("fuzzy_score"),
    )
    return skew.attach(records, picked, _NODE, "node_rows")


# --- batch resolution --------------------------------------------------------------------


def _seq_minima(kind: list[str], leaders: DataFrame, open_: DataFrame) -> DataFrame:
    """Earliest new leader and earliest undecided entry per group."""
    null = F.lit(None).cast("bigint")
    return (
        leaders.select(*kind, F.col("seq").alias("lead"), null.alias("wait"))
        .unionByName(open_.select(*kind, null.alias("lead"), F.col("seq").alias("wait")))
        .groupBy(*kind)
        .agg(F.min("lead").alias("lead"), F.min("wait").alias("wait"))
    )


def _with_minima(
    rows: DataFrame, minima: DataFrame, keys: list[str], names: tuple[str, str], total: int,
    hot_rows: int,
) -> DataFrame:
    renamed = minima.withColumnsRenamed({"lead": names[0], "wait": names[1]})
    if total <= hot_rows:  # no key can be hot
        return rows.join(renamed, keys, "left")
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("key_rows"))
    return skew.attach(rows, sizes.join(renamed, keys, "left"), keys, "key_rows", hot_rows)


def _leader_rows(types: DataFrame) -> DataFrame:
    return types.select(
        F.col("entity_key").alias("leader_key"), "leader_name", *_CAND,
        F.col("seq").alias("leader_seq"),
    )


def _elect_leaders(
    types: DataFrame, edges: DataFrame, known: DataFrame | None, max_rounds: int, hot_rows: int,
) -> list[DataFrame]:
    """Types that found no earlier leader when their first record arrived.

    This is the greedy independent set of the match graph in arrival order: a type is settled
    as merged as soon as any earlier neighbour is a leader, and as a leader once no earlier
    neighbour is undecided. All types advance together; on tangled inputs the number of
    rounds grows with the longest alternating chain, typically logarithmically.
    """
    open_ = types.withColumn("state", F.lit("open"))
    fresh = open_.where(F.lit(False))
    if known is not None:
        fresh = known.select(
            *_CAND, F.col("leader_key").alias("entity_key"), F.col("leader_seq").alias("seq")
        )
    elected: list[DataFrame] = []
    for _ in range(max_rounds):
        total = open_.count()
        if total == 0:
            return elected
        by_key = _seq_minima(["entity_key"], fresh, open_)
        judged = _with_minima(
            open_.drop("state"), by_key, ["entity_key"], ("key_lead", "key_wait"), total, hot_rows
        )
        near = edges.join(_seq_minima(_CAND, fresh, open_), _CAND)
        near = near.groupBy(*_NODE).agg(F.min("lead").alias("lead"), F.min("wait").alias("wait"))
        judged = _with_minima(judged, near, _NODE, ("name_lead", "name_wait"), total, hot_rows)
        seq = F.col("seq")
        earlier = lambda c: F.coalesce(F.col(c) < seq, F.lit(False))
        state = (
            F.when(earlier("key_lead") | earlier("name_lead"), "merged")
            .when(earlier("key_wait") | earlier("name_wait"), "open")
            .otherwise("leader")
        )
        judged = cut_lineage(judged.withColumn("state", state).select(open_.columns))
        fresh = judged.where("state = 'leader'")
        elected.append(_leader_rows(fresh))
        open_ = judged.where("state = 'open'")
    if open_.isEmpty():
        return elected
    raise RuntimeError(f"resolution not settled after {max_rounds} rounds; raise max_rounds")


def resolve(
    records: DataFrame, registry: DataFrame | RegistryIndex | None = None, threshold: float = FUZZY_THRESHOLD,
    max_rounds: int = 500, hot_rows: int = skew.HOT_ROWS, first_generation: int = FIRST_GENERATION,
) -> Resolution:
    """Resolve a batch as if records were upserted one by one in ``seq`` order.

    Each record sees the registry and every node created earlier in the batch: phone key
    first, then the best fuzzy name, then an equal identity key, else it creates a node.
    A threshold above 100 turns fuzzy matching off. A large registry comes as a :class:`RegistryIndex`:
    the batch then looks its names up in the stored segments instead of cutting up all companies.

    Records with the same identity form, key and phone flag are one *type*: only its first
    record can create a node, so the iteration runs over types and copies never meet. Large
    batches go in generations of growing size: a type similar to a leader of an earlier
    generation is settled before it is compared with its own generation, so dense groups of
    near-equal names shrink to their leaders instead of meeting pairwise. The winner per
    record afterwards is a lookup in per-name time intervals, because leaders only ever join.
    """
    rows = _identified(records)
    types = (
        rows.groupBy(*_NODE, "entity_key", F.col("phone_key").isNotNull().alias("has_phone"))
        .agg(
            F.min("seq").alias("seq"), F.min_by("stored_name", "seq").alias("leader_name"),
            F.count("*").alias("type_rows"),
        )
        .withColumn("cand_form", fuzzy_form("leader_name"))
        .withColumn("cand_norm", F.col("in_norm"))
    )
    types = cut_lineage(types)
    index = None
    if isinstance(registry, RegistryIndex):
        known = registry.leaders.withColumn("leader_seq", F.lit(-1).cast("bigint"))
        if registry.made_for <= threshold:
            index = registry
    else:
        known = stored(as_leaders(registry)) if registry is not None else None
    everyone = lambda own: reduce(DataFrame.unionByName, own + ([known] if known is not None else []))

    edges = None
    if threshold > 100:
        leaders = everyone([_first_per_key(types, known)])
    else:
        cuts = _generation_cuts(types, first_generation)
        if cuts:
            own: list[DataFrame] = []
            bounds = [None, *cuts, None]
            for low, high in zip(bounds, bounds[1:]):
                batch = types if low is None else types.where(F.col("seq") > low)
                batch = batch if high is None else batch.where(F.col("seq") <= high)
                if own or known is not None:
                    batch = _unmatched(batch, own, known, threshold, index)
                near = _type_edges(batch, None, threshold)
                own += _elect_leaders(batch, near, None, max_rounds, hot_rows)
            leaders = everyone(own)
            edges = cut_lineage(_near(types, own, known, threshold, index))
        else:
            edges = _type_edges(types, known, threshold, index)
            leaders = everyone(_elect_leaders(types, edges, known, max_rounds, hot_rows))
    resolved = _assign(rows, types, leaders, edges, records.columns, hot_rows)
    # Node and edge tables, log and statistics all read the result: compute it once.
    return Resolution(cut_lineage(resolved), leaders)


def _generation_cuts(types: DataFrame, first: int) -> list[float]:
    """Arrival positions between generations, each four times the one before."""
    total = types.count()
    shares, size, upto = [], first, first
    while upto < total:
        shares.append(upto / total)
        size *= GENERATION_GROWTH
        upto += size
    if not shares:
        return []
    # Any cut is correct; a rough quantile only shifts work between generations.
    return sorted(set(types.approxQuantile("seq", shares, max(1e-5, first / total / 4))))


def _near(
    names: DataFrame, own: list[DataFrame], known: DataFrame | None, threshold: float, index: RegistryIndex | None,
) -> DataFrame:
    """Similar names among ``own`` candidates and known companies, the latter from the index if there is one."""
    nodes = names.select(*_NODE).distinct()
    fresh = [c.select(*_CAND) for c in own]
    if index is None:
        fresh += [known.select(*_CAND)] if known is not None else []
        return similar_names(nodes, reduce(DataFrame.unionByName, fresh).distinct(), threshold)
    found = indexed_names(nodes, index.segments, index.made_for, threshold)
    if not fresh:
        return found
    more = similar_names(nodes, reduce(DataFrame.unionByName, fresh).distinct(), threshold)
    # A name may be both stored and new.
    return found.unionByName(more.select(found.columns)).dropDuplicates([*_NODE, *_CAND])


def _type_edges(
    types: DataFrame, known: DataFrame | None, threshold: float, index: RegistryIndex | None = None,
) -> DataFrame:
    """Similar names among the types themselves and towards known companies."""
    return cut_lineage(_near(types, [types], known, threshold, index))


def _unmatched(
    batch: DataFrame, own: list[DataFrame], known: DataFrame | None, threshold: float, index: RegistryIndex | None,
) -> DataFrame:
    """Types of a generation that match no leader before it, by key or by name."""
    before = own + ([known] if known is not None else [])
    keys = reduce(DataFrame.unionByName, [d.select(F.col("leader_key").alias("entity_key")) for d in before])
    open_ = cut_lineage(batch.join(keys, "entity_key", "left_anti"))
    near = _near(open_, own, known, threshold, index)
    return cut_lineage(open_.join(near.select(*_NODE), _NODE, "left_anti"))


def _first_per_key(types: DataFrame, known: DataFrame | None) -> DataFrame:
    """Leaders without fuzzy matching: the first type of every key not stored yet."""
    first = (
        types.groupBy("entity_key")
        .agg(F.min_by(F.struct("leader_name", *_CAND, "seq"), "seq").alias("w"))
        .select("entity_key", "w.*")
    )
    first = _leader_rows(first)
    if known is None:
        return first
    return first.join(known.select("leader_key"), "leader_key", "left_anti")


def _assign(
    rows: DataFrame, types: DataFrame, leaders: DataFrame, edges: DataFrame | None,
    columns: list[str], hot_rows: int,
) -> DataFrame:
    """Match of every record among the leaders that existed when it arrived."""
    by_key = leaders.select(
        F.col("leader_key").alias("entity_key"), F.col("leader_seq").alias("key_seq"),
        F.col("leader_name").alias("key_name"),
    )
    key_sizes = types.groupBy("entity_key").agg(F.sum("type_rows").alias("key_rows"))
    out = skew.attach(
        rows, key_sizes.join(by_key, "entity_key", "left"), ["entity_key"], "key_rows", hot_rows
    )
    if edges is not None:
        # Leaders near a name, best one so far after each arrival. A batch contributes few per
        # name (they are mutually dissimilar); the registry is folded into one row first.
        # Every name starts with an empty span for the time before its first leader.
        steps = (
            edges.join(leaders, _CAND)
            .groupBy(*_NODE, "leader_seq")
            .agg(F.min(_best()).alias("b"))
        )
        nodes = types.groupBy(*_NODE).agg(F.sum("type_rows").alias("node_rows"))
        start = nodes.select(
            *_NODE, F.lit(-2).cast("bigint").alias("leader_seq"),
            F.lit(None).cast(steps.schema["b"].dataType).alias("b"),
        )
        by_time = W.partitionBy(*_NODE).orderBy("leader_seq")
        spans = start.unionByName(steps).select(
            *_NODE,
            F.col("leader_seq").alias("from_seq"),
            F.lead("leader_seq").over(by_time).alias("to_seq"),
            F.min("b").over(by_time.rowsBetween(W.unboundedPreceding, 0)).alias("b"),
            F.count("*").over(W.partitionBy(*_NODE)).alias("spans"),
        ).join(nodes, _NODE)
        inside = (F.col("seq") > F.col("from_seq")) & (
            F.col("to_seq").isNull() | (F.col("seq") <= F.col("to_seq"))
        )
        out = skew.attach(out, spans, _NODE, "node_rows", hot_rows, on=inside, fanout="spans")
    else:
        out = out.withColumn(
            "b", F.lit(None).cast("struct<neg_score: double, leader_name: string, leader_key: string>")
        )
    key_hit = F.coalesce(F.col("key_seq") < F.col("seq"), F.lit(False))
    match_type = (
        F.when(key_hit & F.col("phone_key").isNotNull(), "phone")
        .when(F.col("b").isNotNull(), "fuzzy")
        .when(key_hit, "key")
    )
    fuzzy = F.col("match_type") == "fuzzy"
    return out.withColumn("match_type", match_type).select(
        *columns, "stored_name", "in_norm", "in_form",
        F.when(fuzzy, F.col("b.leader_key")).otherwise(F.col("entity_key")).alias("resolved_key"),
        "match_type",
        F.when(fuzzy, F.col("b.leader_name")).when(F.col("match_type").isNotNull(), F.col("key_name"))
        .alias("matched_name"),
        F.when(fuzzy, -F.col("b.neg_score")).alias("fuzzy_score"),
    )


def _near_lines(resolution: Resolution, least: float) -> DataFrame:
    """Open records with every leader before them that scores at least ``least``."""
    open_rows = resolution.records.where(
        F.coalesce(F.col("match_type") != "phone", F.lit(True))
    ).select("seq", "company_name", "in_form", "in_norm")
    nodes = open_rows.groupBy(*_NODE).agg(F.count("*").alias("node_rows"))
    leaders = resolution.leaders.select("leader_name", "leader_seq", *_CAND)
    pairs = similar_names(nodes.select(*_NODE), leaders.select(*_CAND).distinct(), least)
    near = pairs.join(leaders, _CAND).withColumn(
        "near", F.count("*").over(W.partitionBy(*_NODE))
    ).join(nodes, _NODE)
    earlier = F.col("leader_seq") < F.col("seq")
    return skew.attach(open_rows, near, _NODE, "node_rows", on=earlier, fanout="near")


def review_log(
    resolution: Resolution, as_of, threshold: float = FUZZY_THRESHOLD, floor: float = REVIEW_FLOOR,
) -> DataFrame:
    """Comparisons of fuzzy-resolved records scoring at least ``floor``, or the threshold if that
    is lower, with both verdicts.

    Only comparisons the one-by-one run makes are listed: records not matched by phone,
    against leaders that existed before them. Pairs under the floor are not formed at all; how
    many there are of them is in :func:`review_counts`.
    """
    lines = _near_lines(resolution, min(floor, threshold))
    return lines.select(
        as_of_column(as_of).alias("timestamp"),
        F.lit("FUZZY_MATCH").alias("action"),
        F.col("company_name").alias("incoming_name"),
        F.col("in_norm").alias("incoming_normalized"),
        F.col("leader_name").alias("candidate_name"),
        F.col("cand_norm").alias("candidate_normalized"),
        "score",
        F.lit(int(threshold)).alias("threshold"),
        F.when(F.col("score") >= F.lit(float(threshold)), "matched").otherwise("not_matched").alias("verdict"),
    )


def review_counts(
    resolution: Resolution, threshold: float = FUZZY_THRESHOLD,
) -> DataFrame:
    """``seq, comparisons, matched, not_matched`` of every record not matched by phone.

    ``comparisons`` is what the one-by-one run scores: companies of the record's prefix block that
    exist when it arrives. It is a running count of leaders along (prefix, arrival), so no pair is
    formed; leaders that arrived together count as one event. ``matched`` is the number of
    lines of :func:`review_log` at or above the threshold.
    """
    open_rows = resolution.records.where(F.coalesce(F.col("match_type") != "phone", F.lit(True)))
    asks = open_rows.select(name_prefix(F.col("in_norm")).alias("prefix"), "seq").withColumn("turn", F.lit(0)).withColumn("n", F.lit(0).cast("bigint"))
    # Short names stand against longer prefixes: at most four lengths.
    lengths = [r[0] for r in asks.select(F.length("prefix").alias("l")).distinct().collect()]
    cand = resolution.leaders.select("cand_norm", "leader_seq")
    fits = F.filter(F.array(*[F.lit(k) for k in sorted(lengths)]).cast("array<int>"), lambda k: k <= F.length("cand_norm"))
    led = (
        cand.select(F.explode(F.transform(fits, lambda k: F.substring("cand_norm", F.lit(1), k))).alias("prefix"), F.col("leader_seq").alias("seq"))
        .groupBy("prefix", "seq").agg(F.count("*").alias("n"))
    )
    # A record that founds a company is not compared with itself: at equal arrival it asks first.
    events = asks.unionByName(led.withColumn("turn", F.lit(1)).select(asks.columns))
    counted = running_sum(events, "prefix", ["seq", "turn"], F.col("n"), "comparisons").where("turn = 0").select("seq", "comparisons")
    hits = _near_lines(resolution, threshold).groupBy("seq").agg(F.count("*").alias("matched"))
    both = counted.join(hits, "seq", "left").withColumn("matched", F.coalesce("matched", F.lit(0)))
    return both.withColumn("not_matched", F.col("comparisons") - F.col("matched"))


def review_lines(log: DataFrame) -> DataFrame:
    """Pipe-separated text lines of the review log (pipes inside names escaped)."""
    escaped = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("|"), F.lit("\\|"))
    cells = {
        "timestamp": F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"),
        "action": F.col("action"),
        "score": F.format_string("%.1f", "score"),
        "threshold": F.col("threshold").cast("string"),
        "verdict": F.col("verdict"),
    }
    line = F.concat_ws("|", *[cells.get(c, escaped(c)) for c in REVIEW_LOG_COLUMNS])
    return log.select(line.alias("value"))
