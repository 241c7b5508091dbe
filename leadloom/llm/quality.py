"""Quality rules whose cutoffs have a certified limit on false rejections. Built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leadloom.llm.shared import stored

# Fixed values.
SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30

# Strata, by language; all others, NULL included, are one more.
STRATA = ("de", "en", "es", "fr")
OTHER = "other"
# Cutoffs to choose from, lenient to strict, as shares.
GRID = tuple(round(1.25 ** -i, 6) for i in range(0, 28))
RULES = ("symbols", "dup_lines", "repeats")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the same text.

    Windows are compared by 64-bit hash. Only texts with a repeated hash look for the places:
    hashes sorted with their places, those equal to a neighbour, and the union of their windows.
    """
    n = F.size(words)
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))

    def union(sorted_pairs: Column) -> Column:
        same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
        twice = F.filter(sorted_pairs, lambda e, j: same(F.get(sorted_pairs, j - 1), e) | same(F.get(sorted_pairs, j + 1), e))
        places = F.sort_array(F.transform(twice, lambda e: e["i"]))
        first = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("covered"))
        return F.aggregate(places, first, lambda acc, i: F.struct(
            i.alias("last"), (acc["covered"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("bigint").alias("covered")),
            lambda acc: acc["covered"])

    def count(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(
            _let(F.sort_array(pairs), union))

    return _let(hashes, count)


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    A NULL text has no words and only zero counts. One row per row, no shuffle.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES, -1))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    stratum = F.when(F.col(stratum_col).isin(*STRATA), F.col(stratum_col)).otherwise(OTHER)
    found = docs.select(
        F.col(id_col).alias("doc_id"), stratum.alias("stratum"),
        F.char_length(F.translate(text, SPACE, "")).cast("bigint").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")).alias("n_dup_lines"),
        _let(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), _repeated_words(w).alias("n_repeat_words"))).alias("w"),
    )
    found = found.select("doc_id", "stratum", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return found.withColumn("base_failed", base)


def rule_values() -> dict[str, Column]:
    """What each rule looks at; higher is worse, between 0 and 1."""
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return {"symbols": F.least(share("n_symbols", "word_chars"), F.lit(1.0)),
            "dup_lines": F.least(share("n_dup_lines", "n_words"), F.lit(1.0)),
            "repeats": share("n_repeat_words", "n_words")}


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial(n, p): the exact sum, its terms followed as logarithms."""
    import math

    odds = math.log(p / (1 - p))
    first = F.struct((n * math.log1p(-p)).alias("term"), F.exp(n * math.log1p(-p)).alias("sum"))
    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("bigint"), k.cast("bigint"))).otherwise(F.array().cast("array<bigint>"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))

    return F.aggregate(steps, first, add, lambda acc: acc["sum"])


def cutoffs(holdout: DataFrame, alpha: float = 0.02, delta: float = 0.05) -> DataFrame:
    """``stratum, rule, cutoff, n, k``: strictest certified cutoff per stratum and rule.

    ``holdout``: features of documents labelled good that pass the base rules. A rule rejects
    values above its cutoff. With confidence ``1 - delta`` for all strata and rules together, no
    stratum loses more than a share ``alpha`` of its good documents: each rule may reject
    ``alpha / rules`` of them; a cutoff is certified when seeing so few rejected, k of n, would
    have probability at most ``delta / (strata * rules)`` at that rate (exact binomial bound,
    corrected for every stratum and rule). Along the grid cutoffs are tested from lenient to
    strict up to the first that fails, which needs no further correction. No certified cutoff:
    no row, and the rule is off in that stratum.

    The result has at most ``len(STRATA) + 1`` times ``len(RULES)`` rows.
    """
    level, limit = delta / ((len(STRATA) + 1) * len(RULES)), alpha / len(RULES)
    # Number of grid cutoffs below the value: those are the ones that reject it.
    reached = lambda v: sum((F.when(v > c, 1).otherwise(0) for c in GRID), F.lit(0))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), reached(v).alias("reached")) for r, v in rule_values().items()]))
    binned = holdout.select("stratum", each.alias("e")).groupBy("stratum", "e.rule", "e.reached").count()
    # From here on there is one row per (stratum, rule, grid step).
    steps = F.explode(F.array(*[F.struct(F.lit(j).alias("step"), F.lit(c).alias("cutoff")) for j, c in enumerate(GRID)]))
    cell = binned.groupBy("stratum", "rule").agg(F.sum("count").alias("n"), F.collect_list(F.struct("reached", "count")).alias("bins"))
    # GRID falls, so step j rejects a value when more than len(GRID) - 1 - j cutoffs lie below it.
    k = F.aggregate(F.filter("bins", lambda b: b["reached"] >= len(GRID) - F.col("s.step")), F.lit(0).cast("bigint"), lambda a, b: a + b["count"])
    tested = cell.select("stratum", "rule", "n", "bins", steps.alias("s")).select("stratum", "rule", "n", k.alias("k"), "s.step", "s.cutoff")
    # At or above the expected number the probability is about a half: certainly not certified.
    hopeless = F.col("k") >= limit * F.col("n")
    p = F.when(hopeless, F.lit(1.0)).otherwise(binomial_cdf(F.when(hopeless, F.lit(0)).otherwise(F.col("k")), F.col("n"), limit))
    order = W.partitionBy("stratum", "rule").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    passed = tested.withColumn("sound", F.min(p <= level).over(order)).where("sound")
    best = passed.groupBy("stratum", "rule").agg(F.max_by(F.struct("cutoff", "n", "k"), "step").alias("b"))
    return best.select("stratum", "rule", "b.cutoff", "b.n", "b.k")


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
    alpha: float = 0.02, delta: float = 0.05,
) -> DataFrame:
    """Features of every document with ``kept``: false where a base rule or a certified rule rejects.

    ``labels``: ``doc_id, quality`` (1 is good); other labels and unlabelled documents play no
    part in choosing cutoffs. The features are stored once and read twice. Repeated ids are
    judged row by row; an empty table gives an empty result.
    """
    found = stored(features(docs, id_col, text_col, stratum_col))
    good = labels.where("quality = 1").select("doc_id").distinct()
    chosen = cutoffs(found.where("NOT base_failed").join(good, "doc_id", "left_semi"), alpha, delta)
    # At most (strata) rows with one cutoff per rule: bounded whatever the input, so broadcast.
    wide = chosen.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"__{r}") for r in RULES])
    rejected = [F.coalesce(v > F.col(f"__{r}"), F.lit(False)) for r, v in rule_values().items()]
    verdict = ~(F.col("base_failed") | rejected[0] | rejected[1] | rejected[2])
    return found.join(F.broadcast(wide), "stratum", "left").select(*found.columns, verdict.alias("kept"))
