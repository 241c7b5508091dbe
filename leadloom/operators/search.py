"""Substring search in company names through trigram postings.

A name that contains a term contains all its trigrams. The postings of a term's rarest trigrams are
intersected and what is left is verified with ``contains``; common trigrams are not read. Terms of
fewer than three characters have none: their names are found by one scan that compares equal pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

GRAM = 3
# Trigrams of a term that are intersected. Any number gives the same names.
RAREST = 3


def _pieces(text: Column, size: int) -> Column:
    """Distinct substrings of a length."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))


def name_postings(companies: DataFrame, key: str = "dedup_key", name: str = "company_name") -> DataFrame:
    """``gram, dedup_key``: the trigrams of every lower-cased name."""
    return companies.select(F.explode(_pieces(F.lower(name), GRAM)).alias("gram"), F.col(key).alias("dedup_key"))


def find_names(terms: DataFrame, companies: DataFrame, postings: DataFrame) -> DataFrame:
    """``term, dedup_key, company_name`` of all names containing a term, any case.

    terms: distinct ``term``; companies: ``dedup_key, company_name``; an empty term is in every name, a
    NULL one in none.
    """
    wanted = terms.where("term IS NOT NULL").select("term", F.lower("term").alias("low"))
    grams = wanted.where(F.length("low") >= GRAM).select("term", F.explode(_pieces(F.col("low"), GRAM)).alias("gram"))
    # How often the asked trigrams occur: one row per trigram of the terms.
    asked = grams.select("gram").distinct()
    sizes = postings.join(asked, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy("term").orderBy("n", "gram"))
    # A trigram that no name has comes first: the term has no names then.
    rare = grams.join(sizes, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("rank", rank)
    rare = rare.where(F.col("rank") <= RAREST).withColumn("of", F.count("*").over(W.partitionBy("term"))).select("term", "gram", "of")
    shared = postings.join(rare, "gram").groupBy("term", "of", "dedup_key").agg(F.count("*").alias("n")).where("n = of")
    names = companies.select("dedup_key", "company_name")
    hits = shared.select("term", "dedup_key").join(names, "dedup_key").where(F.contains(F.lower("company_name"), F.lower("term")))
    found = hits.select("term", "dedup_key", "company_name")
    short = wanted.where(F.length("low") < GRAM)
    sizes_asked = sorted(r[0] for r in short.select(F.length("low").alias("n")).distinct().collect())  # at most 0, 1 and 2
    if not sizes_asked:
        return found
    lowered = F.lower("company_name")
    pieces = F.concat(*[_pieces(lowered, n) if n else F.when(lowered.isNotNull(), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")) for n in sizes_asked])
    scanned = names.select("dedup_key", "company_name", F.explode(pieces).alias("low")).join(short, "low")
    return found.unionByName(scanned.select("term", "dedup_key", "company_name"))
