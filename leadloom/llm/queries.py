"""The numbered queries over the given tables, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import (
    bpe, discriminant, html_text, line_dedup, lm_score, manifest, mixing, ngram_join, quality,
    secret_scan, topk, toxicity, turn_trie,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BYTE_RANKS = "byte_bpe_50k.tiktoken"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query("op2_lm_score")
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


@query("op3_bpe")
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path(BYTE_RANKS)
    return bpe.digests(bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("stratum")


LINES_SQL = r"""
WITH l AS MATERIALIZED (
  SELECT doc_id, i AS number, line, list_distinct(regexp_extract_all(
      translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS s,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n_words
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)
), sets AS MATERIALIZED (
  SELECT list_sort(s) AS s, len(s) AS n, min((doc_id, number)) AS first, row_number() OVER () AS k
  FROM l WHERE n_words >= 1 GROUP BY list_sort(s), len(s)
), each AS MATERIALIZED (
  SELECT k, n, unnest(s) AS x FROM sets
), rare AS MATERIALIZED (
  -- Frequent words join last; sets at 4/5 share one of their rarest n - ceil(4n/5) + 1 words.
  SELECT k, n, x FROM (SELECT k, n, x, row_number() OVER (PARTITION BY k ORDER BY c, x) AS r
    FROM each JOIN (SELECT x, count(*) AS c FROM each GROUP BY x) USING (x)) WHERE r <= n - ceil(0.8 * n) + 1
), candidates AS MATERIALIZED (
  SELECT DISTINCT a.k AS a, b.k AS b FROM rare a JOIN rare b ON a.x = b.x AND a.k <> b.k AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), later AS MATERIALIZED (
  SELECT DISTINCT b.k FROM candidates JOIN sets a ON a.k = candidates.a JOIN sets b ON b.k = candidates.b
  WHERE a.first < b.first AND 5 * len(list_intersect(a.s, b.s)) >= 4 * (a.n + b.n - len(list_intersect(a.s, b.s)))
), judged AS (
  SELECT l.doc_id, l.number, l.line, coalesce(s.k IN (SELECT k FROM later) OR (l.doc_id, l.number) <> s.first, false) AS removed
  FROM l LEFT JOIN sets s ON l.n_words >= 1 AND list_sort(l.s) = s.s
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY number) FILTER (NOT removed), '') AS text, count_if(removed)::INT AS n_removed
FROM judged GROUP BY doc_id
"""


@query("op5_line_dedup", LINES_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


MIX_SQL = r"""
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('mix:' || doc_id) AS shuffle FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sums
), filling(done, target) AS (
  -- Share by weight again and again: whoever would exceed its limit is set to it.
  SELECT [0]::BIGINT[], 0.0::DOUBLE
  UNION ALL
  SELECT list_concat(f.done, n.places), f.target FROM filling f, LATERAL (
    SELECT list(r.place) AS places FROM ranked r, (
      SELECT (1.5 * (SELECT sum(source_size) FROM ranked)
              - coalesce(sum(2 * source_size) FILTER (list_contains(f.done, place)), 0))
        / sum(weight) FILTER (NOT list_contains(f.done, place)) AS level FROM ranked) l
    WHERE NOT list_contains(f.done, r.place) AND l.level * r.weight > 2 * r.source_size) n
  WHERE n.places IS NOT NULL
), final AS (
  SELECT done FROM filling ORDER BY len(done) DESC LIMIT 1
), level AS (
  SELECT (1.5 * sum(source_size) - coalesce(sum(2 * source_size) FILTER (list_contains(done, place)), 0))
    / sum(weight) FILTER (NOT list_contains(done, place)) AS level FROM ranked, final
), targets AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, level * weight) AS target FROM ranked, level
), runs AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST, shuffle, doc_id, size) AS row,
    sum(size) OVER (PARTITION BY source ORDER BY shuffle, doc_id, size ROWS UNBOUNDED PRECEDING) AS used FROM sized
), queue AS (
  SELECT row, size, sum(size) OVER (ORDER BY (pass * source_size + used) / target, row, pass ROWS UNBOUNDED PRECEDING) AS upto
  FROM runs JOIN targets ON runs.source IS NOT DISTINCT FROM targets.source, (VALUES (0), (1)) p(pass) WHERE size > 0
), taken AS (
  SELECT row, sum(greatest(least(size, (SELECT sum(round(target)) FROM targets) - (upto - size)), 0)) AS taken FROM queue GROUP BY row
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM runs JOIN targets ON runs.source IS NOT DISTINCT FROM targets.source LEFT JOIN taken USING (row)
"""


@query("op6_mixing", MIX_SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.word_count("text")).plan.select("doc_id", "size", "source_size", "target", "taken")


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), each AS MATERIALIZED (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.component_id
FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = s.doc_id
"""


@query("op7_ngram_join", NEAR_SQL)
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.digests(secret_scan.scan(docs, secret_scan.fit(docs)))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_from_labels(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(toxicity.fold("doc_id") == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT * FROM (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
  FROM scored) WHERE rank <= 10
"""


@query("op10_topk", TOPK_SQL)
def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def crc_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text in SQL: eight shifts a byte, with the reversed polynomial."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    byte = "list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce({codes}, lambda a, c: {byte}, 4294967295::BIGINT), 4294967295)"


def _leaf_sql(n_chars: str) -> str:
    framed = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("doc_id::VARCHAR", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(framed)})"


def _levels_sql(name: str, base: str) -> str:
    """Levels of the trees over the lists ``hs`` of ``base(g, hs)``: pairs hashed until one is left."""
    return f"""
{name}_up(g, lvl, hs) AS (
  SELECT g, 0, hs FROM {base}
  UNION ALL
  SELECT g, lvl + 1, list_transform(range(0, (len(hs) + 1) // 2), lambda i: sha256(array_to_string(hs[(2 * i + 1)::INT:(2 * i + 2)::INT], '')))
  FROM {name}_up WHERE len(hs) > 1
), {name} AS MATERIALIZED (
  SELECT g, list(hs ORDER BY lvl) AS levels, last(hs ORDER BY lvl)[1] AS top FROM {name}_up GROUP BY g
)"""


def _path_sql(levels: str, i: str) -> str:
    return f"""list_transform(range(1, len({levels})), lambda l: {{'other': {levels}[l::INT][(xor({i} >> (l - 1)::INT, 1) + 1)::INT],
    'right': ({i} >> (l - 1)::INT) & 1 = 0}})"""


MANIFEST_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf_sql('n_chars::VARCHAR')} AS leaf,
    CASE WHEN {crc_sql('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)::VARCHAR')} END AS changed FROM documents
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves
), lists AS (SELECT lang AS g, list(leaf ORDER BY i) AS hs FROM placed GROUP BY lang),
{_levels_sql('trees', 'lists')},
langs AS MATERIALIZED (SELECT g AS lang, top AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS j FROM trees),
tops AS (SELECT 0 AS g, list(subroot ORDER BY j) AS hs FROM langs HAVING count(*) > 0),
{_levels_sql('crown', 'tops')},
walks AS (
  SELECT p.*, l.subroot, c.top AS root, list_concat({_path_sql('t.levels', 'p.i')}, {_path_sql('c.levels', 'l.j')}) AS path
  FROM placed p JOIN trees t ON p.lang IS NOT DISTINCT FROM t.g JOIN langs l ON p.lang IS NOT DISTINCT FROM l.lang, crown c
), folded AS (
  SELECT *, sha256(array_to_string(list_transform(path, lambda s: coalesce(s.other, '')), '')) AS proof_sha256,
    list_reduce(path, lambda h, s: sha256(CASE WHEN s.other IS NULL THEN h WHEN s.right THEN h || s.other ELSE s.other || h END), coalesce(changed, leaf)) AS folded_root
  FROM walks
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""


@query("op11_merkle_manifest", MANIFEST_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = manifest.document_leaves(table(spark, sf_dir, "documents"), tampered)
    return manifest.verify(manifest.manifest(leaves))


TRIE_SQL = rf"""
WITH t AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, {crc_sql('conv_id::VARCHAR')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)
), turns AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
), whole AS (
  SELECT c.conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY part, pos) FILTER (part IS NOT NULL), []) AS s
  FROM convs c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id
), prefixes AS MATERIALIZED (
  SELECT conv_id, d, len(s) AS n, sha256(to_json(s[1:d])::VARCHAR) AS k, CASE WHEN d > 0 THEN len(regexp_extract_all(s[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1))::INT AS d FROM whole)
), nodes AS MATERIALIZED (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256 FROM prefixes GROUP BY d, k
), under AS MATERIALIZED (
  SELECT DISTINCT a.d, a.k, b.d AS d2, b.k AS k2 FROM prefixes a JOIN prefixes b ON a.conv_id = b.conv_id AND b.d >= a.d
), kids AS MATERIALIZED (
  SELECT d, k, count(*) FILTER (d2 = d + 1) AS n_children FROM under GROUP BY d, k
), sums AS (
  SELECT u.d, u.k, sum((n.n_convs - 1) * n.w)::BIGINT AS saved_tokens, count(*) FILTER (c.n_children = 0) AS n_leaves
  FROM under u JOIN nodes n ON n.d = u.d2 AND n.k = u.k2 JOIN kids c ON c.d = u.d2 AND c.k = u.k2 GROUP BY u.d, u.k
), ups AS (
  SELECT u.d2 AS d, u.k2 AS k, n.conv_id AS parent_conv_id FROM under u JOIN nodes n ON n.d = u.d AND n.k = u.k WHERE u.d2 = u.d + 1
)
SELECT conv_id, n.d::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
FROM nodes n JOIN kids USING (d, k) JOIN sums USING (d, k) LEFT JOIN ups USING (d, k)
"""


@query("op13_turn_trie", TRIE_SQL)
def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turn_trie.turn_rows(table(spark, sf_dir, "conversations"))
    base = F.col("conv_id") - F.col("conv_id") % 20
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    nodes, ends = turn_trie.trie(*turn_trie.rebuilt(rows, base, head, 3))
    none = F.sha2(F.lit("").cast("binary"), 256)
    found = nodes.join(turn_trie.end_digests(ends), "key", "left").drop("key")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", none))


@query("op12_quality_discriminant")
def op12_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discriminant.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
