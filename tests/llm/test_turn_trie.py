import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from leadloom.llm import turn_trie as T

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def words(text):
    return len([w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w])


def rebuild(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + v[h:]
    return out


def truth(rows):
    convs = rebuild(rows)
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    out = []
    for node, own in members.items():
        below = [n for n in members if n[:len(node)] == node]
        kids = [n for n in below if len(n) == len(node) + 1]
        leaf = lambda n: not any(m[:len(n)] == n and len(m) == len(n) + 1 for m in members)
        saved = sum((len(members[n]) - 1) * words(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(node))
        out.append((own[0], len(node), members[node[:-1]][0] if node else None, len(own), len(kids), sum(map(leaf, below)), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, block=T.BLOCK, extra=None):
    df = spark.createDataFrame(rows, SCHEMA)
    df = extra(df) if extra else df
    base = F.col("conv_id") - F.col("conv_id") % 20
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    nodes, ends = T.trie(*T.rebuilt(T.turn_rows(df), base, head, 3), block)
    found = nodes.join(T.end_digests(ends), "key", "left").fillna(hashlib.sha256(b"").hexdigest(), ["ends_sha256"])
    return sorted(map(tuple, found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def random_rows(seed, convs, most, texts):
    rng = random.Random(seed)
    return [(c, i if rng.random() < 0.9 else i * 10, rng.choice(["user", "bot"][: 1 + seed % 2]), rng.choice(texts))
            for c in rng.sample(range(200), convs) for i in range(rng.randint(1, most))]


def test_equals_brute_force(spark):
    rows = random_rows(1, 60, 9, ["a", "b c", "d e f"])
    assert got(spark, rows) == truth(rows)
    rows = random_rows(2, 40, 14, ["x", "y z"])
    assert got(spark, rows, block=3) == truth(rows)


def test_absent_base_turnless_and_single_turns(spark):
    rows = [(c, 0, "user", "only turn") for c in (21, 22, 23, 24, 25, 26)] + [(40, 1, "user", "first"), (41, 1, "user", "own"), (41, 2, "bot", "own two")]
    assert any(not v for v in rebuild(rows).values())
    assert got(spark, rows) == truth(rows)


def test_nulls_repeated_rows_long_texts_and_clashing_names(spark, clashing):
    rows = [(0, None, None, None), (0, 1, "", ""), (1, None, None, "t"), (None, 1, "user", "lost"), (3, 2, "user", "w " * 30000), (5, 2, "user", "w " * 30000)]
    rows += [(7, 1, "user", "copy")] * 30 + [(9, 1, "user", "copy")] * 30
    more = lambda df: clashing(df).withColumns({c: F.lit(1) for c in ("words", "t", "pos", "part", "q", "p", "blk", "depth", "c", "h", "of", "w", "end", "steps", "own", "leaf")})
    assert got(spark, rows, extra=more) == truth(rows)


def test_empty_table(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "user", "x")]) == []


def test_copies_of_one_conversation_and_one_long_one(spark):
    rows = [(c, i, "user", f"turn {i}") for c in range(1000, 2300) for i in range(2)]
    rows += [(0, i, "user", f"step {i % 5}") for i in range(120)] + [(2, i, "user", f"step {i % 5}") for i in range(118)]
    assert got(spark, rows) == truth(rows)


def test_pieces_stream_into_one_digest(spark):
    ids = list(range(0, 3 * T.PIECE + 7))
    ends = spark.createDataFrame([("k", 3 * i) for i in ids] + [("l", 5)], "key STRING, conv_id BIGINT").repartition(9)
    found = {r.key: r.ends_sha256 for r in T.end_digests(ends).collect()}
    assert found == {"k": hashlib.sha256(",".join(str(3 * i) for i in ids).encode()).hexdigest(), "l": hashlib.sha256(b"5").hexdigest()}
