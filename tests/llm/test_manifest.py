import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from leadloom.llm import manifest as M
from leadloom.llm.ordered import running


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = (doc_id, source, lang, n_chars, text)
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def tree(hashes):
    """Top of a tree and, per leaf, the (left, right) siblings on the way up."""
    level, where = list(hashes), list(range(len(hashes)))
    paths = [[] for _ in hashes]
    while len(level) > 1:
        for path, i in zip(paths, where):
            other = level[i ^ 1] if i ^ 1 < len(level) else None
            path.append((other, None) if i & 1 else (None, other))
        level = [H(*level[i:i + 2]) for i in range(0, len(level), 2)]
        where = [i >> 1 for i in where]
    return level[0], paths


def truth(rows):
    low = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (low(r[0]), leaf(*r))) for x in langs}
    trees = {x: tree([leaf(*r) for r in own[x]]) for x in langs}
    root, over = tree([trees[x][0] for x in langs])
    out = []
    for x, up in zip(langs, over):
        for r, path in zip(own[x], trees[x][1]):
            whole = path + up
            start = leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                start = leaf(*r[:4], r[4] + 1)
            h = start
            for a, b in whole:
                h = H(a or "", h, b or "")
            out.append((r[0], leaf(*r), trees[x][0], root, H(*[(a or "") + (b or "") for a, b in whole]), h, h == root))
    return out


def got(spark, rows, digits=2, extra=None):
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    df = extra(df) if extra else df
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = M.verify(M.manifest(M.document_leaves(df, tampered), digits))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.collect()), key=str)


def make(n, lang, start=0):
    return [(start + i, f"text é {i}" * (i % 3), lang, "s", i) for i in range(n)]


@pytest.mark.parametrize("rows", [
    make(1, "en"), make(4, "en"), make(5, "en"), make(16, "en") + make(17, "de", 50) + make(3, "fr", 90) + make(1, "it", 99) + make(1, None, 70) + make(2, "zz", 80),
    make(67, "en") + make(64, "de", 100),
])
def test_trees_of_all_shapes(spark, rows):
    assert got(spark, rows) == sorted(truth(rows), key=str)


def test_production_digits(spark):
    rows = make(70, "en") + make(3, "de", 100)
    assert got(spark, rows, M.DIGITS) == sorted(truth(rows), key=str)


def test_nulls_ties_and_repeated_rows(spark, clashing):
    rows = [(None, None, None, None, None), (None, "a", "en", None, 1), (None, "b", "en", "s", 1), (7, "", "", "", 0),
            (3, "x", "en", "s", 2**63 - 1), (14, "y" * 5000, "en", "s", None)] + [(5, "copy", "en", "s", 4)] * 40
    assert got(spark, rows, extra=clashing) == sorted(truth(rows), key=str)


def test_many_languages(spark):
    rows = [(i, "t", f"l{i}", "s", 1) for i in range(21)]
    assert got(spark, rows) == sorted(truth(rows), key=str)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_tampering_shows_exactly_where_it_happened(spark):
    rows = make(40, "en")
    bad = {r[0] for r in got(spark, rows) if not r[-1]}
    assert bad == {i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 0}


def test_running_values_over_a_group_of_most_rows(spark):
    rows = [(g, i, i % 5) for g, n in ((None, 3), ("a", 2), ("b", 300), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "g STRING, o BIGINT, v BIGINT").repartition(7)
    out = running(df, ["g"], ["o"], total=("sum", F.col("v")), mixed=("xor", F.col("v") * 3 + F.col("o")))
    for g in (None, "a", "b", "c"):
        own = sorted((r.o, r.v, r.total, r.mixed) for r in out.collect() if r.g == g)
        total = mixed = 0
        for o, v, t, x in own:
            total, mixed = total + v, mixed ^ (v * 3 + o)
            assert (t, x) == (total, mixed)
    assert out.count() == len(rows)
