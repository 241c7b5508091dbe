"""Near duplicates by shingles and by lines, against all pairs."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadloom.llm import components as C
from leadloom.llm import line_dedup, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(rows):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                label[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def edited(rnd, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rnd.randrange(len(out))] = f"x{rnd.randrange(10 ** 6)}"
    return out


def corpus(seed):
    """Copies, near copies around the threshold, a shared passage, and odd texts."""
    rnd = random.Random(seed)
    fresh = lambda n: [f"w{rnd.randrange(10 ** 5)}" for _ in range(n)]
    texts = [None, "", " \n ", "one", "One", "one two", "a b c d", "A b C d", "a b c d e"]
    for size in (5, 6, 9, 14, 30, 60, 150, 400):
        base = fresh(size)
        texts += [" ".join(edited(rnd, base, e)) for e in (0, 0, 1, 1, 2, 3, 5) for _ in range(2)]
        texts += [" ".join(base + fresh(max(1, size // k))) for k in (2, 3, 4, 5)]
    hot = fresh(80)
    texts += [" ".join(edited(rnd, hot, rnd.randrange(3))) for _ in range(50)]
    passage = fresh(60)
    texts += [" ".join(fresh(rnd.randrange(10, 80)) + passage + fresh(10)) for _ in range(50)]
    texts += [" ".join(passage + fresh(rnd.randrange(0, 12))) for _ in range(25)]
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    return rows + [(5, "one two"), (5, "one two"), (None, " ".join(hot)), (2000, "v" * 700_000 + " a b"), (2001, "V" * 700_000 + " a b")]


@pytest.mark.parametrize("hot", [2, 16])
def test_components_against_all_pairs(docs, clashing, monkeypatch, hot):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "meet", lambda f, own=ngram_join.meet: own(f, hot))
    rows = corpus(hot)
    found = ngram_join.join(clashing(docs(rows)).repartition(3)).collect()
    assert sorted(map(tuple, found), key=str) == groups(rows)


def test_small_limits_change_nothing(docs, monkeypatch):
    for name, value in (("BUCKET_ENTRIES", 3000), ("FLUSH", 2000), ("BROADCAST_IDS", 0), ("PAIRS_PER_SALT", 2)):
        monkeypatch.setattr(ngram_join, name, value)
    rows = corpus(11)
    assert sorted(map(tuple, ngram_join.join(docs(rows)).collect()), key=str) == groups(rows)


def test_empty_and_single(docs):
    assert ngram_join.join(docs([])).collect() == []
    assert [tuple(r) for r in ngram_join.join(docs([(4, None)])).collect()] == [(4, 0, 4)]


def test_similar_sets_share_enough_signatures():
    import numpy as np

    rnd = random.Random(8)
    for _ in range(300):
        n = rnd.randrange(1, 200)
        a = np.array(sorted([rnd.getrandbits(63) for _ in range(n)]), np.uint64) * np.uint64(2)
        a = np.unique(a)
        edits = rnd.randrange(0, n // 3 + 1)
        b = np.unique(np.concatenate((a[rnd.randrange(0, edits + 1):], np.array([rnd.getrandbits(63) for _ in range(rnd.randrange(0, edits + 1))], np.uint64))))
        shared = len(np.intersect1d(a, b))
        if 4 * shared < 3 * (len(a) + len(b) - shared):
            continue
        common = set(ngram_join.schemes(len(a))) & set(ngram_join.schemes(len(b)))
        assert common
        for scheme in common:
            (ka, fa), (kb, fb) = ngram_join.signatures(a, scheme), ngram_join.signatures(b, scheme)
            assert len(np.intersect1d(ka, kb)) >= max(1, max(fa, fb) - (len(a) + len(b)) // 7)


def test_components_of_paths_stars_and_rings(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(400, 480)] + [(i, 900 + (i - 899) % 30) for i in range(900, 930)] + [(7, 7), (-5, 3), (3, -5)]
    rnd.shuffle(edges)
    found = dict(map(tuple, C.components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()))
    want = {i: 100 for i in range(100, 141)} | {i: 400 for i in [*range(400, 480), 500]} | {i: 900 for i in range(900, 930)} | {-5: -5, 3: -5}
    assert found == want
    assert C.components(spark.createDataFrame([], "a BIGINT, b BIGINT")).collect() == []


# --- lines ------------------------------------------------------------------------------------


def without_repeats(rows, least=1):
    lines = []
    for d, t in set(rows):
        for k, line in enumerate((t or "").split("\n")):
            w = words(line)
            if len(w) >= least:
                lines.append(((d is not None, d or 0, 0), k, frozenset(w), t))
    gone = {}
    for d, k, s, t in lines:
        for e, j, r, u in lines:
            if (e, j) < (d, k) and 5 * len(s & r) >= 4 * len(s | r):
                gone.setdefault((d, t), set()).add(k)
    out = []
    for d, t in rows:
        cut = gone.get(((d is not None, d or 0, 0), t), set())
        text = t if not cut else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut)
        out.append((d, text, len(cut)))
    return sorted(out, key=str)


def line_corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    line = lambda: [rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 14))]
    pool = [line() for _ in range(25)] + [rnd.sample(vocabulary, 40)]
    hot = rnd.sample(vocabulary, 12)
    rows = []
    for i in range(70):
        lines = []
        for _ in range(rnd.randrange(0, 6)):
            base = list(rnd.choice(pool)) if rnd.random() < 0.6 else line()
            if rnd.random() < 0.5:
                base[rnd.randrange(len(base))] = rnd.choice(vocabulary)
            lines.append(rnd.choice([" ", "  ", "\t"]).join(base).title() if rnd.random() < 0.2 else " ".join(base))
        if i % 3 == 0:
            lines.insert(0, " ".join(edited(rnd, hot, rnd.randrange(2))))
        rows.append((i * 7 % 71, "\n".join(lines)))
    return rows + [(200, None), (201, ""), (202, "\n\n"), (None, " ".join(hot)), (203, "z " * 30_000 + "\n" + " ".join(hot) + "\r\n" + "q" * 600_000)]


@pytest.mark.parametrize("direct", [2, 16])
def test_lines_against_all_pairs(docs, clashing, monkeypatch, direct):
    monkeypatch.setattr(line_dedup, "meet", lambda f, own=line_dedup.meet: own(f, direct))
    rows = line_corpus(direct)
    found = line_dedup.dedup(clashing(docs(rows)).repartition(3))
    assert sorted(map(tuple, found.select("doc_id", "text", "n_removed").collect()), key=str) == without_repeats(rows)


def test_line_limits_change_nothing(docs, monkeypatch):
    for name, value in (("BUCKET_ENTRIES", 50), ("CHUNK_BYTES", 300), ("CHUNK_LINES", 3), ("SLOTS", 16), ("BLOCK", 4), ("TOGETHER", 2), ("BROADCAST_IDS", 0), ("PAIRS_PER_SALT", 2)):
        monkeypatch.setattr(line_dedup, name, value)
    rows = line_corpus(5)
    found = line_dedup.dedup(docs(rows)).select("doc_id", "text", "n_removed").collect()
    assert sorted(map(tuple, found), key=str) == without_repeats(rows)


def test_alike_rows_and_shared_ids(docs):
    text = "one two three four five six\nshort line"
    rows = [(1, text), (1, text), (1, "other words stand here now"), (2, text), (2, "One two three four FIVE six\nunlike the line above it")]
    found = {tuple(r) for r in line_dedup.dedup(docs(rows), least_words=5).select("doc_id", "text", "n_removed").collect()}
    assert (1, text, 0) in found and (2, "short line", 1) in found and (2, "unlike the line above it", 1) in found
    assert line_dedup.dedup(docs([])).collect() == []
    assert [r.text for r in line_dedup.dedup(docs([(1, None)])).collect()] == [None]


def test_short_lines(docs):
    rows = [(1, "Click here now\nhome"), (2, "click HERE now\n\n\nown words"), (3, "Home\n1 2 3 4 5"), (4, "5 4 3 2 1")]
    for least in (1, 3, 5):
        found = line_dedup.dedup(docs(rows), least_words=least).select("doc_id", "text", "n_removed").collect()
        assert sorted(map(tuple, found), key=str) == without_repeats(rows, least)


def test_a_column_called_like_the_count_is_replaced(docs):
    rows = docs([(1, "a b c d e\na b c d e"), (2, "f")]).withColumn("n_removed", F.lit("x")).withColumn("numbers", F.lit("y"))
    out = line_dedup.dedup(rows)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "numbers", "n_removed"]
    assert {(r.doc_id, r.text, r.n_removed, r.numbers) for r in out.collect()} == {(1, "a b c d e", 1, "y"), (2, "f", 0, "y")}
    other = line_dedup.dedup(rows, name="__gone")
    assert {(r.doc_id, r.n_removed, r["__gone"]) for r in other.collect()} == {(1, "x", 1), (2, "x", 0)}


def test_columns_stay(docs):
    out = line_dedup.dedup(docs([(1, "a b c d e\na b c d e")]).withColumn("extra", F.lit(3)))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "n_removed"]
    assert out.first().text == "a b c d e"


def test_sets_too_late_at_their_word_are_not_tried(monkeypatch):
    tried = []
    monkeypatch.setattr(line_dedup, "_may_match", lambda a, i, b, j, own=line_dedup._may_match: tried.append(len(i)) or own(a, i, b, j))

    def met(places, sizes):
        about = np.array([(k + 1, (n << 40) | k, 0, 0) for k, n in enumerate(sizes)], np.int64)
        packed = {"bucket": [0], "keys": [b"common" * len(sizes)], "at": [np.arange(len(sizes), dtype=np.uint16).tobytes()],
                  "places": [np.array(places, np.uint32).tobytes()], "about": [about.tobytes()]}
        tried.clear()
        found = line_dedup.meet(pd.DataFrame(packed))
        return {(a, b) for a, b in zip(found["a"], found["b"], strict=True)}

    # Of ten words eight are left at place 2: too few for the nine that two such sets share.
    assert met([2] * 100, [10] * 100) == set() and sum(tried) == 0
    rnd = random.Random(3)
    for _ in range(20):
        sizes = [rnd.randrange(1, 30) for _ in range(60)]
        places = [rnd.randrange(n // 5 + 1) for n in sizes]
        fits = lambda x, y: 5 * min(sizes[x], sizes[y]) >= 4 * max(sizes[x], sizes[y]) and 9 * min(
            sizes[x] - places[x], sizes[y] - places[y]) >= 4 * (sizes[x] + sizes[y])
        expected = {(x + 1, y + 1) for x in range(60) for y in range(x + 1, 60) if fits(x, y)}
        assert met(places, sizes) == expected and sum(tried) == len(expected)
        monkeypatch.setattr(line_dedup, "TRIED", rnd.randrange(1, 200))


def test_pairs_are_verified_in_two_rounds(docs, monkeypatch):
    rounds = []
    monkeypatch.setattr(line_dedup, "meet", lambda f, own=line_dedup.meet: own(f, 2))
    monkeypatch.setattr(line_dedup, "_verified", lambda *a, own=line_dedup._verified: rounds.append(1) or own(*a))
    rows = line_corpus(2)
    found = line_dedup.dedup(docs(rows)).select("doc_id", "text", "n_removed").collect()
    assert sorted(map(tuple, found), key=str) == without_repeats(rows) and len(rounds) == 2


def test_a_line_in_many_pairs_is_asked_for_in_pieces(docs, monkeypatch):
    monkeypatch.setattr(line_dedup, "PAIRS_PER_SALT", 5)
    longest = []
    own = line_dedup.stored

    def spy(df):
        out = own(df)
        if "wanted" in out.columns:
            longest.append(out.selectExpr("max(size(wanted))").first()[0])
        return out

    monkeypatch.setattr(line_dedup, "stored", spy)
    rows = docs([(i, f"a b c d e f g h i {i}") for i in range(100)]).selectExpr("doc_id", "0L AS version", "CAST(text AS BINARY) AS bytes")
    firsts = rows.selectExpr("doc_id", "version", "0 AS number", "doc_id AS node")
    pairs = rows.where("doc_id < 99").selectExpr("doc_id AS a", "99L AS b")
    assert {tuple(r) for r in line_dedup._verified(pairs, rows, firsts).collect()} == {(i, 99) for i in range(99)}
    assert longest[0] <= 30
