import random
import re
from collections import Counter
from math import comb

from leadloom.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_features_against_brute_force(docs, clashing):
    rnd = random.Random(2)
    texts = [None, "", " \n\t\x0b\f\r ", "a", "\n\na\n a\na\n", "a b c d e f g h", "x " * 9, "é ü\xa0ñ # <b> & | $ % *", "a\x1cb c d"]
    texts += ["".join(rnd.choice(["a ", "b ", "c\n", "d\t", "# "]) for _ in range(rnd.randrange(0, 120))) for _ in range(60)]
    base = " ".join(str(i) for i in range(30))
    texts += [base + " x " + base, base + "\n" + base + "\n" + base, " ".join(f"w{i}" for i in range(30_000)) + " " + base + " " + base]
    df = docs(list(enumerate(texts)))
    rows = {r.doc_id: r for r in Q.features(clashing(df)).collect()}
    for i, t in enumerate(texts):
        r = rows[i]
        n, *rest = brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest), i
        assert r.base_failed == (n < 20 or 100 * rest[3] > 30 * n)


def test_binomial_bound(spark):
    from pyspark.sql import functions as F

    cases = [(0, 10, 0.1), (3, 10, 0.1), (10, 10, 0.1), (5, 300, 0.02), (900, 1000, 0.5), (0, 1, 0.4)]
    df = spark.createDataFrame([(k, n) for k, n, _ in cases], "k BIGINT, n BIGINT")
    for k, n, p in cases:
        got = df.where((F.col("k") == k) & (F.col("n") == n)).select(Q.binomial_cdf(F.col("k"), F.col("n"), p)).first()[0]
        assert abs(got - sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))) < 1e-9


def cutoffs_by_hand(rows, alpha, delta):
    """rows: (stratum, rule -> value) of good documents."""
    out = {}
    level, limit = delta / ((len(Q.STRATA) + 1) * len(Q.RULES)), alpha / len(Q.RULES)
    for s in {s for s, _ in rows}:
        for rule in Q.RULES:
            values = [v[rule] for t, v in rows if t == s]
            for c in Q.GRID:
                k, n = sum(v > c for v in values), len(values)
                if sum(comb(n, i) * limit ** i * (1 - limit) ** (n - i) for i in range(k + 1)) > level:
                    break
                out[s, rule] = c
    return out


def test_cutoffs_and_verdicts(spark, docs):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(3000):
        lang = "en" if i % 3 else rnd.choice(["de", "xx", None])
        text = rnd.sample(words, 40)
        if i % 10 == 0:
            text = [w + "##$" for w in text]
        elif i % 97 == 0:
            text[3] += "#"
        rows.append((i, " ".join(text), lang, "s"))
        labels.append((i, 0 if i % 10 == 0 else 1))
    df = docs(rows)
    lab = spark.createDataFrame(labels + [(1, 1), (None, 1), (99999, 1)], "doc_id BIGINT, quality INT")
    found = Q.features(df).collect()
    good = dict(labels)
    share = lambda a, b: min(a / b, 1.0) if b else 0.0
    value = lambda r: {"symbols": share(r.n_symbols, r.word_chars), "dup_lines": share(r.n_dup_lines, r.n_words), "repeats": share(r.n_repeat_words, r.n_words)}
    want = cutoffs_by_hand([(r.stratum, value(r)) for r in found if good[r.doc_id] and not r.base_failed], 0.06, 0.05)
    got = {(r.stratum, r.rule): r.cutoff for r in Q.cutoffs(Q.features(df).join(lab.where("quality = 1"), "doc_id", "left_semi").where("not base_failed"), 0.06, 0.05).collect()}
    assert got == want and ("en", "symbols") in got
    judged = {r.doc_id: r for r in Q.judge(df, lab, alpha=0.06).collect()}
    for r in found:
        cut = any(value(r)[rule] > want.get((r.stratum, rule), 2) for rule in Q.RULES)
        assert judged[r.doc_id].kept == (not r.base_failed and not cut)
    lost = sum(not judged[i].kept for i, q in labels if q)
    assert lost <= 0.06 * len(labels)
    assert sum(not judged[i].kept for i, q in labels if not q and i % 3) > 150


def test_small_tables(spark, docs):
    none = spark.createDataFrame([], "doc_id BIGINT, quality INT")
    assert Q.judge(docs([]), none).collect() == []
    text = " ".join(f"a{i}" for i in range(25))
    rows = Q.judge(docs([(1, text), (1, text), (2, None)]), none).collect()
    assert sorted((r.doc_id, r.kept) for r in rows) == [(1, True), (1, True), (2, False)]
