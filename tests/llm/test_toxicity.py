import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from leadloom.llm import toxicity

SYLLABLES = "an ter ou the ing on er ti re ha st nd".split()


def text(rnd, bad):
    words = ["".join(rnd.choices(SYLLABLES, k=rnd.randrange(1, 4))) for _ in range(rnd.randrange(5, 200))]
    for _ in range(bad):
        words[rnd.randrange(len(words))] = rnd.choice(["zubrak", "zubrakel", "zubrakonti", "mipfdol", "mipfdols"])
    return " ".join(words)


def data(spark, docs, n=400):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        rows.append((i, text(rnd, 1 + rnd.randrange(4) if bad else 0)))
        labels.append((i, int(bad)))
    return docs(rows), spark.createDataFrame(labels, "doc_id BIGINT, toxic INT"), dict(labels)


def test_held_out_accuracy_and_odd_texts(spark, docs, clashing):
    df, labels, truth = data(spark, docs)
    odd = docs([(1000, None), (1001, ""), (1002, "   "), (1003, "zubrak " + "an ter " * 30_000), (1003, "an"), (None, "the ing")])
    noise = spark.createDataFrame([(5, None), (None, 1), (7777, 1), (6, 9)], "doc_id BIGINT, toxic INT")
    model = toxicity.fit_from_labels(clashing(df), labels.unionAll(noise))
    rows = toxicity.score(df.unionAll(odd), model, ["doc_id"]).collect()
    held = [r for r in rows if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum((r.score >= 0.3) == truth[r.doc_id] for r in held)
    assert len(held) > 60 and right >= 0.97 * len(held)
    assert len(rows) == 406 and all(0 <= r.score <= 1 for r in rows)
    assert [r.score for r in rows if r.doc_id == 1000] == [r.score for r in rows if r.doc_id == 1001] == [r.score for r in rows if r.doc_id == 1002]
    assert next(r.score for r in rows if r.doc_id == 1000) < 0.3


def test_held_out_labels_do_not_matter(spark, docs):
    df, labels, _ = data(spark, docs, 200)
    flipped = labels.withColumn("toxic", F.when(toxicity.fold("doc_id") == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    scores = [sorted(map(tuple, toxicity.score(df, toxicity.fit_from_labels(df, lab), ["doc_id"]).collect())) for lab in (labels, flipped)]
    assert scores[0] == scores[1]


def test_without_labels_or_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    one = spark.createDataFrame([(1, 0)], "doc_id BIGINT, toxic INT")
    df = docs([(1, "a b"), (2, None)])
    for labels in (none, one):
        model = toxicity.fit_from_labels(df, labels)
        assert all(r.score < 0.3 for r in toxicity.score(df, model, ["doc_id"]).collect())
        assert toxicity.score(docs([]), model, ["doc_id"]).collect() == []


def sequential_ratio(top, gram, discount=0.75):
    """Kneser-Ney one n-gram at a time, from the two classes' counts."""
    if gram not in top[0] and gram not in top[1]:
        return 0.0
    p, seen = 1 / 5000, set(top[0]) | set(top[1])
    for n in range(1, len(gram)):
        longer = {g[-n - 1:] for g in seen}
        parts = {g[1:] for g in longer}
        follow = lambda part: sum(g[1:] == part for g in longer)
        context = [x for x in parts if x[:-1] == gram[len(gram) - n:-1]]
        p = (follow(gram[-n:]) - discount + discount * len(context) * p) / sum(map(follow, context))
    out = []
    for counts in top:
        own = {g: k for g, k in counts.items() if g[:-1] == gram[:-1]}
        out.append((max(own.get(gram, 0) - discount, 0) + discount * len(own) * p) / sum(own.values()) if own else p)
    return math.log(out[1] / out[0])


def test_ratios_against_sequential_models():
    rnd = random.Random(2)
    words = [["".join(rnd.choices("abé𝔸", k=rnd.randrange(1, 5))) for _ in range(40)] for _ in (0, 1)]
    for order in (2, 3, 5):
        top = [Counter(g for w in side for g in toxicity.grams(w, order)) for side in words]
        names = sorted(set(top[0]) | set(top[1]) | {"x" * order})
        model = toxicity._estimate(names, np.array([[c[g] for c in top] for g in names]), order)
        asked = [*words[0], *words[1], "unseen", "bb", "a"]
        want = [sum(sequential_ratio(top, g) for g in toxicity.grams(w, order)) for w in asked]
        assert np.allclose(model.word_ratios(asked), want, atol=1e-4)


def test_features_of_texts_scored_together(monkeypatch, spark, docs, clashing):
    df, labels, _ = data(spark, docs, 120)
    model = toxicity.fit_from_labels(df, labels)
    some = clashing(df).withColumn("per_letter", F.lit("y")).withColumn("of_words", F.lit("z")).withColumn("row", F.lit(1))
    want = {r.doc_id: r.toxic_score for r in toxicity.score(some, model, some.columns, name="toxic_score").collect()}
    for r in df.collect():
        words = toxicity.words_of(r.text)
        value = model.word_ratios(words)
        a, b = model.features([[], words, ["an"]])
        assert math.isclose(a[1], value.sum() / (sum(map(len, words)) + len(words)), abs_tol=1e-9)
        assert math.isclose(b[1], math.log(np.exp(value).mean()), abs_tol=1e-6)
        assert a[0] == b[0] == 0
        z = model.weights[0] + sum(w * (x - m) / s for w, x, m, s in zip(model.weights[1:], (a[1], b[1]), model.centre[:2], model.centre[2:], strict=True))
        assert math.isclose(want[r.doc_id], 1 / (1 + math.exp(-z)), abs_tol=1e-9)
