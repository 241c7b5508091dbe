import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadloom.llm import discriminant as Q

GOOD = "The house stood by the river, and people came there every summer to rest.".split()


def text(rng, good):
    words = rng.choices(GOOD, k=rng.randint(5, 120))
    if good:
        return " ".join(words).capitalize() + "."
    kind = rng.randrange(3)
    if kind == 0:
        return " | ".join(words)
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in words)
    return " ".join([words[0]] * len(words))


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(3)
    return [(i, text(rng, i % 6 > 0), int(i % 6 > 0)) for i in range(600)]


def frames(spark, sample):
    docs = spark.createDataFrame([(i, t) for i, t, _ in sample], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, y) for i, _, y in sample], "doc_id BIGINT, quality INT")
    return docs, labels


def test_held_out_accuracy_and_fold(spark, sample):
    docs, labels = frames(spark, sample)
    out = {r.doc_id: r for r in Q.judge(docs, labels).collect()}
    truth = {i: y for i, _, y in sample}
    held = [r for r in out.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [(r.score >= 0.3) == bool(truth[r.doc_id]) for r in held]
    assert len(right) > 80 and sum(right) / len(right) >= 0.98
    assert all(0 <= r.score <= 1 for r in out.values())


def test_held_out_labels_play_no_part(spark, sample):
    docs, labels = frames(spark, sample)
    turned = labels.withColumn("quality", F.when(Q.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: round(r.score, 9) for r in Q.judge(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_scores_equal_the_densities_written_out(spark, sample):
    docs, labels = frames(spark, sample)
    stats = Q.statistics(docs)
    x = {r.doc_id: np.array(r.x) for r in stats.collect()}
    y = {i: v for i, _, v in sample}
    model = Q.fit(stats.join(labels, "doc_id").select(F.col("quality").alias("y"), "x"))
    every = np.array(list(x.values()))
    log = {}
    for k in (0, 1):
        own = np.array([x[i] for i in x if y[i] == k])
        c = (1 - Q.SHRINKAGE) * np.cov(own.T, bias=True) + Q.SHRINKAGE * np.diag(every.var(0)) + Q.FLOOR * np.eye(every.shape[1])
        d = every - own.mean(0)
        log[k] = np.log(len(own) / len(every)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * (d * np.linalg.solve(c, d.T).T).sum(1)
    want = 1 / (1 + np.exp(-(log[1] - log[0]) / every.shape[1]))
    assert np.allclose(model.scores(every), want, rtol=1e-6, atol=1e-9)


def test_statistics_of_one_text(spark):
    df = spark.createDataFrame([(1, "Ab ab AB! AB! | x9\n\n12\nAb")], "doc_id BIGINT, text STRING")
    x = dict(zip(Q.STATISTICS, Q.statistics(df).first().x))
    share = lambda k, n: np.arcsin(np.sqrt(k / n))
    assert x["words"] == pytest.approx(np.log1p(8)) and x["lines"] == pytest.approx(np.log1p(3))
    assert x["shouted"] == pytest.approx(share(2, 8)) and x["repeats"] == pytest.approx(share(1, 8))
    assert x["lone"] == pytest.approx(share(1, 8)) and x["most_frequent"] == pytest.approx(share(2, 8))
    assert x["symbols"] == pytest.approx(share(1, 17)) and x["capitals"] == pytest.approx(share(6, 17)) and x["digits"] == pytest.approx(share(3, 17))
    assert x["others"] == pytest.approx(share(17 - 11, 17))


def test_nulls_empty_long_repeated_and_clashing(spark, clashing, sample):
    docs, labels = frames(spark, sample)
    odd = spark.createDataFrame([(None, "a b"), (9001, None), (9002, ""), (9003, "w " * 60000), (9004, "x"), (9004, "x"), (9005, " \n\t ")], docs.schema)
    more = lambda df: clashing(df).withColumns({c: F.lit(1) for c in ("x", "y", "v", "at", "counts", "held_out", "quality", "toxic")})
    noise = spark.createDataFrame([(None, 1), (5, None), (7, 9), (123456, 1)], labels.schema)
    out = Q.judge(more(docs.unionByName(odd)), labels.unionByName(noise)).collect()
    assert len(out) == len(sample) + 7 and all(0 <= r.score <= 1 for r in out)
    got = {r.doc_id: r for r in out}
    assert got[9001].score == got[9002].score and got[None].held_out is False


@pytest.mark.parametrize("keep, want", [("quality = 1", 1.0), ("quality = 0", 0.0), ("false", 0.5)])
def test_missing_classes(spark, sample, keep, want):
    docs, labels = frames(spark, sample[:60])
    assert {r.score for r in Q.judge(docs, labels.where(keep)).collect()} == {want}


def test_empty_table(spark, sample):
    docs, labels = frames(spark, sample[:5])
    assert Q.judge(docs.where("false"), labels).collect() == []
