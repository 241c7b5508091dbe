"""The pipeline against sequential versions of its stages, on small documents."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from leadloom.llm import bpe
from test_joins import groups, without_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rnd = random.Random(12)
    fresh = lambda n: " ".join(f"w{rnd.randrange(10 ** 5)}" for _ in range(n))
    rows = []
    for i in range(160):
        text = "\n".join(fresh(rnd.randrange(6, 30)) for _ in range(3))
        if i % 4 == 0:
            text += " zubrak zubrakel " + fresh(3)
        rows.append([i, text, "en", rnd.choice(["a", "a", "a", "b", None])])
    rows[50][1] = rows[49][1]
    rows[53][1] = rows[51][1].replace("\n", " ")
    rows[57][1] = rows[51][1].replace("\n", " ") + " tail"
    return [tuple(r) for r in rows] + [(300, None, "en", "b"), (301, "", "en", "b"), (302, "tiny", "de", "c"), (302, "tiny", "de", "c")]


@pytest.fixture
def stored_tables(spark, docs, tmp_path):
    rows = corpus()
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(r[0], int(r[0] % 4 == 0)) for r in rows if r[0] < 300]
    spark.createDataFrame(labels, "doc_id BIGINT, toxic INT").withColumn("quality", F.lit(1)).write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stage_by_stage(spark, stored_tables, tmp_path):
    df = spark.read.parquet(f"{stored_tables}/documents.parquet")
    names = [n for n, _ in P.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing", "byte-level BPE"]
    results = []
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, df, stored_tables).write.parquet(str(tmp_path / f"s{k}"))
        df = spark.read.parquet(str(tmp_path / f"s{k}"))
        if k < 4:
            assert df.columns == COLUMNS
        results.append(df)
    clean, lines, kept, mixed, tokens = results
    # Planted toxic documents go, the others stay.
    assert {d for d, _ in plain(clean)} == {r[0] for r in corpus() if r[0] >= 300 or r[0] % 4}
    want = [(d, t) for d, t, n in without_repeats(plain(clean)) if not n or (t or "").strip()]
    assert sorted(plain(lines), key=str) == sorted(want, key=str)
    low = {d: c for d, _, c in groups(sorted(set(plain(lines)), key=str))}
    assert sorted(plain(kept), key=str) == sorted({(d, t) for d, t in plain(lines) if low[d] == d}, key=str)
    words = lambda t: len((t or "").split())
    texts = dict(plain(kept))
    assert all(t == texts[d] or texts[d].startswith(t) and t for d, t in plain(mixed))
    total = sum(map(words, texts.values()))
    assert abs(sum(words(t) for _, t in plain(mixed)) - 1.5 * total) <= 3
    enc = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    found = sorted((r.doc_id, tuple(r.ids), r.n_tokens, r.round_trip) for r in tokens.collect())
    assert found == sorted((d, tuple(i), len(i), True) for d, t in plain(mixed) for i in [enc.encode_ordinary(t)])


def test_empty_table(spark, docs, tmp_path):
    docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    out = P.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "ids", "n_tokens", "round_trip"] and out.collect() == []
