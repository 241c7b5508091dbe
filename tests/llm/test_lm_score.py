import math
import random
import re
from collections import Counter

import pytest

from leadloom.llm import lm_score
from leadloom.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, order=2, backoff=0.4):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for _, t in rows]
    grams = lambda w: Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1))
    whole = sum((grams(w) for w in texts), Counter())
    total = sum(map(len, texts))
    out = []
    for (d, _), w in zip(rows, texts):
        own, s = grams(w), 0.0
        count = lambda g: whole[g] - own[g]
        for i in range(len(w)):
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1:i + 1])
                if n == 1:
                    s += math.log(max(1, count(g)) / max(1, total - len(w))) + (order - 1) * math.log(backoff)
                elif count(g):
                    s += math.log(count(g) / count(g[:-1])) + (order - n) * math.log(backoff)
                else:
                    continue
                break
        out.append((d, len(w), round(s, 6)))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(5)
    rows = [(i, " ".join(rnd.choice("the of To a in B c d e f g".split()) + str(rnd.randrange(3)) for _ in range(rnd.randrange(0, 60)))) for i in range(80)]
    return rows + [(500, None), (501, ""), (3, "the0 of1"), (3, "the0 of1"), (None, "unseen words only here"), (502, "the1 " * 5000)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_sequential_scores(docs, clashing, monkeypatch, order):
    monkeypatch.setattr(lm_score, "BATCH_WORDS", 900)
    monkeypatch.setattr(lm_score, "BUCKET_NGRAMS", 500)
    rows = corpus()
    found = lm_score.score(clashing(docs(rows)).repartition(3), order=order).collect()
    assert sorted(((r.doc_id, r.n_words, round(r.log_score, 6)) for r in found), key=str) == brute(rows, order)
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in found)


def test_small_tables(docs):
    assert lm_score.score(docs([])).collect() == []
    assert [tuple(r) for r in lm_score.score(docs([(1, None)])).collect()] == [(1, 0, 0.0, None)]
    assert lm_score.score(docs([(1, "alone")])).first().n_words == 1


def test_registered_query_scores_trigrams(docs, spark, tmp_path):
    rows = corpus()[:81]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op2_lm_score"](spark, str(tmp_path)).collect()
    want = brute(rows, 3)
    assert want != brute(rows, 2)
    assert sorted(((r.doc_id, r.n_words, round(r.log_score, 6)) for r in found), key=str) == want
