import math
import random

import pytest

from leadloom.llm.mixing import mix, word_count


def targets(sizes, weights=(5, 2, 1)):
    """Share by weight, set what exceeds its limit, again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    out, budget = {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in out]
        if not open_:
            return out
        level = (budget - sum(out.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: 2.0 * sizes[s] for s in over}


def check(df):
    plan, entries = mix(df, word_count("text"))
    rows = plan.collect()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = targets(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        taken[r.source] += r.taken
    # The queue again, one entry after another.
    budget, used, entered = sum(math.floor(w + 0.5) for w in want.values()), dict.fromkeys(sizes, 0), []
    for again in (0, 1):
        for r in sorted(rows, key=lambda r: r.row):
            if r.size:
                used[r.source] += r.size
                entered.append((used[r.source] / r.target, r.row, again, r.size))
    truth, left = dict.fromkeys((r.row for r in rows), 0), budget
    for _, row, _, size in sorted(entered):
        truth[row] += min(size, left)
        left -= min(size, left)
    assert {r.row: r.taken for r in rows} == truth
    most = max((r.size for r in rows), default=0)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= most * len(sizes)
        assert taken[s] >= want[s] - max(r.size for r in rows if r.source == s) - 1
    queue = sorted(map(tuple, entries.select("finish", "row", "pass", "take", "upto").collect()))
    total = 0
    for finish, _, _, take, upto in queue:
        total += take
        assert upto == total and finish > 0
    assert total == budget
    return rows


def test_hot_source_ties_and_odd_rows(docs):
    rnd = random.Random(3)
    rows = [(i, "w " * rnd.randrange(0, 40), "en", rnd.choice(["a", "a", "a", "a", "é", "Z", None])) for i in range(400)]
    rows += [(7, "same text here", "en", "a")] * 3 + [(None, "x y", "en", "b"), (900, None, "en", "b"), (901, "", "en", "c"), (902, "w " * 5000, "en", "d")]
    first = check(docs(rows))
    again = check(docs(list(reversed(rows))).repartition(5))
    order = lambda rs: sorted((str(r.doc_id), str(r.source), r.size, r.taken) for r in rs)
    assert order(first) == order(again)


@pytest.mark.parametrize("rows", [[], [(1, None), (2, "")], [(1, "one")], [(1, "a b c", "en", None)]])
def test_small_tables(docs, rows):
    assert len(check(docs(rows))) == len(rows)


def test_extra_columns(docs, clashing):
    assert len(check(clashing(docs([(1, "a b", "en", "x"), (2, "c", "en", "y")])))) == 2
