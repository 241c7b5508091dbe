import random

import pytest
from pyspark.sql import functions as F

import naive
from leadloom.functions.names import fuzzy_normalize_company_name, normalize_company_name
from leadloom.functions.similarity import indel_ratio
from leadloom.operators import resolve as R
from leadloom.operators.similar import similar_names
from leadloom.ranges import numbered

RECORD = "seq BIGINT, company_name STRING, phone STRING, website STRING"
WORDS = ["Acme", "Acmee", "Hub", "Hubb", "Tech", "Data", "Dataa", "Bright", "Brite", "Nova"]
TAILS = ["", "Pvt Ltd", "Solutions", "Services", "LLP", "(OPC) Private Limited", "It", "Infotech"]


def random_batch(n, seed, phones=8):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        name = " ".join(rng.choices(WORDS, k=rng.randint(1, 3)) + [rng.choice(TAILS)])
        if rng.random() < 0.04:
            name = rng.choice(["", "  ", "Solutions", "Services Ltd", "A B", "Co"])
        if rng.random() < 0.2 and len(name) > 4:
            i = rng.randrange(len(name))
            name = name[:i] + rng.choice("xyz ") + name[i + 1:]
        phone = rng.choice([None, "", "12345", f"+91 98765 0000{rng.randrange(phones)}"])
        site = rng.choice([None, None, f"https://www.{rng.choice(WORDS).lower()}.in/"])
        rows.append((seq, name, phone, site))
    rng.shuffle(rows)
    return rows


def as_dicts(rows):
    return [dict(zip(("seq", "company_name", "phone", "website"), r)) for r in rows]


def outcome(resolution):
    rows = resolution.records.select(
        "seq", "resolved_key", "match_type", "matched_name", "fuzzy_score"
    ).collect()
    return sorted(
        (r.seq, r.resolved_key, r.match_type, r.matched_name,
         None if r.fuzzy_score is None else round(r.fuzzy_score, 6))
        for r in rows
    )


def rounded(expected):
    return [(s, k, m, n, None if f is None else round(f, 6)) for s, k, m, n, f in expected]


@pytest.mark.parametrize("seed, n, phones", [(1, 120, 8), (2, 200, 40), (3, 60, 2)])
def test_batch_equals_one_by_one(spark, seed, n, phones):
    rows = random_batch(n, seed, phones)
    got = outcome(R.resolve(spark.createDataFrame(rows, RECORD)))
    assert got == rounded(naive.resolve(as_dicts(rows)))


def test_registry_and_hot_split(spark):
    """Existing companies come first; a low hot limit sends keys through both join paths."""
    first, second = random_batch(80, 11), random_batch(120, 12)
    base = naive.resolve(as_dicts(first))
    names = {r[0]: (r[1] or "").strip() or "Unknown" for r in first}
    registry = [(k, names[s], naive.norm(names[s])) for s, k, m, _, _ in base if m is None]
    stored = spark.createDataFrame(
        registry, "dedup_key STRING, company_name STRING, normalized_name STRING"
    )
    batch = spark.createDataFrame(second, RECORD)
    got = outcome(R.resolve(batch, stored, hot_rows=5))
    assert got == rounded(naive.resolve(as_dicts(second), registry))


def test_generations_do_not_change_the_result(spark):
    first, second = random_batch(50, 31), random_batch(170, 32)
    base = naive.resolve(as_dicts(first))
    names = {r[0]: (r[1] or "").strip() or "Unknown" for r in first}
    registry = [(k, names[s], naive.norm(names[s])) for s, k, m, _, _ in base if m is None]
    stored = spark.createDataFrame(
        registry, "dedup_key STRING, company_name STRING, normalized_name STRING"
    )
    batch = spark.createDataFrame(second, RECORD)
    for known, truth in ((None, naive.resolve(as_dicts(second))), (stored, naive.resolve(as_dicts(second), registry))):
        assert outcome(R.resolve(batch, known, first_generation=15)) == rounded(truth)


def test_fuzzy_off(spark):
    rows = random_batch(60, 5)
    got = outcome(R.resolve(spark.createDataFrame(rows, RECORD), threshold=101))
    assert got == rounded(naive.resolve(as_dicts(rows), threshold=101))


def test_review_log_lists_every_comparison_over_the_floor(spark):
    rows = random_batch(90, 21)
    log = []
    naive.resolve(as_dicts(rows), log=log)
    resolution = R.resolve(spark.createDataFrame(rows, RECORD))
    got = sorted(
        (r.incoming_name, r.candidate_name, round(r.score, 6), r.verdict)
        for r in R.review_log(resolution, "2026-01-31 12:00:00").collect()
    )
    want = sorted(
        (a, b, s, "matched" if s >= 90 else "not_matched") for a, b, s in log if s >= 80
    )
    assert got == want
    assert {v for *_, v in got} == {"matched", "not_matched"}


def test_review_lines_escape_pipes(spark):
    log = spark.createDataFrame(
        [("2026-01-31 12:00:00", "FUZZY_MATCH", "A|B", "a b", "C", "c", 40.0, 90, "not_matched")],
        "timestamp STRING, action STRING, incoming_name STRING, incoming_normalized STRING, "
        "candidate_name STRING, candidate_normalized STRING, score DOUBLE, threshold INT, verdict STRING",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert R.review_lines(log).first().value == (
        "2026-01-31T12:00:00.000Z|FUZZY_MATCH|A\\|B|a b|C|c|40.0|90|not_matched"
    )


def test_similarity_join_equals_brute_force(spark):
    rng = random.Random(4)
    forms = set()
    while len(forms) < 130:
        form = " ".join(sorted(rng.choices([w.lower() for w in WORDS] + ["solutions", "x"], k=rng.randint(0, 4))))
        if rng.random() < 0.5 and form:
            i = rng.randrange(len(form))
            form = form[:i] + rng.choice("abé") + form[i + 1:]
        forms.add((form, form.replace("solutions", "").strip()[: rng.choice([0, 2, 30, 30])]))
    forms = sorted(forms)
    a = spark.createDataFrame(forms, "in_form STRING, in_norm STRING")
    b = spark.createDataFrame(forms, "cand_form STRING, cand_norm STRING")
    for t in (30, 60, 69.5, 75, 90):
        got = {tuple(r)[:4] for r in similar_names(a, b, t).select("in_form", "in_norm", "cand_form", "cand_norm").collect()}
        want = {
            (f, n, g, m) for f, n in forms for g, m in forms
            if m.startswith(n[:3]) and naive.ratio(f, g) >= t
        }
        assert got == want
    with pytest.raises(ValueError):
        similar_names(a, b, 0)


def test_scores_of_known_pairs(spark):
    pairs = [
        ("Pinnacle It Solutions", "Pinnacle It Services"),
        ("Tech Solutions India", "Tech Services India"),
        ("Tech Solutions India", "Tech Systems India"),
        ("Acme Technologies", "Acme Tech"),
        ("Codetrex Infotech Pvt. Ltd.", "Codetrex Infotech"),
        ("Nitai Technologies (OPC) Private Limited", "Nitai Technologies"),
        ("", ""),
        ("b a", "a b"),
    ]
    df = spark.createDataFrame(pairs, "a STRING, b STRING")
    scores = [r[0] for r in df.select(indel_ratio(R.fuzzy_form("a"), R.fuzzy_form("b"))).collect()]
    assert all(s < 90 for s in scores[:4])
    assert scores[4:] == [100.0] * 4
    assert [round(s, 6) for s in scores] == [
        round(naive.token_sort_ratio(naive.fuzzy_norm(a), naive.fuzzy_norm(b)), 6) for a, b in pairs
    ]


def test_names(one):
    cases = {
        "Tech Solutions Pvt. Ltd.": ("tech", "tech solutions"),
        "Nitai Technologies (OPC) Private Limited": ("nitai", "nitai technologies"),
        "  ABC   Industries  ": ("abc", "abc industries"),
        "Foo Corporation LLC": ("foo", "foo"),
        "Müller GmbH & Co": ("müller gmbh", "müller gmbh"),
        "ABC Consulting Enterprises": ("abc consulting", "abc consulting enterprises"),
    }
    assert one(list(cases), normalize_company_name("v")) == [c[0] for c in cases.values()]
    assert one(list(cases), fuzzy_normalize_company_name("v")) == [c[1] for c in cases.values()]


def test_single_operators_against_registry(spark):
    registry = spark.createDataFrame(
        [
            (naive.phone_key("7971671113"), "Acme", "acme"),
            ("dk-z", "Tech Pvt Ltd", "tech"),
            ("dk-a", "Tech Limited", "tech"),
            ("dk-s", "Pinnacle It Solutions", "pinnacle it"),
        ],
        "dedup_key STRING, company_name STRING, normalized_name STRING",
    )
    batch = spark.createDataFrame(
        [(0, "Acme Corp", "+91-7971-671113", None), (1, "Tech", None, None),
         (2, "Pinnacle It Services", None, None), (3, "Solutions Ltd", None, None)],
        RECORD,
    )
    phones = {r.seq: r.matched_name for r in R.phone_match(batch, registry).collect()}
    assert phones == {0: "Acme", 1: None, 2: None, 3: None}
    best = {r.seq: (r.matched_key, r.fuzzy_score) for r in R.best_fuzzy(batch, registry).collect()}
    assert best == {0: (naive.phone_key("7971671113"), 100.0), 1: ("dk-a", 100.0)}
    sizes = {r.seq: r.candidates for r in R.block_sizes(batch, registry).collect()}
    assert sizes == {0: 1, 1: 2, 2: 1, 3: 4}


@pytest.mark.parametrize("threshold, seed", [(90, 41), (55, 42)])
def test_counts_cover_every_comparison(spark, threshold, seed):
    first, second = random_batch(40, seed), random_batch(110, seed + 10)
    base = naive.resolve(as_dicts(first))
    names = {r[0]: (r[1] or "").strip() or "Unknown" for r in first}
    registry = [(k, names[s], naive.norm(names[s])) for s, k, m, _, _ in base if m is None]
    stored = spark.createDataFrame(registry, "dedup_key STRING, company_name STRING, normalized_name STRING")
    log = []
    want_rows = naive.resolve(as_dicts(second), registry, threshold, log)
    resolution = R.resolve(spark.createDataFrame(second, RECORD), stored, threshold)
    assert outcome(resolution) == rounded(want_rows)
    counts = R.review_counts(resolution, threshold).collect()
    assert {r.seq for r in counts} == {s for s, _, m, _, _ in want_rows if m != "phone"}
    assert sum(r.comparisons for r in counts) == len(log)
    assert sum(r.matched for r in counts) == sum(s >= threshold for _, _, s in log)
    assert all(r.comparisons == r.matched + r.not_matched for r in counts)
    per_name = {}
    for name, _, _ in log:
        per_name[name] = per_name.get(name, 0) + 1
    got = {}
    name_of = {r[0]: r[1] for r in second}
    for r in counts:
        if r.comparisons:
            got[name_of[r.seq]] = got.get(name_of[r.seq], 0) + r.comparisons
    assert got == per_name


def test_running_sum_of_a_group_that_spans_ranges(spark):
    rows = [(g, i) for g, n in ((None, 5), ("a", 1), ("hot", 400), ("z", 3)) for i in range(n)]
    out = numbered(spark.createDataFrame(rows, "g STRING, o INT").repartition(5), "g", ["o"], "place").collect()
    assert sorted((str(r.g), r.o, r.place) for r in out) == sorted((str(g), i, i + 1) for g, i in rows)
    assert numbered(spark.createDataFrame([], "g STRING, o INT"), "g", ["o"], "place").collect() == []


def test_hot_prefix_is_compared_in_even_tiles(spark):
    """One prefix owns all names: strips are equal and pairs of far lengths never meet."""
    rng = random.Random(8)
    forms = sorted({"abc" + "".join(rng.choices("xyz ", k=rng.choice([1, 4, 12, 40]))).rstrip() for _ in range(160)})
    a = spark.createDataFrame([(f, f) for f in forms], "in_form STRING, in_norm STRING")
    b = spark.createDataFrame([(f, f) for f in forms], "cand_form STRING, cand_norm STRING")
    seen = []
    import leadloom.operators.tiles as tiles

    keep = tiles.stored

    def spy(df):
        out = keep(df)
        seen.append(out)
        return out

    tiles.stored = spy
    try:
        pairs = tiles.tiled_names(a, b, 60, 3, strip=16).collect()
    finally:
        tiles.stored = keep
    assert {(p.in_form, p.cand_form) for p in pairs} == {(f, g) for f in forms for g in forms if naive.ratio(f, g) >= 60}
    sizes = sorted(r["count"] for r in seen[0].groupBy("strip").count().collect())
    assert len(sizes) >= 8 and sizes[-1] == 16 and sizes[1:] == [16] * (len(sizes) - 1)
    assert seen[2].count() < len(sizes) ** 2


def test_names_of_batch_and_registry_are_read_once(spark):
    """Normalizing is the costly step: it must not be repeated by every reader of the records."""
    batch_reads, registry_reads = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counted(reads):
        def read(name):
            reads.add(1)
            return name
        return F.udf(read, "string")

    rows = random_batch(40, 5)
    batch = spark.createDataFrame(rows, RECORD).withColumn("company_name", counted(batch_reads)("company_name"))
    registry = spark.createDataFrame([(f"k{i}", f"Acme {i} Pvt Ltd", f"acme {i}") for i in range(10)],
                                     "dedup_key STRING, company_name STRING, normalized_name STRING")
    resolution = R.resolve(batch, registry.withColumn("company_name", counted(registry_reads)("company_name")))
    assert resolution.records.count() == 40
    assert (batch_reads.value, registry_reads.value) == (40, 10)
