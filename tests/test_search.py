import random

from leadloom.operators.search import find_names, name_postings


def test_every_term_finds_what_a_scan_finds(spark):
    rng = random.Random(5)
    names = ["", None, "Ab", "É Nova", "NOVA nova", "x%_y", "a" * 300] + ["".join(rng.choices("abcn ov", k=rng.randint(1, 12))) for _ in range(150)]
    companies = spark.createDataFrame([(f"k{i}", n) for i, n in enumerate(names)], "dedup_key STRING, company_name STRING")
    terms = sorted({"", "a", "no", "NOV", "nova", "ova n", "é n", "%_", "zzz", "abzzz", "aaaa"} | {n[1:5] for n in names if n and len(n) > 5})
    asked = spark.createDataFrame([(t,) for t in terms] + [(None,)], "term STRING")
    got = sorted((r.term, r.dedup_key) for r in find_names(asked, companies, name_postings(companies)).collect())
    assert got == sorted((t, f"k{i}") for t in terms for i, n in enumerate(names) if n is not None and t.lower() in n.lower())
    long = asked.where("length(term) > 3")
    plan = find_names(long, companies, name_postings(companies))
    assert {r.term for r in plan.collect()} <= {t for t in terms if len(t) > 3}
