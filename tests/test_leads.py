from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadloom.operators import dedup as D
from leadloom.operators import gates as G
from leadloom.operators.leads import filter_valid, raw_to_lead, score_leads, seed_score, with_violations
from leadloom.operators.report import dashboard_rows, fill_rates, kpis, search_leads, sort_leads

AS_OF = "2026-01-31 12:00:00"
NOW = datetime(2026, 1, 31, 12)
LEAD = "seq BIGINT, company_name STRING, dedup_key STRING, employee_count INT, revenue_band STRING"


def leads(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], LEAD)


def test_dedup_keeps_richest_then_name_then_order(spark):
    rows = [
        ("Zeta", "k1", 5, None), ("Alpha", "k1", None, None), ("Beta", "k1", 0, "b"),
        ("B", "k2", 1, None), ("A", "k2", 2, None), ("Same", "k3", None, None), ("Same", "k3", None, None),
        ("NoKey", None, None, None), ("Blank", "  ", None, None), ("Empty", "", None, None), ("K1 ", "k1 ", None, None),
    ]
    out = D.deduplicate(leads(spark, rows), AS_OF)
    assert sorted(r.seq for r in out.kept.collect()) == [2, 4, 5, 7, 8, 9, 10]
    rejected = sorted((r.dedup_key, r.kept_company, r.rejected_company, r.reason) for r in out.rejected.collect())
    assert rejected == [
        ("k1", "Beta", "Alpha", "Fewer enrichment fields (0 vs 2)"),
        ("k1", "Beta", "Zeta", "Fewer enrichment fields (1 vs 2)"),
        ("k2", "A", "B", "Tied at 1 enrichment fields, rejected alphabetically"),
        ("k3", "Same", "Same", "Tied at 0 enrichment fields, rejected alphabetically"),
    ]


def test_dedup_is_complete_and_order_independent(spark):
    rows = [(f"N{i % 7}", "hot" if i % 3 else f"k{i % 11}", i if i % 2 else None, None) for i in range(200)]
    df = leads(spark, rows)
    a = D.deduplicate(df, AS_OF, hot_rows=20)
    b = D.deduplicate(df.repartition(7, "company_name"), AS_OF)
    assert a.kept.count() + a.rejected.count() == 200
    assert sorted(a.kept.collect()) == sorted(b.kept.collect())
    assert sorted(a.rejected.collect()) == sorted(b.rejected.collect())


def test_append_skips_stored_and_repeated_keys(spark):
    rows = [("A", "k1", None, None), ("B", "k2", None, None), ("C", "k2", None, None), ("D", "", None, None),
            ("E", None, None, None), ("F", " ", None, None), ("G", " ", None, None)]
    batch = leads(spark, rows)
    stored = D.existing_keys(leads(spark, [("X", "k1", None, None), ("Y", "", None, None)]))
    assert [r.dedup_key for r in stored.collect()] == ["k1"]
    assert sorted(r.seq for r in D.filter_new_rows(batch, stored).collect()) == [1, 3, 4, 5]
    again = D.existing_keys(batch, leads(spark, [("X", "k1", None, None)]))
    assert sorted(r.seq for r in D.filter_new_rows(batch, again).collect()) == [3, 4]


def test_fill_first(spark):
    df = spark.createDataFrame(
        [(0, "k", "", None, 0), (1, "k", "a", None, 7), (2, "k", "b", "z", 9)],
        "seq BIGINT, key STRING, x STRING, y STRING, n INT",
    )
    assert D.fill_first(df, "key").first().asDict() == {"key": "k", "x": "a", "y": "z", "n": 7, "seq": 0}


def test_multi_source(spark):
    df = spark.createDataFrame(
        [("098765 43210", "https://www.justdial.com"), ("+91 9876543210", "https://dir.indiamart.com"),
         ("9811223344", "https://www.justdial.com"), ("123", "https://www.justdial.com")],
        "phone STRING, source_url STRING",
    )
    assert [tuple(r) for r in D.multi_source_groups(df).collect()] == [("9876543210", ["IndiaMART", "Justdial"])]


def test_validation(spark):
    rows = [("A", "a@b.in", None), ("", "a@b.in", None), ("  ", None, None), (None, None, None), ("B", None, None),
            ("C", "", "  "), ("D", None, "99"), ("E", "bad", None), ("F", "  ", None), ("G", " a@b.in ", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq BIGINT, company_name STRING, email STRING, phone STRING")
    out = filter_valid(df)
    assert {r.seq: r.email for r in out.valid.collect()} == {
        0: "a@b.in", 6: None, 7: "UNVERIFIED:bad", 8: "UNVERIFIED:", 9: " a@b.in ",
    }
    assert {r.seq: r.reason for r in out.invalid.collect()} == {
        1: "Empty company_name", 2: "Empty company_name", 3: "Empty company_name",
        4: "Missing both email and phone", 5: "Missing both email and phone",
    }


SCORE = ("seq BIGINT, phone STRING, email STRING, website STRING, sources ARRAY<STRING>, "
         "first_seen TIMESTAMP, category_slug STRING, city_slug STRING")


@pytest.mark.parametrize(
    "row, total, recency",
    [
        ((None, None, None, None, None, None, None), 10, "new"),
        (("1", None, None, None, NOW, None, None), 35, "today"),
        ((" ", "UNVERIFIED:x", "w", ["a"], NOW - timedelta(days=8), None, None), 55, "older"),
        (("", None, None, ["a", "b"], NOW - timedelta(days=7, hours=3), None, None), 30, "last_7_days"),
        (("1", "e", "w", ["a", "b", "c"], NOW, "it", None), 100, "today"),
        ((None, None, None, None, NOW - timedelta(hours=13), None, "pune"), 15, "last_7_days"),
    ],
)
def test_score(spark, row, total, recency):
    df = spark.createDataFrame([(0, *row)], SCORE)
    got = score_leads(df, AS_OF, {"it"}, {"pune"}).first()
    assert (got.lead_score, got.lead_score_breakdown.recency) == (total, recency)


def test_score_breakdown_json_omits_absent_contacts(spark):
    df = spark.createDataFrame([(0, None, "e", None, None, None, None, None)], SCORE)
    text = score_leads(df, AS_OF).select(F.to_json("lead_score_breakdown")).first()[0]
    assert '"has_email":15' in text and "has_phone" not in text


def test_seed_score_and_violations(spark):
    df = spark.createDataFrame(
        [(" A ", "bad url", "https://x.in", 101, "e", "", "w", "it")],
        "company_name STRING, website STRING, source_url STRING, lead_score INT, email STRING, phone STRING, w STRING, industry_code STRING",
    )
    row = with_violations(df).first()
    assert row.company_name == "A" and row.violations == ["Invalid URL: bad url", "lead_score must be between 0 and 100"]
    assert df.select(seed_score()).first()[0] == 55


def test_raw_to_lead(spark):
    df = spark.createDataFrame(
        [(0, "A", "https://www.Foo.in/x", "https://dir.indiamart.com", ""), (1, "B", None, "https://e.org", "own")],
        "seq BIGINT, company_name STRING, website STRING, source_url STRING, dedup_key STRING",
    )
    rows = raw_to_lead(df, AS_OF).orderBy("seq").collect()
    assert [(r.dedup_key, r.sources) for r in rows] == [("foo.in", ["IndiaMART"]), ("own", None)]
    assert rows[0].first_seen == NOW


def test_gate(spark):
    targets = spark.range(10)
    errors = lambda n: spark.createDataFrame([(f" u{i % 3} ", "r1") for i in range(n)] + [(" ", "r0")], "url STRING, run_id STRING")
    G.require_gate(G.failure_gate(errors(3), targets, run_id="r1"))
    with pytest.raises(G.ThresholdExceeded):
        G.require_gate(G.failure_gate(errors(4), targets, run_id="r1"))
    assert G.failure_gate(errors(9), targets, mode="urls").first().error_count == 3
    assert G.failure_gate(errors(9), targets.limit(0)).first().passed


def test_promote(spark):
    rows = [("A", "k1", None, None), ("B", "k2", None, None), (" ", "", None, None), (None, None, None, None), ("C", None, None, None)]
    stored = leads(spark, [("X", "k1", None, None)])
    assert sorted(r.seq for r in G.promote(leads(spark, rows), stored).collect()) == [1, 4]


def test_reports(spark):
    df = spark.createDataFrame(
        [(0, "beta", "w", "e", "1", "addr", "IT", "k", "https://www.justdial.com"),
         (1, "Alpha", None, "", "2", None, None, "", "https://x.org/y"),
         (2, None, None, None, None, None, None, None, None)],
        "seq BIGINT, company_name STRING, website STRING, email STRING, phone STRING, address STRING, industry_code STRING, dedup_key STRING, source_url STRING",
    )
    assert kpis(df).first().asDict() == {
        "total": 3, "with_phone": 2, "with_email": 1, "with_website": 1, "domains": 1, "distinct_domains": 1,
    }
    rows = dashboard_rows(df)
    assert [r.source for r in rows.collect()] == ["Unknown", "x.org", "Justdial"]
    assert [r.company_name for r in search_leads(rows, "ADDR").collect()] == ["beta"]
    assert search_leads(rows, has="phone_email").count() == 1
    assert search_leads(rows, source="x.org").count() == 1
    assert [r.seq for r in sort_leads(df, "company_name").collect()] == [2, 1, 0]
    targets = spark.createDataFrame([("IndiaMART", True), ("TradeIndia", False)], "name STRING, enabled BOOLEAN")
    assert {r.site: r.total for r in fill_rates(df, targets).collect()} == {"justdial": 1, "unknown": 2, "indiamart": 0}
