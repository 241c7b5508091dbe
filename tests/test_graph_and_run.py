import pytest
from pyspark.sql import functions as F

from leadloom import schemas
from leadloom.operators import gates, graph as G
from leadloom.operators.legacy import build_legacy_graph
from leadloom.operators.resolve import resolve
from leadloom.plans.lead_run import clean_leads, lead_run, promote_standalone
from leadloom.sources import tables as S
from leadloom.streaming.ingest import start_promotion_stream

AS_OF = "2026-01-31 12:00:00"
RAW = schemas.RAW_RECORDS.replace(", detail_url STRING, dedup_key STRING", "")


def raw(spark, rows):
    """rows: (name, website, email, phone, source_url, category, city)"""
    return spark.createDataFrame(
        [(i, n, w, e, p, "Addr", "IT", None, None, s, c, t) for i, (n, w, e, p, s, c, t) in enumerate(rows)], RAW
    )


JD, IM = "https://www.justdial.com/x", "https://dir.indiamart.com/y"
ROWS = [
    ("Synthetix Digital Solutions Pvt Ltd", "https://synthetix.in", "info@synthetix.in", "09876543210", JD, "web", "pune"),
    ("Synthetix Digital Solutions", None, "sales@synthetix.in", "+91 98765 43210", IM, "seo", "pune"),
    ("Hub It Infotech", "https://hubit.in", "bad", None, "https://e.org", "web", "delhi"),
    ("Hub It Infotech Ltd", "https://hubit2.in", "c@hubit.in", None, IM, "web", None),
    ("  ", "https://blank.in", "x@y.in", None, JD, "web", "pune"),
    ("No Contact", "https://none.in", None, " ", JD, "web", "pune"),
    ("Twin", "https://www.twin.in/a", "a@twin.in", None, JD, "web", "pune"),
    ("Atwin", "https://twin.in/b", "b@twin.in", None, JD, "web", "pune"),
]


def errors(spark, n):
    return spark.createDataFrame([(f"u{i}", None, "RobotsDisallowed") for i in range(n)], "url STRING, timestamp TIMESTAMP, error_type STRING")


def test_run_twice_is_idempotent(spark, tmp_path):
    store = S.TableStore(spark, str(tmp_path / "db"))
    targets = spark.range(4)
    first = lead_run(store, raw(spark, ROWS), errors(spark, 1), targets, AS_OF, "r1", {"web"})
    assert first["scraped"] == 8 and first["invalid_records"] == 2 and first["rejected_duplicates"] == 1
    assert first["kept_after_validation"] == 5 and first["errors"] == 1
    assert (first["created"], first["merged_phone"], first["merged_fuzzy"], first["merged_key"]) == (3, 1, 1, 0)
    assert first["Company"] == 3 and first["SOURCED_FROM"] == 4
    leads = store.read("leads").count()
    assert leads == 5
    before = store.read_graph()
    stats = {r.label: r["count"] for r in G.graph_stats(before).collect()}
    second = lead_run(store, raw(spark, ROWS), errors(spark, 1), targets, AS_OF, "r2", {"web"})
    assert second["created"] == 0 and {k: second[k] for k in stats} == stats
    # Four leads carry a website key; the keyless one is always written.
    assert store.read("leads").count() == leads + 1
    assert store.read("rejected_duplicates").count() == 2
    assert store.read("fuzzy_review").where("verdict = 'matched'").count() >= 1
    delta = G.stats_delta(G.graph_stats(before), G.graph_stats(store.read_graph()))
    assert {r.delta for r in delta.collect()} == {0}


def test_upsert_rules(spark, tmp_path):
    store = S.TableStore(spark, str(tmp_path / "db"))
    lead_run(store, raw(spark, ROWS), errors(spark, 0), spark.range(4), AS_OF, "r1")
    row = store.read("companies").where("company_name like 'Synthetix%'").first()
    assert row.company_name == "Synthetix Digital Solutions Pvt Ltd" and row.normalized_name == "synthetix digital"
    assert row.email == "sales@synthetix.in" and row.website == "https://synthetix.in"
    assert row.sources == ["Justdial", "IndiaMART"]
    graph = store.read_graph()
    found = G.query_by_location(graph, "pune").collect()
    assert [(r.company_name, r.categories, r.sources) for r in found] == [
        ("Atwin", ["web"], ["Justdial"]),
        ("Synthetix Digital Solutions Pvt Ltd", ["seo", "web"], ["IndiaMART", "Justdial"]),
    ]
    detail = G.query_company_detail(graph, "hub IT").collect()
    assert [(r.company_name, r.city, r.sources) for r in detail] == [("Hub It Infotech", "delhi", ["IndiaMART"])]
    ids = {r.raw_record_id for r in graph.sourced_from.collect()}
    assert "indiamart|synthetix digital solutions|919876543210" in ids
    assert G.company_count(graph).first()[0] == 3
    store.register_views("v_")
    assert spark.sql("SELECT count(*) FROM v_companies").first()[0] == 3


def test_failing_gate_stages_but_does_not_promote(spark, tmp_path):
    store = S.TableStore(spark, str(tmp_path / "db"))
    with pytest.raises(gates.ThresholdExceeded):
        lead_run(store, raw(spark, ROWS), errors(spark, 3), spark.range(4), AS_OF, "r1", threshold=101)
    assert store.read("staging").count() == 5 and store.read("leads").count() == 0
    with pytest.raises(gates.ThresholdExceeded):
        promote_standalone(store, spark.range(4))
    promote_standalone(store, spark.range(4), run_id="other")
    assert store.read("leads").count() == 5


def test_failed_graph_write_does_not_end_the_run(spark, tmp_path, monkeypatch):
    def fail(*_):
        raise OSError("no space left")

    monkeypatch.setattr("leadloom.plans.lead_run.resolve_into_graph", fail)
    store = S.TableStore(spark, str(tmp_path / "db"))
    summary = lead_run(store, raw(spark, ROWS), errors(spark, 0), spark.range(4), AS_OF, "r1")
    assert summary["graph_failed"] == 1 and store.read("leads").count() == 5


def test_dry_run(spark, tmp_path):
    store = S.TableStore(spark, str(tmp_path / "db"))
    summary = lead_run(store, raw(spark, ROWS), errors(spark, 9), spark.range(1), AS_OF, "r1", dry_run=True)
    assert summary["kept_after_validation"] == 5 and store.read("companies").count() == 0


def test_constraints(spark):
    with pytest.raises(ValueError):
        G.check_unique(spark.createDataFrame([("a",), ("a",)], "name STRING"), "name")


def test_store(spark, tmp_path):
    store = S.TableStore(spark, str(tmp_path / "db"))
    assert store.read("leads").count() == 0
    assert store.ensure_all() == {"leads": True, "staging": True, "scrape_errors": True, "rejected_duplicates": True}
    assert not any(store.ensure_all().values())
    store.append("scrape_errors", errors(spark, 2))
    store.append("scrape_errors", errors(spark, 0))
    store.append("scrape_errors", errors(spark, 1))
    assert store.read("scrape_errors").count() == 3
    store.truncate("scrape_errors")
    assert store.read("scrape_errors").count() == 0
    assert store.register("extra", "a STRING") and not store.register("extra", "a STRING")


def test_exports(spark, tmp_path):
    out = clean_leads(raw(spark, ROWS[:1]), AS_OF)
    row = S.lead_rows(out.scored).first()
    assert row.employee_count == "" and row.scraped_at.startswith("2026-01-31T12:00:00") and row.lead_score == "65"
    assert '"total":65' in row.lead_score_breakdown and row.category_slug == "web"
    path = str(tmp_path / "leads.csv")
    S.export_csv(S.lead_rows(out.scored), path)
    assert spark.read.option("header", True).csv(path).count() == 1
    S.export_dashboard(out.scored, str(tmp_path / "dash"))
    assert spark.read.json(str(tmp_path / "dash")).first().source == "Justdial"
    log = spark.createDataFrame([], schemas.FUZZY_REVIEW)
    for _ in range(2):
        S.export_review_log(log, str(tmp_path / "log"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert len(lines) == 1 and lines[0].startswith("timestamp|action|incoming_name")


def test_record_batch(spark, tmp_path):
    (tmp_path / "b.json").write_text('[{"company_name": "A", "lead_score": 5}, {"company_name": "B"}]')
    df = S.read_record_batch(spark, str(tmp_path / "b.json"), "company_name STRING, lead_score INT")
    assert [tuple(r) for r in df.orderBy("company_name").collect()] == [("A", 5), ("B", None)]


def test_legacy_graph(spark):
    df = spark.createDataFrame(
        [(0, "Café", "x.in", "", "9876543210", "a@b.in", "", "Pune", "IT / Web", JD),
         (1, "Cafe", "x.in", "Rd 1", "9876543210 / 022123456", "", "C@d.in", "", "", ""),
         (2, "", None, None, None, None, None, None, "N/A", "https://e.org")],
        "seq BIGINT, company_name STRING, website STRING, address STRING, phone STRING, email STRING, raw_email STRING, city STRING, industry STRING, source_url STRING",
    )
    g = build_legacy_graph(df)
    rows = {r.company_name: r for r in g.companies.collect()}
    assert set(rows) == {"Café", "Unknown"}
    assert (rows["Café"].address, rows["Café"].industry_code) == ("Rd 1 Pune", "IT___WEB")
    assert sorted(r.phone for r in g.has_phone.collect()) == ["9876543210"]
    assert sorted(r.email for r in g.has_email.collect()) == ["a@b.in", "c@d.in"]
    assert [g.located_in.count(), g.belongs_to.count(), g.sourced_from.count(), g.has_website.count()] == [1, 1, 1, 1]
    assert g.industries.first().name == "IT / Web"


def test_key_merge_is_reported(spark):
    """Names equal only after dropping descriptors share the key and merge as such."""
    df = spark.createDataFrame(
        [(0, "X Solutions", None, None), (1, "X Services", None, None)], "seq BIGINT, company_name STRING, phone STRING, website STRING"
    )
    rows = resolve(df).records.orderBy("seq").collect()
    assert [r.match_type for r in rows] == [None, "key"] and rows[0].resolved_key == rows[1].resolved_key


def test_promotion_stream(spark, tmp_path):
    store = S.TableStore(spark, str(tmp_path / "db"))
    store.ensure_all()
    staging = str(tmp_path / "staged")
    scored = clean_leads(raw(spark, ROWS), AS_OF).scored.where(F.col("dedup_key") != "")
    for _ in range(2):  # the same files again: nothing new
        store._typed("staging", scored).write.mode("append").parquet(staging)
        start_promotion_stream(spark, staging, store, str(tmp_path / "pos")).awaitTermination()
        assert store.read("leads").count() == 4


def test_run_logs_matches_below_the_usual_floor(spark, tmp_path):
    store = S.TableStore(spark, str(tmp_path / "db"))
    rows = [("Abcdefghixyz", "https://one.in", "a@one.in", None, JD, "web", "pune"),
            ("Abcdefghiuvw", "https://two.in", "b@two.in", None, IM, "web", "pune")]
    summary = lead_run(store, raw(spark, rows), errors(spark, 0), spark.range(4), AS_OF, "r1", threshold=75)
    assert summary["merged_fuzzy"] == 1
    assert [(r.score, r.verdict) for r in store.read("fuzzy_review").collect()] == [(75.0, "matched")]
