import random

import pytest
from pyspark.sql import functions as F

from leadloom.operators import frontier as R
from leadloom.sources import dims

CONFIG = {
    "targets": [
        {"name": "IndiaMART", "enabled": True, "max_pages": 0}, {"name": "TradeIndia", "enabled": True},
        {"name": "Justdial", "enabled": False}, {"name": "Other", "enabled": True},
    ],
    "categories": [
        {"slug": "web", "labels": {"indiamart": "web-services"}}, {"slug": "seo", "labels": {"tradeindia": ""}},
    ],
    "cities": [
        {"slug": "pune", "labels": {"indiamart": "Pune"}, "tradeindia_code": "1"},
        {"slug": "surat", "labels": {}, "tradeindia_code": "2"},
    ],
    "url_templates": {"indiamart": "https://i/{city}/{category}", "tradeindia": "https://t/{city}-{code}/{category}"},
    "icp_categories": ["web", {"slug": "seo"}], "fuzzy_match_threshold": "85",
}


def expand(spark, config):
    return R.expand_start_urls(dims.categories_df(spark, config), dims.cities_df(spark, config), dims.url_templates(config))


def test_frontier_order_labels_and_codes(spark):
    urls = [r.url for r in expand(spark, CONFIG).urls.orderBy("ordinal").collect()]
    assert urls == [
        "https://i/Pune/web-services", "https://i/surat/web-services", "https://i/Pune/seo", "https://i/surat/seo",
        "https://t/pune-1/web", "https://t/surat-2/web",
    ]


def test_missing_code_fails_only_that_site(spark):
    cities = [dict(c) for c in CONFIG["cities"]]
    cities[1].pop("tradeindia_code")
    out = expand(spark, {**CONFIG, "cities": cities})
    assert {r.site for r in out.urls.collect()} == {"indiamart"}
    assert [(r.site, r.error_type) for r in out.config_errors.collect()] == [("tradeindia", "ConfigError")]


def test_empty_dimensions(spark):
    assert expand(spark, {**CONFIG, "cities": []}).urls.count() == 0


def test_targets(spark):
    targets = dims.targets_df(spark, CONFIG)
    assert {r.name for r in R.enabled_targets(targets).collect()} == {"IndiaMART", "TradeIndia"}
    bad = R.target_config_errors(targets, dims.url_templates(CONFIG)).collect()
    assert [(r.site, r.url) for r in bad] == [("indiamart", "https://i/{city}/{category}")]


def test_config_values(tmp_path):
    assert dims.load_config(str(tmp_path / "none.json")) == {}
    broken = tmp_path / "c.json"
    broken.write_text("[1]")
    assert dims.load_config(str(broken)) == {}
    broken.write_text("{")
    with pytest.raises(ValueError):
        dims.load_config(str(broken))
    assert dims.fuzzy_threshold(CONFIG) == 85 and dims.fuzzy_threshold({"fuzzy_match_threshold": "x"}) == 90
    assert dims.icp_list(CONFIG, "icp_categories") == {"web", "seo"}


def test_expand_pages(spark):
    df = spark.createDataFrame([("https://a/", 3)], "url STRING, n INT")
    assert [r.page_url for r in R.expand_pages(df, F.col("n")).collect()] == [
        "https://a/", "https://a?page=2", "https://a?page=3",
    ]


def naive_quota(requests, caps, prior):
    used, allowed = dict(prior), {}
    for date, domain, seq in sorted(requests, key=lambda r: r[2]):
        n = used.get((date, domain), 0)
        allowed[seq] = n < caps.get(domain, 0)
        used[date, domain] = n + allowed[seq]
    return allowed, used


def test_quota_against_sequential_counter(spark):
    rng = random.Random(3)
    caps = {"a": 4, "b": 7, "hot": 5}
    requests = [(f"d{rng.randrange(3)}", rng.choice(["a", "b", "hot", "hot", "hot"]), s) for s in range(300)]
    prior = {("d0", "hot"): 3, ("d1", "b"): 9}
    allowed, used = naive_quota(requests, caps, prior)
    df = spark.createDataFrame(requests, "date STRING, domain STRING, seq BIGINT").repartition(5)
    caps_df = spark.createDataFrame(list(caps.items()), "domain STRING, cap INT")
    prior_df = spark.createDataFrame([(d, m, n) for (d, m), n in prior.items()], "date STRING, domain STRING, consumed INT")
    for hot_rows in (10, 10**6):
        got = R.daily_quota(df, caps_df, prior_df, hot_rows)
        assert {r.seq: r.allowed for r in got.collect()} == allowed
    report = R.quota_report(df, caps_df, prior_df).collect()
    assert {(r.date, r.domain): r.used for r in report} == used
    denied = {(d, m) for d, m, s in requests if not allowed[s]}
    assert {(r.date, r.domain) for r in report if r.cap_reached} == denied


def test_quota_has_no_hidden_limits(spark):
    requests = [("d", "a", s) for s in range(60)] + [("d", None, 100), (None, "a", 101), ("d", "unknown", 102)]
    df = spark.createDataFrame(requests, "date STRING, domain STRING, seq BIGINT")
    caps = spark.createDataFrame([("a", 50), ("b", 3)], "domain STRING, cap INT")
    for hot_rows in (5, 10**6):
        got = {r.seq: r.allowed for r in R.daily_quota(df, caps, None, hot_rows).collect()}
        assert got == {s: s < 50 for _, _, s in requests}
    report = {(r.date, r.domain): (r.used, r.cap_reached) for r in R.quota_report(df, caps).collect()}
    assert report[("d", "a")] == (50, True) and report[("d", None)] == (0, True)


def test_absent_slugs_and_other_sites(spark):
    schema = "site STRING, category_slug STRING, city_slug STRING, page INT"
    targets = [("indiamart", None, "x"), ("tradeindia", None, None), ("justdial", "c", "x"), (None, "c", "x")]
    rows = [(*t, p, n, 10 * i + p) for i, t in enumerate(targets) for p, n in ((1, "A"), (2, "a "), (3, "B"))]
    records = spark.createDataFrame(rows, schema + ", company_name STRING, seq BIGINT")
    for hot_rows in (1, 10**6):
        out = R.early_stop(records.select("site", "category_slug", "city_slug", "page"), records, hot_rows=hot_rows)
        assert {tuple(r) for r in out.stops.collect()} == {("indiamart", None, "x", 2, "0_new"), ("tradeindia", None, None, 2, "0_new")}
        assert sorted(r.seq for r in out.records.collect()) == [1, 2, 11, 12, 21, 22, 23, 31, 32, 33]


def naive_pagination(pages, names, max_pages):
    seen, page = set(), 1
    while True:
        rows = names.get(page, [])
        if not rows:
            return page, "empty"
        new = {n.lower().strip() for n in rows} - {""} - seen
        if not new:
            return page, "0_new"
        seen |= new
        if page >= max_pages:
            return page, None
        page += 1


def test_early_stop_against_sequential_crawl(spark):
    rng = random.Random(8)
    pages, records, truth = [], [], {}
    for t in range(12):
        names = {p: [rng.choice(["A", " a", "B", "C ", "D", " ", "E"]) for _ in range(rng.randrange(4))] for p in range(1, 7)}
        truth[f"c{t}"] = naive_pagination(range(1, 7), names, 5)
        for p, rows in names.items():
            pages.append(("indiamart", f"c{t}", "x", p))
            records += [("indiamart", f"c{t}", "x", p, n) for n in rows]
    schema = "site STRING, category_slug STRING, city_slug STRING, page INT"
    pages_df = spark.createDataFrame(pages, schema)
    records_df = spark.createDataFrame([(*r, i) for i, r in enumerate(records)], schema + ", company_name STRING, seq BIGINT")
    for hot_rows in (3, 10**6):
        out = R.early_stop(pages_df, records_df, max_pages=5, hot_rows=hot_rows)
        stops = {r.category_slug: (r.stop_page, r.reason) for r in out.stops.collect()}
        assert stops == {c: v for c, v in truth.items() if v[1]}
        kept = sorted(r.seq for r in out.records.collect())
        assert kept == [i for i, r in enumerate(records) if r[3] <= truth[r[1]][0]]


def test_dedupe_endpoints(spark):
    df = spark.createDataFrame(
        [(2, "http://u:p@h:1"), (1, "h:1"), (3, " "), (4, "h:2/x")], "seq BIGINT, endpoint STRING"
    )
    assert sorted((r.endpoint_key, r.seq) for r in R.dedupe_endpoints(df).collect()) == [("h:1", 1), ("h:2", 4)]


def test_fetch_log_summaries(spark):
    df = spark.createDataFrame(
        [("jd", "p1", 403, "x", "http://u:p@h:1", False), ("jd", "p1", 403, "x" * 600, "h:1", False),
         ("jd", "p1", 200, "é" * 300, None, True), ("im", "p2", 200, "y" * 500, None, True), ("im", "p2", 200, None, None, True)],
        "site STRING, parser STRING, status INT, body STRING, endpoint STRING, yielded BOOLEAN",
    )
    rows = {r.site: tuple(r)[1:] for r in R.outcome_summary(df).collect()}
    assert rows == {"jd": (1, 1, 1), "im": (1, 1, 1)}
    assert {r.parser: r.bytes for r in R.bytes_fetched(df).collect()} == {"p1": 600, "p2": 500, None: 1100}
