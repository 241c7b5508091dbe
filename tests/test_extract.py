import json

from pyspark.sql import functions as F

from leadloom.operators import detail as T
from leadloom.operators import extract as E


def listings(spark, html, strategy):
    pages = spark.createDataFrame([(1, "https://dir.indiamart.com/l", html)], "page_id INT, url STRING, html STRING")
    return E.explode_listings(pages, strategy(F.col("html"))).orderBy("position").collect()


def ld(*blocks):
    return "".join(f'<script type="application/ld+json">{b}</script>' for b in blocks)


def test_json_ld(spark):
    node = {"@type": "LocalBusiness", "name": " A ", "url": "https://www.facebook.com/a", "telephone": "987-654-3210",
            "contactPoint": {"email": "a@a.in"}, "address": {"streetAddress": "1 Rd", "addressRegion": "MH"}}
    rows = listings(spark, ld(
        json.dumps(node), "{broken", '[{"name":"InList"}]', '{"@type":"Person","name":"P"}', '{"name":"N","address":"plain"}',
        '{"@graph":[{"@type":"Organization","name":"G","url":"https://g.in","contactPoint":[{"email":""},{"email":"g@g.in"}]},"x"]}',
    ), E.json_ld_listings)
    assert [(r.company_name, r.website, r.email, r.phone, r.address) for r in rows] == [
        ("A", None, "a@a.in", "9876543210", "1 Rd, MH"),
        ("N", None, None, None, "plain"),
        ("G", "https://g.in", "g@g.in", None, None),
    ]


def test_state(spark):
    state = {
        "data": [
            {"CMP": "Quillon", "ad": "7 Mill Lane", "city": "Nagpur", "g_s": "VD", "ds": "d" * 400, "s_url": "https://www.indiamart.com/quillon/?src=9"},
            {"CMP": " "}, 7, {"CMP": "Brack {et} House", "s_url": "https://brackhouse.example"},
        ],
        "plaWidgetData": [{"COMPANYNAME": "Quillon", "CONTACT_NUMBER": "2025550147"}, {"COMPANYNAME": "Quillon ", "CONTACT_NUMBER": "9876543210"}],
    }
    html = f"<script>window.__INITIAL_STATE__ = {json.dumps(state)}; window.x = {{}};</script>"
    a, b = listings(spark, html, E.state_listings)
    assert (a.company_name, a.website, a.phone, a.address, len(a.industry_code), a.detail_url) == (
        "Quillon", None, "9876543210", "7 Mill Lane, Nagpur, VD", 300, "https://www.indiamart.com/quillon/")
    assert (b.company_name, b.website, b.phone, b.detail_url) == ("Brack {et} House", "https://brackhouse.example", None, None)


def test_state_variants(one):
    pages = ["window.__PRELOADED_STATE__ = {\"key\": 1}", "window.__INITIAL_STATE__ = [1]", "window.__INITIAL_STATE__ = x", "none"]
    got = one(pages, E.state_json("v"))
    assert got == ['{"key": 1}', "[1]", None, None]
    assert one(["window.__INITIAL_STATE__ = {bad json};"], F.size(E.state_listings("v"))) == [0]


def test_columnar(spark):
    nested = json.dumps({"cmp_params": {"email": "n@n.in", "website": "own.in", "misc": "9876543210"}})
    results = {"columns": ["name", "VNumber", "area", "website", "bd_params"], "data": [
        ["A", 9876543211, "X", "www.a.in", None], ["B", None, None, "https://twitter.com/b", nested], {"no": 1}, ["", "1"], ["C"],
    ]}
    page = lambda props: f'<script id="__NEXT_DATA__" type="application/json">{json.dumps({"props": {"pageProps": props}})}</script>'
    for props in ({"listData": {"results": results}}, {"listingData": results}):
        rows = listings(spark, page(props), E.columnar_listings)
        assert [(r.company_name, r.phone, r.address, r.website, r.email) for r in rows] == [
            ("A", "9876543211", "X", "https://www.a.in", None),
            ("B", "9876543210", None, "https://own.in", "n@n.in"), ("C", None, None, None, None),
        ]


PAYLOADS = "page_id INT, url STRING, payloads ARRAY<STRUCT<url: STRING, body: STRING>>"


def payload_names(spark, *payloads):
    df = spark.createDataFrame([(1, "u", list(payloads))], PAYLOADS)
    return [r.company_name for r in E.explode_listings(df, E.payload_listings("payloads")).collect()]


def test_payload_choice(spark):
    generic = ("https://metrics.example/hit", '{"results":[{"name":"Plain"}]}')
    own = ("https://www.Justdial.com/api", '{"data":{"searchOutput":{"results":[{"title":"JD"}]}},"results":[{"name":"No"}]}')
    assert payload_names(spark, generic, own) == ["JD"]
    assert payload_names(spark, (None, '"text"'), (None, "bad"), (None, '{"listData":[1,{"name":"F"}]}'), generic) == ["F"]
    assert payload_names(spark, ("https://www.justdial.com", '{"results":[]}'), generic) == ["Plain"]
    assert payload_names(spark) == []


def test_payload_fields(spark):
    item = {"name": "Quillon", "VNumber": "9876543210", "address": "12 Weir Row", "area": "Oldside", "city": "Kota", "type": "Tools",
            "website": "millworks.example", "email": "post@mill.example"}
    df = spark.createDataFrame([(1, "u", [("x", json.dumps({"results": [item, {"name": ""}]}))])], PAYLOADS)
    (r,) = E.explode_listings(df, E.payload_listings("payloads")).collect()
    assert (r.phone, r.address, r.industry_code, r.website, r.email) == (
        "9876543210", "12 Weir Row, Oldside, Kota", "Tools", "https://millworks.example", "post@mill.example")


def test_text_fallback(spark):
    html = '<h2 data-name="1">Aa</h2><h2 data-name>Aa</h2><h2 data-name> B </h2> x@y.in 9876543210 https://own.in/a?b'
    rows = listings(spark, html, lambda h: E.site_text_listings(h, "justdial"))
    assert [(r.company_name, r.email, r.phone, r.website) for r in rows] == [("Aa", "x@y.in", "9876543210", "https://own.in/a")] * 2
    rows = listings(spark, '"CMP" : "Q" "CMP":"Q" "CMP":" R"', lambda h: E.site_text_listings(h, "indiamart"))
    assert [r.company_name for r in rows] == ["Q", "R"]
    rows = listings(spark, f'<h3 class="company-url"> {"N" * 250} </h3>', lambda h: E.site_text_listings(h, "tradeindia"))
    assert [len(r.company_name) for r in rows] == [200]


def test_cascade_takes_first_hit_per_page(spark):
    pages = spark.createDataFrame(
        [(1, "u", 'window.__INITIAL_STATE__ = {"data":[{"CMP":"S"}]}', "parse_indiamart"), (2, "u", '"CMP":"T"', "parse_indiamart"),
         (3, "u", "nothing", "parse_indiamart"), (4, "u", ld('{"name":"L"}'), "parse_justdial"), (5, "u", "x", "parse_new"), (6, "u", "x", None)],
        "page_id INT, url STRING, html STRING, parser STRING",
    )
    out = E.parse_pages(pages)
    assert sorted((r.page_id, r.strategy, r.company_name) for r in out.records.collect()) == [
        (1, "state", "S"), (2, "text", "T"), (4, "json_ld", "L")]
    assert [r.error_type for r in out.errors.collect()] == ["UnknownParser"] * 2


def test_registering_a_parser(spark):
    @E.register_parser("parse_titles")
    def titles(pages):
        return E.explode_listings(pages, E.text_listings("html", [r"<h1>([^<]+)</h1>"]))

    try:
        pages = spark.createDataFrame([(1, "u", "<h1>One</h1>", "parse_titles")], "page_id INT, url STRING, html STRING, parser STRING")
        assert [r.company_name for r in E.parse_pages(pages).records.collect()] == ["One"]
    finally:
        E.REGISTRY.pop("parse_titles")


def test_pairing(spark):
    df = spark.createDataFrame(
        [("https://dir.indiamart.com/a/", [(" ", "/x"), ("A", "/p1"), ("B", "/q#"), ("C", None), ("D", "/p4")], [("A",), ("B",), ("C",)])],
        "url STRING, cards ARRAY<STRUCT<name: STRING, href: STRING>>, records ARRAY<STRUCT<company_name: STRING>>",
    )
    rows = E.pair_by_position(df, "/").collect()
    assert [(r.record.company_name, r.detail_url) for r in rows] == [
        ("A", "https://dir.indiamart.com/p1"), ("B", None), ("C", None)]


RECORD = "record_id BIGINT, seq BIGINT, phone STRING, email STRING, website STRING, detail_url STRING"


def test_enrichment(spark):
    records = spark.createDataFrame(
        [(1, 1, "111", "a@a.in", None, "u"), (2, 2, None, "old@a.in", None, "u"), (3, 3, "222", None, None, "u"),
         (4, 4, None, None, None, "u"), (5, 5, None, None, None, None)], RECORD)
    pages = spark.createDataFrame(
        [(1, "9876543210 n@n.in"), (2, "9876543210 new@n.in https://own.in"), (3, "01146710423 helpdesk@tradeindia.com"), (4, "None")],
        "record_id BIGINT, html STRING")
    details = T.detail_contacts(pages)
    merged = T.enrich(records, details)
    got = {r.record_id: (r.phone, r.email, r.website) for r in merged.collect()}
    assert got == {1: ("111", "a@a.in", None), 2: ("9876543210", "new@n.in", "https://own.in"), 3: (None, None, None),
                   4: (None, None, None), 5: (None, None, None)}
    assert T.enrich_stats(merged).first().asDict() == {
        "attempted": 3, "fetched": 2, "fetch_failed": 1, "phone_unavailable": 1, "email_unavailable": 1, "website_unavailable": 1}
    gaps = {r.record_id: (r.phone, r.email) for r in T.enrich(records, details, detail_wins=False).collect()}
    assert gaps[2] == ("9876543210", "old@a.in") and gaps[3] == ("222", None)
    assert [r.record_id for r in T.select_needy(records, 2).collect()] == [2, 3]
    filled = {r.record_id: r.phone for r in T.backfill_phone(records, pages).collect()}
    assert filled == {1: "111", 2: "9876543210", 3: "222", 4: None, 5: None}


def test_revealed(spark):
    rows = [[("x/get-user-mobile", '{"default_mobile":"0","default_email":" a@a.in "}'), ("x/other", '{"default_mobile":"2025550147"}'),
             ("x/get-user-mobile", "bad"), ("x/get-user-mobile", '{"default_mobile":"9876543210","default_email":"late@a.in"}')]]
    df = spark.createDataFrame([(1, "", p) for p in rows], "record_id INT, html STRING, payloads ARRAY<STRUCT<url: STRING, body: STRING>>")
    row = df.select(E.revealed_contacts("payloads").alias("c")).first().c
    assert (row.phone, row.email) == ("9876543210", "a@a.in")
    assert T.detail_contacts(df, reveal=True).first().detail_phone == "9876543210"


def test_binary_pages(spark):
    df = spark.createDataFrame([(bytearray(b"ok \xff"),)], "raw BINARY")
    assert df.select(E.page_text("raw", binary=True)).first()[0] == "ok �"
