import json

from leadloom.sources.captures import scan_dimension, scan_records, scan_snapshots


def test_bad_records_are_kept_beside_the_good_ones(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"n": 1, "name": "x"}\n{"n": "seven"}\nno json\n\n{"name": "y", "more": 3}\n')
    (tmp_path / "b.json").write_text('{"n": 2}\n')
    found = scan_records(spark, str(tmp_path), "n INT, name STRING")
    assert sorted(map(tuple, found.rows.collect()), key=str) == [(1, "x"), (2, None), (None, "y")]
    errors = sorted((r.record, r.error_type, r.url[-6:]) for r in found.errors.collect())
    assert errors == [("no json", "MalformedRecord", "a.json"), ('{"n": "seven"}', "MalformedRecord", "a.json")]


def test_arrays_in_whole_files(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps([{"n": 1}, {"n": 2}], indent=1))
    (tmp_path / "bad.json").write_text('[{"n": 3}, {"n": ')
    found = scan_records(spark, str(tmp_path), "n INT", multi_line=True)
    assert {1, 2} <= {r.n for r in found.rows.collect()} and found.errors.count() == 1


def test_dimension_entries(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"slug": "pune", "labels": {"a": "Pune", "b": null}, "code": "7"}\n{"labels": {}}\n{"slug": "x", "labels": 5}\n{"slug": "y"}\n')
    found = scan_dimension(spark, str(tmp_path))
    rows = {r.slug: (r.labels, r.code) for r in found.rows.collect()}
    assert rows == {"pune": ({"a": "Pune", "b": None}, "7"), "y": (None, None)}
    assert sorted(r.error_type for r in found.errors.collect()) == ["MalformedRecord", "MissingSlug"]


def test_snapshots_with_differing_columns_in_order_of_arrival(spark, tmp_path):
    one = spark.createDataFrame([("A", "1"), ("B", None)], "name STRING, mobile STRING").coalesce(1)
    two = spark.createDataFrame([("C", None, "9", 4)], "company_name STRING, phone STRING, mobile STRING, city INT").coalesce(1)
    one.write.parquet(str(tmp_path / "1"))
    two.write.parquet(str(tmp_path / "2"))
    columns = {"company_name": ["company_name", "name"], "phone": ["phone", "mobile"], "city": ["city"], "fax": ["fax"]}
    out = scan_snapshots(spark, [str(tmp_path / "1"), str(tmp_path / "2")], columns)
    assert sorted(map(tuple, out.collect())) == [(0, 0, "A", "1", None, None), (1, 0, "B", None, None, None), (2, 1, "C", "9", "4", None)]
