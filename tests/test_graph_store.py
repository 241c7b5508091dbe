"""The stored graph: one commit for seven tables, untouched buckets, failing and racing writers."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from leadloom.operators import graph as G
from leadloom.operators.resolve import resolve
from leadloom.operators.similar import indexed_names
from leadloom.schemas import BREAKDOWN
from leadloom.sources.graph_store import ConcurrentWrite, GraphStore
from leadloom.sources.tables import TableStore

AS_OF = "2026-01-31 12:00:00"
RECORD = ("seq BIGINT, company_name STRING, phone STRING, email STRING, website STRING, address STRING, industry_code STRING, "
          "source_url STRING, category_slug STRING, city_slug STRING, lead_score INT")
NAMES = ["Acme", "Borealis", "Cobalt", "Dunlin", "Emerald", "Falcon", "Garnet", "Heron", "Indigo", "Juniper"]


def records(spark, names, start=0, city="pune"):
    rows = [(start + i, f"{n} Works {i % 3}", None, f"{n}@x.in".lower(), f"https://{n.lower()}.in", "Rd", "IT",
             "https://www.justdial.com/x", f"cat-{i % 4}", city, 50 + i) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, RECORD)
    return df.withColumn("lead_score_breakdown", F.lit(None).cast(BREAKDOWN))


def resolved(spark, store, names, **more):
    return resolve(records(spark, names, **more), store.table("companies"), threshold=101).records


def contents(graph):
    return {name: sorted(map(str, getattr(graph, name).collect())) for name in G.Graph._fields}


def files(root):
    return {p.name: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_two_batches_equal_the_graph_built_in_one_piece(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"), buckets=8)
    assert store.head() is None and store.table("companies").count() == 0
    first = resolved(spark, store, NAMES[:7])
    store.upsert(first, AS_OF)
    whole = G.build_graph(first, AS_OF)
    assert contents(store.read()) == contents(whole)
    second = resolved(spark, store, NAMES[4:], start=100, city="delhi")
    assert store.upsert(second, "2026-02-01 12:00:00")["version"] == 1
    assert contents(store.read()) == contents(G.build_graph(second, "2026-02-01 12:00:00", whole))


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"), buckets=16)
    before = store.upsert(resolved(spark, store, NAMES), AS_OF)
    old = files(tmp_path)
    after = store.upsert(resolved(spark, store, NAMES[:1], start=100), "2026-02-02 12:00:00")
    same = [b for b, f in before["tables"]["companies"].items() if after["tables"]["companies"].get(b) == f]
    changed = [b for b, f in after["tables"]["companies"].items() if before["tables"]["companies"].get(b) != f]
    assert len(changed) == 1 and len(same) == len(before["tables"]["companies"]) - 1
    now = files(tmp_path)
    assert {n: t for n, t in now.items() if n in old} == old
    assert contents(store.read(before)) != contents(store.read(after))
    assert store.table("companies").count() == len(NAMES)


@pytest.mark.parametrize("fails_at", ["listed_in", "cities", "source_nodes"])
def test_failure_between_two_tables_leaves_the_version_before(spark, tmp_path, monkeypatch, fails_at):
    store = GraphStore(spark, str(tmp_path / "g"), buckets=4)
    store.upsert(resolved(spark, store, NAMES[:5]), AS_OF)
    want = contents(store.read())
    batch = resolved(spark, store, NAMES, start=50, city="delhi")
    write = GraphStore._write

    def broken(self, name, *rest):
        if name == fails_at:
            raise OSError("no space left")
        return write(self, name, *rest)

    monkeypatch.setattr(GraphStore, "_write", broken)
    with pytest.raises(OSError):
        store.upsert(batch, AS_OF)
    assert store.head()["version"] == 0 and contents(store.read()) == want
    monkeypatch.undo()
    assert store.upsert(batch, AS_OF)["version"] == 1
    assert store.table("companies").count() == len(NAMES)


def test_second_writer_fails(spark, tmp_path, monkeypatch):
    store, other = (GraphStore(spark, str(tmp_path / "g"), buckets=4) for _ in range(2))
    store.upsert(resolved(spark, store, NAMES[:3]), AS_OF)
    mine, theirs = resolved(spark, store, NAMES[3:6], start=50), resolved(spark, other, NAMES[6:], start=60)
    write, done = GraphStore._write, []

    def meanwhile(self, name, *rest):
        if self is store and not done:
            done.append(1)
            other.upsert(theirs, AS_OF)
        return write(self, name, *rest)

    monkeypatch.setattr(GraphStore, "_write", meanwhile)
    with pytest.raises(ConcurrentWrite):
        store.upsert(mine, AS_OF)
    assert store.head()["version"] == 1 and store.table("companies").count() == 3 + len(NAMES[6:])


def test_constraints_are_checked_before_the_commit(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"), buckets=4)
    graph = G.build_graph(resolved(spark, store, NAMES[:3]), AS_OF)
    twice = graph._replace(companies=graph.companies.unionByName(graph.companies))
    with pytest.raises(ValueError, match="duplicate key"):
        store.replace(twice)
    assert store.head() is None
    store.replace(graph)
    assert contents(store.read()) == contents(graph)


def test_graph_tables_are_written_as_a_whole(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    with pytest.raises(ValueError):
        store.append("companies", store.read("companies"))
    assert not store.exists("companies")


def test_writers_of_one_table_version_do_not_overwrite_each_other(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "db"))
    store.truncate("leads")
    monkeypatch.setattr(TableStore, "_folders", lambda self, name, committed=False: [])
    with pytest.raises(Exception, match="exist"):
        store.truncate("leads")


def test_an_abandoned_version_is_passed_over(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    (tmp_path / "db/leads/v=0").mkdir(parents=True)
    store.truncate("leads")
    assert store._versions("leads") == [1] and store.read("leads").count() == 0


def test_second_batch_looks_names_up_in_the_stored_index(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"), buckets=4)
    assert store.index().leaders.count() == 0
    store.upsert(resolve(records(spark, NAMES + ["", "Ac"]), store.index()).records, AS_OF)
    store.upsert(resolve(records(spark, ["Kestrel"], start=30), store.index()).records, AS_OF)
    names = [n[:-1] + "x" for n in NAMES] + NAMES[:4] + ["", "A", "Kestrell", "Quite New"]
    batch = records(spark, names, start=100).withColumn("website", F.lit(None).cast("string"))
    pick = lambda r: sorted(map(str, r.records.select("seq", "resolved_key", "match_type", "matched_name", "fuzzy_score").collect()))
    plain = pick(resolve(batch, store.table("companies"), 85))
    assert pick(resolve(batch, store.index(), 85)) == plain
    assert pick(resolve(batch, store.index(), 85, first_generation=4)) == plain
    assert pick(resolve(batch, store.index(), 70)) == pick(resolve(batch, store.table("companies"), 70))
    assert sum("fuzzy" in r for r in plain) >= 5


def test_the_index_is_read_once_and_names_are_not_normalized_again(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "g"), buckets=4)
    store.upsert(resolved(spark, store, NAMES), AS_OF)
    index = store.index()
    nodes = spark.createDataFrame([("acme works", "acme works")], "in_form STRING, in_norm STRING")
    plan = indexed_names(nodes, index.segments, index.made_for, 90)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "regexp" not in plan
    assert "regexp" not in index.leaders._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        indexed_names(nodes, index.segments, index.made_for, index.made_for - 5)
