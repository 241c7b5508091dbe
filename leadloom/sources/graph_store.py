"""The company graph as one versioned unit: seven tables in hash buckets under one commit.

A version is a small JSON file that lists, per table, the folder of every bucket. A write puts new
bucket folders beside the old ones, checks the uniqueness constraints on what it wrote, and then
creates the next version file, which only one writer can. Buckets that a batch does not touch keep
their folders and files. A failed write leaves folders no version names; readers never see them.

Beside the tables lies what resolution needs of the companies: their name forms and the segments of
those. Name and form are fixed when a company is founded, so a write only adds the new ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.operators import graph as G
from leadloom.operators.resolve import REVIEW_FLOOR, RegistryIndex, as_leaders
from leadloom.operators.search import name_postings
from leadloom.operators.similar import segment_index
from leadloom.schemas import GRAPH_TABLES

BUCKETS = 32
# What :func:`leadloom.operators.resolve.resolve` looks up, for thresholds from this one upwards.
INDEX_FROM = REVIEW_FLOOR
_FORMS = "leader_key STRING, leader_name STRING, cand_form STRING, cand_norm STRING"
_POSTINGS = "gram STRING, dedup_key STRING"
_SEGMENTS = "sig BIGINT, blocked BOOLEAN, cand_form STRING, cand_norm STRING"
_NAMES = {"categories": ("listed_in", "category"), "cities": ("located_in", "city"), "source_nodes": ("sourced_from", "source")}


class ConcurrentWrite(RuntimeError):
    """Another writer committed a version since this one began."""


class GraphStore:
    """Versions of the graph below ``root`` (any Hadoop path).

    ``buckets`` counts for the first version; later ones keep the number it was made with. A bucket is
    written by one task, so choose it by the expected number of companies.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self._buckets = spark, root.rstrip("/"), buckets

    # -- versions -----------------------------------------------------------------------

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _names(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def head(self) -> dict | None:
        """The newest version, or None before the first."""
        numbers = [int(n[:-5]) for n in self._names(f"{self.root}/versions") if n.endswith(".json") and n[:-5].isdigit()]
        if not numbers:
            return None
        fs, at = self._fs(f"{self.root}/versions/{max(numbers):08d}.json")
        stream = fs.open(at)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, base: dict | None, tables: dict[str, dict[str, str]], index: list[str]) -> dict:
        version = 0 if base is None else base["version"] + 1
        content = {"version": version, "buckets": self._count(base), "tables": tables, "index": index, "index_from": INDEX_FROM}
        fs, at = self._fs(f"{self.root}/versions/{version:08d}.json")
        if fs.exists(at):
            raise ConcurrentWrite(f"version {version} of {self.root} was written by another run")
        # A whole file appears at once, and only where there is none yet.
        fs, draft = self._fs(f"{self.root}/drafts/{uuid.uuid4().hex}.json")
        out = fs.create(draft, False)
        out.write(json.dumps(content).encode())
        out.close()
        fs.mkdirs(at.getParent())
        if fs.exists(at) or not fs.rename(draft, at):
            raise ConcurrentWrite(f"version {version} of {self.root} was written by another run")
        return content

    def _count(self, base: dict | None) -> int:
        return self._buckets if base is None else base["buckets"]

    # -- reads --------------------------------------------------------------------------

    def table(self, name: str, only: Iterable[int] | None = None, version: dict | None = None) -> DataFrame:
        """A table of the newest (or the given) version, or some of its buckets."""
        head = version or self.head()
        folders = head["tables"].get(name, {}) if head else {}
        wanted = folders if only is None else {str(b): folders[str(b)] for b in only if str(b) in folders}
        if not wanted:
            return self.spark.createDataFrame([], GRAPH_TABLES[name])
        paths = [f"{self.root}/data/{folder}/{name}/bucket={b}" for b, folder in sorted(wanted.items())]
        return self.spark.read.schema(GRAPH_TABLES[name]).parquet(*paths)

    def read(self, version: dict | None = None) -> G.Graph:
        head = version or self.head()
        return G.Graph(**{name: self.table(name, version=head) for name in G.Graph._fields})

    def index(self) -> RegistryIndex:
        """Forms and segments of all companies of the newest version, for :func:`resolve`."""
        made_for = (self.head() or {}).get("index_from", INDEX_FROM)
        return RegistryIndex(self._indexed("forms", _FORMS), self._indexed("segments", _SEGMENTS), made_for)

    def postings(self) -> DataFrame:
        """Trigrams of all company names, for :func:`leadloom.operators.search.find_names`."""
        return self._indexed("postings", _POSTINGS)

    def _indexed(self, name: str, schema: str) -> DataFrame:
        folders = (self.head() or {}).get("index", [])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{f}/{name}" for f in folders])

    # -- writes -------------------------------------------------------------------------

    def bucket(self, key: str | Column, base: dict | None) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self._count(base))).cast("int")

    def _touched(self, df: DataFrame, key: str, base: dict | None) -> list[int]:
        """Buckets of the keys of ``df``: at most their fixed number."""
        return sorted(r[0] for r in df.select(self.bucket(key, base).alias("b")).distinct().collect())

    def _write(self, name: str, df: DataFrame, folder: str, base: dict | None) -> dict[str, str]:
        """Write rows by bucket and return the buckets' folder."""
        key = "name" if name in _NAMES else "dedup_key"
        fields = self.spark.createDataFrame([], GRAPH_TABLES[name]).schema.fields
        typed = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        path = f"{self.root}/data/{folder}/{name}"
        typed.withColumn("bucket", self.bucket(key, base)).repartition("bucket").sortWithinPartitions("bucket", key).write.partitionBy("bucket").parquet(path)
        written = [n[7:] for n in self._names(path) if n.startswith("bucket=")]
        return dict.fromkeys(written, folder)

    def _write_index(self, founded: DataFrame, folder: str) -> None:
        """Forms, segments and name trigrams of new companies, the latter two in order, so that files tell their range."""
        forms, path = founded.select("leader_key", "leader_name", "cand_form", "cand_norm"), f"{self.root}/data/{folder}"
        forms.write.parquet(f"{path}/forms")
        stored = self.spark.read.schema(_FORMS).parquet(f"{path}/forms")
        segment_index(stored.select("cand_form", "cand_norm").distinct(), float(INDEX_FROM)).repartitionByRange("sig").sortWithinPartitions(
            "sig").write.parquet(f"{path}/segments")
        name_postings(stored, "leader_key", "leader_name").repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/postings")

    def _write_all(self, tables: dict[str, DataFrame], founded: DataFrame, folder: str, base: dict | None) -> dict[str, dict[str, str]]:
        """The tables and the index do not depend on one another: their jobs run side by side."""
        with ThreadPoolExecutor(len(tables) + 1) as pool:
            index = pool.submit(self._write_index, founded, folder)
            written = pool.map(lambda item: self._write(*item, folder, base), tables.items())
            done = dict(zip(tables, written, strict=True))
            index.result()
            return done

    def _check(self, written: dict[str, dict[str, str]]) -> None:
        """Uniqueness of company keys and node names. A key lies in one bucket, so the written ones tell."""
        keyed = []
        for name, key in [("companies", "dedup_key"), *[(n, "name") for n in _NAMES]]:
            if written[name]:
                paths = [f"{self.root}/data/{folder}/{name}/bucket={b}" for b, folder in written[name].items()]
                keyed.append(self.spark.read.schema(GRAPH_TABLES[name]).parquet(*paths).select(F.lit(name).alias("table"), F.col(key).alias("key")))
        if keyed:
            G.check_unique(reduce(DataFrame.unionByName, keyed), "table", "key")

    def replace(self, graph: G.Graph) -> dict:
        """All seven tables as the next version."""
        base, folder = self.head(), uuid.uuid4().hex
        tables = self._write_all(graph._asdict(), as_leaders(graph.companies), folder, base)
        self._check(tables)
        return self._commit(base, tables, [folder])

    def upsert(self, resolved: DataFrame, as_of) -> dict:
        """Bring resolved records in: only buckets holding one of their keys or names are rewritten.

        ``resolved`` is read several times; give a stored table.
        """
        base, folder = self.head(), uuid.uuid4().hex
        keys = self._touched(resolved, "resolved_key", base)
        old = G.Graph(*[self.table(n, keys, base) for n in G.Graph._fields[:4]], None, None, None)
        fresh = {
            "companies": G.upsert_companies(resolved, as_of, old.companies),
            "listed_in": G.listed_in(resolved, old.listed_in),
            "located_in": G.located_in(resolved, old.located_in),
            "sourced_from": G.sourced_from(resolved, as_of, old.sourced_from),
        }
        touched = dict.fromkeys(fresh, keys)
        for name, (edges, column) in _NAMES.items():
            made = {"listed_in": G.listed_in(resolved), "located_in": G.located_in(resolved), "sourced_from": G.sourced_from(resolved, as_of)}[edges]
            names = made.select(F.col(column).alias("name")).distinct()
            touched[name] = self._touched(names, "name", base)
            fresh[name] = names.unionByName(self.table(name, touched[name], base)).distinct()
        founded = resolved.where("match_type IS NULL").select(F.col("resolved_key").alias("dedup_key"), F.col("stored_name").alias("company_name"), F.col("in_norm").alias("normalized_name"))
        tables = self._write_all(fresh, as_leaders(founded), folder, base)
        self._check(tables)
        if base is not None:
            for name, folders in base["tables"].items():
                kept = {b: f for b, f in folders.items() if int(b) not in set(touched[name])}
                tables[name] = kept | tables[name]
        return self._commit(base, tables, [*(base or {"index": []})["index"], folder])
