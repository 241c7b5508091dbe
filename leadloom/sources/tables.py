"""Table store on a shared folder: scans, appends, overwrites and exports as parquet.

There is no MERGE on plain parquet, so replaced tables are written as a new version folder;
a version counts once its job has committed (``_SUCCESS``), and readers take the newest
committed one. Readers of an older version keep their files. The seven graph tables change
together, see :mod:`leadloom.sources.graph_store`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom import constants as K
from leadloom.operators.extract import page_text
from leadloom.operators.graph import Graph
from leadloom.operators.report import dashboard_rows
from leadloom.operators.resolve import review_lines
from leadloom.schemas import FUZZY_REVIEW, GRAPH_TABLES, QUOTA_TABLES, TABLES
from leadloom.sources.graph_store import GraphStore


class TableStore:
    """Named tables below ``root`` (any Hadoop path)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = {**TABLES, **GRAPH_TABLES, "fuzzy_review": FUZZY_REVIEW, **QUOTA_TABLES}
        self.graph = GraphStore(spark, f"{self.root}/graph")

    # -- paths --------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        conf = self.spark._jsc.hadoopConfiguration()
        return hadoop_path.getFileSystem(conf), hadoop_path

    def _folders(self, name: str, committed: bool = False) -> list[int]:
        """Versions of a table, oldest first, with or without those whose job never ended."""
        fs, path = self._fs(f"{self.root}/{name}")
        if not fs.exists(path):
            return []
        jvm = self.spark._jvm
        found = []
        for status in fs.listStatus(path):
            label = status.getPath().getName()
            marker = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if label.startswith("v=") and (not committed or fs.exists(marker)):
                found.append(int(label[2:]))
        return sorted(found)

    def _versions(self, name: str) -> list[int]:
        return self._folders(name, committed=True)

    @staticmethod
    def _own(name: str) -> None:
        if name in GRAPH_TABLES:
            raise ValueError(f"{name} is part of the graph, which is written as a whole")

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v={version}"

    # -- reads --------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self.graph.head() is not None if name in GRAPH_TABLES else bool(self._versions(name))

    def read(self, name: str) -> DataFrame:
        """Newest version of a table; an unwritten table is empty."""
        if name in GRAPH_TABLES:
            return self.graph.table(name)
        versions = self._versions(name)
        if not versions:
            return self.spark.createDataFrame([], self.schemas[name])
        paths = [self._path(name, versions[-1]), *self._batch_paths(name, versions[-1])]
        return self.spark.read.schema(self.schemas[name]).parquet(*paths)

    # -- writes -------------------------------------------------------------------------

    def overwrite(self, name: str, df: DataFrame) -> None:
        """Replace a table by writing its next version; a second writer of that version fails."""
        self._own(name)
        nxt = max(self._folders(name), default=-1) + 1
        self._typed(name, df).write.mode("errorifexists").parquet(self._path(name, nxt))

    def append(self, name: str, df: DataFrame) -> None:
        """Append rows to the current version; appending nothing leaves the table as it is."""
        self._own(name)
        versions = self._versions(name)
        current = versions[-1] if versions else max(self._folders(name), default=-1) + 1
        self._typed(name, df).write.mode("append").parquet(self._path(name, current))

    # -- batches of a stream ------------------------------------------------------------

    def _children(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _batch_paths(self, name: str, version: int, stream: str | None = None, but: int | None = None) -> list[str]:
        """Folders of the complete batches that belong to a version of a table."""
        root, out = f"{self.root}/{name}/batches/v={version}", []
        for own in self._children(root):
            for batch in self._children(f"{root}/{own}"):
                wanted = stream in (None, own[7:]) and not (but is not None and own[7:] == stream and int(batch[6:]) == but)
                if wanted and "_SUCCESS" in self._children(f"{root}/{own}/{batch}"):
                    out.append(f"{root}/{own}/{batch}")
        return out

    def write_batch(self, name: str, stream: str, batch_id: int, choose: Callable[[DataFrame], DataFrame]) -> None:
        """Add one batch of a stream to a table, in a folder of its own.

        ``choose`` gets the table without this batch and returns the rows to add. A replayed batch
        replaces its folder, so it adds the same rows again and none twice, whatever their keys.
        """
        self.ensure_all([name])
        version = self._versions(name)[-1]
        paths = [self._path(name, version), *self._batch_paths(name, version, stream, batch_id)]
        before = self.spark.read.schema(self.schemas[name]).parquet(*paths)
        rows = self._typed(name, choose(before))
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/batches/v={version}/stream={stream}/batch={batch_id}")

    def read_batches(self, name: str, stream: str) -> DataFrame:
        """What a stream has added to the present version of a table."""
        versions = self._versions(name)
        paths = self._batch_paths(name, versions[-1], stream) if versions else []
        if not paths:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(*paths)

    # -- several tables as one version --------------------------------------------------

    def overwrite_together(self, group: str, tables: dict[str, DataFrame]) -> None:
        """Tables that change together: one version folder, complete once its marker is there."""
        version = max(self._folders(group), default=-1) + 1
        for name, df in tables.items():
            self._typed(name, df).write.mode("errorifexists").parquet(f"{self._path(group, version)}/{name}")
        fs, marker = self._fs(f"{self._path(group, version)}/_SUCCESS")
        fs.create(marker, False).close()

    def read_together(self, group: str, name: str) -> DataFrame:
        versions = self._versions(group)
        if not versions:
            return self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(self.schemas[name]).parquet(f"{self._path(group, versions[-1])}/{name}")

    def ensure_all(self, names: list[str] | None = None) -> dict[str, bool]:
        """Create missing tables; returns {table: created now}."""
        created = {}
        for name in names or list(TABLES):
            created[name] = not self.exists(name)
            if created[name]:
                self.truncate(name)
        return created

    def register(self, name: str, schema: str) -> bool:
        """Declare a further table (its schema is fixed on first use); True when created."""
        self.schemas.setdefault(name, schema)
        return self.ensure_all([name])[name]

    def truncate(self, *names: str) -> None:
        for name in names:
            self.overwrite(name, self.spark.createDataFrame([], self.schemas[name]))

    def _typed(self, name: str, df: DataFrame) -> DataFrame:
        """Columns of the table schema in order; columns the input lacks become NULL."""
        fields = self.spark.createDataFrame([], self.schemas[name]).schema.fields
        return df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in fields
            ]
        )

    # -- graph --------------------------------------------------------------------------

    def read_graph(self) -> Graph:
        return self.graph.read()

    def write_graph(self, graph: Graph) -> None:
        """All seven tables in one commit."""
        self.graph.replace(graph)

    def upsert_graph(self, resolved: DataFrame, as_of) -> None:
        """Resolved records into the graph: touched buckets only, in one commit."""
        self.graph.upsert(resolved, as_of)

    def register_views(self, prefix: str = "") -> None:
        """Expose every stored table to ``spark.sql``."""
        for name in self.schemas:
            if self.exists(name):
                self.read(name).createOrReplaceTempView(prefix + name)


def read_record_batch(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON array batch of records. The reader splits by file, so keep batches in many files."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_pages(spark: SparkSession, path: str, binary: bool = False) -> DataFrame:
    """Captured pages; binary captures are decoded as UTF-8, bad bytes replaced."""
    pages = spark.read.parquet(path)
    return pages.withColumn("html", page_text("html", binary=True)) if binary else pages


def read_legacy_leads(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot of a legacy lead table (parquet); needs an arrival order column ``seq``."""
    return spark.read.parquet(path)


# --- flat exports ------------------------------------------------------------------------


def _flat(name: str, dtype: str) -> Column:
    c = F.col(name)
    if dtype == "timestamp":
        text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    elif dtype.startswith("struct"):
        text = F.to_json(c)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("")).alias(name)


def flat_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """All-text rows: NULL as '', numbers as text, times as ISO, structs as JSON."""
    types = dict(df.dtypes)
    return df.select(*[_flat(c, types[c]) for c in columns])


def lead_rows(leads: DataFrame) -> DataFrame:
    return flat_rows(leads, K.LEAD_EXPORT_COLUMNS)


def rejected_rows(rejected: DataFrame) -> DataFrame:
    return flat_rows(rejected, K.REJECTED_EXPORT_COLUMNS)


def error_rows(errors: DataFrame) -> DataFrame:
    return flat_rows(errors, K.ERROR_EXPORT_COLUMNS)


def export_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def export_review_log(log: DataFrame, path: str) -> None:
    """Append the review log as pipe-separated text, with a header file on first use."""
    spark = log.sparkSession
    store = TableStore(spark, path)
    fs, hadoop_path = store._fs(path)
    if not fs.exists(hadoop_path):
        header = spark.createDataFrame([("|".join(K.REVIEW_LOG_COLUMNS),)], "value STRING")
        header.coalesce(1).write.mode("append").text(path)
    review_lines(log).write.mode("append").text(path)


def export_dashboard(leads: DataFrame, path: str) -> None:
    """Dashboard dataset as JSON lines, ordered by company name."""
    dashboard_rows(leads).write.mode("overwrite").json(path)
