"""Footers of many Parquet files, read by tasks.

``schema_groups`` sorts files by their schema: one job reads all footers where the executors are and
returns, besides counts, only the paths whose schema differs from the first file's. Spark then
resolves one file of each distinct schema, so the driver opens a footer a schema, not a file.
``footer_counts`` adds up the rows and NULLs that the writers noted for each row group.

Tasks open files with Arrow's file systems (local, HDFS and ViewFs where libhdfs is installed, S3,
GCS, ABFS). Paths of a store that only Spark's JVM reaches come back unread; their schemas are then
read from the driver, a few at a time, and their counts are unknown.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.sources import hadoop_fs

#: Footers that one task reads.
FILES_EACH = 250

FOOTER = "path string, signature string, n_rows long, columns array<struct<name:string,nulls:bigint>>"


@dataclass
class SchemaGroup:
    """Files of one schema, in the order given; ``base`` is their dataset's folder where they lie in
    ``column=value`` subfolders."""

    schema: T.StructType
    files: list[str] = field(default_factory=list)
    base: str | None = None


def _reader() -> Callable[[str], tuple]:
    """A function of a path that gives its ``FOOTER`` row; ``signature`` is null if it can't be opened.

    Self-contained, so that tasks need no more than pyarrow. ``columns`` has flat columns only (the
    statistics of nested ones count their leaves); ``nulls`` is null where a row group lacks them.
    """

    def read(path: str) -> tuple:
        import hashlib
        from urllib.parse import quote, urlsplit

        import pyarrow.parquet as pq
        from pyarrow import fs

        try:
            scheme = urlsplit(path).scheme
            if scheme in ("", "file"):
                store, inner = fs.LocalFileSystem(), path.removeprefix("file:")
                inner = "/" + inner.lstrip("/") if scheme else inner
            else:
                store, inner = fs.FileSystem.from_uri(quote(path, safe=":/@%=+,"))
            with store.open_input_file(inner) as source:
                meta = pq.read_metadata(source)
        except Exception:  # reached by the JVM only, or not a Parquet file: the driver finds out
            return path, None, None, []
        stored = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
        signature = hashlib.sha256(str(meta.schema).partition("\n")[2].encode() + b"\0" + stored).hexdigest()
        columns = []
        for i in range(meta.num_columns):
            leaf = meta.schema.column(i)
            if leaf.path != leaf.name or leaf.max_repetition_level or leaf.max_definition_level > 1:
                continue
            nulls = 0
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(i).statistics
                known = leaf.max_definition_level == 0 or stats is not None and stats.has_null_count
                nulls = None if nulls is None or not known else nulls + (stats.null_count if leaf.max_definition_level else 0)
            columns.append((leaf.name, nulls))
        return path, signature, meta.num_rows, columns

    return read


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Sorted data files that ``path`` (a file, a dataset's folder or a glob pattern) leads to, empty if
    none. Folders are listed by Spark, in parallel where they hold many; no file is read."""
    found = []
    for own, is_folder in hadoop_fs.glob(spark, path):
        if is_folder:
            listed = spark.read.schema("none int").option("recursiveFileLookup", "true").parquet(own).inputFiles()
            found += [unquote(f).replace("file:///", "file:/", 1) for f in listed]
        else:
            found.append(own)
    return sorted(found)


def _inside(path: str) -> str:
    """``path`` without scheme and authority."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "", path).rstrip("/")


def partitioned_base(path: str, files: list[str]) -> str | None:
    """``path`` if some of ``files`` lie in ``column=value`` folders below it."""
    return path if any("=" in _inside(f).removeprefix(_inside(path)).rpartition("/")[0] for f in files) else None


def footer_rows(spark: SparkSession, files: list[str]) -> DataFrame:
    """A row for each file, see ``FOOTER``, read by one task for each ``FILES_EACH`` files."""
    one = _reader()

    def read(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.struct([("name", pa.string()), ("nulls", pa.int64())]))]
        for batch in batches:
            rows = list(zip(*map(one, batch.column(0).to_pylist()))) or [[]] * 4
            rows[3] = [[{"name": n, "nulls": k} for n, k in columns] for columns in rows[3]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, kinds)], ["path", "signature", "n_rows", "columns"])

    import pyarrow as pa

    paths = spark.createDataFrame(pa.table({"path": pa.array(files, pa.string())}))
    return paths.repartition(max(1, math.ceil(len(files) / FILES_EACH))).mapInArrow(read, FOOTER)


def _read_by_driver(spark: SparkSession, files: list[str], threads: int = 16) -> list[str]:
    """The schemas' text of files that tasks can't reach, through Hadoop's file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def footer(path: str) -> str:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(hadoop_fs.locate(spark, path)[1], conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            meta = reader.getFileMetaData()
            return f"{meta.getSchema().toString()}\n{meta.getKeyValueMetaData().get('org.apache.spark.sql.parquet.row.metadata')}"
        finally:
            reader.close()

    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(files)))) as pool:
        return list(pool.map(footer, files))


def schema_groups(spark: SparkSession, files: list[str], base: str | None = None) -> list[SchemaGroup]:
    """``files`` by their schema, the groups in the order of their first files.

    One job reads the footers; the driver gets the paths whose schema isn't the first file's.
    """
    own = _reader()(files[0])[1]  # not a Spark read: only to know the signature
    others: dict[str, str] = {}
    if len(files) > 1:
        odd = F.col("signature").isNull() | (F.col("signature") != F.lit(own)) if own else F.lit(True)
        others = {r.path: r.signature for r in footer_rows(spark, files).where(odd).select("path", "signature").collect()}
    elif own is None:
        others = {files[0]: None}
    unread = [f for f in files if f in others and others[f] is None]
    if unread:
        others.update(zip(unread, _read_by_driver(spark, unread)))
    groups: dict[str, SchemaGroup] = {}
    known: dict[str | None, str] = {}  # signature -> schema; several signatures may be one schema to Spark
    for f in files:
        signature = others.get(f, own)
        if signature not in known:
            schema = spark.read.parquet(f).schema
            known[signature] = schema.json()
            groups.setdefault(known[signature], SchemaGroup(schema, [], base))
        groups[known[signature]].files.append(f)
    return list(groups.values())


def footer_counts(spark: SparkSession, files: list[str]) -> DataFrame:
    """``column_name, n_files, n_rows, null_count`` of the files' flat columns from their footers: rows of
    the files that hold the column, and its NULLs in them, null where a row group doesn't tell. The
    row without a name has the number of files and rows of all (null if one can't be read)."""
    rows = footer_rows(spark, files)
    every = F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("nulls")))
    rows = rows.select("path", "n_rows", F.explode(F.concat(every, "columns")).alias("c"))
    whole = lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))
    return rows.groupBy(F.col("c.name").alias("column_name")).agg(F.count(F.lit(1)).alias("n_files"), whole(F.col("n_rows")).alias("n_rows"), whole(F.col("c.nulls")).alias("null_count"))
