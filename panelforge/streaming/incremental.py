"""Incremental Stage 1 with Structured Streaming.

New raw files of a table arrive over time (a new year, a late delivery). Instead of re-running a
whole year, a stream of file names picks up exactly the files not yet processed (the checkpoint
records which). Each micro-batch, a bounded number of files, is read as a batch run reads them: its
files are sorted by their footers' schemas, each schema is scanned once and cast to the columns and
types of the stream's first file, and the same projection, lineage and reshape as in
``select_year`` follow. The first file's schema is kept beside the checkpoint, so that it holds for
all later runs. ``availableNow`` processes everything pending and stops, so this runs as a scheduled job.

A micro-batch is written aside and its files are switched into the dataset by a journal, under names
that tell the delivery: a batch that is processed again after a crash replaces its own files.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelforge.operators.project import select_columns
from panelforge.operators.reshape import explode_periods, unpivot_monthly
from panelforge.session import checkpoint_root
from panelforge.sinks.switch import aside, recover, switch
from panelforge.sources import hadoop_fs
from panelforge.sources.footers import SchemaGroup, data_files, schema_groups
from panelforge.sources.parquet import check_against_first, conform_to_first, glob_parquet
from panelforge.specs import SelectSpec

#: Columns of Spark's source of whole files; only the path is asked for, so no content is read.
FILE_NAMES = "path string, modificationTime timestamp, length long, content binary"


def select_files(spark: SparkSession, spec: SelectSpec, files: list[str], first: T.StructType) -> DataFrame:
    """The Stage 1 table of ``files``, each cast to the columns of ``first``; a file that lacks one of
    them is an error, as in a batch run."""
    groups = schema_groups(spark, sorted(files))
    check_against_first([SchemaGroup(first), *groups])
    working = select_columns(conform_to_first(spark, groups, first, spec.lineage_col), spec.columns, spec.lineage_col)
    if spec.explode_arrays:
        return explode_periods(working, spec.period_col, spec.n_periods)
    if spec.monthly_columns:
        return unpivot_monthly(working, spec.period_col, spec.n_periods, spec.monthly_pattern, spec.lineage_col)
    return working


def first_delivery(spark: SparkSession, source_glob: str, checkpoint: str) -> tuple[str, T.StructType]:
    """(name, schema) of the stream: the schema of the first file present at its first run."""
    note = f"{checkpoint.rstrip('/')}/first_file.json"
    if not hadoop_fs.exists(spark, note):
        schema = spark.read.parquet(glob_parquet(spark, source_glob)[0]).schema
        hadoop_fs.write_text(spark, f"{note}.tmp", json.dumps({"stream": uuid.uuid4().hex[:8], "schema": schema.jsonValue()}))
        hadoop_fs.rename(spark, f"{note}.tmp", note)
    known = json.loads(hadoop_fs.read_text(spark, note))
    return known["stream"], T.StructType.fromJson(known["schema"])


def write_delivery(df: DataFrame, output_dir: str, delivery: str, partition_col: str | None) -> None:
    """Files of one micro-batch into the dataset, named after it; those of an earlier try go."""
    spark, out = df.sparkSession, output_dir.rstrip("/")
    recover(spark, out)
    root = aside(out)
    new = f"{root}/new"
    writer = df.write.partitionBy(partition_col) if partition_col and partition_col in df.columns else df.write
    writer.parquet(new)
    inside = lambda f: f.partition("/new/")[2]
    moves = []
    for f in data_files(spark, new):
        folder, _, name = inside(f).rpartition("/")
        moves.append((f, "/".join(x for x in (out, folder, f"{delivery}-{name}") if x)))
    earlier = [p for depth in ("", "/*") for p, _ in hadoop_fs.glob(spark, f"{out}{depth}/{delivery}-*")]
    switch(spark, out, root, moves, earlier)


def run_incremental(
    spark: SparkSession,
    spec: SelectSpec,
    source_glob: str,
    output_dir: str,
    partition_col: str | None = "year",
    checkpoint_location: str | None = None,
    max_files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process every raw file not yet seen and stop; returns the finished query.

    The checkpoint defaults to ``<spark.checkpoint.dir>/incremental/<table>``.
    """
    checkpoint = checkpoint_location or f"{checkpoint_root(spark)}/incremental/{spec.name}"
    stream, first = first_delivery(spark, source_glob, checkpoint)
    names = spark.readStream.format("binaryFile").schema(FILE_NAMES).option("maxFilesPerTrigger", max_files_per_batch).load(source_glob)

    def process(batch: DataFrame, number: int) -> None:
        files = [r.path for r in batch.select("path").collect()]  # at most max_files_per_batch
        if files:
            write_delivery(select_files(spark, spec, files, first), output_dir, f"{stream}-{number:06d}", partition_col)

    query = names.select("path").writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
