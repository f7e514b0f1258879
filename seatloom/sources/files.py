"""Result files: CSV with a header, in a table's own order however many files and tasks that takes.

A table is sorted by ranges, so that its numbered part files, one after another, are in order; a small one is one file. Read
back, a row's place is its file, its block in the file and its place in the block."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value in result files.
MISSING = ["", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "n/a", "<NA>", "#N/A", "-NaN", "-nan"]


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's checkpoint folder. Only in local mode, where both are
    one process, an unset one is replaced by a temporary folder; on a cluster it must be set."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="seatloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_csv(df: DataFrame, path: str) -> None:
    """Part files under path; empty tables still get their header."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def part_files(spark: SparkSession, folder: str) -> list:
    """The paths of the part files of one write, in order."""
    at = _path(spark, folder)
    found = [s.getPath() for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)]
    return sorted((p for p in found if p.getName().startswith("part-")), key=lambda p: p.getName())


def put(spark: SparkSession, source, path: str) -> None:
    """Move what is at source to path, in place of what is there."""
    target = _path(spark, path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(target, True)
    if target.getParent() is not None:
        fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"{source} can't be moved to {path}")


def remove(spark: SparkSession, path: str) -> None:
    at = _path(spark, path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def put_text(spark: SparkSession, text: str, path: str) -> None:
    target = _path(spark, path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_ordered_csv(df: DataFrame, path: str, order: list[str] | tuple[str, ...] = (), metrics: dict[str, Column] | None = None) -> dict:
    """df in the order of those columns and without them (or as it is sorted already) under path: one file if it is small
    enough for one task, else a folder of numbered part files, each with the header. Gives how many rows were written and
    what metrics come to over them, taken in passing."""
    spark, told = df.sparkSession, Observation()
    parts = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    # on top of the sort: what stands below is run twice, once for a sample of the ranges
    ordered = df.orderBy(*order) if order else df
    seen = ordered.observe(told, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()])
    write_csv(seen.drop(*order), parts)
    files = part_files(spark, parts)
    put(spark, files[0] if len(files) == 1 else _path(spark, parts), path)
    if len(files) == 1:
        remove(spark, parts)
    return told.get


def row_position() -> Column:
    """Where a row of a file scan stands: file, block and place in the block. Ordered like the rows of numbered part files."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, row_pos: bool = False) -> DataFrame:
    """Columns by place and type; the texts of MISSING are null. row_pos: with a column of that name, each row's place."""
    raw = spark.read.csv(path, header=True, escape='"', schema=T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    return _typed(raw.withColumn("row_pos", row_position()), schema, "row_pos") if row_pos else _typed(raw, schema)


def _typed(raw: DataFrame, schema: T.StructType, *carried: str) -> DataFrame:
    cell = lambda n: F.when(~F.col(n).isin(MISSING), F.col(n))
    return raw.select(*[cell("`" + f.name.replace("`", "``") + "`").try_cast(f.dataType).alias(f.name) for f in schema.fields], *carried)


def read_seat_results(spark: SparkSession, path: str) -> DataFrame:
    """A seat table as written, a file or a folder of them: names as text, ratios as doubles, other columns as they come;
    row_pos is a row's place, so that the table's order is known though many tasks read it."""
    raw = spark.read.csv(path, header=True, escape='"')
    kind = lambda n: T.DoubleType() if n.endswith("_ratio") else T.LongType() if n.endswith("_votes") else T.StringType()
    schema = T.StructType([T.StructField(n, kind(n)) for n in raw.columns])
    return _typed(raw.withColumn("row_pos", row_position()), schema, "row_pos")
