"""Which files of a table count: a small commit for each micro-batch, which readers go by.

A writer stages its files out of sight, moves them to their place and then commits their names in one rename. Until then
no reader counts them; a repeated micro-batch commits anew, and its last commit alone counts. So a reader sees every
batch either whole or not at all, before, during and after a failure or a retry.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_commits"
STAGING = "_staging"
FOLD_EVERY = 100  # micro-batches, whose commits then become one file
SCHEMA = "batch_id long, committed_at long, trades long, flagged long, files array<string>"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, over the one that is there."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    over = spark._sc._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    old, new = hadoop.Path(source), hadoop.Path(target)
    hadoop.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration()).rename(old, new, over)


def staging_folder(path: str, batch_id: int) -> str:
    """A folder of its own for one attempt at a micro-batch."""
    return f"{path}/{STAGING}/{batch_id}-{uuid.uuid4().hex}"


def move_staged(spark: SparkSession, staged: str, path: str, batch_id: int) -> list[str]:
    """Move the data files of an attempt below ``path``, in the folders of its batch; their names are unique."""
    fs, folder = file_system(spark, staged)
    base = fs.makeQualified(folder).toString()
    names, found = [], fs.listFiles(folder, True)
    while found.hasNext():
        file = found.next().getPath()
        if file.getName().startswith(("_", ".")):
            continue
        inside = file.getParent().toString()[len(base):].strip("/")
        target = file_system(spark, "/".join(p for p in (path, inside, f"batch_id={batch_id}") if p))[1]
        fs.mkdirs(target)
        if not fs.rename(file, spark._jvm.org.apache.hadoop.fs.Path(target, file.getName())):
            raise OSError(f"{file.toString()} could not be moved")
        names.append(file.getName())
    fs.delete(folder, True)
    return names


def commit(spark: SparkSession, path: str, batch_id: int, files: list[str], trades: int, flagged: int) -> None:
    """Make the named files, and no others, those of a micro-batch. Replaces an earlier commit of it at once."""
    entry = {"batch_id": batch_id, "committed_at": time.time_ns(), "trades": trades, "flagged": flagged, "files": files}
    fs, written = file_system(spark, f"{path}/{FOLDER}/.{uuid.uuid4().hex}")
    out = fs.create(written, True)
    try:
        out.write(bytearray(json.dumps(entry).encode() + b"\n"))
    finally:
        out.close()
    _replace(spark, written.toString(), f"{path}/{FOLDER}/batch-{batch_id:019d}.json")
    if batch_id % FOLD_EVERY == FOLD_EVERY - 1:
        fold(spark, path)


def fold(spark: SparkSession, path: str) -> None:
    """Bring all commits into one file. A commit that is in two files for a while counts once."""
    fs, folder = file_system(spark, f"{path}/{FOLDER}")
    old = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
    made = f"{path}/{FOLDER}/.fold-{uuid.uuid4().hex}"
    commits(spark, path).coalesce(1).write.json(made)
    part = next(s.getPath() for s in fs.listStatus(file_system(spark, made)[1]) if s.getPath().getName().startswith("part-"))
    _replace(spark, part.toString(), f"{path}/{FOLDER}/folded-{uuid.uuid4().hex}.json")
    fs.delete(file_system(spark, made)[1], True)
    for file in old:
        fs.delete(file, False)


def has_commits(spark: SparkSession, path: str) -> bool:
    fs, folder = file_system(spark, f"{path}/{FOLDER}")
    return fs.exists(folder)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The last commit of every micro-batch: (batch_id, committed_at, trades, flagged, files)."""
    found = spark.read.schema(SCHEMA).option("pathGlobFilter", "*.json").json(f"{path}/{FOLDER}")
    last = found.groupBy("batch_id").agg(F.max_by(F.struct("committed_at", "trades", "flagged", "files"), "committed_at").alias("last"))
    return last.select("batch_id", "last.*")


def only_committed(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """The rows of ``df``, read from ``path``, in files that are committed; all of them in a table that keeps no commits."""
    if not has_commits(spark, path):
        return df
    names = commits(spark, path).select(F.explode("files").alias("committed_file"))
    return df.join(names, F.col("_metadata.file_name") == F.col("committed_file"), "left_semi")


def remove_uncommitted(spark: SparkSession, path: str, batch_id: int, files: list[str]) -> None:
    """Remove what other attempts at a micro-batch have left in its folders; ``files`` are the committed ones."""
    fs, pattern = file_system(spark, f"{path}/*/batch_id={batch_id}/part-*")
    for found in fs.globStatus(pattern) or []:
        if found.getPath().getName() not in files:
            fs.delete(found.getPath(), False)
