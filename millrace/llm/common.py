"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def ship(spark: SparkSession) -> None:
    """Let Python workers that share this file system import the package."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([ROOT, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where it is unset, a local master gets a new local folder; on a
    cluster, whose machines would each write to their own disk, that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR"))
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Paths of the tables that cut() has made, for each open temporary().
_open: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete what cut() makes inside at the end. Results have to be written inside, since they may read it."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: a lineage cut that survives lost executors.

    The files stay until the folder is cleared, or until the temporary() around the call ends.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    if _open:
        _open[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files behind a table made by cut() that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(spark, folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A key with over 1 of so many rows is frequent; so fewer than this are.
OFTEN = 200_000


def look_up(rows: DataFrame, table: DataFrame, key: str, n: int) -> DataFrame:
    """rows joined to a table that has one row for each of their keys and `count`, its number of rows among all n.

    Frequent keys are broadcast, so that none of them fills a task. Both sides are read twice, so they should be
    written tables. The table's other columns must not be among those of rows.
    """
    often = F.col("count") * OFTEN > n
    side = table.withColumnRenamed(key, "__key")
    met = rows.join(F.broadcast(side.filter(often)), F.col(key) == F.col("__key"), "left")
    rest = met.filter("__key is null").select(*rows.columns).join(side.filter(~often), F.col(key) == F.col("__key"))
    return met.filter("__key is not null").union(rest).drop("__key", "count")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once, also where body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def settled(df: DataFrame) -> DataFrame:
    """df with a column `settled` that is never below 0. A filter that uses it stays above df's expressions
    instead of being pushed into them, where they would be worked out a second time."""
    return df.withColumn("settled", F.monotonically_increasing_id())
