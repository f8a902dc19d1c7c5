"""The posting store on disk: versions of hash buckets, of which a batch rewrites only its own.

A store is a folder. data/{version}/bucket={b} holds a bucket as one batch left it, and manifest/{version} the list
of the buckets with the version that each was last written in. A batch reads the buckets of its keys, folds itself into
them, writes them as a new version, and last writes a manifest. Whoever reads takes the last manifest that is
complete, so a batch that dies half-way changes nothing, and its next attempt takes a number of its own.

Writers take turns: two batches at once would both start from the same manifest, and the later one would win.
Manifests have one row for each bucket, so what the driver reads of them is bounded by the number of buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.store import upsert
from millrace.sources.workspace import written

#: What a store adds to the columns of its postings.
STAMPS = "run_id long, created_at timestamp, updated_at timestamp"


def _folders(spark: SparkSession, path: str) -> list[str]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in files.listStatus(where) if files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))) if files.exists(where) else []


class Store:
    """Postings by `key` in a folder. columns: DDL of all columns but the stamps; `overwrite` and `keep` are those of
    upsert(), and what is in neither (but the key) stays as the first batch gave it.

    Rows without a key are no postings and are left out. Rows of a batch that share a key are folded in the order of
    its `order` column.
    """

    def __init__(self, spark: SparkSession, path: str, columns: str, key: str, overwrite: list[str], keep: list[str], buckets: int = 256) -> None:
        self.spark, self.path, self.key, self.overwrite, self.keep, self.buckets = spark, path.rstrip("/"), key, overwrite, keep, buckets
        self.columns = StructType.fromDDL(columns)
        self.schema = StructType([*self.columns, *StructType.fromDDL(STAMPS)])
        self.first = [c for c in self.columns.names if c != key and c not in overwrite and c not in keep]

    def manifest(self) -> dict[int, str]:
        """The version of each bucket, by the last complete manifest."""
        found = _folders(self.spark, f"{self.path}/manifest")
        return {r.bucket: r.version for r in self.spark.read.parquet(found[-1]).collect()} if found else {}

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The postings, or those of some buckets."""
        paths = [f"{self.path}/data/{v}/bucket={b}" for b, v in self.manifest().items() if buckets is None or b in buckets]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def apply(self, batch: DataFrame, order: str, run_id: int, at: str) -> None:
        """Fold a batch in. at: the time of the run."""
        now = F.lit(at).cast("timestamp")
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        rows = written(batch.filter(F.col(self.key).isNotNull()).select(*self.columns.names, F.col(order).alias("__order")), "batch")
        touched = [r.b for r in rows.select(bucket.alias("b")).distinct().collect()]  # at most `buckets`
        if not touched:
            return
        before = self.manifest()
        old = self.read(touched)
        # a first value is the first one of the batch, where the store has none
        firsts = rows.groupBy(F.col(self.key).alias("__key")).agg(*[F.min_by(c, "__order").alias(f"__{c}") for c in self.first], F.lit(True).alias("__hit"))
        new = upsert(old, rows, self.key, "__order", self.overwrite, self.keep, {c: F.lit(None) for c in [*self.first, "run_id", "created_at", "updated_at"]})
        new = new.join(firsts, F.col(self.key) == F.col("__key"), "left")
        fresh, hit = F.col("created_at").isNull(), F.col("__hit").isNotNull()
        stamped = new.withColumns(
            {c: F.when(fresh, F.col(f"__{c}")).otherwise(F.col(c)) for c in self.first}
            | {"run_id": F.when(hit, F.lit(run_id)).otherwise(F.col("run_id")), "updated_at": F.when(hit, now).otherwise(F.col("updated_at")), "created_at": F.coalesce("created_at", now)}
        )
        out = stamped.select(*[F.col(f.name).cast(f.dataType) for f in self.schema], bucket.alias("bucket"))
        version = f"{len(_folders(self.spark, f'{self.path}/manifest')):08d}-{uuid.uuid4().hex[:8]}"
        out.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/{version}")
        after = before | dict.fromkeys(touched, version)
        self.spark.createDataFrame(sorted(after.items()), "bucket int, version string").coalesce(1).write.parquet(f"{self.path}/manifest/{version}")
