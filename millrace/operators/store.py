"""The posting store: keyed upserts, first inserts, run records and latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold_batch(batch: DataFrame, key: str, order: str, overwrite: list[str], keep: list[str]) -> DataFrame:
    """A batch as one row for each key, as if applied row by row in order.

    The last row gives the `overwrite` fields, null or not; the last value that is not null gives the
    `keep` fields. batch_rows counts the rows of the key.
    """
    last = [F.max_by(c, order).alias(c) for c in overwrite]
    known = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in keep]
    return batch.groupBy(key).agg(*last, *known, F.count("*").alias("batch_rows"))


def upsert(target: DataFrame, batch: DataFrame, key: str, order: str, overwrite: list[str], keep: list[str], untouched: dict[str, Column]) -> DataFrame:
    """The target after the batch. `untouched` columns keep the target's value and give it for new rows."""
    new = fold_batch(batch, key, order, overwrite, keep).select(F.col(key).alias("new_key"), *[F.col(c).alias(f"new_{c}") for c in [*overwrite, *keep]])
    both = target.join(new, F.col(key) == F.col("new_key"), "full_outer")
    hit, old = F.col("new_key").isNotNull(), F.col(key).isNotNull()
    return both.select(
        F.coalesce(key, "new_key").alias(key),
        *[F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in overwrite],
        *[F.coalesce(f"new_{c}", c).alias(c) for c in keep],
        *[F.when(old, F.col(c)).otherwise(v).alias(c) for c, v in untouched.items()],
    )


def upsert_counts(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """new: keys of the batch that the target lacks; updated: all other rows of the batch."""
    keys = batch.groupBy(key).agg(F.count("*").alias("n"))
    known = target.select(F.col(key).alias("known")).distinct()
    marked = keys.join(known, F.col(key) == F.col("known"), "left")
    new = F.count_if(F.col("known").isNull())
    return marked.agg(new.alias("new"), (F.coalesce(F.sum("n"), F.lit(0)) - new).alias("updated"))


def insert_absent(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key the target lacks."""
    return rows.join(target.select(key).distinct(), key, "left_anti")


def add_companies(target: DataFrame, rows: DataFrame, key: str, id_col: str) -> DataFrame:
    """The target with the rows whose key it lacks, numbered on from its greatest id in the order of their keys.

    Of rows with the same key one is added, the least. New companies are few, so they are numbered in one task.
    """
    others = [c for c in rows.columns if c != key]
    new = insert_absent(target, rows, key).groupBy(key).agg(F.min(F.struct(*others)).alias("least") if others else F.count("*"))
    last = F.coalesce(F.lit(target.agg(F.max(id_col)).first()[0]).cast("long"), F.lit(0).cast("long"))
    numbered = new.select(key, *[F.col("least")[c].alias(c) for c in others], (last + F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(key))).cast(target.schema[id_col].dataType).alias(id_col))
    return target.unionByName(numbered, allowMissingColumns=True)


def start_run(runs: DataFrame, companies: DataFrame, name: str, run_id: int, started: str) -> DataFrame:
    """The runs with a running one of a company, looked up by its name; an unknown company adds none."""
    new = companies.filter(F.col("company_name") == name).limit(1).select(F.lit(run_id).cast(runs.schema["run_id"].dataType).alias("run_id"), "company_id", F.lit(started).cast("timestamp").alias("started_at"), F.lit("running").alias("status"))
    return runs.unionByName(new, allowMissingColumns=True)


def evolve(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the columns that are missing, as nulls of their type."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by a total order."""
    return df.withColumn("first_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("first_rank = 1").drop("first_rank")


def least_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key, all orders ascending with nulls first. Rows are combined before the shuffle, so a
    hot key sends one row for each task."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)]))
    return df.groupBy(*keys).agg(best.alias("best")).select(*keys, *[F.col("best")[c].alias(c) for c in rest]).select(*df.columns)


def finish_run(runs: DataFrame, run_id: int, found: int, new: int, updated: int, status: str = "completed", error: str | None = None, completed: str | None = None) -> DataFrame:
    """Close a running run; one that has failed stays failed and keeps its error. completed: the time, for the duration."""
    open_run = (F.col("run_id") == run_id) & (F.col("status") == "running")
    values = {"jobs_found": F.lit(found), "jobs_new": F.lit(new), "jobs_updated": F.lit(updated), "status": F.lit(status), "error_message": F.lit(error).cast("string")}
    if completed:
        end = F.lit(completed).cast("timestamp")
        seconds = (F.unix_micros(end) - F.unix_micros("started_at")).cast("double") / 1_000_000
        runs = evolve(runs, {"completed_at": "timestamp", "duration_seconds": "double"})
        values |= {"completed_at": end, "duration_seconds": seconds}
    return runs.withColumns({c: F.when(open_run, v).otherwise(F.col(c)) for c, v in values.items()})
