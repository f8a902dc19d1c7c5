"""Pulls in batches: a bounded number of tries for each batch, and a report of those that never came.

Members are dealt into batches by their order, each batch is pulled by one call, and a batch that fails is tried
again. What fails for good is a row of the report and never ends the job; the rows of all other batches stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from millrace.operators.sequences import with_ordinal
from millrace.sources.workspace import written

#: fetch(members, attempt): the rows of a batch as tuples or dicts; any exception is a failed try. attempt is from 1.
Fetch = Callable[[list[dict[str, Any]], int], Iterable[Any]]


def in_batches(members: DataFrame, order: list[str], size: int) -> DataFrame:
    """(batch, members): batches of `size` members in a total order, numbered from 1; the last may be smaller.

    A batch holds at most `size` members, so gathering one is bounded.
    """
    rows = with_ordinal(members, order, "ordinal").withColumn("batch", F.expr(f"ordinal div {size} + 1"))
    kept = F.sort_array(F.collect_list(F.struct("ordinal", F.struct(*members.columns).alias("member"))))
    return rows.groupBy("batch").agg(F.transform(kept, lambda x: x["member"]).alias("members"))


def pull(batches: DataFrame, fetch: Fetch, schema: str, attempts: int = 3) -> DataFrame:
    """(batch, attempts, error, n_rows, then schema): the rows of each batch that came, or one row with the last error.

    A row without an error and with n_rows 0 is a batch that came empty. The rows of a try count only when it ends,
    so a try that breaks off leaves none behind; a task keeps one batch at a time. The result is written once, so
    that rows and report come from the same tries; a task that is run again pulls its batches again.
    """
    own = StructType.fromDDL(schema)
    head = [StructField("batch", LongType()), StructField("attempts", IntegerType()), StructField("error", StringType()), StructField("n_rows", IntegerType())]
    whole = StructType([*head, *own])
    names = own.names

    def tried(members: list[dict[str, Any]]) -> tuple[int, str | None, list[tuple]]:
        error = None
        for attempt in range(1, attempts + 1):
            try:
                return attempt, None, [tuple(r[n] for n in names) if isinstance(r, dict) else tuple(r) for r in fetch(members, attempt)]
            except Exception as e:  # noqa: BLE001  what a connector raises is a failed try
                error = f"{type(e).__name__}: {e}"
        return attempts, error, []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for batch, members in zip(frame["batch"], frame["members"], strict=True):
                tries, error, rows = tried([m if isinstance(m, dict) else m.asDict(True) for m in members])
                lines = [(batch, tries, error, len(rows), *r) for r in rows or [(None,) * len(names)]]
                yield pd.DataFrame(lines, columns=whole.names, dtype=object)

    return written(batches.mapInPandas(run, whole), "pulled")


def pulled_rows(pulled: DataFrame) -> DataFrame:
    """The rows of all batches that came, with their batch."""
    return pulled.filter("n_rows > 0").drop("attempts", "error", "n_rows")


def report(pulled: DataFrame) -> DataFrame:
    """(batch, attempts, error, n_rows), a row for each batch."""
    return pulled.groupBy("batch").agg(F.first("attempts").alias("attempts"), F.first("error").alias("error"), F.first("n_rows").alias("n_rows"))
