"""Education extracts: code standardisation, labels, tagged unions and trend aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalars import standardize_code


def snake_case(name: str) -> str:
    """`CIPGroupDesc` to `cip_group_desc`."""
    import re

    name = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name))
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def with_snake_case(df: DataFrame) -> DataFrame:
    return df.toDF(*map(snake_case, df.columns))


def select_rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of `names` under their new names; all others go, so a scan doesn't read them."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def cast_if_present(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Casts for those of the columns that there are."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in kinds.items() if c in df.columns})


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def only_codes(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Rows whose code is in the list. codes: one column of the same name."""
    return df.join(codes, column, "left_semi")


def enrich(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Rows with the labels of their code."""
    return df.join(codes, column)


def clean_extract(df: DataFrame, codes: DataFrame, sector: str, metric: str) -> DataFrame:
    """One raw extract with standard codes, tags and labels; rows without a listed code go."""
    rows = with_snake_case(df).withColumns({"cip_code": standardize_code(F.col("cip_desc")), "institution_sector": F.lit(sector), "metric_type": F.lit(metric), "academic_year": F.col("dim_year").try_cast("int")})
    rows = enrich(rows, codes, "cip_code")
    names = {"inst_type_list": "institution_type", "inst_list": "institution_name", "cip_desc": "cip_description", "major_type_desc": "major_type", "level_group_desc": "level_group", "semester_desc": "semester", "classification_desc": "classification"}
    return rows.drop("dim_year").withColumnsRenamed({k: v for k, v in names.items() if k in rows.columns})


def dashboard_filter(df: DataFrame, sector: str = "All", category: str = "All", low: int | None = None, high: int | None = None, sector_col: str = "sector", category_col: str = "category", year_col: str = "year") -> DataFrame:
    """Optional equality filters ("All" is none) and an inclusive year range."""
    if sector != "All":
        df = df.filter(F.col(sector_col) == sector)
    if category != "All":
        df = df.filter(F.col(category_col) == category)
    if low is not None and high is not None:
        df = df.filter(F.col(year_col).try_cast("double").between(low, high))
    return df


def in_years(day: str, low: int, high: int) -> Column:
    """Days of the years low to high, as bounds on the column itself, so that a scan can skip the rest."""
    return (F.col(day) >= F.make_date(F.lit(low), F.lit(1), F.lit(1))) & (F.col(day) < F.make_date(F.lit(high + 1), F.lit(1), F.lit(1)))


def total(column: Column) -> Column:
    """An exact sum that is 0 where all values are null."""
    return F.coalesce(F.sum(column.cast("decimal(18,2)")), F.lit(0)).cast("double")


def trend(df: DataFrame, keys: list[str], amount: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(total(F.col(amount)).alias(name))


def fill_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """field, filled and share of rows that are not null, in one pass."""
    counts = df.agg(F.count("*").alias("n"), *[F.count(c).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in columns]))
    return counts.select("n", pairs.alias("x")).select("x.field", "x.filled", F.try_divide("x.filled", F.col("n")).alias("share"))


def distinct_with_null(column: str) -> Column:
    """Distinct values, null counting as one."""
    return F.countDistinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
