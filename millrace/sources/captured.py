"""Readers of captured extracts and payloads."""

from __future__ import annotations

import csv

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from millrace.functions.scalars import group_or_null
from millrace.operators.details import repaired
from millrace.sources.workspace import written

NULLS = {"nullValue": "NA"}


@F.pandas_udf(ArrayType(StringType()))
def csv_records(text: pd.Series) -> pd.Series:
    """Records of a CSV text: lines, and lines that an open quote joins."""

    def split(t: str) -> list[str]:
        out: list[str] = []
        rest: list[str] = []
        for line in t.replace("\r\n", "\n").split("\n"):
            rest.append(line)
            if sum(x.count('"') for x in rest) % 2 == 0:
                out.append("\n".join(rest))
                rest = []
        return out + (["\n".join(rest)] if rest else [])

    return text.map(lambda t: [] if t is None else split(t))


def read_titled_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Exports with a title line, a header and a comma at each record's end; bad bytes are repaired.

    Files are small web exports, so each is one row until its records are split. The column that the last
    comma makes has no name and no values and isn't read.
    """
    files = spark.read.format("binaryFile").load(path)
    records = F.slice(csv_records(repaired(F.col("content"))), 3, 1 << 30)
    rows = files.select(F.explode(records).alias("line")).filter(F.length(F.trim("line")) > 0)
    return rows.select(F.from_csv(F.regexp_replace("line", ",$", ""), F.lit(schema), {"nullValue": "", "escape": '"'}).alias("r")).select("r.*")


EXPORT = r"^jobs_(.+)_([0-9]{8})[^.]*\.csv$"


@F.pandas_udf(ArrayType(StringType()))
def header_names(line: pd.Series) -> pd.Series:
    """Names of a CSV header."""
    return line.map(lambda t: next(csv.reader([t.lstrip("\ufeff")]), []))


#: Files whose headers are broadcast.
HEADERS = 20_000


def header_registry(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(file, names): the header of each file that has one, as a written table. A header is one line."""
    lines = spark.read.option("pathGlobFilter", pattern).text(folder).select(F.col("_metadata.file_path").alias("file"), "value", F.monotonically_increasing_id().alias("n"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.filter("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("header"))
    return written(first.select("file", header_names("header").alias("names")), "headers")


def read_by_name(spark: SparkSession, folder: str, schema: str, pattern: str = "*.csv") -> DataFrame:
    """CSV files with headers of their own: columns by name, missing ones null, further ones left out; and path.

    All files are one read, by position, whatever their headers; each row takes its values by the names of its file.
    Headers stay in a table, so neither they nor the paths pass the driver. Of two columns of a name the first counts;
    a value that is none of its type is null; rows beyond the header's columns lose what has no name; no files, or
    only empty ones, give no rows.
    """
    wanted = StructType.fromDDL(schema)
    headers = header_registry(spark, folder, pattern)
    size = headers.agg(F.count("*").alias("files"), F.max(F.size("names")).alias("width")).first()
    if not size.files:
        return spark.createDataFrame([], wanted).withColumn("path", F.lit(None).cast("string"))
    cells = [f"c{i}" for i in range(size.width)]
    rows = spark.read.schema(StructType([StructField(c, StringType()) for c in cells])).options(header=True, enforceSchema=True, multiLine=True, pathGlobFilter=pattern, **NULLS).csv(folder)
    rows = rows.select(F.col("_metadata.file_path").alias("path"), F.array(*cells).alias("cells"))
    met = rows.join(F.broadcast(headers) if size.files <= HEADERS else headers, F.col("path") == F.col("file"))

    def named(f: StructField) -> Column:
        return F.get("cells", (F.array_position("names", f.name) - 1).cast("int")).try_cast(f.dataType).alias(f.name)

    return met.select(*[named(f) for f in wanted], "path")


def read_exports(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """jobs_{slug}_{yyyymmdd}*.csv files with slug, day and path; the combined export is left out."""
    rows = read_by_name(spark, folder, schema, "jobs_*.csv")
    name = F.element_at(F.split("path", "/"), -1)
    rows = rows.withColumns({"slug": F.regexp_extract(name, EXPORT, 1), "day": F.regexp_extract(name, EXPORT, 2)})
    return rows.filter((F.col("day") != "") & (F.col("slug") != "all_companies"))


def write_export(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, **NULLS).csv(path)


def listing(body: Column, schema: str, items: str) -> Column:
    """The items of a JSON listing, one for each row."""
    return F.explode(F.from_json(body, F.lit(schema))[items])


def embedded_json(html: Column, script_id: str) -> Column:
    """The text of a page's embedded JSON script; null without one."""
    pattern = rf'(?s)<script id="{script_id}"[^>]*>(.*?)</script>'
    return F.when(html.rlike(rf'<script id="{script_id}"'), F.regexp_extract(html, pattern, 1))


def sitemap_urls(xml: Column, pattern: str) -> Column:
    """Locations of a sitemap that match."""
    return F.filter(F.xpath(xml, F.lit("//loc/text()")), lambda u: u.rlike(pattern))


def write_company_exports(df: DataFrame, folder: str, day: str, slug: Column, rows_per_file: int = 1_000_000) -> None:
    """Files below a folder jobs_{slug}_{day}.csv for each company; a company without rows has none.

    Rows are dealt by company, but a company too large for one task is dealt over several by their sizes, and has
    several files, none of over rows_per_file rows.
    """
    rows = df.withColumn("export", F.concat(F.lit("jobs_"), slug, F.lit(f"_{day}.csv")))
    rows.hint("rebalance", "export").write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("export").options(header=True, **NULLS).csv(folder)


def read_company_exports(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """What write_company_exports wrote, with slug, day and path (the export's folder)."""
    own = StructType([*StructType.fromDDL(schema), StructField("export", StringType())])
    rows = spark.read.schema(own).options(header=True, **NULLS).csv(folder)
    rows = rows.withColumns({"slug": F.regexp_extract("export", EXPORT, 1), "day": F.regexp_extract("export", EXPORT, 2)})
    return rows.filter((F.col("day") != "") & (F.col("slug") != "all_companies")).withColumnRenamed("export", "path")


def script_json(html: Column, name: str) -> Column:
    """The object that a page's script assigns to a name: up to the `};` before the script's end, else up to the
    first one before a new statement; null without it."""
    start = rf"(?s){name}\s*=\s*(\{{.*?\}});\s*"
    return F.coalesce(group_or_null(html, start + r"</script>"), group_or_null(html, start + r"(?:\n|var |window\.|$)"))


def oracle_listing(body: Column) -> Column:
    """Items of a listing with a place in the United States: id, title, location, posted and total.

    The first such place is the label: city and state, or whichever of them there is, or the country.
    """
    kind = "struct<items:array<struct<TotalJobsCount:bigint,requisitionList:array<struct<Id:string,Title:string,PostedDate:string,workLocation:array<struct<Country:string,TownOrCity:string,Region2:string>>>>>>>"
    page = F.get(F.from_json(body, F.lit(kind))["items"], 0)

    def one(x: Column) -> Column:
        place = F.get(F.filter(x["workLocation"], lambda w: w["Country"] == "US"), 0)
        parts = F.filter(F.array(place["TownOrCity"], place["Region2"]), lambda p: F.length(p) > 0)
        label = F.when(place.isNotNull(), F.when(F.size(parts) > 0, F.array_join(parts, ", ")).otherwise("United States"))
        return F.struct(x["Id"].alias("id"), x["Title"].alias("title"), label.alias("location"), x["PostedDate"].alias("posted"), page["TotalJobsCount"].alias("total"))

    return F.filter(F.transform(page["requisitionList"], one), lambda x: x["location"].isNotNull() & x["title"].isNotNull())


def results_html(body: Column) -> Column:
    """The HTML fragment of a listing that comes as JSON."""
    return F.get_json_object(body, "$.results")


def read_companies(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The active companies of a configuration file with a header."""
    return spark.read.schema(schema).options(header=True, **NULLS).csv(path).filter("active")


def leaf_options(body: Column) -> Column:
    """value and text of the options that are no groups, from a JSON list."""
    options = F.from_json(body, F.lit("array<struct<Value:string,Text:string,IsGroup:boolean>>"))
    return F.transform(F.filter(options, lambda o: ~o["IsGroup"]), lambda o: F.struct(o["Value"].alias("value"), o["Text"].alias("text")))


def sitemaps_of(xml: Column) -> Column:
    """Locations of the sitemaps that an index lists; none where the file is no index."""
    return F.xpath(xml, F.lit("//sitemap/loc/text()"))


def crawl_sitemaps(files: DataFrame, start: str, pattern: str) -> DataFrame:
    """Matching locations of a sitemap and of those that it lists as an index. files: url, xml, as captured."""
    first = files.filter(F.col("url") == start)
    listed = first.select(F.explode(sitemaps_of(F.col("xml"))).alias("of")).distinct()
    rows = first.select("xml").unionByName(files.join(listed, F.col("url") == F.col("of")).select("xml"))
    return rows.select(F.explode(sitemap_urls(F.col("xml"), pattern)).alias("job_url")).distinct()
