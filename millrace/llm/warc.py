"""WARC archives as a chunked record table.

Each page becomes a record; a payload over `chunk_chars` becomes one record and numbered continuation
records (the format's own segmentation), so the table that is written and read has a row for each
record id and chunk number, and no row is larger than a chunk. Of equal payloads of `least_bytes` or
more, the page with the largest id is the response and the others are revisit records without a body.

Archives are written by the text sink with the record terminator as line separator, and read by the
text source with `WARC/1.1` and its line end as separator, so they can lie in any store that Spark
reads and large files are split. To make that exact, a payload that holds the separator is cut inside
it, which segmentation allows. The digest of a segmented payload is carried from chunk to chunk while
its rows stream by in order; no task holds a whole payload.

Edge cases: very long payloads are segments; null html is an empty payload and an empty payload a response; a null url has no header;
line ends in a url are escaped; of repeated ids in a group of equal payloads all rows with the largest
are responses, and rows with a null id revisit (or are responses where no id is known); an empty table
gives empty archives and an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, new_path, ship

MARK = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK_CHARS, SALTS = 1 << 18, 32


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record_id(page: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(">"))


def _escaped(url: Column) -> Column:
    out = url
    for a, b in (("%", "%25"), ("\r", "%0D"), ("\n", "%0A")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _unescaped(url: Column) -> Column:
    out = url
    for a, b in (("\n", "%0A"), ("\r", "%0D"), ("%", "%25")):
        out = F.replace(out, F.lit(b), F.lit(a))
    return out


def chunks_of(payload: Column, chunk_chars: int) -> Column:
    """Pieces of at most chunk_chars characters, none of which holds the separator."""
    safe = F.when(F.instr(payload, MARK) > 0, F.split(payload, r"(?<=WA)(?=RC/1\.1\r\n)")).otherwise(F.array(payload))
    return F.flatten(F.transform(safe, lambda p: F.transform(F.sequence(F.lit(1), F.greatest(F.length(p), F.lit(1)), F.lit(chunk_chars)), lambda i: F.substring(p, i, F.lit(chunk_chars)))))


def write_archives(pages: DataFrame, path: str, chunk_chars: int = CHUNK_CHARS, least_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z", broadcast_groups: int = 200_000) -> None:
    """Write the pages as WARC files under path. Groups of equal payloads are found on digests alone."""
    html = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(pages[id_col].cast("long").alias("page"), pages[url_col].alias("url"), html.alias("payload"), F.octet_length(html).cast("long").alias("n"), F.sha1(html).alias("digest"))
    groups = rows.filter(F.col("n") >= least_bytes).groupBy("digest", "n").agg(F.max("page").alias("keeper"), F.count("*").alias("copies")).filter("copies > 1")
    groups = cut(groups.select(F.col("digest").alias("of_digest"), F.col("n").alias("of_n"), "keeper"), "payload-groups")
    if groups.count() <= broadcast_groups:
        rows = rows.join(F.broadcast(groups), (F.col("digest") == F.col("of_digest")) & (F.col("n") == F.col("of_n")), "left")
    else:  # a digest may be that of very many pages: narrow rows meet the groups, payloads are joined by page
        salt = F.pmod(F.xxhash64("page"), F.lit(SALTS)).cast("int")
        salted = groups.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        narrow = rows.select("page", "digest", "n").filter(F.col("n") >= least_bytes).withColumn("salt", salt)
        members = narrow.join(salted, (F.col("digest") == F.col("of_digest")) & (F.col("n") == F.col("of_n")) & (F.col("salt") == F.col("of_salt")))
        members = members.select(F.col("page").alias("of_page"), "of_digest", "of_n", "keeper").distinct()
        rows = rows.join(members, F.col("page").eqNullSafe(F.col("of_page")) & (F.col("digest") == F.col("of_digest")) & (F.col("n") == F.col("of_n")), "left")
    rows = rows.withColumn("first", F.col("keeper").isNull() | F.col("page").eqNullSafe(F.col("keeper")))
    rows = rows.withColumn("chunks", F.when(F.col("first"), chunks_of(F.col("payload"), chunk_chars)).otherwise(F.array(F.lit("")))).withColumn("copy", F.uuid())
    rows = rows.select("page", "url", "n", "digest", "keeper", "first", F.size("chunks").alias("of"), "copy", F.posexplode("chunks").alias("k", "chunk"))
    segmented, head = F.col("of") > 1, F.col("k") == 0
    block = F.concat(F.when(head & F.col("first"), F.lit(HTTP_HEAD)).otherwise(F.lit("")), F.col("chunk"))
    odd_url = F.col("url").contains("\r") | F.col("url").contains("\n")
    own_id = _record_id(F.col("page"), F.col("digest"))
    record = F.concat(
        F.lit(MARK),
        _field("WARC-Type", F.when(~head, "continuation").when(F.col("first"), "response").otherwise("revisit")),
        _field("WARC-Record-ID", F.when(head, own_id).otherwise(F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.when(odd_url, _escaped(F.col("url"))).otherwise(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("WARC-Profile", F.when(~F.col("first"), F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(~F.col("first"), _record_id(F.col("keeper"), F.col("digest")))),
        _field("WARC-Segment-Number", F.when(segmented, (F.col("k") + 1).cast("string"))),
        _field("WARC-Segment-Origin-ID", F.when(~head, own_id)),
        _field("WARC-Segment-Total-Length", F.when(segmented & (F.col("k") == F.col("of") - 1), (F.col("n") + len(HTTP_HEAD)).cast("string"))),
        _field("Content-Type", F.when(head & F.col("first"), F.lit("application/http; msgtype=response"))),
        _field("X-Page-ID", F.col("page").cast("string")),
        _field("X-Refers-To-Page-ID", F.when(~F.col("first"), F.col("keeper").cast("string"))),
        _field("X-Payload-Length", F.col("n").cast("string")),
        _field("X-Copy", F.col("copy")),
        _field("X-Escaped", F.when(odd_url, F.lit("1"))),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The record table: a row for each record or segment, with its part of the payload.

    Meant for archives of write_archives; a record whose length differs from its header fails the job.
    """
    rows = spark.read.option("lineSep", MARK).text(path).filter("value <> ''")
    head = F.substring_index("value", END, 1)
    rows = rows.select(head.alias("head"), F.expr(f"substring(value, length(substring_index(value, '\\r\\n\\r\\n', 1)) + 5, length(value) - length(substring_index(value, '\\r\\n\\r\\n', 1)) - {4 + len(END)})").alias("block"))

    def field(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
        return F.when(F.col("head").rlike(rf"(?:^|\r\n){name}: "), found)

    kind = field("WARC-Type")
    right = F.octet_length("block") == field("Content-Length").cast("long")
    block = F.when(right, F.col("block")).otherwise(F.raise_error(F.lit("a record's block differs from its Content-Length")).cast("string"))
    part = F.when(kind == "response", F.substring(block, F.lit(len(HTTP_HEAD) + 1), F.length("block"))).otherwise(block)
    uri = field("WARC-Target-URI")
    return rows.select(
        kind.alias("type"),
        field("WARC-Record-ID").alias("record_id"),
        field("X-Page-ID").cast("long").alias("page_id"),
        F.when(field("X-Escaped").isNotNull(), _unescaped(uri)).otherwise(uri).alias("url"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        field("X-Payload-Length").cast("long").alias("payload_length"),
        field("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        field("X-Copy").alias("copy"),
        field("WARC-Segment-Number").cast("int").alias("segment"),
        part.alias("part"),
    )


def digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(copy, bytes, digest) of payloads whose segments come in order; one hash object is kept."""
    now, sha, size = None, hashlib.sha1(), 0
    for batch in batches:
        done: list[tuple[str, int, str]] = []
        for copy, part in zip(batch.column(0), batch.column(1), strict=True):
            if copy.as_py() != now:
                if now is not None:
                    done.append((now, size, sha.hexdigest()))
                now, sha, size = copy.as_py(), hashlib.sha1(), 0
            data = part.as_buffer()
            sha.update(data)
            size += data.size
        yield _digests(done)
    if now is not None:
        yield _digests([(now, size, sha.hexdigest())])


def _digests(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())], ["of_copy", "bytes", "sha1"])


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type and refers_to, from the payloads read back."""
    ship(spark)
    records = read_records(spark, path)
    segments = records.filter("segment is not null").select("copy", "segment", "part").repartition("copy").sortWithinPartitions("copy", "segment")
    long = segments.select("copy", "part").mapInArrow(digest_batches, "of_copy string, bytes long, sha1 string")
    heads = records.filter("type <> 'continuation'").select("page_id", "url", "type", "refers_to", "copy", F.when(F.col("type") == "revisit", F.col("payload_length")).otherwise(F.octet_length("part").cast("long")).alias("n"), F.when(F.col("type") == "revisit", F.col("digest")).otherwise(F.sha1("part")).alias("d"), "segment")
    whole = heads.filter("segment is null").select("page_id", "url", F.col("n").alias("payload_bytes"), F.col("d").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
    cut_up = heads.filter("segment is not null").join(long, F.col("copy") == F.col("of_copy")).select("page_id", "url", F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")
    return whole.union(cut_up)


def archived(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the archives and read them back."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_archives(pages, path, **options)
    return read_pages(spark, path)
