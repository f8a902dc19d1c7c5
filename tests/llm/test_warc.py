"""Archives are exact round trips."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm.warc import MARK, archived, read_records, write_archives

BIG = "<p>ä€ long</p>\r\n\r\n" * 90
ROWS = [
    (1, "http://a/?x=%0A", BIG),
    (2, "http://b/", BIG),
    (9, "http://a/", BIG),
    (3, None, None),
    (4, "", ""),
    (5, "http://c/\r\nX: 1%25", "short"),
    (6, "http://d/", "short"),
    (7, "u", f"{MARK}WARC-Type: response\r\n\r\n{MARK}" * 70 + "\r\n\r\n"),
    (8, "u", "\U0001f600" * 5000 + "\r\n"),
    (8, "u", "\U0001f600" * 5000 + "\r\n"),
    (None, "n", BIG),
]


def expected(rows):
    keep = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 1000 and i is not None:
            keep[h] = max(keep.get(h, i), i)
    out = Counter()
    for i, u, h in rows:
        b = (h or "").encode()
        k = keep.get(h) if len(b) >= 1000 else None
        first = k is None or i == k
        out[i, u, len(b), hashlib.sha1(b).hexdigest(), "response" if first else "revisit", None if first else k] += 1
    return out


@pytest.mark.parametrize(("chunk", "limit"), [(50, 10), (700, 0), (1 << 18, 10)])
def test_round_trip(spark, chunk, limit):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, copy string, n int").repartition(3)
    got = Counter(map(tuple, archived(df, chunk_chars=chunk, broadcast_groups=limit).collect()))
    assert got == expected(ROWS)


def test_archives_are_warc_files(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "w")
    write_archives(df, f"file://{path}", chunk_chars=500)
    data = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
    records, at = [], 0
    while at < len(data):  # a plain reader: header, then Content-Length bytes, then two line ends
        assert data[at:].startswith(b"WARC/1.1\r\n")
        end = data.index(b"\r\n\r\n", at)
        head = dict(x.split(b": ", 1) for x in data[at:end].split(b"\r\n")[1:])
        n = int(head[b"Content-Length"])
        records.append((head, data[end + 4 : end + 4 + n]))
        assert data[end + 4 + n : end + 8 + n] == b"\r\n\r\n"
        at = end + 8 + n
    table = read_records(spark, f"file://{path}")
    assert table.count() == len(records) and table.agg(F.max(F.length("part"))).first()[0] <= 500
    ids = {h[b"WARC-Record-ID"] for h, _ in records}
    assert all(h[b"WARC-Refers-To"] in ids for h, _ in records if h[b"WARC-Type"] == b"revisit")
    assert archived(df.limit(0)).count() == 0
