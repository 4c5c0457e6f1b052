"""Archives against the bytes they were made of."""

import base64
import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from casebook.llm import warc

SAME = "<p>the same page</p>"
PAGES = [
    (1, "http://a.example/1", SAME),
    (2, "http://a.example/2", SAME),
    (2, "http://a.example/2", SAME),
    (None, "http://a.example/none", SAME),
    (3, None, None),
    (4, "", ""),
    (5, "http://a.example/a b\r\nX: y", "one\r\n\r\nWARC/1.1\r\n\r\n\r\n\r\n"),
    (6, "http://bücher.example/ü%20\U0001f600", "\U0001f600 é \x00 end\r\n"),
    (7, "http://a.example/long", "x" * 300_000),
    *[(k, f"http://b.example/{k}", f"page {k % 23}") for k in range(10, 150)],
]


def expected(rows, least=0):
    """One (page_id, bytes, digest, type, refers_to) per row; which of repeated rows is the response doesn't show."""
    out, best = [], {}
    for i, (page, _, html) in enumerate(rows):
        k = (-1 if page is None else page, i)
        best[html or ""] = max(best.get(html or "", k), k)
    for i, (page, _, html) in enumerate(rows):
        x = (html or "").encode()
        first = best[html or ""]
        later = len(x) >= least and first[1] != i
        out.append((page, len(x), base64.b32encode(hashlib.sha1(x).digest()).decode(), "revisit" if later else "response", first[0] if later else None))
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("segment", "uid", "kind", "text", "payload", "offset"):
        df = df.withColumn(c, F.lit("own"))
    return df


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("least", [0, 8])
def test_digest_matches_brute_force(spark, least):
    got = warc.digest(spark, frame(spark, PAGES).repartition(5), least=least)
    assert ordered(got.collect()) == ordered(expected(PAGES, least))


def files_of(archive):
    return glob.glob(archive.files.removeprefix("file:") + "/*.warc.gz")


def test_archive_bytes_and_selected_reads(spark):
    archive = warc.write_archive(frame(spark, PAGES).repartition(2), file_bytes=2_000)
    assert warc.broken(spark, archive).count() == 0 == warc.orphans(spark, archive).count()
    index = spark.read.parquet(archive.index)
    assert index.select("file").distinct().count() > 4
    some = index.where("page_id % 3 = 0")
    got = {r.page_id: r for r in warc.read_records(spark, archive, some, gap=0, read_bytes=1024).collect()}
    texts = {p: h or "" for p, _, h in PAGES if p is not None and p % 3 == 0}
    assert set(got) == set(texts)
    for p, r in got.items():
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload).decode() == texts[p]
    urls = {r.page_id: r.url for r in warc.read_records(spark, archive).collect()}
    assert urls[3] == urls[4] == "about:blank" and urls[7] == "http://a.example/long"
    assert urls[5] == "http://a.example/a%20b%0D%0AX:%20y" and urls[6] == "http://b%C3%BCcher.example/%C3%BC%20%F0%9F%98%80"
    # the archive can be walked without the index
    for f in files_of(archive):
        data, n = gzip.open(f).read(), 0
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            size = int(dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])["Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            data, n = rest[size + 4 :], n + 1
        assert n == index.where(F.col("file") == f.split("/")[-1]).count() + 1


def test_reads_are_merged(spark):
    rows = [("f", 500, 100), ("f", 600, 100), ("f", 705, 10), ("f", 900, 50), ("f", 2100, 900), ("g", 0, 10)]
    df = spark.createDataFrame(rows, "file string, offset long, length long")
    got = warc.plan_reads(df, gap=5, read_bytes=2000).select("file", "start", "stop", F.size("records")).collect()
    assert ordered(got) == [("f", 2100, 3000, 1), ("f", 500, 715, 3), ("f", 900, 950, 1), ("g", 0, 10, 1)]


def test_damage_is_raised(spark):
    member = lambda raw: gzip.compress(raw)
    raw = warc.page_record("r", 1, "u", b"some payload", warc.sha1_label(b"some payload"), None, warc.DATE)
    assert warc.parse_record(member(raw))[-1] == b"some payload"
    for bad in (member(raw.replace(b"some", b"SOME")), member(raw[:-1]), member(raw)[:-9], member(raw) + b"x", raw):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_lost_attempts_leave_orphans_only(spark):
    archive = warc.write_archive(frame(spark, PAGES))
    kept = files_of(archive)[0]
    with open(kept.replace(".warc.gz", "0.warc.gz"), "wb") as f:
        f.write(b"half a file")
    assert warc.broken(spark, archive).count() == 0 and warc.orphans(spark, archive).count() == 1
    assert warc.read_records(spark, archive, payload=False).count() == len(PAGES)


def test_empty_table(spark):
    assert warc.digest(spark, frame(spark, PAGES).where("false")).count() == 0
