"""Archives written and read back, against hashlib and a plain parser."""

import base64
import hashlib

import pytest
from compare import compare, oracle_connection
from pyspark.sql import functions as F

from hammerline.llm import warc
from hammerline.llm.queries import ORACLES, QUERIES


def bare(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def test_query_matches_hashlib_and_sql(spark, sf):
    name = "op7_warc_archive"
    rows = {r.page_id: r for r in QUERIES[name](spark, sf).collect()}
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert set(rows) == set(pages)
    last = {}
    for i in sorted(pages):
        last[pages[i]] = i
    for i, payload in pages.items():
        keep = last[payload]
        kind, refers = ("response", None) if keep == i else ("revisit", keep)
        assert tuple(rows[i][c] for c in ("payload_bytes", "payload_digest", "record_type", "refers_to")) == (
            len(payload), bare(payload), kind, refers)
    if name in ORACLES:
        problems, _ = compare(QUERIES[name](spark, sf), oracle_connection(sf), ORACLES[name])
        assert not problems


EDGES = [(1, "u", None), (2, None, ""), (3, "a\r\nb", "<p>é</p>"), (3, "a", "<p>é</p>"), (None, "n", "<p>é</p>"),
         (5, "x", "y" * 300_000), (6, "x", "lone")]


def edge_pages(spark):
    return spark.createDataFrame([(*r, "k", "p") for r in EDGES], "page_id long, url string, html string, key string, payload string")


def test_exact_records(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write(edge_pages(spark), path)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    records = warc.read(spark, path).collect()
    assert len(records) == len(EDGES)
    names = set()
    for r in records:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        assert lines[0] == "WARC/1.1" and fields["WARC-Type"] == r.record_type and head.decode() + "\r\n\r\n" == r.header
        names.add(fields["WARC-Record-ID"])
        if r.record_type == "response":
            assert int(fields["Content-Length"]) == len(rest) - 4 and rest.endswith(b"\r\n\r\n")
            payload = rest[:-4].partition(b"\r\n\r\n")[2]
            assert fields["WARC-Payload-Digest"] == "sha1:" + bare(payload)
            assert payload in {(h or "").encode() for _, _, h in EDGES}
        else:
            assert fields["WARC-Refers-To"] and r.refers_to is not None
    assert len(names) == len(EDGES)
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.summary(spark, path).collect())
    assert got == [("1", "revisit", 2), ("2", "response", None), ("3", "response", None), ("3", "revisit", 3),
                   ("5", "response", None), ("6", "response", None), ("None", "revisit", 3)]


def test_small_payloads_and_empty_table(spark, tmp_path):
    path = str(tmp_path / "small")
    warc.write(edge_pages(spark), path, least_bytes=1)
    kinds = {r.page_id: r.record_type for r in warc.summary(spark, path).collect()}
    assert kinds[1] == kinds[2] == "response"
    assert warc.archive(edge_pages(spark).limit(0)).count() == 0


def test_damage_is_found(spark, tmp_path):
    path = str(tmp_path / "damaged")
    warc.write(edge_pages(spark), path)
    stored = spark.read.parquet(f"{path}/payloads")
    stored.withColumn("payload", F.concat("payload", F.lit(b"!"))).write.parquet(str(tmp_path / "other/payloads"))
    spark.read.parquet(f"{path}/headers").write.parquet(str(tmp_path / "other/headers"))
    with pytest.raises(Exception, match="differs from its digest"):
        warc.summary(spark, str(tmp_path / "other")).collect()
