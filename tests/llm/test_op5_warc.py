import base64
import gzip
import hashlib

import pytest

from tessera.llm.op5_warc import WarcReader, read_archives, record, write_archives
from tests.conftest import SF_SMALL
from tests.llm.sql import agrees

PAGES = [(7, "http://a/é x", "same"), (3, None, "same"), (9, "u", "same"), (1, "u", ""), (2, "u", None), (5, "u", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n")]
PAGES += [(10, "u", "x" * 300_000), (10, "u", "x" * 300_000), (None, "u", "alone"), (None, "u", "same")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pages = spark.createDataFrame([(*p, "more", 1) for p in PAGES], "page_id long, url string, html string, digest string, first int")
    return write_archives(pages, f"file://{tmp_path_factory.mktemp('warc')}", stretch_bytes=400, archive_bytes=200_000)


def expected(least=0):
    out = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        same = [j for j, _, h in PAGES if (h or "") == (html or "") and j is not None]
        first = min(same, default=None)
        again = first is not None and i != first and len(raw) >= least
        out.append((i, base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", len(raw), first if again else None))
    return out


def seen(rows):
    number = lambda x: None if x is None or "None" in x else int(x[10:-1])
    return [(number(r["record_id"]), r["payload_digest"], r["warc_type"], r["payload_length"], number(r["refers_to"])) for r in rows]


def test_round_trip(spark, folder):
    rows = read_archives(spark, folder).collect()
    assert sorted(seen(rows), key=str) == sorted(expected(), key=str)
    for r in rows:
        assert r["payload"] is None if r["warc_type"] == "revisit" else len(r["payload"]) == r["payload_length"]


def test_pushed_predicates_skip_blocks(spark, folder):
    plan = read_archives(spark, folder, payload=False).where("warc_type = 'revisit' AND record_id IN ('<urn:page:7>', '<urn:page:1>')")
    assert [r["refers_to"] for r in plan.collect()] == ["<urn:page:3>"]
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in shown and "Filter isnotnull" not in shown
    assert read_archives(spark, folder).where("target_uri LIKE 'http://a%'").count() == 1
    assert read_archives(spark, folder).where("payload_length > 100000").count() == 2


def test_least_bytes_and_foreign_gzip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    least = write_archives(pages, str(tmp_path / "a"), least_bytes=5)
    assert sorted(seen(read_archives(spark, least).collect()), key=str) == sorted(expected(5), key=str)
    (tmp_path / "b").mkdir()
    made = [record("response", str(i), "u", "2024-01-01T00:00:00Z", base64.b32encode(hashlib.sha1(b"p%d" % i).digest()).decode(), b"p%d" % i) for i in range(5)]
    (tmp_path / "b" / "x.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in made))
    got = read_archives(spark, str(tmp_path / "b")).where("record_id = '<urn:page:3>'").collect()
    assert [bytes(r["payload"]) for r in got] == [b"p3"]


def test_wrong_digest_is_found(tmp_path):
    (tmp_path / "x.warc").write_bytes(record("response", "1", "u", "d", "A" * 32, b"payload"))
    reader = WarcReader({"path": str(tmp_path)})
    with pytest.raises(ValueError, match="digest"):
        list(reader.read(reader.partitions()[0]))


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archives(spark, write_archives(none, str(tmp_path / "none"))).count() == 0


def test_query_against_sql(spark):
    agrees(spark, "op5_warc", SF_SMALL)
