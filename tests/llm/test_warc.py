"""WARC round trips, pushdown and foreign files."""

import gzip

import pytest

from tidebar.llm.queries import op2_warc
from tidebar.llm.warc import base32_sha1, digest_column, page_records, read_warc, record, write_pages

PAGES = "page_id long, url string, html string, record_type string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES).repartition(3)


ROWS = [
    (3, "http://a/\r\nX-Page-Id: 9", "<p>é</p>"), (1, None, "same"), (2, "u", "same"), (5, "u", "same"), (1, None, "same"),
    (4, "u", None), (6, "u", ""), (None, "u", "same"), (None, "u", "alone"), (8, "u", "WARC/1.1\r\n\r\n" * 50_000), (9, "u", "\r\n\r\n"),
]


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "a")
    write_pages(pages(spark, ROWS), path)
    got = read_warc(spark, path).collect()
    assert len(got) == len(ROWS)
    first = {}
    for i, _, h in ROWS:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in ROWS:
        body = (h or "").encode()
        revisit = i != first.get(h or "")
        kind = ("revisit", first.get(h or ""), None) if revisit else ("response", None, body)
        want.append((i, len(body), base32_sha1(body), *kind))
    read = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    payload = [(bytes(r.payload) if r.record_type == "response" else None) for r in got]
    assert sorted(((*a, b) for a, b in zip(read, payload, strict=True)), key=repr) == sorted(want, key=repr)
    named = {r.record_id: r for r in got if r.record_type == "response"}
    assert all(named[r.refers_to_record].page_id == r.refers_to for r in got if r.record_type == "revisit")
    assert all(r.refers_to_record is None for r in named.values())
    assert next(r for r in got if r.page_id == 3).target_uri == "http://a/ X-Page-Id: 9"


def test_filters_and_columns_are_pushed_down(spark, tmp_path):
    path = str(tmp_path / "a")
    write_pages(pages(spark, ROWS), path)
    df = read_warc(spark, path, ["page_id", "record_type"]).where("record_type = 'revisit' and page_id in (2, 5, 99)")
    assert sorted(r.page_id for r in df.collect()) == [2, 5]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (record_type" not in plan, plan
    assert read_warc(spark, path).where("page_id is null").count() == 2
    assert read_warc(spark, path, ["page_id"]).count() == len(ROWS)


def test_the_query_pushes_both_filters(spark):
    plan = op2_warc(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan warc") == 2 and "Filter (record_type" not in plan, plan


def test_append_overwrite_and_empty(spark, tmp_path):
    path = str(tmp_path / "a")
    write_pages(pages(spark, []), path)
    assert read_warc(spark, path).collect() == []
    for n in (1, 2):
        write_pages(pages(spark, ROWS[:3]), path)
        assert read_warc(spark, path).count() == 3 * n
    page_records(pages(spark, ROWS[:2])).write.format("warc").mode("overwrite").save(path)
    assert read_warc(spark, path).count() == 2


def test_foreign_archives(spark, tmp_path):
    plain = (
        "WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
        "WARC/1.0\r\nwarc-type: response\r\nWARC-Target-URI: http://x\r\n  /y\r\nContent-Length: 9\r\n\r\n"
        "a\r\n\r\nWARC\r\n\r\n"
    ).encode()
    (tmp_path / "a.warc").write_bytes(plain)
    cut = plain.index(b"WARC/1.0\r\nwarc-type")
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(plain[:cut]) + gzip.compress(plain[cut:]))
    got = sorted((r.record_type, r.target_uri, bytes(r.payload)) for r in read_warc(spark, str(tmp_path)).collect())
    assert got == sorted([("warcinfo", None, b"hello"), ("response", "http://x /y", b"a\r\n\r\nWARC")] * 2, key=repr) or (
        [g[0] for g in got] == ["response", "response", "warcinfo", "warcinfo"] and got[0][2] == b"a\r\n\r\nWARC"
    )


def test_a_cut_record_is_an_error(spark, tmp_path):
    data = record({"record_type": "response", "payload": bytes(range(256)) * 99})
    (tmp_path / "a.warc.gz").write_bytes(data[:-40])
    with pytest.raises(Exception, match="cut short"):
        read_warc(spark, str(tmp_path)).collect()


def test_digest_column(spark):
    df = spark.createDataFrame([("",), ("é",), ("x" * 999,)], "t string")
    for r in df.select("t", digest_column(df.t).alias("d")).collect():
        assert r.d == base32_sha1(r.t.encode())
