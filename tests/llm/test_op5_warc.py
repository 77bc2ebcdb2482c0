from __future__ import annotations

import glob
import gzip

import pytest

from tallybrook.llm import op5_warc as warc
from tallybrook.llm.queries import op5_warc_round_trip
from tests.llm.helpers import table


def expected(pages):
    """(page_id, bytes, digest, type, refers_to) of pages with unique ids."""
    top = {}
    for i, html in pages:
        top[html or ""] = max(top.get(html or "", -1), i)
    out = set()
    for i, html in pages:
        data, first = (html or "").encode(), top[html or ""]
        out.add((i, len(data), warc.base32_sha1(data), "response" if first == i else "revisit", None if first == i else first))
    return out


def test_every_page(spark, sf_dir):
    pages = [(r["page_id"], r["html"]) for r in table(spark, sf_dir, "pages").collect()]
    assert {tuple(r) for r in op5_warc_round_trip(spark, sf_dir).collect()} == expected(pages)


PAGES = [
    (1, "http://a/", "<p>same é</p>" * 2000),
    (2, None, None),
    (3, "http://a/ b\r\nX: y", ""),
    (4, "http://a/4", "<p>same é</p>" * 2000),
    (5, "", "WARC/1.1\r\n\r\n \x1f body"),
    (6, "http://a/6", "<p>same é</p>" * 2000),
]


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    folder = f"{tmp_path_factory.mktemp('warc')}/archives"
    df = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, sha string, top int")
    warc.write_archives(df.repartition(2), folder)
    return folder


@pytest.mark.parametrize("range_bytes", [50, 700, 10**7])
def test_ranges_of_any_size_own_each_record_once(spark, archives, range_bytes):
    rows = warc.read_archives(spark, archives, range_bytes=range_bytes).collect()
    got = {
        (int(r["record_id"][10:-1]), r["payload_bytes"], r["payload_digest"], r["record_type"],
         r["refers_to"] and int(r["refers_to"][10:-1])) for r in rows
    }
    assert len(rows) == len(PAGES)
    assert got == expected([(i, html) for i, _, html in PAGES])
    payloads = {r["record_id"]: r["payload"] for r in rows if r["record_type"] == "response"}
    assert bytes(payloads["<urn:page:6>"]).decode() == PAGES[5][2]


def test_archives_are_plain_gzip(archives):
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{archives}/part-*"))
    assert data.count(b"WARC-Type: response") == 3
    assert data.count(b"WARC-Type: revisit") == 3
    assert b"\r\nX: y" not in data


def test_damage_is_not_passed_over(spark, archives, tmp_path):
    source = max(glob.glob(f"{archives}/part-*"), key=lambda f: len(open(f, "rb").read()))
    data = open(source, "rb").read()
    (tmp_path / "cut.gz").write_bytes(data[: len(data) // 2])
    with pytest.raises(Exception, match="archive ends inside|damaged"):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_repeated_and_null_ids_and_no_pages(spark, tmp_path):
    schema = "page_id long, url string, html string"
    rows = [(7, "u", "q"), (7, "u", "q"), (None, "u", "q"), (None, "u", "z")]
    warc.write_archives(spark.createDataFrame(rows, schema), f"{tmp_path}/a")
    got = sorted((r["record_id"], r["record_type"]) for r in warc.read_archives(spark, f"{tmp_path}/a").collect())
    assert got == [
        ("<urn:page:7>", "response"), ("<urn:page:7>", "response"),
        ("<urn:page:None>", "response"), ("<urn:page:None>", "revisit"),
    ]
    warc.write_archives(spark.createDataFrame([], schema), f"{tmp_path}/b")
    assert warc.read_archives(spark, f"{tmp_path}/b").collect() == []
