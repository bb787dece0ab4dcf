"""Archives: records, the merged index, and what is read back."""

import base64
import glob
import gzip
import hashlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc

SCHEMA = "page_id bigint, url string, html string, at timestamp, digest string, position bigint, top bigint"


def row(i, url, html, minute=0):
    return (i, url, html, datetime(2024, 5, 1) + timedelta(minutes=minute), "x", -1, 7)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    out = [row(i, f"http://{r.choice(['www.b.org', 'A.net', 'c.b.org'])}/p{i % 40}?q", f"<p>seite {i % 90} ü</p>" * (1 + i % 5), r.randrange(500)) for i in range(600)]
    out += [row(1000 + i, "http://hot.com/", "<hot>", 3) for i in range(300)]
    out += [row(2000, None, None), row(2001, "no scheme", ""), row(2002, "https://u@H.com:8443#f", "x\r\n\r\nWARC/1.1\r\n\r\n"), row(2003, "ftp://x/ a\r\nb", "日本\n" * 200_000), row(None, "http://n/", "only null"), row(None, "http://n/", "<hot>"), row(600, "http://t/", "tie"), row(600, "http://t/", "tie")]
    return out


@pytest.fixture(scope="module")
def read(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc") / "archives")
    runs = warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(7), folder, archive=4000)
    index = warc.merged(runs, 100)
    return folder, runs, index, [r.asDict() for r in warc.read_archives(index, folder).collect()]


def test_captures(rows, read):
    top = {}
    for i, _, html, *_ in rows:
        top[html or ""] = max(top.get(html or "", -1), -1 if i is None else i)
    want = []
    for i, url, html, at, *_ in rows:
        payload, first = (html or "").encode(), top[html or ""]
        response = first == (-1 if i is None else i)
        want.append((i, at, "response" if response else "revisit", None if response else first, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), (html or "") if response else None))
    key = str
    assert sorted(((r["page_id"], r["at"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"], r["payload"]) for r in read[3]), key=key) == sorted(want, key=key)
    assert {r["page_id"]: r["url"] for r in read[3] if r["page_id"] in (2000, 2001, 2003)} == {2000: None, 2001: "no%20scheme", 2003: "ftp://x/%20a%0D%0Ab"}


def test_global_order(spark, read):
    folder, runs, index, _ = read
    assert runs.select("file").distinct().count() > 20
    rows = [r.asDict() for r in index.orderBy("position").collect()]
    assert [r["position"] for r in rows] == list(range(len(rows)))
    places = [(r["url_key"], r["at"], -1 if r["page_id"] is None else r["page_id"], r["file"], r["offset"]) for r in rows]
    assert places == sorted(places) and len(rows) == runs.count()
    told = {r["url_key"]: r for r in warc.histories(index).collect()}
    assert told["com,hot)/"]["captures"] == 300 and told["com,hot)/"]["responses"] == 1
    assert rows[told["com,hot)/"]["position"]]["url_key"] == "com,hot)/"


def test_files_are_archives(read):
    whole = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{read[0]}/*.warc.gz")))
    assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and whole.endswith(b"\r\n\r\n")


def test_no_response_is_missing(spark, read):
    records = warc.read_archives(read[2], read[0])
    assert warc.dangling(records).count() == 0
    assert warc.dangling(records.where("record_type = 'revisit'")).count() > 0


def test_small_payloads_and_many_copies(spark, rows, tmp_path, monkeypatch):
    pages = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(warc, "FEW", 0)
    monkeypatch.setattr(warc, "SHARED", 8)
    same = sorted(map(str, warc.judged(pages, 0).select("page_id", "digest", "top").collect()))
    monkeypatch.undo()
    assert same == sorted(map(str, warc.judged(pages, 0).select("page_id", "digest", "top").collect()))
    assert warc.judged(pages, 6).where("top is not null and octet_length(html) < 6").count() == 0


def test_url_keys(spark):
    want = {"http://www.B.org:80/A?x#y": "org,b)/A?x", "http://b.org": "org,b)/", "http://b.org?q": "org,b)/?q", "https://u:p@m.x.com/": "com,x,m)/", "plain": "plain", None: "", "http:///p": ")/p"}
    df = spark.createDataFrame([(u,) for u in want], "url string")
    assert {r["url"]: r["k"] for r in df.withColumn("k", warc.url_key(F.col("url"))).collect()} == want


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    r = random.Random(k)
    keys = r.sample(range(1000), 200)
    runs = [sorted(keys[i::k]) for i in range(k)]
    if k > 2:
        runs[1] = []
    out = [x for i, a, b in warc.LoserTree(runs).stretches() for x in runs[i][a:b]]
    assert out == sorted(x for run in runs for x in run)


def test_nothing(spark, tmp_path):
    runs = warc.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    index = warc.merged(runs)
    assert index.count() == 0 and warc.read_archives(index, str(tmp_path / "none")).count() == 0
