"""Web archives with a merged capture index.

Every task writes WARC files (a gzip member a record) and, for each file, a run: its captures sorted by URL key and
time. The runs are merged into one index in global order: ranges of the order are dealt out, and each range merges its slices
of all runs by a tournament tree of losers, a whole stretch of a run at a time. Archives are read through that index, so
a record that it doesn't hold isn't found.
"""

from __future__ import annotations

import base64
import hashlib
import time
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import relieved, shared_dir, small_batches, stored

#: Bytes of an archive file after which the next begins; bytes of it that are read by one key; captures in a range of the index.
ARCHIVE, PIECE, RANGE = 1 << 26, 1 << 22, 1 << 17
#: Rows of duplicated payloads that are broadcast whole; beyond, only those that take over 1 / SHARED of all captures.
FEW, SHARED = 1 << 17, 1 << 12
CAPTURE = "url_key string, at bigint, page_id bigint, record_type string, file string, offset bigint, length bigint"
ORDER = ["url_key", "at", "page_id", "file", "offset"]


def url_key(url: Column) -> Column:
    """A URL's key: its host's labels reversed, `)`, its path and query. A leading `www.`, user, port and fragment don't count; hosts are in lower case.

    A null url has the empty key, one without `://` itself.
    """
    rest = F.substring_index(F.regexp_extract(url, r"^[^:]*://((?s:.*))$", 1), "#", 1)
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^(?:[^/?@]*@)?([^/?:]*)", 1)), r"^www\.", "")
    tail = F.regexp_extract(rest, r"^[^/?]*((?s:.*))$", 1)
    path = F.when(F.startswith(tail, F.lit("/")), tail).otherwise(F.concat(F.lit("/"), tail))
    return F.when(url.isNull(), "").when(~F.contains(url, F.lit("://")), url).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path))


def judged(pages: DataFrame, least: int = 0) -> DataFrame:
    """pages(page_id, url, html, at) with digest and `top`: the page_id of the response among equal payloads; null for a response.

    Of payloads of `least` bytes or more that are equal the rows of the largest page_id are responses; smaller payloads all are. A null
    page_id is below all others.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), "at").withColumn("digest", F.sha1("html"))
    counted = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("many"))
    copies = stored(counted.where("many > 1").select(F.col("digest").alias("d"), "top", "many"), "copies")
    if copies.count() <= FEW:
        found = rows.join(F.broadcast(copies), F.col("digest") == F.col("d"), "left")
    else:
        total = rows.count()
        hot = stored(copies.where(F.col("many") * SHARED > total), "hot")  # SHARED rows at most
        seldom = rows.join(F.broadcast(hot.select("d")), F.col("digest") == F.col("d"), "left_anti")
        seldom = seldom.join(copies.where(F.col("many") * SHARED <= total), F.col("digest") == F.col("d"), "left")
        found = rows.join(F.broadcast(hot), F.col("digest") == F.col("d")).unionByName(seldom)
    return found.withColumn("top", F.when(~F.col("top").eqNullSafe(F.col("page_id")), F.col("top"))).drop("d", "many")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}:{digest}'.encode()).hexdigest())}>"


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC record as a gzip member."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *fields, ("Content-Length", len(block))])
    packed = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packed.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packed.flush()


def _fields(head: bytes) -> dict[str, str]:
    return {k: v for k, _, v in (line.partition(": ") for line in head.decode().split("\r\n")[1:])}


def _stamp(seconds: int) -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(seconds))


def capture_records(page_id: int | None, url: str | None, payload: bytes, at: int, digest: str, top: int | None) -> tuple[str, bytes]:
    """The type and the record of a capture. `digest` is the payload's SHA-1 in hex; with `top` the record revisits that page and leaves the payload out."""
    kind = "response" if top is None else "revisit"
    target = f"urn:page:{page_id}" if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
    fields = [("WARC-Record-ID", _record_id(page_id, digest if top is None else f"{digest}:{url}")), ("WARC-Date", _stamp(at)), ("WARC-Target-URI", target), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if top is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _record_id(top, digest)), ("X-Refers-To-Page-Id", str(top))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return kind, _record(kind, [*fields, ("Content-Type", "application/http; msgtype=response")], http + (payload if top is None else b""))


def _opened(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder, local or by its scheme, and the folder's path in it."""
    return pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pyarrow.fs.LocalFileSystem(), folder)


def write_archives(pages: DataFrame, folder: str, least: int = 0, archive: int = ARCHIVE) -> DataFrame:
    """Write a WARC record for each row of pages(page_id, url, html, at) and return the runs: url_key, at, page_id, record_type, file, offset, length.

    Files have names of their own, so a repeated task leaves at most a file that no run names. A run is a file's captures by URL key, time, page_id
    and place. A null html is an empty payload, a null `at` the epoch; other columns are ignored, and no row gives no file.
    """

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _opened(folder)
        out, run, size, name = None, [], 0, ""

        def closed() -> pa.RecordBatch:
            out.close()
            run.sort(key=_place)
            return pa.RecordBatch.from_pylist([dict(zip(_NAMES, r)) for r in run], _ARROW)

        for batch in batches:
            for page_id, url, html, at, digest, top, key in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, run = f"captures-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz", []
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                    info = _record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", _stamp(at or 0)), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    size = len(info)
                kind, record = capture_records(page_id, url, html.encode(), at or 0, digest, top)
                out.write(record)
                run.append((key, at or 0, page_id, kind, name, size, len(record)))
                size += len(record)
                if size >= archive:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    spark = pages.sparkSession
    small_batches(spark)
    rows = judged(pages, least)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    at = F.unix_seconds("at")
    return stored(rows.select("page_id", "url", "html", at.alias("at"), "digest", "top", url_key(F.col("url")).alias("url_key")).mapInArrow(of, CAPTURE), "runs")


_NAMES = [c.split()[0] for c in CAPTURE.split(", ")]
_ARROW = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in CAPTURE.split(", ")])


def _place(capture: tuple) -> tuple:
    """What captures are ordered by; no page_id comes first."""
    key, at, page_id, _, file, offset, _ = capture
    return key, at, page_id is not None, page_id or 0, file, offset


class LoserTree:
    """Merges sorted lists of distinct keys. Each inner node keeps the list that lost there, so the next winner costs one way up."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, k = runs, [0] * len(runs), len(runs)
        self.losers = [0] * max(1, k)
        won = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = won[2 * node], won[2 * node + 1]
            won[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = won[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        """Whether list a's next key is before b's; a list at its end is behind all."""
        if self.at[b] >= len(self.runs[b]):
            return True
        return self.at[a] < len(self.runs[a]) and self.runs[a][self.at[a]] < self.runs[b][self.at[b]]

    def stretches(self) -> Iterator[tuple[int, int, int]]:
        """(list, from, to): what comes next, as many keys of one list as lie before all others'."""
        k = len(self.runs)
        while k and self.at[self.winner] < len(self.runs[self.winner]):
            w, node, second = self.winner, (self.winner + k) // 2, None
            while node:  # the runner-up lost to the winner itself
                if second is None or self._before(self.losers[node], second):
                    second = self.losers[node]
                node //= 2
            own, first = self.runs[w], self.at[w]
            rival = self.runs[second][self.at[second]] if second is not None and self.at[second] < len(self.runs[second]) else None
            self.at[w] = len(own) if rival is None else bisect_right(own, rival, first)
            yield w, first, self.at[w]
            node = (w + k) // 2
            while node:
                if self._before(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def merged(runs: DataFrame, captures: int = RANGE) -> DataFrame:
    """The index: runs' rows with `position`, their place from 0 in the order of URL key, time, page_id (null first), file and offset.

    Ranges of that order take about `captures` rows each; the file and offset are part of it, so captures of one URL, or equal ones, are split
    too. A range's slices of the runs are merged in one task.
    """
    ranges = max(runs.sparkSession.sparkContext.defaultParallelism, -(-runs.count() // captures))

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        table = pa.Table.from_batches(batches, _ARROW)
        rows = list(zip(*(c.to_pylist() for c in table.columns)))
        files: dict[str, list[int]] = {}
        for i, r in enumerate(rows):
            files.setdefault(r[4], []).append(i)
        runs, order = list(files.values()), []
        for run, first, last in LoserTree([[_place(rows[i]) for i in run] for run in runs]).stretches():
            order += runs[run][first:last]
        found = table.take(pa.array(order, pa.int64())).append_column("part", pa.array([part] * len(order), pa.int32())).append_column("local", pa.array(range(len(order)), pa.int64()))
        yield from found.to_batches()

    slices = runs.repartitionByRange(ranges, *ORDER).sortWithinPartitions("file", *ORDER[:3], "offset")
    rows = stored(slices.mapInArrow(of, f"{CAPTURE}, part int, local bigint"), "index")
    sizes = rows.groupBy("part").agg(F.count("*").alias("n"))  # a row for each range
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return rows.join(F.broadcast(before), "part").select(*_NAMES, (F.col("base") + F.col("local")).alias("position"))


def histories(index: DataFrame) -> DataFrame:
    """(url_key, captures, responses, first_at, last_at, position) of every URL key: its captures stand together in the index from `position` on."""
    return index.groupBy("url_key").agg(F.count("*").alias("captures"), F.count_if(F.col("record_type") == "response").alias("responses"), F.timestamp_seconds(F.min("at")).alias("first_at"), F.timestamp_seconds(F.max("at")).alias("last_at"), F.min("position").alias("position"))


def read_archives(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """(position, page_id, url, at, record_type, refers_to, payload_bytes, payload_digest[, payload]) of every capture that the index names.

    A revisit has its response's page_id in refers_to, and a null payload; its bytes and digest are the full payload's. Pieces of a file go to
    different tasks and are read in the order of their places. A record whose payload doesn't have its digest fails.
    """

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _opened(folder)
        name, source = None, None
        for batch in batches:
            out = []
            for position, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    name, source = file, system.open_input_file(f"{base}/{file}")
                source.seek(offset)
                head, _, block = zlib.decompress(source.read(length), 31).partition(b"\r\n\r\n")
                fields = _fields(head)
                block = block[: int(fields["Content-Length"])]
                http, _, payload = block.partition(b"\r\n\r\n")
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                    raise ValueError(f"payload digest mismatch: {file} at {offset}")
                page_id, top = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
                url = None if fields["WARC-Target-URI"].startswith("urn:page:") else fields["WARC-Target-URI"]
                row = (position, page_id and int(page_id), url, fields["WARC-Date"], kind, top and int(top), int(_fields(http)["Content-Length"]), digest)
                out.append((*row, payload.decode() if kind == "response" else None) if payloads else row)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names)

    text, number = pa.string(), pa.int64()
    names = ["position", "page_id", "url", "at", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payloads
    types = [number, number, text, text, text, number, number, text, text][: len(names)]
    pieces = index.select("position", "file", "offset", "length", F.expr(f"offset div {PIECE}").alias("piece")).repartition("file", "piece").sortWithinPartitions("file", "offset")
    rows = pieces.select("position", "file", "offset", "length").mapInArrow(of, ", ".join(f"{n} {'string' if t == text else 'bigint'}" for n, t in zip(names, types)))
    return rows.withColumn("at", F.to_timestamp("at"))


def dangling(records: DataFrame) -> DataFrame:
    """Revisits whose response, by page_id and digest, isn't among the records."""
    responses = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest").distinct()
    return records.where("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left_anti")


def op12_web_archive(spark, sf_dir):
    """All pages as WARC records, read back through the merged index. The table has no times: a page is captured page_id (mod 10**8) seconds after 2024-01-01."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    at = F.timestamp_seconds(F.coalesce(F.pmod("page_id", F.lit(100_000_000)), F.lit(0)) + 1_704_067_200)
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    index = merged(write_archives(pages.select("page_id", "url", "html", at.alias("at")), folder))
    return read_archives(index, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "position")


OP12_SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, url, strlen(t) AS payload_bytes, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS top FROM p),
b AS (SELECT *, array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform(range(4), lambda c: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((CAST('0x' || h[5 * g + 1 : 5 * g + 5] AS BIGINT) >> (15 - 5 * c)) & 31) + 1]), '')), '') AS payload_digest FROM d),
u AS (SELECT *, split_part(regexp_extract(url, '^[^:]*://(.*)$', 1), '#', 1) AS rest FROM b),
k AS (SELECT *, CASE WHEN url IS NULL THEN '' WHEN NOT contains(url, '://') THEN url ELSE array_to_string(list_reverse(string_split(regexp_replace(lower(regexp_extract(rest, '^(?:[^/?@]*@)?([^/?:]*)', 1)), '^www\.', ''), '.')), ',') || ')' ||
  CASE WHEN starts_with(regexp_extract(rest, '^[^/?]*(.*)$', 1), '/') THEN '' ELSE '/' END || regexp_extract(rest, '^[^/?]*(.*)$', 1) END AS key FROM u)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to,
  row_number() OVER (ORDER BY key, page_id % 100000000, page_id) - 1 AS position
FROM k
"""
