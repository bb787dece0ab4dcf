"""Readers for filing lists, JSON lines, market CSV, parquet by id, file trees and filings."""

from __future__ import annotations

import hashlib
import io
import zipfile
import zlib
from collections.abc import Iterator
from html.entities import name2codepoint
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.contracts import first_reason, is_document_id, squeezed
from ..operators.graph import cut

LIST_SCHEMA = (
    "metadata struct<status:string,parameter:struct<date:string>,resultset:struct<count:bigint>>, results array<struct<"
    "seqNumber:bigint,docID:string,edinetCode:string,secCode:string,JCN:string,filerName:string,issuerEdinetCode:string,"
    "subjectEdinetCode:string,parentDocID:string,submitDateTime:string,opeDateTime:string,withdrawalStatus:string,"
    "docInfoEditStatus:string,disclosureStatus:string,docTypeCode:string>>, _corrupt string"
)
# Columns that each market data set must have.
MARKET_COLUMNS = {
    "equities_master": ("Date", "Code", "Mkt", "ProdCat"),
    "equities_bars_daily": ("Date", "Code", "O", "H", "L", "C", "Vo", "AdjFactor"),
    "fins_summary": ("DiscDate", "DiscTime", "Code", "DiscNo", "DocType", "CurPerSt", "CurPerEn"),
    "markets_calendar": ("Date", "HolDiv"),
}


def daily_lists(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of daily filing lists, one JSON document a file.

    A file is rejected as a whole if it can't be read, its status isn't 200, its count isn't the rows', or a sequence
    number is missing, not positive or repeated, or a document id is malformed. A lower-case parent id is kept with a warning.
    """
    raw = spark.read.schema(LIST_SCHEMA).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    raw = raw.withColumn("file", F.input_file_name())
    seq = F.transform("results", lambda r: r["seqNumber"])
    reason = first_reason(
        (F.col("_corrupt").isNotNull() | F.col("metadata").isNull(), "list_unreadable"),
        (~F.col("metadata.status").eqNullSafe(F.lit("200")), "list_status_not_200"),
        (~F.col("metadata.resultset.count").eqNullSafe(F.size("results").cast("bigint")), "list_count_mismatch"),
        (F.exists(seq, lambda s: s.isNull() | (s <= 0)) | (F.size(F.array_distinct(seq)) != F.size(seq)), "list_sequence_invalid"),
        (F.exists("results", lambda r: ~is_document_id(r["docID"])), "list_document_id_invalid"),
    )
    judged = raw.withColumn("reason", reason)
    rows = judged.where("reason is null").select("file", F.col("metadata.parameter.date").alias("day"), F.posexplode("results").alias("index", "r")).select("file", "day", "index", "r.*")
    rows = rows.withColumn("warning", F.when(F.col("parentDocID").rlike("[a-z]"), "parent_id_lower_case"))
    return rows, judged.where("reason is not null").select("file", "reason")


def json_lines(spark: SparkSession, path: str, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of JSON lines, each with the file and the byte-free line text's hash as locator.

    A line that isn't one complete object, or lacks a required field, is rejected with a reason.
    """
    text = spark.read.text(path).withColumn("file", F.col("_metadata.file_path")).withColumn("line_sha256", F.sha2("value", 256))
    names = [f.name for f in T._parse_datatype_string(schema)]
    parsed = text.withColumn("r", F.from_json("value", schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    lacks = F.lit(False)
    for c in required:
        lacks = lacks | F.col(f"r.{c}").isNull()
    judged = parsed.withColumn("reason", first_reason((F.col("r._corrupt").isNotNull() | F.col("r").isNull(), "line_unreadable"), (lacks, "required_field_missing")))
    return judged.where("reason is null").select("file", "line_sha256", *[F.col(f"r.{c}").alias(c) for c in names]), judged.where("reason is not null").select("file", "line_sha256", "reason")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): each line with its number in its file, from 1; lines end at line feeds. Splits of a file are read in parallel.

    Rows of a split follow each other, so a line's place in its split is its running id less the split's first. The splits' lines are counted and
    added up along the file, one row a split, and give each split the number that it begins with.
    """
    text = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    splits = text.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    splits = splits.select("file", "block", "first", (F.sum("n").over(upto) - F.col("n")).alias("before"))
    return text.join(splits, ["file", "block"]).select("file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), "value")


def market_csv(spark: SparkSession, dataset: str, path: str, columns: list[str]) -> DataFrame:
    """All-string rows of a market data set (plain or gzip CSV) with `missing_reason`.

    The file must have these columns in this order, among them the data set's; a row of another width is
    malformed, one with a bad date or code says so. A byte order mark is tolerated.
    """
    lacking = set(MARKET_COLUMNS[dataset]) - set(columns)
    if lacking or len(set(columns)) != len(columns) or "" in columns:
        raise ValueError(f"header of {dataset} is not acceptable: {sorted(lacking)}")
    schema = ", ".join(f"`{c}` string" for c in columns) + ", _corrupt string"
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    day = "Date" if "Date" in columns else "DiscDate"
    bad_day = ~F.coalesce(F.col(day).rlike(r"^\d{4}-\d\d-\d\d$"), F.lit(False)) | F.col(day).try_cast("date").isNull()
    bad_code = ~F.coalesce(F.col("Code").rlike("^[0-9A-Z]{4,5}$"), F.lit(False)) if "Code" in columns else F.lit(False)
    reason = first_reason((F.col("_corrupt").isNotNull(), "row_width_mismatch"), (bad_day, "invalid_date"), (bad_code, "invalid_code"))
    return rows.withColumn("file", F.input_file_name()).withColumn("missing_reason", reason).drop("_corrupt")


def parquet_by_ids(spark: SparkSession, path: str, column: str, ids: DataFrame, listed: int = 1000) -> DataFrame:
    """The rows whose id is in ids(id), with file and row place.

    Up to `listed` ids are handed to the reader, which skips row groups that can't hold any; more are met by a join.
    """
    few = [r["id"] for r in ids.where("id is not null").distinct().limit(listed + 1).collect()]  # listed + 1 rows at most
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row_index"))
    if len(few) <= listed:
        return rows.where(F.col(column).isin(few))
    return rows.join(ids.select(F.col("id").alias(column)).distinct(), column, "left_semi")


#: Bytes of a file that are held at a time.
PIECE = 1 << 20


def fingerprints(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, sha256, size, modified) of every file below a path.

    A file is read by one task, as its SHA-256 is sequential: on a mounted disk a piece at a time, so files of any size pass, elsewhere as one value of 2 GB at most.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    rest = [F.col("length").alias("size"), F.col("modificationTime").alias("modified")]
    if spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        return files.select("path", F.sha2("content", 256).alias("sha256"), *rest)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name in batch.column(0).to_pylist():
                digest = hashlib.sha256()
                with open(name.removeprefix("file:"), "rb") as stream:
                    while piece := stream.read(PIECE):
                        digest.update(piece)
                found.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), batch.column(1), batch.column(2)], ["path", "sha256", "size", "modified"])

    return files.select("path", *rest).mapInArrow(of, "path string, sha256 string, size bigint, modified timestamp")


def archive_frame(spark: SparkSession, path: str, events: DataFrame, suffix: str = "zip") -> DataFrame:
    """Archived documents (file name without suffix) with their listing days and number of files; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").load(path).select("path", F.col("length").alias("size"))
    own = files.withColumn("doc_id", F.regexp_extract("path", rf"([^/]+)\.{suffix}$", 1))
    days = events.groupBy("doc_id").agg(F.array_sort(F.collect_set("day")).alias("days"), F.count("*").alias("listings"))
    return own.join(days, "doc_id", "left")


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str], columns: list[str], revision: int | None = None) -> DataFrame:
    """(key, change, fields, reason, revision): added, changed (which fields, sorted; those with a value if added) or absent.

    An absent row is not taken for withdrawn, and its reason says so. revision: that of the snapshot before, null for none.
    """
    a = before.select(*key, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_a"))
    b = after.select(*key, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_b"))
    met = a.join(b, key, "full")
    fields = F.array_compact(F.array(*[F.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), F.lit(c)) for c in sorted(columns)]))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "absent").when(F.size(fields) > 0, "changed")
    return met.select(*key, change.alias("change"), F.when(change == "absent", F.array().cast("array<string>")).otherwise(fields).alias("fields"), F.when(change == "absent", "not_inferred_withdrawn").alias("reason"), F.lit(0 if revision is None else revision + 1).alias("revision")).where("change is not null")


def snapshot_series(rows: DataFrame, key: list[str], columns: list[str], snapshot: str = "snapshot") -> DataFrame:
    """(key, snapshot, change, fields, revision, last_seen): what happens to each key over a series of snapshots, rows(snapshot, key, columns).

    added at a key's first snapshot, changed where a column differs from the snapshot before, absent at the first snapshot without the key, returned
    at the next with it. fields are those that differ from when the key was last seen, sorted (none if absent; those with a value if added). revision counts
    the contents so far, from 0. last_seen is the snapshot of the last row before. Snapshots follow each other in the order of their column; those
    that hold no row at all don't exist. A key has one row a snapshot at most. A series that is continued gives the old events again and the new ones.
    """
    listed = rows.select(snapshot).distinct()
    numbers = F.broadcast(listed.withColumn("_i", F.row_number().over(Window.orderBy(snapshot))).withColumn("_next", F.lead(snapshot).over(Window.orderBy(snapshot))))  # a row for each snapshot
    along = Window.partitionBy(*key).orderBy("_i")
    said = rows.select(*key, snapshot, F.struct(*columns).alias("_c")).join(numbers, snapshot)
    said = said.withColumn("_was", F.lag("_c").over(along)).withColumn("_at", F.lag("_i").over(along)).withColumn("_seen", F.lag(snapshot).over(along)).withColumn("_then", F.lead("_i").over(along))
    fields = F.array_compact(F.array(*[F.when(~F.col(f"_c.{c}").eqNullSafe(F.col(f"_was.{c}")), F.lit(c)) for c in sorted(columns)]))
    said = said.withColumn("_f", fields).withColumn("revision", F.sum(F.when(F.col("_at").isNotNull() & (F.size("_f") > 0), 1).otherwise(0)).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    change = F.when(F.col("_at").isNull(), "added").when(F.col("_at") < F.col("_i") - 1, "returned").when(F.size("_f") > 0, "changed")
    here = F.struct(F.col(snapshot).alias("s"), change.alias("change"), F.col("_f").alias("fields"), F.col("_seen").alias("last"))
    gone = F.when(F.col("_next").isNotNull() & ~F.col("_then").eqNullSafe(F.col("_i") + 1), F.struct(F.col("_next").alias("s"), F.lit("absent").alias("change"), F.array().cast("array<string>").alias("fields"), F.col(snapshot).alias("last")))
    out = said.withColumn("_e", F.explode(F.array_compact(F.array(here, gone)))).where("_e.change is not null")
    return out.select(*key, F.col("_e.s").alias(snapshot), F.col("_e.change").alias("change"), F.col("_e.fields").alias("fields"), "revision", F.col("_e.last").alias("last_seen"))


# -- filings ---------------------------------------------------------------------------------------

# Names as the parser gives them: namespace, a brace, local name.
_I = "http://www.xbrl.org/2003/instance}"
_L = "http://www.xbrl.org/2003/linkbase}"
_X = "http://www.w3.org/1999/xlink}"
_D = "http://xbrl.org/2006/xbrldi}"
_NIL = "http://www.w3.org/2001/XMLSchema-instance}nil"
RAW = "kind string, member string, element_index bigint, qname string, ref string, unit string, decimals string, `precision` string, nil string, has_children boolean, has_transform boolean, text string, start string, `end` string, instant string, entity string, dimensions array<struct<axis:string,member:string>>, numerator array<string>, denominator array<string>, role string, parent string, child string, weight string, ord string"
_ARCS = (f"{_L}calculationArc", f"{_L}definitionArc")
_KEPT = (f"{_I}context", f"{_I}unit")


#: Bytes of a member that are parsed at a time, and rows of a batch.
CHUNK, ROWS = 1 << 16, 5000
# An open element, or one of a kept subtree.
_NAME, _ATTRS, _INDEX, _PARENTAL, _TEXT, _CHILDREN = range(6)


def _tag(name: str) -> str:
    return "{" + name if "}" in name else name


def _below(node: list, name: str) -> list:
    return [x for x in node[_CHILDREN] if x[_NAME] == name]


def _arc_rows(link: list, member: str) -> Iterator[tuple]:
    """Calculation and definition arcs of an extended link both of whose labels stand for one locator."""
    hrefs: dict[str, list] = {}
    for e in _below(link, f"{_L}loc"):
        hrefs.setdefault(e[_ATTRS].get(f"{_X}label"), []).append(e[_ATTRS].get(f"{_X}href"))
    for i, arc in enumerate(link[_CHILDREN]):
        said = arc[_ATTRS]
        left, right = (hrefs.get(said.get(f"{_X}{end}"), []) for end in ("from", "to"))
        if arc[_NAME] in _ARCS and len(left) == 1 and len(right) == 1:
            yield ("arc", member, i, said.get(f"{_X}arcrole"), *[None] * 15, link[_ATTRS].get(f"{_X}role"), left[0], right[0], said.get("weight"), said.get("order"))


def _context_row(e: list, member: str, name) -> tuple:
    """The row of a context that has ended; `name` writes a prefixed name out."""
    nodes, said, dimensions = [e], {}, []
    while nodes:
        x = nodes.pop()
        nodes.extend(reversed(x[_CHILDREN]))
        said[x[_NAME]] = x[_TEXT]
        if x[_NAME] == f"{_D}explicitMember":
            dimensions.append({"axis": name(x[_ATTRS].get("dimension")), "member": name(x[_TEXT])})
    return ("context", member, e[_INDEX], None, e[_ATTRS].get("id"), *[None] * 7, said.get(f"{_I}startDate"), said.get(f"{_I}endDate"), said.get(f"{_I}instant"), said.get(f"{_I}identifier"), dimensions, *[None] * 7)


def _unit_row(e: list, member: str, name) -> tuple:
    ratio = _below(e, f"{_I}divide")[:1]
    top = [m for r in ratio for part in _below(r, f"{_I}unitNumerator") for m in _below(part, f"{_I}measure")] if ratio else _below(e, f"{_I}measure")
    low = [m for r in ratio for part in _below(r, f"{_I}unitDenominator") for m in _below(part, f"{_I}measure")]
    return ("unit", member, e[_INDEX], None, e[_ATTRS].get("id"), *[None] * 12, [name(m[_TEXT]) for m in top], [name(m[_TEXT]) for m in low], *[None] * 5)


_NO_MORE = (None,) * 12


def _member_rows(stream, member: str) -> Iterator[list[tuple]]:
    """Rows of one member, in RAW's order, as its elements end, some at a time; an element's index counts all elements that begin before it.

    Only what is open is held: a context or unit, an extended link, or the way down to a fact. Documents that declare types or entities are rejected.
    """
    prefixes: dict[str, list[str]] = {}
    way: list[list] = []
    rows: list[tuple] = []
    kept = linkbase = None
    index = -1

    def name(text: str | None) -> str | None:
        prefix, _, local = (text or "").strip().partition(":")
        return f"{{{prefixes[prefix][-1]}}}{local}" if local and prefixes.get(prefix) else text

    def start(tag: str, attrs: dict) -> None:
        nonlocal index, kept, linkbase
        index += 1
        node = [tag, attrs, index, False, None, []]
        if way:
            way[-1][_PARENTAL] = True
            if kept is not None:
                way[-1][_CHILDREN].append(node)
        else:
            linkbase = tag == f"{_L}linkbase"
        way.append(node)
        if kept is None and (len(way) == 2 if linkbase else tag in _KEPT):
            kept = node

    def end(tag: str) -> None:
        nonlocal kept
        e = way.pop()
        if kept is not None:
            if e is kept:
                kept = None
                if linkbase:
                    rows.extend(_arc_rows(e, member))
                else:
                    rows.append((_context_row if tag == _KEPT[0] else _unit_row)(e, member, name))
        elif not linkbase and "contextRef" in (said := e[_ATTRS]):
            get = said.get
            rows.append(("fact", member, e[_INDEX], _tag(tag), said["contextRef"], get("unitRef"), get("decimals"), get("precision"), get(_NIL), e[_PARENTAL], "scale" in said or "sign" in said or "format" in said, e[_TEXT], *_NO_MORE))

    def data(text: str) -> None:
        top = way[-1]
        if not top[_PARENTAL]:
            top[_TEXT] = text if top[_TEXT] is None else top[_TEXT] + text

    parser, tail = expat.ParserCreate(namespace_separator="}"), b""
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, data
    parser.StartNamespaceDeclHandler = lambda prefix, uri: prefixes.setdefault(prefix or "", []).append(uri or "")
    parser.EndNamespaceDeclHandler = lambda prefix: prefixes[prefix or ""].pop()
    while chunk := stream.read(CHUNK):
        tail = (tail + chunk.replace(b"\0", b"")).upper()
        if b"<!DOCTYPE" in tail or b"<!ENTITY" in tail:
            raise ValueError("xml_rejected")
        tail = tail[-16:]
        parser.Parse(chunk, False)
        if rows:
            yield rows[:]
            rows.clear()
    parser.Parse(b"", True)
    if rows:
        yield rows


def _elements(data: bytes) -> Iterator[list[tuple]]:
    """Raw rows of one archive: facts, contexts, units and arcs, as they stand; no rule is applied here."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for name in sorted(z.namelist()):
            if name.endswith((".xbrl", ".xml")):
                with z.open(name) as member:
                    yield from _member_rows(member, name)


def filing_elements(archives: DataFrame) -> DataFrame:
    """Raw rows of archives(path, content, sha256): path, reason, then RAW; the byte hash is checked first. Stored when called.

    An archive whose bytes don't have the hash (null: not checked), that can't be read, or that declares entities gives
    one row with a reason and no others. Members are parsed once, while they are read; rows leave in batches of some thousand, whatever archives they are
    of. What goes wrong in an archive takes back its rows; where some have left already, it ends with a row that cancels them, and only then are all met with such rows.
    """
    fields = T._parse_datatype_string(RAW)
    arrow = pa.schema([("path", pa.string()), ("reason", pa.string()), ("late", pa.bool_())] + [(f.name, _arrow(f.dataType)) for f in fields])

    def told(data: bytes, sha: str | None) -> Iterator[tuple[str | None, list[tuple]]]:
        none = [(None,) * len(fields)]
        if sha is not None and hashlib.sha256(data).hexdigest() != sha:
            yield "artifact_hash_mismatch", none
            return
        try:
            for rows in _elements(data):
                yield None, rows
        except (zipfile.BadZipFile, zlib.error, EOFError, expat.ExpatError):
            yield "archive_unreadable", none
        except ValueError as why:
            yield str(why), none

    def packed(heads: list, rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((*zip(*heads), *zip(*rows)), arrow)], schema=arrow)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, held = [], []
        for batch in batches:
            for path, content, sha in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                first, left = len(held), False
                for reason, rows in told(content.as_py(), sha):
                    if reason is not None:
                        del heads[first:], held[first:]
                    heads.extend([(path, reason, left and reason is not None)] * len(rows))
                    held.extend(rows)
                    if len(held) >= ROWS:
                        yield packed(heads, held)
                        heads, held, first, left = [], [], 0, True
        if held:
            yield packed(heads, held)

    stored = cut(archives.select("path", "content", "sha256").mapInArrow(of, "path string, reason string, late boolean, " + RAW))
    rows, cancelled = stored.drop("late"), stored.where("late").select("path")
    if cancelled.isEmpty():
        return rows
    return rows.join(cancelled, "path", "left_anti").unionByName(stored.where("late").drop("late"))


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind])
    return pa.int64() if isinstance(kind, T.LongType) else pa.bool_() if isinstance(kind, T.BooleanType) else pa.string()


def structural_profile(elements: DataFrame) -> DataFrame:
    """Per archive: numbers of contexts, units, facts, text blocks, dimensions, duplicates, a hash of the QName set.

    dei: the distinct values of the document's own data; members: files with facts; shared_tags: tags of several contexts.
    """
    fact, context = F.col("kind") == "fact", F.col("kind") == "context"
    per = elements.groupBy("path").agg(
        F.count_if(context).alias("contexts"),
        F.count_if(F.col("kind") == "unit").alias("units"),
        F.count_if(fact).alias("facts"),
        F.count_if(fact & F.col("qname").endswith("TextBlock")).alias("text_blocks"),
        F.count_if(context & F.col("instant").isNotNull()).alias("instants"),
        F.count_if(context & (F.size("dimensions") > 0)).alias("dimensional"),
        F.sha2(F.to_json(F.array_sort(F.collect_set(F.when(fact, F.col("qname"))))), 256).alias("qnames_sha256"),
        F.array_sort(F.collect_set("reason")).alias("failures"),
        F.array_sort(F.collect_set(F.when(fact & F.col("qname").contains("/jpdei/"), F.struct(F.regexp_extract("qname", r"\}(.*)$", 1).alias("name"), "text")))).alias("dei"),
        F.size(F.collect_set(F.when(fact, F.col("member")))).cast("bigint").alias("members"),  # an archive's files, without a second shuffle
    )
    twice = elements.where(fact).groupBy("path", "qname", "ref", "unit").agg((F.count("*") - 1).alias("more")).groupBy("path").agg(F.sum("more").alias("duplicates"))
    spread = elements.where(fact).groupBy("path", "qname").agg(F.count_distinct("ref").alias("refs")).groupBy("path").agg(F.count_if(F.col("refs") > 1).alias("shared_tags"))
    return per.join(twice, "path", "left").join(spread, "path", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("duplicates", "shared_tags")})


#: Comments, whole scripts and styles, declarations and tags, or runs of text, in this order.
HTML_TOKENS = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<[!?/a-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^<]+|<"
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def _unescaped(text: Column) -> Column:
    """Text whose character references, named (of the basic set) or numeric, stand for their characters; others stay."""
    names = F.create_map(*[F.lit(x) for name, point in sorted(name2codepoint.items()) for x in (name, chr(point))])

    def one(part: Column) -> Column:
        name = F.regexp_extract(part, _REFERENCE, 1)
        digits = F.substring(name, 2, 9)
        point = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 9), 16, 10)).otherwise(digits).try_cast("bigint")
        letter = F.when(point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
        found = F.when(name.startswith("#"), letter).when(name != "", F.try_element_at(names, name))
        return F.when(found.isNotNull(), F.concat(found, F.substring(part, F.length(name) + 2, F.length(part)))).otherwise(F.concat(F.lit("&"), part))

    parts = F.split(text, "&", -1)
    told = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), ""))
    return F.when(F.contains(text, F.lit("&")), told).otherwise(text)


def html_text(rows: DataFrame, column: str, name: str = "text") -> DataFrame:
    """rows with the character data of an HTML column, white space taken out; null stays null.

    Scripts and styles count as they stand, comments, declarations and tags not at all. Tokens are found by one pattern and
    judged by built-in functions, so no row leaves the JVM. References must end with a semicolon.
    """
    def data(token: Column) -> Column:
        raw = F.regexp_extract(token, r"(?is)^<(?:script|style)\b[^>]*>(.*?)</(?:script|style)\s*>$", 1)
        return F.when(token.rlike(r"(?i)^<(script|style)\b[^>]*>"), raw).when(token.rlike("(?i)^<[!?/a-z]"), "").otherwise(_unescaped(token))

    tokens = F.regexp_extract_all(column, F.lit(HTML_TOKENS), F.lit(0))
    return rows.withColumn(name, squeezed(F.array_join(F.transform(tokens, data), "")))
