"""Queries of document links, comparisons by kind, evidence, counts, lists and checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import coverage, evidence, identity, lineage, market, reconcile, revisions, sampling, validate
from ..operators.graph import cut, shared_dir
from ..sources import filings, package, store
from .bindings_scalars import KEY, pick
from .tables import DOCS_SQL, documents, table


def document_links(spark, sf_dir):
    """Provider rows of orders against the orders: customer, status and time in the precision that both have."""
    o = table(spark, sf_dir, "orders")
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    docs = o.select(F.col(KEY).alias("doc_id"), F.when(F.col(KEY) % 31 != 0, text).alias("submitted"), F.col("o_custkey").cast("string").alias("entity"), F.col("o_orderstatus").alias("state")).where(F.col(KEY) % 7 != 0)
    said = F.when(F.col(KEY) % 5 == 0, F.substring(text, 1, 10)).when(F.col(KEY) % 5 == 1, F.replace(text, F.lit(" "), F.lit("T"))).when(F.col(KEY) % 5 == 2, "1990-01-01").when(F.col(KEY) % 5 == 3, text)
    rows = o.select(F.col(KEY).alias("row_id"), F.col(KEY).alias("doc_id"), said.alias("submitted"), F.when(F.col(KEY) % 11 == 0, "x").when(F.col(KEY) % 3 != 0, F.col("o_custkey").cast("string")).alias("entity"), F.when(F.col(KEY) % 13 == 0, "").when(F.col(KEY) % 2 == 0, F.col("o_orderstatus")).alias("state"))
    return reconcile.document_link(rows, docs, {"entity": "entity_mismatch", "state": "status_mismatch"}).select("row_id", "missing_reason")


_LINK_SQL = """SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 7 = 0 THEN 'document_id_mismatch' WHEN o_orderkey % 11 = 0 THEN 'entity_mismatch' WHEN o_orderkey % 13 = 0 THEN 'status_mismatch'
 WHEN o_orderkey % 5 <> 4 AND (o_orderkey % 31 = 0 OR o_orderkey % 5 = 2) THEN 'submit_time_mismatch' END AS missing_reason FROM orders"""


def link_grid(spark, sf_dir):
    """Every order and each supplier group as provider: linked by none, one or many lines."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("p"), (F.col("l_suppkey") % 3).cast("string")).alias("provider"))
    docs = table(spark, sf_dir, "orders").select(F.col(KEY).alias("doc_id"))
    return reconcile.link_grid(docs, li.select("provider").distinct(), li)


_LINKS_SQL = """WITH g AS (SELECT o_orderkey AS doc_id, p AS provider FROM orders, (SELECT DISTINCT 'p' || (l_suppkey % 3) AS p FROM lineitem)), c AS (SELECT l_orderkey AS doc_id, 'p' || (l_suppkey % 3) AS provider, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT doc_id, provider, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'linked' ELSE 'ambiguous' END AS state FROM g LEFT JOIN c USING (doc_id, provider)"""


def context_compare(spark, sf_dir):
    """Provider contexts against the originals' by fields, then dimensions."""
    o = table(spark, sf_dir, "orders")

    def dims(a, m):
        return F.array(F.struct(a.alias("axis"), m.alias("member")), F.struct(F.lit("z").alias("axis"), F.lit("1").alias("member")))

    ids = [F.col(KEY).alias("doc_id"), F.col("o_custkey").alias("context_id")]
    contexts = o.where(F.col(KEY) % 9 != 0).select(*ids, F.to_date("o_orderdate").alias("end"), F.col("o_orderstatus").alias("entity"), dims(pick(["scope", "y"], F.col(KEY)), F.lit("m")).alias("dimensions"))
    contexts = contexts.union(contexts.where("doc_id % 8 = 0"))
    rows = o.select(F.col(KEY).alias("row_id"), *ids, F.date_add(F.to_date("o_orderdate"), (F.col(KEY) % 4 == 0).cast("int")).alias("end"), F.col("o_orderstatus").alias("entity"), F.reverse(dims(pick(["scope", "y"], F.col(KEY)), pick(["m", "m", "n"], F.col(KEY)))).alias("dimensions"))
    return reconcile.compare_contexts(rows, contexts, ["end", "entity"], "scope")


_CONTEXT_SQL = "SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 9 = 0 OR o_orderkey % 8 = 0 THEN 'unresolved' WHEN o_orderkey % 4 = 0 THEN 'context_difference' WHEN o_orderkey % 3 = 2 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'scope_difference' ELSE 'context_difference' END ELSE 'exact_match' END AS verdict FROM orders"


def arc_compare(spark, sf_dir):
    """Provider's calculation arcs, exact, and flattened ones, which stay unresolved beside their candidates."""
    o = table(spark, sf_dir, "orders")
    arcs = o.select(F.col(KEY).alias("doc_id"), F.lit("r").alias("role"), F.when(F.col(KEY) % 5 == 0, "other").otherwise(reconcile.SUMMATION).alias("arcrole"), F.concat(F.lit("f.xsd#P"), F.col(KEY).cast("string")).alias("parent"), F.concat(F.lit("f.xsd#C"), F.col("o_custkey").cast("string")).alias("child"), F.lit("1.0").alias("weight"), F.lit("10").alias("ord"), F.col(KEY).cast("string").alias("origin_id"))
    arcs = arcs.union(arcs.where("doc_id % 7 = 0"))
    rows = o.select(F.col(KEY).alias("row_id"), F.col(KEY).alias("doc_id"), F.lit("r").alias("role"), F.concat(F.lit("f.xsd#P"), F.col(KEY).cast("string")).alias("parent"), F.concat(F.lit("f.xsd#C"), F.col("o_custkey").cast("string")).alias("child"), F.when(F.col(KEY) % 3 == 0, "-1").otherwise("1e0").alias("weight"), F.lit("10.00").alias("ord"))
    flat = o.select(F.col(KEY).alias("row_id"), F.col(KEY).alias("doc_id"), F.concat(F.lit("C"), F.substring(F.col("o_custkey").cast("string"), 1, 1)).alias("child_concept"), F.when(F.col(KEY) % 2 == 0, "P").otherwise("Q").alias("parent_concept"))
    a = reconcile.compare_arcs(rows, arcs).select("row_id", "verdict", F.lit("").alias("candidates"))
    return a.union(reconcile.flattened_arcs(flat, arcs).select("row_id", F.concat(F.lit("flat_"), "verdict"), F.array_join("candidates", ",")))


_ARC_SQL = """SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 'unresolved' WHEN o_orderkey % 3 = 0 THEN 'extraction_difference' ELSE 'exact_match' END AS verdict, '' AS candidates FROM orders
UNION ALL SELECT o_orderkey, 'flat_unresolved', CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END FROM orders"""


def coalesced_components(spark, sf_dir):
    """The first tag of a priority list that an order has lines of; all ties stay."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_returnflag").alias("tag"), F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_suppkey")]).alias("row_id"), F.when(F.col("l_suppkey") % 4 != 0, F.lit("1")).alias("value"))
    wanted = table(spark, sf_dir, "orders").select(F.col(KEY).alias("want_id"), F.col(KEY).alias("doc_id"), F.when(F.col(KEY) % 2 == 0, "sales").otherwise("profit").alias("field"))
    tags = spark.createDataFrame([("sales", "R", 1), ("sales", "A", 2), ("sales", "N", 3), ("profit", "N", 1)], "field string, tag string, priority int")
    return reconcile.coalesce_components(wanted, rows, tags).groupBy("want_id", "tag").agg(F.count("*").alias("rows"))


_COALESCE_SQL = """WITH r AS (SELECT l_orderkey AS k, l_returnflag AS t, CASE WHEN l_orderkey % 2 = 0 THEN CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END WHEN l_returnflag = 'N' THEN 1 END AS p FROM lineitem WHERE l_suppkey % 4 <> 0)
SELECT k AS want_id, t AS tag, count(*) AS rows FROM r JOIN orders ON o_orderkey = k WHERE p IS NOT NULL GROUP BY k, t, p QUALIFY p = min(p) OVER (PARTITION BY k)"""


def reverse_rows(spark, sf_dir):
    """Stored rows against a second reading by file and index, and stored facts against a second extraction."""
    o = table(spark, sf_dir, "orders")
    again = validate.row_hashes(o.select(F.col("o_orderstatus").alias("file"), F.col(KEY).alias("index"), "o_custkey"))
    index = F.col("index")
    stored = again.select("file", F.when(index % 37 == 0, -index - 1).otherwise(index).alias("index"), F.when(index % 41 == 0, "x").otherwise(F.col("row_sha256")).alias("row_sha256"))
    rows = reconcile.reverse_lookup(stored, again, ["file", "index"], "row_sha256")
    facts = o.select(F.col(KEY).alias("fact_id"), F.col("o_custkey").cast("string").alias("value"))
    kept = facts.withColumn("value", F.when(F.col("fact_id") % 43 == 0, "?").otherwise(F.col("value")))
    proof = evidence.reverse_facts(kept.union(kept.where("fact_id % 100 = 0")), facts)
    flat = rows.select(F.explode(F.array(F.struct(F.lit("rows_differ").alias("check"), F.col("mismatches").alias("violations")), F.struct(F.lit("rows_missing").alias("check"), F.col("missing").alias("violations")))).alias("x")).select("x.*")
    return flat.union(proof)


_REVERSE_SQL = """SELECT 'rows_differ' AS "check", count(*) FILTER (o_orderkey % 37 <> 0 AND o_orderkey % 41 = 0) AS violations FROM orders UNION ALL SELECT 'rows_missing', count(*) FILTER (o_orderkey % 37 = 0) FROM orders
UNION ALL SELECT 'duplicate_fact_id', count(*) FILTER (o_orderkey % 100 = 0) FROM orders UNION ALL SELECT 'source_reverse_lookup_mismatch', count(*) FILTER (o_orderkey % 43 = 0) FROM orders"""


def identity_evidence(spark, sf_dir):
    """Orders as documents whose filer and code the daily lists (orders again) must bear out."""
    o = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    sha = F.sha2(day, 256)
    docs = o.select(F.col(KEY).alias("doc_id"), F.when(F.col(KEY) % 23 != 0, F.col("o_custkey").cast("string")).alias("entity_id"), F.when(F.col(KEY) % 19 == 0, "x").otherwise("13010").alias("code"), pick(["120", "130", "999", "120"], F.col(KEY)).alias("doc_type"))
    locators = o.where(F.col(KEY) % 13 != 0).select(F.col(KEY).alias("doc_id"), day.alias("file"), F.when(F.col(KEY) % 17 == 0, -F.col(KEY)).otherwise(F.col(KEY)).alias("seq"), day.alias("day"), F.when(F.col(KEY) % 29 == 0, "0").otherwise(sha).alias("sha256"))
    events = o.select(day.alias("file"), F.col(KEY).alias("seq"), day.alias("day"), sha.alias("sha256"), F.col(KEY).alias("doc_id"), F.when(F.col(KEY) % 31 == 0, "z").otherwise(F.col("o_custkey").cast("string")).alias("entity_id"), F.lit("13010").alias("code"), pick(["120", "130", "999", "120"], F.col(KEY)).alias("doc_type"), F.when(F.col(KEY) % 37 == 0, "f").alias("fund_code"), F.lit("").alias("subject_id"), F.lit(None).cast("string").alias("issuer_id"))
    return evidence.identity_evidence(docs, locators, events, ["120", "130"])


_EVIDENCE_SQL = """SELECT doc_id, CAST(CASE WHEN doc_id % 13 = 0 THEN 0 ELSE 1 END AS BIGINT) AS sources, CASE WHEN r IS NULL THEN 'PASS' ELSE 'BLOCKED' END AS status, r AS missing_reason FROM (SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 19 = 0 THEN 'invalid_code' WHEN o_orderkey % 23 = 0 THEN 'edinet_filer_identifier_missing' WHEN o_orderkey % 4 = 2 THEN 'filer_security_role_unsupported' WHEN o_orderkey % 13 = 0 THEN 'edinet_identity_source_missing'
 WHEN o_orderkey % 29 = 0 THEN 'edinet_metadata_integrity_failed' WHEN o_orderkey % 17 = 0 THEN 'edinet_identity_locator_mismatch' WHEN o_orderkey % 31 = 0 THEN 'edinet_identity_mismatch' WHEN o_orderkey % 37 = 0 THEN 'filer_security_role_unsupported' END AS r FROM orders)"""


def identity_candidates(spark, sf_dir):
    """How often a part's code stood on an order line's day: evidence, never an identity."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.to_date("l_shipdate").alias("day"), F.col("l_partkey").alias("code"))
    asked = table(spark, sf_dir, "orders").join(li, F.col("l_orderkey") == F.col(KEY)).groupBy(KEY).agg(F.min(F.struct(F.to_date("l_shipdate").alias("day"), F.col("l_partkey").alias("code"))).alias("x"))
    asked = asked.select(KEY, F.when(F.col(KEY) % 3 == 0, F.date_sub("x.day", 3000)).otherwise(F.col("x.day")).alias("day"), "x.code")
    return identity.identity_candidates(asked, rows, [KEY])


_CANDIDATE_SQL = """WITH c AS (SELECT CAST(l_shipdate AS DATE) AS d, l_partkey AS p, count(*) AS n FROM lineitem GROUP BY ALL), a AS (SELECT l_orderkey AS k, CAST(l_shipdate AS DATE) AS d, l_partkey AS p FROM lineitem JOIN orders ON o_orderkey = l_orderkey QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_shipdate AS DATE), l_partkey) = 1)
SELECT k AS o_orderkey, coalesce(n, 0) AS evidence, 'BLOCKED' AS status, CASE WHEN n IS NULL THEN 'dated_master_missing' ELSE 'identity_not_established_by_code' END AS missing_reason FROM a LEFT JOIN c ON c.p = a.p AND c.d = CASE WHEN k % 3 = 0 THEN a.d - 3000 ELSE a.d END"""


def gap_resolution(spark, sf_dir):
    """Orders without metadata against their lines as lists read again, and their parts' suppliers as local files."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    events = li.where(k % 5 != 0).select(k.alias("doc_id"), F.when(k % 3 == 0, "1999-01-01").otherwise("2000-01-01").alias("day"), F.when((k % 7 == 0) & (F.col("l_linenumber") == 2), "b").otherwise("a").alias("entity_id"), F.lit("1").alias("code"), F.lit("2000-01-01 10:00").alias("submitted"), F.lit("120").alias("doc_type"), F.lit("").alias("period_start"), F.lit("").alias("period_end"), (k % 2 == 0).alias("warned"))
    said = F.when(F.col(KEY) % 23 == 0, "file integrity broken").when(F.col(KEY) % 29 == 0, "member size_limit exceeded")
    codes = F.when(F.col(KEY) % 17 == 0, F.array(F.lit("a"), F.lit("b"))).when(F.col(KEY) % 19 == 0, F.array(F.lit("b"))).otherwise(F.array(F.lit("a")))
    files = o.where(F.col(KEY) % 11 != 0).select(F.col(KEY).alias("doc_id"), said.alias("file_reason"), (F.col(KEY) % 31 == 0).alias("changed"), F.when(F.col(KEY) % 13 == 0, "FAILED").otherwise("PASS").alias("parse_status"), codes.alias("codes"))
    lists = li.select(F.to_date("l_shipdate").alias("day")).distinct().select(F.lit("daily_metadata_not_available").alias("list_reason"))
    return evidence.gap_resolution(o.select(F.col(KEY).alias("doc_id")), events, files.union(files.where("doc_id % 37 = 0")), lists)


_GAP_SQL = """WITH e AS (SELECT l_orderkey AS doc_id, CASE WHEN l_orderkey % 7 = 0 AND l_linenumber = 2 THEN 'b' ELSE 'a' END AS ent, CASE WHEN l_orderkey % 3 = 0 THEN DATE '1999-01-01' ELSE DATE '2000-01-01' END AS day, DATE '2000-01-01' AS submitted, l_orderkey % 2 = 0 AS warned FROM lineitem WHERE l_orderkey % 5 <> 0),
c AS (SELECT doc_id, count(DISTINCT ent) AS claims, min(ent) AS ent, bool_or(day = submitted) AS same_day, bool_or(warned) AS warned FROM e GROUP BY 1),
f0 AS (SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 23 = 0 THEN 'byte_integrity_failed' WHEN o_orderkey % 29 = 0 THEN 'raw_size_limit' WHEN o_orderkey % 31 = 0 THEN 'byte_integrity_failed' END AS broken, o_orderkey % 13 = 0 AS unparsed, CASE WHEN o_orderkey % 17 = 0 THEN ['a', 'b'] WHEN o_orderkey % 19 = 0 THEN ['b'] ELSE ['a'] END AS codes FROM orders WHERE o_orderkey % 11 <> 0),
f AS (SELECT doc_id, count(*) AS files, any_value(broken) AS broken, bool_or(unparsed) AS unparsed, any_value(codes) AS codes FROM (SELECT * FROM f0 UNION ALL SELECT * FROM f0 WHERE doc_id % 37 = 0) GROUP BY 1),
x AS (SELECT o_orderkey AS doc_id, warned, CASE WHEN files IS NULL THEN 'raw_missing' WHEN files > 1 THEN 'identifier_ambiguous' WHEN broken IS NOT NULL THEN broken WHEN claims IS NULL THEN 'daily_metadata_not_available' WHEN claims > 1 THEN 'metadata_identity_ambiguous' WHEN NOT same_day THEN 'daily_date_submit_date_mismatch'
  WHEN unparsed THEN 'original_xml_unverified' WHEN len(codes) <> 1 THEN 'original_identifier_ambiguous_or_missing' WHEN codes[1] <> c.ent THEN 'original_metadata_identifier_mismatch' END AS r FROM orders LEFT JOIN c ON c.doc_id = o_orderkey LEFT JOIN f ON f.doc_id = o_orderkey)
SELECT doc_id, CASE WHEN warned THEN 'daily_file_rejected_by_parent_case_guard' ELSE 'unresolved' END AS history, CASE WHEN r IS NULL THEN 'PASS' ELSE 'BLOCKED' END AS resolution, r AS missing_reason FROM x"""


def overlap_sample(spark, sf_dir):
    """The line that two sources' samples share: the first, else the least common document's first."""
    li = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), F.col("l_orderkey").alias("doc_id"))
    return evidence.overlap_sample(li, table(spark, sf_dir, "orders").where(F.col(KEY) % 50 == 7).select(F.col(KEY).alias("doc_id")))


_OVERLAP_SQL = "SELECT l_orderkey AS doc_id, l_orderkey * 10 + l_linenumber AS line, 'sorted_intersection_doc_id_then_first_line' AS rule FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 50 = 7) ORDER BY 1, 2 LIMIT 1"


def list_tie(spark, sf_dir):
    """Orders on the list of their day; some lists lack them, some days have no list."""
    o = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    events = o.where((F.col(KEY) % 6 != 0) & (F.dayofmonth("o_orderdate") != 13)).select(F.col(KEY).alias("doc_id"), day.alias("day"), F.col(KEY).alias("seq"))
    return evidence.list_tie(o.select(F.col(KEY).alias("doc_id"), day.alias("day")), events.union(events.where("doc_id % 5 = 0")))


_LIST_SQL = """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 6 <> 0 AND day(o_orderdate) <> 13)
SELECT o_orderkey AS doc_id, CAST(CASE WHEN d IS NULL OR o_orderkey % 6 = 0 THEN 0 WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS sequences, CASE WHEN d IS NULL THEN 'local_daily_metadata_not_available' WHEN o_orderkey % 6 = 0 THEN 'local_daily_document_id_not_found' END AS missing_reason FROM orders LEFT JOIN d ON d = CAST(o_orderdate AS DATE)"""


def master_checks(spark, sf_dir):
    """Suppliers as entities, parts as securities, lines as identifier histories."""
    s, p = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")
    entities = s.where("s_suppkey % 9 <> 0").select(F.concat(F.lit("e"), "s_suppkey").alias("entity_id"))
    entities = entities.union(entities.limit(0)).union(s.where("s_suppkey % 10 = 1").select(F.concat(F.lit("e"), "s_suppkey")))
    li = table(spark, sf_dir, "lineitem")
    securities = p.select(F.concat(F.lit("s"), "p_partkey").alias("security_id"), F.concat(F.lit("e"), (F.col("p_partkey") % 20 + 1).cast("string")).alias("issuer_id"))
    history = li.select(F.concat(F.when(F.col("l_linenumber") % 2 == 0, "s").otherwise("e"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey")).otherwise(F.col("l_suppkey")).cast("string")).alias("owner"), F.when(F.col("l_linenumber") % 3 == 0, "entity").when(F.col("l_linenumber") % 2 == 0, "security").otherwise("entity").alias("owner_kind"))
    return identity.master_checks(entities.distinct().union(s.where("s_suppkey % 10 = 1 and s_suppkey % 9 <> 0").select(F.concat(F.lit("e"), "s_suppkey"))), securities, history.distinct())


_MASTER_SQL = """WITH e AS (SELECT DISTINCT 'e' || s_suppkey AS id FROM supplier WHERE s_suppkey % 9 <> 0 OR s_suppkey % 10 = 1), h AS (SELECT DISTINCT CASE WHEN l_linenumber % 2 = 0 THEN 's' || l_partkey ELSE 'e' || l_suppkey END AS o, CASE WHEN l_linenumber % 3 = 0 THEN 'entity' WHEN l_linenumber % 2 = 0 THEN 'security' ELSE 'entity' END AS k FROM lineitem),
o AS (SELECT id, 'entity' AS kind, CASE WHEN CAST(id[2:] AS BIGINT) % 10 = 1 AND CAST(id[2:] AS BIGINT) % 9 <> 0 THEN 2 ELSE 1 END AS n FROM e UNION ALL SELECT 's' || p_partkey, 'security', 1 FROM part)
SELECT 'duplicate_id' AS "check", count(*) AS violations FROM o WHERE n > 1 UNION ALL SELECT 'issuer_missing', count(*) FROM part WHERE 'e' || (p_partkey % 20 + 1) NOT IN (SELECT id FROM e) UNION ALL SELECT 'owner_kind_mismatch', CAST(coalesce(sum(coalesce(n, 1)), 0) AS BIGINT) FROM h LEFT JOIN o ON o.id = h.o WHERE kind IS NULL OR kind <> h.k"""


def source_counts(spark, sf_dir):
    """Samples, sources, ranges, acceptance, statuses and views: one row a figure."""
    o = table(spark, sf_dir, "orders")
    docs = o.select(F.col(KEY).alias("doc_id"), F.col("o_orderpriority").alias("sample_kind"), F.when(F.col(KEY) % 3 != 0, F.col("o_custkey")).alias("entity"), (F.col(KEY) % 2 == 0).alias("integrity"), (F.col(KEY) % 5 == 0).alias("tie"), (F.col(KEY) % 7 == 0).alias("parse"), F.when(F.col(KEY) % 4 == 0, "PASS").otherwise("BLOCKED").alias("status"), F.col("o_orderstatus").alias("source"), (F.col(KEY) % 1000 == 0).alias("data_fetched"), (F.col(KEY) % 2 == 0).alias("schema_profiled"), (F.col(KEY) < 0).alias("original_tied"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.col("o_custkey").alias("key"))

    def long(rows, name, by, *columns):
        pairs = F.array(*[F.struct(F.lit(c).alias("figure"), F.col(c).cast("string").alias("value")) for c in columns])
        return rows.select(F.lit(name).alias("count"), (F.col(by) if by else F.lit("")).alias("of"), F.explode(pairs).alias("x")).select("count", "of", "x.*")

    shared = coverage.shared_originals(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("origin_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_id"), F.col("l_suppkey").alias("source")))
    parts = [
        long(coverage.sample_coverage(docs), "coverage", "sample_kind", "documents", "entities", "integrity_pass", "tie_pass", "parse_pass"),
        long(coverage.join_summary(docs), "joins", "sample_kind", "passed", "rows", "documents", "entities"),
        long(coverage.status_counts(docs), "status", "status", "n"),
        long(coverage.acceptance(docs), "acceptance", "source", "data_fetched", "schema_profiled", "original_tied"),
        long(coverage.observed_ranges(docs, "day", "key"), "ranges", "source", "first", "last", "identifiers"),
        long(coverage.multi_view_counts(shared, 4), "views", None, "seen_by_several", "seen_by_all", "evidence_groups"),
    ]
    return validate.report(parts)


_COUNTS_SQL = """WITH d AS (SELECT o_orderkey AS k, o_orderpriority AS s, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS e, o_custkey AS c, o_orderstatus AS src, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d') AS day FROM orders),
a AS (SELECT s, count(*) AS n, count(DISTINCT e) AS e, count(*) FILTER (k % 2 = 0) AS i, count(*) FILTER (k % 5 = 0) AS t, count(*) FILTER (k % 7 = 0) AS p, count(*) FILTER (k % 4 = 0) AS ok FROM d GROUP BY 1), b AS (SELECT src, min(day) AS lo, max(day) AS hi, count(DISTINCT c) AS n, bool_or(k % 1000 = 0) AS f, bool_or(k % 2 = 0) AS g FROM d GROUP BY 1),
v AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)
SELECT 'coverage' AS count, s AS of, unnest(['documents', 'entities', 'integrity_pass', 'tie_pass', 'parse_pass']) AS figure, CAST(unnest([n, e, i, t, p]) AS VARCHAR) AS value FROM a
UNION ALL SELECT 'joins', s, unnest(['passed', 'rows', 'documents', 'entities']), CAST(unnest([ok, n, n, e]) AS VARCHAR) FROM a
UNION ALL SELECT 'status', CASE WHEN k % 4 = 0 THEN 'PASS' ELSE 'BLOCKED' END, 'n', CAST(count(*) AS VARCHAR) FROM d GROUP BY 2
UNION ALL SELECT 'acceptance', src, unnest(['data_fetched', 'schema_profiled', 'original_tied']), unnest([CASE WHEN f THEN 'PASS' ELSE 'BLOCKED' END, CASE WHEN g THEN 'PASS' ELSE 'BLOCKED' END, 'BLOCKED']) FROM b
UNION ALL SELECT 'ranges', src, unnest(['first', 'last', 'identifiers']), unnest([lo, hi, CAST(n AS VARCHAR)]) FROM b
UNION ALL SELECT 'views', '', unnest(['seen_by_several', 'seen_by_all', 'evidence_groups']), CAST(unnest([count(*) FILTER (n > 1), count(*) FILTER (n = 4), count(*)]) AS VARCHAR) FROM v"""


def source_matrix(spark, sf_dir):
    """Every order and each source's table: lines there, or why none."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit("s"), (F.col("l_suppkey") % 2).cast("string")).alias("source"), F.col("l_linestatus").alias("table"), F.col("l_linenumber").cast("string").alias("row_id"))
    docs = table(spark, sf_dir, "orders").select(F.col(KEY).alias("doc_id"))
    out = coverage.source_matrix(docs, [("s0", "O"), ("s0", "F"), ("s1", "O"), ("s9", "X")], rows)
    return out.withColumn("ids", F.array_join("ids", ","))


_MATRIX_SQL = """WITH g AS (SELECT o_orderkey AS doc_id, s AS source, t AS "table" FROM orders, (VALUES ('s0', 'O'), ('s0', 'F'), ('s1', 'O'), ('s9', 'X')) v(s, t)), c AS (SELECT l_orderkey AS doc_id, 's' || (l_suppkey % 2) AS source, l_linestatus AS "table", count(*) AS n, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS ids FROM lineitem GROUP BY ALL)
SELECT doc_id, source, "table", coalesce(n, 0) AS n, coalesce(ids, '') AS ids, CASE WHEN n IS NULL THEN 'no_provider_row' END AS reason FROM g LEFT JOIN c USING (doc_id, source, "table")"""


def summary_components(spark, sf_dir):
    """Orders' figures from the first tag of a list, of the wanted year and the widest scope that the order has."""
    li = table(spark, sf_dir, "lineitem")
    context = F.concat(F.when(F.col("l_linenumber") % 3 == 0, "Prior1Year").when(F.col("l_linenumber") % 7 == 0, "Prior5Year").otherwise("CurrentYear"), F.lit("Duration"), F.when(F.col("l_suppkey") % 2 == 0, "_NonConsolidatedMember").otherwise(""))
    rows = li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_returnflag").alias("tag"), context.alias("context_id"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("row_id"), F.when(F.col("l_suppkey") % 5 != 0, "1").alias("value"))
    wanted = table(spark, sf_dir, "orders").select(F.col(KEY).alias("want_id"), F.col(KEY).alias("doc_id"), F.lit("sales").alias("field"), (-(F.col(KEY) % 2)).cast("int").alias("year_offset"))
    tags = spark.createDataFrame([("sales", "R", 1), ("sales", "A", 2), ("sales", "N", 3)], "field string, tag string, priority int")
    return reconcile.summary_components(wanted, rows, tags).groupBy("want_id", "tag").agg(F.count("*").alias("rows"))


_SUMMARY_SQL = """WITH r AS (SELECT l_orderkey AS k, l_returnflag AS t, CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END AS y, l_suppkey % 2 <> 0 AS g, l_suppkey % 5 <> 0 AS v, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS p FROM lineitem WHERE l_linenumber % 3 = 0 OR l_linenumber % 7 <> 0),
s AS (SELECT *, bool_or(g) OVER (PARTITION BY k) AS w FROM r), x AS (SELECT * FROM s JOIN orders ON o_orderkey = k WHERE g = w AND v AND y = o_orderkey % 2)
SELECT k AS want_id, t AS tag, count(*) AS rows FROM x GROUP BY k, t, p QUALIFY p = min(p) OVER (PARTITION BY k)"""


def financial_observations(spark, sf_dir):
    """Customers' annual report rows as facts by field, scope and standard, counted."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    kind = pick(["FYFinancialStatements_Consolidated_JP", "FYFinancialStatements_NonConsolidated_IFRS", "1QFinancialStatements_Consolidated_JP", "FYFinancialStatements_Consolidated_IFRS"], k)
    amount = F.when(k % 7 == 0, "").when(k % 11 == 0, "-").otherwise(F.floor("c_acctbal").cast("string"))
    fields = ["Sales", "OP", "NP", "TA", "CFO", "CFI", "EPS", "BPS", "Eq", "ShOutFY"]
    rows = c.select(k, kind.alias("DocType"), F.when(k % 13 == 0, "1Q").otherwise("FY").alias("CurPerType"), F.when(k % 17 == 0, "2025-01-01").otherwise("2023-04-01").alias("CurPerSt"), F.lit("2024-03-31").alias("CurPerEn"), F.lit("2024-05-10").alias("DiscDate"), F.when(k % 19 == 0, "15:00").otherwise("15:00:00").alias("DiscTime"), F.when(k % 3 == 0, "true").otherwise("").alias("RetroRst"), *[amount.alias(f) for f in fields])
    out = market.financial_observations(rows, ["c_custkey"])
    return out.groupBy("field", "metric", "period_kind", "period_class", F.col("period_start").cast("string").alias("period_start"), F.col("instant_date").cast("string").alias("instant_date"), "unit", "scope", "standard", "reason", "restated", F.unix_timestamp("public_at").alias("public_at")).agg(F.count("*").alias("n"), F.sum("value").cast("bigint").alias("total"))


_FINANCIAL_SQL = """WITH c AS (SELECT c_custkey AS k, CAST(floor(c_acctbal) AS BIGINT) AS a, CASE WHEN c_custkey % 4 = 1 THEN 'standalone' ELSE 'consolidated' END AS scope, CASE WHEN c_custkey % 4 = 0 THEN 'JP GAAP' ELSE 'IFRS' END AS standard FROM customer WHERE c_custkey % 4 <> 2 AND c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 19 <> 0),
f AS (SELECT * FROM (VALUES ('Sales', 'd', 'JPY'), ('OP', 'd', 'JPY'), ('NP', 'd', 'JPY'), ('TA', 'i', 'JPY'), ('CFO', 'd', 'JPY'), ('CFI', 'd', 'JPY'), ('EPS', 'd', 'JPY/share'), ('BPS', 'i', 'JPY/share'), ('Eq', 'i', 'JPY'), ('ShOutFY', 'i', 'shares')) v(field, p, unit)),
x AS (SELECT field, CASE field WHEN 'Sales' THEN CASE WHEN standard = 'IFRS' THEN 'revenue_ifrs' ELSE 'revenue_sales' END WHEN 'OP' THEN 'operating_profit' WHEN 'NP' THEN CASE WHEN scope = 'standalone' THEN 'net_profit_total' ELSE 'net_profit_owners' END WHEN 'TA' THEN 'assets_total' WHEN 'EPS' THEN 'eps_basic_reported' WHEN 'ShOutFY' THEN 'shares_issued_gross'
 WHEN 'BPS' THEN CASE WHEN standard = 'IFRS' THEN 'bps_definition_unresolved' ELSE 'bps_net_assets_reported' END WHEN 'Eq' THEN CASE WHEN standard = 'IFRS' THEN 'equity_definition_unresolved' ELSE 'net_assets_total' END ELSE lower(field) END AS metric, p, unit, scope, standard, CASE WHEN k % 7 <> 0 AND k % 11 = 0 THEN 'invalid_market_number' END AS reason, k % 3 = 0 AS restated, CASE WHEN k % 7 <> 0 AND k % 11 <> 0 THEN a END AS v FROM c, f)
SELECT field, metric, CASE p WHEN 'd' THEN 'duration' ELSE 'instant' END AS period_kind, CASE p WHEN 'd' THEN 'annual' ELSE 'instant' END AS period_class, CASE p WHEN 'd' THEN '2023-04-01' END AS period_start, CASE p WHEN 'i' THEN '2024-03-31' END AS instant_date, unit, scope, standard, reason, restated, CAST(epoch(TIMESTAMP '2024-05-10 06:00:00') AS BIGINT) AS public_at, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM x GROUP BY ALL"""


def text_index(spark, sf_dir):
    """The texts that a package leaves out: long ones, and those of the text columns whatever their length."""
    o = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return package.text_index(o, "doc_id", ["text", "lang"], 2000, ["lang"])


_TEXT_SQL = """SELECT doc_id, 'text' AS "column", sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS byte_count FROM documents WHERE strlen(text) > 2000 UNION ALL SELECT doc_id, 'lang', sha256(lang), CAST(strlen(lang) AS BIGINT) FROM documents WHERE lang IS NOT NULL"""


def archive_frame(spark, sf_dir):
    """The tables' own files as archived documents, with the months in which events list them."""
    e = table(spark, sf_dir, "events").select(pick(["orders", "lineitem", "missing"], F.col("event_id")).alias("doc_id"), F.date_format("ts", "yyyy-MM").alias("day"))
    out = filings.archive_frame(spark, sf_dir, e, "parquet").where("doc_id in ('orders', 'lineitem', 'part')")
    return out.select("doc_id", (F.col("size") > 0).alias("there"), F.array_join("days", ",").alias("days"), "listings")


_ARCHIVE_SQL = """WITH e AS (SELECT (['orders', 'lineitem', 'missing'])[event_id % 3 + 1] AS d, strftime(CAST(ts AS TIMESTAMP), '%Y-%m') AS m FROM events), g AS (SELECT d, string_agg(DISTINCT m, ',' ORDER BY m) AS days, count(*) AS n FROM e GROUP BY 1)
SELECT x AS doc_id, true AS there, days, n AS listings FROM (VALUES ('orders'), ('lineitem'), ('part')) v(x) LEFT JOIN g ON g.d = x"""


def screening(spark, sf_dir):
    """Five orders by hash, four of each status, then all by hash: the first thirty."""
    o = table(spark, sf_dir, "orders").select(F.col(KEY).alias("doc_id"), F.array("o_orderstatus").alias("cats"))
    return sampling.screening(o, ["O", "F", "P"], "9", 5, 4, 30).select("doc_id", F.col("place.part").alias("part"))


_SCREENING_SQL = """WITH r AS (SELECT o_orderkey AS k, o_orderstatus AS s, sha256('9:' || o_orderkey) AS h FROM orders), x AS (SELECT k, 0 AS part, h FROM r QUALIFY row_number() OVER (ORDER BY h, k) <= 5
 UNION ALL SELECT k, CASE s WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END, h FROM r QUALIFY row_number() OVER (PARTITION BY s ORDER BY h, k) <= 4 UNION ALL SELECT k, 4, h FROM r)
SELECT k AS doc_id, part FROM (SELECT k, min((part, h)) AS p, min(part) AS part FROM x GROUP BY 1) ORDER BY p, k LIMIT 30"""


def first_rows(spark, sf_dir):
    """Each order's first line."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").cast("int").alias("quantity"))
    return sampling.first_by(li, ["l_orderkey"], ["l_linenumber", "l_suppkey", "quantity"])


_FIRST_SQL = "SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, CAST(l_quantity AS INTEGER)) = 1"


def screening_list(spark, sf_dir):
    """Fixed orders, then each status's first four by hash, then all by hash: the first forty."""
    o = table(spark, sf_dir, "orders")
    ranked = o.select(KEY, "o_orderstatus", sampling.hash_of("7", F.col(KEY)).alias("rank"))
    fixed = ranked.where(F.col(KEY) % 1000 == 1).select(KEY, F.lpad(F.col(KEY).cast("string"), 12, "0").alias("rank"))
    frames = [fixed] + [ranked.where(F.col("o_orderstatus") == s).orderBy("rank", KEY).limit(4).select(KEY, "rank") for s in ("O", "F", "P")] + [ranked.select(KEY, "rank")]
    return sampling.screening_list(frames, KEY, 40).select(KEY, F.col("place.part").alias("part"))


_SCREEN_SQL = """WITH r AS (SELECT o_orderkey, o_orderstatus AS s, sha256('7:' || o_orderkey) AS h FROM orders), x AS (SELECT o_orderkey, 0 AS part, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS h FROM r WHERE o_orderkey % 1000 = 1
 UNION ALL SELECT o_orderkey, CASE s WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END, h FROM r QUALIFY row_number() OVER (PARTITION BY s ORDER BY h, o_orderkey) <= 4 UNION ALL SELECT o_orderkey, 4, h FROM r)
SELECT o_orderkey, part FROM (SELECT o_orderkey, min((part, h)) AS p, min(part) AS part FROM x GROUP BY 1) ORDER BY p, o_orderkey LIMIT 40"""


def page(spark, sf_dir):
    """The second page of orders, with its summary on every row."""
    rows, total = sampling.page(table(spark, sf_dir, "orders").select(KEY, "o_custkey"), [KEY], 100, 100)
    one = total.first()
    return rows.withColumns({c: F.lit(one[c]) for c in ("total", "truncated")})


_PAGE_SQL = "SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders) AS total, (SELECT count(*) > 200 FROM orders) AS truncated FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 100"


def parent_closure(spark, sf_dir):
    """One filing in ten with all its parents."""
    d = documents(spark, sf_dir)
    return revisions.parent_closure(d.where(F.col("doc_id").endswith("3")).select("doc_id"), d.where(~F.col("doc_id").endswith("9")))


_PARENT_SQL = f"""{DOCS_SQL}, d AS (SELECT * FROM docs WHERE doc_id NOT LIKE '%9'), r AS (SELECT doc_id FROM d WHERE doc_id LIKE '%3' UNION SELECT d.parent_id FROM r JOIN d USING (doc_id) WHERE d.parent_id IS NOT NULL) SELECT doc_id, doc_id LIKE '%9' AS missing FROM r"""


def decision_schedule(spark, sf_dir):
    """A decision a microsecond after each filing, unless its time is unknown or past the snapshot."""
    out = revisions.decision_schedule(documents(spark, sf_dir), "1997-01-01")
    return out.select("doc_id", F.unix_micros("decision_at").alias("micros"), "missing_reason")


_SCHEDULE_SQL = f"""{DOCS_SQL} SELECT doc_id, CASE WHEN available_at + INTERVAL 1 MICROSECOND <= TIMESTAMP '1997-01-01' THEN epoch_us(available_at) + 1 END AS micros, CASE WHEN available_at IS NULL THEN 'public_time_unknown' WHEN available_at + INTERVAL 1 MICROSECOND > TIMESTAMP '1997-01-01' THEN 'decision_after_snapshot' END AS missing_reason FROM docs"""


def package_edges(spark, sf_dir):
    """All relations of a package laid out from orders and lines, counted, and required edges that were taken away."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey")
    docs = o.select(F.col(KEY).alias("doc_id"), F.col("o_custkey").alias("entity_id"), F.when(F.col(KEY) % 3 == 0, F.col(KEY) - 1).alias("parent_id"))
    facts = li.select(line.alias("fact_id"), F.col("l_orderkey").alias("doc_id"), F.when(F.col("l_suppkey") % 5 == 0, "derived").otherwise("reported").alias("representation"), F.array(F.col("l_partkey"), F.col("l_suppkey")).alias("input_ids"), F.concat(F.lit("c"), line).alias("candidate_id"))
    securities = o.select(F.col(KEY).alias("mapping_id"), F.col("o_custkey").alias("entity_id"), F.col(KEY).alias("evidence_id"), F.array(F.col(KEY), F.col(KEY) + 1).alias("decision_ids"), F.array(F.col(KEY) + 2).alias("entry_ids"))
    joins = o.select(F.col(KEY).alias("row_id"), F.col(KEY).alias("fact_id"), F.when(F.col(KEY) % 2 == 0, F.col(KEY)).alias("mapping_id"), F.col(KEY).alias("observation_id"), F.col(KEY).alias("evidence_id"), F.array(F.col(KEY), F.col(KEY) + 1).alias("calendar_ids"))
    links = li.select(line.alias("comparison_id"), F.col("l_partkey").alias("source_row_id"), F.array("l_orderkey").alias("origin_ids"), F.array("l_suppkey").alias("fact_ids"), F.array().cast("array<string>").alias("component_ids"))
    observations = o.select(F.col(KEY).alias("observation_id"))
    edges = cut(lineage.package_edges({"documents": docs, "canonical_facts": facts, "securities": securities, "pit_join_rows": joins, "derived_source_links": links, "market_observations": observations, "trading_calendar": observations}))
    counted = edges.groupBy("relation").agg(F.count("*").alias("n"))
    lost = lineage.missing_edges(edges.where("relation in ('reported_in', 'financial')"), edges.where(~F.col("src").endswith("7")))
    return counted.union(lost.groupBy(F.concat(F.lit("missing_"), "relation")).agg(F.count("*")))


_EDGE_SQL = """WITH l AS (SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS id, l_orderkey, l_partkey, l_suppkey FROM lineitem), i AS (SELECT DISTINCT id, l_orderkey, l_suppkey FROM l),
n AS (SELECT 'filer' AS relation, count(*) AS n FROM orders UNION ALL SELECT 'revises', count(*) FROM orders a WHERE o_orderkey % 3 = 0 AND o_orderkey - 1 IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'reported_in', count(*) FROM i
 UNION ALL SELECT 'derived_from', count(*) FROM (SELECT DISTINCT id, unnest([l_partkey, l_suppkey]) AS p FROM l WHERE l_suppkey % 5 = 0)
 UNION ALL SELECT 'original_element', (SELECT count(*) FROM i WHERE l_suppkey % 5 <> 0) + (SELECT count(*) FROM i) UNION ALL SELECT 'dated_entity', count(*) FROM orders UNION ALL SELECT 'filer_code', 2 * count(*) FROM orders UNION ALL SELECT 'decision_identity', 2 * count(*) FROM orders UNION ALL SELECT 'entry_validation_only', count(*) FROM orders
 UNION ALL SELECT 'financial', count(*) FROM orders UNION ALL SELECT 'identity', count(*) FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'prior_market', count(*) FROM orders UNION ALL SELECT 'scheduled_session', 2 * count(*) FROM orders UNION ALL SELECT 'source_row', 2 * count(*) FROM orders
 UNION ALL SELECT 'provider_row', count(*) FROM (SELECT DISTINCT id, l_partkey FROM l) UNION ALL SELECT 'canonical_candidate', count(*) FROM i UNION ALL SELECT 'missing_reported_in', count(*) FROM i WHERE id LIKE '%7' UNION ALL SELECT 'missing_financial', count(*) FROM orders WHERE o_orderkey % 10 = 7)
SELECT relation, CAST(n AS BIGINT) AS n FROM n WHERE n > 0"""


def integrity_checks(spark, sf_dir):
    """PASS rows, facts, fingerprints, manifests, mirrors, comparisons and stages against what they name."""
    o = table(spark, sf_dir, "orders")
    text, at = F.col(KEY).cast("string"), F.col("o_orderdate").cast("timestamp")
    facts = o.where(F.col(KEY) % 101 != 0).select(F.col(KEY).alias("fact_id"), F.col(KEY).alias("doc_id"), F.col("o_custkey").alias("entity_id"), F.col("o_orderstatus").alias("value"), F.when(F.col(KEY) % 103 == 0, F.date_add(F.to_date(at), 9).cast("timestamp")).otherwise(at).alias("available_at"), text.alias("sha256"), F.when(F.col(KEY) % 107 != 0, F.col(KEY)).alias("element_index"))
    mappings = o.select(F.col(KEY).alias("mapping_id"), F.col("o_custkey").alias("entity_id"), F.when(F.col(KEY) % 109 == 0, "x").otherwise("s").alias("security_id"))
    prices = o.select(F.col(KEY).alias("observation_id"), F.lit("c").alias("code"), F.when(F.col(KEY) % 113 == 0, 0).otherwise(1).alias("close"), at.alias("available_at"))
    joins = o.select(F.col(KEY).alias("row_id"), F.when(F.col(KEY) % 2 == 0, "PASS").otherwise("BLOCKED").alias("status"), F.col(KEY).alias("fact_id"), F.col(KEY).alias("mapping_id"), F.col(KEY).alias("observation_id"), F.when(F.col(KEY) % 127 == 0, -F.col(KEY)).otherwise(F.col(KEY)).alias("doc_id"), F.col("o_custkey").alias("entity_id"), F.lit("s").alias("security_id"), F.lit("c").alias("code"), F.col("o_orderstatus").alias("value"), F.lit(1).alias("price"), F.date_add(F.to_date(at), 5).cast("timestamp").alias("decision_at"), (F.col(KEY) % 131 == 0).alias("execution_claim"), F.lit("NOT ESTABLISHED").alias("system_replay"), at.alias("available_at"))
    docs = o.where(F.col(KEY) % 137 != 0).select(F.col(KEY).alias("doc_id"), F.when(F.col(KEY) % 139 == 0, 0).otherwise(F.col("o_custkey")).alias("entity_id"), F.when(F.col(KEY) % 149 == 0, "?").otherwise(text).alias("sha256"))
    files = o.select(text.alias("path"), F.when(F.col(KEY) % 151 == 0, "?").otherwise(text).alias("sha256"))
    refs = o.select(text.alias("path"), text.alias("sha256"))
    links = o.select(F.col(KEY).alias("comparison_id"), F.when(F.col(KEY) % 3 == 0, "PASS").otherwise("BLOCKED").alias("status"), F.col(KEY).alias("row_id"), F.array(F.col(KEY), F.col(KEY) + 1).alias("origin_ids"), F.array(F.col(KEY)).alias("fact_ids"), (F.col(KEY) % 157 == 0).alias("promoted"), (F.col(KEY) % 163 == 0).cast("int").alias("independent_evidence"))
    sizes = o.groupBy("o_orderstatus").agg(F.count("*").alias("rows")).select(F.col("o_orderstatus").alias("name"), "rows", F.lit("h").alias("schema_hash"))
    wrong = sizes.withColumn("rows", F.when(F.col("name") == "P", F.col("rows") + 1).otherwise(F.col("rows"))).where("name <> 'F'")
    stages = o.where(F.col(KEY) % 500 == 1).select(F.col(KEY).alias("stage"), (F.col(KEY) % 1000 == 1).alias("synthetic"), F.when(F.col(KEY) % 1500 == 1, "b").otherwise("a").alias("parent_snapshot_id"), F.lit("h").alias("inherited_sha256"))
    parts = [
        validate.join_integrity(joins, facts, mappings, prices),
        validate.no_future(joins.withColumn("value", F.when(F.col("row_id") % 167 != 0, F.col("value")))),
        validate.locators(facts, docs),
        validate.fingerprints_match(refs, files),
        validate.preserved(refs, files.where(F.col("path") != "1")),
        validate.manifest_matches(sizes, wrong),
        validate.mirrors(links),
        validate.comparison_checks(links, o.where(F.col(KEY) % 9 != 0).select(F.col(KEY).alias("row_id")), o.select(F.col(KEY).alias("origin_id")), o.where(F.col(KEY) % 10 != 0).select(F.col(KEY).alias("fact_id"))),
        validate.stage_consistency(stages, spark.createDataFrame([("a", "h")], "snapshot_id string, sha256 string"), False),
    ]
    return validate.report(parts)


_INTEGRITY_SQL = """WITH j AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 101 = 0 THEN 'required_lineage_edge_missing' WHEN o_orderkey % 127 = 0 THEN 'join_identity_mismatch' WHEN o_orderkey % 113 = 0 THEN 'join_value_mismatch' WHEN o_orderkey % 109 = 0 THEN 'join_mapping_mismatch' WHEN o_orderkey % 103 = 0 THEN 'future_information_leakage' WHEN o_orderkey % 131 = 0 THEN 'evidence_promotion' END AS r FROM orders WHERE o_orderkey % 2 = 0),
k AS (SELECT o_orderkey AS k FROM orders)
SELECT r AS "check", count(*) AS violations FROM j WHERE r IS NOT NULL GROUP BY 1
UNION ALL SELECT 'pass_without_future', count(*) FROM k WHERE k % 2 = 0 AND (k % 167 = 0 OR k % 131 = 0)
UNION ALL SELECT 'fact_locator', count(*) FROM k JOIN orders ON o_orderkey = k WHERE k % 101 <> 0 AND (k % 137 = 0 OR (k % 139 = 0 AND o_custkey <> 0) OR k % 149 = 0 OR k % 107 = 0)
UNION ALL SELECT 'source_fingerprint', count(*) FROM k WHERE k % 151 = 0
UNION ALL SELECT 'preservation', count(*) FROM k WHERE k % 151 = 0 OR k = 1
UNION ALL SELECT 'manifest', count(*) FROM (SELECT o_orderstatus AS s FROM orders GROUP BY 1) WHERE s IN ('P', 'F')
UNION ALL SELECT 'mirror_promoted', count(*) FROM k WHERE k % 163 = 0
UNION ALL SELECT 'unverified_source_admitted', count(*) FROM k WHERE k % 9 = 0
UNION ALL SELECT 'orphan_original_lineage', count(*) FROM k WHERE k + 1 NOT IN (SELECT k FROM k)
UNION ALL SELECT 'orphan_canonical_lineage', count(*) FROM k WHERE k % 10 = 0
UNION ALL SELECT 'mirror_promoted', count(*) FROM k WHERE k % 157 = 0 OR k % 163 = 0
UNION ALL SELECT 'synthetic_mode_mismatch', count(*) FROM k WHERE k % 1000 = 1
UNION ALL SELECT 'parent_snapshot_mismatch', count(*) FROM k WHERE k % 1500 = 1
UNION ALL SELECT 'input_evidence_mismatch', count(*) FROM k WHERE k % 500 = 1 AND k < 0"""


def bulk_tie(spark, sf_dir):
    """Files against a listing with one entry of their key and size."""
    o = table(spark, sf_dir, "orders")
    files = o.select(F.col(KEY).cast("string").alias("file"), F.col(KEY).alias("key"), F.col("o_custkey").alias("size"))
    listing = o.where(F.col(KEY) % 7 != 0).select(F.col(KEY).alias("key"), (F.col("o_custkey") + (F.col(KEY) % 5 == 0).cast("int")).alias("size"))
    return market.bulk_tie(files, listing.union(listing.where("key % 11 = 0"))).select("file", "missing_reason")


_BULK_SQL = "SELECT CAST(o_orderkey AS VARCHAR) AS file, CASE WHEN o_orderkey % 7 = 0 THEN 'bulk_entry_missing' WHEN o_orderkey % 11 = 0 THEN 'bulk_entry_ambiguous' WHEN o_orderkey % 5 = 0 THEN 'bulk_size_mismatch' END AS missing_reason FROM orders"


def file_selection(spark, sf_dir):
    """Files of months that a window overlaps, the calendar's always, and the lines that codes and windows keep."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    windows = o.where(F.col(KEY) % 997 == 0).select(F.to_date("o_orderdate").alias("first_day"), F.date_add(F.to_date("o_orderdate"), 20).alias("last_day"))
    month = F.trunc("l_shipdate", "month")
    manifest = li.select(month.alias("first"), F.last_day(month).alias("last")).distinct().select(F.lit("equities_bars_daily").alias("dataset"), F.lit("r1").alias("revision"), F.col("first").cast("string").alias("file"), "first", "last")
    manifest = manifest.union(manifest.select(F.lit("markets_calendar"), F.lit("r1"), F.concat(F.lit("c"), "file"), "first", "last"))
    files = market.overlapping(manifest, windows).select("file", F.lit(0).cast("bigint").alias("rows"))
    asked = li.where("l_orderkey % 100 = 0").groupBy("l_partkey").agg(F.min(F.to_date("l_shipdate")).alias("first_day"))
    asked = asked.select(F.col("l_partkey").alias("code"), "first_day", F.date_add("first_day", 200).alias("last_day"))
    rows = li.select(F.col("l_partkey").alias("code"), F.to_date("l_shipdate").alias("day"))
    kept = market.retained(rows, asked.select("code"), asked).groupBy(F.col("code").cast("string").alias("file")).agg(F.count("*").alias("rows"))
    return files.union(kept)


_SELECTION_SQL = """WITH w AS (SELECT CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + 20 AS b FROM orders WHERE o_orderkey % 997 = 0), m AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS a, last_day(CAST(l_shipdate AS DATE)) AS b FROM lineitem),
q AS (SELECT l_partkey AS p, min(CAST(l_shipdate AS DATE)) AS a FROM lineitem WHERE l_orderkey % 100 = 0 GROUP BY 1)
SELECT CAST(m.a AS VARCHAR) AS file, CAST(0 AS BIGINT) AS rows FROM m WHERE EXISTS (SELECT 1 FROM w WHERE m.a <= w.b AND w.a <= m.b) UNION ALL SELECT 'c' || m.a, 0 FROM m
UNION ALL SELECT CAST(p AS VARCHAR), count(*) FROM lineitem JOIN q ON p = l_partkey AND CAST(l_shipdate AS DATE) BETWEEN a AND a + 200 GROUP BY p"""


def market_store(spark, sf_dir):
    """Lines as daily market rows, written to a store by day and read by windows of orders of a status, for parts of some kinds, with the calendar's days."""
    li, o, path = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), f"{shared_dir(spark)}/store-{uuid.uuid4().hex}"
    rows = li.select(F.to_date("l_shipdate").alias("day"), F.col("l_partkey").alias("code"), F.col("l_quantity").cast("bigint").alias("volume"), "l_linestatus")
    store.write_revision(rows.where("code % 2 = 0"), path, "equities_bars_daily", "r1")
    store.write_revision(rows, path, "equities_bars_daily", "r2")
    store.write_revision(o.select(F.to_date("o_orderdate").alias("day"), F.lit(None).cast("bigint").alias("code")).distinct(), path, market.CALENDAR, "r1")
    windows = o.where("o_orderstatus = 'P'").select(F.date_add(F.to_date("o_orderdate"), 5).alias("first_day"), F.date_add(F.to_date("o_orderdate"), 9 - (F.col(KEY) % 8).cast("int")).alias("last_day"))
    codes = table(spark, sf_dir, "part").where("p_size <= 25").select(F.col("p_partkey").alias("code"))
    kept = store.read_days(spark, path, "equities_bars_daily", windows, codes)
    out = kept.groupBy("day").agg(F.count("*").alias("rows"), F.sum("volume").alias("volume"), F.count_distinct("code").alias("codes"))
    calendar = store.read_days(spark, path, market.CALENDAR, windows).groupBy("day").agg(F.count("*").alias("rows"), F.lit(None).cast("bigint").alias("volume"), F.lit(0).cast("bigint").alias("codes"))
    return out.union(calendar).withColumn("day", F.col("day").cast("string"))


_STORE_SQL = """WITH w AS (SELECT CAST(o_orderdate AS DATE) + 5 AS a, CAST(o_orderdate AS DATE) + CAST(9 - o_orderkey % 8 AS INTEGER) AS b FROM orders WHERE o_orderstatus = 'P'), d AS (SELECT DISTINCT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM w WHERE a <= b)
SELECT CAST(day AS VARCHAR) AS day, count(*) AS rows, CAST(sum(l_quantity) AS BIGINT) AS volume, count(DISTINCT l_partkey) AS codes FROM lineitem JOIN d ON d.day = CAST(l_shipdate AS DATE) WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25) GROUP BY 1
UNION ALL SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, NULL, 0 FROM orders"""


def parquet_by_ids(spark, sf_dir):
    """Orders of scattered ids, with the places that Parquet gives them."""
    ids = table(spark, sf_dir, "customer").where("c_custkey % 10 = 3").select(F.col("c_custkey").cast("bigint").alias("id"))
    rows = filings.parquet_by_ids(spark, f"{sf_dir}/orders.parquet", "o_orderkey", ids)
    return rows.select(KEY, F.col("o_custkey"), F.regexp_extract("file", r"([^/]+?)(/part[^/]*)?$", 1).alias("file"), (F.col("row_index") >= 0).alias("placed"))


_BY_IDS_SQL = "SELECT o_orderkey, o_custkey, 'orders.parquet' AS file, true AS placed FROM orders WHERE o_orderkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 = 3)"


def ledgers(spark, sf_dir):
    """Failure ledgers of three stages as one: columns that a stage lacks are null."""
    o = table(spark, sf_dir, "orders")
    parts = {"p2": o.where(F.col(KEY) % 7 == 0).select(F.col(KEY).alias("doc_id"), F.lit("raw_missing").alias("reason")), "p3": o.where(F.col(KEY) % 11 == 0).select(F.col(KEY).alias("doc_id"), F.col(KEY).alias("fact_id"), F.lit("reported_nil").alias("reason")), "p4": o.where(F.col(KEY) % 13 == 0).select(F.col(KEY).alias("fact_id"), F.lit("price_missing").alias("reason"))}
    return package.failure_ledger(parts).groupBy("stage", "reason").agg(F.count("*").alias("n"), F.count("doc_id").alias("documents"), F.count("fact_id").alias("facts"))


_LEDGER_SQL = "SELECT 'p2' AS stage, 'raw_missing' AS reason, count(*) AS n, count(*) AS documents, CAST(0 AS BIGINT) AS facts FROM orders WHERE o_orderkey % 7 = 0 UNION ALL SELECT 'p3', 'reported_nil', count(*), count(*), count(*) FROM orders WHERE o_orderkey % 11 = 0 UNION ALL SELECT 'p4', 'price_missing', count(*), 0, count(*) FROM orders WHERE o_orderkey % 13 = 0"

_PARTS = {
    document_links: _LINK_SQL, link_grid: _LINKS_SQL, context_compare: _CONTEXT_SQL, arc_compare: _ARC_SQL, coalesced_components: _COALESCE_SQL, reverse_rows: _REVERSE_SQL, identity_evidence: _EVIDENCE_SQL, identity_candidates: _CANDIDATE_SQL, gap_resolution: _GAP_SQL, overlap_sample: _OVERLAP_SQL,
    list_tie: _LIST_SQL, master_checks: _MASTER_SQL, source_counts: _COUNTS_SQL, source_matrix: _MATRIX_SQL, first_rows: _FIRST_SQL, screening_list: _SCREEN_SQL, page: _PAGE_SQL, parent_closure: _PARENT_SQL, decision_schedule: _SCHEDULE_SQL, package_edges: _EDGE_SQL, integrity_checks: _INTEGRITY_SQL,
    summary_components: _SUMMARY_SQL, financial_observations: _FINANCIAL_SQL, text_index: _TEXT_SQL, archive_frame: _ARCHIVE_SQL, screening: _SCREENING_SQL, bulk_tie: _BULK_SQL, file_selection: _SELECTION_SQL, market_store: _STORE_SQL, parquet_by_ids: _BY_IDS_SQL, ledgers: _LEDGER_SQL,
}
QUERIES = {f.__name__: f for f in _PARTS}
ORACLES = {f.__name__: sql for f, sql in _PARTS.items()}
