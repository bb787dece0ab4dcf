"""Queries of samples, grids, comparisons with originals, packaging and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import api
from ..functions import contracts
from ..operators import coverage, market, reconcile, sampling, validate
from ..sources import filings, package
from .tables import table

SEED = "20260918"


def hash_sample(spark, sf_dir):
    """The fifteen documents first by a seeded hash."""
    return sampling.hash_ranked(table(spark, sf_dir, "documents"), "doc_id", SEED, 15)


_HASH_SQL = f"SELECT doc_id, sha256('{SEED}:' || doc_id) AS hash FROM documents ORDER BY hash, doc_id LIMIT 15"


def challenge_sample(spark, sf_dir):
    """A probability sample and a disjoint challenge sample that covers the categories in order."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("entity"), F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_totalprice"))
    cats = F.array_compact(F.array(F.concat(F.lit("status_"), "o_orderstatus"), F.concat(F.lit("priority_"), F.substring("o_orderpriority", 1, 1)), F.when(F.col("doc_id") % 97 == 0, "overlap"), F.when(F.col("doc_id") % 5003 == 0, "rare")))
    names = ["status_O", "status_F", "status_P", "priority_1", "priority_2", "priority_5", "rare", "overlap", "nowhere"]
    first, chosen, _ = sampling.challenge_sample(rows.select("doc_id", "entity", cats.alias("cats")), names, SEED, 15, 20, "overlap")
    out = [("probability", i, d, "hash_rank") for i, d in enumerate(first)] + [("challenge", i, d, ",".join(why)) for i, (d, why) in enumerate(chosen)]
    return spark.createDataFrame(out, "sample string, place int, doc_id bigint, reasons string")


def canonical_events(spark, sf_dir):
    """Each user's event of a stated day, else the first."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").alias("doc_id"), F.to_date("ts").alias("day"), F.col("event_id").alias("seq"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("user_id") % 28).cast("int")).alias("submit_day"), "event_type")
    return sampling.canonical_event(rows).select("doc_id", "seq", "event_type")


_CANONICAL_SQL = """SELECT user_id AS doc_id, event_id AS seq, event_type FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN day = DATE '2024-01-01' + CAST(user_id % 28 AS INTEGER) THEN 0 ELSE 1 END, day, event_id) = 1"""


def snapshot_diff(spark, sf_dir):
    """What changed for users and event types between two weeks."""
    e = table(spark, sf_dir, "events").withColumn("week", F.when(F.to_date("ts") < F.lit("2024-01-08").cast("date"), 1).when(F.to_date("ts") < F.lit("2024-01-15").cast("date"), 2))
    per = e.where("week is not null").groupBy("week", "user_id", "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last"))
    a, b = (per.where(F.col("week") == w).drop("week").withColumn("last", F.col("last") % 2) for w in (1, 2))
    out = filings.snapshot_diff(a, b, ["user_id", "event_type"], ["n", "last"], 4)
    return out.withColumns({"fields": F.array_join("fields", ","), "revision": F.col("revision").cast("bigint")})


_DIFF_SQL = """WITH e AS (SELECT CASE WHEN CAST(ts AS DATE) < DATE '2024-01-08' THEN 1 WHEN CAST(ts AS DATE) < DATE '2024-01-15' THEN 2 END AS w, user_id, event_type, count(*) AS n, max(event_id) % 2 AS last FROM events GROUP BY ALL),
j AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_type, b.event_type) AS event_type, CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'absent' WHEN a.n <> b.n OR a.last <> b.last THEN 'changed' END AS change,
  CASE WHEN a.n IS NULL THEN 'last,n' ELSE concat_ws(',', CASE WHEN a.last <> b.last THEN 'last' END, CASE WHEN a.n <> b.n THEN 'n' END) END AS fields FROM (SELECT * FROM e WHERE w = 1) a FULL JOIN (SELECT * FROM e WHERE w = 2) b ON a.user_id = b.user_id AND a.event_type = b.event_type)
SELECT user_id, event_type, change, fields, CASE WHEN change = 'absent' THEN 'not_inferred_withdrawn' END AS reason, CAST(5 AS BIGINT) AS revision FROM j WHERE change IS NOT NULL"""


def coverage_grid(spark, sf_dir):
    """Every source and quality family with its labelled documents, or why there are none."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id").select("source", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor").alias("family"), F.col("n_chars"))
    return coverage.grid(docs, ["toxic", "good", "poor", "unseen"], "source", "family", rows, F.col("n_chars") > 500)


_GRID_SQL = """WITH r AS (SELECT source, CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE 'poor' END AS family, n_chars FROM documents JOIN labels USING (doc_id)),
g AS (SELECT DISTINCT source, f.family FROM documents, (VALUES ('toxic'), ('good'), ('poor'), ('unseen')) f(family)),
n AS (SELECT source, family, count(*) AS c, count(*) FILTER (n_chars > 500) AS k FROM r GROUP BY ALL)
SELECT source, family, coalesce(c, 0) AS candidates, coalesce(k, 0) AS non_null, CASE WHEN coalesce(c, 0) = 0 THEN 'no_candidate' WHEN k = 0 THEN 'all_candidates_blocked' END AS reason FROM g LEFT JOIN n USING (source, family)"""


def bias_summary(spark, sf_dir):
    """Missing orders before and after a rule, by year, status and priority in one pass."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rows = o.select(k, F.year("o_orderdate").alias("year"), F.when(k % 9 != 0, F.col("o_orderstatus")).alias("status"), F.col("o_orderpriority").alias("priority"))
    return coverage.bias_summary(rows, ["year", "status", "priority"], k % 4 == 0, k % 8 == 0)


_BIAS_SQL = """WITH r AS (SELECT o_orderkey AS k, CAST(year(o_orderdate) AS VARCHAR) AS y, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus ELSE 'unknown' END AS s, o_orderpriority AS p FROM orders),
l AS (SELECT 'year' AS attribute, y AS value, k FROM r UNION ALL SELECT 'status', s, k FROM r UNION ALL SELECT 'priority', p, k FROM r)
SELECT attribute, value, count(*) AS n, count(*) FILTER (k % 4 = 0) AS missing_before, count(*) FILTER (k % 8 = 0) AS missing_after FROM l GROUP BY ALL"""


def _provider(spark, sf_dir):
    """Order lines as originals, and a provider's copy of them with some values, units and keys altered."""
    li, s = table(spark, sf_dir, "lineitem"), F.col("l_suppkey")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"))
    o = li.select(F.concat_ws("-", key, F.col("l_linenumber").cast("string")).alias("origin_id"), key.alias("tag"), F.col("l_linenumber").cast("string").alias("context"), F.col("l_linestatus").alias("unit"), F.when(s % 19 != 0, F.col("l_quantity").cast("int").cast("string")).alias("value"), (s % 19 == 0).alias("is_nil"))
    rows = li.select(F.concat_ws("-", key, F.col("l_linenumber").cast("string"), s.cast("string")).alias("row_id"), F.when(s % 23 == 0, F.concat(key, F.lit("x"))).otherwise(key).alias("tag"), F.when(s % 29 == 0, "99").otherwise(F.col("l_linenumber").cast("string")).alias("context"), F.when(s % 31 == 0, "?").otherwise(F.col("l_linestatus")).alias("unit"), F.when(s % 19 != 0, F.concat((F.col("l_quantity").cast("int") + F.when(s % 7 == 0, 1).otherwise(0)).cast("string"), F.lit(".0"))).alias("value"), F.concat(F.lit("p"), (s % 3).cast("string")).alias("source"))
    return rows, o


def _compared(spark, sf_dir):
    rows, originals = _provider(spark, sf_dir)
    return reconcile.compare_facts(rows.dropDuplicates(["row_id"]), originals, [("tag", "extraction_difference", "original_element_not_found"), ("context", "context_difference", "original_context_not_matched")])


def provider_compare(spark, sf_dir):
    """A provider's rows against originals: element, context, unit, value."""
    return _compared(spark, sf_dir).select("row_id", "verdict", "reason", F.array_join("origins", ",").alias("origins"))


_COMPARED = """o AS (SELECT l_orderkey || '-' || l_partkey AS tag, CAST(l_linenumber AS VARCHAR) AS cx, l_linestatus AS u, CAST(l_quantity AS INTEGER) AS q, l_suppkey % 19 = 0 AS nil, l_orderkey || '-' || l_partkey || '-' || l_linenumber AS id FROM lineitem),
p AS (SELECT row_id, any_value(tag) AS tag, any_value(cx) AS cx, any_value(u) AS u, any_value(q) AS q, any_value(nil) AS nil, any_value(source) AS source FROM (SELECT l_orderkey || '-' || l_partkey || '-' || l_linenumber || '-' || l_suppkey AS row_id, l_orderkey || '-' || l_partkey || CASE WHEN l_suppkey % 23 = 0 THEN 'x' ELSE '' END AS tag, CASE WHEN l_suppkey % 29 = 0 THEN '99' ELSE CAST(l_linenumber AS VARCHAR) END AS cx,
  CASE WHEN l_suppkey % 31 = 0 THEN '?' ELSE l_linestatus END AS u, CAST(l_quantity AS INTEGER) + CASE WHEN l_suppkey % 7 = 0 THEN 1 ELSE 0 END AS q, l_suppkey % 19 = 0 AS nil, 'p' || (l_suppkey % 3) AS source FROM lineitem) GROUP BY row_id),
g AS (SELECT row_id, count(o.id) AS n0, count(o.id) FILTER (o.cx = p.cx) AS n1, coalesce(array_to_string(list_sort(list_distinct(list(o.id) FILTER (o.cx = p.cx))), ','), '') AS origins, any_value(p.u) AS u, any_value(p.q) AS q, any_value(p.nil) AS nil, min(o.u) FILTER (o.cx = p.cx) AS ou, min(o.q) FILTER (o.cx = p.cx) AS oq, bool_or(o.nil) FILTER (o.cx = p.cx) AS onil, any_value(source) AS source FROM p LEFT JOIN o ON o.tag = p.tag GROUP BY 1),
v AS (SELECT row_id, source, origins, CASE WHEN n0 = 0 THEN 'original_element_not_found' WHEN n1 = 0 THEN 'original_context_not_matched' WHEN n1 > 1 THEN 'original_element_ambiguous' WHEN u <> ou THEN 'unit_ref_differs' WHEN onil AND NOT nil THEN 'nil_value_differs' WHEN NOT onil AND (nil OR q <> oq) THEN 'provider_value_differs' END AS reason FROM g)"""
_COMPARE_SQL = f"""WITH {_COMPARED} SELECT row_id, CASE reason WHEN 'original_element_not_found' THEN 'extraction_difference' WHEN 'original_context_not_matched' THEN 'context_difference' WHEN 'original_element_ambiguous' THEN 'unresolved' WHEN 'unit_ref_differs' THEN 'unit_difference' ELSE CASE WHEN reason IS NULL THEN 'exact_match' ELSE 'extraction_difference' END END AS verdict, reason, origins FROM v"""


def reason_counts(spark, sf_dir):
    """How often each reason stops a comparison."""
    rows = _compared(spark, sf_dir).where("reason is not null").select(F.array("reason").alias("reasons"))
    return coverage.reason_counts(rows, "reasons")


def shared_views(spark, sf_dir):
    """Originals by how many provider views and sources they have: one original is one piece of evidence."""
    rows = _compared(spark, sf_dir).select("row_id", F.explode("origins").alias("origin_id"))
    source = _provider(spark, sf_dir)[0].select("row_id", "source").distinct()
    shared = coverage.shared_originals(rows.join(source, "row_id"))
    return shared.select("origin_id", F.size("views").cast("bigint").alias("views"), "sources", F.col("evidence").cast("bigint").alias("evidence"))


_SHARED_SQL = f"WITH {_COMPARED}, x AS (SELECT row_id, source, unnest(string_split(origins, ',')) AS origin_id FROM v WHERE origins <> '') SELECT origin_id, count(DISTINCT row_id) AS views, count(DISTINCT source) AS sources, CAST(1 AS BIGINT) AS evidence FROM x GROUP BY 1"


def text_tie(spark, sf_dir):
    """Documents whose text, without white space, other documents of their language have too."""
    docs = table(spark, sf_dir, "documents")
    tied = reconcile.text_tie(docs.select(F.col("doc_id").alias("row_id"), "lang", "text"), docs.select(F.col("doc_id").alias("origin_id"), "lang", "text"), ["lang"])
    return tied.select("row_id", "n", "first")


_TIE_SQL = r"""WITH d AS (SELECT doc_id, lang, regexp_replace(text, '[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', '', 'g') AS s FROM documents)
SELECT doc_id AS row_id, count(*) OVER (PARTITION BY lang, s) AS n, min(doc_id) OVER (PARTITION BY lang, s) AS first FROM d WHERE s <> ''"""


def page_text(spark, sf_dir):
    """The character data of every page, by size and hash."""
    pages = filings.html_text(table(spark, sf_dir, "pages").select("page_id", "html"), "html")
    return pages.select("page_id", F.length("text").cast("bigint").alias("chars"), F.sha2("text", 256).alias("text_sha256"))


_PAGE_TEXT_SQL = r"""WITH t AS (SELECT page_id, regexp_extract_all(html, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<[!?/a-z](?:[^>"'']|"[^"]*"|''[^'']*'')*>|[^<]+|<') AS x FROM pages WHERE html IS NOT NULL),
d AS (SELECT page_id, array_to_string(list_transform(x, lambda y: CASE WHEN regexp_matches(y, '(?i)^<(script|style)\b[^>]*>') THEN regexp_extract(y, '(?is)^<(?:script|style)\b[^>]*>(.*?)</(?:script|style)\s*>$', 1) WHEN regexp_matches(y, '(?i)^<[!?/a-z]') THEN ''
  ELSE replace(replace(replace(replace(replace(replace(replace(y, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&amp;', '&') END), '') AS s FROM t),
e AS (SELECT page_id, regexp_replace(s, '[\s\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', '', 'g') AS s FROM d)
SELECT page_id, CAST(length(s) AS BIGINT) AS chars, sha256(s) AS text_sha256 FROM pages LEFT JOIN e USING (page_id)"""


def pk_violations(spark, sf_dir):
    """Order lines are no key; orders are one."""
    checks = [validate.primary_key(table(spark, sf_dir, t), k).withColumn("check", F.lit(t)) for t, k in (("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey"]), ("customer", ["c_custkey"]))]
    return validate.report(checks)


_PK_SQL = """SELECT 'lineitem' AS "check", count(*) AS violations FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'orders', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1) UNION ALL SELECT 'customer', count(*) FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)"""


def required_edges(spark, sf_dir):
    """Orders of customers that don't exist, lines without order, and lines without a part of the first half."""
    o, li, p = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
    return validate.report([validate.references(o, "o_custkey", table(spark, sf_dir, "customer"), "c_custkey"), validate.references(li, "l_orderkey", o, "o_orderkey"), validate.references(li, "l_partkey", p.where(F.col("p_size") < 25), "p_partkey")])


_REQUIRED_SQL = """SELECT 'orphan_o_custkey' AS "check", count(*) AS violations FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'orphan_l_orderkey', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'orphan_l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)"""


def column_profile(spark, sf_dir):
    """The types seen in every property of the events."""
    return package.column_profile(table(spark, sf_dir, "events"), "props").select("key", F.array_join("types", ",").alias("types"), "n")


_COLUMN_SQL = """SELECT key, string_agg(DISTINCT CASE WHEN t IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' WHEN t = 'VARCHAR' THEN 'STRING' ELSE t END, ',' ORDER BY CASE WHEN t IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' WHEN t = 'VARCHAR' THEN 'STRING' ELSE t END) AS types, count(*) AS n
FROM (SELECT key, json_type(props, '$.' || key) AS t FROM (SELECT props, unnest(json_keys(props)) AS key FROM events)) GROUP BY 1"""


def duplicate_candidates(spark, sf_dir):
    return coverage.duplicate_candidates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_DUPLICATE_SQL = "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"


def pack_roundtrip(spark, sf_dir):
    """Suppliers packed and unpacked: rows whose columns and payload disagree."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    packed = package.pack(s, ["s_suppkey", "s_name"]).withColumn("s_name", F.when(F.col("s_suppkey").cast("bigint") % 7 == 0, "?").otherwise(F.col("s_name")))
    s = s.withColumn("s_nationkey", F.when(F.col("s_suppkey") % 11 == 0, -1).otherwise(F.col("s_nationkey")).cast("int"))
    back = package.unpack(packed, "s_suppkey bigint, s_name string, s_nationkey int")
    return validate.report([validate.projected(packed, ["s_suppkey", "s_name"]), validate.same_rows(s, back)])


_PACK_SQL = """SELECT 'projected_columns' AS "check", count(*) AS violations FROM supplier WHERE s_suppkey % 7 = 0 UNION ALL SELECT 'frame_equality', 2 * count(*) FROM supplier WHERE s_suppkey % 11 = 0 AND s_nationkey <> -1"""


def formula_guard(spark, sf_dir):
    """Names and signs as cells that no spreadsheet runs."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    cell = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("=", "+", "-", "@", "", "+a", "-1.")]), (k % 7 + 1).cast("int")), k.cast("string"))
    return o.select(k, contracts.formula_guard(cell).alias("cell"))


_FORMULA_SQL = r"""WITH c AS (SELECT o_orderkey, ['=', '+', '-', '@', '', '+a', '-1.'][o_orderkey % 7 + 1] || o_orderkey AS cell FROM orders)
SELECT o_orderkey, CASE WHEN regexp_matches(cell, '^[=+@\-]') AND NOT regexp_matches(cell, '^[+-]?\d+(\.\d+)?$') THEN '''' || cell ELSE cell END AS cell FROM c"""


def _members(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return package.entity_members(c.select(F.col("c_nationkey").cast("string").alias("entity_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("code"), F.col("c_custkey").cast("string").alias("doc_id")))


def company_search(spark, sf_dir):
    """Companies whose name holds a text in any case."""
    found = api.company(_members(spark, sf_dir), name="CUSTOMER#00000001")
    codes = F.array_join(F.array_sort(F.collect_set(F.when(F.col("kind") == "code", F.col("value")))), ",")
    return found.groupBy("entity_id").agg(codes.alias("codes"), F.count_if(F.col("kind") == "document").alias("documents"))


def company_names(spark, sf_dir):
    """Many searches at once: the names that hold each nation's number as three, two or one digits, or its name."""
    n = table(spark, sf_dir, "nation")
    asked = n.select(F.explode(F.array(F.format_string("%03d", "n_nationkey"), F.format_string("R#%d", "n_nationkey"), F.format_string("%d", "n_nationkey"), F.col("n_name"))).alias("query"))
    return package.find_names(package.name_grams(_members(spark, sf_dir)), asked).groupBy("query").agg(F.count("*").alias("names"), F.min("name").alias("first"))


_NAMES_SQL = """WITH a AS (SELECT DISTINCT unnest([printf('%03d', n_nationkey), 'R#' || n_nationkey, CAST(n_nationkey AS VARCHAR), n_name]) AS query FROM nation), n AS (SELECT DISTINCT c_name FROM customer)
SELECT query, count(*) AS names, min(c_name) AS first FROM a JOIN n ON contains(lower(c_name), lower(query)) GROUP BY 1"""
_COMPANY_SQL = "SELECT CAST(c_nationkey AS VARCHAR) AS entity_id, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS codes, count(*) AS documents FROM customer GROUP BY 1 HAVING bool_or(contains(lower(c_name), 'customer#00000001'))"


def omitted_texts(spark, sf_dir):
    """Documents whose text is too long for a cell, as hash and size."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = package.omit_texts(d, ["text"], F.concat(F.lit("documents:"), F.col("doc_id").cast("string")))
    return out.select("doc_id", F.get_json_object("text", "$.sha256").alias("sha256"), F.get_json_object("text", "$.byte_count").cast("bigint").alias("byte_count")).where("sha256 is not null")


_OMIT_SQL = "SELECT doc_id, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS byte_count FROM documents WHERE strlen(text) > 1024"


def financial_unpivot(spark, sf_dir):
    """Customers' figures as one row each, empty ones left out."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    rows = c.select(k, F.when(k % 5 != 0, F.floor("c_acctbal").cast("string")).alias("TA"), F.when(k % 7 == 0, "").otherwise(F.col("c_nationkey").cast("string")).alias("EPS"))
    return market.unpivot_financials(rows, ["c_custkey"], {"TA": ("total_assets", "instant", "JPY"), "EPS": ("eps", "duration", "JPY/share")})


_UNPIVOT_SQL = """SELECT c_custkey, 'TA' AS field, 'total_assets' AS metric, 'instant' AS kind, 'JPY' AS unit, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS value FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT c_custkey, 'EPS', 'eps', 'duration', 'JPY/share', CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_custkey % 7 <> 0"""


def retention_gate(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", market.retention_gate(F.to_date("o_orderdate"), F.lit("2006-06-15").cast("date")).alias("gate"))


_RETENTION_SQL = "SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) < DATE '1996-06-15' THEN 'outside' WHEN CAST(o_orderdate AS DATE) < DATE '1996-07-16' THEN 'boundary' ELSE 'ok' END AS gate FROM orders"


def exact_numbers(spark, sf_dir):
    """Decimal texts of many forms in their one canonical form."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    text = F.concat(F.element_at(F.array(*[F.lit(x) for x in ("", "-", "+", "00", "-0", "x")]), (k % 6 + 1).cast("int")), (k % 1000).cast("string"), F.when(k % 3 == 0, ".500").when(k % 3 == 1, ".").otherwise(""))
    return o.select("o_orderkey", contracts.canonical_number(text).alias("number"))


_NUMBER_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE CASE WHEN o_orderkey % 6 IN (1, 4) AND NOT (o_orderkey % 1000 = 0 AND o_orderkey % 3 <> 0) THEN '-' ELSE '' END || (o_orderkey % 1000) || CASE WHEN o_orderkey % 3 = 0 THEN '.5' ELSE '' END END AS number FROM orders"""


def fingerprints(spark, sf_dir):
    """The bytes of the input files by hash and size."""
    found = filings.fingerprints(spark, sf_dir, "*.parquet")
    return found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "sha256", "size")


def inventory(spark, sf_dir):
    """Orders as documents, lines over 20 as their files, lines of an even supplier as their listings."""
    li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "doc_id")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.date_add(F.to_date("o_orderdate"), 30).alias("submit_day"), "o_custkey")
    events = li.where("l_suppkey % 2 = 0").join(o, "doc_id").select("doc_id", F.to_date("l_shipdate").alias("day"), F.col("l_linenumber").alias("seq"), "submit_day", F.when(F.col("l_partkey") % 5 != 0, F.when(F.col("l_partkey") % 7 == 0, "").otherwise("c")).alias("code"), F.when(F.col("o_custkey") % 9 != 0, F.col("o_custkey").cast("string")).otherwise("").alias("entity"), F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("doc_type"))
    out = coverage.inventory(events, li.where("l_quantity > 20").select("doc_id"))
    told = F.array_join(F.transform("types", lambda t: F.concat_ws(":", t["type"], t["n"].cast("string"))), ",")
    return out.withColumns({c: F.col(c).cast("string") for c in ("first_submitted", "last_submitted", "first_day", "last_day")}).withColumn("types", told)


_INVENTORY_SQL = """WITH e AS (SELECT l_orderkey AS k, CAST(l_shipdate AS DATE) AS day, l_linenumber AS seq, CAST(o_orderdate AS DATE) + 30 AS sub, l_partkey % 5 <> 0 AND l_partkey % 7 <> 0 AS coded, CASE WHEN o_custkey % 9 <> 0 THEN o_custkey END AS e, CASE WHEN l_returnflag <> 'R' THEN l_returnflag ELSE 'unknown' END AS t, CASE WHEN l_partkey % 5 <> 0 THEN CASE WHEN l_partkey % 7 = 0 THEN '' ELSE 'c' END END AS code, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS doc_type FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_suppkey % 2 = 0),
c AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY k ORDER BY CASE WHEN day = sub THEN 0 ELSE 1 END, day, seq, code NULLS FIRST, doc_type NULLS FIRST) = 1),
f AS (SELECT l_orderkey AS fk, count(*) AS n FROM lineitem WHERE l_quantity > 20 GROUP BY 1),
m AS (SELECT * FROM f LEFT JOIN c ON k = fk), y AS (SELECT coalesce(t, 'unknown') AS t, count(*) AS n FROM m GROUP BY 1)
SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS files, count(*) FILTER (n > 1) AS repeated, count(k) AS with_events, (SELECT count(DISTINCT k) FROM e WHERE k NOT IN (SELECT fk FROM f)) AS listing_only, count(*) FILTER (coded) AS with_code, count(*) FILTER (coded IS NOT TRUE) AS without_code, CAST(min(sub) AS VARCHAR) AS first_submitted, CAST(max(sub) AS VARCHAR) AS last_submitted,
  count(DISTINCT e) AS entities, (SELECT string_agg(t || ':' || n, ',' ORDER BY t) FROM y) AS types, (SELECT count(DISTINCT day) FROM e) AS list_days, (SELECT CAST(min(day) AS VARCHAR) FROM e) AS first_day, (SELECT CAST(max(day) AS VARCHAR) FROM e) AS last_day FROM m"""

QUERIES = {f.__name__: f for f in (hash_sample, challenge_sample, canonical_events, snapshot_diff, coverage_grid, bias_summary, provider_compare, reason_counts, shared_views, text_tie, page_text, pk_violations, required_edges, column_profile, duplicate_candidates, pack_roundtrip, formula_guard, company_search, company_names, omitted_texts, financial_unpivot, retention_gate, exact_numbers, fingerprints, inventory)}
ORACLES = {
    "hash_sample": _HASH_SQL,
    "canonical_events": _CANONICAL_SQL,
    "snapshot_diff": _DIFF_SQL,
    "coverage_grid": _GRID_SQL,
    "bias_summary": _BIAS_SQL,
    "provider_compare": _COMPARE_SQL,
    "reason_counts": f"WITH {_COMPARED} SELECT reason, count(*) AS n FROM v WHERE reason IS NOT NULL GROUP BY 1",
    "shared_views": _SHARED_SQL,
    "text_tie": _TIE_SQL,
    "page_text": _PAGE_TEXT_SQL,
    "column_profile": _COLUMN_SQL,
    "pk_violations": _PK_SQL,
    "required_edges": _REQUIRED_SQL,
    "duplicate_candidates": _DUPLICATE_SQL,
    "pack_roundtrip": _PACK_SQL,
    "formula_guard": _FORMULA_SQL,
    "company_search": _COMPANY_SQL,
    "company_names": _NAMES_SQL,
    "omitted_texts": _OMIT_SQL,
    "financial_unpivot": _UNPIVOT_SQL,
    "retention_gate": _RETENTION_SQL,
    "exact_numbers": _NUMBER_SQL,
    "inventory": _INVENTORY_SQL,
}
