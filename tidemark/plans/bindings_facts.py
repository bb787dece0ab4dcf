"""Queries of revisions, views, joins, derivations, splits and lineage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.contracts import first_reason, gate
from ..operators import facts as rules
from ..operators import lineage, reconcile, revisions
from ..operators.graph import cut
from .tables import DOCS_SQL, FACTS_SQL, documents, facts, table

DECISION = "1997-01-01"


def _shape(docs):
    return docs.withColumn("parents", F.when(F.col("parent_id").isNotNull(), F.array("parent_id"))).withColumn("conflicts", F.array().cast("array<string>"))


def revision_components(spark, sf_dir):
    """Every filing's chain, its root and depth, or all that is wrong with the chain."""
    g = revisions.revision_graph(_shape(documents(spark, sf_dir)))
    return g.select("doc_id", "series_id", "root", F.col("depth").cast("bigint").alias("depth"), F.array_join("reasons", ",").alias("reasons"))


#: Components, problems and roots of the table {d}, a subset of docs.
_GRAPH = """
e{x} AS (SELECT c.doc_id AS child, p.doc_id AS parent, c.entity_id AS ce, p.entity_id AS pe, c.available_at AS ca, p.available_at AS pa FROM {d} c JOIN {d} p ON c.parent_id = p.doc_id),
u{x} AS (SELECT child AS a, parent AS b FROM e{x} UNION ALL SELECT parent, child FROM e{x}),
r{x} AS (SELECT doc_id, doc_id AS seen FROM {d} UNION SELECT r{x}.doc_id, u{x}.b FROM r{x} JOIN u{x} ON u{x}.a = r{x}.seen),
c{x} AS (SELECT doc_id, min(seen) AS series_id FROM r{x} GROUP BY 1),
up{x} AS (SELECT doc_id, doc_id AS seen, 0 AS hops FROM {d} UNION ALL SELECT up{x}.doc_id, parent, hops + 1 FROM up{x} JOIN e{x} ON child = seen),
dep{x} AS (SELECT doc_id, max(hops) AS depth FROM up{x} GROUP BY 1),
pr{x} AS (SELECT doc_id, 'revision_metadata_inventory_incomplete' AS reason FROM {d} WHERE incomplete
  UNION ALL SELECT doc_id, 'revision_parent_missing' FROM {d} WHERE doc_type = '130' AND parent_id IS NULL
  UNION ALL SELECT doc_id, 'revision_parent_missing' FROM {d} WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT doc_id FROM {d})
  UNION ALL SELECT child, 'revision_entity_mismatch' FROM e{x} WHERE ce <> pe UNION ALL SELECT child, 'revision_time_order_invalid' FROM e{x} WHERE pa >= ca
  UNION ALL SELECT parent, 'ambiguous_revision_branches' FROM e{x} GROUP BY parent HAVING count(*) > 1),
t{x} AS (SELECT series_id, string_agg(DISTINCT reason, ',' ORDER BY reason) AS reasons FROM pr{x} JOIN c{x} USING (doc_id) GROUP BY 1),
o{x} AS (SELECT series_id, count(*) FILTER (parent_id IS NULL) AS origins, min(doc_id) FILTER (parent_id IS NULL) AS top, max(depth) AS depth FROM {d} JOIN c{x} USING (doc_id) JOIN dep{x} USING (doc_id) GROUP BY 1),
g{x} AS (SELECT c{x}.doc_id, series_id, CASE WHEN reasons IS NULL AND origins = 1 THEN top END AS root, o{x}.depth, coalesce(reasons, CASE WHEN origins <> 1 THEN 'revision_root_unresolved' ELSE '' END) AS reasons FROM c{x} JOIN o{x} USING (series_id) LEFT JOIN t{x} USING (series_id))
"""
_COMPONENTS_SQL = f"{DOCS_SQL}, {_GRAPH.format(x='', d='docs')} SELECT doc_id, series_id, root, CAST(depth AS BIGINT) AS depth, reasons FROM g"


def revision_summary(spark, sf_dir):
    return revisions.revision_summary(revisions.revision_graph(_shape(documents(spark, sf_dir)))).select("series", "blocked_series", F.col("max_depth").cast("bigint").alias("max_depth"))


_SUMMARY_SQL = f"{DOCS_SQL}, {_GRAPH.format(x='', d='docs')}, s AS (SELECT series_id, max(reasons) AS r, max(depth) AS d FROM g GROUP BY 1) SELECT count(*) AS series, count(*) FILTER (r <> '') AS blocked_series, CAST(max(d) AS BIGINT) AS max_depth FROM s"


def revision_roots(spark, sf_dir):
    """Roots of chains whose entities agree and whose times rise, as the strict form asks."""
    d = documents(spark, sf_dir)
    p = d.select(F.col("doc_id").alias("p"), F.col("entity_id").alias("pe"), F.col("available_at").alias("pa"))
    ok = d.join(p, d.parent_id == p.p, "left").withColumn("parent_id", F.when((F.col("pe") == F.col("entity_id")) & ~F.coalesce(F.col("pa") >= F.col("available_at"), F.lit(False)), F.col("parent_id")))
    return revisions.revision_roots(ok.select("doc_id", "parent_id", "entity_id", "available_at"))


_ROOTS_SQL = f"""{DOCS_SQL}, ok AS (SELECT c.doc_id, p.doc_id AS parent FROM docs c LEFT JOIN docs p ON c.parent_id = p.doc_id AND c.entity_id = p.entity_id AND NOT coalesce(p.available_at >= c.available_at, false)),
up AS (SELECT doc_id, doc_id AS seen FROM ok UNION ALL SELECT up.doc_id, ok.parent FROM up JOIN ok ON ok.doc_id = up.seen WHERE ok.parent IS NOT NULL)
SELECT up.doc_id, up.seen AS root FROM up JOIN ok ON ok.doc_id = up.seen AND ok.parent IS NULL"""


def revision_closure(spark, sf_dir):
    """What the filings of one customer in ten reach through parents and amendments."""
    d = documents(spark, sf_dir)
    seeds = d.where(F.col("entity_id").endswith("7")).select("doc_id")
    return revisions.revision_closure(seeds, d, ["130"]).select("doc_id", F.col("hops").cast("bigint").alias("hops"))


_CLOSURE_SQL = f"""{DOCS_SQL}, e AS (SELECT c.doc_id AS a, c.parent_id AS b FROM docs c JOIN docs p ON c.parent_id = p.doc_id UNION SELECT parent_id, doc_id FROM docs WHERE parent_id IS NOT NULL AND doc_type = '130'),
r AS (SELECT doc_id, 0 AS hops FROM docs WHERE entity_id LIKE '%7' UNION SELECT e.b, hops + 1 FROM r JOIN e ON e.a = r.doc_id WHERE hops < 40)
SELECT doc_id, CAST(min(hops) AS BIGINT) AS hops FROM r GROUP BY 1"""


def _decision(spark, cutoff):
    return spark.range(1).select(F.lit("d").alias("decision_id"), F.lit(cutoff).cast("timestamp").alias("cutoff"), F.lit("2030-01-01").cast("timestamp").alias("snapshot"))


def fact_view_asof(spark, sf_dir):
    """The facts that may be used at one decision, and the ledger of what may not."""
    view = revisions.fact_view(facts(spark, sf_dir), documents(spark, sf_dir), _decision(spark, DECISION))
    return view.select("doc_id", "fact_id", "key", "value", "missing_reason")


def fact_view_latest(spark, sf_dir):
    view = revisions.fact_view(facts(spark, sf_dir), documents(spark, sf_dir), _decision(spark, "2030-01-01"))
    return view.groupBy("missing_reason").agg(F.count("*").alias("n"))


def _view_sql(cutoff: str, tail: str) -> str:
    return f"""{DOCS_SQL}, {FACTS_SQL}, el AS (SELECT * FROM docs WHERE available_at IS NULL OR available_at < TIMESTAMP '{cutoff}'), {_GRAPH.format(x="", d="el")},
v0 AS (SELECT el.*, root, reasons FROM el JOIN g USING (doc_id)),
spoilt AS (SELECT DISTINCT root FROM v0 WHERE root IS NOT NULL AND available_at IS NULL),
visible AS (SELECT * FROM v0 WHERE root IS NOT NULL AND available_at IS NOT NULL),
clean AS (SELECT * FROM visible WHERE root NOT IN (SELECT root FROM spoilt)),
leaf AS (SELECT * FROM clean WHERE doc_id NOT IN (SELECT parent_id FROM visible WHERE parent_id IS NOT NULL)),
win AS (SELECT *, CASE WHEN k % 61 = 0 THEN 'withdrawn' WHEN k % 67 = 0 THEN 'artifact_hash_mismatch' END AS gate FROM leaf),
good AS (SELECT doc_id, root FROM win WHERE gate IS NULL),
own AS (SELECT facts.* FROM facts JOIN good USING (doc_id)),
jd AS (SELECT doc_id, key, CASE WHEN bool_or(fact_at >= TIMESTAMP '{cutoff}') THEN 'fact_not_yet_available' WHEN bool_or(v IS NULL) THEN '-' WHEN bool_or(unverified) THEN 'unverified_facts' WHEN min(v) <> max(v) THEN 'conflicting_facts' END AS reason FROM own GROUP BY ALL),
older AS (SELECT DISTINCT good.doc_id, f.key FROM good JOIN visible o ON o.root = good.root AND o.doc_id <> good.doc_id JOIN facts f ON f.doc_id = o.doc_id),
view AS (SELECT doc_id, fact_id, key, CAST(v AS VARCHAR) AS value, CASE WHEN reason = '-' THEN 'parse_failed' END AS missing_reason FROM own JOIN jd USING (doc_id, key) WHERE reason IS NULL OR (reason = '-' AND v IS NULL)
  UNION ALL SELECT doc_id, NULL, key, NULL, reason FROM jd WHERE reason <> '-'
  UNION ALL SELECT doc_id, NULL, key, NULL, 'metric_absent_in_latest_revision' FROM older WHERE (doc_id, key) NOT IN (SELECT (doc_id, key) FROM own)
  UNION ALL SELECT doc_id, NULL, NULL, NULL, gate FROM win WHERE gate IS NOT NULL
  UNION ALL SELECT doc_id, NULL, NULL, NULL, 'unknown_availability' FROM v0 WHERE root IS NOT NULL AND available_at IS NULL
  UNION ALL SELECT doc_id, NULL, NULL, NULL, unnest(string_split(reasons, ',')) FROM v0 WHERE root IS NULL)
{tail}"""


def view_boundary(spark, sf_dir):
    """The view of every amendment's series at the amendment's public time and a microsecond after, as slices of one log."""
    docs = documents(spark, sf_dir)
    return revisions.boundary_audit(revisions.view_log(facts(spark, sf_dir), docs, "2030-01-01"), docs, "2030-01-01")


_BOUNDARY_SQL = f"""{DOCS_SQL}, {FACTS_SQL}, lk AS (SELECT c.doc_id AS a, p.doc_id AS b FROM docs c JOIN docs p ON c.parent_id = p.doc_id), lb AS (SELECT * FROM lk UNION ALL SELECT b, a FROM lk),
fr AS (SELECT doc_id, doc_id AS seen FROM docs UNION SELECT fr.doc_id, lb.b FROM fr JOIN lb ON lb.a = fr.seen), fam AS (SELECT doc_id, min(seen) AS series FROM fr GROUP BY 1),
bd AS (SELECT doc_id || '/' || boundary AS id, doc_id AS rev, boundary, series, available_at + CASE WHEN boundary = 'after_boundary' THEN INTERVAL 1 MICROSECOND ELSE INTERVAL 0 MICROSECOND END AS t FROM docs JOIN fam USING (doc_id), (VALUES ('after_boundary'), ('at_exclusive_boundary')) v(boundary) WHERE parent_id IS NOT NULL AND available_at IS NOT NULL),
el AS (SELECT bd.id || '|' || docs.doc_id AS doc_id, bd.id || '|' || parent_id AS parent_id, entity_id, available_at, doc_type, incomplete, k, docs.doc_id AS own, bd.id, rev, boundary, t FROM bd JOIN fam USING (series) JOIN docs ON docs.doc_id = fam.doc_id AND (available_at IS NULL OR available_at < t)), {{graph}},
v0 AS (SELECT el.*, root, reasons FROM el JOIN g USING (doc_id)),
spoilt AS (SELECT DISTINCT root FROM v0 WHERE root IS NOT NULL AND available_at IS NULL),
visible AS (SELECT * FROM v0 WHERE root IS NOT NULL AND available_at IS NOT NULL),
clean AS (SELECT * FROM visible WHERE root NOT IN (SELECT root FROM spoilt)),
leaf AS (SELECT * FROM clean WHERE doc_id NOT IN (SELECT parent_id FROM visible WHERE parent_id IS NOT NULL)),
win AS (SELECT *, CASE WHEN k % 61 = 0 THEN 'withdrawn' WHEN k % 67 = 0 THEN 'artifact_hash_mismatch' END AS gate FROM leaf),
good AS (SELECT * FROM win WHERE gate IS NULL),
ow AS (SELECT good.rev, boundary, t, own, f.fact_id, f.key, f.v, f.unverified, f.fact_at FROM good JOIN facts f ON f.doc_id = good.own),
jd AS (SELECT rev, boundary, own, key, CASE WHEN bool_or(fact_at >= t) THEN 'fact_not_yet_available' WHEN bool_or(v IS NULL) THEN '-' WHEN bool_or(unverified) THEN 'unverified_facts' WHEN min(v) <> max(v) THEN 'conflicting_facts' END AS reason FROM ow GROUP BY ALL),
older AS (SELECT DISTINCT good.rev, good.boundary, good.own, f.key FROM good JOIN visible o ON o.root = good.root AND o.doc_id <> good.doc_id JOIN facts f ON f.doc_id = o.own)
SELECT rev AS revision_doc_id, boundary, own AS doc_id, fact_id, key, CAST(v AS VARCHAR) AS value, CASE WHEN reason = '-' THEN 'parse_failed' END AS missing_reason FROM ow JOIN jd USING (rev, boundary, own, key) WHERE reason IS NULL OR (reason = '-' AND v IS NULL)
  UNION ALL SELECT rev, boundary, own, NULL, key, NULL, reason FROM jd WHERE reason <> '-'
  UNION ALL SELECT rev, boundary, own, NULL, key, NULL, 'metric_absent_in_latest_revision' FROM older ANTI JOIN ow USING (rev, boundary, own, key)
  UNION ALL SELECT rev, boundary, own, NULL, NULL, NULL, gate FROM win WHERE gate IS NOT NULL
  UNION ALL SELECT rev, boundary, own, NULL, NULL, NULL, 'unknown_availability' FROM v0 WHERE root IS NOT NULL AND available_at IS NULL
  UNION ALL SELECT rev, boundary, own, NULL, NULL, NULL, unnest(string_split(reasons, ',')) FROM v0 WHERE root IS NULL""".replace("{graph}", _GRAPH.format(x="", d="el"))


def pit_join(spark, sf_dir):
    """Usable facts joined to the price before the decision, with the first reason that stops a row."""
    from ..operators.calendar import price_asof

    view = revisions.fact_view(facts(spark, sf_dir), documents(spark, sf_dir), _decision(spark, DECISION)).where("fact_id is not null")
    parts = F.split("fact_id", "-")
    rows = cut(view.select("fact_id", "value", "missing_reason", parts[2].cast("bigint").alias("code"), F.lit(DECISION).cast("timestamp").alias("decision_at")).distinct())
    li = table(spark, sf_dir, "lineitem")
    prices = li.select(F.col("l_partkey").alias("code"), F.to_date("l_shipdate").alias("day"), F.col("l_quantity").cast("int").alias("close"), F.lit(1).alias("factor"), F.lit("reported_unadjusted").alias("basis"), F.date_add(F.to_date("l_shipdate"), 1).cast("timestamp").alias("available_at"), F.lit(True).alias("projected"))
    asked = rows.select("code", "decision_at").distinct().withColumn("part", F.col("code"))
    met = rows.withColumnRenamed("missing_reason", "view_reason").join(price_asof(asked, prices, ["part"]), F.col("code") == F.col("part"), "left")
    reason = first_reason((F.col("view_reason").isNotNull(), F.col("view_reason")), (F.col("price_reason").isNotNull(), F.col("price_reason")))
    return gate(met, reason, ("value", "close")).select("fact_id", "value", F.col("close").cast("bigint").alias("close"), "status", "missing_reason")


_PIT_TAIL = f"""SELECT DISTINCT fact_id, CASE WHEN r IS NULL THEN value END AS value, CASE WHEN r IS NULL THEN CAST(q AS BIGINT) END AS close, CASE WHEN r IS NULL THEN 'PASS' ELSE 'BLOCKED' END AS status, r AS missing_reason FROM (
  SELECT fact_id, value, q, coalesce(missing_reason, CASE WHEN n IS NULL THEN 'price_missing' WHEN n > 1 THEN 'price_observation_ambiguous' WHEN day + 1 >= DATE '{DECISION}' THEN 'price_not_yet_available' END) AS r
  FROM view LEFT JOIN (SELECT p, day, n, q FROM (SELECT l_partkey AS p, CAST(l_shipdate AS DATE) AS day, count(*) AS n, min(CAST(l_quantity AS INTEGER)) AS q FROM lineitem WHERE CAST(l_shipdate AS DATE) < DATE '{DECISION}' GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY p ORDER BY day DESC) = 1) x
  ON x.p = CAST(string_split(fact_id, '-')[3] AS BIGINT) WHERE fact_id IS NOT NULL)"""


def _pair_facts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_quantity").cast("int").cast("string"), F.date_format("l_shipdate", "yyyyMMdd")).alias("fact_id"), "l_orderkey", "l_linenumber", F.when(F.col("l_suppkey") % 5 == 0, "second").otherwise("first").alias("doc_id"), F.when(F.col("l_partkey") % 3 == 0, "r").alias("root"), F.when(F.col("l_suppkey") % 13 != 0, F.col("l_returnflag")).alias("scope"), F.lit("JP GAAP").alias("standard"), F.col("l_linestatus").alias("unit"), F.lit("k").alias("key"), F.col("l_quantity").cast("int").cast("string").alias("value"))
    return rows


def fact_pairs_reconcile(spark, sf_dir):
    """All pairs of rows that share an order line, classified."""
    rows = _pair_facts(spark, sf_dir)
    return reconcile.within_source(rows, ["l_orderkey", "l_linenumber"]).select("a", "b", F.array_join("classes", ",").alias("classes"))


_PAIRS_SQL = """WITH f AS (SELECT concat_ws('-', l_partkey, l_suppkey, CAST(l_quantity AS INTEGER), strftime(CAST(l_shipdate AS TIMESTAMP), '%Y%m%d')) AS id, l_orderkey AS o, l_linenumber AS l, CASE WHEN l_suppkey % 5 = 0 THEN 's' ELSE 'f' END AS d, l_partkey % 3 = 0 AS r,
  CASE WHEN l_suppkey % 13 <> 0 THEN l_returnflag END AS s, l_linestatus AS u, CAST(l_quantity AS INTEGER) AS v FROM lineitem),
p AS (SELECT x.id AS a, y.id AS b, list_filter([CASE WHEN x.s IS NULL OR y.s IS NULL THEN 'unresolved' WHEN x.s <> y.s THEN 'scope_difference' END, CASE WHEN x.u <> y.u THEN 'unit_difference' END,
  CASE WHEN x.d <> y.d THEN CASE WHEN x.r AND y.r THEN 'restatement_difference' ELSE 'unresolved' END END], lambda c: c IS NOT NULL) AS c, x.v = y.v AS same FROM f x JOIN f y ON x.o = y.o AND x.l = y.l AND x.id < y.id)
SELECT a, b, CASE WHEN len(c) > 0 THEN array_to_string(c, ',') WHEN same THEN 'exact_match' ELSE 'conflicting_facts' END AS classes FROM p"""


def fact_pair_counts(spark, sf_dir):
    """How often each outcome occurs among all pairs of an order's lines, from counts alone."""
    rows = _pair_facts(spark, sf_dir).withColumn("key", F.col("l_linenumber").cast("string"))
    return reconcile.pair_counts(rows, ["l_orderkey"]).select("l_orderkey", F.array_join("classes", ",").alias("classes"), "pairs")


_PAIR_COUNT_SQL = """WITH f AS (SELECT concat_ws('-', l_partkey, l_suppkey, CAST(l_quantity AS INTEGER), strftime(CAST(l_shipdate AS TIMESTAMP), '%Y%m%d')) AS id, l_orderkey AS o, l_linenumber AS l, CASE WHEN l_suppkey % 5 = 0 THEN 's' ELSE 'f' END AS d, l_partkey % 3 = 0 AS r,
  CASE WHEN l_suppkey % 13 <> 0 THEN l_returnflag END AS s, l_linestatus AS u, CAST(l_quantity AS INTEGER) AS v FROM lineitem),
p AS (SELECT x.o, list_filter([CASE WHEN x.s IS NULL OR y.s IS NULL THEN 'unresolved' WHEN x.s <> y.s THEN 'scope_difference' END, CASE WHEN x.u <> y.u THEN 'unit_difference' END,
  CASE WHEN x.d <> y.d THEN CASE WHEN x.r AND y.r THEN 'restatement_difference' ELSE 'unresolved' END END], lambda c: c IS NOT NULL) AS c, x.v = y.v AS same, x.l = y.l AS keyed FROM f x JOIN f y ON x.o = y.o AND x.id < y.id)
SELECT o AS l_orderkey, CASE WHEN len(c) > 0 THEN array_to_string(c, ',') WHEN NOT keyed THEN 'unresolved' WHEN same THEN 'exact_match' ELSE 'conflicting_facts' END AS classes, count(*) AS pairs FROM p GROUP BY ALL"""


def cross_source_reconcile(spark, sf_dir):
    """Customers' order sums against their suppliers' view of the same lines: a fact is an order and a unit, its revisions are the lines' ship days."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    li = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(F.col("l_quantity").cast("int")).alias("q"), F.max(F.to_date("l_shipdate")).alias("last"), F.count_distinct("l_returnflag").alias("flags"), F.min("l_linestatus").alias("status"), F.count("*").alias("n"))
    day = F.to_date("o_orderdate")
    unit = F.element_at(F.array(*[F.lit(u) for u in ("JPY", "shares", "JPY/share")]), (k % 3 + 1).cast("int"))
    left = o.select(k, k.alias("fact_id"), F.when(k % 97 != 0, k % 7 != 0).alias("identity_verified"), (k % 11 == 0).alias("is_revision"), F.when(k % 2 == 0, "cons").otherwise("solo").alias("scope"), unit.alias("unit"), F.substring("o_orderpriority", 1, 1).alias("share_basis"), F.when(F.col("o_orderstatus") == "P", 1).alias("n_dimensions"),
        F.when(k % 89 != 0, F.date_add(day, 1).cast("timestamp")).alias("available_at"), F.when(k % 83 != 0, F.date_add(day, 60).cast("timestamp")).alias("decision_at")).join(li.select("o_orderkey", F.col("q").cast("string").alias("value")), "o_orderkey", "left")
    right = li.join(o, "o_orderkey").where(k % 5 != 0).select(k, k.alias("fact_id"), F.when(k % 3 == 0, F.col("q") + 1).otherwise(F.col("q")).cast("string").alias("value"), F.when(k % 13 == 0, F.col("last")).otherwise(F.date_add(day, 1)).cast("timestamp").alias("available_at"), F.when(k % 4 == 0, "cons").otherwise("solo").alias("scope"), unit.alias("unit"),
        F.when(F.col("flags") == 1, "1").otherwise(F.substring("o_orderpriority", 1, 1)).alias("share_basis"), (k % 17 == 0).alias("restated"), F.when(F.col("status") == "F", reconcile.FIRST_STATE).when(F.col("n") > 3, "revised").alias("revision_state"))
    out = reconcile.across_sources(left, right, ["o_orderkey"], {"scope": "scope_difference"})
    return out.select("o_orderkey", "other_id", F.array_join("classes", ",").alias("classes"), "numeric")


_CROSS_SQL = """WITH li AS (SELECT l_orderkey AS k, sum(CAST(l_quantity AS INTEGER)) AS q, CAST(max(l_shipdate) AS DATE) AS last, count(DISTINCT l_returnflag) AS flags, min(l_linestatus) AS st, count(*) AS n FROM lineitem GROUP BY 1),
o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, (['JPY', 'shares', 'JPY/share'])[o_orderkey % 3 + 1] AS unit, substr(o_orderpriority, 1, 1) AS basis, o_orderstatus AS st FROM orders),
l AS (SELECT o.k, q AS v, o.k % 97 <> 0 AND o.k % 7 <> 0 AS ok, o.k % 11 = 0 AS rev, CASE WHEN o.k % 2 = 0 THEN 'cons' ELSE 'solo' END AS s, unit, basis, o.st = 'P' AS dims, CASE WHEN o.k % 89 <> 0 THEN day + 1 END AS t, CASE WHEN o.k % 83 <> 0 THEN day + 60 END AS dec FROM o LEFT JOIN li ON li.k = o.k),
r AS (SELECT o.k, CASE WHEN o.k % 3 = 0 THEN q + 1 ELSE q END AS v, CASE WHEN o.k % 13 = 0 THEN last ELSE day + 1 END AS t, CASE WHEN o.k % 4 = 0 THEN 'cons' ELSE 'solo' END AS s, CASE WHEN flags = 1 THEN '1' ELSE basis END AS basis,
  o.k % 17 = 0 AS re, CASE WHEN li.st = 'F' THEN 'reported_initial_or_unknown' WHEN n > 3 THEN 'revised' END AS state FROM li JOIN o ON o.k = li.k WHERE o.k % 5 <> 0),
m AS (SELECT l.k, r.k AS other_id, l.v AS a, r.v AS b, NOT ok AS bad, l.s <> r.s OR dims AS sd, unit <> 'JPY' AND l.basis <> r.basis AS dd, rev OR re OR state IS NULL OR state <> 'reported_initial_or_unknown' AS vd, l.t IS NULL OR r.t IS NULL OR dec IS NULL AS untimed, greatest(l.t, r.t) >= dec AS late, l.t <> r.t AS td FROM l LEFT JOIN r ON r.k = l.k),
n AS (SELECT *, CASE WHEN other_id IS NOT NULL AND NOT bad AND NOT sd AND NOT dd AND NOT untimed AND NOT late AND a IS NOT NULL AND b IS NOT NULL THEN CASE WHEN a = b THEN 'equal' ELSE 'different' END END AS num FROM m)
SELECT k AS o_orderkey, other_id, CASE WHEN other_id IS NULL THEN 'unresolved' ELSE array_to_string(list_sort(list_filter([CASE WHEN bad OR untimed OR a IS NULL OR b IS NULL THEN 'unresolved' END, CASE WHEN sd THEN 'scope_difference' END, CASE WHEN dd THEN 'definition_difference' END, CASE WHEN vd THEN 'revision_difference' END,
  CASE WHEN NOT untimed AND (late OR td) THEN 'timing_difference' END, CASE num WHEN 'equal' THEN 'exact_match' WHEN 'different' THEN 'value_conflict' END], lambda c: c IS NOT NULL)), ',') END AS classes, num AS numeric FROM n"""


def quarter_from_ytd(spark, sf_dir):
    """Quarters of a supplier's shipped cents as differences of its year-to-date sums."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("y"), F.quarter("l_shipdate").alias("q"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    sums = li.groupBy("l_suppkey", "y", "q").agg(F.sum("cents").alias("cents"))
    ytd = sums.withColumn("ytd", F.sum("cents").over(Window.partitionBy("l_suppkey", "y").orderBy("q")))
    start = F.make_date("y", F.lit(1), F.lit(1))
    end = F.last_day(F.make_date("y", F.col("q") * 3, F.lit(1)))
    cents = F.concat((F.col("ytd") / 100).cast("decimal(30,2)").cast("string"))
    rows = ytd.select(F.concat_ws("-", "l_suppkey", "y", "q").alias("fact_id"), "l_suppkey", F.when(F.col("l_suppkey") % 9 == 0, "backlog").otherwise("revenue_sales").alias("metric"), start.alias("period_start"), end.alias("period_end"), start.alias("fiscal_year_start"), F.lit("cumulative").alias("period_class"), F.lit("duration").alias("period_kind"), cents.alias("value"), F.when((F.col("l_suppkey") + F.col("q")) % 8 == 0, "unverified").otherwise("source_tied").alias("verification"), F.lit("reported").alias("representation"), F.lit(False).alias("synthetic"), end.cast("timestamp").alias("available_at"))
    out = rules.derive_quarter(rows, ["l_suppkey"])
    return out.select("current_id", "previous_id", F.col("quarter_start").cast("string").alias("quarter_start"), F.col("quarter_end").cast("string").alias("quarter_end"), "value", "missing_reason")


_QUARTER_SQL = """WITH s AS (SELECT l_suppkey AS s, year(l_shipdate) AS y, quarter(l_shipdate) AS q, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS c FROM lineitem GROUP BY ALL),
t AS (SELECT *, sum(c) OVER (PARTITION BY s, y ORDER BY q) AS ytd, concat_ws('-', s, y, q) AS id, CAST(make_date(y, 1, 1) + to_months(CAST(3 * q AS INTEGER)) AS DATE) - 1 AS e, (s + q) % 8 = 0 AS bad FROM s),
p AS (SELECT a.id AS current_id, b.id AS previous_id, b.e + 1 AS qs, a.e AS qe, CAST(a.ytd - b.ytd AS BIGINT) AS d, CASE WHEN a.s % 9 = 0 THEN 'metric_not_additive' WHEN a.e - b.e NOT BETWEEN 70 AND 100 THEN 'non_quarter_difference' WHEN a.bad OR b.bad THEN 'incomplete_or_unverified_lineage' END AS missing_reason FROM t a JOIN t b ON a.s = b.s AND a.y = b.y AND b.q < a.q)
SELECT current_id, previous_id, CAST(qs AS VARCHAR) AS quarter_start, CAST(qe AS VARCHAR) AS quarter_end, CASE WHEN missing_reason IS NULL THEN CAST(d // 100 AS VARCHAR) || CASE WHEN d % 100 = 0 THEN '' WHEN d % 10 = 0 THEN '.' || CAST(d % 100 // 10 AS VARCHAR) ELSE '.' || lpad(CAST(d % 100 AS VARCHAR), 2, '0') END END AS value, missing_reason FROM p"""


def training_split(spark, sf_dir):
    """Orders whose outcome and label lie before the validation start less thirty days."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    end = F.greatest(F.col("o_orderdate"), F.coalesce("last", F.col("o_orderdate")))
    rows = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_orderkey").alias("episode_id"), F.col("o_orderdate").alias("decision_at"), end.alias("outcome_end"), F.when(F.col("o_orderkey") % 10 != 0, end + F.expr("interval 7 days")).alias("label_available_at"))
    return rules.past_training(rows, "1997-06-01", 30)


_SPLIT_SQL = """SELECT o_orderkey AS episode_id FROM (SELECT o_orderkey, o_orderdate, greatest(o_orderdate, coalesce(max(l_shipdate), o_orderdate)) AS e FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
WHERE o_orderkey % 10 <> 0 AND o_orderdate < TIMESTAMP '1997-05-02' AND e + INTERVAL 7 DAY < TIMESTAMP '1997-05-02'"""


def _edges(spark, sf_dir):
    return lineage.build([
        lineage.edge(table(spark, sf_dir, "nation"), "region", "n_regionkey", "nation", "n_nationkey", "has_nation"),
        lineage.edge(table(spark, sf_dir, "customer"), "nation", "c_nationkey", "customer", "c_custkey", "has_customer"),
        lineage.edge(table(spark, sf_dir, "orders"), "customer", "o_custkey", "order", "o_orderkey", "has_order"),
        lineage.edge(table(spark, sf_dir, "lineitem"), "order", "l_orderkey", "part", "l_partkey", "has_part"),
    ])


def lineage_reach(spark, sf_dir):
    """All that comes from one region, with the least number of steps."""
    nodes, _ = lineage.walk(spark.range(1).select(F.lit("region:1").alias("node")), _edges(spark, sf_dir))
    return nodes.select("node", F.col("hops").cast("bigint").alias("hops"))


_EDGES_SQL = """e AS (SELECT DISTINCT 'region:' || n_regionkey AS src, 'nation:' || n_nationkey AS dst, 'has_nation' AS rel FROM nation UNION SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey, 'has_customer' FROM customer
 UNION SELECT 'customer:' || o_custkey, 'order:' || o_orderkey, 'has_order' FROM orders UNION SELECT 'order:' || l_orderkey, 'part:' || l_partkey, 'has_part' FROM lineitem)"""
_REACH_SQL = f"WITH RECURSIVE {_EDGES_SQL}, r AS (SELECT 'region:1' AS node, 0 AS hops UNION SELECT dst, hops + 1 FROM r JOIN e ON src = node) SELECT node, CAST(min(hops) AS BIGINT) AS hops FROM r GROUP BY 1"


def lineage_validate(spark, sf_dir):
    """Edges whose end no table has, and nodes on or behind cycles, which some orders close."""
    back = lineage.edge(table(spark, sf_dir, "orders").where("o_orderkey % 500 = 1"), "order", "o_orderkey", "customer", "o_custkey", "returns")
    edges = cut(_edges(spark, sf_dir).union(back))
    known = [("region", "region", "r_regionkey"), ("nation", "nation", "n_nationkey"), ("customer", "customer", "c_custkey"), ("order", "orders", "o_orderkey"), ("part", "part", "p_partkey")]
    nodes = None
    for kind, name, key in known:
        own = table(spark, sf_dir, name).where(F.lit(True) if kind != "part" else F.col(key) % 50 != 0).select(F.concat(F.lit(f"{kind}:"), F.col(key).cast("string")).alias("node"))
        nodes = own if nodes is None else nodes.union(own)
    lost = lineage.orphans(edges, nodes).groupBy("relation").agg(F.count("*").alias("n")).select(F.concat(F.lit("orphan_"), "relation").alias("check"), "n")
    return lost.union(lineage.cyclic(edges).agg(F.count("*").alias("n")).select(F.lit("cycle").alias("check"), "n"))


_VALIDATE_SQL = f"""WITH {_EDGES_SQL}, n AS (SELECT 'region:' || r_regionkey AS node FROM region UNION ALL SELECT 'nation:' || n_nationkey FROM nation UNION ALL SELECT 'customer:' || c_custkey FROM customer UNION ALL SELECT 'order:' || o_orderkey FROM orders UNION ALL SELECT 'part:' || p_partkey FROM part WHERE p_partkey % 50 <> 0),
c AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 500 = 1), q AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM c))
SELECT 'orphan_' || rel AS "check", count(*) AS n FROM e WHERE src NOT IN (SELECT node FROM n) OR dst NOT IN (SELECT node FROM n) GROUP BY 1 UNION ALL SELECT 'cycle', (SELECT count(*) FROM c) + (SELECT count(*) FROM q) + (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM q))"""

QUERIES = {f.__name__: f for f in (revision_components, revision_summary, revision_roots, revision_closure, fact_view_asof, fact_view_latest, view_boundary, pit_join, fact_pairs_reconcile, fact_pair_counts, cross_source_reconcile, quarter_from_ytd, training_split, lineage_reach, lineage_validate)}
ORACLES = {
    "revision_components": _COMPONENTS_SQL,
    "revision_summary": _SUMMARY_SQL,
    "revision_roots": _ROOTS_SQL,
    "revision_closure": _CLOSURE_SQL,
    "fact_view_asof": _view_sql(DECISION, "SELECT * FROM view"),
    "fact_view_latest": _view_sql("2030-01-01", "SELECT missing_reason, count(*) AS n FROM view GROUP BY 1"),
    "view_boundary": _BOUNDARY_SQL,
    "pit_join": _view_sql(DECISION, _PIT_TAIL),
    "fact_pairs_reconcile": _PAIRS_SQL,
    "fact_pair_counts": _PAIR_COUNT_SQL,
    "cross_source_reconcile": _CROSS_SQL,
    "quarter_from_ytd": _QUARTER_SQL,
    "training_split": _SPLIT_SQL,
    "lineage_reach": _REACH_SQL,
    "lineage_validate": _VALIDATE_SQL,
}
