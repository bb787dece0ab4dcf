"""Queries of the scalar rules: numbers, instants, ids, periods, scopes, units, times, categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import contracts
from ..operators import facts as rules
from ..operators import market, reconcile, sampling, validate
from .tables import table


def pick(values: list, k: Column) -> Column:
    """values[k modulo their number]; None stands for null."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))


def literal(v) -> str:
    if v is None:
        return "NULL"
    return str(v).lower() if isinstance(v, bool) else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def picked(values: list, k: str) -> str:
    """pick in SQL."""
    return f"([{', '.join(map(literal, values))}])[{k} % {len(values)} + 1]"


KEY = "o_orderkey"

NUMBERS = ["12", "1e3", " 7 ", "", "abc", "NaN", "0.12345678912", "-5.50", None, "+.5", "1E-9", "Infinity"]
NUMBER_VALUES = ["12", "1000", "7", None, None, None, None, "-5.5", None, "0.5", "0.000000001", None]
NUMBER_REASONS = [None, None, None, None, "invalid_market_number", "invalid_market_number", "market_number_not_exact", None, None, None, None, "invalid_market_number"]


def strict_numbers(spark, sf_dir):
    """Provider numbers: exact, empty, or with a reason; never rounded."""
    value, reason = contracts.market_number(pick(NUMBERS, F.col(KEY)))
    return table(spark, sf_dir, "orders").select(KEY, contracts.canonical_number(value.cast("decimal(38,9)").cast("string")).alias("number"), reason.alias("reason"))


_NUMBERS_SQL = f"SELECT o_orderkey, {picked(NUMBER_VALUES, KEY)} AS number, {picked(NUMBER_REASONS, KEY)} AS reason FROM orders"

PAIRS = [("1e3", "1000", True), ("NaN", "NaN", False), ("1.50", "1.5", True), ("-0", "0.00", True), ("a", "a", True), ("a ", "a", False), (None, None, True), (None, "1", False), ("Infinity", "inf", False), ("123456789012345678901234567890.1", "123456789012345678901234567890.10", True), ("12e-1", "1.2", True), ("1", "x", False), ("1E400", "10e399", True)]


def scalar_equality(spark, sf_dir):
    """Pairs of scalars: numbers by value, exponents and all; what isn't finite equals nothing."""
    a, b = pick([p[0] for p in PAIRS], F.col(KEY)), pick([p[1] for p in PAIRS], F.col(KEY))
    return table(spark, sf_dir, "orders").select(KEY, contracts.scalar_equal(a, b).alias("equal"))


_EQUAL_SQL = f"SELECT o_orderkey, {picked([p[2] for p in PAIRS], KEY)} AS equal FROM orders"

OFFSETS = ["Z", "+09:00", "", "+0900", "-05:30"]


def strict_instants(spark, sf_dir):
    """Order times with an offset as instants; without a full one they are unknown."""
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), pick(OFFSETS, F.col(KEY)))
    return table(spark, sf_dir, "orders").select(KEY, F.unix_timestamp(contracts.strict_instant(text)).alias("seconds"))


_INSTANT_SQL = f"SELECT o_orderkey, CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) - {picked([0, 32400, None, None, -19800], KEY)} AS BIGINT) AS seconds FROM orders"


def content_ids(spark, sf_dir):
    """Content hashes over sorted keys that keep nulls and non-ASCII text."""
    code = F.when(F.col(KEY) % 3 == 0, F.lit(None).cast("string")).otherwise("é")
    return table(spark, sf_dir, "orders").select(KEY, contracts.content_id({"b": F.col(KEY), "a": F.col("o_orderstatus"), "n": code}).alias("id"))


_IDS_SQL = """SELECT o_orderkey, sha256('{"a":"' || o_orderstatus || '","b":' || o_orderkey || ',"n":' || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"é"' END || '}') AS id FROM orders"""


def semantic_keys(spark, sf_dir):
    """How many order lines share what they mean; unknown flags are a meaning too."""
    li = table(spark, sf_dir, "lineitem").withColumn("flag", F.when(F.col("l_suppkey") % 7 != 0, F.col("l_returnflag")))
    return li.groupBy(contracts.semantic_key(["flag", "l_linestatus"]).alias("key")).agg(F.count("*").alias("n"))


_SEMANTIC_SQL = """SELECT sha256('{"flag":' || CASE WHEN l_suppkey % 7 <> 0 THEN '"' || l_returnflag || '"' ELSE 'null' END || ',"l_linestatus":"' || l_linestatus || '"}') AS key, count(*) AS n FROM lineitem GROUP BY 1"""

NAMES = ["CurrentYearDuration", "CurrentYearInstant", "Prior1YearDuration", "CurrentYTDDuration", "CurrentQuarterDuration", "CurrentYearDurationX", "AccumulatedQ1Duration", "Prior0YearDuration", "Prior12YearInstant_NonConsolidatedMember", "FilingDateInstant", "Prior1YTDDuration"]
DURATIONS = ["annual", None, "annual", "cumulative", "quarter", None, None, None, None, None, None]
INSTANTS = [False, True, False, False, False, False, False, False, True, False, False]


def periods(spark, sf_dir):
    """Contexts' periods by dates and names: kind, class, reason, warning."""
    d = F.to_date("o_orderdate")
    shape = F.col(KEY) % 5
    start = F.when(shape.isin(0, 1, 4), d)
    end = F.when(shape == 0, F.date_add(d, 90)).when(shape == 1, F.date_sub(d, 1))
    instant = F.when(shape.isin(2, 4), d)
    kind, reason = rules.period_kind(start, end, instant)
    cls, warning = rules.period_class(pick(NAMES, F.col(KEY)), kind)
    return table(spark, sf_dir, "orders").select(KEY, kind.alias("kind"), reason.alias("reason"), cls.alias("class"), warning.alias("warning"))


_PERIOD_SQL = f"""SELECT o_orderkey, kind, reason, CASE WHEN kind = 'instant' THEN 'instant' ELSE d END AS class, CASE WHEN (kind = 'instant' AND NOT i) OR coalesce(CASE WHEN kind = 'instant' THEN 'i' END, d) IS NULL OR kind IS NULL THEN 'context_period_class_unverified' END AS warning FROM (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'duration' WHEN 2 THEN 'instant' END AS kind, CASE o_orderkey % 5 WHEN 1 THEN 'context_period_reversed' WHEN 3 THEN 'context_period_unknown' WHEN 4 THEN 'context_period_unknown' END AS reason, {picked(DURATIONS, KEY)} AS d, {picked(INSTANTS, KEY)} AS i FROM orders)"""

AXIS, SOLO, GROUP = "axis", "solo", "group"


def scopes(spark, sf_dir):
    """Contexts judged by dimensions, names and the filing's own dates."""
    def dims(*pairs):
        return F.array(*[F.struct(F.lit(a).alias("axis"), F.lit(m).alias("member")) for a, m in pairs]).cast("array<struct<axis:string,member:string>>")

    d = F.to_date("o_orderdate")
    shapes = [dims(), dims((AXIS, SOLO)), dims((AXIS, GROUP)), dims((AXIS, SOLO), (AXIS, GROUP)), dims(("segment", "x")), dims((AXIS, "unknown"))]
    dimensions = shapes[5]
    for i, s in enumerate(shapes[:5]):
        dimensions = F.when(F.col(KEY) % 6 == i, s).otherwise(dimensions)
    solo_name = (F.col(KEY) % 6 == 1) != (F.col(KEY) % 13 == 0)
    rows = table(spark, sf_dir, "orders").select(
        KEY, F.concat(F.lit("CurrentYearDuration"), F.when(solo_name, rules.SOLO_SUFFIX).otherwise("")).alias("context_id"), d.alias("start"), F.date_add(d, 364).alias("end"), F.lit(None).cast("date").alias("instant"), dimensions.alias("dimensions"),
        F.when(F.col(KEY) % 17 == 0, "E99999").when(F.col(KEY) % 19 == 0, "E00001-000").otherwise("E00001").alias("entity"), F.lit("E00001").alias("dei_entity"), (F.col(KEY) % 7 != 0).alias("dei_consolidated"), d.alias("dei_year_start"), F.date_add(d, F.when(F.col(KEY) % 11 == 0, 365).otherwise(364)).alias("dei_year_end"),
    )
    out = rules.judge_contexts(rows, AXIS, {SOLO: "standalone", GROUP: "consolidated"})
    return out.select(KEY, "period_kind", "period_class", "scope", "context_reason", "context_warning", F.col("fiscal_year_start").cast("string").alias("fiscal_year_start"))


_SCOPE_SQL = """WITH a AS (SELECT o_orderkey AS k, o_orderkey % 6 AS s, CAST(o_orderdate AS DATE) AS d FROM orders),
b AS (SELECT *, CASE WHEN k % 17 = 0 THEN 'context_entity_mismatch' WHEN s = 3 THEN 'scope_ambiguous' WHEN s NOT IN (1, 2) AND k % 7 = 0 THEN 'scope_unverified' WHEN s IN (0, 1, 2) AND k % 13 = 0 THEN 'context_scope_name_mismatch' END AS r FROM a),
c AS (SELECT *, CASE WHEN r IS NULL THEN CASE WHEN s > 3 THEN 'unsupported_dimensions' WHEN k % 11 = 0 THEN 'context_dei_period_mismatch' END END AS w FROM b)
SELECT k AS o_orderkey, CASE WHEN r IS NULL THEN 'duration' END AS period_kind, CASE WHEN r IS NULL AND s < 4 THEN 'annual' END AS period_class, CASE WHEN r IS NULL THEN CASE WHEN s = 1 THEN 'standalone' ELSE 'consolidated' END END AS scope, r AS context_reason, w AS context_warning, CASE WHEN r IS NULL AND s < 4 THEN CAST(d AS VARCHAR) END AS fiscal_year_start FROM c"""


def units(spark, sf_dir):
    """Measures as JPY, shares, JPY/share, or nothing that a rule knows."""
    def some(*x):
        return F.array(*[F.lit(v) for v in x]).cast("array<string>")

    top = F.when(F.col(KEY) % 4 == 0, some("m")).when(F.col(KEY) % 4 == 1, some("s")).when(F.col(KEY) % 4 == 2, some("m", "s")).otherwise(some("s", "m"))
    low = F.when(F.col(KEY) % 3 == 0, some()).when(F.col(KEY) % 3 == 1, some("s")).otherwise(some("m"))
    return table(spark, sf_dir, "orders").select(KEY, rules.unit_of(top, low, "m", "s").alias("unit"))


_UNIT_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 12 = 0 THEN 'JPY' WHEN o_orderkey % 4 = 1 AND o_orderkey % 3 = 0 THEN 'shares' WHEN o_orderkey % 4 = 0 AND o_orderkey % 3 = 1 THEN 'JPY/share' END AS unit FROM orders"


def price_projection(spark, sf_dir):
    """Order lines as daily rows: closes, factors, and when they were known by channel."""
    li, s = table(spark, sf_dir, "lineitem"), F.col("l_suppkey")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    close = F.when(s % 11 == 0, "").when(s % 13 == 0, "n/a").otherwise(F.col("l_quantity").cast("int").cast("string"))
    o = F.when(s % 22 == 0, "").otherwise("1")
    rows = li.select(s, day.alias("Date"), F.col("l_partkey").cast("string").alias("Code"), *[o.alias(c) for c in ("O", "H", "L", "Vo", "Va")], close.alias("C"), F.lit("1.0").alias("AdjFactor"), F.lit("0").alias("ExRT"), F.col("l_linestatus").alias("file"))
    prices = market.project_prices(rows)
    channels = [("F", "PASS", "bulk_csv", "/equities/bars/daily", "1"), ("O", "PASS", "bulk_csv", "/fins/summary", "1"), ("O", "BLOCKED", None, None, None)]
    mine = rows.select(F.to_date("Date").alias("day"), "Code", "file", F.when(s % 5 == 0, "0").otherwise("1").alias("sha256"), F.lit(None).alias("available_at"), F.lit(None).alias("missing_reason"))
    known = market.price_availability(mine, spark.createDataFrame(channels, "file string, status string, channel string, endpoint string, file_sha256 string"))
    a = prices.groupBy("day", "missing_reason", "trading_status").agg(F.count("*").alias("n"), F.sum("close").cast("bigint").alias("closes"))
    b = known.groupBy("day", "missing_reason").agg(F.count("*").alias("n"), F.max((F.unix_timestamp("available_at") / 3600).cast("bigint")).alias("closes")).select("day", "missing_reason", F.lit("availability").alias("trading_status"), "n", "closes")
    return a.union(b).withColumn("day", F.col("day").cast("string"))


_PRICE_SQL = """WITH a AS (SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, CASE WHEN l_suppkey % 11 <> 0 AND l_suppkey % 13 = 0 THEN 'invalid_market_number' ELSE 'daily_row_publication_time_not_recorded' END AS missing_reason, CASE WHEN l_suppkey % 22 = 0 THEN 'no_trade_reason_unknown' ELSE 'intraday_status_not_provided' END AS trading_status, CASE WHEN l_suppkey % 11 <> 0 AND l_suppkey % 13 <> 0 THEN CAST(l_quantity AS INTEGER) END AS c FROM lineitem)
SELECT day, missing_reason, trading_status, count(*) AS n, CAST(sum(c) AS BIGINT) AS closes FROM a GROUP BY ALL
UNION ALL SELECT day, r, 'availability', count(*), max(CASE WHEN r IS NULL THEN date_diff('day', DATE '1970-01-01', CAST(day AS DATE)) * 24 + 24 - 9 END) FROM (SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, CASE WHEN l_linestatus <> 'F' OR l_suppkey % 5 = 0 THEN 'acquisition_channel_unknown' END AS r FROM lineitem) GROUP BY day, r"""

def bulk_channels(spark, sf_dir):
    """Orders as files, a data set for each customer: which came by the bulk channel, by reason."""
    o, c, k = table(spark, sf_dir, "orders"), F.col("o_custkey"), F.col("o_orderkey")
    name = F.concat(F.lit("set_"), c)
    files = o.select(name.alias("dataset"), k.cast("string").alias("file"), k.alias("source_key"), (k % 1000).alias("bytes"), F.sha2(k.cast("string"), 256).alias("sha256"))
    listing = o.where((c % 7 != 0) | (k % 3 != 0)).select(name.alias("dataset"), k.alias("key"), F.when((c % 11 == 0) & (k % 2 == 0), -1).otherwise(k % 1000).alias("size"))
    listing = listing.union(listing.where("key % 97 = 0"))
    sets = o.select(c, name.alias("dataset")).distinct()
    manifests = sets.select("dataset", F.when(c % 13 == 0, "api").otherwise("bulk").alias("mode"), F.when(c % 17 == 0, "/set").otherwise(F.concat(F.lit("/set/"), c)).alias("endpoint"), F.lit("a").alias("list_sha256"), F.when(c % 19 == 0, "b").otherwise("a").alias("listed_sha256"))
    out = market.bulk_channels(manifests.where("mode is not null and dataset not like '%9'"), files, listing)
    return out.groupBy("status", "missing_reason").agg(F.count("*").alias("n"), F.count("file_sha256").alias("hashes"), F.min("endpoint").alias("endpoint"))


_CHANNEL_SQL = """WITH f AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderkey % 1000 AS b FROM orders), l0 AS (SELECT c, k, CASE WHEN c % 11 = 0 AND k % 2 = 0 THEN -1 ELSE b END AS s FROM f WHERE c % 7 <> 0 OR k % 3 <> 0),
l AS (SELECT c, k, count(*) AS n, min(s) AS s FROM (SELECT * FROM l0 UNION ALL SELECT * FROM l0 WHERE k % 97 = 0) GROUP BY 1, 2),
t AS (SELECT c, bool_and(coalesce(n = 1 AND s = b, false)) AS tied FROM f LEFT JOIN l USING (c, k) GROUP BY 1),
m AS (SELECT DISTINCT c, CASE WHEN c % 13 = 0 OR c % 17 = 0 THEN 'acquisition_channel_unknown' WHEN c % 19 = 0 THEN 'bulk_list_integrity_failed' WHEN NOT tied THEN 'bulk_channel_file_mismatch' END AS r FROM t WHERE c % 10 <> 9)
SELECT CASE WHEN r IS NULL THEN 'PASS' ELSE 'BLOCKED' END AS status, r AS missing_reason, count(*) AS n, count(*) FILTER (r IS NULL) AS hashes, min(CASE WHEN r IS NULL THEN '/set/' || c END) AS endpoint FROM f JOIN m USING (c) GROUP BY r"""

PATHS = ["a/b.csv", "/a", "../a", "a/../b", "c:\\a", "", "a\\..\\b", "a..b/c"]


def locators_valid(spark, sf_dir):
    """Locators by path, size, hashes and index."""
    sha = F.sha2(F.col(KEY).cast("string"), 256)
    ok = contracts.locator_valid(pick(PATHS, F.col(KEY)), F.col(KEY) % 9, F.when(F.col(KEY) % 10 == 0, F.upper(sha)).otherwise(sha), F.when(F.col(KEY) % 7 == 0, F.lit(None).cast("string")).otherwise(sha), F.col(KEY) % 5)
    return table(spark, sf_dir, "orders").select(KEY, ok.alias("valid"))


_LOCATOR_SQL = f"SELECT o_orderkey, {picked([True, False, False, False, False, False, False, True], KEY)} AND o_orderkey % 9 > 0 AND o_orderkey % 10 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 5 >= 1 AS valid FROM orders"


def metadata_availability(spark, sf_dir):
    """When a filing's metadata was known: the latest of submit and edits, unknown with a conflict or an unknown edit."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.when(F.col("l_suppkey") % 23 != 0, F.col("l_shipdate")).alias("t"))).alias("e"))
    o = table(spark, sf_dir, "orders").join(li, F.col("l_orderkey") == F.col(KEY), "left")
    edits = F.coalesce(F.transform("e", lambda x: x["t"].cast("timestamp")), F.array().cast("array<timestamp>"))
    conflicts = F.when(F.col(KEY) % 29 == 0, F.array(F.lit("revision_parent_ambiguous"))).otherwise(F.array().cast("array<string>"))
    return o.select(KEY, F.date_format(rules.metadata_availability(F.col("o_orderdate").cast("timestamp"), edits, conflicts), "yyyy-MM-dd").alias("known"))


_METADATA_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 29 <> 0 AND NOT coalesce(bool_or(l_suppkey % 23 = 0), false) THEN strftime(greatest(CAST(o_orderdate AS TIMESTAMP), coalesce(max(CAST(l_shipdate AS TIMESTAMP)), CAST(o_orderdate AS TIMESTAMP))), '%Y-%m-%d') END AS known FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate"""


def status_events(spark, sf_dir):
    """Daily rows as status events: when each was known, and whether it takes the document away."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    rows = e.select(F.col("user_id").alias("doc_id"), (k % 7 == 0).cast("int").cast("string").alias("withdrawal_status"), (k % 5 == 0).cast("int").cast("string").alias("edit_status"), F.lit("0").alias("disclosure_status"), F.when(k % 35 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm")).alias("operated"), F.date_format("ts", "yyyy-MM-dd").alias("submitted"))
    out = rules.status_events(rows)
    return out.select("doc_id", F.size("events").cast("bigint").alias("events"), F.size(F.filter("events", lambda x: x["blocked_reason"].isNotNull())).cast("bigint").alias("blocked"), F.size(F.filter("events", lambda x: x["available_at"].isNull())).cast("bigint").alias("unknown"), F.unix_timestamp(F.array_max(F.transform("events", lambda x: x["available_at"]))).alias("last"))


_STATUS_SQL = """WITH x AS (SELECT user_id AS doc_id, event_id AS k, event_id % 7 = 0 AS b, event_id % 7 = 0 OR event_id % 5 = 0 AS op, CAST(floor(epoch(ts) / 60) * 60 AS BIGINT) AS m, CAST(epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS BIGINT) AS d FROM events),
y AS (SELECT doc_id, b, CASE WHEN op THEN CASE WHEN k % 35 <> 0 THEN m + 60 - 32400 END ELSE d + 86400 - 32400 END AS t FROM x)
SELECT doc_id, count(*) AS events, count(*) FILTER (b) AS blocked, count(*) FILTER (t IS NULL) AS unknown, max(t) AS last FROM y GROUP BY 1"""

FAILURES = ["source_byte_integrity_failed", "file_changed", "ambiguous_versions", "bad_document_id", "local_file_not_available", "size_limit_reached", "else", None]


def failure_classes(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(contracts.failure_class(pick(FAILURES, F.col(KEY))).alias("class")).groupBy("class").agg(F.count("*").alias("n"))


_FAILURE_SQL = f"SELECT {picked(['byte_integrity_failed', 'byte_integrity_failed', 'identifier_ambiguous', 'identifier_ambiguous', 'raw_missing', 'raw_size_limit', 'local_archive_contract_failed', None], KEY)} AS class, count(*) AS n FROM orders GROUP BY 1"


def sample_categories(spark, sf_dir):
    """Challenge categories of orders, counted: from metadata, with lines as their listing events and customers as entities, and from structure."""
    o, li, k = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), F.col("l_orderkey")
    rows = li.join(o.withColumnRenamed(KEY, "l_orderkey"), "l_orderkey")
    code = F.when(k % 19 != 0, F.when(F.col("l_suppkey") % 3 == 0, "130A").when(F.col("l_suppkey") % 3 == 1, "7203"))
    events = rows.select(k.alias("doc_id"), F.to_date("l_shipdate").alias("day"), F.col("l_linenumber").alias("seq"), F.date_add(F.to_date("o_orderdate"), 30).alias("submit_day"), F.when(F.col("o_custkey") % 9 != 0, F.col("o_custkey").cast("string")).otherwise("").alias("entity"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("l_returnflag")).otherwise("x").alias("name"), code.alias("code"), F.when(F.col("l_linenumber") == 4, "130").otherwise("120").alias("doc_type"), F.when(F.col("l_quantity") > 45, "p").otherwise("").alias("parent_id"), F.array(F.lit("0"), F.when(F.col("l_tax") > 0.06, "1")).alias("statuses"))
    files = li.where(k % 23 != 0).select(k.alias("doc_id"), F.floor(F.col("l_extendedprice") * 30).cast("bigint").alias("bytes"))
    files = files.union(o.where(F.col(KEY) % 29 == 0).select(F.col(KEY), F.lit(1).cast("bigint")))
    meta = sampling.metadata_categories(events, files).select(F.explode("cats").alias("category"))
    profile = rows.groupBy(k.alias("doc_id"), "o_orderdate").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.when(F.col("l_partkey") % 2 == 0, "OperatingSegmentsAxis").otherwise("ScopeAxis"), F.when(F.col("l_suppkey") % 5 == 0, "NonConsolidatedMember").otherwise(F.concat(F.col("l_returnflag"), F.lit("Member")))))), lambda d: F.struct(d["col1"].alias("axis"), d["col2"].alias("member"))).alias("dimensions"),
        F.max(F.col("l_discount") > 0.09).alias("loss_fact"), F.max(F.col("l_linenumber") == 3).alias("shared_tag"), F.count_distinct("l_linestatus").alias("members"), F.array_compact(F.array(F.max(F.when(F.col("l_tax") > 0.07, "raw_missing")))).alias("failures"), F.max(F.to_date("l_shipdate")).alias("last"))
    kind = F.col("doc_id") % 5
    dei = F.create_map(F.lit("AccountingStandardsDEI"), F.array(F.when(kind < 2, "Japan GAAP").when(kind == 2, "IFRS").otherwise("US GAAP")), F.lit("WhetherConsolidatedFinancialStatementsArePreparedDEI"), F.array(F.when(kind == 0, "false").when(kind < 4, "true")), F.lit("CurrentFiscalYearStartDateDEI"), F.array(F.date_sub(F.to_date("o_orderdate"), 300).cast("string")),
        F.lit("CurrentFiscalYearEndDateDEI"), F.when(F.col("doc_id") % 31 == 0, F.array(F.lit("soon"))).when(F.col("doc_id") % 37 == 0, F.array(F.lit("2000-01-01"), F.lit("2001-01-01"))).otherwise(F.array(F.col("last").cast("string"))), F.lit("IndustryCodeDEI"), F.array(F.when(F.col("doc_id") % 41 == 0, "BNK").when(F.col("doc_id") % 43 == 0, "REIT")))
    structure = sampling.structure_categories(profile.withColumn("dei", dei)).select(F.explode("cats").alias("category"))
    return meta.union(structure).groupBy("category").agg(F.count("*").alias("n"))


_CATEGORY_SQL = """WITH e AS (SELECT l_orderkey AS k, CAST(l_shipdate AS DATE) AS day, l_linenumber AS seq, CAST(o_orderdate AS DATE) + 30 AS sub, CASE WHEN o_custkey % 9 <> 0 THEN o_custkey END AS e, CASE WHEN o_custkey % 2 = 0 THEN l_returnflag ELSE 'x' END AS name,
  CASE WHEN l_orderkey % 19 <> 0 THEN CASE l_suppkey % 3 WHEN 0 THEN '130A' WHEN 1 THEN '7203' END END AS code, l_linenumber = 4 AS amended, l_quantity > 45 AS parent, l_tax > 0.06 AS odd FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
f AS (SELECT k, max(b) AS b FROM (SELECT l_orderkey AS k, floor(l_extendedprice * 30) AS b FROM lineitem WHERE l_orderkey % 23 <> 0 UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_orderkey % 29 = 0) GROUP BY 1),
x AS (SELECT e.* FROM e WHERE k IN (SELECT k FROM f)),
h AS (SELECT e, count(DISTINCT code) AS codes, count(DISTINCT name) AS names FROM x WHERE e IS NOT NULL GROUP BY 1),
p AS (SELECT k, bool_or(amended) AS amended, bool_or(parent) AS parent, bool_or(odd) AS odd FROM x GROUP BY 1),
c AS (SELECT k, code, e FROM x QUALIFY row_number() OVER (PARTITION BY k ORDER BY CASE WHEN day = sub THEN 0 ELSE 1 END, day, seq, code NULLS FIRST) = 1),
m AS (SELECT unnest([CASE WHEN amended THEN 'amended_report' END, CASE WHEN parent THEN 'parent_document' END, CASE WHEN odd THEN 'unusual_status' END, CASE WHEN c.k IS NOT NULL AND code IS NULL THEN 'security_code_null' END, CASE WHEN code = '130A' THEN 'alpha_security_code' END, CASE WHEN codes > 1 THEN 'multiple_security_codes' END,
  CASE WHEN names > 1 THEN 'name_history' END, CASE WHEN b >= 2097152 THEN 'large_zip' END]) AS category FROM f LEFT JOIN p ON p.k = f.k LEFT JOIN c ON c.k = f.k LEFT JOIN h ON h.e = c.e),
d AS (SELECT l_orderkey AS k, CASE WHEN l_partkey % 2 = 0 THEN 'OperatingSegmentsAxis' ELSE 'ScopeAxis' END AS axis, CASE WHEN l_suppkey % 5 = 0 THEN 'NonConsolidatedMember' ELSE l_returnflag || 'Member' END AS member, * FROM lineitem),
s AS (SELECT k, CAST(o_orderdate AS DATE) - 300 AS a, CAST(max(l_shipdate) AS DATE) AS b, bool_or(member LIKE '%NonConsolidatedMember%') AS solo, count(DISTINCT CASE WHEN axis LIKE '%Segment%' THEN member END) AS segments, bool_or(l_discount > 0.09) AS loss, bool_or(l_linenumber = 3) AS shared, count(DISTINCT l_linestatus) AS members, bool_or(l_tax > 0.07) AS failed FROM d JOIN orders ON o_orderkey = k GROUP BY k, o_orderdate),
t AS (SELECT unnest([CASE WHEN k % 5 < 2 THEN 'jp_gaap' WHEN k % 5 = 2 THEN 'ifrs' END, CASE WHEN k % 5 BETWEEN 1 AND 3 THEN 'consolidated' END, CASE WHEN k % 5 = 0 OR solo THEN 'non_consolidated' END, CASE WHEN loss THEN 'loss_fact' END, CASE WHEN k % 31 <> 0 AND k % 37 <> 0 AND b - a NOT BETWEEN 363 AND 366 THEN 'fiscal_period_change_cue' END,
  CASE WHEN k % 41 = 0 THEN 'financial' WHEN k % 43 = 0 THEN 'reit' END, CASE WHEN segments > 1 THEN 'multiple_segments' END, CASE WHEN members > 1 THEN 'multiple_xbrl_members' END, CASE WHEN shared THEN 'same_tag_multiple_contexts' END, CASE WHEN failed THEN 'screening_failure' END]) AS category FROM s)
SELECT category, count(*) AS n FROM (SELECT * FROM m UNION ALL SELECT * FROM t) WHERE category IS NOT NULL GROUP BY 1"""


def dimension_compare(spark, sf_dir):
    """Two contexts' dimensions in any order: equal, another scope, another context."""
    def dim(a, m):
        return F.struct(a.alias("axis"), m.alias("member"))

    a = F.array(dim(F.lit("x"), F.lit("1")), dim(pick(["scope", "y"], F.col(KEY)), F.lit("2")))
    b = F.array(dim(pick(["scope", "y"], F.col(KEY)), pick(["2", "3", "2"], F.col(KEY))), dim(F.lit("x"), F.lit("1")))
    return table(spark, sf_dir, "orders").select(KEY, reconcile.dimensions_difference(a, b, "scope").alias("difference"))


_DIMENSION_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'scope_difference' ELSE 'context_difference' END END AS difference FROM orders"


def json_safe(spark, sf_dir):
    """Decimals, dates and instants as texts."""
    rows = table(spark, sf_dir, "orders").select(KEY, F.col("o_totalprice").cast("decimal(20,2)").alias("amount"), F.to_date("o_orderdate").alias("day"), F.col("o_orderdate").cast("timestamp").alias("at"))
    return contracts.json_safe(rows)


_SAFE_SQL = "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS VARCHAR) AS amount, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S') AS at FROM orders"


def standard_errors(spark, sf_dir):
    """Roots of customers' order variances; one order has none, and a negative one is no zero."""
    v = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(F.floor("o_totalprice").cast("bigint")).alias("s"), F.count("*").alias("n"))
    variance = F.when(F.col("n") > 1, F.col("s").cast("double") * F.when(F.col("o_custkey") % 7 == 0, -1).otherwise(1))
    root, reason = contracts.checked_standard_error(variance)
    return v.select("o_custkey", F.round(root, 6).alias("root"), reason.alias("reason"))


_ERROR_SQL = """SELECT o_custkey, CASE WHEN n > 1 AND o_custkey % 7 <> 0 THEN round(sqrt(CAST(s AS DOUBLE)), 6) END AS root, CASE WHEN n < 2 OR o_custkey % 7 = 0 THEN 'invalid_variance' END AS reason FROM (SELECT o_custkey, sum(CAST(floor(o_totalprice) AS BIGINT)) AS s, count(*) AS n FROM orders GROUP BY 1)"""


def observation_contract(spark, sf_dir):
    """Observations that break the rules for keys and rows, by rule."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    at = F.col("ts").cast("timestamp")
    value = F.when(k % 3 != 0, F.when(k % 59 == 0, "inf").otherwise("1.5"))
    dims = F.when(k % 31 == 0, F.array(F.struct(F.lit("b").alias("axis"), F.lit("1").alias("member")), F.struct(F.lit("a").alias("axis"), F.lit("1").alias("member")))).otherwise(F.array(F.struct(F.lit("a").alias("axis"), F.lit("1").alias("member"))))
    rows = e.select(
        k.alias("record_id"), F.lit("s").alias("source_id"), F.col("event_type").alias("series_id"), F.lit("d").alias("source_document_id"), F.when(k % 43 != 0, "l").alias("source_locator"), F.when(k % 41 != 0, "e").alias("entity_id"), F.lit("m").alias("metric_id"), F.lit("c").alias("scope"), F.lit("JP GAAP").alias("accounting_standard"), F.lit("JPY").alias("unit"),
        F.to_date("ts").alias("period_start"), F.date_add(F.to_date("ts"), F.when(k % 37 == 0, -1).otherwise(0)).alias("period_end"), F.when(k % 47 == 0, "month").otherwise("instant").alias("period_kind"), dims.alias("dimensions"), (k % 19 - 1).alias("revision"), value.alias("value"), F.when((k % 3 == 0) & (k % 53 != 0), "parse_failed").alias("missing_reason"),
        F.when(k % 5 != 0, at).alias("available_at"), F.when(k % 10 != 0, "exact").otherwise("unknown").alias("availability_basis"), at.alias("recorded_at"), F.when(k % 61 == 0, "guess").when(k % 4 == 0, "derived").otherwise("reported").alias("representation"), F.lit("structured").alias("extraction_method"), F.lit("source_tied").alias("verification"), F.sha2(k.cast("string"), 256).alias("source_artifact_sha256"),
        F.when(k % 67 != 0, F.lit(False)).alias("synthetic"), F.when(k % 71 == 0, "withdrawn").otherwise("active").alias("state"), F.when(k % 8 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("i"))).alias("input_ids"),
    )
    return validate.observation_contract(rows).select(F.explode("violations").alias("violation")).groupBy("violation").agg(F.count("*").alias("n"))


_CONTRACT_SQL = """WITH e AS (SELECT event_id AS k FROM events), x AS (SELECT unnest(list_filter([
 CASE WHEN k % 41 = 0 THEN 'Fact key fields may not be empty' END, CASE WHEN k % 37 = 0 THEN 'Reversed fiscal interval' END, CASE WHEN k % 47 = 0 THEN 'Unknown period kind' END, CASE WHEN k % 47 <> 0 AND k % 37 = 0 THEN 'Instant facts must use one date' END, CASE WHEN k % 31 = 0 THEN 'Dimensions must be sorted' END,
 CASE WHEN k % 43 = 0 THEN 'Provenance identifiers are required' END, CASE WHEN k % 19 = 0 THEN 'Revision must be a nonnegative integer' END, CASE WHEN (k % 5 = 0) <> (k % 10 = 0) THEN 'Unknown timing must have no available_at' END, CASE WHEN k % 3 <> 0 AND k % 59 = 0 THEN 'Values must be finite Decimal or None' END,
 CASE WHEN k % 3 = 0 AND k % 53 = 0 THEN 'Null requires a reason; a value must not have one' END, CASE WHEN k % 71 = 0 THEN 'Withdrawal is a tombstone, not a numeric zero' END, CASE WHEN k % 61 = 0 THEN 'Unknown representation' END, CASE WHEN k % 67 = 0 THEN 'synthetic must be an explicit boolean' END, CASE WHEN k % 61 <> 0 AND k % 8 = 0 THEN 'Derived values need input lineage' END], lambda c: c IS NOT NULL)) AS violation FROM e)
SELECT violation, count(*) AS n FROM x GROUP BY 1"""

_PARTS = {
    strict_numbers: _NUMBERS_SQL, scalar_equality: _EQUAL_SQL, strict_instants: _INSTANT_SQL, content_ids: _IDS_SQL, semantic_keys: _SEMANTIC_SQL, periods: _PERIOD_SQL, scopes: _SCOPE_SQL, units: _UNIT_SQL, price_projection: _PRICE_SQL, bulk_channels: _CHANNEL_SQL,
    locators_valid: _LOCATOR_SQL, metadata_availability: _METADATA_SQL, status_events: _STATUS_SQL, failure_classes: _FAILURE_SQL, sample_categories: _CATEGORY_SQL, dimension_compare: _DIMENSION_SQL, json_safe: _SAFE_SQL, standard_errors: _ERROR_SQL, observation_contract: _CONTRACT_SQL,
}
QUERIES = {f.__name__: f for f in _PARTS}
ORACLES = {f.__name__: sql for f, sql in _PARTS.items()}
