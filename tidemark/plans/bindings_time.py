"""Queries of as-of selection, sessions, prices and identities."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import contracts
from ..operators import asof, calendar, identity
from .tables import CALENDAR_SQL, OBSERVATIONS_SQL, observations, table
from .tables import calendar as calendar_of

DECISION, SNAPSHOT = "2024-01-10", "2030-01-01"


def _asof(spark, sf_dir, policy):
    return asof.select_asof(observations(spark, sf_dir), DECISION, SNAPSHOT, policy, ["metric"])


def asof_select(spark, sf_dir):
    """The usable winners of every series at one decision."""
    return _asof(spark, sf_dir, asof.Policy()).where("missing_reason is null").select("record_id", "series_id", "revision")


def asof_blocked(spark, sf_dir):
    """What is blocked at the same decision, and why."""
    return _asof(spark, sf_dir, asof.Policy()).where("missing_reason is not null").select("record_id", "series_id", "missing_reason")


def asof_system_replay(spark, sf_dir):
    return _asof(spark, sf_dir, asof.Policy(replay="system_replay")).select("record_id", "series_id", "missing_reason")


def asof_many_decisions(spark, sf_dir):
    """All decisions at the starts of the events' weeks in one job."""
    weeks = table(spark, sf_dir, "events").select(F.date_trunc("week", "ts").alias("decision_at")).distinct().select(F.date_format("decision_at", "yyyy-MM-dd").alias("decision_id"), "decision_at")
    return asof.select_asof_many(observations(spark, sf_dir), weeks, SNAPSHOT).select("decision_id", "record_id", "series_id", "missing_reason")


_RANKED = """
s AS (SELECT *, max(available_at IS NULL) OVER (PARTITION BY {by}) AS unknown FROM ({rows}) x),
best AS (SELECT * FROM s WHERE NOT unknown AND available_at < {decision} QUALIFY rank() OVER (PARTITION BY {by} ORDER BY k DESC, recorded_at DESC) = 1),
j AS (SELECT {id} record_id, series_id, k AS revision, CASE WHEN k % 23 = 0 THEN 'withdrawn' WHEN k % 17 = 0 THEN 'parse_failed' WHEN k % 29 = 0 THEN 'representation_not_allowed'
        WHEN k % 31 = 0 THEN 'extraction_method_not_allowed' WHEN k % 37 = 0 THEN 'unverified' END AS missing_reason FROM best
      UNION ALL SELECT {id} record_id, series_id, k, 'unknown_availability_blocks_series' FROM s WHERE unknown AND available_at IS NULL)
"""


def _asof_sql(where: str, columns: str, replay: bool = False) -> str:
    rows = f"SELECT * FROM o WHERE recorded_at <= TIMESTAMP '{SNAPSHOT}'" + (f" AND recorded_at <= TIMESTAMP '{DECISION}'" if replay else "")
    return f"WITH {OBSERVATIONS_SQL}, {_RANKED.format(by='series_id', rows=rows, decision=f"TIMESTAMP '{DECISION}'", id='')} SELECT {columns} FROM j {where}"


_MANY_SQL = f"""WITH {OBSERVATIONS_SQL}, w AS (SELECT DISTINCT date_trunc('week', ts)::TIMESTAMP AS decision_at FROM events),
{_RANKED.format(by="decision_id, series_id", rows=f"SELECT o.*, strftime(decision_at, '%Y-%m-%d') AS decision_id, decision_at FROM o JOIN w ON available_at IS NULL OR available_at < decision_at WHERE recorded_at <= TIMESTAMP '{SNAPSHOT}'", decision="decision_at", id="decision_id,")}
SELECT decision_id, record_id, series_id, missing_reason FROM j"""


def availability_bound(spark, sf_dir):
    """Upper bounds of publication in UTC from local days and, for most, times."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    time = F.when(k % 3 != 0, F.format_string("%02d:%02d", (k % 24).cast("int"), (k % 60).cast("int")))
    at = contracts.availability_bound(F.to_date("o_orderdate"), time, F.make_dt_interval(F.lit(0), F.lit(0), (k % 90).cast("int")))
    return o.select("o_orderkey", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("bound"))


_AVAILABILITY_SQL = """SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 3 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP)
  ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o_orderkey % 60 AS INTEGER)) END
  - INTERVAL 9 HOUR + to_minutes(CAST(o_orderkey % 90 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS bound FROM orders"""


def precision_bound(spark, sf_dir):
    """Timestamps written as day, minute, second or not at all readable."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    form = [F.date_format("o_orderdate", f) for f in ("yyyy-MM-dd", "yyyy-MM-dd HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd")]
    text = F.when(k % 4 == 0, form[0]).when(k % 4 == 1, form[1]).when(k % 4 == 2, form[2]).otherwise(form[3])
    return o.select("o_orderkey", F.date_format(contracts.precision_bound(text), "yyyy-MM-dd HH:mm:ss").alias("bound"))


_PRECISION_SQL = """SELECT o_orderkey, strftime(CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP)
  WHEN 1 THEN date_trunc('minute', CAST(o_orderdate AS TIMESTAMP)) + INTERVAL 1 MINUTE WHEN 2 THEN date_trunc('second', CAST(o_orderdate AS TIMESTAMP)) END - INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS bound FROM orders"""


def _asked(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", (F.date_trunc("day", "o_orderdate") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))).alias("threshold"))


def _dated(df, column):
    return df.withColumn(column, F.col(column).cast("string"))


def next_session(spark, sf_dir):
    return _dated(calendar.next_session(_asked(spark, sf_dir), calendar_of(spark, sf_dir), ["o_orderkey"], "1996-01-01"), "entry_day")


def previous_session(spark, sf_dir):
    return _dated(calendar.previous_session(_asked(spark, sf_dir), calendar_of(spark, sf_dir), ["o_orderkey"]), "prior_day")


def _session_sql(steps: str, fits: str, none: str, name: str, early: str) -> str:
    return f"""WITH {CALENDAR_SQL}, q AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 24 AS hour, unnest(range({steps})) AS step FROM orders),
k AS (SELECT q.*, d + CAST(step AS INTEGER) AS day, CASE WHEN coalesce(n, 0) <> 1 THEN 'gap' WHEN h IN ('0', '3') THEN 'skip' WHEN h <> '1' THEN 'odd' WHEN {fits} THEN 'hit' ELSE 'skip' END AS kind FROM q LEFT JOIN cal ON cal.day = d + CAST(step AS INTEGER)),
f AS (SELECT o_orderkey, any_value(d) AS d, arg_min(kind, abs(step)) FILTER (kind <> 'skip') AS kind, arg_min(day, abs(step)) FILTER (kind <> 'skip') AS day FROM k GROUP BY o_orderkey)
SELECT o_orderkey, CASE WHEN kind = 'hit' AND NOT ({early}) THEN CAST(day AS VARCHAR) END AS {name}, CASE WHEN {early} THEN 'session_rule_period_unsupported' WHEN kind = 'gap' THEN 'trading_calendar_missing_or_ambiguous' WHEN kind = 'odd' THEN 'session_time_unverified' WHEN kind IS NULL THEN '{none}' END AS session_reason FROM f"""


def price_asof(spark, sf_dir):
    """The last price before the local day of each order's decision, at every hour of it, for each part in it."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    prices = li.select(F.col("l_partkey").alias("code"), F.to_date("l_shipdate").alias("day"), F.when(F.col("l_suppkey") % 7 != 0, F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("close"), F.when(F.col("l_suppkey") % 11 == 0, 0).otherwise(1).alias("factor"), F.when(F.col("l_suppkey") % 13 == 0, "adjusted").otherwise("reported_unadjusted").alias("basis"), F.date_add(F.to_date("l_shipdate"), (F.col("l_suppkey") % 40).cast("int")).cast("timestamp").alias("available_at"), (F.col("l_suppkey") % 17 != 0).alias("projected"), F.when(F.col("l_suppkey") % 3 != 0, F.date_add(F.to_date("l_shipdate"), (F.col("l_suppkey") % 5 * 20).cast("int")).cast("timestamp")).alias("basis_at"))
    asked = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", F.col("l_partkey").alias("code"), (F.date_add(F.to_date("o_orderdate"), 60).cast("timestamp") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))).alias("decision_at")).distinct()
    return _dated(calendar.price_asof(asked.withColumn("part", F.col("code")), prices, ["o_orderkey", "part"]), "price_day")


_PRICE_SQL = """WITH p AS (SELECT l_partkey AS code, CAST(l_shipdate AS DATE) AS day, count(*) AS n, min(l_suppkey) AS s, min(l_extendedprice) AS x FROM lineitem GROUP BY ALL),
a AS (SELECT DISTINCT o_orderkey, l_partkey AS part, CAST(CAST(o_orderdate AS DATE) + 60 AS TIMESTAMP) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS t FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
m AS (SELECT a.*, p.day, p.n, p.s, p.x FROM (SELECT *, CAST(t + INTERVAL 9 HOUR AS DATE) AS d FROM a) a ASOF LEFT JOIN p ON a.part = p.code AND a.d > p.day),
r AS (SELECT *, CASE WHEN day IS NULL THEN 'price_missing' WHEN n <> 1 THEN 'price_observation_ambiguous' WHEN s % 7 = 0 THEN 'price_missing' WHEN CAST(day + CAST(s % 40 AS INTEGER) AS TIMESTAMP) >= t THEN 'price_not_yet_available'
  WHEN s % 13 = 0 THEN CASE WHEN s % 3 = 0 THEN 'adjusted_price_vintage_unknown' WHEN CAST(day + CAST(s % 5 * 20 AS INTEGER) AS TIMESTAMP) >= t THEN 'future_corporate_action_adjustment' ELSE 'adjusted_price_out_of_scope' END WHEN s % 11 = 0 THEN 'corporate_action_basis_unknown' WHEN s % 17 = 0 THEN 'price_projection_source_mismatch' END AS price_reason FROM m)
SELECT o_orderkey, part, CASE WHEN price_reason IS NULL THEN CAST(day AS VARCHAR) END AS price_day, CASE WHEN price_reason IS NULL THEN CAST(round(x * 100) AS BIGINT) END AS close, price_reason FROM r"""


def execution_outcome(spark, sf_dir):
    """What happened on an order's day to a code, from the rows of that day alone."""
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int")
    nothing = F.col("l_suppkey") % 9 == 0
    rows = li.select((F.col("l_partkey") % 20).alias("code"), F.to_date("l_shipdate").alias("day"), *[F.when(~nothing, v).alias(c) for c, v in (("o", q), ("h", q + F.col("l_linenumber")), ("l", q - 2), ("c", F.when(F.col("l_suppkey") % 8 == 0, q + 9).otherwise(q - 1)), ("vo", q), ("va", F.when(F.col("l_suppkey") % 10 == 0, None).otherwise(q)))], (F.col("l_partkey") % 6 != 0).alias("verified"))
    asked = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 20).alias("code"), F.to_date("o_orderdate").alias("day"))
    return calendar.execution_outcome(asked, rows, ["o_orderkey"])


_OUTCOME_SQL = """WITH r AS (SELECT l_partkey % 20 AS code, CAST(l_shipdate AS DATE) AS day, count(*) AS n, min(l_suppkey) AS s, min(l_partkey) AS p, min(CAST(l_quantity AS INTEGER)) AS q, min(l_linenumber) AS ln FROM lineitem GROUP BY ALL),
j AS (SELECT o_orderkey, n, CASE WHEN n IS NULL THEN 'entry_daily_row_missing' WHEN n > 1 THEN 'duplicate_entry_daily_rows' WHEN p % 6 = 0 THEN 'entry_source_unverified' WHEN s % 9 = 0 THEN NULL
  WHEN s % 10 = 0 OR q - 2 <= 0 THEN 'entry_partial_or_inconsistent_values' WHEN CASE WHEN s % 8 = 0 THEN q + 9 ELSE q - 1 END > q + ln THEN 'entry_price_inconsistent' END AS missing_reason, s
  FROM orders LEFT JOIN r ON r.code = o_custkey % 20 AND r.day = CAST(o_orderdate AS DATE))
SELECT o_orderkey, CASE WHEN missing_reason = 'entry_daily_row_missing' THEN 'price_unavailable' WHEN missing_reason IS NOT NULL THEN 'ambiguous' WHEN s % 9 = 0 THEN 'no_observed_trade' ELSE 'traded' END AS status, missing_reason FROM j"""


def identifier_lookup(spark, sf_dir):
    """Owners of a customer's identifier over half-open intervals in two times."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    own = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    day = F.to_date("o_orderdate")
    nxt = F.lead(day).over(own)
    history = o.select(F.lit("customer").alias("scheme"), F.col("o_custkey").alias("value"), F.concat(F.lit("owner"), (k % 50).cast("string")).alias("owner"), F.when(k % 43 != 0, day).alias("valid_from"), F.when(k % 13 == 0, F.date_add(nxt, 60)).otherwise(nxt).alias("valid_to"), F.date_add(day, (k % 30).cast("int")).alias("recorded_from"), F.when(k % 19 == 0, F.date_add(day, 40)).alias("recorded_to"))
    asked = o.select("o_orderkey", F.lit("customer").alias("scheme"), F.col("o_custkey").alias("value"), F.date_add(day, 10).alias("day"), F.date_add(day, 25).alias("known_at"))
    return identity.identifier_lookup(asked, history, ["o_orderkey"])


_LOOKUP_SQL = """WITH h AS (SELECT o_custkey AS v, 'owner' || (o_orderkey % 50) AS owner, CASE WHEN o_orderkey % 43 <> 0 THEN CAST(o_orderdate AS DATE) END AS a,
  lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) + CASE WHEN o_orderkey % 13 = 0 THEN 60 ELSE 0 END AS b, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS ra, CASE WHEN o_orderkey % 19 = 0 THEN CAST(o_orderdate AS DATE) + 40 END AS rb FROM orders),
g AS (SELECT o.o_orderkey, min(h.owner) AS lo, max(h.owner) AS hi FROM orders o LEFT JOIN h ON h.v = o.o_custkey AND a <= CAST(o_orderdate AS DATE) + 10 AND (b IS NULL OR CAST(o_orderdate AS DATE) + 10 < b) AND ra <= CAST(o_orderdate AS DATE) + 25 AND (rb IS NULL OR CAST(o_orderdate AS DATE) + 25 < rb) GROUP BY 1)
SELECT o_orderkey, CASE WHEN lo = hi THEN lo END AS owner, CASE WHEN lo IS NULL THEN 'identifier_owner_missing' WHEN lo <> hi THEN 'identifier_owner_ambiguous' END AS missing_reason FROM g"""


def security_resolution(spark, sf_dir):
    """Which of a supplier's mappings may be used from decision to entry."""
    s, day = F.col("s"), F.col("first")
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("s"), (F.col("l_partkey") % 4).alias("p")).agg(F.to_date(F.min("l_shipdate")).alias("first"), F.count("*").alias("n"))
    mappings = m.select(
        F.concat_ws("-", s.cast("string"), F.col("p").cast("string")).alias("mapping_id"), s.alias("entity_id"), F.when(F.col("n") % 37 == 0, None).otherwise(s).alias("issuer_entity_id"), F.col("p").cast("string").alias("security_id"),
        F.when(F.col("n") % 53 == 0, "x").otherwise((F.lit(1000) + F.col("p")).cast("string")).alias("code"), F.when(F.col("n") % 29 == 0, "BLOCKED").otherwise("PASS").alias("status"), F.lit(None).cast("string").alias("reason"), (F.col("n") % 31 != 0).alias("has_evidence"), day.cast("timestamp").alias("available_at"),
        F.add_months(day, 10 * F.col("p").cast("int")).alias("identifier_validity_from"), F.add_months(day, 10 * F.col("p").cast("int") + 14).alias("identifier_validity_to"), (F.col("n") % 41 != 0).alias("identifier_validity_verified"),
        F.add_months(day, 8 * F.col("p").cast("int")).alias("listing_from"), F.lit(None).cast("date").alias("listing_to"), F.lit(True).alias("listing_verified"))
    d = F.to_date("o_orderdate")
    asked = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 100 + 1).alias("entity_id"), d.cast("timestamp").alias("decision_at"), d.alias("decision_day"), F.date_add(d, 3).alias("entry_day"), F.when(F.col("o_orderkey") % 2 == 0, (F.lit(1000) + F.col("o_orderkey") % 4).cast("string")).alias("requested_code"))
    return identity.resolve_security(asked, mappings, ["o_orderkey"])


_SECURITY_SQL = """WITH m0 AS (SELECT l_suppkey AS s, l_partkey % 4 AS p, CAST(min(l_shipdate) AS DATE) AS first, count(*) AS n FROM lineitem GROUP BY ALL),
m AS (SELECT s || '-' || p AS id, s, n, first, CASE WHEN n % 53 = 0 THEN 'x' ELSE CAST(1000 + p AS VARCHAR) END AS code, CAST(first + to_months(CAST(10 * p AS INTEGER)) AS DATE) AS a, CAST(first + to_months(CAST(10 * p + 14 AS INTEGER)) AS DATE) AS b, CAST(first + to_months(CAST(8 * p AS INTEGER)) AS DATE) AS l FROM m0),
q AS (SELECT o_orderkey, o_orderkey % 100 + 1 AS e, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + 3 AS x, CASE WHEN o_orderkey % 2 = 0 THEN CAST(1000 + o_orderkey % 4 AS VARCHAR) END AS req FROM orders),
j AS (SELECT q.*, m.*, CASE WHEN id IS NULL THEN NULL WHEN code = 'x' THEN 'invalid_code' WHEN n % 29 = 0 THEN 'mapping_unverified' WHEN n % 31 = 0 THEN 'mapping_evidence_missing' WHEN n % 37 = 0 THEN 'issuer_role_unverified' WHEN first >= d THEN 'mapping_not_yet_available' WHEN n % 41 = 0 THEN 'identifier_validity_not_established' END AS error
  FROM q LEFT JOIN m ON m.s = q.e AND (req IS NULL OR req = code)),
i AS (SELECT *, CASE WHEN id IS NOT NULL AND error IS NULL THEN CASE WHEN NOT (a <= d AND d < b AND a <= x AND x < b) THEN 'code_not_valid_at_decision_or_entry' WHEN NOT (l <= d AND l <= x) THEN 'not_listed_at_decision_or_entry' END END AS idle FROM j),
g AS (SELECT o_orderkey, min(error) AS error, min(idle) AS idle, count(id) FILTER (error IS NULL AND idle IS NULL) AS n, min(id) FILTER (error IS NULL AND idle IS NULL) AS id FROM i GROUP BY 1),
r AS (SELECT *, CASE WHEN error IS NOT NULL THEN error WHEN n > 1 THEN 'ambiguous_security_mapping' WHEN n = 0 THEN coalesce(idle, 'security_mapping_not_available') END AS missing_reason FROM g)
SELECT o_orderkey, CASE WHEN missing_reason IS NULL THEN id END AS mapping_id, missing_reason FROM r"""


def trading_status(spark, sf_dir):
    o, k, d = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.to_date("o_orderdate")
    nxt = F.lead(d).over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    statuses = o.select(F.col("o_custkey").alias("security_id"), d.alias("valid_from"), F.when(k % 7 == 0, F.date_add(nxt, 90)).otherwise(nxt).alias("valid_to"), F.col("o_orderstatus").alias("status"), F.when(k % 47 != 0, F.date_add(d, (k % 4).cast("int"))).alias("available_at"))
    asked = o.select("o_orderkey", F.col("o_custkey").alias("security_id"), F.date_add(d, 5).alias("entry_day"), F.date_add(d, 2).alias("decision_at"))
    return identity.trading_status(asked, statuses, ["o_orderkey"]).drop("synthetic")


_STATUS_SQL = """WITH s AS (SELECT o_custkey AS c, CAST(o_orderdate AS DATE) AS a, lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) + CASE WHEN o_orderkey % 7 = 0 THEN 90 ELSE 0 END AS b, o_orderstatus AS st, CASE WHEN o_orderkey % 47 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER) END AS av FROM orders),
g AS (SELECT o_orderkey, CAST(any_value(o_orderdate) AS DATE) + 2 AS d, count(s.c) AS n, any_value(s.st) AS st, any_value(av) AS av, count(av) AS k FROM orders LEFT JOIN s ON s.c = o_custkey AND a <= CAST(o_orderdate AS DATE) + 5 AND (b IS NULL OR CAST(o_orderdate AS DATE) + 5 < b) GROUP BY 1),
r AS (SELECT *, CASE WHEN n = 0 THEN 'trading_status_missing' WHEN n > 1 THEN 'trading_status_ambiguous' WHEN k = 0 THEN 'time_precision_unknown' WHEN av >= d THEN 'trading_status_not_yet_available' END AS missing_reason FROM g)
SELECT o_orderkey, CASE WHEN missing_reason IS NULL THEN st END AS trading, missing_reason FROM r"""


def dated_mapping(spark, sf_dir):
    masters = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"), (F.col("l_partkey") % 20).alias("code"), F.col("l_returnflag").alias("product"), F.col("l_linestatus").alias("market"), (F.col("l_suppkey") % 10 != 0).alias("verified"))
    d = F.to_date("o_orderdate")
    asked = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 20).alias("code"), F.array(d, F.date_add(d, 3)).alias("required"), F.date_add(d, 1).alias("decision_day"))
    return identity.dated_mapping(asked, masters, ["o_orderkey"], ["N", "R"], ["O", "F"]).drop("synthetic")


_DATED_SQL = """WITH m AS (SELECT CAST(l_shipdate AS DATE) AS day, l_partkey % 20 AS code, count(*) AS n, min(l_returnflag) AS p, min(l_suppkey % 10 <> 0) AS v FROM lineitem GROUP BY ALL),
q AS (SELECT o_orderkey, o_custkey % 20 AS code, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + unnest([0, 3]) AS day FROM orders),
r AS (SELECT q.*, CASE WHEN n IS NULL THEN 'dated_master_missing_or_code_mismatch' WHEN n > 1 THEN 'dated_master_ambiguous' WHEN NOT v THEN 'master_source_unverified' WHEN p NOT IN ('N', 'R') THEN 'product_category_incompatible' END AS reason FROM q LEFT JOIN m ON m.day = q.day AND m.code = q.code)
SELECT o_orderkey, count(*) AS n_dates, count(*) FILTER (day <= d + 1) AS decision_dates, arg_min(reason, day) FILTER (reason IS NOT NULL) AS missing_reason FROM r GROUP BY 1"""


def code_reuse_conflict(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    rows = o.select("o_orderkey", (F.col("o_custkey") % 500).alias("code"), F.col("o_custkey").alias("entity_id"), F.col("o_orderdate").alias("decision_at"))
    return identity.code_reuse_conflict(rows, rows.withColumnRenamed("decision_at", "available_at"), ["o_orderkey"])


_REUSE_SQL = """WITH a AS (SELECT o_custkey AS c, min(o_orderdate) AS t FROM orders GROUP BY 1)
SELECT o_orderkey, count(a.c) AS conflicts FROM orders LEFT JOIN a ON a.c % 500 = o_custkey % 500 AND a.c <> o_custkey AND a.t < o_orderdate GROUP BY 1"""

QUERIES = {f.__name__: f for f in (asof_select, asof_blocked, asof_system_replay, asof_many_decisions, availability_bound, precision_bound, next_session, previous_session, price_asof, execution_outcome, identifier_lookup, security_resolution, trading_status, dated_mapping, code_reuse_conflict)}
ORACLES = {
    "asof_select": _asof_sql("WHERE missing_reason IS NULL", "record_id, series_id, revision"),
    "asof_blocked": _asof_sql("WHERE missing_reason IS NOT NULL", "record_id, series_id, missing_reason"),
    "asof_system_replay": _asof_sql("", "record_id, series_id, missing_reason", True),
    "asof_many_decisions": _MANY_SQL,
    "availability_bound": _AVAILABILITY_SQL,
    "precision_bound": _PRECISION_SQL,
    "next_session": _session_sql("0, 15", "step > 0 OR hour < 9", "entry_session_not_available_in_window", "entry_day", "d < DATE '1996-01-01'"),
    "previous_session": _session_sql("-15, 0", "true", "prior_session_not_available", "prior_day", "false"),
    "price_asof": _PRICE_SQL,
    "execution_outcome": _OUTCOME_SQL,
    "identifier_lookup": _LOOKUP_SQL,
    "security_resolution": _SECURITY_SQL,
    "trading_status": _STATUS_SQL,
    "dated_mapping": _DATED_SQL,
    "code_reuse_conflict": _REUSE_SQL,
}
