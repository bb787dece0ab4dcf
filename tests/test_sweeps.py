"""Sweeps, logs and graph depths against plain loops, and with keys that are large."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import asof, calendar, graph, identity, revisions, sweep
from test_operators import DAY, FACT, T0, chosen, documents, fact, obs

D0 = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else D0 + n * DAY


@pytest.mark.parametrize("few", [0, 2, 10**6])
def test_status_intervals(spark, few):
    r = random.Random(few)
    rows = [(f"s{i % 4}", day(a), day(r.choice([None, a + r.randrange(-1, 9)])), f"x{i % 5}", T0) for i in range(90) for a in [r.randrange(60)]]
    rows += [("s0", None, day(5), "never", T0), ("s1", day(1), day(1), "empty", T0)]
    asked = [(k, f"s{k % 5}", day(r.randrange(-2, 70)), T0 + DAY) for k in range(150)] + [(999, None, day(3), T0 + DAY)]
    got = {x["k"]: (x["trading"], x["missing_reason"]) for x in identity.trading_status(spark.createDataFrame(asked, "k int, security_id string, entry_day date, decision_at timestamp"), spark.createDataFrame(rows, "security_id string, valid_from date, valid_to date, status string, available_at timestamp"), ["k"], few).collect()}
    for k, s, d, _ in asked:
        held = [x for x in rows if x[0] == s and x[1] and x[1] <= d and (x[2] is None or d < x[2])]
        want = (None, "trading_status_missing") if not held else (None, "trading_status_ambiguous") if len(held) > 1 else (held[0][3], None)
        assert got[k] == want


@pytest.mark.parametrize("few", [0, 3, 10**6])
def test_owners_in_two_times(spark, few):
    r = random.Random(few)
    def end(a):
        return r.choice([None, a + r.randrange(1, 25)])
    rows = []
    for i in range(120):
        a, b = r.randrange(50), r.randrange(50)
        rows.append(("c", f"v{i % 5}", r.choice(["o1", "o2", "o3"]), day(a) if i % 17 else None, day(end(a)), day(b), day(end(b))))
    asked = [(k, "c", f"v{k % 6}", day(r.randrange(-3, 80)), day(r.randrange(-3, 80))) for k in range(250)]
    kind = "scheme string, value string, owner string, valid_from date, valid_to date, recorded_from date, recorded_to date"
    got = {x["k"]: (x["owner"], x["missing_reason"]) for x in identity.identifier_lookup(spark.createDataFrame(asked, "k int, scheme string, value string, day date, known_at date"), spark.createDataFrame(rows, kind), ["k"], few).collect()}
    for k, _, v, d, t in asked:
        owners = {x[2] for x in rows if x[1] == v and x[3] and x[3] <= d and (x[4] is None or d < x[4]) and x[5] <= t and (x[6] is None or t < x[6])}
        assert got[k] == ((None, "identifier_owner_missing") if not owners else (None, "identifier_owner_ambiguous") if len(owners) > 1 else (owners.pop(), None))


def test_a_key_of_many_intervals(spark):
    n = 100_000
    rows = spark.range(n).select(F.lit("hot").alias("security_id"), F.expr("date_add(date'1900-01-01', cast(id div 3 as int))").alias("valid_from"), F.expr("date_add(date'1900-01-01', cast(id div 3 + id % 2 as int))").alias("valid_to"), F.concat(F.lit("x"), "id").alias("status"), F.lit(T0).alias("available_at"))
    asked = spark.range(n).select(F.col("id").alias("k"), F.lit("hot").alias("security_id"), F.expr("date_add(date'1900-01-01', cast(id div 3 as int))").alias("entry_day"), F.lit(T0 + DAY).alias("decision_at"))
    got = {x["missing_reason"]: x["count"] for x in identity.trading_status(asked, rows, ["k"]).groupBy("missing_reason").count().collect()}
    # of three rows that begin on a day those of an odd id last it
    one = sum(1 for i in range(n) if sum(j % 2 for j in range(i // 3 * 3, min(n, i // 3 * 3 + 3))) == 1)
    assert got == {None: one, "trading_status_ambiguous": n - one}


def test_stretches_carry_on(spark):
    rows = [("a", i, 0, i) for i in range(0, 900, 3)] + [("b", 5, 0, 7)] + [(k, i, 1, 0) for k in "ab" for i in range(-5, 900, 7)]
    df = spark.createDataFrame(rows, "k string, p int, _side int, v bigint")
    got = {(r["k"], r["p"]): r["v"] for r in sweep.running_sums(df, ["k"], "p", ["v"], 50).where("_side = 1").collect()}
    assert got == {(k, p): sum(v for q, o, s, v in rows if q == k and s == 0 and o <= p) for k, p, s, _ in rows if s == 1}


def test_price_of_the_local_day(spark):
    prices = spark.createDataFrame([("c", D0 + DAY, 90, T0 - 400 * DAY), ("c", D0 + 2 * DAY, 100, dt.datetime(2024, 1, 3, 15))], "code string, day date, close int, available_at timestamp").withColumns({"factor": F.lit(1), "basis": F.lit("reported_unadjusted"), "projected": F.lit(True)})
    times = [dt.datetime(2024, 1, 3, 14, 59), dt.datetime(2024, 1, 3, 15, 0), dt.datetime(2024, 1, 3, 16), dt.datetime(2024, 1, 1, 15), dt.datetime(2024, 3, 9)]
    asked = spark.createDataFrame([(i, "c", t) for i, t in enumerate(times)], "k int, code string, decision_at timestamp")
    got = {r["k"]: (r["close"], r["price_reason"]) for r in calendar.price_asof(asked, prices, ["k"]).collect()}
    assert got == {0: (90, None), 1: (None, "price_not_yet_available"), 2: (100, None), 3: (None, "price_missing"), 4: (100, None)}


@pytest.mark.parametrize("replay", ["public_reconstruction", "system_replay"])
def test_winner_log_is_every_decision(spark, replay):
    r = random.Random(7)
    rows = [{"record_id": f"r{i}", "series_id": f"s{i % 6}", "revision": i // 6 % 4 * 10 + i % 7, "available_at": T0 + r.randrange(12) * DAY if i % 19 else None, "recorded_at": T0 + r.randrange(14) * DAY + i * dt.timedelta(seconds=1), "state": "withdrawn" if i % 9 == 0 else "active"} for i in range(70)]
    df = obs(spark, *rows)
    times = [T0 + k * DAY + x for k in range(-1, 16) for x in (dt.timedelta(0), dt.timedelta(hours=1))]
    policy = asof.Policy(replay=replay)
    many = asof.select_asof_many(df, spark.createDataFrame([(str(t), t) for t in times], "decision_id string, decision_at timestamp"), T0 + 30 * DAY, policy).collect()
    for t in times:
        want = {}
        for s in {x["series_id"] for x in rows}:
            own = [x for x in rows if x["series_id"] == s and (replay != "system_replay" or x["recorded_at"] <= t)]
            lost = [x for x in own if x["available_at"] is None]
            seen = [x for x in own if x["available_at"] and x["available_at"] < t]
            if lost:
                want |= {x["record_id"]: "unknown_availability_blocks_series" for x in lost}
            elif seen:
                best = max(seen, key=lambda x: (x["revision"], x["recorded_at"]))
                want[best["record_id"]] = "withdrawn" if best["state"] == "withdrawn" else None
        assert {x["record_id"]: x["missing_reason"] for x in many if x["decision_id"] == str(t)} == want
        if t.hour == 13:
            assert chosen(asof.select_asof(df, t, T0 + 30 * DAY, policy)) == want


def test_ties_and_drift_break_only_decisions_that_meet_them(spark):
    rows = obs(spark, {"record_id": "a"}, {"record_id": "b", "available_at": T0 + 5 * DAY}, {"record_id": "c", "revision": 1, "available_at": T0 + 9 * DAY})
    d = spark.createDataFrame([("x", T0 + DAY), ("y", T0 + 10 * DAY)], "decision_id string, decision_at timestamp")
    assert {x["record_id"] for x in asof.select_asof_many(rows, d, T0 + 90 * DAY).collect()} == {"a", "c"}
    with pytest.raises(Exception, match="Ambiguous revision"):
        asof.select_asof(rows, T0 + 6 * DAY, T0 + 90 * DAY).collect()


def test_many_decisions_make_no_row_too_many(spark):
    rows = obs(spark, *[{"record_id": f"{s}{i}", "series_id": s, "revision": i, "available_at": T0 + i * DAY} for s in "xy" for i in range(30)])
    d = spark.range(100_000).select(F.col("id").cast("string").alias("decision_id"), (F.lit(T0) + F.expr("make_dt_interval(0, 0, 0, id)") * 20).alias("decision_at"))
    assert asof.select_asof_many(rows, d, T0 + 90 * DAY).count() == 2 * 99_999


def test_view_log_is_every_view(spark):
    docs = documents(spark, {}, {"doc_id": "b", "parent_id": "a", "available_at": T0 + 5 * DAY, "events": [(T0 + 6 * DAY, "withdrawn"), (T0 + 8 * DAY, None)]}, {"doc_id": "c", "parent_id": "b", "available_at": T0 + 12 * DAY}, {"doc_id": "d", "parent_id": "b", "available_at": T0 + 15 * DAY},
                     {"doc_id": "p"}, {"doc_id": "q", "parent_id": "p", "available_at": T0 + DAY, "retrieved_at": T0 + 4 * DAY}, {"doc_id": "u", "available_at": None}, {"doc_id": "v", "parent_id": "w", "available_at": T0 + 2 * DAY}, {"doc_id": "w", "available_at": T0 + 7 * DAY}, {"doc_id": "x", "failure": "lost"}, {"doc_id": "late", "recorded_at": T0 + 400 * DAY})
    rows = [fact("f1", "a"), fact("f2", "a", "gone"), fact("f3", "b", value="2", at=T0 + 7 * DAY), fact("f4", "b", "j", at=None), fact("f5", "c", at=T0 + 13 * DAY), fact("f6", "c", value="3", at=T0 + 14 * DAY), fact("g1", "p"), fact("g2", "q", value=None, at=T0 + DAY), fact("g3", "q", "y", at=T0 + 3 * DAY, verification="no"), fact("u1", "u"), fact("v1", "v"), fact("x1", "x")]
    facts = spark.createDataFrame(rows, FACT)
    times = [T0 + k * DAY + x * dt.timedelta(microseconds=1) for k in (0, 2, 5, 7, 12, 14, 15) for x in (0, 1)]
    decisions = spark.createDataFrame([(str(t), t, T0 + 90 * DAY) for t in times], "decision_id string, cutoff timestamp, snapshot timestamp")
    for how in ({}, {"replay": "system_replay", "latest": False}):
        log = revisions.view_log(facts, docs, T0 + 90 * DAY, **how)
        name = ["decision_id", "doc_id", "fact_id", "key", "value", "missing_reason"]
        want = sorted(map(str, revisions.fact_view(facts, docs, decisions, **how).select(name).collect()))
        assert sorted(map(str, revisions.views(log, decisions.select("decision_id", F.col("cutoff").alias("decision_at"))).select(name).collect())) == want and want
        assert sorted(map(str, revisions.view_at(log, T0 + 6 * DAY).select(name[1:]).collect())) == sorted(map(str, revisions.fact_view(facts, docs, decisions.where(F.col("cutoff") == T0 + 6 * DAY), **how).select(name[1:]).collect()))


def depths(n, edges):
    parents = {}
    for a, b in edges:
        parents.setdefault(b, set()).add(a)
    out = {i: 0 for i in range(n) if i not in parents}
    while True:
        new = {b: 1 + max(out[a] for a in p) for b, p in parents.items() if b not in out and p <= out.keys()}
        if not new:
            return {i: out.get(i) for i in range(n)}
        out |= new


@pytest.mark.parametrize("seed", range(2))
def test_depths_with_several_parents(spark, seed):
    r = random.Random(seed)
    n = 60
    edges = [(a, b) for b in range(1, n) for a in r.sample(range(b), min(b, r.choice([0, 1, 1, 1, 2, 3])))]
    if seed % 2:
        edges += [(n - 1, n - 5), (n - 5, n - 1)]
    got = {x["node"]: x["depth"] for x in graph.levels(spark.range(n).withColumnRenamed("id", "node"), spark.createDataFrame(edges, "parent bigint, child bigint")).collect()}
    assert got == depths(n, edges)


def test_long_chain_with_one_more_parent_takes_few_rounds(spark, monkeypatch):
    written = []
    cut = graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: written.append(1) or cut(df))
    n = 10_000
    edges = spark.range(1, n).selectExpr("id - 1 parent", "id child").union(spark.createDataFrame([(17, 5000)], "parent bigint, child bigint"))
    got = graph.levels(spark.range(n).withColumnRenamed("id", "node"), edges)
    assert got.where("depth <> node").count() == 0 and got.where("depth is null").count() == 0 and len(written) < 60
