"""What the findings of round 3 name, each as small as it shows."""

import datetime as dt
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from test_queries import SF, TABLES, cells

from tidemark.operators import sampling


def agrees(spark, path, name, tables=TABLES) -> bool:
    """Whether a query and its SQL say the same of the tables in `path`; the others are the smallest ones."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from '{path}/{t}.parquet'")
    got, want = entry.queries()[name](spark, str(path)).toPandas(), con.execute(entry.oracle_sql()[name]).fetchdf()
    return sorted(got.columns) == sorted(want.columns) and cells(got) == cells(want)


def test_events_of_one_day_and_number(spark):
    day = dt.date(2024, 1, 1)
    rows = [("a", day, 1, None, "2"), ("a", day, 1, None, None), ("a", day, 1, None, "1"), ("b", day, 1, day, "2"), ("b", day, 1, day, "1")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id string, day date, seq int, submit_day date, code string").coalesce(1)
        assert {r["doc_id"]: r["code"] for r in sampling.canonical_event(df).collect()} == {"a": None, "b": "1"}


@pytest.mark.parametrize("name", ["inventory", "sample_categories"])
def test_repeated_lines(spark, tmp_path, name):
    """Lines of one day and number that differ otherwise, in both orders."""
    for i, order in enumerate(("asc", "desc")):
        path = tmp_path / str(i)
        path.mkdir()
        con = duckdb.connect()
        con.execute(f"copy (select * from '{SF}/orders.parquet' limit 300) to '{path}/orders.parquet' (format parquet)")
        con.execute(f"copy (select * replace (1 as l_linenumber, timestamp '1996-01-01' as l_shipdate, case l_suppkey % 3 when 0 then 'A' when 1 then 'N' else 'R' end as l_returnflag) from '{SF}/lineitem.parquet' where l_orderkey < 300 order by l_partkey {order}, l_suppkey {order}) to '{path}/lineitem.parquet' (format parquet)")
        assert agrees(spark, path, name, ("orders", "lineitem"))


@pytest.fixture(scope="module")
def shared_codes(tmp_path_factory):
    """The smallest tables twice, with customers whose numbers differ by 100,000 and who so have one code."""
    path = tmp_path_factory.mktemp("codes")
    con = duckdb.connect()
    for name, keys in (("customer", {"c_custkey": 100000}), ("orders", {"o_orderkey": 100003, "o_custkey": 100000})):
        moved = ", ".join(f"cast({k} + i * {n} as bigint) as {k}" for k, n in keys.items())
        con.execute(f"copy (select * replace ({moved}) from '{SF}/{name}.parquet', range(2) t(i)) to '{path}/x.parquet' (format parquet)")
        con.execute(f"copy (select * exclude (i) from '{path}/x.parquet') to '{path}/{name}.parquet' (format parquet)")
    return path


@pytest.mark.parametrize("name", ["dated_plans", "dated_join", "pit_join_reasons", "interval_join"])
def test_customers_that_share_a_code(spark, shared_codes, name):
    assert agrees(spark, shared_codes, name, ("customer", "orders"))


def test_rows_of_an_archive_come_in_lists():
    """A row for each element of the fields of RAW, some at a time, whatever is nested in whatever."""
    import io
    import zipfile

    from tidemark.sources import filings

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.xbrl", '<r xmlns:i="http://www.xbrl.org/2003/instance" xmlns:u="urn:u"><i:unit id="u"><i:divide><i:unitNumerator><i:measure>u:a</i:measure></i:unitNumerator></i:divide><i:measure>c</i:measure></i:unit><u:e contextRef="1">&#65;<!-- b -->C<u:f contextRef="2"/>D</u:e></r>')
    (rows,) = filings._elements(out.getvalue())
    assert [len(r) for r in rows] == [24, 24, 24]
    assert rows[0][:5] == ("unit", "a.xbrl", 1, None, "u") and rows[0][17:19] == (["{urn:u}a"], [])
    assert [(r[3], r[2], r[9], r[11]) for r in rows[1:]] == [("{urn:u}f", 7, False, None), ("{urn:u}e", 6, True, "AC")]


def test_lineage_drops_what_was_judged(spark, capsys):
    """No exchange after the facts' join carries what only that join needs."""

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entry.queries()["dated_lineage"](spark, SF).explain(mode="formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    inputs = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    later = [x for x in inputs if "price_source#" in x and "f_there#" in x]
    assert later and not any("xbrl#" in x for x in later)


def test_reuse_is_counted_without_pairs(spark, capsys):
    from tidemark.operators import identity

    t = dt.datetime(2024, 1, 1)
    seen = [("c", "a", 0), ("c", "a", 5), ("c", "b", 1), ("c", "d", 2), ("c", None, 0), ("c", "e", None), (None, "a", 0), ("x", "a", 0)]
    anchors = spark.createDataFrame([(c, e, None if n is None else t + dt.timedelta(n)) for c, e, n in seen], "code string, entity_id string, available_at timestamp")
    asks = [("c", "a", 0, 0), ("c", "a", 1, 0), ("c", "a", 2, 1), ("c", "b", 1, 1), ("c", "b", 9, 2), ("c", "z", 9, 3), ("c", None, 9, 0), ("c", "a", None, 0), (None, "a", 9, 0), ("y", "a", 9, 0)]
    asked = spark.createDataFrame([(i, c, e, None if n is None else t + dt.timedelta(n)) for i, (c, e, n, _) in enumerate(asks)], "i int, code string, entity_id string, decision_at timestamp")
    out = identity.code_reuse_conflict(asked, anchors, ["i"])
    assert [r["conflicts"] for r in out.orderBy("i").collect()] == [x[3] for x in asks]
    out.explain(mode="formatted")
    assert "keys [1]: [code#" not in capsys.readouterr().out


def test_interval_join_reads_its_rows_once(spark, capsys):
    """The plan doesn't hold the sessions' walk again for every table that rows are joined to."""
    entry.queries()["interval_join"](spark, SF).explain(mode="formatted")
    told = capsys.readouterr().out
    scans = len(re.findall(r"\n\(\d+\) Scan parquet", told))
    assert scans <= 12, scans


def test_views_of_families_that_grow_need_no_instants(spark, monkeypatch):
    """Random families, ordered in time or not, are viewed as at each decision; the ordered ones without a view of every instant."""
    import random

    from test_sweeps import DAY, FACT, T0, documents, fact

    from tidemark.operators import revisions

    r, day = random.Random(5), lambda n: None if n is None else T0 + n * DAY
    docs, rows = [], []
    for i in range(60):
        own, ordered = [], i % 3 > 0
        for j in range(r.randint(1, 6)):
            at = r.choice([None, 3]) if r.random() < 0.08 else (2 * j if ordered else r.randint(0, 12))
            parent = r.choice(own[-2:]) if own and r.random() < 0.9 else r.choice([None, None, "gone"])
            events = [(day(r.choice([None, 3, 7, 9])), r.choice(["withdrawn", None])) for _ in range(r.choice([0, 0, 1, 2]))]
            docs.append({"doc_id": f"d{i}-{j}", "parent_id": parent, "entity_id": "e" if r.random() < 0.95 else "f", "available_at": day(at), "retrieved_at": day(r.randint(0, 9)), "events": events, "failure": "lost" if r.random() < 0.1 else None, "doc_type": "130" if parent else r.choice(["120", "120", "130"]), "incomplete": r.random() < 0.05})
            own.append(f"d{i}-{j}")
            rows += [fact(f"{own[-1]}-{n}", own[-1], r.choice("jkl"), value=r.choice([None, "1", "2"]), at=day(r.choice([None, 0, 4, 8, 11])), verification=r.choice(["source_tied"] * 5 + ["no"])) for n in range(r.randint(0, 4))]
    kept = [d for d in docs if int(d["doc_id"][1:].split("-")[0]) % 3 > 0 and d["available_at"] != T0 + 3 * DAY and d["available_at"]]
    made = documents(spark, *docs)
    facts = spark.createDataFrame(rows, FACT)
    times = [T0 + k * DAY + x * dt.timedelta(microseconds=1) for k in range(0, 13) for x in (0, 1)]
    decisions = spark.createDataFrame([(str(t), t, T0 + 90 * DAY) for t in times], "decision_id string, cutoff timestamp, snapshot timestamp")
    name = ["decision_id", "doc_id", "fact_id", "key", "value", "missing_reason"]
    for how in ({}, {"latest": False}):
        log = revisions.view_log(facts, made, T0 + 90 * DAY, **how)
        want = sorted(map(str, revisions.fact_view(facts, made, decisions, **how).select(name).collect()))
        assert sorted(map(str, revisions.views(log, decisions.select("decision_id", F.col("cutoff").alias("decision_at"))).select(name).collect())) == want and len(want) > 1000
        assert log.groupBy(log.columns[:6] + ["from_at"]).count().where("count > 1").isEmpty()

    def none(*args):
        raise AssertionError("viewed by instants")

    monkeypatch.setattr(revisions, "_viewed", none)
    whole = documents(spark, *[d for d in kept if not d["parent_id"] or any(k["doc_id"] == d["parent_id"] for k in kept)])
    assert revisions.view_log(facts, whole, T0 + 90 * DAY).count() > 100


def test_ends_of_lineage_stay_out_of_the_rounds(spark, monkeypatch):
    """Nodes that no edge leaves are told from what is before them; only edges between others are searched for cycles."""
    from tidemark.operators import lineage

    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("a", "e"), ("s", "s"), ("s", "t"), ("t", "u"), ("v", "w"), ("w", "x")], "src string, dst string")
    searched, levels = [], lineage.levels

    def watched(nodes, inner):
        searched.extend(tuple(r) for r in inner.collect())
        return levels(nodes, inner)

    monkeypatch.setattr(lineage, "levels", watched)
    assert {r["node"] for r in lineage.cyclic(edges).collect()} == {"b", "c", "d", "s", "t", "u"}
    assert set(searched) == {("a", "b"), ("b", "c"), ("c", "b"), ("s", "s"), ("s", "t"), ("v", "w")}


def plans(monkeypatch, module) -> list[str]:
    """The plans of what a module stores from here on."""
    seen, cut = [], module.cut

    def watched(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(module, "cut", watched)
    return seen


def test_rounds_of_a_closure_send_nothing_through_the_driver(spark, monkeypatch):
    from tidemark.operators import graph

    seen = plans(monkeypatch, graph)
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "e")], "src string, dst string")
    got = graph.reachable(spark.createDataFrame([(0, "a"), (1, "d")], "origin int, node string"), edges)
    assert sorted(map(tuple, got.collect())) == [(0, "a", 0), (0, "b", 1), (0, "c", 2), (1, "d", 0), (1, "e", 1)]
    assert sum("Join" in p for p in seen) >= 3 and not any("Broadcast" in p for p in seen)


def test_pairs_are_counted_without_joins(spark):
    from tidemark.operators import reconcile

    rows = [("g", "a", "d", None, "s", "x", "u", "k", "1"), ("g", "b", "d", None, "s", "x", "u", "k", "1.0"), ("g", "c", "e", "r", "s", "x", "u", "k", "1"), ("h", "d", "d", "r", "s", "x", "u", "k", "1")]
    df = spark.createDataFrame(rows, "g string, fact_id string, doc_id string, root string, scope string, standard string, unit string, key string, value string")
    got = reconcile.pair_counts(df, ["g"])
    assert sorted(tuple(r) for r in got.collect()) == [("g", ["exact_match"], 1), ("g", ["unresolved"], 2)]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_fingerprints_hold_no_file_as_one_value(spark, tmp_path):
    """A file larger than a value may be, here made small, and a name that a URI would write otherwise."""
    import hashlib

    from tidemark.sources import filings

    texts = {"a b%20.bin": b"x" * 5000, "c.bin": b"y"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text)
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, 1000)
    try:
        got = {r["path"].rpartition("/")[2]: (r["sha256"], r["size"]) for r in filings.fingerprints(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset(limit)
    assert got == {name: (hashlib.sha256(text).hexdigest(), len(text)) for name, text in texts.items()}


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_view_reads_its_facts_once(spark, tmp_path):
    """What the winner of a chain has and what only those before it have come from one pass over the facts."""
    from test_sweeps import DAY, FACT, T0, documents, fact

    from tidemark.operators import revisions

    docs = documents(spark, {"doc_id": "a"}, {"doc_id": "b", "parent_id": "a", "available_at": T0 + DAY}, {"doc_id": "c", "available_at": T0})
    rows = [fact("a1", "a", "gone"), fact("a2", "a", "kept", value="1"), fact("b1", "b", "kept", value="2"), fact("b2", "b", "late", at=T0 + 20 * DAY), fact("c1", "c", value="1"), fact("c2", "c", value="1.0"), fact("c3", "c", "j"), fact("c4", "c", "j", value="17")]
    spark.createDataFrame(rows, FACT).write.parquet(str(tmp_path / "facts_alone"))
    at = spark.createDataFrame([("d", T0 + 9 * DAY, T0 + 90 * DAY)], "decision_id string, cutoff timestamp, snapshot timestamp")
    view = revisions.fact_view(spark.read.parquet(str(tmp_path / "facts_alone")), docs, at)
    got = {(r["doc_id"], r["fact_id"], r["key"]): r["missing_reason"] for r in view.collect()}
    assert got[("b", None, "gone")] == "metric_absent_in_latest_revision" and got[("b", "b1", "kept")] is None and got[("b", None, "late")] == "fact_not_yet_available"
    assert not any(doc == "a" for doc, _, _ in got)
    assert plan_of(view).count("Relation [fact_id") == 1


def test_pit_join_makes_its_view_once(spark):
    assert "Relation [o_orderkey" not in plan_of(entry.queries()["pit_join"](spark, SF))  # the facts read orders, prices don't


def test_look_ups_are_not_spread_over_histories(spark):
    """An asked row meets its identifier's history as one array, so no aggregate over the asked rows follows."""
    from tidemark.operators import identity

    day = dt.date(2024, 1, 1)
    history = spark.createDataFrame([("s", "v", o, day, to, day, None) for o, to in (("a", dt.date(2024, 2, 1)), ("b", None), ("a", None))], "scheme string, value string, owner string, valid_from date, valid_to date, recorded_from date, recorded_to date")
    asked = spark.createDataFrame([(1, "s", "v", day), (2, "s", "v", dt.date(2023, 1, 1)), (3, "s", "w", day)], "k int, scheme string, value string, day date").withColumn("known_at", F.col("day"))
    out = identity.identifier_lookup(asked, history, ["k"])
    assert {r["k"]: r["missing_reason"] for r in out.collect()} == {1: "identifier_owner_ambiguous", 2: "identifier_owner_missing", 3: "identifier_owner_missing"}
    assert "Aggregate [k#" not in plan_of(out)


def test_a_comparison_judges_values_once(spark):
    from tidemark.functions.contracts import scalar_equal
    from tidemark.operators import reconcile

    o = spark.createDataFrame([("o1", "t", "u", "17", False), ("o2", "s", "u", "1e2", False)], "origin_id string, tag string, unit string, value string, is_nil boolean")
    rows = spark.createDataFrame([("r1", "t", "u", "17.00"), ("r2", "t", "u", "18"), ("r3", "s", "u", "100"), ("r4", "x", "u", "1"), ("r5", "t", "w", "017")], "row_id string, tag string, unit string, value string")
    out = reconcile.compare_facts(rows, o, [("tag", "extraction_difference", "original_element_not_found")])
    got = {r["row_id"]: (r["verdict"], r["reason"]) for r in out.collect()}
    assert got == {"r1": ("exact_match", None), "r2": ("extraction_difference", "provider_value_differs"), "r3": ("exact_match", None), "r4": ("extraction_difference", "original_element_not_found"), "r5": ("unit_difference", "unit_ref_differs")}
    once = plan_of(rows.select(scalar_equal(F.col("value"), F.col("unit")))).count("transform(")
    assert plan_of(out).count("transform(") < once


def test_numbers_as_they_stand_equal_those_that_are_cleaned(spark):
    from tidemark.functions.contracts import canonical_number, market_number, scalar_equal

    texts = ["0", "00", "7", "007", "7.", "7.0", "7.10", "+7", "-7", "-0", "1" * 18, "1" * 18 + ".0", "1" * 29, "1" * 30, "0.123456789", "0.1234567890", "7\n", "٧", "7e0", "", "n/a", "0.0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("spaced", F.concat(F.lit(" "), "t", F.lit(" ")))
    value, reason = market_number(F.col("t"))
    value2, reason2 = market_number(F.col("spaced"))
    rows = df.where("t not in ('', '7\\n')").select("t", value.alias("a"), reason.alias("b"), value2.alias("c"), reason2.alias("d"), canonical_number(F.col("t")).alias("e"), canonical_number(F.col("spaced")).alias("f")).collect()
    assert all(r["a"] == r["c"] and r["b"] == r["d"] and r["e"] == r["f"] for r in rows) and len(rows) == len(texts) - 2
    pairs = df.alias("x").crossJoin(df.alias("y")).where("x.t not in ('', '7\\n', 'n/a', '٧') and y.t not in ('', '7\\n', 'n/a', '٧')")
    assert pairs.where(scalar_equal(F.col("x.t"), F.col("y.t")) != scalar_equal(F.col("x.spaced"), F.col("y.spaced"))).isEmpty()
    # plain ones are told before any pattern is taken apart
    assert plan_of(df.select(value)).index("\\z") < plan_of(df.select(value)).index("transform(")


def test_white_space_is_dropped_without_patterns(spark):
    from tidemark.functions.contracts import UNICODE_SPACE
    from tidemark.operators import reconcile

    df = spark.range(0x3100).where("id > 0 and not (id between 55296 and 57343)").select(F.col("id").alias("row_id"), F.concat(F.lit("a"), F.decode(F.expr("unhex(lpad(hex(id), 4, '0'))"), "UTF-16BE"), F.lit("b")).alias("text"))
    own = df.withColumn("k", F.lit(1))
    got = {r["row_id"] for r in reconcile.text_tie(own, own.withColumnRenamed("row_id", "origin_id"), ["k"]).where("n > 1").collect()}
    assert got == {r["row_id"] for r in df.where(F.regexp_replace("text", UNICODE_SPACE, "") == "ab").collect()} and len(got) == 29
    blank = spark.createDataFrame([(0, " \t\u3000", 1), (1, "", 1), (2, None, 1)], "row_id int, text string, k int")
    tied = reconcile.text_tie(blank, blank.withColumnRenamed("row_id", "origin_id"), ["k"])
    assert tied.isEmpty() and "regexp_replace" not in plan_of(tied)


def test_prices_of_a_day_are_aggregated_by_hash(spark):
    """The least row of a day was a struct, which only sorting aggregates hold."""
    from tidemark.operators import calendar

    at = dt.datetime(2024, 1, 1)
    prices = spark.createDataFrame([(1, dt.date(2022, 12, 30), 5, 1, "reported_unadjusted", at, True), (2, dt.date(2023, 5, 1), 6, None, "reported_unadjusted", at, True), (3, dt.date(2023, 5, 1), 6, 1, "reported_unadjusted", at, True), (3, dt.date(2023, 5, 1), 7, 1, "adjusted", at, True)], "code int, day date, close int, factor int, basis string, available_at timestamp, projected boolean")
    asked = spark.createDataFrame([(k, k, dt.datetime(2024, 3, 1)) for k in (1, 2, 3, 4)], "k int, code int, decision_at timestamp")
    out = calendar.price_asof(asked, prices, ["k"])
    assert {r["k"]: (r["close"], r["price_reason"]) for r in out.collect()} == {1: (5, None), 2: (None, "corporate_action_basis_unknown"), 3: (None, "price_observation_ambiguous"), 4: (None, "price_missing")}
    assert "min(struct(" not in plan_of(out)


@pytest.mark.parametrize("name", ["asof_blocked", "asof_system_replay"])
def test_selection_sorts_only_what_is_asked_for(spark, name):
    """Reasons are told before rows are sorted, so the texts that they come from aren't carried."""
    plan = plan_of(entry.queries()[name](spark, SF)).splitlines()
    first = {text: min(i for i, line in enumerate(plan) if text in line) for text in ("Window [", "source_tied")}
    assert first["Window ["] < first["source_tied"]
