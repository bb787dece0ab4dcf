"""Operators at the edges that the bound queries don't reach."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.api import Evidence, company
from tidemark.operators import asof, calendar, coverage, facts, graph, identity, lineage, market, reconcile, revisions, sampling, validate
from tidemark.sources import filings, package
from tidemark.streaming import lists

T0 = dt.datetime(2024, 7, 1, 12)
DAY = dt.timedelta(days=1)
OBS = "record_id string, source_id string, series_id string, revision bigint, available_at timestamp, recorded_at timestamp, value string, value_reason string, state string, synthetic boolean, representation string, method string, verification string, metric string"


def obs(spark, *rows):
    base = dict(record_id="a", source_id="s", series_id="x", revision=0, available_at=T0, recorded_at=T0, value="1", value_reason=None, state="active", synthetic=False, representation="reported", method="structured", verification="source_tied", metric="m")
    names = [f.split()[0] for f in OBS.split(", ")]
    return spark.createDataFrame([tuple({**base, **r}[n] for n in names) for r in rows], OBS)


def chosen(df):
    return {r["record_id"]: r["missing_reason"] for r in df.collect()}


@pytest.mark.parametrize(
    "change, reason",
    [({}, None), ({"state": "withdrawn"}, "withdrawn"), ({"value": None, "value_reason": "nil"}, "nil"), ({"synthetic": True}, "synthetic_not_empirical"), ({"representation": "derived"}, "representation_not_allowed"), ({"method": "ocr"}, "extraction_method_not_allowed"), ({"verification": "none"}, "unverified"), ({"state": "withdrawn", "synthetic": True}, "withdrawn")],
)
def test_newest_revision_blocks_without_fallback(spark, change, reason):
    rows = obs(spark, {"record_id": "old"}, {"record_id": "new", "revision": 1, "available_at": T0 + DAY, **change})
    assert chosen(asof.select_asof(rows, T0 + 2 * DAY, T0 + 9 * DAY)) == {"new": reason}
    assert chosen(asof.select_asof(rows, T0 + DAY, T0 + 9 * DAY)) == {"old": None}  # not strictly before


def test_unknown_time_blocks_the_series(spark):
    rows = obs(spark, {"record_id": "a"}, {"record_id": "b", "revision": 1, "available_at": None}, {"record_id": "c", "series_id": "y"})
    assert chosen(asof.select_asof(rows, T0 + DAY, T0 + 9 * DAY)) == {"b": "unknown_availability_blocks_series", "c": None}
    late = obs(spark, {"record_id": "a"}, {"record_id": "b", "revision": 1, "available_at": None, "recorded_at": T0 + 20 * DAY})
    assert chosen(asof.select_asof(late, T0 + DAY, T0 + 9 * DAY)) == {"a": None}


@pytest.mark.parametrize("rows, message", [([{"record_id": "a"}, {"record_id": "a"}], "Duplicate record id"), ([{"record_id": "a"}, {"record_id": "b"}], "Ambiguous revision"), ([{"record_id": "a"}, {"record_id": "b", "revision": 1, "metric": "other"}], "changed semantic"), ([{"record_id": "a"}, {"record_id": "b", "revision": 1, "metric": None}], "changed semantic")])
def test_broken_contracts_fail(spark, rows, message):
    with pytest.raises(Exception, match=message):
        asof.select_asof(obs(spark, *rows), T0 + DAY, T0 + 9 * DAY, key=["metric"]).collect()


def test_system_replay_needs_recording(spark):
    rows = obs(spark, {"record_id": "a", "recorded_at": T0 + 5 * DAY})
    assert chosen(asof.select_asof(rows, T0 + DAY, T0 + 9 * DAY)) == {"a": None}
    assert chosen(asof.select_asof(rows, T0 + DAY, T0 + 9 * DAY, asof.Policy(replay="system_replay"))) == {}


def test_many_decisions_are_the_single_ones(spark):
    rows = obs(spark, *[{"record_id": f"{s}{i}", "series_id": s, "revision": i, "available_at": T0 + i * DAY, "value": None if i == 2 else "1", "value_reason": "nil"} for s in "xy" for i in range(4)])
    times = [T0 + k * DAY for k in range(6)]
    many = asof.select_asof_many(rows.repartition(3), spark.createDataFrame([(str(t), t) for t in times], "decision_id string, decision_at timestamp"), T0 + 30 * DAY).collect()
    for t in times:
        assert {r["record_id"]: r["missing_reason"] for r in many if r["decision_id"] == str(t)} == chosen(asof.select_asof(rows, t, T0 + 30 * DAY))


def test_status(spark):
    e = "array<struct<available_at:timestamp,blocked_reason:string>>"
    rows = [([(T0, "x")], "x"), ([(T0, "x"), (T0 + DAY, None)], None), ([(T0, "x"), (T0, None)], "ambiguous_status_events"), ([(None, None)], "unknown_status_time"), ([(T0 + 9 * DAY, "x")], None), ([], None)]
    df = spark.createDataFrame(rows, f"e {e}, want string")
    assert all(r[0] == r[1] for r in df.select(asof.latest_status(F.col("e"), F.lit(T0 + 3 * DAY)), "want").collect())


def test_sessions_stop_at_gaps(spark):
    day = dt.date(2024, 1, 1)
    cal = spark.createDataFrame([(day + i * DAY, h) for i, h in enumerate("1031200")] + [(day + 6 * DAY, "0")], "day date, hol_div string")
    asked = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 8)), (2, dt.datetime(2024, 1, 1, 9)), (3, dt.datetime(2024, 1, 4, 10)), (4, dt.datetime(2024, 1, 6)), (5, dt.datetime(2015, 1, 1))], "k int, threshold timestamp")
    got = {r["k"]: (str(r["entry_day"]), r["session_reason"]) for r in calendar.next_session(asked, cal, ["k"]).collect()}
    assert got == {1: ("2024-01-01", None), 2: ("2024-01-04", None), 3: ("None", "session_time_unverified"), 4: ("None", "trading_calendar_missing_or_ambiguous"), 5: ("None", "session_rule_period_unsupported")}
    back = {r["k"]: (str(r["prior_day"]), r["session_reason"]) for r in calendar.previous_session(asked.where("k in (2, 3)"), cal, ["k"]).collect()}
    assert back == {2: ("None", "trading_calendar_missing_or_ambiguous"), 3: ("2024-01-01", None)}


def test_components_and_levels(spark):
    nodes = spark.createDataFrame([(i,) for i in range(70)], "node bigint")
    chain = spark.createDataFrame([(i, i + 1) for i in range(39)] + [(50, 51), (51, 52), (52, 51)], "a bigint, b bigint")
    labels = {r["node"]: r["label"] for r in graph.components(nodes, chain).collect()}
    assert all(labels[i] == 0 for i in range(40)) and labels[45] == 45 and labels[52] == 50
    depth = {r["node"]: r["depth"] for r in graph.levels(nodes, chain.toDF("parent", "child")).collect()}
    assert depth[39] == 39 and depth[50] == 0 and depth[51] is None and depth[45] == 0
    top = {r["node"]: r["root"] for r in graph.roots(spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 9), (5, 4), (6, 7), (7, 6)], "node bigint, parent bigint")).collect()}
    assert top == {1: 1, 2: 1, 3: 1, 4: None, 5: None, 6: None, 7: None}


def documents(spark, *rows):
    base = dict(doc_id="a", parent_id=None, entity_id="e", available_at=T0, recorded_at=T0, retrieved_at=T0, doc_type="120", events=[], failure=None)
    kind = "doc_id string, parent_id string, entity_id string, available_at timestamp, recorded_at timestamp, retrieved_at timestamp, doc_type string, events array<struct<available_at:timestamp,blocked_reason:string>>, failure string"
    names = [f.split()[0] for f in kind.replace("available_at:timestamp,blocked", "b").split(", ")]
    return spark.createDataFrame([tuple({**base, **r}[n] for n in names) for r in rows], kind)


@pytest.mark.parametrize(
    "rows, reasons",
    [
        ([{}, {"doc_id": "b", "parent_id": "a", "available_at": T0 + DAY}], []),
        ([{}, {"doc_id": "b", "parent_id": "a"}], ["revision_time_order_invalid"]),
        ([{}, {"doc_id": "b", "parent_id": "a", "entity_id": "o", "available_at": T0 + DAY}], ["revision_entity_mismatch"]),
        ([{}, {"doc_id": "b", "parent_id": "a", "entity_id": None, "available_at": T0 + DAY}], ["revision_entity_unverified"]),
        ([{"parent_id": "z"}], ["revision_parent_missing"]),
        ([{"doc_type": "130"}], ["revision_parent_missing"]),
        ([{}, {"doc_id": "b", "parent_id": "a", "available_at": T0 + DAY}, {"doc_id": "c", "parent_id": "a", "available_at": T0 + DAY}], ["ambiguous_revision_branches"]),
        ([{"parent_id": "b", "available_at": None}, {"doc_id": "b", "parent_id": "a", "available_at": None}], ["revision_cycle"]),
    ],
)
def test_revision_problems(spark, rows, reasons):
    d = documents(spark, *rows, {"doc_id": "other"}).withColumn("parents", F.array("parent_id")).withColumns({"conflicts": F.array().cast("array<string>"), "incomplete": F.lit(False)})
    got = {r["doc_id"]: r for r in revisions.revision_graph(d).collect()}
    assert got["a"]["reasons"] == reasons and (got["a"]["root"] == "a") == (not reasons) and got["other"]["root"] == "other"


FACT = "fact_id string, doc_id string, key string, value string, value_reason string, verification string, representation string, synthetic boolean, available_at timestamp"


def view(spark, docs, rows, cutoff, **how):
    f = spark.createDataFrame(rows, FACT)
    d = spark.createDataFrame([("d", cutoff, T0 + 90 * DAY)], "decision_id string, cutoff timestamp, snapshot timestamp")
    return sorted(((r["doc_id"], r["fact_id"], r["missing_reason"]) for r in revisions.fact_view(f, docs, d, **how).collect()), key=str)


def fact(i, doc, key="k", value="1", at=T0, **change):
    base = dict(verification="source_tied", representation="reported", synthetic=False)
    base.update(change)
    return (i, doc, key, value, None if value else "nil", base["verification"], base["representation"], base["synthetic"], at)


def test_view_takes_the_leaf_known_at_the_time(spark):
    docs = documents(spark, {}, {"doc_id": "b", "parent_id": "a", "available_at": T0 + 5 * DAY})
    rows = [fact("f1", "a"), fact("f2", "a", "gone"), fact("f3", "b", value="2", at=T0 + 5 * DAY)]
    assert view(spark, docs, rows, T0 + 5 * DAY) == [("a", "f1", None), ("a", "f2", None)]
    got = view(spark, docs, rows, T0 + 6 * DAY)
    assert ("b", "f3", None) in got and ("b", None, "metric_absent_in_latest_revision") in got and len(got) == 2


def test_view_gates_are_ordered(spark):
    docs = documents(spark, {})
    for rows, want in (
        ([fact("x", "a", synthetic=True, value=None)], [("a", None, "synthetic_not_empirical")]),
        ([fact("x", "a", at=T0 + 50 * DAY)], [("a", None, "fact_not_yet_available")]),
        ([fact("x", "a", value=None), fact("y", "a")], [("a", "x", "nil")]),
        ([fact("x", "a", verification="no")], [("a", None, "unverified_facts")]),
        ([fact("x", "a", value="1.0"), fact("y", "a", value="1")], [("a", "x", None), ("a", "y", None)]),
        ([fact("x", "a", value="1"), fact("y", "a", value="2")], [("a", None, "conflicting_facts")]),
    ):
        assert sorted(view(spark, docs, rows, T0 + 9 * DAY), key=str) == sorted(want, key=str)


def test_a_future_branch_spoils_nothing_earlier(spark):
    docs = documents(spark, {}, {"doc_id": "b", "parent_id": "a", "available_at": T0 + DAY}, {"doc_id": "c", "parent_id": "a", "available_at": T0 + 8 * DAY})
    rows = [fact("f1", "a"), fact("f2", "b", at=T0 + DAY)]
    assert view(spark, docs, rows, T0 + 3 * DAY) == [("b", "f2", None)]
    assert {r[2] for r in view(spark, docs, rows, T0 + 9 * DAY)} == {"ambiguous_revision_branches"}


def test_security_errors_dominate(spark):
    names = "mapping_id entity_id issuer_entity_id security_id code status reason has_evidence available_at identifier_validity_from identifier_validity_to identifier_validity_verified listing_from listing_to listing_verified".split()
    good = dict(zip(names, ["m", "e", "e", "s", "1234", "PASS", None, True, T0, T0.date(), None, True, T0.date(), None, True]))
    kind = "mapping_id string, entity_id string, issuer_entity_id string, security_id string, code string, status string, reason string, has_evidence boolean, available_at timestamp, identifier_validity_from date, identifier_validity_to date, identifier_validity_verified boolean, listing_from date, listing_to date, listing_verified boolean"
    asked = spark.createDataFrame([(1, "e", T0 + 5 * DAY, (T0 + 5 * DAY).date(), (T0 + 6 * DAY).date(), None)], "k int, entity_id string, decision_at timestamp, decision_day date, entry_day date, requested_code string")

    def run(*changes):
        m = spark.createDataFrame([tuple({**good, **c}[n] for n in names) for c in changes], kind)
        return tuple(identity.resolve_security(asked, m, ["k"]).first())[1:]

    assert run({}) == ("m", None)
    assert run({}, {"mapping_id": "n", "status": "BLOCKED", "reason": "why"}) == (None, "why")
    assert run({}, {"mapping_id": "n"}) == (None, "ambiguous_security_mapping")
    assert run({"listing_to": (T0 + 6 * DAY).date()}) == (None, "not_listed_at_decision_or_entry")
    assert run({"entity_id": "x"}) == (None, "security_mapping_not_available")
    assert run({"available_at": T0 + 5 * DAY}) == (None, "mapping_not_yet_available")


def test_admission_takes_the_first_failing_check(spark):
    names = "qname rule_id rule_period rule_scopes rule_standard rule_unit dei_entity entity_id n_contexts context_reason n_units scope filing_standard context_warning period_kind available_day period_last unit nil has_transform decimals precision has_children text".split()
    good = dict(zip(names, ["q", "r", "duration", ["consolidated"], "JP GAAP", "JPY", "e", "e", 1, None, 1, "consolidated", "Japan GAAP", None, "duration", "2024-02-01", "2024-01-31", "JPY", None, False, "-3", None, False, " 12.50 "]))
    kind = "qname string, rule_id string, rule_period string, rule_scopes array<string>, rule_standard string, rule_unit string, dei_entity string, entity_id string, n_contexts int, context_reason string, n_units int, scope string, filing_standard string, context_warning string, period_kind string, available_day string, period_last string, unit string, nil string, has_transform boolean, decimals string, precision string, has_children boolean, text string"
    changes = [({}, None), ({"rule_id": None, "dei_entity": "x"}, "unknown_mapping"), ({"dei_entity": "x"}, "dei_identifier_unverified"), ({"n_contexts": 2}, "context_ambiguous"), ({"n_units": 0}, "unit_unknown"), ({"filing_standard": "IFRS"}, "accounting_standard_unverified"), ({"period_kind": "instant"}, "period_rule_mismatch"), ({"available_day": None}, "public_time_unknown"), ({"period_last": "2024-03-01"}, "future_period_not_reported_actual"), ({"unit": None}, "unit_unknown_or_incompatible"), ({"nil": "true"}, "reported_nil"), ({"decimals": "x"}, "invalid_numeric_accuracy"), ({"text": "1E5"}, "invalid_numeric_lexical"), ({"text": None}, "invalid_numeric_lexical")]
    df = spark.createDataFrame([(i, *[{**good, **c}[n] for n in names]) for i, (c, _) in enumerate(changes)], "i int, " + kind)
    got = [(r["missing_reason"], r["normalized_value"]) for r in facts.admit(df).orderBy("i").collect()]
    assert [g[0] for g in got] == [w for _, w in changes] and got[0][1] == "12.50" and all(v is None for _, v in got[1:])


def test_sampling_ignores_row_order(spark):
    rows = [(i, f"e{i % 9}", [c for c in ("a", "b", "c") if (i * 7 + ord(c)) % 5 == 0]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id bigint, entity string, cats array<string>")
    a = sampling.challenge_sample(df, ["a", "b", "none"], "s", 5, 10)
    b = sampling.challenge_sample(df.orderBy(F.desc("doc_id")).repartition(7), ["a", "b", "none"], "s", 5, 10)
    assert a == b and len(a[0]) == 5 and len(a[1]) == 10 and not set(a[0]) & {d for d, _ in a[1]} and a[2]["none"] == "not_found_in_available_archive_screen"
    page, total = sampling.page(df, ["doc_id"], 190, 20)
    assert page.count() == 10 and tuple(total.first()) == (200, 190, 20, False)


def test_market(spark):
    rows = spark.createDataFrame([("2024-01-05", "1234", "1", "2", "1", "1.5", "9", "9", "1", ""), ("2024-01-05", "1234", "", "", "", "", "", "", "x", "")], "Date string, Code string, O string, H string, L string, C string, Vo string, Va string, AdjFactor string, ExRT string")
    got = market.project_prices(rows).collect()
    assert [(g["trading_status"], g["missing_reason"]) for g in got] == [("intraday_status_not_provided", "daily_row_publication_time_not_recorded"), ("no_trade_reason_unknown", "invalid_market_number")]
    tie = market.bulk_tie(spark.createDataFrame([("f", "k", 1), ("g", "m", 1), ("h", "n", 1)], "file string, key string, size bigint"), spark.createDataFrame([("k", 1), ("m", 2)], "key string, size bigint"))
    assert sorted((r["file"], r["missing_reason"]) for r in tie.collect()) == [("f", None), ("g", "bulk_size_mismatch"), ("h", "bulk_entry_missing")]


def test_lineage(spark):
    edges = spark.createDataFrame([("a", "b", "r"), ("b", "c", "r"), ("c", "b", "r"), ("x", "y", "r")], "src string, dst string, relation string")
    assert sorted(r[0] for r in lineage.cyclic(edges).collect()) == ["b", "c"]
    nodes, reached = lineage.walk(spark.createDataFrame([("a",)], "node string"), edges)
    assert sorted(r["node"] for r in nodes.collect()) == ["a", "b", "c"] and reached.count() == 3
    assert lineage.orphans(edges, spark.createDataFrame([(n,) for n in "abcx"], "node string")).count() == 1


def test_reconcile_reason_order(spark):
    rows = [("1", "d", "r", None, "s", "u", "k", "1"), ("2", "e", "r", "c", "s", "v", "k", "1")]
    f = spark.createDataFrame(rows, "fact_id string, doc_id string, root string, scope string, standard string, unit string, key string, value string").withColumn("g", F.lit(1))
    assert reconcile.within_source(f, ["g"]).first()["classes"] == ["unresolved", "unit_difference", "restatement_difference"]


def archive() -> bytes:
    body = """<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:p="urn:p" xmlns:xbrldi="http://xbrl.org/2006/xbrldi">
<context id="c1"><entity><identifier scheme="s">E1</identifier></entity><period><startDate>2023-04-01</startDate><endDate>2024-03-31</endDate></period><scenario><xbrldi:explicitMember dimension="p:axis">p:m</xbrldi:explicitMember></scenario></context>
<unit id="u1"><divide><unitNumerator><measure>iso4217:JPY</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit>
<p:Sales contextRef="c1" unitRef="u1" decimals="0">12</p:Sales><p:Sales contextRef="c1" unitRef="u1" decimals="0">12</p:Sales></xbrl>"""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.xbrl", body)
    return out.getvalue()


def test_filing_extraction(spark):
    import hashlib

    data = archive()
    df = spark.createDataFrame([("p", data, hashlib.sha256(data).hexdigest()), ("q", data, "0" * 64), ("r", b"no zip", None)], "path string, content binary, sha256 string")
    rows = filings.filing_elements(df)
    got = rows.where("path = 'p'").orderBy("element_index").collect()
    assert [r["kind"] for r in got] == ["context", "unit", "fact", "fact"] and got[2]["qname"] == "{urn:p}Sales" and got[1]["denominator"] == ["shares"]
    assert {r["path"]: r["reason"] for r in rows.where("reason is not null").collect()} == {"q": "artifact_hash_mismatch", "r": "archive_unreadable"}
    profile = filings.structural_profile(rows).where("path = 'p'").first()
    assert (profile["facts"], profile["duplicates"], profile["dimensional"]) == (2, 1, 1)


def test_sources(spark, tmp_path):
    day = '{"metadata":{"status":"%s","parameter":{"date":"2024-01-01"},"resultset":{"count":%d}},"results":[{"docID":"S1000001","seqNumber":1,"parentDocID":"s1"}]}'
    (tmp_path / "l").mkdir()
    (tmp_path / "l/a.json").write_text(day % ("200", 1))
    (tmp_path / "l/b.json").write_text(day % ("200", 2))
    (tmp_path / "l/c.json").write_text(day % ("404", 1))
    (tmp_path / "l/d.json").write_text("{")
    rows, rejects = filings.daily_lists(spark, str(tmp_path / "l"))
    assert [(r["docID"], r["warning"]) for r in rows.collect()] == [("S1000001", "parent_id_lower_case")]
    assert sorted(r["reason"] for r in rejects.collect()) == ["list_count_mismatch", "list_status_not_200", "list_unreadable"]
    (tmp_path / "x.csv").write_text("﻿Date,HolDiv\n2024-01-01,0\n2024-13-01,1\n2024-01-02\n", encoding="utf-8")
    got = filings.market_csv(spark, "markets_calendar", str(tmp_path / "x.csv"), ["Date", "HolDiv"]).collect()
    assert [r["missing_reason"] for r in got] == [None, "invalid_date", "row_width_mismatch"]
    with pytest.raises(ValueError):
        filings.market_csv(spark, "markets_calendar", "x", ["Date"])
    (tmp_path / "j.jsonl").write_text('{"a": 1, "b": "x"}\n{"a": 1\n{"b": "y"}\n')
    ok, bad = filings.json_lines(spark, str(tmp_path / "j.jsonl"), "a bigint, b string", ["a"])
    assert ok.count() == 1 and sorted(r["reason"] for r in bad.collect()) == ["line_unreadable", "required_field_missing"]
    assert [r["line"] for r in filings.numbered_lines(spark, str(tmp_path / "j.jsonl")).orderBy("line").collect()] == [1, 2, 3]
    before = filings.fingerprints(spark, str(tmp_path / "l"))
    assert validate.preserved(before, before).first()["violations"] == 0
    assert validate.preserved(before, before.limit(2)).first()["violations"] == 2


def test_package_and_api(spark, tmp_path):
    docs = documents(spark, {}, {"doc_id": "b", "parent_id": "a", "available_at": T0 + DAY})
    tables = {
        "documents": docs,
        "facts": spark.createDataFrame([fact("f1", "a"), fact("f2", "b", at=T0 + DAY)], FACT),
        "entities": spark.createDataFrame([("e", "name", "Alpha Co"), ("e", "name", "Beta"), ("e", "code", "1234"), ("f", "name", "Gam")], "entity_id string, kind string, value string"),
        "joins": spark.createDataFrame([("j", "e", "PASS")], "row_id string, entity_id string, status string"),
        "comparisons": spark.createDataFrame([("c", "a")], "comparison_id string, doc_id string"),
        "failures": spark.createDataFrame([("a", "why")], "doc_id string, missing_reason string"),
        "lineage": spark.createDataFrame([("fact:f1", "document:a", "of")], "src string, dst string, relation string"),
    }
    tables["name_grams"] = package.name_grams(tables["entities"])
    path = str(tmp_path / "p")
    package.publish(tables, path, "one")
    with pytest.raises(Exception):
        package.publish(tables, path, "one")
    e = Evidence(spark, path)
    assert e.company(name="ALPHA").count() == 3 and e.company(code="1234").count() == 3 and e.company(name="gamma").count() == 0 and e.company(name="").count() == 0
    assert {r["value"] for r in e.company(name="a").collect()} == {"Alpha Co", "Beta", "1234", "Gam"} and e.company(entity="f").count() == 1
    assert package.version(spark, path) == 1 and package.commit(spark, path, "two", 1) == 2 and package.current(spark, path) == "two"
    with pytest.raises(ValueError, match="snapshot_commit_conflict"):
        package.commit(spark, path, "three", 1)
    package.commit(spark, path, "one", 2)
    assert [r["fact_id"] for r in e.facts("e").where("missing_reason is null").collect()] == ["f2"]
    assert [r["fact_id"] for r in e.facts("e", T0 + DAY, snapshot=T0 + 9 * DAY).where("missing_reason is null").collect()] == ["f1"]
    assert e.filings("e").count() == 2 and e.joins("e").count() == 1 and e.compare("a").count() == 1 and e.failures(reason="why").count() == 1
    assert e.lineage("fact:f1")[0].count() == 2
    assert {r["check"]: r["violations"] for r in e.validate({"documents": ["doc_id"], "facts": ["doc_id"]}).collect()} == {"primary_key:documents": 0, "primary_key:facts": 0, "manifest": 0}
    more = e.validate({}, (("facts", "doc_id", "documents", "doc_id"), ("failures", "doc_id", "joins", "row_id")), required=(("facts", "fact", "fact_id", "document", "doc_id", "of"),))
    assert {r["check"]: r["violations"] for r in more.collect()} == {"orphan_doc_id:facts": 0, "orphan_doc_id:failures": 1, "required_edge:of": 1, "manifest": 0}
    package.write_views({"v": spark.createDataFrame([("=1",)], "a string")}, str(tmp_path / "views"))
    assert "'=1" in "".join(p.read_text() for p in (tmp_path / "views/v").glob("*.csv"))


def test_stream_appends_once(spark, tmp_path):
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    (tmp_path / "src").mkdir()
    line = '{"event_time":"2024-01-0%dT00:00:00","id":%d}\n'
    (tmp_path / "src/a.json").write_text(line % (1, 1) + line % (1, 1) + line % (2, 2))
    for more in (line % (2, 2) + line % (3, 3), ""):
        q = lists.append_rows(spark, src, "event_time timestamp, id bigint", out, mark, ["id"])
        q.awaitTermination(120)
        if more:
            (tmp_path / "src/b.json").write_text(more)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_coverage(spark):
    assert coverage.duplicate_candidates(spark.createDataFrame([(1,), (1,), (2,)], "a int"), ["a"]).first()[0] == 1
    ents = spark.createDataFrame([("e", "name", "Ä")], "entity_id string, kind string, value string")
    assert company(ents, entity="e").count() == 1


def test_text_tie_counts_large_groups(spark):
    """20,000 copies: one row each, not 400 million pairs."""
    copies = spark.range(20_000).selectExpr("id", "'k' as k", "'a b' as text")
    other = spark.createDataFrame([(20_000, "k", "x"), (20_001, "k", " x\n"), (20_002, "k", "lone"), (20_003, "k", " "), (20_004, "m", "ab")], "id bigint, k string, text string")
    rows = copies.union(other)
    elements = rows.where("id <> 20002 and id <> 0").union(other.limit(1)).withColumnRenamed("id", "origin_id")
    tied = reconcile.text_tie(rows.withColumnRenamed("id", "row_id"), elements, ["k"])
    got = {r["row_id"]: (r["n"], r["first"]) for r in tied.collect()}
    assert tied.count() == len(got) == 20_004
    assert all(got[i] == (19_999, 1) for i in range(20_000))
    assert [got.get(i) for i in range(20_000, 20_005)] == [(2, 20_000), (2, 20_000), (0, None), None, (1, 20_004)]


def test_page_text_is_the_parsers(spark):
    from html.parser import HTMLParser

    class Data(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.parts = []

        def handle_data(self, data):
            self.parts.append(data)

    rows = ["a &#65;&#x42; &eacute; & b <b title='x>y'>c</b> 1 < 2 <!-- <p> -->d　e", "<!DOCTYPE html><style>p>a{}</style><SCRIPT>var t='</p>';if(a<b)&amp;</SCRIPT >t&amp;lt;", "", "<p>x<br/>y</p>\n z"]
    got = filings.html_text(spark.createDataFrame([(i, x) for i, x in enumerate([*rows, None])], "i int, html string"), "html").orderBy("i").collect()
    for text, r in zip(rows, got):
        p = Data()
        p.feed(text)
        p.close()
        assert r["text"] == "".join("".join(p.parts).split()), text
    assert got[-1]["text"] is None


def test_extraction_of_nested_facts_and_odd_members(spark):
    def packed(**members):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, body in members.items():
                z.writestr(name.replace("__", "."), body)
        return out.getvalue()

    body = """<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:p="urn:p"><context id="c"><entity><identifier>E1</identifier></entity><period><instant>2024-03-31</instant></period></context><p:T><p:A contextRef="c" unitRef="u" precision="3" scale="6">1<p:B contextRef="c"/></p:A></p:T></xbrl>"""
    arcs = """<linkbase xmlns="http://www.xbrl.org/2003/linkbase" xmlns:x="http://www.w3.org/1999/xlink"><calculationLink x:role="r"><loc x:label="a" x:href="#A"/><loc x:label="b" x:href="#B"/><loc x:label="b" x:href="#C"/><loc x:label="d" x:href="#D"/><calculationArc x:from="a" x:to="b"/><calculationArc x:from="a" x:to="d" weight="1"/><calculationArc x:from="a" x:to="none"/></calculationLink></linkbase>"""
    df = spark.createDataFrame([("n", packed(a__xbrl=body, a_cal__xml=arcs), None), ("d", packed(a__xbrl='<!DOCTYPE x [<!ENTITY e "v">]>' + body), None)], "path string, content binary, sha256 string")
    rows = filings.filing_elements(df).collect()
    facts = [(r["qname"], r["element_index"], r["precision"], r["has_children"], r["has_transform"]) for r in rows if r["kind"] == "fact"]
    assert sorted(facts) == [("{urn:p}A", 7, "3", True, True), ("{urn:p}B", 8, None, False, False)]
    assert [(r["parent"], r["child"]) for r in rows if r["kind"] == "arc"] == [("#A", "#D")]
    assert [(r["path"], r["reason"]) for r in rows if r["reason"]] == [("d", "xml_rejected")]
    many = body.replace("</xbrl>", "".join(f'<p:A contextRef="c" unitRef="u">{i}</p:A>' for i in range(20_000)))
    late = spark.createDataFrame([("ok", packed(a__xbrl=many + "</xbrl>"), None), ("late", packed(a__xbrl=many), None)], "path string, content binary, sha256 string")
    got = filings.filing_elements(late)
    assert got.where("path = 'ok' and kind = 'fact'").count() == 20_002 and got.where("path = 'ok'").agg(F.max("element_index")).first()[0] == 20_008
    assert [(r["path"], r["reason"], r["kind"]) for r in got.where("path = 'late'").collect()] == [("late", "archive_unreadable", None)]


def test_pairs_are_counted_as_they_are_made(spark):
    import random

    r = random.Random(3)
    rows = [(f"f{i}", f"g{i % 4}", f"d{i % 3}" if i % 5 else "e", r.choice([None, "r", "s"]), r.choice([None, "c", "n"]), r.choice(["J", "I"]), r.choice(["Y", "S", None]), r.choice(["k", "l"]), r.choice(["1", "1.0", "2", None, "NaN", "x"])) for i in range(160)]
    roots = {d: r.choice([None, "r", "s"]) for d in {x[2] for x in rows}}
    df = spark.createDataFrame([(*x[:3], roots[x[2]], *x[4:]) for x in rows], "fact_id string, g string, doc_id string, root string, scope string, standard string, unit string, key string, value string")
    group = df.select("fact_id", "g").withColumnRenamed("fact_id", "a")
    want = {(x["g"], tuple(x["classes"])): x["count"] for x in reconcile.within_source(df, ["g"]).join(group, "a").groupBy("g", "classes").count().collect()}
    assert {(x["g"], tuple(x["classes"])): x["pairs"] for x in reconcile.pair_counts(df, ["g"]).collect()} == want


def test_lines_are_numbered_over_splits(spark, tmp_path):
    for name, n in (("a.txt", 5000), ("b.txt", 3), ("c.txt", 0)):
        (tmp_path / name).write_text("".join(f"line {i} " + "x" * (i % 50) + "\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        got = filings.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 5003 and all(r["value"].startswith(f"line {r['line'] - 1} ") for r in got)


def test_as_reported_and_budget(spark):
    from tidemark.operators import revisions

    docs = spark.sql("select * from values ('a', null, 'e', timestamp'2020-01-01', '120'), ('b', 'a', 'e', timestamp'2020-02-01', '130') t(doc_id, parent_id, entity_id, available_at, doc_type)")
    docs = docs.withColumns({"recorded_at": F.col("available_at"), "retrieved_at": F.col("available_at"), "events": F.array().cast("array<struct<available_at:timestamp,blocked_reason:string>>"), "failure": F.lit(None).cast("string")})
    facts = spark.sql("select * from values ('1', 'a', 'k', '5'), ('2', 'b', 'k', '6') t(fact_id, doc_id, key, value)").withColumns({"value_reason": F.lit("x"), "verification": F.lit("source_tied"), "representation": F.lit("reported"), "synthetic": F.lit(False), "available_at": F.lit("2020-01-01").cast("timestamp")})
    got = revisions.as_reported(facts, docs, "a", "2021-01-01").collect()
    assert [(r["fact_id"], r["value"], r["missing_reason"]) for r in got] == [("1", "5", None)]
    with pytest.raises(ValueError, match="budget"):
        revisions.revision_closure(docs.where("doc_id = 'b'").select("doc_id"), docs, ["130"], budget=1)
