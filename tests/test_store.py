"""The store by day, comparisons across sources and categories, at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import coverage, market, reconcile, sampling
from tidemark.sources import store

D0 = dt.date(2024, 1, 1)
PRICES = "day date, code string, close bigint"
WINDOWS = "first_day date, last_day date"


def day(n):
    return D0 + dt.timedelta(days=n)


def files_read(df):
    """How many files each scan of a query that has been run has opened."""
    found, files = df._jdf.queryExecution().executedPlan().executedPlan().collectLeaves(), []
    for i in range(found.size()):
        leaf = found.apply(i)
        while leaf.nodeName().endswith("QueryStage"):
            inner = leaf.plan().collectLeaves()
            leaf = inner.apply(0)
        if leaf.metrics().contains("numFiles"):
            files.append(leaf.metrics().apply("numFiles").value())
    return files


@pytest.fixture
def kept(spark, tmp_path):
    # a third of all rows on one day
    rows = [(day(n % 100), f"{n % 40:04d}", n) for n in range(2000)] + [(day(7), f"{n % 40:04d}", n) for n in range(1000)] + [(None, "0001", 1)]
    path = str(tmp_path / "store")
    told = store.write_revision(spark.createDataFrame(rows, PRICES), path, "bars", "r1", span="day", rows_per_file=300)
    return path, rows, told


def test_store_counts_its_rows_and_splits_a_hot_day(spark, kept):
    path, rows, told = kept
    assert told == len(rows)
    files = spark.read.parquet(f"{path}/bars/revision=r1/rows/day_start={day(7)}").inputFiles()
    assert len(files) >= 4


def test_store_reads_files_of_the_windows_alone(spark, kept):
    path, rows, _ = kept
    windows = spark.createDataFrame([(day(3), day(5)), (day(4), day(7)), (day(50), day(40)), (None, day(90)), (day(98), day(200))], WINDOWS)
    got = store.read_days(spark, path, "bars", windows)
    asked = {day(n) for n in (3, 4, 5, 6, 7, 98, 99)}
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] in asked)
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    total = len(spark.read.parquet(f"{path}/bars/revision=r1/rows").inputFiles())
    read = max(files_read(got))
    assert 0 < read < total / 4


def test_store_by_month_gives_the_same_days(spark, kept, tmp_path):
    _, rows, _ = kept
    path = str(tmp_path / "months")
    store.write_revision(spark.createDataFrame(rows, PRICES), path, "bars", "r1")
    windows = spark.createDataFrame([(day(33), day(35)), (day(34), day(34))], WINDOWS)
    got = store.read_days(spark, path, "bars", windows)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] and day(33) <= r[0] <= day(35))
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert max(files_read(got)) < len(spark.read.parquet(f"{path}/bars/revision=r1/rows").inputFiles())


@pytest.mark.parametrize("limits", [{}, {"most_codes": 1}, {"most_days": 1}, {"most_days": 1, "most_codes": 1}])
def test_store_by_codes_is_the_same_by_list_and_by_join(spark, kept, limits):
    path, rows, _ = kept
    windows = spark.createDataFrame([(day(0), day(9))], WINDOWS)
    codes = spark.createDataFrame([("0003",), ("0004",), ("0003",), (None,), ("none",)], "code string")
    got = store.read_days(spark, path, "bars", windows, codes, **limits)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] and day(0) <= r[0] <= day(9) and r[1] in ("0003", "0004"))


def test_store_revisions(spark, tmp_path):
    path = str(tmp_path / "s")
    windows = spark.createDataFrame([(day(0), day(9))], WINDOWS)
    with pytest.raises(ValueError, match="no_committed_snapshot"):
        store.read_days(spark, path, "bars", windows)
    store.write_revision(spark.createDataFrame([(day(1), "1", 1)], PRICES), path, "bars", "r1")
    store.write_revision(spark.createDataFrame([(day(1), "2", 2)], PRICES), path, "bars", "r2")
    assert [r["code"] for r in store.read_days(spark, path, "bars", windows).collect()] == ["2"]
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        store.write_revision(spark.createDataFrame([(day(1), "3", 3)], PRICES), path, "bars", "r2")
    assert store.write_revision(spark.createDataFrame([], PRICES), path, "bars", "r3") == 0
    empty = store.read_days(spark, path, "bars", windows)
    assert empty.columns == ["day", "code", "close"] and empty.count() == 0


def test_store_reads_the_calendar_whole(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([(day(n), None, n) for n in range(30)], PRICES)
    store.write_revision(rows, path, market.CALENDAR, "r1")
    assert store.read_days(spark, path, market.CALENDAR, spark.createDataFrame([(day(3), day(3))], WINDOWS)).count() == 30


T = dt.datetime(2024, 5, 1)
SIDE = "k int, fact_id string, value string, available_at timestamp, unit string, share_basis string, scope string"


def across(spark, left=None, right=None):
    own = dict(k=1, fact_id="a", value="10", available_at=T, unit="JPY", share_basis=None, scope="c")
    a = own | dict(is_revision=False, identity_verified=True, decision_at=T + dt.timedelta(days=1), n_dimensions=0) | (left or {})
    b = own | dict(fact_id="b", value="10.0", restated=False, revision_state=reconcile.FIRST_STATE) | (right or {})
    x = spark.createDataFrame([tuple(a.values())], SIDE + ", is_revision boolean, identity_verified boolean, decision_at timestamp, n_dimensions int")
    y = spark.createDataFrame([tuple(b.values())], SIDE + ", restated boolean, revision_state string")
    r = reconcile.across_sources(x, y, ["k"], {"unit": "definition_difference", "scope": "scope_difference"}).first()
    return r["classes"], r["numeric"]


@pytest.mark.parametrize(
    "left, right, want",
    [
        ({}, {}, (["exact_match"], "equal")),
        ({}, {"value": "11"}, (["value_conflict"], "different")),
        ({"n_dimensions": 1}, {}, (["scope_difference"], None)),
        ({"n_dimensions": None}, {}, (["exact_match"], "equal")),
        ({"share_basis": "x"}, {}, (["exact_match"], "equal")),
        ({"share_basis": "x", "unit": "shares"}, {"unit": "shares"}, (["definition_difference"], None)),
        ({"unit": "JPY/share"}, {"unit": "JPY/share"}, (["exact_match"], "equal")),
        ({}, {"revision_state": None}, (["exact_match", "revision_difference"], "equal")),
        ({}, {"revision_state": "revised", "value": "9"}, (["revision_difference", "value_conflict"], "different")),
        ({"decision_at": None}, {}, (["unresolved"], None)),
        ({"available_at": None}, {}, (["unresolved"], None)),
        ({"decision_at": T}, {}, (["timing_difference"], None)),
        ({}, {"available_at": T - dt.timedelta(hours=1)}, (["exact_match", "timing_difference"], "equal")),
        ({"identity_verified": None}, {"restated": None}, (["unresolved"], None)),
        ({}, {"k": 2}, (["unresolved"], None)),
    ],
)
def test_across_sources(spark, left, right, want):
    assert across(spark, left, right) == want


EVENT = "doc_id string, day date, seq int, submit_day date, entity string, name string, code string, doc_type string, parent_id string, statuses array<string>"


def test_metadata_categories_take_all_events(spark):
    events = [
        ("a", day(1), 1, day(2), "E", "n1", "130A", "130", "", ["0"]),
        ("a", day(2), 1, day(2), "E", "n1", None, "120", "p", ["0", None]),
        ("b", day(1), 1, day(9), "E", "n2", "7203", "120", None, ["0", "1"]),
        ("c", day(1), 1, None, None, "n3", "", None, None, None),
        ("listed only", day(1), 1, day(1), "E", "n9", "9999", "130", None, None),
    ]
    files = [("a", 1), ("a", 5), ("b", 9), ("b", None), ("c", None), ("d", 1)]
    got = sampling.metadata_categories(spark.createDataFrame(events, EVENT), spark.createDataFrame(files, "doc_id string, bytes bigint"), big=9)
    assert {r["doc_id"]: r["cats"] for r in got.collect()} == {
        "a": ["amended_report", "parent_document", "security_code_null", "multiple_security_codes", "name_history"],
        "b": ["unusual_status", "multiple_security_codes", "name_history", "large_zip"],
        "c": [],
        "d": [],
    }


PROFILE = "doc_id string, dei map<string,array<string>>, dimensions array<struct<axis:string,member:string>>, loss_fact boolean, shared_tag boolean, members int, failures array<string>"


def test_structure_categories(spark):
    span = {"CurrentFiscalYearStartDateDEI": ["2023-04-01"], "CurrentFiscalYearEndDateDEI": ["2024-03-31"]}
    rows = [
        ("year", span | {"AccountingStandardsDEI": ["Japan GAAP"], "WhetherConsolidatedFinancialStatementsArePreparedDEI": ["true"]}, [], False, False, 1, []),
        ("short", span | {"CurrentFiscalYearEndDateDEI": ["2023-12-31"], "AccountingStandardsDEI": ["x", "IFRS"], "IndustryCodeWhenConsolidatedDEI": ["BNK"]}, [("SegmentAxis", "AMember"), ("SegmentAxis", "AMember")], True, True, 2, ["f"]),
        ("two ends", span | {"CurrentFiscalYearEndDateDEI": ["2023-12-31", "2023-11-30"], "IndustryCodeDEI": [None, "REIT"]}, [("SegmentAxis", "AMember"), ("OtherSegment", "BMember")], None, None, None, None),
        ("bad day", span | {"CurrentFiscalYearEndDateDEI": ["soon"]}, [("x", "NonConsolidatedMember"), ("x", None)], None, None, 0, None),
        ("nothing", None, None, None, None, None, None),
    ]
    got = sampling.structure_categories(spark.createDataFrame(rows, PROFILE))
    assert {r["doc_id"]: r["cats"] for r in got.collect()} == {
        "year": ["jp_gaap", "consolidated"],
        "short": ["ifrs", "loss_fact", "fiscal_period_change_cue", "financial", "multiple_xbrl_members", "same_tag_multiple_contexts", "screening_failure"],
        "two ends": ["reit", "multiple_segments"],
        "bad day": ["non_consolidated"],
        "nothing": [],
    }


def test_inventory_of_nothing(spark):
    events = spark.createDataFrame([], "doc_id string, day date, seq int, submit_day date, code string, entity string, doc_type string")
    r = coverage.inventory(events, spark.createDataFrame([], "doc_id string")).first()
    assert (r["documents"], r["files"], r["entities"], r["types"], r["first_day"]) == (0, 0, 0, [], None)
    r = coverage.inventory(events, spark.createDataFrame([("a",), ("a",)], "doc_id string")).first()
    assert (r["documents"], r["files"], r["repeated"], r["without_code"], [tuple(t) for t in r["types"]]) == (1, 2, 1, 1, [("unknown", 1)])
