"""What the findings of round 4 name, each as small as it shows."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from test_findings import agrees
from test_queries import SF


@pytest.fixture(scope="module")
def last_code(tmp_path_factory):
    """A few orders, one of which is the filing of the last company code and a multiple of 37."""
    path = tmp_path_factory.mktemp("codes")
    con = duckdb.connect()
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        con.execute(f"copy (select * replace (cast({key} + 999990 as bigint) as {key}) from '{SF}/{name}.parquet' where {key} < 60) to '{path}/{name}.parquet' (format parquet)")
    return path


def test_admission_of_the_last_company_code(spark, last_code):
    """999,999 is a multiple of 37, so its filing names another company than its archive does, as all such."""
    assert agrees(spark, last_code, "fact_admission", ("orders", "lineitem"))


def test_interval_join_sends_no_rows_through_the_driver(spark, capsys):
    """Stored rows look small to Spark; what has a row for each fact, mapping or price is still not broadcast."""
    entry.queries()["interval_join"](spark, SF).explain(mode="formatted")
    keys = re.findall(r"\) BroadcastHashJoin.*\nLeft keys \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert not [k for k in keys if not re.fullmatch(r"day#\d+", k)], keys


def exchanged(spark, capsys, name) -> list[str]:
    """What each exchange of a query's plan without broadcasts carries."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        entry.queries()[name](spark, SF).explain(mode="formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)


@pytest.mark.parametrize("name", ["dated_plans", "dated_join", "pit_join_reasons"])
def test_plans_deal_out_judged_rows_and_days_once(spark, capsys, name):
    """No exchange carries the texts that prices and masters are judged by, nor a row for each day about an order or each step of a session's walk by plan."""
    inputs = exchanged(spark, capsys, name)
    assert inputs and not [x for x in inputs if re.search(r"\b(basis|evidence|product|market)#", x)]
    assert not [x for x in inputs if re.fullmatch(r"c#\d+L?, day#\d+", x) or (re.search(r"plan_id#", x) and re.search(r"\bmin#", x) and "step" in x)]


def test_sessions_are_walked_once_a_day(spark, capsys):
    import datetime as dt

    from pyspark.sql import functions as F

    from tidemark.operators import calendar

    t = dt.datetime(2024, 1, 5, 8)
    asked = spark.createDataFrame([(i, None if i == 3 else t + dt.timedelta(hours=i % 3)) for i in range(6)], "k int, threshold timestamp")
    days = spark.createDataFrame([(t.date() + dt.timedelta(i), "1" if i < 1 or i > 2 else "0") for i in range(-3, 8)], "day date, hol_div string")
    out = calendar.next_session(asked, days, ["k"])
    said = [(str(r["entry_day"]), r["session_reason"]) for r in out.orderBy("k").collect()]
    assert said == [("2024-01-05", None), ("2024-01-08", None), ("2024-01-08", None), ("None", "trading_calendar_missing_or_ambiguous"), ("2024-01-08", None), ("2024-01-08", None)]
    back = calendar.previous_session(asked.where("k in (0, 3)"), days, ["k"]).withColumn("p", F.col("prior_day").cast("string"))
    assert [(r["p"], r["session_reason"]) for r in back.orderBy("k").collect()] == [("2024-01-04", None), (None, "trading_calendar_missing_or_ambiguous")]
    out.explain(mode="formatted")
    assert not [x for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out) if re.search(r"\bk#", x)]


def test_stored_tables_leave_no_shuffles(spark):
    """What a stored table was made from takes no disk when it is there, and the session is as it was."""
    from pyspark.sql import functions as F

    from tidemark.operators.graph import cut

    def shuffles() -> set[str]:
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, there = spark.conf.get(name), shuffles()
    rows = cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")))
    assert not shuffles() - there and spark.conf.get(name) == before and rows.count() == 7


def test_edges_are_made_distinct_by_ids(spark, capsys):
    """Neither the lineage nor the search for its orphans deals out edges with all their texts; what they give stays."""
    from tidemark.operators import lineage

    docs = spark.createDataFrame([(1, 7, None), (1, 7, None), (2, 7, 1), (3, None, 9)], "doc_id int, entity_id int, parent_id int")
    edges = lineage.package_edges({"documents": docs})
    assert sorted(map(tuple, edges.collect())) == [("documents:1", "entities:7", "filer"), ("documents:2", "documents:1", "revises"), ("documents:2", "entities:7", "filer")]
    nodes = spark.createDataFrame([("documents:1",), ("documents:2",), ("documents:2",)], "node string")
    lost = lineage.orphans(edges.union(edges), nodes)
    assert sorted(map(tuple, lost.collect())) == [("documents:1", "entities:7", "filer"), ("documents:2", "entities:7", "filer")]
    edges.explain(mode="formatted")
    assert "relation#" not in "".join(re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out))


@pytest.mark.parametrize("rows", [1, 5000])
def test_archives_that_break_late_take_back_their_rows(spark, monkeypatch, capsys, rows):
    """Whether their first rows have left or not; rows are met with cancelling ones only where some have."""
    import io
    import zipfile

    from tidemark.sources import filings

    def archive(*members: str) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for i, text in enumerate(members):
                z.writestr(f"{i}.xml", text)
        return out.getvalue()

    monkeypatch.setattr(filings, "ROWS", rows)
    whole = '<r xmlns:u="urn:u"><u:e contextRef="1">1</u:e><u:e contextRef="2">2</u:e></r>'
    archives = spark.createDataFrame([("a", archive(whole), None), ("b", archive(whole, "<r>"), None), ("c", archive(whole, whole), None), ("d", b"", None)], "path string, content binary, sha256 string").coalesce(1)
    out = filings.filing_elements(archives)
    assert sorted((r["path"], r["reason"] or "") for r in out.select("path", "reason").collect()) == [("a", ""), ("a", ""), ("b", "archive_unreadable"), *[("c", "")] * 4, ("d", "archive_unreadable")]
    out.explain()
    assert ("Join" in capsys.readouterr().out) == (rows == 1)
