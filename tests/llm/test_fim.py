"""Fill-in-middle against plain cutting by regular expressions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, percent=50, spm=80):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows(texts):
    r = random.Random(8)
    odd = ["  a  b ", "\x1c\x1d x\x85y", "日本 語\n\n😀", "x<P>y", "<S", "<S<M", "a" * 5000 + " b " * 50 + "c" * 3000 + " d", "\t \n", "M> x <P"]
    long = " ".join("w" * r.choice([1, 2, 3, 9, 200]) for _ in range(200_000))
    return [*texts, *[(500 + i, t) for i, t in enumerate(odd * 6)], (None, "no id here"), (700, long), (701, long), texts[0]]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id bigint, text string, form string, output int").repartition(3)


def test_as_plain_cutting(table, rows):
    got = fim.fill_in_middle(table, percent=100)
    assert got.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "n_segments"]
    got = got.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got))) == sorted(map(str, ((i, t, *brute(i, t, 100)) for i, t in rows)))
    assert all(r["back"] == (r["text"] or "") for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_share_of_plain(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"))
    share = {r["form"]: r["count"] for r in fim.fill_in_middle(df).groupBy("form").count().collect()}
    assert abs(share["plain"] - 1000) < 120 and abs(share["spm"] - 800) < 120
    assert fim.fill_in_middle(df, percent=0).where("form <> 'plain'").count() == 0


@pytest.mark.parametrize("error", [0, 5, 127])
def test_segments_bound_the_error(error):
    r = np.random.default_rng(error)
    lengths = [1, 2, 700, 4000]
    places = np.concatenate([np.append(0, np.cumsum(r.integers(1, 60, n - 1))) for n in lengths])
    starts = np.append(0, np.cumsum(lengths))
    index = fim.fit(places, starts, error)
    assert np.array_equal(index.offsets(np.arange(len(places))), places)
    assert np.abs(index.residual.astype(int)).max() <= error
    assert set(starts[:-1]) <= set(index.first) and len(index.first) < (len(places) if error else len(places) + 1)


def test_stored_index(spark, table, rows):
    index = fim.boundary_index(table.where("doc_id in (0, 300, 506, 700)"))
    asked = index.join(spark.createDataFrame([(k,) for k in (-1, 0, 1, 5, 50, 199_999, 200_000, 200_001)], "k bigint"), F.lit(True))
    texts = dict(rows)
    for r in asked.select("doc_id", "n", "k", fim.boundary_at(F.col("k")).alias("at")).collect():
        tokens = TOKEN.findall(texts[r["doc_id"]] or "")
        assert r["n"] == len(tokens)
        assert r["at"] == (len("".join(tokens[: r["k"]]).encode()) if 0 <= r["k"] <= len(tokens) else None)


def test_nothing(table):
    assert fim.fill_in_middle(table.limit(0)).count() == 0 and fim.boundary_index(table.limit(0)).count() == 0
