"""Near duplicates, lines and benchmark passages against brute force."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, near_dup
from tidemark.llm.common import components


def shingles(text, size):
    w = [x.encode().decode() for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in w]
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}


def brute_groups(rows, size, percent):
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, texts, size):
    got = near_dup.near_duplicates(docs, size, 80).collect()
    want = brute_groups(texts, size, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert len(got) == len(want) + 1
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]


def test_near_duplicates_of_nothing(empty):
    assert near_dup.near_duplicates(empty).collect() == []


def test_estimate_follows_jaccard():
    import numpy as np

    r = np.random.default_rng(0)
    x = r.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.sort(x[:2000]), np.sort(x[500:2500])
    p, q = near_dup.sketch(a, np.array([0, 2000])), near_dup.sketch(b, np.array([0, 2000]))
    assert abs(near_dup.estimate(p, q, np.array([2000.0]), np.array([2000.0]))[0] - 1500 / 2500) < 0.17


def test_registers():
    import numpy as np

    got = near_dup.registers(np.array([1 << 63, (1 << 63) | (1 << 62), 1 << 62, 1, 0], np.uint64))
    assert got.tolist() == [0, 1 << 9, 1 << 10, 63 << 10, 63 << 10]


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 60), (60, 70), (5, 5)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 60: 60, 70: 60, 100: 60, **{}}


# -- lines -----------------------------------------------------------------------------------------


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def line_words(line):
    return re.findall(r"[^\x20\x09-\x0D]+", line.lower())


def brute_lines(rows, least=8):
    seen, out = [], defaultdict(set)
    for i, t in sorted(rows, key=lambda r: r[0]):
        for p, line in enumerate((t if t is not None else "\0").split("\n")):
            w = line_words(line)
            if t is None or not w:
                continue
            if any(v == w or (min(len(w), len(v)) >= least and abs(len(w) - len(v)) < 2 and edit(w, v) <= 1) for v in seen):
                out[i].add(p)
            seen.append(w)
    return out


def test_duplicate_lines(spark):
    a = "one two three four five six seven eight nine"
    rows = [(1, a + "\nshort line"), (2, a.upper() + "\nshort line"), (3, a.replace("five", "5")), (4, a.replace("one ", "")), (5, a + " ten"), (6, a.replace("one", "1").replace("nine", "9")), (7, a + "\n" + a), (8, None), (9, ""), (10, "x " * 60), (11, "x " * 61), (12, "x " * 30 + "y " + "x " * 30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: set(r["drops"]) for r in line_dedup.duplicate_lines(df).collect()}
    assert got == dict(brute_lines(rows))
    kept = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert kept[1] == rows[0][1] and kept[2] == "" and kept[3] == "" and kept[8] is None and kept[9] == ""


def test_duplicate_lines_of_documents(docs, texts, empty):
    got = {r["doc_id"]: set(r["drops"]) for r in line_dedup.duplicate_lines(docs.where("doc_id is not null")).collect()}
    assert got == dict(brute_lines(texts))
    clash = docs.withColumns({c: F.lit(c) for c in ("row", "drops", "drop_id", "drop_hash", "text_hash", "d", "t")})
    out = line_dedup.dedup_lines(clash)
    assert out.columns == clash.columns and {(r["row"], r["drops"], r["t"]) for r in out.collect()} == {("row", "drops", "t")}
    assert {r["doc_id"]: r["text"] for r in out.collect() if r["doc_id"] in (301, 302)} == {301: "", 302: " \n\t "}
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert line_dedup.dedup_lines(empty).collect() == []


# -- benchmark -------------------------------------------------------------------------------------


def bench_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_contamination(rows, items, window=13):
    out = {}
    for i, t in rows:
        w, hit, found = bench_words(t), set(), set()
        for item, text in items:
            v = bench_words(text)
            n = min(window, len(v))
            for p in range(len(v) - n + 1) if n else ():
                for q in range(len(w) - n + 1):
                    if w[q : q + n] == v[p : p + n]:
                        hit |= set(range(q, q + n))
                        found.add(item)
        out[i] = (len(w), len(hit), sorted(map(str, found)), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def test_contamination(spark, docs, texts, empty):
    import hashlib

    t = dict(texts)
    long = " ".join(t[307].split()[100:130])
    items = [(1, long), (2, "one"), (3, "ONE  two!"), (4, None), (5, "..."), (10, " ".join(t[2].split()[:13])), (11, " ".join(t[2].split()[3:20])), (12, "été one")]
    bench = spark.createDataFrame([(i, x, 0) for i, x in items], "item_id bigint, text string, words int")
    got = decontaminate.contamination(docs, bench).collect()
    want = brute_contamination([*texts], items)
    for r in got:
        n, hit, found, bad = want[r["doc_id"] if r["doc_id"] is not None else 1]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(found), bad), r["doc_id"]
        assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
    assert len(got) == docs.count()
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0


def test_every_shared_window_shares_a_fingerprint(spark):
    df = spark.createDataFrame([(" ".join(str(i % 7) for i in range(40)),)], "t string").select(F.split("t", " ").alias("w"))
    n = df.select(F.size(decontaminate.fingerprints(F.col("w"), 13)), F.size(decontaminate.fingerprints(F.slice("w", 1, 13), 13))).first()
    assert tuple(n) == (28, 1)


def test_large_bands_and_outsiders(spark, monkeypatch):
    """Groups whose members lie about the threshold, so hubs, blocks and pairs all matter."""
    import random

    monkeypatch.setattr(near_dup, "PAIRED", 3)
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    r = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        lost = set(r.sample(range(120), r.randint(0, 16)))
        rows.append((i, " ".join(w for j, w in enumerate(base) if j not in lost)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 2, 80).collect()
    assert {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in got} == brute_groups(rows, 2, 80)


def test_block_links():
    import numpy as np

    def row(doc, root, n, apart):
        return {"doc": doc, "root": root, "n": n, "apart": np.array(sorted(apart), np.int64).tobytes()}

    left = [row(1, 1, 10, {5}), row(2, 2, 10, {5, 6, 7, 8, 9})]
    right = [row(1, 1, 10, {5}), row(3, 3, 9, set()), row(4, 4, 9, {5, 6})]
    assert sorted(near_dup.block_links(left, right, 80)) == [(1, 3), (1, 4)]


def test_texts_of_one_id_keep_their_own_partners(spark, monkeypatch):
    a, b = ([f"{x}{i}" for i in range(60)] for x in "ab")
    rows = [(5, " ".join(a)), (5, " ".join(b)), (6, " ".join([*a[:59], "other"])), (7, " ".join([*b[:59], "other"])), (5, " ".join(a)), (8, "alone here"), (4, " ".join(b[:30]))]
    monkeypatch.setattr(near_dup, "MEET", 1)
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 2, 80).collect()}
    assert got == {4: 4, 5: 5, 6: 5, 7: 5, 8: 8}
