"""Vector codes against plain Lloyd's rounds."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import codes

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, salt int"


def brute(rows, parts, entries, rounds):
    """(vec_id, label, code, error) by plain loops, and the codebooks."""
    kept = sorted(((i, np.floor(np.float32(v).astype(float) * 4096).astype(int), label) for i, v, label in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1].astype("<i4").tobytes()))
    width = len(kept[0][1]) // parts
    books = [[r[1][p * width : (p + 1) * width] for r in kept[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((int(((x - c) ** 2).sum()), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        said = [[nearest(p, r[1][p * width : (p + 1) * width])[1] for r in kept] for p in range(parts)]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [r[1][p * width : (p + 1) * width] for r, c in zip(kept, said[p]) if c == e]
                if own:
                    books[p][e] = sum(own) // len(own)
    out = []
    for i, v, label in kept:
        found = [nearest(p, v[p * width : (p + 1) * width]) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, books


def made(n, dims, seed=3):
    r = random.Random(seed)
    near = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    return [(i, [x + r.gauss(0, 0.2) for x in near[i % 6]], None if i % 7 == 0 else i % 3) for i in range(n)]


def key(r):
    return tuple((x is not None, x) if x is not None else (False, 0) for x in r)


def test_as_plain_rounds(spark):
    rows = made(150, 16)
    rows += [rows[20], (rows[30][0], rows[31][1], 1), (None, rows[5][1], 2), (900, rows[40][1], None)]
    odd = [(901, None, 1), (902, [*rows[0][1][:15], None], 1), (903, [float("nan")] * 16, 1), (904, [float("inf"), *rows[0][1][1:]], 2)]
    df = spark.createDataFrame([(*r, "x", 9) for r in rows + odd], SCHEMA).repartition(5)
    want, books = brute([(i, v, label) for i, v, label in rows], 8, 16, 6)
    got = codes.compressed(df).collect()
    total = {}
    for _, label, _, error in want:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    assert sorted((tuple(r) for r in got), key=key) == sorted(((i, c, e, total[label], digest) for i, label, c, e in want), key=key)


def test_many_labels_salted(spark, monkeypatch):
    rows = spark.createDataFrame([(*r, "x", 9) for r in made(80, 8)], SCHEMA)
    once = sorted(map(tuple, codes.compressed(rows, 2, 4, 1).collect()))
    monkeypatch.setattr(codes, "FEW", 0)
    assert sorted(map(tuple, codes.compressed(rows, 2, 4, 1).collect())) == once


@pytest.mark.parametrize("k", [1, 3, 64, 130])
def test_masks_hold_the_nearest(k):
    r = np.random.default_rng(k)
    book = r.integers(-50, 50, (k, 3))
    book[k // 2] = book[0]  # a tie
    x = r.integers(-70, 70, (400, 3))
    apart = ((x[:, None] - book[None]) ** 2).sum(axis=2)
    entry, least = codes.Sliced(book).nearest(x)
    assert np.array_equal(entry, apart.argmin(axis=1)) and np.array_equal(least, apart.min(axis=1))
    row, _ = codes.Sliced(book).candidates(x)
    assert k < 64 or len(row) < 0.8 * apart.size  # the masks leave entries out


def test_other_lengths_large_components_and_few_rows(spark):
    rows = [(1, [0.5, -0.25, 1.0], 1, "a", 1), (2, [0.5], 1, "a", 1), (3, [3e38, 0.0, 0.0], 1, "a", 1), (4, [0.0, 0.0, 0.0], 1, "a", 1), (5, [], 2, "a", 1)]
    got = {r["vec_id"]: r for r in codes.compressed(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: got[i]["code"] is None for i in got} == {1: False, 2: True, 3: True, 4: False, 5: True}
    assert got[1]["error"] == got[4]["error"] == 0 and got[1]["label_error"] == 0 and got[5]["label_error"] is None


def test_decoding(spark):
    rows = codes.scaled(spark.createDataFrame([(*r, "x", 9) for r in made(60, 10)], SCHEMA))
    books, size = codes.train(rows, 4, 16, 3)
    coded = codes.encode(rows, books, size)
    exact = {r["vec_id"]: np.frombuffer(r["v"], "<i4") for r in rows.collect()}
    back = {r["vec_id"]: np.array(r["approximate"]) * 4096 for r in codes.decode(coded, books, size).collect()}
    error = {r["vec_id"]: r["error"] for r in coded.collect()}
    assert all(round(((exact[i] - back[i]) ** 2).sum()) == error[i] for i in exact)


def test_nothing(spark):
    assert codes.compressed(spark.createDataFrame([], SCHEMA)).count() == 0
    assert codes.compressed(spark.createDataFrame([(1, None, 1, "a", 1)], SCHEMA)).count() == 0
