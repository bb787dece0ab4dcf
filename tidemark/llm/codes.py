"""Compressed codes of vectors: parts quantised by codebooks, nearest entries found by slices and masks.

A codebook's entries are bits of uint64 masks. Each of its dimensions keeps its coordinates sorted, with a mask of the
entries before every place. An initial radius, the distance of one entry near by, selects a range of each dimension;
two prefix masks give the entries in the range, and the masks of all dimensions ANDed give exact candidates: no entry as near
as the first lies outside that box. Their squared distances decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import relieved, small_batches, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Components from this on aren't encoded: their squared distances may leave 64 bits.
LARGEST = 1 << 14
#: Labels that are joined by broadcast; beyond, each label's sum is repeated for so many salts.
FEW, SALTS = 1 << 16, 32


class Sliced:
    """A codebook (entries x dimensions, integers) for exact nearest-entry search."""

    def __init__(self, book: np.ndarray):
        self.book = np.asarray(book, np.int64)
        k, dims = self.book.shape
        self.words = (k + 63) // 64
        order = np.argsort(self.book, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.book, order, axis=0)
        bit = np.zeros((k, self.words), np.uint64)
        bit[np.arange(k), np.arange(k) // 64] = np.uint64(1) << (np.arange(k) % 64).astype(np.uint64)
        self.before = np.zeros((dims, k + 1, self.words), np.uint64)
        for j in range(dims):
            self.before[j, 1:] = np.bitwise_or.accumulate(bit[order[:, j]], axis=0)
        # the dimension of the widest spread finds an entry near by
        self.widest = int(np.argmax(self.sorted[-1] - self.sorted[0])) if dims else 0
        self.order = order[:, self.widest] if dims else np.zeros(k, np.int64)

    def candidates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry) of every entry in the box around a row of x that holds its nearest ones; by row, then entry."""
        k, dims = self.book.shape
        at = np.minimum(np.searchsorted(self.sorted[:, self.widest], x[:, self.widest]), k - 1) if dims else np.zeros(len(x), np.int64)
        radius = np.sqrt(((x - self.book[self.order[at]]) ** 2).sum(axis=1).astype(np.float64)).astype(np.int64) + 1
        mask = np.broadcast_to(self.before[0, k] if dims else self._all(), (len(x), self.words)).copy()
        for j in range(dims):
            low, high = np.searchsorted(self.sorted[:, j], x[:, j] - radius, "left"), np.searchsorted(self.sorted[:, j], x[:, j] + radius, "right")
            mask &= self.before[j, high] & ~self.before[j, low]
        bits = (mask[:, :, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
        return np.nonzero(bits.reshape(len(x), -1))

    def _all(self) -> np.ndarray:
        k = len(self.book)
        return np.array([(1 << min(64, k - 64 * w)) - 1 for w in range(self.words)], np.uint64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest entry, of equally near ones the lowest, and its squared distance."""
        if not len(x):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        row, entry = self.candidates(x)
        apart = ((x[row] - self.book[entry]) ** 2).sum(axis=1)
        least = np.minimum.reduceat(apart, np.searchsorted(row, np.arange(len(x))))
        hit = np.flatnonzero(apart == least[row])
        return entry[hit[np.unique(row[hit], return_index=True)[1]]], least


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the finite rows of vectors(vec_id, embedding, label): little-endian 32-bit integers floor(scale * x), stored.

    Rows with a component of LARGEST or more in size have a null v.
    """

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            big = np.append(0, np.cumsum(np.abs(flat) >= LARGEST))
            whole = np.floor(np.clip(flat, -LARGEST, LARGEST) * scale).astype("<i4")
            v = [None if big[y] > big[x] else whole[x:y].tobytes() for x, y in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(v, pa.binary())], ["vec_id", "label", "v"])

    small_batches(vectors.sparkSession)
    rows = vectors.where(finite(F.col("embedding"))).select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    return stored(rows.mapInArrow(of, rows.select("vec_id", "label").schema.add("v", "binary")), "vectors")


def _cut(column: pa.Array, parts: int, size: int) -> np.ndarray:
    """rows x parts x components, the last part filled up with zeros."""
    flat = np.frombuffer(b"".join(column.to_pylist()), "<i4").astype(np.int64).reshape(len(column), size)
    width = -(-size // parts)
    return np.pad(flat, ((0, 0), (0, width * parts - size))).reshape(len(column), parts, width)


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[np.ndarray, int]:
    """The codebooks (parts x entries x components) after Lloyd's rounds over `scaled` rows, and the length of a vector.

    The row of the least vec_id (null last, of equal ids the least vector) sets the length; rows of other lengths take no part.
    Codebooks start as the first `entries` rows in that order, fewer if there are fewer. Each round replaces an entry by the
    floored mean of its parts; entries without any stay. A round's sums come to the driver, one row for each part, entry and component.
    """
    # a leading sign bit would sort after; the bytes only break ties between equal ids
    order = [F.asc_nulls_last("vec_id"), F.asc("v")]
    rows = rows.where("v is not null")
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64), 0
    size = len(first[0]["v"]) // 4
    rows = rows.where(F.octet_length("v") == 4 * size).select("vec_id", "v")
    start = rows.orderBy(*order).limit(entries).collect()  # `entries` rows at most
    books = _cut(pa.array([bytes(r["v"]) for r in start], pa.binary()), parts, size).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        now = books

        @relieved
        def sums(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            sliced = [Sliced(b) for b in now]
            total, count = np.zeros_like(now), np.zeros(now.shape[:2], np.int64)
            for batch in batches:
                x = _cut(batch.column(0), parts, size)
                for p in range(parts):
                    code = sliced[p].nearest(x[:, p])[0]
                    np.add.at(total[p], code, x[:, p])
                    count[p] += np.bincount(code, minlength=now.shape[1])
            p, e, c = (a.ravel().astype(np.int32) for a in np.indices(now.shape))
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (p, e, c, total.ravel(), np.repeat(count.ravel(), now.shape[2]))], ["part", "entry", "component", "total", "n"])

        found = rows.select("v").mapInArrow(sums, "part int, entry int, component int, total bigint, n bigint").where("n > 0")
        books = now.copy()
        for r in found.groupBy("part", "entry", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            books[r["part"], r["entry"], r["component"]] = r["total"] // r["n"]
    return books, size


def encode(rows: DataFrame, books: np.ndarray, size: int) -> DataFrame:
    """(vec_id, label, code, error) of `scaled` rows: two hex digits a part for up to 256 entries (four beyond), and the summed squared distance.

    Rows without v or of another length have a null code and error.
    """
    parts, digits = len(books), "%02x" if books.shape[1] <= 256 else "%04x"

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = [Sliced(b) for b in books]
        for batch in batches:
            fits = np.array([v is not None and len(v) == 4 * size for v in batch.column(2).to_pylist()], bool)
            x = _cut(batch.column(2).filter(pa.array(fits)), parts, size)
            found = [sliced[p].nearest(x[:, p]) for p in range(parts)] if len(x) else []
            code, error = np.full(len(fits), None, object), np.zeros(len(fits), np.int64)
            if found:
                code[fits] = ["".join(digits % c for c in row) for row in np.stack([f[0] for f in found], axis=1)]
                error[fits] = sum(f[1] for f in found)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code.tolist(), pa.string()), pa.array(error, pa.int64(), mask=~fits)], ["vec_id", "label", "code", "error"])

    small_batches(rows.sparkSession)
    return rows.select("vec_id", "label", "v").mapInArrow(of, rows.select("vec_id", "label").schema.add("code", "string").add("error", "long"))


def decode(codes: DataFrame, books: np.ndarray, size: int, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, approximate) of codes(vec_id, code): the vector that a code stands for; null for a null code."""
    parts, k, width = books.shape
    digits = 2 if k <= 256 else 4

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if c is None else np.concatenate([books[p, int(c[p * digits : (p + 1) * digits], 16)] for p in range(parts)])[:size] / scale for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_(pa.float64()))], ["vec_id", "code", "approximate"])

    return codes.select("vec_id", "code").mapInArrow(of, codes.select("vec_id", "code").schema.add("approximate", ArrayType(DoubleType())))


def with_label_errors(codes: DataFrame) -> DataFrame:
    """codes(label, error, ...) with label_error: the error summed over the rows of the label, nulls together; null beyond 64 bits."""
    sums = stored(codes.groupBy("label").agg(F.try_sum("error").alias("label_error")), "labels")
    if sums.count() <= FEW:
        sums, own, on = F.broadcast(sums), codes, F.lit(True)
    else:
        sums = sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = codes.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
        on = F.col("_salt") == F.col("salt")
    sums = sums.withColumnRenamed("label", "_label")
    return own.join(sums, on & own.label.eqNullSafe(F.col("_label")), "left").drop("_label", "_salt", "salt")


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of vectors(vec_id, embedding, label).

    Rows whose vector is null or holds null or non-finite components are dropped. A component is the integer floor(scale * x). Rows that repeat
    a vec_id or all columns are rows of their own, learnt and returned as often as they occur; a null vec_id stands last. Rows of another length than
    the first row's, or with a component of LARGEST or more in size, get a null code and error. A length that `parts` don't divide is filled up with
    zeros. Other columns are ignored; an empty table gives none.
    """
    rows = scaled(vectors.select("vec_id", "embedding", "label"), scale)
    books, size = train(rows, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    codes = stored(encode(rows, books, size), "codes")
    return with_label_errors(codes).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op11_vector_codes(spark, sf_dir):
    """Codes of all embeddings."""
    return compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(rounds: int = ROUNDS) -> str:
    nearest = "SELECT p.vec_id, p.part, p.x, arg_min(b.e, struct_pack(d := list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.c[i]) ** 2)), e := b.e)) AS e, min(list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - b.c[i]) ** 2))) AS d FROM p JOIN b{0} b ON p.part = b.part GROUP BY ALL"
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({nearest.format(r)})")
        steps.append(f"s{r} AS (SELECT part, e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM (SELECT part, e, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY part, e, i)")
        steps.append(f"m{r} AS (SELECT part, e, list((s - ((s % n + n) % n)) // n ORDER BY i) AS c FROM s{r} GROUP BY part, e)")
        steps.append(f"b{r + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN m{r} m ON m.part = b.part AND m.e = b.e)")
    return f"""
WITH k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS x FROM k, (SELECT unnest(range({PARTS})) AS part)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k QUALIFY e < {ENTRIES}),
b0 AS MATERIALIZED (SELECT part, e, x AS c FROM p JOIN f USING (vec_id)),
{", ".join(steps)},
z AS MATERIALIZED ({nearest.format(rounds)}),
o AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM z GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) FROM b{rounds}) AS codebooks_sha256
FROM o JOIN k USING (vec_id)"""


OP11_SQL = _sql()
