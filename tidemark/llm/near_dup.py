"""Near-duplicate documents by HyperMinHash.

A document's word shingles are hashed by 128 functions. Of each function's least value a register keeps
the number of leading zeros (6 bits) and the next 10 bits (the mantissa). Four registers make a band.
Documents that share a band are candidates; the share of equal registers, corrected for accidental
collisions, drops those far below the threshold, and the rest are verified on their full shingle sets.

Two documents of similarity 0.8 share none of the 32 bands with a chance of (1 - 0.8**4)**32 < 5e-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, mix64, relieved, small_batches, stored
from .textblocks import shingle_sets

BANDS, ROWS, MANTISSA = 32, 4, 10
REGISTERS = BANDS * ROWS
#: Documents and bytes in a block; members of the bands whose members far from the hub make pairs.
BLOCK, BLOCK_BYTES, PAIRED = 512, 1 << 23, 32
#: Pairs of a hub that meet one copy of its set.
MEET = 256
_XOR = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_MUL = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xABC98388FB8FAC03)) | np.uint64(1)


def registers(least: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of 64-bit minima, packed in 16 bits."""
    high = least.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        high |= high >> np.uint64(shift)
    zeros = (64 - np.bitwise_count(high)).astype(np.uint64)
    shifted = np.where(zeros >= 63, np.uint64(0), least << np.minimum(zeros + np.uint64(1), np.uint64(63)))
    return ((np.minimum(zeros, np.uint64(63)) << np.uint64(MANTISSA)) | (shifted >> np.uint64(64 - MANTISSA))).astype(np.uint16)


def sketch(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bands (rows of BANDS int64, each of ROWS registers) of sets without empty ones."""
    least = np.empty((len(offsets) - 1, REGISTERS), np.uint64)
    for k in range(REGISTERS):
        least[:, k] = np.minimum.reduceat((hashes ^ _XOR[k]) * _MUL[k], offsets[:-1])
    return np.ascontiguousarray(registers(least)).view(np.int64)


def estimate(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from equal registers, less those that collide by accident.

    Minima of two unrelated sets of n and m fall in one register value with a chance of about
    0.17 * 2**-MANTISSA * 4nm / (n + m)**2.
    """
    equal = (left.view(np.uint16).reshape(len(left), -1) == right.view(np.uint16).reshape(len(right), -1)).mean(axis=1)
    by_chance = 0.17 * 2.0**-MANTISSA * 4 * n * m / (n + m) ** 2.0
    return np.maximum(0, equal - by_chance) / (1 - by_chance)


def _fixed(flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * BANDS, flat.reshape(-1))


def _digests(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of a cryptographic digest over each ascending set, so equal ones are equal sets; 0 for an empty set."""
    made = b"".join(hashlib.blake2b(hashes[i:j], digest_size=16).digest() if j > i else bytes(16) for i, j in zip(ends, ends[1:]))
    both = np.frombuffer(made, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), the set's digest f1 and f2, and its bands; null for an empty set."""

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, ends in shingle_sets(batch.column(1), size):
                n = np.diff(ends)
                f1, f2 = _digests(hashes, ends)
                bands = np.zeros((len(n), BANDS), np.int64)
                full = np.flatnonzero(n > 0)
                if len(full):
                    bands[full] = sketch(hashes, np.append(ends[:-1][full], len(hashes)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(n)), pa.array(n, pa.int64()), pa.array(f1), pa.array(f2), _fixed(bands)], ["doc_id", "n", "f1", "f2", "bands"])

    return docs.select("doc_id", "text").mapInArrow(of, "doc_id bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>")


def _spread(pairs: DataFrame, sides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pairs(a, b, many) with a salt, and sides(key, ...) as many times as its hub has salts: about MEET pairs meet one copy of a hub's side."""
    salts = F.ceil(F.col("many") / MEET).cast("int")
    hubs = pairs.groupBy("a").agg(F.max(salts).alias("salts"))
    copies = sides.join(hubs, sides.key == hubs.a).drop("a").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return pairs.select("a", "b", "many", F.pmod(F.xxhash64("b"), salts).cast("int").alias("salt")), copies


def _likely(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b, many) whose estimate is not far (five deviations) below the threshold."""
    floor = threshold - 5 * (threshold * (1 - threshold) / REGISTERS) ** 0.5
    salted, hubs = _spread(pairs, reps.select("key", "n", "bands"))
    both = salted.join(hubs.selectExpr("key a", "salt", "n na", "bands ba"), ["a", "salt"]).join(reps.selectExpr("key b", "n nb", "bands bb"), "b")

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if not x.num_rows:
                continue
            n, m = (x.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            left, right = (np.ascontiguousarray(x.column(c).flatten().to_numpy()).reshape(-1, BANDS) for c in ("ba", "bb"))
            # sizes that far apart cannot reach the threshold
            keep = (estimate(left, right, n, m) >= floor) & (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9)
            yield x.select(["a", "b", "many"]).filter(pa.array(keep))

    return both.select("a", "b", "many", "na", "nb", "ba", "bb").mapInArrow(of, "a bigint, b bigint, many bigint")


def _sets(docs: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """(key, shingles) of reps(key, doc_id, f1, f2): ascending 64-bit hashes of the text of the doc_id whose set has the digest."""

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, ends in shingle_sets(batch.column(0), size):
                rows = batch.slice(first, len(ends) - 1)
                f1, f2 = _digests(hashes, ends)
                own = np.flatnonzero((rows.column(2).to_numpy() == f1) & (rows.column(3).to_numpy() == f2))
                yield pa.RecordBatch.from_arrays([rows.column(1).take(pa.array(own)), pa.array([hashes[ends[i] : ends[i + 1]].tobytes() for i in own], pa.binary())], ["key", "shingles"])

    found = docs.select("doc_id", "text").join(reps, "doc_id").select("text", "key", "f1", "f2").mapInArrow(of, "key bigint, shingles binary")
    # rows that repeat a doc_id and text
    return found.dropDuplicates(["key"]) if docs.select("doc_id").count() > docs.select("doc_id").distinct().count() else found


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, na, nb, linked, apart) of pairs(a, b, many): whether 100 * |intersection| >= percent * |union| on full sets, and what only one has."""

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            sizes, linked, apart = ([], []), [], []
            for p, q in zip(x.column("sa"), x.column("sb")):
                p, q = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                odd = np.setxor1d(p, q, assume_unique=True)
                union = (len(p) + len(q) + len(odd)) // 2
                linked.append(100 * (union - len(odd)) >= percent * union)
                apart.append(odd.tobytes())
                sizes[0].append(len(p))
                sizes[1].append(len(q))
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b"), pa.array(sizes[0], pa.int64()), pa.array(sizes[1], pa.int64()), pa.array(linked, pa.bool_()), pa.array(apart, pa.binary())], ["a", "b", "na", "nb", "linked", "apart"])

    salted, hubs = _spread(pairs, sets)
    both = salted.join(hubs.selectExpr("key a", "salt", "shingles sa"), ["a", "salt"]).join(sets.selectExpr("key b", "shingles sb"), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(of, "a bigint, b bigint, na bigint, nb bigint, linked boolean, apart binary")


def block_links(left: list[dict], right: list[dict], percent: int) -> list[tuple[int, int]]:
    """A link from each left row to every other root that a right row of it is linked with.

    Rows: doc, root, n, apart (what the row and the hub don't share). Rows x and y have
    |apart_x| + |apart_y| - 2 |apart_x & apart_y| shingles not in common, so similarity is exact.
    """
    x, y = ([np.frombuffer(r["apart"], np.int64) for r in rows] for rows in (left, right))
    words, back = np.unique(np.concatenate([*x, *y, np.zeros(0, np.int64)]), return_inverse=True)
    sx, sy = (np.array([len(v) for v in rows], np.int64) for rows in (x, y))
    row = np.concatenate((np.repeat(np.arange(len(x)), sx), np.repeat(np.arange(len(y)), sy)))
    is_x = np.arange(len(row)) < sx.sum()
    common = np.zeros((len(x), len(y)), np.float32)
    for first in range(0, len(words), 4096):
        width = min(4096, len(words) - first)
        own = (back >= first) & (back < first + width)
        parts = []
        for side, n in ((is_x, len(x)), (~is_x, len(y))):
            m = np.zeros((n, width), np.float32)
            m[row[own & side], back[own & side] - first] = 1
            parts.append(m)
        common += parts[0] @ parts[1].T
    nx, ny = (np.array([r["n"] for r in rows], np.int64) for rows in (left, right))
    odd = sx[:, None] + sy[None, :] - 2 * common.astype(np.int64)
    union = (nx[:, None] + ny[None, :] + odd) // 2
    rx, ry = (np.array([r["root"] for r in rows], np.int64) for rows in (left, right))
    found = (100 * (union - odd) >= percent * union) & (rx[:, None] != ry[None, :])
    links = {(left[i]["doc"], ry[j]): right[j]["doc"] for i, j in zip(*np.nonzero(found))}
    return [(a, b) for (a, _), b in links.items()]


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members(hub, doc, root, n, apart) of one hub and different roots.

    Members of the hub's main root link with each other already. All others are compared with all members, block
    by block. Blocks have about BLOCK documents and BLOCK_BYTES; blocks of others are dealt out to the hub's blocks
    by (hub, block), so a large hub's work is spread over as many keys as it has blocks.
    """
    size = F.octet_length("apart").cast("bigint")
    counts = members.groupBy("hub", "root").agg(F.count("*").alias("many"), F.sum(size).alias("bytes"))
    main = F.max_by(F.struct("root", "many", "bytes"), F.struct("many", "root"))
    mixed = counts.groupBy("hub").agg(main.alias("main"), F.sum("many").alias("many"), F.sum("bytes").alias("bytes"), F.count("*").alias("roots")).where("roots > 1")

    def blocks(many, amount):
        return F.greatest(F.ceil(many / BLOCK), F.ceil(amount / BLOCK_BYTES)).cast("int")

    mixed = mixed.select("hub", F.col("main.root").alias("main"), blocks(F.col("many"), F.col("bytes")).alias("blocks"), blocks(F.col("many") - F.col("main.many"), F.col("bytes") - F.col("main.bytes")).alias("others"))
    own = stored(members.join(mixed, "hub"), "members")
    row = F.collect_list(F.struct("doc", "root", "n", "apart"))
    right = own.select("hub", "doc", "root", "n", "apart", F.pmod(F.xxhash64("doc"), "blocks").alias("block")).groupBy("hub", "block").agg(row.alias("y"))
    left = own.where("root <> main").withColumn("other", F.pmod(F.xxhash64("doc"), "others")).groupBy("hub", "other", "blocks").agg(row.alias("x"))
    left = left.select("hub", "x", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks").cast("bigint") - 1)).alias("block"))

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                links = block_links(x.as_py(), y.as_py(), percent)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array([v[i] for v in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    return left.join(right, ["hub", "block"]).select("x", "y").mapInArrow(of, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs(doc_id, text).

    Words stand between ASCII white space, A-Z lower-cased; a set is the distinct `size`-word shingles,
    or the whole sequence of fewer words, or empty without words. Sets are linked at `percent` or more;
    component_id is the least doc_id reachable, kept is doc_id = component_id. Empty and null texts link
    with nothing. Rows with a null doc_id are returned with a null component and kept. Rows of one doc_id
    count as one document: equal texts give one row, and different texts lie in one component. Extra columns
    are ignored; an empty table gives none. Texts of any length are taken whole.

    Equal sets, by their size and a 128-bit digest of the whole set, are one class, which has a key of its own, before any pair is made. A band's members are
    compared with their least one (a star, never all pairs). Members that no star links with their hub's main component are then compared with
    the hub's other members in blocks, by what each has and the hub has not, or the other way round.
    """
    small_batches(docs.sparkSession)
    threshold = percent / 100
    sig = stored(signatures(docs, size), "signatures")
    ids = sig.where("n > 0 and doc_id is not null")
    classes = ids.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))  # equal sets have equal bands
    reps = stored(classes.withColumn("key", F.monotonically_increasing_id()), "classes")
    member = ids.select("doc_id", "n", "f1", "f2").distinct().join(reps.select("n", "f1", "f2", "key"), ["n", "f1", "f2"]).select("doc_id", "key")
    rows = reps.select("key", F.posexplode("bands").alias("band", "value"))
    shared = rows.groupBy("band", "value").agg(F.min("key").alias("least"), F.count("*").alias("many")).where("many > 1")
    near = stored(rows.join(shared, ["band", "value"]), "bands")
    sets = stored(_sets(docs, reps.join(near.select("key").distinct(), "key").select("key", "doc_id", "f1", "f2"), size), "shingles")

    def compared(pairs: DataFrame) -> DataFrame:
        return stored(_compared(stored(_likely(pairs, reps, threshold), "likely"), sets, percent), "compared")

    def pairs(rows: DataFrame, a: Column, b: Column) -> DataFrame:
        return rows.groupBy(a.alias("a"), b.alias("b")).agg(F.max("many").alias("many"))

    stars = pairs(near.where("key <> least"), F.col("least"), F.col("key"))
    first = compared(stars)
    # members far from their hub: in large bands they join the blocks, in others they make pairs
    far = near.where("key <> least").join(first.select(F.col("a").alias("least"), F.col("b").alias("key")), ["least", "key"], "left_anti")
    far = stored(far, "far")
    first = first.union(stored(_compared(pairs(far.where(F.col("many") > PAIRED), F.col("least"), F.col("key")), sets, percent), "compared"))
    linked = first.where("linked").select("a", "b")
    roots = stored(components(linked), "roots")

    def rooted(rows: DataFrame, doc: str, name: str) -> DataFrame:
        return rows.join(roots.select(F.col("node").alias("_n"), F.col("root").alias(name)), F.col(doc) == F.col("_n"), "left").drop("_n").withColumn(name, F.coalesce(name, doc))

    hubs = first.groupBy("a").agg(F.max("na").alias("n")).select(F.col("a").alias("hub"), F.col("a").alias("doc"), "n", F.lit(b"").alias("apart"))
    members = first.select(F.col("a").alias("hub"), F.col("b").alias("doc"), F.col("nb").alias("n"), "apart").union(hubs)
    across = stored(_across(rooted(members, "doc", "root"), percent), "across")
    far = far.where(F.col("many") <= PAIRED).select("band", "value", "many", F.col("key").alias("x"))
    rest = rooted(rooted(far, "x", "rx").join(near.select("band", "value", F.col("key").alias("y")), ["band", "value"]), "y", "ry").where("rx <> ry")
    rest = pairs(rest, F.least("x", "y"), F.greatest("x", "y")).join(stars.select("a", "b"), ["a", "b"], "left_anti")
    linked = linked.union(across).union(compared(rest).where("linked").select("a", "b"))
    # classes as their least doc_ids; the texts of one doc_id belong together
    named = reps.select("key", "doc_id")
    edges = linked.join(named.withColumnsRenamed({"key": "a", "doc_id": "x"}), "a").join(named.withColumnsRenamed({"key": "b", "doc_id": "y"}), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    own = member.join(named.withColumnRenamed("doc_id", "rep"), "key").groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("texts"))
    several = own.where("texts > 1").select("doc_id")
    same = member.join(several, "doc_id").join(named.withColumnRenamed("doc_id", "rep"), "key").join(own.select("doc_id", "low"), "doc_id").where("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b"))
    roots = components(edges.union(same))
    rooted = own.join(roots, F.col("low") == F.col("node"), "left").select("doc_id", F.coalesce("root", "low").alias("root"))
    out = sig.where("doc_id is not null").select("doc_id", "n").distinct().join(rooted, "doc_id", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    lost = sig.where("doc_id is null").select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("bigint").alias("component_id"), F.lit(True).alias("kept"))
    return out.union(lost)


def op8_near_duplicates(spark, sf_dir):
    """Near-duplicates of all documents on two-word shingles at 80 per cent."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), size=2, percent=80)


OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) WHEN len(w) = 1 THEN w ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS root FROM w UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id WHERE r.root < e.b)
SELECT w.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.root) AS component_id, min(r.root) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.doc_id = w.doc_id GROUP BY w.doc_id
"""
