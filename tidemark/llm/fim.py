"""Fill-in-middle by a learned rank index.

A text's tokens are words with the white space before them. The index of a text is a piecewise-linear function from
a token's rank to the offset of its boundary: segments that miss no boundary by more than ERROR bytes, and the exact
residual of every boundary in one byte. A cut is predicted by its segment and put right by its residual.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import relieved, small_batches
from .textblocks import IS_SPACE, blocks

#: The most bytes that a segment misses a boundary by, so that a residual takes one signed byte; binary places of a slope.
ERROR, SHIFT = 127, 16
MARKERS = ("<P>", "<S>", "<M>")


class Index(NamedTuple):
    """Segments in the order of their first boundary, and every boundary's residual; boundaries of several texts may follow each other."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def offsets(self, at: np.ndarray) -> np.ndarray:
        """The offsets of the boundaries `at`: predicted, then corrected."""
        s = np.searchsorted(self.first, at, "right") - 1
        return self.base[s] + ((at - self.first[s]) * self.slope[s] >> SHIFT) + self.residual[at]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text's boundaries (0, then the end of each token, from its own first byte) in a row, and where each text's begin."""
    space = IS_SPACE[data]
    close = np.zeros(len(data), bool)
    if len(data):
        close[:-1] = ~space[:-1] & space[1:]
        close[offsets[1:][np.diff(offsets) > 0] - 1] = True
    ends = np.flatnonzero(close) + 1
    n = np.diff(np.searchsorted(ends, offsets, "right"))
    row = np.repeat(np.arange(len(n)), n)
    places = np.zeros(len(ends) + len(n), np.int64)
    places[np.arange(len(ends)) + row + 1] = ends - offsets[row]
    return places, np.append(0, np.cumsum(n + 1))


def fit(places: np.ndarray, starts: np.ndarray, error: int = ERROR) -> Index:
    """The index of boundaries. A segment goes from its first to its last boundary; one that misses by more than `error` is halved."""
    first, last = starts[:-1], starts[1:] - 1
    residual, firsts, slopes = np.zeros(len(places), np.int8), [], []
    while len(first):
        size = last - first + 1
        slope = ((places[last] - places[first]) << SHIFT) // np.maximum(size - 1, 1)
        begin = np.cumsum(size) - size
        along = np.arange(size.sum()) - np.repeat(begin, size)
        at = along + np.repeat(first, size)
        miss = places[at] - np.repeat(places[first], size) - (along * np.repeat(slope, size) >> SHIFT)
        good = np.maximum.reduceat(np.abs(miss), begin) <= error
        kept = np.repeat(good, size)
        residual[at[kept]] = miss[kept]
        firsts.append(first[good])
        slopes.append(slope[good])
        first, last = first[~good], last[~good]
        middle = (first + last) // 2
        first, last = np.concatenate((first, middle + 1)), np.concatenate((middle, last))
    first = np.concatenate([*firsts, np.zeros(0, np.int64)])
    order = np.argsort(first)
    return Index(first[order], places[first[order]], np.concatenate([*slopes, np.zeros(0, np.int64)])[order], residual)


def boundary_index(docs: DataFrame) -> DataFrame:
    """(doc_id, n, segments, residuals) of each row of docs(doc_id, text): the number of tokens, the segments (first rank, offset there
    in bytes, slope in 2**-16 bytes) and a signed byte for each of the n + 1 boundaries.

    A null text is empty and has the one boundary 0. Rows are taken one by one, repeated ones as often as they occur;
    other columns are ignored, and an empty table gives none.
    """

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in blocks(batch.column(1)):
                places, starts = boundaries(data, offsets)
                index = fit(places, starts)
                cut = np.searchsorted(index.first, starts)
                own = index.first - np.repeat(starts[:-1], np.diff(cut))
                segments = pa.ListArray.from_arrays(cut.astype(np.int32), pa.StructArray.from_arrays([pa.array(own), pa.array(index.base), pa.array(index.slope)], ["first", "base", "slope"]))
                residuals = pa.array([index.residual[x:y].tobytes() for x, y in zip(starts, starts[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(np.diff(starts) - 1), segments, residuals], ["doc_id", "n", "segments", "residuals"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(of, "doc_id bigint, n bigint, segments array<struct<first:bigint,base:bigint,slope:bigint>>, residuals binary")


def boundary_at(rank: Column) -> Column:
    """The offset in bytes of boundary `rank` of a row of boundary_index, without its text; null for ranks below 0 or over n."""
    own = F.element_at(F.filter("segments", lambda s: s["first"] <= rank), -1)
    byte = F.conv(F.hex(F.substring(F.col("residuals"), rank.cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    exact = own["base"] + F.shiftright((rank - own["first"]) * own["slope"], SHIFT) + byte - F.when(byte > 127, 256).otherwise(0)
    return F.when((rank >= 0) & (rank <= F.col("n")), exact)


def draws(seed: int) -> Column:
    """Four numbers below 2**32 for each doc_id: a SHA-256 of the seed and the id. A null doc_id counts as empty."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.transform(F.array(*[F.substring(h, 1 + 8 * i, 8) for i in range(4)]), lambda x: F.conv(x, 16, 10).cast("bigint"))


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """docs(doc_id, text) with n, form, prefix_chars, middle_chars, output and n_segments after its columns.

    A text is cut at two token boundaries that its doc_id draws. psm: prefix, suffix, middle; spm: suffix, prefix, middle, each after its
    marker; plain: the text as it is, for texts that aren't drawn, are empty or hold a marker. n counts tokens, prefix_chars and
    middle_chars code points (null if plain); n_segments is the size of the text's index. A null text is empty. Rows of one doc_id get the same
    draws; equal rows get equal results. Texts of any length are cut whole. Own columns of these names are replaced; an empty table gives none.
    """
    new = ("n", "form", "prefix_chars", "middle_chars", "output", "n_segments")
    kept = [c for c in docs.columns if c not in new]
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.contains(text, F.lit(MARKERS[0])) | F.contains(text, F.lit(MARKERS[1])) | F.contains(text, F.lit(MARKERS[2]))
    rows = docs.select(F.struct(*kept).alias("row"), text.alias("text"), draws(seed).alias("h"), marked.alias("marked"))
    form = F.when((F.col("text") == "") | F.col("marked") | (F.col("h")[2] % 100 >= percent), "plain").when(F.col("h")[3] % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.select("row", "text", F.col("h")[0].alias("h1"), F.col("h")[1].alias("h2"), form.alias("form"))
    p, s, m = (x.encode() for x in MARKERS)

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy() for c in (2, 3))
            forms = batch.column(4).to_pylist()
            for first, last, data, offsets in blocks(batch.column(1)):
                places, starts = boundaries(data, offsets)
                index = fit(places, starts)
                n = np.diff(starts) - 1
                ranks = np.stack((h1[first:last] % (n + 1), h2[first:last] % (n + 1)))
                low, high = (offsets[:-1] + index.offsets(starts[:-1] + r) for r in (ranks.min(axis=0), ranks.max(axis=0)))
                letters = np.append(0, np.cumsum(data & 0xC0 != 0x80))
                whole, out = data.tobytes(), []
                for form, a, b, c, d in zip(forms[first:last], offsets.tolist(), low.tolist(), high.tolist(), offsets[1:].tolist()):
                    if form == "plain":
                        out.append(whole[a:d])
                    elif form == "psm":
                        out.append(b"".join((p, whole[a:b], s, whole[c:d], m, whole[b:c])))
                    else:
                        out.append(b"".join((s, whole[c:d], p, whole[a:b], m, whole[b:c])))
                plain = np.array([f == "plain" for f in forms[first:last]])
                chars = [pa.array(letters[y] - letters[x], pa.int64(), mask=plain) for x, y in ((offsets[:-1], low), (low, high))]
                segments = np.diff(np.searchsorted(index.first, starts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(n), pa.array(forms[first:last]), *chars, pa.array(out, pa.binary()).cast(pa.string()), pa.array(segments)], ["row", *new])

    small_batches(docs.sparkSession)
    schema = rows.select("row").schema.add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long").add("output", "string").add("n_segments", "long")
    return rows.mapInArrow(of, schema).select(*[F.col("row").getField(c).alias(c) for c in kept], *new)


def restored(output: Column, form: Column) -> Column:
    """The exact text that fill_in_middle made an output of: the parts between the markers, in the order of the form."""
    parts = F.split(output, "|".join(MARKERS), -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))


def op13_fill_in_middle(spark, sf_dir):
    """Every document cut, put together and restored again."""
    made = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h FROM documents),
k AS (SELECT *, list_transform(regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'), lambda x: length(x)) AS w, list_transform(range(4), lambda i: CAST('0x' || h[8 * i + 1 : 8 * i + 8] AS BIGINT)) AS r FROM d),
f AS (SELECT *, len(w) AS n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 50 THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
c AS (SELECT *, CAST(coalesce(list_sum(w[1 : least(r[1] % (n + 1), r[2] % (n + 1))]), 0) AS BIGINT) AS a, CAST(coalesce(list_sum(w[1 : greatest(r[1] % (n + 1), r[2] % (n + 1))]), 0) AS BIGINT) AS b FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || t[1 : a] || '<S>' || t[b + 1 :] || '<M>' || t[a + 1 : b] ELSE '<S>' || t[b + 1 :] || '<P>' || t[1 : a] || '<M>' || t[a + 1 : b] END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c
"""
