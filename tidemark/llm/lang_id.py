"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector is the product (binding) of its letters'
vectors, each rotated by its place; a text's vector is the sum (bundling) of its n-grams' vectors; a
language's prototype is the sum of its documents' unit vectors. A document gets the language whose
prototype has the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix64, relieved, small_batches

DIMS, GRAM = 1024, 3
#: Characters that are worked on at a time; a longer text is a block of its own.
BLOCK = 1 << 18
#: n-gram vectors that a worker keeps, and columns multiplied at a time.
KEPT, COLUMNS = 1 << 14, 1 << 12


class Encoder:
    """Bundles texts; keeps the vectors of n-grams it has met, KEPT at most."""

    def __init__(self, dims: int = DIMS, gram: int = GRAM):
        self.dims, self.gram = dims, gram
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        self._forget()

    def _forget(self) -> None:
        self.codes, self.vectors = np.zeros(0, np.int64), np.zeros((0, self.dims), np.int8)

    def _made(self, codes: np.ndarray) -> np.ndarray:
        """The n-grams' vectors: bound from rotated letter vectors that a hash of the letter gives."""
        out = np.ones((len(codes), self.dims), np.int8)
        for j in range(self.gram):
            letters, back = np.unique((codes >> (21 * (self.gram - 1 - j))) & 0x1FFFFF, return_inverse=True)
            with np.errstate(over="ignore"):
                bits = mix64(letters.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(self.dims // 64, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
            signs = np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1
            out *= np.roll(signs, j, axis=1)[back]
        return out

    def of(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), max(0, len(self.codes) - 1))
        new = codes if not len(self.codes) else codes[self.codes[at] != codes]
        if len(new):
            if len(self.codes) + len(new) > KEPT:
                self._forget()
                new = codes
            both = np.concatenate((self.codes, new))
            order = np.argsort(both)
            self.codes, self.vectors = both[order], np.concatenate((self.vectors, self._made(new)))[order]
        return self.vectors[np.searchsorted(self.codes, codes)]

    def bundle(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A row of float32 sums for each text, and whether it has a letter."""
        lowered = [f" {t.lower()} " for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        row = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
        is_letter = self.letter[points]
        has = np.zeros(len(texts), bool)
        has[row[is_letter]] = True
        symbol = np.where(is_letter, points, 32).astype(np.int64)
        keep = np.ones(len(symbol), bool)
        keep[1:] = is_letter[1:] | is_letter[:-1] | (row[1:] != row[:-1])
        symbol, row = symbol[keep], row[keep]
        n = max(0, len(symbol) - self.gram + 1)
        codes = np.zeros(n, np.int64)
        for j in range(self.gram):
            codes = (codes << 21) | symbol[j : j + n]
        inside = row[:n] == row[self.gram - 1 :][:n]
        codes, row = codes[inside], row[:n][inside]
        out = np.zeros((len(texts), self.dims), np.float32)
        if not len(codes):
            return out, has
        grams, back = np.unique(codes, return_inverse=True)
        for first in range(0, len(grams), COLUMNS):
            own = slice(None) if len(grams) <= COLUMNS else (back >= first) & (back < first + COLUMNS)
            width = min(COLUMNS, len(grams) - first)
            rows, local = np.unique(row[own], return_inverse=True)
            counts = np.bincount(local * width + (back[own] - first), minlength=len(rows) * width).reshape(len(rows), width).astype(np.float32)
            out[rows] += counts @ self.of(grams[first : first + width]).astype(np.float32)
        return out, has


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > BLOCK:
            yield first, i
            first = i
            size = 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def learn(labelled: DataFrame, train_rows: int = 40_000) -> tuple[list[str], np.ndarray]:
    """Languages (ascending) and their unit prototypes from labelled(doc_id, text, lang).

    A hash of doc_id picks about `train_rows` of the rows with a text and a language; all, if fewer.
    """
    small_batches(labelled.sparkSession)
    labelled = labelled.where("lang is not null and text is not null")
    share = train_rows / max(1, labelled.select("doc_id").count())
    picked = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * share)) if share < 1 else labelled

    @relieved
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, encoder = {}, Encoder()
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in _blocks(texts):
                for lang, v in zip(langs[i:j], _units(encoder.bundle(texts[i:j])[0])):
                    total[lang] = total.get(lang, 0) + v
        for lang, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * DIMS), pa.array(np.arange(DIMS, dtype=np.int32)), pa.array(v.astype(np.float64))], ["lang", "dim", "part"])

    parts = picked.select("text", "lang").mapInArrow(sums, "lang string, dim int, part double")
    rows = parts.groupBy("lang", "dim").agg(F.sum("part").alias("part")).toPandas()  # languages x DIMS
    if not len(rows):
        return [], np.zeros((0, DIMS))
    table = rows.pivot(index="lang", columns="dim", values="part").sort_index()
    return list(table.index), _units(table.to_numpy())


def identify(docs: DataFrame, langs: list[str], prototypes: np.ndarray) -> DataFrame:
    """docs with lang_pred and score (the largest cosine, 0 to 1, rounded to four places) after its columns.

    A text that is null or has no letter, and any text if no language was learnt, gets `und` and 0.
    Equal cosines: the first language in alphabetical order.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = kept.index("text")
    schema = docs.select(kept).schema.add("lang_pred", "string").add("score", "double")

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for i, j in _blocks(texts):
                vectors, has = encoder.bundle(texts[i:j])
                if langs:
                    cosines = _units(vectors) @ prototypes.T
                    best = cosines.argmax(axis=1)
                    score = np.where(has, np.round(np.clip(cosines[np.arange(j - i), best], 0, 1), 4), 0.0)
                    said = [langs[b] if h else "und" for b, h in zip(best, has)]
                else:
                    score, said = np.zeros(j - i), ["und"] * (j - i)
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(said, pa.string()), pa.array(score, pa.float64())], [*kept, "lang_pred", "score"])

    return docs.select(kept).mapInArrow(of, schema)


def held_out(folds: int) -> Column:
    """crc32 of doc_id as text, modulo `folds`, is 1; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == 1


def predicted(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, lang) with lang_pred and score, learnt from the rows that aren't held out.

    Repeated rows are judged alike and learnt as often as they occur; null doc_ids count as empty; texts of any
    length are read whole; other columns stay as they are, but for own ones named lang_pred or score.
    """
    langs, prototypes = learn(docs.select("doc_id", "text", "lang").where(~held_out(3)))
    return identify(docs, langs, prototypes)


def op5_language_id(spark, sf_dir):
    """The language of every document, learnt from the rows that aren't held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    langs, prototypes = learn(docs.where(~held_out(3)))
    return identify(docs.select("doc_id", "text"), langs, prototypes).select("doc_id", held_out(3).alias("held_out"), "lang_pred", "score")
