"""Benchmark decontamination by winnowing.

A text's k-gram hashes are taken, and of every run of them that one window holds the least is kept as a fingerprint,
with its place. Equal windows have equal fingerprints at equal distances from their begin, so fingerprints of
training texts are joined with those of the benchmark's windows, and each hit is extended to the whole window and
compared word by word. Every shared window of `window` words is found.
"""

from __future__ import annotations

import json
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, stored, words_of

#: What stands between words: ASCII that is neither a digit nor a letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bits of the map of benchmark fingerprints for each of them, and the most in all (2 MB).
BITS_EACH, MOST_BITS = 16, 1 << 24


def item_words(text: Column) -> Column:
    return words_of(ascii_lower(text), SEPARATORS)


def fingerprints(words: Column, length: int, k: int = 5) -> Column:
    """For each window of `length` words, the least hash among its k-grams (null array: no window)."""
    k = min(k, length)
    least = let(grams(words, k), lambda g: leasts(g, length - k + 1))
    return F.when(F.size(words) >= length, least)


def grams(words: Column, k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))


def leasts(hashes: Column, run: int) -> Column:
    """The least of each `run` neighbours."""
    if run == 1:
        return hashes
    return F.transform(F.sequence(F.lit(1), F.size(hashes) - run + 1), lambda i: F.array_min(F.slice(hashes, i, run)))


def window_text(words: Column, start: Column, length: int) -> Column:
    """Words have no blank, so the joined words stand for the window exactly."""
    return F.array_join(F.slice(words, start + 1, length), " ")


def _bit_map(prints: DataFrame) -> tuple[Column, int]:
    """A map of the distinct fingerprints as an array of bigints, and its bits: BITS_EACH for one, MOST_BITS at most."""
    bits = 1 << min(int(log2(MOST_BITS)), max(10, ceil(log2(BITS_EACH * max(1, prints.count())))))
    slots = prints.select(F.pmod("print", F.lit(bits)).alias("bit"))
    words = slots.groupBy((F.col("bit") / 64).cast("int").alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    found = dict(words.collect())  # MOST_BITS / 64 rows at most, whatever the benchmark's size
    return F.from_json(F.lit(json.dumps([found.get(i, 0) for i in range(bits // 64)])), "array<bigint>"), bits


def _windows(items: DataFrame, length: int, k: int) -> DataFrame:
    """(item_id, length, win, print, lead): each window, its fingerprint and the words before that in it."""
    k = min(k, length)
    run = length - k + 1

    def of(words: Column) -> Column:
        def window(g: Column) -> Column:
            def one(i: Column) -> Column:
                own = F.slice(g, i + 1, run)
                return let(F.array_min(own), lambda x: F.struct(window_text(words, i, length).alias("win"), x.alias("print"), (F.array_position(own, x) - 1).cast("int").alias("lead")))

            return F.transform(F.sequence(F.lit(0), F.size(words) - length), one)

        return let(grams(words, k), window)

    return items.select("item_id", F.explode(of(F.col("words"))).alias("x")).select("item_id", F.lit(length).alias("length"), "x.win", "x.print", "x.lead")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, k: int = 5) -> DataFrame:
    """Judge each row of docs(doc_id, text) against benchmark(item_id, text).

    Words are runs of digits, letters and non-ASCII, A-Z lower-cased. An item's windows are its runs
    of `window` words, or all its words if it has fewer; items without words (empty or null) have none.
    A word of a document inside an occurrence of a window is hit; the document is contaminated if words
    are hit and `share` times their number is at least its words.

    Returns doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated. A null text has no
    words. Repeated rows are each judged on their own text; null doc_ids are kept. Extra columns don't
    matter. An empty benchmark hits nothing; an empty item list has the SHA-256 of the empty string.
    Texts of any length are read whole.

    A map of the benchmark's fingerprints keeps the others from the join; with over MOST_BITS / BITS_EACH of them
    it passes more than it must, and results stay exact. Each distinct window has one row, with its items in
    an array, so the join's rows don't multiply with the items that share it.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", item_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("length", F.least(F.size("words"), F.lit(window)))
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # at most `window` of them
    known = spark.createDataFrame([], "item_id bigint, length int, win string, print bigint, lead int")
    known = known.select(F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"), "length", "win", "print", "lead")
    for n in lengths:
        known = known.union(_windows(items.where(F.col("length") == n), n, k))
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    known = stored(known.groupBy("length", "print", "lead", "win").agg(ids.alias("ids")), "windows")
    in_map, bits = _bit_map(known.select("print").distinct())

    kind = "array<struct<length:int,print:bigint,at:int,before:int,words:array<string>>>"

    def passes(value: Column) -> Column:
        bit = F.pmod(value, F.lit(bits))
        return F.call_function("getbit", F.get(in_map, F.shiftright(bit, 6).cast("int")), (bit % 64).cast("int")) == 1

    def of_length(words: Column, n: int) -> Column:
        own = min(k, n)
        run = n - own + 1

        def hits(g: Column) -> Column:
            def met(least: Column) -> Column:
                starts = F.filter(F.sequence(F.lit(0), F.size(least) - 1), lambda i: passes(F.get(least, i)))
                return F.array_distinct(F.transform(starts, lambda i: F.struct(F.get(least, i).alias("print"), (i + F.array_position(F.slice(g, i + 1, run), F.get(least, i)) - 1).cast("int").alias("at"))))

            return let(leasts(g, run), met)

        # the words that any window with this fingerprint can have
        def around(x: Column) -> Column:
            before = F.least(x["at"], F.lit(run - 1))
            return F.struct(F.lit(n).alias("length"), x["print"].alias("print"), x["at"].alias("at"), before.alias("before"), F.slice(words, x["at"] - before + 1, n + run - 1).alias("words"))

        return F.coalesce(F.when(F.size(words) >= n, F.transform(let(grams(words, own), hits), around)), F.array().cast(kind))

    def candidates(words: Column) -> Column:
        return F.concat(F.array().cast(kind), *[of_length(words, n) for n in lengths])

    passed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), let(item_words(F.col("text")), lambda w: F.struct(F.size(w).cast("bigint").alias("n_words"), candidates(w).alias("found"))).alias("x"))
    passed = stored(passed.select("doc_id", "text_hash", "x.n_words", "x.found"), "fingerprints")
    prints = passed.where(F.size("found") > 0).select("doc_id", "text_hash", F.explode("found").alias("f")).select("doc_id", "text_hash", "f.*")
    met = prints.join(known, ["length", "print"]).where("lead <= before")
    whole = F.array_join(F.slice("words", F.col("before") - F.col("lead") + 1, F.col("length")), " ") == F.col("win")
    hits = met.where(whole).select("doc_id", "text_hash", (F.col("at") - F.col("lead")).cast("bigint").alias("at"), (F.col("at") - F.col("lead") + F.col("length")).cast("bigint").alias("end"), "ids")
    spans = F.array_sort(F.collect_set(F.struct("at", "end")))
    zero = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate(spans, zero, lambda a, s: F.struct(F.greatest(a["end"], s["end"]).alias("end"), (a["n"] + F.greatest(F.lit(0).cast("bigint"), s["end"] - F.greatest(a["end"], s["at"]))).alias("n")), lambda a: a["n"])
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids"))))
    hits = hits.groupBy("doc_id", "text_hash").agg(covered.alias("n_hit"), ids.alias("ids")).withColumnsRenamed({"doc_id": "hit_id", "text_hash": "hit_hash"})
    out = passed.join(hits, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select("doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def op10_decontaminate(spark, sf_dir):
    """Every document against the whole benchmark, by the 13-word rule."""
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contamination(docs.select("doc_id", "text"), benchmark).drop("text_hash")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT DISTINCT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""
