"""Repeated and near-duplicate lines, by hashes and deletion neighbourhoods.

Lines are sequences of words, and the edit bound is one word put in, taken out or exchanged. Equal lines meet by
their hash. For near ones all variants of a line within the bound, the line itself and the line without each of its
words, are emitted as hashed keys; equal keys bring lines together, their edit distance is verified, and the
earliest line stays.

Two lines within the bound share the first or the last half of their words (of the shorter one's). Only
lines that share such a half with another line emit variants; no pair is lost by that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

#: A line that takes over 1 / SHARED of all lines is looked up by broadcast: SHARED rows at most.
SHARED = 1 << 12
#: White space that stands for a blank.
BLANKS = "\t\x0b\f\r"


def _lines(text: Column) -> Column:
    """The lines of a text, lower-cased, every other white space a blank."""
    plain = F.lower(text)
    for c in BLANKS:
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    return F.split(plain, "\n", -1)


def _canonical(line: Column) -> Column:
    """The words of a line with one blank between."""
    line = F.trim(line)
    return F.when(F.contains(line, F.lit("  ")), F.regexp_replace(line, " {2,}", " ")).otherwise(line)


def _count(line: Column) -> Column:
    """The number of words of a canonical line."""
    blanks = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
    return F.when(line == "", 0).otherwise(blanks + 1)


def _first(line: Column, n: Column) -> Column:
    """The first n words, or the last -n."""
    return F.call_function("substring_index", line, F.lit(" "), n)


def _one_edit(a: Column, b: Column) -> Column:
    """Whether word arrays are within one edit: the rest after the first difference is equal."""
    long, short = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)

    def rest(x: Column, y: Column) -> Column:
        at = F.coalesce(F.get(F.filter(F.sequence(F.lit(0), F.size(y) - 1), lambda i: F.get(x, i) != F.get(y, i)), F.lit(0)), F.size(y))
        return let(at, lambda p: F.slice(x, p + 2, F.size(x)) == F.slice(y, F.when(F.size(x) == F.size(y), p + 2).otherwise(p + 1), F.size(y)))

    return (F.size(long) - F.size(short) <= 1) & let(long, lambda x: let(short, lambda y: rest(x, y)))


def duplicate_lines(docs: DataFrame, min_words: int = 1, edit_words: int = 8) -> DataFrame:
    """(doc_id, text_hash, drops): the places, from 0, of the lines to drop in docs(doc_id, text) that have some.

    Lines stand between line feeds; words between ASCII white space, lower-cased. A line of `min_words` words or
    more is dropped if an earlier one is equal; one of `edit_words` or more also if an earlier one of as many is
    within one word's edit (in shorter lines one word is too much of the meaning). Lines without words stay.
    Earlier is the lower (doc_id, text_hash, place), null doc_ids first. Rows of the same doc_id and text
    count once and get the same drops. Null texts have no lines. Texts and lines of any length are taken whole.
    """
    own = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    lines = own.select("doc_id", "text_hash", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    lines = lines.select("doc_id", "text_hash", "pos", _canonical(F.col("line")).alias("line"))
    lines = lines.select("doc_id", "text_hash", "pos", "line", _count(F.col("line")).alias("n"))
    line, n = F.col("line"), F.col("n")
    half, less = F.shiftright(n, 1), F.shiftright(n - 1, 1)

    def end(side: int, count: Column, where: Column) -> Column:
        return F.when(where, F.xxhash64(F.lit(side), _first(line, count if side == 0 else -count)))

    long = n >= edit_words
    even = long & (half != less)
    ends = [end(0, half, long).alias("e0"), end(1, half, long).alias("e1"), end(0, less, even).alias("e2"), end(1, less, even).alias("e3")]
    # equal lines are within the edit bound too
    lines = stored(lines.select("doc_id", "text_hash", "pos", "n", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"), *ends), "lines").where(F.col("n") >= max(1, min(min_words, edit_words)))
    place = F.struct("doc_id", "text_hash", "pos")
    halves = ["e0", "e1", "e2", "e3"]
    first = stored(lines.groupBy("h1", "h2", "n").agg(F.min(place).alias("first"), F.count("*").alias("many"), *[F.min(e).alias(e) for e in halves]), "first")

    halved = first.where(F.col("n") >= edit_words).select("h1", F.explode(F.array_compact(F.array(*halves))).alias("half"))
    shared = halved.groupBy("half").agg(F.count("*").alias("many")).where("many > 1").select("half")
    likely = halved.join(shared, "half").select("h1").distinct()
    at = first.join(likely, "h1").groupBy(F.col("first.doc_id").alias("d"), F.col("first.text_hash").alias("t")).agg(F.collect_list(F.struct("h1", "h2", "n", "first")).alias("spots"))
    texts = own.join(at, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")))
    spots = let(_lines(F.col("text")), lambda rows: F.transform("spots", lambda s: F.struct(s["h1"].alias("h1"), s["h2"].alias("h2"), s["n"].alias("n"), s["first"].alias("first"), _canonical(F.get(rows, s["first"]["pos"])).alias("line"))))
    likely = stored(texts.select(F.explode(spots).alias("s")).select("s.*"), "likely")

    cut = likely.select("h1", "n", "line", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    without = F.trim(F.concat(_first(F.col("line"), F.col("i")), F.lit(" "), _first(F.col("line"), F.col("i") + 1 - F.col("n"))))
    cut = cut.select("h1", F.xxhash64(without).alias("v"), (F.col("n") - 1).alias("len"), "i")
    variants = stored(cut.union(likely.select("h1", F.col("h1").alias("v"), F.col("n").alias("len"), F.lit(-1).alias("i"))), "variants")
    several = variants.groupBy("v").agg(F.count("*").alias("many")).where("many > 1").select("v")
    met = stored(variants.join(several, "v").join(likely.select("h1", "first"), "h1"), "met")
    both = met.groupBy("v", "len").agg(F.min(F.when(F.col("i") < 0, F.col("first"))).alias("whole"), F.min(F.when(F.col("i") >= 0, F.col("first"))).alias("cut"))
    swapped = met.where("i >= 0").groupBy("v", "len", "i").agg(F.min("first").alias("swap"))
    partner = F.when(F.col("i") < 0, F.col("cut")).otherwise(F.least("whole", "swap"))
    near = met.join(both, ["v", "len"]).join(swapped, ["v", "len", "i"], "left").withColumn("partner", partner).where("partner < first").groupBy("h1").agg(F.min("partner").alias("partner"))
    near = near.join(likely.select("h1", "h2", "line"), "h1").join(likely.select(F.col("first").alias("partner"), F.col("line").alias("earlier")), "partner")
    near = near.where(_one_edit(F.split("line", " "), F.split("earlier", " "))).select("h1", "h2").distinct()

    # of a near line its first occurrence goes; the others repeat it. Lines that take over 1 / SHARED of all meet theirs by broadcast
    near = near.join(first.select("h1", "h2", "first"), ["h1", "h2"]).select("first.doc_id", "first.text_hash", "first.pos")
    total = first.agg(F.sum("many")).first()[0] or 0
    repeated = first.where("many > 1").select("h1", "h2", "first", (F.col("many") * SHARED > total).alias("hot"))
    hot = stored(repeated.where("hot").drop("hot"), "hot")  # SHARED rows at most
    later = lines.select("doc_id", "text_hash", "pos", "h1", "h2")
    often = later.join(F.broadcast(hot), ["h1", "h2"])
    seldom = later.join(F.broadcast(hot.select("h1", "h2")), ["h1", "h2"], "left_anti").join(repeated.where("not hot").drop("hot"), ["h1", "h2"])
    dropped = often.unionByName(seldom).where(~place.eqNullSafe(F.col("first"))).select("doc_id", "text_hash", "pos").union(near)
    return dropped.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("drops"))


def _with_drops(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """row (docs' columns) and drops (null if none) of each row of docs."""
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("d"), F.xxhash64("text").alias("t"))
    drops = drops.withColumnsRenamed({"doc_id": "drop_id", "text_hash": "drop_hash"})
    return own.join(drops, F.col("d").eqNullSafe(F.col("drop_id")) & (F.col("t") == F.col("drop_hash")), "left")


def dedup_lines(docs: DataFrame, min_words: int = 1, edit_words: int = 8) -> DataFrame:
    """docs with the lines of `duplicate_lines` taken out of `text`, other columns as they are, whatever their names.

    A document that loses all its lines keeps the empty text; a null text stays null.
    """
    marked = _with_drops(docs, duplicate_lines(docs, min_words, edit_words))
    lines = F.split("row.text", "\n", -1)
    kept = let(lines, lambda x: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), F.col("drops")), lambda i: F.get(x, i)), "\n"))
    text = F.when(F.col("drops").isNull(), F.col("row.text")).otherwise(kept).alias("text")
    return marked.select(*[text if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def op9_line_dedup(spark, sf_dir):
    """The lines that are dropped from every document: their number and places."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    n_lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("bigint").alias("n_lines")
    own = docs.select("doc_id", F.xxhash64("text").alias("t"), n_lines)
    drops = duplicate_lines(docs).withColumnsRenamed({"doc_id": "drop_id", "text_hash": "drop_hash"})
    marked = own.join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.col("t") == F.col("drop_hash")), "left")
    drops = F.coalesce("drops", F.array().cast("array<int>"))
    return marked.select("doc_id", "n_lines", F.size(drops).cast("bigint").alias("n_dropped"), F.array_join(F.transform(drops, lambda i: i.cast("string")), ",").alias("dropped"))


OP9_SQL = r"""
WITH l AS (SELECT doc_id, p - 1 AS pos, list_filter(regexp_split_to_array(lower(x[p]), '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w
           FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS p FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))),
k AS (SELECT doc_id, pos, w, array_to_string(w, ' ') AS s FROM l WHERE len(w) >= 1),
f AS (SELECT s, any_value(w) AS w, len(any_value(w)) AS n, min(doc_id * 1000000 + pos) AS loc FROM k GROUP BY s),
v AS (SELECT s, loc, n, i, array_to_string(w[:i - 1] || w[i + 1:], ' ') AS v FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM f WHERE n >= 8)),
near AS (SELECT b.s FROM v a JOIN v b ON a.v = b.v AND a.i = b.i AND a.n = b.n AND a.loc < b.loc
         UNION SELECT f.s FROM v JOIN f ON v.v = f.s AND v.loc < f.loc AND f.n >= 8
         UNION SELECT v.s FROM v JOIN f ON v.v = f.s AND f.loc < v.loc AND f.n >= 8),
d AS (SELECT k.doc_id, k.pos FROM k JOIN f USING (s) WHERE k.doc_id * 1000000 + k.pos <> f.loc OR k.s IN (SELECT s FROM near)),
g AS (SELECT doc_id, count(*) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS p FROM d GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_dropped, coalesce(p, '') AS dropped
FROM documents LEFT JOIN g USING (doc_id)
"""
