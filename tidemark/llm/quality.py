"""Quality rules by distribution divergence.

A document's histograms of character classes and of common words are compared with those of each language,
summed over the corpus, by Jensen-Shannon distance. A document that is near no language's histograms is
rejected; documents of few words are not judged by a histogram that they are too short for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, let, stored, words_of

# Frequent function words of four languages, in tiers of eight.
COMMON = (
    ("the", "of", "and", "to", "a", "in", "is", "that"),
    ("for", "it", "as", "was", "with", "be", "by", "on"),
    ("not", "he", "his", "but", "at", "are", "this", "have"),
    ("der", "die", "und", "in", "den", "von", "zu", "das"),
    ("mit", "sich", "des", "auf", "für", "ist", "im", "dem"),
    ("nicht", "ein", "eine", "als", "auch", "es", "an", "werden"),
    ("de", "la", "le", "et", "les", "des", "en", "un"),
    ("du", "une", "que", "est", "pour", "qui", "dans", "par"),
    ("au", "ne", "sur", "se", "pas", "plus", "avec", "sont"),
    ("de", "la", "que", "el", "en", "y", "los", "del"),
    ("se", "las", "por", "un", "para", "con", "una", "su"),
    ("al", "lo", "como", "más", "pero", "sus", "le", "es"),
)
SYMBOLS = "#*$%&|<>"
DIGITS, BLANKS, POINTS = "0123456789", " \t\n\x0b\x0c\r", ".,;:!?'\"()-"
#: The least words for the rule of the base, for the character and for the common-word histogram.
MIN_BASE, MIN_CHARS, MIN_WORDS = 10, 20, 60
#: The largest accepted distances (the square root of the divergence in bits, 0 to 1).
MAX_CHARS, MAX_COMMON = 0.3, 0.28


def _of(text: Column, letters: str) -> Column:
    """How many characters of a text are among `letters`."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def repeated_words(words: Column, window: int = 5) -> Column:
    """How many words lie in windows of `window` words that the text has twice or more.

    Windows are sorted by a 32-bit hash with their place below it; those whose hash recurs are sorted by
    their words, so equal ones stand side by side, and the places of those that recur are counted.
    """
    n = F.size(words) - window + 1
    low = F.lit(0xFFFFFFFF).cast("bigint")
    keyed = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.shiftleft(F.hash(*[F.get(words, i + j) for j in range(window)]).cast("bigint"), 32).bitwiseOR(i.cast("bigint")))

    def beside(x: Column, i: Column, same) -> Column:
        return F.coalesce(same(F.get(x, i), F.get(x, i - 1)), F.lit(False)) | F.coalesce(same(F.get(x, i), F.get(x, i + 1)), F.lit(False))

    def recurring(x: Column, same) -> Column:
        return F.filter(x, lambda v, i: beside(x, i, same))

    def places(at: Column) -> Column:
        texts = F.array_sort(F.transform(at, lambda v: let(v.bitwiseAND(low).cast("int"), lambda i: F.struct(F.slice(words, i + 1, window).alias("w"), i.alias("i")))))
        return let(texts, lambda x: F.array_sort(F.transform(recurring(x, lambda a, b: a["w"] == b["w"]), lambda v: v["i"])))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda v, i: F.least(F.lit(window), F.coalesce(F.get(at, i + 1) - v, F.lit(window)))), F.lit(0).cast("bigint"), lambda a, v: a + v)

    candidates = let(F.sort_array(keyed), lambda x: recurring(x, lambda a, b: F.shiftright(a, 32) == F.shiftright(b, 32)))
    found = let(candidates, lambda c: F.when(F.size(c) == 0, F.lit(0).cast("bigint")).otherwise(let(places(c), covered)))
    return F.when(n < 2, F.lit(0).cast("bigint")).otherwise(found)


def _with_word(line: Column) -> Column:
    return F.length(F.translate(line, BLANKS, "")) > 0


def features(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, lang, the base's counts, and the histograms `chars` and `common` of docs(doc_id, text, lang)."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", F.hash("text").alias("text_hash"), "lang", text.alias("text"))
    lines = let(F.filter(F.split("text", "\n", -1), _with_word), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    tiers = [sorted(set(t)) for t in COMMON]
    known = sorted({w for t in COMMON for w in t})

    def of_words(w: Column) -> Column:
        shared = F.transform(F.filter(w, lambda x: (F.length(x) <= max(map(len, known))) & ascii_lower(x).isin(known)), ascii_lower)
        tier_counts = let(shared, lambda s: F.array(*[F.size(F.filter(s, _among(t))) for t in tiers], F.size(s)))
        return F.struct(F.size(w).cast("bigint").alias("n_words"), repeated_words(w).alias("n_repeat_words"), tier_counts.alias("tiers"))

    x = let(words_of(F.col("text")), of_words)
    t = F.col("text")
    found = docs.select("doc_id", "text_hash", "lang", F.length(t).alias("n"), x.alias("x"), lines.cast("bigint").alias("n_dup_lines"), *[_of(t, s).alias(c) for c, s in (("blank", BLANKS), ("lower", LOWER), ("upper", UPPER), ("digit", DIGITS), ("point", POINTS), ("symbol", SYMBOLS))])
    rest = F.col("n") - F.col("blank") - F.col("lower") - F.col("upper") - F.col("digit") - F.col("point") - F.col("symbol")
    other = F.greatest(F.lit(0).cast("bigint"), F.col("x.n_words") - F.element_at("x.tiers", -1))
    chars = F.array(*[F.col(c).cast("bigint") for c in ("blank", "lower", "upper", "digit", "point", "symbol")], rest.cast("bigint"))
    common = F.concat(F.slice(F.transform("x.tiers", lambda v: v.cast("bigint")), 1, len(COMMON)), F.array(other))
    return found.select("doc_id", "text_hash", "lang", "x.n_words", (F.col("n") - F.col("blank")).cast("bigint").alias("word_chars"), F.col("symbol").cast("bigint").alias("n_symbols"), "n_dup_lines", "x.n_repeat_words", chars.alias("chars"), common.alias("common"))


def _among(words: list[str]):
    return lambda x: x.isin(words)


def references(found: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Each language's histograms over all its documents, as shares: a row for each language."""
    sums = [F.sum(F.get("chars", F.lit(i))).alias(f"a{i}") for i in range(7)] + [F.sum(F.get("common", F.lit(i))).alias(f"b{i}") for i in range(len(COMMON) + 1)]
    rows = found.where("lang is not null").groupBy("lang").agg(*sums).orderBy("lang").collect()

    def shares(counts: list[int]) -> list[float]:
        return [c / max(1, sum(counts)) for c in counts]

    return {r["lang"]: (shares([r[f"a{i}"] for i in range(7)]), shares([r[f"b{i}"] for i in range(len(COMMON) + 1)])) for r in rows}


def distance(counts: Column, share: list[float]) -> Column:
    """Jensen-Shannon distance of an array of counts from shares; null without counts."""
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, v: a + v)

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def terms(n: Column) -> Column:
        out = F.lit(0.0)
        for i, q in enumerate(share):
            p = F.get(counts, F.lit(i)) / n
            m = (p + F.lit(q)) / 2
            out = out + (part(p, m) + part(F.lit(q), m)) / 2
        return out

    return F.when(total > 0, F.sqrt(F.greatest(F.lit(0.0), terms(total))))


def judged(docs: DataFrame) -> DataFrame:
    """The base's columns, base_failed, jsd_chars, jsd_common and kept for each row of docs(doc_id, text, lang).

    Words are `[^\\x20\\x09-\\x0D]+`; a null text has none. base_failed: under 10 words, or over a fifth
    of the words in recurring five-word windows. kept: the base holds, and the least distance from any
    language's histogram is within MAX_CHARS (from MIN_CHARS words on) and MAX_COMMON (from MIN_WORDS words
    on). Without a language in the table no distance is taken. Repeated rows and null doc_ids are judged like
    any row; other columns are ignored.
    """
    found = stored(features(docs), "features")
    known = references(found)
    least = [F.least(*x) if len(x) > 1 else x[0] if x else F.lit(None).cast("double") for x in ([distance(F.col(c), ref[k]) for ref in known.values()] for k, c in enumerate(("chars", "common")))]
    n = F.col("n_words")
    failed = (n < MIN_BASE) | (100 * F.col("n_repeat_words") > 20 * n)
    far = ((n >= MIN_CHARS) & F.coalesce(F.col("jsd_chars") > MAX_CHARS, F.lit(False))) | ((n >= MIN_WORDS) & F.coalesce(F.col("jsd_common") > MAX_COMMON, F.lit(False)))
    out = found.withColumns({"jsd_chars": least[0], "jsd_common": least[1], "base_failed": failed})
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), F.round("jsd_chars", 4).alias("jsd_chars"), F.round("jsd_common", 4).alias("jsd_common"))


def op6_quality(spark, sf_dir):
    """The base's counts and the verdict for every document."""
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    lower = "translate({}, '" + UPPER + "', '" + LOWER + "')"
    known = ", ".join(f"'{w}'" for w in sorted({w for t in COMMON for w in t}))
    tiers = ", ".join("len(list_filter(s, lambda x: x IN (" + ", ".join(f"'{w}'" for w in sorted(set(t))) + ")))" for t in COMMON)

    def count(letters: str) -> str:
        text = letters.replace("'", "''").replace("\t", "' || chr(9) || '").replace("\n", "' || chr(10) || '").replace("\x0b", "' || chr(11) || '").replace("\x0c", "' || chr(12) || '").replace("\r", "' || chr(13) || '")
        return f"length(t) - length(translate(t, '{text}', ''))"

    classes = ", ".join(count(x) for x in (BLANKS, LOWER, UPPER, DIGITS, POINTS, SYMBOLS))
    return rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
win AS (SELECT doc_id, i, w[i:i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY 1),
c AS (SELECT doc_id, lang, len(w) AS n, length(t) AS len, [{classes}] AS a, len(l) - len(list_distinct(l)) AS dup, list_filter(list_transform(w, lambda x: {lower.format("x")}), lambda x: x IN ({known})) AS s FROM d),
h AS (SELECT doc_id, lang, n, len, a, dup, list_append(a, len - list_sum(a)) AS ha, list_append([{tiers}], n - len(s)) AS hb FROM c),
x AS (SELECT doc_id, lang, kind, i, CAST(v AS DOUBLE) AS v FROM (SELECT doc_id, lang, 'a' AS kind, unnest(ha) AS v, unnest(range(len(ha))) AS i FROM h UNION ALL SELECT doc_id, lang, 'b', unnest(hb), unnest(range(len(hb))) FROM h)),
r AS (SELECT lang, kind, i, sum(v) / sum(sum(v)) OVER (PARTITION BY lang, kind) AS q FROM x WHERE lang IS NOT NULL GROUP BY lang, kind, i),
p AS (SELECT *, v / nullif(sum(v) OVER (PARTITION BY doc_id, kind), 0) AS p FROM x),
j AS (SELECT doc_id, kind, r.lang, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END / 2 + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END / 2))) AS jsd FROM p JOIN r USING (kind, i) WHERE p IS NOT NULL GROUP BY ALL),
m AS (SELECT doc_id, min(jsd) FILTER (kind = 'a') AS ja, min(jsd) FILTER (kind = 'b') AS jb FROM j GROUP BY 1),
f AS (SELECT h.*, ja, jb, coalesce(pos.n, 0) AS nr, h.n < {MIN_BASE} OR 100 * coalesce(pos.n, 0) > 20 * h.n AS bad FROM h LEFT JOIN m USING (doc_id) LEFT JOIN pos USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len - a[1] AS BIGINT) AS word_chars, CAST(a[6] AS BIGINT) AS n_symbols, CAST(dup AS BIGINT) AS n_dup_lines, CAST(nr AS BIGINT) AS n_repeat_words, bad AS base_failed,
  NOT bad AND NOT (n >= {MIN_CHARS} AND coalesce(ja > {MAX_CHARS}, false)) AND NOT (n >= {MIN_WORDS} AND coalesce(jb > {MAX_COMMON}, false)) AS kept, round(ja, 4) AS jsd_chars, round(jb, 4) AS jsd_common FROM f
"""


OP6_SQL = _oracle()
