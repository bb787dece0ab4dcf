"""Language, quality and language-model scores."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lang_id, lm_score, quality
from tidemark.llm.common import mix64

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lang_id.predicted(docs).where(lang_id.held_out(3) & F.col("lang").isNotNull() & (F.length("text") > 100))
    n, good = got.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 200 and good >= 0.97 * n


def test_language_edges(spark, docs, empty):
    rows = {r["doc_id"]: r for r in lang_id.predicted(docs).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (300, 301, 302))
    assert rows[0]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in rows.values())
    assert lang_id.predicted(empty).count() == 0
    assert {r[0] for r in lang_id.predicted(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").collect()} == {"und"}


def test_language_of_one_text_stands_alone():
    e = lang_id.Encoder()
    a, _ = e.bundle(["hello world", "", "日本語のテキスト"])
    b, has = lang_id.Encoder().bundle(["日本語のテキスト"])
    assert np.array_equal(a[2], b[0]) and not a[1].any() and has[0]


def _bundled(text, dims=1024):
    """The plain definition: each three letters' rotated vectors multiplied, all products added up."""

    def letter(c):
        with np.errstate(over="ignore"):
            bits = mix64(np.uint64(ord(c)) * np.uint64(0x9E3779B97F4A7C15) + np.arange(dims // 64, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        return np.unpackbits(bits.view(np.uint8)).astype(int) * 2 - 1

    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    line, out = " " + " ".join(words) + " ", np.zeros(dims)
    for gram, n in Counter(zip(line, line[1:], line[2:])).items():
        out += n * np.prod([np.roll(letter(c), j) for j, c in enumerate(gram)], axis=0)
    return out


def test_language_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 1500").orderBy("doc_id").limit(60).select("doc_id", "text", "lang")
    docs = docs.union(spark.createDataFrame([(10**7, None, None), (10**7 + 1, "12 !", None), (10**7 + 2, "É1à", None), (10**7 + 3, "x", None)], docs.schema))
    unit, rows = (lambda v: v / max(np.linalg.norm(v), 1e-9)), docs.collect()
    learnt = {}
    for r in rows:
        if r["lang"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1:
            learnt[r["lang"]] = learnt.get(r["lang"], 0) + unit(_bundled(r["text"]))
    langs = sorted(learnt)
    got = {r["doc_id"]: r for r in lang_id.predicted(docs).collect()}
    assert len(langs) > 1 and len(got) == len(rows)
    for r in rows:
        said, score = got[r["doc_id"]]["lang_pred"], got[r["doc_id"]]["score"]
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (said, score) == ("und", 0.0)
            continue
        own = unit(_bundled(r["text"]))
        cosines = {x: max(0.0, float(own @ unit(learnt[x]))) for x in langs}
        assert abs(score - max(cosines.values())) < 2e-4 and cosines[said] > max(cosines.values()) - 2e-4


def test_language_ties_and_repeated_rows(spark):
    """Equal prototypes: the first language in alphabetical order; repeated rows are judged alike."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("one two three", "zz"), ("one two three", "aa"), ("vier fünf", "mm")])]
    docs = spark.createDataFrame(rows + rows, "doc_id bigint, text string, lang string")
    got = lang_id.identify(docs, *lang_id.learn(docs)).collect()
    assert sorted((r["doc_id"], r["lang_pred"]) for r in got) == [(0, "aa"), (0, "aa"), (1, "aa"), (1, "aa"), (2, "mm"), (2, "mm")]


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, docs, texts, empty):
    more = [(400, "a b c d e " * 5), (401, "x " * 5), (402, "l\nl\nl\n \n"), (403, "# $ a|b <c>"), (404, "p q r s t u p q r s t v w x y")]
    rows = docs.select("doc_id", "text", "lang", "key").union(spark.createDataFrame([(i, t, None, "") for i, t in more], "doc_id bigint, text string, lang string, key string"))
    got = quality.judged(rows).collect()
    want = {i: base(t) for i, t in [*texts, *more]}
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want[r["doc_id"]], r["doc_id"]
            assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])
    assert len(got) == rows.count() and quality.judged(empty).count() == 0


def test_quality_keeps_good_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judged(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in rows}
    assert kept[1] > 0.97 and kept[0] < 0.3


def test_distance(spark):
    df = spark.createDataFrame([([1, 1],), ([2, 0],), ([0, 0],)], "c array<bigint>")
    got = [r[0] for r in df.select(quality.distance(F.col("c"), [0.0, 1.0])).collect()]
    assert got[1] == 1.0 and got[2] is None and abs(got[0] - math.sqrt(0.5 * (0.5 + 0.5 * math.log2(0.5 / 0.75) + math.log2(1 / 0.75)))) < 1e-9


def test_lm_base(docs, texts, empty):
    got = lm_score.scored(docs).collect()
    rows = [(i, t) for i, t in [*texts, texts[0], (None, texts[1][1])]]
    out = {i: zlib.crc32((str(i) if i is not None else "").encode()) % 5 == 1 for i, _ in rows}
    toks = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    c = Counter(w for i, t in toks if not out[i] for w in t)
    n, v = sum(c.values()), len(c)
    want = {i: (out[i], len(t), sum(w in c for w in t), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for i, t in toks}
    assert len(got) == len(rows)
    for r in got:
        h, k, known, total, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, k, known, total)
        assert abs(r["base_score"] - score) < 1e-6 * max(1, abs(score)) and r["score"] < 0
    assert lm_score.scored(empty).count() == 0


def test_scores_stay_where_they_are_looked_up_and_how_rows_lie(spark, docs):
    """No pair by broadcast, or all; other partitions; repeated rows alike."""

    def scores(rows, **more):
        return sorted((str(r["doc_id"]), r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in lm_score.scored(rows, contexts=50, **more).collect())

    want = scores(docs)
    assert scores(docs, hot=1) == want == scores(docs.repartition(5))
    assert len(want) - len(set(want)) == 1  # the repeated row, scored like its twin


def test_seats():
    keys = np.arange(3, dtype=np.uint64)
    t, _ = lm_score.seat(np.array([1.0, 10, 5000]), np.full(3, 100.0), np.full(3, 0.1), 0.5, keys, 1)
    assert t[0] == 1 and 1 <= t[1] <= 10 and 10 < t[2] < 5000
    many = np.arange(4000, dtype=np.uint64)
    t, _ = lm_score.seat(np.full(4000, 2.0), np.zeros(4000), np.full(4000, 0.3), 0.5, many, 1)
    assert abs((t - 1).mean() - 1.5 * 0.3 / (1.5 * 0.3 + 0.5)) < 0.03  # the second customer's chance of a table of its own


def _corpus():
    r = np.random.default_rng(5)
    after = {i: r.permutation(12)[:3] for i in range(12)}
    rows = []
    for i in range(60):
        at, out = int(r.integers(12)), []
        for _ in range(30):
            out.append(f"w{at}")
            at = int(r.choice(after[at]))
        rows.append((i, " ".join(out)))
    return rows


def _hash(word):
    """A word's hash; "" is the end of a text."""
    _, w, _ = next(lm_score.tokens(pa.array([word])))
    return w[0]


def _probabilities(spark, rows, contexts):
    """Probability of every word and an unknown one in every context; contexts are words, or None for the shared one."""
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("train", F.lit(True))
    before = lm_score.frequent(lm_score.counted(docs, np.zeros(0, np.uint64)).groupBy("w").agg(F.sum("c").alias("c")), contexts)
    words = [*sorted({x for _, t in rows for x in t.split()}), "", "?"]
    names = {int(_hash(w)): w for w in words}
    none = spark.createDataFrame([(int(np.int64(_hash(w).view(np.int64))), u, 0, 1) for w in words for u in range(len(before) + 1)], "w bigint, u int, c bigint, n bigint")
    state, model = lm_score.sampled(lm_score.dishes(lm_score.counted(docs, before).union(none)), before, 6, 7)
    known = [names[int(x)] for x in before] + [None]
    return {(known[r["u"]], names[r["w"] % 2**64]): 10 ** r["score"] for r in lm_score.learnt(state, model).collect()}


@pytest.mark.parametrize("share", [1024, 12])
def test_scores_are_a_distribution_near_exact_gibbs(spark, share):
    """Probabilities after each context sum to 1, and a customer-by-customer sampler gives nearly the same.

    With a share of 1 / 1024 every word is a context by itself, with 1 / 12 some words have the shared one.
    """
    rows = _corpus()
    got = _probabilities(spark, rows, share)
    each = Counter(w for _, t in rows for w in [*t.split(), ""])
    alone = {w for w, c in each.items() if c * share > each.total()}
    assert {u for u, _ in got} == alone | {None} and (share == 1024) == (alone == set(each))
    contexts = alone | ({None} if share < 1024 else set())
    for u in contexts:
        assert abs(sum(p for (x, _), p in got.items() if x == u) - 1) < 1e-6

    counts = Counter()
    for _, t in rows:
        seq = ["", *t.split(), ""]
        counts.update((u if u in alone else None, w) for u, w in zip(seq, seq[1:]))
    words = sorted({w for _, w in counts})

    def share(values):
        once, twice = sum(v == 1 for v in values), sum(v == 2 for v in values)
        return min(0.95, max(0.05, once / max(1, once + 2 * twice)))

    d1, d0 = share(list(counts.values())), share(list(Counter(w for _, w in counts).values()))
    r, g0 = np.random.default_rng(1), 1 / (len(words) + 1)
    tables = {k: [] for k in counts}
    top = {w: [] for w in words}

    def add(seats, free, p_new, d, theta, total):
        weights = [max(0.0, n - d) for n in seats] + [(theta + d * total) * p_new]
        i = r.choice(len(weights), p=np.array(weights) / sum(weights))
        if i == len(seats):
            seats.append(0)
        seats[i] += 1
        return i == len(seats) - 1 and seats[i] == 1

    def parent(w):
        n, t = sum(map(sum, top.values())), sum(map(len, top.values()))
        return (sum(top[w]) - d0 * len(top[w]) + (1 + d0 * t) * g0) / (1 + n)

    def drop(seats):
        i = r.choice(len(seats), p=np.array(seats) / sum(seats))
        seats[i] -= 1
        if not seats[i]:
            seats.pop(i)
            return True
        return False

    mean = Counter()
    for sweep in range(30):
        for (u, w), c in counts.items():
            for _ in range(c):
                if sweep and drop(tables[u, w]):
                    drop(top[w])
                all_u = sum(len(t) for (x, _), t in tables.items() if x == u)
                if add(tables[u, w], None, parent(w), d1, 1.0, all_u):
                    add(top[w], None, g0, d0, 1.0, sum(map(len, top.values())))
        if sweep >= 10:
            for u in contexts:
                n = sum(c for (x, _), c in counts.items() if x == u)
                t = sum(len(x) for (y, _), x in tables.items() if y == u)
                for w in words:
                    own = tables.get((u, w), [])
                    mean[u, w] += (sum(own) - d1 * len(own) + (1 + d1 * t) * parent(w)) / (1 + n) / 20
    off = [abs(math.log10(got[k]) - math.log10(mean[k])) for k in counts]
    assert np.average(off, weights=list(counts.values())) < 0.03 and max(off) < 0.4


def test_model_prefers_its_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6, "qzx vjw xqk zzv kqj wxz " * 20)], "doc_id bigint, text string")
    rows = lm_score.scored(docs.union(odd)).selectExpr("doc_id", "held_out", "score / n_tokens as s").collect()
    held = [r["s"] for r in rows if r["held_out"] and r["doc_id"] < 10**6]
    assert sum(held) / len(held) > -6 and all(r["s"] < 0 for r in rows)


def test_model_tells_prose_from_its_shuffle(spark):
    """Same words, other order: a model of single words scores both alike."""
    r = np.random.default_rng(3)
    after, rows = {i: r.permutation(40)[:2] for i in range(40)}, []
    held = [i for i in range(10**4, 10**5) if zlib.crc32(str(i).encode()) % 5 == 1]
    learnt = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 != 1]
    for i in learnt[:50] + held[:10]:
        at, out = int(r.integers(40)), []
        for _ in range(120):
            out.append(f"w{at}")
            at = int(r.choice(after[at]))
        rows.append((i, " ".join(out)))
    rows += [(j, " ".join(r.permutation(t.split()))) for j, (_, t) in zip(held[10:], rows[50:])]
    got = {x["doc_id"]: x["score"] / x["n_tokens"] for x in lm_score.scored(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert np.mean([got[i] for i in held[:10]]) > np.mean([got[i] for i in held[10:20]]) + 0.3


def test_rare_words_are_contexts_too(spark):
    """Where every word's share is below the bound, so that none has a restaurant right below that of all words, order still tells."""
    r = np.random.default_rng(3)
    after, rows = {i: r.permutation(40)[:2] for i in range(40)}, []
    held = [i for i in range(10**4, 10**5) if zlib.crc32(str(i).encode()) % 5 == 1]
    learnt = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 != 1]
    for i in learnt[:50] + held[:10]:
        at, out = int(r.integers(40)), []
        for _ in range(120):
            out.append(f"w{at}")
            at = int(r.choice(after[at]))
        rows.append((i, " ".join(out)))
    rows += [(j, " ".join(r.permutation(t.split()))) for j, (_, t) in zip(held[10:], rows[50:])]
    got = {x["doc_id"]: x["score"] / x["n_tokens"] for x in lm_score.scored(spark.createDataFrame(rows, "doc_id bigint, text string"), contexts=1).collect()}
    assert np.mean([got[i] for i in held[:10]]) > np.mean([got[i] for i in held[10:20]]) + 0.3


def test_rare_contexts_have_restaurants_of_their_own(spark):
    """Probabilities after each sum to 1, differ with their dishes, and are exact where a dish has one customer."""
    words, counts = range(20), {1: {0: 1, 1: 1, 2: 1}, 2: {3: 30, 4: 2}, 3: {}}
    pairs = spark.createDataFrame([(v, w, c.get(w, 0), 1) for v, c in counts.items() for w in words], "v bigint, w bigint, c bigint, n bigint")
    base = spark.createDataFrame([(w, 7, 0.05) for w in words], "w bigint, known bigint, p double")
    key = {int((np.array([w], np.uint64) ^ lm_score.mix64(np.array([v], np.uint64))).view(np.int64)[0]): (v, w) for v in counts for w in words}
    got = {key[r["key"]]: 10 ** r["score"] for r in lm_score.below(pairs, base, 3, 7).collect()}
    for v in counts:
        assert abs(sum(got[v, w] for w in words) - 1) < 1e-9
    d = 3 / (3 + 2 * 1)  # three dishes of one customer, one of two
    assert abs(got[1, 0] - (1 - d + (1 + 3 * d) * 0.05) / 4) < 1e-12 and abs(got[1, 9] - (1 + 3 * d) * 0.05 / 4) < 1e-12
    assert got[2, 3] > 0.8 and all(abs(got[3, w] - 0.05) < 1e-12 for w in words)


def test_contexts_are_not_cut_between_batches():
    values = [1, 1, 1, 2, 2, 2, 2, 2, 3, 4, 4, 5]
    for size in (1, 2, 3, 5, 12):
        batches = [pa.RecordBatch.from_arrays([pa.array(values[i : i + size])], ["v"]) for i in range(0, 12, size)]
        got = [b.column(0).to_pylist() for b in lm_score.whole(batches, 2)]
        assert sum(got, []) == values and all(a[-1] != b[0] for a, b in zip(got, got[1:])) and len(got) > (size < 12)


def test_close_languages_are_told_apart_before_rounding(spark):
    import numpy as np

    from tidemark.llm import lang_id

    vector = lang_id._units(lang_id.Encoder().bundle(["some words of a text"])[0].astype(float))[0]
    noise = np.zeros_like(vector)
    noise[0] = 0.003
    prototypes = lang_id._units(np.stack([vector + noise, vector]))
    got = lang_id.identify(spark.createDataFrame([(1, "some words of a text")], "doc_id bigint, text string"), ["aa", "bb"], prototypes).first()
    assert got["lang_pred"] == "bb" and got["score"] == 1.0
