"""Language-model scores by a hierarchical Pitman-Yor model.

A token's context is the word before it (the end of the text before its first word), and every word has a restaurant of its own as a
context. Those of words that take over 1 / CONTEXTS of the training tokens, at most CONTEXTS, have one parent, the restaurant of all words.
Those of all other words have the shared restaurant between, which is one more child of the restaurant of all words. A restaurant's tables are its parent's
customers; to the shared one each dish of a context below sends its first table. The base measure of all words is uniform over the training tokens and
one unknown. Words are kept by 64-bit hashes.

Seating is sampled by Gibbs: a sweep reseats each dish's customers given all others', by sequential
proposals with an acceptance step. A dish's row needs only its count, its restaurant's number of tables and its base probability. So
a word with its dishes in every context is one row of bounded width, a sweep is one pass without a shuffle, and only the restaurants'
totals go through the driver. The restaurants below the shared one are independent of each other given its probabilities, so each is seated and reseated
where its dishes are put together, whatever their number. Draws are hashes of dish, context and sweep, so neither files nor partitions change a score. Predictive
probabilities are averaged over the sweeps after the first.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, released, relieved, small_batches, stored
from .lang_id import held_out
from .textblocks import blocks, word_hashes

#: The context of a word that takes over 1 / CONTEXTS of the training tokens is a child of all words, any other of the shared restaurant.
CONTEXTS = 1 << 10
#: A pair that takes over 1 / HOT of all tokens is looked up where texts are read: HOT rows of 24 bytes at most.
HOT = 1 << 21
#: Tokens that a worker counts before it passes their counts on.
COUNTED = 1 << 20
#: Customers come in parties of 1 + seated div PARTY, whatever the dish: one by one first, then of at most a 64th of those seated.
PARTY = 64
SWEEPS, STRENGTH = 3, 1.0
#: The end of a text, a token and the context of the first word.
END = np.uint64(0x5EED)
STATE = "w bigint, u array<int>, c array<bigint>, n array<bigint>, known bigint, tables array<double>, weight array<double>, mass array<double>, own double, own_weight double, kept array<double>"


def draw(keys: np.ndarray, *salts: int) -> np.ndarray:
    """A number from 0 to 1 for each 64-bit key, by hash."""
    x = keys.view(np.uint64)
    with np.errstate(over="ignore"):
        for s in salts:
            x = mix64(x + np.uint64(s + 1) * np.uint64(0x9E3779B97F4A7C15))
    return (x >> np.uint64(11)).astype(float) * 2.0**-53


def seat(count: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, keys: np.ndarray, sweep: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of dishes with `count` customers, seated in turn, and the log weight of that proposal.

    others: tables of the restaurant's other dishes; base: the dish's probability in the parent.
    """
    order = np.argsort(-count, kind="stable")
    n, base, others, keys = count[order].astype(float), base[order], others[order].astype(float), keys[order]
    tables, weight, seated = np.minimum(n, 1.0), np.zeros(len(n)), 1
    while live := int(np.searchsorted(-n, -seated, "left")):
        size = np.minimum(1 + seated // PARTY, n[:live] - seated)
        t = tables[:live]
        new = (STRENGTH + discount * (others[:live] + t)) * base[:live]
        total = np.maximum(new + seated - discount * t, 1e-300)
        opened = np.floor(size * np.clip(new / total, 0.0, 1.0) + draw(keys[:live], sweep, seated))
        tables[:live] += np.minimum(opened, size)
        weight[:live] += size * np.log(total)
        seated += 1 + seated // PARTY
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return tables[back], weight[back]


def resit(count, tables, weight, all_tables, base, discount: float, keys, sweep: int, changed=False) -> tuple[np.ndarray, np.ndarray]:
    """One Gibbs step of every dish; rows without tables yet, or with other customers than before, are seated."""
    new, new_weight = seat(count, np.maximum(0, all_tables - tables), base, discount, keys, sweep)
    take = (tables == 0) | changed | (np.log(np.maximum(draw(keys, sweep, -1 & 0xFFFF), 1e-300)) < new_weight - weight)
    return np.where(take, new, tables), np.where(take, new_weight, weight)


def tokens(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, offsets of the rows in them): A-Z lower-cased words between ASCII white space, then the end."""
    for first, last, data, offsets in blocks(column):
        words, at = word_hashes(data, offsets)
        yield first, np.insert(words, at[1:], END), at + np.arange(last - first + 1)


def preceding(w: np.ndarray) -> np.ndarray:
    """The word before each token; every text ends with the end."""
    return np.append(END, w[:-1])


def numbered(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """The number of each word among the contexts; len(contexts) is the shared one."""
    if not len(contexts):
        return np.zeros(len(words), np.int32)
    at = np.minimum(np.searchsorted(contexts, words), len(contexts) - 1)
    return np.where(contexts[at] == words, at, len(contexts)).astype(np.int32)


def context(w: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """The context's number of each token, that of the word before."""
    return numbered(preceding(w), contexts)


def pair_keys(w: np.ndarray, u: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """One 64-bit key of each pair, whatever the contexts' numbers."""
    return w ^ mix64(np.append(contexts, np.uint64(1)))[u]


def counted(docs: DataFrame, contexts: np.ndarray, apart: bool = False) -> DataFrame:
    """(w, u, c, n): tokens of docs(text, train) by word and context, in training rows and in all; several rows a pair.

    With `apart` there is v, the hash of the word before for pairs of the shared context, which it keeps apart; 0 for others.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush():
            w, u, train = (np.concatenate(x) for x in zip(*held))
            held.clear()
            words, code = np.unique(w, return_inverse=True)
            wide = len(words) if apart else len(contexts) + 1
            pair, code = np.unique(code * wide + (np.append(code[-1], code[:-1]) if apart else u), return_inverse=True)
            word, u = np.divmod(pair, wide)
            more = []
            if apart:
                v = words[u]
                u = numbered(words, contexts)[u]
                more = [pa.array(np.where(u < len(contexts), np.uint64(0), v).view(np.int64))]
            c = np.bincount(code, train, len(pair)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words[word].view(np.int64)), pa.array(u, pa.int32()), pa.array(c), pa.array(np.bincount(code, minlength=len(pair))), *more], names)

        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for first, w, at in tokens(batch.column(0)):
                held.append((w, w if apart else context(w, contexts), np.repeat(train[first : first + len(at) - 1], np.diff(at)).astype(float)))
                if sum(len(x[0]) for x in held) >= COUNTED:
                    yield from flush()
        if held:
            yield from flush()

    names = ["w", "u", "c", "n", "v"][: 4 + apart]
    return docs.select("text", "train").mapInArrow(relieved(of), "w bigint, u int, c bigint, n bigint" + ", v bigint" * apart)


def frequent(vocab: DataFrame, contexts: int) -> np.ndarray:
    """Hashes, ascending, of the words in vocab(w, c) that take over 1 / contexts of the training tokens."""
    total = vocab.agg(F.sum("c")).first()[0] or 0
    return np.sort(np.array([r[0] for r in vocab.where(F.col("c") * contexts > total).select("w").collect()], np.int64).view(np.uint64))


def dishes(pairs: DataFrame) -> DataFrame:
    """One row a word with its counts in every context, from the rows of `counted`."""
    return gathered_by_word(pairs.groupBy("w", "u").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).withColumn("known", F.col("c")))


def gathered_by_word(pairs: DataFrame) -> DataFrame:
    """One row a word from one row a pair(w, u, c, n, known); known adds up to the word's training tokens."""
    rows = pairs.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("u", "c", "n"))).alias("x"), F.sum("known").alias("known"))
    return rows.select("w", "x.u", "x.c", "x.n", "known")


def gathered(batches: Iterator[pa.RecordBatch], cells: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The batches of words, put together to about so many dishes, as each costs as many rounds as its largest dish asks."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column(1).values)
        if size >= cells:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _lists(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lengths of the lists in the columns, which are equally long, and the columns' values in a row."""
    columns = [batch.column(n) for n in names]
    return np.diff(columns[0].offsets.to_numpy()), [c.flatten().to_numpy() for c in columns]


class Model(NamedTuple):
    """What all dishes share after sampling: an entry a sample, and a column a context in `back` and an entry in `customers`."""

    contexts: np.ndarray
    customers: np.ndarray
    back: np.ndarray
    rest: np.ndarray
    total: np.ndarray


def sampled(words: DataFrame, contexts: np.ndarray, sweeps: int, seed: int) -> tuple[DataFrame, Model]:
    """Seat the dishes of words(w, u, c, n, known) and reseat them `sweeps` times."""
    some = lambda x: F.size(F.filter("c", x))
    arrivals = some(lambda x: x > 0)
    n_words, w1, w2, p1, p2 = (x or 0 for x in words.agg(F.count_if(arrivals > 0), F.count_if(arrivals == 1), F.count_if(arrivals == 2), F.sum(some(lambda x: x == 1)), F.sum(some(lambda x: x == 2))).first())
    discount, pair_discount = (min(0.95, max(0.05, a / max(1, a + 2 * b))) for a, b in ((w1, w2), (p1, p2)))
    uniform, names = 1.0 / (n_words + 1), [x.split()[0] for x in STATE.split(", ")]

    def totals(table: DataFrame, column: str) -> np.ndarray:
        found = np.zeros(len(contexts) + 1)
        for u, x in table.select(F.explode(F.arrays_zip("u", F.col(column).alias("x"))).alias("e")).groupBy("e.u").agg(F.sum("e.x")).collect():  # a row a context
            found[u] = x
        return found

    customers = totals(words, "c")
    seats, all_tables, total = np.zeros(len(contexts) + 1), float(n_words), 0.0
    backs, rests, sizes, state = [], [], [], words
    for k in range(sweeps + 1):  # 0 seats words alone, each pair at one table

        def sweep(batches: Iterator[pa.RecordBatch], k=k, seats=seats, all_tables=all_tables, total=total) -> Iterator[pa.RecordBatch]:
            for batch in gathered(batches):
                w = batch.column(0).to_numpy().view(np.uint64)
                long, (u, c) = _lists(batch, "u", "c")
                row = np.repeat(np.arange(len(w)), long)
                if k:
                    _, (tables, weight, mass) = _lists(batch, "tables", "weight", "mass")
                    own, own_weight = (batch.column(n).to_numpy() for n in ("own", "own_weight"))
                    last = np.bincount(row, tables, len(w))
                    p = (last - discount * own + (STRENGTH + discount * all_tables) * uniform) / (STRENGTH + total)
                    tables, weight = resit(c, tables, weight, seats[u], p[row], pair_discount, pair_keys(w[row], u, contexts), seed + k)
                    mass = mass + (c - pair_discount * tables if k > 1 else 0.0)
                else:
                    tables, weight, mass = np.minimum(c, 1).astype(float), np.zeros(len(c)), np.zeros(len(c))
                    last = own = own_weight = np.zeros(len(w))
                a = np.bincount(row, tables, len(w))
                own, own_weight = resit(a, own, own_weight, np.full(len(w), all_tables if k else float(n_words)), np.full(len(w), uniform), discount, w, seed + k, a != last)
                if k > 1:
                    before = batch.column(names.index("kept")).flatten().to_numpy().reshape(len(w), k - 2)
                    kept = np.column_stack((before, a - discount * own))
                else:
                    kept = np.zeros((len(w), 0))
                ends = pa.array(np.append(0, np.cumsum(long)).astype(np.int32))
                listed = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (tables, weight, mass)]
                kept = pa.ListArray.from_arrays(pa.array((np.arange(len(w) + 1) * kept.shape[1]).astype(np.int32)), pa.array(kept.ravel()))
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:5]), *listed, pa.array(own), pa.array(own_weight), kept], names)

        old, state = state, stored(state.mapInArrow(relieved(sweep), STATE), "seats")
        released(old)
        seats = totals(state, "tables")
        all_tables, total = state.agg(F.sum("own")).first()[0] or 0.0, float(seats.sum())
        if k > 1:
            backs.append((STRENGTH + pair_discount * seats) / (STRENGTH + customers))
            rests.append((STRENGTH + discount * all_tables) * uniform)
            sizes.append(STRENGTH + total)
    return state, Model(contexts, customers, np.array(backs), np.array(rests), np.array(sizes))


def learnt(state: DataFrame, model: Model) -> DataFrame:
    """(key, w, u, c, n, score): log10 of each pair's predictive probability; c is the word's training count, n the pair's of all."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = len(model.rest)
        for batch in batches:
            w = batch.column(0).to_numpy().view(np.uint64)
            long, (u, n, mass) = _lists(batch, "u", "n", "mass")
            row = np.repeat(np.arange(len(w)), long)
            p = (batch.column("kept").flatten().to_numpy().reshape(len(w), samples) + model.rest) / model.total
            p = (mass / (STRENGTH + model.customers[u]) + (model.back.T[u] * p[row]).sum(1)) / samples
            known = batch.column("known").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (pair_keys(w[row], u, model.contexts).view(np.int64), w[row].view(np.int64), u, known[row], n, np.log10(np.maximum(p, 1e-300)))], ["key", "w", "u", "c", "n", "score"])

    return state.select("w", "u", "n", "known", "kept", "mass").mapInArrow(relieved(of), "key bigint, w bigint, u int, c bigint, n bigint, score double")


def whole(batches: Iterator[pa.RecordBatch], cells: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Batches of rows in the order of their first column, put together to at least so many rows, or all, without cutting one of its values."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        first = batch.column(0).to_numpy()
        at = int(np.searchsorted(first, first[-1]))  # its last value may go on
        if size >= cells and (at or held[:-1] and held[-2].column(0)[-1] != batch.column(0)[0]):
            yield pa.Table.from_batches([*held[:-1], batch.slice(0, at)]).combine_chunks().to_batches()[0]
            held, size = [batch.slice(at)], batch.num_rows - at
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def below(pairs: DataFrame, base: DataFrame, sweeps: int, seed: int) -> DataFrame:
    """(key, c, n, score) of pairs(v, w, c, n) of the contexts v below the shared one, whose probabilities of words are base(w, known, p).

    c is the word's training count, n the pair's of all, score log10 of its predictive probability.
    """
    once, twice = (x or 0 for x in pairs.agg(F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)).first())
    discount = min(0.95, max(0.05, once / max(1, once + 2 * twice)))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches):
            v, w = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            c, p = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            u = np.cumsum(np.append(0, v[1:] != v[:-1]))
            keys = w ^ mix64(v)
            customers = STRENGTH + np.bincount(u, c)
            tables, weight, mass, back = np.minimum(c, 1).astype(float), np.zeros(len(c)), np.zeros(len(c)), np.zeros(len(customers))
            some = np.flatnonzero(c > 1)  # others have one way to sit
            for k in range(1, sweeps + 1):
                seats = np.bincount(u, tables)[u[some]]
                tables[some], weight[some] = resit(c[some], tables[some], weight[some], seats, p[some], discount, keys[some], seed + k, k == 1)
                if k > 1:
                    mass += c - discount * tables
                    back += STRENGTH + discount * np.bincount(u, tables)
            score = np.log10(np.maximum((mass + back[u] * p) / customers[u] / (sweeps - 1), 1e-300))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(4), batch.column(3), pa.array(score)], ["key", "c", "n", "score"])

    rows = pairs.join(base, "w").select("v", "w", "c", "n", "known", "p").repartition("v").sortWithinPartitions("v", "w")
    return rows.mapInArrow(relieved(of), "key bigint, c bigint, n bigint, score double")


def scored(docs: DataFrame, sweeps: int = SWEEPS, seed: int = 7, contexts: int = CONTEXTS, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs(doc_id, text).

    Tokens are the words between ASCII white space, A-Z lower-cased, then one end; a null text has the end
    alone. Rows whose crc32(doc_id as text) modulo 5 is not 1 are learnt from. score is the log10 probability of
    the tokens; 10 ** (-score / n_tokens) is the perplexity. Repeated rows and null doc_ids are rows like any;
    other columns are ignored; texts of any length are read whole; without training rows all tokens are the unknown one.
    sweeps is two or more. `hot` moves look-ups between the worker and a join and changes no score.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text", held_out(5).alias("held_out"))
    learn = docs.select("text", (~F.col("held_out")).alias("train"))
    vocab = stored(counted(learn, np.zeros(0, np.uint64)).groupBy("w").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "vocabulary")
    n_train, n_words, n_all = (x or 0 for x in vocab.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum("n")).first())
    before = frequent(vocab, contexts)
    released(vocab)
    pairs = stored(counted(learn, before, True).groupBy("w", "u", "v").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "pairs")
    own, apart = pairs.where(F.col("u") < len(before)), pairs.where(F.col("u") == len(before))
    shared = apart.groupBy("w", "u").agg(F.count_if(F.col("c") > 0).alias("c"), F.sum("n").alias("n"), F.sum("c").alias("known"))
    words = stored(gathered_by_word(own.select("w", "u", "c", "n", F.col("c").alias("known")).union(shared)), "dishes")
    state, model = sampled(words, before, sweeps, seed)
    scores = learnt(state, model)
    base = scores.where(F.col("u") == len(before)).select("w", F.col("c").alias("known"), F.pow(F.lit(10.0), "score").alias("p"))
    rest = stored(below(apart, base, sweeps, seed), "below")
    released(pairs)
    scores = scores.where(F.col("u") < len(before)).select("key", "c", "n", "score").union(rest)
    smooth = n_train + 0.5 * (n_words + 1)
    often = scores.where(F.col("n") * hot > n_all).select("key", "c", "score").orderBy("key").toPandas()  # under `hot` rows
    looked = spark.sparkContext.broadcast((often["key"].to_numpy(np.int64), np.append(often["c"].to_numpy(np.int64), 0), np.append(often["score"].to_numpy(float), 0.0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, c, score = looked.value
        base = np.log10((c + 0.5) / smooth)
        known, base[-1] = c > 0, 0.0
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, w, at in tokens(batch.column(1)):
                own = (w ^ mix64(preceding(w))).view(np.int64)
                found = np.searchsorted(keys, own)
                found[found < len(keys)] = np.where(keys[found[found < len(keys)]] == own[found < len(keys)], found[found < len(keys)], len(keys))
                missing = found == len(keys)
                ends = np.append(0, np.cumsum(missing))[at].astype(np.int32)
                n = len(at) - 1
                sums = [np.add.reduceat(x[found], at[:-1]) for x in (known.astype(np.int64), base, score)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), *(batch.column(i).slice(first, n) for i in (0, 2)), pa.array(np.diff(at)), *map(pa.array, sums), pa.ListArray.from_arrays(pa.array(ends), pa.array(own[missing]))], names)
                row += n

    names = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rest"]
    kinds = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double, rest array<bigint>"
    seen = stored(docs.select("doc_id", "text", "held_out").mapInArrow(relieved(read), kinds), "seen")
    base = F.log10((F.col("c") + 0.5) / F.lit(float(smooth)))
    rare = scores.where(F.col("n") * hot <= n_all).select("key", "c", F.col("score").alias("s"))
    rare = seen.select("row", F.explode("rest").alias("key")).join(rare, "key")
    rare = rare.groupBy("row").agg(F.count_if(F.col("c") > 0).alias("k"), F.sum(base).alias("b"), F.sum("s").alias("s"))
    out = seen.drop("rest").join(rare, "row", "left")
    both = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return out.select("doc_id", "held_out", "n_tokens", both("known", "k").alias("n_known"), F.lit(n_train).cast("bigint").alias("train_tokens"), both("base", "b").alias("base_score"), both("score", "s").alias("score"))


def op7_lm_score(spark, sf_dir):
    """Base and model scores of every document."""
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"))
