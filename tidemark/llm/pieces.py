"""SentencePiece encoding and decoding, with a max-plus parallel scan over giant documents.

A document of over CHUNK characters is cut into chunks at fixed places, in the middle of words if it so
happens. A boundary state is the piece that lies over a cut or ends there. A chunk yields the matrix of the
best scores from each state at its left cut to each state at its right cut (max-plus: scores add along a
path, the best path wins). Matrices are combined associatively, FAN at a time; that fixes the state at
every cut, and each chunk is then traced back by itself.

In a BPE model the paths are restricted to those that merging gives: a sequence of pieces is the encoding of
its text if and only if each neighbouring pair is the encoding of that pair's text, so exactly one path
from the first cut to the last remains. In a unigram model every neighbour is allowed.

A word's end is a place that no piece lies over. Between such places a chunk has one state, so its
inner words are encoded by the library and only the words at the cuts need the lattice.

Models must normalise as the public ones do: identity, a blank put before the text, blanks kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import relieved, small_batches, stored

#: Characters in a chunk, matrices combined at a time, words kept by a worker, characters encoded at a time.
CHUNK, FAN, KEPT, BLOCK = 1 << 15, 64, 150_000, 1 << 20
BLANK = "▁"
NONE = float("-inf")
#: The state before a text's first piece.
START = (0, "")


class Model:
    """A model file's pieces, and the ids of words it has met."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        names = [self.sp.id_to_piece(i) for i in range(n)]
        ordinary = [i for i in range(n) if not (self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i))]
        self.score = {names[i]: self.sp.get_score(i) for i in ordinary}
        self.id = {names[i]: i for i in ordinary}
        self.byte = {int(names[i][3:5], 16): i for i in range(n) if self.sp.is_byte(i)}
        self.longest = max(len(p) for p in self.score)
        # no piece lies over a line end, or over a word's end
        self.lines = not any("\n" in p for p in self.score)
        self.words = not any(BLANK in p.lstrip(BLANK) for p in self.score)
        surface = [b"" if self.sp.is_control(i) else " ⁇ ".encode() if self.sp.is_unknown(i) else bytes([int(names[i][3:5], 16)]) if self.sp.is_byte(i) else names[i].replace(BLANK, " ").encode() for i in range(n)]
        self.size = np.array([len(x) for x in surface], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.kept: dict[str, bytes] = {}
        self._pairs: dict[tuple[str, str], bool] = {}
        self._own: dict[str, bool] = {}

    # -- whole texts and words ------------------------------------------------------------------

    def _new(self, words: list[str]) -> None:
        """Words stand after a blank, or after a line end if they begin with one."""
        for w, ids in zip(words, self.sp.encode([w or "\n" for w in words], num_threads=1)):
            # the library puts a blank before: an empty word is that blank, a line end has none
            ids = ids[:1] if not w else ids[1:] if w[0] == "\n" else ids
            self.kept[w] = np.array(ids, np.uint32).tobytes()

    def _simple(self, text: str) -> bool:
        return bool(text) and self.lines and self.words and text[0] != " " and "  " not in text and BLANK not in text

    def forget(self) -> None:
        """Let go of the words met, as when a task ends."""
        self.kept, self._pairs, self._own = {}, {}, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The library's ids of each text as little-endian u32."""
        if len(self.kept) > KEPT:
            self.kept = {}
        split = [t.replace("\n", " \n").split(" ") if self._simple(t) else None for t in texts]
        new = set()
        for words in split:
            new.update(words or ())
        self._new(list(new.difference(self.kept)))
        rest = iter(self.sp.encode([t for t, words in zip(texts, split) if words is None], num_threads=1))
        kept = self.kept.__getitem__
        return [np.array(next(rest), np.uint32).tobytes() if words is None else b"".join(map(kept, words)) for words in split]

    def decode(self, flat: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of runs of ids; the blank before a text goes, broken UTF-8 is replaced as in the library."""
        size = self.size[flat]
        ends = np.cumsum(size)
        data = self.surface[np.repeat(self.begin[flat] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        ends = np.append(0, ends)[offsets]
        out = []
        for r in range(len(offsets) - 1):
            own = data[ends[r] : ends[r + 1]]
            try:
                text = own.decode()
                out.append(text[1:] if text[:1] == " " and not self.sp.is_byte(int(flat[offsets[r]])) else text)
            except UnicodeDecodeError:
                out.append(self.sp.decode(flat[offsets[r] : offsets[r + 1]].tolist()))
        return out

    # -- the lattice ----------------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """A short text's pieces by merging the neighbours of best score, the leftmost first."""
        parts = list(text)
        while True:
            best, at = NONE, -1
            for i in range(len(parts) - 1):
                if self.score.get(parts[i] + parts[i + 1], NONE) > best:
                    best, at = self.score[parts[i] + parts[i + 1]], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether pieces may follow each other."""
        if not left or self.unigram:
            return True
        if (found := self._pairs.get((left, right))) is None:
            found = self._pairs[left, right] = self.merged(left + right) == [left, right]
            if len(self._pairs) > KEPT:
                self._pairs = {}
        return found

    unigram = False

    def pieces_at(self, s: str, at: int) -> list[str]:
        """Pieces that begin at a place; a character that no piece has stands for itself."""
        found = [s[at : at + n] for n in range(1, self.longest + 1) if at + n <= len(s) and s[at : at + n] in self.score]
        if not found or len(found[0]) > 1:
            found.insert(0, s[at])
        if self.unigram:
            return found
        out = []
        for p in found:
            if (own := self._own.get(p)) is None:
                own = self._own[p] = len(p) == 1 or self.merged(p) == [p]
            if own:
                out.append(p)
        return out

    def gain(self, piece: str) -> float:
        return self.score.get(piece, -1e6)

    def ids_of(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            if p in self.id:
                out.append(self.id[p])
            else:
                out += [self.byte[b] for b in p.encode()] if self.byte else [self.sp.unk_id()]
        return out

    def is_cut(self, s: str, at: int) -> bool:
        """Whether no piece lies over this place and any two may meet here."""
        return (self.words and s[at] == BLANK and s[at - 1] != BLANK) or (self.lines and (s[at] == "\n" or s[at - 1] == "\n"))


_models: dict[str, Model] = {}


def model_of(path: str) -> Model:
    """One model for all tasks that a Python worker runs."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


class Chunk:
    """A chunk of a normalised text with the characters around that pieces over its cuts need."""

    def __init__(self, model: Model, left: str, body: str, right: str, first: bool, last: bool):
        self.model, self.s = model, left + body + right
        self.a, self.b, self.first, self.last = len(left), len(left) + len(body), first, last
        at = [i for i in (self._next_cut(), self._last_cut()) if i is not None]
        self.cut = (at[0], at[1]) if len(at) == 2 else None

    def _next_cut(self):
        return next((i for i in range(self.a + 1, self.b) if self.model.is_cut(self.s, i)), None)

    def _last_cut(self):
        return next((i for i in range(self.b - 1, self.a, -1) if self.model.is_cut(self.s, i)), None)

    def over(self, cut: int, open_end: bool) -> list[tuple[int, str]]:
        """States at a cut: (begin relative to the cut, piece), the piece ending at the cut or beyond."""
        found = [(i - cut, p) for i in range(max(0, cut - self.model.longest), cut) for p in self.model.pieces_at(self.s, i) if i + len(p) >= cut]
        return found if open_end else [(i, p) for i, p in found if i + len(p) == 0]

    def entries(self):
        return [START] if self.first else self.over(self.a, True)

    def run(self, states: list[tuple[int, str]], at: int, to: int, stop: bool):
        """Forward from states at `at`. Returns {(begin, piece): (score, entry, previous)} by entry for what reaches `to`.

        stop: paths end exactly at `to`; else with the first piece that reaches it.
        """
        live: dict[int, dict] = {}
        for e in states:
            end = at + e[0] + len(e[1])
            if end > to and stop:
                continue
            live.setdefault(end, {}).setdefault((at + e[0], e[1]), {})[e] = (0.0, None)
        done, back = {}, {}
        for p in range(at, to):
            here = live.pop(p, None)
            if not here:
                continue
            for piece in self.model.pieces_at(self.s, p):
                gain, end = self.model.gain(piece), p + len(piece)
                if stop and end > to:
                    continue
                best = {}
                for (i, q), reached in here.items():
                    if self.model.fits(q, piece):
                        for e, (score, _) in reached.items():
                            if score + gain > best.get(e, (NONE,))[0]:
                                best[e] = (score + gain, (i, q))
                if best:
                    back[p, piece] = best
                    (done if end >= to else live.setdefault(end, {}))[p, piece] = best
        for q, reached in live.pop(to, {}).items():
            done.setdefault(q, reached)
        return done, back

    @staticmethod
    def path(back: dict, e: tuple, end: tuple) -> list[str]:
        out = []
        while end in back and e in back[end]:
            out.append(end[1])
            end = back[end][e][1]
        return out[::-1]

    def middle(self) -> list[int]:
        """Ids between the first and the last word's end, by the library."""
        text = self.s[self.cut[0] : self.cut[1]]
        if not text:
            return []
        if text[0] == BLANK:
            return self.model.sp.encode(text[1:].replace(BLANK, " ")) if len(text) > 1 else [self.model.id[BLANK]]
        # a line end before hides the blank that the library puts there
        return self.model.sp.encode("\n" + text.replace(BLANK, " "))[1 + len(self.model.ids_of(["\n"])) :]

    def _parts(self):
        """Head to the first word's end and tail from the last; the head alone if there is none between."""
        if self.cut is None:
            return self.run(self.entries(), self.a, self.b, self.last), None
        head = self.run(self.entries(), self.a, self.cut[0], True)
        tail = self.run([START], self.cut[1], self.b, self.last)
        return head, tail

    def matrix(self) -> dict[tuple, dict[tuple, float]]:
        """{entry: {exit: score}}; exits are relative to the right cut, as the next chunk's entries."""
        head, tail = self._parts()
        out: dict[tuple, dict[tuple, float]] = {}
        if tail is None:
            for (i, p), reached in head[0].items():
                for e, (score, _) in reached.items():
                    out.setdefault(e, {})[i - self.b, p] = score
            return out
        inner = sum(self.model.sp.get_score(i) for i in self.middle())
        for reached in head[0].values():
            for e, (score, _) in reached.items():
                for (i, p), after in tail[0].items():
                    out.setdefault(e, {})[i - self.b, p] = score + inner + after[START][0]
        return out

    def trace(self, entry: tuple, leave: tuple) -> list[int]:
        """The ids that begin in this chunk, given the states at both its cuts."""
        head, tail = self._parts()
        end = (leave[0] + self.b, leave[1])
        if tail is None:
            return self.model.ids_of(self.path(head[1], entry, end))
        (best,) = [q for q, reached in head[0].items() if entry in reached] or [None]
        return self.model.ids_of(self.path(head[1], entry, best)) + self.middle() + self.model.ids_of(self.path(tail[1], START, end))


def combine(left: dict, right: dict) -> dict:
    """The max-plus product of two matrices."""
    out: dict[tuple, dict[tuple, float]] = {}
    for e, row in left.items():
        own = out.setdefault(e, {})
        for mid, score in row.items():
            for leave, more in right.get(mid, {}).items():
                if score + more > own.get(leave, NONE):
                    own[leave] = score + more
    return out


def between(matrices: list[dict], entry: tuple, leave: tuple) -> list[tuple]:
    """The states at all cuts of a run of matrices on the best way from `entry` to `leave`."""
    now, back = {entry: 0.0}, []
    for m in matrices:
        best, came = {}, {}
        for mid, score in now.items():
            for x, more in m.get(mid, {}).items():
                if score + more > best.get(x, NONE):
                    best[x], came[x] = score + more, mid
        now = best
        back.append(came)
    states = [leave]
    for came in reversed(back):
        states.append(came[states[-1]])
    return states[::-1]


def _rows(matrix: dict) -> list:
    return [(e[0], e[1], x[0], x[1], score) for e, row in matrix.items() for x, score in row.items()]


def _matrix(rows) -> dict:
    out: dict[tuple, dict[tuple, float]] = {}
    for r in rows:
        out.setdefault((r["i"], r["p"]), {})[r["j"], r["q"]] = r["s"]
    return out


_MATRIX = "array<struct<i:int,p:string,j:int,q:string,s:double>>"


def _giant_ids(giants: DataFrame, path: str) -> DataFrame:
    """(key, ids) of giants(key, text), each key once."""
    overlap = 64

    @relieved
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                s = BLANK + batch.column(1)[r].as_py().replace(" ", BLANK)
                n = -(-len(s) // CHUNK)
                for k in range(n):
                    i = k * CHUNK
                    row = [[batch.column(0)[r].as_py()], [k], [n], [s[max(0, i - overlap) : i]], [s[i : i + CHUNK]], [s[i + CHUNK : i + CHUNK + overlap]]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (text, number, number, text, text, text))], ["key", "k", "n", "before", "body", "after"])

    text, number = pa.string(), pa.int32()
    chunks = stored(giants.select("key", "text").mapInArrow(cut, "key string, k int, n int, before string, body string, after string"), "chunks")

    def chunk(model, r) -> Chunk:
        return Chunk(model, r["before"], r["body"], r["after"], r["k"] == 0, r["k"] == r["n"] - 1)

    @relieved
    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for r in batch.to_pylist():
                rows = [dict(zip("ipjqs", x)) for x in _rows(chunk(model, r).matrix())]
                yield pa.RecordBatch.from_pylist([{"key": r["key"], "k": r["k"], "m": rows}], schema=kind)

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        ms = [_matrix(m) for m in pdf.sort_values("k")["m"]]
        while len(ms) > 1:
            ms = [combine(*ms[i : i + 2]) if i + 1 < len(ms) else ms[i] for i in range(0, len(ms), 2)]
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "k": (pdf["k"].iloc[:1] // FAN).astype("int32"), "m": [[dict(zip("ipjqs", x)) for x in _rows(ms[0])]]})

    def settle(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        own, up = own.sort_values("k"), above.iloc[0]
        states = between([_matrix(m) for m in own["m"]], (up["i"], up["p"]), (up["j"], up["q"]))
        return pd.DataFrame([(key, k, *e, *x) for key, k, e, x in zip(own["key"], own["k"], states, states[1:])], columns=["key", "k", "i", "p", "j", "q"])

    @relieved
    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for r in batch.to_pylist():
                ids = chunk(model, r).trace((r["i"], r["p"]), (r["j"], r["q"]))
                yield pa.RecordBatch.from_pylist([{"key": r["key"], "k": r["k"], "ids": ids}], schema=part)

    kind = pa.schema([("key", text), ("k", number), ("m", pa.list_(pa.struct([("i", number), ("p", text), ("j", number), ("q", text), ("s", pa.float64())])))])
    part = pa.schema([("key", text), ("k", number), ("ids", pa.list_(number))])
    levels = [stored(chunks.mapInArrow(matrices, f"key string, k int, m {_MATRIX}"), "matrices")]
    most = chunks.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(stored(levels[-1].groupBy("key", F.expr(f"k div {FAN}").alias("group")).applyInPandas(product, f"key string, k int, m {_MATRIX}"), "matrices"))
        most = -(-most // FAN)
    best = levels[-1].select("key", "k", F.array_max(F.transform("m", lambda m: F.struct(m["s"].alias("s"), m["i"].alias("i"), m["p"].alias("p"), m["j"].alias("j"), m["q"].alias("q")))).alias("x"))
    states = best.select("key", "k", "x.i", "x.p", "x.j", "x.q")
    for level in reversed(levels[:-1]):
        below = level.withColumn("group", F.expr(f"cast(k div {FAN} as int)"))
        states = stored(below.groupBy("key", "group").cogroup(states.withColumnRenamed("k", "group").groupBy("key", "group")).applyInPandas(settle, "key string, k int, i int, p string, j int, q string"), "states")
    ids = chunks.join(states, ["key", "k"]).select("key", "k", "n", "before", "body", "after", "i", "p", "j", "q").mapInArrow(traced, "key string, k int, ids array<int>")
    return ids.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))


def _with(docs: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*docs.schema, T.StructField(name, kind)])


def _key(text: Column) -> Column:
    return F.sha2(text, 256)


def _is_long() -> Column:
    return F.length(F.coalesce("text", F.lit(""))) >= CHUNK


def _encoded_giants(docs: DataFrame, path: str) -> DataFrame:
    """The rows of docs with giant texts, with `ids`; a text that several rows have is encoded once."""
    giants = docs.where(_is_long()).select(F.struct(*docs.columns).alias("row"), _key(F.col("text")).alias("key"))
    ids = _giant_ids(giants.select("key", F.col("row.text").alias("text")).dropDuplicates(["key"]), path)
    return giants.join(ids, "key").select("row.*", "ids")


def _blocks(model: Model, texts: pa.Array) -> Iterator[tuple[int, list[str], np.ndarray, np.ndarray]]:
    """(first row, texts, ids, offsets of the rows in the ids) of blocks of a text column."""
    first = 0
    while first < len(texts):
        own, chars = [], 0
        while first + len(own) < len(texts) and chars < BLOCK:
            own.append(texts[first + len(own)].as_py() or "")
            chars += len(own[-1])
        found = model.encode(own)
        yield first, own, np.frombuffer(b"".join(found), np.int32), np.append(0, np.cumsum([len(x) // 4 for x in found]))
        first += len(own)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """docs with `ids`, the model's ids of `text`, after its columns (a column of that name is replaced).

    Null and empty texts have no ids. Rows are kept as they are, repeated ones too; texts are taken whole. A giant
    text that several rows have is encoded once.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("ids")
    names, at = docs.columns, docs.columns.index("text")

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for first, own, flat, offsets in _blocks(model, batch.column(at)):
                ids = pa.ListArray.from_arrays(offsets.astype(np.int32), flat)
                yield pa.RecordBatch.from_arrays([*batch.slice(first, len(own)).columns, ids], [*names, "ids"])
        model.forget()

    return docs.where(~_is_long()).mapInArrow(of, _with(docs, "ids", T.ArrayType(T.IntegerType()))).unionByName(_encoded_giants(docs, path))


def _id_blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, offsets of the rows in the ids) of blocks of a column of ids."""
    first, sizes = 0, np.array(column.value_lengths().fill_null(0))
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(np.cumsum(sizes[first:]), BLOCK, "right")) + first)
        yield first, column.slice(first, last - first).flatten().to_numpy(), np.append(0, np.cumsum(sizes[first:last]))
        first = last


def decode(docs: DataFrame, path: str) -> DataFrame:
    """docs with `decoded`, the text of `ids`, after its columns; null ids give the empty text."""
    docs = docs.drop("decoded")
    names, at = docs.columns, docs.columns.index("ids")

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for first, flat, offsets in _id_blocks(batch.column(at)):
                texts = pa.array(model.decode(flat, offsets), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(first, len(texts)).columns, texts], [*names, "decoded"])

    return docs.mapInArrow(of, _with(docs, "decoded", T.StringType()))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded text, n_pieces, ids_crc32 (of the ids as little-endian u32) and same: decoded is the text.

    A task encodes and decodes in one job; giant texts are decoded from the ids that their chunks gave.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    names = ["doc_id", "text", "n_pieces", "ids_crc32", "same"]

    def told(model: Model, doc_ids: pa.Array, texts: list[str], flat: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        decoded = model.decode(flat, offsets)
        crcs = [zlib.crc32(flat[x:y].astype("<u4").tobytes()) for x, y in zip(offsets, offsets[1:])]
        same = [a == b for a, b in zip(decoded, texts)]
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(decoded, pa.string()), pa.array(np.diff(offsets), pa.int64()), pa.array(crcs, pa.int64()), pa.array(same, pa.bool_())], names)

    @relieved
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for first, own, flat, offsets in _blocks(model, batch.column(1)):
                yield told(model, batch.column(0).slice(first, len(own)), own, flat, offsets)
        model.forget()

    @relieved
    def given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            for first, flat, offsets in _id_blocks(batch.column(2)):
                n = len(offsets) - 1
                yield told(model, batch.column(0).slice(first, n), batch.column(1).slice(first, n).to_pylist(), flat, offsets)

    kind = "doc_id bigint, text string, n_pieces bigint, ids_crc32 bigint, same boolean"
    giants = _encoded_giants(docs, path).select("doc_id", "text", "ids").mapInArrow(given, kind)
    return docs.where(~_is_long()).mapInArrow(whole, kind).union(giants)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_sentencepiece(spark, sf_dir):
    """Every document encoded, and the text that its ids decode to compared with it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return round_trip(docs, model_path()).select("doc_id", "n_pieces", "ids_crc32", "same", F.length("text").cast("bigint").alias("n_chars"))
