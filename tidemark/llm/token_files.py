"""Token files of directly addressable codes.

A file set is a Parquet folder of segments in ascending document order. A segment holds whole documents;
its ids are split into 8-bit chunks by level. Level 0 has the lowest chunk of every id and a bitmap that
says which ids go on; level 1 has the next chunk of those, and so on. A directory of bit counts before
every 512th bit gives an id's place on the next level, so any token is read without decoding its neighbours.

Payload, little-endian: b"DAC1", levels u32, count u64; per level: count u64, chunks u8[count],
bitmap u8[ceil(count / 8)] (low bit first), directory u32[ceil(count / 512)].
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import relieved, shared_dir, small_batches

#: Tokens in a segment, unless one document has more.
SEGMENT = 1 << 19
#: Words whose ids a worker keeps, and characters that it encodes at a time.
KEPT, BLOCK = 500_000, 1 << 22


def pack(ids: np.ndarray) -> bytes:
    ids = np.ascontiguousarray(ids, np.uint32)
    levels, out, rest = 0, [], ids
    while levels == 0 or len(rest):
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        counts = np.bitwise_count(np.pad(bits, (0, -len(bits) % 64))).reshape(-1, 64).sum(axis=1).astype(np.int64)
        directory = np.concatenate(([0], np.cumsum(counts)))[: (len(rest) + 511) // 512].astype(np.uint32)
        out += [struct.pack("<Q", len(rest)), (rest & 0xFF).astype(np.uint8).tobytes(), bits.tobytes(), directory.tobytes()]
        rest = rest[more] >> 8
        levels += 1
    return b"DAC1" + struct.pack("<IQ", levels, len(ids)) + b"".join(out)


class Packed:
    """A segment's payload; `get` reads single tokens, `all` every token."""

    def __init__(self, payload: bytes):
        if payload[:4] != b"DAC1":
            raise ValueError("not a DAC1 payload")
        n_levels, self.count = struct.unpack_from("<IQ", payload, 4)
        self.levels, at = [], 16
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", payload, at)
            at += 8
            chunks = np.frombuffer(payload, np.uint8, n, at)
            bits = np.frombuffer(payload, np.uint8, (n + 7) // 8, at + n)
            directory = np.frombuffer(payload, np.uint32, (n + 511) // 512, at + n + len(bits))
            self.levels.append((chunks, bits, directory))
            at += n + len(bits) + 4 * len(directory)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The tokens at any places, each found by rank alone."""
        at = np.asarray(at, np.int64)
        out, live = np.zeros(len(at), np.uint32), np.arange(len(at))
        for depth, (chunks, bits, directory) in enumerate(self.levels):
            out[live] |= chunks[at].astype(np.uint32) << np.uint32(8 * depth)
            go = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            live, at = live[go], at[go]
            if not len(at):
                break
            block = np.pad(bits, (0, 64))[((at >> 9) << 6)[:, None] + np.arange(64)]
            within = np.arange(64) < ((at & 511) >> 3)[:, None]
            last = bits[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8)
            at = directory[at >> 9].astype(np.int64) + np.bitwise_count(block * within).sum(axis=1).astype(np.int64) + np.bitwise_count(last)
        return out

    def all(self) -> np.ndarray:
        out = None
        for chunks, bits, _ in reversed(self.levels):
            own = chunks.astype(np.uint32)
            if out is not None:
                own[np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)] |= out << np.uint32(8)
            out = own
        return out


class WordEncoder:
    """Encodes texts with a `tokenizers` file, remembering the ids of words between blanks.

    The files' pre-tokenisers split at white space, so a text's ids are its words' ids in a row.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kept: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.points = {p: self._ids([p])[0] for p in ".,"}

    def _ids(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, np.uint32).tobytes() for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of letters alone, many in one text: each is one run, so its ids go up to the next that ends a word."""
        out = []
        for i in range(0, len(words), 4096):
            own = words[i : i + 4096]
            ids = np.array(self.tokenizer.encode(" ".join(own), add_special_tokens=False).ids, np.uint32)
            cuts = np.flatnonzero(self.ends[np.minimum(ids, len(self.ends) - 1)]) + 1
            if len(cuts) == len(own):
                data, at = ids.tobytes(), (cuts * 4).tolist()
                out += [data[x:y] for x, y in zip([0, *at], at)]
            else:
                out += self._ids(own)
        return out

    @staticmethod
    def plain(text: str) -> str:
        """The text with blanks for line ends; in lower case where that is a matter of single characters, as in the normaliser."""
        # in Latin-1 it is; markers keep their case
        if "<|" not in text:
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ")

    def _learn(self, words: list[str]) -> None:
        """Put the ids of words that aren't kept among the kept ones."""
        kept = self.kept
        # a letter's run ends before a full stop or comma, so these ids can be joined; not if lower case puts a mark after the letter
        ends = [w for w in words if w[-1] in ".," and w[:-1].isalpha() and w[-2] < "ɐ" and w[:-1].lower().isalpha()]
        stems = {w[:-1] for w in ends}
        whole = (set(words).difference(ends) | stems).difference(kept)
        plain = [w for w in whole if w.isalpha() and max(w) < "ɐ" and w.lower().isalpha()]
        kept.update(zip(plain, self._letters(plain)))
        odd = list(whole.difference(plain))
        kept.update(zip(odd, self._ids(odd)))
        for w in ends:
            kept[w] = kept[w[:-1]] + self.points[w[-1]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the end of each text's in them.

        Each distinct word is looked up once; its ids are then gathered for all its occurrences.
        """
        if len(self.kept) > KEPT:  # words that the last KEPT don't have are forgotten
            self.kept, self.older = {"": b""}, self.kept
        split = pc.split_pattern(pa.array(map(self.plain, texts), pa.large_string()), " ")
        coded = split.flatten().dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        parts = list(map(self.kept.get, words))
        missing = [i for i, x in enumerate(parts) if x is None]
        if missing:
            found = [self.older.get(words[i]) for i in missing]
            self.kept.update((words[i], x) for i, x in zip(missing, found) if x is not None)
            self._learn([words[i] for i, x in zip(missing, found) if x is None])
            for i in missing:
                parts[i] = self.kept[words[i]]
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        data, begin = np.frombuffer(b"".join(parts), np.uint32), np.cumsum(size) - size
        each = size[codes]
        upto = np.append(0, np.cumsum(each))
        ids = data[np.repeat(begin[codes] - upto[:-1], each) + np.arange(upto[-1])]
        return ids, upto[split.offsets.to_numpy()[1:]]


_encoders: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """One encoder for all tasks that a Python worker runs."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, tokenizer: str, end: int, path: str) -> None:
    """Encode docs(doc_id, text), append `end` to each, and write segments in ascending doc_id order to `path`.

    Rows of one doc_id follow each other in the order of their texts; a null doc_id comes first; a null text
    has only the end. A text of any length is encoded whole, in a segment of its own beyond SEGMENT ids. Other columns are not written; an empty table
    gives a folder without segments.
    """

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(tokenizer), TaskContext.get().partitionId()
        close = np.array([end], np.uint32).tobytes()
        ids, parts, size, before = [], [], 0, 0

        def segment():
            nonlocal ids, parts, size, before
            lengths = [len(p) // 4 for p in parts]
            row = [[part], [before], [size], [ids], [lengths], [pack(np.frombuffer(b"".join(parts), np.uint32))]]
            before += size
            ids, parts, size = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()))], ["part", "before", "n_tokens", "doc_ids", "lengths", "payload"])

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            first = 0
            while first < len(doc_ids):
                own, chars = [], 0
                while first + len(own) < len(doc_ids) and chars < BLOCK:
                    own.append(texts[first + len(own)].as_py() or "")
                    chars += len(own[-1])
                flat, ends = encoder.encode(own)
                for doc_id, x, y in zip(doc_ids[first:], [0, *ends], ends):
                    n = int(y - x) + 1
                    if size and size + n > SEGMENT:
                        yield segment()
                    ids.append(doc_id)
                    parts.append(flat[x:y].tobytes() + close)
                    size += n
                first += len(own)
        if ids:
            yield segment()

    small_batches(docs.sparkSession)
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(of, "part int, before bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary").write.parquet(path)


def segments(spark, path: str) -> DataFrame:
    """The segments at `path` with `start`, the number of ids in all segments before."""
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each written partition
    upto = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return rows.join(upto, "part").withColumn("start", F.col("base") + F.col("before")).drop("base")


def read_documents(spark, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, read back from the files."""

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, doc_ids, lengths, payload = (batch.column(c)[row] for c in range(4))
                ids = Packed(payload.as_buffer()).all()
                lengths = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(lengths)
                columns = [pa.array(doc_ids.as_py(), pa.int64()), pa.array(start.as_py() + ends - lengths), pa.array(lengths), pa.array([zlib.crc32(ids[e - n : e].astype("<u4").tobytes()) for e, n in zip(ends, lengths)], pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return segments(spark, path).select("start", "doc_ids", "lengths", "payload").mapInArrow(of, schema)


def tokens_at(spark, path: str, positions: DataFrame, stride: int = 1 << 20) -> DataFrame:
    """(position, token) for positions(position) in the whole token stream; places outside give no row.

    Segments and positions meet by stretches of `stride` places; a segment is opened once for all its positions,
    and their tokens are read by rank.
    """
    rows = segments(spark, path).where("n_tokens > 0")
    own = rows.select("part", "before", "start", "n_tokens", F.explode(F.sequence((F.col("start") / stride).cast("bigint"), ((F.col("start") + F.col("n_tokens") - 1) / stride).cast("bigint"))).alias("stretch"))
    asked = positions.select("position", F.floor(F.col("position") / stride).alias("stretch"))
    met = asked.join(own, "stretch").where("position >= start and position < start + n_tokens")
    met = met.groupBy("part", "before").agg(F.sort_array(F.collect_list("position")).alias("positions"))

    @relieved
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                at = batch.column(0)[r].values
                tokens = Packed(batch.column(2)[r].as_buffer()).get(at.to_numpy() - batch.column(1)[r].as_py())
                yield pa.RecordBatch.from_arrays([at, pa.array(tokens.astype(np.int64))], ["position", "token"])

    return rows.join(met, ["part", "before"]).select("positions", "start", "payload").mapInArrow(of, "position bigint, token bigint")


def op3_token_files(spark, sf_dir):
    """All documents as token files; what is returned is read back from them."""
    import public_tokenizers

    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), 2, path)
    return read_documents(spark, path)
