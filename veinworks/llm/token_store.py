"""Token ids on disk: independent zstandard frames, a trailing seek table, checksums.

A shard holds the ids of its documents one after another, as little-endian
32-bit integers, in frames of bounded size that decompress on their own. The
seek table at its end gives compressed size, size and checksum of each frame,
in the public seekable format of zstandard, so a reader fetches and decompresses
only the frames that hold the documents asked for.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from veinworks.llm.base import fresh_folder, map_arrow, query, table
from veinworks.llm.bpe import byte_letters, default_tokenizer
from veinworks.llm.files import filesystem, read_at, task_name

# Magic numbers and flags of the seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS, FOOTER = 0x184D2A5E, 0x8F92EAB1, 0x80, 9
FRAME_BYTES = 1 << 18
LOT_CHARS = 24 << 20  # code points of the texts that are taken apart together
PIECES_AT_ONCE = 1 << 19  # pieces of the texts that are put together at once
KNOWN_PIECES = 600_000  # encoded pieces that a worker process remembers
# The split rule of byte-level tokenizers and its white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACES = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class FrameWriter:
    """Writes bytes as independent frames to a binary stream."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, level: int = 1):
        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.pending = b""
        self.entries: list[tuple[int, int, int]] = []

    def write(self, data: bytes) -> None:
        view = memoryview(self.pending + data) if self.pending else memoryview(data)
        whole = len(view) // self.frame_bytes * self.frame_bytes
        for at in range(0, whole, self.frame_bytes):
            self._frame(view[at : at + self.frame_bytes])
        self.pending = bytes(view[whole:])

    def _frame(self, data: bytes | memoryview) -> None:
        packed = self.compressor.compress(data)
        self.stream.write(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.pending:
            self._frame(self.pending)
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        footer = struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table) + FOOTER) + table + footer)
        self.stream.close()


class FrameReader:
    """Random access to the bytes of a shard; decompresses the frames asked for."""

    def __init__(self, file: pa.NativeFile):
        self.file, size = file, file.size()
        frames, flags, magic = struct.unpack("<IBI", read_at(file, size - FOOTER, FOOTER))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise OSError("no seek table with checksums")
        raw = read_at(file, size - FOOTER - 12 * frames, 12 * frames)
        table = np.frombuffer(raw, "<u4").reshape(-1, 3).astype(np.int64)
        self.sums = table[:, 2]
        self.packed_at = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.at = np.concatenate([[0], np.cumsum(table[:, 1])])
        self.decompressor = zstandard.ZstdDecompressor()
        self.last: tuple[int, bytes] = (-1, b"")
        self.decompressed = 0

    def _frame(self, k: int) -> bytes:
        if self.last[0] != k:
            packed = read_at(self.file, int(self.packed_at[k]), int(self.packed_at[k + 1] - self.packed_at[k]))
            data = self.decompressor.decompress(packed, max_output_size=int(self.at[k + 1] - self.at[k]))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
                raise OSError(f"checksum of frame {k} does not match")
            self.last, self.decompressed = (k, data), self.decompressed + 1
        return self.last[1]

    def read(self, offset: int, length: int) -> bytes:
        parts, end = [], offset + length
        k = int(np.searchsorted(self.at, offset, side="right")) - 1
        while offset < end:
            data, start = self._frame(k), int(self.at[k])
            parts.append(data[offset - start : end - start])
            offset, k = start + len(data), k + 1
        return b"".join(parts)


class PieceEncoder:
    """Encodes texts with the tokenizers library, each distinct piece of the lots once.

    A piece is what lies between two single spaces, with the space before it:
    the byte-level split rule never cuts elsewhere around such a space. Texts
    in which another white space follows a space, that end with a space or that
    hold an added token go through the library whole.
    """

    def __init__(self, spec: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        special = "|".join(re.escape(t.content) for t in self.library.get_added_tokens_decoder().values())
        self.whole = re.compile(f" [{SPACES}]| \\Z" + (f"|{special}" if special else "")).search
        self.latin = re.compile(r"[\t\n\r\x20-\x7e\xa1-\u024f]*").fullmatch  # classes that no Unicode version changes
        self.words = regex.compile(SPLIT).findall
        self.letters = dict(enumerate(byte_letters()))
        self.space = self.letters[32]
        self.simple = not json.loads(spec).get("normalizer")
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.of_word: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _words(self, text: str) -> list[str]:
        """Words of the split rule; their ids, from the library's model, are in ``of_word``."""
        words, known, tokenize = self.words(text), self.of_word, self.library.model.tokenize
        for w in [w for w in set(words) if w not in known]:
            letters = w.encode().decode("latin-1").translate(self.letters)
            known[w] = array("I", [t.id for t in tokenize(letters)]).tobytes()
        return words

    def _learn(self, fresh: list[str]) -> None:
        """Ids of new pieces: side by side between spaces where the split rule is known for all characters."""
        if not self.simple or not self.latin("".join(fresh)):
            for p in fresh if not self.simple else [p for p in fresh if not self.latin(p)]:
                self.pieces[p] = self._library(" " + p)
            fresh = [p for p in fresh if p not in self.pieces]
        known, pieces, tokenize, space = self.of_word, self.pieces, self.library.model.tokenize, self.space
        rest = []
        for p in fresh:
            if p.isascii() and p.isalpha():  # one word, without a search for its end
                w = " " + p
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = array("I", [t.id for t in tokenize(space + p)]).tobytes()
                pieces[p] = ids
            elif not p or p[0].isspace():  # first in a text: beside others it would run into the space between
                pieces[p] = self._library(" " + p)
            else:
                rest.append(p)
        fresh, out = rest, []
        for w in self._words(" " + " ".join(fresh)) if fresh else []:
            if w[0] == " ":
                out.append(known[w])
            else:
                out[-1] += known[w]
        self.pieces.update(zip(fresh, out, strict=True))

    def _first(self, piece: str) -> bytes:
        if self.simple and self.latin(piece):
            return b"".join([self.of_word[w] for w in self._words(piece)])
        return self._library(piece)

    def encode(self, lot: list[str], end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Some texts at a time: (ids with the end id after each text, number of ids of each text)."""
        whole = [bool(self.whole(text)) for text in lot]
        parts = pc.split_pattern(pa.array(["" if w else t for t, w in zip(lot, whole, strict=True)], pa.string()), pattern=" ")
        bounds = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        del parts
        distinct = coded.dictionary.to_pylist()
        if len(self.pieces) > KNOWN_PIECES // 2:  # pieces not met again since the last turn go
            self.older, self.pieces, self.of_word = self.pieces, {}, {}
        fresh = []
        for p in distinct:
            if p not in self.pieces:
                ids = self.older.get(p)
                if ids is None:
                    fresh.append(p)
                else:
                    self.pieces[p] = ids
        self._learn(fresh)
        order = coded.indices.to_numpy()
        # A text starts with a piece of its own, without a space before it, and ends with the end id.
        firsts = [
            self._library(text) if w else self._first(distinct[k])
            for text, w, k in zip(lot, whole, order[bounds[:-1]].tolist(), strict=True)
        ]
        entries = [*map(self.pieces.__getitem__, distinct), *firsts, struct.pack("<I", end_id)]
        size = np.fromiter(map(len, entries), np.int32, len(entries)) // 4
        pool, start = np.frombuffer(b"".join(entries), "<u4"), np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        n, begin = len(distinct), 0
        del entries, distinct
        while begin < len(lot):
            end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + PIECES_AT_ONCE)) - 1)
            own = bounds[begin : end + 1] - bounds[begin]
            part = order[bounds[begin] : bounds[end]].copy()
            part[own[:-1]] = n + np.arange(begin, end)
            part = np.insert(part, own[1:], len(size) - 1)
            sizes = size[part]
            ends = np.cumsum(sizes)
            ids = pool[np.repeat((start[part] - (ends - sizes)).astype(np.int32), sizes) + np.arange(ends[-1], dtype=np.int32)]
            yield ids, np.diff(ends[own[1:] + np.arange(end - begin)], prepend=0)
            begin = end


def encoder_of(spec: str) -> PieceEncoder:
    """The encoder of this worker process: its next task starts with the pieces of the last.

    Functions travel with their task and bring their own globals, so what is
    kept between tasks lies in a module of the process.
    """
    kept = vars(sys.modules.setdefault("veinworks_worker", types.ModuleType("veinworks_worker")))
    key = xxhash.xxh64_intdigest(spec)
    if kept.get("encoder", (None, None))[0] != key:
        kept["encoder"] = key, PieceEncoder(spec)
    return kept["encoder"][1]


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of about ``LOT_CHARS`` code points, over several batches: the more texts, the more pieces they share."""
    keys, lot, chars = [], [], 0
    for batch in batches:
        own = [t or "" for t in batch.column(1).to_pylist()]
        keys.append(batch.column(0))
        lot += own
        chars += sum(map(len, own))
        if chars >= LOT_CHARS:
            yield pa.concat_arrays(keys), lot
            keys, lot, chars = [], [], 0
    if lot:
        yield pa.concat_arrays(keys), lot


def write_store(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, shards: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Write the ids of all texts in ascending id order; returns the index.

    The index (doc_id, shard, file, start, n_tokens), kept as Parquet beside
    the shards, has one row per row of ``docs``; ``start`` counts ids within
    the shard. ``end_id`` follows every document. Null texts count as empty,
    null ids come first, rows with the same id follow each other in order of a
    hash of their texts, so they may fill several shards. Other columns are
    ignored. ``shards`` defaults to the number of shuffle partitions.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())  # the vocabulary: a few MB, whatever the corpus
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]):
        encoder, writer, at = encoder_of(spec.value), None, 0
        names = ["doc_id", "shard", "file", "start", "n_tokens"]
        for keys, lot in _lots(batches):
            if writer is None:
                partition, name = task_name("shard", ".zst")
                fs, path = filesystem(folder)
                writer = FrameWriter(fs.open_output_stream(f"{path}/{name}", compression=None))
            sizes = []
            for ids, found in encoder.encode(lot, end_id):
                writer.write(ids.tobytes())
                sizes.append(found)
            sizes = np.concatenate(sizes)
            ends = at + np.cumsum(sizes)
            n, starts, at = len(lot), ends - sizes, int(ends[-1])
            columns = [keys, pa.array([partition] * n, pa.int32()), pa.array([name] * n, pa.string()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)
        if writer is not None:
            writer.close()

    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    order = ("doc_id", F.xxhash64("text"))
    placed = chosen.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
    schema = f"doc_id {kind}, shard int, file string, start long, n_tokens long"
    map_arrow(placed, run, schema).write.parquet(f"{folder}/index")
    return spark.read.schema(schema).parquet(f"{folder}/index")


def global_starts(index: DataFrame) -> DataFrame:
    """The index with ``start`` counted over all shards."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("total"))  # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))
    joined = index.join(F.broadcast(shards), "shard")  # as many rows as the store has shards
    return joined.withColumn("first", F.col("start") + F.col("before")).drop("before")


def read_store(index: DataFrame, folder: str) -> DataFrame:
    """The rows of ``index`` with ``ids``, their packed ids read from the shards.

    Any selection of index rows may be read; only frames that hold them are.
    """
    names = index.columns
    of = [names.index(c) for c in ("file", "start", "n_tokens")]

    def run(batches):
        fs, path = filesystem(folder)
        name, reader = None, None
        for batch in batches:
            ids: list[bytes] = []
            begin, size = 0, 0
            for k, (file, start, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in of), strict=True), 1):
                if file != name:
                    name, reader = file, FrameReader(fs.open_input_file(f"{path}/{file}"))
                ids.append(reader.read(4 * start, 4 * n))
                size += 4 * n
                if size >= 8 << 20 or k == batch.num_rows:
                    part = batch.slice(begin, k - begin)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], [*names, "ids"])
                    ids, begin, size = [], k, 0

    return map_arrow(index, run, index.withColumn("ids", F.lit(b"")).schema)


@query("op5_token_store")
def op5(spark, sf_dir):
    """Ids of all documents written in id order, then read back from the shards."""
    folder = fresh_folder(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    index = write_store(docs, default_tokenizer("byte_bpe_50k.json"), folder)
    rows = read_store(global_starts(index), folder)
    return rows.select(
        "doc_id", F.col("first").alias("start"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
