"""Token-ID output: length-delimited binary records with masked checksums and a separate offset index.

A shard is a file of frames; all integers are little-endian:

    u64 length | u32 masked CRC-32 of the length | payload | u32 masked CRC-32 of the payload | 0x0A

The payload is a header (u8 format version, u8 bytes an id, u8 1 if the document
has an id, i64 document id) and the token ids. The end byte is what Spark's text
sink puts after a row, which writes the frames: so any file system Spark writes to
will do, and its commit protocol makes lost or repeated tasks leave no trace. A
file's number in its name orders the shards, and documents are in ascending order
of id (nulls first, ties by the text's hash) within and across shards.

The index is a Parquet table, a row a frame: shard, file, offset, length, doc_id,
n_tokens and more. ``read_shuffled`` reads frames in a seeded random order, whole
shards at a time, from offsets alone.

Nulls and odd rows: a null text is empty and still has its end id; rows with equal
or null ids are each written; other columns of the input are ignored; an empty
table gives an empty index.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curdle.llm import bpe

_HEADER = struct.Struct("<BBBq")
_VERSION = 1
#: Text bytes a shard is made for; a longer document fills one alone.
SHARD_BYTES = 8 << 20
#: Texts encoded together: those of a shard, so that each distinct unit of a shard is looked up once.
GROUP_CHARS = SHARD_BYTES
#: Units in each of an encoder's two tables, the current one and the one before.
TABLE = 1 << 18
#: What Python's str.isspace() takes as white space, as a class of Arrow's regular expressions (whose \s is ASCII alone).
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def masked(crc: int) -> int:
    """The checksum rotated and offset, so that a checksum of stored checksums keeps its strength."""
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


class Encoder:
    """Ids of whole texts by the tokenizers library, as little-endian bytes, each distinct unit encoded once.

    A space before a character that is no white space always begins a pre-token of a
    byte-level tokenizer, and a lone line break is one, so a text is cut there and each unit (" word,") is split
    by that tokenizer's pattern and encoded by the library's model. Units and pieces are
    kept in bounded tables. Texts where units would not stand
    alone (white space after white space, or at the end, a special string, a null
    character) go through the library whole, as do all texts of other tokenizers.
    """

    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_str(spec)
        self.t.no_truncation()
        self.t.no_padding()
        small = self.t.get_vocab_size(with_added_tokens=True) <= 1 << 16
        self.width, self.code = (2, "H") if small else (4, "I")
        j = json.loads(spec)
        specials = [re.escape(x["content"]) for x in j.get("added_tokens", [])]
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        plain = byte_level.items() <= (j.get("pre_tokenizer") or {}).items() and not j.get("normalizer") and not j.get("post_processor")
        self.whole = "|".join([rf"{_SPACE}(?:{_SPACE}|\z)", r"\x00", *specials]) if plain else ""
        self.table: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.split, self.symbols = regex.compile(bpe.SPLIT).findall, dict(enumerate(bpe.byte_symbols()))

    def _by_library(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, found.ids).tobytes() for found in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) > TABLE:
                self.pieces.clear()
            symbols = piece.encode().decode("latin-1").translate(self.symbols)
            self.pieces[piece] = ids = array(self.code, [token.id for token in self.t.model.tokenize(symbols)]).tobytes()
        return ids

    def _unit(self, unit: str) -> bytes:
        """A unit is split by the byte-level pattern, and the library's model encodes each distinct piece."""
        last = unit[-1:]
        if last in ".," and unit[-2:-1].isalpha():  # a mark after a letter always is a piece of its own
            return self._unit(unit[:-1]) + self._piece(last)
        if unit[:1] == " " and unit[1:].isalpha():  # a space and letters are one piece
            return self._piece(unit)
        return b"".join(map(self._piece, self.split(unit)))

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units, those not met lately encoded."""
        if len(self.table) > TABLE:  # units in use come over from the table before
            self.before, self.table = self.table, {}
        table, before = self.table, self.before
        found = list(map(table.get, units))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            ids = before.get(units[i])
            table[units[i]] = found[i] = self._unit(units[i]) if ids is None else ids
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Units are cut out, told apart and put together again as Arrow columns; Python sees each distinct one of a group once."""
        given = pa.array(texts, pa.string())
        cut = pc.invert(pc.match_substring_regex(given, self.whole))
        marked, cut = given.filter(cut), cut.to_pylist()
        marked = pc.replace_substring(pc.replace_substring(marked, " ", "\0 "), "\n", "\0\n\0")
        units = pc.split_pattern(marked, "\0")
        coded = units.flatten().dictionary_encode()
        ids = pa.array(self._units(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(coded.indices)
        if len(ids):
            _, ends, data = ids.buffers()
            at = np.frombuffer(ends, dtype=np.int64)[units.offsets.to_numpy()] if len(units) else []
            data = memoryview(data) if data is not None else memoryview(b"")
        found = iter(range(len(units)))
        return [bytes(data[at[i] : at[i + 1]]) if c and (i := next(found)) is not None else self._by_library([t])[0] for t, c in zip(texts, cut)]


_encoders: dict[int, Encoder] = {}


def encoder_for(spec: str) -> Encoder:
    """This worker's encoder; it stays for the worker's next tasks."""
    key = zlib.crc32(spec.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(spec)
    return _encoders[key]


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = _HEADER.pack(_VERSION, width, doc_id is not None, doc_id or 0) + ids
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(zlib.crc32(length))), payload, struct.pack("<I", masked(zlib.crc32(payload)))))


def frames(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, frame length, document id, ids) of each frame of a shard; raises ValueError where a checksum fails."""
    at = 0
    while at < len(content):
        offset, doc_id, ids, end = at, *read_frame(content, at)
        yield offset, end - offset, doc_id, ids
        at = end


def read_frame(content: bytes, at: int) -> tuple[int | None, np.ndarray, int]:
    """The frame at an offset: document id, ids, and the offset after it."""
    length = content[at : at + 8]
    if len(length) < 8 or struct.unpack_from("<I", content, at + 8)[0] != masked(zlib.crc32(length)):
        raise ValueError(f"length checksum fails at offset {at}")
    size = struct.unpack("<Q", length)[0]
    payload = content[at + 12 : at + 12 + size]
    end = at + 16 + size
    if len(payload) < size or struct.unpack_from("<I", content, end - 4)[0] != masked(zlib.crc32(payload)) or content[end : end + 1] != b"\n":
        raise ValueError(f"payload checksum fails at offset {at}")
    version, width, has_id, doc_id = _HEADER.unpack_from(payload)
    if version != _VERSION:
        raise ValueError(f"format version {version}")
    return (doc_id if has_id else None), np.frombuffer(payload, f"<u{width}", offset=_HEADER.size), end + 1


def write_records(docs: DataFrame, spec: str, path: str, id_col: str = "doc_id", text: str = "text", end_id: int = 0) -> None:
    """Encode every whole text with the tokenizers library, append ``end_id`` and write the shards below ``path``."""
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_BYTES))
    shipped = spark.sparkContext.broadcast(spec)  # a tokenizer file: its size does not grow with the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(shipped.value)
        end = array(encoder.code, [end_id]).tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(ids):
                group, chars = [], 0
                while at + len(group) < len(ids) and chars < GROUP_CHARS:
                    group.append(texts[at + len(group)].as_py())
                    chars += len(group[-1])
                out = [frame(doc_id, found + end, encoder.width) for doc_id, found in zip(ids[at : at + len(group)], encoder.encode(group))]
                at += len(group)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    tie = F.xxhash64("text")
    dealt = picked.repartitionByRange(shards, F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    # The cast keeps the bytes as they are; the text sink writes them out unchanged.
    dealt.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")).write.text(path)


def build_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Read the shards back, check every frame, and write the offset index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                name, data = name.as_py(), content.as_buffer().to_pybytes()
                rows = [(o, n, d, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for o, n, d, ids in frames(data)]
                if not rows:
                    continue
                offset, length, doc_id, n, crc = zip(*rows)
                before = np.cumsum([0, *n[:-1]])
                shard = int(re.search(r"part-(\d+)", name.rpartition("/")[2])[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(rows), pa.int32()), pa.array([name] * len(rows), pa.string()), pa.array(offset, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(n, pa.int64()), pa.array(before, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    names=names,
                )

    schema = "shard int, file string, offset long, length long, doc_id long, n_tokens long, start_in_shard long, ids_crc32 long"
    names = [c.split()[0] for c in schema.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    files.select("path", "content").mapInArrow(run, schema).write.parquet(index_path)
    return spark.read.schema(schema).parquet(index_path)


def with_starts(index: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all documents before. Shard totals are summed first, so the ordered window has a row a shard."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return index.join(before, "shard").withColumn("start", F.col("before") + F.col("start_in_shard")).drop("before")


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, seed: int = 0) -> DataFrame:
    """(position, doc_id, ids) in a seeded random order: shards in random order, frames at random within, found by their offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, offsets in zip(batch.column(0), batch.column(1)):
                data = content.as_buffer().to_pybytes()
                got = [read_frame(data, at)[:2] for at in offsets.as_py()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(len(got)), pa.int64()), pa.array([d for d, _ in got], pa.int64()), pa.array([x.astype(np.int64) for _, x in got], pa.list_(pa.int64()))],
                    names=["position", "doc_id", "ids"],
                )

    mixed = lambda *c: F.xxhash64(*c, F.lit(seed))
    # A shard's offsets are bounded by its size, like its bytes.
    plan = index.groupBy("file").agg(F.sort_array(F.collect_list(F.struct(mixed("file", "offset").alias("r"), "offset"))).alias("o"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    joined = files.join(plan, files["path"] == plan["file"]).orderBy(mixed("file"))
    return joined.select("content", F.col("o.offset").alias("offsets")).mapInArrow(run, "position long, doc_id long, ids array<long>")
