"""Token ids in sorted-string-table shards.

A shard is one file: blocks of entries in ascending key order, then a sparse index
(first key, offset and length of each block), a Bloom filter of the keys, and a
footer. Keys are prefix-compressed within a block, blocks are zstd frames with a
CRC. A look-up asks the Bloom filter, searches the index by halves and reads one
block; a scan reads block after block. Both need the index and one block in
memory, whatever the size of the shard.

Documents are dealt by ranges of (doc_id, hash of the text) into as many shards as their
bytes need, so shards follow each other in key order and a doc_id with very many rows is spread over
several. A task writes under a name of its own and reports it with its place in the
manifest, one row for each shard; files of lost or repeated attempts are in no
manifest, and ``sweep`` deletes them. Files are reached through ``pyarrow.fs``, by the address
of the shared folder.

Defined results: null or empty text: the end id alone; a null doc_id sorts first;
rows of one doc_id follow each other in the order of a hash of their texts and are numbered
within each shard; ids that do not fit into ``width`` bytes are an error; an empty table has no shards;
further columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.kernels import mix
from tessera.llm.pieces import encoder, some
from tessera.llm.scratch import folder, table, written

U = np.uint64
#: Bytes of text in a shard, and the least for which a shard of its own is worth it; bytes of a block.
SHARD_BYTES, LEAST_BYTES, BLOCK_BYTES = 32 << 20, 1 << 20, 1 << 16
BITS_PER_KEY, PROBES = 10, 7
MAGIC = b"TSST0001"
FOOTER = struct.Struct("<QQQQQQ8s")  # offsets of index, filter, footer; entries; tokens; bytes of an id; magic
END_ID = 2


def key_of(doc_id: int | None, repeat: int) -> bytes:
    """Bytes that sort like (doc_id, repeat), null first."""
    return b"\0" + struct.pack(">I", repeat) if doc_id is None else b"\1" + struct.pack(">QI", (doc_id + (1 << 63)), repeat)


def id_of(key: bytes) -> int | None:
    return None if key[0] == 0 else struct.unpack(">Q", key[1:9])[0] - (1 << 63)


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while data[at] & 128:
        n |= (data[at] & 127) << shift
        shift += 7
        at += 1
    return n | data[at] << shift, at + 1


def key_hash(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key)


def probes(h: np.ndarray, bits: int) -> np.ndarray:
    step = mix(h) | U(1)
    return np.stack([(h + U(k) * step) % U(bits) for k in range(PROBES)])


class Writer:
    def __init__(self, sink, width: int):
        self.sink, self.width = sink, width
        self.at = self.entries = self.tokens = 0
        self.block, self.size, self.first, self.last = [], 0, b"", b""
        self.index: list[bytes] = []
        self.keys = array("Q")  # their hashes
        self.pack = zstandard.ZstdCompressor(level=1)

    def put(self, data: bytes) -> None:
        self.sink.write(data)
        self.at += len(data)

    def flush(self) -> None:
        if self.block:
            data = self.pack.compress(b"".join(self.block))
            self.index.append(varint(len(self.first)) + self.first + struct.pack("<QII", self.at, len(data), zlib.crc32(data)))
            self.put(data)
            self.block, self.size, self.last = [], 0, b""

    def add(self, key: bytes, ids: np.ndarray) -> None:
        same = 0
        while same < min(len(key), len(self.last)) and key[same] == self.last[same]:
            same += 1
        if len(ids) and int(ids.max()) >> (8 * self.width):
            raise ValueError(f"id {ids.max()} does not fit into {self.width} bytes")
        value = ids.astype(f"<u{self.width}").tobytes()
        if not self.block:
            self.first, same = key, 0
        entry = varint(same) + varint(len(key) - same) + varint(len(value)) + key[same:] + value
        self.block.append(entry)
        self.size += len(entry)
        self.last = key
        self.keys.append(key_hash(key))
        self.entries += 1
        self.tokens += len(ids)
        if self.size >= BLOCK_BYTES:
            self.flush()

    def close(self) -> None:
        self.flush()
        index_at = self.at
        self.put(b"".join(self.index))
        filter_at = self.at
        bits = max(64, 8 * -(-len(self.keys) * BITS_PER_KEY // 8))
        filled = np.zeros(bits, dtype=bool)
        if self.keys:
            hashes = np.frombuffer(self.keys, dtype=U)
            for k in range(0, len(hashes), 1 << 16):
                filled[probes(hashes[k : k + (1 << 16)], bits).ravel().astype(np.int64)] = True
        self.put(np.packbits(filled, bitorder="little").tobytes())
        self.put(FOOTER.pack(index_at, filter_at, self.at, self.entries, self.tokens, self.width, MAGIC))
        self.sink.close()


class Reader:
    """A shard opened for look-ups and scans; ``source`` is a seekable file."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - FOOTER.size)
        index_at, filter_at, footer_at, self.entries, self.tokens, self.width, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != MAGIC or footer_at + FOOTER.size != end:
            raise ValueError("not a complete shard")
        source.seek(index_at)
        data = source.read(footer_at - index_at)
        self.filter = np.frombuffer(data, np.uint8, offset=filter_at - index_at)
        self.first, self.place, at = [], [], 0
        while at < filter_at - index_at:
            n, at = read_varint(data, at)
            self.first.append(data[at : at + n])
            self.place.append(struct.unpack_from("<QII", data, at + n))
            at += n + 16

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        offset, length, crc = self.place[i]
        self.source.seek(offset)
        data = self.source.read(length)
        if zlib.crc32(data) != crc:
            raise ValueError(f"block {i} is damaged")
        data = zstandard.ZstdDecompressor().decompress(data)
        at, key = 0, b""
        while at < len(data):
            same, at = read_varint(data, at)
            more, at = read_varint(data, at)
            size, at = read_varint(data, at)
            key = key[:same] + data[at : at + more]
            at += more
            yield key, np.frombuffer(data, f"<u{self.width}", size // self.width, at)
            at += size

    def scan(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.place)):
            yield from self.block(i)

    def get(self, doc_id: int | None, repeat: int = 0) -> np.ndarray | None:
        key = key_of(doc_id, repeat)
        at = probes(np.array([key_hash(key)], dtype=U), 8 * len(self.filter)).ravel().astype(np.int64)
        if not (self.filter[at >> 3] >> (at & 7) & 1).all():
            return None
        i = bisect_right(self.first, key) - 1
        return next((ids for k, ids in (self.block(i) if i >= 0 else ()) if k == key), None)


MANIFEST = "file string, part int, first long, last long, n_docs long, n_tokens long, n_bytes long"


def write(docs: DataFrame, path: str, tokenizer: str, width: int = 2, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Shards of ``docs`` (doc_id, text) below ``path``; the manifest, a row for each shard: file, part (its place), first, last, n_docs, n_tokens, n_bytes."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(-(-size // shard_bytes), min(docs.sparkSession.sparkContext.defaultParallelism, size // LEAST_BYTES), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        rows = (r for b in batches for part in some(b) for r in zip(part.column("doc_id").to_pylist(), own.encode(part.column("text").to_pylist())))
        got = next(rows, None)
        if got is None:
            return
        fs, top = pafs.FileSystem.from_uri(path)
        fs.create_dir(top, recursive=True)
        name = f"{uuid.uuid4().hex}.sst"
        to = Writer(fs.open_output_stream(f"{top}/{name}"), width)
        first = last = got[0]
        repeat = -1
        while got is not None:
            repeat = repeat + 1 if got[0] == last and repeat >= 0 else 0
            last = got[0]
            to.add(key_of(last, repeat), np.append(np.frombuffer(got[1], "<u4"), np.uint32(end_id)))
            got = next(rows, None)
        to.close()
        yield pa.RecordBatch.from_pydict({"file": [name], "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "first": pa.array([first], pa.int64()), "last": pa.array([last], pa.int64()), "n_docs": [to.entries], "n_tokens": [to.tokens], "n_bytes": [to.at]})

    dealt = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).repartitionByRange(shards, "doc_id", "h").sortWithinPartitions("doc_id", "h")
    return written(dealt.mapInArrow(run, MANIFEST), "manifest")


def sweep(manifest: DataFrame, path: str) -> int:
    """Delete the files below ``path`` that are in no manifest, once no writer is at work; their number."""
    fs, top = pafs.FileSystem.from_uri(path)
    known = {r["file"] for r in manifest.select("file").collect()}
    gone = [f.path for f in fs.get_file_info(pafs.FileSelector(top, allow_not_found=True)) if f.base_name not in known]
    for name in gone:
        fs.delete_file(name)
    return len(gone)


def read(manifest: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the shards. ``start`` adds up the shards before, by their manifest rows."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard, not for each document
    starts = manifest.select("file", "part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = pafs.FileSystem.from_uri(path)
        for batch in batches:
            for name, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                rows: list[tuple] = []
                with fs.open_input_file(f"{top}/{name}") as source:
                    for key, ids in Reader(source).scan():
                        rows.append((id_of(key), start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield packed(rows)
                            rows = []
                yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return starts.repartitionByRange(n, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = folder(spark, "shards")
    manifest = write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read(manifest, path)
