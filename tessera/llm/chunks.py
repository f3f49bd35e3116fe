"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last ``SPAN`` bytes picks, among the starts of white-space
runs, those where a chunk ends, so equal passages are cut alike wherever they
stand. A chunk is encoded by the library as one text, once for as long as it stays
in the byte-bounded cache of the Python worker; wherever it stands again its ids are
reused. At each join of two chunks the characters beside it (or, beyond plain letters, the last word before and the first after) are
encoded together and compared with their ids apart; on disagreement the two chunks
become one, which is encoded anew, and its own joins are compared again, until all
agree.

Defined results: null or empty text: no ids, empty decoded text; a text without
white space is one chunk; repeated rows are encoded alike; columns of ``keep``
that are named like a new one are replaced by it; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import kernels
from tessera.llm.pieces import Cache, tokenizer
from tessera.llm.scratch import kept_schema, table

U = np.uint64
SPAN, MASK, BESIDE = 8, 63, 3
#: Bytes of each generation of the caches of chunks and of joins, and of what goes to the library in one call.
CHUNK_BYTES, JOIN_BYTES, CALL_BYTES = 12 << 20, 2 << 20, 1 << 18
SPACE = ~kernels.NOT_SPACE
NEW = {"ids": "array<int>", "decoded": "string"}
#: The normalizer that texts of ``PLAIN`` characters pass as if only lower-cased: they have no marks to compose,
#: no character whose lower case is two, no white space but ASCII, and no beginning of a special token.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PLAIN = re.compile("[\t-\r -;=-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]*")

#: Bytes of plain ASCII text that begins and ends no special token, and the byte between the sides of a join.
EASY = bytes(x for x in range(128) if PLAIN.fullmatch(chr(x)) and chr(x) != ">") + b"\xff"


def cuts(piece: kernels.Slice) -> np.ndarray:
    """Positions at which chunks begin inside texts: starts of white space where a hash of the SPAN bytes before says so."""
    buf = piece.buf
    if len(buf) <= SPAN:
        return np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(SPACE[buf[SPAN:]] & ~SPACE[buf[SPAN - 1 : -1]]) + SPAN
    before = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buf, SPAN)[at - SPAN]).view(U).ravel()
    return at[(kernels.mix(before) & U(MASK)) == 0]


class Codec:
    """Ids of texts given as chunks, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.tokens = pa.array([self.library.id_to_token(i) for i in range(self.library.get_vocab_size())], pa.string())
        self.normalizer = self.library.normalizer
        with open(path, encoding="utf-8") as file:
            self.lowers = json.load(file).get("normalizer") == NORMALIZER
        self.bytes_given = self.bytes_encoded = 0
        self.forget()

    def forget(self) -> None:
        """Empty caches, so that a worker that goes on to other work holds none of this."""
        self.chunks, self.joins, self.words = Cache(CHUNK_BYTES), Cache(JOIN_BYTES), Cache(JOIN_BYTES)

    def encoded(self, chunks: list[bytes]) -> list[bytes]:
        """What the library makes of each chunk; plain ones reach it in lower case, past its normalizer."""
        texts = [c.decode() for c in chunks]
        plain = [self.lowers and PLAIN.fullmatch(x) is not None for x in texts]
        out: list[bytes] = [b""] * len(texts)
        self.bytes_encoded += sum(map(len, chunks))
        for kind in (True, False):
            own = [i for i, p in enumerate(plain) if p == kind]
            if kind:
                self.library.normalizer = None
            try:
                for group in groups(own, texts):
                    found = self.library.encode_batch_fast([texts[i].lower() if kind else texts[i] for i in group], add_special_tokens=False)
                    for i, e in zip(group, found):
                        out[i] = array("I", e.ids).tobytes()
            finally:
                self.library.normalizer = self.normalizer
        return out

    def agree(self, joins: list[bytes]) -> list[bytes]:
        """Of each join (its sides with a byte 0xFF between), b"1" if both sides have the same ids together as apart, else b"0"."""
        sides = [j.split(b"\xff") for j in joins]
        apart = self.words.bring({x for pair in sides for x in pair}, self.encoded)
        return [b"1" if whole == apart[a] + apart[b] else b"0" for whole, (a, b) in zip(self.encoded([a + b for a, b in sides]), sides)]

    def encode(self, texts: list[list[bytes]]) -> list[bytes]:
        self.bytes_given += sum(len(c) for t in texts for c in t)
        todo = list(range(len(texts)))
        while todo:
            joins = {k: [join(a, b) for a, b in zip(texts[k], texts[k][1:])] for k in todo}
            agree = self.joins.bring({j for own in joins.values() for j in own}, self.agree)
            todo = [k for k in todo if any(agree[j] == b"0" for j in joins[k])]
            for k in todo:
                merged = texts[k][:1]
                for j, chunk in zip(joins[k], texts[k][1:]):
                    if agree[j] == b"0":
                        merged[-1] += chunk
                    else:
                        merged.append(chunk)
                texts[k] = merged
        found = self.chunks.bring({c for t in texts for c in t}, self.encoded)
        return [b"".join(map(found.__getitem__, t)) for t in texts]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The decoder of a file that names none: its tokens, joined by spaces."""
        return pa.compute.binary_join(pa.ListArray.from_arrays(ids.offsets, self.tokens.take(ids.values)), " ")


def groups(own: list[int], texts: list[str]) -> Iterator[list[int]]:
    """Numbers of texts in runs of about CALL_BYTES characters."""
    group, size = [], 0
    for i in own:
        if group and size + len(texts[i]) > CALL_BYTES:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(texts[i])
    if group:
        yield group


def join(a: bytes, b: bytes) -> bytes:
    """What tells whether two chunks may be encoded apart, with a byte between that UTF-8 never has.

    Normalizers and pre-tokenizers of ``PLAIN`` text decide by the characters beside a place, so there the last and first
    ``BESIDE`` are enough, of which few combinations exist. Else, and where a special token may end or begin, it is the last and the first word.
    """
    beside = a[-BESIDE:] + b"\xff" + b[: BESIDE + 1]
    if not beside.translate(None, EASY) and b[:1].isspace() and not b[1:2].isspace():
        return beside
    space = len(b) - len(b.lstrip())
    tail, head = a[-2 * BESIDE :].decode(errors="ignore")[-BESIDE:], b[: space + 2 * BESIDE].decode(errors="ignore")[: space + BESIDE]
    if space and PLAIN.fullmatch(tail + head) and ">" not in tail:
        return tail.encode() + b"\xff" + head.encode()
    last, first = a.split()[-1:] if len(a) < 64 else a[-64:].split()[-1:], b.split(None, 1)[:1]
    if last and len(last[0]) >= 63:
        last = a.rsplit(None, 1)[-1:]
    tail = last[0] if last else a
    head = b[: b.index(first[0]) + len(first[0])] if first else b
    return tail + b"\xff" + head


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, tokenizer_path: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row with ``ids`` of the whole text and the text ``decoded`` from them; ``docs`` needs ``text``."""
    keep = [c for c in keep if c not in NEW]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer_path)
        try:
            for batch in batches:
                for piece in kernels.slices(batch.column("text")):
                    at = cuts(piece)
                    raw, off = piece.buf.tobytes(), piece.off.tolist()
                    among = np.searchsorted(at, piece.off)
                    texts = []
                    for i in range(piece.rows):
                        edge = [off[i], *(x for x in at[among[i] : among[i + 1]].tolist() if off[i] < x < off[i + 1]), off[i + 1]]
                        texts.append([raw[x:y] for x, y in zip(edge[:-1], edge[1:]) if x < y])
                    found = own.encode(texts)
                    ends = np.cumsum([0, *(len(x) // 4 for x in found)]).astype(np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), np.int32)))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(piece.first, piece.rows) for c in keep), ids, own.decode(ids)], [*keep, *NEW])
        finally:
            own.forget()

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, kept_schema(docs, keep, NEW))


def digests(encoded: DataFrame) -> DataFrame:
    """``ids`` and ``decoded`` as their number and SHA-256 sums, ids in decimal, joined by spaces."""
    return (
        encoded.withColumn("n_tokens", F.size("ids").cast("long"))
        .withColumn("ids_sha256", F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256))
        .withColumn("decoded_sha256", F.sha2("decoded", 256))
        .drop("ids", "decoded")
    )


def op9_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(encode(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"]))
