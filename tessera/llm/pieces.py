"""Exact tokenization of whole texts through a bounded table of pieces.

A text is cut in front of each run of white space and between a letter and a sign behind it, where the
pre-tokenizers used here always split, so the library's ids of the text are those
of its pieces, one after another. Cuts are found on the bytes of some MB of texts at once; where a byte
leaves open what its character is, nothing is cut. Arrow finds the distinct pieces and their rows in the
table of the Python worker; what the table lacks is encoded by the library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tessera.llm.kernels import byte_class

#: Bytes of a table of pieces, and characters that are cut and encoded together.
PIECE_BYTES, TOGETHER_CHARS = 64 << 20, 4 << 20
#: White space behind what is none, for Python and the library alike (U+001C to U+001F, U+0085 and U+180E are not).
NEXT = re.compile(r"(?<=[^\s\u180e])[^\S\x1c-\x1f\x85]")
BETWEEN, TOGETHER = "<|endoftext|>", 2000
SPACE, SIGN, LETTER, SOLID = 1, 2, 4, 8
#: What a byte is: white space, an ASCII sign but the apostrophe, an ASCII letter, surely no white space (bytes of other characters are looked at beside their neighbours).
KIND = sum(bit * byte_class(pattern).astype(np.uint8) for bit, pattern in ((SPACE, r"[\x20\x09-\x0D]"), (SIGN, r"[!-&(-/:-@\[-`{-~]"), (LETTER, "[A-Za-z]"), (SOLID, r"[^\x20\x09-\x0D\x1C-\x1F]"))).astype(np.uint8)


def cuts(buf: np.ndarray) -> np.ndarray:
    """Whether bytes of UTF-8 are cut in front of each place, the end included; beside these, cut where texts begin."""
    kind = KIND[buf]
    at = np.flatnonzero(kind[1:] & (SPACE | SIGN)) + 1
    before = kind[at - 1]
    wide = np.flatnonzero(buf[at - 1] > 127)
    if len(wide):
        x, y, z = (buf[np.maximum(at[wide] - k, 0)] for k in (3, 2, 1))
        letter = (y == 0xC3) & (z != 0x97) & (z != 0xB7)  # U+00C0 to U+00FF
        # Two or three bytes that may be white space for Python or the library: U+0085, U+00A0; U+1680, U+180E and others; U+2000 to U+200F, U+2020 to U+202F; U+2040 to U+207F; U+3000 to U+303F.
        space = (y == 0xC2) | (x == 0xE1) & ((y == 0x9A) | (y == 0xA0)) | (x == 0xE2) & ((y == 0x80) & (z & 0x1F < 0x10) | (y == 0x81)) | (x == 0xE3) & (y == 0x80)
        before[wide] = np.where(space, 0, SOLID) | np.where(letter, LETTER, 0)
    here = kind[at]
    at = at[(here & SPACE != 0) & (before & SOLID != 0) | (here & SIGN != 0) & (before & LETTER != 0)]
    out = np.zeros(len(buf) + 1, dtype=bool)
    out[at] = True
    raw, found = buf.tobytes(), -1
    while (found := raw.find(BETWEEN.encode(), found + 1)) >= 0:
        out[found + 1 : found + len(BETWEEN)] = False
    return out


class Cache:
    """Values by key in two generations of about ``budget`` bytes each.

    When the young generation is full it becomes the old one, and what is met again
    moves back. Keys longer than ``LONGEST`` are held until the next call only.
    """

    LONGEST, ENTRY = 4096, 200  # ENTRY: what an entry costs beside its bytes

    def __init__(self, budget: int):
        self.budget, self.size = budget, 0
        self.young: dict = {}
        self.old: dict = {}
        self.long: list = []

    def bring(self, keys: set, make: Callable[[list], list]) -> dict:
        """A dictionary with the values of all keys; those not held are made together."""
        for k in self.long:
            del self.young[k]
        self.long.clear()
        if self.size > self.budget:
            self.old, self.young, self.size = self.young, {}, 0
        missing = keys.difference(self.young)
        if missing:
            again = {k: v for k in missing if (v := self.old.get(k)) is not None}
            new = list(missing.difference(again))
            made = dict(zip(new, make(new)))
            for found in (again, made):
                self.young.update(found)
                self.size += sum(map(len, found)) + sum(map(len, found.values())) + self.ENTRY * len(found)
            self.long += [k for k in new if len(k) > self.LONGEST]
            self.size -= sum(len(k) + len(made[k]) + self.ENTRY for k in self.long)
        return self.young


_LOADED: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once by each worker, without truncation or padding."""
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(path)
        found.no_truncation()
        found.no_padding()
        _LOADED[path] = found
    return _LOADED[path]


class Known:
    """A table of pieces and their ids, of about ``budget`` bytes: beyond that, what was met latest makes up its half.

    Pieces longer than ``LONGEST`` are held until the next call only.
    """

    LONGEST, ENTRY = 4096, 32  # ENTRY: what a piece costs beside its bytes and ids

    def __init__(self, budget: int):
        self.budget = budget
        self.keys = pa.array([], pa.large_binary())
        self.ids, self.count, self.met, self.now = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def cost(self) -> np.ndarray:
        return pc.binary_length(self.keys).to_numpy(zero_copy_only=False) + 4 * self.count + self.ENTRY

    def trim(self) -> None:
        cost = self.cost()
        keep = cost - 4 * self.count - self.ENTRY <= self.LONGEST
        if cost[keep].sum() > self.budget:
            order = np.argsort(-self.met, kind="stable")
            order = order[keep[order]]
            keep[order[np.cumsum(cost[order]) > self.budget // 2]] = False
        if not keep.all():
            self.keys, self.ids = self.keys.filter(pa.array(keep)), self.ids[np.repeat(keep, self.count)]
            self.count, self.met = self.count[keep], self.met[keep]

    def bring(self, keys: pa.Array, make: Callable[[list[str]], list[bytes]]) -> np.ndarray:
        """Rows of distinct keys in the table; those not held are made together."""
        self.trim()
        self.now += 1
        row = pc.index_in(keys, value_set=self.keys)
        missing = pc.is_null(row)
        row = pc.fill_null(row, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = keys.filter(missing)
        if len(new):
            made = make(new.cast(pa.large_string()).to_pylist())
            row[row < 0] = np.arange(len(self.keys), len(self.keys) + len(new))
            self.keys = pa.concat_arrays([self.keys, new])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(made), "<u4")])
            self.count = np.concatenate([self.count, np.fromiter(map(len, made), np.int64, len(made)) // 4])
            self.met = np.concatenate([self.met, np.zeros(len(made), np.int64)])
        self.met[row] = self.now
        return row


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    Pieces to encode go to the library together, with a special token between them,
    which the library splits at before anything else.
    """

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.between = self.library.token_to_id(BETWEEN)
        self.known = Known(PIECE_BYTES)

    def together(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, none of which holds the special token."""
        groups = [pieces[k : k + TOGETHER] for k in range(0, len(pieces), TOGETHER)]
        out: list[bytes] = []
        for group in groups:
            ids = np.array(self.library.encode_batch_fast([BETWEEN.join(group)], add_special_tokens=False)[0].ids, dtype="<u4")
            edge = [-1, *np.flatnonzero(ids == self.between).tolist(), len(ids)]
            if len(edge) != len(group) + 1:
                raise ValueError("pieces were not kept apart")
            raw = ids.tobytes()
            out += [raw[4 * a + 4 : 4 * b] for a, b in zip(edge[:-1], edge[1:])]
        return out

    def make(self, pieces: list[str]) -> list[bytes]:
        plain = [k for k in pieces if BETWEEN not in k]
        found = dict(zip(plain, self.together(plain)))
        return [found[k] if k in found else np.array(self.library.encode(k, add_special_tokens=False).ids, dtype="<u4").tobytes() for k in pieces]

    def pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of some texts, which are cut and looked up together."""
        whole = pa.array(texts, pa.large_string())
        off = np.frombuffer(whole.buffers()[1], np.int64)[: len(texts) + 1]
        if not off[-1]:
            return [b""] * len(texts)
        cut = cuts(np.frombuffer(whole.buffers()[2], np.uint8, off[-1]))
        cut[off] = True
        edge = np.flatnonzero(cut)
        found = pa.Array.from_buffers(pa.large_binary(), len(edge) - 1, [None, pa.py_buffer(edge), whole.buffers()[2]]).dictionary_encode()
        row = self.known.bring(found.dictionary, self.make)
        count = self.known.count[row]
        start = (np.cumsum(self.known.count) - self.known.count)[row]
        each = found.indices.to_numpy()
        n = count[each]
        end = np.concatenate([[0], np.cumsum(n)])
        ids = self.known.ids[np.repeat(start[each] - end[:-1], n) + np.arange(end[-1])]
        at = end[np.searchsorted(edge, off)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        group: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            for (i, _), ids in zip(group, self.pieces([x for _, x in group])):
                out[i] += ids
            group.clear()
            size = 0

        for i, text in enumerate(texts):
            for part in parts(text or ""):
                group.append((i, part))
                size += len(part)
                if size > TOGETHER_CHARS:
                    flush()
        flush()
        return out


def parts(text: str) -> Iterator[str]:
    """A text in parts of about TOGETHER_CHARS, which begin with white space."""
    at = 0
    while len(text) - at > TOGETHER_CHARS and (cut := NEXT.search(text, at + TOGETHER_CHARS)) is not None:
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices with about TOGETHER_CHARS bytes of ``text``; a longer text is a slice of its own."""
    end = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(end, (end[at - 1] if at else 0) + TOGETHER_CHARS, side="right")))
        yield batch.slice(at, to - at)
        at = to


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
