"""SentencePiece encoding and decoding (operator 13) that keeps offsets: every piece knows its bytes of the original text.

1. ``CharMap.normalize``: the model's compiled character map (a double array of key bytes) is walked for the longest key at
   each place of the text; what it maps to is written, and for every byte written the place it came from. Spaces become the
   mark U+2581, a mark is put before the text, and space runs are folded if the model says so.
2. The normalised text is cut before each run of marks (no piece of the vocabulary crosses such a place; a model with one
   that does is not cut), the distinct words of an Arrow batch are merged by score as rows of a matrix (``merges.py``),
   characters without a piece become byte pieces, and the texts' ids are put together by Arrow ``take``.
3. ``spans``: piece lengths add up to places in the normalised text, and the alignment turns these into byte spans of the
   original. All byte pieces of a character but the last have an empty span before it, as the library defines it.
4. ``decode``: pieces to bytes, marks to spaces, one space taken off the front, ill-formed bytes replaced.

A map that is empty, or has no key that begins in the text, leaves the text as it is, and alignment is then arithmetic: a
mark that was written for a space stands for one byte. Such texts (all of them with an identity map) go through Arrow as
whole batches; texts that the map changes, or that hold the mark itself, are normalised one by one.

The model file is a path on the driver, shipped to the executors as in operator 3. Supported are merge (BPE) models with byte
pieces and without user-defined or unused pieces; others raise ``ValueError``.

Defined results: a NULL or empty text has the end id alone (or no id) and decodes to the empty text; so does a NULL list of
ids. Control symbols spelled in a text are ordinary text. Rows are independent, repeated rows repeat their result; extra
columns pass through, and one named like a result column raises ``ValueError``.
"""

from __future__ import annotations

import codecs
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from kestrel.llm.bpe import SLICE_BYTES, ship
from kestrel.llm.common import joined_runs, map_arrays, refuse_clash
from kestrel.llm.merges import WIDTHS, MergeTable, by_width, in_order, merge_long, merge_rows, packed

MARK = "▁"
MARK_BYTES = MARK.encode()
POINTS = 0x110000
# Numbers of the fields of a model file, and of the kinds of pieces in it.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
MODEL_TYPE, SUFFIX_MARK, BYTE_FALLBACK, UNK_SURFACE = 3, 24, 35, 44
CHAR_MAP, DUMMY_PREFIX, FOLD_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
MERGE_MODEL = 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def fields(message: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol-buffer message: whole numbers, 4- and 8-byte values, byte strings."""

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at, value, shift = at + 1, value | (b & 127) << shift, shift + 7
            if b < 128:
                return value

    at = 0
    while at < len(message):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or number()
        yield tag >> 3, message[at : at + size]
        at += size


class CharMap:
    """The normaliser of a model."""

    def __init__(self, spec: bytes = b"", suffix_mark: bool = False):
        own = dict(fields(spec))
        self.prefix, self.fold = bool(own.get(DUMMY_PREFIX, 1)), bool(own.get(FOLD_SPACES, 1))
        self.space = MARK_BYTES if own.get(ESCAPE_SPACES, 1) else b" "
        self.suffix = suffix_mark
        blob = own.get(CHAR_MAP, b"")
        self.units, self.mapped, self.starts = [], b"", frozenset()
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
            self.mapped = blob[4 + size :]
            root = self._below(0)
            self.starts = frozenset(b for b in range(256) if self.units[root ^ b] & 0x800000FF == b)

    def _below(self, node: int) -> int:
        unit = self.units[node]
        return node ^ (unit >> 10 << ((unit & 512) >> 6))

    def longest(self, text: bytes, at: int) -> tuple[bytes, int]:
        """What the longest key that starts at ``at`` maps to, and its length; one character as it is if there is none."""
        lead = text[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        if lead not in self.starts:
            return text[at : at + size], size
        node, found, units = self._below(0), -1, self.units
        length = 0
        for k in range(at, len(text)):
            node ^= text[k]
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node = self._below(node)
            if unit >> 8 & 1:
                found, length = units[node] & 0x7FFFFFFF, k + 1 - at
        if found < 0:
            return text[at : at + size], size
        return self.mapped[found : self.mapped.index(b"\0", found)], length

    def normalize(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised text, for each of its bytes and its end the place in the original that it stands for)."""
        out, source, at, n = bytearray(), [], 0, len(text)

        def write(data: bytes, place: int) -> None:
            out.extend(data)
            source.extend([place] * len(data))

        if self.fold:
            while at < n:
                made, size = self.longest(text, at)
                if made != b" ":
                    break
                at += size
        if at >= n:
            return b"", np.zeros(1, np.int64)
        if self.prefix and not self.suffix:
            write(self.space, at)
        after_space = self.fold
        while at < n:
            made, size = self.longest(text, at)
            if after_space:
                made = made.lstrip(b" ")
            if made:
                write(made.replace(b" ", self.space), at)
                after_space = made.endswith(b" ")
            if not self.fold:
                after_space = False
            at += size
        if self.fold:
            while out.endswith(self.space):
                at = source[len(out) - len(self.space)]
                del out[-len(self.space) :], source[-len(self.space) :]
        if self.prefix and self.suffix:
            write(self.space, at)
        return bytes(out), np.array([*source, at], np.int64)


class PieceModel:
    """Vocabulary, merges and normaliser of a model file."""

    def __init__(self, data: bytes):
        parts = list(fields(data))
        trainer = dict(fields(dict(parts).get(TRAINER, b"")))
        specs = [dict(fields(v)) for f, v in parts if f == PIECES]
        kinds = np.array([s.get(KIND, NORMAL) for s in specs])
        if trainer.get(MODEL_TYPE) != MERGE_MODEL or not trainer.get(BYTE_FALLBACK) or np.isin(kinds, [USER_DEFINED, UNUSED]).any():
            raise ValueError("needs a merge model with byte pieces and without user-defined or unused ones")
        names = [s[PIECE].decode() for s in specs]
        self.map = CharMap(dict(parts).get(NORMALIZER, b""), bool(trainer.get(SUFFIX_MARK, 0)))
        self.kinds, self.size = kinds, len(names)
        self.end = next((i for i, n in enumerate(names) if n == "</s>" and kinds[i] == CONTROL), None)
        normal = {n: i for i, n in enumerate(names) if kinds[i] == NORMAL}
        self.byte_id = np.zeros(256, np.int64)
        for i in np.flatnonzero(kinds == BYTE):
            self.byte_id[int(names[i][3:5], 16)] = i
        # symbols: the pieces, characters that occur in pieces without being one, and any other character
        extra = {c: self.size + k for k, c in enumerate(sorted({c for n in normal for c in n} - normal.keys()))}
        symbol = {**normal, **extra}
        self.other = self.size + len(extra)
        self.symbol_of = np.full(POINTS, self.other, np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        self.chars = np.ones(self.other + 1, np.int64)
        # a symbol's bytes in the original text, where its marks stand for spaces of one byte
        self.width = np.zeros(self.other + 1, np.int64)
        score = [struct.unpack("<f", s.get(SCORE, b"\0\0\0\0"))[0] for s in specs]
        rank_of = {v: r for r, v in enumerate(sorted(set(score), reverse=True))}
        left, right, rank, made = [], [], [], []
        for name, i in normal.items():
            self.chars[i], self.width[i] = len(name), len(name.encode()) - 2 * name.count(MARK)
            for k in range(1, len(name)):
                a, b = symbol.get(name[:k]), symbol.get(name[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(rank_of[score[i]]), made.append(i)
        self.table = MergeTable(left, right, rank, made)
        self.cuts = not any(re.search(f"[^{MARK}]{MARK}", n) for n in normal)
        surface = trainer.get(UNK_SURFACE, " ⁇ ".encode())
        self.bytes_of = pa.array([
            surface if k == UNKNOWN else b"" if k == CONTROL else bytes([int(n[3:5], 16)]) if k == BYTE
            else n.replace(MARK, " ").encode() for n, k in zip(names, kinds.tolist())], pa.binary())
        self.marked = np.array([k == NORMAL and n.startswith(MARK) for n, k in zip(names, kinds.tolist())])
        self.norm_width = np.array([len(n.encode()) for n in names])

    def words(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """For every word of normalised text its ids and their widths in the original, packed as 32-bit numbers."""
        texts = words.to_pylist()
        lens = np.fromiter(map(len, texts), np.int64, len(texts))
        ids, widths, places = [], [], []
        for chosen, width in by_width(lens):
            points = np.array([texts[i] for i in chosen], dtype=f"U{width}").view(np.uint32).reshape(len(chosen), width)
            rows, n = merge_rows(self.table, self.symbol_of[points], lens[chosen])
            a, b = self.with_bytes(rows, n, points)
            ids.append(a), widths.append(b), places.append(chosen)
        for i in np.flatnonzero(lens > WIDTHS[-1]):
            points = np.array(list(texts[i]), dtype="U1").view(np.uint32)
            row = np.array([merge_long(self.table, self.symbol_of[points].tolist())], np.int32)
            a, b = self.with_bytes(row, np.array([row.shape[1]]), points[None, :])
            ids.append(a), widths.append(b), places.append(np.array([i]))
        return in_order(ids, places), in_order(widths, places)

    def with_bytes(self, rows: np.ndarray, lens: np.ndarray, points: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Ids and widths of rows of symbols; a symbol that is no piece becomes the bytes of its character."""
        used = np.arange(rows.shape[1])[None, :] < lens[:, None]
        if not (unknown := used & (rows >= self.size)).any():
            return packed(rows, lens), packed(self.width[rows], lens)
        begin = np.cumsum(np.where(used, self.chars[np.minimum(rows, self.other)], 0), 1)
        flat, at = rows[used].astype(np.int64), np.flatnonzero(unknown[used])
        row, col = np.nonzero(unknown)
        raw = [chr(points[r, begin[r, c] - 1]).encode() for r, c in zip(row, col)]
        sizes = np.ones(len(flat), np.int64)
        sizes[at] = [len(b) for b in raw]
        out, widths = np.repeat(flat, sizes), np.repeat(np.where(flat < self.size, self.width[flat], 0), sizes)
        of_bytes = np.repeat(np.isin(np.arange(len(flat)), at), sizes)
        out[of_bytes] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        widths[(np.cumsum(sizes) - 1)[at]] = sizes[at]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.concatenate([[0], np.cumsum(lens)])
        new = np.diff(total[ends])
        return packed_flat(out, new), packed_flat(widths, new)

    def encode(self, texts: pa.Array, end: bool = False) -> tuple[pa.Array, pa.Array, pa.Array]:
        """(ids, begins, ends) of every text as lists; begins and ends are bytes of the original UTF-8 text."""
        texts = pc.fill_null(texts, "")
        simple = self.simple_rows(texts)
        rows, words, starts = [], [], [np.zeros(1, np.int64)]
        if simple.any():
            own, first = self.cut_simple(texts.filter(pa.array(simple)))
            rows.append(np.flatnonzero(simple)), words.append(own), starts.append(first[1:])
        aligned = []
        if not simple.all():
            normal = [self.map.normalize(t.encode()) for t in texts.filter(pa.array(~simple)).to_pylist()]
            own = [self.cut(n.decode("utf-8", "replace")) for n, _ in normal]
            aligned = [source for _, source in normal]
            rows.append(np.flatnonzero(~simple)), words.append(pa.array([w for ws in own for w in ws], pa.string()))
            starts.append(starts[-1][-1] + np.cumsum([len(ws) for ws in own]))
        codes = (pa.concat_arrays(words) if words else pa.array([], pa.string())).dictionary_encode()
        number, starts = codes.indices.to_numpy(), np.concatenate(starts)
        ids, widths = self.words(codes.dictionary)
        ids, widths = joined_runs(ids, number, starts), joined_runs(widths, number, starts)
        sizes = pc.binary_length(ids).to_numpy() // 4
        flat = [np.frombuffer(v.buffers()[2] or b"", "<u4")[: sizes.sum()].astype(np.int64) for v in (ids, widths)]
        first = np.concatenate([[0], np.cumsum(sizes)])
        n_simple = int(simple.sum())
        # simple texts: the mark put before the text stands for nothing
        flat[1][first[:-1][:n_simple][sizes[:n_simple] > 0]] -= 1 if self.map.prefix else 0
        upto = np.concatenate([[0], np.cumsum(flat[1])])
        begins, ends = (upto[:-1] - np.repeat(upto[first[:-1]], sizes)), (upto[1:] - np.repeat(upto[first[:-1]], sizes))
        for k, source in enumerate(aligned, n_simple):
            own = slice(first[k], first[k + 1])
            begins[own], ends[own] = self.project(flat[0][own], source)
        out = [flat[0], begins, ends]
        if end:
            length = np.concatenate([np.zeros(0, np.int64), *[pc.binary_length(texts).to_numpy()[r] for r in rows]])
            out = [np.insert(v, first[1:], x) for v, x in zip(out, (self.end, length, length))]
            first = first + np.arange(len(first))
        back = np.empty(len(texts), np.int64)
        back[np.concatenate(rows) if rows else np.zeros(0, np.int64)] = np.arange(len(texts))
        return tuple(
            pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(v.astype(np.int32))).take(pa.array(back)) for v in out)

    def simple_rows(self, texts: pa.Array) -> np.ndarray:
        """Texts that the map leaves alone, without the mark, without runs of spaces and without one in front."""
        if self.map.fold or not self.map.prefix or self.map.suffix or self.map.space != MARK_BYTES or self.map.starts or not self.cuts:
            return np.zeros(len(texts), bool)
        no = pc.or_(pc.match_substring(texts, MARK), pc.match_substring(texts, "  "))
        return ~pc.or_(no, pc.starts_with(texts, " ")).to_numpy(zero_copy_only=False).astype(bool)

    def cut_simple(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of simple texts, each with its mark, and where those of each text start; empty texts have none."""
        lists = pc.split_pattern(texts, " ")
        starts = lists.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        words = pc.binary_join_element_wise(MARK, lists.flatten(), "")
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        if empty.any():
            keep = np.ones(len(words), bool)
            keep[starts[:-1][empty]] = False
            words = words.filter(pa.array(keep))
            starts = starts - np.concatenate([[0], np.cumsum(empty)])
        return words, starts

    def cut(self, text: str) -> list[str]:
        """Normalised text cut before each run of marks."""
        if not self.cuts:
            return [text] if text else []
        return re.findall(f"{MARK}+[^{MARK}]*|^[^{MARK}]+", text)

    def project(self, ids: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte spans of the original for the ids of one normalised text with its alignment."""
        is_byte = self.kinds[ids] == BYTE
        value = np.searchsorted(self.byte_id[np.argsort(self.byte_id)], ids)
        value = np.argsort(self.byte_id)[np.minimum(value, 255)]
        size = np.where(value < 0x80, 1, np.where(value < 0xE0, 2, np.where(value < 0xF0, 3, 4)))
        lead = is_byte & ((value & 0xC0) != 0x80)
        widths = np.where(is_byte, 0, self.norm_width[ids])
        place = np.flatnonzero(lead)
        widths[place + size[place] - 1] = size[place]
        upto = np.concatenate([[0], np.cumsum(widths)])
        return source[upto[:-1]], source[upto[1:]]

    def decode(self, ids: pa.Array) -> pa.Array:
        """The texts of lists of ids."""
        starts = ids.offsets.to_numpy().astype(np.int64)
        flat = ids.values.to_numpy()[starts[0] : starts[-1]].astype(np.int64)
        starts -= starts[0]
        raw = joined_runs(self.bytes_of, flat, starts)
        try:
            text = raw.cast(pa.string())
        except pa.ArrowInvalid:
            text = pa.array([b.decode("utf-8", "replace-each") for b in raw.to_pylist()], pa.string())
        if not (self.map.prefix or self.map.fold):
            return text
        if self.map.fold:
            raise ValueError("decoding with folded spaces is not supported")
        seen = np.append(np.flatnonzero(self.kinds[flat] != CONTROL), len(flat))
        first = seen[np.searchsorted(seen, starts[:-1])]
        front = np.zeros(len(ids), bool)
        inside = first < starts[1:]
        front[inside] = self.marked[flat[first[inside]]]
        return pc.if_else(pa.array(front), pc.utf8_slice_codeunits(text, 1), text)


# one replacement character for every byte that is part of no character
codecs.register_error("replace-each", lambda e: ("�" * (e.end - e.start), e.end))


def packed_flat(values: np.ndarray, lens: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lens) * 4]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(ends), pa.py_buffer(values.astype("<u4"))])


@lru_cache(maxsize=2)
def _model(path: str) -> PieceModel:
    with open(path, "rb") as f:
        return PieceModel(f.read())


class PieceCodec:
    """Name of the shipped model file; picklable, opened inside tasks."""

    def __init__(self, model_file: str):
        self.model_file = model_file

    def model(self) -> PieceModel:
        return _model(SparkFiles.get(self.model_file))


def prepare(df: DataFrame, model_path: str) -> PieceCodec:
    _model(model_path)  # refuses unsupported models here and not in tasks
    with open(model_path, "rb") as f:
        return PieceCodec(ship(df.sparkSession, f.read(), "pieces"))


def encode(df: DataFrame, codec: PieceCodec, text_col: str = "text", keep=None, end: bool = False, decoded: bool = False) -> DataFrame:
    """The ``keep`` columns (default: every input column) plus ``ids``, ``begins`` and ``ends`` (byte spans); ``end`` adds
    the end id, with an empty span after the text; ``decoded`` adds what ``decode`` makes of the ids, in the same pass."""
    keep = df.columns if keep is None else list(keep)
    ddl = "ids array<int>, begins array<int>, ends array<int>" + ", decoded string" * decoded
    refuse_clash(keep, ddl)

    def make():
        model = codec.model()

        def call(texts):
            out = model.encode(texts, end)
            return [*out, model.decode(out[0])] if decoded else out

        return call

    return map_arrays(df, [text_col], keep, ddl, make, SLICE_BYTES)


def decode(df: DataFrame, codec: PieceCodec, ids_col: str = "ids", keep=None) -> DataFrame:
    """The ``keep`` columns (default: every input column) plus ``decoded``."""
    keep = df.columns if keep is None else list(keep)
    refuse_clash(keep, "decoded string")

    def make():
        model = codec.model()
        return lambda ids: [model.decode(pc.fill_null(ids, pa.scalar([], ids.type)) if ids.null_count else ids)]

    return map_arrays(df, [ids_col], keep, "decoded string", make)
