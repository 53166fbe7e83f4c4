"""BPE encoding and decoding (operator 3): a minimal acyclic transducer lexicon plus exact merges for unseen words.

1. ``word_counts``: every text is split by the tokenizer's pattern; tasks pre-count, Spark sums the counts of all words.
   Which characters are letters and numbers is asked of the tokenizers library on the driver, once, so that neither
   the interpreter's Unicode tables nor those of the executors decide.
2. ``build_lexicon``: the ``lexicon_size`` most frequent words (a documented bound, so the collected list and the file
   stay small) are merged once and compiled into a minimal acyclic transducer (``lexicon.py``).
3. ``encode``: the file travels with ``SparkContext.addFile``; tasks memory-map their executor's copy. Words found in the
   transducer take its ids, all other words are merged exactly by rank. The result never depends on the lexicon.
   An Arrow batch is cut at spaces and dictionary-encoded, so that Python sees each distinct piece of a batch once; the
   texts' ids are put together by Arrow ``take``.
4. ``decode``: ids to bytes to text, ill-formed UTF-8 replaced, special tokens kept.

The tokenizer file (byte-level BPE JSON) is a path on the driver; it is shipped to the executors the same way.

Defined results: NULL and empty texts have no ids (an empty, non-NULL array of 0 bytes) and decode to the empty text;
a NULL ids value decodes to the empty text. Text that spells a special token becomes that token. Rows are independent;
repeated rows repeat their result; extra columns pass through, and one named like a result column raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import lexicon
from kestrel.llm.common import checkpointed, joined_runs, lean_memory, map_arrays, pieces, refuse_clash, release_memory
from kestrel.llm.merges import WIDTHS, MergeTable, binary_parts, by_width, byte_rows, in_order, merge_rows, packed
from kestrel.session import ensure_checkpoint_dir

LEXICON_SIZE = 1 << 17
MAX_LEXICON_WORD = 64  # bytes; longer words are merged when met
TASK_WORDS = 1 << 18  # pieces a task counts before it hands their counts on
SLICE_BYTES = 4 << 20  # texts that a task encodes at once
MEMO_WORDS = 1 << 17  # encoded words, and pieces, that a task remembers
MEMO_PIECE = 48  # characters; longer pieces are not remembered
SHORT = 64  # bytes; longer words are merged with a heap
TOP_COUNT = 1 << 16  # word counts are told apart up to here

# The white space of the splitting pattern (Unicode White_Space).
WHITE = r"\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


# A space that stands after white space and before white space or the end: a word may cross the place before it.
INSIDE_RUN = re.compile(f" (?<=[{WHITE}] )(?=[{WHITE}]|\\Z)")
OUTSIDE_RUN = re.compile(f"(?<![{WHITE}]) (?=[^{WHITE}])")


def cut(text: str) -> list[str]:
    """The text cut at spaces that no word of the splitting pattern crosses, without these spaces. A word holds a space
    other than its first character only inside a run of white space; such a run ends before its last space if a word
    follows, so the pattern gives the same words on each piece with a space before it (the first one without)."""
    return OUTSIDE_RUN.split(text) if INSIDE_RUN.search(text) else text.split(" ")


# The same for a whole batch of texts (RE2 writes code points in braces): white space, a space, white space or the end.
CROSSED = "[{0}] (?:[{0}]|\\z)".format(re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", WHITE))
# A piece of these letters alone is one word, with a space before it or without; ASCII punctuation after them is a
# second one. ASCII and Latin-1 letters, ASCII punctuation.
WORD_AND_MARKS = "^(?P<word> ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<marks>[!-/:-@\\[-`{-~]*)$"
LETTER_PLANES = 0x40000  # no plane from the fourth on has letters or numbers


@lru_cache(maxsize=1)
def unicode_classes() -> tuple[str, str]:
    """The letters and the numbers, as character ranges of a pattern, as the tokenizers library knows them."""
    from tokenizers import Regex, pre_tokenizers

    every = "".join(chr(c) for c in range(LETTER_PLANES) if not 0xD800 <= c <= 0xDFFF)

    def ranges(category: str) -> str:
        runs = pre_tokenizers.Split(Regex(rf"\p{{{category}}}+"), "removed", invert=True).pre_tokenize_str(every)
        return "".join(f"\\U{ord(r[0]):08x}-\\U{ord(r[-1]):08x}" for r, _ in runs)

    return ranges("L"), ranges("N")


@lru_cache(maxsize=2)
def splitter(classes: tuple[str, str] | None = None) -> re.Pattern:
    """The GPT-2 splitting pattern with \\p{L} and \\p{N} written out as character ranges."""
    letters, numbers = classes or unicode_classes()
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{WHITE}{letters}{numbers}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
    )


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level BPE files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        table[chr(256 + i)] = b
    return table


class Bpe:
    """Vocabulary and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        model = spec["model"]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab = model["vocab"]
        raw = {tok: bytes(alphabet[c] for c in tok) for tok in vocab if tok not in self.specials}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for tok, b in raw.items():
            self.bytes_of[vocab[tok]] = b
        for tok, i in self.specials.items():
            self.bytes_of[i] = tok.encode()
        self.byte_id = [0] * 256
        for c, b in alphabet.items():
            self.byte_id[b] = vocab[c]
        # a pair of ids as one number -> its rank and the id it makes, as one number that orders by rank
        self.bits = size.bit_length()
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[a] << self.bits | vocab[b]] = rank << self.bits | vocab[a + b]
        self.table = MergeTable(
            [k >> self.bits for k in self.merges], [k & (1 << self.bits) - 1 for k in self.merges],
            [m >> self.bits for m in self.merges.values()], [m & (1 << self.bits) - 1 for m in self.merges.values()])
        self.byte_ids = np.array(self.byte_id, np.int32)
        self.special_re = (
            re.compile("(" + "|".join(re.escape(s) for s in sorted(self.specials, key=len, reverse=True)) + ")")
            if self.specials else None
        )

    def merge(self, word: bytes) -> list[int]:
        """Exact merges: always the lowest rank, leftmost first."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) > SHORT:
            return self._merge_long(ids)
        get, bits, never = self.merges.get, self.bits, 1 << 62
        mask = (1 << bits) - 1
        ranks = [get(a << bits | b, never) for a, b in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < never:
            i = ranks.index(low)
            made = low & mask
            ids[i : i + 2] = [made]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << bits | made, never)
            if i < len(ranks):
                ranks[i] = get(made << bits | ids[i + 1], never)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, O(n log n) for words of any length."""
        n, get, bits = len(ids), self.merges.get, self.bits
        mask = (1 << bits) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get(ids[i] << bits | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            made = m & mask
            ids[i], ids[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (x := get(made << bits | ids[k])) is not None:
                    heapq.heappush(heap, (x, i, made, ids[k]))
            p = before[i]
            if p >= 0 and (x := get(ids[p] << bits | made)) is not None:
                heapq.heappush(heap, (x, p, ids[p], made))
        return [x for x in ids if x >= 0]


@lru_cache(maxsize=4)
def _bpe(path: str) -> Bpe:
    return Bpe(path)


def encode_words(words: pa.Array, bpe: Bpe, lex: lexicon.Lexicon) -> pa.Array:
    """Packed ids of every word of a string array: the transducer's output, or exact merges of the word's bytes."""
    data, starts = binary_parts(words)
    lens = np.diff(starts)
    parts, places = [], []
    for chosen, width in by_width(lens):
        rows = byte_rows(data, starts, chosen, width)
        number = lex.numbers(rows, lens[chosen])
        seen = number >= 0
        parts.append(lex.outputs.take(pa.array(number[seen])))
        places.append(chosen[seen])
        ids, n = merge_rows(bpe.table, bpe.byte_ids[rows[~seen]], lens[chosen][~seen])
        parts.append(packed(ids, n))
        places.append(chosen[~seen])
    rest = np.flatnonzero(lens > WIDTHS[-1])
    if len(rest):
        values = [w.as_py().encode() for w in words.take(pa.array(rest))]
        parts.append(pa.array([lex.lookup(w) or array("I", bpe.merge(w)).tobytes() for w in values], pa.binary()))
        places.append(rest)
    return in_order(parts, places)


class _Words(dict):
    """word -> packed ids; a missing word goes to the transducer, then to exact merges."""

    def __init__(self, bpe: Bpe, words: lexicon.Lexicon):
        super().__init__()
        self.bpe, self.words = bpe, words

    def __missing__(self, word: str) -> bytes:
        raw = word.encode("utf-8", "replace")
        ids = self.words.lookup(raw)
        if ids is None:
            ids = array("I", self.bpe.merge(raw)).tobytes()
        if len(word) <= MEMO_PIECE:
            self[word] = ids
        return ids


class _Pieces(dict):
    """piece (see ``cut``) -> packed ids of the piece with a space before it. So the pattern runs on pieces that are new,
    not on every text."""

    def __init__(self, words: _Words, classes: tuple[str, str] | None = None):
        super().__init__()
        self.words, self.split = words, splitter(classes).findall

    def __missing__(self, piece: str) -> bytes:
        ids = b"".join(map(self.words.__getitem__, self.split(" " + piece)))
        if len(piece) <= MEMO_PIECE:
            self[piece] = ids
        return ids

    def bound(self) -> None:
        if len(self) > MEMO_WORDS:
            self.clear()
        if len(self.words) > MEMO_WORDS:
            self.words.clear()

    def encode(self, text: str) -> bytes:
        self.bound()
        first, *rest = cut(text)
        return b"".join(map(self.words.__getitem__, self.split(first))) + b"".join(map(self.__getitem__, rest))


def space_pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Plain texts cut at every space: the distinct pieces (each with the space before it, but for the texts' first
    ones), the numbers of the texts' pieces, and where those of each text start."""
    lists = pc.split_pattern(texts, " ")
    starts = lists.offsets.to_numpy().astype(np.int64)
    starts -= starts[0]
    later = np.ones(starts[-1], bool)
    later[starts[:-1]] = False
    flat, later = lists.flatten(), pa.array(later)
    codes, first = flat.filter(later).dictionary_encode(), flat.filter(pc.invert(later))
    spaced = pc.binary_join_element_wise(" ", codes.dictionary, "")
    number = np.empty(len(flat), np.int64)
    later = later.to_numpy(zero_copy_only=False)
    number[later], number[~later] = codes.indices.to_numpy(), np.arange(len(spaced), len(spaced) + len(first))
    return pa.concat_arrays([spaced, first]), number, starts


def plain_rows(texts: pa.Array, specials) -> np.ndarray:
    """Which texts may be cut at every space: those without mixed runs of white space and without special tokens."""
    bad = pc.match_substring_regex(texts, CROSSED)
    for s in specials:
        bad = pc.or_(bad, pc.match_substring(texts, s))
    return ~bad.to_numpy(zero_copy_only=False).astype(bool)


def word_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) of all texts. Tasks count before the shuffle, in tables of about ``TASK_WORDS`` entries."""
    classes = unicode_classes()

    def run(batches):
        lean_memory()
        split, pieces_ = splitter(classes).findall, Counter()

        def flush():
            counts = Counter()
            for piece, n in pieces_.items():
                for word in split(piece):
                    counts[word] += n
            out = pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
            )
            pieces_.clear()
            return out

        for batch in batches:
            for part in pieces(batch, [text_col], SLICE_BYTES):
                texts = pc.fill_null(part.column(0), "")
                plain = plain_rows(texts, ())
                distinct, number, _ = space_pieces(texts.filter(pa.array(plain)))
                for piece, n in zip(distinct.to_pylist(), np.bincount(number, minlength=len(distinct)).tolist()):
                    pieces_[piece] += n
                for text in texts.filter(pa.array(~plain)).to_pylist():
                    head, *rest = cut(text)
                    pieces_.update([head, *(" " + r for r in rest)])
                if len(pieces_) > TASK_WORDS:
                    yield flush()
        yield flush()
        release_memory()

    return df.select(text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int = LEXICON_SIZE) -> list[str]:
    """At most ``size`` words, all those whose count exceeds the least bound that leaves so few. The bound comes from
    a histogram of counts (at most ``TOP_COUNT`` rows), so the driver receives ``size`` words and never a long list."""
    short = counts.where(F.octet_length("word") <= MAX_LEXICON_WORD).withColumn("n", F.least("n", F.lit(TOP_COUNT)))
    bound, above = TOP_COUNT, 0
    for r in sorted(short.groupBy("n").count().collect(), reverse=True):
        if r["n"] < 2 or above + r["count"] > size:
            break
        bound, above = r["n"], above + r["count"]
    return [r.word for r in short.where(F.col("n") >= bound).select("word").collect()] if above else []


def build_lexicon(words: list[str], bpe: Bpe) -> bytes:
    return lexicon.build((w, bpe.merge(w)) for w in sorted({w.encode() for w in words}))


def ship(spark: SparkSession, data: bytes, kind: str) -> str:
    """Give every executor, present or future, its own copy of a small file; returns the name to look it up by. The file
    lies in the shared folder of ``spark.checkpoint.dir``. Its name follows from the content, so content that this
    application has shipped before is not shipped again."""
    name = f"{kind}-{hashlib.sha256(data).hexdigest()[:24]}"
    if any(f.endswith("/" + name) for f in spark.sparkContext.listFiles):
        return name
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shipped-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")  # noqa: SLF001 - no public writer for one file
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)  # noqa: SLF001
    out.write(bytearray(data))
    out.close()
    spark.sparkContext.addFile(path.toString())
    return name


class Encoder:
    """What a task encodes with. It ends with the task: workers that wait for other work hold no words."""

    def __init__(self, tokenizer_path: str, lexicon_path: str, classes: tuple[str, str]):
        bpe = self.bpe = _bpe(tokenizer_path)
        self.lex = lexicon.Lexicon.mapped(lexicon_path)
        self.memo, self.split = _Pieces(_Words(bpe, self.lex), classes), splitter(classes).findall
        self.special = {s: array("I", [i]).tobytes() for s, i in bpe.specials.items()}
        self.special_re = bpe.special_re

    def text(self, text: str) -> bytes:
        if not any(s in text for s in self.special):
            return self.memo.encode(text)
        return b"".join(self.special[p] if p in self.special else self.memo.encode(p)
                        for p in self.special_re.split(text) if p)

    def batch(self, texts: pa.Array) -> pa.Array:
        """Packed ids of every text: the plain ones through the batch's distinct words, the others one by one."""
        texts = pc.fill_null(texts, "")
        plain = plain_rows(texts, self.special)
        distinct, number, starts = space_pieces(texts.filter(pa.array(plain)))
        words, word_starts = self.words_of(distinct)
        codes = words.dictionary_encode()
        table = encode_words(codes.dictionary, self.bpe, self.lex)
        out = joined_runs(joined_runs(table, codes.indices.to_numpy(), word_starts), number, starts)
        if plain.all():
            return out
        rest = pa.array([self.text(t) for t in texts.filter(pa.array(~plain)).to_pylist()], pa.binary())
        return in_order([out, rest], [np.flatnonzero(plain), np.flatnonzero(~plain)])

    def words_of(self, distinct: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all pieces in order, and where those of each piece start."""
        simple = pc.extract_regex(distinct, WORD_AND_MARKS)
        easy = simple.is_valid().to_numpy(zero_copy_only=False)
        word, marks = (pc.struct_field(simple, i).filter(pa.array(easy)) for i in (0, 1))
        marked = pc.not_equal(marks, "")
        more = [self.split(p) for p in distinct.filter(pa.array(~easy)).to_pylist()]
        sizes = np.ones(len(distinct), np.int64)
        sizes[easy] += marked.to_numpy(zero_copy_only=False)
        sizes[~easy] = [len(w) for w in more]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        first = starts[:-1][easy]
        places = [first, first[marked.to_numpy(zero_copy_only=False)] + 1, np.flatnonzero(np.repeat(~easy, sizes))]
        return in_order([word, marks.filter(marked), pa.array([w for ws in more for w in ws], pa.string())], places), starts


class Decoder:
    def __init__(self, tokenizer_path: str):
        self.table = pa.array(_bpe(tokenizer_path).bytes_of, pa.binary())

    def batch(self, ids: pa.Array) -> pa.Array:
        """Bytes of all ids by one ``take``, cut into texts; ill-formed UTF-8 is replaced."""
        starts = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1].astype(np.int64)
        flat = np.frombuffer(ids.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]].copy().view("<u4")
        raw = joined_runs(self.table, flat, (starts - starts[0]) // 4)
        try:
            return raw.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())


class Codec:
    """Names of the shipped tokenizer and transducer files and the character classes; picklable, opened inside tasks."""

    def __init__(self, tokenizer_file: str, lexicon_file: str):
        self.tokenizer_file, self.lexicon_file, self.classes = tokenizer_file, lexicon_file, unicode_classes()

    def encoder(self) -> Encoder:
        return Encoder(SparkFiles.get(self.tokenizer_file), SparkFiles.get(self.lexicon_file), self.classes)

    def decoder(self) -> Decoder:
        return Decoder(SparkFiles.get(self.tokenizer_file))


def prepare(df: DataFrame, tokenizer_path: str, text_col: str = "text", lexicon_size: int = LEXICON_SIZE) -> Codec:
    """Count the words of all texts, compile the frequent ones, ship both files."""
    spark = df.sparkSession
    bpe = _bpe(tokenizer_path)
    words = frequent_words(checkpointed(word_counts(df, text_col).where("n > 1")), lexicon_size)
    with open(tokenizer_path, "rb") as f:
        tokenizer_file = ship(spark, f.read(), "tokenizer")
    return Codec(tokenizer_file, ship(spark, build_lexicon(words, bpe), "lexicon"))


def encode(df: DataFrame, codec: Codec, text_col: str = "text", keep=None, decoded: bool = False) -> DataFrame:
    """The ``keep`` columns (default: every input column) plus ``ids`` (little-endian unsigned 32-bit, packed) and
    ``n_tokens``; with ``decoded`` also what ``decode`` makes of the ids, in the same pass."""
    keep = df.columns if keep is None else list(keep)
    ddl = "ids binary, n_tokens bigint" + ", decoded string" * decoded
    refuse_clash(keep, ddl)

    def make():
        one, back = codec.encoder(), codec.decoder()

        def call(texts):
            ids = one.batch(texts)
            out = [ids, pc.divide(pc.binary_length(ids), 4).cast(pa.int64())]
            return [*out, back.batch(ids)] if decoded else out

        return call

    return map_arrays(df, [text_col], keep, ddl, make, SLICE_BYTES)


def decode(df: DataFrame, codec: Codec, ids_col: str = "ids", keep=None) -> DataFrame:
    """The ``keep`` columns (default: every input column) plus ``decoded``."""
    keep = df.columns if keep is None else list(keep)
    refuse_clash(keep, "decoded string")

    def make():
        one = codec.decoder()
        return lambda ids: [one.batch(pc.fill_null(ids, b""))]

    return map_arrays(df, [ids_col], keep, "decoded string", make)
