"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import re
import time
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.sources.workspace import Workspace

__all__ = ["Workspace", "connected_components", "encoder", "free_shuffles", "mix64", "parts_of", "read_table", "text_bytes"]

U64 = np.uint64
# Odd multipliers of a 64-bit finalizer; any odd constants with mixed bits serve.
MIX_A, MIX_B, MIX_C = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

# Bytes of text handled at once where arrays of their size are made; a longer text is one part.
PART = 1 << 20
CACHE_ENTRIES = 250_000
CACHE_CHARS = 48
# Latin letters that stay letters in lower case.
LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+"
ASCII_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
ASCII_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files of frames that no variable refers to any more."""
    for _ in range(2):  # what the first round lets go may hold more
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection, so unequal inputs stay unequal."""
    x = x * MIX_B
    x ^= x >> U64(29)
    x *= MIX_C
    x ^= x >> U64(32)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column end to end, and the offsets of its rows (null: empty)."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
    if not len(offsets) or column.buffers()[2] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts_of(batch: pa.RecordBatch, i: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``PART`` bytes in column ``i``; one row at least."""
    sizes = np.array([x or 0 for x in pa.compute.binary_length(batch.column(i)).to_pylist()], np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(batch):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + PART, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def white_space(raw: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space as the tokenizers' patterns see it."""
    space = ASCII_SPACE[raw]
    at = np.flatnonzero((raw == 0xC2) | (raw >= 0xE1) & (raw <= 0xE3))
    if len(at):
        code = raw[at].astype(np.int32) << 16  # the character's bytes, with a 0 for what a shorter one lacks
        code |= raw[at + 1].astype(np.int32) << 8
        three = at[raw[at] != 0xC2]
        code[raw[at] != 0xC2] |= raw[three + 2]
        wide = (code >= 0xE28080) & (code <= 0xE2808A)
        wide |= np.isin(code, [0xC28500, 0xC2A000, 0xE19A80, 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
        at, n = at[wide], 2 + (raw[at[wide]] != 0xC2)
        space[at] = space[at + 1] = space[at + n - 1] = True
    return space


def letter_bytes(raw: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters of ``LETTERS`` up to U+023F."""
    letter = ASCII_LETTER[raw]
    at = np.flatnonzero((raw >= 0xC3) & (raw <= 0xC8))
    if len(at):
        code = (raw[at].astype(np.int32) << 8) | raw[at + 1]
        at = at[~np.isin(code, [0xC397, 0xC3B7, 0xC4B0])]
        letter[at] = letter[at + 1] = True
    return letter


class CachedEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    A text is cut before each run of white space. No pre-token of the two vocabularies reaches over such
    a cut, so the ids of the pieces, end to end, are the ids of the text. Most pieces are letters with maybe a space or
    a line end before them and a mark after them; these are cut further, since the letters, the mark and the line end are
    pre-tokens of their own. Texts are cut as arrays of bytes, and each distinct piece of them is looked up once.
    The cache has two generations of ``entries`` pieces; what the older one holds unused is dropped. A text
    that may hold one of the vocabulary's added tokens, such as its end of text, is encoded as a whole.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        # A task has one core; the library's own threads would only contend with those of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.entries = entries
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.by_ends = any(p.endswith("</w>") for p in self.tokenizer.get_vocab())
        added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(a[:1] != "<" for a in added):
            raise ValueError("added tokens must begin with <")
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        # A vocabulary by word ends leaves white space out; the other's words begin with their space.
        self.word = re.compile(LETTERS if self.by_ends else f" ?{LETTERS}")
        # How a vocabulary of bytes writes them: those that print as they are, the rest as characters from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = (b for b in range(256) if b not in shown)
        self.written = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
        # Whether the model alone gives the ids of words as bytes: by ends in lower case, others as they are.
        probe = ["Zebras", "x", "Àéß", "ǅur", "ŁÓDŹ"]
        if not self.by_ends:
            probe += [f" {w}" for w in probe]
        self.direct = self._single(probe) == self._merged(probe)

    def _single(self, pieces: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _merged(self, words: list[str]) -> list[bytes]:
        merge, written = self.tokenizer.model.tokenize, self.written
        if self.by_ends:
            words = [w.lower() for w in words]
        texts = [w.replace(" ", written[32]) if w.isascii() else "".join([written[b] for b in w.encode()]) for w in words]
        return [array("I", [t.id for t in merge(x)]).tobytes() for x in texts]

    def _find(self, missing: list[str]) -> None:
        """Put the ids of pieces that the younger cache lacks there."""
        older, cache, is_word = self.older, self.cache, self.word.fullmatch
        words, others = [], []
        for p in missing:
            ids = older.get(p)
            if ids is not None:
                cache[p] = ids
            elif self.direct and is_word(p):
                words.append(p)
            else:
                others.append(p)
        cache.update(zip(words, self._merged(words), strict=True))
        for i in range(0, len(others), 20_000):
            part = others[i : i + 20_000]
            cache.update(zip(part, self._single(part), strict=True))

    def _cut(self, raw: np.ndarray, rows: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of texts, which are end to end in ``raw`` and begin at ``rows``, and the first piece of each row."""
        space = white_space(raw)
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[rows[rows < len(raw)]] = True
        begin = np.flatnonzero(first)
        end = np.append(begin[1:], len(raw))
        head, tail = raw[begin], raw[end - 1]
        line, blank = head == 10, head == 32
        mark = (tail == 44) | (tail == 46)
        letters = np.add.reduceat(letter_bytes(raw), begin, dtype=np.int64)
        simple = (letters > 0) & (letters == end - begin - line - blank - mark)
        first[(end - 1)[simple & mark]] = True
        first[(begin + 1)[simple & line]] = True
        if self.by_ends and self.direct:
            # Their spaces have no ids, and lower case tells fewer words apart.
            raw = np.where(np.repeat(simple, end - begin) & (raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)
            stays = np.ones(len(raw), bool)
            stays[begin[simple & blank]] = False
            first[(begin + 1)[simple & blank]] = True
            rows = np.append(0, np.cumsum(stays))[rows]
            raw, first = raw[stays], first[stays]
        begin = np.flatnonzero(first)
        offsets = np.append(begin, len(raw)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        return pieces, np.searchsorted(begin, rows)

    def _encode(self, column: pa.Array) -> list[bytes]:
        raw, offsets = text_bytes(column)
        if not len(raw):
            return [b""] * len(column)
        pieces, rows = self._cut(raw, offsets)
        coded = pieces.dictionary_encode()
        distinct, cache = coded.dictionary.to_pylist(), self.cache
        missing = [p for p in distinct if p not in cache]
        if missing:
            self._find(missing)
        ids = pa.array([cache[p] for p in distinct], pa.large_binary()).take(coded.indices)
        edges, data = np.frombuffer(ids.buffers()[1], "<i8", len(ids) + 1)[rows].tolist(), ids.buffers()[2]
        whole = data.to_pybytes() if data else b""
        out = [whole[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        if self.added is not None:
            for i in np.unique(np.searchsorted(offsets, np.flatnonzero(raw == ord("<")), "right") - 1).tolist():
                text = column[i].as_py()
                if self.added.search(text):
                    out[i] = self._single([text])[0]
        for p in missing:
            if len(p) > CACHE_CHARS:
                del cache[p]
        if len(cache) > self.entries:
            self.cache, self.older = {}, cache
        return out

    def encode_many(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text; what no cache holds is encoded for all of them together."""
        return self._encode(pa.array(texts, pa.large_string()))

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def encode_column(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text of a column, some texts at a time."""
        sizes = np.cumsum([x or 0 for x in pa.compute.binary_length(column).to_pylist()])
        at = 0
        while at < len(column):
            before = int(sizes[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, before + PART, "right")))
            yield from self._encode(column.slice(at, stop - at))
            at = stop


_ENCODERS: dict[str, CachedEncoder] = {}


def encoder(path: str, entries: int = CACHE_ENTRIES) -> CachedEncoder:
    """One encoder for each vocabulary file and Python worker, with the largest cache asked for."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path, entries)
    _ENCODERS[path].entries = max(entries, _ENCODERS[path].entries)
    return _ENCODERS[path]


def connected_components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long); component: the smallest node reachable.

    Alternates large-star and small-star steps, each a grouped minimum joined back to the edges, and
    writes the edges after every round. Minima are summed up before the shuffle, and the joins have a
    side with one row a key, so a centre with very many edges can be split.
    """
    e = ws.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges"
    )
    mark = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == mark or now[0] == 0:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
                e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            )
        mark = tuple(now)
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        below = large.groupBy("hi").agg(F.min("lo").alias("m"))
        pairs = large.join(below, "hi")
        small = (
            pairs.where("lo <> m")
            .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionByName(below.select("hi", F.col("m").alias("lo")))
            .distinct()
        )
        e = ws.keep(small, "edges")
