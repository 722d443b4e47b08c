"""SentencePiece BPE encoding with seeded merge-dropout, and decoding without loss.

Merges are taken from an agenda, best score first and leftmost of equals; each candidate is skipped if a keyed
hash says so. The key is of the seed, the document, the place of the word and the merge, so the same
text is segmented in varied ways, yet every run gives the same pieces. Whatever is skipped, the pieces spell the text.

The agendas of many words are worked off side by side in arrays: a step takes the best merge of each word. Words
in which no applied merge is skipped have the pieces of the plain run, which are remembered with its merges; a merge that
the plain run only offers, and does not apply, changes nothing when it is skipped.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskrank.llm.common import MIX_A, MIX_C, U64, mix64, parts_of, text_bytes

SPACE = "▁"
# No piece of such a vocabulary reaches from a word into the spaces after it, so chunks are encoded alone: a text is cut before each run
# of spaces, as by this pattern.
CHUNK = re.compile(" *[^ ]+| +")
# Words handled at once; longer words have an agenda of their own.
WORDS = 1 << 15
LONG = 48
CACHE_ENTRIES = 200_000
CACHE_CHARS = 32
MASK = (1 << 64) - 1
# Odd numbers that spread what names a merge: where its two symbols begin and where it ends.
KEY, BEGIN, MIDDLE, END = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93
NEVER = np.iinfo(np.int32).max


def skips(h: np.ndarray, limit: int) -> np.ndarray:
    """Whether the merges that these keys name are skipped."""
    h = (h ^ h >> U64(32)) * U64(END)
    h = (h ^ h >> U64(29)) * U64(BEGIN)
    return (h ^ h >> U64(32)) < U64(min(limit, MASK))


class Merges:
    """The merges of a vocabulary as arrays: which two symbols give which, and which is better."""

    def __init__(self, score: dict[str, float], ids: dict[str, int]):
        symbols = sorted({*score, *(c for p in score for c in p)})
        number = {p: i for i, p in enumerate(symbols)}
        self.piece = np.array([ids.get(p, -1) for p in symbols], np.int64)
        best = {s: i for i, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = np.array([best[score[p]] if p in score else NEVER for p in symbols], np.int32)
        pairs = [
            (number[p[:i]] * len(symbols) + number[p[i:]], number[p])
            for p in score
            for i in range(1, len(p))
            if p[:i] in number and p[i:] in number
        ]
        self.size = len(symbols)
        keys, merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self._hash(keys, merged)
        self.of_character = np.full(0x110000, -1, np.int32)
        for p, i in number.items():
            if len(p) == 1:
                self.of_character[ord(p)] = i

    def _hash(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """A table of pairs that is at most an eighth full: a pair lies in its slot or in one of the next."""
        bits = max(8, int(np.ceil(np.log2(8 * len(keys)))))
        self.shift = U64(64 - bits)
        self.pairs, self.merged = np.full((1 << bits) + 64, -1, np.int64), np.full((1 << bits) + 64, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slots(keys)
        while len(left):
            free = np.flatnonzero(self.pairs[slot] < 0)
            taken, one = np.unique(slot[free], return_index=True)
            one = free[one]
            self.pairs[taken], self.merged[taken] = keys[left[one]], merged[left[one]]
            rest = np.ones(len(left), bool)
            rest[one] = False
            left, slot = left[rest], slot[rest] + 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * U64(KEY)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol that two neighbours give, -1 for none."""
        wanted = left.astype(np.int64) * self.size + right
        slot = self._slots(wanted)
        held = self.pairs[slot]
        out = np.where(held == wanted, self.merged[slot], np.int32(-1))
        open_ = np.flatnonzero((held != wanted) & (held >= 0))
        while len(open_):
            slot[open_] += 1
            held = self.pairs[slot[open_]]
            same = held == wanted[open_]
            out[open_[same]] = self.merged[slot[open_[same]]]
            open_ = open_[~same & (held >= 0)]
        out[(left < 0) | (right < 0)] = -1
        return out

    def run(self, text: str, sizes: np.ndarray, keys: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
        """Work off the agendas of all words, which are end to end in ``text``.

        Returns the symbols of all words end to end, the first code point and the word of each, and for every merge that
        was applied its word and what its place in the word adds to the key.
        """
        code = np.frombuffer(text.encode("utf-32-le"), "<u4")
        symbol = self.of_character[code]
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        at = np.arange(len(symbol), dtype=np.int32)  # where a symbol begins in the text
        rank, merged = np.full(len(symbol), NEVER, np.int32), np.full(len(symbol), -1, np.int32)

        def place(i: np.ndarray) -> np.ndarray:
            """What the merges of the symbols i with those after them add to the keys of their words."""
            of, after = word[i], np.minimum(i + 2, len(at) - 1)
            end = np.where((after == i + 2) & (word[after] == of), at[after], ends[of])
            a, b, c = (x - starts[of] for x in (at[i], at[i + 1], end))
            return a.astype(np.uint64) * U64(BEGIN) + b.astype(np.uint64) * U64(MIDDLE) + c.astype(np.uint64) * U64(END)

        def offer(i: np.ndarray) -> None:
            """Candidates of the symbols i with those after them."""
            i = i[i + 1 < len(at)]
            i = i[word[i] == word[i + 1]]
            found = self.find(symbol[i], symbol[i + 1])
            i, found = i[found >= 0], found[found >= 0]
            if limit:
                stays = ~skips(keys[word[i]] + place(i), limit)
                i, found = i[stays], found[stays]
            rank[i], merged[i] = self.rank[found], found

        offer(np.arange(len(symbol)))
        done, applied = [], []
        while len(symbol):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(rank, first)
            if (least == NEVER).any():
                over = np.repeat(least == NEVER, np.diff(np.append(first, len(symbol))))
                done.append((symbol[over], at[over], word[over]))
                rest = ~over
                symbol, at, word, rank, merged = (x[rest] for x in (symbol, at, word, rank, merged))
                if not len(symbol):
                    break
                first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
                least = least[least != NEVER]
            i = np.flatnonzero(rank == np.repeat(least, np.diff(np.append(first, len(symbol)))))
            i = i[np.concatenate([[True], word[i][1:] != word[i][:-1]])]
            applied.append((word[i], place(i)))
            symbol[i] = merged[i]
            keep = np.ones(len(symbol), bool)
            keep[i + 1] = False
            symbol, at, word, rank, merged = (x[keep] for x in (symbol, at, word, rank, merged))
            i = i - np.arange(len(i))  # one symbol less for each merge before
            before = i[i > 0] - 1
            near = np.concatenate([i, before[word[before] == word[before + 1]]])
            rank[near] = NEVER
            offer(near)
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        symbols, begins, of = (joined([d[k] for d in done], np.int32) for k in range(3))
        order = np.argsort(of, kind="stable")
        of_merge, adds = joined([a[0] for a in applied], np.int32), joined([a[1] for a in applied], np.uint64)
        return symbols[order], code[begins[order]].astype(np.int64), of[order], of_merge, adds


class PieceCodec:
    """A vocabulary with byte fallback, read from a SentencePiece BPE model."""

    def __init__(self, path: str, dropout: float, seed: int):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.score = {p: model.get_score(i) for i, p in enumerate(names) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        self.ids = {p: i for i, p in enumerate(names) if p in self.score}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.score):
            raise ValueError("a piece of this vocabulary crosses from a word into spaces")
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.ids_of_bytes = np.array(self.byte_ids, np.int64)
        self.spelled = [p.replace(SPACE, " ").encode() if p in self.score else b"" for p in names]
        for b, i in enumerate(self.byte_ids):
            self.spelled[i] = bytes([b])
        self.pieces = pa.array(self.spelled, pa.large_binary())
        self.limit, self.seed = int(dropout * 2**64), seed
        self.merges = Merges(self.score, self.ids)
        # Chunks with no merge skipped: their ids, the keys of the merges applied but for the place, as 64-bit numbers, and
        # their own key.
        self.young: dict[str, tuple[bytes, bytes, int]] = {}
        self.old: dict[str, tuple[bytes, bytes, int]] = {}

    def key(self, chunk: str) -> int:
        return (zlib.crc32(chunk.encode()) * KEY + (self.seed << 8) + 1) & MASK

    def segment(self, chunk: str, place: int, limit: int, applied: list[int] | None = None) -> list[str]:
        """Pieces of one chunk (spaces as written in the vocabulary) at a place (a hash of it), by an agenda; ``applied`` takes
        the keys of its merges, but for the place."""
        score, key = self.score, self.key(chunk)
        n = len(chunk)
        after = list(range(1, n + 1))  # where the symbol that begins here ends
        before = list(range(-1, n - 1))  # where the symbol before begins
        alive = [True] * n
        agenda: list[tuple[float, int, int, int]] = []

        def offer(a: int, b: int, c: int) -> None:
            s = score.get(chunk[a:c])
            if s is None:
                return
            if limit:
                h = (key + place + a * BEGIN + b * MIDDLE + c * END) & MASK
                h = ((h ^ h >> 32) * END) & MASK
                h = ((h ^ h >> 29) * BEGIN) & MASK
                if h ^ h >> 32 < limit:
                    return
            heapq.heappush(agenda, (-s, a, b, c))

        for a in range(n - 1):
            offer(a, a + 1, a + 2)
        while agenda:
            _, a, b, c = heapq.heappop(agenda)
            if not alive[a] or b >= n or not alive[b] or after[a] != b or after[b] != c:
                continue
            if applied is not None:
                applied.append((key + a * BEGIN + b * MIDDLE + c * END) & MASK)
            alive[b] = False
            after[a] = c
            if c < n:
                before[c] = a
                offer(a, c, after[c])
            if before[a] >= 0:
                offer(before[a], a, c)
        out, a = [], 0
        while a < n:
            out.append(chunk[a : after[a]])
            a = after[a]
        return out

    def _alone(self, chunk: str, place: int, limit: int) -> tuple[bytes, bytes]:
        """Ids and merges of a chunk that is long or holds a character that looks like the mark for spaces."""
        out, applied = array("I"), []
        for i, part in enumerate(chunk.split(SPACE)):
            if i:
                out.extend(self.byte_ids[b] for b in SPACE.encode())
            for piece in self.segment(part.replace(" ", SPACE), place, limit, applied):
                found = self.ids.get(piece)
                if found is None:
                    out.extend(self.byte_ids[b] for b in piece.encode())
                else:
                    out.append(found)
        return out.tobytes(), array("Q", applied).tobytes()

    def _spelled(self, symbols: np.ndarray, codes: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of symbols, characters without a piece in bytes, and the word of each."""
        ids = np.where(symbols >= 0, self.merges.piece[symbols], -1)
        none = ids < 0
        if not none.any():
            return ids, of
        n = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        times = np.where(none, n, 1)
        at = np.cumsum(times) - times
        out = np.empty(int(times.sum()), np.int64)
        out[at[~none]] = ids[~none]
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
        for j in range(4):
            which = none & (n > j)
            c, k = codes[which], n[which]
            part = c >> (6 * (k - 1 - j))
            out[at[which] + j] = self.ids_of_bytes[lead[k] | part if j == 0 else 0x80 | (part & 0x3F)]
        return out, np.repeat(of, times)

    def _together(self, chunks: list[str], own: list[int], places: np.ndarray, limit: int) -> list:
        """Ids of many chunks (``own``: their keys) at their places; without a limit their merges and keys too."""
        out: list = [None] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if len(c) <= LONG and SPACE not in c]
        if len(plain) < len(chunks):
            for i in set(range(len(chunks))).difference(plain):
                ids, merges = self._alone(chunks[i], int(places[i]), limit)
                out[i] = ids if limit else (ids, merges, own[i])
        for begin in range(0, len(plain), WORDS):
            part = plain[begin : begin + WORDS]
            words = [chunks[i] for i in part]
            keys = np.array([own[i] for i in part], np.uint64)
            text, sizes = "".join(words).replace(" ", SPACE), np.fromiter(map(len, words), np.int64, len(words))
            symbols, codes, of, of_merge, adds = self.merges.run(text, sizes, keys + places[part], limit)
            ids, of = self._spelled(symbols, codes, of)
            edges = np.append(0, 4 * np.cumsum(np.bincount(of, minlength=len(part)))).tolist()
            raw = ids.astype("<u4").tobytes()
            if limit:
                for i, a, b in zip(part, edges, edges[1:]):  # noqa: B905
                    out[i] = raw[a:b]
                continue
            order = np.argsort(of_merge, kind="stable")
            merges = (keys[of_merge] + adds)[order].tobytes()
            cuts = np.append(0, 8 * np.cumsum(np.bincount(of_merge, minlength=len(part)))).tolist()
            for i, a, b, c, d in zip(part, edges, edges[1:], cuts, cuts[1:]):  # noqa: B905
                out[i] = raw[a:b], merges[c:d], own[i]
        return out

    def _plain(self, chunks: list[str]) -> list[tuple[bytes, bytes, int]]:
        """What ``_together`` gives for each of these distinct chunks with nothing skipped; remembered, but for long ones."""
        young, old = self.young, self.old
        out, new = [young.get(c) for c in chunks], []
        for i, x in enumerate(out):
            if x is None:
                out[i] = x = old.get(chunks[i])
                if x is None:
                    new.append(i)
                else:
                    young[chunks[i]] = x
        words = [chunks[i] for i in new]
        own = [self.key(c.replace(" ", SPACE)) for c in words]
        for i, c, x in zip(new, words, self._together(words, own, np.zeros(len(new), np.uint64), 0), strict=True):
            out[i] = x
            if len(c) <= CACHE_CHARS:
                young[c] = x
        if len(young) > CACHE_ENTRIES:
            self.young, self.old = {}, young
        return out

    def encode(self, text: str | None, doc: int) -> bytes:
        return self.encode_many([text], [doc])[0]

    def encode_many(self, texts: Sequence[str | None], docs: Sequence[int]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; an empty text has none.

        The chunks of all texts are cut and told apart as arrays, so that each distinct one is looked up once.
        """
        raw, rows = text_bytes(pa.array([f" {t}" if t else "" for t in texts], pa.large_string()))
        if not len(raw):
            return [b""] * len(texts)
        first = raw == 32
        first[1:] &= raw[:-1] != 32
        first[rows[rows < len(raw)]] = True
        begin = np.flatnonzero(first)
        edges = np.append(begin, len(raw)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(edges), pa.py_buffer(raw)])
        coded = chunks.dictionary_encode()
        distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy().copy()
        known = self._plain(distinct)
        ids = [x[0] for x in known]
        rows = np.searchsorted(begin, rows)
        if self.limit:
            sizes = np.diff(rows)
            merged = pa.array([x[1] for x in known], pa.large_binary()).take(coded.indices)
            ends, data = np.frombuffer(merged.buffers()[1], "<i8", len(merged) + 1), merged.buffers()[2]
            merges = np.frombuffer(data, "<u8", ends[-1] >> 3) if ends[-1] else np.empty(0, np.uint64)
            bases = np.array([(doc * int(MIX_C) + self.seed) & MASK for doc in docs], np.uint64)
            inside = np.arange(len(begin)) - np.repeat(rows[:-1], sizes)
            place = mix64(inside.astype(np.uint64) * MIX_A + np.repeat(bases, sizes))
            of = np.repeat(np.arange(len(begin)), np.diff(ends) >> 3)
            again = np.unique(of[skips(place[of] + merges, self.limit)])
            words = which[again].tolist()
            ids += self._together([distinct[i] for i in words], [known[i][2] for i in words], place[again], self.limit)
            which[again] = len(distinct) + np.arange(len(again))
        found = pa.array(ids, pa.large_binary()).take(pa.array(which))
        cuts, data = np.frombuffer(found.buffers()[1], "<i8", len(found) + 1)[rows].tolist(), found.buffers()[2]
        whole = data.to_pybytes() if data else b""
        return [whole[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def spells(self, ids: Sequence[bytes], texts: Sequence[str | None]) -> list[bool]:
        """Whether the ids of each text decode to it."""
        cuts = np.append(0, np.cumsum([len(x) >> 2 for x in ids]))
        found = self.pieces.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        edges, data = np.frombuffer(found.buffers()[1], "<i8", len(found) + 1)[cuts].tolist(), found.buffers()[2]
        whole = data.to_pybytes() if data else b""
        # The first space is none of the text's.
        return [whole[a:b][1:] == (t or "").encode() for a, b, t in zip(edges[:-1], edges[1:], texts, strict=True)]

    def decode(self, ids: bytes) -> str:
        spelled = self.spelled
        return b"".join([spelled[i] for i in array("I", ids)])[1:].decode()


_CODECS: dict[tuple, PieceCodec] = {}


def codec(path: str, dropout: float, seed: int) -> PieceCodec:
    """One codec for each vocabulary and key in a Python worker."""
    key = (path, dropout, seed)
    if key not in _CODECS:
        _CODECS[key] = PieceCodec(path, dropout, seed)
    return _CODECS[key]


def encode_pieces(
    docs: DataFrame, *, model: str, dropout: float = 0.1, seed: int = 0, id: str = "doc_id", text: str = "text", keep_ids: bool = True
) -> DataFrame:
    """Per row: doc_id, n_pieces, ids_crc32, lossless (whether the ids decode to the text), and ``ids`` if kept.

    Null texts count as empty and have no pieces. A null id is keyed as 0; repeated rows get equal pieces. Other
    columns are ignored; an empty table gives no rows. With a dropout of 0 the pieces are the model's own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, dropout, seed)
        for batch in batches:
            for part in parts_of(batch, 1):
                docs_, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                ids = c.encode_many(texts, [d or 0 for d in docs_])
                columns = [
                    part.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array(c.spells(ids, texts), pa.bool_()),
                    *([pa.array(ids, pa.binary())] if keep_ids else []),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_pieces", "ids_crc32", "lossless", "ids"][: len(columns)])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, lossless boolean" + ", ids binary" * keep_ids)


def decode_pieces(encoded: DataFrame, *, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, 0.0, 0)
        for batch in batches:
            texts = [c.decode(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
