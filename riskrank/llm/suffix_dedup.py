"""Removal of passages that repeat across documents, by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``threshold`` tokens (bytes or words), by passes over digits from the most
significant on, and a group that holds one document is left after any pass:

1. The first digit of a window of ``threshold`` tokens is its anchor: the ``ANCHOR`` tokens in it with the
   smallest hash, the leftmost if tied. Equal windows have equal anchors at equal places, and neighbouring
   windows share theirs, so one row stands for a run of windows (a region). Rows are dealt by anchor and
   sorted by anchor, region and document: a region that a smaller document has too is settled as a whole.
2. The second digit is the anchor with the tokens before it, or with those after it. Every window holds
   one of the two, so regions that share neither with another region of their anchor go.
3. What is left is sorted through all ``threshold`` tokens: equal groups are the repeated windows.

Within a task, equal rows are summed up to that of the smallest document before they are shuffled, so a
passage that a third of all documents hold gives one row a task and not one a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskrank.llm.common import MIX_A, MIX_B, MIX_C, U64, Workspace, free_shuffles, mix64, parts_of, text_bytes

ANCHOR = 16
STEP = 1 << 20
FLUSH_ROWS = 2_000_000
# Start of a region, its length, the place of its anchor and two second digits (0: none) share one number.
LEN_BITS, DIGIT_BITS = 6, 8
SETTLED = np.int64(1 << 62)


class Tokens:
    """The tokens of a batch of texts end to end, as 16-token hashes on demand.

    ``bounds``: token offsets of the rows. For words, ``begin`` and ``end`` are their byte places.
    """

    def __init__(self, column: pa.Array, unit: str):
        self.data, self.offsets = text_bytes(column)
        self.unit = unit
        if unit == "byte":
            self.bounds = self.offsets
            return
        space = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        word = np.concatenate([[False], ~space, [False]])
        # Words never reach over the end of a row.
        cut = np.zeros(len(self.data) + 1, bool)
        cut[self.offsets] = True
        inside = word[1:-1]
        first = inside & (~word[:-2] | cut[:-1])
        last = inside & (~word[2:] | cut[1:])
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.begin, self.offsets)
        self.codes = self._codes()

    def _codes(self) -> np.ndarray:
        out = np.zeros(len(self.begin), np.uint64)
        step = 1 << 16
        for i in range(0, len(self.begin), step):
            begin, end = self.begin[i : i + step], self.end[i : i + step]
            size = end - begin
            at = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            place = (at - np.repeat(begin, size)).astype(np.uint64)
            out[i : i + step] = np.add.reduceat(
                mix64(self.data[at].astype(np.uint64) * MIX_A + place * MIX_C + U64(1)), np.cumsum(size) - size
            )
        return mix64(out)

    def hashes(self, lo: int, hi: int) -> np.ndarray:
        """Hashes of the 16 tokens from each of lo, ..., hi - 16 on."""
        if hi - lo < ANCHOR:
            return np.empty(0, np.uint64)
        if self.unit == "byte":
            raw = np.ascontiguousarray(self.data[lo:hi])
            h = mix64(np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,)) + MIX_A)
            reach = 8
        else:
            h, reach = self.codes[lo:hi], 1
        while reach < ANCHOR:
            h = mix64(h[:-reach] * MIX_A + h[reach:])
            reach *= 2
        return h


def span_hash(h: np.ndarray, at: np.ndarray, size: int, times: np.uint64) -> np.ndarray:
    """Hash of the ``size`` tokens from each place on (``size`` at least 16)."""
    out = h[at]
    for i in [*range(ANCHOR, size - ANCHOR, ANCHOR), size - ANCHOR]:
        out = mix64(out * times + h[at + i])
    return out


def regions(tokens: Tokens, threshold: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, region hash, row, start in its row, last - first window, anchor - start, left digit, right digit)."""
    bounds, width, side = tokens.bounds, threshold - ANCHOR + 1, side_of(threshold)
    low = U64((1 << 21) - 1)
    for lo in range(0, int(bounds[-1]), STEP):
        hi = min(lo + STEP, int(bounds[-1]))  # windows that start in [lo, hi)
        before = min(lo, side)
        h = tokens.hashes(lo - before, min(hi + threshold + side, int(bounds[-1])))
        own = h[before:]
        if len(own) < width:
            continue
        keys = (own & ~low) | np.arange(len(own), dtype=np.uint64)
        least, reach = keys, 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        least = (least & low).astype(np.int64)[: hi - lo]
        i, j = np.searchsorted(bounds, lo, "right") - 1, np.searchsorted(bounds, lo + len(least), "left")
        row = np.repeat(np.arange(i, j), np.diff(np.clip(bounds[i : j + 1], lo, lo + len(least))))
        ok = np.arange(lo, lo + len(least)) + threshold <= bounds[row + 1]
        turn = np.concatenate([[True], (least[1:] != least[:-1]) | (row[1:] != row[:-1])])
        first = np.flatnonzero(ok & (turn | np.concatenate([[True], ~ok[:-1]])))
        last = np.flatnonzero(ok & np.concatenate([turn[1:] | ~ok[1:], [True]]))
        anchor, own_row = least[first], row[first]
        region = span_hash(own, first, threshold, MIX_B) * MIX_A + span_hash(own, last, threshold, MIX_C)
        region = mix64(region + (last - first).astype(np.uint64))
        digits = []
        for begin in (anchor - side, anchor):
            full = (begin + lo >= bounds[own_row]) & (begin + lo + side + ANCHOR <= bounds[own_row + 1])
            at = begin[full] + before
            digit = np.zeros(len(first), np.int64)
            digit[full] = span_hash(h, at, side + ANCHOR, MIX_B) % U64((1 << DIGIT_BITS) - 1) + U64(1) if side else 1
            digits.append(digit)
        yield own[anchor], region, own_row, first + lo - bounds[own_row], last - first, anchor - first, *digits


def side_of(threshold: int) -> int:
    """Tokens beside the anchor in a second digit: every window holds those before it or those after it."""
    return (threshold - ANCHOR) // 2


def packed(start: np.ndarray, size: np.ndarray, anchor: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    place = (start << LEN_BITS | size) << LEN_BITS | anchor
    return (place << DIGIT_BITS | left) << DIGIT_BITS | right


def unpacked(place: np.ndarray) -> tuple[np.ndarray, ...]:
    digit, length = (1 << DIGIT_BITS) - 1, (1 << LEN_BITS) - 1
    place = place & ~SETTLED
    right, left, place = place & digit, place >> DIGIT_BITS & digit, place >> (2 * DIGIT_BITS)
    return place >> (2 * LEN_BITS), place >> LEN_BITS & length, place & length, left, right


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def combine(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, place: np.ndarray, spans) -> tuple[np.ndarray, ...]:
    """Settle what a smaller document of these rows has too; only the other rows stand for their key.

    ``spans`` gives start and last - first window of a place.
    """
    order = np.lexsort((doc, k2, k1))
    k1, k2, doc, place = k1[order], k2[order], doc[order], place[order]
    new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
    settled = doc > doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    start, size = spans(place[settled])
    owner = doc[settled]
    order = np.lexsort((start, owner))
    owner, start, size = owner[order], start[order], size[order]
    # Runs that follow on each other are one.
    turn = np.ones(len(owner), bool)
    turn[1:] = (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + size[:-1] + 1)
    first = np.flatnonzero(turn)
    owner, begin = owner[first], start[first]
    size = (np.maximum.reduceat(start + size, first) if len(first) else start) - begin
    # Settled runs are dealt by document and place instead of their key, which may be hot; the second key has their length.
    away = mix64(owner.view(np.uint64) * MIX_A + begin.view(np.uint64)).view(np.int64)
    rest = ~settled
    pairs = ((k1[rest], away), (k2[rest], size), (doc[rest], owner), (place[rest], begin | SETTLED))
    return tuple(np.concatenate(x) for x in pairs)


def first_pass(docs: DataFrame, unit: str, threshold: int) -> DataFrame:
    """(k1: anchor, k2: region, doc, place) of all regions."""
    names = ["k1", "k2", "doc", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for part in (p for batch in batches for p in parts_of(batch, 1)):
            tokens, ids = Tokens(part.column(1), unit), part.column(0).to_numpy()
            for anchor, region, row, start, size, inner, left, right in regions(tokens, threshold):
                held.append((anchor.view(np.int64), region.view(np.int64), ids[row], packed(start, size, inner, left, right)))
                rows += len(row)
                if rows > FLUSH_ROWS:
                    yield _batch(names, *combine(*map(np.concatenate, zip(*held, strict=True)), lambda p: unpacked(p)[:2]))
                    held, rows = [], 0
        if rows:
            yield _batch(names, *combine(*map(np.concatenate, zip(*held, strict=True)), lambda p: unpacked(p)[:2]))

    return docs.mapInArrow(run, "k1 long, k2 long, doc long, place long")


def settle(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray, place: np.ndarray, head: tuple | None, whole: bool, threshold: int):
    """Rows (sorted) of full groups of an anchor, or of a part of a very large one: (doc, start, len, open).

    ``head`` is (anchor, region, smallest document) of the part before. Without the whole group, the
    second digit cannot rule anything out, and all that is not settled stays open. With it, the windows
    that hold a shared second digit stay open.
    """
    new1 = np.concatenate([[True], k1[1:] != k1[:-1]])
    new2 = new1 | np.concatenate([[True], k2[1:] != k2[:-1]])
    least = doc[np.flatnonzero(new2)][np.cumsum(new2) - 1]
    if head and (k1[0], k2[0]) == head[:2]:
        least[np.cumsum(new2) == 1] = head[2]
    done = doc > least
    start, size, inner, left, right = unpacked(place)
    open_ = ~done
    if whole and not head:
        group = np.cumsum(new1) - 1
        at = np.flatnonzero(new1)
        many = (np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)) & (np.add.reduceat(new2.astype(np.int64), at) > 1)
        shared = []
        region = np.cumsum(new2) - 1
        stands = np.flatnonzero(new2)
        for digit in (left, right):
            key = group[stands] << DIGIT_BITS | digit[stands]
            _, which, n = np.unique(key, return_inverse=True, return_counts=True)
            shared.append(((n[which] > 1) & (digit[stands] > 0))[region])
        side = side_of(threshold)
        # Windows 0, ..., size of a region: the first ones hold the left digit, the last ones the right digit.
        begin = np.where(open_ & ~shared[0], np.maximum(0, inner - (threshold - ANCHOR - side)), 0)
        end = np.where(open_ & ~shared[1], np.minimum(size, inner - side), size)
        start, size = start + begin, end - begin
        open_ &= many[group] & (shared[0] | shared[1]) & (size >= 0)
    last = (k1[-1], k2[-1], least[-1])
    rows = done | open_
    return (doc[rows], start[rows], size[rows], open_[rows]), last


def second_pass(rows: DataFrame, threshold: int) -> DataFrame:
    """(doc, start, len, open) from the rows of the first pass, sorted by anchor, region and document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, head = ["doc", "start", "len", "open"], None, None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(4)]
            away = (columns[3] & SETTLED) != 0
            if away.any():
                yield _batch(names, columns[2][away], columns[3][away] & ~SETTLED, columns[1][away], np.zeros(away.sum(), bool))
                columns = [c[~away] for c in columns]
            if not len(columns[0]):
                continue
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))  # the last anchor may go on
            if cut:
                out, _ = settle(*(c[:cut] for c in columns), head, True, threshold)
                yield _batch(names, *out)
                head = None
            held = [c[cut:] for c in columns]
            if len(held[0]) > FLUSH_ROWS:
                out, head = settle(*held, head, False, threshold)
                yield _batch(names, *out)
                held = None
        if held is not None:
            yield _batch(names, *settle(*held, head, True, threshold)[0])

    ordered = rows.repartition(_parts(rows), "k1").sortWithinPartitions("k1", "k2", "doc", "place")
    return ordered.mapInArrow(run, "doc long, start long, len long, open boolean")


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _with_spans(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    grouped = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "len")).alias("spans"))
    return docs.join(grouped, F.col("id") == F.col("doc"), how)


def _span_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the rows, starts and lengths of a column of lists of (start, len) (null: no span)."""
    sizes = np.array([0 if x is None else x for x in pa.compute.list_value_length(column).to_pylist()], np.int64)
    flat = column.flatten()
    start, size = (np.asarray(flat.field(i).to_numpy(zero_copy_only=False), np.int64) for i in range(2))
    return np.concatenate([[0], np.cumsum(sizes)]), start, size


def third_pass(docs: DataFrame, open_: DataFrame, unit: str, threshold: int) -> DataFrame:
    """(doc, start, len): single windows of the open regions that a smaller document has too."""
    names = ["k1", "k2", "doc", "place"]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, (at, start, size) = batch.column(0).to_numpy(), _span_arrays(batch.column(2))
            held, rows = [], 0
            for i in range(len(batch)):
                tokens = Tokens(batch.column(1).slice(i, 1), unit)
                h = tokens.hashes(0, int(tokens.bounds[-1]))
                begin, extra = start[at[i] : at[i + 1]], size[at[i] : at[i + 1]] + 1
                where = np.repeat(begin - (np.cumsum(extra) - extra), extra) + np.arange(extra.sum())
                where = np.unique(where[where + threshold <= tokens.bounds[-1]])
                if not len(where):
                    continue
                k1, k2 = (span_hash(h, where, threshold, m).view(np.int64) for m in (MIX_B, MIX_C))
                held.append((k1, k2, np.full(len(where), ids[i]), where.astype(np.int64)))
                rows += len(where)
                if rows > FLUSH_ROWS:
                    yield _batch(names, *combine(*map(np.concatenate, zip(*held, strict=True)), lambda p: (p, np.zeros_like(p))))
                    held, rows = [], 0
            if rows:
                yield _batch(names, *combine(*map(np.concatenate, zip(*held, strict=True)), lambda p: (p, np.zeros_like(p))))

    def equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            k1, k2, doc, place = (batch.column(i).to_numpy() for i in range(4))
            away = (place & SETTLED) != 0
            found = [(doc[away], place[away] & ~SETTLED, k2[away])]
            k1, k2, doc, place = (c[~away] for c in (k1, k2, doc, place))
            if len(k1):
                new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
                least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
                if head and (k1[0], k2[0]) == head[:2]:
                    least[np.cumsum(new) == 1] = head[2]
                head = (k1[-1], k2[-1], least[-1])
                more = doc > least
                found.append((doc[more], place[more], np.zeros(int(more.sum()), np.int64)))
            yield _batch(["doc", "start", "len"], *(np.concatenate(x) for x in zip(*found, strict=True)))

    rows = _with_spans(docs, open_, "inner").select("id", "text", "spans").mapInArrow(
        windows, "k1 long, k2 long, doc long, place long"
    )
    ordered = rows.repartition(_parts(rows), "k1").sortWithinPartitions("k1", "k2", "doc")
    return ordered.mapInArrow(equal, "doc long, start long, len long")


def repeated_spans(docs: DataFrame, ws: Workspace, *, unit: str, threshold: int) -> DataFrame:
    """(doc, start, len): windows start, ..., start + len of a document that also start in a smaller one.

    ``docs``: (id long, not null; text).
    """
    if unit not in ("byte", "word") or not ANCHOR + 2 <= threshold < ANCHOR + (1 << LEN_BITS):
        raise ValueError("unit must be byte or word, and threshold 18 to 79")
    spark = docs.sparkSession
    found = ws.keep(second_pass(first_pass(docs, unit, threshold), threshold), "regions")
    free_shuffles(spark)
    whole = found.where("not open").select("doc", "start", "len")
    single = ws.keep(third_pass(docs, found.where("open"), unit, threshold), "windows")
    free_shuffles(spark)
    return whole.unionByName(single)


def remove_repeats(
    docs: DataFrame,
    ws: Workspace,
    *,
    unit: str = "byte",
    threshold: int = 50,
    id: str = "doc_id",
    text: str = "text",
    keep_content: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Remove from every document what is covered by ``threshold`` tokens that also start in a smaller one.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs of bytes), kept_sha256, and, if asked
    for, ``spans`` (begin, end in bytes) and ``kept`` (the bytes that stay), and the columns named in ``carry``
    as the struct ``carried``. Windows are judged on the input
    and never cross documents. With words, a run reaches from its first to its last word.

    A null text counts as empty. Rows with a null id are returned whole and remove nothing. An id stands for one text:
    rows that repeat it are never held against each other. Other columns are ignored; an empty table gives
    no rows. Texts of any length are judged whole.
    """
    rows = docs.select(
        F.col(id).cast("long").alias("id"), F.col(text).alias("text"), *([F.struct(*carry).alias("carried")] if carry else [])
    )
    spans = repeated_spans(rows.where("id is not null").select("id", "text"), ws, unit=unit, threshold=threshold)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in parts_of(whole, 1)):
            tokens, (at, start, size) = Tokens(batch.column(1), unit), _span_arrays(batch.column(2))
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for i in range(len(batch)):
                a, b = tokens.bounds[i], tokens.bounds[i + 1]
                body = tokens.data[tokens.offsets[i] : tokens.offsets[i + 1]]
                begin, end = start[at[i] : at[i + 1]], start[at[i] : at[i + 1]] + size[at[i] : at[i + 1]] + threshold
                fits = end <= b - a
                begin, end = begin[fits], end[fits]
                if unit == "word" and len(begin):
                    begin, end = (x - tokens.offsets[i] for x in (tokens.begin[a + begin], tokens.end[a + end - 1]))
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], np.maximum.accumulate(end[order]) if len(end) else end
                new = np.concatenate([[True], begin[1:] > end[:-1]]) if len(begin) else np.empty(0, bool)
                first = np.flatnonzero(new)
                begin, end = begin[first], end[np.append(first[1:], len(end)) - 1] if len(first) else end
                kept, done = [], 0
                for x, y in zip(begin.tolist(), end.tolist(), strict=True):
                    kept.append(body[done:x].tobytes())
                    done = y
                kept = b"".join([*kept, body[done:].tobytes()])
                spans_ = [{"begin": x, "end": y} for x, y in zip(begin.tolist(), end.tolist(), strict=True)]
                values = (len(body), len(body) - len(kept), len(begin), hashlib.sha256(kept).hexdigest(), spans_, kept)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
            columns = [batch.column(0), *(pa.array(c, t) for c, t in zip(out, types, strict=True))]
            n = 7 if keep_content else 5
            carried = [batch.column(3)] if carry else []
            yield pa.RecordBatch.from_arrays([*columns[:n], *carried], names=[*names[:n], *["carried"][: len(carried)]])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if keep_content:
        schema += ", spans array<struct<begin: long, end: long>>, kept binary"
    joined = _with_spans(rows, spans, "left").select("id", "text", "spans", *(["carried"] if carry else []))
    out = StructType.fromDDL(schema)
    return joined.mapInArrow(cut, out.add("carried", joined.schema["carried"].dataType) if carry else out)
