"""Token ids in binary files, compressed with a static range asymmetric numeral system.

One table of symbol frequencies, counted over the whole corpus, serves all files. A file holds documents
in ascending id order: their ids are cut into blocks that decode on their own, each coded by ``LANES``
interleaved states so that whole vectors of symbols are coded at once. The index of blocks (first id,
place, states, checksum) gives the checkpoints from which readers start in parallel.

File: ``MAGIC``, then blocks, then the index (zlib-compressed arrays), then its length and checksum.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace, encoder

MAGIC = b"RANSTOK1"
LANES = 2048
BLOCK = 1 << 19
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
FILE_TOKENS = 4_000_000

MANIFEST = "file string, first_doc long, n_docs long, n_tokens long, part int, number int"


class Table:
    """Symbol frequencies scaled to ``2 ** SCALE_BITS``, every symbol that occurs with one at least."""

    def __init__(self, counts: np.ndarray):
        total = 1 << SCALE_BITS
        freq = np.zeros(len(counts), np.int64)
        if counts.sum():
            seen = counts > 0
            freq[seen] = np.maximum(1, counts[seen] * (total - int(seen.sum())) // counts.sum())
            freq[np.argmax(freq)] += total - freq.sum()
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)]).astype(np.uint64)
        self._symbol: np.ndarray | None = None

    def symbol(self) -> np.ndarray:
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """States, then the words that the lanes put out, in the order in which a reader takes them."""
    rows = -(-len(ids) // LANES)
    state = np.full(LANES, LOW, np.uint64)
    words: list[np.ndarray] = []
    limit_shift = np.uint64(63 - SCALE_BITS)
    for r in range(rows - 1, -1, -1):
        symbols = ids[r * LANES : (r + 1) * LANES]
        x = state[: len(symbols)]
        freq = table.freq[symbols]
        full = x >= (freq << limit_shift)
        if full.any():
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> np.uint64(32), x)
        times = x // freq
        state[: len(symbols)] = (times << np.uint64(SCALE_BITS)) + (x - times * freq) + table.start[symbols]
    return state.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))


def decode_block(data: bytes, n: int, table: Table) -> np.ndarray:
    state = np.frombuffer(data, "<u8", LANES).copy()
    words = np.frombuffer(data, "<u4", offset=8 * LANES).astype(np.uint64)
    out, at, symbol = np.empty(n, np.uint32), 0, table.symbol()
    mask = np.uint64((1 << SCALE_BITS) - 1)
    for begin in range(0, n, LANES):
        x = state[: min(LANES, n - begin)]
        slot = x & mask
        found = symbol[slot]
        out[begin : begin + len(x)] = found
        x = table.freq[found] * (x >> np.uint64(SCALE_BITS)) + slot - table.start[found]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << np.uint64(32)) | words[at : at + len(low)]
        at += len(low)
        state[: len(x)] = x
    return out


def write_file(stream, docs: np.ndarray, sizes: np.ndarray, known: np.ndarray, ids: np.ndarray, table: Table) -> None:
    """docs: ids of the documents (``known`` false: null), sizes: how many tokens each has."""
    stream.write(MAGIC)
    at, places, sums = len(MAGIC), [], []
    for begin in range(0, len(ids), BLOCK):
        part = ids[begin : begin + BLOCK]
        data = encode_block(part, table)
        stream.write(data)
        places.append((begin, len(part), at, len(data)))
        sums.append((zlib.crc32(data), zlib.crc32(part.astype("<u4").tobytes())))
        at += len(data)
    held = io.BytesIO()
    np.savez(
        held,
        docs=docs.astype("<i8"),
        known=known,
        sizes=sizes.astype("<i8"),
        places=np.array(places, "<i8").reshape(-1, 4),
        sums=np.array(sums, "<i8").reshape(-1, 2),
    )
    index = zlib.compress(held.getvalue(), 6)
    stream.write(index)
    stream.write(struct.pack("<QI", len(index), zlib.crc32(index)))


def read_index(data: bytes) -> dict[str, np.ndarray]:
    size, crc = struct.unpack("<QI", data[-12:])
    index = data[-12 - size : -12]
    if data[: len(MAGIC)] != MAGIC or zlib.crc32(index) != crc:
        raise ValueError("not a token file, or its index is damaged")
    with np.load(io.BytesIO(zlib.decompress(index))) as held:
        return {k: held[k] for k in held.files}


def read_tokens(data: bytes, index: dict[str, np.ndarray], table: Table, start: int = 0, n: int | None = None) -> np.ndarray:
    """Tokens [start, start + n) of a file; only the blocks that hold them are decoded and checked."""
    end = int(index["sizes"].sum()) if n is None else start + n
    parts = []
    for (begin, count, at, size), (crc, crc_ids) in zip(index["places"], index["sums"], strict=True):
        if begin >= end or begin + count <= start:
            continue
        block = data[at : at + size]
        if zlib.crc32(block) != crc:
            raise ValueError(f"block at token {begin} is damaged")
        ids = decode_block(block, int(count), table)
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc_ids:
            raise ValueError(f"block at token {begin} does not decode to what was written")
        parts.append(ids[max(0, start - begin) : end - begin])
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


# Pieces that a task remembers, in two generations: some 100 bytes each.
CACHE_ENTRIES = 600_000


def id_type(vocabulary: int) -> str:
    """How ids are kept between the steps: two bytes each where the vocabulary allows it, else four."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def tokenize(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int, id: str, text: str) -> DataFrame:
    kind = id_type(vocabulary)
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer, CACHE_ENTRIES).encode_column, np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            step = 256  # rows held at once
            for i in range(0, len(batch), step):
                part = batch.slice(i, step)
                wide = [np.frombuffer(ids + end, "<u4") for ids in encode(part.column(1))]
                if max(int(x.max()) for x in wide) >= vocabulary:
                    raise ValueError(f"an id is beyond the vocabulary of {vocabulary}")
                ids = [x.astype(kind).tobytes() for x in wide]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // width for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"],
                )

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def symbol_counts(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of every id: one row an id and task is shuffled, one an id collected."""
    kind = id_type(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_buffer(), kind), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    rows = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for r in rows.toLocalIterator():
        counts[r.id] = r.n
    return counts


def write_token_files(
    docs: DataFrame,
    ws: Workspace,
    *,
    tokenizer: str,
    vocabulary: int,
    end_id: int = 1,
    id: str = "doc_id",
    text: str = "text",
    file_tokens: int = FILE_TOKENS,
) -> tuple[DataFrame, np.ndarray]:
    """Write the corpus and return the manifest (one row a file, in order by part and number) and the counts.

    Documents are tokenized once into a written table, then range-partitioned by id; each task writes its
    range as files of about ``file_tokens``. A task that runs again writes new files; only those that the
    manifest names are read. Null texts count as empty, null ids come first, repeated rows are all written.
    """
    spark = docs.sparkSession
    tokens = ws.keep(tokenize(docs, tokenizer, vocabulary, end_id, id, text), "tokens")
    counts = symbol_counts(tokens, vocabulary)
    table = spark.sparkContext.broadcast(counts)  # one number for each id of the vocabulary
    folder = ws.path("token_files")
    kind = id_type(vocabulary)
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fs, at = _open(folder)
        fs.create_dir(at, recursive=True)
        shared, part, made = Table(table.value), TaskContext.get().partitionId(), 0

        def written(rows: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(x for _, x in rows), kind).astype("<u4")
            name = f"part-{part:06d}-{made:05d}-{uuid.uuid4().hex}.rans"
            with fs.open_output_stream(f"{at}/{name}") as stream:
                write_file(
                    stream,
                    np.array([d or 0 for d, _ in rows], np.int64),
                    np.array([len(x) // width for _, x in rows], np.int64),
                    np.array([d is not None for d, _ in rows], bool),
                    ids,
                    shared,
                )
            values = ([f"{folder}/{name}"], [rows[0][0]], [len(rows)], [len(ids)], [part], [made])
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            names = ["file", "first_doc", "n_docs", "n_tokens", "part", "number"]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)

        rows, held = [], 0
        for batch in batches:
            for doc, ids in zip(batch.column(0), batch.column(1), strict=True):
                rows.append((doc.as_py(), ids.as_py()))
                held += len(rows[-1][1]) // width
                if held >= file_tokens:
                    yield written(rows)
                    rows, held, made = [], 0, made + 1
        if rows:
            yield written(rows)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.select("doc_id", "ids").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    return ws.keep(ordered.mapInArrow(run, MANIFEST), "manifest"), counts


def read_token_files(manifest: DataFrame, counts: np.ndarray, *, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (and ids if asked for)."""
    table = manifest.sparkSession.sparkContext.broadcast(counts)
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    # One row a file of millions of tokens: the running total over them is small.
    files = manifest.select("file", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("before"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shared = Table(table.value)
        for frame in frames:
            for file, before in zip(frame.file, frame.before, strict=True):
                fs, at = _open(file)
                with fs.open_input_file(at) as stream:
                    data = stream.read()
                index = read_index(data)
                ids = read_tokens(data, index, shared).astype("<u4")
                ends = np.cumsum(index["sizes"])
                starts = ends - index["sizes"]
                out = pd.DataFrame({"doc_id": pd.array(index["docs"], "Int64"), "start": starts + before})
                out.loc[~index["known"], "doc_id"] = pd.NA
                out["n_tokens"] = index["sizes"]
                parts = [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                out["ids_crc32"] = [zlib.crc32(x) for x in parts]
                if with_ids:
                    out["ids"] = parts
                yield out

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return files.repartition(reading_tasks(manifest.sparkSession), "file").mapInPandas(run, schema)


def reading_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
