"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance 2 r share a point at distance r from both. So every distinct fingerprint
emits all variants within half the radius, the variants are shuffled, and fingerprints that meet at one are
verified. Equal fingerprints are one class before anything is emitted, so a group of copies costs one row,
and a variant is met by a bounded number of classes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskrank.llm.common import PART, Workspace, connected_components, text_bytes

SEED = 42
WHITE = re.compile(rb"[ \t-\r]")


def words_of(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between white space (space and \\t to \\r)."""
    return data.lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words; of the whole sequence if there are fewer; none without words."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= size:
        runs = [b" ".join(words)]
    else:
        runs = [b" ".join(w) for w in zip(*[words[i:] for i in range(size)], strict=False)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(r, SEED) for r in runs), np.uint64, len(runs))


def bits_set(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, the highest first."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return ones


def simhash(data: bytes, size: int) -> int:
    """The bits that are set in over half of the shingles' hashes, as a signed 64-bit number; 0 without words.

    A long text is taken in parts of about ``PART`` bytes; the last words of a part begin the shingles of the next.
    """
    ones, n, carried, at = np.zeros(64, np.int64), 0, [], 0
    while True:
        gap = WHITE.search(data, at + PART) if len(data) - at > PART else None
        stop = gap.start() if gap else len(data)
        words = carried + words_of(data[at:stop])
        # Fewer words than a shingle has are a shingle only if the text has no more.
        if len(words) >= size or (stop == len(data) and not n):
            hashes = shingle_hashes(words, size)
            ones, n = ones + bits_set(hashes), n + len(hashes)
        if stop == len(data):
            return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)
        carried, at = words[len(words) - size + 1 :] if len(words) >= size else words, stop


def fingerprints(docs: DataFrame, *, id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): the SimHash over all runs of ``words`` words, repeats included, of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            raw = data.tobytes()
            fps = [simhash(raw[a:b], words) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            columns = [batch.column(0), batch.column(2), pa.array(fps, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"), text_hash(text).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def text_hash(text: str) -> Column:
    """What tells texts under one id apart; null and empty texts are the same."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def masks(bits: int, radius: int) -> list[int]:
    """All changes of up to ``radius`` of ``bits`` bits, as signed 64-bit numbers."""
    out = []
    for n in range(radius + 1):
        for places in combinations(range(bits), n):
            m = sum(1 << p for p in places)
            out.append(m - (1 << 64) if m >> 63 else m)
    return out


def ball_pairs(fps: DataFrame, *, radius: int = 2) -> DataFrame:
    """Pairs (a, b) of distinct ``fp`` at distance ``radius`` or less, enough to connect all such pairs.

    ``fps`` holds distinct fp. Classes that meet at a variant are linked in order, each to the next one there: all
    of them are within the ball, so within ``radius`` of each other when it is even.
    """
    near = [F.col("fp").bitwiseXOR(F.lit(m)) for m in masks(64, radius // 2)]
    variants = fps.select("fp", F.explode(F.array(*near)).alias("variant"))
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    pairs = variants.select(before.alias("a"), F.col("fp").alias("b")).where("a is not null").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _classes(fps: DataFrame, ws: Workspace, radius: int) -> DataFrame:
    """Per distinct fp: head (smallest doc_id), least (smallest id and text, null ids last), component (smallest fp reachable)."""
    if radius % 2:
        raise ValueError("radius must be even")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = ws.keep(fps.groupBy("fp").agg(F.min("doc_id").alias("head"), F.min(order).alias("least")), "classes")
    linked = connected_components(ball_pairs(classes.select("fp"), radius=radius), ws).withColumnRenamed("node", "fp")
    return classes.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(
    docs: DataFrame, ws: Workspace, *, id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable).

    Fingerprints are linked at ``radius`` (even) or fewer differing bits. Null and empty texts have the
    fingerprint zero and are linked like any other; a repeated row is returned as often; a row with a null id
    is returned and links others, but never names a component (null if no id is reachable). Other columns
    are ignored; an empty table gives no rows.
    """
    fps = ws.keep(fingerprints(docs, id=id, text=text, words=words), "fingerprints")
    roots = _classes(fps, ws, radius)
    smallest = roots.groupBy("component").agg(F.min("head").alias("component_id"))
    by_class = roots.join(smallest, "component").select("fp", "component_id")
    return fps.join(by_class, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(
    docs: DataFrame, ws: Workspace, *, id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 2
) -> DataFrame:
    """(doc_id, text_hash) of the document of each group of ``near_duplicates`` that stays: the smallest, null ids last.

    A document is an id and a text, so another text under the same id is judged on its own.
    """
    fps = ws.keep(fingerprints(docs, id=id, text=text, words=words), "fingerprints")
    least = _classes(fps, ws, radius).groupBy("component").agg(F.min("least").alias("m"))
    return least.select("m.doc_id", "m.text_hash")
