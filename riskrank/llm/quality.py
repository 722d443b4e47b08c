"""Document quality: a classifier's evidence, combined with what its site's other documents say.

Logistic models (one for low quality, one for toxic text) over what the words say (each hashed word's own shrunk rate)
and marks of style are fitted on a bounded sample of labelled rows. Then hierarchical empirical Bayes: each host's rate of bad documents is
a beta posterior that shrinks to the global rate, each path's one that shrinks to its host's, with strengths
estimated from how much the rates of sites differ; the logit of a document is moved by how its site's
rate differs from the global one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.llm.common import MIX_A, MIX_C, U64, Workspace, mix64, parts_of, text_bytes
from riskrank.llm.simhash import text_hash

WORD_BITS = 16
WORD_PRIOR = 5.0
STRONG = 1.5
MARKS = 14
SAMPLE_ROWS = 20_000
# A site may move a document's logit by so much at most.
MOST_SHIFT = 2.0


class Features:
    """Hashed words (each once a document) and style numbers of a batch of texts."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        n = len(column)
        low = np.where((data >= 65) & (data <= 90), data + 32, data)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        # Words are runs of letters (ASCII or any byte of a longer character).
        letter = ((low >= 97) & (low <= 122)) | (data >= 128)
        row = np.repeat(np.arange(n), np.diff(offsets))
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        first = letter & (np.concatenate([[True], ~letter[:-1]]) | cut[:-1])[: len(data)]
        last = letter & (np.concatenate([~letter[1:], [True]]) | cut[1:])[: len(data)]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        size = end - begin
        codes = np.zeros(len(begin), np.uint64)
        step = 1 << 16
        for i in range(0, len(begin), step):
            s, b = size[i : i + step], begin[i : i + step]
            ends = np.cumsum(s)
            at = np.repeat(b - (ends - s), s) + np.arange(ends[-1])
            place = (at - np.repeat(b, s)).astype(np.uint64)
            codes[i : i + step] = np.add.reduceat(mix64(low[at].astype(np.uint64) * MIX_A + place * MIX_C + U64(1)), ends - s)
        word_row = row[begin]
        slot = (mix64(codes) >> U64(64 - WORD_BITS)).astype(np.int64)
        pairs, times = np.unique(word_row << WORD_BITS | slot, return_counts=True)
        self.n, self.row, self.slot = n, pairs >> WORD_BITS, pairs & ((1 << WORD_BITS) - 1)

        def count(mask: np.ndarray) -> np.ndarray:
            return np.bincount(row[mask], minlength=n).astype(float)

        words = np.bincount(word_row, minlength=n).astype(float)
        distinct = np.bincount(self.row, minlength=n).astype(float)
        most = np.zeros(n)
        np.maximum.at(most, self.row, times)
        filled, letters = count(~space), count(letter)
        repeated = (codes[1:] == codes[:-1]) & (word_row[1:] == word_row[:-1])
        runs = np.bincount(word_row[1:][repeated], minlength=n).astype(float)
        share = lambda a, b: a / np.maximum(b, 1)
        self.style = np.stack(
            [
                np.log1p(words) / 8,
                share(count((data >= 65) & (data <= 90)), letters),
                share(count((data >= 48) & (data <= 57)), filled),
                share(filled - letters, filled),
                share(count(data == 33), words),
                share(count(data == 124), words),
                share(letters, words) / 8,
                share(distinct, words),
                share(most, words),
                share(runs, words),
            ],
            axis=1,
        )
        self.distinct = distinct

    def marks(self, shift: np.ndarray) -> np.ndarray:
        """What the distinct words say (``shift``: a number for each of ``row``), and the style."""
        begin = np.searchsorted(self.row, np.arange(self.n))
        filled = self.distinct > 0
        most = np.zeros(self.n)
        if len(shift):
            most[filled] = np.maximum.reduceat(shift, begin[filled])
        strong = np.bincount(self.row, np.where(shift > STRONG, shift, 0), minlength=self.n)
        mean = np.bincount(self.row, shift, minlength=self.n) / np.maximum(self.distinct, 1)
        return np.concatenate([np.stack([most, np.log1p(strong), mean], axis=1), self.style, np.ones((self.n, 1))], axis=1)


def word_shifts(bad: np.ndarray, seen: np.ndarray, rate: float) -> np.ndarray:
    """Logit of a word's rate of bad documents, shrunk to the base rate by ``WORD_PRIOR`` documents, against the base."""
    p = (bad + WORD_PRIOR * rate) / (seen + WORD_PRIOR)
    return np.log(p / (1 - p)) - np.log(rate / (1 - rate))


def fit_logistic(marks: np.ndarray, labels: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Weights of the marks by Newton steps with a small ridge (not on the constant, the last)."""
    w = np.zeros(marks.shape[1])
    hold = np.full(len(w), ridge)
    hold[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(marks @ w, -30, 30)))
        slope = marks.T @ (p - labels) + hold * w
        curve = (marks * (p * (1 - p))[:, None]).T @ marks + np.diag(hold)
        change = np.linalg.solve(curve, slope)
        w -= change
        if np.abs(change).max() < 1e-8:
            break
    return w


@dataclass
class QualityModel:
    """For the two heads (low quality, toxic): a shift for each word slot, and the weights of the marks."""

    shifts: np.ndarray
    weights: np.ndarray
    rows: int


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    toxic: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> QualityModel:
    """Fit both heads on ``sample_rows`` labelled rows at most, chosen by a hash of the id.

    Labels that are null, or of documents that are not there, are left out. Without any, no document has evidence.
    """
    marked = labels.select(F.col(id).cast("long").alias("doc_id"), F.col(quality).cast("int").alias("quality"), F.col(toxic).cast("int").alias("toxic"))
    # The smallest hashes: a bounded result, however many labels there are.
    chosen = marked.dropna().dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    source = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined = source.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality", "toxic")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 1):
                f = Features(part.column(1))
                at = np.searchsorted(f.row, np.arange(f.n + 1))
                words = [f.slot[a:b].astype("<u2").tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                style = [x.astype("<f8").tobytes() for x in f.style]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words, pa.binary()), pa.array(style, pa.binary()), part.column(2), part.column(3)],
                    names=["doc_id", "words", "style", "quality", "toxic"],
                )

    def fit(_: object, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "words"])
        sizes = (frame.words.str.len() // 2).to_numpy()
        slot = np.frombuffer(b"".join(frame.words), "<u2").astype(np.int64)
        row = np.repeat(np.arange(len(frame)), sizes)
        f = Features.__new__(Features)
        f.n, f.row, f.slot, f.distinct = len(frame), row, slot, sizes.astype(float)
        f.style = np.stack([np.frombuffer(x, "<f8") for x in frame["style"]])
        shifts, weights = [], []
        for label in (frame.quality <= 0, frame.toxic > 0):
            y = label.to_numpy().astype(float)
            rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
            bad, seen = (np.bincount(slot, v, minlength=1 << WORD_BITS) for v in (y[row], np.ones(len(row))))
            # A document's own label does not count in what its words say about it.
            own = word_shifts(bad[slot] - y[row], seen[slot] - 1, rate)
            weights.append(fit_logistic(f.marks(own), y))
            shifts.append(word_shifts(bad, seen, rate))
        values = {"rows": len(frame), "shifts": np.stack(shifts).astype("<f8").tobytes(), "weights": np.stack(weights).astype("<f8").tobytes()}
        return pd.DataFrame({k: [v] for k, v in values.items()})

    rows = joined.mapInArrow(features, "doc_id long, words binary, style binary, quality int, toxic int")
    # One task fits the bounded sample.
    rows = rows.withColumn("sample", F.lit(0))
    out = rows.groupBy("sample").applyInPandas(fit, "rows long, shifts binary, weights binary").first()
    if out is None:
        return QualityModel(np.zeros((2, 1 << WORD_BITS)), np.zeros((2, MARKS)), 0)
    return QualityModel(*(np.frombuffer(x, "<f8").reshape(2, -1) for x in (out.shifts, out.weights)), out.rows)


def evidence(docs: DataFrame, model: QualityModel, *, id: str, text: str, host: Column, path: Column) -> DataFrame:
    """(doc_id, text_hash, host, path, low, toxic): logits of both heads for every whole text."""
    held = docs.sparkSession.sparkContext.broadcast((model.shifts, model.weights))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts_of(batch, 4):
                f = Features(part.column(4))
                low, toxic = (pa.array(f.marks(s[f.slot]) @ w) for s, w in zip(*held.value, strict=True))
                names = ["doc_id", "text_hash", "host", "path", "low", "toxic"]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], low, toxic], names=names)

    rows = docs.select(
        F.col(id).cast("long").alias("doc_id"), text_hash(text).alias("text_hash"), host.alias("host"), path.alias("path"), F.col(text).alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, text_hash long, host string, path string, low double, toxic double")


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def logit(p: Column) -> Column:
    q = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(q / (1 - q))


def strength(groups: DataFrame, rate: str, n: str, parent: str) -> float:
    """How many documents the parent's rate counts for, from the spread of the groups' rates around it.

    By moments: the spread beyond what sampling explains is the variance of a beta with that strength.
    """
    p, m = F.col(rate), F.col(parent)
    row = (
        groups.where(F.col(n) > 1)
        .agg(
            F.sum(F.col(n) * (p - m) ** 2).alias("spread"),
            F.sum(m * (1 - m)).alias("noise"),
            F.sum(F.col(n) * m * (1 - m)).alias("base"),
        )
        .first()
    )
    if not row.base:
        return 1.0
    # E[sum n (p - m)^2] = sum m (1 - m) (1 + (n - 1) / (strength + 1))
    extra = (row.spread - row.noise) / max(row.base - row.noise, 1e-12)
    return float(min(1e4, max(1.0, 1 / max(extra, 1e-4) - 1)))


def site_shifts(scored: DataFrame, ws: Workspace, head: str) -> DataFrame:
    """(host, path, shift_<head>): how far the site's posterior lies from the global rate, as a logit."""
    p = sigmoid(F.col(head))
    paths = ws.keep(scored.groupBy("host", "path").agg(F.sum(p).alias("bad"), F.count("*").alias("n")), f"paths_{head}")
    total = paths.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    prior = (total.bad or 0.0) / total.n if total.n else 0.5
    hosts = paths.groupBy("host").agg(F.sum("bad").alias("host_bad"), F.sum("n").alias("host_n"))
    hosts = ws.keep(hosts.withColumn("rate", F.col("host_bad") / F.col("host_n")).withColumn("prior", F.lit(prior)), f"hosts_{head}")
    k = strength(hosts, "rate", "host_n", "prior")
    post = hosts.select("host", ((F.col("host_bad") + k * prior) / (F.col("host_n") + k)).alias("host_rate"))
    both = ws.keep(paths.join(post, F.equal_null(paths.host, post.host)).drop(post.host).withColumn("rate", F.col("bad") / F.col("n")), f"sites_{head}")
    k = strength(both, "rate", "n", "host_rate")
    rate = (F.col("bad") + k * F.col("host_rate")) / (F.col("n") + k)
    shift = logit(rate) - logit(F.lit(prior))
    return both.select("host", "path", F.greatest(F.lit(-MOST_SHIFT), F.least(F.lit(MOST_SHIFT), shift)).alias(f"shift_{head}"))


def classify(
    docs: DataFrame,
    model: QualityModel,
    ws: Workspace,
    *,
    id: str = "doc_id",
    text: str = "text",
    host: Column | None = None,
    path: Column | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Per row: doc_id, text_hash, host, path, p_low and p_toxic (posteriors), reject (either over ``threshold``).

    ``host`` and ``path`` name the site and its section (default: ``source`` and ``lang``); null is a site of its
    own. A document counts in its site's rate as any other does, so a site of one is moved a little by itself.
    Null and empty texts have no words and are judged by their marks and their site; long texts are judged whole. Rows
    with a null id and repeated rows are judged each; other columns are ignored; an empty table gives no rows.
    """
    host = F.col("source") if host is None else host
    path = F.col("lang") if path is None else path
    scored = ws.keep(evidence(docs, model, id=id, text=text, host=host.cast("string"), path=path.cast("string")), "evidence")
    out = scored
    for head in ("low", "toxic"):
        shifts = site_shifts(scored, ws, head)
        on = F.equal_null(out.host, shifts.host) & F.equal_null(out.path, shifts.path)
        out = out.join(shifts, on, "left").drop(shifts.host, shifts.path)
    low, toxic = (sigmoid(F.col(h) + F.col(f"shift_{h}")) for h in ("low", "toxic"))
    return out.select(
        "doc_id", "text_hash", "host", "path", low.alias("p_low"), toxic.alias("p_toxic"), ((low > threshold) | (toxic > threshold)).alias("reject")
    )
