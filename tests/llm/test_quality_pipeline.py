"""The quality classifier, and the stages of the pipeline on planted cases."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from riskrank.llm import quality, queries
from riskrank.llm.common import Workspace
from tests.llm import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels")}


def test_features():
    texts = ["Über ALLES, über!!", None, "", "a b\ta|b 12", "x" * 10]
    f = quality.Features(pa.array(texts))
    assert np.bincount(f.row, minlength=5).tolist() == [3, 0, 0, 2, 1]
    alone = [quality.Features(pa.array([t], pa.string())) for t in texts]
    for i, a in enumerate(alone):
        assert (a.style[0] == f.style[i]).all() and set(a.slot) == set(f.slot[f.row == i])


def test_held_out(spark, tables):
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    labels = tables["labels"]
    model = quality.fit_quality(tables["documents"], labels.where(fold > 0))
    judged = quality.classify(tables["documents"], model, Workspace(spark))
    rows = judged.join(labels.where(fold == 0), "doc_id").collect()
    right = [r.reject == bool(r.quality == 0 or r.toxic) for r in rows]
    clean = [not r.reject for r in rows if r.quality and not r.toxic]
    assert len(rows) > 80 and np.mean(right) > 0.9 and np.mean(clean) > 0.95
    assert judged.count() == tables["documents"].count()


def test_shrinking_by_hand(spark):
    r = random.Random(1)
    rows = [(i, f"h{i % 7}", f"p{i % 3}", r.uniform(-3, 1) + (2 if i % 7 == 0 else 0), r.uniform(-4, 0)) for i in range(300)]
    rows += [(1000, None, None, 2.0, 0.0), (1001, None, "p0", -1.0, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, host string, path string, low double, toxic double")
    got = {(x.host, x.path): x.shift_low for x in quality.site_shifts(df, Workspace(spark), "low").collect()}
    p = {}
    for _, h, s, z, _ in rows:
        p.setdefault((h, s), []).append(1 / (1 + np.exp(-z)))
    every = [v for x in p.values() for v in x]
    prior = np.mean(every)

    def strength(groups):
        spread = sum(n * (m - t) ** 2 for m, n, t in groups if n > 1)
        noise = sum(t * (1 - t) for _, n, t in groups if n > 1)
        base = sum(n * t * (1 - t) for _, n, t in groups if n > 1)
        return min(1e4, max(1.0, 1 / max((spread - noise) / (base - noise), 1e-4) - 1))

    hosts = {h: [v for (g, _), x in p.items() if g == h for v in x] for h in {h for h, _ in p}}
    k = strength([(np.mean(x), len(x), prior) for x in hosts.values()])
    rate = {h: (sum(x) + k * prior) / (len(x) + k) for h, x in hosts.items()}
    k = strength([(np.mean(x), len(x), rate[h]) for (h, _), x in p.items()])
    logit = lambda q: np.log(q / (1 - q))
    for (h, s), x in p.items():
        shift = logit((sum(x) + k * rate[h]) / (len(x) + k)) - logit(prior)
        assert abs(got[h, s] - np.clip(shift, -2, 2)) < 1e-9


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, lang string, host int, low int, reject int"
    rows = [(1, None, "a", "b", 0, 0, 0), (2, "", None, None, 0, 0, 0), (None, "x " * 50_000, "a", None, 0, 0, 0), (1, None, "a", "b", 0, 0, 0)]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, schema)
    for marks in (labels, labels.where("false")):
        out = quality.classify(docs, quality.fit_quality(docs, marks), Workspace(spark)).collect()
        assert len(out) == 4 and all(0 <= r.p_low <= 1 and 0 <= r.p_toxic <= 1 for r in out)
    assert quality.classify(docs.where("false"), quality.fit_quality(docs, labels), Workspace(spark)).count() == 0


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def hashes_of(spark, texts):
    texts = sorted({t or "" for t in texts})
    return dict(map(tuple, spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t")).collect()))


def near_by_hand(spark, rows):
    """Of each group of fingerprints within two bits the row with the smallest id, null last, then text hash."""
    hashes, groups = hashes_of(spark, [r[1] for r in rows]), {}
    for i, _, c in brute.components([(i, brute.simhash(r[1])) for i, r in enumerate(rows)]):
        groups.setdefault(c, []).append(rows[i])
    key = lambda r: (r[0] is None, r[0] or 0, hashes[r[1] or ""], *((v is not None, v or "") for v in (r[2], r[3])), r[4] or 0, r[1] is not None)
    return [min(g, key=key) for g in groups.values()]


def passages_by_hand(spark, rows, n=50):
    """Words of runs of ``n`` that also start under a smaller id are cut; one text an id, null ids stay whole."""
    hashes, least = hashes_of(spark, [r[1] for r in rows]), {}
    for r in rows:
        if r[0] is not None:
            least[r[0]] = min(least.get(r[0], (2**63,)), (hashes[r[1] or ""],))
    found, out = {}, []
    part = [r[0] is not None and (hashes[r[1] or ""],) == least[r[0]] for r in rows]
    words = [[(m.start(), m.end()) for m in re.finditer(rb"[^ \t-\r]+", (r[1] or "").encode())] for r in rows]

    def windows(i):
        data = (rows[i][1] or "").encode()
        return [tuple(data[a:b] for a, b in words[i][j : j + n]) for j in range(len(words[i]) - n + 1)]

    for i in range(len(rows)):
        for w in windows(i) if part[i] else ():
            found[w] = min(found.get(w, rows[i][0]), rows[i][0])
    for i, r in enumerate(rows):
        data = (r[1] or "").encode()
        gone = bytearray(len(data))
        for j, w in enumerate(windows(i) if part[i] else ()):
            if found[w] < r[0]:
                a, b = words[i][j][0], words[i][j + n - 1][1]
                gone[a:b] = b"\1" * (b - a)
        text = bytes(c for c, g in zip(data, gone, strict=True) if not g).decode()
        out.append((r[0], text, r[2], r[3], len(text)))
    return out


def key(rows):
    return sorted((tuple(map(str, r)) for r in rows))


def test_stages_equal_plain_versions(spark, tables):
    """Each stage on what its predecessor kept, over a whole table with repeated ids and nulls."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*corpus_pipeline.COLUMNS).collect()]
    passage = " ".join(f"p{i}" for i in range(70))
    rows += [(90_000 + i, f"own {i} words a{i} b{i} c{i} {passage} tail {i}", "en", "s", 0) for i in range(5)]
    rows += [(90_000, f"another text of that id {passage}", "en", "s", 1), (None, f"x {passage}", None, None, None), (90_010, None, None, None, None)]
    rows += [rows[3], (rows[4][0], "a second text under an id that is there already", "de", "t", 7), (rows[5][0], rows[6][1], "de", "t", 7)]
    docs = spark.createDataFrame(rows, SCHEMA)

    model = quality.fit_quality(docs, tables["labels"])
    judged = quality.classify(docs, model, Workspace(spark)).select("doc_id", "text_hash", "reject").collect()
    rejected = {(r.doc_id, r.text_hash) for r in judged if r.reject}
    hashes = hashes_of(spark, [r[1] for r in rows])
    kept = [r for r in rows if (r[0], hashes[r[1] or ""]) not in rejected]
    sf = "/root/testdata/sf0.01"
    assert key(corpus_pipeline.quality(spark, docs, sf).collect()) == key(kept)

    single = near_by_hand(spark, kept)
    assert key(corpus_pipeline.near_duplicates(spark, spark.createDataFrame(kept, SCHEMA), sf).collect()) == key(single)
    cut = passages_by_hand(spark, single)
    got = corpus_pipeline.repeated_passages(spark, spark.createDataFrame(single, SCHEMA), sf).collect()
    assert key(got) == key(cut)
    assert sum(passage in r.text for r in got) < 5

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = corpus_pipeline.packing(spark, spark.createDataFrame(cut, SCHEMA), sf).collect()
    sizes = [len(tokenizer.encode(r[1], add_special_tokens=False).ids) + 1 for r in cut]
    assert sum(r.length for r in packed) == sum(sizes) and max(r.length for r in packed) <= 2048
    assert len(packed) == sum(-(-n // 2048) for n in sizes)
    assert len({r.sequence_id for r in packed}) <= -(-sum(sizes) // 2048) + 1


def test_rows_that_the_pipeline_once_lost(spark):
    """Another text under an id goes its own way, and rows with a null id do not depend on other rows' ids."""
    x, y = (" ".join(f"{c}{i}" for i in range(30)) for c in "xy")
    docs = lambda *rows: spark.createDataFrame([(*r, "en", "s", 0) for r in rows], SCHEMA)
    stage = lambda d: sorted((str(r.doc_id), r.text) for r in corpus_pipeline.near_duplicates(spark, d, SF).collect())
    assert stage(docs((1, x), (2, x), (2, y))) == [("1", x), ("2", y)]
    assert stage(docs((None, x), (None, y))) == sorted([("None", x), ("None", y)])
    assert stage(docs((None, x), (None, x), (None, y))) == sorted([("None", x), ("None", y)])
    assert stage(docs((None, x), (None, x), (5, y), (5, y), (6, x))) == [("5", y), ("6", x)]


def test_pipeline_runs(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) in (4, 5)
    out = __spark_entry__.queries()["pipeline"](spark, SF)
    assert out.count() > 500
    full = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.avg("n"), F.max("n")).first()
    assert full[0] > 2000 and full[1] <= 2048


def test_stages_with_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, spans int"
    rows = [(1, None, None, None, None, 0, 0), (2, "", "en", "s", 0, 0, 0), (None, "a b c", "en", "s", 5, 0, 0), (3, "a b", "en", "s", 3, 0, 0), (3, "a b", "en", "s", 3, 0, 0)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.collect()
            if stage is not corpus_pipeline.packing:
                assert out.columns == corpus_pipeline.COLUMNS


def test_quality_query(spark):
    out = queries.op9_site_bayes(spark, "/root/testdata/sf0.001")
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
