"""Vector searches against brute force, and piece codes against the model."""

import random

import duckdb
import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from riskrank.llm import ann, pieces, queries, topk
from riskrank.llm.common import Workspace

SF = "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *(F.lit("x").alias(n) for n in ("vec", "head", "ids", "grp", "key", "asked", "score"))
    )


def odd_rows(seed, n=700, d=6):
    r = np.random.default_rng(seed)
    rows = [(i, (r.standard_normal(d) * r.lognormal(0, 1)).tolist()) for i in range(n)]
    hot = rows[3][1]
    rows = [(i, hot if i % 3 == 1 else v) for i, v in rows]
    rows += [(5000, None), (5050, []), (5100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (5150, [float("nan")] * d), (5200, [float("inf")] * d)]
    rows += [(5250, [0.0] * d), (5300, [1.0, 2.0]), (None, rows[0][1]), rows[50], (-50, rows[9][1]), (100_000_000_000 * 50, rows[8][1])]
    return rows


def brute(rows, score, zero, k=5, every=50):
    live = {i: np.array(v, float) for i, v in rows if i is not None and v and len(v) == 6 and None not in v and np.isfinite(v).all()}
    live = {i: v for i, v in live.items() if zero or v.any()}
    out = []
    for q in live:
        if q % every == 0:
            best = sorted(((-score(live[q], v), i) for i, v in live.items() if i != q))[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(out)


def cosine(a, b):
    return round(float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), 12)


def test_hilbert_neighbours():
    for d, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        keys = ann.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_nearest_with_full_reach_is_exact(spark):
    rows = odd_rows(1)
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in ann.nearest(vectors_of(spark, rows), Workspace(spark), reach=1.0).collect())
    expected = brute(rows, cosine, False)
    assert [x[3] for x in got] == [x[3] for x in expected] and got == expected
    assert ann.nearest(vectors_of(spark, []), Workspace(spark)).count() == 0
    few = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 1.0, 0.0])]
    assert [tuple(r)[:3] for r in ann.nearest(vectors_of(spark, few), Workspace(spark)).collect()] == [(0, 1, 1)]


def test_nearest_recall_over_windows(spark, monkeypatch):
    monkeypatch.setattr(ann.in_blocks, "__defaults__", (64,))
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in ann.nearest(table, Workspace(spark)).collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    data = table.toPandas()
    x = np.stack(data.embedding).astype(float)
    ids = data.vec_id.to_numpy()
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = (x @ x[q]) / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[q]))
        s[q] = -9
        top = np.lexsort((ids, -s))[:5]
        hits += sum(int(ids[t]) in got[int(ids[q])] for t in top)
        total += 5
        assert all(abs(s[np.flatnonzero(ids == v)[0]] - y) < 1e-12 for v, y in got[int(ids[q])].items())
    assert hits >= 0.9 * total


def test_top_products(spark, monkeypatch):
    rows = odd_rows(2)
    expected = brute([(i, None if v is None or None in v or not np.isfinite(v).all() else np.floor(256 * np.array(v)).tolist()) for i, v in rows], lambda a, b: int((a * b).sum()), True)
    for size in (2048, 32):
        monkeypatch.setattr(topk.in_blocks, "__defaults__", (size,))
        got = sorted(map(tuple, topk.top_products(vectors_of(spark, rows), Workspace(spark)).collect()))
        assert got == expected
    assert topk.top_products(vectors_of(spark, []), Workspace(spark)).count() == 0


def test_search_of_a_full_block_with_few_pruned_rows():
    r = np.random.default_rng(4)
    d, n, keep = 32, 2048, 6
    heads, turn = np.arange(n), np.eye(d)
    q = np.floor(r.standard_normal((20, d)) * 4) + 200 * np.eye(d)[0]
    for pruned in range(1, 9):
        v = np.floor(r.standard_normal((n, d)) * 4) + 200 * np.eye(d)[0]
        v[r.choice(n, pruned, replace=False), 0] = -1000
        scores, least = topk.products(q, v), np.ones(len(q))
        assert ((~topk.candidates(q, v, least, turn)).sum(axis=1) == pruned).all()
        i, j, score = topk.search(q, v, heads, least, turn, keep)
        for k in range(len(q)):
            expected = sorted((-s, h) for h, s in enumerate(scores[k].tolist()))[:keep]
            assert [(-s, h) for s, h in zip(score[i == k].tolist(), j[i == k].tolist(), strict=True)] == expected


def test_top_products_in_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    expected = sorted(duck.execute(queries.oracle_sql()["op3_norm_sorted_topk"]).fetchall())
    assert sorted(map(tuple, queries.op3_norm_sorted_topk(spark, SF).collect())) == expected


def test_large_products_are_exact():
    a = np.array([[2.0**30, 3.0, -(2.0**31)]])
    b = np.array([[2.0**31, 1.0, 7.0]])
    assert topk.products(a, b)[0, 0] == 2**61 + 3 - 7 * 2**31


TEXTS = [
    "", None, " ", "  a\n\tb ﬁ  c ", "hello world", "▁under▁ ▁▁ x", "日本語 テキスト", "é é", "a" * 400, "\x00\x01 <0x0A> <s> </s> <unk>", "🙂 ok",
    " lead", "trail  ", "1234567890 12 345", "In 1984, the U.S.A. won!!!",
]


def test_codec_without_dropout_is_the_model():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    c = pieces.PieceCodec(MODEL, 0.0, 0)
    r = random.Random(1)
    texts = [t for t in TEXTS if t and "▁" not in t and "<" not in t]
    texts += ["".join(r.choices("abcdehilnorst  ,.\nABé日", k=r.randint(1, 80))) for _ in range(1500)]
    for t in texts:
        assert np.frombuffer(c.encode(t, 1), "<u4").tolist() == model.encode(t), repr(t)


def test_dropout_varies_and_decodes(spark):
    c = pieces.PieceCodec(MODEL, 0.3, 5)
    seen = {c.encode("internationalization", d) for d in range(40)}
    assert len(seen) > 3
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x y"), (0, "again"), (0, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("n_pieces", F.lit("x"))
    for p in (0.0, 0.1, 1.0):
        out = pieces.encode_pieces(df, model=MODEL, dropout=p, seed=3)
        assert all(r.lossless and r.n_pieces == len(r.ids) // 4 for r in out.collect())
        back = sorted(map(tuple, pieces.decode_pieces(out, model=MODEL).collect()), key=str)
        assert back == sorted(((d, t or "") for d, t in rows), key=str)
    # With everything skipped, pieces are characters or bytes.
    plain = pieces.PieceCodec(MODEL, 1.0, 0)
    assert len(np.frombuffer(plain.encode("abc", 0), "<u4")) == 4


def test_dropout_of_every_occurrence(spark):
    c = pieces.PieceCodec(MODEL, 0.1, 5)
    word, places = "internationalization", 4000
    ids = [c.encode(word, d) for d in range(places)]
    assert len(set(ids)) > 20 and all(c.decode(x) == word for x in ids)
    # Of two characters that only one merge can join, a tenth stay apart.
    pair = next(p for p in c.score if len(p) == 2 and p[0] == pieces.SPACE and p[1].isalpha())
    apart = np.mean([len(x) > 4 for x in (c.encode(pair[1], d) for d in range(places))])
    assert 0.08 < apart < 0.12
    text = " ".join(["the", "of", word] * 20)
    chunks = pieces.CHUNK.findall(" " + text)
    place = pieces.mix64(np.arange(len(chunks), dtype=np.uint64) * pieces.MIX_A + pieces.U64((3 * int(pieces.MIX_C) + 5) & pieces.MASK))
    assert c.encode(text, 3) == b"".join(c._alone(x, int(p), c.limit)[0] for x, p in zip(chunks, place, strict=True))
    assert "ids" in queries.op4_merge_dropout(spark, SF).columns


def test_dropout_by_plain_agenda():
    c = pieces.PieceCodec(MODEL, 0.0, 0)
    plain = pieces.PieceCodec(MODEL, 0.25, 9)
    r = random.Random(2)
    for _ in range(300):
        chunk = "▁" + "".join(r.choices("ethanios", k=r.randint(1, 14)))
        v = r.randrange(8)
        symbols, key = [(i, i + 1) for i in range(len(chunk))], None
        import zlib

        key = zlib.crc32(chunk.encode()) * 0x9E3779B97F4A7C15 + (9 << 8) + v + 1
        while True:
            best = None
            for (a, b), (_, e) in zip(symbols, symbols[1:], strict=False):
                s = c.score.get(chunk[a:e])
                h = (key + a * 0xBF58476D1CE4E5B9 + b * 0x94D049BB133111EB + e * 0xD6E8FEB86659FD93) & pieces.MASK
                h = ((h ^ h >> 32) * 0xD6E8FEB86659FD93) & pieces.MASK
                h = ((h ^ h >> 29) * 0xBF58476D1CE4E5B9) & pieces.MASK
                if s is not None and (h ^ h >> 32) >= plain.limit and (best is None or (-s, a) < best[0]):
                    best = ((-s, a), a, b, e)
            if best is None:
                break
            symbols = [x for x in symbols if x[0] not in best[1:3]] + [(best[1], best[3])]
            symbols.sort()
        assert plain.segment(chunk, v, plain.limit) == [chunk[a:b] for a, b in symbols]


def test_words_side_by_side_as_one_by_one():
    """Arrays of many words give what an agenda for each gives: characters without a piece, long words and marks included."""
    r = random.Random(6)
    texts = [t for t in TEXTS if t] + ["".join(r.choices("abcdehilnorst  ,.\nABé日ﬁ🙂▁\u0301", k=r.randint(1, 300))) for _ in range(200)]
    texts += [r.choice("abc") * r.randint(40, 60) for _ in range(5)]
    for dropout in (0.0, 0.1, 0.5, 1.0):
        c = pieces.PieceCodec(MODEL, dropout, 11)
        for texts_, docs in ((texts, list(range(len(texts)))), (texts[::-1], [7] * len(texts))):
            got = c.encode_many([None, *texts_, ""], [1, *docs, 2])
            assert got[0] == got[-1] == b""
            for t, d, x in zip(texts_, docs, got[1:-1], strict=True):
                chunks = pieces.CHUNK.findall(" " + t)
                base = pieces.U64((d * int(pieces.MIX_C) + 11) & pieces.MASK)
                place = pieces.mix64(np.arange(len(chunks), dtype=np.uint64) * pieces.MIX_A + base)
                assert x == b"".join(c._alone(y, int(p), c.limit)[0] for y, p in zip(chunks, place, strict=True)), (dropout, t)
                assert c.decode(x) == t


def test_pieces_table(spark):
    out = queries.op4_merge_dropout(spark, "/root/testdata/sf0.001")
    assert out.where("not lossless").count() == 0 and out.count() == 200


def test_chunks_of_a_batch_are_looked_up_once(monkeypatch):
    """Each distinct chunk of a batch is asked for once; what every text and place gets is as if it were alone."""
    c, asked = pieces.PieceCodec(MODEL, 0.2, 3), []
    plain = c._plain
    monkeypatch.setattr(c, "_plain", lambda chunks: asked.append(sorted(chunks)) or plain(chunks))
    texts = ["to be  or not to be", None, "", " ", "be", "▁ to  ", "日本 to\nbe "] * 2
    docs = [5, 6, 7, 8, 9, -1, 10**12] * 2
    together = c.encode_many(texts, docs)
    assert asked == [sorted(set(asked[0]))]
    assert together == [pieces.PieceCodec(MODEL, 0.2, 3).encode(t, d) for t, d in zip(texts, docs, strict=True)]
    assert c.spells(together, texts) == [True] * 14
    other = [b"" if x else together[0] for x in together]
    assert c.spells(other, texts) == [False] * 14
    assert c.spells([x + x[:4] for x in together], texts) == [not x for x in together]
