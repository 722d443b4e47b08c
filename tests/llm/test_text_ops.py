"""Suffix dedup, SimHash, packing and token files against plain versions."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskrank.llm import packing, queries, simhash, suffix_dedup, token_files
from riskrank.llm.common import CachedEncoder, Workspace, connected_components, encoder
from tests.llm import brute

SF = "/root/testdata/sf0.001"
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", None, "  ", "a\t  b \n\n c", "\x1c a!\x1c\x1f b", "x\xa0\xa0y  z", "it's 'S", "<|endoftext|> a<|endoftext|>", "é ́a", "日本 語　x", "A" * 300]


def docs_of(spark, rows):
    """Rows (doc_id, text) with columns whose names clash with inner ones."""
    return spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *(F.lit("x").alias(n) for n in ("id", "doc", "spans", "fp", "row", "length", "k1", "component_id"))
    )


def mixed_rows(seed=1, n=60):
    r = random.Random(seed)
    words = ["".join(r.choices("abcdeé ", k=r.randint(1, 8))) for _ in range(300)]
    texts = [" ".join(r.choices(words, k=r.randint(0, 120))) for _ in range(n)]
    for i in range(n // 2):
        a, b = r.sample(range(n), 2)
        x = r.randint(0, len(texts[a]))
        cut = texts[a][x : x + r.randint(20, 200)]
        at = r.randint(0, len(texts[b]))
        texts[b] = texts[b][:at] + cut + texts[b][at:]
    texts += [texts[0], texts[1][:-3], "ab" * 200, "ab" * 150, "q" * 49, "q" * 50, *ODD]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    return rows + [rows[0], rows[5], (None, texts[2]), (None, None)]


def test_suffix_dedup_bytes(spark):
    for seed in range(2):
        rows = mixed_rows(seed)
        got = suffix_dedup.remove_repeats(docs_of(spark, rows), Workspace(spark)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(brute.suffix_removed(rows), key=str)


def test_suffix_dedup_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op2_suffix_dedup(spark, SF).collect()))
    assert got == sorted(brute.suffix_removed(rows))


def test_suffix_dedup_small_flushes(spark, monkeypatch):
    rows = mixed_rows(3)
    tokens = suffix_dedup.Tokens(__import__("pyarrow").array([t for _, t in rows]), "byte")
    whole = [np.concatenate(x) for x in zip(*suffix_dedup.regions(tokens, 50), strict=True)]
    monkeypatch.setattr(suffix_dedup, "STEP", 1000)
    steps = [np.concatenate(x) for x in zip(*suffix_dedup.regions(tokens, 50), strict=True)]

    def windows(found):
        return sorted((int(r), int(s) + i) for r, s, n in zip(*found[2:5], strict=True) for i in range(int(n) + 1))

    assert windows(whole) == windows(steps)
    # a group settled in parts
    k = np.zeros(6, np.int64)
    place = suffix_dedup.packed(np.arange(6), k, k, k, k)
    (doc, *_, open_), head = suffix_dedup.settle(k, k, np.array([3, 3, 4, 5, 5, 6]), place, None, False, 50)
    assert open_.tolist() == [True, True, False, False, False, False] and head[2] == 3
    (doc, *_, open_), _ = suffix_dedup.settle(k, k, np.array([6, 6, 7, 7, 8, 9]), place, head, True, 50)
    assert len(doc) == 6 and not open_.any()


def test_suffix_dedup_words(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefg", k=5))
    shared = [word() for _ in range(60)]
    rows = [(i, " ".join([*(word() for _ in range(30)), *shared, *(word() for _ in range(20))])) for i in range(5)]
    rows += [(9, "  ".join(shared[:49])), (10, "\n".join(shared[3:55]))]
    out = suffix_dedup.remove_repeats(docs_of(spark, rows), Workspace(spark), unit="word", keep_content=True)
    got = {r.doc_id: r for r in out.collect()}
    assert got[0].n_spans == 0 and got[9].n_spans == 0
    for i in range(1, 5):
        assert got[i].n_spans == 1 and got[i].n_removed == len(" ".join(shared))
        assert bytes(got[i].kept).decode().split() == rows[i][1].split()[:30] + rows[i][1].split()[90:]
    assert bytes(got[10].kept) == b""


def test_empty_tables(spark):
    none = docs_of(spark, [])
    assert suffix_dedup.remove_repeats(none, Workspace(spark)).count() == 0
    assert simhash.near_duplicates(none, Workspace(spark)).count() == 0
    assert simhash.one_of_each(none, Workspace(spark)).count() == 0
    assert packing.pack_documents(none, Workspace(spark), tokenizer=BYTE).count() == 0
    manifest, counts = token_files.write_token_files(none, Workspace(spark), tokenizer=WORD, vocabulary=49_408)
    assert token_files.read_token_files(manifest, counts).count() == 0


def test_simhash(spark):
    rows = mixed_rows(2)
    got = simhash.near_duplicates(docs_of(spark, rows), Workspace(spark)).collect()
    expected = brute.components([(d, brute.simhash(t)) for d, t in rows])
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_simhash_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op10_simhash_ball(spark, SF).collect()))
    assert got == sorted(brute.components([(r.doc_id, brute.simhash(r.text)) for r in rows]))


def test_ball_pairs_connect_all_within_radius(spark):
    r = random.Random(7)
    base = [r.getrandbits(64) for _ in range(20)]
    fps = {b ^ sum(1 << p for p in r.sample(range(64), r.randint(0, 3))) for b in base for _ in range(12)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    pairs = simhash.ball_pairs(spark.createDataFrame([(x,) for x in signed], "fp long"))
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in pairs.collect())
    got = {r.node: r.component for r in connected_components(pairs, Workspace(spark)).collect()}
    expected = brute.components(list(enumerate(fps)))
    group = {f: c for (_, f, c) in expected}
    for x in signed:
        for y in signed:
            same = group[f"{x & (2**64 - 1):016x}"] == group[f"{y & (2**64 - 1):016x}"]
            assert same == (x == y or got.get(x, x) == got.get(y, y))


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(r.randint(0, 60), r.randint(0, 60)) for _ in range(50)] + [(5, 5), (-7, 200)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long"), Workspace(spark)).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and got[200] == -7
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for start in got:
        seen, todo = {start}, [start]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        assert got[start] == min(seen)


def test_long_texts_in_parts(monkeypatch):
    r = random.Random(8)
    texts = [" ".join("".join(r.choices("abcAB", k=r.randint(1, 6))) for _ in range(n)) for n in (0, 1, 2, 3, 4, 5, 200)]
    texts += ["x" * 300, "y" * 50 + "  " + "z" * 80 + "\t\n q", " \n " * 40, " a" * 90 + " "]
    for size in (1, 3, 5):
        whole = [simhash.simhash(t.encode(), size) for t in texts]
        assert [x & (2**64 - 1) for x in whole] == [brute.simhash(t, size) for t in texts]
        for part in (1, 7, 64):
            monkeypatch.setattr(simhash, "PART", part)
            assert [simhash.simhash(t.encode(), size) for t in texts] == whole
        monkeypatch.undo()


def test_one_of_each(spark):
    rows = mixed_rows(4) + [(2, "another text under the same id, of its own words"), (None, "no id here but words"), (None, "no id here but words")]
    found = brute.components([(i, brute.simhash(t)) for i, (_, t) in enumerate(rows)])
    groups = {}
    for i, _, c in found:
        groups.setdefault(c, []).append(rows[i])
    hashes = {t: h for t, h in spark.createDataFrame([(t,) for t in {t or "" for _, t in rows}], "t string").select("t", F.xxhash64("t")).collect()}
    key = lambda r: (r[0] is None, r[0] or 0, hashes[r[1] or ""])
    expected = sorted((min(key(r) for r in g) for g in groups.values()))
    got = simhash.one_of_each(docs_of(spark, rows), Workspace(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text_hash) for r in got) == expected


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_whole_texts(path):
    tokenizer = Tokenizer.from_file(path)
    r = random.Random(4)
    texts = [*ODD, *("".join(r.choices("ab'sé \t\n\r\x0b\x85\xa0 　​\x1c9!́", k=r.randint(0, 60))) for _ in range(3000))]
    for t in texts:
        expected = np.asarray(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder(path).encode(t) == expected, repr(t)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_of_many_new_words(path):
    """Words of every Latin letter, in one text, so that they are encoded end to end and cut apart."""
    tokenizer = Tokenizer.from_file(path)
    r = random.Random(9)
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x250))]
    words = ["".join(r.choices(letters, k=r.randint(1, 12))) + r.choice(["", "", ",", ".", ";", "..", "'s"]) for _ in range(4000)]
    text = " ".join([*letters, *(x + "," for x in letters), *words])
    expected = np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert CachedEncoder(path).encode(text) == expected


@pytest.mark.parametrize("path,distinct", [(BYTE, 7), (WORD, 4)])
def test_words_are_found_once_and_by_the_model(path, distinct, monkeypatch):
    """Marks, line ends and, where it is dropped, case make no new words, and no words go through the whole tokenizer."""
    e, seen = CachedEncoder(path), []
    single = e._single
    monkeypatch.setattr(e, "_single", lambda pieces: seen.extend(pieces) or single(pieces))
    texts = ["Zebu zebu, zebu.\nzebu. Zebu,\nZebu", "", None, " zebu, Zebu"] * 3
    expected = [np.asarray(x.ids, "<u4").tobytes() for x in e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert e.encode_many(texts) == expected
    assert set(seen) <= {",", ".", "\n"} and len(seen) <= 3 and len(e.cache) == distinct


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_cuts_rows_at_their_ends(path):
    """Rows of one column, slices of it too: white space, marks and added tokens at the ends of rows stay their own."""
    r = random.Random(5)
    alphabet = [*"ab'sÉ×İɀ.,<9 \n\x85\xa0\u2003\u3000́", "<|endoftext|>", " the,", "Ed."]
    texts = [None, "", *("".join(r.choices(alphabet, k=r.randint(0, 6))) for _ in range(4000))]
    e = CachedEncoder(path, 500)
    expected = [np.asarray(x.ids, "<u4").tobytes() for x in e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert list(e.encode_column(pa.array(["x,", *texts]).slice(1))) == expected
    assert list(e.encode_column(pa.array([None, ""], pa.string()))) == [b"", b""] and e.encode_many([]) == []


def test_packing(spark):
    rows = mixed_rows(6) + [(500, "word " * 5000)]
    got = packing.pack_documents(docs_of(spark, rows), Workspace(spark), tokenizer=BYTE, capacity=256, keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(BYTE)
    by_doc = {}
    for p in got:
        by_doc.setdefault(p.doc_id, []).append(p)
        assert brute.crc(np.frombuffer(p.ids, "<u4")) == p.ids_crc32 and len(p.ids) == 4 * p.length
    for doc, text in rows:
        if doc is None or [d for d, _ in rows].count(doc) > 1:
            continue
        pieces = sorted(by_doc[doc], key=lambda p: p.piece)
        ids = brute.ids_of(tokenizer, text, 0)
        assert [i for p in pieces for i in np.frombuffer(p.ids, "<u4")] == ids
        assert len(pieces) == -(-len(ids) // 256) and all(p.length == 256 for p in pieces[1:])
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()
    sequences = {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append(p)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256
    assert len(sequences) <= -(-sum(p.length for p in got) // 256) + 1
    assert len(got) == sum(-(-len(brute.ids_of(tokenizer, t, 0)) // 256) for _, t in rows)


def test_fullest_bin_is_optimal():
    r = random.Random(8)
    for _ in range(200):
        counts = {}
        for _ in range(r.randint(1, 8)):
            counts[r.randint(1, 40)] = r.randint(1, 3)
        chosen = packing.fullest(dict(counts), 40)
        assert chosen[0] == max(counts) and sum(chosen) <= 40
        assert all(chosen.count(n) <= counts[n] for n in chosen)
        sums = {max(counts)}
        items = [n for n, c in counts.items() for _ in range(c)]
        items.remove(max(counts))
        for n in items:
            sums |= {s + n for s in sums if s + n <= 40}
        assert sum(chosen) == max(sums)


def test_token_files(spark):
    rows = mixed_rows(9) + [(500, "word " * 3000)]
    ws = Workspace(spark)
    manifest, counts = token_files.write_token_files(docs_of(spark, rows), ws, tokenizer=WORD, vocabulary=49_408, file_tokens=700)
    assert manifest.count() > 8
    got = token_files.read_token_files(manifest, counts, with_ids=True).collect()
    tokenizer = Tokenizer.from_file(WORD)
    expected = sorted(((d is not None, d or 0), brute.ids_of(tokenizer, t, 1)) for d, t in rows)
    got = sorted(got, key=lambda r: r.start)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), np.frombuffer(r.ids, "<u4").tolist()) for r in got) == expected
    at = 0
    for r, (key, _) in zip(got, expected, strict=True):
        assert r.start == at and (r.doc_id is not None, r.doc_id or 0) == key and r.n_tokens == len(r.ids) // 4
        assert brute.crc(np.frombuffer(r.ids, "<u4")) == r.ids_crc32
        at += r.n_tokens


def test_token_blocks_checkpoints_and_checksums(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 5000)
    r = np.random.default_rng(1)
    ids = (r.zipf(1.3, 23_456) % 3000).astype(np.uint32)
    table = token_files.Table(np.bincount(ids, minlength=3000))
    sizes = np.array([456, 0, 20_000, 3000])
    with open(tmp_path / "f", "wb") as f:
        token_files.write_file(f, np.arange(4), sizes, np.ones(4, bool), ids, table)
    data = (tmp_path / "f").read_bytes()
    index = token_files.read_index(data)
    assert (token_files.read_tokens(data, index, table) == ids).all()
    assert (token_files.read_tokens(data, index, table, 4990, 5021) == ids[4990:10_011]).all()
    broken = bytearray(data)
    broken[int(index["places"][2][2]) + 50] ^= 1
    assert (token_files.read_tokens(bytes(broken), index, table, 0, 9000) == ids[:9000]).all()
    with pytest.raises(ValueError, match="damaged"):
        token_files.read_tokens(bytes(broken), index, table)
    one = np.zeros(10, np.uint32)
    only = token_files.Table(np.array([10, 0]))
    assert (token_files.decode_block(token_files.encode_block(one, only), 10, only) == one).all()
