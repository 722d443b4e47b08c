"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from riskrank.llm import merkle, queries
from riskrank.llm.common import Workspace

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    rows = [leaves]
    while len(rows[-1]) > 1:
        rows.append([h("".join(rows[-1][i : i + 3])) for i in range(0, len(rows[-1]), 3)])
    return rows


def steps(rows, i):
    out = []
    for row in rows[:-1]:
        at = i - i % 3
        out.append(("".join(row[at:i]), "".join(row[i + 1 : at + 3])))
        i //= 3
    return out


def plain(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((own, tree([leaf(*r) for r in own])))
    top = tree([t[-1][0] for _, t in trees])
    out = []
    for k, (own, t) in enumerate(trees):
        for i, r in enumerate(own):
            path, folded = steps(t, i) + steps(top, k), leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                folded = leaf(*r[:4], r[4].replace("\n", ""))
            for left, right in path:
                folded = h(left + folded + right)
            proof = h("".join(left + right for left, right in path))
            out.append((r[0], t[0][i], t[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def key(rows):
    return sorted((tuple(map(str, r)) for r in rows))


def checked(spark, rows, block_levels):
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("x").alias(n) for n in ("leaf", "idx", "grp", "tree")))
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    other = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    manifest = merkle.document_manifest(docs, Workspace(spark), claimed={"text": other}, block_levels=block_levels)
    return manifest, merkle.check_claims(manifest)


def test_van_emde_boas_addresses():
    for levels in range(1, 8):
        places = [int(a) for row in merkle.addresses(levels) for a in row]
        assert sorted(places) == list(range(merkle.size_of(levels)))
    # Four levels: a top of two, then nine subtrees of two levels, each of a node and its three children.
    depths = merkle.addresses(4)
    assert depths[0].tolist() == [0] and depths[1].tolist() == [1, 2, 3]
    assert depths[2].tolist() == list(range(4, 40, 4))
    assert depths[3].tolist() == [4 + 4 * j + 1 + c for j in range(9) for c in range(3)]


def test_blocks_keep_their_nodes():
    for n in (1, 2, 3, 4, 9, 10, 26, 27):
        height = 0
        while 3**height < n:
            height += 1
        rows = merkle.grow([h(str(i)) for i in range(n)], height)
        assert merkle.load(merkle.store(rows), n, height) == rows
        assert rows == tree([h(str(i)) for i in range(n)])[::-1]


def test_paths_round_trip():
    path = [("", ""), ("", h("a")), (h("b"), ""), (h("c") + h("d"), ""), (h("e"), h("f")), ("", h("g") + h("h"))]
    assert merkle.unpack_path(merkle.pack_path(path)) == path


ODD = [
    (None, None, None, None, None), (1, None, "en", 1, "a\nb"), (2, "", "", 0, ""), (2, "", "", 0, ""), (3, "é", "-", -1, "\n\n\n"),
    (3, "é", "-", -1, "other"), (4, "z", None, 5, "x" * 3_000_000 + "\n"), (None, "z", "en", None, "no id\n"), (5, "Z", "1:-", 9, "ü\n"),
]


@pytest.mark.parametrize("block_levels", [1, 2, 6])
def test_manifest(spark, block_levels):
    rows = ODD + [(100 + i, f"s{i % 40}" if i % 3 else "hot", "en", i, f"text {i}\nend") for i in range(200)]
    manifest, got = checked(spark, rows, block_levels)
    got = got.collect()
    assert key(r[:7] for r in got) == key(plain(rows))
    assert manifest.root == got[0].root
    for r in got:
        path = merkle.unpack_path(bytes(r.path))
        assert merkle.fold(r.leaf, path) == r.root
        assert h("".join(left + right for left, right in path)) == r.proof_sha256


def test_one_row_and_none(spark):
    manifest, got = checked(spark, [(7, "a", "en", 1, "x")], 2)
    (r,) = got.collect()
    assert r.leaf == r.subroot == r.root == manifest.root and r.verified and r.proof_sha256 == h("")
    manifest, got = checked(spark, [], 2)
    assert manifest.root is None and got.count() == 0 and "folded_root" in got.columns


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = queries.op13_veb_manifest(spark, SF)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert key(got.collect()) == key(plain([tuple(r) for r in rows]))
