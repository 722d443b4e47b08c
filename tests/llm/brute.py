"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import xxhash


def suffix_removed(rows, threshold=50):
    first = {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        data = (text or "").encode()
        for i in range(len(data) - threshold + 1):
            first.setdefault(data[i : i + threshold], doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - threshold + 1):
            if doc is not None and first[data[i : i + threshold]] < doc:
                gone[i : i + threshold] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, radius=2):
    """rows: (doc_id, fingerprint)."""
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, f"{fp:016x}", least.get(find(i))) for i, (doc, fp) in enumerate(rows)]


def ids_of(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
