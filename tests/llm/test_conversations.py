"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

from pyspark.sql import functions as F

from riskrank.llm import conversations, queries

SF = "/root/testdata/sf0.001"
WHOLE = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def hurt(rows):
    """(conv_id, turn, role, text, there) after the damage that the query does."""
    for conv, turn, role, text in rows:
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        for _ in range(2 if n == 3 else 1):
            yield conv, turn, "user" if n == 4 else role, text, n != 0


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """(cost, audit) by suffixes: the roles so far are known by the last one, and whether there is any."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserted):
        ways = []
        if i == len(rows) and last in ("", "a"):
            ways.append((0, ""))
        if inserted < 3:
            cost, audit = best(i, after[last], inserted + 1)
            ways.append((cost + 2, "I" + audit))
        if i < len(rows):
            fault, initial = faults[i], rows[i][1][:1]
            cost, audit = best(i + 1, last, 0)
            ways.append((cost + 3, "D" + audit))
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                if initial == after[last] or (initial == "s" and last == ""):
                    cost, audit = best(i + 1, initial, 0)
                    ways.append((cost + cut, "K" + audit))
                cost, audit = best(i + 1, after[last], 0)
                ways.append((cost + cut + 2, "R" + audit))
        return min(ways, default=(10**9, ""))

    return best(0, "", 0)


def apply(rows, audit):
    """The repaired (role, text) rows."""
    out, at, last = [], 0, ""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    for edit in audit:
        if edit in "IR":
            last = after[last]
            out.append(({"u": "user", "a": "assistant"}[last], rows[at][2] if edit == "R" else ""))
        elif edit == "K":
            out.append(rows[at][1:])
            last = rows[at][1][:1]
        at += edit != "I"
    return out


def plain(damaged):
    """rows: conv_id, turn, role, text, there."""
    groups = {}
    for conv, *row in damaged:
        groups.setdefault(conv, []).append(row)
    out = []
    for conv, rows in groups.items():
        rows = sorted((r[:3] for r in rows if r[3]), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {r[0] for r in rows} - {None}
        faults = faults_of(rows)
        cost, audit = cheapest(rows, faults)
        fixed = apply(rows, audit)
        assert WHOLE.fullmatch("".join(r[0][:1] for r in fixed))
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
        text = "\n".join(f"{r}:{t}" for r, t in fixed)
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                sum(p not in ("su", "ua", "au") for p in pairs),
                cost,
                audit,
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return out


def key(rows):
    return sorted((tuple(map(str, r)) for r in rows))


def front_of(rows):
    c = conversations.Conversation()
    for (turn, role, text), fault in zip(rows, faults_of(rows), strict=True):
        c.add((turn, conversations.FAULTS.index(fault), role, text))
    return list(c.edits())


def test_every_short_conversation():
    """All role strings up to five rows with every choice of faults: cost, least string and repaired roles."""
    texts = {"o": "fine.", "t": "cut off", "b": " "}
    for n in range(6):
        for roles in itertools.product(("system", "user", "assistant", "tool"), repeat=n):
            for kinds in itertools.product("otb", repeat=n) if n < 4 else ["o" * n, ("tob" * n)[:n], "t" * n]:
                rows = [(i, r, texts[k] if k == "b" else f"{i} {texts[k]}") for i, (r, k) in enumerate(zip(roles, kinds, strict=True))]
                cost, audit = cheapest(rows, faults_of(rows))
                got = front_of(rows)
                assert "".join(e[0] or "" for e in got) == audit, (roles, kinds)
                assert [(e[4], e[5]) for e in got if e[4] is not None] == apply(rows, audit)


def test_long_conversations_and_few_fronts():
    rng = random.Random(5)
    for n in (50, 400, 3000):
        rows = [(i, rng.choice(("system", "user", "user", "assistant", "x")), rng.choice(("a.", "b", "", f"{i}.", f"{i}"))) for i in range(n)]
        cost, audit = cheapest_long(rows)
        assert "".join(e[0] for e in front_of(rows)) == audit
    assert len(conversations._MOVES) < 5000


def cheapest_long(rows):
    """``cheapest`` without deep recursion."""
    after, faults = {"": "u", "s": "u", "u": "a", "a": "u"}, faults_of(rows)
    table = {"": (0, ""), "a": (0, "")}

    def inserted(t):
        for _ in range(3):
            for s in after:
                if after[s] in t:
                    way = (t[after[s]][0] + 2, "I" + t[after[s]][1])
                    t[s] = min(t.get(s, way), way)
        return t

    table = inserted(table)
    for (_, role, _), fault in zip(reversed(rows), reversed(faults), strict=True):
        now = {}
        for s in after:
            ways = [(table[s][0] + 3, "D" + table[s][1])] if s in table else []
            if fault not in ("blank", "duplicate"):
                cut = fault == "truncated"
                if role[:1] == after[s] or (role[:1] == "s" and s == ""):
                    ways.append((table[role[:1]][0] + cut, "K" + table[role[:1]][1]))
                ways.append((table[after[s]][0] + cut + 2, "R" + table[after[s]][1]))
            if ways:
                now[s] = min(ways)
        table = inserted(now)
    return table[""]


def test_spilled(monkeypatch):
    rows = [(i, "user" if i % 3 else "assistant", f"{i}." if i % 5 else "") for i in range(500)]
    whole = front_of(rows)
    monkeypatch.setattr(conversations, "HELD_BYTES", 3000)
    monkeypatch.setattr(conversations, "HELD_POINTERS", 16)
    assert front_of(rows) == whole


ODD = [
    (1, 0, "user", "a."), (1, 2, "assistant", "b."),
    (2, None, "user", "no turn."), (2, None, None, None), (2, -5, "user", "x"),
    (3, 0, "system", "s."), (3, 0, "system", "s."), (3, 0, "system", "s."),
    (4, 1, "user", ""), (4, 2, "assistant", " \t\n"), (4, 3, "", "."),
    (5, 0, "user", "z" * 3_000_000 + "!"), (5, 1, "assistant", "y" * 3_000_000),
    (None, 0, "user", "none."), (None, None, "assistant", "none."), (None, 9, "ünknown", "é "),
    (6, 0, "user", "same."), (6, 1, "assistant", "same."), (6, 2, "user", "same."),
    (7, -(2**63), "user", "far."), (7, 2**63 - 1, "assistant", "far."),
    (8, 1, "user", "tie b."), (8, 1, "user", "tie a."), (8, 1, "assistant", "tie."),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        "*", *(F.lit("x").alias(n) for n in ("conv", "no_conv", "fault", "nth", "place"))
    )


def test_odd_rows(spark):
    rows = ODD + [(100 + i % 30, i // 30, "user" if i % 7 else "assistant", f"t{i % 11}" + "." * (i % 3)) for i in range(300)]
    rows += [(9_007_199_254_740_993, 0, "user", "wide id.")]
    got = conversations.figures(conversations.repair(conversations.damage(table(spark, rows)), present="present")).collect()
    want = plain(hurt(rows))
    assert {tuple(r)[0] for r in got} == {r[0] for r in rows} and len(got) == len({r[0] for r in rows})
    limit = [tuple(min(v, 2**63 - 1) if i == 1 else v for i, v in enumerate(r)) for r in want]
    assert key(got) == key(limit)


def test_rows_of_a_repair(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "user", "b."), (1, 3, "assistant", "cut")]
    got = sorted(map(tuple, conversations.repair(table(spark, rows)).collect()), key=lambda r: r[1])
    assert [r[2] for r in got] == list("KIKDK")
    assert got[1] == (1, 1, "I", None, None, None, "assistant", "")
    assert got[3] == (1, 3, "D", "duplicate", 2, "user", None, None)
    assert got[4] == (1, 4, "K", "truncated", 3, "assistant", "assistant", "cut")
    gone = conversations.repair(table(spark, rows).withColumn("there", F.col("turn") < -1), present="there").collect()
    assert [tuple(r) for r in gone] == [(1, *(None,) * 7)]
    assert conversations.figures(conversations.repair(table(spark, []))).count() == 0


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = queries.op11_turn_repair(spark, SF)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.columns == names
    assert key(got.collect()) == key(plain(hurt([tuple(r) for r in rows])))
