"""URL filters and WARC archives against plain versions."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from riskrank.llm import queries, url_filter, warc
from riskrank.llm.common import Workspace
from riskrank.llm.url_filter import Rule

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(url_filter.UPPER, url_filter.LOWER)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([len(rest), *(rest.find(c) for c in "/?#" if c in rest)])
    path = rest[at:]
    stop = min([len(path), *(path.find(c) for c in "?#" if c in path)])
    return rest[:at].translate(LOWER), path[:stop]


def rule_of(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host + r.path), r.verdict), default=None)


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").select(
        "*", *(F.lit("x").alias(n) for n in ("host", "path", "rule", "payload", "refers_to", "src", "n"))
    )


URLS = [
    None, "", "example.net/en/", "http://", "HTTP://EXAMPLE.NET/en/x?y#z", "http://a.example.net/en/", "http://notexample.net/en/",
    "http://net", "http://net/", "x://É.NET/a", "http://example.com/de/?q=://x", "http://example.com/en", "http://a.org/fr/b", "http://org/fr",
    "http://a.org?fr/", "http://b.org#/fr/", "a://b://net/", "http://x\n.net/\ny", "http://u@Example.com:80/de/", "http://.net/",
]


def test_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(3, URLS[3], ""), (None, URLS[5], "x")]
    got = url_filter.filter_urls(pages_of(spark, rows), Workspace(spark), queries.URL_RULES).collect()
    assert len(got) == len(rows)
    seen = {r.page_id: r for r in got}
    for i, u, _ in rows[: len(URLS)]:
        rule, r = rule_of(u, queries.URL_RULES), seen[i]
        assert (r.host, r.path) == parts(u), u
        assert r.rule == (rule and rule.host + rule.path), u
        assert r.verdict == (rule.verdict if rule else "allow"), u
    none = url_filter.filter_urls(pages_of(spark, []), Workspace(spark), queries.URL_RULES)
    assert none.count() == 0


def test_rules_over_the_table(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()
    got = {r.page_id: r for r in queries.op5_link_propagation(spark, SF).collect()}
    assert len(got) == len(rows)
    hosts, ruled, edges = {}, {}, {}
    for r in rows:
        host, rule = parts(r.url)[0], rule_of(r.url, queries.URL_RULES)
        if host:
            hosts[host] = hosts.get(host, 0) + 1
            if rule:
                ruled[host, rule.verdict] = ruled.get((host, rule.verdict), 0) + 1
        for link in re.findall(url_filter.LINK[4:], r.html or "", re.I):
            to = parts("http:" + link if link.startswith("//") else link)[0]
            if to and host and to != host and re.match(r"//|[A-Za-z][A-Za-z0-9+.-]*://", link):
                edges[host, to] = edges.get((host, to), 0) + 1
    seeds = {v: {h: n for (h, w), n in ruled.items() if w == v and 2 * n > hosts[h]} for v in ("allow", "block")}
    seeds = {v: {h: n / sum(s.values()) for h, n in s.items()} for v, s in seeds.items()}
    trust, distrust = power(edges, seeds["allow"]), power({(b, a): w for (a, b), w in edges.items()}, seeds["block"])
    for r in rows:
        host, rule, g = parts(r.url)[0], rule_of(r.url, queries.URL_RULES), got[r.page_id]
        assert (g.host, g.path, g.rule) == (*parts(r.url), rule and rule.host + rule.path)
        blocked = distrust.get(host, 0) > max(trust.get(host, 0), 1 / len(hosts))
        assert g.verdict == (rule.verdict if rule else "block" if blocked else "allow")


def power(edges, seeds, rounds=300):
    hosts = {h for e in edges for h in e} | set(seeds)
    total = {}
    for (a, _), w in edges.items():
        total[a] = total.get(a, 0) + w
    score = dict(seeds)
    for _ in range(rounds):
        got = dict.fromkeys(hosts, 0.0)
        for (a, b), w in edges.items():
            got[b] += 0.85 * score.get(a, 0.0) * w / total[a]
        back = 1 - sum(got.values())
        score = {h: got[h] + back * seeds.get(h, 0.0) for h in hosts}
    return score


def test_propagation(spark):
    r = random.Random(2)
    hosts = [f"h{i}.com" for i in range(12)] + ["good.org", "bad.net", "worse.net"]
    edges, rows = {}, []
    for i in range(200):
        a, b = r.choice(hosts), r.choice(hosts)
        if a == "good.org" and b.endswith(".net"):
            continue
        link = r.choice([f'<a href="http://{b.upper()}/x">', f"<A HREF = '//{b}?q'>", f"<a class=x href=https://{b}#t>"])
        rows.append((i, f"http://{a}/{i}", f'<p>{link}</a><a href="/own"><a href="mailto:x@y">'))
        if a != b:
            edges[a, b] = edges.get((a, b), 0) + 1
    rules = [Rule("allow", "good.org", "/"), Rule("block", "net", "/")]
    got = url_filter.filter_urls(pages_of(spark, rows), Workspace(spark), rules).collect()
    pages = {}
    for _, u, _ in rows:
        pages[parts(u)[0]] = pages.get(parts(u)[0], 0) + 1
    bad = {h: pages.get(h, 0) for h in ("bad.net", "worse.net")}
    trust = power(edges, {"good.org": 1.0})
    distrust = power({(b, a): w for (a, b), w in edges.items()}, {h: n / sum(bad.values()) for h, n in bad.items()})
    verdicts = set()
    for row in got:
        assert abs(row.trust - trust.get(row.host, 0)) < 1e-4 and abs(row.distrust - distrust.get(row.host, 0)) < 1e-4
        if row.rule is None:
            blocked = distrust.get(row.host, 0) > max(trust.get(row.host, 0), 1 / len(pages))
            assert row.verdict == ("block" if blocked else "allow")
            verdicts.add(row.verdict)
    assert verdicts == {"allow", "block"}


def test_propagation_reaches_hosts_far_from_the_seed(spark):
    chain = [f"c{i}.com" for i in range(41)]
    rows = [(i, f"http://{chain[i + 1]}/", f'<a href="http://{chain[i]}/">') for i in range(40)]
    rows += [(100, f"http://{chain[0]}/", ""), *((1000 + i, f"http://n{i}.org/", "") for i in range(3000))]
    got = url_filter.filter_urls(pages_of(spark, rows), Workspace(spark), [Rule("block", chain[0], "/")]).where("page_id < 1000").collect()
    distrust = power({(a, b): 1 for a, b in zip(chain[:-1], chain[1:], strict=True)}, {chain[0]: 1.0})
    assert len(got) == 41
    for row in got:
        assert abs(row.distrust - distrust[row.host]) < 0.01 / 3041
        if row.rule is None:
            assert row.verdict == ("block" if distrust[row.host] > 1 / 3041 else "allow")
    assert any(row.page_id >= 31 and row.page_id < 100 and row.verdict == "block" for row in got)


def other(name, payload, *, algorithm="sha1", form="base32", http=True, kind="response"):
    """A record as other writers write it."""
    import base64

    block = (b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n" if http else b"") + payload
    digest = hashlib.new(algorithm, block).digest()
    text = base64.b32encode(digest).decode().rstrip("=") if form == "base32" else digest.hex().upper()
    lines = [
        "WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Target-URI: http://o/{name}?\\x", "WARC-Date: 2020-01-01T00:00:00Z",
        f"Content-Type: {'application/http; msgtype=response' if http else 'text/plain'}", f"content-length: {len(block)}", f"WARC-Block-Digest: {algorithm}:{text}",
    ]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_archives_of_other_writers():
    kinds = [
        {}, {"form": "hex"}, {"algorithm": "sha256"}, {"algorithm": "sha256", "form": "hex"}, {"algorithm": "md5"},
        {"algorithm": "sha512", "form": "hex"}, {"http": False}, {"kind": "warcinfo", "http": False},
    ]
    payloads = [f"payload {i} é".encode() * 20 for i in range(len(kinds))]
    whole = [other(i, p, **k) for i, (p, k) in enumerate(zip(payloads, kinds, strict=True))]
    files = [
        b"".join(whole), b"".join(map(warc.member, whole)), warc.member(b"".join(whole)),
        warc.member(b"".join(whole[:3])) + b"".join(whole[3:5]) + warc.member(b"".join(whole[5:])),
    ]
    for data in files:
        found = list(warc.salvage(data))
        assert [x[0] for x in found] == ["record"] * len(kinds)
        assert [x[3]["payload"] for x in found] == payloads
        assert [x[3]["payload_digest"] for x in found] == [hashlib.sha1(p).hexdigest() for p in payloads]
        assert [x[1] for x in found] == [0, *(x[2] for x in found[:-1])] and found[-1][2] == len(data)
    # A digest that does not fit is damage in either form; the records beside it in a member stay.
    broken = whole[1].replace(b"payload 1", b"payload X", 1)
    found = list(warc.salvage(warc.member(whole[0] + broken) + warc.member(whole[2])))
    assert [(x[0], x[3] if x[0] == "gap" else x[3]["payload"]) for x in found] == [
        ("record", payloads[0]), ("gap", "block digest differs"), ("record", payloads[2])
    ]
    assert [x[1] for x in found] == [0, *(x[2] for x in found[:-1])]


def test_a_quoted_record_is_no_record():
    """The payload of a damaged record holds a whole record: its own length tells where the next one begins."""
    inner = warc.record(77, "http://inner", b"inner payload", None)
    outer, after = warc.record(1, "http://outer", b"before " + inner + b" after", None), warc.record(2, "http://after", b"x", None)
    for damaged in (b"X" + outer[1:], outer.replace(b"sha1:", b"sha1;", 1).replace(b"before", b"beFore", 1)):
        found = list(warc.salvage(damaged + after))
        assert [(x[0], x[0] == "record" and (x[3]["page_id"], x[3]["after_gap"])) for x in found] == [("gap", False), ("record", (2, False))]
    # Where the length is lost too, what is found is marked.
    lost = (b"X" + outer[1:]).replace(b"\nContent-Length: ", b"\nContent-Lxngth: ", 1)
    records = [x[3] for x in warc.salvage(lost + after) if x[0] == "record"]
    assert [(r["page_id"], r["after_gap"]) for r in records] == [(77, True), (2, True)]


def test_revisits_name_their_response(spark):
    rows = [(1, "http://a", "y" * 2000), (2, "http://b", "y" * 2000)]
    manifest = warc.write_archives(pages_of(spark, rows), Workspace(spark), compressed=False)
    with open(manifest.first().file.removeprefix("file:"), "rb") as f:
        text = f.read().decode()
    ids = {re.search(r"WARC-Type: (\w+)", part)[1]: part for part in text.split("WARC/1.1\r\n")[1:]}
    name = re.search(r"WARC-Record-ID: (\S+)", ids["response"])[1]
    assert f"WARC-Refers-To: {name}" in ids["revisit"] and "HTTP/1.1 200 OK" in ids["response"]


def archive_rows():
    r = random.Random(3)
    long = ["".join(r.choices("abé<>\r\n WARC/1.1", k=r.randint(990, 3000))) for _ in range(6)]
    rows = [(i, f"http://x/{i}\r\né", r.choice(long)) for i in range(40)]
    rows += [(100, None, None), (101, "", ""), (102, "u", "short"), (103, "u", "short"), (104, "u", "é" * 500), (105, "u", "é" * 500)]
    return rows + [rows[39], rows[0], (None, "n", long[0]), (106, "u", "x" * 999), (107, "u", "x" * 999)]


def plain_records(rows):
    last = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if i is not None and len(data) >= 1000:
            last[data] = max(i, last.get(data, i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = last.get(data)
        revisit = i is not None and to is not None and to != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def test_archives(spark):
    for compressed in (True, False):
        manifest = warc.write_archives(pages_of(spark, archive_rows()), Workspace(spark), file_bytes=5000, compressed=compressed)
        read = warc.read_archives(manifest)
        assert warc.gaps(read).count() == 0
        got = warc.records(read).collect()
        digest = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
        assert sorted(digest, key=str) == plain_records(archive_rows())
        urls = {i: u for i, u, _ in archive_rows()}
        html = {i: h for i, _, h in archive_rows()}
        for r in got:
            assert r.url == urls[r.page_id]
            assert bytes(r.payload) == (b"" if r.record_type == "revisit" else (html[r.page_id] or "").encode())
    assert warc.read_archives(warc.write_archives(pages_of(spark, []), Workspace(spark))).count() == 0


def test_archive_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, queries.op8_warc_salvage(spark, SF).collect()), key=str) == plain_records(rows)


def test_salvage():
    rows = archive_rows()[:30]
    plain = [warc.record(i, u, (h or "").encode(), None) for i, u, h in rows]
    r = random.Random(5)
    for compressed in (True, False):
        blocks = [warc.member(x) if compressed else x for x in plain]
        whole = b"".join(blocks)
        ends = [0]
        for b in blocks:
            ends.append(ends[-1] + len(b))
        assert [x[3]["page_id"] for x in warc.salvage(whole)] == [i for i, _, _ in rows]
        for _ in range(60):
            data, hit = bytearray(whole), r.sample(range(30), 3)
            for k in hit:
                at = r.randrange(ends[k], ends[k + 1])
                data[at] ^= 1 << r.randrange(8)
            found = list(warc.salvage(bytes(data)))
            assert [x[1] for x in found] == [0, *(x[2] for x in found[:-1])] and found[-1][2] == len(data)
            kept = {x[3]["page_id"] for x in found if x[0] == "record"}
            # A record whose neighbour's end was hit is found again at its own beginning.
            assert {i for k, (i, _, _) in enumerate(rows) if k not in hit} <= kept | {None}
            assert len([x for x in found if x[0] == "gap"]) >= (1 if compressed else 0)
        cut = list(warc.salvage(whole[: ends[10] + 7]))
        assert len(cut) == 11 and cut[-1][0] == "gap"
        junk = list(warc.salvage(whole[: ends[2]] + b"\x1f\x8b\x08junk" + whole[ends[2] :]))
        assert len([x for x in junk if x[0] == "record"]) == 30 and len([x for x in junk if x[0] == "gap"]) == 1
    assert list(warc.salvage(b"")) == []


def test_salvage_of_a_damaged_beginning():
    r = random.Random(6)
    pages = ["".join(map(chr, r.choices(range(32, 1000), k=9000))) for _ in range(6)]
    plain = [warc.record(i, f"http://x/{i}", h.encode(), None) for i, h in enumerate(pages)]
    for blocks in ([warc.member(x) for x in plain], plain):
        whole = b"".join(blocks)
        assert len(blocks[0]) > 8192
        for damaged in (b"\x00" + whole[1:], whole[:2] + b"\xff" + whole[3:], bytes(4096) + whole[4096:], b"\x1f\x8b\x08" + whole[3:100] + bytes(5000) + whole[5100:]):
            found = list(warc.salvage(damaged))
            assert [x[3]["page_id"] for x in found if x[0] == "record"] == [1, 2, 3, 4, 5]
            assert [x[:3] for x in found if x[0] == "gap"] == [("gap", 0, len(blocks[0]))]
