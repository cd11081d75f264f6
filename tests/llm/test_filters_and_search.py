"""Url filters, ranked search and the filter audit against plain loops."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stationflow.llm import filter_audit, lexical_search, queries, url_filter

# 11


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return host, re.split("[?#]", rest[end:], maxsplit=1)[0]


def plain_verdict(url, rules, default="allow"):
    host, path = plain_parts(url)
    fits = [r for r in rules if host and (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return (host, path, best[0] + best[1], best[2]) if best else (host, path, None, default)


ODD_URLS = [None, "", "x", "http://", "http:///en/", "http://NET", "http://É.Net/x", "a://b?c/d", "a://b#://c/d", "ftp://h.net:80/x", "://net/en", "http://net/\nen?\n", "http://" + "a." * 50_000 + "net/" + "x" * 100_000, "http://..net/", "http://net./", "x://y://z.net/"]


@pytest.mark.parametrize("pass_bytes", [64 << 20, 8])
def test_urls_against_plain_rules(spark, pass_bytes):
    rng = random.Random(4)
    names = ["net", "org", "com", "a", "b", "c", "ä"]
    host = lambda most: ".".join(rng.choices(names, k=rng.randint(1, most)))
    path = lambda most: "".join("/" + rng.choice(["", "x", "yy", "é"]) for _ in range(rng.randint(0, most)))
    rules = [(host(3), path(2), rng.choice(["block", "allow"])) for _ in range(150)]
    urls = [f"http://{host(5)}{path(4)}{rng.choice(['', '?q=/x', '#top'])}" for _ in range(900)] + ODD_URLS + ["http://a.net/x"] * 300
    pages = spark.createDataFrame([(k % 1200 or None, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, host string, key string").repartition(7)
    bad = [(None, "/", "block"), ("", "/", "block"), ("net", "x", "block"), ("a/b", "", "block"), ("com", "/", "deny"), rules[0], ("q.com", None, "allow")]
    table = spark.createDataFrame([(h.upper() if h and k % 2 else h, p, v) for k, (h, p, v) in enumerate([*rules, *bad])], "host string, path string, verdict string")
    got = url_filter.filter_urls(pages, table, pass_bytes=pass_bytes)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    lower = lambda h: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in h)
    rules = [(lower(h.upper() if k % 2 else h), p, v) for k, (h, p, v) in enumerate(rules)] + [("q.com", "", "allow")]
    want = [(k % 1200 or None, *plain_verdict(u, rules)) for k, u in enumerate(urls)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_cascade_is_exact_for_the_universe(spark):
    listed = [f"h{k}.net/" for k in range(400)]
    urls = spark.createDataFrame([(f"h{k}.net", "/x") for k in range(6000)], "host string, path string")
    rules = spark.createDataFrame([(k, "block") for k in listed], "key string, verdict string")
    levels = url_filter.build_cascades(urls, rules, [(2, 1)], 3000)["block"]  # a first level that lets many pass
    assert len(levels) > 2
    assert {k for k in range(6000) if url_filter.is_listed(levels, b"h%d.net/" % k)} == set(range(400))
    assert sum(len(x.bits) for x in levels) < 400 * 4


def test_level_uses_sparks_hash(spark):
    keys = spark.createDataFrame([(f"ключ{k}",) for k in range(3000)], "key string")
    level = url_filter.build_level(keys, 3000, 5, 2)
    assert all(level.holds(f"ключ{k}".encode()) for k in range(3000)) and 8 * len(level.bits) == 32768
    assert sum(level.holds(b"other%d" % k) for k in range(3000)) < 200
    assert level.seeds[0] == xxhash.xxh64_intdigest((128).to_bytes(4, "little"), 42)


def test_url_tables_that_are_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id int, url string")
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert [tuple(r) for r in url_filter.filter_urls(pages, rules.limit(0), default="block").collect()] == [(1, "a.net", "/", None, "block")]


# 12

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, top=20):
    terms = [plain_terms(t) for _, t in docs]
    n_docs, total = sum(bool(t) for t in terms), sum(map(len, terms))
    df = Counter(t for ts in terms for t in set(ts))
    rows = []
    for item, text in items:
        scored = []
        for (doc, _), ts in zip(docs, terms, strict=True):
            tf = Counter(ts)
            m = 100 - 25 + (25 * len(ts) * n_docs) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in plain_terms(text) if tf[t])
            if score > 0:
                scored.append((-score, doc is None, doc))
        rows += [(item, k + 1, doc, -s) for k, (s, _, doc) in enumerate(sorted(scored)[:top])]
    return rows


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(12)
    words = [f"w{k}" for k in range(400)] + ["Ünï", "ÉCOLE", "日本", "A1", "mixed"]
    odds = [1 / (k + 1) for k in range(len(words))]
    docs = [(k, rng.choice([" ", ", ", "\n-", "\x7f"]).join(rng.choices(words, odds, k=rng.choice([1, 5, 60, 400])))) for k in range(700)]
    docs += [(900 + k, docs[3][1]) for k in range(300)] + [(5, docs[5][1]), (None, docs[3][1]), (None, None), (2000, None), (2001, ""), (2002, " .,!"), (2003, " ".join(rng.choices(words, k=300_000)))]
    items = [(k, " ".join(rng.choices(words, k=rng.choice([1, 8, 40])))) for k in range(30)]
    items += [(3, items[3][1]), (None, "w1 w2"), (100, None), (101, ""), (102, "nowhere at all"), (103, "w1 w1 w1"), (104, docs[3][1])]
    return docs, items


def test_search_against_plain_scores(spark, corpus):
    docs, items = corpus
    want = sorted(plain_search(docs, items), key=repr)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item": F.lit("x"), "score": F.lit(1), "term": F.lit(2)})
    i = spark.createDataFrame(items, "item_id int, text string").withColumns({"item": F.lit("x"), "block": F.lit(1)})
    for parts, chars in ((1, 1 << 20), (9, 2000)):
        got = lexical_search.search(d.repartition(parts), i, item_chars=chars)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert lexical_search.search(d.limit(0), i).count() == lexical_search.search(d, i.limit(0)).count() == 0
    assert lexical_search.search(d.where("doc_id in (2000, 2001, 2002)"), i).count() == 0


def test_bounds_hold_and_save_work(corpus):
    docs, items = corpus
    docs = [(k, t) for k, t in docs if t]
    counts = [lexical_search.term_counts(t) for _, t in docs]
    assert all(c == Counter(x.encode() for x in plain_terms(t)) for c, (_, t) in zip(counts, docs, strict=True))
    stats = lexical_search.Corpus(sum(map(bool, counts)), sum(c.total() for c in counts), Counter(t for c in counts for t in c))
    asked = lexical_search.Asked([(k, lexical_search.term_counts(t)) for k, (_, t) in enumerate(items)], stats)
    cells, sketches = lexical_search.Cells(), np.zeros((len(docs), lexical_search.CELLS), np.float32)
    for c, row in zip(counts, sketches, strict=True):
        lexical_search.sketch(c, stats.length(c.total()), cells, row)
    bounds = asked.bounds(sketches)
    scores = np.array([[asked.score(k, c, stats.length(c.total())) for k in range(len(items))] for c in counts])
    assert (bounds >= scores).all()
    leaders = lexical_search.Leaders(len(items), 20)
    looked = sum(lexical_search.search_block(asked, stats, *map(list, zip(*docs[at : at + 100], strict=True)), cells, leaders) for at in range(0, len(docs), 100))
    assert looked < 0.5 * len(docs) * len(items)


def test_terms_of_a_text_in_pieces(monkeypatch):
    monkeypatch.setattr(lexical_search, "TEXT_BYTES", 7)
    for text in ("a" * 50, "ab cd" * 20, " ", "é ü.x" * 9, "end "):
        assert lexical_search.term_counts(text) == Counter(x.encode() for x in plain_terms(text))


# 13


def plain_fails(docs):
    rows = []
    for doc, text, part in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = ("A" * (len(words) < 50), "B" * (100 * len(set(words)) < 65 * len(words)), "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)), "D" * bool(re.search(r"[#$%&*|]", text)))
        copy = doc is not None and any(o is not None and o < doc and (t or "") == text for o, t, _ in docs)
        rows.append((part or "", "".join(fails) + "E" * copy))
    return rows


def plain_audit(rows, filters):
    out = []
    for part in {p for p, *_ in rows}:
        own = [r for r in rows if r[0] == part]
        total = Counter()
        steps = []
        for order in permutations(filters):
            left = list(own)
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                redundant = sum(f in r[1] for r in own) - len(gone)
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                steps.append((part, "".join(order), k + 1, len(left), len(gone), redundant, sum(r[1] == f for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone), f))
        out += [(*s[:-1], total[s[-1]]) for s in steps]
    return out


def test_text_failures_against_plain_rules(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{k}" for k in range(rng.choice([5, 90]))] + ["ABC", "É", "a#b"][: rng.randint(0, 3)], k=rng.choice([0, 10, 49, 50, 51, 120]))) for _ in range(150)]
    texts += ["x" * 95 + "ABCDE", "x" * 94 + "ABCDEF", "\x0b a\x0c", "é" * 60, " ".join(["One"] * 200_000), "a\u2003b " * 30]
    docs = [(k, t, f"s{k % 3}") for k, t in enumerate(texts)] + [(500 + k, texts[9], "s0") for k in range(200)]
    docs += [(9, texts[9], "s1"), (None, texts[9], None), (None, None, "s1"), (800, None, "s2"), (801, "", ""), (3, texts[3], "s0")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({"digest": F.lit("x"), "fails": F.lit(1), "t": F.lit(2), "part": F.lit(3), "words": F.lit(4)})
    got = filter_audit.text_failures(df.repartition(5)).collect()
    letters = lambda bits: "".join(c for k, c in enumerate("ABCDE") if bits >> k & 1)
    assert Counter((r.doc_id, r.part, letters(r.fails)) for r in got) == Counter((d, *x) for (d, *_), x in zip(docs, plain_fails(docs), strict=True))


@pytest.mark.parametrize("n", [1, 3, 5])
def test_audit_against_every_order(spark, n):
    rng = random.Random(n)
    filters = "ABCDE"[:n]
    rows = [(rng.choice(["x", "y", ""]), "".join(c for c in filters if rng.random() < 0.4), rng.random() < 0.5, rng.random() < 0.2) for _ in range(300)] + [("clean", "", True, False)]
    df = spark.createDataFrame([(p or None, sum(1 << ord(c) - 65 for c in f), g, t, 1) for p, f, g, t in rows], "part string, fails int, good boolean, toxic boolean, state int")
    got = filter_audit.audit_filters(df, n)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_audit(rows, filters))
    assert filter_audit.audit_filters(df.limit(0), n).count() == 0


def test_path_counts():
    for n in (1, 4, 6):
        edges = filter_audit.lattice(n)
        fact = math.factorial
        assert len(edges) == n << n - 1
        assert all(e.paths == fact(e.state.bit_count()) * fact(n - 1 - e.state.bit_count()) for e in edges)


def test_labels_of_odd_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (4, "d")], "doc_id long, part string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (4, 0, 1)], "doc_id int, quality int, toxic int")
    got = sorted(map(tuple, filter_audit.with_labels(rows, labels).collect()), key=repr)
    assert got == sorted([(1, "a", True, True)] * 2 + [(2, "b", False, False), (None, "c", False, False), (4, "d", False, True)], key=repr)


@pytest.mark.parametrize("name", ["op11_url_filter", "op12_lexical_search", "op13_filter_audit"])
def test_query_equals_its_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    found = con.execute(f"select {', '.join(cols)} from ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(found, key=repr)


# Mended in this round: time of scans, vectors of any size, families of similar texts alone


@pytest.mark.parametrize("line", ["-----BEGIN RSA KEY-----\n", "LS0tLS1CRUdJTi", "LS0tLS1CRUdJTiBSU0EgS0VZLS0tLS0K", "-----BEGIN A KEY-----\nAAAA\n-----END B KEY-----\n", "MII/", "LS0tLS1CRUdJTg==\n"])
def test_repeated_openers_take_linear_time(line):
    import time

    from stationflow.llm import secret_scan

    text = line * (4_000_000 // len(line))
    began = time.process_time()
    assert not [k for k, *_ in secret_scan.find_secrets(text) if k in secret_scan.CONFIRMED]
    assert time.process_time() - began < 20


def test_key_after_a_stray_opener():
    import base64

    from stationflow.llm import secret_scan

    number = lambda n: bytes([2, n]) + b"\x11" * n
    inner = bytes([2, 1, 0]) + b"".join(number(20) for _ in range(8))
    body = base64.b64encode(bytes([0x30, 0x81, len(inner)]) + inner).decode()
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    stray = "-----BEGIN RSA PRIVATE KEY-----\n"
    assert [x for x in secret_scan.find_secrets(stray + pem) if x[0] == "pem"] == [("pem", len(stray), len(stray) + len(pem))]
    for pad in ("", "a", "bc"):  # each way to divide the signs, after a certificate
        encoded = base64.b64encode(f"-----BEGIN CERTIFICATE-----\n{pad}AAAA\n-----END CERTIFICATE-----\n{pem}".encode()).decode()
        assert ("pem", 2, 2 + len(encoded)) in secret_scan.find_secrets(f"x {encoded}\n")


def test_cosines_of_extreme_vectors(spark):
    from stationflow.llm import ann

    gen = np.random.default_rng(4)
    v = gen.standard_normal((40, 8))
    u = v / np.linalg.norm(v, axis=1)[:, None]
    size = np.array([1e-200, 1.0, 1e200, 1e-300] * 10)[:, None]
    assert np.allclose(ann.cosine(v * size, (v * size)[::-1]), (u * u[::-1]).sum(1), atol=1e-12)
    assert (ann.cosine(v, v[::-1]) == ann.cosine(v * 2.0**300, v[::-1] * 2.0**-300)).all()
    df = spark.createDataFrame([(k, [float(c) for c in x]) for k, x in enumerate(v * size)], "vec_id long, embedding array<double>")
    got = [r.vec_id for r in ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [k for k in np.argsort(-(u @ u[0]), kind="stable") if k != 0][:5]


def test_random_fingerprints_make_no_families(spark):
    """A budget under which unrelated fingerprints would all be one family: only planted pairs, which are near in the check words too, are linked."""
    from stationflow.llm import simhash_dedup

    gen = np.random.default_rng(9)
    n = 3000
    fp, c1, c2 = (gen.integers(0, 1 << 63, n, np.int64) for _ in range(3))
    fp &= np.int64((1 << 50) - 1)  # all agree in one block
    flip = lambda x, k: x ^ np.bitwise_or.reduce(np.int64(1) << gen.choice(40, k, replace=False))
    for k in range(0, 200, 2):  # near in all words, 100 pairs
        fp[k + 1], c1[k + 1], c2[k + 1] = flip(fp[k], 9), flip(c1[k], 12), flip(c2[k], 12)
    fp[300:340] = fp[300]  # equal words of unrelated texts, and of like ones
    c1[320:340], c2[320:340] = c1[320], c2[320]
    rows = spark.createDataFrame([(int(k), int(a), int(b), int(c)) for k, (a, b, c) in enumerate(zip(fp, c1, c2, strict=True))], "node long, fp long, c1 long, c2 long")
    def classes(df):
        root = list(range(n))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for r in simhash_dedup.near_links(df, 20).collect():
            a, b = sorted((find(r.src), find(r.dst)))
            root[b] = a
        return Counter(find(k) for k in range(n))

    assert max(classes(rows.drop("c1", "c2")).values()) > 0.9 * n
    found = classes(rows)  # of two million pairs that are near in the word some thirty are in the check words too
    assert all(found[k] in (2, 3) for k in range(0, 200, 2)) and found[320] in (20, 21)
    assert sorted(found.values())[-2] <= 4 and sum(m > 1 for m in found.values()) < 150


def test_kept_rows_with_clashing_names(spark):
    from stationflow.llm import near_copies

    rng = random.Random(3)
    a, b = (" ".join(rng.choices([f"w{k}" for k in range(500)], k=80)) for _ in range(2))
    names = ["__id", "__mark", "__m", "__row", "copy_id_0", "COPY_MARK_0", "node", "root", "n", "a.b"]
    docs = spark.createDataFrame([(k, t, *([k] * len(names))) for k, t in ((1, a), (2, a), (3, b), (3, b), (4, None), (5, ""))], "doc_id long, text string, " + ", ".join(f"`{c}` long" for c in names))
    got = near_copies.keep_one_copy(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted((k, t, *([k] * len(names))) for k, t in ((1, a), (3, b), (4, None)))
