"""URL rules, source divergence and lexical search against brute force on small tables."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from yieldmill.llm import divergence, lexical_search, transducer, url_rules
from yieldmill.llm.terms import splitter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SIGNS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

# --- terms ---------------------------------------------------------------------


def test_terms_are_the_matches_of_the_pattern():
    rng = random.Random(1)
    alphabet = [chr(i) for i in range(128)] + ["é", "\u0085", "\u00a0", "İ", "ß", "漢", "\U0001f600"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(60))
        for pattern, digits in ((LETTERS, False), (SIGNS, True)):
            want = [term.translate(LOWER).encode() for term in pattern.findall(text)]
            assert splitter(digits)(text.encode()) == want
    assert splitter(True)(None) == splitter(True)(b"") == splitter(False)(b" 12 \n") == []


# --- url rules -----------------------------------------------------------------


def split_url(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def judged(url, rules, default="allow"):
    host, path = split_url(url)
    fits = [
        (len(h + p), len(h), h + p, v)
        for (h, p), v in rules.items()
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


def test_url_rules_equal_brute_force(spark):
    rng = random.Random(3)
    labels = ["a", "b", "net", "Net", "x-y", "", "é"]
    host = lambda most: ".".join(rng.choice(labels) for _ in range(rng.randint(1, most)))
    path = lambda: "".join(rng.choice(["/", "a", "/a", "/b/", "é", "/a/b"]) for _ in range(rng.randint(0, 5)))
    urls = [None, "", "no scheme", "x://", "://net", "http://u:p@a.net:80/a?b/c#d", "http://a.net?://b/", "a://b\nc/d\ne",
            "http://" + "a." * 3000 + "net/" + "a/" * 20000]
    urls += ["http://a.net/a/b"] * 400  # a url that many rows hold
    urls += [f"http://{host(5)}{path()}{rng.choice(['', '?q', '#f'])}" for _ in range(600)]
    given = [(rng.choice(["", host(3)]), path(), rng.choice(["block", "allow"])) for _ in range(60)]
    given += given[:9] + [("a.net", "/a", "allow"), ("A.Net", "/a", "block"), ("net", "/none", None)]
    rules = {}
    for h, p, verdict in given:
        if verdict is not None:
            key = (h.translate(LOWER), p)
            rules[key] = "block" if "block" in (verdict, rules.get(key)) else "allow"
    rows = [(i, url, "x", "y") for i, url in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, key string").repartition(7)
    rule_rows = spark.createDataFrame(given + [(None, None, None)], "host string, path string, verdict string")
    out = url_rules.judge(pages, rule_rows, default="block")
    assert out.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    for i, url in enumerate(urls):
        want = judged(url, rules, "block")
        assert got[i][:2] == want[:2] and got[i][3] == want[3], url
        assert (got[i][2] is None) == (want[2] is None) and len(got[i][2] or "") == len(want[2] or ""), url
    # Repeated and null ids stay rows of their own; without rules the default holds.
    twice = pages.filter("page_id < 3").withColumn("page_id", F.lit(None).cast("long"))
    assert [r.verdict for r in url_rules.judge(twice, rule_rows.limit(0)).collect()] == ["allow"] * 3
    assert url_rules.judge(pages.limit(0), rule_rows).count() == 0
    wrong = spark.createDataFrame([("net", "/", "drop")], "host string, path string, verdict string")
    with pytest.raises(Exception, match="not drop"):
        url_rules.judge(pages, wrong).collect()


def test_rules_reach_every_part_of_their_interval():
    rng = random.Random(9)
    keys = sorted(("".join(rng.choice(["a.", "b.", "ab."]) for _ in range(3)), rng.choice(["", "/", "/a", "/ab"]), i)
                  for i in range(300))
    cuts = [keys[i] for i in (20, 21, 60, 61, 62, 100, 170, 240)]
    part = lambda key: sum(cut <= key for cut in cuts)
    for host in ("", "a.", "a.b.", "ab.", "b.a.ab."):
        for path in ("", "/", "/a", "/z"):
            reached = {part(k) for k in keys if k[0].startswith(host) and k[1].startswith(path)}
            assert reached <= set(url_rules.parts_of(host, path, cuts))


# --- divergence ----------------------------------------------------------------


def test_transducer_is_minimal_and_orders():
    rng = random.Random(2)
    terms = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))).encode() for _ in range(800)})
    machine = transducer.Transducer.load(transducer.build(terms).dump())
    others = [term + b"x" for term in terms[:50]] + [term[:-1] for term in terms[:50] if term[:-1] not in terms] + [b""]
    found = machine.ordinals([*terms, *others])
    assert found.tolist() == [*range(len(terms)), *[-1] * len(others)]
    # One state for each different set of endings.
    prefixes = {term[:k] for term in terms for k in range(len(term) + 1)}
    futures = {frozenset(t[len(p):] for t in terms if t.startswith(p)) for p in prefixes}
    assert len(machine.final) == len(futures)
    nothing = transducer.build([])
    assert nothing.ordinals([b"a", b""]).tolist() == [-1, -1] and nothing.ordinals([]).tolist() == []
    assert transducer.build([b""]).ordinals([b"", b"a"]).tolist() == [0, -1]
    for bad in ([b"b", b"a"], [b"a", b"a"]):
        with pytest.raises(ValueError):
            transducer.build(bad)


def plain_audit(rows, least=10, top=10):
    docs = [(lang or "", source or "", [t.translate(LOWER) for t in LETTERS.findall(text or "")]) for text, lang, source in rows]
    seen, n, langs = Counter(), defaultdict(Counter), defaultdict(Counter)
    for lang, _, terms in docs:
        seen.update((lang, t) for t in set(terms))
    groups = {(lang, source) for lang, source, _ in docs}
    kept = {lang: sorted((t for k, t in seen if k == lang and seen[k, t] >= least), key=str.encode) for lang, _ in groups}
    for lang, source, terms in docs:
        counts = Counter(t for t in terms if t in set(kept[lang]))
        n[lang, source].update(counts)
        langs[lang].update(counts)
    share = lambda counts, t, lang: 1 + 10**9 * (counts[t] + 2) // (sum(counts.values()) + 2 * len(kept[lang]))
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang, source in groups:
        p = {t: share(n[lang, source], t, lang) for t in kept[lang]}
        pairs = []
        for _, other in (g for g in groups if g[0] == lang and g[1] != source):
            pairs.append((-sum(f(p[t], share(n[lang, other], t, lang)) for t in kept[lang]), other.encode(), other))
        q = {t: share(langs[lang], t, lang) for t in kept[lang]}
        terms = [(-f(p[t], q[t]), t.encode(), t) for t in kept[lang] if n[lang, source][t] > 0 and p[t] > q[t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(items, 1)]
    return sorted(out)


SCHEMA = "text string, lang string, source string, term string, n long"


def audit_rows():
    rng = random.Random(4)
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(60)] + ["É", "é", "漢字", "Z"]
    rows = [(None, "en", "a"), ("", None, None), ("1 2 3", "xx", "only"), ("lone words", "yy", "p"), ("", "yy", "q")]
    for i in range(160):
        lang, source = ["en", "de", None][i % 3], ["a", "b", "c", None, "ä"][rng.randrange(5)]
        few = words[: 20 + 8 * rng.randrange(6)]
        rows.append((" ".join(rng.choice(few) for _ in range(rng.randrange(40))), lang, source))
    return rows + rows[20:30] + [(" ".join(words * 300), "en", "a")]


@pytest.mark.parametrize("shard, sent, width, held", [(1 << 17, 1 << 25, 1024, 1 << 18), (7, 1, 5, 10)])
def test_divergence_equals_brute_force(spark, monkeypatch, shard, sent, width, held):
    """Also with small shards and blocks and many loads, as a large vocabulary has."""
    monkeypatch.setattr(divergence, "SHARD_TERMS", shard)
    monkeypatch.setattr(divergence, "SENT_BYTES", sent if sent > 1 else 4000)
    monkeypatch.setattr(divergence, "WIDTH", width)
    monkeypatch.setattr(divergence, "HELD", held)
    rows = audit_rows()
    docs = spark.createDataFrame([(*row, "t", 1) for row in rows], SCHEMA).repartition(5)
    out = divergence.audit(docs)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in out.collect()) == plain_audit(rows)


def test_counts_travel_by_block(spark, monkeypatch):
    """A task sends a row for each source and block of terms, not for each source and term."""
    monkeypatch.setattr(divergence, "WIDTH", 16)
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    rows = [(w, "en", s) for s in ("a", "b") for w in (" ".join(words), " ".join(words[::2]), "other")]
    texts = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    texts = texts.select("lang", "source", F.col("text").cast("binary").alias("text"))
    terms = spark.createDataFrame([("en", w.encode(), k) for k, w in enumerate(words, 1)], "lang string, term binary, ordinal long")
    load = [(r.lang, r.first, r.least, r.data) for r in divergence.shards(terms).collect()]
    cells = divergence._stream(texts, load)
    # Ordinals 1 to 64 lie in blocks 0 to 4; before, 128 rows travelled.
    assert sorted((r.source, r.block) for r in cells.collect()) == [(s, b) for s in "ab" for b in range(5)]
    want = [("en", s, k, 1 + k % 2, 2 * (1 + k % 2)) for s in "ab" for k in range(1, 65)]
    assert sorted(tuple(r) for r in divergence.summed(cells.unionByName(cells.limit(0))).collect()) == want


def test_words_are_counted_by_number(monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    monkeypatch.setattr(divergence, "WAITING", 200)
    held = divergence.Numbered()
    held.add("en", "a", [])
    assert not held.of and not held.full()
    held.add("en", "a", [b"x", b"y", b"x"])
    held.add("en", "b", [b"z", b"x"])
    held.add("de", "a", [b"z"])
    assert held.full()  # four distinct ones
    got = {}
    for lang, terms, sources in held.empty():
        for source, (found, n) in sources.items():
            got[lang, source] = {terms[k]: t for k, t in zip(found.tolist(), n.tolist())}
    assert got == {("en", "a"): {b"x": 2, b"y": 1}, ("en", "b"): {b"z": 1, b"x": 1}, ("de", "a"): {b"z": 1}}
    assert not held.of and not held.words and not held.full()
    held.add("en", "a", [b"x"] * 200)
    assert held.full()  # many words


def test_divergence_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert divergence.audit(empty).count() == 0
    bare = spark.createDataFrame([(None, "en", s, "t", 1) for s in ("a", "b", "b", None)], SCHEMA)
    got = sorted(tuple(r) for r in divergence.audit(bare).collect())
    assert got == plain_audit([(None, "en", s) for s in ("a", "b", "b", None)]) and len(got) == 6


# --- lexical search ------------------------------------------------------------


def plain_search(docs, items, k):
    texts = [(i, Counter(t.translate(LOWER) for t in SIGNS.findall(text or ""))) for i, text in docs]
    texts = [(i, terms, sum(terms.values())) for i, terms in texts if terms]
    count, length = len(texts), sum(n for _, _, n in texts)
    df = Counter(t for _, terms, _ in texts for t in terms)
    out = []
    for item, text in items:
        asked = Counter(t.translate(LOWER) for t in SIGNS.findall(text or ""))
        scores = []
        for i, terms, n in texts:
            m, score = 25 + 75 * n * count // length, 0
            for t, times in asked.items():
                if t in terms:
                    weight = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += times * weight * (10**9 * terms[t] // (1000 * terms[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def search_rows():
    rng = random.Random(6)
    words = [f"t{i}" for i in range(50)] + ["É", "x9"]
    text = lambda n: " ".join(rng.choice(words[: rng.randint(5, 52)]) for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(120)]
    docs += [(200 + i, docs[3][1]) for i in range(30)] + [(None, docs[3][1]), (5, docs[5][1]), (900, None), (901, "--")]
    docs.append((902, text(20000)))
    items = [(i, text(12)) for i in range(25)] + [(3, text(5)), (None, "t1 t2 t2"), (40, None), (41, "..."), (42, "absent"),
                                                (43, docs[3][1]), (44, text(4000))]
    return docs, items


@pytest.mark.parametrize("block, cells", [(1 << 20, 1 << 18), (16, 3)])
def test_search_equals_brute_force(spark, monkeypatch, block, cells):
    """Also in many small blocks of items."""
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block if block > 16 else 3000)
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    docs, items = search_rows()
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, item int, score int")
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    out = lexical_search.search(d.repartition(5), b, k=7)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain_search(docs, items, 7)
    for some, asked in ((d.limit(0), b), (d, b.limit(0))):
        assert lexical_search.search(some, asked).count() == 0
