"""Ranked search, URL filters and spelling groups against SQL and brute force, and their cases."""

import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check_oracle
from stallbook.llm import ranked_search, spelling, url_filter
from stallbook.llm.url_filter import Automaton, Rule

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_url_filter", "op13_spelling"])
def test_query_equals_sql(spark, name):
    assert check_oracle.compare(spark, check_oracle.connect(SMALL), SMALL, name) is None


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, top):
    """The contract's scores of all documents, for each item's text."""
    counted = [(name, Counter(terms_of(text))) for name, text in docs]
    counted = [(name, terms) for name, terms in counted if terms]
    n, total = len(counted), sum(sum(terms.values()) for _, terms in counted)
    df = Counter(t for _, terms in counted for t in terms)
    found = []
    for item, text in items:
        scores = []
        for name, terms in counted:
            m = 100 - 50 + 50 * sum(terms.values()) * n // total
            w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(terms_of(text)) if t in terms}
            score = sum(w[t] * (1_000_000_000 * terms[t] // (1000 * terms[t] + 20 * m)) for t in w)
            if score > 0:
                scores.append((-score, name is None, name))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        found += [(item, rank, name, -score) for rank, (score, _, name) in enumerate(scores[:top], 1)]
    return sorted(found, key=str)


@pytest.mark.parametrize("postings", [1 << 20, 60])
def test_ranking_of_odd_documents_and_items(spark, monkeypatch, postings):
    monkeypatch.setattr(ranked_search, "POSTINGS", postings)
    monkeypatch.setattr(ranked_search, "ITEMS", 3)
    draw = random.Random(5)
    words = [f"w{k}" for k in range(30)] + ["été", "Ärger", "x\x00y", "漢字"]
    docs = [(k, " ".join(draw.choices(words, k=draw.randint(1, 40)))) for k in range(120)]
    docs += [(7, "W1 w1 w2"), (7, "W1 w1 w2"), (None, "w1, w1; w2"), (None, None), (130, ""), (131, " -- "), (132, "w3 " * 20_000)]
    items = [(1, "w1 w2 w1"), (1, "w3"), (2, "w4 W5 nowhere"), (2, "w4 W5 nowhere"), (None, "été ÄRGER Ärger 漢字"), (3, None), (4, ""), (5, "nowhere")]
    items += [(10 + k, " ".join(draw.choices(words, k=12))) for k in range(8)]
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, term string").withColumn("shard", F.lit(1)).repartition(3)
    asked = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, score int").withColumn("rank", F.lit("r"))
    lists, n = ranked_search.indexed(frame)
    assert n == 124
    got = [tuple(r) for r in ranked_search.search(lists, n, asked, top=10).collect()]
    assert sorted(got, key=str) == ranked(docs, list(dict.fromkeys(items)), 10)


def test_ranking_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = docs.select(F.col("doc_id").alias("item_id"), "text")
    assert ranked_search.search(*ranked_search.indexed(docs), items.limit(0)).collect() == []
    assert ranked_search.search(*ranked_search.indexed(docs.limit(0)), items).collect() == []


def test_bounds_give_the_same_as_whole_lists_and_read_less():
    draw = np.random.default_rng(2)
    for top in (1, 5, 50):
        n, lists, scores = 3000, [], np.zeros(3000, np.int64)
        for size in (3000, 900, 120, 7, 1):
            docs = draw.permutation(n)[:size]
            adds = -np.sort(-draw.integers(1, 40, size)) * (3000 // size)
            scores[docs] += adds
            lists.append((docs, adds))
        order = np.lexsort((np.arange(n), -scores))[:top]
        best, found = ranked_search.nra(lists, n, top)
        assert best.tolist() == order.tolist() and found.tolist() == scores[order].tolist()


class Counted(np.ndarray):
    """An array that remembers the furthest place that was read."""

    furthest = 0

    def __getitem__(self, key):
        if isinstance(key, slice) and key.stop is not None:
            self.furthest = max(self.furthest, key.stop)
        return np.asarray(super().__getitem__(key))


def test_reading_ends_when_bounds_are_resolved():
    n = 50_000
    docs = np.arange(n).view(Counted)
    adds = np.concatenate([np.arange(10_000, 9_000, -1), np.ones(n - 1000)]).astype(np.int64)
    best, scores = ranked_search.nra([(docs, adds)], n, 10)
    assert best.tolist() == list(range(10)) and scores.tolist() == list(range(10_000, 9_990, -1))
    assert docs.furthest <= ranked_search.FIRST


def regex_of(rule):
    """A rule's host stands behind a dot: the first one for the host itself, any other for a subdomain."""
    path = rule.path[:-1] if rule.path.endswith("$") else rule.path + "*"
    host = "".join("[^#]*" if c == "*" else re.escape(c) for c in rule.host)
    return re.compile(rf"(?s).*\.{host}#{''.join({'*': '.*', '?': '.'}.get(c, re.escape(c)) for c in path)}")


def test_masks_fit_what_regular_expressions_fit():
    draw = random.Random(11)

    def some(letters, most):
        return "".join(draw.choices(letters, k=draw.randint(0, most)))

    rules = list({Rule(some("ab.*", 4), "/" + some("ab/*?é", 5) + draw.choice(["", "$"]), "allow") for _ in range(120)})
    assert Automaton(rules).words > 5
    urls = [(some("ab.", 6), "/" + some("ab/é漢", 8) if draw.random() < 0.9 else "") for _ in range(800)]
    urls += [("", "")]
    found = Automaton(rules).first_fits([f".{host}#{path}".encode() for host, path in urls])
    for (host, path), first in zip(urls, found.tolist(), strict=True):
        fits = [k for k, r in enumerate(rules) if regex_of(r).fullmatch(f".{host}#{path}")]
        assert first == (fits[0] if fits else -1), (host, path)


def test_rules_of_the_crawl(spark):
    urls = {
        "https://EXAMPLE.org/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
        "http://www.example.org/en/17?x=/es/": ("www.example.org", "/en/17", "example.org/en/1", "block"),
        "http://www.example.org/en/2#/en/1": ("www.example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/1": ("notexample.org", "/es/1", "org/", "allow"),
        "http://example.org": ("example.org", "", None, "allow"),
        "http://example.org?/es/": ("example.org", "", None, "allow"),
        "http://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "http://com/fr/": ("com", "/fr/", "com/fr/", "allow"),
        "http://a.com/FR/": ("a.com", "/FR/", None, "allow"),
        "http://a.com:80/fr/": ("a.com:80", "/fr/", None, "allow"),
        "http://x.spam-shop.net/a": ("x.spam-shop.net", "/a", None, "block"),
        "http://x.spam-shop.org/a": ("x.spam-shop.org", "/a", "org/", "allow"),
        "http://x.net/a/B.zip?x": ("x.net", "/a/B.zip", None, "block"),
        "http://x.net/a.zip/b": ("x.net", "/a.zip/b", None, "allow"),
        "ftp://É.org/\n/": ("É.org", "/\n/", "org/", "allow"),
        "a://b://c.org/": ("b:", "//c.org/", None, "allow"),
        "www.example.org/es/": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://long.org/" + "x" * 200_000: ("long.org", "/" + "x" * 200_000, "org/", "allow"),
    }
    rows = [((1 << 60) + k, url, "clash") for k, url in enumerate(urls)] + [(None, "http://a.com/de/", "clash")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string").withColumn("canonical", F.lit(1))
    got = url_filter.judged(pages).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert by_id.pop(None) == urls["http://a.com/de/"]
    assert by_id == {(1 << 60) + k: wanted for k, wanted in enumerate(urls.values())}
    assert url_filter.judged(pages.limit(0)).collect() == []
    everywhere = (Rule("*", "", "block"), Rule("com", "/de/", "allow"))
    assert [r["verdict"] for r in url_filter.judged(pages, everywhere).where("page_id is null").collect()] == ["allow"] * 2
    assert url_filter.judged(pages, everywhere).where("host = ''").first()["verdict"] == "block"


@pytest.mark.parametrize("host,path,verdict", [("a/b", "/", "allow"), ("a#b", "/", "allow"), ("a", "/#", "allow"), ("a", "/", "maybe")])
def test_rules_that_are_none(host, path, verdict):
    with pytest.raises(ValueError):
        Rule(host, path, verdict)


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    k = next((k for k in range(len(short)) if short[k] != long[k]), len(short))
    return short[k:] == long[k + 1 :]


def variants(docs):
    """The contract's rows, comparing every word with every other one."""
    counts = Counter()
    for name, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            noise = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if noise % 97 == 0:
                run = run[: noise % len(run)] + run[noise % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    forms, rows = {}, []
    neighbours = {w: [v for v in counts if near(w, v)] for w in counts}
    for w, others in neighbours.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best and counts[best] >= 2 * counts[w] else None
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.append((w, forms[w], root, n, len(neighbours[w]), counts.get(forms[w])))
    return sorted(rows, key=str)


@pytest.mark.parametrize("literal", [40, 5])
def test_spelling_of_odd_documents(spark, monkeypatch, literal):
    monkeypatch.setattr(spelling, "LITERAL", literal)
    monkeypatch.setattr(spelling, "BATCH", 7)
    monkeypatch.setattr(spelling, "HELD", 40)
    draw = random.Random(9)
    words = ["".join(draw.choices("aabé", k=draw.randint(4, 7))) for _ in range(150)] + ["a" * k for k in range(4, 12)]
    docs = [(k, " ".join(draw.choices(words, k=60))) for k in range(80)]
    docs += [(k, f"{'q' * 39} {'q' * 40} {'q' * 41}, {'q' * 20}z{'q' * 20}." * 2 ** (k % 3)) for k in range(100, 106)]
    long = "".join(draw.choices("abcdefgh", k=3000))
    docs += [(200, f"{long} " * 3 + f"{long[:1500]}{long[1501:]} " * 7 + f"{long}h " * 14 + f"{long}hh " * 30)]
    # A chain of forms: each occurs twice as often as the one before.
    docs += [(300, " ".join(f"kettl{'e' * k}s " * (3 << k) for k in range(6)))]
    docs += [(301, "Müller MÜLLER Muller ×÷×÷× ×÷×÷× ×÷×÷×")] * 3 + [(None, "Müller Mueller " * 5), (None, None), (302, ""), (303, "1234 -- ")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int").withColumn("word", F.lit("x")).repartition(3)
    got = spelling.grouped(frame).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got), key=str) == variants(docs)
    assert spelling.grouped(frame.limit(0)).collect() == []


def test_rotations_in_hashes_agree_with_rotations_in_letters(monkeypatch):
    draw = random.Random(1)
    words = list({"".join(draw.choices("abc", k=draw.randint(1, 9))) for _ in range(300)})
    spelt = {(w, k): row[0] for w in words for k, row in enumerate(spelling.rotations(w))}
    monkeypatch.setattr(spelling, "LITERAL", 0)
    hashed = {(w, k): row[0] for w in words for k, row in enumerate(spelling.rotations(w))}
    pairs = set(zip(spelt.values(), hashed.values(), strict=True))
    assert len(pairs) == len(set(spelt.values())) == len(set(hashed.values()))


def test_sql_of_the_catalog_runs_on_odd_tables():
    duck = duckdb.connect()
    duck.execute("CREATE TABLE documents AS SELECT * FROM (VALUES (1, 'alpha alpha alpha alphx'), (NULL, NULL)) t(doc_id, text)")
    assert duck.execute(spelling.SQL).fetchall() == [("alpha", None, "alpha", 3, 0, None)]
