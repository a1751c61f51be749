"""What operators do on inputs that once took time or traffic with the square of their size."""

import random
import re
import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallbook.llm import decontam, exact, secret_scan
from stallbook.llm.page_text import blocks


def test_slices_sent_grow_with_the_fingerprints_and_not_with_the_owners(spark):
    docs = spark.range(20_000, numPartitions=4).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 15_000).cast("string")).alias("text")
    )
    sizes = {}
    for owners in (1, 64, 512):
        rows, sent = exact.digests(docs, owners)
        assert rows.count() == 20_000
        total = F.sum(F.length("unary") + F.length("rest") + F.length("repeated"))
        sizes[owners] = sent.agg(total.alias("bytes"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("slices")).first()
        assert sizes[owners]["n"] == 20_000  # no text occurs twice in one partition
    assert sizes[512]["slices"] == 4 * 512
    # Each slice rounds three bit strings up to bytes; nothing else is added.
    assert sizes[512]["bytes"] <= 1.1 * sizes[1]["bytes"] + 4 * 512 * 3


@pytest.mark.parametrize("chunk", [50, 1 << 16])
def test_duplicates_within_and_between_senders_are_suspects(spark, monkeypatch, chunk):
    monkeypatch.setattr(exact, "OWNED", 100)
    monkeypatch.setattr(exact, "CHUNK", chunk)
    monkeypatch.setattr(exact, "LEAST", 1)
    rows = [(k, f"text {k % 700}") for k in range(1000)]
    found = exact.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found} == {
        (k, k % 700, 2 if k % 700 < 300 else 1, k < 700) for k in range(1000)
    }


def test_ids_beyond_doubles_are_kept_beside_null_ids(spark):
    big = (1 << 53) + 1
    rows = [(big, "a"), (None, "a"), (big + 2, "b"), (None, None)]
    found = exact.groups(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in found} == {
        (big, big, True), (None, big, False), (big + 2, big + 2, True), (None, None, True),
    }


def seconds(work, *sizes):
    taken = []
    for size in sizes:
        data = work[0](size)
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            work[1](data)
            runs.append(time.perf_counter() - start)
        taken.append(min(runs))
    return taken


@pytest.mark.parametrize("markup", ["<li>a few words ", "<div>a few words ", "<ul><li>words ", "<video><p>words "])
def test_pages_that_never_close_elements_take_time_in_proportion(markup):
    short, long = seconds((lambda n: markup * n, blocks), 2000, 16_000)
    assert long < 24 * short


def test_next_in_a_row_ends_the_one_before():
    html = "<main><ul><li class=advert>Buy this now<li>A point of the article<li>Another</ul></main>"
    assert [(text, place) for text, _, _, place, _ in blocks(html)] == [
        ("Buy this now", "x"), ("A point of the article", "m"), ("Another", "m"),
    ]


@pytest.mark.parametrize("head", [b"token=AAtoken:", b"secret: apikey=", b"AKIAAKIA"])
def test_long_values_behind_a_hit_in_a_match_take_time_in_proportion(head):
    scanner = secret_scan.Scanner()
    for tail in (b"b", b"A", b"0"):
        short, long = seconds((lambda n, t=tail: head + t * n, scanner.spans), 2000, 16_000)
        assert long < 24 * short


def test_secrets_that_begin_in_a_match_against_regular_expressions():
    scanner = secret_scan.Scanner()
    parts = ["token", "secret", ":", "=", "a", "b ", " ", '"', "AKIA", "A" * 6, "0af" * 5, "abcdef1", "password", "_key", "api", "\n"]
    assign = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
    draw = random.Random(7)
    for _ in range(2000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(1, 40)))
        want = {(m.start(), m.end(), 0) for m in assign.finditer(text) if len(m[1]) >= 6}
        want |= {(m.start(), m.end(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20}
        want |= {(m.start(), m.end(), 2) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24}
        assert {s for s in scanner.spans(text.encode()) if s[2] < 3} == want, text


def test_a_repeated_word_takes_memory_in_proportion():
    text, item = np.full(8000, 5, np.uint64), np.full(800, 5, np.uint64)
    tracemalloc.start()
    found = decontam.Block([(3, item)]).matches([text])
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found == [[(3, 0, 800, 1.0)]] and most < 20_000_000
