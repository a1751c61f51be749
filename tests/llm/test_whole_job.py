"""The corpus operators on inputs that a part of the job would get wrong."""

import random
from bisect import bisect_right
from functools import cache
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stallbook.llm import decontam, language, packing, page_text

SMALL = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"

POLISH = (
    "i w na się nie z że do to jest o jak po co za od jego przez który była wszystko tylko może bardzo kiedy gdzie miasto człowiek "
    "dzień roku praca szkoła dom ulica pisać czytać książka wiedział powiedział dziecko życie czas ręka głowa wojna noc woda droga"
).split()


@pytest.fixture(scope="module")
def model(spark):
    """Dictionaries and what a text is found to be by them."""
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    return docs, language.predictor(language.learnt(docs))


def accepted(spark, predict, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(predict(F.col("text"))["accepted"].alias("a")).collect()
    return sum(r["a"] for r in rows) / len(rows)


@pytest.mark.parametrize("words", [20, 100, 500])
def test_language_rejects_random_letters_and_a_language_not_learnt(spark, model, words):
    draw = random.Random(words)
    junk = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(words)) for _ in range(60)]
    assert accepted(spark, model[1], junk) <= 0.02
    assert accepted(spark, model[1], [" ".join(draw.choices(POLISH, k=words)) for _ in range(60)]) <= 0.02


def test_language_rejects_halves_and_keeps_clean_texts(spark, model):
    docs, predict = model
    held = docs.where(language.held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.length("text") > 200)).orderBy("doc_id")
    clean = [r for r in held.collect() if len(set(r["text"].split())) > 30]
    assert accepted(spark, predict, [r["text"] for r in clean]) >= 0.97
    halves = []
    for a, b in zip(clean, clean[1:]):
        if a["lang"] != b["lang"]:
            size = min(len(a["text"]), len(b["text"]))
            halves.append(a["text"][:size] + " " + b["text"][:size])
    assert len(halves) > 50 and accepted(spark, predict, halves) <= 0.1


def text_of(html):
    return " ".join(block[0] for block in page_text.blocks(html))


@pytest.mark.parametrize(
    "markup",
    [
        '<svg class="i"/>', "<svg/>", "<svg viewBox='0 0 1 1' />", "<math/>", '<object data="x"/>', '<video-player src="x"></video-player>',
        "<title-bar></title-bar>", "<select-menu>", "<div><video src=x></div>", "<p><video src=x>", "<svg><title>no</title><g><path/></g></svg>",
        "<svg><svg/><text>no</text></svg>", "<select><option>no<option>no</select>", "<template><p>no</p></template>", "<script>'<p>no'</script >",
        "<noscript><p>no</p></noscript>", "<div><object data=x/><p>no</p></div>", "<canvas>no</canvas>",
    ],
)
def test_page_goes_on_after_hidden_elements(markup):
    assert text_of(f"<article>{markup}<p>Body text.</p><p>More.</p></article><p>End.") == "Body text. More. End."


def test_hidden_elements_end_with_their_parent_and_part_no_words():
    assert text_of("<article><p>One <svg><path/></svg>word.</p><object><p>no</p></article><p>After.") == "One word. After."
    assert [b[0] for b in page_text.blocks("<p>a<svg></svg>b<canvas>no</canvas>c")] == ["abc"]
    assert text_of("<p>Shown.</p><script>var a = '<p>no</p>'") == "Shown."


WORDS = "The market opened at nine and the first carts came in from the hills with apples, pears and a load of late plums. "


@pytest.mark.parametrize(
    "tag", ['main class="content has-sidebar"', 'article class="post hentry category-social"', 'div id=main class="no-comments"',
            'article class="sponsored"', 'div class="content wp-ad-free"', "article role=complementary"],
)
def test_articles_are_kept_whatever_their_class_and_captions_with_them(spark, tag):
    name = tag.split()[0]
    page = (
        f"<body><nav><a href=x>Home</a></nav><{tag}><h1>Market day</h1><p>{WORDS * 3}</p><figure><img src=x><figcaption>Carts at the "
        f"north gate in the rain.</figcaption></figure><p>{WORDS * 2}</p></{name}><div class=site-footer><p>{WORDS}</p></div></body>"
    )
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    want = f"Market day {WORDS * 3}Carts at the north gate in the rain. {WORDS * 2}".strip()
    assert page_text.main_texts(df).first()["text"] == want


def test_names_of_asides():
    asides = ["site-footer", "post-navigation", "cookie-notice", "entry-comments", "sidebar-right", "content sidebar", "main-nav"]
    assert all(page_text.role("div", f'class="{x}"') == "a" for x in asides)
    assert [page_text.role("div", f'class="{x}"') for x in ("wrapper has-sidebar", "entry-content")] == ["", "m"]
    assert page_text.role("article", "class=comment", nested=True) == page_text.role("main", "hidden") == "a"


def fewest(pieces, capacity):
    """The fewest sequences by trying every place of every piece."""

    @cache
    def most_room(done):
        """Fewest sequences with the least used of the last one, for a set of pieces."""
        if not done:
            return 1, 0
        best = (len(pieces) + 1, 0)
        for k, size in enumerate(pieces):
            if done >> k & 1:
                n, used = most_room(done & ~(1 << k))
                best = min(best, (n, used + size) if used + size <= capacity else (n + 1, size))
        return best

    return most_room((1 << len(pieces)) - 1)[0]


def counted(pieces, capacity):
    return np.bincount(pieces, minlength=capacity + 1)


def test_plan_of_few_lengths_is_least():
    plan, proven = packing.searched(counted([52, 40, 31, 29, 20, 16, 12], 100))
    assert proven and sum(times for times, _ in plan) == 2


def test_plan_against_brute_force():
    draw = random.Random(9)
    for _ in range(250):
        capacity = draw.choice([12, 30, 100])
        few = [draw.randint(1, capacity) for _ in range(draw.randint(1, 7))]
        pieces = [draw.choice(few) for _ in range(draw.randint(1, 11))]
        plan, proven = packing.searched(counted(pieces, capacity))
        assert proven and sum(times for times, _ in plan) == fewest(tuple(pieces), capacity)
        assert sorted(s for times, fill in plan for s, n in fill for _ in range(times * n)) == sorted(pieces)


def test_plan_says_when_the_search_was_cut_short():
    draw = np.random.default_rng(2)
    counts = np.bincount(draw.integers(260, 400, 60), minlength=1001)
    plan, proven = packing.searched(counts, nodes=5)
    assert not proven and sum(t for t, _ in plan) <= sum(t for t, _ in packing.best_fit(counts))


@pytest.mark.parametrize("low,high,n", [(1366, 1800, 100_000), (1366, 2730, 20_000), (350, 700, 60)])
def test_bounds_prove_plans_of_pieces_that_go_two_by_two(low, high, n):
    pieces = np.random.default_rng(2).integers(low, high, n)
    capacity = 1000 if n == 60 else 4096
    plan, proven = packing.searched(counted(pieces, capacity), nodes=5)
    # No three go together, so the fewest are found by giving the largest the largest that fits.
    waiting, fewest_sequences = np.sort(pieces).tolist(), 0
    while waiting:
        largest = waiting.pop()
        if fits := bisect_right(waiting, capacity - largest):
            waiting.pop(fits - 1)
        fewest_sequences += 1
    assert proven and sum(times for times, _ in plan) == fewest_sequences


def test_weights_never_ask_for_more_sequences_than_needed():
    draw = random.Random(4)
    for _ in range(150):
        capacity = draw.choice([7, 12, 30])
        pieces = [draw.randint(1, capacity) for _ in range(draw.randint(1, 9))]
        bound, weight, full = packing.weights(counted(pieces, capacity))
        assert -(-sum(pieces) // capacity) <= bound <= fewest(tuple(pieces), capacity)
        assert bound == -(-sum(int(weight[p]) for p in pieces) // full)


def all_alignments(item, words):
    """Whether an item overlaps a text, by every alignment and every stretch."""
    n = len(item)
    for start in range(1 - n, len(words)):
        agree = [0 <= start + k < len(words) and item[k] == words[start + k] for k in range(n)]
        if n < 13:
            if 0 <= start <= len(words) - n and 5 * sum(agree) >= 4 * n:
                return True
            continue
        for a in range(n):
            for b in range(a + 13, n + 1):
                inside = 0 <= start + a and start + b <= len(words)
                if inside and agree[a] and agree[b - 1] and 5 * sum(agree[a:b]) >= 4 * (b - a):
                    return True
    return False


@pytest.mark.parametrize("n", [5, 6, 7, 8, 9, 10, 11, 12, 15, 16, 20])
def test_every_allowed_substitution_is_found(n):
    item = np.arange(1, n + 1).astype(np.uint64)
    block = decontam.Block([(7, item)])
    texts = []
    for places in combinations(range(n) if n < 13 else range(1, n - 1), n // 5):
        words = item.copy()
        words[list(places)] = 1000
        texts.append(np.concatenate([[900, 901], words, [902]]).astype(np.uint64))
    for found in block.matches(texts):
        assert found == [(7, 2, n, (n - n // 5) / n)]
    words = item.copy()
    words[: n // 5 + 1] = 1000
    assert n > 12 or block.matches([words]) == [[]]


def test_overlaps_against_all_alignments():
    draw = random.Random(10)
    items = [[draw.randrange(30) for _ in range(draw.choice([5, 7, 9, 12, 13, 16, 24]))] for _ in range(60)]
    block = decontam.Block([(i, np.array(x, np.uint64)) for i, x in enumerate(items)])
    texts = []
    for x in items:
        part = [w if draw.random() < 0.82 else 99 for w in x]
        low = draw.choice([0, 0, 2])
        texts.append([draw.randrange(30) for _ in range(draw.randrange(4))] + part[low:] + [draw.randrange(30) for _ in range(draw.randrange(20))])
    found = block.matches([np.array(t, np.uint64) for t in texts])
    for text, hits in zip(texts, found, strict=True):
        assert {h[0] for h in hits} == {i for i, x in enumerate(items) if all_alignments(x, text)}
    assert 10 < sum(map(bool, found)) < 60


@pytest.mark.parametrize("bits", [16, 26])
def test_decontamination_by_joins_against_all_alignments(spark, monkeypatch, bits):
    monkeypatch.setattr(decontam, "BITS", bits)
    monkeypatch.setattr(decontam, "BLOCK", 40)
    draw = random.Random(11)
    items = [[draw.randrange(40) for _ in range(draw.choice([4, 5, 8, 12, 14, 20]))] for _ in range(40)]
    items += [items[7], [6] * 9]
    texts = [[draw.randrange(40) for _ in range(draw.randrange(25))] for _ in range(30)] + [[6] * 50, []]
    texts += [[w if draw.random() < 0.85 else 99 for w in x] + [draw.randrange(40) for _ in range(8)] for x in items]
    texts += texts[-5:] * 3
    docs = spark.createDataFrame([(k, ", ".join(f"W{w}" for w in t)) for k, t in enumerate(texts)], "doc_id long, text string")
    table = spark.createDataFrame([(k, " ".join(f"w{w}" for w in x)) for k, x in enumerate(items)], "item_id long, text string")
    expected = {k: [i for i, x in enumerate(items) if len(x) > 4 and all_alignments(x, t)] for k, t in enumerate(texts)}
    assert {r["doc_id"]: r["item_ids"] for r in decontam.contaminated(docs, table).collect()} == expected
    assert {r["doc_id"] for r in decontam.keep_clean(docs, table).collect()} == {k for k, x in expected.items() if not x}
    assert 20 < sum(map(bool, expected.values())) < 80


def test_longest_stretch_begins_and_ends_in_agreement():
    agree = np.array([1] * 12 + [0] * 3 + [1] * 11 + [0, 1, 0, 1] + [0] * 6, bool)
    stretches = [(a, b) for a in range(len(agree)) for b in range(a + 1, len(agree) + 1)]
    best = max(b - a for a, b in stretches if agree[a] and agree[b - 1] and 5 * agree[a:b].sum() >= 4 * (b - a))
    a, b = decontam.longest(agree)
    assert b - a == best and agree[a] and agree[b - 1] and decontam.longest(np.zeros(3, bool)) is None


def test_items_without_an_id_are_searched(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b c d e f"), (3, "b c d e f g"), (3, "c d e f g h i")], "item_id long, text string")
    found = {r["doc_id"]: r["item_ids"] for r in decontam.contaminated(docs, items).collect()}
    assert found == {1: [3, None], 2: []}
    assert [r["doc_id"] for r in decontam.keep_clean(docs, items).collect()] == [2]


@pytest.mark.parametrize("stage", ["exact", "near"])
def test_stages_take_columns_of_any_name_and_type(spark, stage):
    text = "the cat sat on the mat and the dog lay by the door all day"
    rows = [(1, text), (1, text), (2, text), (3, "something else that was written by someone"), (3, "something else that was written by someone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    names = ("mark", "__mark", "__dropped_id", "__id", "dropped_id", "Dropped_Mark", "_dropped_id", "repeated_id", "repeated_row", "REPEATED_MARK")
    docs = docs.select("*", *[F.lit(k).alias(name) for k, name in enumerate(names)], F.create_map(F.lit("a"), F.col("doc_id")).alias("facts"))
    kept = dict(corpus_pipeline.STAGES)[stage](spark, docs, SMALL)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
