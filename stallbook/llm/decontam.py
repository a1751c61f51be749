"""Benchmark decontamination by spaced seeds.

Words of a benchmark item and of a document are hashed through fixed masks, each of which looks at
some of the words of a window and ignores the others. Equal hashes of the same mask join a text to
an item, even where words in between were replaced; the overlap at each alignment that such a
hit gives is then verified word by word.

An overlap is the longest stretch, at fixed alignment, that begins and ends in agreement and in which at
least SIMILARITY of the words agree. It counts if it is as long as LEAST words. An item of fewer words is
compared whole, its first and last word may be replaced as well. No such overlap is missed: the masks of
MASKS together hit FIVE adjacent words with any one replaced, and of a stretch of n words with at most a
fifth replaced, one of its n // FIVE windows of FIVE has at most one replaced.

Words are runs of letters and digits, lower-cased; all else separates them. Seeds of both sides are
made in tasks and joined by hash; each text takes part once, however many documents hold it. Before
the join a bitmap of BITS bits, each seed of the benchmark setting two, sets texts aside that share no
seed with it. The bitmap is all that the driver sees and all that is broadcast, 8 MB for a benchmark of
any size; a fuller one lets more texts through to the join, which decides.
A text is compared with at most BLOCK words of items in a row, with more of them in further rows, and
takes memory in proportion to its own length and an item's.

Cases: null and empty texts have no words and match nothing. Items of fewer than FIVE words are no
evidence and match nothing. Repeated items are all reported, and items without an id as null. Empty tables give no rows, or no matches. Other
columns are not read; `keep_clean` passes them on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.llm.tables import fresh, in_small_batches, join_side, table
from stallbook.storage import written

#: Places of a window of FIVE that each mask looks at; the first also finds the last four words of one.
MASKS = ((0, 1, 2, 3), (0, 2, 3, 4), (0, 1, 3, 4), (0, 1, 2, 4))
FIVE = 5
SIMILARITY = 0.8
LEAST = 13
#: Words of items, and one item more, that a text is compared with in one row.
BLOCK = 20_000
#: Bits of the bitmap of seeds, as a power of two, and of each of its pieces, which Spark fixes.
BITS = 26
PIECE = 15
#: Texts whose seeds a task makes at once.
AT_ONCE = 256
#: Distinct words whose hashes a task remembers.
REMEMBERED = 1 << 19

HITS = "array<struct<item_id:long,first_word:int,words:int,similarity:double>>"
#: Of item_seeds and verified.
ITEM_SEEDS = "struct<n_words:long,seeds:array<long>>"
FOUND = "array<struct<k:int,first_word:int,words:int,similarity:double>>"

_ODD = np.random.default_rng(7).integers(1, 1 << 63, size=(4, 8), dtype=np.uint64) | np.uint64(1)


class Words(dict):
    """Hash of each word, remembered up to a number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return value

    def of(self, text: str | None) -> np.ndarray:
        found = re.findall(r"[^\W_]+", (text or "").lower())
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def seeds(words: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """The hash of the window at each place, as far as windows fit."""
    size = max(0, len(words) - mask[-1])
    out = np.full(size, number, np.uint64)
    for k, place in enumerate(mask):
        out += words[place : place + size] * _ODD[number, k]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0x9E3779B97F4A7C15)


def alignments(words: np.ndarray, items: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(item, where it would begin in words) for all alignments at which they share a seed.

    One flag for each alignment, so repeated words give no more than there are alignments.
    """
    sides = []
    for number, mask in enumerate(MASKS):
        here = seeds(words, mask, number)
        order = np.argsort(here)
        sides.append((number, mask, here[order], order))
    for n, item in enumerate(items):
        flags = np.zeros(len(words) + len(item), bool)
        for number, mask, here, order in sides:
            wanted = seeds(item, mask, number)
            low, high = np.searchsorted(here, wanted), np.searchsorted(here, wanted, "right")
            for place in np.flatnonzero(low < high).tolist():
                flags[order[low[place] : high[place]] + (len(item) - place)] = True
        starts = np.flatnonzero(flags) - len(item)
        if len(starts):
            yield n, starts


class Block:
    """Words of some items, ready to be compared with texts."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.words = [w for _, w in items]

    def matches(self, texts: list[np.ndarray]) -> list[list[tuple[int, int, int, float]]]:
        """For each text its verified overlaps with the items, the best of each item."""
        return [self._of(words) for words in texts]

    def _of(self, words: np.ndarray) -> list[tuple[int, int, int, float]]:
        found = []
        for number, starts in alignments(words, self.words):
            item, best = self.words[number], (0, 0, 0)
            for start in starts.tolist():
                first, last = max(0, -start), min(len(item), len(words) - start)
                if last - first < max(best[0], min(LEAST, len(item))):
                    continue
                agree = item[first:last] == words[start + first : start + last]
                if len(item) < LEAST:
                    whole = agree.sum() * 100 >= round(100 * SIMILARITY) * len(item)
                    stretch = (0, len(item)) if whole else None
                else:
                    stretch = longest(agree)
                if stretch and stretch[1] - stretch[0] >= min(LEAST, len(item)):
                    a, b = stretch
                    best = max(best, (int(agree[a:b].sum()), -(start + first + a), b - a))
            if best[0]:
                hits, at, size = best
                found.append((self.ids[number], -at, size, hits / size))
        return found


def longest(agree: np.ndarray) -> tuple[int, int] | None:
    """The longest stretch whose share of agreement is at least SIMILARITY; it begins and ends in agreement."""
    # With agreement worth 1-s and disagreement -s a stretch qualifies if its sum is not negative.
    sums = np.concatenate(([0], np.cumsum(np.where(agree, 100 - round(100 * SIMILARITY), -round(100 * SIMILARITY)))))
    begins = np.where(agree, sums[:-1], np.iinfo(sums.dtype).max)
    least = np.minimum.accumulate(begins)  # falls, so the first start not above an end's sum is a search
    ends = np.flatnonzero(agree) + 1
    if not len(ends):
        return None
    starts = np.searchsorted(-least, -sums[ends])
    k = int(np.argmax(ends - starts))
    return int(starts[k]), int(ends[k])


def item_seeds(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The number of words of an item and its different seeds; none of an item that is no evidence."""
    hashed = Words()
    for column in columns:
        sizes, found = [], []
        for text in column:
            words = hashed.of(text)
            sizes.append(len(words))
            parts = [seeds(words, mask, number) for number, mask in enumerate(MASKS)] if len(words) >= FIVE else []
            found.append(np.unique(np.concatenate(parts)).view(np.int64) if parts else np.empty(0, np.int64))
        yield pd.DataFrame({"n_words": sizes, "seeds": found})


def bitmap(keys: DataFrame) -> np.ndarray:
    """The bits that the seeds in keys set, packed; it comes in at most 2^(BITS - PIECE) pieces of 4 KB."""
    first = F.shiftrightunsigned("seed", 64 - BITS)
    second = F.shiftrightunsigned(F.shiftleft("seed", BITS), 64 - BITS)
    pieces = (
        keys.select(F.explode(F.array(first, second)).alias("bit"))
        .groupBy(F.shiftright("bit", PIECE).alias("piece"))
        .agg(F.bitmap_construct_agg(F.col("bit") % (1 << PIECE)).alias("bits"))
    )
    size = 1 << (PIECE - 3)
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for row in pieces.collect():
        out[row["piece"] * size : (row["piece"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def maybe_shared(spark: SparkSession, bits: np.ndarray):
    """A column function: text to its different seeds that are in the bitmap, null for none; and the broadcast."""
    sent = spark.sparkContext.broadcast(bits)

    def among(known: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    @F.pandas_udf("array<long>")
    def shared(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known, hashed, rest = sent.value, Words(), np.uint64(64 - BITS)
        for column in columns:
            found: list[np.ndarray | None] = []
            for low in range(0, len(column), AT_ONCE):
                # Searched as one array: a window over the end of a text is one more chance hit of that text.
                texts = [hashed.of(x) for x in column.iloc[low : low + AT_ONCE]]
                ends, whole = np.cumsum([len(t) for t in texts]), np.concatenate(texts)
                places, hits = [], []
                for number, mask in enumerate(MASKS):
                    here = seeds(whole, mask, number)
                    at = np.flatnonzero(among(known, here >> rest))
                    at = at[among(known, (here[at] << np.uint64(BITS)) >> rest)]
                    places.append(at)
                    hits.append(here[at])
                place, hit = np.concatenate(places), np.concatenate(hits)
                of: list[np.ndarray | None] = [None] * len(texts)
                which = np.searchsorted(ends, place, "right")
                for k in np.unique(which).tolist():
                    of[k] = np.unique(hit[which == k]).view(np.int64)
                found += of
            yield pd.Series(found, dtype=object)

    # What is filtered by its result is not computed a second time below the filter, in a second worker for each task.
    return shared.asNondeterministic(), sent


def verified(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The overlaps of a text with the items beside it, which are named by their places in the array."""
    hashed, names = Words(), ("k", "first_word", "words", "similarity")
    for texts, items in columns:
        found = []
        for text, beside in zip(texts, items, strict=True):
            block = Block([(k, hashed.of(x)) for k, x in enumerate(beside)])
            found.append([dict(zip(names, hit, strict=True)) for hit in block.matches([hashed.of(text)])[0]])
        yield pd.Series(found)


def text_mark() -> Column:
    return F.md5(F.col("text").cast("binary"))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_column: str = "item_id") -> DataFrame:
    """mark and overlaps of each text in docs that overlaps an item; a row for all documents that hold it."""
    spark = in_small_batches(docs).sparkSession
    items = written(
        benchmark.select(
            F.monotonically_increasing_id().alias("number"),
            F.col(id_column).cast("long").alias("item_id"),
            "text",
            F.pandas_udf(item_seeds, ITEM_SEEDS).asNondeterministic()(F.col("text")).alias("made"),
        )
        .select("number", "item_id", "text", "made.*")
        .where(F.size("seeds") > 0),
        "items",
    )
    keys = written(items.select("number", F.explode("seeds").alias("seed")), "item-seeds")
    shared, sent = maybe_shared(spark, bitmap(keys))
    found = docs.select("text").select("text", shared(F.col("text")).alias("seeds")).where("seeds IS NOT NULL")
    texts = written(found.withColumn("mark", text_mark()).dropDuplicates(["mark"]), "candidates")
    sent.destroy()
    pairs = (
        texts.select("mark", F.explode("seeds").alias("seed"))
        .join(join_side(keys), "seed")
        .select("mark", "number")
        .distinct()
    )
    compared = F.pandas_udf(verified, FOUND).asNondeterministic()(F.col("text"), F.col("items.item"))
    so_far = Window.partitionBy("mark").orderBy("number")
    rows = (
        pairs.join(items.select("number", "n_words"), "number")
        .select("mark", "number", F.floor(F.sum("n_words").over(so_far) / BLOCK).alias("part"))
        .join(items.select("number", "item_id", F.col("text").alias("item")), "number")
        .groupBy("mark", "part")
        .agg(F.collect_list(F.struct("item_id", "item")).alias("items"))
        .join(texts.select("mark", "text"), "mark")
        .select("mark", "items.item_id", compared.alias("found"))
        .where(F.size("found") > 0)
    )
    named = F.transform(
        "found",
        lambda x: F.struct(F.get("item_id", x["k"]).alias("item_id"), x["first_word"], x["words"], x["similarity"]),
    )
    return written(
        rows.select("mark", named.cast(HITS).alias("overlaps"))
        .groupBy("mark")
        .agg(F.sort_array(F.flatten(F.collect_list("overlaps"))).alias("overlaps")),
        "overlaps",
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, the items found in each document and the overlaps."""
    found = docs.select("doc_id", text_mark().alias("mark")).join(overlaps(docs, benchmark), "mark", "left")
    return found.select("doc_id", F.coalesce("overlaps", F.array().cast(HITS)).alias("overlaps")).select(
        "doc_id",
        (F.size("overlaps") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("overlaps.item_id")).alias("item_ids"),
        "overlaps",
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that overlap an item, all columns unchanged."""
    (name,) = fresh(docs, "found_mark")
    side = join_side(overlaps(docs, benchmark).select(F.col("mark").alias(name)))
    return docs.join(side, text_mark() == F.col(name), "left_anti")


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the benchmark items found in it."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
