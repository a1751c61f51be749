"""SimHash near-duplicates by a self-join of binary tries.

Every text becomes a 64-bit fingerprint of its word shingles; fingerprints link at a few differing
bits, and linked documents, directly or through others, form a component.

The join walks pairs of nodes of a binary trie together. A step down one bit adds one differing bit
where the two branches part, and a pair of nodes is pruned as soon as the bits it has spent exceed
the budget. To spread the walk over many tasks the 64 bits are cut into blocks. Of fingerprints that
differ in at most BUDGET bits, all but BUDGET blocks agree, so for each choice of so many blocks there
is one trie with those blocks on top, where no difference is allowed: its top part is a plain
grouping by Spark, and each group walks its own lower part. More blocks, and so smaller groups, are
chosen as the corpus grows; the result is the same for any choice.

A node with very many fingerprints is dealt over tiles, and each pair of tiles is one task, so no
task holds more than a bounded number of rows. A task returns the links that join its fingerprints
into trees, not all pairs. Equal fingerprints are one row from the start.

Cases: null and empty texts, and those of white space, have fingerprint zero and so are linked with
each other. Repeated rows are linked like any. Null doc_ids never name a component unless it has no
other; it is then null. An empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm.components import stars
from stallbook.llm.tables import first_of_repeats, in_small_batches, join_side, table, texts, without_rows
from stallbook.storage import written

WORDS = 4
BUDGET = 4
SEED = 42
#: Fingerprints that one task gets at most, about; groups are formed and split by it.
TASK_ROWS = 20_000
#: Node pairs that a task walks at once, and pairs of values below which two nodes are compared at once.
WALK = 1 << 17
LEAVES = 64


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The 64-bit SimHash of the word shingles of a whole text."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(parts) > words:
        ends, starts = ends[words - 1 :], starts[: len(parts) - words + 1]
    else:
        ends, starts = ends[-1:], starts[:1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts)
    )
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint_column(words: int = WORDS):
    """A column function: text to its fingerprint as a signed long."""

    @F.pandas_udf("long")
    def computed(column: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(x, words) for x in column), np.uint64, len(column))
        return pd.Series(found.view(np.int64))

    return computed


def cuts(blocks: int) -> list[tuple[int, int]]:
    """Lowest bit and width of each of so many blocks of the 64 bits."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def choices(blocks: int, budget: int) -> list[tuple[int, ...]]:
    """The choices of blocks that must agree."""
    return list(combinations(range(blocks), blocks - budget))


def blocks_for(rows: int, budget: int) -> int:
    """The fewest blocks for which a group of agreeing fingerprints is expected to be small."""
    for blocks in range(budget + 1, 2 * budget + 1):
        agreeing = min(sum(cuts(blocks)[i][1] for i in c) for c in choices(blocks, budget))
        if rows <= 4 << agreeing:
            return blocks
    return 2 * budget


def _top(fp: Column, chosen: tuple[int, ...], blocks: int) -> Column:
    out = F.lit(0).cast("long")
    for i in chosen:
        low, width = cuts(blocks)[i]
        out = F.shiftleft(out, width).bitwiseOR(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long")))
    return out


def turned(values: np.ndarray, chosen: tuple[int, ...], blocks: int) -> tuple[np.ndarray, int]:
    """Values with the chosen blocks on top, and how many bits these are."""
    out = np.zeros_like(values)
    order = [*chosen, *(i for i in range(blocks) if i not in chosen)]
    for i in order:
        low, width = cuts(blocks)[i]
        out = (out << np.uint64(width)) | ((values >> np.uint64(low)) & np.uint64((1 << width) - 1))
    return out, sum(cuts(blocks)[i][1] for i in chosen)


def leaves(pairs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of values below pairs of small nodes."""
    which = np.repeat(np.arange(pairs.shape[1]), sizes)
    place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    across = (pairs[3] - pairs[2])[which]
    return pairs[0][which] + place // across, pairs[2][which] + place % across


def walk(values: np.ndarray, top: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of distinct sorted values that agree in the top bits and differ in few others.

    A node of the trie is a range of the values, a frontier an array of node pairs with their bits
    spent. Frontiers are walked depth first in pieces, so memory does not grow with the pairs.
    """
    groups = np.flatnonzero(np.diff(values >> np.uint64(64 - top)) != 0) + 1 if top else np.empty(0, np.int64)
    low, high = np.concatenate(([0], groups)), np.concatenate((groups, [len(values)]))
    many = high - low > 1
    low, high = low[many], high[many]
    stack = [(top, np.stack([low, high, low, high, np.zeros_like(low)]))]
    while stack:
        depth, pairs = stack.pop()
        if pairs.shape[1] > WALK:
            stack += [(depth, pairs[:, at : at + WALK]) for at in range(0, pairs.shape[1], WALK)]
            continue
        sizes = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
        small = sizes <= LEAVES
        a, b = leaves(pairs[:, small], sizes[small])
        near = (a != b) & (np.bitwise_count(values[a] ^ values[b]) <= budget)
        if near.any():
            yield a[near], b[near]
        pairs = pairs[:, ~small]
        if not pairs.shape[1]:
            continue
        bit = np.uint64(1 << (63 - depth))

        def parted(low: np.ndarray, high: np.ndarray, bit=bit, depth=depth) -> np.ndarray:
            above = (values[low] >> np.uint64(64 - depth)) << np.uint64(64 - depth) if depth else np.zeros(len(low), np.uint64)
            return np.clip(np.searchsorted(values, above | bit), low, high)

        al, ah, bl, bh, spent = pairs
        am, bm = parted(al, ah), parted(bl, bh)
        apart = np.flatnonzero(al != bl)  # two nodes, rather than one with itself
        below = [
            np.stack([al, am, bl, bm, spent]),
            np.stack([am, ah, bm, bh, spent]),
            np.stack([al, am, bm, bh, spent + 1]),
            np.stack([am[apart], ah[apart], bl[apart], bm[apart], spent[apart] + 1]),
        ]
        for x in below:
            x = x[:, (x[0] < x[1]) & (x[2] < x[3]) & (x[4] <= budget)]
            x = x[:, (x[0] != x[2]) | (x[1] - x[0] > 1)]  # a single value with itself
            if x.shape[1]:
                stack.append((depth + 1, x))


def forest(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of size nodes the least node that pairs join it to."""
    root = np.arange(size)
    for a, b in pairs:
        while True:
            x, y = root[a], root[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (up := root[root]).tobytes() != root.tobytes():
                root = up
    return root


def links(fingerprints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(a, b): links that join all fingerprints within the budget of each other.

    fingerprints: written, with one distinct long column `fp`.
    """
    rows = fingerprints.count()
    blocks = blocks_for(rows, budget)
    chosen = choices(blocks, budget)
    cells = max(1, -(-rows // TASK_ROWS))
    keyed = fingerprints.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _top(F.col("fp"), c, blocks).alias("top")) for k, c in enumerate(chosen)])).alias("x"),
    ).select("fp", "x.k", "x.top")
    crowded = written(
        keyed.groupBy("k", "top").count().where(F.col("count") > TASK_ROWS).select(
            F.col("k").alias("ck"), F.col("top").alias("ctop"), F.ceil(2 * F.col("count") / TASK_ROWS).cast("int").alias("tiles")
        ),
        "crowded",
    )
    dealt = (
        keyed.join(join_side(crowded), (F.col("k") == F.col("ck")) & (F.col("top") == F.col("ctop")), "left")
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce("tiles", F.lit(1))))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("tiles", F.lit(1)) - F.lit(1).cast("long"))))
        .select(
            "fp",
            "k",
            F.when(F.col("tiles").isNull(), F.pmod(F.xxhash64("k", "top"), F.lit(cells))).otherwise(F.col("top")).alias("cell"),
            F.when(F.col("tiles").isNull(), F.lit(-1).cast("long")).otherwise(F.least("own", "other")).alias("p"),
            F.when(F.col("tiles").isNull(), F.lit(-1).cast("long")).otherwise(F.greatest("own", "other")).alias("q"),
        )
    )

    def joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(rows["fp"].to_numpy().view(np.uint64))
        spun, top = turned(values, chosen[int(key[0])], blocks)
        order = np.argsort(spun)
        root = forest(len(values), walk(spun[order], top, budget))
        members = np.flatnonzero(root != np.arange(len(values)))
        own = values[order].view(np.int64)
        return pd.DataFrame({"a": own[members], "b": own[root[members]]})

    return dealt.groupBy("k", "cell", "p", "q").applyInPandas(joined, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """doc_id, fp, component_id, root and mark of every document.

    root, a fingerprint, names the component even where doc_ids are null; mark is a hash of the text.
    """
    digests = written(
        texts(in_small_batches(docs)).select("doc_id", fingerprint_column(words)("text").alias("fp"), F.xxhash64("text").alias("mark")), "simhash"
    )
    first = written(digests.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    grown = written(stars(links(first.select("fp"), budget)), "stars")
    nodes = grown.unionByName(grown.select(F.col("root").alias("node"), "root")).distinct()
    linked = written(nodes.join(first, F.col("node") == F.col("fp")).select("node", "root", "first_id"), "linked")
    leads = written(linked.groupBy("root").agg(F.min("first_id").alias("lead")), "leads")
    named = written(linked.join(leads, "root").select("node", "root", "lead"), "named")
    labels = written(
        first.join(named, F.col("fp") == F.col("node"), "left").select(
            F.col("fp").alias("label_fp"),
            F.when(F.col("node").isNull(), F.col("first_id")).otherwise(F.col("lead")).alias("component_id"),
            F.coalesce("root", "fp").alias("root"),
        ),
        "labels",
    )
    return digests.join(labels, F.col("fp") == F.col("label_fp")).select("doc_id", "fp", "component_id", "root", "mark")


def keep_first(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """One document of each component with all its columns: the smallest doc_id, nulls last.

    Of several texts with that doc_id the one with the least hash stays, of equal rows the least.
    """
    found = written(near_duplicates(docs, words, budget), "near")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "mark")
    chosen = written(
        found.groupBy("root").agg(F.min(order).alias("x"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
            F.col("root").alias("of_root"), F.col("x.doc_id").alias("chosen_id"), F.col("x.mark").alias("chosen_mark")
        ),
        "chosen",
    )
    grouped = found.join(chosen, F.col("root") == F.col("of_root"))
    lead = F.col("doc_id").eqNullSafe(F.col("chosen_id")) & F.col("mark").eqNullSafe(F.col("chosen_mark"))
    repeated = grouped.where(lead).groupBy("doc_id", "mark").count().where("count > 1")
    mark = F.xxhash64("text")
    return first_of_repeats(without_rows(docs, grouped.where(~lead), mark), repeated, mark)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
