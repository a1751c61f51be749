"""Ranked lexical search by NRA, reading impact-sorted lists without random access.

1. A pass over the documents counts them and their terms.
2. Each task cuts its documents into shards of at most DOCS documents and about POSTINGS postings, and writes for each
   shard and term one list of (document, impact), the largest impact first. A document is a number within
   its shard, in the order of ids, and a row with an empty term holds the ids. This index has all terms, none is left out.
3. Items are dealt into blocks of about ITEMS. The lists of a block's terms meet by shard, and for each item the shard is
   searched: lists are read from the top, ever deeper. What a document's read impacts add up to is its lower bound;
   adding, for each list in which it has not come up, the impact last read there gives its upper bound. Documents whose
   upper bound, with ties decided by id, cannot reach the TOP-th lower bound fall away. Reading goes on, in the lists that can still
   say something, until the bounds of all that are left are equal; then members, order and scores are final.
4. The best of all shards, TOP from each at most, are ranked by item.

Terms are maximal runs of ASCII letters and digits and all characters above ASCII, of which A-Z are
lower-cased. Impacts are integers, a term's weight times the part of its frequency in the document, so equal scores are equal.

A shard bounds what a task holds, whatever the corpus holds: a term in every document is one list in each shard. Only a single longer
document makes a shard larger. Items of a block that share a term share its lists.

Cases: null and empty texts have no terms and are not found; items without terms, or whose terms no document has, find
nothing. Repeated documents are found each, repeated items (id and text) are searched once, and items that share
an id but not the text are ranked each for themselves. Null ids come last among equal scores. Ids of documents are integers.
Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.llm.tables import table
from stallbook.storage import written

TOP = 50
#: Documents of a shard, whose numbers have two bytes, and postings, about.
DOCS = 1 << 16
POSTINGS = 1 << 20
#: Items of a block, about.
ITEMS = 256
#: How deep lists are read at first, and how many times deeper each further time.
FIRST, DEEPER = 64, 4

#: Bytes that are no part of a term become spaces, A-Z become a-z.
SPACED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
IS_TERM = np.array([c != 32 for c in SPACED])

LISTS = "shard long, term binary, length int, docs binary, impacts binary"


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            inside = IS_TERM[np.frombuffer(text, np.uint8)]
            n = int(np.count_nonzero(inside[1:] > inside[:-1])) + bool(inside[0])
            docs, terms = docs + bool(n), terms + n
    yield pa.RecordBatch.from_pydict({"docs": pa.array([docs], pa.int64()), "terms": pa.array([terms], pa.int64())})


class _Shard:
    """Postings of some documents; at the end one list for each term."""

    def __init__(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.postings = 0
        self.term_parts: list[np.ndarray] = []
        self.count_parts: list[np.ndarray] = []

    def add(self, name: int | None, words: list[bytes]) -> None:
        counts, terms = Counter(words), self.terms
        self.term_parts.append(np.fromiter((terms.setdefault(w, len(terms)) for w in counts), np.int32, len(counts)))
        self.count_parts.append(np.fromiter(counts.values(), np.int64, len(counts)))
        self.ids.append(name)
        self.sizes.append(len(words))
        self.postings += len(counts)

    def lists(self, shard: int, docs: int, terms: int) -> pa.RecordBatch:
        order = sorted(range(len(self.ids)), key=lambda d: (self.ids[d] is None, self.ids[d] or 0))
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        lengths = [len(part) for part in self.term_parts]
        term, n = np.concatenate(self.term_parts), np.concatenate(self.count_parts)
        doc = np.repeat(number, lengths)
        norm = np.repeat(50 + 50 * np.array(self.sizes, np.int64) * docs // terms, lengths)
        impact = 1_000_000_000 * n // (1000 * n + 20 * norm)
        by_impact = np.lexsort((doc, -impact, term))
        length = np.bincount(term, minlength=len(self.terms))
        ends = np.concatenate([[0], np.cumsum(length)])
        known = np.array([self.ids[d] for d in order if self.ids[d] is not None], np.int64).tobytes()

        def column(values: np.ndarray, before: bytes) -> pa.Array:
            # The first row holds the ids, then one list for each term.
            offsets = np.concatenate([[0], ends * values.itemsize + len(before)]).astype(np.int32)
            return pa.Array.from_buffers(
                pa.binary(), len(length) + 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(before + values.tobytes())]
            )

        return pa.RecordBatch.from_pydict(
            {
                "shard": pa.array(np.full(len(length) + 1, shard, np.int64)),
                "term": pa.array([b"", *self.terms], pa.binary()),
                "length": pa.array(np.concatenate([[len(order)], length]).astype(np.int32)),
                "docs": column(doc[by_impact].astype(np.uint16), known),
                "impacts": column(impact[by_impact].astype(np.int32), b""),
            }
        )


def _indexed(docs: int, terms: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = text.as_py().translate(SPACED).split()
                if not words:
                    continue
                shard.add(name, words)
                if len(shard.ids) == DOCS or shard.postings >= POSTINGS:
                    yield shard.lists(number, docs, terms)
                    number, shard = number + 1, _Shard()
        if shard.ids:
            yield shard.lists(number, docs, terms)

    return index


def indexed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, int]:
    """The lists of all terms by shard, written, and the number of documents that have terms."""
    # A text of bytes spares tasks the decoding.
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text")).where(F.length("text") > 0)
    counted = rows.select("text").mapInArrow(_sizes, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    n, terms = counted[0] or 0, counted[1] or 0
    return written(rows.mapInArrow(_indexed(n, terms), LISTS), "lists"), n


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
            terms = sorted(set(text.translate(SPACED).split()))
            yield pa.RecordBatch.from_pydict({"item": pa.array([item] * len(terms), pa.int64()), "term": pa.array(terms, pa.binary())})


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The top documents of 0..n-1 and their scores, best first, equal scores by number.

    Each list has documents, no document twice, and what it adds to them, largest first.
    """
    lower, places = np.zeros(n, np.int64), np.arange(n)
    at, frontier = [0] * len(lists), [0] * len(lists)
    reading, depth = range(len(lists)), FIRST
    while True:
        for t in reading:
            docs, adds = lists[t]
            to = min(depth, len(docs))
            lower[docs[at[t] : to]] += adds[at[t] : to]
            at[t], frontier[t] = to, int(adds[to - 1]) if to < len(docs) else 0
        unread = [t for t, bound in enumerate(frontier) if bound]
        upper = lower + sum(frontier)
        for t in unread:
            upper[lists[t][0][: at[t]]] -= frontier[t]
        wanted = (upper > 0) & _can_reach(lower, upper, places, top)
        undecided = wanted & (upper > lower)
        left = np.count_nonzero(undecided)
        if not left:
            break
        reading = [t for t in unread if np.count_nonzero(undecided[lists[t][0][: at[t]]]) < left]
        depth *= DEEPER
    best = places[wanted]
    best = best[np.lexsort((best, -lower[best]))][:top]
    return best, lower[best]


def _can_reach(lower: np.ndarray, upper: np.ndarray, places: np.ndarray, top: int) -> np.ndarray:
    """Documents whose upper bound is not behind the top-th lower bound, which a tie is decided against by number."""
    if len(lower) <= top:
        return np.ones(len(lower), bool)
    least = np.partition(lower, len(lower) - top)[len(lower) - top]
    ties = np.flatnonzero(lower == least)
    last = ties[top - np.count_nonzero(lower > least) - 1]
    return (upper > least) | ((upper == least) & (places <= last))


def _searched(top: int) -> Callable[[pa.Table], pa.Table]:
    def search(lists: pa.Table) -> pa.Table:
        names, n = [], 0
        read: list[tuple[np.ndarray, np.ndarray]] = []
        by_item: dict[int, list[int]] = {}
        for row in lists.select(["term", "length", "docs", "impacts", "weight", "items"]).to_pylist():
            if row["term"] == b"":
                names, n = np.frombuffer(row["docs"], np.int64).tolist(), row["length"]
                continue
            for item in row["items"]:
                by_item.setdefault(item, []).append(len(read))
            read.append((np.frombuffer(row["docs"], np.uint16), np.frombuffer(row["impacts"], np.int32) * np.int64(row["weight"])))
        names += [None] * (n - len(names))
        items, docs, scores = [], [], []
        for item, terms in by_item.items():
            best, score = nra([read[t] for t in terms], n, top)
            items += [item] * len(best)
            docs += [names[d] for d in best.tolist()]
            scores += score.tolist()
        return pa.table({"item": pa.array(items, pa.int64()), "doc_id": pa.array(docs, pa.int64()), "score": pa.array(scores, pa.int64())})

    return search


def search(lists: DataFrame, n: int, items: DataFrame, top: int = TOP, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score of the top documents for each item; lists and n are those of an index."""
    rows = items.select(F.col(id_column).alias("item_id"), F.col(text_column).cast("binary").alias("text")).where(F.length("text") > 0)
    numbered = written(rows.distinct().select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "items")
    blocks = -(-numbered.count() // ITEMS) or 1
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")
    terms = written(numbered.select("item", "text").mapInArrow(_item_terms, "item long, term binary").select("*", block), "terms")
    found = lists.select("term", "length").join(terms.select("term").distinct(), "term").groupBy("term").agg(F.sum("length").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1).cast("double")))
    weights = found.select("term", weight.alias("weight")).where("weight > 0")
    # At most ITEMS items or so for each block and term.
    uses = terms.groupBy("block", "term").agg(F.collect_list("item").alias("items")).join(weights, "term")
    ids = terms.select("block").distinct().select("block", F.lit(b"").alias("term"), F.lit(0).cast("long").alias("weight"), F.array().cast("array<bigint>").alias("items"))
    uses = written(uses.select("block", "term", "weight", "items").unionByName(ids), "uses")
    best = lists.join(uses, "term").groupBy("block", "shard").applyInArrow(_searched(top), "item long, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    ranked = best.select("*", rank.alias("rank")).where(F.col("rank") <= top)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that rank highest for each benchmark item."""
    lists, n = indexed(table(spark, folder, "documents"))
    return search(lists, n, table(spark, folder, "benchmark"))


#: The same by scoring every document.
SQL = r"""
    WITH words AS (
        SELECT doc_id, row, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM (SELECT *, row_number() OVER () AS row FROM documents)
    ), postings AS (
        SELECT doc_id, row, term, count(*) AS tf FROM words GROUP BY ALL
    ), totals AS (
        SELECT count(DISTINCT row) AS docs, count(*) AS terms FROM words
    ), norms AS (
        SELECT row, 50 + (50 * count(*) * any_value(docs)) // any_value(terms) AS m FROM words, totals GROUP BY row
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
        FROM postings, totals GROUP BY term
    ), asked AS (
        SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), scores AS (
        SELECT item_id, text, doc_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
        FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN norms USING (row)
        GROUP BY item_id, text, doc_id, row
    ), ranked AS (
        SELECT item_id, doc_id, score,
               CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank
        FROM scores WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
