"""Spelling variants grouped over permuterm rotations.

A word marked with a terminator is written in all its rotations, b$a for every way to part it into a and b.
Two words that differ in one place share all of a rotation but that place:

* words a x b and a y b, one letter replaced, have rotations b$a x and b$a y, which share the prefix b$a;
* the word a b, from which a x b comes by one more letter, is that prefix itself.

So the rotations of all words are dealt by that prefix and sorted, and each group of one prefix is
scanned: its members are at most one whole word (a b) and words that go on by one letter each, one at most for
each letter of the alphabet. A member's neighbours in the group are counted and its best one is kept without
writing out pairs. A letter within a run of equal ones can be left out in several ways that
give the same word; only the first letter of a run counts as left out, so that every pair of words is counted once.

Prefixes longer than LITERAL characters stand as two polynomial rolling hashes of 61 bits, which take
constant time for each rotation, so that very long words cost time and space in proportion to their length.

Words are maximal runs of `[A-Za-zÀ-ÿ]`, of which A-Z are lower-cased, in whole texts. Where
NOISE divides the CRC-32 of `<id>:<run>`, one code point of the run is deleted. Those of at least SHORTEST code
points that occur LEAST times are grouped: a word's form is its near word that occurs most often (the
smallest in code-point order among equals), if it occurs at least FACTOR times as often. As a form occurs more often
than its word, forms never go in a circle, and the root of a word is found by doubling steps.

Cases: null and empty texts have no words; a null id is written as nothing. Repeated rows count each time.
An empty table gives no rows. Other columns are not read. Nothing but counts of words leaves the tasks, so a
word that makes up a third of a corpus is one row for each task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.llm.tables import table
from stallbook.storage import written

RUN = "[A-Za-zÀ-ÿ]+"
NOISE = 97
SHORTEST = 5
LEAST = 3
FACTOR = 2

TERMINATOR = "$"
LITERAL = 40
#: Different words that a task counts before it passes them on.
HELD = 200_000
#: Rotations in one batch of results, and their characters, about.
BATCH, BATCH_CHARACTERS = 20_000, 1 << 21

MODULUS = (1 << 61) - 1
#: The bases of the two rolling hashes.
BASES = (1_000_003, 754_974_721)

LOWER = {c: c + 32 for c in range(65, 91)}


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words of a task, in several parts if they are many."""
    find, found = re.compile(RUN).findall, Counter()

    def passed_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

    for batch in batches:
        for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
            for run, n in Counter(find(text.translate(LOWER))).items():
                noise = zlib.crc32(f"{name}:{run}".encode())
                if noise % NOISE == 0:
                    place = noise % len(run)
                    run = run[:place] + run[place + 1 :]
                if len(run) >= SHORTEST:
                    found[run] += n
            if len(found) >= HELD:
                yield passed_on()
                found.clear()
    if found:
        yield passed_on()


def counted_words(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """word and n of all words that are long and frequent enough."""
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("name"), F.col(text_column).alias("text")
    ).where(F.length("text") >= SHORTEST)
    return rows.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


def _hashes(word: str, base: int) -> Iterator[tuple[int, int]]:
    """For each place i of word, and its end: hashes of the rotations word[i:]$word[:i] and word[i + 1:]$word[:i]."""
    size, powers, front = len(word), [1], [0]
    for c in word:
        powers.append(powers[-1] * base % MODULUS)
        front.append((front[-1] * base + ord(c) + 1) % MODULUS)
    mark = ord(TERMINATOR) + 1
    for i in range(size + 1):
        tail = (mark * powers[i] + front[i]) % MODULUS
        whole = ((front[size] - front[i] * powers[size - i]) * powers[i] % MODULUS * base + tail) % MODULUS
        if i == size:
            yield whole, 0
        else:
            rest = (front[size] - front[i + 1] * powers[size - i - 1]) * powers[i] % MODULUS * base
            yield whole, (rest + tail) % MODULUS


def rotations(word: str) -> Iterator[tuple[str, str, bool]]:
    """(prefix, letter that goes on, whether it is the first of its run); the letter of a whole word is empty."""
    size = len(word)
    long = [zip(*(_hashes(word, base) for base in BASES), strict=True)] if size + 1 > LITERAL else []
    hashed = [(f"#{a:x}:{b:x}", f"#{c:x}:{d:x}") for (a, c), (b, d) in long[0]] if long else None
    for i in range(size + 1):
        yield (hashed[i][0] if size + 1 > LITERAL else word[i:] + TERMINATOR + word[:i]), "", False
        if i < size:
            prefix = hashed[i][1] if size > LITERAL else word[i + 1 :] + TERMINATOR + word[:i]
            yield prefix, word[i], i == 0 or word[i - 1] != word[i]


def _rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    held = 0

    def batch_of() -> pa.RecordBatch:
        prefix, letter, first, place = zip(*rows, strict=True)
        return pa.RecordBatch.from_pydict(
            {"prefix": pa.array(prefix, pa.string()), "letter": pa.array(letter, pa.string()), "first": pa.array(first), "place": pa.array(place, pa.int64())}
        )

    for batch in batches:
        for place, word in zip(batch.column("place").to_pylist(), batch.column("word").to_pylist(), strict=True):
            for prefix, letter, first in rotations(word):
                rows.append((prefix, letter, first, place))
                held += len(prefix)
                if len(rows) >= BATCH or held >= BATCH_CHARACTERS:
                    yield batch_of()
                    rows, held = [], 0
    if rows:
        yield batch_of()


def neighbours(words: DataFrame) -> DataFrame:
    """place, n_near and the least place among the near words, for each word that has one.

    words has place and word, and is written. A pair of near words meets in exactly one group.
    """
    rotated = words.select("place", "word").mapInArrow(_rotated, "prefix string, letter string, first boolean, place long")
    group = Window.partitionBy("prefix")
    # Within a group, by place; all members that go on by a letter are replacements of each other.
    ranked = group.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    goes_on = F.col("letter") != ""
    scanned = rotated.select(
        "place",
        goes_on.alias("goes_on"),
        "first",
        F.count_if(goes_on).over(ranked).alias("others"),
        F.count_if("first").over(ranked).alias("shorter"),
        F.nth_value(F.when(goes_on, F.col("place")), 1, ignoreNulls=True).over(ranked).alias("best"),
        F.nth_value(F.when(goes_on, F.col("place")), 2, ignoreNulls=True).over(ranked).alias("second"),
        F.min(F.when(F.col("first"), F.col("place"))).over(ranked).alias("best_longer"),
        F.min(F.when(~goes_on, F.col("place"))).over(ranked).alias("whole"),
    )
    left_out = F.when(F.col("first"), F.col("whole"))
    near = F.when(F.col("goes_on"), F.col("others") - 1 + F.when(left_out.isNotNull(), 1).otherwise(0)).otherwise(F.col("shorter"))
    replaced = F.when(F.col("best") == F.col("place"), F.col("second")).otherwise(F.col("best"))
    best = F.when(F.col("goes_on"), F.least(replaced, left_out)).otherwise(F.col("best_longer"))
    return (
        scanned.select("place", near.alias("near"), best.alias("best"))
        .where("near > 0")
        .groupBy("place")
        .agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """place and root of every place that has a form; forms has place and form, and no circles.

    Every step doubles the length of the way from a word to what it points to, so steps grow with the
    logarithm of the longest way, which the factor between counts keeps short.
    """
    ways = written(forms.select("place", F.col("form").alias("root")), "ways")
    while True:
        ahead = ways.select(F.col("place").alias("at"), F.col("root").alias("further"))
        moved = ways.join(ahead, F.col("root") == F.col("at"), "left")
        moved = written(moved.select("place", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ways")
        ways = moved.select("place", "root")
        if moved.where("moved").isEmpty():
            return ways


def grouped(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of all words of docs."""
    ordered = counted_words(docs).orderBy(F.desc("n"), "word")
    # Places grow with the order, the most frequent word first, and stay as they are once written.
    words = written(ordered.select(F.monotonically_increasing_id().alias("place"), "word", "n"), "words")
    near = written(neighbours(words), "near")
    best = words.select(F.col("place").alias("best"), F.col("word").alias("best_word"), F.col("n").alias("best_n"))
    judged = written(
        words.join(near, "place", "left").join(best, "best", "left").select(
            "place", "word", "n", "n_near", F.when(F.col("best_n") >= FACTOR * F.col("n"), F.struct("best", "best_word", "best_n")).alias("form")
        ),
        "forms",
    )
    root = roots(judged.where("form is not null").select("place", F.col("form.best").alias("form")))
    named = root.join(words.select(F.col("place").alias("root"), F.col("word").alias("root_word")), "root").select("place", "root_word")
    return judged.join(named, "place", "left").select(
        "word",
        F.col("form.best_word").alias("form"),
        F.coalesce("root_word", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.col("form.best_n").alias("form_n"),
    )


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the documents with its form and root."""
    return grouped(table(spark, folder, "documents"))


#: The same by joining pairs of words that are equal after a letter is left out of one or both; CRC-32 is spelt out.
SQL = r"""
    WITH RECURSIVE crcs AS (
        SELECT list(crc ORDER BY byte) AS of_byte
        FROM (
            SELECT byte, list_reduce(list_prepend(byte, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc
            FROM range(256) AS bytes(byte)
        )
    ), runs AS (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents
    ), lowered AS (
        SELECT name, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM runs GROUP BY ALL
    ), coded AS (
        SELECT run, n, flatten(list_transform(string_split(name || ':' || run, ''), lambda c:
            CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)) AS bytes
        FROM lowered
    ), hashed AS (
        SELECT run, n, xor(list_reduce(
            list_prepend(4294967295, list_transform(bytes, lambda b: CAST(b AS BIGINT))),
            lambda c, b: xor(c >> 8, of_byte[xor(c & 255, b) + 1])
        ), 4294967295) AS h
        FROM coded, crcs
    ), noisy AS (
        SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
    ), words AS (
        SELECT word, CAST(sum(n) AS BIGINT) AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
    ), holes AS (
        SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
    ), pairs AS (
        SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION
        SELECT a.word, b.word, b.n FROM words a JOIN holes b ON a.word = b.rest
        UNION
        SELECT b.word, a.word, a.n FROM words a JOIN holes b ON a.word = b.rest
    ), best AS (
        SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
               row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place
        FROM pairs
    ), judged AS (
        SELECT words.word, n, coalesce(n_near, 0) AS n_near,
               CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
        FROM words LEFT JOIN best ON words.word = best.word AND place = 1
    ), ways AS (
        SELECT word, word AS root FROM judged
        UNION ALL
        SELECT ways.word, judged.form FROM ways JOIN judged ON ways.root = judged.word WHERE judged.form IS NOT NULL
    ), ends AS (
        SELECT ways.word, root FROM ways JOIN judged ON ways.root = judged.word WHERE judged.form IS NULL
    )
    SELECT judged.word, form, root, n, n_near, form_n FROM judged JOIN ends ON judged.word = ends.word
"""
