"""Exact duplicates by an exchange of compressed fingerprints.

1. Every partition hashes its texts, sorts the distinct fingerprints and sends each owner, who owns
   one range of fingerprints, its slice as a Golomb code of the gaps (parameter a power of two).
   Its own bitmap of what it saw repeated is cut the same way, so what is sent grows with the
   fingerprints and not with senders times owners.
2. An owner decodes the slices of all senders and returns to each a bitmap of those fingerprints
   that another sender has too.
3. Senders turn the bitmaps, and what they saw repeated themselves, into suspect fingerprints. Only
   texts of suspects are shuffled, and compared byte for byte, so an unlucky fingerprint costs
   work but never joins different texts.

Texts are equal when identical after each run of ASCII white space has become one space. Of equal
texts the row with the smallest doc_id stays; null doc_ids come last.

Cases: a null text is an empty one, and a text of white space equals a single space, not an empty
text. Of repeated rows with one doc_id and text, one counts as kept. An empty table gives no rows. Columns
other than id and text pass through `deduplicate` and are not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm.tables import first_of_repeats, join_side, table, texts, without_rows
from stallbook.storage import written

#: Bits of a fingerprint. At 10^11 texts some ten million are suspected without cause.
BITS = 48
#: Fingerprints that a sender sorts at once, at least, and that an owner gets, about.
CHUNK = 1 << 16
OWNED = 500_000

#: A sender waits until its slices have about so many fingerprints, within bounds of memory.
LEAST, LARGEST = 64, 1 << 22

#: A row is a document's digest or, with nothing else, a slice for an owner.
ROWS = (
    "doc_id long, text_sha256 string, fp long, row long,"
    " slice struct<sender:long,owner:int,n:int,rice:int,unary:binary,rest:binary,repeated:binary>"
)
NAMES = ["doc_id", "text_sha256", "fp", "row", "slice"]
SLICE = pa.struct(
    [("sender", pa.int64()), ("owner", pa.int32()), ("n", pa.int32()), ("rice", pa.int32())]
    + [(name, pa.binary()) for name in ("unary", "rest", "repeated")]
)


def normal(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def golomb(values: np.ndarray, width: int) -> tuple[int, bytes, bytes]:
    """Golomb code of the gaps of sorted distinct values below 2^width: parameter, quotients, rests.

    Quotients are in unary, a one after so many zeros, and stand apart from the remainders.
    """
    gaps = np.diff(values, prepend=np.int64(-1)) - 1
    rice = max(0, int((2.0**width / len(values) * 0.69)).bit_length() - 1)
    ends = np.cumsum((gaps >> rice) + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    rest = ((gaps[:, None] >> np.arange(rice)) & 1).astype(np.uint8)
    return rice, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def ungolomb(n: int, rice: int, unary: bytes, rest: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * rice].reshape(n, rice).astype(np.int64)
    return np.cumsum((quotients << rice) + (bits << np.arange(rice)).sum(axis=1) + 1) - 1


def _sender(owners: int):
    width = BITS - (owners - 1).bit_length()  # owners is a power of two
    size = min(max(CHUNK, LEAST * owners), LARGEST)

    def cut(parts: list[np.ndarray], sender: int) -> Iterator[pa.RecordBatch]:
        """The slices of one sender, as rows of which only `slice` is filled."""
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        owner = values >> width
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        ends = np.append(starts[1:], len(values))
        for at in range(0, len(starts), 4096):
            slices = []
            for low, high in zip(starts[at : at + 4096], ends[at : at + 4096], strict=True):
                rice, unary, rest = golomb(values[low:high] & ((1 << width) - 1), width)
                repeated = np.packbits(counts[low:high] > 1).tobytes()
                slices.append((sender, int(owner[low]), int(high - low), rice, unary, rest, repeated))
            fields = [pa.array(column, f.type) for column, f in zip(zip(*slices, strict=True), SLICE, strict=True)]
            empty = [pa.nulls(len(slices), t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*empty, pa.StructArray.from_arrays(fields, fields=list(SLICE))], names=NAMES)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        sender = TaskContext.get().partitionId() << 24
        row, waiting, held = 0, [], 0
        for batch in batches:
            numbers = pa.array(first + row + np.arange(batch.num_rows))
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, numbers, pa.nulls(batch.num_rows, SLICE)], names=NAMES)
            prints = batch.column("fp").to_numpy()
            for low in range(0, len(prints), CHUNK):
                waiting.append(prints[low : low + CHUNK])
                held += len(waiting[-1])
                if held >= size:
                    yield from cut(waiting, sender)
                    waiting, held, sender = [], 0, sender + 1
        if held:
            yield from cut(waiting, sender)

    return send


def _answer(key: tuple, slices: pd.DataFrame) -> pd.DataFrame:
    """What an owner returns: for each slice the bitmap of fingerprints that came more than once."""
    values = [ungolomb(x.n, x.rice, x.unary, x.rest) for x in slices.itertuples()]
    _, inverse, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    bits = np.split(shared, np.cumsum([len(v) for v in values])[:-1])
    return pd.DataFrame({"sender": slices["sender"], "owner": slices["owner"], "bitmap": [np.packbits(b).tobytes() for b in bits]})


def _suspects(owners: int):
    width = BITS - (owners - 1).bit_length()

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for x in batch.itertuples():
                bits = np.unpackbits(np.frombuffer(x.bitmap, np.uint8))[: x.n].astype(bool)
                bits |= np.unpackbits(np.frombuffer(x.repeated, np.uint8))[: x.n].astype(bool)
                if bits.any():
                    yield pd.DataFrame({"fp": ungolomb(x.n, x.rice, x.unary, x.rest)[bits] | (x.owner << width)})

    return found


def digests(docs: DataFrame, owners: int) -> tuple[DataFrame, DataFrame]:
    """Digests of all rows, and the slices that senders have for owners, both from one written table."""
    hashed = texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), normal(F.col("text")).alias("body"))
    hashed = hashed.select(
        "doc_id",
        F.sha2("body", 256).alias("text_sha256"),
        F.shiftrightunsigned(F.xxhash64("body"), 64 - BITS).alias("fp"),
    )
    rows = written(hashed.mapInArrow(_sender(owners), ROWS), "digests")
    return rows.where("fp is not null").drop("slice"), rows.where("fp is null").select("slice.*")


def exchange(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Digests of all rows, and the suspect fingerprints, both written."""
    owners = 1 << max(0, -(-docs.count() // OWNED) - 1).bit_length()
    rows, sent = digests(docs, owners)
    answers = sent.drop("repeated").groupBy("owner").applyInPandas(_answer, "sender long, owner int, bitmap binary")
    back = sent.join(answers, ["sender", "owner"])
    suspects = written(back.mapInPandas(_suspects(owners), "fp long").distinct(), "suspects")
    return rows, suspects


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and a row number."""
    rows, suspects = exchange(docs)
    suspect = join_side(suspects)
    bodies = (
        texts(docs)
        .select("doc_id", normal(F.col("text")).alias("body"))
        .withColumn("fp", F.shiftrightunsigned(F.xxhash64("body"), 64 - BITS))
        .join(suspect, "fp", "left_semi")
    )
    # Copies meet in each task before the shuffle; what is compared are the bytes of the texts.
    verified = (
        bodies.groupBy("body")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("body", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    first = (
        rows.join(suspect, "fp", "left_semi")
        .groupBy("text_sha256")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row"))["row"].alias("keep_row"))
    )
    found = written(verified.join(first, "text_sha256"), "duplicates").withColumnRenamed("text_sha256", "group_sha256")
    return rows.join(join_side(found), F.col("text_sha256") == F.col("group_sha256"), "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "text_sha256",
        "row",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with one row, all columns, of each group of equal texts."""
    found = written(groups(docs), "groups")
    mark = F.sha2(normal(F.col("text")), 256)
    lead = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    dropped = found.where(~lead).select("doc_id", F.col("text_sha256").alias("mark"))
    repeated = found.where(lead & ~F.col("kept")).select("doc_id", F.col("text_sha256").alias("mark")).distinct()
    return first_of_repeats(without_rows(docs, dropped, mark), repeated, mark)


def op5_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one that stays for it."""
    return groups(table(spark, folder, "documents")).drop("row")
