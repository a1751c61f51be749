"""Fingerprints of source files, and the check that a run read one stable input.

Every file, of any size, has a content digest that is read in splits: its lines are hashed, and the hashes are
summed, once plainly and once weighed by line number. Sums can be taken split by split in any order, so the
digest depends on neither splits nor partitions, yet on every byte and on the order of the lines. A line's
number is its place in its split plus the lines of the splits before, and as the weighed sum is linear in
it, one pass over the file is enough: what a split begins with is put in when the splits are added up.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HASHED_BYTES = 512 << 20
CHANGED = "The input changed during the run."


def _files(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Input workbook not found: {path}") from error
        raise


def _seen(files: DataFrame) -> DataFrame:
    seen = F.concat_ws("@", F.col("length").cast("string"), F.col("modificationTime").cast("string"))
    return files.select("path", "length", F.sha2(seen, 256).alias("sha256"))


# An MD5 is taken as four numbers of 32 bits.
PARTS = (1, 9, 17, 25)


def hash_parts(content: Column) -> list[Column]:
    hashed = F.md5(content)
    return [F.conv(F.substring(hashed, at, 8), 16, 10).cast("decimal(10,0)") for at in PARTS]


def _weighed(place: Column, value: Column) -> Column:
    """Exact product of a place below 2^63 and a number of 32 bits."""
    return place.cast("decimal(19,0)") * value


def digest_text(lines: Column, sums: list[Column], moments: list[Column]) -> Column:
    return F.sha2(F.concat_ws("@", *[part.cast("string") for part in (lines, *sums, *moments)]), 256)


def ordered_digest(lines: DataFrame, place: Column, content: Column, *keys: Column) -> DataFrame:
    """One row for each value of keys: lines and digest of numbered content, in the order of place."""
    parts = [f"part_{number}" for number in range(len(PARTS))]
    placed = lines.select(*keys, place.alias("place"), *[part.alias(name) for part, name in zip(hash_parts(content), parts)])
    summed = placed.groupBy(*placed.columns[: len(keys)]).agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.sum(name).alias(f"sum_{name}") for name in parts],
        *[F.sum(_weighed(F.col("place"), F.col(name))).alias(f"moment_{name}") for name in parts],
    )
    digest = digest_text(
        F.col("lines"), [F.col(f"sum_{name}") for name in parts], [F.col(f"moment_{name}") for name in parts]
    )
    return summed.select(*placed.columns[: len(keys)], "lines", digest.alias("digest"))


def _lines_digest(spark: SparkSession, path: str) -> DataFrame:
    """file and digest of every file that has lines: all bytes, and the order of what stands between line feeds."""
    parts = [f"part_{number}" for number in range(len(PARTS))]
    hashed = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"),
        *[part.alias(name) for part, name in zip(hash_parts(F.col("value").cast("binary")), parts)],
    )
    # Ids count on within a partition, so those of a split are its first one and the places after it.
    place = F.col("id").bitwiseAND((1 << 33) - 1)
    splits = hashed.groupBy("file", "split").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min(place).alias("first"),
        *[F.sum(name).cast("decimal(20,0)").alias(f"sum_{name}") for name in parts],
        *[F.sum(_weighed(place, F.col(name))).cast("decimal(38,0)").alias(f"moment_{name}") for name in parts],
    )
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    shifted = splits.withColumn("shift", F.coalesce(F.sum("lines").over(earlier), F.lit(0)) - F.col("first"))
    moments = [
        F.sum(F.col(f"moment_{name}") + F.col("shift").cast("decimal(17,0)") * F.col(f"sum_{name}")) for name in parts
    ]
    sums = [F.sum(f"sum_{name}") for name in parts]
    return shifted.groupBy("file").agg(digest_text(F.sum("lines"), sums, moments).alias("digest"))


def fingerprint(
    spark: SparkSession, path: str, hashed_bytes: int = HASHED_BYTES
) -> DataFrame:
    """One row for each file: path, length, sha256, whether that is the file's own, and content_digest.

    The content of every file is read, and content_digest covers it at every size, order included; it is what
    two fingerprints are compared by. A file's own SHA-256 takes it as one value in one task, so files
    beyond hashed_bytes have that of their length and digest. Spark tests the length before it reads a file.
    """
    files = _files(spark, path)
    digests = _lines_digest(spark, path)
    listed = files.select("path", "length", F.col("_metadata.file_path").alias("file")).join(digests, "file", "left")
    # A file without lines has its length alone.
    content = F.sha2(F.concat_ws("@", F.col("length").cast("string"), F.coalesce("digest", F.lit(""))), 256)
    own = files.where(F.col("length") <= hashed_bytes).select(F.col("path").alias("of"), F.sha2("content", 256).alias("own"))
    return listed.join(own, F.col("path") == F.col("of"), "left").select(
        "path",
        "length",
        F.coalesce("own", content).alias("sha256"),
        F.col("own").isNotNull().alias("of_content"),
        content.alias("content_digest"),
    )


def listing(spark: SparkSession, path: str) -> DataFrame:
    """The same columns without reading any content."""
    seen = _seen(_files(spark, path)).withColumn("of_content", F.lit(False))
    return seen.withColumn("content_digest", F.col("sha256"))


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that appeared, vanished or differ between two fingerprints."""
    old, new = (
        side.select("path", F.col("sha256").alias(f"sha256_{when}"), F.col("content_digest").alias(f"digest_{when}"))
        for side, when in ((before, "before"), (after, "after"))
    )
    return old.join(new, "path", "full").where(~F.col("digest_before").eqNullSafe(F.col("digest_after")))


def require_unchanged(before: DataFrame, after: DataFrame) -> None:
    if not changed_files(before, after).isEmpty():
        raise ValueError(CHANGED)
