"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Every record hashes into one of SLOTS virtual slots, for ever. Shards own slots, not records: a
small table (version, slot, shard, bytes, rows) says who owns which, and rebalancing adds a version
of that table in which some slots have moved. Nothing about a record changes but its shard.

Law of the assignment: `bytes`. A version is edited from the one before by the bytes now in each
slot, so that shard sizes are near equal; records of a slot always stay together.

Cases: a null text has no bytes, so its size is 1, and crc32 0 like an empty one. Null doc_ids are
hashed like any value. Repeated rows hash alike and share a slot; each still gets its own place.
An empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.llm.tables import table, texts
from stallbook.storage import shared_folder, written

#: Virtual slots. Fixed: it bounds the map, which is therefore safe to broadcast, and with a few
#: hundred slots a shard the sizes can be made equal to a small fraction of a percent.
SLOTS = 4096
SHARDS = 16


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every record; the text itself is read once."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return (
        texts(docs)
        .select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
        .withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(SLOTS)).cast("int"))
    )


def slot_totals(records: DataFrame) -> DataFrame:
    """Bytes and rows of each virtual slot that has records."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(spark: SparkSession, shards: int = SHARDS) -> DataFrame:
    """Version 0: slots dealt round, before anything is known of their sizes."""
    return spark.range(0, SLOTS, 1, 1).select(
        F.lit(0).alias("version"),
        F.col("id").cast("int").alias("virtual_slot"),
        F.pmod("id", F.lit(shards)).cast("int").alias("shard"),
    )


def rebalanced(current: DataFrame, totals: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version of the map, edited by the bytes in each slot.

    Slots are gone through from the largest to the smallest. A slot stays where it is while its
    shard has room below the mean; otherwise the emptiest shard takes it. So few slots move, and no
    shard exceeds the mean by more than the last slot put on it. The map has SLOTS rows, whatever
    the corpus: it is folded as one array. `shards` may differ from that of the current version;
    slots of a shard that is gone are dealt anew.
    """
    slots = current.select("version", "virtual_slot", "shard").join(totals, "virtual_slot", "left").select(
        F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"),
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        "virtual_slot",
        "shard",
        "version",
    )
    listed = slots.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual_slot", "shard", "rows"))).alias("slots"),
        (F.sum("bytes") / F.lit(shards)).alias("mean"),
        (F.max("version") + 1).alias("version"),
    )

    def place(state, slot):
        size = -slot["less"]
        home = F.least(slot["shard"], F.lit(shards - 1)) + 1
        # The emptiest of the first: array_position finds the lowest of equal loads.
        emptiest = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        stays = (slot["shard"] < shards) & (F.element_at(state["loads"], home) + size <= F.col("mean"))
        chosen = F.when(stays, home).otherwise(emptiest)
        loads = F.transform(state["loads"], lambda load, i: load + F.when(i + 1 == chosen, size).otherwise(F.lit(0).cast("long")))
        return F.struct(loads.alias("loads"), F.concat(state["homes"], F.array(chosen - 1)).alias("homes"))

    start = F.struct(
        F.array_repeat(F.lit(0).cast("long"), shards).alias("loads"),
        F.array().cast("array<int>").alias("homes"),
    )
    return (
        listed.withColumn("homes", F.aggregate("slots", start, place)["homes"])
        .select("version", F.explode(F.arrays_zip("slots", "homes")).alias("z"))
        .select(
            "version",
            F.col("z.slots.virtual_slot").alias("virtual_slot"),
            F.col("z.homes").alias("shard"),
            (-F.col("z.slots.less")).alias("bytes"),
            F.col("z.slots.rows").alias("rows"),
        )
    )


def store_map(version: DataFrame, folder: str) -> DataFrame:
    """Add a version to the stored map and return it as read back. Versions are never overwritten."""
    number = version.agg(F.max("version")).first()[0]
    path = f"{folder}/version={number}"
    version.drop("version").write.mode("errorifexists").parquet(path)
    return version.sparkSession.read.parquet(path).withColumn("version", F.lit(number))


def assigned(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with the shard that owns their slot. The map has SLOTS rows, hence the broadcast."""
    return records.join(F.broadcast(slot_map.select("virtual_slot", "shard", "version")), "virtual_slot")


def numbered(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with shard and a gapless place `slot` in it, without a sort of a whole shard.

    A shard's places run through its virtual slots in order: the map's row counts give each slot its
    start, and only records of one slot are ordered together. Equal records are counted first and
    written out again afterwards, so that repeats do not meet in one task before that.
    """
    starts = slot_map.select(
        "virtual_slot",
        "shard",
        "version",
        (F.sum("rows").over(Window.partitionBy("shard").orderBy("virtual_slot")) - F.col("rows")).alias("start"),
    )
    distinct = records.groupBy("virtual_slot", "doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    before = F.sum("copies").over(
        Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)
    ) - F.col("copies")
    return (
        distinct.withColumn("before", before)
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .withColumn("slot", F.col("start") + F.col("before") + F.col("copy"))
        .drop("start", "before", "copies", "copy")
    )


def op1_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    records = written(sized(table(spark, folder, "documents")), "sized")
    maps = f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}"
    dealt = store_map(first_map(spark), maps)
    edited = store_map(rebalanced(dealt, slot_totals(records)), maps)
    return numbered(records, edited).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )

