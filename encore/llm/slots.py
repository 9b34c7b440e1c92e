"""Operator 5, sharding: fixed virtual slots.

Records hash into a fixed number of slots (thousands), bytes are summed per slot, and a small versioned table
maps slots to shards. Rebalancing edits that table: a shard keeps its largest slots up to an equal share of the
bytes, the others move to whichever shard is then the lightest. Data never rehashes, only slots move. Everything
is DataFrame work; the map has ``n_slots`` rows whatever the size of the data, which bounds every broadcast and
the one array that the greedy step runs over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_SLOTS = 4096
#: Equal rows numbered by one task.
COPIES = 4096


def with_slots(docs: DataFrame, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, copy, virtual_slot): size is UTF-8 bytes of the text (null: none) plus 8.

    The slot is a hash of the id, the text's checksum and the number of the copy (0 for a row unlike all others), so
    repeated rows, and rows without an id or a text, spread over all slots instead of sharing one. Equal rows are
    counted, before the shuffle, and written out again with their numbers; a group of more than ``COPIES`` is dealt to
    several tasks for that.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))).alias("part")
    large = counted.where(F.col("n") > COPIES).select("*", parts).repartition("doc_id", "size", "text_crc32", "part")
    every = counted.where(F.col("n") <= COPIES).withColumn("part", F.lit(0).cast("long")).unionByName(large)
    first = F.col("part") * COPIES
    copy = F.explode(F.sequence(first, F.least(F.col("n"), first + COPIES) - 1)).alias("copy")
    return every.select("doc_id", "size", "text_crc32", copy).withColumn(
        "virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "copy"), F.lit(n_slots)).cast("int"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """(virtual_slot, n_rows, bytes): summed before the shuffle, at most n_slots rows after."""
    return rows.groupBy("virtual_slot").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"))


def initial_map(spark: SparkSession, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """Version 1: (version, virtual_slot, shard), slots dealt in turn."""
    return spark.range(n_slots).select(F.lit(1).alias("version"), F.col("id").cast("int").alias("virtual_slot"),
                                       (F.col("id") % n_shards).cast("int").alias("shard"))


def rebalance(slot_map: DataFrame, weights: DataFrame, n_shards: int) -> DataFrame:
    """The next version of a map for these slot bytes: (version, virtual_slot, shard), every slot once.

    ``n_shards`` may differ from the map's: slots of removed shards move, new shards are filled. A shard keeps its
    slots, largest first (ties: smaller slot), while their bytes stay within an equal share of all bytes; slots
    without rows stay where their shard still exists. The rest goes, largest first, to the shard with the fewest
    bytes (ties: smaller shard). Shards differ by less than the largest moved slot whenever every slot is below an
    equal share; a slot above it (one row larger than that) makes its shard the largest.
    """
    sized = slot_map.join(F.broadcast(weights), "virtual_slot", "left").select(
        "version", "virtual_slot", "shard", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    whole = Window.partitionBy("version")  # the map's n_slots rows
    ordered = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.withColumn("upto", F.sum("bytes").over(ordered)).withColumn("share", F.sum("bytes").over(whole) / n_shards)
    placed = placed.withColumn("stays", (F.col("shard") < n_shards) & ((F.col("upto") <= F.col("share")) | (F.col("bytes") == 0)))
    one = placed.agg(F.max("version").alias("version"), F.collect_list(F.struct("virtual_slot", "shard", "bytes", "stays")).alias("slots"))
    loads = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)), lambda s: F.aggregate(
        F.filter("slots", lambda x: x["stays"] & (x["shard"] == s)), F.lit(0).cast("long"), lambda a, x: a + x["bytes"]))
    one = one.withColumn("loads", loads).withColumn("moving", F.array_sort(F.transform(F.filter("slots", lambda x: ~x["stays"]), lambda x: F.struct(
        (-x["bytes"]).alias("minus"), x["virtual_slot"].alias("virtual_slot")))))
    start = F.struct(F.col("loads"), F.array().cast("array<struct<virtual_slot:int,shard:int>>").alias("moved"))

    def place(acc: Column, x: Column) -> Column:
        to = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(F.transform(acc["loads"], lambda v, i: F.when(i == to, v - x["minus"]).otherwise(v)).alias("loads"),
                        F.concat(acc["moved"], F.array(F.struct(x["virtual_slot"].alias("virtual_slot"), to.alias("shard")))).alias("moved"))

    moved = F.aggregate("moving", start, place)["moved"]
    kept = F.transform(F.filter("slots", lambda x: x["stays"]), lambda x: F.struct(x["virtual_slot"].alias("virtual_slot"), x["shard"].alias("shard")))
    return one.select((F.col("version") + 1).alias("version"), F.explode(F.concat(kept, moved)).alias("x")) \
        .select("version", F.col("x.virtual_slot").alias("virtual_slot"), F.col("x.shard").alias("shard"))


def store_map(slot_map: DataFrame, path: str) -> None:
    """Append a version to the stored map (a folder per version); storing a version again replaces it."""
    slot_map.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version, the latest unless named."""
    stored = spark.read.parquet(path).select("version", "virtual_slot", "shard")
    wanted = version if version is not None else stored.agg(F.max("version")).first()[0]
    return stored.where(F.col("version") == wanted)


def place(rows: DataFrame, slot_map: DataFrame, weights: DataFrame) -> DataFrame:
    """``rows`` with their shard and ``slot``, the place in the shard (0, 1, ... without gaps).

    A shard's virtual slots follow each other; inside one, rows are ordered by id, checksum, size and copy. Only rows of
    one virtual slot are sorted together; the slots' offsets come from the ``n_slots`` row map.
    """
    own = slot_map.join(F.broadcast(weights), "virtual_slot")
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    own = own.select("virtual_slot", "shard", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "copy")
    numbered = rows.withColumn("within", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(own), "virtual_slot").withColumn("slot", (F.col("first") + F.col("within")).cast("long")).drop("first", "within", "copy")


def shard(docs: DataFrame, n_shards: int = 24, n_slots: int = N_SLOTS, id_col: str = "doc_id", text_col: str = "text",
          slot_map: DataFrame | None = None) -> DataFrame:
    """Shards near equal in bytes: doc_id, size, text_crc32, virtual_slot, shard, slot, map_version for every row.

    Starts from ``slot_map`` (default: version 1) and rebalances it once for these rows. Null texts have no bytes,
    null ids are ids like any other, repeated rows each take a place; whole texts; extra columns are ignored; an
    empty table gives an empty result.
    """
    rows = with_slots(docs, n_slots, id_col, text_col)
    weights = slot_bytes(rows)
    edited = rebalance(slot_map if slot_map is not None else initial_map(docs.sparkSession, n_shards, n_slots), weights, n_shards)
    return place(rows, edited.select("virtual_slot", "shard"), weights)
