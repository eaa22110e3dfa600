"""Shards by extendible hashing.

A row's bits are a hash of its key and text, then a hash of its place. A bucket is a
prefix of bits; one that holds more bytes than a shard may is split on another bit, the
others stay. The directory of leaves is found from byte sums of prefixes: a leaf is the
shortest prefix that fits. Sums are taken to a depth a few bits beyond what equal shares
need; rows of prefixes that are too large even there go on to more bits. Copies of one
row differ in their second hash, so a key that holds a third of all rows splits as well.

Everything is DataFrame code, on narrow rows; the directory grows with the number of
shards and stays distributed.

Defined results: a null text has no bytes; a null key is hashed like any other; a row
larger than the limit gets a shard of its own; an empty table has no shards; repeated
rows are kept, each in a shard. Rows with equal keys may be in different shards. Other
columns pass through ``write_shards``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written

#: Most text bytes of a shard.
SHARD_BYTES = 32 << 20
#: Bits summed beyond those that equal shares need.
SPARE_BITS = 4
BITS = 128


def _bits(value):
    return F.lpad(F.bin(value), 64, "0")


def _leaves(rows: DataFrame, start: int, depth: int, limit: int) -> DataFrame:
    """(cell, depth, shard_bytes, shard_rows) of prefixes of ``depth`` bits: the shortest prefix
    of at least ``start`` bits that fits or holds one row; depth null where none does."""
    cells = rows.groupBy(F.substring("bits", 1, depth).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
    each = cells.select("cell", "bytes", "n", F.explode(F.sequence(F.lit(start), F.lit(depth))).alias("d"))
    each = each.withColumn("prefix", F.expr("substring(cell, 1, d)"))
    sums = each.groupBy("prefix", "d").agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
    fit = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | (F.col("d") == BITS))
    first = each.select("cell", "prefix", "d").join(fit, ["prefix", "d"], "left").groupBy("cell")
    return first.agg(F.min(F.when(F.col("shard_bytes").isNotNull(), F.struct("d", "shard_bytes", "shard_rows"))).alias("leaf"))


def assign(docs: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, bytes, shard, depth, shard_bytes, shard_rows) for every row, and the columns ``keep``.

    ``shard`` is the prefix as a string of bits, empty if all rows fit into one.
    """
    size = F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)).cast("long").alias("_bytes")
    rows = docs.select(F.col(f"`{key}`").alias("_key"), size, F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("_h"), F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row") if keep else F.lit(0).alias("_row"))
    # Written once, so that a row's place stays what it is.
    rows = written(rows.withColumn("_place", F.monotonically_increasing_id()), "shard-rows")
    rows = rows.withColumn("bits", F.concat(_bits(F.col("_h")), _bits(F.xxhash64("_place")))).withColumnRenamed("_bytes", "bytes")
    total = rows.agg(F.sum("bytes").alias("n")).collect()[0]["n"] or 0
    depth, start, levels, rest = min(BITS, SPARE_BITS + max(0, math.ceil(math.log2(max(1, total) / limit)))), 0, [], rows.select("bits", "bytes")
    while True:
        leaves = written(_leaves(rest, start, depth, limit), "shard-leaves")
        levels.append((depth, leaves))
        large = leaves.where("leaf IS NULL").select("cell")
        if depth == BITS or large.isEmpty():
            break
        rest = rest.join(large, F.substring("bits", 1, depth) == F.col("cell"), "left_semi")
        start, depth = depth + 1, min(BITS, depth + 2 * SPARE_BITS)
    leaf = []
    for i, (depth, leaves) in enumerate(levels):
        rows = rows.join(leaves.select(F.col("cell").alias(f"_cell{i}"), F.col("leaf").alias(f"_leaf{i}")), F.substring("bits", 1, depth) == F.col(f"_cell{i}"), "left")
        leaf.append(f"_leaf{i}")
    rows = rows.withColumn("leaf", F.coalesce(*leaf))
    shard = F.expr("substring(bits, 1, leaf.d)")
    own = [F.col("_row.*")] if keep else []
    return rows.select(F.col("_key").alias(key), "bytes", shard.alias("shard"), F.col("leaf.d").alias("depth"), F.col("leaf.shard_bytes").alias("shard_bytes"), F.col("leaf.shard_rows").alias("shard_rows"), *own)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> None:
    """Write all rows and columns as Parquet, one folder ``shard_bits=b<bits>`` per shard."""
    packed = docs.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_all"))
    out = assign(packed, limit, "_k", "_t", ("_all",)).select(F.concat(F.lit("b"), "shard").alias("_shard"), "_all.*")
    out.repartition("_shard").withColumnRenamed("_shard", "shard_bits").write.partitionBy("shard_bits").parquet(path)
