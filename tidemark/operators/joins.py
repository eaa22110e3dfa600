"""Joins that stay balanced when one key holds a large share of the rows.

A hash or sort-merge join sends every row of a key to one task. When a key can
hold a third of all rows (a hot customer, the Unknown member), that task does a
third of the job. ``skew_safe_join`` counts such keys, joins them separately against a broadcast (or salted) copy of their few partner rows, and
joins the rest normally. Hot-key detection only steers the plan; every row is
joined exactly once, so results are whole.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import broadcast_bound, fits_broadcast, known_rows, row_count, stage

# A key is hot when it holds at least this many rows: a fixed budget for one task,
# whatever the size of the table.
HOT_MIN_ROWS = 1_000_000
SALT_BUCKETS = 64
# Hashes by which keys are counted before they are counted one by one.
HOT_BUCKETS = 1024


# Bits of the filter of staged keys; at most FILTER_BITS / 64 rows of 16 bytes are broadcast.
FILTER_BITS = 1 << 27


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """(_word, _bits): a bitmap of the keys' hashes, 64 bits a row, whatever their number."""
    slot = keys.where(F.col(key).isNotNull()).select(F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("_slot"))
    return slot.groupBy(F.shiftright("_slot", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_slot & 63 as int))")).alias("_bits"))


def rows_with_keys(df: DataFrame, key: str, keys: DataFrame, keys_key: str | None = None) -> DataFrame:
    """The rows of ``df`` whose key is among ``keys`` (a semi join).

    Keys of a checked, bounded size are broadcast. Beyond that, a bitmap of their
    hashes (of a fixed size) is, so that of ``df`` only the rows that pass it are
    shuffled for the exact join.
    """
    if known_rows(df) == 0:
        return df
    keys_key = keys_key or key
    wanted = keys.select(F.col(keys_key).alias(key))
    if fits_broadcast(keys):
        return df.join(F.broadcast(wanted), key, "left_semi").select(*df.columns)
    slot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    marked = df.withColumn("_slot", slot).withColumn("_word", F.shiftright("_slot", 6))
    bits = F.broadcast(key_filter(wanted, key).withColumnRenamed("_word", "_w"))
    passed = marked.join(bits, (F.col("_word") == F.col("_w")) & (F.getbit("_bits", (F.col("_slot").bitwiseAND(F.lit(63))).cast("int")) == 1), "left_semi")
    return passed.select(*df.columns).join(wanted, key, "left_semi").select(*df.columns)


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int | None = None) -> DataFrame | None:
    """Keys of ``df`` with at least ``min_rows`` rows, the largest first, or None.

    Counted over all rows (map-side partial sums): by a hash of the keys first, so
    that only keys of a hash with as many rows are shuffled. At most
    ``broadcast_bound()`` keys are returned, so the result may be broadcast; the
    list only steers the plan.
    """
    min_rows = HOT_MIN_ROWS if min_rows is None else min_rows
    if row_count(df) < min_rows:
        return None
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HOT_BUCKETS))
    full = df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_rows)
    full = [r["_b"] for r in full.collect()]  # HOT_BUCKETS rows at most
    if not full:
        return None
    if len(full) < HOT_BUCKETS:
        df = df.where(bucket.isin(full))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_rows)
    found = stage(counts.orderBy(F.desc("_n")).limit(broadcast_bound()).select(*keys))
    return found if row_count(found) > 0 else None


def _equi(left_keys: Sequence[str], right_keys: Sequence[str]) -> Column:
    cond = None
    for lk, rk in zip(left_keys, right_keys):
        c = F.col(lk) == F.col(rk)
        cond = c if cond is None else cond & c
    return cond


def skew_safe_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                   right_keys: Sequence[str], how: str = "inner",
                   residual: Callable[[], Column] | None = None,
                   broadcast_rows: int | None = None,
                   detect_hot: bool = True) -> DataFrame:
    """Equi join (plus an optional residual predicate) of a large ``left`` with
    a ``right`` that has few rows per key.

    Column names of ``left`` and ``right`` must be disjoint (rename the right
    keys); ``residual`` builds its predicate from ``F.col`` names.
    ``how`` is one of inner, left, left_semi, left_anti.
    """
    if broadcast_rows is None:
        broadcast_rows = broadcast_bound()

    def cond() -> Column:
        c = _equi(left_keys, right_keys)
        return c if residual is None else c & residual()

    # A right side of checked, bounded size is broadcast whole: no shuffle of
    # the left at all, so a hot key cannot unbalance anything.
    if fits_broadcast(right, broadcast_rows):
        return left.join(F.broadcast(right), cond(), how)
    n_left = known_rows(left)
    if n_left is not None and n_left <= broadcast_rows:
        # A small (staged) left and a large right, as in an incremental load:
        # keep only the right rows whose key the left has, by scanning the
        # right through a broadcast of the left's keys; what remains is
        # usually small enough to broadcast, so the right is never shuffled.
        key_set = stage(left.select(*[F.col(lk).alias(rk) for lk, rk in zip(left_keys, right_keys)]).distinct(), "left_keys")
        if len(right_keys) == 1:
            partners = rows_with_keys(right, right_keys[0], key_set)
        else:  # bounded in rows and, as staged, in bytes
            hinted = F.broadcast(key_set) if fits_broadcast(key_set, broadcast_rows) else key_set
            partners = right.join(hinted, list(right_keys), "left_semi").select(*right.columns)
        right = stage(partners, "prefiltered")
        if fits_broadcast(right, broadcast_rows):
            return left.join(F.broadcast(right), cond(), how)
    if detect_hot and known_rows(left) is None:
        # Counting, sampling and splitting a derived input would each recompute
        # it; stage it once instead.
        left = stage(left, "skew_left")
    hot = hot_keys(left, left_keys) if detect_hot else None
    if hot is None:
        return left.join(right, cond(), how)

    hot_l = F.broadcast(hot)
    hot_r = F.broadcast(hot.toDF(*right_keys))
    # (USING-style joins put the key first; restore each side's column order.)
    left_hot = left.join(hot_l, list(left_keys), "left_semi").select(*left.columns)
    left_cold = left.join(hot_l, list(left_keys), "left_anti").select(*left.columns)
    right_hot = right.join(hot_r, list(right_keys), "left_semi").select(*right.columns)
    cold = left_cold.join(right, cond(), how)

    if fits_broadcast(right_hot, broadcast_rows):
        hot_part = left_hot.join(F.broadcast(right_hot), cond(), how)
    else:
        # Salting: spread each hot key over SALT_BUCKETS tasks; the (few) right
        # rows of hot keys are copied once per bucket, so each left row still
        # meets every partner exactly once.
        salted_left = left_hot.withColumn(
            "_salt_l", F.pmod(F.xxhash64(*left.columns), F.lit(SALT_BUCKETS)))
        salted_right = right_hot.withColumn(
            "_salt_r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT_BUCKETS - 1).cast("long"))))

        def salted_cond() -> Column:
            return cond() & (F.col("_salt_l") == F.col("_salt_r"))

        hot_part = salted_left.join(salted_right, salted_cond(), how).drop("_salt_l", "_salt_r")
    return cold.unionByName(hot_part)
