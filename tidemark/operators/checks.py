"""History validation of a Type 2 dimension, and integrity audits.

Every check is a distributed aggregate that returns counts; none collects a
key's versions into one task, and none enumerates pairs of versions.

Overlapping windows are counted with a sort instead of the self join
``a.bk = b.bk AND a.sk <> b.sk AND a.from < b.to AND b.from < a.to``, whose
cost is quadratic in the versions of a key. For ordered pairs (a, b) of one
key the overlap count is ``X - W + Z - V`` where

* ``X = #{(a, b): b.from < a.to}`` and ``W = #{(a, b): b.to <= a.from}``;
  with each row contributing a start event at ``from`` and an end event at
  ``to``, sorted by (key, time, end before start), ``X - W`` equals the sum
  of the end events' positions minus the sum of the start events' positions;
* ``Z = #{(a, b): b.to <= a.from and a.to <= b.from}``, non-zero only when a
  row has ``to <= from`` (an inverted or empty window, which spans ``[to, from]``).
  Two such rows count when their spans touch: the positions of the spans' ends
  minus those of their starts in a sort with starts first. One such row and a
  valid one count (twice) when the valid window lies inside the span: a join of
  the invalid rows with the valid ones of their key;
* ``V`` removes the pairs (a, a) of valid rows.

Positions come from one range-partitioned sort (a hot key spans several
partitions) plus per-partition offsets, as for surrogate keys.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import rows_with_keys, skew_safe_join
from tidemark.operators.keys import partition_offsets
from tidemark.session import range_partitions, row_count, stage

CHECK_MULTI_CURRENT = "multiple_current"
CHECK_NO_CURRENT = "no_current"
CHECK_OVERLAPS = "overlapping_pairs"
CHECK_INVERTED = "inverted_windows"

_LOW_BITS = (1 << 33) - 1
_BIG = "decimal(38,0)"


def history_multi_current(dim: DataFrame, business_key: str) -> DataFrame:
    """Keys with more than one current version: (key, current_versions)."""
    return (dim.where(F.col("is_current")).groupBy(business_key)
            .agg(F.count(F.lit(1)).alias("current_versions"))
            .where(F.col("current_versions") > 1))


def history_no_current(dim: DataFrame, business_key: str) -> DataFrame:
    """Keys none of whose versions is current: (key, versions)."""
    return (dim.groupBy(business_key)
            .agg(F.count(F.lit(1)).alias("versions"), F.count_if(F.col("is_current")).alias("_cur"))
            .where(F.col("_cur") == 0).drop("_cur"))


def history_inverted(dim: DataFrame) -> DataFrame:
    """Rows whose window is empty or inverted: ``valid_to <= valid_from``."""
    return dim.where(F.col("valid_to") <= F.col("valid_from"))


def _ranged_events(dim: DataFrame, business_key: str, num_partitions: int | None,
                   start: str = "valid_from", end: str = "valid_to", end_first: bool = True) -> DataFrame:
    """Start and end events sorted by (key, time, end before start), range
    partitioned so a hot key spans several partitions; ``_mid`` carries the
    partition id (high bits) and the position within it (low 33 bits)."""
    spark = dim.sparkSession
    # Two events per row; the range partition count follows the row count.
    n = num_partitions or range_partitions(2 * row_count(dim), spark)
    events = dim.select(F.col(business_key).alias("_k"), F.explode(F.array(
        F.struct(F.col(start).alias("t"), F.lit(int(end_first)).alias("kind"), F.lit(-1).alias("sign")),
        F.struct(F.col(end).alias("t"), F.lit(int(not end_first)).alias("kind"), F.lit(1).alias("sign")),
    )).alias("e")).select("_k", "e.t", "e.kind", "e.sign")
    order = [F.col("_k").asc_nulls_last(), F.col("t").asc_nulls_last(), F.col("kind")]
    return (events.repartitionByRange(n, *order).sortWithinPartitions(*order)
            .withColumn("_mid", F.monotonically_increasing_id()))


def _rank_sum_total(dim: DataFrame, business_key: str, num_partitions: int | None) -> DataFrame:
    """X - W over all keys, one row ``xw``, from one aggregate with a row per partition.

    With g = offset(p) + pos for an event at position pos of partition p,
    sum(sign * g) = sum_p offset(p) * S_p + I_p, where S_p is the sum of signs
    and I_p the sum of sign * pos in p; the key's first position cancels
    because each key has as many ends as starts.
    """
    per = _ranged_events(dim, business_key, num_partitions).groupBy(
        F.shiftright("_mid", 33).alias("_pid")).agg(
        F.count(F.lit(1)).alias("c"), F.sum("sign").cast(_BIG).alias("s"),
        F.sum(F.col("sign") * F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))).cast(_BIG).alias("i"))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offset = F.coalesce(F.sum("c").over(earlier), F.lit(0)).cast("decimal(19,0)")
    return per.withColumn("o", offset).agg(F.coalesce(F.sum(F.col("o") * F.col("s").cast("decimal(19,0)") + F.col("i")), F.lit(0)).cast(_BIG).alias("xw"))


def _event_rank_sums(dim: DataFrame, business_key: str, num_partitions: int | None, **events) -> DataFrame:
    """Per key: sum of end positions minus sum of start positions (X - W)."""
    ranged = _ranged_events(dim, business_key, num_partitions, **events)
    # Ties (same key, time and kind) share a sign, so their relative order does
    # not change any sum below.
    per_part = stage(ranged.groupBy(F.shiftright("_mid", 33).alias("_pid"), "_k").agg(
        F.sum(F.col("sign") * F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))).cast(_BIG).alias("_sp"),
        F.sum("sign").cast(_BIG).alias("_ss"),
        F.count(F.lit(1)).alias("_c")))
    offsets = partition_offsets(per_part, "_pid", F.col("_c")).select(
        "_pid", F.col("_offset").cast(_BIG).alias("_off"))
    return (per_part.join(offsets, "_pid")
            .groupBy("_k").agg(F.sum(F.col("_sp") + F.col("_off") * F.col("_ss")).alias("_xw")))


def _inverted_pair_counts(dim: DataFrame, business_key: str, num_partitions: int | None = None) -> DataFrame:
    """Per key: Z, the pairs involving a row with ``valid_to <= valid_from``."""
    bk = business_key
    bad = stage(dim.where(F.col("valid_to") <= F.col("valid_from")).select(bk, "valid_from", "valid_to"), "inverted")
    if row_count(bad) == 0:  # a healthy history: nothing to pair
        return dim.sparkSession.createDataFrame([], f"_k {dim.schema[bk].dataType.simpleString()}, _z decimal(38,0)")
    # Both invalid: spans [to, from] that touch, by positions; no pair is built.
    touching = _event_rank_sums(bad, bk, num_partitions, start="valid_to", end="valid_from", end_first=False)
    # One of each: valid windows inside a span, once for each order of the two.
    keys = rows_with_keys(dim.where(F.col("valid_to") > F.col("valid_from")).select(bk, "valid_from", "valid_to"), bk, stage(bad.select(bk).distinct(), "inverted_keys"))
    valid = stage(keys.select(F.col(bk).alias("_k"), F.col("valid_from").alias("_f"), F.col("valid_to").alias("_t")), "beside_inverted")
    inside = skew_safe_join(bad, valid, [bk], ["_k"], "inner",
                            residual=lambda: (F.col("_t") <= F.col("valid_from")) & (F.col("valid_to") <= F.col("_f")))
    both = touching.select("_k", F.col("_xw").alias("_z")).unionByName(
        inside.groupBy("_k").agg((2 * F.count(F.lit(1))).cast(_BIG).alias("_z")))
    return both.groupBy("_k").agg(F.sum("_z").cast(_BIG).alias("_z"))


def history_overlaps(dim: DataFrame, business_key: str, num_partitions: int | None = None) -> DataFrame:
    """Keys with overlapping validity windows: (key, overlapping_pairs).

    Counts ordered pairs of distinct rows, as the self-join formulation does
    (each overlapping pair twice). Rows are told apart by position, so the
    count assumes the surrogate key is unique (audited separately).
    """
    bk = business_key
    xw = _event_rank_sums(dim, bk, num_partitions)
    z = _inverted_pair_counts(dim, bk, num_partitions)
    v = dim.where(F.col("valid_to") > F.col("valid_from")).groupBy(F.col(bk).alias("_k")).agg(
        F.count(F.lit(1)).cast(_BIG).alias("_v"))
    total = (xw.join(z, "_k", "left").join(v, "_k", "left")
             .select(F.col("_k").alias(bk),
                     (F.col("_xw") + F.coalesce(F.col("_z"), F.lit(0).cast(_BIG))
                      - F.coalesce(F.col("_v"), F.lit(0).cast(_BIG))).cast("long").alias("overlapping_pairs")))
    return total.where(F.col("overlapping_pairs") > 0)


def validate_history(dim: DataFrame, business_key: str, num_partitions: int | None = None) -> DataFrame:
    """The four invariants as ``(check, n)``, four rows, zeros when clean.

    multiple_current and no_current count keys, overlapping_pairs counts
    ordered pairs, inverted_windows counts rows.
    """
    # Current-version checks, inverted rows and V: one grouped pass (partial
    # aggregation per key). Overlaps are sums of parts: X - W, Z and -V.
    per_key = dim.groupBy(business_key).agg(
        F.count_if(F.col("is_current")).alias("_cur"),
        F.count_if(F.col("valid_to") <= F.col("valid_from")).alias("_inv"),
        F.count_if(F.col("valid_to") > F.col("valid_from")).alias("_val"))
    part = lambda check, n: F.struct(F.lit(check).alias("check"), F.coalesce(n, F.lit(0)).cast("long").alias("n"))
    simple = per_key.agg(F.array(
        part(CHECK_MULTI_CURRENT, F.count_if(F.col("_cur") > 1)), part(CHECK_NO_CURRENT, F.count_if(F.col("_cur") == 0)),
        part(CHECK_INVERTED, F.sum("_inv")), part(CHECK_OVERLAPS, -F.sum("_val"))).alias("parts"))
    parts = simple.select(F.explode("parts").alias("p")).select("p.check", "p.n")
    overlaps = [_rank_sum_total(dim, business_key, num_partitions).select(part(CHECK_OVERLAPS, F.col("xw")).alias("p")),
                _inverted_pair_counts(dim, business_key, num_partitions).agg(part(CHECK_OVERLAPS, F.sum("_z")).alias("p"))]
    for more in overlaps:
        parts = parts.unionAll(more.select("p.check", "p.n"))
    return parts.groupBy("check").agg(F.sum("n").alias("n"))


def history_overlap_total(dim: DataFrame, business_key: str, num_partitions: int | None = None) -> int:
    """The number of ordered overlapping pairs over the whole dimension."""
    total = validate_history(dim, business_key, num_partitions).where(F.col("check") == CHECK_OVERLAPS)
    return int(total.collect()[0]["n"])


def validation_counts_by(dim: DataFrame, business_key: str,
                         group_of: Callable[[Column], Column], num_partitions: int | None = None) -> dict:
    """The four invariant counts per group of keys, where ``group_of(key)``
    is a function of the business key (e.g. its storage bucket), as
    ``{group: {check: n}}``. Rows reaching the driver: one per group and one
    per (partition, group) of the sorted events, bounded by partitions plus
    groups.

    The invariants are per-key properties, so counts of disjoint key groups
    add up to the dimension's totals; a load then re-validates only the groups
    it touched. Overlaps use the rank identity of ``history_overlap_total``
    with events sorted by (group, key, time): a key never spans groups, so
    each group's sum of signed positions is the sum over its keys.
    """
    bk = business_key
    per_key = dim.groupBy(bk).agg(
        F.count_if(F.col("is_current")).alias("_cur"),
        F.count_if(F.col("valid_to") <= F.col("valid_from")).alias("_inv"),
        F.count_if(F.col("valid_to") > F.col("valid_from")).alias("_val"))
    simple = per_key.groupBy(group_of(F.col(bk)).alias("_g")).agg(
        F.count_if(F.col("_cur") > 1).alias("m"), F.count_if(F.col("_cur") == 0).alias("z"),
        F.sum("_inv").alias("i"), F.sum("_val").alias("v")).collect()
    out = {r["_g"]: {CHECK_MULTI_CURRENT: int(r["m"]), CHECK_NO_CURRENT: int(r["z"]),
                     CHECK_OVERLAPS: -int(r["v"]), CHECK_INVERTED: int(r["i"])} for r in simple}
    if not out:
        return out

    spark = dim.sparkSession
    n = num_partitions or range_partitions(2 * row_count(dim), spark)
    events = dim.select(group_of(F.col(bk)).alias("_g"), F.col(bk).alias("_k"), F.explode(F.array(
        F.struct(F.col("valid_from").alias("t"), F.lit(1).alias("kind"), F.lit(-1).alias("sign")),
        F.struct(F.col("valid_to").alias("t"), F.lit(0).alias("kind"), F.lit(1).alias("sign")),
    )).alias("e")).select("_g", "_k", "e.t", "e.kind", "e.sign")
    order = [F.col("_g").asc_nulls_last(), F.col("_k").asc_nulls_last(), F.col("t").asc_nulls_last(),
             F.col("kind")]
    ranged = (events.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    per = ranged.groupBy(F.shiftright("_mid", 33).alias("_pid"), "_g").agg(
        F.count(F.lit(1)).alias("c"), F.sum("sign").alias("s"),
        F.sum(F.col("sign") * F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))).cast(_BIG).alias("i")).collect()
    per_pid: dict = {}
    for r in per:
        per_pid[r["_pid"]] = per_pid.get(r["_pid"], 0) + int(r["c"])
    offsets, running = {}, 0
    for pid in sorted(per_pid):
        offsets[pid] = running
        running += per_pid[pid]
    for r in per:
        out[r["_g"]][CHECK_OVERLAPS] += offsets[r["_pid"]] * int(r["s"]) + int(r["i"])

    if any(c[CHECK_INVERTED] for c in out.values()):
        z = _inverted_pair_counts(dim, bk)
        for r in z.groupBy(group_of(F.col("_k")).alias("_g")).agg(F.sum("_z").alias("z")).collect():
            out[r["_g"]][CHECK_OVERLAPS] += int(r["z"])
    return out


_MESSAGES = {
    CHECK_MULTI_CURRENT: "business key(s) have more than one current version",
    CHECK_NO_CURRENT: "business key(s) have no current version",
    CHECK_OVERLAPS: "overlapping validity window pair(s)",
    CHECK_INVERTED: "row(s) with valid_to on or before valid_from",
}


def problem_messages(counts: dict) -> list[str]:
    """Messages for non-zero invariant counts (``{check: n}``)."""
    return [f"{counts[check]} {text}" for check, text in _MESSAGES.items() if counts.get(check)]


def problem_text(count: Callable[[str], Column]) -> Column:
    """The same messages as one text column, ``clean`` when there are none."""
    said = F.concat_ws("; ", *[F.when(count(c) > 0, F.concat(count(c).cast("string"), F.lit(f" {text}"))) for c, text in _MESSAGES.items()])
    return F.when(said == "", F.lit("clean")).otherwise(said)


def history_problems(dim: DataFrame, business_key: str) -> list[str]:
    """Messages for the failing invariants; empty when the history is clean."""
    return problem_messages({r["check"]: r["n"] for r in validate_history(dim, business_key).collect()})


# --- audits -----------------------------------------------------------------

def audit_duplicates(df: DataFrame, key: Sequence[str] | str, check: str | None = None) -> DataFrame:
    """``(check, n)``: key values occurring more than once (primary key audit)."""
    keys = [key] if isinstance(key, str) else list(key)
    name = check or "duplicate_" + "_".join(keys)
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).cast("long").alias("n")).select(F.lit(name).alias("check"), "n")


def audit_not_null(df: DataFrame, columns: Sequence[str], table: str = "") -> DataFrame:
    """``(check, n)`` per column: NULLs in NOT NULL columns, in one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in columns])
    prefix = f"{table}." if table else ""
    stacked = [F.struct(F.lit(prefix + c).alias("check"), F.col(c).alias("n")) for c in columns]
    return row.select(F.explode(F.array(*stacked)).alias("r")).select("r.check", "r.n")


def audit_orphans(fact: DataFrame, dim: DataFrame, fk: str = "customer_sk", pk: str = "sk") -> DataFrame:
    """``(check, n)``: facts whose key is NULL or matches no dimension row.

    Facts are counted per key first (map-side), so the hot Unknown key costs
    one row in the anti join.
    """
    per_key = fact.groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    orphan = per_key.join(dim.select(F.col(pk).alias("_k")), "_k", "left_anti")
    return orphan.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n")).select(
        F.lit("orphan_" + fk).alias("check"), "n")


def audit_unknown(fact: DataFrame, fk: str = "customer_sk", unknown_sk: int = -1) -> DataFrame:
    """``(check, n)``: facts resolved to the Unknown member."""
    return fact.agg(F.count_if(F.col(fk) == unknown_sk).cast("long").alias("n")).select(
        F.lit("unknown_" + fk).alias("check"), "n")


def audit_as_at(fact: DataFrame, dim: DataFrame, source: DataFrame, key: str = "order_line_id",
                event_ts: str = "order_ts", fk: str = "customer_sk", pk: str = "sk") -> DataFrame:
    """``(check, n)``: facts whose source event time lies outside the validity
    window of the dimension version they point at.

    Facts are reduced to ``(sk, event time, count)`` before meeting the
    dimension, so a hot surrogate key contributes one row per distinct time.
    """
    events = fact.select(key, fk).join(source.select(key, event_ts), key)
    per = events.groupBy(fk, event_ts).agg(F.count(F.lit(1)).alias("_n"))
    versions = dim.select(F.col(pk).alias("_sk"), F.col("valid_from").alias("_f"), F.col("valid_to").alias("_t"))
    joined = skew_safe_join(per, versions, [fk], ["_sk"], "inner")
    bad = joined.where((F.col(event_ts) < F.col("_f")) | (F.col(event_ts) >= F.col("_t")))
    return bad.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n")).select(
        F.lit("fact_outside_version_window").alias("check"), "n")
