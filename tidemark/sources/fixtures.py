"""Source-system snapshots derived from the given tables.

The loader reads three source tables (customers, products, order lines), each
with an ``updated_at`` change stamp. ``v1`` is the source as the first load sees
it; ``v2`` as the second load sees it, after a set of changes: re-rated
customers (some to equal values), renamed products, restated order lines, new
customers together with their orders, and a back-dated correction stamped
behind the first run's mark but inside the lookback.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.joins import hot_keys, skew_safe_join
from tidemark.sources.tables import read_table

# --- Fixed values of the fixture derivation --------------------------------
CUSTOMER_PREFIX = "CUST-"
PRODUCT_PREFIX = "PROD-"
ORDER_PREFIX = "ORD-"
LINE_PREFIX = "OL-"
KEY_WIDTH = 9
NULL_SEGMENT = "BUILDING"          # becomes a NULL segment in the source
LATE_CUSTOMER_MOD = 97             # customers absent from v1, new in v2
LATE_PRODUCT_MOD = 89              # products absent from v1, new in v2
CHANGED_CUSTOMER_MOD = 13          # customers re-rated in v2
CHANGED_PRODUCT_MOD = 13           # products renamed in v2
RESTATED_LINE_MOD = 100            # l_orderkey % 100 = 7: quantity + 1
RESTATED_LINE_REM = 7
BACKDATED_LINE_MOD = 1000          # l_orderkey % 1000 = 3: quantity + 5, back-dated
BACKDATED_LINE_REM = 3
RENAME_SUFFIX = " (v2)"
BASE_TS = "1995-01-01 00:00:00"
V1_CUTOFF = "2000-12-31 00:00:00"
V2_CUSTOMER_TS = "2001-01-15 06:00:00"
V2_PRODUCT_TS = "2001-01-15 00:00:00"
V2_RESTATED_TS = "2001-01-15 00:00:00"
BACKDATED_TS = "2000-12-30 00:00:00"
# Credit rating bands on c_acctbal: < 0 BB, < 2500 BBB, < 5000 A, < 7500 AA, else AAA.
# Segment re-rating: BUILDING -> MACHINERY, MACHINERY -> NULL, HOUSEHOLD -> HOUSEHOLD, other -> AUTOMOBILE.
# ----------------------------------------------------------------------------


def _ts(text: str) -> Column:
    return F.lit(text).cast(schemas.TS)


def _digits(col: str) -> Column:
    """The key as text, padded to KEY_WIDTH digits; longer keys stay whole."""
    text = F.col(col).cast("string")
    return F.when(F.length(text) < KEY_WIDTH, F.lpad(text, KEY_WIDTH, "0")).otherwise(text)


def _key(prefix: str, col: str) -> Column:
    return F.concat(F.lit(prefix), _digits(col))


def _credit_rating() -> Column:
    bal = F.col("c_acctbal")
    return (F.when(bal < 0, "BB").when(bal < 2500, "BBB").when(bal < 5000, "A")
            .when(bal < 7500, "AA").otherwise("AAA"))


def _hour_stamp() -> Column:
    return _ts(BASE_TS) + F.make_dt_interval(F.lit(0), (F.col("c_custkey") % 24).cast("int"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is a fixed 25-row reference table: a broadcast of bounded size.
    return customer.join(F.broadcast(nation), F.col("n_nationkey") == F.col("c_nationkey"))


def src_customer(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    c = _customers(spark, sf_dir)
    seg = F.col("c_mktsegment")
    base_segment = F.nullif(seg, F.lit(NULL_SEGMENT))
    if version == 1:
        c = c.where(F.col("c_custkey") % LATE_CUSTOMER_MOD != 0)
        segment, stamp = base_segment, _hour_stamp()
    else:
        changed = F.col("c_custkey") % CHANGED_CUSTOMER_MOD == 0
        late = F.col("c_custkey") % LATE_CUSTOMER_MOD == 0
        rerated = (F.when(seg == "BUILDING", F.lit("MACHINERY"))
                   .when(seg == "MACHINERY", F.lit(None).cast("string"))
                   .when(seg == "HOUSEHOLD", F.lit("HOUSEHOLD"))
                   .otherwise(F.lit("AUTOMOBILE")))
        segment = F.when(changed, rerated).otherwise(base_segment)
        stamp = F.when(changed | late, _ts(V2_CUSTOMER_TS)).otherwise(_hour_stamp())
    return c.select(
        _key(CUSTOMER_PREFIX, "c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        segment.alias("segment"),
        F.col("n_name").alias("country"),
        _credit_rating().alias("credit_rating"),
        stamp.alias("updated_at"),
    )


def src_product(spark: SparkSession, sf_dir: str, version: int) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    name, stamp = F.col("p_name"), _ts(BASE_TS)
    late = F.col("p_partkey") % LATE_PRODUCT_MOD == 0
    if version == 1:
        p = p.where(~late)
    else:
        renamed = F.col("p_partkey") % CHANGED_PRODUCT_MOD == 0
        name = F.when(renamed, F.concat(F.col("p_name"), F.lit(RENAME_SUFFIX))).otherwise(name)
        stamp = F.when(renamed | late, _ts(V2_PRODUCT_TS)).otherwise(stamp)
    return p.select(
        _key(PRODUCT_PREFIX, "p_partkey").alias("product_id"),
        name.alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(schemas.MONEY).alias("unit_cost"),
        stamp.alias("updated_at"),
    )


_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus"]
# Columns that only put repeated lines in order.
_ORDER_ONLY = ["l_suppkey", "l_tax", "l_returnflag", "l_linestatus"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``lineitem`` with its order's customer and date.

    The given lineitem repeats some (order, line number) pairs; ``repeat`` numbers
    them from 1, latest ship date first, then by the remaining columns, so every row
    has a line id of its own. Without an order that holds very many lines, one shuffle
    by order serves the numbering and the join.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", *_LINE_ORDER).where(F.col("l_orderkey").isNotNull())
    even = hot_keys(li, ["l_orderkey"]) is None
    if even:
        li = li.repartition("l_orderkey")
    pair = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(F.col("l_shipdate").desc(), *_LINE_ORDER)
    li = li.withColumn("repeat", F.row_number().over(pair))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = skew_safe_join(li.drop(*_ORDER_ONLY), orders, ["l_orderkey"], ["o_orderkey"], "inner", detect_hot=not even)
    return joined.drop("o_orderkey")


def src_order_line(spark: SparkSession, sf_dir: str, version: int, base: DataFrame | None = None) -> DataFrame:
    ln = base if base is not None else lines(spark, sf_dir)
    ship = F.col("l_shipdate")
    qty = F.col("l_quantity").cast("int")
    stamp = ship
    if version == 1:
        ln = ln.where(ship <= _ts(V1_CUTOFF))
    else:
        backdated = F.col("l_orderkey") % BACKDATED_LINE_MOD == BACKDATED_LINE_REM
        restated = F.col("l_orderkey") % RESTATED_LINE_MOD == RESTATED_LINE_REM
        qty = qty + F.when(backdated, 5).when(restated, 1).otherwise(0)
        in_v1 = ship <= _ts(V1_CUTOFF)
        stamp = (F.when(in_v1 & backdated, _ts(BACKDATED_TS))
                 .when(in_v1 & restated, _ts(V2_RESTATED_TS))
                 .otherwise(ship))
    order_key = _digits("l_orderkey")
    again = F.when(F.col("repeat") > 1, F.concat(F.lit("-"), F.col("repeat").cast("string"))).otherwise("")
    return ln.select(
        F.concat(F.lit(LINE_PREFIX), order_key, F.lit("-"), F.col("l_linenumber").cast("string"), again).alias("order_line_id"),
        F.concat(F.lit(ORDER_PREFIX), order_key).alias("order_id"),
        F.col("o_orderdate").alias("order_ts"),
        _key(CUSTOMER_PREFIX, "o_custkey").alias("customer_id"),
        _key(PRODUCT_PREFIX, "l_partkey").alias("product_id"),
        qty.cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(schemas.MONEY).alias("unit_price"),
        F.col("l_discount").cast(schemas.RATE).alias("discount_pct"),
        stamp.alias("updated_at"),
    )


@dataclass
class SourceSnapshot:
    """The three source tables as one load sees them."""
    customer: DataFrame
    product: DataFrame
    order_line: DataFrame

    def all(self) -> list[DataFrame]:
        return [self.customer, self.product, self.order_line]


def snapshot(spark: SparkSession, sf_dir: str, version: int, base_lines: DataFrame | None = None) -> SourceSnapshot:
    return SourceSnapshot(
        customer=src_customer(spark, sf_dir, version),
        product=src_product(spark, sf_dir, version),
        order_line=src_order_line(spark, sf_dir, version, base_lines),
    )


# --- Planted history defects (so that validation is not trivially empty) ---
# Every 50th customer gets a second current row, every 51st
# loses its current flag, every 53rd gets an overlapping closed row, every 59th
# an inverted row. Planted rows get SKs beyond the largest real one.
DEFECT_SECOND_CURRENT_MOD = 50
DEFECT_NO_CURRENT_MOD = 51
DEFECT_OVERLAP_MOD = 53
DEFECT_INVERTED_MOD = 59
DEFECT_OVERLAP_WINDOW = ("1950-01-01 00:00:00", "2000-01-01 00:00:00")
DEFECT_INVERTED_WINDOW = ("2001-06-01 00:00:00", "2001-01-01 00:00:00")


def planted_defects(dim: DataFrame) -> DataFrame:
    """The dimension with the four kinds of defect planted on real customers."""
    num = F.substring(F.col("customer_id"), len(CUSTOMER_PREFIX) + 1, 64).cast("long")
    real = dim.where(F.col("customer_id") != schemas.UNKNOWN_BK)
    step = dim.agg(F.coalesce(F.max("sk"), F.lit(0)).alias("m")).collect()[0]["m"] + 1
    cols = dim.columns
    base = dim.select(*[
        F.when((F.col("customer_id") != schemas.UNKNOWN_BK) & (num % DEFECT_NO_CURRENT_MOD == 0), F.lit(False))
        .otherwise(F.col(c)).alias(c) if c == "is_current" else F.col(c) for c in cols])

    def planted(where, sk_offset, window, current):
        rows = real.where(F.col("is_current") & where)
        out = []
        for c in cols:
            if c == "sk":
                out.append((F.col("sk") + F.lit(sk_offset)).alias("sk"))
            elif c == "valid_from" and window:
                out.append(_ts(window[0]).alias(c))
            elif c == "valid_to" and window:
                out.append(_ts(window[1]).alias(c))
            elif c == "is_current":
                out.append(F.lit(current).alias(c))
            else:
                out.append(F.col(c))
        return rows.select(*out)

    second = planted(num % DEFECT_SECOND_CURRENT_MOD == 0, 1 * step, None, True)
    overlap = planted(num % DEFECT_OVERLAP_MOD == 0, 2 * step, DEFECT_OVERLAP_WINDOW, False)
    inverted = planted(num % DEFECT_INVERTED_MOD == 0, 3 * step, DEFECT_INVERTED_WINDOW, False)
    return base.unionByName(second).unionByName(overlap).unionByName(inverted)
