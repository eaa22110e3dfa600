"""Near-duplicate vectors by lattice hashing.

Each of ``tables`` tables projects a vector's direction to eight dimensions and names the
nearest point of the E8 lattice, the vector's home cell. A vector also probes the cells of the
next nearest points. Two vectors meet where one's home is the other's home or one of its
probes, and vectors that meet are compared by cosine in double precision. Equal vectors are
one class, compared once and counted as often as it occurs.

A cell with many vectors is dealt out in blocks of homes times blocks of visitors, so that no
task holds more than two blocks. A pair that meets in several cells counts in the first one
only, which both vectors' lists of cells tell; so blocks give link counts and locally connected
parts, and never a list of pairs.

Defined results: a vector that is null, empty, zero or holds null or non-finite entries links
with nothing. Vectors of different lengths don't link. Rows of one vec_id are rows of their own
(two with the same vector link with each other); a null vec_id is a row like any other and
never the smallest of its component unless all are null. An empty table gives an empty result.
Further columns are dropped.

Directions at a cosine of 0.9 meet in one table with a chance of about a half, so six tables
find 98 of 100 such pairs, and practically all from 0.95 on. For far more vectors than a few
hundred million take a larger ``scale`` (smaller cells) and more ``tables``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import written

TABLES = 6
PROBES = 4
#: Length of a unit vector's mean projection, in units of the lattice.
SCALE = 2.0
COSINE = 0.9
#: Vectors of one side of a block.
BLOCK = 1024

_U = np.uint64


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of +-1, or eight of +-1/2 with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a in (1.0, -1.0):
            for b in (1.0, -1.0):
                v = np.zeros(8)
                v[i], v[j] = a, b
                out.append(v)
    halves = 0.5 - (np.arange(256)[:, None] >> np.arange(8) & 1)
    return np.vstack([np.array(out), halves[(halves < 0).sum(axis=1) % 2 == 0]])


SHORTEST = _shortest()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: where the sum is odd, the entry rounded worst goes the other way."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(near.sum(axis=1) % 2)
    near[rows, worst[rows]] += np.where(off[rows, worst[rows]] >= 0, 1.0, -1.0)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 for each row: E8 is the even points and the even points moved by one half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    whole[closer] = half[closer]
    return whole


def _cell_ids(points: np.ndarray, table: int) -> np.ndarray:
    """A 32-bit name of each lattice point; points that share a name only give more to compare."""
    h = np.full(points.shape[:-1], 0x9E3779B97F4A7C15 + table, dtype=np.uint64)
    doubled = np.rint(points * 2).astype(np.int64).view(np.uint64)
    for k in range(8):
        h = (h ^ doubled[..., k]) * _U(0xBF58476D1CE4E5B9)
        h ^= h >> _U(29)
    return (h >> _U(32)).astype(np.uint32).view(np.int32)


def directions(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that neither squares overflow nor vanish."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


class Lattice:
    """The tables' projections for one vector length; the same in every task."""

    def __init__(self, length: int, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE):
        self.tables, self.probes = tables, probes
        rng = np.random.default_rng([20, length])
        self.planes, self.shifts = [], []
        for _ in range(tables):
            plane = rng.normal(size=(length, 8))
            if length >= 8:
                plane = np.linalg.qr(plane)[0]
            self.planes.append(plane * scale * np.sqrt(length / 8))
            self.shifts.append(rng.uniform(0, 2, size=8))

    def cells(self, units: np.ndarray) -> np.ndarray:
        """Row by table by (home, probes): cell names."""
        out = np.empty((len(units), self.tables, 1 + self.probes), dtype=np.int32)
        for t in range(self.tables):
            x = units @ self.planes[t] + self.shifts[t]
            home = nearest(x)
            out[:, t, 0] = _cell_ids(home, t)
            if self.probes:
                gain = (x - home) @ SHORTEST.T  # the larger, the nearer the neighbouring point
                best = np.argpartition(-gain, self.probes - 1, axis=1)[:, : self.probes]
                out[:, t, 1:] = _cell_ids(home[:, None, :] + SHORTEST[best], t)
        return out


def _valid(column: pa.Array):
    """(row, vector as numpy) of each row whose vector can be compared."""
    for i, v in enumerate(column):
        if v.is_valid and len(v) and v.values.null_count == 0:
            x = v.values.to_numpy(zero_copy_only=False) + 0.0  # no negative zero
            if np.isfinite(x).all() and x.any():
                yield i, x


def vectors(table: DataFrame, id_column: str, column: str) -> DataFrame:
    """(vec_id, raw) with the entries' bytes, as they are stored; raw is null where there is nothing to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [None] * b.num_rows
            for i, x in _valid(b.column(1)):
                raw[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(raw, pa.binary())], ["vec_id", "raw"])

    return table.select(F.col(id_column).cast("long"), column).mapInArrow(run, "vec_id long, raw binary")


def _rows_of(column: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Binary entries of one length at a time: (their rows, a matrix)."""
    sizes = np.array([len(x.as_buffer()) for x in column])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.frombuffer(b"".join(column[int(i)].as_py() for i in at), dtype=kind).reshape(len(at), -1)


def cell_rows(classes: DataFrame, kind: str, tables: int, probes: int, scale: float) -> DataFrame:
    """A row for each class, table and cell that it is at home in or probes; ``seen`` holds all its cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Lattice] = {}
        for b in batches:
            for at, matrix in _rows_of(b.column("raw"), kind):
                n = matrix.shape[1]
                if n not in made:
                    made[n] = Lattice(n, tables, probes, scale)
                cells = made[n].cells(directions(matrix))
                flat = cells.reshape(len(at), -1)
                seen = pa.array([x.tobytes() for x in flat], pa.binary())
                keep = np.ones(cells.shape, dtype=bool)  # a cell named twice is visited once
                for k in range(1, 1 + probes):
                    keep[:, :, k] = (cells[:, :, k : k + 1] != cells[:, :, :k]).all(axis=2)
                row, table, k = np.nonzero(keep)
                take = pa.array(at[row])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), n, dtype=np.int32)), pa.array(table.astype(np.int32)), pa.array(cells[row, table, k]),
                        pa.array(k == 0), b.column("node").take(take), b.column("copies").take(take), b.column("raw").take(take), seen.take(pa.array(row)),
                    ],
                    ["width", "table", "cell", "home", "node", "copies", "raw", "seen"],
                )

    return classes.select("node", "copies", "raw").mapInArrow(run, "width int, table int, cell int, home boolean, node long, copies long, raw binary, seen binary")


def in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """Rows of cells where vectors meet, dealt out: homes by blocks, every block of visitors against each of them."""
    key = ["width", "table", "cell"]
    sizes = rows.groupBy(*key).agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("all")).where("homes > 0 AND all > 1")
    sizes = sizes.select(*key, F.ceil(F.col("homes") / block).cast("int").alias("home_blocks"), F.ceil(F.col("all") / block).cast("int").alias("blocks"))
    dealt = rows.join(sizes, key).withColumns({"own_home": F.pmod(F.xxhash64("node", F.lit(1)), "home_blocks").cast("int"), "own": F.pmod(F.xxhash64("node", F.lit(2)), "blocks").cast("int")})
    # As a home a row stands against every block of visitors; as a visitor against every block of homes.
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    at_home = F.when(F.col("home"), F.transform(each("blocks"), lambda b: F.struct(F.col("own_home").alias("h"), b.alias("v"), F.lit(True).alias("host"))))
    visits = F.transform(each("home_blocks"), lambda h: F.struct(h.alias("h"), F.col("own").alias("v"), F.lit(False).alias("host")))
    places = F.explode(F.concat(F.coalesce(at_home, F.array().cast("array<struct<h:int,v:int,host:boolean>>")), visits))
    return dealt.withColumn("at", places).select(*key, "at.h", "at.v", "at.host", "home", "node", "copies", "raw", "seen")


def _met(seen_a: np.ndarray, seen_b: np.ndarray) -> np.ndarray:
    """Whether the two vectors of each row meet, by table: pair by table."""
    a, b = seen_a[:, :, 0], seen_b[:, :, 0]
    return (seen_b == a[:, :, None]).any(axis=2) | (seen_a == b[:, :, None]).any(axis=2)


def _parts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of ``n`` points reaches over the links (a, b)."""
    at = np.arange(n)
    while True:
        low = np.minimum(at[a], at[b])
        new = at.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == at).all():
            return at
        at = new


def links_in_block(table: int, cell: int, hosts: dict, guests: dict, cosine: float):
    """(node, linked rows, least node of its part) of the links that count in this block."""
    a, b = np.nonzero(hosts["unit"] @ guests["unit"].T >= cosine)
    x, y = hosts["node"][a], guests["node"][b]
    ok = (x != y) & (~guests["home"][b] | (x < y))  # two at home here meet as (host, guest) and (guest, host)
    a, b, x, y = a[ok], b[ok], x[ok], y[ok]
    if not len(a):
        return None
    seen_a, seen_b = hosts["seen"][a], guests["seen"][b]
    counts = ~_met(seen_a[:, :table], seen_b[:, :table]).any(axis=1)
    mine, other = seen_a[:, table, 0], seen_b[:, table, 0]  # mine is this cell
    twice = (other != mine) & (seen_a[:, table, 1:] == other[:, None]).any(axis=1)  # also met in the guest's home
    counts &= ~twice | (mine < other)
    x, y, a, b = x[counts], y[counts], a[counts], b[counts]
    if not len(x):
        return None
    nodes, at = np.unique(np.concatenate((x, y)), return_inverse=True)
    left, right = at[: len(x)], at[len(x) :]
    links = np.zeros(len(nodes), dtype=np.int64)
    np.add.at(links, left, guests["copies"][b])
    np.add.at(links, right, hosts["copies"][a])
    return nodes, links, nodes[_parts(len(nodes), left, right)]


def block_links(blocks: DataFrame, kind: str, tables: int, probes: int, cosine: float) -> DataFrame:
    """(node, links, root) from each block; a block's rows follow each other in one partition."""
    key = ["width", "table", "cell", "h", "v"]

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """One block's rows at a time, though batches cut them anywhere."""
        parts: list[pa.Table] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            names = np.stack([b.column(k).to_numpy() for k in key])
            cuts = np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1
            if last is not None and (names[:, 0] != last).any() and parts:
                yield pa.concat_tables(parts)
                parts = []
            bounds = [0, *cuts.tolist(), b.num_rows]
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                parts.append(t.slice(lo, hi - lo))
                if hi < b.num_rows:
                    yield pa.concat_tables(parts)
                    parts = []
            last = names[:, -1]
        if parts:
            yield pa.concat_tables(parts)

    def side(t: pa.Table) -> dict:
        raw = np.frombuffer(b"".join(t.column("raw").to_pylist()), dtype=kind).reshape(t.num_rows, -1)
        seen = np.frombuffer(b"".join(t.column("seen").to_pylist()), dtype=np.int32).reshape(t.num_rows, tables, 1 + probes)
        return {"unit": directions(raw), "seen": seen, "node": t.column("node").to_numpy(), "copies": t.column("copies").to_numpy(), "home": t.column("home").to_numpy()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(batches):
            host = t.column("host").to_numpy()
            if not host.any() or host.all():
                continue
            hosts, guests = side(t.filter(pa.array(host))), side(t.filter(pa.array(~host)))
            got = links_in_block(t.column("table")[0].as_py(), t.column("cell")[0].as_py(), hosts, guests, cosine)
            if got is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], ["node", "links", "root"])

    return blocks.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "node long, links long, root long")


def near_duplicates(table: DataFrame, id_column: str = "vec_id", column: str = "embedding", cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``table``."""
    kind = "<f8" if dict(table.dtypes)[column] == "array<double>" else "<f4"
    if kind == "<f4":
        table = table.withColumn(column, F.col(column).cast("array<float>"))
    every = written(vectors(table, id_column, column), "vectors")
    classes = every.where("raw IS NOT NULL").groupBy("raw").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    found = written(block_links(in_blocks(cell_rows(classes, kind, tables, probes, scale), block), kind, tables, probes, cosine), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("node <> root").select("node", "root").distinct(), "node", "root")
    placed = classes.join(links, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = written(placed.select("raw", "least", "root", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-roots")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    known = placed.join(least, "root").select("raw", "n_links", F.col("component_id").alias("found_id"), F.lit(True).alias("known"))
    component = F.when(F.col("known"), F.col("found_id")).otherwise(F.col("vec_id"))
    return every.join(known, "raw", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
