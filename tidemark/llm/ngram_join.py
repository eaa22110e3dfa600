"""Self-join of documents on the Jaccard similarity of their word n-grams.

All n-grams have one global order: by hash, with those met often put last, the more
often the later. A set's
prefix is its first ``n - ceil(0.8 n) + 1`` n-grams; two sets that link share one in
their prefixes, whatever the order, so putting frequent ones last only makes the lists
of documents shorter. Pairs from these lists are then counted exactly: the order is
cut vertically into fragments, each fragment of a pair gives a partial overlap, and
the partial overlaps are summed per pair. Only components are asked for, so pairs are
counted in rounds: first each document's best candidate, then its best one in another
component, and in the last round all candidates that are still in different components.

Documents with equal sets are one class from the start. N-grams that many sets hold
even in their prefixes belong to large groups of near copies: there each list links
its members to a few hubs first, and only members that are then still apart from the
list's largest component are compared with all of the list that a bitmap of their
frequent n-grams can't tell from them. No link between
different components is lost, and a group is never expanded into all its pairs.

Defined results: null and empty texts, and texts without a word, have an empty set and
link with nothing; a text of fewer words than an n-gram has all its words as its only
one; exact copies are one class; a null doc_id links with nothing (component null);
rows that share a doc_id are one document, whose set is the one with the most n-grams;
an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .components import components
from .storage import written

WIDTH = 5
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Vertical fragments of the global order; a power of two.
FRAGMENTS = 4
#: An n-gram goes last in the order when it repeats within blocks of documents this often.
FREQUENT = 6
#: N-grams put last at most (the most frequent ones); bounds what is broadcast to 12 MB.
MAX_FREQUENT = 1_000_000
#: N-grams that are counted together before their repeats are passed on.
BLOCK = 2_000_000
#: Longer lists link through hubs; shorter ones give all their pairs.
LONG_LIST = 20
#: Hubs of each long list, and the round in which who is still apart is compared with all.
HUBS, HUB_ROUNDS = 3, 4
#: Numbers of 64 bits in the bitmap of a set's frequent n-grams.
BITMAP = 16
#: Document ids that are broadcast at most (16 MB).
BROADCAST_IDS = 2_000_000

_U = np.uint64
_GATE = 22  # leading hash bits of the quick test for frequent n-grams


def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The distinct n-grams of each text as ascending 64-bit hashes."""
    raw, offsets = T.buffer_of(batch.column("text"))
    raw = T.LOWER[raw]
    starts, ends, counts = T.word_spans(raw, offsets)
    grams, _, per = T.windows(T.span_hashes(raw, starts, ends), counts, WIDTH, short=True)
    at = np.concatenate(([0], np.cumsum(per)))
    return [np.unique(grams[at[i] : at[i + 1]]) for i in range(len(per))]


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams that several sets of a block share, and how often they repeat in it."""
    held: list[np.ndarray] = []
    seen: set[bytes] = set()
    size = 0

    def counted():
        grams, n = np.unique(np.concatenate(held), return_counts=True)
        again = n > 1
        return pa.RecordBatch.from_arrays([pa.array(grams[again].view(np.int64)), pa.array(n[again] - 1)], names=["gram", "n"])

    for batch in T.slices(batches, "text"):
        for own in _sets(batch):
            key = own[:4].tobytes() + len(own).to_bytes(8, "little")
            if len(own) and key not in seen:  # copies in a block count once
                seen.add(key)
                held.append(own)
                size += len(own)
                if size >= BLOCK:
                    yield counted()
                    held, seen, size = [], set(), 0
    if held:
        yield counted()


def frequent_grams(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most ``MAX_FREQUENT`` n-grams to put last in the order, ascending, and their places there."""
    counts = docs.select("text").mapInArrow(_repeats, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    top = counts.orderBy(F.desc("n"), "gram").limit(MAX_FREQUENT).select("gram").toPandas()["gram"]
    grams = top.to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(grams)
    return grams[order], (len(grams) - 1 - order).astype(np.int32)  # the most frequent one is the last


class _Frequent:
    """Membership in the frequent n-grams, most of the others turned away by a bitmap."""

    def __init__(self, grams: np.ndarray, places: np.ndarray):
        self.grams, self.places = grams, places
        self.gate = np.zeros(1 << _GATE, dtype=bool)
        self.gate[grams >> _U(64 - _GATE)] = True

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        found = self.gate[grams >> _U(64 - _GATE)]
        some = np.flatnonzero(found)
        if len(some):
            at = np.minimum(np.searchsorted(self.grams, grams[some]), len(self.grams) - 1)
            found[some] = self.grams[at] == grams[some]
        return found

    def ordered(self, grams: np.ndarray) -> np.ndarray:
        """Frequent n-grams in their order."""
        return grams[np.argsort(self.places[np.searchsorted(self.grams, grams)])]


def least_overlap(n: int) -> int:
    """The fewest n-grams that a set of n shares with any set it links to."""
    return -(-PERCENT * n // 100)


def prefixes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, n, h1, h2, light, heavy, bits): size, a 128-bit digest and the prefix of each set.

    ``bits`` is a bitmap of all frequent n-grams of a set whose prefix holds some; such a
    prefix holds all of the others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = _Frequent(*shared.value)
        for batch in T.slices(batches, "text"):
            sets = _sets(batch)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            at = np.concatenate(([0], np.cumsum(n)))
            flags = last(every)
            one, two = T.mix(every), T.mix(every ^ _U(0x5DEECE66D1234567))
            light, heavy, h1, h2, bits = [], [], [], [], []
            for i, own in enumerate(sets):
                a, b = at[i], at[i + 1]
                h1.append(one[a:b].sum(dtype=np.uint64))
                h2.append(two[a:b].sum(dtype=np.uint64))
                size = len(own) - least_overlap(len(own)) + 1 if len(own) else 0
                mark = flags[a:b]
                if mark.any():
                    light.append(own[~mark][:size])
                    more = size - len(light[-1])
                    heavy.append(last.ordered(own[mark])[:more] if more else own[:0])
                    bits.append(_bitmap(own[mark]) if more else None)
                else:
                    bits.append(None)
                    light.append(own[:size])
                    heavy.append(own[:0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(np.array(h1, np.uint64).view(np.int64)), pa.array(np.array(h2, np.uint64).view(np.int64)), _lists(light), _lists(heavy), pa.array(bits, pa.list_(pa.int64()))],
                names=["doc_id", "n", "h1", "h2", "light", "heavy", "bits"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, h1 long, h2 long, light array<long>, heavy array<long>, bits array<long>")


def _bitmap(grams: np.ndarray) -> np.ndarray:
    out = np.zeros(BITMAP, dtype=np.uint64)
    np.bitwise_or.at(out, ((grams >> _U(8)) % _U(BITMAP)).astype(np.int64), _U(1) << (grams & _U(63)))
    return out.view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    return T.int_lists(np.concatenate(rows) if rows else np.zeros(0, np.uint64), np.array([len(r) for r in rows], dtype=np.int64))


#: A set's size and the size of its prefix's frequent part, in one number.
_PART = 1 << 24


def _list_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by n-gram: all pairs of each short list, the rows of each long one.

    Pairs have ``a < b``; rows of long lists have ``b`` null. A list is held only up to
    ``LONG_LIST`` rows; of a longer one, the rest passes through.
    """
    empty = np.zeros(0, np.int64)
    carried = (empty, empty, empty)
    long_gram = None

    def out(gram, a, b, ma, mb):
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(a), b if isinstance(b, pa.Array) else pa.array(b), pa.array(ma), mb if isinstance(mb, pa.Array) else pa.array(mb)], names=["gram", "a", "b", "ma", "mb"])

    def of(gram, doc, m):
        if not len(gram):
            return
        edge = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
        size = np.diff(np.concatenate((edge, [len(gram)])))
        own = np.repeat(size, size)
        own[gram == long_gram] = LONG_LIST + 1
        if (far := own > LONG_LIST).any():
            none = pa.nulls(int(far.sum()), pa.int64())
            yield out(gram[far], doc[far], none, m[far], none)
        few = (own > 1) & ~far
        gram, doc, m = gram[few], doc[few], m[few]
        n = m // _PART
        for lag in range(1, LONG_LIST):
            same = np.flatnonzero(gram[lag:] == gram[:-lag])
            if not len(same):
                break
            x, y = same, same + lag
            near = 100 * np.minimum(n[x], n[y]) >= PERCENT * np.maximum(n[x], n[y])
            x, y = x[near], y[near]
            if len(x):
                swap = doc[x] > doc[y]
                x, y = np.where(swap, y, x), np.where(swap, x, y)
                yield out(gram[x], doc[x], doc[y], m[x], m[y])

    for batch in batches:
        part = [np.concatenate((c, batch.column(k).to_numpy(zero_copy_only=False))) for c, k in zip(carried, ("gram", "cid", "m"))]
        if not len(part[0]):
            continue
        last = int(np.searchsorted(part[0], part[0][-1], "left"))
        if len(part[0]) - last > LONG_LIST or part[0][-1] == long_gram:  # no need to hold a long list
            if part[0][-1] != long_gram:
                yield from of(*(p[:last] for p in part))
                part = [p[last:] for p in part]
                long_gram = part[0][-1]
            yield from of(*part)
            carried = (empty, empty, empty)
        else:
            yield from of(*(p[:last] for p in part))
            carried = tuple(p[last:] for p in part)
    yield from of(*carried)


def _near(a: str, b: str):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _prefix_rest(n):
    """How many n-grams of a set of n stand behind its prefix."""
    return F.ceil(PERCENT * n / F.lit(100)) - 1


def _room(overlap, a, b):
    """Whether an overlap of at most this many lets sets of these sizes link."""
    return overlap * (100 + PERCENT) >= PERCENT * (a + b)


def _counted_pairs(pairs: DataFrame, long_counts: DataFrame) -> DataFrame:
    """(a, b) of short lists whose shared prefix n-grams leave room for a link.

    Sets can share what is counted here, n-grams of their prefixes that aren't (frequent
    ones, and ``k`` in long lists), and what stands behind the longer of the prefixes.
    """
    found = pairs.groupBy("a", "b", "ma", "mb").agg(F.count(F.lit(1)).alias("shared"))
    for k in "ab":
        found = found.join(long_counts.select(F.col("cid").alias(k), F.col("k").alias(f"k{k}")), k, "left")
    size = {k: F.floor(F.col(f"m{k}") / _PART) for k in "ab"}
    more = {k: F.col(f"m{k}") % _PART + F.coalesce(f"k{k}", F.lit(0)) for k in "ab"}
    most = F.col("shared") + F.least(more["a"], more["b"]) + F.greatest(_prefix_rest(size["a"]), _prefix_rest(size["b"]))
    return found.where(_room(most, size["a"], size["b"])).select("a", "b", "shared")


def _best_pairs(pairs: DataFrame) -> DataFrame:
    """Of each document's pairs the one with the most shared prefix n-grams."""
    ends = [pairs.select(F.col(own).alias("id"), F.struct("shared", F.col(other).alias("other")).alias("p")) for own, other in ("ab", "ba")]
    best = ends[0].unionAll(ends[1]).groupBy("id").agg(F.max("p").alias("p"))
    return best.select(F.least("id", "p.other").alias("a"), F.greatest("id", "p.other").alias("b")).distinct()


def _crossing(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose documents are in different components."""
    for k in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(k), F.col("root").alias(f"root_{k}")), k, "left")
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    return pairs.where(apart).select("a", "b", "shared")


def fragments(docs: DataFrame, ids: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(id, fragment, n, grams): the sets of the documents in ``ids``, cut vertically.

    ``only`` (doc_id, n, h1, h2) names the set to take where rows share a doc_id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.arange(1, FRAGMENTS, dtype=np.uint64) * _U((1 << 64) // FRAGMENTS)
        for batch in T.slices(batches, "text"):
            sets = _sets(batch)
            parts = [p for own in sets for p in np.split(own, np.searchsorted(own, cuts))]
            h1 = np.array([T.mix(own).sum(dtype=np.uint64) for own in sets], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), FRAGMENTS)),
                    pa.array(np.tile(np.arange(FRAGMENTS), len(sets))),
                    pa.array(np.repeat([len(s) for s in sets], FRAGMENTS).astype(np.int64)),
                    pa.array(np.repeat(h1.view(np.int64), FRAGMENTS)),
                    _lists(parts),
                ],
                names=["id", "fragment", "n", "h1", "grams"],
            )

    ids = written(ids.select(F.col("id").alias("doc_id")).distinct(), "join-ids")
    few = ids.count() <= BROADCAST_IDS  # else both sides are shuffled
    rows = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").select("doc_id", "text")
    parts = rows.mapInArrow(run, "id long, fragment long, n long, h1 long, grams array<long>")
    if only is not None:
        parts = parts.join(only.withColumnRenamed("doc_id", "id"), ["id", "n", "h1"], "left_semi").dropDuplicates(["id", "fragment"])
    return written(parts, "fragments")


def linked(parts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of documents that link: partial overlaps by fragment, summed per pair.

    Fragments of documents in no pair are left out before the joins, so a round with few
    pairs moves few of them.
    """
    ids = written(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "pair-ids")
    parts = parts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")
    left = parts.select(F.col("id").alias("a"), "fragment", F.col("n").alias("na"), F.col("grams").alias("ga"))
    right = parts.select(F.col("id").alias("b"), "fragment", F.col("n").alias("nb"), F.col("grams").alias("gb"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).alias("overlap"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("o"))
    return total.where(100 * F.col("o") >= PERCENT * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def _able(n, more, m, other):
    """Whether sets of n and m can link without being a pair of a short list.

    Such sets share, of n-grams that stand in both prefixes, only ones of long lists, which
    ``more`` counts in a set's prefix. All others they share stand behind the prefix that
    ends first in the global order, which can be the one of either set.
    """
    rest = F.greatest(_prefix_rest(F.col(n)), _prefix_rest(F.col(m)))
    return _near(n, m) & _room(F.least(more, other) + rest, F.col(n), F.col(m))


def _alike(a: str, b: str):
    """Whether the bitmaps leave room for a link, where both sets have one.

    Such sets share frequent n-grams, and of the others only ones of long lists. A bit
    that only one of them has stands for a frequent n-gram that only this one has.
    """
    extra = lambda x, y: F.zip_with(F.col(f"{x}.bits"), F.col(f"{y}.bits"), lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
    only = lambda x, y: F.aggregate(extra(x, y), F.lit(0), lambda n, k: n + k)
    most = F.least(F.col(f"{a}.frequent") - only(a, b), F.col(f"{b}.frequent") - only(b, a)) + F.least(F.col(f"{a}.k"), F.col(f"{b}.k"))
    return F.coalesce(_room(most, F.col(f"{a}.n"), F.col(f"{b}.n")), F.lit(True))


def _hub(seed: int, *also: str):
    """Of a random quarter of a list's members, the one with the fewest n-grams of its own.

    Near copies that were changed least are the likeliest to link with the others.
    """
    quarter = F.pmod(F.xxhash64("cid", F.lit(seed)), F.lit(4)).alias("q")
    own = F.col("n") - _prefix_rest(F.col("n")) - F.col("more")
    return F.struct(quarter, own.alias("own"), F.xxhash64("cid").alias("h"), "cid", "n", "more", *also)


def _hub_pairs(rows: DataFrame) -> DataFrame:
    """Each member of a long list with the list's hubs."""
    hubs = rows.groupBy("gram").agg(*(F.min(_hub(k)).alias(f"hub{k}") for k in range(HUBS)))
    hubs = hubs.select("gram", F.explode(F.array_distinct(F.array(*(F.struct(F.col(f"hub{k}.cid").alias("cid"), F.col(f"hub{k}.n").alias("n"), F.col(f"hub{k}.more").alias("more")) for k in range(HUBS))))).alias("hub"))
    met = rows.join(hubs, "gram").where(F.col("cid") != F.col("hub.cid")).where(_able("n", "more", "hub.n", "hub.more"))
    return met.select(F.least("cid", "hub.cid").alias("a"), F.greatest("cid", "hub.cid").alias("b")).distinct()


def _apart(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of long lists whose members are in several components, with the largest (top)."""
    rows = rows.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    sizes = rows.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("gram").agg(F.max(F.struct("k", "root")).alias("top"), F.count(F.lit(1)).alias("roots")).where("roots > 1").select("gram", F.col("top.root").alias("top"))
    return written(rows.join(largest, "gram"), "lists-apart")


def _more_hub_pairs(apart: DataFrame, seed: int) -> DataFrame:
    """Members outside a list's largest component with new hubs, inside and outside of it."""
    pick = [(f"hub{k}", k, F.col("root") == F.col("top")) for k in range(HUBS)] + [("hub", HUBS, F.col("root") != F.col("top"))]
    hubs = apart.groupBy("gram").agg(*(F.min(F.when(of, _hub(seed * 10 + k, "root"))).alias(name) for name, k, of in pick))
    hubs = hubs.select("gram", F.explode(F.array(*(name for name, _, _ in pick))).alias("hub"))
    met = apart.where("root <> top").join(hubs, "gram").where((F.col("root") != F.col("hub.root")) & _able("n", "more", "hub.n", "hub.more"))
    return met.select(F.least("cid", "hub.cid").alias("a"), F.greatest("cid", "hub.cid").alias("b")).distinct()


def _rest_pairs(apart: DataFrame) -> DataFrame:
    """The members outside a list's largest component with all of other components."""
    minor = apart.where("root <> top").alias("x")
    met = minor.join(apart.alias("y"), (F.col("x.gram") == F.col("y.gram")) & (F.col("x.root") != F.col("y.root")) & _able("x.n", "x.more", "y.n", "y.more") & _alike("x", "y"))
    return met.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()


def join_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    firsts = written(prefixes(docs, frequent_grams(docs)), "prefixes")
    key = ["n", "h1", "h2"]
    usable, only = firsts.where("n > 0 AND doc_id IS NOT NULL"), None
    rows = usable.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("d")).collect()[0]
    if rows["n"] > rows["d"]:
        only = written(usable.groupBy("doc_id").agg(F.max(F.struct(*key)).alias("k")).select("doc_id", "k.*"), "repeated-ids")
        usable = usable.join(only, ["doc_id", *key], "left_semi")
    # Sets with one digest are equal, and so are their prefixes: any of them will do.
    classes = usable.groupBy(*key).agg(F.min("doc_id").alias("cid"), F.first("light").alias("light"), F.first("heavy").alias("heavy"), F.first("bits").alias("bits"))
    nodes = classes = written(classes, "classes")

    packed = (F.col("n") * _PART + F.size("heavy")).alias("m")
    light = nodes.select(F.explode("light").alias("gram"), "cid", packed)
    sorted_lists = light.repartition("gram").sortWithinPartitions("gram")
    met = written(sorted_lists.mapInArrow(_list_pairs, "gram long, a long, b long, ma long, mb long"), "list-pairs")
    heavy = nodes.select(F.explode("heavy").alias("gram"), "cid", packed)
    long_rows = heavy.unionAll(met.where("b IS NULL").select("gram", F.col("a").alias("cid"), F.col("ma").alias("m")))
    long_counts = met.where("b IS NULL").groupBy(F.col("a").alias("cid")).agg(F.count(F.lit(1)).alias("k"))
    long_rows = long_rows.join(long_counts, "cid", "left").withColumn("n", F.floor(F.col("m") / _PART)).withColumn("k", F.coalesce("k", F.lit(0)))
    mapped = nodes.where("bits IS NOT NULL").select("cid", "bits", (F.col("n") - F.size("light")).alias("frequent"))
    long_rows = long_rows.select("gram", "cid", "n", "k", (F.col("m") % _PART + F.col("k")).alias("more")).join(mapped, "cid", "left")
    long_rows = written(long_rows, "long-lists")

    short = written(_counted_pairs(met.where("b IS NOT NULL"), long_counts), "short-pairs")
    pairs = written(_best_pairs(short).unionAll(_hub_pairs(long_rows)).distinct(), "candidates")
    ids = short.select(F.col("a").alias("id")).union(short.select(F.col("b").alias("id"))).union(long_rows.select(F.col("cid").alias("id")))
    parts = fragments(docs, ids, only)
    roots = written(components(written(linked(parts, pairs), "links")), "roots")
    for seed in range(1, HUB_ROUNDS + 1):
        short = written(_crossing(short, roots).join(pairs, ["a", "b"], "left_anti"), "short-pairs")
        apart, done = _apart(long_rows, roots), seed == HUB_ROUNDS
        if apart.isEmpty() and short.isEmpty():
            break
        if not done:
            new = _best_pairs(short).unionAll(_more_hub_pairs(apart, seed)).distinct()
            new = written(new.join(pairs, ["a", "b"], "left_anti"), "candidates")
            links = written(linked(parts, new), "links")
            pairs, done = pairs.unionAll(new), links.isEmpty()
        if done:  # who is still apart is compared with all
            rest = short.select("a", "b").unionAll(_rest_pairs(apart)).distinct()
            links = written(linked(parts, written(rest.join(pairs, ["a", "b"], "left_anti"), "candidates")), "links")
        roots = written(components(links.unionAll(roots.select(F.col("root").alias("a"), F.col("node").alias("b")))), "roots")
        if done:
            break

    owner = classes.select(*key, "cid").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    owner = owner.select(*key, F.coalesce("root", "cid").alias("component_id"))
    if only is None:
        out = firsts.select("doc_id", "n", "h1", "h2").join(owner, key, "left")
    else:  # rows that share a doc_id share its component
        out = firsts.select("doc_id", "n").join(only.join(owner, key).select("doc_id", "component_id"), "doc_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the least doc_id, with all columns.

    Of rows that share that doc_id the least row stays; rows without one all stay.
    """
    groups = join_components(docs)
    dropped = written(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_drop")).distinct(), "dropped")
    kept = docs.join(dropped, F.col("doc_id").cast("long") == F.col("_drop"), "left_anti")
    rows = groups.where("doc_id IS NOT NULL").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("d")).collect()[0]
    if rows["n"] > rows["d"]:
        named = kept.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias("_row"))
        kept = named.select("_row.*").unionByName(kept.where("doc_id IS NULL"))
    return kept
