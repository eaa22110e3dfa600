"""Phrases that occur together more often than their parts would, by marginals of the longest windows.

Only one kind of window is counted: each word of a piece with the up to four words after it
(its lead columns), padded where the piece ends. The count of a phrase of k words is the sum over
all windows that begin with it, so ``ROLLUP`` over the lead columns gives the counts of every
shorter length; nothing is exploded per length.

Windows are coded by a book of the most frequent words (two or three bytes each; words beyond the
book are spelled out, so any vocabulary works), summed within a slice of text and moved once, straight to
range partitions of the whole corpus, whose bounds come from the windows of a sample of texts (they set how
even the partitions are, never what is counted). In a sorted run the windows that share a beginning stand
together: a run that ends inside the batch and falls short of ``least`` can't reach it
anywhere, so its windows are shortened to the longest beginning that can, and summed. Runs at the
edges of a batch stay as they are. What is left for the ROLLUP is a small part, and its sums are
exact for every phrase that reaches ``least``. A word with fewer than ``least`` occurrences in its language
can't be in such a phrase, so windows end before it.

Defined results: a null text is empty, a null lang is ``und`` (as is a lang of that name). Repeated rows
count as often as they occur; doc_id isn't read. An empty table, or one without a candidate, gives an
empty result. Further columns are ignored. Texts are read whole, of any length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .storage import written

WIDTH = 5
LEAST = 100
TOP = 2000
#: Entries of the broadcast code book, the most frequent ones: some 10 MB with words of usual length.
BOOK = 1 << 18
#: Longest word of the code book in bytes; with BOOK this bounds what is broadcast. Longer words are spelled out.
BOOK_WORD_BYTES = 64
#: Bytes of text whose windows are summed together before they are written.
SLICE_BYTES = 8_000_000
#: Windows whose keys are made, and passed on, at once.
PACKED_ROWS = 100_000
#: Sorted windows that one pass of the collapse looks at.
RUN_ROWS = 500_000
#: Windows in a range partition, about, unless that takes more than MAX_PARTS of them.
PARTITION_ROWS = 1_000_000
MAX_PARTS = 1 << 16
#: Texts (at least) and windows for each range partition that its bounds are taken from; bytes of a bound.
SAMPLE_TEXTS, SAMPLE_WINDOWS, BOUND_BYTES = 2_000, 16, 64
#: Shares of a language's candidates that are ranked apart before the last ranking.
SALTS = 32

#: Fixed by the query's contract: separators of pieces, and what stands between words.
PIECE_END = np.array([b in b".,;:!?\n\x0b\x0c\r" for b in range(256)])
IN_WORD = np.array([b not in b".,;:!?\n\x0b\x0c\r \t" for b in range(256)])

#: Codes below this take two bytes and begin below LONG; others take three and begin below SPELLED.
TWO_BYTES = 0x7F00
LONG = 0x80
SPELLED = b"\xff"  # before a word that is spelled out
END = b" "  # no word holds a space


def _words(batch: pa.RecordBatch):
    """(distinct words, their indices, lang indices, langs, whether each word follows the one before it in a piece)."""
    raw, offsets = T.buffer_of(batch.column("text"))
    raw = T.LOWER[raw]
    starts, ends, counts = T.word_spans(raw, offsets, IN_WORD)
    size = ends - starts
    at = np.concatenate(([0], np.cumsum(size)))
    letters = raw[IN_WORD[raw]]  # words side by side, in order
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(letters))
    coded = pc.dictionary_encode(words)
    langs = pc.dictionary_encode(batch.column("lang"))
    lang_of = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts)
    breaks = np.concatenate(([0], np.cumsum(PIECE_END[raw])))[starts] if len(raw) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    follows = np.zeros(len(starts), dtype=bool)
    follows[1:] = (row[1:] == row[:-1]) & (breaks[1:] == breaks[:-1])
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), lang_of, langs.dictionary, follows


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in T.slices(batches, "text", SLICE_BYTES):
            words, index, lang, langs, _ = _words(b)
            if not len(index):
                continue
            pair, n = np.unique(lang * len(words) + index, return_counts=True)
            lang, word = np.divmod(pair, len(words))
            yield pa.RecordBatch.from_arrays([langs.take(pa.array(lang)).cast(pa.string()), words.take(pa.array(word)).cast(pa.string()), pa.array(n.astype(np.int64))], ["lang", "word", "n"])

    return _texts(docs).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Book:
    """Codes of the most frequent (lang, word) pairs; ``whole`` when it holds every word that occurs often enough."""

    def __init__(self, rows: list[tuple[str, str]], whole: bool):
        self.whole = whole
        self.words = pa.array([w for _, w in rows], pa.string())
        self.code = {key: i for i, key in enumerate(rows)}

    def lookup(self, langs: list[str], words: list[str]) -> np.ndarray:
        """Each pair's code; -1 for a word that ends a window, -2 for one that is spelled out."""
        missing = -1 if self.whole else -2
        return np.fromiter((self.code.get(p, missing) for p in zip(langs, words)), dtype=np.int64, count=len(words))


def make_book(counts: DataFrame, least: int, book: int) -> Book:
    """The code book from the words' counts: at most ``book`` rows reach the driver."""
    often = counts.where(F.col("n") >= least)
    short = often.where(F.octet_length("word") <= BOOK_WORD_BYTES).where(F.octet_length("lang") <= BOOK_WORD_BYTES)
    rows = short.orderBy(F.desc("n"), "lang", "word").limit(book).select("lang", "word").collect()
    return Book([(r["lang"], r["word"]) for r in rows], whole=often.count() == len(rows))


def _lang_key(lang: str) -> bytes:
    """A language's bytes, ending themselves: no key is the beginning of another."""
    return lang.encode().replace(END, END + b"\x01") + END + b"\x00"


def _spelled(word: str) -> bytes:
    return SPELLED + word.encode() + END


def _code(number: int) -> bytes:
    return number.to_bytes(2, "big") if number < TWO_BYTES else (LONG << 16 | number).to_bytes(3, "big")


def _side_by_side(columns: list[np.ndarray]) -> list[np.ndarray]:
    """As many of the columns as fit side by side in one number, in fewer numbers that sort alike."""
    out: list[np.ndarray] = []
    left = 0
    for c in columns:
        bits = max(1, int(c.max(initial=0)).bit_length())
        if bits <= left:
            out[-1] = out[-1] << bits | c
            left -= bits
        else:
            out.append(c.astype(np.int64))
            left = 63 - bits
    return out


def windows(docs: DataFrame, broadcast, width: int = WIDTH, bounds=None) -> DataFrame:
    """(part, key, n): windows of two to ``width`` words and how often each occurs within a slice of text.

    ``key`` is the language's key and the words' codes one after the other, so it sorts windows with
    the same beginning next to each other. ``part`` says how many of ``bounds`` (a broadcast sorted
    list of keys) the key has reached.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, edges = broadcast.value, bounds.value if bounds else []
        for b in T.slices(batches, "text", SLICE_BYTES):
            words, index, lang, langs, follows = _words(b)
            if len(index) < 2:
                continue
            pair, at = np.unique(lang * len(words) + index, return_inverse=True)
            names = langs.to_pylist()
            pair_lang, pair_word = np.divmod(pair, len(words))
            spelled = words.take(pa.array(pair_word)).to_pylist()
            code = book.lookup([names[i] for i in pair_lang], spelled)
            coded = code[at]
            ok = coded != -1
            # length[i]: words of the window that begins at i
            length = np.where(ok, 1, 0)
            going = ok.copy()
            for k in range(1, width):
                more = np.zeros(len(ok), dtype=bool)
                more[: len(ok) - k] = going[: len(ok) - k] & follows[k:] & ok[k:]
                length += more
                going = more
            first = np.flatnonzero(length >= 2)
            if not len(first):
                continue
            # Lead columns: a number for each word, 0 for padding; words that are spelled out come after the book.
            plain = np.where(code == -2, len(book.words) + 1 + np.arange(len(code)), code + 1).astype(np.int32)[at]
            lead = [np.where(length[first] > k, plain[np.minimum(first + k, len(plain) - 1)], 0) for k in range(width)]
            keys = _side_by_side([lang[first], *lead])
            order = np.lexsort(keys[::-1])
            new = np.ones(len(order), dtype=bool)
            new[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in keys])
            n = np.diff(np.append(np.flatnonzero(new), len(order)))
            once = order[new]
            lead, speaks = np.stack([x[once] for x in lead], axis=1), lang[first][once]
            del keys, order, new, once, plain, coded, at, ok, going, length, index, lang, follows  # only the distinct windows are needed
            outside = lead > len(book.words)
            for l in np.unique(speaks):
                own = np.flatnonzero(speaks == l)
                head = np.frombuffer(_lang_key(names[l]), dtype=np.uint8)
                easy = own[~outside[own].any(axis=1)]
                for lo in range(0, len(easy), PACKED_ROWS):
                    part = easy[lo : lo + PACKED_ROWS]
                    keys = _packed(head, lead[part])
                    yield _dealt(_places(_Keys(keys), edges), keys, n[part])
                hard = own[outside[own].any(axis=1)]
                for part in np.array_split(hard, max(1, -(-len(hard) // PACKED_ROWS))) if len(hard) else []:
                    keys = [head.tobytes() + b"".join(_spelled(spelled[x - len(book.words) - 1]) if x > len(book.words) else _code(x) for x in row if x) for row in lead[part].tolist()]
                    places = np.array([bisect_right(edges, x) for x in keys], dtype=np.int32)
                    yield _dealt(places, pa.array(keys, pa.binary()), n[part])

    return _texts(docs).mapInArrow(run, "part int, key binary, n long")


def _dealt(places: np.ndarray, keys: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(places), keys, pa.array(n.astype(np.int64))], ["part", "key", "n"])


class _Keys(Sequence):
    """An Arrow array of keys as a sequence of bytes."""

    def __init__(self, keys: pa.Array):
        self.keys = keys

    def __len__(self) -> int:
        return len(self.keys)

    def __getitem__(self, i: int) -> bytes:
        return self.keys[i].as_py()


def _places(keys: Sequence[bytes], edges: list[bytes]) -> np.ndarray:
    """How many of the sorted ``edges`` each of the sorted ``keys`` has reached."""
    first, last = bisect_right(edges, keys[0]), bisect_right(edges, keys[len(keys) - 1])
    if last - first > len(keys):
        return np.array([bisect_right(edges, k) for k in keys], dtype=np.int32)
    cuts = [0]
    for e in edges[first:last]:
        cuts.append(bisect_left(keys, e, lo=cuts[-1]))
    return np.repeat(np.arange(first, last + 1, dtype=np.int32), np.diff([*cuts, len(keys)]))


def range_bounds(docs: DataFrame, broadcast, width: int, parts: int) -> list[bytes]:
    """At most ``parts - 1`` keys that cut the windows of a sample of texts into equal shares.

    At most ``SAMPLE_WINDOWS`` keys a partition reach the driver.
    """
    if parts < 2:
        return []
    share = max(SAMPLE_TEXTS, parts) / max(1, docs.count())
    texts = docs.sample(fraction=share, seed=7) if share < 1 else docs
    keys = windows(texts, broadcast, width).select(F.substring("key", 1, BOUND_BYTES).alias("key"), "n")
    found = sorted(bytes(r["key"]) for r in keys.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_WINDOWS * parts).collect())
    return sorted({found[len(found) * i // parts] for i in range(1, parts)}) if found else []


def _packed(head: np.ndarray, lead: np.ndarray) -> pa.Array:
    """Keys of windows whose words are all in the book."""
    rows, width = lead.shape
    three = lead >= TWO_BYTES
    body = np.stack([np.where(three, lead >> 16 | LONG, lead >> 8), np.where(three, lead >> 8, lead), lead], axis=2).astype(np.uint8)
    used = np.stack([lead > 0, lead > 0, three], axis=2).reshape(rows, 3 * width)
    full = np.concatenate((np.broadcast_to(head, (rows, len(head))), body.reshape(rows, 3 * width)), axis=1)
    used = np.concatenate((np.ones((rows, len(head)), dtype=bool), used), axis=1)
    at = np.concatenate(([0], np.cumsum(used.sum(axis=1)))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(at), pa.py_buffer(full[used])])


def _cuts(keys: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, ends): where the language and each word of a key ends; -1 where it has fewer words."""
    _, offsets, data = keys.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    spaces = np.flatnonzero(raw == END[0])
    # The language: up to the first space that a zero byte follows (one byte 1 follows an own space of the language).
    closing = spaces[raw[np.minimum(spaces + 1, len(raw) - 1)] == 0]
    ends = np.full((len(keys), width + 1), -1, dtype=np.int64)
    place = closing[np.searchsorted(closing, at[:-1])] + 2
    ends[:, 0] = place
    for k in range(1, width + 1):
        inside = place < at[1:]
        first = raw[np.minimum(place, len(raw) - 1)]
        spelled = inside & (first == SPELLED[0])
        step = place + np.where(first < LONG, 2, 3)
        if spelled.any():
            step[spelled] = spaces[np.searchsorted(spaces, place[spelled])] + 1
        place = np.where(inside, step, place)
        ends[inside, k] = place[inside]
    return raw, at, ends


def collapse(keys: pa.Array, n: np.ndarray, least: int, width: int, book: Book) -> pa.RecordBatch | None:
    """Sorted windows shortened to the longest beginning that can reach ``least``, as words with their summed counts."""
    raw, at, ends = _cuts(keys, width)
    rows = len(n)
    total = np.concatenate(([0], np.cumsum(n)))
    size = (ends >= 0).sum(axis=1) - 1
    same = _shared(raw, at, ends, width)  # words (and the language) that a row shares with the one before
    deep = np.zeros(rows, dtype=np.int64)
    for k in range(2, width + 1):
        has = size >= k
        new = np.ones(rows, dtype=bool)
        new[1:] = same[1:] < k
        begin = np.flatnonzero(new)
        close = np.append(begin[1:], rows)
        alive = (total[close] - total[begin] >= least) | (begin == 0) | (close == rows)
        deep = np.where(has & alive[np.cumsum(new) - 1], k, deep)
    kept = np.flatnonzero(deep >= 2)
    if not len(kept):
        return None
    # Rows with the same shortened beginning that follow each other become one.
    new = np.ones(len(kept), dtype=bool)
    shared = _least_between(same, kept)
    new[1:] = (shared < deep[kept][1:]) | (deep[kept][1:] != deep[kept][:-1])
    begin, summed = kept[new], np.add.reduceat(n[kept], np.flatnonzero(new))
    columns = []
    for k in range(1, width + 1):
        there = deep[begin] >= k
        codes = np.full(len(begin), -1, dtype=np.int64)
        start = ends[begin, k - 1]
        first = raw[np.minimum(start, len(raw) - 1)]
        plain = there & (first != SPELLED[0])
        long = plain & (first >= LONG)
        codes[plain] = (raw[start[plain]].astype(np.int64) << 8) + raw[start[plain] + 1] - 1
        codes[long] = (raw[start[long]].astype(np.int64) - LONG << 16) + (raw[start[long] + 1].astype(np.int64) << 8) + raw[start[long] + 2] - 1
        words = book.words.take(pa.array(codes, mask=codes < 0))
        if (odd := np.flatnonzero(there & ~plain)).size:
            got = words.to_pylist()
            for i in odd:
                got[i] = raw[start[i] + 1 : ends[begin[i], k] - 1].tobytes().decode()
            words = pa.array(got, pa.string())
        columns.append(words)
    heads = [raw[lo : hi - 2].tobytes().replace(END + b"\x01", END).decode() for lo, hi in zip(at[begin].tolist(), ends[begin, 0].tolist())]
    return pa.RecordBatch.from_arrays([pa.array(heads, pa.string()), *columns, pa.array(summed)], ["lang", *(f"w{k}" for k in range(1, width + 1)), "n"])


def _least_between(same: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """For each kept row after the first: the fewest words shared between neighbours from the kept row before it on."""
    if len(kept) < 2:
        return np.zeros(0, dtype=np.int64)
    bounds = kept[:-1] + 1
    return np.minimum.reduceat(same[: kept[-1] + 1], bounds)


def _shared(raw: np.ndarray, at: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """How many words each row shares with the row before it, from the first on; -1 where the language differs."""
    rows = len(at) - 1
    out = np.full(rows, -1, dtype=np.int64)
    if rows < 2:
        return out
    still = np.ones(rows - 1, dtype=bool)
    begin = at[:-1]
    for k in range(width + 1):
        lo = begin if k == 0 else ends[:, k - 1]
        hi = ends[:, k]
        size = np.where(hi >= 0, hi - lo, -1)
        still = still & (size[1:] >= 0) & (size[1:] == size[:-1])
        rows_left = np.flatnonzero(still)
        most = int(size[1:][rows_left].max(initial=0))
        equal = np.ones(len(rows_left), dtype=bool)
        for j in range(most):
            more = size[1:][rows_left] > j
            a = raw[np.minimum(lo[1:][rows_left] + j, len(raw) - 1)]
            b = raw[np.minimum(lo[:-1][rows_left] + j, len(raw) - 1)]
            equal &= ~more | (a == b)
        still[rows_left] = equal
        out[1:][still] = k
    return out


def collapsed(sorted_windows: DataFrame, broadcast, least: int, width: int) -> DataFrame:
    """The sorted windows of each partition, collapsed a batch at a time."""
    columns = ", ".join(f"w{k} string" for k in range(1, width + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[pa.RecordBatch] = []
        rows = 0

        def done() -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(have).combine_chunks()
            got = collapse(t.column("key").combine_chunks(), t.column("n").to_numpy(), least, width, broadcast.value)
            if got is not None:
                yield got

        for b in batches:
            if b.num_rows:
                have.append(b)
                rows += b.num_rows
            if rows >= RUN_ROWS:
                yield from done()
                have, rows = [], 0
        if rows:
            yield from done()

    return sorted_windows.select("key", "n").mapInArrow(run, f"lang string, {columns}, n long")


def phrase_counts(docs: DataFrame, least: int = LEAST, width: int = WIDTH, book: int = BOOK) -> tuple[DataFrame, DataFrame]:
    """((lang, words, size, f) of every phrase of 2 to ``width`` words with f >= least, (lang, word, n) of every word)."""
    spark = docs.sparkSession
    counts = written(word_counts(docs), "word-counts")
    made = spark.sparkContext.broadcast(make_book(counts, least, book))
    total = counts.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0  # a window a word at most
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MAX_PARTS, -(-int(total) // PARTITION_ROWS)))
    bounds = spark.sparkContext.broadcast(range_bounds(docs, made, width, parts))
    ordered = windows(docs, made, width, bounds).repartitionById(parts, F.col("part")).sortWithinPartitions("key")
    left = written(collapsed(ordered, made, least, width), "collapsed-windows")
    lead = [f"w{k}" for k in range(1, width + 1)]
    # Marginals: the last lead column that a grouping keeps names its length; where it is padding, the window was shorter.
    sums = left.rollup("lang", *lead).agg(F.grouping_id().alias("rolled"), F.sum("n").alias("f")).where(F.col("f") >= least)
    size = sum(F.when(F.col("rolled").bitwiseAND(F.lit(1 << (width - k))) == 0, 1).otherwise(0) for k in range(1, width + 1))
    words = F.array_compact(F.array(*lead))
    phrases = sums.withColumn("size", size).withColumn("words", words).where((F.col("size") >= 2) & (F.size("words") == F.col("size")))
    return written(phrases.select("lang", "words", "size", "f"), "phrases"), counts


def collocations(docs: DataFrame, least: int = LEAST, width: int = WIDTH, top: int = TOP, book: int = BOOK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases."""
    phrases, counts = phrase_counts(docs, least, width, book)
    exact = lambda c: F.col(c).cast("decimal(16,0)")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    spaced = F.concat_ws(" ", "words")
    # f of every phrase and of every word that a phrase can be cut into.
    parts = phrases.select("lang", spaced.alias("part"), F.col("f").alias("parts_f"))
    parts = parts.unionAll(counts.where(F.col("n") >= least).select("lang", F.col("word").alias("part"), F.col("n").alias("parts_f")))
    # A longer phrase that occurs as often as one inside it: then one that is longer by a single word does, too.
    inner = F.explode(F.array(F.slice("words", F.lit(1), F.col("size") - 1), F.slice("words", F.lit(2), F.col("size") - 1))).alias("words")
    longer = phrases.where("size > 2").select("lang", "f", inner).groupBy("lang", F.concat_ws(" ", "words").alias("phrase")).agg(F.max("f").alias("longer"))
    # Cuts, each joined with the counts of its two parts.
    cut = F.posexplode(F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(k.alias("k"), F.concat_ws(" ", F.slice("words", F.lit(1), k)).alias("first"), F.concat_ws(" ", F.slice("words", k + 1, F.col("size") - k)).alias("rest"))))
    cuts = phrases.select("lang", spaced.alias("phrase"), F.col("f").alias("a"), cut.alias("at", "c")).select("lang", "phrase", "a", "c.k", "c.first", "c.rest")
    cuts = cuts.join(parts.select("lang", F.col("part").alias("first"), F.col("parts_f").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("rest"), F.col("parts_f").alias("r")), ["lang", "rest"])
    cuts = cuts.join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang")
    ratio = F.lit(1000).cast("decimal(4,0)") * (exact("a") * exact("n"))
    cuts = cuts.withColumn("num", ratio).withColumn("den", exact("l") * exact("r")).withColumn("score", F.expr("num div den"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = best.join(longer, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranking = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = Window.partitionBy("lang", "salt").orderBy(*ranking)
    scored = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = scored.drop("salt").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*ranking)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
