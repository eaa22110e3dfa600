"""Benchmark decontamination: BM25 over an inverted index of test items.

Every passage of every training text is a query against an index of the test items:
windows of ``PASSAGE`` words, half overlapping, so that an item of up to half that size
lies whole in one of them. A longer item is in the index as a whole and also in chunks of
at most that size, each with a score of its own, so that a text that holds the item has
passages that hold whole chunks; any of them retrieves the item. A score is the BM25
score for the passage's distinct words as a share of the score for the item's (or the
chunk's) own words, so one threshold serves all.
All items at or above it are retrieved with block-max WAND: postings carry the largest
score per list and per block, and items whose sum of these can't reach the threshold
are skipped. Retrieved items are verified by the word trigrams of their question and of
their answer that stand in the text around the passage.

Passages are first put through the same bound as arrays: the words that make up all but
``SLACK`` of an item's score are its essential ones, and a passage that holds too few of
every item's can't reach the threshold, so WAND doesn't start for it.

The index is built by Spark jobs over the items and broadcast in parts of at most
``PART_POSTINGS`` postings; with more items, the texts are read once per part.

Defined results: null, empty and wordless texts match nothing, neither do such items;
repeated items and rows match each on their own; equal scores are all kept; an empty
table of either kind gives an empty result; only doc_id and text (item_id and text) are
read, and ``clean_documents`` passes all columns through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import written

PASSAGE, STRIDE = 96, 48
#: Least share of an item's own score.
THRESHOLD = 0.6
#: Share of an item's score that its inessential words may have together.
SLACK = 0.25
#: Least share of trigrams found, for the question and for the answer.
QUESTION, ANSWER = 0.6, 0.6
#: Without a line of its own, the answer is this last share of an item's words.
ANSWER_SHARE = 1 / 3
K1, B = 1.2, 0.75
BLOCK = 64
#: Postings per broadcast part of the index (under 100 MB).
PART_POSTINGS = 2_000_000

_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _words(column: pa.Array):
    """(hash of each word, words per row) of lower-cased texts."""
    raw, offsets = T.buffer_of(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, counts = T.word_spans(raw, offsets, _WORD)
    return T.span_hashes(raw, starts, ends), counts


def _trigrams(words: np.ndarray) -> np.ndarray:
    return np.unique(T.windows(words, np.array([len(words)]), 3, short=True)[0])


@dataclass
class Index:
    """Postings of a part of the items, by word; impacts are shares of an item's own score.

    Chunks of long items are numbered as items, right after the whole item that owns them.
    """

    items: list  # item ids
    question: list[np.ndarray]  # trigrams
    answer: list[np.ndarray]
    sizes: np.ndarray  # words per item
    words: np.ndarray  # ascending hashes
    starts: np.ndarray  # first posting of each word, and the end
    docs: np.ndarray  # item number of each posting, ascending within a word
    impacts: np.ndarray
    owner: np.ndarray  # number of the whole item, for each item and chunk

    def __post_init__(self):
        n = len(self.starts) - 1
        self.list_max = np.maximum.reduceat(self.impacts, self.starts[:-1]) if n else np.zeros(0)
        order = np.lexsort((-self.impacts, self.docs))
        before = np.cumsum(self.impacts[order])
        first = np.searchsorted(self.docs[order], np.arange(len(self.items)))
        before -= np.concatenate(([0.0], before))[first][self.docs[order]]
        own = np.empty(len(order))
        own[order] = before - self.impacts[order]  # what an item's stronger words hold
        essential = own < 1 - SLACK
        self.rest = 1 - np.bincount(self.docs[essential], self.impacts[essential], minlength=len(self.items))
        keep = np.flatnonzero(essential)
        per_word = np.repeat(np.arange(n), np.diff(self.starts))[keep]
        self.core_starts = np.searchsorted(per_word, np.arange(n + 1))
        self.core_docs, self.core_impacts = self.docs[keep], self.impacts[keep]
        self.gate = np.zeros(1 << 20, dtype=bool)
        self.gate[(self.words >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, word numbers) of the hashes that the index holds."""
        at = np.flatnonzero(self.gate[hashes >> np.uint64(44)])
        to = np.minimum(np.searchsorted(self.words, hashes[at]), len(self.words) - 1)
        same = self.words[to] == hashes[at]
        return at[same], to[same]

    def wand(self, words: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All (item number, score) with a score of at least ``threshold`` for distinct words."""
        lists = [_Postings(self, int(w)) for w in words]
        found = []
        while lists := [p for p in lists if p.doc is not None]:
            lists.sort(key=lambda p: p.doc)
            bound, pivot = 0.0, None
            for i, p in enumerate(lists):
                bound += p.most
                if bound >= threshold - 1e-9:
                    pivot = i
                    break
            if pivot is None:
                break
            doc = lists[pivot].doc
            while pivot + 1 < len(lists) and lists[pivot + 1].doc == doc:
                pivot += 1
            blocks = [p.block(doc) for p in lists[: pivot + 1]]
            if sum(b[0] for b in blocks) < threshold - 1e-9:  # no item before the first block end can do
                end = min([b[1] for b in blocks] + [p.doc - 1 for p in lists[pivot + 1 : pivot + 2]])
                for p in lists[: pivot + 1]:
                    p.seek(max(end, doc) + 1)
            elif lists[0].doc == doc:
                score = sum(p.impact for p in lists[: pivot + 1])
                if score >= threshold - 1e-9:
                    found.append((doc, float(score)))
                for p in lists[: pivot + 1]:
                    p.seek(doc + 1)
            else:
                for p in lists[:pivot]:
                    p.seek(doc)
        return found


class _Postings:
    """A cursor in one word's list."""

    def __init__(self, index: Index, word: int):
        a, b = index.starts[word], index.starts[word + 1]
        self.docs, self.impacts, self.most, self.at = index.docs[a:b], index.impacts[a:b], float(index.list_max[word]), 0

    @property
    def doc(self):
        return int(self.docs[self.at]) if self.at < len(self.docs) else None

    @property
    def impact(self):
        return float(self.impacts[self.at])

    def seek(self, doc: int) -> None:
        self.at += int(np.searchsorted(self.docs[self.at :], doc))

    def block(self, doc: int) -> tuple[float, int]:
        """(largest impact, last item) of the block where ``doc`` would stand."""
        at = self.at + int(np.searchsorted(self.docs[self.at :], doc))
        if at >= len(self.docs):
            return 0.0, int(np.iinfo(np.int64).max)
        a = at // BLOCK * BLOCK
        block = slice(a, min(a + BLOCK, len(self.docs)))
        return float(self.impacts[block].max()), int(self.docs[block][-1])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per item, chunk and distinct word: how often it occurs, and the item's size.

    Chunk 0 is the whole item; items of more than ``STRIDE`` words have others besides.
    """
    for batch in T.slices(batches, "text"):
        hashes, counts = _words(batch.column("text"))
        row = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
        chunk = 1 + place * -(-counts // STRIDE)[row] // np.maximum(counts, 1)[row]
        cut = counts[row] > STRIDE
        row, chunk, words = (np.concatenate(x).astype(np.uint64) for x in ((row, row[cut]), (np.zeros_like(chunk), chunk[cut]), (hashes, hashes[cut])))
        keys, n = np.unique(np.stack([row, chunk, words]), axis=1, return_counts=True)
        at = keys[0].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(batch.column("item").to_numpy()[at]), pa.array(keys[1].view(np.int64)), pa.array(keys[2].view(np.int64)), pa.array(n), pa.array(counts[at])],
            names=["item", "chunk", "word", "tf", "size"],
        )


def _parts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of an item's question and of its answer, its last line or last words."""
    lines = [x for x in text.strip().split("\n") if x.strip()]
    parts = ["\n".join(lines[:-1]), lines[-1]] if len(lines) > 1 else [text, ""]
    hashes, counts = _words(pa.array(parts))
    cut = int(counts[0])
    if min(counts) < 3:
        cut = max(1, len(hashes) - max(3, round(len(hashes) * ANSWER_SHARE)))
    return _trigrams(hashes[:cut]), _trigrams(hashes[cut:])


def indexes(items: DataFrame, item_id: str = "item_id") -> Iterator[Index]:
    """The index of all items, in parts of bounded size."""
    numbered = written(items.select(F.col(item_id).alias("id"), "text").withColumn("item", F.monotonically_increasing_id()), "items")
    terms = written(numbered.select("item", "text").mapInArrow(_postings, "item long, chunk long, word long, tf long, size long"), "item-words")
    sums = terms.agg(F.count(F.lit(1)).alias("postings")).collect()[0]
    whole = terms.where("chunk = 0")
    every = whole.select("item", "size").distinct().agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("size")).collect()[0]
    if not sums["postings"]:
        return
    df = whole.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((every["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("size") / every["size"]))
    weighted = terms.join(df, "word").select("item", "chunk", "word", "size", (idf * tf).alias("w"))
    own = weighted.groupBy("item", "chunk").agg(F.sum("w").alias("own"))
    impacts = written(weighted.join(own, ["item", "chunk"]).select("item", "chunk", "word", "size", (F.col("w") / F.col("own")).alias("impact")), "item-impacts")
    parts = -(-sums["postings"] // PART_POSTINGS)
    for k in range(parts):
        of = F.pmod(F.xxhash64("item"), F.lit(parts)) == k
        rows = impacts.where(of).toPandas()
        names = numbered.where(of).toPandas().set_index("item")
        number = rows.groupby(["item", "chunk"]).ngroup().to_numpy()
        ids = rows[["item", "chunk"]].drop_duplicates().sort_values(["item", "chunk"])["item"].to_numpy()
        if not len(ids):
            continue
        word = rows["word"].to_numpy().view(np.uint64)
        order = np.lexsort((number, word))
        words, starts = np.unique(word[order], return_index=True)
        size = np.zeros(len(ids), dtype=np.int64)
        size[number] = rows["size"].to_numpy()
        halves = {i: _parts_of(names.at[i, "text"]) for i in np.unique(ids)}
        yield Index(
            [names.at[i, "id"] for i in ids], [halves[i][0] for i in ids], [halves[i][1] for i in ids], size, words,
            np.append(starts, len(word)), number[order].astype(np.int64), rows["impact"].to_numpy()[order], np.searchsorted(ids, ids),
        )


def _share(wanted: np.ndarray, have: np.ndarray) -> float:
    return float(np.isin(wanted, have, assume_unique=True).mean()) if len(wanted) else 1.0


def matches_in(index: Index, texts: pa.Array) -> list[tuple[int, int, int, float, float, float]]:
    """(row, item number, first word, score, question share, answer share), the best passage of each.

    Passages that reach the threshold for the whole item go before those that do for a chunk.
    """
    hashes, counts = _words(texts)
    first = np.concatenate(([0], np.cumsum(counts)))
    at, word = index.find(hashes)
    if not len(at):
        return []
    row = np.searchsorted(first, at, "right") - 1
    inside = (at - first[row]) // STRIDE
    # Passages are numbered through all rows; a word lies in its stride's and in the one before.
    base = np.concatenate(([0], np.cumsum(np.maximum(-(-counts // STRIDE), 1))))
    passage = np.concatenate((base[row] + inside, (base[row] + inside - 1)[inside > 0]))
    keys = np.unique(passage * len(index.words) + np.concatenate((word, word[inside > 0])))
    passage, word = keys // len(index.words), keys % len(index.words)
    n = index.core_starts[word + 1] - index.core_starts[word]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    core = np.repeat(index.core_starts[word], n) + step
    pair = np.repeat(passage, n) * len(index.items) + index.core_docs[core]
    pairs, to = np.unique(pair, return_inverse=True)
    held = np.bincount(to, index.core_impacts[core], minlength=len(pairs))
    able = np.unique(pairs[held >= THRESHOLD - index.rest[pairs % len(index.items)] - 1e-9] // len(index.items))
    best: dict[tuple[int, int], tuple] = {}
    for p in able:
        own = word[np.searchsorted(passage, p) : np.searchsorted(passage, p, "right")]
        r = int(np.searchsorted(base, p, "right") - 1)
        start = int(p - base[r]) * STRIDE
        for item, score in index.wand(own):
            a = first[r] + max(0, start - int(index.sizes[item]))
            b = min(first[r + 1], first[r] + start + PASSAGE + int(index.sizes[item]))
            around = _trigrams(hashes[a:b])
            q, s = _share(index.question[item], around), _share(index.answer[item], around)
            own_item = int(index.owner[item])
            rank = (own_item == item, score)
            if q >= QUESTION and s >= ANSWER and rank > best.get((r, own_item), ((False, 0.0),))[0]:
                best[r, own_item] = (rank, start, score, q, s)
    return [(r, item, *v[1:]) for (r, item), v in sorted(best.items())]


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, score, question_overlap, answer_overlap) of all matches.

    ``first_word`` is the place (words from 0) of the best passage for that item.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    kind, item_kind = rows.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, first_word long, score double, question_overlap double, answer_overlap double"
    out = spark.createDataFrame([], schema)
    for index in indexes(items):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in T.slices(batches, "text"):
                found = matches_in(index, batch.column("text"))
                r, item, start, score, q, a = map(list, zip(*found)) if found else ([],) * 6
                names = pa.array([index.items[i] for i in item], type=None if item else pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(r, pa.int64())), names, pa.array(start, pa.int64()), pa.array(score, pa.float64()), pa.array(q, pa.float64()), pa.array(a, pa.float64())],
                    names=["doc_id", "item_id", "first_word", "score", "question_overlap", "answer_overlap"],
                )

        out = out.unionAll(rows.mapInArrow(run, schema))
    return out


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that match no item, with all their columns."""
    for index in indexes(items):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in T.slices(batches, "_text"):
                bad = {m[0] for m in matches_in(shared.value, batch.column("_text"))}
                yield batch.select(["_row"]).filter(pa.array([i not in bad for i in range(batch.num_rows)]))

        packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col("text").alias("_text"))
        docs = packed.mapInArrow(run, packed.select("_row").schema).select("_row.*")
    return docs
