"""Token ids as canonical, length-limited Huffman codes in independent blocks.

File format. A dataset is a folder with three Parquet tables:

* ``book``: one row per id that occurs, (id int, bits int): the code lengths. Codes
  are canonical: numbered within a length by ascending id, shorter lengths first.
* ``coded``: rows in order of (shard, segment), each a run of whole documents:
  ``doc_ids`` and ``sizes`` (ids per document), ``bits`` (big-endian 32-bit words of
  the codes), ``checkpoints`` (the bit offset of every block of ``BLOCK`` ids, so that
  any block is decoded alone), ``n_ids``
  and ``before`` (ids of the shard that stand before the segment);
* ``starts``: (shard, start): how many ids stand before each of at most ``MAX_SHARDS`` shards.

Documents are in ascending doc_id order over all segments. Code lengths come from
global counts by package-merge with at most ``MAX_BITS`` bits. Decoding looks up the
next ``MAX_BITS`` bits in a table and takes one id from every block at a time.

Defined results: a null text is encoded as an empty one, which has only the end id;
a null doc_id comes first; rows that share a doc_id stay apart, in the order of
their ids' bytes; an empty table gives an empty dataset; other columns aren't read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as T
from .storage import table_path, written

END_ID = 1
MAX_BITS = 18
#: Ids per block, and ids per segment (a document is never cut).
BLOCK = 256
SEGMENT = 1 << 19
#: Shards of a dataset, at most: what its index holds and every task reads of it.
MAX_SHARDS = 1 << 18
#: Distinct words remembered per worker.
REMEMBERED = 500_000
#: Punctuation that is tokenized apart from the word that it ends.
ENDINGS = ".,;:!?#*$%&"

# ---------------------------------------------------------------- tokenizing


_ENDING = np.array([b in ENDINGS.encode() for b in range(256)])
#: Letters that UTF-8 writes as C3 and one more byte.
LATIN = "".join(chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha())
_SECOND = np.array([bytes([0xC3, b]).decode() in LATIN if 128 <= b < 192 else False for b in range(256)])
_LATIN_WORD = re.compile(f"[A-Za-z{LATIN}]+")
#: These letters as byte-level vocabularies write them: bytes without a sign of their own come after 255.
_NO_SIGN = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or 174 <= b)]
_SHIFTED = [(chr(b), chr(256 + k)) for k, b in enumerate(_NO_SIGN) if b >= 128 and bytes([0xC3, b]).decode() in LATIN.lower()]
_ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])


def _byte_level(words: str) -> str:
    """Lower-cased words of Latin letters in the signs of byte-level vocabularies."""
    words = words.lower()
    if not words.isascii():
        words = words.encode().decode("latin-1")
        for byte, sign in _SHIFTED:
            words = words.replace(byte, sign)
    return words


class WordIds:
    """Ids of texts by a tokenizer that drops white space and never joins across it.

    Each distinct word (run of other characters) goes through the tokenizer once; words
    are cut between letters (ASCII or of ``LATIN``) or ASCII digits and ``ENDINGS`` if the
    tokenizer cuts there as well, and A-Z are lower-cased before if it does that. New words are joined by a
    special token, by which their ids are told apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.mark, self.mark_id = next(iter(special.items()), (None, None))
        self.special = tuple(special)
        same = lambda *texts: len({tuple(sum((self.tokenizer.encode(t, add_special_tokens=False).ids for t in x), [])) for x in texts}) == 1
        self.folds = same(("Ab",), ("ab",))
        self.cuts = all(same((f"a1{p}b",), ("a1", p, "b")) for p in [*ENDINGS, ENDINGS])
        self.cuts_latin = self.cuts and all(same((f"{c}{p}{c}",), (c, p, c)) for c in LATIN for p in ENDINGS)
        # Words of Latin letters need no pattern, only folding, signs for bytes and the merges.
        own = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []}
        self.merges = Tokenizer.from_str(json.dumps(own))
        probes = ["!", "a", "z", "the", "and", "qxz", "tokenization", "thntblere"]
        alike = [self.merges.encode(p).ids == self.tokenizer.encode(p, add_special_tokens=False).ids for p in probes]
        self.plain = all(alike) and len(self.merges.encode("!").ids) == 1
        probes = [*LATIN, *(f"{a}{b}" for a, b in zip(LATIN, LATIN[1:])), *(f"th{c}Tion" for c in LATIN)]
        self.latin = self.plain and self.folds and all(
            [t.id for t in self.merges.model.tokenize(_byte_level(p))] == self.tokenizer.encode(p, add_special_tokens=False).ids for p in probes)
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.pool, self.begin = array("i"), array("q", [0])

    def _add(self, words: list[str]) -> None:
        if self.latin:
            plain = [w for w in words if _LATIN_WORD.fullmatch(w)]
            self._add_latin(plain)
        else:
            plain = [w for w in words if w.isascii() and w.isalpha() and w.islower()] if self.plain else []
            self._add_joined(self.merges, plain, "!", self.merges.encode("!").ids[0] if plain else None)
        rest = [w for w in words if w not in self.words] if plain else words
        alone = [w for w in rest if self.mark is None or ("<" in w and any(s in w for s in self.special))]
        for w, e in zip(alone, self.tokenizer.encode_batch(alone, add_special_tokens=False)):
            self.words[w] = len(self.begin) - 1
            self.pool.extend(e.ids)
            self.begin.append(len(self.pool))
        self._add_joined(self.tokenizer, [w for w in rest if w not in self.words] if alone else rest, self.mark, self.mark_id)

    def _add_latin(self, words: list[str]) -> None:
        """Encode words of Latin letters by the tokenizer's model alone."""
        tokenize = self.merges.model.tokenize
        for i in range(0, len(words), 4096):  # ids of so many words at once
            group = words[i : i + 4096]
            ids = [[t.id for t in tokenize(w)] for w in _byte_level("\n".join(group)).split("\n")]
            first, before = len(self.begin) - 1, len(self.pool)
            self.words.update(zip(group, range(first, first + len(group))))
            self.pool.extend(chain.from_iterable(ids))
            self.begin.extend(islice(accumulate(map(len, ids), initial=before), 1, None))

    def _add_joined(self, tokenizer, words: list[str], mark: str, mark_id: int) -> None:
        """Encode words with a mark between them, whose id none of them has."""
        groups = [words[i : i + 256] for i in range(0, len(words), 256)]
        for group, e in zip(groups, tokenizer.encode_batch_fast([f" {mark} ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, dtype=np.int32)
            marks = np.flatnonzero(ids == mark_id)
            ends = np.append(marks, len(ids)) - np.arange(len(group))
            first, before = len(self.begin) - 1, len(self.pool)
            self.words.update(zip(group, range(first, first + len(group))))
            self.pool.frombytes(np.delete(ids, marks).tobytes())
            self.begin.frombytes((ends + before).astype(np.int64).tobytes())

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, each row ended by ``end_id``; ids per row)."""
        raw, offsets = T.buffer_of(column)
        starts, ends, counts = T.word_spans(raw, offsets)
        if self.folds:
            # Special tokens are matched before folding: bytes of words with "<" stay. So do words
            # that aren't all ASCII: a letter may only compose with the mark after it in one case.
            stays = _near_sign(raw) if 60 in raw else None
            far = np.flatnonzero(raw >= 128)
            if len(far):
                at = np.searchsorted(starts, far, side="right") - 1  # the word of each such byte
                mixed = at[np.flatnonzero(np.diff(at, prepend=-1))]
                edge = np.zeros(len(raw) + 1, dtype=np.int8)
                edge[starts[mixed]] += 1
                edge[ends[mixed]] -= 1
                inside = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
                stays = inside if stays is None else stays | inside
            raw = T.LOWER[raw] if stays is None else np.where(stays, raw, T.LOWER[raw])
        if self.cuts and len(starts):
            sign = np.flatnonzero(_ENDING[raw])
            before, after = sign[sign > 0], sign[sign < len(raw) - 1]
            ended, begun = _ALNUM[raw[before - 1]], _ALNUM[raw[after + 1]]
            if self.cuts_latin:
                ended |= (before > 1) & (raw[before - 2] == 0xC3) & _SECOND[raw[before - 1]]
                begun |= (raw[after + 1] == 0xC3) & _SECOND[raw[np.minimum(after + 2, len(raw) - 1)]]
            cut = np.sort(np.concatenate((before[ended], after[begun] + 1)))
            edges = np.searchsorted(cut, offsets)  # where a text ends, none is needed
            edges = edges[edges < len(cut)][cut[edges[edges < len(cut)]] == offsets[edges < len(cut)]]
            cut = np.delete(cut, edges)
            counts = counts + np.diff(np.searchsorted(cut, offsets))
            starts, ends = (np.insert(x, np.searchsorted(x, cut), cut) for x in (starts, ends))
        size = ends - starts
        data = raw[T.NOT_SPACE[raw]]
        at = np.concatenate(([0], np.cumsum(size)))
        words = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(at), pa.py_buffer(data)).dictionary_encode()
        texts = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.words) > REMEMBERED:
            self.forget()
        if new := [w for w in texts if w not in self.words]:
            self._add(new)
        flat = np.append(np.frombuffer(self.pool, dtype=np.int32), np.int32(end_id)) if self.pool else np.array([end_id], np.int32)
        begin = np.frombuffer(self.begin, dtype=np.int64)
        own = np.fromiter(map(self.words.__getitem__, texts), dtype=np.int64, count=len(texts))
        start = np.append(begin[own], len(flat) - 1).astype(np.int32)
        length = np.append(begin[own + 1] - begin[own], 1).astype(np.int32)
        # Words of all rows with an end mark after each row.
        row_ends = np.cumsum(counts)
        marks = np.insert(words.indices.to_numpy(zero_copy_only=False), row_ends, len(texts))
        n = length[marks]
        last = np.cumsum(n, dtype=np.int32)  # a slice holds fewer ids than bytes
        at = np.repeat(start[marks] - (last - n), n)
        at += np.arange(len(at), dtype=np.int32)
        return flat[at], np.diff(last[row_ends + np.arange(len(row_ends))], prepend=0).astype(np.int64)


def _near_sign(raw: np.ndarray) -> np.ndarray:
    """Bytes of words that hold a ``<``."""
    word = np.cumsum(~T.NOT_SPACE[raw])
    return np.isin(word, word[raw == 60]) & T.NOT_SPACE[raw]


_WORD_IDS: dict[str, WordIds] = {}


def numbers(ids: int) -> np.dtype:
    """How ids below ``ids`` are kept between the passes."""
    return np.dtype("<u2" if ids <= 1 << 16 else "<u4")


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n, ids): the ids of each text and the end id, as little-endian numbers.

    Numbers have 16 bits where the vocabulary allows it, else 32 (see ``numbers``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _WORD_IDS.get(tokenizer) or _WORD_IDS.setdefault(tokenizer, WordIds(tokenizer))
        for batch in T.slices(batches, "text", 8 * T.SLICE_BYTES):
            ids, n = own.encode(batch.column("text"), end_id)
            kind = numbers(own.tokenizer.get_vocab_size())
            raw = ids.astype(kind).tobytes()
            at = list(accumulate((kind.itemsize * int(k) for k in n), initial=0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array([raw[a:b] for a, b in zip(at, at[1:])], pa.binary())], names=["doc_id", "n", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, ids binary")


def id_counts(rows: DataFrame, kind: np.dtype) -> DataFrame:
    """(id, n) over all documents, summed within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for raw in batch.column("ids"):
                own = np.bincount(np.frombuffer(raw.as_buffer(), dtype=kind))
                if len(own) > len(total):
                    own[: len(total)] += total
                    total = own
                else:
                    total[: len(own)] += own
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["id", "n"])

    return rows.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- codes


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits for positive counts, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    most = max(most, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    levels, row, leaf = [], weights, np.ones(n, dtype=bool)
    for _ in range(most - 1):
        levels.append(leaf)
        packed = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((weights, packed))
        by = np.argsort(both, kind="stable")
        row, leaf = both[by], by < n
    levels.append(leaf)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        lengths[:leaves] += 1  # the lightest symbols come first
        take = 2 * (take - leaves)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Book:
    """Canonical codes for ids (ascending) with given lengths, and the table that decodes them."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort((ids, bits))
        length = bits[order]
        self.width = int(length.max()) if len(length) else 1
        room = np.left_shift(np.int64(1), self.width - length)
        code = (np.cumsum(room) - room) >> (self.width - length)
        self.code = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=np.uint64)
        self.size = np.zeros(len(self.code), dtype=np.int64)
        self.code[ids[order]], self.size[ids[order]] = code, length
        used = int(room.sum())
        self.symbol = np.zeros(1 << self.width, dtype=np.int32)
        self.taken = np.ones(1 << self.width, dtype=np.int64)
        self.symbol[:used] = np.repeat(ids[order], room)
        self.taken[:used] = np.repeat(length, room)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(32-bit big-endian words with all codes, bit offset of every block)."""
        size = self.size[ids]
        end = np.cumsum(size)
        at = end - size
        word, inside = at >> 5, (at & 31).astype(np.uint64)
        # A code of at most 32 bits lies in one word and the next.
        value = self.code[ids] << (np.uint64(64) - inside - size.astype(np.uint64))
        words = np.zeros((int(end[-1]) >> 5) + 3 if len(ids) else 2, dtype=np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        if len(ids):
            words[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
            words[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return words.astype(">u4").tobytes(), at[::BLOCK]

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
        """The ids of the blocks that start at ``checkpoints``, ``n`` in all."""
        raw = np.frombuffer(bits, dtype=">u4").astype(np.uint64)
        pairs = (raw[:-1] << np.uint64(32)) | raw[1:]
        at = checkpoints.astype(np.int64).copy()
        out = np.zeros((len(at), block), dtype=np.int32)
        shift = np.uint64(64 - self.width)
        short = n - (len(at) - 1) * block  # ids of the last block
        for k in range(min(block, n)):
            if k == short:
                at = at[:-1]
            window = (pairs[at >> 5] << (at & 31).astype(np.uint64)) >> shift
            window = window.astype(np.int64)
            out[: len(at), k] = self.symbol[window]
            at = at + self.taken[window]
        return out.reshape(-1)[:n]


# ---------------------------------------------------------------- writing and reading


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode all texts of ``docs`` into a dataset at ``path``."""
    spark = docs.sparkSession
    rows = written(tokenized(docs, tokenizer, end_id), "ids")
    from tokenizers import Tokenizer

    stored = numbers(Tokenizer.from_file(tokenizer).get_vocab_size())
    counts = id_counts(rows, stored).orderBy("id").toPandas()  # at most one row per id of the vocabulary
    ids, bits = counts["id"].to_numpy(dtype=np.int64), code_lengths(counts["n"].to_numpy(dtype=np.int64))
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(ids, bits)], "id int, bits int").coalesce(1).write.parquet(f"{path}/book")

    # Range bounds come from narrow keys; the checksum splits rows that share a doc_id.
    sums = rows.agg(F.sum("n").alias("n")).collect()[0]["n"] or 0
    shards = max(1, -(-int(sums) // max(4 * SEGMENT, -(-int(sums) // MAX_SHARDS))))
    ordered = rows.withColumn("_crc", F.crc32("ids")).repartitionByRange(shards, "doc_id", "_crc").sortWithinPartitions("doc_id", "_crc", "ids").drop("_crc")
    shared = spark.sparkContext.broadcast((ids, bits))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        book, shard, k = Book(*shared.value), TaskContext.get().partitionId(), 0
        names, parts, size, before = [], [], 0, 0

        def full():
            coded, marks = book.encode(np.concatenate(parts))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([k], pa.int32()), pa.array([names], pa.list_(kind)), pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                    pa.array([size], pa.int64()), pa.array([before], pa.int64()), pa.array([coded], pa.binary()), pa.array([marks.tolist()], pa.list_(pa.int64())),
                ],
                names=["shard", "segment", "doc_ids", "sizes", "n_ids", "before", "bits", "checkpoints"],
            )

        kind = pa.int64()
        for batch in batches:
            kind = batch.column("doc_id").type
            for name, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                names.append(name)
                parts.append(np.frombuffer(raw.as_py(), dtype=stored))
                size += len(parts[-1])
                if size >= SEGMENT:
                    yield full()
                    names, parts, size, k, before = [], [], 0, k + 1, before + size
        if names:
            yield full()

    kind = docs.schema["doc_id"].dataType.simpleString()
    coded = ordered.select("doc_id", "ids").mapInArrow(segments, f"shard int, segment int, doc_ids array<{kind}>, sizes array<long>, n_ids long, before long, bits binary, checkpoints array<long>")
    coded.write.option("compression", "none").parquet(f"{path}/coded")
    _with_starts(spark, path)


def _with_starts(spark: SparkSession, path: str) -> None:
    """The index table ``starts``: ids before each shard, from the segments' own counts."""
    sizes = spark.read.parquet(f"{path}/coded").groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # MAX_SHARDS rows at most
    rows = list(zip((r["shard"] for r in sizes), accumulate((r["n"] for r in sizes), initial=0)))
    spark.createDataFrame(rows, "shard int, start long").coalesce(1).write.parquet(f"{path}/starts")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): decoded documents; ids as array<int>."""
    return _decoded(spark, path, "ids array<int>", lambda ids, at: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the decoded documents."""

    def sums(ids: np.ndarray, at: np.ndarray) -> pa.Array:
        raw = memoryview(ids.astype("<u4").tobytes())
        return pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())

    return _decoded(spark, path, "ids_crc32 long", sums)


def _decoded(spark: SparkSession, path: str, extra: str, make) -> DataFrame:
    lengths = spark.read.parquet(f"{path}/book").orderBy("id").toPandas()
    shared = spark.sparkContext.broadcast((lengths["id"].to_numpy(dtype=np.int64), lengths["bits"].to_numpy(dtype=np.int64)))
    name, kind = extra.split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Book(*shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                n = row.column("n_ids")[0].as_py()
                marks = row.column("checkpoints").flatten().to_numpy(zero_copy_only=False)
                ids = book.decode(row.column("bits")[0].as_py(), marks, n)
                sizes = row.column("sizes").flatten().to_numpy(zero_copy_only=False)
                at = np.concatenate(([0], np.cumsum(sizes)))
                yield pa.RecordBatch.from_arrays(
                    [row.column("doc_ids").flatten(), pa.array(at[:-1] + row.column("start")[0].as_py()), pa.array(sizes), make(ids, at)],
                    names=["doc_id", "start", "n_tokens", name],
                )

    coded = spark.read.parquet(f"{path}/coded")
    starts = spark.read.parquet(f"{path}/starts")
    doc_kind = coded.schema["doc_ids"].dataType.elementType.simpleString()
    rows = coded.join(F.broadcast(starts), "shard").withColumn("start", F.col("start") + F.col("before"))  # MAX_SHARDS rows at most
    return rows.mapInArrow(run, f"doc_id {doc_kind}, start long, n_tokens long, {name} {kind}")


def round_trip(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write ``docs`` (to the shared folder by default) and return what reading gives back."""
    path = path or table_path(docs.sparkSession, "huffman")
    write(docs, path, tokenizer)
    return read_digests(docs.sparkSession, path)
