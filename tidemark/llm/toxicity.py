"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: case, homoglyphs (letters of other scripts and widths that
look like Latin ones) and digits or signs used as letters. Lexicon entries are whole
words or word beginnings, given as a list or learned from labelled texts as weighted
log-odds. Hits inside an exception phrase don't count. A text's evidence is the
weight of its hits and that weight per word; a logistic curve, fitted on the labelled
texts, makes a score from 0 to 1 of it.

Learning uses at most ``MAX_PER_CLASS`` texts of each label, the ones with the lowest
hashes of their ids, so the sample and what is broadcast have a fixed bound. Near
copies among them count once. Scoring reads every whole text.

Defined results: null and empty texts have no hits and the score of no evidence; a null
doc_id is scored, with a null id; labels that are null are not learned from; without
any toxic or any clean label the built-in words are used with the default curve;
repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import written

#: Largest number of labelled texts of each class that are learned from.
MAX_PER_CLASS = 4_000
#: Largest number of learned lexicon entries.
MAX_ENTRIES = 2_000
#: Word beginnings of these lengths can become entries; longer words count whole.
STEMS = range(3, 8)
#: Least log-odds of an entry, and least log-likelihood ratio (that its share differs).
MIN_LOG_ODDS, MIN_RATIO = 2.5, 20.0

#: Words that are toxic in any corpus, with a weight.
BASE_WORDS = {w: 3.0 for w in "idiot moron imbecile scum loser stupid pathetic worthless disgusting clown trash retard bastard".split()}
#: Phrases in which such words are harmless.
EXCEPTIONS = (
    "trash can", "trash bin", "white trash bag", "class clown fish", "clown fish", "loser bracket",
    "sore loser rule", "worthless bond", "worthless stock", "stupid simple", "pathetic fallacy",
    "pond scum", "soap scum", "bastard file", "fire retard",
)

#: Letters of other scripts that look like Latin ones (fixed values).
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d", "ɡ": "g",
    "һ": "h", "ո": "n", "м": "m", "т": "t", "к": "k", "в": "b", "н": "h", "ο": "o", "α": "a", "ι": "i", "ν": "v", "ρ": "p",
    "τ": "t", "υ": "u", "κ": "k", "ε": "e", "ı": "i",
}
#: Digits and signs used for letters (fixed values).
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "​": "", "‍": "", "­": ""}


def _fold_table() -> dict[int, str]:
    table = {ord(k): v for k, v in HOMOGLYPHS.items()} | {ord(k.upper()): v for k, v in HOMOGLYPHS.items() if len(k.upper()) == 1 and k.upper() > "\x7f"}
    table |= {ord(k): v for k, v in SUBSTITUTES.items()}
    table |= {c: unicodedata.normalize("NFKC", chr(c)).lower() for c in range(0xFF21, 0xFF5B) if chr(c).isalpha()}
    return table


_FOLD = _fold_table()
_ASCII = bytes(ord(SUBSTITUTES.get(chr(b), chr(b).lower())) if b < 128 else b for b in range(256))
_ODD = None  # made on first use: a pattern of what needs the slow way


def fold(text: str) -> str:
    """Lower case with homoglyphs and substituted digits as Latin letters."""
    if text.isascii():
        return text.encode().translate(_ASCII).decode()
    return text.encode().translate(_ASCII).decode().lower().translate(_FOLD) if _needs_table(text) else text.encode().translate(_ASCII).decode().lower()


def _needs_table(text: str) -> bool:
    global _ODD
    if _ODD is None:
        import re

        _ODD = re.compile("[" + "".join(sorted(map(chr, (c for c in _FOLD if c > 127)))) + "]")
    return _ODD.search(text) is not None


@dataclass(frozen=True)
class Lexicon:
    """weights: entry -> (weight, whole word?); curve: intercept, and slopes of log weight and log density."""

    weights: dict[str, tuple[float, bool]]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 2.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for entry, (weight, whole) in self.weights.items():
            made.add_word(entry, (len(entry), weight, whole, False))
        for phrase in self.exceptions:
            made.add_word(folded := fold(phrase), (len(folded), *self.weights.get(folded, (0.0, False)), True))
        if len(made):
            made.make_automaton()
        return made


def evidence(folded: str, automaton: ahocorasick.Automaton) -> float:
    """The weight of the hits in a folded text, at most one for each place in a word.

    A hit starts a word; a whole-word entry ends it too. Of entries that start at one
    place the heaviest counts, and none that lies in an exception phrase.
    """
    hits: dict[int, tuple[float, int]] = {}
    spared: list[tuple[int, int]] = []
    if not len(automaton):
        return 0.0
    for end, (size, weight, whole, exception) in automaton.iter(folded):
        start = end - size + 1
        if start and folded[start - 1].isalnum():
            continue
        if exception:
            spared.append((start, end))
        if weight and not (whole and end + 1 < len(folded) and folded[end + 1].isalnum()) and weight > hits.get(start, (0.0, 0))[0]:
            hits[start] = (weight, end)
    if not spared:
        return sum(w for w, _ in hits.values())
    # The reach of the exceptions up to each of their starts: only the last before a hit is asked.
    spared.sort()
    opens, reach = [a for a, _ in spared], list(accumulate((b for _, b in spared), max))
    total = 0.0
    for start, (w, end) in hits.items():
        k = bisect_right(opens, start)
        if not k or reach[k - 1] < end:
            total += w
    return total


def _inputs(weight, words):
    """The two inputs of the curve: log weight and log weight per 100 words."""
    return np.log1p(weight), np.log1p(100 * weight / np.maximum(words, 1))


def scored(df: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``df`` with toxic_weight, n_words and score."""
    schema = df.select("*", *(F.lit(0.0).alias("toxic_weight"), F.lit(0).cast("long").alias("n_words"), F.lit(0.0).alias("score"))).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        a, b, c = lexicon.curve
        for batch in T.slices(batches, text):
            folded = [fold(t) if t else "" for t in batch.column(text).to_pylist()]
            weight = np.array([evidence(t, automaton) for t in folded], dtype=float)
            words = np.array([len(t.split()) for t in folded], dtype=np.int64)
            x, y = _inputs(weight, words)
            score = 1 / (1 + np.exp(-(a + b * x + c * y)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weight), pa.array(words), pa.array(score)], names=[*batch.schema.names, "toxic_weight", "n_words", "score"])

    return df.mapInArrow(run, schema)


def training_rows(docs: DataFrame, labels: DataFrame, held_out, most: int = MAX_PER_CLASS) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled texts of each class that aren't held out."""
    labels = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    by_hash = labels.dropDuplicates(["doc_id"]).withColumn("_h", F.xxhash64("doc_id"))
    chosen = by_hash.where("toxic = 1").orderBy("_h", "doc_id").limit(most).unionAll(by_hash.where("toxic = 0").orderBy("_h", "doc_id").limit(most))
    chosen = chosen.select("doc_id", "toxic")
    return docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")  # at most 2 * most rows


def _document_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: the distinct words and word beginnings, and a signature that near copies share."""
    for batch in T.slices(batches, "text"):
        keys, features = [], []
        raw, offsets = T.buffer_of(batch.column("text"))
        starts, ends, counts = T.word_spans(raw, offsets)
        hashes, _, per = T.windows(T.span_hashes(raw, starts, ends), counts, 3, short=True)
        at = np.concatenate(([0], np.cumsum(per)))
        for i, text in enumerate(batch.column("text").to_pylist()):
            keys.append(int(hashes[at[i] : at[i + 1]].min() >> np.uint64(1)) if per[i] else 0)
            words = {w.strip("\"'.,;:!?()[]{}#*$%&|<>-_") for w in fold(text).split()}
            features.append(sorted({w + "\n" for w in words if 2 < len(w) < 30} | {w[:k] for w in words for k in STEMS if len(w) >= k}))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column("toxic"), pa.array(features, pa.list_(pa.string()))], names=["near", "toxic", "features"])


def learn(docs: DataFrame, labels: DataFrame, held_out, most: int = MAX_PER_CLASS) -> Lexicon:
    """A lexicon and its curve from labelled texts for which ``held_out`` is false."""
    rows = written(training_rows(docs, labels, held_out, most), "toxicity-sample")
    lists = written(rows.mapInArrow(_document_features, "near long, toxic int, features array<string>").dropDuplicates(["near", "toxic"]), "toxicity-features")
    sizes = {r["toxic"]: r["n"] for r in lists.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({w: (v, True) for w, v in BASE_WORDS.items()})
    counts = lists.select("toxic", F.explode("features").alias("entry")).groupBy("entry").agg(F.sum("toxic").alias("p"), F.sum(1 - F.col("toxic")).alias("n"))
    odds = F.log((F.col("p") + 0.5) / (n_toxic + 1)) - F.log((F.col("n") + 0.5) / (n_clean + 1))
    both, total = F.col("p") + F.col("n"), n_toxic + n_clean
    ratio = 2 * sum(F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) * total / (both * size))).otherwise(0.0) for k, size in (("p", n_toxic), ("n", n_clean)))
    strong = counts.withColumn("w", odds).where((F.col("w") >= MIN_LOG_ODDS) & (ratio >= MIN_RATIO))
    top = strong.orderBy(F.desc(F.col("w") * F.col("p")), "entry").limit(MAX_ENTRIES).collect()
    weights = {w: (v, True) for w, v in BASE_WORDS.items()}
    # A beginning of a word makes its longer forms needless, unless they are much stronger.
    for r in sorted(top, key=lambda r: (len(r["entry"].rstrip("\n")), r["entry"])):
        entry, whole = r["entry"].rstrip("\n"), r["entry"].endswith("\n")
        covered = any((f := weights.get(entry[:k])) and not f[1] and f[0] > r["w"] - 1 for k in range(1, len(entry) + 1))
        if not covered and not (whole and entry in weights and weights[entry][0] >= r["w"]):
            weights[entry] = (float(r["w"]), whole)
    lexicon = Lexicon(weights)
    sample = scored(rows, lexicon).select("toxic", "toxic_weight", "n_words").collect()  # at most 2 * most narrow rows
    return Lexicon(weights, lexicon.exceptions, _curve(sample))


def _curve(sample) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    y = np.array([r["toxic"] for r in sample], dtype=float)
    x, z = _inputs(np.array([r["toxic_weight"] for r in sample]), np.array([r["n_words"] for r in sample]))
    design, beta, ridge = np.stack([np.ones_like(x), x, z], axis=1), np.zeros(3), np.diag([1e-3, 0.1, 0.1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, design.T @ (y - p) - ridge @ beta)
        size = float(np.abs(step).max())
        beta += step / max(1.0, size)
        if size < 1e-8:
            break
    return tuple(map(float, beta))


def held_out_fifth(doc_id):
    """The rows whose labels are never learned from: crc32 of the id as text divisible by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def score_documents(docs: DataFrame, labels: DataFrame, held_out=held_out_fifth) -> DataFrame:
    """(doc_id, held_out, score, predicted, toxic_weight, n_words) for every row."""
    lexicon = learn(docs, labels, held_out)
    rows = scored(docs.select("doc_id", "text"), lexicon)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic_weight", F.col("n_words"))


def clean_documents(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The rows whose score is below one half, with all their columns."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), F.col(f"`{text}`").alias("_text"))
    return scored(rows, lexicon, "_text").where("score < 0.5").select("_row.*")
