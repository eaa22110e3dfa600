"""Quality rules as weak supervision.

Each rule looks at counts of a text and votes good (1) or bad (0), or abstains (-1).
Expectation-maximisation over the counts of all vote patterns estimates the share of
good texts and how often each rule votes on good and on bad ones, without labels. A
text is kept when its posterior probability of being good is at least one half, unless
it fails the fixed base test.

The patterns are at most 2 ** len(RULES) rows, so the table that reaches the
driver has a fixed bound; it is made by a partially aggregated ``groupBy``.

Defined results: a null text counts as empty; an empty text fails the base test;
repeated rows are judged alike, each on its own; a null ``doc_id`` is kept as it
is; an empty table gives an empty result; other columns pass through ``kept_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .storage import written

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"[#*$%&|<>]"[1:-1])] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_CHAR = np.array([b & 0xC0 != 0x80 for b in range(256)])  # first bytes of code points

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_lines", "n_upper", "n_digits")
FEATURES = ", ".join(f"{c} long" for c in COUNTS + EXTRA)

_BARE = T.SPACES.decode()


def _line_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    lines, repeats = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            own = [x for x in text.split("\n") if x.strip(_BARE)]
            lines[i] = len(own)
            repeats[i] = len(own) - len(set(own))
    return lines, repeats


def _repeated_words(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words per row that lie in a 3-word window found at least twice in the row."""
    keys, at, full = T.windows(hashes, counts, 3, short=False)
    row = np.repeat(np.arange(len(counts)), full)
    keys = T.mix(keys + T.mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), dtype=bool)
    for j in range(3):
        covered[at[twice] + j] = True
    return T.per_row(covered, np.concatenate(([0], np.cumsum(counts))))


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: the counts that the base test and the rules use."""
    for batch in T.slices(batches, "text"):
        raw, offsets = T.buffer_of(batch.column("text"))
        starts, ends, counts = T.word_spans(raw, offsets)
        inside = T.NOT_SPACE[raw]
        lines, repeats = _line_counts(batch.column("text").to_pylist())
        values = {
            "n_words": counts,
            "word_chars": T.per_row(inside & _CHAR[raw], offsets),
            "n_symbols": T.per_row(_SYMBOL[raw], offsets),
            "n_dup_lines": repeats,
            "n_repeat_words": _repeated_words(T.span_hashes(raw, starts, ends), counts),
            "n_lines": lines,
            "n_upper": T.per_row(_UPPER[raw], offsets),
            "n_digits": T.per_row(_DIGIT[raw], offsets),
        }
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), *(pa.array(values[c], pa.int64()) for c in COUNTS + EXTRA)],
            names=["_id", *COUNTS, *EXTRA],
        )


#: name -> (vote, when). A rule that doesn't hold abstains. "prose" asks for
#: ordinary running text; each of the others names one way to be bad.
RULES = {
    "prose": (1, "n_words >= 50 AND n_symbols * 100 <= n_words * 3 AND n_repeat_words * 100 <= n_words * 20 "
                 "AND n_upper * 100 <= word_chars * 15 AND word_chars BETWEEN n_words * 3 AND n_words * 10"),
    "tiny": (0, "n_words < 15"),
    "symbols": (0, "n_symbols * 100 >= n_words * 20"),
    "repeats": (0, "n_repeat_words * 100 >= n_words * 40"),
    "dup_lines": (0, "n_lines >= 4 AND n_dup_lines * 100 >= n_lines * 40"),
    "word_size": (0, "word_chars < n_words * 2 OR word_chars > n_words * 14"),
    "upper": (0, "n_upper * 100 >= word_chars * 35"),
    "digits": (0, "n_digits * 100 >= word_chars * 20"),
}
#: Share of texts held to be good before any vote; how often a rule votes on texts of
#: the class it votes for, and on the others, at the start of the fit.
START_PRIOR, START_RIGHT, START_WRONG = 0.8, 0.5, 0.05
#: EM rounds, and how many texts (at least, and as a share) the start counts for.
ROUNDS, LEAST_WEIGHT, START_WEIGHT = 50, 2.0, 0.002


def fit(patterns: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """EM over vote patterns (rows of -1, 0, 1) with their counts.

    Returns the share of good texts and, for each class (bad, good) and rule, how
    often it votes; votes are independent within a class. The start counts as some
    texts, so a rule that hardly votes stays near it, and a rule never votes more
    often on the class that it votes against.
    """
    target = np.array([vote for vote, _ in RULES.values()])
    start = np.where(np.arange(2)[:, None] == target, START_RIGHT, START_WRONG)
    voted, prior, rates = patterns != -1, START_PRIOR, start
    strength = LEAST_WEIGHT + START_WEIGHT * weights.sum()
    for _ in range(ROUNDS):
        good = posterior(patterns, prior, rates)
        by_class = np.stack([weights * (1 - good), weights * good])
        prior = float((by_class[1].sum() + START_PRIOR * strength) / (by_class.sum() + strength))
        rates = (by_class @ voted + strength * start) / (by_class.sum(axis=1, keepdims=True) + strength)
        low, high = rates.min(axis=0), rates.max(axis=0)
        rates = np.clip(np.where(np.arange(2)[:, None] == target, high, low), 1e-4, 1 - 1e-4)
    return prior, rates


def posterior(patterns: np.ndarray, prior: float, rates: np.ndarray) -> np.ndarray:
    """Probability that a text with each pattern is good."""
    voted = (patterns != -1).astype(float)
    logs = np.log([1 - prior, prior]) + voted @ np.log(rates).T + (1 - voted) @ np.log(1 - rates).T
    return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` as the struct ``_id``, with the counts of each text."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(count_features, f"_id {kind}, {FEATURES}")


BASE_FAILED = "n_words < 50 OR n_repeat_words * 100 > n_words * 50"


def _voted(counts: DataFrame) -> DataFrame:
    return counts.withColumn("votes", F.array(*(F.expr(f"CASE WHEN {when} THEN {vote} ELSE -1 END") for vote, when in RULES.values())))


def fitted(counts: DataFrame) -> DataFrame:
    """(votes, quality): the posterior of every vote pattern.

    The fit is to the texts that pass the base test: the others are decided.
    """
    voted = _voted(counts).groupBy("votes").agg(F.sum(F.expr(f"IF({BASE_FAILED}, 0, 1)")).alias("n"))
    seen = [(list(r["votes"]), r["n"]) for r in voted.collect()]  # at most 2 ** len(RULES) rows
    patterns = np.array([v for v, _ in seen], dtype=int).reshape(-1, len(RULES))
    quality = posterior(patterns, *fit(patterns, np.array([n for _, n in seen], dtype=float)))
    rows = [(v, float(q)) for (v, _), q in zip(seen, quality)]
    return counts.sparkSession.createDataFrame(rows, "votes array<int>, quality double")


def judged(counts: DataFrame, model: DataFrame) -> DataFrame:
    """``counts`` with votes, quality, base_failed and kept."""
    return (
        _voted(counts)
        .join(F.broadcast(model), "votes")
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    )


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept, quality (posterior), votes."""
    pairs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    narrow = features(pairs).select(F.col("_id.doc_id").alias(doc_id), *COUNTS, *EXTRA)
    counts = written(narrow, "quality-counts")
    return judged(counts, fitted(counts)).select(doc_id, *COUNTS, "base_failed", "kept", "quality", "votes")


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text is kept, with all their columns.

    Texts are counted twice, once for the fit and once for the verdict, which
    moves no row between tasks and writes nothing.
    """
    model = fitted(features(docs.select(F.col(f"`{text}`").alias("text"))))
    return judged(features(docs, text), model).where("kept").select("_id.*")
