"""Quality rules: plain limits and boosted trees over statistics of whole documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.shared import SPACES
from sluiceway.llm.trees import Forest, fit

#: The classifier is fitted on so many labelled documents at most, those with the smallest hash.
SAMPLE_ROWS = 10_000
#: A document goes if the trees give it a smaller chance to be good.
LEAST_CHANCE = 0.5
WINDOW = 8
SYMBOLS = "#*$%&|<>"

COUNTS = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"
#: Statistics the trees read, and whether a larger value may only lower the chance to be good.
FEATURES = {
    "log_words": 0,
    "chars_per_word": 0,
    "symbols_per_word": -1,
    "dup_lines_per_line": -1,
    "repeat_words_share": -1,
    "capitals_share": -1,
    "exclamations_per_word": -1,
    "digits_share": 0,
    "distinct_share": 0,
    "words_per_line": 0,
    "stops_per_word": 0,
    "longest_word": 0,
}


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included; exact."""
    size = len(words) - window + 1
    if size < 2:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    width, span = len(numbers), 1
    while span < window:  # codes of spans of twice the length, renumbered densely
        pairs = codes[:-span] * width + codes[span:]
        _, codes = np.unique(pairs, return_inverse=True)
        width, span = int(codes.max()) + 1, span * 2
    repeated = np.bincount(codes)[codes] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(repeated)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The counts and the trees' features of one whole text."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    lines = dup_lines = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            dup_lines += line in seen
            seen.add(line)
    repeats = repeated_words(words)
    size, per = max(1, chars), max(1, n)
    capitals = sum(map(str.isupper, text))
    features = [
        float(np.log1p(n)),
        chars / per,
        symbols / per,
        dup_lines / max(1, lines),
        repeats / per,
        capitals / size,
        text.count("!") / per,
        sum(map(text.count, "0123456789")) / size,
        len(set(words)) / per,
        n / max(1, lines),
        text.count(".") / per,
        float(max(map(len, words), default=0)),
    ]
    return [n, chars, symbols, dup_lines, repeats], features


def fit_forest(documents: DataFrame, labels: DataFrame, key: str, text: str, good: str, sample_rows: int) -> Forest:
    """Trees over a bounded sample of labelled documents: those whose keys' hashes are smallest.

    Labels with a null key or value are left out; of several for a document the smallest counts.
    """
    chosen = (
        labels.select(F.col(key).alias("key"), F.col(good).cast("double").alias("good"))
        .where("key IS NOT NULL AND good IS NOT NULL")
        .groupBy("key")
        .agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(sample_rows)
    )
    sample = (
        documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "key")  # at most sample_rows pairs of numbers
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(x.as_py())[1] for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("good"), pa.array(rows, pa.list_(pa.float64()))],
                names=["key", "good", "features"],
            )

    kind = documents.schema[key].dataType.simpleString()
    found = sample.mapInArrow(features, f"key {kind}, good double, features array<double>").dropDuplicates(["key"])
    data = found.orderBy("key").toPandas()
    rows = np.array(data["features"].tolist(), float).reshape(len(data), len(FEATURES))
    return fit(rows, (data["good"].to_numpy(float) > 0.5).astype(float), np.array([*FEATURES.values()]))


def quality(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    good: str = "quality",
    keep: list[str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
    least_chance: float = LEAST_CHANCE,
) -> DataFrame:
    """A row per document: the columns of ``keep`` (the key alone if None), the counts,
    ``base_failed``, ``kept`` and the trees' ``chance`` to be good.

    A document fails the base rules with under 20 words or with more than 30 in 100 words repeated.
    The trees judge the others. Null and empty texts have no words and fail; equal rows are judged
    alike, each for itself; no documents give no rows; without labels of both kinds the trees keep
    all that pass the base rules. No shuffle but of the labels.
    """
    keep = keep or [key]
    # the constant forest of labels of one kind says nothing about a document
    forest = fit_forest(documents, labels, key, text, good, sample_rows)
    trained = bool(len(forest.roots))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            counts = np.array([x for x, _ in found], np.int64).reshape(len(found), len(COUNTS))
            rows = np.array([x for _, x in found], float).reshape(len(found), len(FEATURES))
            chance = forest.probability(rows)
            failed = (counts[:, 0] < 20) | (100 * counts[:, 4] > 30 * counts[:, 0])
            kept = ~failed & ((chance >= least_chance) | (not trained))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *map(pa.array, counts.T.copy()), pa.array(failed), pa.array(kept), pa.array(chance)],
                names=[*keep, *COUNTS, "base_failed", "kept", "chance"],
            )

    kinds = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in keep)
    return documents.select(*keep, F.col(text).alias("whole_text")).mapInArrow(
        judge,
        f"{kinds}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean, chance double",
    )
