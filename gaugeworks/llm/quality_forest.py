"""Quality rules with an isolation forest over rule statistics (operator 9).

Each text gives exact counts (words, symbols, repeated lines, words in repeated windows) and ratios made of
them. Random trees over the ratios isolate unusual documents after few splits; the mean path length is
compared with a threshold calibrated on labelled rows. Two plain rules come before the forest.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.shared import fresh, row_key, saved

#: White space between words, symbols that are counted.
ASCII_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window; base rules: least words, most per cent of words in repeated windows.
WINDOW, LEAST_WORDS, REPEAT_PERCENT = 8, 20, 30
#: Trees, rows that each is grown on, and labelled rows they are drawn from (a bound of the fit).
TREES, ROWS_PER_TREE, FIT_ROWS = 200, 256, 4096
#: Most labelled good rows, of a thousand, that the threshold may reject, one row beside.
GOOD_LOST = 3
#: A feature is split on if good and bad rows of the fit differ so much in it (Kolmogorov-Smirnov distance).
LEAST_GAP = 0.15

STATISTICS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, features array<double>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number = dict(zip(dict.fromkeys(words), itertools.count()))
    ids = np.fromiter(map(number.__getitem__, words), "i8", len(words))
    mixed = np.zeros(n, "u8")
    for i in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + ids[i : i + n].astype("u8")
    if len(np.unique(mixed)) == n:
        return 0
    length = 1
    while length < window:  # exact: windows of twice the length are pairs of numbered windows
        step = min(length, window - length)
        size = len(ids) - step
        _, ids = np.unique(ids[:size] * (len(words) + 1) + ids[step:], return_inverse=True)
        length += step
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, "i8")
    edges[:n] += again
    edges[window:] -= again
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def statistics(text: str | None) -> tuple:
    """The counts of COUNTS and the forest's features; a null text counts as empty."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    letters = len(text) - sum(map(text.count, ASCII_SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(ASCII_SPACE)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    upper = sum(map(str.isupper, text)) if n else 0
    alpha = sum(map(str.isalpha, text)) if n else 0
    alnum = sum(map(str.isalnum, text)) if n else 0
    features = [  # ratios; the constants draw those of short texts to what is usual
        min(symbols / (n + 5), 2.0),
        dup_lines / (len(lines) + 2),
        repeats / (n + 20),
        upper / (alpha + 50),
        (letters - alnum) / (letters + 30),
    ]
    return n, letters, symbols, dup_lines, repeats, features


def rule_statistics(text: Column) -> Column:
    """A struct of STATISTICS for each text."""

    @F.arrow_udf(STATISTICS)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            *counts, features = zip(*(statistics(row.as_py()) for row in batch), strict=True) if len(batch) else [[]] * 6
            columns = [pa.array(c, pa.int64()) for c in counts] + [pa.array(features, pa.list_(pa.float64()))]
            yield pa.StructArray.from_arrays(columns, [*COUNTS, "features"])

    return found(text)


def expected_depth(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, "f8")
    safe = np.maximum(n, 2)
    return np.where(n < 2, 0.0, np.where(n == 2, 1.0, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe))


@dataclass
class Forest:
    """Trees as flat arrays: the feature a node asks for (-1: none), its threshold, its children, its depth."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    roots: np.ndarray
    rows: int

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Anomaly of each row, from 0 to 1; one half is usual."""
        total = np.zeros(len(features))
        at_row = np.arange(len(features))
        for root in self.roots.tolist():
            node = np.full(len(features), root)
            while True:
                asked = self.feature[node]
                if (asked < 0).all():
                    break
                goes_left = features[at_row, np.maximum(asked, 0)] < self.threshold[node]
                node = np.where(asked < 0, node, np.where(goes_left, self.left[node], self.right[node]))
            total += self.depth[node]
        return 2.0 ** (-total / len(self.roots) / max(1e-9, float(expected_depth(self.rows))))


def telling(features: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Features whose distributions among good and bad rows are at least LEAST_GAP apart somewhere."""
    gaps = []
    for values in features.T:
        levels = np.unique(values)
        below = [np.searchsorted(np.sort(values[rows]), levels, side="right") / max(1, rows.sum()) for rows in (bad, ~bad)]
        gaps.append(np.abs(below[0] - below[1]).max())
    found = np.flatnonzero(np.array(gaps) >= LEAST_GAP)
    return found if len(found) else np.arange(features.shape[1])


def grow(features: np.ndarray, usable: np.ndarray, trees: int = TREES, rows: int = ROWS_PER_TREE, seed: int = 11) -> Forest:
    """A forest over random subsets of the rows, random features among the usable and random split points."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(features))
    limit = max(1, math.ceil(math.log2(max(2, rows))))
    nodes: list[list[float]] = []

    def node(part: np.ndarray, depth: int) -> int:
        me = len(nodes)
        nodes.append([-1, 0.0, -1, -1, depth + float(expected_depth(len(part)))])
        spread = usable[np.ptp(part[:, usable], axis=0) > 0] if len(part) > 1 else []
        if depth < limit and len(spread):
            feature = int(rng.choice(spread))
            low, high = part[:, feature].min(), part[:, feature].max()
            threshold = float(rng.uniform(low, high))
            less = part[:, feature] < threshold
            if less.any() and not less.all():
                nodes[me][:4] = [feature, threshold, node(part[less], depth + 1), node(part[~less], depth + 1)]
        return me

    roots = [node(features[rng.choice(len(features), rows, replace=False)], 0) for _ in range(trees)]
    feature, threshold, left, right, depth = zip(*nodes, strict=True)
    return Forest(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(depth), np.array(roots), rows)


@dataclass
class QualityModel:
    """A forest and the anomaly above which a document is rejected; no forest rejects nothing."""

    forest: Forest | None
    threshold: float


def fit(documents: DataFrame, labels: DataFrame) -> QualityModel:
    """Grows the forest on labelled documents, whatever their label, and calibrates its threshold on the labels.

    Labelled rows are those of `documents` whose doc_id has one quality in `labels` (0 or 1); ids with
    several or null labels are left out. The forest is drawn from at most FIT_ROWS of them that pass the base
    rules, those whose hashed ids come first; it splits on features in which their labels differ. The threshold rejects the most bad rows less good ones among those that reject at
    most GOOD_LOST of a thousand good rows and one more, over all labelled rows. Without rows of either kind nothing more is rejected.
    """
    judged = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    judged = judged.where("quality = most").select("doc_id", "quality")
    texts = documents.where("doc_id IS NOT NULL")
    counted = texts.select("doc_id", row_key(F.col("text")).alias("key"), rule_statistics(F.col("text")).alias("s")).select("doc_id", "key", "s.*")
    rows = saved(counted.join(judged, "doc_id").withColumn("place", F.xxhash64("doc_id")), "labelled")  # no text is shuffled
    passed = rows.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    sample = passed.orderBy("place", "key").limit(FIT_ROWS).select("features", "quality").collect()
    if not sample or passed.agg(F.countDistinct("quality")).first()[0] < 2:
        return QualityModel(None, math.inf)
    features = np.array([row.features for row in sample])
    forest = grow(features, telling(features, np.array([row.quality == 0 for row in sample])))
    bins = passed.groupBy("quality", F.round(anomaly(F.col("features"), forest), 3).alias("score")).count().collect()  # 2,002 rows at most
    good = np.zeros(1002)
    bad = np.zeros(1002)
    for row in bins:
        (good if row.quality == 1 else bad)[round(row.score * 1000)] += row["count"]
    lost, caught = good[::-1].cumsum()[::-1], bad[::-1].cumsum()[::-1]
    allowed = np.flatnonzero(lost * 1000 <= GOOD_LOST * good.sum() + 1000)
    gain = caught[allowed] / max(1, bad.sum()) - lost[allowed] / good.sum()
    best = allowed[len(gain) - 1 - int(np.argmax(gain[::-1]))]
    return QualityModel(forest, (int(best) - 0.5) / 1000)


def anomaly(features: Column, forest: Forest) -> Column:
    """The forest's score of each row of features."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(forest.scores(np.array(batch.to_pylist(), "f8").reshape(len(batch), -1)), pa.float64())

    return scored(features)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > REPEAT_PERCENT * n_words)


def judge(documents: DataFrame, model: QualityModel, name: str) -> DataFrame:
    """`documents` with a struct column `name`: the counts, base_failed, anomaly and kept.

    Null and empty texts have no words and fail the base rules. Each row is judged alone, so repeated rows,
    null ids and further columns change nothing; `name` must not be a column.
    """
    raw, score = fresh([*documents.columns, name], "statistics"), fresh([*documents.columns, name], "anomaly")
    rows = documents.withColumn(raw, rule_statistics(F.col("text")))
    rows = rows.withColumn(score, anomaly(F.col(raw)["features"], model.forest) if model.forest else F.lit(0.0))
    failed = base_failed(F.col(raw)["n_words"], F.col(raw)["n_repeat_words"])
    verdict = F.struct(
        *[F.col(raw)[c].alias(c) for c in COUNTS],
        failed.alias("base_failed"),
        F.col(score).alias("anomaly"),
        (~failed & (F.round(F.col(score), 3) < model.threshold)).alias("kept"),
    )
    return rows.withColumn(name, verdict).drop(raw, score)


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `documents` that the rules and the forest keep, columns unchanged."""
    name = fresh(documents.columns, "verdict")
    return judge(documents, fit(documents, labels), name).where(F.col(name)["kept"]).drop(name)
