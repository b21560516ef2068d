"""Language identification by sparse multinomial logistic regression (operator 1).

Features are TF-IDF weights of hashed character n-grams: the share of a text's n-grams of each length that
fall into a slot, times the slot's inverse document frequency over all training documents. Weights come from
follow-the-regularised-leader with elastic-net penalties, so most are exactly zero; a temperature fitted on
rows kept out of training turns scores into calibrated probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.shared import fresh

#: Lengths of n-grams and slots they are hashed to.
ORDERS, SLOTS = (1, 2, 3), 1 << 16
#: Bound of the fit: about so many rows of each language, one in five of them for the temperature.
ROWS_PER_LANGUAGE, EPOCHS = 400, 4
#: FTRL's step and penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
#: Scale of the features, which are shares of a whole.
SCALE = 10.0


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def slots(text: str) -> Iterator[np.ndarray]:
    """Slots of the n-grams of each order in lower-cased text, one array per order."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4").astype("u8")
    for n in ORDERS:
        if len(points) < n:
            return
        mixed = np.full(len(points) - n + 1, n, "u8")
        for i in range(n):
            mixed = (mixed + points[i : i + len(mixed)]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        yield ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype("i8") % SLOTS


def shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The slots a text fills, and their shares summed over the orders."""
    total = np.zeros(SLOTS)
    for found in slots(text):
        total += np.bincount(found, minlength=SLOTS) / len(found)
    filled = np.flatnonzero(total)
    return filled, total[filled]


@dataclass
class LanguageModel:
    """Languages, and a row of scores for each slot (inverse document frequency and temperature within)."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its probability; `und` and 0 without a letter or without a model."""
        if not self.languages or not has_letter(text):
            return "und", 0.0
        scores = self.bias.copy()
        for found in slots(text):
            scores += np.bincount(found, minlength=SLOTS) @ self.weights / len(found)
        scores -= scores.max()
        chances = np.exp(scores)
        best = int(np.argmax(chances))
        return self.languages[best], float(chances[best] / chances.sum())


def fit(rows: DataFrame) -> LanguageModel:
    """Learns from `text` and `lang` of rows that have both; other columns are not read.

    Document frequencies count all of the rows. Weights are learned from about ROWS_PER_LANGUAGE rows of each
    language, those whose hashed texts come first. Rows without a letter teach nothing. No rows, no languages:
    every prediction is then `und`.
    """
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, languages, n = np.zeros(SLOTS, "i8"), {}, 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                text, lang = text.as_py(), lang.as_py()
                if not has_letter(text):
                    continue
                n += 1
                languages[lang] = languages.get(lang, 0) + 1
                seen = np.zeros(SLOTS, bool)
                for found in slots(text):
                    seen[found] = True
                total += seen
        filled = np.flatnonzero(total)
        slot = [*filled.tolist(), *[-1] * len(languages)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot, pa.int32()), pa.array([*[None] * len(filled), *languages], pa.string()), pa.array([*total[filled].tolist(), *languages.values()], pa.int64())],
            ["slot", "lang", "n"],
        )

    # one row for each slot and each language
    totals = rows.mapInArrow(counted, "slot int, lang string, n bigint").groupBy("slot", "lang").agg(F.sum("n").alias("n")).collect()
    languages = sorted(row.lang for row in totals if row.slot < 0)
    of_language = {row.lang: row.n for row in totals if row.slot < 0}
    documents = sum(of_language.values())
    if not languages:
        return LanguageModel([], np.zeros((SLOTS, 0)), np.zeros(0))
    frequency = np.zeros(SLOTS)
    for row in totals:
        if row.slot >= 0:
            frequency[row.slot] = row.n
    idf = np.log((1 + documents) / (1 + frequency)) + 1

    share = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, ROWS_PER_LANGUAGE / of_language[lang]))])
    chance = F.pmod(F.xxhash64("text", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    chosen = rows.where(chance < share[F.col("lang")]).select("lang", chance.alias("chance"), _filled(F.col("text")).alias("f")).where("f IS NOT NULL")
    sample = sorted(chosen.collect(), key=lambda row: (row.chance, row.lang, row.f.slots))  # a bounded sample, slots of each at most
    data = [(languages.index(r.lang), np.array(r.f.slots, "i8"), SCALE * idf[r.f.slots] * np.array(r.f.shares)) for r in sample]
    held = data[::5]
    learned = [row for i, row in enumerate(data) if i % 5] or data
    weights, bias = follow_the_leader(learned, len(languages))
    heat = temperature([(y, bias + x @ weights[s]) for y, s, x in held])
    return LanguageModel(languages, SCALE * idf[:, None] * weights / heat, bias / heat)


def _filled(text: Column) -> Column:
    @F.arrow_udf("slots array<int>, shares array<double>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = []
            for text in batch.to_pylist():
                pair = shares(text) if has_letter(text) else None
                rows.append(pair and {"slots": pair[0].tolist(), "shares": pair[1].tolist()})
            yield pa.array(rows, pa.struct([("slots", pa.list_(pa.int32())), ("shares", pa.list_(pa.float64()))]))

    return found(text)


def follow_the_leader(rows: list[tuple[int, np.ndarray, np.ndarray]], languages: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net over rows of (language, slots, values); the bias is not penalised."""
    z, n = np.zeros((SLOTS + 1, languages)), np.zeros((SLOTS + 1, languages))
    l1, l2 = np.full(SLOTS + 1, L1), np.full(SLOTS + 1, L2)
    l1[SLOTS] = 0

    def weights(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at, None], 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + l2[at, None])

    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)).tolist():
            y, at, x = rows[i]
            at, x = np.append(at, SLOTS), np.append(x, 1.0)
            w = weights(at)
            scores = x @ w
            chances = np.exp(scores - scores.max())
            chances /= chances.sum()
            chances[y] -= 1
            g = x[:, None] * chances
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    final = weights(np.arange(SLOTS + 1))
    return final[:SLOTS], final[SLOTS]


def temperature(rows: list[tuple[int, np.ndarray]]) -> float:
    """The divisor of scores at which held-out rows are likeliest, found by golden-section search."""
    if not rows:
        return 1.0
    ys, scores = np.array([y for y, _ in rows]), np.array([s for _, s in rows])

    def loss(log_heat: float) -> float:
        s = scores / math.exp(log_heat)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(ys)), ys]))

    low, high, ratio = math.log(0.05), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def predict(text: Column, model: LanguageModel) -> Column:
    """A struct of lang_pred and score for each text."""

    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [model.predict(row.as_py()) for row in batch]
            yield pa.StructArray.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang_pred", "score"]
            )

    return predicted(text)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves remainder 2 by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_identified(documents: DataFrame, least: float = 0.6) -> DataFrame:
    """The rows of `documents` whose language is known with a score of `least` or more, columns unchanged.

    Learns from the rows that are not held out. Null texts and texts without a letter go. Each row is judged
    alone, so repeated rows, null ids and further columns change nothing.
    """
    model = fit(documents.where(~held_out(F.col("doc_id"))))
    name = fresh(documents.columns, "language")
    return documents.withColumn(name, predict(F.col("text"), model)).where((F.col(name)["lang_pred"] != "und") & (F.col(name)["score"] >= least)).drop(name)
