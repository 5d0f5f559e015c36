"""Language identification (operator 1).

A sparse multinomial logistic regression over TF-IDF weighted character
n-grams, trained with follow-the-regularised-leader (per-coordinate steps,
elastic-net penalty) and calibrated with one temperature.

* Text becomes lower-cased code points, where every run of characters that
  are not letters counts as one space.  Its 1- to 3-grams are hashed to
  ``FEATURES`` buckets.
* Document frequencies cover all labelled training documents.
* The regression is fitted on a sample of about ``SAMPLE_ROWS`` training
  documents, the same number per language as far as there are so many (a
  documented bound: a row is drawn by the hash of its id and text, and rows
  equal in both are drawn as one).  ``SHARDS`` tasks train on a share each and
  their weights are averaged.  One row in ``CALIBRATE_ONE_IN`` of the sample is
  kept from training and sets the temperature, with one pseudo-count against
  the label, so that rows without an error have a best temperature too.
* A block of code points is known if one in ``KNOWN_ONE_IN`` labelled training
  documents of some language has letters of it.  The score is the calibrated
  probability times the share of the text's letters in known blocks: hashed
  grams of a script that was never learned say nothing.
* Prediction reads the whole text and nothing else.

Defined cases: a null text or one without a letter gives ``und`` with score
0, as does every text if nothing could be learned; a text without a known
letter gets the likeliest language with score 0; rows with a null label are
predicted but never learned from; repeated rows count as often as they occur,
but once in the sample; null ids are drawn by their texts; an only language has
temperature 1; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .common import drop_stage, release_memory, stage

FEATURES = 1 << 16
SAMPLE_ROWS = 6_000
SHARDS = 4
EPOCHS = 2
CALIBRATE_ONE_IN = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
#: Blocks of 2 ** BLOCK_BITS code points are known from one in KNOWN_ONE_IN documents of a language.
BLOCK_BITS, KNOWN_ONE_IN = 7, 100
BLOCKS = 0x110000 >> BLOCK_BITS
#: The logarithms of the temperature that are searched.
LOG_TEMPERATURE = 8.0
UNDETERMINED = "und"
#: The least score with which a filter takes a text as written in a learned language.  A text torn between two
#: learned languages stays; one torn among more, or with under a third of its letters in known blocks, goes.
MIN_SCORE = 1 / 3


def _points(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of a text, and which of them are letters."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    ascii_letter = (x - 97 < 26)
    letter = ascii_letter | (x >= 170)
    if not ascii_letter.all() and (x >= 170).any():  # other letters and signs beyond ASCII, by their class
        other = np.unique(x[x >= 170])
        signs = [c for c in other if not chr(c).isalpha()]
        if signs:
            letter &= ~np.isin(x, signs)
    return x, letter


def _blocks(text: str) -> np.ndarray:
    """The block of each letter."""
    x, letter = _points(text)
    return x[letter] >> BLOCK_BITS


def _grams(text: str) -> np.ndarray:
    """Feature buckets of all 1- to 3-grams of a text, repeats included."""
    x, letter = _points(text)
    x = np.where(letter, x, 32).astype(np.uint64)
    x = np.concatenate(([32], x, [32])).astype(np.uint64)
    x = x[np.concatenate(([True], (x[1:] != 32) | (x[:-1] != 32)))]
    one = x * np.uint64(0x9E3779B97F4A7C15)
    two = (x[:-1] << np.uint64(21) | x[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    three = (x[:-2] << np.uint64(42) | x[1:-1] << np.uint64(21) | x[2:]) * np.uint64(0x165667B19E3779F9)
    shift = np.uint64(64 - FEATURES.bit_length() + 1)
    return (np.concatenate((one, two, three)) >> shift).astype(np.int64)


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    grams = _grams(text)
    if len(grams) < 3000:
        return np.unique(grams, return_counts=True)
    n = np.bincount(grams, minlength=FEATURES)
    at = np.flatnonzero(n)
    return at, n[at]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@F.pandas_udf(BooleanType())
def with_letter(texts: pd.Series) -> pd.Series:
    return pd.Series([has_letter(t) for t in texts], dtype=bool)


def _vector(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(n)) * idf[at]
    return x / max(np.sqrt(x @ x), 1e-12)


@dataclass(frozen=True)
class LanguageModel:
    """Learned values, inverse document frequencies, weights, temperature, known blocks (None: all)."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # (features, languages)
    bias: np.ndarray
    temperature: float
    known: np.ndarray | None = None

    def familiar(self, text: str) -> float:
        """The share of a text's letters in known blocks."""
        if self.known is None or (self.known[0] and text.isascii()):
            return 1.0
        blocks = _blocks(text)
        return float(self.known[blocks].mean()) if len(blocks) else 0.0

    def logits(self, text: str) -> np.ndarray:
        at, n = _counts(text)
        return _vector(at, n, self.idf) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        z = self.logits(text) / self.temperature
        p = np.exp(z - z.max())
        best = int(np.argmax(p))
        return self.languages[best], float(p[best] / p.sum()) * self.familiar(text)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader with per-coordinate steps.

    ``rows``: feature positions, values, class.  Returns weights and biases;
    the elastic net keeps a weight at zero until its summed gradient exceeds
    ``L1`` and shrinks it by ``L2``.  The bias is not penalised.
    """
    z, s = np.zeros((FEATURES + 1, classes)), np.zeros((FEATURES + 1, classes))
    l1 = np.full((FEATURES + 1, 1), L1)
    l1[-1] = 0

    def leader(at):
        zs = z[at]
        step = (BETA + np.sqrt(s[at])) / ALPHA + L2
        return np.where(np.abs(zs) <= l1[at], 0.0, -(zs - np.sign(zs) * l1[at]) / step)

    for _ in range(epochs):
        for at, x, label in rows:
            at, x = np.append(at, FEATURES), np.append(x, 1.0)
            w = leader(at)
            logit = x @ w
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[label] -= 1
            g = x[:, None] * p
            before = s[at]
            z[at] += g - (np.sqrt(before + g * g) - np.sqrt(before)) / ALPHA * w
            s[at] = before + g * g
    w = leader(np.arange(FEATURES + 1))
    return w[:-1], w[-1]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> LanguageModel:
    """Learn from all given rows with a text and a label."""
    spark = docs.sparkSession
    rows = docs.select(
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("draw"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("string").alias("label")
    ).where("text IS NOT NULL AND label IS NOT NULL")

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, labels, blocks = np.zeros(FEATURES, np.int64), {}, {}
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                if has_letter(text):
                    labels[label] = labels.get(label, 0) + 1
                    for block in (0,) if text.isascii() else np.unique(_blocks(text)).tolist():
                        blocks[label, block] = blocks.get((label, block), 0) + 1
                    df[np.unique(_grams(text)) if len(text) < 1000 else _counts(text)[0]] += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({
            "label": pd.Series([None] * len(at) + list(labels) + [label for label, _ in blocks], dtype=object),
            "feature": [*at.tolist(), *[-1] * len(labels), *(-2 - block for _, block in blocks)],
            "n": [*df[at].tolist(), *labels.values(), *blocks.values()],
        })

    counted = rows.select("text", "label").mapInPandas(frequencies, "label string, feature int, n long").groupBy("label", "feature").agg(F.sum("n").alias("n")).toPandas()
    sizes = counted[counted.feature == -1].set_index("label")["n"].to_dict()
    languages = tuple(sorted(sizes))
    total = sum(sizes.values())
    idf = np.zeros(FEATURES)
    seen = counted[counted.feature >= 0]
    idf[seen.feature.to_numpy(np.int64)] = np.log((1 + total) / (1 + seen.n.to_numpy(float))) + 1
    if not languages:
        return LanguageModel((), idf, np.zeros((FEATURES, 0)), np.zeros(0), 1.0)

    known, block = np.zeros(BLOCKS, bool), counted[counted.feature < -1]
    often = block.n.to_numpy() * KNOWN_ONE_IN >= block.label.map(sizes).to_numpy()
    known[-2 - block.feature.to_numpy(np.int64)[often]] = True

    share = SAMPLE_ROWS / len(languages)
    most = (1 << 32) - 1
    keep = F.create_map(*[F.lit(x) for k in languages for x in (k, min(most, int(most * share / sizes[k])))])
    drawn = rows.where(F.col("draw").bitwiseAND(F.lit(most)) <= F.try_element_at(keep, F.col("label")))
    drawn = drawn.groupBy("draw", "label").agg(F.first("text").alias("text"))  # equal rows, of null ids too, are one

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = {k: i for i, k in enumerate(languages)}
        for batch in batches:
            out = [(draw, code[label], *_counts(text)) for draw, text, label in zip(batch["draw"], batch["text"], batch["label"], strict=True) if has_letter(text)]
            yield pd.DataFrame(
                [(d, c, at.astype("<i4").tobytes(), _vector(at, n, idf).astype("<f4").tobytes()) for d, c, at, n in out], columns=["draw", "label", "at", "x"]
            )

    features, path = stage(drawn.mapInPandas(featurise, "draw long, label int, at binary, x binary"), "language-sample")
    part = F.pmod(F.shiftright("draw", 32), F.lit(CALIBRATE_ONE_IN))

    def decode(frame: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, int]]:
        frame = frame.sort_values("draw")
        return [(np.frombuffer(a, "<i4"), np.frombuffer(x, "<f4").astype(float), int(c)) for a, x, c in zip(frame["at"], frame["x"], frame["label"], strict=True)]

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        w, b = ftrl(decode(frame), len(languages))
        at, c = np.nonzero(w)
        return pd.DataFrame({"feature": [*at, *[-1] * len(b)], "label": [*c, *range(len(b))], "w": [*w[at, c], *b]})

    fitted = (
        features.where(part != 0).withColumn("shard", F.pmod(F.shiftright("draw", 40), F.lit(SHARDS)))
        .groupBy("shard").applyInPandas(fit, "feature int, label int, w double")
    )
    shards = features.where(part != 0).select(F.pmod(F.shiftright("draw", 40), F.lit(SHARDS))).distinct().count()
    averaged = fitted.groupBy("feature", "label").agg(F.sum("w").alias("w")).toPandas()
    weights, bias = np.zeros((FEATURES, len(languages))), np.zeros(len(languages))
    inner = averaged[averaged.feature >= 0]
    weights[inner.feature, inner.label] = inner.w / max(1, shards)
    outer = averaged[averaged.feature < 0]
    bias[outer.label] = outer.w / max(1, shards)
    held = decode(features.where(part == 0).toPandas())  # at most about SAMPLE_ROWS / CALIBRATE_ONE_IN rows
    drop_stage(spark, path)
    return LanguageModel(languages, idf, weights, bias, calibrate([x @ weights[at] + bias for at, x, _ in held], [c for *_, c in held]), known)


def calibration_loss(z: np.ndarray, y: np.ndarray, temperature: float) -> float:
    """Mean cross-entropy of logits over a temperature, one pseudo-count of a wrong label in ``len(y) + 2``.

    Convex in the inverse temperature, so a search by halves finds the least.
    """
    s = z / temperature
    s = s - s.max(axis=1, keepdims=True)
    right, wrong = s[np.arange(len(y)), y], 1 / (len(y) + 2)
    others = (s.sum(axis=1) - right) / (z.shape[1] - 1)
    return float((np.log(np.exp(s).sum(axis=1)) - (1 - wrong) * right - wrong * others).mean())


def calibrate(logits: list[np.ndarray], labels: list[int]) -> float:
    """The temperature with the least ``calibration_loss`` (golden section on its logarithm).

    1 if there are no rows, one class or equal logits only.  A best value at
    the bound of the search (logits that go against the labels) is reported as
    a warning.
    """
    z, y = np.array(logits), np.array(labels)
    if not len(y) or z.shape[1] < 2 or not np.ptp(z, axis=1).any():
        return 1.0
    lo, hi, g = -LOG_TEMPERATURE, LOG_TEMPERATURE, (5 ** 0.5 - 1) / 2
    while hi - lo > 1e-3:
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if calibration_loss(z, y, np.exp(a)) <= calibration_loss(z, y, np.exp(b)) else (a, hi)
    if min(lo + LOG_TEMPERATURE, LOG_TEMPERATURE - hi) < 1e-2:
        warnings.warn("the temperature of the language scores lies at the bound of its search", stacklevel=2)
    return float(np.exp((lo + hi) / 2))


def predictor(docs: DataFrame, model: LanguageModel):
    """A column function: text -> struct(lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x languages numbers

    @F.pandas_udf(StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"])
        release_memory()

    return predict


def held_out(id_col: str = "doc_id") -> Column:
    """Rows never learned from: CRC-32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_on_documents(docs: DataFrame) -> LanguageModel:
    """The documents table's fold: every labelled row that isn't held out."""
    return train(docs.where(~held_out()))
