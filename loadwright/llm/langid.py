"""Language identification from character n-grams.

Text is lower-cased and every run of other characters than letters becomes one
space; hashed character 1- to 3-grams of the whole text get TF-IDF weights
(sublinear counts, unit length).  Document frequencies cover every training
document.  A sparse multinomial logistic regression is trained with
FTRL-proximal (elastic net: ``L1`` and ``L2``) on a bounded, documented sample
of ``FIT_ROWS`` distinct labelled rows per language: each round, every partition of the
sample runs FTRL from the shared state and the states are averaged, so only
states of fixed size reach the driver.  A temperature, chosen on sample rows
that were held back from the fit, calibrates the probabilities.

Only the text and the label of training documents are used; a prediction sees
the text alone.

Defined results: a null text or one without letters is ``und`` with score 0; so
is every text if there is no labelled training row; rows without ``doc_id`` are
predicted, count as not held out and are not learned from; repeated rows are
predicted each; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwright.llm.common import key_counts, key_hash, map_batches, sample_cut, sampled, settle

DIMS = 1 << 15
FIT_ROWS = 1500
ROUNDS = 3
PARTS = 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-3, 1e-4
TEMPERATURES = np.geomspace(0.05, 5.0, 41)
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Is the code point a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, count=0x110000)


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, counts) of a whole text; empty where it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0)
    codes = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of other characters after a letter stays as a space
    codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint32)
    mix = np.uint32(2654435761)
    total = np.zeros(DIMS, np.int64)
    gram = codes * mix
    for order in range(3):
        if order:
            gram = (gram[:-1] ^ (gram[:-1] >> np.uint32(13))) * np.uint32(1540483477) + codes[order:] * mix
        total += np.bincount((gram * np.uint32(2246822519)) >> np.uint32(17), minlength=DIMS)
    found = np.flatnonzero(total)
    return found, total[found].astype(float)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIMS x languages
    temperature: float = 1.0

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        at, n = ngram_counts(text)
        x = (1 + np.log(n)) * self.idf[at]
        return at, x / max(np.sqrt((x * x).sum()), 1e-12)

    def predict(self, text: str | None) -> tuple[str, float]:
        at, x = self.vector(text)
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        z = x @ self.weights[at] / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(min(p[best], 1.0))


def ftrl_weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that FTRL-proximal holds for its state."""
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def ftrl_row(z: np.ndarray, n: np.ndarray, at: np.ndarray, x: np.ndarray, label: int) -> None:
    """One row's update of the state, in place."""
    zi, ni = z[at], n[at]
    w = ftrl_weights(zi, ni)
    s = x @ w
    p = np.exp(s - s.max())
    p /= p.sum()
    p[label] -= 1
    g = x[:, None] * p[None, :]
    more = ni + g * g
    z[at] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / ALPHA * w
    n[at] = more


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """How many training texts hold each feature: one row per task and feature, summed by Spark."""

    def run(batches):
        seen, rows = np.zeros(DIMS, np.int64), 0
        for b in batches:
            for t in b.column(0).to_pylist():
                seen[ngram_counts(t)[0]] += 1
                rows += 1
        if rows:
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int32()), pa.array([rows, *seen[at]], pa.int64())], ["feature", "n"])

    out, rows = np.zeros(DIMS, np.int64), 0
    for r in map_batches(train, ["text"], "feature int, n long", run).groupBy("feature").agg(F.sum("n").alias("n")).collect():
        if r.feature < 0:
            rows = r.n
        else:
            out[r.feature] = r.n
    return out, rows


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> LanguageModel:
    train = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    key = ("doc_id", "text")
    sizes = {r.lang: r for r in train.groupBy("lang").agg(*key_counts(key, 31)).collect()}  # one row per language
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], np.zeros(DIMS), np.zeros((DIMS, 0)))
    seen, rows = _document_frequencies(train)
    model = LanguageModel(languages, np.log((rows + 1) / (seen + 1)) + 1e-3, np.zeros((DIMS, len(languages))))
    pick = F.lit(False)
    for lang in languages:
        pick = pick | ((F.col("lang") == lang) & sampled(key, sample_cut(sizes[lang].n, sizes[lang].least, fit_rows), 31))
    chosen = train.where(pick).dropDuplicates().repartition(PARTS, *key).sortWithinPartitions(key_hash(key, 31), "lang")
    sample = settle(_vectors(chosen, model), "language-sample").coalesce(PARTS)
    z = np.zeros((DIMS, len(languages)))
    n = np.zeros_like(z)
    for _ in range(ROUNDS):
        states = _round(sample, z, n)
        if not states:
            break
        z, n = (sum(s[i] for s in states) / len(states) for i in (0, 1))
    model.weights = ftrl_weights(z, n)
    model.temperature = _temperature(sample, model)
    return model


def _vectors(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """(at, x, label, check): feature vectors; a fifth of the rows are for calibration."""
    index = {x: i for i, x in enumerate(model.languages)}

    def run(batches):
        for b in batches:
            v = [model.vector(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([a.astype(np.int32) for a, _ in v], pa.list_(pa.int32())), pa.array([x for _, x in v], pa.list_(pa.float64())),
                pa.array([index[x] for x in b.column(1).to_pylist()], pa.int32()), b.column(2)], ["at", "x", "label", "check"])

    check = (F.pmod(F.xxhash64(F.lit(37), "doc_id", "text"), F.lit(5)) == 0).alias("check")
    return map_batches(rows, ["text", "lang", check], "at array<int>, x array<double>, label int, check boolean", run)


def _round(sample: DataFrame, z: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """FTRL over each partition of the fitting rows, from the same state."""

    def run(batches):
        mine, rows = (z.copy(), n.copy()), 0
        for b in batches:
            for at, x, label in zip(*(b.column(i).to_pylist() for i in range(3))):
                if at:
                    ftrl_row(*mine, np.array(at), np.array(x), label)
                    rows += 1
        if rows:
            yield pa.RecordBatch.from_pydict({"z": [mine[0].tobytes()], "n": [mine[1].tobytes()]})

    got = map_batches(sample.where("NOT check"), ["at", "x", "label"], "z binary, n binary", run).collect()
    states = sorted((r.z, r.n) for r in got)  # sums in a repeatable order
    return [tuple(np.frombuffer(s).reshape(z.shape) for s in state) for state in states]


def _temperature(sample: DataFrame, model: LanguageModel) -> float:
    """The temperature of least log loss on the rows held back."""
    weights = model.weights

    def run(batches):
        loss = np.zeros(len(TEMPERATURES))
        for b in batches:
            for at, x, label in zip(*(b.column(i).to_pylist() for i in range(3))):
                if at:
                    s = (np.array(x) @ weights[np.array(at)])[None, :] / TEMPERATURES[:, None]
                    s -= s.max(axis=1, keepdims=True)
                    loss += np.log(np.exp(s).sum(axis=1)) - s[:, label]
        yield pa.RecordBatch.from_pydict({"loss": [loss.tobytes()]})

    losses = [np.frombuffer(r.loss) for r in map_batches(sample.where("check"), ["at", "x", "label"], "loss binary", run).collect()]
    total = sum(losses, np.zeros(len(TEMPERATURES)))
    return float(TEMPERATURES[int(total.argmin())]) if total.any() else 1.0


def identify(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``."""
    model = fit(docs, fit_rows)

    def run(batches):
        for b in batches:
            found = [model.predict(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text"],
                       "doc_id long, held_out boolean, lang_pred string, score double", run)
