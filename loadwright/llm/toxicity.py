"""Toxicity as an ordered grade: cumulative-link (proportional odds) regression.

Grades come from the labels and the model's vocabulary: 0 not toxic, 1 toxic,
2 toxic with more distinct toxic words than the median toxic document has.
``P(grade <= k) = sigmoid(theta_k - w.x)``: all thresholds share the weights
``w`` over sparse word features (a word occurs in the text or not).

The model is fitted on a bounded, documented sample of labelled documents
(``FIT_ROWS``, and of either class ``CLASS_ROWS`` if it has as many; of rows
that share an id one text).  Its vocabulary is the words whose share among toxic rows
most exceeds that among the others (two-proportion z at least ``MIN_Z``,
``VOCABULARY`` words at most).  Each Fisher-scoring step is a Spark job that
sums gradient and information over the sample; only sums of that fixed size
reach the driver.  Scoring reads every whole text.

Defined results: a null or empty text has no word, and so the model's base
rate; labels that repeat count once per document (toxic if any is); null labels and null ids are left out of the fit; without both
classes in the labels nothing is toxic (severity 0); repeated documents are
scored each; empty tables give empty results.  Where no word is in ``MIN_DOCS`` labelled
documents and reaches ``MIN_Z`` (too few toxic labels, or labels that no word
explains) the vocabulary is empty and nothing is toxic.  Extra columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwright.llm.common import keep_threshold, key_hash, map_batches, map_rows, sample_cut, sampled, settle

FIT_ROWS = 20_000
CLASS_ROWS = 200
VOCABULARY = 256
MIN_DOCS = 5
MIN_Z = 5.0
RIDGE = 0.02
STEPS = 25
GRADES = 3
#: A document is toxic if P(grade >= 1) reaches this.
REJECT_AT = 0.5

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return _WORD.findall((text or "").lower())


@dataclass
class OrdinalModel:
    vocabulary: list[str]
    weights: np.ndarray     # one per word, shared by all thresholds
    thresholds: np.ndarray  # ascending, GRADES - 1

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every score (rows) and threshold (columns)."""
        z = np.clip(score[:, None] - self.thresholds[None, :], -500, 500)
        return 1 / (1 + np.exp(-z))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(distinct words, toxic) of about ``rows`` labelled documents at most."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("id")).agg(
        (F.max("toxic") > 0).cast("int").alias("tox"))
    sizes = known.groupBy("tox").agg(F.count(F.lit(1)).alias("n"), F.min(key_hash(("id",), 11)).alias("least")).collect()
    cut = keep_threshold(sum(r.n for r in sizes), rows)
    pick = F.lit(False)
    for r in sizes:
        pick = pick | ((F.col("tox") == r.tox) & sampled(("id",), max(cut, sample_cut(r.n, r.least, min(CLASS_ROWS, rows))), 11))
    known = known.where(pick)
    texts = docs.select("doc_id", "text")
    rows = texts.join(known, texts["doc_id"] == known["id"]).groupBy("id", "tox").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def run(batches):
        for b in batches:
            words = [list(dict.fromkeys(words_of(t))) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), b.column(1)], ["words", "tox"])

    return map_batches(rows, ["text", "tox"], "words array<string>, tox int", run)


def _vocabulary(sample: DataFrame) -> list[str]:
    """The words that tell toxic rows from others; the statistics cover the whole sample."""
    n, n_tox = sample.agg(F.count(F.lit(1)), F.sum("tox")).first()
    n_tox = n_tox or 0
    if not 0 < n_tox < n:
        return []
    words = sample.select(F.explode("words").alias("word"), "tox")
    seen = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("tox").alias("t")).where(F.col("n") >= MIN_DOCS)
    p = F.col("n") / n
    z = (F.col("t") / n_tox - (F.col("n") - F.col("t")) / (n - n_tox)) / F.sqrt(p * (1 - p) * (1 / n_tox + 1 / (n - n_tox)) + 1e-12)
    best = seen.select("word", z.alias("z")).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "word").limit(VOCABULARY)
    return sorted(r.word for r in best.collect())


def _likelihood(x: np.ndarray, y: np.ndarray, model: OrdinalModel):
    """Log-likelihood, gradient and expected information of weights, then thresholds."""
    k, v = len(model.thresholds), x.shape[1]
    up = model.above(x @ model.weights)                         # P(y > j)
    edge = np.hstack([np.ones((len(x), 1)), up, np.zeros((len(x), 1))])
    p = np.clip(edge[:, :-1] - edge[:, 1:], 1e-12, None)        # P(y = j)
    slope = edge * (1 - edge)                                   # of edge by the score
    rows = np.arange(len(x))
    dp = np.zeros((len(x), k + 1, v + k))                       # of P(y = j) by each parameter
    dp[:, :, :v] = (slope[:, :-1] - slope[:, 1:])[:, :, None] * x[:, None, :]
    for j in range(k):                                          # theta_j lowers edge j + 1
        dp[:, j, v + j] += slope[:, j + 1]
        dp[:, j + 1, v + j] -= slope[:, j + 1]
    grad = (dp[rows, y] / p[rows, y][:, None]).sum(axis=0)
    scaled = dp / np.sqrt(p)[:, :, None]
    flat = scaled.reshape(-1, v + k)
    return float(np.log(p[rows, y]).sum()), grad, flat.T @ flat


def _sums(features: DataFrame, model: OrdinalModel):
    """One job: the sums of ``_likelihood`` over all rows."""
    v = len(model.vocabulary)

    def run(batches):
        total = None
        for b in batches:
            grades = b.column(1).to_numpy(zero_copy_only=False)
            lists = b.column(0).to_pylist()
            for at in range(0, len(lists), 256):
                x = np.zeros((len(lists[at:at + 256]), v))
                for i, words in enumerate(lists[at:at + 256]):
                    x[i, words] = 1
                part = _likelihood(x, grades[at:at + 256], model)
                total = part if total is None else tuple(a + c for a, c in zip(total, part))
        if total is not None:
            yield pa.RecordBatch.from_pydict({"ll": [total[0]], "grad": [total[1].tobytes()], "info": [total[2].tobytes()]})

    rows = map_batches(features, ["words", "grade"], "ll double, grad binary, info binary", run).collect()
    size = v + len(model.thresholds)
    ll = sum(r.ll for r in rows)
    grad = sum((np.frombuffer(r.grad) for r in rows), np.zeros(size))
    return ll, grad, sum((np.frombuffer(r.info).reshape(size, size) for r in rows), np.zeros((size, size)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> OrdinalModel | None:
    """The fitted model; None where the labels don't hold both classes."""
    sample = settle(labelled_sample(docs, labels, rows), "toxicity-sample")
    words = _vocabulary(sample)
    if not words:
        return None
    index = {w: i for i, w in enumerate(words)}
    place = F.udf(lambda ws: sorted(index[w] for w in ws if w in index), "array<int>")
    marked = sample.select(place("words").alias("words"), "tox")
    many = marked.where("tox = 1 AND size(words) > 0").agg(F.percentile(F.size("words"), 0.5)).first()[0] or 0
    grade = F.when(F.col("tox") == 0, 0).when(F.size("words") > F.lit(many), 2).otherwise(1)
    features = settle(marked.select("words", grade.cast("int").alias("grade")), "toxicity-features")
    counts = {r.grade: r["count"] for r in features.groupBy("grade").count().collect()}
    n = sum(counts.values())
    share = [(sum(c for g, c in counts.items() if g <= j) + 0.5) / (n + 1) for j in range(GRADES - 1)]
    start = np.log(np.array(share) / (1 - np.array(share))) + np.arange(GRADES - 1) * 1e-3
    model = OrdinalModel(words, np.zeros(len(words)), start)
    ll, grad, info = _sums(features, model)
    v = len(words)
    ridge = np.concatenate([np.full(v, RIDGE), np.full(GRADES - 1, 1e-6)])
    for _ in range(STEPS):
        at = np.concatenate([model.weights, np.zeros(GRADES - 1)])
        step = np.linalg.solve(info + np.diag(ridge), grad - ridge * at)
        value = ll - 0.5 * RIDGE * (model.weights ** 2).sum()
        for half in range(8):
            s = step / 2 ** half
            new = OrdinalModel(words, model.weights + s[:v], model.thresholds + s[v:])
            if (np.diff(new.thresholds) <= 0).any():
                continue
            sums = _sums(features, new)
            gain = sums[0] - 0.5 * RIDGE * (new.weights ** 2).sum() - value
            if gain >= 0:
                break
        else:
            break
        model, (ll, grad, info) = new, sums
        if gain < 0.01:
            break
    return model


def _scorer(model: OrdinalModel):
    weight = dict(zip(model.vocabulary, model.weights.tolist()))
    vocab = frozenset(weight)

    def above(texts: list) -> np.ndarray:
        hits = (vocab.intersection(words_of(t)) for t in texts)
        return model.above(np.array([sum(weight[w] for w in sorted(h)) for h in hits], float))

    return above


def severity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, severity, p_toxic, grade, toxic) for every row of ``docs``.

    ``severity`` is the expected grade, ``grade`` the likeliest one.
    """
    model = fit(docs, labels, rows)
    if model is None:
        none = F.lit(0.0)
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), none.alias("severity"), none.alias("p_toxic"),
                           F.lit(0).alias("grade"), F.lit(False).alias("toxic"))
    above = _scorer(model)

    def run(batches):
        for b in batches:
            up = above(b.column(1).to_pylist())
            p = np.hstack([1 - up[:, :1], -np.diff(up, axis=1), up[:, -1:]])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(up.sum(axis=1)), pa.array(up[:, 0]), pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(up[:, 0] >= REJECT_AT)],
                ["doc_id", "severity", "p_toxic", "grade", "toxic"])

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), "text"],
                       "doc_id long, severity double, p_toxic double, grade int, toxic boolean", run)


def keep_clean(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``docs``, all columns, without the rows that the model holds to be toxic."""
    model = fit(docs, labels, rows)
    if model is None:
        return docs
    above = _scorer(model)
    text = docs.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(above(b.column(text).to_pylist())[:, 0] < REJECT_AT))

    return map_rows(docs, run)
