"""Quality rules with thresholds that adapt to language and source.

Each document gets counts over its whole text.  The counts' ratios go into KLL
quantile sketches, one per (language, source); sketches merge, so those of a
language and of the whole corpus are merged from them and no row is read again.

Every threshold is the median plus or minus a distance, and median and distance
are shrunk by size: those of a group of n rows weigh n, those of its language
``SHRINK`` (and so those of a language towards the corpus, and the corpus towards
``PRIOR``).  There is no group size at which the rule changes.  Two distances
that junk cannot widen are used:

* ``SPREAD`` times the distance from the median to the outer quantile, where
  that distance counts up to ``SKEW`` times the one on the median's other side:
  junk does not reach that side before it is half of the group;
* for counts that most documents do not have at all (symbols, repeated words):
  as many occurrences as a geometric law with the group's share of documents
  that have any exceeds with probability ``TAIL``, in a document of the group's
  median length.  Junk enters this only by its share, however large its counts.

A document shorter than its group's median gets the same number of occurrences,
and for word length a distance that widens with the error of a mean.  Joining
documents with thresholds gives the verdict.  What more than half of a group
holds is its normal level.

Defined results: a null or empty text has no words, fails the base rule and is
not kept; null languages and sources are groups of their own; repeated rows are
judged each; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
import operator
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwright.llm.common import map_batches, settle

WINDOW = 8
SKETCH_K = 400
SPREAD = 8.0
#: A side of the median is at most this many times as wide as the other side; what goes beyond is junk.
SKEW = 2.0
#: Rows that the figures of the larger group (language, corpus, prior) count as.
SHRINK = 30.0
#: Chance that a normal document has more occurrences than the limit.
TAIL = 1e-6
OUTER = 0.9
#: What is assumed of a corpus without any document: distance on either side, share of documents with any occurrence.
PRIOR = {"up": 0.3, "down": 0.3, "share": 0.1}
#: ratio: words that one occurrence counts as (a repeated window is seen twice); None for a ratio that every document has.
RATIOS = {"word_length": None, "symbols": 1, "repeats": 2 * WINDOW}

_SPACES = " \t\n\r\x0b\x0c"
_SYMBOLS = "#*$%&|<>"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeat_words(words: list, window: int = WINDOW) -> int:
    """Words inside some ``window`` of consecutive words that occurs twice or more."""
    if len(words) <= window:
        return 0
    number = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, count=len(words))
    size = 1
    while size < window:  # ids of runs: doubled, the last step overlaps
        step = min(size, window - size)
        _, ids = np.unique(ids[:-step] * (ids.max() + 1) + ids[step:], return_inverse=True)
        size += step
    twice = np.flatnonzero(np.bincount(ids)[ids] > 1)
    if not len(twice):
        return 0
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + window, -1)
    return int((np.cumsum(change) > 0).sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    return (len(words), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, counts) per row of ``docs``."""

    def run(batches):
        for b in batches:
            found = list(zip(*map(counts, b.column(3).to_pylist()))) or [()] * 5
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), *(pa.array(c, pa.int64()) for c in found)],
                                             ["doc_id", "lang", "source", *_COUNTS])

    text = [F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")]
    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), *text],
                       "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS), run)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _ratios() -> dict[str, Column]:
    n = F.greatest("n_words", F.lit(1))
    return {"word_length": F.col("word_chars") / n, "symbols": F.col("n_symbols") / n, "repeats": F.col("n_repeat_words") / n}


def _figures(level: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, words, and of each ratio its median, distances and share) from counts and sketches."""
    at = lambda r, q: F.kll_sketch_get_quantile_double(F.col(r), F.lit(q))
    out = [*keys, "n", at("n_words", 0.5).alias("words")]
    for r in RATIOS:
        above, below = at(r, OUTER) - at(r, 0.5), at(r, 0.5) - at(r, 1 - OUTER)
        out += [at(r, 0.5).alias(f"{r}_mid"), F.least(above, SKEW * below).alias(f"{r}_up"), F.least(below, SKEW * above).alias(f"{r}_down"),
                (F.col(f"some_{r}") / F.col("n")).alias(f"{r}_share")]
    return level.where("n > 0").select(*out)


def _names() -> list[str]:
    return ["words", *(f"{r}_{x}" for r in RATIOS for x in ("mid", "up", "down", "share"))]


def _shrunk(figures: DataFrame, keys: list[str], parent) -> DataFrame:
    """``figures`` drawn towards the parent's by their number of rows; ``parent(name)`` is a column."""
    weight = lambda x: (F.col("n") * F.col(x) + SHRINK * parent(x)) / (F.col("n") + SHRINK)
    return figures.select(*keys, "n", *(weight(x).alias(x) for x in _names()))


def thresholds(rows: DataFrame) -> DataFrame:
    """(lang, source, n, words, <ratio>_low, <ratio>_mid, <ratio>_high) for every group of ``rows``."""
    ratios = _ratios()
    good = rows.where(~base_failed()).select("lang", "source", F.col("n_words").cast("double").alias("n_words"),
                                             *(c.cast("double").alias(r) for r, c in ratios.items()))
    sketched = ["n_words", *RATIOS]
    sketch = [F.kll_sketch_agg_double(r, F.lit(SKETCH_K)).alias(r) for r in sketched]
    some = [F.count_if(F.col(r) > 0).alias(f"some_{r}") for r in RATIOS]
    merge = [F.kll_merge_agg_double(r).alias(r) for r in sketched] + [F.sum(f"some_{r}").alias(f"some_{r}") for r in RATIOS] + [F.sum("n").alias("n")]
    groups = settle(good.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *sketch, *some), "quality-sketches")
    langs = groups.groupBy("lang").agg(*merge)
    corpus = _figures(langs.agg(*merge), []).first()  # one row; none without any good document

    def everywhere(name: str) -> Column:
        if corpus is None:
            return F.lit(None).cast("double")
        own, kind = corpus[name], name.rpartition("_")[2]
        return F.lit((corpus.n * own + SHRINK * PRIOR.get(kind, own)) / (corpus.n + SHRINK))

    of_lang = _shrunk(_figures(langs, ["lang"]), ["lang"], everywhere)
    of_lang = of_lang.select(F.col("lang").alias("lang_l"), *(F.col(x).alias(f"{x}_l") for x in _names()))
    own = _figures(groups, ["lang", "source"])
    joined = own.join(of_lang, own["lang"].eqNullSafe(of_lang["lang_l"]))
    return _limits(_shrunk(joined, ["lang", "source"], lambda x: F.col(f"{x}_l")))


def _limits(figures: DataFrame) -> DataFrame:
    out = ["lang", "source", "n", "words"]
    for r, unit in RATIOS.items():
        high, low = SPREAD * F.col(f"{r}_up"), SPREAD * F.col(f"{r}_down")
        if unit is not None:
            share = F.least(F.greatest(f"{r}_share", F.lit(1e-4)), F.lit(0.5))
            high, low = F.greatest(high, unit * math.log(TAIL) / F.log(share) / F.col("words")), F.lit(float("inf"))
        out += [(F.col(f"{r}_mid") - low).alias(f"{r}_low"), F.col(f"{r}_mid").alias(f"{r}_mid"), (F.col(f"{r}_mid") + high).alias(f"{r}_high")]
    return figures.select(*out)


def judge(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, kept, adaptive_failed) per row of ``docs``."""
    rows = settle(measured(docs), "quality-counts")
    limits = thresholds(rows)
    limits = limits.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), F.col("words").alias("g_words"),
                           *(f"{r}_{s}" for r in RATIOS for s in ("low", "mid", "high")))
    joined = rows.join(limits, rows["lang"].eqNullSafe(limits["g_lang"]) & rows["source"].eqNullSafe(limits["g_source"]), "left")
    short = F.greatest(F.lit(1.0), F.col("g_words") / F.greatest("n_words", F.lit(1)))
    outside = []
    for r, c in _ratios().items():
        if RATIOS[r] is None:
            low, mid, high = (F.col(f"{r}_{s}") for s in ("low", "mid", "high"))
            outside += [c < mid - (mid - low) * F.sqrt(short), c > mid + (high - mid) * F.sqrt(short)]
        else:
            outside.append(c > F.col(f"{r}_high") * short)
    adaptive = F.coalesce(_any(outside), F.lit(False))
    return joined.select("doc_id", *_COUNTS, base_failed().alias("base_failed"), (~base_failed() & ~adaptive).alias("kept"), adaptive.alias("adaptive_failed"))


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = operator.or_(out, c)
    return out
