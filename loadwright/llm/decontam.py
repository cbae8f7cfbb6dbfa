"""Benchmark decontamination with suffix arrays of the training text.

The documents of a Spark partition are cut into shards of bounded size; a
document is never cut.  Each shard gets a suffix array over word ids, sorted to
the depth of the longest test text, and every test suffix is binary-searched in
it.  The places found merge the sorted test suffixes with the shard's, so a
training suffix shares most words with one of its two neighbours among the test
suffixes: that is its longest verbatim match.  A match of at least a window hits
its words; a test text shorter than a window is hit where it occurs as a whole.

Words absent from the test texts end any match, so only suffixes whose first
``least`` words all occur in the test set are searched, where ``least`` is the
length of the shortest window.  That is exact: no other suffix can match.

Defined results: a null or empty text has no words, no hits and no items; a
null or empty test text has no window; test texts count by their id, so equal
texts under different ids are items of their own; repeated documents are judged
each; an empty table gives an empty result.  Of several longest matches the
first in the document is told.  Only the id and text columns are read, so other
columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwright.llm.common import fresh, map_batches, settle

WINDOW = 10
#: Words of a shard, and characters of test text in one pass (bounds memory).
SHARD_WORDS = 2_000_000
PASS_CHARS = 8_000_000

#: Every byte that separates words becomes a space: all of ASCII but digits and letters.
_SPACED = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_SPACED).split()


def _compare(ids: np.ndarray, at: np.ndarray, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign of each suffix of ``ids`` against ``length`` words from ``start``, and the words that both share."""
    sign, same = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    live, k = np.flatnonzero(length > 0), 0
    while len(live):
        gap = ids[at[live] + k] - words[start[live] + k]
        ends = gap != 0
        sign[live[ends]] = np.sign(gap[ends])
        live, k = live[~ends], k + 1
        same[live] = k
        live = live[length[live] > k]
    return sign, same


def _runs(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words from each position to the next word 0."""
    breaks = np.flatnonzero(ids == 0)
    return breaks[np.searchsorted(breaks, at)] - at


def suffix_sort(ids: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` by at least their next ``depth`` words, a word 0 being the end: prefix doubling over ties.

    With a position, ``at`` must hold all later ones up to the next word 0.
    """
    if not len(at):
        return at
    rank, run = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    run[at] = _runs(ids, at)
    order = at[np.argsort(ids[at], kind="stable")]
    head = np.concatenate([[True], ids[order[1:]] != ids[order[:-1]]])
    tied, step = np.arange(len(order)), 1
    while True:
        rank[order[tied]] = np.maximum.accumulate(np.where(head[tied], tied, 0)) + 1
        last = np.append(head[1:], True)
        tied = tied[~(head[tied] & last[tied])]
        tied = tied[run[order[tied]] >= step]  # the others ended together
        if step >= depth or not len(tied):
            return order
        old = order[tied]
        after = np.where(run[old] > step, rank[np.minimum(old + step, len(ids) - 1)], 0)
        by = np.lexsort((after, rank[old]))
        order[tied], after, group = old[by], after[by], rank[old[by]]
        head[tied[1:]] |= (after[1:] != after[:-1]) | (group[1:] != group[:-1])
        step *= 2


@dataclass
class TestSet:
    """Test texts as word ids, one after the other with a 0 behind each; their suffixes in order."""

    vocab: dict[bytes, int]
    names: list[str]            # item of each text
    ids: np.ndarray
    suffixes: np.ndarray        # positions in ``ids``, sorted
    left: np.ndarray            # words from there to the text's end
    text: np.ndarray            # the text that each suffix belongs to
    place: np.ndarray           # its place in that text
    number: np.ndarray          # number of the window that each suffix begins with
    owners: dict[int, set[str]]  # items that hold each window
    short: np.ndarray           # suffixes that are a whole text below the window
    window: int

    @property
    def depth(self) -> int:
        return int(self.left.max())

    @property
    def least(self) -> int:
        return min([self.window, *self.left[self.short].tolist()])


def test_set(rows: list[tuple[str, str | None]], window: int = WINDOW) -> TestSet | None:
    """The suffixes of every test text and their windows of ``window`` words; a shorter text is one window."""
    vocab: dict[bytes, int] = {}
    names, parts = [], []
    for item, text in rows:
        ids = [vocab.setdefault(w, len(vocab) + 1) for w in words_of(text)]
        if ids:
            names.append(item)
            parts.append(np.array([*ids, 0], np.int64))
    if not names:
        return None
    ids = np.concatenate(parts)
    starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
    longest = max(len(p) for p in parts) - 1
    suffixes = suffix_sort(ids, np.flatnonzero(ids), longest)
    left, text = _runs(ids, suffixes), np.searchsorted(starts, suffixes, side="right") - 1
    place = suffixes - starts[text]
    _, same = _compare(ids, suffixes[1:], ids, suffixes[:-1], np.minimum(left[1:], left[:-1]))
    number = np.concatenate([[0], np.cumsum(same < np.minimum(window, np.maximum(left[1:], left[:-1])))])
    owners: dict[int, set[str]] = {}
    whole = (left >= window) | (place == 0)
    for n, t in zip(number[whole].tolist(), text[whole].tolist()):
        owners.setdefault(n, set()).add(names[t])
    short = np.flatnonzero((left < window) & (place == 0))
    short = short[np.unique(number[short], return_index=True)[1]]
    return TestSet(vocab, names, ids, suffixes, left, text, place, number, owners, short, window)


class SuffixArray:
    """Sorted suffixes of one shard; documents are kept apart by id 0."""

    def __init__(self, ids: np.ndarray, least: int, depth: int):
        self.ids = np.concatenate([[0], ids, np.zeros(depth + 1, np.int64)])
        at = np.flatnonzero(self.ids)
        run = _runs(self.ids, at)
        head = np.flatnonzero(self.ids[at - 1] == 0)  # first position of each run
        whole = np.repeat(run[head], run[head])
        order = suffix_sort(self.ids, at[whole >= least], depth)
        order = order[_runs(self.ids, order) >= least]
        self.ids, self.at = self.ids[1:], order - 1

    def place(self, test: TestSet, which: np.ndarray, after: bool) -> np.ndarray:
        """Binary search of test suffixes, all at once.

        ``after=False``: training suffixes less than the test suffix;
        ``after=True``: those that are less or begin with it.
        """
        start, length = test.suffixes[which], test.left[which]
        lo, hi = np.zeros(len(which), np.int64), np.full(len(which), len(self.at))
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            sign, _ = _compare(self.ids, self.at[mid], test.ids, start[open_], length[open_])
            right = (sign < 0) | ((sign == 0) & after)
            lo[open_[right]] = mid[right] + 1
            hi[open_[~right]] = mid[~right]
        return lo

    def shared(self, test: TestSet, ranks: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Words that the training suffix of each rank shares with a test suffix (0 where one is out of range)."""
        out = np.zeros(len(ranks), np.int64)
        ok = np.flatnonzero((ranks >= 0) & (ranks < len(self.at)) & (which >= 0) & (which < len(test.suffixes)))
        w = which[ok]
        out[ok] = _compare(self.ids, self.at[ranks[ok]], test.ids, test.suffixes[w], test.left[w])[1]
        return out


def _shards(batches: Iterator[pa.RecordBatch], vocab: dict[bytes, int], limit: int):
    """(keys, earlier state, ids, starts, lengths) of shards with about ``limit`` words; keys keep their Arrow type."""
    keys, states, parts, lengths, size, kind = [], [], [], [], 0, pa.int64()
    get = vocab.get

    def shard():
        ids = np.concatenate([np.concatenate([p, [0]]) for p in parts])
        ends = np.cumsum(np.array(lengths) + 1)
        return pa.array(keys, kind), list(states), ids, ends - np.array(lengths) - 1, np.array(lengths)

    for b in batches:
        kind = b.column(0).type
        before = b.column(2).to_pylist() if b.num_columns > 2 else [None] * b.num_rows
        for key, text, state in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), before):
            w = words_of(text)
            keys.append(key)
            states.append(state)
            parts.append(np.fromiter((get(x, 0) for x in w), np.int64, count=len(w)))
            lengths.append(len(w))
            size += len(w) + 1
            if size >= limit:
                yield shard()
                keys, states, parts, lengths, size = [], [], [], [], 0
    if keys:
        yield shard()


def _doc_of(starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(starts, at, side="right") - 1


_STATE = "struct<n_words: bigint, n_hit: bigint, hit_bits: binary, items: array<string>, longest: bigint, longest_at: bigint>"
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("hit_bits", pa.binary()), ("items", pa.list_(pa.string())),
                    ("longest", pa.int64()), ("longest_at", pa.int64())])


def _matches(sa: SuffixArray, test: TestSet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, words, window number) of the longest match at every position where a window occurs.

    A position where a short test text occurs has a row for that, too.
    """
    lo = sa.place(test, np.arange(len(test.suffixes)), False)
    rank = np.arange(len(sa.at))
    above = np.searchsorted(lo, rank, side="right")
    pair = np.stack([sa.shared(test, rank, above - 1), sa.shared(test, rank, above)])
    side, same = pair.argmax(axis=0), pair.max(axis=0)
    hit = np.flatnonzero(same >= test.window)
    found = [(sa.at[hit], same[hit], test.number[above[hit] - 1 + side[hit]])]
    for s, a, e in zip(test.short, lo[test.short], sa.place(test, test.short, True)):
        found.append((sa.at[a:e], np.full(e - a, test.left[s]), np.full(e - a, test.number[s])))
    return tuple(np.concatenate(c) for c in zip(*found))


def _mark(test: TestSet, limit: int):
    """Per document: its word count, a bit for each hit word, the items found, its longest match."""

    def run(batches):
        for keys, states, ids, starts, lengths in _shards(batches, test.vocab, limit):
            at, words, number = _matches(SuffixArray(ids, test.least, test.depth), test)
            cover = np.zeros(len(ids) + 1, np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + np.minimum(words, test.window), -1)
            hit = np.cumsum(cover)[:-1] > 0
            doc = _doc_of(starts, at)
            by = np.lexsort((at, -words, doc))
            first = by[np.flatnonzero(np.diff(doc[by], prepend=-1))]
            best = {d: (w, p) for d, w, p in zip(doc[first].tolist(), words[first].tolist(), (at - starts[doc])[first].tolist())}
            items: dict[int, set] = {}
            for d, n in np.unique(np.stack([doc, number]), axis=1).T.tolist():
                items.setdefault(d, set()).update(test.owners[n])
            out = []
            for d, (old, n) in enumerate(zip(states, lengths.tolist())):
                bits = hit[starts[d]:starts[d] + n]
                found, (longest, place) = items.get(d, set()), best.get(d, (0, None))
                if old is not None and old["hit_bits"] is not None:
                    bits = bits | np.unpackbits(np.frombuffer(old["hit_bits"], np.uint8), count=n).astype(bool)
                    found = found.union(old["items"])
                    if (old["longest"], -old["longest_at"]) > (longest, -(place or 0)):
                        longest, place = old["longest"], old["longest_at"]
                out.append({"n_words": n, "n_hit": int(bits.sum()) if found else 0, "items": sorted(found), "longest": longest, "longest_at": place,
                            "hit_bits": np.packbits(bits).tobytes() if found else None})
            yield pa.RecordBatch.from_arrays([keys, pa.array(out, _ARROW)], ["doc_id", "state"])

    return run


def _longest(test: TestSet, limit: int):
    """Per shard and test suffix: its longest verbatim match and where it is."""

    def run(batches):
        every = np.arange(len(test.suffixes))
        for keys, _, ids, starts, _ in _shards(batches, test.vocab, limit):
            sa = SuffixArray(ids, test.least, test.depth)
            rank = sa.place(test, every, False)
            pair = np.stack([sa.shared(test, rank - 1, every), sa.shared(test, rank, every)])
            same, rank = pair.max(axis=0), rank - 1 + pair.argmax(axis=0)
            got = np.flatnonzero(same >= test.least)
            at = sa.at[rank[got]] if len(got) else np.zeros(0, np.int64)
            doc = _doc_of(starts, at)
            yield pa.RecordBatch.from_arrays([
                pa.array([test.names[t] for t in test.text[got]], pa.string()), pa.array(test.place[got], pa.int64()),
                pa.array(same[got], pa.int64()), keys.take(pa.array(doc, pa.int64())),
                pa.array(at - starts[doc] if len(got) else at, pa.int64())], ["item_id", "item_at", "n_words", "doc_id", "doc_at"])

    return run


def _test_sets(benchmark: DataFrame, window: int, pass_chars: int) -> tuple[int, Iterator[TestSet]]:
    """The number of passes, and the test texts pass by pass: each has about ``pass_chars`` characters.

    Only the pass at hand is on the driver.  A pass is a hash of id and text, and equal rows are one, so
    no item is larger than its texts; a single text is never cut.
    """
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").distinct()
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = int(chars // pass_chars) + 1
    cut = F.pmod(F.xxhash64("item", "text"), F.lit(passes))
    sets = (test_set([(r.item or "", r.text) for r in rows.where(cut == p).collect()], window) for p in range(passes))
    return passes, (s for s in sets if s)


def contaminated_words(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                       pass_chars: int = PASS_CHARS, key: str = "long") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items array<string>, longest, longest_at) per row of ``docs``; ``key`` is the id's type.

    ``longest`` has the words of the longest match that holds a window (0: none), ``longest_at`` its first word's place.
    A benchmark beyond ``pass_chars`` characters is searched in several passes;
    each takes over what the one before found.
    """
    keyed = docs.select(F.col("doc_id").cast(key).alias("doc_id"), "text")
    passes, sets = _test_sets(benchmark, window, pass_chars)
    if passes == 1:
        test = next(sets, None)
        state = map_batches(keyed, ["doc_id", "text"], f"doc_id {key}, state {_STATE}", _mark(test, shard_words) if test else _counted)
    else:
        state = _passes(keyed, sets, shard_words, key)
    return state.select("doc_id", "state.n_words", "state.n_hit", F.size("state.items").cast("long").alias("n_items"),
                        F.col("state.items").alias("items"), "state.longest", "state.longest_at")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts alone, for a benchmark without any window."""
    for b in batches:
        out = [{"n_words": len(words_of(t)), "n_hit": 0, "items": [], "hit_bits": None, "longest": 0, "longest_at": None} for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, _ARROW)], ["doc_id", "state"])


def _passes(keyed: DataFrame, sets: Iterator[TestSet], shard_words: int, key: str) -> DataFrame:
    """Search pass after pass; rows keep their text and state in a written table between them."""
    rows = keyed.select("doc_id", "text", F.lit(None).cast(_STATE).alias("state"))
    for test in sets:
        def run(batches, test=test):
            kept = []

            def seen():
                for b in batches:
                    kept.extend(b.column(1).to_pylist())
                    yield b

            for out in _mark(test, shard_words)(seen()):
                texts, kept[:] = kept[:out.num_rows], kept[out.num_rows:]
                yield pa.RecordBatch.from_arrays([out.column(0), pa.array(texts, pa.string()), out.column(1)], ["doc_id", "text", "state"])

        rows = settle(map_batches(rows, ["doc_id", "text", "state"], f"doc_id {key}, text string, state {_STATE}", run), "decontam-pass")
    return rows.select("doc_id", "state")


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                    pass_chars: int = PASS_CHARS) -> DataFrame:
    """(item_id, item_at, n_words, doc_id, doc_at): for each test suffix, by item
    and place, one longest verbatim match in ``docs`` (by words, smallest
    ``doc_id`` first); suffixes without a match of the shortest window are left out."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "item_id string, item_at long, n_words long, doc_id long, doc_at long"
    found = None
    for test in _test_sets(benchmark, window, pass_chars)[1]:
        part = map_batches(keyed, ["doc_id", "text"], schema, _longest(test, shard_words))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    best = F.max(F.struct("n_words", (-F.col("doc_id")).alias("d"), (-F.col("doc_at")).alias("p"))).alias("m")
    return found.groupBy("item_id", "item_at").agg(best).select(
        "item_id", "item_at", "m.n_words", (-F.col("m.d")).alias("doc_id"), (-F.col("m.p")).alias("doc_at"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The digest per document: counts, the sha256 of its item ids, the verdict, its longest match and that match's place."""
    found = contaminated_words(docs, benchmark, window)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), "longest", "longest_at")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a test window.

    Contamination follows from the text alone, so it is looked up by the text's
    own SHA-256: rows with equal or no ``doc_id`` are told apart.
    """
    key = fresh("_text_key", docs.columns)
    sha = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    marked = docs.withColumn(key, sha)
    asked = docs.select(sha.alias("doc_id"), "text")
    bad = contaminated_words(asked, benchmark, window, key="binary").where("n_hit > 0").select("doc_id").distinct()
    return marked.join(bad, marked[key] == bad["doc_id"], "left_anti").drop(key)
