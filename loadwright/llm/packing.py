"""Best-fit packing of token pieces by a configuration linear program.

Only the length histogram (``capacity`` bins, whatever the corpus size) is
solved on the driver:

* the fractional covering program ``min sum x_c`` with ``sum_c a_cl x_c >= n_l``
  over configurations ``c`` (multisets of lengths that fit one sequence) is
  solved by multiplicative weights.  A round prices the lengths, and a knapsack
  dynamic programme finds for each length that lags behind the configuration
  worth most that holds it; it is taken as often as makes up the round's share,
  in whole sequences, so that rare lengths take turns.  A length's price is its size times
  ``exp(-LEARNING_RATE * (share covered - share of rounds gone))``: lengths that
  lag behind gain weight until configurations with them win.  The rounds' mean
  prices, divided by the best value at them, are a feasible dual and bound every
  packing from below, as the sizes do;
* the last share, and lengths with too few pieces left for whole configurations,
  are rounded up by pricing on: the longest length left opens a sequence, and a
  knapsack over the copies that are left finds what is worth most beside it at
  the dual prices (the mean ones or the sizes, whichever needs fewer sequences);
* sequences with places left, and those of many pieces, are opened and rounded
  up anew as long as that needs fewer.

Documents are tokenised, cut and ranked within their length on the executors;
a rank then picks its place from the solved plan.

Defined results: a null or empty text is its end id alone; a document of more
than ``capacity`` ids is cut into full pieces, where the first one may be
shorter; repeated rows are packed each; a null ``doc_id`` stays null; an empty
table gives no piece.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadwright.llm.common import map_batches, settle
from loadwright.llm.tokens import END_ID, default_path, encoder

CAPACITY = 1024
#: Shares that the sequences are dealt out in.
ROUNDS = 400
LEARNING_RATE = 2.0
#: Sequences that rounding up is left with: this share of all, and so many at most.
LAST_SHARE = 0.25
LAST_SEQUENCES = 1000
#: Cost of a piece against the highest price.
FEWER = 1e-6
#: Times that sequences with places left, and those of so many pieces, are opened and rounded up anew.
REOPENED = 4
MANY_PIECES = 3


def fewer(value: np.ndarray) -> np.ndarray:
    """Prices by which, of contents worth the same, those of fewer pieces win (short pieces fill what is left later)."""
    return value - FEWER * value.max() * (value > 0)


def knapsack(value: np.ndarray, limit: np.ndarray, capacity: int) -> list[int]:
    """For every room up to ``capacity`` the length that contents of most total ``value`` take first (0: leave a place).

    Dynamic programming over used capacity; lengths without any piece
    (``limit`` 0) are left out.
    """
    lengths = np.flatnonzero(limit[1:] > 1e-6) + 1
    worth = value[lengths]
    best = np.zeros(capacity + 1)
    took = [0] * (capacity + 1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for room in range(1, capacity + 1):
        fit = fits[room]
        best[room] = best[room - 1]
        if fit:
            total = best[room - lengths[:fit]] + worth[:fit]
            k = int(total.argmax())
            if total[k] > best[room]:
                best[room], took[room] = total[k], int(lengths[k])
    return took


def contents(took: list[int], room: int) -> dict[int, int]:
    """{length: copies} that ``knapsack`` fits into ``room``."""
    out: dict[int, int] = {}
    while room > 0:
        k = took[room]
        if k:
            out[k] = out.get(k, 0) + 1
        room -= k or 1
    return out


def best_configuration(value: np.ndarray, limit: np.ndarray, capacity: int) -> dict[int, int]:
    """{length: copies} of most total ``value`` that fits ``capacity``."""
    return contents(knapsack(value, limit, capacity), capacity)


@dataclass
class Cover:
    """A fractional solution: configurations with how often each is used, the last prices, the mean ones, a lower bound of any packing."""

    columns: list[tuple[dict[int, int], float]]
    prices: np.ndarray
    mean: np.ndarray
    bound: float


def fractional_cover(counts: np.ndarray, capacity: int, rounds: int = ROUNDS, rate: float = LEARNING_RATE) -> Cover:
    """The covering program by multiplicative weights (see the module's text).

    One knapsack table a round prices all lengths: beside each one it has the
    contents worth most.  ``start`` lets lengths of like counts take turns.
    """
    need, size = counts.astype(float), np.arange(capacity + 1) / capacity
    bound = float(need @ size)  # prices by size alone: no sequence is worth more than 1
    left, used = counts.copy(), {}
    start = np.arange(capacity + 1) * 0.6180339887498949 % 1
    price, mean = size.copy(), np.zeros(capacity + 1)
    last = min(LAST_SHARE * bound, LAST_SEQUENCES)
    for done in range(int(rounds * (1 - last / bound)) if bound else 0):
        covered = 1 - left / np.maximum(need, 1)
        price = size * np.exp(np.clip(-rate * (covered - done / rounds), -500, 500)) * (need > 0)
        mean += price / max(float(need @ price), 1e-300)
        target = np.floor((done + 1) / rounds * need + start)
        late = np.flatnonzero(counts - left < target)[::-1]
        if not len(late):
            continue
        took = knapsack(fewer(price), left, capacity)
        before = left.sum()
        for k in late.tolist():
            behind = int(target[k] - counts[k] + left[k])
            if behind > 0:
                config = contents(took, capacity - k)
                config[k] = config.get(k, 0) + 1
                amount = min(-(-behind // config[k]), *(int(left[j] // c) for j, c in config.items()))
                if amount > 0:
                    for j, c in config.items():
                        left[j] -= amount * c
                    key = tuple(sorted(config.items()))
                    used[key] = used.get(key, 0) + amount
        if left.sum() == before:  # no configuration fits what is left
            break
    if mean.any():
        best = best_configuration(mean, need, capacity)
        bound = max(bound, float(need @ mean) / sum(mean[k] * c for k, c in best.items()))
    return Cover([(dict(c), x) for c, x in sorted(used.items(), key=lambda kv: -kv[1])], price, mean, bound)


def best_rest(value: np.ndarray, left: np.ndarray, room: int) -> dict[int, int]:
    """{length: copies} of most total ``value`` that fits ``room``, with no more copies of a length than ``left`` has.

    Knapsack by dynamic programming; copies of a length come in lots of 1, 2, 4 and so on.
    """
    lots = []
    for k in (np.flatnonzero(left[1:room + 1]) + 1).tolist():
        n, lot = min(int(left[k]), room // k), 1
        while n > 0:
            lots.append((k, min(lot, n)))
            n, lot = n - lot, 2 * lot
    best, took = np.zeros(room + 1), np.zeros((len(lots), room + 1), bool)
    for i, (k, m) in enumerate(lots):
        total = best[:room + 1 - k * m] + m * value[k]
        took[i, k * m:] = total > best[k * m:]
        best[k * m:] = np.maximum(best[k * m:], total)
    out: dict[int, int] = {}
    for i in range(len(lots) - 1, -1, -1):
        if took[i, room]:
            k, m = lots[i]
            out[k] = out.get(k, 0) + m
            room -= k * m
    return out


def round_up(counts: np.ndarray, prices: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Sequences for all of ``counts``: each with the longest piece left and what is worth most beside it, as often as the pieces last."""
    left, plan, prices = counts.copy(), [], fewer(prices)
    for top in range(capacity, 0, -1):
        while left[top]:
            left[top] -= 1
            config = best_rest(prices, left, capacity - top)
            left[top] += 1
            config[top] = config.get(top, 0) + 1
            n = min(int(left[k] // c) for k, c in config.items())
            plan.append((config, n))
            for k, c in config.items():
                left[k] -= n * c
    return plan


def best_fit_decreasing(counts: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best fit decreasing on a histogram: [(configuration, how many sequences)].

    A yardstick for ``solve``, which makes no use of it.
    Sequences in the same state are kept as one entry, so the work follows the
    number of distinct states and not the number of pieces.
    """
    rooms: list[int] = []                                  # sorted distinct rooms left
    states: dict[int, dict[tuple, int]] = {}               # room -> contents -> sequences

    def put(room: int, content: tuple, n: int):
        if room not in states:
            insort(rooms, room)
            states[room] = {}
        states[room][content] = states[room].get(content, 0) + n

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                if left >= per:
                    put(capacity - per * length, (length,) * per, left // per)
                if left % per:
                    put(capacity - left % per * length, (length,) * (left % per), 1)
                break
            room = rooms[at]
            content, n = next(iter(states[room].items()))
            per = min(room // length, left)
            m = min(n, left // per)
            states[room][content] -= m
            if not states[room][content]:
                del states[room][content]
            if not states[room]:
                del states[room]
                rooms.pop(at)
            put(room - per * length, content + (length,) * per, m)
            left -= m * per
    out: dict[tuple, int] = {}
    for by in states.values():
        for content, n in by.items():
            out[content] = out.get(content, 0) + n
    return [({x: c.count(x) for x in dict.fromkeys(c)}, n) for c, n in out.items()]


def sequences(plan: list[tuple[dict[int, int], int]]) -> int:
    return sum(n for _, n in plan)


def solve(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS, rate: float = LEARNING_RATE) -> list[tuple[dict[int, int], int]]:
    """Whole sequences that hold exactly ``counts[l]`` pieces of each length ``l``."""
    cover = fractional_cover(counts, capacity, rounds, rate)
    left, plan = counts.copy(), cover.columns
    for config, n in plan:
        for k, c in config.items():
            left[k] -= n * c
    duals = cover.mean, np.arange(capacity + 1) / capacity  # two feasible ones, but for their scale
    whole = lambda left: min((round_up(left, prices, capacity) for prices in duals), key=sequences)
    plan = plan + whole(left)
    for _ in range(REOPENED):
        opened = [sum(config.values()) >= MANY_PIECES or sum(k * c for k, c in config.items()) < capacity for config, _ in plan]
        loose, left = [x for x, again in zip(plan, opened) if again], np.zeros_like(counts)
        for config, n in loose:
            for k, c in config.items():
                left[k] += n * c
        anew = whole(left)
        if sequences(anew) >= sequences(loose):
            break
        plan = [x for x, again in zip(plan, opened) if not again] + anew
    return plan


def places(plan: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first rank, first sequence and offset of each run of slots."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    base, given = 0, {}
    for config, n in plan:
        offset = 0
        for length in sorted(config, reverse=True):
            for _ in range(config[length]):
                runs.setdefault(length, []).append((given.get(length, 0), base, offset))
                given[length] = given.get(length, 0) + n
                offset += length
        base += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in runs.items()}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, after a shorter first one."""
    head = n % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, n, capacity)]


_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, local_rank long"


def _pieces(path: str, capacity: int):
    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
                       ("ids_crc32", pa.int64()), ("task", pa.int32()), ("local_rank", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]):
        enc, end = encoder(path), np.array([END_ID], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc.ids(text) + end
                for i, (s, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((doc, i, s, n, zlib.crc32(ids[4 * s:4 * (s + n)]), task, int(seen[n])))
                    seen[n] += 1
            columns = list(zip(*rows)) if rows else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, arrow)], schema=arrow)
        enc.rest()

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    path = tokenizer or default_path()
    rows = settle(map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), "text"], _PIECES, _pieces(path, capacity)), "pieces")
    # ranks within a length: a task counted its own, the tasks' counts give the rest
    per_task = rows.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    offsets = per_task.select("length", "task", before.alias("before"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    slots = places(solve(counts, capacity, rounds))
    ranked = rows.join(offsets, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local_rank")).alias("rank"))

    def place(batches):
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                mine = length == n
                first, base, at = slots[int(n)]
                k = np.searchsorted(first, rank[mine], side="right") - 1
                sequence[mine], offset[mine] = base[k] + rank[mine] - first[k], at[k]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), b.column(3).cast(pa.int64()), b.column(4), pa.array(sequence), pa.array(offset)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
