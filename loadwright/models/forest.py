"""Growth of a random forest of continuous features: node for node the forest of Spark ML's own fit.

Spark ML keeps a dense histogram of every open node in every partition and
ships them all in each pass, so its time grows with nodes times partitions,
however few rows the nodes hold.  Here a pass costs what its rows cost:

* ``_blocks``    a partition's rows as bins of Spark's own candidate splits, with its own bootstrap counts
* ``_counted``   while nodes are large: counts of the cells that occur, summed by node in a shuffle
* ``dealt``      once the largest open node fits a task, every open node with all its rows goes to one
  partition (by size), and a pass needs no shuffle: its tasks find the best splits themselves
* ``Growth``     on the driver, as in Spark ML: the stack of open nodes, their feature subsets and the nodes found

The order of the nodes, the random numbers, the bins, the gains and the ties
are Spark ML's, so the forest does not depend on which of the two grew it.
"""

from __future__ import annotations

import json
import math
import pickle
import time
import uuid
from functools import partial

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REBASE = 8  # passes after which the rows' nodes are kept anew
DEALT_ROWS = 100_000  # rows of the largest open node that a task may hold whole
CELLS = 1 << 18  # histogram cells looked at together
PACKED = 20_000  # nodes written together
NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, "
         "rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")
INVALID = -np.finfo(np.float64).max
LOW = 0xFFFFFFFF


# random numbers of Spark ML


def poisson_counts(seed: int, n: int) -> np.ndarray:
    """``n`` draws of commons-math's PoissonDistribution(1) on a Well19937c with ``seed``: Spark ML's bootstrap counts."""
    v = [(seed >> 32) & LOW, seed & LOW]
    for i in range(2, 624):
        x = v[i - 2] - (1 << 32) if v[i - 2] >> 31 else v[i - 2]
        v.append((1812433253 * (x ^ (x >> 30)) + i) & LOW)
    block, chunk, u32 = 70, 70 * 36, np.uint32
    z = np.empty(624 + chunk, u32)
    z[:624] = np.roll(np.array(v, u32)[::-1], 1)  # the state in the order of time; its first word stands for the last output
    x = v[0]
    out, filled, count, r, least = np.empty(n, np.uint8), 0, 0, 1.0, math.exp(-1.0)
    while filled < n:
        raw = []
        for s in range(624, 624 + chunk, block):
            m1, m2, m3, r1, r2 = (z[s - back:s - back + block] for back in (70, 179, 449, 623, 622))
            b1, z2 = m1 ^ (m1 >> u32(27)), (m2 >> u32(9)) ^ m3 ^ (m3 >> u32(1))
            z0 = (r1 & u32(0x80000000)) ^ (r2 & u32(0x7FFFFFFF))
            known = z0 ^ (b1 << u32(9)) ^ (z2 << u32(21)) ^ ((b1 ^ z2) >> u32(21))
            first = x
            for k in known.tolist():
                y = x ^ (x << 25 & LOW)
                x = (y << 9 & LOW) ^ (y >> 21) ^ k
                raw.append(x)
            before = np.array([first, *raw[-block:-1]], u32)
            z[s:s + block] = before ^ (before << u32(25)) ^ b1 ^ z2
        z[:624] = z[-624:]
        t = np.array(raw, u32)
        t ^= (t << u32(7)) & u32(0xE46E1700)
        t ^= (t << u32(15)) & u32(0x9B868000)
        high, low = (t >> u32(6)).astype(np.int64).reshape(-1, 2).T
        drawn = []
        for u in ((high << 26 | low) * 2.0**-52).tolist():
            r *= u
            if r >= least:
                count += 1
            else:
                drawn.append(count)
                count, r = 0, 1.0
        some = min(len(drawn), n - filled)
        out[filled:filled + some] = drawn[:some]
        filled += some
    return out


class JavaRandom:
    """java.util.Random's nextLong."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def longs(self, n: int) -> tuple[np.ndarray, list[int]]:
        """The next ``n`` values, and the state after each of them; the state here stays."""
        s, out, after = self.state, [], []
        for _ in range(n):
            s = (s * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
            high = s >> 16
            s = (s * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
            low = s >> 16
            out.append(((high << 32) + low - ((low >> 31) << 32)) & 0xFFFFFFFFFFFFFFFF)
            after.append(s)
        return np.array(out, np.uint64), after


def _murmur(first: np.ndarray, second: np.ndarray, h: np.ndarray) -> np.ndarray:
    """scala.util.hashing.MurmurHash3.bytesHash of two 4-byte blocks."""
    rotl = lambda x, n: (x << np.uint32(n)) | (x >> np.uint32(32 - n))
    for k in (first, second):
        h = rotl(h ^ (rotl(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)), 13) * np.uint32(5) + np.uint32(0xE6546B64)
    h = h ^ np.uint32(8)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return h ^ (h >> np.uint32(16))


def feature_subsets(seeds: np.ndarray, d: int, k: int) -> np.ndarray:
    """For each seed the ``k`` of ``d`` features that Spark's reservoir sampling takes, in its order."""
    first, second = (seeds >> np.uint64(32)).astype(np.uint32).byteswap(), seeds.astype(np.uint32).byteswap()
    low = _murmur(first, second, np.full(len(seeds), 0x3C074A61, np.uint32))
    high = _murmur(first, second, low)
    s = high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)
    out = np.tile(np.arange(k, dtype=np.int32), (len(seeds), 1))
    at = np.arange(len(seeds))
    for item in range(k, d):
        halves = []
        for bits in (26, 27):
            s = s ^ (s << np.uint64(21))
            s = s ^ (s >> np.uint64(35))
            s = s ^ (s << np.uint64(4))
            halves.append(s & np.uint64((1 << bits) - 1))
        u = ((halves[0] << np.uint64(27)) + halves[1]).astype(np.float64) * 2.0**-53
        place = (u * (item + 1)).astype(np.int64)
        hit = place < k
        out[at[hit], place[hit]] = item
    return out


# what tasks do


def gini(counts: np.ndarray) -> np.ndarray:
    """Spark's Gini impurity of class counts along the last axis, in its order of operations."""
    total = counts.sum(-1)
    out = np.ones(total.shape)
    with np.errstate(invalid="ignore", divide="ignore"):
        for c in range(counts.shape[-1]):
            f = counts[..., c] / total
            out -= f * f
    return np.where(total == 0, 0.0, out)


def _best(hist: np.ndarray):
    """Of counts by class, node, feature and bin: feature, bin and gain of each node's best split, its left and all class counts.

    The first of equal gains wins, features in the order of their subset.
    """
    classes, nodes, k, bins = hist.shape
    cum = np.cumsum(hist, axis=-1)
    left, total = cum[..., :-1], cum[:, :, 0, -1]
    n, n_left = total.sum(0)[:, None, None], left.sum(0)
    n_right = n - n_left
    gain_left, gain_right, f = np.ones(n_left.shape), np.ones(n_left.shape), np.empty(n_left.shape)
    with np.errstate(invalid="ignore", divide="ignore"):
        for c in range(classes):
            np.divide(left[c], n_left, out=f)
            np.multiply(f, f, out=f)
            gain_left -= f
            np.subtract(total[c][:, None, None], left[c], out=f)
            np.divide(f, n_right, out=f)
            np.multiply(f, f, out=f)
            gain_right -= f
        gain = gini(total.T)[:, None, None] - (n_left / n) * gain_left - (n_right / n) * gain_right
    gain[(n_left == 0) | (n_right == 0) | ~(gain >= 0.0)] = INVALID
    gain = gain.reshape(nodes, -1)
    best = gain.argmax(1)
    at = np.arange(nodes)
    k_best, bin_best = best // (bins - 1), best % (bins - 1)
    return k_best, bin_best, gain[at, best], left[:, at, k_best, bin_best].T, total.T


def _found(g: np.ndarray, hist: np.ndarray):
    k, b, gain, left, total = _best(hist)
    return g, k.astype(np.int32), b.astype(np.int32), gain, left.astype(np.int32), total.astype(np.int32)


def _chunks(g: np.ndarray, cells: int):
    """Slices of the sorted nodes ``g``, each with whole nodes, few enough for a dense histogram."""
    nodes, starts = np.unique(g, return_index=True)
    step = max(1, CELLS // cells)
    for i in range(0, len(nodes), step):
        end = starts[i + step] if i + step < len(nodes) else len(g)
        yield nodes[i:i + step], slice(starts[i], end)


def _blocks(batches, thresholds, trees: int, seed: int, classes: int):
    """A partition as one block: bins of its rows, labels, and for each tree the rows drawn into it, all at the root."""
    import pyarrow as pa
    from pyspark import TaskContext

    width = np.uint8 if max(map(len, thresholds), default=0) < 256 else np.uint16
    bins, labels = [np.empty((0, len(thresholds)), width)], [np.empty(0, np.int32)]
    for batch in batches:
        x = np.ascontiguousarray(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(thresholds)).T)
        bins.append(np.stack([np.searchsorted(t, x[j], side="left").astype(width) for j, t in enumerate(thresholds)], axis=1))
        labels.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int32))
    bins, labels = np.concatenate(bins), np.concatenate(labels)
    drawn = poisson_counts(seed + TaskContext.get().partitionId() + 1, len(labels) * trees).reshape(len(labels), trees)
    tree, row = np.nonzero(drawn.T)
    block = bins, labels, row.astype(np.int32), tree.astype(np.int64) << 32 | 1, drawn[row, tree]
    yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(block)], pa.large_binary())})


def _find(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``key`` are among the sorted ``keys``, and where."""
    at = np.searchsorted(keys, key)
    at[at == len(keys)] = 0
    hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
    return hit, at[hit]


def _moved(block, passes):
    """The block with its rows at the nodes to which the splits of ``passes`` lead; rows in finished nodes go."""
    bins, labels, row, key, w = block
    for keys, feature, at_most, open_left, open_right in passes:
        hit, at = _find(keys, key)
        if not len(at):
            continue
        r = row[hit]
        right = bins[r, feature[at]] > at_most[at]
        now = key[hit]
        key = key.copy()
        key[hit] = np.where(np.where(right, open_right[at], open_left[at]), now + (now & LOW) + right, -1)
        live = key >= 0
        row, key, w = row[live], key[live], w[live]
    return bins, labels, row, key, w


def _rows_of(block, group):
    """Node of the group, label, weight and bins of its features for every row in one of the group's nodes, by node."""
    bins, labels, row, key, w = block
    keys, number, features = group
    hit, at = _find(keys, key)
    g, r = number[at], row[hit]
    order = np.argsort(g, kind="stable")
    g, r = g[order], r[order]
    return g, labels[r], w[hit][order].astype(np.float64), bins[r[:, None], features[g]].astype(np.int64)


def _local(blocks, shared, classes: int, bins: int):
    """Best splits of the group's nodes, all rows of a node being in one block."""
    passes, group = shared.value
    for block in blocks:
        g, label, w, b = _rows_of(_moved(block, passes), group)
        k = b.shape[1]
        for nodes, s in _chunks(g, classes * k * bins):
            place = label[s].astype(np.int64) * len(nodes) + np.searchsorted(nodes, g[s])
            cell = (place[:, None] * k + np.arange(k)) * bins + b[s]
            hist = np.bincount(cell.ravel(), np.repeat(w[s], k), classes * len(nodes) * k * bins)
            yield _found(nodes, hist.reshape(classes, len(nodes), k, bins))


def _counted(blocks, shared, classes: int, bins: int, reducers: int):
    """Counts of the cells (node, feature, bin, class) that occur in a block, by reducer."""
    passes, group = shared.value
    for block in blocks:
        g, label, w, b = _rows_of(_moved(block, passes), group)
        k = b.shape[1]
        for nodes, s in _chunks(g, classes * k * bins):
            place = (np.searchsorted(nodes, g[s])[:, None] * k + np.arange(k)) * bins + b[s]
            hist = np.bincount((place * classes + label[s][:, None]).ravel(), np.repeat(w[s], k), len(nodes) * k * bins * classes)
            cell = np.flatnonzero(hist)
            node, rest = nodes[cell // (k * bins * classes)], cell % (k * bins * classes)
            to = node % reducers
            for j in np.unique(to).tolist():
                yield j, (node[to == j].astype(np.int32), rest[to == j].astype(np.int32), hist[cell[to == j]])


def _summed(pairs, classes: int, bins: int, k: int):
    """Best splits of the nodes whose cells meet here."""
    parts = [x for _, x in pairs]
    if not parts:
        return
    node, rest, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(node, kind="stable")
    node, rest, n = node[order], rest[order], n[order]
    size = k * bins * classes
    for nodes, s in _chunks(node, size):
        hist = np.bincount(np.searchsorted(nodes, node[s]) * size + rest[s], n[s], len(nodes) * size)
        yield _found(nodes, np.moveaxis(hist.reshape(len(nodes), k, bins, classes), -1, 0))


def _kept(blocks, shared):
    for block in blocks:
        bins, labels, row, key, w = _moved(block, shared.value)
        used = np.unique(row)
        yield bins[used], labels[used], np.searchsorted(used, row).astype(np.int32), key, w


def _dealt(blocks, shared):
    """Pieces of the blocks by the partition of their node."""
    passes, keys, partition = shared.value
    for block in blocks:
        bins, labels, row, key, w = _moved(block, passes)
        hit, at = _find(keys, key)
        row, key, w, to = row[hit], key[hit], w[hit], partition[at]
        for j in np.unique(to).tolist():
            s = to == j
            yield j, (bins[row[s]], labels[row[s]], key[s], w[s])


def _gathered(pairs):
    parts = [x for _, x in pairs]
    if parts:
        bins, labels, key, w = (np.concatenate(x) for x in zip(*parts, strict=True))
        yield bins, labels, np.arange(len(key), dtype=np.int32), key, w


# the driver


class _Column:
    """An array that grows at its end."""

    def __init__(self, first: np.ndarray):
        self.all, self.n = first, len(first)

    def extend(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.all):
            room = np.zeros((max(2 * len(self.all), self.n + len(more)), *self.all.shape[1:]), self.all.dtype)
            room[:self.n] = self.all[:self.n]
            self.all = room
        self.all[self.n:self.n + len(more)] = more
        self.n += len(more)

    def values(self) -> np.ndarray:
        return self.all[:self.n]


class Growth:
    """The nodes found so far and the stack of open ones, in Spark ML's order."""

    def __init__(self, trees: int, classes: int, n_bins: np.ndarray, per_node: int, max_depth: int, memory: int, seed: int, tree_order):
        self.classes, self.n_bins, self.per_node, self.max_depth, self.memory = classes, n_bins, per_node, max_depth, memory
        self.random, self.tree_order = JavaRandom(seed), tree_order
        self.tree, self.id = _Column(np.arange(trees, dtype=np.int32)), _Column(np.ones(trees, np.int64))
        self.level, self.value = _Column(np.zeros(trees, np.int32)), _Column(np.zeros((trees, classes), np.int32))
        self.left, self.feature = _Column(np.full(trees, -1, np.int32)), _Column(np.full(trees, -1, np.int32))
        self.bin, self.gain, self.valid = _Column(np.full(trees, -1, np.int32)), _Column(np.full(trees, -1.0)), _Column(np.ones(trees, bool))
        self.stack = list(range(trees))

    def group(self) -> tuple[np.ndarray, np.ndarray]:
        """The next nodes to split and their features: as many as Spark's memory for histograms would hold."""
        d, used, taken, features = len(self.n_bins), 0, [], []
        while self.stack:
            n = min(len(self.stack), 4096)
            if self.per_node < d:
                seeds, after = self.random.longs(n)
                subset = feature_subsets(seeds, d, self.per_node)
            else:
                after, subset = None, np.tile(np.arange(d, dtype=np.int32), (n, 1))
            total = used + np.cumsum(self.n_bins[subset].sum(1) * self.classes * 8)
            fits = int((total <= self.memory).sum()) if used or total[0] <= self.memory else 1
            if after:
                self.random.state = after[min(fits, n - 1)]  # the node that no longer fits has drawn its features, too
            if fits:
                taken += self.stack[:-fits - 1:-1]
                del self.stack[-fits:]
                features.append(subset[:fits])
                used = total[fits - 1]
            if fits < n:
                break
        return np.array(taken, np.int64), np.concatenate(features)

    def shared(self, nodes: np.ndarray, features: np.ndarray):
        key = self.tree.all[nodes].astype(np.int64) << 32 | self.id.all[nodes]
        order = np.argsort(key)
        return key[order], order, features

    def take(self, nodes: np.ndarray, features: np.ndarray, found: list):
        """Keeps a pass's best splits, opens the children, and returns where the rows go."""
        g, k, b, gain, left, total = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 6
        n, c = len(nodes), self.classes
        feature, at_most, gains, lefts, totals = np.zeros(n, np.int32), np.zeros(n, np.int32), np.full(n, INVALID), np.zeros((n, c), np.int32), np.zeros((n, c), np.int32)
        if len(g):
            feature[g], at_most[g], gains[g], lefts[g], totals[g] = features[g, k], b, gain, left, total
        self.value.all[nodes], self.valid.all[nodes] = totals, gains != INVALID
        split = (gains > 0) & (self.level.all[nodes] < self.max_depth)
        of_tree = self.tree.all[nodes]
        rank = {t: i for i, t in enumerate(self.tree_order(list(dict.fromkeys(of_tree.tolist()))))}
        order = np.argsort(np.array([rank[t] for t in of_tree.tolist()]), kind="stable")
        order = order[split[order]]
        parent, m = nodes[order], len(order)
        self.feature.all[parent], self.bin.all[parent], self.gain.all[parent] = feature[order], at_most[order], gains[order]
        self.left.all[parent] = self.tree.n + 2 * np.arange(m)
        two = lambda a: np.repeat(a, 2, axis=0)
        level, value = two(self.level.all[parent] + 1), np.stack([lefts[order], totals[order] - lefts[order]], 1).reshape(2 * m, c)
        is_open = (level < self.max_depth) & ~(np.abs(gini(value)) < np.finfo(np.float64).eps)
        self.stack += (self.tree.n + np.flatnonzero(is_open)).tolist()
        for column, more in ((self.id, two(self.id.all[parent]) * 2 + np.tile([0, 1], m)), (self.level, level), (self.value, value), (self.left, np.full(2 * m, -1)),
                             (self.feature, np.full(2 * m, -1)), (self.bin, np.full(2 * m, -1)), (self.gain, np.full(2 * m, -1.0)), (self.valid, np.ones(2 * m, bool)),
                             (self.tree, two(self.tree.all[parent]))):
            column.extend(more)
        opens = np.zeros((n, 2), bool)
        opens[order] = is_open.reshape(m, 2)
        key = of_tree.astype(np.int64) << 32 | self.id.all[nodes]
        by = np.argsort(key)
        return key[by], feature[by], at_most[by], opens[by, 0], opens[by, 1]

    def nodes(self) -> dict[str, np.ndarray]:
        """The finished trees as Spark ML saves them: nodes whose children are leaves of one class become leaves, ids run in preorder."""
        tree, level, value, left = self.tree.values(), self.level.values(), self.value.values(), self.left.values().copy()
        prediction, impurity = value.argmax(1), np.where(self.valid.values(), gini(value), -1.0)
        by_level = [np.flatnonzero(level == i) for i in range(int(level.max()) + 1)]
        size = np.ones(len(tree), np.int64)
        for at in reversed(by_level):
            at = at[left[at] >= 0]
            kids = left[at]
            same = (left[kids] < 0) & (left[kids + 1] < 0) & (prediction[kids] == prediction[kids + 1])
            left[at[same]] = -1
            at, kids = at[~same], kids[~same]
            size[at] = 1 + size[kids] + size[kids + 1]
        number = np.full(len(tree), -1, np.int64)
        number[level == 0] = 0
        for at in by_level:
            at = at[(left[at] >= 0) & (number[at] >= 0)]
            number[left[at]] = number[at] + 1
            number[left[at] + 1] = number[at] + 1 + size[left[at]]
        kept = np.flatnonzero(number >= 0)
        kept = kept[np.lexsort((number[kept], tree[kept]))]
        inner, kids = left[kept] >= 0, np.maximum(left[kept], 0)
        return {"tree": tree[kept], "id": number[kept], "prediction": prediction[kept], "impurity": impurity[kept], "value": value[kept], "inner": inner,
                "gain": np.where(inner, self.gain.values()[kept], -1.0), "left": np.where(inner, number[kids], -1), "right": np.where(inner, number[kids + 1], -1),
                "feature": np.where(inner, self.feature.values()[kept], -1), "bin": self.bin.values()[kept]}


def _prepared(spark, rf, data: DataFrame):
    """Spark ML's metadata and candidate splits of the data, or None where a feature is categorical."""
    jvm, rf_java, jdf = spark._jvm, rf._java_obj, data._jdf
    one = lambda name: getattr(getattr(jvm, name + "$"), "MODULE$")
    rf._transfer_params_to_java()
    impl, util = "org.apache.spark.ml.tree.impl.", "org.apache.spark.ml.util."
    categorical = one(util + "MetadataUtils").getCategoricalFeatures(jdf.schema().apply(rf.getFeaturesCol()))
    if not categorical.isEmpty():
        return None
    sets = one(util + "DatasetUtils")
    classes = sets.getNumClasses(jdf, rf.getLabelCol(), 100)
    rows = sets.extractInstances(rf_java, jdf, jvm.scala.Option.apply(classes))
    kind = one("org.apache.spark.mllib.tree.configuration.Algo").Classification()
    strategy = rf_java.getOldStrategy(categorical, classes, kind, rf_java.getOldImpurity())
    meta = one(impl + "DecisionTreeMetadata").buildMetadata(rows, strategy, rf.getNumTrees(), rf.getFeatureSubsetStrategy())
    splits = one(impl + "RandomForest").findSplits(rows, meta, rf.getSeed())
    thresholds = [np.array([s.threshold() for s in of_feature]) for of_feature in splits]
    return classes, thresholds, meta.numFeaturesPerNode()


def _tree_order(spark):
    """Trees in the order in which Spark ML's hash map of a group gives them."""
    known: dict[tuple[int, ...], list[int]] = {}

    def order(trees: list[int]) -> list[int]:
        if tuple(trees) not in known:
            jvm = spark._jvm
            mutable = getattr(getattr(jvm, "scala.collection.mutable.HashMap$"), "MODULE$").empty()
            for t in trees:
                mutable.put(t, t)
            keys = mutable.toMap(getattr(getattr(jvm, "scala.$less$colon$less$"), "MODULE$").refl()).keysIterator()
            out = []
            while keys.hasNext():
                out.append(int(keys.next()))
            known[tuple(trees)] = out
        return known[tuple(trees)]

    return order


def grow(rf, data: DataFrame):
    """(nodes, thresholds, classes) of the forest that ``rf.fit(data)`` grows; None where a feature is categorical."""
    from pyspark.ml.functions import vector_to_array

    spark = data.sparkSession
    sc = spark.sparkContext
    prepared = _prepared(spark, rf, data)
    if prepared is None:
        return None
    classes, thresholds, per_node = prepared
    trees, slots = rf.getNumTrees(), max(2, sc.defaultParallelism)
    n_bins = np.array([len(t) + 1 for t in thresholds])
    bins = max(2, int(n_bins.max(initial=2)))
    growth = Growth(trees, classes, n_bins, per_node, rf.getMaxDepth(), rf.getMaxMemoryInMB() << 20, rf.getSeed(), _tree_order(spark))
    read = data.select(F.col(rf.getLabelCol()).alias("y"), vector_to_array(rf.getFeaturesCol()).alias("x"))
    seed = rf.getSeed()
    cut = partial(_blocks, thresholds=thresholds, trees=trees, seed=seed, classes=classes)
    base = read.mapInArrow(lambda batches: cut(batches), "block binary").rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK)
    passes, whole, kept = [], False, 0
    try:
        while growth.stack:
            top = np.array(growth.stack, np.int64)
            largest, rows = growth.value.all[top].sum(1).max(), growth.value.all[top].sum()
            if not whole and growth.tree.n > trees and largest <= min(DEALT_ROWS, max(1000, rows // (4 * slots))):
                base, passes, whole, kept = dealt(base, growth, top, passes, slots), [], True, kept + 1
            elif len(passes) >= REBASE:
                kept += 1
                base, passes = _renewed(base, base.mapPartitions, _kept, passes, kept % 10 == 0), []
            nodes, features = growth.group()
            shared = sc.broadcast((passes, growth.shared(nodes, features)))
            if whole:
                found = base.mapPartitions(partial(_local, shared=shared, classes=classes, bins=bins)).collect()
            else:
                reducers = min(slots, len(nodes))
                found = (base.mapPartitions(partial(_counted, shared=shared, classes=classes, bins=bins, reducers=reducers)).partitionBy(reducers, int)
                         .mapPartitions(partial(_summed, classes=classes, bins=bins, k=features.shape[1])).collect())
            shared.destroy()
            passes.append(growth.take(nodes, features, found))
    finally:
        base.unpersist()
    return growth.nodes(), thresholds, classes


def _renewed(base, through, task, values, checkpoint: bool = False, then=lambda rdd: rdd):
    """The rows after ``task``, kept in place of ``base``."""
    shared = base.context.broadcast(values)
    new = then(through(partial(task, shared=shared))).persist(StorageLevel.MEMORY_AND_DISK)
    if checkpoint:
        new.checkpoint()
    new.count()
    base.unpersist()
    return new


def dealt(base, growth: Growth, top: np.ndarray, passes: list, slots: int):
    """Every open node with all its rows in one partition, the partitions alike in rows."""
    key, n = growth.tree.all[top].astype(np.int64) << 32 | growth.id.all[top], growth.value.all[top].sum(1)
    partition, load = np.zeros(len(top), np.int64), np.zeros(slots)
    for i in np.argsort(-n, kind="stable").tolist():
        partition[i] = j = load.argmin()
        load[j] += n[i] + 1
    order = np.argsort(key)
    return _renewed(base, base.mapPartitions, _dealt, (passes, key[order], partition[order]),
                    then=lambda pieces: pieces.partitionBy(slots, int).mapPartitions(_gathered))


def _packed(nodes: dict[str, np.ndarray], thresholds: list[np.ndarray], classes: int):
    """The nodes in Spark ML's format, ``PACKED`` at a time, as compressed Arrow messages."""
    import pyarrow as pa

    starts, flat, n = np.concatenate([[0], np.cumsum([len(t) for t in thresholds])]), np.concatenate([*thresholds, [0.0]]), np.int32
    for i in range(0, len(nodes["id"]), PACKED):
        at = {k: v[i:i + PACKED] for k, v in nodes.items()}
        inner, count = at["inner"], len(at["id"])
        threshold = flat[starts[at["feature"][inner]] + at["bin"][inner]]
        stats = pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=n) * n(classes)), pa.array(at["value"].astype(np.float64).ravel()))
        cut = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(inner)]).astype(n)), pa.array(threshold))
        split = pa.StructArray.from_arrays([pa.array(at["feature"].astype(n)), cut, pa.array(np.full(count, -1, n))], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        fields = {"id": at["id"].astype(n), "prediction": at["prediction"].astype(np.float64), "impurity": at["impurity"], "impurityStats": stats,
                  "rawCount": at["value"].sum(1, dtype=np.int64), "gain": at["gain"], "leftChild": at["left"].astype(n), "rightChild": at["right"].astype(n), "split": split}
        data = pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in fields.values()], list(fields))
        batch = pa.RecordBatch.from_arrays([pa.array(at["tree"].astype(n)), data], ["treeID", "nodeData"])
        with pa.ipc.new_stream(sink := pa.BufferOutputStream(), batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch)
        yield sink.getvalue().to_pybytes()


def _unpacked(batches):
    import pyarrow as pa

    for batch in batches:
        for block in batch.column(0):
            yield from pa.ipc.open_stream(block.as_buffer())


def save(spark, rf, grown, path: str) -> None:
    """The grown forest in the format in which Spark ML saves a RandomForestClassificationModel."""
    nodes, thresholds, classes = grown
    parts = list(_packed(nodes, thresholds, classes))
    rdd = spark.sparkContext.parallelize(parts, min(len(parts), max(2, spark.sparkContext.defaultParallelism))).map(lambda b: (bytearray(b),))
    spark.createDataFrame(rdd, "block binary").mapInArrow(_unpacked, NODES).write.mode("overwrite").parquet(f"{path}/data")

    names = lambda params: {p.name: v for p, v in params.items()}
    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    own, default = names(rf._paramMap), names(rf._defaultParamMap)
    model = {"class": "org.apache.spark.ml.classification.RandomForestClassificationModel", **about, "uid": rf.uid, "paramMap": own, "defaultParamMap": default,
             "numFeatures": len(thresholds), "numClasses": classes, "numTrees": rf.getNumTrees()}
    of_trees = {"numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap"}
    tree = {"class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel", **about,
            "paramMap": {k: v for k, v in own.items() if k not in of_trees}, "defaultParamMap": {k: v for k, v in default.items() if k not in of_trees}}
    spark.createDataFrame([(json.dumps(model),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
    about_trees = [(t, json.dumps(tree | {"uid": f"dtc_{uuid.uuid4().hex[:12]}"}), 1.0) for t in range(rf.getNumTrees())]
    spark.createDataFrame(about_trees, "_1 int, _2 string, _3 double").coalesce(1).write.mode("overwrite").parquet(f"{path}/treesMetadata")


class SavedForest:
    """A forest saved in Spark ML's format; Spark's model is read from there when something else is asked of it."""

    def __init__(self, path: str, num_features: int):
        self.path, self.numFeatures, self._model = path, num_features, None

    def __getattr__(self, name):
        if name.startswith("__") or name == "_model":
            raise AttributeError(name)
        if self._model is None:
            from pyspark.ml.classification import RandomForestClassificationModel

            self._model = RandomForestClassificationModel.load(self.path)
        return getattr(self._model, name)
