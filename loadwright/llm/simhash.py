"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64-bit SimHashes of 3-word shingles.  Distinct fingerprints
within ``max_bits`` of each other are linked:

1. bits that correlate (on a bounded sample of fingerprints) are grouped into
   the same partition, so that the skew sits in few partitions;
2. dynamic programming gives every partition its own threshold ``t_i >= -1``
   with ``sum(t_i) = max_bits - m + 1``.  Any pair within ``max_bits`` differs
   by at most ``t_i`` bits in some partition, so no link is lost.  The costs
   are estimated candidate counts plus probe rows; the number of partitions
   is chosen the same way;
3. each fingerprint probes the keys within ``t_i`` bits of its own; a hash
   join finds the candidates and checks the full distance in its condition,
   so only true links leave the join;
4. links become components by alternating star contraction;
5. documents meet their components by fingerprint and salt: a fingerprint that
   many copies share is dealt over up to ``SALTS`` keys, one that is alone has one.

The sample steers cost only; every fingerprint is indexed and probed.

Defined results: a null or empty text has fingerprint zero and links like any
other; repeated rows share a component; a null ``doc_id`` never is a
``component_id`` unless all ids of its component are null; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwright.llm.common import fresh, map_batches, settle

SHINGLE_WORDS = 3
MAX_BITS = 3
#: Fingerprints looked at to estimate costs (never to find links).
COST_SAMPLE = 2048
#: Cost of one probe row, in units of one candidate pair checked in the join.
PROBE_COST = 4.0
#: Keys that the copies of one fingerprint are dealt over (bits of a long).
SALTS = 64


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of ``text``; repeated shingles count each time."""
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    if len(w) < words:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(words))))
    n, ones = max(1, len(w) - words + 1), np.zeros(64, np.int64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), "<u8", count=n)
    for at in range(0, n, 1 << 16):  # bits of a very long text a block at a time
        block = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp long): one row per row of ``docs``."""

    def run(batches):
        last = {}  # copies often sit close together
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                if t not in last:
                    if len(last) > 64:
                        last.clear()
                    last[t] = simhash(t, shingle_words)
                out.append(last[t])
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(out, pa.int64())], ["doc_id", "fp"])

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), "text"], "doc_id long, fp long", run)


def group_bits(bits: np.ndarray, m: int) -> list[list[int]]:
    """64 positions in ``m`` groups; each takes the bits that correlate most with it."""
    if len(bits) > 2:
        with np.errstate(invalid="ignore", divide="ignore"):
            corr = np.abs(np.nan_to_num(np.corrcoef(bits.T.astype(float))))
    else:
        corr = np.zeros((64, 64))
    np.fill_diagonal(corr, 0)
    left, groups = set(range(64)), []
    for i in range(m):
        size = 64 * (i + 1) // m - 64 * i // m
        rest = sorted(left)
        group = [max(rest, key=lambda b: (corr[b, rest].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            nxt = max(sorted(left), key=lambda b: (corr[b, group].sum(), -b))
            group.append(nxt)
            left.remove(nxt)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up, summing to ``total``, of least cost.

    ``costs[i][t + 1]`` is the cost of threshold ``t`` in partition ``i``.
    """
    best = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, ts) in best.items():
            for t, c in enumerate(row, -1):
                if done + t not in step or cost + c < step[done + t][0]:
                    step[done + t] = (cost + c, [*ts, t])
        best = step
    return best[total]


def plan_partitions(sample: list[int], n: int, max_bits: int = MAX_BITS) -> list[tuple[list[int], int]]:
    """[(bit positions, threshold)] for ``n`` distinct fingerprints."""
    fp = np.array(sample, np.int64).view(np.uint64)
    bits = (fp[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    pairs = max(1, len(fp) * (len(fp) - 1) // 2)
    choices = []
    for m in range(1, max_bits + 2):
        groups, costs = group_bits(bits, m), []
        for g in groups:
            mask = np.uint64(sum(1 << b for b in g))
            seen = np.zeros(max_bits + 1)
            for i in range(len(fp) - 1):
                d = np.bitwise_count((fp[i] ^ fp[i + 1:]) & mask)
                seen += np.bincount(d[d <= max_bits], minlength=max_bits + 1)
            row, volume = [0.0], 0
            for t in range(max_bits + 1):
                volume += comb(len(g), t)
                share = max(seen[:t + 1].sum() / pairs, volume / 2.0 ** len(g))
                row.append(n * volume * PROBE_COST + n * n / 2 * share)
            costs.append(row)
        cost, ts = allocate(costs, max_bits - m + 1)
        choices.append((cost, m, list(zip(groups, ts))))
    return min(choices)[2]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _near_keys(part: int, own: Column, flips: list[int]) -> Column:
    """(part, key) of every key that differs from ``own`` by one of ``flips``."""
    near = F.transform(F.array(*map(F.lit, flips)), lambda f: own.bitwiseXOR(f))
    return F.transform(near, lambda k: F.struct(F.lit(part).alias("part"), k.alias("key")))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: distinct fingerprints ``fps.fp`` within ``max_bits`` bits."""
    n = fps.count()
    sample = [r.fp for r in fps.orderBy(F.xxhash64("fp")).limit(COST_SAMPLE).collect()]
    plan = [(g, t) for g, t in plan_partitions(sample, n, max_bits) if t >= 0]
    keys, probes = [], []
    for i, (group, t) in enumerate(plan):
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in group))))
        keys.append(F.struct(F.lit(i).alias("part"), own.alias("key")))
        flips = [_signed(sum(1 << b for b in c)) for k in range(t + 1) for c in combinations(group, k)]
        probes.append(_near_keys(i, own, flips))
    index = fps.select(F.col("fp").alias("b"), F.explode(F.array(*keys)).alias("k")).select("b", "k.part", "k.key")
    probe = fps.select(F.col("fp").alias("a"), F.explode(F.concat(*probes)).alias("k")).select("a", "k.part", "k.key")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    found = probe.alias("p").join(index.alias("i"), (F.col("p.part") == F.col("i.part"))
                                  & (F.col("p.key") == F.col("i.key")) & near)
    return found.select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b).

    Alternates large-star and small-star contraction; each round is written to
    the shared folder, so a lost executor costs one round at most.  The number
    of rounds grows with the logarithm of the longest chain.
    """
    edges = settle(edges.select("a", "b"), "star")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        low = low.select("n", F.least("n", "m").alias("m"))
        large = both.join(low, both["a"] == low["n"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every edge now points down, from a to a smaller b
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        hung = large.join(low, large["a"] == low["n"])
        small = hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("n", "m")).distinct()
        edges = settle(small, "star")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if now == state:
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))
        state = now


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``."""
    rows = settle(fingerprints(docs, shingle_words), "fingerprints")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    bit = F.expr("shiftleft(1L, salt)")
    fps = settle(salted.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.bit_or(bit).alias("salts")), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), max_bits))
    linked = fps.join(roots, fps["fp"] == roots["node"])
    least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    linked = linked.join(least, "root").select(F.col("fp").alias("fp2"), "least_id")
    used = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit("salts", i) == 1)
    groups = fps.join(linked, fps["fp"] == linked["fp2"], "left").select(
        F.col("fp").alias("fp3"), F.when(F.col("fp2").isNull(), F.col("first_id")).otherwise(F.col("least_id")).alias("component_id"),
        F.explode(used).alias("salt3"))
    same = (salted["fp"] == groups["fp3"]) & (salted["salt"] == groups["salt3"])
    return salted.join(groups, same, "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without near-duplicates: of each component one row stays.

    That is the row with the smallest ``doc_id``; where rows repeat that id, the
    one with the smallest fingerprint, once.  A component in which no row has
    an id keeps one row of each fingerprint.
    """
    found = settle(near_duplicates(docs, shingle_words, max_bits), "components")
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = settle(ids.where("n > 1 OR doc_id IS NULL").select("doc_id"), "repeated-ids")
    chosen = found.where("doc_id = component_id").select("doc_id").distinct()
    plain = docs.join(chosen, docs["doc_id"].cast("long") == chosen["doc_id"], "left_semi")
    if again.isEmpty():
        return plain
    # Rows that share a doc_id (or have none): settle them by their fingerprint.
    single = plain.join(again, plain["doc_id"].cast("long") == again["doc_id"], "left_anti")
    some = docs.join(again, docs["doc_id"].cast("long").eqNullSafe(again["doc_id"]), "left_semi")
    pick = (found.where("doc_id = component_id").join(again, "doc_id", "left_semi")
            .groupBy(F.col("doc_id").alias("id")).agg(F.min("fingerprint").alias("least")))
    nameless = found.where("component_id IS NULL").select("fingerprint").distinct()
    fp = fresh("_fp", docs.columns)
    print_of = F.udf(lambda t: format(simhash(t, shingle_words) & (1 << 64) - 1, "016x"), "string")
    marked = some.withColumn(fp, print_of("text"))
    named = marked.join(pick, (marked["doc_id"].cast("long") == pick["id"]) & (marked[fp] == pick["least"]), "left_semi")
    orphan = marked.where("doc_id IS NULL").join(nameless, marked[fp] == nameless["fingerprint"], "left_semi")
    return single.unionByName(named.unionByName(orphan).dropDuplicates(["doc_id", fp]).drop(fp))
