"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation's turns are numbered, rebuilt (a shared head, then its own rest)
and laid out in blocks of ``WIDTH`` turn-id columns.  One ``GROUP BY .. ROLLUP``
over the columns of all blocks aggregates every prefix at once; ``grouping_id``
tells how many of a block's columns a group holds.  A long conversation goes on
in further blocks, each keyed by the node that the block before it ends in, so
the number of jobs does not depend on how long conversations are.

* A turn's id is the SHA-256 of its role and text, with its word count.
* A node's key is 128 bits: the exclusive or, over the node's path, of hashes of
  (position, turn id).  A block's key and a node's parent follow from it without
  a join, and a conversation is never gathered in one row.
* Subtree figures take no walk over the trie.  A node counts at its smallest
  member: ``n_leaves`` and ``saved_tokens`` are sums, in a second ROLLUP, of
  what the members' paths hold from that depth on.

Turns are numbered over range partitions of (conversation, turn), and running
sums are taken over chunks of ``CHUNK`` blocks first, so one conversation may
hold a third of all turns.  The member list of a node is hashed from sorted runs
of ids, read one after another.

Defined results: a null role or text is empty; a null turn sorts first; turns
that tie are ordered by role, then text; repeated rows are turns each; rows
without ``conv_id`` belong to no conversation; ``c - c % 20`` truncates towards
zero; an empty table has no root and gives no row.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadwright.llm.common import settle, small_batches

WIDTH = 8
#: Blocks whose running sums one task takes.
CHUNK = 512
#: Conversation ids joined into one run of a member list.
RUN_IDS = 4096
#: Conversations that share a head, and the most turns of a head plus one (fixed values).
FAMILY, HEAD = 20, 4

_WORD = r"[^\x20\x09-\x0D]+"
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _bits(position: Column, turn: Column) -> tuple[Column, Column]:
    """128 hash bits of a turn at a position, as two longs."""
    return tuple(F.xxhash64(F.lit(seed), position.cast("long"), turn) for seed in (1, 2))


def _head(conv: Column) -> Column:
    return F.pmod(F.crc32(conv.cast("string")), F.lit(HEAD)).cast("long")


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn): every turn's id at its place in its conversation.

    Rows are range-partitioned by conversation, turn, role and text (and their
    place in the input, so even equal rows are spread) and counted by partition.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("at"), empty("role").alias("role"), empty("text").alias("text"),
        F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv_id"), F.col("at").asc_nulls_first(), F.col("role"), F.col("text"), F.col("row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sha = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    words = F.lpad(F.hex(F.regexp_count("text", F.lit(_WORD)).cast("long")), 16, "0")
    place = F.monotonically_increasing_id()
    placed = settle(ranged.select("conv_id", F.concat(sha, F.unhex(words)).alias("turn"), F.shiftright(place, 33).alias("part"),
                                  place.bitwiseAND(F.lit((1 << 33) - 1)).alias("idx")), "trie-turns")
    parts = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("least"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    offsets = parts.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), (before - F.col("least")).alias("shift"))
    # a conversation within one partition, as nearly all are, has one offset row
    joined = placed.join(offsets, (F.col("conv_id") == F.col("c")) & (F.col("part") == F.col("p")))
    return joined.select("conv_id", (F.col("idx") + F.col("shift")).alias("pos"), "turn")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of every conversation, and (conv_id, pos, turn) with its head taken from its family."""
    convs = turns.groupBy("conv_id").agg(F.lit(1).alias("one")).select("conv_id")
    base = F.col("conv_id") - F.col("conv_id") % F.lit(FAMILY)
    heads = turns.where((F.col("conv_id") % F.lit(FAMILY) == 0) & (F.col("pos") < HEAD - 1)).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("head_pos"), F.col("turn").alias("head_turn"))
    taken = convs.join(heads, (base == F.col("base")) & (F.col("head_pos") < _head(F.col("conv_id")))).select(
        "conv_id", F.col("head_pos").alias("pos"), F.col("head_turn").alias("turn"))
    # where the family's first conversation is shorter than the head, the own rest moves up
    size = heads.groupBy("base").agg(F.count(F.lit(1)).alias("have"))
    short = convs.join(size, base == F.col("base"), "left").select(
        F.col("conv_id").alias("c"), F.greatest(_head(F.col("conv_id")) - F.coalesce("have", F.lit(0)), F.lit(0)).alias("gap")).where("gap > 0")
    own = turns.where(F.col("pos") >= _head(F.col("conv_id"))).join(short, F.col("conv_id") == F.col("c"), "left").select(
        "conv_id", (F.col("pos") - F.coalesce("gap", F.lit(0))).alias("pos"), "turn")
    return convs, taken.unionByName(own)


def _columns(prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(WIDTH)]


def _running(rows: DataFrame, values: list[str], how, forward: bool = True) -> DataFrame:
    """Adds ``before_<value>``: ``how`` of a value over the conversation's earlier (or later) blocks; null for none.

    Rows are one per conversation and block.  Sums run within chunks of blocks,
    then over the chunks, so no task takes a whole long conversation.
    """
    chunk = F.call_function("div", F.col("block"), F.lit(CHUNK)).alias("chunk")
    rows = rows.select("*", chunk)
    ordered = lambda c: F.col(c) if forward else F.col(c).desc()
    window = lambda keys, by: Window.partitionBy(*keys).orderBy(ordered(by)).rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.select("*", *(how(v).over(window(["conv_id", "chunk"], "block")).alias(f"in_{v}") for v in values))
    totals = rows.groupBy("conv_id", "chunk").agg(*(how(v).alias(v) for v in values))
    earlier = totals.select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"),
                            *(how(v).over(window(["conv_id"], "chunk")).alias(f"to_{v}") for v in values)).where(
        F.coalesce(*(f"to_{v}" for v in values)).isNotNull())  # conversations of one chunk have none
    joined = inside.join(earlier, (F.col("conv_id") == F.col("c")) & (F.col("chunk") == F.col("k")), "left")
    both = lambda v: how_two(how, F.col(f"to_{v}"), F.col(f"in_{v}"))
    return joined.select(*[c for c in rows.columns if c != "chunk"], *(both(v).alias(f"before_{v}") for v in values))


def how_two(how, a: Column, b: Column) -> Column:
    """``how`` (sum or exclusive or) of two values, where a null is no value."""
    zero = F.lit(0).cast("long")
    a, b = F.coalesce(a, zero), F.coalesce(b, zero)
    return a.bitwiseXOR(b) if how is F.bit_xor else a + b


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, key1, key2, t0..): one row per conversation and ``WIDTH`` turns; the key is the node they start from."""
    b1, b2 = _bits(F.col("pos"), F.col("turn"))
    rows = turns.select("conv_id", F.call_function("div", F.col("pos"), F.lit(WIDTH)).alias("block"), (F.col("pos") % WIDTH).alias("slot"),
                        "turn", b1.alias("x1"), b2.alias("x2"))
    by_slot = [F.max(F.when(F.col("slot") == i, F.col("turn"))).alias(t) for i, t in enumerate(_columns("t"))]
    laid = settle(rows.groupBy("conv_id", "block").agg(*by_slot, F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2")), "trie-blocks")
    keyed = _running(laid, ["x1", "x2"], F.bit_xor)
    return settle(keyed.withColumnsRenamed({"before_x1": "key1", "before_x2": "key2"}).drop("x1", "x2"), "trie-keyed")


def _rolled(laid: DataFrame, measures: list[Column]) -> DataFrame:
    """One row per (node, block that ends in it): depth, keys of node and parent, last turn, ``measures``.

    ROLLUP groups by the block's key and its first 0, 1, .. columns; groups whose
    last column is null hold shorter conversations and are left out.
    """
    turns = _columns("t")
    view = laid.select("block", F.col("key1").alias("p1"), F.col("key2").alias("p2"), *turns, *measures)
    names = [c for c in view.columns if c not in ("block", "p1", "p2", *turns)]
    aggregates = ", ".join(f"{'min' if n == 'conv_id' else 'sum'}({n}) AS {n}" for n in names)
    rolled = laid.sparkSession.sql(
        f"SELECT block, p1, p2, {', '.join(turns)}, grouping_id() AS gid, count(1) AS n, {aggregates} "
        f"FROM {{view}} GROUP BY block, p1, p2, ROLLUP({', '.join(turns)})", view=view)
    # grouping_id has a bit for each column rolled away: 2**k - 1 for the k last ones
    held = F.lit(WIDTH) - F.bit_count("gid").cast("int")
    rolled = rolled.withColumn("held", held).where("held > 0")
    last = F.coalesce(*(F.when(F.col("held") == i + 1, F.col(t)) for i, t in enumerate(turns)))
    rolled = rolled.withColumn("last", last).where("last IS NOT NULL")
    key, parent = [F.col("p1"), F.col("p2")], [F.col("p1"), F.col("p2")]
    for i, t in enumerate(turns):
        bits = _bits(F.col("block") * WIDTH + i, F.col(t))
        zero = F.lit(0).cast("long")
        key = [k.bitwiseXOR(F.when(F.col("held") > i, b).otherwise(zero)) for k, b in zip(key, bits)]
        parent = [k.bitwiseXOR(F.when(F.col("held") > i + 1, b).otherwise(zero)) for k, b in zip(parent, bits)]
    chosen = [F.coalesce(*(F.when(F.col("held") == i + 1, F.col(f"s{i}")) for i in range(WIDTH))).alias("saved")] if "s0" in names else []
    words = F.conv(F.hex(F.substring("last", 33, 8)), 16, 10).cast("long")
    return rolled.select((F.col("block") * WIDTH + F.col("held")).alias("depth"), key[0].alias("k1"), key[1].alias("k2"),
                         parent[0].alias("u1"), parent[1].alias("u2"), words.alias("words"), "n",
                         *(c for c in names if not c[1:].isdigit()), *chosen)


def _member_hashes(ends: DataFrame) -> DataFrame:
    """(k1, k2, depth, ends_sha256) of the nodes at which conversations end, from (k1, k2, depth, conv_id)."""
    small_batches(ends.sparkSession)
    node = ["k1", "k2", "depth"]
    arrow = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64())])

    def groups(batches: Iterator[pa.RecordBatch], most: int | None):
        """(node, list of values) of neighbouring rows of one node, at most ``most`` rows each; the last of a node is not marked."""
        at, values = None, []
        for b in batches:
            for *key, value in zip(*(c.to_pylist() for c in b.columns)):
                if values and (key != at or len(values) == most):
                    yield at, values
                    values = []
                at = key
                values.append(value)
        if values:
            yield at, values

    def runs(batches):
        for key, ids in groups(batches, RUN_IDS):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()) for k in key] + [pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))], pa.string())],
                                             schema=pa.schema([*arrow, ("first", pa.int64()), ("ids", pa.string())]))

    def hashes(batches):
        at, state, rows = None, None, []

        def out():
            done = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t.type) for i, t in enumerate([*arrow, pa.field("s", pa.string())])],
                                              names=[*node, "ends_sha256"])
            rows.clear()
            return done

        for b in batches:
            for *key, ids in zip(*(c.to_pylist() for c in b.columns)):
                if key != at:
                    if state:
                        rows.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(rows) >= 1000:
                yield out()
        if state:
            rows.append((*at, state.hexdigest()))
        if rows:
            yield out()

    sorted_ids = ends.select(*node, "conv_id").repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id")
    parts = sorted_ids.mapInArrow(runs, "k1 long, k2 long, depth long, first long, ids string")
    return parts.repartition(*node).sortWithinPartitions(*node, "first").select(*node, "ids").mapInArrow(hashes, "k1 long, k2 long, depth long, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    convs, turns = rebuilt(numbered(conversations))
    convs = settle(convs, "trie-convs")
    laid = blocks(turns)
    nodes = settle(_rolled(laid, [F.col("conv_id")]), "trie-nodes")
    children = nodes.groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))

    # what a conversation's path holds of the nodes whose smallest member it is
    gain = (F.col("n") - 1) * F.col("words")
    slot = (F.col("depth") - 1) % WIDTH
    own = nodes.where("n > 1").select(F.col("conv_id").alias("c"), F.call_function("div", F.col("depth") - 1, F.lit(WIDTH)).alias("b"), slot.alias("slot"), gain.alias("gain"))
    own = own.groupBy("c", "b").agg(*(F.sum(F.when(F.col("slot") == i, F.col("gain")).otherwise(0)).alias(f"g{i}") for i in range(WIDTH)))
    leaf = nodes.join(children, ["k1", "k2", "depth"], "left_anti").select(
        F.col("conv_id").alias("c"), F.call_function("div", F.col("depth") - 1, F.lit(WIDTH)).alias("b"), F.lit(1).alias("is_leaf"))
    marks = own.join(leaf, ["c", "b"], "full")
    zero = F.lit(0).cast("long")
    held = [F.coalesce(f"g{i}", zero).alias(f"g{i}") for i in range(WIDTH)]
    with_own = laid.join(marks, (F.col("conv_id") == F.col("c")) & (F.col("block") == F.col("b")), "left").select(
        *laid.columns, *held, F.coalesce("is_leaf", zero).alias("leaf"))
    total = sum((F.col(f"g{i}") for i in range(1, WIDTH)), F.col("g0"))
    later = settle(_running(with_own.withColumn("all", total), ["all", "leaf"], F.sum, forward=False), "trie-gains")
    # of this block from a slot on, and of all later blocks
    suffix = [sum((F.col(f"g{j}") for j in range(i + 1, WIDTH)), F.col(f"g{i}") + F.col("before_all")).alias(f"s{i}") for i in range(WIDTH)]
    leaves = (F.col("leaf") + F.col("before_leaf")).alias("leaves")
    whole = _rolled(later, [F.col("conv_id"), leaves, *suffix]).select(
        "k1", "k2", "u1", "u2", "depth", "conv_id", "n", "leaves", "saved")

    parents = nodes.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent"))
    tip = laid.groupBy("conv_id").agg(F.max_by(F.struct("block", "key1", "key2", *_columns("t")), "block").alias("t")).select("conv_id", "t.*")
    size = sum((F.when(F.col(t).isNotNull(), 1).otherwise(0) for t in _columns("t")), F.lit(0))
    end = [F.col("key1"), F.col("key2")]
    for i, t in enumerate(_columns("t")):
        end = [k.bitwiseXOR(F.when(F.col(t).isNotNull(), b).otherwise(zero)) for k, b in zip(end, _bits(F.col("block") * WIDTH + i, F.col(t)))]
    ends = tip.select((F.col("block") * WIDTH + size).alias("depth"), end[0].alias("k1"), end[1].alias("k2"), "conv_id")
    turnless = convs.join(tip.select("conv_id"), "conv_id", "left_anti").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id")
    member = _member_hashes(ends.unionByName(turnless))

    first = later.where("block = 0").agg(F.coalesce(F.sum(F.col("all") + F.col("before_all")), zero).alias("saved"), F.coalesce(F.sum(F.col("leaf") + F.col("before_leaf")), zero).alias("leaves"))
    everyone = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).where("n > 0")
    whole_trie = first.select(F.struct("leaves", "saved")).scalar()  # one row, as is everyone
    root = everyone.withColumn("all", whole_trie).select(
        *(zero.alias(c) for c in ("k1", "k2", "u1", "u2", "depth")), "conv_id", "n", F.greatest("all.leaves", F.lit(1).cast("long")).alias("leaves"),
        F.col("all.saved").alias("saved"))
    least = everyone.select(F.col("conv_id")).scalar()
    # the root's children, perhaps a third of all nodes, take its id without the join
    deep = whole.join(parents, ["u1", "u2", "depth"], "left").withColumn("parent", F.when(F.col("depth") == 1, least).otherwise(F.col("parent")))
    every = deep.unionByName(root.withColumn("parent", F.lit(None).cast("long")))
    out = every.join(children, ["k1", "k2", "depth"], "left").join(member, ["k1", "k2", "depth"], "left")
    return out.select("conv_id", F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
                      F.coalesce("n_children", zero).alias("n_children"), F.col("leaves").cast("long").alias("n_leaves"),
                      F.col("saved").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"))
