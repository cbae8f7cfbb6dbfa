"""Shards by a k-d tree over metadata, cut at distributed weighted medians.

Every node is split along the dimension in which its rows spread widest, at the
point that divides its bytes in proportion to the leaves on either side, until
a leaf is one shard.  A dimension's key is its coordinate followed by a hash of
the row, so a value shared by a third of all rows is divided like any other.

A weighted median is found by histogram refinement: all nodes of a level
together, each pass sums the bytes of ``BUCKETS`` ranges per node and narrows
to the range that holds the median, until that range weighs next to nothing.
Only the crossing range of each node reaches the driver.  All of it is native
DataFrame work on a narrow written table (no text).

Defined results: a null text has no bytes; null metadata is a value of its own;
repeated rows are placed each; an empty table gives an empty result.  The law
is ``bytes``: shard sizes are near equal; equal texts may be in several shards.
Only the id, the text and the metadata columns named are read; the table must
have these (``categories=()`` leaves the size as the only dimension).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadwright.llm.common import settle

BUCKETS = 4096
#: A range of this share of its node's bytes needs no further refinement.
CLOSE = 2e-4
COORDINATE_BITS, TIE_BITS = 30, 32
#: Rows numbered in one task when slots are given.
SLOT_ROWS = 100_000


def _hashed(column: str) -> Column:
    return F.when(F.col(column).isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(column), F.lit((1 << COORDINATE_BITS) - 1)) + 1)


def _scaled(size: Column) -> Column:
    """Sizes on a logarithmic scale up to 2**40."""
    return (F.least(F.log2(size) / 40, F.lit(1.0)) * ((1 << COORDINATE_BITS) - 1)).cast("long")


@dataclass
class Node:
    """An open node: its leaves are shards ``first`` to ``first + leaves - 1``."""

    id: int
    first: int
    leaves: int
    dim: int = 0
    low: int = 0
    width: int = 1
    before: int = 0   # bytes below ``low``
    target: float = 0
    cut: int | None = None


def metadata(docs: DataFrame, categories: tuple[str, ...]) -> DataFrame:
    """The narrow table that the tree is built on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    meta = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32"),
                       *(_hashed(c).alias(f"x{i}") for i, c in enumerate(categories)), _scaled(size).alias(f"x{len(categories)}"),
                       F.monotonically_increasing_id().alias("row"))
    meta = settle(meta, "shard-rows")  # from here on a row keeps its number
    tie = F.pmod(F.xxhash64("row"), F.lit(1 << TIE_BITS))
    keys = F.array(*((F.col(f"x{i}") * F.lit(1 << TIE_BITS) + tie) for i in range(len(categories) + 1)))
    return meta.select("doc_id", "size", "text_crc32", "row", keys.alias("keys"))


def _values(df: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small local table (one row per node at most)."""
    values = ", ".join("(" + ", ".join(f"{int(v)}L" for v in r) + ")" for r in rows)
    return df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def _widest(rows: DataFrame, nodes: list[Node], dims: int, span: list[int]) -> None:
    """Gives each node its widest dimension, that one's range and the bytes to the left of the cut."""
    low = [F.min(F.col("keys")[d]).alias(f"a{d}") for d in range(dims)]
    high = [F.max(F.col("keys")[d]).alias(f"b{d}") for d in range(dims)]
    found = {r.node: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *low, *high).collect()}
    for n in nodes:
        r = found.get(n.id)
        if r is None:
            continue
        wide = [(r[f"b{d}"] - r[f"a{d}"]) / max(1, span[d]) for d in range(dims)]
        n.dim = max(range(dims), key=lambda d: (wide[d], -d))
        n.low, high_key = r[f"a{n.dim}"], r[f"b{n.dim}"]
        n.width = max(1, -(-(high_key + 1 - n.low) // BUCKETS))
        n.target = r.bytes * (n.leaves // 2) / n.leaves
        n.before = 0
        n.cut = None if n.leaves > 1 else n.low


def _narrow(rows: DataFrame, nodes: list[Node], close: dict[int, float]) -> None:
    """One pass: the range of each open node that its weighted median falls in."""
    ask = _values(rows, ["n", "dim", "low", "width", "need"], [(n.id, n.dim, n.low, n.width, max(0, round(n.target - n.before))) for n in nodes])
    key = F.element_at("keys", (F.col("dim") + 1).cast("int"))
    inside = rows.join(F.broadcast(ask), rows["node"] == ask["n"]).where((key >= F.col("low")) & (key < F.col("low") + F.col("width") * BUCKETS))
    bucket = F.call_function("div", key - F.col("low"), F.col("width"))  # whole-number division
    sums = inside.groupBy("node", bucket.alias("bucket"), "need").agg(F.sum("size").alias("bytes"))
    upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("bucket"))
    crossing = sums.withColumn("upto", upto).where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("bytes") < F.greatest("need", F.lit(1))))
    got = {r.node: r for r in crossing.collect()}
    for n in nodes:
        r = got.get(n.id)
        if r is None:  # nothing to divide
            n.cut = n.low
            continue
        left = n.before + r.upto - r.bytes
        low = n.low + r.bucket * n.width
        if n.width == 1 or r.bytes <= close[n.id]:
            n.cut = low if n.target - left < left + r.bytes - n.target else low + n.width
        else:
            n.before, n.low, n.width = left, low, max(1, -(-n.width // BUCKETS))


def assign(docs: DataFrame, shards: int = 16, categories: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs``."""
    rows = metadata(docs, categories).withColumn("node", F.lit(1).cast("long"))
    dims = len(categories) + 1
    span = [(1 << COORDINATE_BITS + TIE_BITS)] * dims
    nodes, leaves = [Node(1, 0, shards)], {}
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    while nodes:
        open_ = [n for n in nodes if n.leaves > 1]
        leaves |= {n.id: n.first for n in nodes if n.leaves == 1}
        if not open_:
            break
        _widest(rows, open_, dims, span)
        close = {n.id: CLOSE * n.target for n in open_}
        while todo := [n for n in open_ if n.cut is None]:
            _narrow(rows, todo, close)
        cuts = _values(rows, ["n", "dim", "cut"], [(n.id, n.dim, n.cut) for n in open_])
        right = F.element_at("keys", (F.col("dim") + 1).cast("int")) >= F.col("cut")
        joined = rows.join(F.broadcast(cuts), rows["node"] == cuts["n"], "left")
        node = F.when(F.col("n").isNull(), F.col("node")).otherwise(F.col("node") * 2 + right.cast("long"))
        rows = settle(joined.select("doc_id", "size", "text_crc32", "row", "keys", node.alias("node")), "shard-level")
        nodes = [c for n in open_ for c in (Node(2 * n.id, n.first, n.leaves // 2), Node(2 * n.id + 1, n.first + n.leaves // 2, n.leaves - n.leaves // 2))]
    names = _values(rows, ["n", "shard"], sorted(leaves.items()))
    placed = rows.join(F.broadcast(names), rows["node"] == names["n"]).select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "row")
    return _slots(placed, max(1, -(-total["n"] // SLOT_ROWS)))


def _slots(placed: DataFrame, parts: int) -> DataFrame:
    """Gapless numbers within each shard: counted per part of a shard, then numbered within it."""
    part = F.pmod(F.xxhash64(F.lit(5), "row"), F.lit(parts)).alias("part")
    rows = placed.select("*", part)
    sizes = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select(F.col("shard").alias("s"), F.col("part").alias("p"),
                          (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    numbered = rows.withColumn("own", own)
    return numbered.join(before, (F.col("shard") == F.col("s")) & (F.col("part") == F.col("p"))).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("own")).alias("slot"))
