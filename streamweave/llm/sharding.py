"""K-d tree sharding (operator 6): shards of nearly equal bytes, equal texts together.

The tree splits a node along the widest of its metadata dimensions (widths as shares of the whole table's), at the
weighted median of the rows' sizes, until each leaf is one shard's worth of bytes. Medians are found by all tasks
together: a round adds up the sizes of each node by one digit of the rows' place along the dimension, picks the
median's bucket in Spark, and the next round looks at the digit below inside it. All nodes of a level advance in one
round. Each row carries its node, written anew after each level, so plans don't grow with the tree. The driver sees
one row for each node and round and holds the cuts of a level: data that grow with the shards, never with the rows.

Rows of equal place are told apart by a hash of their text, so a cut never parts equal texts. If the median falls
inside the rows of one text (or into one long row) and both cuts beside them miss it, the node is split along the
next dimension, at last in the order of other hashes; only a text with several rows that is in the way in all of
them (it weighs about a shard or more) is parted, by doc_id. A lone row can't be parted: the nearest cut found counts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from streamweave.llm.common import scratch, stored

DIGIT = 12
#: Bits of a place: along the dimension, of the text's hash, of the hash of doc_id.
PLACE, HASH, ROW = 36, 48, 48
#: Digits of a place that are the same for equal texts, and all digits.
OF_TEXT, ALL = (PLACE + HASH) // DIGIT, (PLACE + HASH + ROW) // DIGIT
#: A median is close enough when its bucket holds this part of the node's bytes or less.
CLOSE = 0.0005
#: Part of a shard's bytes by which a cut beside one text's rows may miss the median.
MISS = 0.02
#: Further orders (by other hashes of the text) that are tried when a cut beside one text misses by more.
OTHERS = 4
#: Rows of a slice that is numbered in one task, on average.
SLICE = 20_000
#: Most shards: the nodes of a level, some 100 bytes each, are broadcast.
MOST_SHARDS = 1 << 20

NODE = ["node", "half", "axis", "mask_0", "cut_0", "mask_1", "cut_1", "mask_2", "cut_2", "which", "shift", "before_", "goal"]


def place(dim: str, low: float, high: float) -> Column:
    """Where a value lies between the table's least and largest, in steps of 2^-PLACE; null counts as least."""
    share = (F.coalesce(F.col(dim).cast("double"), F.lit(low)) - F.lit(low)) / F.lit(max(high - low, 1e-300))
    return F.floor(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * F.lit(float(2 ** PLACE - 1))).cast("bigint")


class Node:
    """A node of the tree: ``shards`` shards from number ``first`` on, and its cut so far.

    A row's key is (place along the axis, hash of its text, hash of its doc_id); the cut is such a key, found digit by
    digit. Rows below it go left: to the first half of the shards."""

    def __init__(self, shards: int, first: int):
        self.shards, self.first, self.half = shards, first, shards // 2
        self.axes, self.total, self.done, self.best = [], 0, False, None
        self.restart()

    def restart(self) -> None:
        self.at, self.cut, self.before = 0, [0, 0, 0], 0

    @property
    def goal(self) -> float:
        return self.total * self.half / self.shards

    def digit(self) -> tuple[int, int]:
        """(part of the key, shift) of the digit that is looked for."""
        bits = self.at * DIGIT
        for which, width in enumerate((PLACE, HASH, ROW)):
            if bits < width:
                return which, width - bits - DIGIT
            bits -= width
        return 2, 0

    def row(self) -> tuple:
        """The node as a row of NODE; masks cover the digits that are found."""
        out, bits = [], self.at * DIGIT
        for width, cut in zip((PLACE, HASH, ROW), self.cut):
            found = min(max(bits, 0), width)
            out += [(1 << width) - (1 << (width - found)), cut]
            bits -= width
        return (self.first, self.half, self.axes[0], *out, *self.digit(), self.before, self.goal)

    def found(self, value: int) -> None:
        which, shift = self.digit()
        self.cut[which] += value << shift
        self.at += 1

    def advance(self, value: int, before: int, size: int, rows: int, one_text: bool, shard_bytes: float) -> None:
        """Takes the bucket that holds the median: ``rows`` rows of ``size`` bytes, after ``before`` bytes."""
        miss, upper = min((abs(before - self.goal), False), (abs(before + size - self.goal), True))
        at = self.at + 1
        whole = at <= OF_TEXT and (one_text or at == OF_TEXT)
        if whole and size == self.total:
            self.axes = self.axes[:1]  # the node is one text: other orders tell its rows apart no better
        if (size <= CLOSE * self.total or at == ALL or whole and miss <= MISS * shard_bytes
                or at > OF_TEXT and rows == 1):
            self.found(value + upper)  # the cut is the bucket's nearer side
            self.done = True
        elif whole and (len(self.axes) > 1 or rows == 1):
            self.found(value + upper)
            self.best = min(self.best or (miss, self.axes[0], self.cut), (miss, self.axes[0], self.cut))
            if len(self.axes) > 1:
                self.axes = self.axes[1:]
                self.restart()
            else:
                _, axis, self.cut = self.best
                self.axes, self.done = [axis], True
        else:
            self.found(value)
            self.before = before


def key(dims: list[str]) -> list[Column]:
    """A row's key along its node's axis: a dimension, or the order of another hash of the text."""
    along = F.when(F.col("axis") == 0, F.col(dims[0]))
    for i, dim in enumerate(dims[1:], 1):
        along = along.when(F.col("axis") == i, F.col(dim))
    other = F.shiftrightunsigned(F.xxhash64("hash_", "axis"), 64 - PLACE)
    return [along.otherwise(other), F.col("hash_"), F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - ROW)]


def with_nodes(rows: DataFrame, nodes: list[Node], how: str) -> DataFrame:
    """Rows beside their node; one row of NODE for each node is broadcast."""
    table = pa.table([pa.array(c) for c in zip(*(n.row() for n in nodes))], names=NODE)
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(table)), "node", how)


def median_buckets(rows: DataFrame, dims: list[str], nodes: list[Node]) -> DataFrame:
    """(node, b: (digit, before, size, n, one)): for each node the bucket of its next digit that holds the median."""
    parts = key(dims)
    inside = F.lit(True)
    for i, part in enumerate(parts):
        inside &= part.bitwiseAND(F.col(f"mask_{i}")) == F.col(f"cut_{i}")
    part = F.when(F.col("which") == 0, parts[0]).when(F.col("which") == 1, parts[1]).otherwise(parts[2])
    digit = F.call_function("shiftright", part, F.col("shift").cast("int")).bitwiseAND(F.lit((1 << DIGIT) - 1))
    sums = (with_nodes(rows, nodes, "inner").where(inside).groupBy("node", "before_", "goal", digit.alias("digit"))
            .agg(F.sum("size").alias("size"), F.count("*").alias("n"),
                 (F.min("hash_") == F.max("hash_")).alias("one")))
    upto = Window.partitionBy("node").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("until", F.col("before_") + F.sum("size").over(upto))
    bucket = F.struct("digit", (F.col("until") - F.col("size")).alias("before"), "size", "n", "one")
    return sums.groupBy("node").agg(
        F.coalesce(F.min(F.when(F.col("until") >= F.col("goal"), bucket)), F.max(bucket)).alias("b"))


def kd_tree(rows: DataFrame, dims: list[str], shards: int, folder: str) -> DataFrame:
    """Rows (doc_id, size, text_crc32, hash_, places of ``dims``) with their leaf as ``node``: the shard."""
    rows = rows.withColumn("node", F.lit(0).cast("bigint"))
    columns = rows.columns
    level, depth = [Node(shards, 0)] if shards > 1 else [], 0
    while level:
        wide = {r[0]: r[1:] for r in rows.groupBy("node").agg(
            F.sum("size"), *(F.max(d) - F.min(d) for d in dims)).collect()}
        level = [n for n in level if n.first in wide]  # a node without rows needs no cut
        for node in level:
            node.total, *widths = wide[node.first]
            node.axes = (sorted(range(len(dims)), key=lambda d: (-widths[d], d))
                         + list(range(len(dims), len(dims) + OTHERS)))
        shard_bytes = sum(n.total for n in level) / max(1, sum(n.shards for n in level))
        while open_ := {n.first: n for n in level if not n.done}:
            for r in median_buckets(rows, dims, list(open_.values())).collect():
                open_[r.node].advance(r.b.digit, r.b.before, r.b["size"], r.b.n, r.b.one, shard_bytes)
        if level:
            a, b, c = key(dims)
            left = (a < F.col("cut_0")) | ((a == F.col("cut_0")) & (
                (b < F.col("cut_1")) | ((b == F.col("cut_1")) & (c < F.col("cut_2")))))
            node = F.when(F.col("cut_0").isNull() | left, F.col("node")).otherwise(F.col("node") + F.col("half"))
            rows = with_nodes(rows, level, "left").select(*columns[:-1], node.alias("node"))
            rows = stored(rows, folder, f"level-{depth}")
        level = [kid for n in level for kid in (Node(n.half, n.first), Node(n.shards - n.half, n.first + n.half))
                 if kid.shards > 1]
        depth += 1
    return rows


def sharded(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
            dims: dict[str, Column] | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row for each row of ``docs``.

    size: UTF-8 bytes of the text and 1 more; a null text has size 1 and crc32 0. Shards hold nearly equal sums of
    sizes (law ``bytes``); equal texts share a shard (see the module for one that outweighs a shard). slot numbers
    a shard's rows from 0 in no special order. dims: the metadata dimensions; by default bytes, characters and
    lines of the text, which are equal for equal texts. target_bytes: the size of a shard, in place of ``shards``:
    as many shards as hold the table at that size or less on average. Both ways at most MOST_SHARDS, else a
    ValueError. An empty table gives an empty result; repeated rows are rows of their own; other columns are
    ignored; with more shards than texts some stay empty."""
    folder = scratch(docs.sparkSession)
    text = F.col(text_col)
    if dims is None:
        lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
        dims = {"n_bytes": F.octet_length(text), "n_chars": F.length(text), "n_lines": lines}
    names = [f"dim_{i}" for i in range(len(dims))]
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 64 - HASH).alias("hash_"),
        *(c.cast("double").alias(n) for n, c in zip(names, dims.values())))
    rows = stored(rows, folder, "rows")
    total, count, *ends = rows.agg(F.sum("size"), F.count("*"), *(f(n) for n in names for f in (F.min, F.max))).first()
    if target_bytes is not None:
        shards = max(1, -(-(total or 0) // target_bytes))
    if not 1 <= shards <= MOST_SHARDS:
        raise ValueError(f"{shards} shards; from 1 to {MOST_SHARDS} can be made")
    places = [place(n, ends[2 * i] or 0.0, ends[2 * i + 1] or 0.0).alias(n) for i, n in enumerate(names)]
    out = kd_tree(rows.select("doc_id", "size", "text_crc32", "hash_", *places), names, shards, folder)
    out = out.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"))
    # Slots in two levels: rows are numbered inside slices, and slices start where the one before ends.
    slices = max(1, -(-count // (SLICE * shards)))
    cut = out.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit("slot")), F.lit(slices)))
    sums = cut.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32")
    return (cut.withColumn("own", F.row_number().over(inside)).join(sums, ["shard", "slice"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("base") + F.col("own") - 1).cast("bigint").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
