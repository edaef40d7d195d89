"""MinHash near-duplicate detection (operator 3).

Sketch: fast similarity sketching. With t bins, round i < t hashes every shingle to a bin and a value and
keeps the least i + value of each bin; rounds t..2t-1 place all shingles in bin i - t. A document stops after
the first round that leaves no bin empty, so every coordinate is filled, two sketches agree in a coordinate with
probability equal to the Jaccard similarity, and the agreement is concentrated as for independent coordinates.

Plan: (1) one pass over the texts gives digest, set size and band hashes; (2) equal word sequences become one
class, all later steps work on classes; (3) each band bucket is linked to its least class (a star, never all
pairs) and the stars' components are the candidate clusters; (4) texts of clustered classes are dealt to
(cluster, block, block) groups of bounded size, where every pair is decided on its full shingle sets, so a
cluster of any size is spread over many tasks; a task returns a spanning forest of the links it confirmed,
never more rows than it read; (5) components of the confirmed links.

Bands are chosen by the threshold, so that a pair at it shares no bucket with probability MISSED at most: at 0.85, 32
bands of 7 (4.2e-6); at 0.8, 41 bands of 6 (3.9e-6).
"""

from __future__ import annotations

from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from streamweave.llm.common import chunks, components, mix, scratch, shingles, small_batches, stored
from streamweave.llm.words import Words

#: The most that may be missed of the pairs at the threshold.
MISSED = 4.3e-6
#: Shingles that are sketched at once, about.
SKETCHED = 250_000
#: Classes in a block of a cluster, on average; a task compares two blocks.
BLOCK = 96
EMPTY = np.iinfo(np.uint64).max


IN_WORD = np.ones(256, np.uint8)
IN_WORD[[9, 10, 11, 12, 13, 32]] = 0


def words_of(column: pa.Array) -> Words:
    """Lower-cases A-Z and cuts at the six white-space characters of ASCII."""
    return Words(column, IN_WORD)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of word hashes; a shorter sequence is one shingle."""
    return np.unique(shingles(words, min(k, len(words)))) if len(words) else np.zeros(0, np.uint64)


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """Fast similarity sketches, one row of ``t`` values for each non-empty set."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    items, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    out = np.full(n * t, EMPTY, np.uint64)
    for i in range(2 * t):
        h = mix(items + np.uint64((0xD1B54A32D192ED03 * (i + 1)) & (2 ** 64 - 1)))
        if i < t:
            # multiply-shift of the upper half picks the bin
            where = owner * t + (((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64)
        else:
            where = owner * t + (i - t)
        np.minimum.at(out, where, (np.uint64(i) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF)))
        open_ = (out.reshape(n, t) == EMPTY).any(axis=1)
        if not open_.any():
            break
        keep = open_[owner]
        items, owner = items[keep], owner[keep]
    return out.reshape(n, t)


def band_hashes(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash for each band of each sketch; the band's number goes in."""
    cut = sketch.reshape(len(sketch), bands, rows)
    h = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = np.broadcast_to(h, cut.shape[:2]).copy()
    for j in range(rows):
        h = mix(h ^ mix(cut[:, :, j] + np.uint64(j + 1)))
    return h.view(np.int64)


def banding(over: int, under: int) -> tuple[int, int]:
    """(bands, rows of each) for a threshold of ``over / under``."""
    rows = max(1, round(1.12 / max(0.05, 1 - over / under)))
    shared = (over / under) ** rows
    return (ceil(log(MISSED) / log(1 - shared)) if shared < 1 else 1), rows


def signed(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, raw, node, n_shingles, bands) for each row; raw is a hash of the text as it is, node a 128-bit
    digest of its word sequence, null without words; bands is null with it."""
    schema = "doc_id bigint, raw bigint, node binary, n_shingles bigint, bands array<bigint>"
    arrow = pa.schema([("doc_id", pa.int64()), ("raw", pa.int64()), ("node", pa.binary()), ("n_shingles", pa.int64()),
                       ("bands", pa.list_(pa.int64()))])

    def run(batches):
        seen, new, sets, waiting = {}, [], [], []

        def done():
            """Sketches the sets gathered so far and answers for the rows that wait for them."""
            if sets:
                for node, s, b in zip(new, sets, band_hashes(sketches(sets, bands * rows), bands, rows)):
                    seen[node] = (len(s), b)
            for ids, raw, nodes in waiting:
                found = [(0, None) if x is None else seen[x] for x in nodes]
                yield pa.RecordBatch.from_arrays([
                    ids, raw, pa.array(nodes, pa.binary()), pa.array([x[0] for x in found], pa.int64()),
                    pa.array([x[1] for x in found], pa.list_(pa.int64()))], schema=arrow)
            new.clear(), sets.clear(), waiting.clear()
            if len(seen) > 10_000:  # a worker remembers the last texts only to save time
                seen.clear()

        for batch in chunks(batches, 2):
            words, nodes = words_of(batch.column(2)), []
            for i in range(batch.num_rows):
                own = words.of(i)
                node = xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None
                nodes.append(node)
                if node is not None and node not in seen:
                    seen[node] = None
                    new.append(node)
                    sets.append(shingle_set(own, k))
            # copies of the two columns: their slices would hold the whole batch
            waiting.append((*(batch.column(c).take(pa.array(np.arange(batch.num_rows))) for c in (0, 1)), nodes))
            if sum(map(len, sets)) >= SKETCHED:
                yield from done()
        yield from done()

    return (small_batches(docs).select(F.col(id_col).cast("bigint"), F.xxhash64(text_col), F.col(text_col).cast("binary"))
            .mapInArrow(run, schema))


def linked_pairs(sets: list[np.ndarray], side: np.ndarray, over: int, under: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs whose sets meet ``under * |A & B| >= over * |A | B|``.

    side: 0 compares all, 1 and 2 only across. Counts come from the items that at least two sets hold."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    items, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, code, count = np.unique(items, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    code, owner = code[shared], owner[shared]
    both = np.zeros((n, n), np.int64)
    width = 4096
    if len(code):
        _, code = np.unique(code, return_inverse=True)
        order = np.argsort(code, kind="stable")
        code, owner = code[order], owner[order]
        for at in range(0, int(code[-1]) + 1, width):
            lo, hi = np.searchsorted(code, (at, at + width))
            m = np.zeros((n, width), np.float32)
            m[owner[lo:hi], code[lo:hi] - at] = 1
            both += (m @ m.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    ok = np.triu(under * both >= over * union, 1)
    if side.any():
        ok &= (side[:, None] != side[None, :])
    root = list(range(n))

    def top(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for i, j in zip(*np.nonzero(ok)):
        a, b = top(int(i)), top(int(j))
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(i), int(j)))
    return out


def confirmed(members: DataFrame, k: int, over: int, under: int) -> DataFrame:
    """Links (a, b) that hold on full sets, among ``members`` (cluster, size, node, text).

    A cluster of more than BLOCK classes is cut in blocks by hash and each two blocks meet in a group of their
    own; small clusters share groups."""
    n = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), n).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("n") - 1),
                       lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    rows = (members.select("cluster", "size", "node", "text", n.alias("n"), block.alias("block"))
            .select("*", F.explode(pair).alias("p")))
    bins = max(1, members.count() // BLOCK)
    small = F.col("n") == 1
    rows = rows.select(
        F.when(small, F.pmod(F.xxhash64("cluster"), F.lit(bins)))
        .otherwise(F.xxhash64("cluster", "p.i", "p.j")).alias("g"),
        F.concat_ws(",", "cluster", "p.i", "p.j").alias("label"),
        F.when(F.col("p.i") == F.col("p.j"), 0).when(F.col("block") == F.col("p.i"), 1).otherwise(2).alias("side"),
        small.alias("small"), "node", "text")

    def compare(table):
        words = words_of(table.column("text").combine_chunks())
        label, node, side = (table.column(c).to_numpy() for c in ("label", "node", "side"))
        order = np.argsort(label.astype(str), kind="stable")
        cut = np.flatnonzero(label[order][1:] != label[order][:-1]) + 1
        a, b = [], []
        for own in np.split(order, cut):
            if len(own) > 1:
                sets = [shingle_set(words.of(i), k) for i in own]
                for i, j in linked_pairs(sets, side[own], over, under):
                    a.append(int(node[own[i]]))
                    b.append(int(node[own[j]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("g", "small").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, over: int = 80,
                    under: int = 100, bands: int | None = None, rows: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash), one row for each row of ``docs``.

    Two documents are linked if ``under * |A & B| >= over * |A | B|`` for their sets of distinct k-word
    shingles. component_id: the least doc_id that links reach. kept: doc_id = component_id.
    bands and rows: by default those of ``banding``. Documents without words (null, empty, only white space) have n_shingles 0 and are linked with nothing.
    Repeated rows are equal texts; rows of one doc_id with different texts are linked each by its own text. A
    row with a null doc_id gets the component of its equal texts, null and not kept without any. An empty table
    gives an empty result; other columns are ignored."""
    own = banding(over, under)
    bands, rows = bands or own[0], rows or own[1]
    folder = scratch(docs.sparkSession)
    signs = stored(signed(docs, id_col, text_col, k, bands, rows), folder, "signs")
    classes = (signs.where("node is not null and doc_id is not null")
               .groupBy("node").agg(F.min("doc_id").alias("least")))
    classes = stored(classes, folder, "classes")
    # The rows of a class's least id stand for the class: one, or repeated ones that are equal.
    firsts = signs.join(classes.select("node", F.col("least").alias("doc_id")), ["node", "doc_id"], "left_semi")
    firsts = stored(firsts.select("doc_id", "raw", "bands"), folder, "firsts")
    banded = firsts.select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
    stars = banded.groupBy("bucket").agg(F.min("node").alias("least")).join(banded, "bucket").where("node <> least")
    raw = components(stars.select(F.col("node").alias("a"), F.col("least").alias("b")), folder, "raw")
    raw = raw.union(raw.select(F.col("root").alias("node"), "root").distinct())
    # Sums are stored before the join with what they sum: its sides are plain shuffles, and Spark splits large clusters.
    sizes = stored(raw.groupBy("root").agg(F.count("*").alias("size")), folder, "sizes")
    members = raw.join(sizes, "root").select(F.col("root").alias("cluster"), "size", "node")
    ids = stored(members.join(firsts.select(F.col("doc_id").alias("node"), "raw"), "node").distinct(), folder, "members")
    texts = docs.select(F.col(id_col).cast("bigint").alias("node"), F.xxhash64(text_col).alias("raw"),
                        F.col(text_col).cast("binary").alias("text"))
    # One plan at every size: the ids are hashed in each shuffle partition, and texts go there once, unsorted.
    found = stored(texts.join(ids.hint("shuffle_hash"), ["node", "raw"]).dropDuplicates(["node", "raw"]), folder, "texts")
    links = components(confirmed(found, k, over, under), folder, "links")
    labels = (classes.join(links.select(F.col("node").alias("least"), "root"), "least", "left")
              .select("node", F.coalesce("root", "least").alias("component_id")))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = signs.join(labels, "node", "left").withColumn("component_id", component)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), F.col("raw").alias("text_hash"))
