"""Packing token sequences (operator 4): bounded-space online best fit.

A task tokenizes its documents as they come. Full windows are cut off long documents; what remains of a document
goes whole into the open window that it fills best. When none of the OPEN windows has room, the fullest one is
emitted and a new one takes its place: its gap, if it is at least CUT ids, is first filled with the front of the
piece, else left as padding. A task holds OPEN windows, whatever its share of the documents.

Each task's last open windows are merged in a second step: their pieces, with their ids, are dealt to groups of
bounded size and packed best-fit decreasing. Pieces are written to the shared folder once, so nothing is tokenized
twice. A sequence's number holds the number of its input partition or group, so a repeated task gives the same
numbers.
"""

from __future__ import annotations

import base64
import json
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from streamweave.llm.common import chunks, scratch, small_batches, stored

LENGTH, OPEN, CUT = 1024, 64, 32
#: Left-over windows of a merge group.
GROUP = 256
#: Partition number (or group) and number in it share a sequence's number.
WITHIN = 40
#: Partitions and groups together; beyond it a sequence's number would not fit into 63 bits.
MOST = 1 << (63 - WITHIN)


@lru_cache(maxsize=2)
def encoder(path: str, ranks: str | None = None):
    """texts -> lists of ids; ``path``: a tokenizer's .json, or a table of ranks (.tiktoken), which knows no added tokens.

    The .json file's ids are those of its tokenizer with add_special_tokens=False, so a text that spells an added token
    holds its id. ``ranks`` may name the same vocabulary as a table of ranks: four times as fast, for all texts that
    spell no added token."""
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        return lambda texts: [fast.encode_ordinary(t) for t in texts]
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    if ranks is None:
        return lambda texts: [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    if file["normalizer"]:
        raise ValueError(f"{path} has a normalizer: its tokens can't be looked for in the texts")
    added, plain = [t["content"] for t in file["added_tokens"]], encoder(ranks)
    return lambda texts: [own.encode(t, add_special_tokens=False).ids if any(a in t for a in added) else plain([t])[0]
                          for t in texts]


class Open:
    """The open windows of a task: best fit by free space, emission of the fullest."""

    def __init__(self, length: int, most: int, cut: int):
        self.length, self.most, self.cut = length, most, cut
        self.free: list[tuple[int, int]] = []  # (free ids, window), sorted
        self.next = 0

    def window(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, size: int):
        """(window, offset, ids placed, closed) of the front of a piece of ``size`` ids, a closed one no more open."""
        if size >= self.length:
            return self.window(), 0, self.length, True
        at = bisect_left(self.free, (size, -1))
        if at < len(self.free):
            free, window = self.free.pop(at)
        elif len(self.free) < self.most:
            free, window = self.length, self.window()
        else:
            free, window = self.free.pop(0)  # the fullest
            if free >= self.cut:
                return window, self.length - free, free, True
            free, window = self.length, self.window()
        if free > size:
            insort(self.free, (free - size, window))
        return window, self.length - free, size, free == size


PIECE = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
         "offset bigint, ids array<int>")


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str, end: int, length: int, most: int, cut: int,
           keep_ids: bool, ranks: str | None = None) -> DataFrame:
    """PIECE for each piece; ids are there for all pieces if asked for, else for those in windows that stay open."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                                  "offset")] + [("ids", pa.list_(pa.int32())), ("open", pa.bool_())])

    def run(batches):
        encode, windows = encoder(path, ranks), Open(length, most, cut)
        base = TaskContext.get().partitionId() << WITHIN
        if base >= 1 << 63:
            raise ValueError(f"more than {MOST} partitions: read the texts in fewer")
        waiting: dict[int, list] = {}  # pieces of open windows

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)],
                                              schema=schema)

        for batch in chunks(batches, 1):
            out = []
            for doc, ids in zip(batch.column(0).to_pylist(), encode([t or "" for t in batch.column(1).to_pylist()])):
                ids.append(end)
                ids, at = np.array(ids, "<u4"), 0
                while at < len(ids):
                    window, offset, n, closed = windows.place(len(ids) - at)
                    own = ids[at:at + n]
                    piece = (doc, at, n, zlib.crc32(own.tobytes()), len(ids), base + window, offset, own.view("<i4"), False)
                    if closed:
                        out += [(*p[:7], p[7] if keep_ids else None, False) for p in [*waiting.pop(window, []), piece]]
                    else:
                        waiting.setdefault(window, []).append(piece)
                    at += n
                # windows that were emitted with a gap
                if len(waiting) > len(windows.free):
                    still = {w for _, w in windows.free}
                    for w in [w for w in waiting if w not in still]:
                        out += [(*p[:7], p[7] if keep_ids else None, False) for p in waiting.pop(w)]
            if out:
                yield table(out)
        if waiting:
            yield table([(*p[:8], True) for own in waiting.values() for p in own])

    return (small_batches(docs).select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
            .mapInArrow(run, PIECE + ", open boolean"))


def merged(left: DataFrame, length: int, cut: int, first: int) -> DataFrame:
    """Packs the pieces of left-over windows anew, the longest first, in groups of about GROUP windows."""
    groups = max(1, -(-left.select("sequence_id").distinct().count() // GROUP))
    if first + groups > MOST:
        raise ValueError(f"{first} partitions and {groups} groups are more than {MOST}: read the texts in fewer partitions")

    def pack(key, table):
        rows = sorted(table.to_pylist(), key=lambda r: (-r["length"], r["doc_id"] is None, r["doc_id"], r["start"], r["ids_crc32"]))
        windows = Open(length, len(rows) + 1, cut)
        for r in rows:
            window, r["offset"], _, _ = windows.place(r["length"])
            r["sequence_id"] = ((first + key[0].as_py()) << WITHIN) + window
        return pa.Table.from_pylist(rows, schema=table.schema).select([c.split()[0] for c in PIECE.split(", ")])

    return (left.groupBy(F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).cast("int").alias("g"))
            .applyInArrow(pack, PIECE))


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = 0,
           length: int = LENGTH, most: int = OPEN, cut: int = CUT, keep_ids: bool = True,
           ranks: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids): one row for each piece.

    path and ranks: see ``encoder``. A document is its tokens and then ``end``; a null or empty text is ``end`` alone. start: the document's ids
    before the piece; offset: the place in the sequence, gapless from 0. ids is null if ``keep_ids`` is off.
    Repeated rows and rows with a null doc_id are documents of their own; an empty table gives an empty result;
    other columns are ignored."""
    folder = scratch(docs.sparkSession)
    all_ = stored(pieces(docs, id_col, text_col, path, end, length, most, cut, keep_ids, ranks), folder, "pieces")
    left = all_.where("open")
    # Numbers of groups follow the numbers of partitions.
    first = (all_.agg(F.max(F.shiftright("sequence_id", WITHIN))).first()[0] or 0) + 1
    final = merged(left.drop("open"), length, cut, first)
    if not keep_ids:
        final = final.withColumn("ids", F.lit(None).cast("array<int>"))
    return all_.where("not open").drop("open").union(final)
