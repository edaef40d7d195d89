"""Benchmark decontamination (operator 1): which words of a document lie in a window of a benchmark item.

A window is ``size`` consecutive words of an item, or the whole of a shorter item. As all words of a window must
be there, its necessary prefix is one token: of the shingles (5 words, fewer in shorter windows) the one that
occurs least often in the documents. Documents and windows are joined on this token; the token's place in the
window and the window's length bound where a match can start and end; the words there are then compared one by
one with the window.

The windows come in blocks of bounded size, so the join is a map-side one: a block's prefix table goes to every
task and each document is worked through where it was read, without a shuffle. More windows than a block holds
mean more passes over the documents, never a larger table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streamweave.llm.common import chunks, scratch, small_batches, stored
from streamweave.llm.words import Words

SIZE, SHINGLE = 10, 5
#: (window, item) rows of a block: some 6 MB in each task.
BLOCK = 50_000
IN_WORD = np.zeros(256, np.uint8)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = 1


def words_of(column: pa.Array) -> Words:
    return Words(column, IN_WORD)


class Lookup:
    """Sorted 64-bit keys behind a bitmap of their upper 20 bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.keys >> np.uint64(44)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the values that are keys, and which keys they are."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.bits[values >> np.uint64(44)])
        key = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        same = self.keys[key] == values[at]
        return at[same], key[same]


class Block:
    """The windows of a block: texts, lengths, items, and for each length of shingle the shingles' hashes."""

    def __init__(self, windows: list[bytes], items: list[list[str]], shingle: int):
        self.windows, self.items, self.shingle = windows, items, shingle
        words = words_of(pa.array(windows, pa.large_binary()))
        self.n = np.diff(words.first)
        self.whole = np.zeros(len(windows), np.uint64)
        for n in np.unique(self.n):
            own = np.flatnonzero(self.n == n)
            self.whole[own] = words.runs(int(n), words.first[own])
        self.k = np.minimum(self.n, shingle)
        # tokens: window, place in it, hash
        self.tokens = {}
        for k in map(int, np.unique(self.k)):
            own = np.flatnonzero(self.k == k)
            many = self.n[own] - k + 1
            window = np.repeat(own, many)
            place = np.arange(len(window)) - np.repeat(np.cumsum(many) - many, many)
            self.tokens[k] = window, place, words.runs(k, words.first[window] + place)

    def choose(self, counts: dict[int, dict[int, int]]) -> None:
        """Keeps each window's rarest token (then the first one): its prefix."""
        self.prefix = {}
        for k, (window, place, token) in self.tokens.items():
            seen = np.array([counts.get(k, {}).get(t, 0) for t in token.tolist()], np.int64)
            order = np.lexsort((place, seen, window))
            order = order[np.r_[True, window[order][1:] != window[order][:-1]]]
            order = order[np.argsort(token[order], kind="stable")]
            look = Lookup(token[order])
            first = np.searchsorted(token[order], np.r_[look.keys, look.keys[-1:]], "left")
            first[-1] = len(order)
            self.prefix[k] = look, first, window[order], place[order]
        del self.tokens

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of every occurrence of a window in the texts."""
        starts, found = [], []
        text_of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        for k, (look, first, window, place) in self.prefix.items():
            at, key = look.find(words.runs(k))
            many = first[key + 1] - first[key]
            at, key = np.repeat(at, many), np.repeat(first[key] - np.cumsum(many) + many, many) + np.arange(many.sum())
            start, own = at - place[key], window[key]
            # position and length: the window must lie in the text that the token lies in
            text = text_of[at]
            ok = (start >= words.first[text]) & (start + self.n[own] <= words.first[text + 1])
            start, own = start[ok], own[ok]
            for n in np.unique(self.n[own]):
                pick = np.flatnonzero(self.n[own] == n)
                pick = pick[words.runs(int(n), start[pick]) == self.whole[own[pick]]]
                pick = [i for i in pick.tolist() if words.text(int(start[i]), int(n)) == self.windows[own[i]]]
                starts.append(start[pick])
                found.append(own[pick])
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(starts), np.concatenate(found)


def item_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(window, item), distinct; a window's words are joined by a space."""
    def run(batches):
        for batch in chunks(batches, 1):
            words = words_of(batch.column(1))
            ids = batch.column(0).to_pylist()
            out, who = [], []
            for i, own in enumerate(ids):
                a, b = words.first[i], words.first[i + 1]
                for at in range(a, max(b - size, a) + 1 if b > a else a):
                    out.append(words.text(at, min(size, b - a)))
                    who.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(who, pa.string())],
                                             names=["window", "item"])

    return (items.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary"))
            .mapInArrow(run, "window binary, item string").where("item is not null").distinct())


def token_counts(docs: DataFrame, text_col: str, block) -> dict[int, dict[int, int]]:
    """How often each token of a block occurs in the documents; a task sends one sum for each token it met."""
    def run(batches):
        looks = {k: Lookup(t[2]) for k, t in block.value.tokens.items()}
        sums = {k: np.zeros(len(x.keys), np.int64) for k, x in looks.items()}
        for batch in chunks(batches, 0):
            words = words_of(batch.column(0))
            for k, look in looks.items():
                np.add.at(sums[k], look.find(words.runs(k))[1], 1)
        for k, look in looks.items():
            met = np.flatnonzero(sums[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(met), k, np.int32)), pa.array(look.keys[met].view(np.int64)),
                                              pa.array(sums[k][met])], names=["k", "token", "n"])

    rows = (docs.select(F.col(text_col).cast("binary")).mapInArrow(run, "k int, token bigint, n bigint")
            .groupBy("k", "token").agg(F.sum("n").alias("n")).collect())
    out: dict[int, dict[int, int]] = {}
    for k, token, n in rows:
        out.setdefault(k, {})[token % 2 ** 64] = n
    return out


STATE = ("doc_id bigint, text binary, n_words bigint, spans array<struct<start:bigint,end:bigint>>, "
         "items array<string>")
SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def scanned(state: DataFrame, block, last: bool) -> DataFrame:
    """Adds a block's hits to (doc_id, text, n_words, spans, items, more); the last block drops texts that aren't kept."""
    def run(batches):
        own = block.value
        for batch in chunks(batches, 1):
            words = words_of(batch.column(1))
            start, window = own.matches(words)
            edge = np.zeros(len(words.hash) + 1, np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + own.n[window], -1)
            hit = np.cumsum(edge)[:-1] > 0
            n = len(words.first) - 1
            text = np.repeat(np.arange(n), np.diff(words.first))
            spans, items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            for t in np.unique(text[start]).tolist():
                a, b = words.first[t], words.first[t + 1]
                mark = np.zeros(b - a + 1, bool)
                mark[:-1] = hit[a:b]
                for s in spans[t] or []:
                    mark[s["start"]:s["end"]] = True
                turn = np.flatnonzero(np.diff(np.r_[False, mark]))
                spans[t] = [{"start": int(x), "end": int(y)} for x, y in zip(turn[::2], turn[1::2])]
            who: dict[int, set] = {}
            for t, w in set(zip(text[start].tolist(), window.tolist())):
                who.setdefault(t, set()).update(own.items[w])
            for t, found in who.items():
                items[t] = sorted(found | set(items[t] or []))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.nulls(n, pa.binary()) if last else batch.column(1), pa.array(np.diff(words.first).astype(np.int64)),
                 pa.array(spans, SPAN), pa.array(items, pa.list_(pa.string())), *batch.columns[5:]], names=names)

    names, kinds = state.columns, dict(state.dtypes)
    return state.mapInArrow(run, STATE + (f", rest {kinds['rest']}" if "rest" in kinds else ""))


def contaminated_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", size: int = SIZE,
                       shingle: int = SHINGLE, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, n_words, spans, items), one row for each row of ``docs``. If asked for, the row's ``text`` and a struct
    ``rest`` of its columns ``keep`` go with it, so no join is needed to use the result.

    Words are runs of digits, letters and all characters beyond ASCII, after A-Z is lower-cased. spans: the
    hit words as [start, end) word numbers, disjoint and in order; items: ids (as strings, sorted) of the items
    with a window in the text. A null or wordless text has no words and no hits; an item without words or id has
    no windows; repeated rows are treated alike; with no documents or no items nothing is hit. Other columns are
    ignored."""
    spark = small_batches(docs).sparkSession
    rows = stored(item_windows(items, item_id, item_text, size), scratch(spark), "windows")
    blocks = max(1, -(-rows.count() // BLOCK))
    state = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
                        F.lit(None).cast("bigint").alias("n_words"),
                        F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans"),
                        F.lit(None).cast("array<string>").alias("items"),
                        *([F.struct(*(F.col(f"`{c}`") for c in keep)).alias("rest")] if keep else []))
    for b in range(blocks):
        part = (rows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)
                .groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")).collect())
        own = Block([bytes(r[0]) for r in part], [list(r[1]) for r in part], shingle)
        sent = spark.sparkContext.broadcast(own)
        counts = token_counts(docs, text_col, sent)
        sent.unpersist()
        own.choose(counts)
        state = scanned(state, spark.sparkContext.broadcast(own), b == blocks - 1 and not keep)
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return state.select("doc_id", "n_words", F.coalesce("spans", empty).alias("spans"),
                        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                        *([F.col("text").cast("string").alias("text"), "rest"] if keep else []))


def digest(hits: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of ``contaminated_spans``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return hits.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.size("spans") > 0).alias("contaminated"))
