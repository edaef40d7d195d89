"""Quality rules (operator 11): compression bands beside counted base rules.

A text is compressed by zstandard as a whole and again in fixed chunks of its UTF-8 bytes. The ratio, bytes before
to bytes after, must lie inside the band of the compressed length: repetitive text lies above it, noise below. Bands
go by length because a short text can't refer back to much. Words, lines and windows are found in whole Arrow
columns at once; each text is judged by itself, so there is no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from streamweave.llm.common import chunks, mix, small_batches
from streamweave.llm.words import AS_IT_IS, Words

#: (from so many bytes on, least ratio, greatest ratio): prose of Latin, Greek, Cyrillic and CJK scripts lies well
#: inside; one sentence or word over and over lies far above, base64 and random letters below.
BANDS = ((0, 1.05, 2.3), (512, 1.2, 2.8), (2 << 10, 1.35, 3.3), (8 << 10, 1.45, 3.9), (32 << 10, 1.5, 4.6), (128 << 10, 1.5, 5.5))
#: Bytes of a chunk; zstandard's level; the share of a text's bytes that chunks outside their band may hold.
CHUNK, LEVEL, OFF_SHARE = 4096, 3, 0.25
#: Base rules: fewest words, and the greatest share, in percent, of words inside repeated windows of WINDOW words.
MIN_WORDS, REPEAT_PERCENT, WINDOW = 50, 50, 3

VISIBLE = np.ones(256, np.uint8)
VISIBLE[[9, 10, 11, 12, 13, 32]] = 0
NOT_NEWLINE = np.ones(256, np.uint8)
NOT_NEWLINE[10] = 0
#: First bytes of code points that belong to a word; symbols.
LETTER = ((AS_IT_IS & 0xC0) != 0x80) & (VISIBLE == 1)
SYMBOL = np.zeros(256, bool)
SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, kept boolean, n_bytes bigint, ratio double, least_chunk double, greatest_chunk double, "
          "off_share double")


def per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many flags are set from edges[i] to edges[i + 1], for each i."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[edges])


def seen(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags: the key occurs more than once in its text; it occurred earlier there."""
    _, first, group, n = np.unique(mix(key + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                                   return_index=True, return_inverse=True, return_counts=True)
    earlier = np.ones(len(key), bool)
    earlier[first] = False
    return n[group] > 1, earlier


def counted(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of a column of texts. Words, lines and windows are compared by 64-bit hashes."""
    words, lines = Words(column, VISIBLE, AS_IT_IS), Words(column, NOT_NEWLINE, AS_IT_IS)
    size = np.fromiter((len(x) if x is not None else 0 for x in column.cast(pa.large_binary()).to_pylist()), np.int64, len(column))
    bytes_at = np.concatenate(([0], np.cumsum(size)))
    text_of = lambda first: np.repeat(np.arange(len(column)), np.diff(first))
    owner = text_of(words.first)
    whole = np.flatnonzero(owner[:max(0, len(owner) - WINDOW + 1)] == owner[WINDOW - 1:])
    again, _ = seen(owner[whole], words.runs(WINDOW, whole))
    inside = np.zeros(len(owner), bool)
    for j in range(WINDOW):
        inside[whole[again] + j] = True
    letters = np.zeros(len(lines.bytes) + 1, np.int64)
    np.cumsum(VISIBLE[lines.bytes], out=letters[1:])
    spoken = letters[lines.end] > letters[lines.start]
    _, earlier = seen(text_of(lines.first), lines.hash)
    return {"n_words": np.diff(words.first), "word_chars": per_text(LETTER[words.bytes], bytes_at),
            "n_symbols": per_text(SYMBOL[words.bytes], bytes_at), "n_dup_lines": per_text(spoken & earlier, lines.first),
            "n_repeat_words": per_text(inside, words.first), "n_bytes": size}


def compressed(text: bytes, chunk: int, bands, press) -> tuple[float, float, float, float, bool]:
    """(ratio of all, least and greatest ratio of a chunk, share of bytes in chunks outside their band, all inside)."""
    starts, least, most = (np.array(x) for x in zip(*bands))

    def inside(part: bytes) -> tuple[float, bool]:
        ratio = len(part) / len(press(part))
        band = np.searchsorted(starts, len(part), "right") - 1
        return ratio, bool(least[band] <= ratio <= most[band])

    ratio, good = inside(text)
    ratios, off = [], 0
    for at in range(0, len(text), chunk):
        part = text[at:at + chunk]
        r, ok = inside(part)
        ratios.append(r)
        off += 0 if ok else len(part)
    return ratio, min(ratios), max(ratios), off / len(text), good


def compression_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands=BANDS, chunk: int = CHUNK,
                         level: int = LEVEL, off_share: float = OFF_SHARE, min_words: int = MIN_WORDS,
                         repeat_percent: int = REPEAT_PERCENT) -> DataFrame:
    """One row for each row of ``docs``, columns as in SCHEMA.

    ``base_failed``: fewer than ``min_words`` words, or more than ``repeat_percent`` % of them inside windows of three
    that the text repeats. ``kept``: the base rules hold, the whole text's ratio is inside the band of its length, and
    chunks outside theirs hold at most ``off_share`` of its bytes; the last chunk may be short and is judged by its
    own length. Words are runs of characters other than white space, as they are written.

    Null and empty texts have no words, fail the base rules and have null ratios. Repeated rows get equal verdicts, a
    null id stays null, an empty table gives an empty result, other columns are ignored."""
    def run(batches):
        press = zstandard.ZstdCompressor(level=level).compress
        for batch in chunks(batches, 1):
            out = counted(batch.column(1))
            failed = (out["n_words"] < min_words) | (100 * out["n_repeat_words"] > repeat_percent * out["n_words"])
            found = [compressed(t, chunk, bands, press) if t else (None, None, None, None, False)
                     for t in batch.column(1).to_pylist()]
            ratio, low, high, off, good = zip(*found)
            kept = [not f and g and o <= off_share for f, g, o in zip(failed.tolist(), good, off)]
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(out[c], pa.int64()) for c in names), pa.array(failed), pa.array(kept, pa.bool_()),
                 pa.array(out["n_bytes"], pa.int64()), *(pa.array(x, pa.float64()) for x in (ratio, low, high, off))],
                names=[c.split()[0] for c in SCHEMA.split(", ")])

    return (small_batches(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
            .mapInArrow(run, SCHEMA))
