"""E4 word count: batch (A1), rolling changelog (A2), and the checkpointed
streaming job (ST15) over a folder of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamweave.operators.aggregates import rolling_word_count, word_count
from streamweave.operators.transforms import split_words
from streamweave.sources.text import PLACE, read_lines, read_lines_stream
from streamweave.streaming.runner import IdempotentParquetSink, start


def batch_word_count(spark: SparkSession, path: str) -> DataFrame:
    return word_count(split_words(read_lines(spark, path, numbered=False)))


def rolling_text_word_count(spark: SparkSession, path: str) -> DataFrame:
    """(word, file, block, line, pos, count) in the order of the files' lines; a chunk is a file block."""
    words = split_words(read_lines(spark, path, numbered=False), keep=PLACE)
    return rolling_word_count(words, order=(*PLACE, "pos"), chunk=[F.col("file"), F.col("block")])


def stream_word_count(spark: SparkSession, folder: str, out: str, checkpoint: str,
                      trigger_interval: str | None = "300 milliseconds", available_now: bool = False):
    """Counts per word over text files arriving in ``folder``; update mode
    into an idempotent per-batch sink; resumable from ``checkpoint``."""
    lines = read_lines_stream(spark, folder)
    counts = word_count(split_words(lines))
    return start(counts, IdempotentParquetSink(out), checkpoint, output_mode="update",
                 trigger_interval=trigger_interval, available_now=available_now)
