"""Quality classifier (operator 8): hashed word n-grams, logistic regression by follow-the-regularised-leader.

A text's features are its words, punctuation marks and their neighbours in pairs, hashed to 2^18 buckets, with
the root of the bucket's count as value, scaled to length 1; a word that repeats its predecessor is one feature
of its own. Training reads a bounded sample of the labelled rows, dealt over tasks of PART rows that
each run FTRL-Proximal over their share, and averages their weights; the model has 2^18 numbers at most (2 MB), whatever
the input. Scoring is one pass over the texts: sparse dot products against the broadcast weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streamweave.llm.common import chunks, mix, small_batches
from streamweave.llm.words import AS_IT_IS, Words

BITS = 18
#: Rows with a label that training reads, about; a hash of doc_id picks them when there are more.
SAMPLE = 24_000
#: Rows of a training task, about; passes over them.
PART, EPOCHS = 2_000, 8
ALPHA, BETA, L1, L2 = 20.0, 1.0, 1e-4, 1e-3
#: Letters, digits and all bytes beyond ASCII are one kind of token, other visible characters another.
KINDS = np.full(256, 2, np.uint8)
KINDS[48:58] = KINDS[65:91] = KINDS[97:123] = KINDS[128:] = 1
KINDS[[9, 10, 11, 12, 13, 32]] = 0
SAME = np.uint64(0x5851F42D4C957F2D)


def tokens_of(column: pa.Array) -> Words:
    return Words(column, KINDS, AS_IT_IS)


def features(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of a text's token hashes; the values' squares add up to 1, or there are none."""
    if not len(words):
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    pairs = np.where(words[1:] == words[:-1], SAME, words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    at, n = np.unique(mix(np.concatenate((words, pairs))) >> np.uint64(64 - BITS), return_counts=True)
    return at.astype(np.int32), np.sqrt(n / n.sum()).astype(np.float32)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the bias last, after ``epochs`` passes of FTRL-Proximal over (buckets, values, label)."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(at):
        own = z[at]
        return np.where(np.abs(own) <= L1, 0.0, (np.sign(own) * L1 - own) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for at, x, y in rows:
            at, x = np.append(at, size - 1), np.append(x, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            s = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - s * w
            n[at] += g * g
    return weights(np.arange(size))


def trained(texts: DataFrame, parts: int) -> np.ndarray:
    """Mean weights of ``parts`` models over (doc_id, text, label); zeros without rows."""
    def fit(table):
        table = table.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("label", "ascending")])
        rows = []
        for batch in chunks(table.to_batches(), table.column_names.index("text")):
            words = tokens_of(batch.column("text"))
            rows += [(*features(words.of(i)), y) for i, y in enumerate(batch.column("label").to_pylist())]
        w = ftrl(rows)
        at = np.flatnonzero(w)
        return pa.table({"at": pa.array(at, pa.int64()), "w": pa.array(w[at]), "rows": pa.array(np.full(len(at), len(rows)))})

    rows = texts.withColumn("order", F.xxhash64("doc_id", F.lit("order")))
    dealt = rows.groupBy(F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(parts)).alias("part"))
    sums = (dealt.applyInArrow(fit, "at bigint, w double, rows bigint")
            .groupBy("at").agg(F.sum(F.col("w") * F.col("rows")).alias("w"), F.sum("rows").alias("rows")).toArrow())
    at, w, n = (sums.column(c).to_numpy() for c in ("at", "w", "rows"))
    out = np.zeros((1 << BITS) + 1)
    out[at] = w / n.max(initial=1)
    return out


def held_out(doc_id):
    """crc32 of the id as text, modulo 5, is 0; rows without an id are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def quality_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Trains on about ``sample`` labelled rows that aren't held out (all of them, if there are no more)."""
    known = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(~held_out(F.col("doc_id")) & F.col("label").isin(0, 1)).distinct()
    count = known.count()
    share = min(1.0, sample / max(1, count))
    known = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    # The sample's ids are bounded by ``sample``.
    return trained(texts.join(F.broadcast(known), "doc_id"), max(1, round(count * share / PART)))


def quality_scores(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """(doc_id, score), one row for each row of ``docs``: the probability of label 1 by the whole text. If asked for,
    the row's ``text`` and a struct ``rest`` of its columns ``keep`` go with it, so no join is needed to use the score.

    A null, empty or white text has no features and gets the model's bias. Repeated rows score alike, rows without an
    id are scored too, an empty table gives an empty result, other columns are ignored."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    rest = [F.struct(*(F.col(f"`{c}`") for c in keep)).alias("rest")] if keep else []

    def run(batches):
        w = sent.value
        for batch in chunks(batches, 1):
            words, scores = tokens_of(batch.column(1)), []
            for i in range(batch.num_rows):
                at, x = features(words.of(i))
                scores.append(w[at] @ x + w[-1])
            score = pa.array(1 / (1 + np.exp(-np.clip(np.array(scores), -35, 35))))
            more = batch.columns[1:] if keep else []
            yield pa.RecordBatch.from_arrays([batch.column(0), score, *more], names=["doc_id", "score", *(["text", "rest"] if keep else [])])

    rows = small_batches(docs).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *rest)
    kinds = dict(rows.dtypes)
    more = f", text binary, rest {kinds['rest']}" if keep else ""
    out = rows.mapInArrow(run, "doc_id bigint, score double" + more)
    return out.withColumn("text", F.col("text").cast("string")) if keep else out
