"""Removal of repeated line runs (operator 10), DataFrame functions only.

Texts are cut at ``\\n``; a line's id is a 64-bit hash. Suffixes of the line-id sequences are ranked by
distributed prefix doubling: ranks by one line come from a grouped count and prefix sums, ranks by 2k lines from
the pairs (rank of k lines here, rank of k lines k further on). A rank is the first index of its group in the
suffix array, so the group of suffixes that share d lines is the LCP interval of depth d; groups of one are
dropped on the way, as nothing that contains them repeats.

A run counts if it has ``min_words`` words or more. For each start the shortest run that counts, and for each end
likewise, is looked up in its LCP interval; if the interval holds an earlier place, the run is a later copy. The
union of these runs is exactly the union of all runs that count and occur earlier (a longer run is covered by
them), so maximal runs need no search of their own. Doubling ends at the longest of these shortest runs.

Prefix sums are taken in two levels over slices of the order, so a line that holds a third of all places is
grouped map-side and its successors are split over 512 slices.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from streamweave.llm.common import scratch, stored

MIN_WORDS = 40
ROW = ["doc_id", "raw"]
WHERE = "decimal(38,0)"


def ranked(groups: DataFrame, a: str, b: str, slices) -> DataFrame:
    """Adds ``rank`` to distinct (a, b, n): a + the places of smaller b in the same a.

    slices: an expression of b that doesn't fall as b rises; sums run inside a slice, then over slice totals."""
    cut = groups.withColumn("slice", slices)
    inside = Window.partitionBy(a, "slice").orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(a).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(a, "slice").agg(F.sum("n").alias("total"))
    totals = totals.select(a, "slice", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return (cut.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(totals.hint("merge"), [a, "slice"]).select(a, b, "n", (F.col(a) + F.col("base") + F.col("own")).alias("rank")))


def line_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, raw, ids, words): raw a hash of the text, then id and number of words of each line."""
    lines = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("raw"),
                        F.split(text_col, "\n", -1).alias("lines"))
    return lines.where("lines is not null").select(
        *ROW, F.transform("lines", lambda x: F.xxhash64(x)).alias("ids"),
        F.transform("lines", lambda x: F.regexp_count(x, F.lit(r"\S+"))).alias("words"))


def repeated_lines(lines: DataFrame, folder: str) -> DataFrame:
    """(doc_id, raw, at, rank, words) of the lines that occur more than once; repeated rows count as one."""
    each = lines.select(*ROW, F.posexplode(F.arrays_zip("ids", "words")).alias("at", "x"))
    each = each.select(*ROW, "at", F.col("x.ids").alias("id"), F.col("x.words").alias("words"))
    groups = each.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").withColumn("a", F.lit(0).cast("bigint"))
    names = stored(ranked(groups, "a", "id", F.shiftright("id", 52)), folder, "names")
    return stored(each.join(names.select("id", "rank").hint("merge"), "id").drop("id").dropDuplicates([*ROW, "at"]), folder, "repeated")


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, raw, start, size): for each start, and for each end, the fewest lines with ``min_words`` words,
    inside stretches of repeated lines."""
    doc = Window.partitionBy(*ROW).orderBy("at")
    lines = lines.withColumn("stretch", F.col("at") - F.row_number().over(doc))
    part = Window.partitionBy(*ROW, "stretch")
    upto = part.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    lines = (lines.withColumn("upto", F.sum("words").over(upto))
             .withColumn("before", F.col("upto") - F.col("words"))
             .withColumn("all", F.sum("words").over(part)).withColumn("first", F.min("at").over(part))
             .withColumn("last", F.max("at").over(part)))
    beyond = part.orderBy("before").rangeBetween(min_words, Window.unboundedFollowing)
    ahead = part.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)
    lines = (lines.withColumn("to", F.coalesce(F.min("at").over(beyond) - 1,
                                               F.when(F.col("all") - F.col("before") >= min_words, F.col("last"))))
             .withColumn("from", F.coalesce(F.max("at").over(ahead) + 1,
                                            F.when(F.col("upto") >= min_words, F.col("first")))))
    onward = lines.select(*ROW, F.col("at").alias("start"), (F.col("to") - F.col("at") + 1).alias("size"))
    back = lines.select(*ROW, F.col("from").alias("start"), (F.col("at") - F.col("from") + 1).alias("size"))
    return onward.union(back).where("size is not null").distinct()


def doubled(level: DataFrame, step: int, total: int) -> DataFrame:
    """Ranks by 2 * step lines from ranks by ``step`` lines; only places whose group has two or more."""
    pairs = level.join(level.select(*ROW, (F.col("at") - step).alias("at"), F.col("rank").alias("b")).hint("merge"), [*ROW, "at"])
    pairs = pairs.withColumnRenamed("rank", "a")
    groups = pairs.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1")
    names = ranked(groups, "a", "b", F.floor(F.col("b") * 512 / F.lit(total + 1)))
    return pairs.join(names.hint("merge"), ["a", "b"]).select(*ROW, "at", "rank")


def placed(runs: DataFrame, level: DataFrame, step: int) -> DataFrame:
    """The runs of step to 2 * step - 1 lines with the two ranks that cover such a run, and their place."""
    here = runs.where((F.col("size") >= step) & (F.col("size") < 2 * step))
    here = here.join(level.select(*ROW, F.col("at").alias("start"), F.col("rank").alias("a")).hint("merge"), [*ROW, "start"])
    if step > 1:
        ends = level.select(*ROW, F.col("at").alias("tail"), F.col("rank").alias("b"))
        here = here.withColumn("tail", F.col("start") + F.col("size") - step).join(ends.hint("merge"), [*ROW, "tail"]).drop("tail")
    else:
        here = here.withColumn("b", F.col("a"))
    here = here.withColumn("place", F.col("doc_id").cast(WHERE) * F.lit(10 ** 10).cast("decimal(11,0)") + F.col("start"))
    return here.withColumn("place", F.col("place").cast(WHERE)).select(*ROW, "start", "size", "a", "b", "place")


def later_copies(here: DataFrame, folder: str) -> DataFrame:
    """The stored runs that occur at an earlier place. A size has one step, so (size, a, b) names a run's lines."""
    # Both sides are stored: the join's are then plain shuffles, and Spark splits a run that many documents share.
    first = stored(here.groupBy("size", "a", "b").agg(F.min("place").alias("first")), folder, "first")
    return here.join(first.hint("merge"), ["size", "a", "b"]).where("first < place").select(*ROW, "start", "size")


def deleted_lines(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(doc_id, raw, gone): the numbers of the lines that go, for documents that lose any."""
    folder = scratch(docs.sparkSession)
    level = repeated_lines(stored(line_ids(docs, id_col, text_col), folder, "lines"), folder)
    runs = stored(shortest_runs(level, min_words), folder, "runs")
    total, longest = level.count(), runs.agg(F.max("size")).first()[0] or 0
    level = level.select(*ROW, "at", "rank")
    here, step = [runs.limit(0).select(*ROW, "start", "size", *(F.lit(None).cast("bigint").alias(c) for c in "ab"),
                                       F.lit(None).cast(WHERE).alias("place"))], 1
    while step <= longest:
        here.append(stored(placed(runs, level, step), folder, f"here-{step}"))
        if 2 * step <= longest:
            level = stored(doubled(level, step, total), folder, f"level-{2 * step}")
        step *= 2
    copies = later_copies(reduce(DataFrame.union, here[1:] or here), folder)
    return (copies.select(*ROW, F.explode(F.expr("sequence(start, start + size - 1)")).alias("at")).distinct()
            .groupBy(*ROW).agg(F.collect_list("at").alias("gone")))


def drop_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                       keep: list[str] | None = None) -> DataFrame:
    """(doc_id, text, n_lines, n_deleted), one row for each row of ``docs``, and, if asked for, a struct ``rest``
    of the columns ``keep`` of that row.

    Lines in a run of ``min_words`` words or more that occurs at an earlier place (smaller doc_id, then line
    number; overlaps count) go; shorter repeats stay. Words are runs of characters other than white space.
    A null text stays null with 0 lines, an empty one has one line. Repeated rows are one document and keep the
    same lines; of rows that share a doc_id but not the text none is earlier. Rows with a null doc_id stay as they
    are. An empty table gives an empty result; other columns are ignored."""
    rest = [F.struct(*(F.col(f"`{c}`") for c in keep)).alias("rest")] if keep else []
    gone = deleted_lines(docs.where(F.col(id_col).isNotNull()), id_col, text_col, min_words)
    lines = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("raw"),
                        F.split(text_col, "\n", -1).alias("lines"), *rest)
    size = F.greatest(F.size("lines"), F.lit(0))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n"))
    return lines.join(gone.hint("merge"), ROW, "left").select(
        "doc_id", text.alias("text"), size.cast("bigint").alias("n_lines"),
        F.greatest(F.size("gone"), F.lit(0)).cast("bigint").alias("n_deleted"), *(["rest"] if keep else []))
