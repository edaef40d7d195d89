"""Secret scan with a random forest against false positives (operator 9), DataFrame functions only.

Candidates are runs of 12 or more characters that keys and tokens are made of, with a digit among them; runs of a
known issuer's format, digit or not; and whatever is assigned to a telling name, of any length. Each is described by its length, its changes of character class, its spread of characters, the part of it that dictionary
words cover, whether it lies in a path or address, and the words around it. A random forest, trained from labelled
findings, tells secrets from hashes, numbers, identifiers and paths.

Labelled findings come in as a table (see ``findings``); ``rule_labels`` makes one from the corpus itself: findings of
a known issuer's format or behind an assignment to a telling name are secrets, all others are not. Training reads a
bounded sample of them (SAMPLE). The dictionary is counted over all documents: words of four letters or more that
occur MENTIONS times. Everything else is one pass over the texts; only documents with a candidate go on.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from streamweave.llm.common import scratch, stored

BODY = "A-Za-z0-9+/_-"
#: Characters of a finding's surroundings that are looked at.
AROUND = 48
SAMPLE, TREES, DEPTH, SEED = 20_000, 24, 8, 11
MENTIONS = 20
#: Fixed prefixes of issuers' key formats.
ISSUERS = (r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_live_[A-Za-z0-9]{16,}$"
           r"|^AIza[A-Za-z0-9_-]{35}$|^glpat-[A-Za-z0-9_-]{20}$")
TELLING = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api_?key|auth|credential|private_?key)[\"']?\s*(=|:|=>)\s*[\"']?$"
RUN = f"(?<![{BODY}])(?=[A-Za-z+/_-]*+[0-9])[{BODY}]{{12,}}+={{0,2}}"
ISSUED = f"(?<![{BODY}])(?:{ISSUERS.replace('^', '').replace('$', '')})(?![{BODY}])"
#: A value behind an assignment to a telling name: between quotes, else up to white space or the next assignment. The
#: first look back is cheap; spaces are as many as a finding's surroundings may hold.
BEHIND = "(?<=[=:>\"'\\s])(?<=[=:>]\\s{0,32}[\"']?)(?<=" + TELLING.replace("\\s*", "\\s{0,32}").removesuffix("$").replace("(?i)", "(?i:", 1) + "))"
PART = "[^\\s\"'<>,;&]+"
VALUE = (f"{BEHIND}(?:(?<=\")[^\"\\r\\n]+(?=\")|(?<=')[^'\\r\\n]+(?=')"
         f"|(?![=>:]){PART}(?:[,;&](?![A-Za-z_][A-Za-z0-9_.-]{{0,40}}\\s{{0,8}}[=:]){PART}){{0,64}}(?<![.:)\\]}}]))")
CANDIDATE = f"{VALUE}|{ISSUED}|{RUN}"
NAMES = ["password", "passwd", "pwd", "secret", "token", "key", "auth", "credential"]
FEATURES = ["n_chars", "n_turns", "turn_rate", "n_distinct", "distinct_rate", "digit_rate", "upper_rate", "lower_rate",
            "hex_only", "digits_only", "coverage", "in_path", "n_slashes", "assigned", "quoted", "issuer",
            *(f"near_{n}" for n in NAMES)]


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, raw, nth, start, finding, before, after); repeated rows are looked at once."""
    text = F.col(text_col)
    found = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text")).where(F.col("text").rlike(CANDIDATE))
    found = found.select("doc_id", F.xxhash64("text").alias("raw"), F.length("text").alias("size"),
                         F.regexp_extract_all("text", F.lit(f"({CANDIDATE})"), 1).alias("hits"),
                         F.split("text", CANDIDATE, -1).alias("gaps"))
    # Between two candidates lies one gap: what stands before the one and behind the other. A short gap's candidate
    # may hold the name that the next one is assigned to.
    item = F.arrays_zip("hits", F.transform("gaps", lambda g: F.length(g)).alias("skips"),
                        F.transform("gaps", lambda g, i: F.right(F.concat(F.when(i > 0, F.get("hits", i - 1)).otherwise(""), g), F.lit(AROUND))).alias("befores"),
                        F.slice(F.transform("gaps", lambda g: F.left(g, F.lit(AROUND))), 2, F.size("gaps")).alias("afters"))
    found = found.select("doc_id", "raw", F.posexplode(item).alias("nth", "x")).where("x.hits is not null")
    found = found.dropDuplicates(["doc_id", "raw", "nth"])
    upto = Window.partitionBy("doc_id", "raw").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    return found.select("doc_id", "raw", F.col("nth").cast("bigint").alias("nth"),
                        (F.sum(F.col("x.skips") + F.length("x.hits")).over(upto) - F.length("x.hits")).alias("start"),
                        F.col("x.hits").alias("finding"), F.col("x.befores").alias("before"),
                        F.coalesce("x.afters", F.lit("")).alias("after"))


def dictionary(docs: DataFrame, text_col: str, mentions: int = MENTIONS) -> DataFrame:
    """(word): letters only, lower case, four or more, ``mentions`` times in all documents."""
    word = F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+")).alias("word")
    return (docs.select(word).where(F.length("word") > 3).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= mentions).select("word"))


def covered(found: DataFrame, words: DataFrame) -> DataFrame:
    """(finding, coverage): the part of a finding's characters that lie in dictionary words."""
    parts = found.select("finding").distinct().select(
        "finding", F.explode(F.split(F.lower(F.col("finding")), "[^a-z]+")).alias("word")).where(F.length("word") > 3)
    return (parts.join(words, "word").groupBy("finding").agg(F.sum(F.length("word")).alias("letters"))
            .select("finding", (F.col("letters") / F.length("finding")).alias("coverage")))


def featured(found: DataFrame, cover: DataFrame) -> DataFrame:
    """Adds the FEATURES columns."""
    f, before, after = F.col("finding"), F.col("before"), F.col("after")
    kind = F.regexp_replace(F.regexp_replace(F.regexp_replace(f, "[a-z]", "a"), "[A-Z]", "B"), "[0-9]", "9")
    turns = F.length(f) - F.length(F.regexp_replace(kind, r"(.)(?=\1)", ""))
    n = F.length(f)
    rate = lambda cls: F.length(F.regexp_replace(f, f"[^{cls}]", "")) / n
    flag = lambda c: c.cast("double")
    out = found.join(cover, "finding", "left")
    out = out.withColumn("n_chars", flag(n)).withColumn("n_turns", flag(n - 1 - turns))
    out = out.withColumn("turn_rate", F.col("n_turns") / n)
    out = out.withColumn("n_distinct", flag(F.size(F.array_distinct(F.split(f, "")))))
    out = out.withColumn("distinct_rate", F.col("n_distinct") / n)
    columns: dict[str, Column] = {
        "digit_rate": rate("0-9"), "upper_rate": rate("A-Z"), "lower_rate": rate("a-z"),
        "hex_only": flag(f.rlike("^[0-9a-f]+$|^[0-9A-F]+$")), "digits_only": flag(f.rlike("^[0-9]+$")),
        "coverage": F.coalesce("coverage", F.lit(0.0)),
        "in_path": flag(before.rlike(r"(://\S*|[/.\\@])$") | after.rlike(r"^(/|\.[A-Za-z0-9]|@)")),
        "n_slashes": flag(F.length(f) - F.length(F.replace(f, F.lit("/"), F.lit("")))),
        "assigned": flag(before.rlike(r"(=|:)\s*[\"']?$")), "quoted": flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        "issuer": flag(f.rlike(ISSUERS)),
        **{f"near_{name}": flag(F.lower(before).contains(name)) for name in NAMES}}
    return out.withColumns(columns)


def rule_labels(found: DataFrame) -> DataFrame:
    """Adds ``label``: 1 for an issuer's format or a value assigned to a telling name, else 0."""
    return found.withColumn("label", (F.col("finding").rlike(ISSUERS) | F.col("before").rlike(TELLING)).cast("double"))


def forest(labelled: DataFrame, sample: int = SAMPLE):
    """A model of the labelled findings (FEATURES and label), or the one label that all of them have.

    About ``sample`` findings are read, the same ones for the same table: a hash of the finding picks them."""
    ends = labelled.agg(F.count("*"), F.min("label"), F.max("label")).first()
    if ends[1] == ends[2]:
        return ends[1] or 0.0
    pick = F.pmod(F.xxhash64("finding", "before"), F.lit(1_000_000)) < max(1, int(1_000_000 * min(1, sample / ends[0])))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled.where(pick)).select("features", "label")
    ends = rows.agg(F.min("label"), F.max("label")).first()
    if ends[0] == ends[1]:
        return ends[0] or 0.0
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(rows)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None,
                 words: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, nth, start, length, finding, probability, is_secret): a row for each candidate.

    start counts characters. labelled: findings with ``finding``, ``before``, ``after`` and ``label`` (0.0 or 1.0); by
    default ``rule_labels`` of the candidates whose document isn't held out (crc32 of the id, modulo 5, is not 0).
    words: the dictionary, by default that of ``docs``. Null and empty texts have no candidates; repeated rows are
    looked at once; rows with a null doc_id take part; an empty table gives an empty result; other columns are
    ignored. If all labels are the same, so is each answer."""
    folder = scratch(docs.sparkSession)
    found = stored(candidates(docs, id_col, text_col), folder, "candidates")
    words = stored(dictionary(docs, text_col) if words is None else words.select("word").distinct(), folder, "words")
    if labelled is None:
        learned = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0, F.lit(False))
        labelled = rule_labels(found.where(learned))
    given = labelled.select("finding", "before", "after", F.col("label").cast("double").alias("label")).where("label in (0, 1)")
    model = forest(stored(featured(given, covered(given, words)), folder, "labelled"), sample)
    known = featured(found, covered(found, words))
    if isinstance(model, float):
        scored = known.withColumn("probability", F.lit(model))
    else:
        scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(known))
        scored = scored.withColumn("probability", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select("doc_id", "nth", "start", F.length("finding").cast("bigint").alias("length"), "finding",
                         "probability", (F.col("probability") >= 0.5).alias("is_secret"))
