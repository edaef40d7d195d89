"""Chat formatting (operator 2), DataFrame functions only.

A record's layout is known by a fingerprint: a hash of its nested field paths. Tables with typed columns have one
layout, read off the schema; JSON records each have their own, read off the value. LAYOUTS lists declarative
mappings (field paths -> where role and text of the turns are); the fingerprint selects one, and the mapping's
expressions turn the record into canonical turns: array<struct<role, text>>.

The template writes each turn as <|im_start|>role, newline, text, <|im_end|>, newline. Escaping puts a backslash
before every backslash and behind the first character of every control string, so none is left in a text, and
dropping each backslash that isn't itself escaped gives the text back. The loss mask is a list of byte spans, one
for each assistant text.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that tokenizers of chat models treat as control tokens (fixed values).
CONTROL = [START, END, "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>", "<|start_header_id|>",
           "<|end_header_id|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
TURNS = "array<struct<role:string,text:string>>"
#: Layouts: name -> (field paths, schema, turns as an expression over the record {r}).
LAYOUTS = {
    "messages_role_content": (
        ["messages[].content", "messages[].role"], "messages array<struct<role:string,content:string>>",
        "transform({r}.messages, m -> struct(m.role as role, m.content as text))"),
    "conversations_from_value": (
        ["conversations[].from", "conversations[].value"], "conversations array<struct<`from`:string,value:string>>",
        "transform({r}.conversations, m -> struct(case m.`from` when 'human' then 'user' when 'gpt' then 'assistant' "
        "else m.`from` end as role, m.value as text))"),
    "instruction_input_output": (
        ["input", "instruction", "output"], "instruction string, input string, output string",
        "array(struct('user' as role, concat_ws('\\n', {r}.instruction, nullif({r}.input, '')) as text), "
        "struct('assistant' as role, {r}.output as text))"),
    "instruction_output": (
        ["instruction", "output"], "instruction string, output string",
        "array(struct('user' as role, {r}.instruction as text), struct('assistant' as role, {r}.output as text))"),
    "prompt_completion": (
        ["completion", "prompt"], "prompt string, completion string",
        "array(struct('user' as role, {r}.prompt as text), struct('assistant' as role, {r}.completion as text))"),
    "prompt_response": (
        ["prompt", "response"], "prompt string, response string",
        "array(struct('user' as role, {r}.prompt as text), struct('assistant' as role, {r}.response as text))"),
    "system_prompt_response": (
        ["prompt", "response", "system"], "system string, prompt string, response string",
        "array(struct('system' as role, {r}.system as text), struct('user' as role, {r}.prompt as text), "
        "struct('assistant' as role, {r}.response as text))"),
    "question_answer": (
        ["answer", "question"], "question string, answer string",
        "array(struct('user' as role, {r}.question as text), struct('assistant' as role, {r}.answer as text))"),
}
#: Layouts of tables with a row for each turn: name -> (field paths, turns as an aggregate over a conversation's rows).
ROW_LAYOUTS = {
    "turn_rows": (
        ["conv_id", "role", "text", "turn"],
        "transform(sort_array(collect_list(struct(turn, role, text))), x -> struct(x.role as role, x.text as text))"),
}
#: Fields that hold a list of records in some layout.
LISTED = sorted({p.split("[]")[0] for fields, _, _ in LAYOUTS.values() for p in fields if "[]" in p})
KNOWN = sorted({p for fields, _, _ in LAYOUTS.values() for p in fields})
KNOWN_OF_ROWS = sorted({p for fields, _ in ROW_LAYOUTS.values() for p in fields})


def paths(kind: T.DataType, at: str = "") -> list[str]:
    """The leaf paths of a schema: ``a.b`` for fields, ``[]`` for elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(names: list[str]) -> str:
    """Hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(set(names))).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(fields): name for name, (fields, _, _) in LAYOUTS.items()}
ROWS_BY_FINGERPRINT = {fingerprint(fields): name for name, (fields, _) in ROW_LAYOUTS.items()}


def json_fingerprint(record: Column) -> Column:
    """The fingerprint of each JSON record: of its top fields and, for a list of records that a layout lists, of their
    fields; paths that no layout knows are left out, so ids and notes beside the turns don't matter. A list counts as
    such by its JSON type: a text may begin with a bracket."""
    def field(e: Column) -> Column:
        listed = F.from_json(F.when(e["key"].isin(LISTED), e["value"].cast("string")), "array<map<string,string>>")
        inner = F.flatten(F.transform(F.filter(listed, lambda m: m.isNotNull()), F.map_keys))
        paths_ = F.transform(inner, lambda k: F.concat(e["key"], F.lit("[]."), k))
        return (F.when(F.coalesce(F.schema_of_variant(e["value"]).startswith("ARRAY"), F.lit(False)),
                       F.coalesce(paths_, F.array().cast("array<string>"))).otherwise(F.array(e["key"])))

    found = F.flatten(F.transform(F.map_entries(F.from_json(record, "map<string,variant>")), field))
    found = F.array_intersect(found, F.array(*map(F.lit, KNOWN)))
    return F.sha2(F.array_join(F.array_sort(found), "\n").cast("binary"), 256)


def json_turns(records: DataFrame, json_col: str = "record") -> DataFrame:
    """Adds ``layout`` and ``turns`` to records with a JSON object each, of whatever known layout.

    A null, broken or unknown record gets null for both; nothing is guessed. Null texts are empty later on."""
    print_ = json_fingerprint(F.col(json_col))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for own, name in BY_FINGERPRINT.items():
        _, schema, expression = LAYOUTS[name]
        record = f"from_json(`{json_col}`, '{schema}')"
        layout = F.when(print_ == own, F.lit(name)).otherwise(layout)
        turns = F.when(print_ == own, F.expr(expression.format(r=record)).cast(TURNS)).otherwise(turns)
    return records.withColumn("layout", layout).withColumn("turns", turns)


def table_turns(table: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(conv_id, turns) of a table with typed columns, by the fingerprint of its schema.

    Fingerprints are taken over the paths that layouts know, first those of row layouts, then those of records; a
    record layout whose paths are all there is taken if exactly those are there, else the one with most paths. Other
    columns are ignored, no fitting layout is an error. In a table with a row for each turn, turns stand in the
    order of ``turn`` (then role, then text; null first); repeated rows are turns of their own."""
    there = paths(table.schema)
    named = ["conv_id" if p == id_col else p for p in there if p == id_col or p != "conv_id"]
    by_rows = ROWS_BY_FINGERPRINT.get(fingerprint([p for p in named if p in KNOWN_OF_ROWS]))
    if by_rows:
        return (table.groupBy(F.col(id_col).cast("bigint").alias("conv_id"))
                .agg(F.expr(ROW_LAYOUTS[by_rows][1]).cast(TURNS).alias("turns")))
    fitting = {name: fields for name, (fields, _, _) in LAYOUTS.items() if set(fields) <= set(there)}
    exact = BY_FINGERPRINT.get(fingerprint([p for p in there if p in KNOWN]))
    if not fitting:
        raise ValueError(f"no layout has the fields {there}")
    name = exact or max(fitting, key=lambda n: (len(fitting[n]), n))
    _, schema, expression = LAYOUTS[name]
    tops = sorted({p.split("[")[0] for p in LAYOUTS[name][0]})
    return table.select(F.col(id_col).cast("bigint").alias("conv_id"),
                        F.expr(expression.format(r="struct(" + ", ".join(f"`{t}`" for t in tops) + ")")).cast(TURNS).alias("turns"))


def escaped(text: Column) -> Column:
    """Reversible; no control string is left. Null becomes empty."""
    ahead = "|".join("(?<=" + re.escape(c[0]) + ")" + re.escape(c[1:]) for c in CONTROL)
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(text, f"([<\\[])(?={ahead})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """Adds ``formatted`` and ``mask`` to rows with ``turns``.

    mask: for each turn how many characters of its stretch to skip, to take under the loss mask, and then to skip
    again; an assistant's text is taken, nothing else. Null or no turns give an empty text and mask."""
    parts = F.transform(F.coalesce("turns", F.array().cast(TURNS)), lambda t: F.struct(
        F.concat(F.lit(START), F.replace(escaped(t["role"]), F.lit("\n"), F.lit("\\\n")), F.lit("\n")).alias("head"),
        escaped(t["text"]).alias("text"), F.coalesce(t["role"] == "assistant", F.lit(False)).alias("loss")))
    out = turns.withColumn("parts_", parts)
    out = out.withColumn("formatted", F.array_join(F.transform(
        "parts_", lambda p: F.concat(p["head"], p["text"], F.lit(f"{END}\n"))), ""))
    end = len(END) + 1
    mask = F.transform("parts_", lambda p: F.when(p["loss"], F.struct(
        F.length(p["head"]).alias("skip"), F.length(p["text"]).alias("take"), F.lit(end).alias("rest"))).otherwise(F.struct(
            (F.length(p["head"]) + F.length(p["text"]) + end).alias("skip"), F.lit(0).alias("take"), F.lit(0).alias("rest"))))
    return out.withColumn("mask", mask).drop("parts_")


def read_back(texts: DataFrame) -> DataFrame:
    """Adds ``read``, array<struct<role, text, loss>>: the turns as the formatted text has them, and the text
    under the mask in each turn's stretch."""
    stretches = F.split("formatted", re.escape(END) + "\n", -1)
    head = re.escape(START) + r"([^\\\n]*+(?:\\[\s\S][^\\\n]*+)*+)\n"
    out = texts.withColumn("stretches_", F.slice(stretches, 1, F.size("mask")))

    def turn(s: Column, m: Column) -> Column:
        role = F.regexp_extract(s, f"^{head}", 1)
        return F.struct(unescaped(role).alias("role"),
                        unescaped(F.substring(s, F.length(role) + len(START) + 2, F.length(s))).alias("text"),
                        unescaped(F.substring(s, m["skip"] + 1, m["take"])).alias("loss"))

    return out.withColumn("read", F.zip_with("stretches_", "mask", turn)).drop("stretches_")


def digest(texts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output."""
    turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("read", lambda t: t["loss"]), "")
    return read_back(texts).select(
        "conv_id", F.size("read").cast("bigint").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))
