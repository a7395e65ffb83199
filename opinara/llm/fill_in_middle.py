"""Fill-in-the-middle rewriting by a counted-quantifier regular expression.

A text is a row of units (lines, by default). ``regexp_count`` gives their number, two draws give
the bounds ``a <= b``, and the row gets a pattern of its own: ``unit{a}+``, ``unit{b-a}+`` and the
rest, each in a group. One match then holds prefix, middle and suffix, and one replacement writes
them in their new order. The quantifiers are possessive: units are matched from left to right and
never given back, so the matcher loops over them and needs no stack however many there are.

Everything is an expression over the row: one scan, no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.llm.common import documents, whole_text

#: A line with its end, or a last line without one.
LINE = r"[^\n]*\n|[^\n]+"


@dataclass(frozen=True)
class FimConfig:
    seed: int = 7
    #: Of 100 texts, so many are rewritten, and of those, so many suffix first.
    rewritten: int = 100
    suffix_first: int = 50
    #: What a unit is: adjacent matches have to cover the text.
    unit: str = LINE
    prefix_mark: str = "<P>"
    suffix_mark: str = "<S>"
    middle_mark: str = "<M>"

    def __post_init__(self):
        marks = (self.prefix_mark, self.suffix_mark, self.middle_mark)
        overlap = any(a.endswith(b[:k]) for a in marks for b in marks for k in range(1, len(b)))
        if not all(marks) or overlap or any(a in b for a in marks for b in marks if a is not b):
            raise ValueError("marks have to be there and must not overlap, or outputs could not be undone")


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a document, the same in every run."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    hexed = F.sha2(named.cast("binary"), 256)
    return [F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _replacement(*parts: str) -> Column:
    """Group numbers and marks as a replacement; ``$`` and backslashes of marks are themselves."""
    return F.lit("".join(p if p.startswith("$") and p[1:].isdigit() else p.replace("\\", "\\\\").replace("$", "\\$") for p in parts))


def fill_in_middle(docs: DataFrame, config: FimConfig = FimConfig()) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, text, n, form, prefix_chars, middle_chars, output``.

    ``form`` is ``plain``, ``psm`` or ``spm``; lengths are in code points and null for plain ones.
    A null text is an empty one (n 0, plain). A text that holds a mark stays plain, so ``restored``
    can undo every output. A null id draws as an empty one does; repeated rows are rewritten alike.
    Texts of any length are matched whole. An empty table gives no rows; other columns, whatever
    their names, are ignored.
    """
    unit = f"(?:{config.unit})"
    marks = [config.prefix_mark, config.suffix_mark, config.middle_mark]
    h1, h2, h3, h4 = draws(F.col("doc_id"), config.seed)
    rows = docs.select("doc_id", whole_text(F.col("text").cast("string")).alias("text"))
    counted = rows.withColumn("n", F.regexp_count("text", F.lit(unit)).cast("long"))
    bounds = [F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)), F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))]
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains("text", F.lit(mark))
    form = F.when((F.col("text") == "") | marked | (h3 % 100 >= config.rewritten), "plain")
    form = form.when(h4 % 100 < config.suffix_first, "spm").otherwise("psm")
    drawn = counted.select("*", form.alias("form"), bounds[0].alias("first"), (bounds[1] - bounds[0]).alias("between"))
    # (?s): the rest runs over line feeds.
    pattern = F.concat(F.lit(rf"(?s)\A({unit}{{"), "first", F.lit(rf"}}+)({unit}{{"), "between", F.lit(r"}+)(.*)\z"))
    prefix, suffix, middle = marks
    order = F.when(F.col("form") == "spm", _replacement(suffix, "$3", prefix, "$1", middle, "$2"))
    order = order.otherwise(_replacement(prefix, "$1", suffix, "$3", middle, "$2"))
    written = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace(F.col("text"), pattern, order))
    out = drawn.withColumn("output", written)
    # Marks are in no rewritten text, so their places in the output tell the lengths.
    at = {mark: F.instr("output", F.lit(mark)) for mark in marks}
    after_prefix = F.when(F.col("form") == "spm", at[middle]).otherwise(at[suffix])
    spliced = F.when(F.col("form") != "plain", after_prefix - at[prefix] - len(prefix))
    tail = F.when(F.col("form") != "plain", F.char_length("output") - at[middle] - len(middle) + 1)
    return out.select(
        "doc_id", "text", "n", "form", spliced.cast("long").alias("prefix_chars"), tail.cast("long").alias("middle_chars"), "output"
    )


def restored(output: Column, form: Column, config: FimConfig = FimConfig()) -> Column:
    """The text that ``fill_in_middle`` made ``output`` from."""
    prefix, suffix, middle = (rf"\Q{m}\E(.*)" for m in (config.prefix_mark, config.suffix_mark, config.middle_mark))
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{prefix}{suffix}{middle}\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{suffix}{prefix}{middle}\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(documents(spark, sf_dir))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        _sha256(F.col("output")).alias("output_sha256"),
        _sha256(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


OP12_SQL = r"""
WITH lines AS (
    SELECT doc_id, coalesce("text", '') AS txt,
           regexp_extract_all(coalesce("text", ''), '[^\n]*\n|[^\n]+') AS line,
           sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS hex
    FROM documents
), drawn AS (
    SELECT doc_id, txt, line, len(line) AS n,
           ('0x' || hex[1:8])::BIGINT % (len(line) + 1) AS x, ('0x' || hex[9:16])::BIGINT % (len(line) + 1) AS y,
           ('0x' || hex[17:24])::BIGINT % 100 AS h3, ('0x' || hex[25:32])::BIGINT % 100 AS h4
    FROM lines
), formed AS (
    SELECT doc_id, txt, n,
           CASE WHEN txt = '' OR contains(txt, '<P>') OR contains(txt, '<S>') OR contains(txt, '<M>') OR h3 >= 100
                THEN 'plain' WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form,
           array_to_string(line[1:least(x, y)], '') AS a,
           array_to_string(line[least(x, y) + 1:greatest(x, y)], '') AS b,
           array_to_string(line[greatest(x, y) + 1:], '') AS c
    FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(a)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN txt WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
                        ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(txt) AS restored_sha256
FROM formed
"""
