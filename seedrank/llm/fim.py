"""Fill-in-middle transformation by counted-quantifier regular expressions.

A text of n units (code points) is cut into prefix, middle and suffix and written with markers:
psm ``<P>``prefix``<S>``suffix``<M>``middle, spm ``<S>``suffix``<P>``prefix``<M>``middle, or plain
(unchanged). ``regexp_count`` gives n: whole blocks of ``BLOCK`` units first, then single units of
the rest, so a long text is never held as one string a unit. The cut is one match of a pattern made
for the row, ``unit{a}+`` and ``unit{b-a}+`` in possessive groups and the rest, whose groups the
replacement puts in order. ``restore`` rebuilds the text from output and form alone: a text that
holds a marker stays plain, and no marker overlaps itself, so the first markers found are the ones written.

Everything is a column expression: one pass, no shuffle, no Python on the executors.

The draws come from the sha256 of ``<seed>:<doc_id>``; a null doc_id draws as the empty string. Null
text counts as empty; empty text, and text with a marker, is plain. Equal rows give equal results, an
empty table no rows, and extra columns are ignored (``examples`` names its own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: the markers, and shares of plain and of spm rows in percent
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
UNIT = "."
#: units of a block when counting
BLOCK = 1024
#: a row's pattern must be the same in every mode of the session: dot matches all, anchored at both ends
_HEAD, _TAIL = r"(?s)\A", r"\z"


def count_units(text: Column) -> Column:
    """Number of units, by ``regexp_count`` over blocks and over what follows the last whole block."""
    blocks = F.regexp_count(text, F.lit(f"(?s){UNIT}{{{BLOCK}}}+"))
    rest = F.substring(text, blocks * F.lit(BLOCK) + F.lit(1), F.lit(BLOCK))
    return blocks.cast("long") * F.lit(BLOCK) + F.regexp_count(rest, F.lit(f"(?s){UNIT}")).cast("long")


def cut_pattern(a: Column, b: Column) -> Column:
    """Pattern of a row: the first ``a`` units, the next ``b - a``, and the rest."""
    return F.concat(F.lit(f"{_HEAD}({UNIT}{{"), a.cast("string"), F.lit(f"}}+)({UNIT}{{"), (b - a).cast("string"), F.lit(f"}}+)({UNIT}*+){_TAIL}"))


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of a row."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def restore(output: Column, form: Column) -> Column:
    """The text that gave ``output`` in ``form``."""
    def parse(first: str, second: str) -> Column:
        return F.lit(f"{_HEAD}{first}({UNIT}*?){second}({UNIT}*?){MIDDLE}({UNIT}*+){_TAIL}")

    psm = F.regexp_replace(output, parse(PREFIX, SUFFIX), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, parse(SUFFIX, PREFIX), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def examples(docs: DataFrame, seed: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row; the counts are null if plain."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    t = F.col("text")
    marked = t.contains(PREFIX) | t.contains(SUFFIX) | t.contains(MIDDLE)
    form = (F.when((t == "") | marked | (h3 % 100 >= PLAIN_FROM), "plain").when(h4 % 100 < SPM_BELOW, "spm").otherwise("psm"))
    rows = rows.select("doc_id", "text", count_units(t).alias("n"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    x, y = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    rows = rows.select("doc_id", "text", "n", "form", F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    cut = F.col("form") != "plain"
    return rows.select(
        "doc_id", "n", "form", F.when(cut, F.col("a")).alias("prefix_chars"), F.when(cut, F.col("b") - F.col("a")).alias("middle_chars"),
        F.when(cut, F.regexp_replace("text", cut_pattern(F.col("a"), F.col("b")), order)).otherwise(F.col("text")).alias("output"))


def digests(docs: DataFrame, **how) -> DataFrame:
    """``examples`` with output and restored text as sha256."""
    e = examples(docs, **how)
    return e.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                    F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
