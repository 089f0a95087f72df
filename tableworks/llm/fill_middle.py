"""Fill-in-the-middle transformation by counted quantifiers.

A text is a run of units (white space with the word after it, or white space at
the end).  ``regexp_count`` gives their number ``n``; two cut places come from a
keyed hash of the id.  A pattern made for the row, ``((?:unit){a}+)`` and
``((?:unit){b-a}+)`` and the rest, captures prefix, middle and suffix in a single
match, and the replacement writes them in the order of the row's form.  Possessive
groups never give back a unit, so the regular expression engine loops over them
and needs no stack, however long the text is.

One projection: no shuffle, no Python worker.

Defined results: a null or empty text gives an empty output of form ``plain``
with ``n`` 0; a null id is hashed as an empty string; equal rows come out equal
(same id, same text); a text that holds one of the markers stays plain, so every
output can be taken apart again; an empty table gives no rows.  All columns of
the input stay; one named like a new column is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableworks.llm.common import SPACE_CLASS

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, SPM, PSM = "plain", "spm", "psm"

#: White space and the word after it, or what white space is left at the end.
UNIT = f"[{SPACE_CLASS}]*+[^{SPACE_CLASS}]++|[{SPACE_CLASS}]++"

NEW_COLUMNS = ("fim_text", "form", "n", "prefix_chars", "middle_chars")


def id_hashes(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, fim_percent: int = 50, spm_percent: int = 80
) -> DataFrame:
    """Every row with ``fim_text`` and how it was made.

    ``fim_percent`` of the texts are transformed, ``spm_percent`` of these to
    suffix-prefix-middle, the others to prefix-suffix-middle.  ``n`` counts the
    units; ``prefix_chars`` and ``middle_chars`` are code points, null in a plain
    row.
    """
    clash = sorted({*NEW_COLUMNS, *_HELPERS} & set(docs.columns))
    if clash:
        raise ValueError(f"the table already has the columns {clash}")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    h1, h2, h3, h4 = id_hashes(F.col(f"`{id_col}`"), seed)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = (
        F.when((text == "") | marked | (F.pmod(h3, F.lit(100)) >= fim_percent), F.lit(PLAIN))
        .when(F.pmod(h4, F.lit(100)) < spm_percent, F.lit(SPM))
        .otherwise(F.lit(PSM))
    )
    counted = docs.withColumns({"n": F.regexp_count(text, F.lit(UNIT)).cast("long"), "form": form})
    one, two = (F.pmod(h, F.col("n") + 1) for h in (h1, h2))
    placed = counted.withColumns({"__a": F.least(one, two), "__b": F.greatest(one, two)})
    unit = f"((?:{UNIT}){{"
    pattern = F.concat(F.lit(rf"\A{unit}"), F.col("__a"), F.lit("}+)" + unit), F.col("__b") - F.col("__a"), F.lit(r"}+)((?s:.*+))"))
    order = F.when(F.col("form") == SPM, F.lit(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")).otherwise(F.lit(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"))
    plain = F.col("form") == PLAIN
    made = placed.withColumn("fim_text", F.when(plain, text).otherwise(F.regexp_replace(text, pattern, order)))
    parts = F.when(~plain, _parts(F.col("fim_text")))
    prefix = F.when(F.col("form") == SPM, parts[2]).otherwise(parts[1])
    lengths = {"prefix_chars": F.length(prefix).cast("long"), "middle_chars": F.length(parts[3]).cast("long")}
    return made.withColumns(lengths).select(*[F.col(f"`{c}`") for c in docs.columns], *NEW_COLUMNS)


_HELPERS = ("__a", "__b")


def _parts(output: Column) -> Column:
    """An empty string, then the parts of an output that isn't plain, in its order.

    No part holds a marker and none can begin inside a part and end outside it,
    so each marker stands there exactly once.
    """
    return F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)


def restore_text(output: Column, form: Column) -> Column:
    """The text that ``output`` of this ``form`` was made from."""
    parts = _parts(output)
    joined = F.when(form == SPM, F.concat(parts[2], parts[3], parts[1])).otherwise(F.concat(parts[1], parts[3], parts[2]))
    return F.when(form == PLAIN, output).otherwise(joined)
