"""Fill-in-middle transformation by counted-quantifier regular expressions.

``regexp_count`` gives a text's n code points. Two hashed cuts a <= b make a pattern of the row's own,
``\\A(unit{a}+)(unit{b-a}+)(rest)\\z``, whose possessive groups capture prefix, middle and suffix in one
match: the match itself writes the output (``regexp_replace`` with a replacement that orders the groups).
Possessive counts never back up, so a text of any length is read once and without recursion. Everything
is a built-in expression in one narrow projection: no shuffle, no Python.

Cuts and forms come from the hex SHA-256 of ``<seed>:<doc_id>``; its first four 8-digit groups are h1 to
h4. Prefix ends after min(h1 % (n+1), h2 % (n+1)) code points, middle after the larger. A text is left
plain if it is empty, holds a marker, or h3 % 100 >= ``fim_percent``; else it takes the order
suffix-prefix-middle if h4 % 100 < ``spm_percent``, and prefix-suffix-middle otherwise.

``restore`` inverts the output from (output, form) alone: markers do not occur in transformed texts, so
their first occurrences part it.

Defined cases: a null text counts as empty and is plain; a null doc_id is hashed as the empty string;
repeated rows give equal rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 1
FIM_PERCENT = 90
SPM_PERCENT = 20

#: One code point, line ends too.
UNIT = "(?s:.)"
#: Code points that one match counts, largest first: bounds the matches of a text that are held at once.
BLOCKS = (4096, 64, 1)


def count_units(text: Column) -> Column:
    """Code points of a text: its whole blocks, then smaller ones in what lies behind them."""
    total = F.lit(0).cast("long")
    for size in BLOCKS:
        block = f"{UNIT}{{{size}}}+"
        total = total + F.regexp_count(text, F.lit(block)).cast("long") * size
        text = F.regexp_replace(text, F.lit(rf"\A(?:{block})*+"), F.lit(""))
    return total


def draw(digest: Column, k: int) -> Column:
    """The k-th (from 0) group of 8 hex digits, as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _quoted(marker: str) -> str:
    return marker.replace("\\", "\\\\").replace("$", r"\$")


def _order(form: Column, psm: str, spm: str) -> Column:
    return F.when(form == SPM, F.lit(spm)).otherwise(F.lit(psm))


def transform(
    docs: DataFrame,
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """Per document: doc_id, n, form, prefix_chars, middle_chars (null if plain), output."""
    prefix, suffix, middle = map(_quoted, markers)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        digest.alias("digest"),
    ).withColumn("n", count_units(F.col("text")))
    marked = F.contains("text", F.lit(markers[0])) | F.contains("text", F.lit(markers[1])) | F.contains("text", F.lit(markers[2]))
    plain = (F.col("n") == 0) | (draw(F.col("digest"), 2) % 100 >= fim_percent) | marked
    turned = draw(F.col("digest"), 3) % 100 < spm_percent
    first, second = (draw(F.col("digest"), k) % (F.col("n") + 1) for k in (0, 1))
    cut = counted.withColumns({
        "form": F.when(plain, PLAIN).when(turned, SPM).otherwise(PSM),
        "a": F.least(first, second),
        "b": F.greatest(first, second),
    })
    counts = [F.lit(rf"\A({UNIT}{{"), F.col("a"), F.lit(rf"}}+)({UNIT}{{"), F.col("b") - F.col("a"), F.lit(rf"}}+)({UNIT}*+)\z")]
    pattern = F.concat(*[c.cast("string") for c in counts])
    written = _order(F.col("form"), f"{prefix}$1{suffix}$3{middle}$2", f"{suffix}$3{prefix}$1{middle}$2")
    whole = F.col("form") == PLAIN
    return cut.select(
        "doc_id",
        "n",
        "form",
        F.when(~whole, F.col("a")).alias("prefix_chars"),
        F.when(~whole, F.col("b") - F.col("a")).alias("middle_chars"),
        F.when(whole, F.col("text")).otherwise(F.regexp_replace("text", pattern, written)).alias("output"),
    )


def restore(output: Column, form: Column, markers: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text again, from the output and its form: the three parts are captured in one match."""
    prefix, suffix, middle = map(re.escape, markers)
    part = f"({UNIT}*?)"
    pattern = _order(form, rf"\A{prefix}{part}{suffix}{part}{middle}({UNIT}*+)\z", rf"\A{suffix}{part}{prefix}{part}{middle}({UNIT}*+)\z")
    return F.when(form == PLAIN, output).otherwise(F.regexp_replace(output, pattern, _order(form, "$1$3$2", "$2$3$1")))
