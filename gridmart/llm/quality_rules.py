"""Quality rules: a threshold table compiled into one Spark projection (no user functions).

``apply_rules(docs)`` adds the measures, one boolean per rule, ``base_failed`` and ``kept``.
``keep_clean(docs)`` is the filter form: the columns of the input, rejected documents gone.

Defined cases: a null text has no words and fails the length rule; an empty table gives an
empty result; repeated rows are each judged alike; columns of the input are not read beside
``text`` (names of measures that clash with input columns are not carried along).

Repeated five-word windows are compared by 64-bit hashes of their word hashes, inside one
document only. Everything is a built-in expression, so a document never leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import SPACE_RE, words

WINDOW = 5

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    (
        "the of and to in a is that it for on was as with be by at this from are or an "
        "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es "
        "de la le et les des en un du une que est pour qui dans par sur pas au avec "
        "el los las y por se con una del su para como más lo al"
    ).split()
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_marks")


@dataclass(frozen=True)
class Rule:
    """Keep a document whose ``top / per`` lies in [least, most]; ``min_words``: shorter ones pass."""

    name: str
    top: str
    per: str | None = None
    least: float | None = None
    most: float | None = None
    min_words: int = 0

    def passes(self, m: dict[str, Column]) -> Column:
        value = m[self.top].cast("double")
        if self.per:
            value = value / F.greatest(m[self.per], F.lit(1))
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (value >= F.lit(self.least))
        if self.most is not None:
            ok = ok & (value <= F.lit(self.most))
        return ok if not self.min_words else ((m["n_words"] < self.min_words) | ok)


#: The production table.
RULES = (
    Rule("enough_words", "n_words", least=10),
    Rule("word_length", "word_chars", "n_words", least=2.0, most=14.0),
    Rule("few_symbols", "n_symbols", "n_words", most=0.15),
    Rule("few_marks", "n_marks", "n_words", most=0.5),
    Rule("has_stop_words", "n_stop_words", "n_words", least=0.02, min_words=60),
    Rule("few_repeated_lines", "n_dup_lines", "n_lines", most=0.5),
)


def _measures(docs: DataFrame, text: str) -> DataFrame:
    """Adds the measures in a few projections that Catalyst keeps apart (each value computed once)."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    spaces, symbols, marks = F.lit(SPACE_RE), F.lit(r"[^#*$%&|<>]+"), F.lit(r"[^!?]+")
    df = docs.withColumns({
        "_words": words(body),
        "_lines": F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "word_chars": F.length(F.regexp_replace(body, spaces, F.lit(""))).cast("long"),
        "n_symbols": F.length(F.regexp_replace(body, symbols, F.lit(""))).cast("long"),
        "n_marks": F.length(F.regexp_replace(body, marks, F.lit(""))).cast("long"),
    })
    stop = list(STOP_WORDS)
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(stop))).cast("long"),
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
    })
    at = [lambda i, k=k: F.get(F.col("_hashes"), i + k) for k in range(WINDOW)]
    df = df.withColumn(
        "_windows",
        F.when(
            F.col("n_words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), (F.col("n_words") - WINDOW).cast("int")), lambda i: F.xxhash64(*[g(i) for g in at])
            ),
        ),
    )
    # Most texts repeat no window; only the others sort theirs.
    df = df.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    same = lambda s, j: s["h"] == F.get(F.col("_sorted"), j)["h"]
    df = df.withColumn(
        "_at",
        F.sort_array(
            F.transform(
                F.filter(
                    "_sorted",
                    lambda s, j: F.coalesce(same(s, j - 1), F.lit(False)) | F.coalesce(same(s, j + 1), F.lit(False)),
                ),
                lambda s: s["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform("_at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_at"), j + 1) - p, F.lit(WINDOW)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, the measures, ``base_failed``, one boolean per rule (``rule_<name>``) and ``kept``."""
    kept_as = {c: f"_in_{i}" for i, c in enumerate(keep)}
    df = docs.select(*[F.col(c).alias(a) for c, a in kept_as.items()], F.col(text).alias("_text"))
    # The measures pass through a generator of one row: Catalyst does not push a filter on the verdict below it,
    # where it would inline the measures into the filter, once for every use.
    one = F.explode(F.array(F.struct(*MEASURES))).alias("_m")
    df = _measures(df, "_text").select(*kept_as.values(), one).select(*kept_as.values(), "_m.*")
    m = {name: F.col(name) for name in MEASURES}
    base = (m["n_words"] < 10) | (F.lit(100) * m["n_repeat_words"] > F.lit(20) * m["n_words"])
    checks = {f"rule_{r.name}": r.passes(m) for r in rules}
    verdict = ~base
    for ok in checks.values():
        verdict = verdict & ok
    return df.select(
        *[F.col(a).alias(c) for c, a in kept_as.items()],
        *[F.col(c) for c in MEASURES],
        base.alias("base_failed"),
        *[ok.alias(name) for name, ok in checks.items()],
        verdict.alias("kept"),
    )


def keep_clean(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The input's rows and columns, without the documents that the rules reject (one narrow pass)."""
    names = docs.columns
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"), F.col(text).alias("_body"))
    judged = apply_rules(inner, rules, text="_body", keep=("_doc",))
    return judged.where("kept").select(*[F.col("_doc").getField(c).alias(c) for c in names])
