"""Quality rules as a short-circuit cascade, by DataFrame functions only.

Each rule is an expression that is true where a text must go, with a count of the work it takes. On
a bounded sample, written once, one aggregation gives the rules' rejection rates and mean work; no
clock has a say, so the same rows give the same order. The cascade asks rules by falling rejections
per work, and a text that one rule rejects is not put
to the others. The order changes the cost, never the verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.frames import bind
from shopgrain.session import materialise

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"


def words(text: Column) -> Column:
    """The words of a text: what white space of ASCII parts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda w: w != "")


def word_chars(text: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")).cast("bigint")


def n_symbols(text: Column) -> Column:
    kept = F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SYMBOLS}]+", "")
    return F.char_length(kept).cast("bigint")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1),
                     lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return bind(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def n_repeat_words(found: Column) -> Column:
    """Words in windows of three that occur twice or more.

    Windows are sorted with their places; a window like the one before or behind it in that order
    is repeated, and the places it covers are counted once.
    """
    def covered(ws: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(ws) - 3), lambda i: F.struct(
            F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("w"),
            i.alias("i")))

        def repeated(s: Column) -> Column:
            again = F.filter(s, lambda x, k: (F.get(s, k - 1)["w"] == x["w"])
                             | (F.get(s, k + 1)["w"] == x["w"]))
            return F.size(F.array_distinct(F.flatten(F.transform(
                again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        # Without a repeated window, which is the usual case, nothing needs its place.
        return bind(F.sort_array(windows), repeated)

    return bind(found, lambda ws: F.when(F.size(ws) >= 4, covered(ws)).otherwise(0).cast("bigint"))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column
    work: Column | None = None  # characters read for it, or None for measures at hand


def default_rules(text: str = "text") -> list[Rule]:
    """Rules on the text and on its measures (see `measure`)."""
    body = F.coalesce(F.col(text), F.lit(""))
    n, length = F.greatest(F.col("n_words"), F.lit(1)), F.char_length(body)
    lines = F.size(F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    letters = F.greatest(F.char_length(F.regexp_replace(body, r"\P{L}+", "")), F.lit(1))
    return [
        Rule("symbols", F.col("n_symbols") * 10 > n),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("same_lines", F.col("n_dup_lines") * 2 > F.greatest(lines, F.lit(1)), 2 * length),
        Rule("capitals", F.char_length(F.regexp_replace(body, r"\P{Lu}+", "")) * 2 > letters,
             2 * length),
        Rule("exclamations", F.char_length(F.regexp_replace(body, r"[^!]+", "")) * 10 > n, length),
        Rule("few_letters", F.char_length(F.regexp_replace(body, r"\P{L}+", "")) * 2
             < F.col("word_chars"), length),
    ]


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of whole texts."""
    t = F.col(text)
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    counted = F.transform(F.array(words(t)), lambda ws: F.struct(
        F.size(ws).cast("bigint").alias("n"), n_repeat_words(ws).alias("r")))[0]
    return df.drop(*made).withColumns({
        "quality_words": counted, "word_chars": word_chars(t), "n_symbols": n_symbols(t),
        "n_dup_lines": n_dup_lines(t)}).withColumns({
            "n_words": F.col("quality_words")["n"], "n_repeat_words": F.col("quality_words")["r"],
        }).drop("quality_words")


def base_failed() -> Column:
    """Too few words, or mostly repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def order_rules(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Rules by falling rejections per work on the sample; ties keep their order."""
    seen = sample.agg(*[a for i, r in enumerate(rules) for a in (
        F.avg(F.coalesce(r.rejects, F.lit(False)).cast("int")).alias(f"rate_{i}"),
        F.avg(1 + (F.lit(0) if r.work is None else r.work)).alias(f"work_{i}"))]).first()
    by_worth = sorted(range(len(rules)), key=lambda i: -(seen[f"rate_{i}"] or 0.0) / (
        seen[f"work_{i}"] or 1.0))
    return [rules[i] for i in by_worth]


def cascade(rules: list[Rule]) -> Column:
    """The name of the first rule that rejects, else NULL; CASE asks no further than that."""
    verdict = F.when(rules[0].rejects, F.lit(rules[0].name))
    for rule in rules[1:]:
        verdict = verdict.when(rule.rejects, F.lit(rule.name))
    return verdict


def apply_rules(
    df: DataFrame, text: str = "text", rules: list[Rule] | None = None,
    sample_rows: int = 1000,
) -> DataFrame:
    """df with its measures, base_failed, rejected_by (a rule's name or NULL) and kept.

    NULL and empty texts have no words and fail the base. Work and rejections are
    estimated on about sample_rows rows drawn from the whole of df; they decide the order of the
    rules alone. Texts that failed the base are not put to the
    cascade. Rows are independent, and there is no shuffle. Columns of the added names are replaced.
    """
    rules = rules or default_rules(text)
    share = min(1.0, sample_rows / max(df.count(), 1))
    sample = materialise(measure(df.select(text).sample(share, seed=7), text), "rule_sample")
    ordered = order_rules(sample, rules)
    made = measure(df.drop("base_failed", "rejected_by", "kept"), text)
    made = made.withColumn("base_failed", base_failed())
    made = made.withColumn("rejected_by", F.when(~F.col("base_failed"), cascade(ordered)))
    return made.withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
