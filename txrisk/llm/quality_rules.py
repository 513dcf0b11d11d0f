"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document.  The ledger keeps the
measurements and one BIGINT, ``fail_bits``, in which bit i says that rule i
failed.  A policy is a version with a mask of rules: applying it, or
comparing many policies, is bitwise arithmetic on the stored ledger and
never reads a text again.  Ablations group the ledger by its few distinct
bit patterns first, so each rule's solo rejections come from a small table.

Edge cases: a null text has no words, fails ``few_words`` and keeps its row;
an empty table gives an empty ledger; repeated rows are judged alike;
further columns pass through, and a column of the input named like one of
the ledger's is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import SPACE, let, text_of

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letters", "n_upper", "n_exclaim", "n_broken", "n_ellipsis_lines", "longest_word")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Column


def rules() -> list[Rule]:
    """The rules; a rule's place in this list is its bit, so only append."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return [
        Rule("few_words", words < 10),
        Rule("repeat_words", 100 * F.col("n_repeat_words") > 20 * words),
        Rule("symbols", 100 * F.col("n_symbols") > 25 * words),
        Rule("capitals", 100 * F.col("n_upper") > 50 * F.col("n_letters")),
        Rule("dup_lines", 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
        Rule("short_words", 10 * chars < 15 * words),
        Rule("long_words", chars > 25 * words),
        Rule("few_letters", 100 * F.col("n_letters") < 50 * chars),
        Rule("exclaims", 100 * F.col("n_exclaim") > 30 * words),
        Rule("broken_chars", 100 * F.col("n_broken") > chars),
        Rule("ellipses", 100 * F.col("n_ellipsis_lines") > 30 * F.col("n_lines")),
        Rule("endless_word", F.col("longest_word") > 1000),
    ]


#: Rules of each policy version; a stored ledger can be judged by any of them.
POLICIES = {
    "base": ("few_words", "repeat_words"),
    "v1": ("few_words", "repeat_words", "symbols", "capitals", "dup_lines", "short_words", "long_words",
           "few_letters", "exclaims", "broken_chars", "ellipses"),
    "strict": ("few_words", "repeat_words", "symbols", "capitals", "dup_lines", "short_words", "long_words",
               "few_letters", "exclaims", "broken_chars", "ellipses", "endless_word"),
}
PRODUCTION = "v1"


def policy_mask(version: str) -> int:
    place = {r.name: i for i, r in enumerate(rules())}
    return sum(1 << place[name] for name in POLICIES[version])


def _count_of(text: Column, pattern: str) -> Column:
    """Characters of the text that the pattern's runs cover."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _repeat_words(words: Column) -> Column:
    """Words covered by a 5-word window that occurs twice or more.

    Windows are compared by their 64-bit hashes, within one text only.  When
    any repeats, the hashes are sorted with their places, equal neighbours
    marked, and the places of the marked windows merged.
    """
    def hashes(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))

    def covered(places):
        return let(F.sort_array(places), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda total, x: total + x))

    def repeated(g):
        ordered = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: covered(F.transform(
            F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"])))

    def count(w):
        return let(hashes(w), lambda g: F.when(
            F.size(F.array_distinct(g)) < F.size(g), repeated(g)).otherwise(F.lit(0)))

    return F.when(F.size(words) > WINDOW, let(words, count)).otherwise(F.lit(0)).cast("long")


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the measurements and ``fail_bits``."""
    t = F.col("_text")
    rows = docs.drop(*MEASURES, "fail_bits").withColumn("_text", text_of(text)).withColumns({
        "_words": F.filter(F.split(t, SPACE), lambda w: w != ""),
        "_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    words, lines = F.col("_words"), F.col("_lines")
    rows = rows.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.regexp_replace(t, SPACE, "")).cast("long"),
        "n_symbols": _count_of(t, r"[#*$%&|<>]+"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _repeat_words(words),
        "n_letters": F.length(F.regexp_replace(t, r"\P{L}+", "")).cast("long"),
        "n_upper": _count_of(t, r"\p{Lu}+"),
        "n_exclaim": _count_of(t, "!+"),
        "n_broken": _count_of(t, r"[\x00-\x08\x0E-\x1F\x7F�]+"),
        "n_ellipsis_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).cast("long"),
        "longest_word": F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)).cast("long"),
    }).drop("_text", "_words", "_lines")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules()):
        bits = bits.bitwiseOR(F.when(rule.fails, F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return rows.withColumn("fail_bits", bits)


def apply_policy(judged: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """``kept`` by a policy, from the ledger's bits alone."""
    return judged.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(policy_mask(version))) == 0)


def ablations(judged: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and
    that would be kept without it (rule, n_failed, n_only, kept_without)."""
    mask = policy_mask(version)
    place = {r.name: i for i, r in enumerate(rules())}
    patterns = judged.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count("*").alias("n"))
    each = patterns.select("bits", "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(1 << place[name]).cast("long").alias("bit"))
        for name in POLICIES[version]])).alias("r")).select("bits", "n", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n")).otherwise(0)).alias("kept_without"))


def keep_good(docs: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """Filter: the rows of ``docs`` that the policy keeps, columns unchanged."""
    inner = docs.select(F.struct("*").alias("_row"), F.col("text").alias("text"))
    return apply_policy(ledger(inner), version).where("kept").select("_row.*")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, then the ledger's bits and what the policy adds."""
    base = policy_mask("base")
    judged = apply_policy(ledger(docs.select("doc_id", "text")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (F.col("fail_bits").bitwiseAND(F.lit(base)) != 0).alias("base_failed"), "kept",
                         "fail_bits", "n_letters", "n_upper", "n_exclaim")
