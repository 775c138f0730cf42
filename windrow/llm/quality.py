"""Quality rules as a ledger: every rule is evaluated once per document, policies come later.

A ledger row holds the measurements of a document and ``failed_bits``, one bit per rule it fails.
A policy is a named set of rules; applying one, or asking what each rule alone removes, is
arithmetic on the bits and never reads a text again. All of it is built-in expressions, without a
shuffle up to the ablations, which group by the bits first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.text import SPACE, words_of

#: Words in the windows whose repetition counts.
WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition on the measurements, in whole numbers."""

    name: str
    bit: int
    fails: str


#: A rule keeps its bit for ever, so that ledgers of any age can be read.
RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("shouting", 3, "2 * n_upper > n_letters"),
    Rule("repeated_lines", 4, "100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", 5, "word_chars < 2 * n_words or word_chars > 15 * n_words"),
)
#: Policies by version; one that is published doesn't change.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols"),
    "v2": ("few_words", "repeated_words", "symbols", "shouting"),
    "strict": ("few_words", "repeated_words", "symbols", "shouting", "repeated_lines", "word_length"),
}
DEFAULT_POLICY = "v2"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters",
)


def mask_of(policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    bits = {rule.name: rule.bit for rule in rules}
    return sum(1 << bits[name] for name in set(names))


def measure(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with a column ``measures``, a struct of the whole numbers that rules look at.

    A null text counts as an empty one: all its measurements are zero.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    # Each step is used more than once by the next, so the optimizer keeps them apart.
    found = documents.withColumn("_words", words_of(text)).withColumn(
        "_hashes", F.transform("_words", lambda w: F.xxhash64(w))
    )
    starts = F.sequence(F.lit(0), F.size("_words") - WINDOW)

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)])

    windows = F.when(F.size("_words") >= WINDOW, F.transform(starts, window_hash)).otherwise(
        F.array().cast("array<bigint>")
    )
    found = found.withColumn("_windows", windows)
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    found = found.withColumn("_placed", F.when(repeats, F.sort_array(placed)))

    def same(p: Column, j: Column) -> Column:
        return F.coalesce(F.get("_placed", j)["h"] == p["h"], F.lit(False))

    again = F.filter("_placed", lambda p, j: same(p, j - 1) | same(p, j + 1))
    found = found.withColumn("_again", F.sort_array(F.transform(again, lambda p: p["i"])))
    # A repeated window covers its words up to the next repeated one.
    covered = F.transform(
        "_again", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_again", j + 1) - p, F.lit(WINDOW)))
    )
    n_repeat = F.coalesce(F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0))
    found = found.withColumn("_lines", F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    measures = {
        "n_words": F.size("_words"),
        "word_chars": F.length(whole) - F.regexp_count(whole, F.lit(SPACE)),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOLS)),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": n_repeat,
        "n_upper": F.regexp_count(whole, F.lit(r"\p{Lu}")),
        "n_letters": F.regexp_count(whole, F.lit(r"\p{L}")),
    }
    struct = F.struct(*[value.cast("bigint").alias(name) for name, value in measures.items()])
    return found.withColumn("measures", struct).select(*documents.columns, "measures")


def ledger(documents: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``key``, the measurements and ``failed_bits``: one row per row of the input, in one pass.

    Nulls: a null text is an empty one, a null key stays null. Repeated rows give repeated rows, an
    empty table an empty ledger. Other columns of the input take no part, whatever their names.
    """
    inner = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = measure(inner, "_text").select(F.col("_key").alias(key), "measures.*")
    bits = F.lit(0).cast("bigint")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0).cast("bigint"))
    return rows.withColumn("failed_bits", bits)


def passes(policy: str | Sequence[str] = DEFAULT_POLICY, bits: str = "failed_bits", rules: Sequence[Rule] = RULES):
    """Column: no rule of the policy failed."""
    return F.col(bits).bitwiseAND(F.lit(mask_of(policy, rules)).cast("bigint")) == 0


def keep(documents: DataFrame, policy: str | Sequence[str] = DEFAULT_POLICY, text: str = "text") -> DataFrame:
    """The documents that the policy keeps, with the columns they came with.

    Rules are evaluated beside the row, so that nothing is joined or shuffled.
    """
    inner = documents.select(F.struct(*documents.columns).alias("_row"), F.col(text).alias("_text"))
    names = set(POLICIES[policy] if isinstance(policy, str) else policy)
    measured = measure(inner, "_text").select("_row", "measures.*")
    failed = F.lit(False)
    for rule in RULES:
        if rule.name in names:
            failed = failed | F.expr(rule.fails)
    # As a filter the condition would move below the measuring steps, each copied into the next.
    return measured.select(F.inline(F.when(~failed, F.array("_row"))))


def ablations(
    ledger_rows: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``policy, rule, n_failed, n_only, n_kept``: what each rule removes, and what it alone removes.

    The ledger is first grouped by its bits, so what is left has at most a row for each set of
    rules. ``n_kept`` is what the policy keeps. An empty ledger gives zeros.
    """
    bit = {rule.name: 1 << rule.bit for rule in rules}
    pairs = [(p, r, mask_of(names, rules), bit[r]) for p, names in policies.items() for r in names]
    asked = ledger_rows.sparkSession.createDataFrame(pairs, "policy string, rule string, mask bigint, bit bigint")
    sets = ledger_rows.groupBy("failed_bits").agg(F.count("*").alias("n"))
    every = F.collect_list(F.struct("failed_bits", "n"))
    counted = asked.crossJoin(F.broadcast(sets.agg(every.alias("sets"))))

    def total(keep_set) -> Column:
        return F.aggregate(
            F.filter("sets", keep_set), F.lit(0).cast("bigint"), lambda a, s: a + s["n"]
        )

    return counted.select(
        "policy",
        "rule",
        total(lambda s: s["failed_bits"].bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        total(lambda s: s["failed_bits"].bitwiseAND(F.col("mask")) == F.col("bit")).alias("n_only"),
        total(lambda s: s["failed_bits"].bitwiseAND(F.col("mask")) == 0).alias("n_kept"),
    )
