"""Quality rules: a ledger of rule failures, policies over it, and ablations.

``ledger`` evaluates every rule once and keeps the measurements and one failure bit per
rule. A policy is a named, versioned set of rules; applying or changing one is a bitwise
test on the ledger and reads no text. ``ablations`` counts, for each rule of a policy, what
it rejects, what it alone rejects and so what would stay without it, from the counts of
distinct bit patterns.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import SPACES, let

SYMBOLS = "#*$%&|<>"
_SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Measurements of a ledger, beside the columns asked for.
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
)


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the measurements by name and says whether the text fails."""

    name: str
    fails: Callable[[Mapping[str, Column]], Column]


@dataclass(frozen=True)
class Policy:
    """A text is kept if it fails none of ``rejecting`` and at most ``tolerated`` of the rest."""

    name: str
    version: int
    rejecting: tuple[str, ...]
    counted: tuple[str, ...] = ()
    tolerated: int = 0


#: Ratios are compared as integer products, so that no rounding decides.
RULES: tuple[Rule, ...] = (
    Rule("too_few_words", lambda m: m["n_words"] < 50),
    Rule("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("short_words", lambda m: m["word_chars"] < 3 * m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 10 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule("some_repetition", lambda m: 100 * m["n_repeat_words"] > 25 * m["n_words"]),
    Rule("shouting", lambda m: 10 * m["n_upper"] > 3 * m["word_chars"]),
    Rule("too_many_words", lambda m: m["n_words"] > 100_000),
)

BASE = Policy("base", 1, ("too_few_words", "repeated_windows"))
STRICT = Policy(
    "web",
    1,
    (
        "too_few_words",
        "repeated_windows",
        "short_words",
        "long_words",
        "symbols",
        "repeated_lines",
        "shouting",
    ),
    ("some_repetition", "too_many_words"),
    tolerated=1,
)


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows are numbered by their place. Sorted by their 64-bit hash, equal ones are
    neighbours; their places in order cover three words each, or fewer up to the next
    place.
    """

    def window_hashes(words):
        places = F.sequence(F.lit(0), F.size(words) - 3)
        return F.transform(places, lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))

    def twins(by_hash):
        def twin(w, k):
            same = lambda j: F.coalesce(F.get(by_hash, j)["h"] == w["h"], F.lit(False))
            return same(k - 1) | same(k + 1)

        return F.sort_array(F.transform(F.filter(by_hash, twin), lambda w: w["i"]))

    def covered(places):
        return F.aggregate(
            places,
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("at")),
            lambda s, i: F.struct(
                (s["n"] + F.least(F.lit(3), i - s["at"])).alias("n"), i.alias("at")
            ),
            lambda s: s["n"],
        )

    def of_hashes(hashes):
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            covered(let(F.sort_array(placed), twins)),
        ).otherwise(0)

    def of_words(words):
        return F.when(F.size(words) > 3, let(window_hashes(words), of_hashes)).otherwise(0)

    return let(words, of_words)


def measure(df: DataFrame, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """The measurements of every whole text, beside the columns ``keep``."""
    text = F.col("text__")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    has_word = lambda line: F.translate(line, _SPACE_CHARS, "") != ""
    staged = df.select(
        *[F.col(f"`{c}`") for c in keep],
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text__"),
    ).select(
        *[F.col(f"`{c}`") for c in keep],
        "text__",
        F.filter(F.split("text__", SPACES), lambda w: w != "").alias("words__"),
        F.filter(F.split("text__", "\n"), has_word).alias("lines__"),
    )
    n_words = F.size("words__")
    long = lambda c, name: c.cast("long").alias(name)
    removed = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    return staged.select(
        *[F.col(f"`{c}`") for c in keep],
        long(n_words, "n_words"),
        long(F.length(F.translate(text, _SPACE_CHARS, "")), "word_chars"),
        long(removed(SYMBOLS), "n_symbols"),
        long(F.size("lines__"), "n_lines"),
        long(F.size("lines__") - F.size(F.array_distinct("lines__")), "n_dup_lines"),
        long(_repeat_words(F.col("words__")), "n_repeat_words"),
        long(removed(upper), "n_upper"),
    )


def ledger(
    df: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    rules: Sequence[Rule] = RULES,
) -> DataFrame:
    """``keep``, the measurements and ``failed_bits``: bit k is set if rule k fails.

    Null text measures like empty text: no words, no lines. A text's rows are judged one
    by one, so repeated rows stay, and columns not named in ``keep`` are not read. Columns in
    ``keep`` must differ from the measurements' names. An empty table gives an empty ledger.
    """
    if len(rules) > 63:
        raise ValueError("a ledger has room for 63 rules")
    if clash := set(keep) & {*MEASURES, "failed_bits"}:
        raise ValueError(f"columns clash with the ledger's: {sorted(clash)}")
    measured = measure(df, text_col, keep)
    named = {m: F.col(m) for m in MEASURES}
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(
            F.when(rule.fails(named), F.lit(1 << k).cast("long")).otherwise(0)
        )
    return measured.withColumn("failed_bits", bits)


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    known = {rule.name: 1 << k for k, rule in enumerate(rules)}
    return sum(known[name] for name in names)


def kept(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """The policy's verdict on a row of a ledger."""
    bits = F.col("failed_bits")
    hard = bits.bitwiseAND(F.lit(mask(policy.rejecting, rules)).cast("long")) == 0
    soft = F.bit_count(bits.bitwiseAND(F.lit(mask(policy.counted, rules)).cast("long")))
    return hard & (soft <= policy.tolerated)


def ablations(
    entries: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """For each rule of the policy: rows that fail it, and rows kept only without it.

    Rows of a ledger first reduce to counts of distinct bit patterns, then every pattern
    meets every rule: at most patterns times rules rows, whatever the ledger's size. A
    rule that nothing fails has zeros; an empty ledger gives no rows.
    """
    hard, soft = mask(policy.rejecting, rules), mask(policy.counted, rules)
    names = [*policy.rejecting, *policy.counted]
    of = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.lit(mask([n], rules)).cast("long").alias("bit")) for n in names]
    )
    bits, bit = F.col("failed_bits"), F.col("r.bit")
    without = bits.bitwiseAND(F.bitwise_not(bit))

    def passes(b):
        return (b.bitwiseAND(F.lit(hard).cast("long")) == 0) & (
            F.bit_count(b.bitwiseAND(F.lit(soft).cast("long"))) <= policy.tolerated
        )

    return (
        entries.groupBy("failed_bits")
        .count()
        .select("failed_bits", "count", F.explode(of).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(bits.bitwiseAND(bit) != 0, F.col("count")).otherwise(0)).alias("failed"),
            F.sum(
                F.when(~passes(bits) & passes(without), F.col("count")).otherwise(0)
            ).alias("kept_without"),
        )
    )
