"""Personal data: fixed formats, and identifiers found by contexts learned from them.

Fixed formats (e-mail addresses, IPv4 addresses, card numbers, phone numbers) are the
seeds. Where a seed stands, its neighbouring words form lexical patterns. Patterns and the
strings they surround make a bipartite graph, which Spark scores in rounds: a pattern is as
reliable as the strings it surrounds, a string as the best of its patterns together. Strings
with a digit or an @ that are no seed, but stand in patterns of high confidence, are reported
as learned. Fixed findings always stay.

Each text is read once; the graph has only mentions, a few words each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import let, spans
from orderlens.sources import scratch

KINDS = ("email", "ip", "card", "phone")
LEARNED = "learned"

# Formats, written so that no search begins inside a run of characters that it has just
# given up, which keeps the work in proportion to the text.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: A longest run of digits with single spaces or hyphens between has 13 to 19 digits.
CARD = (
    r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])"
)
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: A word with a digit or an @.
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

#: Characters around a mention in which its neighbouring words are looked for.
CONTEXT_CHARS = 80
#: Distinct seeds of one kind that make a context a pattern.
MIN_SEEDS = 3
ROUNDS = 3
#: Confidence of a pattern that may discover, and of a string that is reported.
PATTERN_CONFIDENCE = 0.6
REPORT_CONFIDENCE = 0.8


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    places = F.transform(
        F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), lambda c: c.cast("int")
    )

    def weigh(d, k):
        twice = 2 * d
        return F.when(k % 2 == 0, d).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    total = F.aggregate(F.transform(places, weigh), F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def fixed_formats(text: Column) -> Column:
    """array<struct<order, start, end, kind, found>> by kind as listed, then start."""
    none = F.array().cast(
        "array<struct<order:int,start:int,end:int,kind:string,found:string>>"
    )

    def of_kind(gate: Column, kind: str, pattern: str, holds=None) -> Column:
        found = spans(text, F.lit(pattern))
        if holds:
            found = F.filter(found, lambda s: holds(s["found"]))
        named = F.transform(
            found,
            lambda s: F.struct(
                F.lit(KINDS.index(kind)).alias("order"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.lit(kind).alias("kind"),
                s["found"].alias("found"),
            ),
        )
        return F.when(gate, named).otherwise(none)

    n_digits = lambda found: F.length(digits(found))
    digit = text.rlike("[0-9]")
    ip = rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$"
    return F.concat(
        of_kind(F.contains(text, F.lit("@")), "email", EMAIL),
        of_kind(digit & text.rlike(IP), "ip", IP, lambda s: s.rlike(ip)),
        of_kind(digit & text.rlike(CARD), "card", CARD, lambda s: luhn(digits(s))),
        of_kind(
            F.contains(text, F.lit("+")),
            "phone",
            PHONE,
            lambda s: (n_digits(s) >= 9) & (n_digits(s) <= 15),
        ),
    )


def _contexts(text: Column, start: Column, end: Column) -> Column:
    """Lexical patterns of a mention: two words before it; a word before and one after."""
    left = F.substring(
        text,
        F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1,
        F.least(start, F.lit(CONTEXT_CHARS)),
    )
    right = F.substring(text, end + 1, F.lit(CONTEXT_CHARS))
    two = F.lower(F.regexp_extract(left, r"(\S+\s+\S+)\s*$", 1))
    one = F.lower(F.regexp_extract(left, r"(\S+)\s*$", 1))
    after = F.lower(F.regexp_extract(right, r"^[^\s\w]*\s*(\S+)", 1))
    return F.array(
        F.when(two != "", F.concat(F.lit("2 "), F.regexp_replace(two, r"\s+", " "))),
        F.when((one != "") & (after != ""), F.concat_ws(" ", F.lit("1"), one, after)),
    )


def mentions(df: DataFrame, text_col: str, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``fixed`` and ``loose``: words that may be identifiers, with contexts."""
    kept = [F.col(f"`{c}`") for c in keep]
    text = F.col("text__")
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    def mention(text, s, kind):
        contexts = _contexts(text, s["start"], s["end"]).alias("contexts")
        return F.struct(s["start"], s["end"], kind.alias("kind"), s["found"], contexts)

    def all_mentions(fixed):
        touched = lambda w: F.exists(
            fixed, lambda f: (f["start"] < w["end"]) & (f["end"] > w["start"])
        )
        loose = F.filter("words__", lambda w: ~touched(w))
        unknown = F.lit(None).cast("string")
        return F.concat(
            F.transform(fixed, lambda s: mention(text, s, s["kind"])),
            F.transform(loose, lambda w: mention(text, w, unknown)),
        )

    return (
        df.select(*kept, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text__"))
        .select(
            *kept,
            "text__",
            fixed_formats(text).alias("fixed"),
            F.when(text.rlike("[0-9@]"), spans(text, F.lit(CANDIDATE)))
            .otherwise(none)
            .alias("words__"),
        )
        .select(*kept, "fixed", let(F.col("fixed"), all_mentions).alias("mentions"))
    )


def learn(
    edges: DataFrame,
    rounds: int = ROUNDS,
    min_seeds: int = MIN_SEEDS,
    pattern_confidence: float = PATTERN_CONFIDENCE,
) -> DataFrame:
    """Confidence of the strings that patterns discover: ``found``, ``confidence``.

    ``edges``: pattern, found, kind (null for a string that is no seed), not repeated.
    Only patterns with ``min_seeds`` distinct seeds of one kind take part. A pattern's
    confidence is the mean of its strings', with one doubtful string added; a string's is
    1 - the product of its patterns' (1 - confidence); a seed's stays 1. Patterns that fall
    below ``pattern_confidence`` do not count for strings.
    """
    strong = (
        edges.where(F.col("kind").isNotNull())
        .groupBy("pattern", "kind")
        .count()
        .where(F.col("count") >= min_seeds)
        .select("pattern")
        .distinct()
    )
    graph = scratch.durable(edges.join(strong, "pattern", "left_semi"), "pii-graph")
    strings = graph.groupBy("found").agg(
        F.when(F.count("kind") > 0, 1.0).otherwise(0.0).alias("confidence")
    )
    for _ in range(rounds):
        patterns = (
            graph.select("pattern", "found").distinct()
            .join(strings, "found")
            .groupBy("pattern")
            .agg((F.sum("confidence") / (F.count("*") + 1)).alias("reliable"))
        )
        counted = F.when(F.col("reliable") >= pattern_confidence, F.col("reliable")).otherwise(0.0)
        doubt = F.sum(F.log(1 - F.least(counted, F.lit(0.999999))))
        strings = scratch.durable(
            graph.join(patterns, "pattern")
            .groupBy("found")
            .agg(
                F.when(F.count("kind") > 0, 1.0)
                .otherwise(1 - F.exp(doubt))
                .alias("confidence")
            ),
            "pii-strings",
        )
    seeds = graph.where(F.col("kind").isNotNull()).select("found")
    return strings.join(seeds, "found", "left_anti")


def find_personal_data(
    df: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    report_confidence: float = REPORT_CONFIDENCE,
) -> DataFrame:
    """``keep``, ``fixed`` and ``learned``: arrays of struct<order, start, end, kind, found>.

    Offsets are code points, the end exclusive. Null text is empty text and has none. Repeated
    rows stay, each with its own findings; a string counts once for a pattern, however
    often both occur together, so copies of a text teach nothing new. Other columns are not
    read; ``keep`` must not name the result's columns. An empty table gives an empty result.
    """
    used = {"fixed", "learned", "mentions", "row__"}
    if clash := set(keep) & used:
        raise ValueError(f"columns clash with the result's: {sorted(clash)}")
    kept = [F.col(f"`{c}`") for c in keep]
    rows = scratch.durable(
        mentions(df, text_col, keep).withColumn("row__", F.monotonically_increasing_id()),
        "pii-mentions",
    )
    each = rows.select("row__", F.explode("mentions").alias("m")).select(
        "row__", "m.start", "m.end", "m.kind", "m.found", F.explode("m.contexts").alias("pattern")
    ).where(F.col("pattern").isNotNull())
    edges = each.select("pattern", "found", "kind").distinct()
    trusted = learn(edges).where(F.col("confidence") >= report_confidence).select("found")
    learned = (
        each.where(F.col("kind").isNull())
        .join(trusted, "found", "left_semi")
        .select(
            "row__",
            F.struct(
                F.lit(len(KINDS)).alias("order"),
                "start",
                "end",
                F.lit(LEARNED).alias("kind"),
                "found",
            ).alias("s"),
        )
        .distinct()
        .groupBy("row__")
        .agg(F.sort_array(F.collect_list("s")).alias("learned"))
    )
    none = F.array().cast(
        "array<struct<order:int,start:int,end:int,kind:string,found:string>>"
    )
    return rows.join(learned, "row__", "left").select(
        *kept, "fixed", F.coalesce("learned", none).alias("learned")
    )
