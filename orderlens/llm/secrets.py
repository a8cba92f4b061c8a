"""Secret scans: fixed formats, and strings too random to be words.

Fixed formats are assignments to secret-like names, access-key ids and long hex strings.
Beyond them, candidate strings that mix letters and digits are scanned by Shannon
entropy: a window slides over the candidate, the counts of its characters change by one
character leaving and one entering, and the largest entropy of a window, against the
threshold of the candidate's character class, decides. Strings on the allow-list (UUIDs,
dates, paths of words) are not reported, and windows with a placeholder do not count, while
the rest of such a candidate does. Fixed findings always stay; of a candidate that they
touch, what they leave is judged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import let, spans

ASSIGN = (
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Shortest value of an assignment.
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Characters of a sliding window; as long as the shortest candidate.
WINDOW = 20


@dataclass(frozen=True)
class CharacterClass:
    """Candidates made only of ``alphabet`` need ``bits`` of entropy in some window."""

    name: str
    pattern: str
    alphabet: str
    bits: float


_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: From the narrowest alphabet to the widest; a candidate belongs to the first that holds it.
CLASSES: tuple[CharacterClass, ...] = (
    CharacterClass("hex", "[0-9a-fA-F]+", _DIGITS + "abcdefABCDEF", 3.0),
    CharacterClass("base32", "[A-Z0-9]+", _DIGITS + _LOWER.upper(), 3.4),
    CharacterClass("base36", "[a-z0-9]+", _DIGITS + _LOWER, 3.5),
    CharacterClass(
        "base64", "[A-Za-z0-9+/_-]+", _DIGITS + _LOWER + _LOWER.upper() + "+/_-", 3.8
    ),
)

#: Whole strings that look random but are no secrets.
ALLOWED: tuple[str, ...] = (
    r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",  # UUID
    r"(?:[0-9]+[-_/])+[0-9]+",  # dates, numbers with separators
    r"(?:[A-Za-z]*[-_/])+[A-Za-z]+[0-9]{0,4}",  # paths and names of words
)

#: Placeholders within a candidate, and what stays of them: pieces that a line break parts, of
#: which none holds the placeholder whole.
PLACEHOLDERS: tuple[tuple[str, str], ...] = (
    (  # words between separators
        r"(?i)(?<![A-Za-z0-9])(?:example|sample|dummy|placeholder|changeme|redacted|test)[A-Za-z0-9]*",
        "\n",
    ),
    (r"(?i)(.)(\1{6})\1*(\1)", "$1$2\n$2$3"),  # one character eight times
    (r"(?i)0123456789|1234567890|abcdefghij|qwertyuiop", "\n"),
)


def _term(count: Column) -> Column:
    """c * log2(c), 0 for 0."""
    return F.when(count > 1, count * F.log2(count)).otherwise(0.0)


def _least_sum(places: Column, size: int, window: int) -> Column:
    """``places``: 1-based alphabet places of a candidate's characters."""
    zero = F.array_repeat(F.lit(0), size)
    steps = F.sequence(F.lit(1), F.size(places))
    start = F.struct(
        zero.alias("counts"), F.lit(0.0).alias("sum"), F.lit(float("inf")).alias("least")
    )

    def step(state, i):
        entering = F.element_at(places, i)
        leaving = F.when(i > window, F.element_at(places, F.greatest(i - window, F.lit(1))))
        same = F.coalesce(entering == leaving, F.lit(False))
        counts = state["counts"]
        c_in = F.element_at(counts, entering)
        c_out = F.element_at(counts, F.coalesce(leaving, F.lit(1)))
        moved = state["sum"] + F.when(
            same, 0.0
        ).otherwise(
            _term(c_in + 1)
            - _term(c_in)
            + F.when(leaving.isNull(), 0.0).otherwise(_term(c_out - 1) - _term(c_out))
        )
        changed = F.transform(
            counts,
            lambda c, k: c
            + F.when(k + 1 == entering, 1).otherwise(0)
            - F.when(F.coalesce(k + 1 == leaving, F.lit(False)), 1).otherwise(0),
        )
        return F.struct(
            changed.alias("counts"),
            moved.alias("sum"),
            F.when(i >= window, F.least(state["least"], moved))
            .otherwise(state["least"])
            .alias("least"),
        )

    return F.aggregate(steps, start, step, lambda s: s["least"])


def max_entropy(candidate: Column, alphabet: str, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of ``window`` neighbouring characters.

    Null if the candidate is shorter than a window. The counts, and the sum of c*log2(c)
    over them, follow the window one character at a time; the entropy is
    log2(window) - sum / window.
    """

    def over(text):
        places = F.transform(
            F.filter(F.split(text, ""), lambda ch: ch != ""),
            lambda ch: F.instr(F.lit(alphabet), ch),
        )
        return let(places, lambda p: _least_sum(p, len(alphabet), window))

    least = over(candidate)
    return F.when(
        F.length(candidate) >= window, F.lit(math.log2(window)) - least / window
    )


def _mixes(found: Column) -> Column:
    return found.rlike("[0-9]") & found.rlike("[A-Za-z]")


def find_secrets(
    df: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    classes: Sequence[CharacterClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """``keep`` and ``fixed``, ``random``: array<struct<start, order, kind, end, found>>.

    ``fixed`` has the fixed formats by start, then kind as listed; ``random`` the strings
    found by entropy, by start. ``found`` of an assignment is the whole assignment. Null
    text is empty text and has none. What fixed findings leave of a candidate is a finding of
    its own; if it is shorter than a window, it is one where it mixes letters and digits and
    joins an access key or hex string without a separator. Each row is scanned by itself, so repeated rows stay.
    Columns not named in ``keep`` are not read; ``keep`` must not name ``fixed`` or ``random``.
    An empty table gives an empty result. No text is too long: the work follows its length.
    """
    if clash := set(keep) & {"fixed", "random"}:
        raise ValueError(f"columns clash with the result's: {sorted(clash)}")
    kept = [F.col(f"`{c}`") for c in keep]
    text = F.col("text__")
    none = F.array().cast(
        "array<struct<start:int,order:int,kind:string,end:int,found:string>>"
    )

    def of_kind(found: Column, kind: str) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit((*KINDS, "random").index(kind)).alias("order"),
                F.lit(kind).alias("kind"),
                s["end"].alias("end"),
                s["found"].alias("found"),
            ),
        )

    long_value = lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 1)) >= ASSIGN_VALUE
    lower = F.lower(text)
    names = ("passw", "secret", "token", "api")
    may_assign = F.lit(False)
    for name in names:
        may_assign = may_assign | F.contains(lower, F.lit(name))
    assigned = F.when(
        may_assign & text.rlike(ASSIGN),
        of_kind(F.filter(spans(text, F.lit(ASSIGN)), long_value), "assign"),
    ).otherwise(none)
    access = F.when(
        F.contains(text, F.lit("AKIA")), of_kind(spans(text, F.lit(ACCESS)), "access")
    ).otherwise(none)
    hexes = F.when(text.rlike(HEX), of_kind(spans(text, F.lit(HEX)), "hex")).otherwise(none)
    candidates = F.when(
        text.rlike("[0-9]") & text.rlike(CANDIDATE),
        F.filter(of_kind(spans(text, F.lit(CANDIDATE)), "random"), lambda s: _mixes(s["found"])),
    ).otherwise(none)

    def uncovered(s, fixed):
        """What ``fixed``, by start, leaves of a candidate."""
        touching = F.filter(fixed, lambda f: (f["start"] < s["end"]) & (f["end"] > s["start"]))
        assigns = F.exists(touching, lambda f: f["kind"] == "assign")
        place = "struct<start:int,end:int>"
        state = F.struct(s["start"].alias("at"), F.array().cast(f"array<{place}>").alias("out"))

        def gap(at, start):
            one = F.struct(at.cast("int").alias("start"), start.cast("int").alias("end"))
            return F.when(start > at, F.array(one)).otherwise(F.array().cast(f"array<{place}>"))

        gaps = F.aggregate(
            touching,
            state,
            lambda t, f: F.struct(
                F.greatest(t["at"], f["end"]).alias("at"),
                F.concat(t["out"], gap(t["at"], f["start"])).alias("out"),
            ),
            lambda t: F.concat(t["out"], gap(t["at"], s["end"])),
        )

        def piece(g):
            size = g["end"] - g["start"]
            found = F.substring(s["found"], g["start"] - s["start"] + 1, size)
            return F.struct(
                g["start"].alias("start"),
                s["order"].alias("order"),
                s["kind"].alias("kind"),
                g["end"].alias("end"),
                found.alias("found"),
            )

        def may_be(r):
            joins = ~assigns & r["found"].rlike("^[A-Za-z0-9]+$")
            return _mixes(r["found"]) & ((F.length(r["found"]) >= WINDOW) | joins)

        return F.filter(F.transform(gaps, piece), may_be)

    def loose(fixed):
        return F.flatten(F.transform("candidates__", lambda s: uncovered(s, fixed)))

    def random(s):
        pieces = s["found"]
        for pattern, stays in PLACEHOLDERS:
            pieces = F.regexp_replace(pieces, pattern, stays)
        pieces = F.filter(F.split(pieces, "\n"), lambda p: F.length(p) >= WINDOW)
        verdict = F.lit(False)
        for c in reversed(classes):
            verdict = F.when(
                s["found"].rlike(f"^{c.pattern}$"),
                F.exists(pieces, lambda p: max_entropy(p, c.alphabet) >= c.bits),  # noqa: B023
            ).otherwise(verdict)
        suppressed = F.lit(False)
        for pattern in allowed:
            suppressed = suppressed | s["found"].rlike(f"^(?:{pattern})$")
        return (F.length(s["found"]) < WINDOW) | (~suppressed & verdict)

    return (
        df.select(*kept, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text__"))
        .select(
            *kept,
            F.concat(assigned, access, hexes).alias("fixed__"),
            candidates.alias("candidates__"),
        )
        .select(*kept, F.sort_array("fixed__").alias("fixed__"), "candidates__")
        .select(*kept, "fixed__", let(F.col("fixed__"), loose).alias("candidates__"))
        .select(
            *kept,
            F.col("fixed__").alias("fixed"),
            F.filter("candidates__", random).alias("random"),
        )
    )


def all_spans(fixed: Column, random: Column) -> Column:
    """Both kinds of findings by start, then kind as listed."""
    return F.sort_array(F.concat(fixed, random))


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def redact(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch covered by findings replaced by one mark.

    ``found`` must be sorted by start; overlapping findings are one stretch. Null text
    stays null.
    """
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(s, f):
        gap = F.when(
            f["start"] >= s["at"],
            F.concat(F.substring(text, s["at"] + 1, f["start"] - s["at"]), F.lit(mark)),
        ).otherwise(F.lit(""))
        return F.struct(
            F.concat(s["out"], gap).alias("out"), F.greatest(s["at"], f["end"]).alias("at")
        )

    rebuilt = F.aggregate(
        found,
        state,
        step,
        lambda s: F.concat(
            s["out"], F.substring(text, s["at"] + 1, F.length(text) - s["at"])
        ),
    )
    return F.when(F.size(found) > 0, rebuilt).otherwise(text)
