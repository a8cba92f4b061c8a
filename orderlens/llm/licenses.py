"""License scans by ordered signature rules.

A text becomes its lower-case words with one space between and around them. Signatures are
regular expressions over that form, each gated by keywords: only where one of them occurs is
the expression run at all, so each of its alternatives must contain one. A detection inside another's interval is suppressed if the
other has at least its priority (and more words, or a higher priority, or an earlier place
in the rule order). Pinned signatures are reported wherever they match and are never
suppressed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.text import let, lower_ascii

#: Characters between words: ASCII other than digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Signature:
    """``pattern`` matches words of the normal form, without the spaces around them.

    ``keyword``: keywords with ``|`` between; any of them opens the gate.
    """

    label: str
    keyword: str
    pattern: str
    priority: int
    pinned: bool = False

    @property
    def keywords(self) -> tuple[str, ...]:
        return tuple(self.keyword.split("|"))


#: Phrases that are always reported, with their labels.
BASE: tuple[tuple[str, str], ...] = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Licence families: label, gating keywords, pattern of the name, pattern of a version.
_V = r"(?: version| v)?"
_FAMILIES: tuple[tuple[str, str, str, str], ...] = (
    ("apache", "apache", r"apache(?: software)? license", rf"{_V} [12](?: [01])?"),
    ("mit", "mit|expat|x11", r"(?:mit|expat|x11) license", ""),
    ("bsd", "bsd", r"(?:[0-9] clause )?bsd(?: [0-9] clause)? license", ""),
    ("isc", "isc", r"isc license", ""),
    ("zlib", "zlib", r"zlib(?: libpng)? license", ""),
    ("boost", "boost", r"boost software license", rf"{_V} 1(?: 0)?"),
    ("artistic", "artistic", r"artistic license", rf"{_V} [12](?: 0)?"),
    ("gpl-family", "gnu", r"gnu (?:general public license|gpl)", rf"{_V} [123](?: [01])?"),
    ("lgpl", "lesser|library", r"(?:gnu )?(?:lesser|library) general public license", rf"{_V} [23](?: [01])?"),
    ("agpl", "affero", r"(?:gnu )?affero general public license", rf"{_V} [13](?: 0)?"),
    ("fdl", "documentation", r"(?:gnu )?free documentation license", rf"{_V} 1(?: [0-3])?"),
    ("mpl", "mozilla", r"mozilla public license", rf"{_V} [12](?: [01])?"),
    ("epl", "eclipse", r"eclipse public license", rf"{_V} [12](?: 0)?"),
    ("cddl", "distribution", r"common development and distribution license", rf"{_V} 1(?: [01])?"),
    ("cpl", "common", r"common public license", rf"{_V} 1(?: 0)?"),
    ("eupl", "european", r"european union public licen[cs]e", rf"{_V} 1(?: [0-2])?"),
    ("osl", "open", r"open software license", rf"{_V} [123](?: [01])?"),
    ("ofl", "font", r"(?:sil )?open font license", rf"{_V} 1(?: [01])?"),
    ("odbl", "database", r"open database license", rf"{_V} 1(?: 0)?"),
    ("python", "python", r"python(?: software foundation)? license", rf"{_V} [23](?: [0-9])?"),
    ("php", "php", r"php license", rf"{_V} [23](?: [0-9]+)?"),
    ("ruby", "ruby", r"ruby license", ""),
    ("perl", "perl", r"same terms as perl(?: itself)?", ""),
    ("unlicense", "unlicense", r"the unlicense", ""),
    ("wtfpl", "want", r"do what the f\w+ you want to public license", rf"{_V} [12]"),
    ("public-domain", "domain", r"public domain(?: dedication)?", ""),
    ("cc0", "cc0", r"cc0", r"(?: 1 0)?(?: universal)?"),
    ("ms-pl", "microsoft", r"microsoft (?:public|reciprocal) license", ""),
    ("afl", "academic", r"academic free license", rf"{_V} [123](?: [01])?"),
    ("ecl", "educational", r"educational community license", rf"{_V} [12](?: 0)?"),
    ("proprietary", "proprietary", r"proprietary (?:and confidential|software|license)", ""),
)
#: Ways a licence is stated: frame around a name, what it adds to the priority.
_FRAMES: tuple[tuple[str, int], ...] = (
    (r"licen[cs]ed under(?: the)?(?: terms of)?(?: the)? {}", 40),
    (r"released under(?: the)?(?: terms of)?(?: the)? {}", 40),
    (r"(?:distributed|available|published) under(?: the)?(?: terms of)?(?: the)? {}", 40),
    (r"under the (?:terms|conditions) of(?: the)? {}", 30),
    (r"subject to(?: the)?(?: terms of)?(?: the)? {}", 25),
    (r"(?:governed|covered) by(?: the)? {}", 25),
    (r"see(?: the)? {} for (?:more )?details", 20),
    (r"{}", 10),
)
#: Parts of Creative Commons licences besides attribution.
_CC_PARTS: tuple[str, ...] = ("", " sa", " nd", " nc", " nc sa", " nc nd")
_CC_LONG = {
    "sa": "share ?alike",
    "nd": "no ?deriv(?:atives|s)?(?: works)?",
    "nc": "non ?commercial",
}
#: Statements without a licence name: label, keyword, pattern, priority.
_NOTICES: tuple[tuple[str, str, str, int], ...] = (
    ("copyright", "copyright", r"copyright(?: c)?(?: (?:19|20)[0-9]{2})+(?: by)?", 5),
    ("copyright", "copyright", r"copyright c", 4),
    ("no-warranty", "warranty", r"without warranty of any kind(?: express or implied)?", 15),
    ("no-warranty", "warranties", r"without (?:any )?warranties or conditions of any kind", 15),
    ("as-is", "provided", r"(?:software|work|material) is provided as is", 15),
    ("permission", "permission", r"permission is hereby granted free of charge", 35),
    ("permission", "permission", r"permission to use copy modify and or distribute", 35),
    ("redistribution", "redistribution", r"redistribution and use in source and binary forms", 35),
    ("no-reuse", "reproduction", r"(?:unauthori[sz]ed )?reproduction (?:is )?(?:strictly )?prohibited", 15),
    ("no-reuse", "permission", r"(?:used|reproduced) (?:only )?with(?:out)?(?: the)?(?: prior)? (?:written )?permission", 12),
)


def build_signatures() -> tuple[Signature, ...]:
    """All signatures in rule order: pinned ones, frames by family, then notices."""
    rules = [Signature(label, phrase, phrase, 0, pinned=True) for phrase, label in BASE]
    names = [(f[0], f[1], f[2], f[3]) for f in _FAMILIES]
    for parts in _CC_PARTS:
        long = "".join(f"(?: and)? {_CC_LONG[p]}" for p in parts.split())
        label = "cc-by" + parts.replace(" ", "-")
        version = r"(?: [1-4] [05])?(?: (?:international|unported|generic))?"
        names.append((label, "cc by", rf"cc by{parts}(?: license)?", version))
        names.append(
            (label, "creative", rf"creative commons attribution{long}(?: license)?", version)
        )
    for label, keyword, name, version in names:
        for frame, weight in _FRAMES:
            full = f"{name}(?:{version})?" if version else name
            rules.append(Signature(label, keyword, frame.format(f"(?:{full})"), weight))
        spdx = label.replace("-", " ")
        rules.append(
            Signature(label, "spdx", rf"spdx license identifier {spdx}(?: [0-9]+)*", 50)
        )
    rules += [Signature(*notice) for notice in _NOTICES]
    return tuple(rules)


SIGNATURES = build_signatures()


def normal_form(text: Column) -> Column:
    """Words in lower case, one space before, between and after them."""
    return F.regexp_replace(
        F.concat(F.lit(" "), lower_ascii(text), F.lit(" ")), SEPARATORS, " "
    )


def _detections(normal: Column, rules: Sequence[Signature]) -> Column:
    """array<struct<start, end, order, label, priority, pinned>> in words, before suppression.

    The rules stand in the plan once, as an array; those with a keyword that occurs are kept and
    each is run over the text. A match is wrapped by its spaces, which neighbours share, so
    the closing one is only looked at.
    """
    table = F.array(
        *[
            F.struct(
                F.array(*[F.lit(f" {k} ") for k in r.keywords]).alias("keywords"),
                F.lit(f" {r.pattern}(?= )").alias("pattern"),
                F.lit(n).alias("order"),
                F.lit(r.label).alias("label"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.pinned).alias("pinned"),
            )
            for n, r in enumerate(rules)
        ]
    )
    spaces = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))

    def of(rule):
        gaps = F.split(normal, rule["pattern"])
        hits = F.regexp_extract_all(normal, rule["pattern"], F.lit(0))
        pairs = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(hits)),
            hits,
            lambda gap, hit: F.struct(spaces(gap).alias("gap"), spaces(hit).alias("hit")),
        )
        start = F.struct(
            F.lit(0).alias("at"),
            F.array()
            .cast(
                "array<struct<start:int,end:int,order:int,label:string,priority:int,pinned:boolean>>"
            )
            .alias("found"),
        )
        return F.aggregate(
            pairs,
            start,
            lambda s, p: F.struct(
                (s["at"] + p["gap"] + p["hit"]).alias("at"),
                F.concat(
                    s["found"],
                    F.array(
                        F.struct(
                            (s["at"] + p["gap"]).alias("start"),
                            (s["at"] + p["gap"] + p["hit"]).alias("end"),
                            rule["order"].alias("order"),
                            rule["label"].alias("label"),
                            rule["priority"].alias("priority"),
                            rule["pinned"].alias("pinned"),
                        )
                    ),
                ).alias("found"),
            ),
            lambda s: s["found"],
        )

    gated = F.filter(
        table, lambda r: F.exists(r["keywords"], lambda keyword: F.contains(normal, keyword))
    )
    return F.flatten(F.transform(gated, of))


def _gate(normal: Column, rules: Sequence[Signature]) -> Column:
    """Whether any signature's keyword occurs."""
    any_keyword = F.lit(False)
    for keyword in dict.fromkeys(k for r in rules for k in r.keywords):
        any_keyword = any_keyword | F.contains(normal, F.lit(f" {keyword} "))
    return any_keyword


def scan(
    df: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    rules: Sequence[Signature] = SIGNATURES,
) -> DataFrame:
    """``keep``, ``n_words`` and ``detections`` of every whole text.

    ``detections``: array<struct<start, end, order, label, priority, pinned, suppressed>>,
    places in words from 0, end exclusive, by start. Of detections with equal interval and
    priority the earlier rule stays. Null text is empty text: no words, no detections.
    Rows are scanned one by one, so repeated rows stay; other columns are not read, and
    ``keep`` must not name the result's columns. An empty table gives an empty result.
    """
    if clash := set(keep) & {"n_words", "detections"}:
        raise ValueError(f"columns clash with the result's: {sorted(clash)}")
    kept = [F.col(f"`{c}`") for c in keep]
    normal = F.col("normal__")
    none = F.array().cast(
        "array<struct<start:int,end:int,order:int,label:string,priority:int,pinned:boolean>>"
    )

    def stronger(other, d):
        inside = (other["start"] <= d["start"]) & (other["end"] >= d["end"])
        longer = (other["end"] - other["start"]) > (d["end"] - d["start"])
        beats = (other["priority"] > d["priority"]) | (
            (other["priority"] == d["priority"])
            & (longer | (other["order"] < d["order"]))
        )
        return inside & beats & ~other["pinned"]

    def judged(found):
        def one(d):
            lost = ~d["pinned"] & F.exists(found, lambda other: stronger(other, d))
            names = ("start", "end", "order", "label", "priority", "pinned")
            return F.struct(*[d[c].alias(c) for c in names], lost.alias("suppressed"))

        return F.transform(found, one)

    n_spaces = F.length(normal) - F.length(F.replace(normal, F.lit(" "), F.lit("")))
    return (
        df.select(*kept, normal_form(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("normal__"))
        .select(
            *kept,
            (n_spaces - 1).cast("long").alias("n_words"),
            let(
                F.when(
                    _gate(normal, rules),
                    let(normal, lambda n: F.sort_array(_detections(n, rules))),
                ).otherwise(none),
                judged,
            ).alias("detections"),
        )
    )


def standing(detections: Column) -> Column:
    return F.filter(detections, lambda d: ~d["suppressed"])


def labels(detections: Column) -> Column:
    """Distinct labels, sorted, comma-joined."""
    return F.array_join(
        F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ","
    )


def confidence(detections: Column) -> Column:
    """0 without a detection, else up to 1 by the strongest standing statement."""
    strongest = F.array_max(F.transform(standing(detections), lambda d: d["priority"]))
    return F.coalesce((F.lit(0.5) + strongest / 100).cast("double"), F.lit(0.0))
