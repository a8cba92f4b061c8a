"""Language identification by cross-parsing against suffix automata.

A bounded sample of labelled text per language becomes a suffix automaton, which recognises
every substring of the sample. A text is cut from left to right into the longest phrases that
occur in the sample. A phrase could be told by its place there, in log2 of the sample's length
bits; a symbol that the sample lacks is told as it is, in ``LITERAL_BITS``; and one bit says
which. Phrases so weighed, over the text's length, estimate its cross entropy, whatever the
samples' lengths. The language with the fewest bits wins, the first by name of equal ones.

Symbols are bytes: letters in lower case, other ASCII as one space, everything else as
its UTF-8 bytes. Whole texts are parsed, in windows of ``WINDOW`` symbols whose phrases end with
them, so that many windows take each step at once. A task holds the automata and a few
megabytes of text, whatever the corpus; documents do not travel.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.sources import scratch

#: The sample that a language's automaton is made of: so many distinct labelled texts, chosen
#: by hash, of each at most so many characters from a place that the hash gives, and in all so
#: many symbols.
SAMPLE_TEXTS = 128
EXCERPT_CHARS = 1024
SAMPLE_SYMBOLS = 32_768
#: All automata together; with many languages or letters, each gets a smaller sample.
TABLE_BYTES = 256 << 20
WINDOW = 512
LITERAL_BITS = 8
#: Symbols that are parsed together.
CHUNK_SYMBOLS = 2_000_000
UNDETERMINED = "und"

_FOLD = bytes(c if chr(c).isalpha() else 0x20 for c in range(0x80)) + bytes(range(0x80, 0x100))
_ASCII_LETTER = re.compile("[A-Za-z]")
_built: dict[tuple, tuple] = {}


def held_out(id_col: Column) -> Column:
    """A quarter of all rows by id, never learned from; a row without an id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def symbols(text: str) -> bytes:
    """Words in lower case with one space between; symbols are bytes."""
    return b" ".join(text.lower().encode().translate(_FOLD).split())


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the states; state 0 is the start, and every path spells a substring."""
    edges: list[dict[int, int]] = [{}]
    links, lengths, last = [-1], [0], 0
    for symbol in text:
        state = len(edges)
        edges.append({})
        links.append(0)
        lengths.append(lengths[last] + 1)
        at = last
        while at >= 0 and symbol not in edges[at]:
            edges[at][symbol] = state
            at = links[at]
        if at >= 0:
            known = edges[at][symbol]
            if lengths[at] + 1 == lengths[known]:
                links[state] = known
            else:
                copy = len(edges)
                edges.append(dict(edges[known]))
                links.append(links[known])
                lengths.append(lengths[at] + 1)
                while at >= 0 and edges[at].get(symbol) == known:
                    edges[at][symbol] = copy
                    at = links[at]
                links[known] = links[state] = copy
        last = state
    return edges


def parse_table(text: bytes, code: np.ndarray, width: int) -> np.ndarray:
    """Per state and symbol: 4 times the next state, plus 1 if the step ends a phrase, plus 2 if
    the symbol is missing in the sample.

    Where a phrase cannot go on, the next one starts with the symbol. ``code`` numbers the
    symbols, unknown ones 0.
    """
    edges = suffix_automaton(text)
    start = np.zeros(width, np.int32)
    for symbol, state in edges[0].items():
        start[code[symbol]] = state
    table = np.empty((len(edges), width), np.int32)
    restart = 4 * start + 2 * (start == 0)
    table[:] = restart + 1
    for state, out in enumerate(edges):
        places = code[np.fromiter(out.keys(), np.intp, len(out))]
        table[state, places] = 4 * np.fromiter(out.values(), np.int32, len(out))
    # at the start no phrase has to end
    table[0] = restart
    return table


class Parser:
    """The automata of all languages, and the costs of texts in each of them."""

    def __init__(self, samples: list[tuple[str, bytes]]):
        self.languages = [language for language, _ in samples]
        known = sorted(set(b"".join(text for _, text in samples)))
        self.code = np.zeros(256, np.uint8)
        self.code[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        # an automaton has at most two states a symbol
        room = TABLE_BYTES // (8 * self.width * max(1, len(samples)))
        tables = [parse_table(text[:room], self.code, self.width) for _, text in samples]
        self.bits = np.array([1 + math.log2(max(2, len(text[:room]))) for _, text in samples])
        ends = np.cumsum([len(t) for t in tables])
        self.roots = np.r_[0, ends[:-1]].astype(np.int64)[: len(tables)]
        # states of all languages count on, so one gather serves them all
        self.table = (
            np.concatenate([t + 4 * root for t, root in zip(tables, self.roots, strict=True)])
            .astype(np.int32)
            .ravel()
            if tables
            else np.zeros(0, np.int32)
        )

    def phrases(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases and missing symbols of every text (rows) in every language (columns)."""
        sizes = np.array([len(t) for t in texts], np.int64)
        windows = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(texts)), windows)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        begins = np.repeat(np.cumsum(sizes) - sizes, windows) + within * WINDOW
        lengths = np.minimum(sizes[owner] - within * WINDOW, WINDOW)
        order = np.argsort(-lengths, kind="stable")
        owner, begins, lengths = owner[order], begins[order], lengths[order]
        flat = self.code[np.frombuffer(b"".join(texts), np.uint8)]
        roots = self.roots[:, None]
        states = np.repeat(roots, len(owner), axis=1)
        ended, missing = np.zeros((2, *states.shape), np.int64)
        active = np.searchsorted(-lengths, -np.arange(WINDOW), side="left")
        for step, live in enumerate(active):
            if not live:
                break
            taken = flat[begins[:live] + step]
            found = self.table[states[:, :live] * self.width + taken]
            states[:, :live] = found >> 2
            ended[:, :live] += found & 1
            missing[:, :live] += (found >> 1) & 1
        ended += states != roots
        totals = np.zeros((2, len(texts), len(roots)), np.int64)
        np.add.at(totals[0], owner, ended.T)
        np.add.at(totals[1], owner, missing.T)
        return totals[0], totals[1]

    def judge(self, texts: list[bytes]) -> list[tuple[str, float]]:
        """(language, score) of texts that have symbols; the score is the lead over the second."""
        sizes = np.array([len(t) for t in texts], float)
        phrases, missing = self.phrases(texts)
        costs = (phrases * self.bits + missing * (1 + LITERAL_BITS)) / sizes[:, None]
        best = costs.argmin(axis=1)
        ranked = np.sort(costs, axis=1)
        lead = 1 - ranked[:, 0] / ranked[:, 1] if costs.shape[1] > 1 else np.ones(len(texts))
        return [(self.languages[b], float(s)) for b, s in zip(best, lead, strict=True)]


def _parser(samples: list[tuple[str, bytes]]) -> Parser:
    """Built once in each Python process."""
    key = tuple(samples)
    if key not in _built:
        _built.clear()
        _built[key] = Parser(samples)
    return _built[key]


def _predict(shared):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        parser = None
        for batch in batches:
            parser = parser or _parser(shared.value)
            found: list = [(UNDETERMINED, 0.0)] * len(batch)
            rows, texts, waiting = [], [], 0

            def settle():
                for row, result in zip(rows, parser.judge(texts), strict=True):
                    found[row] = result

            for row, text in enumerate(batch.column("text__")):
                text = text.as_py()
                if text is None or not parser.languages or not has_letter(text):
                    continue
                rows.append(row)
                texts.append(symbols(text))
                waiting += len(texts[-1])
                if waiting >= CHUNK_SYMBOLS:
                    settle()
                    rows, texts, waiting = [], [], 0
            if rows:
                settle()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id__"),
                    batch.column("held_out"),
                    pa.array([language for language, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                names=["id__", "held_out", "lang_pred", "score"],
            )

    return run


def sample(
    labelled: DataFrame, sample_texts: int = SAMPLE_TEXTS, excerpt_chars: int = EXCERPT_CHARS
) -> DataFrame:
    """lang__, hash__, excerpt: at most ``sample_texts`` distinct texts of each language.

    Copies of a text count once. Hashes are found first, so that only chosen texts travel.
    """
    hashed = labelled.withColumn("hash__", F.xxhash64("text__"))
    distinct = hashed.select("lang__", "hash__").distinct()
    smallest = Window.partitionBy("lang__").orderBy("hash__")
    chosen = scratch.durable(
        distinct.withColumn("n", F.row_number().over(smallest))
        .where(F.col("n") <= sample_texts)
        .drop("n"),
        "language-chosen",
    )
    room = F.greatest(F.length("text__") - excerpt_chars, F.lit(0)) + 1
    start = F.pmod(F.col("hash__"), room.cast("long")).cast("int") + 1
    return (
        hashed.join(chosen, ["lang__", "hash__"], "left_semi")
        .groupBy("lang__", "hash__")
        .agg(F.min(F.substring("text__", start, F.lit(excerpt_chars))).alias("excerpt"))
    )


def learn(labelled: DataFrame, sample_symbols: int = SAMPLE_SYMBOLS, **bounds) -> list:
    """(language, sample) of each language with a letter among its chosen texts, by name."""
    texts: dict[str, list[bytes]] = {}
    rows = sample(labelled, **bounds).orderBy("lang__", "hash__").toArrow().to_pylist()
    for row in rows:
        if has_letter(row["excerpt"]):
            texts.setdefault(row["lang__"], []).append(symbols(row["excerpt"]))
    # names in code point order, so that ties fall alike everywhere
    return [(name, b" ".join(texts[name])[:sample_symbols]) for name in sorted(texts)]


def predict(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_symbols: int = SAMPLE_SYMBOLS,
) -> DataFrame:
    """``id_col``, held_out, lang_pred, score of every row.

    Learns only from text and non-null language of rows that ``held_out`` leaves. The score is 0
    to 1: how much cheaper the text is in its language than in the next one, 1 if only one was
    learned. Null texts, texts without a letter, and all texts if nothing was learned are
    ``und`` with score 0. Repeated rows are judged each time. Other columns are not read.
    """
    source = df.select(
        F.col(f"`{id_col}`").alias("id__"),
        F.col(f"`{text_col}`").alias("text__"),
        F.col(f"`{lang_col}`").alias("lang__"),
        held_out(F.col(f"`{id_col}`")).alias("held_out"),
    )
    labelled = source.where(
        ~F.col("held_out") & F.col("lang__").isNotNull() & (F.length("text__") > 0)
    ).select("lang__", "text__")
    shared = df.sparkSession.sparkContext.broadcast(learn(labelled, sample_symbols))
    id_type = source.schema["id__"].dataType.simpleString()
    return (
        source.select("id__", "text__", "held_out")
        .mapInArrow(_predict(shared), f"id__ {id_type}, held_out boolean, lang_pred string, score double")
        .withColumnRenamed("id__", id_col)
    )
