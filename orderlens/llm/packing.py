"""Packing examples into fixed-length training sequences.

Vector bin packing: an example demands tokens, one segment and loss-bearing tokens at
once, and a sequence has a limit on each. Sequences are filled one by one. Of the
waiting examples that fit, the one whose demand has the largest dot product with the
room left goes next, both as shares of the limits. When none fits, one is cut so that
its first part fills the rest. What does not fill a sequence at the end of a partition
is cut into sequences whose lengths are powers of two, which need no padding.

Every partition packs its own rows, so no row moves and a lost executor repeats only its
own partitions. Waiting are ``window`` examples of less than one sequence each.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sequence ids of a partition start at its number times this.
SEQUENCES_PER_PARTITION = 1 << 33
#: Tokenized at a time, in characters.
CHUNK_CHARS = 2_000_000
#: Words and word parts whose ids a worker keeps.
CACHE_WORDS = 400_000


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 128
    loss_tokens: int = 4096


class _Cache(dict):
    """Ids by key, computed once. Keys unused for ``size`` others leave, so memory is bounded."""

    def __init__(self, compute, size: int):
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = ids
        return ids


class WordEncoder:
    """Token ids of texts, word by word, for tokenizers that drop white space.

    Such a tokenizer gives a text the ids of its words one after another, so the ids of
    a word are looked up once and kept. ``encode`` returns unsigned 32-bit
    little-endian ids.
    """

    # the tokenizer's own split, for printable ASCII and the letters of Latin-1, which are
    # their own composed form and have one lower-case letter each
    _PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    _PARTS = re.compile(
        r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+"
    )

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words = _Cache(self._word, CACHE_WORDS)
        self.parts = _Cache(self._part, CACHE_WORDS)
        # the characters that stand for the bytes of those letters
        bytewise = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100)]
        self.stand_in = {ord(c): bytewise.pre_tokenize_str(c)[0][0] for c in letters}

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        return _packed([t.id for t in self.model.tokenize(part)])

    def _word(self, word: str) -> bytes:
        if "<|" in word:  # may hold a special token
            return self.whole(word)
        if self._PLAIN.fullmatch(word):
            parts = self._PARTS.findall(word.lower())
            if not word.isascii():
                parts = [p if p.isascii() else p.translate(self.stand_in) for p in parts]
        else:
            normal = self.tokenizer.normalizer.normalize_str(word)
            parts = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        if len(parts) == 1:
            return self.parts[parts[0]]
        return b"".join([self.parts[p] for p in parts])

    def encode(self, texts: list[str]) -> list[bytes]:
        ids = self.words.__getitem__
        return [
            self.whole(text) if _SEPARATORS.search(text) else b"".join(map(ids, text.split()))
            for text in texts
        ]


_encoders: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """This process's encoder, with what it knows from earlier tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


#: White space to Python, but not to the tokenizer.
_SEPARATORS = re.compile("[\x1c-\x1f]")


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class _Packer:
    """Packs one partition; finished pieces gather in ``out``."""

    def __init__(self, limits: Limits, first_sequence: int, window: int):
        self.limits, self.sequence, self.window = limits, first_sequence, window
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.items: list[tuple] = []  # key, ids, prompt tokens, start
        self.tokens = np.zeros(0)
        self.loss = np.zeros(0)
        self.out: list[tuple] = []

    def _loss(self, item: tuple) -> int:
        _, ids, prompt, start = item
        return max(0, len(ids) // 4 - max(start, prompt))

    def _fitting(self, item: tuple, tokens: int, loss: int) -> int:
        """Tokens of the item's longest prefix within both limits."""
        _, ids, prompt, start = item
        return min(len(ids) // 4 - start, tokens, max(0, prompt - start) + loss)

    def add(self, items: list[tuple]) -> None:
        """Whole sequences of long examples leave at once; the rest waits."""
        limits, waiting = self.limits, []
        for key, ids, prompt in items:
            start = 0
            while len(ids) // 4 - start >= limits.tokens:
                item = (key, ids, prompt, start)
                n = self._fitting(item, limits.tokens, limits.loss_tokens)
                self._close([(item, n)])
                start += n
            if len(ids) // 4 > start:
                waiting.append((key, ids, prompt, start))
        self.items += waiting
        self.tokens = np.append(self.tokens, [len(i[1]) // 4 - i[3] for i in waiting])
        self.loss = np.append(self.loss, [self._loss(i) for i in waiting])
        while len(self.items) > self.window:
            self._fill()

    def finish(self) -> None:
        while self.items:
            self._fill()

    def _take(self, k: int) -> tuple:
        """Remove the k-th waiting item; the last one moves to its place."""
        item, last = self.items[k], self.items.pop()
        if k < len(self.items):
            self.items[k] = last
            self.tokens[k], self.loss[k] = self.tokens[-1], self.loss[-1]
        self.tokens, self.loss = self.tokens[:-1], self.loss[:-1]
        return item

    def _fill(self) -> None:
        limits, placed = self.limits, []
        tokens, segments, loss = limits.tokens, limits.segments, limits.loss_tokens
        while tokens and segments and self.items:
            fits = (self.tokens <= tokens) & (self.loss <= loss)
            if segments == 1 and tokens:  # only a cut can still fill the sequence
                fits &= self.tokens == tokens
            if fits.any():
                weight = np.array([tokens, segments, loss]) / self.capacity**2
                score = self.tokens * weight[0] + weight[1] + self.loss * weight[2]
                item = self._take(int(np.argmax(np.where(fits, score, -1.0))))
                n = len(item[1]) // 4 - item[3]
            else:
                item = self._take(int(np.argmax(self.tokens)))
                n = self._fitting(item, tokens, loss)
                key, ids, prompt, start = item
                if start + n < len(ids) // 4:
                    rest = (key, ids, prompt, start + n)
                    self.items.append(rest)
                    self.tokens = np.append(self.tokens, len(ids) // 4 - start - n)
                    self.loss = np.append(self.loss, self._loss(rest))
                if not n:  # no room for loss-bearing tokens
                    break
            placed.append((item, n))
            tokens, segments = tokens - n, segments - 1
            loss -= max(0, item[3] + n - max(item[3], item[2]))
        self._close(placed)

    def _close(self, placed: list[tuple]) -> None:
        """Emit one full sequence, or several whose lengths are powers of two."""
        total = sum(n for _, n in placed)
        room = total if total == self.limits.tokens else 0
        offset = 0
        for (key, ids, prompt, start), n in placed:
            end = start + n
            while start < end:
                if not room:
                    room = 1 << (total.bit_length() - 1)
                take = min(room, end - start)
                bearing = max(0, start + take - max(start, prompt))
                blob = ids[4 * start : 4 * (start + take)]
                self.out.append(
                    (*key, start, take, bearing, blob, len(ids) // 4, self.sequence, offset)
                )
                start, offset = start + take, offset + take
                room, total = room - take, total - take
                if not room:
                    self.sequence, offset = self.sequence + 1, 0


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_cols: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    prompt_col: str | None = None,
    end_id: int = 2,
    limits: Limits = Limits(),
    window: int = 512,
) -> DataFrame:
    """One row per piece: ``id_cols``, start, length, loss_tokens, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset.

    An example is the ids of its prompt, which bear no loss, those of its text, then
    ``end_id``. Null text or prompt: empty, so such an example is ``end_id`` alone.
    Rows with equal or null ids are examples of their own. Other columns are not read, so
    their names cannot clash; ``id_cols`` must differ from the output's names. An empty
    table gives an empty result. Rows are taken in the order of their partition.
    """
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
        raise ValueError("every limit must be at least 1")
    made = T.StructType.fromDDL(
        "start long, length long, loss_tokens long, ids binary, doc_tokens long, "
        "sequence_id long, offset long"
    )
    if clash := set(id_cols) & set(made.names):
        raise ValueError(f"id columns clash with the result's: {sorted(clash)}")
    keys = [F.col(f"`{c}`") for c in id_cols]
    prompt = F.col(f"`{prompt_col}`") if prompt_col else F.lit("")
    source = df.select(
        *keys,
        F.coalesce(prompt, F.lit("")).alias("prompt__"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text__"),
    )
    schema = T.StructType([source.schema[c] for c in id_cols] + made.fields)
    end = _packed([end_id])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        arrow_schema = None
        encoder = encoder_of(tokenizer_path)
        first = TaskContext.get().partitionId() * SEQUENCES_PER_PARTITION
        packer = _Packer(limits, first, window)

        def flush():
            columns = list(zip(*packer.out, strict=True))
            packer.out = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow_schema, strict=True)],
                schema=arrow_schema,
            )

        for batch in batches:
            if arrow_schema is None:
                arrow_schema = _arrow_schema(batch.schema, id_cols, made)
            for rows in _chunks(_rows(batch, id_cols)):
                texts = encoder.encode([r[2] for r in rows])
                prompts = encoder.encode([r[1] for r in rows])
                packer.add(
                    [
                        (r[0], p + t + end, len(p) // 4)
                        for r, p, t in zip(rows, prompts, texts, strict=True)
                    ]
                )
                if packer.out:
                    yield flush()
        packer.finish()
        if packer.out:
            yield flush()

    return source.mapInArrow(run, schema)


def _arrow_schema(batch_schema, id_cols, made: T.StructType):
    import pyarrow as pa

    kinds = {"binary": pa.binary(), "bigint": pa.int64()}
    return pa.schema(
        [batch_schema.field(c) for c in id_cols]
        + [pa.field(f.name, kinds[f.dataType.simpleString()]) for f in made.fields]
    )


def _rows(batch, id_cols) -> list[tuple]:
    keys = zip(*(batch.column(c).to_pylist() for c in id_cols), strict=True)
    prompts, texts = batch.column("prompt__").to_pylist(), batch.column("text__").to_pylist()
    return list(zip(keys, prompts, texts, strict=True))


def _chunks(rows: list[tuple]) -> Iterator[list[tuple]]:
    chunk, chars = [], 0
    for row in rows:
        chunk.append(row)
        chars += len(row[1]) + len(row[2])
        if chars >= CHUNK_CHARS:
            yield chunk
            chunk, chars = [], 0
    if chunk:
        yield chunk
