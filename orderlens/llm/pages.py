"""Main text of web pages: markup, and a suffix array per host.

Pages of one host repeat their menus, notices and footers word for word. The token streams
of up to ``PAGES_PER_ARRAY`` pages of a host are laid end to end, and a suffix array over
them, exact to the length that counts as long, finds the substrings that occur on several
distinct pages. Those are boilerplate; the unique runs between them are kept. Pages with the
same tokens are copies of one page and count once.

What the markup itself says goes first: an ``article`` or ``main`` element is the main text
as its author marked it, so passages repeated inside it are kept, and elements that are
menus, headers, forms, adverts or comments by their tag, role or class never are. Repetition
decides on all the rest, that is on pages that mark no main text.

A host of up to ``PAGES_PER_ARRAY`` pages lies in one array. The pages of a larger one stay where
they are read, in arrays of their own, and what repeats is counted over all arrays of the host:
first the hashes of a few of every page's shorter substrings, which sift out the text that stands on
one page alone, then the substrings that are left. So neither the arrays' borders nor the
number of tasks matter, and no page is shuffled.
"""

from __future__ import annotations

import hashlib
import html as references
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.sources import scratch

PAGES_PER_ARRAY = 256
#: Tokens of a repeated substring, a power of two, and distinct pages that it is on.
LONG = 8
REPEATED_ON = 3
#: Tokens of the shorter substrings by which repeated ones are sifted.
_SHORT = LONG // 2
#: Sifted hashes are counted by their first bits; the next 32 are kept.
_BUCKET_BITS = 10
#: Bytes of the sieve, and of a table of repeated substrings, that are broadcast; a power of two.
BROADCAST_BYTES = 64 << 20
#: Characters of the pages that lie in one array of a large host, a page at least.
ARRAY_CHARS = 1 << 20

# fixed values: element names of HTML
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title noscript template iframe svg math object".split())
#: Closed by the next block if they have no end tag.
_SELF_CLOSING = frozenset("p li dt dd option".split())
_NOT_MAIN = frozenset(
    "nav aside footer form menu dialog button select head search label fieldset audio "
    "video canvas".split()
)
_NOT_MAIN_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar tablist".split()
)
_NOT_MAIN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer foot cookie "
    "cookies consent gdpr notice notices alert popup modal overlay banner subscribe newsletter "
    "signup login social share sharing related recommended comment comments respond reply "
    "replies discussion disqus form search skip widget toolbar masthead copyright legal "
    "pagination pager".split()
)
#: Not main outside an article; inside one, its title block.
_HEADER_WORDS = frozenset("header topbar".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?"
)
_WORDS = re.compile("[a-z0-9]+")


@dataclass
class Block:
    """One block of a page: its text, and whether it stands in marked main text."""

    text: str
    main: bool
    skipped: bool


@dataclass
class _Open:
    name: str
    main: bool
    skipped: bool


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=lambda: [_Open("", False, False)])

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join(references.unescape("".join(self.pieces)).split())
            self.pieces.clear()
            if text:
                top = self.stack[-1]
                self.blocks.append(Block(text, top.main, top.skipped))

    def start(self, name: str, attributes: str) -> None:
        block = name in _BLOCKS
        if block:
            self.end_block()
            if self.stack[-1].name in _SELF_CLOSING and (
                self.stack[-1].name == "p" or self.stack[-1].name == name
            ):
                self.stack.pop()
        if name in _VOID:
            if name == "br":
                self.pieces.append(" ")
            return
        top = self.stack[-1]
        main = top.main or (name in ("article", "main"))
        skipped = top.skipped or name in _NOT_MAIN or (name == "header" and not top.main)
        if attributes and not skipped:
            said = {
                a.lower(): (b or c or d)
                for a, b, c, d in _ATTRIBUTE.findall(attributes)
            }
            words = {
                *_WORDS.findall(said.get("class", "").lower()),
                *_WORDS.findall(said.get("id", "").lower()),
            }
            role = said.get("role", "").lower()
            main = main or role in ("main", "article")
            skipped = (
                role in _NOT_MAIN_ROLES
                or "hidden" in said
                or said.get("aria-hidden", "").lower() == "true"
                or "display:none" in said.get("style", "").replace(" ", "").lower()
                or (
                    name not in ("html", "body", "article", "main")
                    and bool(
                        words & _NOT_MAIN_WORDS or (not top.main and words & _HEADER_WORDS)
                    )
                )
            )
        if block or skipped != top.skipped or main != top.main:
            if not block:
                self.end_block()
            self.stack.append(_Open(name, main, skipped))

    def end(self, name: str) -> None:
        if name in _BLOCKS:
            self.end_block()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].name == name:
                if name not in _BLOCKS:
                    self.end_block()
                del self.stack[k:]
                return
            if name not in _BLOCKS and self.stack[k].name in _BLOCKS:
                return  # an inline end tag does not reach beyond its block


def read_blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with character references decoded."""
    reader, at, size = _Reader(), 0, len(page)
    while at < size:
        tag = _TAG.search(page, at)
        if tag is None:
            reader.pieces.append(page[at:])
            break
        if tag.start() > at:
            reader.pieces.append(page[at : tag.start()])
        at = tag.end()
        if not tag[2]:
            continue
        name = tag[2].lower()
        if tag[1]:
            reader.end(name)
        elif name in _RAW:
            if not tag[3].endswith("/"):
                close = re.compile(f"</{name}[^>]*>", re.I).search(page, at)
                at = close.end() if close else size
        else:
            reader.start(name, tag[3])
    reader.end_block()
    return reader.blocks


def _ranks(rank: np.ndarray, long: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``long`` tokens, from ranks of the tokens."""
    length = 1
    while length < long:
        after = np.zeros_like(rank)
        after[:-length] = rank[length:]
        pairs = rank * (max(int(rank.max()), 1) + 1) + after
        rank = np.unique(pairs, return_inverse=True)[1]
        length *= 2
    return rank


def _suffixes(pages: Sequence[Sequence[str]], long: int) -> tuple[np.ndarray, ...]:
    """Suffixes in the order of their first ``long`` tokens: place, owner, group, tokens left.

    Ranks of the suffixes by their first 1, 2, 4, ... tokens come from the ranks of half
    the length at two places; a page ends with a token of its own, so that no substring runs
    into the next page. Suffixes of equal rank are neighbours in the array and make a group.
    """
    sizes = np.array([len(p) for p in pages], dtype=np.int64)
    owner = np.repeat(np.arange(len(pages)), sizes + 1)
    numbers: dict[str, int] = {}
    number = numbers.setdefault
    flat: list[int] = []
    for k, tokens in enumerate(pages):
        flat += [number(t, len(numbers)) for t in tokens]
        flat.append(-1 - k)
    # ends are 0 .. pages - 1
    rank = _ranks(np.array(flat, dtype=np.int64) + len(pages), long)
    array = np.argsort(rank, kind="stable")  # so owners rise within equal ranks
    ranks = rank[array]
    group = np.cumsum(np.r_[True, ranks[1:] != ranks[:-1]]) - 1
    left = np.repeat(np.cumsum(sizes + 1), sizes + 1) - np.arange(len(rank)) - 1
    return array, owner[array], group, left[array]


def _covered(size: int, starts: Sequence[int] | np.ndarray, long: int = LONG) -> np.ndarray:
    """Which of ``size`` tokens lie in a substring of ``long`` tokens from one of ``starts``."""
    change, first = np.zeros(size + 1, dtype=np.int64), np.asarray(starts, dtype=np.int64)
    np.add.at(change, first, 1)
    np.subtract.at(change, np.minimum(first + long, size), 1)
    return np.cumsum(change)[:-1] > 0


def repeated(pages: Sequence[Sequence[str]], long: int = LONG, on: int = REPEATED_ON) -> list[np.ndarray]:
    """For each page's tokens, which lie in a substring of ``long`` tokens on ``on`` pages."""
    if not len(pages):
        return []
    array, owners, group, left = _suffixes(pages, long)
    new_owner = np.r_[True, (group[1:] != group[:-1]) | (owners[1:] != owners[:-1])]
    often = np.bincount(group, weights=new_owner)[group] >= on
    # the whole substring lies in the page
    covered = _covered(len(array), array[often & (left >= long)], long)
    sizes = np.array([len(p) for p in pages], dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    return [covered[e - n - 1 : e - 1] for e, n in zip(ends, sizes, strict=True)]


def substrings(
    pages: Sequence[Sequence[str]], long: int = LONG
) -> Iterator[tuple[bytes, list[tuple[int, list[int]]]]]:
    """Every substring of ``long`` tokens as a digest, and the pages and places it is at."""
    if not len(pages):
        return
    array, owners, group, left = _suffixes(pages, long)
    starts = np.r_[0, np.cumsum([len(p) + 1 for p in pages])]
    borders = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
    for low, high in zip(borders[:-1], borders[1:], strict=True):
        if left[low] < long:
            continue  # reaches its page's end, which no other page has
        at: dict[int, list[int]] = {}
        for place, k in zip(array[low:high].tolist(), owners[low:high].tolist(), strict=True):
            at.setdefault(k, []).append(place - int(starts[k]))
        k, places = next(iter(at.items()))
        words = " ".join(pages[k][places[0] : places[0] + long])
        yield hashlib.md5(words.encode("utf-8", "surrogatepass")).digest(), list(at.items())


def _words(blocks: Sequence[Block]) -> list[list[str]]:
    return [b.text.split(" ") for b in blocks]


def _stream(words: Sequence[Sequence[str]]) -> tuple[str, ...]:
    return tuple(t for block in words for t in block)


def _marked(blocks: Sequence[Block]) -> bool:
    return any(b.main and not b.skipped for b in blocks)


def _main_text(
    blocks: Sequence[Block], words: Sequence[Sequence[str]], cover: np.ndarray
) -> tuple[str, int]:
    marked = _marked(blocks)
    kept, at = [], 0
    for block, tokens in zip(blocks, words, strict=True):
        here = cover[at : at + len(tokens)]
        at += len(tokens)
        if block.skipped or (marked and not block.main):
            continue
        if marked or not here.any():
            kept.append(block.text)
        elif not here.all():
            kept.append(" ".join(w for w, c in zip(tokens, here, strict=True) if not c))
    return "\n".join(kept), int(cover.sum())


def main_texts(htmls: Sequence[str]) -> list[tuple[str, int]]:
    """Main text, and tokens covered by repetition, of pages of one host."""
    read = [read_blocks(h) for h in htmls]
    split = [_words(blocks) for blocks in read]
    streams = [_stream(words) for words in split]
    distinct = list(dict.fromkeys(streams))
    cover_of = dict(zip(distinct, repeated(distinct), strict=True))
    return [
        _main_text(blocks, words, cover_of[stream])
        for blocks, words, stream in zip(read, split, streams, strict=True)
    ]


def host(url: Column) -> Column:
    """Host of a URL in lower case; empty if there is none."""
    found = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


def extract(
    df: DataFrame,
    html_col: str = "html",
    url_col: str = "url",
    keep: Sequence[str] = ("page_id", "url"),
) -> DataFrame:
    """``keep``, ``text`` and ``n_repeated`` (tokens covered by repetition) of every page.

    Null or empty html gives an empty text. Pages without a host form one host. Repeated rows
    stay, and count as one page for what is repeated. Other columns are not read; ``keep`` must not name the
    result's columns. An empty table gives an empty result. Nothing of a page is cut off.
    """
    if clash := set(keep) & {"text", "n_repeated"}:
        raise ValueError(f"columns clash with the result's: {sorted(clash)}")
    source = df.select(
        *[F.col(f"`{c}`") for c in keep],
        host(F.col(f"`{url_col}`")).alias("host__"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html__"),
    )
    schema = T.StructType(
        [source.schema[c] for c in keep]
        + T.StructType.fromDDL("text string, n_repeated long").fields
    )
    large = scratch.durable(
        source.groupBy("host__")
        .agg(F.count("*").alias("pages__"))
        .where(F.col("pages__") > PAGES_PER_ARRAY)
        .select("host__"),
        "large_hosts",
    )
    if large.isEmpty():
        return _in_arrays(source, keep, schema)
    alone = source.join(F.broadcast(large), "host__", "left_anti")
    together = source.join(F.broadcast(large), "host__", "left_semi")
    return _in_arrays(alone, keep, schema).unionByName(_across_arrays(together, keep, schema))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _chain(start: np.ndarray, words: np.ndarray, at: np.ndarray, long: int) -> np.ndarray:
    """Hashes of the substrings of ``long`` tokens from some places."""
    made = start[at]
    for k in range(long):
        made = _mix(made * np.uint64(0x9E3779B97F4A7C15) + words[at + k])
    return made


class _Array:
    """Token hashes of some pages end to end, each page's mixed with its host's."""

    def __init__(self, hosts: Sequence[str], blocks: list[list[Block]]):
        import xxhash

        self.blocks = blocks
        texts = [" ".join(b.text for b in page).encode("utf-8", "surrogatepass") for page in blocks]
        seeds = [xxhash.xxh3_64_intdigest(h.encode("utf-8", "surrogatepass")) for h in hosts]
        #: Copies, which have the same tokens, have the same number.
        self.numbers = np.array(
            [xxhash.xxh3_64_intdigest(t, s) for t, s in zip(texts, seeds, strict=True)], np.uint64
        )
        sizes = [t.count(b" ") + 1 if t else 0 for t in texts]
        self.page = np.repeat(np.arange(len(texts)), sizes)
        self.first = np.cumsum([0, *sizes])
        self.seed = np.repeat(np.array(seeds, np.uint64), sizes)
        self.data = np.frombuffer(b" ".join(t for t in texts if t), np.uint8)
        self.words = self._hashed(0)

    def _hashed(self, seed: int) -> np.ndarray:
        """A hash of every token: the sum of those of its bytes and their places."""
        if not len(self.data):
            return np.empty(0, np.uint64)
        end = self.data == 32
        starts = np.r_[0, np.flatnonzero(end) + 1]
        place = np.arange(len(self.data)) - np.repeat(starts, np.diff(np.r_[starts, len(self.data)]))
        values = _mix((place.astype(np.uint64) << np.uint64(8)) + self.data + np.uint64((seed << 56) + 1))
        values[end] = 0
        return _mix(np.add.reduceat(values, starts))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the substrings of ``LONG`` tokens, and the least hash of the ``_SHORT`` in each.

        Equal substrings of a host have equal keys, and neighbours mostly share theirs.
        """
        size = len(self.words) - LONG + 1
        if size <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        short = _chain(self.seed, self.words, np.arange(size + LONG - _SHORT), _SHORT)
        least = short[:size]
        for k in range(1, LONG - _SHORT + 1):
            least = np.minimum(least, short[k : k + size])
        at = np.flatnonzero(self.page[:size] == self.page[LONG - 1 :])
        return at, _mix(least[at] + np.uint64(1))  # the least of some are not evenly spread

    def names(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes that name the substrings of a host from some places."""
        return (
            _chain(self.seed, self.words, at, LONG),
            _chain(self.seed, self._hashed(1), at, LONG),
        )

    def groups(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places ordered by their substrings, by a suffix array of what they cover; its groups."""
        covered = _covered(len(self.words), at)
        ranks = np.unique(self.words[covered] ^ self.seed[covered], return_inverse=True)[1]
        # what a place covers is covered without a gap
        rank = _ranks(ranks, LONG)[(np.cumsum(covered) - 1)[at]]
        order = np.lexsort((at, self.numbers[self.page[at]], rank))
        return at[order], rank[order]


def _arrays(batch) -> Iterator[_Array]:
    hosts, blocks, chars = [], [], 0
    for h, page in zip(batch.column("host__"), batch.column("html__"), strict=True):
        hosts.append(h.as_py())
        blocks.append(read_blocks(page.as_py()))
        chars += sum(len(b.text) for b in blocks[-1])
        if chars >= ARRAY_CHARS:
            yield _Array(hosts, blocks)
            hosts, blocks, chars = [], [], 0
    if hosts:
        yield _Array(hosts, blocks)


def _short_hashes(batches: Iterator) -> Iterator:
    """The keys of every page with a tag of its tokens, packed by their first bits."""
    import pyarrow as pa

    for batch in batches:
        keys, tags = [], []
        for array in _arrays(batch):
            at, key = array.keys()
            if len(at):
                page = array.page[at]
                new = np.r_[True, (key[1:] != key[:-1]) | (page[1:] != page[:-1])]
                keys.append(key[new])
                tags.append(array.numbers[page[new]].astype(np.uint32))
        if not keys:
            continue
        key, tag = np.concatenate(keys), np.concatenate(tags)
        order = np.argsort(key, kind="stable")
        key, tag = key[order], tag[order]
        bucket = (key >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        low = _low(key)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        parts = [slice(a, b) for a, b in zip(starts, [*starts[1:], len(key)], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[starts], pa.int32()),
                pa.array([low[part].tobytes() for part in parts], pa.binary()),
                pa.array([tag[part].tobytes() for part in parts], pa.binary()),
            ],
            names=["bucket", "low", "tag"],
        )


def _low(keys: np.ndarray) -> np.ndarray:
    """The 32 bits after those of the bucket."""
    return ((keys << np.uint64(_BUCKET_BITS)) >> np.uint64(32)).astype(np.uint32)


def _on_several(batches: Iterator) -> Iterator:
    """Of rows that come bucket by bucket, the hashes that pages of unlike tags have.

    Copies have the same tag. What is on three pages and missed here has three equal tags, for
    which the chance is 2 ** -64.
    """
    import pyarrow as pa

    def done(bucket: int, waiting: list) -> pa.RecordBatch:
        both = np.unique(np.concatenate(waiting))
        low = (both >> np.uint64(32)).astype(np.uint32)
        again = np.unique(low[1:][low[1:] == low[:-1]])
        arrays = [pa.array([bucket], pa.int32()), pa.array([again.tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=["bucket", "low"])

    waiting, of = [], None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("bucket", "low", "tag"))
        for bucket, low, tag in zip(*columns, strict=True):
            if waiting and bucket != of:
                yield done(of, waiting)
                waiting = []
            of = bucket
            high = np.frombuffer(low, np.uint32).astype(np.uint64) << np.uint64(32)
            waiting.append(high | np.frombuffer(tag, np.uint32))
    if waiting:
        yield done(of, waiting)


class _Sieve:
    """Bits of the hashes that several pages have; passes some others too, or all without bits."""

    def __init__(self, bits: np.ndarray | None):
        self.bits = bits  # a row for each bucket

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Places of the substrings that several pages may have, by their keys."""
        if self.bits is None:
            return np.arange(len(keys))
        bucket = (keys >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
        at = _low(keys) % np.uint32(self.bits.shape[1] * 8)
        return np.flatnonzero((self.bits[bucket, at >> 3] >> (at & 7).astype(np.uint8)) & 1)


def _sieve(source: DataFrame) -> _Sieve:
    """Sieve of these pages: 16 bits a hash as far as memory allows, set in tasks."""
    several = scratch.durable(
        source.mapInArrow(_short_hashes, "bucket int, low binary, tag binary")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_on_several, "bucket int, low binary"),
        "short_substrings",
    )
    most = several.agg(F.max(F.length("low"))).first()[0] or 0
    # bits of a bucket, a power of two; fewer pass more that only one page has
    size = min(16 << max(most // 4, 1).bit_length(), (BROADCAST_BYTES * 8) >> _BUCKET_BITS)
    if size < 8:
        return _Sieve(None)

    def packed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = []
            for low in batch.column("low").to_pylist():
                flags = np.zeros(size, bool)
                flags[np.frombuffer(low, np.uint32) % np.uint32(size)] = True
                made.append(np.packbits(flags, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("bucket"), pa.array(made, pa.binary())], names=["bucket", "bits"]
            )

    bits = np.zeros((1 << _BUCKET_BITS, size // 8), np.uint8)
    for row in several.mapInArrow(packed, "bucket int, bits binary").toLocalIterator():
        bits[row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    return _Sieve(bits)


_AT = "name long, other long, page__ long, at int"


def _array_substrings(batches: Iterator, sieve, whole: bool) -> Iterator:
    """The substrings that pass the sieve and the pages they are on, array by array.

    Of a substring on ``REPEATED_ON`` pages of an array no more of them are needed to count it; with
    ``whole`` all places on all pages are told.
    """
    import pyarrow as pa

    for batch in batches:
        for array in _arrays(batch):
            at, key = array.keys()
            at = at[sieve.value(key)]
            if not len(at):
                continue
            at, group = array.groups(at)
            number = array.numbers[array.page[at]]
            if not whole:
                first = np.r_[True, group[1:] != group[:-1]]
                new = first | np.r_[True, number[1:] != number[:-1]]
                nth = np.cumsum(new)  # of all pages, then of the group's
                nth -= np.repeat(nth[first], np.diff(np.r_[np.flatnonzero(first), len(at)]))
                told = new & (nth < REPEATED_ON)
                at, number = at[told], number[told]
            name, other = array.names(at)
            place = (at - array.first[array.page[at]]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.view(np.int64)) for x in (name, other, number)] + [pa.array(place)],
                names=["name", "other", "page__", "at"],
            )


def _across_arrays(source: DataFrame, keep: Sequence[str], schema: T.StructType) -> DataFrame:
    """Pages of hosts that need several arrays: what repeats is counted over all of them."""
    context = source.sparkSession.sparkContext
    sieve = context.broadcast(_sieve(source))
    often = scratch.durable(
        source.mapInArrow(lambda batches: _array_substrings(batches, sieve, whole=False), _AT)
        .groupBy("name", "other")
        .agg(F.size(F.collect_set("page__")).alias("pages"))
        .where(F.col("pages") >= REPEATED_ON)
        .select("name", "other"),
        "repeated_substrings",
    )
    names = list(keep)

    def run(batches: Iterator, starts_of) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            made = []
            for array in _arrays(batch):
                starts = starts_of(batch, len(made), array)
                for blocks, at in zip(array.blocks, starts, strict=True):
                    words = _words(blocks)
                    made.append(_main_text(blocks, words, _covered(len(_stream(words)), at)))
            arrays = [batch.column(c) for c in names]
            arrays += [pa.array([t for t, _ in made], pa.string())]
            arrays += [pa.array([n for _, n in made], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "text", "n_repeated"])

    if often.count() * 16 <= BROADCAST_BYTES:
        rows = [(r["name"], r["other"]) for r in often.toLocalIterator()]
        table = np.array(sorted(rows), np.int64).reshape(-1, 2)
        told = context.broadcast(table)

        def known(batch, start: int, array: _Array) -> list[np.ndarray]:
            at, key = array.keys()
            at = at[sieve.value(key)]
            if len(at) and len(told.value):
                name, other = (x.view(np.int64) for x in array.names(at))
                found = np.searchsorted(told.value[:, 0], name) % len(told.value)
                at = at[(told.value[found, 0] == name) & (told.value[found, 1] == other)]
            else:
                at = at[:0]
            return np.split(at - array.first[array.page[at]], np.searchsorted(at, array.first[1:-1]))

        return source.mapInArrow(lambda batches: run(batches, known), schema)

    places = (
        source.mapInArrow(lambda batches: _array_substrings(batches, sieve, whole=True), _AT)
        .join(often, ["name", "other"], "left_semi")
        .groupBy("page__")
        .agg(F.collect_set("at").alias("starts__"))
    )
    numbered = T.StructType([*source.schema, T.StructField("page__", T.LongType())])
    placed = source.mapInArrow(_numbered, numbered).join(places, "page__", "left")

    def joined(batch, start: int, array: _Array) -> list[list[int]]:
        return [
            starts or [] for starts in batch.column("starts__").slice(start, len(array.blocks)).to_pylist()
        ]

    return placed.mapInArrow(lambda batches: run(batches, joined), schema)


def _numbered(batches: Iterator) -> Iterator:
    """Pages with the number that their copies share."""
    import pyarrow as pa

    for batch in batches:
        numbers = [array.numbers for array in _arrays(batch)]
        column = pa.array(np.concatenate(numbers).view(np.int64) if numbers else [], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "page__"])


def _in_arrays(source: DataFrame, keep: Sequence[str], schema: T.StructType) -> DataFrame:
    """Pages of hosts that one array holds."""
    ranged = source.repartitionByRange("host__").sortWithinPartitions("host__")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names, kinds = list(keep), None

        def done(rows):
            made = main_texts([r[-1] for r in rows])
            columns = list(zip(*[r[0] for r in rows], strict=True)) if names else []
            arrays = [pa.array(c, kinds.field(n).type) for n, c in zip(names, columns, strict=True)]
            arrays += [pa.array([t for t, _ in made], pa.string())]
            arrays += [pa.array([n for _, n in made], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=[*names, "text", "n_repeated"])

        waiting: list[tuple] = []
        for batch in batches:
            kinds = batch.schema
            keys = zip(*(batch.column(c).to_pylist() for c in names), strict=True)
            hosts, htmls = batch.column("host__"), batch.column("html__")
            for key, h, page in zip(keys, hosts, htmls, strict=True):
                h = h.as_py()
                if waiting and waiting[0][1] != h:
                    yield done(waiting)
                    waiting = []
                waiting.append((key, h, page.as_py()))
        if waiting:
            yield done(waiting)

    return ranged.mapInArrow(run, schema)
