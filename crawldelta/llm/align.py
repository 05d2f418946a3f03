"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which of their ids go together.

A text is seen as bytes that two tokenizers cover. Byte offsets where tokens of
both end cut them into groups. Short texts are aligned where they are read. Long
ones are cut into byte ranges of a bounded size, which are encoded and aligned
by tasks of their own; a range's result is a fragment:

  head    tokens up to the first common end: the group may have begun before
  closed  whole groups, a row of the result that moves no more
  tail    tokens after the last common end

Fragments form a monoid: of two neighbours, the first one's tail and the second
one's head make groups of their own, and what is left open is a head and a tail
again. So a text's fragments are composed in any bracketing, here by a tree
whose levels are shuffles of open parts only.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawldelta.llm import scratch
from crawldelta.llm.scratch import ship_code, stored, without

#: Texts of more characters than this are cut, into ranges of about so many.
RANGE = 1 << 16

#: Neighbouring fragments that one task composes at a level.
FAN_IN = 8

#: Characters encoded together.
ENCODED_AT_ONCE = 1 << 20

#: Groups, or links, of one stored row at most: whoever reads such rows holds thousands of them at once.
ROW_GROUPS = 512
ROW_LINKS = 512

#: Distinct pairs of ids that a task counts before it tells them.
PAIRS_AT_ONCE = 1_000_000

#: Where one tokenizer always begins a token: at a single white space between others.
_A_CUT = re.compile(r"(?<=\S)[ \n](?=\S)")
#: The other's pieces hold its space sign at their front only.
_B_CUT = re.compile(r"(?<=[^ ▁])(?= [^ ▁])")
#: One tokenizer's fast form takes quadratic time in a run of so many signs; the other form does not.
LONG_RUN = 500
_LONG_SPACE = re.compile(rf"\s{{{LONG_RUN}}}")

_OPEN = [f"{part}_{c}" for part in ("head", "tail") for c in ("a_ids", "a_ends", "b_ids", "b_ends")]
_SECTION = ["at", "a_ids", "b_ids", "a_sizes", "b_sizes"]
_INTS, _LONGS = ("array<int>", pa.list_(pa.int32())), ("array<long>", pa.list_(pa.int64()))
_LINKS = ("array<struct<pair:long,times:int>>", pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int32())])))
#: What tasks write: rows of the kinds text, section, links, counts and open, each with columns of its own.
_COLUMNS = (
    {"kind": ("string", pa.string())}
    | {c: ("long", pa.int64()) for c in ("row_id", "doc_id", "seq", "n_a", "n_b", "n_groups", "at")}
    | {"ok": ("boolean", pa.bool_()), "groups_sha256": ("string", pa.string())}
    | {c: _INTS for c in _SECTION[1:]}
    | {"links": _LINKS, "cut": ("boolean", pa.bool_())}
    | {c: _LONGS if c.endswith("ends") else _INTS for c in _OPEN}
)
_DDL = ", ".join(f"{c} {t}" for c, (t, _) in _COLUMNS.items())


def _batch(kind: str, n: int, **columns: list | np.ndarray | pa.Array) -> pa.RecordBatch:
    """n rows of a kind; columns that are not given are null."""
    made = {c: x if isinstance(x, pa.Array) else pa.array(x, _COLUMNS[c][1]) for c, x in columns.items()} | {"kind": pa.array([kind] * n)}
    arrays = [made[c] if c in made else pa.nulls(n, t) for c, (_, t) in _COLUMNS.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_COLUMNS))


# ---------------------------------------------------------------- tokenizers


class Vocabulary(NamedTuple):
    """A tokenizer as the alignment needs it: ids of texts, bytes of ids."""

    encode: Callable[[list[str]], list[np.ndarray]]
    raw: list[bytes]
    sizes: np.ndarray
    bytes_of: pa.Array


def _vocabulary(encode: Callable[[list[str]], list[np.ndarray]], raw: list[bytes]) -> Vocabulary:
    return Vocabulary(encode, raw, np.array([len(r) for r in raw], np.int64), pa.array(raw, pa.large_binary()))


def _byte_signs() -> dict[str, int]:
    """The printable sign for each byte in a byte-level vocabulary: itself where it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level(path: str) -> Vocabulary:
    """A byte-level BPE file of the tokenizers library, its merges in the order of their ids; strings of special tokens are plain text.

    Texts are encoded by tiktoken over the file's own vocabulary, which gives the
    same ids in a third of the time; those with a run of very many signs without
    white space, or of white space, by the tokenizers library.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    model, signs = Tokenizer.from_file(path), _byte_signs()
    model.encode_special_tokens = True
    size = model.get_vocab_size(with_added_tokens=True)
    ranks = {bytes(signs[c] for c in token): i for token, i in model.get_vocab(with_added_tokens=False).items()}
    raw = [b""] * size
    for token, i in model.get_vocab(with_added_tokens=True).items():
        raw[i] = token.encode()
    for token, i in ranks.items():
        raw[i] = token
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def one(text: str) -> np.ndarray:
        if max(map(len, text.split()), default=0) < LONG_RUN and not _LONG_SPACE.search(text):
            return fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
        return np.array(model.encode(text, add_special_tokens=False).ids, np.int32)

    return _vocabulary(lambda texts: [one(t) for t in texts], raw)


def pieces(path: str) -> Vocabulary:
    """A sentencepiece model, which puts a space before each text; byte pieces stand for their byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(n)]
    raw = [bytes([int(s[3:5], 16)]) if model.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(names)]
    return _vocabulary(lambda texts: [np.array(x, np.int32) for x in model.encode(texts, num_threads=1)], raw)


_LOADED: dict[tuple[str, str], tuple[Vocabulary, Vocabulary]] = {}


def vocabularies(a: str, b: str) -> tuple[Vocabulary, Vocabulary]:
    """Both tokenizers, loaded once a worker."""
    if (a, b) not in _LOADED:
        _LOADED[a, b] = byte_level(a), pieces(b)
    return _LOADED[a, b]


# ---------------------------------------------------------------- fragments


class Tokens(NamedTuple):
    """A run of tokens of both tokenizers: their ids and the byte offsets where they end."""

    a_ids: np.ndarray
    a_ends: np.ndarray
    b_ids: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*map(np.concatenate, zip(self, other)))

    def until(self, end: int) -> tuple[Tokens, Tokens]:
        """The tokens that end up to a byte, and the others."""
        i, j = np.searchsorted(self.a_ends, end, "right"), np.searchsorted(self.b_ends, end, "right")
        cut = (i, i, j, j)
        return Tokens(*[x[:k] for x, k in zip(self, cut)]), Tokens(*[x[k:] for x, k in zip(self, cut)])

    def common(self) -> np.ndarray:
        """Where tokens of both end, ascending."""
        both = np.sort(np.concatenate((self.a_ends, self.b_ends)), kind="stable")  # two ascending runs: merged
        return both[1:][both[1:] == both[:-1]]


NO_TOKENS = Tokens(*[np.zeros(0, t) for t in (np.int32, np.int64, np.int32, np.int64)])


class Fragment(NamedTuple):
    """What a byte range leaves open. Without a cut, all of its tokens are in the head."""

    head: Tokens
    tail: Tokens
    cut: bool


def split(tokens: Tokens, begun: bool) -> tuple[Fragment, Tokens]:
    """The fragment of tokens, and its closed groups. `begun`: a group is known to begin with them."""
    common = tokens.common()
    if begun:
        closed, tail = tokens.until(common[-1]) if len(common) else (NO_TOKENS, tokens)
        return Fragment(NO_TOKENS, tail, True), closed
    if not len(common):
        return Fragment(tokens, NO_TOKENS, False), NO_TOKENS
    head, rest = tokens.until(common[0])
    closed, tail = rest.until(common[-1])
    return Fragment(head, tail, True), closed


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, Tokens]:
    """The fragment of two neighbours, and the groups that they close between them. Associative."""
    between, closed = split((left.tail if left.cut else left.head) + right.head, left.cut)
    head = left.head if left.cut else between.head
    return Fragment(head, right.tail if right.cut else between.tail, between.cut), closed


class Cover(NamedTuple):
    """The bytes that a run of whole groups covers: how many tokens of each side, and how many groups and links, end up to each."""

    base: int
    a: np.ndarray
    b: np.ndarray
    common: np.ndarray
    links: np.ndarray


def cover(tokens: Tokens, base: int = 0) -> Cover:
    """Counts by byte from `base` on, which lies before the first end."""
    size = int(max(tokens.a_ends[-1], tokens.b_ends[-1])) - base + 1 if len(tokens.a_ends) else 1
    marks = np.zeros((2, size), bool)
    marks[0, tokens.a_ends - base] = True
    marks[1, tokens.b_ends - base] = True
    count = lambda m: np.cumsum(m, dtype=np.int32)
    return Cover(base, count(marks[0]), count(marks[1]), count(marks[0] & marks[1]), count(marks[0] | marks[1]))


def _places(counts: np.ndarray) -> np.ndarray:
    """The bytes at which a running count grows."""
    return np.flatnonzero(np.diff(counts, prepend=0))


def groups_of(tokens: Tokens, held: Cover | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side the groups hold, of tokens that are whole groups."""
    held = held or cover(tokens, _base(tokens))
    ends = _places(held.common)
    return np.diff(held.a[ends], prepend=0).astype(np.int32), np.diff(held.b[ends], prepend=0).astype(np.int32)


def links_of(tokens: Tokens, held: Cover | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The (A token, B token) places whose bytes overlap, by where the overlap ends, of tokens that are whole groups."""
    held = held or cover(tokens, _base(tokens))
    before = _places(held.links) - 1
    return held.a[before], held.b[before]


def _base(tokens: Tokens) -> int:
    """A byte before the first end, within the first group."""
    return int(min(tokens.a_ends[0], tokens.b_ends[0])) - 1 if len(tokens.a_ends) else 0


# ---------------------------------------------------------------- tasks


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _section_rows(tokens: Tokens, held: Cover, row_ids: np.ndarray, firsts: np.ndarray, stops: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sections of texts that lie end to end, each text from its byte of firsts to that of stops; a long one's in parts, by ascending `at`."""
    group_ends = _places(held.common) + held.base
    last = held.common[stops - held.base].tolist()
    owner, begin, end = [], [], []
    for row_id, first, low, high in zip(row_ids.tolist(), firsts.tolist(), [0, *last], last):
        for k in range(low, high, ROW_GROUPS):
            owner.append(row_id)
            begin.append(first if k == low else int(group_ends[k - 1]))
            end.append(int(group_ends[min(k + ROW_GROUPS, high) - 1]))
    if not owner:
        return
    at_end = np.array(end, np.int64) - held.base
    count = lambda c: np.diff(c[at_end], prepend=0)
    a_sizes, b_sizes = groups_of(tokens, held)
    yield _batch(
        "section", len(owner), row_id=owner, at=begin,
        a_ids=_lists(tokens.a_ids, count(held.a), pa.int32()), b_ids=_lists(tokens.b_ids, count(held.b), pa.int32()),
        a_sizes=_lists(a_sizes, count(held.common), pa.int32()), b_sizes=_lists(b_sizes, count(held.common), pa.int32()),
    )


def _link_list(pairs: np.ndarray, times: np.ndarray, offsets: list[int]) -> pa.Array:
    link = pa.StructArray.from_arrays([pa.array(pairs, pa.int64()), pa.array(times, pa.int32())], ["pair", "times"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), link)


def _links(tokens: Tokens, held: Cover, stops: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, times, how many distinct pairs each text has) of texts that lie end to end, text by text."""
    x, y = links_of(tokens, held)
    pair = tokens.a_ids[x].astype(np.int64) * span + tokens.b_ids[y]
    bits = int(pair.max()).bit_length() if len(pair) else 0
    of = np.repeat(np.arange(len(stops), dtype=np.int64), np.diff(held.links[stops - held.base], prepend=0))
    keys = np.sort((of << bits) | pair)
    fresh = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[fresh] & ((1 << bits) - 1), np.diff(fresh, append=len(keys)), np.bincount(keys[fresh] >> bits, minlength=len(stops))


def _link_rows(row_ids: np.ndarray, pairs: np.ndarray, times: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The links of each text, in rows of a bounded size."""
    owner, offsets, at = [], [], 0
    for row_id, n in zip(row_ids.tolist(), counts.tolist()):
        for low in range(at, at + n, ROW_LINKS):
            owner.append(row_id)
            offsets.append(low)
        at += n
    if owner:
        yield _batch("links", len(owner), row_id=owner, links=_link_list(pairs, times, [*offsets, at]))


def _group_text(tokens: Tokens, held: Cover, a: Vocabulary, b: Vocabulary) -> tuple[memoryview, np.ndarray]:
    """`a1,a2|b1;a3|b2,b3;` of whole groups as bytes, and the byte where each group's text ends.

    Each token is taken from a table of ids in decimal with the sign that
    follows: a comma within a group, else the one that ends its side.
    """
    a_sizes, b_sizes = groups_of(tokens, held)
    a_stops, b_stops = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_last, b_last = np.zeros(len(tokens.a_ids), np.int64), np.zeros(len(tokens.b_ids), np.int64)
    a_last[a_stops - 1] = 1
    b_last[b_stops - 1] = 1
    index = np.empty(len(a_last) + len(b_last), np.int64)
    # A group's A tokens stand after all tokens of the groups before, its B tokens after them.
    index[np.arange(len(a_last)) + np.repeat(b_stops - b_sizes, a_sizes)] = 2 * tokens.a_ids.astype(np.int64) + a_last
    index[np.arange(len(b_last)) + np.repeat(a_stops, b_sizes)] = 2 * (len(a.raw) + tokens.b_ids.astype(np.int64)) + b_last
    data, ends = _taken(_decimals(len(a.raw), len(b.raw)), index)
    return data, ends[a_stops + b_stops - 1] if len(ends) else ends


_DECIMALS: dict[tuple[int, int], pa.Array] = {}


def _decimals(n_a: int, n_b: int) -> pa.Array:
    """Every id with a comma and with the sign that ends its side, first those of A."""
    if (n_a, n_b) not in _DECIMALS:
        told = [f"{i}{sign}" for n, signs in ((n_a, ",|"), (n_b, ",;")) for i in range(n) for sign in signs]
        _DECIMALS[n_a, n_b] = pa.array([t.encode() for t in told], pa.large_binary())
    return _DECIMALS[n_a, n_b]


def _taken(table: pa.Array, index: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The chosen entries of a table of bytes end to end, and where each ends."""
    taken = table.take(pa.array(index))
    offsets = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset : taken.offset + len(taken) + 1]
    data = memoryview(taken.buffers()[2] or b"")
    return data[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def _given_back(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary, raws: list[bytes]) -> np.ndarray:
    """Which texts their tokens give back byte by byte."""
    data, ends = _taken(vocabulary.bytes_of, ids)
    if bytes(data) == b"".join(raws):
        stops = np.concatenate(([0], ends))[np.cumsum(counts)]
        if np.array_equal(stops, np.cumsum([len(r) for r in raws])):
            return np.ones(len(raws), bool)
    stops = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))].tolist()
    return np.array([bytes(data[p:q]) == r for p, q, r in zip(stops, stops[1:], raws)], bool)


def _whole_texts(rows: list[tuple], a: Vocabulary, b: Vocabulary, counted: PairCounts) -> Iterator[pa.RecordBatch]:
    """Short texts with their digests, their sections and links; those that the tokenizers do not give back have none."""
    texts, row_ids = [text or "" for _, _, text in rows], np.array([r[0] for r in rows], np.int64)
    full = np.array([i for i, t in enumerate(texts) if t], np.int64)
    raws = [(" " + texts[i]).encode() for i in full]
    coded, counts, sound = [], [], np.ones(len(full), bool)
    for vocabulary, source in ((a, [" " + texts[i] for i in full]), (b, [texts[i] for i in full])):
        ids = vocabulary.encode(source)
        counts.append(np.array([len(x) for x in ids], np.int64))
        coded.append(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32))
        sound &= _given_back(coded[-1], counts[-1], vocabulary, raws)
    coded = [c[np.repeat(sound, n)] for c, n in zip(coded, counts)]
    # All sound texts of the slice lie end to end: each begins and ends at a common end.
    sizes = np.array([len(r) if s else 0 for r, s in zip(raws, sound)], np.int64)
    tokens = Tokens(coded[0], np.cumsum(a.sizes[coded[0]]), coded[1], np.cumsum(b.sizes[coded[1]]))
    ends = np.cumsum(sizes)
    firsts, stops, held, told = (ends - sizes)[sound], ends[sound], cover(tokens), full[sound]
    text, text_ends = _group_text(tokens, held, a, b)
    cuts = np.concatenate(([0], text_ends))[held.common[stops]].tolist()
    digests = [""] * len(rows)
    for i, p, q in zip(told.tolist(), [0, *cuts], cuts):
        digests[i] = hashlib.sha256(text[p : q - 1]).hexdigest()
    ok, numbers = np.ones(len(rows), bool), {}
    ok[full[~sound]] = False
    for name, count in (("n_a", held.a), ("n_b", held.b), ("n_groups", held.common)):
        numbers[name] = np.zeros(len(rows), np.int64)
        numbers[name][told] = np.diff(count[stops], prepend=0)
    yield _batch("text", len(rows), row_id=row_ids, doc_id=[r[1] for r in rows], ok=ok, groups_sha256=digests, **numbers)
    yield from _section_rows(tokens, held, row_ids[told], firsts, stops)
    pairs, times, distinct = _links(tokens, held, stops, len(b.raw))
    yield from _link_rows(row_ids[told], pairs, times, distinct)
    yield from counted.add(pairs)


class PairCounts:
    """Texts by linked pair, added up over a task's slices; told in rows of a bounded size."""

    def __init__(self) -> None:
        self.pairs, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Count the distinct pairs of each text."""
        own, n = np.unique(pairs, return_counts=True)
        both, turn = np.unique(np.concatenate((self.pairs, own)), return_inverse=True)
        self.pairs, self.n = both, np.bincount(turn, np.concatenate((self.n, n)), len(both)).astype(np.int64)
        if len(both) > PAIRS_AT_ONCE:
            yield from self.told()

    def told(self) -> Iterator[pa.RecordBatch]:
        """The counts as rows without a text."""
        offsets = list(range(0, len(self.pairs), ROW_LINKS))
        if offsets:
            yield _batch("counts", len(offsets), links=_link_list(self.pairs, self.n, [*offsets, len(self.pairs)]))
        self.pairs, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _slices(rows: Iterator[tuple], size: Callable[[tuple], int]) -> Iterator[list[tuple]]:
    held, some = 0, []
    for row in rows:
        if some and held + size(row) > ENCODED_AT_ONCE:
            yield some
            held, some = 0, []
        some.append(row)
        held += size(row)
    if some:
        yield some


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            yield from zip(*[c.to_pylist() for c in batch.slice(low, 256).columns])


def ranges(text: str, size: int = RANGE) -> list[tuple[str, int, str, int]]:
    """The byte ranges of a text with a space before it: for each tokenizer what to encode, and the byte where it begins.

    A tokenizer's range begins at its own first safe place from the nominal
    bound on, so the two begin at places of their own; an empty one has no tokens.
    """
    nominal = range(size, len(text), size)
    cuts = []
    for rule in (_A_CUT, _B_CUT):
        found = [rule.search(text, p) for p in nominal]
        cuts.append([0, *[m.start() if m else len(text) for m in found], len(text)])
    out, at, byte = [], 0, {0: 0}
    for place in sorted({*cuts[0], *cuts[1]}):
        byte[place] = byte[at] + len(text[at:place].encode())
        at = place
    for i, (x, x_end, y, y_end) in enumerate(zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:])):
        own_a = (" " if i == 0 else "") + text[x:x_end]
        # The piece model puts a space before what it encodes; from the second range on, it is the text's own.
        own_b = text[y + (i > 0) : y_end]
        out.append((own_a, byte[x] + (i > 0), own_b, byte[y] + (i > 0)))
    return out


def _open_row(row_id: int, doc_id: int | None, seq: int, ok: bool, part: Fragment) -> pa.RecordBatch:
    lists = {c: [x] for c, x in zip(_OPEN, [*part.head, *part.tail])}
    return _batch("open", 1, row_id=[row_id], doc_id=[doc_id], seq=[seq], ok=[ok], cut=[part.cut], **lists)


def _closed_rows(row_id: int, closed: Tokens, span: int) -> Iterator[pa.RecordBatch]:
    """Sections and links of closed groups; their places begin at a byte of the first group, so sections keep their order."""
    if len(closed.a_ids):
        first = _base(closed)
        held, row_ids, stops = cover(closed, first), np.array([row_id]), closed.a_ends[-1:]
        yield from _section_rows(closed, held, row_ids, np.array([first]), stops)
        yield from _link_rows(row_ids, *_links(closed, held, stops, span))


def _aligned_ranges(batches: Iterator[pa.RecordBatch], a: Vocabulary, b: Vocabulary) -> Iterator[pa.RecordBatch]:
    """The fragments of ranges (row_id, doc_id, seq, a_text, a_byte, b_text, b_byte), and the groups that they close."""
    for some in _slices(_rows(batches), lambda r: len(r[3])):
        full_a, full_b = ([i for i, r in enumerate(some) if r[c]] for c in (3, 5))
        of_a = dict(zip(full_a, a.encode([some[i][3] for i in full_a])))
        of_b = dict(zip(full_b, b.encode([some[i][5] for i in full_b])))
        for i, (row_id, doc_id, seq, a_text, a_byte, b_text, b_byte) in enumerate(some):
            x, y = of_a.get(i, NO_TOKENS.a_ids), of_b.get(i, NO_TOKENS.b_ids)
            ok = bytes(_taken(a.bytes_of, x)[0]) == a_text.encode()
            ok = ok and bytes(_taken(b.bytes_of, y)[0]) == ((" " + b_text).encode() if b_text else b"")
            x, y = (x, y) if ok else (NO_TOKENS.a_ids, NO_TOKENS.b_ids)
            tokens = Tokens(x, a_byte + np.cumsum(a.sizes[x]), y, b_byte + np.cumsum(b.sizes[y]))
            part, closed = split(tokens, seq == 0)
            yield _open_row(row_id, doc_id, seq, ok, part)
            yield from _closed_rows(row_id, closed, len(b.raw))


def _composed(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Fold the neighbours of one parent (row_id, up; by seq) into one fragment; the groups they close are rows of their own."""
    key, acc = None, None
    for row_id, up, *parts in _rows(batches):
        kinds = [np.int32, np.int64] * 4
        lists = [np.array(v, t) for v, t in zip(parts[1:], kinds)]
        one = Fragment(Tokens(*lists[:4]), Tokens(*lists[4:]), parts[0])
        if (row_id, up) != key:
            if key is not None:
                yield _open_row(key[0], None, key[1], True, acc)
            key, acc = (row_id, up), one
            continue
        acc, closed = compose(acc, one)
        yield from _closed_rows(row_id, closed, span)
    if key is not None:
        yield _open_row(key[0], None, key[1], True, acc)


# ---------------------------------------------------------------- the operator


class Alignment(NamedTuple):
    """What an alignment gives, stored.

    texts: row_id and doc_id of every row of the input, n_a, n_b, n_groups and groups_sha256, the digest of its groups as
        text; these are null for a text that was cut
    sections: row_id, at, a_ids, b_ids, a_sizes, b_sizes - runs of whole groups by ascending `at`; the groups hold a_sizes
        and b_sizes of the ids
    links: row_id, pair, times - how often a text that was not cut holds a pair of ids linked
    cut_links: the same of the others, where a pair may have several rows of one text
    counted: pair, n - texts that were not cut by linked pair, added up over parts of the input
    span: a pair is the A id times span and the B id
    """

    texts: DataFrame
    sections: DataFrame
    links: DataFrame
    cut_links: DataFrame
    counted: DataFrame
    span: int


def _kept(df: DataFrame, name: str) -> DataFrame:
    """stored(), in less space."""
    path = scratch.new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cut_texts(texts: DataFrame, a_path: str, b_path: str, span: int, size: int, fan_in: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, sections, links) of long texts: cut, spread, aligned by range, and composed level by level."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row_id, doc_id, text in _rows(batches):
            own = ranges(text, size)
            columns = [[row_id] * len(own), [doc_id] * len(own), list(range(len(own))), *map(list, zip(*own))]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _aligned_ranges(batches, *vocabularies(a_path, b_path))

    names = ["row_id", "doc_id", "seq", "a_text", "a_byte", "b_text", "b_byte"]
    cuts = texts.mapInArrow(cut, "row_id long, doc_id long, seq long, a_text string, a_byte long, b_text string, b_byte long")
    parts = _kept(cuts.repartition("row_id", "seq").mapInArrow(align, _DDL), "fragments")
    heads = parts.where("kind = 'open'")
    # A text that is not given back has no tokens.
    unsound = stored(heads.where("NOT ok").select("row_id").distinct(), "unsound")
    sound = lambda df: without(df, unsound, {"row_id": df["row_id"]})
    closed = parts
    last = heads.agg(F.max("seq")).first()[0] or 0
    level = sound(heads)
    while last:
        asked = level.select("row_id", F.expr(f"seq div {fan_in}").alias("up"), "seq", "cut", *_OPEN).repartition("row_id", "up")
        asked = asked.sortWithinPartitions("row_id", "up", "seq").drop("seq")
        made = _kept(asked.mapInArrow(lambda batches: _composed(batches, span), _DDL), "composed")
        closed = closed.unionByName(made)
        level, last = made.where("kind = 'open'"), last // fan_in
    sections = sound(closed.where("kind = 'section'").select("row_id", *_SECTION))
    links = sound(closed.where("kind = 'links'").select("row_id", "links")).select("row_id", F.inline("links"))
    return heads.where("seq = 0").select(*_TEXT), sections, links


_TEXT = ["row_id", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]


def align(docs: DataFrame, a_path: str, b_path: str, size: int = RANGE, fan_in: int = FAN_IN) -> Alignment:
    """Align docs(doc_id, text): a byte-level BPE file over a space and the text, a piece model over the text.

    Null and empty texts, and those that the tokens do not give back byte by
    byte, have no section or an empty one; repeated rows are texts of their own,
    rows without doc_id too; an empty table gives empty ones; extra columns are
    ignored.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, counted = vocabularies(a_path, b_path), PairCounts()
        for some in _slices(_rows(batches), lambda r: len(r[2] or "")):
            yield from _whole_texts(some, *loaded, counted)
        yield from counted.told()

    ship_code(docs.sparkSession)
    span = len(vocabularies(a_path, b_path)[1].raw)
    # Ids of rows as they are read, even for short texts and odd for long ones, so that the two reads need not agree.
    place = F.monotonically_increasing_id() * 2
    rows = docs.select(place.alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    is_long = F.coalesce(F.length("text") > size, F.lit(False))
    made = _kept(rows.where(~is_long).mapInArrow(whole, _DDL), "aligned")
    longer = rows.where(is_long).withColumn("row_id", F.col("row_id") + 1)
    cut_texts, cut_sections, cut_links = _cut_texts(longer, a_path, b_path, span, size, fan_in)
    counted = made.where("kind = 'counts'").select(F.inline("links"))
    return Alignment(
        made.where("kind = 'text'").select(*_TEXT).unionByName(cut_texts),
        made.where("kind = 'section'").select("row_id", *_SECTION).unionByName(cut_sections),
        made.where("kind = 'links'").select("row_id", F.inline("links")),
        cut_links,
        counted.select("pair", F.col("times").cast("long").alias("n")),
        span,
    )


# ---------------------------------------------------------------- counts and report


def pair_counts(made: Alignment) -> DataFrame:
    """Stored (pair, n, best): the texts that hold a pair of ids linked, and whether no pair of its A id has more.

    Texts that were not cut are counted within the tasks that align them; the others' pairs are made distinct here.
    """
    held = made.counted.unionByName(made.cut_links.select("row_id", "pair").distinct().select("pair", F.lit(1).cast("long").alias("n")))
    counts = stored(held.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    of_a = F.expr(f"pair div {made.span}")
    # As many rows as the A vocabulary has, at most.
    best = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))
    judged = counts.withColumn("a", of_a).join(F.broadcast(best), "a")
    return stored(judged.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def with_counts(links: DataFrame, counts: DataFrame) -> DataFrame:
    """links(pair, ...) with the stored counts' n and best.

    Beyond the broadcast bound only the commonest pairs are broadcast, as many as
    the bound allows; the others, each of bounded weight, meet their links by shuffle.
    """
    size, bound = counts.count(), scratch.BROADCAST_ROWS
    if size <= bound:
        return links.join(F.broadcast(counts), "pair")
    share = min(1.0, max(0.0, 1 - bound / 2 / size))
    least = counts.agg(F.percentile_approx("n", share, 10_000)).first()[0]
    while counts.where(F.col("n") > least).count() > bound:
        least *= 2
    hot, cold = counts.where(F.col("n") > least), counts.where(F.col("n") <= least)
    met = links.join(F.broadcast(hot), "pair", "left")
    rest = met.where("n IS NULL").select(*links.columns).join(cold, "pair")
    return met.where("n IS NOT NULL").unionByName(rest)


def groups_text(a_ids: list[int], b_ids: list[int], a_sizes: list[int], b_sizes: list[int]) -> str:
    """`a1,a2|b1;a3|b2,b3` of a section."""
    a, b, x, y, out = list(map(str, a_ids)), list(map(str, b_ids)), 0, 0, []
    for m, n in zip(a_sizes, b_sizes):
        out.append(f"{a[x]}|{b[y]}" if m == n == 1 else f"{','.join(a[x : x + m])}|{','.join(b[y : y + n])}")
        x, y = x + m, y + n
    return ";".join(out)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_id, tokens of each side, groups, digest of their text) of sections that come text by text, by `at`; one section in memory at a time."""
    key, sha, sums = None, hashlib.sha256(), [0, 0, 0]
    names = ["row_id", "m_a", "m_b", "m_groups", "long_sha256"]

    def told() -> pa.RecordBatch:
        numbers = [pa.array([n], pa.int64()) for n in (key, *sums)]
        return pa.RecordBatch.from_arrays([*numbers, pa.array([sha.hexdigest() if sums[0] else ""])], names=names)

    for row_id, a_ids, b_ids, a_sizes, b_sizes in _rows(batches):
        if row_id != key:
            if key is not None:
                yield told()
            key, sha, sums = row_id, hashlib.sha256(), [0, 0, 0]
        if a_ids:
            sha.update(((";" if sums[0] else "") + groups_text(a_ids, b_ids, a_sizes, b_sizes)).encode())
            sums = [s + len(x) for s, x in zip(sums, (a_ids, b_ids, a_sizes))]
    if key is not None:
        yield told()


def alignment_report(docs: DataFrame, a_path: str, b_path: str, size: int = RANGE, fan_in: int = FAN_IN) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; zeros and '' without tokens."""
    made = align(docs, a_path, b_path, size, fan_in)
    # The numbers and the digest of a text that was cut come from its sections, one at a time.
    cut = made.sections.where("row_id % 2 = 1").repartition("row_id").sortWithinPartitions("row_id", "at").drop("at")
    sums_of_cut = cut.mapInArrow(_digests, "row_id long, m_a long, m_b long, m_groups long, long_sha256 string")
    links = with_counts(made.links.unionByName(made.cut_links), pair_counts(made))
    best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0)))
    sums = links.groupBy("row_id").agg(best.alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    joined = made.texts.join(sums, "row_id", "left").join(sums_of_cut, "row_id", "left")
    for name in ("a", "b", "groups"):
        joined = joined.withColumn(f"n_{name}", F.coalesce(f"n_{name}", f"m_{name}"))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    n_links = F.col("n_a") + F.col("n_b") - F.col("n_groups")
    return joined.select(
        "doc_id",
        *[number(F.col(c)).alias(c) for c in ("n_a", "n_b", "n_groups")],
        number(n_links).alias("n_links"),
        *[number(F.col(c)).alias(c) for c in ("n_best", "count_sum")],
        F.coalesce("groups_sha256", "long_sha256", F.lit("")).alias("groups_sha256"),
    )
