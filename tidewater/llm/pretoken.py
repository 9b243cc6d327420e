"""Pre-tokens of the public byte-level BPE vocabularies, found for many texts at once.

The rules are those of ``public_tokenizers.PATTERN``: contractions, runs of letters,
digits or other characters with one leading space, and white space. The test suite
holds the result against the pattern itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np

from .textbytes import hash_runs

_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
# The characters with the Unicode property White_Space.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_classes: np.ndarray | None = None
_CUT = re.compile(rb"[A-Za-z0-9](?= [A-Za-z0-9])")


def classes() -> np.ndarray:
    """Class of every code point, made once in each Python worker."""
    global _classes
    if _classes is None:
        import regex

        table = np.full(0x110000, _OTHER, dtype=np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, name in ((_LETTER, "L"), (_NUMBER, "N")):
            for run in regex.finditer(rf"\p{{{name}}}+", every):
                a, b = ord(every[run.start()]), ord(every[run.end() - 1])
                table[a : b + 1] = kind
        table[0xD800:0xE000] = _OTHER
        table[_WHITE] = _SPACE
        _classes = table
    return _classes


def safe_cuts(data: bytes, limit: int) -> list[int]:
    """Places, about ``limit`` bytes apart, where a pre-token surely begins: a space between
    ASCII letters or digits. A text without such places stays whole."""
    cuts, at = [0], 0
    while len(data) - at > 2 * limit and (found := _CUT.search(data, at + limit)):
        at = found.end()
        cuts.append(at)
    return [*cuts, len(data)]


def code_points(data) -> np.ndarray:
    return np.frombuffer(bytes(data).decode("utf-8").encode("utf-32-le"), dtype=np.uint32)


def point_offsets(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte offsets as code point offsets."""
    leads = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
    return leads[offsets]


def pretoken_starts(points: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Places of the code points that begin a pre-token; ``docs``: where documents begin, and the end."""
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    kind = classes()[points]
    begins = np.zeros(n, dtype=bool)
    begins[docs[:-1][docs[:-1] < n]] = True
    run = begins.copy()
    run[1:] |= kind[1:] != kind[:-1]
    blank = kind == _SPACE
    start = run.copy()
    # the last white space before other characters stands alone or, a space, joins them
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & ~begins[1:])
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    # an apostrophe that begins a pre-token may form a contraction with the letters behind it
    quote = np.flatnonzero((points[:-1] == 0x27) & start[:-1] & (kind[1:] == _LETTER) & ~begins[1:])
    if len(quote):
        one = points[quote + 1]
        behind = np.minimum(quote + 2, n - 1)
        two = np.where((quote + 2 < n) & ~begins[behind], points[behind], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        for at, width in ((quote[short], 2), (quote[long], 3)):
            start[at + 1] = False
            rest = at + width
            rest = rest[rest < n]
            start[rest[(kind[rest] == _LETTER) & ~begins[rest]]] = True
    return np.flatnonzero(start)


class PieceTable:
    """Numbers computed once for each distinct piece of text and kept while memory allows.

    ``encode`` gets distinct pieces and returns one sequence of numbers for each. Pieces are
    known by 64-bit hashes; a table holds at most ``most`` of them and is then begun anew.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], most: int = 600_000, bits: int = 19):
        self._encode, self._most, self._shift = encode, most, np.uint64(64 - bits)
        self._size = 1 << bits
        self._clear()

    def _clear(self) -> None:
        self._known: dict[int, int] = {}
        self._start, self._length, self._used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), 0
        self._flat = np.zeros(4096, np.uint32)
        self._slot_hash, self._slot_entry = np.zeros(self._size, np.uint64), np.full(self._size, -1, np.int64)

    def _add(self, hashes: list[int], pieces: list[str]) -> None:
        first = len(self._known)
        coded = self._encode(pieces)
        need = first + len(pieces)
        if need > len(self._start):
            grow = max(need, 2 * len(self._start)) - len(self._start)
            self._start, self._length = (np.concatenate([a, np.zeros(grow, np.int64)]) for a in (self._start, self._length))
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        values = np.fromiter((x for c in coded for x in c), np.uint32, int(lengths.sum()))
        if self._used + len(values) > len(self._flat):
            grow = max(self._used + len(values), 2 * len(self._flat)) - len(self._flat)
            self._flat = np.concatenate([self._flat, np.zeros(grow, np.uint32)])
        self._start[first:need] = self._used + np.cumsum(lengths) - lengths
        self._length[first:need] = lengths
        self._flat[self._used : self._used + len(values)] = values
        self._used += len(values)
        self._known.update(zip(hashes, range(first, need)))

    def numbers(self, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all pieces in order, and how many each piece has."""
        lengths = np.diff(starts, append=len(points))
        hashes = hash_runs(points, starts, lengths)
        if len(self._known) > self._most:
            self._clear()
        slots = (hashes >> self._shift).astype(np.int64)
        entries = self._slot_entry[slots]
        miss = np.flatnonzero((self._slot_hash[slots] != hashes) | (entries < 0))
        if len(miss):
            distinct, where, back = np.unique(hashes[miss], return_index=True, return_inverse=True)
            keys = distinct.tolist()
            get = self._known.get
            found = np.fromiter((get(k, -1) for k in keys), np.int64, len(keys))
            new = np.flatnonzero(found < 0)
            if len(new):
                at = miss[where[new]]
                joined = points[_ranges(starts[at], lengths[at])].tobytes().decode("utf-32-le", "surrogatepass")
                cut = np.concatenate([[0], np.cumsum(lengths[at])]).tolist()
                self._add([keys[k] for k in new.tolist()], [joined[a:b] for a, b in zip(cut, cut[1:])])
                found[new] = np.arange(len(self._known) - len(new), len(self._known))
            entries[miss] = found[back]
            self._slot_hash[slots[miss]], self._slot_entry[slots[miss]] = hashes[miss], entries[miss]
        sizes = self._length[entries]
        return self._flat[_ranges(self._start[entries], sizes)], sizes


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start .. start + length - 1 of each range, one after another."""
    total = int(lengths.sum())
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(total)


def coded_chunks(column, table: PieceTable, find=pretoken_starts, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, numbers, n + 1 offsets of the rows' numbers) for groups of rows."""
    from .textbytes import chunks

    for row, _, data, offsets in chunks(column, limit):
        if len(offsets) == 2 and len(data) > 2 * limit:  # one very long text, in parts
            whole = data.tobytes()
            cuts = safe_cuts(whole, limit)
            parts = []
            for a, b in zip(cuts, cuts[1:]):
                points = code_points(whole[a:b])
                parts.append(table.numbers(points, find(points, np.array([0, len(points)])))[0])
            numbers = np.concatenate(parts)
            yield row, numbers, np.array([0, len(numbers)])
            continue
        points = code_points(data)
        docs = point_offsets(data, offsets)
        starts = find(points, docs)
        numbers, sizes = table.numbers(points, starts)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        yield row, numbers, ends[np.searchsorted(starts, docs)]
