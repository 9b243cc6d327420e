"""Byte-level BPE by prefix dynamic programming.

Of all tokens that end a byte prefix, exactly one is the last token of the prefix's
encoding: the one that forms a valid pair with the stored last token of the prefix it
leaves, a pair being valid if its bytes encode to that pair. One array of last tokens
therefore holds the encodings of all prefixes. Appending bytes goes on from its end;
an edit keeps everything before the edited place.

Nulls are empty texts, an empty text has no tokens. Repeated rows give repeated rows,
an empty table an empty result, and further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretoken import PieceTable, coded_chunks

PAIRS_KEPT = 2_000_000


class Vocabulary:
    """Ranks of a tiktoken file; a token's rank is its id and the time of its merge."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self._matches = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self._matches.add_word(token.decode("latin-1"), (len(token), rank))
        self._matches.make_automaton()
        self._valid: dict[tuple[int, int], bool] = {}
        self._halves: dict[int, tuple[int, int] | None] = {}
        lengths = np.zeros(max(self.tokens) + 1, np.int64)
        for rank, token in self.tokens.items():
            lengths[rank] = len(token)
        self._length, self._start = lengths, np.cumsum(lengths) - lengths
        self._bytes = np.frombuffer(b"".join(self.tokens.get(r, b"") for r in range(len(lengths))), np.uint8)

    def merged(self, data: bytes, below: int | None = None) -> list[int]:
        """Encoding by the definition: merge the pair of lowest rank until none is left
        (or none below a rank)."""
        end = len(self.ranks) if below is None else below
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, end), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= end:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for single bytes."""
        if token not in self._halves:
            data = self.tokens[token]
            self._halves[token] = tuple(self.merged(data, below=token)) if len(data) > 1 else None
        return self._halves[token]

    def valid(self, left: int, right: int) -> bool:
        """Whether the bytes of ``left`` and ``right`` encode to that pair.

        They do unless some merge across the seam comes before the merges that complete
        either side. The merges at the seam are taken back, latest first; of two equal
        ranks the one further left comes first.
        """
        known = self._valid.get((left, right))
        if known is None:
            if len(self._valid) >= PAIRS_KEPT:
                self._valid.clear()
            known = self._valid[left, right] = self._stays_apart(left, right)
        return known

    def _stays_apart(self, left: int, right: int) -> bool:
        ranks, tokens, never = self.ranks, self.tokens, len(self.tokens) + 1
        due = never  # merges across the seam of a lower rank come first
        while True:
            if ranks.get(tokens[left] + tokens[right], never) < due:
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                due, left = left, a[1]
            else:
                due, right = right + 1, b[0]

    def extend(self, data: bytes, last: list[int], end: int | None = None) -> None:
        """Fills ``last`` (last token of each prefix of ``data``, from one byte on) up to ``end``."""
        done = len(last)
        reach = max(0, done - self.longest + 1)
        valid, pairs = self.valid, self._valid
        # matches come by their end, longest first; the first that fits is the only one
        for at, (length, rank) in self._matches.iter(data[reach:end].decode("latin-1")):
            at += reach
            if at < len(last):
                continue
            begin = at + 1 - length
            if begin:
                before = last[begin - 1]
                fits = pairs.get((before, rank))
                if fits is None:
                    fits = valid(before, rank)
                if not fits:
                    continue
            last.append(rank)

    def encode(self, piece: bytes) -> list[int]:
        rank = self.ranks.get(piece)
        return [rank] if rank is not None else Prefixes(self, piece).tokens()

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        return [self.encode(p.encode("utf-8", "surrogatepass")) for p in pieces]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids one after another, and the number of bytes of each id."""
        from .pretoken import _ranges

        sizes = self._length[ids]
        return self._bytes[_ranges(self._start[ids], sizes)], sizes


class Prefixes:
    """A piece with the last token of every prefix; grows and changes in place."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self._vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self._vocabulary.extend(self.data, self.last)

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Puts ``new`` in place of data[start:stop]; prefixes up to ``start`` stay as they are.

        A last token depends on as many bytes and last tokens before it as the longest token
        has bytes. Once that many behind the edit are what they were, so are all that follow.
        """
        behind, reach = self.last[stop:], self._vocabulary.longest
        self.data = self.data[:start] + new + self.data[stop:]
        del self.last[start:]
        edited, size = start + len(new), len(self.data)
        end = edited
        while end < size:
            end = min(size, end + 2 * reach)
            self._vocabulary.extend(self.data, self.last, end)
            if self.last[-reach:] == behind[max(0, end - edited - reach) : end - edited] and end - edited >= reach:
                self.last += behind[end - edited :]
                return
        self._vocabulary.extend(self.data, self.last)

    def tokens(self, stop: int | None = None) -> list[int]:
        """Encoding of the first ``stop`` bytes (of all, without it)."""
        at, out = len(self.data) if stop is None else stop, []
        while at:
            out.append(self.last[at - 1])
            at -= len(self._vocabulary.tokens[out[-1]])
        return out[::-1]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def _table(path: str) -> PieceTable:
    return PieceTable(vocabulary(path).encode_pieces)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): the ids of every text and the bytes they decode to.

    The rank file is read by each Python worker from ``path``, a place that every
    executor has (an installed package). Work is row by row, without a shuffle.
    """
    return _run(docs, path, id_col, text_col, [("ids", "array<int>"), ("decoded", "binary")])


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), hashed where the ids are made."""
    return _run(docs, path, id_col, text_col, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")])


def _run(docs: DataFrame, path: str, id_col: str, text_col: str, wanted: list[tuple[str, str]]) -> DataFrame:
    full = wanted[0][0] == "ids"

    def work(batches):
        words, table = vocabulary(path), _table(path)
        for batch in batches:
            rows = []
            for _, ids, ends in coded_chunks(batch.column(1), table):
                data, sizes = words.decode(ids)
                places = np.concatenate([[0], np.cumsum(sizes)])[ends]
                for a, b, x, y in zip(ends, ends[1:], places, places[1:]):
                    mine, back = ids[a:b], data[x:y].tobytes()
                    if full:
                        rows.append((mine.astype(np.int32), back))
                    else:
                        rows.append((int(b - a), hashlib.sha256(mine.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(back).hexdigest()))
            kinds = [pa.list_(pa.int32()), pa.binary()] if full else [pa.int64(), pa.string(), pa.string()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_col, *[w[0] for w in wanted]])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {kind}", *[f"{n} {t}" for n, t in wanted]])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(work, schema)
