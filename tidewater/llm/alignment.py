"""Alignment of two tokenizers, with corpus-wide counts of the token pairs they link.

Byte offsets at which tokens of both sides end cut a text into groups; all tokens of one side
are linked to all of the other in their group. How many documents hold a pair linked is
counted by external spill counting:

1. Each task turns its documents into records of (pair, document, times). Full buffers are
   spilled as runs: written, zstd-packed blocks, radix-partitioned by the A token and sorted by
   A token, then B token (side-major).
2. A run's pairs with the number of its documents are merged k-way by a heap, ``FAN_IN`` runs
   at a time and then those results. As all pairs of an A token come together, its highest
   count is known as soon as the merge has passed it.
3. The counts stream back to the runs, whose records become sums per document.

A pair sends one entry per run, however many documents hold it, so no token pair is hot. A
document's records stay in one run.

Texts that are null or empty or that the tokenizers do not give back byte for byte have no
tokens: zeros and an empty digest. Rows with equal or null ids are documents of their own. An
empty table gives an empty result. The piece model must be a BPE model with the identity
normalizer, as ``piece_bpe_32k.model`` is: its pieces hold U+2581 at their beginning only, so
words can be encoded apart.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blobs import pack, pack_sorted, runs, slices, unpack, unpack_sorted
from .packing import _encoder
from .pretoken import PieceTable, _ranges, coded_chunks, pretoken_starts
from .scratch import written
from .textbytes import CHUNK_BYTES, chunks

RADIX = 64
FAN_IN = 256
FLUSH = 2_000_000  # records of a run
SMALL = 4096  # links of a group that are listed one by one
_BITS = 18  # of a token id within a pair
_SPACE = "▁"


class Side:
    """Ids and byte lengths of one tokenizer's tokens."""

    def __init__(self, table: PieceTable, find, tokens: list[bytes]):
        if len(tokens) >= 1 << _BITS:
            raise ValueError("the vocabulary is too large")
        self.table, self.find = table, find
        self.widths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.widths) - self.widths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[_ranges(self.starts[ids], self.widths[ids])]


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_side(path: str) -> Side:
    from tokenizers import Tokenizer

    tokenizer, byte = Tokenizer.from_file(path), _byte_of()
    names = [tokenizer.id_to_token(k) or "" for k in range(tokenizer.get_vocab_size())]
    return Side(PieceTable(_encoder(path)), pretoken_starts, [bytes(byte.get(c, 0x3F) for c in n) for n in names])


def _unit_starts(points: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Where words with the spaces before them begin: no piece reaches from a word into a space behind it."""
    space = (points == 0x20) | (points == ord(_SPACE))
    start = space.copy()
    start[1:] &= ~space[:-1]
    start[docs[:-1][docs[:-1] < len(points)]] = True
    return np.flatnonzero(start)


@lru_cache(maxsize=2)
def piece_side(path: str) -> Side:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    if any(_SPACE in n.lstrip(_SPACE) for n in names):
        raise ValueError("a piece has a space behind other characters")
    lone = model.piece_to_id(_SPACE)

    def encode(units: list[str]) -> list:
        # each begins with a space, which the model adds itself
        coded = model.encode([u[1:] for u in units], num_threads=1)
        return [ids if len(u) > 1 else [lone] for u, ids in zip(units, coded)]

    tokens = [bytes([int(n[3:5], 16)]) if model.is_byte(k) else n.replace(_SPACE, " ").encode() for k, n in enumerate(names)]
    return Side(PieceTable(encode), _unit_starts, tokens)


def _per_doc(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


class Aligned:
    """The groups of a chunk of documents: token ids and offsets of both sides, group of each token."""

    def __init__(self, a: Side, b: Side, data, offsets, ids_a, at_a, ids_b, at_b):
        docs = len(offsets) - 1
        good = np.ones(docs, dtype=bool)
        for side, ids, at in ((a, ids_a, at_a), (b, ids_b, at_b)):
            good &= _per_doc(side.widths[ids], at) == np.diff(offsets)
        if not good.all():
            data, offsets = _only(data, offsets, good)
            ids_a, at_a = _only(ids_a, at_a, good)
            ids_b, at_b = _only(ids_b, at_b, good)
        same = np.concatenate([[0], np.cumsum((a.joined(ids_a) == data) & (b.joined(ids_b) == data))])
        good = same[offsets[1:]] - same[offsets[:-1]] == np.diff(offsets)
        if not good.all():
            data, offsets = _only(data, offsets, good)
            ids_a, at_a = _only(ids_a, at_a, good)
            ids_b, at_b = _only(ids_b, at_b, good)
        self.docs, self.ids_a, self.at_a, self.ids_b, self.at_b = docs, ids_a, at_a, ids_b, at_b
        ends_a, ends_b = np.cumsum(a.widths[ids_a]), np.cumsum(b.widths[ids_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=len(common)), np.bincount(self.group_b, minlength=len(common))
        self.groups_at = np.searchsorted(common, offsets, side="right")  # of each document
        self.doc_of_group = np.repeat(np.arange(docs), np.diff(self.groups_at))

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, pair, times), distinct and sorted by document and pair."""
        links = self.size_a * self.size_b
        first_a, first_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        g = np.flatnonzero(links <= SMALL)
        of = np.repeat(g, links[g])
        place = np.arange(len(of)) - np.repeat(np.cumsum(links[g]) - links[g], links[g])
        left = self.ids_a[first_a[of] + place // self.size_b[of]].astype(np.int64)
        right = self.ids_b[first_b[of] + place % self.size_b[of]].astype(np.int64)
        keys = [self.doc_of_group[of] << 2 * _BITS | left << _BITS | right]
        times = [np.ones(len(of), np.int64)]
        for k in np.flatnonzero(links > SMALL).tolist():
            x, nx = np.unique(self.ids_a[first_a[k] : first_a[k] + self.size_a[k]].astype(np.int64), return_counts=True)
            y, ny = np.unique(self.ids_b[first_b[k] : first_b[k] + self.size_b[k]].astype(np.int64), return_counts=True)
            keys.append((self.doc_of_group[k] << 2 * _BITS | x[:, None] << _BITS | y[None, :]).reshape(-1))
            times.append((nx[:, None] * ny[None, :]).reshape(-1))
        key, n = np.concatenate(keys), np.concatenate(times)
        order = np.argsort(key)
        key, n = key[order], n[order]
        at = runs(key)
        return key[at] >> 2 * _BITS, key[at] & ((1 << 2 * _BITS) - 1), np.add.reduceat(n, at) if len(at) else n

    def digests(self, digits: np.ndarray, width: np.ndarray) -> list[str]:
        """SHA-256 of `a1,a2|b1;a3|b2,b3` for each document; empty without tokens."""
        before_b, before_a = np.cumsum(self.size_b) - self.size_b, np.cumsum(self.size_a)
        place_a = np.arange(len(self.ids_a)) + before_b[self.group_a]
        place_b = np.arange(len(self.ids_b)) + before_a[self.group_b]
        ids = np.empty(len(place_a) + len(place_b), np.int64)
        ids[place_a], ids[place_b] = self.ids_a, self.ids_b
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[place_a[before_a - 1]] = ord("|")
        mark[place_b[np.cumsum(self.size_b) - 1]] = ord(";")
        cells = np.zeros((len(ids), digits.shape[1] + 1), np.uint8)
        cells[:, :-1] = digits[ids]
        cells[np.arange(len(ids)), width[ids]] = mark
        text = cells[np.arange(cells.shape[1]) <= width[ids][:, None]].tobytes()
        ends = np.concatenate([[0], np.cumsum(width[ids] + 1)])[self.at_a + self.at_b].tolist()
        return [hashlib.sha256(text[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(ends, ends[1:])]


def _only(values: np.ndarray, offsets: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets without those of some documents, which stay as empty ones."""
    sizes = np.diff(offsets)
    return values[np.repeat(good, sizes)], np.concatenate([[0], np.cumsum(np.where(good, sizes, 0))])


def _decimal(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of the numbers below ``size``, from the left, and how many."""
    text = [str(k).encode() for k in range(size)]
    most = max(map(len, text))
    return np.frombuffer(b"".join(t.ljust(most, b"\0") for t in text), np.uint8).reshape(size, most), np.fromiter(map(len, text), np.int64, size)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def spilled(
    docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", most: int = FLUSH, chunk: int = CHUNK_BYTES
) -> DataFrame:
    """The written runs. A run has one row with its documents and records (``radix`` null),
    and one for each radix with its pairs in order and the number of documents of each."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"run long, radix int, pairs binary, held binary, ids array<{kind}>, digests array<string>, "
        + ", ".join(f"{c} array<long>" for c in _COUNTS)
        + ", sizes binary, ranks binary, times binary"
    )

    def work(batches):
        from pyspark import TaskContext

        a, b = byte_side(bytes_path), piece_side(pieces_path)
        digits, width = _decimal(max(len(a.widths), len(b.widths)))
        run = TaskContext.get().partitionId() << 32
        ids, digests, counts, records, waiting, docs_held = [], [], [], [], 0, 0

        def flush():
            doc, pair, times = (np.concatenate(x) for x in zip(*records))
            code = (pair >> _BITS) % RADIX << 2 * _BITS | pair
            distinct, rank, held = np.unique(code, return_inverse=True, return_counts=True)
            # within a document in rank order, so that differences are small
            order = np.lexsort((rank, doc))
            rank, times = rank[order].astype(np.uint32), times[order]
            sizes = np.bincount(doc, minlength=docs_held)
            column = pa.chunked_array(ids).combine_chunks()
            lists = [column, pa.array([x for d in digests for x in d], pa.string()), *[pa.array(np.concatenate(c)) for c in zip(*counts)]]
            one = [pa.ListArray.from_arrays(pa.array([0, docs_held], pa.int32()), c) for c in lists]
            blobs = [pack(sizes.astype(np.uint32)), pack(np.diff(rank, prepend=np.uint32(0))), pack(times)]
            whole = [pa.array([run]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()), *one, *[pa.array([x], pa.binary()) for x in blobs]]
            yield pa.RecordBatch.from_arrays(whole, names=names)
            rows = [(r, pack_sorted(distinct[x:y]), pack(held[x:y].astype(np.uint32))) for r, x, y in slices(distinct >> 2 * _BITS)]
            if rows:
                n = len(rows)
                radix, pairs, held = zip(*rows)
                empty = [pa.nulls(n, c.type) for c in whole[4:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([run] * n), pa.array(radix, pa.int32()), pa.array(pairs, pa.binary()), pa.array(held, pa.binary()), *empty], names=names
                )

        names = ["run", "radix", "pairs", "held", "ids", "digests", *_COUNTS, "sizes", "ranks", "times"]
        for batch in batches:
            text = batch.column(1).fill_null("")
            blank = pc.or_(pc.equal(text, ""), pc.match_substring(text, _SPACE))  # the second would come back as a space
            text = pc.if_else(blank, "", pc.binary_join_element_wise(" ", text, ""))
            each = zip(chunks(text, chunk), coded_chunks(text, a.table, a.find, chunk), coded_chunks(text, b.table, b.find, chunk))
            for (at, stop, data, offsets), (_, ids_a, at_a), (_, ids_b, at_b) in each:
                found = Aligned(a, b, data, offsets, ids_a, at_a, ids_b, at_b)
                doc, pair, times = found.records()
                ids.append(batch.column(0).slice(at, stop - at))
                digests.append(found.digests(digits, width))
                links = np.concatenate([[0], np.cumsum(found.size_a * found.size_b)])[found.groups_at]
                counts.append([np.diff(x) for x in (found.at_a, found.at_b, found.groups_at, links)])
                records.append((doc + docs_held, pair, times))
                docs_held += stop - at
                waiting += len(doc)
                if waiting >= most:
                    yield from flush()
                    run += 1
                    ids, digests, counts, records, waiting, docs_held = [], [], [], [], 0, 0
        if docs_held:
            yield from flush()

    return written(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(work, schema), "alignment-runs")


def merged(blocks: list[tuple[np.ndarray, np.ndarray]]):
    """(pairs, counts) of one A token after another, from sorted blocks, by a heap of their next pairs."""
    at = [0] * len(blocks)
    heap = [(int(pairs[0]), k) for k, (pairs, _) in enumerate(blocks) if len(pairs)]
    heapq.heapify(heap)
    while heap:
        limit = ((heap[0][0] >> _BITS) + 1) << _BITS
        parts = []
        while heap and heap[0][0] < limit:
            k = heap[0][1]
            pairs, n = blocks[k]
            end = at[k] + int(np.searchsorted(pairs[at[k] :], limit))
            parts.append((pairs[at[k] : end], n[at[k] : end]))
            at[k] = end
            if end < len(pairs):
                heapq.heapreplace(heap, (int(pairs[end]), k))
            else:
                heapq.heappop(heap)
        if len(parts) == 1:
            yield parts[0]
            continue
        pairs, n = np.concatenate([p for p, _ in parts]), np.concatenate([n for _, n in parts])
        order = np.argsort(pairs, kind="stable")
        start = runs(pairs[order])
        yield pairs[order][start], np.add.reduceat(n[order], start)


def _blocks(table) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(unpack_sorted(p, np.int64), unpack(n, np.int64)) for p, n in zip(table["pairs"].to_pylist(), table["held"].to_pylist())]


def _first_merge(key, table):
    blocks = [(unpack_sorted(p, np.int64), unpack(n, np.uint32).astype(np.int64)) for p, n in zip(table["pairs"].to_pylist(), table["held"].to_pylist())]
    found = list(merged(blocks))
    pairs, held = np.concatenate([p for p, _ in found]), np.concatenate([n for _, n in found])
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([pack_sorted(pairs)], pa.binary()), pa.array([pack(held)], pa.binary())], names=["radix", "pairs", "held"])


def _last_merge(key, table):
    """Counts over all documents, and whether each is its A token's highest."""
    found = [(p, n, n == n.max()) for p, n in merged(_blocks(table))]
    pairs, held, best = (np.concatenate(x) for x in zip(*found))
    blobs = [pa.array([x], pa.binary()) for x in (pack_sorted(pairs), pack(held), pack(np.packbits(best)))]
    return pa.table([pa.array([key[0].as_py()], pa.int32()), *blobs], names=["radix", "pairs", "held", "best"])


def _answered(key, heads, totals):
    """The corpus-wide counts of a run's pairs, in the run's order."""
    if not len(heads):
        return pa.table([pa.array([], k) for k in (pa.int64(), pa.int32(), pa.binary(), pa.binary())], names=["run", "radix", "held", "best"])
    row = totals.to_pylist()[0]
    every, held = unpack_sorted(row["pairs"], np.int64), unpack(row["held"], np.int64)
    best = np.unpackbits(unpack(row["best"], np.uint8), count=len(every))
    counts, bits = [], []
    for p in heads["pairs"].to_pylist():
        place = np.searchsorted(every, unpack_sorted(p, np.int64))
        counts.append(pack(held[place]))
        bits.append(pack(best[place]))
    return pa.table([heads["run"], heads["radix"], pa.array(counts, pa.binary()), pa.array(bits, pa.binary())], names=["run", "radix", "held", "best"])


def _summed(key, run, answers):
    """Documents of a run with the sums over their links."""
    answers = answers.sort_by("radix")
    held = np.concatenate([np.empty(0, np.int64), *[unpack(b, np.int64) for b in answers["held"].to_pylist()]])
    best = np.concatenate([np.empty(0, np.uint8), *[unpack(b, np.uint8) for b in answers["best"].to_pylist()]])
    row = run.select(["sizes", "ranks", "times"]).to_pylist()[0]
    sizes, times = unpack(row["sizes"], np.uint32).astype(np.int64), unpack(row["times"], np.int64)
    rank = np.cumsum(unpack(row["ranks"], np.uint32), dtype=np.uint32)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    plain = [pc.list_flatten(run[c]) for c in ("ids", "digests", *_COUNTS)]
    sums = [pa.array(_per_doc(x, offsets)) for x in (times * best[rank], times * held[rank])]
    return pa.table([*plain, *sums], names=["id", "groups_sha256", *_COUNTS, "n_best", "count_sum"])


def aligned(
    docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", most: int = FLUSH, chunk: int = CHUNK_BYTES
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.
    A run is spilled at ``most`` records; texts are handled ``chunk`` bytes at a time."""
    spill = spilled(docs, bytes_path, pieces_path, id_col, text_col, most, chunk)
    whole = spill.where(F.col("radix").isNull())
    groups = max(1, -(-whole.select("run").count() // FAN_IN))
    heads = spill.where(F.col("radix").isNotNull()).select("run", "radix", F.pmod(F.xxhash64("run"), F.lit(groups)).cast("int").alias("part"), "pairs", "held")
    merge = heads.groupBy("radix", "part").applyInArrow(_first_merge, "radix int, pairs binary, held binary")
    totals = merge.groupBy("radix").applyInArrow(_last_merge, "radix int, pairs binary, held binary, best binary")
    totals = written(totals, "alignment-totals").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    answers = heads.drop("held").groupBy("radix", "part").cogroup(totals.groupBy("radix", "part")).applyInArrow(_answered, "run long, radix int, held binary, best binary")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, groups_sha256 string, " + ", ".join(f"{c} long" for c in [*_COUNTS, "n_best", "count_sum"])
    rows = whole.drop("radix", "pairs", "held").groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_summed, schema)
    return rows.select(F.col("id").alias(id_col), *_COUNTS, "n_best", "count_sum", "groups_sha256")
