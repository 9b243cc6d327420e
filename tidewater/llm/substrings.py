"""Removal of passages that repeat an earlier document, by fixed-block anchors.

Every document is cut into reference blocks of half a window that don't overlap; they
are indexed, and every rolling span of that length in every document is a probe. A
passage of at least one window that two documents share holds a whole reference block
of either, so the other's probe meets it. Around such anchors the hits are extended:
all windows that hold an anchor are compared by 64-bit hash, each with the smallest id
of the documents that have it, and neighbouring windows join to maximal repeats. A word
is removed if a window over it also begins in a document with a smaller id.

Documents are dealt into groups by hash. A group sends each distinct span once, as
sorted 32-bit prints within a bucket, however often it occurs in the group; a bucket
answers with the prints that at least two documents have, and in the second step with
the smallest id of each window. A span that occurs in a third of all documents thus
costs one entry a group. No pair of documents is ever made. Prints that meet by chance
only bring windows to the second step in vain.

Set ``spark.sql.shuffle.partitions`` so that a partition's share of the texts fits a
task, as for any shuffle; there are twice as many groups and buckets.

Null texts have no words. Rows without an id are returned whole and remove nothing.
Rows that share an id don't remove from each other. An empty table gives an empty
result; all columns of the input come back in ``row``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blobs import lengths, pack, pack_sorted, runs, slices, unpack, unpack_sorted
from .scratch import shuffle_partitions
from .textbytes import chunks, string_buffers, window_hashes, words_of

WINDOW = 50
_U = np.uint64


class _Group:
    """Words of all texts of a group of documents."""

    def __init__(self, ids, texts):
        self.ids = np.array(ids.fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False)) if len(ids) else np.empty(0, np.int64)
        known = ids.is_valid().to_numpy(zero_copy_only=False) if len(ids) else np.empty(0, bool)
        hashes, counts = [np.empty(0, _U)], [np.empty(0, np.int64)]
        for _, _, data, offsets in chunks(texts):
            words = words_of(data, offsets)
            hashes.append(words.hashes())
            counts.append(words.counts)
        self.hashes, self.counts = np.concatenate(hashes), np.concatenate(counts)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self._known = known

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first word and document of every window of k words of documents with an id."""
        hashes, at = window_hashes(self.hashes, self.first, k)
        doc = np.searchsorted(self.first, at, side="right") - 1
        if not self._known.all():
            keep = self._known[doc]
            return hashes[keep], at[keep], doc[keep]
        return hashes, at, doc


def _codes(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 32-bit print of a span as one number."""
    return (((hashes >> _U(32)) % _U(buckets)) << _U(32)) | (hashes & _U(0xFFFFFFFF))


def _table(schema: str, **columns) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table([pa.array(columns[name], kinds[kind]) for name, kind in fields], names=[name for name, _ in fields])


_SPANS = "bucket int, grp int, prints binary, flags binary"
_ANSWER = "grp int, bucket int, prints binary"
_WINDOWS = "bucket int, grp int, hashes binary, owners binary, flags binary"
_OWNERS = "grp int, hashes binary, owners binary"


def _spans(half: int, buckets: int):
    def work(key, docs):
        group = _Group(docs["id"].combine_chunks(), docs["text"])
        hashes, at, doc = group.windows(half)
        codes = _codes(hashes, buckets)
        order = np.argsort(codes)
        codes, owner, block = codes[order], group.ids[doc[order]], ((at - group.first[doc]) % half == 0)[order]
        start = runs(codes)
        out = {"bucket": [], "grp": [], "prints": [], "flags": []}
        if len(start):
            many = np.minimum.reduceat(owner, start) != np.maximum.reduceat(owner, start)
            flags = many.astype(np.uint8) | (np.logical_or.reduceat(block, start).astype(np.uint8) << 1)
            codes = codes[start]
            for bucket, a, b in slices((codes >> _U(32)).astype(np.int64)):
                out["bucket"].append(bucket)
                out["grp"].append(key[0].as_py())
                out["prints"].append(pack_sorted(codes[a:b].astype(np.uint32)))
                out["flags"].append(pack(flags[a:b]))
        return _table(_SPANS, **out)

    return work


def _shared(key, blobs):
    """Prints that two documents have, one of them as a reference block; told to all groups that have them."""
    groups = blobs["grp"].to_pylist()
    prints = [unpack_sorted(b, np.uint32) for b in blobs["prints"].to_pylist()]
    flags = np.concatenate([unpack(b, np.uint8) for b in blobs["flags"].to_pylist()])
    who = np.repeat(np.arange(len(groups)), [len(p) for p in prints])
    every = np.concatenate(prints)
    order = np.argsort(every, kind="stable")
    start = runs(every[order])
    size = lengths(start, len(order))
    joined = np.bitwise_or.reduceat(flags[order], start)
    good = np.repeat(((size > 1) | (joined & 1 > 0)) & (joined & 2 > 0), size)
    chosen = np.sort(order[good])  # back in the order of groups, prints ascending
    out = {"grp": [], "bucket": [], "prints": []}
    for k, a, b in slices(who[chosen]):
        out["grp"].append(groups[k])
        out["bucket"].append(key[0].as_py())
        out["prints"].append(pack_sorted(every[chosen[a:b]]))
    return _table(_ANSWER, **out)


def _anchored(window: int, half: int, buckets: int):
    def work(key, docs, shared):
        out = {"bucket": [], "grp": [], "hashes": [], "owners": [], "flags": []}
        if len(docs) and len(shared):
            group = _Group(docs["id"].combine_chunks(), docs["text"])
            known = np.sort(np.concatenate([
                (_U(b) << _U(32)) | unpack_sorted(p, np.uint32).astype(_U) for b, p in zip(shared["bucket"].to_pylist(), shared["prints"].to_pylist())
            ]))
            hashes, at, _ = group.windows(half)
            codes = _codes(hashes, buckets)
            place = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            anchors = at[known[place] == codes]
            # windows that begin up to a half before an anchor hold it
            change = np.zeros(len(group.hashes) + 1, np.int64)
            np.add.at(change, np.maximum(anchors - (window - half), 0), 1)
            np.add.at(change, anchors + 1, -1)
            holds = np.cumsum(change) > 0
            hashes, at, doc = group.windows(window)
            keep = holds[at]
            hashes, owner = hashes[keep], group.ids[doc[keep]]
            bucket = ((hashes >> _U(40)) % _U(buckets)).astype(np.int64)
            order = np.lexsort((hashes, bucket))
            hashes, owner, bucket = hashes[order], owner[order], bucket[order]
            start = runs(hashes)
            if len(start):
                least, most = np.minimum.reduceat(owner, start), np.maximum.reduceat(owner, start)
                hashes, flags = hashes[start], (least != most).astype(np.uint8)
                for b, x, y in slices(bucket[start]):
                    out["bucket"].append(b)
                    out["grp"].append(key[0].as_py())
                    out["hashes"].append(pack_sorted(hashes[x:y]))
                    out["owners"].append(pack(least[x:y]))
                    out["flags"].append(pack(flags[x:y]))
        return _table(_WINDOWS, **out)

    return work


def _owners(key, blobs):
    """Smallest id of each window, told to the groups where some document has a larger one."""
    groups = blobs["grp"].to_pylist()
    hashes = [unpack_sorted(b, _U) for b in blobs["hashes"].to_pylist()]
    who = np.repeat(np.arange(len(groups)), [len(h) for h in hashes])
    every = np.concatenate(hashes)
    owner = np.concatenate([unpack(b, np.int64) for b in blobs["owners"].to_pylist()])
    many = np.concatenate([unpack(b, np.uint8) for b in blobs["flags"].to_pylist()])
    order = np.argsort(every, kind="stable")
    start = runs(every[order])
    least = np.empty(len(every), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owner[order], start), lengths(start, len(order)))
    chosen = np.flatnonzero((least < owner) | (many > 0))
    out = {"grp": [], "hashes": [], "owners": []}
    for k, a, b in slices(who[chosen]):
        some = chosen[a:b]
        out["grp"].append(groups[k])
        out["hashes"].append(pack_sorted(every[some]))
        out["owners"].append(pack(least[some]))
    return _table(_OWNERS, **out)


def _cleaned(window: int, layout: bool):
    def work(key, docs, owners):
        group = _Group(docs["id"].combine_chunks(), docs["text"])
        gone = np.zeros(len(group.hashes), dtype=bool)
        if len(owners) and len(docs):
            known = np.concatenate([unpack_sorted(b, _U) for b in owners["hashes"].to_pylist()])
            least = np.concatenate([unpack(b, np.int64) for b in owners["owners"].to_pylist()])
            order = np.argsort(known)
            known, least = known[order], least[order]
            hashes, at, doc = group.windows(window)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            late = at[(known[place] == hashes) & (least[place] < group.ids[doc])]
            change = np.zeros(len(gone) + 1, np.int64)
            change[late] += 1
            np.add.at(change, late + window, -1)
            gone = np.cumsum(change[:-1]) > 0
        spans, removed, kept = [], [], []
        data, offsets = string_buffers(docs["text"])
        raw = data.tobytes()
        for k, (a, b) in enumerate(zip(group.first[:-1], group.first[1:])):
            words = raw[offsets[k] : offsets[k + 1]].split()
            mine = gone[a:b]
            n = int(mine.sum())
            if n:
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
                spans.append([{"first": int(x), "last": int(y) - 1} for x, y in zip(edges[::2], edges[1::2])])
                words = [w for w, g in zip(words, mine.tolist()) if not g]
            else:
                spans.append([])
            removed.append(n)
            kept.append((raw[offsets[k] : offsets[k + 1]] if layout and not n else b" ".join(words)).decode("utf-8"))
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        return pa.table(
            [docs["row"], pa.array(group.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.string())],
            names=["row", "n_words", "n_removed", "removed", "kept"],
        )

    return work


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, layout: bool = False) -> DataFrame:
    """(row, n_words, n_removed, removed, kept): the input row, its counts of words, the
    removed passages as first and last word, and the words kept, joined by one space. With
    ``layout`` a text that loses nothing stays as it is (null becomes empty).

    The texts are shuffled once; the three steps over them read the same shuffle files.
    """
    half, buckets = window // 2, 2 * shuffle_partitions(docs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    group = F.pmod(F.xxhash64(id_col, text_col), F.lit(buckets)).cast("int").alias("grp")
    dealt = docs.select(row, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), group).repartition(shuffle_partitions(docs), "grp")
    spans = dealt.groupBy("grp").applyInArrow(_spans(half, buckets), _SPANS)
    shared = spans.groupBy("bucket").applyInArrow(_shared, _ANSWER)
    windows = dealt.groupBy("grp").cogroup(shared.groupBy("grp")).applyInArrow(_anchored(window, half, buckets), _WINDOWS)
    owners = windows.groupBy("bucket").applyInArrow(_owners, _OWNERS)
    passage = T.StructType().add("first", "long").add("last", "long")
    out = T.StructType().add(dealt.schema["row"]).add("n_words", "long").add("n_removed", "long")
    out = out.add("removed", T.ArrayType(passage)).add("kept", "string")
    return dealt.groupBy("grp").cogroup(owners.groupBy("grp")).applyInArrow(_cleaned(window, layout), out)
