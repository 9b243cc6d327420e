"""Similarity join of documents on word n-grams, by vertical partitioning.

The set of a document holds its distinct n-grams. N-grams have a global order, rare ones
first; two sets that are similar enough share an n-gram among the first few of both
(the prefix). N-grams that only one set has can't be shared: they count in the size and
the order, but are dropped as soon as their frequency is known.

For candidate pairs the range of all n-grams is cut into fragments. Each fragment counts
the overlap of its part of the two sets on its own, and the counts are summed per pair.

No group of copies is turned into all its pairs. Documents with equal sets are one
class. The classes that have an n-gram in their prefix are a list; ``families`` lets them
meet pivots (the one with the fewest n-grams of its own first, in a family of near copies
the original), then short open lists completely and long ones more pivots. The bounds on the
sizes and on what two sets can still share behind the n-gram are part of the join.

An n-gram is known by its fragment bucket and 40 bits of a 64-bit hash. Documents of
fewer than n words have their whole word sequence as one n-gram. Documents without words
(null and empty texts) have empty sets and link with nothing. Ids may have any type that has
an order. Rows without an id and rows that share one take part as documents of their own; a
component of rows without ids has none. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blobs import lengths, pack, runs, slices, unpack
from .families import component_ids, labelled, named, shared_lists
from .scratch import shuffle_partitions, written, written_small
from .textbytes import LOWER, chunks, mix, window_hashes, words_of

N, PERCENT = 5, 75
FRAGMENTS = 16
FLUSH = 2_000_000  # n-grams sent together
SEEN = 1_000_000  # sets that a task remembers, to send equal ones once
_U = np.uint64
_PRINT = (1 << 40) - 1

_KEY = ["n", "high", "low"]


def _sent(kind: str) -> str:
    return f"part int, uid long, id {kind}, own long, n long, high long, low long, uids binary, prints binary, counts binary"


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), kind, *[pa.int64()] * 4, *[pa.binary()] * 3]
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _sent("x").split(", ")])


def _blob(part: int, uids: np.ndarray, prints: np.ndarray, counts: np.ndarray) -> tuple:
    return (part, None, None, None, None, None, None, pack(uids), pack(prints), pack(counts))


def _group_of(uids: np.ndarray, groups: int) -> np.ndarray:
    return (mix(uids.astype(_U)) % _U(groups)).astype(np.int64)


def grams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, document) of a chunk, distinct and sorted by document; shorter documents whole."""
    counts = np.diff(first)
    found, places = [], []
    for k in range(1, n + 1):
        values, at = window_hashes(hashes, first, k)
        doc = np.searchsorted(first, at, side="right") - 1
        if k < n:
            short = counts[doc] == k
            values, doc = mix(values[short] + _U(k)), doc[short]
        found.append(values)
        places.append(doc)
    values, doc = np.concatenate(found), np.concatenate(places)
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[new], doc[new]


def _cut(n: int, buckets: int, groups: int):
    """Texts to one row per document, dealt by its group, and blobs of n-grams by bucket.
    Of the documents of a task with equal sets only the first (``own``) sends its n-grams."""

    def work(batches):
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 36
        seen: dict[tuple[int, int, int], int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush():
            values, owner = (np.concatenate(x) for x in zip(*held))
            bucket = ((values >> _U(40)) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            values, owner, bucket = values[order] & _U(_PRINT), owner[order], bucket[order]
            rows = []
            for b, x, y in slices(bucket):
                start = runs(owner[x:y])
                rows.append(_blob(b, owner[x:y][start], values[x:y], lengths(start, y - x).astype(np.uint32)))
            return _batch(rows, ids.type)

        for batch in batches:
            ids = batch.column(0)
            for row, stop, data, offsets in chunks(batch.column(1)):
                words = words_of(LOWER[data], offsets)
                values, doc = grams(words.hashes(), words.first, n)
                sizes = np.bincount(doc, minlength=stop - row)
                begin = np.cumsum(sizes) - sizes
                sums = [np.concatenate([[_U(0)], np.cumsum(mix(values ^ _U(s)))]) for s in (0x5851F42D, 0x14057B7E)]
                high, low = ((s[begin + sizes] - s[begin]).view(np.int64) for s in sums)
                rows, fresh = [], np.zeros(stop - row, dtype=bool)
                uids = np.arange(uid, uid + stop - row)
                uid += stop - row
                groups_of = _group_of(uids, groups)
                for k in range(stop - row):
                    node, size = ids[row + k].as_py(), int(sizes[k])
                    own = int(uids[k])
                    if size:
                        key = (size, int(high[k]), int(low[k]))
                        first = seen.setdefault(key, own)
                        fresh[k] = first == own
                        own = first
                    rows.append((int(groups_of[k]), int(uids[k]), node, own, size, int(high[k]), int(low[k]), None, None, None))
                yield _batch(rows, ids.type)
                if len(seen) > SEEN:
                    seen.clear()
                keep = fresh[doc]
                held.append((values[keep], uids[doc[keep]]))
                waiting += int(keep.sum())
                if waiting >= FLUSH:
                    yield flush()
                    held, waiting = [], 0
        if waiting:
            yield flush()

    return work


def _frequent(buckets: int, groups: int):
    """Frequencies in one bucket; n-grams of at least two sets go on to the groups of their documents."""

    def work(key, table):
        part = key[0].as_py()
        plain = table.filter(table["uid"].is_valid())
        blobs = table.filter(table["uids"].is_valid())
        if not len(blobs):
            return plain
        prints = np.concatenate([unpack(b, _U) for b in blobs["prints"].to_pylist()])
        owner = np.concatenate([
            np.repeat(unpack(u, np.int64), unpack(c, np.uint32)) for u, c in zip(blobs["uids"].to_pylist(), blobs["counts"].to_pylist())
        ])
        order = np.argsort(prints, kind="stable")
        start = runs(prints[order])
        size = lengths(start, len(order))
        times = np.repeat(size, size)
        keep = np.flatnonzero(times > 1)
        prints, owner, times = prints[order[keep]], owner[order[keep]], times[keep]
        group = _group_of(owner, groups)
        order = np.lexsort((owner, group))
        prints, owner, times, group = prints[order], owner[order], times[order], group[order]
        prints |= _U(part << 40)
        rows = [_blob(g, owner[a:b], prints[a:b], times[a:b].astype(np.uint32)) for g, a, b in slices(group)]
        return pa.concat_tables([plain, pa.Table.from_batches([_batch(rows, table.schema.field("id").type)])])

    return work


def _sets(kind: str) -> str:
    return f"uid long, id {kind}, own long, n long, high long, low long, shared int, lead array<long>, parts array<array<long>>"


def _assembled(percent: int, buckets: int, fragments: int):
    """One row per document: the number of its shared n-grams, those of them that lie in its
    prefix (``lead``, in global order: frequency, then value), and if there are any, all
    shared ones cut into the fragments of the n-gram range (``parts``)."""
    width = -(-(buckets << 40) // fragments)

    def work(key, table):
        plain = table.filter(table["uid"].is_valid())
        blobs = table.filter(table["uids"].is_valid())
        uids, n = plain["uid"].to_numpy(), plain["n"].to_numpy()
        shared, leading = np.zeros(len(uids), np.int64), np.zeros(len(uids), np.int64)
        lead, inner, flat = np.empty(0, np.int64), np.zeros(1, np.int64), np.empty(0, np.int64)
        if len(blobs):
            owner = np.concatenate([unpack(b, np.int64) for b in blobs["uids"].to_pylist()])
            value = np.concatenate([unpack(b, _U) for b in blobs["prints"].to_pylist()]).view(np.int64)
            times = np.concatenate([unpack(b, np.uint32) for b in blobs["counts"].to_pylist()])
            by_uid = np.argsort(uids)
            place = by_uid[np.searchsorted(uids[by_uid], owner)]
            shared = np.bincount(place, minlength=len(uids))
            leading = np.clip(n - -(-percent * n // 100) + 1 - (n - shared), 0, shared)  # prefix length less the n-grams of its own
            keep = leading[place] > 0
            place, value, times = place[keep], value[keep], times[keep]
            order = np.lexsort((value, times, place))
            begin = np.cumsum(shared * (leading > 0)) - shared * (leading > 0)
            rank = np.arange(len(order)) - begin[place[order]]
            lead = value[order][rank < leading[place[order]]]
            order = np.lexsort((value, place))
            flat = value[order]
            cell = (np.cumsum(leading > 0) - 1)[place[order]] * fragments + flat // width
            inner = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=int((leading > 0).sum()) * fragments))])
        ends = lambda counts: pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        parts = pa.ListArray.from_arrays(pa.array(inner, pa.int32()), pa.array(flat))
        columns = [
            *[plain[c] for c in ("uid", "id", "own", *_KEY)], pa.array(shared, pa.int32()),
            pa.ListArray.from_arrays(ends(leading), pa.array(lead)), pa.ListArray.from_arrays(ends((leading > 0) * fragments), parts),
        ]
        return pa.table(columns, names=[f.split()[0] for f in _sets("x").split(", ")])

    return work


def sets(docs: DataFrame, n: int = N, percent: int = PERCENT, fragments: int = FRAGMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One written row per document: its set as ``_assembled`` describes it."""
    parts, kind = 2 * shuffle_partitions(docs), docs.schema[id_col].dataType.simpleString()
    sent = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(_cut(n, parts, parts), _sent(kind))
    counted = sent.groupBy("part").applyInArrow(_frequent(parts, parts), _sent(kind))
    return written(counted.groupBy("part").applyInArrow(_assembled(percent, parts, fragments), _sets(kind)), "jaccard-sets")


def _linked(pairs: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets are similar enough: the overlap of each fragment of the n-grams, summed per pair."""
    ends = ["x", "y", "x_label", "y_label"]
    left = pairs.join(lists.select(F.col("uid").alias("x"), F.col("n").alias("x_n"), "parts"), "x")
    left = left.select(*ends, "x_n", F.posexplode("parts").alias("fragment", "x_part")).where(F.size("x_part") > 0)
    right = lists.select(F.col("uid").alias("y"), F.col("n").alias("y_n"), "parts").join(pairs.select("y").distinct(), "y", "left_semi")
    right = right.select("y", "y_n", F.posexplode("parts").alias("fragment", "y_part")).where(F.size("y_part") > 0)
    met = left.join(right, ["y", "fragment"]).select(*ends, "x_n", "y_n", F.size(F.array_intersect("x_part", "y_part")).alias("overlap"))
    found = met.groupBy(*ends, "x_n", "y_n").agg(F.sum("overlap").alias("overlap"))
    return found.where(_enough(F.col("x_n"), F.col("y_n"), F.col("overlap"), percent)).select(*ends)


def _enough(a: Column, b: Column, overlap: Column, percent: int) -> Column:
    return 100 * overlap >= percent * (a + b - overlap)


def grouped(docs: DataFrame, n: int = N, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    found = sets(docs, n, percent, FRAGMENTS, id_col, text_col)
    classes = written(found.where("n > 0").groupBy(*_KEY).agg(F.min("own").alias("rep"), F.min("id").alias("id")), "jaccard-classes")
    sent = found.where((F.size("lead") > 0) & (F.col("uid") == F.col("own"))).select("uid", "n", "shared", "lead", "parts")
    lists = written(sent.join(classes.select(F.col("rep").alias("uid")), "uid", "left_semi"), "jaccard-sent")
    alone = F.col("n") - F.col("shared")
    entries = lists.select("uid", "n", (1000 * alone / F.col("n")).cast("int").alias("alone"), F.posexplode("lead").alias("at", "token"), alone.alias("before"))
    entries = entries.select("token", F.struct("alone", "uid", "n", (F.col("at") + F.col("before")).alias("at")).alias("me"))

    def bound(a: Column, b: Column) -> Column:
        # in the list of the first n-gram they share, two sets can have no more in common
        # than what either has from there on; other lists need not find the pair
        few, many, rest = F.least(a["n"], b["n"]), F.greatest(a["n"], b["n"]), F.least(a["n"] - a["at"], b["n"] - b["at"])
        return (100 * few >= percent * many) & _enough(a["n"], b["n"], rest, percent)

    def check(pairs: DataFrame) -> DataFrame:
        return _linked(written_small(pairs, "jaccard-pairs"), lists, percent)

    labels = labelled(shared_lists(entries, "jaccard"), bound, lambda pivot: F.min(pivot)["uid"], check, "jaccard")
    rows = component_ids(found.select("id", *_KEY), named(classes, labels, _KEY, "jaccard"), _KEY)
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def representatives(docs: DataFrame, n: int = N, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those of a component that have a larger id than another; rows without
    an id stay."""
    late = grouped(docs, n, percent, id_col, text_col).where(F.col("component_id") < F.col(id_col)).select(id_col)
    return docs.join(late, id_col, "left_anti").select(*docs.columns)
