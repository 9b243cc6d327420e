"""Near duplicates by MinHash: many universal hash minima, banding, verification, components.

The set of a document holds its distinct word shingles. Each of ``MINIMA`` functions
h(x) = a * x + b modulo 2**64 gives the least value over the set; the share of equal minima of
two sets estimates their similarity. ``BANDS`` bands of ``ROWS`` minima are the lists in which
documents meet; a pair of similarity 0.80 shares none with a probability of 0.672**36 =
6e-7. Candidates must agree in ``LEAST`` of the minima (six standard deviations below what a
similarity of 0.80 gives) and are then confirmed on the full sets. ``families`` turns the
confirmed links into components by large and small stars, without all pairs of a group. Sets
that are left in lists of several components meet by their rare shingles instead of bands.

Documents of equal sets are one class, known by its size and 128 bits summed over the set.
Full sets are needed only of classes that share a list. A bit array of a fixed size says
which may be among them (a few others may, too), so a second reading of the texts sends only those.

A shingle is known by a 64-bit hash. Documents of fewer than n words have their whole word
sequence as one shingle. Documents without words (null and empty texts) have empty sets and
are linked with nothing. Rows without an id take part as documents of their own; a component
of such rows alone has no id and keeps them all, in others they are not kept. Rows that share
an id are documents of their own. Ids may have any type that has an order. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .families import component_ids, labelled, named, shared_lists
from .jaccard import grams
from .scratch import merged_tasks, written, written_small
from .textbytes import LOWER, chunks, mix, words_of

N, PERCENT = 4, 80
BANDS, ROWS = 36, 5
MINIMA = BANDS * ROWS
LEAST = 112  # equal minima of MINIMA that a candidate needs
FILTER_BITS = 1 << 26  # size of the bit array: 8 MB, whatever the input
_PAGE = 1 << 15  # bits that one row of it holds, by Spark's bitmap functions
_U = np.uint64
_draw = np.random.Generator(np.random.PCG64(13))
_A = _draw.integers(1 << 63, size=MINIMA, dtype=_U) * _U(2) + _U(1)
_B = _draw.integers(1 << 63, size=MINIMA, dtype=_U)
_KEY = ["n", "high", "low"]


def _sets(column, n: int):
    """(number of rows, distinct shingles sorted by row, sizes, 128 bits of each set) of a batch, in chunks."""
    for _, _, data, offsets in chunks(column):
        words = words_of(LOWER[data], offsets)
        values, doc = grams(words.hashes(), words.first, n)
        sizes = np.bincount(doc, minlength=len(offsets) - 1)
        begin = np.cumsum(sizes) - sizes
        sums = [np.concatenate([[_U(0)], np.cumsum(mix(values ^ _U(s)))]) for s in (0x5851F42D, 0x14057B7E)]
        yield values, sizes, *((s[begin + sizes] - s[begin]).view(np.int64) for s in sums)


def minima(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Upper 32 bits of the least value of each function, one row for each set; empty sets have zeros."""
    some = sizes > 0
    out = np.zeros((len(sizes), MINIMA), np.uint32)
    begin = (np.cumsum(sizes) - sizes)[some]
    if len(begin):
        h = np.empty_like(values)
        for k in range(MINIMA):
            np.multiply(values, _A[k], out=h)
            h += _B[k]
            out[some, k] = np.minimum.reduceat(h, begin) >> _U(32)
    return out


def _bands(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    cut = least.reshape(len(least), BANDS, ROWS).astype(_U)
    key = mix(np.arange(1, BANDS + 1, dtype=_U))[None, :].repeat(len(least), axis=0)
    for k in range(ROWS):
        key = mix(key * _U(0x9E3779B97F4A7C15) ^ (cut[:, :, k] + _U(1)))
    return key.view(np.int64)


def _blobs(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    kind = pa.binary() if offsets[-1] < 1 << 31 else pa.large_binary()
    width = np.int32 if kind == pa.binary() else np.int64
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets.astype(width).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def profiles(docs: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One written row per document: number, id, set size and bits, band keys, one byte of each minimum."""

    def work(batches):
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            at = 0
            for values, sizes, high, low in _sets(batch.column(1), n):
                rows = len(sizes)
                least = minima(values, sizes)
                keys = _bands(least)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(uid, uid + rows)), batch.column(0).slice(at, rows), pa.array(sizes), pa.array(high), pa.array(low),
                        pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1))),
                        _blobs(least.astype(np.uint8), np.arange(1, rows + 1) * MINIMA),
                    ],
                    names=["uid", "id", *_KEY, "bands", "least"],
                )
                uid, at = uid + rows, at + rows

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"uid long, id {kind}, n long, high long, low long, bands array<long>, least binary"
    return written(docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(work, schema), "minhash-profiles")


def _place(high: Column, low: Column) -> Column:
    return F.pmod(F.xxhash64(high, low), F.lit(FILTER_BITS))


def full_sets(docs: DataFrame, wanted: DataFrame, n: int, text_col: str) -> DataFrame:
    """(rep, grams): the shingles of the ``wanted`` classes (rep, n, high, low), written."""

    ends = lambda sizes: np.concatenate([[0], np.cumsum(sizes)])

    def work(batches):
        for batch in batches:
            for values, sizes, high, low in _sets(batch.column(0), n):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sizes), pa.array(high), pa.array(low), pa.ListArray.from_arrays(pa.array(ends(sizes), pa.int32()), pa.array(values.view(np.int64)))],
                    names=[*_KEY, "grams"],
                )

    place = _place(F.col("high"), F.col("low"))
    pages = wanted.select(place.alias("p")).groupBy(F.expr(f"p div {_PAGE}").alias("page")).agg(
        F.bitmap_construct_agg(F.col("p") % _PAGE).alias("bits")
    )
    read = docs.select(F.col(f"`{text_col}`")).mapInArrow(work, "n long, high long, low long, grams array<long>").withColumn("p", place)
    byte = F.conv(F.hex(F.expr(f"substring(bits, cast(p % {_PAGE} div 8 as int) + 1, 1)")), 16, 10).cast("int")
    some = read.withColumn("page", F.expr(f"p div {_PAGE}")).join(F.broadcast(pages), "page")  # at most FILTER_BITS / _PAGE rows of 4 KB
    some = some.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(p % 8 as int))")) != 0)
    each = some.groupBy(*_KEY).agg(F.first("grams").alias("grams"))
    return written(each.join(wanted, _KEY).select("rep", "grams"), "minhash-sets")


def _alike(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Pairs whose minima agree often enough."""

    def work(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINIMA) for c in ("a", "b"))
            yield batch.filter(pa.array((a == b).sum(axis=1) >= least)).drop_columns(["a", "b"])

    side = lambda c, name: classes.select(F.col("rep").alias(c), F.col("least").alias(name))
    rows = pairs.join(side("x", "a"), "x").join(side("y", "b"), "y").select("x", "y", "x_label", "y_label", "a", "b")
    return merged_tasks(rows).mapInArrow(work, "x long, y long, x_label long, y_label long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets overlap enough."""
    side = lambda c, name: sets.select(F.col("rep").alias(c), F.col("grams").alias(name))
    rows = pairs.join(side("x", "a"), "x").join(side("y", "b"), "y")
    both = F.size(F.array_intersect("a", "b"))
    return rows.where(100 * both >= percent * (F.size("a") + F.size("b") - both)).select("x", "y", "x_label", "y_label")


def _refined(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows by shingle in place of bands, for sets that are still open.

    Shingles found under one label only can't be shared with another one. The others have a
    global order, rare ones first, and two sets that are similar enough share one among
    the first few of both; sets with too few shared ones are linked with no other label.
    """
    members = written_small(rows.select(F.col("me.uid").alias("rep"), "label", "me.n").distinct(), "minhash-members")
    grams = written(members.join(sets, "rep").select("rep", "label", "n", F.explode("grams").alias("gram")), "minhash-grams")
    shared = grams.groupBy("gram").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("times")).where("a < b")
    each = Window.partitionBy("rep")
    alive = grams.join(shared.select("gram", "times"), "gram").withColumns(
        {"alive": F.count("*").over(each), "place": F.row_number().over(each.orderBy("times", "gram"))}
    )
    own = F.col("n") - F.col("alive")
    first = alive.where(F.col("place") <= F.col("alive") - F.ceil(F.col("n") * percent / 100) + 1)
    return first.select(F.col("gram").alias("token"), F.struct(own.alias("own"), F.col("rep").alias("uid"), "n", (own + F.col("place") - 1).alias("at")).alias("me"), "label")


def grouped(docs: DataFrame, n: int = N, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    found = profiles(docs, n, id_col, text_col)
    classes = written(
        found.where("n > 0").groupBy(*_KEY).agg(F.min("id").alias("id"), F.min(F.struct("uid", "bands", "least")).alias("r"))
        .select(F.col("r.uid").alias("rep"), *_KEY, "id", "r.bands", "r.least"),
        "minhash-classes",
    )
    lists = shared_lists(classes.select(F.explode("bands").alias("token"), F.struct(F.lit(0).cast("long").alias("own"), F.col("rep").alias("uid"), "n", F.lit(0).cast("long").alias("at")).alias("me")), "minhash")
    wanted = written(classes.select("rep", *_KEY).join(lists.select(F.col("me.uid").alias("rep")).distinct(), "rep", "left_semi"), "minhash-wanted")
    sets = full_sets(docs, wanted, n, text_col)

    def check(pairs: DataFrame) -> DataFrame:
        return _confirmed(written(_alike(pairs, classes, LEAST * percent // PERCENT), "minhash-alike"), sets, percent)

    def bound(a: Column, b: Column) -> Column:
        both = F.least(a["n"] - a["at"], b["n"] - b["at"])  # no more than what either has from this shingle on
        return 100 * both >= percent * (a["n"] + b["n"] - both)

    # of the pivots of its lists a class meets the one that most of them have
    choose = lambda pivot: F.mode(pivot["uid"], True)
    labels = labelled(lists, bound, choose, check, "minhash", lambda rows: _refined(rows, sets, percent))
    rows = component_ids(found.select("id", *_KEY), named(classes, labels, _KEY, "minhash"), _KEY)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull())
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
