"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Bulk-synchronous: in each round the documents not yet placed and the gaps of the open
sequences are range-sorted together by size, largest first. A sweep down that order
gives each document the smallest gap that still holds it (its successor): a gap goes
onto a stack, a document takes the top one. Each task sweeps its range; what stays
open at the ends of the ranges is matched by rank from one count pair per range. Then
the gaps shrink and the next round begins. A gap at least twice as long as the longest
document left offers several slots at once, so many short documents need few rounds.

Nulls are empty texts; an empty text is the end mark alone. Repeated rows, ids that are
null and equal ids are documents of their own. An empty table gives an empty result.
Longer documents are cut into pieces of the capacity, the first piece taking the rest.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pretoken import PieceTable, coded_chunks
from .scratch import written

CAPACITY = 2048
END_ID = 0
ROWS_PER_TASK = 100_000
JOINED = 2000  # pre-tokens encoded in one call


def _encoder(path: str):
    """Ids of distinct pre-tokens by the tokenizers library.

    A pre-token that begins with a space may follow any other without changing how
    either is split, so those are encoded as one text and cut by their bytes.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    size = tokenizer.get_vocab_size()
    widths = np.array([len(tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)  # one letter per byte

    def ids(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(pieces: list[str]) -> list:
        out: list = [None] * len(pieces)
        joined = [k for k, p in enumerate(pieces) if len(p) > 1 and p[0] == " " and not p[1].isspace()]
        apart = sorted(set(range(len(pieces))) - set(joined))
        for k, got in zip(apart, ids([pieces[k] for k in apart])):
            out[k] = got
        for at in range(0, len(joined), JOINED):
            some = joined[at : at + JOINED]
            ends = np.cumsum([len(pieces[k].encode("utf-8")) for k in some])
            got = np.array(ids(["".join(pieces[k] for k in some)])[0], np.uint32)
            cuts = np.searchsorted(np.cumsum(widths[got]), ends) + 1
            for k, a, b in zip(some, [0, *cuts[:-1].tolist()], cuts.tolist()):
                out[k] = got[a:b]
        return out

    return encode


@lru_cache(maxsize=2)
def _table(path: str) -> PieceTable:
    return PieceTable(_encoder(path))


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32): documents tokenized and cut, without a shuffle.

    ``uid`` numbers the pieces of one run only; write the result before using it twice.
    """

    def work(batches):
        from pyspark import TaskContext

        uid = TaskContext.get().partitionId() << 40
        table = _table(path)
        for batch in batches:
            ids_of, column = batch.column(0), batch.column(1)
            rows, numbers, starts, lengths, sums = [], [], [], [], []
            row_of = 0
            for row_of, ids, ends in coded_chunks(column, table):
                for k in range(len(ends) - 1):
                    whole = np.append(ids[ends[k] : ends[k + 1]], np.uint32(END_ID)).astype("<u4")
                    at, number = 0, 0
                    cut = len(whole) % capacity or capacity
                    while at < len(whole):
                        rows.append(row_of + k)
                        numbers.append(number)
                        starts.append(at)
                        lengths.append(cut - at)
                        sums.append(zlib.crc32(whole[at:cut].tobytes()))
                        at, cut, number = cut, cut + capacity, number + 1
            uids = np.arange(uid, uid + len(rows))
            uid += len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids), ids_of.take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (starts, lengths, sums)]],
                names=["uid", id_col, "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"uid long, `{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(work, schema)


def _sweep(ranged: DataFrame) -> DataFrame:
    """Matches inside each range of (size, kind, id), sorted; kind 0 is a gap, 1 a document.

    Out come matched pairs (doc, gap), and what stays open with its rank in the range:
    documents from the largest on, gaps from the bottom of the stack.
    """

    def work(batches):
        from pyspark import TaskContext

        part, stack, lone = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            docs, gaps, ranks = [], [], []
            for kind, who in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if kind == 0:
                    stack.append(who)
                elif stack:
                    docs.append(who)
                    gaps.append(stack.pop())
                    ranks.append(None)
                else:
                    docs.append(who)
                    gaps.append(None)
                    ranks.append(lone)
                    lone += 1
            yield _swept(part, docs, gaps, ranks)
        yield _swept(part, [None] * len(stack), stack, list(range(len(stack))))

    def _swept(part, docs, gaps, ranks):
        columns = [pa.array([part] * len(docs), pa.int32()), *[pa.array(x, pa.int64()) for x in (docs, gaps, ranks)]]
        return pa.RecordBatch.from_arrays(columns, names=["part", "doc", "gap", "rank"])

    return ranged.mapInArrow(work, "part int, doc long, gap long, rank long")


def _across(spark: SparkSession, swept: DataFrame) -> DataFrame:
    """Which open documents of a range take which open gaps of earlier ranges.

    One row of counts per range is gathered, as many as there are tasks; the stack of
    earlier gaps is kept as runs of ranks.
    """
    open_ = F.col("rank").isNotNull()
    counts = swept.where(open_).groupBy("part").agg(F.count("doc").alias("docs"), F.count("gap").alias("gaps")).collect()
    runs, links = [], []
    for part, docs, gaps in sorted(map(tuple, counts)):
        taken = 0
        while taken < docs and runs:
            owner, free = runs.pop()
            n = min(free, docs - taken)
            links.append((part, taken, taken + n, owner, free - 1 + taken))  # document rank r takes gap rank (last - r)
            taken += n
            if n < free:
                runs.append((owner, free - n))
        if gaps:
            runs.append((part, gaps))
    return spark.createDataFrame(links, "part int, low long, high long, gap_part int, last long")


def assign(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, sequence_id, offset) for rows (uid, length) with lengths from 1 to ``capacity``."""
    spark = items.sparkSession
    open_docs = items.where(F.col("length") < capacity).select("uid", "length")
    full = items.where(F.col("length") == capacity).select("uid", (2 * F.col("uid") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    gaps = spark.createDataFrame([], "gap_id long, room long")
    placed: list[DataFrame] = []
    opened, turn = 0, 0
    while True:
        shortest, longest, docs_n, total = open_docs.agg(
            F.min("length"), F.max("length"), F.count("*"), F.sum("length")
        ).first()
        if not docs_n:
            break
        usable = gaps.where(F.col("room") >= shortest)
        room_n, room, widest = usable.agg(F.count("*"), F.sum("room"), F.max("room")).first()
        long = open_docs.where(F.col("length") > (widest or 0))
        long_n, long_total = long.agg(F.count_if(F.col("length") * 2 > capacity), F.sum("length")).first()
        new = max(long_n, -(-(long_total or 0) // capacity), -(-(total - (room or 0)) // capacity))
        if new:
            usable = usable.unionByName(
                spark.range(opened, opened + new).select(F.col("id").alias("gap_id"), F.lit(capacity).cast("long").alias("room"))
            )
            opened += new
        most = max(1, -(-4 * docs_n // (room_n + new)))
        slots = F.when(F.col("room") >= 2 * longest, F.least(F.floor(F.col("room") / longest), F.lit(most))).otherwise(1)
        offers = usable.select(
            "gap_id", "room", F.explode(F.sequence(F.lit(1), slots.cast("int"))).alias("slot")
        ).select(F.when(F.col("room") >= 2 * longest, F.lit(longest)).otherwise(F.col("room")).alias("size"), F.lit(0).alias("kind"), F.col("gap_id").alias("id"))
        asks = open_docs.select(F.col("length").alias("size"), F.lit(1).alias("kind"), F.col("uid").alias("id"))
        tasks = 1 + (docs_n + room_n + new) // ROWS_PER_TASK
        order = [F.col("size").desc(), F.col("kind"), F.col("id")]
        ranged = offers.unionByName(asks).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
        swept = written(_sweep(ranged), "packing-sweep")
        # Bounded by the number of tasks: at most two runs for each range.
        links = F.broadcast(_across(spark, swept))
        lone = swept.where("doc IS NOT NULL AND gap IS NULL").alias("s").join(
            links.alias("k"), F.expr("s.part = k.part AND s.rank >= k.low AND s.rank < k.high"), "left"
        ).select("doc", "gap_part", (F.col("last") - F.col("rank")).alias("gap_rank"))
        spare = swept.where("doc IS NULL").select("gap", F.col("part").alias("gap_part"), F.col("rank").alias("gap_rank"))
        crossed = lone.where("gap_part IS NOT NULL").join(spare, ["gap_part", "gap_rank"]).select("doc", "gap")
        pairs = swept.where("doc IS NOT NULL AND gap IS NOT NULL").select("doc", "gap").unionByName(crossed)
        sized = written(
            pairs.join(open_docs, F.col("doc") == F.col("uid")).select("uid", "length", "gap", F.lit(turn).alias("turn")), "packing-placed"
        )
        placed.append(sized)
        gaps = written(
            usable.select("gap_id", "room").unionByName(sized.select(F.col("gap").alias("gap_id"), (-F.col("length")).alias("room")))
            .groupBy("gap_id").agg(F.sum("room").alias("room")).where("room > 0"), "packing-gaps"
        )
        open_docs = written(
            open_docs.join(lone.where("gap_part IS NULL").select(F.col("doc").alias("uid")), "uid", "left_semi"), "packing-open"
        )
        turn += 1
    if not placed:
        return full
    every = placed[0]
    for more in placed[1:]:
        every = every.unionByName(more)
    inside = Window.partitionBy("gap").orderBy("turn", F.col("length").desc(), "uid").rowsBetween(Window.unboundedPreceding, -1)
    packed = every.select("uid", (2 * F.col("gap")).alias("sequence_id"), F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long").alias("offset"))
    return packed.unionByName(full)


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with the sequence and offset each was given."""
    table = written(pieces(docs, path, capacity, id_col, text_col), "packing-pieces")
    return table.join(assign(table.select("uid", "length"), capacity), "uid").drop("uid")
