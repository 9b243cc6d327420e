"""Exact top-k by inner product, term at a time.

A vector is a sparse row of (term, weight); terms are its places, weights integers.
Candidates are dealt into blocks; a block keeps, for each term, the rows that have it
and their weights. The queries of a group go through the terms one by one, and each
term adds query weight times posting weight into dense rows of scores, one place per
candidate. Partition selection leaves k candidates of a block for each query; a window
merges the blocks.

Vectors that are null or hold null or non-finite components take no part, nor do rows
without an id. Rows with one id are one vector, the largest by array order. Shorter vectors
lack the terms beyond their end. Ties go to the smaller id; an empty table gives an empty
result.

Scores are added in 64 bits where no sum can exceed them; vectors with larger weights are
scored with whole numbers of any length, so every rank is exact. A score that 64 bits do
not hold is null in the result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import shuffle_partitions

BLOCK, SMALL, GROUP = 16_384, 256, 2_048  # most and least candidates of a block, queries of a group
SCALE = 256


UNIT = 64  # integer_vectors gives weights as doubles in units of 2**-UNIT: none overflows
FAR = 1 << 2240  # more than any score of doubles; makes sort keys of scores beyond 64 bits


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, weights): floor(scale * x) of every component, as array<double> in units of 2**-UNIT."""
    number = lambda x: x.cast("double")
    sound = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) < float("inf")))
    unit = F.lit(2.0**-UNIT)
    weights = F.transform(F.col(vector_col), lambda x: F.when(  # from 2**52 on a double has no fraction
        F.abs(scale * number(x)) < 2.0**52, F.floor(scale * number(x)).cast("double") * unit
    ).otherwise(scale * (number(x) * unit)))
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & sound)
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), weights.alias("weights")).groupBy("vec_id").agg(F.max("weights").alias("weights"))


def _whole(w) -> int:
    """A weight as a whole number: a long, or a double in units of 2**-UNIT."""
    if isinstance(w, float):
        n, d = w.as_integer_ratio()
        return (n << UNIT) // d
    return int(w)


def _matrix(weights: pd.Series) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Weights of the rows that 64 bits hold safely, and the other rows (zero there) by place.
    A product of two safe weights, summed over all terms, stays below 2**63."""
    width = max(map(len, weights), default=0)
    safe = 1 << (62 - width.bit_length()) // 2
    out, wide = np.zeros((len(weights), width), np.int64), {}
    for place, w in enumerate(weights):
        w = np.asarray(w)
        unit = 2.0**UNIT if w.dtype.kind == "f" else 1
        if ((w < safe / unit) & (w > -safe / unit)).all():
            out[place, : len(w)] = w * unit
        else:
            wide[place] = np.array([_whole(x) for x in w.tolist()], object)
    return out, wide


def _exact(a: np.ndarray, b: np.ndarray) -> int:
    return sum(int(x) * int(y) for x, y in zip(a, b) if x and y)


def _with_wide(row: np.ndarray, query: int, asked, candidates) -> np.ndarray:
    """The scores of a query with those that involve a wide vector put in, exactly."""
    (terms, wide_terms), (table, wide) = asked, candidates
    own = wide_terms.get(query, terms[query])
    places = range(len(row)) if query in wide_terms else wide
    exact = [_exact(own, wide.get(place, table[place])) for place in places]
    if any(abs(x) >= 1 << 63 for x in exact):
        row = row.astype(object)
    row[list(places)] = exact
    return row


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id; ``ids`` ascend."""
    if (me := np.searchsorted(ids, own)) < len(ids) and ids[me] == own:
        places = np.delete(np.arange(len(ids)), me)
    else:
        places = np.arange(len(ids))
    mine = scores[places]
    if len(mine) > k:
        limit = np.partition(mine, len(mine) - k)[len(mine) - k]
        above = np.flatnonzero(mine > limit)
        chosen = np.concatenate([above, np.flatnonzero(mine == limit)[: k - len(above)]])
    else:
        chosen = np.arange(len(mine))
    return places[chosen]


def _search(k: int):
    def work(key, candidates, queries):
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(candidates) and len(queries):
            candidates = candidates.sort_values("vec_id")
            ids, (table, wide) = candidates["vec_id"].to_numpy(), _matrix(candidates["weights"])
            postings = [(rows, column[rows]) for column in table.T for rows in [np.flatnonzero(column)]]
            asked, (terms, wide_terms) = queries["query_id"].to_numpy(), _matrix(queries["terms"])
            step = max(1, (1 << 21) // len(ids))
            for at in range(0, len(asked), step):
                some = terms[at : at + step]
                scores = np.zeros((len(some), len(ids)), np.int64)
                for weights, (rows, values) in zip(some.T, postings):
                    for place in np.flatnonzero(weights):
                        if len(rows) == len(ids):
                            scores[place] += weights[place] * values
                        else:
                            scores[place, rows] += weights[place] * values
                for place, (query, row) in enumerate(zip(asked[at : at + step], scores), at):
                    if wide or place in wide_terms:
                        row = _with_wide(row, place, (terms, wide_terms), (table, wide))
                    best = _best(row, ids, query, k)
                    out["query_id"] += [query] * len(best)
                    out["vec_id"] += ids[best].tolist()
                    out["score"] += row[best].tolist()
        fits = [-(1 << 63) <= x < 1 << 63 for x in out["score"]]
        return pd.DataFrame({
            "query_id": np.array(out["query_id"], np.int64), "vec_id": np.array(out["vec_id"], np.int64),
            "score": pd.array([x if f else None for x, f in zip(out["score"], fits)], "Int64"),
            "far": pd.Series([None if f else f"{x + FAR:0561x}" for x, f in zip(out["score"], fits)], dtype=object),
        })

    return work


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for every row of
    ``queries``, both (vec_id, weights). A query never finds its own id.

    Every block meets every group of queries once, so a vector is sent once for each
    group and a query once for each block.
    """
    n = vectors.count()
    blocks = max(1 + n // BLOCK, min(shuffle_partitions(vectors), 1 + n // SMALL))  # enough for all tasks
    groups = 1 + queries.count() // GROUP
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("vec_id", "weights", part(blocks).alias("block"), every(groups).alias("group"))
    right = queries.select(F.col("vec_id").alias("query_id"), F.col("weights").alias("terms"), every(blocks).alias("block"), part(groups).alias("group"))
    found = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInPandas(
        _search(k), "query_id long, vec_id long, score long, far string"
    )
    side = F.when(F.col("far").isNull(), 0).when(F.col("far").startswith("1"), 1).otherwise(-1)  # beyond 64 bits: above or below
    order = Window.partitionBy("query_id").orderBy(side.desc(), F.col("score").desc(), F.col("far").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
