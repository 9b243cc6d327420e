"""Phrases whose words stand together more often than apart, by SON partitioning.

Texts are cut into runs of words of one language, each with its own word list, and the runs
are dealt into ``SHARDS`` shards. Each shard is mined completely: all its phrases are counted
by hash, and those that reach the support lowered to the shard's share of the language's words
are locally frequent. A phrase that is frequent over all documents is so in at least one shard,
so the union of the locally frequent phrases misses none. The runs then count the candidates
of that union by their words, not by hashes, and the sums are exact.

A phrase sends one print per run and not one per occurrence, so a passage that all documents
share is as cheap as any other. More shards prune less: the support of a shard is a count,
and of ten occurrences in ten shards or more nothing is left to demand.

Words are ``[^\\x20\\x09]+`` of the pieces between ``[.,;:!?\\x0A-\\x0D]``, A-Z lower-cased; a phrase
lies within one piece. A null language is ``und``, also beside rows that say so. Null and empty texts
have no words; repeated rows count each time. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blobs import lengths, pack, pack_sorted, runs, slices, unpack, unpack_sorted
from .scratch import shuffle_partitions, written
from .textbytes import CHUNK_BYTES, IS_WORD_BYTE, LOWER, chunks, hash_runs, window_hashes, words_of

MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
CONTAINED = 50  # percent of a phrase's occurrences that a longer one must have to replace it
SCALE = 1_000_000
SHARDS = 4
FLUSH = 1_000_000  # words of a run
UNKNOWN = "und"
_U = np.uint64
_PRINT = (1 << 40) - 1
_END = np.zeros(256, dtype=bool)
_END[[ord(c) for c in ".,;:!?"]] = True
_END[0x0A:0x0E] = True
_INSIDE = IS_WORD_BYTE & ~_END


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])


def encoded(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most: int = FLUSH, chunk: int = CHUNK_BYTES) -> DataFrame:
    """One written row per run: shard, language, number of words, the distinct words (one a line),
    the place of each word in them, and the lengths of the pieces."""

    def work(batches):
        from pyspark import TaskContext

        run = TaskContext.get().partitionId() << 36
        held: dict[str, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def flush():
            nonlocal run
            rows = []
            for lang, parts in held.items():
                data, sizes, pieces = (np.concatenate(x) for x in zip(*parts))
                coded = _binary(data, sizes).dictionary_encode()
                words = b"\n".join(coded.dictionary.to_pylist())
                rows.append((run, run % SHARDS, lang, len(sizes), words, pack(coded.indices.to_numpy().astype(np.uint32)), pack(pieces.astype(np.uint32))))
                run += 1
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            for row in rows:
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=["run", "shard", "lang", "n", "words", "ids", "pieces"])

        for batch in batches:
            langs = batch.column(0)
            for at, stop, data, offsets in chunks(batch.column(1), chunk):
                data = LOWER[data]
                found = words_of(data, offsets, _INSIDE)
                if not len(found.starts):
                    continue
                sizes = found.ends - found.starts
                kept = data[_INSIDE[data]]
                ends = np.cumsum(_END[data])[found.starts]
                doc = np.repeat(np.arange(stop - at), found.counts)
                codes: dict[str, int] = {}
                of_doc = np.array([codes.setdefault(x, len(codes)) for x in langs.slice(at, stop - at).fill_null(UNKNOWN).to_pylist()])
                new = np.ones(len(doc), dtype=bool)
                new[1:] = (doc[1:] != doc[:-1]) | (ends[1:] != ends[:-1])
                for lang, code in codes.items():
                    mine = of_doc[doc] == code
                    if mine.any():
                        begin = np.flatnonzero(new[mine])
                        held.setdefault(lang, []).append((kept[np.repeat(mine, sizes)], sizes[mine], lengths(begin, int(mine.sum()))))
                waiting += len(doc)
                if waiting >= most:
                    yield from flush()
                    held, waiting = {}, 0
        yield from flush()

    schema = "run long, shard int, lang string, n long, words binary, ids binary, pieces binary"
    return written(docs.select(F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`")).mapInArrow(work, schema), "collocations-runs")


class _Run:
    """Words and phrases of one run."""

    def __init__(self, words: bytes, ids: bytes, pieces: bytes):
        self.words = words.split(b"\n")
        self.ids = unpack(ids, np.uint32).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(unpack(pieces, np.uint32).astype(np.int64))])
        sizes = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.hashes = hash_runs(np.frombuffer(b"".join(self.words), np.uint8), np.cumsum(sizes) - sizes, sizes)[self.ids]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(print, place of the first word) of every phrase of so many words."""
        return window_hashes(self.hashes, self.first, size, seed=size)

    def prints(self, longest: int, radix: int):
        """(bucket, prints, counts) of all its phrases, prints ascending within a bucket."""
        every = np.sort(np.concatenate([self.windows(k)[0] for k in range(2, longest + 1)]))
        at = runs(every)
        prints, times = every[at], lengths(at, len(every))
        # an ascending print has ascending upper bits, so each bucket is one slice
        bucket = ((prints >> _U(40)) * _U(radix) >> _U(24)).astype(np.int64)
        for b, x, y in slices(bucket):
            yield b, prints[x:y], times[x:y]

    def counts(self, size: int, candidates: np.ndarray):
        """(phrase, count) of the phrases of so many words whose print is a candidate's."""
        if size == 1:
            n = np.bincount(self.ids, minlength=len(self.words))
            return self.words, n
        prints, at = self.windows(size)
        place = np.searchsorted(candidates, prints)
        place[place == len(candidates)] = 0
        at = at[candidates[place] == prints] if len(candidates) else at[:0]
        rows = self.ids[at[:, None] + np.arange(size)]
        if len(self.words) ** size < 1 << 62:
            key = rows @ (len(self.words) ** np.arange(size))
            _, one, n = np.unique(key, return_index=True, return_counts=True)
            rows = rows[one]
        else:
            rows, n = np.unique(rows, axis=0, return_counts=True)
        w = self.words
        return [b" ".join([w[k] for k in row]) for row in rows.tolist()], n


def _sent(rows: DataFrame, longest: int, radix: int) -> DataFrame:
    """The prints of each run's phrases by bucket, with the support of its shard."""

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                run = _Run(row["words"], row["ids"], row["pieces"])
                out = [(b, pack_sorted(p & _U(_PRINT)), pack(n.astype(np.uint32))) for b, p, n in run.prints(longest, radix)]
                if out:
                    buckets, prints, counts = zip(*out)
                    same = [pa.array([row[c]] * len(out), k) for c, k in (("lang", pa.string()), ("shard", pa.int32()), ("run", pa.int64()), ("need", pa.int64()))]
                    yield pa.RecordBatch.from_arrays(
                        [*same, pa.array(buckets, pa.int32()), pa.array(prints, pa.binary()), pa.array(counts, pa.binary())],
                        names=["lang", "shard", "run", "need", "bucket", "prints", "counts"],
                    )

    return rows.mapInArrow(work, "lang string, shard int, run long, need long, bucket int, prints binary, counts binary")


def _mined(key, table):
    """The locally frequent phrases of one bucket of a shard."""
    prints = np.concatenate([unpack_sorted(b, _U) for b in table["prints"].to_pylist()])
    times = np.concatenate([unpack(b, np.uint32) for b in table["counts"].to_pylist()]).astype(np.int64)
    order = np.argsort(prints, kind="stable")
    prints, times = prints[order], times[order]
    at = runs(prints)
    prints = prints[at][np.add.reduceat(times, at) >= table["need"][0].as_py()]
    return pa.table([pa.array([key[0].as_py()], pa.string()), pa.array([key[2].as_py()], pa.int32()), pa.array([pack_sorted(prints)], pa.binary())], names=["lang", "bucket", "frequent"])


def _answered(key, sent, union):
    """For each run of a bucket, which of its phrases are candidates, as bits."""
    good = np.unique(np.concatenate([np.empty(0, _U), *[unpack_sorted(b, _U) for b in union["frequent"].to_pylist()]]))
    bits = []
    for b in sent["prints"].to_pylist():
        prints = unpack_sorted(b, _U)
        place = np.searchsorted(good, prints)
        place[place == len(good)] = 0
        bits.append(pack(np.packbits(good[place] == prints if len(good) else np.zeros(len(prints), bool))))
    return pa.table([sent["run"], sent["bucket"], pa.array(bits, pa.binary())], names=["run", "bucket", "bits"])


def _counted(longest: int, radix: int):
    """Exact counts of a run's words and of its candidates."""

    def work(key, left, right):
        phrases, sizes, counts = [], [], []
        for row in left.to_pylist():
            run = _Run(row["words"], row["ids"], row["pieces"])
            bits = dict(zip(right["bucket"].to_pylist(), right["bits"].to_pylist()))
            good = [np.empty(0, _U)]
            for b, prints, _ in run.prints(longest, radix):
                if b in bits:
                    good.append(prints[np.unpackbits(unpack(bits[b], np.uint8), count=len(prints)).astype(bool)])
            good = np.concatenate(good)
            for size in range(1, longest + 1):
                found, n = run.counts(size, good)
                phrases.append(pa.array(found, pa.binary()).cast(pa.string()))
                sizes.append(np.full(len(n), size))
                counts.append(n)
        lang = left["lang"][0].as_py() if len(left) else None
        total = sum(map(len, counts))
        return pa.table(
            [pa.array([lang] * total, pa.string()), pa.chunked_array(phrases, pa.string()), pa.array(np.concatenate([np.empty(0, np.int32), *sizes]).astype(np.int32)),
             pa.array(np.concatenate([np.empty(0, np.int64), *counts]).astype(np.int64))],
            names=["lang", "phrase", "words", "f"],
        )

    return work


def frequent(
    docs: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS, lang_col: str = "lang", text_col: str = "text", most: int = FLUSH, chunk: int = CHUNK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): the exact count f of every word and phrase (lang, phrase, words) found
    ``least`` times or more, written, and the number of words n of each language."""
    rows = encoded(docs, lang_col, text_col, most, chunk)
    radix = shuffle_partitions(docs)
    parts = written(rows.groupBy("lang", "shard").agg(F.sum("n").alias("part")), "collocations-shares")
    totals = parts.groupBy("lang").agg(F.sum("part").alias("n"))
    # the shard's share of the support, rounded up
    need = parts.join(totals, "lang").select("lang", "shard", F.expr(f"cast({least} * cast(part as decimal(18,0)) + n - 1 as decimal(30,0)) div n").alias("need"))
    sent = _sent(rows.join(need, ["lang", "shard"]).select("lang", "shard", "run", "need", "words", "ids", "pieces"), longest, radix)
    cell = ["lang", "shard", "bucket"]
    mined = sent.groupBy(*cell).applyInArrow(_mined, "lang string, bucket int, frequent binary")
    union = mined.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(SHARDS - 1))))
    answers = sent.groupBy(*cell).cogroup(union.groupBy(*cell)).applyInArrow(_answered, "run long, bucket int, bits binary")
    counted = rows.select("run", "lang", "words", "ids", "pieces").groupBy("run").cogroup(answers.groupBy("run"))
    found = counted.applyInArrow(_counted(longest, radix), "lang string, phrase string, words int, f long")
    return written(found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "collocations-frequent"), totals


def collocations(
    docs: DataFrame, least: int = MIN_COUNT, longest: int = MAX_WORDS, top: int = TOP, contained: int = CONTAINED, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases."""
    phrases, totals = frequent(docs, least, longest, lang_col, text_col)
    return ranked(phrases, totals, top, contained)


def ranked(phrases: DataFrame, totals: DataFrame, top: int = TOP, contained: int = CONTAINED) -> DataFrame:
    """The best phrases by their worst cut, without those that mostly occur inside a longer one."""
    candidates = phrases.where("words > 1").withColumn("w", F.split("phrase", " "))
    part = lambda a, b: f"array_join(slice(w, {a}, {b}), ' ')"
    longer = candidates.where("words > 2").select(
        "lang", F.col("f").alias("longer"), "w", F.explode(F.expr("sequence(2, words - 1)")).alias("size")
    ).select("lang", "longer", "w", "size", F.explode(F.expr("sequence(1, size(w) - size + 1)")).alias("at"))
    longer = longer.select("lang", "longer", F.expr(part("at", "size")).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = candidates.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < contained * F.col("f"), F.lit(True)))
    cuts = left.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.expr("sequence(1, words - 1)")).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.expr(part("1", "cut")).alias("first"), F.expr(part("cut + 1", "size(w) - cut")).alias("rest")
    )
    count = lambda phrase, f: phrases.select("lang", F.col("phrase").alias(phrase), F.col("f").alias(f))
    cuts = cuts.join(count("first", "l"), ["lang", "first"]).join(count("rest", "r"), ["lang", "rest"])
    big = lambda c: f"cast({c} as decimal(15,0))"
    score = F.expr(f"({big('a')} * {big('a')} * cast({SCALE} as decimal(7,0))) div ({big('l')} * {big('r')})")
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c"))
    rows = worst.select("lang", "phrase", "a", "c.l", "c.r", "c.score").join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
