"""Token counts of a unigram tokenizer, without making the tokens.

An Aho-Corasick automaton over the vocabulary finds all pieces that end at each
character; dynamic programming carries the best score and the number of pieces there.
Ties follow the tokenizers library: of equal scores the piece that begins first wins, a
character that no single piece covers is unknown and costs ten more than the worst
piece, and unknown characters count as their UTF-8 bytes if the vocabulary has byte
pieces (otherwise a run of them counts once).

No piece of a sentencepiece vocabulary has a space mark behind another character, so
the best path never crosses from a word into the space before the next: texts are cut
there, and each distinct cut piece is counted once per worker. A vocabulary that has
such pieces is refused.

The pieces given to op 3 are those of a sentencepiece BPE model, whose scores are merge
ranks: no unigram file is given, so they serve as a unigram vocabulary, and the counts are
not those of sentencepiece.

Null texts are empty; an empty text has no tokens. Repeated rows give repeated rows, an
empty table an empty result, and further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretoken import PieceTable, coded_chunks

MARK = "▁"
UNKNOWN_COST = 10.0


class Unigram:
    def __init__(self, pieces: dict[str, float], byte_fallback: bool = True):
        import ahocorasick

        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece has a space mark behind another character")
        self._matches = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self._matches.add_word(piece, (len(piece), score))
        self._matches.make_automaton()
        self._unknown = min(pieces.values()) - UNKNOWN_COST
        self._bytes = byte_fallback

    def count(self, text: str) -> int:
        """Number of tokens of the best segmentation of ``text``, spaces already marked."""
        n = len(text)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self._matches.iter(text)
        at, match = next(matches, (n, None))
        for end in range(n):
            best, pieces, single = None, 0, False
            while at == end:
                length, own = match
                begin = end + 1 - length
                single |= length == 1
                if best is None or score[begin] + own > best:
                    best, pieces = score[begin] + own, count[begin] + 1
                at, match = next(matches, (n, None))
            lost = False
            if not single and (best is None or score[end] + self._unknown > best):
                best, lost = score[end] + self._unknown, True
                pieces = count[end] + (len(text[end].encode("utf-8")) if self._bytes else not unknown[end])
            score[end + 1], count[end + 1], unknown[end + 1] = best, pieces, lost
        return count[n]

    def count_pieces(self, pieces: list[str]) -> list[list[int]]:
        return [[self.count(p.replace(" ", MARK))] for p in pieces]


def word_starts(points: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Places where a document begins or a space follows another character."""
    begin = np.zeros(len(points), dtype=bool)
    begin[docs[:-1][docs[:-1] < len(points)]] = True
    space = points == 0x20
    begin[1:] |= space[1:] & ~space[:-1]
    return np.flatnonzero(begin)


def vocabulary(path: str) -> tuple[dict[str, float], bool]:
    """Pieces and scores of a sentencepiece file, and whether it has byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = {model.id_to_piece(i): model.get_score(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
    return plain, any(model.is_byte(i) for i in ids)


@lru_cache(maxsize=2)
def _table(path: str) -> PieceTable:
    return PieceTable(Unigram(*vocabulary(path)).count_pieces)


def counted(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every text, a space put before it; row by row, without a shuffle."""

    def work(batches):
        table = _table(path)
        for batch in batches:
            text = pc.fill_null(batch.column(1), "")
            marked = pc.if_else(pc.equal(pc.binary_length(text), 0), text, pc.binary_join_element_wise(" ", text, ""))
            totals = np.zeros(len(text), np.int64)
            for row, counts, ends in coded_chunks(marked, table, word_starts):
                sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[ends]
                totals[row : row + len(ends) - 1] = np.diff(sums)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals)], names=[id_col, "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(work, f"`{id_col}` {kind}, n_tokens long")
