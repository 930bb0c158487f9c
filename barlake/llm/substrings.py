"""Substring dedup by fixed-block anchors: repeated word windows lose all but their first document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.exchange import (
    KIND,
    Keys,
    answer,
    answers_of_kind,
    ask,
    bucket_count,
    chunked,
    met,
    pack,
    request_rows,
    unpack,
)
from barlake.llm.words import (
    covered,
    fits,
    hashed,
    kept_texts,
    pieces,
    span_lists,
    split_words,
    utf8,
    window_hashes,
)

#: Bytes of a word with the gap after it, to size the buckets by.
WORD_BYTES = 6
_LAST = np.iinfo(np.int64).max
_OUT = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<start:long,end:long>>"


def _ids(rows: pa.Table) -> np.ndarray:
    return rows.column("doc_id").fill_null(_LAST).to_numpy()


class _Windows:
    """Windows of one chunk."""

    def __init__(self, rows: pa.Table, window: int, buckets: int):
        self.window, self.block = window, (window + 1) // 2
        self.ids = _ids(rows)
        text = rows.column("text").combine_chunks()
        self.words, self.row_at = hashed(text)
        counts = np.diff(self.row_at)
        self.starts = fits(self.row_at, window)
        # Blocks can matter where a whole window fits in the document.
        places = fits(self.row_at, self.block)
        row = np.searchsorted(self.row_at[1:], places, side="right")
        long = counts[row] >= window
        self.places, row = places[long], row[long]
        hashes = window_hashes(self.words, self.block)[self.places]
        self.probes = Keys(hashes, buckets)
        self._aligned = (self.places - self.row_at[row]) % self.block == 0

    def probe_flags(self) -> np.ndarray:
        """1: a reference block has the key; 2: several places have it."""
        flags = (self.probes.counts > 1).astype(np.uint8) * 2
        flags[self.probes.inverse[self._aligned]] |= 1
        return flags

    def extend(self, hit: np.ndarray, buckets: int) -> None:
        """Whole windows around the hits: their keys, and the smallest document of each."""
        at_place = np.zeros(len(self.words) + 1, np.int64)
        at_place[self.places + 1] = hit[self.probes.inverse]
        upto = np.cumsum(at_place)
        span = self.window - self.block + 1
        near = upto[np.minimum(self.starts + span, len(self.words))] > upto[self.starts]
        self.starts = self.starts[near]
        row = np.searchsorted(self.row_at[1:], self.starts, side="right")
        self.owner = self.ids[row]
        self.whole = Keys(window_hashes(self.words, self.window)[self.starts], buckets, 64)
        self.smallest = np.full(len(self.whole.values), _LAST)
        np.minimum.at(self.smallest, self.whole.inverse, self.owner)

    def removed(self, elsewhere: np.ndarray) -> np.ndarray:
        """Words to remove; ``elsewhere``: another chunk has the window in a smaller document."""
        inverse = self.whole.inverse
        gone = elsewhere[inverse].astype(bool) | (self.smallest[inverse] < self.owner)
        return covered(self.starts[gone], self.window, len(self.words))


def _hits(values: np.ndarray, _owner: np.ndarray, extras: list[bytes]) -> np.ndarray:
    """Keys that are a reference block and have another place."""
    flags = np.concatenate([unpack(x, np.uint8) for x in extras])
    distinct, inverse = np.unique(values, return_inverse=True)
    places = np.bincount(inverse, 1 + (flags >> 1), minlength=len(distinct))
    block = np.bincount(inverse, flags & 1, minlength=len(distinct))
    return ((places > 1) & (block > 0))[inverse].astype(np.uint8)


def _smaller(values: np.ndarray, _owner: np.ndarray, extras: list[bytes]) -> np.ndarray:
    """Keys that a smaller document has than the smallest of the chunk that asks."""
    ids = np.concatenate([unpack(x, np.int64) for x in extras])
    distinct, inverse = np.unique(values, return_inverse=True)
    smallest = np.full(len(distinct), _LAST)
    np.minimum.at(smallest, inverse, ids)
    return (smallest[inverse] < ids).astype(np.uint8)


def remove_repeated_windows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50
) -> DataFrame:
    """Remove words covered by a window that also starts in a document of a smaller id.

    Words are what stands between ASCII blanks, unchanged; a window is ``window``
    consecutive words of one document; windows are judged on the input.

    Non-overlapping blocks of half a window, counted from each document's start, are
    the reference: any window contains a whole one. Every rolling window of a
    block's length probes them, also in its own document. Where a probe meets a
    block from another place, the hit is extended to the whole windows around it,
    and these are compared among all documents by a 64-bit hash: consecutive ones
    that agree make up a maximal exact repeat. So no two texts are ever paired, and
    a passage that many documents share costs each of them its own windows.

    Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (kept words joined by
    one space) and ``removed`` (word ranges), a row for each input row. Null or
    empty texts have no words. A null id counts as larger than all others; rows that
    repeat an id are not smaller than each other. An empty table gives an empty one.
    Other columns are not read. One text must fit in a task's memory some ten times.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chunks = chunked(slim, "text")
    buckets = bucket_count(chunks, 1 / WORD_BYTES)

    def probe(chunk: int, rows: pa.Table) -> pa.Table:
        found = _Windows(rows, window, buckets)
        flags = found.probe_flags()
        return request_rows(chunk, found.probes, lambda part: pack(flags[part]))

    hits = answer(ask(chunks, probe), [(_hits, 32)], "hits")

    def extend(chunk: int, rows: pa.Table, got: dict[int, bytes]) -> pa.Table:
        found = _Windows(rows, window, buckets)
        found.extend(found.probes.answers(got, np.uint8), buckets)
        return request_rows(chunk, found.whole, lambda part: pack(found.smallest[part]))

    windows = met(chunks, hits, extend, "bucket int, chunk long, asked binary, extra binary")
    smaller = answer(windows, [(_smaller, 64)], "smaller")
    both = hits.unionByName(smaller.withColumn("bucket", F.col("bucket") + KIND))

    def remove(_chunk: int, rows: pa.Table, got: dict[int, bytes]) -> pa.Table:
        found = _Windows(rows, window, buckets)
        found.extend(found.probes.answers(got, np.uint8), buckets)
        gone = found.removed(found.whole.answers(answers_of_kind(got, 1), np.uint8))
        text, out, at = rows.column("text").combine_chunks(), [], 0
        for first, last in pieces(text):
            words = split_words(*utf8(text.slice(first, last - first)))
            mine = gone[at : at + len(words.start)]
            at += len(words.start)
            before = np.concatenate([[0], np.cumsum(mine)])[words.row_at]
            out.append(
                pa.table(
                    {
                        "doc_id": rows.column("doc_id").slice(first, last - first).combine_chunks(),
                        "n_words": pa.array(words.per_row, pa.int64()),
                        "n_removed": pa.array(np.diff(before), pa.int64()),
                        "kept": pa.array(kept_texts(words, ~mine), pa.binary()).cast(pa.string()),
                        "removed": span_lists(mine, words.row_at),
                    }
                )
            )
        return pa.concat_tables(out)

    return met(chunks, both, remove, _OUT)
