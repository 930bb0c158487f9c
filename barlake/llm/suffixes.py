"""Substring dedup: prefix doubling over anchored positions, ranked by Spark's sorts.

Ranking every byte position would shuffle several times the corpus. Two things keep that small and the
result exact, up to collisions of 64-bit hashes:

* Only some positions are ranked. Of the positions that a ``length``-byte
  window begins with, the one whose next ``SEED`` bytes hash lowest is its anchor.
  The choice depends on the window's own bytes, so equal windows have their
  anchors at the same place in them, and consecutive windows mostly share theirs.
* A position leaves as soon as its rank is its own. The first round sorts positions by a key of their first bytes;
  each later one sorts pairs of the rank so far and a key of as many bytes again after those, until the
  longest prefix that any window of an anchor must have is ranked. As texts are at hand, the key of the
  bytes at an offset stands for the rank of the position there. A chunk sends a prefix once for each
  of two contexts at most, however often it has it.

What is left are prefixes that several places share. The context of an anchor is all its windows together. Where that
is repeated, all its windows are, which an exchange of contexts tells; where it is unique but its prefix's
rank is shared, the anchor's windows are compared one by one at the full length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.exchange import (
    KIND,
    Keys,
    answer,
    answers_of_kind,
    ask,
    bucket_count,
    chunked,
    met,
    of_kind,
    pack,
    request_rows,
    rows_of,
    unpack,
)
from barlake.llm.storage import written
from barlake.llm.words import Rolling, byte_values, covered, pieces, scramble, span_lists, utf8

SEED = 16
_ASKED = "bucket int, chunk long, asked binary, extra binary"
#: Kinds of keys.
_PREFIXES, _CONTEXTS, _WINDOWS = 0, 1, 2
_REPEATED, _FIRST = 1, 2


def _span(length: int) -> int:
    """How many window starts share the choice of an anchor: a power of two."""
    return 1 << max(0, (length // 3).bit_length() - 1)


class _Anchors:
    """Anchors of some texts: position, first and last start of the windows they stand for."""

    def __init__(self, text: pa.Array, length: int):
        self.length = length
        self.data, self.at = utf8(text)
        n = len(self.data)
        self.rolling = Rolling(byte_values(self.data))
        reach = _span(length)
        seed = min(SEED, length - reach + 1)
        values = scramble(self.rolling.windows(seed))
        # The low half holds the position: the minimum names where it is, the first of equal ones.
        best = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64)
        step = 1
        while step < reach and len(best) > step:
            best = np.minimum(best[:-step], best[step:])
            step *= 2
        ends = np.repeat(self.at[1:], np.diff(self.at))
        starts = np.flatnonzero(np.arange(n) + length <= ends)
        if not len(starts):
            self.place = self.first = self.last = starts
            return
        chosen = (best[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
        edge = np.flatnonzero(new)
        self.place, self.first = chosen[edge], starts[edge]
        self.last = starts[np.append(edge[1:], len(starts)) - 1]

    def prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the bytes after the anchor that are in all windows it may stand for: a hash, and keys of the
        first quarter, the second and the half after them (a row each)."""
        whole = self.length - _span(self.length) + 1
        edges = [0, -(-whole // 4), -(-whole // 2), whole]
        parts = [self.rolling(self.place + a, self.place + b) for a, b in zip(edges, edges[1:])]
        keys = np.stack([(p >> np.uint64(32)).astype(np.uint32) for p in parts])
        return self.rolling(self.place, self.place + whole), keys

    def contexts(self) -> np.ndarray:
        """Hash of the bytes of all windows of the anchor and of where it is in them."""
        around = self.rolling(self.first, self.last + self.length)
        lead = (self.place - self.first).astype(np.uint64)
        return scramble(around + lead * np.uint64(0x9E3779B97F4A7C15))

    def window_hashes(self, starts: np.ndarray) -> np.ndarray:
        return self.rolling(starts, starts + self.length)


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers from each first to its last, end to end."""
    sizes = last - first + 1
    if not len(sizes):
        return np.zeros(0, np.int64)
    jump = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return jump + np.arange(sizes.sum())


class _Chunk:
    """Anchors of a chunk, gone through a piece (or one text) at a time."""

    def __init__(self, rows: pa.Table, length: int, buckets: int, wide: int):
        self.text = rows.column("text").combine_chunks()
        self.length, self.wide = length, wide
        self.cuts = list(pieces(self.text))
        none = np.zeros(0, np.uint64)
        prefixes, contexts, self.sizes = [none], [none], []
        keys = [np.zeros((3, 0), np.uint32)]
        for a in self.parts():
            prefix, parts = a.prefixes()
            prefixes.append(prefix)
            keys.append(parts)
            contexts.append(a.contexts())
            self.sizes.append(len(a.place))
        self._contexts = np.concatenate(contexts)
        self._keys = np.concatenate(keys, 1)
        # Distinct prefixes, numbered by their hash.
        _, self._first, self.number = np.unique(
            np.concatenate(prefixes), return_index=True, return_inverse=True
        )
        self.contexts = Keys(self._contexts, buckets, 64)

    def parts(self):
        for first, last in self.cuts:
            yield _Anchors(self.text.slice(first, last - first), self.length)

    def positions(self, chunk: int) -> pa.RecordBatch:
        """A row of keys for each distinct prefix, with one of its contexts; another row if it has others."""
        marks = (self._contexts >> np.uint64(32)).astype(np.uint32)
        n = len(self._first)
        least = np.full(n, 0xFFFFFFFF, np.uint32)
        np.minimum.at(least, self.number, marks)
        most = np.zeros(n, np.uint32)
        np.maximum.at(most, self.number, marks)
        rows = np.concatenate([np.arange(n), np.flatnonzero(least != most)])
        mark = np.concatenate([least, most[least != most]]).astype(np.int64)
        first, second, third = self._keys[:, self._first[rows]].astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(first),
                pa.array(second << 32 | third),
                pa.array(mark),
                pa.array(np.full(len(rows), chunk)),
                pa.array(rows.astype(np.int32)),
            ],
            names=["rank", "ahead", "mark", "chunk", "number"],
        )

    def requests(self, chunk: int) -> pa.Table:
        """The contexts."""
        many = (self.contexts.counts > 1).astype(np.uint8)
        return of_kind(request_rows(chunk, self.contexts, lambda p: pack(many[p])), _CONTEXTS)

    def looked_up(self, got: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor whether its context is repeated, and whether it is to be compared.

        To be compared are contexts that share their prefix with others; of a repeated
        one only the first copy of all.
        """
        shared = np.zeros(len(self._first), bool)
        if _PREFIXES * KIND in got:
            shared[unpack(got[_PREFIXES * KIND], np.uint32)] = True
        codes = self.contexts.answers(answers_of_kind(got, _CONTEXTS), np.uint8)
        inverse = self.contexts.inverse
        first = np.zeros(len(inverse), bool)
        first[np.unique(inverse, return_index=True)[1]] = True
        first &= codes[inverse] & _FIRST > 0
        return codes[inverse] & _REPEATED > 0, first & shared[self.number]

    def windows(self, repeated: np.ndarray, compare: np.ndarray):
        """Piece by piece: anchors, which of them are repeated, starts of the windows to compare."""
        at = 0
        for a, n in zip(self.parts(), self.sizes):
            mine = compare[at : at + n]
            yield a, repeated[at : at + n], _ranges(a.first[mine], a.last[mine])
            at += n

    def compared(self, repeated: np.ndarray, compare: np.ndarray) -> Keys:
        found = [a.window_hashes(starts) for a, _, starts in self.windows(repeated, compare)]
        return Keys(np.concatenate([np.zeros(0, np.uint64), *found]), self.wide, 64)


_RANKED = "rank long, ahead long, mark long, chunk long, number int"


def _reranked(last: bool):
    """Over rows sorted by pair: those whose pair is not their own, with its new rank.

    ``last`` keeps, of each pair, the rows if it has several contexts; rows of a pair are sorted by
    those then. The new rank is where a pair's rows begin in the sorted order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, task = 0, TaskContext.get().partitionId() << 40
        open_rows: list[pa.RecordBatch] = []  # the pair at hand: the first row, or those of one context
        open_key, open_at, open_mark, emitted = None, 0, None, False

        def out(rows: pa.RecordBatch, ranks: np.ndarray) -> pa.RecordBatch:
            return rows.set_column(0, "rank", pa.array(ranks, pa.int64()))

        for batch in batches:
            if not batch.num_rows:
                continue
            rank, key, mark = (batch.column(c).to_numpy() for c in ("rank", "key", "mark"))
            new = np.ones(len(rank), bool)
            new[1:] = (rank[1:] != rank[:-1]) | (key[1:] != key[:-1])
            new[0] = open_key != (rank[0], key[0])
            starts = np.flatnonzero(new)
            edges = np.concatenate([[0] if not new[0] else [], starts, [len(rank)]]).astype(np.int64)
            rows = batch.drop_columns(["key"])
            # The pair that goes on from the batch before.
            if not new[0]:
                n = int(edges[1])
                apart = not last or mark[n - 1] != open_mark
                if apart:
                    for held in open_rows:
                        yield out(held, np.full(held.num_rows, task + open_at))
                    open_rows, emitted = [], True
                if emitted or apart:
                    yield out(rows.slice(0, n), np.full(n, task + open_at))
                else:
                    open_rows.append(rows.slice(0, n))
                edges = edges[1:]
            if len(edges) > 1:
                sizes = np.diff(edges)
                if last:
                    good = mark[edges[:-1]] != mark[edges[1:] - 1]
                else:
                    good = sizes > 1
                good[-1] = False  # may go on in the next batch
                keep = np.repeat(good, sizes)
                picked = np.flatnonzero(keep) + edges[0]
                if len(picked):
                    ranks = np.repeat(edges[:-1] + at, sizes)[keep] + task
                    yield out(rows.take(pa.array(picked)), ranks)
                begin = int(edges[-2])
                open_key, open_at, open_mark = (rank[-1], key[-1]), at + begin, mark[begin]
                tail = rows.slice(begin)
                several = mark[begin] != mark[-1] if last else tail.num_rows > 1
                emitted, open_rows = bool(several), [] if several else [tail]
                if several:
                    yield out(tail, np.full(tail.num_rows, task + open_at))
            at += len(rank)

    return run


def _ranked_prefixes(positions: DataFrame) -> DataFrame:
    """``chunk`` and ``number`` of the prefixes that have several contexts, by prefix doubling.

    ``positions`` has a key of the first bytes as ``rank``, and ``ahead`` the keys for the next two rounds.
    """
    ahead = [F.lit(0).cast("long"), F.shiftright("ahead", 32), F.col("ahead").bitwiseAND(F.lit(0xFFFFFFFF))]
    for turn, key in enumerate(ahead):
        last = turn == len(ahead) - 1
        pair = ["rank", "key"]
        placed = positions.withColumn("key", key).repartition(*pair)
        placed = placed.sortWithinPartitions(*pair, *(["mark"] if last else []))
        positions = written(placed.mapInArrow(_reranked(last), _RANKED), "ranked")
    return positions.select("chunk", "number")


def _numbers(rows: pa.Table) -> pa.Table:
    """The prefix numbers of one chunk as an answer of their kind."""
    numbers = np.unique(rows.column("number").to_numpy()).astype(np.uint32)
    return pa.table(
        {
            "chunk": rows.column("chunk").slice(0, 1),
            "bucket": pa.array([_PREFIXES * KIND], pa.int32()),
            "answer": pa.array([pack(numbers)], pa.binary()),
        }
    )


def _places(values: np.ndarray, _owner: np.ndarray, extras: list[bytes]) -> np.ndarray:
    """Contexts at two places or more, and the first request of each."""
    many = np.concatenate([unpack(x, np.uint8) for x in extras])
    distinct, first, inverse = np.unique(values, return_index=True, return_inverse=True)
    places = np.bincount(inverse, 1 + many.astype(np.int64), minlength=len(distinct))
    out = ((places > 1) * np.uint8(_REPEATED))[inverse]
    out[first] |= _FIRST
    return out


def _repeats(values: np.ndarray, _owner: np.ndarray, extras: list[bytes]) -> np.ndarray:
    """Windows that start at two places or more."""
    many = np.concatenate([unpack(x, np.uint8) for x in extras])
    distinct, inverse = np.unique(values, return_inverse=True)
    places = np.bincount(inverse, 1 + many.astype(np.int64), minlength=len(distinct))
    return (places > 1)[inverse].astype(np.uint8)


def remove_repeated_substrings(
    docs: DataFrame, text_col: str = "text", length: int = 200, as_text: bool = False
) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that starts anywhere else too.

    Texts are UTF-8 bytes; matches do not cross documents but may be in one, may
    overlap, and are judged on the input. See the module for the method. Repeats are
    told by 64-bit hashes. A prefix that very many places share makes two entries a chunk at most;
    contexts are counted by themselves.

    Returns all columns of ``docs`` and ``_bytes`` (length of the text), ``_kept``
    (binary: the bytes left, where a code point may have lost a part; with ``as_text`` a
    string without such parts), ``_removed`` (byte ranges of the text), a row for each
    input row. Null and empty texts have no bytes. Copies of a row remove each other's
    bytes, if there are ``length``; ids play no part. An empty table gives an empty one.
    Input columns of the added names are replaced. One text must fit in a task's memory
    some fifty times.
    """
    if length < 2:
        raise ValueError("length must be 2 at least")
    docs = docs.drop("_bytes", "_kept", "_removed")
    chunks = chunked(docs, text_col)
    # An anchor in about half the span of starts that may share one.
    buckets = bucket_count(chunks, 2 / (_span(length) + 1))
    # Windows to compare one by one: an eighth of all starts would be many.
    wide = bucket_count(chunks, 1 / 8)
    schema = T.StructType(list(docs.schema.fields))
    span = T.StructType().add("start", "long").add("end", "long")
    schema.add("_bytes", "long").add("_kept", "string" if as_text else "binary").add("_removed", T.ArrayType(span))

    def slim(rows: pa.Table) -> pa.Table:
        return pa.table({"text": rows.column(text_col)})

    def first(chunk: int, rows: pa.Table) -> pa.Table:
        return _Chunk(slim(rows), length, buckets, wide).requests(chunk)

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield _Chunk(slim(rows_of(blob.as_buffer())), length, buckets, wide).positions(chunk)
                pa.default_memory_pool().release_unused()

    ranked = _ranked_prefixes(chunks.select("chunk", "rows").mapInArrow(positions, _RANKED))
    prefixes = ranked.groupBy("chunk").applyInArrow(_numbers, "chunk long, bucket int, answer binary")
    looks = [(_places, 64)] * (_CONTEXTS + 1)
    shared = answer(ask(chunks, first), looks, "contexts").unionByName(written(prefixes, "prefixes"))

    def second(chunk: int, rows: pa.Table, got: dict[int, bytes]) -> pa.Table:
        found = _Chunk(slim(rows), length, buckets, wide)
        keys = found.compared(*found.looked_up(got))
        return request_rows(chunk, keys, lambda p: pack((keys.counts[p] > 1).astype(np.uint8)))

    repeats = answer(met(chunks, shared, second, _ASKED), [(_repeats, 64)], "repeats")
    both = shared.unionByName(repeats.withColumn("bucket", F.col("bucket") + _WINDOWS * KIND))

    def last(_chunk: int, rows: pa.Table, got: dict[int, bytes]) -> pa.Table:
        found = _Chunk(slim(rows), length, buckets, wide)
        known = found.looked_up(got)
        keys = found.compared(*known)
        again = keys.answers(answers_of_kind(got, _WINDOWS), np.uint8)[keys.inverse] > 0
        out, at = [], 0
        for (begin, end), (a, repeated, starts) in zip(found.cuts, found.windows(*known)):
            mine = again[at : at + len(starts)]
            at += len(starts)
            gone = np.concatenate([_ranges(a.first[repeated], a.last[repeated]), starts[mine]])
            removed = covered(gone, length, len(a.data))
            upto = np.concatenate([[0], np.cumsum(~removed)])[a.at]
            left = pa.py_buffer(a.data[~removed].tobytes())
            kept = pa.Array.from_buffers(
                pa.binary(), end - begin, [None, pa.py_buffer(upto.astype(np.int32)), left]
            )
            if as_text:
                kept = pa.array([k.decode(errors="ignore") for k in kept.to_pylist()], pa.string())
            part = rows.slice(begin, end - begin)
            part = part.append_column("_bytes", pa.array(np.diff(a.at), pa.int64()))
            part = part.append_column("_kept", kept)
            out.append(part.append_column("_removed", span_lists(removed, a.at)))
        return pa.concat_tables(out)

    return met(chunks, both, last, schema)
