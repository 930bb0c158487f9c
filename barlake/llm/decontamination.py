"""Benchmark decontamination: a suffix automaton of the test items reads the training texts."""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.exchange import chunked, rows_of
from barlake.llm.storage import written
from barlake.llm.words import (
    LOWER,
    hashed,
    pieces,
    spans,
    split_words,
    utf8,
    window_hashes,
)

#: Text of the items that one automaton is built of (a block), in bytes.
BLOCK_BYTES = 1 << 20
#: Blocks whose automata are broadcast together, some ten megabytes each; larger benchmarks take
#: another pass over the documents for as many again.
AT_ONCE = 16

GAPS = np.ones(256, bool)
GAPS[0x30:0x3A] = GAPS[0x61:0x7B] = GAPS[0x80:] = False


class Automaton:
    """Generalised suffix automaton over the word hashes of some items.

    State 0 is the empty string. For each state: length of its longest string and
    the state of its longest proper suffix elsewhere; steps are one dictionary.
    """

    def __init__(self, items: list[tuple[int, np.ndarray]], window: int):
        self.window = window
        self.step: dict[tuple[int, int], int] = {}
        self.length, self.link = [0], [-1]
        self._out: list[list[int]] = [[]]
        sequences = [(item, words.tolist()) for item, words in items if len(words)]
        for _, words in sequences:
            last = 0
            for word in words:
                last = self._extend(last, word)
        del self._out
        # Items by the state of each of their windows; short ones by that of the whole.
        self.items_at: dict[int, set[int]] = defaultdict(set)
        self.short_at: dict[int, list[tuple[int, int]]] = defaultdict(list)
        lengths = [len(words) for _, words in sequences]
        self.shortest = min([window, *lengths])
        for item, words in sequences:
            for _, state, matched in self.walk(words):
                if matched >= window:
                    self.items_at[self.cut(state)].add(item)
            if len(words) < window:
                self.short_at[state].append((len(words), item))
        # A state knows the short items that end its strings: its own and its suffixes'.
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            inherited = self.short_at.get(self.link[state])
            if inherited:
                self.short_at[state] = self.short_at.get(state, []) + inherited
        self.grams = np.unique(
            np.concatenate(
                [np.zeros(0, np.uint64)]
                + [window_hashes(words, self.gram) for _, words in items if len(words) >= self.gram]
            )
        )

    @property
    def gram(self) -> int:
        """Length of the n-grams that tell which places can be part of a match at all."""
        return min(3, self.shortest)

    def _new(self, length: int, link: int, out: list[int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self._out.append(out)
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        known = self.step.get((last, word))
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, word)
        new = self._new(self.length[last] + 1, 0, [])
        at = last
        while at != -1 and (at, word) not in self.step:
            self.step[at, word] = new
            self._out[at].append(word)
            at = self.link[at]
        if at != -1:
            known = self.step[at, word]
            whole = self.length[known] == self.length[at] + 1
            self.link[new] = known if whole else self._split(at, known, word)
        return new

    def _split(self, at: int, known: int, word: int) -> int:
        copy = self._new(self.length[at] + 1, self.link[known], list(self._out[known]))
        for w in self._out[known]:
            self.step[copy, w] = self.step[known, w]
        self.link[known] = copy
        while at != -1 and self.step.get((at, word)) == known:
            self.step[at, word] = copy
            at = self.link[at]
        return copy

    def walk(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """Place, state and length of the longest match that ends there."""
        state = matched = 0
        for i, word in enumerate(words):
            while state and (state, word) not in self.step:
                state = self.link[state]
                matched = self.length[state]
            state = self.step.get((state, word), 0)
            matched = matched + 1 if state else 0
            yield i, state, matched

    def cut(self, state: int) -> int:
        """The state of the last ``window`` words of a match."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state


class Packed:
    """An automaton as flat arrays, to be broadcast and to read texts.

    Steps are sorted by state and word number; a step is looked up by bisection. ``ids`` has for each item of the
    automaton the ids of all items with its text.
    """

    def __init__(self, automaton: Automaton, ids: list[list[int | None]]):
        self.window, self.shortest = automaton.window, automaton.shortest
        self.gram, self.grams, self.ids = automaton.gram, automaton.grams, ids
        self.words = np.unique(np.array([w for _, w in automaton.step], np.uint64))
        states = np.array([s for s, _ in automaton.step], np.uint64)
        words = np.searchsorted(self.words, np.array([w for _, w in automaton.step], np.uint64))
        keys = (states << np.uint64(32)) | words.astype(np.uint64)
        order = np.argsort(keys)
        targets = np.array(list(automaton.step.values()), np.int32)[order]
        self.keys, self.targets = array("Q", keys[order].tobytes()), array("i", targets.tobytes())
        self.length, self.link = array("i", automaton.length), array("i", automaton.link)
        self.items_at = _Lists({s: sorted(items) for s, items in automaton.items_at.items()})
        self.short_at = _Lists(
            {s: [x for pair in pairs for x in pair] for s, pairs in automaton.short_at.items()}
        )

    def step(self, state: int, word: int) -> int:
        """The state after it, 0 if there is none."""
        key = state << 32 | word
        at = bisect_left(self.keys, key)
        return self.targets[at] if at < len(self.keys) and self.keys[at] == key else 0

    def walk(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """As that of the automaton, over numbers of words, -1 for those it has not."""
        state = matched = 0
        for i, word in enumerate(words):
            after = 0
            if word < 0:
                state = matched = 0
            else:
                after = self.step(state, word)
                while state and not after:
                    state = self.link[state]
                    matched = self.length[state]
                    after = self.step(state, word)
            state = after
            matched = matched + 1 if state else 0
            yield i, state, matched

    def cut(self, state: int) -> int:
        """The state of the last ``window`` words of a match."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def mark(self, words: np.ndarray, hit: np.ndarray) -> set[int | None]:
        """Sets the words inside item windows; returns the ids of the items they are from."""
        at = np.searchsorted(self.words, words)
        known = self.words[np.minimum(at, len(self.words) - 1)] == words
        found: set[int] = set()
        for i, state, matched in self.walk(np.where(known, at, -1).tolist()):
            if matched >= self.window:
                hit[i - self.window + 1 : i + 1] = True
                found.update(self.items_at[self.cut(state)])
            short = self.short_at[state] if state else ()
            for n, item in zip(short[::2], short[1::2]):
                if n <= matched:
                    hit[i - n + 1 : i + 1] = True
                    found.add(item)
        return {id_ for item in found for id_ in self.ids[item]}

    def search(
        self, words: np.ndarray, row_at: np.ndarray, hit: np.ndarray, items: dict[int, set]
    ) -> None:
        """Adds hit words of many texts, and the items of each text that has some.

        Only runs of places whose n-gram is one of the items' can hold a match; the
        automaton reads those.
        """
        if not len(self.grams) or len(words) < self.gram:
            return
        hashes = window_hashes(words, self.gram)
        at = np.searchsorted(self.grams, hashes)
        known = np.zeros(len(words), bool)
        known[: len(hashes)] = self.grams[np.minimum(at, len(self.grams) - 1)] == hashes
        ends = np.repeat(row_at[1:], np.diff(row_at))
        known &= np.arange(len(words)) + self.gram <= ends
        for row, start, end in zip(*spans(known, row_at)):
            if end - start + self.gram - 1 < self.shortest:
                continue
            first, last = row_at[row] + start, row_at[row] + end + self.gram - 1
            found = self.mark(words[first:last], hit[first:last])
            if found:
                items.setdefault(int(row), set()).update(found)


class _Lists:
    """Lists of numbers by state, in three arrays."""

    def __init__(self, lists: dict[int, list[int]]):
        states = sorted(lists)
        self.states = array("i", states)
        self.at = array("q", [0, *np.cumsum([len(lists[s]) for s in states]).tolist()])
        self.values = array("i", [x for s in states for x in lists[s]])

    def __getitem__(self, state: int):
        at = bisect_left(self.states, state)
        if at == len(self.states) or self.states[at] != state:
            return ()
        return self.values[self.at[at] : self.at[at + 1]]


def _block_count(items: DataFrame, text_col: str) -> int:
    total = items.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return int(total // BLOCK_BYTES) + 1


def _packed(
    items: DataFrame, item_col: str, text_col: str, block: int, n: int, window: int
) -> Packed:
    """The automaton of one of ``n`` blocks of items, dealt by a hash of their text.

    Equal texts come to the driver once, with the ids of all of them.
    """
    texts = items.select(F.struct(F.col(item_col).cast("long")).alias("i"), F.col(text_col).alias("t"))
    mine = F.pmod(F.xxhash64("t"), F.lit(n)) == block
    alike = texts.filter(F.col("t").isNotNull() & mine).groupBy("t")
    rows = alike.agg(F.collect_set("i").alias("ids")).collect()
    words, at = hashed(pa.array([r["t"] for r in rows], pa.string()), GAPS, LOWER)
    sequences = [(k, words[at[k] : at[k + 1]]) for k in range(len(rows))]
    return Packed(Automaton(sequences, window), [[i[0] for i in r["ids"]] for r in rows])


def _words_and_edges(text: pa.Array):
    data, at = utf8(text)
    return split_words(LOWER[data], at, GAPS)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
) -> DataFrame:
    """Find, and cut out, what the texts share with the test items.

    Words are runs of digits, letters and bytes above 0x7F, lower-cased (A-Z). A hit
    is a word inside an occurrence of ``window`` consecutive words of an item, or of
    the whole of an item that has fewer (but not none). A suffix automaton of the
    items tracks at each word the longest match that ends there.

    Returns all columns of ``docs`` and ``_words``, ``_hits`` (numbers of words),
    ``_items`` (distinct ids of items that occur, ascending, null last) and ``_kept``: the
    text without the spans of hit words (from the first to the last byte of each
    run), itself where nothing is hit, null where it is null. How many hits are too many is for the
    caller to say. Rows are not moved. Null and empty texts and items have no words;
    repeated rows and items are looked at each by itself; items with a null id count as one item.
    Empty tables are fine. Input columns of the added names are replaced. A text needs some ten times its size in
    memory.

    An automaton is built of at most ``BLOCK_BYTES`` of items (or one longer item), split by a hash of
    their texts, and packed; ``AT_ONCE`` of them are broadcast together and read each text one after the other.
    For a larger benchmark the documents are written once, in chunks; each pass over them keeps only the
    marks of the texts that it hits, and these meet their chunk in the end.
    """
    docs = docs.drop("_words", "_hits", "_items", "_kept")
    final = T.StructType(list(docs.schema.fields))
    final.add("_words", "long").add("_hits", "long").add("_items", T.ArrayType(T.LongType()))
    final.add("_kept", "string")
    blocks = _block_count(items, item_text_col)

    def automata(first: int):
        """Broadcast: the size of the blocks and their number are bounded."""
        numbers = range(first, min(first + AT_ONCE, blocks))
        packed = [_packed(items, item_col, item_text_col, b, blocks, window) for b in numbers]
        return docs.sparkSession.sparkContext.broadcast(packed)

    if blocks <= AT_ONCE:
        shared = automata(0)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, end in pieces(batch.column(text_col), 1 << 20):
                    part = batch.slice(first, end - first)
                    yield _finished(part, text_col, *_searched(part.column(text_col), shared.value))

        return docs.mapInArrow(run, final)

    chunks = chunked(docs, text_col)
    passes = [
        written(_marks(chunks, text_col, automata(first)), "marks")
        for first in range(0, blocks, AT_ONCE)
    ]
    marks = reduce(DataFrame.unionByName, passes)

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = rows_of(left.column("rows")[0].as_buffer()).combine_chunks()
        marked: dict[int, list[tuple]] = defaultdict(list)
        for r in right.select(["row", "marks", "found"]).to_pylist():
            marked[r["row"]].append((r["marks"], r["found"]))
        out = []
        for batch in rows.to_batches():
            for first, end in pieces(batch.column(text_col), 1 << 20):
                part = batch.slice(first, end - first)
                words, row_at = hashed(part.column(text_col), GAPS, LOWER)
                hit, found = np.zeros(len(words), bool), {}
                for row in range(part.num_rows):
                    for bits, ids in marked.get(row + first, ()):
                        span = slice(row_at[row], row_at[row + 1])
                        n = int(row_at[row + 1] - row_at[row])
                        hit[span] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
                        found.setdefault(row, set()).update(ids)
                out.append(_finished(part, text_col, hit, found, row_at))
        return pa.Table.from_batches(out)

    whole = chunks.select("chunk", "rows").groupBy("chunk")
    return whole.cogroup(marks.groupBy("chunk")).applyInArrow(both, final)


_MARKS = "chunk long, row int, marks binary, found array<long>"


def _marks(chunks: DataFrame, text_col: str, shared) -> DataFrame:
    """Of the rows that some automata hit: which words, as bits, and the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = rows_of(blob.as_buffer()).column(text_col).combine_chunks()
                for first, end in pieces(text, 1 << 20):
                    hit, items, row_at = _searched(text.slice(first, end - first), shared.value)
                    rows = sorted(items)
                    bits = [np.packbits(hit[row_at[r] : row_at[r + 1]]).tobytes() for r in rows]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([chunk] * len(rows), pa.int64()),
                            pa.array([r + first for r in rows], pa.int32()),
                            pa.array(bits, pa.binary()),
                            pa.array([list(items[r]) for r in rows], pa.list_(pa.int64())),
                        ],
                        names=["chunk", "row", "marks", "found"],
                    )

    return chunks.select("chunk", "rows").mapInArrow(run, _MARKS)


def _searched(text: pa.Array, automata: list[Packed]) -> tuple[np.ndarray, dict[int, set], np.ndarray]:
    """Hit words, items by row, and where each row's words start."""
    words, row_at = hashed(text, GAPS, LOWER)
    hit, items = np.zeros(len(words), bool), {}
    for automaton in automata:
        automaton.search(words, row_at, hit, items)
    return hit, items, row_at


def _finished(
    batch: pa.RecordBatch, text_col: str, hit: np.ndarray, items: dict[int, set], row_at: np.ndarray
) -> pa.RecordBatch:
    text, n = batch.column(text_col), batch.num_rows
    found = [sorted(items.get(r, ()), key=lambda i: (i is None, i)) for r in range(n)]
    upto = np.concatenate([[0], np.cumsum(hit)])
    hits = upto[row_at[1:]] - upto[row_at[:-1]]
    kept = text
    rows = np.flatnonzero(hits)
    if len(rows):
        where = _words_and_edges(text)
        row, start, end = spans(hit, row_at)
        drop = np.zeros(len(where.data) + 1, np.int64)
        np.add.at(drop, where.start[row_at[row] + start], 1)
        np.add.at(drop, where.end[row_at[row] + end - 1], -1)
        keep = np.cumsum(drop[:-1]) == 0
        data, at = utf8(text)
        cut = [data[at[r] : at[r + 1]][keep[at[r] : at[r + 1]]].tobytes().decode() for r in rows]
        kept = pc.replace_with_mask(text, pa.array(hits > 0), pa.array(cut, text.type))
    return (
        batch.append_column("_words", pa.array(np.diff(row_at), pa.int64()))
        .append_column("_hits", pa.array(hits, pa.int64()))
        .append_column("_items", pa.array(found, pa.list_(pa.int64())))
        .append_column("_kept", kept)
    )
