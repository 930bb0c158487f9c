"""LM scoring: an n-gram model, of order two or three, smoothed by deleted interpolation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
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
    of_kind,
    pack,
    request_rows,
    unpack,
)
from barlake.llm.words import BLANKS, LOWER, hashed, scramble

#: Bytes of a word with the gap after it, to size the buckets by.
WORD_BYTES = 6
#: Parts of the documents.
TRAINED, TUNING, HELD_OUT = 0, 1, 2
#: Context counts are told apart by powers of two, 0 on its own.
LEVELS = 48
_END, _START = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)
#: Kinds of keys, and the bits that are sent of each after those that name the bucket.
_PAIRS, _WORDS, _TRIPLES = 0, 1, 2
_BITS = {_PAIRS: 64, _WORDS: 64, _TRIPLES: 32}
_FIRST = np.uint64(1 << 63)
#: Steps of the logarithms that the mixture weights are learned from, per factor of two, by the order: three
#: estimates side by side make many more combinations than two, and those come to the driver.
FINE = {2: 8, 3: 2}
_NEVER = -(1 << 20)
_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class _Tokens:
    """Tokens of a chunk: each text's words in lower case, then an end."""

    def __init__(self, rows: pa.Table, buckets: int, order: int = 2):
        words, row_at = hashed(rows.column("text").combine_chunks(), BLANKS, LOWER)
        n_rows = len(row_at) - 1
        self.tokens = np.insert(words, row_at[1:], _END)
        self.first = row_at[:-1] + np.arange(n_rows)
        self.counts = np.diff(row_at) + 1
        before = self._shifted(self.tokens, _START)
        pairs = scramble(scramble(before) + self.tokens)
        self.keys = {_PAIRS: pairs, _WORDS: self.tokens}
        if order > 2:
            # The first token of a text has no triple other than its pair.
            self.keys[_TRIPLES] = scramble(scramble(self._shifted(pairs, _START) + _START) + self.tokens)
        self.keys = {kind: Keys(values, buckets, _BITS[kind]) for kind, values in self.keys.items()}

    def _shifted(self, values: np.ndarray, first) -> np.ndarray:
        """For each token the value of the one before it; ``first`` at the beginning of a text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.first] = first
        return out

    def requests(self, chunk: int, trains: bool) -> pa.Table:
        tables = []
        for kind, keys in self.keys.items():
            counts = keys.counts.astype(np.uint64) * np.uint64(trains)
            asked = request_rows(chunk, keys, lambda part, counts=counts: pack(counts[part]))
            tables.append(of_kind(asked, kind))
        return pa.concat_tables(tables)

    def trained(self, got: dict[int, bytes], own: bool) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each token how often training has it after its contexts, and those: longest context first.

        The last is the token alone, without a context. Without ``own`` this chunk's counts are left out:
        what remains is held out from it.
        """
        found = {}
        for kind, keys in self.keys.items():
            counts = keys.answers(answers_of_kind(got, kind), np.uint64) & ~_FIRST
            counts = counts.astype(np.int64)
            if not own:
                counts -= keys.counts
            found[kind] = counts[keys.inverse]
        word, pair = found[_WORDS], found[_PAIRS]
        # A text starts as often as one ends.
        ends = word[self.first + self.counts - 1]
        context = self._shifted(word, ends)
        out = [(pair, context), (word, None)]
        if _TRIPLES in found:
            triple, two = found[_TRIPLES], self._shifted(pair, ends)
            triple[self.first] = pair[self.first]
            out.insert(0, (triple, two))
        return out


def _count(values: np.ndarray, _owner: np.ndarray, extras: list[bytes]) -> np.ndarray:
    """Occurrences in training; a flag for the first request of a trained key."""
    counts = np.concatenate([unpack(x, np.uint64) for x in extras])
    distinct, inverse = np.unique(values, return_inverse=True)
    total = np.zeros(len(distinct), np.uint64)
    np.add.at(total, inverse, counts)
    out = total[inverse]
    trained = np.flatnonzero(counts)
    _, first = np.unique(inverse[trained], return_index=True)
    out[trained[first]] |= _FIRST
    return out


def _vocabulary(counts: DataFrame) -> tuple[int, int]:
    """Number of distinct and of all training tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = tokens = 0
        for batch in batches:
            for answered in batch.column(0):
                values = unpack(answered.as_buffer().to_pybytes(), np.uint64)
                first = values[values >= _FIRST] & ~_FIRST
                kinds, tokens = kinds + len(first), tokens + int(first.sum())
        yield pa.RecordBatch.from_pydict({"kinds": [kinds], "tokens": [tokens]})

    words = counts.filter(F.col("bucket").between(_WORDS * KIND, (_WORDS + 1) * KIND - 1)).select("answer")
    sums = words.mapInArrow(run, "kinds long, tokens long")
    row = sums.agg(F.sum("kinds"), F.sum("tokens")).first()
    return int(row[0] or 0), int(row[1] or 0)


def _levels(context: np.ndarray) -> np.ndarray:
    """0 for contexts that were never seen, else 1 plus the whole part of the binary logarithm."""
    return np.frexp(np.maximum(context, 0).astype(float))[1].clip(0, LEVELS - 1)


def _context_level(estimates: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Which bucket of contexts a token is in: that of its longest context that was seen, by its frequency."""
    contexts = [context for _, context in estimates[:-1]]
    level = _levels(contexts[-1])
    for above, context in enumerate(reversed(contexts[:-1]), 1):
        level = np.where(context > 0, above * LEVELS + _levels(context), level)
    return level


def learn_weights(events: np.ndarray, floor: float = 1e-6, rounds: int = 100) -> np.ndarray:
    """Mixture weights by level, (longest context's estimate, ..., word, uniform), by expectation-maximisation.

    ``events`` has columns level, log-ratio of each estimate
    to the uniform one (in steps of ``FINE`` to a factor of two; never: not seen), number
    of held-out tokens. A level without tokens takes the weights of all of them.
    """
    n_estimates = events.shape[1] - 2

    def climb(rows: np.ndarray) -> np.ndarray:
        ratios = np.ones((len(rows), n_estimates + 1))
        for i in range(n_estimates):
            steps = rows[:, 1 + i]
            ratios[:, i] = np.where(steps == _NEVER, 0.0, np.exp2(steps / FINE[n_estimates]))
        n, weights = rows[:, -1].astype(float), np.full(n_estimates + 1, 1 / (n_estimates + 1))
        for _ in range(rounds):
            share = ratios * weights
            share /= share.sum(1, keepdims=True)
            weights = np.maximum((share * n[:, None]).sum(0) / n.sum(), floor)
            weights /= weights.sum()
        return weights

    pooled = climb(events) if len(events) else np.full(n_estimates + 1, 1 / (n_estimates + 1))
    out = np.tile(pooled, ((n_estimates - 1) * LEVELS, 1))
    for level in np.unique(events[:, 0]) if len(events) else []:
        out[level] = climb(events[events[:, 0] == level])
    # Contexts that were never seen, and levels of shorter ones, have no estimate of longer ones.
    for above in range(n_estimates - 1):
        levels = out[above * LEVELS : (above + 1) * LEVELS]
        levels[:, : n_estimates - 2 - above] = 0.0
        levels[0, : n_estimates - 1 - above] = 0.0
    return out / out.sum(1, keepdims=True)


def _events(
    chunks: DataFrame, counts: DataFrame, buckets: int, kinds: int, tokens: int, order: int = 2
) -> np.ndarray:
    """Held-out tokens by level and estimates, a row for each combination of steps that occurs.

    Steps are logarithms: there are some fifty of each with order 3 and some hundred and fifty with order 2, however large the
    corpus, and the levels double with a context's frequency. The table comes to the driver as Arrow.
    """

    def run(_chunk: int, rows: pa.Table, got: dict[int, bytes]) -> pa.Table:
        found = _Tokens(rows, buckets, order)
        estimates = found.trained(got, own=False)
        rest = max(1, tokens - len(found.tokens))

        def steps(estimate: np.ndarray) -> np.ndarray:
            some = estimate > 0
            logs = np.full(len(estimate), _NEVER)
            logs[some] = np.rint(FINE[order] * np.log2(estimate[some] * (kinds + 1)))
            return logs

        cells = [_context_level(estimates)]
        for count, context in estimates:
            cells.append(steps(count / (rest if context is None else np.maximum(context, 1))))
        cells, n = np.unique(np.stack(cells, 1), axis=0, return_counts=True)
        columns = {name: cells[:, i] for i, name in enumerate(names)}
        return pa.table({**columns, "n": n})

    names = ["level", *[f"e{i}" for i in range(order)]]
    tuned = chunks.filter(F.col("part") == TUNING)
    asked = counts.filter(F.col("chunk").bitwiseAND(F.lit(15)) == TUNING)
    cells = met(tuned, asked, run, ", ".join(f"{c} long" for c in [*names, "n"]))
    table = cells.groupBy(*names).agg(F.sum("n").alias("n")).toArrow()
    return np.stack([c.to_numpy() for c in table.columns], 1).astype(np.int64).reshape(-1, order + 2)


def score_texts(
    docs: DataFrame,
    part: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = 2,
) -> DataFrame:
    """Log10 probability of every text under a model of the training texts.

    ``part`` says what a row is: 0 trained on, 1 trained on and used to tune, 2 held
    out (other values and null: 0). Tokens are lower-cased (A-Z) words between ASCII blanks, then an end.
    The model mixes the maximum-likelihood estimates of a token after the two before it (with
    ``order`` 3), after the one
    before it and of the token alone with a uniform one over the vocabulary and one
    unknown token. The weights depend on how often the longest context that was seen was seen, by powers
    of two. They are learned by expectation-maximisation on the tuning texts, each
    chunk of which is judged by the counts of all others (its own are deleted).

    All training texts are counted, words, pairs and triples, with nothing cut off: each
    chunk sends its distinct ones with their counts and gets the totals back. Words and pairs are told
    apart by 64 bits, triples by 32 and those of their bucket's name, of which about one in ten thousand
    has another one's count added to its own. A text needs some fifteen times its size in memory.

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (tokens that
    training has), ``train_tokens``, ``base_score`` (words alone, one added to each
    count) and ``score``, a row for each input row. Null text is empty: it has the
    end only. Null and repeated ids are kept. An empty table gives an empty one; without
    training texts every token is unknown. Other columns are not read.
    """
    if order not in (2, 3):
        raise ValueError("order must be 2 or 3")
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.when(part.isin(TUNING, HELD_OUT), part).otherwise(TRAINED).cast("int").alias("part"),
    )
    chunks = chunked(slim, "text", "part")
    buckets = bucket_count(chunks, 1 / WORD_BYTES)

    def request(chunk: int, rows: pa.Table) -> pa.Table:
        return _Tokens(rows, buckets, order).requests(chunk, chunk & 15 != HELD_OUT)

    looks = [(_count, _BITS[kind]) for kind in sorted(_BITS)]
    counts = answer(ask(chunks, request), looks, "counts")
    kinds, tokens = _vocabulary(counts)
    weights = learn_weights(_events(chunks, counts, buckets, kinds, tokens, order))

    def score(chunk: int, rows: pa.Table, got: dict[int, bytes]) -> pa.Table:
        found = _Tokens(rows, buckets, order)
        estimates = found.trained(got, own=True)
        word = estimates[-1][0]
        share = weights[_context_level(estimates)]
        chance = share[:, -1] / (kinds + 1)
        for i, (count, context) in enumerate(estimates):
            chance += share[:, i] * count / (max(tokens, 1) if context is None else np.maximum(context, 1))
        base = np.log10((word + 1) / (tokens + kinds + 1))
        sums = lambda x: np.add.reduceat(x, found.first)
        n = rows.num_rows
        return pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "held_out": pa.array(np.full(n, chunk & 15 == HELD_OUT)),
                "n_tokens": pa.array(found.counts, pa.int64()),
                "n_known": pa.array(sums((word > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array(np.full(n, tokens), pa.int64()),
                "base_score": sums(base),
                "score": sums(np.log10(chance)),
            }
        )

    return met(chunks, counts, score, _SCORED)
