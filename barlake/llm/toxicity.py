"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.decontamination import GAPS
from barlake.llm.words import LOWER, Rolling, byte_values, hashed, pieces, scramble, split_words, utf8

#: Hash places of the terms.
PLACES = 1 << 18
#: Labelled rows that the model is fitted on, at most; see :func:`fit`.
SAMPLE = 50_000
#: Of these, rows whose pairs of words are screened; see :func:`select_pairs`.
PAIR_ROWS = 3_000
#: Words of a pair are less than this far apart.
NEAR = 16
#: Least hashes of a row's word triples that must differ from another's, all of them, for both to count.
SIGNS = 8
#: Rows that the decay is chosen on.
CHOICE_ROWS = 8_000
#: Rows that a pair must be in, and twice the log-likelihood ratio that it must reach.
PAIR_LEAST, PAIR_RATIO = 9, 40.0
#: A word in a larger share of the rows is in no pair.
COMMON = 0.6
#: Decays to choose from.
DECAYS = (1e-6, 1e-5, 1e-4, 1e-3, 1e-2)
#: A word counts as itself and as each beginning of so many bytes, which stand for its stem.
STEMS = (4, 5, 6, 7, 8)


def terms(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash place of each word and word beginning, with repeats."""
    rows, places, seen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for first, last in pieces(text, 1 << 20):
        data, at = utf8(text.slice(first, last - first))
        words = split_words(LOWER[data], at, GAPS)
        rolling = Rolling(byte_values(words.data))
        row, size = words.rows() + seen, words.end - words.start
        seen += last - first
        rows.append(row)
        places.append((rolling(words.start, words.end) % np.uint64(PLACES)).astype(np.int64))
        for stem in STEMS:
            longer = size > stem
            start = words.start[longer]
            # Another salt than whole words have.
            stems = rolling(start, start + stem) * np.uint64(2 * stem + 1) >> np.uint64(40)
            rows.append(row[longer])
            places.append((stems % np.uint64(PLACES)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(places)


def near_pairs(text: pa.Array, usable: np.ndarray) -> Iterator[np.ndarray]:
    """For each row its distinct pairs of usable words that stand near each other, packed.

    Only whole words count, by hash place; those between that are not usable are left out first.
    """
    for first, last in pieces(text, 1 << 20):
        hashes, row_at = hashed(text.slice(first, last - first), GAPS, LOWER)
        places = (hashes % np.uint64(PLACES)).astype(np.int64)
        for low, high in zip(row_at[:-1], row_at[1:]):
            mine = places[low:high]
            mine = mine[usable[mine]]
            sides = [(mine[:-d], mine[d:]) for d in range(1, min(NEAR, len(mine)))]
            if not sides:
                yield np.zeros(0, np.int64)
                continue
            a, b = (np.concatenate(side) for side in zip(*sides))
            pairs = np.unique(np.minimum(a, b) * PLACES + np.maximum(a, b))
            yield pairs[pairs // PLACES != pairs % PLACES]


def signatures(text: pa.Array) -> np.ndarray:
    """For each row ``SIGNS`` least hashes of its word triples (or of all its words, if it has fewer)."""
    out = [np.zeros((0, SIGNS), np.uint64)]
    for first, last in pieces(text, 1 << 20):
        hashes, row_at = hashed(text.slice(first, last - first), GAPS, LOWER)
        rolling = Rolling(hashes)
        signs = np.zeros((last - first, SIGNS), np.uint64)
        for row, (low, high) in enumerate(zip(row_at[:-1], row_at[1:])):
            starts = np.arange(low, max(low + 1, high - 2))
            triples = rolling(starts, np.minimum(starts + 3, high))
            for k in range(SIGNS):
                signs[row, k] = scramble(triples ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)).min()
        out.append(signs)
    return np.concatenate(out)


def one_of_alike(signs: np.ndarray) -> np.ndarray:
    """Numbers of the rows that share no sign with an earlier one, nor with one that is linked so."""
    group = np.arange(len(signs))

    def root(row: int) -> int:
        while group[row] != row:
            group[row] = group[group[row]]
            row = group[row]
        return row

    for column in signs.T:
        first: dict[int, int] = {}
        for row, sign in enumerate(column.tolist()):
            a, b = root(first.setdefault(sign, row)), root(row)
            group[max(a, b)] = min(a, b)
    return np.array([row for row in range(len(group)) if group[row] == row], np.int64)


def chosen_terms(text: pa.Array, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of each distinct term of a row that the model keeps, by row."""
    row, place = terms(text)
    number = index[place]
    kept = number >= 0
    pairs = np.unique(row[kept] * np.int64(PLACES) + number[kept].astype(np.int64))
    return pairs // PLACES, pairs % PLACES


@dataclass
class Machine:
    """``index``: number of the term at each hash place, -1 for none; the rest by term number."""

    index: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, row: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Bias, terms, and half of (square of the sum less sum of the squares) of their factors."""
        out = np.full(n, self.bias) + np.bincount(row, self.weights[term], minlength=n)
        for f in self.factors.T:
            out += 0.5 * np.bincount(row, f[term], minlength=n) ** 2
            out -= 0.5 * np.bincount(row, f[term] ** 2, minlength=n)
        return out

    def scores(self, text: pa.Array) -> np.ndarray:
        row, term = chosen_terms(text, self.index)
        return 1 / (1 + np.exp(-np.clip(self.raw(row, term, len(text)), -30, 30)))


def train(
    row: np.ndarray,
    term: np.ndarray,
    label: np.ndarray,
    index: np.ndarray,
    n_factors: int = 4,
    epochs: int = 40,
    rate: float = 0.2,
    decay: float = 1e-5,
    batch: int = 256,
    seed: int = 0,
) -> Machine:
    """Logistic loss, minibatches, per-parameter step sizes. ``row`` ascends."""
    n_terms = max(1, int(index.max()) + 1)
    rng = np.random.default_rng(seed)
    # The terms' own weights start at 0, the factors small and random.
    model = Machine(index, 0.0, np.zeros(n_terms), rng.normal(0, 0.01, (n_terms, n_factors)))
    seen_bias, seen_w = 1e-8, np.full(n_terms, 1e-8)
    seen_v = np.full((n_terms, n_factors), 1e-8)
    edges = np.searchsorted(row, np.arange(len(label) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            sizes = edges[rows + 1] - edges[rows]
            where = np.repeat(np.arange(len(rows)), sizes)
            first = np.cumsum(sizes) - sizes
            t = term[np.repeat(edges[rows], sizes) + np.arange(len(where)) - np.repeat(first, sizes)]
            guess = 1 / (1 + np.exp(-np.clip(model.raw(where, t, len(rows)), -30, 30)))
            slope = (guess - label[rows]) / len(rows)
            sums = np.stack([np.bincount(where, f[t], minlength=len(rows)) for f in model.factors.T], 1)
            touched, local = np.unique(t, return_inverse=True)
            by_term = lambda x: np.bincount(local, x, minlength=len(touched)) * 1.0
            g_w = by_term(slope[where]) + decay * model.weights[touched]
            g_v = np.stack(
                [
                    by_term(slope[where] * (sums[where, f] - model.factors[t, f]))
                    for f in range(n_factors)
                ],
                1,
            )
            g_v += decay * model.factors[touched]
            g_b = slope.sum()
            seen_bias += g_b**2
            model.bias -= rate * g_b / np.sqrt(seen_bias)
            seen_w[touched] += g_w**2
            model.weights[touched] -= rate * g_w / np.sqrt(seen_w[touched])
            seen_v[touched] += g_v**2
            model.factors[touched] -= rate / 4 * g_v / np.sqrt(seen_v[touched])
    return model


def select_terms(
    counts: np.ndarray,
    totals: np.ndarray,
    at_least: int = 3,
    paired: np.ndarray = np.zeros(0, np.int64),
) -> np.ndarray:
    """Term numbers by hash place, -1 for those left out.

    ``counts``: place, rows with label 0, rows with label 1. Kept are all places
    whose share of the labels differs from the whole by four standard deviations, the most
    different first, and those in ``paired``: words that tell something in a pair, whatever they
    tell alone. What neither tells by itself nor in a pair is noise to the machine: with all
    places kept it learns the rows it is fitted on by heart.
    """
    index = np.full(PLACES, -1, np.int32)
    if not len(counts) or not totals.all():
        return index
    n = counts[:, 1] + counts[:, 2]
    share = totals[1] / totals.sum()
    deviation = np.abs(counts[:, 2] - n * share) / np.sqrt(n * share * (1 - share))
    good = np.flatnonzero((n >= at_least) & (deviation >= 4))
    best = good[np.lexsort((counts[good, 0], -deviation[good]))]
    places = counts[best, 0]
    places = np.append(places, np.setdiff1d(paired, places))
    index[places] = np.arange(len(places))
    return index


def interacting(pairs: np.ndarray, n0: np.ndarray, n1: np.ndarray, share: np.ndarray, whole: float):
    """Which pairs have other shares of label 1 than their members let expect, by far.

    ``share`` is that of each place, ``whole`` of all rows. Expected is what two weights that add up would
    give; twice the log-likelihood ratio against that must reach ``PAIR_RATIO``, so that
    of the many pairs hardly one passes by chance.
    """
    logit = lambda p: np.log(np.clip(p, 1e-3, 0.999) / (1 - np.clip(p, 1e-3, 0.999)))
    added = logit(share[pairs // PLACES]) + logit(share[pairs % PLACES]) - logit(np.array(whole))
    expected = 1 / (1 + np.exp(-added))
    n = n0 + n1
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(n1 > 0, n1 * np.log(n1 / (n * expected)), 0)
        ratio += np.where(n0 > 0, n0 * np.log(n0 / (n * (1 - expected))), 0)
    return (n >= PAIR_LEAST) & (2 * ratio >= PAIR_RATIO)


def _words_by_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of either label that have the word at each place; all rows at -1."""
    for rows in _small(batches):
        label = rows.column(1).to_numpy(False)
        hashes, row_at = hashed(rows.column(0), GAPS, LOWER)
        row = np.repeat(np.arange(rows.num_rows), np.diff(row_at))
        pairs = np.unique(row * PLACES + (hashes % np.uint64(PLACES)).astype(np.int64))
        seen = [np.bincount(pairs[label[pairs // PLACES] == y] % PLACES, minlength=PLACES) for y in (0, 1)]
        places = np.flatnonzero(seen[0] + seen[1])
        totals = np.bincount(label, minlength=2)
        yield pa.RecordBatch.from_pydict(
            {
                "place": np.append(places, -1),
                "n0": np.append(seen[0][places], totals[0]),
                "n1": np.append(seen[1][places], totals[1]),
            }
        )


def select_pairs(labelled: DataFrame) -> np.ndarray:
    """Places of the words that interact with another one.

    ``labelled`` has a few thousand rows of ``_text``, ``_label`` and ``_order``. Of rows that are copies of each
    other, nearly or wholly, one counts, as all pairs of a text that is there twenty times would seem to tell its label. Pairs of
    near words are counted by
    Spark, combined in the tasks first; a pair that no additive rule foretells has both its members
    kept. As many places as there are come to the driver at most.
    """
    named = labelled.withColumn("_name", F.xxhash64("_order", "_label", "_text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in batches:
            signs = signatures(rows_.column(0))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(signs.view(np.int64).reshape(-1)), SIGNS)
            yield pa.RecordBatch.from_arrays(
                [rows_.column(1), lists.cast(pa.list_(pa.int64()))], names=["name", "signs"]
            )

    # A few thousand rows of eight numbers.
    signed = named.select("_text", "_name").mapInArrow(sign, "name long, signs array<long>").toArrow()
    signed = signed.sort_by("name")
    signs = np.array(signed.column("signs").to_pylist(), np.int64).reshape(-1, SIGNS)
    alone = signed.column("name").to_numpy()[one_of_alike(signs)]
    spark = labelled.sparkSession
    kept = spark.createDataFrame(pa.table({"_name": np.unique(alone)}))
    labelled = named.join(F.broadcast(kept), "_name", "left_semi")
    words = labelled.select("_text", "_label").mapInArrow(_words_by_label, "place long, n0 long, n1 long")
    words = words.groupBy("place").agg(F.sum("n0"), F.sum("n1")).toArrow()
    counts = np.stack([c.to_numpy() for c in words.columns], 1).reshape(-1, 3)
    totals = counts[counts[:, 0] == -1, 1:].sum(0)
    if not totals.all():
        return np.zeros(0, np.int64)
    counts, whole = counts[counts[:, 0] >= 0], totals[1] / totals.sum()
    share, rows = np.full(PLACES, whole), np.zeros(PLACES, np.int64)
    rows[counts[:, 0]] = counts[:, 1] + counts[:, 2]
    share[counts[:, 0]] = (counts[:, 2] + whole) / (rows[counts[:, 0]] + 1)
    usable = (rows >= PAIR_LEAST) & (rows <= COMMON * totals.sum())

    def batch(values: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=names)

    def flush(held: list[np.ndarray], labels: list[int]) -> pa.RecordBatch:
        label = np.repeat(np.array(labels, np.int64), [len(h) for h in held])
        pairs, inverse = np.unique(np.concatenate(held), return_inverse=True)
        # Rows with label 1 count in the upper half.
        n = np.bincount(inverse, minlength=len(pairs)) - np.bincount(inverse, label, minlength=len(pairs))
        ones = np.bincount(inverse, label, minlength=len(pairs)).astype(np.int64)
        return batch([pairs, n.astype(np.int64) + (ones << 32)], ["pair", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, labels, size = [], [], 0
        for rows_ in _small(batches):
            for found, label in zip(near_pairs(rows_.column(0), usable), rows_.column(1).to_pylist()):
                held.append(found)
                labels.append(label)
                size += len(found)
                if size >= 1 << 20:
                    yield flush(held, labels)
                    held, labels, size = [], [], 0
        if size:
            yield flush(held, labels)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_ in batches:
            pairs, n = (c.to_numpy(zero_copy_only=False) for c in rows_.columns)
            good = pairs[interacting(pairs, n & 0xFFFFFFFF, n >> 32, share, whole)]
            yield batch([np.unique(np.concatenate([good // PLACES, good % PLACES]))], ["place"])

    counted = labelled.select("_text", "_label").mapInArrow(count, "pair long, n long")
    found = counted.groupBy("pair").agg(F.sum("n").alias("n")).mapInArrow(judge, "place long")
    return np.sort(found.distinct().toArrow().column(0).to_numpy())


def log_loss(model: Machine, row: np.ndarray, term: np.ndarray, label: np.ndarray) -> float:
    guess = 1 / (1 + np.exp(-np.clip(model.raw(row, term, len(label)), -30, 30)))
    guess = np.clip(guess, 1e-9, 1 - 1e-9)
    return float(-np.mean(label * np.log(guess) + (1 - label) * np.log(1 - guess)))


def train_chosen(
    row: np.ndarray, term: np.ndarray, label: np.ndarray, index: np.ndarray, every: int = 4
) -> Machine:
    """A machine with the decay that does best on some rows when fitted on others; then fitted on all.

    ``CHOICE_ROWS`` rows are used to choose, one in ``every`` of them to judge.
    """
    # Rows are in the order of labels, so every so-manieth has both in their shares.
    some = np.arange(len(label)) % max(1, len(label) // CHOICE_ROWS) == 0
    aside = some & (np.cumsum(some) % every == 0)
    learnt = some & ~aside
    if len(np.unique(label[learnt])) < 2 or not aside.any():
        return train(row, term, label, index)

    def part(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kept = rows[row]
        return (np.cumsum(rows) - 1)[row[kept]], term[kept], label[rows]

    losses = [
        log_loss(train(*part(learnt), index, decay=d, epochs=10), *part(aside)) for d in DECAYS
    ]
    return train(row, term, label, index, decay=DECAYS[int(np.argmin(losses))])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> Machine:
    """A machine from labelled rows.

    It is fitted on ``sample`` labelled rows at most, those whose ids hash lowest, so
    that the rows, cut to the terms kept, fit on the driver. Rows with a null id or label are left out; an id that is
    repeated is used with each of its texts and labels. Terms are counted by Spark
    over these rows, pairs of near words over the first ``PAIR_ROWS`` of them; all terms that tell the labels apart, alone
    or in a pair, are kept (``PLACES`` bounds them), and only
    their numbers come to the driver, where the training runs. The decay is chosen on a part of the same rows. Without labels of
    both kinds, or terms that tell them apart, the score is the share of the toxic
    ones (half a row added), one half without any.
    """
    rows = labels.select(
        F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label")
    ).filter("_id IS NOT NULL AND _label IN (0, 1)")
    rows = rows.withColumn("_order", F.xxhash64(F.lit(7), "_id"))
    n = rows.count()
    if n > 2 * sample:
        # Twice the share asked for, so that not every partition sends a whole sample.
        rows = rows.filter(F.col("_order") < int((4 * sample / n - 1) * 2**63))
    rows = rows.orderBy("_order", "_label").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    # The sample is bounded by its parameter.
    labelled = texts.join(F.broadcast(rows), "_id").select("_text", "_label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, seen = np.zeros(2, np.int64), np.zeros((2, PLACES), np.int64)
        for batch in _small(batches):
            label = batch.column(1).to_numpy(False)
            totals += np.bincount(label, minlength=2)
            row, place = terms(batch.column(0))
            pairs = np.unique(row * np.int64(PLACES) + place)
            for y in (0, 1):
                mine = pairs[label[pairs // PLACES] == y] % PLACES
                seen[y] += np.bincount(mine, minlength=PLACES)
        places = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_pydict(
            {
                "place": np.append(places, -1),
                "n0": np.append(seen[0, places], totals[0]),
                "n1": np.append(seen[1, places], totals[1]),
            }
        )

    counted = labelled.mapInArrow(count, "place long, n0 long, n1 long")
    counted = counted.groupBy("place").agg(F.sum("n0"), F.sum("n1"))
    # A row for each hash place at most.
    found = np.stack([c.to_numpy() for c in counted.toArrow().columns], 1).reshape(-1, 3)
    totals = found[found[:, 0] == -1, 1:].sum(0)
    counts = found[found[:, 0] >= 0]
    paired = np.zeros(0, np.int64)
    if totals.all():
        some = rows.orderBy("_order", "_label").limit(PAIR_ROWS)
        paired = select_pairs(texts.join(F.broadcast(some), "_id"))
    index = select_terms(counts, totals, paired=paired)
    if not totals.all() or index.max() < 0:
        share = (totals[1] + 0.5) / (totals.sum() + 1)
        return Machine(index, float(np.log(share / (1 - share))), np.zeros(1), np.zeros((1, 1)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            row, term = chosen_terms(batch.column(0), index)
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(term, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(1), lists], names=["label", "terms"])

    table = labelled.mapInArrow(cut, "label int, terms array<int>").toArrow().combine_chunks()
    label = table.column("label").to_numpy().astype(float)
    lists = pa.concat_arrays(table.column("terms").chunks)
    flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    # In an order of their own, so that reruns agree.
    order = sorted(range(len(label)), key=lambda i: (label[i], flat[at[i] : at[i + 1]].tobytes()))
    row = np.repeat(np.arange(len(label)), np.diff(at)[order])
    term = np.concatenate([flat[:0], *[flat[at[i] : at[i + 1]] for i in order]]).astype(np.int64)
    return train_chosen(row, term, label[order], index)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of a megabyte of text (the first column), or of one row."""
    for batch in batches:
        for first, last in pieces(batch.column(0), 1 << 20):
            yield batch.slice(first, last - first)


def score(docs: DataFrame, model: Machine, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1) of every whole text, in place.

    The text is all that a score depends on. A null or empty text has the score of
    the bias alone. An input column called ``name`` is replaced. A text needs some thirty times its
    size in memory.
    """
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by PLACES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col))
            scores = [np.zeros(0)]
            for first, last in pieces(text, 1 << 20):
                scores.append(shared.value.scores(text.slice(first, last - first)))
            yield batch.append_column(name, pa.array(np.concatenate(scores)))

    return docs.mapInArrow(run, T.StructType(list(docs.schema.fields)).add(name, "double"))


def learnt_from(column: Column, divisor: int = 3, held_out: int = 1) -> Column:
    """Whether labels of this id may be learnt from."""
    return F.coalesce(F.crc32(column.cast("string")) % divisor != held_out, F.lit(False))
