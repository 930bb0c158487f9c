"""Quality: multiple-instance learning with gated attention over a document's passages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.llm.words import BLANKS, LOWER, Rolling, Words, byte_values, pieces, split_words, utf8

#: Words of a passage.
PASSAGE = 64
#: Labelled rows that the model is fitted on, at most, and passages of all of them together.
SAMPLE, PASSAGES = 8_000, 100_000
#: Places for words and for shapes of words, and other numbers of a passage.
WORDS, SHAPES, NUMBERS = 1024, 256, 9
WIDTH = WORDS + SHAPES + NUMBERS
#: Numbers of a passage's representation and of a gate.
CODE, GATE = 16, 8

# Kinds of bytes: lower case, upper case, digits and other than ASCII are one each; a mark is its own.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[0x61:0x7B] = 0x61
_KIND[0x41:0x5B] = 0x41
_KIND[0x30:0x3A] = 0x30
_KIND[0x80:] = 0x80
_MARK = np.ones(128, bool)
_MARK[[*range(0x21), *range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), 0x7F]] = False
_IS_MARK = np.concatenate([_MARK, np.zeros(128, bool)])


@dataclass
class Passages:
    """Of the passages of some texts: hash places of words and their shapes, and numbers.

    ``first`` has the index of each text's first passage, and their number; ``word_at``
    that of each passage's first word, and theirs.
    """

    first: np.ndarray
    word_at: np.ndarray
    words: np.ndarray
    shapes: np.ndarray
    numbers: np.ndarray

    def __len__(self) -> int:
        return len(self.word_at) - 1

    def dense(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """A row of ``WIDTH`` numbers for each passage of a range."""
        at = self.word_at[low : len(self) + 1 if high is None else high + 1]
        n, sizes = len(at) - 1, np.diff(at)
        out = np.zeros((n, WIDTH), np.float32)
        passage = np.repeat(np.arange(n), sizes)
        share = (1 / np.maximum(sizes, 1))[:, None]
        words, shapes = self.words[at[0] : at[-1]], self.shapes[at[0] : at[-1]]
        words = np.bincount(passage * WORDS + words, minlength=n * WORDS).reshape(n, WORDS)
        shapes = np.bincount(passage * SHAPES + shapes, minlength=n * SHAPES).reshape(n, SHAPES)
        out[:, :WORDS] = words * share
        out[:, WORDS : WORDS + SHAPES] = shapes * share
        out[:, WORDS + SHAPES :] = self.numbers[low : low + n]
        return out


def _shape_hashes(words: Words) -> np.ndarray:
    """Of each word's kinds of bytes, runs of one kind counted once."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    kind = _KIND[words.data]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[words.start] = True
    upto = np.cumsum(new)
    return Rolling(byte_values(kind[new]))(upto[words.start] - 1, upto[words.end - 1])


def passages(text: pa.Array) -> Passages:
    """Each whole text cut into passages of ``PASSAGE`` words; without words it has an empty one."""
    data, at = utf8(text)
    words = split_words(data, at, BLANKS)
    lower = Rolling(byte_values(LOWER[data]))(words.start, words.end)
    per_row = words.per_row
    per_text = np.maximum(1, -(-per_row // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per_text)])
    n = int(first[-1])
    inside = np.arange(n) - np.repeat(first[:-1], per_text)
    start = np.repeat(words.row_at[:-1], per_text) + inside * PASSAGE
    word_at = np.append(start, len(lower))
    sizes = np.diff(word_at)
    passage = np.repeat(np.arange(n), sizes)

    def summed(values: np.ndarray) -> np.ndarray:
        return np.bincount(passage, values, minlength=n)

    upto = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    counted = [upto(x) for x in (
        (data >= 0x41) & (data < 0x5B), _IS_MARK[data], (data >= 0x30) & (data < 0x3A), data >= 0x80,
    )]
    size = words.end - words.start
    n_bytes = np.maximum(summed(size), 1)
    again = np.zeros(len(lower), bool)
    again[1:] = (lower[1:] == lower[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((lower, passage))
    new = np.ones(len(order), bool)
    new[1:] = (lower[order][1:] != lower[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    lines = upto(data == 0x0A)
    breaks = np.zeros(len(lower))
    breaks[1:] = lines[words.start[1:]] > lines[words.end[:-1]]
    n_words = np.maximum(sizes, 1)
    numbers = np.stack(
        [summed(c[words.end] - c[words.start]) / n_bytes for c in counted]
        + [
            summed(again) / n_words,
            summed(new) / n_words,  # distinct ones; the order of passages is that of words
            np.minimum(summed(size) / n_words / 10, 3),
            summed(breaks) / n_words,
            np.log1p(sizes) / np.log1p(PASSAGE),
        ],
        1,
    )
    shapes = _shape_hashes(words)
    return Passages(
        first,
        word_at,
        (lower % np.uint64(WORDS)).astype(np.int64),
        (shapes % np.uint64(SHAPES)).astype(np.int64),
        numbers.astype(np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Bags:
    """Documents as bags of encoded passages.

    A passage's numbers ``x`` become a code ``h = tanh(x E + e)``; its attention is the softmax, over the
    document, of ``(tanh(h V) * sigmoid(h U)) w``; the sum of codes by attention gives the score.
    """

    weights: dict[str, np.ndarray]

    def encode(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.weights["E"] + self.weights["e"])

    def forward(self, h: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, sizes = self.weights, np.diff(first)
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        raw = (t * g) @ p["w"]
        top = np.maximum.reduceat(raw, first[:-1])
        a = np.exp(raw - np.repeat(top, sizes))
        a /= np.repeat(np.add.reduceat(a, first[:-1]), sizes)
        z = np.add.reduceat(h * a[:, None], first[:-1])
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["b"])}

    def gradient(
        self, x: np.ndarray, first: np.ndarray, slope: np.ndarray, f: dict[str, np.ndarray]
    ) -> dict[str, np.ndarray]:
        """Of the loss by each weight; ``slope`` is that by the score before its squashing."""
        p, sizes = self.weights, np.diff(first)
        h, t, g, a, z = (f[k] for k in "htgaz")
        each = np.repeat(slope, sizes)
        dh = each[:, None] * a[:, None] * p["c"]
        # How much a passage's share moves the score.
        draw = each * a * ((h - np.repeat(z, sizes, axis=0)) @ p["c"])
        dt = draw[:, None] * p["w"] * g * (1 - t * t)
        dg = draw[:, None] * p["w"] * t * g * (1 - g)
        dh += dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - h * h)
        return {
            "E": x.T @ dx, "e": dx.sum(0), "V": h.T @ dt, "U": h.T @ dg,
            "w": (t * g).T @ draw, "c": z.T @ slope, "b": slope.sum(keepdims=True),
        }

    def read(self, text: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        """For each text its score, and the shares of its passages."""
        made = passages(text)
        # A long text's passages become codes a thousand at a time.
        blocks = [self.encode(made.dense(i, min(i + 1024, len(made)))) for i in range(0, len(made), 1024)]
        f = self.forward(np.concatenate(blocks), made.first)
        return f["y"].astype(float).round(6), np.split(f["a"], made.first[1:-1])


def new_bags(share: float, seed: int = 0) -> Bags:
    rng = np.random.default_rng(seed)
    normal = lambda *size: rng.normal(0, 1 / np.sqrt(size[0]), size).astype(np.float32)
    return Bags({
        # Shares are small numbers: their weights start larger than the width asks for.
        "E": rng.normal(0, 0.3, (WIDTH, CODE)).astype(np.float32), "e": np.zeros(CODE, np.float32),
        "V": normal(CODE, GATE), "U": normal(CODE, GATE), "w": normal(GATE),
        "c": normal(CODE), "b": np.array([np.log(share / (1 - share))], np.float32),
    })


def train(
    bags: list[Passages],
    label: np.ndarray,
    epochs: int = 12,
    updates: int = 1500,
    rate: float = 0.01,
    decay: float = 1e-5,
    batch: int = 64,
    seed: int = 0,
) -> Bags:
    """Logistic loss of the documents' labels by Adam; ``bags`` has one document each.

    All of them are gone through ``epochs`` times, few of them more often, until there were ``updates``.
    """
    epochs = max(epochs, -(-updates * batch // len(bags)))
    model, rng = new_bags(float(label.mean()), seed), np.random.default_rng(seed + 1)
    mean = {k: np.zeros_like(v) for k, v in model.weights.items()}
    square = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            mine = [bags[i] for i in order[at : at + batch]]
            x = np.concatenate([b.dense() for b in mine])
            first = np.concatenate([[0], np.cumsum([len(b) for b in mine])])
            f = model.forward(model.encode(x), first)
            slope = ((f["y"] - label[order[at : at + batch]]) / len(mine)).astype(np.float32)
            grads = model.gradient(x, first, slope, f)
            step += 1
            size = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, grad in grads.items():
                grad = grad + decay * model.weights[k]
                mean[k] += 0.1 * (grad - mean[k])
                square[k] += 0.001 * (grad * grad - square[k])
                model.weights[k] -= (size * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
    return model


def learnt_from(column: Column, divisor: int = 5, held_out: int = 0) -> Column:
    """Whether labels of this id may be learnt from."""
    return F.coalesce(F.crc32(column.cast("string")) % divisor != held_out, F.lit(False))


def _sampled(labels: DataFrame, id_col: str, label_col: str, sample: int) -> DataFrame:
    """``_id, _label, _order`` of ``sample`` rows at most, those whose ids hash lowest."""
    rows = labels.select(
        F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label")
    ).filter("_id IS NOT NULL AND _label IN (0, 1)")
    rows = rows.withColumn("_order", F.xxhash64(F.lit(11), "_id"))
    n = rows.count()
    if n > 2 * sample:
        # Twice the share asked for, so that not every partition sends a whole sample.
        rows = rows.filter(F.col("_order") < int((4 * sample / n - 1) * 2**63))
    return rows.orderBy("_order", "_label").limit(sample)


_BAG = "label int, words array<int>, shapes array<int>, numbers array<float>"


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    at_most: int = PASSAGES,
) -> Bags | float:
    """A model from labelled rows; the share of label 1 where there are not both labels.

    It is fitted on ``sample`` labelled rows at most, those whose ids hash lowest, and of these on
    as many, in that order, as have ``at_most`` passages together: so much fits on the driver,
    where the training runs. Texts become hash places and numbers where they are.
    Rows with a null id or label are left out; an id that is repeated is used with each of its texts and labels.
    With one label only the share has half a row added to either, so without any it is one half.
    """
    rows = _sampled(labels, id_col, label_col, sample)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    # The sample is bounded by its parameter.
    labelled = texts.join(F.broadcast(rows), "_id")
    n = F.greatest(F.lit(1), F.ceil(F.regexp_count("_text", F.lit(r"[^ \t-\r]+")) / PASSAGE))
    sized = labelled.select("_order", "_label", F.xxhash64("_text").alias("_hash"), F.coalesce(n, F.lit(1)).alias("_n"))
    # A row for each labelled document of the sample.
    upto = F.sum("_n").over(Window.orderBy("_order", "_label", "_hash"))
    over = sized.withColumn("_upto", upto).filter(F.col("_upto") > at_most)
    last = over.agg(F.min("_order")).first()[0]
    if last is not None:
        labelled = labelled.filter(F.col("_order") < last)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in pieces(batch.column(0), 1 << 20):
                made = passages(batch.column(0).slice(first, end - first))
                at = made.word_at[made.first]
                lists = lambda edges, x, kind: pa.ListArray.from_arrays(
                    pa.array(edges, pa.int32()), pa.array(x, kind)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(first, end - first),
                        lists(at, made.words, pa.int32()),
                        lists(at, made.shapes, pa.int32()),
                        lists(made.first * NUMBERS, made.numbers.reshape(-1), pa.float32()),
                    ],
                    names=["label", "words", "shapes", "numbers"],
                )

    table = labelled.select("_text", "_label").mapInArrow(cut, _BAG).toArrow()
    label = table.column("label").to_numpy().astype(np.float32)
    if not 0 < label.sum() < len(label):
        return (float(label.sum()) + 0.5) / (len(label) + 1)
    bags = []
    for words, shapes, numbers in zip(*[table.column(i) for i in (1, 2, 3)]):
        numbers = numbers.values.to_numpy().reshape(-1, NUMBERS)
        words = words.values.to_numpy().astype(np.int64)
        word_at = np.minimum(np.arange(len(numbers) + 1) * PASSAGE, len(words))
        shapes = shapes.values.to_numpy().astype(np.int64)
        bags.append(Passages(np.array([0, len(numbers)]), word_at, words, shapes, numbers))
    # In an order of their own, so that reruns agree.
    order = sorted(range(len(bags)), key=lambda i: (label[i], bags[i].words.tobytes(), bags[i].numbers.tobytes()))
    return train([bags[i] for i in order], label[order])


def score(docs: DataFrame, model: Bags | float, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (0 to 1) of every whole text, in place.

    The text is all that a score depends on; scores have six decimals. A null or empty text, or one of
    blanks, has the score of one passage without words. An input column called ``name`` is
    replaced. An empty table gives an empty one. A text needs some thirty times its size in memory.
    """
    docs = docs.drop(name)
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 80 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col))
            scores = [np.zeros(0)]
            for first, last in pieces(text):
                scores.append(shared.value.read(text.slice(first, last - first))[0])
            yield batch.append_column(name, pa.array(np.concatenate(scores)))

    return docs.mapInArrow(run, T.StructType(list(docs.schema.fields)).add(name, "double"))
