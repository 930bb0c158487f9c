"""Importance resampling towards a target's words, with distinct lines looked at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.hot import join_by_share
from barlake.llm.storage import global_rank, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: Column) -> Column:
    """Lines of a lower-cased text that are not empty; of a null text none."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lower, "\n", -1), lambda line: line != "")


def _words(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(WORD), F.lit(0))


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature) % buckets).cast("int")


def _starts(words: Column, length: int) -> Column:
    """Places (from 1) at which so many consecutive words start."""
    n = F.size(words) - (length - 1)
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _runs(items: Column, length: int) -> Column:
    """All runs of so many consecutive items."""
    return F.transform(_starts(items, length), lambda i: F.slice(items, i, length))


def _inside(words: Column, n: int, buckets: int) -> Column:
    """Buckets of all runs of 1 to ``n`` words of a line, with repeats."""
    runs = [F.transform(words, lambda w: _bucket(w, buckets))]
    for length in range(2, n + 1):
        runs.append(
            F.transform(_runs(words, length), lambda run: _bucket(F.array_join(run, " "), buckets))
        )
    return F.concat(*runs)


def _across(lines: Column, n: int, buckets: int) -> Column:
    """Buckets of the runs of 2 to ``n`` words that begin in one line and end in a later one.

    Only the ``n - 1`` words at either end of a line can be in such a run; of a longer
    line an empty word stands for the middle, and no run has it.
    """
    if n < 2:
        return F.array().cast("array<int>")
    side = n - 1

    def ends(words: Column, line: Column) -> Column:
        cut = F.when(
            F.size(words) > 2 * side,
            F.concat(F.slice(words, 1, side), F.array(F.lit("")), F.slice(words, -side, side)),
        ).otherwise(words)
        return F.transform(cut, lambda w: F.struct(w.alias("word"), line.alias("line")))

    ended = F.flatten(F.transform(lines, lambda line, i: ends(_words(line), i)))
    runs = []
    for length in range(2, n + 1):
        crossing = F.filter(
            _runs(ended, length),
            lambda run: (F.element_at(run, 1)["line"] != F.element_at(run, -1)["line"])
            & ~F.exists(run, lambda w: w["word"] == ""),
        )
        runs.append(
            F.transform(
                crossing,
                lambda run: _bucket(
                    F.array_join(F.transform(run, lambda w: w["word"]), " "), buckets
                ),
            )
        )
    return F.concat(*runs)


class Segmented:
    """A table's texts as distinct lines and where those occur, both written.

    ``lines`` has a row for each distinct line: ``key``, ``occurs``, ``n_words``,
    ``buckets`` (of its features, with repeats). ``rows`` has one for each text: ``_row``,
    the columns asked for, ``keys`` of its lines and ``across``, the buckets of features that
    cross from one line to a later one.
    """

    def __init__(self, docs: DataFrame, text_col: str, n: int, buckets: int, carry: Sequence[str]):
        self.buckets = buckets
        lines = _lines(F.col(text_col))
        self.rows = written(
            docs.select(
                F.monotonically_increasing_id().alias("_row"),
                *[F.col(c) for c in carry],
                F.transform(lines, _key).alias("keys"),
                _across(lines, n, buckets).alias("across"),
            ),
            "lined",
        )
        each = docs.select(F.explode(lines).alias("line")).groupBy("line")
        words = each.agg(F.count(F.lit(1)).alias("occurs")).withColumn("words", _words(F.col("line")))
        self.lines = written(
            words.select(
                _key(F.col("line")).alias("key"),
                "occurs",
                F.size("words").cast("long").alias("n_words"),
                _inside(F.col("words"), n, buckets).alias("buckets"),
            ),
            "lines",
        )

    def counts(self) -> DataFrame:
        """``bucket`` and ``n``: a distinct line's features times the line's occurrences, and those across."""
        inside = self.lines.select(F.explode("buckets").alias("bucket"), F.col("occurs").alias("n"))
        across = self.rows.select(F.explode("across").alias("bucket"), F.lit(1).cast("long").alias("n"))
        return inside.unionByName(across).groupBy("bucket").agg(F.sum("n").alias("n"))

    def weighed(self, gains: list[int], carry: Sequence[str]) -> DataFrame:
        """``_row``, the carried columns, ``n_features``, ``n_words`` and ``weight``, the sum of gains."""
        # One literal; the optimizer folds it into an array.
        table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<bigint>")

        def total(buckets: str) -> Column:
            return F.aggregate(
                buckets, F.lit(0).cast("long"), lambda sum_, b: sum_ + F.get(table, b)
            )

        lines = written(
            self.lines.select(
                "key",
                "occurs",
                "n_words",
                F.size("buckets").cast("long").alias("n_features"),
                total("buckets").alias("weight"),
            ),
            "line-weights",
        )
        occurs = lines.agg(F.sum("occurs")).first()[0] or 0
        there = self.rows.select("_row", F.explode("keys").alias("key"))
        sums = ["n_words", "n_features", "weight"]
        inside = join_by_share(there, lines, ["key"], "occurs", occurs).select(
            "_row", *[F.lit(None).cast(self.rows.schema[c].dataType).alias(c) for c in carry], *sums
        )
        own = self.rows.select(
            "_row",
            *carry,
            F.lit(0).cast("long").alias("n_words"),
            F.size("across").cast("long").alias("n_features"),
            total("across").alias("weight"),
        )
        # One row of each group has the carried values; the others have nulls.
        return (
            own.unionByName(inside)
            .groupBy("_row")
            .agg(*[F.max(c).alias(c) for c in carry], *[F.sum(c).alias(c) for c in sums])
        )


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """For each bucket ``floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))``.

    The tables hold ``bucket`` and ``n``; ``s``, ``t`` are the counts and ``S``, ``T`` their
    sums. As many numbers as there are buckets come to the driver.
    """
    both = (
        source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
        .unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
        .groupBy("bucket")
        .agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    )
    every = written(
        source.sparkSession.range(buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(both, "bucket", "left")
        .fillna(0.0, ["s", "t"]),
        "buckets",
    )
    sums = every.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    ratio = ((F.col("t") + 1) * F.lit(sums["s"] + buckets)) / (
        (F.col("s") + 1) * F.lit(sums["t"] + buckets)
    )
    gains = every.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))
    found = {r["bucket"]: r["gain"] for r in gains.collect()}
    return [found[b] for b in range(buckets)]


def noise(id_: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    n: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Documents drawn so that their hashed n-grams look like those of the target.

    Features are all runs of 1 to ``n`` consecutive words (runs of digits, ASCII letters
    in lower case, and whatever is not ASCII), hashed to ``buckets``. A bucket's gain is the
    log of how much more often the target has it, in thousandths, rounded down; a document's weight is the sum
    over its features, its score that and Gumbel noise, a hash of seed and id. Of the documents with
    ``least_words`` words, ``percent`` in a hundred are drawn, highest scores first: sampling
    without replacement with probabilities that go with the weights.

    Texts are cut into lines, and a distinct line is taken apart once, however often the
    corpus has it: its features count times its occurrences, its weight goes to each of
    them. Features that cross from a line to a later one are counted by themselves. A line is
    never cut, a word never holds a line's end. Lines meet in an aggregate with partial
    combining; weights go back by a join whose hot lines are broadcast; the order of the scores is a
    distributed one.

    Returns, for each input row, ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score``,
    ``rank`` (1, 2, 3..., null if not drawn) and the columns named in ``carry`` (of a type
    that ``max`` takes; not by those names). Null and empty texts have no features and weight 0. Equal scores go by the smaller id,
    null first; rows with equal ids have equal noise, each is drawn for itself, in any order
    where all is equal. An empty table gives an empty one, an empty target weighs by rarity alone. Other columns
    are not read, whatever their names. A text needs memory for its words, some twenty times its size.
    """
    aside = {c: f"_carry{i}" for i, c in enumerate(carry)}
    docs = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
        *[F.col(c).alias(name) for c, name in aside.items()],
    )
    kept = ["_id", *aside.values()]
    source = Segmented(docs, "_text", n, buckets, kept)
    wanted = Segmented(target.select(F.col(target_text_col).alias("_text")), "_text", n, buckets, [])
    gains = bucket_gains(source.counts(), wanted.counts(), buckets)
    scored = source.weighed(gains, kept).withColumn(
        "score", F.col("weight") + noise(F.col("_id"), seed)
    )
    able = F.col("n_words") >= least_words
    # Those that can be drawn come first.
    placed = global_rank(
        scored.withColumns({"_late": ~able, "_down": -F.col("score")}),
        ["_late", "_down", "_id", "_row"],
        "_place_of",
    )
    quota = placed.agg(F.count_if(~F.col("_late"))).first()[0] * percent // 100
    rank = F.when(F.col("_place_of") < quota, F.col("_place_of") + 1)
    return placed.select(
        F.col("_id").alias("doc_id"),
        "n_words",
        "n_features",
        "weight",
        "score",
        rank.alias("rank"),
        *[F.col(name).alias(c) for c, name in aside.items()],
    )
