"""Document fingerprints: SimHash over weighted words. DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.storage import global_rank, written

BLANK = r"[\x20\x09-\x0D]+"
#: A fingerprint is two longs.
HALVES = ("f0", "f1")
BITS = 128
_LANES = 0x0000000100000001


def words_of(text: Column) -> Column:
    """Lower-case words; an empty one may lead or trail and weighs nothing."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), BLANK)


def _weight(word: Column) -> Column:
    """1 to 16, by the square of the length: long words are rare ones. 0 for none."""
    length = F.least(F.length(word), F.lit(16))
    return F.coalesce(((length * length + 15) / 16).cast("long"), F.lit(0).cast("long"))


def fingerprints(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys``, ``f0``, ``f1``: a 128-bit SimHash of the text of each distinct key.

    Each word's hash votes with the word's weight on every bit, for 1 or for 0;
    a bit is set if the votes for 1 outweigh the others. Votes for two bits share a
    long (lanes of 32 bits, enough for any text Spark can hold), and are summed by
    one hash aggregate that combines a text's words before the shuffle. Rows that
    repeat a key with its text change nothing: votes scale. A text without words,
    or a null, has no bit set.
    """
    voted = texts.select(*keys, F.explode_outer(words_of(F.col(text_col))).alias("_word"))
    voted = voted.select(
        *keys,
        _weight(F.col("_word")).alias("_w"),
        F.xxhash64("_word").alias("_h0"),
        F.xxhash64(F.lit(1), F.col("_word")).alias("_h1"),
    )
    sums = [
        F.sum(
            F.shiftrightunsigned(f"_h{half}", i).bitwiseAND(F.lit(_LANES)) * F.col("_w")
        ).alias(f"_s{half}_{i}")
        for half in (0, 1)
        for i in range(32)
    ]
    votes = voted.groupBy(*keys).agg(F.sum("_w").alias("_all"), *sums)

    def half(k: int) -> Column:
        bits = []
        for i in range(32):
            lanes = F.col(f"_s{k}_{i}")
            for place, ones in ((i, lanes.bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftright(lanes, 32))):
                bits.append(
                    F.shiftleft(F.when(ones * 2 > F.col("_all"), 1).otherwise(0).cast("long"), place)
                )
        while len(bits) > 1:  # a balanced tree: expressions nest 7 deep, not 64
            bits = [reduce(Column.bitwiseOR, bits[i : i + 2]) for i in range(0, len(bits), 2)]
        return bits[0]

    return votes.select(*keys, half(0).alias("f0"), half(1).alias("f1"))


def as_text(*halves: Column) -> Column:
    """32 hexadecimal digits."""
    return F.concat(*[F.lpad(F.lower(F.hex(h)), 16, "0") for h in halves])


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Number of bits that differ."""
    return reduce(lambda x, y: x + y, [F.bit_count(p.bitwiseXOR(q)) for p, q in zip(a, b)])


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return 1 - distance(a, b) / F.lit(float(BITS))


def _block_masks(radius: int, spare: int) -> list[tuple[int, int]]:
    """One pair of masks for each choice of ``spare`` blocks out of ``radius + spare``.

    Fingerprints that differ in ``radius`` bits at most differ in as many blocks at
    most, so some ``spare`` blocks agree: under one of the masks they are equal.
    """
    n = radius + spare
    edges = [round(BITS * i / n) for i in range(n + 1)]
    masks = []
    for chosen in combinations(range(n), spare):
        bits = {b for c in chosen for b in range(edges[c], edges[c + 1])}
        pair = [sum(1 << b for b in range(64) if b + 64 * k in bits) for k in (0, 1)]
        masks.append(tuple(m - (1 << 64) if m >> 63 else m for m in pair))
    return masks


def _masked(halves: list[Column], masks: tuple[int, int]) -> list[Column]:
    return [h.bitwiseAND(F.lit(m)) for h, m in zip(halves, masks)]


def _tabled(prints: DataFrame, names: tuple[str, str], masks: list[tuple[int, int]]) -> DataFrame:
    """Distinct fingerprints under a key for each table; ``_table`` is its number."""
    halves = [F.col(h) for h in HALVES]
    keys = [
        F.struct(F.lit(i).alias("t"), F.xxhash64(F.lit(i), *_masked(halves, m)).alias("k"))
        for i, m in enumerate(masks)
    ]
    rows = prints.select(*HALVES).distinct().select("*", F.explode(F.array(*keys)).alias("_e"))
    renamed = [F.col(h).alias(n) for h, n in zip(HALVES, names)]
    return rows.select(*renamed, F.col("_e.t").alias("_table"), F.col("_e.k").alias("_key"))


def find_within(
    queries: DataFrame, fingerprints: DataFrame, radius: int = 3, spare: int = 1
) -> DataFrame:
    """All fingerprints within ``radius`` bits of each query fingerprint.

    Both tables have ``f0``, ``f1``; equal fingerprints are looked at once. Returns
    ``q0``, ``q1``, ``f0``, ``f1``, ``bits``, a row for each pair of distinct
    values, equal ones included. Every fingerprint is put under one key for each of
    the permuted tables (four of 32 bits with the defaults; ``spare=2`` gives more
    and longer ones, for more than some billion fingerprints); queries look up
    their own keys. The join itself decides by the distance, and takes a pair in the first
    of the tables it agrees in, so only what was asked for comes out.
    """
    masks = _block_masks(radius, spare)
    left = _tabled(queries, ("q0", "q1"), masks)
    right = _tabled(fingerprints, HALVES, masks).withColumnRenamed("_table", "_other")
    differ = [F.col(q).bitwiseXOR(F.col(f)) for q, f in zip(("q0", "q1"), HALVES)]
    agree = [reduce(Column.bitwiseOR, _masked(differ, m)) == 0 for m in masks]
    first = reduce(lambda rest, i: F.when(agree[i], i).otherwise(rest), range(len(masks) - 1, -1, -1), F.lit(-1))
    bits = F.bit_count(differ[0]) + F.bit_count(differ[1])
    same = (F.col("_key") == F.col("_same")) & (F.col("_table") == F.col("_other"))
    right = right.withColumnRenamed("_key", "_same")
    found = left.join(right, same & (bits <= radius) & (F.col("_table") == first))
    return found.select("q0", "q1", *HALVES, bits.alias("bits"))


def with_near_rows(
    prints: DataFrame, queries: Column, radius: int = 3, spare: int = 1
) -> DataFrame:
    """``near_rows`` for the rows that ``queries`` is true for, null for the others.

    It is the number of other rows whose fingerprint is within ``radius`` bits.
    """
    asked = prints.filter(queries).select(*HALVES)
    copies = prints.groupBy(*HALVES).agg(F.count(F.lit(1)).alias("_copies"))
    near = (
        find_within(asked, prints, radius, spare)
        .join(copies, list(HALVES))
        .groupBy(F.col("q0").alias("f0"), F.col("q1").alias("f1"))
        .agg(F.sum("_copies").alias("_near"))
    )
    counted = prints.join(near, list(HALVES), "left")
    return counted.withColumn("near_rows", F.when(queries, F.col("_near") - 1)).drop("_near")


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness.

    The edited text has the last third of its code points (rounded down) replaced
    by the first as many, or all, of the next document's: the next smaller id, after
    the last the first. Null text is empty. Null ids come after the others. Rows
    that repeat an id are taken in the order of a hash of their texts; rows that
    are wholly equal count as one document in that order and each get its result.
    A table of one document is its own next. Other columns are not read.

    The order is made on (id, hash, length) alone. A text is shuffled once, to meet
    its neighbours' keys, and the leading part that the neighbour needs once more.
    """
    number, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    # The hash knows whether the id is null, so the key has no null in it.
    rows = docs.select(
        F.coalesce(number, F.lit(0)).alias("_id"),
        F.xxhash64(number.isNull(), text).alias("_hash"),
        number.alias("doc_id"),
        text.alias("_text"),
    )
    key = ["_id", "_hash"]
    narrow = rows.groupBy(*key, "doc_id").agg(
        F.max(F.length("_text")).cast("long").alias("n_chars"), F.count(F.lit(1)).alias("_copies")
    )
    # Descending ids, null last, as ascending order.
    narrow = narrow.withColumn("_null", F.col("doc_id").isNull())
    narrow = narrow.withColumn("_down", F.bitwise_not("_id"))
    order = written(global_rank(narrow, ["_null", "_down", "_hash"], "_rank"), "order")
    total = max(order.count(), 1)
    following = order.select(
        F.pmod(F.col("_rank") - 1, F.lit(total)).alias("_rank"),
        F.col("_id").alias("_next_id"),
        F.col("_hash").alias("_next_hash"),
    )
    links = order.select(*key, "doc_id", "n_chars", "_copies", "_rank").join(following, "_rank")
    links = written(links.drop("_rank"), "links")
    need = links.select(
        F.col("_next_id").alias("_id"),
        F.col("_next_hash").alias("_hash"),
        F.col("_id").alias("_to_id"),
        F.col("_hash").alias("_to_hash"),
        F.expr("n_chars div 3").cast("int").alias("_take"),
    )
    rows = rows.drop("doc_id")
    heads = (
        rows.join(need, key)
        .select(
            F.col("_to_id").alias("_id"),
            F.col("_to_hash").alias("_hash"),
            F.substring("_text", F.lit(1), F.col("_take")).alias("_head"),
        )
        .groupBy(*key)
        .agg(F.first("_head").alias("_head"))
    )
    cut = (F.col("n_chars") - F.expr("n_chars div 3")).cast("int")
    joined = rows.join(links.select(*key, "n_chars"), key).join(heads, key)
    edited = joined.select(
        *key, "_text", F.concat(F.substring("_text", F.lit(1), cut), F.col("_head")).alias("_edited")
    )
    both = edited.withColumn("edited_sha256", F.sha2("_edited", 256)).select(
        *key,
        "edited_sha256",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("kind"), F.col("_text").alias("text")),
                F.struct(F.lit(1).alias("kind"), F.col("_edited").alias("text")),
            )
        ).alias("_v"),
    )
    both = both.select(
        *key, "edited_sha256", F.col("_v.kind").alias("_kind"), F.col("_v.text").alias("_t")
    )
    prints = fingerprints(both, [*key, "edited_sha256", "_kind"], "_t")
    of = lambda kind, half: F.max(F.when(F.col("_kind") == kind, F.col(half)))
    prints = prints.groupBy(*key, "edited_sha256").agg(
        of(0, "f0").alias("f0"),
        of(0, "f1").alias("f1"),
        of(1, "f0").alias("e0"),
        of(1, "f1").alias("e1"),
    )
    prints = written(prints, "prints")
    after = prints.select(
        F.col("_id").alias("_next_id"),
        F.col("_hash").alias("_next_hash"),
        F.col("f0").alias("n0"),
        F.col("f1").alias("n1"),
    )
    linked = prints.join(links, key).join(after, ["_next_id", "_next_hash"])
    own, new, nxt = [tuple(F.col(f"{c}{i}") for i in (0, 1)) for c in "fen"]
    return linked.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(*own).alias("fingerprint"),
        as_text(*new).alias("edited_fingerprint"),
        likeness(own, new).alias("near_edited"),
        likeness(own, nxt).alias("near_next"),
        *HALVES,
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"),
    ).drop("_copy")
