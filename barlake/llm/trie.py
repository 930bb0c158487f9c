"""The trie of conversation prefixes, built as a burst trie.

A turn's id is 20 bytes: a digest of its role and text, and the size of the text. A
conversation is cut into segments of ``SEGMENT`` turns; a segment's ids joined are a
suffix, held under a trie head that stands for all turns before it. Equal suffixes under one
head are one entry, with the number and the smallest of their conversations. A container
of entries that is too large for its share bursts by the next turn id, until none is;
containers, dealt out by their heads, are sorted and swept into nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.hot import join_by_share
from barlake.llm.storage import PART_BITS, in_order, written

SEGMENT = 64
#: A container bursts if it has more entries than this and more than one in ``SHARES`` of all.
LEAST = 4096
#: So fewer containers than this burst in a round, which may then be broadcast.
SHARES = 1 << 16
#: Rows of one conversation that a running total takes together.
BLOCK = 4096
_ID = 20
_EMPTY = hashlib.sha256(b"").hexdigest()


def _turn_id(role: Column, text: Column) -> Column:
    """40 hex digits."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 8, "0"))


def ordered_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, position, id`` of all turns, and ``conv_id, n_turns`` of all conversations.

    Positions count from 0 in the order of ``turn``, null first, then of the turn's id. A sort
    over all rows and, for each conversation, the counts of the ranges it
    is in give them, so one conversation may have any share of the rows. Rows with a null ``conv_id`` belong to
    no conversation and are left out.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _turn_id(F.col("role"), F.col("text")).alias("id"),
    ).filter("conv_id IS NOT NULL")
    placed = in_order(rows, ["conv_id", "turn", "id"], "place").withColumn(
        "part", F.shiftright("place", PART_BITS)
    )
    counts = written(
        placed.groupBy("conv_id", "part").agg(
            F.count(F.lit(1)).alias("n"), F.min("place").alias("first")
        ),
        "counts",
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")
    )
    numbered = placed.join(starts, ["conv_id", "part"]).select(
        "conv_id", (F.col("place") + F.col("shift")).alias("position"), "id"
    )
    return written(numbered, "turns"), written(
        counts.groupBy("conv_id").agg(F.sum("n").alias("n_turns")), "conversations"
    )


def rebuilt(
    turns: DataFrame, conversations: DataFrame, group: int = 5, spread: int = 9
) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first one of their group does; tables as given.

    Conversation ``c`` gets the first ``h`` turns of ``c - c % group``, all if that has fewer, none if
    it has none, and then its own from the ``h``-th on; ``h`` is the CRC-32 of ``c`` in decimal,
    modulo ``spread``. Every conversation stays, some without any turn.
    """
    giver = F.col("conv_id") - F.col("conv_id") % group
    h = F.crc32(F.col("conv_id").cast("string")) % spread
    takes = conversations.select("conv_id", "n_turns", giver.alias("giver"), h.alias("h"))
    givers = conversations.select(F.col("conv_id").alias("giver"), F.col("n_turns").alias("has"))
    plan = written(
        takes.join(givers, "giver", "left")
        .withColumn("taken", F.least("h", F.coalesce("has", F.lit(0).cast("long"))))
        .withColumn("total", F.col("taken") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0)))
        .select("conv_id", "giver", "h", "taken", "total"),
        "rebuilt",
    )
    given = turns.filter((F.col("position") < spread) & (giver == F.col("conv_id")))
    given = given.withColumnRenamed("conv_id", "giver").join(
        plan.select("giver", "conv_id", "h"), "giver"
    )
    given = given.filter("position < h").select("conv_id", "position", "id")
    # Own turns are those of a conversation without its first, so all of a long one stay where they are:
    # what is added to a position is looked up for blocks of it.
    block = F.floor(F.col("position") / BLOCK).alias("block")
    shifts = turns.select("conv_id", block).distinct().join(plan, "conv_id")
    own = turns.select("*", block).join(
        shifts.select("conv_id", "block", "h", "taken"), ["conv_id", "block"]
    )
    own = own.filter("position >= h").select(
        "conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "id"
    )
    return given.unionByName(own), plan.select("conv_id", F.col("total").alias("n_turns"))


def _exclusive(
    rows: DataFrame, at: str, values: list[str], agg, both, zero: int = 0
) -> DataFrame:
    """``rows`` with ``_before_<value>``: what ``agg`` gives over the conversation's rows before.

    Rows are taken ``BLOCK`` places together, whose totals are added up by themselves, so a
    conversation with any share of the rows meets in no task.
    """
    rows = rows.withColumn("_block", F.floor(F.col(at) / BLOCK))
    ahead = lambda by, order: Window.partitionBy(*by).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = rows.groupBy("conv_id", "_block").agg(*[agg(v).alias(f"_all_{v}") for v in values])
    over = ahead(["conv_id"], "_block")
    nothing = F.lit(zero).cast("long")
    totals = totals.select(
        "conv_id",
        "_block",
        *[F.coalesce(agg(f"_all_{v}").over(over), nothing).alias(f"_blocks_{v}") for v in values],
    )
    inner = ahead(["conv_id", "_block"], at)
    found = rows.withColumns(
        {f"_inner_{v}": F.coalesce(agg(v).over(inner), nothing) for v in values}
    ).join(totals, ["conv_id", "_block"])
    return found.withColumns(
        {f"_before_{v}": both(F.col(f"_inner_{v}"), F.col(f"_blocks_{v}")) for v in values}
    ).drop("_block", *[f"_inner_{v}" for v in values], *[f"_blocks_{v}" for v in values])


def _node_key(prefix: Column) -> Column:
    """16 bytes for the node that ``prefix`` leads to from the head ``seg, x, y``."""
    return F.unhex(F.md5(F.concat_ws(":", "seg", "x", "y", F.hex(prefix))))


def _digest(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), F.col("seg"), F.col("path"))


def _segments(turns: DataFrame, conversations: DataFrame, segment: int) -> DataFrame:
    """A row for each segment: ``conv_id, seg, x, y, path, last, key``.

    ``x`` and ``y`` stand for all turns before it, 128 bits, ``path`` are its turn ids. A
    conversation without turns has one empty segment.
    """
    cut = (
        turns.groupBy("conv_id", F.floor(F.col("position") / segment).alias("seg"))
        .agg(F.array_sort(F.collect_list(F.struct("position", "id"))).alias("ids"))
        .select(
            "conv_id", "seg", F.unhex(F.concat_ws("", F.transform("ids", lambda t: t["id"]))).alias("path")
        )
    )
    empty = conversations.filter("n_turns = 0").select(
        "conv_id", F.lit(0).cast("long").alias("seg"), F.lit(b"").alias("path")
    )
    cut = written(cut.unionByName(empty), "segments")
    longer = conversations.filter(F.col("n_turns") > segment)
    # A row for each block of a long conversation, with where it ends.
    blocks = longer.select(
        "conv_id",
        F.floor((F.col("n_turns") - 1) / segment).alias("end"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_turns") - 1) / segment / BLOCK))).alias("_at"),
    )
    cut = cut.withColumn("_at", F.floor(F.col("seg") / BLOCK))
    several = cut.join(blocks, ["conv_id", "_at"]).withColumns({"dx": _digest(1), "dy": _digest(2)})
    several = _exclusive(
        several.drop("_at"), "seg", ["dx", "dy"], F.bit_xor, lambda a, b: a.bitwiseXOR(b)
    )
    alone = cut.join(blocks, ["conv_id", "_at"], "left_anti")
    zero = F.lit(0).cast("long")
    rows = alone.select("conv_id", "seg", zero.alias("x"), zero.alias("y"), "path", F.lit(True).alias("last"))
    rows = rows.unionByName(
        several.select(
            "conv_id", "seg", F.col("_before_dx").alias("x"), F.col("_before_dy").alias("y"), "path",
            (F.col("seg") == F.col("end")).alias("last"),
        )
    )
    return written(rows.withColumn("key", _node_key(F.col("path"))), "suffixes")


def _ends(segments: DataFrame) -> DataFrame:
    """``key`` and ``ends``: a digest of the ids of the conversations that end there, in order.

    SHA-256 takes its input in order, so those that end alike meet in one task: a
    key and an id each, sorted by Spark and gone through one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            keys, ends = [], []
            for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k == key:
                    sha.update(b",%d" % conv)
                    continue
                if key is not None:
                    keys.append(key)
                    ends.append(sha.hexdigest())
                key, sha = k, hashlib.sha256(b"%d" % conv)
            yield _ended(keys, ends)
        if key is not None:
            yield _ended([key], [sha.hexdigest()])

    rows = segments.filter("last").select("key", "conv_id")
    placed = rows.repartition("key").sortWithinPartitions("key", "conv_id")
    return placed.mapInArrow(run, "key binary, ends string")


def _ended(keys: list, ends: list) -> pa.RecordBatch:
    arrays = [pa.array(keys, pa.binary()), pa.array(ends, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "ends"])


def _prefix(turns: Column | int) -> Column:
    n = F.lit(turns) if isinstance(turns, int) else turns
    return F.substring(F.col("path"), F.lit(1), n * _ID)


_HEAD = ["seg", "x", "y"]


def _burst(entries: DataFrame, least: int, shares: int) -> DataFrame:
    """Entries with ``cut``, the turns that their container's head is down from the segment's.

    A round counts the entries of each container; those with too many burst: an entry moves to
    the container of its next turn id, or stays at the head (``stays``) if it has none.
    The containers that burst are fewer than ``shares``.
    """
    limit = max(least, entries.count() // shares)
    done, active, cut = [], entries, 0
    while True:
        container = [*_HEAD, _prefix(cut).alias("head")]
        counts = active.groupBy(*container).agg(F.count(F.lit(1)).alias("_n"))
        full = written(counts.filter(F.col("_n") > limit).drop("_n"), "full")
        placed = active.withColumns({"cut": F.lit(cut), "head": _prefix(cut)})
        if full.isEmpty():
            done.append(placed.drop("head").withColumn("stays", F.lit(False)))
            break
        by = [*_HEAD, "head"]
        kept = placed.join(F.broadcast(full), by, "left_anti").drop("head")
        moved = written(placed.join(F.broadcast(full), by, "left_semi").drop("head"), "moved")
        ended = F.length("path") == cut * _ID
        done.append(kept.withColumn("stays", F.lit(False)))
        done.append(moved.filter(ended).withColumn("stays", F.lit(True)))
        active, cut = moved.filter(~ended).drop("cut"), cut + 1
    return written(reduce(DataFrame.unionByName, done), "entries")


_SUMS = ["n", "leaf", "saved"]
_NODE = (
    "conv_id long, depth long, n long, leaf long, saved long, children long, size long, "
    "ends string, me binary, up binary, parent long"
)
_NODE_TYPES = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.binary(), pa.int64()]
_NODE_NAMES = [f.split()[0] for f in _NODE.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in _NODE_TYPES]
    arrays = [pa.array(list(c), t) for c, t in zip(columns, _NODE_TYPES)]
    return pa.RecordBatch.from_arrays(arrays, names=_NODE_NAMES)


class _Open:
    """A node on the way from its container's head to the entry at hand."""

    __slots__ = ("conv", "sums", "children", "ends", "me", "below")

    def __init__(self):
        self.conv, self.sums, self.children, self.below = None, [0, 0, 0], 0, []
        self.ends = self.me = None


def _sweep(segment: int):
    """Sorted entries to nodes, container by container.

    Nodes wait below their parent until that is complete, as they name its smallest member. The
    top of a container has its parent elsewhere: ``up`` is its key. Of a container right
    under the head of a later segment the nodes at its top are the children of a node of the segment
    before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        container, path, stack, out = None, b"", [], []
        seg = cut = 0
        up = None

        def close(depth: int) -> None:
            """Complete the nodes deeper than ``depth`` turns below the segment's head."""
            while stack and cut + len(stack) - 1 > depth:
                local = cut + len(stack) - 1
                node = stack.pop()
                shown = local > 0 or seg == 0
                parent, above = (node.conv, None) if shown else (None, up)
                out.extend((*row, above, parent) for row in node.below)
                if not shown:
                    continue
                size = int.from_bytes(path[local * _ID - 4 : local * _ID], "big") if local else 0
                # A node at a segment's end that goes on has its children elsewhere.
                children = None if node.me is not None else node.children
                row = (node.conv, seg * segment + local, *node.sums, children, size, node.ends, node.me)
                if stack:
                    stack[-1].below.append(row)
                    stack[-1].children += 1
                else:
                    out.append((*row, up, None))

        for batch in batches:
            for e in batch.to_pylist():
                here = (e["seg"], e["x"], e["y"], e["cut"], e["path"][: e["cut"] * _ID])
                if here != container:
                    close(-1)
                    container, path = here, e["path"]
                    seg, cut, up = e["seg"], e["cut"], e["up"]
                    shared = cut
                    stack.append(_Open())
                else:
                    shared, most = cut, min(len(path), len(e["path"])) // _ID
                    while (
                        shared < most
                        and path[shared * _ID : (shared + 1) * _ID]
                        == e["path"][shared * _ID : (shared + 1) * _ID]
                    ):
                        shared += 1
                    close(shared)
                    path = e["path"]
                stack.extend(_Open() for _ in range(shared, len(path) // _ID))
                stack[-1].ends, stack[-1].me = e["ends"], e["below"]
                for node in stack:
                    if node.conv is None or e["conv_id"] < node.conv:
                        node.conv = e["conv_id"]
                    for i, name in enumerate(_SUMS):
                        node.sums[i] += e[name]
            if len(out) >= 4096:
                yield _batch(out)
                out = []
        close(-1)
        yield _batch(out)

    return run


def _nodes(entries: DataFrame, segment: int) -> DataFrame:
    """All nodes as ``_NODE`` has them, sums over the entries under them, from burst entries."""
    up = F.when(
        (F.col("cut") > 0) | (F.col("seg") > 0), _node_key(_prefix(F.greatest(F.col("cut") - 1, F.lit(0))))
    )
    held = entries.filter(~F.col("stays")).withColumns(
        {"up": up, "head": _node_key(_prefix(F.col("cut")))}
    )
    swept = (
        held.repartition("head")
        .sortWithinPartitions(*_HEAD, "path")
        .drop("head")
        .mapInArrow(_sweep(segment), _NODE)
    )
    # The heads that have burst: each entry is below all of its container's, and at its own if it stays.
    last = F.col("cut") - F.when(F.col("stays"), 0).otherwise(1)
    over = entries.filter((F.col("cut") > 0) | F.col("stays")).withColumn(
        "at", F.explode(F.sequence(F.lit(0), last))
    )
    ended = F.when(F.length("path") == F.col("at") * _ID, F.col("ends"))
    heads = (
        over.filter("at > 0 OR seg = 0")
        .groupBy(*_HEAD, "at", _prefix(F.col("at")).alias("path"))
        .agg(F.min("conv_id").alias("conv_id"), *[F.sum(s).alias(s) for s in _SUMS], F.max(ended).alias("ends"))
        .select(
            "conv_id",
            (F.col("seg") * segment + F.col("at")).alias("depth"),
            *_SUMS,
            F.lit(None).cast("long").alias("children"),
            F.when(F.col("at") > 0, F.conv(F.right(F.hex("path"), F.lit(8)), 16, 10).cast("long")).otherwise(0).alias("size"),
            "ends",
            _node_key(F.col("path")).alias("me"),
            F.when((F.col("at") > 0), _node_key(_prefix(F.col("at") - 1))).alias("up"),
            F.lit(None).cast("long").alias("parent"),
        )
    )
    return swept.unionByName(heads)


def prefix_trie(
    turns: DataFrame,
    conversations: DataFrame,
    segment: int = SEGMENT,
    least: int = LEAST,
    shares: int = SHARES,
) -> DataFrame:
    """A row for each distinct beginning of a conversation, the empty one included.

    ``turns`` has ``conv_id``, ``position`` (0, 1, 2...) and ``id``, ``conversations`` has ``conv_id`` and
    ``n_turns``, 0 too, as :func:`ordered_turns` gives them. Returns ``conv_id`` (the smallest member),
    ``depth``, ``parent_conv_id`` (the parent's ``conv_id``), ``n_convs``, ``n_children``, ``n_leaves`` (nodes without children in
    its subtree), ``saved_tokens`` (over its subtree, members but one times bytes of the last text) and
    ``ends_sha256`` (of the comma-joined ids of the members that end there).

    Sums over subtrees take no walk from level to level. A node belongs to its smallest member; those of a
    conversation are the end of its path. What its nodes add up to counts once at each node that
    the conversation is a member of, less what lies above that node; so a
    second sweep, whose entries carry these totals, gives all sums.

    One conversation, first turn or group of copies may have any share of the rows: conversations are
    cut, equal suffixes counted before they are shuffled, full containers burst. Only ids of conversations that
    end alike meet in a task, as their digest needs. Without conversations there is no row. Turn ids are
    compared by 128 bits and the size of the text.
    """
    segments = _segments(turns, conversations, segment)
    goes_on = F.count_if(~F.col("last")) > 0
    below = F.unhex(
        F.md5(F.concat_ws(":", F.col("seg") + 1, F.col("x").bitwiseXOR(_digest(1)),
                          F.col("y").bitwiseXOR(_digest(2)), F.lit("")))
    )
    entries = (
        segments.groupBy("key", *_HEAD, "path")
        .agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"), goes_on.alias("on"))
        .withColumn("below", F.when(F.col("on"), below))
        .drop("on")
        .join(_ends(segments), "key", "left")
    )
    entries = _burst(written(entries, "distinct"), least, shares)
    zero = F.lit(0).cast("long")
    first = _nodes(entries.withColumns({"leaf": zero, "saved": zero}), segment)
    saves = (F.col("n") - 1) * F.col("size")
    leaf = F.col("me").isNull() & (F.col("children") == 0)
    owned = first.groupBy("conv_id").agg(F.count_if(leaf).alias("leaf"), F.sum(saves).alias("saved"))
    # To the segments of each owner, block by block.
    placed = segments.select("conv_id", F.floor(F.col("seg") / BLOCK).alias("_at"), "key")
    shared = placed.select("conv_id", "_at").distinct().join(owned, "conv_id")
    totals = placed.join(shared, ["conv_id", "_at"]).groupBy("key")
    totals = totals.agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    weighted = entries.join(totals, "key", "left").fillna(0, ["leaf", "saved"])
    nodes = written(_nodes(weighted, segment), "nodes")

    # Nodes with parents or children elsewhere.
    apart = nodes.filter("up IS NOT NULL")
    found = apart.groupBy(F.col("up").alias("me")).agg(F.count(F.lit(1)).alias("found"))
    counted = nodes.filter("me IS NOT NULL").join(found, "me").drop("children")
    counted = written(counted.withColumnRenamed("found", "children"), "heads")
    parents = counted.select(F.col("me").alias("up"), F.col("conv_id").alias("_parent"), "children")
    n_apart = apart.count()

    def resolved(rows: DataFrame) -> DataFrame:
        """``parent`` by the key above, where there is one."""
        there = rows.filter("up IS NULL")
        away = join_by_share(
            rows.filter("up IS NOT NULL").withColumnRenamed("children", "_children"),
            parents, ["up"], "children", n_apart,
        ).withColumn("parent", F.col("_parent")).withColumnRenamed("_children", "children")
        return there.unionByName(away.select(*there.columns))

    rows = resolved(nodes.filter("me IS NULL").unionByName(counted.select(*nodes.columns)))
    rows = _exclusive(
        rows.withColumn("own", saves), "depth", ["own"], F.sum, lambda a, b: a + b
    )
    return rows.select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaf").alias("n_leaves"),
        (F.col("saved") - F.col("_before_own")).alias("saved_tokens"),
        F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
    )
