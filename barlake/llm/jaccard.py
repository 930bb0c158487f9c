"""N-gram Jaccard join: prefix trees of globally ordered n-gram sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.components import components
from barlake.llm.exchange import Keys, answer, ask, bucket_count, chunked, met, pack, request_rows, rows_of, unpack
from barlake.llm.hot import join_by_share
from barlake.llm.storage import in_order, written
from barlake.llm.words import BLANKS, LOWER, Rolling, fits, hashed, scramble

WORD_BYTES = 6
#: Sets of a tree: 2 to this power.
BLOCK_BITS = 10
#: Counts above this one are not told apart in the order of n-grams.
COMMON = 127
#: The lengths at which a branch is tested for pruning are this many n-grams apart.
STRIDE = 8


def shingles(text: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct n-grams of each text, by row; short texts have one."""
    words, row_at = hashed(text, BLANKS, LOWER)
    start = fits(row_at, n)
    sizes = np.diff(row_at)
    short = np.flatnonzero((sizes > 0) & (sizes < n))
    start = np.concatenate([start, row_at[short]])
    end = np.concatenate([start[: len(start) - len(short)] + n, row_at[short + 1]])
    values = Rolling(words)(start, end)
    rows = np.searchsorted(row_at[1:], start, side="right")
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def _documents(values: np.ndarray, _owner: np.ndarray, extras: list[bytes]) -> np.ndarray:
    """In how many documents an n-gram is, up to ``COMMON``."""
    counts = np.concatenate([unpack(x, np.uint32) for x in extras])
    distinct, inverse = np.unique(values, return_inverse=True)
    total = np.bincount(inverse, counts, minlength=len(distinct))
    return np.minimum(total, COMMON)[inverse].astype(np.uint8)


def common_prefixes(sets: list[np.ndarray]) -> list[int]:
    """How many leading items each set shares with the one before it."""
    out = [0]
    for a, b in zip(sets, sets[1:]):
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        out.append(int(differ[0]) if len(differ) else m)
    return out


def tree_join(
    probes: list[np.ndarray],
    probe_sizes: np.ndarray,
    stored: list[np.ndarray],
    stored_sizes: np.ndarray,
    percent: int,
):
    """Number of each stored set and the numbers of the probes it is linked with.

    Sets are ascending arrays; sizes count items that are not in the arrays too
    (they are in no other set). The stored sets, in lexical order, are the prefix tree in
    the order of its branches. Going down a branch, the overlap of every probe with the path so
    far is kept; sets that share the path share it, and it is taken back on the way up. A
    branch is left when no probe can reach the overlap it needs even if all that remains of
    the set is in it.
    """
    sizes = np.array([len(p) for p in probes])
    owner = np.repeat(np.arange(len(probes)), sizes)
    items = np.concatenate([np.zeros(0, np.int64), *probes])
    order = np.argsort(items, kind="stable")
    names, first = np.unique(items[order], return_index=True)
    lists = np.split(owner[order], first[1:]) if len(names) else []
    # Big-endian bytes sort as the items do.
    branch_order = sorted(range(len(stored)), key=lambda i: stored[i].astype(">i8").tobytes())
    branches = [stored[i] for i in branch_order]
    shared = common_prefixes(branches)
    need, gain = percent, 100 + percent  # gain * overlap >= need * (both sizes)
    wanted = need * probe_sizes.astype(np.int64)
    overlap = np.zeros(len(probes), np.int64)
    path: list[np.ndarray | None] = []
    for number, branch, common in zip(branch_order, branches, shared):
        while len(path) > common:
            where = path.pop()
            if where is not None:
                overlap[where] -= 1
        at = np.searchsorted(names, branch)
        size = int(stored_sizes[number])
        spare = gain * len(branch) - need * size
        while len(path) < len(branch):
            depth = len(path)
            if depth % STRIDE == 0 or depth == common:
                if spare - gain * depth + int((gain * overlap - wanted).max()) < 0:
                    break
            i = at[depth]
            known = i < len(names) and names[i] == branch[depth]
            where = lists[i] if known else None
            if where is not None:
                overlap[where] += 1
            path.append(where)
        else:
            yield number, np.flatnonzero(gain * overlap >= wanted + need * size)


_LABELS = "set long, root long, links long"


class _Block:
    """Sets of some rows: ``set``, ``n``, ``copies``, ``tokens``, ``side``; and what was found of them."""

    def __init__(self, table: pa.Table):
        table = table.take(pa.array(np.argsort(table.column("set").to_numpy(), kind="stable")))
        self.sets = table.column("set").to_numpy()
        lists = table.column("tokens").combine_chunks()
        flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        at = at - at[0]
        self.tokens = [flat[at[i] : at[i + 1]] for i in range(len(self.sets))]
        self.sizes, self.copies = table.column("n").to_numpy(), table.column("copies").to_numpy()
        self.side = table.column("side").to_numpy()
        self.label, self.links = np.arange(len(self.sets)), np.zeros(len(self.sets), np.int64)

    def join(self, rows: np.ndarray, percent: int, first: int | None = None) -> None:
        """Take in the links among rows of one side, or between those of two.

        With ``first`` only pairs count whose first common n-gram it is.
        """
        left, right = rows[self.side[rows] == 0], rows[self.side[rows] == 1]
        alone = not len(right)
        if alone:
            right = left
        for number, hits in tree_join(
            [self.tokens[i] for i in left], self.sizes[left],
            [self.tokens[i] for i in right], self.sizes[right], percent,
        ):
            me, hits = right[number], left[hits]
            hits = hits[hits != me]
            if first is not None:
                hits = hits[[self._meet(me, hit) == first for hit in hits]]
            if not len(hits):
                continue
            # A pair of one side is seen from either set.
            self.links[me] += self.copies[hits].sum()
            if not alone:
                self.links[hits] += self.copies[me]
            met_labels = np.unique(np.append(self.label[hits], self.label[me]))
            if len(met_labels) > 1:
                self.label[np.isin(self.label, met_labels)] = met_labels[0]

    def _meet(self, a: int, b: int) -> int:
        return int(np.intersect1d(self.tokens[a], self.tokens[b], assume_unique=True)[0])

    def found(self) -> pa.Table:
        return pa.table({"set": self.sets, "root": self.sets[self.label], "links": self.links})


def _join_blocks(table: pa.Table, percent: int) -> pa.Table:
    """Links between the sets of one block, or of two, as a label and a count for each set."""
    block = _Block(table)
    block.join(np.arange(len(block.sets)), percent)
    return block.found()


def _join_tokens(table: pa.Table, percent: int) -> pa.Table:
    """The same for rows under n-grams: only rows of one are compared, pairs that meet there first."""
    table = table.take(pa.array(np.argsort(table.column("set").to_numpy(), kind="stable")))
    block, under = _Block(table), table.column("token").to_numpy()
    order = np.argsort(under, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(under[order])) + 1):
        block.join(rows, percent, int(under[rows[0]]))
    return block.found()


def _families(with_tokens: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``set, family, by_token``, and of families that are joined by n-grams those: ``token, m``.

    Sets that share rare n-grams, and those that share some with them, are a family. One that is more than
    two blocks large may be joined block by block, each with each, or n-gram by n-gram: whichever sends fewer sets.
    Close copies of one text share most n-grams, so blocks are less; in a chain of texts of which each shares
    something with the next n-grams are, and grow with the links. Of n-grams that are in just the same
    sets the first one stands for all.
    """
    tokens = keys.groupBy("token").agg(
        F.count(F.lit(1)).alias("m"),
        F.min("set").alias("centre"),
        F.bit_xor(F.xxhash64("set")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "set")).alias("y"),
    )
    tokens = written(tokens.filter("m > 1"), "shared")
    # Written, so that the hot n-grams of this join are split.
    edges = keys.join(tokens.select("token", "centre"), "token")
    edges = edges.select(F.col("set").alias("a"), F.col("centre").alias("b"))
    families = components(edges).select(F.col("node").alias("set"), F.col("root").alias("family"))
    families = written(families, "families")
    block = 1 << BLOCK_BITS
    lists = tokens.groupBy("m", "x", "y").agg(F.min("token").alias("token"), F.min("centre").alias("set"))
    lists = written(lists.join(families, "set").select("token", "m", "family"), "lists")
    cost = lists.groupBy("family").agg(F.sum(F.col("m") * F.ceil(F.col("m") / block)).alias("cost"))
    sizes = families.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / block)
    plan = sizes.join(cost, "family").select(
        "family", "size", ((blocks > 2) & (F.col("cost") < blocks * blocks * block)).alias("by_token")
    )
    plan = written(plan, "plan")
    families = join_by_share(families, plan, ["family"], "size", families.count())
    chosen = lists.join(plan.filter("by_token").select("family"), "family", "left_semi")
    return written(families, "families"), written(chosen.select("token", "m"), "chosen")


def _pairs_of_blocks(reach: DataFrame, by: str, percent: int) -> DataFrame:
    """``by, seg, seg2`` of blocks that hold sets of one family or n-gram, if sizes allow a link.

    ``reach`` has for each ``by`` and ``seg`` the ``least`` and ``most`` size.
    """
    ahead = reach.select(by, F.col("seg").alias("seg2"), F.col("least").alias("least2"))
    return (
        reach.join(ahead, by)
        .filter(f"seg2 > seg AND 100 * most >= {percent} * least2")
        .select(by, "seg", "seg2")
    )


def _sides(pairs: DataFrame, *by: str) -> DataFrame:
    """Each pair of blocks twice: ``side`` 0 with the first one in ``of``, 1 with the second."""
    one = pairs.select(*by, "seg", "seg2", F.lit(0).alias("side"), F.col("seg").alias("of"))
    return one.unionByName(
        pairs.filter("seg2 <> seg").select(
            *by, "seg", "seg2", F.lit(1).alias("side"), F.col("seg2").alias("of")
        )
    )


def _by_blocks(members: DataFrame, with_tokens: DataFrame, percent: int) -> DataFrame:
    """Labels out of the joins of all blocks of a family: ``members`` are ``set, family, n, copies``."""
    placed = in_order(members, ["family", "n", "set"], "place")
    placed = placed.withColumn("seg", F.shiftright("place", BLOCK_BITS))
    reach = placed.groupBy("family", "seg").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    across = _pairs_of_blocks(reach, "family", percent).select("seg", "seg2").distinct()
    own = placed.select("seg").distinct().select("seg", F.col("seg").alias("seg2"))
    sides = _sides(written(across.unionByName(own), "pairs"))
    rows = placed.select("set", "copies", F.col("seg").alias("of")).join(sides, "of").drop("of")
    rows = rows.join(with_tokens, "set")
    return rows.groupBy("seg", "seg2").applyInArrow(lambda t: _join_blocks(t, percent), _LABELS)


def _by_tokens(members: DataFrame, with_tokens: DataFrame, percent: int) -> DataFrame:
    """The same n-gram by n-gram: ``members`` are ``set, token, n, copies``.

    Rows in the order of n-grams and sizes are cut into blocks; few n-grams go on in another one, which are
    joined across by themselves.
    """
    placed = in_order(members, ["token", "n", "set"], "place")
    placed = placed.withColumn("seg", F.shiftright("place", BLOCK_BITS))
    own = placed.select("set", "copies", "token", "seg", F.lit(0).alias("side"))
    own = own.join(with_tokens, "set").groupBy("seg")
    inside = own.applyInArrow(lambda t: _join_tokens(t, percent), _LABELS)
    reach = placed.groupBy("token", "seg").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    sides = _sides(written(_pairs_of_blocks(reach, "token", percent), "token-pairs"), "token")
    rows = placed.select("set", "copies", "token", F.col("seg").alias("of")).join(sides, ["token", "of"])
    rows = rows.drop("of").join(with_tokens, "set").groupBy("token", "seg", "seg2")
    return inside.unionByName(rows.applyInArrow(lambda t: _join_tokens(t, percent), _LABELS))


def _link(sets: DataFrame, percent: int) -> DataFrame:
    """``set``, ``root``, ``links``, ``copies`` of the sets that are linked with another.

    A linked pair shares an n-gram among the rarest of both (as many as a set can be without,
    and one). Sets joined by such n-grams make up families, and only sets of one family
    are compared: in blocks of a kilobyte of sets, in the order of family and size, or
    n-gram by n-gram where that is less.
    """
    copies = sets.filter("set IS NOT NULL").groupBy("set", "n").agg(F.count(F.lit(1)).alias("copies"))
    copies = written(copies, "copies")
    # Every chunk with a copy has the n-grams: one row for each set is kept, combined map-side.
    with_tokens = sets.filter("tokens IS NOT NULL").groupBy("set")
    with_tokens = written(with_tokens.agg(F.first("n").alias("n"), F.first("tokens").alias("tokens")), "tokens")
    least = F.expr(f"(n * {percent} + 99) div 100")
    rare = F.size("tokens") - least + 1
    keys = with_tokens.select("set", F.explode(F.slice("tokens", F.lit(1), rare.cast("int"))).alias("token"))
    keys = written(keys.distinct(), "prefixes")
    families, chosen = _families(with_tokens, keys)
    by_blocks = families.filter("NOT by_token").join(copies, "set")
    labelled = _by_blocks(by_blocks, with_tokens, percent)
    if not chosen.isEmpty():
        under = join_by_share(keys, chosen, ["token"], "m", keys.count()).join(copies, "set")
        labelled = labelled.unionByName(_by_tokens(under, with_tokens, percent))
    labelled = written(labelled, "labelled")
    roots = components(labelled.select(F.col("set").alias("a"), F.col("root").alias("b")))
    roots = written(roots, "roots")
    links = written(labelled.groupBy("set").agg(F.sum("links").alias("links")), "links")
    return (
        copies.drop("n")
        .join(links, "set", "left")
        .join(roots.withColumnsRenamed({"node": "set"}), "set", "left")
        .select("set", F.coalesce("root", "set").alias("root"), F.coalesce("links", F.lit(0)).alias("links"), "copies")
    )


_SETS = "chunk long, row int, doc_id long, n long, set long, tokens array<long>"


def _linked(
    chunks: DataFrame, n: int, percent: int, id_col: str, text_col: str
) -> DataFrame:
    """For each row of the chunks: ``chunk, row, doc_id, n_shingles, component_id, n_links, first``."""
    buckets = bucket_count(chunks, 1 / WORD_BYTES)

    def request(chunk: int, rows: pa.Table) -> pa.Table:
        _, values = shingles(rows.column(text_col).combine_chunks(), n)
        keys = Keys(values, buckets)
        counts = keys.counts.astype(np.uint32)
        return request_rows(chunk, keys, lambda part: pack(counts[part]))

    documents = answer(ask(chunks, request), [(_documents, 32)], "documents")

    def gather(chunk: int, rows: pa.Table, got: dict[int, bytes]) -> pa.Table:
        row, values = shingles(rows.column(text_col).combine_chunks(), n)
        keys = Keys(values, buckets)
        found_in = keys.answers(got, np.uint8)[keys.inverse]
        n_rows = rows.num_rows
        size = np.bincount(row, minlength=n_rows)
        repeated = found_in > 1
        may_link = (size > 0) & (100 * np.bincount(row, repeated, minlength=n_rows) >= percent * size)
        sums = np.zeros(n_rows, np.uint64)
        np.add.at(sums, row, scramble(values))
        names = scramble(sums + size.astype(np.uint64)).view(np.int64)
        tokens = (found_in.astype(np.int64) << 56) | (values >> np.uint64(8)).astype(np.int64)
        keep = repeated & may_link[row]
        row, tokens = row[keep], tokens[keep]
        order = np.lexsort((tokens, row))
        row, tokens = row[order], tokens[order]
        at = np.searchsorted(row, np.arange(n_rows + 1))
        # Of equal sets of a chunk the first one carries the n-grams.
        carries = np.zeros(n_rows, bool)
        linked = np.flatnonzero(may_link)
        carries[linked[np.unique(names[linked], return_index=True)[1]]] = True
        lists = [tokens[at[i] : at[i + 1]] if carries[i] else None for i in range(n_rows)]
        return pa.table(
            {
                "chunk": pa.array(np.full(n_rows, chunk)),
                "row": pa.array(np.arange(n_rows), pa.int32()),
                "doc_id": rows.column(id_col).cast(pa.int64()),
                "n": pa.array(size, pa.int64()),
                "set": pa.array(names, mask=~may_link),
                "tokens": pa.array(lists, pa.list_(pa.int64())),
            }
        )

    sets = written(met(chunks, documents, gather, _SETS), "sets")
    # Written: the joins below have plain shuffles on both sides, whose hot sets and groups are split.
    linked = written(_link(sets, percent), "linked")
    rows = sets.drop("tokens")
    alone = rows.filter("set IS NULL")  # they would all meet in one task of a join
    rows = written(rows.filter("set IS NOT NULL").join(linked, "set"), "rooted")
    # The smallest id of a group, and the one row that stands for it.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "chunk", "row")
    firsts = written(rows.groupBy("root").agg(F.min(order).alias("_first")), "firsts")
    first = F.col("_first")
    grouped = rows.join(firsts, "root").select(
        "chunk",
        "row",
        "doc_id",
        F.col("n").alias("n_shingles"),
        first["doc_id"].alias("component_id"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"),
        ((first["chunk"] == F.col("chunk")) & (first["row"] == F.col("row"))).alias("first"),
    )
    return grouped.unionByName(
        alone.select(
            "chunk",
            "row",
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.col("doc_id").alias("component_id"),
            F.lit(0).cast("long").alias("n_links"),
            F.lit(True).alias("first"),
        )
    )


def link_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Groups of documents linked by the Jaccard similarity of their n-gram sets.

    A text's set: the distinct runs of ``n`` of its words (between ASCII blanks, A-Z
    lower-cased); with fewer words the whole sequence as one. Two documents link when
    ``100 * intersection >= percent * union``; those without words link with nothing.

    Every n-gram's number of documents is looked up in bulk. A document can only link if
    enough of its n-grams are in another one; equal sets are taken as one; the others are
    joined by prefix trees with the n-grams in one order, rarest first. N-grams are told
    apart by 64-bit hashes (56 bits in the trees).

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links,
    itself included) and ``n_links``, a row for each input row. Null text has no words.
    Null ids come last: a group of nulls alone has a null one. Rows that repeat an id are
    documents of their own. An empty table gives an empty one. Other columns are not read. A text needs some ten
    times its size in memory.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    linked = _linked(chunked(slim, "text"), n, percent, "doc_id", "text")
    return linked.select("doc_id", "n_shingles", "component_id", "n_links")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The documents, all columns, with one of each group of :func:`link_documents` left.

    It is the one with the smallest id; of rows that share it, one. Documents without
    words all stay.
    """
    chunks = chunked(docs, text_col)
    linked = _linked(chunks, n, percent, id_col, text_col).select("chunk", "row", "first")

    def take(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = rows_of(left.column("rows")[0].as_buffer())
        stays = np.zeros(rows.num_rows, bool)
        stays[right.column("row").to_numpy()] = right.column("first").to_numpy()
        return rows.filter(pa.array(stays))

    whole = chunks.select("chunk", "rows").groupBy("chunk")
    return whole.cogroup(linked.groupBy("chunk")).applyInArrow(take, docs.schema)
