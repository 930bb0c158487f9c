"""Which keys of a document occur elsewhere: exchanged in bulk, packed.

Rows are first gathered into chunks of some megabytes, written once. A chunk then
asks about its keys (hashes of windows, n-grams, words): the keys, sorted and made
distinct, go packed to the bucket that their leading bits name; a bucket sees all
chunks' requests for its keys and answers each of them in the order asked; and the
answers meet their chunk again. A chunk derives its keys from its rows each time,
so answers need not name them. What a key costs on the way is two to three bytes for 32 bits of
it (as the keys are sorted, their leading bits compress away), whatever the number
of times a chunk has it.

A bucket has the same share of the distinct keys of every chunk, so one hot key
adds at most one entry a chunk. The number of buckets grows with the input, which
keeps a bucket's work the same at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.storage import power_of_two, written

CHUNK_BYTES = 4 << 20
#: What a row counts towards a chunk besides the bytes of its columns.
ROW_BYTES = 16
#: Distinct keys that a bucket should have to look at.
BUCKET_KEYS = 1 << 20
_CHUNKS = "chunk long, part int, n_bytes long, rows binary"


def _serialized(table: pa.Table) -> bytes:
    """The table with all its batches: a column over 2 GiB does not combine to one."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
    with pa.ipc.new_stream(sink, table.schema, options=options) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _text_bytes(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(False)


def _row_bytes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of each row in all columns; those of nested columns are spread evenly."""
    total = np.full(batch.num_rows, ROW_BYTES, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            total += _text_bytes(column)
        else:
            total += -(-column.nbytes // max(1, batch.num_rows))
    return total


def rows_of(blob) -> pa.Table:
    """The rows of a chunk, all their columns."""
    with pa.ipc.open_stream(pa.py_buffer(blob)) as stream:
        return stream.read_all()


def chunked(docs: DataFrame, text_col: str, part_col: str | None = None) -> DataFrame:
    """Rows gathered into chunks and written: ``chunk``, ``part``, ``n_bytes``, ``rows``.

    A chunk holds about ``CHUNK_BYTES`` in all columns, or one longer row, and rows of one
    value of ``part_col`` only, if given: an INT from 0 to 15, also the chunk number's last four
    bits. ``n_bytes`` counts the text alone. The chunks stay where their rows were: nothing
    is shuffled.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[int, list] = {}
        size: dict[int, int] = {}
        n_bytes: dict[int, int] = {}

        def flush(part: int) -> pa.RecordBatch:
            nonlocal made
            blob = _serialized(pa.Table.from_batches(held.pop(part)).combine_chunks())
            made += 1
            del size[part]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(((task << 28) + made) << 4) + int(part)], pa.int64()),
                    pa.array([part], pa.int32()),
                    pa.array([n_bytes.pop(part)], pa.int64()),
                    pa.array([blob], pa.binary()),
                ],
                names=["chunk", "part", "n_bytes", "rows"],
            )

        for batch in batches:
            text = _text_bytes(batch.column(batch.schema.get_field_index(text_col)))
            lengths = _row_bytes(batch)
            if part_col:
                parts = batch.column(batch.schema.get_field_index(part_col)).to_numpy(False)
            else:
                parts = np.zeros(len(lengths), np.int32)
            for part in np.unique(parts):
                rows = np.flatnonzero(parts == part)
                upto = np.cumsum(lengths[rows])
                while len(rows):
                    room = CHUNK_BYTES - size.get(part, 0)
                    base = upto[0] - lengths[rows[0]]
                    n = max(1, int(np.searchsorted(upto - base, room, "right")))
                    taken = batch.take(pa.array(rows[:n]))
                    held.setdefault(part, []).append(taken)
                    size[part] = size.get(part, 0) + int(upto[n - 1] - base)
                    n_bytes[part] = n_bytes.get(part, 0) + int(text[rows[:n]].sum())
                    rows, upto = rows[n:], upto[n:]
                    if size[part] >= CHUNK_BYTES or len(rows):
                        yield flush(part)
        for part in list(held):
            yield flush(part)

    return written(docs.mapInArrow(gather, _CHUNKS), "chunks")


def bucket_count(chunks: DataFrame, keys_per_byte: float) -> int:
    """A power of two so that a bucket has about ``BUCKET_KEYS`` keys."""
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(16, power_of_two(total * keys_per_byte / BUCKET_KEYS))


def pack(values: np.ndarray, delta: bool = False) -> bytes:
    """Unsigned integers or bytes, compressed; ``delta`` if sorted."""
    if delta and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    width = values.dtype.itemsize
    planes = values.view(np.uint8).reshape(-1, width).T if width > 1 else values.view(np.uint8)
    raw = np.ascontiguousarray(planes).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(data: bytes, dtype, delta: bool = False) -> np.ndarray:
    size, dtype = int.from_bytes(data[:8], "little"), np.dtype(dtype)
    raw = pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    planes = np.frombuffer(raw, np.uint8)
    if dtype.itemsize > 1:
        planes = np.ascontiguousarray(planes.reshape(dtype.itemsize, -1).T).reshape(-1)
    values = planes.view(dtype)
    return np.cumsum(values, dtype=dtype) if delta else values


class Keys:
    """Distinct keys of a chunk, cut to the bits that are sent, and how they were made distinct.

    ``bits`` is 32 or 64 (of each key, after the ones that name the bucket).
    """

    def __init__(self, hashes: np.ndarray, buckets: int, bits: int = 32):
        name_bits = buckets.bit_length() - 1
        width = 64 if bits == 64 else bits + name_bits
        self.bits = bits
        self.values, self.inverse, self.counts = np.unique(
            hashes >> np.uint64(64 - width), return_inverse=True, return_counts=True
        )
        names = self.values >> np.uint64(width - name_bits)
        self._edges = np.searchsorted(names, np.arange(buckets + 1, dtype=np.uint64))

    def parts(self) -> Iterator[tuple[int, slice]]:
        """Buckets that have keys, and where those are."""
        for b in np.flatnonzero(np.diff(self._edges)):
            yield int(b), slice(int(self._edges[b]), int(self._edges[b + 1]))

    def sent(self, part: slice) -> bytes:
        values = self.values[part]
        if self.bits == 32:
            return pack((values & np.uint64(0xFFFFFFFF)).astype(np.uint32), delta=True)
        return pack(values, delta=True)

    def answers(self, received: dict[int, bytes], dtype) -> np.ndarray:
        """One value for each distinct key."""
        out = np.zeros(len(self.values), dtype)
        for b, part in self.parts():
            out[part] = unpack(received[b], dtype)[: part.stop - part.start]
        return out


_ASKED = "bucket int, chunk long, asked binary, extra binary"
_ANSWERED = "chunk long, bucket int, answer binary"


def _table(schema: str, columns: list[list]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns)})


def request_rows(chunk: int, keys: Keys, extra: Callable[[slice], bytes] | None = None) -> pa.Table:
    parts = list(keys.parts())
    return _table(
        _ASKED,
        [
            [b for b, _ in parts],
            [chunk] * len(parts),
            [keys.sent(p) for _, p in parts],
            [extra(p) if extra else b"" for _, p in parts],
        ],
    )


def ask(chunks: DataFrame, rows_to_requests: Callable[[int, pa.Table], pa.Table]) -> DataFrame:
    """Requests of all chunks, derived from their rows alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from rows_to_requests(chunk, rows_of(blob.as_buffer())).to_batches()
                pa.default_memory_pool().release_unused()

    return chunks.select("chunk", "rows").mapInArrow(run, _ASKED)


#: Different kinds of keys may go in one exchange: a kind's buckets start at its multiple of this.
KIND = 1 << 24


def of_kind(requests: pa.Table, kind: int) -> pa.Table:
    """The requests with their buckets moved to those of a kind."""
    moved = pa.array(requests.column("bucket").to_numpy() + kind * KIND, pa.int32())
    return requests.set_column(0, "bucket", moved)


def answers_of_kind(received: dict[int, bytes], kind: int) -> dict[int, bytes]:
    """Of the answers of one chunk those of a kind, by plain bucket number."""
    return {b - kind * KIND: a for b, a in received.items() if b // KIND == kind}


def answer(requests: DataFrame, looks: list[tuple[Callable, int]], label: str) -> DataFrame:
    """Answers of all buckets, written: ``chunk``, ``bucket``, ``answer``.

    ``looks`` has for each kind of keys a function and the number of bits sent.
    ``look(values, owner, extras)`` gets the keys of all requests of a bucket end to
    end, the number of the request each belongs to (in the order of the chunks), and
    the requests' extras, and gives an array with a value for each key.
    """

    def run(table: pa.Table) -> pa.Table:
        look, bits = looks[table.column("bucket")[0].as_py() // KIND]
        order = np.argsort(table.column("chunk").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        dtype = np.uint32 if bits == 32 else np.uint64
        asked = [unpack(x.as_buffer().to_pybytes(), dtype, delta=True) for x in table.column("asked")]
        sizes = np.array([len(a) for a in asked])
        extras = [x.as_buffer().to_pybytes() for x in table.column("extra")]
        found = look(np.concatenate(asked), np.repeat(np.arange(len(asked)), sizes), extras)
        ends = np.cumsum(sizes)
        return _table(
            _ANSWERED,
            [
                table.column("chunk").to_pylist(),
                table.column("bucket").to_pylist(),
                [pack(np.ascontiguousarray(found[e - n : e])) for e, n in zip(ends, sizes)],
            ],
        )

    return written(requests.groupBy("bucket").applyInArrow(run, _ANSWERED), label)


def received(answers: pa.Table) -> dict[int, bytes]:
    """The answers of one chunk by bucket."""
    return {
        b: a.as_buffer().to_pybytes()
        for b, a in zip(answers.column("bucket").to_pylist(), answers.column("answer"))
    }


def met(chunks: DataFrame, answers: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``run(chunk id, rows, answers by bucket)`` for each chunk with its answers."""

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # of the chunk before
        chunk = left.column("chunk")[0].as_py()
        return run(chunk, rows_of(left.column("rows")[0].as_buffer()), received(right))

    left = chunks.select("chunk", "rows").groupBy("chunk")
    return left.cogroup(answers.groupBy("chunk")).applyInArrow(both, schema)
