"""Documents in compressed blocks, stored once and read by every later step of an operator."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .packing import forget_tokenizers

#: Bytes of text in a block; a longer document is a block of its own. Compressed, a
#: block stays below the half megabyte from which the JVM treats arrays apart.
BLOCK_BYTES = 1 << 20
#: Stands for a NULL id: larger than any.
NO_ID = np.iinfo(np.int64).max
#: No id is NULL in a block: in pandas, those beside it would become doubles.
BLOCKS = "block_id long, n_bytes long, docs array<struct<id: long, known: boolean, size: long, digest: string>>, data binary"


def make_blocks(docs: DataFrame, name: str, carry: bool = False) -> DataFrame:
    """Documents (doc_id, text) as blocks: ids, sizes and SHA-256 of the texts, their bytes compressed.

    With ``carry``, ``rest`` has all of the documents' other columns in Arrow's format.
    """
    columns = docs.columns if carry else ["doc_id", "text"]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        forget_tokenizers()
        squeeze = zstandard.ZstdCompressor(level=3).compress
        first, made = TaskContext.get().partitionId() << 32, 0
        held, rows, rests, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            row = {"block_id": first + made, "n_bytes": size, "docs": rows, "data": squeeze(b"".join(held))}
            if carry:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rests[0].schema) as writer:
                    for rest in rests:
                        writer.write_batch(rest)
                row["rest"] = squeeze(sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            begin = 0
            for i, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())):
                data = text.encode("utf-8", "surrogatepass") if text is not None else b""
                if held and size + len(data) > BLOCK_BYTES:
                    if carry and i > begin:
                        rests.append(batch.slice(begin, i - begin).drop_columns(["text"]))
                    yield block()
                    held, rows, rests, size, made, begin = [], [], [], 0, made + 1, i
                held.append(data)
                rows.append({"id": NO_ID if doc is None else doc, "known": doc is not None, "size": len(data), "digest": hashlib.sha256(data).hexdigest()})
                size += len(data)
            if carry and batch.num_rows > begin:
                rests.append(batch.slice(begin).drop_columns(["text"]))
        if held:
            yield block()

    fields = [
        ("block_id", pa.int64()), ("n_bytes", pa.int64()),
        ("docs", pa.list_(pa.struct([("id", pa.int64()), ("known", pa.bool_()), ("size", pa.int64()), ("digest", pa.string())]))), ("data", pa.binary()),
    ]
    schema = pa.schema(fields + [("rest", pa.binary())] * carry)
    typed = docs.select(*[F.col(c).cast("long").alias(c) if c == "doc_id" else F.col(f"`{c}`") for c in columns])
    return stored(typed.mapInArrow(gather, BLOCKS + ", rest binary" * carry), name)


def known_ids(docs: list) -> list[int | None]:
    """The ids of a block's documents, None for NULL."""
    return [d["id"] if d["known"] else None for d in docs]


def carried(rest: bytes) -> pa.Table:
    """The other columns of a block's documents."""
    import zstandard

    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(rest)).read_all()


def block_bytes(docs: list, data: bytes) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """A block's bytes, and start, stop and id of each document (NO_ID for NULL)."""
    import zstandard

    size = np.fromiter((d["size"] for d in docs), np.int64, len(docs))
    ids = np.fromiter((d["id"] for d in docs), np.int64, len(docs))
    raw = zstandard.ZstdDecompressor().decompress(data) if size.sum() else b""
    stop = np.cumsum(size)
    return raw, stop - size, stop, ids
