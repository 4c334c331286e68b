"""Vector codes by product quantisation: codebooks trained by Lloyd's rounds over resident members."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from tickerlake.session import scratch_path

#: Bytes of members, about, that one owner (position, entry, salt) holds.
OWNER_BYTES = 1 << 20
#: Below this, sums and squares of integers are exact in double precision.
EXACT = 2.0**52
_LIMB = 30

#: Members of an owner: row numbers, and their parts as integers (see ``packed``).
_BLOCK = "position int, entry int, salt int, n long, members binary, kind string, parts binary"
_BLOCK_ARROW = pa.schema([
    ("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("n", pa.int64()),
    ("members", pa.binary()), ("kind", pa.string()), ("parts", pa.binary()),
])


def integers(x: np.ndarray) -> np.ndarray:
    """floor(256 * x) of doubles, exactly: int64 where that is below 2 ** 52, else Python's integers."""
    if not x.size or np.abs(x).max() < EXACT / 256:
        return np.floor(x * 256).astype(np.int64)
    whole = [256 * int(v) if abs(v) >= EXACT else math.floor(v * 256) for v in x.ravel().tolist()]
    return np.array(whole, object).reshape(x.shape)


def packed(parts: np.ndarray) -> tuple[str, bytes]:
    """Integers as bytes of the narrowest kind that holds them; of Python's integers as text."""
    if parts.dtype == object:
        if not parts.size or max(map(abs, parts.ravel().tolist())) >= EXACT:
            return "text", ",".join(map(str, parts.ravel().tolist())).encode()
        parts = parts.astype(np.int64)
    most = np.abs(parts).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    return kind, parts.astype(kind).tobytes()


def unpacked(kind: str, data: bytes, width: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(v) for v in data.split(b",")], object).reshape(-1, width)
    return np.frombuffer(data, kind).astype(np.int64).reshape(-1, width)


def stacked(arrays: list[np.ndarray], width: int) -> np.ndarray:
    if any(a.dtype == object for a in arrays):
        arrays = [a.astype(object) for a in arrays]
    return np.concatenate(arrays) if arrays else np.zeros((0, width), np.int64)


def nearest_entries(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each part the nearest entry (least squared distance, ties to the lower index) and that distance."""
    small = parts.dtype != object and book.dtype != object
    if small:
        most = max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0))
        small = 4.0 * max(1, parts.shape[1]) * float(most) ** 2 < EXACT
    entry, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64 if small else object)
    step = 8192 if small else 64
    if small:
        own = book.astype(np.float64)
        length = (own * own).sum(1)
    for lo in range(0, len(parts), step):
        some = parts[lo : lo + step]
        if small:
            x = some.astype(np.float64)
            d = (x * x).sum(1)[:, None] - 2 * (x @ own.T) + length
        else:
            d = ((some.astype(object)[:, None, :] - book.astype(object)[None]) ** 2).sum(2)
        best = np.array([min(range(len(row)), key=row.__getitem__) for row in d.tolist()], np.int64) if not small else d.argmin(1)
        entry[lo : lo + step] = best
        distance[lo : lo + step] = d[np.arange(len(some)), best]
    return entry, distance


class Codebooks:
    """Integer entries of each part position: (entries, part width) arrays."""

    def __init__(self, seeds: np.ndarray, positions: int):
        self.width = seeds.shape[1] // positions
        self.books = [seeds[:, p * self.width : (p + 1) * self.width] for p in range(positions)]

    def updated(self, sums: dict[tuple[int, int], list[int]], counts: dict[tuple[int, int], int]) -> Codebooks:
        """Entries as the means of their parts, rounded down; unused ones stay."""
        out = object.__new__(Codebooks)
        out.width, out.books = self.width, []
        for p, book in enumerate(self.books):
            rows = [[s // counts[p, e] for s in sums[p, e]] if counts.get((p, e)) else book[e].tolist() for e in range(len(book))]
            whole = np.array(rows, object).reshape(len(rows), self.width)
            fits = not whole.size or max(map(abs, whole.ravel().tolist())) < EXACT
            out.books.append(whole.astype(np.int64) if fits else whole)
        return out

    def digest(self) -> str:
        text = ",".join(str(v) for book in self.books for v in book.ravel().tolist())
        return hashlib.sha256(text.encode()).hexdigest()


def _each_batch(emit: Callable[[pa.RecordBatch, int], Iterator[dict]], schema: pa.Schema):
    """A map over Arrow batches; ``emit`` also gets a number that differs from batch to batch of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId()
        for i, batch in enumerate(batches):
            rows = list(emit(batch, first + i))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _blocks_of(position: int, entry: np.ndarray, members: np.ndarray, parts: np.ndarray, salt: Callable[[int], int]) -> Iterator[dict]:
    """One block for each entry that some members have."""
    order = np.argsort(entry, kind="stable")
    used, starts = np.unique(entry[order], return_index=True)
    for e, some in zip(used.tolist(), np.split(order, starts[1:])):
        kind, data = packed(parts[some])
        yield {"position": position, "entry": e, "salt": salt(e), "n": len(some), "members": members[some].tobytes(), "kind": kind, "parts": data}


def _read_blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    for r in batch.to_pylist():
        members = np.frombuffer(r["members"], "<i8")
        parts = unpacked(r["kind"], r["parts"], width) if width else np.zeros((len(members), 0), np.int64)
        yield r["position"], r["entry"], r["salt"], members, parts


def _owned(blocks: DataFrame, width: int, name: str) -> DataFrame:
    """Blocks brought to their owners and joined: one resident block each, stored."""
    def join(key: tuple, group: pa.Table) -> pa.Table:
        read = [b for batch in group.to_batches() for b in _read_blocks(batch, width)]
        kind, data = packed(stacked([b[4] for b in read], width))
        members = np.concatenate([b[3] for b in read])
        p, e, s = (k.as_py() for k in key)
        row = {"position": p, "entry": e, "salt": s, "n": len(members), "members": members.tobytes(), "kind": kind, "parts": data}
        return pa.Table.from_pylist([row], _BLOCK_ARROW)

    return stored(blocks.groupBy("position", "entry", "salt").applyInArrow(join, _BLOCK), name)


def _salts(counts: dict[tuple[int, int], int], width: int) -> dict[tuple[int, int], int]:
    """How many owners share an entry's members."""
    most = max(1, OWNER_BYTES // (2 * width + 8))
    return {k: -(-n // most) for k, n in counts.items() if n > most}


def _counted(blocks: DataFrame) -> dict[tuple[int, int], int]:
    rows = blocks.groupBy("position", "entry").agg(F.sum("n").alias("n")).collect()  # positions x entries at most
    return {(r["position"], r["entry"]): r["n"] for r in rows}


def _first_owners(rows: DataFrame, books: Codebooks, name: str) -> DataFrame:
    """Every part at the owner of its nearest entry."""
    def assigned(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        if not batch.num_rows:
            return
        members = np.array(batch.column("row").to_pylist(), np.int64)
        total = books.width * len(books.books)
        whole = stacked([unpacked(k, d, total) if total else np.zeros((1, 0), np.int64)
                         for k, d in zip(batch.column("kind").to_pylist(), batch.column("ints").to_pylist())], total)
        for p, book in enumerate(books.books):
            parts = whole[:, p * books.width : (p + 1) * books.width]
            yield p, nearest_entries(parts, book)[0], members, parts

    def count(batch: pa.RecordBatch, number: int) -> Iterator[dict]:
        for p, entry, _, _ in assigned(batch):
            for e, n in zip(*np.unique(entry, return_counts=True)):
                yield {"position": p, "entry": int(e), "n": int(n)}

    counts = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("n", pa.int64())])
    salts = _salts(_counted(rows.mapInArrow(_each_batch(count, counts), "position int, entry int, n long")), books.width)

    def deal(batch: pa.RecordBatch, number: int) -> Iterator[dict]:
        for p, entry, members, parts in assigned(batch):
            yield from _blocks_of(p, entry, members, parts, lambda e, p=p: number % salts.get((p, e), 1))

    return _owned(rows.mapInArrow(_each_batch(deal, _BLOCK_ARROW), _BLOCK), books.width, name)


def _migrated(owned: DataFrame, books: Codebooks, name: str) -> DataFrame:
    """Members after a round: those that keep their entry stay in their owner's file, the others move to their new owner."""
    def look(batch: pa.RecordBatch, number: int) -> Iterator[dict]:
        for p, e, s, members, parts in _read_blocks(batch, books.width):
            entry = nearest_entries(parts, books.books[p])[0]
            for block in _blocks_of(p, entry, members, parts, lambda new, e=e, s=s: s if new == e else number):
                yield {**block, "moved": block["entry"] != e}

    spark, path = owned.sparkSession, scratch_path(owned.sparkSession, f"{name}-round")
    schema = pa.schema([*_BLOCK_ARROW, ("moved", pa.bool_())])
    owned.mapInArrow(_each_batch(look, schema), _BLOCK + ", moved boolean").write.partitionBy("moved").parquet(path)
    after = spark.read.schema(_BLOCK + ", moved boolean").parquet(path)
    stayed, moving = after.where(~F.col("moved")).drop("moved"), after.where("moved").drop("moved")
    salts = _salts(_counted(moving), books.width)
    if salts:
        many = spark.createDataFrame([(p, e, n) for (p, e), n in salts.items()], "position int, entry int, salts int")
        dealt = moving.join(F.broadcast(many), ["position", "entry"], "left")  # positions x entries rows at most
        moving = dealt.withColumn("salt", F.col("salt") % F.coalesce("salts", F.lit(1))).select(*moving.columns)
    else:
        moving = moving.withColumn("salt", F.lit(0))
    return stayed.unionByName(_owned(moving, books.width, f"{name}-arrived"))


def _trained(owned: DataFrame, books: Codebooks) -> Codebooks:
    """Entries as the means of their resident members. Owners send sums only, in limbs that add up exactly."""
    def sums(batch: pa.RecordBatch, number: int) -> Iterator[dict]:
        for p, e, _, members, parts in _read_blocks(batch, books.width):
            narrow = parts.dtype != object and np.abs(parts).max(initial=0) < 1 << 31
            total = (parts if narrow else parts.astype(object)).sum(0).tolist() if books.width else []
            for component, value in enumerate([len(members), *total]):
                sign, value, limb = -1 if value < 0 else 1, abs(value), 0
                while value or not limb:
                    yield {"position": p, "entry": e, "component": component, "limb": limb, "value": sign * (value & ((1 << _LIMB) - 1))}
                    value, limb = value >> _LIMB, limb + 1

    fields = ["position", "entry", "component", "limb"]
    schema = pa.schema([*[(f, pa.int32()) for f in fields], ("value", pa.int64())])
    made = owned.mapInArrow(_each_batch(sums, schema), ", ".join(f"{f} int" for f in fields) + ", value long")
    totals: dict[tuple[int, int], list[int]] = {}
    for r in made.groupBy(*fields).agg(F.sum("value").alias("value")).collect():  # the codebooks' size
        whole = totals.setdefault((r["position"], r["entry"]), [0] * (books.width + 1))
        whole[r["component"]] += r["value"] << (_LIMB * r["limb"])
    return books.updated({k: v[1:] for k, v in totals.items()}, {k: v[0] for k, v in totals.items()})


def usable(vector: Column) -> Column:
    """Not NULL and without NULL or non-finite components."""
    limit = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < limit))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def vector_codes(
    vectors: DataFrame,
    positions: int = 16,
    entries: int = 64,
    rounds: int = 2,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Codes of vectors: vec_id, code (two hex digits a part), error, label_error, codebooks_sha256.

    Each component x is the integer floor(256 * x); a vector is cut into ``positions``
    parts. A position's codebook starts as that part of the ``entries`` vectors of smallest id
    and is trained by ``rounds`` of Lloyd's method in whole numbers. ``error`` is the
    squared distance to the entries, ``label_error`` its sum over rows of the
    label (NULLs together).

    Rows whose vector is NULL or holds NULL or non-finite components are dropped.
    Repeated rows and ids are rows of their own; a NULL id comes after all others, rows
    of one id in the order of their vectors. Fewer rows than ``entries`` make smaller
    codebooks. Vectors shorter than the longest, or of a length that ``positions`` does not
    divide, are extended with zeros. Magnitudes are exact at any size; an error beyond a long is NULL, and
    so is its label's. Other columns are ignored, an empty table gives an empty result.

    Scale: parts lie in stored blocks by owner (position, entry, salt), of which a
    much-used entry has many. A round reads the blocks in place: owners send sums, what
    keeps its entry is written where it is, and only what changes entry is shuffled.
    """
    kept = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector")
    ).where(usable(F.col("vector"))).withColumn("vector", F.col("vector").cast("array<double>"))
    shape = kept.agg(F.max(F.size("vector")).alias("size")).first()
    label = kept.schema["label"].dataType.simpleString()
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    if shape["size"] is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    size = -(-shape["size"] // positions) * positions

    def whole(vector: list[float]) -> np.ndarray:
        return integers(np.array([*vector, *[0.0] * (size - len(vector))], np.float64))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [packed(whole(v)) for v in batch.column("vector").to_pylist()]
            columns = [batch.column("id"), batch.column("label"), pa.array([k for k, _ in made], pa.string()), pa.array([d for _, d in made], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "kind", "ints"])

    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    books = Codebooks(stacked([whole(r["vector"])[None] for r in first], size), positions)
    rows = stored(
        kept.mapInArrow(narrow, f"id long, label {label}, kind string, ints binary").withColumn("row", F.monotonically_increasing_id()), "codes-rows")

    owned = _first_owners(rows.select("row", "kind", "ints"), books, "codes")
    for r in range(rounds):
        if r:
            owned = _migrated(owned, books, "codes")
        books = _trained(owned, books)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "position", "entry", "distance"]
        for batch in batches:
            for p, _, _, members, parts in _read_blocks(batch, books.width):
                entry, distance = nearest_entries(parts, books.books[p])
                exact = pa.array([None if d >= 1 << 63 else d for d in distance.tolist()], pa.int64())
                position = pa.array(np.full(len(entry), p, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), position, pa.array(entry), exact], names)

    ends = owned.mapInArrow(coded, "row long, position int, entry long, distance long")
    words = [F.bit_or(F.when(F.expr(f"position div 8 = {w}"), F.expr("shiftleft(entry, 8 * (7 - position % 8))"))) for w in range(-(-positions // 8))]
    code = F.substring(F.concat(*[F.lpad(F.hex(w), 16, "0") for w in words]), 1, 2 * positions)
    complete = F.count("distance") == positions
    by_row = ends.groupBy("row").agg(F.lower(code).alias("code"), F.when(complete, F.try_sum("distance")).alias("error"))
    named = stored(by_row.join(rows.select("row", "id", "label"), "row").select(F.col("id").alias("vec_id"), "label", "code", "error"), "codes-rows-coded")
    known = F.count("error") == F.count("*")
    labels = named.groupBy(F.col("label").alias("of")).agg(F.when(known, F.try_sum("error")).alias("label_error"))
    return named.join(labels, F.col("label").eqNullSafe(F.col("of"))).withColumn("codebooks_sha256", F.lit(books.digest())).select(*columns)
