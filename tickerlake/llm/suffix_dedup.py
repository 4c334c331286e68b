"""Removal of repeated byte strings by a sparse suffix array, range-partitioned and sorted in buckets.

A string of LENGTH bytes is found by the one of its GRAM-byte pieces with the
smallest hash, its anchor; equal strings have equal anchors at the same offset.
So sorting the suffixes that start at anchors, about one in 15 of all, brings
together every pair of equal strings, whatever its place. Anchors whose piece
is in one document only are left out before the sort.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import NO_ID, block_bytes, carried, known_ids, make_blocks
from .common import release_memory, stored
from .text import mixed

LENGTH = 50
GRAM = 20
#: Offsets an anchor can have in a string: 0 to OFFSETS - 1.
OFFSETS = LENGTH - GRAM + 1
#: Text a range of suffixes stands for, one group of a task.
RANGE_BYTES = 1 << 26
#: String starts hashed at a time.
SLICE = 1 << 18
_PLACE_BITS = 20
_RNG = np.random.default_rng(50)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64)
_ODD = int(_RNG.integers(1, 2**62)) * 2 + 1



# ---- blocks of documents -------------------------------------------------------------------

def block_text(docs: list, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's bytes (with LENGTH zeros after), and start, stop and id of each document."""
    raw, start, stop, ids = block_bytes(docs, data)
    return np.frombuffer(raw + bytes(LENGTH), np.uint8), start, stop, ids


def exact_copies(blocks: DataFrame) -> DataFrame:
    """block_id and place of every document whose whole text is that of a smaller id."""
    rows = blocks.select("block_id", F.posexplode("docs").alias("place", "doc")).select(
        "block_id", "place", F.col("doc.id").alias("id"), "doc.size", "doc.digest"
    ).where(F.col("size") >= LENGTH)
    first = rows.groupBy("digest").agg(F.min("id").alias("first"))
    return rows.join(first, "digest").where(F.col("id") > F.col("first")).select("block_id", "place")


# ---- anchors ------------------------------------------------------------------------------

def _gram_hashes(piece: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every place on: polynomial, by doubling."""
    power, hashed, width, parts = _ODD, _BYTE[piece], 1, []
    while width <= GRAM:
        if GRAM & width:
            parts.append((width, hashed, power))
        hashed = hashed[:-width] * np.uint64(power) + hashed[width:]
        power, width = power * power % 2**64, width * 2
    n, out, at = len(piece) - GRAM + 1, None, 0
    for width, hashed, power in reversed(parts):
        part = hashed[at : at + n]
        out = part if out is None else out * np.uint64(power) + part
        at += width
    return mixed(out)


def anchors(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of a block: place, 44-bit hash, document, first and last string start.

    A run of string starts with the same smallest piece has that as its anchor,
    the leftmost on ties. Strings that leave their document are none.
    """
    n = len(text) - LENGTH
    found = []
    for lo in range(0, max(0, n - LENGTH + 1), SLICE):
        piece = text[lo : min(n, lo + SLICE + LENGTH - 1)]
        key = _gram_hashes(piece)
        key = (key >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(key), dtype=np.uint64)
        least, width = key, 1
        while width * 2 <= OFFSETS:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        over = OFFSETS - width
        if over:
            least = np.minimum(least[:-over], least[over:])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], len(least)) - 1
        value = least[first]
        found.append((
            (value & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64) + lo,
            # Mixed again, as least hashes crowd at the low end and are dealt by their high bits.
            mixed(value >> np.uint64(_PLACE_BITS)) >> np.uint64(_PLACE_BITS), first + lo, last + lo,
        ))
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty.astype(np.uint64), empty, empty, empty
    place, hashed, first, last = (np.concatenate(x) for x in zip(*found))
    doc = np.searchsorted(stop, place, "right")
    first, last = np.maximum(first, start[doc]), np.minimum(last, stop[doc] - LENGTH)
    keep = first <= last
    return place[keep], hashed[keep], doc[keep], first[keep], last[keep]


def _packed(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel()


def _by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted hashes and the bucket each belongs to (high bits)."""
    unique = np.unique(hashes)
    return unique, ((unique >> np.uint64(12)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def repeated_anchors(blocks: DataFrame, buckets: int, ranges: int, sample_share: float) -> DataFrame:
    """For each block and hash bucket, which of its distinct hashes are in two documents or more.

    The row of bucket -1 has the splitters instead: quantiles of sampled
    suffixes with their document ids, from which the sort's ranges are dealt.
    """
    rate = max(1, round(1 / sample_share)) if sample_share > 0 else 1

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, docs, data in zip(batch["block_id"], batch["docs"], batch["data"]):
                text, start, stop, ids = block_text(docs, data)
                place, hashed, doc, _, _ = anchors(text, start, stop)
                order = np.lexsort((ids[doc], hashed))
                h, d = hashed[order], ids[doc][order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])]) if len(h) else np.zeros(0, bool)
                many = h[new]
                twice = many[1:][many[1:] == many[:-1]]
                unique, bucket = _by_bucket(hashed, buckets)
                more = np.isin(unique, twice)
                rows = []
                for b in np.unique(bucket):
                    at = bucket == b
                    rows.append((int(b), block, _packed(unique[at]), np.packbits(more[at]).tobytes()))
                # Anchors known to be repeated are sampled more, so that ranges are narrow where suffixes are many.
                rates = np.where(more[np.searchsorted(unique, hashed)], max(1, rate // 4), rate) if len(unique) else hashed
                taken = mixed(hashed ^ mixed(ids[doc].astype(np.uint64) + place.astype(np.uint64))) % rates.astype(np.uint64) == 0
                if taken.any():
                    rows.append((-1, block, suffix_keys(text, place[taken], stop[doc[taken]], ids[doc[taken]]).tobytes(), b""))
                yield pd.DataFrame(rows, columns=["bucket", "block_id", "hashes", "more"])

    def match(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            keys = np.sort(np.concatenate([np.frombuffer(k, KEY) for k in group["hashes"]]))
            cuts = np.unique(keys[[len(keys) * i // ranges for i in range(1, ranges)]])
            return pd.DataFrame({"block_id": [-1], "bucket": [-1], "mask": [cuts.tobytes()]})
        hashes = [_unpacked(h) for h in group["hashes"]]
        more = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(h)).astype(bool) for h, m in zip(hashes, group["more"])]
        unique, count = np.unique(np.concatenate(hashes), return_counts=True)
        masks = [np.packbits((count[np.searchsorted(unique, h)] > 1) | m).tobytes() for h, m in zip(hashes, more)]
        return pd.DataFrame({"block_id": group["block_id"], "bucket": key[0], "mask": masks})

    sent = blocks.select("block_id", "docs", "data").mapInPandas(send, "bucket int, block_id long, hashes binary, more binary")
    return stored(sent.groupBy("bucket").applyInPandas(match, "block_id long, bucket int, mask binary"), "suffix-repeats")


# ---- suffixes: ranges and sort ---------------------------------------------------------------

#: A suffix's first LENGTH bytes, then its document's id: the order of the sort.
KEY = np.dtype(f"S{LENGTH + 9}")
SUFFIX = np.dtype([
    ("right", np.uint8, (LENGTH,)), ("left", np.uint8, (OFFSETS - 1,)), ("id", "<i8"),
    ("block", "<i8"), ("doc", "<i4"), ("place", "<i4"), ("least", "u1"), ("most", "u1"),
])


def right_of(text: np.ndarray, place: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The LENGTH bytes from each place on, zeros after the document's end."""
    at = place[:, None] + np.arange(LENGTH)
    return np.where(at < stop[:, None], text[np.minimum(at, len(text) - 1)], 0).astype(np.uint8)


def left_of(text: np.ndarray, place: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The bytes before each place, nearest first, zeros before the document's start."""
    at = place[:, None] - 1 - np.arange(OFFSETS - 1)
    return np.where(at >= start[:, None], text[np.maximum(at, 0)], 0).astype(np.uint8)


def suffix_keys(text: np.ndarray, place: np.ndarray, stop: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return _keys(right_of(text, place, stop), ids)


def _keys(right: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Byte strings that sort as (suffix, id); the last byte keeps zeros at the end."""
    number = (ids.astype(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.concatenate([right, number, np.ones((len(ids), 1), np.uint8)], 1).copy().view(KEY).ravel()


def multikey_sort(token: Callable[[int], np.ndarray], tokens: int) -> np.ndarray:
    """Order of rows by their 64-bit tokens 0 to ``tokens`` - 1, by multikey quicksort.

    Rows are sorted by one token; only runs of rows that are still equal are
    then sorted by the next.
    """
    first = token(0)
    order = np.argsort(first, kind="stable")
    first = first[order]
    run = np.cumsum(np.concatenate([[0], first[1:] != first[:-1]])) if len(order) else order
    for t in range(1, tokens):
        sizes = np.bincount(run) if len(run) else run
        open_ = np.flatnonzero(sizes[run] > 1)
        if not len(open_):
            break
        rows, runs = order[open_], run[open_]
        value = token(t)[rows]
        inner = np.lexsort((value, runs))
        value = value[inner]
        order[open_] = rows[inner]
        change = np.concatenate([[False], (value[1:] != value[:-1]) & (runs[1:] == runs[:-1])])
        new = np.zeros(len(order), np.int64)
        new[open_[change]] = 1
        run = run + np.cumsum(new)
    return order


def _token(data: np.ndarray, t: int) -> np.ndarray:
    """Bytes 8 t to 8 t + 7 of each row as a number that sorts like them."""
    piece = np.zeros((len(data), 8), np.uint8)
    part = data[:, 8 * t : 8 * t + 8]
    piece[:, : part.shape[1]] = part
    return piece.view(">u8").ravel().astype(np.uint64)


def _shared(data: np.ndarray) -> np.ndarray:
    """Leading bytes each row shares with the row before; -1 for the first."""
    same = np.full(len(data), -1, np.int64)
    for lo in range(1, len(data), 1 << 15):
        hi = min(len(data), lo + (1 << 15))
        differ = data[lo:hi] != data[lo - 1 : hi - 1]
        same[lo:hi] = np.where(differ.any(1), differ.argmax(1), data.shape[1])
    return same


def sort_bucket(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[bytes, int, int]]]:
    """Sort one range of suffixes and compare: sorted rows, offsets removed, strings at its edges.

    The offsets removed (as bits) are those of strings that this range also has
    in a document of smaller id. Strings that may go on in a neighbouring range,
    as their part right of the anchor starts the first or last suffix here, are
    returned as (string, offset, row) for the rows of smallest id.
    """
    wide = -(-LENGTH // 8)
    number = rows["id"].astype(np.uint64) ^ np.uint64(1 << 63)
    rows = rows[multikey_sort(lambda t: _token(rows["right"], t) if t < wide else number, wide + 1)]
    shared = _shared(rows["right"])
    by_left = multikey_sort(lambda t: _token(rows["left"], t), -(-(OFFSETS - 1) // 8))
    shared_left = _shared(rows["left"][by_left])
    mask, edges = np.zeros(len(rows), np.int64), []
    for offset in range(OFFSETS):
        here = np.flatnonzero((rows["least"] <= offset) & (offset <= rows["most"]))
        if not len(here):
            continue
        run = np.cumsum(shared < LENGTH - offset)
        left = np.empty(len(rows), np.int64)
        left[by_left] = np.cumsum(shared_left < offset)
        key, ids = run[here] << 32 | left[here], rows["id"][here]
        order = np.lexsort((ids, key))
        key, ids, here = key[order], ids[order], here[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        smallest = np.repeat(ids[first], np.diff(np.append(first, len(key))))
        mask[here[ids > smallest]] |= 1 << offset
        edge = ((key >> 32 == run[0]) | (key >> 32 == run[-1])) & (ids == smallest)
        edges += [(bytes(rows["left"][r][:offset][::-1]) + bytes(rows["right"][r][: LENGTH - offset]), offset, int(r)) for r in here[edge]]
    return rows, mask, edges


REMOVED = "block_id long, doc int, place int, mask long, string binary, id long"


def removed_strings(blocks: DataFrame, repeats: DataFrame, copies: DataFrame, buckets: int) -> DataFrame:
    """block_id, doc (place in the block), place of an anchor, mask of its offsets whose strings go."""
    cuts = repeats.where("bucket < 0").first()
    splitters = np.frombuffer(cuts["mask"], KEY) if cuts else np.zeros(0, KEY)
    flags = repeats.where("bucket >= 0").unionByName(
        copies.groupBy("block_id").agg(F.collect_list("place").alias("places"))
        .select("block_id", F.lit(-2).alias("bucket"), F.array_join("places", ",").cast("binary").alias("mask"))
    )

    def deal(key: tuple, block: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3).compress
        out = []
        for block_id, docs, data in zip(block["block_id"], block["docs"], block["data"]):
            text, start, stop, ids = block_text(docs, data)
            place, hashed, doc, first, last = anchors(text, start, stop)
            unique, bucket = _by_bucket(hashed, buckets)
            repeated = np.zeros(len(unique), bool)
            copied = np.zeros(len(docs), bool)
            for b, mask in zip(flags["bucket"], flags["mask"]):
                if b >= 0:
                    at = bucket == b
                    repeated[at] = np.unpackbits(np.frombuffer(mask, np.uint8), count=int(at.sum())).astype(bool)
                else:
                    copied[[int(x) for x in mask.split(b",")]] = True
            keep = repeated[np.searchsorted(unique, hashed)] & ~copied[doc] if len(unique) else np.zeros(0, bool)
            if not keep.any():
                continue
            place, doc, first, last = place[keep], doc[keep], first[keep], last[keep]
            rows = np.zeros(len(place), SUFFIX)
            rows["right"], rows["left"] = right_of(text, place, stop[doc]), left_of(text, place, start[doc])
            rows["id"], rows["block"], rows["doc"], rows["place"] = ids[doc], block_id, doc, place - start[doc]
            rows["least"], rows["most"] = place - last, place - first
            keys = _keys(rows["right"], rows["id"])
            order = np.argsort(keys, kind="stable")
            rows, keys = rows[order], keys[order]
            edge = np.searchsorted(keys, splitters, "left")
            for r, (lo, hi) in enumerate(zip(np.append(0, edge), np.append(edge, len(rows)))):
                if lo < hi:
                    out.append((r, squeeze(rows[lo:hi].tobytes())))
        return pd.DataFrame(out, columns=["range", "suffixes"])

    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        release_memory()
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        buffer = bytearray()
        for part in group["suffixes"]:
            buffer += expand(part)
        rows, mask, edges = sort_bucket(np.frombuffer(buffer, SUFFIX))
        del buffer
        hit = np.flatnonzero(mask)
        found = pd.DataFrame({"block_id": rows["block"][hit], "doc": rows["doc"][hit], "place": rows["place"][hit], "mask": mask[hit], "string": None, "id": rows["id"][hit]})
        at = np.fromiter((r for _, _, r in edges), np.int64, len(edges))
        edge = pd.DataFrame({
            "block_id": rows["block"][at], "doc": rows["doc"][at], "place": rows["place"][at],
            "mask": [1 << o for _, o, _ in edges], "string": [s for s, _, _ in edges], "id": rows["id"][at],
        })
        return pd.concat([found, edge]) if len(found) and len(edge) else (found if len(found) else edge)

    keyed = blocks.select(F.col("block_id").alias("b"), "block_id", "docs", "data")
    dealt = keyed.groupBy("b").cogroup(flags.withColumn("b", F.col("block_id")).groupBy("b")).applyInPandas(deal, "range int, suffixes binary")
    sorted_ = stored(dealt.groupBy("range").applyInPandas(compare, REMOVED), "suffix-removed")
    edges = sorted_.where(F.col("string").isNotNull())
    smallest = edges.groupBy("string").agg(F.min("id").alias("smallest"))
    across = edges.join(smallest, "string").where(F.col("id") > F.col("smallest"))
    columns = ["block_id", "doc", "place", "mask"]
    return sorted_.where(F.col("string").isNull()).select(columns).unionByName(across.select(columns))


# ---- the operator -------------------------------------------------------------------------------

RESULT = "doc_id long, digest string, n_bytes long, n_removed long, spans array<struct<start: long, length: long>>, kept binary"


def remove_repeats(docs: DataFrame, ranges: int | None = None, sample_per_range: int = 20) -> DataFrame:
    """Every document without the bytes of LENGTH-byte strings that a document of smaller id has too.

    ``docs`` needs doc_id and text; other columns are ignored. Texts are UTF-8
    bytes, NULL the empty text; matches never cross documents; strings are
    judged on the input. Returns doc_id, digest (SHA-256 of the input text),
    n_bytes, n_removed, spans (maximal removed runs), kept (remaining bytes).

    Documents of less than LENGTH bytes stay whole. Rows that share an id
    remove nothing from one another. A NULL id is larger than any. Repeated
    strings in one document alone stay. An empty table gives an empty result.

    Scale: texts are compressed in blocks of 1 MB, written once. Whole copies are
    found by digest. Of a block, each distinct anchor is sent once, in 6
    bytes, so frequent passages cost no more than rare ones; only suffixes at
    repeated anchors are sent. Ranges are dealt by (suffix, id), so one frequent
    passage spreads over as many ranges as it fills; what may go on in another
    range is compared in a last pass of one row a range, string and offset.
    The driver holds ``ranges`` splitters of 59 bytes: one for each RANGE_BYTES of text, or shuffle partition if those are more.
    """
    blocks = make_blocks(docs, "suffix-blocks")
    gone = _gone(blocks, ranges, sample_per_range)

    def cut(key: tuple, block: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
        out = []
        for docs, data in zip(block["docs"], block["data"]):
            for d, known, (body, drop) in zip(docs, known_ids(docs), kept_bytes(docs, data, gone["doc"], gone["place"], gone["mask"])):
                edge = np.flatnonzero(np.diff(drop.astype(np.int8), prepend=0, append=0))
                spans = [{"start": int(a), "length": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]
                out.append((known, d["digest"], len(drop), int(drop.sum()), spans, body))
        table = pd.DataFrame(out, columns=["doc_id", "digest", "n_bytes", "n_removed", "spans", "kept"], dtype=object)
        return table.assign(doc_id=pd.array([row[0] for row in out], "Int64"))

    return blocks.groupBy("block_id").cogroup(gone.groupBy("block_id")).applyInPandas(cut, RESULT)


def _gone(blocks: DataFrame, ranges: int | None, sample_per_range: int) -> DataFrame:
    """What goes of each block: anchors with their offsets, and place -1 for a whole document."""
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    ranges = ranges or max(parts, total // RANGE_BYTES)
    buckets = max(parts, total >> 25)
    copies = stored(exact_copies(blocks), "suffix-copies")
    repeats = repeated_anchors(blocks, buckets, ranges, min(1.0, sample_per_range * ranges * 15 / max(total, 1)))
    removed = removed_strings(blocks, repeats, copies, buckets)
    whole = copies.select("block_id", F.col("place").alias("doc"), F.lit(-1).alias("place"), F.lit(0).cast("long").alias("mask"))
    return removed.unionByName(whole)


def kept_bytes(docs: list, data: bytes, doc: pd.Series, place: pd.Series, mask: pd.Series) -> Iterator[tuple[bytes, np.ndarray]]:
    """Of each document of a block: the bytes that stay, and which of its bytes go."""
    text, start, stop, _ = block_text(docs, data)
    doc, place, mask = (np.asarray(x, np.int64) for x in (doc, place, mask))
    whole = place < 0
    at, mask = (start[doc] + place)[~whole], mask[~whole]
    begins = np.concatenate([at[(mask >> offset & 1).astype(bool)] - offset for offset in range(OFFSETS)])
    first = np.zeros(len(text), bool)
    first[begins] = True
    # The last start at or before each byte: within LENGTH of it, the byte goes.
    last = np.maximum.accumulate(np.where(first, np.arange(len(text), dtype=np.int32), np.int32(-LENGTH)))
    drop = np.arange(len(text), dtype=np.int32) - last < LENGTH
    for d in doc[whole]:
        drop[start[d] : stop[d]] = True
    for lo, hi in zip(start, stop):
        yield text[lo:hi][~drop[lo:hi]].tobytes(), drop[lo:hi]


def without_repeats(docs: DataFrame, ranges: int | None = None, sample_per_range: int = 20) -> DataFrame:
    """``docs`` with the repeats gone from text, and n_chars, where there is one, counted anew.

    Of a character cut in two nothing stays. Documents of which nothing is left
    go; those that were empty stay as they are.
    """
    blocks = make_blocks(docs, "suffix-blocks", carry=True)
    gone = _gone(blocks.drop("rest"), ranges, sample_per_range)
    names = docs.columns

    def cut(block: pa.Table, gone: pa.Table) -> pa.Table:
        gone, tables = gone.to_pandas(), []
        for row in block.to_pylist():
            rest, texts = carried(row["rest"]), []
            keep = []
            for body, drop in kept_bytes(row["docs"], row["data"], gone["doc"], gone["place"], gone["mask"]):
                texts.append(body.decode("utf-8", "ignore"))
                keep.append(bool(texts[-1]) or not drop.any())
            table = rest.append_column("text", pa.array(texts, pa.string()))
            if "n_chars" in names:
                i = table.schema.get_field_index("n_chars")
                table = table.set_column(i, "n_chars", pa.array([len(t) for t in texts]).cast(table.schema.field(i).type))
            tables.append(table.select(names).filter(pa.array(keep, pa.bool_())))
        return pa.concat_tables(tables) if tables else pa.table({n: [] for n in names})

    schema = docs.withColumn("doc_id", F.col("doc_id").cast("long")).schema
    return blocks.groupBy("block_id").cogroup(gone.groupBy("block_id")).applyInArrow(cut, schema)
