"""Cost-balanced packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import json
import string
import sys
import unicodedata
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped_texts, release_memory, stored

#: Distinct runs whose ids a worker process remembers, from task to task; others are tokenised each time.
REMEMBERED = 500_000

PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, "
    "blocks array<struct<start: long, length: long, ids_crc32: long>>"
)
PACKED = (
    "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, cost double"
)


def forget_tokenizers() -> None:
    """Drop what this worker process remembers of tokenisers; tasks of other work call it first."""
    sys.modules.pop("_packing_tokenizers", None)
    release_memory()


#: Normaliser and splitter of the tokenizers whose texts may be cut (see ``WordTokenizer``).
CUTTABLE = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    {
        "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed", "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


class WordTokenizer:
    """Ids of whole texts, and an end id.

    A tokenizer that lower-cases, drops spaces and cuts letters from
    punctuation, as CUTTABLE does, gives a text the ids of its space-separated parts in turn,
    and a part of letters (in lower case, too) and punctuation the ids of both, whatever the case. So each
    distinct run is tokenised once and remembered. Of any other tokenizer whole texts are encoded.
    """

    def __init__(self, path: str, end_id: int):
        kept = sys.modules.setdefault("_packing_tokenizers", ModuleType("_packing_tokenizers")).__dict__
        if path not in kept:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            made = json.loads(tokenizer.to_str())
            steps = [*(made["normalizer"] or {}).get("normalizers", []), *(made["pre_tokenizer"] or {}).get("pretokenizers", [])]
            kept[path] = (tokenizer.encode, {}, steps == CUTTABLE and made["model"].get("type") == "BPE")
        self.encode, self.known, self.cuttable = kept[path]
        self.end = np.uint32(end_id).astype("<u4").tobytes()

    def part(self, part: str) -> bytes:
        known, room = self.known.get, REMEMBERED // 4
        letters = part.rstrip(string.punctuation)
        if len(letters) < len(part) and letters.isalpha() and (letters.isascii() or unicodedata.normalize("NFC", letters).lower().isalpha()):
            marks = part[len(letters) :]
            got = (known(letters) or self.part(letters)) + (known(marks) or self.part(marks))
        elif part.isascii() and not part.islower() and part.isalpha():
            got = known(part.lower()) or self.part(part.lower())
        else:
            got, room = np.array(self.encode(part, add_special_tokens=False).ids, "<u4").tobytes(), REMEMBERED
        if len(self.known) < room:
            self.known[part] = got
        return got

    def ids(self, text: str | None) -> bytes:
        """The text's ids and the end id, as little-endian unsigned 32-bit numbers."""
        if not self.cuttable:
            return np.array(self.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes() + self.end
        parts = (text or "").replace("\n", " ").split(" ")
        known, out = self.known.get, []
        for part in parts:
            got = known(part)
            out.append(self.part(part) if got is None else got)
        out.append(self.end)
        return b"".join(out)


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int, list[tuple[int, int, int]]]]:
    """Full sequences from the start, then the rest as one piece with its blocks.

    Blocks are the rest's parts of falling power-of-two lengths: where it may be
    cut further without reading its ids again.
    """
    n = len(ids) // 4
    pieces = [(s, capacity, zlib.crc32(ids[4 * s : 4 * (s + capacity)]), []) for s in range(0, n - n % capacity, capacity)]
    if rest := n % capacity:
        at, blocks = n - rest, []
        for bit in reversed(range(rest.bit_length())):
            if rest >> bit & 1:
                blocks.append((at, 1 << bit, zlib.crc32(ids[4 * at : 4 * (at + (1 << bit))])))
                at += 1 << bit
        pieces.append((n - rest, rest, zlib.crc32(ids[4 * (n - rest) :]), blocks))
    return pieces


def pack_pieces(pieces: pd.DataFrame, capacity: int, linear: float, quadratic: float) -> pd.DataFrame:
    """Sequences of one group of pieces; ``sequence_id`` counts from 0. Ids are text, NULL after all others.

    As many sequences as the tokens fill are open from the start. Pieces, longest
    first, each go to the sequence of least cost that has room; a piece that
    fits nowhere is cut into its blocks, and a block that fits nowhere becomes a
    sequence of its own, whose power-of-two length needs no padding. A piece of
    n tokens costs ``linear * n + quadratic * n * n``.
    """
    number = pd.array([None if d is None else int(d) for d in pieces["doc_id"]], "Int64")
    order = pieces.assign(number=number).sort_values(["length", "number", "start"], ascending=[False, True, True], kind="stable")
    count = int(order["length"].sum()) // capacity
    cost, room = np.zeros(count), np.full(count, capacity, np.int64)
    own, rows, waiting = 0, [], []

    def place(doc: str | None, start: int, n: int, crc: int, tokens: int) -> bool:
        fits = np.flatnonzero(room >= n)
        if not len(fits):
            return False
        at = int(fits[np.argmin(cost[fits])])
        price = linear * n + quadratic * n * n
        rows.append((doc, start, n, crc, tokens, at, capacity - int(room[at]), price))
        cost[at] += price
        room[at] -= n
        return True

    for doc, start, n, crc, tokens, blocks in order[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "blocks"]].itertuples(index=False):
        if not place(doc, start, n, crc, tokens):
            waiting += [(doc, b["start"], b["length"], b["ids_crc32"], tokens) for b in blocks]
    for block in sorted(waiting, key=lambda b: -b[2]):
        if not place(*block):
            doc, start, n, crc, tokens = block
            rows.append((doc, start, n, crc, tokens, count + own, 0, linear * n + quadratic * n * n))
            own += 1
    return pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"])


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    tokens_per_group: int = 1 << 20,
) -> DataFrame:
    """Pack every document's tokens into sequences of at most ``capacity`` tokens.

    ``docs`` needs doc_id and text; other columns are ignored. Returns one row
    per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    cost (estimated, linear plus quadratic in the piece's length). Every id is
    in exactly one piece; offsets in a sequence run without gaps from 0.

    ``capacity`` must be a power of two. NULL and empty texts are documents of
    the end id alone. Rows that share a doc_id are packed as separate documents.
    An empty table gives an empty result.

    Scale: ids never leave the task that makes them, only pieces do. Pieces are
    dealt by hash into groups of about ``tokens_per_group`` tokens, each packed
    by itself; a group leaves no padding beyond a few hundred tokens, so
    their number costs nothing. Long documents and hot sources spread evenly.
    """

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_memory()
        words = WordTokenizer(tokenizer_path, end_id)
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part, rows = batch.iloc[lo : lo + 512], []
                for doc, text in zip(part["doc_id"].tolist(), part["text"].tolist()):
                    ids = words.ids(text)
                    rows += [(doc, s, n, crc, len(ids) // 4, [{"start": a, "length": b, "ids_crc32": c} for a, b, c in blocks]) for s, n, crc, blocks in cut(ids, capacity)]
                yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "blocks"])

    pieces = mapped_texts(docs, tokenise, PIECES).withColumn("row", F.monotonically_increasing_id())
    pieces = stored(pieces, "pack-pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(total / tokens_per_group))

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        packed = pack_pieces(group, capacity, linear, quadratic)
        packed["sequence_id"] += np.int64(key[0]) << 32
        return packed

    # By row too: many equal rows fill many groups.
    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "row"), F.lit(groups))
    dealt = pieces.withColumn("_group", group).withColumn("doc_id", F.col("doc_id").cast("string")).drop("row")
    return dealt.groupBy("_group").applyInPandas(pack, PACKED).withColumn("doc_id", F.col("doc_id").cast("long"))
