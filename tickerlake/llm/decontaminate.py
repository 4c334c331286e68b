"""Benchmark decontamination: training words streamed through a suffix automaton of the test items."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A word: a run of digits, Latin letters (A-Z lower-cased before) and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of test items in one automaton; more items make more automata.
SHARD_WORDS = 250_000
#: Bytes of a text that are cut into words at a time.
CHUNK = 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes in lower case; those of no word as spaces. All bytes of a character beyond ASCII are word bytes.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def word_chunks(data: bytes) -> Iterator[tuple[int, bytes]]:
    """A text's normalised bytes with their offset, cut between words."""
    clean, lo = data.translate(_NORMAL), 0
    while lo < len(clean):
        hi = lo + CHUNK
        if hi < len(clean):
            cut = clean.rfind(b" ", lo, hi)
            hi = cut + 1 if cut >= lo else clean.find(b" ", hi) + 1 or len(clean)
        yield lo, clean[lo:hi]
        lo = hi


class Automaton:
    """Generalised suffix automaton over the words of test items.

    A state stands for the word sequences that end at the same places of the
    items; ``length`` is its longest, ``link`` the state of the longest suffix
    that ends at more places. An item of at least ``window`` words leaks where
    that many consecutive words of it occur, a shorter one where all of it does.
    """

    def __init__(self, items: Iterable[tuple[str, list[str]]], window: int):
        self.window = window
        self.step: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        self.vocabulary: dict[bytes, int] = {}
        numbered = []
        for item, words in items:
            ids = [self.vocabulary.setdefault(w.encode("utf-8", "surrogatepass"), len(self.vocabulary)) for w in words]
            if ids:
                numbered.append((item, ids))
            state = 0
            for word in ids:
                state = self._extend(state, word)
        by_length = sorted(range(len(self.step)), key=self.length.__getitem__)
        #: The state of the last ``window`` words of a state's longest sequence.
        self.last = list(range(len(self.step)))
        for state in by_length[1:]:
            if self.length[self.link[state]] >= window:
                self.last[state] = self.last[self.link[state]]
        #: State -> items with that window; state -> lengths and items of whole short items.
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for item, ids in numbered:
            state = 0
            for i, word in enumerate(ids):
                state = self.step[state][word]
                if i + 1 >= window:
                    self.items.setdefault(self.last[state], set()).add(item)
            if len(ids) < window:
                self.short.setdefault(state, {}).setdefault(len(ids), set()).add(item)
        #: Nearest state on the way of links, itself included, with a short item; -1 without.
        self.above = [-1] * len(self.step)
        for state in by_length[1:]:
            self.above[state] = state if state in self.short else self.above[self.link[state]]

    def _new(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        return len(self.step) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of ``state``'s longest sequence and ``word``, apart from ``target``'s longer ones."""
        if self.length[target] == self.length[state] + 1:
            return target
        own = self._new(self.length[state] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = own
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = own
            state = self.link[state]
        return own

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word, self.step[last][word])
        made, state = self._new(self.length[last] + 1, 0, {}), last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = made
            state = self.link[state]
        if state >= 0:
            self.link[made] = self._split(state, word, self.step[state][word])
        return made

    def scan(self, data: bytes) -> tuple[int, list[list[int]], set[str]]:
        """Number of words, runs [first, last) of words inside windows that occur, and the windows' items."""
        step, link, length, last, above = self.step, self.link, self.length, self.last, self.above
        window, known = self.window, self.vocabulary.get
        n, state, matched = 0, 0, 0
        spans: list[list[int]] = []
        found: set[tuple[int, int]] = set()
        for _, chunk in word_chunks(data):
            words = chunk.split()
            for i, word in enumerate(map(known, words), n + 1):
                # The longest suffix of the words so far that some item has too.
                if word is None:
                    state = matched = 0
                    continue
                to = step[state].get(word)
                if to is None:
                    while to is None and state:
                        state = link[state]
                        to = step[state].get(word)
                    matched = length[state]
                state = to
                matched += 1
                if matched < window and above[state] < 0:
                    continue
                covers = matched if matched >= window else 0
                if covers:
                    found.add((last[state], 0))
                at = above[state]
                while at >= 0:
                    for n_words in self.short[at]:
                        if n_words <= matched:
                            covers = max(covers, n_words)
                            found.add((at, n_words))
                    at = above[link[at]]
                if covers:
                    first = i - covers
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append([first, i])
            n += len(words)
        items = (self.short[at][size] if size else self.items[at] for at, size in found)
        return n, spans, set().union(*items)


def without_spans(data: bytes, spans: list[list[int]]) -> bytes:
    """The text without the bytes from each run's first word to its last."""
    edges = iter(sorted(x for a, b in spans for x in (a, b - 1)))
    edge, at, cuts = next(edges, None), 0, []
    for lo, chunk in word_chunks(data):
        end = 0
        for word in chunk.split():
            start = chunk.find(word, end)
            end = start + len(word)
            while edge == at:
                cuts.append(lo + (end if len(cuts) % 2 else start))
                edge = next(edges, None)
            at += 1
    parts, done = [], 0
    for first, last in zip(cuts[::2], cuts[1::2]):
        parts.append(data[done:first])
        done = last
    return b"".join([*parts, data[done:]])


def automata(items: DataFrame, window: int, shard_words: int) -> Iterator[Automaton]:
    """Automata of all items, each of about ``shard_words`` words; one at least.

    A longer item is cut into pieces that overlap by ``window`` - 1 words, so every
    window lies in one of them.
    """
    words = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("words")).where(F.size("words") > 0)
    first = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)), F.lit(shard_words))
    pieces = rows.withColumn("first", F.explode(first)).select(
        "item", F.slice("words", F.col("first"), F.lit(shard_words + window - 1)).alias("words")).distinct()
    total = pieces.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    shards = max(1, -(-total // shard_words))
    shard = F.pmod(F.xxhash64("item", "words"), F.lit(shards))
    for s in range(shards):
        yield Automaton(((r["item"], r["words"]) for r in pieces.where(shard == s).sort("item", "words").collect()), window)


_FOUND = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string())),
])
_FOUND_DDL = "struct<n_words: long, spans: array<array<long>>, items: array<string>>"


def _name(columns: list[str], wanted: str) -> str:
    """A column name that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while wanted in taken:
        wanted += "_"
    return wanted


def _mapped(docs: DataFrame, held: Broadcast, change: Callable[[pa.RecordBatch, list[dict]], pa.RecordBatch], schema: str) -> DataFrame:
    """``change`` of every batch and of what the automaton finds in each of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = held.value
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                n, spans, items = automaton.scan(text.encode("utf-8", "surrogatepass") if text else b"")
                found.append({"n_words": n, "spans": spans, "items": sorted(items)})
            yield change(batch, found)

    return docs.mapInArrow(run, schema)


def _merged(lists):
    """Runs of several automata as maximal runs."""
    def add(done, run):
        last = F.element_at(done, -1)
        joined = F.array(last[0], F.greatest(last[1], run[1]))
        return F.when((F.size(done) > 0) & (last[1] >= run[0]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(F.array_sort(F.flatten(lists)), F.array().cast("array<array<long>>"), add)


def with_leaks(docs: DataFrame, items: DataFrame, window: int = 10, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, str]:
    """``docs`` and a column, of the returned name, of struct<n_words, spans, items>.

    One automaton: a map over the documents. More: one map for each, over the
    documents stored with a number, and only those with hits are joined to them.
    """
    name = _name(docs.columns, "leaks")
    texts = docs.withColumn("text", F.col("text").cast("string"))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    machines = automata(items, window, shard_words)
    first, second = next(machines), next(machines, None)
    sc = docs.sparkSession.sparkContext
    if second is None:
        def attach(batch: pa.RecordBatch, found: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _FOUND)], [*batch.schema.names, name])

        return _mapped(texts, sc.broadcast(first), attach, f"{ddl}, `{name}` {_FOUND_DDL}"), name
    row = _name([*docs.columns, name], "row")
    numbered = stored(texts.withColumn(row, F.monotonically_increasing_id()), "leaks-documents")

    def hits(batch: pa.RecordBatch, found: list[dict]) -> pa.RecordBatch:
        kept = [f if f["spans"] else None for f in found]
        return pa.RecordBatch.from_arrays([batch.column(row), pa.array(kept, _FOUND)], [row, name])

    def shard(machine: Automaton) -> DataFrame:
        held = sc.broadcast(machine)
        found = _mapped(numbered.select(row, "text"), held, hits, f"`{row}` long, `{name}` {_FOUND_DDL}")
        found = stored(found.where(F.col(f"`{name}`").isNotNull()), "leaks-found")
        held.destroy()
        return found

    parts = [shard(first), shard(second), *map(shard, machines)]
    leak = F.col(f"`{name}`")
    words = F.coalesce(F.regexp_count(F.translate("text", _UPPER, _LOWER), F.lit(WORD)), F.lit(0)).cast("long")
    every = reduce(DataFrame.unionByName, parts).groupBy(row).agg(
        _merged(F.collect_list(leak["spans"])).alias("_spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list(leak["items"])))).alias("_items"))
    every = every.select(row, F.struct("_spans", "_items").alias(name))
    joined = numbered.join(every, row, "left").withColumn(name, F.struct(
        words.alias("n_words"), F.coalesce(leak["_spans"], F.array().cast("array<array<long>>")).alias("spans"),
        F.coalesce(leak["_items"], F.array().cast("array<string>")).alias("items")))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"`{name}`")), name


def find_leaks(docs: DataFrame, items: DataFrame, window: int = 10, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, spans and items: which words of whole texts lie in test items.

    Words are in lower case (A-Z). A window is ``window`` consecutive words of
    an item, or all words of a shorter one; a document's word is hit if it lies in
    an occurrence of a window. ``spans`` has maximal runs of hit words as
    [first, last), ``items`` the distinct ids of items with a window that occurs, as
    sorted strings; ``longest`` is the longest run.

    ``items`` has item_id and text. NULL and empty texts have no words: they
    hit nothing and are hit by nothing. A NULL item_id counts as ''; repeated
    items count once; repeated documents each have a row, NULL doc_ids too. Other columns are
    ignored; an empty table of documents gives an empty result, one of items no hits.
    """
    found, name = with_leaks(docs.select("doc_id", "text"), items, window, shard_words)
    leak = F.col(f"`{name}`")
    run = F.transform(leak["spans"], lambda s: s[1] - s[0])
    return found.select(
        "doc_id", leak["n_words"].alias("n_words"), F.aggregate(run, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_hit"),
        leak["spans"].alias("spans"), leak["items"].alias("items"), F.coalesce(F.array_max(run), F.lit(0)).cast("long").alias("longest"),
    )


def remove_leaks(
    docs: DataFrame, items: DataFrame, window: int = 10, span_words: int = 10, max_coverage: float = 0.5, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """``docs`` without leaked spans: runs of at least ``span_words`` hit words go from the texts.

    Documents of whose words more than ``max_coverage`` are hit go as a whole.
    All columns are kept; of ``text`` what lies between the removed runs stays as it was.
    NULL, empty and repeated rows: as ``find_leaks``; they are kept as they are.
    """
    found, name = with_leaks(docs, items, window, shard_words)
    leak = F.col(f"`{name}`")
    hit = F.aggregate(leak["spans"], F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0])
    kept = found.where(hit <= max_coverage * leak["n_words"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, spans in enumerate(batch.column(name).field("spans").to_pylist()):
                long = [s for s in spans if s[1] - s[0] >= span_words]
                if long:
                    texts[i] = without_spans(texts[i].encode("utf-8", "surrogatepass"), long).decode("utf-8", "surrogatepass")
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type)).drop_columns([name])

    ddl = ", ".join(f"`{c}` {t}" for c, t in kept.drop(name).dtypes)
    return kept.mapInArrow(cut, ddl)
