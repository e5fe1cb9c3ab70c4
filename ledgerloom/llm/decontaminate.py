"""Benchmark decontamination (2): a generalised suffix automaton over the words of all test items.

The automaton is built once, on the driver, from a block of items of at most `block_words` words (a longer item is a
block of its own), and broadcast: blocks bound what the driver and a task hold, whatever the benchmark's size. Documents
stream through it word by word; the state and the length of the longest match ending at each word are tracked. Wherever
a match reaches a window (`width` words, or all words of a shorter item), the words it covers are hit. A benchmark of
several blocks is one pass for each, without a shuffle; passes are written to the scratch folder, so one automaton is
alive at a time, and what counts is the union of the hits of all blocks.

Nulls and empty texts have no words, hence no hits; an item without words has no window. Items are told apart by their
ids: rows that repeat one, be their texts alike or not, are one item with the windows of all (a null id is an empty
one). Repeated rows of documents fare alike. An empty benchmark hits nothing; empty documents give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.shared import _CUT, every, free_names, map_batches, map_rows, scratch, texts, words_of

WIDTH = 10
#: Words of items in one automaton, of about 0.5 KB each at most.
BLOCK_WORDS = 200_000
#: Documents of which this share of the words or more is hit are dropped, not cut.
MAX_COVERAGE = 0.5


class Automaton:
    """Suffix automaton of many word sequences: moves (by state and word), link and length by state; windows and whole:
    what ends in a state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int) -> None:
        self.width = width
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[int]] = [set()]
        short: list[list[tuple[int, int]]] = [[]]
        self.names = [name for name, _ in items]
        for k, (_, words) in enumerate(items):
            last = 0
            path = []
            for w in words:
                last = self._extend(last, w, ends, short)
                path.append(last)
            for state in path:
                ends[state].add(k)
            if 0 < len(words) < width:
                short[path[-1]].append((len(words), k))
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True)
        for v in order:  # what ends in a state ends in the states of its suffixes
            if self.link[v] > 0:
                ends[self.link[v]] |= ends[v]
        #: Items whose window of `width` words ends in a state, when a match is that long.
        self.windows: dict[int, tuple[int, ...]] = {}
        #: (length, item) of whole short items that end in a state, the longest last.
        self.whole: dict[int, tuple[tuple[int, int], ...]] = {}
        for v in reversed(order):
            up = self.link[v]
            if self.length[v] >= width:
                self.windows[v] = tuple(sorted(ends[v])) if self.length[up] < width else self.windows[up]
            if both := self.whole.get(up, ()) + tuple(sorted(short[v])):
                self.whole[v] = both
        #: What is sent: words by number, and one table of moves from state * words + word.
        self.number = {w: k for k, w in enumerate(sorted({w for moves in self.next for w in moves}))}
        n = len(self.number)
        self.moves = {v * n + self.number[w]: to for v, moves in enumerate(self.next) for w, to in moves.items()}
        del self.next

    def _extend(self, last: int, w: bytes, ends: list, short: list) -> int:
        nxt, link, length = self.next, self.link, self.length

        def state(n: int, to: int, moves: dict) -> int:
            nxt.append(moves)
            link.append(to)
            length.append(n)
            ends.append(set())
            short.append([])
            return len(nxt) - 1

        def split(p: int, q: int) -> int:
            """A state for the longest match of p and w alone, taken out of q."""
            clone = state(length[p] + 1, link[q], dict(nxt[q]))
            ends[clone] |= ends[q]
            link[q] = clone
            while p >= 0 and nxt[p].get(w) == q:
                nxt[p][w] = clone
                p = link[p]
            return clone

        q = nxt[last].get(w)
        if q is not None:
            return q if length[q] == length[last] + 1 else split(last, q)
        new = state(length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else split(p, q)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans of hit words (end exclusive, apart from each other) and the items whose windows occur."""
        move, link, length, whole, windows, width, n_words = self.moves.get, self.link, self.length, self.whole, self.windows, self.width, len(self.number)
        spans: list[list[int]] = []
        seen: set[int] = set()
        items: set[int] = set()
        v = n = 0
        for i, w in enumerate(map(self.number.get, words)):
            if w is None:  # in no item
                v = n = 0
                continue
            to = move(v * n_words + w)
            if to is None:
                while v > 0 and to is None:
                    v = link[v]
                    to = move(v * n_words + w)
                n = length[v]
            v = to
            n += 1
            if n >= width:
                start = i + 1 - n
                if v not in seen:
                    seen.add(v)
                    items.update(windows[v])
                    items.update(k for _, k in whole.get(v, ()))
            elif v in whole:
                fit = [(m, k) for m, k in whole[v] if m <= n]
                if not fit:
                    continue
                items.update(k for _, k in fit)
                start = i + 1 - max(m for m, _ in fit)
            else:
                continue
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append([start, i + 1])
        return [(a, b) for a, b in spans], items


def automatons(benchmark: DataFrame, width: int, block_words: int) -> Iterator[tuple[Automaton, bool]]:
    """The automaton of each block of items, and whether it is the last; one at least. Items come to the driver one
    partition at a time, and a block at a time is held."""
    held: list[tuple[str, list[bytes]]] = []
    size = 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), F.col("text").cast("string").alias("t"))
    for i, t in rows.toLocalIterator():
        if words := words_of(t):
            if held and size + len(words) > block_words:
                yield Automaton(held, width), False
                held, size = [], 0
            held.append((i, words))
            size += len(words)
    yield Automaton(held, width), True


def find(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, spans (array of first and end word, joined over all items) and items (ids as strings)."""
    out = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.array().cast("array<struct<a:int,b:int>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    found = "doc_id long, n_words long, spans array<struct<a:int,b:int>>, items array<string>"
    for automaton, last in automatons(benchmark, width, block_words):  # only a further pass needs the texts
        sent = docs.sparkSession.sparkContext.broadcast(automaton)
        out = map_batches(out, _finder(sent, not last), found + ", text string" * (not last))
        if not last:
            out = scratch(out, "scanned")
            sent.destroy()
    return out


def _finder(sent, more: bool):
    def make():
        automaton = sent.value

        def one(batch: pa.RecordBatch) -> dict:
            old = {n: batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "spans", "items")}
            spans, items, counts = [], [], []
            for text, before, ids in zip(texts(batch), old["spans"].to_pylist(), old["items"].to_pylist(), strict=True):
                words = words_of(text)
                found, hit = automaton.scan(words)
                counts.append(len(words))
                spans.append([{"a": a, "b": b} for a, b in joined(found + [(x["a"], x["b"]) for x in before])])
                items.append(sorted({*ids, *(automaton.names[k] for k in hit)}))
            out = {"doc_id": old["doc_id"], "n_words": counts, "spans": spans, "items": items}
            return out | {"text": batch.column(batch.schema.get_field_index("text"))} if more else out

        return one

    return make


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them; what stood around a span stays, parted by
    a space where nothing else parts it."""
    raw = text.encode()
    flat, places, at = raw.translate(_CUT), [], 0
    for w in flat.split():
        at = flat.index(w, at)
        places.append((at, at + len(w)))
        at += len(w)
    out, done = [], 0
    for a, b in spans:
        out.append(raw[done : places[a][0]])
        done = places[b - 1][1]
    out.append(raw[done:])
    return b" ".join(x.strip(b" ") for x in out if x.strip(b" ")).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with their columns: documents of which the items hit `max_coverage` of the words or more go; the others lose
    their hit spans, again until none is left (a cut may join the parts of an item). Texts without hits stay as they
    are. All blocks of items are looked at before a document is judged or cut, so `block_words` changes nothing."""
    spark, names = docs.sparkSession, docs.columns
    at, size = names.index("text"), len(names)
    first = automatons(benchmark, width, block_words)
    automaton, last = next(first)
    if last:
        return map_rows(docs, _cleaner(spark.sparkContext.broadcast(automaton), max_coverage, at), docs.schema)
    spans, again = free_names(names, "hit_spans", "was_cut")
    todo, done, judge = docs.select(*every(names), F.array().cast("array<struct<a:int,b:int>>").alias(spans)), None, True
    while True:
        while True:
            sent = spark.sparkContext.broadcast(automaton)
            todo = scratch(map_rows(todo, _marker(sent, at, size), todo.schema), "marked")
            sent.destroy()
            if last:
                break
            automaton, last = next(first)
        schema = todo.withColumn(again, F.lit(True)).schema
        todo = scratch(map_rows(todo, _cutter(max_coverage if judge else None, at, size, schema), schema), "cut")
        ready = todo.where(~F.col(again)).select(*every(names))
        done = ready if done is None else done.unionByName(ready)
        todo = todo.where(F.col(again)).select(*every(names), F.array().cast("array<struct<a:int,b:int>>").alias(spans))
        if not todo.head(1):
            return done
        judge, first = False, automatons(benchmark, width, block_words)
        automaton, last = next(first)


def _cleaner(sent, max_coverage: float, at: int):
    """One block of items: judged and cut until nothing is hit, in one pass."""

    def run(batches):
        automaton = sent.value
        for batch in batches:
            keep, new = [], []
            for text in batch.column(at).to_pylist():
                words = words_of(text)
                spans, _ = automaton.scan(words)
                keep.append(not _covered(spans, len(words), max_coverage))
                while spans and keep[-1]:
                    text = cut(text, spans)
                    spans, _ = automaton.scan(words_of(text))
                new.append(text)
            yield _with(batch, {at: new}).filter(pa.array(keep, pa.bool_()))

    return run


def _marker(sent, at: int, size: int):
    """Adds the spans of one block of items to those of the blocks before."""

    def run(batches):
        automaton = sent.value
        for batch in batches:
            new = []
            for text, before in zip(batch.column(at).to_pylist(), batch.column(size).to_pylist(), strict=True):
                spans = automaton.scan(words_of(text))[0] + [(x["a"], x["b"]) for x in before]
                new.append([{"a": a, "b": b} for a, b in joined(spans)])
            yield _with(batch, {size: new})

    return run


def _cutter(max_coverage: float | None, at: int, size: int, schema):
    """Judges documents by the spans of all blocks (None: they have been judged) and cuts those that stay."""

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            keep, new, again = [], [], []
            for text, held in zip(batch.column(at).to_pylist(), batch.column(size).to_pylist(), strict=True):
                spans = [(x["a"], x["b"]) for x in held]
                keep.append(max_coverage is None or not _covered(spans, len(words_of(text)), max_coverage))
                again.append(bool(spans))
                new.append(cut(text, spans) if spans and keep[-1] else text)
            columns = [c.cast(f.type) for c, f in zip(_with(batch, {at: new}).columns, arrow, strict=False)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(again, pa.bool_())], schema=arrow).filter(pa.array(keep, pa.bool_()))

    return run


def _covered(spans: list[tuple[int, int]], n_words: int, max_coverage: float) -> bool:
    return bool(spans) and sum(b - a for a, b in spans) >= max_coverage * n_words


def _with(batch: pa.RecordBatch, new: dict[int, list]) -> pa.RecordBatch:
    columns = [pa.array(new[k], c.type) if k in new else c for k, c in enumerate(batch.columns)]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: counts, item digest and verdict for each document."""
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + (x["b"] - x["a"]).cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


SQL = """
WITH cut AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS p FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
place AS (SELECT r, n, p, array_to_string(w[p : p + n - 1], ' ') AS s
    FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM cut, sizes WHERE len(w) >= n)),
hit AS (SELECT r, p, place.n, item_id FROM place JOIN win USING (n, s)),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(p, p + n - 1)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM cut LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""
