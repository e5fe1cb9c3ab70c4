"""Line dedup (1): passages of lines that an earlier document has too go from the later one.

Order: documents are ordered by doc_id (null last), then by the hash of their text. Lines are compared without outer
white space, and blank lines don't count.

A passage is a run of lines next to each other, blank lines between aside, of `block_words` words or more. White space
parts words; in scripts that are written without it, two characters count as a word (Han, kana) or four (Thai, Lao,
Tibetan, Burmese, Khmer and others). Every passage that two documents share, wherever it stands in either, is deleted
from the later, with the blank lines inside:

1. Rare hashes pair documents. One line alone may stand in any number of documents, so the hashed units are windows: the
   shortest passages of a document, from each line on, and back from each line. What a window holds depends on nothing
   around it, so two documents that share a passage share the windows that lie within it, and these cover all its lines.
   Each window has a holder, the first document with it. A document is paired with the holders of its windows: at most
   one for each window, however many documents share it.
2. Each pair is aligned with patience diff: windows that stand once in either text are anchors, the longest chain of them
   in the order of both is kept, and the gaps between anchors are aligned in turn with the windows that repeat.
3. Aligned windows that follow each other make blocks, which are deleted from the later document. Shared windows that a
   chain leaves, as passages that were moved, make blocks of their own, marked so: no shared passage stays.

Holders never lose their windows to later documents. Null and empty texts stay as they are. Rows that repeat doc_id and
text are one document and fare alike.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.shared import every, free_names, keyed, map_batches, map_rows, scratch, spread_join, texts

#: Words of a passage that is deleted, at least.
BLOCK_WORDS = 10

#: What bytes.strip() takes off.
_SPACE = " \t\n\r\x0b\x0c"

WINDOWS = "doc_id long, th long, a int, b int, h long, c int, once boolean"


#: Letters and marks of scripts without spaces, of which two count as a word, and of which four do.
_TWO = re.compile("[\u3005-\u3007\u3040-\u30ff\u3100-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff]")
_FOUR = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u1b00-\u1b7f\ua980-\ua9ff\uaa60-\uaadf]")


def words_in(line: bytes) -> int:
    """Words of a line that isn't blank, one at least."""
    if line.isascii():
        return len(line.split())
    text = line.decode(errors="replace")
    rest, two = _TWO.subn(" ", text)
    rest, four = _FOUR.subn(" ", rest)
    if not two and not four:
        return len(text.split()) or 1
    return sum(any(map(str.isalnum, w)) for w in rest.split()) + -(-two // 2) + -(-four // 4)


def windows(sizes: list[int], least: int) -> list[tuple[int, int]]:
    """Shortest runs (end exclusive) of `least` or more from each place on, and back from each."""
    out = set()
    held = b = 0
    for a, n in enumerate(sizes):
        while held < least and b < len(sizes):
            held += sizes[b]
            b += 1
        if held < least:
            break
        out.add((a, b))
        held -= n
    held = a = 0
    for b, n in enumerate(sizes, 1):
        held += n
        while held - sizes[a] >= least:
            held -= sizes[a]
            a += 1
        if held >= least:
            out.add((a, b))
    return sorted(out)


def windows_of(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each window: its place among the lines that aren't blank, 96 bits of its hash, and whether the text
    has it once."""

    def make():
        def one(batch: pa.RecordBatch) -> dict:
            out: dict = {n.split()[0]: [] for n in WINDOWS.split(", ")}
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, th, text in zip(ids, hashes, texts(batch), strict=True):
                lines = [x for line in text.split(b"\n") if (x := line.strip())] if text else []
                marks = [xxhash.xxh3_128_digest(x) for x in lines]
                found = windows([words_in(x) for x in lines], block_words)
                own = [xxhash.xxh3_128_intdigest(b"".join(marks[a:b])) for a, b in found]
                times = Counter(own)
                for (a, b), mark in zip(found, own, strict=True):
                    out["doc_id"].append(doc_id)
                    out["th"].append(th)
                    out["a"].append(a)
                    out["b"].append(b)
                    out["h"].append((mark & (2**64 - 1)) - 2**63)
                    out["c"].append((mark >> 64 & (2**32 - 1)) - 2**31)
                    out["once"].append(times[mark] == 1)
            return out

        return one

    return map_batches(keyed(docs), make, WINDOWS)


Point = tuple[int, int, int, bool]  # a window's first line and end, its first line in the holder, once in either


def chain(points: list[Point]) -> list[Point]:
    """The longest run of points, sorted by place, that goes forward in both texts."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, _, q, _) in enumerate(points):
        n = bisect_left(tops, q)
        back.append(at[n - 1] if n else -1)
        tops[n : n + 1], at[n : n + 1] = [q], [k]
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(points[k])
        k = back[k]
    return out[::-1]


def patience(points: list[Point]) -> set[Point]:
    """The points of one pair that align. They are sorted; of windows that begin at one line both count."""
    out: set[Point] = set()
    todo = [points]
    while todo:
        own = todo.pop()
        anchors = chain([p for p in own if p[3]]) or chain(own)
        out.update(anchors)
        starts, gaps = [p[0] for p in anchors], [[] for _ in range(len(anchors) + 1)]
        for p in own:
            k = bisect_left(starts, p[0])  # anchors before the point
            if k < len(anchors) and anchors[k][0] == p[0]:
                if anchors[k][2] == p[2]:
                    out.add(p)
            elif (not k or anchors[k - 1][2] < p[2]) and (k == len(anchors) or p[2] < anchors[k][2]):
                gaps[k].append(p)
        if any(p[3] for p in anchors):  # else what the gaps hold would have made the chain longer
            todo += [gap for gap in gaps if gap]
    return out


def blocks_of(points: list[Point]) -> list[tuple[int, int, int, bool]]:
    """Blocks of lines (first, end), where each begins in the holder, and whether it was moved."""
    kept = patience(points)
    out: list[tuple[int, int, int, bool]] = []
    for moved, own in ((False, kept), (True, set(points) - kept)):
        for a, b, q, _ in sorted(own, key=lambda p: (p[2] - p[0], p[0], p[1])):
            if out and out[-1][3] == moved and out[-1][2] - out[-1][0] == q - a and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2], moved)
            else:
                out.append((a, b, q, moved))
    return sorted(out)


def removals(text: str, found: list[dict]) -> list[dict]:
    """Blocks of the text's lines, blank ones counted (a, and end b), the holder of each, and whether it was moved."""
    places = [p for p, x in enumerate(text.split("\n")) if x.strip(_SPACE)]
    pairs: dict[tuple, list[Point]] = defaultdict(list)
    for x in found:
        pairs[x["id"], x["th"]].append((x["a"], x["b"], x["q"], x["once"]))
    blocks = []
    for (holder, _), points in pairs.items():
        for a, b, _, moved in blocks_of(sorted(points)):
            blocks.append({"a": places[a], "b": places[b - 1] + 1, "holder": holder, "moved": moved})
    return sorted(blocks, key=lambda x: (x["a"], -x["b"], x["holder"] is None, x["holder"] or 0))


def merged(blocks: list[dict]) -> list[tuple[int, int]]:
    """Lines that blocks cover, as runs (end exclusive). Blocks of two holders may overlap."""
    out: list[tuple[int, int]] = []
    for x in blocks:
        if out and x["a"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(x["b"], out[-1][1]))
        else:
            out.append((x["a"], x["b"]))
    return out


def shared_windows(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, th and found, for the documents with a window that an earlier one holds: for each such window its lines,
    the holder, and its first line there."""
    own = windows_of(docs, block_words)
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")
    key = ["h", "c"]
    firsts = own.groupBy(*key).agg(F.min(F.struct(order.alias("o"), "a", "once")).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))
    holders = scratch(firsts.where("first.o <> last").select(*key, "first", "n"), "holders")
    # a window that a third of all documents have is dealt over many tasks
    later = spread_join(own, holders, key, ["doc_id", "th", "a"]).where(order != F.col("first.o"))
    point = F.struct(F.col("first.o.doc_id").alias("id"), F.col("first.o.th").alias("th"), "a", "b", F.col("first.a").alias("q"), (F.col("once") & F.col("first.once")).alias("once"))
    # at most two for each of the document's lines
    return later.groupBy("doc_id", "th").agg(F.collect_set(point).alias("found"))


BLOCKS = "array<struct<a:int,b:int,holder:bigint,moved:boolean>>"


def dedup(docs: DataFrame, block_words: int = BLOCK_WORDS, drop_emptied: bool = False, more: tuple[str, str] | None = ("blocks", "n_lines")) -> DataFrame:
    """docs with their columns, and two more (None: none) under names that docs doesn't have: blocks that were deleted
    (line numbers a, end b, the holder's id, whether moved), and the lines that the text had. Blocks of two holders may
    overlap. drop_emptied: documents of which nothing but white space is left go, if it was lines that were deleted."""
    names = docs.columns
    i, t, j, u, found = free_names(names, "own_id", "own_th", "later_id", "later_th", "found")
    held = docs.select(*every(names), F.col("doc_id").cast("long").alias(i), F.xxhash64("text").alias(t))
    paired = shared_windows(docs, block_words).select(F.col("doc_id").alias(j), F.col("th").alias(u), F.col("found").alias(found))
    rows = held.join(paired, F.col(i).eqNullSafe(F.col(j)) & (F.col(t) == F.col(u)), "left").select(*every(names), found)
    blocks, n = free_names(names, *(more or ("blocks", "n_lines")))
    schema = docs.select(*every(names), F.lit(None).cast(BLOCKS).alias(blocks), F.lit(None).cast("int").alias(n)).schema
    at, size = names.index("text"), len(names)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            new, removed, counts, keep = [], [], [], []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(size).to_pylist(), strict=True):
                blocks = removals(text, found) if found else []
                counts.append(0 if text is None else text.count("\n") + 1)
                if blocks:
                    gone = {p for a, b in merged(blocks) for p in range(a, b)}
                    text = "\n".join(x for p, x in enumerate(text.split("\n")) if p not in gone)
                removed.append(blocks)
                new.append(text)
                keep.append(not (drop_emptied and blocks and not text.strip(_SPACE)))
            columns = list(batch.columns)[:size]
            columns[at] = pa.array(new, columns[at].type)
            out = [c.cast(f.type) for c, f in zip(columns, arrow, strict=False)]
            out += [pa.array(removed, arrow.field(size).type), pa.array(counts, arrow.field(size + 1).type)]
            yield pa.RecordBatch.from_arrays(out, schema=arrow).filter(pa.array(keep, pa.bool_()))

    out = map_rows(rows, run, schema)
    return out if more else out.select(*every(names))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: for each document the text without the passages of earlier ones, the deleted lines as runs, the counts of
    lines, and each aligned block with its holder (first line-end:holder, `~` before those that were moved)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    listed = F.array_join(F.transform("blocks", lambda x: F.concat(F.when(x["moved"], "~").otherwise(""), x["a"], F.lit("-"), x["b"], F.lit(":"), F.coalesce(x["holder"].cast("string"), F.lit("null")))), ",")
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<a:int,b:int>>").alias("out"))

    def step(s, x):  # blocks come in the order of their first lines
        last = F.element_at(s["out"], -1)
        longer = F.concat(F.slice(s["out"], 1, F.size(s["out"]) - 1), F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))))
        fresh = F.concat(s["out"], F.array(F.struct(x["a"].alias("a"), x["b"].alias("b"))))
        return F.struct(F.greatest(s["end"], x["b"]).alias("end"), F.when((F.size(s["out"]) > 0) & (x["a"] <= s["end"]), longer).otherwise(fresh).alias("out"))

    rows = dedup(docs).withColumn("runs", F.aggregate("blocks", start, step)["out"])
    n = F.aggregate("runs", F.lit(0), lambda s, x: s + x["b"] - x["a"])
    return rows.select("doc_id", "text", F.col("n_lines").cast("long").alias("n_lines"), n.cast("long").alias("n_removed"), F.array_join(F.transform("runs", lambda x: F.concat_ws("-", x["a"], x["b"])), ",").alias("removed"), listed.alias("blocks"))
