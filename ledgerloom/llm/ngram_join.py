"""N-gram Jaccard self-join (6): MinHash bands find candidates, full n-gram sets decide.

A document's set holds its runs of `width` words (a shorter one that has words is one run). Documents with the same set
are one class of copies. choose_bands() picks the number of bands and rows for the target recall at the threshold.

1. One pass computes each document's set key and band hashes; copies collapse to a class.
2. Rows are shuffled on band hashes. Each class takes the least class that it shares one with as its hub, and classes
   of one hub are a block, so near copies of one text, which share most bands, mostly stand in one block. A hub with
   more classes or bytes than a block may hold is dealt by a hash to as many blocks as that needs.
3. A class meets the others of its block, and those of each block in which a class shares a band hash with it. Each
   pair of blocks that meet is one group of bounded size, however large a bucket is, where all pairs are verified on full
   n-gram sets. A pair of classes has one pair of blocks, so no link is counted twice. Only a row a class leaves: how
   many documents it is linked with there, and the least class it is connected with.
4. Classes are connected over those rows.

So no pairs are emitted and nothing is capped: blocks meet only where a band hash is shared. Within a bucket whose texts
all differ, the comparisons stay quadratic, since every link counts; they are spread over the pairs of its blocks.

n_links counts the other documents with a similarity of `threshold` or more, copies included; class_id is the least
doc_id that links connect a document with. Documents without words (null and empty texts among them) have no links and
are their own class. Rows that repeat doc_id and text count as documents; of them all only one is `first`. A null
doc_id comes last in the order of ids.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm.components import components
from ledgerloom.llm.shared import WordHashes, every, free_names, keyed, map_batches, map_groups, scratch, shingles, spread_join, texts, words_of

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Hash functions at most.
MAX_HASHES = 256
#: A block: documents and bytes of text at most (a single longer document is a block).
BLOCK_DOCS = 1024
BLOCK_BYTES = 6_000_000


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest false candidates, with which a pair at the threshold shares a band
    with the probability `recall` and bands x rows are at most max_hashes."""
    best = None
    for rows in range(1, 65):
        p = threshold**rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no bands within max_hashes reach this recall")
    return best


class Signer:
    def __init__(self, width: int, bands: int, rows: int) -> None:
        rng = np.random.default_rng(20240229)
        self.width, self.bands, self.rows = width, bands, rows
        self.xor = rng.integers(0, 2**63, bands * rows, np.uint64)[:, None]
        self.mul = (rng.integers(0, 2**63, bands * rows, np.uint64) | np.uint64(1))[:, None]
        self.salt = rng.integers(0, 2**63, bands, np.uint64)
        self.hashes = WordHashes()

    def set_of(self, text: bytes | str | None) -> np.ndarray:
        return np.unique(shingles(self.hashes.of(words_of(text)), self.width))

    def bands_of(self, items: np.ndarray) -> np.ndarray:
        low = None
        for i in range(0, len(items), 2048):
            part = ((items[i : i + 2048][None, :] ^ self.xor) * self.mul).min(axis=1)
            low = part if low is None else np.minimum(low, part)
        low = low.reshape(self.bands, self.rows)
        out = self.salt.copy()
        for r in range(self.rows):
            out = (out ^ low[:, r]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out.view(np.int64)


SIGNED = "doc_id long, th long, key binary, h long, size long, bands array<long>"


def sign(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """doc_id, th, key (of the n-gram set; null without words), h (its first 8 bytes), size (bytes), bands."""

    def make():
        signer = Signer(width, bands, rows)

        def one(batch: pa.RecordBatch) -> dict:
            out: dict = {"doc_id": batch.column(0), "th": batch.column(1), "key": [], "h": [], "size": [], "bands": []}
            for text in texts(batch):
                items = signer.set_of(text)
                if len(items):
                    key = xxhash.xxh3_128_digest(items.tobytes())
                    out["key"].append(key)
                    out["h"].append(int.from_bytes(key[:8], "little", signed=True))
                    out["bands"].append(signer.bands_of(items))
                else:
                    for name in ("key", "h", "bands"):
                        out[name].append(None)
                out["size"].append(len(text or b""))
            return out

        return one

    return map_batches(keyed(docs), make, SIGNED)


def similar_pairs(sets: list[np.ndarray], threshold: float, chunk: int = 4096) -> np.ndarray:
    """Boolean matrix: which sets have that Jaccard similarity or more with which others."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count >= 2  # an item that one set alone has is in no intersection
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    both = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(shared.sum()), chunk):
        a, b = np.searchsorted(column, [low, low + chunk])
        part = np.zeros((n, min(chunk, int(shared.sum()) - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += part @ part.T
    out = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-6
    np.fill_diagonal(out, False)
    return out


def verified(rows: DataFrame, width: int, threshold: float) -> DataFrame:
    """From i, j, block, key, n, text: for each pair of blocks and class with links there key, root, links."""

    def one(group: tuple, columns: dict[str, list]) -> dict[str, list]:
        i, j = group
        at = {k: p for p, k in enumerate(columns["key"])}  # rows that repeat a document give its class twice
        places = list(at.values())
        out: dict[str, list] = {"key": [], "root": [], "links": []}
        if len(places) < 2:
            return out
        signer = Signer(width, 1, 1)
        keys = [columns["key"][p] for p in places]
        linked = similar_pairs([signer.set_of(columns["text"][p]) for p in places], threshold)
        if i != j:
            side = np.array([columns["block"][p] == i for p in places])
            linked &= side[:, None] != side[None, :]
        weights = np.array([columns["n"][p] for p in places], np.int64)
        labels = np.array(sorted(range(len(keys)), key=keys.__getitem__)).argsort()  # by the order of keys
        while True:
            low = np.minimum(labels, np.where(linked, labels[None, :], len(keys)).min(axis=1))
            if (low == labels).all():
                break
            labels = low
        by_rank = sorted(keys)
        for p in np.flatnonzero(linked.any(axis=1)):
            out["key"].append(keys[p])
            out["root"].append(by_rank[labels[p]])
            out["links"].append(int(weights[linked[p]].sum()))
        return out

    return map_groups(rows, ["i", "j"], one, "key binary, root binary, links long")


def _meetings(classes: DataFrame, block_docs: int, block_bytes: int) -> DataFrame:
    """h, block, others: for each class that shares a band hash with another, its block and the blocks that it meets,
    its own among them if another class is in it."""
    rows = classes.select("h", "size", F.explode("bands").alias("bucket"))
    hubs = rows.groupBy("bucket").agg(F.min("h").alias("hub"), F.max("h").alias("top"), F.count("*").alias("n"))
    hubs = scratch(hubs.where("hub < top").select("bucket", "hub", "n"), "hubs")
    # a class has as many buckets as there are bands, at most
    shared = scratch(spread_join(rows, hubs, ["bucket"], ["h"]).groupBy("h").agg(F.min("hub").alias("near"), F.first("size").alias("size"), F.collect_list("bucket").alias("buckets")), "shared")
    parts = F.greatest(F.ceil(F.count("*") / block_docs), F.ceil(F.sum("size") / block_bytes)).cast("int")
    sizes = scratch(shared.groupBy("near").agg(F.count("*").alias("n"), parts.alias("parts"), (F.count("*") > 1).alias("more")), "sizes")
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("h", "near"), "parts")).otherwise(F.lit(0))
    placed = scratch(spread_join(shared, sizes, ["near"], ["h"]).select("h", "buckets", F.xxhash64("near", part).alias("block"), "more"), "placed")
    held = placed.select("h", "block", F.explode("buckets").alias("bucket"))
    met = held.groupBy("bucket").agg(F.collect_set("block").alias("blocks")).where(F.size("blocks") > 1)
    far = held.join(met, "bucket").groupBy("h").agg(F.array_distinct(F.flatten(F.collect_list("blocks"))).alias("blocks"))
    none = F.array().cast("array<bigint>")
    own = F.when(F.col("more"), F.array("block")).otherwise(none)
    others = F.concat(own, F.array_remove(F.coalesce("blocks", none), F.col("block")))
    return scratch(placed.join(far, "h", "left").select("h", "block", others.alias("others")), "meetings")


def jaccard_join(
    docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, recall: float = RECALL,
    block_docs: int = BLOCK_DOCS, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, th, class_id, n_links, first: for each row of docs; th is the hash of its text."""
    signed = scratch(sign(docs, width, *choose_bands(threshold, recall)), "signed")
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "th")
    classes = scratch(
        signed.where("key is not null").groupBy("key").agg(F.first("h").alias("h"), F.count("*").alias("n"), F.max("size").alias("size"), F.min(order).alias("rep"), F.first("bands").alias("bands")),
        "classes",
    )
    m = classes.join(_meetings(classes, block_docs, block_bytes), "h").select("key", "n", "rep", "block", "others")
    # members grow with the data, so this side is never broadcast
    m = scratch(m, "members").hint("merge").alias("m")
    with_text = keyed(docs).alias("d").join(m, F.col("d.doc_id").eqNullSafe(F.col("m.rep.doc_id")) & (F.col("d.th") == F.col("m.rep.th")))
    pairs = with_text.select("block", "key", "n", "text", F.explode("others").alias("other")).select(
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "n", "text"
    )
    found = scratch(verified(pairs, width, threshold), "found")
    linked = scratch(found.groupBy("key").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.max("root").alias("top")), "linked")
    if linked.where("root < top").head(1):  # a class that met several blocks may have several roots
        ends = found.join(linked.select("key", F.col("root").alias("low")), "key").where("root != low").select("root", "low").distinct()
        roots = components(ends, "root", "low").select(F.col("node").alias("root"), "comp")
        linked = linked.join(roots, "root", "left").select("key", "links", F.coalesce("comp", "root").alias("root"))
    linked = classes.join(linked.select("key", "links", "root"), "key").select("key", "root", "links", "rep")
    heads = linked.groupBy("root").agg(F.min("rep").alias("head"))
    verdicts = classes.select("key", "n", "rep").join(linked.join(heads, "root").select("key", "links", "head"), "key", "left").select(
        "key", F.coalesce("head", "rep").alias("head"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "n"
    )
    own = signed.select("doc_id", "th", "key")
    # copies of one text, and texts without words, may be a third of all rows
    out = spread_join(own, verdicts, ["key"], ["doc_id", "th"], counts=classes.select("key", "n"), how="left")
    same = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("th") == F.col("head.th"))
    return out.select(
        "doc_id", "th",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.lit(True)).otherwise(same).alias("first"),
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """docs with their columns, one document of each class: that with the least doc_id. Documents without words stay."""
    own, th, i, t, words, turn = free_names(docs.columns, "own_id", "own_th", "first_id", "first_th", "has_words", "turn")
    found = jaccard_join(docs, **options).where("first").select(F.col("doc_id").alias(i), F.col("th").alias(t)).distinct()
    letters = F.coalesce(F.col("text"), F.lit("")).rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]")
    held = docs.select(*every(docs.columns), F.col("doc_id").cast("long").alias(own), F.xxhash64("text").alias(th), letters.alias(words))
    # the join and the window deal rows out alike: repeated rows lose their second
    rows = held.join(found, F.col(own).eqNullSafe(F.col(i)) & (F.col(th) == F.col(t)), "left_semi")
    rows = rows.withColumn(turn, F.row_number().over(Window.partitionBy(own, th).orderBy(F.lit(1))))
    return rows.where((F.col(turn) == 1) | ~F.col(words)).select(*every(docs.columns))


def classes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: class_id and number of links for each document."""
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "n_links")


SQL = """
WITH RECURSIVE cut AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
gram AS (SELECT DISTINCT r, hash(array_to_string(w[p : p + least(5, len(w)) - 1], ' ')) AS g
    FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS p FROM cut WHERE len(w) > 0)),
size AS (SELECT r, count(*) AS n FROM gram GROUP BY r),
pair AS (SELECT x.r AS a, y.r AS b, count(*) AS m FROM gram x JOIN gram y ON x.g = y.g AND x.r <> y.r GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN size s ON s.r = a JOIN size t ON t.r = b WHERE 5 * m >= 4 * (s.n + t.n - m)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least_id AS (SELECT a, min(doc_id) AS id FROM reach JOIN cut ON cut.r = reach.b GROUP BY a),
many AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(id, doc_id)) AS class_id, coalesce(n, 0) AS n_links
FROM cut LEFT JOIN least_id ON least_id.a = cut.r LEFT JOIN many ON many.a = cut.r
"""
