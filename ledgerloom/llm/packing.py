"""Best-fit packing (10) of tokenized documents into sequences, bettered by swaps between underfull bins.

A document's ids are those of a public tokenizer and one end id; a longer document than `capacity` is cut into pieces
of `capacity` ids, the last may be shorter. Null text counts as empty: its one piece holds the end id alone.

Tokenizing is one pass without a shuffle; what it finds of each piece (no ids, unless asked for) goes to the scratch
folder. Pieces are then dealt by a hash of a row number to shards of bounded tokens and pieces, whose number follows
the data, and each shard is packed in one task: best fit, longest first, then local search. What local search can't
empty are a few bins a shard that are far from full: while there are several shards, the pieces of bins filled to `LOOSE`
or less are taken out of all of them and packed together, in fewer shards each time. Repeated rows are documents of
their own; ties in length are broken by order of arrival in the shard.

Local search: the emptiest bin gives to fuller ones, by moving a piece, exchanging one for one, two for one or one for
two, always the exchange that raises the sum of squared fills most, until it is empty or none raises it; then comes
the next emptiest. It ends at a number of bins that no packing of these lengths is under, or when each underfull bin has been tried
since the last exchange. A bin tried in vain is tried again only with bins that have changed since.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.shared import every, free_names, map_batches, map_groups, scratch

CAPACITY = 4096
END_ID = 1
#: A shard: bins and pieces at most, about.
SHARD_BINS = 1024
SHARD_PIECES = 40_000
#: Bins of a shard that are no fuller than this share are packed again with those of other shards.
LOOSE = 0.75
#: Bytes of a tokenizer file that is broadcast, at most.
FILE_BYTES = 64 << 20

_CACHED = 300_000
_LOADED: dict[int, "Encoder"] = {}


class Encoder(dict):
    """Ids (little-endian unsigned 32 bits) of whole texts, by remembered ids of what stands between white space.

    The tokenizer's pattern lets no token span white space, so ids of the parts, in order, are the ids of the text.
    Parts are cut further by the tokenizer's own normalizer and pattern; a part in ASCII and Latin-1 letters is cut by
    the same pattern here. A text with U+001C to U+001F, which Python alone calls white space, is encoded whole."""

    def __init__(self, source: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(source)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}

    def __call__(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, text.split()))

    def __missing__(self, part: str) -> bytes:
        if len(self) >= _CACHED:
            self.clear()
        if _PLAIN.fullmatch(part):
            ids = b"".join(self.words.get(w) or self._word(w) for w in _PIECES.findall(part.lower()))
        else:
            ids = array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
        self[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if len(self.words) >= _CACHED:
            self.words.clear()
        mapped = word if word.isascii() else "".join(map(_BYTE_LETTERS.__getitem__, word.encode()))
        ids = self.words[word] = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
        return ids


_ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Parts that NFC leaves alone, whose case folds letter by letter, and that hold no special token.
_PLAIN = re.compile("[!-;=-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_SHOWN = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
#: Byte-level letters: printable bytes stand for themselves, the others follow from U+0100 on.
_BYTE_LETTERS = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}


def encoder(source: str) -> Encoder:
    """One a worker: tasks of the same worker share what it remembers."""
    key = hash(source)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(source)
    return _LOADED[key]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row for each piece; with_ids: its ids too, as bytes."""
    with open(tokenizer, encoding="utf-8") as f:  # a file of the driver: executors need none
        source = f.read(FILE_BYTES + 1)
    if len(source) > FILE_BYTES:
        raise ValueError(f"{tokenizer} is larger than {FILE_BYTES} bytes")
    sent = docs.sparkSession.sparkContext.broadcast(source)
    end = array("I", [end_id]).tobytes()
    step = 4 * capacity

    def make():
        encode = encoder(sent.value)

        def one(batch: pa.RecordBatch) -> dict:
            out: dict = {n.split()[0]: [] for n in (PIECES + ", ids binary").split(", ")}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                for k in range(0, len(ids), step):
                    part = ids[k : k + step]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(k // step)
                    out["start"].append(k // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(part)
            return out

        return one

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, make, PIECES + ", ids binary" * with_ids)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices: longest first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r: a bin has room r
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        fit = rooms >> n
        if fit:
            room = (fit & -fit).bit_length() - 1 + n
            k = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        if room > n:
            by_room[room - n].append(k)
            rooms |= 1 << (room - n)
    return bins


def least_bins(lengths: list[int], capacity: int) -> int:
    """A number of bins that no packing is under: for each k, pieces over capacity - k share a bin with none of k or more,
    those over half the capacity share one with none of each other, and what of those from k to half doesn't fit beside
    the latter needs bins of its own."""
    count = [0] * (capacity + 2)
    for n in lengths:
        count[n] += 1
    best, half = 0, capacity // 2
    bins = sum(count[half + 1 :])  # pieces over half the capacity
    room = sum((capacity - n) * count[n] for n in range(half + 1, capacity + 1))  # beside the latter
    small = sum(n * count[n] for n in range(half + 1))  # tokens of pieces from k to half
    for k in range(half + 1):
        room -= (k - 1) * count[capacity - k + 1]
        best = max(best, bins + max(0, -(-(small - room) // capacity)))
        small -= k * count[k]
    return best


class _Bin:
    """Pieces of a bin by length. `one` has a bit for each length, `two` for each sum of the lengths of two pieces."""

    def __init__(self, pieces: list[int], lengths: list[int]) -> None:
        self.by: dict[int, list[int]] = defaultdict(list)
        for i in pieces:
            self.by[lengths[i]].append(i)
        self.settle()

    def settle(self) -> None:
        self.lengths = sorted(n for n, held in self.by.items() if held)
        self.fill = sum(n * len(self.by[n]) for n in self.lengths)
        self.one = sum(1 << n for n in self.lengths)
        self.two = 0
        for n in self.lengths:
            others = self.one if len(self.by[n]) > 1 else self.one & ~(1 << n)
            self.two |= others << n

    def pair(self, total: int) -> tuple[int, int]:
        """Lengths of two pieces of this sum."""
        return next((n, total - n) for n in self.lengths if self.by.get(total - n) and (n != total - n or len(self.by[n]) > 1))

    def pieces(self) -> list[int]:
        return [i for held in self.by.values() for i in held]


@lru_cache(4)
def _below(capacity: int) -> list[int]:
    """Masks of the bits 0 to n."""
    return [(2 << n) - 1 for n in range(2 * capacity + 1)]


def _exchange(e: _Bin, f: _Bin, room: int, most: int, below: list[int]) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    """The exchange that brings f most, `most` at the most: how much, the lengths that e gives and those that it takes. A
    move, one for one, two for one, or one for two."""
    n = (e.one & below[room]).bit_length() - 1
    best = (n, (n,), ()) if n > 0 else (0, (), ())
    for t in f.lengths:
        if best[0] == most:
            return best
        g = (e.one & below[t + room]).bit_length() - 1
        if g - t > best[0]:
            best = (g - t, (g,), (t,))
        g = (e.two & below[t + room]).bit_length() - 1
        if g - t > best[0]:
            best = (g - t, e.pair(g), (t,))
    for g in e.lengths:
        if best[0] == most:
            return best
        low = max(0, g - room)
        if left := f.two >> low:
            t = low + (left & -left).bit_length() - 1
            if g - t > best[0]:
                best = (g - t, (g,), f.pair(t))
    return best


def empty_bins(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Local search (see above). Bins that are full stay as they are."""
    least = least_bins(lengths, capacity)
    full = [b for b in bins if sum(lengths[i] for i in b) == capacity]
    held = dict(enumerate(_Bin(b, lengths) for b in bins if sum(lengths[i] for i in b) < capacity))
    clock = 1
    changed, tried = dict.fromkeys(held, 1), dict.fromkeys(held, 0)
    while len(full) + len(held) > least and (left := [k for k in held if tried[k] < clock]):
        e = min(left, key=lambda k: held[k].fill)
        clock = _drain(e, held, changed, tried[e], clock, capacity)
        tried[e] = clock
        if not held[e].lengths:
            del held[e]
    return full + [b.pieces() for b in held.values()]


def _drain(e: int, bins: dict[int, _Bin], changed: dict[int, int], since: int, clock: int, capacity: int) -> int:
    """Exchanges until bin e is empty or none gains; the clock after them. since: when e was last tried in vain."""
    mine, below = bins[e], _below(capacity)
    while mine.lengths:
        gain, best = 0, None
        new = changed[e] > since
        most = {f: 2 * d * (b.fill - mine.fill + d) for f, b in bins.items() if f != e and b.fill >= mine.fill and (new or changed[f] > since) and (d := min(capacity - b.fill, mine.fill)) > 0}
        for f in sorted(most, key=most.__getitem__, reverse=True):
            if most[f] <= gain:
                break
            room = capacity - bins[f].fill
            d, given, taken = _exchange(mine, bins[f], room, min(room, mine.fill), below)
            if 2 * d * (bins[f].fill - mine.fill + d) > gain:
                gain, best = 2 * d * (bins[f].fill - mine.fill + d), (f, given, taken)
        if not best:
            break
        f, given, taken = best
        theirs = bins[f]
        going, coming = [mine.by[n].pop() for n in given], [theirs.by[n].pop() for n in taken]
        for n, i in zip(given, going, strict=True):
            theirs.by[n].append(i)
        for n, i in zip(taken, coming, strict=True):
            mine.by[n].append(i)
        mine.settle()
        theirs.settle()
        clock += 1
        changed[e] = changed[f] = clock
    return clock


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_bins: int = SHARD_BINS, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """pieces (a column length, 1 to capacity, and any others) with sequence_id and offset, under these names (a column
    of pieces that has one of them goes)."""
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    row, shard, loose = free_names(names, "row", "shard", "loose")
    kinds = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    schema = f"{kinds}, sequence_id long, offset long, `{loose}` boolean"
    rows = scratch(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    done, level, before = None, 0, None
    while True:
        whole = rows.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("tokens"), F.count("*").alias("n")).head()
        shards = max(1, -(-whole["tokens"] // (capacity * shard_bins)), -(-whole["n"] // shard_pieces))
        last = shards == 1 or shards == before
        dealt = rows.withColumn(shard, F.pmod(F.xxhash64(row, F.lit(level)), F.lit(shards))).drop(row)
        found = map_groups(dealt, [shard], _packer(names, capacity, level, 0 if last else LOOSE * capacity, loose), schema)
        if last:
            ready = found.drop(loose)
            return ready if done is None else done.unionByName(ready)
        found = scratch(found, "packed")
        ready = found.where(~F.col(loose)).drop(loose)
        done = ready if done is None else done.unionByName(ready)
        rows = scratch(found.where(loose).select(*every(names)).withColumn(row, F.monotonically_increasing_id()), "loose")
        level, before = level + 1, shards


def _packer(names: list[str], capacity: int, level: int, most: float, loose: str):
    """Packs a shard; `loose` tells the pieces of bins filled to `most` or less. Ids of sequences hold the level, the
    shard and the bin."""

    def one(group: tuple, columns: dict[str, list]) -> dict[str, list]:
        lengths = columns["length"]
        out: dict[str, list] = {n: [] for n in [*names, "sequence_id", "offset", loose]}
        for k, held in enumerate(empty_bins(best_fit(lengths, capacity), lengths, capacity)):
            at = 0
            for i in held:
                for n in names:
                    out[n].append(columns[n][i])
                out["sequence_id"].append((level << 56) + (group[0] << 24) + k)
                out["offset"].append(at)
                at += lengths[i]
            out[loose] += [at <= most] * len(held)
        return out

    return one


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack(tokenize(docs, tokenizer, capacity, with_ids=with_ids), capacity)


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the pieces of all documents and their places."""
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
