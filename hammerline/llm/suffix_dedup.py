"""Removal of long repeated passages by sorted suffixes.

A byte goes if it lies in a string of ``least`` bytes (a window) that also starts anywhere else in
the corpus. Not every suffix is sorted: each window has an anchor, the place in it where a hash of
``lead`` bytes is smallest, and equal windows have their anchors at the same offset. So it is
enough to sort the suffixes that start at anchors, one in about ``(least - lead) / 2`` bytes, each
with the text around it that its windows cover (its slice).

1. Texts are scanned for anchors. An anchor row has hashes of its leading bytes and of its slice.
2. Anchors whose leading bytes occur once are dropped with a bounded filter before any shuffle.
   Of the rest, equal slices are counted: windows of a slice that occurs twice are repeated.
3. Different slices with equal leading bytes are fetched and range-partitioned by their suffixes,
   with Spark's sampled splitters. Each bucket sorts its suffixes, and the texts before the
   anchors, by multikey quicksort over eight-byte characters. Two windows that end ``r`` bytes
   after the anchor are equal just if their suffixes fall into one run of common length ``r`` and
   their fore-texts into one run of the rest; this is read from the two orders.
4. Borders lie between different leading bytes, except where more than HOT slices share theirs:
   these may be cut anywhere. Equal windows on different sides of such a border begin (from the
   anchor on) like the last suffix before it and the first behind it. Only such windows are
   compared across buckets, by a strong hash.

Copies of whole texts share their rows: texts go by digest throughout. A hot passage collapses to
one slice, and more than HOT near copies of it are spread over buckets by what follows.

Defined cases: NULL text is the empty text; texts shorter than ``least`` lose nothing; rows with
equal texts of at least that length lose all of it; matches may overlap themselves and never cross
texts; NULL and repeated ids are rows of their own; an empty table gives an empty result; columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.llm.exact_dedup import filter_bits, probe, repeated_pages
from hammerline.llm.texts import filled, small_batches
from hammerline.session import write_table

LEAST = 400
LEAD = 128
# Bytes scanned at a time, and slice bytes that a bucket should hold.
LOT = 1 << 19
BUCKET_BYTES = 4 << 20
# So many different slices with the same leading bytes may share a bucket; more are spread.
HOT = 20_000
POSITION_BITS = 24
HANDED_ON = 500
SPANS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
SEED = 5


def digest(text: Column) -> Column:
    """Sixteen bytes of the text's SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


class Scanner:
    """Finds the anchors of texts given as bytes."""

    def __init__(self, least: int = LEAST, lead: int = LEAD, lot: int = LOT):
        if not 0 < lead <= least:
            raise ValueError("lead must be between 1 and least")
        self.least, self.lead, self.lot = least, lead, lot
        rng = np.random.default_rng(SEED)
        self.letters = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        base = int(rng.integers(1 << 62, dtype=np.uint64)) * 2 + 1
        room = 2 * lot + 2 * least
        self.powers, self.inverses = self._powers(base, room), self._powers(pow(base, -1, 1 << 64), room)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def segments(self, texts: list[memoryview]) -> Iterator[list[tuple[int, int, memoryview]]]:
        """Lots of (text number, offset, part): long texts in parts that share no window."""
        lot, size = [], 0
        for i, text in enumerate(texts):
            for start in range(0, len(text) - self.least + 1, self.lot):
                part = text[start : start + self.lot + self.least - 1]
                lot.append((i, start, part))
                size += len(part)
                if size >= self.lot:
                    yield lot
                    lot, size = [], 0
        if lot:
            yield lot

    def grams(self, data: np.ndarray) -> np.ndarray:
        """A hash of the ``lead`` bytes from each position on."""
        n = len(data)
        sums = np.empty(n + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(self.letters[data] * self.powers[:n], out=sums[1:])
        h = (sums[self.lead :] - sums[: -self.lead]) * self.inverses[: n - self.lead + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        return h

    def anchors(self, data: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """The anchor of every window of the data: its least hash, the leftmost of equals."""
        windows, width = len(data) - self.least + 1, self.least - self.lead + 1
        low = np.uint64((1 << POSITION_BITS) - 1)
        ranked = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        ranked = np.concatenate([ranked, np.full(-len(ranked) % width, ~np.uint64(0))]).reshape(-1, width)
        ahead = np.minimum.accumulate(ranked, axis=1).ravel()
        behind = np.minimum.accumulate(ranked[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
        return (least & low).astype(np.int64)

    def scan(self, texts: list[memoryview]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, lo, hi, off, gram, slice) for each anchor: its windows start at lo..hi, the
        anchor is ``off`` bytes behind lo, and the last are hashes of lead bytes and slice."""
        for lot in self.segments(texts):
            whole = b"".join(part for _, _, part in lot)
            data = np.frombuffer(whole, dtype=np.uint8)
            grams = self.grams(data)
            at = self.anchors(data, grams)
            out, at0 = [], 0
            for number, offset, part in lot:
                own = at[at0 : at0 + len(part) - self.least + 1]
                lo = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
                hi = np.concatenate([lo[1:] - 1, [len(own) - 1]])
                place = own[lo]
                off = place - at0 - lo
                hashes = [
                    xxhash.xxh3_128_digest(part[a : b + self.least], seed=o)
                    for a, b, o in zip(lo.tolist(), hi.tolist(), off.tolist())
                ]
                out.append((np.full(len(lo), number), lo + offset, hi + offset, off, grams[place].view(np.int64), hashes))
                at0 += len(part)
            yield tuple(np.concatenate(x) if i < 5 else sum(x, []) for i, x in enumerate(zip(*out)))


def multikey_sort(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): the sorted order, and the length that each string in that order has in
    common with the one before (0 for the first).

    Multikey quicksort with eight bytes as one character, all parts of a level at once: parts
    are split by the character at the current depth, and only parts of several strings go on.
    """
    n = len(strings)
    size = np.array([len(s) for s in strings], dtype=np.int64)
    depth_end = int(size.max(initial=0))
    joined = np.frombuffer(b"".join(strings) + bytes(16), dtype=np.uint8)
    start = np.cumsum(size) - size
    order, common = np.arange(n), np.zeros(n, dtype=np.int64)
    part = np.zeros(n, dtype=np.int64)  # by place in the order: the first place of its part
    live = np.arange(n)  # places in parts of several strings
    depth = 0
    while len(live) > 1 and depth < depth_end + 8:
        which = order[live]
        left = np.clip(size[which] - depth, 0, 8)
        at = np.minimum(start[which] + depth, len(joined) - 8)
        word = joined[at[:, None] + np.arange(8)].copy()
        word[np.arange(8) >= left[:, None]] = 0
        word = word.view(">u8").ravel().astype(np.uint64)
        rank = np.lexsort((left, word, part[live]))
        which, word, left, parts = which[rank], word[rank], left[rank], part[live]
        order[live] = which
        same_part = parts[1:] == parts[:-1]
        differ = np.flatnonzero(same_part & ((word[1:] != word[:-1]) | (left[1:] != left[:-1]))) + 1
        bits = word[differ] ^ word[differ - 1]
        equal = np.full(len(differ), 8)
        for b in range(8):  # bytes in common, counted from the front
            equal = np.where((equal == 8) & ((bits >> np.uint64(56 - 8 * b)) & np.uint64(255) != 0), b, equal)
        common[live[differ]] = depth + np.minimum(equal, np.minimum(left[differ], left[differ - 1]))
        begins = np.ones(len(live), dtype=bool)
        begins[1:] = ~same_part
        begins[differ] = True
        part[live] = live[np.maximum.accumulate(np.where(begins, np.arange(len(live)), 0))]
        ended = left < 8  # equal strings that end here have all in common
        firsts = np.flatnonzero(begins)
        sizes = np.diff(np.concatenate([firsts, [len(live)]]))
        done = np.repeat(sizes == 1, sizes) | ended
        inside = np.flatnonzero(ended & ~begins)
        common[live[inside]] = size[which[inside]]
        live = live[~done]
        depth += 8
    return order, common


def common_length(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int((x != y).argmax())


def compare_bucket(
    slices: list[bytes], offs: np.ndarray, hot: np.ndarray, least: int, lead: int
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(repeated, border): whether each window of each slice occurs twice in the bucket, and the
    windows of hot slices, one of equals each, that may occur in another bucket as (slice, window).

    ``repeated`` has a row per slice and a column per distance from the window's start to the
    anchor.
    """
    n, furthest = len(slices), least - lead
    sizes = np.array([len(s) for s in slices], dtype=np.int64)
    order, common = multikey_sort([s[o:] for s, o in zip(slices, offs)])
    fore_order, fore_common = multikey_sort([s[:o][::-1] for s, o in zip(slices, offs)])
    repeated = np.zeros((n, furthest + 1), dtype=bool)
    keys = [s[o:] + s[:o] for s, o in zip(slices, offs)]
    first, last = min(keys), max(keys)
    reach = np.array([max(common_length(k, first), common_length(k, last)) if h else -1 for k, h in zip(keys, hot)])
    border: list[tuple[int, int]] = []
    for before in range(furthest + 1):
        # Windows that start ``before`` bytes ahead of the anchor.
        valid = (offs >= before) & (offs - before <= sizes - least)
        if not valid.any():
            continue
        run, fore = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        run[order] = np.cumsum(common < least - before)
        fore[fore_order] = np.cumsum(fore_common < before)
        at = np.flatnonzero(valid)
        pair = run[at] * (n + 1) + fore[at]
        ranked = np.argsort(pair, kind="stable")
        new = np.concatenate([[True], pair[ranked][1:] != pair[ranked][:-1]])
        alone = new & np.concatenate([new[1:], [True]])
        repeated[at[ranked[~alone]], before] = True
        edge = at[ranked[new]]
        border += [(int(i), int(offs[i]) - before) for i in edge[reach[edge] >= least - before]]
    return repeated, border


def runs(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Maximal runs (first, last) of sorted integers."""
    if len(starts):
        cuts = np.flatnonzero(np.diff(starts) > 1)
        yield from zip(starts[np.concatenate([[0], cuts + 1])].tolist(), starts[np.concatenate([cuts, [len(starts) - 1]])].tolist())


def views(column: pa.Array) -> list[memoryview]:
    """The values of a binary column, without copying them."""
    return [memoryview(value.as_buffer()) for value in column]


def anchor_rows(texts: DataFrame, least: int = LEAST, lead: int = LEAD) -> DataFrame:
    """(digest, lo, hi, off, gram, slice) from (digest, data); a task scans equal texts once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, seen = Scanner(least, lead), set()
        for batch in batches:
            names, parts = [], []
            for key, data in zip(batch.column("digest").to_pylist(), views(batch.column("data"))):
                if len(data) >= least and key not in seen:
                    seen.add(key)
                    names.append(key)
                    parts.append(data)
            keys = pa.array(names, pa.binary())
            for text, lo, hi, off, gram, slices in scanner.scan(parts):
                columns = [keys.take(pa.array(text)), lo, hi, off.astype(np.int32), gram, pa.array(slices, pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["digest", "lo", "hi", "off", "gram", "slice"])

    return texts.mapInArrow(scan, "digest binary, lo long, hi long, off int, gram long, slice binary")


def matching(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(may match, cannot match): rows by whether their value occurs among the keys, told by a
    bounded filter without a shuffle."""
    bits = filter_bits(keys.count())
    pages = write_table(repeated_pages(keys, column, bits, least=1), "pages")
    probed = probe(rows, pages, column, bits)
    return probed.where("maybe").drop("maybe"), probed.where(~F.col("maybe")).drop("maybe")


def repeated_spans(texts: DataFrame, least: int = LEAST, lead: int = LEAD) -> DataFrame:
    """(digest, lo, hi): spans, ends exclusive, that cover all repeated windows of distinct
    texts, from (digest, data). Spans of a text may touch and overlap."""
    spark = texts.sparkSession
    with small_batches(spark):
        anchors = write_table(anchor_rows(texts, least, lead), "anchors")
    bits = filter_bits(anchors.count())
    pages = write_table(repeated_pages(anchors, "gram", bits), "pages")
    shared = probe(anchors, pages, "gram", bits).where("maybe").drop("maybe")
    shared = write_table(shared.withColumn("occ", F.xxhash64("digest", "lo")), "shared")
    slices = shared.groupBy("gram", "slice").agg(
        F.min(F.struct("occ", "digest", "lo", "hi", "off")).alias("first"), F.max("occ").alias("last")
    )
    slices = write_table(slices.select("gram", "slice", "first.*", (F.col("last") != F.col("first.occ")).alias("again")), "slices")
    twice = slices.where("again").select("gram", "slice")
    whole = shared.join(twice, ["gram", "slice"], "left_semi").select("digest", "lo", (F.col("hi") + least).alias("hi"))

    several = write_table(slices.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "several")
    wanted = slices.join(several, "gram").withColumn("hot", F.col("n") > HOT)
    wanted = write_table(
        wanted.groupBy("digest").agg(F.collect_list(F.struct("lo", "hi", "off", "again", "hot")).alias("slices")), "wanted"
    )
    sources, _ = matching(texts, wanted, "digest")
    sources = sources.dropDuplicates(["digest"]).join(wanted, "digest")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("slices")
            for i, (key, data) in enumerate(zip(batch.column("digest").to_pylist(), views(batch.column("data")))):
                listed = lists[i].as_py()
                columns = {
                    "digest": pa.array([key] * len(listed), pa.binary()),
                    "lo": pa.array([s["lo"] for s in listed], pa.int64()),
                    "off": pa.array([s["off"] for s in listed], pa.int32()),
                    "again": pa.array([s["again"] for s in listed], pa.bool_()),
                    "hot": pa.array([s["hot"] for s in listed], pa.bool_()),
                    "part": pa.array([data[s["lo"] : s["hi"] + least] for s in listed], pa.binary()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    parts = sources.select("digest", "data", "slices").mapInArrow(
        cut, "digest binary, lo long, off int, again boolean, hot boolean, part binary"
    )
    with small_batches(spark):
        parts = write_table(parts, "parts")
        found = write_table(_sort_buckets(parts, least, lead), "found")
    inner = found.where("window is null").select("digest", "lo", "hi")
    border = found.where("window is not null")
    across = border.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    across = border.join(across, "window", "left_semi").select("digest", "lo", "hi")
    return whole.unionByName(inner).unionByName(across)


def _sort_buckets(parts: DataFrame, least: int, lead: int) -> DataFrame:
    """(digest, lo, hi, window): repeated spans of slices that occur once, and the windows at
    the borders of buckets with their hash."""
    size = parts.agg(F.sum(F.octet_length("part"))).first()[0] or 0
    rest = F.octet_length("part") - F.col("off")
    whole = F.concat(F.substring("part", F.col("off") + 1, rest), F.substring("part", F.lit(1), F.col("off")))
    key = F.when(F.col("hot"), whole).otherwise(F.substring("part", F.col("off") + 1, F.lit(lead)))
    ranged = parts.repartitionByRange(max(1, -(-size // BUCKET_BYTES)), key)

    names = ["digest", "lo", "hi", "window"]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The slices are copied out of their batches one by one; of a batch nothing else is kept.
        slices, digests, columns = [], [], {"lo": [], "off": [], "again": [], "hot": []}
        for batch in batches:
            slices += [bytes(view) for view in views(batch.column("part"))]
            digests += batch.column("digest").to_pylist()
            for name, parts in columns.items():
                parts.append(batch.column(name).to_numpy(zero_copy_only=False).copy())
        if not slices:
            return
        los, offs, again, hot = (np.concatenate(columns[name]) for name in columns)
        repeated, border = compare_bucket(slices, offs.astype(np.int64), hot.astype(bool), least, lead)
        out = []
        for i in np.flatnonzero(repeated.any(axis=1) & ~again.astype(bool)):
            starts = np.sort(los[i] + offs[i] - np.flatnonzero(repeated[i]))
            out += [(digests[i], a, b + least, None) for a, b in runs(starts)]
        for i, w in border:
            out.append((digests[i], int(los[i]) + w, int(los[i]) + w + least, hashlib.sha256(slices[i][w : w + least]).digest()))
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
        for start in range(0, len(out), HANDED_ON):
            part = zip(*out[start : start + HANDED_ON])
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(part, kinds)], names)

    return ranged.mapInArrow(sort, "digest binary, lo long, hi long, window binary")


def merge_spans(spans) -> list[tuple[int, int]]:
    """Touching and overlapping spans as maximal ones, in order."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, lead: int = LEAD) -> DataFrame:
    """One row per document: id, n_bytes, kept (the remaining bytes), spans removed.

    Documents that lose nothing are not shuffled.
    """
    data = filled(text_col).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), digest(data).alias("digest"), data.alias("data"))
    long_texts = rows.where(F.octet_length("data") >= least)
    spans = repeated_spans(long_texts.select("digest", "data"), least, lead)
    copies = long_texts.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    copies = write_table(copies, "copies")
    listed = spans.groupBy("digest").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    listed = write_table(listed, "spans")
    touched, whole = matching(rows, listed.select("digest").unionByName(copies), "digest")
    # Copies lose everything; their texts are not handed to Python.
    size = F.octet_length("data").cast("long").alias("n_bytes")
    gone = touched.select("id", "digest", size).join(copies, "digest", "left_semi")
    touched = touched.join(copies, "digest", "left_anti").join(listed, "digest", "left").select("id", "data", "spans")
    kind = rows.schema["id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            # What remains is handed on every few texts, so that it isn't held beside them all.
            for start in range(0, whole.num_rows, HANDED_ON):
                batch = whole.slice(start, HANDED_ON)
                sizes, kept, spans = [], [], []
                for text, listed in zip(views(batch.column("data")), batch.column("spans")):
                    gone = merge_spans(listed.as_py() or [])
                    ends = [0, *(b for _, b in gone)]
                    sizes.append(len(text))
                    kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(text)])))
                    spans.append([{"lo": a, "hi": b} for a, b in gone])
                arrays = [pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, SPANS)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", "n_bytes", "kept", "spans"])

    cut = touched.mapInArrow(remove, f"id {kind}, n_bytes long, kept binary, spans array<struct<lo:long,hi:long>>")
    with small_batches(docs.sparkSession):
        cut = write_table(cut, "kept")
    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    same = whole.select("id", size, F.col("data").alias("kept"), none.alias("spans"))
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("n_bytes").alias("hi")))
    emptied = gone.select("id", "n_bytes", F.lit(b"").alias("kept"), all_of_it.alias("spans"))
    return cut.unionByName(same).unionByName(emptied).withColumnRenamed("id", id_col)


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, lead: int = LEAD) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = dedup(docs, id_col, text_col, least, lead)
    return out.select(
        id_col,
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
