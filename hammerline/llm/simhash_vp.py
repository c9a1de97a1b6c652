"""Near-duplicates by SimHash, linked through a vantage-point tree over the Hamming space.

Fingerprints are reduced to distinct ones first, so copies cost nothing further. A tree of
vantage points, built from a bounded sample, cuts the space into shards: at each node the
points nearer than the radius lie inside, the others outside. Every fingerprint is owned by one
shard. By the triangle inequality two linked fingerprints can lie on either side of a border
only if the inner one is within the link distance of it, so only such inner points also visit
the outer side, as queries. Each shard then searches exactly, with a vantage-point tree of its
own down to small leaves, and returns a spanning forest of its links, never all pairs.

Defined cases: NULL text is the empty text; a text without words has fingerprint zero; fewer
words than a shingle form one shingle; repeated rows and equal ids are rows of their own and
share a component; a NULL id is smaller than any other and does not name a component while the
component has another id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.llm.components import components
from hammerline.llm.exact_dedup import filter_bits, probe, repeated_pages
from hammerline.llm.texts import filled, small_batches
from hammerline.session import materialise, write_table

SEED = 42
SHINGLE = 3
DISTANCE = 2
# A shard owns about OWNED distinct fingerprints, until there are SHARDS of them; beyond, shards
# grow and their own trees deepen. The shard tree is built from SAMPLED fingerprints for each
# shard, so the driver and the tasks hold at most SHARDS nodes and SHARDS * SAMPLED numbers.
OWNED = 8_192
SHARDS = 1 << 17
SAMPLED = 16
LEAF = 48
# Shingle hashes turned to bits at a time.
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text: bits set in over half of the shingle hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, BLOCK):
        part = words[start : min(n, start + BLOCK) + shingle - 1]
        shingles = zip(*(part[i:] for i in range(shingle))) if n > 1 or len(words) == shingle else [part]
        hashes = np.array([digest(b" ".join(s), SEED) for s in shingles], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def udf(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = np.fromiter((fingerprint(t, shingle) for t in batch), dtype=np.uint64, count=len(batch))
            yield pd.Series(values.view(np.int64))

    return udf(filled(text))


def hex16(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def hamming(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def shard_tree(sample: np.ndarray, owned: int, seed: int = SEED) -> tuple | int:
    """Nested (vantage, radius, inside, outside) with shard numbers at the leaves.

    A node whose points cannot be told apart by distance becomes a leaf as it is.
    """
    rng, shards = np.random.default_rng(seed), iter(range(1 << 30))

    def grow(points: np.ndarray) -> tuple | int:
        if len(points) <= owned:
            return next(shards)
        vantage = points[rng.integers(len(points))]
        far = hamming(points, vantage)
        radius = int(np.median(far))
        inside = far <= radius
        if inside.all():
            radius, inside = radius - 1, far <= radius - 1
        if inside.all() or not inside.any():
            return next(shards)
        return int(vantage), radius, grow(points[inside]), grow(points[~inside])

    return grow(sample)


def route(tree: tuple | int, points: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(shard, indices of points, owned): one owner for each point and the shards it visits."""

    def walk(node, own, visit):
        if not len(own) and not len(visit):
            return
        if isinstance(node, int):
            yield node, own, True
            yield node, visit, False
            return
        vantage, radius, inside, outside = node
        near, away = hamming(points[own], np.uint64(vantage)), hamming(points[visit], np.uint64(vantage))
        yield from walk(inside, own[near <= radius], visit[away <= radius + distance])
        crossing = own[(near <= radius) & (near > radius - distance)]
        yield from walk(outside, own[near > radius], np.concatenate([visit[away > radius - distance], crossing]))

    yield from walk(tree, np.arange(len(points)), np.arange(0))


class Forest:
    """Union-find over positions of an array; links() are its spanning edges."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def flatten(self) -> None:
        parent = self.parent
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                return
            parent[:] = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Link many pairs at once; pairs already connected cost only array work."""
        self.flatten()
        roots = np.sort(np.stack([self.parent[a], self.parent[b]]), axis=0)
        for x, y in np.unique(roots[:, roots[0] != roots[1]], axis=1).T:
            x, y = self.find(int(x)), self.find(int(y))
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.links.append((x, y))


def link_shard(points: np.ndarray, owned: np.ndarray, distance: int, leaf: int = LEAF) -> list[tuple[int, int]]:
    """Spanning links, as pairs of positions, among all pairs with at least one owned point.

    Pairs of two visitors belong to other shards. The local tree holds the owned points; owned
    and visiting points alike descend it with triangle bounds.
    """
    forest, rng = Forest(len(points)), np.random.default_rng(len(points))

    def search(own: np.ndarray, visit: np.ndarray) -> None:
        if not len(own) or len(own) + len(visit) < 2:
            return
        if len(own) > leaf:
            vantage = points[own[rng.integers(len(own))]]
            near, away = hamming(points[own], vantage), hamming(points[visit], vantage)
            radius = int(np.median(near))
            inside = near <= radius
            if not inside.all():
                search(own[inside], visit[away <= radius + distance])
                crossing = own[inside & (near > radius - distance)]
                search(own[~inside], np.concatenate([visit[away > radius - distance], crossing]))
                return
        every = np.concatenate([own, visit])
        for start in range(0, len(every), 2048):
            rows = every[start : start + 2048]
            for low in range(0, len(own), 2048):
                cols = own[low : low + 2048]
                i, j = np.nonzero(hamming(points[rows][:, None], points[cols][None, :]) <= distance)
                a, b = rows[i], cols[j]
                if (apart := a != b).any():
                    forest.join(a[apart], b[apart])

    search(np.flatnonzero(owned), np.flatnonzero(~owned))
    return forest.links


def link_fingerprints(
    distinct: DataFrame, distance: int = DISTANCE, owned: int = OWNED, seed: int = SEED
) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that keep all components.

    ``distinct`` should be materialised; it is read for its size, for the sample and for the
    routing. A fingerprint visits about 1.3 shards for each level of the tree, so the rows
    sent grow as the fingerprints to the power 1.4.
    """
    total = distinct.count()
    shards = min(SHARDS, max(1, -(-total // owned)))
    share = min(1.0, SAMPLED * shards / max(1, total))
    # By a hash of the value, so a lost and repeated task draws the same sample.
    drawn = distinct.where(F.pmod(F.xxhash64("fp", F.lit(seed)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))
    sample = np.sort(np.array([r[0] for r in drawn.select("fp").collect()], dtype=np.int64)).view(np.uint64)
    tree = shard_tree(sample, max(1, -(-len(sample) // shards)), seed) if shards > 1 else 0

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["fp"].to_numpy(np.int64).view(np.uint64)
            routed = [(shard, at, own) for shard, at, own in route(tree, points, distance) if len(at)]
            sizes = [len(at) for _, at, _ in routed]
            at = np.concatenate([at for _, at, _ in routed])
            yield pd.DataFrame(
                {
                    "shard": np.repeat([shard for shard, _, _ in routed], sizes),
                    "fp": points[at].view(np.int64),
                    "owned": np.repeat([own for _, _, own in routed], sizes),
                }
            )

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        links = link_shard(points, pdf["owned"].to_numpy(bool), distance)
        at = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": points[at[:, 0]].view(np.int64), "b": points[at[:, 1]].view(np.int64)})

    placed = distinct.select("fp").mapInPandas(spread, "shard int, fp long, owned boolean")
    if isinstance(tree, int):  # one shard
        placed = distinct.select(F.lit(0).alias("shard"), "fp", F.lit(True).alias("owned"))
    return placed.groupBy("shard").applyInPandas(search, "a long, b long")


def near_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id)."""
    prints = docs.select(F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp"))
    with small_batches(docs.sparkSession):
        prints = materialise(prints)
    distinct = materialise(prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(link_fingerprints(distinct, distance))
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """The documents that stay, with all columns: of each component the one with its id.

    Of rows alike in id and text one stays. Most documents stay and are alone: a bounded filter of
    the rows that go or are repeated lets them pass without a shuffle, and only the others are
    joined to what is decided about them.
    """
    mark = F.xxhash64(F.col(id_col), filled(text_col)).alias("mark")
    # A NULL id comes last, so that it stands for a component only if there is no other.
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), mark).alias("key")
    grouped = near_components(docs.select(key, F.col(text_col).alias("text")), "key", "text", shingle, distance)
    counted = grouped.groupBy("key").agg(F.count("*").alias("n"), (F.min("component_id") == F.col("key")).alias("stays"))
    decided = counted.where(~F.col("stays") | (F.col("n") > 1))
    decided = write_table(decided.select(F.col("key.id").alias("its_id"), F.col("key.mark").alias("its_mark"), "stays"), "decided")
    bits = filter_bits(decided.count())
    pages = write_table(repeated_pages(decided, "its_mark", bits, least=1), "pages")
    probed = probe(docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), mark), pages, "mark", bits)
    alike = (F.col("mark") == F.col("its_mark")) & F.col("id").eqNullSafe(F.col("its_id"))
    rest = write_table(probed.where("maybe").join(decided, alike, "left").where("stays is null or stays"), "rest")
    once = probed.where(~F.col("maybe")).select("doc").unionByName(rest.where("stays is null").select("doc"))
    return once.unionByName(rest.where("stays").dropDuplicates(["id", "mark"]).select("doc")).select("doc.*")
