"""Near-duplicate detection by MinHash with tensored banding.

Documents with the same set of word shingles form a class. A class has ``COLLECTIONS`` small collections of ``ROWS``
minhashes. The tables are all pairs of collections: two classes are candidates if they agree in two collections. So
24 collections of 4 minhashes give 276 tables with keys of 8 minhashes from 96 minhashes instead of 2208, about the
square root. Two sets of similarity 0.8 fail to meet in all tables with a chance of 6e-5, at 0.85 with 2e-7.

1. Collections that no other class shares are dropped first (a count by key), so only classes with at least two
   shared collections make table keys.
2. In each table all classes are tied to the smallest one: a star, never all pairs. The connected components of
   the stars are candidate clusters; no candidate pair lies across two of them.
3. Candidates of a cluster are confirmed on full shingle sets inside tasks; pairs that are already connected are not
   compared. A cluster over ``CELL_MEMBERS`` or ``CELL_SHINGLES`` is dealt to cells of that size. Cells pass up to
   ``ENVOYS`` members of each of their groups to the next round until they fit one cell. Whoever is not yet in the
   cluster's largest group afterwards is then compared with all cells, so no candidate pair is lost at any size.
4. The components of the confirmed links are the result.

Edge cases: a text without words has no shingles and is linked with nothing; null ids take part but give no component
id, and a component without any id has a null one, all rows of it being kept; rows that repeat an id with another
text are separate texts, fully equal rows are one class; an empty table gives an empty result; columns other than
doc_id and text are not read by ``report`` and carried through by ``keep_one``. Shingles are told by 64-bit hashes,
classes by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import SPACE, free_names, in_batches, quoted, stage, text_key, texts
from tallymark.llm.components import components
from tallymark.llm.windows import STEP, mix

ROWS, COLLECTIONS = 4, 24
# Linked: 100 * intersection >= PERCENT * union.
PERCENT = 80
SHINGLE = 2
CELL_MEMBERS, CELL_SHINGLES = 8_192, 4_000_000
ENVOYS = 32
SEED = 20


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, rng.integers(0, 1 << 63, n, dtype=np.uint64)


class WordHashes(dict):
    """Hashes of words seen before, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str, hashes: WordHashes, width: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of the word shingles in order; a text with fewer words is one shingle."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    total = np.full(n, min(len(words), width), np.uint64)
    for k in range(min(len(words), width)):
        total = mix(total * np.uint64(STEP) + each[k : k + n])
    return np.unique(total)


def collections(shingle_set: np.ndarray, odd: np.ndarray, add: np.ndarray, n: int) -> np.ndarray:
    """One key per collection from its minhashes."""
    least = np.full(len(odd), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingle_set), 2048):
        part = np.multiply.outer(odd, shingle_set[at : at + 2048]) + add[:, None]
        least = np.minimum(least, part.min(axis=1))
    rows = least.reshape(n, -1)
    keys = np.arange(1, n + 1, dtype=np.uint64)
    for r in range(rows.shape[1]):
        keys = mix(keys * np.uint64(STEP) + rows[:, r])
    return keys.view(np.int64)


def sketches(docs: DataFrame, rows: int = ROWS, n: int = COLLECTIONS, width: int = SHINGLE) -> DataFrame:
    """(doc_id, key, n_shingles, digest, collections) of each row; the last two are null without shingles."""

    def run(batches: Iterable[pa.RecordBatch]):
        odd, add = coefficients(rows * n)
        hashes = WordHashes()
        for batch in batches:
            sizes, digests, keys = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), hashes, width)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                keys.append(collections(found, odd, add, n).tolist() if len(found) else None)
            found = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), *found],
                ["doc_id", "key", "n_shingles", "digest", "collections"],
            )

    rows_in = texts(docs).select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("key"), "text")
    return in_batches(rows_in).mapInArrow(
        run, "doc_id long, key long, n_shingles long, digest binary, collections array<long>"
    )


def stars(classes: DataFrame) -> DataFrame:
    """(a, b): every class of a table tied to the table's smallest class."""
    each = classes.select("node", F.explode("collections").alias("k"))
    shared = each.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("k")
    # A class has at most one entry per collection, so its list is bounded.
    lists = each.join(shared, "k", "left_semi").groupBy("node").agg(F.sort_array(F.collect_list("k")).alias("ks"))
    pairs = F.flatten(
        F.transform("ks", lambda x, i: F.transform(F.slice("ks", i + 2, F.size("ks")), lambda y: F.xxhash64(x, y)))
    )
    # Keys are 64-bit hashes; a chance hit only adds a candidate.
    entries = lists.filter(F.size("ks") > 1).select("node", F.explode(pairs).alias("table"))
    centres = entries.groupBy("table").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a < z")
    tied = entries.join(centres.select("table", "a"), "table").filter("node > a")
    return tied.select("a", F.col("node").alias("b")).distinct()


def is_linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(x), len(y)))
    if 100 * small < percent * large:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


class Groups:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = int(self.up[x])
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)

    def roots(self) -> np.ndarray:
        """The root of every position."""
        while (self.up != self.up[self.up]).any():
            self.up = self.up[self.up]
        return self.up


def confirm(
    nodes: list[int], groups: list[int], keys: np.ndarray, sets: list[np.ndarray], against: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links that connect candidates of different groups. Positions in ``against`` meet all others, these not each other."""
    state = Groups(len(nodes))
    first: dict[int, int] = {}
    for i, group in enumerate(groups):
        state.join(i, first.setdefault(group, i))
    links = []
    for x in np.flatnonzero(against):
        common = (keys == keys[x]).sum(axis=1)
        apart = state.roots() != state.find(x)
        others = np.flatnonzero((common >= 2) & (~against | (np.arange(len(nodes)) < x)) & apart)
        for y in others[np.argsort(-common[others], kind="stable")]:
            if state.find(x) != state.find(y) and is_linked(sets[x], sets[y], percent):
                state.join(x, y)
                links.append((nodes[x], nodes[y]))
    return links


def cells(members: DataFrame, by: list[str], percent: int, width: int) -> DataFrame:
    """Confirmed links (a, b) inside each cell; rows with ``asks`` meet all rows of their cell."""

    def run(table):
        hashes = WordHashes()
        sets = [shingles(t.as_py(), hashes, width) for t in table.column("text")]
        keys = np.array(table.column("collections").to_pylist(), np.int64)
        links = confirm(
            table.column("node").to_pylist(), table.column("grp").to_pylist(), keys, sets,
            np.array(table.column("asks").to_pylist(), bool), percent,
        )
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return members.groupBy(*by).applyInArrow(run, "a long, b long")


def n_cells(members: DataFrame, by: str, limits: tuple[int, int]) -> DataFrame:
    """How many cells each cluster needs."""
    need = F.greatest(F.ceil(F.count(F.lit(1)) / limits[0]), F.ceil(F.sum("n_shingles") / limits[1]))
    return members.groupBy(by).agg(need.alias("cells"))


def dealt(members: DataFrame, limits: tuple[int, int], turn: int) -> DataFrame:
    sized = members.join(n_cells(members, "cluster", limits), "cluster")
    return sized.withColumn("cell", F.pmod(F.xxhash64("node", F.lit(turn)), F.col("cells")))


def regroup(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with ``grp`` set to their component under all links so far."""
    found = components(links).select("node", F.col("component").alias("found"))
    return members.join(found, "node", "left").withColumn("grp", F.coalesce("found", "node")).drop("found")


def confirmed(members: DataFrame, limits: tuple[int, int], percent: int, width: int) -> DataFrame:
    """All links (a, b) that connect candidates, from members (cluster, node, n_shingles, collections, text).

    Small clusters take one round. ``rest`` are the members of larger ones, which go on in further rounds.
    """
    members = members.withColumns({"grp": F.col("node"), "asks": F.lit(True)})
    placed = dealt(members, limits, 0)
    links = stage(cells(placed, ["cluster", "cell"], percent, width), "links")
    large = placed.filter("cells > 1")
    if large.isEmpty():
        return links
    rest = stage(large.drop("cells", "cell"), "large-clusters")
    envoys, turn = rest, 0
    while True:
        # Members that speak for their group in the next round; the groups of one cell hold together already.
        turn += 1
        grouped = regroup(envoys, links)
        before = dealt(grouped, limits, turn - 1)
        rank = F.row_number().over(Window.partitionBy("cluster", "cell", "grp").orderBy(F.xxhash64("node", F.lit(turn))))
        fewer = before.withColumn("rank", rank).filter(F.col("rank") <= ENVOYS).drop("rank", "cells", "cell")
        fewer = stage(fewer, "envoys")
        again = dealt(fewer, limits, turn)
        links = stage(links.unionByName(cells(again, ["cluster", "cell"], percent, width)), "links")
        if again.filter("cells > 1").isEmpty() or fewer.count() == envoys.count():
            break
        envoys = fewer
    # What is left: members outside their cluster's largest group meet every cell of the cluster.
    grouped = stage(regroup(rest, links), "large-groups")
    sizes = grouped.groupBy("cluster", "grp").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("cluster").agg(F.max(F.struct("n", F.col("grp").alias("top"))).alias("s")).select("cluster", "s.top")
    marked = dealt(grouped, limits, 0).join(largest, "cluster").withColumn("asks", F.col("grp") != F.col("top"))
    half = (max(1, limits[0] // 2), max(1, limits[1] // 2))
    askers = marked.filter("asks").drop("cells", "cell")
    askers = askers.join(n_cells(askers, "cluster", half).withColumnRenamed("cells", "ask_cells"), "cluster")
    askers = askers.withColumn("ask_cell", F.pmod(F.xxhash64("node", F.lit(-1)), F.col("ask_cells")))
    counts = n_cells(grouped, "cluster", half)
    hosts = marked.drop("cells", "cell").join(counts, "cluster").withColumn("cell", F.pmod(F.xxhash64("node", F.lit(-2)), F.col("cells")))
    hosts = hosts.join(askers.select("cluster", "ask_cells").distinct(), "cluster").withColumn("asks", F.lit(False))
    hosts = hosts.withColumn("ask_cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ask_cells") - 1)))
    asked = askers.join(counts, "cluster").withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)))
    columns = ["cluster", "cell", "ask_cell", "node", "grp", "asks", "collections", "text"]
    both = asked.select(*columns).unionByName(hosts.select(*columns))
    return links.unionByName(stage(cells(both, ["cluster", "cell", "ask_cell"], percent, width), "links"))


def report(
    docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE, limits: tuple[int, int] = (CELL_MEMBERS, CELL_SHINGLES),
    rows: int = ROWS, n: int = COLLECTIONS,
) -> DataFrame:
    """Per row: shingles, the smallest id of its component, and whether it is the one with that id."""
    return labelled(docs, percent, width, limits, rows, n).select("doc_id", "n_shingles", "component_id", "kept")


def labelled(docs: DataFrame, percent: int, width: int, limits: tuple[int, int], rows: int, n: int) -> DataFrame:
    sketch = stage(sketches(docs, rows, n, width), "sketches")
    merged = sketch.filter("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("least_id"),
        F.min(F.struct("doc_id", "key")).alias("sample"),
        F.first("collections").alias("collections"),
        F.first("n_shingles").alias("n_shingles"),
    )
    # Numbers are written once, so every later read sees the same ones.
    classes = stage(merged.withColumn("node", F.monotonically_increasing_id()), "classes")
    clusters = components(stars(classes)).withColumnRenamed("component", "cluster")
    chosen = classes.join(clusters, "node").select("cluster", "node", "n_shingles", "collections", "sample")
    source = texts(docs).select(F.col("doc_id").cast("long"), "text").withColumn("key", text_key(F.col("text")))
    same = F.col("sample.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("sample.key") == F.col("key"))
    # Rows that are equal as a whole give the same member again; one is enough.
    members = chosen.join(source, same).drop("doc_id", "key", "sample").dropDuplicates(["node"])
    links = confirmed(stage(members, "members"), limits, percent, width)
    groups = components(links)
    named = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_class = named.select("digest", "component").join(least, "component")
    linked = sketch.drop("collections").join(by_class, "digest", "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    kept = F.coalesce(F.col("doc_id") == component_id, component_id.isNull())
    return linked.select(
        "doc_id", "key", "n_shingles", "component", component_id.alias("component_id"), kept.alias("kept")
    )


def keep_one(docs: DataFrame, percent: int = PERCENT, width: int = SHINGLE) -> DataFrame:
    """The rows to keep, with their columns: one per component, and all rows without words.

    The row with the smallest id stays (an id before none), among equal ids the one with the smallest text hash, and
    one of fully equal rows.
    """
    labels = labelled(docs, percent, width, (CELL_MEMBERS, CELL_SHINGLES), ROWS, COLLECTIONS)
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("best")
    one = labels.filter("n_shingles > 0").groupBy("component").agg(best).select("best.doc_id", "best.key")
    key, id_key, their_key, their_id_key = free_names(docs, "_key", "_id_key", "_their_key", "_their_id_key")
    stays = one.select(F.col("key"), F.xxhash64("doc_id")).toDF(their_key, their_id_key)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.withColumns({key: text_key(text), id_key: F.xxhash64(F.col("doc_id").cast("long"))})
    empty = F.trim(text, F.lit(SPACE)) == ""
    same = (F.col(key) == F.col(their_key)) & (F.col(id_key) == F.col(their_id_key))
    single = keyed.filter(~empty).join(stays, same).dropDuplicates([key, id_key])
    return single.select(*quoted(docs.columns)).unionByName(docs.filter(empty))
