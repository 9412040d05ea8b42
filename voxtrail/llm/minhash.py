"""Near-duplicate documents: fast similarity sketches, banding, and exact verification on full shingle sets.

Sketch: in round i every shingle falls into one hashed bin of T with the value (i, hash); a bin keeps its least value. The first T rounds choose bins by hash, T more fill bin i - T for certain, so every coordinate fills; rounds stop when all bins are full, for all but short texts after the first. Two sets agree in a coordinate with a probability of their Jaccard similarity, and the agreeing number is concentrated about its mean. BANDS keys of ROWS coordinates each find a pair at 0.85 with a probability of 1 - 1e-7, at 0.80 of 1 - 1.5e-5.

Equal sets are one class from the start, named by 128 bits of the set's digest and numbered once written, so copies cost one row each; copies are summed up before they are shuffled. Within a band's bucket no list of all pairs is made: each class is first held against the bucket's least class, links are joined to components, and only buckets that still hold several components go on: of up to SMALL classes by the pairs between components, larger ones block against block, where each class is sent once for each block of its bucket and a task returns no more links than it has classes. A block has about BLOCK classes, or fewer where their sets have more than BLOCK_BYTES. A bucket's least class may be that of very many pairs: its set is sent once for each HUB pairs, to as many tasks. All classes of a bucket that aren't connected yet are thus compared exactly, on full sets.

Defined results: null and empty texts have an empty set and are linked with nothing; a null doc_id joins its group, whose component is the least id that isn't null; kept compares null-safely, so a row with a null doc_id is kept where its component is null too; rows repeated in full are copies of each other; of rows with a null doc_id those of equal text count as repeated; an empty table gives an empty result; columns other than id and text, whatever their names, are ignored by near_duplicates() and kept by drop_near_duplicates().
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, slices, unused
from .components import connected_components
from .words import mixed, word_hashes

WIDTH = 5
#: Similarity of linked texts: op4's contract, and the general rule that holds where no contract says otherwise.
PERCENT = 85
DROP_PERCENT = 80
BANDS, ROWS = 28, 5
T = BANDS * ROWS
SMALL = 24
BLOCK = 512
BLOCK_BYTES = 32 << 20
#: Pairs of one class that are compared in one place.
HUB = 128

_U = np.uint64


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=np.uint64) | _U(1)


_PLACE = _odd(1, WIDTH + 1)
_ROUND = _odd(2, 2 * T)
_COORD = _odd(3, T)
_LOW = _U(0xFFFFFFFFFFFF)


def shingles(data: bytes | None) -> np.ndarray:
    """The sorted distinct hashes of the WIDTH-word shingles; of the whole sequence if it is shorter."""
    h = word_hashes((data or b"").lower())
    n, k = len(h), min(len(h), WIDTH)
    if not n:
        return h
    s = np.full(n - k + 1, k, np.uint64) * _PLACE[WIDTH]
    for j in range(k):
        s += h[j : n - k + 1 + j] * _PLACE[j]
    return np.unique(mixed(s))


def sketch(s: np.ndarray) -> np.ndarray:
    """T coordinates (round << 48 | hash), every one filled, of a set that isn't empty."""
    out, left, i = np.zeros(T, np.uint64), np.ones(T, bool), 0
    while left.any() and i < T:
        rounds = min(T - i, max(1, int(6.5 * T / len(s))))
        h = mixed(s[None, :] * _ROUND[i : i + rounds, None])
        at = ((h >> _U(32)) * _U(T)) >> _U(32)
        key = (at << _U(56)) | (np.arange(i, i + rounds, dtype=np.uint64) << _U(48))[:, None] | (h & _LOW)
        key = np.sort(key[left[at.astype(np.int64)]])
        bins = (key >> _U(56)).astype(np.int64)
        first = np.ones(len(key), bool)
        first[1:] = bins[1:] != bins[:-1]
        out[bins[first]] = key[first] & _U(0x00FFFFFFFFFFFFFF)
        left[bins] = False
        i += rounds
    for j in np.flatnonzero(left):
        out[j] = (_U(T + j) << _U(48)) | (mixed(s * _ROUND[T + j]).min() >> _U(16))
    return out


def band_keys(coords: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band."""
    return mixed((mixed(coords) * _COORD).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def _sketched(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_key, n_shingles, the two halves of the set's digest, and the bands, for every row; the last three null for an empty set."""

    def run(batches):
        for b in slices(batches, 2):
            n, high, low, bands = [], [], [], []
            for data in b.column(2).to_pylist():
                s = shingles(data)
                digest = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64).tolist() if len(s) else (None, None)
                n.append(len(s))
                high.append(digest[0])
                low.append(digest[1])
                bands.append(band_keys(sketch(s)) if len(s) else None)
            cols = [b.column(0), b.column(1), *(pa.array(x, pa.int64()) for x in (n, high, low)), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_key", "n_shingles", "high", "low", "bands"])

    rows = docs.select(F.col(doc_id).cast("long"), F.xxhash64(text), F.col(text).cast("binary"))
    return rows.mapInArrow(run, "doc_id long, text_key long, n_shingles long, high long, low long, bands array<long>")


def similar(n_a, n_b, common, percent: int = PERCENT):
    return 100 * common >= percent * (n_a + n_b - common)


def common_counts(sets: list) -> np.ndarray:
    """The sizes of the intersections of all sets with each other, from the values that two or more of them have."""
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    use = count[col] > 1
    of, col = of[use], number[col[use]]
    order = np.argsort(col, kind="stable")
    of, col = of[order], col[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        lo, hi = np.searchsorted(col, [start, start + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[of[lo:hi], col[lo:hi] - start] = 1
        total += part @ part.T
    return np.rint(total).astype(np.int64)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what a symmetric matrix of links connects."""
    left, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root], queue = False, [root]
        while queue:
            x = queue.pop()
            found = np.flatnonzero(linked[x] & left)
            left[found] = False
            edges += [(x, int(y)) for y in found]
            queue += found.tolist()
    return edges



def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. pairs: a, b, and m, no less than the pairs that b has."""

    def run(batches):
        for b in batches:
            both = zip(b.column(2).to_pylist(), b.column(3).to_pylist())
            common = [(len(x) // 8, len(y) // 8, len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))) for x, y in both]
            yield b.select(["a", "b"]).filter(pa.array([similar(*x, percent) for x in common], pa.bool_()))

    parts = F.ceil(F.col("m") / HUB).cast("int")
    hubs = pairs.groupBy("b").agg(F.max(parts).alias("parts"))
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = hubs.join(sets, hubs["b"] == sets["id"]).select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("set").alias("set_b"))
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("a"), parts).cast("int").alias("part"))
    return dealt.join(left, "a").join(right, ["b", "part"]).select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _verified_blocks(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect the similar classes of each bucket. members: key, id, label, m and size (the bucket's classes and the bytes of their sets)."""
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("size") / BLOCK_BYTES)).cast("int")
    rows = members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.join(sets, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "label", "set")

    def run(table: pa.Table) -> pa.Table:
        ids, labels, own = (np.array(table.column(k)) for k in ("id", "label", "own"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").to_pylist()]
        n = np.array([len(s) for s in sets])
        linked = similar(n[:, None], n[None, :], common_counts(sets), percent) & (labels[:, None] != labels[None, :])
        if table.column("i")[0] != table.column("j")[0]:
            linked &= own[:, None] != own[None, :]
        edges = forest(linked)
        return pa.table({"a": pa.array([ids[x] for x, _ in edges], pa.int64()), "b": pa.array([ids[y] for _, y in edges], pa.int64())})

    return rows.groupBy("key", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, label (null: no copy and no link) and text_key (a hash of the text) for every row. Texts are linked at 100 * intersection >= percent * union; percent of 80 or more is what BANDS and ROWS are made for."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    all_rows = scratch.table(_sketched(docs, doc_id, text), "sketches")
    # one row for each class of equal sets; copies meet before the shuffle
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    classes = all_rows.where(F.col("high").isNotNull()).groupBy("high", "low").agg(F.min(row).alias("row"), F.min("doc_id").alias("least"), F.count("*").alias("n"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
    classes = scratch.table(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    members = classes.select("id", "size", F.explode("bands").alias("key"))
    buckets = scratch.table(members.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("m"), (8 * F.sum("size")).alias("size")).where("m > 1"), "buckets")
    members = scratch.table(members.select("id", "key").join(buckets, "key"), "candidates")
    scratch.drop("buckets")
    # the sets of the classes that share a bucket, each from one of its rows; neither side of the join is bounded, so it is a merge at any size
    chosen = scratch.table(classes.join(members.select("id").distinct(), "id", "left_semi").select("id", F.col("row.doc_id").alias("row"), F.col("row.text_key").alias("text_key")), "chosen")
    texts = docs.select(F.col(doc_id).cast("long").alias("at"), F.xxhash64(text).alias("key"), F.col(text).cast("binary").alias("data"))

    def to_sets(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(x).tobytes() for x in b.column(1).to_pylist()], pa.binary())], names=["id", "set"])

    same = chosen["row"].eqNullSafe(texts["at"]) & (chosen["text_key"] == texts["key"])
    sets = chosen.join(texts.hint("merge"), same).dropDuplicates(["id"]).select("id", "data").mapInArrow(to_sets, "id long, set binary")
    sets = scratch.table(sets, "sets")
    first = members.where("id <> hub").groupBy(F.col("id").alias("a"), F.col("hub").alias("b")).agg(F.max("m").alias("m"))
    links = scratch.table(_verified(scratch.table(first, "pairs-1"), sets, percent), "links-1")
    labels = connected_components(links, scratch, "first")
    named = members.where("m > 2").join(labels, "id", "left").select("key", "id", "hub", "m", "size", F.coalesce("label", "id").alias("label"))
    named = scratch.table(named, "named")
    open_buckets = named.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select("key")
    open_buckets = scratch.table(open_buckets, "open")
    rest = scratch.table(named.join(open_buckets, "key"), "rest")
    few = rest.where((F.col("m") <= SMALL) & (F.col("id") != F.col("hub")))
    x, y = few.select("key", F.col("id").alias("a"), F.col("label").alias("la")), few.select("key", F.col("id").alias("b"), F.col("label").alias("lb"))
    pairs = scratch.table(x.join(y, "key").where("a < b and la <> lb").select("a", "b").distinct().withColumn("m", F.lit(SMALL)), "pairs-2")
    more = _verified(pairs, sets, percent).union(_verified_blocks(rest.where(F.col("m") > SMALL), sets, percent))
    more = scratch.table(more, "links-2")
    labels = connected_components(links.union(more), scratch, "all")
    # components by their least doc_id; classes of one row that have no link need no row here
    found = classes.select("id", "high", "low", "least", "n").join(labels, "id", "left").where("n > 1 or label is not null")
    found = scratch.table(found.select("high", "low", "least", F.coalesce("label", "id").alias("label")), "found")
    roots = scratch.table(found.groupBy("label").agg(F.min("least").alias("component_id")), "roots")
    found = scratch.table(found.join(roots, "label").select("high", "low", "label", "component_id"), "components")
    joined = all_rows.select("doc_id", "n_shingles", "high", "low", "text_key").join(found, ["high", "low"], "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "label", "text_key")


def drop_near_duplicates(docs: DataFrame, percent: int = DROP_PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each group of linked rows: that of the least doc_id, null last. Rows without words stay all.

    One left-anti join deals out the texts by row, so no group meets in a task."""
    scratch = Scratch(docs.sparkSession, "dropnear")
    rows = near_duplicates(docs, percent, doc_id, text).where("label is not null")
    rows = scratch.table(rows.select("label", F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("row"), "text_key"), "rows")
    first = scratch.table(rows.groupBy("label").agg(F.min(F.struct("none", "row", "text_key")).alias("first")), "first")
    at, none, key = names = unused(docs.columns, "at", "none", "key")
    keys = [F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), F.col(doc_id).cast("long").isNull(), F.xxhash64(text)]
    named = lambda df: df.select(F.col("row").alias("g_at"), F.col("none").alias("g_none"), F.col("text_key").alias("g_key"))
    gone = scratch.table(named(rows.join(first, "label").where(F.struct("none", "row", "text_key") != F.col("first"))).distinct(), "gone")
    twice = scratch.table(named(rows).groupBy("g_at", "g_none", "g_key").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "twice")
    left = docs.withColumns(dict(zip(names, keys))).alias("d").hint("merge")
    same = lambda other: [F.col(f"d.{x}") == other[g] for x, g in zip(names, ("g_at", "g_none", "g_key"))]
    left = left.join(gone, same(gone), "left_anti")
    if not twice.isEmpty():  # rows repeated in full are dealt with apart, so that the others need no sort
        left = left.join(twice, same(twice), "left_anti").union(left.join(twice, same(twice), "left_semi").dropDuplicates([at, none, key]))
    return left.drop(*names)
