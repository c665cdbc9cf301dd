"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

The join is exact. Its steps:

1. *Classes.* Every text becomes a sorted set of shingle hashes; equal sets form
   one class, represented by its smallest doc_id. Copies never meet again.
2. *Size bands.* Two linked sets differ in size by at most the threshold, so they
   lie in one band or in neighbouring ones. For a band the largest possible
   symmetric difference ``d`` is known; hash space is cut into more than ``d``
   buckets, so linked sets agree on at least one bucket. A set sends one key per
   bucket (a hash of the bucket's members), for its own band and the next.
   Equal keys are candidates. (Agreement on empty buckets says nothing; a set
   with so many empty buckets that only those might agree sends keys for them.)
3. *Candidate groups* are the connected components of "same key", linked as stars
   to the smallest class of a key, never as pairs.
4. *Tiles.* A group goes to one tile; a group too large for a tile is cut by size
   band and salt into cells, and every pair of neighbouring cells is a tile.
   First only parity bitmaps of the hashes go there: each differing bit needs a
   differing shingle, so the bit count bounds the overlap from above. A tile
   returns a spanning forest of the pairs that survive, linear in its sets; their
   components are finer groups, close to the true ones.
5. *Exact tiles.* Only now whole sets go to the tiles of the finer groups. Pairs
   that survive the bitmaps and are not yet connected in the tile are
   intersected; a tile returns a spanning forest of its true links.
6. *Components* of those links.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from recordflow.llm.common import Stages, bounded, groups, unused
from recordflow.llm.components import connected_components
from recordflow.llm.shingles import mix, set_digest, text_sets

#: Shingles of one cell of a tile; a tile holds at most two cells (32 MB of hashes).
CELL_SHINGLES = 2_000_000
#: The least weight of a row, so that a cell holds some thousand rows at most.
ROW_WEIGHT = 512
_TILE = ["grp", "a", "b"]
_EMPTY = np.uint64(0xD6E8FEB86659FD93)
_P, _Q = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


# -- size bands ----------------------------------------------------------------


@lru_cache(maxsize=4096)
def band_limits(percent: int, largest: int) -> list[int]:
    """Smallest sizes of the bands: with ``x >= percent% of y``, x lies in y's band or the one before."""
    limits = [1]
    while len(limits) < 4 or limits[-3] <= largest:
        limits.append(max(limits[-1] + 1, -(-limits[-1] * 100 // percent)))
    return limits


def most_different(size: int, upper: int, percent: int) -> int:
    """Largest symmetric difference of a linked pair that holds a set of ``size`` and lies below ``upper``."""
    return (size + min(upper, size * 100 // percent)) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def bucket_count(lower: int, upper: int, percent: int) -> int:
    """Buckets for sets of ``lower`` to ``upper`` shingles: more than any difference plus the usual empty ones."""
    sizes = sorted({lower, max(lower, upper * percent // 100), upper})
    count = 1 + max(most_different(s, upper, percent) for s in sizes)
    if count == 1:
        return 1
    while True:
        empty = [count * np.exp(-s / count) for s in sizes]
        need = max(most_different(s, upper, percent) + 2 + e + 4 * e**0.5 for s, e in zip(sizes, empty))
        if count >= need or count >= upper:
            return count
        count += 1


def band_keys(items: np.ndarray, band: int, lower: int, upper: int, percent: int) -> np.ndarray:
    """Bucket keys of one set in one band."""
    count = bucket_count(lower, upper, percent)
    tag = mix(np.array([band + 1], np.uint64) * _Q)
    bucket = ((items >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
    starts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1))
    content = np.add.reduceat(mix(items), starts)
    keys = mix(mix(content ^ tag) + bucket[starts] * _P)
    if count - len(starts) > count - 1 - most_different(len(items), upper, percent):
        void = np.setdiff1d(np.arange(count, dtype=np.uint64), bucket[starts])
        keys = np.concatenate((keys, mix(mix(tag ^ _EMPTY) + void * _P)))
    return keys


def candidate_keys(items: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set in its own size band and the next; linked sets share at least one."""
    n = len(items)
    limits = band_limits(percent, 1 << n.bit_length())
    band = bisect_right(limits, n) - 1
    both = [band_keys(items, b, limits[max(b - 1, 0)], limits[b + 1] - 1, percent) for b in (band, band + 1)]
    return np.concatenate(both)


# -- tiles ---------------------------------------------------------------------


def bitmap(items: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the number of hashes at each of ``bits`` positions."""
    odd = np.bincount((items & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def own_bitmap(items: np.ndarray) -> np.ndarray:
    return bitmap(items, width(len(items)))


def width(size: int) -> int:
    """Bits for sets of a size: at least two a shingle, 2 KB at most."""
    return min(1 << 14, max(256, 1 << int(2 * size - 1).bit_length()))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Members that two sorted arrays share."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int(np.count_nonzero(b[at] == a))


def tile_links(sets: list[np.ndarray], left: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the true links among ``sets`` (indices).

    ``left`` splits the tile: None links within all sets, else only pairs of a
    left and a right set are looked at.
    """
    return spanning_links([len(s) for s in sets], [own_bitmap(s) for s in sets], sets, left, percent)


def spanning_links(sizes, bitmaps: list[np.ndarray], sets: list[np.ndarray] | None, left: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that the bitmaps let through, or, with ``sets``, of the true links."""
    sizes = np.array(sizes)
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    side = None if left is None else left[order]
    widths = np.array([width(int(n)) for n in sizes])
    maps = {w: np.stack([bitmaps[k] for k in order[widths == w]]) for w in np.unique(widths)}
    first = {w: int(np.argmax(widths == w)) for w in maps}
    label = np.arange(len(sizes))
    found = []
    for i in range(len(sizes) - 1):
        stop = int(np.searchsorted(sizes, sizes[i] * 100 // percent, side="right"))
        own = maps[widths[i]][i - first[widths[i]]]
        for w, block in maps.items():
            begin, end = max(i + 1, first[w]), min(stop, first[w] + len(block))
            if begin >= end:
                continue
            near = np.flatnonzero(label[begin:end] != label[i]) + begin
            if side is not None:
                near = near[side[near] != side[i]]
            if not len(near):
                continue
            theirs = block[near - first[w]]
            mine = own
            while theirs.shape[1] > len(mine):  # parity bitmaps fold by exclusive or
                half = theirs.shape[1] // 2
                theirs = theirs[:, :half] ^ theirs[:, half:]
            differing = np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64)
            most = (sizes[near] + sizes[i]) * (100 - percent) // (100 + percent)
            slack = most - differing
            alive = np.flatnonzero(slack >= 0)
            for k in alive[np.argsort(-slack[alive], kind="stable")]:
                j = int(near[k])
                if label[j] == label[i]:
                    continue
                if sets is not None:
                    shared = overlap(sets[order[i]], sets[order[j]])
                    if 100 * shared < percent * (int(sizes[i]) + int(sizes[j]) - shared):
                        continue
                label[label == label[j]] = label[i]
                found.append((int(order[i]), int(order[j])))
    return found


# -- the join ------------------------------------------------------------------


def shingle_classes(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, n_shingles, h1, h2, bits)`` of every row; equal (n, h1, h2) means equal shingle sets."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("bits", pa.binary())])

    def digest(batches):
        for batch in batches:
            rows = [(len(s), *set_digest(s), own_bitmap(s).tobytes() if len(s) else b"") for _, s in text_sets(batch.column(1), size)]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t.type) for c, t in zip(zip(*rows), list(schema)[1:]))], schema=schema)

    return _two(docs).mapInArrow(digest, "doc_id long, n_shingles long, h1 long, h2 long, bits binary")


def class_keys(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Distinct ``(key, h1)`` per task: the bucket keys of every non-empty set."""
    schema = pa.schema([("key", pa.int64()), ("h1", pa.int64())])

    def emit(batches):
        seen = set()
        for batch in batches:
            keys, owners, held = [], [], 0
            for _, items in text_sets(batch.column(1), size):
                if not len(items):
                    continue
                h1 = set_digest(items)[0]
                if h1 in seen:  # a copy within the task
                    continue
                if len(seen) < 200_000:
                    seen.add(h1)
                keys.append(candidate_keys(items, percent))
                owners.append(np.full(len(keys[-1]), h1, np.int64))
                held += len(keys[-1])
                if held >= 200_000:
                    yield _columns(schema, np.concatenate(keys).view(np.int64), np.concatenate(owners))
                    keys, owners, held = [], [], 0
            if held:
                yield _columns(schema, np.concatenate(keys).view(np.int64), np.concatenate(owners))

    return _two(docs).mapInArrow(emit, "key long, h1 long")


def jaccard_components(docs: DataFrame, size: int = 3, percent: int = 90, cell: int = CELL_SHINGLES) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text, ...)``.

    Documents link when 100 * |intersection| >= percent * |union| of their sets
    of distinct ``size``-word shingles. The component id is the smallest doc_id
    reachable by links. Null or empty texts have no shingles and link with
    nothing: each is its own component. Rows that share a doc_id count as one
    document; rows without a doc_id are returned with a null component and link
    with nothing. Other columns are ignored; an empty table gives no rows.
    """
    stages = Stages(docs.sparkSession, "jaccard")
    rows = stages.write(shingle_classes(docs, size), "classes")
    reps = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    reps = stages.write(reps, "reps")
    links = _links(docs, rows, reps, stages, size, percent, cell)
    component = connected_components(links, stages)
    stages.drop(links)
    labelled = reps.join(component, F.col("rep") == F.col("node"), "left").select(
        F.col("n_shingles").alias("n"), F.col("h1").alias("a"), F.col("h2").alias("b"), F.coalesce("component", "rep").alias("component_id")
    )
    same = (F.col("n_shingles") == F.col("n")) & (F.col("h1") == F.col("a")) & (F.col("h2") == F.col("b"))
    known = rows.where("n_shingles > 0").join(labelled, same, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return known.unionByName(alone)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the smallest doc_id.

    All columns stay. Of rows that share a doc_id one stays; rows without a
    doc_id stay.
    """
    stages = Stages(docs.sparkSession, "near-copies")
    found = stages.write(jaccard_components(docs, size, percent), "components")
    key = unused(docs, "other_doc_id")
    gone = stages.write(found.where("component_id != doc_id").select(F.col("doc_id").alias(key)).distinct(), "gone")
    kept = docs.join(bounded(gone, 16 * gone.count()), docs["doc_id"] == F.col(key), "left_anti")
    twice = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(key))
    twice = stages.write(twice, "repeated")
    n = twice.count()
    if not n:
        return kept
    once = kept.join(bounded(twice, 16 * n), kept["doc_id"] == F.col(key), "left_anti")
    again = kept.join(bounded(twice, 16 * n), kept["doc_id"] == F.col(key), "left_semi")
    return once.unionByName(again.dropDuplicates(["doc_id"]))


def _links(docs: DataFrame, rows: DataFrame, reps: DataFrame, stages: Stages, size: int, percent: int, cell: int) -> DataFrame:
    """``(src, dst)``: spanning links between class representatives, exact, as a staged table."""
    # The filter is what the join would add to one side alone; with it both sides share one exchange.
    keys = class_keys(docs, size, percent).where("key IS NOT NULL AND h1 IS NOT NULL").repartition("key")
    shared = keys.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low != high").select("key", "low")
    stars = keys.join(shared, "key").where("h1 != low").select(F.col("h1").alias("src"), F.col("low").alias("dst")).distinct()
    stars = stages.write(stars, "stars")
    group = connected_components(stars, stages)
    stages.drop(stars)
    member = reps.join(group, F.col("h1") == F.col("node")).select(
        F.col("rep").alias("id"), F.col("n_shingles").alias("n"), "h1", "h2", F.col("component").alias("grp")
    )
    member = stages.write(member, "members")
    # A bitmap is an eighth of its set at most (beside the smallest).
    rough = _placed(member, percent, cell, F.greatest(F.col("n") / 8, F.lit(ROW_WEIGHT)))
    bitmaps = rows.where("n_shingles > 0").select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "h1", "h2", "bits")
    rough = rough.join(bitmaps, ["id", "h1", "h2"]).select("id", "n", "bits", F.explode("tiles").alias("t"))
    alike = stages.write(_tiles(_by_tile(rough.select("id", "n", "bits", "t.*")), percent).distinct(), "alike")
    finer = connected_components(alike, stages)
    stages.drop(alike)
    member = member.drop("grp").join(finer, F.col("id") == F.col("node")).withColumnRenamed("component", "grp").drop("node")
    placed = stages.write(_placed(member, percent, cell, F.greatest("n", F.lit(ROW_WEIGHT))), "tiles")
    size_of = placed.agg(F.count("*").alias("rows"), F.sum(F.size("tiles")).alias("tiles")).first()
    near = docs.select("doc_id", "text").join(
        bounded(placed, 48 * size_of["rows"] + 40 * (size_of["tiles"] or 0)), F.col("doc_id") == F.col("id")
    )
    sets = _sets(near.select("id", "text", "h1", "h2", "tiles"), size)
    in_tiles = sets.select("id", "items", F.explode("tiles").alias("t")).select("id", "items", "t.*")
    links = stages.write(_tiles(_by_tile(in_tiles), percent).distinct(), "links")
    stages.drop(placed)
    return links


def _by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition(*_TILE).sortWithinPartitions(*_TILE)


def _placed(member: DataFrame, percent: int, cell: int, weight: Column) -> DataFrame:
    """Members with the tiles they go to: ``tiles`` of (grp, a, b, own cell); a cell weighs ``cell`` at most, about."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent) * 1.0001))
    weighed = member.select("id", "h1", "h2", "grp", band.alias("band"), weight.cast("long").alias("w"))
    whole = weighed.groupBy("grp").agg(F.sum("w").alias("weight"), F.count("*").alias("members")).where("members > 1")
    weighed = weighed.join(whole, "grp")
    small = weighed.where(F.col("weight") <= cell).select(
        "id", "h1", "h2", F.array(F.struct("grp", F.lit(-1).cast("long").alias("a"), F.lit(-1).cast("long").alias("b"), F.lit(-1).cast("long").alias("own"))).alias("tiles")
    )
    large = weighed.where(F.col("weight") > cell)
    cells = large.groupBy("grp", "band").agg(F.ceil(F.sum("w") / F.lit(cell)).alias("cells"))
    # A cell is named by band and salt; salts stay below 2^32.
    partners = cells.select("grp", F.col("band").alias("pband"), F.col("cells").alias("pcells"), F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("o")).select(
        "grp", (F.col("pband") + F.col("o")).alias("band"), "pband", "pcells"
    )
    salted = large.join(cells, ["grp", "band"]).withColumn("own", F.col("band") * (1 << 32) + F.pmod(F.xxhash64("id"), F.col("cells")))
    met = salted.join(partners, ["grp", "band"]).select("id", "h1", "h2", "grp", "own", "pband", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pcells") - 1)).alias("salt"))
    other = F.col("pband") * (1 << 32) + F.col("salt")
    cut = met.groupBy("id", "h1", "h2").agg(
        F.collect_list(F.struct("grp", F.least("own", other).alias("a"), F.greatest("own", other).alias("b"), "own")).alias("tiles")
    )
    return small.unionByName(cut)


_TILES = ArrayType(StructType([StructField(c, LongType()) for c in ("grp", "a", "b", "own")]))


def _sets(near: DataFrame, size: int) -> DataFrame:
    """Shingle sets as bytes; rows of the same doc_id whose set is another one are dropped."""
    out = StructType([StructField("id", LongType()), StructField("items", BinaryType()), StructField("tiles", _TILES)])

    def build(batches):
        for batch in batches:
            digests = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()))
            rows, items, held = [], [], 0
            for row, found in text_sets(batch.column(1), size):
                if set_digest(found) == digests[row]:
                    rows.append(row)
                    items.append(found.tobytes())
                    held += len(items[-1])
                if held > 16 << 20:
                    yield _taken(batch, rows, items)
                    rows, items, held = [], [], 0
            if rows:
                yield _taken(batch, rows, items)

    return near.mapInArrow(build, out)


def _taken(batch: pa.RecordBatch, rows: list[int], items: list[bytes]) -> pa.RecordBatch:
    at = pa.array(rows, pa.int64())
    return pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(items, pa.binary()), batch.column(4).take(at)], names=["id", "items", "tiles"])


def _tiles(sets: DataFrame, percent: int) -> DataFrame:
    """Spanning links of every tile: of true links for rows with ``items``, of what bitmaps let through for rows with ``bits``."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def compare(batches):
        for (_, a, b), tile in groups(batches, ["grp", "a", "b"]):
            ids = tile.column("id").to_pylist()
            whole = "items" in tile.column_names
            items = [np.frombuffer(x.as_buffer(), np.uint64) for chunk in tile.column("items" if whole else "bits").chunks for x in chunk]
            left = None if a == b else np.array(tile.column("own").to_pylist()) == a
            links = tile_links(items, left, percent) if whole else spanning_links(tile.column("n").to_pylist(), items, None, left, percent)
            if links:
                yield _columns(schema, *(np.array([ids[pair[k]] for pair in links], np.int64) for k in (0, 1)))

    return sets.mapInArrow(compare, "src long, dst long")


def _two(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _columns(schema: pa.Schema, *arrays: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], schema=schema)
