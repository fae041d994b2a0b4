"""Near-duplicate groups by a chosen-path set similarity join.

1. Sets. A text gives the set of its word shingles, as 64-bit hashes. Documents with equal sets are one
   class and go on as one member. A class has ``TREES`` root tokens (minwise hashes of their own) and a
   signature of ``COORDINATES`` further minwise tokens.
2. Trees. Every tree branches the classes by its root token. A node with more than ``NODE`` members is
   branched again by ``BRANCHES`` signature tokens that its path chooses, up to ``DEPTH`` levels; small
   nodes are compared exhaustively, first by one bit of each coordinate, so that members without a
   likely partner leave before the signatures are fetched, then by signature. Nodes that are still large at the last level are
   compared whole, block against block. Two classes at the threshold s share a small node of one tree
   with probability s * (1 - (1 - s)^BRANCHES)^(levels below), so that ``TREES`` independent trees miss
   at most 2.5e-7 of the links at s = 0.8. All trees share one signature; its two filters lose a further
   3.4e-8 there, so that fewer than one link in a million is missed (1e-8 and 8.1e-8 at s = 0.85).
3. Candidates. Pairs whose signatures agree as far as s allows, less six standard deviations, are
   linked, as stars per node; the components of these links are the candidate groups.
4. Confirmation. Each candidate group gets the full sets of its members, once, and all its pairs are
   confirmed by exact intersection and union, whatever their signatures; pairs that are connected already are skipped. Groups of
   more than ``GROUP_SHINGLES`` are confirmed block against block. Components of the confirmed links
   are the result.

No pair lists of groups are made: every step hands on stars, so rows grow with members. Shuffles
carry hashes, never texts.

Defined results: a null text, or one without words, has an empty set and is linked with nothing; a text
with fewer words than a shingle has its whole sequence as its one shingle; component_id is the smallest
non-null doc_id of the component and null if there is none; rows with equal doc_id keep their own sets;
an empty table gives no rows; extra columns are ignored by ``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenamart.llm.common import contiguous, read, stored
from arenamart.llm.components import components

TREES = 10
COORDINATES = 128
NODE = 2_000
BRANCHES = 3
DEPTH = 3
#: Standard deviations below the expected agreement at the threshold where the signature filters begin.
DEVIATIONS = 6
GROUP_SHINGLES = 2_000_000
#: Ids of candidates in one broadcast: below 100 MB.
BROADCAST_IDS = 2_000_000

_SEEDS = np.random.default_rng(20240229).integers(1, 2**63, (2, TREES + COORDINATES), dtype=np.int64).astype(np.uint64)
_XOR, _ODD = _SEEDS[0], _SEEDS[1] | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; A-Z lower-cased, words end at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(out)])
    return np.unique(out)


def minwise(found: np.ndarray) -> np.ndarray:
    """All root tokens, then the signature, of a set that is not empty."""
    least = np.full(TREES + COORDINATES, np.iinfo(np.uint64).max)
    for at in range(0, len(found), 4096):
        part = mix(found[at : at + 4096])
        least = np.minimum(least, ((part[:, None] ^ _XOR) * _ODD).min(axis=0))
    return least


def class_of(found: np.ndarray) -> bytes:
    """128 bits of a set."""
    with np.errstate(over="ignore"):
        a, b = mix(found).sum(dtype=np.uint64), mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return mix(np.array([a + np.uint64(len(found)), b], np.uint64)).tobytes()


def _sketch(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                sizes, names, roots, bits, signs = [], [], [], [], []
                for text in batch.column("text").to_pylist():
                    found = shingles(text, size)
                    sizes.append(len(found))
                    tokens = minwise(found) if len(found) else None
                    names.append(None if tokens is None else class_of(found))
                    roots.append(None if tokens is None else tokens[:TREES].astype(np.int64))
                    sign = None if tokens is None else (tokens[TREES:] >> np.uint64(48)).astype("<u2")
                    bits.append(None if sign is None else np.packbits(sign & 1).tobytes())
                    signs.append(None if sign is None else sign.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text_hash"),
                        pa.array(sizes, pa.int64()),
                        pa.array(names, pa.binary()),
                        pa.array(roots, pa.list_(pa.int64())),
                        pa.array(bits, pa.binary()),
                        pa.array(signs, pa.binary()),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "class", "roots", "bits", "sign"],
                )

    return run


def sketches(docs: DataFrame, size: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = f"doc_id {kind}, text_hash bigint, n_shingles bigint, class binary, roots array<bigint>, bits binary, sign binary"
    return stored(rows.mapInArrow(_sketch(size), schema), "sketches")


class Forest:
    """Which members of one group are connected already."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)

    def stars(self, names: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Every member of a component with its smallest name: stars, which settle in few rounds."""
        roots = [self.root(i) for i in range(len(names))]
        least: dict[int, bytes] = {}
        for name, root in zip(names, roots, strict=True):
            least[root] = min(name, least.get(root, name))
        return [(name, least[root]) for name, root in zip(names, roots, strict=True) if name != least[root]]


def _batched(stars: Iterator[list[tuple[bytes, bytes]]], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of many small groups in batches of about ``rows``."""
    held: list[tuple[bytes, bytes]] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in held], pa.binary()) for k in (0, 1)], ["a", "b"])

    for pairs in stars:
        held += pairs
        if len(held) >= rows:
            yield batch()
            held = []
    if held:
        yield batch()


def least_agreement(percent: int) -> int:
    """Coordinates that two sets at the threshold share, less ``DEVIATIONS``."""
    s = percent / 100
    return int(COORDINATES * s - DEVIATIONS * (COORDINATES * s * (1 - s)) ** 0.5)


def _sized(sizes: np.ndarray, i: int, percent: int) -> np.ndarray:
    """Which later members may reach the threshold with member i by size."""
    return 100 * np.minimum(sizes[i], sizes[i + 1 :]) >= percent * np.maximum(sizes[i], sizes[i + 1 :])


def _alike(signs: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each member the later members that may reach the threshold by signature and size."""
    least = least_agreement(percent)
    for i in range(len(signs) - 1):
        later = np.flatnonzero(_sized(sizes, i, percent)) + i + 1
        if len(later):
            later = later[np.count_nonzero(signs[later] == signs[i], axis=1) >= least]
            if len(later):
                yield i, later


def _members(group: list[pa.RecordBatch]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct classes of a group, their set sizes and signatures."""
    rows = {c: (n, s) for b in group for c, n, s in zip(*(b.column(k).to_pylist() for k in ("class", "n_shingles", "sign")), strict=True)}
    sizes = np.array([n for n, _ in rows.values()], np.int64)
    signs = np.frombuffer(b"".join(s for _, s in rows.values()), "<u2").reshape(len(rows), COORDINATES)
    return list(rows), sizes, signs


def least_equal_bits(percent: int) -> int:
    """As ``least_agreement`` for one bit of each coordinate; half of unequal coordinates agree in it."""
    s = (1 + percent / 100) / 2
    return int(COORDINATES * s - DEVIATIONS * (COORDINATES * s * (1 - s)) ** 0.5)


def _likely(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Members of each node that have a partner by their bits (rows sorted by node)."""
    most = COORDINATES - least_equal_bits(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []

        def batch() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([h[k] for h in held], t) for k, t in enumerate(kinds)], ["node", "block", "class"])

        for group in contiguous(batches, ["node", "block"]):
            names = [c for b in group for c in b.column("class").to_pylist()]
            bits = np.frombuffer(b"".join(x for b in group for x in b.column("bits").to_pylist()), "<u8").reshape(len(names), -1)
            paired = np.zeros(len(names), bool)
            for i in range(len(names) - 1):
                near = np.bitwise_count(bits[i + 1 :] ^ bits[i]).sum(axis=1) <= most
                paired[i] |= near.any()
                paired[i + 1 :] |= near
            node, block = group[0].column("node")[0].as_py(), group[0].column("block")[0].as_py()
            held += [(node, block, names[i]) for i in np.flatnonzero(paired)]
            if len(held) >= 20_000:
                yield batch()
                held = []
        if held:
            yield batch()

    return run


def _compare_signs(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spanning links of each node (rows sorted by node)."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, bytes]]]:
        for group in contiguous(batches, ["node", "block"]):
            names, sizes, signs = _members(group)
            forest = Forest(len(names))
            for i, later in _alike(signs, sizes, percent):
                for j in map(int, later):
                    forest.join(i, j)
            yield forest.stars(names)

    return lambda batches: _batched(stars(batches))


def _blocks(rows: DataFrame, key: str, parts: F.Column) -> DataFrame:
    """Rows of an oversized group, once for each pair of blocks that their own block is part of."""
    own = F.pmod(F.xxhash64("class"), parts)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))
    spread = rows.withColumn("_parts", parts).withColumn("_own", own).withColumn("_other", other)
    pair = F.least("_own", "_other") * F.col("_parts") + F.greatest("_own", "_other")
    return spread.withColumn("block", pair).drop("_parts", "_own", "_other")


def candidate_links(classes: DataFrame, percent: int) -> DataFrame:
    """Spanning links (a, b) of the tree nodes, by signature."""
    roots = F.posexplode("roots").alias("tree", "token")
    rows = classes.select("class", "bits", roots).select("class", "bits", F.xxhash64("tree", "token").alias("node"))
    rows = stored(rows, "tree-roots")
    signs = classes.select("class", "n_shingles", "sign")
    links, level = [], 0
    while True:
        counts = rows.groupBy("node").agg(F.count("*").alias("_n")).where("_n > 1")
        counted = stored(rows.join(counts, "node"), "tree-nodes")
        small = counted.where(F.col("_n") <= NODE).select("class", "bits", "node", F.lit(0).cast("bigint").alias("block"))
        large = counted.where(F.col("_n") > NODE)
        last = level == DEPTH
        if last:
            small = small.union(_blocks(large, "node", F.ceil(F.col("_n") / NODE)).select("class", "bits", "node", "block"))
        dealt = small.repartition("node", "block").sortWithinPartitions("node", "block")
        likely = stored(dealt.mapInArrow(_likely(percent), "node bigint, block bigint, class binary"), "tree-likely")
        dealt = likely.join(signs, "class").repartition("node", "block").sortWithinPartitions("node", "block")
        links.append(dealt.mapInArrow(_compare_signs(percent), "a binary, b binary"))
        if last or large.isEmpty():
            break
        level += 1
        # The path, that is the node, chooses the coordinates; the token there names the branch.
        chosen = [F.pmod(F.xxhash64("node", F.lit(k)), F.lit(COORDINATES)).cast("int") for k in range(BRANCHES)]
        tokens = [F.xxhash64("node", c, F.substring("sign", 2 * c + 1, F.lit(2))) for c in chosen]
        rows = stored(large.join(signs, "class").select("class", "bits", F.explode(F.array(*tokens)).alias("node")), "tree-branches")
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _with_sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                found = [shingles(t, size) for t in whole.slice(start, 256).column("text").to_pylist()]
                found = [f for f in found if len(f)]
                arrays = [pa.array(map(class_of, found), pa.binary()), pa.array([f.tobytes() for f in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["class", "hashes"])

    return run


def _confirm(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spanning confirmed links of each candidate group, or pair of its blocks (rows sorted by group)."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, bytes]]]:
        for group in contiguous(batches, ["root", "block"]):
            named = {c: n for b in group for c, n in zip(*(b.column(k).to_pylist() for k in ("class", "n_shingles")), strict=True)}
            names, sizes = list(named), np.array(list(named.values()), np.int64)
            sets = {c: h for b in group for c, h in zip(b.column("class").to_pylist(), b.column("hashes").to_pylist(), strict=True)}
            full = [frozenset(np.frombuffer(sets.pop(c), np.uint64).tolist()) for c in names]
            forest = Forest(len(names))
            for i in range(len(names) - 1):
                for j in map(int, np.flatnonzero(_sized(sizes, i, percent)) + i + 1):
                    if forest.root(i) != forest.root(j):
                        both = len(full[i] & full[j])
                        if 100 * both >= percent * (len(full[i]) + len(full[j]) - both):
                            forest.join(i, j)
            yield forest.stars(names)

    return lambda batches: _batched(stars(batches))


def grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, class, root class of the group and component_id of every row."""
    rows = sketches(docs, size)
    classes = rows.where("class is not null").groupBy("class").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"), F.first("roots").alias("roots"), F.first("bits").alias("bits"), F.first("sign").alias("sign")
    )
    classes = stored(classes, "classes")
    groups = components(candidate_links(classes, percent)).select(F.col("node").alias("class"), "root")
    members = stored(groups.join(classes.select("class", "first_id", "n_shingles"), "class"), "candidates")
    # One document of each member class gives the set again; its class tells which set that is.
    # Up to the bound their ids are broadcast, so that no text is shuffled; beyond it both sides are.
    ids = members.select(F.col("first_id")).distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    chosen = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    sets = chosen.select("text").mapInArrow(_with_sets(size), "class binary, hashes binary")
    weight = members.groupBy("root").agg(F.sum("n_shingles").alias("_w"))
    members = members.join(weight, "root").withColumn("_parts", F.ceil(F.col("_w") / GROUP_SHINGLES))
    placed = _blocks(members, "root", F.col("_parts")).select("root", "block", "class", "n_shingles")
    dealt = placed.join(sets, "class").repartition("root", "block").sortWithinPartitions("root", "block")
    links = dealt.mapInArrow(_confirm(percent), "a binary, b binary")
    linked = components(links).select(F.col("node").alias("class"), "root")
    roots = linked.join(classes.select("class", "first_id"), "class")
    least = roots.groupBy("root").agg(F.min("first_id").alias("_least"))
    ends = roots.join(least, "root").select("class", "root", "_least")
    ends = classes.select("class", "first_id").join(ends, "class", "left")
    ends = ends.select("class", F.coalesce("root", "class").alias("group"), F.coalesce("_least", "first_id").alias("_component"))
    joined = rows.select("doc_id", "text_hash", "n_shingles", "class").join(ends, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("_component"))
    return joined.select("doc_id", "text_hash", "n_shingles", "class", "group", component.alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document row."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return grouped(docs, size, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with its own columns: the one with the smallest id.

    Documents without words are linked with nothing and all stay. Where several rows carry the smallest
    id, one of them stays.
    """
    found = stored(grouped(docs, size, percent).where(F.col("class").isNotNull()), "near-groups")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    stay = found.where(first).groupBy("group").agg(F.min("text_hash").alias("_stays"))
    gone = found.join(stay, "group").where(~first | (F.col("text_hash") != F.col("_stays")))
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    # Equal rows are rare; only they are dealt out by id.
    equal = found.groupBy("doc_id", "text_hash").agg(F.count("*").alias("_n")).where("_n > 1")
    equal = equal.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
    left = docs.select("doc_id", "text", F.struct("*").alias("_row")).join(gone, same, "left_anti")
    once = left.join(equal, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(equal, same, "left_anti").union(once).select("_row.*")


def op2_near_dup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), size=3, percent=85)
