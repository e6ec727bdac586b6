"""Near-duplicate join: word shingles, MinHash candidates pruned by Bayes, exact check.

1. Every text becomes a set of 64-bit hashes of its five-word shingles (a text
   of fewer words is one shingle). Texts with equal sets form one class, counted
   before anything else moves, so copies cost one row.
2. ``HASHES`` MinHash values are grouped into ``BANDS``; classes that agree on a
   whole band are candidates. A pair at similarity 0.8 shares none of the 32
   bands of 4 with probability (1 - 0.8^4)^32 < 5e-8.
3. Candidates compare their MinHash values block by block; after each block a
   pair is dropped when the posterior probability that its similarity reaches
   the threshold, given the matches so far, is below ``TOLERANCE``. What is left
   links classes into groups. Every class is compared with the least one of each
   of its buckets first; pairs that are in one group then are not compared again,
   so a bucket that is one group costs a row for each member.
4. Inside a group links are counted exactly on the full sets, and each class gets
   its number of links: groups of up to ``GROUP_BLOCK`` classes pair by pair, larger
   ones through their common core (see ``large_links``).
5. Classes linked by verified pairs are one component; its least id is the
   documents' class id.

What is left of large buckets, and of the pairs of a large group that its core does
not decide, is cut into blocks of bounded size and each pair of blocks is a task of
its own; tasks return counts and a spanning forest, never the pairs. There is no
cap: every pair of blocks is worked.

Words are runs of bytes other than ASCII white space, with A-Z lower-cased.
Defined results: a text that is null or has no word is similar to nothing: its
class id is its own id, with no links; repeated rows are copies of each other
and count as links; an empty table gives no rows; other columns are ignored. Every
text is read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import arrow_schema, field, map_batches, record_batch, settle

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
#: MinHash values are compared this many at a time.
COMPARE_STEP = 16
TOLERANCE = 1e-6
#: Classes of one block of a bucket; most classes of a group that is verified pair by
#: pair, and of one block of what is left of a larger one.
BUCKET_BLOCK, GROUP_BLOCK = 512, 256
#: Words whose hash a task keeps.
WORD_CACHE = 400_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


class Shingler:
    """Sorted distinct shingle hashes of a text."""

    def __init__(self, n: int = SHINGLE_WORDS):
        self.n, self.known = n, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > WORD_CACHE:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        hashes = np.array([known[w] for w in words], np.uint64)
        wide = max(1, len(words) - self.n + 1)
        mixed = np.full(wide, min(self.n, len(words)), np.uint64)
        for i in range(min(self.n, len(words))):
            mixed = (mixed ^ hashes[i:i + wide]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


@lru_cache(1)
def hash_family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_229)
    mask = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
    factor = rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return mask, factor


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """HASHES values of 32 bits."""
    mask, factor = hash_family()
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        part = shingles[at:at + 512, None] ^ mask
        part *= factor
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint64)


def band_keys(values: np.ndarray) -> np.ndarray:
    rows = values.reshape(BANDS, BAND_ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _PAIR
    for i in range(BAND_ROWS):
        key = (key ^ rows[:, i]) * _MIX
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


@lru_cache(8)
def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """For each number of compared values (multiples of COMPARE_STEP), the least
    matches with posterior P(similarity >= threshold) >= tolerance.

    Values are compared by one byte, so two unequal ones match with chance 1/256;
    the prior of the similarity is uniform."""
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    out = []
    for seen in range(COMPARE_STEP, HASHES + 1, COMPARE_STEP):
        for matches in range(seen + 1):
            log = matches * np.log(p) + (seen - matches) * np.log1p(-p)
            weight = np.exp(log - log.max())
            if weight[s >= threshold].sum() >= tolerance * weight.sum():
                out.append(matches)
                break
    return tuple(out)


def survivors(signatures: np.ndarray, one: np.ndarray, two: np.ndarray,
              least: tuple[int, ...]) -> np.ndarray:
    """Positions of the pairs (one[k], two[k]) that no block of values drops."""
    left, matches = np.arange(len(one)), np.zeros(len(one), np.int32)
    for step, need in enumerate(least):
        cut = slice(step * COMPARE_STEP, (step + 1) * COMPARE_STEP)
        matches += (signatures[one[left], cut] == signatures[two[left], cut]).sum(axis=1, dtype=np.int32)
        stay = matches >= need
        left, matches = left[stay], matches[stay]
        if not len(left):
            break
    return left


def flattened(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def unite(parent: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Roots (least positions) after linking one[k] with two[k]."""
    while len(one):
        a, b = parent[one], parent[two]
        apart = a != b
        one, two, a, b = one[apart], two[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        parent = flattened(parent)
    return parent


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, set_id, n, bands, signature) of every row, settled. ``set_id``
    names the shingle set, null where there is no word."""
    ddl = f"id {field(docs, id_col)}, text_key string, set_id binary, n int, bands array<bigint>, signature binary"

    def make():
        shingle = Shingler()

        def step(batch: pa.RecordBatch) -> dict:
            sets, sizes, bands, signatures = [], [], [], []
            for text in batch["text"].to_pylist():
                s = shingle(text)
                sizes.append(len(s))
                if not len(s):
                    sets.append(None), bands.append(None), signatures.append(None)
                    continue
                values = min_hashes(s)
                sets.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(band_keys(values))
                signatures.append(values.astype(np.uint8).tobytes())
            return {"id": batch["id"], "text_key": batch["text_key"], "set_id": sets, "n": sizes,
                    "bands": bands, "signature": signatures}
        return step

    rows = docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
                       F.col(text_col).alias("text"))
    return settle(map_batches(rows, make, ddl), "sketch")


def blocked(members: DataFrame, size: str, block: int) -> DataFrame:
    """Every member of a group once for each pair of blocks that its block is in:
    columns ``low``, ``high`` name the pair, ``block`` the member's own."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return (members.withColumn("blocks", F.ceil(F.col(size) / block).cast("int"))
            .withColumn("block", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
            .drop("blocks", "other", size))


def star_links(keys: DataFrame, payload: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Edges of classes with the least class of a bucket, where the pair survives."""
    heads = keys.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("size")).where("size > 1")
    pairs = keys.join(heads, "key").where("node <> head").select("node", "head").distinct()
    of_head = payload.select(F.col("node").alias("head"), F.col("n").alias("head_n"), F.col("signature").alias("head_signature"))
    rows = (pairs.join(payload, "node").join(of_head, "head")
            .where(F.least("n", "head_n") >= F.lit(threshold) * F.greatest("n", "head_n")))
    least = least_matches(threshold, tolerance)

    def step(batch: pa.RecordBatch) -> dict:
        both = b"".join(batch["signature"].to_pylist() + batch["head_signature"].to_pylist())
        signatures, m = np.frombuffer(both, np.uint8).reshape(-1, HASHES), batch.num_rows
        at = pa.array(survivors(signatures, np.arange(m), np.arange(m) + m, least))
        return {"u": batch["node"].take(at), "v": batch["head"].take(at)}

    return map_batches(rows.select("node", "head", "signature", "head_signature"), lambda: step, "u bigint, v bigint")


def candidate_links(classes: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                    block: int = BUCKET_BLOCK) -> DataFrame:
    """Edges (u > v) that span the classes whose pairs survive the pruning: those
    with the least class of a bucket, then those of what is in one bucket but not yet
    in one group."""
    keys = classes.select("node", F.explode("bands").alias("key"))
    payload = classes.select("node", "n", "signature")
    stars = settle(star_links(keys, payload, threshold, tolerance), "stars")
    grouped = (keys.join(components(stars).select("node", F.col("label").alias("star")), "node", "left")
               .withColumn("star", F.coalesce("star", "node")))
    mixed = (grouped.groupBy("key").agg(F.count("*").alias("size"), F.min("star").alias("low"), F.max("star").alias("high"))
             .where("low < high").select("key", "size"))
    members = grouped.join(mixed, "key")
    spread = blocked(members, "size", block)
    rows = (spread.join(payload, "node").repartition("key", "low", "high")
            .sortWithinPartitions("key", "low", "high", "node")
            .select("key", "low", "high", "block", "node", "star", "n", "signature"))
    least = least_matches(threshold, tolerance)
    schema = arrow_schema("u bigint, v bigint")

    def links(part: pa.Table) -> pa.RecordBatch | None:
        """Of whole buckets, sorted: rows d apart in one bucket are compared for
        d = 1, 2, ... until no bucket is that long."""
        number = _runs(part)
        own = part["block"].to_numpy()
        cross = part["low"].to_numpy() != part["high"].to_numpy()
        size = part["n"].to_numpy()
        signatures = np.frombuffer(b"".join(part["signature"].to_pylist()), np.uint8).reshape(-1, HASHES)
        # Rows of one bucket that are in one group already have one root.
        order = np.lexsort((np.arange(len(number)), part["star"].to_numpy(), number))
        star = part["star"].to_numpy()[order]
        first = np.concatenate([[True], (star[1:] != star[:-1]) | (number[order][1:] != number[order][:-1])])
        parent, rows_left = np.empty(len(number), np.int64), np.arange(len(number))
        parent[order] = order[np.flatnonzero(first)][np.cumsum(first) - 1]
        joined = parent.copy()
        d = 1
        while True:
            rows_left = rows_left[rows_left + d < len(number)]
            rows_left = rows_left[number[rows_left] == number[rows_left + d]]
            if not len(rows_left):
                break
            one, two = rows_left, rows_left + d
            small, large = np.minimum(size[one], size[two]), np.maximum(size[one], size[two])
            fit = ((parent[one] != parent[two]) & (small >= threshold * large)
                   & (~cross[one] | (own[one] != own[two])))
            one, two = one[fit], two[fit]
            left = survivors(signatures, one, two, least)
            parent = unite(parent, one[left], two[left])
            d += 1
        at = np.flatnonzero(parent != joined)
        node = part["node"].to_numpy()
        if not len(at):
            return None
        return record_batch({"u": node[at], "v": node[parent[at]]}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            number = _runs(held)
            last = int(np.searchsorted(number, number[-1]))   # the last bucket may go on
            if last:
                found = links(held.slice(0, last).combine_chunks())
                if found is not None:
                    yield found
                held = held.slice(last)
        if held is not None and held.num_rows:
            found = links(held.combine_chunks())
            if found is not None:
                yield found

    return rows.mapInArrow(run, "u bigint, v bigint").unionByName(stars)


def _runs(part: pa.Table) -> np.ndarray:
    """Numbers of the runs of equal (key, low, high)."""
    change = np.zeros(part.num_rows, np.int64)
    for c in ("key", "low", "high"):
        x = part[c].to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.cumsum(change)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the edges (u, v): the least node of each
    connected component. Alternating large and small stars, until every node has
    one edge, to a node that has none.

    The node of a large star has as many edges as its component has nodes. Its
    least neighbour is an aggregate, settled before the edges meet it, so that
    this join has its own exchanges and adaptive execution can split the node."""
    edges = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = settle(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .distinct(), "large")
        near = settle(large.groupBy("u").agg(F.min("v").alias("m")), "near")
        small = (large.join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(near.select("u", F.col("m").alias("v"))))
        edges = settle(small.where("u <> v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    nodes = edges.groupBy("u").agg(F.count("*").alias("n"))
    centres = edges.select(F.col("v").alias("u")).distinct()
    return nodes.where("n > 1").isEmpty() and nodes.join(centres, "u", "leftsemi").isEmpty()


def verified_links(members: DataFrame, threshold: float = THRESHOLD, block: int | None = None) -> DataFrame:
    """From (node, copies, label, size, shingles): (node, links, root), one row or
    more per class. Exact: intersections are counted on the sets."""
    block = block or GROUP_BLOCK
    ddl = "node bigint, links bigint, root bigint"

    def verify(part: pa.Table) -> pa.Table:
        part = part.sort_by("node")
        sets = [np.frombuffer(b, np.uint64) for b in part["shingles"].to_pylist()]
        return linked_rows(part, similar(sets, threshold))

    small = members.where(F.col("size") <= block).groupBy("label").applyInArrow(verify, ddl)
    large = members.where(F.col("size") > block)
    return small if large.isEmpty() else small.unionByName(large_links(large, threshold, block))


def linked_rows(part: pa.Table, linked: np.ndarray) -> pa.Table:
    """(node, links, root) from the matrix of linked pairs."""
    node, copies = part["node"].to_numpy(), part["copies"].to_numpy().astype(np.int64)
    root = unite(np.arange(len(node)), *np.nonzero(linked))
    return pa.table({"node": node, "links": (linked @ copies).astype(np.int64), "root": node[root]})


def large_links(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """The links of large groups, most of them without looking at pairs.

    A group's core are the shingles that more than half of its sets hold; D(x) is
    the symmetric difference of x and the core. For a threshold p/q two sets are
    linked exactly if (q + p) |x ^ y| <= (q - p) (|x| + |y|), and as |x ^ y| =
    |D(x)| + |D(y)| - 2 |D(x) & D(y)|, if

        far(x) + far(y) <= 2 (q + p) |D(x) & D(y)|,   far(x) = (q + p) |D(x)| - (q - p) |x|.

    Pairs with far(x) + far(y) <= 0 are linked whatever their intersection: a class
    has as many as there are classes up to -far(x) in its group, a running sum over
    the values of far; and all classes with such a link have one with the class that
    is least in far. Other pairs are linked only if they share something that the
    core does not explain: of the classes that can be in such a pair, only what two
    or more of their D hold is kept, and those with something left are compared in
    pairs of blocks."""
    ratio = Fraction(threshold).limit_denominator(10_000)
    up, down = ratio.denominator + ratio.numerator, ratio.denominator - ratio.numerator

    def as_set(batch: pa.RecordBatch) -> dict:
        return {**{c: batch[c] for c in ("node", "copies", "label", "size")},
                "held": [np.frombuffer(b, np.int64) for b in batch["shingles"].to_pylist()]}

    sets = settle(map_batches(members.select("node", "copies", "label", "size", "shingles"), lambda: as_set,
                              "node bigint, copies bigint, label bigint, size bigint, held array<bigint>"), "large")
    core = (sets.select("label", "size", F.explode("held").alias("s")).groupBy("label", "size", "s").count()
            .where("2 * count > size").groupBy("label").agg(F.collect_list("s").alias("core")))
    none = F.array().cast("array<bigint>")
    against = sets.join(core, "label", "left").withColumn("core", F.coalesce("core", none))
    apart = F.concat(F.array_except("held", "core"), F.array_except("core", "held"))
    rows = settle(against.select("label", "node", "copies", F.size("held").alias("n"), apart.alias("apart"))
                  .withColumn("far", (F.lit(up) * F.size("apart") - F.lit(down) * F.col("n")).cast("bigint"))
                  .select("label", "node", "copies", "far", "apart"), "apart")
    ends = rows.groupBy("label").agg(F.min(F.struct("far", "node")).alias("least"), F.max("far").alias("most"))
    counts = rows.groupBy("label", "far").agg(F.sum("copies").alias("copies"))
    asked = counts.select("label", (-F.col("far")).alias("at"), F.lit(0).cast("bigint").alias("copies"), "far")
    upto = Window.partitionBy("label").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    found = (asked.unionByName(counts.select("label", F.col("far").alias("at"), "copies", F.lit(None).cast("bigint").alias("far")))
             .withColumn("near", F.sum("copies").over(upto)).where("far IS NOT NULL")
             .join(ends, "label").select("label", "far", "near", "least"))
    own = F.when(F.col("far") <= 0, F.col("copies")).otherwise(F.lit(0))
    near = rows.drop("apart").join(found, ["label", "far"]).select(
        "node", (F.col("near") - own).alias("links"),
        F.when(F.col("far") + F.col("least.far") <= 0, F.col("least.node")).otherwise(F.col("node")).alias("root"))

    open_ = rows.join(ends.select("label", "most"), "label").where("far + most > 0")
    items = open_.select("label", "node", F.explode("apart").alias("s"))
    shared = items.groupBy("label", "s").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    left = items.join(shared, ["label", "s"]).groupBy("label", "node").agg(F.collect_list("s").alias("items"))
    left = settle(left.join(open_.select("label", "node", "copies", "far"), ["label", "node"]), "left")
    sizes = left.groupBy("label").agg(F.count("*").alias("size"))
    spread = blocked(left.join(sizes, "label"), "size", block)

    def verify(part: pa.Table) -> pa.Table:
        part = part.sort_by("node")
        far, own = part["far"].to_numpy(), part["block"].to_numpy()
        both = far[:, None] + far[None, :]
        common = intersections([np.array(x, np.int64) for x in part["items"].to_pylist()])
        linked = (both > 0) & (both <= 2 * up * common)
        np.fill_diagonal(linked, False)
        if part["low"][0].as_py() != part["high"][0].as_py():
            linked &= own[:, None] != own[None, :]
        return linked_rows(part, linked)

    return near.unionByName(spread.groupBy("label", "low", "high").applyInArrow(verify, "node bigint, links bigint, root bigint"))


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Matrix of the pairs of different sets with Jaccard similarity >= threshold."""
    sizes, common = np.array([len(s) for s in sets], np.int64), intersections(sets)
    both = sizes[:, None] + sizes[None, :] - common
    linked = common >= threshold * both - 1e-9
    np.fill_diagonal(linked, False)
    return linked


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of the intersections of any two sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, held = np.unique(values, return_inverse=True, return_counts=True)
    shared = held[column] > 1                 # an item of one set alone adds nothing
    number = np.cumsum(held > 1) - 1
    column, owner = number[column[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
        a, b = np.searchsorted(column, (at, at + 4096))
        held_here = np.zeros((len(sets), 4096), np.float32)
        held_here[owner[a:b], column[a:b] - at] = 1.0
        common += held_here @ held_here.T
    np.fill_diagonal(common, sizes)
    return common


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: ``id``, ``text_key`` (MD5 of the text), ``class_key``
    (names the class; null where there is no word), ``class_id`` (its least id)
    and ``n_links`` (other documents with similarity >= threshold)."""
    sketched = sketch(docs, id_col, text_col)
    first = F.min(F.struct("id", "text_key"))
    classes = settle(
        sketched.where("set_id is not null").groupBy("set_id")
        .agg(F.count("*").alias("copies"), first.alias("head"), F.first("n").alias("n"),
             F.first("bands").alias("bands"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    groups = settle(components(candidate_links(classes, threshold, tolerance)), "groups")
    sizes = groups.groupBy("label").agg(F.count("*").alias("size"))
    wanted = (groups.join(sizes, "label").join(classes.select("node", "copies", "head"), "node"))
    # The text of a class is that of its first document; copies stay where they are.
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"),
                        F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("key"))
    found = (texts.join(wanted, texts["doc"].eqNullSafe(F.col("head.id")) & (texts["key"] == F.col("head.text_key")))
             .select("node", "copies", "label", "size", "text"))
    ddl = "node bigint, copies bigint, label bigint, size bigint, shingles binary"

    def make():
        shingle = Shingler()

        def step(batch: pa.RecordBatch) -> dict:
            return {**{c: batch[c] for c in ("node", "copies", "label", "size")},
                    "shingles": [shingle(t).tobytes() for t in batch["text"].to_pylist()]}
        return step

    members = settle(map_batches(found, make, ddl).dropDuplicates(["node"]), "members")
    checked = settle(verified_links(members, threshold), "links")
    labels = components(checked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    known = (classes.select("set_id", "node", "copies", F.col("head.id").alias("least"))
             .join(links, "node", "left").join(labels, "node", "left")
             .withColumn("class_key", F.coalesce("label", "node")))
    least = known.groupBy("class_key").agg(F.min("least").alias("class_id"))
    known = known.join(least, "class_key").select(
        F.col("set_id").alias("of_set"), "class_key", "class_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return sketched.join(known, sketched["set_id"] == known["of_set"], "left").select(
        "id", "text_key", "class_key",
        F.when(F.col("class_key").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """The documents with one of each class: the row with the least id (of equal
    ids, the least text key). Documents without a word all stay."""
    found = near_duplicates(docs, id_col, text_col, threshold)
    kept = (found.where("class_key is not null").groupBy("class_key")
            .agg(F.min(F.struct("id", "text_key")).alias("head")).select("head.*"))
    key = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    marked = docs.withColumn("_jaccard_key", key)
    kept = kept.select(F.col("id").alias("_jaccard_id"), F.col("text_key").alias("_jaccard_kept"))
    ones = (marked.join(kept, (marked["_jaccard_key"] == kept["_jaccard_kept"]) & marked[id_col].eqNullSafe(kept["_jaccard_id"]), "leftsemi")
            .dropDuplicates([id_col, "_jaccard_key"]).drop("_jaccard_key"))
    wordless = docs.where(~F.coalesce(F.col(text_col), F.lit("")).rlike("[^ \\t\\n\\x0B\\f\\r]"))
    return ones.unionByName(wordless)
