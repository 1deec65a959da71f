"""Exact Jaccard self-join on word shingles by universe partition, and its connected components.

A document's set holds the 64-bit hashes of its distinct shingles of ``WIDTH`` words (fewer words:
the whole sequence is one shingle). Two documents link if |A n B| / |A u B| >= 0.8; then at most
H = floor((|A| + |B|) / 9) shingles lie in one set only.

Pigeonhole. Sets are dealt into size bands. Within a band every shingle belongs to one of the
band's segments by its hash. H differing shingles spoil at most H segments, so of a pair's
segments enough are the same, and a set needs to index only H + 1 of them, as long as both sides
drop the costliest ones by one common order. A segment of which also the one-deletion neighbourhood
is indexed (its subset, and the subset without each of its members) is spoiled by two differences
only, so it counts for two.

Cost-based allocation. Per band, ``allocate`` weighs the keys written against the candidates
expected, and chooses how many segments get deletion neighbourhoods: sets of few shingles do, long
ones do not. Per set, segments are taken coldest first: a segment costs as much as its rarest
shingle is frequent, by counts of all documents' shingles (a fixed-size table of heavy slots), then
the smaller its subset. So passages that many documents share are indexed last. Counts steer
costs only: any table gives the same links.

Buckets and skew. Copies (equal sets) are one node. Sets with a common key are candidates, but a
bucket's pairs are not listed: first each member is verified against the bucket's smallest id, its
pivot, streaming in sort order, and components are formed. Where a bucket still holds several
components, all that share its pivot are compared in blocks of bounded size, a product of two
blocks' incidence matrices giving the intersections, and only links come back. Every candidate
pair is either verified or already connected, so components are exact. Families of many
heavily edited copies that do not link cost the square of their size in that product: to show
that no two of them link, each two must be compared.

Nothing is capped: keys, buckets and candidates of any number take this way. Results that are read
twice are tables in the shared folder. The driver sees only the heavy slots, at most
``SLOTS / HEAVY``.

Edge cases: null and wordless texts have an empty set and are linked with nothing. Rows with a null
id have a set size and a null component. Rows of one id are one document: they share their
component, each with its own set size. Very long texts cost memory in proportion to one text.
Repeated rows are copies. An empty table gives none. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayscope.llm.common import map_text, ship
from stayscope.llm.hashing import BY_WHITE, Words, mix, window_hashes
from stayscope.storage import materialise

WIDTH = 5
#: Links have 100 * intersection >= PERCENT * union. The bound H = (a + b) / 9 belongs to 80.
PERCENT = 80
BAND_RATIO = 1.5
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
#: A slot is heavy if it counts so many times the mean.
HEAVY = 4

#: Bounds of a block of sets that are compared with each other, and the width of one product.
BLOCK_ROWS = 512
BLOCK_SHINGLES = 200_000
TOKENS_AT_ONCE = 4096

#: What ``allocate`` has worked out; a plain table, so that it goes to the workers by value.
_allocated: dict[int, tuple[int, int]] = {}

_GROUP, _SEGMENT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def shingle_set(text: str) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = Words(text, BY_WHITE)
    return np.unique(window_hashes(words.hashes, min(WIDTH, len(words)))) if len(words) else words.hashes


def differences(a: int, b: int) -> int:
    """The most shingles that lie in only one of two linked sets of these sizes."""
    return (a + b) // 9


def band_of(n: int) -> int:
    band = int(math.log(n) / math.log(BAND_RATIO) + 1e-9)
    while lowest(band + 1) <= n:
        band += 1
    while lowest(band) > n:
        band -= 1
    return band


def lowest(band: int) -> int:
    """The smallest size in a band."""
    return math.ceil(BAND_RATIO**band - 1e-9)


def _few(n: int, share: float) -> float:
    """Chance that at most one of ``n`` shingles falls into a segment of this share."""
    return (1 - share) ** n + n * share * (1 - share) ** (n - 1)


def allocate(band: int) -> tuple[int, int]:
    """``(deletion segments, exact segments)`` of a band, the cheapest by a simple model.

    The cost is the number of keys of the band's largest set plus the candidates expected: a subset
    of t shingles is taken to recur in unrelated sets with a chance of 0.35^t, more so in short
    sets, and an almost empty deletion segment to recur everywhere.
    """
    if band in _allocated:
        return _allocated[band]
    high = max(lowest(band), lowest(band + 1) - 1)
    low = max(1, math.ceil(0.8 * lowest(band)))
    needed = differences(high, high) + 1
    best = (math.inf, 0, 1)
    for deletions in range(needed // 2 + 1):
        keys = needed - 2 * deletions
        exact = max(math.ceil(1.5 * keys), keys + 6) if keys > 0 else 0
        if needed == 1:
            exact = 1
        # A deletion segment takes three shares of the hash space, an exact one takes one.
        shares = 3 * deletions + exact
        size = high / shares
        written = keys + deletions * (1 + 3 * size)
        candidates = keys * 0.35**size + deletions * (1 + 3 * size) * 0.35 ** (3 * size)
        cost = written + 512 / high * candidates + 2000 * deletions * _few(low, 3 / shares)
        best = min(best, (cost, deletions, exact))
    _allocated[band] = best[1:]
    return _allocated[band]


def keys_of(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Index keys of a set in its own band and, if a larger partner may lie there, in the next."""
    n = len(hashes)
    if not n:
        return hashes
    own, largest = band_of(n), n * 5 // 4
    bands = [own] + [own + 1] * (largest >= lowest(own + 1))
    heat = levels[(hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
    values = mix(hashes + _SEGMENT)
    out = []
    for band in bands:
        deletions, exact = allocate(band)
        high = max(lowest(band), lowest(band + 1) - 1)
        take = differences(n, min(high, largest)) + 1 - 2 * deletions
        share = ((hashes >> np.uint64(17)) % np.uint64(3 * deletions + exact)).astype(np.int64)
        segment = np.where(share < 3 * deletions, share // 3, share - 2 * deletions)
        order = np.argsort(segment, kind="stable")
        sorted_segments = segment[order]
        first = np.flatnonzero(np.diff(sorted_segments, prepend=-1))
        filled = sorted_segments[first]
        total = deletions + exact
        sums = np.zeros(total, dtype=np.uint64)
        sums[filled] = np.add.reduceat(values[order], first)
        sizes = np.bincount(segment, minlength=total)
        cost = np.full(total, 255, dtype=np.uint8)
        cost[filled] = np.minimum.reduceat(heat[order], first)
        salt = np.array([band + 1], dtype=np.uint64) * _GROUP + _SEGMENT * np.arange(1, total + 1, dtype=np.uint64)
        if take > 0:
            ranked = deletions + np.lexsort((-sizes[deletions:], cost[deletions:]))[:take]
            out.append(mix(sums[ranked] + salt[ranked]))
        if deletions:
            out.append(mix(sums[:deletions] + salt[:deletions]))
            inside = segment < deletions
            of = segment[inside]
            out.append(mix(sums[of] - values[inside] + salt[of]))
    return np.unique(np.concatenate(out))


def set_table(docs: DataFrame) -> DataFrame:
    """``doc_id, n, s1, s2, heavy``: set size, 128-bit signature, heavy slots seen near the row."""

    def start():
        def kernel(texts):
            sizes, s1, s2, seen = [], [], [], []
            for text in texts:
                hashes = shingle_set(text)
                sizes.append(len(hashes))
                s1.append(int(mix(hashes).sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(mix(hashes ^ _GROUP).sum(dtype=np.uint64).view(np.int64)))
                seen.append((hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
            counts = np.bincount(np.concatenate(seen), minlength=SLOTS)
            # Slots that stand out here; slots heavy over all documents do so in most places.
            standing = np.flatnonzero(counts >= max(8, HEAVY * counts.mean()))
            heavy = [[(int(i), int(counts[i])) for i in standing], *[[] for _ in texts[1:]]]
            return [sizes, s1, s2, heavy]

        return kernel

    outputs = [
        ("n", "bigint"),
        ("s1", "bigint"),
        ("s2", "bigint"),
        ("heavy", "array<struct<slot:int,n:bigint>>"),
    ]
    return map_text(docs.select("doc_id", "text"), "text", outputs, start, keep_text=False)


def heat_levels(sets: DataFrame) -> np.ndarray:
    """For each slot 0, or, for heavy ones, one more than log2 of its count over the mean."""
    mean = (sets.agg(F.sum("n")).first()[0] or 0) / SLOTS
    heavy = (
        sets.where(F.size("heavy") > 0)
        .select(F.inline("heavy"))
        .groupBy("slot")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= HEAVY * max(mean, 1.0))
    )
    levels = np.zeros(SLOTS, dtype=np.uint8)
    for slot, n in heavy.collect():  # counts add up to the mean times SLOTS at most
        levels[slot] = min(254, 1 + int(math.log2(n / max(mean, 1.0))))
    return levels


def index_keys(docs: DataFrame, levels: np.ndarray) -> DataFrame:
    """``doc_id, key``: the index entries, one document of equal sets per task."""

    def start():
        met: set = set()

        def kernel(texts):
            out = []
            for text in texts:
                hashes = shingle_set(text)
                mixed = mix(hashes).sum(dtype=np.uint64)
                signature = (len(hashes), int(mixed), int(hashes.sum(dtype=np.uint64)))
                fresh = signature not in met
                met.add(signature)
                out.append(keys_of(hashes, levels).view(np.int64) if fresh else hashes[:0].view(np.int64))
            return [out]

        return kernel

    keys = map_text(docs, "text", [("keys", "array<bigint>")], start, keep_text=False)
    return keys.select("doc_id", F.explode("keys").alias("key"))


def _sets_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, members``: the stored shingle sets of the documents in ``ids`` (doc_id)."""

    def start():
        return lambda texts: [[shingle_set(t).view(np.int64) for t in texts]]

    wanted = docs.join(ids.distinct().hint("shuffle_hash"), "doc_id", "left_semi")
    sets = map_text(wanted, "text", [("members", "array<bigint>")], start, keep_text=False)
    return materialise(sets, "join-sets")


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The linked ones of ``pairs`` (a, b)."""
    pairs = materialise(pairs, "join-pairs")
    sets = _sets_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), docs)
    first = sets.select(F.col("doc_id").alias("a"), F.col("members").alias("of_a"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("members").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - both
    linked = pairs.join(first, "a").join(second, "b").where(100 * both >= PERCENT * union)
    return materialise(linked.select("a", "b").distinct(), "join-links")


def _intersections(members: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with each other."""
    sizes = [len(m) for m in members]
    owners = np.repeat(np.arange(len(members)), sizes)
    _, tokens, counts = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    shared = counts[tokens] > 1
    number = np.cumsum(counts > 1) - 1
    tokens, owners = number[tokens[shared]], owners[shared]
    out = np.zeros((len(members), len(members)), dtype=np.float32)
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    for low in range(0, int(tokens[-1]) + 1 if len(tokens) else 0, TOKENS_AT_ONCE):
        part = slice(*np.searchsorted(tokens, (low, low + TOKENS_AT_ONCE)))
        present = np.zeros((len(members), TOKENS_AT_ONCE), dtype=np.float32)
        present[owners[part], tokens[part] - low] = 1.0
        out += present @ present.T
    return out.astype(np.int64)


def _linked_across(groups: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between the components that meet in a group, one for each two that do.

    ``groups`` has ``pivot, node, root, n``. A group is cut into blocks of bounded size by hash; a
    task compares two blocks and returns links only, so a large group is neither held
    together nor written out as pairs.
    """
    sizes = groups.groupBy("pivot").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    n_blocks = F.greatest(
        F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)
    ).cast("int")
    blocks = sizes.where("rows > 1").select("pivot", n_blocks.alias("n_blocks"))
    placed = groups.join(blocks, "pivot").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    dealt = placed.select("pivot", "node", "root", "block", other.alias("other")).select(
        "pivot",
        "node",
        "root",
        "block",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
    )
    sets = _sets_of(groups.select(F.col("node").alias("doc_id")), docs)
    held = dealt.join(sets, F.col("node") == F.col("doc_id")).drop("doc_id")

    def compare(table: pa.Table) -> pa.Table:
        node, root, block = (np.asarray(table.column(c)) for c in ("node", "root", "block"))
        members = [m.values.to_numpy().view(np.uint64) for m in table.column("members")]
        both = _intersections(members)
        size = np.array([len(m) for m in members])
        linked = 100 * both >= PERCENT * (size[:, None] + size[None, :] - both)
        # Pairs of one block are compared where it meets itself.
        alone = bool((block == block[0]).all())
        linked &= (root[:, None] < root[None, :]) & (alone | (block[:, None] != block[None, :]))
        a, b = np.nonzero(linked)
        _, first = np.unique(np.stack([root[a], root[b]], axis=1), axis=0, return_index=True)
        return pa.table({"a": node[a[first]], "b": node[b[first]]})

    links = held.groupBy("pivot", "i", "j").applyInArrow(compare, "a bigint, b bigint")
    return materialise(links.distinct(), "join-links")


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable from each node of undirected ``edges`` (a, b).

    Alternates the two star operations: hand the smallest neighbour to the larger neighbours, then
    to the smaller ones. Each round is a stored table; the number of rounds grows with the
    logarithm of the longest path.
    """

    def smallest(of: DataFrame) -> DataFrame:
        return of.groupBy("u").agg(F.min("v").alias("m"))

    def state(of: DataFrame):
        return tuple(of.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    stars = materialise(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "components",
    )
    before = state(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(smallest(both).select("u", F.least("u", "m").alias("m")), "components-low")
        large = materialise(
            both.join(low, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            "components-large",
        )
        low = materialise(smallest(large), "components-low")
        passed = large.join(low, "u").where(F.col("v") != F.col("m"))
        small = passed.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        stars = materialise(small.distinct(), "components")
        after = state(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    docs = docs.select("doc_id", "text")
    sets = materialise(set_table(docs), "join-sizes")
    named = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).select("doc_id", "n", "s1", "s2")
    copies = materialise(
        named.groupBy("n", "s1", "s2")
        .agg(F.min("doc_id").alias("copy_of"), F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .drop("copies"),
        "join-copies",
    )
    nodes = materialise(
        sets.drop("heavy")
        .join(copies, ["n", "s1", "s2"], "left")
        .select("doc_id", "n", F.coalesce("copy_of", "doc_id").alias("node")),
        "join-nodes",
    )

    keyed = index_keys(docs.where(F.col("doc_id").isNotNull()), heat_levels(sets))
    in_order = Window.partitionBy("key").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    shared = materialise(
        keyed.withColumn("pivot", F.first("doc_id").over(in_order)).where(F.col("doc_id") != F.col("pivot")),
        "join-buckets",
    )

    of_doc = nodes.where(F.col("n") > 0).select("doc_id", "n", "node")

    def as_nodes(pairs: DataFrame) -> DataFrame:
        """Pairs of documents as distinct pairs of nodes whose sizes allow a link."""
        a = of_doc.select(F.col("doc_id").alias("x"), F.col("n").alias("n_a"), F.col("node").alias("p"))
        b = of_doc.select(F.col("doc_id").alias("y"), F.col("n").alias("n_b"), F.col("node").alias("q"))
        sized = pairs.join(a, "x").join(b, "y").where(F.col("p") != F.col("q"))
        fits = 5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b")
        pair = F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")
        return sized.where(fits).select(*pair).distinct()

    stars = materialise(
        shared.select(F.col("pivot").alias("x"), F.col("doc_id").alias("y")).distinct(), "join-stars"
    )
    links = _verified(as_nodes(stars), docs)
    # Rows of one id are one document, whatever their sets.
    united = of_doc.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    links = links.unionByName(united.where("a <> b").select("a", "b"))
    links = links.unionByName(united.where("a <> doc_id AND a <> b").select("a", F.col("doc_id").alias("b")))
    roots = components(links)

    placed = materialise(
        of_doc.join(roots, of_doc.node == roots.node, "left").select(
            "doc_id", "n", of_doc.node, F.coalesce("root", of_doc.node).alias("root")
        ),
        "join-placed",
    )

    def with_root(df: DataFrame, column: str, name: str) -> DataFrame:
        named = placed.select(F.col("doc_id").alias(column), F.col("root").alias(name))
        return df.join(named.distinct(), column)

    # Buckets whose members are not all connected yet; every pair that shares one shares its pivot.
    apart = with_root(with_root(stars, "x", "root_x"), "y", "root_y").where("root_x <> root_y")
    apart = apart.select(F.col("x").alias("pivot"), F.col("y").alias("doc_id")).distinct()
    apart = materialise(apart, "join-apart")
    open_keys = shared.join(apart, ["pivot", "doc_id"], "left_semi").select("key").distinct()
    open_keys = materialise(open_keys, "join-open")
    members = shared.join(open_keys, "key", "left_semi").select("pivot", "doc_id").distinct()
    members = members.unionByName(members.select("pivot", F.col("pivot").alias("doc_id")).distinct())
    groups = members.join(placed, "doc_id").select("pivot", "node", "root", "n").distinct()
    more = _linked_across(materialise(groups, "join-groups"), docs)
    if not more.isEmpty():
        roots = components(
            roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)
        )
    found = nodes.join(roots, "node", "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("component_id")
    )


ship(__name__)
