"""Near duplicates by an LSH forest over MinHash signatures, confirmed on whole shingle sets.

Every text's set of five-word shingles gets a signature of MinHash values. A tree of the forest takes
DEPTH values of its own; texts that share these form a region. Texts of regions with more than REGION
texts get longer prefixes (adaptive depth) of fresh values and, as a longer prefix is shared less
often, so many more trees that similar texts still meet. What the longest prefix leaves too large is
cut into blocks, first by hash, then in pairs (step 4).

1. Equal sets fall into classes first; from here on a class is one text.
2. The texts of each region of the first orders are compared on their whole sets, all at once in a
   task that holds the region; so are pairs that stand alone in any order, if their signatures agree
   enough. Links give components.
3. Regions of the other orders are compared if they hold texts of different components.
4. Where a region too large for one task still holds different components, all its texts of
   different components meet: it is cut into blocks, and a task compares two of them.

A region leaves one link per text at most, and no pairs travel: groups of thousands of near copies
cost as many rows as they have texts. Only texts that are no copies of each other and still agree in
the longest prefix, more than REGION of them, are sent once for each block of their region.

No value is used twice, so trees are independent: two texts of the least similarity p miss each other
in all n trees of a depth with probability (1 - p**depth)**n <= MISS, and at all four depths, if they
are in dense areas, with at most four times that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlake.llm.tables import checked, connected_components, empty_or_null, keep, merge_components, repeated
from larderlake.llm.words import VISIBLE, hashed_words, mix, windows

SHINGLE = 5
#: Link texts with 100 * intersection >= PERCENT * union.
PERCENT = 85
DEPTH = 5
#: Longer prefixes for texts in regions of more than REGION texts.
DEEPER = (8, 11, 15)
REGION = 1024
#: Probability at most that similar texts meet in no order of a depth.
MISS = 1e-6
#: Orders of each depth whose regions are all compared.
FIRST = 3
#: Deviations below the average by which a pair's agreeing values may fall short before its sets are
#: compared: a similar pair is left out with a probability under 1e-7.
SHORT = 5.5

#: Hash values that are worked out together.
_STEP = 1 << 17
#: Shingles of a region that are looked at together.
_COLUMNS = 8192


def _sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; of fewer than SHINGLE words, one for all of them."""
    for _, w in hashed_words(texts, VISIBLE):
        shingles = windows(w.hashes, SHINGLE)
        for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
            if b - a < SHINGLE:
                yield windows(w.hashes[a:b], b - a) if b > a else np.zeros(0, dtype=np.uint64)
            else:
                found = np.sort(shingles[a : b - SHINGLE + 1])
                fresh = np.ones(len(found), dtype=bool)
                np.not_equal(found[1:], found[:-1], out=fresh[1:])
                yield found[fresh]


def trees(depth: int, percent: int) -> int:
    """Orders of a depth, so many that texts of the least similarity share a prefix in some order."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** depth))) if percent < 100 else 1


def _functions(depth: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """What the hash functions of a depth's values add and multiply with; each depth has its own."""
    place = np.arange(1, trees(depth, percent) * depth + 1, dtype=np.uint64)
    place += np.uint64((depth << 24) * (depth != DEPTH))
    return mix(place).astype(np.uint32), mix(place + np.uint64(1 << 40)).astype(np.uint32) | np.uint32(1)


def _signature(found: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """MinHash values of a set that is not empty."""
    add, factor = functions
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(add), 0xFFFFFFFF, dtype=np.uint32)
    step = max(1, _STEP // len(add))
    for i in range(0, len(x), step):
        np.minimum(out, ((x[i : i + step, None] ^ add) * factor).min(axis=0), out=out)
    return out


def _keys(found: np.ndarray, depth: int, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The prefix of a set in each order of a depth, as a hash of its values."""
    values = _signature(found, functions).reshape(-1, depth).astype(np.uint64)
    out = np.zeros(len(values), dtype=np.uint64)
    for i in range(depth):
        out = mix(out ^ values[:, i]) + np.uint64(i + 1)
    return out


def _least_size(percent: int) -> int:
    """Sets smaller than this are linked with equal sets only."""
    return -(-percent // (100 - percent)) if percent < 100 else 1 << 62


def features(docs: DataFrame, percent: int) -> DataFrame:
    """(id, n, k1, k2, signature) of (id, text): size of the set, a 128-bit hash of it, MinHash values.

    Sets that can only equal others have no signature.
    """
    least, functions = _least_size(percent), _functions(DEPTH, percent)
    length = len(functions[0])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, k1, k2, values = [], [], [], []
            for found in _sets(batch.column(1)):
                n.append(len(found))
                k1.append(int(mix(found).sum(dtype=np.uint64).view(np.int64)))
                k2.append(int(mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
                values.append(_signature(found, functions).view(np.int32) if len(found) >= least else None)
            offsets = np.cumsum([0] + [length * (v is not None) for v in values], dtype=np.int32)
            flat = np.concatenate([v for v in values if v is not None] or [np.zeros(0, dtype=np.int32)])
            signature = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (n, k1, k2)), signature]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "k1", "k2", "signature"])

    return docs.mapInArrow(make, "id long, n long, k1 long, k2 long, signature array<int>")


def _prefixes(signatures: DataFrame, percent: int) -> DataFrame:
    """(id, tree, key): the prefix of each text in each order of the first depth, which take its values in turn."""
    starts = F.array(*(F.lit(t * DEPTH + 1) for t in range(trees(DEPTH, percent))))
    key = lambda i: F.xxhash64(F.slice("signature", i, DEPTH))
    rows = signatures.select("id", F.posexplode(F.transform(starts, key)).alias("tree", "key"))
    return rows.select("id", F.struct(F.lit(DEPTH).alias("depth"), "tree").alias("tree"), "key")


def _longer_prefixes(texts: DataFrame, depth: int, percent: int) -> DataFrame:
    """(id, tree, key) of texts (id, text) for a deeper level, from values that no other level uses."""
    least, functions = _least_size(percent), _functions(depth, percent)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_keys(x, depth, functions).view(np.int64) if len(x) >= least else [] for x in _sets(batch.column(1))]
            column = pa.array(keys, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["id", "keys"])

    rows = texts.select("id", "text").mapInArrow(make, "id long, keys array<long>")
    rows = rows.select("id", F.posexplode("keys").alias("tree", "key"))
    return rows.select("id", F.struct(F.lit(depth).alias("depth"), "tree").alias("tree"), "key")


def forest(signatures: DataFrame, texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Regions (tree, key, block, id) of three to REGION texts, pairs (a, b) of smaller ones, and
    (tree, key, id) of the regions that the longest prefix leaves too large, if there are any.

    ``signatures`` has (id, signature), ``texts`` (id, text). Regions that are too large are also among the others, in
    blocks by hash, and their leaders are paired with each text there in the first orders: that
    brings most copies together before all blocks meet.
    """
    regions, pairs, crowded = [], [], None
    for depth in (DEPTH, *DEEPER):
        last = depth == DEEPER[-1]
        prefixes = _prefixes(signatures, percent) if depth == DEPTH else _longer_prefixes(texts, depth, percent)
        sizes = prefixes.groupBy("tree", "key").agg(F.count("*").alias("size"), F.min("id").alias("a"), F.max("id").alias("b"))
        sizes = keep(sizes.where("size > 1"), "sizes")
        pairs.append(sizes.where("size = 2").select("a", "b"))
        whole = keep(prefixes.join(checked(sizes.where("size > 2")), ["tree", "key"]), "members")
        large = whole.where(F.col("size") > REGION)
        blocks = F.ceil(F.col("size") / REGION).cast("int") if last else F.lit(1)
        block = F.pmod(F.xxhash64("id", "tree"), blocks).cast("int").alias("block")
        small = whole if last else whole.where(F.col("size") <= REGION)
        regions.append(small.select("tree", "key", block, "id"))
        if last:
            pairs.append(large.where(F.col("tree")["tree"] < FIRST).select("a", F.col("id").alias("b")))
            crowded = None if large.isEmpty() else large.select("tree", "key", "id")
        if last or large.isEmpty():
            break
        texts = keep(texts.join(checked(keep(large.select("id").distinct(), "large")), "id", "left_semi"), "dense")
    return reduce(DataFrame.unionByName, regions), reduce(DataFrame.unionByName, pairs), crowded


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _agreeing(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs whose signatures agree in as many values as similar sets do."""
    p, values = percent / 100, trees(DEPTH, percent) * DEPTH
    least = int(values * p - SHORT * (values * p * (1 - p)) ** 0.5)
    a = signatures.select(F.col("id").alias("a"), F.col("signature").alias("left"))
    b = signatures.select(F.col("id").alias("b"), F.col("signature").alias("right"))
    both = pairs.join(a, "a").join(b, "b")
    same = F.size(F.filter(F.zip_with("left", "right", lambda x, y: x == y), lambda x: x))
    return both.where(same >= least).select("a", "b")


def _mixed(regions: DataFrame, components: DataFrame) -> DataFrame:
    """The rows of regions that hold texts of different components."""
    named = regions.join(components.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    region = ["tree", "key", "block"]
    spread = named.groupBy(*region).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return regions.join(spread.where("low <> high").select(*region), region, "left_semi")


def _meetings(crowded: DataFrame, components: DataFrame) -> DataFrame:
    """(tree, key, block, id): tasks in which all texts of a large region meet those of other components.

    A component with many texts in a region fills blocks of its own, the small ones share blocks; each
    task has two blocks. Blocks of the same component need not meet.
    """
    part, region = max(1, REGION // 2), ["tree", "key"]
    named = crowded.join(components.withColumnRenamed("node", "id"), "id", "left")
    named = keep(named.select(*region, "id", F.coalesce("component", "id").alias("component")), "crowded")
    sizes = keep(named.groupBy(*region, "component").agg(F.count("*").alias("n")), "sizes")
    own = F.col("n") > part // 2
    totals = sizes.groupBy(*region).agg(F.count("*").alias("components"), F.sum(F.when(own, 0).otherwise(F.col("n"))).alias("rest"))
    totals = keep(totals.where("components > 1"), "totals")
    rows = named.join(checked(totals), region).join(checked(sizes), [*region, "component"])
    parts = F.ceil(F.when(own, F.col("n")).otherwise(F.col("rest")) / part)
    number = F.pmod(F.xxhash64(F.when(own, F.col("id")).otherwise(F.col("component"))), parts)
    single = F.when(own, F.col("component"))
    name = F.concat_ws(":", F.coalesce(single.cast("string"), F.lit("small")), number)
    rows = keep(rows.select(*region, "id", single.alias("single"), name.alias("part")), "blocks")
    blocks = keep(rows.select(*region, "single", "part").distinct(), "blocks")
    left = blocks.select(*region, F.col("single").alias("one"), F.col("part").alias("left"))
    right = blocks.select(*region, F.col("single").alias("two"), F.col("part").alias("right"))
    both = left.join(right, region).where("left <= right and (one is null or two is null or one <> two)")
    part_ = F.explode(F.array_distinct(F.array("left", "right"))).alias("part")
    tasks = keep(both.select(*region, F.concat_ws("|", "left", "right").alias("block"), part_), "tasks")
    return rows.join(checked(tasks), [*region, "part"]).select(*region, "block", "id")


def _common(found: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with each other."""
    values, codes = np.unique(np.concatenate(found), return_inverse=True)
    owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
    shared = np.bincount(codes, minlength=len(values)) > 1
    keep_ = shared[codes]
    codes, owner = (np.cumsum(shared) - 1)[codes[keep_]], owner[keep_]
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    out = np.zeros((len(found), len(found)), dtype=np.float32)
    for start in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(codes, (start, start + _COLUMNS))
        present = np.zeros((len(found), _COLUMNS), dtype=np.float32)
        present[owner[a:b], codes[a:b] - start] = 1
        out += present @ present.T
    return out


def _leaders(linked: np.ndarray) -> np.ndarray:
    """The first text that each text is connected with by links, itself included."""
    leader = np.full(len(linked), -1)
    for i in range(len(linked)):
        if leader[i] >= 0:
            continue
        reached = edge = linked[i] | (np.arange(len(linked)) == i)
        while edge.any():
            more = linked[edge].any(axis=0) & ~reached
            reached, edge = reached | more, more
        leader[reached] = i
    return leader


def _region_links(regions: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b): each text of a region and the first that it is connected with inside the region."""

    def compare(region: pa.Table) -> pa.Table:
        # Whatever order the rows came in, the links are the same.
        region = region.sort_by("id")
        ids = region.column("id").to_numpy()
        found = list(_sets(region.column("text").combine_chunks()))
        size = np.array([len(x) for x in found])
        common = _common(found)
        leader = _leaders(100 * common >= percent * (size[:, None] + size - common))
        return pa.table({"a": ids[leader], "b": ids}).filter(pa.array(leader != np.arange(len(ids))))

    rows = regions.join(texts, "id").select("tree", "key", "block", "id", "text")
    return rows.groupBy("tree", "key", "block").applyInArrow(compare, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs that are similar enough on their whole sets."""
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    both = both.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(_sets(batch.column(2)), _sets(batch.column(3)), strict=True):
                common = len(x) + len(y) - len(np.union1d(x, y))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(check, "a long, b long")


def _merged(components: DataFrame, more: DataFrame) -> DataFrame:
    """Components after more links between texts."""
    # Only links between components count; most repeat what is known.
    names = components.select(F.col("node").alias("a"), F.col("component").alias("one"))
    others = components.select(F.col("node").alias("b"), F.col("component").alias("two"))
    fresh = more.distinct().join(names, "a", "left").join(others, "b", "left")
    fresh = fresh.select(F.coalesce("one", "a").alias("a"), F.coalesce("two", "b").alias("b")).where("a <> b")
    return merge_components(components, keep(fresh, "links"))


def link_components(docs: DataFrame, percent: int = PERCENT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every document.

    ``id`` holds integers. Words are runs of what isn't ASCII white space, A-Z in lower case. Texts
    are linked if 100 * common shingles >= percent * all shingles of both, and a component is named
    by its least id; ``kept`` marks the row with that id. A null or empty text, or one of white
    space, has no shingles and is linked with nothing. Rows equal in id and text give one row; rows
    that share an id only are one document with several texts. A row without id is linked with
    nothing: null component, kept. Other columns are not read.
    """
    texts = docs.select(docs[f"`{id}`"].cast("long").alias("id"), empty_or_null(docs[f"`{text}`"]).alias("text"))
    if repeated(docs, id):
        texts = texts.distinct()
    found = keep(features(texts, percent), "features")
    usable = found.where("id is not null and n > 0")
    classes = keep(usable.groupBy("n", "k1", "k2").agg(F.min("id").alias("class")), "classes")
    able = usable.where(F.size("signature") > 0).select("n", "k1", "k2", "id", "signature")
    firsts = checked(classes.withColumnRenamed("class", "id"))
    signatures = keep(able.join(firsts, ["id", "n", "k1", "k2"], "left_semi").select("id", "signature"), "signatures")
    regions, pairs, crowded = forest(signatures, texts, percent)
    regions, pairs = keep(regions, "regions"), keep(_agreeing(_ordered(pairs), signatures, percent), "pairs")
    involved = regions.select("id").unionByName(pairs.select(F.explode(F.array("a", "b")).alias("id"))).distinct()
    texts = keep(texts.join(checked(keep(involved, "involved")), "id", "left_semi"), "texts")
    first = regions.where(F.col("tree")["tree"] < FIRST)
    links = _confirmed(pairs, texts, percent).unionByName(_region_links(first, texts, percent))
    links = keep(links, "links")
    components = connected_components(links)
    rest = _mixed(regions.where(F.col("tree")["tree"] >= FIRST), components)
    more = keep(_region_links(rest, texts, percent), "links")
    components = _merged(components, more)
    for orders in ("tree.tree < {}", "tree.tree >= {}") if crowded is not None else ():
        components = keep(components, "components")
        tasks = keep(_meetings(crowded.where(orders.format(FIRST)), components), "regions")
        components = _merged(components, keep(_region_links(tasks, texts, percent), "links"))
    rows = found.select("id", "n", "k1", "k2").join(classes, ["n", "k1", "k2"], "left")
    rows = rows.withColumn("class", F.when(F.col("n") > 0, F.col("class")))
    rows = rows.join(components.withColumnRenamed("node", "class"), "class", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "class", "id"))
    return rows.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, percent: int = PERCENT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay: one of each component, columns as they were.

    Of rows that repeat an id one stays; rows without id all stay.
    """
    gone = link_components(docs, percent, id, text).where("not kept").select(F.col(id).alias("gone")).distinct()
    stay = docs.join(checked(keep(gone, "gone")), docs[f"`{id}`"] == F.col("gone"), "left_anti")
    if not repeated(docs, id):
        return stay
    named = stay.where(stay[f"`{id}`"].isNotNull()).dropDuplicates([id])
    return named.unionByName(stay.where(stay[f"`{id}`"].isNull()))
