"""Near-duplicate documents by bottom-k sketches of their word shingles.

One hash function orders all shingles; a document's sketch is its ``k`` smallest
hash values. The steps:

1. Documents with equal shingle sets become one class.
2. Bands: two small hash values of one residue class form a key; each class is
   compared with the smallest class under its keys. This joins the bulk of a large
   group of near copies with one link a member.
3. Clusters: the classes that share their smallest class of step 2, whether they
   link with it or not. Those that ended in another component than that class meet
   the whole cluster, block against block inside tasks, through inverted lists of
   the block's sketches; of a class's links one to each component comes out.
4. Lists over all classes: of a sketch's values, rarest first, only the prefix is
   listed that two sketches over the threshold cannot both miss. They pair classes of
   *different* components and clusters; inside either nothing is left to find.

Pairs pass an estimate from the union's sketch, then exact Jaccard on the words of
both texts; links make components. Pairs are made only of what earlier steps
leave, so no group yields all its pairs, and no pair over the threshold between
two components is skipped. The chances taken
are those of the hash: sketches of two sets with Jaccard 0.8 share at least 32 of
the union's 64 values but for one pair in some 10^7, and so for other thresholds
(``least_overlap``); sets that fit in their sketches take no chance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.llm.common import WordHasher, connected_components, mixed, rows_of, saved, sliced

SKETCH_SIZE = 64
BANDS, BAND_VALUES = 8, 2
#: Sets from this size on get bands.
BAND_SET_SIZE = 4 * BANDS * BAND_VALUES
#: Share of the union's sketch from which a class joins its smallest one's cluster.
CLUSTER_SHARE = 0.2
#: Shingles and rows of a block of cluster members that meets another in one task.
BLOCK_SHINGLES, BLOCK_ROWS = 100_000, 256
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SKETCH = (
    "doc_id LONG, n_shingles LONG, digest BINARY, sketch ARRAY<LONG>, bands ARRAY<LONG>"
)


def words_of(text: str | None) -> list[bytes]:
    """Words without ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingles_of(words: list, width: int) -> set:
    """Distinct runs of ``width`` words; fewer words are one shingle, none is none."""
    if not words:
        return set()
    if len(words) <= width:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(width))))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of hashed words."""
    if not len(words):
        return words
    n = max(1, len(words) - width + 1)
    value = np.full(n, min(width, len(words)), np.uint64)
    for i in range(min(width, len(words))):
        value = mixed(value * _MULTIPLIER + words[i : n + i])
    return np.unique(value)


def sketches(docs: DataFrame, width: int, size: int = SKETCH_SIZE) -> DataFrame:
    """Set size, digest of the set, bottom-``size`` values and band keys of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        residues = np.arange(BANDS, dtype=np.uint64)[:, None]
        for batch in sliced(batches):
            texts = ((t or "").encode().lower() for t in batch.column("text").to_pylist())
            sizes, digests, values, bands = [], [], [], []
            for words in hasher.each(texts):
                found = shingle_hashes(words, width)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                values.append(found[:size].view(np.int64))
                keys = np.zeros(0, np.int64)
                if len(found) >= BAND_SET_SIZE:
                    # The smallest values of each residue lie among the first few.
                    first = found[: 16 * BANDS * BAND_VALUES]
                    match = (first & np.uint64(BANDS - 1)) == residues
                    if (match.sum(axis=1) >= BAND_VALUES).all():
                        at = np.argsort(~match, axis=1, kind="stable")[:, :BAND_VALUES]
                        key = residues[:, 0]
                        for i in range(BAND_VALUES):
                            key = mixed(key * _MULTIPLIER + first[at[:, i]])
                        keys = key.view(np.int64)
                bands.append(keys)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "digest": pa.array(digests, pa.binary()),
                    "sketch": pa.array(values, pa.list_(pa.int64())),
                    "bands": pa.array(bands, pa.list_(pa.int64())),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, _SKETCH)


def least_overlap(size: int, percent: int) -> int:
    """Values of the union's sketch that two sets over the threshold share.

    Six standard deviations below the mean of a binomial count.
    """
    p = percent / 100
    return max(1, math.floor(size * p - 6 * math.sqrt(size * p * (1 - p))))


def prefix_length(n: Column, size: int, percent: int) -> Column:
    """How many of a sketch's values, rarest first, must be listed.

    Where any partner's set fits in its sketch too, the overlap is exact;
    otherwise it is ``least_overlap`` of the ``size`` values.
    """
    whole = n - F.ceil(n * percent / 100) + 1
    cut = F.least(n, F.lit(size)) - least_overlap(size, percent) + 1
    return F.when(n * 100 <= F.lit(size * percent), whole).otherwise(F.greatest(cut, F.lit(1)))


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document.

    Documents link where ``100 * |A & B| >= percent * |A | B|`` on their sets of
    ``width``-word shingles; ``component_id`` is the smallest doc_id reachable
    and ``kept`` says whether it is the row's own. Null and empty texts have no
    shingles and no links. Repeated rows are all returned. Rows of one doc_id
    with several texts are one document with the links of all of them; a row
    without doc_id links with nothing, has no component and is kept. Columns
    other than ``doc_id`` and ``text`` are not read.
    """
    docs = docs.select("doc_id", "text")
    rows = saved(spark, sketches(docs, width, size), "sketches")
    linked = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = saved(
        spark,
        linked.groupBy("digest").agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("n_rows"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    estimated = _estimated(spark, classes, _band_pairs(spark, classes), percent, size)
    found = _confirmed(spark, docs, _likely(spark, estimated), width, percent)
    # ``hub`` names a class's cluster: every pair with its own hub is decided.
    clusters = saved(
        spark,
        estimated.where(F.col("overlap") >= CLUSTER_SHARE * F.col("values"))
        .groupBy(F.col("b").alias("rep"))
        .agg(F.min("a").alias("hub")),
        "clusters",
    )
    first = connected_components(spark, found)
    inside = _cluster_links(spark, docs, classes, clusters, first, width, percent, size)
    found = found.union(inside)
    second = connected_components(spark, found)
    pairs = _list_pairs(spark, classes, clusters, second, size, percent)
    likely = _likely(spark, _estimated(spark, classes, pairs, percent, size))
    found = found.union(_confirmed(spark, docs, likely, width, percent))
    components = connected_components(spark, found)

    # Only classes that are not their own document's alone need to be looked up.
    named = saved(
        spark,
        classes.select("digest", "rep", "n_rows")
        .join(components.withColumnRenamed("id", "rep"), "rep", "left")
        .where((F.col("n_rows") > 1) | F.col("component").isNotNull())
        .select("digest", F.coalesce("component", "rep").alias("component")),
        "components",
    )
    own = F.coalesce("component", "doc_id")
    return (
        rows.select("doc_id", "n_shingles", "digest")
        .join(named, (rows["digest"] == named["digest"]) & rows["doc_id"].isNotNull(), "left")
        .select(
            "doc_id",
            "n_shingles",
            own.alias("component_id"),
            F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
        )
    )


def keep_one(
    spark: SparkSession, docs: DataFrame, width: int = 5, percent: int = 80
) -> DataFrame:
    """The documents, with all their columns, less all but one of each group.

    The one with the smallest doc_id stays; of rows that repeat it, any one. Rows
    without doc_id stay.
    """
    found = near_duplicates(spark, docs, width, percent)
    rows = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")
    )
    rows = saved(spark, rows, "rows")
    dropped = rows.where(~F.col("kept")).select("doc_id")
    repeated = rows.where(F.col("kept") & (F.col("n") > 1)).select("doc_id")
    others = saved(spark, dropped.union(repeated), "others")
    return rows_of(docs, others, "left_anti").unionByName(
        rows_of(docs, repeated).dropDuplicates(["doc_id"])
    )


def _band_pairs(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """``(a, b)``: each class with the smallest class under each of its keys."""
    keys = saved(spark, classes.select("rep", F.explode("bands").alias("key")), "bands")
    hubs = saved(
        spark,
        keys.groupBy("key")
        .agg(F.min("rep").alias("hub"), F.max("rep").alias("last"))
        .where(F.col("hub") < F.col("last"))
        .select("key", "hub"),
        "hubs",
    )
    return (
        keys.join(hubs, "key")
        .where(F.col("rep") > F.col("hub"))
        .select(F.col("hub").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )


class SketchLists:
    """Inverted lists from retained values to the sketches that hold them."""

    def __init__(self, sketches: list[np.ndarray], size: int, percent: int) -> None:
        self._size, self._percent = size, percent
        self._lengths = np.array([len(s) for s in sketches], np.int64)
        values = np.concatenate([*sketches, np.zeros(0, np.uint64)])
        order = np.argsort(values, kind="stable")
        self._values = values[order]
        self._owners = np.repeat(np.arange(len(sketches)), self._lengths)[order]
        starts = np.cumsum(self._lengths) - self._lengths
        self._ranks = (np.arange(len(values)) - np.repeat(starts, self._lengths))[order]

    def likely(self, sketch: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """The ``allowed`` sketches that the sketch of the union with ``sketch``
        does not rule out, by the rule of ``_estimated``."""
        first = np.searchsorted(self._values, sketch, "left")
        found = np.searchsorted(self._values, sketch, "right") - first
        at = np.arange(found.sum()) + np.repeat(first - np.cumsum(found) + found, found)
        own_rank = np.repeat(np.arange(len(sketch)), found)
        use = allowed[self._owners[at]]
        at, own_rank = at[use], own_rank[use]
        by_owner = np.argsort(self._owners[at], kind="stable")
        at, own_rank = at[by_owner], own_rank[by_owner]
        owners = self._owners[at]
        common = np.bincount(owners, minlength=len(self._lengths))
        # A value's place in the union: those before it on either side, once each.
        before = np.arange(len(owners)) - (np.cumsum(common) - common)[owners]
        inside = own_rank + self._ranks[at] - before < self._size
        overlap = np.bincount(owners[inside], minlength=len(self._lengths))
        union = len(sketch) + self._lengths - common
        least = np.where(
            union <= self._size,
            union * self._percent / 100 - 1e-6,
            least_overlap(self._size, self._percent),
        )
        return np.flatnonzero((common > 0) & (overlap >= least))


def _cluster_links(
    spark: SparkSession,
    docs: DataFrame,
    classes: DataFrame,
    clusters: DataFrame,
    components: DataFrame,
    width: int,
    percent: int,
    size: int,
) -> DataFrame:
    """``(a, b)`` links between members of one cluster in different components.

    A member whose component is not its hub's is a probe; probes meet all members
    of the cluster. Both are dealt in blocks of about ``BLOCK_SHINGLES`` shingles
    and ``BLOCK_ROWS`` rows, whichever is less. In a task, lists of the members'
    retained values give a probe's overlaps, the union's sketch rules most out, and
    full sets decide the others.
    """
    at_hub = components.toDF("hub", "hub_component")
    members = saved(
        spark,
        clusters.join(components.withColumnRenamed("id", "rep"), "rep", "left")
        .join(at_hub, "hub", "left")
        .join(classes.select("rep", "n"), "rep")
        .select("hub", "rep", "n", F.coalesce("component", "rep").alias("component"),
                F.coalesce("hub_component", "hub").alias("hub_component")),
        "members",
    )
    probe = F.col("component") != F.col("hub_component")

    def blocks(shingles: Column) -> Column:
        by_rows = F.ceil(F.count(shingles) / BLOCK_ROWS)
        return F.greatest(F.ceil(F.sum(shingles) / BLOCK_SHINGLES), by_rows).cast("int")

    sizes = saved(
        spark,
        members.groupBy("hub")
        .agg(blocks(F.col("n")).alias("bases"), blocks(F.when(probe, F.col("n"))).alias("probes"))
        .where(F.col("probes") > 0),
        "sizes",
    )
    open_ = saved(spark, members.join(sizes, "hub"), "open")
    texts = rows_of(docs, open_.select(F.col("rep").alias("doc_id")).distinct()).distinct()

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("rep"), F.col(own)).cast("int").alias(own[0])
        each = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[0])
        places = {own[0]: mine, other[0]: each}
        return rows.select(
            "hub", places["p"], places["b"], F.lit(own == "probes").alias("is_probe"), "rep", "component"
        )

    def compare(table: pa.Table) -> pa.Table:
        hasher = WordHasher()
        data = [(t or "").encode().lower() for t in table.column("text").to_pylist()]
        sets = [shingle_hashes(words, width) for words in hasher.each(data)]
        is_probe = np.asarray(table.column("is_probe"))
        reps, component = (np.asarray(table.column(n)) for n in ("rep", "component"))
        bases, probes = np.flatnonzero(~is_probe), np.flatnonzero(is_probe)
        lists = SketchLists([sets[j][:size] for j in bases], size, percent)
        lengths = np.array([len(sets[j]) for j in bases], np.int64)
        a, b = [], []
        for i in probes:
            own = sets[i]
            likely = lists.likely(own[:size], component[bases] != component[i])
            if not len(likely):
                continue
            values = np.concatenate([sets[j] for j in bases[likely]])
            at = np.minimum(np.searchsorted(own, values), len(own) - 1)
            owner = np.repeat(np.arange(len(likely)), lengths[likely])
            common = np.bincount(owner[own[at] == values], minlength=len(likely))
            linked = 100 * common >= percent * (len(own) + lengths[likely] - common)
            met = set()
            for j in bases[likely[linked]]:
                if component[j] not in met:
                    mine, other = (shingles_of(data[k].split(), width) for k in (i, j))
                    shared = len(mine & other)
                    if 100 * shared >= percent * (len(mine) + len(other) - shared):
                        met.add(component[j])
                        a.append(min(reps[i], reps[j]))
                        b.append(max(reps[i], reps[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    both = dealt(open_.where(probe), "probes", "bases").union(dealt(open_, "bases", "probes"))
    linked = (
        both.join(texts.withColumnRenamed("doc_id", "rep"), "rep")
        .groupBy("hub", "p", "b")
        .applyInArrow(compare, "a LONG, b LONG")
    )
    return saved(spark, linked, "inside")


def _list_pairs(
    spark: SparkSession,
    classes: DataFrame,
    clusters: DataFrame,
    components: DataFrame,
    size: int,
    percent: int,
) -> DataFrame:
    """``(a, b)`` of different components and clusters that meet in an inverted list."""
    values = classes.select("rep", "n", F.explode("sketch").alias("value"))
    shared = saved(
        spark,
        values.groupBy("value")
        .agg(F.count(F.lit(1)).alias("df"))
        .where(F.col("df") > 1),
        "frequencies",
    )
    # Values of one class come first in its prefix and lead nowhere: only their
    # number counts, which is what is missing of the sketch.
    ranked = (
        values.join(shared, "value")
        .groupBy("rep", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"))
    )
    alone = F.least("n", F.lit(size)) - F.size("shared")
    length = F.greatest(prefix_length(F.col("n"), size, percent) - alone, F.lit(0))
    listed = ranked.select(
        "rep", "n", F.explode(F.slice("shared", F.lit(1), length.cast("int"))).alias("at")
    ).select("rep", "n", F.col("at.value").alias("value"))
    lists = saved(
        spark,
        listed.join(components.withColumnRenamed("id", "rep"), "rep", "left")
        .join(clusters, "rep", "left")
        .select(
            "value",
            "rep",
            "n",
            F.coalesce("component", "rep").alias("component"),
            F.coalesce("hub", "rep").alias("hub"),
        ),
        "lists",
    )
    # A value that one component alone lists pairs nothing.
    useful = saved(
        spark,
        lists.groupBy("value")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where(F.col("low") < F.col("high"))
        .select("value"),
        "useful",
    )
    # A pair comes out at the first value that both list: no earlier one in common.
    own = ["rep", "n", "component", "hub"]
    values = F.array_sort(F.collect_set("value")).alias("values")
    kept = saved(
        spark,
        lists.join(useful, "value", "left_semi")
        .groupBy(*own)
        .agg(values)
        .select(*own, "values", F.posexplode("values").alias("at", "value"))
        .select(*own, "value", F.slice("values", F.lit(1), F.col("at")).alias("earlier")),
        "lists",
    )
    left, right = kept.alias("left"), kept.alias("right")
    return (
        left.join(
            right,
            (F.col("left.value") == F.col("right.value"))
            & (F.col("left.rep") < F.col("right.rep"))
            & (F.col("left.component") != F.col("right.component"))
            & (F.col("left.hub") != F.col("right.hub"))
            & (F.col("left.n") * 100 >= F.col("right.n") * percent)
            & (F.col("right.n") * 100 >= F.col("left.n") * percent)
            & ~F.arrays_overlap("left.earlier", "right.earlier"),
        )
        .select(F.col("left.rep").alias("a"), F.col("right.rep").alias("b"))
        .distinct()
    )


def _estimated(
    spark: SparkSession, classes: DataFrame, pairs: DataFrame, percent: int, size: int
) -> DataFrame:
    """Pairs with the values of their union's sketch, and how many both hold.

    ``likely`` says whether that rules a similar pair out. Pairs with less than
    ``CLUSTER_SHARE`` in common are left out: they are neither.
    """
    pairs = saved(spark, pairs, "pairs")
    sketch = classes.select("rep", "n", "sketch")
    both = (
        pairs.join(sketch.toDF("a", "n_a", "sketch_a"), "a")
        .join(sketch.toDF("b", "n_b", "sketch_b"), "b")
    )
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, size)
    overlap = F.size(F.array_intersect(union, F.array_intersect("sketch_a", "sketch_b")))
    # Whole sets in both sketches: the estimate is exact. Otherwise allow for chance.
    least = F.when(
        F.size(F.array_union("sketch_a", "sketch_b")) <= size,
        F.size(union) * percent / 100 - 1e-6,
    ).otherwise(F.lit(float(least_overlap(size, percent))))
    made = both.select(
        "a",
        "b",
        overlap.alias("overlap"),
        F.size(union).alias("values"),
        (overlap >= least).alias("likely"),
    )
    near = F.col("likely") | (F.col("overlap") >= CLUSTER_SHARE * F.col("values"))
    return saved(spark, made.where(near), "estimated")


def _likely(spark: SparkSession, estimated: DataFrame) -> DataFrame:
    """The pairs that the sketch of their union does not rule out."""
    return saved(spark, estimated.where("likely").select("a", "b"), "likely")


def _confirmed(
    spark: SparkSession, docs: DataFrame, likely: DataFrame, width: int, percent: int
) -> DataFrame:
    """The pairs of classes whose shingle sets are similar enough, as ``(a, b)``."""
    ends = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
    texts = saved(spark, rows_of(docs, saved(spark, ends, "ends")).distinct(), "texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last = None, set()
        for batch in sliced(batches):
            a, b = [], []
            for id_a, id_b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns)):
                if last_text is None or text_a != last_text:
                    last_text, last = text_a, shingles_of(words_of(text_a), width)
                other = shingles_of(words_of(text_b), width)
                common = len(last & other)
                if 100 * common >= percent * (len(last) + len(other) - common) > 0:
                    a.append(id_a)
                    b.append(id_b)
            yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    checked = (
        likely.join(texts.toDF("b", "text_b"), "b")
        .join(texts.toDF("a", "text_a"), "a")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(run, "a LONG, b LONG")
        .distinct()
    )
    return saved(spark, checked, "confirmed")
