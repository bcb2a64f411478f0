"""SimHash near duplicates by multi-index hashing, and their components.

Every distinct fingerprint is filed in a table under its upper half. Two fingerprints within two bits differ in
at most one bit of their upper halves, or not at all in their lower halves. So the upper table is searched with
the small Hamming ball around each upper half (radius one), the lower table with the lower half alone, and what
the tables return is verified over all 64 bits. Of a pair whose upper halves differ, only the side with the
cleared bit looks for the other, so each pair is met once.

A table entry with very many fingerprints is not compared pair by pair: its fingerprints look up the whole ball
around themselves instead, which is exact and has at most 2,080 members, however many share the entry.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.llm.batches import map_texts, stored
from candlegrid.llm.words import mix

BITS = 2
#: Fingerprints that may share a table entry and still be compared with each other.
CROWD = 512
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# fixed values: A-Z to a-z and nothing else
_LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint_of(text: str | None, size: int = 3) -> int:
    """Bits set in over half of the XXH64 values of the text's shingles; zero without words."""
    words = _WORDS.findall(text.translate(_LOWER)) if text else []
    if not words:
        return 0
    if len(words) < size:
        shingles = [" ".join(words)]
    else:
        shingles = map(" ".join, zip(*[words[i:] for i in range(size)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(s, 42) for s in shingles], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the values have."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: id, what `keep` names, fingerprint as a signed 64-bit integer."""

    def make():
        def apply(texts):
            made = np.array([fingerprint_of(t, size) for t in texts], np.uint64)
            return [made.view(np.int64)]

        return apply

    return map_texts(docs, make, [T.StructField("fingerprint", T.LongType())], id_col, text_col, keep)


def _differ(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of the given distinct fingerprints (one column, fp) that differ in one or two bits, each at least once."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    high = F.shiftrightunsigned("fp", 32)
    halves = distinct.select("fp", high.alias("high"), low.alias("low"))
    crowded_high = halves.groupBy("high").count().where(F.col("count") > CROWD).select("high")
    crowded_low = halves.groupBy("low").count().where(F.col("count") > CROWD).select("low")

    # upper halves: the ball of radius one, outwards by cleared bits only
    masks = F.array(*[F.lit(1 << i).cast("long") for i in range(32)])
    ball = F.filter(masks, lambda bit: F.col("high").bitwiseAND(bit) == 0)
    around = F.concat(F.array(F.col("high")), F.transform(ball, lambda bit: F.col("high").bitwiseOR(bit)))
    calm_high = halves.join(crowded_high, "high", "left_anti")
    probes = calm_high.select(F.col("fp").alias("a"), F.explode(around).alias("key"))
    filed = calm_high.select(F.col("fp").alias("b"), F.col("high").alias("key"))
    by_high = probes.join(filed, "key").where(_differ(F.col("a"), F.col("b")).between(1, BITS)).select("a", "b")

    # lower halves: equal, with an upper half two bits away
    calm_low = halves.join(crowded_low, "low", "left_anti")
    one, two = calm_low.select(F.col("fp").alias("a"), "low"), calm_low.select(F.col("fp").alias("b"), "low")
    by_low = one.join(two, "low").where((F.col("a") < F.col("b")) & _differ(F.col("a"), F.col("b")).between(1, BITS)).select("a", "b")

    # crowded entries: every neighbour by its whole value
    crowd = halves.join(crowded_high, "high", "left_semi").select("fp").union(halves.join(crowded_low, "low", "left_semi").select("fp")).distinct()
    return by_high.union(by_low).union(crowd_links(crowd, distinct))


def crowd_links(crowd: DataFrame, distinct: DataFrame) -> DataFrame:
    masks = [1 << i for i in range(64)]
    masks += [a | b for a, b in itertools.combinations(masks, 2)]
    flips = np.array(masks, np.uint64).view(np.int64)

    def enumerate_ball(batches):
        for batch in batches:
            own = batch.column(0).to_numpy()
            for at in range(0, len(own), 64):
                part = own[at : at + 64]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part, len(flips))), pa.array((part[:, None] ^ flips[None, :]).ravel())], names=["a", "b"])

    return crowd.mapInArrow(enumerate_ball, "a long, b long").join(distinct.select(F.col("fp").alias("b")), "b", "left_semi").select("a", "b")


def components(pairs: DataFrame, most_rounds: int = 64) -> DataFrame:
    """Of links (a, b) between numbers: (node, root), root the smallest number of the node's component; linked nodes only.

    Each round, every node's greater neighbours are hung on its least neighbour, then its lesser ones are; stars
    are left when nothing changes. Both steps are group-bys on the node; the minimum is taken before the
    neighbours are met again by a join, so that no group is gathered. Each round is written to the shared folder.
    """
    edges = stored(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: greater neighbours to the least of the neighbourhood
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: the node and its lesser neighbours to the least of these
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small_least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = stored(small, "links")
        changed = new.exceptAll(edges).limit(1).count() + edges.exceptAll(new).limit(1).count()
        edges = new
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, fingerprint (signed 64-bit), component_id, the smallest id reachable over links.

    Equal fingerprints are linked, and those that differ in one or two bits. Null and empty texts and texts of
    white space have fingerprint zero and link like any other. Null ids keep their row and give no component_id to
    others; a component of null ids alone has none. Repeated rows each keep their row; other columns are ignored.
    """
    printed = stored(fingerprints(docs, size, id_col, text_col).withColumnRenamed(id_col, "_id"), "fingerprints")
    least = printed.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("_id").alias("least"))
    roots = components(links(least.select("fp")))
    placed = least.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return printed.join(named, "fingerprint").select(F.col("_id").alias(id_col), "fingerprint", "component_id")


def hexadecimal(fingerprint: Column) -> Column:
    """16 lowercase digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


# ---- a higher tolerance: similarity of word shingles ----

#: Fingerprints over a sample of shingles, shingles in a sample, and 64-bit numbers of parities.
TABLES, SAMPLE, PARITIES = 8, 3, 8


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of the text's shingles, in their order; none without words."""
    words = _WORDS.findall(text.translate(_LOWER)) if text else []
    if not words:
        return np.zeros(0, np.uint64)
    shingles = [" ".join(words)] if len(words) < size else map(" ".join, zip(*[words[i:] for i in range(size)], strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(s, 42) for s in shingles], np.uint64)


def parities(distinct: np.ndarray) -> np.ndarray:
    """Distinct hashes dealt to 64 * PARITIES places: a bit per place, whether it got an odd number.

    Where two texts differ in a bit, one of them has a hash that the other lacks, so bits that differ never
    outnumber hashes that differ.
    """
    odd = np.bincount((distinct % np.uint64(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def signature_of(text: str | None, size: int) -> tuple[int, list[int], int, np.ndarray]:
    """SimHash of all shingles; SimHashes of TABLES samples, each of the SAMPLE shingles that come first under a seed of
    its own; the number of distinct shingles and the parities of their hashes."""
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return 0, [], 0, parities(hashes)
    distinct = np.unique(hashes)
    samples = []
    for table in range(TABLES):
        order = mix(distinct ^ np.uint64((table + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        first = np.argpartition(order, SAMPLE - 1)[:SAMPLE] if len(order) > SAMPLE else np.arange(len(order))
        samples.append(majority(distinct[first]))
    return majority(hashes), samples, len(distinct), parities(distinct)


def _possible(x: str, y: str, threshold: float) -> Column:
    """Whether the sizes and parities of columns x and y (structs of n and odd) allow a similarity of threshold."""
    apart = F.aggregate(F.zip_with(f"{x}.odd", f"{y}.odd", lambda a, b: _differ(a, b)), F.lit(0), lambda n, d: n + d)
    apart = F.greatest(F.abs(F.col(f"{x}.n") - F.col(f"{y}.n")), apart)
    # similar sets differ in at most (1 - t) of their union, which is half of both sizes and the difference
    return apart * (1 + threshold) <= (1 - threshold) * (F.col(f"{x}.n") + F.col(f"{y}.n")) + 1e-6


def _similar(pairs: DataFrame, texts: DataFrame, threshold: float, size: int) -> DataFrame:
    """Those of the pairs (a, b) of nodes whose full sets of shingles are similar; texts has node and _text.

    Only the texts of nodes in a pair are shuffled and hashed again.
    """
    pairs = stored(pairs, "proposed")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()

    def make():
        def apply(part):
            return [[np.unique(shingle_hashes(t, size)).view(np.int64) for t in part]]

        return apply

    asked = texts.join(wanted, "node", "left_semi").dropDuplicates(["node"])
    full = stored(map_texts(asked, make, [T.StructField("hashes", T.ArrayType(T.LongType()))], "node", "_text"), "shingles")
    both = pairs.join(full.select(F.col("node").alias("a"), F.col("hashes").alias("s")), "a").join(full.select(F.col("node").alias("b"), F.col("hashes").alias("t")), "b")
    shared = F.size(F.array_intersect("s", "t"))
    met = both.select("a", "b", shared.alias("shared"), (F.size("s") + F.size("t")).alias("n"))
    return met.where(F.col("shared") >= threshold * (F.col("n") - F.col("shared"))).select("a", "b")


def print_links(printed: DataFrame) -> DataFrame:
    """Links (a, b) between nodes (node, fp) by which all are reachable whose fingerprints are within BITS bits."""
    first = printed.groupBy("fp").agg(F.min("node").alias("least"))
    same = printed.join(first, "fp").where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    one, two = first.select(F.col("fp").alias("a"), F.col("least").alias("x")), first.select(F.col("fp").alias("b"), F.col("least").alias("y"))
    return same.union(links(first.select("fp")).join(one, "a").join(two, "b").select("x", "y"))


def similar_documents(docs: DataFrame, threshold: float = 0.8, size: int = 5, id_col: str = "doc_id", text_col: str = "text", prints: bool = False) -> DataFrame:
    """One row per distinct (id, text): id, node (a hash of the text) and group, the least node of those reachable.

    With prints, two texts are linked as in near_duplicates, by fingerprints over three-word shingles, repeats included, that are
    found by the two segments and differ in at most two bits. In any case they are linked if their sets of `size`-word shingles have a similarity of `threshold` or more, told from
    the hashes of all their distinct shingles. Whole fingerprints within two bits and equal sampled
    fingerprints propose pairs; of those that share a fingerprint, or have close ones, each is compared with
    one of them first, then all that are not in one group yet are compared with each other. A pair
    at 0.8 is proposed with a chance of over 0.99, one at 0.9 of over 0.9999. Equal texts have one node; texts
    without words are equal to each other.
    """
    columns = [
        T.StructField("own", T.LongType()),
        T.StructField("fp", T.LongType()),
        T.StructField("samples", T.ArrayType(T.LongType())),
        T.StructField("n", T.LongType()),
        T.StructField("odd", T.ArrayType(T.LongType())),
    ]

    def make():
        def apply(texts):
            told = [signature_of(t, size) for t in texts]
            return [
                np.array([fingerprint_of(t) for t in texts], np.uint64).view(np.int64),
                np.array([t[0] for t in told], np.uint64).view(np.int64),
                [np.array(t[1], np.uint64).view(np.int64) for t in told],
                np.array([t[2] for t in told], np.int64),
                [t[3] for t in told],
            ]

        return apply

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("node"), text.alias("_text"))
    told = stored(map_texts(rows, make, columns, "_id", "_text", ["node"]), "signatures")
    nodes = told.groupBy("node").agg(F.first("own").alias("own"), F.first("fp").alias("fp"), F.first("samples").alias("samples"), F.first(F.struct("n", "odd")).alias("set"))
    nodes = stored(nodes, "nodes")

    sampled = nodes.select("node", F.posexplode("samples").alias("table", "key"))
    meeting = sampled.groupBy("table", "key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    proposed = sampled.join(meeting, ["table", "key"]).select("a", F.col("node").alias("b"))
    of_print = nodes.groupBy("fp").agg(F.min("node").alias("a"))
    same = nodes.join(of_print, "fp").select("a", F.col("node").alias("b"))
    near = stored(links(of_print.select("fp")).distinct(), "near")
    one, two = of_print.select(F.col("fp").alias("a"), F.col("a").alias("x")), of_print.select(F.col("fp").alias("b"), F.col("a").alias("y"))
    within = near.join(one, "a").join(two, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    pairs = proposed.union(same).union(within).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    one, two = nodes.select(F.col("node").alias("a"), F.col("set").alias("x")), nodes.select(F.col("node").alias("b"), F.col("set").alias("y"))
    pairs = pairs.join(one, "a").join(two, "b").where(_possible("x", "y", threshold)).select("a", "b")
    texts = rows.select("node", "_text")
    found = _similar(pairs, texts, threshold, size)
    roots = components(found.union(print_links(nodes.select("node", F.col("own").alias("fp")))) if prints else found)

    # what meets without being reachable yet: all pairs, since those already in one group can't change the groups
    placed = nodes.join(roots, "node", "left").select(F.struct("node", F.coalesce("root", "node").alias("root"), "set.n", "set.odd").alias("x"), "fp", "samples")
    placed = stored(placed, "placed")
    filed = placed.select("x", F.posexplode("samples").alias("table", "key")).union(placed.select("x", F.lit(-1).alias("table"), F.col("fp").alias("key")))
    mixed = filed.groupBy("table", "key").agg(F.min("x.root").alias("least"), F.max("x.root").alias("most")).where("least <> most").select("table", "key")
    open_ = filed.join(mixed, ["table", "key"], "left_semi")
    # the members of a bucket's largest group meet only those of its other groups: pairs within it aren't formed
    sizes = open_.groupBy("table", "key", F.col("x.root").alias("of")).count()
    main = sizes.groupBy("table", "key").agg(F.max_by("of", F.struct("count", "of")).alias("main"))
    open_ = stored(open_.join(main, ["table", "key"]).withColumn("main", F.col("x.root") == F.col("main")), "mixed")
    rest, largest = open_.where(~F.col("main")).drop("main"), open_.where("main").drop("main")
    with_largest = rest.join(largest.withColumnRenamed("x", "y"), ["table", "key"]).select("x", "y")
    among = rest.join(rest.withColumnRenamed("x", "y"), ["table", "key"]).where("x.root < y.root").select("x", "y")
    in_one = with_largest.where(_possible("x", "y", threshold)).union(among.where(_possible("x", "y", threshold)))
    printed = placed.select("x", "fp")
    close = near.join(printed, F.col("a") == F.col("fp")).select("b", "x").join(printed.withColumnRenamed("x", "y"), F.col("b") == F.col("fp")).select("x", "y")
    left = in_one.union(close).where("x.root <> y.root").where(_possible("x", "y", threshold))
    left = left.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    more = _similar(left, texts, threshold, size)
    roots = components(more.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    return told.select("_id", "node").distinct().join(roots, "node", "left").select(F.col("_id").alias(id_col), "node", F.coalesce("root", "node").alias("group"))
