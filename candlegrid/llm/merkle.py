"""Merkle manifest of a dataset, with octopus multiproofs.

Leaves of one tree ascend by key; every two consecutive nodes become one, up to the tree's top. The tops in turn are the
leaves of the tree of trees. A table of millions of leaves is folded in blocks of 4,096 aligned leaves, their tops again
in blocks of 4,096, and so on, so that no task holds more than a block and there are as many rounds as the count has
digits to the base 4,096.

Proofs are made by leaf partition, a run of consecutive leaves of one tree. A partition works out from positions alone
which nodes it lacks: level by level, the siblings of what it has or can derive, each once. These coordinates are
fetched with a single join; the nodes that its leaves share are derived once, and every leaf's own proof is read off
locally.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlegrid.llm.batches import stored

#: Levels that a block folds, and levels below which the leaves of a partition lie side by side.
BLOCK, PARTITION = 12, 14
#: Rows of a result batch.
ROWS = 10_000
#: The name of the tree over all trees; a tree of documents is "=" and its language, or "-" without one.
ROOT = "/"


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def level_sizes(n: int) -> list[int]:
    """Nodes on each level of a tree of n leaves, the top last."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append((sizes[-1] + 1) // 2)
    return sizes


def fold(digests: list[str]) -> list[str]:
    """The level above: each two consecutive digests become the digest of both, a last one alone that of itself."""
    return [_digest("".join(digests[i : i + 2])) for i in range(0, len(digests), 2)]


def lacking(present: np.ndarray, sizes: list[int], level: int = 0) -> list[tuple[int, int]]:
    """Coordinates (level, index) that a set of nodes of one level needs to reach the top: siblings neither present nor derivable."""
    wanted = []
    have = np.unique(present)
    for at in range(level, len(sizes) - 1):
        beside = have ^ 1
        wanted += [(at, int(i)) for i in beside[(beside < sizes[at]) & ~np.isin(beside, have)]]
        have = np.unique(have >> 1)
    return wanted


def derived(leaves: dict[int, str], fetched: dict[tuple[int, int], str], sizes: list[int]) -> list[dict[int, str]]:
    """Per level the nodes that leaves and fetched ones give; each is hashed once."""
    levels = [dict(leaves)]
    for at in range(len(sizes) - 1):
        here = levels[-1]
        for (level, i), digest in fetched.items():
            if level == at:
                here[i] = digest
        above = {}
        for i in {i >> 1 for i in here}:
            told = [here[j] for j in (2 * i, 2 * i + 1) if j < sizes[at]]
            above[i] = _digest("".join(told))
        levels.append(above)
    return levels


def siblings(levels: list[dict[int, str]], sizes: list[int], position: int) -> list[str]:
    """The digests beside a leaf's path, from below; a level where the node stands alone has none and gives ""."""
    out = []
    for at in range(len(sizes) - 1):
        out.append(levels[at][position ^ 1] if (position ^ 1) < sizes[at] else "")
        position >>= 1
    return out


def folded(leaf: str, position: int, beside: list[str]) -> str:
    """The top that a leaf and its siblings give."""
    for other in beside:
        leaf = _digest(other + leaf if position & 1 else leaf + other)
        position >>= 1
    return leaf


# ---- positions ----


def numbered(frame: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """The frame with `position` in its group from 0, and `n`, the group's size; rows equal in `order` stand in any order.

    The group column holds no null. Rows are dealt out by range, so that a group of any size spreads over tasks; each task numbers its run, and only
    the sizes of runs (one row per task and group) meet in a window. Written to the shared folder once.
    """
    keys = [F.col(group), *order, F.monotonically_increasing_id()]
    spread = frame.withColumn("_group", F.col(group)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    spread = spread.withColumn("_run", F.spark_partition_id()).withColumn("_place", F.lit(0).cast("long"))
    at, schema = spread.columns.index("_group"), spread.schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            told = pc.run_end_encode(batch.column(at))
            names, ends = told.values.to_pylist(), told.run_ends.to_pylist()
            places = np.empty(batch.num_rows, np.int64)
            start = 0
            for name, end in zip(names, ends, strict=True):
                if (name,) != last:
                    last, done = (name,), 0
                places[start:end] = np.arange(done, done + end - start)
                done += end - start
                start = end
            yield batch.set_column(batch.num_columns - 1, "_place", pa.array(places))

    rows = stored(spread.mapInArrow(count, schema), "numbered")
    runs = rows.groupBy("_group", "_run").agg(F.count(F.lit(1)).alias("_held"))
    before = Window.partitionBy("_group").orderBy("_run")
    runs = runs.select(
        "_group",
        "_run",
        (F.sum("_held").over(before) - F.col("_held")).alias("_before"),
        F.sum("_held").over(Window.partitionBy("_group")).alias("n"),
    )
    return rows.join(runs, ["_group", "_run"]).withColumn("position", F.col("_place") + F.col("_before")).drop("_group", "_run", "_place", "_before")


# ---- nodes ----

_NODES = "tree string, n long, level int, position long, digest string"


def _fold_blocks(batches: Iterator[pa.RecordBatch], base: int, block: int, inner: bool) -> Iterator[pa.RecordBatch]:
    """Rows (tree, n, position, digest) of whole blocks, in order: their nodes above, or only the uppermost."""

    def nodes(tree, n, first, digests):
        height = len(level_sizes(n)) - 1
        for up in range(1, block + 1):
            if base + up > height:
                break
            digests, first = fold(digests), first >> 1
            if inner or up == block or base + up == height:
                for i, digest in enumerate(digests):
                    yield tree, n, base + up, first + i, digest

    def groups():
        key, held, first, n = None, [], 0, 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for tree, size, position, digest in zip(*columns, strict=True):
                if (tree, position >> block) != key:
                    if held:
                        yield key[0], n, first, held
                    key, held, first, n = (tree, position >> block), [], position, size
                held.append(digest)
        if held:
            yield key[0], n, first, held

    rows = []
    for group in groups():
        rows += nodes(*group)
        while len(rows) >= ROWS:
            yield _batch(rows[:ROWS], _KINDS)
            rows = rows[ROWS:]
    if rows:
        yield _batch(rows, _KINDS)


_KINDS = [("tree", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("position", pa.int64()), ("digest", pa.string())]


def _batch(rows: list[tuple], kinds: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[n for n, _ in kinds])


def build(leaves: DataFrame, block: int = BLOCK, whole: bool = False) -> DataFrame:
    """Nodes (tree, n, level, position, digest) from leaves (tree, n, position, digest).

    Of the first blocks only the tops are kept, of all further ones every node: what proofs of whole blocks need, about a
    2,048th of the leaves. `whole` keeps the leaves and all nodes. There are as many rounds as the largest n has digits
    to the base 2 ** block.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    height = len(level_sizes(most)) - 1 if most else 0
    columns = ("tree", "n", "level", "position", "digest")
    nodes = leaves.where(F.lit(whole) | (F.col("n") == 1)).withColumn("level", F.lit(0)).select(*columns)
    level = leaves
    for base in range(0, height, block):
        told = level.select("tree", "n", "position", "digest").repartition("tree", F.shiftright("position", block)).sortWithinPartitions("tree", "position")

        def run(batches, base=base):
            return _fold_blocks(batches, base, block, whole or base > 0)

        made = stored(told.mapInArrow(run, _NODES), "nodes")
        nodes = nodes.unionByName(made)
        level = made.where(F.col("level") == base + block)
    return nodes


def tops(nodes: DataFrame) -> DataFrame:
    """(tree, digest): the uppermost node of each tree."""
    height = F.length(F.bin(F.col("n") - 1)) - (F.col("n") == 1).cast("int")
    return nodes.where(F.col("level") == height).select("tree", "digest")


# ---- documents ----

#: Columns that a leaf tells, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_text(told: dict[str, Column]) -> Column:
    """What is hashed of a row: per field `-` if null, else its length in bytes, a colon and its value."""
    parts = []
    for name in FIELDS:
        value = told[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.concat(*parts)


def _hash(told: dict[str, Column]) -> Column:
    return F.sha2(F.encode(leaf_text(told), "UTF-8"), 256)


def manifest(docs: DataFrame, tampered_every: int = 7, block: int = BLOCK, partition: int = PARTITION) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, siblings (array of digests, from below, without gaps),
    folded_root (from the tampered leaf if there is one) and verified.

    A tree per language, null a language of its own, first; languages in the order of their UTF-8 bytes. Leaves
    ascend by doc_id, null first; of rows with one doc_id the lesser leaf comes first, equal rows have a place each.
    Tampering adds 1 to n_chars where `tampered_every` divides the CRC-32 of the decimal doc_id; rows without doc_id
    or n_chars stay. Null and empty fields differ; texts of any length are hashed by the JVM where they lie, and
    only digests are shuffled. Columns besides the five of a leaf are ignored; an empty table gives no rows.
    """
    own = {name: F.col(name) for name in FIELDS}
    hit = (F.crc32(F.col("doc_id").cast("string")) % tampered_every == 0) & F.col("n_chars").isNotNull()
    rows = docs.select(
        F.col("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-")).alias("tree"),
        _hash(own).alias("digest"),
        F.when(hit, _hash({**own, "n_chars": F.col("n_chars").cast("long") + 1})).alias("tampered"),
    )
    leaves = numbered(rows, "tree", [F.col("doc_id").asc_nulls_first(), F.col("digest")])
    leaves = stored(leaves.select("tree", "n", "position", "doc_id", "digest", "tampered"), "leaves")
    nodes = build(leaves, block)
    subroots = stored(tops(nodes), "subroots")
    # "-" sorts before "=", so null comes first
    above = numbered(subroots.select(F.lit(ROOT).alias("root_tree"), "tree", "digest"), "root_tree", [F.col("tree")])
    above = stored(above.select(F.col("root_tree").alias("tree"), "n", "position", "digest", F.col("tree").alias("of")), "above")
    # the tree of trees is looked into from single leaves, so all its nodes are kept
    nodes = nodes.unionByName(build(above.select("tree", "n", "position", "digest"), block, whole=True))

    parts = leaves.groupBy("tree", "n", F.shiftright("position", partition).alias("part")).agg(F.count(F.lit(1)).alias("held"))
    parts = parts.join(above.select(F.col("of").alias("tree"), F.col("n").alias("trees"), F.col("position").alias("rank")), "tree")
    wanted = parts.mapInArrow(_requests(partition), "tree string, part long, of string, level int, position long")
    fetched = wanted.join(nodes.select(F.col("tree").alias("of"), "level", "position", "digest"), ["of", "level", "position"])
    placed = parts.select("tree", "part", "n", "trees", "rank")
    message = fetched.select("tree", "part", "of", "level", "position", F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "digest", F.lit(None).cast("string").alias("tampered"))
    own_rows = leaves.select("tree", F.shiftright("position", partition).alias("part"), F.lit(None).cast("string").alias("of"), F.lit(-1).alias("level"), "position", "doc_id", "digest", "tampered")
    sizes = placed.select(
        "tree",
        "part",
        F.lit("").alias("of"),
        F.lit(-2).alias("level"),
        F.col("n").alias("position"),
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.concat_ws(",", "trees", "rank").alias("digest"),
        F.lit(None).cast("string").alias("tampered"),
    )
    # a partition's rows in order: its sizes, what was fetched, then its leaves
    kind = F.when(F.col("level") == -2, 0).when(F.col("of").isNotNull(), 1).otherwise(2)
    together = sizes.union(message).union(own_rows).withColumn("kind", kind).repartition("tree", "part").sortWithinPartitions("tree", "part", "kind", "position")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return together.mapInArrow(
        _proofs(partition),
        f"doc_id {id_type}, leaf string, subroot string, root string, siblings array<string>, folded_root string, verified boolean",
    )


def _requests(partition: int):
    """Per leaf partition the coordinates that it lacks, in its own tree and in the tree of trees."""
    kinds = [("tree", pa.string()), ("part", pa.int64()), ("of", pa.string()), ("level", pa.int32()), ("position", pa.int64())]

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                sizes = level_sizes(r["n"])
                # a whole run of leaves derives everything up to its own top, which lies on this level
                level = min(partition, len(sizes) - 1)
                rows += [(r["tree"], r["part"], r["tree"], *at) for at in lacking(np.array([r["part"]]), sizes, level)]
                rows += [(r["tree"], r["part"], ROOT, *at) for at in lacking(np.array([r["rank"]]), level_sizes(r["trees"]))]
            for at in range(0, len(rows), ROWS):
                yield _batch(rows[at : at + ROWS], kinds)

    return run


def _proofs(partition: int):
    """Rows of leaf partitions to proofs, checked against the root."""

    def groups(batches):
        key, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["tree"], row["part"]) != key:
                    if held:
                        yield held
                    key, held = (row["tree"], row["part"]), []
                held.append(row)
        if held:
            yield held

    def prove(rows):
        head, tree = rows[0], rows[0]["tree"]
        sizes = level_sizes(head["position"])
        trees, rank = map(int, head["digest"].split(","))
        root_sizes = level_sizes(trees)
        fetched = {(r["level"], r["position"]): r["digest"] for r in rows if r["of"] == tree}
        root_fetched = {(r["level"], r["position"]): r["digest"] for r in rows if r["of"] == ROOT}
        own = [r for r in rows if r["of"] is None]
        levels = derived({r["position"]: r["digest"] for r in own}, fetched, sizes)
        subroot = levels[-1][0]
        root_levels = derived({rank: subroot}, root_fetched, root_sizes)
        root = root_levels[-1][0]
        root_beside = siblings(root_levels, root_sizes, rank)
        for r in own:
            beside = siblings(levels, sizes, r["position"])
            top = folded(folded(r["tampered"] or r["digest"], r["position"], beside), rank, root_beside)
            yield r["doc_id"], r["digest"], subroot, root, [b for b in [*beside, *root_beside] if b], top, top == root

    def run(batches):
        kinds = None
        rows = []
        for group in groups(_noting(batches, seen := {})):
            kinds = kinds or [
                ("doc_id", seen["doc_id"]),
                ("leaf", pa.string()),
                ("subroot", pa.string()),
                ("root", pa.string()),
                ("siblings", pa.list_(pa.string())),
                ("folded_root", pa.string()),
                ("verified", pa.bool_()),
            ]
            for row in prove(group):
                rows.append(row)
                if len(rows) == ROWS:
                    yield _batch(rows, kinds)
                    rows = []
        if rows:
            yield _batch(rows, kinds)

    return run


def _noting(batches, seen: dict):
    for batch in batches:
        seen.setdefault("doc_id", batch.schema.field("doc_id").type)
        yield batch


def proof_digests(proved: DataFrame) -> DataFrame:
    """Of manifest()'s rows: the siblings as one SHA-256."""
    return proved.select("doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "siblings").cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")
