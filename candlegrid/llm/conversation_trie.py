"""The prefix trie of conversations, by union-find over sorted neighbours.

A conversation is a path of turn digests. Paths are sorted, so that conversations with a common beginning are
neighbours, and the length of the common beginning of two neighbours is an edge between them. Edges are taken in
descending depth: the two components of an edge merge in a branching node at its depth, and what a component has
above that depth, down from its own node, is a chain of nodes that is complete and can leave.

Runs of sorted paths are worked on apart. The first and the last path of a run may go on in its neighbours, so a run is
contracted to these two, each with what hangs from it by depth, and the contracted paths of many runs are
sorted and merged in the same way, until a class of paths fits one run.

A path is cut into chunks of `CHUNK` turns. The chunks that follow one and the same beginning are a class with a trie of
its own, rooted in that beginning's last node, so that neither a row nor a comparison grows with a conversation. Classes
of one conversation are chains; the others are worked on from the deepest chunk upwards, each handing its totals to
the node that it is rooted in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlegrid.llm.batches import stored
from candlegrid.llm.merkle import numbered

#: Turns of a chunk; paths of a run; contracted paths from which on runs are contracted again.
CHUNK, RUN, FEW = 256, 2_000, 4_000
#: Bytes of a turn's digest and of a node's id.
DIGEST = 16
#: First turns that conversations of one group of five may share.
HEAD = 9

_NODE = "id binary, parent binary, parent_conv long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long"
_HUNG = "array<struct<depth:int,n:long,least:long,children:long,leaves:long,saved:long>>"
_ENTRY = f"cls binary, path binary, sizes array<long>, hung {_HUNG}"
#: A node, a contracted path, or a class's totals (a path of no turns).
_OUT = f"kind int, {_NODE}, {_ENTRY}"


# ---- one run ----


def node_id(cls: bytes, path: bytes) -> bytes:
    return hashlib.sha256(cls + path).digest()[:DIGEST]


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with alike."""
    low, high = 0, min(len(a), len(b)) // DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * DIGEST] == b[: middle * DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


class Path:
    """A path and what hangs from its nodes by depth: (conversations, least id, children, childless nodes, saved)."""

    def __init__(self, path: bytes, sizes: list[int], hung: dict[int, tuple]):
        self.path, self.sizes, self.hung = path, sizes, hung

    def hang(self, depth: int, told: tuple) -> None:
        own = self.hung.get(depth)
        if own:
            told = (own[0] + told[0], min(own[1], told[1]), own[2] + told[2], own[3] + told[3], own[4] + told[4])
        self.hung[depth] = told

    def take(self, other: Path) -> None:
        for depth, told in other.hung.items():
            self.hang(depth, told)

    def rise(self, cls: bytes, offset: int, to: int) -> Iterator[tuple]:
        """Completes the nodes deeper than `to`, and hangs the lowest of them there as a child."""
        deepest = max(self.hung)
        if deepest <= to:
            return
        waiting = None
        for depth in range(deepest, to, -1):
            n, least, children, leaves, saved = self.hung.pop(depth)
            saved += (n - 1) * self.sizes[depth - 1]
            if not children:
                leaves = 1
            if waiting:
                yield (*waiting[:2], least, *waiting[3:])
            above = node_id(cls, self.path[: (depth - 1) * DIGEST]) if depth > 1 else cls
            waiting = (node_id(cls, self.path[: depth * DIGEST]), above, None, least, offset + depth, n, children, leaves, saved)
            self.hang(depth - 1, (n, least, 1, leaves, saved))
        # who the parent of the last one is called after is known once its own node is complete
        yield waiting


def merge_run(cls: bytes, paths: list[Path], offset: int, open_: bool) -> tuple[list[tuple], list[Path]]:
    """Nodes of sorted paths of one class that are complete, and what is left: the first and last path of an open run,
    a path that holds the class's totals at depth 0 otherwise."""
    nodes: list[tuple] = []
    edges = sorted(((common_turns(a.path, b.path), i) for i, (a, b) in enumerate(zip(paths, paths[1:], strict=False))), key=lambda e: -e[0])
    above = list(range(len(paths)))
    first, last = paths[0], paths[-1]
    component = list(paths)

    def find(i: int) -> int:
        while above[i] != i:
            above[i] = above[above[i]]
            i = above[i]
        return i

    for depth, i in edges:
        x, y = find(i), find(i + 1)
        left, right = component[x], component[y]
        if open_ and left is first and right is last:
            continue
        for side in (left, right):
            if not (open_ and (side is first or side is last)):
                nodes += side.rise(cls, offset, depth)
        kept, other = (right, left) if open_ and right is last else (left, right)
        kept.take(other)
        above[y] = x
        component[x] = kept
    if open_:
        return nodes, [first] if first is last else [first, last]
    top = component[find(0)]
    nodes += top.rise(cls, offset, 0)
    return nodes, [top]


def _runs(offset: int, size: int | None):
    """Rows (cls, path, sizes, hung) in order to rows of _OUT; runs of `size` paths, or one per class."""

    def row_of(kind, cls, path):
        hung = [dict(zip(("depth", "n", "least", "children", "leaves", "saved"), (d, *told), strict=True)) for d, told in sorted(path.hung.items())]
        return (kind, *[None] * 9, cls, path.path if kind == 1 else b"", path.sizes if kind == 1 else [], hung)

    def worked(held, whole):
        """held: (class, paths) in order; the outer classes of a run may go on beyond it."""
        for at, (cls, paths) in enumerate(held):
            open_ = not whole and at in (0, len(held) - 1)
            nodes, left = merge_run(cls, paths, offset, open_)
            for node in nodes:
                yield (0, *node, None, None, None, None)
            for path in left:
                yield row_of(1 if open_ else 2, cls, path)

    def run(batches):
        held, count, rows = [], 0, []
        for batch in batches:
            for r in batch.to_pylist():
                if size is None and held and held[-1][0] != r["cls"]:
                    rows += worked(held, True)
                    held, count = [], 0
                elif size is not None and count >= size:
                    rows += worked(held, False)
                    held, count = [], 0
                if not held or held[-1][0] != r["cls"]:
                    held.append((r["cls"], []))
                held[-1][1].append(Path(r["path"], r["sizes"], {h["depth"]: (h["n"], h["least"], h["children"], h["leaves"], h["saved"]) for h in r["hung"]}))
                count += 1
                while len(rows) >= 5_000:
                    yield _batch(rows[:5_000])
                    rows = rows[5_000:]
        if held:
            rows += worked(held, size is None)
        for at in range(0, len(rows), 5_000):
            yield _batch(rows[at : at + 5_000])

    return run


_HUNG_ARROW = pa.list_(pa.struct([("depth", pa.int32()), *[(n, pa.int64()) for n in ("n", "least", "children", "leaves", "saved")]]))
_ARROW = [("kind", pa.int32()), ("id", pa.binary()), ("parent", pa.binary())]
_ARROW += [(n, pa.int64()) for n in ("parent_conv", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")]
_ARROW += [("cls", pa.binary()), ("path", pa.binary()), ("sizes", pa.list_(pa.int64())), ("hung", _HUNG_ARROW)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows, strict=True), _ARROW, strict=True)], names=[n for n, _ in _ARROW])


def merged(entries: DataFrame, offset: int, run: int = RUN, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """Nodes of the tries of paths (cls, path, sizes, hung), and per class its totals at the root.

    A round leaves at most four paths of each run. Rounds end with `few` paths, or when runs no longer shrink.
    """
    order = ("cls", "path")
    nodes, totals, left = [], [], entries.select("cls", "path", "sizes", "hung")
    count, before = left.count(), None
    while count > few and (before is None or 2 * count <= before):
        # the first round spreads over all tasks, further ones over as many as there are runs to fill
        spread = left.repartitionByRange(*order) if before is None else left.repartitionByRange(-(-count // (16 * run)), *order)
        done = stored(spread.sortWithinPartitions(*order).mapInArrow(_runs(offset, run), _OUT), "trie")
        nodes.append(done.where("kind = 0"))
        totals.append(done.where("kind = 2"))
        left = done.where("kind = 1").select("cls", "path", "sizes", "hung")
        before, count = count, left.count()
    done = stored(left.repartition("cls").sortWithinPartitions(*order).mapInArrow(_runs(offset, None), _OUT), "trie")
    nodes.append(done.where("kind = 0"))
    totals.append(done.where("kind = 2"))
    columns = [c.split(" ")[0] for c in _NODE.split(", ")]
    all_nodes, all_totals = nodes[0], totals[0]
    for n, t in zip(nodes[1:], totals[1:], strict=True):
        all_nodes, all_totals = all_nodes.union(n), all_totals.union(t)
    return all_nodes.select(*columns), all_totals.select("cls", F.col("hung")[0].alias("told"))


# ---- conversations ----


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ids, turns): every conversation's id, and turns (conv_id, n, position, digest, size) after rebuilding.

    digest: 32 hexadecimal digits that tell role and text; size: bytes of the text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        F.substring(F.sha2(F.encode(told, "UTF-8"), 256), 1, 2 * DIGEST).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    placed = numbered(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")]).drop("n")
    shared = F.crc32(F.col("conv_id").cast("string")) % HEAD
    ids = placed.where("position = 0").select("conv_id")
    heads = placed.where(F.col("position") < HEAD).select(F.col("conv_id").alias("base"), "position", "digest", "size")
    copies = ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base").where(F.col("position") < shared)
    own = placed.where(F.col("position") >= shared)
    columns = ("conv_id", "part", F.col("position").alias("was"), "digest", "size")
    rows = copies.withColumn("part", F.lit(0)).select(*columns).union(own.withColumn("part", F.lit(1)).select(*columns))
    return ids, numbered(rows, "conv_id", [F.col("part"), F.col("was")]).select("conv_id", "n", "position", "digest", "size")


def chunks(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(cls, tail, k, path, sizes, conv_id, last): a row per conversation and chunk; tail is the id of its last node, cls of the one before its first."""
    part = F.floor(F.col("position") / chunk).cast("long")
    told = turns.groupBy("conv_id", part.alias("k"), "n").agg(F.array_sort(F.collect_list(F.struct("position", "digest", "size"))).alias("turns"))
    rows = told.select(
        F.lit(b"").alias("cls"),
        F.lit(b"").alias("tail"),
        "k",
        F.unhex(F.array_join("turns.digest", "")).alias("path"),
        F.col("turns.size").alias("sizes"),
        "conv_id",
        ((F.col("k") + 1) * chunk >= F.col("n")).alias("last"),
    )

    def link(batches):
        conv, tail = None, b""
        for batch in batches:
            before, after = [], []
            for c, path in zip(batch.column(5).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if c != conv:
                    conv, tail = c, b""
                before.append(tail)
                tail = node_id(tail, path)
                after.append(tail)
            yield pa.RecordBatch.from_arrays([pa.array(before, pa.binary()), pa.array(after, pa.binary()), *batch.columns[2:]], names=batch.schema.names)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "k").mapInArrow(link, rows.schema)


def _ends(ended: DataFrame) -> DataFrame:
    """(id, ends_sha256) from (id, conv_id): ids in order are hashed as they pass, so a node of any size holds one state."""

    def run(batches):
        node, state, rows = None, None, []
        for batch in batches:
            for at, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if at != node:
                    if state:
                        rows.append((node, state.hexdigest()))
                    node, state = at, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.binary(), pa.string()), strict=True)], names=["id", "ends_sha256"])
                rows = []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["id", "ends_sha256"])

    return ended.select("id", "conv_id").repartition("id").sortWithinPartitions("id", "conv_id").mapInArrow(run, "id binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, chunk: int = CHUNK, run: int = RUN, few: int = FEW) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt first: up to eight turns of each group of five come from the first of the group. Turns
    are ordered by number, null first, of one number by digest; null role or text counts as empty; rows
    without conv_id take no part; a repeated row is a turn of its own. A conversation left without turns ends in the root.
    Texts and conversations may have any length: texts are digested where they lie, and paths are cut into chunks.
    Other columns are ignored; without conversations there are no rows.
    """
    ids, turns = rebuilt(conversations)
    ids = stored(ids, "conversations")
    pieces = stored(chunks(turns, chunk), "chunks")
    entries = pieces.groupBy("tail").agg(
        F.first("cls").alias("cls"),
        F.first("k").alias("k"),
        F.first("path").alias("path"),
        F.first("sizes").alias("sizes"),
        F.min("conv_id").alias("least"),
        F.count(F.lit(1)).alias("n"),
        F.max((~F.col("last")).cast("int")).alias("goes_on"),
    )
    entries = stored(entries, "entries")
    classes = entries.where("k > 0").groupBy("cls", "k").agg(F.sum("n").alias("held"))
    classes = stored(classes, "classes")
    alone, crowd = classes.where("held = 1").select("cls"), classes.where("held > 1")

    # chains of one conversation
    chains = entries.join(alone, "cls", "left_semi").select("*", F.explode(F.sequence(F.lit(1), F.size("sizes"))).alias("at"))
    end = F.col("at") == F.size("sizes")
    nodes = chains.select(
        F.when(end, F.col("tail")).alias("id"),
        F.when(F.col("at") == 1, F.col("cls")).alias("parent"),
        F.when(F.col("at") > 1, F.col("least")).alias("parent_conv"),
        F.col("least").alias("conv_id"),
        (F.col("k") * chunk + F.col("at")).alias("depth"),
        F.lit(1).cast("long").alias("n_convs"),
        F.when(end, F.col("goes_on")).otherwise(1).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
    )

    # classes of several, the deepest chunk first
    one = F.struct(F.lit(1).cast("long").alias("children"), F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    below = alone.select("cls", one.alias("told"))
    deepest = crowd.agg(F.max("k")).first()[0] or 0
    for k in range(deepest, -1, -1):
        own = entries.where(F.col("k") == k)
        if k:
            own = own.join(crowd.select("cls"), "cls", "left_semi")
        own = own.join(below.select(F.col("cls").alias("tail"), "told"), "tail", "left")

        def carried(name):
            return F.coalesce(F.col("told")[name], F.lit(0).cast("long")).alias(name)

        hung = F.struct(F.size("sizes").alias("depth"), "n", "least", carried("children"), carried("leaves"), carried("saved"))
        made, totals = merged(own.withColumn("hung", F.array(hung)), k * chunk, run, few)
        nodes = nodes.union(made)
        told = totals.select("cls", F.struct("told.children", "told.leaves", "told.saved").alias("told"))
        # a class of k hangs from a path of k - 1, whose class may be a lone one: those are all in `alone`
        below = alone.select("cls", one.alias("told")).union(told)

    all_ids = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = told.where(F.col("cls") == F.lit(b"")).select("told")
    root = all_ids.join(top, F.lit(True), "left").select(
        F.lit(b"").alias("id"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(None).cast("long").alias("parent_conv"),
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        "n_convs",
        F.coalesce("told.children", F.lit(0)).alias("n_children"),
        F.coalesce("told.leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("told.saved", F.lit(0)).alias("saved_tokens"),
    )
    nodes = stored(nodes.union(root), "trie_nodes")

    # what is called after another conversation than its parent
    named = nodes.where("id is not null").select(F.col("id").alias("parent"), F.col("conv_id").alias("called"))
    nodes = nodes.join(named, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv", "called"))
    turnless = ids.join(pieces.where("k = 0").select("conv_id"), "conv_id", "left_anti").select(F.lit(b"").alias("id"), "conv_id")
    ends = _ends(pieces.where("last").select(F.col("tail").alias("id"), "conv_id").union(turnless))
    return nodes.join(ends, "id", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
