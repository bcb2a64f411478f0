"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions only.

A text is cut into paragraphs at line ends and behind words chosen by the hash of the word and the one before it,
one in `WORDS` on average. An unbroken stretch of more than `LONG` code points is cut in the same way behind code
points chosen by the hash of `WINDOW` of them, one in `POINTS`. Where a text is cut depends on what stands there and not on its place, so
an insertion changes the paragraphs around it and no others; a stretch in which nothing is chosen, as when few
words repeat, stays one paragraph.

The digests of the distinct paragraphs go into the cells of a sketch, each into one cell of each of three rows; a cell holds a
count, the digests' XOR and the XOR of their check values. Subtracting one version's cells from the other's leaves
the differing digests alone. Peeling takes out what stands alone in a cell, until nothing is left. If something
is left, the comparison is tried again with more cells: first their digests are dealt to buckets by
their hash, as many as the two texts' sizes call for, each with a sketch of its own, then a bucket that still fails is sketched
larger by the steps of `WIDTHS`. Two digests that share their cells in all rows even then, of a chance of about one in
a thousand million a pair, would be left; such a bucket is compared digest by digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlegrid.llm.batches import stored

#: A word in so many ends a paragraph, and a code point in so many of an unbroken stretch; both powers of two.
WORDS, POINTS = 32, 32
#: Code points of an unbroken stretch beyond which it is cut inside, and of a window that chooses a cut there.
LONG, WINDOW = 64, 4
#: Cells in each of a sketch's three rows, at first and on later attempts.
WIDTHS = (8, 32, 128, 1024)
#: Digests of both texts that a bucket should hold at most, on average.
PER_BUCKET = 9
#: Rounds of peeling; each takes out all that stand alone.
ROUNDS = 8
#: Bits of a digest from which its cell in each row is taken.
_BITS = (0, 20, 40)

Lambda = Callable[..., Column]


def _let(value: Column, body: Lambda) -> Column:
    """body(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _named(**fields: Column) -> Column:
    return F.named_struct(*[x for name, value in fields.items() for x in (F.lit(name), value)])


def _one_in(n: int, *of: Column) -> Column:
    return F.xxhash64(*of).bitwiseAND(F.lit(n - 1).cast("long")) == 0


def _unbroken(word: Column) -> Column:
    """A long word with a line end behind each chosen code point."""

    def marked(points: Column) -> Column:
        def mark(c: Column, i: Column) -> Column:
            window = [F.get(points, i - back) for back in range(WINDOW - 1, 0, -1)]
            return F.when(_one_in(POINTS, *window, c), F.concat(c, F.lit("\n"))).otherwise(c)

        return F.array_join(F.transform(points, mark), "")

    return F.when(F.length(word) > LONG, _let(F.split(word, ""), marked)).otherwise(word)


def paragraphs(text: Column) -> Column:
    """The text's paragraphs in order, none empty. Null has none."""

    def marked(words: Column) -> Column:
        def mark(w: Column, i: Column) -> Column:
            return F.concat(_unbroken(w), F.when(_one_in(WORDS, F.get(words, i - 1), w), F.lit("\n")).otherwise(F.lit(" ")))

        return F.array_join(F.transform(words, mark), "")

    whole = F.coalesce(text, F.lit(""))
    cut = _let(F.split(whole, " "), marked)
    return F.when(whole == "", F.array().cast("array<string>")).otherwise(F.filter(F.split(cut, "\n"), lambda p: F.trim(p) != ""))


def paragraph_digests(text: Column) -> Column:
    """Digests of the distinct paragraphs. Null has none."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7))


def _masked(bits: int, mask: Column) -> Lambda:
    return lambda k: F.shiftrightunsigned(k, bits).bitwiseAND(mask)


def _cells_of(keys: Column, width: Column) -> Column:
    """For each of the three rows, the cell of each digest."""
    mask = (width - 1).cast("long")
    return F.array(*[F.transform(keys, _masked(bits, mask)) for bits in _BITS])


def _cell(own: Column) -> Column:
    """Number, XOR and XOR of checks of signed digests."""
    none = F.lit(0).cast("long")
    several = _named(
        n=F.aggregate(own, none, lambda s, x: s + x["s"]),
        key=F.aggregate(own, none, lambda s, x: s.bitwiseXOR(x["k"])),
        check=F.aggregate(own, none, lambda s, x: s.bitwiseXOR(_check(x["k"]))),
    )
    first = F.get(own, F.lit(0))
    one = _named(n=first["s"], key=first["k"], check=_check(first["k"]))
    return F.when(F.size(own) == 0, _named(n=none, key=none, check=none)).when(F.size(own) == 1, one).otherwise(several)


def signed(keys: Column, sign: int) -> Column:
    return F.transform(keys, lambda k: _named(k=k, s=F.lit(sign).cast("long")))


def sketch(keys: Column, width: int | Column) -> Column:
    """Cells of signed digests, row by row: array of n, key, check."""
    width = F.lit(width)
    every = F.sequence(F.lit(0).cast("long"), (width - 1).cast("long"))

    def rows(t: Column) -> Column:
        return F.flatten(F.transform(t["c"], lambda cells: F.transform(every, lambda i: _let(F.filter(t["k"], lambda k, x: F.get(cells, x) == i), _cell))))

    return _let(_named(k=keys, c=_cells_of(F.transform(keys, lambda x: x["k"]), width)), rows)


def _minus(x: Column, y: Column) -> Column:
    return _named(n=x["n"] - y["n"], key=x["key"].bitwiseXOR(y["key"]), check=x["check"].bitwiseXOR(y["check"]))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, _minus)


def peel(cells: Column, width: int | Column) -> Column:
    """Digests only in the first (a) and only in the second (b) of two subtracted sketches; null if some can't be told."""
    none = F.array().cast("array<struct<k:bigint,s:bigint>>")
    start = _named(cells=cells, out=none, more=F.lit(True))

    def round_(state: Column, _: Column) -> Column:
        # where nothing stood alone nothing will, and later rounds needn't look
        return F.when(state["more"], looked(state)).otherwise(state)

    def looked(state: Column) -> Column:
        pure = F.filter(state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == _check(c["key"])))

        def without(out: Column) -> Column:
            gone = sketch(out, width)
            left = F.zip_with(state["cells"], gone, lambda x, y: F.when((y["n"] == 0) & (y["key"] == 0), x).otherwise(_minus(x, y)))
            return _named(cells=left, out=F.concat(state["out"], out), more=F.lit(True))

        alone = F.array_distinct(F.transform(pure, lambda c: _named(k=c["key"], s=c["n"])))
        stuck = _named(cells=state["cells"], out=state["out"], more=F.lit(False))
        return _let(alone, lambda out: F.when(F.size(out) == 0, stuck).otherwise(without(out)))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_)

    def told(out: Column) -> Column:
        return _named(a=F.transform(F.filter(out, lambda x: x["s"] > 0), lambda x: x["k"]), b=F.transform(F.filter(out, lambda x: x["s"] < 0), lambda x: x["k"]))

    return _let(done, lambda s: F.when(~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["key"] != 0)), told(s["out"])))


def _bucket_difference(a: Column, b: Column) -> Column:
    # a sketch is linear: that of a's digests and b's taken out is the one of a less the one of b, in half the passes
    both = F.concat(signed(a, 1), signed(b, -1))

    def attempt(width: Column) -> Column:
        return peel(sketch(both, width), width)

    # a later attempt is made only if all before it failed
    untold = F.lit(None).cast("struct<a:array<bigint>,b:array<bigint>>")
    told = F.aggregate(F.array(*[F.lit(w) for w in WIDTHS]), untold, lambda found, w: F.coalesce(found, attempt(w)))
    return F.coalesce(told, _named(a=F.array_except(a, b), b=F.array_except(b, a)))


def difference(a: Column, b: Column, cells_a: Column, cells_b: Column) -> Column:
    """Digests only in a and only in b, from sketches: first the given ones of the whole texts, then by buckets."""
    whole = peel(subtract(cells_a, cells_b), WIDTHS[0])

    # buckets in two steps, so that dealing costs the digests times the root of the number of buckets
    def side(total: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(F.sqrt(total / PER_BUCKET)).cast("int"))

    def dealt(keys: Column, parts: Column, part: Column, seed: int) -> Column:
        return F.filter(keys, lambda k: F.pmod(F.xxhash64(k, F.lit(seed)), parts.cast("long")) == part.cast("long"))

    def split(both: Column, parts: Column, seed: int) -> Column:
        return F.transform(F.sequence(F.lit(0), parts - 1), lambda p: _named(a=dealt(both["a"], parts, p, seed), b=dealt(both["b"], parts, p, seed)))

    def by_buckets(parts: Column) -> Column:
        groups = split(_named(a=a, b=b), parts, 11)
        buckets = F.flatten(F.transform(groups, lambda g: split(g, parts, 13)))
        found = F.transform(buckets, lambda g: _bucket_difference(g["a"], g["b"]))
        return _let(found, lambda f: _named(a=F.flatten(F.transform(f, lambda x: x["a"])), b=F.flatten(F.transform(f, lambda x: x["b"]))))

    return F.coalesce(whole, _let(side(F.size(a) + F.size(b)), by_buckets))


def likeness(a: Column, b: Column, only: Column) -> Column:
    """Shared digests by all digests of both; two texts without any are alike."""
    shared = F.size(a) - F.size(only["a"])
    every = shared + F.size(only["a"]) + F.size(only["b"])
    return F.when(every == 0, 1.0).otherwise(shared / every)


def shown(cells: Column) -> Column:
    """A sketch as text, cell by cell: count, digests and checks, the last two as 16 hex digits; an empty cell is empty.

    Nothing is shortened: two such texts can be read, subtracted and peeled.
    """

    def digits(value: Column) -> Column:
        return F.lpad(F.lower(F.hex(value)), 16, "0")

    empty = lambda c: (c["n"] == 0) & (c["key"] == 0)
    return F.array_join(F.transform(cells, lambda c: F.when(empty(c), F.lit("")).otherwise(F.concat_ws(":", c["n"].cast("string"), digits(c["key"]), digits(c["check"])))), ",")


# ---- documents and their successors ----


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # a and b together are a key of id and text, which are joined as plain numbers
    own = F.coalesce(F.col(id_col).cast("string"), F.lit("\u0000null"))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text, own).alias("a"), F.xxhash64(own, text).alias("b"), text.alias("text"))


def successors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its successor by descending id: id, a, b, copies, next_id, next_a, next_b; after the last comes the first.

    a and b are hashes of id and text, which order rows with one id; null ids come last. Equal rows follow each other:
    all but the last of them succeed themselves. Rows are dealt to ranges of the order, and the first of each range
    follows the last of the one before; only one row a range meets in one task.
    """
    order = [F.desc_nulls_last("id"), F.desc("a"), F.desc("b")]
    rows = _keyed(docs, id_col, text_col).groupBy("id", "a", "b").agg(F.count(F.lit(1)).alias("copies"))
    dealt = stored(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order")
    own = Window.partitionBy("part").orderBy(*order)
    following = F.lead(F.struct("id", "a", "b")).over(own)
    told = dealt.select("*", following.alias("next"), F.row_number().over(own).alias("rank"))
    # the first row of each range, as seen from the range before it
    first = stored(told.where("rank = 1").select("part", F.struct("id", "a", "b").alias("first")), "ranges")
    in_order = Window.orderBy("part")
    ahead = first.select("part", F.coalesce(F.lead("first").over(in_order), F.first("first").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("ahead"))
    # a row a range: as few as there are partitions
    linked = told.where("next is not null").select("id", "a", "b", "copies", "next").union(
        told.where("next is null").join(F.broadcast(ahead), "part").select("id", "a", "b", "copies", F.col("ahead").alias("next"))
    )
    return linked.select("id", "a", "b", "copies", F.col("next.id").alias("next_id"), F.col("next.a").alias("next_a"), F.col("next.b").alias("next_b"))


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n / 3) code points replaced by the first as many of its successor (or all of
    them). Null texts are empty. Texts without paragraphs are alike. Repeated rows and null ids each keep their row;
    other columns are ignored; a table of one row is its own successor.
    """
    chain = stored(successors(docs, id_col, text_col), "successors")
    # of equal rows one is followed by the next row, the others by themselves
    one = F.struct(F.lit(1).cast("long").alias("times"), F.col("next_id").alias("id"), F.col("next_a").alias("a"), F.col("next_b").alias("b"))
    rest = F.struct((F.col("copies") - 1).alias("times"), F.col("id").alias("id"), F.col("a").alias("a"), F.col("b").alias("b"))
    chain = chain.select("id", "a", "b", F.explode(F.when(F.col("copies") > 1, F.array(one, rest)).otherwise(F.array(one))).alias("to"))
    chain = chain.select(F.col("id").alias("from_id"), F.col("a").alias("from_a"), F.col("b").alias("from_b"), "to.times", "to.id", "to.a", "to.b")

    rows = _keyed(docs, id_col, text_col)
    # met twice, by its successor's key and by its own, in one shuffle of the texts; a text is cut once for both
    texts = rows.select("a", "b", "text", paragraph_digests(F.col("text")).alias("d")).dropDuplicates(["a", "b"])
    sizes = rows.select("a", "b", F.length("text").alias("n")).dropDuplicates(["a", "b"])
    sizes = sizes.select(F.col("a").alias("from_a"), F.col("b").alias("from_b"), F.floor(F.col("n") / 3).cast("int").alias("m"))

    # what the successor lends: as much of its beginning as is needed, and its digests
    asked = chain.join(sizes, ["from_a", "from_b"]).drop("id")
    lent = asked.join(texts, ["a", "b"]).select(
        F.col("from_id").alias("id"), F.col("from_a").alias("a"), F.col("from_b").alias("b"), "times", "m", F.substring(F.col("text"), F.lit(1), F.col("m")).alias("lent"), F.col("d").alias("d_next")
    )
    both = lent.join(texts, ["a", "b"]).select("id", "times", "text", "d", "d_next", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - F.col("m")), F.col("lent")).alias("edited"))
    digested = both.select("id", "times", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "d", paragraph_digests(F.col("edited")).alias("d_edited"), "d_next")
    # of the text, the edited one and the next, in this order
    cells = digested.select("*", F.transform(F.array("d", "d_edited", "d_next"), lambda d: sketch(signed(d, 1), WIDTHS[0])).alias("s"))
    own, others = F.col("s")[0], F.array(*[_named(d=F.col(d), s=F.col("s")[i]) for i, d in ((1, "d_edited"), (2, "d_next"))])

    def near(other: Column) -> Column:
        return _let(difference(F.col("d"), other["d"], own, other["s"]), lambda only: likeness(F.col("d"), other["d"], only))

    out = cells.select("id", "times", "n_chars", "edited_sha256", shown(own).alias("fingerprint"), shown(F.col("s")[1]).alias("edited_fingerprint"), F.transform(others, near).alias("near"))
    out = out.select(*out.columns[:-1], F.col("near")[0].alias("near_edited"), F.col("near")[1].alias("near_next"))
    names = out.columns[2:]
    return out.select("id", *names, F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("_copy")).select(F.col("id").alias(id_col), *names)
