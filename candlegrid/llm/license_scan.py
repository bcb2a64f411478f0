"""License scans by diagonal voting, in DataFrame functions only.

Every two consecutive words of a document are hashed and joined to the places where the same two stand in a
template. Matches of one template whose offset (place in the document minus place in the template) is the same
lie on one diagonal; votes are counted per diagonal. Diagonals that lie next to each other, as they do where a
word was added or left out, are merged and count together. Each place of a template votes once, by its words and not their
hash, and places count as far as they follow each other in the document. Spans of base phrases are verified whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: phrases of the base and their labels
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
# fixed values: opening sentences of public license notices, which the method adds, and their labels
NOTICES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-notice": "this work is licensed under a creative commons attribution",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license",
    "reserved": "all rights reserved",
    "spdx": "spdx license identifier",
}
#: Diagonals at most so far apart are merged.
NEAR = 2
#: Part of a notice's votes that its merged diagonals need.
LEAST_SHARE = 0.6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """A-Z lower-cased; runs of digits, letters a-z and all beyond ASCII. Null has none."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    parts = F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def _grams(words: Column) -> Column:
    """Hash of each two consecutive words, by place."""
    return F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))


def _named(**fields: Column) -> Column:
    return F.named_struct(*[x for name, value in fields.items() for x in (F.lit(name), value)])


def templates(docs: DataFrame) -> DataFrame:
    """A row per place of a template: label, words, base, gram and place; as many as the fixed phrases have words."""
    rows = [(label, words.split(), base) for base, group in ((True, PHRASES), (False, NOTICES)) for label, words in group.items()]
    told = docs.sparkSession.createDataFrame(rows, "label string, words array<string>, base boolean")
    return told.select("label", "words", "base", F.posexplode(_grams(F.col("words"))).alias("place", "gram"))


def diagonals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Votes by document, template and diagonal, and for each document a row without a template whose votes count its copies."""
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(1)).alias("b"), words_of(text).alias("words"))
    # one entry without a gram stands before the others and keeps the row, whatever the text has
    grams = F.concat(F.array(F.lit(None).cast("long")), _grams(F.col("words")))
    rows = rows.select("_id", "a", "b", F.size("words").cast("long").alias("n_words"), "words", grams.alias("grams"))
    places = rows.select("_id", "a", "b", "n_words", "words", F.posexplode("grams").alias("after", "gram"))
    known = templates(docs).withColumnRenamed("words", "phrase").withColumnRenamed("gram", "known")
    voted = places.join(F.broadcast(known), F.col("gram") == F.col("known"), "left")  # the fixed templates
    voted = voted.where("label is not null or after = 0")
    diagonal = F.col("after") - 1 - F.col("place")
    whole = F.when(diagonal < 0, False).otherwise(F.slice("words", F.greatest(diagonal, F.lit(0)) + 1, F.size("phrase")) == F.col("phrase"))
    same = F.when(F.col("after") > 0, F.slice("words", F.greatest("after", F.lit(1)), 2) == F.slice("phrase", F.col("place") + 1, 2))
    return (
        voted.select("_id", "a", "b", "n_words", "label", "base", diagonal.alias("diagonal"), (F.size("phrase") - 1).alias("full"), whole.alias("whole"), "place", same.alias("same"))
        .groupBy("_id", "a", "b", "n_words", "label", "base", "diagonal", "full")
        .agg(F.count(F.lit(1)).alias("votes"), F.max("whole").alias("whole"), F.collect_set(F.when(F.col("same"), F.col("place"))).alias("voted"))
    )


def _in_order(votes: Column, full: Column) -> Column:
    """Most places of a template that follow each other in the document, of votes (at, back): place in the document, place in the template negated."""

    def longest(best: Column, vote: Column) -> Column:
        before = lambda i: F.coalesce(F.array_max(F.slice(best, F.lit(1), i)), F.lit(0))
        return F.transform(best, lambda n, i: F.when(i == -vote["back"], F.greatest(n, before(i) + 1)).otherwise(n))

    return F.array_max(F.aggregate(F.array_sort(votes), F.array_repeat(F.lit(0), full), longest))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_words, base (array of start and label), notices (array of start, label, share).

    base: every place where a phrase's words stand consecutively. notices: merged diagonals of the longer
    templates with enough votes, share being places in order by all places. Null and empty texts have no words and no spans;
    repeated rows and null ids each keep their row; other columns are ignored.
    """
    key = ["_id", "a", "b"]
    votes = diagonals(docs, id_col, text_col)
    order = Window.partitionBy(*key, "label").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEAR, F.lit(True))
    grouped = votes.withColumn("group", F.sum(apart.cast("int")).over(order))
    merged = grouped.groupBy(*key, "n_words", "label", "base", "full", "group").agg(
        F.min("diagonal").alias("start"), F.sum("votes").alias("votes"), F.collect_list(F.when(F.col("whole"), F.col("diagonal"))).alias("places"),
        F.collect_list(F.when(~F.col("base"), F.struct("diagonal", "voted"))).alias("voted"),
    )
    enough = F.size(F.array_distinct(F.flatten("voted.voted"))) >= LEAST_SHARE * F.col("full")
    votes = F.flatten(F.transform("voted", lambda d: F.transform(d["voted"], lambda p: _named(at=d["diagonal"] + p, back=-p))))
    merged = merged.withColumn("share", F.when(enough, _in_order(votes, F.col("full")) / F.col("full")).otherwise(0.0))
    told = merged.groupBy(*key, "n_words").agg(
        F.sum(F.when(F.col("label").isNull(), F.col("votes"))).alias("copies"),
        F.flatten(F.collect_list(F.when(F.col("base"), F.transform("places", lambda p: _named(start=p.cast("long"), label=F.col("label")))))).alias("base"),
        F.collect_list(F.when(~F.col("base"), _named(start=F.greatest("start", F.lit(0)).cast("long"), label=F.col("label"), share=F.col("share")))).alias("seen"),
    )
    notices = F.filter("seen", lambda s: s["share"] >= LEAST_SHARE)
    told = told.select("_id", "n_words", F.array_sort("base").alias("base"), F.array_sort(notices).alias("notices"), F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return told.select(F.col("_id").alias(id_col), "n_words", "base", "notices")


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of scan()'s rows: n_base, first_word, last_word, base_labels, labels, and score: 1 with a base place, else the best share."""

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    base, notices = F.col("base.label"), F.col("notices.label")
    starts = F.col("base.start")
    return found.select(
        id_col,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, notices)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("notices.share"), F.lit(0.0))).alias("score"),
    )
