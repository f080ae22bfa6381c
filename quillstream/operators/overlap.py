"""Texts that contain one another: exact classes, and containment over word shingles between class representatives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions.text import bound, shingle_hashes, squash
from quillstream.session import cut

#: Share of a text's shingles that the prefix is longer than it must be: longer prefixes meet more texts, of which fewer are compared as a whole.
SPARE = 0.08


def _hashed(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, h, plain): each row that isn't blank with the hash of its squashed text."""
    plain = df.select(F.col(f"`{key}`").alias("k"), F.lower(squash(F.col(f"`{text}`"))).alias("plain")).where(F.length("plain") > 0)
    return plain.select("k", F.unhex(F.sha2("plain", 256)).alias("h"), "plain")


def _marked(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(class_id, marks): for each different text the hashes of its shingles, written once."""
    rows = _hashed(df, key, text).select("k", "h", shingle_hashes(F.col("plain"), size).alias("marks"))
    return cut(rows.groupBy("h").agg(F.min("k").alias("class_id"), F.any_value("marks").alias("marks")).where(F.size("marks") > 0).select("class_id", "marks"))


def _ranked(rows: DataFrame) -> DataFrame:
    """(class_id, n, items, weights): a text's shared shingles, those of the rarest first, written once. Shingles that the very same texts
    have are one item, whose weight is their number; n counts the unshared ones too."""
    each = rows.select("class_id", F.explode("marks").alias("mark")).repartition("mark")  # shuffled once, counted and joined where it lies
    lists = each.groupBy("mark").agg(F.count("*").alias("df"), F.bit_xor(F.xxhash64("class_id")).alias("who")).select("mark", "df", F.xxhash64("df", "who").alias("item"))
    shared = each.join(lists.hint("merge"), "mark").select("class_id", "df", "item").repartition("class_id")
    items = shared.groupBy("class_id", "df", "item").agg(F.count("*").cast("int").alias("w"))
    by = F.sort_array(F.collect_list(F.when(F.col("df") > 1, F.struct("df", "item", "w"))))
    ranked = items.groupBy("class_id").agg(F.sum("w").cast("int").alias("n"), by.alias("by")).where(F.size("by") > 0)
    return cut(ranked.select("class_id", "n", F.col("by.item").alias("items"), F.col("by.w").alias("weights")))


def _contained(rows: DataFrame, threshold: float) -> DataFrame:
    ranked = _ranked(rows)
    lost = (F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9)).cast("int")  # so many may be missing in the larger text
    alone = F.col("n") - F.aggregate("weights", F.lit(0), lambda x, w: x + w)
    smaller = ranked.select(F.col("class_id").alias("small"), F.col("n").alias("n_small"), "items", "weights", lost.alias("lost"), alone.alias("alone")).where("alone <= lost")
    enough = F.col("lost") + F.floor(SPARE * F.col("n_small")).cast("int")
    taken = F.aggregate("weights", F.struct(F.col("alone").alias("sum"), F.lit(0).alias("k")), lambda x, w: F.when(x["sum"] <= enough, F.struct((x["sum"] + w).alias("sum"), (x["k"] + 1).alias("k"))).otherwise(x))
    smaller = smaller.withColumn("taken", bound(taken, lambda x: x))
    each = F.arrays_zip(F.slice("items", 1, F.col("taken.k")).alias("item"), F.slice("weights", 1, F.col("taken.k")).alias("w"))
    prefix = smaller.select("small", "n_small", (F.col("taken.sum") - F.col("lost")).alias("least"), F.explode(each).alias("x")).select("small", "n_small", "least", "x.item", "x.w")
    listed = ranked.select(F.col("class_id").alias("large"), F.col("n").alias("n_large"), F.explode("items").alias("item"))
    ordered = (F.col("n_small") < F.col("n_large")) | ((F.col("n_small") == F.col("n_large")) & (F.col("small") < F.col("large")))
    # merged, not broadcast: Spark takes arrays for a few bytes, and lists that are unfolded from them too
    met = prefix.join(listed.hint("merge"), "item").where((F.col("small") != F.col("large")) & ordered).select("small", "large", "w", "least").repartition("small")
    candidates = met.groupBy("small", "large").agg(F.sum("w").alias("met"), F.max("least").alias("least")).where("met >= least").select("small", "large")
    a, b = rows.select(F.col("class_id").alias("small"), F.col("marks").alias("m_a")), rows.select(F.col("class_id").alias("large"), F.col("marks").alias("m_b"))
    both = candidates.join(a.hint("merge"), "small").join(b.hint("merge"), "large")
    common = both.select("small", "large", F.size(F.array_intersect("m_a", "m_b")).alias("common"), F.least(F.size("m_a"), F.size("m_b")).alias("n"))
    return common.where(F.col("common") >= F.lit(threshold) * F.col("n") - 1e-9).select("small", "large", "common", F.round(F.col("common") / F.col("n"), 6).alias("similarity"))


def containment_pairs(df: DataFrame, key: str, text: str, threshold: float = 0.8, size: int = 5) -> DataFrame:
    """(small, large, common, similarity): class representatives of which the smaller shares at least `threshold` of its shingles with the larger.

    A class holds the rows of one squashed text and is named by its smallest key. Prefix filter: of a smaller text that reaches
    the threshold (1 - threshold) * n shingles may be missing in the larger. So of its rarest (1 - threshold + SPARE) * n ones,
    which alone meet the full inverted lists, all but those must be there; frequent shingles enter a prefix only where a text has no
    rarer ones. The whole shingle arrays of the pairs that pass then give the exact number in common. Nothing is capped, so no pair is
    lost. Null and blank texts have no class.
    """
    return _contained(_marked(df, key, text, size), threshold)


def linked_components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of `links` (small, large) is linked with, over any number of links.

    Labels spread by taking the least of the neighbours' and then the label's own label, each round in a written table, until no
    label changes; so rounds grow with the logarithm of the longest chain.
    """
    ways = F.explode(F.array(F.struct("small", "large"), F.struct(F.col("large").alias("small"), F.col("small").alias("large"))))  # not a union, which works the links out twice
    both = cut(links.select(ways.alias("x")).select("x.small", "x.large").distinct())
    label = both.groupBy(F.col("small").alias("node")).agg(F.least(F.min("large"), F.col("node")).alias("label"))
    while True:
        near = both.join(label, F.col("large") == F.col("node")).groupBy("small").agg(F.min("label").alias("near"))
        step = label.join(near, F.col("node") == F.col("small"), "left").select("node", F.least("label", F.coalesce("near", "label")).alias("next"), "label")
        jump = step.select(F.col("node").alias("j"), F.col("next").alias("far"))
        after = cut(step.join(jump, F.col("next") == F.col("j"), "left").select("node", F.least("next", F.coalesce("far", "next")).alias("new"), "label"))
        label = after.select("node", F.col("new").alias("label"))
        if after.where("new <> label").isEmpty():
            return label


def near_duplicate_classes(df: DataFrame, key: str, text: str, threshold: float = 0.8, size: int = 5) -> DataFrame:
    """(key, class_id): rows whose texts are linked by containment, over any number of links, share the smallest key among them. Null and blank texts have no row."""
    rows = _hashed(df, key, text).select("k", "h")
    classes = rows.groupBy(F.col("h").alias("c")).agg(F.min("k").alias("class_id"))
    label = linked_components(_contained(_marked(df, key, text, size), threshold))
    named = classes.join(label, F.col("class_id") == F.col("node"), "left").select("c", F.coalesce("label", "class_id").alias("class_id"))
    return rows.join(named, F.col("h") == F.col("c")).select(F.col("k").alias(key), "class_id")
