"""Signals in transcripts and events: keyword rules, a cooldown gate per key, and latency percentiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quillstream.functions.text import spoken_form
from quillstream.session import cut

from .ordered import with_last, with_neighbours

# Signal types with the keywords that stand for them, their confidence and priority, in the order in which they are looked for.
RULES = (
    ("PRICE_OBJECTION", ("too expensive", "very expensive", "premium is expensive", "premium too high", "cost too much", "can't afford", "cannot afford", "too costly", "expensive"), 0.92, "HIGH"),
    ("FRUSTRATION", ("frustrated", "frustrating", "frustration", "angry", "annoyed", "ridiculous", "terrible", "not happy", "fed up", "this is useless", "waste of time", "nobody is helping", "no one is helping", "already explained", "explained this twice"), 0.88, "HIGH"),
    ("PAYMENT_DIFFICULTY", ("can't pay", "cannot pay", "difficult to pay", "difficulty paying", "payment problem", "payment issue", "unable to pay", "how can i pay", "payment options"), 0.84, "HIGH"),
    ("RENEWAL_INTENT", ("i want to renew", "want to renew", "renew my policy", "continue my policy", "i'll renew", "i will renew", "yes i want to continue"), 0.90, "MEDIUM"),
    ("HUMAN_SUPPORT", ("speak to someone", "speak to a person", "talk to someone", "human agent", "customer service", "call me back", "callback", "i want a human", "i need a human", "let me speak to someone"), None, None),
    ("CROSS_SELL_OPPORTUNITY", ("another vehicle", "second vehicle", "another car", "second car", "additional vehicle", "multiple vehicles"), 0.86, "MEDIUM"),
    ("COMPLIANCE_RISK", ("guaranteed", "definitely covered", "you will get", "no risk", "guaranteed return", "guaranteed benefit"), 0.93, "HIGH"),
)


def detect(df: DataFrame, text: str, rules=RULES, strict: bool = False) -> DataFrame:
    """The rows of `df` once for each signal in their text, with ord, type, confidence, priority and matched_keywords (in rule order).

    Keywords are found inside words too. They are brought into the text's form first; with strict=True they are compared as
    written, so that those with an apostrophe never match. The rules become one expression, evaluated in a single pass.
    """

    def keyword(k: str) -> Column:
        return F.lit(k) if strict else spoken_form(F.lit(k))

    spoken = df.withColumn("_spoken", spoken_form(F.col(text)))
    found = []
    for n, (kind, words, confidence, priority) in enumerate(rules, 1):
        hits = F.array_compact(F.array(*[F.when(F.contains(F.col("_spoken"), keyword(w)), F.lit(w)) for w in words]))
        row = F.struct(
            F.lit(n).alias("ord"), F.lit(kind).alias("type"), F.lit(confidence).cast("double").alias("confidence"),
            F.lit(priority).cast("string").alias("priority"), hits.alias("matched_keywords"))
        found.append(F.when(F.size(hits) > 0, row))
    return spoken.withColumn("_found", F.array_compact(F.array(*found))).select(*[F.col(f"`{c}`") for c in df.columns], F.inline_outer("_found")).where("type is not null")  # outer: else the search is done once more, as a filter on the array


def first_signal(detected: DataFrame, key: str) -> DataFrame:
    """(key, type): the first signal of each row in rule order."""
    return detected.groupBy(key).agg(F.min_by("type", "ord").alias("type"))


def _pauses(pause: int):
    """Marks the rows kept among rows sorted by group and time, batch after batch: the next one kept is looked up, so the work is that of the kept rows."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            g, t = np.asarray(batch.column("_g")), np.asarray(batch.column("_t"))
            keep = np.zeros(len(g), bool)
            edges = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1], [True])))
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                at = start if g[start] != group else start + int(np.searchsorted(t[start:end], last + pause))
                while at < end:
                    keep[at], last = True, int(t[at])
                    at += 1 if pause <= 0 else int(np.searchsorted(t[at:end], last + pause))
                group = g[start]
            yield batch.select([n for n in batch.schema.names if n not in ("_g", "_t")]).append_column("decision", pa.array(np.where(keep, "keep", "suppress"), pa.string()))

    return judge


def cooldown(df: DataFrame, keys: list[str], at: str, seconds: float, tie: str, days: int = 7) -> DataFrame:
    """`df` with decision: keep for a row at least `seconds` after the last kept row of its keys, else suppress. Suppressed rows don't start the pause anew.

    A row that follows a gap of `seconds` is kept whatever was before, so the rows between two such gaps (a burst) can be judged on
    their own. A key is thus spread over its bursts and over buckets of `days` days; a burst is sorted by Spark and streamed through one
    task, which holds no more than a batch of it. Rows with a null time are left out. Equal times are taken in the order of `tie`.
    """
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    timed = df.where(F.col(at).isNotNull()).withColumn("_t", micros)
    pause = int(seconds * 1_000_000)
    bucket = F.floor(F.col("_t") / (days * 86_400_000_000))
    timed = cut(timed)  # read several times below
    near = with_neighbours(timed, keys, ["_t", tie], "_t", bucket, "_before", "_after").drop("_after")
    opens = F.when(F.col("_before").isNull() | (F.col("_t") - F.col("_before") >= pause), F.col("_t"))
    burst = with_last(near, keys, ["_t", tie], {"_burst": opens}, bucket, inclusive=True)
    named = burst.select(*[F.col(f"`{c}`") for c in df.columns], "_t", F.xxhash64(*[F.col(f"`{k}`") for k in keys], *[F.col(f"`{k}`").isNull() for k in keys], "_burst").alias("_g"))
    ordered = named.repartition("_g").sortWithinPartitions("_g", "_t", tie)
    schema = StructType([*df.schema.fields, StructField("decision", StringType())])
    return ordered.mapInArrow(_pauses(pause), schema)


def gate(detected: DataFrame, keys: list[str], at: str, tie: str, threshold: float = 0.7, seconds: float = 10.0) -> DataFrame:
    """Detected signals with decision and reason: without confidence, below the threshold or without a time they are suppressed and start no pause; the rest go through the cooldown."""
    sure = F.coalesce(F.col("confidence") >= threshold, F.lit(False)) & F.col(at).isNotNull()
    passed = cooldown(detected.where(sure), keys, at, seconds, tie)
    passed = passed.withColumn("reason", F.when(F.col("decision") == "suppress", "cooldown"))
    why = F.when(F.col("confidence").isNull(), "missing_confidence").when(F.col("confidence") < threshold, "below_confidence_threshold").otherwise("missing_time")
    rest = detected.where(~sure).withColumn("decision", F.lit("suppress")).withColumn("reason", why)
    return passed.unionByName(rest)


def floor_percentiles(df: DataFrame, value: str, shares: tuple[float, ...] = (0.5, 0.95), group: str | None = None, buckets: int = 1000, most: int = 100_000) -> DataFrame:
    """(group, share, value): the value at the index floor(share * (n - 1)) of the sorted values; no row for a group without values.

    Exact without sorting a group in one task: a histogram of `buckets` equal parts of each group's range tells in which part
    the wanted index lies, that part is cut up again, and so on until it holds at most `most` rows or one value; only these
    rows' different values are sorted. A far outlier costs another round and nothing else.
    """
    key = F.col(group) if group else F.lit("all")
    plain = df.select(key.alias("g"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    ends = plain.groupBy("g").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))
    wanted = ends.select("g", F.explode(F.array(*map(F.lit, shares))).alias("share"), "low", "high", "n").select("g", "share", "low", "high", F.col("n").alias("m"), F.floor(F.col("share") * (F.col("n") - 1)).alias("at"))
    wanted = cut(wanted)  # one row a group and share; `at` counts from the part's first row

    def inside(part: DataFrame) -> DataFrame:
        near = part.select(F.col("g").alias("pg"), "low", "high").distinct()
        return plain.join(near, F.col("g").eqNullSafe(F.col("pg")) & F.col("v").between(F.col("low"), F.col("high"))).drop("pg")

    while not wanted.where((F.col("m") > most) & (F.col("low") < F.col("high"))).isEmpty():
        part = F.least(F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * buckets), F.lit(buckets - 1))
        parts = inside(wanted).groupBy("g", "low", "high", F.coalesce(part, F.lit(0)).alias("part")).agg(F.count("*").alias("c"), F.min("v").alias("from"), F.max("v").alias("to"))
        before = F.sum("c").over(Window.partitionBy("g", "low", "high").orderBy("part")) - F.col("c")
        parts = parts.select(F.col("g").alias("pg"), F.col("low").alias("pl"), F.col("high").alias("ph"), "c", "from", "to", before.alias("before"))
        here = F.col("g").eqNullSafe(F.col("pg")) & (F.col("low") == F.col("pl")) & (F.col("high") == F.col("ph")) & (F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("c"))
        wanted = cut(wanted.join(parts, here).select("g", "share", F.col("from").alias("low"), F.col("to").alias("high"), F.col("c").alias("m"), (F.col("at") - F.col("before")).alias("at")))
    counted = inside(wanted).groupBy("g", "low", "high", "v").agg(F.count("*").alias("c"))  # however often a value comes, it is one row
    upto = counted.withColumn("r", F.sum("c").over(Window.partitionBy("g", "low", "high").orderBy("v")))
    upto = upto.select(F.col("g").alias("ug"), F.col("low").alias("ul"), F.col("high").alias("uh"), "v", "r", "c")
    hit = wanted.join(upto, F.col("g").eqNullSafe(F.col("ug")) & (F.col("low") == F.col("ul")) & (F.col("high") == F.col("uh")) & (F.col("at") < F.col("r")) & (F.col("at") >= F.col("r") - F.col("c")))
    return hit.select(F.col("g").alias(group or "group"), "share", F.col("v").alias("value"))


def transcripts(df: DataFrame, stream: str, order: str, text: str) -> DataFrame:
    """(stream, transcript): a stream's chunks in order, joined by blanks, blank chunks left out."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text).alias("t"))))
    return df.where(F.trim(text) != "").groupBy(stream).agg(F.array_join(F.transform(parts, lambda x: F.trim(x["t"])), " ").alias("transcript"))


def tumbling(df: DataFrame, at: str, width: str, keys: list[str], value: str) -> DataFrame:
    """(window_start, keys, n, total): counts and sums over windows of one width."""
    return df.groupBy(F.window(F.col(at), width).alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total")).select(F.col("w.start").alias("window_start"), *keys, "n", "total")
