"""Mixing sources to target weights: soft membership and projected-gradient least squares."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.session import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Buckets for token numbers; the classifier's size is this times the number of target sources.
BUCKETS = 4096
#: The classifier is fitted on about so many labelled rows, the same number of each source where it has them.
FIT_ROWS = 20_000
#: How often labels are taken to be right; the rest of a labelled row's membership follows its text.
LABEL_TRUST = 0.98
#: Divisors of the log likelihood, of which the one that suits held-out rows of the sample best is taken; words of a text aren't independent.
TEMPERATURES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0, 256.0)
#: Documents of one label whose posteriors agree to this fraction move alike and are fitted as one group.
GRAIN = 16


@lru_cache(maxsize=2)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@dataclass
class Membership:
    """Multinomial classifier over token buckets: log probabilities (sources x buckets), which sources it was fitted on, and the temperature."""

    log_p: np.ndarray
    fitted: np.ndarray
    temperature: float = 1.0

    def likelihoods(self, tokens: list[list[int]]) -> np.ndarray:
        """Log likelihood of each text under each source."""
        sizes = np.array([len(t) for t in tokens], np.int64)
        out = np.zeros((len(tokens), len(self.fitted)))
        if sizes.sum():
            flat = np.fromiter((x for t in tokens for x in t), np.int64, int(sizes.sum())) % BUCKETS
            pairs, count = np.unique(np.repeat(np.arange(len(tokens)), sizes) * BUCKETS + flat, return_counts=True)
            of = pairs // BUCKETS
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            out[of[starts]] = np.add.reduceat(self.log_p.T[pairs % BUCKETS] * count[:, None], starts)
        return out

    def posteriors(self, tokens: list[list[int]], label: np.ndarray, trust: float) -> np.ndarray:
        """P(source) of each text, with its label (-1 for none) as a prior of weight `trust`. A row is zero where nothing is known."""
        k = len(self.fitted)
        raw = np.where(self.fitted, self.likelihoods(tokens) / self.temperature, -np.inf)
        top = raw.max(axis=1, initial=-np.inf, keepdims=True)
        p = np.exp(raw - np.where(np.isfinite(top), top, 0.0))
        p /= np.maximum(p.sum(axis=1, keepdims=True), 1e-300)
        has = np.flatnonzero(label >= 0)
        prior = np.full((len(has), k), (1 - trust) / max(1, k - 1))
        prior[np.arange(len(has)), label[has]] = trust
        p[has] *= prior
        alone = has[~self.fitted[label[has]]]  # rows of a source that the classifier doesn't know
        p[alone] = 0.0
        p[alone, label[alone]] = 1.0
        whole = p.sum(axis=1, keepdims=True)
        return np.divide(p, whole, out=np.zeros_like(p), where=whole > 0)


def _small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, as a row's tokens times the sources take memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _tokens(batch: pa.RecordBatch, path: str) -> list[list[int]]:
    encode = _encoder(path).encode_ordinary
    return [encode(t) if t else [] for t in batch.column("text").to_pylist()]


def _counter(path: str):
    """Counts (label, bucket, n) over a sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            tokens = _tokens(batch, path)
            sizes = [len(t) for t in tokens]
            flat = np.fromiter((x for t in tokens for x in t), np.int64, sum(sizes)) % BUCKETS
            pairs, n = np.unique(np.repeat(batch.column("label").to_numpy(), sizes) * BUCKETS + flat, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs // BUCKETS, pa.int64()), pa.array(pairs % BUCKETS, pa.int64()), pa.array(n, pa.int64())], names=["label", "bucket", "n"])

    return count


def _judge(model: Membership, path: str):
    """Summed log loss (temperature, loss) over held-out rows."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            label = batch.column("label").to_numpy()
            raw = np.where(model.fitted, model.likelihoods(_tokens(batch, path)), -np.inf)[model.fitted[label]]
            label = label[model.fitted[label]]
            loss = []
            for t in TEMPERATURES:
                x = raw / t
                x = x - x.max(axis=1, initial=-np.inf, keepdims=True)
                loss.append(float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(label)), label]).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(TEMPERATURES, pa.float64()), pa.array(loss, pa.float64())], names=["temperature", "loss"])

    return judge


def fit_membership(labelled: DataFrame, sources: int, path: str) -> Membership:
    """The classifier, from (text, label) rows: counts of a stratified sample with one row in five held out for the temperature.
    What comes back is `sources` x BUCKETS numbers at most."""
    sizes = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}  # one number a source
    share = {k: min(1.0, FIT_ROWS / max(1, len(sizes)) / n) for k, n in sizes.items()}
    sample = labelled.sampleBy("label", share, seed=7).where("text is not null").withColumn("out", F.pmod(F.xxhash64("text"), F.lit(5)) == 0)
    counts = np.zeros((sources, BUCKETS))
    got = sample.where("not out").select("text", "label").mapInArrow(_counter(path), "label long, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts[got["label"].to_numpy(np.int64), got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy()
    whole = counts.sum(axis=1, keepdims=True)
    model = Membership(np.log((counts + 1) / (whole + BUCKETS)), whole[:, 0] > 0)
    losses = sample.where("out").select("text", "label").mapInArrow(_judge(model, path), "temperature double, loss double").groupBy("temperature").agg(F.sum("loss").alias("loss")).collect()
    if losses:
        model.temperature = min(losses, key=lambda r: (r["loss"], r["temperature"]))["temperature"]
    return model


def _groups(model: Membership, path: str, trust: float):
    """Partial sums (group, label, source, weight, tokens, documents): of the documents of one label and about one posterior, the expected
    tokens of each source; tokens and documents stand in the rows of source -1."""

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            tokens = _tokens(batch, path)
            label = batch.column("label").to_numpy()
            n = np.array([len(t) for t in tokens], np.int64)
            p = model.posteriors(tokens, label, trust)
            coarse = np.column_stack((label, np.rint(p * GRAIN).astype(np.int64)))
            keys, of = np.unique(coarse, axis=0, return_inverse=True)
            of = of.reshape(-1)
            names = np.array([int.from_bytes(hashlib.blake2b(k.tobytes(), digest_size=8).digest(), "big", signed=True) for k in keys], np.int64)
            weight = np.zeros((len(keys), p.shape[1]))
            np.add.at(weight, of, p * n[:, None])
            g, s = np.nonzero(weight)
            whole = np.bincount(of, n, len(keys)).astype(np.int64)
            out = [
                np.concatenate((names[g], names)), np.concatenate((keys[g, 0], keys[:, 0])), np.concatenate((s, np.full(len(keys), -1))),
                np.concatenate((weight[g, s], np.zeros(len(keys)))), np.concatenate((np.zeros(len(g), np.int64), whole)), np.concatenate((np.zeros(len(g), np.int64), np.bincount(of, minlength=len(keys)))),
            ]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["g", "label", "s", "weight", "tokens", "documents"])

    return group


def fit_rates(groups: DataFrame, targets: np.ndarray, steps: int = 200, tolerance: float = 1e-3) -> tuple[list[np.ndarray], np.ndarray]:
    """Projected-gradient least squares over `groups` (tokens, cap, members: array of (s, w), the expected tokens of source s): rates r in
    [0, cap] that minimise the sum over sources of ((sum of r * w - target) / capacity)**2, targets beyond all caps being lowered to them.

    A step moves each group's rate against the gradient, scaled by the group's tokens (a diagonal metric), and clips it. A rate
    after t steps is a fold over the residuals so far, one number a source; so a pass over the groups needs nothing but that short
    history, and its sum, one number a source, is all that comes back. Returns the residual history and the totals reached.
    """
    capacity = _totals(groups, F.lit(1.0), len(targets))
    scale = np.where(capacity > 0, capacity, 1.0)
    targets = np.minimum(targets, _totals(groups, F.col("cap"), len(targets)))  # what no rate can reach must not pull at other sources' documents
    history: list[np.ndarray] = []
    totals, rate = capacity, F.lit(1.0)
    for _ in range(steps):
        history.append((totals - targets) / scale)
        before, totals = totals, _totals(groups, rate := _moved(rate, history[-1]), len(targets))
        if np.max(np.abs(before - totals) / np.maximum(targets, 0.1 * scale), initial=0.0) < tolerance:
            break
        if len(history) % 8 == 0:  # a written table keeps the plan short
            groups = cut(groups.withColumn("start", rate))
            rate = F.col("start")
    return history, totals


def _moved(rate, move: np.ndarray):
    moves = F.lit(move)
    gradient = F.aggregate("members", F.lit(0.0), lambda a, x: a + x["w"] * F.element_at(moves, (x["s"] + 1).cast("int"))) / F.greatest(F.col("tokens"), F.lit(1.0))
    return F.greatest(F.lit(0.0), F.least(F.col("cap"), rate - gradient))


def _totals(groups: DataFrame, rate, k: int) -> np.ndarray:
    each = groups.select(rate.alias("rate"), F.explode("members").alias("m")).groupBy(F.col("m.s").alias("s")).agg(F.sum(F.col("rate") * F.col("m.w")).alias("t")).collect()  # one number a source
    out = np.zeros(k)
    for r in each:
        out[r["s"]] = r["t"]
    return out


@dataclass
class Mix:
    """A fitted mix: the target sources in order, then one class for all others; the classifier, caps, goals and the residual history."""

    names: list[str]
    model: Membership
    caps: np.ndarray
    goal: np.ndarray
    totals: np.ndarray
    history: list[np.ndarray]
    groups: DataFrame

    def rates(self, p: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The fitted rate of documents with these posteriors and labels."""
        cap = np.where(label >= 0, self.caps[label], p @ self.caps)
        rate = np.ones(len(p))
        for move in self.history:
            rate = np.clip(rate - p @ move, 0.0, cap)
        return rate if self.history else np.zeros(len(p))


def _labelled(documents: DataFrame, names: list[str]) -> DataFrame:
    """(doc_id, text, source, label): the source's place in the targets, the place behind them for another source, -1 for none or a blank one."""
    place = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)]) if names else F.lit(None).cast("map<string,int>")
    source = F.when(F.trim("source") != "", F.col("source"))
    return documents.select("doc_id", "text", source.alias("source")).withColumn("label", F.when(F.col("source").isNull(), -1).otherwise(F.coalesce(place[F.col("source")], F.lit(len(names)))).cast("long"))


def fit_mix(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, trust: float = LABEL_TRUST) -> Mix:
    """Posteriors of all documents, their groups and the fitted rates.

    The label is a prior of weight `trust`, the text decides the rest; rows without a source go by their text alone. Documents of
    one label with about the same posterior are one group, whose expected tokens a source are summed exactly. Sources that the
    targets lack are one class with target and cap 0, so nothing grows with their number; the targets' number is
    the user's. Goals are target shares of the tokens of all documents that have a source.
    """
    want = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap")).orderBy("source").collect()  # the user's table, one row a source
    names = [r["source"] for r in want]
    docs = _labelled(documents, names)
    model = fit_membership(docs.where("label >= 0").select("text", "label"), len(names) + 1, path)
    caps = np.array([float(r["cap"] or 0) for r in want] + [0.0])
    part = docs.select("text", "label").mapInArrow(_groups(model, path, trust), "g long, label long, s long, weight double, tokens long, documents long")
    summed = part.groupBy("g", "label", "s").agg(F.sum("weight").alias("w"), F.sum("tokens").alias("tokens"), F.sum("documents").alias("documents"))
    member = F.filter(F.collect_list(F.when(F.col("s") >= 0, F.struct("s", "w"))), lambda x: x.isNotNull())
    groups = summed.groupBy("g", "label").agg(member.alias("members"), F.sum("tokens").cast("double").alias("tokens"), F.sum("documents").alias("documents"))
    cap_of = F.lit(caps)
    soft = F.aggregate("members", F.lit(0.0), lambda a, x: a + x["w"] * F.element_at(cap_of, (x["s"] + 1).cast("int"))) / F.greatest(F.col("tokens"), F.lit(1.0))
    groups = cut(groups.withColumn("cap", F.when(F.col("label") < 0, soft).otherwise(F.element_at(cap_of, (F.greatest("label", F.lit(0)) + 1).cast("int")))))
    whole = float(groups.where("label >= 0").agg(F.sum("tokens")).first()[0] or 0.0)
    goal = np.array([float(r["share"] or 0) for r in want] + [0.0]) * whole
    history, totals = fit_rates(groups, goal)
    rate = F.lit(1.0) if history else F.lit(0.0)
    for k, move in enumerate(history, 1):
        rate = _moved(rate, move)
        if k % 8 == 0:
            groups = groups.withColumn(f"rate{k}", rate)
            rate = F.col(f"rate{k}")
    return Mix(names, model, caps, goal, totals, history, groups.withColumn("rate", rate))


def mix_report(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, trust: float = LABEL_TRUST) -> DataFrame:
    """(source, documents, tokens, target_share, max_repeats, repeats, mixed_tokens, goal_share, reached_share, short) of each target source.

    documents and tokens are those labelled with the source; repeats is their mean rate by tokens (a rate of 1.4 takes a row once and
    four in ten a second time), between 0 and max_repeats; mixed_tokens counts them in the mix. goal_share is the source's expected
    tokens in the mix, soft members included, against the tokens of all documents that have a source, which is what the fit
    brings to target_share; reached_share is the same against the mix, which is smaller where sources fall short, so that the
    others have more of it. `short` tells that the fit stays a hundredth or more below the target. Null and
    empty texts have no tokens; null or blank sources belong to no source but enter the fit by their posterior; a source
    without documents has 0 documents; of repeated target rows the largest numbers hold.
    """
    spark = documents.sparkSession
    mix = fit_mix(documents, targets, path, trust)
    size, whole = float(mix.totals.sum()), float(mix.groups.where("label >= 0").agg(F.sum("tokens")).first()[0] or 0.0)
    fit = spark.createDataFrame(
        [(i, n, float(t / whole) if whole else 0.0, float(t / size) if size else 0.0, bool(t < 0.99 * g)) for i, (n, g, t) in enumerate(zip(mix.names, mix.goal, mix.totals, strict=False))],
        "label long, source string, goal_share double, reached_share double, short boolean",
    )
    own = mix.groups.groupBy("label").agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"), F.sum(F.col("rate") * F.col("tokens")).alias("mixed"))
    want = targets.where("source is not null").groupBy(F.col("source").alias("w")).agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return fit.join(own, "label", "left").join(want, F.col("source") == F.col("w")).select(
        "source", F.coalesce("documents", F.lit(0)).alias("documents"), zero("tokens").cast("long").alias("tokens"), "target_share", "max_repeats",
        F.round(F.coalesce(F.try_divide("mixed", "tokens"), F.lit(0.0)), 4).alias("repeats"), F.round(zero("mixed")).cast("long").alias("mixed_tokens"),
        F.round("goal_share", 6).alias("goal_share"), F.round("reached_share", 6).alias("reached_share"), "short",
    )


def _repeater(mix: Mix, path: str, trust: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            tokens, label = _tokens(batch, path), batch.column("label").to_numpy()
            rate = mix.rates(mix.model.posteriors(tokens, label, trust), label)
            draw = batch.column("draw").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), pa.array([len(t) for t in tokens], pa.int64()), pa.array(rate, pa.float64()), pa.array((np.floor(rate) + (draw < rate - np.floor(rate))).astype(np.int32), pa.int32())],
                names=["doc_id", "source", "tokens", "rate", "repeats"],
            )

    return repeat


def mixed_records(documents: DataFrame, targets: DataFrame, path: str = TOKENIZER, trust: float = LABEL_TRUST) -> DataFrame:
    """(doc_id, source, tokens, rate, repeats): the mix itself, each document with how often it is taken.

    A document's rate is what its own posterior comes to under the fit; repeats is the rate rounded down, or up as often as its fraction
    says, by a hash of the key, so that a second run takes the same. Documents that are not taken at all have no row. Equal rows
    are mixed each; a null key is rounded like any other.
    """
    mix = fit_mix(documents, targets, path, trust)
    plain = Mix(mix.names, mix.model, mix.caps, mix.goal, mix.totals, mix.history, None)  # the groups stay on the driver's side
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = _labelled(documents, mix.names).withColumn("draw", F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 20)) / F.lit(float(1 << 20)))
    return rows.select("doc_id", "text", "source", "label", "draw").mapInArrow(_repeater(plain, path, trust), f"doc_id {kind}, source string, tokens long, rate double, repeats int").where("repeats > 0")
