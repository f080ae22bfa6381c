"""Queries over vectors and events."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.operators import signals, vectors
from quillstream.session import cut, ensure_checkpoint_dir, table
from quillstream.streaming import signals as streams

DAY = 86_400.0


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings")


def _queries(e: DataFrame) -> DataFrame:
    return e.where(F.col("vec_id") % 50 == 0)


def vector_topk(spark: SparkSession, folder: str) -> DataFrame:
    e = _embeddings(spark, folder)
    return vectors.top_k(e, _queries(e))


_SCORED = """
q AS (SELECT vec_id AS query_id, embedding AS v FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, vec_id AS hit, list_cosine_similarity(v::DOUBLE[], embedding::DOUBLE[]) AS score FROM q, embeddings {where}),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, hit) AS rank, hit, round(score, 4) AS score FROM s)"""
VECTOR_TOPK = f"WITH {_SCORED.format(where='')} SELECT query_id, CAST(rank AS INTEGER) AS rank, hit, score FROM r WHERE rank <= 5"


def vector_topk_filtered(spark: SparkSession, folder: str) -> DataFrame:
    e = _embeddings(spark, folder)
    return vectors.top_k(e.where("label = 1"), _queries(e), k=10)


VECTOR_TOPK_FILTERED = f"WITH {_SCORED.format(where='WHERE label = 1')} SELECT query_id, CAST(rank AS INTEGER) AS rank, hit, score FROM r WHERE rank <= 10"


def vector_norm_check(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.norm_check(_embeddings(spark, folder))


VECTOR_NORM_CHECK = "WITH n AS (SELECT vec_id, len(embedding) AS dimensions, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings) SELECT vec_id, CAST(dimensions AS INTEGER) AS dimensions, round(norm, 4) AS norm, abs(norm - 1) <= 0.001 AS unit FROM n"


def search_results(spark: SparkSession, folder: str) -> DataFrame:
    e = _embeddings(spark, folder)
    hits = vectors.top_k(e, _queries(e))
    shown = hits.join(e.select(F.col("vec_id").alias("hit"), "label"), "hit")
    return shown.select("query_id", F.to_json(F.struct("rank", F.col("score").cast("decimal(6,4)").alias("score"), F.col("hit").alias("id"), "label")).alias("result"))


SEARCH_RESULTS = f"""
WITH {_SCORED.format(where='')} SELECT query_id, '{{"rank":' || rank || ',"score":' || CAST(score AS DECIMAL(6, 4)) || ',"id":' || hit || ',"label":' || label || '}}' AS result
FROM r JOIN embeddings e ON e.vec_id = r.hit WHERE rank <= 5"""


def evaluation_rows(spark: SparkSession, folder: str) -> DataFrame:
    e = _embeddings(spark, folder)
    return vectors.evaluation_rows(vectors.top_k(e, _queries(e)), e, e)


EVALUATION_ROWS = f"""
WITH {_SCORED.format(where='')} SELECT query_id, CAST(rank AS INTEGER) AS rank, score, hit, h.label AS category, q0.label AS expected, h.label = q0.label AS right
FROM r JOIN embeddings h ON h.vec_id = hit JOIN embeddings q0 ON q0.vec_id = query_id WHERE rank <= 5"""


def index_recall(spark: SparkSession, folder: str) -> DataFrame:
    e = _embeddings(spark, folder)
    centres = vectors.inverted_file(e)
    index = cut(vectors.assign_cells(e, centres))
    probes = vectors.tuned_probes(e, index, centres)
    return vectors.recall(vectors.indexed_top_k(index, _queries(e), centres, probes=probes), vectors.top_k(e, _queries(e)))


def event_cooldown(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return signals.cooldown(e, ["user_id", "event_type"], "ts", DAY, "event_id").select("event_id", "decision")


EVENT_COOLDOWN = """
WITH RECURSIVE e AS (SELECT event_id, user_id, event_type, ts, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events),
g AS (SELECT event_id, user_id, event_type, ts, n, ts AS last, TRUE AS keep FROM e WHERE n = 1
  UNION ALL SELECT e.event_id, e.user_id, e.event_type, e.ts, e.n, CASE WHEN e.ts - g.last >= INTERVAL 24 HOURS THEN e.ts ELSE g.last END, e.ts - g.last >= INTERVAL 24 HOURS
  FROM g JOIN e ON e.user_id = g.user_id AND e.event_type = g.event_type AND e.n = g.n + 1)
SELECT event_id, CASE WHEN keep THEN 'keep' ELSE 'suppress' END AS decision FROM g"""


def event_cooldown_counts(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    done = signals.cooldown(e, ["user_id", "event_type"], "ts", DAY, "event_id")
    return done.groupBy("event_type").agg(F.count_if(F.col("decision") == "keep").alias("kept"), F.count_if(F.col("decision") == "suppress").alias("suppressed"))


EVENT_COOLDOWN_COUNTS = EVENT_COOLDOWN.replace("SELECT event_id, CASE WHEN keep THEN 'keep' ELSE 'suppress' END AS decision FROM g", "SELECT event_type, count_if(keep) AS kept, count_if(NOT keep) AS suppressed FROM g GROUP BY event_type")


def event_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    return signals.floor_percentiles(table(spark, folder, "events"), "value", (0.5, 0.95), "event_type")


EVENT_PERCENTILES = """
WITH s AS (SELECT event_type, list_sort(list(value)) AS v FROM events WHERE value IS NOT NULL GROUP BY event_type), p AS (SELECT unnest([0.5, 0.95]) AS share)
SELECT event_type, CAST(share AS DOUBLE) AS share, v[CAST(floor(CAST(share AS DOUBLE) * (len(v) - 1)) AS BIGINT) + 1] AS value FROM s, p"""


def event_windows(spark: SparkSession, folder: str) -> DataFrame:
    e = table(spark, folder, "events")
    return signals.tumbling(e, "ts", "6 hours", ["event_type"], "value")


EVENT_WINDOWS = "SELECT time_bucket(INTERVAL 6 HOURS, ts, TIMESTAMP '1970-01-01') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"

#: Keywords that the calls and letters of the corpus use; the rules are data, so that any table of them can take their place.
CORPUS_RULES = (
    ("COMPLAINT", ("lodge a complaint", "grievance", "ticket number"), 0.9, "HIGH"),
    ("PAYMENT", ("net banking", "demand draft", "renewal premium", "can't pay"), 0.8, "MEDIUM"),
    ("LOAN", ("loan of up to", "surrender value", "interest at"), 0.6, "LOW"),
    ("PROMISE", ("oral promise", "bonus against a fee"), 0.93, "HIGH"),
    ("HELP", ("sorry i still do not understand", "can you tell me"), None, None),
)


def signal_detect(spark: SparkSession, folder: str) -> DataFrame:
    found = signals.detect(table(spark, folder, "documents").select("doc_id", "text"), "text", CORPUS_RULES)
    return found.select("doc_id", "type", "confidence", "priority", F.array_join("matched_keywords", "|").alias("keywords"))


_SPOKEN = r"trim(regexp_replace(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _rule_sql() -> str:
    rows = []
    for n, (kind, words, confidence, priority) in enumerate(CORPUS_RULES, 1):
        quoted = [w.replace("'", "''") for w in words]
        spoken = [_SPOKEN.format(f"'{w}'") for w in quoted]
        hits = ", ".join(f"CASE WHEN contains(s, {k}) THEN '{w}' END" for w, k in zip(quoted, spoken, strict=True))
        rows.append(f"SELECT doc_id, {n} AS ord, '{kind}' AS type, CAST({confidence if confidence is not None else 'NULL'} AS DOUBLE) AS confidence, CAST({repr(priority) if priority else 'NULL'} AS VARCHAR) AS priority, list_filter([{hits}], lambda x: x IS NOT NULL) AS k FROM d")
    return f"WITH d AS (SELECT doc_id, {_SPOKEN.format('text')} AS s FROM documents), r AS ({' UNION ALL '.join(rows)})"


SIGNAL_DETECT = f"{_rule_sql()} SELECT doc_id, type, confidence, priority, array_to_string(k, '|') AS keywords FROM r WHERE len(k) > 0"


def signal_first(spark: SparkSession, folder: str) -> DataFrame:
    return signals.first_signal(signals.detect(table(spark, folder, "documents").select("doc_id", "text"), "text", CORPUS_RULES), "doc_id")


SIGNAL_FIRST = f"{_rule_sql()} SELECT doc_id, arg_min(type, ord) AS type FROM r WHERE len(k) > 0 GROUP BY doc_id"


def signal_gate(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "retrieved_at_utc", "text")
    found = signals.detect(d, "text", CORPUS_RULES).drop("text", "matched_keywords")
    done = signals.gate(found, ["source", "type"], "retrieved_at_utc", "doc_id", 0.7, 3600.0)
    return done.select("doc_id", "type", "decision", "reason")


SIGNAL_GATE = f"""
{_rule_sql().replace('WITH d AS', 'WITH RECURSIVE d AS')},
x AS (SELECT r.doc_id, r.type, r.confidence, coalesce(t.source, '') AS source, t.retrieved_at_utc AS ts FROM r JOIN documents t USING (doc_id) WHERE len(k) > 0),
e AS (SELECT *, row_number() OVER (PARTITION BY source, type ORDER BY ts, doc_id) AS n FROM x WHERE confidence >= 0.7 AND ts IS NOT NULL),
g AS (SELECT doc_id, source, type, ts, n, ts AS last, TRUE AS keep FROM e WHERE n = 1
  UNION ALL SELECT e.doc_id, e.source, e.type, e.ts, e.n, CASE WHEN e.ts - g.last >= INTERVAL 1 HOUR THEN e.ts ELSE g.last END, e.ts - g.last >= INTERVAL 1 HOUR FROM g JOIN e ON e.source = g.source AND e.type = g.type AND e.n = g.n + 1)
SELECT doc_id, type, CASE WHEN keep THEN 'keep' ELSE 'suppress' END AS decision, CASE WHEN NOT keep THEN 'cooldown' END AS reason FROM g
UNION ALL SELECT doc_id, type, 'suppress', CASE WHEN confidence IS NULL THEN 'missing_confidence' WHEN confidence < 0.7 THEN 'below_confidence_threshold' ELSE 'missing_time' END FROM x WHERE confidence IS NULL OR confidence < 0.7 OR ts IS NULL"""


def _folders(spark: SparkSession) -> tuple[str, str]:
    base = ensure_checkpoint_dir(spark)
    name = uuid.uuid4().hex
    return f"{base}/stream-{name}/out", f"{base}/stream-{name}/state"


def stream_cooldown(spark: SparkSession, folder: str) -> DataFrame:
    stream = streams.read_events(spark, folder)
    out = streams.cooldown_stream(stream, ["user_id", "event_type"], "ts", DAY, "event_id")
    return streams.run_to_table(out, *_folders(spark)).select("event_id", "decision")


STREAM_COOLDOWN = EVENT_COOLDOWN


def stream_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's events of a kind as one transcript, in the order of their times."""
    e = table(spark, folder, "events")
    return signals.transcripts(e.withColumn("at", F.struct("ts", "event_id")), "user_id", "at", "event_type")


STREAM_TRANSCRIPTS = "SELECT user_id, string_agg(trim(event_type), ' ' ORDER BY ts, event_id) AS transcript FROM events WHERE trim(event_type) <> '' GROUP BY user_id"

NAMES = (
    "vector_topk", "vector_topk_filtered", "vector_norm_check", "search_results", "evaluation_rows", "index_recall", "stream_transcripts", "event_cooldown", "event_cooldown_counts", "event_percentiles",
    "event_windows", "signal_detect", "signal_first", "signal_gate", "stream_cooldown",
)
QUERIES = {n: globals()[n] for n in NAMES}
SQL = {n: globals()[n.upper()] for n in NAMES if n.upper() in globals()}
