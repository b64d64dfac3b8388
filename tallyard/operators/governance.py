"""Governance ledgers as event tables: signals, claims, coverage, audit, receipts, SQL policy, governed retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.canonical import canonical_json, json_string
from . import claims
from .nearest import nearest_granted

FLOOR = 2.0**-10

#: The steps of a claim, as status, action, next status. Locked, rejected and withdrawn are final.
STEPS = [
    ("draft", "submit", "submitted"), ("draft", "withdraw", "withdrawn"), ("submitted", "start_review", "under_review"), ("submitted", "withdraw", "withdrawn"),
    ("under_review", "approve", "approved"), ("under_review", "reject", "rejected"), ("under_review", "withdraw", "withdrawn"), ("approved", "lock", "locked"),
]

#: Half-lives of the kinds of signals, in seconds.
HALF_LIVES = {"reconciliation_run": 43200.0, "tombstone_batch": 21600.0, "key_scan_missing": 86400.0, "exception_disposition": 172800.0}

#: Words that no submitted query may contain, and table functions that it may not call.
FORBIDDEN = ["ALTER", "ATTACH", "CALL", "CHECKPOINT", "COPY", "CREATE", "DELETE", "DETACH", "DROP", "EXPORT", "GRANT", "IMPORT", "INSERT", "INSTALL", "LOAD", "MERGE", "PRAGMA", "RESET", "REVOKE", "SET", "TRUNCATE", "UPDATE", "USE", "VACUUM"]
TABLE_FUNCTIONS = ["read_csv", "read_csv_auto", "read_parquet", "parquet_scan", "read_json", "read_json_auto", "read_blob", "glob", "sqlite_scan", "postgres_scan", "mysql_scan", "httpfs", "delta_scan", "iceberg_scan"]


def with_signal_id(signals: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds signal_id: the first 16 hex digits of the SHA-256 of the canonical JSON of kind, payload and subject.

    The payload may be of any type that JSON has a form for, nested as it likes; without one it is the empty object.
    """
    body = F.when(F.col(payload).isNull(), "{}").otherwise(canonical_json(F.col(payload), signals.schema[payload].dataType))
    text = F.concat(F.lit('{"kind":'), json_string(F.col("kind")), F.lit(',"payload":'), body, F.lit(',"subject":'), json_string(F.col("subject")), F.lit("}"))
    return signals.withColumn("signal_id", F.substring(F.sha2(text, 256), 1, 16))


def post(signals: DataFrame) -> DataFrame:
    """One row per signal: posting is idempotent; the latest emission holds, with its half-life."""
    return signals.groupBy("signal_id", "kind", "subject").agg(
        F.max_by("half_life_seconds", F.struct("emitted_at", "half_life_seconds")).alias("half_life_seconds"), F.max("emitted_at").alias("emitted_at")
    )


def half_life(kind: Column) -> Column:
    """The half-life of a kind of signal in seconds; null for unknown kinds."""
    return F.create_map(*(F.lit(x) for pair in HALF_LIVES.items() for x in pair))[kind]


def salience(emitted_at: Column, half_life_seconds: Column, now: Column) -> Column:
    """0.5 to the power of age over half-life; a signal from the future counts as new."""
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(emitted_at.cast("timestamp"))) / F.lit(1e6)
    return F.pow(F.lit(0.5), F.greatest(F.lit(0.0), age) / half_life_seconds)


def read_signals(signals: DataFrame, now: Column, kinds: list[str] | None = None, minimum: float = 0.0) -> DataFrame:
    """Signals of the kinds at least that salient, in the total order (kind, subject, id)."""
    out = signals.withColumn("salience", salience(F.col("emitted_at"), F.col("half_life_seconds"), now))
    if kinds is not None:
        out = out.where(F.col("kind").isin(kinds))
    return out.where(F.col("salience") >= minimum).orderBy("kind", "subject", "signal_id")


def swept(signals: DataFrame, now: Column) -> DataFrame:
    """How many signals a sweep keeps and drops, by kind."""
    alive = salience(F.col("emitted_at"), F.col("half_life_seconds"), now) >= FLOOR
    return signals.groupBy("kind").agg(F.count_if(alive).alias("kept"), F.count_if(~alive).alias("dropped"))


def claim_states(opened: DataFrame, transitions: DataFrame, steps: list[tuple[str, str, str]] = STEPS) -> DataFrame:
    """Current state of each claim (claim_id, opened_by), and the person that confirmed its lock: its moves replayed in
    order, where one that breaks a rule leaves the claim as it was."""
    return claims.states_of(opened, claims.replayed(opened, transitions, steps))


def illegal_transitions(opened: DataFrame, transitions: DataFrame, steps: list[tuple[str, str, str]] = STEPS) -> DataFrame:
    """Ledger lines that break a rule, with the first one broken and the state that they met.

    UNKNOWN_CLAIM (none opened), ILLEGAL_STEP, UNNAMED_ACTOR, FOUR_EYES (who opened a claim approves or locks it),
    ANONYMOUS_LOCK (nobody confirms a lock), SELF_CONFIRMED (the actor does). Names are compared without regard to case
    and outer spaces. transitions: claim_id, seq, at, action, to_status, actor, confirmed_by.
    """
    rows = claims.replayed(opened, transitions, steps).where("rule IS NOT NULL")
    return rows.select("claim_id", "seq", "before", "action", "to_status", "actor", "rule")


def lock_gate(states: DataFrame, requests: DataFrame) -> DataFrame:
    """Per export (export_id, claim_id): granted only if every claim asked for is locked, with a hash of the content."""
    rows = requests.join(states.select("claim_id", "status"), "claim_id", "left")
    content = F.to_json(F.array_sort(F.collect_list(F.struct("claim_id", "status"))))
    out = rows.groupBy("export_id").agg(F.bool_and(F.coalesce(F.col("status") == "locked", F.lit(False))).alias("granted"), F.count(F.lit(1)).alias("claims"), F.sha2(content, 256).alias("h"))
    return out.select("export_id", "granted", "claims", F.when(F.col("granted"), F.col("h")).alias("content_hash"))


def normalized_question(text: Column) -> Column:
    """Lower case, white space collapsed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\n\r\f\x0B]+", " "))


def coverage_queue(requests: DataFrame) -> DataFrame:
    """Questions without an answer, by how often they were asked, then by how recently. requests: question, reason, at."""
    q = requests.withColumn("normalized_question", normalized_question(F.col("question")))
    out = q.groupBy(F.substring(F.sha2("normalized_question", 256), 1, 12).alias("question_hash"), "normalized_question").agg(
        F.count(F.lit(1)).alias("request_count"), F.min("at").alias("first_requested_at"), F.max("at").alias("last_requested_at"), F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons")
    )
    return out.orderBy(F.desc("request_count"), F.desc("last_requested_at"), "question_hash")


def audit_trail(events: DataFrame, limit: int = 100) -> DataFrame:
    return events.orderBy(F.desc("at"), F.desc("id")).limit(limit)


def outcome_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def redemptions(events: DataFrame) -> DataFrame:
    """Each redemption of a receipt: REDEEMED (the first, in time), EXPIRED, or REPLAY. Every one after the first is a replay."""
    w = Window.partitionBy("receipt_id").orderBy("redeemed_at", "event_id")
    nth = events.withColumn("nth", F.row_number().over(w))
    verdict = F.when(F.col("nth") > 1, "REPLAY").when(F.col("redeemed_at") >= F.col("expires_at"), "EXPIRED").otherwise("REDEEMED")
    return nth.withColumn("verdict", verdict).drop("nth")


def broken_entries(ledger: DataFrame) -> DataFrame:
    """Entries whose body doesn't have the digest that they store; a body that isn't text counts by its canonical JSON."""
    kind = ledger.schema["body"].dataType
    body = F.col("body") if isinstance(kind, (T.StringType, T.BinaryType)) else canonical_json(F.col("body"), kind)
    return ledger.where(~F.sha2(body, 256).eqNullSafe(F.col("body_sha256")))


def sql_policy(log: DataFrame, column: str = "sql") -> DataFrame:
    """The verdict on each submitted text: OK, EMPTY, MULTIPLE_STATEMENTS, NOT_SELECT, FILE_FUNCTION or FORBIDDEN_KEYWORD.

    Comments don't count, quoted strings do. Words are whole runs of letters and underscores, so created_at isn't CREATE;
    a function is refused only where it is called, so a column may be named glob.
    """
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"(?s)/\*.*?\*/", " "), r"--[^\n]*", " ")
    text = F.regexp_replace(bare, r"^\s+|\s+$", "")
    words = F.regexp_extract_all(F.upper(text), F.lit(r"([A-Z_]+)"), 1)
    verdict = (
        F.when(text == "", "EMPTY").when(F.regexp_replace(text, r";+$", "").contains(";"), "MULTIPLE_STATEMENTS").when(~text.rlike(r"(?i)^(select|with)\b"), "NOT_SELECT")
        .when(text.rlike(rf"(?i)\b({'|'.join(TABLE_FUNCTIONS)})\s*\("), "FILE_FUNCTION").when(F.arrays_overlap(words, F.array(*map(F.lit, FORBIDDEN))), "FORBIDDEN_KEYWORD").otherwise("OK")
    )
    return log.withColumn("verdict", verdict)


def over_cap(result: DataFrame, cap: int = 10_000) -> DataFrame:
    """Whether a result has more rows than the cap: an error then, never a silent cut."""
    return result.limit(cap + 1).agg(F.count(F.lit(1)).alias("seen")).select(F.least("seen", F.lit(cap + 1)).alias("seen"), (F.col("seen") > cap).alias("exceeded"))


def granted_documents(documents: DataFrame, principals: DataFrame) -> DataFrame:
    """(principal, doc_id) that a grant covers: the principal itself or one of its roles is in the document's allow list.

    documents: doc_id, allow (array); principals: principal, roles (array). Unknown ones are in no row: denied.
    """
    allow = documents.select("doc_id", F.explode("allow").alias("name"))
    names = principals.select("principal", F.explode(F.array_union(F.array("principal"), F.coalesce("roles", F.array().cast("array<string>")))).alias("name"))
    return allow.join(names, "name").select("principal", "doc_id").distinct()


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays, in double precision, from left to right."""
    return F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def authorized_nearest(vectors: DataFrame, grants: DataFrame, queries: DataFrame, k: int = 10, docs_block: int = 2048, queries_block: int = 128) -> DataFrame:
    """Per query the k most similar documents among those granted to its principal; ties to the smaller doc_id.

    vectors: doc_id, vector; grants: principal, doc_id; queries: query_id, principal, query. k lies in 1..50. Documents
    that can't be scored (a null vector, one with null or non-finite components, or of another length) are no hits. The
    result is that of scoring every granted document, but cells of documents that can't hold a hit are left out (see
    :mod:`.nearest`).
    """
    return nearest_granted(vectors, grants, queries, max(1, min(50, k)), docs_block, queries_block)[0]


def post_verify(hits: DataFrame, queries: DataFrame, grants_now: DataFrame) -> DataFrame:
    """Hits against a fresh policy: outcome EXECUTED or POST_VERIFY_REMOVED."""
    now = grants_now.select("principal", "doc_id", F.lit(True).alias("still"))
    rows = hits.join(queries.select("query_id", "principal"), "query_id").join(now, ["principal", "doc_id"], "left")
    return rows.select("query_id", "principal", "doc_id", "rank", F.when(F.col("still"), "EXECUTED").otherwise("POST_VERIFY_REMOVED").alias("outcome"))


def hashed_bag(docs: DataFrame, dims: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Hashed bag of words: per row an array of ``dims`` token counts, the bucket from the token's SHA-256.

    dims must be a power of two up to 256, for which the 8th byte of the digest alone decides. Null and empty texts
    give zeros. Each text is counted where it is read: nothing is shuffled.
    """
    if dims not in (2, 4, 8, 16, 32, 64, 128, 256):
        raise ValueError("dims must be a power of two up to 256")
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[ \t\n\r\f\x0B]+"), lambda t: t != "")
    buckets = F.transform(tokens, lambda t: F.pmod(F.conv(F.substring(F.sha2(t, 256), 15, 2), 16, 10).cast("int"), F.lit(dims)))
    rows = docs.select(id_col, buckets.alias("b"))
    count = lambda i: (F.size("b") - F.size(F.array_remove("b", i))).cast("long")
    return rows.select(id_col, F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), count).alias("vector"))


def retrieval_outcomes(queries: DataFrame, verified: DataFrame) -> DataFrame:
    """Per query the outcome to record: NO_GRANTS, POST_VERIFY_REMOVED (some hit was taken away), or EXECUTED."""
    by = verified.groupBy("query_id").agg(F.count_if(F.col("outcome") == "POST_VERIFY_REMOVED").alias("removed"), F.count(F.lit(1)).alias("hits"))
    out = F.when(F.col("hits").isNull(), "NO_GRANTS").when(F.col("removed") > 0, "POST_VERIFY_REMOVED").otherwise("EXECUTED")
    return queries.select("query_id").join(by, "query_id", "left").select("query_id", out.alias("outcome"), F.coalesce("removed", F.lit(0)).alias("removed"))
