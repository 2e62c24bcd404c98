"""Secret scan with an incremental blob ledger.

Every version of a document is content-addressed by the SHA-256 of its text. The
ledger, Parquet in a shared folder, has one row per scanned (blob, rule, rule
version) with the spans found, none included. A scan reads only the pairs that the
ledger does not have, one row per blob however many paths carry it, appends them,
and joins the spans back to all documents. A new rule or a raised version rescans
that rule alone; a batch that fails leaves no part behind, as Spark commits it
whole.

Spans count code points, end exclusive. Base rules, leftmost and non-overlapping
within a rule: ``assign`` (key word, separator, value of 6 or more characters),
``access`` (AKIA and at least 16 more), ``hex`` (24 or more hex digits). Added by
this operator: ``pem`` (private key blocks) and ``jwt`` (three-part tokens).

Null text counts as empty. Empty table: no rows. Repeated rows give repeated rows.
Other columns, whatever their names, are ignored by ``scan`` and passed through by
``redact``."""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import arrow_rows, fresh, new_folder, text_of

#: Fixed order of kinds; the first three are the base rules. Raise a version when a pattern changes.
RULES = (("assign", 1), ("access", 1), ("hex", 1), ("pem", 1), ("jwt", 1))
BASE = ("assign", "access", "hex")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----.*?-----END \1-----", re.DOTALL)
_JWT = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
_KEY_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Texts that a task hands to its worker at once.
BATCH_ROWS = 256

LEDGER = "blob binary, kind string, version int, starts array<int>, ends array<int>"


def spans(text: str, kind: str) -> list[tuple[int, int]]:
    """The spans of one rule in ``text``."""
    if kind == "assign":
        low = text.lower()
        if not any(w in low for w in _KEY_WORDS):
            return []
        return [m.span() for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if kind == "access":
        return [m.span() for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    if kind == "hex":
        return [m.span() for m in _HEX.finditer(text)]
    if kind == "pem":
        return [m.span() for m in _PEM.finditer(text)] if "PRIVATE KEY-----" in text else []
    if kind == "jwt":
        return [m.span() for m in _JWT.finditer(text)] if "eyJ" in text else []
    raise ValueError(kind)


def _scan(batches):
    schema = pa.schema([("blob", pa.binary()), ("kind", pa.string()), ("version", pa.int32()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])
    seen = set()  # repeated rows of one document meet in one task
    for b in batches:
        out: list[list] = [[], [], [], [], []]
        for blob, text, due in zip(b["blob"], b["text"], b["due"], strict=True):
            blob = blob.as_py()
            if blob in seen:
                continue
            seen.add(blob)
            text = text.as_py()
            for rule in due.as_py():
                found = spans(text, rule["kind"])
                for column, value in zip(out, (blob, rule["kind"], rule["version"], [s for s, _ in found], [e for _, e in found]), strict=True):
                    column.append(value)
        yield pa.record_batch([pa.array(c, t.type) for c, t in zip(out, schema, strict=True)], schema=schema)


def _read(spark, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(f"{ledger}/batch-*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def update(docs: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """Scan what ``ledger`` lacks of ``docs``, append it, and return the ledger's
    rows for ``rules``."""
    spark = docs.sparkSession
    known = _read(spark, ledger)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("text", 256)))
    wanted = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).cast("int").alias("version")) for k, v in rules])
    blobs = rows.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    if known.isEmpty():
        due = blobs.withColumn("due", wanted)
    else:
        pairs = blobs.withColumn("rule", F.explode(wanted)).select("blob", "doc_id", "rule.kind", "rule.version", "rule")
        pairs = pairs.join(known.select("blob", "kind", "version").distinct(), ["blob", "kind", "version"], "left_anti")
        due = pairs.groupBy("blob", "doc_id").agg(F.collect_list("rule").alias("due"))
    due = due.select(F.col("blob").alias("due_blob"), F.col("doc_id").alias("due_id"), "due")
    todo = rows.join(due.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(due["due_id"]) & (rows["blob"] == due["due_blob"]))
    found = todo.select("blob", "text", "due").mapInArrow(_scan, LEDGER)
    with arrow_rows(spark, BATCH_ROWS):
        found.write.parquet(f"{ledger}/batch-{uuid.uuid4().hex}")
    current = " OR ".join(f"(kind = '{k}' AND version = {v})" for k, v in rules)
    return _read(spark, ledger).filter(current)


def findings(docs: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """blob, found (array of start, rank, kind, end in the order of output) of the
    blobs of ``docs`` with at least one span."""
    rank = F.create_map(*[x for i, (k, _) in enumerate(rules) for x in (F.lit(k), F.lit(i))])
    rows = update(docs, ledger, rules).filter(F.size("starts") > 0).dropDuplicates(["blob", "kind"])
    each = rows.select("blob", F.transform(F.arrays_zip("starts", "ends"), lambda x: F.struct(x["starts"].alias("start"), rank[F.col("kind")].alias("rank"), F.col("kind").alias("kind"), x["ends"].alias("end"))).alias("part"))
    return each.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("part"))).alias("found"))


def _line(found):
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, ledger: str | None = None, rules=RULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans. Without ``ledger`` a new one is begun."""
    ledger = ledger or new_folder(docs.sparkSession, "secret-ledger")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.unhex(F.sha2(text_of(docs), 256)).alias("blob"))
    all_rows = rows.join(findings(docs, ledger, rules), "blob", "left")
    found = F.coalesce(F.col("found"), F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>"))
    all_rows = all_rows.select("doc_id", found.alias("found"))
    base = F.filter("found", lambda x: x["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("found", lambda x: x["kind"] == k)).cast("long")
    return all_rows.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(_line(base), 256).alias("base_sha256"), _line(F.col("found")).alias("spans"))


def redact(docs: DataFrame, ledger: str | None = None, rules=RULES) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (overlapping spans
    by the first one's); n_chars, where there is such a column, follows the text."""
    ledger = ledger or new_folder(docs.sparkSession, "secret-ledger")
    blob, found, other = fresh(docs, "blob_", "found_", "other_")
    hits = findings(docs, ledger, rules).select(F.col("blob").alias(other), F.col("found").alias(found))
    rows = docs.withColumn(blob, F.unhex(F.sha2(text_of(docs), 256)))
    rows = rows.join(hits.hint("shuffle_hash"), rows[blob] == hits[other], "left")

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, x):
        text = F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"]), F.lit("["), x["kind"], F.lit("]"))
        return F.struct(F.when(x["start"] >= acc["at"], text).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))

    done = lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    hit = F.col(found).isNotNull()
    changed = rows.withColumn("text", F.when(hit, F.aggregate(found, start, step, done)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(hit, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])
