"""Validating receipts as relations: one row of the receipts table is a receipt, and each rule yields the rows that break it.

receipts: (receipt, status, sources array<struct<path, role, sha256>>, outputs array<struct<path, role, sha256>>,
evidence array<struct<domain, id, path, sha256, delivery_path, delivery_sha256>>,
gates array<struct<id, required, result, evidence array<string>, reason>>).
files: (path, sha256) of what is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probata.functions.paths import is_portable, is_sha256
from probata.operators.checks import gate_problems, gate_status

# Fixed values.
STATUSES = ("validated", "prototype", "blocked", "failed")
SOURCE_ROLES = ("user_authored", "generated_source", "licensed_source", "working_frame")
OUTPUT_ROLES = ("editable_source", "engine_delivery", "frame_manifest", "preview", "audit")
SINGLE_ROLES = ("engine_delivery", "frame_manifest", "audit")
DOMAINS = ("artifact", "visual_native_scale", "visual_gameplay_scale", "animation", "tileset_or_ui", "engine_import")

SCHEMA = (
    "receipt string, status string, sources array<struct<path string, role string, sha256 string>>, outputs array<struct<path string, role string, sha256 string>>, "
    "evidence array<struct<domain string, id string, path string, sha256 string, delivery_path string, delivery_sha256 string>>, "
    "gates array<struct<id string, required boolean, result string, evidence array<string>, reason string>>"
)


def _rows(receipts: DataFrame, column: str) -> DataFrame:
    return receipts.select("receipt", F.explode(column).alias("r")).select("receipt", "r.*")


def _code(rows: DataFrame, code: str, where: Column | str | None = None) -> DataFrame:
    return (rows if where is None else rows.filter(where)).select("receipt", F.lit(code).alias("code"))


def named_files(receipts: DataFrame) -> DataFrame:
    """(receipt, kind, role, path, sha256): every file that a receipt names."""
    part = lambda c, role: _rows(receipts, c).select("receipt", F.lit(c).alias("kind"), F.col(role).alias("role"), "path", "sha256")
    return part("sources", "role").union(part("outputs", "role")).union(part("evidence", "domain"))


def file_problems(receipts: DataFrame, files: DataFrame) -> DataFrame:
    """Paths that are not portable, digests that are none, files that are missing or hold something else, and files named in two parts."""
    named = named_files(receipts)
    fine = named.filter(is_portable(F.col("path"), strict=True) & is_sha256(F.col("sha256")))
    there = fine.join(files.select("path", F.col("sha256").alias("found")), "path", "left")
    role = F.when(F.col("kind") == "sources", F.col("role").isin(*SOURCE_ROLES)).when(F.col("kind") == "outputs", F.col("role").isin(*OUTPUT_ROLES)).otherwise(F.col("role").isin(*DOMAINS))
    twice = named.filter("kind <> 'evidence'").groupBy("receipt", F.lower("path").alias("p")).agg(F.count_distinct("kind").alias("kinds"), F.count(F.lit(1)).alias("n"))
    return (
        _code(named, "PATH_NOT_PORTABLE", ~is_portable(F.col("path"), strict=True))
        .union(_code(named, "SHA256_INVALID", ~is_sha256(F.col("sha256"))))
        .union(_code(named, "ROLE_INVALID", ~F.coalesce(role, F.lit(False))))
        .union(_code(there, "FILE_MISSING", F.col("found").isNull()))
        .union(_code(there, "FILE_HASH_MISMATCH", F.col("found") != F.col("sha256")))
        .union(_code(twice, "SOURCE_OUTPUT_FILE_ALIAS", "kinds > 1"))
        .union(_code(twice, "PATH_DUPLICATE", "kinds = 1 and n > 1"))
    )


def role_problems(receipts: DataFrame) -> DataFrame:
    """A code for each role that must have exactly one output and has not."""
    have = _rows(receipts, "outputs").groupBy("receipt", "role").agg(F.count(F.lit(1)).alias("n"))
    want = receipts.select("receipt", F.explode(F.array(*map(F.lit, SINGLE_ROLES))).alias("role"))
    return _code(want.join(have, ["receipt", "role"], "left"), "OUTPUT_ROLE_CARDINALITY_INVALID", "coalesce(n, 0) <> 1")


def evidence_problems(receipts: DataFrame) -> DataFrame:
    """Repeated ids in a domain, and engine evidence that is not about the one delivery."""
    rows = _rows(receipts, "evidence")
    repeated = rows.groupBy("receipt", "domain", F.lower("id").alias("i")).count()
    delivery = _rows(receipts, "outputs").filter("role = 'engine_delivery'").groupBy("receipt").agg(F.count(F.lit(1)).alias("n"), F.first("path").alias("p"), F.first("sha256").alias("s")).filter("n = 1")
    engine = rows.filter("domain = 'engine_import'").join(delivery, "receipt")
    bound = F.col("delivery_path").eqNullSafe(F.col("p")) & F.col("delivery_sha256").eqNullSafe(F.col("s"))
    return _code(repeated, "EVIDENCE_ID_DUPLICATE", "count > 1").union(_code(engine, "ENGINE_DELIVERY_BINDING_MISMATCH", ~bound))


def _gates(receipts: DataFrame) -> DataFrame:
    return _rows(receipts, "gates").withColumn("cites_engine", F.exists(F.coalesce("evidence", F.array().cast("array<string>")), lambda e: e.startswith("engine_import:")))


def reference_problems(receipts: DataFrame) -> DataFrame:
    """Gates that cite what is not there, cite it twice, or share an id; and receipts without gates."""
    gates = _gates(receipts)
    cited = gates.select("receipt", F.explode("evidence").alias("ref"))
    known = _rows(receipts, "evidence").select("receipt", F.concat_ws(":", "domain", "id").alias("ref"))
    again = gates.filter(F.size(F.array_distinct("evidence")) < F.size("evidence"))
    same = gates.groupBy("receipt", F.lower("id").alias("i")).count()
    return (
        _code(cited.join(known, ["receipt", "ref"], "left_anti"), "GATE_EVIDENCE_UNKNOWN")
        .union(_code(again, "GATE_EVIDENCE_DUPLICATE"))
        .union(_code(same, "GATE_ID_DUPLICATE", "count > 1"))
        .union(_code(receipts, "GATES_INVALID", "coalesce(size(gates), 0) < 1"))
        .union(gate_problems(gates.withColumnRenamed("receipt", "subject")).select(F.col("subject").alias("receipt"), "code"))
    )


def reduced(receipts: DataFrame) -> DataFrame:
    """(receipt, reduced): the status that gates and engine evidence come to; a receipt without gates is a prototype."""
    engine = _rows(receipts, "evidence").filter("domain = 'engine_import'").select("receipt").distinct().withColumn("engine", F.lit(True))
    gates = _gates(receipts).join(engine, "receipt", "left").withColumn("cites_engine", F.col("cites_engine") & F.coalesce("engine", F.lit(False)))
    status = gate_status(gates, "receipt")
    return receipts.select("receipt").join(status, "receipt", "left").select("receipt", F.coalesce("status", F.lit("prototype")).alias("reduced"))


def problems(receipts: DataFrame, files: DataFrame) -> DataFrame:
    """(receipt, code, n) of everything that is wrong with each receipt."""
    declared = receipts.select("receipt", "status").join(reduced(receipts), "receipt")
    known = F.coalesce(F.col("status").isin(*STATUSES), F.lit(False))
    found = (
        _code(receipts, "STATUS_INVALID", ~known)
        .union(_code(declared, "STATUS_REDUCTION_MISMATCH", known & (F.col("status") != F.col("reduced"))))
        .union(file_problems(receipts, files))
        .union(role_problems(receipts))
        .union(evidence_problems(receipts))
        .union(reference_problems(receipts))
    )
    return found.groupBy("receipt", "code").agg(F.count(F.lit(1)).alias("n"))


def validated(receipts: DataFrame, files: DataFrame) -> DataFrame:
    """(receipt, reduced, problems, verdict): a receipt passes if nothing is wrong with it, also one that truly failed."""
    n = problems(receipts, files).groupBy("receipt").agg(F.sum("n").alias("problems"))
    out = reduced(receipts).join(n, "receipt", "left").withColumn("problems", F.coalesce("problems", F.lit(0).cast("long")))
    return out.withColumn("verdict", F.when(F.col("problems") == 0, "pass").otherwise("fail"))
