"""The chain of evidence of a receipt: what its gates, comparisons and audits refer to must be its own outputs, with the same hashes.

outputs: (receipt, path, sha256, role), one row for each file that was found as named. Each rule yields (receipt, code, item) rows for what breaks it.
Hashes are compared without case, paths in the form that paths.normal gives; a null never matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from probata.operators.compare import recomputed_differs
from probata.operators.semantics import reproducible

#: The ends of a comparison's chain, and the output role that each must be (fixed values).
ENDPOINTS = {"source_report": "source_audit", "imported_report": "import_audit", "delivery": "engine_delivery"}


def normal(path: Column) -> Column:
    """A path with forward slashes and without empty and single-dot parts."""
    return F.array_join(F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda p: (p != "") & (p != ".")), "/")


def same_hash(a: Column, b: Column) -> Column:
    return F.coalesce(F.lower(a) == F.lower(b), F.lit(False))


def _found(refs: DataFrame, outputs: DataFrame) -> DataFrame:
    """refs (receipt, item, path, ...) with the output of that path, if there is one: _there, _sha256, _role."""
    own = outputs.select("receipt", normal(F.col("path")).alias("_path"), F.col("sha256").alias("_sha256"), F.col("role").alias("_role"), F.lit(True).alias("_there"))
    return refs.withColumn("_path", normal(F.col("path"))).join(own, ["receipt", "_path"], "left")


def _code(rows: DataFrame, code: str, where: Column) -> DataFrame:
    return rows.filter(where).select("receipt", F.lit(code).alias("code"), F.col("item").cast("string").alias("item"))


def output_problems(refs: DataFrame, outputs: DataFrame, code: str) -> DataFrame:
    """References (receipt, item, path) that are no output."""
    return _code(_found(refs, outputs), code, F.col("_there").isNull())


def artifact_problems(refs: DataFrame, outputs: DataFrame) -> DataFrame:
    """What artifact gates cite (receipt, item, path, sha256, role): it must be an output, of the same hash and role."""
    found = _found(refs, outputs)
    same = same_hash(F.col("sha256"), F.col("_sha256")) & F.col("role").eqNullSafe(F.col("_role"))
    return _code(found, "ARTIFACT_GATE_NOT_OUTPUT", F.col("_there").isNull()).union(_code(found, "ARTIFACT_GATE_REFERENCE_MISMATCH", F.col("_there").isNotNull() & ~same))


def chain_problems(chain: DataFrame, outputs: DataFrame, audits: DataFrame) -> DataFrame:
    """A comparison's entries (receipt, item, path, sha256, run_id; items are the ENDPOINTS): all there, each an output of the same hash, and of audits (receipt, path, run_id) the same run."""
    want = chain.select("receipt").distinct().withColumn("item", F.explode(F.array(*map(F.lit, ENDPOINTS))))
    missing = want.join(chain.select("receipt", "item").distinct(), ["receipt", "item"], "left_anti")
    found = _found(chain, outputs)
    there = F.col("_there").isNotNull()
    runs = audits.select("receipt", normal(F.col("path")).alias("_path"), F.col("run_id").alias("_run"))
    audited = found.filter(there & (F.col("item") != "delivery")).join(runs, ["receipt", "_path"])
    return (
        _code(missing, "ROUNDTRIP_CHAIN_ENTRY_MISSING", F.lit(True))
        .union(_code(found, "ROUNDTRIP_CHAIN_NOT_OUTPUT", ~there))
        .union(_code(found, "ROUNDTRIP_CHAIN_HASH_MISMATCH", there & ~same_hash(F.col("sha256"), F.col("_sha256"))))
        .union(_code(audited, "ROUNDTRIP_RUN_ID_MISMATCH", ~F.col("run_id").eqNullSafe(F.col("_run"))))
    )


def endpoint_problems(chain: DataFrame, outputs: DataFrame, roles: dict[str, str] = ENDPOINTS) -> DataFrame:
    """The chain's ends against the outputs of their roles: exactly one output has the role, and it is the chain's."""
    role_of = F.create_map(*(F.lit(x) for pair in roles.items() for x in pair))
    ends = chain.filter(F.col("item").isin(*roles)).select("receipt", "item", role_of[F.col("item")].alias("role"), normal(F.col("path")).alias("_path"))
    one = outputs.groupBy("receipt", "role").agg(F.count(F.lit(1)).alias("n"), F.min(normal(F.col("path"))).alias("p"))
    both = ends.join(one, ["receipt", "role"], "left")
    single = F.coalesce("n", F.lit(0)) == 1
    return _code(both, "ROUNDTRIP_ROLE_CARDINALITY_INVALID", ~single).union(_code(both, "ROUNDTRIP_ENDPOINT_MISMATCH", single & ~F.col("_path").eqNullSafe(F.col("p"))))


def audit_bindings(audits: DataFrame, outputs: DataFrame) -> DataFrame:
    """Audits (receipt, item, manifest_sha256, delivery_sha256) against the digests of the manifest and the delivery; a digest that is null is not looked at."""
    digest = lambda role, name: outputs.filter(F.col("role") == role).groupBy("receipt").agg(F.min(F.lower("sha256")).alias(name))
    both = audits.join(digest("frame_manifest", "_m"), "receipt", "left").join(digest("engine_delivery", "_d"), "receipt", "left")
    off = lambda mine, theirs: F.col(mine).isNotNull() & ~same_hash(F.col(mine), F.col(theirs))
    return _code(both, "AUDIT_MANIFEST_BINDING_MISMATCH", off("manifest_sha256", "_m")).union(_code(both, "AUDIT_ENGINE_DELIVERY_BINDING_MISMATCH", off("delivery_sha256", "_d")))


def contract_problems(gates: DataFrame, contracts: DataFrame) -> DataFrame:
    """Contract gates (receipt, item, path, sha256) against the receipt's contract (receipt, path, sha256), if it has one."""
    c = contracts.select("receipt", normal(F.col("path")).alias("_p"), F.col("sha256").alias("_s"))
    both = gates.join(c, "receipt")
    same = normal(F.col("path")).eqNullSafe(F.col("_p")) & same_hash(F.col("sha256"), F.col("_s"))
    return _code(both, "CONTRACT_GATE_EVIDENCE_MISMATCH", ~same)


def audit_problems(checks: DataFrame, expected: DataFrame, declared: DataFrame) -> DataFrame:
    """Audits whose checks (receipt, check_id, verdict) are not exactly the expected ones (receipt, check_id), or whose declared verdict (receipt, verdict) does not follow."""
    a, e = checks.select("receipt", "check_id").distinct().withColumn("_a", F.lit(1)), expected.select("receipt", "check_id").distinct().withColumn("_e", F.lit(1))
    differ = a.join(e, ["receipt", "check_id"], "full_outer").filter("_a is null or _e is null").select("receipt", F.col("check_id").alias("item"))
    failed = checks.filter(~F.col("verdict").eqNullSafe("pass")).select("receipt").union(differ.select("receipt")).distinct().withColumn("_failed", F.lit(True))
    both = declared.join(failed, "receipt", "left").withColumn("item", F.col("verdict"))
    derived = F.when(F.col("_failed").isNull(), "pass").otherwise("fail")
    return (
        _code(differ, "AUDIT_CHECK_INVENTORY_MISMATCH", F.lit(True))
        .union(_code(both, "AUDIT_VERDICT_INCONSISTENT", ~F.col("verdict").eqNullSafe(derived)))
        .union(_code(both, "AUDIT_VERDICT_NOT_PASS", ~F.col("verdict").eqNullSafe("pass")))
    )


def replay_differs(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The rows by which a stored report and one made anew differ, but for what differs from run to run."""
    return recomputed_differs(reproducible(stored), reproducible(fresh))


def link_ownership(exists: Column, is_link: Column, target: Column, source: Column) -> Column:
    """absent, real-item, owned or wrong-owner, of a place where a link is wanted."""
    return F.when(~exists, "absent").when(~is_link, "real-item").when(target.eqNullSafe(source), "owned").otherwise("wrong-owner")
