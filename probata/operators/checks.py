"""Checks, and the rules that reduce them to verdicts and statuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def verdict(passed: Column) -> Column:
    return F.when(passed, "pass").otherwise("fail")


def check(df: DataFrame, subject: str, identifier: str, passed: Column, observed: Column) -> DataFrame:
    """(subject, check_id, observed, verdict): one check of each row; observed is text."""
    return df.select(F.col(subject).alias("subject"), F.lit(identifier).alias("check_id"), observed.cast("string").alias("observed"), verdict(F.coalesce(passed, F.lit(False))).alias("verdict"))


def all_pass(checks: DataFrame, *by: str) -> DataFrame:
    """Pass if all checks pass, with the number of failures."""
    return checks.groupBy(*by).agg(F.count_if(F.col("verdict") == "fail").alias("failures"), verdict(F.bool_and(F.col("verdict") == "pass")).alias("verdict"))


def severity_verdict(issues: DataFrame, *by: str, severity: str = "severity") -> DataFrame:
    """Fail with any error, else pass_with_warnings with any issue, else pass; null severity is no issue."""
    s = F.col(severity)
    worst = F.when(F.count_if(s == "error") > 0, "fail").when(F.count_if(s.isNotNull()) > 0, "pass_with_warnings").otherwise("pass")
    return issues.groupBy(*by).agg(F.count_if(s == "error").alias("errors"), F.count_if(s == "warning").alias("warnings"), worst.alias("verdict"))


def accepted(audit_verdict: Column, allow_warnings: bool = False) -> Column:
    return audit_verdict.isin("pass", "pass_with_warnings") if allow_warnings else audit_verdict == "pass"


def gate_status(gates: DataFrame, *by: str) -> DataFrame:
    """The status that gates reduce to: failed, blocked, validated or prototype, in this order.

    gates: (by, id, required, result, cites_engine). Any failed gate fails, required or not; a required blocker gate that was not tested
    blocks; it takes every required gate passed, and a required engine gate that cites engine evidence, to validate.
    """
    required, result = F.col("required"), F.col("result")
    engine = F.coalesce(F.bool_or(required & F.col("id").startswith("engine.") & (result == "pass") & F.col("cites_engine")), F.lit(False))
    whole = F.coalesce(F.min(F.when(required, (result == "pass").cast("int"))) == 1, F.lit(True))
    status = (
        F.when(F.bool_or(result == "fail"), "failed")
        .when(F.bool_or(required & (result == "not_tested") & F.col("id").startswith("blocker.")), "blocked")
        .when(whole & engine, "validated")
        .otherwise("prototype")
    )
    return gates.groupBy(*by).agg(status.alias("status"))


def allowed_statuses(gates: DataFrame, *by: str, round_trip: str) -> DataFrame:
    """The statuses that required gates and a round trip (pass, fail, not_tested) leave open."""
    need = F.col("required")
    fail = F.coalesce(F.bool_or(need & (F.col("result") == "fail")), F.lit(False)) | (F.max(round_trip) == "fail")
    open_ = F.coalesce(F.bool_or(need & (F.col("result") == "not_tested")), F.lit(False)) | (F.max(round_trip) != "pass")
    both = F.array(F.lit("prototype"), F.lit("blocked"))
    return gates.groupBy(*by).agg(F.when(fail, F.array(F.lit("failed"))).when(open_, both).otherwise(F.array(F.lit("validated"))).alias("statuses"))


def gate_problems(gates: DataFrame) -> DataFrame:
    """(subject, code) of gates (subject, id, required, result, evidence array, reason) that break the rules for gates."""
    result, reason = F.col("result"), F.length(F.trim(F.coalesce("reason", F.lit("")))) > 0
    none = F.size(F.coalesce("evidence", F.array().cast("array<string>"))) == 0
    rules = {
        "GATE_RESULT_INVALID": ~F.coalesce(result.isin("pass", "fail", "not_tested", "not_applicable"), F.lit(False)),
        "REQUIRED_GATE_NOT_APPLICABLE": F.col("required") & (result == "not_applicable"),
        "GATE_REASON_REQUIRED": result.isin("not_tested", "not_applicable") & ~reason,
        "GATE_EVIDENCE_REQUIRED": result.isin("pass", "fail") & none,
    }
    return gates.select("subject", F.explode(F.array_compact(F.array(*(F.when(rule, F.lit(code)) for code, rule in rules.items())))).alias("code"))


def declared_matches(declared: Column, statuses: Column) -> Column:
    return F.array_contains(statuses, declared)


def coverage(evidence: DataFrame, by: str, domains: list[str]) -> DataFrame:
    """(by, missing): the domains, in order, for which there is no evidence row (by, domain, current)."""
    missing = [F.when(~F.coalesce(F.bool_or((F.col("domain") == d) & F.col("current")), F.lit(False)), F.lit(d)) for d in domains]
    return evidence.groupBy(by).agg(F.array_join(F.array_compact(F.array(*missing)), ",").alias("missing"))


def classified(value: Column, states: dict[str, list[str]], other: str = "unknown") -> Column:
    """The first state any of whose patterns (LIKE) a value fits."""
    out = F.lit(other)
    for state, patterns in reversed(states.items()):
        for p in patterns:
            out = F.when(value.like(p), state).otherwise(out)
    return out
