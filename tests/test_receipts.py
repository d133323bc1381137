"""One change to a sound receipt, one code."""

import copy
import hashlib

from probata.plans import receipts

digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
PATHS = ["src/a.ppm", "out/sheet.png", "out/sheet.json", "out/audit.json", "ev/one.json", "ev/engine.json"]

SOUND = {
    "status": "validated",
    "sources": [(PATHS[0], "user_authored", digest(PATHS[0]))],
    "outputs": [(p, r, digest(p)) for p, r in zip(PATHS[1:4], ("engine_delivery", "frame_manifest", "audit"), strict=True)],
    "evidence": [("artifact", "audit", PATHS[4], digest(PATHS[4]), None, None), ("engine_import", "run", PATHS[5], digest(PATHS[5]), PATHS[1], digest(PATHS[1]))],
    "gates": [("artifact.audit", True, "pass", ["artifact:audit"], ""), ("engine.import", True, "pass", ["engine_import:run"], ""), ("visual.native", False, "not_tested", [], "no screen")],
}


def changed(part, index=None, field=None, value=None, drop=False):
    r = copy.deepcopy(SOUND)
    if index is None:
        r[part] = value
    elif drop:
        del r[part][index]
    else:
        row = list(r[part][index])
        row[field] = value
        r[part][index] = tuple(row)
    return r


CASES = {
    "sound": (SOUND, set()),
    "status": (changed("status", value="done"), {"STATUS_INVALID"}),
    "not applicable": (changed("gates", 0, 2, "not_applicable"), {"REQUIRED_GATE_NOT_APPLICABLE", "STATUS_REDUCTION_MISMATCH", "GATE_REASON_REQUIRED"}),
    "no reason": (changed("gates", 2, 4, " "), {"GATE_REASON_REQUIRED"}),
    "no evidence": (changed("gates", 0, 3, []), {"GATE_EVIDENCE_REQUIRED"}),
    "unknown evidence": (changed("gates", 0, 3, ["artifact:none"]), {"GATE_EVIDENCE_UNKNOWN"}),
    "cited twice": (changed("gates", 0, 3, ["artifact:audit"] * 2), {"GATE_EVIDENCE_DUPLICATE"}),
    "gate fails": (changed("gates", 2, 2, "fail"), {"STATUS_REDUCTION_MISMATCH", "GATE_EVIDENCE_REQUIRED"}),
    "no engine evidence": (changed("evidence", 1, drop=True), {"STATUS_REDUCTION_MISMATCH", "GATE_EVIDENCE_UNKNOWN"}),
    "engine gate renamed": (changed("gates", 1, 0, "motor.import"), {"STATUS_REDUCTION_MISMATCH"}),
    "gate id twice": (changed("gates", 1, 0, "Artifact.audit"), {"GATE_ID_DUPLICATE", "STATUS_REDUCTION_MISMATCH"}),
    "absolute path": (changed("outputs", 2, 0, "/out/audit.json"), {"PATH_NOT_PORTABLE"}),
    "windows path": (changed("outputs", 2, 0, "C:\\audit.json"), {"PATH_NOT_PORTABLE"}),
    "path above": (changed("sources", 0, 0, "../a.ppm"), {"PATH_NOT_PORTABLE"}),
    "upper case digest": (changed("sources", 0, 2, digest(PATHS[0]).upper()), {"SHA256_INVALID"}),
    "wrong digest": (changed("sources", 0, 2, digest("x")), {"FILE_HASH_MISMATCH"}),
    "missing file": (changed("sources", 0, 0, "src/none.ppm"), {"FILE_MISSING"}),
    "manifest gone": (changed("outputs", 1, drop=True), {"OUTPUT_ROLE_CARDINALITY_INVALID"}),
    "unknown role": (changed("sources", 0, 1, "found"), {"ROLE_INVALID"}),
    "engine binding": (changed("evidence", 1, 5, digest("y")), {"ENGINE_DELIVERY_BINDING_MISMATCH"}),
    "source is output": (changed("sources", 0, 0, PATHS[1].upper()), {"SOURCE_OUTPUT_FILE_ALIAS", "FILE_MISSING"}),
    "no gates": (changed("gates", value=[]), {"GATES_INVALID", "STATUS_REDUCTION_MISMATCH"}),
}


def test_each_change_has_its_codes(spark):
    rows = [(k, r["status"], r["sources"], r["outputs"], r["evidence"], r["gates"]) for k, (r, _) in CASES.items()]
    df = spark.createDataFrame(rows, receipts.SCHEMA).cache()
    files = spark.createDataFrame([(p, digest(p)) for p in PATHS], "path string, sha256 string")
    got = {k: set() for k in CASES}
    for r in receipts.problems(df, files).collect():
        got[r["receipt"]].add(r["code"])
    assert got == {k: codes for k, (_, codes) in CASES.items()}
    out = {r["receipt"]: r for r in receipts.validated(df, files).collect()}
    assert {k for k, r in out.items() if r["verdict"] == "pass"} == {"sound"} and out["gate fails"]["reduced"] == "failed"


def test_a_true_failure_passes(spark):
    r = changed("gates", 2, 2, "fail")
    r["gates"][2] = ("visual.native", False, "fail", ["artifact:audit"], "")
    r["status"] = "failed"
    df = spark.createDataFrame([("f", r["status"], r["sources"], r["outputs"], r["evidence"], r["gates"])], receipts.SCHEMA)
    files = spark.createDataFrame([(p, digest(p)) for p in PATHS], "path string, sha256 string")
    assert tuple(receipts.validated(df, files).first()) == ("f", "failed", 0, "pass")
