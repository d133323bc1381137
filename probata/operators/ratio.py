"""The ratio gate: segments of two skeletons, matched by slot, must have similar lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probata.functions.numeric import length, max_scale_deviation
from probata.functions.paths import slot_key

from .keys import unique_by

# The slots that every mapping must have.
CORE_SLOTS = (
    "Hips", "Spine", "Head", "LeftUpperLeg", "RightUpperLeg", "LeftLowerLeg", "RightLowerLeg", "LeftFoot", "RightFoot",
    "LeftUpperArm", "RightUpperArm", "LeftLowerArm", "RightLowerArm", "LeftHand", "RightHand",
)
NEAR_ZERO = 1e-9


def segment_ratios(reference: DataFrame, candidate: DataFrame, slot: str, size: str, low: float = 0.5, high: float = 1.5) -> DataFrame:
    """(slot, reference, candidate, ratio, state) for slots that are unique on both sides.

    state is ok, out_of_range (bounds included) or unusable, where a length is next to zero.
    """
    a = unique_by(reference, slot).select(slot, F.col(size).alias("reference"))
    b = unique_by(candidate, slot).select(slot, F.col(size).alias("candidate"))
    small = (F.col("reference") <= NEAR_ZERO) | (F.col("candidate") <= NEAR_ZERO)
    ratio = F.when(~small, F.col("candidate") / F.col("reference"))
    state = F.when(small, "unusable").when(ratio.between(low, high), "ok").otherwise("out_of_range")
    return a.join(b, slot).select(slot, "reference", "candidate", ratio.alias("ratio"), state.alias("state"))


def ratio_gate(ratios: DataFrame, minimum: int = 15) -> DataFrame:
    """One row: comparable segments, those out of range, the median ratio, a suspected scale error, and the verdict."""
    usable = ratios.filter("state <> 'unusable'")
    one = usable.agg(F.count(F.lit(1)).alias("comparable"), F.count_if(F.col("state") == "out_of_range").alias("out_of_range"), F.median("ratio").alias("median_ratio"))
    m = F.col("median_ratio")
    scale = F.when(m.between(0.005, 0.02), "hundredth").when(m.between(50, 200), "hundredfold")
    passed = (F.col("comparable") >= minimum) & (F.col("out_of_range") == 0)
    return one.select("comparable", "out_of_range", "median_ratio", scale.alias("suspected_scale"), F.when(passed, "pass").otherwise("fail").alias("verdict"))


def mapped_bones(human: DataFrame, skeleton: DataFrame) -> DataFrame:
    """(slot, bone, state, position, scale): each mapped bone's first mapping by line, with its only skeleton bone; state is ok or missing.

    human: (slot_name, bone, line); skeleton: (name, position, scale).
    """
    first = human.groupBy("bone").agg(F.min_by("slot_name", "line").alias("slot_name"))
    bones = skeleton.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.first("position").alias("position"), F.first("scale").alias("scale"))
    both = first.join(bones, first["bone"] == bones["name"], "left")
    state = F.when(F.coalesce(F.col("n"), F.lit(0)) == 1, "ok").otherwise("missing")
    one = lambda c: F.when(F.col("n") == 1, F.col(c)).alias(c)
    return both.select(slot_key(F.col("slot_name")).alias("slot"), "bone", state.alias("state"), one("position"), one("scale"))


def scale_violations(bones: DataFrame, tolerance: float = 0.001) -> DataFrame:
    return bones.filter(max_scale_deviation(F.col("scale")) > tolerance)


def missing_slots(human: DataFrame, required: tuple[str, ...] = CORE_SLOTS) -> DataFrame:
    """(required): required slots that are not mapped exactly once."""
    spark = human.sparkSession
    want = spark.createDataFrame([(s, s.lower()) for s in required], "required string, slot string")
    have = human.groupBy(slot_key(F.col("slot_name")).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    return want.join(have, "slot", "left").filter("coalesce(n, 0) <> 1").select("required")


def humanoid_audit(importer: DataFrame, human: DataFrame, skeleton: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """(code): the failures of one importer file; none means pass. importer: (animation_type, avatar_setup)."""
    bones = mapped_bones(human, skeleton)
    rows = [
        importer.filter("not (animation_type <=> 3 and avatar_setup <=> 1)").select(F.lit("IMPORTER_NOT_HUMANOID").alias("code")),
        missing_slots(human).select(F.lit("REQUIRED_SLOT_MISSING").alias("code")),
        bones.filter("state = 'missing'").select(F.lit("MAPPED_BONE_MISSING").alias("code")),
        bones.filter("state = 'ok' and (position is null or scale is null)").select(F.lit("MAPPED_BONE_INCOMPLETE").alias("code")),
        scale_violations(bones, tolerance).select(F.lit("SCALE_DEVIATION").alias("code")),
        human.groupBy(slot_key(F.col("slot_name"))).count().filter("count > 1").select(F.lit("DUPLICATE_SLOT").alias("code")),
        human.groupBy("bone").count().filter("count > 1").select(F.lit("DUPLICATE_MAPPED_BONE").alias("code")),
        skeleton.groupBy("name").count().filter("count > 1").select(F.lit("DUPLICATE_SKELETON_BONE").alias("code")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out.distinct()


def rest_lengths(bones: DataFrame) -> DataFrame:
    """(slot, size) of bones with a position."""
    return bones.filter("state = 'ok' and position is not null").select("slot", length(F.col("position")).alias("size"))
