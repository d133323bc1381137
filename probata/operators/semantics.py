"""What two reports on a scene are compared by: projections of objects, materials, bones and clips, and facts about them.

objects: (report, name, ordinal, type, parent, and what each projection names); other tables as each function says. Nulls stay nulls and
equal each other in comparisons; a report without rows has no projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import cut, dropped

# Fixed values.
EXPORTED = ("MESH", "ARMATURE")
DIGITS = 6
TOPOLOGY = (
    "vertices", "triangles", "boundary_edges", "non_manifold_edges_excluding_boundaries", "loose_edges", "loose_vertices", "degenerate_faces", "connected_face_components",
    "closed_components", "open_components", "outward_closed_components", "inward_closed_components", "indeterminate_closed_components", "winding_conflict_edges",
)
DIGESTS = ("surface_triangle_digest", "uv_triangle_digest", "material_triangle_digest", "weight_digest")
RUN_FIELDS = ("run_id", "started_at", "generated_at")


def rounded(values: Column, digits: int = DIGITS) -> Column:
    """An array of numbers, each rounded; minus zero is zero."""
    return F.transform(values, lambda x: F.round(x.cast("double"), digits) + 0.0)


def mesh_names(objects: DataFrame) -> DataFrame:
    """(report, name) of the meshes."""
    return objects.filter("type = 'MESH'").select("report", "name")


def exported(objects: DataFrame) -> DataFrame:
    """The meshes and armatures; of those of one name in a report the last."""
    rest = [c for c in objects.columns if c not in ("report", "name")]
    last = objects.filter(F.col("type").isin(*EXPORTED)).groupBy("report", "name").agg(F.max_by(F.struct(*rest), "ordinal").alias("_r"))
    return last.select("report", "name", *(F.col("_r")[c].alias(c) for c in rest))


def material_semantics(materials: DataFrame) -> DataFrame:
    return materials.select("report", "name", "semantics", "semantic_digest")


def hierarchy(objects: DataFrame) -> DataFrame:
    return exported(objects).select("report", "name", "type", "parent")


def transforms(objects: DataFrame, fields: list[str]) -> DataFrame:
    """(report, name, fields): arrays of numbers, rounded."""
    return exported(objects).select("report", "name", *(rounded(F.col(c)).alias(c) for c in fields))


def mesh_semantics(objects: DataFrame, with_uv: bool = True, topology: tuple[str, ...] = TOPOLOGY, digests: tuple[str, ...] = DIGESTS) -> DataFrame:
    """(report, name, bounds struct<min, max, dimensions>, topology, digests) of exported objects with a mesh (bounds columns min, max, dimensions).

    Where texture coordinates are not part of the contract, their digest is a fixed text on both sides.
    """
    uv = lambda c: F.lit("not_compared_by_contract") if c == "uv_triangle_digest" and not with_uv else F.col(c)
    bounds = F.struct(*(rounded(F.col(c)).alias(c) for c in ("min", "max", "dimensions")))
    return exported(objects).filter("type = 'MESH'").select("report", "name", bounds.alias("bounds"), *topology, *(uv(c).alias(c) for c in digests))


def split_bounds(semantics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bounds, all else): bounds are compared within a tolerance, the others as they are."""
    return semantics.select("report", "name", "bounds"), semantics.drop("bounds")


def rest_joints(bones: DataFrame) -> DataFrame:
    """(report, object, name, parent, use_deform, head, matrix) of bones at rest; tails and connections do not count."""
    return bones.select("report", "object", "name", "parent", "use_deform", rounded(F.col("head")).alias("head"), rounded(F.col("matrix")).alias("matrix"))


def valid_clips(actions: DataFrame, channels: DataFrame, bindings: DataFrame) -> DataFrame:
    """actions (report, name, first, last) with valid: whether a clip moves something that it is bound to.

    channels: (report, name, handle, mute, is_valid, points); those that are not muted, valid and have points are usable. bindings: (report, name,
    owner_type, owner, handle). With handles on usable channels, one of them must be bound; without any, any binding will do. The clip's range must not be empty.
    """
    usable = channels.filter(~F.coalesce("mute", F.lit(False)) & F.coalesce("is_valid", F.lit(False)) & (F.col("points") > 0))
    by = ["report", "name"]
    facts = usable.groupBy(*by).agg(F.count(F.lit(1)).alias("_channels"), F.count("handle").alias("_handles"))
    bound = bindings.groupBy(*by).agg(F.count(F.lit(1)).alias("_bindings"))
    met = bindings.join(usable.select(*by, "handle").filter("handle is not null").distinct(), [*by, "handle"], "left_semi").select(*by).distinct().withColumn("_met", F.lit(True))
    out = actions.join(facts, by, "left").join(bound, by, "left").join(met, by, "left")
    valid = (F.col("_channels") > 0) & (F.col("_bindings") > 0) & ((F.col("_handles") == 0) | F.coalesce("_met", F.lit(False))) & (F.col("last") > F.col("first"))
    return out.withColumn("valid", F.coalesce(valid, F.lit(False))).drop("_channels", "_handles", "_bindings", "_met")


def clips(valid: DataFrame, bindings: DataFrame) -> DataFrame:
    """(report, name, first, last, owners): the valid clips, with the distinct owners that they are bound to, in order."""
    owners = bindings.groupBy("report", "name").agg(F.array_sort(F.collect_set(F.concat_ws(":", "owner_type", "owner"))).alias("owners"))
    edge = lambda c: (F.round(F.col(c).cast("double"), DIGITS) + 0.0).alias(c)
    return valid.filter("valid").join(owners, ["report", "name"], "left").select("report", "name", edge("first"), edge("last"), "owners")


def loop_contract(loops: DataFrame) -> DataFrame:
    return loops.select("report", rounded(F.col("frames")).alias("frames"), "start_end_match", "middle_differs")


def reproducible(reports: DataFrame) -> DataFrame:
    """reports without what differs from run to run: times and the run's id, also the source's."""
    out = reports.drop(*RUN_FIELDS)
    if "source" in out.columns and out.schema["source"].dataType.typeName() == "struct":
        out = out.withColumn("source", F.col("source").dropFields("started_at"))
    return out


def public(df: DataFrame) -> DataFrame:
    """df without the columns whose names start with an underscore."""
    return df.select(*(c for c in df.columns if not c.startswith("_")))


def counters_equal(source: DataFrame, imported: DataFrame, key: str, counters: list[str]) -> DataFrame:
    """(key, counter, source, imported, verdict) of every counter of every key on either side."""
    pairs = lambda df, side: df.select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("counter"), F.col(c).cast("long").alias("v")) for c in counters))).alias("p")).select(key, "p.counter", F.col("p.v").alias(side))
    both = pairs(source, "source").join(pairs(imported, "imported"), [key, "counter"], "full_outer")
    return both.withColumn("verdict", F.when(F.col("source").eqNullSafe(F.col("imported")) & F.col("source").isNotNull(), "pass").otherwise("fail"))


def type_histogram(objects: DataFrame, by: str, type_: str) -> DataFrame:
    return objects.groupBy(by, type_).agg(F.count(F.lit(1)).alias("n"))


def sizes(objects: DataFrame, by: str, triangles: Column, bones: Column, skinned: Column) -> DataFrame:
    """(by, triangles, bones, skinned): sums over objects, and how many meshes hang on an armature."""
    return objects.groupBy(by).agg(F.coalesce(F.sum(triangles), F.lit(0)).alias("triangles"), F.coalesce(F.sum(bones), F.lit(0)).alias("bones"), F.count_if(skinned).alias("skinned"))


def used_materials(slots: DataFrame, by: str, material: str) -> DataFrame:
    """(by, material): each material that a slot names, once."""
    return slots.filter(F.col(material).isNotNull()).select(by, material).distinct()


def faces_without_material(faces: DataFrame, slots: DataFrame, by: list[str]) -> DataFrame:
    """(by, faces, missing): faces (by, slot) whose slot is not there, or empty. slots: (by, slot, material)."""
    there = slots.filter("material is not null").select(*by, "slot").distinct().withColumn("_there", F.lit(True))
    return faces.join(there, [*by, "slot"], "left").groupBy(*by).agg(F.count(F.lit(1)).alias("faces"), F.count_if(F.col("_there").isNull()).alias("missing"))


def deforming(weights: DataFrame, bones: DataFrame, by: str, group: str) -> DataFrame:
    """weights with deforms: whether the vertex group is named like a bone (by, name, use_deform) that deforms."""
    b = bones.filter("use_deform").select(by, F.col("name").alias(group)).distinct().withColumn("deforms", F.lit(True))
    return weights.join(b, [by, group], "left").withColumn("deforms", F.coalesce("deforms", F.lit(False)))


def material_profile(principled: Column, images: Column, direct: Column, linked: Column) -> Column:
    """The profile of a material from the number of its principled and image nodes, whether its active output is fed by a principled node directly, and whether any tracked input is linked."""
    plain = (principled == 1) & (images == 0) & direct & ~linked
    return F.when(F.coalesce(plain, F.lit(False)), "constant_principled_core_v1").otherwise("complex_material_unvalidated")


def image_textures(nodes: DataFrame, by: str, image: str) -> DataFrame:
    """(by, image_textures): the image nodes that have an image."""
    return nodes.groupBy(by).agg(F.count(image).alias("image_textures"))


def edge_counts(edges: DataFrame, by: list[str]) -> DataFrame:
    """(by, boundary_edges, non_manifold_edges, loose_edges, winding_conflicts): edges (by, faces, forward) by how many faces they have and run forward in."""
    n = F.col("faces")
    return edges.groupBy(*by).agg(
        F.count_if(n == 1).alias("boundary_edges"), F.count_if(n > 2).alias("non_manifold_edges"), F.count_if(n == 0).alias("loose_edges"), F.count_if((n == 2) & (F.col("forward") != 1)).alias("winding_conflicts")
    )


def in_scope(objects: DataFrame, roots: DataFrame, rounds: int = 10_000) -> DataFrame:
    """(name): the roots that are there, and all below them by parent; each once, also where parents run in a circle."""
    links = objects.select("name", "parent").distinct()
    found = cut(objects.join(roots.select("name").distinct(), "name", "left_semi").select("name").distinct())
    edge = found
    for _ in range(rounds):
        new = cut(links.join(edge.select(F.col("name").alias("parent")), "parent").select("name").distinct().join(found, "name", "left_anti"))
        if new.isEmpty():
            return found
        both = cut(found.union(new))
        dropped(found)
        found, edge = both, new
    raise RuntimeError("more levels than rounds")


def pose_signature(matrices: DataFrame, by: list[str]) -> DataFrame:
    """(by, signature): the numbers of each object's matrix and then those of its bones', by name. matrices: (by, object, bone or null, values)."""
    one = F.struct("object", F.col("bone").isNotNull().alias("is_bone"), F.coalesce("bone", F.lit("")).alias("bone"), "values")
    return matrices.groupBy(*by).agg(F.flatten(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["values"])).alias("signature"))
