import io
import json
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from probata.operators import ratio
from probata.sources import files, sinks


@pytest.fixture
def folder(tmp_path):
    def write(**contents):
        for name, data in contents.items():
            (tmp_path / name.replace("__", ".")).write_bytes(data if isinstance(data, bytes) else data.encode())
        return str(tmp_path)

    return write


def problems(df):
    return {os.path.basename(r["path"]): r["problem"] for r in df.collect()}


def test_bounded_and_strict_json(spark, folder):
    path = folder(a__json='{"a": 1}', b__json='{"a": 1, "a": 2}', c__json="[1]", d__json="{", e__json='{"a": "' + "x" * 200 + '"}')
    df = files.bounded(spark, path, 100, "*.json")
    assert {os.path.basename(r["path"]) for r in df.filter("problem is not null").collect()} == {"e.json"}
    got = problems(files.strict_json(df.filter("problem is null").drop("problem")))
    assert got == {"a.json": None, "b.json": "JSON_INVALID", "c.json": "JSON_NOT_OBJECT", "d.json": "JSON_INVALID"}
    assert files.inventory(spark, path).count() == 5


def test_closed_keys_and_frames(spark, folder):
    frames = {"schema_version": 1, "frames": [{"path": "a.ppm", "id": " one ", "duration_ms": 140}, {"path": "b.ppm", "id": "two"}, {"path": "", "id": "x"}, {"path": "c", "id": "y", "duration_ms": 0}], "more": 1}
    docs = files.strict_json(files.bounded(spark, folder(f__json=json.dumps(frames)), 1000, "*.json").drop("problem"))
    assert [(r["code"], r["key"]) for r in files.key_problems(docs, "document", ["schema_version", "frames", "tool"]).collect()] == [("SCHEMA_KEYS_MISSING", "tool"), ("SCHEMA_KEYS_UNKNOWN", "more")]
    got = [(r["ordinal"], r["id"], r["duration_ms"], r["problem"]) for r in files.frames_of(docs).orderBy("ordinal").collect()]
    assert got == [(0, "one", 140, None), (1, "two", 100, None), (2, "x", 100, "FRAME_PATH_MISSING"), (3, "y", 0, "FRAME_DURATION_INVALID")]


def test_yaml_and_toml(spark, folder):
    pytest.importorskip("yaml")
    path = folder(a__yaml="a: 1\nb: [1, 2]\n", b__yaml="a: 1\na: 2\n", c__yaml="a: &x 1\nb: *x\n", d__yaml="a: 1\n---\nb: 2\n", t__toml='[x]\ny = "z"\n', u__toml="nope")
    got = problems(files.yaml_documents(files.bounded(spark, path, 1000, "*.yaml")))
    assert got["a.yaml"] is None and all(v.startswith("YAML_INVALID") for k, v in got.items() if k != "a.yaml")
    assert problems(files.toml_documents(files.bounded(spark, path, 1000, "*.toml"))) == {"t.toml": None, "u.toml": "TOML_INVALID"}


def test_zip_directories(spark, folder):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("LICENSE", "x" * 50)
        z.writestr("a/b.png", "y")
    path = folder(a__zip=b.getvalue(), b__zip=b"PK not a zip")
    rows = files.zip_entries(files.bounded(spark, path, 10_000, "*.zip")).collect()
    assert sorted(r["filename"] for r in rows if r["filename"]) == ["LICENSE", "a/b.png"]
    assert [r["problem"] for r in rows if r["problem"]] == ["zip_central_directory_metadata_invalid"]
    limit = files.zip_entries(files.bounded(spark, path, 10_000, "a.zip"), max_files=1).collect()
    assert [r["problem"] for r in limit] == ["declared_entry_count_limit_exceeded"]


def test_images(spark, folder):
    r = np.random.default_rng(0)
    rgba = r.integers(0, 256, (5, 7, 4)).astype(np.uint8)
    png = files.encoded_png(7, 5, rgba.tobytes(), {"binding": "x"})
    path = folder(a__png=png, b__ppm="P3\n# c\n2 1\n255\n1 2 3 4 5 6\n", c__ppm=b"P6 1 1 255\n\x07\x08\x09", d__png=png[:40])
    rows = {os.path.basename(x["path"]): x for x in files.rasters(files.bounded(spark, path, 10_000)).collect()}
    assert rows["a.png"]["rgba"] == rgba.tobytes() and rows["b.ppm"]["rgba"] == bytes([1, 2, 3, 255, 4, 5, 6, 255]) and rows["c.ppm"]["rgba"] == bytes([7, 8, 9, 255])
    assert rows["d.png"]["problem"].startswith("IMAGE_INVALID")
    import hashlib

    assert rows["a.png"]["rgba_sha256"] == hashlib.sha256(b"RGBA\0" + (7).to_bytes(8, "big") + (5).to_bytes(8, "big") + rgba.tobytes()).hexdigest()
    px = files.pixels(files.rasters(files.bounded(spark, path, 10_000, "a.png")))
    assert px.count() == 35 and tuple(px.filter("x = 3 and y = 2").select("r", "g", "b", "a").first()) == tuple(rgba[2, 3])


def test_png_filters():
    import struct
    import zlib

    r = np.random.default_rng(1)
    px = r.integers(0, 256, (6, 4, 3)).astype(np.int64)
    lines = b""
    for y in range(6):
        how, line = y % 5, px[y].ravel()
        above = px[y - 1].ravel() if y else np.zeros(12, np.int64)
        left = np.concatenate([[0] * 3, line[:-3]])
        corner = np.concatenate([[0] * 3, above[:-3]])
        if how == 4:
            p = left + above - corner
            d = np.abs(np.stack([p - left, p - above, p - corner]))
            guess = np.choose(np.argmin(d, axis=0), [left, above, corner])
        else:
            guess = [np.zeros(12, np.int64), left, above, (left + above) // 2][how]
        lines += bytes([how]) + ((line - guess) % 256).astype(np.uint8).tobytes()
    chunk = lambda n, b: struct.pack(">I", len(b)) + n + b + struct.pack(">I", zlib.crc32(n + b))
    raw = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 6, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")
    w, h, rgba, kind = files.decoded_image(raw)
    assert (w, h, kind) == (4, 6, "PNG") and np.frombuffer(rgba, np.uint8).reshape(6, 4, 4)[:, :, :3].tolist() == px.tolist()


META = """ModelImporter:
  animationType: 3
  avatarSetup: 1
  humanDescription:
    human:
    - boneName: hip
      humanName: Hips
    - boneName: spine
      humanName: Spine
    skeleton:
    - name: hip
      parentName: root
      position: {x: 0, y: 1.5, z: -2e-1}
      scale: {x: 1, y: 1, z: 1}
    - name: spine
      position: {x: nan, y: 1, z: 1}
      scale: {x: 1, y: 1}
"""


def test_importer_files(spark, folder):
    lines = files.numbered_lines(files.bounded(spark, folder(a__meta=META), 10_000, "*.meta"))
    assert tuple(files.importer_settings(lines).first())[1:] == (3, 1)
    human = files.human_mappings(lines)
    assert [(r["bone"], r["slot_name"]) for r in human.orderBy("line").collect()] == [("hip", "Hips"), ("spine", "Spine")]
    bones = {r["name"]: r for r in files.skeleton_bones(lines).collect()}
    assert bones["hip"]["position"] == [0.0, 1.5, -0.2] and bones["hip"]["parent"] == "root"
    assert bones["spine"]["position"] is None and bones["spine"]["scale"] is None
    codes = {r["code"] for r in ratio.humanoid_audit(files.importer_settings(lines), human, files.skeleton_bones(lines)).collect()}
    assert codes == {"REQUIRED_SLOT_MISSING", "MAPPED_BONE_INCOMPLETE"}


def test_frontmatter(spark, folder):
    path = folder(a__md="---\nname: x\ndescription: y\n---\nbody\n", b__md="---\ndescription: y\nname: x\n---\nbody", c__md="no head")
    assert {os.path.basename(r["path"]): r["ok"] for r in files.frontmatter(files.bounded(spark, path, 1000, "*.md")).collect()} == {"a.md": True, "b.md": False, "c.md": False}


def test_sinks(tmp_path):
    root = str(tmp_path)
    assert sinks.confined(root, "a/b.json", ".json").endswith("b.json")
    for bad in ("../x", "/etc/x", "a\\b", "", "x.txt"):
        with pytest.raises(sinks.OutputError):
            sinks.confined(root, bad, ".json")
    one = os.path.join(root, "one")
    sinks.replaced(one, b"1")
    with pytest.raises(sinks.OutputError):
        sinks.replaced(one, b"2")
    with pytest.raises(sinks.OutputError):
        sinks.distinct_outputs([one, one.upper()], [])
    with pytest.raises(OSError):
        sinks.replaced_together({one: b"3", os.path.join(root, "none", "x"): b"4"}, force=True)
    assert open(one, "rb").read() == b"1"
    sinks.replaced_together({one: b"5", os.path.join(root, "two"): b"6"}, force=True)
    assert open(one, "rb").read() == b"5" and sinks.canonical({"b": 1, "a": "é"}) == '{\n  "a": "é",\n  "b": 1\n}\n'.encode()


def test_receipt_stream(spark, tmp_path):
    from probata.streaming import receipts

    (tmp_path / "in").mkdir()
    row = {"subject": "s", "ts": "2024-01-01T00:00:00Z", "id": "engine.x", "required": True, "result": "pass", "cites_engine": True}
    (tmp_path / "in" / "a.json").write_text(json.dumps(row) + "\n" + json.dumps(row | {"subject": "t", "result": "fail"}))
    got = []
    q = receipts.reduced(receipts.gate_stream(spark, str(tmp_path / "in")), lambda df, epoch: got.extend((r["subject"], r["status"]) for r in df.collect()), str(tmp_path / "check"))
    assert q.awaitTermination(60) and sorted(got) == [("s", "validated"), ("t", "failed")]
    w = receipts.failures_by_window(receipts.gate_stream(spark, str(tmp_path / "in")))
    q = w.writeStream.format("memory").queryName("failures").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [r["failures"] for r in spark.table("failures").collect()] == [1]
