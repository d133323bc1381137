"""Sources: bounded files, strict documents, archives' directories, images, importer files."""

from __future__ import annotations

import io
import json
import struct
import tomllib
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_IMAGE, MAX_MANIFEST, MAX_RECEIPT = 256 << 20, 16 << 20, 4 << 20
MAX_SIDE, MAX_PIXELS = 32768, 64_000_000
MAX_FRAMES = 4096


def inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime) of every file below path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", "modificationTime")


def bounded(spark: SparkSession, path: str, most: int, pattern: str = "*") -> DataFrame:
    """(path, length, content, problem): contents of files up to most bytes; of larger ones only the problem."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    small = files.filter(F.col("length") <= most).select("path", "length", "content", F.lit(None).cast("string").alias("problem"))
    large = files.filter(F.col("length") > most).select("path", "length", F.lit(None).cast("binary").alias("content"), F.lit("FILE_TOO_LARGE").alias("problem"))
    return small.union(large)


def digested(files: DataFrame) -> DataFrame:
    return files.withColumn("sha256", F.sha2("content", 256))


def strict_json(files: DataFrame, most: int = MAX_MANIFEST) -> DataFrame:
    """files (path, content) with document (variant) and problem: UTF-8, no repeated keys, an object, within the size."""
    text = F.col("content").cast("string")
    parsed = F.try_parse_json(text)
    kind = F.schema_of_variant(parsed)
    problem = (
        F.when(F.octet_length("content") > most, "FILE_TOO_LARGE")
        .when(parsed.isNull(), "JSON_INVALID")
        .when(~kind.startswith("OBJECT"), "JSON_NOT_OBJECT")
    )
    return files.withColumn("problem", problem).withColumn("document", F.when(problem.isNull(), parsed))


def _yaml_value(text: str):
    """The value of a text's only YAML document, put together from the parser's events, of which only plain ones are taken."""
    import yaml

    resolver, constructor = yaml.resolver.Resolver(), yaml.constructor.SafeConstructor()
    documents: list = []
    #: What is open: a list, or a dict with the key that waits for its value.
    within: list[list] = [[documents, None]]
    nothing = object()

    def put(value) -> None:
        holder, key = within[-1]
        if isinstance(holder, list):
            holder.append(value)
        elif key is nothing:
            if not isinstance(value, str | int | float | bool | None):
                raise ValueError("a key that is no scalar")
            if value in holder:
                raise ValueError("a key twice")
            within[-1][1] = value
        else:
            holder[key] = value
            within[-1][1] = nothing

    for event in yaml.parse(text, Loader=yaml.SafeLoader):
        if isinstance(event, yaml.AliasEvent) or getattr(event, "anchor", None) is not None:
            raise ValueError("an alias or an anchor")
        if getattr(event, "tag", None) is not None:
            raise ValueError("a tag")
        if isinstance(event, yaml.ScalarEvent):
            tag = resolver.resolve(yaml.ScalarNode, event.value, event.implicit)
            if tag.endswith((":merge", ":value")):
                raise ValueError("a merge")
            put(constructor.construct_object(yaml.ScalarNode(tag, event.value), deep=True))
        elif isinstance(event, yaml.SequenceStartEvent):
            within.append([[], None])
        elif isinstance(event, yaml.MappingStartEvent):
            within.append([{}, nothing])
        elif isinstance(event, yaml.SequenceEndEvent | yaml.MappingEndEvent):
            put(within.pop()[0])
    if len(documents) != 1:
        raise ValueError("not one document")
    return documents[0]


def yaml_documents(files: DataFrame, most: int = MAX_RECEIPT) -> DataFrame:
    """(path, json, problem): single YAML documents without aliases, tags, merges and repeated keys, as JSON text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out, problem = [], []
            for content in pdf["content"]:
                try:
                    if len(content) > most:
                        raise ValueError("too large")
                    out.append(json.dumps(_yaml_value(bytes(content).decode()), sort_keys=True, allow_nan=False))
                    problem.append(None)
                except Exception as e:
                    out.append(None)
                    problem.append(f"YAML_INVALID: {type(e).__name__}")
            yield pd.DataFrame({"path": pdf["path"], "json": out, "problem": problem})

    return files.select("path", "content").mapInPandas(run, "path string, json string, problem string")


def toml_documents(files: DataFrame) -> DataFrame:
    """(path, json, problem) of TOML files, as JSON text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out, problem = [], []
            for content in pdf["content"]:
                try:
                    out.append(json.dumps(tomllib.loads(bytes(content).decode()), sort_keys=True, default=str))
                    problem.append(None)
                except ValueError:
                    out.append(None)
                    problem.append("TOML_INVALID")
            yield pd.DataFrame({"path": pdf["path"], "json": out, "problem": problem})

    return files.select("path", "content").mapInPandas(run, "path string, json string, problem string")


def key_problems(documents: DataFrame, column: str, required: list[str], optional: list[str] = ()) -> DataFrame:
    """(path, code, key): keys that are missing from, or unknown to, a closed object (variant)."""
    keys = F.map_keys(F.from_json(F.to_json(column), "map<string,string>"))
    want = F.array(*map(F.lit, required)).cast("array<string>")
    know = F.array(*map(F.lit, [*required, *optional])).cast("array<string>")
    each = lambda code, a: F.transform(a, lambda k: F.struct(F.lit(code).alias("code"), k.alias("key")))
    out = F.concat(each("SCHEMA_KEYS_MISSING", F.array_except(want, keys)), each("SCHEMA_KEYS_UNKNOWN", F.array_except(keys, know)))
    return documents.select("path", F.explode(out).alias("p")).select("path", "p.code", "p.key")


def frames_of(documents: DataFrame, default_duration: int = 100) -> DataFrame:
    """(path, ordinal, id, frame_path, state, direction, duration_ms, problem): the frames of frame-data documents (variant), in order."""
    frames = F.variant_get("document", "$.frames", "array<variant>")
    each = documents.filter("document is not null").select("path", F.posexplode(frames).alias("ordinal", "f"))
    get = lambda k, t="string": F.try_variant_get("f", f"$.{k}", t)
    duration = F.coalesce(get("duration_ms", "int"), F.lit(default_duration))
    problem = (
        F.when(F.col("ordinal") >= MAX_FRAMES, "TOO_MANY_FRAMES")
        .when(F.coalesce(F.trim(get("id")), F.lit("")) == "", "FRAME_ID_MISSING")
        .when(F.coalesce(get("path"), F.lit("")) == "", "FRAME_PATH_MISSING")
        .when(~duration.between(1, 60000), "FRAME_DURATION_INVALID")
    )
    return each.select("path", "ordinal", F.trim(get("id")).alias("id"), get("path").alias("frame_path"), F.trim(get("state")).alias("state"), F.trim(get("direction")).alias("direction"), duration.alias("duration_ms"), problem.alias("problem"))


def zip_entries(files: DataFrame, max_files: int = 10_000) -> DataFrame:
    """(path, filename, file_size, compress_size, external_attr, flag_bits, problem): central directories of ZIP files (path, content); nothing is unpacked."""

    def declared(raw: bytes) -> int | None:
        at = raw.rfind(b"PK\x05\x06", max(0, len(raw) - 65557))
        return struct.unpack_from("<H", raw, at + 10)[0] if 0 <= at <= len(raw) - 22 else None

    names = ["path", "filename", "file_size", "compress_size", "external_attr", "flag_bits", "problem"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                raw = bytes(content)
                n = declared(raw)
                if n is None:
                    rows.append((path, None, None, None, None, None, "zip_central_directory_metadata_invalid"))
                elif n > max_files:
                    rows.append((path, None, None, None, None, None, "declared_entry_count_limit_exceeded"))
                else:
                    try:
                        infos = zipfile.ZipFile(io.BytesIO(raw)).infolist()
                    except zipfile.BadZipFile:
                        rows.append((path, None, None, None, None, None, "zip_central_directory_metadata_invalid"))
                    else:
                        rows += [(path, i.filename, i.file_size, i.compress_size, i.external_attr, i.flag_bits, None) for i in infos]
            yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(run, "path string, filename string, file_size long, compress_size long, external_attr long, flag_bits long, problem string")


def decoded_image(raw: bytes) -> tuple[int, int, bytes, str]:
    """(width, height, RGBA bytes, format) of a plain or raw PPM or an 8-bit, not interlaced PNG."""
    if raw[:8] == b"\x89PNG\r\n\x1a\n":
        return (*_png(raw), "PNG")
    if raw[:2] in (b"P3", b"P6"):
        return (*_ppm(raw), "PPM")
    raise ValueError("unknown image format")


def _sized(w: int, h: int) -> None:
    if not (0 < w <= MAX_SIDE and 0 < h <= MAX_SIDE and w * h <= MAX_PIXELS):
        raise ValueError("image size out of bounds")


def _ppm(raw: bytes) -> tuple[int, int, bytes]:
    plain = raw[:2] == b"P3"
    fields, at = [], 2
    while len(fields) < 3:
        while raw[at : at + 1].isspace() or raw[at : at + 1] == b"#":
            at = raw.index(b"\n", at) + 1 if raw[at : at + 1] == b"#" else at + 1
        end = at
        while end < len(raw) and not raw[end : end + 1].isspace():
            end += 1
        fields.append(int(raw[at:end]))
        at = end
    w, h, top = fields
    _sized(w, h)
    values = np.array(raw[at:].split(), np.int64)[: w * h * 3] if plain else np.frombuffer(raw, np.uint8, w * h * 3, at + 1).astype(np.int64)
    rgb = (values.reshape(h, w, 3) * 255 // top).astype(np.uint8)
    return w, h, np.concatenate([rgb, np.full((h, w, 1), 255, np.uint8)], axis=2).tobytes()


def _png(raw: bytes) -> tuple[int, int, bytes]:
    at, data, palette, alpha = 8, b"", None, b""
    w = h = kind = 0
    while at < len(raw):
        n, name = struct.unpack_from(">I4s", raw, at)
        body = raw[at + 8 : at + 8 + n]
        if zlib.crc32(name + body) != struct.unpack_from(">I", raw, at + 8 + n)[0]:
            raise ValueError("chunk checksum")
        at += 12 + n
        if name == b"IHDR":
            w, h, depth, kind, _, _, lace = struct.unpack(">IIBBBBB", body)
            _sized(w, h)
            if depth != 8 or lace:
                raise ValueError("only 8 bits, not interlaced")
        elif name == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif name == b"tRNS":
            alpha = body
        elif name == b"IDAT":
            data += body
    c = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    lines = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, 1 + w * c)
    out = np.zeros((h, w * c), np.uint8)
    above = np.zeros(w * c, np.int64)
    for y in range(h):
        how, line = int(lines[y, 0]), lines[y, 1:].astype(np.int64)
        if how == 2:
            line = line + above
        elif how:
            line = line.copy()
            for x in range(w * c):
                left, corner = (line[x - c], above[x - c]) if x >= c else (0, 0)
                if how == 1:
                    line[x] += left
                elif how == 3:
                    line[x] += (left + above[x]) // 2
                else:
                    p = left + above[x] - corner
                    d = (abs(p - left), abs(p - above[x]), abs(p - corner))
                    line[x] += (left, above[x], corner)[d.index(min(d))]
                line[x] &= 255
        above = line & 255
        out[y] = above
    px = out.reshape(h, w, c)
    full = np.full((h, w, 1), 255, np.uint8)
    if kind == 3:
        a = np.full(len(palette), 255, np.uint8)
        a[: len(alpha)] = np.frombuffer(alpha, np.uint8)
        px = np.concatenate([palette, a[:, None]], axis=1)[px[:, :, 0]]
    elif kind == 0:
        px = np.concatenate([px] * 3 + [full], axis=2)
    elif kind == 4:
        px = np.concatenate([px[:, :, :1]] * 3 + [px[:, :, 1:]], axis=2)
    elif kind == 2:
        px = np.concatenate([px, full], axis=2)
    return w, h, px.astype(np.uint8).tobytes()


def encoded_png(width: int, height: int, rgba: bytes, text: dict[str, str] | None = None) -> bytes:
    """An RGBA PNG at the highest compression, with text chunks."""

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    rows = np.frombuffer(rgba, np.uint8).reshape(height, width * 4)
    data = np.concatenate([np.zeros((height, 1), np.uint8), rows], axis=1).tobytes()
    extra = b"".join(chunk(b"tEXt", k.encode("latin-1") + b"\0" + v.encode("latin-1")) for k, v in (text or {}).items())
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)) + extra + chunk(b"IDAT", zlib.compress(data, 9)) + chunk(b"IEND", b"")


def rasters(files: DataFrame) -> DataFrame:
    """(path, width, height, rgba, format, sha256, rgba_sha256, problem) of image files (path, content)."""
    from probata.functions.paths import rgba_sha256

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    rows.append((path, *decoded_image(bytes(content)), None))
                except Exception as e:
                    rows.append((path, None, None, None, None, f"IMAGE_INVALID: {type(e).__name__}"))
            yield pd.DataFrame(rows, columns=["path", "width", "height", "rgba", "format", "problem"])

    out = files.select("path", "content").mapInPandas(run, "path string, width long, height long, rgba binary, format string, problem string")
    return out.withColumn("rgba_sha256", rgba_sha256(F.col("width"), F.col("height"), F.col("rgba")))


def pixels(images: DataFrame, key: str = "path") -> DataFrame:
    """(asset, x, y, r, g, b, a): one row for each pixel of (key, width, height, rgba)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for k, w, h, rgba in zip(pdf[key], pdf["width"], pdf["height"], pdf["rgba"], strict=True):
                px = np.frombuffer(rgba, np.uint8).reshape(int(h), int(w), 4).astype(np.int32)
                for y0 in range(0, int(h), 256):
                    part = px[y0 : y0 + 256]
                    y, x = np.mgrid[y0 : y0 + len(part), 0 : int(w)]
                    flat = part.reshape(-1, 4)
                    yield pd.DataFrame({"asset": k, "x": x.ravel().astype(np.int32), "y": y.ravel().astype(np.int32), "r": flat[:, 0], "g": flat[:, 1], "b": flat[:, 2], "a": flat[:, 3]})

    return images.filter("rgba is not null").select(key, "width", "height", "rgba").mapInPandas(run, "asset string, x int, y int, r int, g int, b int, a int")


def numbered_lines(files: DataFrame) -> DataFrame:
    """(path, line, text) of text files (path, content), lines from 1."""
    text = F.col("content").cast("string")
    return files.select("path", F.posexplode(F.split(text, "\r?\n")).alias("line", "text")).withColumn("line", F.col("line") + 1)


def importer_settings(lines: DataFrame) -> DataFrame:
    """(path, animation_type, avatar_setup) of importer files; a setting that is not there exactly once is null."""
    get = lambda k: F.when(F.regexp_extract("text", rf"^  {k}:\s*(-?[0-9]+)\s*$", 1) != "", F.regexp_extract("text", rf"^  {k}:\s*(-?[0-9]+)\s*$", 1).try_cast("int"))
    rows = lines.select("path", get("animationType").alias("t"), get("avatarSetup").alias("s"))
    one = lambda c: F.when(F.count(c) == 1, F.max(c))
    return rows.groupBy("path").agg(one("t").alias("animation_type"), one("s").alias("avatar_setup"))


def _section(lines: DataFrame, name: str) -> DataFrame:
    """The lines of a section at four blanks, each with the number of its entry."""
    w = Window.partitionBy("path").orderBy("line")
    starts = F.regexp_extract("text", r"^    ([A-Za-z]+):", 1)
    at = lines.withColumn("_s", F.last(F.when(starts != "", starts), ignorenulls=True).over(w)).filter(F.col("_s") == name)
    return at.withColumn("entry", F.sum(F.col("text").rlike(r"^    - ").cast("int")).over(w)).filter("entry > 0")


def _field(pattern: str) -> Column:
    return F.max(F.when(F.col("text").rlike(pattern), F.regexp_extract("text", pattern, 1)))


def vector(payload: Column) -> Column:
    """[x, y, z] of text like 'x: 1, y: 2, z: 3'; null unless all three are finite numbers."""
    parts = F.str_to_map(F.regexp_replace(payload, r"\s", ""), F.lit(","), F.lit(":"))
    v = F.array(*(F.element_at(parts, a).try_cast("double") for a in "xyz"))
    return F.when(F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))), v)


def human_mappings(lines: DataFrame) -> DataFrame:
    """(path, bone, slot_name, line) of the human section."""
    rows = _section(lines, "human").groupBy("path", "entry").agg(_field(r"^    - boneName:\s*(.*?)\s*$").alias("bone"), _field(r"^      humanName:\s*(.*?)\s*$").alias("slot_name"), F.min("line").alias("line"))
    return rows.filter("bone is not null and slot_name is not null").drop("entry")


def skeleton_bones(lines: DataFrame) -> DataFrame:
    """(path, name, parent, position, scale, line) of the skeleton section."""
    rows = _section(lines, "skeleton").groupBy("path", "entry").agg(
        _field(r"^    - name:\s*(.*?)\s*$").alias("name"),
        _field(r"^      parentName:\s*(.*?)\s*$").alias("parent"),
        vector(_field(r"^      position:\s*\{(.*?)\}\s*$")).alias("position"),
        vector(_field(r"^      scale:\s*\{(.*?)\}\s*$")).alias("scale"),
        F.min("line").alias("line"),
    )
    return rows.filter("name is not null").drop("entry")


def frontmatter(files: DataFrame) -> DataFrame:
    """(path, keys, body_lines, ok): whether a document opens with exactly name and description, in order, and its body is within 500 lines."""
    text = F.col("content").cast("string")
    head = F.regexp_extract(text, r"(?s)\A---\r?\n(.*?)\r?\n---\r?\n", 1)
    body = F.regexp_replace(text, r"(?s)\A---\r?\n.*?\r?\n---\r?\n", "")
    keys = F.filter(F.transform(F.split(head, "\r?\n"), lambda s: F.regexp_extract(s, r"^([A-Za-z_-]+):", 1)), lambda k: k != "")
    lines = F.size(F.split(body, "\n"))
    return files.select("path", keys.alias("keys"), lines.alias("body_lines"), ((F.array_join(keys, ",") == "name,description") & (lines <= 500)).alias("ok"))
