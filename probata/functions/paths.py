"""Column functions on paths, names and digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import casefold, nfc

# Fixed values.
EXECUTABLE = (".app", ".bat", ".cmd", ".com", ".command", ".dll", ".dylib", ".exe", ".jar", ".js", ".msi", ".ps1", ".py", ".scr", ".sh", ".so", ".vbs")
AUTO_COMPILED = (".asmdef", ".asmref", ".boo", ".cs", ".rsp")
LICENSE_WORDS = ("copying", "copyright", "license", "licence", "notice", "readme")
ARCHIVE_SUFFIX = {
    ".7z": "7z", ".bz2": "bzip2", ".cab": "cab", ".gz": "gzip", ".rar": "rar", ".tar": "tar", ".tar.bz2": "tar.bz2", ".tar.gz": "tar.gz",
    ".tar.xz": "tar.xz", ".tbz": "tar.bz2", ".tbz2": "tar.bz2", ".tgz": "tar.gz", ".txz": "tar.xz", ".xz": "xz", ".zip": "zip",
}
ARCHIVE_MAGIC = {"52617221": "rar", "377ABCAF271C": "7z", "1F8B": "gzip", "425A68": "bzip2", "FD377A585A00": "xz", "4D534346": "cab"}
DEVICES = ("con", "prn", "aux", "nul", *(f"com{i}" for i in range(1, 10)), *(f"lpt{i}" for i in range(1, 10)))


def components(path: Column) -> Column:
    """The parts of a path that name something."""
    return F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda c: ~c.isin("", "."))


def suffix(name: Column) -> Column:
    """The last suffix of a name, in lower case with its dot; empty if the only dot leads."""
    return F.lower(F.regexp_extract(name, r"(?:^|/)\.*[^/.][^/]*?(\.[^./]+)$", 1))


def stem(name: Column) -> Column:
    """The last part of a path without its suffix."""
    last = F.regexp_extract(name, r"([^/]*)$", 1)
    return F.regexp_replace(last, r"^(\.*[^.].*)\.[^.]+$", "$1")


def is_sha256(value: Column) -> Column:
    return F.coalesce(value.rlike("^[0-9a-f]{64}$"), F.lit(False))


def is_portable(path: Column, strict: bool = False) -> Column:
    """Whether a path is relative and means the same everywhere; strict also forbids empty, '.' and '..' parts."""
    fine = (F.length(path) > 0) & (path != ".") & ~path.contains("\\") & ~path.contains("\x00") & ~path.startswith("/") & ~path.rlike("^[A-Za-z]:") & ~F.array_contains(F.split(path, "/"), "..")
    if strict:
        parts = F.split(path, "/")
        fine &= ~F.exists(parts, lambda c: c.isin("", ".", ".."))
    return F.coalesce(fine, F.lit(False))


def is_unsafe(path: Column) -> Column:
    """Whether unpacking an entry of this name could leave its folder or hit a device."""
    plain = F.replace(path, F.lit("\\"), F.lit("/"))
    device = lambda c: F.regexp_extract(F.lower(F.regexp_replace(c, r"[ .]+$", "")), r"^([^.]*?) *(?:\..*)?$", 1).isin(*DEVICES)
    bad = F.exists(components(path), lambda c: c.contains(":") | c.endswith(".") | c.endswith(" ") | device(c))
    return plain.startswith("/") | F.array_contains(F.split(plain, "/"), "..") | bad


def collision_identity(path: Column) -> Column:
    """The name under which entries collide where case (folded, not only lowered), form (NFC), trailing dots and blanks do not count."""
    return casefold(nfc(F.array_join(F.transform(components(path), lambda c: F.regexp_replace(c, r"[ .]+$", "")), "/")))


def is_license(name: Column) -> Column:
    plain = F.regexp_replace(F.lower(stem(name)), r"[^\p{L}\p{N}]", "")
    return plain.rlike("|".join(LICENSE_WORDS))


def is_code(path: Column) -> Column:
    """Whether any part of a path has a suffix that runs or is compiled."""
    return F.exists(components(path), lambda c: suffix(c).isin(*EXECUTABLE, *AUTO_COMPILED))


def is_executable(path: Column) -> Column:
    return suffix(path).isin(*EXECUTABLE)


def archive_format(name: Column, head: Column | None = None) -> Column:
    """The archive format that the first bytes (binary) tell, or else the longest known suffix; null if none."""
    out = F.lit(None).cast("string")
    low = F.lower(name)
    for s, kind in sorted(ARCHIVE_SUFFIX.items(), key=lambda x: len(x[0])):
        out = F.when(low.endswith(s), F.lit(kind)).otherwise(out)
    if head is not None:
        digits = F.hex(head)
        for magic, kind in ARCHIVE_MAGIC.items():
            out = F.when(digits.startswith(magic), F.lit(kind)).otherwise(out)
        out = F.when(F.substring(digits, 2 * 257 + 1, 10) == "7573746172", F.lit("tar")).otherwise(out)
    return out


def redacted_url(url: Column) -> Column:
    """A URL without user, query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^([A-Za-z][A-Za-z0-9+.-]*://)[^/@]*@", "$1")


def natural_key(value: Column) -> Column:
    """A key under which digit runs compare as numbers, after text at the same place."""
    value = casefold(value)
    parts = F.regexp_extract_all(value, F.lit(r"([0-9]+|[^0-9]+)"), 1)
    # A key starts with text, empty if the value starts with digits.
    parts = F.when(value.rlike("^[0-9]"), F.concat(F.array(F.lit("")), parts)).otherwise(parts)
    digits = lambda p: p.rlike("^[0-9]+$")
    number = lambda p: F.when(digits(p), p.try_cast("decimal(38,0)")).otherwise(F.lit(0))
    return F.transform(parts, lambda p: F.struct(digits(p).cast("int").alias("tag"), number(p).alias("number"), F.when(digits(p), F.lit("")).otherwise(p).alias("text")))


def rgba_sha256(width: Column, height: Column, rgba: Column) -> Column:
    """The digest of an image's pixels and size."""
    number = lambda c: F.unhex(F.lpad(F.hex(c.cast("long")), 16, "0"))
    return F.sha2(F.concat(F.lit(b"RGBA\x00"), number(width), number(height), rgba), 256)


def slot_key(value: Column) -> Column:
    """Letters and digits of a name, in lower case."""
    return F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}]", ""))
