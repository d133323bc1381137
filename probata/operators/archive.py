"""Archive entries: an inventory, and the reasons that block an archive from being unpacked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probata.functions import paths

MAX_FILES, MAX_TOTAL, MAX_SINGLE, MAX_RATIO = 10_000, 1 << 30, 1 << 29, 200.0


def extension_histogram(entries: DataFrame, archive: str, name: str, size: str) -> DataFrame:
    """(archive, extension, files, bytes); folders do not count."""
    ext = paths.suffix(F.col(name))
    files = entries.filter(~F.col(name).endswith("/"))
    return files.groupBy(archive, F.when(ext == "", "[no extension]").otherwise(ext).alias("extension")).agg(F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"))


def entry_facts(entries: DataFrame) -> DataFrame:
    """entries (archive, filename, file_size, compress_size, external_attr, flag_bits) with what the policy asks of each."""
    name, kind = F.col("filename"), F.shiftright("external_attr", 16).bitwiseAND(0xF000)
    file = ~name.endswith("/")
    return entries.withColumns(
        {
            "is_file": file,
            "identity": paths.collision_identity(name),
            "unsafe": paths.is_unsafe(name),
            "license": file & paths.is_license(name),
            "executable": file & paths.is_executable(name),
            "code": file & paths.is_code(name),
            "link_or_special": ~kind.isin(0, 0x8000, 0x4000),
            "encrypted": F.col("flag_bits").bitwiseAND(1) == 1,
            "zero_compressed": file & (F.col("file_size") > 0) & (F.col("compress_size") == 0),
            "ratio": F.when(file & (F.col("file_size") > 0), F.col("file_size") / F.greatest(F.lit(1), F.col("compress_size"))),
        }
    )


def archive_verdicts(entries: DataFrame, max_files: int = MAX_FILES, max_total: int = MAX_TOTAL, max_single: int = MAX_SINGLE, max_ratio: float = MAX_RATIO) -> DataFrame:
    """(archive, entries, max_ratio, blocked_reasons, verdict, safe_to_extract) of each archive."""
    facts = entry_facts(entries)
    collide = facts.groupBy("archive", "identity").count().groupBy("archive").agg(F.max("count").alias("_most"))
    any_ = lambda c: F.bool_or(F.col(c)).alias(c)
    sums = facts.groupBy("archive").agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum(F.when(F.col("is_file"), F.col("file_size")).otherwise(0)).alias("_total"),
        F.max(F.when(F.col("is_file"), F.col("file_size"))).alias("_single"),
        F.coalesce(F.max("ratio"), F.lit(1.0)).alias("max_ratio"),
        *(any_(c) for c in ("unsafe", "license", "executable", "code", "link_or_special", "encrypted", "zero_compressed")),
    )
    rules = {
        "unsafe_archive_paths": F.col("unsafe"),
        "unexpected_executables": F.col("executable"),
        "missing_license_evidence": ~F.col("license"),
        "link_or_special_entries": F.col("link_or_special"),
        "encrypted_entries_cannot_be_audited": F.col("encrypted"),
        "nonempty_zero_compressed_entries": F.col("zero_compressed"),
        "duplicate_or_case_colliding_paths": F.col("_most") > 1,
        "code_or_auto_compiled_entries_require_review": F.col("code"),
        "entry_count_limit_exceeded": F.col("entries") > max_files,
        "total_uncompressed_limit_exceeded": F.col("_total") > max_total,
        "single_file_limit_exceeded": F.col("_single") > max_single,
        "compression_ratio_limit_exceeded": F.col("max_ratio") > max_ratio,
    }
    reasons = F.array_compact(F.array(*(F.when(rule, F.lit(code)) for code, rule in rules.items())))
    out = sums.join(collide, "archive").select("archive", "entries", "max_ratio", reasons.alias("blocked_reasons"))
    blocked = F.size("blocked_reasons") > 0
    return out.withColumns({"verdict": F.when(blocked, "blocked").otherwise("pass"), "safe_to_extract": ~blocked})
