"""WARC records of pages, and a Merkle fixity audit of replicas.

Pages become WARC records, dealt into files of about FILE_RECORDS records; a record's place in its file is an offset
range. For each copy of a file a tree is hashed over its records in order of offset: a leaf is the hash of the bytes
that the copy holds in a record's range, a node that of up to FANOUT children with the range they cover.
An audit compares the roots of two copies, goes down only where they differ, and ends at the ranges whose bytes
differ. Only hashes and ranges are shuffled, never the bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

FILE_RECORDS = 1024
FANOUT = 16
DATE = "2024-01-01T00:00:00Z"


def record(url: Column, body: Column) -> Column:
    """The bytes of a WARC resource record, as text: head, body, and the two line ends that close it."""
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:sha256:"),
        F.sha2(F.concat(url, F.lit("\n"), body).cast("binary"), 256),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def archived(pages: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """(page_id, url, file, record): pages as records, each with the file it belongs to.

    A null url or html is empty. Rows stay one to one, repeated ones too. Other columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    n = max(1, -(-rows.count() // file_records))
    name = F.md5(F.concat_ws(" ", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.col("url")).cast("binary"))
    file = F.conv(F.substring(name, 1, 8), 16, 10).cast("long") % n
    return rows.select("page_id", "url", file.alias("file"), record(F.col("url"), F.col("html")).alias("record"))


def leaves(copies: DataFrame, *held: str) -> DataFrame:
    """(file, number, page_id, url, offset, length, a hash for each column in held): one row for each record's range.

    copies: (page_id, url, file, record, and a column with what each copy holds in the record's range, null if nothing can be read).
    The hash of the k-th column in held is named copyk.
    """
    names = [f"copy{k}" for k in range(len(held))]
    hashes = [F.sha2(F.col(c).cast("binary"), 256).alias(n) for c, n in zip(held, names, strict=True)]
    rows = copies.select("file", "page_id", "url", F.octet_length("record").cast("long").alias("length"), F.sha2(F.col("record").cast("binary"), 256).alias("_order"), *hashes)
    w = Window.partitionBy("file").orderBy("page_id", "url", "_order")
    number = F.row_number().over(w).cast("long") - 1
    before = F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    return rows.select("file", number.alias("number"), "page_id", "url", before.alias("offset"), "length", *names)


def parents(nodes: DataFrame, *held: str, fanout: int = FANOUT) -> DataFrame:
    """The next level of the trees: (file, number, offset, length, hashes) over up to fanout children each."""

    def over(c: str) -> Column:
        part = F.struct("number", F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), F.coalesce(c, F.lit("-"))).alias("h"))
        return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["h"]), ",").cast("binary"), 256).alias(c)

    return nodes.groupBy("file", F.expr(f"number div {fanout}").alias("number")).agg(F.min("offset").alias("offset"), F.sum("length").alias("length"), *(over(c) for c in held))


def audit(copies: DataFrame, one: str, other: str, fanout: int = FANOUT) -> DataFrame:
    """(file, number, page_id, url, offset, length, one, other): the ranges at which the two copies differ.

    copies as for leaves; one and other come back as hashes, null where nothing could be read; if they are one column, the second is named copy1. No rows: no difference.
    """
    a, b = "copy0", "copy1"
    levels = [staged(leaves(copies, one, other))]
    most = levels[0].agg(F.max("number").alias("n")).first()["n"]
    while most is not None and most > 0:
        levels.append(staged(parents(levels[-1], a, b, fanout=fanout)))
        most //= fanout
    differs = ~F.col(a).eqNullSafe(F.col(b))
    bad = levels[-1].filter(differs)
    for below in reversed(levels[:-1]):
        up = bad.select(F.col("file").alias("_f"), F.col("number").alias("_n"))
        children = below.join(up, (F.col("file") == F.col("_f")) & (F.expr(f"number div {fanout}") == F.col("_n")), "left_semi")
        bad = children.filter(differs)
    return bad.withColumnsRenamed({a: one, b: other if other != one else b})


def damaged(archive: DataFrame) -> DataFrame:
    """archive with columns kept and replica: what two copies hold. A few records of the replica, picked by page_id, are changed, blanked or lost."""
    pick = F.substring(F.md5(F.concat(F.lit("damage "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).cast("binary")), 1, 2)
    changed = F.concat(F.expr("left(record, length(record) - 5)"), F.lit("#"), F.expr("right(record, 4)"))
    replica = F.when(pick == "00", changed).when(pick == "01", F.repeat(F.lit("0"), F.octet_length("record"))).when(pick == "02", F.lit(None)).otherwise(F.col("record"))
    return archive.withColumns({"kept": F.col("record"), "replica": replica})


def fixity(pages: DataFrame) -> DataFrame:
    """(file, number, page_id, url, offset, length, kept, replica): the damage that an audit of a damaged replica locates."""
    return audit(damaged(archived(pages)), "kept", "replica")
