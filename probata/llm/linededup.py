"""Line dedup: a deletion-neighbourhood join of lines, in DataFrame functions only.

A line is its sequence of words. Lines that are not blank count as repeated when equal, and from NEAR_WORDS on also within one
edit: a word put in, left out or exchanged. If either line has fewer than FREE_WORDS, a word that is put in or left out has a quarter of
the longer line's characters at most, and one that is exchanged changes by one character. A line goes if an earlier one, by doc_id
and line number, is such a repeat; all are judged on the input. Equal lines meet by their hash. For the others,
a line has a variant for each word left out and each gap between words, keyed by place and
by hashes of what stands before and after; short lines have the same for the characters of each word. Two lines are one exchange apart when
they share a left-out variant, and one insertion apart when the left-out variant of one is the gap variant of the other. Which edits
are allowed is known from each line alone, so the least line of each
key tells all that a key can tell, without pairs; the words of each match are compared before it counts. Within one edit, two lines share
their first or their last half: only lines that share a half with another emit variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Words from which on lines also match within an edit; 1 covers every line.
NEAR_WORDS = 3
#: From here on an edit may be of any word; in shorter lines a word put in or left out has one in so many characters (blanks not counted) at most.
FREE_WORDS, CHARACTERS = 10, 4
#: Words that are hashed one after another; longer lines in runs of so many.
RUN_WORDS = 64
#: As many rows of keys and places (48 bytes each) are sent to all executors at most; beyond that, they are joined by a shuffle.
MOST_SENT = 1 << 20
#: Lines of a document at most, for the place of a line as one number.
LINES = 10**9


def words_of(line: Column) -> Column:
    return F.array_remove(F.split(F.translate(line, "\t\r\x0b\x0c", "    "), " "), "")


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, row, place, words) of each line that is not blank; row tells rows of one doc_id apart."""
    # The text ends here: a line's row carries the hash alone.
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("row"), F.split("text", "\n").alias("lines"))
    lines = rows.select("doc_id", "row", F.posexplode("lines").alias("pos", "line")).filter(F.ltrim(F.col("line"), F.lit(" \t\r\x0b\x0c")) != "")
    place = (F.col("doc_id").cast("decimal(20,0)") * F.lit(LINES).cast("decimal(10,0)") + F.col("pos")).cast("decimal(38,0)")
    return lines.select("doc_id", "row", "pos", place.alias("place"), words_of(F.col("line")).alias("words"))


def half_keys(words: Column) -> list[Column]:
    """Keys of the first and last halves, for both halves that a line within one edit can share."""
    n = F.size(words)
    out = []
    for k in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        out += [F.xxhash64(F.lit("first"), F.slice(words, F.lit(1), k)), F.xxhash64(F.lit("last"), F.slice(words, n - k + 1, k))]
    return out


def running_hashes(words: Column, run: int = RUN_WORDS) -> Column:
    """For each number of words from 0 on, a hash of so many first words; the same for lines that begin alike, in time proportional to their words.

    Each is made from its neighbour's within runs of words, and from the hash of the runs before.
    """
    step = lambda acc, w: F.concat(acc, F.array(F.xxhash64(F.element_at(acc, -1), w)))
    start = F.array(F.lit(42).cast("bigint"))
    inside = lambda part: F.aggregate(part, start, step)
    runs = F.ceil(F.size(words) / run).cast("int")
    parts = F.transform(F.sequence(F.lit(0), runs - 1), lambda k: inside(F.slice(words, k * run + 1, F.lit(run))))
    # What stands before a run: nothing, the first run, then each with those before it. Bound by zip_with, as a lambda would work it out for every word.
    last = F.transform(parts, lambda p: F.element_at(p, -1))
    before = F.concat(F.array(F.lit(None).cast("bigint")), F.aggregate(F.slice(last, F.lit(2), runs - 2), F.array(F.get(last, F.lit(0))), step))
    rest = F.zip_with(parts, before, lambda p, b: F.when(b.isNull(), p).otherwise(F.transform(F.slice(p, F.lit(2), F.lit(run)), lambda h: F.xxhash64(b, h))))
    return F.when(F.size(words) <= run, inside(words)).otherwise(F.flatten(rest))


def characters(words: Column) -> Column:
    return F.length(F.array_join(words, ""))


def variants(lines: DataFrame) -> DataFrame:
    """(key, exchange, leave, at, place): for each line, every word left out, every gap, and for short lines the same of the characters of a word.

    exchange and leave tell whether what is left out may be exchanged, or left out for good; neither marks a gap. at is the word's place.
    A line that shares only its first half with others can differ from them only after it, and the other way round; variants elsewhere are left out.
    """
    before = running_hashes(F.col("words"))
    after = F.reverse(running_hashes(F.reverse("words")))
    half = F.floor((F.col("n") - 1) / 2).cast("int")
    low = F.when(F.col("last"), 0).otherwise(half)
    high = F.when(F.col("first"), F.col("n")).otherwise(F.col("n") - half)
    both = lines.select("place", "n", "words", characters(F.col("words")).alias("size"), low.alias("low"), high.alias("high"), before.alias("before"), after.alias("after"))
    # after[i] hashes words from i on; before[i] those up to i.
    row = lambda key, exchange, leave, at: F.struct(key.alias("key"), exchange.alias("exchange"), leave.alias("leave"), at.alias("at"))
    yes, no = F.lit(True), F.lit(False)
    free = F.col("n") >= FREE_WORDS
    each = F.sequence("low", F.least("high", F.col("n") - 1))
    around = lambda i: (i, F.get("before", i), F.get("after", i + 1))
    leave = lambda i: (F.col("n") > FREE_WORDS) | (CHARACTERS * F.length(F.get("words", i)) <= F.col("size"))
    cut = F.filter(F.transform(each, lambda i: row(F.xxhash64(*around(i)), free, leave(i), i)), lambda v: v["exchange"] | v["leave"])
    gap = F.transform(F.sequence("low", "high"), lambda i: row(F.xxhash64(i, F.get("before", i), F.get("after", i)), no, no, i))
    # Of short lines: each word without each of its characters, and with a gap between them.
    word = lambda i: F.get("words", i)
    without = lambda w, p: F.concat(F.substr(w, F.lit(1), p), F.substr(w, p + 2))
    inner = lambda i, p, w: F.xxhash64(*around(i), p, w)
    less = lambda i: F.transform(F.sequence(F.lit(0), F.length(word(i)) - 1), lambda p: row(inner(i, p, without(word(i), p)), yes, yes, i))
    room = lambda i: F.transform(F.sequence(F.lit(0), F.length(word(i))), lambda p: row(inner(i, p, word(i)), no, no, i))
    small = F.when(~free, F.flatten(F.transform(each, lambda i: F.concat(less(i), room(i))))).otherwise(F.slice(gap, 1, 0))
    return both.select("place", F.explode(F.concat(cut, gap, small)).alias("v")).select("v.key", "v.exchange", "v.leave", "v.at", "place")


def sent_if_few(df: DataFrame) -> DataFrame:
    """A staged table, marked to be sent to all executors if its rows are at most MOST_SENT."""
    df = staged(df)
    return F.broadcast(df) if df.count() <= MOST_SENT else df


def one_edit(a: Column, b: Column, at: Column) -> Column:
    """Whether the words of a and b are equal but for one at a place, which is exchanged or in one of them only, and the edit is allowed."""
    out = lambda w: F.concat(F.slice(w, F.lit(1), at), F.slice(w, at + 2, F.greatest(F.size(w) - at - 1, F.lit(0))))
    allowed = lambda w: (F.size(w) > FREE_WORDS) | (CHARACTERS * F.length(F.get(w, at)) <= characters(w))
    exchanged = (out(a) == out(b)) & ((F.size(a) >= FREE_WORDS) | (F.levenshtein(F.get(a, at), F.get(b, at)) <= 1))
    more = F.size(a) - F.size(b)
    return F.when(more == 0, exchanged).when(more == 1, (out(a) == b) & allowed(a)).when(more == -1, (a == out(b)) & allowed(b)).otherwise(F.lit(False))


def repeated_lines(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """(doc_id, row, gone): the numbers of the lines that go, from 0, for each row that loses any."""
    lines = lines_of(docs)
    keys = half_keys(F.col("words"))
    near = F.size("words") >= near_words
    each = lines.select("doc_id", "row", "pos", "place", F.xxhash64("words").alias("hash"), *(F.when(near, k).alias(f"k{i}") for i, k in enumerate(keys)))
    each = staged(each)
    distinct = staged(each.groupBy("hash").agg(F.min("place").alias("place"), F.max("place").alias("last"), *(F.min(f"k{i}").alias(f"k{i}") for i in range(len(keys)))))
    # Lines that share a half with another line.
    sides = F.array_distinct(F.array(*(F.struct(F.col(f"k{i}").alias("key"), F.lit(i % 2 == 0).alias("first")) for i in range(len(keys)))))
    half = distinct.filter("k0 is not null").select("place", "hash", F.explode(sides).alias("k")).select("place", "hash", "k.key", "k.first")
    shared = sent_if_few(half.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key"))
    some = half.join(shared, "key").groupBy("hash", "place").agg(F.bool_or("first").alias("first"), F.bool_or(~F.col("first")).alias("last"))
    some = sent_if_few(some)
    holders = sent_if_few(some.select(((F.col("place") - F.pmod("place", F.lit(LINES))) / LINES).cast("long").alias("doc_id")).distinct())
    words = lines_of(docs.join(holders, "doc_id", "left_semi")).filter(near).select(F.xxhash64("words").alias("hash"), "place", "words")
    near_lines = staged(words.join(some, ["hash", "place"]).dropDuplicates(["hash"]).select("hash", "place", "words", F.size("words").alias("n"), "first", "last"))
    # Counted first and joined after: written once rather than worked out twice.
    v = staged(variants(near_lines))
    first = lambda of: F.min(F.when(of, F.col("place")))
    is_gap = ~(F.col("exchange") | F.col("leave"))
    least = v.groupBy("key").agg(first(F.col("exchange")).alias("exchange_place"), first(F.col("leave")).alias("leave_place"), first(is_gap).alias("gap_place"), F.count(F.lit(1)).alias("c"))
    least = sent_if_few(least.filter("c > 1 and (exchange_place is not null or leave_place is not null)").drop("c"))
    met = v.join(least, "key")
    # What is left out matches an earlier line that leaves something out there too, or one with the gap; a gap matches one that leaves something out.
    one = lambda mine, theirs: F.when(mine & (F.col(theirs) < F.col("place")), F.col(theirs))
    earlier = F.array_compact(F.array(one(F.col("exchange"), "exchange_place"), one(F.col("leave"), "gap_place"), one(is_gap, "leave_place")))
    met = met.select("place", "at", F.explode(earlier).alias("by")).distinct()
    mine = near_lines.select("place", "hash", F.col("words").alias("a"))
    theirs = near_lines.select(F.col("place").alias("by"), F.col("words").alias("b"))
    changed = met.join(mine, "place").join(theirs, "by").filter(one_edit(F.col("a"), F.col("b"), F.col("at"))).select("hash").distinct().withColumn("near", F.lit(True))
    # Lines with an equal one elsewhere, or one edit from an earlier one, are few beside all.
    known = distinct.join(changed, "hash", "left").filter("last <> place or near").select("hash", F.col("place").alias("kept"), F.coalesce("near", F.lit(False)).alias("near"))
    gone = each.select("doc_id", "row", "pos", "place", "hash").join(sent_if_few(known), "hash").filter("near or place <> kept")
    return gone.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("gone"))


def deduplicated(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """docs with n_lines, n_removed, and text without the lines that an earlier line repeats; other columns stay.

    Null texts and rows without doc_id pass unchanged, and their lines repeat nothing. Blank lines
    stay. A row that is repeated as a whole is one row: lines at the same place of the same doc_id do not
    repeat each other. Columns named n_lines or n_removed are replaced.
    """
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    gone = repeated_lines(docs.select("doc_id", "text"), near_words).select(F.col("doc_id").alias("__line_doc"), F.col("row").alias("__line_row"), F.col("gone").alias("__line_gone"))
    rows = docs.select(*names).withColumn("__line_own", F.xxhash64("text"))
    out = rows.join(gone, (F.col("doc_id") == F.col("__line_doc")) & (F.col("__line_own") == F.col("__line_row")), "left")
    # Split once, in a projection of its own: a lambda that split the text would do so for every line.
    out = out.withColumn("__line_parts", F.split("text", "\n"))
    n = F.size("__line_parts")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), "__line_gone")
    left = F.array_join(F.transform(stay, lambda i: F.get("__line_parts", i)), "\n")
    text = F.when(F.col("__line_gone").isNull(), F.col("text")).otherwise(left)
    return out.select(*(text.alias("text") if c.lower() == "text" else F.col(c) for c in names), F.coalesce(n, F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("__line_gone"), F.lit(0)).cast("long").alias("n_removed"))


def report(docs: DataFrame, near_words: int = NEAR_WORDS) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) of every row; a null text counts as empty."""
    out = deduplicated(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), near_words)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
