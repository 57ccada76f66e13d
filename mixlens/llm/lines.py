"""Line deduplication up to a few edits, by a join on segments.

A line is cut into one segment more than the edits allowed. Two lines within
that distance share at least one segment whole, near the same place. Lines are
indexed by their segments, with length and number of the segment, and probe the
index of their own and slightly smaller lengths with the substrings that can
meet each segment. What shares a key is verified by the edit distance in a band
around the diagonal. Everything here is Spark's own functions.

Lines of one template share most segments and yet may be many edits apart. An
edit changes a few pairs of neighbouring code points only; so one bit for each
class of pairs, whether the line has an odd number of them, tells most lines
that are too far apart without comparing them.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import let, release, text_of, written
from mixlens.llm.components import components
from mixlens.llm.pivots import pivot_links

#: Edits allowed, and the length from which they are: shorter lines are like any other by chance.
EDITS, LEAST_CHARS = 2, 20
#: Up to so many ids are broadcast to pick the texts of candidates (8 bytes each); beyond, Spark joins as it sees fit.
BROADCAST = 2_000_000
#: 64-bit words of a line's sketch, and how many times as many pivots each round takes.
WORDS, GROWTH = 4, 16


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(how much longer the probing line is, segment, shift of the substring) for all substrings to look up.

    Left of segment i (from 0) at most i edits fit if it is the first that
    agrees, and right of it at most edits - i; that bounds how far it is moved.
    """
    found = []
    for longer in range(edits + 1):
        for i in range(edits + 1):
            low, high = max(-i, longer - (edits - i)), min(i, longer + (edits - i))
            found += [(longer, i, shift) for shift in range(low, high + 1)]
    return found


def keys(lines: DataFrame, edits: int) -> DataFrame:
    """node, bucket and own (1: the line is indexed by the key, 0: it looks it up) for all keys of all lines.

    A line of length l is cut into ``edits`` + 1 segments of nearly equal length,
    the last ones longer by one. With four bytes a code point, a place in a line
    is found without reading what stands before. The list of probes is unrolled
    as rows, which keeps the code that Spark generates small.
    """
    parts = edits + 1
    listed = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(i).alias("i"), F.lit(s).alias("s")) for d, i, s in probes(edits)])
    wide = lines.select("node", "len", F.encode("line", "UTF-32").alias("wide"))
    rows = wide.select("node", "len", "wide", F.explode(listed).alias("p"))
    rows = rows.select("node", "wide", "p.i", "p.d", "p.s", (F.col("len") - F.col("p.d")).alias("l"))
    rows = rows.withColumns({"base": F.expr(f"int(l div {parts})"), "plain": F.expr(f"{parts} - l % {parts}")})
    start = F.col("base") * F.col("i") + F.greatest(F.lit(0), F.col("i") - F.col("plain")) + F.col("s")
    size = F.col("base") + F.when(F.col("i") >= F.col("plain"), 1).otherwise(0)
    rows = rows.select("node", "i", "l", "d", "s", F.substring("wide", start * 4 + 1, size * 4).alias("part"))
    return rows.select(
        "node",
        F.xxhash64("i", "l", "part").alias("bucket"),
        F.when((F.col("d") == 0) & (F.col("s") == 0), 1).otherwise(0).alias("own"),
    )


def distinct_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """node (a number), line, len, n (how often it occurs) of all lines of ``least_chars`` and more."""
    lines = docs.select(F.explode(F.split(text_of(), "\n")).alias("line"))
    long = lines.where(F.length("line") >= least_chars)
    counted = long.groupBy("line").agg(F.count("*").alias("n"))
    return written(
        counted.select(F.monotonically_increasing_id().alias("node"), "line", F.length("line").alias("len"), "n"), "lines"
    )


def sketch(line: Column, words: int = WORDS) -> Column:
    """64 * ``words`` bits: for each class of neighbouring code points, by hash, whether the line has an odd number of them."""
    places = F.when(F.length(line) > 1, F.sequence(F.lit(0), F.length(line) - 2)).otherwise(F.array().cast("array<int>"))

    def bits(hashes: Column) -> Column:
        def word(w: int) -> Column:
            def flip(have: Column, h: Column) -> Column:
                own = F.pmod(F.shiftrightunsigned(h, 6), F.lit(words)) == w
                # Only the last six bits of a hash shift.
                bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(63).cast("int"))
                return F.when(own, have.bitwiseXOR(bit)).otherwise(have)

            return F.aggregate(hashes, F.lit(0).cast("long"), flip)

        return F.array(*[word(w) for w in range(words)])

    def hashed(wide: Column) -> Column:
        return let(F.transform(places, lambda i: F.xxhash64(F.substring(wide, i * 4 + 1, F.lit(8)))), bits)

    return let(F.encode(line, "UTF-32"), hashed)


def unlike(edits: int, words: int = WORDS) -> Callable[[Column, Column], Column]:
    """Whether two sketches differ in more bits than ``edits`` can change.

    Whatever the edit, at most two pairs of code points go and two come, so it
    changes four bits at most. No two lines within ``edits`` are told apart.
    """

    def told(one: Column, other: Column) -> Column:
        differ = [F.bit_count(one[w].bitwiseXOR(other[w])) for w in range(words)]
        return functools.reduce(operator.add, differ) > 4 * edits

    return told


def near_lines(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """Links (a, b) between lines within ``edits``, enough to connect all that are connected."""
    marked = keys(lines, edits)
    groups = marked.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.max("own").alias("own"))
    shared = written(groups.where("low < high and own = 1").select("bucket"), "line-keys")
    release(lines.sparkSession)
    members = written(marked.select("bucket", "node").join(shared, "bucket").distinct(), "line-buckets")
    wanted = written(members.select("node").distinct(), "line-nodes")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST else wanted
    texts = written(lines.select("node", "line").join(wanted, "node"), "line-texts")
    release(lines.sparkSession)

    def compare(pairs: DataFrame) -> DataFrame:
        first = pairs.join(texts.withColumnsRenamed({"node": "a", "line": "line_a"}), "a")
        both = first.join(texts.withColumnsRenamed({"node": "b", "line": "line_b"}), "b")
        far = F.levenshtein("line_a", "line_b", 2 * edits)
        return both.select("a", "b", F.when(far < 0, 2 * edits + 1).otherwise(far).cast("double").alias("far"))

    sketches = written(texts.select("node", sketch(F.col("line")).alias("sketch")), "line-sketches")
    links = pivot_links(members.join(sketches, "node"), compare, float(edits), GROWTH, None, unlike(edits), members.count())
    return written(links, "line-links")


def remove_near_lines(docs: DataFrame, edits: int = EDITS, least_chars: int = LEAST_CHARS, short_equal: bool = False) -> DataFrame:
    """Each row without the lines that an earlier line equals or nearly equals.

    Lines within ``edits`` of each other, and those that further lines connect,
    form a class; equal lines are of one class. The first line of a class, by
    doc_id and place in the text, stays; all others go. Lines of fewer than
    ``least_chars`` code points stay and play no part; with ``short_equal`` those
    that aren't empty go if they equal an earlier line, without edits. Other
    columns play no part.

    Gives doc_id, n_lines, n_links (verified links of the row's lines to other
    texts; links that follow from others are not all counted), n_removed, the
    ids ``first_ids`` of the documents that have the first lines, and ``kept``,
    the lines that are left. Null texts are empty and have one empty line. Rows
    of one id that repeat keep their first lines alike, as no order parts them; a
    null id comes last.
    """
    spark = docs.sparkSession
    lowest = 1 if short_equal else least_chars
    lines = distinct_lines(docs, lowest)
    release(spark)
    links = near_lines(lines.where(F.col("len") >= least_chars), edits)
    found = components(links)
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    n_links = ends.groupBy("node").agg(F.count("*").alias("links"))
    linked = found.join(n_links, "node", "left")
    # Lines that occur once and have no near line need no decision.
    some = lines.join(linked, "node", "left").where("n > 1 or root is not null")
    digest = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]
    some = written(
        some.select(*digest, F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "line-classes"
    )
    release(spark)
    rows = docs.select("doc_id", text_of().alias("text"))
    places = rows.select("doc_id", F.xxhash64("text").alias("key"), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    places = places.where(F.length("line") >= lowest).select("doc_id", "key", "place", *digest)
    members = written(places.join(some, ["h1", "h2"]).select("doc_id", "key", "place", "root", "links"), "line-places")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")
    firsts = members.groupBy("root").agg(F.min(order).alias("first"))
    judged = members.join(firsts, "root").withColumn(
        "removed", ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("place") == F.col("first.place")))
    )
    of_row = judged.groupBy(F.col("doc_id").alias("id"), F.col("key").alias("id_key")).agg(
        F.collect_set(F.when(F.col("removed"), F.col("place"))).alias("gone"),
        F.collect_set(F.when(F.col("removed"), F.col("first.doc_id"))).alias("first_ids"),
        F.sum("links").alias("links"),
    )
    of_row = written(of_row, "line-rows")
    release(spark)
    same = rows["doc_id"].eqNullSafe(of_row["id"]) & (F.xxhash64(rows["text"]) == of_row["id_key"])
    both = rows.join(of_row, same, "left").withColumn("lines", F.split("text", "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    left = F.when(F.col("gone").isNull() | (F.size("gone") == 0), F.col("text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    )
    return both.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.array_sort("first_ids").alias("first_ids"),
        left.alias("kept"),
    )
