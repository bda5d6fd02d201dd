"""Document fingerprints by invertible Bloom lookup tables (DataFrame functions only).

A text is the set of its piece digests. Pieces are parts of a line, cut where a word ends in
a letter or sign of PIECE (so that cuts follow the text, not its offsets), else after a word
or at the limit: the first of a line has 32 to 48 code points, so a text of 100 has a piece
in its first half, those after it 92 to 160, and the last may be shorter. A digest is a 64-bit hash of a piece and the
number of its occurrence: k copies of one are k digests. A sketch has CELLS cells in three
equal rows; a digest enters one cell of each row, named by three bits of its own, adding
one to its count and folding digest and check into it by exclusive or. The fingerprint is
the text's sketch. The sketch of one text less that of another holds the digests in which
they differ: cells with a count of one or minus one give theirs up, and peeling goes on
with it taken out. If digests stay, the pair is dealt by hash into more cells (groups of
digests with a sketch each), which peel alone, and again for those that still fail.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxspark.llm.common import read, without, written

PIECE = "(?m)^(?:[^\n]{30,46}?[aeiou.,;:!?] |[^\n]{30,47} |[^\n]{1,48})|[^\n]{90,158}?[aeiou.,;:!?] |[^\n]{90,159} |[^\n]{1,160}"
CELLS, THIRD, ROUNDS = 24, 8, 6
#: Digests of a pair that share a group after a failure, about, and after a further one;
#: groups that a failed sketch is dealt into, at most (larger ones are dealt again).
GROUP, SMALL, FANOUT = 10, 4, 64
#: Ranges of doc_id that find each document's next, at most, and documents of one, at least.
#: Beyond that ranges grow; they are sorted, never held.
RANGES, RANGE_ROWS = 1 << 15, 64
NONE, FOUND = "cast(array() as array<bigint>)", "cast(array() as array<struct<k:bigint,n:int>>)"


def piece_digests(text: Column | str) -> Column:
    """Hashes of a text's pieces: sorted, with repeats; none for an empty one. Not null."""
    return F.sort_array(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.xxhash64(p)))


def as_set(hashes: str) -> Column:
    """Sorted hashes to one digest for each occurrence, of the hash and its number."""
    n = F.size(hashes)
    ends = F.filter(
        F.transform(
            F.zip_with(hashes, F.slice(hashes, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a.alias("h"), (b.isNull() | (a != b)).alias("last"))),
            lambda x, i: F.struct(x["h"].alias("h"), x["last"].alias("last"), (i + 1).alias("upto")),
        ),
        lambda x: x["last"],
    )
    before = F.concat(F.array(F.lit(0)), F.transform(ends, lambda x: x["upto"]))
    each = lambda x, b: F.transform(F.sequence(F.lit(1), x["upto"] - b), lambda i: F.xxhash64(x["h"], i))
    counted = F.flatten(F.filter(F.zip_with(ends, before, lambda x, b: F.when(x.isNotNull(), each(x, b))), lambda x: x.isNotNull()))
    plain = F.transform(hashes, lambda h: F.xxhash64(h, F.lit(1)))
    return F.when(F.size(F.array_distinct(hashes)) == n, plain).otherwise(counted)


def let(name: str, value: str, use: str) -> str:
    """``use`` of a value that is worked out once: a lambda over an array of one. Like the
    functions below it takes and gives SQL text: peeling is one deep expression, which the
    client would build call by call."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def entry(k: str, n: str, s: str) -> str:
    """A digest with its sign, its check, and the cell that it enters in each row."""
    cells = ", ".join(f"'c{r}', cast(shiftright({k}, {3 * r}) & {THIRD - 1}L as int)" for r in range(3))
    return f"named_struct('k', {k}, 'n', {n}, 's', {s}, {cells})"


def entries(digests: str, sign: int = 1) -> str:
    return f"transform({digests}, k -> {entry('k', str(sign), 'xxhash64(k)')})"


def sketch(of: str) -> str:
    """The cells of ``entries``, row after row: signs summed, digests and checks folded."""
    fold = lambda part: f"aggregate(own, 0L, (x, e) -> x ^ e.{part})"
    cell = f"named_struct('n', aggregate(own, 0, (x, e) -> x + e.n), 'k', {fold('k')}, 's', {fold('s')})"
    row = lambda r: f"transform(sequence(0, {THIRD - 1}), i -> {let('own', f'filter(es, e -> e.c{r} = i)', cell)})"
    return let("es", of, f"concat({row(0)}, {row(1)}, {row(2)})")


def sketch_string(cells: str) -> Column:
    """A sketch as text: count, digest and check of each cell, in hexadecimal."""
    return F.array_join(F.transform(cells, lambda c: F.concat_ws(".", F.hex(c["n"]), F.hex(c["k"]), F.hex(c["s"]))), " ")


def less(a: str, b: str) -> str:
    """Sketch ``a`` less sketch ``b``."""
    return f"zip_with({a}, {b}, (x, y) -> named_struct('n', x.n - y.n, 'k', x.k ^ y.k, 's', x.s ^ y.s))"


def peeled(cells: str) -> str:
    """(found, clean) of a difference: the digests with their signs, as far as cells give them
    up, and whether all of them did. Each row of cells is an array of its own, in which a
    digest has one cell."""
    rows, empty = range(3), "c.n != 0 or c.k != 0 or c.s != 0"
    state = lambda row, found, more: f"named_struct({', '.join(f"'r{r}', {row(r)}" for r in rows)}, 'found', {found}, 'more', {more})"
    pure = ", ".join(f"filter(acc.r{r}, c -> abs(c.n) = 1 and xxhash64(c.k) = c.s)" for r in rows)
    pure = f"transform(array_distinct(concat({pure})), c -> {entry('c.k', 'c.n', 'c.s')})"
    out = "named_struct('n', c.n - e.n, 'k', c.k ^ e.k, 's', c.s ^ e.s)"
    left = lambda r: f"aggregate(p, acc.r{r}, (x, e) -> transform(x, (c, i) -> if(i = e.c{r}, {out}, c)))"
    taken = state(left, "concat(acc.found, transform(p, c -> named_struct('k', c.k, 'n', c.n)))", "true")
    stay = state(lambda r: f"acc.r{r}", "acc.found", "false")
    step = let("p", pure, f"if(size(p) = 0, {stay}, {taken})")
    start = let("cells", cells, state(lambda r: f"slice(cells, {THIRD * r + 1}, {THIRD})", FOUND, "true"))
    end = f"aggregate(sequence(1, {ROUNDS}), {start}, (acc, r) -> if(acc.more, {step}, acc))"
    return let("end", end, f"named_struct('found', end.found, 'clean', not exists(concat(end.r0, end.r1, end.r2), c -> {empty}))")


def dealt(a: str, b: str, level: int) -> str:
    """Digests of a failed pair, dealt into groups by hash and peeled alone: for each group
    found and clean, and its digests a and b where it is not clean. Where groups would hold
    many more digests than cells, they are left to be dealt again."""
    # The three lowest octal digits name cells, so groups go by the digits above them.
    share = "shiftrightunsigned(k, 9)" if level == 1 else f"xxhash64(k, 'level{level}')"
    size, group = f"(size({a}) + size({b}))", GROUP if level == 1 else SMALL
    groups = f"cast(greatest(2, least({FANOUT}, ceil({size} / {group}))) as bigint)"
    mine = lambda side: f"filter({side}, k -> pmod({share}, groups) = g)"
    peel = f"if({size} > {4 * CELLS * FANOUT}, named_struct('found', {FOUND}, 'clean', false), {peeled(sketch(f'concat({entries("pair.a")}, {entries("pair.b", -1)})'))})"
    one = let("p", peel, "named_struct('found', p.found, 'clean', p.clean, 'a', if(p.clean, null, pair.a), 'b', if(p.clean, null, pair.b))")
    each = let("pair", f"named_struct('a', {mine(a)}, 'b', {mine(b)})", one)
    return let("groups", groups, f"transform(sequence(0L, groups - 1L), g -> {each})")


def retried(a: str, b: str, cells: str) -> str:
    """Peels the difference ``cells`` of two sets and, where that fails, their groups: an
    array like that of ``dealt``."""
    first = f"array(named_struct('found', p.found, 'clean', true, 'a', {NONE}, 'b', {NONE}))"
    return let("p", peeled(cells), f"if(p.clean, {first}, {dealt(a, b, 1)})")


def found_in(groups: str) -> Column:
    return F.expr(f"flatten(transform(filter({groups}, x -> x.clean), x -> x.found))")


def failed_in(groups: str) -> Column:
    return F.expr(f"transform(filter({groups}, x -> not x.clean), x -> named_struct('a', x.a, 'b', x.b))")


def remaining(failed: DataFrame, keep: Callable[[Column], Column]) -> list[DataFrame]:
    """(id, failed) to (id, found) for each level: ``keep`` of what a group gives up. Each
    level is written, and levels end when none fail, as digests that share a group part by
    a fresh hash at each level."""
    level, parts = 1, []
    todo = failed.select("id", F.explode("failed").alias("p")).select("id", "p.a", "p.b")
    while todo.limit(1).count():
        level += 1
        out = todo.select("id", F.expr(dealt("a", "b", level)).alias("g"))
        out = written(out.select("id", keep(found_in("g")).alias("found"), failed_in("g").alias("failed")), "peeled")
        parts.append(out.select("id", "found"))
        todo = out.select("id", F.explode("failed").alias("p")).select("id", "p.a", "p.b")
    return parts


def differences(pairs: DataFrame) -> DataFrame:
    """(id, a, b, cells), arrays of distinct digests and the sketch of a less that of b, to
    (id, only_a, only_b): the digests that peeling recovers, all of them. Ids are unique."""
    first = pairs.select("id", F.expr(retried("a", "b", "cells")).alias("g"))
    first = written(first.select("id", found_in("g").alias("found"), failed_in("g").alias("failed")), "peeled")
    parts = [first.select("id", "found"), *remaining(first, lambda f: f)]
    found = reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.flatten(F.collect_list("found")).alias("found"))
    side = lambda sign: F.sort_array(F.transform(F.filter("found", lambda e: e["n"] == sign), lambda e: e["k"]))
    return found.select("id", side(1).alias("only_a"), side(-1).alias("only_b"))


def in_ranges(docs: DataFrame) -> tuple[DataFrame, Window]:
    """``docs`` (doc_id, text, ...) in ranges of doc_id, with __wx_r and __wx_guest, and the order
    of rows in a range: descending doc_id, null last; rows of one id by text.

    Bounds are doc_ids of the table, so the largest id of a range is known and its rows are
    also sent, as guests, to the range before it in this order, where they follow its last
    row; the largest of all go to the last range. So the next row in a range is the next
    document, and after the last the first.
    """
    n = docs.count()
    k = max(1, min(RANGES, n // RANGE_ROWS))
    probs = [i / k for i in range(1, k)] or [0.5]
    row = docs.agg(F.percentile_approx("doc_id", probs, 4 * max(k, 2500)).alias("p"), F.max("doc_id").alias("top")).first()
    bounds = sorted({*(row["p"] or []), *([] if row["top"] is None else [row["top"]])})
    at, doc = F.lit(bounds).cast("array<bigint>") if bounds else F.expr(NONE), F.col("doc_id")
    steps = [1 << i for i in reversed(range(max(1, len(bounds)).bit_length()))]
    # How many bounds are under the id, by halving; ids up to the first bound, and null: 0.
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda p, s: F.when((p + s <= len(bounds)) & (F.get(at, p + s - 1) < doc), p + s).otherwise(p))
    below = F.when(doc.isNull() | F.lit(not bounds), 0).otherwise(below)
    d = docs.withColumn("__wx_r", below)
    if bounds:
        guest = F.when(F.col("doc_id") == bounds[-1], F.lit(0)).when(F.get(at, F.col("__wx_r")) == doc, F.col("__wx_r") + 1)
    else:
        guest = F.lit(0)  # only null ids, if any row: one range, which follows itself
    here, there = F.struct(F.lit(False).alias("guest"), F.col("__wx_r").alias("r")), F.struct(F.lit(True).alias("guest"), guest.alias("r"))
    both = F.when(guest.isNull(), F.array(here)).otherwise(F.array(here, there))
    d = d.withColumn("__wx_h", F.explode(both)).withColumns({"__wx_r": F.col("__wx_h.r"), "__wx_guest": F.col("__wx_h.guest")}).drop("__wx_h")
    # Plain columns, so that windows after each other share one exchange and one sort.
    return d, Window.partitionBy("__wx_r").orderBy("__wx_guest", F.col("doc_id").desc_nulls_last(), "text")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, ...) with next_text: the text of the document next in descending order
    of doc_id (null ids last; rows of one id by text); the last row's next is the first."""
    d, order = in_ranges(without(docs, "next_text"))
    d = d.withColumn("next_text", F.lead(F.coalesce("text", F.lit(""))).over(order))
    return d.filter(~F.col("__wx_guest")).drop("__wx_r", "__wx_guest")


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to a written table, one row per row: id (unique), doc_id, n_chars,
    edited_sha256, the cells of text and edited text, sizes of the digest sets of text,
    edited text and next document, and for the pairs text - edited, text - next how many
    digests peeling found and the groups that failed. Every text is sketched once; the next
    row hands its digests and its sketch over."""
    d, order = in_ranges(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    # The range's rows are together before they are sketched, and stay there.
    d = d.repartition("__wx_r")
    d = d.withColumn("own", piece_digests("text")).withColumn("own", as_set("own"))
    d = d.withColumn("own_cells", F.expr(sketch(entries("own"))))
    after = {"next_text": "text", "next_digests": "own", "next_cells": "own_cells"}
    d = d.withColumns({name: F.lead(of).over(order) for name, of in after.items()})
    d = d.filter(~F.col("__wx_guest")).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    d = d.withColumn("edited", edited).withColumn("edit", piece_digests("edited")).withColumn("edit", as_set("edit"))
    d = d.withColumn("edit_cells", F.expr(sketch(entries("edit"))))
    for name, digests, cells in (("edited", "edit", "edit_cells"), ("next", "next_digests", "next_cells")):
        d = d.withColumn(f"{name}_g", F.expr(retried("own", digests, less("own_cells", cells))))
    out = d.select(
        F.monotonically_increasing_id().alias("id"), "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own_cells", "edit_cells",
        (F.size("own") + F.size("edit")).alias("edited_all"), (F.size("own") + F.size("next_digests")).alias("next_all"),
        *[F.size(found_in(f"{x}_g")).alias(f"{x}_found") for x in ("edited", "next")],
        *[failed_in(f"{x}_g").alias(f"{x}_failed") for x in ("edited", "next")],
    )
    return written(out, "sketches")


def op8_bloom(spark, sf_dir: str) -> DataFrame:
    """Likeness is the share of all digests that two texts have in common, 1 for two empty
    ones. Repeated rows are rows of their own; null text is empty; a table of one row is its
    own next, an empty one gives an empty result."""
    v = fingerprint_versions(read(spark, sf_dir, "documents").select("doc_id", "text"))
    versions = F.array(*[F.struct(F.lit(x).alias("i"), F.col(f"{x}_failed").alias("failed")) for x in ("edited", "next")])
    failed = v.select("id", F.explode(versions).alias("v")).filter("size(v.failed) > 0")
    failed = failed.select(F.struct("id", "v.i").alias("id"), "v.failed")
    late = reduce(DataFrame.unionByName, remaining(failed, F.size), v.select(F.struct("id", F.lit("").alias("i")).alias("id"), F.lit(0).alias("found")).filter("false"))
    late = late.groupBy("id.id").agg(*[F.sum(F.when(F.col("id.i") == x, F.col("found"))).alias(f"{x}_late") for x in ("edited", "next")])

    def near(x: str) -> Column:
        total = F.col(f"{x}_all")
        return F.when(total == 0, F.lit(1.0)).otherwise((total - F.col(f"{x}_found") - F.coalesce(f"{x}_late", F.lit(0))) / total)

    return v.join(late, "id", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        sketch_string("own_cells").alias("fingerprint"),
        sketch_string("edit_cells").alias("edited_fingerprint"),
        near("edited").alias("near_edited"),
        near("next").alias("near_next"),
    )
