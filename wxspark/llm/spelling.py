"""Spelling variants: words at one inserted, deleted or replaced code point, by a relational
trie frontier.

The vocabulary is a trie whose edges are rows: node (the hash of a prefix), letter, the
letter after it or the word's end, child. A state (word, pos, node, edits) stands at a node
of the trie and a position of its word. At each level of the trie, states join the edges of
their nodes: without an edit so far, an edge may replace the next letter or be one more
letter; with one edit, it must be the next letter. A state lives on only if the letter after
the edge is the next one that it needs; where edge and word end, the edge's word is a
neighbour.

Only larger letters replace, and only edges' words are longer, as each pair is wanted once.
Of two neighbours, one half of the word is untouched: every word walks a trie of words and
one of reversed words, starts half-way down its own path and edits only from there on. Near
the root, where all words meet, there are no states, so no node is hot for it. Tries are
kept from half-way down too, and written in order of depth, so that a level reads its own.

Words of more than ``LEVELS`` code points would need as many levels. They meet in another
exact way, by hashes of what stays of a word without one of its code points.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import read, written

RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH, LEAST_COUNT, SLIP, FACTOR = 5, 3, 97, 2
#: Longest word that walks the trie; distinct words that a task counts before it emits them;
#: code points of a text that are split at once.
LEVELS, KEPT, CHUNK = 48, 1 << 19, 1 << 22
KID = "struct(letter, after, child, ends, ends_n)"


def runs(text: str | None) -> Counter:
    """The maximal runs of letters, A-Z lower-cased, and how often each occurs."""
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    if len(low) <= CHUNK:
        return Counter(RUN.findall(low))
    return Counter(m.group() for m in RUN.finditer(low))


def slipped(word: str, start: int) -> str:
    """``word``, or the word less a code point where its checksum says so. ``start`` is the
    checksum of the ``<doc_id>:`` before it."""
    h = zlib.crc32(word.encode("utf-8"), start)
    if h % SLIP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(doc_id, text, ...) to (word, n): all words of whole texts with their occurrences. A
    null doc_id is written as nothing before the colon. A task counts words of its own
    documents beforehand, so a word that is everywhere is one row a task."""

    def count(batches):
        total: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in runs(text.as_py()).items():
                    if len(word) >= least_length:
                        word = slipped(word, start)
                        if len(word) >= least_length:
                            total[word] += n
                if len(total) >= KEPT:
                    yield rows()
                    total.clear()
        yield rows()

    counts = docs.select("doc_id", "text").mapInArrow(count, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def both_ways(words: DataFrame) -> DataFrame:
    """(way, x, n): every word (way 0) and its reverse (way 1), with its length."""
    ways = F.array(F.struct(F.lit(0).alias("way"), F.col("word").alias("x")), F.struct(F.lit(1).alias("way"), F.reverse("word").alias("x")))
    return words.select(F.explode(ways).alias("w"), "n").select("w.way", "w.x", "n", F.length("w.x").alias("len"))


def node(x: str, depth: Column | str) -> Column:
    return F.xxhash64("way", F.substr(x, F.lit(1), depth if isinstance(depth, Column) else F.col(depth)))


def letter(x: str, at: Column) -> Column:
    """The code point at ``at`` (from 0), empty after the last."""
    return F.substr(x, at + 1, F.lit(1))


def trie(words: DataFrame) -> DataFrame:
    """(depth, node, kids): written, ordered by depth. A word's edges begin where a word one
    letter shorter may begin to differ, or a word of its length."""
    d = F.col("depth")
    begin = F.floor((F.col("len") - 1 + F.col("way")) / 2).cast("int")
    edges = both_ways(words).select("way", "x", "n", F.explode(F.sequence(begin, F.col("len") - 1)).alias("depth"))
    edges = edges.select("depth", node("x", "depth").alias("node"), letter("x", d).alias("letter"), letter("x", d + 1).alias("after"), node("x", d + 1).alias("child"), "x", "n")
    end = F.col("after") == ""
    edges = edges.select("depth", "node", "letter", "after", "child", F.when(end, F.col("x")).alias("ends"), F.when(end, F.col("n")).alias("ends_n"))
    nodes = edges.repartitionByRange("depth", "node").groupBy("depth", "node").agg(F.collect_set(F.expr(KID)).alias("kids"))
    return written(nodes, "trie", by="depth")


def step(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """States (way, x, n, pos, node, edits) over the edges of their nodes: the states after
    it, one edit made; those with ``ends`` have found this word."""
    at, after = letter("x", F.col("pos")), letter("x", F.col("pos") + 1)
    met = states.withColumn("at", at).withColumn("after", after).join(nodes, "node")
    fresh = F.col("edits") == 0

    def replaced(k):
        other = F.when(fresh, (F.col("at") != "") & (k["letter"] > F.col("at"))).otherwise(k["letter"] == F.col("at"))
        return (k["after"] == F.col("after")) & other

    def longer(k):
        return fresh & (k["after"] == F.col("at")) & (k["letter"] != F.col("at"))

    def moved(k, by):
        return F.struct((F.col("pos") + by).alias("pos"), k["child"].alias("node"), k["ends"].alias("ends"), k["ends_n"].alias("ends_n"))

    hits = F.concat(
        F.transform(F.filter("kids", replaced), lambda k: moved(k, 1)),
        F.transform(F.filter("kids", longer), lambda k: moved(k, 0)),
    )
    return met.select("way", "x", "n", F.explode(hits).alias("k")).select("way", "x", "n", "k.*", F.lit(1).alias("edits"))


def trie_neighbours(words: DataFrame) -> DataFrame:
    """(word, n) of at most LEVELS code points to pairs (a, n_a, b, n_b), some twice."""
    low, high = words.agg(F.min(F.length("word")), F.max(F.length("word"))).first()
    none = words.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("word").alias("b"), F.col("n").alias("n_b")).filter(F.lit(False))
    if low is None:
        return none
    nodes, ways, found, carried = trie(words), both_ways(words), [], None
    for depth in range(low // 2, high + 1):
        begins = F.floor((F.col("len") + F.col("way")) / 2)
        states = ways.filter((begins <= depth) & (F.col("len") >= depth)).select("way", "x", "n", F.lit(depth).alias("pos"), node("x", F.lit(depth)).alias("node"), F.lit(0).alias("edits"))
        if carried is not None:
            states = states.unionByName(carried)
        moved = written(step(states, nodes.filter(F.col("depth") == depth).select("node", "kids")), "frontier")
        carried = moved.filter("ends is null").select("way", "x", "n", "pos", "node", "edits")
        found.append(moved)
    back = lambda c: F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c))
    return reduce(DataFrame.union, found).filter("ends is not null").select(back("x").alias("a"), F.col("n").alias("n_a"), back("ends").alias("b"), F.col("ends_n").alias("n_b"))


def remainders(word: str) -> list[tuple[int, int]]:
    """(position, hash of the word without that code point) for each, and (-1, hash of the
    word): polynomials over a prime, put together from both sides."""
    prime, base = (1 << 61) - 1, 1_000_003
    codes = [ord(c) + 1 for c in word]
    before, after, power = [0], [0], [1]
    for c in codes:
        before.append((before[-1] * base + c) % prime)
        power.append(power[-1] * base % prime)
    for i, c in enumerate(reversed(codes)):
        after.append((c * power[i] + after[-1]) % prime)
    n = len(codes)
    return [(-1, before[n])] + [(i, (before[i] * power[n - 1 - i] + after[n - 1 - i]) % prime) for i in range(n)]


def long_neighbours(words: DataFrame) -> DataFrame:
    """(word, n) to pairs (a, n_a, b, n_b), some twice: words whose remainders without the
    same code point agree, and words that are another's remainder. A row for each code
    point, and candidates for neighbours alone, but for hashes that meet by chance."""

    def rows(batches):
        for b in batches:
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = remainders(word)
                for i in range(0, len(own), 1 << 14):
                    part = own[i : i + (1 << 14)]
                    columns = [pa.array([v] * len(part), k) for v, k in ((word, pa.string()), (n, pa.int64()))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([p for p, _ in part], pa.int32()), pa.array([h for _, h in part], pa.int64())], ["word", "n", "at", "h"])

    # Words are told apart by a hash while they are joined, and fetched for the pairs alone.
    own = words.withColumn("id", F.xxhash64("word"))
    keys = words.select("word", "n").mapInArrow(rows, "word string, n bigint, at int, h bigint").select(F.xxhash64("word").alias("id"), F.length("word").alias("len"), "at", "h")
    keys = written(keys, "remainders")
    x, y = keys.alias("x"), keys.alias("y")
    same = x.filter("at >= 0").join(y.filter("at >= 0"), (F.col("x.h") == F.col("y.h")) & (F.col("x.at") == F.col("y.at")) & (F.col("x.len") == F.col("y.len")) & (F.col("x.id") < F.col("y.id")))
    less = x.filter("at = -1").join(y.filter("at >= 0"), (F.col("x.h") == F.col("y.h")) & (F.col("x.len") + 1 == F.col("y.len")))
    ids = same.select(F.col("x.id").alias("ia"), F.col("y.id").alias("ib")).union(less.select("x.id", "y.id")).distinct()
    a = own.select(F.col("id").alias("ia"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    b = own.select(F.col("id").alias("ib"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    return ids.join(a, "ia").join(b, "ib").select("a", "n_a", "b", "n_b")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n), distinct words, to (word, n, near, near_n): both ways round, once each."""
    size = F.length("word")
    pairs = trie_neighbours(words.filter(size <= LEVELS))
    if words.filter(size > LEVELS).limit(1).count():
        pairs = pairs.union(long_neighbours(words.filter(size >= LEVELS)))
    # Node hashes and remainders may meet by chance: exact, on neighbours alone.
    pairs = pairs.filter(F.levenshtein("a", "b", 1) == 1)
    two = F.array(
        F.struct(F.col("a").alias("word"), F.col("n_a").alias("n"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("n_b").alias("n"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    return pairs.select(F.explode(two).alias("p")).select("p.*").dropDuplicates(["word", "near"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) to (word, root): the last of the forms that follow each other. A form is
    twice as frequent, so there are few; each round doubles the steps taken."""
    at, known = written(forms.select("word", F.col("form").alias("root")), "roots"), None
    while True:
        mark = at.agg(F.coalesce(F.bit_xor(F.xxhash64("word", "root")), F.lit(0))).first()[0]
        if mark == known:
            return at
        known = mark
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = written(at.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``docs`` (doc_id, text, ...) to (word, n, n_near, form, form_n, root), a row for each
    word. Null and empty texts have no words; rows with one doc_id and text each count; of
    neighbours with the largest n the smallest in code-point order is the form. An empty
    table gives an empty one. Other columns are not read."""
    words = written(vocabulary(docs, least_length, least_count), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form")))
    near = neighbours(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    near = words.join(near, "word", "left").withColumn("takes", -F.col("best.m") >= FACTOR * F.col("n"))
    near = near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("takes"), F.col("best.form")).alias("form"), F.when(F.col("takes"), -F.col("best.m")).alias("form_n"))
    near = written(near, "forms")
    last = roots(near.filter("form is not null").select("word", "form"))
    return near.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents),
g AS (SELECT doc_id, w, count(*) AS n FROM r GROUP BY ALL),
h AS (
  SELECT w, n, xor(4294967295, list_reduce(
      list_concat([4294967295], flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda s:
        CASE WHEN unicode(s) < 128 THEN [unicode(s)::BIGINT] ELSE [195, (unicode(s) - 64)::BIGINT] END))),
      lambda c, b: xor(t.t[(xor(c, b) & 255) + 1], c >> 8))) AS h
  FROM g, t),
s AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
k AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (
  SELECT a.word, b.word AS near FROM k a JOIN k b ON a.k = b.k AND a.i = b.i AND a.word <> b.word
  UNION SELECT k.word, v.word FROM k JOIN v ON k.k = v.word
  UNION SELECT v.word, k.word FROM k JOIN v ON k.k = v.word),
b AS (
  SELECT p.word, p.near, y.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY y.n DESC, p.near) AS place
  FROM p JOIN v y ON p.near = y.word),
f AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 2 * v.n THEN b.near END AS form,
         CASE WHEN b.near_n >= 2 * v.n THEN b.near_n END AS form_n
  FROM v LEFT JOIN b ON v.word = b.word AND b.place = 1),
u AS (
  SELECT word, word AS root, 0 AS far FROM f
  UNION ALL SELECT u.word, f.form, u.far + 1 FROM u JOIN f ON u.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(u.root, u.far) AS root, f.n, f.n_near, f.form_n
FROM f JOIN u ON f.word = u.word GROUP BY f.word, f.form, f.n, f.n_near, f.form_n
"""
