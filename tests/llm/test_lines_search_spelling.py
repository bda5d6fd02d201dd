"""Line dedup, ranked lexical search and spelling variants against brute force, on odd tables:
nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wxspark.llm import lines, search, spelling

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def rows():
    g = random.Random(3)
    words = [a + b + c for a in ("tha", "ber", "é", "So") for b in ("ran", "rin", "lo") for c in ("ded", "d", "ding")]
    line = lambda n: " ".join(g.choice(words) for _ in range(n))
    shared = ["A line that many hold", "  a LINE that many hold\t", "short", "Über die Grenze hinaus", "über die Grenze hinaus"]
    out = [(1, ""), (2, None), (3, " \t\n\n"), (4, "twice the same row\nand more of it"), (4, "twice the same row\nand more of it")]
    out += [(4, "twice the same row\nwith another text"), (None, "A line that many hold\nno id at all"), (None, "no id at all\nnor here, really"), (None, None)]
    for i in range(10, 150):
        own = [line(g.randrange(1, 12)) for _ in range(g.randrange(5))] + [g.choice(shared) for _ in range(g.randrange(3))]
        g.shuffle(own)
        out.append((i, "\n".join(own)))
    out.append((7, "\n".join(line(20) for _ in range(1500)) + "\nA line that many hold\nA line that many hold"))
    out.append((9, "日本語 日本語 \U0001f600 x9Y \x7f ÀÉ×÷ ß"))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(docs, *names):
    return docs.select("*", *[F.lit(-5).alias(n) for n in names])


def key(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))


def lines_by_hand(rows, length=10, documents=2):
    holders = defaultdict(set)
    for doc, text in rows:
        for x in (text or "").split("\n"):
            holders[key(x)].add(doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = []
        for x in all_lines:
            held = holders[key(x)]
            first = min((d for d in held if d is not None), default=None)
            if len(key(x)) < length or len(held) < documents or doc == first:
                kept.append(x)
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return Counter(out)


@pytest.mark.parametrize("documents", [2, 5])
def test_lines_match_brute_force(docs, rows, documents):
    got = lines.dedup_lines(docs, least_documents=documents).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    want = lines_by_hand(rows, documents=documents)
    assert Counter(map(tuple, got)) == want
    assert sum(n for _, _, n, _ in want.elements()) > 20


def test_lines_odd_tables(spark, docs, rows, empty):
    assert lines.dedup_lines(empty).count() == 0
    out = lines.dedup_lines(clashing(docs, "N_LINES", "kept", "line", "key", "n"))
    assert set(out.columns) == {"doc_id", "text", "line", "key", "n", "n_lines", "n_dropped", "kept"}
    assert Counter(tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", "kept").collect()) == lines_by_hand(rows)
    plan = lines.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_lines_query(spark, tmp_path, docs, rows):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r) for r in lines.op11_lines(spark, str(tmp_path)).collect())
    want = Counter()
    for (doc, n, gone, kept), times in lines_by_hand(rows).items():
        want[doc, n, gone, hashlib.sha256(kept.encode()).hexdigest()] += times
    assert got == want


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def search_by_hand(rows, items, k=10):
    docs = [(d, Counter(terms(t))) for d, t in rows]
    n = sum(bool(c) for _, c in docs)
    total = sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    queries = defaultdict(Counter)
    for item, text in items:
        queries[item].update(terms(text))
    out = {}
    for item, query in queries.items():
        scored = []
        for doc, c in docs:
            size = sum(c.values())
            m = 25 + (75 * size * n) // total if total else 0
            s = 0
            for t, times in query.items():
                if c[t]:
                    s += times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if s:
                scored.append((-s, doc is None, doc))
        for rank, (s, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out[item, rank] = (doc, -s)
    return out


@pytest.fixture(scope="module")
def items(rows):
    texts = [t for _, t in rows if t]
    return [(i, t[: 40 * i + 20]) for i, t in enumerate(texts[5:45])] + [(1, "tharanded again"), (None, "many hold"), (50, None), (51, "nowhereatall"), (52, "日本語 X9y x9y"), (53, "")]


@pytest.mark.parametrize("small", [True, False])
def test_search_matches_brute_force(spark, docs, rows, items, small, monkeypatch):
    if small:  # many shards, blocks and windows, several groups of queries
        for name, value in (("SHARD_DOCS", 16), ("BLOCK", 4), ("WINDOW", 8), ("QUERIES", 7)):
            monkeypatch.setattr(search, name, value)
    found = search.search(search.build_index(docs), spark.createDataFrame(items, "item_id bigint, text string"))
    got = {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in found.collect()}
    assert got == search_by_hand(rows, items)
    assert len(got) > 300


def test_search_bounds_spare_blocks():
    """Blocks that cannot reach the tenth score stay compressed, and nothing is lost by it."""
    import numpy as np

    g = random.Random(9)
    texts = [["common"] * g.randrange(1, 3) + ["filler"] * g.randrange(5, 60) + (["rare"] * 3 if i % 400 == 0 else []) for i in range(8000)]
    coded = {b"common": 0, b"filler": 1, b"rare": 2}
    batches = search.shard_rows(5, list(range(8000)), [np.array([coded[w.encode()] for w in t]) for t in texts], list(coded))
    by_term = {r["term"]: r for b in batches for r in b.to_pylist()}
    lengths = np.frombuffer(by_term[None]["data"], "<u4").astype(np.int64)
    impact = lambda tf, docs=None, lengths=None, own=lengths: 1_000_000_000 * tf // (1000 * tf + 8 * (own[docs] if docs is not None else lengths))
    lists = [(w, search.Postings(r["n"], r["blocks"], r["impacts"], r["data"], impact)) for w, r in ((3, by_term[b"common"]), (900, by_term[b"rare"]))]
    best, top = search.shard_top(lists, 8000, 10)
    scores = np.array([sum(w * int(impact(np.int64(t.count(x)), docs=i)) for w, x in ((3, "common"), (900, "rare")) if x in t) for i, t in enumerate(texts)])
    want = sorted(range(8000), key=lambda i: (-scores[i], i))[:10]
    assert best.tolist() == want and top.tolist() == scores[want].tolist()
    assert lists[0][1].open.sum() < len(lists[0][1].open)


def test_search_odd_tables(spark, docs, rows, items, empty):
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert search.search(search.build_index(empty), asked).count() == 0
    assert search.search(search.build_index(docs), empty.withColumnRenamed("doc_id", "item_id")).count() == 0
    names = ("term", "shard", "q", "rank", "score", "w", "n")
    found = search.search(search.build_index(clashing(docs, *names)), clashing(asked, "own", *names))
    assert {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in found.collect()} == search_by_hand(rows, items)


def spelling_by_hand(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if a == b or len(b) - len(a) > 1:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
        return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]

    by = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w, xs in by.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(by[w]), n[form[w]] if form[w] else None) for w in n}


def found_by_spark(docs):
    out = spelling.spelling_variants(docs).collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in out}
    assert len(got) == len(out)
    return got


def test_spelling_matches_brute_force(spark, docs, rows):
    g = random.Random(4)
    long = "".join(g.choice("abcdé") for _ in range(70))
    more = [long, long[:20] + long[21:], long[:-1] + "q", "x" + long, long[:48], long[:49], long[:47], "a" * 90, "a" * 91, "q" * 5000, "q" * 5001, "q" * 2500 + "r" + "q" * 2499]
    stem = [["aaaaa", "aaaab"], ["aaaaaa", "abaaa"], ["aabaa"], ["bbbbb", "baaaa", "ééééé", "éééé", "éééée"]]
    texts = [(1000 + i, " ".join([w] * (3 + 5 * i))) for i, ws in enumerate(stem) for w in ws] + [(2000 + i, f"{w} {w}, {w.upper()};{w}") for i, w in enumerate(more)]
    texts += [(3000, "ccccc " * 3), (3001, "ccccd " * 9), (3002, "cccdd " * 30)]
    every = rows + texts
    want = spelling_by_hand(every)
    assert found_by_spark(spark.createDataFrame(every, SCHEMA).repartition(3)) == want
    assert sum(v[0] is not None for v in want.values()) > 5 and want["ccccc"][:2] == ("ccccd", "cccdd")
    assert want["q" * 5000][3] == 2 and want[long[:48]][3] == 2


def test_spelling_odd_tables(spark, docs, rows, empty):
    assert spelling.spelling_variants(empty).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (None, ""), (2, "ab ab ab")], SCHEMA)).count() == 0
    assert found_by_spark(clashing(docs, "word", "n", "node", "depth")) == spelling_by_hand(rows)
