"""The training-data operators: DuckDB twins, brute force, round trips, held-out accuracy,
and odd tables (nulls, empty and long texts, ties, repeated rows, clashing columns)."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from wxspark.llm import bloom, chat, components, language, mixing, neighbours, ngrams, packing, quality, queries, rans, simhash, tokens, toxicity
from wxspark.llm.common import written

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0) for i, t, lang, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, an empty text, blanks, ties, repeated rows, a long text."""
    g = random.Random(1)
    long = "\n".join(" ".join(g.choice("the of and to in is that it".split()) + str(g.randrange(99)) for _ in range(40)) for _ in range(300))
    rows = [(1, "", "en", "a"), (2, None, "en", "a"), (3, " \t\n", None, "b"), (4, "same text here", "fr", None), (4, "same text here", "fr", None)]
    rows += [(None, "no id at all", "de", "b"), (None, None, None, None), (7, long, "en", "c"), (8, long, "en", "c"), (9, "é ß ñ 日本 \U0001f600 </s> [INST] <|endoftext|>", "es", "c")]
    return docs_of(spark, rows), rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    ours, theirs = queries.QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(queries.ORACLE[name]).df()
    cols = sorted(ours.columns)
    assert cols == sorted(theirs.columns)
    tidy = lambda d: d[cols].sort_values(cols).reset_index(drop=True)
    assert tidy(ours).equals(tidy(theirs))


def test_mixing_shares_and_repeats(spark, odd, empty):
    rows = [(i, "w " * (1 + i % 7), "en", "abc"[i % 3] if i % 40 else None) for i in range(400)]
    d = mixing.mix_sources(docs_of(spark, rows).withColumn("Size", F.lit("clash"))).toPandas()
    total = d["size"].sum()
    assert len(d) == 400 and total - d["taken"].sum() < 10 and (d["taken"] <= 3 * d["size"]).all()
    by = d.assign(s=d["source"].fillna("~")).groupby("s").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"))
    assert (abs(by["taken"] - by["target"]) <= 21).all() and (by["target"] <= 3 * by["size"]).all()
    assert mixing.mix_sources(odd[0]).count() == len(odd[1]) and mixing.mix_sources(empty).count() == 0


def brute_simhash(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    bits = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


def test_simhash_against_brute_force(spark, odd):
    g = random.Random(5)
    base = " ".join(f"w{g.randrange(500)}" for _ in range(150)).split()
    rows = list(odd[1]) + [(100 + i, " ".join(base[:i] + ["x"] + base[i + 1 :]), "en", "a") for i in range(60)]
    rows += [(300 + i, " ".join(f"v{g.randrange(999)}" for _ in range(30)), "en", "a") for i in range(40)]
    prints = [brute_simhash(t) for _, t, _, _ in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    root[a] = root[b] = min(root[a], root[b])
    least = {}
    for r, (i, *_) in zip(root, rows, strict=True):
        least.setdefault(r, []).append(i)
    want = Counter((i, f"{p:016x}", min((x for x in least[r] if x is not None), default=None)) for (i, *_), p, r in zip(rows, prints, root, strict=True))
    d = docs_of(spark, rows)
    assert Counter(tuple(r) for r in simhash.near_duplicates(d).collect()) == want
    kept = simhash.one_of_each(d.withColumn("component_id", F.lit(0)))
    assert kept.count() == len(least) and kept.columns == [*d.columns, "component_id"]


def test_block_split_keeps_components(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 3)
    f = [i for i in range(64)] + [1 << 40, 3 << 40]
    edges = simhash.link_edges(spark.createDataFrame([(x,) for x in f], "f bigint"))
    roots = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
    assert set(roots) | {0} == set(f) and set(roots.values()) == {0}


def test_hot_half_links_like_all_pairs(spark, monkeypatch):
    """Many fingerprints that share a half, among them chains of links at three bits."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    g = random.Random(9)
    flipped = lambda x, n, bits: x ^ sum(1 << b for b in g.sample(bits, n))
    f = {0xDEADBEEF << 32 | g.getrandbits(32) for _ in range(60)} | {g.getrandbits(32) << 32 | 0xCAFE for _ in range(60)}
    for x in sorted(f)[:50]:
        f |= {flipped(x, 3, range(64)), flipped(x, 2, range(32)), flipped(x, 3, range(16, 32)), flipped(x, 4, range(64))}
    f = sorted(f)
    root = {x: x for x in f}
    for _ in f:
        before = dict(root)
        for a in f:
            root[a] = min(root[b] for b in f if (a ^ b).bit_count() <= 3)
        if root == before:
            break
    edges = simhash.link_edges(spark.createDataFrame([(simhash._signed(x),) for x in f], "f bigint"))
    got = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
    groups = lambda label: sorted(sorted(x for x in f if label(x) == r) for r in {label(x) for x in f})
    assert groups(root.get) == groups(lambda x: got.get(simhash._signed(x), simhash._signed(x)))


def test_learning_samples_are_bounded(spark):
    """An id that repeats brings no more rows than the sample, copies count once."""
    rows = [(1, f"text number {i} of one id", "en", "a") for i in range(50)] + [(2, "un deux trois", "fr", "a")] * 9 + [(None, "no id", "en", "a")]
    d = docs_of(spark, rows).select("doc_id", "text", "lang")
    got = language.first_documents(d, 5).groupBy("lang").count().collect()
    assert {tuple(r) for r in got} == {("en", 5), ("fr", 1)}
    everything = language.first_documents(d, 100)
    assert everything.count() == 52 and everything.columns == ["doc_id", "text", "lang"]
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (7, 1)], "doc_id bigint, quality int")
    got = neighbours.labelled(d, labels, "quality", 100)
    assert got.count() == 51 and got.filter("doc_id = 2").count() == 1
    assert neighbours.labelled(d, labels, "quality", 4).count() == 4


def test_language_held_out(spark, odd, empty):
    got = language.op3_language(spark, SF_SMALL)
    lang = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    held = got.join(lang, "doc_id").filter("held_out").toPandas()
    assert (held["lang"] == held["lang_pred"]).mean() > 0.95 and held["score"].between(0, 1).all()
    out = language.identify(odd[0], language.learn(odd[0])).collect()
    assert len(out) == len(odd[1]) and all(r["lang_pred"] == "und" and r["rejected"] for r in out if not (r["text"] or "").strip())
    assert {r["lang_pred"] for r in language.identify(odd[0], language.learn(empty)).collect()} == {"und"}


def test_long_text_in_pieces(monkeypatch):
    texts = [b"abcabd" * 300, b"x"]
    whole = ngrams.hashed_counts(texts, 256, (1, 2, 3))
    monkeypatch.setattr(ngrams, "BYTES", 100)
    assert (ngrams.hashed_counts(texts, 256, (1, 2, 3)) == whole).all()


def test_chat_folds_events_and_reads_back(spark):
    log = [
        (1, 1, "message", 0, "user", "hi"), (1, 2, "message", 1, "assistant", "a"), (1, 3, "delta", 1, None, "b"), (1, 4, "regenerate", 1, None, None),
        (1, 5, "delta", 1, None, "c</s>"), (1, 6, "delta", 1, None, r"<\s>"), (1, 7, "message", 2, "user", "q"), (1, 8, "message", 3, "assistant", "old"),
        (1, 9, "edit", 2, None, "[INST]q2"), (1, 10, "regenerate", 1, None, "z"), (2, 1, "message", 0, "sys\ntem", None), (None, None, None, None, None, None),
    ]
    random.Random(2).shuffle(log)
    out = chat.parse_chats(chat.format_chats(spark.createDataFrame(log, "conv_id long, seq long, kind string, turn long, role string, text string")))
    got = {r["conv_id"]: ([tuple(t) for t in r["turns"]], r["loss_text"]) for r in out.collect()}
    assert got == {1: ([("user", "hi"), ("assistant", "z")], "z"), 2: ([("sys\ntem", "")], ""), None: ([("", "")], "")}
    texts = ["</s>", r"<\/s>", r"[\\INST] <s", "", "a\nb"]
    rows = [(5, i, "assistant", t) for i, t in enumerate(texts)] + [(5, 2, "assistant", texts[2])]
    r = chat.parse_chats(chat.format_chats(chat.turns_as_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).first()
    assert [t["text"] for t in r["turns"]] == texts[:3] + texts[2:] and r["formatted"].count("</s>") == 6


def test_quality_counts_and_verdict(spark, odd, empty):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    d = d.unionByName(odd[0]).withColumn("kept", F.lit("clash"))
    out = quality.quality_rules(d).collect()
    assert len(out) == d.count() and not any(r["kept"] for r in out if r["base_failed"])
    for r in out:
        text = r["text"] or ""
        w, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        n = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {j for i in range(len(w) - 4) if n[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
    assert quality.quality_rules(d).filter("kept").count() == sum(r["kept"] for r in out)
    assert quality.quality_rules(empty).count() == 0


def test_divergence_against_numpy(spark):
    p, refs = np.array([3, 0, 5, 2]), [[0.1, 0.4, 0.3, 0.2], [0.25, 0.25, 0.5, 0.0]]

    def distance(q):
        a, q = p / p.sum(), np.array(q)
        m = (a + q) / 2
        return np.sqrt(sum((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum() for x in (a, q)) / 2)

    got = spark.range(1).select(F.array(*[F.lit(int(x)).cast("long") for x in p]).alias("c")).select(quality.divergence("c", refs)).first()[0]
    assert got == pytest.approx(min(map(distance, refs)))


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def ids_of(tokenizer, text, end):
    from tokenizers import Tokenizer

    return np.array([*Tokenizer.from_file(tokenizer).encode(text or "", add_special_tokens=False).ids, end], "<u4")


TEXTS = ["", " ", "a  b", "a   b", "\n a", "x\n \ny z", "foo\n bar\t baz ", " lead", "é ß 日本 \U0001f600", "don't  stop", "a <|endoftext|> b", "x  y"]


def test_encoder_is_the_tokenizer(tokenizer, monkeypatch):
    import pyarrow as pa

    texts = [*TEXTS, None, "", " ", "\n", " lead", "trail ", "a\n b", "Été, été. ñandú; x9, don't won't.", "w" * 100 + " " + "w" * 100, "a  b   c", "été\u00a0été \u2003 x"] * 2
    for kept in (tokens.KEPT_WORDS, 3):  # the second starts anew all the time
        monkeypatch.setattr(tokens, "KEPT_WORDS", kept)
        model = tokens.Encoder(tokenizer)
        for _ in range(2):
            ids, sizes = model.encode(pa.array(texts, pa.string()), 9)
            want = [np.append(ids_of(tokenizer, t, 0)[:-1], 9) for t in texts]
            assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == np.concatenate(want).tolist()


def test_token_file_round_trip(spark, odd, empty, tokenizer, monkeypatch):
    monkeypatch.setattr(rans, "PART", 3000)
    blocks, tables = rans.write_ids(written(tokens.tokenized(odd[0], tokenizer, 2), "ids"))
    got = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in rans.read_ids(blocks, tables).orderBy("start").collect()]
    want = Counter((i, ids_of(tokenizer, t, 2).tobytes()) for i, t, _, _ in odd[1])
    assert Counter((i, x) for i, _, x in got) == want
    assert [s for _, s, _ in got] == np.cumsum([0, *[len(x) // 4 for _, _, x in got]])[:-1].tolist()
    assert [i for i, _, _ in got] == sorted((i for i, _, _ in got), key=lambda i: (i is not None, i))
    bad = blocks.withColumn("words", F.overlay("words", F.unhex(F.lit("00FF00FF")), F.lit(9)))
    with pytest.raises(Exception, match="damaged"):
        rans.read_ids(bad, tables).collect()
    assert rans.read_ids(*rans.write_ids(written(tokens.tokenized(empty, tokenizer, 2), "ids"))).count() == 0


def test_coder_on_skewed_ids():
    g = np.random.default_rng(3)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        ids = np.minimum(g.geometric(0.3, n) * 7, 60_000).astype("<u4")
        coder = rans.Coder(rans.frequencies(dict(Counter(ids.tolist()))))
        states, words = coder.encode(ids)
        assert (coder.decode(states, words, n) == ids).all()
    f = rans.frequencies({i: 1 + (i == 0) * 10**9 for i in range(50_000)})
    assert sum(f.values()) == 1 << rans.PRECISION and min(f.values()) == 1


def test_packing(spark, odd, empty, tokenizer):
    out = packing.pack_documents(odd[0], tokenizer, 0, capacity=64).toPandas()
    assert sorted(out.groupby("sequence_id")["length"].sum())[-1] <= 64
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id")["length"].cumsum() - out["length"] == out["offset"]).all()
    assert out["length"].sum() == sum(len(ids_of(tokenizer, t, 0)) for _, t, _, _ in odd[1])
    assert packing.pack_documents(empty, tokenizer, 0).count() == 0


def test_pieces_are_the_tokens(spark, tokenizer, tmp_path):
    """op7 over whole tables against plain tokenization, and its number of sequences against
    the least that the tokens need."""
    g = random.Random(8)
    rows = [(i, " ".join(g.choice(["the", "of", "été,", "x9"]) + str(g.randrange(50)) for _ in range(g.choice([3, 40, 700, 900, 2500])))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "a b"), (62, "a b"), (62, "another text"), (None, "no id"), (63, "z" * 9000)]
    spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("piece", F.lit(-1)).write.parquet(str(tmp_path / "documents.parquet"))
    out = packing.op7_packing(spark, str(tmp_path)).toPandas()
    want, total = Counter(), 0
    for doc, text in rows:
        ids = ids_of(tokenizer, text, 0)
        total += len(ids)
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        for k, (s, e) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[doc, k, s, e - s, zlib.crc32(ids[s:e].astype("<u4").tobytes())] += 1
    got = out.astype(object).where(out.notna(), None)[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)
    assert Counter(tuple(None if v is None else int(v) for v in r) for r in got) == want
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.groupby("sequence_id")["length"].cumsum() - out["length"] == out["offset"]).all()
    assert out.groupby("sequence_id")["length"].sum().max() <= 2048
    assert out["sequence_id"].nunique() <= -(-total // 2048) + 3


def test_plan_places_every_piece_once():
    g = random.Random(4)
    for _ in range(30):
        counts = Counter(g.choice([g.randrange(1, 101), 34, 50, 100, 3]) for _ in range(g.randrange(1, 400)))
        used, fill = Counter(), Counter()
        for n, rank, k, seq, off, many in packing.packing_plan(dict(counts), 100):
            assert rank == used[n]
            used[n] += many
            for i in range(many):
                fill[seq + i // k] += n
                assert off + (i % k) * n + n <= 100
        assert used == counts and max(fill.values()) <= 100
        large = sum(c for n, c in counts.items() if 3 * n > 100)
        assert len(fill) <= max(large, 1) + sum(n * c for n, c in counts.items()) // 60 + 1


def test_bloom_likeness(spark, odd, empty):
    rows = [r for r in odd[1] if r[0] is not None]
    path = f"{written(docs_of(spark, rows), 'docs').inputFiles()[0].rsplit('/', 1)[0]}"
    d = bloom.with_next(spark.read.parquet(path)).collect()
    order = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or ""))
    follow = Counter((a[0], a[1], b[1] or "") for a, b in zip(order, order[1:] + order[:1], strict=True))
    assert Counter((r["doc_id"], r["text"], r["next_text"]) for r in d) == follow
    assert bloom.with_next(odd[0]).count() == len(odd[1]) and bloom.with_next(empty).count() == 0


def test_bloom_edited_is_nearer_than_next(spark, tmp_dir):
    g = random.Random(9)
    line = lambda n: " ".join("".join(g.choice("abcdeimnost") for _ in range(6)) for _ in range(n))
    again = "one and the same line"
    texts = [line(15), line(25), line(60), f"{line(10)}\n" * 40, "\n".join([again] * 9), "\n".join([again] * 8), "", None, "\n".join(line(g.randrange(60)) for _ in range(700)), line(9000), "\n"]
    path = f"{tmp_dir}/documents.parquet"
    docs_of(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).write.parquet(path)

    first = re.compile(r"[^\n]{30,46}?[aeiou.,;:!?] |[^\n]{30,47} |[^\n]{1,48}")
    later = re.compile(r"[^\n]{90,158}?[aeiou.,;:!?] |[^\n]{90,159} |[^\n]{1,160}")

    def pieces(t):
        out = Counter()
        for x in t.split("\n"):
            if x:
                head = first.match(x).group()
                out.update([head, *later.findall(x[len(head) :])])
        return out

    def near(a, b):
        a, b = pieces(a), pieces(b)
        return 2 * (a & b).total() / (a + b).total() if a or b else 1.0

    for r in bloom.op8_bloom(spark, tmp_dir).collect():
        text, after = texts[r["doc_id"]] or "", texts[r["doc_id"] - 1] or ""
        assert r["n_chars"] == len(text) and (r["fingerprint"] == r["edited_fingerprint"]) == (pieces(text) == pieces(text[: len(text) - len(text) // 2] + after[: len(text) // 2]))
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["near_edited"], r["near_next"]) == pytest.approx((near(text, edited), near(text, after)))
        assert len(text) < 100 or r["near_edited"] > max(0, r["near_next"]) or r["doc_id"] == 5
    assert near(texts[4], texts[5]) > 0.9
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_dir}/none/documents.parquet")
    assert bloom.op8_bloom(spark, f"{tmp_dir}/none").count() == 0
    docs_of(spark, [(None, "x" * 50, "en", "a")]).select("*", F.lit(1).alias("own"), F.lit(2).alias("n_chars_")).write.parquet(f"{tmp_dir}/one/documents.parquet")
    assert [r["near_next"] for r in bloom.op8_bloom(spark, f"{tmp_dir}/one").collect()] == [1.0]


def test_bloom_recovers_differences(spark):
    g = random.Random(6)
    sets = [(i, sorted(g.sample(range(10**6), a)), sorted(g.sample(range(10**6), b))) for i, (a, b) in enumerate([(0, 0), (1, 0), (3, 3), (30, 40), (400, 500), (0, 900), (7000, 8000)])]
    sets.append((9, list(range(200)), list(range(5, 205))))
    p = spark.createDataFrame(sets, "id long, a array<bigint>, b array<bigint>")
    p = p.withColumn("x", F.expr(bloom.sketch(bloom.entries("a")))).withColumn("y", F.expr(bloom.sketch(bloom.entries("b"))))
    got = {r["id"]: (r["only_a"], r["only_b"]) for r in bloom.differences(p.select("id", "a", "b", F.expr(bloom.less("x", "y")).alias("cells"))).collect()}
    for i, a, b in sets:
        assert got[i] == (sorted(set(a) - set(b)), sorted(set(b) - set(a)))


def test_classifiers_on_held_out(spark, odd, empty):
    sf = SF_SMALL.replace("0.001", "0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = neighbours.op9_neighbours(spark, sf).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.93 and got["score"].between(0, 1).all()
    got = toxicity.op10_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").toPandas()
    assert got["score"].between(0, 1).all()
    assert got[got["toxic"] == 1]["predicted"].mean() > 0.8 and got[got["toxic"] == 0]["predicted"].mean() < 0.06
    none = labels.limit(0)
    assert {r["score"] for r in neighbours.classify(odd[0], neighbours.learn(odd[0], none, "quality")).collect()} == {0.5}
    net = toxicity.learn(odd[0], none, "toxic")
    assert toxicity.classify(odd[0], net).filter("score < 0.5").count() == len(odd[1])


def test_leaning_words_of_few_documents():
    g = random.Random(8)
    plain = lambda: {f"w{g.randrange(400)}" for _ in range(30)}
    groups = [("idiot", 300), ("dummkopf", 9), ("cretin", 6)]
    toxic = [plain() | {word} for word, n in groups for _ in range(n)]
    harmless = [plain() for _ in range(1500)]
    got = toxicity.leaning(toxic + harmless, np.arange(len(toxic) + len(harmless)) < len(toxic))
    assert got == {word for word, _ in groups}
    assert toxicity.leaning(harmless, np.arange(len(harmless)) < 200) == set()


def test_special_words_go_first():
    """A word is not taken for everything that begins like it, and a family of words, none of
    which is frequent, is taken by its beginning."""
    g = random.Random(2)
    plain = lambda: {"".join(g.choice("aeioubdlst") for _ in range(5)) for _ in range(40)}
    toxic = [plain() | {"loser"} | ({"losado"} if i == 0 else set()) for i in range(12)]
    toxic += [plain() | {f"lowei{''.join(g.choice('aeiou') for _ in range(6))}" for _ in range(4)} for _ in range(5)]
    harmless = [plain() for _ in range(300)]
    got = toxicity.leaning(toxic + harmless, np.arange(317) < 17)
    assert got == {"loser", "lowei*"}
    net = toxicity.Network({"lowei*": 1, "word": 2})
    assert [net.row(w) for w in ("loweixyz", "lowei", "lowe", "word", "words")] == [1, 1, 0, 2, 0]


def test_sample_bounds(spark):
    """Repeated ids, and texts beyond the volume, stay out of the learning sample as rows."""
    rows = [(1, f"text number {i} of one id", "en", "a") for i in range(50)] + [(2, "scum " * 40, "en", "a"), (3, "x " * 5000, "en", "a"), (None, "scum", "en", "a")]
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (3, None), (None, 1), (9, 1)], "doc_id bigint, toxic int")
    seen = []
    real, toxicity.train, bound = toxicity.train, lambda rows: seen.append(rows), toxicity.SAMPLE_CHARS
    try:
        toxicity.SAMPLE_CHARS = 2000
        toxicity.learn(docs_of(spark, rows), labels, "toxic", sample=(7, 5))
    finally:
        toxicity.train, toxicity.SAMPLE_CHARS = real, bound
    assert set(seen[0]["doc_id"]) <= {1, 2} and 0 < (seen[0]["doc_id"] == 1).sum() <= 7 and (seen[0]["doc_id"] == 2).sum() == 1


def test_gradients():
    net = toxicity.Network({"a": 1, "bc": 2})
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    words, tok, lengths, order = toxicity.batch_of([["a", "bc", "zz"], ["q"], ["bc", "a"]])
    y = np.array([1.0, 0, 1])[order]

    def loss():
        gates, cache = net.inputs(words)
        logit, memory = net.forward(gates, tok, lengths, keep=True)
        return (np.log1p(np.exp(logit)) - y * logit).sum(), net.gradients(gates, cache, memory, toxicity.sigmoid(logit) - y)

    grads = loss()[1]
    for k, v in net.p.items():
        i = np.unravel_index(np.abs(grads[k]).argmax(), v.shape)
        at, v[i] = v[i], v[i] + 1e-4
        up, v[i] = loss()[0], at - 1e-4
        down, v[i] = loss()[0], at
        assert (up - down) / 2e-4 == pytest.approx(grads[k][i], rel=0.02, abs=1e-4)


def test_every_word_is_in_a_window():
    scorer = toxicity.Scorer(toxicity.Network({}))
    for n in (1, 95, 96, 97, 168, 169, 500):
        parts = toxicity.windows([str(i) for i in range(n)])
        assert {w for p in parts for w in p} == {str(i) for i in range(n)}
    assert scorer.scores([None, "", "word"])[:2].tolist() == [0.0, 0.0]


def test_stages_keep_what_they_should(spark):
    """Unlike texts under one id all stay, one row of each group of copies does, and every
    stage keeps the columns' values."""
    g = random.Random(12)
    text = lambda: " ".join(f"w{g.randrange(900)}" for _ in range(80))
    one, two, three, four = (text() for _ in range(4))
    near = next(t for t in (f"{one} w{i}" for i in range(10**4)) if (brute_simhash(one) ^ brute_simhash(t)).bit_count() <= 3)
    rows = [(5, one, "en", "a"), (5, two, "en", "b"), (5, three, None, "c"), (7, one, "fr", "a"), (3, two, "en", "a"), (None, four, "en", None), (None, four, "en", None), (8, three, "en", "a"), (8, three, "en", "a")]
    assert (brute_simhash(one) ^ brute_simhash(near)).bit_count() <= 3
    rows.append((4, near, "en", "z"))
    kept = corpus_pipeline.near_duplicates(spark, docs_of(spark, rows), SF_SMALL).collect()
    got = {(r["doc_id"], r["text"], r["lang"], r["source"]) for r in kept}
    assert len(kept) == 4 and got == {(4, near, "en", "z"), (3, two, "en", "a"), (5, three, None, "c"), (None, four, "en", None)}
    mixed = Counter(tuple(r) for r in corpus_pipeline.mix(spark, docs_of(spark, rows), SF_SMALL).collect())
    taken = Counter()
    for r in mixing.mix_sources(docs_of(spark, rows)).collect():
        taken[tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars"))] += r["passes"]
    assert mixed == +taken


def test_pipeline(spark, odd, empty):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").unionByName(odd[0]).withColumns({"kept": F.lit(1), "score": F.lit(2)})
    columns = d.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = written(stage(spark, d, SF_SMALL), "test-stage")
        assert d.columns == columns and d.count() > 50
    assert corpus_pipeline.STAGES[-1][1](spark, d, SF_SMALL).count() >= d.count()
    d = empty
    for _, stage in corpus_pipeline.STAGES:
        d = written(stage(spark, d, SF_SMALL), "test-stage")
        assert d.count() == 0
