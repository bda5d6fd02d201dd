"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A text is read in overlapping windows of words. A word's input is its own vector (one for
all words outside the vocabulary) and the mean vector of its byte triples and beginnings. Two gated
recurrent layers read a window, one from each end; attention weighs their states into one
vector, and a logistic unit scores it. A document has the score of its highest window.

Labels are of documents, so training goes in rounds. The first takes as toxic those windows
of toxic documents that hold a word, or a word's beginning, that leans to toxic documents
more than chance allows for the number of candidates; later ones also those that the network
itself scores over nearly all windows of the others. Windows of toxic documents that are not
taken teach nothing. Harmless windows are drawn by document, from the second round on half
of them among those that score highest. A leaning beginning is a word of the vocabulary: all
words that begin so have its vector. The network has the mean weights of the last round's
steps, and its level lies between harmless and seeded training documents.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import read, without
from wxspark.llm.language import held_out

WIDTH, STRIDE = 96, 72
WORD_DIMS, TRIPLE_DIMS, TRIPLES, HIDDEN = 16, 8, 8192, 8
#: Bytes of a word's beginnings, its mark included; letters of beginnings that may lean.
BEGINNINGS, LETTERS = (6, 8), range(3, 10)
#: Labelled documents, harmless and toxic, that training reads, at most (whole texts; the
#: first by a hash), code points of them all, at most (a text that no longer fits is not in
#: the sample), and words of the vocabulary, at most (the most frequent).
SAMPLE, SAMPLE_CHARS, VOCABULARY = (1800, 900), 1 << 26, 20_000
LEAST_COUNT, BATCH, RATE, DECAY, WORD_DROP = 5, 128, 0.01, 1e-3, 0.3
#: Steps of each round; share of harmless windows that a toxic one must exceed from the
#: second round on, and that of the harmless windows that are drawn again.
ROUNDS, ABOVE, HARD = (240, 120), 0.99, 0.9
#: How many times as frequent a leaning word is in toxic documents, how many of them hold
#: it, at least, for its number of documents and for its words to count, and the share of
#: its words that a more special one must cover to be taken in its place.
RATIO, LEAST_DOCS, LEAST_TOXIC, SPECIAL = 6, 3, 2, 0.75
#: Quantiles of the harmless and of the seeded documents between which the level lies.
LEVELS = (0.99, 0.25)
#: Words whose inputs a task keeps, windows scored together.
KEPT_WORDS, WINDOWS = 200_000, 2048
WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def windows(words: list[str]) -> list[list[str]]:
    """All windows: they overlap, and every word is in one; none for no words."""
    return [words[i : i + WIDTH] for i in range(0, max(1, len(words) - (WIDTH - STRIDE)), STRIDE)] if words else []


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words' byte triples and beginnings, ends marked, and where each word's
    begin."""
    coded = [b"\x02" + w.encode("utf-8", "surrogatepass") + b"\x03" for w in words]
    lengths = np.array([len(c) for c in coded])
    # Every word is followed by as many fillers as it has beginnings: its triples that touch
    # them give way to their hashes.
    data = np.frombuffer(b"".join(c + b"\x00" * (len(BEGINNINGS) - 2) for c in coded) + b"\x00\x00", np.uint8).astype(np.uint32)
    keys = ((data[:-2] * np.uint32(65599) + data[1:-1] * np.uint32(257) + data[2:]) * np.uint32(2654435761) >> np.uint32(19)).astype(np.int64)
    ends = np.cumsum(lengths + len(BEGINNINGS) - 2)
    for i, n in enumerate(BEGINNINGS):
        keys[ends - 1 - i] = [zlib.crc32(c[:n], n) % TRIPLES for c in coded]
    return keys[: ends[-1]], np.concatenate(([0], ends[:-1]))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """``vocabulary``: word to row of ``words``, from 1; row 0 is any other word."""

    def __init__(self, vocabulary: dict[str, int], seed: int = 7):
        g, inputs = np.random.default_rng(seed), WORD_DIMS + TRIPLE_DIMS
        normal = lambda *shape, s=1.0: (g.standard_normal(shape) * s).astype(np.float32)
        self.vocabulary = vocabulary
        self.starts = any(w.endswith("*") for w in vocabulary)
        self.p = {
            "words": normal(len(vocabulary) + 1, WORD_DIMS, s=0.3),
            "triples": normal(TRIPLES, TRIPLE_DIMS, s=0.3),
            "input": normal(2, inputs, 3 * HIDDEN, s=inputs**-0.5),
            "bias": np.zeros((2, 3 * HIDDEN), np.float32),
            "state": normal(2, HIDDEN, 3 * HIDDEN, s=HIDDEN**-0.5),
            "attend": normal(2 * HIDDEN, s=0.3),
            "out": normal(2 * HIDDEN, s=0.3),
            "shift": np.zeros(1, np.float32),
        }

    def row(self, word: str) -> int:
        """The row of the longest leaning beginning of the word, else its own."""
        for n in LETTERS[::-1] if self.starts else ():
            found = self.vocabulary.get(f"{word[:n]}*", 0) if len(word) >= n else 0
            if found:
                return found
        return self.vocabulary.get(word, 0)

    def inputs(self, words: list[str], rows: np.ndarray | None = None):
        """Each word's share in the gates, both ways: (2, words, 3 * HIDDEN); and what
        ``gradients`` needs of it."""
        if rows is None:
            rows = np.array([self.row(w) for w in words])
        keys, starts = triples(words)
        count = np.diff(np.append(starts, len(keys)))[:, None].astype(np.float32)
        x = np.hstack([self.p["words"][rows], np.add.reduceat(self.p["triples"][keys], starts) / count])
        return x @ self.p["input"] + self.p["bias"][:, None, :], (rows, keys, starts, count, x)

    def forward(self, gates: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Logits of windows, longest first: ``tokens`` (windows, steps) index ``gates``. Both
        layers step together, the second through windows turned round."""
        n, steps = tokens.shape
        h2, u, ways = 2 * HIDDEN, self.p["state"], np.arange(2)[:, None]
        active = (lengths[None, :] > np.arange(steps)[:, None]).sum(1).tolist()
        turn = np.maximum(lengths[:, None] - 1 - np.arange(steps), 0)
        both = np.stack([tokens, np.take_along_axis(tokens, turn, 1)])
        h, outs, tape = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, steps, HIDDEN), np.float32), []
        for t, a in enumerate(active):
            g, before = gates[ways, both[:, :a, t]], h[:, :a].copy()
            s = before @ u
            zr = sigmoid(g[..., :h2] + s[..., :h2])
            z, r, un = zr[..., :HIDDEN], zr[..., HIDDEN:], s[..., h2:]
            new = np.tanh(g[..., h2:] + r * un)
            h[:, :a] = (1 - z) * new + z * before
            outs[:, :a, t] = h[:, :a]
            if keep:
                tape.append((before, z, r, un, new))
        out = np.concatenate([outs[0], np.take_along_axis(outs[1], turn[:, :, None], 1)], 2)
        score = out @ self.p["attend"]
        score[np.arange(steps)[None, :] >= lengths[:, None]] = -np.inf
        weight = np.exp(score - score.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
        pooled = (weight[:, :, None] * out).sum(1)
        return pooled @ self.p["out"] + self.p["shift"][0], (out, weight, pooled, tape, active, turn, both)

    def gradients(self, gates, cache, memory, d_logit: np.ndarray) -> dict[str, np.ndarray]:
        (rows, keys, starts, count, x), (out, weight, pooled, tape, active, turn, both) = cache, memory
        g = {k: np.zeros_like(v) for k, v in self.p.items() if k not in ("words", "triples")}
        g["out"], g["shift"] = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
        d_pooled = d_logit[:, None] * self.p["out"]
        d_weight = out @ d_pooled[:, :, None]
        d_score = weight * (d_weight[:, :, 0] - (weight * d_weight[:, :, 0]).sum(1, keepdims=True))
        g["attend"] = np.einsum("nt,nth->h", d_score, out)
        d_out = weight[:, :, None] * d_pooled[:, None, :] + d_score[:, :, None] * self.p["attend"]
        d_outs = np.stack([d_out[..., :HIDDEN], np.take_along_axis(d_out[..., HIDDEN:], turn[:, :, None], 1)])
        n, steps = turn.shape
        d_steps, d_h = np.zeros((2, n, steps, 3 * HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
        back = np.swapaxes(self.p["state"], 1, 2)
        for t in range(steps - 1, -1, -1):
            a, (before, z, r, un, new) = active[t], tape[t]
            d = d_h[:, :a] + d_outs[:, :a, t]
            d_new = d * (1 - z) * (1 - new * new)
            d_z, d_r = d * (before - new) * z * (1 - z), d_new * un * r * (1 - r)
            pre = np.concatenate([d_z, d_r, d_new * r], 2)
            g["state"] += np.swapaxes(before, 1, 2) @ pre
            d_h[:, :a] = d * z + pre @ back
            d_steps[:, :a, t] = np.concatenate([d_z, d_r, d_new], 2)
        # Steps that no window has are zero, wherever they are added.
        d_gates = np.stack([added(both[w].ravel(), d_steps[w].reshape(n * steps, -1), gates.shape[1]) for w in range(2)])
        g["input"] = np.swapaxes(x, 0, 1)[None] @ d_gates
        g["bias"] = d_gates.sum(1)
        d_x = (d_gates @ np.swapaxes(self.p["input"], 1, 2)).sum(0)
        g["words"] = added(rows, d_x[:, :WORD_DIMS], len(self.p["words"]))
        each = np.repeat(d_x[:, WORD_DIMS:] / count, count[:, 0].astype(int), axis=0)
        g["triples"] = added(keys, each, TRIPLES)
        return g


def added(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` by row, one of ``n``."""
    return np.stack([np.bincount(rows, v, n) for v in values.T], 1).astype(np.float32)


def batch_of(texts: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Windows to (distinct words, tokens, lengths, order); longest first."""
    order = np.argsort([-len(w) for w in texts], kind="stable")
    index: dict[str, int] = {}
    lengths = np.array([len(texts[i]) for i in order])
    tokens = np.zeros((len(texts), int(lengths[0])), np.int64)
    for row, i in enumerate(order):
        tokens[row, : lengths[row]] = [index.setdefault(w, len(index)) for w in texts[i]]
    return list(index), tokens, lengths, order


def beginnings(word: str) -> list[str]:
    """The word, and its first letters, marked."""
    return [word, *[f"{word[:n]}*" for n in LETTERS if len(word) >= n]]


def surprise(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    """Minus the logarithm of a bound (Chernoff) on the chance of ``a`` of a + b, if each were
    toxic with the probability ``share``."""
    n = a + b
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(a > 0, a * np.log(a / (n * share)), 0) + np.where(b > 0, b * np.log(b / (n * (1 - share))), 0)


def leaning(docs: list[set[str]], toxic: np.ndarray) -> set[str]:
    """Words and beginnings of distinct documents (their sets of words) that occur rather in
    toxic ones.

    A candidate is judged by how many toxic and harmless documents hold it, and by how many
    words of theirs it covers; chance may reach the level once in as many candidates as there
    are. Of the best and the longer ones under it, the longest that covers most of its words
    there is taken, so that a word is not taken for all that begins like it. Then its
    words are taken out of all documents, and the rest is judged again, until nothing leans.
    """
    holds = {True: defaultdict(Counter), False: defaultdict(Counter)}  # candidate: document: words
    where = {True: defaultdict(list), False: defaultdict(list)}  # word: documents
    for doc, (words, y) in enumerate(zip(docs, toxic.tolist(), strict=True)):
        for w in words:
            where[y][w].append(doc)
            for f in beginnings(w) if y else ():
                holds[True][f][doc] += 1
    names = sorted(f for f, own in holds[True].items() if len(own) >= LEAST_TOXIC)
    known = set(names)
    for w, own in where[False].items():
        for f in beginnings(w):
            if f in known:
                holds[False][f].update(own)
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    w1, w0 = (max(1, sum(len(ws) for ws, y in zip(docs, toxic, strict=True) if bool(y) == side)) for side in (True, False))
    # Beginnings of the same documents as a longer one are no candidates of their own.
    level = np.log(max(2, len({(f[:3], tuple(sorted(holds[True][f]))) for f in names})))
    docs_of = lambda side: np.array([len(holds[side][f]) for f in names], float)
    words_of_ = lambda side: np.array([sum(holds[side][f].values()) for f in names], float)
    a, b, words1, words0 = docs_of(True), docs_of(False), words_of_(True), words_of_(False)
    at, taken = {f: i for i, f in enumerate(names)}, set()
    while names:
        by_docs = np.where(a >= LEAST_DOCS, surprise(a, b, n1 / (n1 + n0)) / level, 0)
        by_words = surprise(words1, words0, w1 / (w1 + w0)) / (2 * level)
        leans = np.maximum(by_docs, by_words)
        leans[(a < LEAST_TOXIC) | (a / n1 <= RATIO * (b + 0.5) / n0) | (words1 / w1 <= RATIO * words0 / w0)] = 0
        best = int(leans.argmax())
        if leans[best] < 1:
            break
        stem = names[best].rstrip("*")
        special = [f for f in names if f.startswith(stem) and words1[at[f]] >= SPECIAL * words1[best]]
        own = max(special, key=lambda f: (len(f.rstrip("*")), not f.endswith("*"), f))
        taken.add(own)
        gone = [w for w in where[True].keys() | where[False].keys() if w == own or (own.endswith("*") and w.startswith(own[:-1]))]
        for w in gone:
            for side in (True, False):
                for doc in where[side].pop(w, ()):
                    for f in beginnings(w):
                        if f in at:
                            i, left = at[f], holds[side][f]
                            left[doc] -= 1
                            (words1 if side else words0)[i] -= 1
                            if not left[doc]:
                                del left[doc]
                                (a if side else b)[i] -= 1
    return taken


def train(rows: pd.DataFrame, seed: int = 7) -> Network:
    """Windows (doc_id, y, words) to a network; the same for the same rows. Copies of a
    document count once, and copies of a window teach once."""
    rows = rows.sort_values(["doc_id", "y", "words"]).reset_index(drop=True)
    docs = sorted({(y, tuple(sorted(set(w)))) for (_, y), w in rows.groupby(["doc_id", "y"], sort=True)["words"]})
    sets = [{w for t in own for w in t.split(" ")} for _, own in docs]
    counts = Counter(w for ws in sets for w in ws)
    common = sorted((w for w, n in counts.items() if n >= LEAST_COUNT), key=lambda w: (-counts[w], w))[:VOCABULARY]
    seeds = leaning(sets, np.array([y == 1 for y, _ in docs], bool))
    entries = list(dict.fromkeys(sorted(seeds) + common))
    net, g = Network({w: i + 1 for i, w in enumerate(entries)}, seed), np.random.default_rng(seed)
    # Each distinct window once, with the first of its documents.
    where: dict[tuple[int, str], int] = {}
    for d, (y, own) in enumerate(docs):
        for w in own:
            where.setdefault((y, w), d)
    owner, label = np.array(list(where.values()), int), np.array([y == 1 for y, _ in where], bool)
    texts = [w.split(" ") for _, w in where]
    seeded = np.array([bool(y) and any(f in seeds for w in set(t) for f in beginnings(w)) for y, t in zip(label, texts, strict=True)], bool)
    harmless, toxic, hard = np.flatnonzero(~label), seeded, None
    first = {d: i for i, d in reversed(list(enumerate(owner.tolist())))}
    count = Counter(owner.tolist())
    quiet = np.array(sorted(d for d in first if docs[d][0] != 1), int)
    start, many = np.array([first[d] for d in quiet.tolist()], int), np.array([count[d] for d in quiet.tolist()], int)

    def drawn(n: int) -> np.ndarray:
        d = g.integers(len(quiet), size=n)
        return start[d] + (g.random(n) * many[d]).astype(int)

    mean = {k: np.zeros_like(v) for k, v in net.p.items()}
    square = {k: np.zeros_like(v) for k, v in net.p.items()}
    step, sums = 0, {k: np.zeros_like(v) for k, v in net.p.items()}
    for last, steps in zip([False] * (len(ROUNDS) - 1) + [True], ROUNDS, strict=True):
        positive = np.flatnonzero(toxic)
        if not len(positive) or not len(harmless):
            # Nothing to tell apart: every window gets the one label there is, if any.
            net.p["out"][:], net.p["shift"][0] = 0, 5.0 if len(positive) else -5.0
            return net
        for _ in range(steps):
            others = BATCH - BATCH // 4
            quiet_ones = drawn(others) if hard is None else np.concatenate([drawn(others // 2), g.choice(hard, others - others // 2)])
            some = np.concatenate([g.choice(positive, BATCH // 4), quiet_ones])
            words, tokens, lengths, order = batch_of([texts[i] for i in some])
            ids = np.array([net.row(w) for w in words]) * (g.random(len(words)) > WORD_DROP)
            gates, cache = net.inputs(words, ids)
            logit, memory = net.forward(gates, tokens, lengths, keep=True)
            error = sigmoid(logit) - label[some][order]
            grads = net.gradients(gates, cache, memory, (error / len(error)).astype(np.float32))
            step += 1
            for k, v in net.p.items():
                d = grads[k] + DECAY * v
                mean[k] += 0.1 * (d - mean[k])
                square[k] += 0.01 * (d * d - square[k])
                v -= (RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
                if last:
                    sums[k] += v
        if last:
            net.p = {k: v / np.float32(steps) for k, v in sums.items()}
            break
        scores = scored(net, texts)
        toxic = seeded | (label & (scores > max(0.5, np.quantile(scores[harmless], ABOVE))))
        hard = harmless[scores[harmless] >= np.quantile(scores[harmless], HARD)]
    # The level of a document's highest window.
    scores = np.clip(scored(net, texts), 1e-6, 1 - 1e-6)
    top = np.full(len(docs), -np.inf)
    np.maximum.at(top, owner, np.log(scores / (1 - scores)))
    sure = np.unique(owner[seeded])
    low, high = np.quantile(top[quiet], LEVELS[0]), np.quantile(top[sure], LEVELS[1])
    net.p["shift"] -= np.float32((low + max(low, high)) / 2)
    return net


def scored(net: Network, texts: list[list[str]]) -> np.ndarray:
    out = np.zeros(len(texts))
    for at in range(0, len(texts), WINDOWS):
        words, tokens, lengths, order = batch_of(texts[at : at + WINDOWS])
        out[at + order] = sigmoid(net.forward(net.inputs(words)[0], tokens, lengths)[0])
    return out


class Scorer:
    """Scores texts; keeps the gate inputs of the words that it has met."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.gates = np.zeros((2, 0, 3 * HIDDEN), np.float32)

    def rows(self, words: list[str]) -> list[int]:
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        if new:
            n = len(self.index)
            self.index.update(zip(new, range(n, n + len(new)), strict=True))
            if len(self.index) > self.gates.shape[1]:
                grown = np.zeros((2, 2 * len(self.index), 3 * HIDDEN), np.float32)
                grown[:, :n] = self.gates[:, :n]
                self.gates = grown
            for at in range(0, len(new), 8192):
                part = new[at : at + 8192]
                self.gates[:, n + at : n + at + len(part)] = self.net.inputs(part)[0]
        return [self.index[w] for w in words]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Highest window of each text; 0 for a text without words."""
        out, held, owner = np.zeros(len(texts)), [], []

        def flush():
            lengths = np.array([len(h) for h in held])
            order = np.argsort(-lengths, kind="stable")
            tokens = np.zeros((len(held), int(lengths.max())), np.int64)
            for row, i in enumerate(order):
                tokens[row, : lengths[i]] = held[i]
            logit, _ = self.net.forward(self.gates, tokens, lengths[order])
            np.maximum.at(out, np.array(owner)[order], sigmoid(logit))
            held.clear()
            owner.clear()

        for i, text in enumerate(texts):
            words = words_of(text)
            if len(self.index) > KEPT_WORDS and not held:
                self.clear()
            for at in range(0, max(1, len(words) - (WIDTH - STRIDE)) if words else 0, WINDOWS * STRIDE):
                # A long text goes in runs of windows; the next run begins a stride on.
                rows = self.rows(words[at : at + (WINDOWS - 1) * STRIDE + WIDTH])
                for w in range(0, min(WINDOWS * STRIDE, max(1, len(words) - (WIDTH - STRIDE)) - at), STRIDE):
                    held.append(rows[w : w + WIDTH])
                    owner.append(i)
                if len(held) >= WINDOWS:
                    flush()
        if held:
            flush()
        return out


def learn(docs: DataFrame, labels: DataFrame, label: str, sample: tuple[int, int] = SAMPLE) -> Network:
    """A network from ``docs`` (doc_id, text) and ``labels`` (doc_id, ``label`` 0 or 1).

    At most ``sample`` documents of label 0 and of 1, by hash of doc_id, are read, whole, and
    SAMPLE_CHARS code points of them all; their windows reach the driver, where training
    runs. Rows that repeat an id count within these bounds, copies of one text once. Null
    ids, labels and texts teach nothing; without rows of both labels all scores are alike.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter("doc_id is not null").distinct()
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    some = known.filter("y = 1").orderBy(*by_hash).limit(sample[1]).union(known.filter("y = 0").orderBy(*by_hash).limit(sample[0]))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key")).filter("text is not null")
    found = keyed.join(some, "doc_id").select("doc_id", "y", "key", F.length("text").alias("n")).distinct()
    rows = [r for y in (1, 0) for r in found.filter(F.col("y") == y).orderBy(*by_hash, "key").limit(sample[y]).collect()]
    chosen, left = [], SAMPLE_CHARS
    for r in sorted(rows, key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["key"])):
        if r["n"] <= left:
            chosen.append((r["doc_id"], r["key"], r["y"]))
            left -= r["n"]
    chosen = docs.sparkSession.createDataFrame(chosen, "doc_id bigint, key bigint, y int")

    def cut(batches):
        for b in batches:
            for doc, text, y in zip(b["doc_id"], b["text"], b["y"], strict=True):
                parts = [" ".join(w) for w in windows(words_of(text))]
                yield pd.DataFrame({"doc_id": [doc] * len(parts), "y": [y] * len(parts), "words": parts})

    texts = keyed.join(chosen, ["doc_id", "key"]).dropDuplicates(["doc_id", "key", "y"])
    return train(texts.select("doc_id", "text", "y").mapInPandas(cut, "doc_id bigint, y int, words string").toPandas())


def classify(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` (text, ...) with score, 0 to 1; null texts and texts without words score 0.
    Other columns stay, save one named score."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(net)
        for texts in batches:
            parts = [scorer.scores(texts.iloc[at : at + 512].tolist()) for at in range(0, len(texts), 512)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return without(docs, "score").withColumn("score", score.asNondeterministic()("text"))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Null and empty texts score 0; repeated rows are rows of their own; empty tables, of
    documents or labels, leave every score alike."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    net = learn(docs, read(spark, sf_dir, "labels").filter(~held_out(5, 0)), "toxic")
    out = classify(docs, net).select("doc_id", held_out(5, 0).alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
