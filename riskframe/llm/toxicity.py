"""Toxicity: bidirectional gated recurrent network with attention pooling over overlapping word windows.

Every word enters by its own vector and by the largest coordinates of its character grams' vectors. The network
is trained in numpy on a bounded labelled sample; every window of every text is scored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.labelled import held_out, labelled_sample

CUT = 0.3
PER_CLASS = 600
WINDOW, STRIDE = 32, 24
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 8, 8, 8
KNOWN_GRAMS, LETTERS = 16_384, 24
VOCABULARY, MIN_DOCS = 8_000, 5
EPOCHS, BATCH, RATE, DECAY, DROPPED = 4, 256, 0.01, 1.0, 0.1
CHECKED = 4  # every so-manieth text of the sample only sets the cut
KNOWN_WORDS = 400_000
SCORE_BATCH = 8_192
EDGES = ".,;:!?\"'()[]{}<>|#$%&*-_+=/\\`~@^"


def clean(word: str) -> str:
    return word.lower().strip(EDGES)


def words_of(text: str) -> list[str]:
    """What stands between white space; longer than ``LETTERS`` characters, as in scripts without spaces, it is cut into
    pieces, words of their own, that overlap by half, so that words of up to ``LETTERS // 2`` characters in it lie in one."""
    out = []
    for token in text.split():
        if len(token) <= LETTERS:
            out.append(token)
        else:
            out += [token[i : i + LETTERS] for i in range(0, len(token) - LETTERS // 2, LETTERS // 2)]
    return out


def grams(word: str) -> list[str]:
    """Character 5-grams of ``<word>`` and the 4-grams at its ends."""
    marked = f"<{word}>"
    return [marked[:4], marked[-4:], *[marked[i : i + 5] for i in range(len(marked) - 4)]]


def gram_codes(words: list[str], known: dict[str, int]) -> np.ndarray:
    """Numbers of every word's known grams, filled up with 0."""
    get = known.get
    found = [[n for g in grams(w) if (n := get(g))] for w in words]
    out = np.zeros((len(words), max(map(len, found), default=0) or 1), np.int64)
    for i, own in enumerate(found):
        if own:
            out[i, : len(own)] = own
    return out


def windows_of(n: int) -> list[int]:
    """Starts of the overlapping windows that cover n words; one for an empty text."""
    return [0, *range(STRIDE, n - WINDOW + STRIDE, STRIDE)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Words:
    """Word features: the vocabulary number (0: unknown) and the character gram numbers of every word."""

    vocabulary: np.ndarray
    chars: np.ndarray


class Network:
    """Parameters, forward and backward pass."""

    def __init__(self, words: int, grams: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        size = WORD_DIM + CHAR_DIM

        def draw(*shape: int, scale: float | None = None) -> np.ndarray:
            return rng.normal(0, scale or 1 / math.sqrt(shape[0]), shape).astype(np.float32)

        self.p = {
            "word": draw(words, WORD_DIM, scale=0.3),
            "char": draw(grams, CHAR_DIM, scale=0.3),
            "va": draw(ATTENTION),
            "Wa": draw(2 * HIDDEN, ATTENTION),
            "ba": np.zeros(ATTENTION, np.float32),
            "wo": draw(2 * HIDDEN),
            "bo": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.p |= {"W" + side: draw(size, 3 * HIDDEN), "U" + side: draw(HIDDEN, 3 * HIDDEN), "b" + side: np.zeros(3 * HIDDEN, np.float32)}

    def start_from(self, evidence: np.ndarray, gram_evidence: np.ndarray) -> None:
        """The first coordinate of a word's or a gram's vector starts as its evidence for the label."""
        for name, known in (("word", evidence), ("char", gram_evidence)):
            self.p[name] *= 0.2
            self.p[name][:, 0] = known

    def characters(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The largest coordinates over a word's known grams, and the gram each comes from."""
        top = np.zeros((len(words.chars), CHAR_DIM), np.float32)
        source = np.zeros((len(words.chars), CHAR_DIM), np.int64)
        some = np.flatnonzero(words.chars[:, 0])  # known grams come first
        chars = words.chars[some]
        own = np.where((chars > 0)[:, :, None], self.p["char"][chars], -np.inf)
        best = own.argmax(axis=1)
        top[some] = np.take_along_axis(own, best[:, None, :], axis=1)[:, 0]
        source[some] = np.take_along_axis(chars, best, axis=1)
        return top, source

    def inputs(self, words: Words) -> np.ndarray:
        """One input vector per word."""
        return np.concatenate([self.p["word"][words.vocabulary], self.characters(words)[0]], axis=1)

    def projected(self, x: np.ndarray, side: str) -> np.ndarray:
        return x @ self.p["W" + side] + self.p["b" + side]

    def run(self, table: np.ndarray, codes: np.ndarray, mask: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (T, B, H) of one direction; ``table`` holds the projected input of every word."""
        u = self.p["U" + side]
        steps = codes.shape[1]
        states = np.empty((steps, len(codes), HIDDEN), np.float32)
        h = np.zeros((len(codes), HIDDEN), np.float32)
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            x, hu = table[codes[:, t]], h @ u
            gates = sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            new = h + mask[:, t, None] * (1 - z) * (n - h)
            if keep is not None:
                keep.append((t, h, z, r, n, hu[:, 2 * HIDDEN :]))
            states[t] = h = new
        return states

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, ...]:
        u = np.tanh(states @ self.p["Wa"] + self.p["ba"])
        e = np.where(mask.T > 0, u @ self.p["va"], -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        return u, a, np.einsum("tb,tbh->bh", a, states)

    def logits(self, tables: tuple[np.ndarray, np.ndarray], codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        states = np.concatenate([self.run(tables[0], codes, mask, "f"), self.run(tables[1], codes, mask, "b")], axis=2)
        return self.pool(states, mask)[2] @ self.p["wo"] + self.p["bo"]

    def gradients(self, words: Words, codes: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted logistic loss of a batch of windows."""
        p = self.p
        own, codes = np.unique(codes, return_inverse=True)
        codes = codes.reshape(mask.shape)
        words = Words(words.vocabulary[own], words.chars[own])
        x = self.inputs(words)
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self.run(self.projected(x, s), codes, mask, s, kept[s]) for s in "fb"], axis=2)
        u, a, pooled = self.pool(states, mask)
        d = ((sigmoid(pooled @ p["wo"] + p["bo"]) - y) * weight / weight.sum()).astype(np.float32)
        g = {"wo": pooled.T @ d, "bo": d.sum(keepdims=True)}
        dpooled = d[:, None] * p["wo"]
        da = np.einsum("tbh,bh->tb", states, dpooled)
        de = a * (da - (a * da).sum(axis=0))
        du = de[:, :, None] * p["va"] * (1 - u * u)
        g["va"] = np.einsum("tb,tba->a", de, u)
        g["Wa"], g["ba"] = np.einsum("tbh,tba->ha", states, du), du.sum(axis=(0, 1))
        dstates = a[:, :, None] * dpooled + du @ p["Wa"].T
        dx = np.zeros_like(x)
        for k, s in enumerate("fb"):
            w, uh = p["W" + s], p["U" + s]
            dproj, guh = np.zeros((len(x), 3 * HIDDEN), np.float32), np.zeros_like(uh)
            dh = np.zeros((len(codes), HIDDEN), np.float32)
            for t, h, z, r, n, hn in reversed(kept[s]):
                dh = dh + dstates[t][:, k * HIDDEN : (k + 1) * HIDDEN]
                m = mask[:, t, None]
                dn = dh * m * (1 - z) * (1 - n * n)
                dz = dh * m * (h - n) * z * (1 - z)
                dr = dn * hn * r * (1 - r)
                down = np.concatenate([dz, dr, dn * r], axis=1)
                guh += h.T @ down
                np.add.at(dproj, codes[:, t], np.concatenate([dz, dr, dn], axis=1))
                dh = dh * (1 - m * (1 - z)) + down @ uh.T
            g["U" + s], g["W" + s], g["b" + s] = guh, x.T @ dproj, dproj.sum(axis=0)
            dx += dproj @ w.T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], words.vocabulary, dx[:, :WORD_DIM])
        source = self.characters(words)[1]
        np.add.at(g["char"], (source, np.arange(CHAR_DIM)), dx[:, WORD_DIM:])
        g["char"][0] = 0
        return g


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.start = {k: params[k].copy() for k in ("word", "char")}  # vectors of rare words stay near their start
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, p in self.params.items():
            self.m[k] += 0.1 * (g[k] - self.m[k])
            self.v[k] += 0.001 * (g[k] ** 2 - self.v[k])
            p -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
            if k in self.start:
                p -= self.rate * DECAY * (p - self.start[k])


@dataclass
class Model:
    """A trained network, its vocabulary, and the window logit that maps to the wanted threshold."""

    network: Network
    vocabulary: dict[str, int]
    grams: dict[str, int]
    cut: float
    spread: float
    threshold: float = CUT

    def score(self, logits: np.ndarray) -> np.ndarray:
        shift = math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip((logits - self.cut) / self.spread + shift, -30, 30)))


def grid(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (B, T) of windows and their mask; what lies beyond a text's end is masked."""
    at = starts[:, None] + np.arange(WINDOW)
    mask = at < ends[:, None]
    padded = codes[np.minimum(at, max(len(codes) - 1, 0))] if len(codes) else np.zeros(at.shape, np.int64)
    return np.where(mask, padded, 0), mask.astype(np.float32)


def window_grid(lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of all windows of texts that follow each other in one code array."""
    starts, ends, owner, base = [], [], [], 0
    for doc, n in enumerate(lengths):
        own = windows_of(n)
        starts += [base + s for s in own]
        ends += [base + n] * len(own)
        owner += [doc] * len(own)
        base += n
    return np.array(starts, np.int64), np.array(ends, np.int64), np.array(owner, np.int64)


def evidence(found: list[set[str]], labels: np.ndarray, errors: float) -> dict[str, float]:
    """Log odds of the label given that a text has the item, moved to zero by so many standard errors."""
    size = np.bincount(labels, minlength=2)
    count = [Counter(x for items, label in zip(found, labels) if label == c for x in items) for c in (0, 1)]
    out = {}
    for item in count[0] | count[1]:
        n0, n1 = count[0][item] + 0.5, count[1][item] + 0.5
        odds = math.log(n1 / (size[1] + 1)) - math.log(n0 / (size[0] + 1))
        shrunk = max(abs(odds) - errors * math.sqrt(1 / n0 + 1 / n1), 0.0)
        out[item] = math.copysign(min(shrunk, 3.0), odds)
    return out


class Scorer:
    """Scores of texts; input projections of known words are kept, up to ``KNOWN_WORDS``."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.tables = tuple(np.zeros((0, 3 * HIDDEN), np.float32) for _ in "fb")

    def number(self, word: str) -> int:
        """A word's vocabulary number; for a piece of a long one that of the word inside it that speaks most for the label."""
        get = self.model.vocabulary.get
        own = get(word, 0)
        if own or len(word) <= LETTERS // 2:
            return own
        inside = {get(word[i:j], 0) for i in range(len(word) - 3) for j in range(i + 4, len(word) + 1)} - {0}
        return max(inside, key=lambda n: self.model.network.p["word"][n, 0], default=0)

    def codes(self, words: list[str]) -> np.ndarray:
        if len(self.known) > KNOWN_WORDS:
            self.reset()
        known = self.known
        new = list(set(words).difference(known))
        if new:
            plain = [clean(w) for w in new]
            own = {w: i for i, w in enumerate(dict.fromkeys(plain))}
            vocabulary = np.array([self.number(w) for w in own])
            chars = gram_codes(list(own), self.model.grams)
            net = self.model.network
            parts = [net.inputs(Words(vocabulary[i : i + 20_000], chars[i : i + 20_000])) for i in range(0, len(own), 20_000)]
            x, base = np.concatenate(parts), len(self.tables[0])
            self.tables = tuple(np.concatenate([t, net.projected(x, s).astype(np.float32)]) for t, s in zip(self.tables, "fb"))
            known.update(zip(new, [base + own[w] for w in plain]))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def logits(self, texts: list[list[str]]) -> np.ndarray:
        """The greatest window logit of every text."""
        codes = self.codes([w for t in texts for w in t])
        starts, ends, owner = window_grid([len(t) for t in texts])
        best = np.full(len(texts), -np.inf)
        if not len(codes):
            self.codes([""])
        for at in range(0, len(starts), SCORE_BATCH):
            part = slice(at, at + SCORE_BATCH)
            logit = self.model.network.logits(self.tables, *grid(codes, starts[part], ends[part]))
            np.maximum.at(best, owner[part], logit)
        return best


def fit_network(texts: list[str], labels: np.ndarray, threshold: float = CUT) -> Model | None:
    """A label holds for a text, not for each of its windows: of a toxic text the highest windows are trained on,
    by word evidence at first and by the network itself from the second epoch on; of other texts all windows.
    None without both labels.

    Every ``CHECKED``-th text of either label is kept out of the training. The cut on a text's highest window
    is where these texts are told apart best.
    """
    if len(np.unique(labels)) < 2:
        return None
    split = [[clean(w) for w in words_of(t)] for t in texts]
    turn = np.empty(len(labels), np.int64)
    for c in (0, 1):
        turn[labels == c] = np.arange((labels == c).sum())
    trained = (turn % CHECKED != CHECKED - 1) if (labels == 1).sum() >= 3 * CHECKED else np.ones(len(labels), bool)
    documents = Counter(w for t in split for w in set(t))
    sets = [set(t) for t, use in zip(split, trained) if use]
    least = min(MIN_DOCS, max(2, len(sets) // 10))
    frequent = Counter(w for t in sets for w in t)
    common = sorted((w for w, n in frequent.items() if n >= least), key=lambda w: (-frequent[w], w))[:VOCABULARY]
    vocabulary = {w: i + 1 for i, w in enumerate(common)}
    by_word = evidence(sets, labels[trained], 1.0)
    by_gram = evidence([{g for w in t for g in grams(w)} for t in sets], labels[trained], 2.0)
    telling = sorted((g for g, e in by_gram.items() if e > 0), key=lambda g: (-by_gram[g], g))[:KNOWN_GRAMS]
    known_grams = {g: i + 1 for i, g in enumerate(telling)}
    known = {w: i for i, w in enumerate(sorted(documents) or [""])}
    words = Words(np.array([vocabulary.get(w, 0) for w in known]), gram_codes(list(known), known_grams))
    codes = np.array([known[w] for t in split for w in t], np.int64)
    starts, ends, owner = window_grid([len(t) for t in split])
    codes, mask = grid(codes, starts, ends)
    network, rng = Network(len(vocabulary) + 1, len(known_grams) + 1), np.random.default_rng(3)
    of_words = np.array([0.0, *[by_word[w] for w in common]], np.float32)
    of_grams = np.array([0.0, *[by_gram[g] for g in telling]], np.float32)
    network.start_from(of_words, of_grams)
    adam = Adam(network.p, RATE)
    toxic = labels[owner] == 1
    strongest = np.maximum(of_words[words.vocabulary], of_grams[words.chars].max(axis=1))
    logit = (strongest[codes] * mask).max(axis=1)

    def all_logits() -> np.ndarray:
        x = network.inputs(words)
        tables = tuple(network.projected(x, s) for s in "fb")
        parts = [network.logits(tables, codes[i : i + 4096], mask[i : i + 4096]) for i in range(0, len(codes), 4096)]
        return np.concatenate(parts)

    def highest(logit: np.ndarray) -> np.ndarray:
        best = np.full(len(labels), -np.inf)
        np.maximum.at(best, owner, logit)
        return best

    for epoch in range(EPOCHS):
        if epoch:
            logit = all_logits()
        use = np.flatnonzero(trained[owner] & (~toxic | (logit >= highest(logit)[owner] - 0.5)))
        balance = np.where(toxic, min(max(0.5 * (~toxic[use]).sum() / max(toxic[use].sum(), 1), 1.0), 20.0), 1.0).astype(np.float32)
        steps = max(len(use) // BATCH, 40)
        for step in range(steps):
            rows = rng.choice(use, min(BATCH, len(use)), replace=False)
            adam.rate = RATE * (1 - 0.9 * (epoch * steps + step) / (EPOCHS * steps))
            seen = mask[rows] * (rng.random(mask[rows].shape) >= DROPPED)
            adam.step(network.gradients(words, codes[rows], seen.astype(np.float32), toxic[rows].astype(np.float32), balance[rows]))
    best = highest(all_logits())
    fair = ~trained if (~trained).any() else trained
    best, labels = best[fair], labels[fair]
    order = np.argsort(best, kind="stable")
    hits = np.concatenate([[0], np.cumsum(labels[order])])
    total = hits[-1]
    right = (total - hits) / total + (np.arange(len(order) + 1) - hits) / max(len(order) - total, 1)
    at = int(np.argmax(right))
    sides = best[order][max(at - 1, 0)], best[order][min(at, len(order) - 1)]
    cut = float(sides[0] + 0.5 * (sides[1] - sides[0]))
    return Model(network, vocabulary, known_grams, cut, max(float(best[labels == 1].mean() - cut) / 4, 0.05), threshold)


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS) -> Model | None:
    """Fitted on at most ``per_class`` labelled documents of either label, outside the held-out fold."""
    sample = labelled_sample(docs.select("doc_id", "text"), labels, label, per_class)
    rows = sorted(sample.collect(), key=lambda r: (r["doc_id"], r["text"]))
    return fit_network([r["text"] for r in rows], np.array([r["label"] for r in rows])) if rows else None


def score_toxicity(docs: DataFrame, model: Model | None, threshold: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row: the highest of all overlapping windows of the whole text.

    A null or empty text is one empty window, scored by the network's bias. Without a model (no labelled rows
    of both kinds) every score is 0. Scores depend on the text alone.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), held_out("doc_id").alias("held_out")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model else None
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            at, texts, size = 0, [], 0
            for i, value in enumerate(batch.column(1) if scorer else []):
                texts.append(words_of(value.as_py()))
                size += len(texts[-1])
                if size >= 400_000 or i == batch.num_rows - 1:
                    scores[at : i + 1] = model.score(scorer.logits(texts))
                    at, texts, size = i + 1, [], 0
            columns = [batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
