"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as the sum of its own vector, if it is known, and of vectors of its hashed
character sequences. A text's windows overlap by half; its score comes from its most toxic window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.frames import batches_of, share
from ripplelog.llm.words import Hasher, mixed

WINDOW, STRIDE = 32, 16
#: Sizes of word vectors and of each direction's state.
WIDTH, STATE = 12, 8
#: Character sequences of these lengths, hashed into so many buckets.
GRAMS, BUCKETS = (3, 4, 5), 1 << 14
#: The training sample: so many rows of each class, of any length, and so many windows of each text. Of
#: a text beyond so many characters, as many are taken in pieces from all over it. Scoring knows no such
#: bounds.
TOXIC_ROWS, CLEAN_ROWS, SAMPLE_WINDOWS = 1600, 2400, 12
SAMPLE_CHARS, SAMPLE_PIECES = 20_000, 10
#: A word or character sequence counts as known from this many sampled texts on.
KNOWN_FROM, MOST_WORDS = 4, 20_000
THRESHOLD = 0.3
#: Texts of so many bytes, and so many of their windows, are scored at once.
SCORED_BYTES, SCORED_WINDOWS = 1 << 20, 512
#: Characters that separate words: ASCII that is neither letter nor digit.
_MARKS = tuple(c for c in range(128) if not chr(c).isalnum())


@dataclass
class Coded:
    """Texts as numbers of distinct words."""

    word: np.ndarray  # number of the distinct word at each place
    offsets: np.ndarray  # of texts in word
    hashes: np.ndarray  # of the distinct words
    grams: np.ndarray  # buckets of the distinct words' character sequences
    bounds: np.ndarray  # of the distinct words in grams


def code(hasher: Hasher, column: pa.Array) -> Coded:
    data, begin, end, offsets = hasher.spans(column)
    hashes, first, word = np.unique(hasher.hashes(data, begin, end), return_index=True, return_inverse=True)
    # The bytes of each distinct word with a mark on either side, one word after the other.
    size = end[first] - begin[first]
    after = np.cumsum(size + 2)
    letters = np.zeros(int(after[-1]) if len(after) else 0, np.uint64)
    spread = np.arange(int(size.sum()), dtype=np.int64)
    shift = np.cumsum(size) - size
    places = spread + np.repeat(after - size - 1 - shift, size)
    letters[places] = hasher.letters[data[spread + np.repeat(begin[first] - shift, size)]]
    owner = np.repeat(np.arange(len(first)), size + 2)
    found, whose = [], []
    for n in GRAMS:
        h = np.zeros(max(len(letters) - n + 1, 0), np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + letters[k : k + len(h)]
        inside = owner[: len(h)] == owner[n - 1 :]
        found.append((mixed(h[inside] + np.uint64(n)) % np.uint64(BUCKETS)).astype(np.int64))
        whose.append(owner[: len(h)][inside])
    grams, whose = np.concatenate(found), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    bounds = np.searchsorted(whose[order], np.arange(len(first) + 1))
    return Coded(word, offsets, hashes, grams[order], bounds)


def windows(coded: Coded, size: int = WINDOW, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first place, length) of all windows of all texts; a text has one at least."""
    n = np.diff(coded.offsets)
    count = 1 + np.maximum(0, -(-(n - size) // stride))
    text = np.repeat(np.arange(len(n)), count)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * stride
    return text, coded.offsets[text] + start, np.minimum(size, n[text] - start)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights and passes. ``known`` holds the sorted hashes of words with a vector of their own."""

    def __init__(self, known: np.ndarray, words: np.ndarray, grams: np.ndarray, used: np.ndarray, seed: int):
        """words and grams: how far each known word and each bucket leans to the toxic texts of the
        sample, in standard deviations. Vectors start out along one direction by that much."""
        rng = np.random.default_rng(seed)
        normal = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.known, self.used = known, used.astype(np.float32)
        ahead = normal(WIDTH)
        lean = lambda z: 0.7 * normal(len(z), WIDTH) + 0.2 * np.clip(z - 2, 0, 6)[:, None].astype(np.float32) * ahead
        self.calibration = (1.0, 0.0)
        self.w = {
            "word": lean(np.append(words, 0.0)),
            "gram": lean(grams) * self.used[:, None],
            "input": normal(WIDTH, 6 * STATE),
            "input0": np.zeros(6 * STATE, np.float32),
            "state": normal(2, STATE, 3 * STATE),
            "look": normal(2 * STATE),
            "out": normal(2 * STATE),
            "out0": np.zeros(1, np.float32),
        }

    def lookup(self, coded: Coded) -> np.ndarray:
        """Row of the own vector of each distinct word; the last row is for the unknown ones."""
        if not len(self.known):
            return np.zeros(len(coded.hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, coded.hashes), len(self.known) - 1)
        return np.where(self.known[at] == coded.hashes, at, len(self.known))

    def inputs(self, rows: np.ndarray, grams: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors of distinct words, and how much each of their character sequences counts."""
        size = np.diff(bounds)
        share = (1 / np.sqrt(np.maximum(size, 1))).astype(np.float32)
        x = self.w["word"][rows]
        some = np.flatnonzero(size)
        for part in np.array_split(some, max(1, len(some) // 20_000)):
            if len(part):
                a, b = bounds[part[0]], bounds[part[-1] + 1]
                sums = np.add.reduceat(self.w["gram"][grams[a:b]], bounds[part] - a)
                x[part] += sums * share[part, None]
        return x, share

    def forward(self, gates: np.ndarray, mask: np.ndarray | None, keep: bool = False):
        """Logits of windows. gates: (time, direction, window, 3 states), the second one reversed."""
        steps, _, n, _ = gates.shape
        h = np.zeros((2, n, STATE), np.float32)
        states = np.empty((steps, 2, n, STATE), np.float32)
        kept, s = [], STATE
        for t in range(steps):
            u = h @ self.w["state"]
            zr = _sigmoid(gates[t, :, :, : 2 * s] + u[:, :, : 2 * s])
            new = np.tanh(gates[t, :, :, 2 * s :] + zr[:, :, s:] * u[:, :, 2 * s :])
            step = (1 - zr[:, :, :s]) * (new - h)
            if mask is not None:
                step *= mask[t]
            if keep:
                kept.append((h, u[:, :, 2 * s :], zr, new))
            h = h + step
            states[t] = h
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)
        look = both @ self.w["look"]
        if mask is not None:
            look = np.where(mask[:, 0, :, 0] > 0, look, np.float32(-1e4))
        weight = np.exp(look - look.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tn,tns->ns", weight, both)
        logit = pooled @ self.w["out"] + self.w["out0"][0]
        return (logit, (both, weight, pooled, kept)) if keep else logit

    def gates(self, projected: np.ndarray, word: np.ndarray, first: np.ndarray, length: np.ndarray):
        """Inputs and mask of windows; projected: distinct words by both directions' gates."""
        steps = np.arange(WINDOW)
        inside = steps < length[:, None]
        places = np.where(inside, first[:, None] + steps, 0)
        rows = word[places] if len(word) else np.zeros(places.shape, np.int64)
        taken = projected[rows.T] if len(projected) else np.zeros((WINDOW, len(first), 6 * STATE), np.float32)
        both = np.stack([taken[:, :, : 3 * STATE], taken[::-1, :, 3 * STATE :]], axis=1)
        if inside.all():
            return both, None, rows
        mask = inside.T.astype(np.float32)
        return both, np.stack([mask, mask[::-1]], axis=1)[:, :, :, None], rows

    def gradients(self, rows, projected_inputs, gates, mask, target):
        """Loss and gradients of one batch of windows; rows: (window, time) numbers of words."""
        logit, (both, look, pooled, kept) = self.forward(gates, mask, keep=True)
        p = _sigmoid(logit)
        loss = float(-np.where(target > 0, np.log(p + 1e-7), np.log(1 - p + 1e-7)).mean())
        d_logit = ((p - target) / len(p)).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "out0": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.w["out"]
        d_weight = np.einsum("ns,tns->tn", d_pooled, both)
        d_look = look * (d_weight - (look * d_weight).sum(0))
        if mask is not None:
            d_look = d_look * mask[:, 0, :, 0]
        g["look"] = np.einsum("tn,tns->s", d_look, both)
        d_both = look[:, :, None] * d_pooled + d_look[:, :, None] * self.w["look"]
        d_states = np.stack([d_both[:, :, :STATE], d_both[::-1, :, STATE:]], axis=1)
        d_gates = np.empty_like(gates)
        d_h = np.zeros((2, len(p), STATE), np.float32)
        g["state"] = np.zeros_like(self.w["state"])
        back, s = self.w["state"].transpose(0, 2, 1), STATE
        for t in range(len(gates) - 1, -1, -1):
            h, un, zr, new = kept[t]
            d_h = d_h + d_states[t]
            d_step = d_h if mask is None else d_h * mask[t]
            z, r = zr[:, :, :s], zr[:, :, s:]
            d_new = d_step * (1 - z) * (1 - new * new)
            d_z = d_step * (h - new) * z * (1 - z)
            d_r = d_new * un * r * (1 - r)
            d_gates[t] = np.concatenate([d_z, d_r, d_new], axis=2)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=2)
            g["state"] += h.transpose(0, 2, 1) @ d_u
            d_h = d_h - d_step * (1 - z) + d_u @ back
        d_taken = np.concatenate([d_gates[:, 0], d_gates[::-1, 1]], axis=2).reshape(-1, 6 * STATE)
        if mask is not None:
            d_taken = d_taken * mask[:, 0].reshape(-1, 1)
        d_word = np.zeros((len(projected_inputs), 6 * STATE), np.float32)
        np.add.at(d_word, rows.T.ravel(), d_taken)
        g["input"], g["input0"] = projected_inputs.T @ d_word, d_word.sum(0)
        return loss, g, d_word @ self.w["input"].T

    def logits(self, coded: Coded, chunk: int = SCORED_WINDOWS) -> np.ndarray:
        """For each text, the logit of its most toxic window."""
        text, first, length = windows(coded)
        x, _ = self.inputs(self.lookup(coded), coded.grams, coded.bounds)
        projected = x @ self.w["input"] + self.w["input0"]
        out = np.empty(len(text), np.float32)
        # Whole windows need no mask.
        order = np.argsort(length < WINDOW, kind="stable")
        whole = int((length >= WINDOW).sum())
        for a in [*range(0, whole, chunk), *range(whole, len(order), chunk)]:
            some = order[a : min(a + chunk, whole if a < whole else len(order))]
            gates, mask, _ = self.gates(projected, coded.word, first[some], length[some])
            out[some] = self.forward(gates, mask)
        return np.maximum.reduceat(out, np.searchsorted(text, np.arange(len(coded.offsets) - 1)))

    def scores(self, coded: Coded) -> np.ndarray:
        scale, shift = self.calibration
        return _sigmoid(scale * self.logits(coded).astype(np.float64) + shift)


def _calibrate(logit: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the labels on the texts' logits, by damped Newton steps."""
    beta = np.array([1.0, 0.0])
    x = np.stack([logit, np.ones_like(logit)], axis=1).astype(np.float64)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.05, 0.01])
        step = np.linalg.solve(hessian, x.T @ (target - p) - np.array([0.05, 0.01]) * (beta - [1, 0]))
        beta += np.clip(step, -1, 1)
    return max(float(beta[0]), 0.05), float(beta[1])


def train(texts: list[str], labels: list[int], steps: int = 96, batch: int = 1024, seed: int = 7) -> Network:
    """A network for texts labelled 1 (toxic) or 0, by Adam on windows that carry their text's label.

    A fifth of the texts is set aside; the network is tried on them after 4, 8, 16 and every 32 steps. The best one is
    kept, with the scale of its scores fitted on them.
    """
    rng = np.random.default_rng(seed)
    coded = code(Hasher(_MARKS), pa.array(texts, pa.string()))
    target = np.array(labels, np.float32)
    aside = np.zeros(len(texts), bool)
    for label in (0, 1):
        of_label = rng.permutation(np.flatnonzero(target == label))
        aside[of_label[: len(of_label) // 5]] = True
    n_word, t_word, n_gram, t_gram = (np.zeros(n) for n in [len(coded.hashes)] * 2 + [BUCKETS] * 2)
    for i in np.flatnonzero(~aside):
        words = np.unique(coded.word[coded.offsets[i] : coded.offsets[i + 1]])
        size = coded.bounds[words + 1] - coded.bounds[words]
        places = np.arange(int(size.sum())) + np.repeat(coded.bounds[words] - (np.cumsum(size) - size), size)
        grams = np.unique(coded.grams[places])
        n_word[words] += 1
        n_gram[grams] += 1
        t_word[words] += target[i]
        t_gram[grams] += target[i]
    share_toxic = float(target[~aside].mean()) if len(texts) else 0.0

    def lean(n: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        return (toxic - n * share_toxic) / np.sqrt(n * share_toxic * (1 - share_toxic) + 1)

    z_word, z_gram = lean(n_word, t_word), lean(n_gram, t_gram)
    common = np.argsort(-n_word, kind="stable")[:MOST_WORDS]
    common = common[n_word[common] >= KNOWN_FROM]
    common = common[np.argsort(coded.hashes[common])]
    net = Network(coded.hashes[common], z_word[common], z_gram, n_gram >= KNOWN_FROM, seed)
    if len(set(labels)) < 2:
        net.w["out0"][0] = 4.0 if labels and labels[0] else -4.0
        net.w["out"][:] = 0
        return net
    text, first, length = windows(coded)
    lottery = rng.random(len(text))
    order = np.lexsort((lottery, text))
    rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
    chosen = order[rank < SAMPLE_WINDOWS]
    chosen = chosen[~aside[text[chosen]] & (length[chosen] > 0)]
    rows = net.lookup(coded)
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    v = {k: np.zeros_like(x) for k, x in net.w.items()}
    best, queue = (np.inf, None), np.zeros(0, np.int64)
    for turn in range(1, steps + 1):
        if len(queue) < batch:
            queue = np.concatenate([queue, rng.permutation(chosen)])
        some, queue = queue[:batch], queue[batch:]
        places = first[some][:, None] + np.arange(WINDOW)
        inside = np.arange(WINDOW) < length[some][:, None]
        used, word = np.unique(coded.word[np.where(inside, places, first[some][:, None])], return_inverse=True)
        word = word.reshape(places.shape)
        size = np.diff(coded.bounds)[used]
        bounds = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(bounds[-1]) + np.repeat(coded.bounds[used] - bounds[:-1], size)
        grams = coded.grams[at]
        x, share = net.inputs(rows[used], grams, bounds)
        # Some words go unseen, so that no single one carries the decision.
        drop = (rng.random(len(used)) > 0.1).astype(np.float32)[:, None]
        x = x * drop
        projected = x @ net.w["input"] + net.w["input0"]
        flat = np.arange(word.size).reshape(word.shape)
        gates, mask, _ = net.gates(projected[word.ravel()], flat.ravel(), flat[:, 0], length[some])
        goal = target[text[some]]
        _, g, d_x = net.gradients(word, x, gates, mask, goal)
        d_x = d_x * drop
        g["word"] = np.zeros_like(net.w["word"])
        np.add.at(g["word"], rows[used], d_x)
        g["gram"] = np.zeros_like(net.w["gram"])
        np.add.at(g["gram"], grams, np.repeat(d_x * share[:, None], size, axis=0))
        g["gram"] *= net.used[:, None]
        for k, value in net.w.items():
            m[k] += 0.1 * (g[k] - m[k])
            v[k] += 0.01 * (g[k] * g[k] - v[k])
            rate = 0.01 * np.sqrt(1 - 0.99**turn) / (1 - 0.9**turn)
            value -= (rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
            if k in ("word", "gram"):
                value *= 0.9995
        if turn % 32 and turn not in (4, 8, 16):
            continue
        logit = net.logits(coded)
        logit = logit[aside] if aside.any() else logit
        goal = target[aside] if aside.any() else target
        scale, shift = _calibrate(logit, goal)
        p = np.clip(_sigmoid(scale * logit + shift), 1e-6, 1 - 1e-6)
        loss = float(-np.where(goal > 0, np.log(p), np.log(1 - p)).mean())
        if loss < best[0]:
            best = (loss, {k: x.copy() for k, x in net.w.items()}, (scale, shift))
    net.w, net.calibration = best[1], best[2]
    return net


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def sampled_text(text_col: str, key_col: str):
    """The text, or ``SAMPLE_PIECES`` pieces of a long one: one from a seeded place of each equal part."""
    text, part = F.col(text_col), F.floor(F.length(text_col) / SAMPLE_PIECES)
    size = SAMPLE_CHARS // SAMPLE_PIECES

    def piece(k):
        place = F.pmod(F.xxhash64(key_col, k), part - size + 1)
        return F.substr(text, (k * part + place + 1).cast("int"), F.lit(size))

    pieces = F.transform(F.sequence(F.lit(0), F.lit(SAMPLE_PIECES - 1)), piece)
    return F.when(F.length(text_col) > SAMPLE_CHARS, F.array_join(pieces, " ")).otherwise(text)


def training_sample(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> tuple[list[str], list[int]]:
    """Texts and labels of a bounded, seeded sample of rows that aren't held out and have a text."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("key")).agg(F.max(label_col).cast("int").alias("label"))
    most = {1: TOXIC_ROWS, 0: CLEAN_ROWS}
    order = F.xxhash64("key", F.lit(11))
    chosen = [known.where(F.col("label") == c).orderBy(order, "key").limit(n) for c, n in most.items()]
    # At most TOXIC_ROWS + CLEAN_ROWS rows of two numbers.
    ids = F.broadcast(chosen[0].union(chosen[1]))
    texts = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("key"), F.col(text_col).alias("whole"))
    rows = texts.join(ids, "key").select("key", sampled_text("whole", "key").alias("t"), "label")
    rows = rows.groupBy("key").agg(F.min("t").alias("t"), F.max("label").alias("label"))
    got = sorted(rows.toLocalIterator(), key=lambda r: r.key)
    return [r.t for r in got], [r.label for r in got]


def score_toxicity(df: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """Rows (row, score): the row as a struct and its score from 0 to 1, higher for toxic.

    Only the text enters. All its words are read, in overlapping windows. Null and empty texts get
    the score of a window without words. Repeated rows, null ids and columns of any name are carried
    along as they are; an empty table gives an empty table.
    """
    shared = share(df.sparkSession, network)  # of a size that the sample's bounds fix
    packed = df.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    kind = packed.schema["row"].dataType.simpleString()

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, hasher = shared(), Hasher(_MARKS)
        for batch in batches_of(rows, SCORED_BYTES):
            found = net.scores(code(hasher, batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["row", "score"])

    return packed.mapInArrow(score, f"row {kind}, score double")


def toxic_scores(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """Train on a sample of the labelled rows and score all rows."""
    texts, marks = training_sample(df, labels, id_col, text_col, label_col)
    return score_toxicity(df, train(texts, marks), text_col)


def drop_toxic(df: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """Rows of ``df`` below the threshold, with the columns of ``df``."""
    scored = toxic_scores(df, labels, text_col=text_col, **options).where(F.col("score") < THRESHOLD)
    return scored.select(*[F.col(f"row.`{n}`").alias(n) for n in df.columns])
