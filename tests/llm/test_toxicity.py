import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa

from ripplelog.llm import toxicity as T
from ripplelog.llm.frames import batches_of
from ripplelog.llm.words import Hasher


def labelled(n, seed):
    """Texts of invented words; toxic ones hold marked words, or words with a marked stem."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    texts, labels = [], []
    for i in range(n):
        words, toxic = [word() for _ in range(rng.randint(10, 150))], int(i % 4 == 0)
        for _ in range(max(1, len(words) // 25) if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(["grrr", "zonk", "quoth" + word()])
        texts.append(" ".join(words))
        labels.append(toxic)
    return texts, labels


def test_gradients_equal_differences():
    texts, labels = labelled(8, 1)
    coded = T.code(Hasher(T._MARKS), pa.array(texts))
    net = T.Network(coded.hashes[:0], np.zeros(0), np.zeros(T.BUCKETS), np.ones(T.BUCKETS, bool), 3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    text, first, length = T.windows(coded)
    goal = np.array(labels, np.float64)[text]

    def run():
        x, _ = net.inputs(net.lookup(coded), coded.grams, coded.bounds)
        gates, mask, rows = net.gates(x @ net.w["input"] + net.w["input0"], coded.word, first, length)
        return net.gradients(rows, x, gates, mask, goal)

    net.w["look"] += 0.5
    _, grads, _ = run()
    rng = np.random.default_rng(0)
    for name in ("state", "look", "out", "out0", "input", "input0"):
        w = net.w[name]
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in w.shape)
            old, step = w[at], 1e-2
            w[at] = old + step
            up = run()[0]
            w[at] = old - step
            down = run()[0]
            w[at] = old
            slope = (up - down) / (2 * step)
            assert abs(slope - grads[name][at]) < 2e-3 + 0.05 * abs(slope), name


def test_windows_cover_every_word():
    coded = T.code(Hasher(T._MARKS), pa.array([None, "", "a", "b " * 32, "c " * 33, "d " * 500]))
    text, first, length = T.windows(coded)
    assert set(text) == set(range(6))
    seen = {(t, p) for t, f, n in zip(text, first, length) for p in range(f, f + n)}
    assert len(seen) == 1 + 32 + 33 + 500
    assert (length <= T.WINDOW).all() and sorted(first[text == 4] - coded.offsets[4]) == [0, 16]


def test_held_out_accuracy(spark):
    texts, labels = labelled(1600, 2)
    long = " ".join(labelled(40, 5)[0][1::4] * 8)
    net = T.train(texts[:1200], labels[:1200])
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts[1200:] + [long + " zonk grrr " + long])], "doc_id long, text string")
    got = {r.row.doc_id: r.score for r in T.score_toxicity(df, net).collect()}
    right = [(got[i] >= T.THRESHOLD) == bool(y) for i, y in enumerate(labels[1200:])]
    assert sum(right) / len(right) > 0.93
    assert got[400] >= T.THRESHOLD  # two words far inside a long text


def test_only_texts_enter_and_folds_hold(spark):
    texts, labels = labelled(300, 3)
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)], "doc_id long, toxic int")
    sample, _ = T.training_sample(docs, marks)
    assert set(sample) <= {t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 4 != 2}
    held = {r.doc_id for r in docs.where(T.held_out("doc_id")).collect()}
    assert held == {i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_long_texts_teach_from_all_over(spark):
    words = [f"word{i}" for i in range(40_000)]
    texts = [" ".join(words), "short text", None]
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 4 != 2][:3]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    marks = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id long, toxic int")
    sample, labels = T.training_sample(docs, marks)
    assert sample[1] == texts[1] and labels == [0, 1]
    assert len(sample[0]) == T.SAMPLE_CHARS + T.SAMPLE_PIECES - 1
    size = T.SAMPLE_CHARS // T.SAMPLE_PIECES
    pieces = [sample[0][k * (size + 1) :][:size] for k in range(T.SAMPLE_PIECES)]
    part = len(texts[0]) // T.SAMPLE_PIECES
    assert all(part * k <= texts[0].find(x) <= part * (k + 1) - size for k, x in enumerate(pieces))


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(0, 1), (1, 0), (4, 0), (5, None), (6, 1), (None, 1)], "doc_id long, toxic int")
    got = T.toxic_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if not (r.row.text or "").strip()}) == 1
    assert T.drop_toxic(odd, labels).columns == odd.columns
    assert T.toxic_scores(odd, labels.limit(0)).count() == odd.count()
    assert T.toxic_scores(odd.limit(0), labels).collect() == []


def test_scoring_takes_the_memory_of_a_part_of_the_texts():
    """Other tasks and the JVM share an executor's memory with the worker."""
    rng = np.random.default_rng(3)
    texts = pa.array([" ".join(f"w{n}" for n in rng.integers(0, 50_000, 300)) for _ in range(2400)])
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    net = T.Network(np.zeros(0, np.uint64), np.zeros(0), np.zeros(T.BUCKETS), np.ones(T.BUCKETS), 1)
    hasher = Hasher(T._MARKS)
    tracemalloc.start()
    parts = [net.scores(T.code(hasher, b.column(0))) for b in batches_of(iter([batch]), T.SCORED_BYTES)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6
    assert np.abs(np.concatenate(parts) - net.scores(T.code(hasher, texts))).max() < 1e-5
