"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads every text in segments of ``SEGMENT`` bytes in both directions, gives each byte
a probability for each language from the two states there, and a document gets the mean over all
its bytes. It is trained in numpy by backpropagation through time, on the driver, from windows of a
bounded sample: ``SAMPLE`` documents of each language, ``WINDOWS`` windows of ``TRAIN_CHARS``
characters at places chosen by hash, never of documents that are held out.

Defined results: a null text, an empty one or one without a letter is ``und`` with score 0, and so
is everything where nothing can be learned (no row with a language and text); ties go to the
language first by code point; repeated rows get equal answers; a null ``doc_id`` counts as not held
out and is not learned from; an empty table gives no rows. ``predict`` keeps all columns, and
replaces any called lang_pred or score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from findery.scratch import spread

HIDDEN, SEGMENT, BLOCK = 8, 128, 1024
SAMPLE, WINDOWS, TRAIN_CHARS, STEPS, BATCH, TRAIN_BYTES = 300, 4, 96, 450, 128, 64
UNKNOWN = "und"


@dataclass
class Model:
    """``x``: (2 * 256, 3H) input of update, reset and candidate by direction and byte; ``u``: (2, H, 3H); ``o``: (2, H, L); ``b``: (L,)."""

    labels: list[str]
    x: np.ndarray
    u: np.ndarray
    o: np.ndarray
    b: np.ndarray


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(a, -30, 30)))


def _tanh(a: np.ndarray) -> np.ndarray:
    return 2 / (1 + np.exp(np.clip(-2 * a, -60, 60))) - 1


def _train_forward(m: Model, bytes_: np.ndarray):
    """bytes_: (T, B). States and gates of both directions, each in its own order of time."""
    t, n = bytes_.shape
    h, kept = np.zeros((2, n, HIDDEN), np.float32), []
    for i in range(t):
        own = np.stack([bytes_[i], bytes_[t - 1 - i].astype(np.int64) + 256])
        a, r = m.x[own], h @ m.u
        z, g = _sigmoid(a[..., :HIDDEN] + r[..., :HIDDEN]), _sigmoid(a[..., HIDDEN : 2 * HIDDEN] + r[..., HIDDEN : 2 * HIDDEN])
        c = _tanh(a[..., 2 * HIDDEN :] + g * r[..., 2 * HIDDEN :])
        new = c + z * (h - c)
        kept.append((own, h, z, g, c, r[..., 2 * HIDDEN :], new))
        h = new
    return kept


def gradients(m: Model, seen: np.ndarray, wanted: np.ndarray):
    """Loss and its gradients by x, u, o, b: mean cross entropy of every byte of windows ``seen`` (T, B) of languages ``wanted`` (B,), back through time."""
    t, n = seen.shape
    kept = _train_forward(m, seen)
    f, b = np.stack([k[6][0] for k in kept]), np.stack([k[6][1] for k in kept])[::-1]
    logits = f @ m.o[0] + b @ m.o[1] + m.b
    p = np.exp(logits - logits.max(-1, keepdims=True))
    p /= p.sum(-1, keepdims=True)
    loss = -np.log(p[:, np.arange(n), wanted]).mean()
    p[:, np.arange(n), wanted] -= 1
    d = p / (t * n)
    gx, gu = np.zeros_like(m.x), np.zeros_like(m.u)
    go = np.stack([np.einsum("tbh,tbl->hl", f, d), np.einsum("tbh,tbl->hl", b, d)])
    down = np.stack([d @ m.o[0].T, (d @ m.o[1].T)[::-1]], 1)  # by each direction's own time
    dh = np.zeros((2, n, HIDDEN), m.u.dtype)
    for i in range(t - 1, -1, -1):
        own, h, z, g, c, rc, _ = kept[i]
        dh = dh + down[i]
        dz, dc = dh * (h - c) * z * (1 - z), dh * (1 - z) * (1 - c * c)
        dg = dc * rc * g * (1 - g)
        da = np.concatenate([dz, dg, dc], -1)
        dr = np.concatenate([dz, dg, dc * g], -1)
        np.add.at(gx, own.ravel(), da.reshape(-1, 3 * HIDDEN))
        gu += h.transpose(0, 2, 1) @ dr
        dh = dh * z + dr @ m.u.transpose(0, 2, 1)
    return loss, (gx, gu, go, d.sum((0, 1)))


def train(texts: list[bytes], targets: np.ndarray, labels: list[str], steps: int = STEPS, seed: int = 5) -> Model:
    """Adam over random windows, the languages in turn: all of them, however many there are to a step."""
    rng, classes = np.random.default_rng(seed), len(labels)
    init = lambda *s, by=0.3: (rng.standard_normal(s) * by).astype(np.float32)
    m = Model(labels, init(512, 3 * HIDDEN), init(2, HIDDEN, 3 * HIDDEN), init(2, HIDDEN, classes), np.zeros(classes, np.float32))
    texts = [t if len(t) >= TRAIN_BYTES else (t * (TRAIN_BYTES // max(1, len(t)) + 1))[:TRAIN_BYTES] for t in texts]
    of = [np.flatnonzero(targets == k) for k in range(classes)]
    weights = (m.x, m.u, m.o, m.b)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        who = np.array([rng.choice(of[k]) for k in rng.permutation(np.arange((step - 1) * BATCH, step * BATCH) % classes)])
        at = [rng.integers(0, len(texts[i]) - TRAIN_BYTES + 1) for i in who]
        seen = np.stack([np.frombuffer(texts[i], np.uint8, TRAIN_BYTES, s) for i, s in zip(who, at, strict=True)], 1)
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, (a, v) in zip(weights, gradients(m, seen, targets[who])[1], moments, strict=True):
            g = np.clip(g, -0.5, 0.5)
            a += 0.1 * (g - a)
            v += 0.001 * (g * g - v)
            w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return m


def segment_sums(m: Model, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over each segment's bytes of the probabilities at each: (segments, languages)."""
    t, h3 = int(sizes.max(initial=0)), 3 * HIDDEN
    at = np.minimum(starts[:, None] + np.arange(t), max(0, len(data) - 1))
    seen, there = data[at].T.astype(np.intp), (np.arange(t)[:, None] < sizes).astype(np.float32)
    n = len(starts)
    # sigmoid(a) = 1 / (1 + exp(-a)), tanh(a) = 2 / (1 + exp(-2a)) - 1: all signs and factors go into the weights
    sign = np.r_[np.full(2 * HIDDEN, -1), np.full(HIDDEN, -2)].astype(np.float32)
    x, u = m.x * sign, m.u * sign
    h, states = np.zeros((2, n, HIDDEN), np.float32), np.empty((2, t, n, HIDDEN), np.float32)
    whole = bool(there.all())
    with np.errstate(over="ignore"):
        for i in range(t):
            j = t - 1 - i
            a = np.take(x, np.concatenate([seen[i], seen[j] + 256]), 0).reshape(2, n, h3)
            r = h @ u
            gates = a[..., : 2 * HIDDEN] + r[..., : 2 * HIDDEN]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            c = gates[..., HIDDEN:] * r[..., 2 * HIDDEN :]
            c += a[..., 2 * HIDDEN :]
            np.exp(c, out=c)
            c += 1
            np.divide(2, c, out=c)
            c -= 1
            h -= c
            h *= gates[..., :HIDDEN]
            h += c
            if not whole:
                h[1] *= there[j, :, None]
            states[0, i], states[1, j] = h[0], h[1]
    logits = states[0] @ m.o[0] + states[1] @ m.o[1] + m.b
    logits -= logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(-1, keepdims=True)
    if not whole:
        logits *= there[..., None]
    return logits.sum(0, dtype=np.float64)


def probabilities(m: Model, texts: pa.Array) -> np.ndarray:
    """Mean over all bytes of each text: (texts, languages); zeros for empty texts."""
    texts = texts.fill_null("").cast(pa.large_binary())
    out = np.zeros((len(texts), len(m.labels)))
    if not len(texts):
        return out
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    count = -(-sizes // SEGMENT)
    doc = np.repeat(np.arange(len(sizes)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    starts = offsets[doc] + inside * SEGMENT
    lengths = np.minimum(SEGMENT, offsets[doc + 1] - starts)
    for a in range(0, len(starts), BLOCK):
        part = slice(a, a + BLOCK)
        np.add.at(out, doc[part], segment_sums(m, data, starts[part], lengths[part]))
    return out / np.maximum(sizes, 1)[:, None]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> Model | None:
    """A model from ``doc_id, text, lang``: of each language ``sample`` documents by id hash.

    Of a language's n documents those go on whose hash modulo n is small, about twice as many as
    are asked for, so that what meets in one task doesn't grow with the table.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id")))
    hashed = usable.select("lang", "text", F.xxhash64("doc_id", F.lit("sample")).alias("h"))
    counts = usable.groupBy("lang").count().collect()  # a row per language, as many as the model tells apart
    if not counts:
        return None
    count = F.create_map(*(F.lit(x) for r in counts for x in (r["lang"], r["count"])))
    some = hashed.withColumn("c", count[F.col("lang")]).filter(F.pmod("h", "c") < 2 * sample)
    place = lambda k: F.pmod(F.xxhash64("h", F.lit(k)), F.greatest(F.lit(1), F.length("text") - TRAIN_CHARS)) + 1
    cut = F.concat_ws(" ", *(F.substr("text", place(k).cast("int"), F.lit(TRAIN_CHARS)) for k in range(WINDOWS)))
    first = W.partitionBy("lang").orderBy(F.pmod("h", "c"), "cut")
    rows = some.select("lang", "h", "c", cut.alias("cut")).withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample).collect()
    rows = sorted((r["lang"], r["n"], r["cut"]) for r in rows)
    labels = sorted({r[0] for r in rows})
    return train([r[2].encode() for r in rows], np.array([labels.index(r[0]) for r in rows]), labels, steps)


def _predict(m: Model | None):
    def run(batches):
        for b in batches:
            letters = np.array([t is not None and any(map(str.isalpha, t)) for t in b["text"].to_pylist()], dtype=bool)
            lang, score = np.full(len(b), UNKNOWN, dtype=object), np.zeros(len(b))
            if m is not None and letters.any():
                p = probabilities(m, b["text"])
                best = p.argmax(1)
                lang[letters] = np.array(m.labels, dtype=object)[best[letters]]
                score[letters] = np.clip(p[np.arange(len(b)), best], 0, 1)[letters]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns, and ``lang_pred, score``: from ``text`` alone."""
    docs = docs.drop("lang_pred", "score")
    shape = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return spread(docs).mapInArrow(_predict(model), f"{shape}, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs.select("doc_id", "text"), learn(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
