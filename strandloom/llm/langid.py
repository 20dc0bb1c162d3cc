"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

It is trained by backpropagation through time on a bounded sample of labelled
documents, labels every byte of a text, and pools the label probabilities of
all bytes to those of the document. Texts are cut into pieces of PIECE bytes
that run side by side; every byte of every text is labelled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import aside, pin, small, small_batches
from .setjoin import slices

#: The bounded sample: documents of each language, characters of each of them, and documents in all. With many languages each has fewer documents.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS, SAMPLE_IN_ALL = 400, 600, 40_000
HIDDEN, PIECE, SIDE_BY_SIDE = 8, 128, 4096
STEPS, BATCH, SPAN, RATE = 300, 128, 64, 0.02
#: Spans that training sees of each language at least, however many languages there are.
SPANS_EACH = 300
UNDETERMINED = "und"


def held_out(id_column: Column) -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Model:
    """``langs``; per direction W (3H x 256: a column per byte, bias included), U (3H x H); the output layer O (L x 2H) and its bias."""

    langs: list[str]
    forward: tuple[np.ndarray, np.ndarray]
    backward: tuple[np.ndarray, np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def _sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def _run(w, u, x):
    """States of one direction over x (T x B bytes), with what the way back needs."""
    hidden = u.shape[1]
    h, kept = np.zeros((hidden, x.shape[1]), np.float32), []
    for row in x:
        g = w[:, row]
        a = _sigmoid(g[: 2 * hidden] + u[: 2 * hidden] @ h)
        r, z = a[:hidden], a[hidden:]
        n = np.tanh(g[2 * hidden :] + u[2 * hidden :] @ (r * h))
        kept.append((h, r, z, n))
        h = n + z * (h - n)
    return [*(k[0] for k in kept[1:]), h], kept


def _back(w, u, x, kept, from_above):
    """Gradients of W and U by backpropagation through time."""
    hidden = u.shape[1]
    dw, du, carry = np.zeros_like(w), np.zeros_like(u), 0.0
    pre = np.empty((len(x), w.shape[0], x.shape[1]), np.float32)
    for t in range(len(x) - 1, -1, -1):
        h, r, z, n = kept[t]
        d = from_above[t] + carry
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        drh = u[2 * hidden :].T @ dn
        dr = drh * h * r * (1 - r)
        pre[t] = np.concatenate([dr, dz, dn])
        du[: 2 * hidden] += pre[t, : 2 * hidden] @ h.T
        du[2 * hidden :] += dn @ (r * h).T
        carry = d * z + drh * r + u[: 2 * hidden].T @ pre[t, : 2 * hidden]
    flat = pre.transpose(1, 0, 2).reshape(w.shape[0], -1)
    order = np.argsort(x.ravel(), kind="stable")
    seen, starts = np.unique(x.ravel()[order], return_index=True)
    dw[:, seen] = np.add.reduceat(flat[:, order], starts, axis=1)
    return dw, du


def fit(texts: list[str], langs: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, span: int = SPAN, rate: float = RATE, seed: int = 3) -> Model:
    """Train on (text, lang) pairs with Adam; every byte has its document's language as label. Reruns agree."""
    names = sorted({lang for t, lang in zip(texts, langs, strict=True) if t})
    steps = max(steps, -(-SPANS_EACH * len(names) // batch))
    rng = np.random.default_rng(seed)
    by_lang = [[np.frombuffer(t.encode(), np.uint8) for t, l in zip(texts, langs, strict=True) if l == name and t] for name in names]
    f = lambda *shape: (rng.normal(size=shape) * 0.3).astype(np.float32)
    w1, w2, u1, u2 = f(3 * hidden, 256), f(3 * hidden, 256), f(3 * hidden, hidden), f(3 * hidden, hidden)
    b1, b2, o, c = np.zeros((3 * hidden, 1), np.float32), np.zeros((3 * hidden, 1), np.float32), f(len(names), 2 * hidden), np.zeros((len(names), 1), np.float32)
    params = [w1, w2, u1, u2, b1, b2, o, c]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        # Languages take turns, so a frequent one does not drown the others.
        label = (np.arange(batch) + (step - 1) * batch) % len(names)
        x = np.zeros((span, batch), np.uint8)
        for i, k in enumerate(label):
            source = by_lang[k][rng.integers(len(by_lang[k]))]
            start = rng.integers(max(1, len(source) - span + 1))
            x[:, i] = np.resize(source[start : start + span], span)
        hf, kept1 = _run(w1 + b1, u1, x)
        hb, kept2 = _run(w2 + b2, u2, x[::-1])
        states = np.stack([np.concatenate(p) for p in zip(hf, hb[::-1], strict=True)])
        logits = o @ states + c
        e = np.exp(logits - logits.max(axis=1, keepdims=True))
        d = e / e.sum(axis=1, keepdims=True)
        d[:, label, np.arange(batch)] -= 1
        d /= span * batch
        go, gc = np.einsum("tlb,thb->lh", d, states), d.sum(axis=(0, 2))[:, None]
        above = o.T @ d
        gw1, gu1 = _back(w1, u1, x, kept1, above[:, :hidden])
        gw2, gu2 = _back(w2, u2, x[::-1], kept2, above[::-1, hidden:])
        grads = [gw1, gw2, gu1, gu2, gw1.sum(1, keepdims=True), gw2.sum(1, keepdims=True), go, gc]
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(params, grads, m, v, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return Model(names, (w1 + b1, u1), (w2 + b2, u2), o, c)


def _halved(w, u):
    """Gates are computed as (tanh(x / 2) + 1) / 2; the first half goes into the weights."""
    hidden = u.shape[1]
    scale = np.ones((3 * hidden, 1), np.float32)
    scale[: 2 * hidden] = 0.5
    return np.ascontiguousarray(w * scale), np.ascontiguousarray((u * scale)[: 2 * hidden]), np.ascontiguousarray(u[2 * hidden :])


def _step(weights, row, h):
    w, gates, new = weights
    hidden = len(h)
    g = w.take(row, axis=1)
    a = gates @ h
    a += g[: 2 * hidden]
    np.tanh(a, out=a)
    a *= 0.5
    a += 0.5
    n = new @ (a[:hidden] * h)
    n += g[2 * hidden :]
    np.tanh(n, out=n)
    h -= n
    h *= a[hidden:]
    h += n


def label_bytes(model: Model, pieces: list[np.ndarray], every_label: bool = False):
    """Summed label probabilities (L x pieces), and the label of every byte if asked for. Pieces come longest first."""
    sizes = np.array([len(p) for p in pieces])
    steps, hidden = int(sizes[0]), model.forward[1].shape[1]
    x = np.zeros((steps, len(pieces)), np.uint8)
    for i, p in enumerate(pieces):
        x[: len(p), i] = p
    active = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(steps)]  # pieces longer than t
    one, two = _halved(*model.forward), _halved(*model.backward)
    h, states = np.zeros((hidden, len(pieces)), np.float32), []
    for t in range(steps):
        h = np.ascontiguousarray(h[:, : active[t]])
        _step(one, x[t, : active[t]], h)
        states.append(h.copy())
    total, back = np.zeros((len(model.langs), len(pieces)), np.float32), np.zeros((hidden, 0), np.float32)
    labels = np.zeros(x.shape, np.int16) if every_label else None
    left, right = np.ascontiguousarray(model.out[:, :hidden]), np.ascontiguousarray(model.out[:, hidden:])
    for t in range(steps - 1, -1, -1):
        n = active[t]
        if back.shape[1] < n:
            back = np.concatenate([back, np.zeros((hidden, n - back.shape[1]), np.float32)], axis=1)
        _step(two, x[t, :n], back)
        p = left @ states.pop()
        p += right @ back
        p += model.bias
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        total[:, :n] += p
        if every_label:
            labels[t, :n] = p.argmax(axis=0)
    return (total, [labels[: len(p), i] for i, p in enumerate(pieces)]) if every_label else (total, None)


def document_probabilities(model: Model, texts: list[str]) -> np.ndarray:
    """L x texts: the mean label probabilities of all bytes; 0 for empty texts."""
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    cut = [(i, r[a : a + PIECE]) for i, r in enumerate(raw) for a in range(0, len(r), PIECE)]
    cut.sort(key=lambda x: -len(x[1]))
    total = np.zeros((len(texts), len(model.langs)))
    for start in range(0, len(cut), SIDE_BY_SIDE):
        part = cut[start : start + SIDE_BY_SIDE]
        found, _ = label_bytes(model, [p for _, p in part])
        np.add.at(total, [i for i, _ in part], found.T)
    return (total / np.maximum([len(r) for r in raw], 1)[:, None]).T


def label_text(model: Model, text: str) -> list[str]:
    """The language of every byte of a text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    pieces = [raw[a : a + PIECE] for a in range(0, len(raw), PIECE)]
    if not pieces:
        return []
    return [model.langs[k] for labels in label_bytes(model, pieces, every_label=True)[1] for k in labels]


#: Parts that a language's rows are dealt into while the sample is drawn.
PARTS = 16
#: How many times the wanted rows of a language pass the bound of the hash.
SPARE = 8


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, documents: int, characters: int, in_all: int = SAMPLE_IN_ALL) -> DataFrame:
    """Up to ``documents`` of each language, by a hash of the id, and of each a span of ``characters`` from a hashed place.

    A column of very many different values gives fewer of each, one at least,
    and ``in_all`` documents at most. Languages are counted first, and a bound of
    the hash lets by only SPARE times as many rows of each as are wanted, so what
    is shuffled does not grow with the corpus; repeated rows and rows with one id
    share a hash and stand beside each other.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    usable = own.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = pin(usable.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_n")))
    documents = max(1, min(documents, in_all // max(1, counts.limit(in_all).count())))
    h = F.when(F.col("id").isNull(), F.xxhash64("text", F.lit(11))).otherwise(F.xxhash64("id", F.lit(11)))
    bound = F.least(F.lit(1.0), F.lit(float(SPARE * documents)) / F.col("_n")) * float(1 << 31)
    span = F.expr(f"substr(text, cast(1 + pmod(xxhash64(id, 5), greatest(length(text) - {characters}, 1)) as int), {characters})")
    few = usable.join(small(counts), F.col("lang") == F.col("_lang")).filter(F.shiftrightunsigned(h, 33) < bound)
    spans = few.select("lang", span.alias("text"), h.alias("_h"))
    # First of each language's parts, then of the language: the last task of a language reads PARTS * documents rows at most, however large the corpus.
    order = Window.orderBy("_h", "text")
    parts = spans.withColumn("_part", F.pmod("_h", F.lit(PARTS)))
    few = parts.withColumn("_r", F.row_number().over(order.partitionBy("lang", "_part"))).filter(F.col("_r") <= documents).drop("_r")
    return few.withColumn("_r", F.row_number().over(order.partitionBy("lang"))).filter(F.col("_r") <= documents).select("lang", "text").limit(in_all)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", documents: int = SAMPLE_DOCUMENTS, characters: int = SAMPLE_CHARACTERS, **options) -> Model | None:
    """A model from a sample of ``docs``, None if they have no labelled text. The sample's bound does not depend on the corpus."""
    rows = sorted(training_sample(docs, id_col, text_col, lang_col, documents, characters).collect())
    return fit([r["text"] for r in rows], [r["lang"] for r in rows], **options) if rows else None


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the pooled probability of that language.

    Null texts and texts without letters, and all texts if nothing was learned,
    are ``und`` with score 0. Only the text is looked at; columns of ``docs``
    with these two names are replaced. A pure map over the scan.
    """
    small_batches(docs.sparkSession)
    kept = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = kept.columns
    place = names.index(text_col)

    def run(batches):
        net = shared.value
        for batch in slices(batches, 1_024):
            texts = batch.column(place).to_pylist()
            ask = [i for i, t in enumerate(texts) if net is not None and has_letter(t)]
            langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if ask:
                p = document_probabilities(net, [texts[i] for i in ask])
                for i, k, s in zip(ask, p.argmax(axis=0).tolist(), p.max(axis=0).tolist(), strict=True):
                    langs[i], scores[i] = net.langs[k], min(s, 1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    schema = kept.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return kept.mapInArrow(run, schema)


def least_score(languages: int, most: float = 0.4, chance: float = 1.6) -> float:
    """The least pooled score at which a language counts as recognised: ``chance`` times what guessing has, ``most`` at most."""
    return min(most, chance / max(languages, 1))


def identified(docs: DataFrame, model: Model | None, least: float | None = None, text_col: str = "text") -> DataFrame:
    """The documents whose language is recognised with a score of at least ``least`` (None: ``least_score``); columns as they were."""
    names = docs.columns
    least = least_score(len(model.langs) if model else 0) if least is None else least
    found = predict(aside(docs), model, f"_{names.index(text_col)}")
    return found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least)).drop("lang_pred", "score").toDF(*names)
