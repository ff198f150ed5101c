"""Toxic spans by a linear-chain conditional random field over words.

Tags are clean (0) and toxic (1).  A word's features are hashes of the word,
of its first 3 to 6 bytes and of its last 4 bytes; the chain runs over the
words of a segment (up to a sentence end, a line end or ``CHAIN`` words).  Only
documents are labelled, so token labels for training are derived first: a word
of a toxic document is tagged toxic if one of its features occurs in toxic
documents more often than chance allows over all features tested.  The field
is fitted to those tags by gradient descent with exact forward-backward
expectations.

A document's score comes from its marginals: a logistic function of the
largest one and of the sum of those of one half or more, fitted to the document labels of training rows
that the field has not seen.  Words with a marginal of one half or more make
up the offending spans, as byte offsets into the UTF-8 text.

Everything runs on arrays of a slice of documents at once: features by prefix
sums, the chains of all segments in step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelworks.llm.words import ALPHANUMERIC, U, Words, find_words, mix64, shingles, slices

#: Labelled rows learnt from at most (smallest hashes of the id), weights, chain length.
SAMPLE, BUCKETS, CHAIN = 6000, 1 << 18, 64
EPOCHS, RATE, DECAY = 12, 0.3, 1e-6
#: Intercept and slopes of a document's score before any row that the field has not seen.
PRIOR = np.array([-2.0, 4.0, 0.0])
_PREFIXES, _SUFFIX = (3, 4, 5, 6), 4
_ENDS = np.zeros(256, bool)
_ENDS[[10, 13, 33, 46, 63]] = True  # line ends and . ! ?


def features(words: Words) -> np.ndarray:
    """(features, words) buckets; a word too short for a feature has that of
    the whole word there."""
    start, end = words.start, words.end
    own = words.spans(start, end)
    out = np.empty((len(_PREFIXES) + 2, len(start)), np.int32)

    def bucket(h: np.ndarray, kind: int) -> np.ndarray:
        return (mix64(h + U(kind)) & U(BUCKETS - 1)).astype(np.int32)

    out[0] = bucket(own, 1)
    for i, n in enumerate(_PREFIXES):
        out[i + 1] = bucket(words.spans(start, np.minimum(start + n, end)), 2 + i)
    out[-1] = bucket(words.spans(np.maximum(end - _SUFFIX, start), end), 9)
    return out


def segments(words: Words) -> np.ndarray:
    """First words of chains, with the number of words at the end."""
    n = len(words.start)
    if not n:
        return np.zeros(1, np.int64)
    ends = np.concatenate(([0], np.cumsum(_ENDS[words.data])))
    new = np.zeros(n, bool)
    new[words.first[:-1][words.first[:-1] < words.first[1:]]] = True
    new[1:] |= ends[words.start[1:]] > ends[words.end[:-1]]
    first = np.flatnonzero(new)
    at = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    return np.append(np.flatnonzero(at % CHAIN == 0), n)


def marginals(unary: np.ndarray, borders: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of tag 1 of each word, and the sum over neighbouring words of
    the chances of their four tag pairs.  ``unary``: log weight of tag 1
    against tag 0; ``trans``: log weights of pairs.  All chains advance in
    step, longest first."""
    n = len(unary)
    pairs = np.zeros((2, 2))
    if not n:
        return np.zeros(0), pairs
    first, size = borders[:-1], np.diff(borders)
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    e = np.exp(np.clip(unary, -30, 30))
    t = np.exp(trans)
    a = np.empty((2, n))  # forward, scaled to a sum of one
    b = np.ones((2, n))  # backward, scaled alike
    live = [int(np.searchsorted(-size, -k, "left")) for k in range(int(size[0]) + 1)]  # chains longer than k
    f0, f1 = np.ones(len(first)), e[first]
    for k in range(int(size[0])):
        m = live[k]
        at = first[:m] + k
        if k:
            p0, p1 = f0[:m], f1[:m]
            f0, f1 = p0 * t[0, 0] + p1 * t[1, 0], (p0 * t[0, 1] + p1 * t[1, 1]) * e[at]
        s = f0 + f1
        f0, f1 = f0 / s, f1 / s
        a[0, at], a[1, at] = f0, f1
    for k in range(int(size[0]) - 2, -1, -1):
        at = first[: live[k + 1]] + k
        n0, n1 = b[0, at + 1], b[1, at + 1] * e[at + 1]
        b0, b1 = t[0, 0] * n0 + t[0, 1] * n1, t[1, 0] * n0 + t[1, 1] * n1
        q = [[a[0, at] * t[0, 0] * n0, a[0, at] * t[0, 1] * n1], [a[1, at] * t[1, 0] * n0, a[1, at] * t[1, 1] * n1]]
        z = q[0][0] + q[0][1] + q[1][0] + q[1][1]
        pairs += [[(x / z).sum() for x in row] for row in q]
        s = b0 + b1
        b[0, at], b[1, at] = b0 / s, b1 / s
    both = a * b
    return both[1] / both.sum(0), pairs


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    link: np.ndarray  # intercept, largest marginal, log of 1 + sum of marginals of one half or more

    def words(self, words: Words) -> np.ndarray:
        unary = self.weights[features(words)].sum(0) + self.bias
        return marginals(unary.astype(float), segments(words), self.trans)[0]

    def score(self, most: np.ndarray, total: np.ndarray) -> np.ndarray:
        z = self.link[0] + self.link[1] * most + self.link[2] * np.log1p(total)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _document_marginals(words: Words, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    most, total = np.zeros(words.n), np.zeros(words.n)
    some = np.flatnonzero(np.diff(words.first) > 0)
    if len(some):
        most[some] = np.maximum.reduceat(p, words.first[some])
        total[some] = np.add.reduceat(np.where(p >= 0.5, p, 0.0), words.first[some])  # not the many small ones of a long text
    return most, total


def telling_features(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each bucket, whether it occurs in toxic documents beyond chance.
    ``found``: (buckets of a slice, documents of its words, their labels)."""
    in_toxic, in_all = np.zeros(BUCKETS), np.zeros(BUCKETS)
    docs = toxic = 0
    for f, text_no, y in found:
        docs, toxic = docs + len(y), toxic + int(y.sum())
        key = np.unique((text_no.astype(np.int64) * BUCKETS + f).ravel())
        doc, bucket = key // BUCKETS, key % BUCKETS
        in_all += np.bincount(bucket, minlength=BUCKETS)
        in_toxic += np.bincount(bucket[y[doc] == 1], minlength=BUCKETS)
    base = min(max(toxic / max(docs, 1), 1e-3), 0.999)
    rate = in_toxic / np.maximum(in_all, 1)
    inner = np.clip(rate, 1e-9, 1 - 1e-9)
    apart = inner * np.log(inner / base) + (1 - inner) * np.log((1 - inner) / (1 - base))
    tested = max(int((in_all > 0).sum()), 1)
    return (rate > base) & (rate >= 0.5) & (in_all * apart >= np.log(20 * tested))


def distinct_rows(texts: pa.Array) -> np.ndarray:
    """Which texts to learn from: of copies and near copies only the first,
    as a passage that is repeated is no further evidence.  A text counts as
    one if the smallest of its 5-word shingles under one of four hashes is
    that of an earlier text."""
    keep, seen = np.ones(len(texts), bool), [set() for _ in range(4)]
    for lo, hi, data, borders in slices(texts):
        flat, at = shingles(find_words(data, borders, ALPHANUMERIC), 5)
        hashes = [mix64(flat ^ U(0x9E3779B97F4A7C15 * (2 * r + 1) & 0xFFFFFFFFFFFFFFFF)) for r in range(4)]
        for d in range(hi - lo):
            if at[d] < at[d + 1]:
                least = [int(h[at[d] : at[d + 1]].min()) for h in hashes]
                keep[lo + d] = not any(x in s for x, s in zip(least, seen, strict=True))
                for x, s in zip(least, seen, strict=True):
                    s.add(x)
    return keep


def train(texts: pa.Array, toxic: np.ndarray) -> Model:
    """A model from whole texts and their labels; a quarter of them, every
    fourth, is kept from the field and fits the document score."""
    keep = distinct_rows(texts)
    texts, toxic = texts.filter(pa.array(keep)), toxic[keep]
    kept = np.arange(len(toxic)) % 4 == 3
    model = Model(np.zeros(BUCKETS, np.float32), -2.0, np.zeros((2, 2)), PRIOR)
    if not len(toxic):
        return model
    own = texts.filter(pa.array(~kept))
    parts, labels = [], toxic[~kept]
    for lo, hi, data, borders in slices(own, 1 << 18):
        w = find_words(data, borders, ALPHANUMERIC)
        parts.append((features(w), w.text_no, labels[lo:hi], segments(w)))
    telling = telling_features([p[:3] for p in parts])
    tags = [(telling[f].any(0) & (y[text_no] == 1)).astype(float) for f, text_no, y, _ in parts]
    weights, power = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8)
    trans, trans_power = np.zeros((2, 2)), np.full((2, 2), 1e-8)
    bias, bias_power = -2.0, 1e-8
    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(parts)):
            f, _, _, borders = parts[i]
            if not f.shape[1]:
                continue
            p, pairs = marginals(weights[f].sum(0) + bias, borders, trans)
            gap = p - tags[i]
            grad = np.zeros(BUCKETS)
            for row in f:
                grad += np.bincount(row, gap, BUCKETS)
            grad += DECAY * weights * len(gap)
            power += grad * grad
            weights -= RATE * grad / np.sqrt(power)
            bias_power += gap.sum() ** 2
            bias -= RATE * gap.sum() / np.sqrt(bias_power)
            y = tags[i].astype(int)
            inner = np.ones(len(y), bool)
            inner[borders[:-1]] = False
            here = np.flatnonzero(inner)
            seen = np.bincount(2 * y[here - 1] + y[here], minlength=4).reshape(2, 2)
            grad = pairs - seen
            trans_power += grad * grad
            trans -= RATE * grad / np.sqrt(trans_power)
    model = Model(weights.astype(np.float32), float(bias), trans, model.link)
    rest, y = texts.filter(pa.array(kept)), toxic[kept]
    most, total = [np.zeros(0)], [np.zeros(0)]
    for _, _, data, borders in slices(rest):
        w = find_words(data, borders, ALPHANUMERIC)
        m, s = _document_marginals(w, model.words(w))
        most.append(m)
        total.append(s)
    model.link = _logistic(np.column_stack((np.ones(len(y)), np.concatenate(most), np.log1p(np.concatenate(total)))), y)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps, with a small ridge towards
    ``PRIOR``, which few rows hardly move and none leave as it is."""
    w = PRIOR.copy()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * (w - PRIOR))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE, max_bytes: int = 64 << 20) -> Model:
    """Learn from ``docs`` (doc_id, text) labelled in ``labels`` (doc_id,
    toxic): the ``sample`` labelled rows with the smallest hashes of doc_id
    among those where ``learn`` holds, less those that would bring the text
    taken before them over ``max_bytes`` bytes.  Rows with a null id, text or label teach
    nothing."""
    marked = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__y")).where(learn_on(learn, "__id") & F.col("__y").isNotNull())
    order = F.xxhash64(F.col("__id"), F.lit(13))
    first = marked.withColumn("__h", order).orderBy("__h", "__id", "__y").limit(sample)
    rows = docs.join(F.broadcast(first), docs["doc_id"] == F.col("__id"))  # at most ``sample`` rows
    rows = rows.where(F.col("text").isNotNull()).select("__h", "__id", "__y", docs["text"].alias("text"), F.octet_length(docs["text"]).alias("__n"))
    key = ["__h", "__id", "__y", "__t"]
    rows = rows.withColumn("__t", F.xxhash64("text"))
    taken, total, whole = [], 0, True
    for *own, n in rows.groupBy(*key).agg(F.sum("__n")).orderBy(*key).collect():
        if total + n <= max_bytes:
            taken.append(tuple(own))
            total += n
        else:
            whole = False
    if not whole:
        fits = docs.sparkSession.createDataFrame(taken, rows.select(*key).schema)
        rows = rows.join(F.broadcast(fits), key, "left_semi")
    table = rows.orderBy("__h", "__id", "__y", "text").select("text", F.col("__y")).toArrow()
    texts = table.column("text").combine_chunks()
    texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
    return train(texts, table.column("__y").to_numpy().astype(int))


def learn_on(learn: Column, name: str) -> Column:
    """``learn`` is written on the column ``__id`` of the labels."""
    return learn & F.col(name).isNotNull()


def _score(model):
    def run(batches):
        m = model.value
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1)):
                w = find_words(data, borders, ALPHANUMERIC)
                p = m.words(w)
                score = m.score(*_document_marginals(w, p))
                at = np.flatnonzero(p >= 0.5)
                text_no = np.searchsorted(w.first, at, "right") - 1
                base = borders[text_no]
                spans = pa.StructArray.from_arrays(
                    [pa.array(w.start[at] - base), pa.array(w.end[at] - base), pa.array(p[at])], ["start", "end", "chance"]
                )
                ends = np.searchsorted(text_no, np.arange(hi - lo + 1), "left").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(score), pa.ListArray.from_arrays(pa.array(ends), spans)],
                    ["doc_id", "score", "spans"],
                )

    return run


def tag_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, text; other columns are not
    read): doc_id, score (0 to 1), spans (byte offsets start and end of
    offending words, and their chance).

    Null and empty texts, and texts without words: the score of a text
    without toxic words, no spans.  Null doc_ids are carried; repeated rows
    are scored each.  Empty table: no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_score(sent), "doc_id long, score double, spans array<struct<start:long,end:long,chance:double>>")
