"""Language of whole texts: averaged hashed subword embeddings.

Every run of two, three or four bytes of the text (A-Z lower-cased) is hashed
to one of ``BUCKETS`` embeddings; their average over the whole text goes
through a linear softmax.  Embeddings and softmax are trained together by
stochastic gradient descent in numpy on at most ``SAMPLE`` labelled rows, dealt
language by language, the smallest hashes of their ids first.  Two fifths of
all ids are kept from training; at most ``HELD`` of those, dealt alike, are scored on
the executors and calibrate the answer: a temperature makes the score a
probability, and two bounds tell texts of no learnt language.  One is on the
score; the other on familiarity, the average over the same byte runs of the log
of their frequency in the predicted language, less its mean there, so that it
is near 0 for texts of that language.  The bound on the score lies ``REACH`` times
as far below the median as the lowest twentieth; that on familiarity ``WAY`` of
the way from the median in the texts' own language to the median in the best
of the others.  Both hold for any number of rows, and odd texts among them
hardly move them.  Prediction needs one column of a small table for each byte
run.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelworks.llm.storage import stored
from funnelworks.llm.words import slices

BUCKETS, WIDTH = 1 << 15, 16
#: Rows to learn from, rows to calibrate on, and how far off the bounds are.
SAMPLE, HELD, REACH, WAY = 4000, 10_000, 3.0, 0.65
#: Share of a text that a byte run not met in a language counts for there.
UNMET = 1e-5
EPOCHS, RATE, SEED = 12, 0.5, 7
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


def subwords(data: np.ndarray) -> list[np.ndarray]:
    """Buckets of the byte runs of lengths 2, 3 and 4 that start at each byte
    (the last ones are shorter by as many bytes)."""
    b = _FOLD[data]
    out = []
    code = b
    for n in (2, 3, 4):
        code = code[: max(len(b) - n + 1, 0)] | (b[n - 1 :] << np.uint32(8 * (n - 1)))
        h = (code ^ np.uint32(0x9E3779B9 * n & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        out.append(((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32))
    return out


def _features(batches):
    """(lang, buckets, weights) of texts, packed as 16-bit integers and 32-bit
    floats; weights add up to one."""
    for batch in batches:
        for lo, hi, data, borders in slices(batch.column(1)):
            rows = []
            for d in range(hi - lo):
                found = subwords(data[borders[d] : borders[d + 1]])
                counts = np.bincount(np.concatenate(found), minlength=BUCKETS) if len(found[0]) else np.zeros(1, np.int64)
                used = np.flatnonzero(counts)
                if len(used):
                    weights = (counts[used] / counts.sum()).astype(np.float32)
                    rows.append((batch.column(0)[lo + d].as_py(), used.astype(np.uint16).tobytes(), weights.tobytes()))
            if rows:
                kinds = (pa.string(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["lang", "buckets", "weights"]
                )


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # a row of logits for each language, then a row of log frequencies for each; a column a bucket
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0  # lowest score
    floor: float = -np.inf  # lowest familiarity

    def scores(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def answers(self, means: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score and its familiarity, from averages of the table."""
        n, every = len(self.languages), np.arange(len(means))
        p = self.scores(means[:, :n])
        best = p.argmax(1)
        return best, p[every, best], means[every, n + best]


def train(rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """A model from (language, buckets, weights) rows, in the order given."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.zeros(0))
    rng = np.random.default_rng(SEED)
    e = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    w = rng.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    labels = np.array([languages.index(r[0]) for r in rows])
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(len(rows)):
            _, buckets, weights = rows[i]
            x = weights @ e[buckets]
            z = x @ w + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            step = rate * (w @ p)
            w -= rate * np.outer(x, p)
            bias -= rate * p
            e[buckets] -= weights[:, None] * step * 20  # averages shrink the gradient of each embedding
    often = np.full((len(languages), BUCKETS), UNMET)
    for label, (_, buckets, weights) in zip(labels, rows, strict=True):
        often[label, buckets] += weights
    often /= often.sum(1, keepdims=True)
    familiar = np.log(often) - (often * np.log(often)).sum(1, keepdims=True)
    return Model(languages, np.vstack(((e @ w).T, familiar)).astype(np.float32), bias)


def lowest(values: np.ndarray) -> float:
    """A bound ``REACH`` times as far below the median as the lowest twentieth
    of the values; without any, nothing is below."""
    if not len(values):
        return -np.inf
    twentieth, middle = np.quantile(values, (0.05, 0.5))
    return float(middle - REACH * (middle - twentieth))


def halfway(labels: np.ndarray, familiar: np.ndarray) -> float:
    """A bound ``WAY`` of the way from the median familiarity of texts in their
    own language to that in the best of the others, which stands for texts of no
    learnt language; without texts or other languages, nothing is below."""
    if not len(labels) or familiar.shape[1] < 2:
        return -np.inf
    every = np.arange(len(labels))
    own, others = familiar[every, labels], familiar.copy()
    others[every, labels] = -np.inf
    return float((1 - WAY) * np.median(own) + WAY * np.median(others.max(1)))


def calibrate(model: Model, labels: np.ndarray, means: np.ndarray) -> None:
    """Set temperature and bounds from rows kept from training.  The log of the
    temperature has a standard normal prior, so that few rows hardly move it."""
    logits, best = means[:, : len(model.languages)], np.inf
    for t in np.geomspace(1 / 16, 16, 65):
        model.temperature = float(t)
        p = model.scores(logits)[np.arange(len(labels)), labels]
        loss = np.log(t) ** 2 / 2 - np.log(np.maximum(p, 1e-12)).sum()
        if loss < best:
            best, chosen = loss, float(t)
    model.temperature = chosen
    _, score, _ = model.answers(means)
    odds = lowest(np.log(score) - np.log(np.maximum(1 - score, 1e-15)))
    model.threshold = float(1 / (1 + np.exp(-odds)))
    model.floor = halfway(labels, means[:, len(model.languages) :])


def _dealt(rows: DataFrame, sample: int, held: int) -> DataFrame:
    """(id, lang, held, place) of the ids to learn from (at most ``sample``)
    and to calibrate on (at most ``held``), each dealt language by language.

    The driver gets a count for each language.  Hashes are uniform, so a bound
    on the hash, drawn from the count with room to spare, leaves a few times
    the ids to deal, and no task ranks all ids of a language."""
    order = F.xxhash64("doc_id", F.lit(11))
    ids = rows.select(F.col("doc_id").alias("id"), "lang", order.alias("h"))
    counts = {r.lang: max(r.n, 1) for r in ids.groupBy("lang").agg(F.approx_count_distinct("id", 0.05).alias("n")).collect()}
    total, share = 5 * max(-(-held // 2), -(-sample // 3)), 0
    left = sorted(counts.values())
    for i, n in enumerate(left):  # the share of a language that has enough, when others have fewer
        share = max(share, -(-total // (len(left) - i)))
        total -= min(n, share)
    room = 1.5 * share + 10 * share**0.5 + 100
    bounds = [(lang, int(min(room / n, 1.0) * (1 << 31))) for lang, n in counts.items()]
    bounds = F.broadcast(rows.sparkSession.createDataFrame(bounds, "lang string, bound long"))  # a row a language
    some = ids.join(bounds, "lang").where(F.shiftrightunsigned("h", 33) < F.col("bound")).select("id", "lang", "h").distinct()
    some = some.withColumn("held", F.pmod(F.xxhash64("id", F.lit(12)), F.lit(5)) < 2)
    turn = F.row_number().over(Window.partitionBy("lang", "held").orderBy("h", "id"))
    some = stored(some.withColumn("turn", turn).withColumn("place", F.struct("turn", "h", "lang", "id")).drop("turn", "h"), "language-ids")
    parts = [some.where(F.col("held") == kept).orderBy("place").limit(n) for kept, n in ((False, sample), (True, held))]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, learn: Column, sample: int = SAMPLE, held: int = HELD) -> Model:
    """Learn from text and lang of at most ``sample`` rows of ``docs``, dealt by
    language, where ``learn`` holds and both are set, one a doc_id; calibrate
    on at most ``held`` others.  Texts stay on the executors; the driver gets
    sparse counts of at most ``sample`` rows of at most BUCKETS entries, and two
    numbers a language for each row to calibrate on."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    chosen = F.broadcast(stored(_dealt(rows, sample, held), "language-chosen"))  # at most ``sample`` + ``held`` ids
    found = rows.join(chosen, (rows["doc_id"] == chosen["id"]) & (rows["lang"] == chosen["lang"]))
    found = stored(found.groupBy("held", "place").agg(F.min("text").alias("text")), "language-sample")
    texts = found.select("held", "place", F.col("place.lang").alias("lang"), "text")
    own = texts.where(~F.col("held")).repartitionByRange("place").sortWithinPartitions("place").select("lang", "text")
    table = own.mapInArrow(_features, "lang string, buckets binary, weights binary").toArrow()
    model = train(
        [
            (lang.as_py(), np.frombuffer(buckets.as_buffer(), np.uint16), np.frombuffer(weights.as_buffer(), np.float32))
            for lang, buckets, weights in zip(*table.columns, strict=True)
        ]
    )
    if model.languages:
        sent = docs.sparkSession.sparkContext.broadcast(model)
        table = texts.where("held").select("lang", "text").mapInArrow(_means(sent), "label int, means binary").toArrow()
        means = np.frombuffer(b"".join(table.column(1).to_pylist()), np.float64).reshape(-1, len(model.table))
        calibrate(model, table.column(0).to_numpy().astype(np.int64), means)
    return model


def _means(model):
    """Number of the language, and averages of the table, of texts that ``identify`` would score."""

    def run(batches):
        m = model.value
        number = {lang: i for i, lang in enumerate(m.languages)}
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1)):
                langs, texts = (batch.column(i).slice(lo, hi - lo).to_pylist() for i in (0, 1))
                means = _means_slice(m, data, borders)
                out = [(number[lang], row.tobytes()) for lang, text, row in zip(langs, texts, means, strict=True) if lang in number and _LETTER.search(text)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["label", "means"])

    return run


def _means_slice(model: Model, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Averages of the table's rows, the logits with their bias, for each text of a slice."""
    n = len(borders) - 1
    total = np.zeros((n, len(model.table)), np.float64)
    count = np.zeros(n)
    for extra, h in zip((1, 2, 3), subwords(data), strict=True):
        lo, hi = borders[:-1], np.maximum(borders[1:] - extra, borders[:-1])
        some = np.flatnonzero(hi > lo)
        if not len(some):
            continue
        # sums over [lo, hi) by sums between all borders, every other one dropped
        cuts = np.column_stack((lo[some], hi[some])).ravel()
        for j, row in enumerate(model.table):
            values = np.append(row[h], np.float32(0))
            total[some, j] += np.add.reduceat(values, cuts, dtype=np.float64)[::2]
        count[some] += hi[some] - lo[some]
    total /= np.maximum(count, 1)[:, None]
    total[:, : len(model.languages)] += model.bias
    return total


def _predict(model):
    def run(batches):
        m = model.value
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1)):
                texts = batch.column(1).slice(lo, hi - lo)
                letters = [x is not None and bool(_LETTER.search(x)) for x in texts.to_pylist()]
                familiar = np.zeros(hi - lo)
                if m.languages:
                    best, score, familiar = m.answers(_means_slice(m, data, borders))
                    langs = [m.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
                    score = np.where(letters, score, 0.0)
                else:
                    langs, score = [UNKNOWN] * (hi - lo), np.zeros(hi - lo)
                rejected = (score < m.threshold) | (familiar < m.floor) | (np.array(langs, object) == UNKNOWN)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(rejected.astype(bool))],
                    ["doc_id", "lang_pred", "score", "rejected"],
                )

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, text; other columns are not
    read): doc_id, lang_pred, score, rejected.

    Null texts and texts without a letter, also empty ones: ``und``, score 0,
    rejected.  Others get a learned language and are rejected if their score
    or familiarity is below the model's bounds (texts of one byte have no runs:
    familiarity 0).  A model without languages answers
    ``und`` throughout.  Null doc_ids are carried; repeated rows are judged
    each.  Empty table: no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(sent), "doc_id long, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``identify`` doesn't
    reject; each row by its own text, in the same order and partitions."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            answer = [r.column(3) for r in _predict(sent)([_texts_only(batch.column(column))])]
            rejected = pa.concat_arrays(answer) if answer else pa.array([], pa.bool_())
            yield batch.filter(pc.invert(rejected))

    return docs.mapInArrow(run, docs.schema)


def _texts_only(texts: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()), texts], ["doc_id", "text"])
