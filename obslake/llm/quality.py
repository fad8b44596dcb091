"""Quality classification by co-training.

Method: one logistic classifier sees the text only (kinds of characters, words, repetition, hashed
vocabulary), the other the page's metadata only (source, language tag, length, layout of lines). In each
of ROUNDS rounds, each labels the pool documents it is most sure of for the other one to
learn from. Both are then calibrated on labelled documents kept aside, and a calibrated combination
of the two views scores every document.

Learning is bounded: LABELLED labelled documents and POOL others, those with the smallest hash of
their id. Scoring covers every document and its whole text.

Defined cases: a null or empty text has the features zero; null metadata is a value of its own; a null n_chars is
read as -1; rows with a null doc_id are scored but never learned from; labels repeated for one document are
averaged, null labels ignored; without labels of both classes every score is 0.5 and every document
is kept; repeated rows are scored as often as they occur; other columns are ignored by the classifiers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.llm.common import frugal, sliced, word_hashes

#: bounds of the learning sample
LABELLED, POOL = 12_000, 12_000
ROUNDS = 3
#: share of the pool that a classifier labels in a round, of each class in proportion
SHARE = 0.05
#: probability below which a document is rejected; low, as a good document costs more than a bad one
THRESHOLD = 0.3
HASHED = 128
SOURCES = 64
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: kinds of characters: lower, upper, other letter, digit, space, line end, sentence mark, other ASCII mark, other
KINDS = 9


def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, 8, np.uint8)
    for code in range(0x30000):
        c = chr(code)
        if c.isalpha():
            kinds[code] = 0 if c.islower() else 1 if c.isupper() else 2
        elif c.isdigit():
            kinds[code] = 3
        elif c.isspace():
            kinds[code] = 5 if c == "\n" else 4
        elif c in ".,;:?!'\"()-":
            kinds[code] = 6
        elif code < 128:
            kinds[code] = 7
    return kinds


_KINDS: list[np.ndarray] = []


def text_features(texts: list[str]) -> np.ndarray:
    """One row for each whole text."""
    if not _KINDS:
        _KINDS.append(_kinds())
    count = len(texts)
    sizes = np.array([len(text) for text in texts], np.int64)
    kinds = _KINDS[0][np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
    tally = np.bincount(np.repeat(np.arange(count) * KINDS, sizes) + kinds, minlength=count * KINDS)
    shares = tally.reshape(count, KINDS) / np.maximum(sizes, 1)[:, None]
    words = [text.lower().split() for text in texts]
    numbers = np.array([len(w) for w in words], np.int64)
    distinct = np.array([len(set(w)) for w in words])
    flat = [word for w in words for word in w]
    hashes = word_hashes(flat) if flat else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(count), numbers)
    again = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=count)
    lengths = np.fromiter(map(len, flat), np.float64, len(flat))
    short = np.bincount(owner[lengths <= 4], minlength=count)
    some = np.maximum(numbers, 1)
    bag = np.bincount(owner * HASHED + (hashes % np.uint64(HASHED)).astype(np.int64), minlength=count * HASHED)
    bag = np.sqrt(bag.reshape(count, HASHED) / some[:, None])
    mean = np.bincount(owner, lengths, count) / some
    return np.column_stack([shares, np.sqrt(shares), distinct / some, again / some, short / some, np.log1p(mean), bag])


def meta_features(sources: list, languages: list, n_chars: list, texts: list[str]) -> np.ndarray:
    """One row for each document: hashed source and language, length, and the layout of its lines."""
    rows = np.zeros((len(texts), 2 * SOURCES + 4))
    for kind, values in enumerate((sources, languages)):
        slots = [xxhash.xxh3_64_intdigest(repr(value)) % SOURCES for value in values]
        rows[np.arange(len(texts)), kind * SOURCES + np.array(slots, np.int64).reshape(-1)] = 1
    sizes = np.array([-1 if n is None else n for n in n_chars], np.float64)
    lines = [text.split("\n") for text in texts]
    number = np.array([len(x) for x in lines], np.float64)
    unlike = np.array([len(set(x)) for x in lines], np.float64)
    rows[:, -4:] = np.column_stack([np.log1p(np.maximum(sizes, 0)), np.log(number), np.log1p(np.maximum(sizes, 0) / number), unlike / number])
    return rows


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Logistic:
    """Ridge logistic regression on standardised columns, fitted with Newton steps."""

    ridge: float = 1.0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.mean, spread = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(spread > 1e-9, spread, 1.0)
        z = self._columns(x)
        w, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], self.ridge)
        penalty[0] = 1e-3

        def loss(w: np.ndarray) -> float:
            score = z @ w
            return float((np.logaddexp(0, score) - y * score).sum() + (penalty * w * w).sum() / 2)

        now = loss(w)
        for _ in range(30):
            p = _sigmoid(z @ w)
            curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(curve, z.T @ (y - p) - penalty * w)
            while (then := loss(w + step)) > now and np.abs(step).max() > 1e-9:
                step = step / 2
            w = w + step
            if now - then < 1e-6 * max(1.0, now):
                break
            now = then
        self.weights = w
        return self

    def _columns(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), np.clip((x - self.mean) / self.scale, -8, 8)])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._columns(x) @ self.weights


@dataclass
class Model:
    views: list[Logistic]
    calibrations: list[Logistic]
    combination: Logistic

    def scores(self, features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by text, by metadata and by both."""
        logits = [c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibrations, features, strict=True)]
        both = self.combination.logit(np.column_stack(logits))
        return _sigmoid(logits[0]), _sigmoid(logits[1]), _sigmoid(both)


def co_train(features: list[np.ndarray], labels: np.ndarray, aside: np.ndarray, rounds: int = ROUNDS) -> Model | None:
    """features: of both views; labels: 1, 0, or -1 in the pool; aside: rows to calibrate on."""
    pool, aside = labels < 0, aside & (labels >= 0)
    learning = ~pool & ~aside
    if min(len(set(labels[learning])), len(set(labels[aside]))) < 2:
        return None
    given = [np.where(learning, labels, -1) for _ in features]  # what each view learns from
    views = [Logistic().fit(x[g >= 0], g[g >= 0]) for x, g in zip(features, given, strict=True)]
    good = labels[learning].mean()
    for _ in range(rounds):
        taught = [g.copy() for g in given]
        for teacher, student in ((0, 1), (1, 0)):
            open_ = np.flatnonzero(pool & (given[student] < 0))
            logit = views[teacher].logit(features[teacher][open_])
            order = np.argsort(logit, kind="stable")
            number = int(SHARE * pool.sum())
            low, high = order[: int(number * (1 - good))], order[len(order) - int(number * good) :]
            taught[student][open_[low[logit[low] < -1]]] = 0
            taught[student][open_[high[logit[high] > 1]]] = 1
        given = taught
        views = [Logistic().fit(x[g >= 0], g[g >= 0]) for x, g in zip(features, given, strict=True)]
    y = labels[aside]
    logits = [view.logit(x[aside])[:, None] for view, x in zip(views, features, strict=True)]
    calibrations = [Logistic(0.1).fit(logit, y) for logit in logits]
    calibrated = np.column_stack([c.logit(logit) for c, logit in zip(calibrations, logits, strict=True)])
    return Model(views, calibrations, Logistic(0.1).fit(calibrated, y))


def _features(batch: pa.RecordBatch) -> list[np.ndarray]:
    values = {name: batch.column(name).to_pylist() for name in ("text", "source", "lang", "n_chars")}
    texts = [text or "" for text in values["text"]]
    return [text_features(texts), meta_features(values["source"], values["lang"], values["n_chars"], texts)]


def _columns(docs: DataFrame) -> DataFrame:
    kinds = {"doc_id": "long", "n_chars": "long"}
    return docs.select(*(F.col(name).cast(kinds.get(name, "string")).alias(name) for name in COLUMNS))


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> Model | None:
    """A model from a bounded sample of the labelled and of the other documents."""
    docs = _columns(docs)
    hashed = F.xxhash64("doc_id")
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg((F.avg("quality") >= 0.5).cast("int").alias("quality")).orderBy(hashed, "doc_id").limit(labelled)
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    others = ids.join(F.broadcast(marks.select("doc_id")), "doc_id", "left_anti").orderBy(hashed, "doc_id").limit(pool)
    chosen = marks.unionByName(others.withColumn("quality", F.lit(-1)))  # at most labelled + pool rows
    rows = docs.join(F.broadcast(chosen), "doc_id")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2_000_000):
            vectors = [pa.array([row.tobytes() for row in x.astype(np.float32)], pa.binary()) for x in _features(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), *vectors], ["doc_id", "quality", "content", "meta"])

    found = rows.mapInArrow(frugal(compute), "doc_id long, quality int, content binary, meta binary")
    # repeated documents count once
    found = found.groupBy("doc_id").agg(*(F.max(name).alias(name) for name in ("quality", "content", "meta")))
    sample = found.orderBy("doc_id").toArrow()  # bounded, features only
    if not sample.num_rows:
        return None
    features = [np.array([np.frombuffer(v, np.float32) for v in sample.column(name).to_pylist()], np.float64) for name in ("content", "meta")]
    hashes = np.array([xxhash.xxh3_64_intdigest(str(i)) % 10 for i in sample.column("doc_id").to_pylist()])
    return co_train(features, np.array(sample.column("quality").to_pylist()), hashes < 3)


def _scores(model: Model | None, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if model is None:
        return (np.full(batch.num_rows, 0.5),) * 3
    return model.scores(_features(batch))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_score, meta_score, score (probability of good quality) and keep of every document."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2_000_000):
            content, meta, both = _scores(model.value, batch)
            columns = [batch.column("doc_id"), *map(pa.array, (content, meta, both, both >= threshold))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_score", "meta_score", "score", "keep"])

    return _columns(docs).mapInArrow(frugal(score), "doc_id long, text_score double, meta_score double, score double, keep boolean")


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, of documents that score at least the threshold."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2_000_000):
            yield batch.filter(pa.array(_scores(model.value, batch)[2] >= threshold))

    return docs.mapInArrow(frugal(keep), docs.schema)
