"""Toxicity of documents by compression distance.

Two Zstandard dictionaries are trained, one on windows of toxic text and one on windows of ordinary text.
A window is a word between spaces, set in a constant carrier text that both dictionaries hold, so that the
compressed lengths differ by what the word alone costs: the gain of the toxic dictionary, in bytes. A
document's score is a logistic function of how many of its windows pass each of the gains in THRESHOLDS, and of
the share that pass the middle one. How much each threshold counts is calibrated on documents
that their dictionaries were not trained on (FOLDS parts in turn).

The toxic dictionary's windows are words of toxic documents that, or whose beginnings, occur in toxic
documents far more often than in ordinary ones (a likelihood ratio of at least EVIDENCE, counted over distinct
documents: near copies of one passed before don't count).

Fitting takes at most SAMPLE_TOXIC toxic and SAMPLE_ORDINARY ordinary labelled documents, those with the smallest
hashes of doc_id; that is the only bound. Every text is scored whole.

Defined results: null and empty texts score as a text without hits; without labelled documents of both kinds
every score is 0. A document labelled both ways counts as toxic. Labels without a document, and
null labels, are ignored. Equal texts get equal scores. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshelf.llm.common import small_batches, texts_of

SAMPLE_TOXIC, SAMPLE_ORDINARY = 1200, 2400
FOLDS = 3
EVIDENCE = 18.0
TOXIC_BYTES, ORDINARY_BYTES = 4096, 65536
LEVEL = 12
THRESHOLDS = range(2, 10)
#: Gain from which a window counts as a hit on its own, weight of toxic documents in calibration, and ridge.
HIT, TOXIC_WEIGHT, RIDGE = 4, 2.0, 0.3
TOXIC_FROM = 0.7
#: Words whose gain a worker remembers.
REMEMBERED = 500_000

_WORD = re.compile(r"[^\W\d_]+")
_BEFORE = b"|0123456789 abcdefghijklmnopqrstuvwxyz 9876543210|"
_AFTER = b"|ZYXWVUTSRQPONMLKJIHGFEDCBA|"
_HEADS = (4, 5, 6, 7)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Distance:
    """Compressed lengths of windows under the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.parts = (toxic, ordinary)
        self.packers = None
        self.gains: dict[str, int] = {}

    def __getstate__(self):
        return self.parts

    def __setstate__(self, parts):
        self.__init__(*parts)

    @staticmethod
    def _packer(content: bytes) -> zstandard.ZstdCompressor:
        how = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS
        )
        held = zstandard.ZstdCompressionDict(content + _AFTER + _BEFORE, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=how)
        return zstandard.ZstdCompressor(dict_data=held, compression_params=how)

    def gain(self, word: str) -> int:
        """Bytes by which the toxic dictionary is better for this word."""
        found = self.gains.get(word)
        if found is None:
            if self.packers is None:
                self.packers = [self._packer(p) for p in self.parts]
            if len(self.gains) >= REMEMBERED:
                self.gains.clear()
            window = _BEFORE + f" {word} ".encode() + _AFTER
            toxic, ordinary = (len(p.compress(window)) for p in self.packers)
            found = self.gains[word] = ordinary - toxic
        return found


# ---------------------------------------------------------------- training


def _unlike_before(docs: list[list[str]]) -> list[bool]:
    """Which documents aren't near copies of one before (by least hashes of their word triples)."""
    seen, out = set(), []
    for w in docs:
        triples = {" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))}
        keys = {(s, min(xxhash.xxh3_64_intdigest(t, s) for t in triples)) for s in range(4)}
        out.append(not keys & seen)
        seen |= keys
    return out


def _dictionary(windows: Counter, size: int) -> bytes:
    """Trained on the windows; of too few for the trainer, the windows themselves, the most frequent last."""
    samples = [f" {w} ".encode() for w, n in windows.most_common(20_000) for _ in range(min(n, 20))]
    if sum(map(len, samples)) > 8 * size:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(dict.fromkeys(reversed(samples)))[-size:]


def train(docs: list[list[str]], labels: np.ndarray) -> Distance:
    toxic, ordinary = Counter(), Counter()
    for w, label in zip(docs, labels):
        found = set(w)
        found.update([x[:k] + "*" for x in list(found) for k in _HEADS if len(x) > k])
        (toxic if label else ordinary).update(found)
    n_toxic, n_ordinary = int(labels.sum()), int((labels == 0).sum())
    share = n_toxic / max(1, n_toxic + n_ordinary)

    def evidence(t: str) -> float:
        a, b = toxic[t], ordinary[t]
        if a < 3 or a / n_toxic < 5 * b / max(1, n_ordinary):
            return 0.0
        return 2 * (a * math.log(a / ((a + b) * share)) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0))

    marks = {t for t in toxic if evidence(t) >= EVIDENCE}
    toxic_windows, ordinary_windows = Counter(), Counter()
    for w, label in zip(docs, labels):
        for x in set(w):
            if not label:
                ordinary_windows[x] += 1
            elif x in marks or any(x[:k] + "*" in marks for k in _HEADS if len(x) > k):
                toxic_windows[x] += 1
    return Distance(_dictionary(toxic_windows, TOXIC_BYTES), _dictionary(ordinary_windows, ORDINARY_BYTES))


def _measures(words: list[str], distance: Distance) -> list[float]:
    last, n = THRESHOLDS[-1], len(words)
    counts = Counter(min(last, g) for g in map(distance.gain, words) if g >= THRESHOLDS[0])
    hits = sum(k for g, k in counts.items() if g >= HIT)
    gained = sum(k * g for g, k in counts.items() if g >= HIT)
    return [
        *(math.log1p(counts[g]) for g in THRESHOLDS), math.log1p(hits), math.log1p(gained), 10 * hits / max(1, n),
        min(1.0, hits), math.log1p(n) / 5, 1.0,
    ]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression (Newton steps)."""
    scale = np.abs(x).max(axis=0) + 1e-9
    z, w, c = x / scale, np.zeros(x.shape[1]), np.where(y == 1, TOXIC_WEIGHT, 1.0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        h = (z * (c * p * (1 - p))[:, None]).T @ z + RIDGE * np.eye(len(w))
        w -= np.linalg.solve(h, z.T @ (c * (p - y)) + RIDGE * w)
    return w / scale


class Scorer:
    """Dictionaries and logistic weights; 0 for all texts if there is nothing to learn from."""

    def __init__(self, texts: list[str], labels: list[int]):
        docs = [words_of(t) for t in texts]
        new = _unlike_before(docs)
        docs = [d for d, k in zip(docs, new) if k]
        y = np.array([v for v, k in zip(labels, new) if k])
        self.distance = None
        if len(y) < 2 * FOLDS or min((y == 1).sum(), (y == 0).sum()) < FOLDS:
            return
        part = np.empty(len(y), int)
        for v in (0, 1):  # every part has both kinds
            part[y == v] = np.arange((y == v).sum()) % FOLDS
        apart = [train([d for d, p in zip(docs, part) if p != k], y[part != k]) for k in range(FOLDS)]
        self.weights = _logistic(np.array([_measures(d, apart[p]) for d, p in zip(docs, part)]), y)
        self.distance = train(docs, y)

    def score(self, text: str) -> float:
        if self.distance is None:
            return 0.0
        at = float(np.dot(_measures(words_of(text), self.distance), self.weights))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, at))))


# ---------------------------------------------------------------- on Spark


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, toxic: int = SAMPLE_TOXIC, ordinary: int = SAMPLE_ORDINARY) -> Scorer:
    """Fit on documents (doc_id, text) with labels (doc_id, toxic); ``learn`` is a condition on doc_id."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    order = F.xxhash64(F.lit("toxicity"), F.col("doc_id"))
    chosen = known.where("toxic = 1").orderBy(order).limit(toxic).unionByName(known.where("toxic = 0").orderBy(order).limit(ordinary))
    # the sample has a fixed bound, and so may be broadcast and brought to the driver
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # of rows that repeat a doc_id, the text that sorts first
    got = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["text"] or ""))
    return Scorer([r["text"] or "" for r in got], [r["toxic"] for r in got])


def score(docs: DataFrame, scorer: Scorer, *keep: str) -> DataFrame:
    """The columns ``keep`` with score and predicted, from the texts alone."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    rows = docs.select(*keep, F.col("text").alias("_tox_text"))
    schema = docs.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value.score
        for b in batches:
            s = np.array([of(t) for t in texts_of(b.column(b.num_columns - 1))], np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s), pa.array((s >= TOXIC_FROM).astype(np.int32))], names=names)

    return rows.mapInArrow(run, schema)
