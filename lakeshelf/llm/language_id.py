"""Language of documents in two steps: the family first, then the language within it.

Linear support vector machines on counts of letters, pairs and triples of letters (hashed to DIMENSIONS
places, square roots, unit length). One machine per family against the rest chooses the family; within it,
one machine for each pair of its languages votes, and margins break ties. The score is the lowest of the
family's and the languages' certainty and of the text's likeness to the language it is given.

Machines only choose among what was learned, so the likeness stands apart from them: the mean logarithm of a
text's letters, pairs and triples under the language's own distribution, against even odds. Its cut is calibrated
on the labelled sample, each text left out of its own distribution, and lies lower for short texts, as their
likeness scatters more; it is never above half the sample's median, so that a text with passages in another
language stays. A text below the cut scores below LEAST_SCORE.

Every language of the labelled rows is learned. The machines are fitted on at most SAMPLE labelled documents of
each language, those with the smallest hashes of doc_id; where these are more than DRIVER_ROWS in all, the machines
are fitted in tasks, and those of the families on at most FAMILY_ROWS documents, evenly of all languages and one of
each at least. These bounds on labelled rows are the only ones. All texts are classified whole.

Defined results: a null text, and one without a letter, is ``und`` with score 0. Rows without
a language are not learned from; where there is none to learn from, all texts are ``und``. With one
language learned, every text with a letter is that language, with its likeness as score. A language of fewer than
CALIBRATED learned texts has no cut: likeness to it counts as 1. Equal texts get equal results, wherever
they are. An empty table gives an empty result; further columns are kept by ``keep_known``.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshelf.llm.common import batch, small_batches, stored, texts_of

UNKNOWN = "und"
#: Documents per language that are learned from, at most.
SAMPLE = 600
#: Documents that the driver fits on, and that a family's machine is fitted on in a task: 8 to 32 KB each.
DRIVER_ROWS, FAMILY_ROWS = 8_000, 8_000
DIMENSIONS = 1 << 12
#: Below this score a document's language counts as unknown in ``keep_known``.
LEAST_SCORE = 0.2
#: Learned texts from which a language's likeness has a cut, deviations below the median that it leaves at least, and
#: the share of its labelled sample that it leaves.
CALIBRATED, DEVIATIONS, STAYING = 20, 6.0, 0.995

# Families of languages by ISO 639-1 code. A language that isn't here is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indic": "hi bn ur pa mr gu ne si",
    "celtic": "ga gd cy br",
    "baltic": "lt lv",
    "semitic": "ar he am mt",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def family_of(lang: str) -> str:
    code = re.split(r"[-_]", lang.lower())[0]
    return _FAMILY.get(code, f"only {lang}")


# ---------------------------------------------------------------- features


def features(text: str) -> np.ndarray | None:
    """The vector of a text, None if it has no letter."""
    return counted(text)[0]


def counted(text: str) -> tuple[np.ndarray | None, int]:
    """The vector of a text, None if it has no letter, and the length of what it counts."""
    letters = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not letters:
        return None, 0
    c = np.frombuffer(f" {letters} ".encode("utf-32-le"), np.uint32)
    c = c * np.uint32(2654435761)
    counts = np.bincount(c[1:-1] >> 20, minlength=DIMENSIONS)
    two = c[:-1] * np.uint32(31) + c[1:]
    counts += np.bincount((two * np.uint32(0x85EBCA6B)) >> 20, minlength=DIMENSIONS)
    three = two[:-1] * np.uint32(31) + c[2:]
    counts += np.bincount((three * np.uint32(0xC2B2AE35)) >> 20, minlength=DIMENSIONS)
    x = np.sqrt(counts.astype(np.float32))
    return x / np.linalg.norm(x), len(letters)


# ---------------------------------------------------------------- machines


def fit_machine(x: np.ndarray, y: np.ndarray, rounds: int = 30, c: float = 100.0) -> np.ndarray:
    """A linear support vector machine (dual coordinate descent, a constant feature as bias); y is 1 or -1.

    Both sides weigh the same, however many rows they have.
    """
    rng = np.random.default_rng(0)
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w, a = np.zeros(x.shape[1], np.float64), np.zeros(len(x))
    most = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y < 0).sum())))
    norms = (x * x).sum(axis=1)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(x)):
            step = np.clip(a[i] - (y[i] * (x[i] @ w) - 1) / norms[i], 0, most[i]) - a[i]
            if step:
                a[i] += step
                w += step * y[i] * x[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w.astype(np.float32)


class Likeness:
    """How like the learned texts of one language a text is."""

    def __init__(self, x: np.ndarray, sizes: np.ndarray):
        m = len(x)
        shares = np.square(x)  # a text's counts as shares of all it counts
        # one even text is added, so that what was never seen isn't impossible
        total = shares.sum(axis=0) + np.float32(1 / DIMENSIONS)
        self.log = np.log(total * (DIMENSIONS / (m + 1)))
        found = np.array([s @ np.log((total - s).clip(1e-9) * (DIMENSIONS / m)) for s in shares])
        self.middle = float(np.median(found))
        p = total / (m + 1)
        self.each = max(0.0, float(p @ np.square(self.log) - (p @ self.log) ** 2))
        self.wide = (1.4826 * float(np.median(np.abs(found - self.middle)))) ** 2 + 1e-6
        self.most = max(DEVIATIONS, float(np.quantile((self.middle - found) / np.sqrt(self.wide + self.each / sizes), STAYING)))

    def score(self, x: np.ndarray, n: int) -> float:
        """LEAST_SCORE at the cut, below it beneath and above it over the cut."""
        unit = (self.wide + self.each / n) ** 0.5
        cut = min(self.middle - self.most * unit, self.middle / 2)
        below = (cut - float(np.square(x) @ self.log)) / unit
        return float(1 / (1 + (1 / LEAST_SCORE - 1) * np.exp(np.clip(below, -50, 50))))


class Classifier:
    """Machines for the families, and for each pair of languages within one; each language's likeness."""

    def __init__(self, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(k) for k in self.langs})
        self.members = {f: [k for k in self.langs if family_of(k) == f] for f in self.families}
        self.family_w: list[np.ndarray] = []
        self.pair_w: dict[tuple[str, str], np.ndarray] = {}
        self.likeness: dict[str, Likeness] = {}

    def pairs(self) -> list[tuple[str, str]]:
        return [p for f in self.families for p in combinations(self.members[f], 2)]

    def learn(self, x: np.ndarray, langs: list[str], sizes: list[int]) -> Classifier:
        of, sizes = np.array(langs), np.array(sizes)
        families = np.array([family_of(k) for k in langs])
        if len(self.families) > 1:
            self.family_w = [fit_machine(x, np.where(families == f, 1, -1)) for f in self.families]
        for a, b in self.pairs():
            rows = (of == a) | (of == b)
            self.pair_w[a, b] = fit_machine(x[rows], np.where(of[rows] == a, 1, -1))
        self.likeness = {k: Likeness(x[of == k], sizes[of == k]) for k in self.langs if (of == k).sum() >= CALIBRATED}
        return self

    def predict(self, text: str) -> tuple[str, float]:
        x, n = counted(text) if self.langs else (None, 0)
        if x is None:
            return UNKNOWN, 0.0
        sure = lambda m: float(1 / (1 + np.exp(-np.clip(3 * m, -50, 50))))
        family, score = self.families[0], 1.0
        if self.family_w:
            margins = [float(x @ w[:-1] + w[-1]) for w in self.family_w]
            family, score = self.families[int(np.argmax(margins))], sure(max(margins))
        members = self.members[family]
        votes, sums, worst = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0), dict.fromkeys(members, 1.0)
        for a, b in combinations(members, 2):
            w = self.pair_w[a, b]
            m = float(x @ w[:-1] + w[-1])
            votes[a if m >= 0 else b] += 1
            sums[a], sums[b] = sums[a] + m, sums[b] - m
            worst[a], worst[b] = min(worst[a], sure(m)), min(worst[b], sure(-m))
        best = max(members, key=lambda k: (votes[k], sums[k]))
        own = self.likeness[best].score(x, n) if best in self.likeness else 1.0
        return best, min(score, worst[best], own)


# ---------------------------------------------------------------- on Spark


def fit(docs: DataFrame, learn: Column | None = None, sample: int = SAMPLE) -> Classifier:
    """Fit on labelled rows of ``docs`` (doc_id, text, lang) for which ``learn`` holds.

    Rows that repeat a doc_id are learned from once for each language, by the text that sorts first, so the sample is bounded whatever repeats;
    rows without a doc_id count by their text.
    """
    labelled = docs.where("lang IS NOT NULL")
    if learn is not None:
        labelled = labelled.where(learn)
    order = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("language"), F.col("text"))).otherwise(F.xxhash64(F.lit("language"), F.col("doc_id")))
    # a row per language; different documents, to two hundredths
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct(order, 0.02).alias("n")).collect()
    rows_of = {r["lang"]: r["n"] for r in counts}
    # the smallest hashes of each language: a cut that keeps about SAMPLE rows, then exactly those
    span = 1 << 64
    cut = {k: -(1 << 63) + min(span - 1, int(span * min(1.0, 1.1 * (sample + 6 * sample**0.5 + 20) / n))) for k, n in rows_of.items()}
    if not cut:
        return Classifier([])
    edges = docs.sparkSession.createDataFrame(sorted(cut.items()), "lang string, edge long")
    rows = labelled.select("lang", "text", order.alias("h")).join(F.broadcast(edges), "lang").where("h <= edge")
    rows = rows.groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text", "h")
    small_batches(docs.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("h", pa.int64()), ("n", pa.int64()), ("x", pa.binary())])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(k, h, *counted(t)) for k, t, h in zip(b.column(0).to_pylist(), texts_of(b.column(1)), b.column(2).to_pylist())]
            found = [f for f in found if f[2] is not None]
            if found:
                langs, hashes, x, sizes = zip(*found)
                yield batch(schema, langs, hashes, sizes, [v.astype(np.float16).tobytes() for v in x])

    vectors_of = rows.mapInArrow(vectors, "lang string, h long, n long, x binary")
    if sum(min(n, sample) for n in rows_of.values()) > DRIVER_ROWS:
        return _fit_in_tasks(vectors_of, sample)
    # at most DRIVER_ROWS (and some) vectors of 8 KB
    got = vectors_of.toArrow().sort_by([("lang", "ascending"), ("h", "ascending")])
    langs, taken, x, sizes = [], {}, [], []
    for lang, n, data in zip(got["lang"].to_pylist(), got["n"].to_pylist(), got["x"]):
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= sample:
            langs.append(lang)
            sizes.append(n)
            x.append(np.frombuffer(data.as_buffer(), np.float16))
    return Classifier(langs).learn(np.array(x, np.float32).reshape(-1, DIMENSIONS), langs, sizes)


def _array(column: pa.ChunkedArray) -> np.ndarray:
    return np.array([np.frombuffer(d.as_buffer(), np.float16) for d in column], np.float16).reshape(-1, DIMENSIONS)


def _fit_in_tasks(vectors: DataFrame, sample: int) -> Classifier:
    """The same machines and likenesses, one task's group each; the driver gets what they have learned."""
    spark = vectors.sparkSession
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = stored(vectors.withColumn("place", place).where(F.col("place") <= sample), "language-vectors")
    counts = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = Classifier(list(counts))
    pairs = model.pairs()
    owned = [(k, -1 - i) for i, k in enumerate(model.langs) if counts[k] >= CALIBRATED]
    members = owned + [(k, i) for i, pair in enumerate(pairs) for k in pair]

    def one(key, rows):
        rows, machine = rows.sort_by([("lang", "ascending"), ("h", "ascending")]), key[0].as_py()
        x, of = _array(rows["x"]).astype(np.float32), np.array(rows["lang"].to_pylist())
        made = fit_machine(x, np.where(of == pairs[machine][0], 1, -1)) if machine >= 0 else Likeness(x, rows["n"].to_numpy())
        return pa.table({"machine": pa.array([machine], pa.int64()), "made": pa.array([pickle.dumps(made)], pa.binary())})

    if members:
        sides = F.broadcast(spark.createDataFrame(members, "lang string, machine long"))
        for r in chosen.join(sides, "lang").groupBy("machine").applyInArrow(one, "machine long, made binary").toLocalIterator():
            made = pickle.loads(r["made"])
            if r["machine"] >= 0:
                model.pair_w[pairs[r["machine"]]] = made
            else:
                model.likeness[model.langs[-1 - r["machine"]]] = made
    families = model.families
    if len(families) > 1:
        some = chosen.where(F.col("place") <= max(1, FAMILY_ROWS // len(counts))).toArrow().sort_by([("lang", "ascending"), ("h", "ascending")])
        shared = spark.sparkContext.broadcast((_array(some["x"]), [family_of(k) for k in some["lang"].to_pylist()]))
        schema = pa.schema([("family", pa.int64()), ("made", pa.binary())])

        def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x, of = shared.value[0].astype(np.float32), np.array(shared.value[1])
            for b in batches:
                for i in b.column(0).to_pylist():
                    yield batch(schema, [i], [fit_machine(x, np.where(of == families[i], 1, -1)).tobytes()])

        made = spark.range(0, len(families), 1, len(families)).mapInArrow(rest, "family long, made binary").collect()
        model.family_w = [np.frombuffer(r["made"], np.float32) for r in sorted(made, key=lambda r: r["family"])]
    return model


def classify(docs: DataFrame, model: Classifier, *keep: str) -> DataFrame:
    """The columns ``keep`` with lang_pred and score, from the texts alone."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").alias("_lid_text"))
    schema = docs.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for b in batches:
            found = [predict(t) for t in texts_of(b.column(b.num_columns - 1))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=names
            )

    return rows.mapInArrow(run, schema)


def keep_known(docs: DataFrame, model: Classifier, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` in a language that the model knows, with its columns.

    Columns of ``docs`` may have any names; those used inside stand apart.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for b in batches:
            found = [predict(t) for t in texts_of(b.column(at))]
            yield b.filter(pa.array([k != UNKNOWN and s >= least_score for k, s in found], pa.bool_()))

    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # mapInArrow resolves columns by name
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
