"""Toxicity by a subsequence string-kernel support vector machine on Nyström landmarks.

Unit of the kernel: a span, that is a word with the signs inside it, or a run of letters written apart. A span's
subsequences are all triples of its characters, in order, within WINDOW places; a triple with gaps weighs DECAY per
place skipped. The kernel of two spans is the cosine of their weighted triples, so inserted characters and gaps lower
it without breaking it. Landmarks are spans that occur in toxic documents far more than in clean ones, and frequent
clean spans; a span's Nyström coordinates are its kernel values to the landmarks, whitened by the landmarks' own kernel
matrix. A linear support vector machine (Spark ML) is trained on those coordinates of single spans; sentences are not
formed. A training document is represented by the one span that the machine of the round before finds worst, labelled
like the document (in the first round: the spans told apart by counts, and the same with signs put inside). The worst
spans of clean documents also become landmarks. So a phrase of words that are harmless alone is not learnt, nor an insult
with a blank inside or glued into a longer word. The decision function is a sum over landmarks, so it
collapses into one weight per triple; scoring a whole text is a look-up per distinct span, and the document's score is
that of its worst span, squashed so that the training documents are fitted best.

Training takes a bounded, hashed sample of the labelled rows: ``rows_per_class`` toxic and as many clean documents at
most. Null, empty and wordless texts have no span and score 0. Without both labels every score is 0. Equal rows get
equal scores; an empty table gives an empty result. Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feldspar.llm.storage import materialize, small_batches

ROWS_PER_CLASS = 6000
#: Places within which the characters of a triple lie, and the weight per place skipped.
WINDOW, DECAY = 5, 0.5
#: Longer spans are scored in overlapping parts of this many characters.
SPAN_CHARS = 32
TOXIC_LANDMARKS, CLEAN_LANDMARKS = 160, 96
#: Times that the worst spans of the training documents are looked for and learnt anew.
ROUNDS = 2
#: Spans that are counted as landmark candidates must pass this log-likelihood ratio (chi-square, one degree).
EVIDENCE = 12.0
#: Scores from here on are predicted toxic.
THRESHOLD = 0.7
#: Texts that are scored together.
ROWS_AT_ONCE = 128
#: Scored spans that a Python worker keeps between batches.
KEPT_SPANS = 100_000

_EDGE = re.compile(r"^\W+|\W+$")
_TRIPLES = [(j, k) for k in range(2, WINDOW) for j in range(1, k)]


def spans(text: str | None) -> set[str]:
    """Distinct spans of a text, in lower case: words, and words made of three or more letters written apart."""
    words = (text or "").lower().split()
    out = set(words)
    alone = bytes([len(w) == 1 for w in words])
    if b"\1\1\1" in alone:
        out |= {"".join(words[m.start() : m.end()]) for m in re.finditer(b"\1{3,}", alone)}
    return out


def parts(span: str) -> list[str]:
    """A span with its outer signs dropped, marked at both ends; long ones as overlapping parts."""
    core = "^" + _EDGE.sub("", span) + "$"
    if len(core) <= SPAN_CHARS:
        return [core] if len(core) > 2 else []
    return [core[i : i + SPAN_CHARS] for i in range(0, len(core) - SPAN_CHARS // 2, SPAN_CHARS // 2)]


def gapped(span: str) -> list[str]:
    """The span with a sign inside: once in each third, and between all its letters."""
    core = span.strip("^$")
    return [f"^{core[:i]}{sign}{core[i:]}$" for i, sign in ((len(core) // 3, "-"), (len(core) // 2, "."), (2 * len(core) // 3, "*")) if 0 < i] + ["^" + ".".join(core) + "$"]


def triples(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, triple, weight) of all strings; weights of a row have norm 1."""
    lengths = np.array([len(s) for s in strings], np.int64)
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(strings)), lengths)
    rows, names, weights = [], [], []
    for j, k in _TRIPLES:
        if len(codes) <= k:
            continue
        same = row[:-k] == row[k:]
        a, b, c = codes[:-k][same], codes[j : len(codes) - k + j][same], codes[k:][same]
        rows.append(row[:-k][same])
        names.append((a << np.uint64(42)) | (b << np.uint64(21)) | c)
        weights.append(np.full(same.sum(), DECAY ** (k - 2)))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0)
    r, u, w = np.concatenate(rows), np.concatenate(names), np.concatenate(weights)
    norm = np.sqrt(np.bincount(r, w * w, len(strings)))
    return r, u, w / norm[r]


def look_up(strings: list[str], names: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Weighted sum over the triples of each string of the rows (or numbers) that ``table`` has for the sorted ``names``."""
    r, u, w = triples(strings)
    if not len(names):
        return np.zeros((len(strings), *table.shape[1:]))
    at = np.minimum(np.searchsorted(names, u), len(names) - 1)
    hit = names[at] == u
    r, at, w = r[hit], at[hit], w[hit]
    if table.ndim == 1:
        return np.bincount(r, w * table[at], len(strings))
    out = np.zeros((len(strings), table.shape[1]))
    order = np.argsort(r, kind="stable")
    for i in range(0, len(order), 5000):
        some = order[i : i + 5000]
        owners, first = np.unique(r[some], return_index=True)
        out[owners] += np.add.reduceat(w[some, None] * table[at[some]], first, axis=0)
    return out


class Kernel:
    """Kernel values of strings to a fixed list of landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        r, u, w = triples(landmarks)
        self.names, at = np.unique(u, return_inverse=True)
        self.table = np.zeros((len(self.names), len(landmarks)), np.float32)
        np.add.at(self.table, (at, r), w)

    def values(self, strings: list[str]) -> np.ndarray:
        return look_up(strings, self.names, self.table)


class Model:
    """Weights per triple, an intercept, and the squashing of a decision value to a score."""

    def __init__(self, kernel: Kernel, by_landmark: np.ndarray, intercept: float):
        self.names, self.intercept = kernel.names, intercept
        self.weights = kernel.table @ by_landmark
        self.slope, self.shift = 4.0, 0.0
        self.kept: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"kept": {}}

    def worst(self, texts: list[str | None]) -> list[tuple[float, str | None]]:
        """Decision value and name of each text's worst span; (minus infinity, None) without spans."""
        kept, found = self.kept, [spans(t) for t in texts]
        if len(kept) > KEPT_SPANS:
            kept.clear()
        new = list(set().union(*found).difference(kept))
        for i in range(0, len(new), 4000):
            some = new[i : i + 4000]
            cut = [parts(s) for s in some]
            owner = np.repeat(np.arange(len(some)), [len(c) for c in cut])
            worst = np.full(len(some), -np.inf)
            if len(owner):
                np.maximum.at(worst, owner, look_up([p for c in cut for p in c], self.names, self.weights))
            kept.update(zip(some, (worst + self.intercept).tolist()))
        out = []
        for f in found:
            top = max(f, key=kept.__getitem__, default=None)
            out.append((kept[top], top) if top is not None and kept[top] > -np.inf else (-np.inf, None))
        return out

    def score(self, decision: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * decision + self.shift, -500, 500)))) if decision > -np.inf else 0.0


def _sample(rows: DataFrame, per_class: int) -> DataFrame:
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    chance = F.pmod(F.xxhash64(F.lit("sample"), "key"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / max(1, sizes.get(1, 0)))).otherwise(min(1.0, per_class / max(1, sizes.get(0, 0))))
    return rows.where(chance < share)


def _evidence(a, n, b, m):
    """Signed log-likelihood ratio of a of n against b of m."""
    p, q, r = a / n, b / m, (a + b) / (n + m)
    part = lambda x, size, rate: x * np.log(np.maximum(rate, 1e-300)) + (size - x) * np.log(np.maximum(1 - rate, 1e-300))
    return 2 * np.sign(p - q) * (part(a, n, p) + part(b, m, q) - part(a, n, r) - part(b, m, r))


def _apart(names: list[str], most: int, besides: list[str] = []) -> list[str]:
    """The first ``most`` names whose kernel values with each other and with ``besides`` stay below 0.95."""
    if not names:
        return []
    gram, chosen = Kernel(besides + names).values(names), list(range(len(besides)))
    for i in range(len(names)):
        if len(chosen) == most + len(besides):
            break
        if not chosen or gram[i, chosen].max() < 0.95:
            chosen.append(len(besides) + i)
    return [names[i - len(besides)] for i in chosen[len(besides) :]]


def _train(examples: DataFrame, landmarks: list[str]) -> Model | None:
    """A linear machine on the Nyström coordinates of (span, label, weight) rows."""
    kernel = Kernel(landmarks)
    gram = kernel.values(landmarks)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    keep = value > 1e-6 * value.max()
    whiten = vector[:, keep] / np.sqrt(value[keep])

    def coordinates(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for c in columns:
            out, width = [], whiten.shape[1]
            for i in range(0, len(c), 2000):
                out.append((kernel.values(c.slice(i, 2000).to_pylist()) @ whiten).ravel())
            flat = np.concatenate(out) if out else np.empty(0)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1, dtype=np.int32) * width, pa.int32()), pa.array(flat))

    rows = materialize(examples.select(array_to_vector(F.arrow_udf(coordinates, "array<double>")("span")).alias("features"), "label", "weight").coalesce(4))
    if rows.select("label").distinct().count() < 2:
        return None
    machine = LinearSVC(regParam=1e-3, maxIter=40, weightCol="weight", standardization=False).fit(rows)
    return Model(kernel, whiten @ np.array(machine.coefficients), float(machine.intercept))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows_per_class: int = ROWS_PER_CLASS) -> Model | None:
    """Learn from the documents of ``docs`` that ``labels`` (key, label 0 or 1) marks."""
    marks = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("toxic")).where("key is not null and toxic in (0, 1)").groupBy("key").agg(F.max("toxic").alias("toxic"))
    chosen = _sample(docs.select(F.col(key).alias("key")).distinct().join(marks, "key"), rows_per_class)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text is not null").join(chosen, "key")
    rows = materialize(rows.select("text", "toxic").repartition(24))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS_AT_ONCE):
                some, got = batch.slice(i, ROWS_AT_ONCE), Counter()
                for t, y in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    got.update((p, y) for p in {p for s in spans(t) for p in parts(s)})
                names, n = [pa.array(x, k) for x, k in zip(zip(*got), (pa.string(), pa.int32()))] if got else [pa.array([], pa.string()), pa.array([], pa.int32())], list(got.values())
                yield pa.RecordBatch.from_arrays([*names, pa.array(n, pa.int64())], ["span", "toxic", "n"])

    counts = rows.mapInArrow(count, "span string, toxic int, n bigint").groupBy("span")
    counts = counts.agg(F.sum(F.expr("n * toxic")).alias("a"), F.sum(F.expr("n * (1 - toxic)")).alias("b"))
    counts = materialize(counts.where("a + b > 1"))
    n, m = sizes[1], sizes[0]
    suspects = counts.where(F.col("a") / n > F.col("b") / m).orderBy(F.desc(F.col("a") / n - 4 * F.col("b") / m), "span").limit(TOXIC_LANDMARKS * 3).toPandas()
    common = counts.where(F.col("b") / m >= F.col("a") / n).orderBy(F.desc("b"), "span").limit(CLEAN_LANDMARKS * 3).toPandas()["span"].tolist()
    suspects = suspects.assign(g=_evidence(suspects["a"].to_numpy(float), n, suspects["b"].to_numpy(float), m)).sort_values(["g", "span"], ascending=[False, True])
    strong = suspects[suspects["g"] >= EVIDENCE]
    strong = strong if len(strong) else suspects.head(4)
    if not len(strong) or not common:
        return None
    seeds = strong["span"].tolist()
    spark = docs.sparkSession
    first = [(s, 1.0, float(np.log1p(a))) for s, a in zip(seeds, strong["a"])] + [(s, 0.0, 1.0) for s in common]
    first += [(x, y, w) for s, y, w in first for x in gapped(s)]
    examples = spark.createDataFrame(first, "span string, label double, weight double")
    toxic = _apart(seeds, TOXIC_LANDMARKS)
    clean = _apart(common, CLEAN_LANDMARKS)
    model = _train(examples, toxic + clean)
    for _ in range(ROUNDS):
        if model is None:
            return None

        def mine(batches: Iterator[pa.RecordBatch], model: Model = model) -> Iterator[pa.RecordBatch]:
            for some in (batch.slice(i, ROWS_AT_ONCE) for batch in batches for i in range(0, batch.num_rows, ROWS_AT_ONCE)):
                found = zip(model.worst(some.column(0).to_pylist()), some.column(1).to_pylist())
                found = [(parts(span), float(y)) for (value, span), y in found if span is not None and (y == 0 or value > -1)]
                values = look_up([p for x, _ in found for p in x], model.names, model.weights).tolist()
                worst = [max((values.pop(0), p) for p in x)[1] for x, _ in found]
                yield pa.RecordBatch.from_arrays([pa.array(worst, pa.string()), pa.array([y for _, y in found], pa.float64())], ["span", "label"])

        mined = rows.mapInArrow(mine, "span string, label double").groupBy("span", "label").agg(F.log1p(F.count(F.lit(1)).cast("double")).alias("weight"))
        examples = materialize(examples.union(mined).groupBy("span", "label").agg(F.max("weight").alias("weight")))
        hard = examples.where("label = 0").orderBy(F.desc("weight"), "span").limit(CLEAN_LANDMARKS * 3).toPandas()["span"].tolist()
        hard = _apart([h for h in hard if h not in set(clean)], CLEAN_LANDMARKS, clean)
        model = _train(examples, toxic + clean + hard)
    if model is None:
        return None

    def values(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for c in columns:
            yield pa.array([v for i in range(0, len(c), ROWS_AT_ONCE) for v, _ in model.worst(c.slice(i, ROWS_AT_ONCE).to_pylist())], pa.float64())

    seen = rows.select("toxic", F.arrow_udf(values, "double")("text").alias("f")).where("f > -1e300").toPandas()  # 2 * rows_per_class numbers
    model.slope, model.shift = _squash(seen["f"].to_numpy(), seen["toxic"].to_numpy(float))
    return model


def _squash(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits labels to decision values, with softened targets (Platt)."""
    n, m = y.sum(), (1 - y).sum()
    if not n or not m:
        return 4.0, 0.0
    target = np.where(y > 0, (n + 1) / (n + 2), 1 / (m + 2))
    weight = np.where(y > 0, 0.5 / n, 0.5 / m)
    a, b = 1.0, 0.0
    x = np.stack([f, np.ones_like(f)], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * f + b, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 1e-6 * np.array([a, 0])
        curve = x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return max(float(a), 1e-3), float(b)


def predict(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add score and predicted to every row of ``docs``."""
    small_batches(docs.sparkSession)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for c in texts:
            out = []
            for i in range(0, len(c), ROWS_AT_ONCE):
                texts = c.slice(i, ROWS_AT_ONCE).to_pylist()
                out += [model.score(v) for v, _ in model.worst(texts)] if model else [0.0] * len(texts)
            yield pa.array(out, pa.float64())

    scored = docs.drop("score", "predicted").withColumn("score", F.arrow_udf(run, "double")(F.col(text).cast("string")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def detect(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", parts: int = 3, held: int = 1) -> DataFrame:
    """(key, held_out, score, predicted) for every row, learnt from labelled rows that are not held out."""
    out = F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == F.lit(held)
    model = fit(docs.where(~out), labels, key, text)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), out.alias("held_out"))
    return predict(rows, model, "__text").select(F.col("__key").alias(key), "held_out", "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    model = fit(docs, labels, key, text)
    said = predict(docs.select(F.struct("*").alias("__row"), F.col(text).alias("__text")), model, "__text")
    return said.where("predicted = 0").select("__row.*")
