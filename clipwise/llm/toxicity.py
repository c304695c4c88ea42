"""Toxicity by a weighted finite-state pattern grammar over clauses, weighted from labels."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import materialize, table, trimmed

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)

#: Seed words of each class, in English, French, German and Spanish; labels add insults and give weights.
SEEDS = {
    INSULT: "idiot moron imbecile dumb stupid scum vermin idiote imbécile crétin ordure dummkopf abschaum trottel estúpido escoria",
    THREAT: "kill hurt beat destroy shoot burn tuer frapper brûler töten schlagen verbrennen matar golpear quemar",
    TARGET: "you your you're he she they them people tu toi vous ton ils elles du dich dein ihr euch tú ti usted ustedes ellos ellas",
    NEGATION: "not never no isn't aren't don't ne pas jamais nicht kein keine nie nunca jamás ni",
    REPORT: "said says wrote claims claimed quote quoted allegedly dit écrit sagte sagt schrieb dijo dice escribió",
}
SEED_WEIGHT = 2.0
#: Words, and the marks that end a clause. A line break ends one too.
TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[.!?;:\n]")
ENDS = frozenset(".!?;:\n")


@dataclass(frozen=True)
class Transducer:
    """States 0..n-1, from 0; ``step(state, class)`` gives the next state, a scale and a bonus.

    The weights are affine maps: a token of weight w comes out as scale * w + bonus.
    """

    states: int
    step: Callable[[int, int], tuple[int, float, float]]

    def __matmul__(self, other: Transducer) -> Transducer:
        """Both read the same classes; scales multiply, bonuses add."""

        def step(state: int, cls: int) -> tuple[int, float, float]:
            a, s1, b1 = self.step(state // other.states, cls)
            b, s2, b2 = other.step(state % other.states, cls)
            return a * other.states + b, s1 * s2, b1 + b2

        return Transducer(self.states * other.states, step)

    def table(self) -> list[list[tuple[int, float, float]]]:
        return [[self.step(s, c) for c in range(END)] for s in range(self.states)]


def _after(opener: int, reach: int, effect: Callable[[int], tuple[float, float]]) -> Transducer:
    """``effect(class)`` on the tokens up to ``reach`` after one of class ``opener``."""

    def step(state: int, cls: int) -> tuple[int, float, float]:
        scale, bonus = effect(cls) if state else (1.0, 0.0)
        return reach if cls == opener else max(0, state - 1), scale, bonus

    return Transducer(reach + 1, step)


def _said(state: int, cls: int) -> tuple[int, float, float]:
    return int(state or cls == REPORT), 0.5 if state else 1.0, 0.0


GRAMMAR = (
    Transducer(1, lambda s, c: (0, 1.0 if c == INSULT else 0.0, 0.0))
    @ _after(THREAT, 4, lambda c: (1.0, 2.0 if c == TARGET else 0.0))
    @ _after(TARGET, 4, lambda c: (1.25 if c == INSULT else 1.0, 0.0))
    @ _after(NEGATION, 3, lambda c: (0.3, 0.0) if c == INSULT else (1.0, 0.0))
    @ Transducer(2, _said)
)


@dataclass
class Model:
    """Words and word beginnings of the insult class with their weights, and a logistic fit over clause scores."""

    insults: dict[str, float]
    coef: np.ndarray = field(default_factory=lambda: np.array([-3.0, 1.0, 0.5, 2.0]))
    center: np.ndarray = field(default_factory=lambda: np.zeros(3))
    scale: np.ndarray = field(default_factory=lambda: np.ones(3))


class Scorer:
    """Runs the grammar over texts. Known tokens are held, and forgotten between texts once they are ``cache`` many."""

    def __init__(self, model: Model, cache: int = 300_000) -> None:
        self.model, self.limit = model, cache
        self.table = GRAMMAR.table()
        self.fixed = {w: c for c, ws in SEEDS.items() for w in ws.split() if c != INSULT}
        self.longest = max(map(len, model.insults), default=0)
        self.shortest = min(map(len, model.insults), default=1)
        self.classes: dict[str, int] = {}
        self.weights: dict[str, float] = {}

    def _class(self, token: str) -> int:
        kind = END if token in ENDS else self.fixed.get(token, OTHER)
        if kind == OTHER:
            for n in range(min(self.longest, len(token)), self.shortest - 1, -1):
                if (w := self.model.insults.get(token[:n])) is not None:
                    kind, self.weights[token] = INSULT, w
                    break
        self.classes[token] = kind
        return kind

    def clauses(self, text: str | None) -> tuple[list[float], int]:
        """What the composed transducer gives each clause that it matches (one with an insult, or a threat to a target), and how many clauses there are."""
        if len(self.classes) > self.limit:
            self.classes.clear()
            self.weights.clear()
        tokens = TOKEN.findall((text or "").lower())
        get, new = self.classes.get, self._class
        codes = bytes([c if (c := get(t)) is not None else new(t) for t in tokens])
        out: list[float] = []
        count = a = 0
        if INSULT in codes or THREAT in codes:
            for part in codes.split(bytes([END])):
                count += bool(part)
                if INSULT in part or THREAT in part:
                    state, score = 0, 0.0
                    for i, c in enumerate(part, a):
                        state, scale, bonus = self.table[state][c]
                        if c == INSULT:
                            score += scale * self.weights[tokens[i]]
                        score += bonus
                    if score > 0:
                        out.append(score)
                a += len(part) + 1
        return out, count

    def features(self, text: str | None) -> list[float]:
        """The log of the clause scores' sum, the best one, and the share of clauses that match, beside 10 that don't; all 0 without a match.

        Nothing but matched clauses enters: a word counts only by what the grammar makes of its clause.
        """
        found, count = self.clauses(text)
        return [math.log1p(sum(found)), max(found, default=0.0), len(found) / (count + 10)]

    def probability(self, features: np.ndarray) -> np.ndarray:
        m = self.model
        z = m.coef[0] + ((features - m.center) / m.scale) @ m.coef[1:]
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def stems(word: str, least: int = 3, longest: int = 10) -> list[str]:
    """A word's beginnings of ``least`` to ``longest`` characters, and the word itself, however long."""
    out = [word[:i] for i in range(least, min(longest, len(word)) + 1)]
    return out if len(word) <= longest else [*out, word]


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per stem the documents that have it and the sum of log2(1 + its occurrences in one), by label; the empty stem has the totals."""
    docs, seen = {0: Counter(), 1: Counter()}, {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            own: Counter = Counter()
            for word, n in Counter(t for t in TOKEN.findall((text or "").lower()) if t not in ENDS).items():
                seen[toxic][""] += math.log2(1 + n)
                for s in stems(word):
                    own[s] += n
            docs[toxic].update(own.keys())
            for s, n in own.items():
                seen[toxic][s] += math.log2(1 + n)
    every = list(seen[0].keys() | seen[1].keys())
    for a in range(0, len(every), 50_000):
        part = every[a : a + 50_000]
        cols = [[x[s] for s in part] for x in (docs[1], docs[0])] + [[float(x[s]) for s in part] for x in (seen[1], seen[0])]
        yield pa.record_batch([part, *cols], ["stem", "toxic_docs", "clean_docs", "toxic", "clean"])


def learn_insults(labelled: DataFrame, *, min_docs: int = 3, min_gain: float = 20.0, min_lift: float = 2.5) -> dict[str, float]:
    """Word beginnings that mark toxic rows, with log ratios of their rates as weights.

    ``labelled`` has text and toxic (0 or 1). A stem is kept for the G-statistic of its occurrences (log2(1 + n) for
    n in one document), best first, unless it begins or is begun by one that is kept already; of equal ones the longest
    stays. All that reach ``min_gain`` are kept; as the labelled rows are bounded (see ``fit``), so are the stems.
    """
    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return {}
    schema = "stem string, toxic_docs long, clean_docs long, toxic double, clean double"
    counted = labelled.mapInArrow(trimmed(_stem_counts), schema).groupBy("stem").agg(*[F.sum(c).alias(c) for c in ("toxic_docs", "clean_docs", "toxic", "clean")])
    counted = materialize(counted.where(f"toxic_docs >= {min_docs} or stem = ''"), "stems")
    totals = counted.where("stem = ''").first()
    t1, t0 = (totals["toxic"] + 1, totals["clean"] + 1) if totals else (1.0, 1.0)
    part = lambda k, share: F.when(k > 0, k * F.log(k / ((F.col("toxic") + F.col("clean")) * share))).otherwise(0.0)
    good = (F.col("toxic_docs") * n0 > F.col("clean_docs") * n1 * min_lift)
    rows = (
        counted.where((F.col("stem") != "") & good)
        .withColumn("gain", F.round(2 * (part(F.col("toxic"), t1 / (t1 + t0)) + part(F.col("clean"), t0 / (t1 + t0))), 6))
        .where(F.col("gain") >= min_gain)
        .orderBy(F.desc("gain"), F.desc(F.length("stem")), "stem")
        .collect()
    )
    kept: dict[str, float] = {}
    begun: set[str] = set()  # proper beginnings of those kept
    for r in rows:
        s = r["stem"]
        begins = stems(s)[:-1]
        if s in begun or any(x in kept for x in begins):
            continue
        kept[s] = math.log((r["toxic"] + 0.5) / t1) - math.log((r["clean"] + 0.5) / t0)
        begun.update(begins)
    return kept


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps on standardised features."""
    center, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.hstack([np.ones((len(x), 1)), (x - center) / scale])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(len(w)), z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, center, scale


def fit(docs: DataFrame, labels: DataFrame, *, max_labelled: int = 8_000, seed: int = 0) -> Model:
    """Learns insults and the logistic fit from documents with a label.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic; several labels of an id count as
    toxic if one does; null labels are left out. At most about ``max_labelled`` labelled ids are used, picked by a hash;
    this is the bound of everything that reaches the driver. Without labels of both classes the seed
    words and fixed coefficients stand.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    share = min(1.0, max_labelled / max(1, known.count()))
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20)))
    tasks = docs.sparkSession.sparkContext.defaultParallelism
    labelled = materialize(docs.join(F.broadcast(picked), "doc_id").select("text", "toxic").repartition(tasks), "labelled")
    model = Model({w: SEED_WEIGHT for w in SEEDS[INSULT].split()})
    model.insults |= learn_insults(labelled)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            rows = [scorer.features(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([pa.array(rows, pa.list_(pa.float64())), batch.column("toxic")], ["x", "y"])

    rows = labelled.mapInArrow(trimmed(extract), "x array<double>, y int").toArrow()
    y = rows["y"].to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        order = np.lexsort(np.array(rows["x"].to_pylist()).T)  # the fit doesn't depend on the rows' order
        model.coef, model.center, model.scale = _fit(np.array(rows["x"].to_pylist())[order], y[order])
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1) to every row; only the text counts, all of it.

    A null text is an empty one, and gets the model's score for no matched clause, as do all texts without one. Rows are kept
    as they are, repeated ones too; an empty table gives no rows; a column named ``score`` is replaced. Time and memory are
    linear in a text.
    """
    docs = docs.drop("score")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):  # rows go back as they are scored, not a whole batch at once
                part = batch.slice(a, 256)
                x = np.array([scorer.features(t.as_py()) for t in part.column(text_col)])
                yield part.append_column("score", pa.array(scorer.probability(x)))

    return docs.mapInArrow(trimmed(run), schema)


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs.where(~held_out()), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
