"""Operator 10: toxicity scores of texts restored by a noisy-channel decoder.

1. *Language model.* Character trigrams (lower case, with word ends) are
   counted over all texts in one pass; the counts live in ``ALPHABET ** 3``
   cells at most, whatever the input, so they may be shared by broadcast.
2. *Decoding.* Words that mix letters with look-alike signs, repeat a letter
   three times or more, or are spelled out in single characters become a
   character lattice: a sign may stand for each letter it looks like, a run of
   equal letters for a shorter one, the space between single characters for
   nothing or for itself. Viterbi search under the language model and the
   channel costs picks the restored words; all other words are the only path
   of their lattice and stay as they are.
3. *Lexicon.* Over the distinct labelled training texts, the number of toxic
   and clean ones that hold each restored word or word start (``STARTS``) gives
   a log-odds ratio, taken at its lower confidence bound. The ``LEXICON``
   strongest are kept.
4. *Score.* A logistic regression over a text's strongest words. For training
   rows the row's own count is taken out of the lexicon first, so the model
   sees its words as strong as they would look in an unseen text.

The training rows are bounded by ``max_training_rows`` (those with the smallest
key hash), a parameter of ``fit``. Everything else covers all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from attrix.llm.common import stored, text_batches
from attrix.llm.encoding import release

MAX_TRAINING_ROWS = 40_000
LEXICON = 100_000
STARTS = (4, 5, 6)
TOP = 5
THRESHOLD = 0.7
CACHE_ENTRIES = 400_000

#: fixed values: letters that a sign or digit is written for
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
_EDGE = ".,;:!?|\"'()[]{}<>«»“”„…-–—*_/\\"
_OUTSIDE = ".,;:?\"'()[]{}<>"
_SIGN = re.compile(r"[0134578@$!|+(9€]|([^\W\d_])\1\1")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
_LETTER = re.compile(r"[^\W\d_]")

# channel costs (negative log probabilities)
COST_LOOK, COST_CUT, COST_SHORTER, COST_JOIN, COST_KEEP_SPACE = 1.0, 10.0, 0.7, 0.3, 1.5
BEAM = 48

#: 0 = word end, 1..26 = a..z, then the letters U+00DF..U+00FF, 59 = another letter
ALPHABET = 60
_CODES = np.zeros(0x110000, dtype=np.uint8)
_CODES[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CODES[ord("A"):ord("Z") + 1] = np.arange(1, 27)
_CODES[0xDF:0x100] = np.arange(27, 60).clip(max=59)
_CODES[0xC0:0xDF] = _CODES[0xE0:0xFF]
_CODES[0x100:0x2000] = 59
_CODES[0x2C00:0xE000] = 59
_CODES[0xF7] = _CODES[0xD7] = 0


def char_codes(text: str) -> np.ndarray:
    return _CODES[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    counts = np.zeros(ALPHABET ** 3, dtype=np.int64)
    for _, texts in text_batches(batches, [], "text", 1 << 20):
        c = char_codes("\n" + "\n".join(t or "" for t in texts) + "\n").astype(np.int32)
        c = c[np.concatenate(([True], (c[1:] != 0) | (c[:-1] != 0)))]  # one word end between words
        if len(c) > 2:
            tri = (c[:-2] * ALPHABET + c[1:-1]) * ALPHABET + c[2:]
            # a word starts from two ends: (end, end, first letter)
            start = c[1:][(c[:-1] == 0) & (c[1:] != 0)]
            counts += np.bincount(tri[c[1:-1] != 0], minlength=ALPHABET ** 3)
            counts[:ALPHABET] += np.bincount(start, minlength=ALPHABET)
    keep = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int32()), pa.array(counts[keep])], names=["cell", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Costs (negative log probabilities) of a letter after two others, from all texts."""
    cells = (docs.select(F.col(text_col).alias("text")).mapInArrow(_count_trigrams, "cell int, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())  # at most ALPHABET ** 3 rows
    counts = np.zeros(ALPHABET ** 3)
    counts[cells["cell"].to_numpy(dtype=np.int64)] = cells["n"].to_numpy(dtype=np.float64)
    counts = counts.reshape(ALPHABET, ALPHABET, ALPHABET)
    pair = counts.sum(0) + 0.02
    backoff = pair / pair.sum(1, keepdims=True)
    smooth = counts + 2.0 * backoff[None, :, :]
    return (-np.log(smooth / smooth.sum(2, keepdims=True))).astype(np.float32)


def _lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per position the strings it may stand for, with their channel costs."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        ch = token[i]
        j = i
        while j < len(token) and token[j] == ch:
            j += 1
        run = j - i
        if ch in " \t":
            out.append([("", COST_JOIN), (" ", COST_KEEP_SPACE)])
        elif ch in LOOKS:
            for _ in range(run):
                out.append([(x, COST_LOOK) for x in LOOKS[ch]] + [(" ", COST_CUT)])
        elif _LETTER.match(ch):
            if run >= 3:
                out.append([(ch, COST_SHORTER), (ch * 2, COST_SHORTER), (ch * run, 0.0)])
            else:
                out.append([(ch * run, 0.0)])
        else:
            out.append([(" ", 0.0)])
        i = j
    return out


def restore(token: str, costs: np.ndarray) -> list[str]:
    """The words of the cheapest path through the token's lattice."""
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for options in _lattice(token):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (cost, path) in states.items():
            for letters, channel in options:
                x, y, total = a, b, cost + channel
                for ch in letters:
                    c = int(_CODES[ord(ch)])
                    if c == 0:
                        if y != 0:
                            total += float(costs[x, y, 0])
                        x, y = 0, 0
                    else:
                        total += float(costs[x, y, c])
                        x, y = y, c
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, (path, letters))
        states = dict(sorted(after.items(), key=lambda s: s[1][0])[:BEAM])
    best = min(((cost + (float(costs[a, b, 0]) if b else 0.0), path) for (a, b), (cost, path) in states.items()),
               key=lambda s: s[0])[1]
    parts = []
    while best:
        best, letters = best
        parts.append(letters)
    return "".join(reversed(parts)).split()


class Restorer:
    """Restored words, kept per distinct written word in a bounded cache."""

    def __init__(self, costs: np.ndarray, value=lambda words: words):
        self.costs = costs
        self.value = value  # what to keep of a written word's restored words
        self.cache: dict[str, object] = {}

    def restored(self, word: str) -> tuple[str, ...]:
        plain = word.strip(_EDGE)
        if plain.isalpha():
            odd = _TRIPLE.search(plain) or (word[0] in LOOKS)
        else:
            odd = _SIGN.search(word) and _LETTER.search(word)
        if not odd:
            return (plain,) if plain else ()
        found = restore(word.strip(_OUTSIDE) if not plain.isalpha() else word.strip(_OUTSIDE).rstrip(_EDGE), self.costs)
        return tuple(dict.fromkeys([*found, plain] if plain.isalpha() else found))

    def of(self, text: str | None) -> tuple[list, int]:
        """What ``value`` keeps of each distinct written word (spelled-out runs
        count as words), and the number of distinct written words."""
        if not text:
            return [], 0
        low = text.lower()
        words = set(low.split())
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        got = list(map(self.cache.get, words))
        if None in got:
            for word in [w for w, g in zip(words, got) if g is None]:
                v = self.value(self.restored(word))
                if len(word) <= 64:
                    self.cache[word] = v
                got.append(v)
            got = [g for g in got if g is not None]
        got += [self.value(tuple(restore(run, self.costs))) for run in set(_SPELLED.findall(low))]
        return got, len(words)

    def words(self, text: str | None) -> set[str]:
        return set().union(*self.of(text)[0])


_TAGS = [(k, f"{k}:") for k in STARTS]


def word_features(word: str) -> list[str]:
    """The word itself and its starts of ``STARTS`` letters."""
    out = ["=" + word]
    for k, tag in _TAGS:
        if len(word) > k:
            out.append(tag + word[:k])
    return out


def features_of(words: tuple[str, ...]) -> tuple[str, ...]:
    return tuple(word_features(words[0])) if len(words) == 1 else tuple({f for w in words for f in word_features(w)})


def _strength(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Log-odds ratio at its lower confidence bound; features of under two toxic texts count nothing."""
    odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    bound = odds - 1.5 * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return np.where(toxic >= 2, np.maximum(bound, 0.0), 0.0)


@dataclass
class ToxicityModel:
    costs: np.ndarray
    lexicon: dict[str, tuple[int, int]]
    n_toxic: int
    n_clean: int
    weights: np.ndarray
    intercept: float


_INPUTS = [f"x{i}" for i in range(TOP + 2)]
SHORT, LONG = 20, 2000  # words between which a text's length counts


def _inputs(values: np.ndarray, n_words: int) -> list[float]:
    """The strongest words, how many come near the strongest (as a root), and the
    length, since a long text holds weak words by chance. A text without any
    lexicon word is all zeros, however long it is."""
    if not len(values) or values.max() <= 0:
        return [0.0] * (TOP + 2)
    top = np.sort(values)[::-1][:TOP]
    near = float(np.sqrt((values > 0.7 * top[0]).sum()))
    return [*top.tolist(), *[0.0] * (TOP - len(top)), near, math.log1p(min(max(n_words, SHORT), LONG)) - math.log1p(SHORT)]


def _regression(rows: DataFrame, inputs: list[str]):
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(rows)
    return LogisticRegression(regParam=0.002, maxIter=50, featuresCol="features", labelCol="label").fit(vectors)


def fit(docs: DataFrame, labels: DataFrame, train: str, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_training_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """Fit language model, lexicon and regression.

    ``train`` is an SQL condition on the id column that chooses the training
    rows. Rows without text or label are not trained on; of equal texts with an
    equal label one is. With no toxic or no clean training row every score is
    the share of toxic rows (0 without any row).
    """
    spark = docs.sparkSession
    costs = character_model(docs, text_col)
    shared = spark.sparkContext.broadcast(costs)
    known = (labels.where(train).where(F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
             .orderBy(F.xxhash64("id"), "id").limit(max_training_rows))
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
                  .join(F.broadcast(known), "id")  # at most max_training_rows ids
                  .groupBy(F.xxhash64("text").alias("t"), "toxic").agg(F.first("text").alias("text")), "toxicity-train")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        share = n_toxic / (n_toxic + n_clean) if n_toxic + n_clean else 0.0
        odds = min(max(share, 1e-9), 1 - 1e-9)
        return ToxicityModel(costs, {}, n_toxic, n_clean, np.zeros(TOP + 2), math.log(odds / (1 - odds)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, held = Restorer(shared.value, features_of), (Counter(), Counter())

        def out(y: int) -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays(
                [pa.array(list(held[y]), pa.string()), pa.array([y] * len(held[y]), pa.int32()),
                 pa.array(list(held[y].values()), pa.int64())], names=["feature", "toxic", "n"])
            held[y].clear()
            return b
        for (toxic,), texts in text_batches(batches, ["toxic"], "text"):
            for y, t in zip(toxic, texts):
                held[int(y > 0)].update(set().union(*restorer.of(t)[0]))
                if len(held[int(y > 0)]) > 500_000:
                    yield out(int(y > 0))
        yield from map(out, (0, 1))

    counted = (rows.repartition(spark.sparkContext.defaultParallelism).mapInArrow(count, "feature string, toxic int, n long")
               .groupBy("feature").agg(F.sum(F.expr("if(toxic = 1, n, 0)")).alias("t"),
                                       F.sum(F.expr("if(toxic = 0, n, 0)")).alias("c")).where("t >= 2"))
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1)) - F.log((F.col("c") + 0.5) / (n_clean + 1))
    bound = odds - 1.5 * F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = (counted.withColumn("s", bound).where("s > 0").orderBy(F.desc("s"), "feature").limit(LEXICON).toPandas())
    lexicon = {f: (int(t), int(c)) for f, t, c in zip(best["feature"], best["t"], best["c"])}
    words = spark.sparkContext.broadcast(lexicon)

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = words.value
        restorer = Restorer(shared.value, lambda found: tuple(
            (w, tuple(lexicon[f] for f in word_features(w) if f in lexicon)) for w in found
            if any(f in lexicon for f in word_features(w))))
        for (toxic,), texts in text_batches(batches, ["toxic"], "text"):
            xs = []
            for y, t in zip(toxic, texts):
                got, n = restorer.of(t)
                hits = list(dict(h for g in got for h in g).values())
                values = np.zeros(0)
                if hits:
                    flat = np.array([h for hs in hits for h in hs], dtype=np.float64)
                    own = _strength(flat[:, 0] - y, flat[:, 1] - (1 - y), n_toxic - y, n_clean - (1 - y))
                    values = np.maximum.reduceat(own, np.cumsum([0] + [len(h) for h in hits[:-1]]))
                xs.append(_inputs(values, n))
            cols = np.array(xs, dtype=np.float64).reshape(-1, TOP + 2)
            yield pa.RecordBatch.from_arrays([pa.array(cols[:, i]) for i in range(TOP + 2)]
                                             + [pa.array([float(y) for y in toxic])], names=_INPUTS + ["label"])

    train_set = stored(rows.repartition(spark.sparkContext.defaultParallelism)
                       .mapInArrow(inputs, ", ".join(f"{x} double" for x in _INPUTS) + ", label double"), "toxicity-inputs")
    lr = _regression(train_set, _INPUTS)
    if lr.coefficients[-1] > 0:  # length must not raise a score: it only tells how much chance there was
        lr = _regression(train_set, _INPUTS[:-1])
    weights = np.zeros(TOP + 2)
    weights[:len(lr.coefficients)] = lr.coefficients.toArray()
    return ToxicityModel(costs, lexicon, n_toxic, n_clean, weights, float(lr.intercept))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 when the score reaches ``threshold``).

    A null or empty text has no words and gets the model's base score. Every
    row is kept, with its other columns; columns of these two names are replaced.
    """
    spark = docs.sparkSession
    strong = _strength(np.array([v[0] for v in model.lexicon.values()], dtype=np.float64),
                       np.array([v[1] for v in model.lexicon.values()], dtype=np.float64),
                       model.n_toxic, model.n_clean) if model.lexicon else np.zeros(0)
    shared = spark.sparkContext.broadcast(
        (model.costs, dict(zip(model.lexicon, strong.tolist())), model.weights, model.intercept))
    base = docs.drop("score", "predicted")
    names = base.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        costs, lexicon, weights, intercept = shared.value
        # of most words nothing is kept: they are not in the lexicon
        restorer = Restorer(costs, lambda found: tuple(
            (w, v) for w in found if (v := max(lexicon.get(f, 0.0) for f in word_features(w))) > 0.0))
        for b in batches:
            got = []
            for t in b.column(at).to_pylist():
                found, n = restorer.of(t)
                strong = dict(h for g in found for h in g)
                z = intercept + float(np.dot(weights, _inputs(np.array(list(strong.values())), n)))
                got.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(got, pa.float64()), pa.array([int(s >= threshold) for s in got], pa.int32())],
                names=[*(f"c{i}" for i in range(len(names))), "score", "predicted"])

    # columns go through by position, so that clashing or odd names do no harm
    plain = base.toDF(*(f"c{i}" for i in range(len(names))))
    schema = StructType([*plain.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return plain.mapInArrow(run, schema).toDF(*names, "score", "predicted")


TRAIN_FOLD = "pmod(crc32(cast(doc_id AS string)), 3) <> 1"


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, fitted on the rows that are not held out."""
    model = fit(docs, labels, TRAIN_FOLD)
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(~F.expr(TRAIN_FOLD), F.lit(False)).alias("held_out"), "score", "predicted")
