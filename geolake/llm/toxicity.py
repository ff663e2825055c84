"""Toxicity of text as it was meant: noisy-channel restoring, then a learned lexicon.

Disguised words are spelt with look-alike characters (1d10t), spread out (i d i o t, i.d.i.o.t) or drawn out (idiooot). Each such
stretch becomes a lattice: what every character may stand for, with its cost. Viterbi picks the cheapest
path under a character language model (4-grams, counted over all texts). Restored words join the words of the text;
the three most telling ones, by weights learned from labelled texts, give the score.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import labelled, with_texts
from .shared import forget, slices, stored

#: Labelled rows that the weights are learned from, terms of the lexicon, texts that a term must be in.
SAMPLE, TERMS, SUPPORT = 20_000, 20_000, 3
PREFIXES = range(3, 9)
REMEMBERED, LONGEST = 300_000, 64
THRESHOLD = 0.3
#: Weight of texts without any known word, and the bounds of weights.
LOW, HIGH = 0.0, 9.0
TOLD = ("first", "second", "third")

# What a character may stand for besides itself.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
ANY = "aeiou"  # what an asterisk may hide
SEPARATORS = " .-_*~"
_WORD = re.compile(r"[^\W\d_]+")
_SUSPECT = re.compile(r"[^\W\d_][0-9@$!|+(€£*._~\-]+[^\W\d_]|[0-9@$!|+(€£][^\W\d_]|([^\W\d_])\1\1")
_SPREAD = re.compile(r"(?<![^\W_])(?:[^\W_@$!]|[@$!])(?:[ .\-_*~](?:[^\W_]|[@$!])){2,}(?![^\W_])")
_FOLD = str.maketrans("àáâãäåçèéêëìíîïñòóôõöùúûüýÿß", "aaaaaaceeeeiiiinooooouuuuyys")

SIGNS = 32  # 0: no letter; 1 to 26: a to z
_SIGN = np.zeros(256, dtype=np.int64)
for _c in range(256):
    _letter = chr(_c).lower().translate(_FOLD)
    if "a" <= _letter <= "z":
        _SIGN[_c] = ord(_letter) - 96


def signs(data: bytes) -> np.ndarray:
    return _SIGN[np.frombuffer(data.decode("utf-8", "replace").encode("latin-1", "replace"), dtype=np.uint8)]


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a sign after three others: SIGNS ** 4 numbers, from the 4-grams of all texts.

    Tasks add up their counts before they send those that aren't 0; the table's size is fixed.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        total = np.zeros(SIGNS**4, dtype=np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for at in range(0, len(texts), 64):
                s = signs(b"   " + b"   ".join(texts[at : at + 64]) + b" ")
                # Runs of other characters count once: words follow each other.
                s = s[(s > 0) | (np.concatenate(([1], s[:-1])) > 0)]
                s = np.concatenate(([0, 0], s))
                total += np.bincount(((s[:-3] * SIGNS + s[1:-2]) * SIGNS + s[2:-1]) * SIGNS + s[3:], minlength=SIGNS**4)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["gram", "n"])

    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    grams = texts.mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SIGNS**4)
    counts[grams.column("gram").to_numpy()] = grams.column("n").to_numpy()
    counts = counts.reshape((SIGNS,) * 4)
    # Each order leans on the one below as if it had seen STRENGTH more signs like it.
    p = np.full(SIGNS, 1 / SIGNS)
    for axes in ((0, 1, 2), (0, 1), (0,), ()):
        c = counts.sum(axis=axes)
        p = (c + 5.0 * p) / (c.sum(axis=-1, keepdims=True) + 5.0)
    return np.log(p).astype(np.float32).ravel()


class Channel:
    """Restores disguised words; remembers, within bounds, what it has restored."""

    def __init__(self, model: np.ndarray):
        self.model = memoryview(model)  # a list would hold an object for each of a million numbers
        self.known: dict[str, str] = {}

    def lattice(self, text: str) -> list[list[tuple[str, float]]]:
        """For each run of a character what it may stand for, with the cost of each."""
        places = []
        for run in re.finditer(r"(.)\1*", text, re.S):
            c, n = run[1], len(run[0])
            letter = c.translate(_FOLD)
            if "a" <= letter <= "z":
                options = [(letter, 0.0)] if n == 1 else [(letter * 2, 0.0 if n == 2 else 1.0), (letter, 3.0 if n == 2 else 0.5)]
            elif c == "*":
                options = [("", 1.0)] + [(v, 2.0) for v in ANY]
            elif c in SEPARATORS:
                options = [("", 0.0)]
            elif c in LOOKALIKES:
                options = [(x * k, 1.0 + 0.5 * (k - 1)) for x in LOOKALIKES[c] for k in range(1, min(n, 2) + 1)] + [("", 4.0)]
            else:
                options = [("", 1.0)]
            places.append(options)
        return places

    def restore(self, text: str) -> str:
        found = self.known.get(text)
        if found is None:
            found = self._viterbi(text)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[text] = found
        return found

    def _viterbi(self, text: str) -> str:
        paths: dict[int, tuple[float, str]] = {0: (0.0, "")}  # by the last three signs
        for options in [*self.lattice(text), [("\0", 0.0)]]:
            after: dict[int, tuple[float, str]] = {}
            for state, (cost, path) in paths.items():
                for letters, price in options:
                    total, now = cost + price, state
                    for letter in letters:
                        sign = ord(letter) - 96 if letter > "\0" else 0
                        total -= self.model[now * SIGNS + sign]
                        now = (now * SIGNS + sign) % SIGNS**3
                    if now not in after or total < after[now][0]:
                        after[now] = (total, path + letters)
            paths = after
        return min(paths.values())[1].rstrip("\0")

    def restored(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, word) of each disguised stretch of a lower-case text."""
        found, done = [], 0
        for m in _SPREAD.finditer(text):
            if len(m[0]) <= 2 * LONGEST:
                found.append((m.start(), m.end(), self.restore(m[0])))
        for m in _SUSPECT.finditer(text):
            if m.start() < done:
                continue
            start, end = m.start(), m.end()
            low, high = max(0, start - LONGEST), end + LONGEST
            start -= len(text[low:start].split(" ")[-1].split("\n")[-1])
            end += len(re.split(r"\s", text[end:high], maxsplit=1)[0])
            done = end
            token = text[start:end].strip(".,;:?*-_~")
            letters = sum(map(str.isalpha, token))
            # A longer stretch, or one of few letters, is a number, an address, a key or a row of marks.
            if len(token) <= LONGEST and 5 * letters >= 2 * len(token) and "://" not in token and "=" not in token:
                found.append((start, end, self.restore(re.sub(r"([^\w\s])\1+$|!+$", "", token))))
        return found

    def words(self, data: bytes) -> set[str]:
        text = data.decode("utf-8", "replace").lower()
        return set(_WORD.findall(text)).union(w for _, _, w in self.restored(text) if w)


def terms(word: str) -> list[str]:
    """A word and its beginnings, which carry a meaning through many endings."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


@dataclass
class Model:
    language: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    line: tuple[float, ...] = (-30.0, 0.0, 0.0, 0.0)  # what no labelled text can tell scores 0


class Weights(dict):
    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.terms = weights

    def __missing__(self, word: str) -> float:
        found = max((self.terms.get(t, LOW) for t in terms(word)), default=LOW)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


def telling(words: set[str], weights: Weights) -> list[float]:
    """The three largest weights among the words."""
    return (heapq.nlargest(len(TOLD), map(weights.__getitem__, words)) + [LOW] * len(TOLD))[: len(TOLD)]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Weights from at most ``sample`` labelled learning rows; the language model from all rows of ``docs``.

    Three quarters of the sample (by hash) give the terms and their weights, the rest the line from the most telling
    weights to a probability. Without labels of both kinds every score is near the share of toxic texts, or 0.
    """
    spark = docs.sparkSession
    model = Model(language_model(docs))
    language = spark.sparkContext.broadcast(model.language)
    rows = labelled(labels, "toxic", sample).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(4)))
    texts = stored(with_texts(docs, rows).select(F.col("text").cast("binary").alias("text"), F.col("label").cast("int").alias("label"), F.col("part").cast("int").alias("part")).repartition(16), "labelled")

    def count(wanted: set[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            channel, seen = Channel(language.value), Counter()
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    own = {t for w in channel.words(text) if len(w) <= LONGEST for t in terms(w)}
                    seen.update(own if wanted is None else own & wanted)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), type=pa.string()), pa.array(list(seen.values()), type=pa.int64())], names=["term", "n"])

        return run

    learning = texts.filter("part > 0")
    counted = learning.filter("label = 1").select("text").mapInArrow(count(None), "term string, n bigint")
    toxic = counted.groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= SUPPORT).orderBy(F.desc("n"), "term").limit(TERMS)
    found = {r.term: r.n for r in toxic.collect()}
    clean = learning.filter("label = 0").select("text").mapInArrow(count(set(found)), "term string, n bigint")
    against = {r.term: r.n for r in clean.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    size = {r.label: r.n for r in learning.groupBy("label").agg(F.count("*").alias("n")).collect()}
    odds = lambda n, of: (n + 0.5) / (of - n + 0.5)
    for term, n in found.items():
        other = against.get(term, 0)
        weight = math.log(odds(n, size.get(1, 0))) - math.log(odds(other, size.get(0, 0)))
        # Two standard errors less: of many terms some stand in toxic texts alone by chance.
        weight -= 2 * math.sqrt(1 / (n + 0.5) + 1 / (other + 0.5))
        model.weights[term] = min(max(weight, LOW), HIGH)
    # Only what speaks for toxicity tells; the rest of the terms would only be looked up.
    model.weights = {t: w for t, w in model.weights.items() if w > 0.5}
    pairs = _telling(texts.filter("part = 0"), model, ["label"]).toArrow()
    model.line = _fit(pairs.column("label").to_numpy(), [pairs.column(t).to_numpy() for t in TOLD])
    return model


def _fit(label: np.ndarray, told: list[np.ndarray]) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a small ridge."""
    if not len(label):
        return Model.line
    if not 0 < label.sum() < len(label):
        return (math.log((label.sum() + 0.5) / (len(label) - label.sum() + 0.5)), *(0.0 for _ in TOLD))
    x, w = np.column_stack([np.ones(len(label)), *told]), np.zeros(1 + len(told))
    ridge = np.diag([1e-3, *(0.05 for _ in told)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (label - p) - ridge @ w)
        w += np.clip(step, -2, 2)
    return tuple(float(v) for v in w)


def _telling(rows: DataFrame, model: Model, columns: list[str], back: bool = False) -> DataFrame:
    """Adds the most telling weights to rows of ``columns`` and text, whose bytes come ``back`` if asked for."""
    spark = rows.sparkSession
    shipped = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        channel, weights = Channel(shipped.value.language), Weights(shipped.value.weights)
        for batch in slices(batches):
            texts = [t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()]
            pairs = [telling(channel.words(t), weights) for t in texts]
            found = [pa.array([p[k] for p in pairs], type=pa.float64()) for k in range(len(TOLD))]
            upto = batch.num_columns if back else -1
            yield pa.RecordBatch.from_arrays([*batch.columns[:upto], *found], names=[*batch.schema.names[:upto], *TOLD])

    kept = rows.select(*[F.col(f"`{c}`") for c in columns], F.col("text").cast("binary").alias("_bytes"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in (kept.schema if back else kept.schema[:-1]))
    return kept.mapInArrow(run, f"{schema}, " + ", ".join(f"{t} double" for t in TOLD))


def with_scores(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """Adds ``name``, 0 to 1. Whole texts count; a null text is empty. Other columns stay, but for one of that name."""
    columns = [c for c in docs.columns if c.lower() != name.lower()]
    # The text goes to Python and back once, as bytes.
    others = {c: f"_{k}" for k, c in enumerate(columns) if c.lower() != "text"}
    told = _telling(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in others.items()], F.col("text")), model, list(others.values()), back=True)
    line = F.lit(model.line[0])
    for slope, column in zip(model.line[1:], TOLD):
        line = line + F.lit(slope) * F.col(column)
    score = 1 / (1 + F.exp(-line))
    return told.select(*[(F.col(others[c]) if c in others else F.col("_bytes").cast("string")).alias(c) for c in columns], score.alias(name))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with the same columns. Rows equal to others are judged each."""
    return with_scores(docs, learn(docs, labels), "_toxicity").filter(F.col("_toxicity") < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def restore_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and the lower-case text with disguised words restored."""
    shipped = docs.sparkSession.sparkContext.broadcast(model.language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel = Channel(shipped.value)
        for batch in batches:
            out = []
            for data in batch.column(1).to_pylist():
                text, at, parts = data.decode("utf-8", "replace").lower(), 0, []
                for start, end, word in sorted(channel.restored(text)):
                    if start >= at:
                        parts += [text[at:start], word]
                        at = end
                out.append("".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.string())], names=["doc_id", "restored"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).mapInArrow(run, f"doc_id {kind}, restored string")
