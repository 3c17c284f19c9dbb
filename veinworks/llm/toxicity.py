"""Toxicity: a support vector machine over a gap-weighted subsequence kernel of words.

The kernel of two words adds up the triples of characters that both hold in the
same order; a triple counts less the more it is stretched, so a word with
inserted, doubled or missing characters stays near. Landmarks are word starts
and words that labelled toxic documents hold more often than clean ones; by
Nyström's method the kernel with them stands for the whole kernel. A sentence
has, for each landmark, its best match. The machine is trained on the sentences
that match a landmark best within their labelled document; after a first fit, a
toxic document keeps those of them that look toxic, at least the worst one. A
logistic fit turns the decisions of a document's sentences into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veinworks.llm.base import crc_fold, map_arrow, query, table, texts, written

DECAY, SHARPNESS, LEAST_MATCH = 0.6, 3, 0.45
TRAIN_DOCS = 12_000  # bound of the labelled sample, by hash of the id
LANDMARKS, CANDIDATES, LEAST_DOCS, LEAST_LIFT, ALIKE = 24, 600, 5, 6.0, 0.7
LEAST_SHARE = 0.25  # of the clearest candidate's lift
LONGEST = 9  # characters of a landmark
ROUNDS = 2
CHUNK = 2048  # words in turn
TOKENS = 200_000  # of which a task remembers the matches
AROUND = ".,;:!?\"'()[]{}<>*_-"
ENDS = ".!?"
LETTERS_APART = re.compile(r"(?<!\S)\w(?:[ \t]\w)+(?![^\s.,;:!?])")


def framed(word: str) -> str:
    """A word with marks of its start and end, which match as characters do."""
    return f"^{word}$"


def spellings(token: str) -> list[str]:
    """The word of a token, and its letters alone where something stands between them."""
    word = token.strip(AROUND)
    if word.isalpha():
        return [framed(word)]
    letters = "".join(filter(str.isalpha, word))
    return [framed(w) for w in dict.fromkeys((word, letters)) if w]


def sentences(text: str) -> list[list[str]]:
    """Tokens of each sentence; single letters in a row, put together, are a sentence of their own."""
    out = []
    for line in text.lower().split("\n"):
        out += [["".join(run.split())] for run in LETTERS_APART.findall(line)]
        own = []
        for token in line.split():
            own.append(token)
            if token[-1] in ENDS:
                out.append(own)
                own = []
        if own:
            out.append(own)
    return out


def tokens(text: str) -> set[str]:
    text = text.lower()
    return set(text.split()).union("".join(run.split()) for run in LETTERS_APART.findall(text))


class Kernel:
    """Matches of words with landmarks: the kernel over the landmark's own, at most 1, to a power."""

    def __init__(self, landmarks: list[str], decay: float = DECAY):
        self.landmarks, self.decay, self.width = landmarks, decay, max(map(len, landmarks))
        self.codes = {c: k + 1 for k, c in enumerate(sorted(set("".join(landmarks))))}
        self.of_point = np.zeros(max(map(ord, self.codes)) + 2, np.int32)  # the last one answers for all beyond
        for c, k in self.codes.items():
            self.of_point[ord(c)] = k
        self.same = np.zeros((len(self.codes) + 1, len(landmarks), self.width), np.float32)
        for k, landmark in enumerate(landmarks):
            for at, c in enumerate(landmark):
                self.same[self.codes[c], k, at] = decay * decay
        steps = np.arange(self.width)[None, :] - np.arange(self.width)[:, None]
        self.spread = np.where(steps >= 0, float(decay) ** np.abs(steps), 0).astype(np.float32)
        self.first = self.same @ self.spread
        self.own = np.maximum(np.diag(self.sums(landmarks)), 1e-9)

    def sums(self, words: list[str]) -> np.ndarray:
        """The kernel of words (rows) and landmarks, character by character for all words at once.

        Words that start alike share their state, as do those that differ only
        in characters that no landmark holds.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.zeros((len(words), lengths.max(initial=0)), np.int32)
        places = np.arange(len(points)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        codes[np.repeat(np.arange(len(words)), lengths), places] = self.of_point[np.minimum(points, len(self.of_point) - 1)]
        result = np.zeros((len(words), len(self.landmarks)), np.float32)
        one = np.zeros((1, len(self.landmarks), self.width), np.float32)  # first of the triple seen
        two, out = np.zeros_like(one), np.zeros(one.shape[:2], np.float32)
        alive, state = np.flatnonzero(lengths), np.zeros(len(words), np.int64)
        for at, column in enumerate(codes.T):
            alive = alive[lengths[alive] > at]
            states, own = np.unique(state[alive] * len(self.same) + column[alive], return_inverse=True)
            before, char = np.divmod(states, len(self.same))
            same, one, two = self.same[char], one[before], two[before]
            out = out[before] + np.einsum("nmt,nmt->nm", same[:, :, 1:], two[:, :, :-1])
            second = same[:, :, 1:] * one[:, :, :-1]
            two *= self.decay
            two[:, :, 1:] += second @ self.spread[1:, 1:]
            one *= self.decay
            one += self.first[char]
            state[alive] = own
            ended = lengths[alive] == at + 1
            result[alive[ended]] = out[own[ended]]
        return result

    def __call__(self, words: list[str]) -> np.ndarray:
        """Matches of words; sorted chunks share most of their starts."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        order = sorted(range(len(words)), key=words.__getitem__)
        for start in range(0, len(order), CHUNK):
            rows = order[start : start + CHUNK]
            out[rows] = self.sums([words[k] for k in rows])
        return np.minimum(out / self.own, 1) ** SHARPNESS


class Matches:
    """What a task remembers: tokens seen, the words they spell, and the matches of tokens that have any."""

    def __init__(self, kernel: Kernel):
        self.kernel, self.seen, self.words, self.hot = kernel, set(), {}, {}

    def learn(self, found: set[str]) -> None:
        new = found - self.seen
        if not new:
            return
        if len(self.seen) + len(new) > TOKENS:
            self.seen, self.words, self.hot, new = set(), {}, {}, found
        self.seen.update(new)
        spelled = {t: spellings(t) for t in new}
        words = [w for w in dict.fromkeys(w for own in spelled.values() for w in own) if w not in self.words]
        if words:
            rows = self.kernel(words)
            rows[rows < LEAST_MATCH**SHARPNESS] = 0
            self.words.update(dict.fromkeys(words))
            self.words.update({words[k]: rows[k] for k in np.flatnonzero(rows.any(1))})
        for token, own in spelled.items():
            found = [m for w in own if (m := self.words[w]) is not None]
            if found:
                self.hot[token] = np.max(found, 0)

    def of(self, text: str, found: set[str]) -> np.ndarray:
        """Best matches of each sentence that has any, else one row of zeros."""
        none = np.zeros((1, len(self.kernel.landmarks)), np.float32)
        if self.hot.keys().isdisjoint(found):
            return none
        rows = [own for s in sentences(text) if (own := [self.hot[t] for t in s if t in self.hot])]
        return np.array([np.max(own, 0) for own in rows]) if rows else none


def matched(column: pa.Array, memory: Matches):
    """Best matches by sentence of every text of a batch; the kernel sees each new token once."""
    for start in range(0, len(column), 200):
        part = list(texts(column[start : start + 200]))
        found = [tokens(t) for t in part]
        memory.learn(set().union(*found))
        for text, own in zip(part, found, strict=True):
            memory.learn(own)  # nothing new, unless the memory was just emptied
            yield memory.of(text, own)


@dataclass
class Model:
    """Landmarks, weights of the matches, and the logistic fit of a document's decisions."""

    landmarks: list[str]
    weights: np.ndarray
    bias: float
    logistic: np.ndarray
    share: float  # of toxic documents among the labelled ones

    def score(self, rows: np.ndarray) -> float:
        return float(1 / (1 + math.exp(-min(30, max(-30, decided(rows, self.weights, self.bias) @ self.logistic)))))


def decided(rows: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """What a document's sentences say: the worst decision, the sum and number of bad ones."""
    d = rows @ weights + bias
    return np.array([d.max(), math.log1p(np.maximum(0, d + 0.5).sum()), math.log1p((d > 0).sum()), 1.0])


def taught(rows: np.ndarray, label: int, weights: np.ndarray, bias: float) -> np.ndarray:
    """The sentences of a document that the machine learns from: the best for each landmark."""
    d = rows @ weights + bias
    chosen = set(rows.argmax(0)[rows.max(0) > 0].tolist()) | {int(d.argmax())}
    return rows[[k for k in sorted(chosen) if not label or d[k] > 0 or k == d.argmax()]]


def word_starts(token: str) -> set[str]:
    """Landmark candidates: the starts of a word, and a short word itself."""
    out = set()
    for word in spellings(token):
        out |= {word[:k] for k in range(4, min(len(word), LONGEST) + 1)}
    return out


def candidates(train: DataFrame) -> list[str]:
    """Word starts that mark toxic documents, the clearest first."""

    def count(batches):
        known, toxic, clean = {}, Counter(), Counter()
        for batch in batches:
            for text, label in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                own = set()
                for token in tokens(text):
                    if token not in known:
                        known[token] = word_starts(token)
                    own |= known[token]
                (toxic if label else clean).update(own)
            if len(known) > TOKENS:
                yield rows(toxic, clean)
                known, toxic, clean = {}, Counter(), Counter()
        yield rows(toxic, clean)

    def rows(toxic, clean):
        keys = list(toxic | clean)
        arrays = [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in (toxic, clean))]
        return pa.RecordBatch.from_arrays(arrays, ["start", "toxic", "clean"])

    labels = train.agg(F.sum("label"), F.count(F.lit(1)) - F.sum("label")).first()
    if not labels[0] or not labels[1]:
        return []
    found = map_arrow(train.select("text", "label"), count, "start string, toxic long, clean long")
    found = found.groupBy("start").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    a, b = F.col("toxic") / labels[0], F.col("clean") / labels[1]
    share = (F.col("toxic") + F.col("clean")) / (labels[0] + labels[1])
    lift = (a - b) / F.sqrt(share * (1 - share) * (1 / labels[0] + 1 / labels[1]) + 1e-12)
    found = found.where(F.col("toxic") >= LEAST_DOCS).withColumn("lift", lift).where(F.col("lift") >= LEAST_LIFT)
    rows = found.orderBy(F.desc("lift"), F.desc("start")).limit(CANDIDATES).collect()
    return [r["start"] for r in rows if r["lift"] >= LEAST_SHARE * rows[0]["lift"]]


def landmarks(starts: list[str]) -> list[str]:
    """The first of ``starts`` that are not alike."""
    if not starts:
        return []
    alike, chosen = np.cbrt(Kernel(starts)(starts)), []
    for k in range(len(starts)):
        if len(chosen) < LANDMARKS and all(alike[k, j] < ALIKE and alike[j, k] < ALIKE for j in chosen):
            chosen.append(k)
    return [starts[k] for k in chosen]


def whitening(kernel: Kernel) -> np.ndarray:
    """Nyström map: the inverse square root of the landmarks' matches with each other."""
    own = kernel(kernel.landmarks).astype(float)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    return vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T


def machine(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps on the rows inside the margin."""
    x, y = np.hstack([rows, np.ones((len(rows), 1))]), 2.0 * labels - 1
    weight = np.where(y > 0, math.sqrt((y < 0).sum() / max(1, (y > 0).sum())), 1.0)
    w = np.zeros(x.shape[1])
    for _ in range(20):
        inside = 1 - y * (x @ w) > 0
        own = x[inside].T * weight[inside]
        new = np.linalg.solve(own @ x[inside] + ridge * np.eye(len(w)), own @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(rows.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        w = w + np.linalg.solve((rows.T * (p * (1 - p))) @ rows + ridge * np.eye(len(w)), rows.T @ (labels - p) - ridge * w)
    return w


def training_rows(docs: DataFrame, labels: DataFrame, most: int, id_col: str, text_col: str) -> DataFrame:
    """(text, label) of at most ``most`` labelled ids, those with the smallest hashes."""
    marks = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(chosen, "doc_id")
    return written(rows.select("text", F.col("label").cast("int").alias("label")), "toxicity-train")


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the documents that ``labels`` (doc_id, label 0 or 1) name, at most ``most`` ids.

    An id with several labels is toxic if one is; rows with a null id or label
    teach nothing. Without toxic and clean documents, or without a word that
    marks the toxic ones, every score is the share of toxic labels.
    """
    train = training_rows(docs, labels, most, id_col, text_col)
    share = train.agg(F.avg("label")).first()[0] or 0.0
    marks = landmarks(candidates(train))
    if not marks:
        return Model([], np.zeros(0), 0.0, np.zeros(4), share)

    def matches(batches):
        memory = Matches(Kernel(marks))
        for batch in batches:
            rows = [r.astype(np.float32).tobytes() for r in matched(batch.column(0), memory)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(rows, pa.binary())], ["label", "rows"])

    found = written(map_arrow(train, matches, "label int, rows binary"), "toxicity-sentences")
    to_kernel = whitening(Kernel(marks))
    weights, bias = np.ones(len(marks)), 0.0
    for _ in range(ROUNDS):
        own = _collected(found, lambda rows, label, w=weights, b=bias: taught(rows, label, w, b), len(marks))
        fitted, bias = machine(own[:, 1:] @ to_kernel, own[:, 0])
        weights = to_kernel @ fitted
    said = _collected(found, lambda rows, _: decided(rows, weights, bias)[None, :], len(marks))
    return Model(marks, weights, bias, logistic(said[:, 1:], said[:, 0]), share)


def _collected(found: DataFrame, of, width: int) -> np.ndarray:
    """The label and the vectors ``of`` each training document gives; their number is bounded as documents and landmarks are."""

    def run(batches):
        for batch in batches:
            labels, out = [], []
            for label, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                made = of(np.frombuffer(rows.as_buffer(), np.float32).reshape(-1, width), label).astype(float)
                labels += [label] * len(made)
                out += list(made)
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(out, pa.list_(pa.float64()))], ["label", "x"])

    out = map_arrow(found, run, "label int, x array<double>").toArrow()
    rows = out["x"].combine_chunks()
    return np.column_stack([out["label"].to_numpy(), rows.flatten().to_numpy().reshape(len(rows), -1)])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every whole text; a null text counts as empty, repeated rows score alike."""

    def run(batches):
        memory = Matches(Kernel(model.landmarks)) if model.landmarks else None
        for batch in batches:
            if memory:
                scores = [model.score(rows) for rows in matched(batch.column(1), memory)]
            else:
                scores = [model.share] * batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(chosen, run, f"doc_id {kind}, score double")


@query("op12_toxicity")
def op12(spark, sf_dir):
    """Toxicity of every document; labels of held-out documents are never learned from.

    Null ids have no fold, so they are not held out.
    """
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(crc_fold(F.col("doc_id"), 4) != 2)
    model = fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    held_out = F.coalesce(crc_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    scores = score(docs, model)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
