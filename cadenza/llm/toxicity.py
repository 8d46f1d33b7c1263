"""Toxicity (operator 8): a weighted finite-state pattern grammar that scores matched clauses.

Three transducers are composed:
* The lexicon reads a word's letters and writes a sign with a weight: insult, threat, intention, target, negation,
  report or other. It is a trie; insults end at a word's end or after any beginning of it.
* The grammar reads the signs of a clause. It is the product of small machines - negation scope, reported speech, an
  intention before a threat, a target close by - and each of its arcs over an insult or a threat writes to which sums
  of the document the sign's weight goes, and how much of it: a threat that is meant and has a target counts in full,
  one without either little, a negated or quoted insult apart from a plain one.
* A second pass from the clause's end tells the first one of targets that follow.
A logistic model turns a document's sums into a score, so that clauses count and not bare words.

What is learned, on at most SAMPLE labelled rows of at most TRAIN_BYTES (chosen by a hash of the id, copies of a text
once): the insults - words and beginnings of words that mark toxic documents, chosen one after the other by how many
toxic documents they newly explain - with their weights, and the logistic weights, pulled towards PRIOR. The other
signs are word lists. Only the text goes into a score.

Plan: the sample is written once. Beginnings are counted and compared between toxic and clean documents in Spark; the
driver gets those that LEAST words of toxic documents have of the sample. Scoring is one scan without a shuffle; a document
without any of the chosen strings costs a few substring searches.

Cases: null and empty texts, and texts without a match, get the score of no match. Long texts are read whole.
Null or repeated ids are scored each. Without labels of both kinds the seeds and PRIOR are used as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.scratch import materialize

SAMPLE, TRAIN_BYTES = 16_000, 1 << 17
#: Beginnings that a task counts before it hands the counts on.
COUNTED = 50_000
#: Toxic documents of the sample that a beginning must be in, and those that it must newly explain.
LEAST, GAIN = 5, 3
#: A beginning must mark toxic documents so much that chance gives one in CHANCE such samples.
CHANCE = 100
#: A clean document weighs AGAINST a toxic one when a beginning is chosen; each toxic one is to be explained AGAIN times.
AGAINST, AGAIN = 0.5, 3
SHORTEST, LONGEST = 3, 12

WORD = re.compile(r"[^\W\d_]+|[\"“”«»„]")
CLAUSE = re.compile(r"[.!?;:\n\r]+")
SIGNS = OTHER, INSULT, THREAT, INTENT, TARGET, NEGATION, REPORT = range(7)
LISTS = {
    THREAT: "kill hurt destroy beat burn hang stab shoot töten umbringen verletzen tuer frapper détruire matar golpear destruir",
    INTENT: "will shall going gonna want must should werde werden wollen muss sollte vais allons veux dois voy vamos quiero debo",
    TARGET: "you your yours u he she they them him her du dich dir ihr euch tu toi te vous il elle ils tú ti usted ustedes ellos ella",
    NEGATION: "not no never nobody nor isn aren wasn weren don doesn didn nicht kein keine nie niemals ne pas jamais aucun nunca jamás ningún tampoco",
    REPORT: "said says say told wrote writes claimed quoted called sagte sagt schrieb dit disait écrit dijo dice escribió \" “ ” « » „",
}
SEEDS = {"idiot": 2.0, "moron": 2.0, "scum": 2.0}


# --- transducers -----------------------------------------------------------------------------------------


class Lexicon:
    """A transducer from a word's letters to (sign, weight): a trie whose nodes may end a word or any beginning of one."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.whole: list[tuple[int, float] | None] = [None]
        self.begun: list[tuple[int, float] | None] = [None]

    def add(self, word: str, sign: int, weight: float, whole: bool) -> None:
        at = 0
        for c in word:
            if c not in self.arcs[at]:
                self.arcs[at][c] = len(self.arcs)
                self.arcs.append({}), self.whole.append(None), self.begun.append(None)
            at = self.arcs[at][c]
        ends = self.whole if whole else self.begun
        if ends[at] is None or ends[at][1] < weight:
            ends[at] = sign, weight

    def read(self, word: str) -> tuple[int, float]:
        """The word lists come before beginnings; of insults the heaviest counts."""
        at, best = 0, None
        for c in word:
            at = self.arcs[at].get(c, -1)
            if at < 0:
                return best or (OTHER, 0.0)
            if self.begun[at] and (best is None or best[1] < self.begun[at][1]):
                best = self.begun[at]
        own = self.whole[at]
        return own if own and (best is None or own[0] != INSULT or best[1] < own[1]) else best or (OTHER, 0.0)


@dataclass
class Machine:
    """A transducer over signs: step(state, sign) gives the next state; holds(state) is its output for a match."""

    start: int
    step: object
    holds: object


def _within(sign: int, reach: int) -> Machine:
    """Holds for ``reach`` words after a sign."""
    return Machine(0, lambda state, s: reach if s == sign else max(0, state - 1), lambda state: state > 0)


def _after(sign: int) -> Machine:
    """Holds from a sign to the end of the clause."""
    return Machine(0, lambda state, s: 1 if s == sign or state else 0, lambda state: state > 0)


def compose(*machines: Machine) -> tuple[list[list[int]], list[tuple[bool, ...]]]:
    """The product of machines as tables: next[state][sign], outputs[state]; state 0 is the start."""
    start = tuple(m.start for m in machines)
    number, queue, table = {start: 0}, [start], []
    for state in queue:
        row = []
        for s in SIGNS:
            to = tuple(m.step(q, s) for m, q in zip(machines, state, strict=True))
            if to not in number:
                number[to] = len(number)
                queue.append(to)
            row.append(number[to])
        table.append(row)
    return table, [tuple(bool(m.holds(q)) for m, q in zip(machines, state, strict=True)) for state in queue]


#: Sums a document: insults plain, negated, reported, at a target; threats meant and at a target, other threats; matched clauses.
FEATURES = ("plain", "negated", "reported", "targeted", "threat", "bare_threat", "clauses")
PRIOR = np.array([2.0, 0.5, 0.5, 0.5, 2.0, 0.2, 0.5])
BIAS = -3.0


def written(sign: int, negated: bool, reported: bool, meant: bool, target: bool) -> tuple[tuple[int, float], ...]:
    """What an arc writes: (sum, share of the sign's weight)."""
    if sign == INSULT:
        return ((1 if negated else 2 if reported else 0, 1.0), *([(3, 1.0)] if target else []))
    if sign == THREAT:
        full = target and not negated and not reported
        return ((4, 1.0 if meant else 0.5),) if full else ((5, 1.0 if meant and not negated else 0.5),)
    return ()


FORWARD, _HOLDS = compose(_within(NEGATION, 3), _after(REPORT), _within(INTENT, 4), _within(TARGET, 5))
BACKWARD, _BEHIND = compose(_within(TARGET, 5))
#: What the arc from a state over a sign writes, without and with a target behind.
WRITES = [[[written(s, n, r, m, t or behind) for s in SIGNS] for behind in (False, True)] for n, r, m, t in _HOLDS]


@dataclass
class Grammar:
    """The weights of insults (beginnings, or whole words with a final "$") and of the logistic model."""

    insults: dict[str, float] = field(default_factory=lambda: dict(SEEDS))
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())
    bias: float = BIAS

    def __post_init__(self) -> None:
        self.lexicon = Lexicon()
        for sign, words in LISTS.items():
            for w in words.split():
                self.lexicon.add(w, sign, 1.0, True)
        for x, weight in self.insults.items():
            self.lexicon.add(x.rstrip("$"), INSULT, weight, x.endswith("$"))
        self.search = sorted({x.rstrip("$") for x in self.insults} | set(LISTS[THREAT].split()), key=len)

    def features(self, text: str) -> list[float] | None:
        """The sums of a text, or None where nothing matches."""
        low = text.lower()
        if not any(x in low for x in self.search):
            return None
        total, seen = [0.0] * len(FEATURES), set()
        for clause in CLAUSE.split(low):
            if any(x in clause for x in self.search):
                self._clause(WORD.findall(clause), total, seen)
        return total if any(total) else None

    def _clause(self, words: list[str], total: list[float], seen: set[tuple[str, int]]) -> None:
        """Adds what the arcs write; a word counts once in each sum, however often it is repeated."""
        read = [self.lexicon.read(w) for w in words]
        if not any(sign in (INSULT, THREAT) for sign, _ in read):
            return
        behind, state = [False] * len(read), 0
        for i in range(len(read) - 1, -1, -1):
            behind[i] = _BEHIND[state][0]
            state = BACKWARD[state][read[i][0]]
        state, matched = 0, False
        for word, (sign, weight), target in zip(words, read, behind, strict=True):
            for k, share in WRITES[state][target][sign]:
                if (word, k) not in seen:
                    seen.add((word, k))
                    total[k] += share * weight
                    matched |= k != 5
            state = FORWARD[state][sign]
        total[6] += matched

    def score(self, sums: list[float] | None) -> float:
        z = self.bias if sums is None else self.bias + float(np.log1p(np.array(sums)) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


# --- learning --------------------------------------------------------------------------------------------


def _beginnings(text: str) -> Counter:
    """The words of a text, and how many different words have each beginning; no more than AGAIN."""
    out: Counter = Counter()
    for w in set(WORD.findall((text or "").lower())):
        if len(w) >= SHORTEST:
            for x in (w + "$", *(w[:k] for k in range(SHORTEST, min(LONGEST, len(w)) + 1))):
                out[x] = min(AGAIN, out[x] + 1)
    return out


def _counts(train: DataFrame, toxic: int, among: set[str] | None) -> DataFrame:
    """x, n: in how many words of documents of the sample each beginning is; the partial counts of tasks are summed by Spark."""
    known = train.sparkSession.sparkContext.broadcast(among)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["x", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = _beginnings(text)
                seen.update(own if known.value is None else {x: n for x, n in own.items() if x in known.value})
                if len(seen) >= COUNTED:
                    yield counted()
                    seen = Counter()
        yield counted()

    return train.where(F.col("toxic") == toxic).select("text").mapInArrow(count, "x string, n long").groupBy("x").agg(F.sum("n").alias("n"))


def _explained(train: DataFrame, among: set[str]) -> list[dict[str, int]]:
    """In how many words of each toxic document of the sample the candidates are."""
    known = train.sparkSession.sparkContext.broadcast(among)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted((x, n) for x, n in _beginnings(t).items() if x in known.value) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.map_(pa.string(), pa.int64()))], names=["xs"])

    return [r["xs"] for r in train.where("toxic = 1").select("text").mapInArrow(match, "xs map<string, long>").collect()]


def choose_insults(toxic: dict[str, int], clean: dict[str, int], docs: list[dict[str, int]], n_clean: int) -> dict[str, float]:
    """Greedy cover: the beginning that explains most of the toxic documents anew, less its uses in clean ones; of equals the longest.

    A document is explained by AGAIN words, so that insults which mostly come together are all found; the first counts
    fully and others half. A beginning that toxic documents have in many words is so told from one that is in as many clean
    documents, but in one word.
    """
    left = [(d, 0) for d in docs if d]
    out: dict[str, float] = {}
    while left:
        gain: Counter = Counter()
        for d, times in left:
            for x, n in d.items():
                gain[x] += 0.5 * min(n, AGAIN - times) + (0 if times else 0.5)
        net = {x: g - AGAINST * clean.get(x, 0) for x, g in gain.items() if x not in out}
        best = max(net, key=lambda x: (net[x], len(x.rstrip("$")), x.endswith("$"), x), default=None)
        if best is None or net[best] < GAIN:
            break
        out[best] = max(0.1, math.log((toxic[best] + 0.5) / (len(docs) + 1)) - math.log((clean.get(best, 0) + 0.5) / (n_clean + 1)))
        left = [(d, times + d.get(best, 0)) for d, times in left if times + d.get(best, 0) < AGAIN]
    return out


def fit_weights(x: np.ndarray, y: np.ndarray, rounds: int = 60, pull: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps, pulled towards PRIOR and BIAS; weights don't go below 0."""
    z = np.c_[x, np.ones(len(x))]
    prior = np.append(PRIOR, BIAS)
    w, reg = prior.copy(), np.append(np.full(len(PRIOR), pull), 0.1)

    def loss(w: np.ndarray) -> float:
        t = z @ w
        return float((np.logaddexp(0, t) - y * t).sum() + (reg * (w - prior) ** 2).sum() / 2)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + reg * (w - prior)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(reg), grad)
        for half in range(20):  # shorter until the loss falls
            new = w - step / 2**half
            new[:-1] = np.maximum(new[:-1], 0)
            if (then := loss(new)) < now:
                break
        else:
            break
        done, w, now = now - then < 1e-6 * now, new, then
        if done:
            break
    return w[:-1], float(w[-1])


def train(documents: DataFrame, labels: DataFrame) -> Grammar:
    """A grammar from at most SAMPLE rows of ``labels`` (doc_id, toxic) and the texts of those documents."""
    rows = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where("_id is not null and toxic in (0, 1)")
    rows = rows.orderBy(F.xxhash64("_id"), "_id", "toxic").limit(SAMPLE)
    texts = documents.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text")).where(F.octet_length("text") <= TRAIN_BYTES)
    # At most SAMPLE rows of two numbers are broadcast.
    sample = materialize(texts.join(F.broadcast(rows), "_id").groupBy(F.xxhash64("text").alias("h"), F.col("toxic")).agg(F.min_by("text", "_id").alias("text")).select("text", "toxic"), "labelled")
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Grammar()
    toxic = materialize(_counts(sample, 1, None).where(F.col("n") >= LEAST), "beginnings")
    among = {r["x"] for r in toxic.select("x").collect()}
    clean = _counts(sample, 0, among).select("x", F.col("n").alias("clean"))
    both = toxic.join(clean, "x", "left").na.fill(0, ["clean"])
    # Log likelihood ratio of a beginning's documents: under 1 in CHANCE that any of all these would reach the bound by chance.
    k, c, share = F.col("n"), F.col("clean"), n[1] / (n[0] + n[1])
    ratio = k * F.log(k / ((k + c) * share)) + F.when(c > 0, c * F.log(c / ((k + c) * (1 - share)))).otherwise(0.0)
    marks = both.where(k > share * (k + c)).where(ratio >= math.log(CHANCE * max(1, len(among)))).collect()
    insults = choose_insults({r["x"]: r["n"] for r in marks}, {r["x"]: r["clean"] for r in marks}, _explained(sample, {r["x"] for r in marks}), n[0])
    grammar = Grammar(insults or dict(SEEDS))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grammar.features(t or "") or [0.0] * len(FEATURES) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    seen = sample.select("text", "toxic").mapInArrow(sums, "x array<double>, toxic int").collect()
    x, y = np.log1p(np.array([r["x"] for r in seen])), np.array([r["toxic"] for r in seen], float)
    grammar.weights, grammar.bias = fit_weights(x, y)
    return grammar


def score(documents: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id and score (0 to 1) of every document."""
    held = documents.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = held.value
        for batch in batches:
            scores = [g.score(g.features(t) if t else None) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is not for learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns. A null text scores as an empty one."""
    held = documents.sparkSession.sparkContext.broadcast(train(documents, labels))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        g = held.value
        return pd.Series([g.score(g.features(t) if t else None) for t in texts], dtype="float64")

    return documents.where(scored(F.col("text").cast("string")) < threshold)
