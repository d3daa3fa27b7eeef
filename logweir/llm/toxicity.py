"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words are mapped to the grammar's input symbols: insult, threat, target (who is addressed), negation,
reporting verb, quotation mark, other.  Three small transducers read them: one remembers a negation for
the next words, one whether somebody was addressed in the clause, one whether the clause is reported or
quoted speech.  They are composed into one table (their product), which emits a symbol for each insult
or threat: plain, aimed at a target, negated, or reported.  The emitted symbols of a text's clauses,
by count and by share of clauses, are weighed by a logistic model.  So a word counts by what its clause
does with it: "you are an idiot" more than "he said 'idiot'", and "not stupid" least.

Insults come from a list in four languages and from stems learned from labelled documents: words and
word beginnings that come in toxic documents much more often than in others.  Stems and weights are
learned from at most ``SAMPLE_DOCS`` labelled documents of each class that are not held out, whole
texts, in a fixed random order.  Labels, language, source and id are never inputs of a score.

Defined cases: null and empty texts get the score of a text without any match; documents with several
labels are toxic if one says so; null labels are no labels; without labels the list alone is used with
given weights; rows with equal texts get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logweir.llm.common import slices
from logweir.llm.folds import held_out, order_key

SAMPLE_DOCS = 4_000
STEMS = 2_000
STEM_LENGTHS = (4, 5, 6, 7)
LEAST_DOCS = 4  # toxic documents in which a learned stem must come
LEAST_RATIO = 25.0  # how much more often, by share of documents, it must come in toxic ones
CLEAN_SHARE = 8  # toxic documents for each clean one in which it comes, at least
PREDICT_AT = 0.3
KEPT_WORDS = 300_000

OTHER, TARGET, NEGATION, REPORT, QUOTE, INSULT, THREAT = range(7)

# The lists are a start for four languages; what the labels teach is added to them.
INSULTS = """idiot idiots moron morons stupid scum trash loser losers pathetic worthless disgusting clown imbecile
    dumbass bastard bastards asshole bitch cretin filth vermin scumbag dimwit
    idiotin dummkopf abschaum trottel arschloch versager schwachkopf mistkerl widerlich
    imbécile connard connasse salaud ordure minable abruti crétin débile
    idiota imbécil estúpido estúpida basura escoria inútil payaso patético cabrón pendejo""".split()
THREATS = """kill murder strangle stab destroy hurt beat shoot töten umbringen erschlagen vernichten
    tuer égorger frapper détruire matar asesinar golpear destruir""".split()
TARGETS = """you your yours you're youre u ur they them their he him she her people everyone
    du dich dir dein deine ihr euch sie tu toi te vous votre vos ils eux ustedes vosotros usted ellos""".split()
NEGATIONS = """not no never neither nor isn't aren't wasn't don't doesn't ain't without hardly
    nicht kein keine keinen nie niemals ohne pas jamais aucun aucune sans nunca jamás ningún ninguna sin""".split()
REPORTS = """said says say wrote writes called calls claimed claims quoted quote reported reports according
    sagte sagt schrieb nannte behauptet dit disait écrit appelle selon dijo dice escribió llamó según""".split()
LISTED = {**{w: REPORT for w in REPORTS}, **{w: NEGATION for w in NEGATIONS}, **{w: TARGET for w in TARGETS},
          **{w: THREAT for w in THREATS}, **{w: INSULT for w in INSULTS}}

EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "“”„«»‘’…"
QUOTES = "\"“”„«»"
CLAUSE_ENDS = ".!?;:|"
DRAWN_OUT = re.compile(r"(.)\1{2,}")
DIGITS = str.maketrans("0134578@$", "oieastbas")  # look-alikes

# What the composed transducer emits for an insult or a threat.
PLAIN, AIMED, NEGATED, REPORTED = range(4)
EMITTED = 8  # the four for insults, the four for threats


def compose(negation_reach: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The product of the three transducers: next state and emitted symbol (-1: none) by state and input.

    State: words for which a negation still holds, whether a target was read, whether speech is reported
    (by a verb), and whether a quotation is open.
    """
    def number(negated: int, aimed: int, told: int, quoted: int) -> int:
        return ((negated * 2 + aimed) * 2 + told) * 2 + quoted

    states = number(negation_reach, 1, 1, 1) + 1
    following, emits = np.zeros((states, 7), np.int64), np.full((states, 7), -1)
    for negated in range(negation_reach + 1):
        for aimed in (0, 1):
            for told in (0, 1):
                for quoted in (0, 1):
                    here = number(negated, aimed, told, quoted)
                    for symbol in range(7):
                        after = [max(0, negated - 1), aimed, told, quoted]
                        if symbol == NEGATION:
                            after[0] = negation_reach
                        elif symbol == TARGET:
                            after[1] = 1
                        elif symbol == REPORT:
                            after[2] = 1
                        elif symbol == QUOTE:
                            after[3] = 1 - quoted
                        elif symbol in (INSULT, THREAT):
                            kind = REPORTED if told and quoted else NEGATED if negated else AIMED if aimed else PLAIN
                            emits[here, symbol] = kind + (4 if symbol == THREAT else 0)
                        following[here, symbol] = number(*after)
    return following, emits


FOLLOWING, EMITS = (x.tolist() for x in compose())


def bare(chunk: str) -> str:
    """A chunk's word in lower case, without what stands around it."""
    return chunk.strip(EDGES).lower()


def stems(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings marked with a star."""
    return [word, *[word[:n] + "*" for n in STEM_LENGTHS if len(word) > n]]


@dataclass
class Grammar:
    insults: frozenset[str]
    weights: list[float] = field(default_factory=lambda: [1.2, 1.6, 0.3, 0.4, 0.4, 2.0, 0.1, 0.3, 2.0])
    bias: float = -2.5
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "seen": {}}

    def symbol(self, word: str) -> int:
        if not word:
            return OTHER
        for form in dict.fromkeys((word, _plain(word))):
            listed = LISTED.get(form)
            if listed is not None:
                return listed
            if any(s in self.insults for s in stems(form)):
                return INSULT
        return OTHER

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """Input symbols of a chunk; 7 stands for the end of a clause behind it."""
        found = self.seen.get(chunk)
        if found is None:
            tail = chunk.rstrip("*#%&$<>'\")]}”»’_~")
            out = [QUOTE] * any(c in QUOTES for c in chunk[:1])
            out.append(self.symbol(bare(chunk)))
            out += [QUOTE] * any(c in QUOTES for c in chunk[-2:] if len(chunk) > 1)
            found = (*out, 7) if tail[-1:] and tail[-1] in CLAUSE_ENDS else tuple(out)
            if len(chunk) <= 48:
                if len(self.seen) >= KEPT_WORDS:
                    self.seen.clear()
                self.seen[chunk] = found
        return found

    def emitted(self, text: str | None) -> tuple[Counter, int, int]:
        """How often each symbol is emitted; matched clauses; words."""
        out: Counter = Counter()
        clauses = words = 0
        for line in (text or "").split("\n"):
            chunks = line.split()
            words += len(chunks)
            read = [self.seen.get(c) or self.chunk(c) for c in chunks]
            if not any(s[0] >= INSULT or (len(s) > 1 and max(s[:-1]) >= INSULT) for s in read):
                continue
            state, matched = 0, False
            for symbols in read:
                for symbol in symbols:
                    if symbol == 7:
                        clauses, state, matched = clauses + matched, 0, False
                        continue
                    kind = EMITS[state][symbol]
                    if kind >= 0:
                        out[kind] += 1
                        matched = True
                    state = FOLLOWING[state][symbol]
            clauses += matched
        return out, clauses, words

    def features(self, text: str | None) -> list[float]:
        out, clauses, words = self.emitted(text)
        return [math.log1p(out[k]) for k in range(EMITTED)] + [math.log1p(100.0 * clauses / max(words, 1))]

    def score(self, text: str | None) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _plain(word: str) -> str:
    """Look-alike digits as letters, and letters drawn out as one."""
    if any(c.isdigit() or c in "@$" for c in word) and any(c.isalpha() for c in word):
        word = word.translate(DIGITS)
    return DRAWN_OUT.sub(r"\1", word)


def fit(features: np.ndarray, labels: np.ndarray, steps: int = 60, ridge: float = 1.0) -> tuple[list[float], float]:
    """Logistic regression by Newton steps; weights of what an insult or threat emits stay at 0 or above."""
    x = np.hstack((features, np.ones((len(features), 1))))
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + penalty * w
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        w = w - np.linalg.solve(hessian, gradient)
        w[:-1] = np.maximum(w[:-1], 0.0)
    return w[:-1].tolist(), float(w[-1])


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of a bounded sample of each class, not held out."""
    flags = (labels.select("doc_id", "toxic").filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    chosen = None
    for value in (0, 1):
        some = flags.filter(F.col("toxic") == value).orderBy(order_key(), "doc_id").limit(SAMPLE_DOCS)
        chosen = some if chosen is None else chosen.unionByName(some)
    return docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")


def _stem_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 64):
            rows = [(s, t) for text, t in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist())
                    for s in {s for w in {bare(c) for c in text.split()} if len(w) > 2 and w.isalpha() for s in stems(w)}]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.string()), pa.array([t for _, t in rows], pa.int32())],
                                             names=["stem", "toxic"])


def learned_stems(sample: DataFrame, n_toxic: int, n_clean: int) -> Iterable[str]:
    """Words and beginnings that tell toxic documents, most telling first."""
    counts = sample.select("text", "toxic").mapInArrow(_stem_rows, "stem string, toxic int").groupBy("stem").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    ratio = ((F.col("t") + 0.5) / (n_toxic + 1)) / ((F.col("c") + 0.5) / (n_clean + 1))
    best = (counts.filter(F.col("t") >= LEAST_DOCS).withColumn("ratio", ratio)
            .filter((F.col("ratio") >= LEAST_RATIO) & (F.col("c") * CLEAN_SHARE <= F.col("t")))
            .orderBy(F.desc("t"), F.desc("ratio"), "stem").limit(STEMS))
    return [r["stem"] for r in best.collect()]


def learn(docs: DataFrame, labels: DataFrame) -> Grammar:
    sample = labelled(docs, labels)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return Grammar(frozenset())
    grammar = Grammar(frozenset(learned_stems(sample, n_toxic, n_clean)))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([
                    part.column("toxic"), pa.array([grammar.features(t) for t in part.column("text").to_pylist()], pa.list_(pa.float64()))],
                    names=["toxic", "features"])

    rows = sorted((r["toxic"], r["features"]) for r in sample.select("text", "toxic").mapInArrow(batches, "toxic int, features array<double>").collect())
    grammar.weights, grammar.bias = fit(np.array([f for _, f in rows]), np.array([t for t, _ in rows], float))
    return grammar


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """doc_id, held_out, score, predicted and n_clauses (matched ones) of every row."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in slices(batch):
                texts = part.column("text").to_pylist()
                scores = [grammar.score(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), part.column("held_out"), pa.array(scores, pa.float64()),
                    pa.array([int(s >= PREDICT_AT) for s in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    slim = docs.select("doc_id", held_out().alias("held_out"), "text")
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(batches, f"doc_id {kind}, held_out boolean, score double, predicted int")
