"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become classes with a weight: insult, threat, target, negation, verb of report, filler; unknown ones are plain (the lexical
transducer, an arc per word or stem). Five transducers read the classes of a text from left to right, each the output of the one
before, symbol by symbol, with a factor on every arc:

* reported speech: insults and threats within a quotation that a verb of report opens count half;
* negation: those that a negation governs, with nothing but fillers in between, count little;
* target: a clause has one or not. The machine guesses at the beginning of a clause; a guess that no target fulfils is not accepted;
* insult: aimed at the target of the clause it counts more than its weight, without one less;
* threat: without a target it hardly counts.

They are states and arcs as data, and ``compose`` makes one machine of them. A clause, which ends at sentence punctuation, a line
break or an adversative, scores the heaviest accepted path: the sum of the words' weights times the factors of their arcs. A
text's score is a logistic function of its heaviest clause and of the sum over its clauses. One bare word without any pattern is no
verdict: such a text stays below ``BARE_LIMIT``.

What insults and threats there are is partly given (short seed lists in four languages) and partly learned: words that labelled
toxic texts have significantly more often than others, counted over texts that are not near-copies of one another, and stems of
four letters or more under which there are several words. Learning reads a bounded number of labelled rows (SAMPLE_TEXTS of
each label) and keeps all that has the evidence. Scoring reads every text whole, in bounded pieces; a text without an insult or
threat takes one pass over its words.

Null and empty texts score as texts without a match. Repeated rows score alike; an empty table gives an empty one. Extra
columns stay; ``score`` and ``matched_clauses`` are replaced. Without labelled rows of both kinds, the default weights hold.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import pieces, schema_with, with_columns
from tripmart.workspace import materialise

SAMPLE_TEXTS = 5_000
STEM_SIZES = (4, 5, 6, 7)
#: Different words that must stand under a learned stem.
VARIETY = 2
#: Least log-likelihood ratio of a learned stem, and least share of toxic texts among those that have it.
EVIDENCE = 9.0
PURITY = 0.85

PLAIN, INSULT, THREAT, TARGET, NEGATION, REPORT, FILLER, BREAK, QUOTE = range(9)
SEEDS = {
    INSULT: "idiot moron stupid loser scum trash worthless pathetic disgusting clown fool imbecile "
    "idiotin dummkopf arschloch abschaum trottel imbécile crétin abruti connard idiota imbécil estúpido basura",
    THREAT: "kill hurt destroy shoot stab strangle töten umbringen vernichten tuer détruire frapper matar destruir golpear",
    TARGET: "you your yours yourself he she him her they them people du dich dir ihr euch sie tu toi te vous ils elle usted "
    "ustedes ellos ella vosotros",
    NEGATION: "not never no neither nor isn't aren't wasn't nicht nie kein keine keinen jamais pas aucun nunca jamás ni",
    REPORT: "said says say called calls wrote writes claimed reported quoted sagte sagt nannte schrieb dit disait appelle "
    "écrit dijo dice llamó escribió",
    FILLER: "a an the so such really very that this ein eine einen so sehr un une si très vraiment una tan muy",
    BREAK: "but however aber doch sondern mais pourtant pero sino",
}
SEED_WEIGHT = 3.0
#: Log odds at which a learned word weighs as much as a given one.
FULL_ODDS = 5.0
FACTORS = {"aimed": 1.3, "bare": 0.6, "bare threat": 0.1, "negated": 0.2, "reported": 0.5}
#: Greatest score of a text whose only match is one bare word.
BARE_LIMIT = 0.65
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;\n]|[\"“”„«»]")

#: Insults and threats with a target, between the target transducer and those after it.
AIMED_INSULT, AIMED_THREAT = 9, 10
CLASSES = tuple(range(9))
HITS = (INSULT, THREAT)
Arc = tuple[int, float, int]


# ------------------------------------------------------------------ transducers
@dataclass(frozen=True)
class Transducer:
    """``arcs[state][symbol]`` are (output, factor, next state). It starts in state 0 and may stop where it reads a break."""

    arcs: tuple[dict[int, tuple[Arc, ...]], ...]


def transducer(states: int, *rules: tuple) -> Transducer:
    """From rules (state, symbols, next state, factor, output), factor 1 and the symbol itself unless given. Of symbols that no rule
    of a state names, all pass and leave the state as it is; a rule without next state forbids its symbols."""
    table: list[dict[int, list[Arc]]] = [{} for _ in range(states)]
    for state, symbols, after, *more in rules:
        for symbol in symbols:
            arcs = table[state].setdefault(symbol, [])
            if after is not None:
                arcs.append(((more[1] if len(more) > 1 else symbol), (more[0] if more else 1.0), after))
    for state in range(states):
        for symbol in (*CLASSES, AIMED_INSULT, AIMED_THREAT):
            table[state].setdefault(symbol, [(symbol, 1.0, state)])
    return Transducer(tuple({symbol: tuple(arcs) for symbol, arcs in of.items()} for of in table))


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that reads what ``first`` reads and writes what ``second`` makes of what ``first`` writes: its states are the
    pairs that can be reached, its factors products."""
    numbers, queue, table = {(0, 0): 0}, [(0, 0)], []
    for a, b in queue:
        out: dict[int, list[Arc]] = {}
        for symbol, arcs in first.arcs[a].items():
            for middle, factor, next_a in arcs:
                for output, more, next_b in second.arcs[b].get(middle, ()):
                    pair = next_a, next_b
                    if pair not in numbers:
                        numbers[pair] = len(numbers)
                        queue.append(pair)
                    out.setdefault(symbol, []).append((output, factor * more, numbers[pair]))
        table.append({symbol: tuple(arcs) for symbol, arcs in out.items()})
    return Transducer(tuple(table))


_F = FACTORS
#: States: outside, after a verb of report, within its quotation, within another quotation.
REPORTED = transducer(
    4,
    (0, [REPORT], 1), (0, [QUOTE], 3),
    (1, [QUOTE], 2), (1, [BREAK], 0),
    (2, HITS, 2, _F["reported"]), (2, [QUOTE], 0),
    (3, [QUOTE], 0),
)
#: States: free, governed by a negation.
NEGATED = transducer(
    2,
    (0, [NEGATION], 1),
    (1, HITS, 1, _F["negated"]), (1, [PLAIN, TARGET, REPORT, QUOTE, BREAK], 0),
)
_REST = [PLAIN, NEGATION, REPORT, FILLER, QUOTE]
#: States: beginning of a clause, without target, target to come, target seen.
AIMED = transducer(
    4,
    (0, _REST, 1), (0, _REST, 2), (0, [TARGET], 3), (0, [BREAK], 0),
    (0, HITS, 1), (0, [INSULT], 2, 1.0, AIMED_INSULT), (0, [THREAT], 2, 1.0, AIMED_THREAT),
    (1, [TARGET], None), (1, [BREAK], 0),
    (2, [INSULT], 2, 1.0, AIMED_INSULT), (2, [THREAT], 2, 1.0, AIMED_THREAT), (2, [TARGET], 3), (2, [BREAK], None),
    (3, [INSULT], 3, 1.0, AIMED_INSULT), (3, [THREAT], 3, 1.0, AIMED_THREAT), (3, [BREAK], 0),
)
INSULTS = transducer(1, (0, [INSULT], 0, _F["bare"]), (0, [AIMED_INSULT], 0, _F["aimed"]))
THREATS = transducer(1, (0, [THREAT], 0, _F["bare threat"]), (0, [AIMED_THREAT], 0, _F["aimed"]))
GRAMMAR = reduce(compose, (REPORTED, NEGATED, AIMED, INSULTS, THREATS))


@dataclass
class Grammar:
    words: dict[str, tuple[int, float]]
    stems: dict[str, float]
    #: logistic weights: constant, heaviest clause, logarithm of the sum
    weights: tuple[float, float, float] = (-3.0, 1.5, 0.5)
    _memo: dict[str, tuple[int, float] | None] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "weights": self.weights, "_memo": {}}

    # ---- the lexical transducer
    def lexical(self, token: str) -> tuple[int, float] | None:
        found = self.words.get(token)
        if found:
            return found
        for size in STEM_SIZES[::-1]:
            if len(token) >= size and (weight := self.stems.get(token[:size])):
                return INSULT, weight
        return None

    def classes(self, text: str) -> list[tuple[int, float] | None]:
        memo = self._memo
        if len(memo) > 300_000:
            memo.clear()
        tokens = _TOKEN.findall(text.lower())
        for new in set(tokens).difference(memo):
            memo[new] = self.lexical(new)
        return [memo[t] for t in tokens]

    # ---- the composed machine
    def clauses(self, text: str) -> list[float]:
        """Scores of the clauses that the grammar matches: of each the heaviest accepted path."""
        found = self.classes(text)
        if not any(c is not None and c[0] in HITS for c in found):
            return []
        out, arcs, paths = [], GRAMMAR.arcs, {0: 0.0}
        for c in (*found, (BREAK, 0.0)):
            symbol, weight = c or (PLAIN, 0.0)
            after: dict[int, float] = {}
            for state, held in paths.items():
                for _, factor, into in arcs[state].get(symbol, ()):
                    score = held + weight * factor if weight else held
                    if score > after.get(into, -1.0):
                        after[into] = score
            if symbol == BREAK:
                best = max(after.values())
                if best:
                    out.append(best)
                after = dict.fromkeys(after, 0.0)
            paths = after
        return out

    def features(self, text: str | None) -> tuple[float, float, int]:
        scores = self.clauses(text) if text else []
        return (max(scores), math.log1p(sum(scores)), len(scores)) if scores else (0.0, 0.0, 0)

    def score(self, heaviest: float, total: float, matched: int = 2) -> float:
        constant, a, b = self.weights
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, constant + a * heaviest + b * total))))
        return min(score, BARE_LIMIT) if matched < 2 and heaviest < SEED_WEIGHT else score


def seed_grammar() -> Grammar:
    words = {w: (kind, SEED_WEIGHT if kind in HITS else 0.0) for kind, listed in SEEDS.items() for w in listed.split()}
    words |= {mark: (BREAK, 0.0) for mark in ".!?;\n"} | {mark: (QUOTE, 0.0) for mark in "\"“”„«»"}
    return Grammar(words, {})


def _sketch(tokens: list[str]) -> int:
    """The least hash of three tokens in a row: near-copies mostly share it, other texts rarely do."""
    if len(tokens) < 3:
        return zlib.crc32(" ".join(tokens).encode())
    return min(zlib.crc32(" ".join(three).encode()) for three in zip(tokens, tokens[1:], tokens[2:], strict=False))


def _stems(tokens: list[str]) -> set[str]:
    words = {t for t in tokens if len(t) > 3}
    return {"=" + w for w in words} | {w[:n] for w in words for n in STEM_SIZES if len(w) > n}


def _fit(rows: np.ndarray, labels: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge; both labels weigh the same."""
    x = np.column_stack([np.ones(len(rows)), rows])
    share = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1)) * len(labels)
    w = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2]) * len(labels)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (labels - p)) - ridge @ w
        step = np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + ridge, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0)), float(max(w[2], 0.0))


def learn(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE_TEXTS) -> Grammar:
    """From about ``sample`` rows of each label (0 or 1), chosen by a hash of the text; all if there are fewer."""
    grammar = seed_grammar()
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label")).where(
        "text IS NOT NULL AND label IN (0, 1)"
    )
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return grammar
    step = 1 << 20
    part = {label: min(step, -(-sample * step // n)) for label, n in sizes.items()}
    chosen = rows.where(
        F.pmod(F.xxhash64("text"), F.lit(step)) < F.when(F.col("label") == 1, F.lit(part[1])).otherwise(F.lit(part[0]))
    )

    def sketched(batches):
        for batch in pieces(batches, "text"):
            found = [_sketch(_TOKEN.findall(t.lower())) for t in batch.column("text").to_pylist()]
            yield with_columns(batch, sketch=pa.array(found, pa.int64()))

    # the sample is bounded, so its texts may be shuffled and read twice
    kept = chosen.mapInArrow(sketched, "text string, label int, sketch bigint").groupBy("label", "sketch")
    kept = kept.agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("kept"))
    kept = materialise(kept.select("kept.text", "label"), "labelled")

    def counted(batches):
        seen = (Counter(), Counter())
        for batch in pieces(batches, "text"):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                seen[label].update(_stems(_TOKEN.findall(text.lower())))
        stems = list(seen[0].keys() | seen[1].keys())
        columns = [pa.array(stems, pa.string()), *(pa.array([seen[k][s] for s in stems], pa.int64()) for k in (1, 0))]
        yield pa.RecordBatch.from_arrays(columns, ["stem", "toxic", "clean"])

    n = {r.label: r.n for r in kept.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return grammar
    stems = materialise(
        kept.mapInArrow(counted, "stem string, toxic bigint, clean bigint")
        .groupBy("stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where("toxic > 0"),
        "stems",
    )
    # log-likelihood ratio against chance, and log odds
    prior = n[1] / (n[1] + n[0])
    toxic, clean, both = F.col("toxic"), F.col("clean"), F.col("toxic") + F.col("clean")
    ratio = toxic * F.log(toxic / both / prior) + F.when(clean > 0, clean * F.log(clean / both / (1 - prior))).otherwise(0.0)
    odds = F.log((toxic + 0.5) / (n[1] + 1)) - F.log((clean + 0.5) / (n[0] + 1))
    known = stems.where((toxic >= 3) & (toxic >= PURITY * both) & (ratio >= EVIDENCE)).withColumn("odds", odds)
    word = F.substring("stem", 2, 1 << 20)
    sizes_of = F.array(*[F.lit(k) for k in STEM_SIZES])
    varied = (
        stems.where(F.col("stem").startswith("="))
        .select(word.alias("word"), F.explode(F.filter(sizes_of, lambda k: k < F.length(word))).alias("k"))
        .groupBy(F.substring("word", F.lit(1), F.col("k")).alias("stem"))
        .agg(F.count(F.lit(1)).alias("words"))
    )
    learned = known.join(varied, "stem", "left").where(F.col("stem").startswith("=") | (F.col("words") >= VARIETY))
    for r in learned.select("stem", "odds").collect():  # what has the evidence in a bounded sample
        weight = SEED_WEIGHT * min(1.0, r.odds / FULL_ODDS)
        if r.stem[0] == "=":
            grammar.words.setdefault(r.stem[1:], (INSULT, weight))
        else:
            grammar.stems[r.stem] = weight
    points = kept.mapInArrow(_scored(grammar, "text"), "label int, score double, matched_clauses int, heaviest double, total double")
    points = points.select("label", "heaviest", "total").toPandas()
    grammar.weights = _fit(points[["heaviest", "total"]].to_numpy(), points["label"].to_numpy())
    return grammar


def sample_labels(labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", sample: int = SAMPLE_TEXTS) -> DataFrame:
    """About ``sample`` rows of each label, chosen by a hash of the id: few enough to be broadcast to the texts."""
    rows = labels.select(id_col, F.col(label_col).cast("int").alias(label_col)).where(F.col(label_col).isin(0, 1)).distinct()
    step, part = 1 << 20, F.lit(0)
    for r in rows.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).collect():
        part = F.when(F.col(label_col) == r[0], F.lit(min(step, -(-sample * step // r.n)))).otherwise(part)
    return rows.where(F.pmod(F.xxhash64(id_col), F.lit(step)) < part)


def _scored(grammar: Grammar, text_col: str):
    def run(batches):
        for batch in pieces(batches, text_col):
            found = [grammar.features(t) for t in batch.column(text_col).to_pylist()]
            keep = batch.select([n for n in batch.schema.names if n != text_col])
            yield with_columns(
                keep,
                score=pa.array([grammar.score(*f) for f in found], pa.float64()),
                matched_clauses=pa.array([n for _, _, n in found], pa.int32()),
                heaviest=pa.array([a for a, _, _ in found], pa.float64()),
                total=pa.array([b for _, b, _ in found], pa.float64()),
            )

    return run


def score(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """The rows with ``score`` (0 to 1), ``matched_clauses``, ``heaviest`` and ``total`` in place of the text."""
    schema = schema_with(docs.drop(text_col), score="double", matched_clauses="int", heaviest="double", total="double")
    return docs.mapInArrow(_scored(grammar, text_col), schema)
