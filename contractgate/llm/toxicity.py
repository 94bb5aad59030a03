"""Toxicity: a weighted finite-state pattern grammar over clauses.

A text is cut into clauses; each word becomes a symbol (insult, threat verb, first,
second and other person, negation, reporting verb, future, other), and a clause ends with a
symbol of its own. Small transducers read the symbols: negation and reporting
remember whether such a word came before, target whether somebody is addressed,
the insult transducer emits a word's weight. Two more read threats: one waits
for the object of a threat verb ("will kill you", "is killing you"), the other for the end of a
clause whose subject meets a threat verb in the future ("you will burn"). A verb with another
object ("you shoot photos", "she will burn calories") is no threat. Their arcs carry weights: what is
aimed at a second person, or said by a first, counts whole, the rest a quarter. They are composed into one
machine whose states are tuples of their states; an emitted match carries its weight and one
of the kinds plain, negated, reported, addressed or threat. A document's score
is a logistic function of the matched weights per kind, so words count by the
clause they stand in; no kind lowers a score, and a negated or
reported insult never counts more than a plain one.

What is learned, from a bounded sample of labelled rows (``sample_per_class``
documents of each class, by the smallest hash of their id; whole texts): the
insult lexicon (whole words and word beginnings that make up a far larger share
of the words of toxic documents than of others, with their log odds as
weights) and the weight
of each kind of match; threats have a fixed weight if no sampled document holds one.
Cue words of the other symbols are fixed.

Defined cases: a null or empty text matches nothing and gets the score of the
bias; null labels are ignored, a doc_id labelled more than once counts with its
largest label; without rows of both classes every score is 0; repeated rows
get a score each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, text_of

_WORD = re.compile(r"[^\W\d_]+(?:['\u2019](?:t|ll)(?![^\W\d_]))?")  # a contraction with not or will is one word
_CLAUSE_END = re.compile(r"[.!?;\n]")

# Fixed cue words of the grammar (English, German, French, Spanish).
SECOND_PERSON = frozenset("you your yours yourself yourselves du dich dir dein deine ihr euch tu te toi ton ta vous votre tú usted ustedes".split())
FIRST_PERSON = frozenset("i we ich wir je nous yo nosotros nosotras".split())
OTHER_PERSON = frozenset("he she they them him her sie er il elle su ellos ella".split())
NEGATIONS = frozenset("not never no cannot isn aren wasn don nicht kein keine nie niemals pas jamais ne aucun "
                      "nunca jamás ningún".split())
REPORTS = frozenset("said says say called calls wrote quoted claims claimed reported sagte sagt nannte schrieb "
                    "behauptet dit disait écrit appelé déclaré dijo dice llamó escribió afirmó".split())
FUTURES = frozenset("will shall gonna going wirst werdet werden vas allez vais".split())
_ENGLISH_THREATS = "kill hurt destroy beat shoot stab burn murder".split()
THREATS = frozenset([*_ENGLISH_THREATS, *"töten umbringen schlagen verletzen vernichten tuer frapper détruire blesser "
                     "matar golpear destruir herir".split()])

KINDS = ("plain", "negated", "reported", "addressed", "threat")
_REACH = 3  # words over which a negation or an address holds
_OBJECT = 3  # words within which a threat verb meets its object
THREAT_WEIGHT = 8.0  # of the kind threat, where the sample holds none
_THIRD = 0.25  # weight on a threat's arcs for other persons than the second


def _inflected(verb: str) -> list[str]:
    """An English verb with its endings: kill, kills, killing, stabbing, ..."""
    stem = verb.removesuffix("e")
    short = stem[-1] in "bt" and stem[-2] in "aeiou" and stem[-3] not in "aeiou"
    return [verb, verb + "s", (stem + stem[-1] if short else stem) + "ing"]


_THREAT_FORMS = THREATS.union(*map(_inflected, _ENGLISH_THREATS))


def _cue(word: str) -> str:
    """The symbol of a word that is no insult."""
    if word in NEGATIONS or word.endswith(("n't", "n\u2019t")):
        return "negation"
    if word.endswith(("'ll", "\u2019ll")):
        return _cue_of_person(word[:-3], "_will")
    if word in _THREAT_FORMS:
        return "threat"
    return "report" if word in REPORTS else "future" if word in FUTURES else _cue_of_person(word)


def _cue_of_person(word: str, will: str = "") -> str:
    person = "first" if word in FIRST_PERSON else "second" if word in SECOND_PERSON else "third" if word in OTHER_PERSON else ""
    return person + will if person else "future" if will else "other"


@dataclass(frozen=True)
class Transducer:
    """Deterministic: ``move(state, symbol)`` gives the next state."""

    start: int | tuple
    move: Callable[[int | tuple, str], int | tuple]


def _holding(symbol: str, reach: int) -> Transducer:
    """State: words for which the last ``symbol`` still holds."""
    return Transducer(0, lambda state, seen: reach if seen == symbol else max(state - 1, 0))


def _lasting(symbol: str) -> Transducer:
    """State 1 from the first ``symbol`` to the end of the clause."""
    return Transducer(0, lambda state, seen: 1 if seen == symbol else state)


def _awaiting_object() -> Transducer:
    """State: words within which the last threat verb may meet its object, whether a first
    person came shortly before that verb, and words for which one still holds."""
    speaking = Transducer(0, lambda state, seen: _REACH if seen in ("first", "first_will") else max(state - 1, 0))

    def move(state: tuple, seen: str) -> tuple:
        waits, own, first = state
        if seen == "threat":
            waits, own = _OBJECT, first > 0
        else:
            waits = 0 if seen in _PERSONS else max(waits - 1, 0)
        return waits, own and waits > 0, speaking.move(first, seen)

    return Transducer((0, False, speaking.start), move)


def _doomed() -> Transducer:
    """State: (person that is the subject, steps on the way of subject, future, threat verb)."""
    def move(state: tuple, seen: str) -> tuple:
        person, step = state
        if seen in _PERSONS:
            return _PERSONS[seen], 2 if seen.endswith("_will") else 1
        if step == 1 and seen == "future":
            return person, 2
        if step == 2 and seen == "threat":
            return person, 3
        return (person, step) if step == 2 and seen == "other" else (0.0, 0)

    return Transducer((0.0, 0), move)


# weight on the arcs of a threat, by the person it is aimed at
_PERSONS = {"second": 1.0, "second_will": 1.0, "third": _THIRD, "third_will": _THIRD}
END = "end"
SYMBOLS = ("other", "insult", "threat", *_PERSONS, "negation", "report", "first", "first_will", "future", END)


def _addressed() -> Transducer:
    """State: words for which the last person still holds."""
    return Transducer(0, lambda state, seen: _REACH if seen in _PERSONS else max(state - 1, 0))


def compose(*parts: Transducer) -> tuple[tuple, dict[tuple, dict[str, tuple]]]:
    """The machine that runs ``parts`` side by side: its start and its table of moves."""
    start = tuple(p.start for p in parts)
    table, todo = {}, [start]
    while todo:
        state = todo.pop()
        if state in table:
            continue
        table[state] = {s: tuple(p.move(x, s) for p, x in zip(parts, state)) for s in SYMBOLS}
        todo.extend(table[state].values())
    return start, table


_START, _MOVES = compose(_holding("negation", _REACH), _lasting("report"), _addressed(), _awaiting_object(), _doomed())


def _emitted(state: tuple, symbol: str) -> tuple[str, float] | None:
    """(kind, weight of the arc) of what the machine emits on reading ``symbol``."""
    negated, reported, addressed, (waits, own, _), (person, step) = state
    if symbol == "insult":
        return "negated" if negated else "reported" if reported else "addressed" if addressed else "plain", 1.0
    if negated or reported:
        return None
    if symbol in _PERSONS and waits:
        return "threat", 1.0 if own else _PERSONS[symbol]
    return ("threat", person) if symbol == END and step == 3 else None


# Output of the composed machine for (state before the word, symbol).
_EMIT = {(state, symbol): _emitted(state, symbol) for state in _MOVES for symbol in SYMBOLS}


@dataclass
class Grammar:
    insults: dict[str, float]  # words, and word beginnings written with a final "*"
    kinds: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0

    def __post_init__(self):
        self.lengths = sorted({len(w) - 1 for w in self.insults if w[-1] == "*"})
        self.known: dict[str, tuple[str, float]] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        found = self.known.get(word)
        if found is None:
            weight = max([self.insults.get(word, 0.0), *(self.insults.get(word[:n] + "*", 0.0) for n in self.lengths if len(word) > n)])
            found = ("insult", weight) if weight else (_cue(word), 1.0)
            if len(self.known) < 500_000:
                self.known[word] = found
        return found

    def matches(self, text: str) -> tuple[dict[str, float], int]:
        """Weight per kind of match over the whole text, and its number of words."""
        out, words_seen, get = dict.fromkeys(KINDS, 0.0), 0, self.known.get
        for clause in _CLAUSE_END.split(text.lower()):
            words = _WORD.findall(clause)
            words_seen += len(words)
            symbols = [get(w) or self.symbol(w) for w in words]
            if not any(s[0] in ("insult", "threat") for s in symbols):
                continue
            state = _START
            for symbol, weight in (*symbols, (END, 1.0)):
                emitted = _EMIT[state, symbol]
                if emitted:
                    out[emitted[0]] += weight * emitted[1]
                state = _MOVES[state][symbol]
        return out, words_seen

    def score(self, text: str) -> float:
        x = _inputs(*self.matches(text))
        z = self.bias + sum(w * v for w, v in zip(self.kinds.values(), x))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _inputs(found: dict[str, float], words: int) -> list[float]:
    """Logistic inputs: matched weight per kind, and the share of all words that matched."""
    total = sum(found.values())
    return [*(math.log1p(found[k]) for k in KINDS), math.log1p(100 * total / max(words, 1))]


_INPUTS = (*KINDS, "share")


def _stems(text: str, lengths: tuple[int, ...]) -> Counter:
    """Words and word beginnings of a text with their numbers."""
    words, out = Counter(_WORD.findall(text.lower())), Counter()
    for w, n in words.items():
        out[w] += n
        for size in lengths:
            if len(w) > size:
                out[w[:size] + "*"] += n
    return out


def learn_insults(sample: DataFrame, least: int = 8, ratio: float = 8.0,
                  lengths: tuple[int, ...] = (4, 5, 6, 7, 8)) -> dict[str, float]:
    """Words and beginnings found in at least ``least`` toxic sample documents and
    ``ratio`` times as often (per word of text) as in others, with log odds.

    All of them are taken: their number is bounded by the sample, of whose toxic
    documents each must be met in ``least``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, seen = Counter(), (Counter(), Counter())
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = _stems(text.as_py(), lengths)
                seen[y].update(found)
                seen[y][""] += len(text.as_py())
                if y:
                    docs.update(found.keys())
        rows = [(w, docs[w], seen[1][w], seen[0][w]) for w in seen[0].keys() | seen[1].keys()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["word", "docs", "toxic", "clean"])

    counted = (sample.select("y", "text").mapInArrow(count, "word string, docs bigint, toxic bigint, clean bigint")
               .groupBy("word").agg(*[F.sum(c).alias(c) for c in ("docs", "toxic", "clean")]))
    counted = materialise(counted.where((F.col("docs") >= least) | (F.col("word") == "")), "insults")
    size = counted.where("word = ''").collect()  # characters of each class: one row
    if not size or not size[0].toxic or not size[0].clean:
        return {}
    odds = ((F.col("toxic") + 0.5) / size[0].toxic) / ((F.col("clean") + 0.5) / size[0].clean)
    found = (counted.where((F.col("word") != "") & (odds >= ratio))
             .select("word", F.log(odds).alias("weight")).collect())
    return {r.word: r.weight for r in found}


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 3000, rate: float = 0.3, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Full-batch gradient descent on scaled inputs, projected after each step: no weight is
    negative, and those of negated and reported matches are at most that of plain ones."""
    w, b = np.zeros(x.shape[1]), 0.0
    scale = np.maximum(x.std(axis=0), 1e-6)
    z = x / scale
    plain, *lesser = (_INPUTS.index(k) for k in ("plain", "negated", "reported"))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w + b, -60, 60)))
        g = (p - y) / len(y)
        w = np.maximum(w - rate * (z.T @ g + decay * w), 0.0)
        w[lesser] = np.minimum(w[lesser], w[plain] / scale[plain] * scale[lesser])
        b -= rate * g.sum()
    return w / scale, b


def fit(docs: DataFrame, labels: DataFrame, label: str, keep: Column, sample_per_class: int = 4000) -> Grammar:
    known = (labels.where(keep & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y")))
    order = F.xxhash64(F.lit(13), F.col("doc_id")), F.col("doc_id")
    zero, one = (known.where(F.col("y") == y).orderBy(*order).limit(sample_per_class) for y in (0, 1))
    chosen = F.broadcast(zero.unionByName(one))  # at most 2 * sample_per_class ids
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).join(chosen, "doc_id")
    # two halves: one gives the lexicon, the other the weights of the kinds, so that the
    # weights are learned on documents whose words did not make the lexicon
    half = F.pmod(F.xxhash64(F.lit(17), F.col("doc_id")), F.lit(3))
    grammar = Grammar(learn_insults(rows.where(half != 0)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [_inputs(*grammar.matches(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])

    got = rows.where(half == 0).select("y", "text").mapInArrow(measure, "y int, x array<double>").toPandas()
    if got.y.nunique() < 2:
        return Grammar(grammar.insults, dict.fromkeys(_INPUTS, 0.0), -60.0)
    x = np.array(got.x.tolist())
    w, b = _logistic(x, got.y.to_numpy(dtype=float))
    if not x[:, KINDS.index("threat")].any():
        w[KINDS.index("threat")] = THREAT_WEIGHT
    return Grammar(grammar.insults, dict(zip(_INPUTS, w)), b)


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """Every row of ``docs`` with its ``score``; all its columns are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)  # a lexicon of bounded size

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        g = shared.value
        return pd.Series([g.score(x) for x in texts], dtype="float64")

    return docs.withColumn("score", scored(text_of()))
