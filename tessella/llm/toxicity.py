"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sampling import labelled_sample

# The grammar's closed word classes in English, German, French and Spanish.
THREATS = "kill killed killing murder hurt destroy beat shoot stab strangle töten umbringen schlagen vernichten verletzen tuer tuerai frapper détruire blesser matar mataré golpear destruir herir"
TARGETS = "you your yours u they them he she him her du dich dir dein ihr euch sie er tu toi te ton vous votre il elle ils tú ti usted ustedes él ella ellos"
NEGATIONS = "not never no nobody cannot don't isn't aren't wasn't nicht kein keine nie niemals pas jamais aucun aucune nunca jamás ningún sin"
REPORTS = "said says say wrote writes called calls quoted quotes claimed claims told sagte sagt schrieb nannte behauptet dit disait écrit appelle dijo dice escribió llamó"
INTENTS = "will shall going gonna must werde wirst werden muss vais va vas allons voy vamos"

INSULT, THREAT, TARGET, NEGATION, REPORT, INTENT, WORD = range(7)
CLAUSE_END = re.compile(r"[.!?;\n]")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
#: Words over which a negation holds.
SCOPE = 3


def _classes() -> dict[str, int]:
    out: dict[str, int] = {}
    for tag, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (INTENT, INTENTS), (THREAT, THREATS)):
        out |= dict.fromkeys(words.split(), tag)
    return out


@dataclass
class Transducer:
    """States and arcs ``(state, tag) -> (state, output)``; a missing arc stays in place without output."""

    arcs: dict[tuple[int, int], tuple[int, str]]

    def step(self, state: int, tag: int) -> tuple[int, str]:
        return self.arcs.get((state, tag), (state, ""))


def _insults() -> Transducer:
    return Transducer({(0, INSULT): (0, "insult")})


def _threats() -> Transducer:
    """An intent before the threat makes it one that is meant."""
    return Transducer({(0, INTENT): (1, ""), (0, THREAT): (0, "threat"), (1, THREAT): (1, "meant")})


def _targets() -> Transducer:
    """A target on either side of the trigger; state 2: a trigger waits for one."""
    arcs = {(s, TARGET): (1, "aimed" if s == 2 else "") for s in range(3)}
    for tag in (INSULT, THREAT):
        arcs |= {(0, tag): (2, ""), (1, tag): (1, "aimed")}
    return Transducer(arcs)


def _negations() -> Transducer:
    arcs = {(s, NEGATION): (SCOPE, "") for s in range(SCOPE + 1)}
    for s in range(1, SCOPE + 1):
        for tag in (TARGET, REPORT, INTENT, WORD):
            arcs[s, tag] = (s - 1, "")
        for tag in (INSULT, THREAT):
            arcs[s, tag] = (s - 1, "negated")
    return Transducer(arcs)


def _reports() -> Transducer:
    return Transducer({(0, REPORT): (1, ""), (1, INSULT): (1, "reported"), (1, THREAT): (1, "reported")})


@dataclass
class Grammar:
    """The composition of the five transducers, built as its states are reached."""

    parts: tuple[Transducer, ...] = field(default_factory=lambda: (_insults(), _threats(), _targets(), _negations(), _reports()))
    arcs: dict = field(default_factory=dict, repr=False)

    def step(self, state: tuple[int, ...], tag: int) -> tuple[tuple[int, ...], str]:
        """The next state, and the pattern that ends at this word (empty: none)."""
        key = state, tag
        if key not in self.arcs:
            moves = [p.step(s, tag) for p, s in zip(self.parts, state, strict=True)]
            self.arcs[key] = tuple(m[0] for m in moves), "+".join(m[1] for m in moves if m[1])
        return self.arcs[key]

    def patterns(self, tags: list[int]) -> list[str]:
        state: tuple[int, ...] = (0,) * len(self.parts)
        out = []
        for tag in tags:
            state, pattern = self.step(state, tag)
            if pattern:
                out.append(pattern)
        return out


@dataclass
class Lexicon:
    """Insults learned from labels: whole words, and stems that some ending must follow."""

    words: frozenset[str]
    stems: tuple[str, ...]
    _scan: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "_scan": None}

    def scanner(self):
        """An Aho-Corasick automaton over all trigger words and stems."""
        if self._scan is None:
            import ahocorasick

            scan = ahocorasick.Automaton()
            whole = {*self.words, *THREATS.split()}
            for w in {*whole, *self.stems}:
                scan.add_word(w, (len(w), w in whole, w in self.stems))
            scan.make_automaton()
            self._scan = scan
        return self._scan

    def is_insult(self, word: str) -> bool:
        return word in self.words or any(len(word) > len(s) and word.startswith(s) for s in self.stems)


def _letter(text: str, at: int) -> bool:
    return 0 <= at < len(text) and text[at].isalpha()


def clauses_with_triggers(text: str, lexicon: Lexicon):
    """The clauses, lower-cased, that hold a trigger at a word's start; each once, in order."""
    low = text.lower()
    done = 0
    for end, (size, whole, stem) in lexicon.scanner().iter(low):
        start = end - size + 1
        if start < done or _letter(low, start - 1) or not (stem if _letter(low, end + 1) else whole):
            continue
        first = max((low.rfind(c, done, start) for c in ".!?;\n"), default=-1) + 1
        stop = CLAUSE_END.search(low, end + 1)
        done = stop.start() if stop else len(low)
        yield low[max(first, 0) : done]


#: What a document's matched clauses come to: outputs of the composed transducer.
FEATURES = ("insult", "threat", "meant", "aimed", "negated", "reported")
#: What the weights are drawn to, the bias last, and the bounds that give each output its meaning: an
#: insult or threat speaks for label 1, an aimed or meant one more so, a negated or reported one less.
PRIOR = (3.0, 0.5, 1.0, 0.5, -0.5, -0.5, -3.0)
LOW = (0.5, 0.25, 0.25, 0.1, -np.inf, -np.inf, -np.inf)
HIGH = (np.inf, np.inf, np.inf, np.inf, -0.25, -0.25, np.inf)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float
    grammar: Grammar = field(default_factory=Grammar)
    classes: dict[str, int] = field(default_factory=_classes)

    def features(self, text: str | None) -> np.ndarray:
        """Logarithms of one plus the number of times each output was made, over all matched clauses."""
        counts = np.zeros(len(FEATURES))
        for clause in clauses_with_triggers(text or "", self.lexicon):
            tags = [INSULT if self.lexicon.is_insult(w) else self.classes.get(w, WORD) for w in TOKEN.findall(clause)]
            for pattern in self.grammar.patterns(tags):
                for output in pattern.split("+"):
                    counts[FEATURES.index(output)] += 1
        return np.log1p(counts)

    def score(self, texts: list[str | None]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, len(FEATURES))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))


def learn_lexicon(sample: list[tuple[str, int]], shortest: int = 3, longest: int = 8, ratio: float = 8.0, most: int = 400) -> Lexicon:
    """Insults that set label 1 apart, chosen one by one over the positive texts not yet explained.

    Candidates are whole words ("word$") and true beginnings of words of ``shortest`` to ``longest``
    letters ("stem*"). One is accepted if its share of positive texts is ``ratio`` times its share of
    negative ones or more. The one of most worth for the unexplained texts comes next; it gives way to
    longer forms that do as well (see ``_refined``). Candidates that no
    negative text has and many positive ones do follow, as they may share texts with those chosen.
    """
    bags = [frozenset(TOKEN.findall(t.lower())) for t, _ in sample]
    positive = [i for i, (_, y) in enumerate(sample) if y == 1]
    negative = [i for i, (_, y) in enumerate(sample) if y == 0]

    def forms(bag: frozenset[str]) -> set[str]:
        return {w + "$" for w in bag if len(w) >= shortest} | {w[:k] + "*" for w in bag for k in range(shortest, min(longest, len(w) - 1) + 1)}

    clean = Counter(s for i in negative for s in forms(bags[i]))
    own = {i: forms(bags[i]) for i in positive}
    total = Counter(s for i in positive for s in own[i])
    n1, n0 = len(positive) + 1, len(negative) + 1
    good = {s for s, n in total.items() if n >= 4 and (n + 0.5) / n1 >= ratio * (clean[s] + 0.5) / n0}
    chosen: list[str] = []
    left = set(positive)
    explained = Counter(s for i in left for s in own[i] & good)
    # What a candidate is worth: the share it explains, less thrice its share of the negative texts.
    worth = lambda s: explained[s] / n1 - 3 * clean[s] / n0
    while left and explained and len(chosen) < most:
        best = max(explained, key=lambda s: (worth(s), -len(s), s))
        if worth(best) <= 0 or explained[best] < max(3, 0.002 * len(positive)):
            break
        for best in _refined(best, {i for i in left if best in own[i]}, own, clean, good):
            chosen.append(best)
            gone = {i for i in left if best in own[i]}
            left -= gone
            for i in gone:
                explained.subtract(own[i] & good)
    stems, words = [], {s[:-1] for s in chosen if s[-1] == "$"}
    for stem in (s[:-1] for s in chosen if s[-1] == "*"):
        full = Counter(w for i in positive for w in bags[i] if w.startswith(stem) and len(w) > len(stem))
        word, n = full.most_common(1)[0]
        if n >= 0.9 * sum(full.values()):
            words.add(word)
        else:
            stems.append(stem)
    for s in sorted(good, key=lambda s: (-len(s), s)):
        word = s[:-1]
        if clean[s] or total[s] < max(12, 0.02 * len(positive)) or word.startswith(tuple(stems) or ("\0",)):
            continue
        if s[-1] == "$":
            words.add(word)
        elif len(word) >= 4 and not any(x.startswith(word) for x in (*stems, *words)):
            stems.append(word)
    return Lexicon(frozenset(words), tuple(stems))


def _refined(stem: str, texts: set[int], own: dict[int, set[str]], clean: Counter, good: set[str]) -> list[str]:
    """The forms a letter longer, if they explain the same texts (but for a twentieth) and either one
    does alone or together they stand in half as many negative texts; and so on; else the stem itself."""
    if stem[-1] == "$":
        return [stem]
    longer = {s for i in texts for s in own[i] & good if len(s) == len(stem) + 1 and s.startswith(stem[:-1])}
    best = max(longer, key=lambda s: (sum(s in own[i] for i in texts), -clean[s], s), default=None)
    if best and sum(best in own[i] for i in texts) >= 0.95 * len(texts):
        return _refined(best, {i for i in texts if best in own[i]}, own, clean, good)
    shared = [s for s in sorted(longer) if clean[s] * 20 <= sum(s in own[i] for i in texts)]
    both = {i for i in texts if any(s in own[i] for s in shared)}
    if clean[stem] and len(both) >= 0.95 * len(texts) and 2 * sum(clean[s] for s in shared) <= clean[stem]:
        return [x for s in shared for x in _refined(s, {i for i in texts if s in own[i]}, own, clean, good)]
    return [stem]


def train(sample: list[tuple[str, int]], counts: dict[int, int], folds: int = 4) -> ToxicityModel:
    """Learn the lexicon, then weights of the clause patterns by ridge logistic regression within LOW and HIGH.

    Texts weigh so that the classes keep their shares of all labelled rows. To weigh patterns on texts
    that did not choose the words, each of ``folds`` parts is read by a lexicon of the others.
    """
    labels = np.array([y for _, y in sample], float)
    if len(set(labels.tolist())) < 2:
        return ToxicityModel(Lexicon(frozenset(), ()), np.zeros(len(FEATURES)), 3.0 if len(labels) and labels[0] else -3.0)
    model = ToxicityModel(learn_lexicon(sample), np.zeros(len(FEATURES)), 0.0)
    x = np.zeros((len(sample), len(FEATURES)))
    for turn in range(folds):
        part = ToxicityModel(learn_lexicon([s for i, s in enumerate(sample) if i % folds != turn]), model.weights, 0.0)
        for i in range(turn, len(sample), folds):
            x[i] = part.features(sample[i][0])
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    w = _bounded_logistic(np.column_stack([x, np.ones(len(x))]), labels, weight, np.array(PRIOR), 0.1, np.array(LOW), np.array(HIGH))
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def _bounded_logistic(a: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: np.ndarray, ridge: float, low: np.ndarray, high: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights within bounds of least weighted logistic loss plus ``ridge`` times half their squared distance to ``prior``.

    Newton steps over the weights that no bound holds; what passes a bound is set to it.
    """
    w = np.clip(prior, low, high)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + ridge * (w - prior)
        free = ~(((w <= low) & (grad > 0)) | ((w >= high) & (grad < 0)))
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        move = np.zeros(len(w))
        move[free] = np.linalg.solve(hess[np.ix_(free, free)], grad[free])
        w = np.clip(w - move, low, high)
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, rows_per_class: int = 1500, max_chars: int = 12_000) -> ToxicityModel:
    """Learn from a sample bounded by ``rows_per_class`` and ``max_chars``, without the held-out fold."""
    return train(*labelled_sample(docs, labels, "toxic", modulus, held_out, rows_per_class, max_chars))


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, score)`` per row from the whole text alone; a null text scores as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(batch.column(1)[i : i + 256].to_pylist()) for i in range(0, len(batch), 256)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores or [np.zeros(0)]))], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())]))


def with_prediction(scores: DataFrame, threshold: float) -> DataFrame:
    """Adds ``predicted``: 1 where the score is ``threshold`` or more, else 0."""
    return scores.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
