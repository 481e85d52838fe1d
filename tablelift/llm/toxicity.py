"""Toxic terms, misspelled ones too, by Levenshtein automata over a lexicon trie.

The lexicon is learned from at most PER_CLASS labelled documents of each class: whole words, and stems
(beginnings of several words), whose documents are nearly all toxic. Terms are taken greedily by the
log-likelihood of their documents' labels; documents that a term explains count less from then on, so
that words which merely stand beside a term do not enter.

A word is matched by running the automata of all terms at once over the trie: a state is the set of
(trie node, errors) pairs that its letters can reach, and states and steps are kept as they appear.
Terms of LONG letters or more match with one letter (or a digit or mark in its place) wrong, missing or too
many; near words that clean documents of the sample have are spared, one by one, unless they are much more
frequent in toxic ones; a term matches letter by letter only if its near words that RARE clean documents or fewer have are
so many, for how often the term is in toxic ones, that other clean documents must have more of them. A word is matched without the marks around it, and its runs of letters each as well.

A match weighs by its window of CONTEXT words: quotation marks around it, with QUOTED words at most on either
side, or a word for reporting before it make it a mention; a word of address makes it abuse. The weights of all
matches become one strength, and a logistic fit makes strength and length a score.

Cases: null and empty texts have no match; very long texts are read whole; repeated rows are scored
each; without documents of both classes every score is the share of label 1, or 0.5 without labels.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame

from tablelift.llm.calibration import Logistic
from tablelift.llm.labelled import sample

PER_CLASS = 3000
LONG, STEM, CONTEXT, QUOTED = 4, 4, 4, 12
#: Largest rate in clean documents, as a share of that in toxic ones, of a term and of a near word that matches.
RATE, RARE = 0.02, 3
#: Words and state steps that a worker keeps; both are dropped and built again when full.
SEEN_WORDS, STEPS = 300_000, 500_000
LETTERS = re.compile(r"[^\W\d_]+")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
#: Marks of quotation, words that report speech, words of address.
QUOTES = "\"'`«»‘’“”„"
REPORTING = frozenset(["said", "says", "called", "quote", "quoted", "word", "term", "dit", "mot", "sagte", "wort", "dijo", "palabra"])
ADDRESS = frozenset(["you", "your", "u", "dich", "dir", "dein", "tu", "vous", "usted"])
MENTION, ABUSE = 0.4, 1.3


def _forms(word: str) -> set[str]:
    """Runs of letters, and the word without the marks around it."""
    return {word} if word.isalpha() else {*LETTERS.findall(word), EDGES.sub("", word)}


def _opens(word: str) -> bool:
    return word[:1] in QUOTES and word[:1] != ""


def _closes(word: str) -> bool:
    return len(word) > 1 and word.rstrip(".,;:!?")[-1:] in QUOTES and word.rstrip(".,;:!?") != ""


def in_quotation(words: list[str], i: int) -> bool:
    """Whether the next mark to the left opens and the next to the right closes, each within QUOTED words."""
    for j in range(i, max(-1, i - QUOTED - 1), -1):
        if j < i and _closes(words[j]):
            return False
        if _opens(words[j]):
            break
    else:
        return False
    for j in range(i, min(len(words), i + QUOTED + 1)):
        if j > i and _opens(words[j]):
            return False
        if _closes(words[j]):
            return True
    return False


class Lexicon:
    """Trie of terms with the product of their Levenshtein automata, made a state at a time."""

    def __init__(self, words: set[str], stems: set[str], spared: set[str], rigid: set[str]):
        self.words, self.stems, self.spared, self.rigid = words, stems, spared, rigid
        self._build()

    def __getstate__(self):
        return {"words": self.words, "stems": self.stems, "spared": self.spared, "rigid": self.rigid}

    def __setstate__(self, state):
        self.__init__(**state)

    def _build(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.stem_ends: list[bool] = [False]
        for term in sorted(self.words | self.stems):
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.stem_ends.append(False)
                node = self.children[node][c]
            if term in self.words:
                self.ends[node] = term
            if term in self.stems:
                self.stem_ends[node] = True
        self.reset()

    def reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.accepts: list[float] = []
        self.n_steps = 0
        self.start = self._state(frozenset({(0, 0)}))

    def _state(self, pairs: frozenset) -> int:
        """With what a missing letter adds: a child, one error more."""
        full = set(pairs)
        full.update((child, 1) for node, e in pairs if e == 0 for child in self.children[node].values())
        key = frozenset(full)
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            best = 0.0
            for node, e in key:
                term = self.ends[node]
                if term and (e == 0 or (len(term) >= LONG and term not in self.rigid)):
                    best = max(best, 1.0 if e == 0 else 0.9)
                if self.stem_ends[node] and e == 0:
                    best = 1.0
            self.accepts.append(best)
        return self.ids[key]

    def _step(self, state: int, c: str) -> int:
        after = set()
        for node, e in self.states[state]:
            if self.stem_ends[node] and e == 0:
                after.add((node, 0))  # any letters may follow a stem
            for letter, child in self.children[node].items():
                if letter == c:
                    after.add((child, e))
                elif e == 0:
                    after.add((child, 1))
            if e == 0:
                after.add((node, 1))
        self.n_steps += 1
        found = self.steps[state][c] = self._state(frozenset(after))
        return found

    def match(self, word: str) -> float:
        """1 for a term, 0.9 for a term with one error, 0 for no term or a spared word."""
        if self.n_steps > STEPS:
            self.reset()
        state = self.start
        for c in word:
            state = self.steps[state].get(c) if c in self.steps[state] else self._step(state, c)
            if not self.states[state]:
                return 0.0
        found = self.accepts[state]
        return 0.0 if found < 1 and word in self.spared else found


def _learn(texts: list[str], labels: np.ndarray) -> Lexicon:
    """Greedy cover of the toxic texts by words and stems."""
    sets = [set(LETTERS.findall(t.lower())) for t in texts]
    n = [max(1.0, float((labels == k).sum())) for k in (0, 1)]
    clean: Counter = Counter()
    stem_clean: Counter = Counter()
    holders, forms = defaultdict(list), defaultdict(set)
    for i, words in enumerate(sets):
        stems = {w[:k] for w in words for k in range(STEM, min(len(w), 9))}
        if labels[i] == 1:
            for w in words:
                holders[w, False].append(i)
            for w in words:
                for k in range(STEM, min(len(w), 9)):
                    forms[w[:k]].add(w)
            for s in stems:
                holders[s, True].append(i)
        else:
            clean.update(words)
            stem_clean.update(stems)
    open_weight = np.where(labels == 1, 1.0, 0.0)
    index = {}
    for (term, is_stem), held in holders.items():
        bad = (stem_clean if is_stem else clean)[term]
        if len(held) >= 3 and bad / n[0] <= RATE * len(held) / n[1] and (not is_stem or len(forms[term]) >= 3):
            index[term, is_stem] = (np.array(held), bad)
    words: set[str] = set()
    stems: set[str] = set()
    rates: dict[str, float] = {}
    gains = {k: 1e18 for k in index}
    while gains:
        best, best_gain = None, 0.0
        # gains only fall: the largest stale one is refreshed until it stays the largest
        for key in sorted(gains, key=lambda k: (-gains[k], len(k[0]), k)):
            if gains[key] <= best_gain:
                break
            held, bad = index[key]
            weight = open_weight[held].sum()
            p, q = (weight + 0.5) / (n[1] + 1), (bad + 0.5) / (n[0] + 1)
            gains[key] = weight * np.log(p / q) - 0.02 * len(key[0]) if p > q else 0.0
            if gains[key] > best_gain:
                best, best_gain = key, gains[key]
        if best is None or best_gain < 8:
            break
        term, is_stem = best
        (stems if is_stem else words).add(term)
        held, _ = index.pop(best)
        if not is_stem:
            rates[term] = len(held) / n[1]
        open_weight[held] *= 0.15
        del gains[best]
    # near words by their rates in clean and toxic documents
    probe, near = Lexicon(words, stems, set(), set()), (Counter(), Counter())
    for text, label in zip(texts, labels, strict=True):
        near[int(label)].update(set().union(*map(_forms, set(text.lower().split()))))
    close = {w: k for w, k in near[0].items() if 0 < probe.match(w) < 1}
    spared = {w for w, k in close.items() if k / n[0] > RATE * near[1][w] / n[1]}
    # near words found in few clean documents tell the rate of those that the sample does not have
    rare = [w for w in spared if close[w] <= RARE]
    rigid = set()
    for t in words:
        own = Lexicon({t}, set(), set(), set())
        if sum(close[w] for w in rare if own.match(w)) / n[0] > RATE * rates[t]:
            rigid.add(t)
    return Lexicon(words, stems, spared, rigid)


class Model:
    def __init__(self, lexicon: Lexicon, prior: float):
        self.lexicon, self.prior, self.logistic = lexicon, prior, None
        self.seen: set[str] = set()
        self.hits: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"seen": set(), "hits": {}}

    @classmethod
    def fit(cls, texts: list[str], labels: np.ndarray) -> Model:
        prior = float(labels.mean()) if len(labels) else 0.5
        if len(set(labels)) < 2:
            return cls(Lexicon(set(), set(), set(), set()), prior)
        model = cls(_learn(texts, labels), prior)
        model.logistic = Logistic.fit(model.features(texts), labels)
        return model

    def _look(self, words: set[str]) -> None:
        if len(self.seen) > SEEN_WORDS:
            self.seen, self.hits = set(), {}
        for w in words:
            found = max(map(self.lexicon.match, _forms(w)), default=0.0)
            if found:
                self.hits[w] = found
        self.seen |= words

    def matches(self, text: str) -> list[tuple[int, str, float]]:
        """Place among the words, word and weight in its context of every match."""
        words = text.lower().split()
        distinct = set(words)
        new = distinct - self.seen
        if new:
            self._look(new)
        if self.hits.keys().isdisjoint(distinct):
            return []
        out = []
        for i, w in enumerate(words):
            weight = self.hits.get(w)
            if weight:
                window = [x.strip(".,;:!?") for x in words[max(0, i - CONTEXT) : i + CONTEXT + 1]]
                if in_quotation(words, i) or not REPORTING.isdisjoint(window[:CONTEXT]):
                    weight *= MENTION
                elif not ADDRESS.isdisjoint(window):
                    weight *= ABUSE
                out.append((i, w, weight))
        return out

    def features(self, texts: list[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), 2))
        for i, t in enumerate(texts):
            strength = sum(w for _, _, w in self.matches(t)) if t else 0.0
            x[i] = min(strength, 1.0), np.log1p(strength)
        return x

    def score(self, data: list[bytes]) -> np.ndarray:
        if self.logistic is None:
            return np.full(len(data), self.prior)
        return self.logistic.score(self.features([d.decode() for d in data])) if data else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, learn, label: str = "toxic", per_class: int = PER_CLASS) -> Model:
    """`learn`: a condition on doc_id for the labels that may be learned from."""
    return Model.fit(*sample(docs, labels, label, learn, per_class))
