"""Subject areas of documents: classifier chains over term, source and structure features.

The model is fitted on a bounded sample of labelled documents (see
``LABELLED_DOCS``) in four steps:

1. *Terms.*  Word sequences of up to two words get, for every subject, the
   share of labelled documents with the sequence that have the subject,
   shrunk towards the subject's overall share.  The words of a subject's scope
   note and field stand for ``PRIOR_DOCS`` documents of it.  A sequence that
   clearly points to one subject is a term of it.
2. *Contexts.*  The words around a term tell whether the sentence treats
   the subject or only names it: every context word or pair gets the log odds
   with which a term beside it was borne out by the document's labels.
3. *Chain.*  One logistic regression per subject, in order of falling
   frequency, over the evidence for all subjects, structure (length,
   sentences, kind of document, language), source (the feed it came from) and
   the subjects decided before it in the chain.  What all subjects have in
   common, how evidence for a subject speaks for it, is fitted once over all of
   them, and every chain weight is drawn towards it, so a subject with few
   labels starts from the others.  Terms and contexts used for a training document
   leave its fold out, so the probabilities are calibrated for unseen documents; Platt
   scaling on held-out scores corrects what is left.
4. *Decoding.*  Beam search over the chain finds the label combination of
   highest joint probability; co-occurrence enters through the chained inputs.

The model (terms, contexts, weights) comes from a bounded sample and is
therefore bounded itself; it travels to the workers in a broadcast variable and
classifies batches of documents as arrays of word numbers in one narrow pass.

Defined results: null, empty and blank texts have no subject; a null label
means that a document has none; labels of unknown documents are ignored;
with no labelled document at all nothing is assigned; repeated rows of a
document give each subject once.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.sources.stages import spread

#: At most so many labelled documents are used for fitting; beyond, those with the smallest hash of their id.
LABELLED_DOCS = 6_000
FOLDS = 5
BEAM = 12
#: Evidence features of each subject; the first is the number of sentences that treat it.
FEATURES = 8
MAX_WORDS = 2

#: Least share of the sample at which a feed is a feature of its own.
FEED_SHARE = 0.02

#: A sequence is a term if its shrunk share of a subject reaches LEAST_SHARE; SHRINK documents of the overall share are mixed in.
SHRINK, LEAST_SHARE = 2.0, 0.55
#: Fewest labelled documents with a sequence for it to be a term, whatever the size of the sample.
LEAST_DOCS = 2
#: Log odds of the context below which a sentence only names the subject.
NAMED_ONLY = -1.5
#: Documents of its subject that a word of a scope note or field name stands for.
PRIOR_DOCS = 2.0
#: Characters of text that are worked on at once.
CHUNK_CHARS = 4_000_000

_TAG = re.compile(r"<[^<>]*>")
_WORD = re.compile(r"[a-z]+|[0-9]+")
_HYPHEN = re.compile(r"(\w)-\s*\n\s*(\w)")
_BREAK = re.compile(r"(?<=[.?!;])\s+|\s*\n\s*\n\s*|\n(?=\s*(?:[0-9]+[.)]|[A-Z*•-]))|:\s+(?=[A-Z0-9])")
_INVISIBLE = re.compile("[­​‌‍⁠﻿]")
_PLAIN = str.maketrans({"ø": "o", "Ø": "O", "æ": "ae", "Æ": "AE", "ß": "ss", "ł": "l", "đ": "d", "’": "'"})


def sentences(text: str) -> list[list[str]]:
    """Sentences as lists of bare lower-case words; numbers become ``9``."""
    if not text.isascii():
        text = _INVISIBLE.sub("", text)
    if "<" in text:
        text = _TAG.sub(" \n\n ", text)
    if "&" in text:
        text = html.unescape(text)
    if "-" in text and "\n" in text:
        text = _HYPHEN.sub(r"\1\2", text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(_PLAIN))
        text = "".join(c for c in text if not unicodedata.combining(c))
    parts = [["9" if w[0] <= "9" else w for w in _WORD.findall(part.lower())] for part in _BREAK.split(text)]
    return [words for words in parts if words]


def grams(words: list[str], most: int = MAX_WORDS) -> Iterator[tuple[int, int, str]]:
    """(start, end, sequence) of all word sequences of up to ``most`` words."""
    for i in range(len(words)):
        for n in range(1, most + 1):
            if i + n <= len(words):
                yield i, i + n, " ".join(words[i : i + n])


@dataclass
class Evidence:
    """Mentions of a document: (sentence, subject, strength, term) and the context of each sentence."""

    mentions: list[tuple[int, int, float, str]]
    contexts: dict[int, set[str]]
    n_sentences: int
    n_words: int


def first_words(terms: dict[str, tuple[int, float]]) -> set[str]:
    """First words of the terms of several words."""
    return {t.split(" ", 1)[0] for t in terms if " " in t}


def find_terms(doc: list[list[str]], terms: dict[str, tuple[int, float]], heads: set[str]) -> Evidence:
    """Longest terms win where they overlap; what is left of a sentence is its context.  ``heads``: the terms' :func:`first_words`."""
    mentions, contexts = [], {}
    for k, words in enumerate(doc):
        hits = []
        for i, w in enumerate(words):
            if w in terms:
                hits.append((1, terms[w][1], i, i + 1, w))
            if w in heads:
                for n in range(2, min(MAX_WORDS, len(words) - i) + 1):
                    g = " ".join(words[i : i + n])
                    if g in terms:
                        hits.append((n, terms[g][1], i, i + n, g))
        if not hits:
            continue
        rest = list(words)
        for _, strength, s, e, g in sorted(hits, key=lambda h: (-h[1] - 0.02 * h[0], h[2])):
            if "_" not in rest[s:e]:
                rest[s:e] = ["_"] * (e - s)
                mentions.append((k, terms[g][0], strength, g))
        contexts[k] = {g for _, _, g in grams(rest, 2) if g != "_"}
    return Evidence(mentions, contexts, len(doc), sum(map(len, doc)))


class TermCounts:
    """Documents with a sequence, by fold and subject; a fold's share can be taken away."""

    def __init__(self, n_subjects: int, prior_words: Iterable[Iterable[str]] = ()):
        self.n_subjects = n_subjects
        # Words that stand in scope notes, with what they say about each subject; shared by all folds.
        self.prior: dict[str, np.ndarray] = {}
        for s, words in enumerate(prior_words):
            for w in words:
                row = self.prior.setdefault(w, np.zeros(n_subjects + 1, np.float32))
                row[s] += PRIOR_DOCS
                row[-1] += PRIOR_DOCS
        self.by_fold: list[dict[str, np.ndarray]] = [{} for _ in range(FOLDS)]
        self.docs = np.zeros((FOLDS, n_subjects + 1))

    def add(self, fold: int, doc: list[list[str]], labels: set[int], keep: set[str]) -> None:
        row = np.zeros(self.n_subjects + 1, np.float32)
        row[list(labels)] = 1
        row[-1] = 1
        self.docs[fold] += row
        counts = self.by_fold[fold]
        for g in {g for words in doc for _, _, g in grams(words)} & keep:
            if g in counts:
                counts[g] += row
            else:
                counts[g] = row.copy()

    def terms(self, without: int | None = None, shrink: float = SHRINK, least: float = LEAST_SHARE) -> dict[str, tuple[int, float]]:
        """Sequence to (subject, strength) of the clear ones, leaving a fold out."""
        folds = [f for f in range(FOLDS) if f != without]
        total = sum(self.docs[f] for f in folds)
        prior = total[:-1] / max(total[-1], 1)
        sums: dict[str, np.ndarray] = dict(self.prior)
        for f in folds:
            for g, row in self.by_fold[f].items():
                sums[g] = sums[g] + row if g in sums else row
        names = [g for g, row in sums.items() if row[-1] >= LEAST_DOCS]
        if not names:
            return {}
        table = np.stack([sums[g] for g in names])
        share = (table[:, :-1] + shrink * prior) / (table[:, -1:] + shrink)
        best = share.argmax(1)
        strength = share[np.arange(len(names)), best]
        picked = {g: (int(b), float(s)) for g, b, s in zip(names, best, strength, strict=True) if s >= least and g != "9"}
        # A longer sequence counts only where it says more than each of its parts, or something else.
        return {g: v for g, v in picked.items() if " " not in g or not any(p in picked and picked[p][0] == v[0] and picked[p][1] >= v[1] for p in _parts(g))}


def _parts(gram: str) -> list[str]:
    words = gram.split(" ")
    return [" ".join(words[i : i + n]) for n in range(1, len(words)) for i in range(len(words) - n + 1)]


def context_odds(counts: dict[str, np.ndarray], shrink: float = 4.0, least: int = 4) -> dict[str, float]:
    """Log odds of a context that a term beside it is borne out, against all mentions."""
    base = counts.get("", np.array([1.0, 1.0]))
    rate = (base[0] + 1) / (base.sum() + 2)
    neutral = np.log(rate / (1 - rate))
    return {c: float(np.log((n[0] + shrink * rate) / (n[1] + shrink * (1 - rate))) - neutral) for c, n in counts.items() if c and n.sum() >= least}


def features(e: Evidence, odds: dict[str, float], n_subjects: int) -> np.ndarray:
    """Per subject: mentions, sentences that treat it, sentences that only name it, distinct terms, share, strength."""
    out = np.zeros((n_subjects, FEATURES), np.float32)
    treated, named, terms, strongest = defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(float)
    for k, s, strength, g in e.mentions:
        around = sorted(odds[c] for c in e.contexts[k] if c in odds)
        score = sum(around[:2]) / 2 if len(around) > 1 else around[0] if around else 0.0
        strongest[s] = max(strongest[s], strength)
        terms[s].add(g)
        (treated if score > NAMED_ONLY else named)[s].add(k)
    everything = sum(len(v) for v in treated.values())
    for s in terms:
        n = len(treated[s])
        out[s] = [np.log1p(n), n > 0, n > 1, n > 2, np.log1p(len(named[s])), np.log1p(len(terms[s])), n / max(everything, 1), strongest[s] * (n > 0)]
    return out.ravel()


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float, mean: np.ndarray | None = None, rounds: int = 30) -> np.ndarray:
    """Weights (last: intercept) of a logistic regression by Newton steps, with an L2 penalty on their distance from ``mean`` (zero if not given)."""
    x = np.hstack([x, np.ones((len(x), 1))])
    mean = np.zeros(x.shape[1]) if mean is None else mean
    w = mean.copy()
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * (w - mean)
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-5:
            break
    return w


class Grams:
    """Words and word pairs of a table as sorted numbers, for looking up many at once."""

    def __init__(self, names: Sequence[str], vocabulary: dict[str, int]):
        pairs = [(n, k) for k, n in enumerate(names) if " " in n]
        self.single = np.full(len(vocabulary) + 1, -1, np.int64)
        for k, n in enumerate(names):
            if " " not in n:
                self.single[vocabulary[n]] = k
        base = len(vocabulary) + 1
        keys = np.array([vocabulary[n.split(" ")[0]] * base + vocabulary[n.split(" ")[1]] for n, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rows = np.append(keys[order], np.iinfo(np.int64).max), np.append(np.array([k for _, k in pairs], np.int64)[order], -1)

    def pairs(self, keys: np.ndarray) -> np.ndarray:
        """Row of each pair key, or -1."""
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.rows[at], -1)


@dataclass
class SubjectModel:
    subjects: list[str]
    terms: dict[str, tuple[int, float]]
    odds: dict[str, float]
    order: list[int]
    weights: list[np.ndarray]
    scales: list[tuple[float, float]]
    kinds: list[str]
    languages: list[str]
    feeds: list[str]

    def __post_init__(self):
        n = len(self.weights[0]) - 1 if self.weights else 0
        self._heads = np.stack([w[:n] for w in self.weights]) if self.weights else np.zeros((0, n))
        self._shifts = np.array([w[-1] for w in self.weights])
        self._links = [w[n:-1] for w in self.weights]
        words = {w for g in (*self.terms, *self.odds) for w in g.split(" ")} | {"_"}
        self._words = {w: k for k, w in enumerate(sorted(words), 1)}
        self._terms, self._odds = Grams(list(self.terms), self._words), Grams(list(self.odds), self._words)
        self._subject = np.array([v[0] for v in self.terms.values()], np.int64)
        self._strength = np.array([v[1] for v in self.terms.values()])
        self._length = np.array([1 + (" " in t) for t in self.terms], np.int64)
        self._odd = np.array(list(self.odds.values()))

    def inputs(self, texts: Sequence[str | None], kinds: Sequence[str | None], languages: Sequence[str | None], feeds: Sequence[str | None]) -> np.ndarray:
        """One row of features for each text."""
        docs = [sentences(t or "") for t in texts]
        evidence, used = self.evidence(docs)
        structure = [_structure(self.kinds, self.languages, self.feeds, len(d), sum(map(len, d)), u, k, g, f) for d, u, k, g, f in zip(docs, used, kinds, languages, feeds, strict=True)]
        return np.hstack([evidence, np.stack(structure) if structure else np.zeros((0, self._heads.shape[1] - evidence.shape[1]))])

    def evidence(self, docs: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """(features of all subjects, sentences with a mention) of each document; the same numbers as :func:`features` gives one by one."""
        n, s = len(docs), len(self.subjects)
        lengths = np.array([len(words) for d in docs for words in d], np.int64)
        ids = np.fromiter(map(self._words.get, chain.from_iterable(chain.from_iterable(docs)), repeat(0)), np.int64, int(lengths.sum()))
        sentence = np.repeat(np.arange(len(lengths)), lengths)
        doc_of = np.repeat(np.arange(n), [len(d) for d in docs])
        base = len(self._words) + 1
        beside = np.append(sentence[1:] == sentence[:-1], False) if len(ids) else np.zeros(0, bool)

        def look_up(table: Grams, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """(place, row) of all single words and pairs of a table."""
            single = table.single[numbers]
            at = np.flatnonzero(single >= 0)
            ahead = np.flatnonzero(beside & (numbers > 0))
            ahead = ahead[numbers[ahead + 1] > 0]
            found = table.pairs(numbers[ahead] * base + numbers[ahead + 1])
            return np.concatenate([at, ahead[found >= 0]]), np.concatenate([single[at], found[found >= 0]])

        place, term = look_up(self._terms, ids)
        # The stronger term wins where two overlap, then the earlier.
        best = np.lexsort((place, -self._strength[term] - 0.02 * self._length[term]))
        taken, kept = bytearray(len(ids) + 1), []
        for k, p, last in zip(best.tolist(), place[best].tolist(), (place + self._length[term] - 1)[best].tolist(), strict=True):
            if not taken[p] and not taken[last]:
                taken[p] = taken[last] = 1
                kept.append(k)
        kept = np.array(kept, np.int64)
        place, term = place[kept], term[kept]
        hit = sentence[place]

        # What is left of the sentences with a hit: the two contexts that speak most against it.
        rest = np.where(np.frombuffer(taken, np.uint8)[: len(ids)] > 0, self._words["_"], ids)
        at, row = look_up(self._odds, rest)
        with_hit = np.zeros(len(lengths) + 1, bool)
        with_hit[hit] = True
        wanted = with_hit[sentence[at]]
        near_sentence, near_row = np.divmod(np.unique(sentence[at[wanted]] * (len(self._odd) + 1) + row[wanted]), len(self._odd) + 1)
        order = np.lexsort((self._odd[near_row], near_sentence))
        near_sentence, near_row = near_sentence[order], near_row[order]
        starts = np.searchsorted(near_sentence, np.arange(len(lengths)))
        held = np.searchsorted(near_sentence, np.arange(len(lengths)), side="right") - starts
        value = np.append(self._odd[near_row], [0.0, 0.0])
        score = np.where(held > 1, (value[starts] + value[np.minimum(starts + 1, len(value) - 1)]) / 2, np.where(held == 1, value[starts], 0.0))

        subject, doc = self._subject[term], doc_of[hit]
        cell = lambda d, x: np.bincount(d * s + x, minlength=n * s).reshape(n, s)
        told = np.unique(hit * s + subject)
        told_sentence, told_subject = told // s, told % s
        good = score[told_sentence] > NAMED_ONLY
        treated = cell(doc_of[told_sentence[good]], told_subject[good])
        named = cell(doc_of[told_sentence[~good]], told_subject[~good])
        different_doc, different = np.divmod(np.unique(doc * (len(self._subject) + 1) + term), len(self._subject) + 1)
        terms = cell(different_doc, self._subject[different])
        strongest = np.zeros(n * s)
        np.maximum.at(strongest, doc * s + subject, self._strength[term])
        share = treated / np.maximum(treated.sum(1, keepdims=True), 1)
        out = np.stack([np.log1p(treated), treated > 0, treated > 1, treated > 2, np.log1p(named), np.log1p(terms), share, strongest.reshape(n, s) * (treated > 0)], axis=2)
        return out.reshape(n, s * FEATURES), np.bincount(doc_of[np.unique(hit)], minlength=n)

    def decode(self, x: np.ndarray) -> list[list[str]]:
        """Subjects of the most probable label combination of each row."""
        chosen = self.best_combinations(x)
        return [[self.subjects[self.order[k]] for k in np.flatnonzero(row)] for row in chosen]

    def best_combinations(self, x: np.ndarray) -> np.ndarray:
        """Beam search over the chain for all rows at once: one flag for each step of the chain."""
        n, steps = len(x), len(self.order)
        base = x @ self._heads.T + self._shifts
        score, taken = np.zeros((n, 1)), np.zeros((n, 1, steps), bool)
        for k in range(steps):
            slope, shift = self.scales[k]
            z = slope * (base[:, k : k + 1] + taken[:, :, :k] @ self._links[k][:k]) + shift
            with_k = taken.copy()
            with_k[:, :, k] = True
            score = np.hstack([score - np.logaddexp(0, z), score - np.logaddexp(0, -z)])
            taken = np.concatenate([taken, with_k], axis=1)
            if score.shape[1] > BEAM:
                best = np.argsort(-score, axis=1, kind="stable")[:, :BEAM]
                score, taken = np.take_along_axis(score, best, 1), np.take_along_axis(taken, best[:, :, None], 1)
        return taken[np.arange(n), score.argmax(1)] if n else np.zeros((0, steps), bool)


def _structure(kinds: list[str], languages: list[str], feeds: list[str], n_sentences: int, n_words: int, used: int, kind: str | None, language: str | None, feed: str | None) -> np.ndarray:
    language = (language or "").lower()[:2]
    return np.array(
        [math.log1p(n_sentences), math.log1p(n_words), used / max(n_sentences, 1), *(float(kind == k) for k in kinds), *(float(language == x) for x in languages), *(float(feed == x) for x in feeds)], np.float32
    )


def prior_words(areas: Sequence[tuple[str, str | None, str | None]], subjects: list[str]) -> list[set[str]]:
    """Words of the field and scope note of every subject; words that several subjects have say nothing and drop."""
    words: list[set[str]] = [set() for _ in subjects]
    for name, *texts in areas:
        for t in texts:
            words[subjects.index(name)] |= {w for sentence in sentences(t or "") for w in sentence}
    seen = Counter(w for own in words for w in own)
    return [{w for w in own if seen[w] == 1} for own in words]


def fit(rows: list[tuple[str | None, str | None, str | None, str | None, set[str]]], subjects: list[str], penalty: float = 1.0, notes: Sequence[Iterable[str]] = ()) -> SubjectModel:
    """Model from (text, kind, language, feed, subjects) of labelled documents, in a fixed order, and the words of every subject's notes."""
    at = {s: i for i, s in enumerate(subjects)}
    docs = [sentences(r[0] or "") for r in rows]
    labels = [{at[s] for s in r[4] if s in at} for r in rows]
    folds = [i % FOLDS for i in range(len(rows))]
    kinds = sorted({r[1] for r in rows if r[1]})
    languages = sorted({r[2].lower()[:2] for r in rows if r[2]})
    feeds = [f for f, n in sorted(Counter(r[3] for r in rows if r[3]).items()) if n >= FEED_SHARE * len(rows)]
    seen: Counter[str] = Counter()
    for d in docs:
        seen.update({g for words in d for _, _, g in grams(words)})
    keep = {g for g, n in seen.items() if n >= LEAST_DOCS}
    counts = TermCounts(len(subjects), notes)
    for d, fold, own in zip(docs, folds, labels, strict=True):
        counts.add(fold, d, own, keep)
    del seen, keep

    # Evidence of each document from the terms of the other folds, and what its labels say about the contexts.
    evidence: list[Evidence] = [Evidence([], {}, 0, 0)] * len(rows)
    borne: list[dict[str, np.ndarray]] = [defaultdict(lambda: np.zeros(2)) for _ in range(FOLDS)]
    for f in range(FOLDS):
        terms = counts.terms(without=f)
        heads = first_words(terms)
        for i in range(f, len(rows), FOLDS):
            e = evidence[i] = find_terms(docs[i], terms, heads)
            for k, s in {(k, s) for k, s, *_ in e.mentions}:
                for c in {"", *e.contexts[k]}:
                    borne[f][c][0 if s in labels[i] else 1] += 1
    inputs = []
    odds_of = [context_odds(_added(b for g, b in enumerate(borne) if g != f)) for f in range(FOLDS)]
    for i, r in enumerate(rows):
        inputs.append(np.concatenate([features(evidence[i], odds_of[folds[i]], len(subjects)), _structure(kinds, languages, feeds, len(docs[i]), sum(map(len, docs[i])), len({k for k, *_ in evidence[i].mentions}), *r[1:4])]))

    share = [sum(s in own for own in labels) for s in range(len(subjects))]
    order = sorted(range(len(subjects)), key=lambda s: (-share[s], subjects[s]))
    x = np.stack(inputs).astype(np.float64) if rows else np.zeros((0, 1))
    weights, scales = [], []
    chained = np.zeros((len(rows), 0))
    fold = np.array(folds)
    y_of = {s: np.array([float(s in own) for own in labels]) for s in order}
    n_own, n_shared = FEATURES, x.shape[1] - FEATURES * len(subjects)
    own = lambda s: np.hstack([x[:, s * FEATURES : (s + 1) * FEATURES], x[:, FEATURES * len(subjects) :]])
    common = _logistic(np.vstack([own(s) for s in order]), np.concatenate([y_of[s] for s in order]), penalty) if order and rows else np.zeros(n_own + n_shared + 1)

    def drawn(s: int, width: int) -> np.ndarray:
        mean = np.zeros(width + 1)
        mean[s * FEATURES : (s + 1) * FEATURES] = common[:n_own]
        mean[FEATURES * len(subjects) : x.shape[1]] = common[n_own:-1]
        mean[-1] = common[-1]
        return mean

    for s in order:
        y, full = y_of[s], np.hstack([x, chained])
        mean = drawn(s, full.shape[1])
        held_out = np.zeros(len(rows))
        for f in range(FOLDS):
            w = _logistic(full[fold != f], y[fold != f], penalty, mean)
            held_out[fold == f] = full[fold == f] @ w[:-1] + w[-1]
        # Drawn towards leaving the scores as they are, which matters for subjects with few labels.
        slope, shift = _logistic(held_out[:, None], y, 1.0, np.array([1.0, 0.0]))
        weights.append(_logistic(full, y, penalty, mean))
        scales.append((float(slope), float(shift)))
        chained = np.hstack([chained, y[:, None]])
    return SubjectModel(subjects, counts.terms(), context_odds(_added(borne)), order, weights, scales, kinds, languages, feeds)


def _added(parts) -> dict[str, np.ndarray]:
    total: dict[str, np.ndarray] = {}
    for part in parts:
        for c, n in part.items():
            total[c] = total[c] + n if c in total else n
    return total


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = LABELLED_DOCS) -> list[tuple]:
    """(text, kind, language, feed, subjects) of labelled documents, the smallest hashes first."""
    per_doc = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))
    sample = per_doc.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # The sample is bounded by ``most``, so it may be sent to every task instead of shuffling the texts.
    found = docs.select("doc_id", "text", "doc_type", "lang", "source").join(F.broadcast(sample), "doc_id")
    rows = {r.doc_id: (r.text, r.doc_type, r.lang, r.source, set(r.subjects)) for r in found.toLocalIterator()}
    # Known order, apart from that of the ids, so that neighbours do not share a fold by accident.
    return [rows[k] for k in sorted(rows, key=lambda k: (hash_of(k), k))]


def chunks(batch: pa.RecordBatch, most: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Parts of a batch (texts in its second column) with about ``most`` bytes of text, one text at least."""
    size = np.diff(np.cumsum(np.append(0, pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))) // most, prepend=0)
    bounds = [0, *np.flatnonzero(size[1:]).tolist(), len(batch)]
    for start, end in zip(bounds, bounds[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def hash_of(doc_id: int) -> int:
    """A fixed scramble of an id."""
    return (doc_id * 0x9E3779B97F4A7C15) % (1 << 64) >> 20


def assign_subjects(docs: DataFrame, labels: DataFrame, areas: DataFrame, most: int = LABELLED_DOCS) -> DataFrame:
    """(doc_id, subject) of every document without a label row.

    Labelled documents are left out after the classification: what is joined there is a few ids, not the texts.
    """
    described = [c if c in areas.columns else F.lit(None).cast("string").alias(c) for c in ("subject", "oa_field", "scope_note")]
    known = [tuple(r) for r in areas.select(*described).where("subject IS NOT NULL").collect()]
    subjects = sorted({r[0] for r in known})
    rows = labelled_rows(docs, labels, most)
    out_type = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, subject string"
    if not rows or not subjects:
        return docs.sparkSession.createDataFrame([], out_type)
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, subjects, notes=prior_words(known, subjects)))
    del rows

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for b in chunks(batch):
                found = m.decode(m.inputs(*(b.column(c).to_pylist() for c in range(1, 5))))
                at = np.repeat(np.arange(len(found)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array([x for f in found for x in f], pa.string())], names=["doc_id", "subject"])

    texts = docs.select("doc_id", "text", "doc_type", "lang", "source")
    assigned = spread(texts.where("length(text) > 0")).mapInArrow(classify, out_type).distinct()
    return assigned.join(labels.select("doc_id").where("doc_id IS NOT NULL").distinct(), "doc_id", "left_anti")


def corpus_by_subject(assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """(subject, n_documents, n_labelled) over assigned and labelled documents."""
    given = labels.where("subject IS NOT NULL").select("doc_id", "subject").distinct().withColumn("labelled", F.lit(1))
    both = assigned.withColumn("labelled", F.lit(0)).unionByName(given)
    return both.groupBy("subject").agg(F.count("*").alias("n_documents"), F.sum("labelled").alias("n_labelled"))
