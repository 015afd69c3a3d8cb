"""Toxicity by a weighted finite-state pattern grammar.

Words carry classes (insult, threat, target, negation, report, other). Five
small transducers read the class sequence of a clause: insult, threat, target,
negation and reported speech. They are composed into one machine whose state is
the tuple of their states; a clause that ends in a matched state yields a *path*
(what was matched and how it was modified), and paths have weights: a target
raises an insult or threat, negation and reported speech lower it. A document's
evidence is the weighted sum over its matched clauses, not over isolated words.

The insult transducer also reads *learned patterns*, word beginnings that in
labelled rows occur (once, or two or three times) in toxic documents and nearly
no others. They are found by covering: of the toxic documents that the grammar
does not explain yet, the purest pattern in most of them is taken, until none
explains enough more. So other languages than the lexicon's are learned.

Pattern weights and the two constants that turn evidence into a probability are
learned from labels; a document without a matched clause gets the base rate.
Fitting looks at a bounded sample of labelled rows (``MAX_LABELLED``, the
smallest hashes of the id); scoring reads every whole text in one pass and
needs no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, id_crc, map_in_place, materialise, slices, split_words, text_bytes

# FIXED VALUES: the lexicon.
INSULTS = ("idiot", "idiots", "moron", "morons", "scum", "trash", "garbage", "pathetic", "worthless", "stupid",
           "clown", "clowns", "loser", "losers", "disgusting", "imbecile", "imbeciles", "dumb", "retard", "retarded",
           "bastard", "bastards", "bitch", "bitches", "asshole", "assholes", "fuck", "fucking", "fucker", "shit",
           "shitty", "vermin", "filth", "filthy", "cretin", "cretins", "dimwit", "dumbass", "jackass", "freak",
           "subhuman", "degenerate", "whore", "slut", "coward", "cowards", "ugly", "disgrace", "lowlife", "swine",
           "parasite", "parasites", "cockroach", "cockroaches", "nitwit", "halfwit", "brainless", "crap", "sucks")
THREATS = ("kill", "killed", "murder", "hurt", "destroy", "shoot", "stab", "strangle", "attack", "punch", "crush",
           "slaughter", "exterminate", "torture", "lynch", "rape", "burn", "hang")
TARGETS = ("you", "your", "yours", "yourself", "youre", "u", "ur", "they", "them", "their", "he", "him", "she", "her",
           "these", "those", "people", "everyone", "family", "kids")
NEGATIONS = ("not", "never", "no", "isn", "aren", "wasn", "don", "doesn", "didn", "cannot", "without", "neither", "nor")
REPORTS = ("said", "says", "wrote", "writes", "claimed", "claims", "called", "quoted", "reported", "according",
           "alleged", "testified", "posted", "replied")

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
WORD_CLASSES: dict[bytes, int] = {w.encode(): c for c, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS))
                                  for w in ws}
LEXICON: tuple[bytes, ...] = tuple(w.encode() for w in INSULTS + THREATS)

#: How far (in words) a negation reaches forward.
NEGATION_REACH = 2
#: A path's factor on the word's weight.
FACTORS = {"plain": 1.0, "target": 1.5}
NEGATED, REPORTED = 0.35, 0.5
#: Bound on the labelled rows that fitting looks at.
MAX_LABELLED = 20_000
#: A learned pattern: so many characters of a word's beginning, at least so many times in a
#: text; in at most this share as many other documents as toxic ones; each pattern explains
#: MIN_SUPPORT more toxic documents and MIN_SHARE of those the lexicon leaves unexplained.
PATTERN_CHARS, REPEATS, IMPURITY, MIN_SUPPORT, MIN_SHARE = range(3, 8), (1, 2, 3), 0.1, 6, 0.02
#: Words a task remembers.
MEMO_WORDS = 400_000

#: Clauses end at ASCII marks and line ends and at the same marks of other scripts (full-width, CJK, Arabic, Devanagari,
#: Armenian, Ethiopic, double quotation marks, ellipsis, line and paragraph separators, next line).
_MARKS = "\u3002\uff0e\uff61\uff0c\u3001\uff64\uff1b\uff1a\uff01\uff1f\uff08\uff09\uff02\u300c\u300d\u300e\u300f\u060c\u061b\u061f\u06d4" \
    "\u0964\u0965\u0589\u1362\u1363\u1364\u1365\u1367\u1368\u201c\u201d\u201e\u00ab\u00bb\u2026\u203c\u203d\u2047\u2048\u2049\u2028\u2029\u0085"
_CLAUSE = re.compile(rb"[.,;:!?()\n\r\"]+")
_OTHER_MARK = re.compile(f"[{_MARKS}]")


def with_line_ends(text: bytes) -> bytes:
    """The text with a line end for each mark of _MARKS (the word rule takes these for letters)."""
    if text.isascii():
        return text
    return _OTHER_MARK.sub("\n", text.decode("utf-8", "surrogateescape")).encode("utf-8", "surrogateescape")


# Each transducer: state x class -> state. Their outputs are read off the states.
def _step_insult(s: int, c: int) -> int:  # 1: an insult has been read
    return 1 if c == INSULT else s


def _step_threat(s: int, c: int) -> int:  # 1: a threat waits for its target; 2: it has one
    return max(s, 1) if c == THREAT else (2 if s == 1 and c == TARGET else s)


def _step_target(s: int, c: int) -> int:  # 1: a target stands anywhere in the clause
    return 1 if c == TARGET else s


def _step_negation(s: int, c: int) -> int:  # words that a negation still reaches; hits under it are marked
    return NEGATION_REACH if c == NEGATION else max(0, s - 1)


def _step_report(s: int, c: int) -> int:  # 1: from a reporting verb to the end of the clause
    return 1 if c == REPORT else s


STEPS = (_step_insult, _step_threat, _step_target, _step_negation, _step_report)


def compose() -> dict[tuple[int, ...], tuple[tuple[int, ...], ...]]:
    """The composed machine: every reachable state tuple and its successors by class."""
    start = (0,) * len(STEPS)
    table, todo = {}, [start]
    while todo:
        s = todo.pop()
        if s in table:
            continue
        table[s] = tuple(tuple(f(x, c) for f, x in zip(STEPS, s, strict=True)) for c in range(6))
        todo += table[s]
    return table


MACHINE = compose()


class Grammar(dict):
    """Word -> class * 2**20 + pattern number, worked out once a word and task.
    Patterns are the lexicon's words and then the learned word beginnings."""

    def __init__(self, learned: tuple[tuple[bytes, int], ...] = ()):
        super().__init__()
        self.learned = tuple(learned)  # (word beginning, least number of occurrences)
        self.exact = {w: i for i, w in enumerate(LEXICON)}
        self.begins = {w: len(LEXICON) + i for i, (w, _) in enumerate(self.learned)}
        self.least = [1] * len(LEXICON) + [k for _, k in self.learned]
        self.lengths = tuple(sorted({len(w) for w, _ in self.learned}, reverse=True))

    def __reduce__(self):
        return Grammar, (self.learned,)

    @property
    def size(self) -> int:
        return len(LEXICON) + len(self.learned)

    def __missing__(self, word: bytes) -> int:
        i = self.exact.get(word)
        if i is None:
            i = next((k for n in self.lengths if (k := self.begins.get(word[:n])) is not None), None)
        c = WORD_CLASSES.get(word, OTHER) if i is None else (THREAT if len(INSULTS) <= i < len(LEXICON) else INSULT)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = code = (c << 20) + (i or 0)
        return code

    def triggers(self, words: list[bytes]) -> bool:
        """Does any word open a match? (INSULT and THREAT are classes 1 and 2.)"""
        return any([1 << 20 <= self[w] < 3 << 20 for w in words])

    def match_clause(self, words: list[bytes]) -> list[tuple[int, float]]:
        """Matches of one clause: (pattern, path factor). An insult always
        matches; a threat matches when a target follows it. A later word of the
        same clause may still add the target, so factors are settled at its end."""
        state = (0,) * len(STEPS)
        found: list[tuple[int, int, bool, bool]] = []  # pattern, class, negated, reported
        threats_with_target = 0
        for w in words:
            c, pattern = divmod(self[w], 1 << 20)
            negated = state[3] > 0
            state = MACHINE[state][c]
            if c in (INSULT, THREAT):
                found.append((pattern, c, negated, bool(state[4])))
            threats_with_target = max(threats_with_target, state[1])
        out = []
        for pattern, c, negated, reported in found:
            if c == THREAT and threats_with_target < 2:
                continue
            factor = FACTORS["target" if state[2] else "plain"]
            out.append((pattern, factor * (NEGATED if negated else 1.0) * (REPORTED if reported else 1.0)))
        return out

    def match_text(self, text: bytes) -> list[tuple[int, float]]:
        """Matches of a whole text. Texts without a trigger word are left at once;
        clauses end at punctuation and line ends and are read whole."""
        text = with_line_ends(text)
        if not self.triggers(split_words(text)):
            return []
        out = []
        for clause in _CLAUSE.split(text):
            ws = split_words(clause)
            if self.triggers(ws):
                out += self.match_clause(ws)
        times = Counter(p for p, _ in out)
        return [m for m in out if times[m[0]] >= self.least[m[0]]]


@dataclass
class ToxicityModel:
    grammar: Grammar
    weights: list[float]
    bias: float
    slope: float

    def evidence(self, matches: list[tuple[int, float]]) -> float:
        return sum(self.weights[w] * f for w, f in matches)

    def score(self, matches: list[tuple[int, float]]) -> float:
        """Probability of label 1; evidence counts on a logarithmic scale."""
        z = self.bias + self.slope * np.log1p(self.evidence(matches))
        return float(1.0 / (1.0 + np.exp(-z)))


def beginnings(text: bytes) -> set[str]:
    """Candidate patterns of a text: ``k`` and a word beginning that occurs k times or more."""
    words = Counter(split_words(text))
    times: Counter[str] = Counter()
    for w, n in words.items():
        word = w.decode("utf-8", "ignore")
        for chars in PATTERN_CHARS:
            if len(word) >= chars:
                times[word[:chars]] += n
    return {f"{k}{p}" for p, n in times.items() for k in REPEATS if n >= k}


def _count(rows: DataFrame, label: int, grammar: Grammar, wanted: frozenset[str] | None, lists: bool = False) -> DataFrame:
    """(pattern, n): in how many documents of a label each beginning occurs; of
    toxic ones only those that the grammar does not explain. With ``lists``:
    (doc_id, patterns) instead."""
    shared = rows.sparkSession.sparkContext.broadcast((grammar, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, only = shared.value
        seen: Counter[str] = Counter()
        for batch in batches:
            docs, found = [], []
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                text = with_line_ends(text)
                if label and known.triggers(split_words(text)):
                    continue
                got = beginnings(text)
                got = got if only is None else got & only
                if lists:
                    docs.append(doc)
                    found.append(sorted(got))
                else:
                    seen.update(got)
            if lists:
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.list_(pa.string()))],
                                                 ["doc_id", "patterns"])
        if not lists:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                             ["pattern", "n"])

    part = rows.where(F.col("toxic") == label).select("doc_id", "text")
    if lists:
        return part.mapInArrow(run, "doc_id long, patterns array<string>")
    return part.mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def learn_patterns(rows: DataFrame) -> tuple[tuple[bytes, int], ...]:
    """Cover the unexplained toxic rows of the sample by pure patterns. Every
    beginning with MIN_SUPPORT is a candidate; the sample's bound on rows bounds them."""
    grammar = Grammar()
    toxic = {r.pattern: r.n for r in _count(rows, 1, grammar, None).where(F.col("n") >= MIN_SUPPORT).collect()}
    if not toxic:
        return ()
    clean = {r.pattern: r.n for r in _count(rows, 0, grammar, frozenset(toxic)).collect()}
    pure = frozenset(p for p, n in toxic.items() if clean.get(p, 0) <= IMPURITY * n)
    left = {r.doc_id: set(r.patterns) for r in _count(rows, 1, grammar, pure, lists=True).collect()}
    enough = max(MIN_SUPPORT, MIN_SHARE * len(left))
    chosen: dict[str, int] = {}
    while left:
        cover = Counter(p for ps in left.values() for p in ps)
        if not cover:
            break
        best = max(cover, key=lambda p: (cover[p] - clean.get(p, 0) / IMPURITY / 2, len(p), p))
        if cover[best] < enough:
            break
        chosen[best[1:]] = min(int(best[0]), chosen.get(best[1:], 9))
        left = {d: ps for d, ps in left.items() if best not in ps}
    return tuple((p.encode(), k) for p, k in chosen.items())


def labelled_sample(docs: DataFrame, labels: DataFrame, hold_out: bool = True, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, text, toxic) of a bounded sample of labelled documents, the same
    in every run. The sample's ids are broadcast: ``max_labelled`` rows at most."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
    if hold_out:
        lab = lab.where(F.pmod(id_crc(F.col("doc_id")), F.lit(5)) != 0)
    sample = lab.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    return id_and_text(docs).join(F.broadcast(sample), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, hold_out: bool = True, max_labelled: int = MAX_LABELLED) -> ToxicityModel:
    """Learn patterns, their weights and the two constants from ``labels.toxic``;
    with ``hold_out``, rows whose crc32(doc_id) mod 5 is 0 are not looked at. Null
    labels and labels of unknown documents are ignored; without any label the
    prior weights hold."""
    rows = materialise(labelled_sample(docs, labels, hold_out, max_labelled))
    grammar = Grammar(learn_patterns(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [grammar.match_text(t) for t in text_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays([
                batch.column(1), pa.array([[w for w, _ in g] for g in got], pa.list_(pa.int32())),
                pa.array([[f for _, f in g] for g in got], pa.list_(pa.float64()))], ["toxic", "patterns", "factors"])

    got = rows.select("text", "toxic").mapInArrow(run, "toxic int, patterns array<int>, factors array<double>").collect()
    hits, toxic = np.zeros(grammar.size), np.zeros(grammar.size)
    for r in got:
        for w in set(r.patterns):
            hits[w] += 1
            toxic[w] += r.toxic
    # Rate of label 1 among the documents with the pattern, drawn towards 0.9 where few are known.
    rate = (toxic + 0.9 * 4) / (hits + 4)
    model = ToxicityModel(grammar, np.clip(np.log(rate / (1 - rate)), 0.25, 4.0).tolist(), -3.0, 4.0)
    if got:
        x = np.log1p([model.evidence(list(zip(r.patterns, r.factors, strict=True))) for r in got])
        model.bias, model.slope = _logistic(x, np.array([r.toxic for r in got], float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps with a prior towards (-3, 4), which keeps the slope finite
    and positive however few rows carry a match."""
    prior, pull = np.array([-3.0, 4.0]), np.array([0.5, 0.5])
    b = prior.copy()
    a = np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a @ b)))
        grad = a.T @ (p - y) + pull * (b - prior)
        hess = (a * (p * (1 - p))[:, None]).T @ a + np.diag(pull)
        step = np.linalg.solve(hess, grad)
        b -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(max(b[1], 0.1))


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per document: ``doc_id, score, predicted, n_matches, evidence``.
    Null and empty texts have no clause and get the base score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.grammar.match_text(t) for t in text_bytes(batch.column(1))]
            score = [model.score(g) for g in got]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32()),
                pa.array([len(g) for g in got], pa.int32()), pa.array([float(model.evidence(g)) for g in got], pa.float64())],
                ["doc_id", "score", "predicted", "n_matches", "evidence"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double, predicted int, n_matches int, evidence double")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The rows whose score is below 0.5, with all their columns, in place."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                keep = [model.score(model.grammar.match_text(t)) < 0.5 for t in text_bytes(part.column(at))]
                yield part.filter(pa.array(keep, pa.bool_()))

    return map_in_place(docs, run)
