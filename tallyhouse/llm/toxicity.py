"""Toxicity by a lexicon, its misspellings and the words around them.

The lexicon is learned from labelled rows: words that toxic documents have far more often than others are candidates, and a
sparse logistic regression keeps those that explain labels which no other word explains, so that words that merely occur in copies of a
toxic text go. Misspelled terms are found by Levenshtein automata over the lexicon's trie (:mod:`automaton`); a form that
occurs in clean labelled rows is a word of its own and not taken for a misspelling. Each hit is weighed by the window around it:
quotation marks, words of reporting and of address, and words learned from windows of both labels where there are enough. What is left as
abuse, exact and misspelled, and what counts as quoted become a probability by a logistic curve, fitted to labelled rows that the lexicon
has not seen; the lexicon that scores is then learned from all of them. Documents are scored where they lie.

Labels are learned only from rows whose CRC-32 of doc_id mod 4 is not 2, and from a sample of them: ``sample_rows`` distinct texts
per label, in expectation, drawn by a hash of doc_id at a rate that one count gives. Bounds: ``CANDIDATES`` words, ``TERMS`` terms, ``FORMS`` clean
forms, ``CONTEXT_WORDS`` words of windows, ``ROW_WORDS`` candidates per row of the regression.

Defined results: a null or empty text has no hits; a null doc_id is neither held out nor learned from; a doc_id with several labels is toxic if
one of them says so; repeated rows are scored alike; without labelled rows of both kinds the score is the share of label 1, or 0.5; an
empty table gives no rows. Columns other than doc_id, text and toxic are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.automaton import Lexicon
from tallyhouse.llm.common import Stages, read

FOLDS, HELD_OUT, CURVE_PART = 4, 2, 3
SAMPLE_ROWS = 20_000
CANDIDATES = 20_000
TERMS = 5_000
FORMS = 50_000
CONTEXT_WORDS = 5_000
ROW_WORDS = 50
LEAST_ROWS = 2  # toxic rows that a candidate occurs in
LEAST_RATIO = 4.0  # how much more often than in clean rows
LEAST_WEIGHT = 0.3
SPARSITY = 0.3
WINDOW = 6
LEAST_CLEAN_HITS = 50  # of windows to learn from
LEAST_SURPRISE = 3.0  # standard errors by which a word of windows must differ between labels
LEARNED_AT_MOST = 2.0
THRESHOLD = 0.3
_CACHED = 200_000
_LONGEST = 64

# Signs and words by which a hit is taken for reported or addressed.
_OPENS = frozenset("\"'`«»‹›“”„‟‘’‚")
REPORTING = frozenset(
    "said says say called calls calling wrote writes word words term terms phrase quote quoted quotes insult insults slur means meaning "
    "sagte sagt nannte genannt schrieb wort begriff zitat zitierte beleidigung heißt bedeutet "
    "dit disait appelé appelle écrit mot terme citation cité insulte signifie "
    "dijo dice llamó llamado escribió palabra término cita citó insulto significa".split())
ADDRESS = frozenset("you your you're u du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes tus".split())
QUOTED_BY_MARKS, QUOTED_BY_WORD, QUOTED_BY_ADDRESS, QUOTED_FROM = 3.0, 1.5, -1.5, 3.0

_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»‹›“”„‟‘’‚…–—¡¿·•"
_PIECES = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    """Lower-case words between white space without signs at their edges."""
    return [word.strip(_EDGES) for word in text.lower().split()]


def distinct_words(text: str) -> set[str]:
    found = set(words_of(text))
    found.discard("")
    return found


def _marked(raw: list[str], place: int) -> bool:
    """Whether a quotation opened at or before the place ends at or after it, all within the window."""
    opened = False
    for word in raw[:place]:
        opened = (opened or word.lstrip("([")[:1] in _OPENS) and not _closes(word)
    opened = opened or raw[place].lstrip("([")[:1] in _OPENS
    return opened and any(_closes(word) for word in raw[place:])


def _closes(word: str) -> bool:
    return len(word) > 1 and word.rstrip(".,;:!?)]")[-1:] in _OPENS


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    clean_forms: frozenset[str] = frozenset()
    context: dict[str, float] = field(default_factory=dict)
    curve: np.ndarray = field(default_factory=lambda: np.zeros(4))


class Finder:
    """Hits of a text, with what was found for a word remembered."""

    def __init__(self, model: Model):
        self._model, self._lexicon = model, Lexicon(model.terms)
        self._exact = {term: i for i, term in enumerate(model.terms)}
        self._known: dict[str, tuple[int, int] | None] = {}

    def _of_piece(self, word: str) -> tuple[int, int] | None:
        if word in self._exact:
            return 0, self._exact[word]
        return None if len(word) > _LONGEST or word in self._model.clean_forms else self._lexicon.find(word)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of a word, or of the best of its pieces."""
        if word not in self._known:
            if len(self._known) >= _CACHED:
                self._known.clear()
            found = [self._of_piece(word)]
            if not word.isalnum() and len(word) <= 4 * _LONGEST:
                found += map(self._of_piece, _PIECES.findall(word))
            self._known[word] = min((f for f in found if f), default=None)
        return self._known[word]

    def hits(self, text: str) -> list[tuple[str, int, int, list[str], bool]]:
        """(form, edits, term, window around it, inside quotation marks) of each hit."""
        words = words_of(text)
        found = {word: match for word in set(words) if word and (match := self.match(word))}
        if not found:
            return []
        raw, out = text.split(), []
        for i, word in enumerate(words):
            if word in found:
                low, high = max(0, i - WINDOW), i + WINDOW + 1
                out.append((word, *found[word], words[low:i] + words[i + 1 : high], _marked(raw[low:high], i - low)))
        return out

    def quoted(self, window: list[str], marked: bool) -> float:
        """How likely a hit in the window is reported, not meant: 0 to 1."""
        score = QUOTED_BY_MARKS * marked
        score += QUOTED_BY_WORD * any(w in REPORTING for w in window) + QUOTED_BY_ADDRESS * any(w in ADDRESS for w in window)
        score += float(np.clip(sum(self._model.context.get(w, 0.0) for w in window), -LEARNED_AT_MOST, LEARNED_AT_MOST))
        return float(1 / (1 + np.exp(QUOTED_FROM - np.clip(score, -20, 20))))

    def features(self, text: str) -> tuple[float, float, float]:
        """Weight of the terms meant, of those met only misspelled, and of those quoted."""
        meant: dict[int, float] = {}
        misspelled: dict[int, float] = {}
        quoted: dict[int, float] = {}
        for _, edits, term, window, marked in self.hits(text):
            share = self.quoted(window, marked)
            kind = misspelled if edits else meant
            kind[term] = max(kind.get(term, 0.0), 1 - share)
            quoted[term] = max(quoted.get(term, 0.0), share)
        for term in meant:
            misspelled.pop(term, None)
        weights = self._model.weights
        return tuple(float(np.log1p(sum(weights[t] * x for t, x in kind.items()))) for kind in (meant, misspelled, quoted))


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def labelled_sample(documents: DataFrame, labels: DataFrame, sample_rows: int) -> tuple[DataFrame, float]:
    """Distinct (part, toxic, text) of learnable rows, and the log of how much denser toxic rows were drawn than clean ones."""
    ids = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & (remainder(F.col("id")) != HELD_OUT)).groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {row["toxic"]: row["n"] for row in ids.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rates = {label: min(1.0, sample_rows / max(counts.get(label, 0), 1)) for label in (0, 1)}
    grain = 1_000_000
    drawn = F.pmod(F.xxhash64("id"), F.lit(grain)) < F.when(F.col("toxic") == 1, rates[1] * grain).otherwise(rates[0] * grain)
    texts = documents.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # The ids drawn are about twice sample_rows, whatever the number of documents.
    rows = texts.join(F.broadcast(ids.filter(drawn)), "id").select(
        remainder(F.col("id")).cast("int").alias("part"), "toxic", "text", F.xxhash64("text").alias("th"))
    return rows.dropDuplicates(["toxic", "th"]).drop("th"), float(np.log(rates[1] / rates[0]))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many clean and toxic rows of a batch each word occurs."""
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            counts[toxic].update(word for word in distinct_words(text) if len(word) <= _LONGEST)
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *[pa.array([count[w] for w in words], pa.int64()) for count in counts]], ["word", "clean", "bad"])


def _candidate_rows(batches: Iterator[pa.RecordBatch], candidates) -> Iterator[pa.RecordBatch]:
    """Per row its label and its first candidates, in the order of the list."""
    places = {word: i for i, word in enumerate(candidates.value)}
    for batch in batches:
        found = [sorted(places[w] for w in distinct_words(text) if w in places)[:ROW_WORDS] for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], ["toxic", "found"])


def sparse_weights(rows: list[tuple[int, list[int]]], size: int, sparsity: float = SPARSITY, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic regression on which candidates a row has, most of them zero; none is negative."""
    labels = np.array([label for label, _ in rows], float)
    counts = np.array([len(found) for _, found in rows], np.int64)
    row = np.repeat(np.arange(len(rows)), counts)
    column = np.concatenate([np.array(found, np.int64) for _, found in rows]) if rows else np.zeros(0, np.int64)
    # A bound of the curvature along each weight gives its step.
    curve = 0.25 * np.bincount(column, (counts + 1)[row], size) + 1e-9
    own = 0.25 * (counts + 1).sum() + 1e-9
    weights, ahead, base, base_ahead, speed = np.zeros(size), np.zeros(size), 0.0, 0.0, 1.0
    for _ in range(rounds):
        margin = base_ahead + np.bincount(row, ahead[column], len(rows))
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels
        following = np.maximum(ahead - (np.bincount(column, error[row], size) + sparsity) / curve, 0)
        base_following = base_ahead - error.sum() / own
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        push = (speed - 1) / faster
        ahead, base_ahead = following + push * (following - weights), base_following + push * (base_following - base)
        weights, base, speed = following, base_following, faster
    return weights


def _forms_and_windows(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Misspelling-like forms of clean rows, and the words around hits by label."""
    finder = Finder(model.value)
    for batch in batches:
        counts: Counter = Counter()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            for form, edits, term, window, _ in finder.hits(text):
                if edits and not toxic:
                    counts["form", form, 0] += 1
                elif not edits and model.value.weights[term] >= 1:
                    counts["hit", "", toxic] += 1
                    counts.update(("window", w, toxic) for w in set(window) if 0 < len(w) <= _LONGEST)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in counts], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32()))]
            + [pa.array(list(counts.values()), pa.int64())], ["kind", "word", "toxic", "n"])


def learn(rows: DataFrame) -> Model:
    """Lexicon, clean forms and words of windows from (toxic, text)."""
    context = rows.sparkSession.sparkContext
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, bad = totals.get(0, 0), totals.get(1, 0)
    if not clean or not bad:
        return Model()
    ratio = (F.col("bad") / bad) / ((F.col("clean") + 0.5) / clean)
    surprise = F.log(ratio) / F.sqrt(1 / F.col("bad") + 1 / (F.col("clean") + 0.5))
    words = rows.mapInArrow(_word_rows, "word string, clean long, bad long").groupBy("word").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    found = words.filter((F.col("bad") >= LEAST_ROWS) & (ratio >= LEAST_RATIO)).orderBy(surprise.desc(), "word").limit(CANDIDATES)
    candidates = [r["word"] for r in found.select("word").collect()]
    if not candidates:
        return Model()
    listed = rows.mapInArrow(partial(_candidate_rows, candidates=context.broadcast(candidates)), "toxic int, found array<int>")
    weights = sparse_weights([(r["toxic"], r["found"]) for r in listed.toArrow().to_pylist()], len(candidates))
    best = [i for i in np.argsort(-weights, kind="stable")[:TERMS] if weights[i] >= LEAST_WEIGHT]
    model = Model([candidates[i] for i in best], [float(weights[i]) for i in best])
    counts = rows.mapInArrow(partial(_forms_and_windows, model=context.broadcast(model)), "kind string, word string, toxic int, n long").groupBy(
        "kind", "word").agg(F.expr("sum(if(toxic = 0, n, 0)) as clean"), F.expr("sum(if(toxic = 1, n, 0)) as bad"))
    forms = counts.filter("kind = 'form'").orderBy(F.desc("clean"), "word").limit(FORMS)
    model.clean_forms = frozenset(r["word"] for r in forms.select("word").collect())
    hits = counts.filter("kind = 'hit'").collect()
    if hits and min(hits[0]["clean"], hits[0]["bad"]) >= LEAST_CLEAN_HITS:
        n_clean, n_bad = hits[0]["clean"], hits[0]["bad"]
        odds = F.log((F.col("clean") + 0.5) / n_clean) - F.log((F.col("bad") + 0.5) / n_bad)
        surprise = F.abs(odds) / F.sqrt(1 / (F.col("clean") + 0.5) + 1 / (F.col("bad") + 0.5))
        windows = counts.filter((F.col("kind") == "window") & (surprise > LEAST_SURPRISE)).orderBy(surprise.desc(), "word").limit(CONTEXT_WORDS)
        model.context = {r["word"]: float(np.clip(r["odds"], -1, 1)) for r in windows.select("word", odds.alias("odds")).collect()}
    return model


def _features(batches: Iterator[pa.RecordBatch], model, keep: str) -> Iterator[pa.RecordBatch]:
    finder = Finder(model.value)
    for batch in batches:
        found = np.array([finder.features(text.as_py() or "") for text in batch.column("text")], float).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [batch.column(keep), *[pa.array(np.ascontiguousarray(found[:, i])) for i in range(3)]], [keep, "meant", "misspelled", "quoted"])


# Where no labelled row says otherwise, a misspelled term counts nearly as the term and a quoted one hardly.
_AS_MEANT = np.array([1.0, 0.8, 0.05])
_PRIOR = np.array([0.0, 2.0, 0.0, 0.0])
_PULL = np.diag([1e-2, 1.0, 1.0, 1.0])


def fit_curve(points: np.ndarray, labels: np.ndarray, denser: float) -> np.ndarray:
    """Weights of 1, meant, misspelled and quoted; ``denser`` takes the sampling out again.

    Fitted are the weight of what is meant, on all three by their shares of it, and what misspelled and quoted terms depart from that.
    """
    if len(set(labels.tolist())) < 2:
        share = min(max(float(labels.mean()), 1e-3), 1 - 1e-3) if len(labels) else 0.5
        return np.array([np.log(share / (1 - share)), 0.0, 0.0, 0.0])
    x, weights = np.c_[np.ones(len(points)), points @ _AS_MEANT, points[:, 1:]], _PRIOR.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - labels) + _PULL @ (weights - _PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + _PULL, slope)
        weights = weights - step * min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
    of_kinds = np.maximum(weights[1] * _AS_MEANT + np.array([0.0, *weights[2:]]), 0)
    return np.array([weights[0] - denser, *of_kinds])


def train(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    sample, denser = labelled_sample(documents, labels, sample_rows)
    rows = Stages(documents.sparkSession).keep(sample)
    seen = learn(rows.filter(F.col("part") != CURVE_PART))
    held = documents.sparkSession.sparkContext.broadcast(seen)
    points = rows.filter(F.col("part") == CURVE_PART).mapInArrow(
        partial(_features, model=held, keep="toxic"), "toxic int, meant double, misspelled double, quoted double").toArrow()
    if not points.num_rows:
        points = rows.mapInArrow(
            partial(_features, model=held, keep="toxic"), "toxic int, meant double, misspelled double, quoted double").toArrow()
    features = np.stack([points.column(name).to_numpy() for name in ("meant", "misspelled", "quoted")], axis=1)
    model = learn(rows)
    model.curve = fit_curve(features, points.column("toxic").to_numpy().astype(float), denser)
    return model


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, meant, misspelled, quoted, score."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(partial(_features, model=documents.sparkSession.sparkContext.broadcast(model), keep="doc_id"),
                            "doc_id long, meant double, misspelled double, quoted double")
    z = F.lit(float(model.curve[0]))
    for name, weight in zip(("meant", "misspelled", "quoted"), model.curve[1:], strict=True):
        z = z + F.col(name) * float(weight)
    return found.withColumn("score", 1 / (1 + F.exp(-z)))


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return score(documents, train(documents, read(spark, sf_dir, "labels"))).select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
