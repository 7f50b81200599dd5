"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

1. Labelled rows (those outside the held-out third) are the training set; at most about
   ``TRAIN_ROWS`` of them, drawn by a hash of the id, so the fit is bounded whatever the
   corpus.  Equal texts and near copies (groups of ``minhash``, confirmed at 0.75) of one label
   count once, else the rare words of a text that is copied a few times would pass for terms.
2. Lexicon: words that are far more frequent in toxic training texts than in others,
   and word beginnings with several such continuations, which stand for all of them.
3. Matching: the automaton of all words within one edit of a text word is intersected with
   the trie of the lexicon, so misspelled terms (of five letters or more) are found
   without comparing a word with every term.  Words whose first and last half both
   differ from those of every term are more than one edit away and are skipped.
4. Context: a hit is read with the words around it.  Hits in quotation marks or after a
   reporting word are kept apart from plain ones, and hits close together are counted
   as such.  A logistic regression over these counts gives the score.

Texts are read whole; a score depends on the text alone.

Nulls and edges: null, empty and blank texts have no hits and get the score of a text
without hits; rows with a null id or without a label are scored, not learned from;
an id labelled twice is toxic if one label says so; repeated rows score alike; without
both classes in the training rows every score is 0; an empty table gives an empty
result; further columns are ignored.
"""

import math
import re
from collections.abc import Iterable, Iterator

import clickmart.llm
import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart.llm import minhash
from clickmart.llm.common import materialize


# workers need not have the package on their path
cloudpickle.register_pickle_by_value(clickmart.llm)

TRAIN_ROWS = 20_000
MAX_TERMS = 4_096
MIN_DOCS, MIN_SHARE = 3, 0.004
MIN_LOG_ODDS = 3.0
FUZZY_LENGTH = 5
#: lengths of word beginnings, and continuations in toxic texts that one must have
STEMS, ENDINGS = (4, 5, 6, 7), 4
WINDOW = 10
CUT = 0.7
MEMO = 200_000
EDGE = " \t.,;:!?|()[]{}<>*#$%&\"'“”„«»‘’…-"
#: the same characters as a pattern, and the ASCII blanks
_CUTS = "[" + "".join("\\" + c for c in EDGE) + r"\n\x0B\f\r]+"
CUTS = re.compile(_CUTS)
OPENING, CLOSING = "“„«\"‘", "”“»\"’"
#: fixed values: words that report what somebody else said
REPORTING = frozenset(
    "said says wrote writes called calls quoted quote quotes reported sagte schrieb nannte "
    "zitat dit écrit appelle citation dijo escribió llamó cita".split()
)
FEATURES = ("terms", "plain", "weight", "fuzzy", "quoted", "dense")

Lexicon = dict[str, float]


def clean_word(word: str) -> str:
    return word.strip(EDGE).lower()


def text_words(text) -> list[str]:
    return [] if text is None else re.findall(r"[^\x20\x09-\x0D]+", text)


# ---------------------------------------------------------------- automaton and trie


class LevenshteinAutomaton:
    """Accepts every string within ``edits`` of ``word``.

    A state holds, for each prefix of the word that is still within reach, the edits
    spent on it.
    """

    def __init__(self, word: str, edits: int):
        self.word, self.edits = word, edits

    def start(self) -> tuple:
        return tuple((i, i) for i in range(min(self.edits, len(self.word)) + 1))

    def step(self, state: tuple, letter: str) -> tuple:
        spent: dict[int, int] = {}
        for i, cost in state:
            if cost < self.edits:
                spent[i] = min(spent.get(i, cost + 1), cost + 1)  # a letter too many
            if i < len(self.word):
                at = cost + (self.word[i] != letter)
                if at <= self.edits:
                    spent[i + 1] = min(spent.get(i + 1, at), at)
        for i in sorted(spent):  # letters left out
            j, cost = i + 1, spent[i] + 1
            while j <= len(self.word) and cost <= self.edits and spent.get(j, cost + 1) > cost:
                spent[j] = cost
                j, cost = j + 1, cost + 1
        return tuple(sorted(spent.items()))

    def accepts(self, state: tuple) -> bool:
        return any(i == len(self.word) for i, _ in state)


def trie(terms: Iterable[str]) -> dict:
    """Nested dicts by letter; the empty string marks the end of a term."""
    root: dict = {}
    for term in terms:
        node = root
        for letter in term:
            node = node.setdefault(letter, {})
        node[""] = term
    return root


def intersect(automaton: LevenshteinAutomaton, root: dict) -> list[str]:
    """Terms of the trie that the automaton accepts."""
    found, stack = [], [(root, automaton.start())]
    while stack:
        node, state = stack.pop()
        for letter, below in node.items():
            if letter == "":
                if automaton.accepts(state):
                    found.append(below)
            else:
                after = automaton.step(state, letter)
                if after:
                    stack.append((below, after))
    return found


class Matcher:
    """Log-odds and kind (exact, stem, fuzzy) of a word's best term."""

    def __init__(self, terms: Lexicon, stems: Lexicon):
        self.terms, self.stems = terms, stems
        self.stem_lengths = sorted({len(s) for s in stems}, reverse=True)
        fuzzy = [t for t in terms if len(t) >= FUZZY_LENGTH]
        self.root = trie(fuzzy)
        self.heads = {t[: len(t) // 2] for t in fuzzy}
        self.tails = {t[len(t) // 2 :] for t in fuzzy}
        self.head_lengths = sorted({len(h) for h in self.heads})
        self.tail_lengths = sorted({len(h) for h in self.tails})
        self.memo: dict[str, tuple[str, float] | None] = {}

    def near(self, word: str) -> bool:
        """False only for words more than one edit from every term."""
        return any(word[:n] in self.heads for n in self.head_lengths) or any(
            word[-n:] in self.tails for n in self.tail_lengths
        )

    def __call__(self, word: str) -> tuple[str, float] | None:
        if word in self.memo:
            return self.memo[word]
        if len(self.memo) >= MEMO:
            self.memo.clear()
        found = self.memo[word] = self._match(word)
        return found

    def _match(self, word: str) -> tuple[str, float] | None:
        if word in self.terms:
            return "exact", self.terms[word]
        for n in self.stem_lengths:
            if word[:n] in self.stems:
                return "stem", self.stems[word[:n]]
        if len(word) >= FUZZY_LENGTH - 1 and self.near(word):
            terms = intersect(LevenshteinAutomaton(word, 1), self.root)
            if terms:
                return "fuzzy", max(self.terms[t] for t in terms)
        return self._parts(word)

    def _parts(self, word: str) -> tuple[str, float] | None:
        """The best of the parts that inner punctuation makes, as the lexicon was counted."""
        found = []
        for part in CUTS.split(word) if CUTS.search(word) else ():
            if part in self.terms:
                found.append(("exact", self.terms[part]))
            else:
                found += [("stem", self.stems[part[:n]]) for n in self.stem_lengths if part[:n] in self.stems][:1]
        return max(found, key=lambda f: f[1], default=None)


# ---------------------------------------------------------------- features


def features(text, match: Matcher) -> list[float]:
    """Counts of hits by kind and context, each on a logarithmic scale."""
    tokens = text_words(text)
    hits = []
    for at, token in enumerate(tokens):
        word = clean_word(token)
        if word:
            found = match(word)
            if found:
                hits.append((at, word, *found))
    if not hits:
        return [0.0] * len(FEATURES)
    plain = fuzzy = quoted = dense = 0
    weight, last = 0.0, -WINDOW - 1
    for at, _, kind, odds in hits:
        around = tokens[max(0, at - WINDOW) : at]
        opened = sum(t[0] in OPENING for t in [*around, tokens[at]])
        closed = sum(t[-1] in CLOSING for t in around)
        reported = any(clean_word(t) in REPORTING for t in around[-4:])
        dense += at - last <= WINDOW
        last = at
        if opened > closed or reported:
            quoted += 1
        elif kind == "fuzzy":
            fuzzy += 1
        else:
            plain += 1
            weight = max(weight, odds)
    distinct = len({w for _, w, _, _ in hits})
    return [*map(math.log1p, (distinct, plain, weight, fuzzy, quoted, dense))]


# ---------------------------------------------------------------- learning


def held_out(doc_id: Column) -> Column:
    third = F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 3 == 1
    return F.coalesce(third, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic of the drawn training rows, near copies of one label once; written."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = materialize(known, "toxic-labels")
    share = min(1.0, TRAIN_ROWS / max(1, known.count()))
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(77)), 11) / F.lit(float(2**53))
    # about TRAIN_ROWS ids of 8 bytes: bounded by the parameter
    drawn = known.filter(draw < share).withColumnRenamed("doc_id", "label_id")
    rows = docs.select("doc_id", "text").join(
        F.broadcast(drawn), F.col("doc_id") == F.col("label_id")
    )
    once = rows.select("text", "toxic").distinct()
    once = materialize(once.withColumn("row", F.monotonically_increasing_id()), "toxic-drawn")
    groups = minhash.group(once.select(F.col("row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("row"), F.col("component_id").alias("component"))
    return materialize(
        once.join(groups, "row")
        .groupBy("component", "toxic")
        .agg(F.min_by("text", F.md5("text")).alias("text"))
        .select("text", "toxic"),
        "toxic-train",
    )


def _counts(train: DataFrame) -> DataFrame:
    """term, stem, bad, good: texts of each class that hold a word; a stem adds up its words."""
    toxic = F.col("toxic") == 1
    own = F.array_distinct(F.split(F.lower("text"), _CUTS))
    held = train.select(toxic.alias("toxic"), F.explode(own).alias("term")).filter(
        F.length("term") > 2
    )
    counted = held.groupBy("term").agg(
        F.count(F.when(F.col("toxic"), 1)).alias("bad"), F.count(F.when(~F.col("toxic"), 1)).alias("good")
    )
    stems = F.transform(
        F.filter(F.array(*[F.lit(n) for n in STEMS]), lambda n: n < F.length("term")),
        lambda n: F.substring(F.col("term"), F.lit(1), n),
    )
    by_stem = (
        counted.select(F.explode(stems).alias("term"), "bad", "good")
        .groupBy("term")
        .agg(
            F.sum("bad").alias("bad"), F.sum("good").alias("good"),
            F.count(F.when(F.col("bad") > 0, 1)).alias("endings"),
        )
        .filter(F.col("endings") >= ENDINGS)
        .drop("endings")
    )
    return counted.withColumn("stem", F.lit(False)).unionByName(by_stem.withColumn("stem", F.lit(True)))


def lexicon(train: DataFrame) -> tuple[Lexicon, Lexicon]:
    """Terms and stems with their log-odds, the most frequent ``MAX_TERMS`` of each."""
    toxic = F.col("toxic") == 1
    sizes = train.agg(
        F.count(F.when(toxic, 1)).alias("bad"), F.count(F.when(~toxic, 1)).alias("good")
    ).first()
    if not sizes.bad or not sizes.good:
        return {}, {}
    least = max(MIN_DOCS, math.ceil(MIN_SHARE * sizes.bad))
    counts = _counts(train)
    odds = F.log(
        (F.col("bad") + 0.5) / (sizes.bad + 1) / ((F.col("good") + 0.5) / (sizes.good + 1))
    )
    chosen = materialize(
        counts.withColumn("odds", odds).filter(
            (F.col("bad") >= least) & (F.col("odds") >= MIN_LOG_ODDS) & (F.col("bad") >= 4 * F.col("good"))
        ),
        "toxic-terms",
    )
    found = []
    for stem in (False, True):
        rows = (
            chosen.filter(F.col("stem") == stem)
            .orderBy(F.desc("bad"), F.desc("odds"), "term")
            .limit(MAX_TERMS)
            .collect()
        )
        found.append({r.term: r.odds for r in rows})
    return found[0], found[1]


def _feature_rows(terms: Lexicon, stems: Lexicon):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        match = Matcher(terms, stems)
        for batch in batches:
            yield pd.DataFrame(
                {"x": [features(t, match) for t in batch["text"]], "toxic": batch["toxic"].astype(float)}
            )

    return run


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Lexicon, Lexicon, list[float], float]:
    """Lexicon, stems, coefficients and intercept."""
    train = training_rows(docs, labels)
    terms, stems = lexicon(train)
    if not terms and not stems:
        return terms, stems, [0.0] * len(FEATURES), -1e9
    rows = materialize(
        train.mapInPandas(_feature_rows(terms, stems), "x array<double>, toxic double"), "toxic-features"
    )
    model = LogisticRegression(
        featuresCol="vector", labelCol="toxic", regParam=1e-4, maxIter=40
    ).fit(rows.withColumn("vector", array_to_vector("x")))
    return terms, stems, [float(c) for c in model.coefficients], float(model.intercept)


def _scores(terms: Lexicon, stems: Lexicon, coefficients: list[float], intercept: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        match, w = Matcher(terms, stems), np.array(coefficients)
        for batch in batches:
            x = np.array([features(t, match) for t in batch["text"]]).reshape(-1, len(w))
            z = np.clip(x @ w + intercept, -700, 700)
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "score": 1.0 / (1.0 + np.exp(-z))}
            )

    return run


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInPandas(_scores(*model), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
