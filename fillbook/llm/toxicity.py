"""Operator 5, toxicity: a counterfactual-regularised word classifier.

A logistic model over the distinct words of a text and their first 4 and 5
letters (which catch inflected and compound forms). It is learned from a
bounded, seeded sample of labelled rows (``SAMPLE`` documents): Spark counts
the sample's words by label and keeps the ``FEATURES`` most telling ones (and
every term to swap), then numpy fits the weights. For each labelled sentence
that mentions such a term the term is swapped for others of its group, and
the squared change of the score is part of the loss, so that a neutral mention
of a group cannot carry the score. Terms to swap are the fixed identity terms
and terms found in the sample: words that stand in documents of both labels, in
most of them without being toxic, and that keep the same company as others
(alike counts of the frequent words before and after them). All texts are then scored whole inside
``mapInArrow`` tasks.

Defined results: a null text counts as empty and gets the score of no words;
without labelled rows every score is 0; several labels of one document count
as the highest; rows without doc_id are never learned from and count as held
out; repeated rows get equal scores; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import register, seeded_sample, table, write_read
from fillbook.llm.langid import held_out

#: The bound of the training sample, and of the features kept.
SAMPLE = 12_000
FEATURES = 512
MIN_DOCS = 3
SWAPS = 3
#: Found terms to swap: at most so many, each in no larger share of the sample's
#: documents, with neighbours counted over so many frequent words, and so alike.
TERMS = 64
TERM_SHARE = 0.1
CONTEXTS = 128
ALIKE = 0.8
CF_WEIGHT = 1.0
L2 = 1e-4
STEPS = 400
SEED = 11
THRESHOLD = 0.3

#: Groups of identity terms that may stand for one another.
IDENTITY = (
    "women men girls boys woman man girl boy frauen männer mädchen jungen femmes hommes filles garçons mujeres hombres niñas niños",
    "christian muslim jewish hindu buddhist atheist christen muslime juden chrétien musulman juif cristiano musulmán judío",
    "black white asian latino arab african european schwarze weiße noir blanc negro blanco",
    "gay lesbian straight bisexual transgender queer homosexuell lesbisch homosexuel lesbienne homosexual lesbiana",
    "immigrant refugee foreigner citizen ausländer flüchtling immigré réfugié étranger inmigrante refugiado extranjero",
    "young old disabled blind deaf behindert aveugle sourd ciego sordo",
)
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def identity_groups() -> dict[str, tuple[str, ...]]:
    """Each identity term with the terms that may replace it."""
    groups = [g.split() for g in IDENTITY]
    return {w: tuple(x for x in g if x != w) for g in groups for w in g}


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features_of(words: set[str]) -> set[str]:
    """The words and, marked with a star, their beginnings."""
    return words.union([w[:4] + "*" for w in words], [w[:5] + "*" for w in words])


def counterfactuals(text: str, swaps: int = SWAPS, groups: dict[str, tuple[str, ...]] | None = None) -> list[tuple[set[str], set[str]]]:
    """(features gone, features come) of seeded swaps, one sentence at a time.

    One pass over the text: a swap changes only features of the two terms, and
    which of them other words of the text hold as well is counted once.
    """
    groups, out = identity_groups() if groups is None else groups, []
    low = text.lower()
    words = set(_WORD.findall(low))
    if groups.keys().isdisjoint(words):
        return []
    sentences = [set(_WORD.findall(s)) for s in _SENTENCE.split(low)]
    uses = Counter(w for s in sentences for w in s & groups.keys())
    holders = Counter(f for w in words for f in features_of({w}))
    for n, s in enumerate(sentences):
        for w in sorted(s & groups.keys()):
            others = groups[w]
            first = zlib.crc32(f"{w} {n}".encode()) % len(others)
            for i in range(min(swaps, len(others))):
                new = features_of({others[(first + i) % len(others)]})
                alone = {f for f in features_of({w}) if holders[f] == 1} if uses[w] == 1 else set()
                out.append((alone - new, {f for f in new if not holders[f]}))
    return out


def fit(rows: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]], n: int,
        cf_weight: float = CF_WEIGHT, times: list[int] | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept for documents given as lists of word numbers.

    Minimises log loss + L2 + ``cf_weight`` * mean squared score change over
    ``pairs`` (word numbers gone and come in a counterfactual copy), each of
    which counts ``times`` times.
    """
    share = np.array(times if times is not None else [1] * len(pairs), float)
    share /= max(share.sum(), 1.0)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate([np.array(r, np.int64) for r in rows]) if len(doc) else np.zeros(0, np.int64)
    gone = [(i, c, -1.0) for i, (a, _) in enumerate(pairs) for c in a]
    come = [(i, c, 1.0) for i, (_, b) in enumerate(pairs) for c in b]
    pi, pc, ps = (np.array(v) for v in zip(*(gone + come), strict=True)) if gone or come else (np.zeros(0, int),) * 3
    w, rate = np.zeros(n + 1), min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    w[n] = np.log(rate / (1 - rate))
    m1, m2 = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(doc, w[col], minlength=len(rows)) + w[n]
        r = 1 / (1 + np.exp(-z)) - y
        g = np.append(np.bincount(col, r[doc], minlength=n), r.sum()) / len(rows)
        g[:n] += L2 * w[:n]
        if len(pi):
            change = np.bincount(pi, ps * w[pc], minlength=len(pairs))
            g[:n] += 2 * cf_weight * np.bincount(pc, ps * (share * change)[pi], minlength=n)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w -= 0.05 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-9)
    return w[:n], float(w[n])


def _words_batch(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        words = [sorted(features_of(words_of(t))) for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.list_(pa.string()))], names=["id", "toxic", "words"])


def _swaps_batch(groups: dict[str, tuple[str, ...]]):
    """Distinct (gone, come) pairs of a batch and how often they occur."""
    def run(batches):
        for b in batches:
            seen = Counter((tuple(sorted(a)), tuple(sorted(c))) for t in b.column(0).to_pylist() if t for a, c in counterfactuals(t, groups=groups))
            text = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([list(a) for a, _ in seen], text), pa.array([list(c) for _, c in seen], text),
                                              pa.array(list(seen.values()), pa.int64())], names=["gone", "come", "times"])
    return run


def _company_batch(terms: set[str], frequent: set[str]):
    """How often each term of a batch has each frequent word before ("<") or after (">") it in a sentence."""
    def run(batches):
        for b in batches:
            seen = Counter()
            for t in b.column(0).to_pylist():
                for sentence in _SENTENCE.split(t.lower()) if t else ():
                    words = _WORD.findall(sentence)
                    for v, w in zip(words, words[1:], strict=False):
                        if w in terms and v in frequent:
                            seen[w, "<" + v] += 1
                        if v in terms and w in frequent:
                            seen[v, ">" + w] += 1
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in seen], pa.string()), pa.array([x for _, x in seen], pa.string()),
                                              pa.array(list(seen.values()), pa.int64())], names=["term", "near", "times"])
    return run


def alike_terms(company: list[tuple[str, str, int]], swaps: int = SWAPS, alike: float = ALIKE) -> dict[str, tuple[str, ...]]:
    """Each term with the terms of most alike company: the Bhattacharyya
    coefficient of two terms' neighbour counts, ``alike`` at least."""
    terms, near = sorted({x[0] for x in company}), sorted({x[1] for x in company})
    if not terms:
        return {}
    row, col = {t: i for i, t in enumerate(terms)}, {c: i for i, c in enumerate(near)}
    share = np.zeros((len(terms), len(near)))
    for t, c, n in company:
        share[row[t], col[c]] += n
    share = np.sqrt(share / share.sum(1, keepdims=True))
    like = np.round(share @ share.T, 9)
    out = {}
    for i, t in enumerate(terms):
        best = sorted((-like[i, j], o) for j, o in enumerate(terms) if j != i and like[i, j] >= alike)[:swaps]
        if best:
            out[t] = tuple(o for _, o in best)
    return out


def found_groups(texts: DataFrame, seen: DataFrame, total: int, terms: int = TERMS) -> dict[str, tuple[str, ...]]:
    """Terms to swap from the sample itself: ``texts`` (text), ``seen`` (w, n, t:
    documents and toxic documents that hold w). At most ``terms`` terms and
    ``2 * CONTEXTS`` neighbour counts for each reach the driver."""
    word = seen.where(~F.col("w").endswith("*"))
    both = (F.col("t") > 0) & (2 * F.col("t") < F.col("n")) & (F.col("n") >= MIN_DOCS) & (F.col("n") <= TERM_SHARE * total)
    fixed = identity_groups()
    chosen = word.where(both & ~F.col("w").isin(*fixed)).orderBy(F.col("n").desc(), "w").limit(terms).select("w").collect()
    frequent = word.orderBy(F.col("n").desc(), "w").limit(CONTEXTS).select("w").collect()
    near = texts.select("text").mapInArrow(_company_batch({x.w for x in chosen}, {x.w for x in frequent}), "term string, near string, times bigint")
    return alike_terms([tuple(x) for x in near.groupBy("term", "near").agg(F.sum("times").alias("times")).collect()])


class ToxicityModel:
    """Word weights and intercept; the terms swapped and how many distinct pairs they gave."""

    def __init__(self, weights: dict[str, float], intercept: float | None, groups: dict | None = None, pairs: int = 0):
        self.weights, self.intercept, self.groups, self.pairs = weights, intercept, groups or {}, pairs

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE, features: int = FEATURES,
            cf_weight: float = CF_WEIGHT) -> ToxicityModel:
        """Learn ``labels.toxic`` from the texts of ``docs`` where ``learn`` (a
        condition on ``doc_id``) holds. ``cf_weight`` weighs the score changes of swapped terms."""
        marked = labels.where(learn & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        chosen = F.broadcast(seeded_sample(marked, "doc_id", sample, SEED))  # at most ``sample`` small rows
        texts = write_read(docs.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "toxic", "text"), "toxicity-sample")
        kind = docs.schema["doc_id"].dataType.simpleString()
        rows = write_read(texts.mapInArrow(_words_batch, f"id {kind}, toxic int, words array<string>"), "toxicity")
        total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
        if not total.n:
            return cls({}, None)
        # How much more often a word stands in toxic documents than chance has it.
        n, share = total.n, total.t / total.n
        seen = rows.select(F.explode("words").alias("w"), "toxic").groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t"))
        seen = write_read(seen, "toxicity-words")
        groups = {**found_groups(texts, seen, n), **identity_groups()}
        chi = F.pow(F.col("t") - F.col("n") * share, 2) / (F.col("n") * max(share * (1 - share), 1e-9)) / (1.0 + 1e-6 - F.col("n") / n)
        best = seen.where(F.col("n") >= min(MIN_DOCS, n)).orderBy(chi.desc(), "w").limit(features).select("w").collect()
        vocabulary = sorted({x.w for x in best} | features_of(set(groups)))
        known = F.array(*[F.lit(w) for w in vocabulary])
        at = {w: i for i, w in enumerate(vocabulary)}
        got = rows.select("id", "toxic", F.array_intersect("words", known).alias("words")).collect()
        got.sort(key=lambda x: (x.id, x.words))
        # Distinct pairs: few terms, and which of their few features change.
        swaps = texts.select("text").mapInArrow(_swaps_batch(groups), "gone array<string>, come array<string>, times bigint")
        swaps = swaps.groupBy("gone", "come").agg(F.sum("times").alias("times")).collect()
        swaps.sort(key=lambda x: (x.gone, x.come))
        pairs = [([at[w] for w in x.gone], [at[w] for w in x.come]) for x in swaps]
        w, b = fit([[at[v] for v in x.words] for x in got], np.array([x.toxic for x in got], float), pairs, len(vocabulary), cf_weight, times=[x.times for x in swaps])
        return cls(dict(zip(vocabulary, w.tolist(), strict=True)), b, groups, len(pairs))

    def score(self, docs: DataFrame) -> DataFrame:
        """``(doc_id, score)`` of every row."""
        kind = docs.schema["doc_id"].dataType.simpleString()
        weights, intercept = self.weights, self.intercept

        def run(batches):
            for b in batches:
                if intercept is None:
                    s = np.zeros(b.num_rows)
                else:
                    z = [intercept + sum(weights[w] for w in sorted(weights.keys() & features_of(words_of(t)))) for t in b.column(1).to_pylist()]
                    s = np.round(1 / (1 + np.exp(-np.array(z, float))), 6)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["doc_id", "score"])
        return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


@register("op5_toxicity")
def op5_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity of every whole text of ``documents``; rows with crc32(doc_id) mod 4 = 2 are held out."""
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = ToxicityModel.fit(docs, table(spark, sf_dir, "labels"), ~out)
    return model.score(docs).select("doc_id", out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
