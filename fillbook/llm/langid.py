"""Operator 10, language identification with a byte convolutional network.

Texts are lower-cased, every byte that is no letter becomes a blank, and the
bytes are cut into windows of ``WINDOW``. Filters of several widths slide over
a window, each keeps its largest response, and a softmax layer reads those
maxima. The network is trained in numpy on windows of a bounded, seeded sample
of labelled rows (``DOCS_PER_LANG`` documents of each language); the windows of
all other texts, whole texts, are scored in batches inside ``mapInArrow`` tasks
and a text gets the softmax of its mean window logits.

Defined results: a null text or one without a letter is ``und`` with score 0;
without labelled rows every text is ``und``; a row without doc_id is never
learned from and counts as held out; equal probabilities go to the smaller
language name; repeated rows get equal results; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import frugal, register, seeded_sample, table

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: The bound of the training sample: documents of a language, windows of a document.
DOCS_PER_LANG = 400
WINDOWS_PER_DOC = 4
EPOCHS = 12
BATCH = 64
SEED = 7
UNKNOWN = "und"
#: The pipeline's filter rejects texts whose best language is less likely than this.
MIN_SCORE = 0.4

# Byte classes: blank 0, a-z 1-26, bytes from 128 on 27-154.
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = np.arange(27, 155)
ALPHABET = 155


def encode(text: str) -> np.ndarray:
    """Byte classes of a text."""
    return _CLASS[np.frombuffer(text.lower().encode(), np.uint8)]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def held_out(id_col: Column, mod: int, rest: int) -> Column:
    """Whether crc32 of the id's text leaves ``rest``; true without an id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % mod == rest, F.lit(True))


# ---- training (numpy, on the driver, over the bounded sample) -------------

def _responses(x: np.ndarray, p: dict) -> list[np.ndarray]:
    """Filter responses (window, place, filter) of each width."""
    out = []
    for w in WIDTHS:
        n = x.shape[1] - w + 1
        out.append(sum(p[f"k{w}"][j][x[:, j:j + n]] for j in range(w)))
    return out


def train(x: np.ndarray, y: np.ndarray, n_lang: int) -> dict[str, np.ndarray]:
    """Fit the network to windows ``x`` with language numbers ``y`` (Adam)."""
    r = np.random.default_rng(SEED)
    p = {f"k{w}": r.normal(0, 0.3, (w, ALPHABET, FILTERS)).astype(np.float32) for w in WIDTHS}
    p |= {"b": np.zeros(FILTERS * len(WIDTHS), np.float32), "c": np.zeros(n_lang, np.float32),
          "o": r.normal(0, 0.2, (FILTERS * len(WIDTHS), n_lang)).astype(np.float32)}
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(EPOCHS):
        order = r.permutation(len(x))
        for at in range(0, len(x), BATCH):
            pick = order[at:at + BATCH]
            xb, yb = x[pick].copy(), y[pick]
            # Half of the windows are cut short, as short texts are.
            short = np.where(r.random(len(pick)) < 0.5, r.integers(16, WINDOW + 1, len(pick)), WINDOW)
            xb[np.arange(WINDOW)[None, :] >= short[:, None]] = 0
            conv = _responses(xb, p)
            best = [c.argmax(axis=1) for c in conv]
            h = np.concatenate([np.take_along_axis(c, b[:, None], 1)[:, 0] for c, b in zip(conv, best, strict=True)], 1) + p["b"]
            act = np.maximum(h, 0)
            z = act @ p["o"] + p["c"]
            q = np.exp(z - z.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            q[np.arange(len(yb)), yb] -= 1
            q /= len(yb)
            dh = (q @ p["o"].T) * (h > 0)
            g = {"o": act.T @ q, "c": q.sum(0), "b": dh.sum(0)}
            for i, w in enumerate(WIDTHS):
                d = dh[:, i * FILTERS:(i + 1) * FILTERS]
                gk = np.zeros_like(p[f"k{w}"])
                for j in range(w):
                    np.add.at(gk[j], (np.take_along_axis(xb, best[i] + j, 1), np.arange(FILTERS)[None, :]), d)
                g[f"k{w}"] = gk
            step += 1
            for k, v in g.items():
                m1[k] = 0.9 * m1[k] + 0.1 * v
                m2[k] = 0.999 * m2[k] + 0.001 * v * v
                p[k] -= (0.01 * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return p


# ---- scoring (numpy, inside tasks) ----------------------------------------

class Scorer:
    """The trained network with the responses of byte pairs tabulated.

    A filter of width 4 is then two table rows and one of width 2 a single row.
    """

    def __init__(self, p: dict[str, np.ndarray]):
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(ALPHABET * ALPHABET, FILTERS)
        k2, k3, k4 = p["k2"], p["k3"], p["k4"]
        self.first = np.concatenate([pair(k2[0], k2[1]), pair(k3[0], k3[1]), pair(k4[0], k4[1])], 1)
        self.third, self.last = k3[2], pair(k4[2], k4[3])
        self.p = p

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Window logits, 64 windows at a time to stay in the cache."""
        out = np.empty((len(x), len(self.p["c"])), np.float32)
        for at in range(0, len(x), 64):
            b = x[at:at + 64]
            pairs = b[:, :-1].astype(np.int32) * ALPHABET + b[:, 1:]
            r = self.first[pairs]
            f = FILTERS
            r[:, :-1, f:2 * f] += self.third[b[:, 2:]]
            r[:, :-2, 2 * f:] += self.last[pairs[:, 2:]]
            h = np.concatenate([r[:, :, :f].max(1), r[:, :-1, f:2 * f].max(1), r[:, :-2, 2 * f:].max(1)], 1) + self.p["b"]
            out[at:at + 64] = np.maximum(h, 0) @ self.p["o"] + self.p["c"]
        return out

    def predict(self, texts: list[str | None], langs: list[str]) -> tuple[list[str], list[float]]:
        """Best language and its probability of each whole text."""
        known = [bool(langs) and has_letter(t) for t in texts]
        name, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        todo = [i for i, k in enumerate(known) if k]
        at = 0
        while at < len(todo):
            codes, take = [], []
            while at < len(todo) and sum(map(len, codes)) < 1 << 20:
                c = encode(texts[todo[at]])
                codes.append(np.pad(c, (0, -len(c) % WINDOW)))
                take.append(todo[at])
                at += 1
            z = self.logits(np.concatenate(codes).reshape(-1, WINDOW))
            n = np.array([len(c) // WINDOW for c in codes])
            mean = np.add.reduceat(z, np.r_[0, np.cumsum(n)[:-1]], axis=0) / n[:, None]
            q = np.exp(mean - mean.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            for i, j, s in zip(take, q.argmax(1), q.max(1), strict=True):
                name[i], score[i] = langs[j], round(float(s), 6)
        return name, score


@lru_cache(maxsize=2)
def _scorer(key: tuple) -> Scorer:
    return Scorer({n: np.frombuffer(raw, np.float32).reshape(shape) for n, shape, raw in key})


def _window_batches(batches: Iterator[pa.RecordBatch]):
    """Seeded windows of each training text."""
    for b in batches:
        rows = []
        for i, text, lang in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if not has_letter(text):
                continue
            c = encode(text)
            n = max(1, len(c) - WINDOW + 1)
            r = np.random.default_rng(zlib.crc32(i.encode()))
            for at in sorted({int(a) for a in r.integers(0, n, WINDOWS_PER_DOC)}):
                w = c[at:at + WINDOW]
                rows.append((lang, i, at, np.pad(w, (0, WINDOW - len(w))).tobytes()))
        cols = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.binary()), strict=True)],
                                         names=["lang", "id", "at", "window"])


class LanguageModel:
    """A trained network and its languages."""

    def __init__(self, langs: list[str], params: dict[str, np.ndarray]):
        self.langs = langs
        self.key = tuple((n, v.shape, v.tobytes()) for n, v in sorted(params.items()))

    @classmethod
    def fit(cls, docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            docs_per_lang: int = DOCS_PER_LANG) -> LanguageModel:
        """Train on a seeded sample of the rows where ``learn`` holds.

        The ids of the sample are chosen without reading a text; only windows
        of the sampled texts reach the driver.
        """
        ids = docs.where(learn & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).alias("lang"))
        # Bounded by docs_per_lang for each language, so small enough to broadcast.
        chosen = F.broadcast(seeded_sample(ids, "id", docs_per_lang, SEED, by="lang").select("id").distinct())
        rows = docs.where(learn & F.col(lang_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
        got = rows.join(chosen, "id", "left_semi").mapInArrow(_window_batches, "lang string, id string, at bigint, window binary").distinct().collect()
        got.sort(key=lambda x: (x.lang, x.id, x.at, bytes(x.window)))
        langs = sorted({x.lang for x in got})
        if not langs:
            return cls([], {})
        x = np.frombuffer(b"".join(bytes(r.window) for r in got), np.uint8).reshape(-1, WINDOW)
        return cls(langs, train(x, np.array([langs.index(r.lang) for r in got]), len(langs)))

    def predict(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """``(id, lang_pred, score)`` of every row."""
        kind = docs.schema[id_col].dataType.simpleString()
        langs, key = self.langs, self.key

        def run(batches):
            for b in batches:
                name, score = (_scorer(key).predict(b.column(1).to_pylist(), langs) if langs
                               else ([UNKNOWN] * b.num_rows, [0.0] * b.num_rows))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(name, pa.string()), pa.array(score, pa.float64())],
                                                 names=["id", "lang_pred", "score"])
        return docs.select(id_col, text_col).mapInArrow(frugal(run), f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)

    def accepted(self, docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
        """The rows of ``docs`` (all columns) whose text has a known language."""
        langs, key = self.langs, self.key

        def run(batches):
            for b in batches:
                if langs:
                    name, score = _scorer(key).predict(b.column("text").to_pylist(), langs)
                    yield b.filter(pa.array([n != UNKNOWN and s >= min_score for n, s in zip(name, score, strict=True)], pa.bool_()))
                else:
                    yield b.filter(pa.array([has_letter(t) for t in b.column("text").to_pylist()], pa.bool_()))
        return docs.mapInArrow(frugal(run), docs.schema)


@register("op10_langid")
def op10_langid(spark, sf_dir) -> DataFrame:
    """Language of every whole text of ``documents``; rows with crc32(doc_id) mod 5 = 0 are held out."""
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 5, 0)
    found = LanguageModel.fit(docs, ~out).predict(docs)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
