r"""Language identification by known words first, backing off to character n-grams.

Known words are scored by their log frequency in each language.  An unseen word
is covered by the longest known character n-grams: at each place the longest
gram that any language has seen, else progressively shorter ones; the mean of
their log frequencies counts as one word.  Every place of a word is scored,
however long the word is.  A text's language has the greatest sum over its
words.

A word is a run of letters (``\p{L}+``), in training and in prediction alike.
The score is the probability of the language, where a text of more than
``EVIDENCE`` words counts as one of so many with the same mean: words of a text
are not independent, and its score should not depend on its length.

The model comes from a bounded sample of labelled rows: those in a share of the
range of hashes of (doc_id, text) that is expected to give ``TRAIN_ROWS`` rows
or ``TRAIN_BYTES`` bytes, whichever is less.  Their words are counted in Spark,
where no task gathers texts, and the ``MODEL_WORDS`` most frequent of each language are
kept.  Rows whose crc32(doc_id) mod 3 is 1 are held out.  The model's size is
bounded by ``MODEL_WORDS``, whatever the size of the corpus, so it is broadcast.

Defined cases: null text or text without a letter gives ``und`` with score 0
(digits, marks, superscripts, fractions, Roman and circled numerals are no
letters); ties go to the alphabetically first language; with no labelled row at
all every text is ``und``.  Repeated rows and repeated or null doc_ids give a row each
(null ids are not held out and are not learned from).
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, table

TRAIN_ROWS = 8000
TRAIN_BYTES = 64 << 20
MODEL_WORDS = 20_000
LONGEST = 4
MIN_SCORE = 0.4
EVIDENCE = 20
_RUN = re.compile(r"[^\W\d_]+")  # letters, and numerals that are neither digits nor letters
_CACHE = 150_000
_LONG = 64  # letters of a word that is worth keeping


class Model:
    """Log frequencies of words and n-grams, a vector with an entry for each language."""

    def __init__(self, counts: dict[str, dict[str, int]], longest: int = LONGEST):
        self.langs = sorted(counts)
        self.longest = longest
        k = len(self.langs)
        words: dict[str, np.ndarray] = {}
        grams: dict[str, np.ndarray] = {}
        for i, lang in enumerate(self.langs):
            for w, n in counts[lang].items():
                words.setdefault(w, np.zeros(k))[i] += n
                padded = f"^{w}$"
                weight = 1 + math.log(n)
                for size in range(1, longest + 1):
                    for j in range(len(padded) - size + 1):
                        grams.setdefault(padded[j : j + size], np.zeros(k))[i] += weight
        self.words = self._logs(words, 0.5)
        self.grams: dict[str, int] = {}  # rows of gram_rows
        parts = []
        for size in range(1, longest + 1):
            of_size = {g: v for g, v in grams.items() if len(g) == size}
            self.grams.update({g: len(self.grams) + i for i, g in enumerate(of_size)})
            parts.append(self._logs(of_size, 0.5).matrix)
        self.gram_rows = np.concatenate(parts) if parts else np.zeros((0, k))

    class _Table:
        def __init__(self, keys: dict[str, int], matrix: np.ndarray):
            self.keys, self.matrix = keys, matrix

    def _logs(self, table: dict[str, np.ndarray], alpha: float) -> _Table:
        if not table:
            return self._Table({}, np.zeros((0, len(self.langs))))
        m = np.array(list(table.values())) + alpha
        return self._Table({w: i for i, w in enumerate(table)}, np.log(m / m.sum(axis=0)))

    def places(self, word: str) -> list[int]:
        """The gram (its row) at each place of an unseen word where one is known, the longest there is."""
        padded, get, longest = f"^{word}$", self.grams.get, self.longest
        out = []
        for i in range(len(padded)):
            for stop in range(i + longest, i, -1):
                at = get(padded[i:stop])
                if at is not None:
                    out.append(at)
                    break
        return out

    def unseen(self, some: list[str]) -> np.ndarray:
        """The backed-off vectors of words: the means over their places; zeros where no part is known."""
        places = [self.places(w) for w in some]
        sizes = np.array([len(x) for x in places], dtype=np.int64)
        out = np.zeros((len(some), len(self.langs)))
        there = np.flatnonzero(sizes)
        if len(there):
            flat = np.fromiter(chain.from_iterable(places), dtype=np.int64, count=int(sizes.sum()))
            starts = (np.cumsum(sizes) - sizes)[there]
            out[there] = np.add.reduceat(self.gram_rows[flat], starts, axis=0) / sizes[there, None]
        return out


def words(text: str | None) -> list[str]:
    """The runs of letters of a text, in lower case."""
    found = _RUN.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return [w for run in found for w in "".join(c if c.isalpha() else " " for c in run).split()]


class Scorer:
    """Scores texts; words met lately have a row in the same table as known ones, after them."""

    def __init__(self, model: Model):
        self.model = model
        self.known = len(model.words.keys)
        self.rows = np.zeros((self.known + _CACHE, len(model.langs)))
        self.rows[: self.known] = model.words.matrix
        self._forget()

    def _forget(self) -> None:
        self.at = dict(self.model.words.keys)

    def _sum(self, some: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.at.get, some, repeat(-1)), dtype=np.int64, count=len(some))
        total = self.rows[at[at >= 0]].sum(axis=0)
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            counts = Counter(some[i] for i in missing)
            new = list(counts)
            vectors = self.model.unseen(new)
            total += np.array([counts[w] for w in new]) @ vectors
            keep = [i for i, w in enumerate(new) if len(w) <= _LONG]  # a long one is scored whole like any other, but not kept
            if len(self.at) + len(keep) > len(self.rows):
                self._forget()
            keep = keep[: len(self.rows) - len(self.at)]
            first = len(self.at)
            self.rows[first : first + len(keep)] = vectors[keep]
            self.at.update({new[i]: first + j for j, i in enumerate(keep)})
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        found = words(text)
        if not found or not self.model.langs:
            return "und", 0.0
        total = np.zeros(len(self.model.langs))
        for i in range(0, len(found), 100_000):
            total += self._sum(found[i : i + 100_000])
        best = int(np.argmax(total))
        scaled = (total - total[best]) * min(1.0, EVIDENCE / len(found))
        return self.model.langs[best], float(1 / np.exp(scaled).sum())


def held_out(doc_id):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, rows: int = TRAIN_ROWS, words: int = MODEL_WORDS, most_bytes: int = TRAIN_BYTES) -> Model:
    """A model from a sample of about ``rows`` labelled rows or ``most_bytes`` bytes of ``docs``, none of them held out."""
    usable = docs.filter("doc_id is not null and text is not null and lang is not null").filter(~held_out("doc_id"))
    n, size = usable.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    sample = usable.select("lang", "text")
    share = min(rows / max(n, 1), most_bytes / max(size or 0, 1))
    if share < 1:
        sample = usable.filter(F.xxhash64("doc_id", "text") <= int(-(2**63) + 2**64 * share)).select("lang", "text")
    counted = sample.select("lang", F.explode(F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)")).alias("w")).groupBy("lang", "w").agg(F.count("*").alias("n"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "w"))
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for r in counted.withColumn("nth", first).filter(F.col("nth") <= words).collect():
        counts[r.lang][r.w] = r.n
    return Model(counts)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and lang_score; taken names get a leading underscore."""
    cast = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    names = [fresh("lang_pred", docs.columns), fresh("lang_score", docs.columns)]
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(cast.value)
        for b in batches:
            got = [scorer.predict(t) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x for x, _ in got], pa.string()), pa.array([y for _, y in got], pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` with a language: not ``und``, and a score of ``min_score`` or more."""
    out = identify(docs, model)
    pred, score = out.columns[-2:]
    return out.filter((F.col(pred) != "und") & (F.col(score) >= min_score)).select(*docs.columns)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang"))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
