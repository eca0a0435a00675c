"""Quality classifier: a byte-level convolutional network in numpy.

Every byte has a learned vector; learned filters of ``WIDTH`` bytes slide over
the whole document, byte by byte to its last one.  The document is covered by overlapping chunks of ``CHUNK``
bytes (each half a chunk after the last); a filter's responses are max-pooled
over each chunk, and the chunks' pooled vectors are combined (their mean and
their maximum over the document) by a logistic layer into one probability.

Training is on the driver from a bounded sample: the ``TRAIN_ROWS`` labelled
rows with the least hash of doc_id among those whose crc32(doc_id) mod 5 is not
0, one text of each, passing over texts that would take the sum over
``TRAIN_BYTES`` bytes.  Scores come from bytes alone.  Every document is scored whole.

Defined cases: null counts as empty; an empty text has the score that the last
layer's bias gives; with no usable label, or no text that fits, all
scores are 0.5.  Labels that
repeat a doc_id with different values are not learned from.  Repeated rows and
repeated or null doc_ids give a row each.  A text of any length is read in
blocks of ``_BLOCK`` bytes.  Extra columns are not read: the result has doc_id and
score, to be joined where more is wanted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_text, table

TRAIN_ROWS = 3000
TRAIN_BYTES = 12 << 20
CHUNK = 1024
WIDTH = 6
DIM = 4
FILTERS = 32
THRESHOLD = 0.3
_BLOCK = 1 << 16


def _padded(text: bytes) -> np.ndarray:
    x = np.frombuffer(text, dtype=np.uint8)
    return x if len(x) >= WIDTH else np.concatenate((x, np.zeros(WIDTH - len(x), dtype=np.uint8)))


class ByteCNN:
    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.embed = r.normal(0, 0.5, (256, DIM)).astype(np.float32)
        self.filters = r.normal(0, 1 / np.sqrt(WIDTH * DIM), (WIDTH * DIM, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, dtype=np.float32)
        self.last = np.zeros(2 * FILTERS, dtype=np.float32)
        self.last_bias = np.zeros(1, dtype=np.float32)

    def params(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.last, self.last_bias]

    def pooled(self, text: bytes, where: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """Each chunk's greatest filter responses, and the byte places they start at (None if not asked for)."""
        x = _padded(text)
        half = CHUNK // 2
        tops, places = [], []
        n_all = len(x) - WIDTH + 1
        for s in range(0, n_all, _BLOCK):
            n = min(_BLOCK, n_all - s)
            e = self.embed[x[s : s + n + WIDTH - 1]]
            w = np.lib.stride_tricks.as_strided(e, (n, WIDTH * DIM), (DIM * 4, 4))
            out = w @ self.filters
            if not where:
                tops.append(np.maximum.reduceat(out, np.arange(0, n, half), axis=0))
                continue
            for a in range(0, n, half):
                part = out[a : a + half]
                at = part.argmax(axis=0)
                tops.append(part[at, np.arange(FILTERS)][None])
                places.append(s + a + at)
        top = np.concatenate(tops)
        place = np.array(places) if where else None
        if len(top) > 1:  # overlapping chunks are pairs of neighbouring halves
            if where:
                place = np.where(top[1:] > top[:-1], place[1:], place[:-1])
            top = np.maximum(top[:-1], top[1:])
        return top, place

    def forward(self, text: bytes, where: bool = True):
        tops, places = self.pooled(text, where)
        act = np.maximum(tops + self.bias, 0)
        best = act.argmax(axis=0)
        v = np.concatenate((act.mean(axis=0), act[best, np.arange(FILTERS)]))
        return tops, places, act, best, v, float(v @ self.last + self.last_bias[0])

    def score(self, text: bytes | None) -> float:
        if not text:
            return float(1 / (1 + np.exp(-self.last_bias[0])))
        z = self.forward(text, where=False)[-1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def grads(self, text: bytes, label: int) -> list[np.ndarray]:
        if not text:
            d = self.score(text) - label
            return [np.zeros_like(p) for p in self.params()[:-1]] + [np.array([d], dtype=np.float32)]
        _, places, act, best, v, z = self.forward(text)
        d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label
        g = np.repeat((d * self.last[None, :FILTERS] / len(act)), len(act), axis=0)
        g[best, np.arange(FILTERS)] += d * self.last[FILTERS:]
        g *= act > 0
        x = _padded(text)
        c, f = np.nonzero(g)
        gf = np.zeros_like(self.filters)
        ge = np.zeros_like(self.embed)
        if len(c):
            b = x[places[c, f][:, None] + np.arange(WIDTH)]
            gv = g[c, f].astype(np.float32)
            np.add.at(gf.T, f, self.embed[b].reshape(len(c), -1) * gv[:, None])
            np.add.at(ge, b.reshape(-1), (self.filters.T[f] * gv[:, None]).reshape(-1, DIM))
        return [ge, gf, g.sum(axis=0).astype(np.float32), (d * v).astype(np.float32), np.array([d], dtype=np.float32)]

    def fit(self, rows: list[tuple[bytes, int]], epochs: int = 5, batch: int = 16, rate: float = 0.01, seed: int = 7) -> ByteCNN:
        if not rows:
            return self
        share = np.clip(np.mean([y for _, y in rows]), 0.01, 0.99)
        self.last_bias[0] = np.log(share / (1 - share))
        r = np.random.default_rng(seed)
        m = [np.zeros_like(p) for p in self.params()]
        s = [np.zeros_like(p) for p in self.params()]
        t = 0
        for epoch in range(epochs):
            order = r.permutation(len(rows))
            for i in range(0, len(rows), batch):
                t += 1
                sums = [sum(x) / len(x) for x in zip(*(self.grads(*rows[j]) for j in order[i : i + batch]))]
                now = rate * (1 - epoch / epochs)
                for k, (p, g) in enumerate(zip(self.params(), sums)):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    p -= now * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-7)
        return self


def held_out(doc_id):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> ByteCNN:
    """A network from a bounded sample of labelled rows that are not held out."""
    known = labels.filter("doc_id is not null and quality is not null").filter(~held_out("doc_id"))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("y"), F.max("quality").alias("z")).filter("y = z")
    picked = known.select("doc_id", F.col("y").cast("int").alias("y"), F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(rows)
    texts = doc_text(docs).join(F.broadcast(picked), "doc_id").filter("text is not null")
    # Sizes first: they decide how many of the texts fit, before any is fetched.
    chosen, size = [], 0
    one = F.min(F.struct(F.md5("text").alias("m"), F.octet_length("text").alias("n"))).alias("x")
    for r in texts.groupBy("h", "doc_id").agg(one).orderBy("h", "doc_id").collect():
        if size + r.x.n <= most_bytes:  # a text that does not fit is passed over
            size += r.x.n
            chosen.append((r.doc_id, r.x.m))
    if not chosen:
        return ByteCNN()
    wanted = docs.sparkSession.createDataFrame(chosen, "doc_id long, m string")
    fetched = texts.withColumn("m", F.md5("text")).join(F.broadcast(wanted), ["doc_id", "m"]).dropDuplicates(["doc_id"])
    got = [(bytes(r.text), r.y) for r in fetched.orderBy("h", "doc_id").collect()]
    return ByteCNN().fit(got)


def classify(docs: DataFrame, model: ByteCNN) -> DataFrame:
    """(doc_id, score) of each whole text."""
    cast = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = cast.value
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([net.score(t) for t in b["text"].to_pylist()], pa.float64())], ["doc_id", "score"])

    return doc_text(docs).mapInArrow(run, "doc_id long, score double")


def op5_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    out = classify(docs, model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
