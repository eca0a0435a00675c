"""Quality rules: a line-labelling CRF decides what share of a text is content.

Every line is described by language-independent features; Viterbi decoding of a
linear-chain CRF marks it as content or boilerplate, and a document stays when
content lines hold at least ``CONTENT_SHARE`` of its word characters.  The CRF
is trained here on labelled line sequences from ``training_lines`` (invented
words; prose, menus, symbol noise, shouting, notices, repetition).

Two base rules go first: a document with fewer than 50 words, or with more than
half of its words in repeated 3-word windows, fails.

Defined cases: null text has no words and fails; repeated rows and repeated or
null doc_ids give a row each; extra columns are kept by ``keep_good``.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_text, fresh, table
from .crf import ChainCRF

CONTENT_SHARE = 0.5
MIN_WORDS = 50
_SPACES = b" \t\n\x0b\x0c\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_LETTER = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC0))
_NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)
_NOT_NOISE = bytes(b for b in range(256) if chr(b) not in "#*$%&|<>{}[]\\^~_=+@/!")
_NOTICES = (b"copyright", b"\xc2\xa9", b"all rights reserved", b"cookie", b"subscribe", b"click here", b"sign in", b"log in", b"terms of", b"privacy policy", b"licensed under", b"lorem ipsum", b"javascript")

BIAS, NOISE_LOW, NOISE_MID, NOISE_HIGH, PIPES, CAPS, DIGITS, STOPPED, SHORT, LONG, SEEN, REPEATS, NOTICE, ODD_WORDS, EMPTY, FEW_LETTERS, BANGS, COMMAS = range(18)
N_FEATURES = 18


def line_features(line: bytes, seen: bool) -> list[int]:
    words = line.split()
    n = len(words)
    if not n:
        return [BIAS, EMPTY]
    chars = len(line)
    noise = len(line.translate(None, _NOT_NOISE))
    letters = len(line.translate(None, _NOT_LETTER))
    out = [BIAS]
    if noise * 50 > chars:
        out.append(NOISE_HIGH if noise * 8 > chars else NOISE_MID if noise * 20 > chars else NOISE_LOW)
    if line.count(b"|") >= 2:
        out.append(PIPES)
    if 2 * len(line.translate(None, _NOT_UPPER)) > letters > 3:
        out.append(CAPS)
    if 4 * len(line.translate(None, _NOT_DIGIT)) > chars:
        out.append(DIGITS)
    if words[-1][-1:] in (b".", b"!", b"?", b":", b'"'):
        out.append(STOPPED)
    if n < 3:
        out.append(SHORT)
    elif n >= 8:
        out.append(LONG)
    if seen:
        out.append(SEEN)
    if n >= 6 and 2 * len(set(words)) < n:
        out.append(REPEATS)
    if chars < 400:
        low = line.lower()
        if any(x in low for x in _NOTICES):
            out.append(NOTICE)
    if chars > 24 * n:
        out.append(ODD_WORDS)
    if 2 * letters < chars - n:
        out.append(FEW_LETTERS)
    if line.count(b"!!") * 3 > n:
        out.append(BANGS)
    if b", " in line:
        out.append(COMMAS)
    return out


def sequence(text: bytes) -> tuple[list[bytes], list[list[int]], int]:
    """Lines, their features, and how many lines with a word equal an earlier line."""
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    features, repeated = [], 0
    for line in lines:
        again = line in seen and bool(line.strip(_SPACES))
        repeated += again
        features.append(line_features(line, again))
        seen.add(line)
    return lines, features, repeated


def training_lines(n: int = 400, seed: int = 11) -> list[list[tuple[bytes, int]]]:
    """Labelled line sequences: 1 content, 0 boilerplate."""
    r = random.Random(seed)
    parts = "an be co da el fi go ha in ju ka lo mi no or pe ra se ti un vo wa xe yo zu ér ön añ ça ß th sch tion".split()

    def word() -> str:
        return "".join(r.choice(parts) for _ in range(r.choice((1, 1, 2, 2, 3, 4))))

    def prose() -> str:
        out = []
        for _ in range(r.choice((1, 1, 2, 3, 5, 8))):
            w = [word() + ("," if r.random() < 0.08 else "") for _ in range(r.choice((2, 5, 9, 14, 20)))]
            if r.random() < 0.1:
                w.insert(r.randrange(len(w)), str(r.randrange(3000)))
            out.append((" ".join(w)).capitalize() + r.choice("...?!"))
        return " ".join(out)

    def boiler() -> str:
        kind = r.randrange(9)
        w = prose().split() if r.random() < 0.6 else [word() for _ in range(r.choice((3, 6, 12, 30)))]
        if kind == 0:
            return " | ".join(w)
        if kind == 1:
            return " ".join(x + r.choice(("###", "***", "$$$", "%%%", "&&&")) for x in w)
        if kind == 2:
            return " ".join(x.upper() + r.choice(("!!", "!!", "")) for x in w)
        if kind == 3:
            return f"{r.choice(('Copyright', '©', 'All rights reserved', 'Subscribe to', 'We use cookies', 'Click here', 'Sign in', 'Terms of use', 'Licensed under'))} {' '.join(w[:4])}"
        if kind == 4:
            return " ".join([w[0]] * r.choice((8, 20, 60)))
        if kind == 5:
            return " > ".join(w[:5])
        if kind == 6:
            return " ".join(str(r.randrange(10**6)) for _ in w)
        if kind == 7:
            return " ".join(w[:2])
        return "<div>" + "</div><div>".join(w[:6]) + "</div>"

    out = []
    for _ in range(n):
        share = r.choice((0.0, 0.05, 0.2, 0.5, 0.95, 1.0))
        rows, bad = [], r.random() < share
        for _ in range(r.choice((1, 2, 5, 10, 20))):
            bad = bad if r.random() < 0.6 else r.random() < share
            line = boiler() if bad else prose()
            if not bad and r.random() < 0.2 and " " in line:  # a text may break off
                line = line[: r.randrange(len(line) // 2, len(line))].rstrip(" .!?") or line
            rows.append((line.encode(), int(not bad)))
            if r.random() < 0.1:
                rows.append((b"", rows[-1][1]))
        if r.random() < 0.1:
            rows.append((rows[0][0], 0))
        out.append(rows)
    return out


@lru_cache(maxsize=1)
def trained() -> ChainCRF:
    """The CRF; trained once, on the driver, and broadcast."""
    rows = training_lines()
    features = [sequence(b"\n".join(x for x, _ in s))[1] for s in rows]
    return ChainCRF(N_FEATURES).fit(features, [[y for _, y in s] for s in rows])


def repeat_words(words: list[bytes]) -> int:
    """Words in a 3-word window that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    v = len(number)
    if v < 2_000_000:
        keys = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
    else:
        pairs = np.unique(ids[:-2] * v + ids[1:-1], return_inverse=True)[1]
        keys = pairs * v + ids[2:]
    _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
    twice = counts[back] > 1
    hit = np.zeros(n, dtype=bool)
    for j in range(3):
        hit[j : n - 2 + j] |= twice
    return int(hit.sum())


def measure(text: bytes | None, crf: ChainCRF, share: float = CONTENT_SHARE) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept."""
    text = text or b""
    words = text.split()
    n = len(words)
    chars = len(text.translate(None, _SPACES + _CONTINUATION))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines, features, dup = sequence(text)
    repeated = repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeated > 50 * n
    states = crf.decode(features)
    sizes = [len(x.translate(None, _SPACES)) for x in lines]
    whole = sum(sizes)
    content = sum(s for s, y in zip(sizes, states) if y) / whole if whole else 0.0
    return n, chars, symbols, dup, repeated, failed, content, not failed and content >= share


_ADDED = [("n_words", pa.int64(), T.LongType()), ("word_chars", pa.int64(), T.LongType()), ("n_symbols", pa.int64(), T.LongType()), ("n_dup_lines", pa.int64(), T.LongType()), ("n_repeat_words", pa.int64(), T.LongType()), ("base_failed", pa.bool_(), T.BooleanType()), ("content_share", pa.float64(), T.DoubleType()), ("kept", pa.bool_(), T.BooleanType())]


def judge(docs: DataFrame, share: float = CONTENT_SHARE) -> DataFrame:
    """``docs`` with the measures and the verdict; taken names get a leading underscore."""
    names = [fresh(n, docs.columns) for n, _, _ in _ADDED]
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, (_, _, t) in zip(names, _ADDED))])
    cast = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = cast.value
        for b in batches:
            rows = [measure(t, crf, share) for t in b.column(at).cast(pa.large_binary()).to_pylist()]
            columns = list(zip(*rows)) or [()] * len(_ADDED)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, t) for c, (_, t, _) in zip(columns, _ADDED))], names=schema.names)

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, share: float = CONTENT_SHARE) -> DataFrame:
    """The rows of ``docs`` that both the base rules and the CRF keep."""
    out = judge(docs, share)
    return out.filter(F.col(out.columns[-1])).select(*docs.columns)


def op6_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(doc_text(table(spark, sf_dir, "documents"))).drop("text")
