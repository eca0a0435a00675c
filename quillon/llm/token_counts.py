"""Edit-aware token counts by pre-token segment trees.

A document's pre-tokens are counted once and grouped into segments of about
``SEGMENT``; a segment tree over the segments holds, for every subtree, its
characters and its tokens.  Every document has its tree, edited or not.

An edit replaces a range of characters.  The tree finds the first segment it
touches; only from the last pre-token boundary that the edit cannot influence
the text is cut again, and cutting stops as soon as a new boundary meets an old
one behind the edit, from where the rest is as it was.  Only pre-tokens in
between are encoded, only the touched segments' texts are copied, and the sums
on the paths to the root are updated.

The boundary that an edit cannot influence depends on how far the pattern looks
ahead.  With a ``margin`` it lies that many characters before the edit, or
before the white space that stands there, as patterns look to the end of white
space; ``MARGIN`` holds for the installed pattern and for others of its kind.
Without one (the default for any other pattern) the text is cut again from its
start, which is right for every pattern that does not look behind.  Patterns that
look behind, or match the empty string, are refused.  Characters that a pattern
leaves out belong to no pre-token and count nothing.

Edits are (start, stop, replacement), in code points of the text as the edits
before it have left it, applied in order.  ``redactions`` makes such edits for
e-mail addresses, phone-like and card-like numbers and IP addresses, in time
linear in the text.

Defined cases: null text counts as empty; null or missing edits leave the text
as it is; ranges are clipped to the text; a reversed range inserts at its
start.  Very long texts are one row of one task and cost time and memory in
proportion.  Repeated rows and repeated or null doc_ids give a row each; extra
columns ride along, and new columns whose names are taken get a leading
underscore.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import default_vocabulary, encode_word, load_ranks
from .common import fresh, table

SEGMENT = 256
MARGIN = 3  # characters after a boundary that the installed pattern looks at, at most
_CACHE = 200_000
EDITS = "array<struct<start:bigint,stop:bigint,text:string>>"


class Counter:
    """Token counts of pre-tokens, remembered up to a bound."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def count(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            n = self.older.get(word)
            if n is None:
                n = len(encode_word(word.encode(), self.ranks))
            if len(self.known) >= _CACHE:  # words not seen since the last turn are forgotten
                self.older = self.known.copy()
                self.known.clear()
            self.known[word] = n
        return n


class TokenTree:
    """Segments of (length, tokens) of pre-tokens under a tree of sums.

    A segment is cut out of the first text's leaves when an edit touches it;
    until then only its sums are held apart.
    """

    def __init__(self, text: str, counter: Counter, margin: int | None = MARGIN):
        self.counter, self.margin = counter, margin
        self.encoded = 0
        words = counter.pattern.findall(text)
        counts = list(map(counter.known.get, words))
        if None in counts:
            count = counter.count
            counts = [count(w) if n is None else n for w, n in zip(words, counts)]
        sizes = list(map(len, words))
        if sum(sizes) != len(text):  # the pattern leaves characters out: they are leaves without tokens
            sizes, counts = self._with_gaps(text, counts)
        self._leaves(text, sizes, counts)

    def _with_gaps(self, text: str, counts: list[int]) -> tuple[list[int], list[int]]:
        sizes, tokens, at = [], [], 0
        for m, n in zip(self.counter.pattern.finditer(text), counts):
            if m.start() > at:
                sizes.append(m.start() - at)
                tokens.append(0)
            sizes.append(m.end() - m.start())
            tokens.append(n)
            at = m.end()
        if at < len(text):
            sizes.append(len(text) - at)
            tokens.append(0)
        return sizes, tokens

    def _leaves(self, text: str, sizes: list[int], counts: list[int]) -> None:
        """A new tree of these leaves."""
        n = max(1, -(-len(sizes) // SEGMENT))
        self._first = text, sizes, counts
        self.segments: list[list[tuple[int, int]] | None] = [None] * n
        self.texts: list[str | None] = [None] * n
        self.size = 1 << (n - 1).bit_length()
        pad = [0] * (self.size - n)
        cuts = range(0, n * SEGMENT, SEGMENT)
        self.chars = [0] * self.size + [sum(sizes[i : i + SEGMENT]) for i in cuts] + pad
        self.tokens = [0] * self.size + [sum(counts[i : i + SEGMENT]) for i in cuts] + pad
        self._starts = [0, *accumulate(self.chars[self.size : self.size + n])]
        for i in range(self.size - 1, 0, -1):
            self._join(i)

    def _open(self, i: int) -> None:
        """Cut segment ``i`` out of the first text."""
        if self.segments[i] is None:
            text, sizes, counts = self._first
            here = slice(i * SEGMENT, (i + 1) * SEGMENT)
            self.segments[i] = list(zip(sizes[here], counts[here]))
            self.texts[i] = text[self._starts[i] : self._starts[i + 1]]

    def _join(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self._text(i) for i in range(len(self.segments)))

    @property
    def leaves(self) -> list[tuple[int, int]]:
        for i in range(len(self.segments)):
            self._open(i)
        return [x for s in self.segments for x in s]

    def _text(self, i: int) -> str:
        held = self.texts[i]
        return self._first[0][self._starts[i] : self._starts[i + 1]] if held is None else held

    def _find(self, at: int) -> tuple[int, int]:
        """The segment that holds character ``at`` (or the last with any), and its first character."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at >= start + self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.size, start

    def _safe(self, start: int) -> int:
        """A place such that pre-tokens that end there or before are as they were, whatever comes from ``start`` on."""
        if self.margin is None:
            return 0
        at = max(0, start - self.margin)
        while at:
            i, first = self._find(at - 1)
            held = self._text(i)[: at - first].rstrip()
            at = first + len(held)
            if held:
                break
        return max(0, at - self.margin)

    def edit(self, start: int, stop: int, text: str) -> None:
        n = self.chars[1]
        start = min(max(start, 0), n)
        stop = min(max(stop, start), n)
        safe = self._safe(start)
        first, base = self._find(safe)
        self._open(first)
        keep, at = 0, base
        while keep < len(self.segments[first]) and at + self.segments[first][keep][0] <= safe:
            at += self.segments[first][keep][0]
            keep += 1
        # The text from the first segment on, new where the edit is, as far as it is needed; and old boundaries beyond the edit.
        last, end = first, base + self.chars[self.size + first]
        while end < stop:
            last += 1
            end += self.chars[self.size + last]
        old = "".join(self._text(i) for i in range(first, last + 1))
        buffer = old[: start - base] + text + old[stop - base :]
        moved = len(text) - (stop - start)
        seg, k, mark, place = first, keep, at, at - base
        fresh_leaves: list[tuple[int, int]] = []
        search = self.counter.pattern.search
        while True:
            while seg < len(self.segments) and mark - base + moved < place:
                self._open(seg)
                if k >= len(self.segments[seg]):
                    seg, k = seg + 1, 0
                    continue
                mark += self.segments[seg][k][0]
                k += 1
            if mark >= stop and mark - base + moved == place:
                break
            if place >= len(buffer) and last + 1 >= len(self.segments):
                seg, k = len(self.segments), 0
                break
            m = search(buffer, place)
            if last + 1 < len(self.segments) and (m is None or not self._certain(buffer, m.end())):
                more = max(1, last + 1 - first)  # twice as much
                upto = len(self.segments) - 1 if self.margin is None else min(last + more, len(self.segments) - 1)
                buffer += "".join(self._text(i) for i in range(last + 1, upto + 1))
                last = upto
                continue
            stops = m.start() if m else len(buffer)
            if stops > place:
                fresh_leaves.append((stops - place, 0))
                place = stops
                continue
            word = m.group()
            fresh_leaves.append((len(word), self.counter.count(word)))
            self.encoded += 1
            place = m.end()
        tail = []
        if seg < len(self.segments):
            self._open(seg)
            tail = self.segments[seg][k:]
        final = min(seg, len(self.segments) - 1)
        rest = self._text(final)[sum(a for a, _ in self.segments[final][:k]) :] if tail else ""
        merged = self.segments[first][:keep] + fresh_leaves + tail
        own = buffer[:place] + rest
        if len(merged) > 4 * SEGMENT:  # grown far: cut the segments anew; no pre-token is encoded again
            whole = "".join([*(self._text(i) for i in range(first)), own, *(self._text(i) for i in range(final + 1, len(self.segments)))])
            for i in range(len(self.segments)):
                self._open(i)
            leaves = [x for s in self.segments[:first] for x in s] + merged + [x for s in self.segments[final + 1 :] for x in s]
            self._leaves(whole, [a for a, _ in leaves], [b for _, b in leaves])
            return
        for i in range(first, final + 1):
            self.segments[i], self.texts[i] = (merged, own) if i == first else ([], "")
            self.chars[self.size + i] = sum(a for a, _ in self.segments[i])
            self.tokens[self.size + i] = sum(b for _, b in self.segments[i])
        above = {(self.size + i) // 2 for i in range(first, final + 1)}
        while above and 0 not in above:
            for i in above:
                self._join(i)
            above = {i // 2 for i in above}

    def _certain(self, buffer: str, end: int) -> bool:
        """Whether text beyond the buffer cannot change a match that ends at ``end``: see the margin."""
        if self.margin is None:
            return False
        for i in range(end, len(buffer) - self.margin):
            if not buffer[i].isspace():
                return True
        return False


#: A run of the characters of an address is read once: from its start, and never given back.
_PRIVATE = re.compile(r"(?<![\w.+-])[\w.+-]++@[\w-]++(?:\.[\w-]++)++|\b\d{1,3}(?:\.\d{1,3}){3}\b|\+?\d[\d ()-]{7,}\d")


_MARK = re.compile(r"[@\d]")  # each piece has one


def redactions(text: str | None) -> list[tuple[int, int, str]]:
    """Edits, last first, that put a placeholder for each piece of personal data."""
    if not text or not _MARK.search(text):
        return []
    return [(m.start(), m.end(), "[EMAIL]" if "@" in m.group() else "[NUMBER]") for m in _PRIVATE.finditer(text or "")][::-1]


def checked(pattern: str) -> str:
    """``pattern``, if pre-tokens can be cut by it from any boundary on."""
    if regex.search(r"\(\?<[=!]|\\[bBAGmMK]|(?<!\[)\^", pattern):
        raise ValueError("a pattern that looks behind cannot be cut anew from the middle of a text")
    if regex.match(pattern, "") is not None:
        raise ValueError("a pattern that matches the empty string does not cut pre-tokens")
    return pattern


def with_redactions(docs: DataFrame, name: str = "edits") -> DataFrame:
    """``docs`` with a last column of the edits that ``redactions`` makes; a taken name gets a leading underscore."""
    name = fresh(name, docs.columns)
    at = docs.columns.index("text")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("text", pa.string())]))
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(f"{name} {EDITS}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            edits = [[{"start": a, "stop": z, "text": t} for a, z, t in redactions(x)] for x in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(edits, kind)], names=schema.names)

    return docs.mapInArrow(run, schema)


def with_edits(docs: DataFrame, edits: DataFrame, name: str = "edits") -> DataFrame:
    """``docs`` with the rows of ``edits(doc_id, nr, start, stop, text)`` as a last column, in order of nr; a taken name gets a leading underscore."""
    name = fresh(name, docs.columns)
    key = fresh("edited", [*docs.columns, name])
    rows = edits.select("doc_id", F.struct("nr", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), F.coalesce("text", F.lit("")).alias("text")).alias("e"))
    listed = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list("e")).alias("es")).select(F.col("doc_id").alias(key), F.transform("es", lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop"), e["text"].alias("text"))).alias(name))
    return docs.join(listed, F.col("doc_id") == F.col(key), "left").drop(key)


def count_tokens(docs: DataFrame, edits: str = "edits", path: str | None = None, pattern: str | None = None, margin: int | None = None) -> DataFrame:
    """``docs`` with n_tokens, n_tokens_edited, n_edits and n_encoded; taken names get a leading underscore.

    ``n_encoded`` is the number of pre-tokens that the edits made it encode anew.
    ``margin``: see above; it need not be given with the installed pattern.
    """
    own_path, own_pattern = default_vocabulary() if path is None or pattern is None else (path, pattern)
    if pattern is None and margin is None:
        margin = MARGIN
    path, pattern = path or own_path, checked(pattern or own_pattern)
    at, of = docs.columns.index("text"), docs.columns.index(edits) if edits in docs.columns else None
    names = [fresh(n, docs.columns) for n in ("n_tokens", "n_tokens_edited", "n_edits", "n_encoded")]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, pattern)
        for b in batches:
            rows = []
            changes = b.column(of).to_pylist() if of is not None else [None] * b.num_rows
            for text, change in zip(b.column(at).to_pylist(), changes):
                tree = TokenTree(text or "", counter, margin)
                before = tree.total
                for e in change or ():
                    tree.edit(e["start"], e["stop"], e["text"] or "")
                rows.append((before, tree.total, len(change or ()), tree.encoded))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, pa.int64()) for c in columns)], names=schema.names)

    return docs.mapInArrow(run, schema)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    edited = with_redactions(docs)
    return count_tokens(edited, edits=edited.columns[-1]).drop("text", edited.columns[-1])
