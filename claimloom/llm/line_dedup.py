"""Line dedup by winnowing: later copies of repeated lines and runs are cut out of the texts.

Lines are taken in two ways. A wrapped line is the run of ``LINE`` words that starts at
a word, as if the text were wrapped anew from there, since shared passages stand in the
middle of paragraphs; every word but the last few starts one. A window is ``MIN_WORDS``
words, that is ``LINES`` neighbouring wrapped lines. A true line ends at a line feed;
a line of ``LINE_WORDS`` words or more counts alone, shorter ones together with as many lines
behind them, and as many before them, as make so many words: a block. Blocks of ``MIN_WORDS`` or more are windows anyway. Words are split at
ASCII white space, which is ignored in comparisons.

1. Winnowing. Of every window the least line hash is selected, the leftmost on a tie, so
   windows with the same words select the same line: a mark. The windows that select one
   mark are neighbours; the words that they cover are the mark's span.
2. Marks are joined by hash. A match is extended both ways by one comparison of the
   spans' hashes: marks with equal hash and span are copies as a whole, and all but the
   first (lowest doc_id, then place) are repeats.
3. Where a hash has spans that differ, as at both ends of a shared passage and around an
   edit, the match is extended word by word: the windows of the first mark of each
   span are joined by their own hashes, and all but the first of each are repeats.
4. Blocks of true lines are joined by their hashes; all but the first of each are repeats.
5. Repeats are deleted, so a word goes exactly if it lies in ``MIN_WORDS`` neighbouring
   words that stand earlier in the order of documents, or earlier in the same text, or in a block whose words are those of an earlier block.
   A match rests on 96 bits at least, and before words are deleted their hash is compared
   with the repeat's, so a text that only shares another's row key loses nothing.

Hot groups. A batch of rows settles what it can: of equal marks it sends on the first
alone, and marks of one hash with other spans go to step 3 without being compared
further. So a passage, line or text that a third of the documents share is a row per
batch where it is joined, and no task holds the group. Rows that are settled travel under
keys of their own and spread evenly.

Defined results: a null text stays null; a text without repeats stays as it is, byte
for byte; a document of which no word is left is dropped by ``deduplicated`` and has an
empty text in ``line_dedup``; rows that repeat doc_id and text are one document and
change alike; rows under one doc_id with unlike texts are documents of their own, in the
order of the texts' hashes; rows without doc_id come last and are told apart by their
texts; an empty table gives no rows; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimloom.llm.common import OWN, cut, portions, utf8

LINE = 25
MIN_WORDS = 50
LINES = MIN_WORDS - LINE + 1
#: Words of a true line that counts alone.
LINE_WORDS = 10
#: Marks the span of a block; below it stand its first word and, in six bits, its words.
_BLOCK = 1 << 62
#: Bits of a span for its number of windows, at most ``LINES``, above which its first word stands.
_MORE = 5
_BASE = 0x9E3779B97F4A7C15 | 1
_SPAN_BASE = 0xC2B2AE3D27D4EB4F | 1
#: Bytes of text hashed at a time, and marks or windows a batch compares at a time.
SEGMENT, HELD = 1 << 20, 1 << 20
DOC, TAG, RUNS = f"{OWN}doc", f"{OWN}tag", f"{OWN}runs"
#: What a batch found of a mark or window: the only one of its hash, a copy of one before, one to compare by windows, or the first of several spans.
ALONE, COPY, ASKED, SEVERAL = range(4)

_SOLID = np.ones(256, bool)
_SOLID[list(b" \t\n\x0b\x0c\r")] = False
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers_to(size: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64."""
    if base not in _powers or len(_powers[base][0]) < size:
        made = []
        for factor in (base, pow(base, -1, 1 << 64)):
            powers = np.full(max(size, 1 << 16), factor, np.uint64)
            powers[0] = 1
            made.append(np.cumprod(powers, dtype=np.uint64))
        if size > 1 << 21:  # a very long text does not keep its table
            return made[0], made[1]
        _powers[base] = (made[0], made[1])
    return _powers[base]


def _mixed(found: np.ndarray) -> np.ndarray:
    found = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return found ^ (found >> np.uint64(32))


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the words, runs of anything but ASCII white space."""
    solid = np.zeros(len(text) + 2, bool)
    solid[1:-1] = _SOLID[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    return edges[::2], edges[1::2]


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of ``values[start:end]`` for each start and end: differences of one running polynomial."""
    powers, inverse = _powers_to(len(values) + 1, base)
    running = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=running[1:])
    return _mixed((running[ends] - running[starts]) * inverse[starts])


def worded(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the words at which lines begin that line feeds end."""
    parts, places, at = [], [], 0
    while at < len(text):
        end = min(len(text), at + SEGMENT)
        while end < len(text) and _SOLID[text[end]]:  # a word that is longer stays whole
            end += 1
        raw = np.frombuffer(text[at:end], np.uint8)
        starts, ends = word_spans(text[at:end])
        places.append(np.searchsorted(starts, np.flatnonzero(raw == 10)) + sum(map(len, parts)))
        parts.append(_range_hashes(raw.astype(np.uint64) + np.uint64(1), starts, ends, _BASE))
        at = end
    return (np.concatenate(parts), np.concatenate(places)) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def word_hashes(text: bytes) -> np.ndarray:
    return worded(text)[0]


def blocks(edges: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the blocks of lines between ``edges``, whose texts are ``owners``: from each line on, and up to each."""
    last = len(edges) - 1
    ends = np.searchsorted(edges, edges[:-1] + LINE_WORDS)
    starts = np.searchsorted(edges, edges[1:] - LINE_WORDS, side="right") - 1
    on, up = np.flatnonzero(ends <= last), np.flatnonzero(starts >= 0)
    pairs = np.concatenate([np.stack([on, ends[on]], 1), np.stack([starts[up], up + 1], 1)])
    pairs = pairs[owners[pairs[:, 0]] == owners[pairs[:, 1] - 1]] if len(pairs) else pairs
    pairs = pairs[edges[pairs[:, 1]] - edges[pairs[:, 0]] < MIN_WORDS]
    pairs = np.unique(pairs, axis=0)
    return edges[pairs[:, 0]], edges[pairs[:, 1]]


def line_hashes(words: np.ndarray, line: int = LINE) -> np.ndarray:
    """A hash of every run of ``line`` words, from hashes of runs of 1, 2, 4, ... words."""
    if len(words) < line:
        return words[:0]
    count = len(words) - line + 1
    runs, size, at, found = words, 1, 0, None
    while True:
        if line & size:
            part = runs[at : at + count]
            found = part if found is None else found * np.uint64(pow(_BASE, size, 1 << 64)) + part
            at += size
        if 2 * size > line:
            break
        runs = runs[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + runs[size:]
        size *= 2
    found = found ^ (found >> np.uint64(31))
    found = found * np.uint64(0xBF58476D1CE4E5B9)
    return found ^ (found >> np.uint64(29))


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the words of each span."""
    return _range_hashes(words, starts, ends, _SPAN_BASE)


def least_places(hashes: np.ndarray, window: int = LINES) -> np.ndarray:
    """The place of the least hash of every window, the leftmost on a tie."""
    values, places = hashes, np.arange(len(hashes))

    def best(a: slice, b: slice) -> None:
        nonlocal values, places
        right = values[b] < values[a]
        values, places = np.where(right, values[b], values[a]), np.where(right, places[b], places[a])

    size = 1
    while 2 * size <= window:
        best(slice(None, -size), slice(size, None))
        size *= 2
    rest = window - size
    if rest:
        best(slice(None, len(values) - rest), slice(rest, None))
    return places


class Marked:
    """Marks of several texts: ``text`` (number), ``first`` and ``more`` (first window, and windows beyond it), ``line`` (hash), in order."""

    def __init__(self, texts: Sequence[bytes]):
        found, feeds = zip(*map(worded, texts), strict=True) if texts else ((), ())
        sizes = np.array([len(w) for w in found], np.int64)
        self.words = np.concatenate(found) if found else np.zeros(0, np.uint64)
        self.starts = np.cumsum(sizes) - sizes
        self.edges = np.unique(np.concatenate([[0, len(self.words)], self.starts, *(f + a for f, a in zip(feeds, self.starts, strict=True))]).astype(np.int64))
        if len(self.words) < MIN_WORDS:
            self.text = self.first = self.more = np.zeros(0, np.int64)
            self.line = np.zeros(0, np.uint64)
            return
        lines = line_hashes(self.words)
        places = least_places(lines)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.flatnonzero(owner[: len(places)] == owner[MIN_WORDS - 1 :])  # windows of one text
        new = np.ones(len(inside), bool)
        new[1:] = (places[inside[1:]] != places[inside[:-1]]) | (owner[inside[1:]] != owner[inside[:-1]])
        heads = np.flatnonzero(new)
        self.at = inside[heads]  # the first window's place among all words
        self.more = np.diff(np.append(heads, len(inside))) - 1
        self.text = owner[self.at]
        self.first = self.at - self.starts[self.text]
        self.line = lines[places[self.at]]

    def spans(self) -> np.ndarray:
        return self.first << _MORE | self.more

    def hashes(self) -> np.ndarray:
        return span_hashes(self.words, self.at, self.at + self.more + MIN_WORDS) if len(self.text) else np.zeros(0, np.uint64)

    def blocks(self) -> tuple[np.ndarray, ...]:
        """Text, span, hash by lines and own hash of every block."""
        text = np.searchsorted(self.starts, self.edges[:-1], side="right") - 1
        starts, ends = blocks(self.edges, text)
        text = np.searchsorted(self.starts, starts, side="right") - 1
        own = span_hashes(self.words, starts, ends)
        return text, _BLOCK | (starts - self.starts[text]) << 6 | (ends - starts), _mixed(_range_hashes(self.words, starts, ends, _BASE) + np.uint64(1)), own

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word, line hash and own hash of every window of the chosen marks."""
        counts = self.more[chosen] + 1
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.repeat(self.at[chosen], counts) + step
        text = np.repeat(self.text[chosen], counts)
        return text, at - self.starts[text], np.repeat(self.line[chosen], counts), span_hashes(self.words, at, at + MIN_WORDS)


def in_groups(texts: Sequence[bytes], size: int = SEGMENT) -> Iterator[tuple[int, Sequence[bytes]]]:
    """Neighbouring texts of ``size`` bytes together, or one that is longer; with the first one's number."""
    first, held = 0, 0
    for n, text in enumerate(texts):
        if held and held + len(text) > size:
            yield first, texts[first:n]
            first, held = n, 0
        held += len(text)
    if first < len(texts):
        yield first, texts[first:]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that touch as one."""
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def without(text: bytes, spans: np.ndarray, checks: np.ndarray) -> tuple[bytes, int, int, int]:
    """The text without the words of the spans and the white space that follows; words and runs that went, and words left.

    A span counts only if the text's own words have its hash there.
    """
    block, rest = spans >= _BLOCK, spans & (_BLOCK - 1)
    starts = np.where(block, rest >> 6, spans >> _MORE)
    ends = starts + np.where(block, rest & 63, (spans & ((1 << _MORE) - 1)) + MIN_WORDS)
    words = word_hashes(text)
    held = ends <= len(words)
    starts, ends, checks = starts[held], ends[held], checks[held]
    same = _check(span_hashes(words, starts, ends)) == checks
    runs = merged(list(zip(starts[same].tolist(), ends[same].tolist(), strict=True)))
    if not runs:
        return text, 0, 0, -1
    edges = [*word_spans(text)[0].tolist(), len(text)]
    at, kept = 0, []
    for start, end in runs:
        kept.append(text[at : edges[start]])
        at = edges[end]
    kept.append(text[at:])
    gone = sum(e - s for s, e in runs)
    return b"".join(kept), gone, len(runs), len(words) - gone


def _check(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint32).view(np.int32)


_PLACED = "line bigint, own bigint, kind int, doc bigint, tag bigint, span bigint, check int"


def settled(line: np.ndarray, own: np.ndarray, doc: np.ndarray, tag: np.ndarray, span: np.ndarray, check: np.ndarray) -> pa.RecordBatch:
    """What one batch knows of its marks or windows, as rows of ``_PLACED``.

    Of each (line, own) the first by (doc, tag, span) goes on and the others are copies; of each line one
    goes on to be compared with other batches, and tells whether there are others.
    """
    kind = np.full(len(line), ALONE, np.int32)
    order = np.argsort(line, kind="stable")
    same = np.zeros(len(line), bool)
    alike = line[order][1:] == line[order][:-1]
    same[1:] |= alike
    same[:-1] |= alike
    group = order[same]
    drop = np.zeros(len(line), bool)
    if len(group):
        group = group[np.lexsort((span[group], tag[group], doc[group], own[group], line[group]))]
        new_line = np.append(True, line[group][1:] != line[group][:-1])
        new_own = new_line | np.append(True, own[group][1:] != own[group][:-1])
        first = np.maximum.accumulate(np.where(new_own, np.arange(len(group)), 0))
        repeated = (doc[group] == doc[group[first]]) & (tag[group] == tag[group[first]]) & (span[group] == span[group[first]]) & ~new_own
        owns = np.add.reduceat(new_own, np.flatnonzero(new_line))  # spans of each line
        several = np.repeat(owns > 1, np.diff(np.append(np.flatnonzero(new_line), len(group))))
        kind[group] = np.where(~new_own, COPY, np.where(~new_line, ASKED, np.where(several, SEVERAL, ALONE)))
        drop[group] = repeated
    alone = (kind == COPY) | (kind == ASKED)
    # Settled rows need not meet others: a key of their own spreads them.
    line = np.where(alone, _mixed(line ^ _mixed(doc.view(np.uint64) ^ tag.view(np.uint64)) ^ span.view(np.uint64)), line)
    keep = ~drop
    columns = [line.view(np.int64), own.view(np.int64), kind, doc, tag, span, check]
    return pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], [f.split()[0] for f in _PLACED.split(", ")])


class _Batch:
    """Rows of ``settled`` held until a batch is full."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.held.append(columns)
            self.size += len(columns[0])

    def rows(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if self.size >= least:
            columns = [np.concatenate(c) for c in zip(*self.held, strict=True)]
            self.held, self.size = [], 0
            yield settled(*columns)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumns({DOC: F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1)), TAG: F.xxhash64("text")})


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _marks(docs: DataFrame) -> DataFrame:
    """Marks of all texts, settled by batches."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Batch()
        for batch in portions(batches):
            doc, tag = _numbers(batch.column(0)), _numbers(batch.column(1))
            for first, texts in in_groups(utf8(batch.column(2))):
                marks = Marked(texts)
                own, at = marks.hashes(), marks.text + first
                held.add(marks.line, own & np.uint64(0xFFFFFFFF), doc[at], tag[at], marks.spans(), _check(own))
                text, spans, line, own = marks.blocks()
                held.add(line, own, doc[text + first], tag[text + first], spans, _check(own))
                yield from held.rows(HELD)
        yield from held.rows()

    return _keyed(docs).filter("text IS NOT NULL").select(DOC, TAG, "text").mapInArrow(rows, _PLACED)


def _judged(placed: DataFrame) -> DataFrame:
    """(kind, doc, tag, span, check) of copies (COPY) and of what has to be compared by windows (ASKED).

    One shuffle and one sort by (line, own, place). A line has a row per batch at most.
    """
    order = ["line", "own", "doc", "tag", "span"]
    by_line, by_own = Window.partitionBy("line"), Window.partitionBy("line", "own").orderBy(*order[2:])
    dealt = placed.repartition("line").sortWithinPartitions(*order)
    several = (F.min("own").over(by_line) != F.max("own").over(by_line)) | (F.max("kind").over(by_line) == SEVERAL)
    later = F.rank().over(by_own) > 1
    known = F.col("kind").isin(COPY, ASKED)
    kind = F.when(known, F.col("kind")).when(F.col("later"), COPY).when(F.col("several"), ASKED)
    found = dealt.withColumn("several", several).withColumn("later", later).withColumn("kind", kind)
    return found.filter("kind IS NOT NULL").select("kind", "doc", "tag", "span", "check")


def _by_document(rows: DataFrame, value, name: str) -> DataFrame:
    """The values of each document as an array: no more than its words, and once for repeated rows."""
    return rows.groupBy(F.col("doc").alias(f"{OWN}rdoc"), F.col("tag").alias(f"{OWN}rtag")).agg(F.collect_set(value).alias(name))


def _met(dealt: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Rows of ``dealt`` with what was found of them; the small side is hashed, so that no texts are sorted."""
    same = (F.col(DOC) == F.col(f"{OWN}rdoc")) & (F.col(TAG) == F.col(f"{OWN}rtag"))
    return dealt.join(found.hint("shuffle_hash"), same, how).drop(f"{OWN}rdoc", f"{OWN}rtag")


def _windows(dealt: DataFrame, asked: DataFrame) -> DataFrame:
    """Windows of the marks asked for, settled by batches."""
    met = _met(dealt, asked, "inner")
    at = {c: met.columns.index(c) for c in (DOC, TAG, "text", RUNS)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Batch()
        for batch in portions(batches):
            doc, tag = _numbers(batch.column(at[DOC])), _numbers(batch.column(at[TAG]))
            spans, sizes = _numbers(batch.column(at[RUNS]).flatten()), _numbers(batch.column(at[RUNS]).value_lengths())
            edges = np.concatenate([[0], np.cumsum(sizes)])
            for first, texts in in_groups([t or b"" for t in utf8(batch.column(at["text"]))]):
                marks = Marked(texts)
                a, b = edges[first], edges[first + len(texts)]
                wanted = np.repeat(np.arange(len(texts)), sizes[first : first + len(texts)]) << 40 | spans[a:b]
                chosen = np.flatnonzero(np.isin(marks.text << 40 | marks.spans(), wanted))
                if len(chosen):
                    text, place, line, own = marks.windows(chosen)
                    # Each window is compared with its like alone, so line and own hash are one key of it.
                    held.add(_mixed(line) ^ own, own, doc[text + first], tag[text + first], place << _MORE, _check(own))
                yield from held.rows(HELD)
        yield from held.rows()

    return met.mapInArrow(rows, _PLACED)


def _removals(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with ``text`` less its repeated runs, and how many words and runs went."""
    dealt = _keyed(docs)
    marks = cut(_judged(_marks(docs)), "marks")
    # Both joins read one shuffle of the rows.
    asked = _by_document(marks.filter(F.col("kind") == ASKED), F.col("span"), RUNS)
    copies = _judged(_windows(dealt, asked)).unionByName(marks).filter(F.col("kind") == COPY)
    met = _met(dealt, _by_document(copies, F.struct("span", "check"), RUNS), "left").select(*docs.columns, RUNS)
    place, width = docs.columns.index("text"), len(docs.columns)
    removed = StructType([*docs.schema.fields, StructField(f"{OWN}words", LongType()), StructField(f"{OWN}cuts", LongType()), StructField(f"{OWN}left", LongType())])
    names = removed.names

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            texts, counts = utf8(batch.column(place)), np.zeros((3, batch.num_rows), np.int64)
            counts[2] = -1
            runs = batch.column(width)
            flat, edges = runs.flatten(), np.concatenate([[0], np.cumsum(_numbers(runs.value_lengths().fill_null(0)))])
            spans, checks = _numbers(flat.field(0)), _numbers(flat.field(1))
            for n in np.flatnonzero(np.diff(edges)).tolist():
                if texts[n] is not None:
                    own = slice(edges[n], edges[n + 1])
                    texts[n], *counts[:, n] = without(texts[n], spans[own], checks[own])
            columns = batch.columns[:width]
            columns[place] = pa.array(texts, pa.binary()).cast(pa.string()).cast(batch.schema.types[place])
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, counts)], names)

    return met.mapInArrow(rows, removed)


def line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, text without later repeated runs, removed_words and removed_runs, a row per document."""
    found = _removals(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    return found.select("doc_id", "text", F.col(f"{OWN}words").alias("removed_words"), F.col(f"{OWN}cuts").alias("removed_runs"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` less their repeated runs; n_chars follows the text; documents left without a word go."""
    found = _removals(docs).filter(f"{OWN}left <> 0")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col(f"{OWN}cuts") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", changed)
    return found.select(*docs.columns)


def oracle_sql(min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> str:
    """DuckDB SQL for ``line_dedup`` over ``documents`` with one row per doc_id: by all windows of words and blocks of lines, without marks or hashes."""
    white = "\\x20\\x09-\\x0D"
    return f"""WITH t AS MATERIALIZED (SELECT doc_id, text, regexp_extract(text, '^[{white}]*') AS head, regexp_extract_all(text, '[^{white}]+[{white}]*') AS tokens, regexp_extract_all(text, '[^{white}]+') AS words FROM documents),
w AS MATERIALIZED (SELECT doc_id, i, array_to_string(words[i : i + {min_words - 1}], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - {min_words - 2})) AS i FROM t WHERE len(words) >= {min_words})),
lines AS MATERIALIZED (SELECT doc_id, n, last - size + 1 AS first, last FROM (SELECT doc_id, n, size, sum(size) OVER (PARTITION BY doc_id ORDER BY n) AS last FROM (
  SELECT doc_id, unnest(range(1, len(parts) + 1)) AS n, unnest([len(regexp_extract_all(p, '[^{white}]+')) FOR p IN parts]) AS size FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))) WHERE size > 0),
spans AS MATERIALIZED (
  SELECT doc_id, first AS i, (SELECT min(b.last) FROM lines b WHERE b.doc_id = a.doc_id AND b.last >= a.first + {line_words - 1}) AS j FROM lines a
  UNION SELECT doc_id, (SELECT max(b.first) FROM lines b WHERE b.doc_id = a.doc_id AND b.first <= a.last - {line_words - 1}) AS i, last AS j FROM lines a),
blocks AS MATERIALIZED (SELECT s.doc_id, i, j, array_to_string(words[i : j], ' ') AS gram FROM spans s JOIN t USING (doc_id) WHERE i IS NOT NULL AND j IS NOT NULL AND j - i < {min_words - 1}),
later AS (SELECT doc_id, i, i + {min_words - 1} AS j FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS n FROM w) WHERE n > 1
  UNION ALL SELECT doc_id, i, j FROM (SELECT doc_id, i, j, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS n FROM blocks) WHERE n > 1),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(range(CAST(i AS BIGINT), CAST(j AS BIGINT) + 1)) AS place FROM later),
runs AS (SELECT doc_id, count(*) AS words, count_if(coalesce(before, -1) <> place - 1) AS runs FROM (SELECT *, lag(place) OVER (PARTITION BY doc_id ORDER BY place) AS before FROM gone) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(token, '' ORDER BY place) AS body FROM (SELECT doc_id, unnest(range(1, len(tokens) + 1)) AS place, unnest(tokens) AS token FROM t WHERE doc_id IN (SELECT doc_id FROM runs)) ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT t.doc_id, CASE WHEN r.doc_id IS NULL THEN t.text ELSE t.head || coalesce(k.body, '') END AS text, coalesce(r.words, 0) AS removed_words, coalesce(r.runs, 0) AS removed_runs
FROM t LEFT JOIN runs r ON r.doc_id = t.doc_id LEFT JOIN kept k ON k.doc_id = t.doc_id"""
