"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification.

A document is contaminated by a benchmark item if some run of its words is within
``floor(0.2 * words of the item)`` word edits of the item (similarity 0.8). Words are
compared without letter case (ASCII) and without ASCII punctuation at their ends.

The CGK random walk reads a sequence of words into a longer string: at step t it
writes the word it stands on and moves on if the random bit of (t, word) is 1. Two
sequences a few edits apart fall into step again, so edit distance becomes Hamming
distance. Windows as long as the items, one at every word, are walked with the items'
bits, several times with new bits; each walk is sampled at a few steps, several times,
and a window whose samples equal an item's is a candidate. Items of like length are a
group, and each group's number of walks is the least that finds ``TARGET`` of simulated
copies with the full number of edits, made from its own items, and as many of copies that
had no part in that choice. A group that
``MOST_WALKS`` walks leave under the target is searched exactly instead: of one block
more than edits are allowed, some block of a copy is whole.

Before walking, a window must hold enough of the items' word pairs: an edit spoils two
pairs at most, so this count loses nothing. Candidates are verified by Myers' bit
vectors against the whole item. Items over 64 words are walked in parts of at most 64;
of a copy within the limit, some part is within its own.

No row is shuffled. The items are collected in blocks of at most ``BLOCK_BYTES`` of
text, each searched in a pass of its own, so what is sent to executors is bounded.

Of items of fewer than ``LEAST_WORDS`` words no edit is allowed; they are searched exactly, by the hash of every run of
their length. As such runs stand in clean prose as well, ``clean`` counts them only where they are a document's whole text, unless ``short`` is set.

Defined results: null and empty items find nothing; a null or empty document has no hit; repeated rows are reported once each;
items that are repeated under one id count once; null item ids are ignored; null
``doc_id`` rows are kept; of several hits of an item in a document the closest, then
first, is given; other columns are ignored or, by ``clean``, kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import Memo, kept, portions, segments, text_of, utf8

ALLOWED = 0.2
LEAST_WORDS = 5
PART_WORDS = 64
SAMPLES, STEPS_SAMPLED = 8, 4
TARGET, TRIALS, MOST_WALKS = 0.97, 600, 24
BLOCK_BYTES = 8 << 20
SEGMENT = 400_000
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PAIR_BITS = 20
_HITS = "doc_id bigint, item_id bigint, distance int, item_words int, start_word bigint, end_word bigint"


def words_of(text: bytes) -> list[bytes]:
    return [w for w in (x.strip(_PUNCTUATION) for x in text.lower().split()) if w]


def allowed(words: int) -> int:
    """Edits within which a copy of so many words still counts."""
    return int(ALLOWED * words + 1e-9)


def nearest(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to any run of ``text``, and the first end of such a run. Symbol 0 equals nothing."""
    size = len(item)
    places: dict[int, int] = {}
    for k, symbol in enumerate(item):
        places[symbol] = places.get(symbol, 0) | 1 << k
    mask, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = mask, 0, size
    best, end = size, 0
    for at, symbol in enumerate(text):
        same = places.get(symbol, 0) if symbol else 0
        diagonal = (((same & up) + up) ^ up) | same | down
        plus, minus = down | ~(diagonal | up) & mask, up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & mask, minus << 1 & mask
        up, down = minus | ~(diagonal | plus) & mask, plus & diagonal
        if score < best:
            best, end = score, at + 1
    return best, end


class Matcher:
    """Finds copies of a block of items in texts."""

    def __init__(self, items: list[tuple[int, bytes]], seed: int = 11):
        named = {}
        for item_id, text in sorted(items):
            named.setdefault((item_id, tuple(words_of(text))))
        self.items = [(i, list(w)) for i, w in named if len(w) >= LEAST_WORDS]
        self.short: dict[tuple[bytes, ...], list[int]] = {}
        for i, w in named:
            if 0 < len(w) < LEAST_WORDS:
                self.short.setdefault(w, []).append(i)
        long_words = sorted({w for _, ws in self.items for w in ws})
        vocabulary = {w: n + 1 for n, w in enumerate([*long_words, *sorted({w for ws in self.short for w in ws}.difference(long_words))])}
        self.runs: dict[int, tuple[np.ndarray, list[tuple[bytes, ...]]]] = {}  # by length: sorted keys of short items, and their words
        for length in sorted({len(w) for w in self.short}):
            own = [w for w in self.short if len(w) == length]
            keys = np.concatenate([self._block_keys(np.array([vocabulary[x] for x in w], np.int32), length) for w in own])
            self.runs[length] = np.sort(keys), [own[k] for k in np.argsort(keys)]
        self.size = len(vocabulary) + 1
        self.coded = [[vocabulary[w] for w in ws] for _, ws in self.items]
        self.vocabulary = vocabulary
        self.parts = []  # item, offset, symbols
        for n, symbols in enumerate(self.coded):
            count = -(-len(symbols) // PART_WORDS)
            edges = [len(symbols) * k // count for k in range(count + 1)]
            self.parts += [(n, a, symbols[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        self.pairs = np.zeros(1 << _PAIR_BITS, bool)
        for _, _, symbols in self.parts:
            s = np.array(symbols)
            self.pairs[self._pair(s[:-1], s[1:])] = True
        self.mark = zlib.crc32(b"\n".join(vocabulary)), len(vocabulary)
        self.rng = np.random.default_rng(seed)
        self._group()
        self._walks()

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mixed = a.astype(np.uint32) * np.uint32(0x9E3779B1) ^ b.astype(np.uint32) * np.uint32(0x85EBCA77)
        return mixed >> np.uint32(32 - _PAIR_BITS)

    def _group(self) -> None:
        """Parts of like length share steps, samples and filter."""
        lengths = sorted({len(s) for _, _, s in self.parts})
        self.groups: list[dict] = []
        for n in lengths:
            if not self.groups or n > 1.15 * self.groups[-1]["least"]:
                self.groups.append({"least": n, "most": n})
            self.groups[-1]["most"] = n
        for g in self.groups:
            sizes = [n for n in lengths if g["least"] <= n <= g["most"]]
            g["parts"] = [k for k, (_, _, s) in enumerate(self.parts) if len(s) in sizes]
            g["steps"] = max(STEPS_SAMPLED, int(1.6 * g["least"]))
            g["window"] = g["most"] + allowed(g["most"])
            g["need"] = max(0, min(n - 1 - 2 * allowed(n) for n in sizes))
        self.steps = max((g["steps"] for g in self.groups), default=0)
        self.longest = max((len(s) for s in self.coded), default=0)

    def _walks(self) -> None:
        """Adds walks until each group's simulated copies are found; each has its bits, and samples and keys of the groups that need it."""
        self.walks: list[dict] = []
        self.blocks: dict[int, tuple[np.ndarray, dict[int, list[tuple[int, int]]]]] = {}
        trials = [self._trials(g) for g in self.groups]
        found = [np.zeros(TRIALS, bool) for _ in self.groups]
        short, recalls = list(range(len(self.groups))), [1.0] * len(self.groups)
        while short and len(self.walks) < MOST_WALKS:
            bits = self.rng.integers(0, 2, (self.steps, self.size + 1), dtype=np.int8)
            walk = {"bits": bits, "groups": []}
            for n in short:
                g = self.groups[n]
                samples = np.array([np.sort(self.rng.choice(g["steps"], STEPS_SAMPLED, replace=False)) for _ in range(SAMPLES)])
                factors = self.rng.integers(1, 1 << 63, (SAMPLES, STEPS_SAMPLED), dtype=np.uint64) | np.uint64(1)
                members = self._embed(bits, self._rows([self.parts[k][2] for k in g["parts"]], g["steps"]), g["steps"])
                keys = self._keys(members, samples, factors)
                tables, maps = [], []
                for s in range(SAMPLES):
                    table, own = np.zeros(1 << 16, bool), {}
                    for k, key in zip(g["parts"], keys[s].tolist(), strict=True):
                        own.setdefault(key, []).append(k)
                        table[key >> 48] = True
                    tables.append(table)
                    maps.append(own)
                walk["groups"].append((n, samples, factors, tables, maps))
                found[n] |= self._met(walk, walk["groups"][-1], trials[n])
            self.walks.append(walk)
            for n in [n for n in short if found[n].mean() >= TARGET]:
                fresh, met = self._trials(self.groups[n]), np.zeros(TRIALS, bool)
                for own in self.walks:
                    for group in own["groups"]:
                        if group[0] == n:
                            met |= self._met(own, group, fresh)
                if met.mean() >= TARGET:
                    recalls[n] = float(met.mean())
                    short.remove(n)
                else:  # both kinds of copies are asked for from now on
                    trials[n], found[n] = (trials[n][0] + fresh[0], trials[n][1] + fresh[1]), np.concatenate([found[n], met])
        for walk in self.walks:
            walk["groups"] = [x for x in walk["groups"] if x[0] not in short]
        self._blocks(short)
        self.recalls = recalls
        self.simulated_recall = min(recalls, default=1.0)

    def _met(self, walk: dict, group: tuple, trials: tuple[list[int], list[list[int]]]) -> np.ndarray:
        """Which of the copies the walk's samples find."""
        n, samples, factors, _, maps = group
        steps, (parts, copies) = self.groups[n]["steps"], trials
        met = np.zeros(len(parts), bool)
        keys = self._keys(self._embed(walk["bits"], self._rows(copies, steps), steps), samples, factors)
        for own, row in zip(maps, keys, strict=True):
            met |= [part in own.get(key, ()) for part, key in zip(parts, row.tolist(), strict=True)]
        return met

    def _trials(self, group: dict) -> tuple[list[int], list[list[int]]]:
        """Parts of the group, and copies of them with as many random edits as are allowed, followed by other words."""
        parts, copies = [], []
        for _ in range(TRIALS):
            part = group["parts"][int(self.rng.integers(len(group["parts"])))]
            symbols = list(self.parts[part][2])
            for _ in range(allowed(len(symbols))):
                at, kind = int(self.rng.integers(len(symbols))), int(self.rng.integers(3))
                other = int(self.rng.integers(self.size))
                symbols[at : at + (kind < 2)] = [] if kind == 0 else [other]
            parts.append(part)
            copies.append(symbols + self.rng.integers(0, self.size, 2 * PART_WORDS).tolist())
        return parts, copies

    def _blocks(self, groups: list[int]) -> None:
        """By length: table, and map from a block's key to (part, offset), for the parts of the groups."""
        for part in sorted(k for n in groups for k in self.groups[n]["parts"]):
            symbols = self.parts[part][2]
            count = allowed(len(symbols)) + 1
            edges = [len(symbols) * k // count for k in range(count + 1)]
            for a, b in zip(edges, edges[1:], strict=False):
                table, own = self.blocks.setdefault(b - a, (np.zeros(1 << 16, bool), {}))
                key = int(self._block_keys(np.array(symbols[a:b]), b - a)[0])
                table[key >> 48] = True
                own.setdefault(key, []).append((part, a))

    @staticmethod
    def _block_keys(symbols: np.ndarray, length: int) -> np.ndarray:
        """A key of every run of ``length`` symbols."""
        count = max(0, len(symbols) - length + 1)
        key = np.zeros(count, np.uint64)
        for k in range(length):
            key = (key ^ symbols[k : k + count].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key * np.uint64(0xD6E8FEB86659FD93)

    def _rows(self, sequences: list[list[int]], steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Sequences one after another, each followed by end symbols; and their starts."""
        end = [self.size] * (steps + 1)
        flat = np.array([x for s in sequences for x in (*s, *end)], dtype=np.int32)
        starts = np.cumsum([0, *(len(s) + steps + 1 for s in sequences)])[:-1]
        return flat, starts

    @staticmethod
    def _embed(bits: np.ndarray, rows: tuple[np.ndarray, np.ndarray], steps: int) -> np.ndarray:
        """What the walk writes at each step: steps x sequences."""
        flat, place = rows[0], rows[1].astype(np.int64)
        out = np.empty((steps, len(place)), np.int32)
        for t in range(steps):
            out[t] = flat[place]
            place = place + bits[t][out[t]]
        return out

    @staticmethod
    def _keys(written: np.ndarray, samples: np.ndarray, factors: np.ndarray) -> list[np.ndarray]:
        keys = []
        for steps, own in zip(samples, factors, strict=True):
            key = np.zeros(written.shape[1], np.uint64)
            for step, factor in zip(steps, own, strict=True):
                key = (key ^ written[step].astype(np.uint64)) * factor
                key ^= key >> np.uint64(29)
            keys.append(key * np.uint64(0x9E3779B97F4A7C15))
        return keys

    def candidates(self, symbols: np.ndarray, edges: np.ndarray) -> set[tuple[int, int]]:
        """(place, part) whose sampled walks agree, or that share a block; texts begin at ``edges``."""
        size = len(symbols)
        known = np.flatnonzero(self.pairs[self._pair(symbols[:-1], symbols[1:])] & (symbols[:-1] > 0) & (symbols[1:] > 0))
        marks = np.zeros(size, np.int32)
        marks[known] = 1
        before = np.concatenate([[0], np.cumsum(marks, dtype=np.int32)])
        padded = np.concatenate([symbols, np.zeros(self.steps + 1, np.int32)])
        out: set[tuple[int, int]] = set()
        starts = []
        for g in self.groups:
            ends = np.minimum(np.arange(size) + g["window"], size)
            starts.append(np.flatnonzero(before[ends] - before[:size] >= g["need"]))
        for walk in self.walks:
            for n, samples, factors, tables, maps in walk["groups"]:
                g, places = self.groups[n], starts[n]
                for at in range(0, len(places), 40_000):
                    own = places[at : at + 40_000]
                    written = self._embed(walk["bits"], (padded, own), g["steps"])
                    for key, table, parts in zip(self._keys(written, samples, factors), tables, maps, strict=True):
                        for k in np.flatnonzero(table[key >> np.uint64(48)]):
                            for part in parts.get(int(key[k]), ()):
                                out.add((int(own[k]), part))
        for length, (table, own) in self.blocks.items():
            keys = self._block_keys(symbols, length)
            for at in np.flatnonzero(table[keys >> np.uint64(48)]).tolist():
                for part, offset in own.get(int(keys[at]), ()):
                    first = int(edges[np.searchsorted(edges, at, side="right") - 1])
                    out.add((max(first, at - offset), part))
        return out

    def _exact(self, symbols: np.ndarray, inside: bool) -> Iterator[tuple[int, int, int]]:
        """(item id, start, end) of the first run of each short item; without ``inside``, of one that is the whole text."""
        for length, (keys, words) in self.runs.items():
            if len(symbols) < length or not inside and len(symbols) > length:
                continue
            found, first = np.unique(self._block_keys(symbols, length), return_index=True)
            at = np.searchsorted(found, keys)
            for key, place, own in zip(keys, at, words, strict=True):
                if place < len(found) and found[place] == key:
                    for item_id in self.short[own]:
                        yield item_id, int(first[place]), int(first[place]) + length

    def find(self, texts: list[bytes], symbols_of: Memo, short: bool = True) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item id, distance, item words, start, end) of the closest copy of each item in each text; of short ones inside of it if ``short``."""
        hits: dict[tuple[int, int], tuple] = {}
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        held: list[np.ndarray] = []
        owners: list[tuple[int, int]] = []  # text, and its first word there
        size = 0

        def search() -> None:
            edges = np.cumsum([0, *map(len, held)])
            flat = np.concatenate(held)
            if len(flat) < 2:
                return
            last: dict[tuple[int, int], int] = {}
            for place, part in sorted(self.candidates(flat, edges)):
                piece = int(np.searchsorted(edges, place, side="right")) - 1
                item, offset, _ = self.parts[part]
                own = self.coded[item]
                limit = allowed(len(own))
                first = place - offset
                if first - last.get((piece, item), first - len(own)) < max(1, len(own) // 4) and (piece, item) in last:
                    continue
                last[piece, item] = first
                slack = limit + len(own) // 4 + 1
                a = max(int(edges[piece]), first - slack)
                b = min(int(edges[piece + 1]), first + len(own) + limit + slack)
                region = flat[a:b].tolist()
                distance, end = nearest(own, region)
                if distance <= limit:
                    _, back = nearest(own[::-1], region[:end][::-1])
                    text, word = owners[piece]
                    base = word + a - int(edges[piece])
                    hit = (distance, base + end - back, base + end)
                    best[text, item] = min(hit, best.get((text, item), hit))

        for n, text in enumerate(texts):
            found = np.concatenate([np.fromiter(map(symbols_of.__getitem__, part.split()), np.int32) for part in segments(text)])
            found = found[found >= 0]
            for item_id, start, end in self._exact(found, short):
                hits[n, item_id] = (0, start, end, end - start)
            reach = 2 * self.longest + 2 * PART_WORDS
            for at in range(0, max(1, len(found) - reach), SEGMENT):
                part = found[at : at + SEGMENT + reach]
                held.append(part)
                owners.append((n, at))
                size += len(part)
                if size >= SEGMENT:
                    search()
                    held.clear()
                    owners.clear()
                    size = 0
        if held:
            search()
        for (text, item), (distance, start, end) in best.items():
            item_id = self.items[item][0]
            hit = (distance, start, end, len(self.coded[item]))
            hits[text, item_id] = min(hit, hits.get((text, item_id), hit))
        return [(text, item_id, d, n, s, e) for (text, item_id), (d, s, e, n) in sorted(hits.items())]

    def symbols(self) -> Memo:
        """The symbol of a white-space-free chunk: 0 for other words, -1 for one of punctuation alone."""

        def symbol(chunk: bytes) -> int:
            word = chunk.lower().strip(_PUNCTUATION)
            return self.vocabulary.get(word, 0) if word else -1

        return Memo(symbol, 300_000)


def matchers(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Matcher]:
    """Matchers for all items, in blocks of about ``block_bytes`` of text, one after another."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_of().alias("text")).filter("item_id IS NOT NULL").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 + total // block_bytes
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for k in range(blocks):
        yield Matcher([(r.item_id, r.text.encode()) for r in items.filter(block == k).collect()])


def contaminated(docs: DataFrame, benchmark: DataFrame, short: bool = True) -> DataFrame:
    """doc_id, item_id, distance, item_words, start_word, end_word for every document and item within the limit; ``short``: short items inside of texts too."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    names = [field.split()[0] for field in _HITS.split(", ")]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    parts = []
    for shared in map(docs.sparkSession.sparkContext.broadcast, matchers(benchmark)):

        def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = kept(("symbols", shared.value.mark), shared.value.symbols)
            for batch in portions(batches, holding=True):
                ids = batch.column(0).to_pylist()
                found = [(ids[n], *hit) for n, *hit in shared.value.find(utf8(batch.column(1)), own, short)]
                columns = list(zip(*found, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        parts.append(source.mapInArrow(rows, _HITS))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, short: bool = False) -> DataFrame:
    """The rows of ``docs``, unchanged, that hold no copy of a benchmark item; with ``short``, none of a short one inside either."""
    place = docs.columns.index("text")
    for shared in map(docs.sparkSession.sparkContext.broadcast, matchers(benchmark)):

        def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = kept(("symbols", shared.value.mark), shared.value.symbols)
            for batch in portions(batches, holding=True):
                hit = {n for n, *_ in shared.value.find([t or b"" for t in utf8(batch.column(place))], own, short)}
                yield batch.filter(pa.array([n not in hit for n in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(rows, docs.schema)
    return docs
