"""Benchmark decontamination: passages of documents that are within a small edit distance of a benchmark item.

CGK embedding: a walk over the words of a window copies the word at its pointer to each step's output and moves on or stays by a random bit of (step, word). Two word sequences of a small edit distance give outputs of a small Hamming distance, as the walks fall into step again after an edit. Bit sampling: a key of SAMPLED outputs, repeated REPEATS times over EMBEDDINGS walks; a window and an item that meet in any key are a candidate, and the exact edit distance of the item to the best stretch of the document about the window decides. A window of an item's size starts at every word of every text. Items are classed by length, so that the steps sampled lie within every item of the class; the first key of each walk and class stays so near its start that an exact copy always meets it.

An item is indexed from several of its words on (its OFFSETS), each time as an item of what is left, so an edited start doesn't hide the rest; the windows of the texts and their keys are the same for all.

The walks of all windows of a batch of texts go side by side in arrays; texts are read once and never shuffled. The index of the items is broadcast; items of more than ITEM_BYTES are dealt to several indexes by hash, each a pass over the documents, so that what is sent to executors is bounded by bytes.

Defined results: null, empty and blank texts or items match nothing; items of equal id and text count once; repeated rows match alike; without items nothing is found and nothing dropped; words are runs of letters, digits and bytes beyond ASCII, without regard to the case of A-Z; other columns, whatever their names, are ignored by leaks() and kept by drop_leaks().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .words import _random, mixed, word_hashes

#: Edits, as a share of the item's words, up to which a passage is a leak.
MAX_EDITS = 0.2
EMBEDDINGS = 3
#: Keys per embedding and length class, and outputs per key.
REPEATS = 6
SAMPLED = 5
#: Shares of an item after which it is indexed again.
OFFSETS = (0.0, 0.25, 0.5)
#: Words that are left at least.
LEAST_LEFT = 14
#: Bytes of item texts in one index.
ITEM_BYTES = 32 << 20
#: Windows that walk side by side.
STRIDE = 1 << 14
_U = np.uint64
_FACTOR = _random(77, SAMPLED) | _U(1)
_WORD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def tokens(data: bytes | None) -> np.ndarray:
    return word_hashes((data or b"").translate(_WORD))


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of item to a stretch of text, and the stretch: its first start for its first end."""
    d, end = _rows(item, text)
    back, length = _rows(item[::-1], text[:end][::-1], last=True)
    return d, end - length, end


def _rows(item: np.ndarray, text: np.ndarray, last: bool = False) -> tuple[int, int]:
    """Distance, and the end of the best stretch; last: of the stretches that start with the text, the longest best one."""
    at = np.arange(len(text) + 1)
    row = at.copy() if last else np.zeros(len(text) + 1, np.int64)
    for i, w in enumerate(item):
        new = np.empty_like(row)
        new[0] = i + 1
        np.minimum(row[1:] + 1, row[:-1] + (text != w), out=new[1:])
        row = np.minimum.accumulate(new - at) + at
    best = row.min()
    return int(best), int(np.flatnonzero(row == best)[-1 if last else 0])


class Index:
    """The keys of items, and the search of texts for them. state() is plain data, from which load() makes the index again."""

    def __init__(self, items: list[tuple[int | None, bytes]], max_edits: float = MAX_EDITS):
        self.max_edits = max_edits
        made = [(item_id, t) for item_id, data in items if len(t := tokens(data))]
        self.ids, self.items = [i for i, _ in made], [t for _, t in made]
        starts = [(k, o) for k, t in enumerate(self.items) for o in sorted({int(len(t) * x) for x in OFFSETS}) if not o or len(t) - o >= LEAST_LEFT]
        classes: dict[int, list] = {}
        for k, o in starts:
            classes.setdefault(1 << ((len(self.items[k]) - o).bit_length() - 1), []).append((k, o))
        plans = []
        for size in sorted(classes):
            for e in range(EMBEDDINGS):
                for r in range(REPEATS):
                    rng = np.random.Generator(np.random.PCG64([size, e, r]))
                    steps = size if r == 0 else max(size, size + size // 2)
                    plans.append((e, np.sort(rng.permutation(steps)[:SAMPLED]), size))
        self.steps = {e: sorted({int(s) for k, at, _ in plans if k == e for s in at}) for e in range(EMBEDDINGS)}
        # all items one after the other, each followed by nothing for as long as its walks can go on
        padded = [np.concatenate([t, np.zeros(2 * len(t) + 8, np.uint64)]) for t in self.items]
        begins = np.cumsum([0, *map(len, padded)])
        words = np.concatenate([*padded, np.zeros(max((s[-1] for s in self.steps.values() if s), default=0) + 2, np.uint64)])
        self.keys = []
        for e in range(EMBEDDINGS):
            for size, of in sorted(classes.items()):
                walked = self._walk(words, np.array([begins[k] + o for k, o in of]), e)
                item, offset = np.array([k for k, _ in of], np.int32), np.array([o for _, o in of], np.int32)
                for at in (at for f, at, n in plans if f == e and n == size):
                    sig = self._key(walked, at)
                    order = np.argsort(sig, kind="stable")
                    bits = min(22, max(16, len(of).bit_length() + 5))
                    there = np.zeros(1 << bits, bool)
                    there[sig >> _U(64 - bits)] = True
                    self.keys.append((e, at, bits, there, sig[order], item[order], offset[order]))

    def state(self) -> tuple:
        return self.max_edits, self.ids, self.items, self.steps, self.keys

    @classmethod
    def load(cls, state: tuple) -> "Index":
        index = cls.__new__(cls)
        index.max_edits, index.ids, index.items, index.steps, index.keys = state
        return index

    def _walk(self, words: np.ndarray, pointer: np.ndarray, e: int) -> dict:
        """The sampled outputs of the walks that start at the words that pointer names."""
        out, pointer = {}, pointer.copy()
        bits, move = None, np.empty(len(pointer), np.uint64)
        wanted = set(self.steps[e])
        for s in range(max(wanted, default=-1) + 1):
            if s % 64 == 0:
                bits = mixed(words ^ _random(1000 + 64 * e + s // 64, 1)[0])
            if s in wanted:
                out[s] = np.take(words, pointer, mode="clip")
            np.take(bits, pointer, out=move, mode="clip")
            move >>= _U(s % 64)
            move &= _U(1)
            pointer += move.view(np.int64)
        return out

    @staticmethod
    def _key(out: dict, at: np.ndarray) -> np.ndarray:
        key = out[int(at[0])] * _FACTOR[0]
        for s, f in zip(at[1:], _FACTOR[1:]):
            key += out[int(s)] * f
        key ^= key >> _U(32)
        key *= _FACTOR[0]
        return key

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items and where they would start, for the windows that meet an item in a key."""
        starts, items = [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        ahead = max([s[-1] for s in self.steps.values() if s], default=0) + 2
        words = np.concatenate([words, np.zeros(ahead, np.uint64)])
        for lo in range(0, len(words) - ahead if self.keys else 0, STRIDE):
            n = min(STRIDE, len(words) - ahead - lo)
            part, begin = words[lo : lo + n + ahead], np.arange(n)
            outs = [self._walk(part, begin, e) for e in range(EMBEDDINGS)]
            for e, at, bits, there, sig, item, offset in self.keys:
                key = self._key(outs[e], at)
                p = np.flatnonzero(there[key >> _U(64 - bits)])
                if not len(p):
                    continue
                a, b = np.searchsorted(sig, key[p], "left"), np.searchsorted(sig, key[p], "right")
                n_each = b - a
                if n_each.any():
                    found = np.repeat(a, n_each) + np.arange(n_each.sum()) - np.repeat(np.cumsum(n_each) - n_each, n_each)
                    starts.append(lo + np.repeat(p, n_each) - offset[found])
                    items.append(item[found])
        return np.concatenate(starts), np.concatenate(items)

    def search(self, texts: list) -> list[list[tuple]]:
        """For each text its leaks: (item_id, item_words, distance, start_word, end_word), the best of each item."""
        places: list = []
        words = word_hashes(b" ".join([t or b"" for t in texts]).translate(_WORD), places)
        offsets = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
        first = np.searchsorted(np.concatenate(places) if places else np.empty(0, np.int64), offsets)
        best: list[dict] = [{} for _ in texts]
        start, item = self.candidates(words)
        of = np.maximum(np.searchsorted(first, start, "right") - 1, 0)
        slack = np.array([max(4, len(t) // 2) for t in self.items], np.int64)
        # windows of one item that start close to each other share the stretch that is compared
        tried = np.unique(np.stack([of, item, (start - first[of]) // slack[item]]), axis=1) if len(start) else np.empty((3, 0), np.int64)
        for of, k, step in tried.T.tolist():
            item, text, wide = self.items[k], words[first[of] : first[of + 1]], int(slack[k])
            lo, hi = max(0, (step - 1) * wide), min(len(text), (step + 3) * wide + len(item))
            most = int(self.max_edits * len(item))
            if len(np.setdiff1d(item, text[lo:hi])) > most:  # each word of the item that isn't there is an edit
                continue
            d, begin, end = distance(item, text[lo:hi])
            if d <= most:
                found = (d, lo + begin, lo + end)
                best[of][k] = min(best[of].get(k, found), found)
        return [[(self.ids[k], len(self.items[k]), *x) for k, x in sorted(b.items())] for b in best]


#: Bytes of text that are searched side by side.
GROUP = 1 << 20


def _grouped(texts: list):
    """Slices of the list with about GROUP bytes each."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= GROUP or i == len(texts) - 1:
            yield at, i + 1
            at, size = i + 1, 0


def _indexes(benchmark: DataFrame, item_id: str, text: str, max_edits: float):
    """Broadcast states of the indexes of all items, each of about ITEM_BYTES of texts; which one an item is in is what its hash says."""
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("binary").alias("data")).where("length(data) > 0").distinct()
    size = items.agg(F.sum(F.length("data"))).first()[0] or 0
    n = -(-size // ITEM_BYTES)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("id", "data"), F.lit(n)) == k).collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index([(r["id"], bytes(r["data"])) for r in rows], max_edits).state())


def leaks(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, item_words, distance, start_word, end_word) for each document and item of which it holds a passage: the best such passage, in words, end exclusive."""
    kinds = {"doc_id": pa.int64(), "item_id": pa.int64(), "item_words": pa.int32(), "distance": pa.int32(), "start_word": pa.int32(), "end_word": pa.int32()}

    def searcher(shared):
        def run(batches):
            index = Index.load(shared.value)
            for b in batches:
                ids, texts, rows = b.column(0).to_pylist(), b.column(1).to_pylist(), []
                for lo, hi in _grouped(texts):
                    rows += [(ids[lo + i], *x) for i, xs in enumerate(index.search(texts[lo:hi])) for x in xs]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], names=list(kinds))

        return run

    rows = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary"))
    schema = "doc_id long, item_id long, item_words int, distance int, start_word int, end_word int"
    found = [rows.mapInArrow(searcher(shared), schema) for shared in _indexes(benchmark, item_id, text, max_edits)]
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    for other in found[1:]:
        found[0] = found[0].union(other)
    return found[0]


def drop_leaks(docs: DataFrame, benchmark: DataFrame, max_edits: float = MAX_EDITS, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """docs without the rows that hold a passage of a benchmark item, as they are."""
    at = docs.columns.index(text)

    def searcher(shared):
        def run(batches):
            index = Index.load(shared.value)
            for b in slices(batches, at):
                found = index.search(b.column(at).cast(pa.binary()).to_pylist())
                yield b.filter(pa.array([not x for x in found], pa.bool_()))

        return run

    for shared in _indexes(benchmark, item_id, "text", max_edits):
        docs = docs.mapInArrow(searcher(shared), docs.schema)
    return docs
