"""Byte-level BPE, encoded by speculation: greedy longest tokens first, exact merges only where they do not fit.

A text is split at added tokens and by the pre-tokenizer's pattern into words. For each distinct word a greedy walk
proposes the longest token at every place. A proposal is the exact encoding if every token stands for itself and every
adjacent pair is compatible: undoing the later of the two border merges step by step never shows a merge across the
border that would have come first. All new pairs of a batch are tested together with array operations. Words with a
failing pair are merged exactly. Words are remembered in a table of bounded size.

The rule files are read on each executor from ``path``, a parameter. Only the layout of byte-level BPE with no
normalizer and no prefix space is accepted.

Defined cases: a null or empty text has no tokens and decodes to the empty text. Other columns pass through or are
left out; nulls in them do not matter. Repeated rows encode alike. Texts of any length are whole; a word of any length
is merged in O(n log n). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The pre-tokenizer's pattern (fixed by the file format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words held in a worker's table, by count and characters, before it starts afresh.
TABLE_WORDS, TABLE_CHARS = 600_000, 16_000_000
#: Characters handled at a time.
GROUP_CHARS = 1_000_000
NEVER = 1 << 40


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    """Encodes words and decodes ids. Inside, tokens are numbered in the order of their merges; single bytes come first."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        model, pre = rules["model"], rules["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or rules["normalizer"]:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bytes = [bytes([b]) for b in range(256)] + [raw(a + b) for a, b in merges]
        self.index = {t: i for i, t in reversed(list(enumerate(self.bytes)))}
        ids = {raw(t): i for t, i in vocab.items()}
        self.ids = np.array([ids[t] for t in self.bytes], dtype="<u4")
        self.left = np.array([-1] * 256 + [self.index[raw(a)] for a, _ in merges])
        self.right = np.array([-1] * 256 + [self.index[raw(b)] for _, b in merges])
        n = np.int64(len(self.bytes))
        keys = self.left[256:] * n + self.right[256:]
        order = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_merge = keys[order], order + 256
        self.merge = dict(zip(keys[::-1].tolist(), range(len(self.bytes) - 1, 255, -1)))
        self._grow_trie()
        self.own: dict[int, bool] = {}
        self.added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.split = regex.compile(PATTERN)
        self.spelled: dict[int, bytes] = {int(i): t for i, t in zip(self.ids, self.bytes)}
        self.spelled |= {i: t.encode() for t, i in self.added.items()}
        self.table: dict[str, bytes] = {}
        self.chars = 0
        #: Words proposed, and words that needed exact merges.
        self.proposed = self.merged = 0

    # - speculate

    def _grow_trie(self) -> None:
        """Edges (node * 256 + byte) sorted, the node each leads to, and the token each node spells (-1: none)."""
        nodes, spelled, edges = {b"": 0}, [-1], {}
        for token in self.index:
            node = 0
            for i, byte in enumerate(token):
                start = token[: i + 1]
                if start not in nodes:
                    nodes[start] = len(spelled)
                    spelled.append(-1)
                    edges[node * 256 + byte] = nodes[start]
                node = nodes[start]
            spelled[node] = self.index[token]
        self.edge_keys = np.array(sorted(edges))
        self.edge_to = np.array([edges[k] for k in self.edge_keys.tolist()])
        self.node_token = np.array(spelled)

    def greedy(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest tokens from the left for every word ``text[start:end]``: the words' numbers and the tokens, in order."""
        n = len(text)
        stop = np.repeat(ends, ends - starts)  # words lie end to end
        token, length = text.copy(), np.ones(n, np.int64)
        at = np.arange(n)
        node, depth = np.zeros(n, np.int64), 0
        while len(at):
            key = node * 256 + text[at + depth]
            edge = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            known = self.edge_keys[edge] == key
            at, node = at[known], self.edge_to[edge[known]]
            depth += 1
            found = self.node_token[node]
            whole = found >= 0
            token[at[whole]], length[at[whole]] = found[whole], depth
            more = at + depth < stop[at]
            at, node = at[more], node[more]
        owner, place, tokens = [], [], []
        word, cursor = np.arange(len(starts)), starts.copy()
        while len(word):
            owner.append(word)
            place.append(cursor)
            tokens.append(token[cursor])
            cursor = cursor + length[cursor]
            more = cursor < ends[word]
            word, cursor = word[more], cursor[more]
        order = np.argsort(np.concatenate(place), kind="stable")
        return np.concatenate(owner)[order], np.concatenate(tokens)[order]

    # - verify

    def _merges(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What each pair merges to, NEVER if it does not."""
        key = a * np.int64(len(self.bytes)) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_merge[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each adjacent pair of tokens: does merging their joined bytes give back just the two?"""
        good = np.zeros(len(a), bool)
        live = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), NEVER)
        while len(live):
            merge = self._merges(a, b)
            undo_left = a > b
            base = np.where(undo_left, a, b) < 256
            good[live[(merge >= limit) & base]] = True
            on = (merge >= limit) & ~base
            live, a, b, undo_left = live[on], a[on], b[on], undo_left[on]
            limit = np.where(undo_left, a, b + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return good

    def _stands(self, token: int) -> bool:
        """Whether the bytes of a token encode to the token alone."""
        if token not in self.own:
            self.own[token] = self.exact(self.bytes[token]) == [token]
        return self.own[token]

    # - exact merges

    def exact(self, word: bytes) -> list[int]:
        """Lowest merge first, leftmost among equals."""
        tok: list[int] = list(word)
        n, width = len(tok), len(self.bytes)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            m = self.merge.get(tok[i] * width + tok[i + 1])
            if m is not None:
                heap.append((m, i, tok[i], tok[i + 1]))
        heapq.heapify(heap)
        while heap:
            m, i, x, y = heapq.heappop(heap)
            j = after[i]
            if tok[i] != x or j >= n or tok[j] != y:
                continue
            tok[i], tok[j] = m, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q < n:
                    new = self.merge.get(tok[p] * width + tok[q])
                    if new is not None:
                        heapq.heappush(heap, (new, p, tok[p], tok[q]))
        return [t for t in tok if t >= 0]

    def exact_many(self, words: list[bytes]) -> list[np.ndarray]:
        """``exact`` for many short words side by side: one merge per word and step."""
        rows, width = len(words), max(map(len, words))
        sizes = np.array([len(w) for w in words])
        tok = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(rows, width).astype(np.int64)
        col = np.arange(width)
        after = np.broadcast_to(col + 1, (rows, width)).copy()
        before = np.broadcast_to(col - 1, (rows, width)).copy()
        alive = col < sizes[:, None]
        rank = np.full((rows, width), NEVER)
        if width > 1:
            rank[:, :-1] = np.where(alive[:, 1:], self._merges(tok[:, :-1], tok[:, 1:]), NEVER)
        live = np.arange(rows)
        while len(live):
            i = rank[live].argmin(axis=1)
            m = rank[live, i]
            live, i, m = live[m < NEVER], i[m < NEVER], m[m < NEVER]
            if not len(live):
                break
            j = after[live, i]
            tok[live, i] = m
            alive[live, j] = False
            rank[live, j] = NEVER
            k = after[live, j]
            after[live, i] = k
            inside = k < sizes[live]
            before[live[inside], k[inside]] = i[inside]
            rank[live, i] = NEVER
            r, x, y = live[inside], i[inside], k[inside]
            rank[r, x] = self._merges(tok[r, x], tok[r, y])
            h = before[live, i]
            r, x, y = live[h >= 0], h[h >= 0], i[h >= 0]
            rank[r, x] = self._merges(tok[r, x], tok[r, y])
        return [t[a] for t, a in zip(tok, alive)]

    # - texts

    def learn(self, words: set[str]) -> None:
        """Put words into the table: propose for all, test all pairs at once, merge the failing ones."""
        names = list(words)
        raws = [w.encode() for w in names]
        ends = np.cumsum([len(r) for r in raws])
        starts = np.concatenate([[0], ends[:-1]])
        owner, flat = self.greedy(np.frombuffer(b"".join(raws), np.uint8).astype(np.int64), starts, ends)
        first = np.flatnonzero(owner[1:] == owner[:-1])
        width = np.int64(len(self.bytes))
        pairs, back = np.unique(flat[first] * width + flat[first + 1], return_inverse=True)
        bad = np.zeros(len(names), bool)
        bad[owner[first[~self.compatible(pairs // width, pairs % width)[back]]]] = True
        tokens, where = np.unique(flat, return_inverse=True)
        bad[owner[~np.array([self._stands(int(t)) for t in tokens], bool)[where]]] = True
        ids = self.ids[flat].tobytes()
        to = np.cumsum(np.bincount(owner, minlength=len(names))) * 4
        table, at = self.table, 0
        for name, end in zip(names, to.tolist()):
            table[name] = ids[at:end]
            at = end
        failing = sorted(np.flatnonzero(bad).tolist(), key=lambda i: len(raws[i]))
        while failing:
            # Words of like length together; a long word goes alone.
            longest = len(raws[failing[0]]) * 2
            n = next((k for k, i in enumerate(failing) if len(raws[i]) > longest or k >= 20_000), len(failing))
            part, failing = failing[:n], failing[n:]
            if longest > 200:
                exact = [self.exact(raws[i]) for i in part]
            else:
                exact = self.exact_many([raws[i] for i in part])
            for i, t in zip(part, exact):
                table[names[i]] = self.ids[t].tobytes()
        self.chars += sum(map(len, names))
        self.proposed += len(names)
        self.merged += int(bad.sum())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, text by text."""
        out: list[bytes] = []
        group: list[list[str | bytes]] = []
        size = 0

        def flush():
            words = {w for parts in group for w in parts if type(w) is str}
            new = words.difference(self.table)
            if len(self.table) + len(new) > TABLE_WORDS or self.chars > TABLE_CHARS:
                self.table, self.chars, new = {}, 0, words
            if new:
                self.learn(new)
            table = self.table
            for parts in group:
                try:
                    out.append(b"".join(map(table.__getitem__, parts)))
                except KeyError:  # an added token is among them
                    out.append(b"".join(w if type(w) is bytes else table[w] for w in parts))

        for text in texts:
            text = text or ""
            if self.cut and self.cut.search(text):
                parts: list[str | bytes] = []
                for piece in self.cut.split(text):
                    parts += [self.added[piece].to_bytes(4, "little")] if piece in self.added else self.split.findall(piece)
            else:
                parts = self.split.findall(text)
            group.append(parts)
            size += len(text)
            if size >= GROUP_CHARS:
                flush()
                group, size = [], 0
        flush()
        return out

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker and file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of about GROUP_CHARS characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= GROUP_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        values = batch.column(column).to_pylist()
        for lo, hi in _groups(values):
            yield batch.slice(lo, hi - lo), values[lo:hi]


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(``key``, ``ids`` array<int>) of every whole text."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _slices(batches, "text"):
            ids = codec(path).encode(texts)
            offsets = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(pa.array(offsets), values)], ["key", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "key long, ids array<int>").withColumnRenamed("key", key)


def decode(coded: DataFrame, key: str = "doc_id", path: str | None = None) -> DataFrame:
    """(``key``, ``text``) from ``ids``; null ids give the empty text."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            texts = [codec(path).decode(np.array(x or [], "<u4").tobytes()) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    rows = coded.select(F.col(key).cast("long").alias("key"), "ids")
    return rows.mapInArrow(run, "key long, text string").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per text: its number of tokens and the digests of its ids and of what they decode to, in one pass."""
    path = path or default_path()
    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for batch, texts in _slices(batches, "text"):
            both = codec(path)
            ids = both.encode(texts)
            columns = [
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([sha(x) for x in ids], pa.string()),
                pa.array([sha(both.decode(x).encode()) for x in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    schema = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
