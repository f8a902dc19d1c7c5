"""Byte-pair encoding by a deterministic automaton, and decoding by its arc labels.

The automaton starts as one state with a loop for each byte. The merges are applied in order. The
gadget of a merge (a, b) acts on the state that `a` leads to: wherever `a` can be read, the new label
`ab` can be read too and leads where `b` leads, and `a` from now on leads to a clone of its target
that has lost the arc `b`. What is left at the end reads exactly the correct encodings, so each
prefix of a word has exactly one path, and one state: the target of the last label of that path.

A word is read byte by byte. At each byte the labels that end there are looked up (a goto table over all
labels gives the longest, and each label names the next shorter one), and the one whose arc leaves the
state of the place where it begins is the transition into this place. No place is entered twice and
nothing is taken back; the labels of the last place's path are the encoding. All tables are arrays, and the
new words of many texts take their steps together (`encode_words`); `encode_word` takes those of one word.

A clone differs from its original in one arc, so states are kept as differences: `lost[a, b]` is the
merge at which the target of `a` lost `b`, `born[t]` the merge that made `t`, and the target of `t`
builds on the target of its right part as it stood when `t` was made. An arc `t` exists where the arc
of its left part existed at that time. `step` reads this table.

Edge cases: very long texts are read piece by piece, and what a worker remembers of pieces is bounded by
their bytes; null text is empty (0 tokens); special strings inside a text are single tokens, as the
library's default is; ties and repeated rows do not matter (each row stands alone); an empty table
gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import ship

#: White space as the tokenizers library has it, and its pattern within other text.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
BLANK = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c))
#: Bytes of distinct segments and of their ids that a worker remembers at a time; a memory bound without
#: effect on results.
REMEMBERED = 128_000_000
#: Characters of text whose segments are encoded together, bytes of the longest words that step together, and
#: arcs that are held as a table at a time.
_STEP, TOGETHER, MOST_ARCS = 1 << 19, 64, 2_000_000
_NEVER = 1 << 30
_loaded: dict[str, "Automaton"] = {}


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Automaton:
    """Transitions and labels compiled from a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        import regex

        spec = json.loads(open(path, encoding="utf-8").read())
        as_byte = byte_of_char()
        vocab = spec["model"]["vocab"]
        raw = {s: bytes(as_byte[c] for c in s) for s in vocab if all(c in as_byte for c in s)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {vocab[s]: b for s, b in raw.items()} | {i: s.encode() for s, i in self.special.items()}
        self.ids = {bytes([b]): vocab[c] for c, b in as_byte.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.born: dict[int, int] = {}
        self.lost: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.gadget(rank, vocab[a], vocab[b], vocab[a + b])
        self.arcs: dict[int, bool] = {}
        self.compile_labels()
        special = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.specials = re.compile(f"({special})") if special else None
        self.segments = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall
        self.words = regex.compile(WORDS).findall
        self.known: dict[str, list[int]] = {}
        self.known_bytes = 0

    def gadget(self, rank: int, a: int, b: int, ab: int) -> None:
        """Add the label ab and redirect a, if a can be followed by b at this point at all."""
        if not self.follows(a, rank, b, rank):
            return
        if ab in self.born:
            raise ValueError(f"token {ab} has two merges; the automaton needs one for each token")
        self.left[ab], self.right[ab], self.born[ab] = a, b, rank
        self.lost[a << 20 | b] = rank
        self.ids[self.labels[ab]] = ab

    def follows(self, state: int, until: int, label: int, before: int) -> bool:
        """Whether the target of `state`, as it stood at merge `until`, has the arc `label`."""
        while True:
            u, limit = label, before
            while True:
                gone = self.lost.get(state << 20 | u)
                if gone is not None and gone < until and gone <= limit:
                    return False
                if u not in self.left:
                    break
                limit, u = self.born[u], self.left[u]
            if state not in self.right:
                return True
            until, state = self.born[state], self.right[state]

    def step(self, state: int, label: int) -> bool:
        key = state << 20 | label
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) > 2_000_000:
                self.arcs.clear()
            found = self.arcs[key] = self.follows(state, _NEVER, label, _NEVER)
        return found

    def compile_labels(self) -> None:
        """Goto table over all labels: `goto[node << 8 | byte]`, `fall[node]` where it has no entry, the longest
        label that ends at a node, each label's length, and the longest label that is a proper end of it."""
        goto: dict[int, int] = {}
        fall, ends = [0], [-1]
        by_depth: list[list[int]] = [[]]
        for label, t in self.ids.items():
            node = 0
            for depth, byte in enumerate(label):
                key = node << 8 | byte
                if key not in goto:
                    goto[key] = len(fall)
                    fall.append(0), ends.append(-1)
                    if depth == len(by_depth):
                        by_depth.append([])
                    by_depth[depth].append(key)
                node = goto[key]
            ends[node] = t
        size = {t: len(label) for label, t in self.ids.items()}
        shorter = dict.fromkeys(size, -1)
        for depth, keys in enumerate(by_depth):
            for key in keys:
                node, byte, up = goto[key], key & 255, fall[key >> 8]
                if depth:
                    while (k := up << 8 | byte) not in goto and up:
                        up = fall[up]
                    fall[node] = goto.get(k, 0)
                below = ends[fall[node]]
                if ends[node] < 0:
                    ends[node] = below
                else:
                    shorter[ends[node]] = below
        self.goto, self.fall, self.ends, self.size, self.shorter = goto, fall, ends, size, shorter
        keys = np.array(sorted(goto))
        self.goto_keys, self.goto_to = keys, np.array([goto[k] for k in keys.tolist()])
        self.fall_table, self.ends_table = np.array(fall), np.array(ends)
        most = max(size) + 1
        self.size_table, self.shorter_table = np.zeros(most, np.int64), np.full(most, -1)
        self.size_table[list(size)] = list(size.values())
        self.shorter_table[list(shorter)] = list(shorter.values())
        most = max(self.labels) + 1
        self.decimals, self.label_list = list(map(str, range(most))), [self.labels.get(t, b"") for t in range(most)]
        self.numbers = np.array([*range(most), None], object)  # each number once in memory; -1 is none
        self.arc_keys, self.arc_there = np.array([-1]), np.array([False])

    def encode_word(self, word: bytes) -> list[int]:
        """The labels of the one path that reads the word."""
        goto, fall, ends, size, shorter, arcs = self.goto, self.fall, self.ends, self.size, self.shorter, self.arcs
        if (t := self.ids.get(word)) is not None:
            return [t]
        path = [0] * (len(word) + 1)
        node = pos = 0
        for byte in word:
            pos += 1
            while (to := goto.get(node << 8 | byte)) is None:
                node = fall[node]
            node = to
            t = ends[to]
            while begin := pos - size[t]:
                key = path[begin] << 20 | t
                if (found := arcs.get(key)) is None:
                    found = self.step(path[begin], t)
                if found:
                    break
                t = shorter[t]
            path[pos] = t
        out = []
        while pos:
            out.append(t := path[pos])
            pos -= size[t]
        out.reverse()
        return out

    def arc(self, keys: np.ndarray) -> np.ndarray:
        """Whether there is an arc, for (state << 20 | label) keys; arcs that are new are read off the differences once."""
        if len(self.arc_keys) > MOST_ARCS:
            self.arc_keys, self.arc_there = self.arc_keys[:1], self.arc_there[:1]
        at = np.minimum(np.searchsorted(self.arc_keys, keys), len(self.arc_keys) - 1)
        new = self.arc_keys[at] != keys
        if new.any():
            more = np.sort(keys[new])
            more = more[np.append(True, more[1:] != more[:-1])]
            there = np.array([self.follows(k >> 20, _NEVER, k & 0xFFFFF, _NEVER) for k in more.tolist()])
            place = np.searchsorted(self.arc_keys, more)
            self.arc_keys, self.arc_there = np.insert(self.arc_keys, place, more), np.insert(self.arc_there, place, there)
            at = np.searchsorted(self.arc_keys, keys)
        return self.arc_there[at]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The encoding of each word, all of them one byte further at a time."""
        out: list[list[int]] = [[t] if (t := self.ids.get(w)) is not None else [] for w in words]
        todo = [k for k, w in enumerate(words) if w and not out[k] and len(w) <= TOGETHER]
        for k in (k for k, w in enumerate(words) if len(w) > TOGETHER and not out[k]):
            out[k] = self.encode_word(words[k])
        todo.sort(key=lambda k: -len(words[k]))
        if not todo:
            return out
        sizes = np.array([len(words[k]) for k in todo])
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words[k] for k in todo), np.uint8).astype(np.int64)
        n, longest = len(todo), int(sizes[0])
        path = np.zeros((longest + 1, n), np.int32)
        node = np.zeros(n, np.int64)
        for pos in range(1, longest + 1):
            m = int(np.searchsorted(-sizes, -pos, side="right"))  # words that are this long
            node, byte = node[:m], data[starts[:m] + pos - 1]
            open_ = np.arange(m)
            to = np.zeros(m, np.int64)
            while len(open_):
                key = node[open_] << 8 | byte[open_]
                at = np.minimum(np.searchsorted(self.goto_keys, key), len(self.goto_keys) - 1)
                hit = self.goto_keys[at] == key
                to[open_[hit]] = self.goto_to[at[hit]]
                open_ = open_[~hit]
                node[open_] = self.fall_table[node[open_]]
            node = to
            t = self.ends_table[node]
            open_ = np.arange(m)
            while len(open_):
                label = t[open_]
                begin = pos - self.size_table[label]
                there = begin == 0
                inner = np.flatnonzero(~there)
                there[inner] = self.arc(path[begin[inner], open_[inner]].astype(np.int64) << 20 | label[inner])
                open_ = open_[~there]
                t[open_] = self.shorter_table[t[open_]]
            path[pos, :m] = t
        place, live = sizes.copy(), np.arange(n)
        found: list[np.ndarray] = []
        while len(live):  # labels from the last to the first
            row = np.full(n, -1, np.int32)
            row[live] = path[place[live], live]
            found.append(row)
            place[live] -= self.size_table[row[live]]
            live = live[place[live] > 0]
        for k, row in zip(todo, self.numbers[np.array(found)[::-1].T].tolist(), strict=True):
            out[k] = row if row[0] is not None else [t for t in row if t is not None]
        return out

    def learn(self, segments: set[str]) -> None:
        """The ids of segments that aren't known; forgets all of them first if they take too much room."""
        if self.known_bytes > REMEMBERED:
            self.known.clear()
            self.known_bytes = 0
        known, get = self.known, self.known.get
        new = [s for s in segments if get(s) is None]
        whole = [s for s in new if s.isalpha() or s[1:].isalpha() and s[0] == " " or not s.strip(BLANK)]
        split = {s: self.words(s) for s in set(new).difference(whole)}
        words = list({w for ws in split.values() for w in ws}.union(whole))
        ids = dict(zip(words, self.encode_words([w.encode() for w in words]), strict=True))
        known.update({s: ids[s] for s in whole})
        known.update({s: [t for w in ws for t in ids[w]] for s, ws in split.items()})
        self.known_bytes += sum(150 + 2 * len(s) + 8 * len(known[s]) for s in new)

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """(piece, whether it is a special string) in order."""
        if self.specials is None or not any(s in text for s in self.special):
            yield text, False
            return
        for k, piece in enumerate(self.specials.split(text)):
            if piece:
                yield piece, bool(k % 2)

    def encode_segment(self, segment: str) -> list[int]:
        if segment.lstrip(" ").isalpha() or not segment.strip(BLANK):
            return self.encode_word(segment.encode())
        return [t for w in self.words(segment) for t in self.encode_word(w.encode())]

    def encode(self, text: str) -> list[int]:
        return [t for piece, special in self.parts(text) for t in ([self.special[piece]] if special else [t for s in self.segments(piece) for t in self.encode_segment(s)])]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")

    def pieces(self, text: str) -> list[tuple[list[str], bool]]:
        """(segments, whether they are a special string) of the parts of a text."""
        return [([piece] if special else self.segments(piece), special) for piece, special in self.parts(text)]

    def both(self, texts: list[str]) -> Iterator[tuple[int, bytes, bytes]]:
        """Of each text the number of ids, the ids in decimal, joined by commas, and the bytes of their arc labels."""
        every = [self.pieces(t) for t in texts]
        self.learn({s for parts in every for segments, special in parts if not special for s in segments})
        known, decimal, label = self.known.__getitem__, self.decimals.__getitem__, self.label_list.__getitem__
        for parts in every:
            ids: list[int] = []
            for segments, special in parts:
                ids += [self.special[segments[0]]] if special else chain.from_iterable(map(known, segments))
            yield len(ids), ",".join(map(decimal, ids)).encode(), b"".join(map(label, ids))


def automaton(path: str) -> Automaton:
    return _loaded.get(path) or _loaded.setdefault(path, Automaton(path))


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in runs of about _STEP characters."""
    run: list[str] = []
    room = _STEP
    for v in texts:
        run.append(v.as_py() or "")
        room -= len(run[-1])
        if room <= 0:
            yield run
            run, room = [], _STEP
    if run:
        yield run


def digest_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    machine = automaton(path)
    for batch in batches:
        counts, ids, texts = [], [], []
        for run in _slices(batch.column(1)):
            for n, codes, decoded in machine.both(run):
                counts.append(n)
                ids.append(hashlib.sha256(codes).hexdigest())
                texts.append(hashlib.sha256(decoded.decode("utf-8", "replace").encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def id_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    machine = automaton(path)
    for batch in batches:
        ids = [machine.encode(v.as_py() or "") for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])


def text_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    machine = automaton(path)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([machine.decode(v.as_py() or []) for v in batch.column(1)], pa.string())], ["doc_id", "text"])


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the token ids of each whole text."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(lambda b: id_batches(b, path), "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that the ids stand for."""
    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(lambda b: text_batches(b, path), "doc_id long, text string")


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode each whole text in one pass and return the digests of both."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(lambda b: digest_batches(b, path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
