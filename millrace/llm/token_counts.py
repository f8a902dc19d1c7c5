"""Token counts by overlap resynchronisation.

A document of up to `chunk_chars` characters is one chunk. A longer one is cut into chunks that
overlap; each is encoded by itself with offsets, and neighbours are spliced at a boundary that is
stable in both: a place between white space and a word, before which both encodings hold the same
tokens back to an earlier such place. Where an overlap has no such pair the overlap doubles, up to
one chunk over both parts, so a document without white space is still counted exactly.

The splice is proven for tokenizers that drop ASCII white space before they merge, so that no token
crosses it and what stands on one side can't change the other. That is read from the vocabulary file
(`drops_space`), and the same fact lets texts share the counts of repeated pieces. With any other
tokenizer each text is encoded as one.

Edge cases: ties do not matter (each row stands alone); null text counts as empty (0 bytes, 0 tokens, not over the limit); white space alone
gives 0 tokens; repeated rows are counted one by one; an empty table gives an empty table; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import ship

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
#: Bytes of distinct pieces that a worker remembers at a time, and what one costs besides its own bytes; a memory
#: bound without effect on results.
REMEMBERED, _EACH = 1 << 27, 160
_SPACE = " \t\n\x0b\x0c\r"
_START = re.compile(r"(?<=[ \t-\r])[^ \t-\r]")
_loaded: dict[str, "Encoder"] = {}


def drops_space(spec: dict) -> bool:
    """Whether the tokenizer's first rule drops ASCII white space and splits there, whatever stands beside it.

    Normalizers before it may only work on characters or turn white space into a space, and added tokens
    may not take white space in.
    """
    import regex

    def flat(rule: dict | None, key: str) -> list[dict]:
        return [x for r in rule[key] for x in flat(r, key)] if rule and key in rule else [rule] if rule else []

    def harmless(rule: dict) -> bool:
        blank = rule["type"] == "Replace" and rule["pattern"] == {"Regex": r"\s+"} and rule["content"] == " "
        return blank or rule["type"] in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase")

    rules = flat(spec.get("pre_tokenizer"), "pretokenizers")
    first = rules[0] if rules else {"type": None}
    splits = first["type"] in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer")
    if first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and "Regex" in first["pattern"]:
        pieces = regex.findall(first["pattern"]["Regex"], "".join(f"{c}a{c}1{c}!{c}'s{c}{c}" for c in _SPACE))
        splits = not any(c in p for c in _SPACE for p in pieces)
    tokens = spec.get("added_tokens") or []
    return splits and all(map(harmless, flat(spec.get("normalizer"), "normalizers"))) and not any(set(t["content"]) & set(_SPACE) or t["lstrip"] or t["rstrip"] for t in tokens)


class Encoder:
    """The tokenizers library for one vocabulary file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.splits = drops_space(json.loads(self.library.to_str()))
        self.known: dict[bytes, int] = {}
        self.room = REMEMBERED

    def spans(self, text: str, at: int = 0) -> list[tuple[int, int, int]]:
        """(start, end, id) of each token, in characters of the whole document."""
        e = self.library.encode(text, add_special_tokens=False)
        return [(at + s, at + t, i) for (s, t), i in zip(e.offsets, e.ids, strict=True)]

    def learn(self, pieces: set[bytes]) -> None:
        """Count the tokens of pieces without white space that are not known yet."""
        if self.room < 0:
            self.known.clear()
            self.room = REMEMBERED
        new = [p for p in pieces if p not in self.known]
        self.room -= sum(map(len, new)) + _EACH * len(new)
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            found = self.library.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            self.known.update(zip(part, map(len, found), strict=True))


def splice(left: list[tuple[int, int, int]], right: list[tuple[int, int, int]], text: str, lo: int, hi: int) -> tuple[int, list[tuple[int, int, int]]] | None:
    """The last stable boundary in text[lo:hi] and the tokens of both chunks, joined there; None without one.

    lo is the start of the right chunk and hi the end of the left one.
    """
    places = [m.start() for m in _START.finditer(text, lo + 1, hi)]
    if len(places) < 2:
        return None
    a, b = {s: k for k, (s, _, _) in enumerate(left)}, {s: k for k, (s, _, _) in enumerate(right)}
    for p0, p in zip(reversed(places[:-1]), reversed(places[1:]), strict=True):
        if all(x in y for x in (p0, p) for y in (a, b)) and left[a[p0] : a[p]] == right[b[p0] : b[p]]:
            return p, left[: a[p]] + right[b[p] :]
    return None


def encode_long(encoder: Encoder, text: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> list[tuple[int, int, int]]:
    """Token spans of a whole text, chunk by chunk."""
    end = min(chunk_chars, len(text))
    begin, done = 0, encoder.spans(text[:end])
    settled: list[tuple[int, int, int]] = []
    while end < len(text):
        overlap, joined = overlap_chars, None
        stop = min(end + chunk_chars, len(text))
        while joined is None:
            start = max(begin, end - overlap)
            right = encoder.spans(text[start:stop], start)
            joined = (begin, right) if start == begin else splice(done, right, text, start, end)
            overlap *= 2
        # what lies before the boundary can no longer change, and an encoding can start again there
        begin, done = joined
        keep = next((k for k, (s, _, _) in enumerate(done) if s >= begin), len(done))
        settled += done[:keep]
        done = done[keep:]
        end = stop
    return settled + done


def count_batches(batches: Iterator[pa.RecordBatch], path: str, limit: int, chunk_chars: int, overlap_chars: int) -> Iterator[pa.RecordBatch]:
    encoder = _loaded.get(path) or _loaded.setdefault(path, Encoder(path))
    for batch in batches:
        sizes, counts = [], []
        for part in range(0, batch.num_rows, 256):
            texts = [t or "" for t in batch.column(1).slice(part, 256).to_pylist()]
            if not encoder.splits:
                counts += [len(encoder.library.encode(t, add_special_tokens=False)) for t in texts]
                sizes += [len(t.encode()) for t in texts]
                continue
            split = [None if len(t) > chunk_chars else t.encode().split() for t in texts]
            encoder.learn(set().union(*(s for s in split if s)))
            known = encoder.known.__getitem__
            counts += [len(encode_long(encoder, t, chunk_chars, overlap_chars)) if s is None else sum(map(known, s)) for t, s in zip(texts, split, strict=True)]
            sizes += [len(t.encode()) for t in texts]
        n = pa.array(counts, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), n, pa.array([c > limit for c in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """Bytes and tokens of each whole text; one narrow stage without a shuffle."""
    ship(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(lambda batches: count_batches(batches, path, limit, chunk_chars, overlap_chars), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
