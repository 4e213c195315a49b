"""Byte-level BPE: speculate by greedy longest match, verify pairs, merge the rest.

The vocabulary file is a parameter and never copied. A text is cut into
pre-tokens by the tokenizer's pattern; each distinct pre-token is proposed as
its greedy longest-match tokens. A proposal is the BPE encoding exactly when
each adjacent pair of tokens is the encoding of its own concatenation, so one
vectorised look-up over all adjacent pairs of a batch accepts almost every
pre-token; those with a failing pair go through exact merging. Encoded pieces
are remembered up to a bound, then forgotten and met anew.

Defined results: null text is empty text with no tokens; the strings of
special tokens in a text become their ids; texts and pre-tokens of any length
are encoded whole (merging uses a heap); repeated rows are encoded alike; an
empty table gives no rows; other columns pass untouched (columns named like
the outputs are replaced).
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, slices

# The pre-token pattern of byte-level BPE, with the white space class spelled out.
_WS = r"\t-\r\x20\x85\xa0  -     　"
_PRETOKEN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+"
    rf"|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
#: A space that does not stand directly before a visible character.
_LOOSE_SPACE = regex.compile(r" (?!\S)")
REMEMBER = 500_000


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Tokens, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = _byte_alphabet()
        self.ids = {bytes(to_byte[c] for c in tok): i for tok, i in spec["model"]["vocab"].items()
                    if all(c in to_byte for c in tok)}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = (bytes(to_byte[c] for c in x) for x in (m.split(" ") if isinstance(m, str) else m))
            self.merges[self.ids[a], self.ids[b]] = (rank, self.ids[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]
        self.longest = max(map(len, self.ids))
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for tok, i in self.ids.items():
            self.tokens[i] = tok
        for tok, i in self.special.items():
            self.tokens[i] = tok.encode()
        self.lens = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._special_cut = regex.compile("|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) \
            if self.special else None

    # -- exact and speculative encoding of one pre-token ------------------------------

    def merge(self, piece: bytes) -> list[int]:
        """Exact BPE by merge rank."""
        if len(piece) > 48:
            return self._merge_long(piece)
        ids = [self.byte_ids[b] for b in piece]
        look = self.merges.get
        found = [look(p) for p in zip(ids, ids[1:], strict=False)]
        while True:
            best = None
            for i, m in enumerate(found):
                if m is not None and (best is None or m < best):
                    best, at = m, i
            if best is None:
                return ids
            ids[at:at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = look((ids[at - 1], best[1]))
            if at < len(found):
                found[at] = look((best[1], ids[at + 1]))

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same over a heap of pairs and a linked list, for pieces of any length."""
        ids: list = [self.ids[piece[i:i + 1]] for i in range(len(piece))]
        nxt = list(range(1, len(ids) + 1))
        prv = list(range(-1, len(ids) - 1))
        heap = []
        for i in range(len(ids) - 1):
            m = self.merges.get((ids[i], ids[i + 1]))
            if m:
                heap.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue
            ids[i], ids[j] = made, None
            nxt[i] = nxt[j]
            if nxt[i] < len(ids):
                prv[nxt[i]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y < len(ids):
                    m = self.merges.get((ids[x], ids[y]))
                    if m:
                        heapq.heappush(heap, (m[0], x, ids[x], ids[y], m[1]))
        return [i for i in ids if i is not None]

    def greedy(self, piece: bytes) -> list[int]:
        """The longest token at each position."""
        out = []
        at, n, ids, longest = 0, len(piece), self.ids, self.longest
        while at < n:
            end = min(n, at + longest)
            while piece[at:end] not in ids:
                end -= 1
            out.append(ids[piece[at:end]])
            at = end
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of the decoded text; broken sequences become U+FFFD."""
        lens = self.lens[ids]
        total = int(lens.sum())
        at = np.repeat(self.starts[ids] - (np.cumsum(lens) - lens), lens) + np.arange(total)
        raw = self.blob[at].tobytes()
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids; remembers pieces and pairs."""

    def __init__(self, vocab: Vocabulary):
        self.v = vocab
        self.first: dict[str, bytes] = {}    # piece at the start of a section
        self.spaced: dict[str, bytes] = {}   # piece after one space
        self.words: dict[str, bytes] = {}    # pre-token
        self.pair_codes = np.zeros(0, np.int64)
        self.pair_good = np.zeros(0, bool)
        self.exact = 0                       # pre-tokens that needed exact merging

    def _compatible(self, codes: np.ndarray) -> np.ndarray:
        """Does each pair (left * size + right) encode to itself?"""
        size = len(self.v.tokens)
        distinct, back = np.unique(codes, return_inverse=True)
        at = np.searchsorted(self.pair_codes, distinct)
        at_safe = np.minimum(at, max(0, len(self.pair_codes) - 1))
        known = (self.pair_codes[at_safe] == distinct) if len(self.pair_codes) else \
            np.zeros(len(distinct), bool)
        new = distinct[~known]
        if len(new):
            tok = self.v.tokens
            good = np.array([self.v.merge(tok[c // size] + tok[c % size]) == [c // size, c % size]
                             for c in new.tolist()], bool)
            if len(self.pair_codes) > 2_000_000:
                self.pair_codes, self.pair_good = distinct[known], self.pair_good[at_safe[known]]
            codes_all = np.concatenate([self.pair_codes, new])
            order = np.argsort(codes_all)
            self.pair_codes = codes_all[order]
            self.pair_good = np.concatenate([self.pair_good, good])[order]
        return self.pair_good[np.searchsorted(self.pair_codes, distinct)][back]

    def _encode_words(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        proposed = [self.v.greedy(r) for r in raw]
        lens = np.array([len(p) for p in proposed], np.int64)
        flat = np.array([i for p in proposed for i in p], np.int64)
        bad = np.zeros(len(words), bool)
        if len(flat) > 1:
            word_of = np.repeat(np.arange(len(words)), lens)
            inside = np.flatnonzero(word_of[1:] == word_of[:-1])
            ok = self._compatible(flat[inside] * len(self.v.tokens) + flat[inside + 1])
            bad[word_of[inside[~ok]]] = True
        self.exact += int(bad.sum())
        for w, r, p, b in zip(words, raw, proposed, bad.tolist(), strict=True):
            self.words[w] = np.array(self.v.merge(r) if b else p, "<u4").tobytes()

    def _learn(self, missing: list[str], spaced: bool) -> None:
        cache = self.spaced if spaced else self.first
        cut = [_PRETOKEN.findall(f" {m}" if spaced else m) for m in missing]
        need = list({w for c in cut for w in c if w not in self.words})
        if need:
            self._encode_words(need)
        words = self.words
        for m, c in zip(missing, cut, strict=True):
            cache[m] = b"".join([words[w] for w in c])

    def _sections(self, text: str) -> list:
        """Stretches without special tokens, each cut before single spaces, and the
        ids of the special tokens between them. A single space before a visible
        character always begins a pre-token, so a text may be cut there."""
        def cut(part):
            return regex.split(r" (?=\S)", part) if _LOOSE_SPACE.search(part) else part.split(" ")

        special = self.v._special_cut
        if special is None or not special.search(text):
            return [cut(text)]
        out, at = [], 0
        for m in special.finditer(text):
            if m.start() > at:
                out.append(cut(text[at:m.start()]))
            out.append(np.array([self.v.special[m.group()]], "<u4").tobytes())
            at = m.end()
        if at < len(text):
            out.append(cut(text[at:]))
        return out

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; unknown pieces of all texts are learned together."""
        for cache in (self.first, self.spaced, self.words):
            if len(cache) > REMEMBER:
                cache.clear()
        cut = [self._sections(t) if t else [] for t in texts]
        heads, rest = set(), set()
        for sections in cut:
            for s in sections:
                if isinstance(s, list):
                    heads.add(s[0])
                    rest.update(s[1:])
        heads.difference_update(self.first)
        rest.difference_update(self.spaced)
        if heads:
            self._learn(list(heads), False)
        if rest:
            self._learn(list(rest), True)
        get, first = self.spaced.__getitem__, self.first
        return [b"".join([s if isinstance(s, bytes) else first[s[0]] + b"".join(map(get, s[1:]))
                          for s in sections]) for sections in cut]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per vocabulary file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(Vocabulary(path))
    return _ENCODERS[path]


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>) and ``n_tokens`` added; ``path`` is the
    vocabulary file, the same on every machine."""
    prepare(docs.sparkSession)
    docs = docs.drop("ids", "n_tokens")
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches):
        enc = encoder(path)
        for b in slices(batches, text_col):
            raw = enc.batch(b.column(text_col).to_pylist())
            lens = np.array([len(r) // 4 for r in raw], np.int64)
            off = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
            flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(flat)),
                 pa.array(lens)], names=[*b.schema.names, "ids", "n_tokens"])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (string) made from its ids."""
    prepare(encoded.sparkSession)
    encoded = encoded.drop("decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches):
        vocab = encoder(path).v
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                col = b.column(ids_col)
                flat = col.flatten().to_numpy(False).astype(np.int64)
                lens = np.diff(col.offsets.to_numpy(False))
                ends = np.cumsum(lens)
                texts = [vocab.decode(flat[e - n:e]).decode() for e, n in
                         zip(ends.tolist(), lens.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                                 names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids,
    in one pass over the texts."""
    prepare(docs.sparkSession)

    def run(batches):
        enc = encoder(path)
        for b in slices(batches, "text"):
            raw = enc.batch(b.column("text").to_pylist())
            back = [enc.v.decode(np.frombuffer(r, "<u4")) for r in raw]
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"),
                "n_tokens": pa.array([len(r) // 4 for r in raw], pa.int64()),
                "ids_sha256": [hashlib.sha256(r).hexdigest() for r in raw],
                "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in back]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
