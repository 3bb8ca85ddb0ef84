"""BPE encoding by dynamic programming over prefixes, and decoding.

The tokenizer file gives the vocabulary, the merges and the splitting rules.
For every prefix of a piece of text there is exactly one token that can come
last in the prefix's encoding: among the tokens that end there (an automaton
with suffix links yields all of them) it is the one that is compatible with
the unique last token of the prefix before it.  Following these back-pointers
from the end gives the same ids as merging pair by pair.
"""

from __future__ import annotations

import hashlib
import json
import os.path
import re
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .text import lean
from .work import Work

#: Pieces that a Python worker remembers; it forgets all of them when there are more.
CACHE_PIECES = 300_000


class PrefixEncoder:
    """Encodes one piece of single-character symbols at a time from a vocabulary and ranked merges."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.suffix = suffix
        n = max(vocab.values()) + 1
        self.rank: dict[int, int] = {}  # of a pair, left << 20 | right
        # Of a token: the rank of the merge that makes it, and its parts; -1 for a symbol.
        self.order, self.left, self.right = (array("i", [-1]) * n for _ in range(3))
        for r, (a, b) in enumerate(merges):
            left, right, token = vocab[a], vocab[b], vocab[a + b]
            self.rank.setdefault(left << 20 | right, r)
            if self.order[token] < 0:
                self.order[token], self.left[token], self.right[token] = r, left, right
        self.pairs: dict[int, bool] = {}
        # The last symbol of a piece carries the suffix, written as one character here.
        self.end = "\U0010ffff"
        self.automaton = ahocorasick.Automaton()
        known: dict[int, bool] = {}
        for t, i in vocab.items():
            if not self.whole(i, known):  # merging never gives this token
                continue
            text = t.removesuffix(suffix) if suffix and t != suffix else t
            self.automaton.add_word(text if text == t else text + self.end, (i, len(text)))
        self.automaton.make_automaton()

    def compatible(self, left: int, right: int, limit: int) -> bool:
        """Whether merges of a rank below ``limit`` leave ``left`` and ``right`` apart when the two stand side by side."""
        rank, order = self.rank, self.order
        while True:
            r = rank.get(left << 20 | right)
            if r is not None and r < limit:
                return False
            a, b = order[left], order[right]
            if a < 0 and b < 0:
                return True
            # Undo the later of the two merges.  A merge across the border would have come first if its rank is
            # smaller; of equal ranks the leftmost comes first, so one as large as the right token's counts too.
            if a > b:
                limit, left = min(limit, a), self.right[left]
            else:
                limit, right = min(limit, b + 1), self.left[right]

    def whole(self, token: int, known: dict[int, bool]) -> bool:
        """Whether merging the token's own text gives the token."""
        if token not in known:
            left, right = self.left[token], self.right[token]
            known[token] = left < 0 or (self.whole(left, known) and self.whole(right, known) and self.compatible(left, right, self.order[token]))
        return known[token]

    def encode(self, piece: str) -> list[int]:
        """Ids of a non-empty piece of single-character symbols."""
        n, pairs = len(piece), self.pairs
        if len(pairs) > CACHE_PIECES // 2:
            pairs.clear()
        # Of each prefix: its last token and that token's size (0 while none is found).  Matches come by
        # their end, the longest first; the last symbol only exists with its suffix.
        last, size = [0] * (n + 1), [0] * (n + 1)
        final = n - 1 if self.suffix else n
        for at, (token, k) in self.automaton.iter(piece + self.end if self.suffix else piece):
            if at == final:
                continue
            end = at + 1 if at < final else n
            if size[end]:
                continue
            start = end - k
            if start:
                if not size[start]:
                    continue
                left = last[start]
                pair = left << 20 | token
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self.compatible(left, token, 1 << 60)
                if not fits:
                    continue
            last[end], size[end] = token, k
        if not size[n]:
            raise ValueError(f"no encoding for {piece!r}")
        ids = []
        while n:
            ids.append(last[n])
            n -= size[n]
        return ids[::-1]


#: The bytes that byte-level vocabularies write as themselves; the others follow from U+0100 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_symbols() -> list[str]:
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in _PLAIN else chr(next(others)) for b in range(256)]


#: Letters below U+0250, decimal digits, ASCII space, and the rest of printable ASCII: for these the fast split is exact.
_SIMPLE = re.compile(r"[\t\n\r -~ªµºÀ-ÖØ-öø-ɏ]*")


class Tokenizer:
    """Encodes and decodes whole texts as the file's tokenizer does (special strings in the text are their tokens)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.encoder = PrefixEncoder(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max([*model["vocab"].values(), *self.special.values()]))
        for t, i in [*model["vocab"].items(), *self.special.items()]:
            self.tokens[i] = t
        self.codes = [str(i) for i in range(len(self.tokens))]
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.mark = os.path.commonprefix(list(self.special)) if self.special else None  # texts without it hold no special string
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # The file's pattern in terms that hold for the simple characters above.
        plain = split.replace(r"[\p{L}]+", r"[^\W\d_]+").replace(r"[\p{N}]", r"\d").replace(r"[^\s\p{L}\p{N}]+", r"(?:[^\s\w]|_)+")
        self.plain = re.compile(plain)
        # All but the vocabulary, for texts with rare characters.
        self.rules = json.dumps(spec | {"model": model | {"vocab": {"a": 0}, "merges": []}, "added_tokens": []})
        self.symbols = byte_symbols()
        self.known: dict[str, tuple[int, ...]] = {}

    @cached_property
    def library(self):
        """The library's rules for rare characters: normal forms, letters and numbers."""
        from tokenizers import Tokenizer as Library

        return Library.from_str(self.rules)

    def pieces(self, text: str) -> list[str]:
        if _SIMPLE.fullmatch(text):
            return self.plain.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        return ["\0" + p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def piece(self, piece: str) -> tuple[int, ...]:
        """The piece's ids; ``\\0`` marks a piece in byte symbols already."""
        found = self.known.get(piece)
        if found is None:
            symbols = piece[1:] if piece[0] == "\0" else piece if piece.isascii() else "".join(self.symbols[b] for b in piece.encode())
            if len(self.known) > CACHE_PIECES:
                self.known.clear()
            found = self.known[piece] = tuple(self.encoder.encode(symbols))
        return found

    def encode(self, text: str) -> list[int]:
        known, piece = self.known, self.piece
        if self.mark is None or self.mark not in text:
            return list(chain.from_iterable([known.get(p) or piece(p) for p in self.pieces(text)]))
        ids, at = [], 0
        for m in self.marks.finditer(text):
            ids += chain.from_iterable([piece(p) for p in self.pieces(text[at : m.start()])])
            ids.append(self.special[m[0]])
            at = m.end()
        ids += chain.from_iterable([piece(p) for p in self.pieces(text[at:])])
        return ids

    def decode(self, ids: list[int]) -> str:
        """The file has no decoder: tokens joined by a space; unknown ids are left out."""
        n = len(self.tokens)
        return " ".join([self.tokens[i] for i in ids if 0 <= i < n])

    def text(self, text: str) -> tuple[list[int], str, str]:
        """(ids, ids joined by a space, the text that decoding them gives)."""
        ids = self.encode(text)
        return ids, " ".join(map(self.codes.__getitem__, ids)), " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


def _encode(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                yield _encoded(load(path), batch, with_ids)
        finally:  # workers outlive the stage; what they remember of a tokenizer should not
            load.cache_clear()

    return run


def _encoded(tokenizer: Tokenizer, batch: pa.RecordBatch, with_ids: bool) -> pa.RecordBatch:
    n, digest, decoded, lists = [], [], [], []
    for text in batch.column("text"):
        ids, said, back = tokenizer.text(text.as_py() or "")
        n.append(len(ids))
        digest.append(hashlib.sha256(said.encode()).hexdigest())
        decoded.append(hashlib.sha256(back.encode()).hexdigest())
        if with_ids:
            lists.append(np.array(ids, np.int32))
    columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        columns.append(pa.array(lists, pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)


def encode(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, unless turned off, ids, for every row.

    ``docs`` needs doc_id and text, ``path`` is a tokenizer file on every
    machine.  A null text is empty and has no ids; repeated rows and rows
    without doc_id come back as they are; other columns are ignored.
    """
    Work(docs.sparkSession, "bpe")
    shape = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(_encode(path, with_ids)), shape)


def decode(rows: DataFrame, path: str) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in batches:
            texts = [None if x is None else tokenizer.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir: str) -> DataFrame:
    """op4: all documents with the 49k word vocabulary."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), word_bpe(), with_ids=False)
