"""BPE encoding and decoding with a tokenization automaton.

The automaton reads tokens; it accepts a token sequence exactly when the sequence is the BPE
tokenization of the word it spells. It starts with one state and an arc for every base symbol. The
merges are then compiled in order, each as a gadget: for u v -> w, the state after u loses its arc v;
a state for w is made as a copy of the state after v; and every state with an arc u gets an arc w.
A copied state or arc is kept as a reference to its origin and the time of the copy, so the compiled
table has one entry for each merge, and an arc is looked up by following the copies back
(`Automaton.arc`); arcs that have been looked up stay in a table.

A word is encoded from left to right by table-driven transitions: the last token of each prefix is
the one token that ends there and has an arc from the state its start was left in. A trie of the labels, read
from their ends, gives those that end at a place and no others. Since the automaton
is deterministic, there is exactly one. Decoding emits the labels of the arcs on the path.

Text is normalised and split as the tokenizer file says (NFC, white space, lower case; letters, digits,
the rest). Defined cases: null is the empty text, which has no tokens. Special tokens in a text are
split off before all else and keep their id. Very long words are encoded like others.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forumlens.llm.common import drop_columns, map_batches

#: Words of a generation, of which a Python worker remembers two, and arcs that it remembers. Results don't depend on them.
REMEMBERED, ARCS = 150_000, 400_000
#: Rows that a worker holds the tokens of at once.
ROWS = 256
#: Here the Unicode versions of Python and of the tokenizers library part: the library's own normaliser and splitter read such texts.
LATER = re.compile("[\u0530-\U0010ffff]")
#: Marks a word that is given in byte symbols; no text word begins so.
BYTES = "\n"


class Automaton:
    """Base symbols are numbered by rank 0, merges by their time 1, 2, ...; `ids` gives the token ids."""

    def __init__(self, symbols: list[str], merges: list[tuple[str, str]], ids: dict[str, int]):
        self.ids = ids
        self.labels = list(symbols)
        self.number = {s: k for k, s in enumerate(symbols)}
        base = len(symbols)
        self.base = base
        self.parts: list[tuple[int, int]] = [(-1, -1)] * base
        self.cut: dict[tuple[int, int], int] = {}  # arcs that a gadget took away, and when
        self.known: dict[int, bool] = {}
        self.reached = [True] * base  # a token whose gadget found no path stays without arcs
        for left, right in merges:
            u, v, w = self.number[left], self.number[right], len(self.labels)
            if left + right in self.number or (u, v) in self.cut:
                raise ValueError(f"two merges make {left + right!r}")
            self.reached.append(self.reached[u] and self.reached[v] and self.arc(u, v))
            self.cut[u, v] = w
            self.labels.append(left + right)
            self.number[left + right] = w
            self.parts.append((u, v))
        self.known.clear()

    def arc(self, state: int, token: int) -> bool:
        """Whether the state after one token has an arc for another, now."""
        now = len(self.labels)
        while True:
            if self.cut.get((state, token), now) < now:
                return False
            if state > token and state >= self.base:  # the younger one was copied, at its time, from its part
                now = state
                state = self.parts[state][1]
            elif token >= self.base:
                now = token + 1  # of two equal merges that overlap, the left one is made
                token = self.parts[token][0]
            else:
                return True

    def compile(self, end: str) -> None:
        """A trie of the labels that are reached, read from their ends: one for labels with the mark `end`, one for the others."""
        self.end = end
        self.width = 1 + max(map(ord, "".join(self.labels)), default=0)
        self.tries: tuple[dict[int, int], dict[int, int]] = ({}, {})  # (node, symbol) -> node
        self.tokens: tuple[list[int], list[int]] = ([-1], [-1])  # the token whose label ends at a node, or -1
        for token, label in enumerate(self.labels):
            if not self.reached[token]:
                continue
            marked = bool(end) and label.endswith(end)
            trie, tokens, node = self.tries[marked], self.tokens[marked], 0
            for symbol in reversed(label[: len(label) - len(end)] if marked else label):
                key = node * self.width + ord(symbol)
                if key not in trie:
                    trie[key] = len(tokens)
                    tokens.append(-1)
                node = trie[key]
            tokens[node] = token
        if not end:
            self.tries, self.tokens = (self.tries[0],) * 2, (self.tokens[0],) * 2

    def path(self, word: str) -> list[int]:
        """The tokens of the path that spells `word`, whose last symbol carries the mark."""
        size = len(word)
        if not size:
            return []
        symbols = list(map(ord, word))
        last = [-1] * (size + 1)  # the state in which each prefix leaves the automaton
        width, known, count = self.width, self.known, len(self.labels)
        trie, tokens = self.tries[0], self.tokens[0]
        for stop in range(1, size + 1):
            if stop == size:
                trie, tokens = self.tries[1], self.tokens[1]
            node, start = 0, stop
            while start:
                start -= 1
                node = trie.get(node * width + symbols[start])
                if node is None:  # no label goes on
                    break
                token = tokens[node]
                if token < 0:
                    continue
                if start:  # one start fits, whatever the order
                    before = last[start]
                    if before < 0:
                        continue
                    step = before * count + token
                    fits = known.get(step)
                    if fits is None:
                        fits = known[step] = self.arc(before, token)
                    if not fits:
                        continue
                last[stop] = token
                break
        if len(known) > ARCS:
            known.clear()
        found, stop, end = [], size, len(self.end)
        while stop > 0:
            token = last[stop]
            found.append(token)
            stop -= len(self.labels[token]) - (end if stop == size else 0)
        return found[::-1]


def byte_symbols() -> list[str]:
    """The printable character that byte-level tokenizers write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Tokenizer:
    """A word-level BPE tokenizer from its file: normaliser, splitting, automaton, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        made = {a + b for a, b in merges}
        symbols = [s for s in model["vocab"] if s not in made]
        self.automaton = Automaton(symbols, merges, model["vocab"])
        self.automaton.compile(self.end)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(names) + ")") if names else None
        self.library = tokenizers.Tokenizer.from_file(path)
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(steps[0]["pattern"]["Regex"], regex.V0)
        self.bytes = byte_symbols()
        self.table = str.maketrans({chr(b): s for b, s in enumerate(self.bytes)})
        self.cache: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def normalise(self, text: str) -> str:
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        if "Σ" in text:  # character by character: no final sigma
            return "".join(map(str.lower, text))
        return text.lower()

    def word(self, symbols: str) -> tuple[int, str, str]:
        """Number of tokens, their ids and their labels, joined by spaces."""
        a = self.automaton
        labels = [a.labels[t] for t in a.path(symbols)]
        return len(labels), " ".join([str(a.ids[x]) for x in labels]), " ".join(labels)

    def split(self, text: str) -> list[str]:
        """The words of a text; those of later scripts come as the library's byte symbols."""
        if LATER.search(text) is None:
            return self.words.findall(self.normalise(text))
        clean = self.library.normalizer.normalize_str(text)
        return [BYTES + w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(clean)]

    def pieces(self, text: str) -> list[tuple[int, str, str]]:
        """For each word of the text what `word` gives."""
        parts = self.split_special.split(text) if self.split_special else [text]
        cache, found = self.cache, []
        for part in parts:
            if part in self.special:
                found.append((1, str(self.special[part]), part))
                continue
            words = self.split(part)
            if len(cache) > REMEMBERED:
                self.older, self.cache = cache, (cache := {})
            for w in set(words).difference(cache):
                cache[w] = self.older.get(w) or self.word(w[1:] if w[0] == BYTES else w.encode().decode("latin-1").translate(self.table))
            found += map(cache.__getitem__, words)
        return found

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for p in self.pieces(text or "") for i in p[1].split(" ")]

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined by spaces, since the tokenizer file names no decoder."""
        if not hasattr(self, "by_id"):
            self.by_id = {i: s for s, i in (self.automaton.ids | self.special).items()}
        return " ".join([self.by_id[i] for i in ids])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """Compiled once in each Python worker."""
    return Tokenizer(path)


def encode_documents(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """`docs` with `token_ids` and `decoded`; with `digests`, n_tokens, ids_sha256 and decoded_sha256 in their place.

    Input columns with the names of the new ones are replaced.
    """
    if digests:
        more = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    else:
        more = [("token_ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType())]
    docs = drop_columns(docs, *[n for n, _ in more])
    names = [*docs.columns, *[n for n, _ in more]]
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in batches:
            for begin in range(0, len(batch), ROWS):
                some = batch.slice(begin, ROWS)
                numbers, ids_of, decoded_of = [], [], []
                for text in some.column(place):
                    pieces = coder.pieces(text.as_py() or "")
                    ids = " ".join([p[1] for p in pieces])
                    decoded = " ".join([p[2] for p in pieces])
                    if digests:
                        numbers.append(sum([p[0] for p in pieces]))
                        ids, decoded = sha256(ids.encode()).hexdigest(), sha256(decoded.encode()).hexdigest()
                    else:
                        ids = np.fromstring(ids, np.int32, sep=" ") if ids else np.zeros(0, np.int32)
                    ids_of.append(ids)
                    decoded_of.append(decoded)
                if digests:
                    new = [pa.array(numbers, pa.int64()), pa.array(ids_of, pa.string())]
                else:
                    ends = np.cumsum([0, *map(len, ids_of)], dtype=np.int32)
                    new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids_of)))]
                yield pa.RecordBatch.from_arrays([*some.columns, *new, pa.array(decoded_of, pa.string())], names=names)

    return map_batches(docs, run, [T.StructField(n, t) for n, t in more])
