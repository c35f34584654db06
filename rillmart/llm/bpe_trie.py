"""BPE encoding by prefix-sharing trie traversal, and decoding.

A token sequence is the encoding of its text exactly if each token and each pair
of neighbours encodes to itself, so every prefix of a word has one last token:
the token that ends it and agrees with the last token of what precedes.  The
distinct words of a batch of texts go into a trie; a depth-first walk carries the
last tokens down, and words that share a prefix share its states.
"""

from __future__ import annotations

import gc
import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import released, strings, text_slices

SLICE = 3 << 20  # bytes of text whose new words share one trie
KNOWN = 300_000  # pairs of tokens remembered by a worker; forgotten all at once beyond, never skipped
KNOWN_BYTES = 192 << 20  # chunks of text and their ids remembered by a worker, forgotten alike
_SPACE = regex.compile(r"\p{White_Space}+")
_ODD_SPACE = regex.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    for k, b in enumerate(sorted(set(range(256)) - set(plain))):
        letters[chr(256 + k)] = b
    return letters



class WordBpe:
    """Encoder of a vocabulary with word ends, read from the tokenizers library's file format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.names: dict[int, str] = {i: name for name, i in model["vocab"].items()}
        letter = _byte_letters()
        self.letter_of = {b: c for c, b in letter.items()}

        def symbols(name: str) -> str:
            stem = name.removesuffix(suffix) if name.endswith(suffix) and name != suffix else name
            codes = [letter[c] for c in stem]
            if stem != name:
                codes[-1] += 256
            return "".join(map(chr, codes))

        self.token = {symbols(name): i for i, name in self.names.items()}
        self.text_of = {i: s for s, i in self.token.items()}
        vocab = model["vocab"]
        self.rank = {}
        for k, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[left], vocab[right]] = (k, vocab[left + right])
        self.special = {}
        for extra in spec["added_tokens"]:
            self.special[extra["content"]] = extra["id"]
            self.names[extra["id"]] = extra["content"]
        self.split_special = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._endings()
        self.agree: dict[int, bool] = {}
        self.chunks: dict[str | int, bytes] = {}
        self.held, self.limit = 0, KNOWN_BYTES  # bytes of ``chunks``

    def merge(self, text: str) -> list[int]:
        """Plain BPE of a string of symbols: the lowest merge first, the leftmost of equals."""
        parts = [self.token[c] for c in text]
        while len(parts) > 1:
            best = min((self.rank.get(pair, (1 << 60, 0)), k) for k, pair in enumerate(zip(parts, parts[1:])))
            if best[0][0] == 1 << 60:
                break
            k = best[1]
            parts[k : k + 2] = [best[0][1]]
        return parts

    def agrees(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``; ``left`` is -1 at a word's start."""
        key = (left + 1) << 32 | right
        known = self.agree.get(key)
        if known is None:
            if len(self.agree) > KNOWN:
                self.agree.clear()
            if left < 0:
                known = self.merge(self.text_of[right]) == [right]
            else:
                known = self.merge(self.text_of[left] + self.text_of[right]) == [left, right]
            self.agree[key] = known
        return known

    def _endings(self) -> None:
        """Automaton over the tokens: from a state and a symbol to the state of the longest
        token beginning that ends there, and the tokens that end at each state, longest first."""
        self.step: dict[int, int] = {}
        own, order = {0: None}, []
        for text, token in self.token.items():
            state = 0
            for symbol in text:
                key = state << 9 | ord(symbol)
                if key not in self.step:
                    self.step[key] = len(own)
                    own[len(own)] = None
                    order.append((state, ord(symbol), self.step[key]))
                state = self.step[key]
            own[state] = (token, len(text))
        depth = {0: 0}
        for before, _, state in order:
            depth[state] = depth[before] + 1
        self.back = [0] * len(own)
        self.ends: list[tuple] = [()] * len(own)
        for before, symbol, state in sorted(order, key=lambda x: depth[x[2]]):
            at = before
            while at:
                at = self.back[at]
                if (found := self.step.get(at << 9 | symbol)) is not None:
                    self.back[state] = found
                    break
            mine = (own[state],) if own[state] else ()
            self.ends[state] = mine + self.ends[self.back[state]]

    def encode_words(self, words: set[str]) -> dict[str, list[int]]:
        """Ids of distinct words given as strings of symbols."""
        trie: dict = {}
        deepest = 0
        for word in words:
            node = trie
            for symbol in word[:-1]:
                inner = node.get(symbol)
                if inner is None:
                    inner = node[symbol] = {}
                node = inner
            node[word[-1]] = word  # a word's last symbol is no other symbol
            deepest = max(deepest, len(word))
        out = {}
        last, start, states = [-1] * (deepest + 1), [0] * (deepest + 1), [0] * (deepest + 1)
        step, back, ends, agree, agrees = self.step, self.back, self.ends, self.agree, self.agrees
        stack = [(child, symbol, 1) for symbol, child in trie.items()]
        while stack:
            node, symbol, depth = stack.pop()
            state, code = states[depth - 1], ord(symbol)
            while (after := step.get(state << 9 | code)) is None and state:
                state = back[state]
            states[depth] = state = after or 0
            for token, size in ends[state]:
                before = last[depth - size]
                fits = agree.get(before + 1 << 32 | token)
                if fits or fits is None and agrees(before, token):
                    last[depth] = token
                    start[depth] = depth - size
                    break
            if type(node) is dict:
                depth += 1
                for symbol, child in node.items():
                    stack.append((child, symbol, depth))
            else:
                ids, at = [], depth
                while at:
                    ids.append(last[at])
                    at = start[at]
                ids.reverse()
                out[node] = ids
        return out

    def words_of(self, chunks: list[str]) -> list[list[str]]:
        """Normalised words of texts without white space, as strings of symbols."""
        clean = unicodedata.normalize("NFC", "\n".join(chunks))  # nothing composes with a line end
        if "\u03a3" in clean:
            clean = "".join([c.lower() for c in clean])  # letter by letter: no special final sigma
        else:
            clean = clean.lower()
        out = []
        for chunk in clean.split("\n"):
            raws = [word.encode() for word in self.word.findall(chunk)]
            out.append([raw[:-1].decode("latin-1") + chr(256 + raw[-1]) for raw in raws])
        return out

    def pieces(self, text: str) -> list[str | int]:
        """Chunks between white space, and ids of special tokens written in the text."""
        out: list[str | int] = []
        for part in self.split_special.split(text) if "<|" in text else (text,):
            if part in self.special:
                out.append(self.special[part])
            elif _ODD_SPACE.search(part):
                out.extend(x for x in _SPACE.split(part) if x)
            else:
                out.extend(part.split())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers."""
        known = self.chunks
        if self.held > self.limit:
            known.clear()
            self.held = 0
        split = [self.pieces(text) for text in texts]
        new = set().union(*split).difference(known)
        chunks = [x for x in new if isinstance(x, str)]
        words = self.words_of(chunks) if chunks else []
        codes = self.encode_words({w for ws in words for w in ws})
        for x in new.difference(chunks):
            known[x] = array("I", [x]).tobytes()
        for x, ws in zip(chunks, words):
            known[x] = ids = array("I", [i for w in ws for i in codes[w]]).tobytes()
            self.held += 180 + len(x) + len(ids)
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> str:
        """Text of ids: the tokens' strings with a space between, as the file names no decoder."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


@lru_cache(maxsize=1)
def encoder(path: str) -> WordBpe:
    return WordBpe(path)


def encode_decode(
    docs: DataFrame, vocabulary: str, slice_bytes: int = SLICE, known_bytes: int = KNOWN_BYTES, keep: bool = True
) -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` of each whole text.

    Equal to the tokenizers library with the file at ``vocabulary``, no special
    tokens added, truncation or padding.  A null or empty text has empty ``ids``
    and an empty ``decoded``; null ids and repeated rows are kept.  No shuffle:
    each worker keeps about ``known_bytes`` of encodings.  Results do not depend on ``slice_bytes``
    and ``known_bytes``; smaller ones take less memory and more time.
    Without ``keep`` a worker forgets the vocabulary and all encodings after each task.
    """

    def run(batches):
        gc.disable()  # tries have no cycles, and the collector would walk them again and again
        bpe = encoder(vocabulary)
        bpe.limit = known_bytes
        for rows in text_slices(batches, limit=slice_bytes):
            ids = bpe.encode(strings(rows))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())],
                ["doc_id", "ids", "decoded"],
            )
        gc.enable()
        if not keep:
            encoder.cache_clear()  # a worker that goes on to other stages needs the memory there

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        released(run), "doc_id long, ids binary, decoded string"
    )
