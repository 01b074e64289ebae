"""Token counts by greedy longest match, in one pass over the characters of a word.

A trie of the vocabulary gets failure links: where no child fits, the longest tokens of what was read are popped and
matching goes on in the node of the rest. Only how many tokens a link pops is kept, so pieces are never built. Each
character is read once, and pops are paid for by the characters read, so a word costs time linear in its length.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tapelake.llm.common import whole_text

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
WORD_END = "</w>"
#: How the vocabulary's tokenizer cuts lower-case text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Words kept with their counts per task, and the longest kept; both bound memory only.
KEPT_WORDS = 400_000
KEPT_LENGTH = 48


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def symbols(word: bytes) -> list[int]:
    """A word's bytes; the last one, as a word's end, is a symbol of its own."""
    return [*word[:-1], 256 + word[-1]]


def read_vocabulary(path: str) -> list[tuple[int, ...]]:
    """The tokens of a vocabulary file with word ends, as symbols; special tokens, which text never yields, left out."""
    letters = byte_letters()
    out = []
    for token in json.loads(Path(path).read_text(encoding="utf-8"))["model"]["vocab"]:
        ends = token.endswith(WORD_END)
        body = token.removesuffix(WORD_END)
        if body and all(c in letters for c in body) and not (body.startswith("<|") and body.endswith("|>")):
            raw = bytes(letters[c] for c in body)
            out.append(tuple(symbols(raw)) if ends else tuple(raw))
    return out


class Automaton:
    """Trie with failure links; ``child[node * 512 + symbol]``, ``fail[node]`` (-1: none), ``pops[node]``."""

    def __init__(self, vocabulary: Iterable[tuple[int, ...]]):
        self.child: dict[int, int] = {}
        tokens = [False]
        for token in vocabulary:
            node = 0
            for s in token:
                node = self.child.setdefault(node * 512 + s, len(tokens))
                if node == len(tokens):
                    tokens.append(False)
            tokens[node] = True
        below: list[list[tuple[int, int]]] = [[] for _ in tokens]
        for key, node in self.child.items():
            below[key // 512].append((key % 512, node))
        self.fail, self.pops = [-1] * len(tokens), [0] * len(tokens)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for s, node in below[parent]:
                queue.append(node)
                if tokens[node]:
                    self.fail[node], self.pops[node] = 0, 1
                    continue
                popped, back = self.pops[parent], self.fail[parent]
                while back >= 0 and (onward := self.child.get(back * 512 + s)) is None:
                    popped, back = popped + self.pops[back], self.fail[back]
                if back >= 0:
                    self.fail[node], self.pops[node] = onward, popped

    def count(self, word: Iterable[int]) -> int:
        """Tokens of a word; one, the unknown token, if the greedy match gets stuck."""
        child, fail, pops = self.child, self.fail, self.pops
        node = n = 0
        for s in word:
            while (onward := child.get(node * 512 + s)) is None:
                if fail[node] < 0:
                    return 1
                n += pops[node]
                node = fail[node]
            node = onward
        while node:
            if fail[node] < 0:
                return 1
            n += pops[node]
            node = fail[node]
        return n


class Counts(dict):
    """Token counts of words met, filled on demand."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(symbols(word.encode("utf-8", "surrogatepass")))
        if len(word) <= KEPT_LENGTH:
            self[word] = n
        return n


def text_counter(automaton: Automaton) -> Callable[[str], tuple[int, int]]:
    """A function from a text to its words and tokens."""
    counts, find = Counts(automaton), regex.compile(WORDS).findall

    def count(text: str) -> tuple[int, int]:
        words = find(unicodedata.normalize("NFC", text).lower())
        total = sum(map(counts.__getitem__, words))
        if len(counts) > KEPT_WORDS:
            counts.clear()
        return len(words), total

    return count


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` for each row of ``docs(doc_id, text)``, in its order.

    Texts are brought to NFC, lower-cased, cut into words, and each word into the longest tokens from its left. Null,
    empty and blank texts count 0; repeated rows and null ids are counted like others; other columns are not read.
    ``vocabulary`` is the path of a file on the driver. Its automaton, bounded by the vocabulary, is broadcast.
    """
    # Sent with its class, so that executors need not have this package.
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Automaton(read_vocabulary(vocabulary))))
    kind = StructType([StructField("n_words", LongType(), False), StructField("n_tokens", LongType(), False)])

    @F.pandas_udf(kind)
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        count = text_counter(cloudpickle.loads(shared.value))
        for texts in batches:
            yield pd.DataFrame([count(t) for t in texts], columns=["n_words", "n_tokens"], dtype="int64")

    found = docs.select("doc_id", counted(whole_text()).alias("found"))
    return found.select("doc_id", "found.n_words", "found.n_tokens")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
