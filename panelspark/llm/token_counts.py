"""Token counts of a byte-level BPE tokenizer by a shortcut for whole tokens.

A byte-level BPE first cuts a text into pre-tokens and then merges the bytes of
each on its own. Two tables are made once on the driver, from the tokenizer file:

* the vocabulary strings that the merges alone bring back to one token. A
  pre-token found there is one token and is never merged;
* the characters on which the cutting expression of the `regex` module and the
  cutting of the tokenizer's own library differ (versions of Unicode). A text
  that holds one of them is cut by the library.

Both are bounded by the vocabulary and by Unicode, not by the corpus. The other
pre-tokens are merged by the library's model, each once per task as long as the
task's memory of merged pre-tokens has room. Added special tokens inside a text
are found first, as the library does by default, and count as one token each.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelspark.llm import tokens

LIMIT = 512
#: Fixed value: how byte-level BPE cuts a text into pre-tokens.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Merged pre-tokens that a task remembers at most, and the longest of them in characters.
REMEMBERED, LONGEST = 200_000, 64
#: Characters of a text that are cut into pre-tokens at once.
PART = 1 << 20
#: Code points that Unicode can assign; surrogates stand in no text.
LAST, SURROGATES = 0x10FFFF, range(0xD800, 0xE000)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as itself, the others from U+0100 on in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


LETTERS = {b: letter for b, letter in enumerate(_byte_letters())}


def spelled(piece: str) -> str:
    """A pre-token as the vocabulary spells it."""
    return piece.encode().decode("latin-1").translate(LETTERS)


def _checked(config: dict) -> None:
    pre, model = config.get("pre_tokenizer") or {}, config.get("model") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and config.get("normalizer") is None
    merges = model.get("type") == "BPE" and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    added = all(not any(t.get(x) for x in ("single_word", "lstrip", "rstrip", "normalized")) for t in config.get("added_tokens", []))
    if not (plain and merges and added):
        raise ValueError("the shortcut is proved for plain byte-level BPE tokenizers only")


def whole_tokens(tokenizer: Tokenizer) -> frozenset[str]:
    """The texts that the merges bring to exactly one token, found by merging every vocabulary string that is valid UTF-8."""
    byte_of = {letter: b for b, letter in LETTERS.items()}
    found = set()
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        try:
            text = bytes(byte_of[x] for x in entry).decode()
        except (KeyError, UnicodeDecodeError):  # not an entry of bytes, or a part of a character: equal to no pre-token
            continue
        merged = tokenizer.model.tokenize(entry)
        if len(merged) == 1 and merged[0].value == entry:
            found.add(text)
    return frozenset(found)


def disputed(tokenizer: Tokenizer) -> str:
    """The characters that the expression and the library join differently with a letter, a digit or a mark, as ranges of a class.

    Characters that Python knows to be unassigned or private are not tried and count as disputed.
    """
    points, odd = [], []
    for c in chain(range(0, SURROGATES.start), range(SURROGATES.stop, LAST + 1)):
        (odd if unicodedata.category(chr(c)) in ("Cn", "Co") else points).append(chr(c))
    probe, cut = ("a", "1", "!"), regex.compile(PRE_TOKENS)
    for at in range(0, len(points), 4096):
        some = points[at : at + 4096]
        text = "".join(f"{p}{c}\n" for c in some for p in probe)
        theirs = {start for _, (start, _) in tokenizer.pre_tokenizer.pre_tokenize_str(text)}
        ours = {m.start() for m in cut.finditer(text)}
        odd += [c for i, c in enumerate(some) if any((9 * i + 3 * j + 1 in theirs) != (9 * i + 3 * j + 1 in ours) for j in range(3))]
    runs = []
    for c in sorted(map(ord, odd)):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in runs)


@lru_cache(maxsize=4)
def proved(path: str) -> tuple[str, frozenset[str], str]:
    """The tokenizer's file as text, its whole tokens and its disputed characters."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    _checked(json.loads(text))
    tokenizer = Tokenizer.from_str(text)
    return text, whole_tokens(tokenizer), disputed(tokenizer)


class _Lengths(dict):
    """Tokens of a pre-token: one for a whole token, else what the merges leave."""

    def __init__(self, whole: frozenset[str], model):
        super().__init__(dict.fromkeys(whole, 1))
        self.model, self.room = model, len(whole) + REMEMBERED

    def __missing__(self, piece: str) -> int:
        n = len(self.model.tokenize(spelled(piece)))
        if len(piece) <= LONGEST and len(self) < self.room:
            self[piece] = n
        return n


class Counter:
    """Counts the tokens of texts inside a task."""

    def __init__(self, text: str, whole: frozenset[str], odd: str):
        tokenizer = Tokenizer.from_str(text)
        self.library = tokenizer.pre_tokenizer
        self.lengths = _Lengths(whole, tokenizer.model)
        self.cut = regex.compile(PRE_TOKENS)
        self.between = regex.compile(r"(?<=\S) (?=\S)")
        self.odd = re.compile(f"[{odd}]")
        added = sorted((t["content"] for t in json.loads(text).get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None

    def _parts(self, text: str) -> Iterator[str]:
        """Runs of a text; one space between two other characters always begins a pre-token, so a cut there changes nothing."""
        at = 0
        while len(text) - at > PART:
            cut = self.between.search(text, at + PART)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def count(self, text: str) -> tuple[int, int]:
        """Tokens, and how many of the pre-tokens (special tokens aside) are one token."""
        pieces = self.special.split(text) if self.special else [text]
        total, single = len(pieces) - 1, 0
        for piece in pieces:
            for part in self._parts(piece):
                if not part.isascii() and self.odd.search(part):
                    found = [part[s:e] for _, (s, e) in self.library.pre_tokenize_str(part)]
                else:
                    found = self.cut.findall(part)
                lengths = list(map(self.lengths.__getitem__, found))
                total += sum(lengths)
                single += lengths.count(1)
        return total, single


def _counted(batches: Iterator[pa.RecordBatch], proof: tuple[str, frozenset[str], str]) -> Iterator[pa.RecordBatch]:
    counter = None
    for batch, _, offsets in tokens.blocks(batches, "_text"):
        counter = counter or Counter(*proof)
        texts = batch.column(batch.schema.get_field_index("_text")).to_pylist()
        n = np.array([counter.count(t) if t else (0, 0) for t in texts], np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(n[:, 0]), pa.array(n[:, 1])], names=["_id", "n_bytes", "n_tokens", "n_single"])


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Per row: id, n_bytes, n_tokens, n_single (pre-tokens that are one token) and over_limit.

    `path` names the tokenizer's file on the driver; other tokenizers than plain
    byte-level BPE are an error. One row for each row, repeated rows included. A
    NULL or empty text has 0 bytes and 0 tokens; a text of any length is counted
    whole; a NULL id stays NULL; an empty table gives an empty result. Other columns
    are not read, so their names cannot clash; an id column that bears a result's
    name is an error.
    """
    if id_col in ("n_bytes", "n_tokens", "n_single", "over_limit"):
        raise ValueError(f"the id column {id_col} has the name of a result")
    shared = docs.sparkSession.sparkContext.broadcast(proved(path))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = rows.schema["_id"].dataType.simpleString()
    counted = rows.mapInArrow(lambda b: _counted(b, shared.value), f"_id {id_type}, n_bytes bigint, n_tokens bigint, n_single bigint")
    return counted.select(F.col("_id").alias(id_col), "n_bytes", "n_tokens", "n_single", (F.col("n_tokens") > limit).alias("over_limit"))
