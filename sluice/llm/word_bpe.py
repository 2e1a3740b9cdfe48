"""Token ids of a public vocabulary with word ends, by ``tiktoken``'s merge loop on the distinct words of a task.

``tokenizers`` splits and merges every word of every text anew. Words repeat, and each is merged on its own, so a worker
keeps the ids of what it has met between white space, and of the words in it, for its next tasks too. Ids equal those of ``tokenizers`` (tested); texts with characters outside the
scripts listed here, or with a special token's string, are left to it.
"""

from __future__ import annotations

import json
import sys
import types
import unicodedata
from array import array
from collections.abc import Callable

import public_tokenizers
import regex

#: Words, and strings between white space, whose ids a worker keeps.
KEPT = 1 << 19

# How the vocabulary's own file splits normalised text; white space is dropped.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"

#: Beyond Latin, Greek, Cyrillic, general punctuation and currency signs, tables of characters differ between libraries;
#: four control characters are white space to Python alone.
OTHER = regex.compile(r"[^\x00-\x1b\x20-ԯ‐-‧‰-⁞₠-₿]")


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Ids(dict):
    """Ids by string, made by ``make`` when first asked for; forgotten when there are too many."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make

    def __missing__(self, key: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        self[key] = out = self.make(key)
        return out


class WordBpe:
    """``ids(text)``: the ids as little-endian unsigned 32-bit bytes. Holds no cycle of references, so it goes at once."""

    def __init__(self, tokenizer: str):
        import tiktoken

        self.path = public_tokenizers.path(f"{tokenizer}.json") if "/" not in tokenizer else f"{tokenizer}.json"
        with open(self.path, encoding="utf-8") as f:
            given = json.load(f)
        self.special, self.whole = [t["content"] for t in given["added_tokens"]], None
        vocabulary, merges, letters = given["model"]["vocab"], given["model"]["merges"], byte_letters()
        # a symbol is a byte inside a word or at its end; two bytes of a kind of their own each stand for it
        symbol = {}
        for last in (0, 1):
            for b, c in enumerate(letters):
                n = 256 * last + b
                symbol[c + "</w>" * last] = bytes([n >> 4, 32 + (n & 15)])
        ranks = {s: vocabulary[c] for c, s in symbol.items()}
        for a, b in merges:
            symbol[a + b] = symbol[a] + symbol[b]
            ranks[symbol[a + b]] = vocabulary[a + b]
        spare = max(ranks.values()) + 1
        ranks |= {bytes([n]): spare + n for n in range(48)}
        core = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        inner, ends = [symbol[c] for c in letters], [symbol[c + "</w>"] for c in letters]

        def word_ids(word: str) -> bytes:
            b = word.encode()
            return array("I", core._encode_single_piece(b"".join([inner[x] for x in b[:-1]]) + ends[b[-1]])).tobytes()

        words, split = Ids(word_ids), regex.compile(SPLIT).findall

        def chunk_ids(chunk: str) -> bytes:
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
            return b"".join(map(words.__getitem__, split(chunk)))

        self.words, self.chunks = words, Ids(chunk_ids)

    def ids(self, text: str) -> bytes:
        if OTHER.search(text) or any(s in text for s in self.special):
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.chunks.__getitem__, text.split()))


def kept(tokenizer: str) -> WordBpe:
    """The worker process's own, made by the first of its tasks that asks for it."""
    own = sys.modules.setdefault("sluice_kept", types.ModuleType("sluice_kept")).__dict__
    if tokenizer not in own:
        own[tokenizer] = WordBpe(tokenizer)
    return own[tokenizer]
