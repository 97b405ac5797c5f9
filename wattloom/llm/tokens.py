"""Token ids of texts with a public byte-level tokenizer.

The vocabulary file is that of the tokenizers library; merging is done by tiktoken with the same ranks, which gives the
same ids (the tests compare both) in about a quarter of the time on words not met before.

Inside a text, tokens break before every space that stands alone, so a text without two blanks in a row falls into words
that can be encoded apart. Workers remember the ids of recent words; new ones are strung together, encoded at once, and
cut apart again by the byte lengths of their tokens.

The file's added tokens (such as an end of text) have ids of their own. As the library does by default, operators split
texts at them first; `encode_special_tokens` takes their strings as ordinary text instead.
"""

from __future__ import annotations

import json
import re

import numpy as np

# Characters with the Unicode property White_Space, as the tokenizer's own pattern understands it.
BLANKS = frozenset(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                             0x205F, 0x3000]))
SPACE_AND_BLANK = re.compile(" [" + "".join(sorted(BLANKS)) + "]")
# Fixed value: the pattern by which the vocabulary's pre-tokenizer splits.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 400_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _bytes_by_character() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others, in order, from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(0x100 + i): b for i, b in enumerate(others)}}


class Encoder:
    """Encodes texts to ids, as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, remembered: int = REMEMBERED, encode_special_tokens: bool = True):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self._added = {} if encode_special_tokens else {
            content: np.array([i], dtype="<u4").tobytes() for content, i in special.items()}
        longest_first = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._split = re.compile(f"({'|'.join(longest_first)})") if self._added else None
        byte_of = _bytes_by_character()
        ranks = {bytes(map(byte_of.__getitem__, token)): i
                 for token, i in spec["model"]["vocab"].items() if token not in special}
        # What is left between added tokens is ordinary text.
        self._bpe = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._n_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self._n_bytes[i] = len(token)
        self._ids: dict[str, bytes] = {}
        self._remembered = remembered

    def _plain(self, text: str) -> bytes:
        return np.array(self._bpe.encode_ordinary(text), dtype="<u4").tobytes()

    def _learn(self, missing: set[str]) -> None:
        """Ids of words with a space before them."""
        joined = []
        for word in missing:
            if word and word[0] not in BLANKS and word[-1] not in BLANKS:
                joined.append(word)
            else:
                self._ids[word] = self._plain(" " + word)
        if joined:
            found = np.array(self._bpe.encode_ordinary(" " + " ".join(joined)), dtype="<u4")
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, joined)), dtype=np.int64, count=len(joined)) + 1)
            cuts = np.searchsorted(np.cumsum(self._n_bytes[found]), ends) + 1
            packed, start = found.tobytes(), 0
            for word, end in zip(joined, (4 * cuts).tolist()):
                self._ids[word] = packed[start:end]
                start = end

    def encode(self, texts: list[str]) -> list[bytes]:
        if self._split is None:
            return self._ordinary(texts)
        # At even places the stretches between added tokens, at odd ones these.
        cut = [self._split.split(text) for text in texts]
        found = iter(self._ordinary([part for parts in cut for part in parts[::2]]))
        return [b"".join(self._added[part] if i % 2 else next(found) for i, part in enumerate(parts)) for parts in cut]

    def _ordinary(self, texts: list[str]) -> list[bytes]:
        ids = self._ids
        if len(ids) > self._remembered:
            ids.clear()
        split, missing = [], set()
        for text in texts:
            words = None if SPACE_AND_BLANK.search(text) else text.split(" ")
            split.append(words)
            if words:
                known = list(map(ids.get, words))
                if None in known:
                    missing.update([word for word, value in zip(words, known) if value is None])
        if missing:
            self._learn(missing)
        get = ids.__getitem__
        return [
            self._plain(text) if words is None else self._plain(words[0]) + b"".join(map(get, words[1:]))
            for text, words in zip(texts, split)
        ]


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary file; those of added tokens are their strings'."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of, found = _bytes_by_character(), {}
    for token, i in spec["model"]["vocab"].items():
        found[i] = bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode()
    for token in spec["added_tokens"]:
        found[token["id"]] = token["content"].encode()
    return [found.get(i, b"") for i in range(max(found) + 1)]
