"""Token ids of texts by a public tokenizer file, with a cache of white-space separated chunks."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_BPE = "word_bpe_49k.json"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers put for each byte: printable ones stand for themselves, the rest follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class ChunkEncoder:
    """Ids of texts, equal to the tokenizer's own on the whole text.

    The tokenizer's pre-tokenisation never crosses a space or a line feed, so a
    text's ids are those of its chunks, joined. Chunks of a batch are told apart by
    Arrow and looked up in a cache of two generations of bounded size, so that frequent
    ones stay and others go. Unknown words of letters alone go
    straight to the tokenizer's merges, which is what its own steps come to for them
    (probed when it is loaded); all other chunks go through the whole tokenizer.
    """

    MOST = 150_000
    _TAIL = ".,!?;:"
    _PROBES = ("a", "tokenizer", "zqxjkv", "\u00e9t\u00e9", "\u00fcber", "\u4e2d\u6587", "\u044f\u0437\u044b\u043a", "internationalisation")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.sentence_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, i in vocabulary.items():
            if token.endswith("</w>"):
                self.sentence_end[i] = token[-5:-4] in (".", "!", "?")
        self.letters = _byte_letters()
        self.direct = all(self._merged(x) == self._whole([x])[0] and self._merged(x) + self._whole(["."])[0] == self._whole([x + "."])[0] for x in self._PROBES)
        self.cache: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: Iterable[str], chars: int = 2_000_000) -> Iterator[np.ndarray]:
        """uint32 ids of each text, in order."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append((text if "Σ" in text else text.lower()).replace("\n", " "))
            size += len(text)
            if size >= chars:
                yield from self._flush(held)
                held, size = [], 0
        if held:
            yield from self._flush(held)

    def _flush(self, held: list[str]) -> Iterator[np.ndarray]:
        if len(self.cache) > self.MOST:
            self.old, self.cache = self.cache, {"": b""}
        lists = pc.split_pattern(pa.array(held, pa.large_string()), " ")
        coded = lists.values.dictionary_encode()
        turn, bounds = coded.indices.to_numpy(), lists.offsets.to_numpy()
        pieces = self._pieces(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
        known = np.frombuffer(b"".join(pieces), dtype="<u4")
        first, n = (np.cumsum(size) - size)[turn], size[turn]
        ends = np.cumsum(n)
        ids = known[np.repeat(first - (ends - n), n) + np.arange(ends[-1])]
        ends = np.append(0, ends)[bounds]
        for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            yield ids[a:z]

    def _known(self, chunk: str) -> bytes | None:
        found = self.cache.get(chunk)
        if found is None:
            found = self.old.get(chunk)
            if found is not None:
                self.cache[chunk] = found
        return found

    def _pieces(self, chunks: list[str]) -> list[bytes]:
        """Ids, as bytes, of different chunks."""
        known, out, other = self._known, [], []
        for chunk in chunks:
            found = known(chunk)
            if found is None:
                word = chunk.rstrip(self._TAIL)
                if self.direct and word.isalpha() and (word.isascii() or is_normalized("NFC", word)) and word.lower() == word:
                    found = known(word)
                    if found is None:
                        self.cache[word] = found = self._merged(word)
                    if len(word) < len(chunk):
                        tail = chunk[len(word) :]
                        ending = known(tail)
                        if ending is None:
                            self.cache[tail] = ending = self._whole([tail])[0]
                        found += ending
                else:
                    other.append(chunk)
            out.append(found)
        if other:
            self.cache |= zip(other, self._whole(other), strict=True)
            out = [self.cache[chunk] if found is None else found for chunk, found in zip(chunks, out, strict=True)]
        return out

    def _merged(self, word: str) -> bytes:
        plain = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(plain)]).tobytes()

    def _whole(self, chunks: list[str]) -> list[bytes]:
        return [array("I", code.ids).tobytes() for code in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str | None = None) -> ChunkEncoder:
    """The worker process's encoder for a tokenizer file (by default the public word-level one)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(WORD_BPE)
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
