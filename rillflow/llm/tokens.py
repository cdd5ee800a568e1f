"""Token ids of whole texts with a vocabulary file of the ``tokenizers`` library."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import numpy as np

from rillflow.llm.words import Hasher, blocks, grouped
from rillflow.llm.worker import kept

# Words and word parts a worker remembers at a time, about 60 bytes each.
KNOWN_WORDS = 1 << 19
KNOWN_PARTS = 200_000
# How the vocabulary cuts lower-case words of Latin letters, digits and plain signs. The last
# alternative stands for any other character: such words go through the library as they are.
PARTS = re.compile(r"\n|[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:;=>?@\[-`{-~]+|.")
PLAIN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:;=>?@\[-`{-~]+")


class HashTable:
    """Numbers 0, 1, 2, ... for 64-bit keys, looked up by whole arrays."""

    def __init__(self, capacity: int):
        self._mask = np.uint64(4 * capacity - 1)
        self._keys = np.zeros(4 * capacity, np.uint64)
        self._values = np.full(4 * capacity, -1, np.int32)
        self.size = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        slots = (keys & self._mask).astype(np.int64)
        found = self._values[slots]
        wrong = np.flatnonzero((found >= 0) & (self._keys[slots] != keys))
        while len(wrong):
            slots[wrong] = (slots[wrong] + 1) & int(self._mask)
            at = slots[wrong]
            found[wrong] = self._values[at]
            wrong = wrong[(found[wrong] >= 0) & (self._keys[at] != keys[wrong])]
        return found

    def add(self, keys: np.ndarray) -> None:
        """Number new, distinct keys in order."""
        slots = (keys & self._mask).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            # Of the keys that want a free slot the first gets it; the others move on.
            free = left[self._values[slots[left]] < 0]
            _, first = np.unique(slots[free], return_index=True)
            won = free[first]
            self._keys[slots[won]] = keys[won]
            self._values[slots[won]] = self.size + won
            taken = np.zeros(len(keys), bool)
            taken[won] = True
            left = left[~taken[left]]
            slots[left] = (slots[left] + 1) & int(self._mask)
        self.size += len(keys)


class PieceEncoder:
    """Encodes texts word by word and remembers the ids of words.

    The vocabulary drops white space and never joins characters across it, so the ids of a text
    are the ids of its words, in order. Most words come back again and again, and the library is
    asked only for those not seen lately.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._library = Tokenizer.from_file(path)
        self.n_ids = self._library.get_vocab_size()
        # The same vocabulary for parts that are in its normal form and cut already.
        self._cut = Tokenizer.from_file(path)
        self._cut.normalizer = None
        self._cut.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        vocabulary = self._library.get_vocab(with_added_tokens=False)
        self._closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self._closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._hasher = Hasher()
        self._parts: dict[str, list[int]] = {}
        self._forget()

    @staticmethod
    def of(path: str) -> PieceEncoder:
        return kept(("pieces", path), lambda: PieceEncoder(path), large=True)

    def _forget(self) -> None:
        self._table = HashTable(KNOWN_WORDS)
        self._flat, self._used = np.empty(1 << 20, np.uint32), 0
        self._starts = np.empty(2 * KNOWN_WORDS, np.int64)
        self._sizes = np.empty(2 * KNOWN_WORDS, np.int32)

    def _learn_parts(self, parts: list[str]) -> None:
        ids = np.array(self._cut.encode(" ".join(parts), add_special_tokens=False).ids, np.int64)
        ends = np.flatnonzero(self._closes[ids]) + 1
        if len(ends) == len(parts):
            bounds = [0, *ends.tolist()]
            values = ids.tolist()
            self._parts.update(
                (part, values[bounds[i] : bounds[i + 1]]) for i, part in enumerate(parts)
            )
        else:
            for part in parts:
                self._parts[part] = self._cut.encode(part, add_special_tokens=False).ids

    def _encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        texts = [w.decode("utf-8", "replace") for w in words]
        cut: list[list[str]] = [[]]
        for part in PARTS.findall("\n".join(texts).lower()):
            if part == "\n":
                cut.append([])
            else:
                cut[-1].append(part)
        wanted = dict.fromkeys(p for parts in cut for p in parts)
        if len(self._parts) > KNOWN_PARTS:
            self._parts.clear()
        odd = {p for p in wanted if len(p) == 1 and not PLAIN.fullmatch(p)}
        fresh = [p for p in wanted if p not in self._parts and p not in odd]
        if fresh:
            self._learn_parts(fresh)
        if len(cut) != len(words):
            raise ValueError("words must not hold line ends")
        out = []
        for text, parts in zip(texts, cut):
            if odd and not odd.isdisjoint(parts):
                out.append(self._library.encode(text, add_special_tokens=False).ids)
            elif len(parts) == 1:
                out.append(self._parts[parts[0]])
            else:
                out.append([i for p in parts for i in self._parts[p]])
        return out

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        found = self._encode_words(words)
        sizes = np.fromiter(map(len, found), np.int32, len(found))
        ids = np.fromiter((i for one in found for i in one), np.uint32, int(sizes.sum()))
        at, end = self._table.size, self._used + len(ids)
        while end > len(self._flat):
            self._flat = np.concatenate([self._flat, np.empty_like(self._flat)])
        self._flat[self._used : end] = ids
        ends = np.cumsum(sizes, dtype=np.int64)
        self._sizes[at : at + len(keys)] = sizes
        self._starts[at : at + len(keys)] = self._used + ends - sizes
        self._used = end
        self._table.add(keys)

    def _lookup(self, data: bytes, starts, ends, hashes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of a block, and how many each word has."""
        if not len(hashes):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if self._table.size > KNOWN_WORDS:
            self._forget()
        index = self._table.find(hashes)
        fresh = np.flatnonzero(index < 0)
        if len(fresh):
            keys, first = np.unique(hashes[fresh], return_index=True)
            places = fresh[first]
            pairs = zip(starts[places].tolist(), ends[places].tolist())
            self._learn(keys, [data[a:b] for a, b in pairs])
            index[fresh] = self._table.find(hashes[fresh])
        sizes = self._sizes[index].astype(np.int64)
        stops = np.cumsum(sizes)
        places = np.arange(stops[-1]) + np.repeat(self._starts[index] - stops + sizes, sizes)
        return self._flat[places], sizes

    def ids(self, text: bytes) -> np.ndarray:
        """The ids of one text, without special tokens of the library's own."""
        parts = [self._lookup(piece, *self._hasher.spans(piece))[0] for piece in blocks(text)]
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)

    def batches(self, texts: Iterable[bytes]) -> Iterator[list[np.ndarray]]:
        """The ids of each text, for some whole texts at a time."""
        for group in grouped(texts):
            if len(group) == 1:
                yield [self.ids(group[0])]
                continue
            data = b"\n".join(group)
            starts, ends, hashes = self._hasher.spans(data)
            ids, sizes = self._lookup(data, starts, ends, hashes)
            begins = np.cumsum([0] + [len(x) + 1 for x in group])
            stops = np.concatenate([[0], np.cumsum(sizes)])
            cuts = stops[np.searchsorted(starts, begins)]
            yield [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def default_vocabulary() -> str:
    """Where the public vocabulary file of the queries lies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
