"""Token ids of whole texts, each different piece of text encoded once.

Both vocabularies cut a text into pre-tokens before they merge: always before a single space between
two other characters, and between an ASCII letter and a mark other than an apostrophe. Their special
tokens hold no space, and marks only as ``<|`` and ``|>``. So the text is cut at such places, every
different piece is encoded by the tokenizers library, and the ids of a text are the ids of its pieces in
a row. Tests compare them with the library's ids of the whole text. Most pieces that are new are a space and a word; many of them in a
row make a text that is cut at each of them in the same way, so the library gets them together if ids tell where a word ends.
"""

from __future__ import annotations

import os

import numpy as np

from tidemark.llm.arrays import LOWER, SPREAD, U64, byte_table, mix

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
#: Different pieces whose ids a worker keeps.
KEPT_PIECES = 1_000_000
#: New words that are encoded in a row.
TOGETHER = 1024
#: White space of ASCII, which no cut may touch on either side.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: Marks that always part from a letter; an apostrophe may not, a bar or a bracket may belong to a special token.
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = True


def vocabulary_path(name: str) -> str:
    """The file of a public vocabulary; a path is taken as it is."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts with one vocabulary; remembers the ids of pieces it has seen."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lowers = "Lowercase" in str(self.tokenizer.normalizer)
        suffix, names = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)  # ids that end a word, if the vocabulary marks them
        if suffix:
            self.ends[[i for name, i in names.items() if name.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, U64)  # sorted
        self.checks = np.zeros(0, U64)
        self.slots = np.zeros(0, np.int64)
        self.begin = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin (one more entry than texts)."""
        if len(data) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.lowers and not np.any((data[:-1] == 0x3C) & (data[1:] == 0x7C)):  # no "<|", so no special token
            data = LOWER[data]
        cut = data == 32
        cut[0] = cut[-1] = False
        cut[1:-1] &= ~_SPACE[data[:-2]] & ~_SPACE[data[2:]]
        # beyond ASCII a neighbour may be white space of several bytes: keep those uncut
        cut[1:-1] &= (data[:-2] < 0x80) & (data[2:] < 0x80) | _letters(data)
        cut[1:] |= _LETTER[data[:-1]] & _MARK[data[1:]] | _MARK[data[:-1]] & _LETTER[data[1:]]
        filled = offsets[:-1] < offsets[1:]
        cut[offsets[:-1][filled]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(data))
        size = end - start
        place = np.arange(len(data)) - np.repeat(start, size)
        power = np.cumprod(np.full(int(size.max()), SPREAD, U64))[place]
        key = mix(np.add.reduceat(byte_table(11)[data] * power, start) + size.astype(U64))
        check = mix(np.add.reduceat(byte_table(23)[data] * power, start))
        slot = self._slots(data, start, end, key, check)
        count = self.begin[slot + 1] - self.begin[slot]
        total = int(count.sum())
        first = np.cumsum(count) - count
        ids = self.ids[np.arange(total) - np.repeat(first - self.begin[slot], count)]
        edges = np.append(first, total)[np.searchsorted(start, offsets)]
        return ids, edges

    def _slots(self, data, start, end, key, check) -> np.ndarray:
        if len(self.keys) > KEPT_PIECES:
            self.clear()
        some, place, back = np.unique(key, return_index=True, return_inverse=True)
        if np.any(check != check[place][back]):
            raise ValueError("two pieces of text share a hash")
        at = np.searchsorted(self.keys, some)
        known = np.zeros(len(some), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == some[inside]
        if np.any(self.checks[at[known]] != check[place][known]):
            raise ValueError("two pieces of text share a hash")
        fresh = np.flatnonzero(~known)
        if len(fresh):
            counts, flat = self._encoded(data, start[place[fresh]], end[place[fresh]])
            slots = len(self.begin) - 1 + np.arange(len(fresh))
            self.begin = np.append(self.begin, self.begin[-1] + np.cumsum(counts))
            self.ids = np.append(self.ids, flat)
            # both are sorted, so the new ones are put between the others
            new = at[fresh] + np.arange(len(fresh))
            old = np.ones(len(self.keys) + len(fresh), bool)
            old[new] = False
            for name, values in (("keys", some[fresh]), ("checks", check[place[fresh]]), ("slots", slots)):
                both = np.empty(len(old), values.dtype)
                both[old], both[new] = getattr(self, name), values
                setattr(self, name, both)
            at = at + np.cumsum(~known) - ~known
        return self.slots[at][back]

    def _encoded(self, data, start, end) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and all ids in a row."""
        size = end - start
        edges = np.append(0, np.cumsum(size))
        text = data[np.arange(edges[-1]) + np.repeat(start - edges[:-1], size)]
        lead = (text >= 0xC3) & (text <= 0xC9)
        word = _LETTER[text] | lead
        word[1:] |= lead[:-1]
        word[edges[:-1]] = text[edges[:-1]] == 32
        plain = np.logical_and.reduceat(word, edges[:-1]) & (size > 1) & self.ends.any()
        counts, some = np.zeros(len(size), np.int64), np.flatnonzero(plain)
        words, ids = text[np.repeat(plain, size)], []
        at = np.append(0, np.cumsum(size[some]))
        alone = [np.flatnonzero(~plain)]
        for lo in range(0, len(some), TOGETHER):
            group = some[lo : lo + TOGETHER]
            row = words[at[lo] : at[lo + len(group)]].tobytes().decode()
            found = np.array(self.tokenizer.encode_batch_fast([row], add_special_tokens=False)[0].ids, np.uint32)
            last = np.flatnonzero(self.ends[found])
            if len(last) == len(group):  # each piece has a word at least, so none has two
                counts[group] = np.diff(last, prepend=-1)
                ids.append(found)
            else:
                plain[group] = False
                alone.append(group)
        rest = np.sort(np.concatenate(alone))
        raw = text.tobytes()
        found = self.tokenizer.encode_batch_fast([raw[edges[p] : edges[p + 1]].decode() for p in rest], add_special_tokens=False)
        found = [e.ids for e in found]
        counts[rest] = np.fromiter(map(len, found), np.int64, len(found))
        flat, together = np.empty(int(counts.sum()), np.uint32), np.repeat(plain, counts)
        flat[together] = np.concatenate([np.zeros(0, np.uint32), *ids])
        flat[~together] = np.fromiter((i for x in found for i in x), np.uint32, int(counts[rest].sum()))
        return counts, flat


def _letters(data: np.ndarray) -> np.ndarray:
    """For each inner byte, whether both neighbours are ASCII or part of a letter of Latin-1 or Latin Extended."""
    plain = data < 0x80
    lead = (data >= 0xC3) & (data <= 0xC9)
    tail = np.zeros(len(data), bool)
    tail[1:] = (data[1:] >= 0x80) & (data[1:] < 0xC0) & lead[:-1]
    return (plain | tail)[:-2] & (plain | lead)[2:]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]

