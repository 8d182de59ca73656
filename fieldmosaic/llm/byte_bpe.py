"""Byte-level BPE ids of many texts: words are cut out for a whole slice of texts at once, their ids come from a table."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from fieldmosaic.llm.word_ids import WordIds, code_points

LETTER, NUMBER, BLANK, OTHER, EDGE = 1, 2, 3, 4, 5
SLICE = 1 << 20  # characters worked on at a time
_CUT = re.compile(r"\S \S")
_LINES = r"[^\n]+|\n"


def byte_signs() -> dict[str, int]:
    """The byte each character of such a vocabulary stands for: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def merger(definition: str) -> tiktoken.Encoding | None:
    """The same merges for many words at a time, where ids follow the order of the merges; else none."""
    model = json.loads(definition)["model"]
    signs, vocabulary = byte_signs(), model["vocab"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in merges]
    if made != sorted(set(made)) or model.get("unk_token") or not all(vocabulary.get(sign, len(signs)) < len(signs) for sign in signs):
        return None
    usable = {*signs, *(a + b for a, b in merges)}
    ranks = {bytes(signs[c] for c in token): k for token, k in vocabulary.items() if token in usable}
    return tiktoken.Encoding("merges", pat_str=_LINES, mergeable_ranks=ranks, special_tokens={})


class ByteBpe:
    """The ids `Tokenizer.encode(text, add_special_tokens=False)` gives, for a tokenizer whose words follow the usual byte-level pattern.

    That pattern cuts at changes between letters, numbers, blanks and other characters, leaves a single
    blank with what follows it, and knows a few endings after an apostrophe. What kind a character is, the
    library is asked the first time it occurs. A text with an added token in it goes to the library whole.
    New words are merged by another library with the merges of the same file, as that takes a quarter of the time.
    """

    def __init__(self, definition: str):
        self.library = Tokenizer.from_str(definition)
        self.kind = np.zeros(0x110000, np.uint8)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary = self.library.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, k in vocabulary.items():
            self.bytes_of[k] = len(token)  # a character of the vocabulary stands for a byte
        self.words = WordIds(self._encode)
        self.merger = merger(definition)

    def _learn(self, codes: np.ndarray) -> None:
        pieces = self.library.pre_tokenizer.pre_tokenize_str
        for code in np.unique(codes).tolist():
            kinds = (k for k, lead in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(pieces(lead + chr(code))) == 1)
            self.kind[code] = next(kinds, BLANK)

    def _encode(self, words: list[str]) -> list:
        """All words but blank ones as lines of one text: a line end and a word never share a token."""
        plain = [k for k, w in enumerate(words) if not w.isspace()]
        out: list = [None] * len(words)
        blank = [k for k, w in enumerate(words) if w.isspace()]
        for k, done in zip(blank, self.library.encode_batch([words[k] for k in blank], add_special_tokens=False)):
            out[k] = done.ids
        if plain:
            lines = "\n".join([words[k] for k in plain])
            ids = np.array(self.merger.encode_ordinary(lines) if self.merger else self.library.encode(lines, add_special_tokens=False).ids)
            ends = np.cumsum(self.bytes_of[ids])
            sizes = np.array([len(words[k].encode()) for k in plain])
            starts = np.cumsum(sizes + 1) - sizes - 1
            lo, hi = np.searchsorted(ends, starts, "right"), np.searchsorted(ends, starts + sizes)
            for k, a, b in zip(plain, lo.tolist(), hi.tolist()):
                out[k] = ids[a : b + 1]
        return out

    def _slice(self, texts: list[str]) -> list[np.ndarray]:
        joined = "\n".join(texts) + "\n"
        codes = code_points(joined)
        sizes = np.array([len(t) for t in texts]) + 1
        past = np.cumsum(sizes)
        kind = self.kind[codes]
        if not kind.all():
            self._learn(codes[kind == 0])
            kind = self.kind[codes]
        kind[past - 1] = EDGE
        cut = np.ones(len(codes) + 1, bool)
        cut[1:-1] = kind[1:] != kind[:-1]
        last = np.flatnonzero((kind[:-1] == BLANK) & (kind[1:] != BLANK) & (kind[1:] != EDGE))
        cut[last] = True
        cut[last[codes[last] == 32] + 1] = False
        mark = np.flatnonzero((codes[:-1] == 39) & cut[:-2] & (kind[1:] == LETTER))
        one, two = codes[mark + 1], codes[np.minimum(mark + 2, len(codes) - 1)]
        short = np.isin(one, code_points("stmd"))
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        cut[mark[short | pair] + 1] = False
        cut[mark[short] + 2] = True
        cut[mark[pair] + 3] = True
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts[1:], len(codes))
        real = kind[starts] != EDGE
        starts, ends = starts[real], ends[real]
        ids, upto = self.words.ids(joined, codes, starts, ends)
        bounds = upto[np.searchsorted(starts, np.concatenate([[0], past]))]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def _long(self, text: str) -> np.ndarray:
        """A blank between two other characters starts a word, so a long text may be cut before it."""
        out, at = [], 0
        while at < len(text):
            found = _CUT.search(text, at + SLICE) if at + SLICE < len(text) else None
            end = found.start() + 1 if found else len(text)
            out += self._slice([text[at:end]])
            at = end
        return np.concatenate(out)

    def encode(self, texts: list[str]):
        """The ids of each text, in order."""
        held: list[str] = []
        size = 0
        for text in texts:
            direct = any(token in text for token in self.added)
            if held and (direct or size + len(text) > SLICE):
                yield from self._slice(held)
                held, size = [], 0
            if direct:
                yield np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)
            elif len(text) > SLICE:
                yield self._long(text)
            else:
                held.append(text)
                size += len(text)
        if held:
            yield from self._slice(held)


@lru_cache(2)
def byte_bpe(definition: str) -> ByteBpe:
    return ByteBpe(definition)
