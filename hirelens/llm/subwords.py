"""Exact whole-text encoding with the tokenizers library, with every distinct pre-token of a text encoded once.

A text is cut at blanks only where the tokenizer's own pre-tokenisation always cuts, so the ids of the chunks in a row
are the ids of the text.  A chunk of Latin letters is cut further into its pre-tokens by the tokenizer's pattern, and
new pre-tokens go to the library's merge model many at a time; other chunks go through the whole tokenizer.  A worker
keeps ids in two generations of fixed size; those used again move to the younger one, so frequent ones stay and memory
is bounded.
"""

from __future__ import annotations

import gc
import json
import os
import re

import numpy as np
import regex

#: A space that starts a pre-token: white space other than the last blank before a word stays behind.
BEFORE_WORD = re.compile(r" (?=[^\s\x85])")
GENERATION = 600_000
#: Characters below are alike in all versions of Unicode, and canonical composition leaves them alone.
LATIN_END = "ɐ"
# Fixed value: the pattern of byte-level pre-tokenisation.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write visible Latin-1 characters as themselves and the other bytes from U+0100 on."""
    own = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 255 and c != 173]
    rest = [c for c in range(256) if c not in own]
    return {c: chr(c) for c in own} | {c: chr(256 + k) for k, c in enumerate(rest)}


#: Marks that often follow a word, and the byte 255, which UTF-8 doesn't have, in the byte alphabet.
MARKS, NO_TEXT = ".,;:!?|#*%", byte_alphabet()[255]


def _no_letter(data: str) -> bool:
    """Whether bytes, given as Latin-1, are whole characters and begin with one that is no letter."""
    try:
        return not data.encode("latin-1").decode()[0].isalpha()
    except UnicodeDecodeError:
        return False


class ChunkEncoder:
    """encode_all(texts) gives each text's ids as little-endian bytes of `dtype`.

    keeps_space: the tokenizer joins one blank to the word after it (byte-level kind); else white space is dropped.
    """

    def __init__(self, path: str, keeps_space: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # such strings in a text are ordinary text
        self.keeps_space = keeps_space
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 65536 else "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # The same merges without normaliser and pattern: pre-tokens come one a line, in the byte alphabet, and the ids
        # of the line ends between them tell them apart.
        self.merges = Tokenizer.from_file(path)
        self.merges.encode_special_tokens = True
        self.merges.pre_tokenizer = pre_tokenizers.Split(byte_alphabet()[10], "isolated")
        self.table = byte_alphabet()
        with open(path) as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"]
        self.pattern = None
        if keeps_space and kind["type"] == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"] and not spec["normalizer"]:
            self.pattern, self.lower = regex.compile(BYTE_LEVEL), False
        elif not keeps_space and kind["type"] == "Sequence" and [x["type"] for x in kind["pretokenizers"]] == ["Split", "ByteLevel"] and not kind["pretokenizers"][1]["use_regex"]:
            if [x["type"] for x in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]:
                self.pattern, self.lower = regex.compile(kind["pretokenizers"][0]["pattern"]["Regex"]), True
                from tokenizers import normalizers

                self.merges.normalizer = normalizers.Sequence([])
        end = self.merges.encode(self.table[10], add_special_tokens=False).ids
        self.line_end = end[0]
        if len(end) != 1:
            self.pattern = None
        self.apart = bool(self.pattern) and keeps_space and self._apart(spec["model"])
        if self.apart:
            self.merges.pre_tokenizer = None
            self.merges.post_processor = None
            self.line_end = self.merges.encode(NO_TEXT, add_special_tokens=False).ids[0]

    def _apart(self, model: dict) -> bool:
        """Whether no merge holds the byte that no text has, or joins letters to MARKS or a line end to letters.  Then that byte
        parts pre-tokens without a pattern, and a word is merged together with a line end before it and marks after it."""
        if any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return False
        byte = {ord(c): b for b, c in self.table.items()}
        marks = tuple(self.table[ord(c)] for c in MARKS)
        for a, b in (x if isinstance(x, list) else x.split(" ") for x in model["merges"]):
            if NO_TEXT in a or NO_TEXT in b:
                return False
            if b.startswith(marks):
                try:
                    last = a.translate(byte).encode("latin-1").decode()[-1]
                except UnicodeDecodeError:
                    return False
                if last.isalpha():
                    return False
            first = b.translate(byte)[0]
            if a.endswith(self.table[10]) and (first.isascii() and first.isalpha() or first >= "\x80" and not _no_letter(b.translate(byte))):
                return False
        return NO_TEXT in model["vocab"]

    def chunks(self, text: str) -> list[str]:
        plain = text.replace("\n", "").isprintable()  # blanks and line ends are the only white space
        if not self.keeps_space:
            return text.split() if plain else text.split(" ")
        if plain and "  " not in text and "\n\n" not in text and " \n" not in text and "\n " not in text:
            # A line end alone is a pre-token, and a blank begins one.
            return text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")
        parts = BEFORE_WORD.split(text)
        return [parts[0], *[f" {x}" for x in parts[1:]]]

    def _whole(self, strings: list[str]) -> None:
        for at in range(0, len(strings), 20_000):
            part = strings[at : at + 20_000]
            for c, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[c] = np.array(e.ids, self.dtype).tobytes()

    def _merged(self, pretokens: list[str]) -> None:
        """ids of pre-tokens, without line ends unless these are apart."""
        width, per = self.dtype.itemsize, 512 if self.apart else 2000
        for at in range(0, len(pretokens), per):
            part = pretokens[at : at + per]
            data = b"\xff".join([*map(str.encode, part), b""]) if self.apart else "\n".join([*part, ""]).encode()
            lines = data.decode("latin-1").translate(self.table)
            ids = np.array(self.merges.encode_batch_fast([lines], add_special_tokens=False)[0].ids, self.dtype)
            stops = np.flatnonzero(ids == self.line_end)
            if len(stops) != len(part):
                raise ValueError("a pre-token holds a line end")
            data, begin = ids.tobytes(), 0
            for p, stop in zip(part, (stops * width).tolist(), strict=True):
                self.known[p] = data[begin:stop]
                begin = stop + width

    def _find(self, strings: set[str]) -> set[str]:
        """Those whose ids are not known; ids of the older generation move to the younger."""
        older = self.older
        again = {c for c in strings if c in older}
        self.known.update(zip(again, map(older.__getitem__, again), strict=True))
        return strings - again

    def _learn(self, chunks: set[str]) -> None:
        known = self.known
        words, pairs, first, second, more, cut, rest = [], [], [], [], [], [], []
        if self.pattern:
            lower, findall = self.lower, self.pattern.findall
            for c in chunks:
                if not (c.isascii() or max(c) < LATIN_END):
                    rest.append(c)
                elif lower:
                    # Letters alone, or with one mark after them, need no pattern.
                    p = c.lower()
                    if p == c and p.isalpha():
                        words.append(c)
                    elif p[:-1].isalpha() and p[-1:] in ".,;:!?|":
                        pairs.append(c)
                        first.append(p[:-1])
                        second.append(p[-1])
                    else:
                        more.append(c)
                        cut.append(findall(p))
                elif self.apart and (p := c.rstrip(MARKS))[1:].isalpha() and (p[0] in " \n" or p[0].isalpha()):
                    words.append(c)
                elif c[1:].isalpha() and (c[:1] == " " or c[:1].isalpha()):
                    words.append(c)
                elif c[:1] == "\n" and c[1:].isalpha():
                    pairs.append(c)
                    first.append("\n")
                    second.append(c[1:])
                elif c[1:-1].isalpha() and c[0] == " " and c[-1] in ".,;:!?|":
                    pairs.append(c)
                    first.append(c[:-1])
                    second.append(c[-1])
                else:
                    more.append(c)
                    cut.append(findall(c))
            new = self._find(set(first).union(second, *cut).difference(known, words))
            lines = [] if self.apart else [p for p in new if "\n" in p]
            self._merged(words)
            self._merged(list(new.difference(lines)))
            self._whole(lines)
            known.update(zip(pairs, map(bytes.__add__, map(known.__getitem__, first), map(known.__getitem__, second)), strict=True))
            for c, x in zip(more, cut, strict=True):
                known[c] = b"".join([known[p] for p in x])
        else:
            rest = list(chunks)
        self._whole(rest)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        gc.disable()  # millions of strings and no cycles
        try:
            return self._encode_all(texts)
        finally:
            gc.enable()

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        split = [self.chunks(t) for t in texts]
        if len(self.known) > GENERATION:
            self.known, self.older = {}, self.known
        known = self.known
        self._learn(self._find(set().union(*split).difference(known)))
        get = known.__getitem__
        return [b"".join(map(get, s)) for s in split]


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(path: str, keeps_space: bool) -> ChunkEncoder:
    """One per worker process."""
    if (path, keeps_space) not in _ENCODERS:
        _ENCODERS[path, keeps_space] = ChunkEncoder(path, keeps_space)
    return _ENCODERS[path, keeps_space]
