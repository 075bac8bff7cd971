"""Cutting texts into the words of a tokenizer file, and the ids of whole texts from those of words."""

import json
import os
import re

import numpy as np

#: Words a worker remembers in each of two generations. When the younger one is full, it becomes the older
#: one, from which words come back as they are needed.
KNOWN = 150_000
KNOWN_CHARS = 64
#: Fixed value: the rule for words of the tokenizer files this module takes.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Plain characters: printable ASCII, common white space and punctuation, and Latin letters. For them the
#: file's normalisation is lower-casing, and its rule for words is PLAIN_WORD.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡¿«»’“”–—…€À-ÖØ-öø-įı-ž]*")
LETTERS = "a-zß-öø-įı-ž"
PLAIN_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s0-9{LETTERS}]+")


class TextIds:
    """Ids of whole texts; every distinct word is worked on once. Subclasses say how."""

    most = KNOWN

    @staticmethod
    def content(path):
        with open(path, encoding="utf-8") as file:
            return json.load(file)

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core already
        from tokenizers import Tokenizer

        content = self.content(path)
        rules = content["normalizer"]["normalizers"], content["pre_tokenizer"]["pretokenizers"]
        if [r["type"] for r in rules[0]] != ["NFC", "Replace", "Lowercase"] or rules[1][0]["pattern"]["Regex"] != SPLIT:
            raise ValueError("a tokenizer with other rules for words")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.known, self.older = {}, {}

    def word_ids(self, words):
        """The ids of every word, given in the vocabulary's base characters, as bytes of 32-bit integers."""
        raise NotImplementedError

    def _keys(self, text):
        """What the text is made of: plain words, and after a space whole pieces that are not plain.

        White space is dropped by the tokenizer and separates words. A cut too few costs time only.
        """
        if PLAIN.fullmatch(text) and "<|" not in text:
            return PLAIN_WORD.findall(text.lower())
        out = []
        for piece in text.split(" "):
            if PLAIN.fullmatch(piece) and "<|" not in piece:
                out += PLAIN_WORD.findall(piece.lower())
            else:
                out.append(" " + piece)
        return out

    def _words(self, key):
        """The words behind a key, and the ids of special tokens as they stand in it."""
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        if key[0] != " ":
            return [split(key)[0][0]]
        words = []
        for part in self.marks.split(key[1:]):
            if part in self.special:
                words.append(self.special[part])
            elif part:
                words += [word for word, _ in split(self.tokenizer.normalizer.normalize_str(part))]
        return words

    def encode(self, texts):
        """The ids of each text, as bytes of little-endian 32-bit integers."""
        cut = [self._keys(t) for t in texts]
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        new = set().union(*cut).difference(self.known)
        back = new.intersection(self.older)
        self.known.update(zip(back, map(self.older.__getitem__, back)))
        new -= back
        plain = [k for k in new if k.isascii() and k[0] != " "]
        self.known.update(zip(plain, self.word_ids(plain)))
        split = {k: self._words(k) for k in new.difference(plain)}
        words = list({w for found in split.values() for w in found if isinstance(w, str)})
        ids = dict(zip(words, self.word_ids(words)))
        for key, found in split.items():
            self.known[key] = b"".join(ids[w] if isinstance(w, str) else np.uint32(w).tobytes() for w in found)
        out = [b"".join(map(self.known.__getitem__, keys)) for keys in cut]
        for key in [k for k in new if len(k) > KNOWN_CHARS]:
            del self.known[key]
        return out
