"""Token ids of whole texts, by a public tokenizer, with word caches.

A byte-pair tokenizer that drops white space and splits words before it merges
gives a word the same ids wherever it stands. So runs between white space are
looked up, a run not seen before is split into its words, and a word not seen
before is merged by the library's model. Only texts of plain Latin characters
take this way; any other text (combining marks, other scripts, control
characters, the tokenizer's special strings) is encoded whole by the library,
and so is every text where the file asks for another normaliser or another
split than those below, so the ids are always the library's.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from recsort.llm.common import worker_state

#: Entries of each of the two caches; a full cache is emptied and fills again.
CACHE = 400_000

# Characters whose folding and classes are the same here and in the library.
PLAIN = re.compile(r"[\t\n\r\x20-\x7E\xA0-\xAC\xAE-\xB1\xB4-\xB8\xBA\xBB\xBF-įı-ž]*")
# The word pattern of the tokenizer, on such characters.
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")

# The normaliser and the split, as the file states them, that the word way stands for.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class WordTokenizer:
    """``encode`` gives the little-endian ids of a text as bytes, ``dtype`` their type."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        self.by_words = stated.get("normalizer") == NORMALIZER and stated.get("pre_tokenizer") == SPLIT
        self.model = self.library.model
        size = self.library.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # The printable stand-in of each byte: its own character if it has one, else the next from 256 on.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = iter(range(256, 512))
        self.letter = [chr(b if b in own else next(rest)) for b in range(256)]
        self.runs: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        if (ids := self.words.get(word)) is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            letters = "".join(map(self.letter.__getitem__, word.encode()))
            ids = self.words[word] = np.array([t.id for t in self.model.tokenize(letters)], self.dtype).tobytes()
        return ids

    def _run(self, run: str) -> bytes:
        if (ids := self.runs.get(run)) is None:
            if len(self.runs) >= CACHE:
                self.runs.clear()
            ids = self.runs[run] = b"".join(map(self._word, WORD.findall(run.lower())))
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_words or not PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return self._whole(text)
        runs = text.split()
        try:
            return b"".join(map(self.runs.__getitem__, runs))
        except KeyError:
            return b"".join(map(self._run, runs))


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer of ``path``; its caches live on between tasks."""
    return worker_state(f"tokenizer {path}", lambda: WordTokenizer(path))
