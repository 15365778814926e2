"""Token ids of whole texts, each distinct word encoded once per worker.

The vocabulary file drops white space and lets no token span it, so a text's ids are those of its blank-separated
words in order. A text holding the file's own special tokens is encoded as it is.
"""

from __future__ import annotations

import os
import re
import string
from itertools import chain, compress

import numpy as np

from ladderweek.llm.common import held

SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")
SIGNS = re.compile(r"(?<=[0-9a-zß-öø-ÿ])[!-/:-@\[-`{-~]+\Z")  # ASCII signs at the end, behind a Latin letter or digit
ENDING = frozenset(string.punctuation)  # what such a word ends with


class Ragged:
    """Growing lists of ids laid end to end."""

    def __init__(self):
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.lens, self.n = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int64), 0

    def add(self, flat: np.ndarray, lens: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while self.n + len(lens) > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
            self.lens = np.concatenate((self.lens, np.zeros_like(self.lens)))
        here = slice(self.n, self.n + len(lens))
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts[here], self.lens[here] = self.used + np.cumsum(lens) - lens, lens
        self.used, self.n = self.used + len(flat), self.n + len(lens)

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these lists in order, and how many each has."""
        lens = self.lens[numbers]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.starts[numbers] - (ends - lens), lens) + np.arange(total)], lens


class Numbers(dict):
    """Key -> number in order of first sight; ``new`` lists the keys numbered since it was last emptied."""

    def __init__(self):
        self.new: list = []

    def __missing__(self, key):
        n = self[key] = len(self)
        self.new.append(key)
        return n


def counted(uses: np.ndarray, numbers: np.ndarray, n: int) -> np.ndarray:
    """The uses of so many keys with these numbers added."""
    out = np.bincount(numbers, minlength=n)
    out[: len(uses)] += uses
    return out


def often_used(keys: Numbers, ids: Ragged, uses: np.ndarray, most: int) -> tuple[Numbers, Ragged, np.ndarray]:
    """The keys used more than once, at most so many and the most used of them, numbered anew; one use each is on record."""
    often = np.flatnonzero(uses > 1)
    often = np.sort(often[np.argsort(-uses[often], kind="stable")[:most]])
    kept = np.zeros(len(keys), bool)
    kept[often] = True
    left, left_ids = Numbers(), Ragged()
    left.update(zip(compress(keys, kept.tolist()), range(len(often))))
    left_ids.add(*ids.take(often))
    return left, left_ids, np.ones(len(often), np.int64)


class WordEncoder:
    """Word (bytes) -> ids. A word is a stem and the signs behind it, which no token spans either; case is dropped by
    the vocabulary file, so stems are kept in lower case.

    ``most_words`` and ``most_stems`` bound the memory: beyond them those used once, and all but half as many, are forgotten and
    made again when they come up.
    """

    def __init__(self, path: str, most_words: int = 300_000, most_stems: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most_words, self.most_stems = Tokenizer.from_file(path), most_words, most_stems
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        # Letters a-z pass the file's normalizer and splitter as they are, where a trial says so; then its model is asked at once.
        trial = ["a", "the", "running", "zqxjkv", "internationalisation"]
        self.model = self.tokenizer.model
        self.direct = all(self.modelled(x) == self.tokenizer.encode(x, add_special_tokens=False).ids for x in trial)
        self.words, self.word_ids, self.word_uses = Numbers(), Ragged(), np.zeros(0, np.int64)
        self.pieces, self.piece_ids, self.piece_uses = Numbers(), Ragged(), np.zeros(0, np.int64)

    def modelled(self, letters: str) -> list[int]:
        return [token.id for token in self.model.tokenize(letters)]

    def encode_pieces(self, pieces: list[str]) -> None:
        """Plain letters many at a time: each is one pre-token, so it ends where a token with an end mark stands."""
        for at in range(0, len(pieces), 1000):
            some = pieces[at : at + 1000]
            flat, lens = np.zeros(0, np.uint32), None
            letters = all(map(str.isalpha, some))
            if letters and self.direct and (text := "".join(some)).isascii() and text.islower():
                ids = list(map(self.modelled, some))
                lens = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(lens.sum()))
            elif letters:
                (joined,) = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
                flat = np.array(joined.ids, np.uint32)
                lens = np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)
            if lens is None or len(lens) != len(some):
                ids = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                lens = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((i for x in ids for i in x), np.uint32, int(lens.sum()))
            self.piece_ids.add(flat, lens)

    def learn(self) -> None:
        if not self.words.new:
            return
        number, parts = self.pieces.__getitem__, []
        # all words at once: no word holds a line break, and bytes lower A-Z alone
        plain = b"\n".join(self.words.new).lower().decode("utf-8").split("\n")
        counts = np.ones(len(plain), np.int64)
        for k, word in enumerate(plain):
            signs = SIGNS.search(word) if word[-1] in ENDING else None
            if signs:
                parts += [word[: signs.start()], signs[0]]
                counts[k] = 2
            else:
                parts.append(word)
        at = np.zeros(len(parts), np.int64)
        self.words.new = []
        # letters first, a-z before others, so that they are encoded together; numbers follow the order of encoding
        plainly = np.fromiter(map(str.isalpha, parts), bool, len(parts))
        latin = plainly & np.fromiter(map(str.isascii, parts), bool, len(parts))
        for mine in (latin, plainly & ~latin, ~plainly):
            at[mine] = np.fromiter(map(number, compress(parts, mine.tolist())), np.int64, int(mine.sum()))
            self.encode_pieces(self.pieces.new)
            self.pieces.new = []
        self.piece_uses = counted(self.piece_uses, at, len(self.pieces))
        flat, lens = self.piece_ids.take(at)
        self.word_ids.add(flat, np.add.reduceat(lens, np.cumsum(counts) - counts))

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The ids of each text; NULL is an empty one."""
        if len(self.words) > self.most_words:
            most = self.most_words // 2
            self.words, self.word_ids, self.word_uses = often_used(self.words, self.word_ids, self.word_uses, most)
        if len(self.pieces) > self.most_stems:
            most = self.most_stems // 2
            self.pieces, self.piece_ids, self.piece_uses = often_used(self.pieces, self.piece_ids, self.piece_uses, most)
        numbers: list[np.ndarray] = []
        whole: dict[int, np.ndarray] = {}
        number = self.words.__getitem__
        for k, text in enumerate(texts):
            if text and b"<|" in text and any(x in text.lower() for x in SPECIAL):
                ids = self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids
                whole[k] = np.array(ids, np.uint32)
                text = b""
            words = (text or b"").split()
            numbers.append(np.fromiter(map(number, words), np.int64, len(words)))
        self.learn()
        if numbers:
            self.word_uses = counted(self.word_uses, np.concatenate(numbers), len(self.words))
        return [whole[k] if k in whole else self.word_ids.take(n)[0] for k, n in enumerate(numbers)]


def encoder(path: str, most_words: int = 300_000, most_stems: int = 400_000) -> WordEncoder:
    """The worker's encoder for that file."""
    name = f"encoder_{most_words}_{most_stems}_{path}"
    return held(name, lambda: WordEncoder(path, most_words, most_stems))
