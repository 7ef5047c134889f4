"""Token ids of whole texts, word by word: the vocabulary drops white space, so words are encoded apart and remembered."""

from __future__ import annotations

import os

import numpy as np

from tallycube.llm.common import grown, held, ranges
from tallycube.llm.shingles import VISIBLE, Words

MARK = "\0"  # a word of its own between words that are encoded in one go
LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = LETTER[ord("A") : ord("Z") + 1] = True
LATIN = np.zeros(256, bool)  # after the byte 0xC3: a letter from U+00C0 to U+00FF
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False
SIGN = np.zeros(256, bool)
SIGN[0x21:0x7F] = True
SIGN[0x30:0x3A] = SIGN[LETTER] = False
ROOM = 300_000
GO = 400


def signs_after_letters(data: np.ndarray) -> np.ndarray:
    """Where an ASCII sign follows a letter (ASCII or Latin-1), in texts one behind the other."""
    sign = np.flatnonzero(SIGN[data[2:]]) + 2
    before, last = data[sign - 2], data[sign - 1]
    return sign[LETTER[last] | LATIN[last] & (before == 0xC3)]


class WordCodec:
    """Ids of a text as packed little-endian unsigned 32-bit numbers.

    No token of the vocabulary spans white space, so the ids of a text are those of its words in turn. Words are
    split at ASCII white space only; a word with other white space inside is still encoded right, as the vocabulary
    splits it. Nor does a token span a letter and a sign behind it, so words end there too, and are fewer. ASCII letters
    are lower-cased beforehand, as the vocabulary does. Neither is done where a special token may be meant. When
    ROOM words are remembered, those met in one slice of text only are forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Which word it is; the ids of all words in a row, and where those of each begin.
        self.known: dict[bytes, int] = {}
        self.start, self.ids = np.zeros(1, np.int64), np.zeros(1, "<u4")
        self.met = np.zeros(1, np.int64)  # in how many slices of text
        ids = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        if len(ids) != 1:
            raise ValueError("the vocabulary has no single id for the separator")
        self.mark = ids[0]
        self.closing = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closing[[k for token, k in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[bytes]) -> list[bytes]:
        plain = not any(b"<|" in t for t in texts)
        w = Words(texts, VISIBLE, fold=plain, cuts=signs_after_letters if plain else None)
        _, first, place = np.unique(w.hash, return_index=True, return_inverse=True)
        data = w.data.tobytes()
        words = [data[a:b] for a, b in zip(w.start[first].tolist(), w.end[first].tolist(), strict=True)]
        missing = [x for x in words if x not in self.known]
        if len(self.known) + len(missing) > ROOM:
            self._forget()
            missing = [x for x in words if x not in self.known]
        self._learn(missing)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.met = grown(self.met, len(self.known))
        self.met[at] += 1
        at = at[place]
        start, n = self.start[at], self.start[at + 1] - self.start[at]
        ids = self.ids[ranges(start, n)].tobytes()
        cuts = (4 * np.concatenate([[0], np.cumsum(n)])[w.first]).tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _forget(self) -> None:
        met = self.met[: len(self.known)]
        least = 2
        while (met >= least).sum() > ROOM // 2:
            least *= 2
        kept = np.flatnonzero(met >= least)
        words, start = list(self.known), self.start
        n = start[kept + 1] - start[kept]
        ids = self.ids[ranges(start[kept], n)]
        self.known, self.start, self.met = {}, np.zeros(1, np.int64), met[kept].copy()
        self._add([words[k] for k in kept.tolist()], ids, n)

    def _learn(self, words: list[bytes]) -> None:
        # A word of letters has one last token, which the vocabulary marks as an end. Letters that it takes for more than
        # one word, as it may where it lower-cases or knows them otherwise than Python, are encoded like other words.
        letters, plain, odd = [], [], []
        for w in words:
            if w.isalpha() or not w.isascii() and w.decode().isalpha():
                letters.append(w)
            elif b"\0" in w or b"<|" in w:
                odd.append(w)
            else:
                plain.append(w)
        for at in range(0, len(letters), 16 * GO):
            some = [letters[i : i + GO] for i in range(at, min(at + 16 * GO, len(letters)), GO)]
            found = self.tokenizer.encode_batch_fast([b" ".join(go).decode() for go in some], add_special_tokens=False)
            for go, encoding in zip(some, found, strict=True):
                ids = np.array(encoding.ids, "<u4")
                ends = np.flatnonzero(self.closing[ids]) + 1
                if len(ends) == len(go):
                    self._add(go, ids, np.diff(ends, prepend=0))
                else:
                    plain += go
        goes = [plain[i : i + GO] for i in range(0, len(plain), GO)]
        for at in range(0, len(goes), 16):
            some = goes[at : at + 16]
            found = self.tokenizer.encode_batch_fast([f" {MARK} ".join(b"\n".join(g).decode().split("\n")) for g in some], add_special_tokens=False)
            for go, encoding in zip(some, found, strict=True):
                ids = np.array(encoding.ids, "<u4")
                own = ids != self.mark
                self._add(go, ids[own], np.diff(np.cumsum(own)[np.append(np.flatnonzero(~own), len(ids) - 1)], prepend=0))
        for word, encoding in zip(odd, self.tokenizer.encode_batch_fast([w.decode() for w in odd], add_special_tokens=False), strict=True):
            self._add([word], np.array(encoding.ids, "<u4"), np.array([len(encoding.ids)]))

    def _add(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, at = len(self.known), int(self.start[len(self.known)])
        self.start, self.ids = grown(self.start, n + len(words) + 1), grown(self.ids, at + len(ids))
        self.start[n + 1 : n + 1 + len(words)] = at + np.cumsum(lengths)
        self.ids[at : at + len(ids)] = ids
        self.known |= zip(words, range(n, n + len(words)), strict=True)


def codec(path: str) -> WordCodec:
    """One codec for each vocabulary and worker process, held under the path."""
    return held(path, lambda: WordCodec(path))
