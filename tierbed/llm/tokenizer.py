"""Token ids of whole texts by a public vocabulary, quickly: a word or piece is merged once a task."""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterable

import numpy as np
import regex

from tierbed.llm.text import Powers, mix

TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS = 400_000
CACHED_WORD_BYTES = 64
# Distinct pieces, and ids of them, that a task remembers: about 32 bytes a piece, 4 an id.
CACHED_PIECES, CACHED_IDS = 1_500_000, 12_000_000
LATIN_END, LOWER_CASE_END = 0x250, 0x2D00
# Below U+0250, without white space and the one letter whose lower case is two characters.
LATIN = regex.compile(r"[\x21-\x7E\u00A1-\u012F\u0131-\u024F]+")


class WordTokenizer:
    """Ids of texts, put together from cached ids of their words.

    The vocabulary splits at white space, so a text's ids are those of its words. Where it lower-cases
    and splits words by a pattern, as the default does, new words of Latin letters (on
    which composition has no effect, and lower case is letter by letter) are split here and
    only unseen pieces go to the merge rules; all other words go through the whole tokenizer.
    """

    def __init__(self, path: str | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.model = Tokenizer.from_file(path)
        self.cache: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        steps = [x["type"] for x in (parts.get("normalizer") or {}).get("normalizers", [])]
        split = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.split = None
        if steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in split] == ["Split", "ByteLevel"]:
            self.pattern = split[0]["pattern"]["Regex"]
            self.split = regex.compile(self.pattern).findall
            # Lower case of a Latin letter may lie far behind the Latin letters.
            mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.bytes = {i: mapped.pre_tokenize_str(chr(i))[0][0] for i in range(0x21, LOWER_CASE_END)}

    def encode(self, word: bytes) -> bytes:
        ids = self.model.encode(word.decode(), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        tokens = self.model.model.tokenize(piece if piece.isascii() else piece.translate(self.bytes))
        ids = b"".join([t.id.to_bytes(4, "little") for t in tokens])
        if len(piece) <= CACHED_WORD_BYTES:
            self.pieces[piece] = ids
        return ids

    def _learn(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        known, get, split, plain = {}, self.pieces.get, self.split, LATIN.fullmatch
        if len(self.pieces) > CACHED_WORDS:
            self.pieces.clear()
        for word in words:
            text = word.decode()
            if split and plain(text) and "<|" not in text:
                known[word] = b"".join([get(x) or self._piece(x) for x in split(text.lower())])
            else:
                known[word] = self.encode(word)
        return known

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        split = [x.split() for x in texts]
        words = set().union(*split)
        new = words - self.cache.keys()
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache, new = {}, words
        learned = self._learn(new)
        long_words = {w: learned.pop(w) for w in [w for w in learned if len(w) > CACHED_WORD_BYTES]}
        self.cache.update(learned)
        get = self.cache.get
        if long_words:
            get = {w: get(w) or long_words.get(w, b"") for w in words}.get
        return [b"".join(map(get, words)) for words in split]


SPACE, LETTER, NUMBER, OTHER, FOREIGN = range(5)


def _kinds() -> np.ndarray:
    """Kind of each code point below ``LATIN_END``; all beyond are foreign."""
    kinds = np.full(LATIN_END + 1, FOREIGN, np.uint8)
    for i in range(LATIN_END):
        if LATIN.fullmatch(chr(i)):
            kinds[i] = {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(i))[0], OTHER)
    kinds[[0x20, 0x09, 0x0A, 0x0D]] = SPACE
    return kinds


class PieceTokenizer(WordTokenizer):
    """Ids of texts, put together from remembered ids of their pieces.

    For a vocabulary that lower-cases, drops white space and splits at this very pattern, texts of
    Latin letters are split by array operations on code points: runs of letters, single
    numbers, runs of other signs, and contractions. A piece is known by a 64-bit hash. Other
    vocabularies and texts go the way of the words.
    """

    # Fixed value: the pattern that the split follows.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str | None) -> None:
        super().__init__(path)
        self.direct = self.split is not None and self.pattern == self.PATTERN
        self.kinds = _kinds()
        # The table ends with what stands for all further code points, which are foreign.
        lower = [chr(i).lower() for i in range(LATIN_END)]
        self.lower = np.array([*(ord(x) if len(x) == 1 else 0 for x in lower), 0], np.uint32)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.first = self.size = np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, "<u4"), 0

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        if not self.direct or not texts:
            return super().texts(texts)
        strings = [x.decode() for x in texts]
        ends = np.cumsum([len(x) + 1 for x in strings])
        points = np.frombuffer("\n".join([*strings, "  "]).encode("utf-32-le"), "<u4")
        points = np.minimum(points, LATIN_END)
        kind, low = self.kinds[points], self.lower[points]
        # A text's characters begin where the one before has ended.
        foreign = set(np.searchsorted(ends, np.flatnonzero(kind == FOREIGN), "right").tolist())
        foreign.update(i for i, x in enumerate(strings) if "<|" in x)
        for i in foreign:
            kind[ends[i] - len(strings[i]) - 1 : ends[i]] = SPACE
        starts, stops = self._split(kind, low)
        up, down = Powers.upto(len(low))
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)], out=sums[1:])
        hashes = mix((sums[stops] - sums[starts]) * down[starts])
        distinct, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        rows = self._rows(distinct, low, starts[where], stops[where])
        first, size = self.first[rows][which], self.size[rows][which]
        at = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        ids = self.pool[np.repeat(first - at[:-1], size) + np.arange(at[-1])]
        cuts = at[np.searchsorted(starts, np.concatenate(([0], ends)))].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        if foreign:
            order = sorted(foreign)
            for i, found in zip(order, super().texts([texts[i] for i in order]), strict=True):
                out[i] = found
        return out

    @staticmethod
    def _split(kind: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces start and stop; the last two characters must be blanks."""
        start = kind != SPACE
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        marks = np.flatnonzero(start & (low == ord("'")))
        one, two = low[marks + 1], low[marks + 2]
        short = np.isin(one, [ord(x) for x in "stmd"])
        pairs = [(one == ord(x[0])) & (two == ord(x[1])) for x in ("re", "ve", "ll")]
        long = np.logical_or.reduce(pairs) & ~short
        for found, n in ((marks[short], 2), (marks[long], 3)):
            start[found + 1] = False
            start[found + n] |= kind[found + n] != SPACE
        edge = np.flatnonzero(start | (kind == SPACE))
        begins = start[edge]
        return edge[begins], np.append(edge[1:], len(kind))[begins]

    def _rows(self, wanted: np.ndarray, low: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Rows of the sorted distinct hashes among the known pieces, after learning the new ones."""
        if len(self.known) > CACHED_PIECES or self.used > CACHED_IDS:
            self._forget()
        rows = np.searchsorted(self.known, wanted)
        new = np.ones(len(wanted), bool)
        inside = rows < len(self.known)
        new[inside] = self.known[rows[inside]] != wanted[inside]
        if not new.any():
            return rows
        text = low.astype("<u4").tobytes().decode("utf-32-le")
        tokenize, to_bytes = self.model.model.tokenize, self.bytes
        pieces = [text[a:b] for a, b in zip(starts[new].tolist(), stops[new].tolist())]
        found = [[t.id for t in tokenize(x if x.isascii() else x.translate(to_bytes))] for x in pieces]
        size = np.array([len(x) for x in found], np.int64)
        ids = np.array([i for x in found for i in x], "<u4")
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        self.pool[self.used : self.used + len(ids)] = ids
        at = rows[new]
        self.known = np.insert(self.known, at, wanted[new])
        self.first = np.insert(self.first, at, self.used + np.cumsum(size) - size)
        self.size = np.insert(self.size, at, size)
        self.used += len(ids)
        return np.searchsorted(self.known, wanted)


_tokenizers: dict[str | None, PieceTokenizer] = {}


def shared_tokenizer(path: str | None) -> PieceTokenizer:
    """One tokenizer a Python worker, so that tasks profit from what earlier ones have learnt."""
    if path not in _tokenizers:
        _tokenizers[path] = PieceTokenizer(path)
    return _tokenizers[path]
