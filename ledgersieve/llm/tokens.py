"""Token ids of whole texts by a public tokenizer, word by word."""

from __future__ import annotations

import os
from itertools import repeat

import numpy as np
import pyarrow as pa

WORD_BPE = "word_bpe_49k.json"
CACHED_WORDS = 500_000
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def vocabulary_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class WordEncoder:
    """Encode texts with a lower-casing tokenizer whose pieces never span ASCII white space.

    The ids of a text are then the ids of its words one after the other, and most words recur, so each distinct
    word is encoded once and kept, up to a fixed number of words. Words of Latin letters, with or without a comma
    or full stop after them, go straight to the tokenizer's BPE model: normalising and splitting would not change
    them. Other words go through the whole tokenizer, and so do texts that may hold a special token. Null and empty
    texts have no ids.
    """

    def __init__(self, path: str | None = None, cached_words: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        self.words_only = Tokenizer(self.tokenizer.model)
        self.words_only.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.tail = {c: self._whole([c.decode()])[0][0] for c in (b",", b".")}
        self.letters = _byte_letters()
        self.cached_words = cached_words
        self.clear()

    def clear(self) -> None:
        """Forget the words. What is kept: place of each word and stem, then start and count of its ids in ``flat``."""
        self.place: dict[bytes, int] = {}
        self.stems: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def _keep_only(self, words: list[bytes], at: np.ndarray) -> None:
        """Forget all words but some with their places; the frequent ones are in every run of texts."""
        count = self.count[at]
        flat = _gather(self.flat, self.start[at], count)
        self.clear()
        self._keep(flat, count)
        self.place = dict(zip(words, range(len(words)), strict=True))

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _keep(self, ids: np.ndarray, count: np.ndarray) -> int:
        """Add runs of ids to the tables; the place of the first."""
        first = len(self.start)
        self.start = np.concatenate([self.start, np.cumsum(count) - count + len(self.flat)])
        self.count = np.concatenate([self.count, count])
        self.flat = np.concatenate([self.flat, ids.astype(np.uint32)])
        return first

    def _learn(self, words: list[bytes]) -> None:
        """Encode words that are not known yet; each occurs once in the list."""
        place, stems = self.place, self.stems
        array = pa.array(words, pa.binary())
        offsets = np.frombuffer(array.buffers()[1], np.int32, len(words) + 1).astype(np.int64)
        raw = np.frombuffer(array.buffers()[2], np.uint8, offsets[-1])
        tail = raw[offsets[1:] - 1]
        ended = (tail == 44) | (tail == 46)
        ends = offsets[1:] - ended
        letters = np.concatenate([[0], np.cumsum(LETTER[raw], dtype=np.int32)])
        plain = (ends > offsets[:-1]) & (letters[ends] - letters[offsets[:-1]] == ends - offsets[:-1])
        high = np.concatenate([[0], np.cumsum(raw >= 128, dtype=np.int32)])
        beyond = np.flatnonzero(high[offsets[1:]] > high[offsets[:-1]])
        latin = [i for i in beyond.tolist() if _latin(words[i][:-1] if ended[i] else words[i])]
        plain[latin] = True
        odd = [words[i] for i in np.flatnonzero(~plain).tolist()]
        named = np.flatnonzero(plain)
        stem_of = [words[i][:-1] if e else words[i] for i, e in zip(named.tolist(), ended[named].tolist(), strict=True)]
        at = np.fromiter(map(stems.get, stem_of, repeat(-1)), np.int64, len(stem_of))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            unknown = [stem_of[i] for i in missing.tolist()]
            fresh = list(dict.fromkeys(unknown))
            runs = [self._spelt(fresh[i : i + 500]) for i in range(0, len(fresh), 500)]
            got = self.words_only.encode_batch_fast(runs, add_special_tokens=False)
            ids = np.concatenate([np.array(x.ids, np.uint32) for x in got])
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) != len(fresh):
                raise ValueError("the vocabulary does not mark word ends")
            first = self._keep(ids, np.diff(stops, prepend=0))
            stems.update(zip(fresh, range(first, first + len(fresh)), strict=True))
            at[missing] = [stems[s] for s in unknown]
        with_tail = ended[named]
        whole = np.flatnonzero(~with_tail)
        place.update(zip((stem_of[i] for i in whole.tolist()), at[whole].tolist(), strict=True))
        cut = np.flatnonzero(with_tail)
        if len(cut):
            own = at[cut]
            comma = tail[named[cut]] == 44
            tails = np.where(comma, self.tail[b","], self.tail[b"."])
            body = _gather(self.flat, self.start[own], self.count[own])
            ids = np.insert(body, np.cumsum(self.count[own]), tails.astype(np.uint32))
            first = self._keep(ids, self.count[own] + 1)
            place.update(zip((words[i] for i in named[cut].tolist()), range(first, first + len(cut)), strict=True))
        if odd:
            got = self._whole([w.decode() for w in odd])
            count = np.array([len(x) for x in got], np.int64)
            first = self._keep(np.concatenate([np.array(x, np.uint32) for x in got]), count)
            place.update(zip(odd, range(first, first + len(odd)), strict=True))

    def _spelt(self, stems: list[bytes]) -> str:
        """Some stems as the BPE model spells them, parted by spaces."""
        joined = b" ".join(stems)
        if joined.isascii():
            return joined.decode()
        return " ".join(
            s.decode() if s.isascii() else s.decode().lower().encode().decode("latin-1").translate(self.letters) for s in stems
        )

    def encode(self, texts: list[str | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and where each text's ids end. ``end_id`` is put after each text."""
        special = [i for i, text in enumerate(texts) if text and "<|" in text]
        lowered = [(text or "").encode("utf-8", "replace").lower() for text in texts]
        for i in special:
            lowered[i] = b""
        words, per_text = _words(lowered)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            unknown = [distinct[i] for i in missing.tolist()]
            self._learn(unknown)
            at[missing] = [self.place[w] for w in unknown]
        if len(self.place) > self.cached_words:
            self._keep_only(distinct, at)
            at = np.arange(len(distinct))
        at = at[coded.indices.to_numpy()] if len(distinct) else at
        count = self.count[at]
        ids = _gather(self.flat, self.start[at], count)
        text_ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum(per_text)]
        if special:
            got = self._whole([texts[i] for i in special])
            extra = np.zeros(len(texts), np.int64)
            extra[special] = [len(x) for x in got]
            where = np.repeat(text_ends[special], extra[special])
            ids = np.insert(ids, where, np.array([i for x in got for i in x], np.uint32))
            text_ends = text_ends + np.cumsum(extra)
        if end_id is not None:
            ids = np.insert(ids, text_ends, end_id)
            text_ends = text_ends + np.arange(1, len(texts) + 1)
        return ids, text_ends


def _words(texts: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """All words of some texts, as ASCII white space parts them, and how many each text has."""
    raw = np.frombuffer(b"\n".join(texts), np.uint8)
    space = SPACE[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[~space].tobytes())]
    )
    return words, np.diff(np.searchsorted(starts, begins))


def _latin(stem: bytes) -> bool:
    """Letters that one step of lower-casing and NFC leave as Python does."""
    text = stem.decode()
    return text.isalpha() and max(text) < "\u0130"


def _gather(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + count], one after the other."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total, dtype=np.int64) + np.repeat(start - (ends - count), count)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str | None = None) -> WordEncoder:
    """One encoder for each Python worker and vocabulary."""
    key = path or ""
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path)
    return _ENCODERS[key]


def forget() -> None:
    """Free the words that this Python worker's encoders keep; other operators call it before they need the memory."""
    for made in _ENCODERS.values():
        made.clear()


def binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for each run of an array."""
    offsets = np.concatenate([[0], ends]) * values.itemsize
    if offsets[-1] >= 2**31:
        raise ValueError("a run of texts is too long for one batch")
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())]
    )
