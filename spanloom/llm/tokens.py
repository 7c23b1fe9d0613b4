"""Encoders over public tokenizer files; the path is always a parameter."""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from spanloom.llm.common import LOWER, octets, text_bytes, word_hashes, word_spans


def tokenizer_path(name: str) -> str:
    """Where the installed public vocabulary file ``name`` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


class RankEncoder:
    """A byte-level vocabulary of ranks; special strings in a text are ordinary text."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's ids start and end."""
        return _joined([self.encoding.encode_ordinary(t or "") for t in column.to_pylist()])


class JsonEncoder:
    """A tokenizer file whose ids are asked for text by text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return _joined(self.ids([t or "" for t in column.to_pylist()]))


def _joined(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(ends[-1])), ends


def same_bytes(data: np.ndarray, begin: np.ndarray, other: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` bytes from ``begin`` in ``data`` and from ``at`` in ``other`` are equal."""
    lanes, others = octets(data), octets(other)
    same = np.ones(len(size), bool)
    on, done = np.flatnonzero(size > 0), 0
    while len(on):
        short = np.uint64(8) * np.maximum(8 - (size[on] - done), 0).astype(np.uint64)
        same[on] &= (lanes[begin[on] + done] ^ others[at[on] + done]) << short == 0
        done += 8
        on = on[(size[on] > done) & same[on]]
    return same


def distinct_words(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One occurrence of each distinct word, and for every word the index of its own.

    Words meet by hash; a word whose bytes differ from its first occurrence's counts as distinct.
    """
    _, first, back = np.unique(word_hashes(data, begin, end), return_index=True, return_inverse=True)
    size = end - begin
    same = size == size[first][back]
    on = np.flatnonzero(same)
    same[on] = same_bytes(data, begin[on], data, begin[first][back[on]], size[on])
    odd = np.flatnonzero(~same)
    back[odd] = len(first) + np.arange(len(odd))
    return np.concatenate((first, odd)), back


def _byte_letters() -> str:
    """The byte-level alphabet: printable bytes stand for themselves, others follow from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(spare)) for b in range(256))


# What the bytes of a lower-cased text are: blanks, letters (a-z), other printable ASCII without the apostrophe, the rest.
_SPACE, _LETTER, _SIGN, _REST = range(4)
_CLASS = np.full(256, _REST, np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[ord("'")] = _REST
_CLASS[97:123] = _LETTER
_CLASS[[32, *range(9, 14)]] = _SPACE
#: Second bytes of lower-case Latin-1 letters; the first one is 0xC3.
_LATIN = np.zeros(256, bool)
_LATIN[[*range(0x9F, 0xB7), *range(0xB8, 0xC0)]] = True


def part_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the parts of each text's words, and which parts are runs of letters.

    A word of lower-case ASCII and Latin-1 letters and of ASCII signs without the apostrophe is cut into runs of
    letters and runs of signs, as the splitter never joins the two. Any other word is one part.
    """
    kind = _CLASS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[_LATIN[data[lead + 1]]]
    kind[lead] = kind[lead + 1] = _LETTER
    solid = kind != _SPACE
    begin, end, _ = word_spans(data, offsets, solid)
    if not len(begin):
        return begin, end, np.zeros(0, bool)
    plain = ~np.logical_or.reduceat(kind == _REST, begin)
    turn = np.flatnonzero((kind[1:] != kind[:-1]) & solid[1:] & solid[:-1]) + 1
    word = np.searchsorted(begin, turn, "right") - 1
    turn = turn[plain[word] & (turn > begin[word])]
    parts = np.sort(np.concatenate((begin, turn)))
    letters = plain[np.searchsorted(begin, parts, "right") - 1] & (kind[parts] == _LETTER)
    return parts, np.sort(np.concatenate((end, turn))), letters


class WordEncoder(JsonEncoder):
    """A tokenizer that lower-cases, drops white space and never joins across it.

    Then a text's ids are those of the parts of its blank-separated words in order. Each distinct part
    of a batch is looked up once, by its bytes. The first KEPT short parts that a worker meets keep their ids,
    in arrays; other parts are encoded again in each batch, so any vocabulary gives the same ids.
    """

    #: Parts kept by one worker process (about 60 bytes each), and the bytes of the longest one kept.
    KEPT, SHORT = 400_000, 32

    def __init__(self, path: str):
        super().__init__(path)
        self.model = self.tokenizer.model
        self.alphabet = {b: c for b, c in enumerate(_byte_letters())}
        self.hashes = np.zeros(0, np.uint64)  # of the kept parts, sorted
        self.place = np.zeros(0, np.int64)  # their numbers, in order of arrival
        self.bytes, self.begin = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.flat, self.start = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @staticmethod
    def fits(path: str) -> bool:
        """Whether a file's normaliser and splitter are of the kind this class relies on."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split, *rest = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        return (
            steps == ["NFC", "Replace", "Lowercase"]
            and split.get("pattern") == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
            and split.get("behavior") == "Removed"
            and bool(split.get("invert"))
            and [r.get("type") for r in rest] == ["ByteLevel"]
        )

    def _encoded(self, parts: list[bytes], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts one after another, and where each one's start and end."""
        tokenize, alphabet = self.model.tokenize, self.alphabet
        shown = (p.decode() if p.isascii() else p.decode("latin-1").translate(alphabet) for p in parts)
        found = [[t.id for t in tokenize(p)] if own else [] for p, own in zip(shown, letters.tolist())]
        others = np.flatnonzero(~letters).tolist()
        for k in range(0, len(others), 1000):
            some = others[k : k + 1000]
            for i, ids in zip(some, self.ids([parts[i].decode() for i in some])):
                found[i] = ids
        return _joined(found)

    def _kept(self, data: np.ndarray, hashes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers of parts among the kept ones, -1 for others."""
        out = np.full(len(hashes), -1, np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            own = self.place[at]
            on = np.flatnonzero((self.hashes[at] == hashes) & (np.diff(self.begin)[own] == size))
            on = on[same_bytes(data, begin[on], self.bytes, self.begin[own[on]], size[on])]
            out[on] = own[on]
        return out

    def _keep(self, hashes: np.ndarray, parts: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        """Keep new parts while there is room; of parts with one hash only the first is kept."""
        short = np.flatnonzero(np.fromiter(map(len, parts), np.int64, len(parts)) <= self.SHORT)
        short = short[np.searchsorted(self.hashes, hashes[short]) == np.searchsorted(self.hashes, hashes[short], "right")]
        short = short[np.sort(np.unique(hashes[short], return_index=True)[1])][: self.KEPT - len(self.hashes)]
        if not len(short):
            return
        n, taken = len(self.hashes), [parts[i] for i in short.tolist()]
        size = np.diff(ends)[short]
        stops = np.cumsum(size)
        own = ids[np.arange(stops[-1]) + np.repeat(ends[short] - (stops - size), size)]
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(list(map(len, taken)))))
        self.bytes = np.concatenate((self.bytes, np.frombuffer(b"".join(taken), np.uint8)))
        self.start, self.flat = np.concatenate((self.start, self.start[-1] + stops)), np.concatenate((self.flat, own))
        hashes = np.concatenate((self.hashes, hashes[short]))
        order = np.argsort(hashes)
        self.hashes, self.place = hashes[order], np.concatenate((self.place, n + np.arange(len(short))))[order]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(column)
        data = LOWER[data]
        begin, end, letters = part_spans(data, offsets)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        first, back = distinct_words(data, begin, end)
        hashes, at, size = word_hashes(data, begin[first], end[first]), begin[first], (end - begin)[first]
        own = self._kept(data, hashes, at, size)
        new = np.flatnonzero(own < 0)
        flat = data.tobytes()
        parts = [flat[b:e] for b, e in zip(at[new].tolist(), (at + size)[new].tolist())]
        ids, ends = self._encoded(parts, letters[first[new]])
        start, count = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        met = np.flatnonzero(own >= 0)
        start[met], count[met] = self.start[own[met]], np.diff(self.start)[own[met]]
        start[new], count[new] = len(self.flat) + ends[:-1], np.diff(ends)
        flat = np.concatenate((self.flat, ids))
        if len(self.hashes) < self.KEPT:
            self._keep(hashes[new], parts, ids, ends)
        size, start = count[back], start[back]
        stops = np.cumsum(size)
        ids = flat[np.arange(stops[-1]) + np.repeat(start - (stops - size), size)]
        return ids, np.concatenate(([0], stops))[np.searchsorted(begin, offsets)]


#: Longer texts are encoded in parts.
LONG_TEXT = 1 << 20
_BETWEEN_WORDS = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def parts_of(text: str, limit: int | None = None) -> list[str]:
    """A long text in parts of about ``limit`` characters, each but the first from a space between letters on.

    Splitters take such a space with the word after it, so no token goes across. A text without
    such a space stays whole.
    """
    limit, parts, begin = limit or LONG_TEXT, [], 0
    while len(text) - begin > limit and (cut := _BETWEEN_WORDS.search(text, begin + limit)):
        parts.append(text[begin : cut.start()])
        begin = cut.start()
    return [*parts, text[begin:]]


class ByteLevelEncoder(JsonEncoder):
    """A byte-level tokenizer file, encoded by the same ranks and splitter in a faster library.

    Texts with characters outside long-settled Latin and punctuation blocks, where the two libraries'
    tables of letters might differ, are left to the file's own library.
    """

    _ODD = re.compile("[^\x00-\u024f\u2010-\u2027\u2030-\u205e]")

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        super().__init__(path)
        ranks = {t: i for i, t in enumerate(self.token_bytes()) if t is not None}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def fits(path: str) -> bool:
        """Whether a file splits in the usual way, changes nothing else, and merges in the order of its ids."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
        plain = not spec.get("normalizer") and (split.get("type"), split.get("use_regex"), split.get("add_prefix_space")) == ("ByteLevel", True, False)
        merges = [m if isinstance(m, str) else "".join(m) for m in model.get("merges", [])]
        made = [model["vocab"].get(m.replace(" ", "")) for m in merges]
        return plain and bool(made) and made == list(range(256, 256 + len(made)))

    def token_bytes(self) -> list[bytes | None]:
        """The bytes of every id; None for special ones."""
        octet = {c: b for b, c in enumerate(_byte_letters())}
        special = self.tokenizer.get_added_tokens_decoder()
        tokens = (None if i in special else self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size()))
        return [None if t is None else bytes(octet[c] for c in t) for t in tokens]

    def encode(self, column: pa.Array, lead: str = "") -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`RankEncoder.encode`; ``lead`` is put before each text."""
        found = []
        for text in column.to_pylist():
            parts = parts_of(lead + (text or ""))
            found.append([i for p in parts for i in (self.ids([p])[0] if self._ODD.search(p) else self.encoding.encode_ordinary(p))])
        return _joined(found)


class PieceEncoder:
    """A sentencepiece model, which itself adds a space before a text that isn't empty."""

    MARK = "\u2581"

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = "\ufb01  \u2460 a "  # stays as it is where a model normalises nothing
        # Without a mark inside pieces none goes across the place before a space.
        self.known: dict[bytes, list[int]] = {}
        self.apart = self.model.normalize(probe) == (" " + probe).replace(" ", self.MARK) and not any(self.MARK in p.lstrip(self.MARK) for p in self.pieces)

    def token_bytes(self) -> list[bytes | None]:
        """The bytes of every id; None for control ids."""
        byte = re.compile(r"<0x([0-9A-F]{2})>")
        out: list[bytes | None] = []
        for i, piece in enumerate(self.pieces):
            if self.model.is_control(i) or self.model.is_unknown(i):
                out.append(None)
            elif self.model.is_byte(i):
                out.append(bytes([int(byte.fullmatch(piece)[1], 16)]))
            else:
                out.append(piece.replace(self.MARK, " ").encode())
        return out

    #: Runs of letters whose ids one worker process keeps (about 300 bytes each).
    KEPT = 120_000

    def _ids(self, runs: list[bytes]) -> list[list[int]]:
        """Ids of runs that begin with the space that the model adds."""
        found = self.model.encode([r[1:].decode() for r in runs], num_threads=1)
        alone = [self.model.piece_to_id(self.MARK)]
        return [ids if r != b" " else alone for r, ids in zip(runs, found)]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`RankEncoder.encode`; each distinct run from one space on is encoded once in a batch.

        The first KEPT runs that a worker meets keep their ids.
        """
        if not self.apart:
            return _joined([self.model.encode(t or "", num_threads=1) for t in column.to_pylist()])
        data, offsets = text_bytes(column)
        some = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][some], 32)
        offsets = offsets + np.concatenate(([0], np.cumsum(some)))
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        is_start = np.zeros(len(data) + 1, bool)
        is_start[offsets] = True
        # The mark's own last byte is 0x81: a mark in a text counts as a space.
        is_start[1:-1] |= (data[1:] == 32) & (data[:-1] != 32) & (data[:-1] != 0x81)
        bounds = np.flatnonzero(is_start)
        runs = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        runs = runs.dictionary_encode()
        words = runs.dictionary.to_pylist()
        known = list(map(self.known.get, words))
        new = [k for k, ids in enumerate(known) if ids is None]
        for k, ids in zip(new, self._ids([words[k] for k in new])):
            known[k] = ids
            if len(self.known) < self.KEPT:
                self.known[words[k]] = ids
        flat, ends = _joined(known)
        at = runs.indices.to_numpy()
        start, size = ends[:-1][at], np.diff(ends)[at]
        stops = np.cumsum(size)
        ids = flat[np.arange(stops[-1]) + np.repeat(start - (stops - size), size)]
        return ids, np.concatenate(([0], stops))[np.searchsorted(bounds, offsets)]


@lru_cache(maxsize=2)
def load_encoder(path: str) -> RankEncoder | JsonEncoder | PieceEncoder:
    """The encoder of a vocabulary file, one for each worker process and file."""
    if path.endswith(".tiktoken"):
        return RankEncoder(path)
    if path.endswith(".model"):
        return PieceEncoder(path)
    if ByteLevelEncoder.fits(path):
        return ByteLevelEncoder(path)
    return WordEncoder(path) if WordEncoder.fits(path) else JsonEncoder(path)
