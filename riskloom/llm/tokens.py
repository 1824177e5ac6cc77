"""Token ids of whole texts with a public tokenizer file, by pieces between spaces.

Both tokenizer kinds split a text before they merge, and never across the start of a run of ASCII white
space; so a text's ids are those of its pieces (a run and the word behind it), one after another. The pieces of a step, some
megabytes of texts, become an Arrow dictionary: each different piece is learned once, all together, and the ids of the
texts are one ``take`` from the ids of the pieces.
A byte-level tokenizer whose merges are in the order of their ids is a rank table, by which tiktoken encodes the new pieces of Latin text
in one call; the bytes of the tokens tell where each piece ends.
Otherwise, a piece of Latin letters and a run of ASCII punctuation behind it (after at
most one space, where spaces are kept) splits just there, so its two units go straight to the tokenizer's
merge model. All other pieces, those with a special string among them, take the whole tokenizer. What is encoded one by one
stays in a bounded cache per Python worker; it has two generations, so that pieces in use outlive the many that occur once.
Texts with other white space, where a run may mix kinds, are encoded whole by tokenizers that keep white space.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskloom.llm.words import chunks, text_buffer

#: Entries of a generation of a worker's cache (the next one starts at the next step beyond them), text bytes of a
#: step, and bytes of new pieces that the rank table encodes at a time.
CACHE_ENTRIES = 300_000
STEP_BYTES = 16 << 20
LEARN_BYTES = 1 << 20
#: Bytes beyond which a piece takes the whole tokenizer (tiktoken's pattern matcher gives up on very long runs).
LONG_PIECE = 1 << 12

_OTHER_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_OTHER_STARTS = (b"\x1c", b"\x1d", b"\x1e", b"\x1f", b"\xc2", b"\xe1", b"\xe2", b"\xe3")


def _has_other_space(text: bytes) -> bool:
    return any(b in text for b in _OTHER_STARTS) and _OTHER_SPACE.search(text) is not None


#: Letters (A-Z, a-z and those of U+00C0 to U+00FF), by their bytes.
_LETTERS = r"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
#: Pieces of letters and punctuation, by their bytes: spaces kept, or dropped.
_KEPT = rf"^(?P<word> ?{_LETTERS})(?P<marks>[!-/:-@\[-`{{-~]*)$"
_DROPPED = rf"^[\t-\r ]*(?P<word>{_LETTERS})(?P<marks>[!-/:-@\[-`{{-~]*)$"
#: Pieces that the rank table encodes together: ASCII white space, then characters up to U+024F that are none.
_JOINED = r"^[\t-\r ]+(?:[\x00-\x08\x0e-\x1b!-\x7f]|\xc2[\x80-\x84\x86-\x9f\xa1-\xbf]|[\xc3-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+$"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Byte-level tokenizers write a byte as the character of its number if that is printable, else as the next one from U+0100.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = np.arange(256, dtype="<u4")
_BYTE_CHARS[[b for b in range(256) if b not in _PRINTABLE]] = 256 + np.arange(256 - len(_PRINTABLE))
#: Beyond it the libraries may know different letters.
_LATIN_END = "\u024f"
#: Fixed value: the split pattern of the byte-level tokenizer.
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class _Cache(dict):
    """Ids of pieces, if the generation before has none, by ``learn``."""

    def __init__(self, learn) -> None:
        super().__init__()
        self.learn, self.before = learn, {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self[piece] = self.before.get(piece) or self.learn(piece)
        return ids

    def age(self) -> None:
        self.before = dict(self)
        self.clear()

    def forget(self) -> None:
        self.before = {}
        self.clear()


def rank_table(path: str):
    """The byte-level tokenizer of a file as a tiktoken rank table; None if its merges are not in the order of their ids,
    if it does not split by BYTE_LEVEL_SPLIT, or if it changes texts before."""
    import tiktoken

    with open(path) as f:
        spec = json.load(f)
    split, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if not plain or spec.get("normalizer") or model.get("type") != "BPE" or model.get("end_of_word_suffix") or model.get("ignore_merges"):
        return None
    byte_of = {chr(c): b for b, c in enumerate(_BYTE_CHARS.tolist())}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {}
    for token, i in model["vocab"].items():
        if token not in special:
            if not all(c in byte_of for c in token):
                return None
            ranks[bytes(byte_of[c] for c in token)] = i
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(set(merged)) or len(merged) + 256 != len(ranks):
        return None
    return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={})


def _binary(data, at: np.ndarray) -> pa.LargeBinaryArray:
    """The runs of ``data`` between the byte offsets ``at``, without a copy."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(data)])


def _buffers(column: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and bytes of a column without nulls."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def _objects(column: pa.Array) -> list:
    """As to_pylist(), which makes a scalar of each value first."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """keeps_space: white space is part of the ids (byte-level kinds); otherwise it only separates."""

    def __init__(self, path: str, keeps_space: bool, end_id: int) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = keeps_space
        self.end = np.array([end_id], np.uint32).tobytes()
        self.cache = _Cache(self._learn)
        self.merge = self.tokenizer.model.tokenize
        normalizer = self.tokenizer.normalizer
        self.lowers = normalizer is not None and normalizer.normalize_str("A") == "a"
        self.ranked = rank_table(path) if keeps_space else None
        if self.ranked is not None:
            self.token_bytes = np.zeros(self.ranked.n_vocab, np.int64)
            for token in self.ranked.token_byte_values():
                self.token_bytes[self.ranked.encode_single_token(token)] = len(token)
        #: Pieces with one of these strings take the whole tokenizer.
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, text: bytes) -> bytes:
        return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()

    def _merged(self, words: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Ids of words: letters, in lower case if the tokenizer lowers, after at most one space."""
        data = np.frombuffer(b"\n".join(_objects(words)), np.uint8)
        ids, ends = array("I"), [0]
        chars = np.where(data == 10, np.uint32(10), _BYTE_CHARS[data])
        for word in chars.tobytes().decode("utf-32-le").split("\n") if len(words) else []:
            ids.extend([t.id for t in self.merge(word)])
            ends.append(len(ids))
        return _binary(ids.tobytes(), 4 * np.array(ends))

    def _learn(self, piece: bytes) -> bytes:
        """Ids of a piece that the cache does not have and that is not learned with others."""
        if self.ranked is None or len(piece) > LONG_PIECE or _has_other_space(piece) or any(x in piece for x in self.special):
            return self._ids(piece)
        text = piece.decode()
        if not (text.isascii() or max(text) <= _LATIN_END):
            return self._ids(piece)
        return array("I", self.ranked.encode_ordinary(text)).tobytes()

    def _each(self, pieces: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Ids of pieces one by one."""
        found = _objects(pieces) if self.keeps_space else [p.strip() for p in _objects(pieces)]
        return pa.array([self._ids(p) if len(p) > LONG_PIECE else self.cache[p] for p in found], pa.large_binary())

    def _joined(self, pieces: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Ids of pieces of _JOINED by the rank table, many in a call: no token goes from one into the next."""
        at, data = _buffers(pieces)
        ids, ends, n = [], [np.zeros(1, np.int64)], 0
        for i, j in chunks(at, LEARN_BYTES):
            own = np.array(self.ranked.encode_ordinary(data[at[i] : at[j]].tobytes().decode()), np.uint32)
            ids.append(own)
            ends.append(n + 1 + np.searchsorted(np.cumsum(self.token_bytes[own]), at[i + 1 : j + 1] - at[i]))
            n += len(own)
        return _binary(np.concatenate([np.zeros(0, np.uint32), *ids]), 4 * np.concatenate(ends))

    def _by_units(self, words: pa.LargeBinaryArray, marks: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Ids of words and the marks behind them."""
        if self.lowers:
            words = pc.utf8_lower(words.cast(pa.large_string())).cast(pa.large_binary())
        words, marks = words.dictionary_encode(), marks.dictionary_encode()
        behind = pa.array([self.cache[m] if m else b"" for m in _objects(marks.dictionary)], pa.large_binary())
        both = self._merged(words.dictionary).take(words.indices), behind.take(marks.indices)
        return pc.binary_join_element_wise(*both, pa.scalar(b"", pa.large_binary()))

    def learn(self, pieces: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Ids of different pieces."""
        if self.ranked is not None:
            together = pc.and_(pc.match_substring_regex(pieces, _JOINED), pc.less_equal(pc.binary_length(pieces), LONG_PIECE))
        else:
            split = pc.extract_regex(pieces, _KEPT if self.keeps_space else _DROPPED)
            together = split.is_valid()
        for x in self.special:
            together = pc.and_not(together, pc.match_substring(pieces, x))
        if self.ranked is not None:
            ids = self._joined(pieces.filter(together))
        else:
            ids = self._by_units(*split.filter(together).flatten())
        own = together.to_numpy(zero_copy_only=False)
        place = np.empty(len(own), np.int64)
        place[np.argsort(~own, kind="stable")] = np.arange(len(own))
        return pa.concat_arrays([ids, self._each(pieces.filter(pc.invert(together)))]).take(pa.array(place))

    def encode_texts(self, raw: np.ndarray, offsets: np.ndarray) -> pa.LargeBinaryArray:
        """Little-endian unsigned 32-bit ids of each text (bytes between the offsets), the end id last."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.age()
        space = _SPACE[raw]
        first = space.copy()
        first[1:] &= ~space[:-1]
        if self.keeps_space:
            data, at = raw.tobytes(), offsets.tolist()
            for i, j in zip(at[:-1], at[1:]):
                if _has_other_space(data[i:j]):
                    first[i:j] = False  # one piece
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(first)
        pieces = _binary(np.ascontiguousarray(raw), np.append(starts, len(raw))).dictionary_encode()
        ids = pa.concat_arrays([self.learn(pieces.dictionary), pa.array([self.end], pa.large_binary())])
        ends = np.searchsorted(starts, offsets[1:])  # pieces before the end of each text
        index = np.insert(pieces.indices.to_numpy(), ends, len(pieces.dictionary))
        at, data = _buffers(ids.take(pa.array(index)))
        return _binary(data, np.append(0, at[ends + np.arange(len(ends)) + 1]))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """``encode_texts`` of a list."""
        offsets = np.cumsum([0, *map(len, texts)])
        return self.encode_texts(np.frombuffer(b"".join(texts), np.uint8), offsets).to_pylist()


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, keeps_space: bool, end_id: int) -> Encoder:
    key = (path, keeps_space, end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def forget_pieces(path: str, keeps_space: bool, end_id: int) -> None:
    """Free the cache, which would otherwise stay in the worker while it runs later stages."""
    encoder(path, keeps_space, end_id).cache.forget()


def encode_column(path: str, keeps_space: bool, end_id: int, table: pa.Table, text: str) -> pa.Table:
    """Replace the text column by ``ids`` (binary) and their number ``_n``; null texts are empty."""
    raw, offsets = text_buffer(table[text])
    own = encoder(path, keeps_space, end_id)
    steps = [own.encode_texts(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in chunks(offsets, STEP_BYTES)]
    ids = pa.chunked_array(steps, pa.large_binary())
    counts = pc.divide(pc.binary_length(ids), 4)
    return table.drop_columns([text]).append_column("ids", ids).append_column("_n", counts)


def id_arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a part and the ids before each document in it (one more entry than documents)."""
    column = table["ids"].combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.uint32) if data is not None else np.zeros(0, np.uint32)
    return flat, (at - at[0]) // 4
