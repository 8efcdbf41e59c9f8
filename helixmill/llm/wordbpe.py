"""Encoding of whole texts word by word with the tokenizers library.

The tokenizer drops white space before it merges and its special tokens hold none, so a text's ids are the
ids of its white-space separated words, one after another. Arrow splits and numbers the words of a batch; a worker
looks up its distinct words alone, in a table of bounded size, has new ones encoded many at a time, and takes the
ids of all the batch's texts from one flat array.
"""

from __future__ import annotations

import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import span_hashes

_LOADED: dict[str, object] = {}


def load(path: str):
    """The tokenizer, without truncation and padding, loaded once for each worker."""
    if path not in _LOADED:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _LOADED[path] = t
    return _LOADED[path]


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of a column of texts: for each word its place among the distinct ones, the distinct words, and the
    index of each text's first word (and the end). Split and numbered in Arrow, so no text becomes Python objects.

    Words are parted by ASCII white space. Other white space stays inside a word, which the tokenizer parts itself;
    a text that begins or ends with white space has an empty word there, without ids.
    """
    lists = pc.ascii_split_whitespace(texts)
    cuts = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, cuts - cuts[0]


def encode_words(t, words: list[str], at_once: int = 256) -> list[bytes]:
    """Little-endian unsigned 16 bit ids of each word. Words go to the library in rows, parted by a special token."""
    special = {i: a.content for i, a in t.get_added_tokens_decoder().items()}
    sep_id, sep = max(special.items()) if special else (None, None)
    plain = [i for i, w in enumerate(words) if sep and not any(s in w for s in special.values())]
    out: list[bytes | None] = [None] * len(words)
    rows = [plain[i : i + at_once] for i in range(0, len(plain), at_once)]
    for row, got in zip(rows, t.encode_batch_fast([sep.join(words[i] for i in row) for row in rows], add_special_tokens=False) if rows else []):
        ids = np.array(got.ids, dtype="<u2")
        parts = np.flatnonzero(ids == sep_id)
        if len(parts) != len(row) - 1:
            raise ValueError("the separator was not kept apart")
        data, cuts = ids.tobytes(), [0, *((parts + 1) * 2).tolist()]
        ends = [*(parts * 2).tolist(), len(data)]
        for i, a, b in zip(row, cuts, ends):
            out[i] = data[a:b]
    for i, x in enumerate(out):
        if x is None:
            out[i] = array.array("H", t.encode(words[i], add_special_tokens=False).ids).tobytes()
    return out  # type: ignore[return-value]


def hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of the bytes of each word, computed over the column's buffer."""
    if not len(words):
        return np.zeros(0, np.uint64)
    words = words.cast(pa.large_string())
    offset = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offset[0] : offset[-1]] if words.buffers()[2] else np.zeros(0, np.uint8)
    return span_hashes(data, offset[:-1] - offset[0], offset[1:] - offset[0])


class _Table:
    """Ids of words by the words' hashes: sorted keys, and the place and size of each word's ids in one flat array.

    No word is kept as an object, so a million words take some 30 MB. Words that share a key would be taken for each
    other; of n words, short ones only, that has a probability of n^2 / 2^65 (10^-7 for two million).
    """

    def __init__(self):
        self.key, self.at, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row of each key, and whether there is one."""
        order = np.argsort(key)  # keys in order walk through the table once
        row = np.empty(len(key), np.int64)
        row[order] = np.searchsorted(self.key, key[order])
        row[row == len(self.key)] = 0
        return row, self.key[row] == key if len(self.key) else np.zeros(len(key), bool)

    def add(self, key: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """New words (distinct, not in the table) and their ids one after another."""
        at = len(self.flat) + np.cumsum(size) - size
        order = np.argsort(key)
        where = np.searchsorted(self.key, key[order])
        self.key, self.at, self.size = (np.insert(own, where, new[order]) for own, new in ((self.key, key), (self.at, at), (self.size, size)))
        self.flat = np.concatenate((self.flat, ids))


def gather(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of `flat` one after another."""
    ends = np.cumsum(size)
    return flat[np.repeat(at - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(map(len, parts), np.int64, len(parts)) // 2, np.frombuffer(b"".join(parts), "<u2")


#: A run of these letters, and ASCII marks after it, are cut apart by the tokenizer as written here; each upper-case
#: letter has one lower-case letter in the range.
_COMMON = "^(?P<core>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]{1,64})(?P<mark>[!-/:-@\\[-`{-~]{0,64})$"
_BYTE_CHARS = {c: "".join(chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255 else chr(256 + [*range(33), *range(127, 161), 173].index(b)) for b in chr(c).encode()) for c in range(0xDF, 0x100)}
_LONGEST = 128  # bytes of a word that has a place in a table


class Encoder:
    """Ids of whole texts. Words and their letters' ids are kept in tables; beyond `limit` rows a table starts anew,
    so memory is bounded."""

    def __init__(self, path: str, limit: int = 1_500_000):
        self.t, self.limit = load(path), limit
        self.model = self.t.model
        if self.t.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids must fit 16 bits")
        # the library's own BPE model is asked for lower-case words, where the steps before it are plain
        probe = ["\u00e9t\u00e9", "stra\u00dfe", "abc"]
        self.direct = all(self._core(w) == self.t.encode(w, add_special_tokens=False).ids for w in probe) and self.t.encode("ABC\u00c9.", add_special_tokens=False).ids == self._core("abc\u00e9") + self.t.encode(".", add_special_tokens=False).ids
        self.words, self.cores = _Table(), _Table()

    def _core(self, word: str) -> list[int]:
        return [x.id for x in self.model.tokenize(word if word.isascii() else word.translate(_BYTE_CHARS))]

    def _cores(self, cores: pa.Array) -> np.ndarray:
        """Rows of distinct lower-case cores in their table; new ones are tokenised."""
        key = hashes(cores)
        row, known = self.cores.find(key)
        if not known.all():
            new = np.flatnonzero(~known)
            todo = cores.take(pa.array(new)).to_pylist()
            self.cores.add(key[new], *_joined([array.array("H", self._core(w)).tobytes() for w in todo]))
            row, _ = self.cores.find(key)
        return row

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of distinct words, and their ids one after another, without a look at the words' table."""
        split = pc.extract_regex(words, _COMMON) if self.direct else pa.nulls(len(words))
        common = np.asarray(split.is_valid())
        rest, plain = np.flatnonzero(~common), np.flatnonzero(common)
        size, ids = _joined(encode_words(self.t, words.take(pa.array(rest)).to_pylist()))
        if not len(plain):
            return size, ids
        split = split.take(pa.array(plain))
        core, mark = (pc.struct_field(split, [i]).dictionary_encode() for i in (0, 1))
        lower = pc.utf8_lower(core.dictionary).dictionary_encode()
        row = self._cores(lower.dictionary)[lower.indices.to_numpy()][core.indices.to_numpy()]
        mark_size, mark_ids = _joined(encode_words(self.t, mark.dictionary.to_pylist()))
        mark_at = np.cumsum(mark_size) - mark_size
        of = mark.indices.to_numpy()
        # a word's ids are two stretches, of its core and of its marks; a word of the rest has one
        flat = np.concatenate((ids, self.cores.flat, mark_ids))
        at, sizes = np.zeros((len(words), 2), np.int64), np.zeros((len(words), 2), np.int64)
        at[rest, 0], sizes[rest, 0] = np.cumsum(size) - size, size
        at[plain, 0], sizes[plain, 0] = len(ids) + self.cores.at[row], self.cores.size[row]
        at[plain, 1], sizes[plain, 1] = len(ids) + len(self.cores.flat) + mark_at[of], mark_size[of]
        out = sizes.sum(axis=1), gather(flat, at.ravel(), sizes.ravel())
        if len(self.cores.key) > self.limit:
            self.cores = _Table()
        return out

    def _find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place and size of the ids of distinct words, and the flat array they lie in."""
        key, short = hashes(words), np.asarray(pc.binary_length(words)) <= _LONGEST
        row, known = self.words.find(key)
        known &= short
        new = np.flatnonzero(~known)
        if len(new):
            size, ids = self.encode(words.take(pa.array(new)))
            begin = np.cumsum(size) - size
            kept = short[new]
            if kept.all():
                self.words.add(key[new], size, ids)
            else:
                self.words.add(key[new[kept]], size[kept], gather(ids, begin[kept], size[kept]))
            row, _ = self.words.find(key)
        at, sizes, flat = self.words.at[row] if len(self.words.key) else np.zeros(len(key), np.int64), self.words.size[row] if len(self.words.key) else np.zeros(len(key), np.int64), self.words.flat
        if not short.all():
            long = new[~short[new]]
            at[long], sizes[long], flat = len(flat) + begin[~kept], size[~kept], np.concatenate((flat, ids))
        return at, sizes, flat

    def __call__(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids (unsigned 16 bits) of all texts one after another, each followed by `end` if there is one, and
        where each text begins (and the last one ends)."""
        of, distinct, cuts = words_of(texts)
        at, size, flat = self._find(distinct)
        size = size[of]
        ids = gather(flat, at[of], size)
        cuts = np.concatenate(([0], np.cumsum(size)))[cuts]
        if end is not None:
            ids, cuts = np.insert(ids, cuts[1:], np.uint16(end)), cuts + np.arange(len(cuts))
        if len(self.words.key) > self.limit:
            self.words = _Table()
        return ids, cuts


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder; it outlives a task where Spark reuses workers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def release() -> None:
    """Drop the worker's tables, where a later stage needs the memory and encodes no more."""
    _ENCODERS.clear()
