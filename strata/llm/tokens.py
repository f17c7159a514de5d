"""Token ids of whole texts from a byte-level BPE file of the tokenizers library, fast enough for a corpus.

Byte-level BPE never merges across the start of a word, so a text may be cut before each space or line feed that follows
a character other than white space, and the ids of the parts, one after the other, are the ids of the text. Nor does it merge
a letter with a mark behind it (but for the apostrophe), so words are also cut there: a word with and without its comma is
one part. Parts repeat, so each worker keeps the ids of parts it has met. The library encodes every part; only repetition
is saved. The cuts are found on a batch's bytes, Arrow numbers the distinct parts and puts the ids of all together, so Python
sees a part once a batch.
"""

from __future__ import annotations

import functools
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from strata.llm.common import byte_buffer

BYTE_BPE = "byte_bpe_50k.json"
KEPT_WORDS = 1_000_000

# white space other than single spaces and line feeds, each after another character
_RARE_BLANK = r"[ \n]{2}|[\t\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_CUT = re.compile("(?<=[^\\s᠎])(?=[ \n])")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_IS_MARK, _IS_LETTER = np.zeros(256, bool), np.zeros(256, bool)
_IS_MARK[list(_MARKS.encode())] = True
_IS_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_BEFORE_MARK = " a"  # a word that a part which begins with a mark may follow


@functools.lru_cache(maxsize=2)
def encoder(name: str = BYTE_BPE, kept_words: int = KEPT_WORDS) -> WordEncoder:
    """The encoder of this Python worker; it outlives a task, so the next one finds the words it knows."""
    return WordEncoder(name, kept_words)


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers, one bytes object per text.

    ``kept_words`` bounds the memory: of more known parts, the half that the fewest batches held is dropped with the next call.
    """

    def __init__(self, name: str = BYTE_BPE, kept_words: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of_id = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of_id[number] = len(token)  # the file's alphabet has one character per byte
        added = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.rare = "|".join([_RARE_BLANK, *added])  # a token that was added may hold a letter before a mark
        self.before_mark = len(self._ids(_BEFORE_MARK))
        self.kept_words = kept_words
        self.forget()

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        rare = pc.match_substring_regex(column, self.rare).to_numpy(zero_copy_only=False)
        out = np.empty(len(column), object)
        for chosen, parts_of in ((~rare, _words), (rare, _careful_words)):
            if chosen.any():
                out[chosen] = self._joined_ids(*parts_of(column if chosen.all() else column.filter(pa.array(chosen))))
        return out.tolist()

    def forget(self) -> None:
        """Drops the parts met so far, for workers that go on to other work."""
        self.number_of: dict[bytes, int] = {}
        self.ids, self.ends, self.batches = np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _joined_ids(self, parts: pa.Array, starts: np.ndarray) -> list[bytes]:
        """Ids of the texts whose parts begin at ``starts``."""
        encoded = parts.dictionary_encode()
        number = self._numbers(encoded.dictionary.to_pylist())
        known = pa.Array.from_buffers(pa.large_binary(), len(self.ends) - 1, [None, pa.py_buffer(self.ends), pa.py_buffer(self.ids)])
        raw, ends = byte_buffer(known.take(pa.array(number[encoded.indices.to_numpy()])))
        cuts = ends[starts].tolist()
        return [raw[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _numbers(self, parts: list[bytes]) -> np.ndarray:
        """The places of these distinct parts among the known ones."""
        if len(self.number_of) > self.kept_words:
            self._drop_half()
        found = np.fromiter(map(self.number_of.get, parts, repeat(-1)), np.int64, len(parts))
        fresh = np.flatnonzero(found < 0)
        if len(fresh):
            names, first = [parts[i] for i in fresh.tolist()], len(self.number_of)
            ids = self._encode_parts(names)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), np.uint8)])
            self.batches = np.concatenate([self.batches, np.zeros(len(ids), np.uint32)])
            self.number_of.update(zip(names, range(first, first + len(names))))
            found[fresh] = np.arange(first, first + len(names))
        self.batches[found] += 1
        return found

    def _drop_half(self) -> None:
        known = len(self.batches)
        kept = np.zeros(known, bool)
        kept[np.argsort(self.batches, kind="stable")[known // 2 :]] = True  # of equal ones those met last
        names = [name for name, keep in zip(self.number_of, kept.tolist(), strict=True) if keep]
        sizes = np.diff(self.ends)
        self.ids = self.ids[np.repeat(kept, sizes)]
        self.ends = np.concatenate([[0], np.cumsum(sizes[kept])])
        self.batches = self.batches[kept] >> 1
        self.number_of = dict(zip(names, range(len(names))))

    def _encode_parts(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each part. Parts that may follow one another are encoded as one text and told apart by their bytes."""
        out: list[bytes | None] = [None] * len(parts)
        texts = [p.decode() for p in parts]
        blank = " \n"
        joined = [i for i, t in enumerate(texts) if (t[:1] in blank or t[0] in _MARKS) and not (t[-1:].isspace() or t[-1:] in "\u180e")]
        for at in range(0, len(joined), 1000):
            some = joined[at : at + 1000]
            own = [texts[i] if texts[i][0] in blank else _BEFORE_MARK + texts[i] for i in some]
            ids = self._ids("".join(own))
            ends = np.cumsum([len(t.encode()) for t in own])
            cuts = np.searchsorted(np.cumsum(self.bytes_of_id[ids]), ends) + 1
            raw, start = ids.tobytes(), 0
            for i, end in zip(some, (cuts * 4).tolist(), strict=True):
                out[i] = raw[start if texts[i][0] in blank else start + 4 * self.before_mark : end]
                start = end
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = self._ids(texts[i]).tobytes()
        return out

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of texts in which each space or line feed begins a part, and where each text's parts begin."""
    data, starts = byte_buffer(column)
    opens = (data == 0x20) | (data == 0x0A)
    marks = np.flatnonzero(_IS_MARK[data])
    marks = marks[marks > 1]
    before, lead = data[marks - 1], data[marks - 2]
    accented = (lead == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)  # U+00C0 to U+00FF, which are letters but two
    opens[marks[_IS_LETTER[before] | accented]] = True
    opens[starts[:-1][starts[:-1] < starts[1:]]] = True
    at = np.append(np.flatnonzero(opens), len(data))
    parts = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
    return parts, np.searchsorted(at, starts)


def _careful_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The same for any texts: cut only where a space or line feed follows a character other than white space."""
    lists = [_CUT.split(text) for text in column.to_pylist()]
    starts = np.concatenate([[0], np.cumsum([len(parts) for parts in lists])])
    return pa.array([part.encode() for parts in lists for part in parts], pa.large_binary()), starts
