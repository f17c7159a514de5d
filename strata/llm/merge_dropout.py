"""Subword encoding with seeded merge dropout, for a merge-type (BPE) SentencePiece model.

A word's characters are merged pair by pair, the best-scored pair first (leftmost of equals), as the model's library does.
Each candidate taken from the agenda is skipped with probability ``dropout``, decided for every occurrence of a word by a
hash of the seed, the row's key, the word's place in the text and the candidate's number on the agenda. So the same call
gives the same pieces anywhere, and another seed other pieces; with dropout 0 the pieces are the library's.

A task keeps the undropped pieces of words it has met. Occurrences whose draws skip nothing take these; the others are
merged together, a row of symbols each: one step takes the first candidate of every row's agenda.

Characters without a piece, and the model's blank mark itself where a text holds it, become their bytes, so decoding
returns every text exactly.

Defined cases: a null text is empty, and empty text has no pieces; repeated rows get the same pieces; null keys are the
text "null"; an empty table gives no rows; a word over 32 characters that pieces hold together is merged by a heap, alone.
Columns that the results replace (piece_ids, n_pieces, ids_crc32, decoded) are dropped first; keys may have these names.
"""

from __future__ import annotations

import functools
import heapq
import os
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh_name, mixed, slices, tasks_need_package, thrifty

PIECE_BPE = "piece_bpe_32k.model"
BLANK = "▁"
KEPT_WORDS = 300_000
LONG_WORD = 32
WIDTHS = (2, 4, 6, 8, 10, 12, 16, 24, 32)
RUN_CHARS, RUN_UNITS = 2**20, 2**18
_MASK = 2**64 - 1
_STEP = 0x9E3779B97F4A7C15
_NEVER = 2**31 - 1
_LITERAL = ""  # stands for a blank mark that is a character of the text; no word is empty
# texts whose words do not simply lie between single blanks: empty, blanks at the start or in a row, a blank mark, a long word
_UNEVEN = f"^$|^ |  |{BLANK}|[^ ]{{{LONG_WORD}}}"


def _mix(x: int) -> int:
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & _MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & _MASK
    return x ^ x >> 31


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return flat[at]


class Pieces:
    """The model's pieces and the words met so far.

    A symbol is a piece or a character without one; symbols that are pieces have the piece's number, others one behind.
    """

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=name if os.path.isabs(name) else public_tokenizers.path(name))
        size = model.get_piece_size()
        ordinary = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in ordinary}
        self.scores = [model.get_score(i) for i in range(size)]
        self.bytes = [int(model.id_to_piece(i)[3:5], 16) for i in range(size) if model.is_byte(i)]
        first = next(i for i in range(size) if model.is_byte(i))
        self.byte_ids = {b: first + n for n, b in enumerate(self.bytes)}
        self.spelled = [b""] * size
        for piece, i in self.ids.items():
            self.spelled[i] = piece.replace(BLANK, " ").encode()
        for b, i in self.byte_ids.items():
            self.spelled[i] = bytes([b])
        if any(BLANK in piece.lstrip(BLANK) for piece in self.ids):
            raise ValueError("the model has pieces across words, so words cannot be encoded one by one")
        self.spelled_flat = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.spelled_size = np.array([len(x) for x in self.spelled], np.int64)
        self.spelled_start = np.cumsum(self.spelled_size) - self.spelled_size
        self.neighbours = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.symbol = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.emitted: list[list[int]] = [[i] for i in range(size)]
        self._symbols(np.unique(np.array([ord(c) for piece in self.ids for c in piece], np.int64)))
        self._note_pairs()
        self._forget()

    def _note_pairs(self) -> None:
        """Which two symbols make which piece, and the place of its score in the agenda's order."""

        def number(part: str) -> int | None:
            return self.ids.get(part, int(self.symbol[ord(part)]) if len(part) == 1 else None)

        made = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = number(piece[:cut]), number(piece[cut:])
                if a is not None and b is not None:
                    made[a << 32 | b] = i
        self.pairs = np.array(sorted(made), np.int64)
        self.pair_piece = np.array([made[p] for p in self.pairs.tolist()], np.int32)
        place = np.unique(-np.array(self.scores), return_inverse=True)[1].astype(np.int32)
        self.pair_cost = place[self.pair_piece]

    def _forget(self) -> None:
        self.known: dict[str, tuple[bytes, int]] = {_LITERAL: (_packed([self.byte_ids[b] for b in BLANK.encode()]), 0)}

    def _symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of characters; one without a piece gets a number when it is met, and gives the ids of its bytes."""
        found = self.symbol[codes]
        if (found < 0).any():
            for code in np.unique(codes[found < 0]).tolist():
                self.symbol[code] = len(self.emitted)
                self.emitted.append([self.byte_ids[b] for b in chr(code).encode()])
            found = self.symbol[codes]
        if len(self.emitted) != len(getattr(self, "emitted_size", ())):
            self.emitted_flat = np.array([i for ids in self.emitted for i in ids], np.int32)
            self.emitted_size = np.array([len(ids) for ids in self.emitted], np.int64)
            self.emitted_start = np.cumsum(self.emitted_size) - self.emitted_size
        return found

    def units(self, text: str) -> list[str]:
        """Words; a long one is cut wherever no piece holds both neighbours, since no merge reaches across."""
        words = _words(text)
        if max(map(len, words)) <= LONG_WORD:
            return words
        out: list[str] = []
        for word in words:
            start = 0
            if len(word) > LONG_WORD:
                for i in range(1, len(word)):
                    if word[i - 1 : i + 1] not in self.neighbours:
                        out.append(word[start:i])
                        start = i
            out.append(word[start:] if start else word)
        return out

    def encode(self, text: str, dropout: float = 0.0, seed: int = 0, key: int = 0) -> list[int]:
        return self.encode_all([text], [key], dropout, seed)[0].tolist()

    def encode_all(self, texts: pa.Array | list[str | None], keys: list[int], dropout: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number in each."""
        column = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        uneven = pc.match_substring_regex(column, _UNEVEN).to_numpy(zero_copy_only=False)
        rows = np.array([_mix(seed & _MASK) ^ _mix(k + 1 & _MASK) for k in keys], np.uint64)
        limit = int(dropout * 2**64)
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(column)
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi in slices(np.concatenate([[0], np.cumsum(sizes)]), RUN_CHARS):
            for which in (lo + np.flatnonzero(~uneven[lo:hi]), lo + np.flatnonzero(uneven[lo:hi])):
                if len(which):
                    some = column.take(pa.array(which))
                    units, own = self._uneven_units(some) if uneven[which[0]] else _even_units(some)
                    ids, cuts = self._encode_units(units, own, rows[which], limit)
                    for row, a, b in zip(which.tolist(), cuts[:-1], cuts[1:], strict=True):
                        found[row] = ids[a:b]
        return np.concatenate([np.zeros(0, np.int32), *found]), np.array([len(f) for f in found], np.int64)

    def _uneven_units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        lists = [self.units(t) if t else [] for t in texts.to_pylist()]
        return pa.array([u for units in lists for u in units], pa.string()), np.array([len(x) for x in lists], np.int64)

    def _encode_units(self, units: pa.Array, own: np.ndarray, rows: np.ndarray, limit: int) -> tuple[np.ndarray, list[int]]:
        """Ids of texts with ``own`` units each, and where each text's begin and end."""
        before = np.cumsum(own) - own
        salts = mixed(np.repeat(rows, own) + (np.arange(len(units)) - np.repeat(before, own)).astype(np.uint64))
        runs = [self._drawn_ids(units[at : at + RUN_UNITS], salts[at : at + RUN_UNITS], limit) for at in range(0, len(units), RUN_UNITS)]
        if not runs:
            return np.zeros(0, np.int32), [0] * (len(own) + 1)
        ends = np.concatenate([[0], np.cumsum(np.concatenate([counts for _, counts in runs]))])
        return np.concatenate([ids for ids, _ in runs]), ends[np.concatenate([[0], np.cumsum(own)])].tolist()

    def _drawn(self, units: list[str], salts: np.ndarray, limit: int) -> list[bytes]:
        ids, counts = self._drawn_ids(pa.array(units, pa.string()), salts, limit)
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])]

    def _drawn_ids(self, units: pa.Array, salts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all occurrences and their number in each. An occurrence's n-th candidate merge is skipped if the n-th draw from
        its salt is below ``limit``."""
        encoded = units.dictionary_encode()
        words = encoded.dictionary.to_pylist()
        number = encoded.indices.to_numpy().astype(np.int64)
        lens = np.array([len(w) for w in words], np.int64)
        symbols = self._symbols(np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64))
        begin = np.cumsum(lens) - lens
        if len(self.known) > KEPT_WORDS:
            self._forget()
        fresh = np.array([i for i, w in enumerate(words) if len(w) <= LONG_WORD and w not in self.known], np.int64)
        if len(fresh):
            flat, start, count, taken = self._merged(symbols, begin, lens, fresh, None, 0)
            raw = flat.tobytes()
            for i, a, n, t in zip(fresh.tolist(), (start * 4).tolist(), (count * 4).tolist(), taken.tolist(), strict=True):
                self.known[words[i]] = raw[a : a + n], t
        plain = [self.known.get(w, (b"", 0)) for w in words]
        flats = [np.frombuffer(b"".join(p[0] for p in plain), "<i4")]
        sizes = np.array([len(p[0]) // 4 for p in plain], np.int64)
        starts, counts = (np.cumsum(sizes) - sizes)[number], sizes[number]
        if limit:
            n = np.array([p[1] for p in plain], np.int64)[number]
            which = np.repeat(np.arange(len(number)), n)
            nth = np.arange(1, len(which) + 1) - np.repeat(np.cumsum(n) - n, n)
            skipped = which[mixed(salts[which] + nth.astype(np.uint64) * np.uint64(_STEP)) < np.uint64(limit)]
            hit = skipped[np.flatnonzero(np.diff(skipped, prepend=-1))]
            if len(hit):
                flat, start, count, _ = self._merged(symbols, begin, lens, number[hit], salts[hit], limit)
                starts[hit], counts[hit] = start + len(flats[0]), count
                flats.append(flat)
        at = sum(map(len, flats))
        for o in np.flatnonzero(lens[number] > LONG_WORD).tolist():
            salt = int(salts[o])
            ids, _ = self.merge(words[number[o]], lambda k, salt=salt: _mix(salt + (k + 1) * _STEP & _MASK) < limit)
            flats.append(np.frombuffer(ids, "<i4"))
            starts[o], counts[o] = at, len(flats[-1])
            at += len(flats[-1])
        return _gathered(np.concatenate(flats), starts, counts), counts

    def _merged(self, symbols, begin, lens, which, salts, limit) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of words ``which``, whose symbols begin at ``begin``: ids, where each word's begin, how many, and candidates taken."""
        out, at = [], 0
        start, count, taken = (np.zeros(len(which), np.int64) for _ in range(3))
        width_of = np.searchsorted(WIDTHS, lens[which])
        for kind, width in enumerate(WIDTHS):
            mine = np.flatnonzero(width_of == kind)
            if len(mine):
                words = which[mine]
                columns = np.arange(width + 1)
                inside = columns < lens[words][:, None]
                rows = np.where(inside, symbols[np.where(inside, begin[words][:, None] + columns, 0)], np.int32(-1))
                left, taken[mine] = self._merge_rows(rows, None if salts is None else salts[mine], limit)
                there = left >= 0
                remaining, own = left[there], there.sum(axis=1)
                sizes = self.emitted_size[remaining]
                ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(own)])]
                out.append(_gathered(self.emitted_flat, self.emitted_start[remaining], sizes))
                start[mine], count[mine] = at + ends[:-1], np.diff(ends)
                at += len(out[-1])
        return np.concatenate([np.zeros(0, np.int32), *out]), start, count, taken

    def _merge_rows(self, rows: np.ndarray, salts: np.ndarray | None, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Merges the symbols of each row, which -1 fills up (the last column is always -1): what is left, and candidates taken.

        Symbols stay in their columns, linked to the next and the previous one; a merged pair lies in its first column. The
        candidate of a column is the pair of its symbol with the next.
        """
        n, width = rows.shape
        done, taken, where = np.empty_like(rows), np.zeros(n, np.int64), np.arange(n)
        after = np.tile(np.minimum(np.arange(1, width + 1), width - 1), (n, 1))
        before = np.tile(np.arange(-1, width - 1) % width, (n, 1))
        cost, made = self._candidates(rows, np.take_along_axis(rows, after, 1))
        step = 0
        while len(where):
            best = cost.argmin(axis=1)
            going = cost[np.arange(len(where)), best] < _NEVER
            if not going.all():
                ended = where[~going]
                done[ended], taken[ended] = rows[~going], step
                where, best, rows, cost, made, after, before = (x[going] for x in (where, best, rows, cost, made, after, before))
                salts = None if salts is None else salts[going]
            line = np.arange(len(where)) * width
            step += 1
            if limit:
                skipped = mixed(salts + np.uint64(step * _STEP & _MASK)) < np.uint64(limit)
                cost.reshape(-1)[line[skipped] + best[skipped]] = _NEVER
                line, best = line[~skipped], best[~skipped]
            symbol, price, piece, following, previous = (x.reshape(-1) for x in (rows, cost, made, after, before))
            cell = line + best
            right = line + following[cell]
            symbol[cell] = piece[cell]
            symbol[right], price[right] = -1, _NEVER
            following[cell] = following[right]
            right = line + following[cell]
            previous[right] = best
            left = line + previous[cell]
            price[cell], piece[cell] = self._candidates(symbol[cell], symbol[right])
            price[left], piece[left] = self._candidates(symbol[left], symbol[cell])
        return done, taken

    def _candidates(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the agenda's order and piece of each pair; never, if there is no such piece."""
        pair = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.pair_cost[at], np.int32(_NEVER)), self.pair_piece[at]

    def merge(self, word: str, skipped: Callable[[int], bool]) -> tuple[bytes, int]:
        """One word of any length: ids as little-endian 32-bit integers, and how many candidates the agenda gave; those
        ``skipped`` are not merged."""
        if word == _LITERAL:
            return self.known[word]
        symbols: list[str | None] = list(word)
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        agenda: list[tuple[float, int, int, str]] = []
        taken = 0

        def offer(left: int, right: int) -> None:
            if 0 <= left and right < len(symbols):
                both = symbols[left] + symbols[right]
                number = self.ids.get(both)
                if number is not None:
                    heapq.heappush(agenda, (-self.scores[number], left, right, both))

        for i in range(len(word) - 1):
            offer(i, i + 1)
        while agenda:
            _, left, right, both = heapq.heappop(agenda)
            if symbols[left] is None or symbols[right] is None or after[left] != right or symbols[left] + symbols[right] != both:
                continue
            taken += 1
            if skipped(taken - 1):
                continue
            symbols[left], symbols[right] = both, None
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return self._numbers([s for s in symbols if s is not None]), taken

    def _numbers(self, symbols: list[str]) -> bytes:
        ids: list[int] = []
        for symbol in symbols:
            number = self.ids.get(symbol)
            if number is not None:
                ids.append(number)
            else:
                ids += [self.byte_ids[b] for b in symbol.encode()]
        return _packed(ids)

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([len(ids)]))[0].decode()

    def decode_all(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts, as UTF-8, of ids that lie one after the other, ``counts`` in each."""
        starts, out = np.concatenate([[0], np.cumsum(counts)]), []
        for lo, hi in slices(starts, RUN_UNITS):
            some = ids[starts[lo] : starts[hi]]
            sizes = self.spelled_size[some]
            raw = _gathered(self.spelled_flat, self.spelled_start[some], sizes).tobytes()
            ends = np.concatenate([[0], np.cumsum(sizes)])[starts[lo : hi + 1] - starts[lo]].tolist()
            out += [raw[a + 1 : b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return out


def _words(text: str) -> list[str]:
    """Words, each with the blanks before it. A blank mark that the text itself holds is a word of its own, ``_LITERAL``."""
    if BLANK in text:
        return [w for part in _marked(text) for w in part]
    return _split(BLANK + text.replace(" ", BLANK))


def _split(marked: str) -> list[str]:
    words, start = [], 0
    at = marked.find(BLANK, 1)
    while at >= 0:
        if marked[at - 1] != BLANK:
            words.append(marked[start:at])
            start = at
        at = marked.find(BLANK, at + 1)
    words.append(marked[start:])
    return words


def _marked(text: str):
    for n, part in enumerate(text.split(BLANK)):
        if n:
            yield [_LITERAL]
        part = part.replace(" ", BLANK)
        if n == 0:
            yield _split(BLANK + part)
        elif part:
            yield _split(part)


def _even_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of texts in which each lies between single blanks."""
    marked = pc.binary_join_element_wise(BLANK, pc.replace_substring(texts, " ", " " + BLANK), "")
    lists = pc.split_pattern(marked, " ")
    return lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)


@functools.lru_cache(maxsize=2)
def pieces(name: str) -> Pieces:
    return Pieces(name)


def _keyed(df: DataFrame, keys: list[str], dropped: list[str], dropout: float) -> tuple[DataFrame, DataFrame, str]:
    """``df`` without the columns that results replace, the same with a hash of the keys, and that column's name."""
    if not 0 <= dropout < 1:
        raise ValueError("dropout lies in [0, 1)")
    tasks_need_package(df)
    name = fresh_name(df, "__key")
    hashed = df.withColumn(name, F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys]))
    return df.drop(*dropped), hashed.drop(*dropped), name


def encode(
    df: DataFrame, keys: list[str], text: str = "text", dropout: float = 0.1, seed: int = 1, model: str = PIECE_BPE
) -> DataFrame:
    """Adds ``piece_ids``. ``keys`` name the columns that tell rows apart for the draws."""
    kept, rows, key = _keyed(df, keys, ["piece_ids"], dropout)
    names = kept.columns

    @thrifty
    def encoded(batches):
        table = pieces(model)
        for batch in batches:
            ids, counts = table.encode_all(batch.column(text), batch.column(key).to_pylist(), dropout, seed)
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], lists], names=[*names, "piece_ids"])

    return rows.mapInArrow(encoded, kept.select("*", F.lit(None).cast("array<int>").alias("piece_ids")).schema)


def decode(df: DataFrame, ids: str = "piece_ids", model: str = PIECE_BPE) -> DataFrame:
    """Adds ``decoded``, the text of the pieces; null pieces give empty text."""
    tasks_need_package(df)
    kept = df.drop("decoded")
    names = kept.columns

    @thrifty
    def decoded(batches):
        table = pieces(model)
        for batch in batches:
            lists = batch.column(ids)
            counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = table.decode_all(pc.list_flatten(lists).to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=[*names, "decoded"])

    return kept.mapInArrow(decoded, kept.select("*", F.lit("").alias("decoded")).schema)


def round_trip(
    df: DataFrame, keys: list[str], text: str = "text", dropout: float = 0.1, seed: int = 1, model: str = PIECE_BPE
) -> DataFrame:
    """As ``encode`` and ``decode``, in one pass and without the ids: adds ``n_pieces``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers) and ``decoded``."""
    added = ["n_pieces", "ids_crc32", "decoded"]
    kept, rows, key = _keyed(df, keys, added, dropout)
    names = kept.columns

    @thrifty
    def passed(batches):
        table = pieces(model)
        for batch in batches:
            ids, counts = table.encode_all(batch.column(text), batch.column(key).to_pylist(), dropout, seed)
            cuts = np.concatenate([[0], np.cumsum(counts)]).tolist()
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            texts = pa.array(table.decode_all(ids, counts), pa.binary()).cast(pa.string())
            columns = [*[batch.column(c) for c in names], pa.array(counts), pa.array(sums, pa.int64()), texts]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    zero = F.lit(0).cast("long")
    return rows.mapInArrow(passed, kept.select("*", zero.alias("n_pieces"), zero.alias("ids_crc32"), F.lit("").alias("decoded")).schema)
