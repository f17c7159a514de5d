"""Token ids, token files, packing and pieces against the libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import merge_dropout, packing, token_files
from strata.llm.tokens import BYTE_BPE, WordEncoder

PARTS = [*" \n\t\r\x0b\x1c\x85\xa0᠎ 　'aé1.!-中", "\U0001f600", "​", "'s", "<|endoftext|>", "  ", "\n\n", "the", " The"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_the_text(library, awkward):
    draw = random.Random(5)
    texts = [t or "" for _, t in awkward] + ["".join(draw.choices(PARTS, k=draw.randint(0, 25))) for _ in range(5000)]
    encoder = WordEncoder(kept_words=300)  # forgets its words now and then
    for at in range(0, len(texts), 100):
        for text, raw in zip(texts[at : at + 100], encoder.encode(texts[at : at + 100]), strict=True):
            assert list(memoryview(raw).cast("I")) == ids_of(library, text), text


def test_marks_behind_letters_and_added_tokens(library):
    draw = random.Random(6)
    parts = [*"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'", "a", "é", "×", "÷", "ß", "中", "'s", "'ll", " I", "7", "\n", "<|endoftext|>", "<|endof", "text|>", "€", "Ã©"]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 30))) for _ in range(20_000)]
    encoder = WordEncoder(kept_words=2000)
    for at in range(0, len(texts), 500):
        for text, raw in zip(texts[at : at + 500], encoder.encode(texts[at : at + 500]), strict=True):
            assert list(memoryview(raw).cast("I")) == ids_of(library, text), text


def test_the_library_sees_a_word_once(library):
    encoder, asked = WordEncoder(kept_words=60), []
    encode_parts = encoder._encode_parts
    encoder._encode_parts = lambda parts: asked.extend(parts) or encode_parts(parts)
    for n in range(20):  # words of one batch come and go, the common one stays known
        fresh = " ".join(f"word{n}x{i}" for i in range(25))
        text = f"Here common, common. common; (common) {fresh}"
        assert list(memoryview(encoder.encode([text])[0]).cast("I")) == ids_of(library, text)
    assert sum(b"common" in (p if isinstance(p, bytes) else p.encode()) for p in asked) == 2  # after a blank, and after a bracket
    assert len(encoder.number_of) < 120


@pytest.mark.parametrize("n", [1, 7, 511, 512, 513, 5000])
def test_codes_round_trip_and_direct_access(n):
    ids = np.random.default_rng(n).integers(0, [300, 50_000, 2**32][n % 3], n).astype("<u4")
    codes = token_files.Codes(token_files.pack_ids(ids))
    assert len(codes) == n and codes.all().tolist() == ids.tolist()
    for place in {0, n - 1, n // 2, min(n - 1, 512), min(n - 1, 511)}:
        assert codes[place] == ids[place]


def test_token_files_hold_all_documents_in_order(spark, documents, awkward, library, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(documents(awkward), path)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, _ in awkward), key=lambda i: (i is not None, i))
    wanted = {}
    for i, t in awkward:
        ids = [*ids_of(library, t), 2]
        wanted.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    start = 0
    for r in rows:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in wanted[r.doc_id]
        wanted[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    empty = str(tmp_path / "empty")
    token_files.write_tokens(documents([]), empty)
    assert token_files.read_tokens(spark, empty).count() == 0


def checked(windows, sizes):
    taken = [[] for _ in sizes]
    for capacity, pieces in windows:
        used = sum(p[2] for p in pieces)
        assert 0 < used <= capacity
        for doc, start, length in pieces:
            assert length > 0
            taken[doc].append((start, length))
    for size, pieces in zip(sizes, taken, strict=True):
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == size


@pytest.mark.parametrize("seed", range(30))
def test_packing_places_every_id_once_with_one_padded_window(seed):
    draw = random.Random(seed)
    sizes = [draw.choice([1, draw.randint(1, 50), draw.randint(1, 3000), 2048, 9000]) for _ in range(draw.randint(1, 300))]
    windows = packing.pack(sizes)
    checked(windows, sizes)
    assert sum(sum(p[2] for p in pieces) < capacity for capacity, pieces in windows) <= 1


def test_groups_are_balanced():
    used = [2048] * 500 + [1024] * 300 + [256] * 700
    groups = packing.step_groups(used)
    sums = np.bincount(groups, weights=used)
    assert len(sums) == round(sum(used) / packing.STEP_IDS) and sums.max() - sums.min() <= 2048


def test_packed_pieces_hold_the_ids(documents, awkward, library):
    rows = packing.packed_pieces(documents(awkward)).collect()
    ids = {}
    for i, t in awkward:
        ids.setdefault(i, []).append([*ids_of(library, t), 1])
    for r in rows:
        spans = [d[r.start : r.start + r.length] for d in ids[r.doc_id] if len(d) == r.doc_tokens]
        assert r.ids_crc32 in [zlib.crc32(np.array(s, "<u4").tobytes()) for s in spans]
    assert sum(r.length for r in rows) == sum(len(d) for ds in ids.values() for d in ds)
    by_sequence = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert r.offset == by_sequence.get(r.sequence_id, 0)
        by_sequence[r.sequence_id] = r.offset + r.length
    assert max(by_sequence.values()) <= 2048
    assert packing.packed_pieces(documents([])).count() == 0


def test_pieces_without_dropout_are_the_librarys_and_all_decode(awkward):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(merge_dropout.PIECE_BPE))
    table = merge_dropout.Pieces(merge_dropout.PIECE_BPE)
    draw = random.Random(3)
    texts = [t or "" for _, t in awkward] + ["".join(draw.choices([*PARTS, "▁"], k=draw.randint(0, 15))) for _ in range(3000)]
    for n, text in enumerate(texts):
        if "▁" not in text:
            assert table.encode(text) == library.encode(text)
        for dropout in (0.0, 0.1, 0.6):
            assert table.decode(table.encode(text, dropout, 4, n)) == text


def test_dropout_varies_with_the_seed_and_repeats_with_it(spark, awkward):
    rows = spark.createDataFrame([(i, t, 1) for i, t in awkward], "doc_id long, text string, piece_ids int")
    one, again, other = (
        {(r.doc_id, r.text): r for r in merge_dropout.decode(merge_dropout.encode(rows, ["doc_id"], seed=s)).collect()} for s in (1, 1, 2)
    )
    assert {k: r.piece_ids for k, r in one.items()} == {k: r.piece_ids for k, r in again.items()}
    assert {k: r.piece_ids for k, r in one.items()} != {k: r.piece_ids for k, r in other.items()}
    assert all(r.decoded == (r.text or "") for r in [*one.values(), *other.values()])
    table = merge_dropout.Pieces(merge_dropout.PIECE_BPE)
    text = "the quick brown fox jumps over the lazy dog " * 50
    assert len(table.encode(text, 0.3, 1, 1)) > len(table.encode(text, 0.05, 1, 1)) > len(table.encode(text))
    assert merge_dropout.encode(rows.limit(0), ["doc_id"]).count() == 0


def drawn_one_by_one(table, text, dropout, seed, key):
    """Each occurrence merged on its own, every candidate drawn when the agenda gives it."""
    mix, mask, step = merge_dropout._mix, 2**64 - 1, 0x9E3779B97F4A7C15
    ids = b""
    for place, unit in enumerate(table.units(text)):
        salt = mix((mix(seed) ^ mix(key + 1)) + place & mask)
        ids += table.merge(unit, lambda n, salt=salt: mix(salt + (n + 1) * step & mask) < int(dropout * 2**64))[0]
    return np.frombuffer(ids, "<i4").tolist()


def test_every_occurrence_is_drawn_anew(awkward, monkeypatch):
    monkeypatch.setattr(merge_dropout, "RUN_CHARS", 100)
    monkeypatch.setattr(merge_dropout, "RUN_UNITS", 7)
    table = merge_dropout.Pieces(merge_dropout.PIECE_BPE)
    texts = [t for _, t in awkward if t and len(t) < 10_000] + ["international " * 200, "中文字" * 200, "line\n" * 100]
    for dropout in (0.1, 0.6):
        for text in texts:
            assert table.encode(text, dropout, 3, 5) == drawn_one_by_one(table, text, dropout, 3, 5)
    plain = table.encode("international")
    ways = {tuple(table.encode("international", 0.3, 1, key)) for key in range(2000)}
    assert len(ways) > 16 and tuple(plain) in ways


def test_short_and_long_words_merge_alike(monkeypatch):
    table = merge_dropout.Pieces(merge_dropout.PIECE_BPE)
    draw = random.Random(8)
    for _ in range(500):
        word = "▁" + "".join(draw.choices("aeinorst", k=draw.randint(0, 30)))
        skips = {n for n in range(60) if draw.random() < 0.2}
        short = table.merge(word, skips.__contains__)
        monkeypatch.setattr(merge_dropout, "LONG_WORD", 0)
        assert table.merge(word, skips.__contains__) == short
        monkeypatch.undo()


def test_a_word_of_one_merge_is_varied_at_the_rate_of_dropout():
    table = merge_dropout.Pieces(merge_dropout.PIECE_BPE)
    words = [a + b for a in "abcdefgh" for b in "aeiou" if table.merge(a + b, ().__contains__)[1] == 1]
    assert len(words) > 10
    for word in words[:10]:
        ids = table._drawn([word] * 5000, np.arange(5000, dtype=np.uint64) * np.uint64(2**40 + 7), int(0.1 * 2**64))
        assert 350 < sum(len(i) > 4 for i in ids) < 650


def test_dropout_query_reads_documents(spark, documents, awkward, tmp_path):
    from strata.llm.queries import llm

    documents(awkward).write.parquet(str(tmp_path / "documents.parquet"))
    rows = llm.queries["op9_merge_dropout"](spark, str(tmp_path)).collect()
    assert sorted(repr(r.doc_id) for r in rows) == sorted(repr(i) for i, _ in awkward) and all(r.lossless for r in rows)
