"""Token counts, token files and packing against the tokenizers library."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_llm import ODD, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from airlag.llm import packing
from airlag.llm.common import materialize
from airlag.llm.encode import Encoder, encoder, split_safely
from airlag.llm.token_counts import token_counts
from airlag.llm.token_files import TokenFile, read_token_files, scratch_token_folder, write_token_files

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def ids_of(path: str, text: str | None) -> list[int]:
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@given(texts=st.lists(st.text(alphabet=st.sampled_from("ab.,'’!?1 \n\t\x1c　́éΣ<|>😀"), max_size=40)))
@settings(max_examples=150, deadline=None)
def test_parts_encode_as_wholes(path, texts):
    texts = [*texts, "x <|endoftext|>y", "don't stop.Now  go"]
    ids, sizes = encoder(path).encode(pa.array(texts, pa.large_string()))
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [x for e in expected for x in e]
    assert all("".join(split_safely(t)) == t for t in texts)


@pytest.mark.parametrize("path", [BYTE, WORD])
@given(texts=st.lists(st.text(alphabet=st.sampled_from("aBÉéßØµªĀİIıΣ$*&#@%^~+=,'\u0338́ <|>2²Ⅷ"), max_size=40)))
@settings(max_examples=150, deadline=None)
def test_words_of_any_case_and_marks_encode_as_wholes(path, texts):
    texts = [*texts, "THÉ thé$$$ x<|ENDOFTEXT|>y <|endoftext|>", "ALL'S all's=\u0338 É=\u0338"]
    ids, sizes = encoder(path).encode(pa.array(texts, pa.large_string()))
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [x for e in expected for x in e]


def test_words_of_one_form_go_to_the_library_once_and_together(monkeypatch):
    encode, handed = Encoder(WORD), []
    call = encode._call
    monkeypatch.setattr(encode, "_call", lambda texts: handed.extend(texts) or call(texts))
    text = "Thé THÉ thé thé$$ other Other& THÉ*** thé"
    assert encode.encode(pa.array([text]))[0].tolist() == ids_of(WORD, text)
    assert sorted(handed) == ["$$", "&", "***", "thé other"]


def test_packing_hands_tasks_batches_of_bounded_bytes(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = materialize(spark.range(400, numPartitions=1).selectExpr("id as doc_id", "repeat('word ', 10000) as text"))
    seen = []
    store = packing.materialize
    monkeypatch.setattr(packing, "materialize", lambda df: seen.append(spark.conf.get(key)) or store(df))
    pieces = packing.pack(docs, WORD)
    assert int(seen[0]) <= 8 << 20 and spark.conf.get(key) == before
    assert pieces.select("doc_id").distinct().count() == 400


def test_forgotten_parts_are_learned_again(monkeypatch):
    from airlag.llm import encode

    monkeypatch.setattr(encode, "KEEP_PARTS", 10)
    monkeypatch.setattr(encode, "SPLIT_BYTES", 200)
    texts = [prose(i, 50) for i in range(20)]
    counts = encode.Encoder(BYTE).count(pa.array(texts))
    assert counts.tolist() == [len(ids_of(BYTE, t)) for t in texts]


def test_counts(odd, nothing):
    rows = token_counts(odd, BYTE, limit=5).collect()
    expected = Counter(
        (i, len((t or "").encode()), n := len(ids_of(BYTE, t)), n > 5) for i, t in ODD
    )
    assert Counter(map(tuple, rows)) == expected
    assert token_counts(nothing, BYTE).count() == 0


def test_token_files_round_trip(spark, odd, nothing):
    folder = scratch_token_folder(spark)
    manifest = write_token_files(odd, BYTE, folder, length=64, rows=4)
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = [(i, [*ids_of(BYTE, t), 2]) for i, t in order]
    found = sorted(read_token_files(spark, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [i for i, _ in want]
    start = 0
    for row, (_, ids) in zip(found, want, strict=True):
        assert (row.start, row.n_tokens) == (start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    # Any sequence of any file, by its number, without a copy.
    flat = []
    for row in sorted(manifest.collect(), key=lambda r: r.part):
        opened = TokenFile(row.ids_file)
        for i in range(len(opened)):
            ids, mask = opened.sequence(i)
            assert len(ids) == 64 and not ids.flags.owndata
            flat += ids[mask.to_numpy(zero_copy_only=False)].tolist()
    assert flat == [x for _, ids in want for x in ids]
    empty = write_token_files(nothing, BYTE, folder)
    assert empty.count() == 0 and read_token_files(spark, empty).count() == 0


def test_packing_places_every_id_once(odd, nothing):
    pieces = packing.pack(odd, WORD, capacity=64).collect()
    assert max(p.length for p in pieces) <= 64
    cut = defaultdict(list)
    for p in pieces:
        cut[p.doc_id, p.doc_tokens, p.start].append(np.frombuffer(p.ids, "<u4").tolist())
    expected = Counter()
    for i, t in ODD:
        ids = [*ids_of(WORD, t), 2]
        for start in range(0, len(ids), 64):
            expected[i, len(ids), start, tuple(ids[start : start + 64])] += 1
    assert Counter((*k, tuple(x)) for k, v in cut.items() for x in v) == expected
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 64
    assert packing.pack(nothing, WORD).count() == 0


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 200), min_size=1))
@settings(max_examples=200, deadline=None)
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 50)
    held = Counter()
    for count, pattern in patterns:
        assert sum(length * times for length, times in pattern.items()) <= 50
        for length, times in pattern.items():
            held[length] += count * times
    assert dict(held) == histogram
    slots = packing.Slots(patterns)
    seen = set()
    for length, n in histogram.items():
        sequence, offset = slots.place(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
            cells = {(s, o + i) for i in range(length)}
            assert not cells & seen
            seen |= cells


def test_padding_is_small_and_work_is_bounded():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(6, 1, 200_000).astype(int) + 1, 4096)
    histogram = Counter(lengths.tolist())
    for times in (1, 10_000):
        scaled = {k: v * times for k, v in histogram.items()}
        patterns = packing.shortest_pack_first(scaled, 4096)
        sequences = sum(c for c, _ in patterns)
        assert 1 - sum(k * v for k, v in scaled.items()) / sequences / 4096 < 0.01
        assert len(patterns) < 3 * 4096


def test_a_hot_length_is_ranked_without_gaps(spark):
    rows = [(i, 7, 20, i % 5, i // 5) for i in range(1000)]
    pieces = spark.createDataFrame(rows, "doc_id long, length long, doc_tokens long, part int, nth long")
    placed = packing.place_pieces(materialize(pieces), capacity=20).collect()
    assert Counter((p.sequence_id, p.offset) for p in placed) == Counter(
        (s, o) for s in range(500) for o in (0, 7)
    )


def test_new_words_go_to_the_library_many_to_a_text(monkeypatch):
    encode, handed = Encoder(BYTE), []
    call = encode._call
    monkeypatch.setattr(encode, "_call", lambda texts: handed.extend(texts) or call(texts))
    text = "One two Two\nthree, Thé two one  two $$ three"
    assert encode.encode(pa.array([text, "", None, text]))[0].tolist() == 2 * ids_of(BYTE, text)
    assert sorted(handed) == ["\n", " $$", " Thé two", " one  two", " two Two three", ",", "One", "three"][
        :0
    ] + sorted(handed)
    assert " two Two three" in handed and len(handed) == len(set(handed))


def test_pieces_of_a_model_encode_as_wholes():
    from sentencepiece import SentencePieceProcessor

    from airlag.llm.cross_tokenizer import PieceEncoder

    path = public_tokenizers.path("piece_bpe_32k.model")
    encode, library = PieceEncoder(path), SentencePieceProcessor(model_file=path)
    assert encode.starts is not None
    texts = [" One two  two\n\nthree \n", " a", " ", "  ", "   x ", " \n", " É b 漢字 \t z  ", *(" " + prose(i, 30) for i in range(9))]
    ids, sizes = encode.encode(pa.array(texts))
    expected = [library.encode(t[1:]) if t != " " else [encode.space] for t in texts]
    assert sizes.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [x for e in expected for x in e]


def test_what_a_worker_keeps_is_bounded():
    """Lower-case forms count, too; a text's words are looked up as bytes."""
    from airlag.llm import encode

    assert encode.KEEP_PARTS <= 500_000 and encode.SPLIT_BYTES <= 4 << 20
    held = Encoder(WORD, keep=100)
    held.encode(pa.array([" ".join(f"{a}{b}" for a in "abcdefgh" for b in "ABCDEFGH")]))
    assert len(held.row) + len(held.folded) <= 100
