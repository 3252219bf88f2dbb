"""Long texts in windows, and one id that very many documents share."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_llm import ODD, prose
from tokenizers import Tokenizer

from airlag.llm import fingerprints, langid, near_dedup, quality
from airlag.llm.fingerprints import HEAD, edit_likeness, with_follower
from airlag.llm.token_files import read_token_files, scratch_token_folder, write_token_files

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def made(seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("ab é\n\t\x01日x ") for _ in range(rng.choice([0, 1, 3, 40, 200]))) for _ in range(5)]


def column(texts) -> pa.Array:
    return pa.array([t or "" for t in texts], pa.large_string())


@pytest.mark.parametrize("seed", range(20))
def test_hashes_do_not_depend_on_blocks(monkeypatch, seed):
    texts = column([*made(seed), *[t for _, t in ODD if not t or len(t) < 100]])
    words, shingles, marks = (f(texts) for f in (fingerprints.word_hashes, fingerprints.shingle_hashes, fingerprints.sketch))
    kmers = near_dedup.labelled_kmers(texts)
    for size in (1, 3, 50):
        monkeypatch.setattr(fingerprints, "BLOCK_BYTES", size)
        monkeypatch.setattr(fingerprints, "BLOCK_SHINGLES", size)
        for want, got in ((words, fingerprints.word_hashes(texts)), (shingles, fingerprints.shingle_hashes(texts)),
                          (kmers, near_dedup.labelled_kmers(texts))):
            assert all(np.array_equal(x, y) for x, y in zip(want, got, strict=True))
        assert np.array_equal(marks, fingerprints.sketch(texts))


@pytest.mark.parametrize("seed", range(20))
def test_windows_give_the_grams_and_lines_of_the_whole(monkeypatch, seed):
    for text in [*made(seed), prose(seed, 40), "", "\n"]:
        grams, _ = langid.grams(column([text]))
        lines = quality.line_features(column([text]))
        for size in (1, 2, 7, 50):
            monkeypatch.setattr(langid, "CHUNK_BYTES", size)
            monkeypatch.setattr(quality, "CHUNK_BYTES", size)
            assert np.array_equal(grams, np.concatenate(list(langid.windows(text))))
            found = quality.features_of(column([text]))
            assert np.allclose(lines.features, found.features)
            assert np.array_equal(lines.lengths, found.lengths) and lines.counts.tolist() == found.counts.tolist()


def test_long_texts_get_the_language_of_the_whole(monkeypatch):
    rng = np.random.default_rng(1)
    model = langid.Model(list("abc"), np.zeros(3), rng.normal(size=(langid.BUCKETS + 1, 3)).astype(np.float32) / 100)
    texts = column([prose(1, 400), "", prose(2, 300)])
    whole = model.score(texts)
    monkeypatch.setattr(langid, "CHUNK_BYTES", 64)
    for want, got in zip(whole, model.score(texts), strict=True):
        assert np.allclose(want, got, atol=1e-4)


def shared_id(rows: int) -> list[tuple[int, str]]:
    """Ids of one document each, and one that a third of the rows share; some of
    these begin alike or are equal."""
    hot = [(500, f"{'same head of all ' if n % 2 else n} {prose(n % 70, 12)}") for n in range(rows // 3)]
    return [(n, prose(n, 12)) for n in range(rows - len(hot))] + hot


def in_order(rows):
    """Ids ascend; rows of one id come by the head of the text, then in any order
    that depends on the text alone."""
    return sorted(rows, key=lambda r: (r[0], r[1][:HEAD]))


def test_an_id_that_many_share_is_cut(spark):
    rows = shared_id(900)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ranged = with_follower(docs)
    own = ranged.where("not follower")
    assert Counter((r.doc_id, r.text) for r in own.collect()) == Counter(rows)
    assert own.where("doc_id = 500").select("range_no").distinct().count() > 1
    sizes = [r["count"] for r in own.groupBy("range_no").count().collect()]
    assert max(sizes) < 0.3 * len(rows)
    closing = ranged.where("follower")
    assert closing.count() == len(sizes)
    # Every document meets one next document, and is the next of one.
    found = edit_likeness(docs).collect()
    assert Counter((r.doc_id, r.n_chars) for r in found) == Counter((i, len(t)) for i, t in rows)
    edited = Counter(r.edited_sha256 for r in found)
    for (i, text), (j, after) in itertools.pairwise(in_order(rows)):
        if i != j and 500 not in (i, j):
            half = len(text) // 2
            assert edited[hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()] == 1


def test_token_files_of_an_id_that_many_share(spark):
    rows = shared_id(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    manifest = write_token_files(docs, BYTE, scratch_token_folder(spark), length=64, rows=4)
    assert max(r.n_docs for r in manifest.collect()) < 0.3 * len(rows)
    found = sorted(read_token_files(spark, manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted(i for i, _ in rows)
    library = Tokenizer.from_file(BYTE)
    want = Counter()
    for i, text in rows:
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        want[i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == want
    ends = [0, *np.cumsum([r.n_tokens for r in found]).tolist()]
    assert [r.start for r in found] == ends[:-1]
