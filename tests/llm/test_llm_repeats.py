"""Substring dedup, spelling variants and token alignment against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest_llm import ODD, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from airlag.llm import cross_tokenizer, queries, run_index, spelling
from airlag.llm.cross_tokenizer import align, byte_side, cross_alignment, pack_pairs, piece_side, unpack_pairs
from airlag.llm.encode import Encoder, cuts_are_safe
from airlag.llm.run_index import RunIndex, dedup_substrings, long_matches, regions
from airlag.llm.spelling import spelling_variants

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def with_ids(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# --- 11: substrings that occur twice ----------------------------------------


def covered(texts: list[bytes], length: int) -> list[tuple[bytes, list[tuple[int, int]]]]:
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    found = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i + 1 : i + length + 1] = True
        edge = np.flatnonzero(np.diff(gone.astype(int)))
        kept = bytes(b for b, g in zip(t, gone[1:], strict=False) if not g)
        found.append((kept, list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))))
    return found


def removed_as_expected(spark, rows, length=200):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(
        (r.doc_id, r.n_bytes, bytes(r.kept), tuple((s.start, s.stop) for s in r.spans))
        for r in dedup_substrings(docs, length).collect()
    )
    texts = [(t or "").encode() for _, t in rows]
    expected = Counter(
        (i, len(t), kept, tuple(spans))
        for (i, _), t, (kept, spans) in zip(rows, texts, covered(texts, length), strict=True)
    )
    assert got == expected


@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_index_streams_matching_statistics(strings):
    data = np.frombuffer(b"".join(strings), np.uint8)
    index = RunIndex(data, np.array([len(s) for s in strings]))
    got = index.statistics()
    for k, s in enumerate(strings):
        for i in range(len(s)):
            best = 0
            for other, t in enumerate(strings):
                for j in range(len(t)):
                    if (other, j) != (k, i):
                        n = 0
                        while i + n < len(s) and j + n < len(t) and s[i + n] == t[j + n]:
                            n += 1
                        best = max(best, n)
            assert got[index.begins[k] + i] == best


def test_repetitive_strings_have_few_runs():
    copies = b"".join([prose(1, 300).encode()] * 50)
    size = len(copies) // 50
    index = RunIndex(np.frombuffer(copies, np.uint8), np.full(50, size))
    assert len(index.heads) < size + 100
    string, start, stop = long_matches(np.frombuffer(copies, np.uint8), np.full(50, size), 200)
    assert string.tolist() == list(range(50)) and set(start) == {0} and set(stop) == {size}


def test_equal_windows_have_one_key():
    rng = random.Random(5)
    shared = bytes(rng.randrange(256) for _ in range(700))
    texts = [bytes(rng.randrange(256) for _ in range(rng.randrange(900))) + shared + b"!" * n for n in range(5)]
    bounds = np.cumsum([0, *map(len, texts)])
    text, first, windows, keys, _ = regions(np.frombuffer(b"".join(texts), np.uint8), bounds)
    key_of = {}
    for t, a, n, k in zip(text.tolist(), first.tolist(), windows.tolist(), keys.tolist(), strict=True):
        for i in range(a, a + n):
            assert len(texts[t][i : i + 200]) == 200
            assert key_of.setdefault(texts[t][i : i + 200], k) == k
    assert windows.sum() == sum(max(0, len(t) - 199) for t in texts)


def messy_rows():
    rng = random.Random(3)
    passage, period = prose(21, 60), "abcdefghij klmno" * 40
    rows = list(ODD)
    rows += [(100 + i, prose(100 + i, 80) + passage + prose(300 + i, 40)) for i in range(6)]
    near = prose(50, 200).split(" ")
    for i in range(8):
        words = list(near)
        words[rng.randrange(len(words))] = f"changed{i}"
        rows.append((200 + i, " ".join(words)))
    rows += [(300, period), (301, "ñ" * 150), (302, "ñ" * 90 + "x"), (303, prose(9, 30)[:199]), (304, prose(9, 30)[:199])]
    rows += [(None, prose(60, 90)), (None, prose(60, 90)), (400, prose(60, 90) + "!")]
    return rows


def test_substrings(spark):
    removed_as_expected(spark, messy_rows())


def test_substrings_of_frequent_keys(spark, monkeypatch):
    monkeypatch.setattr(run_index, "HOT_BYTES", 600)
    removed_as_expected(spark, messy_rows())


def test_long_texts_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(run_index, "CHUNK_BYTES", 1500)
    monkeypatch.setattr(run_index, "REGION", 100)
    long = prose(70, 1500)
    removed_as_expected(spark, [*messy_rows(), (500, long), (501, prose(71, 900) + long[4000:6500])])


def test_substrings_of_nothing(spark, nothing):
    assert dedup_substrings(nothing).count() == 0
    assert [bytes(r.kept) for r in dedup_substrings(with_ids(spark, ["a", None])).collect()] == [b"a", b""]


# --- 12: spelling variants ---------------------------------------------------


def words_of(rows):
    counts = Counter()
    for i, t in rows:
        run = ""
        for c in (t or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                at = h % len(run)
                counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
                run = ""
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows):
    words = words_of(rows)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    found = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        found.add((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return found


def spelled_rows():
    rng = random.Random(11)
    rows = list(ODD)
    base = ["colour", "harbour", "étagère", "ÀÉcole", "signature", "a" * 40, "abcde", "neighbourhood"]
    letters = "abcdeghilnorstuÿ÷"
    for i in range(120):
        text = []
        for word in base:
            text += [word] * rng.randrange(4)
            for _ in range(3):
                at, c = rng.randrange(len(word)), rng.choice(letters[:6])
                text.append(rng.choice([word[:at] + word[at + 1 :], word[:at] + c + word[at:], word[:at] + c + word[at + 1 :]]))
        rows.append((1000 + i, ", ".join(text)))
    rows += [(2000 + n, "x" * 3000 + "y" * (n % 2)) for n in range(8)]
    return rows


@pytest.mark.parametrize("tile", [None, 16])
def test_variants(spark, monkeypatch, tile):
    if tile:
        monkeypatch.setattr(spelling, "TILE", tile)
        monkeypatch.setattr(spelling, "GROUP_ROWS", 64)
    rows = spelled_rows()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, word string")
    got = {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling_variants(docs).collect()}
    expected = variants(rows)
    assert got == expected and sum(x[3] is not None for x in expected) > 50


def test_no_words(spark, nothing):
    assert spelling_variants(nothing).count() == 0
    assert spelling_variants(with_ids(spark, [None, "", "one two"])).count() == 0


@given(st.lists(st.text("abcé", min_size=1, max_size=7), min_size=2, max_size=30, unique=True))
@settings(max_examples=100, deadline=None)
def test_distances_lose_no_pair(words):
    points, sizes = spelling.code_points(pa.array(words))
    counts = spelling.letter_counts(points, sizes)
    p, q = spelling.near_in_counts(counts, counts, 2)
    kept = set(zip(p.tolist(), q.tolist(), strict=True))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if one_edit(a, b):
                assert (i, j) in kept


def test_chains_end_at_their_root(spark):
    forms = [(f"w{i:03}", f"w{i + 1:03}" if i < 200 else None) for i in range(201)] + [("alone", None)]
    table = spelling.materialize(spark.createDataFrame(forms, "word string, form string"))
    assert {r.word: r.root for r in spelling.roots(table).collect()} == {
        **{f"w{i:03}": "w200" for i in range(201)}, "alone": "alone",
    }


def test_twin_of_variants(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = queries.op12_spelling(spark, sf_dir)
    expected = con.execute(queries.OP12_SQL)
    order = [d[0] for d in expected.description]
    assert Counter(map(tuple, df.select(*order).collect())) == Counter(expected.fetchall())


# --- 13: tokens of two tokenizers --------------------------------------------


def groups_and_links(a: list[int], b: list[int]):
    both, sizes, size = set(a) & set(b), [], Counter()
    for end, side in sorted([(e, "a") for e in a] + [(e, "b") for e in b]):
        size[side] += 1
        if end in both and side == "b":
            sizes.append((size["a"], size["b"]))
            size.clear()
    links, i, j = set(), 0, 0
    while i < len(a):
        links.add((i, j))
        i, j = i + (a[i] <= b[j]), j + (b[j] <= a[i])
    return sizes, links


@given(
    st.sets(st.integers(1, 120), max_size=90), st.sets(st.integers(1, 120), max_size=90),
    st.sets(st.integers(1, 400), max_size=200),
)
@settings(max_examples=300, deadline=None)
def test_align(a, b, same):
    ends = [np.array(sorted({*x, *(120 + s for s in same), 600}), np.int32) for x in (a, b)]
    size_a, size_b = align(*ends)
    link_a, link_b = cross_tokenizer.links(*ends)
    sizes, links = groups_and_links(*(e.tolist() for e in ends))
    assert list(zip(size_a.tolist(), size_b.tolist(), strict=True)) == sizes
    assert len(link_a) == len(links) and set(zip(link_a.tolist(), link_b.tolist(), strict=True)) == links


def test_pairs_pack():
    pairs, n = np.array([3, 9, 1 << 45], np.int64), np.array([1, 70_000, 2])
    again = unpack_pairs(pack_pairs(pairs, n))
    assert [x.tolist() for x in again] == [pairs.tolist(), n.tolist()]


@given(st.lists(st.text(alphabet=st.sampled_from("ab.,'!?1 \n\t ́é<|>😀"), min_size=1, max_size=40)))
@settings(max_examples=150, deadline=None)
def test_pieces_of_parts_are_pieces_of_wholes(texts):
    texts = [*texts, "a  b ", " lead", "\nx\n\n y", "<s> </s>", "x \n y\x00z"]
    side = piece_side(PIECE)
    ids, sizes = side.encoder.encode(pa.array([" " + t for t in texts], pa.large_string()))
    expected = side.encoder.library.encode(texts)
    assert sizes.tolist() == [len(x) for x in expected] and ids.tolist() == [i for x in expected for i in x]


def aligned_by_hand(rows):
    a, b = byte_side(BYTE), piece_side(PIECE)
    found, counts = [], Counter()
    for i, t in rows:
        x = a.encoder.library.encode(" " + (t or ""), add_special_tokens=False).ids
        y = b.encoder.library.encode(t or "")
        whole = (" " + (t or "")).encode()
        if not t or any(b"".join(s.bytes[k] for k in ids) != whole for s, ids in ((a, x), (b, y))):
            found.append((i, [], [], [], []))
            continue
        ends = [np.cumsum([len(s.bytes[k]) for k in ids]).tolist() for s, ids in ((a, x), (b, y))]
        sizes, links = groups_and_links(*ends)
        links = [(x[p], y[q]) for p, q in links]
        counts.update(links)
        found.append((i, x, y, sizes, links))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    for i, x, y, sizes, links in found:
        spelled, p, q = [], 0, 0
        for m, n in sizes:
            spelled.append(",".join(map(str, x[p : p + m])) + "|" + ",".join(map(str, y[q : q + n])))
            p, q = p + m, q + n
        digest = hashlib.sha256(";".join(spelled).encode()).hexdigest() if x else ""
        best = sum(counts[k] == most[k[1]] for k in links)
        yield i, len(x), len(y), len(sizes), len(links), best, sum(counts[k] for k in links), digest


@pytest.mark.parametrize("head", [None, 5])
def test_alignment(spark, monkeypatch, head):
    if head:
        monkeypatch.setattr(cross_tokenizer, "HEAD_PAIRS", head)
        monkeypatch.setattr(cross_tokenizer, "SPELL_GROUPS", 7)
    rows = [*ODD, (20, "under▁score"), (21, "<s>a</s> <unk> <0x41>"), (22, prose(4, 20_000)), (None, "﻿ x")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_a long")
    got = cross_alignment(docs, BYTE, PIECE).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
    assert Counter(map(tuple, got.collect())) == Counter(aligned_by_hand(rows))


def test_alignment_of_nothing(nothing):
    assert cross_alignment(nothing, BYTE, PIECE).count() == 0


# --- encoders -----------------------------------------------------------------


def test_unknown_tokenizers_get_whole_texts(tmp_path):
    """One that splits at digits only must not be cut at spaces."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocab = {c: i for i, c in enumerate("ab ")} | {"a b": 3, "a ": 4}
    made = Tokenizer(models.BPE(vocab, [("a", " "), ("a ", "b")]))
    made.pre_tokenizer = pre_tokenizers.Digits()
    made.save(str(tmp_path / "third.json"))
    encoder = Encoder(str(tmp_path / "third.json"))
    texts = ["a b", "b a b a", "", "a ba b"]
    ids, sizes = encoder.encode(pa.array(texts))
    assert encoder.whole and ids.tolist() == [i for t in texts for i in made.encode(t).ids]
    assert sizes.tolist() == encoder.count(pa.array(texts)).tolist() == [len(made.encode(t).ids) for t in texts]


def test_known_tokenizers_may_be_cut():
    import json
    from pathlib import Path

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        spec = json.loads(Path(public_tokenizers.path(name)).read_text())
        assert cuts_are_safe(spec)
        spec["added_tokens"][0]["lstrip"] = True
        assert not cuts_are_safe(spec)
