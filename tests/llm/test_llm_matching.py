"""Decontamination, near duplicates, fingerprints and line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD, prose
from pyspark.sql import functions as F

from airlag.llm import decontaminate, near_dedup
from airlag.llm.components import components
from airlag.llm.decontaminate import contamination, remove_contaminated
from airlag.llm.fingerprints import densify, edit_likeness, fingerprints, likeness, sketch
from airlag.llm.line_dedup import dedup_lines

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


ITEMS = [
    ("10", prose(7, 4_000)[500:1500]), ("2", "ONE"), ("3", None), ("4", "..."),
    ("5", "日本語 Ñandú"), ("2", "ONE"), ("6", prose(8, 60)), (None, "two spaces"),
]


def windows(width=10):
    found = defaultdict(set)
    for item, text in ITEMS:
        w = words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            found[tuple(w[i : i + width])].add(item or "null")
    return found


def hits(text):
    w, hit, items = words(text), set(), set()
    for window, ids in windows().items():
        for i in range(len(w) - len(window) + 1):
            if tuple(w[i : i + len(window)]) == window:
                hit |= set(range(i, i + len(window)))
                items |= ids
    return len(w), len(hit), sorted(items)


@pytest.mark.parametrize("block_chars", [4_000_000, 50])
def test_contamination(spark, odd, nothing, block_chars):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    rows = contamination(odd, items, block_chars=block_chars).collect()
    texts = dict((i, t) for i, t in ODD if i is not None)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in rows) == Counter(
        (i, n, h, tuple(x)) for i, t in ODD for n, h, x in [hits(t)]
    )
    for r in rows:
        if r.doc_id is not None:
            inside = [len(words(texts[r.doc_id][s.begin : s.end])) for s in r.spans]
            assert sum(inside) == r.n_hit
    clean = remove_contaminated(odd, items, block_chars=block_chars)
    assert clean.columns == odd.columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(
        (i, t) for i, t in ODD if not hits(t)[1]
    )
    assert contamination(nothing, items).count() == 0
    no_item = contamination(odd, items.limit(0)).agg(F.sum("n_hit"), F.count("*")).first()
    assert tuple(no_item) == (0, len(ODD))
    assert remove_contaminated(odd, items.limit(0)).count() == len(ODD)


def test_blocks_of_items_are_drawn_one_at_a_time(spark, odd, monkeypatch):
    events = []

    def watched(call, name):
        def blocks(*args):
            for n, block in enumerate(call(*args)):
                events.append((name, n))
                yield block

        return blocks

    scan = decontaminate._scan
    monkeypatch.setattr(decontaminate, "item_blocks", watched(decontaminate.item_blocks, "drawn"))
    monkeypatch.setattr(decontaminate, "_scan", lambda *a: events.append(("scan", None)) or scan(*a))
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    contamination(odd, items, block_chars=50)
    drawn = [i for i, e in enumerate(events) if e[0] == "drawn"]
    scans = [i for i, e in enumerate(events) if e[0] == "scan"]
    assert len(drawn) == len(scans) > 2
    # Two are drawn to tell one block from more; each further one follows a scan.
    assert all(scans[n - 2] < drawn[n] for n in range(2, len(drawn)))


def kmers(text):
    w, seen, out = (text or "").split(), Counter(), []
    for i in range(max(1, len(w) - 4) if w else 0):
        g = tuple(w[i : i + 5])
        out.append((g, seen[g]))
        seen[g] += 1
    return out


def aligned(a, b):
    if not a and not b:
        return 1.0
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1] / (len(a) + len(b) - row[-1])


def edited(text, seed, edits):
    rng, w = random.Random(seed), text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def near_texts():
    texts = [t for _, t in ODD]
    for base in range(4):
        text = prose(100 + base, 150)
        texts += [text, text]
        texts += [edited(text, s, e) for e in (1, 2, 4, 8) for s in range(5)]
        w = text.split(" ")
        texts += [" ".join(w[:75]), " ".join(w[75:] + w[:75]), text + " " + text]
    return list(enumerate(texts))


def expected_classes(rows):
    seqs = [kmers(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = seqs[i], seqs[j]
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and aligned(a, b) >= 0.8:
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_near_duplicates(spark, odd, nothing):
    rows = near_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("clash"))
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert found == expected_classes(rows)
    kept = near_dedup.keep_one(docs.unionAll(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(found.values()))
    assert near_dedup.near_duplicates(nothing).count() == 0
    assert near_dedup.keep_one(nothing).count() == 0
    some = near_dedup.near_duplicates(odd).collect()
    assert len(some) == len(ODD)
    assert {r.class_id for r in some if r.doc_id in (5, 6)} == {5}
    texts = Counter(r.text or "" for r in near_dedup.keep_one(odd).collect())
    assert set(texts) == {t or "" for _, t in ODD} and max(texts.values()) == 1


def test_a_large_group_stays_together(spark):
    base = prose(500, 200)
    rows = [(i, edited(base, i, 1)) for i in range(300)] + [(1000, prose(501, 200))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter(r.class_id for r in near_dedup.near_duplicates(docs).collect())
    assert found == {0: 300, 1000: 1}


def replaced(text, seed, edits):
    """``edits`` words replaced, far enough apart to cost five k-mers each."""
    rng, w = random.Random(seed), text.split()
    for at in rng.sample(range(len(w) // 10), edits):
        w[at * 10 + rng.randrange(5)] = f"edit{rng.randrange(10**9)}"
    return " ".join(w)


def test_copies_that_are_alike_only_through_their_original(spark):
    base = " ".join(prose(510, 400).split())
    rows = [(0, base)] + [(i, replaced(base, i, 8)) for i in range(1, 1001)]
    made = [near_dedup.labelled_kmers(pa.array([t], pa.large_string()))[0] for _, t in rows[:40]]
    assert all(near_dedup.similarity(made[0], x) > 0.8 for x in made[1:])
    apart = [near_dedup.similarity(x, y) for i, x in enumerate(made[1:], 2) for y in made[i:]]
    assert np.mean(np.array(apart) == 0) > 0.97
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(r.class_id for r in near_dedup.near_duplicates(docs).collect()) == {0: 1001}


def test_large_groups_of_copies_a_little_below_each_other(spark):
    base = " ".join(prose(511, 400).split())
    rows = [(0, base)] + [(i, replaced(base, i, 6)) for i in range(1, 1001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(r.class_id for r in near_dedup.near_duplicates(docs).collect()) == {0: 1001}


def test_large_groups_go_on_outside_their_largest_component(spark, monkeypatch):
    # Tiles of four texts: the first tile alone connects only part of this chain
    # of versions, and the tasks after it have to find all other links.
    monkeypatch.setattr(near_dedup, "SMALL_GROUP", 1)
    monkeypatch.setattr(near_dedup, "TILE", 4)
    texts = [" ".join(prose(520, 150).split())]
    for i in range(40):
        w = texts[-1].split()
        w[i * 3 + 1] = f"new{i}"
        texts.append(" ".join(w))
    rows = list(enumerate([*texts, *(prose(530 + i, 150) for i in range(3))]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert found == expected_classes(rows)


def test_overlaps_count_common_kmers(monkeypatch):
    rng = np.random.default_rng(3)
    kmers = [rng.choice(400, rng.integers(0, 90), replace=False).astype(np.uint64) for _ in range(70)]
    expected = [[len(np.intersect1d(a, b)) for b in kmers] for a in kmers]
    for rare, columns in ((40, 4096), (3, 50), (1000, 10)):
        monkeypatch.setattr(near_dedup, "RARE", rare)
        monkeypatch.setattr(near_dedup, "COLUMNS", columns)
        found = near_dedup.overlaps(kmers)
        np.fill_diagonal(found, [len(k) for k in kmers])
        assert found.tolist() == expected


def test_a_tile_passes_on_a_forest():
    base = np.arange(100, dtype=np.uint64)
    kmers = [np.concatenate([base[:95], base[:5] + 1000 * i]) for i in range(1, 30)] + [base[50:]]
    node = np.arange(100, 130)
    none, two = np.zeros(30, int), np.arange(30) % 2
    for side in (none, two):
        links = near_dedup.spanning_links(node, node, side.astype(bool), kmers, 0.8)
        assert len(links) == 28 and {x for pair in links for x in pair} == set(range(100, 129))
    label = np.where(node < 110, 100, node)
    assert len(near_dedup.spanning_links(node, label, none.astype(bool), kmers, 0.8)) == 19


def classes_by_brute_force(rows):
    """Classes from every pair of texts that shares enough labelled k-mers."""
    ids = defaultdict(list)
    for i, t in rows:
        ids[t or ""].append(i)
    kmers, sizes = near_dedup.labelled_kmers(pa.array(list(ids), pa.large_string()))
    each = np.split(kmers, np.cumsum(sizes)[:-1])
    _, column, count = np.unique(kmers, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(column, kind="stable")]
    first, begin = np.cumsum(count) - count, np.cumsum(sizes) - sizes
    root = list(range(len(sizes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, n in enumerate(sizes.tolist()):
        held = column[begin[i] : begin[i] + n]
        others = np.concatenate([owner[first[c] : first[c] + count[c]] for c in held[count[held] > 1]] or [[]])
        for j, m in zip(*np.unique(others[others > i], return_counts=True), strict=True):
            j = int(j)
            if m >= 0.8 * (n + sizes[j] - m) - 1e-6 and near_dedup.similarity(each[i], each[j]) > 0:
                root[find(i)] = find(j)
    classes = defaultdict(list)
    for x, own in enumerate(ids.values()):
        classes[find(x)] += own
    return {i: min(c) for c in classes.values() for i in c}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_classes_of_the_tables(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    assert found == classes_by_brute_force(rows)


def test_alignment_respects_order():
    a = np.arange(100, dtype=np.uint64)
    assert near_dedup.similarity(a, a) == 1
    assert near_dedup.similarity(a, np.roll(a, 50)) == 0
    assert near_dedup.similarity(a, a[5:]) == pytest.approx(0.95)
    swapped = a.copy()
    swapped[[10, 12]] = swapped[[12, 10]]
    assert near_dedup.similarity(a, swapped) == pytest.approx(98 / 102)
    assert near_dedup.similarity(a[:0], a[:0]) == 1


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    edges = [(a, b) for a, b in edges if a != b]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.label for r in components(df).collect()} == root
    assert components(df.limit(0)).count() == 0


def test_likeness_is_near_jaccard():
    pairs = []
    for seed in range(60):
        text = prose(seed, 300)
        pairs.append((text, edited(text, seed, seed // 2)))
    a, b = (pa.array(list(x), pa.large_string()) for x in zip(*pairs, strict=True))
    found = likeness(sketch(a), sketch(b))
    for (x, y), value in zip(pairs, found, strict=True):
        s, t = ({g for g, _ in kmers(z)} for z in (x, y))
        assert abs(value - len(s & t) / len(s | t)) < 0.1
    # Every bin is filled, from bins of the same text.
    least = np.full((2, 512), 2**64 - 1, np.uint64)
    least[0, 5] = 7
    filled = densify(least)
    assert (filled[0] == 7).all() and (filled[1] == 2**64 - 1).all()


def test_fingerprints_of_odd_texts(spark, odd, nothing):
    rows = edit_likeness(odd).collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected = Counter()
    for k, (i, t) in enumerate(order):
        text, after = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        made = text[: len(text) - half] + after[:half]
        expected[i, len(text), hashlib.sha256(made.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == expected
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    marks = defaultdict(set)
    kept = fingerprints(odd, keep=["removed"])
    assert kept.columns == ["doc_id", "fingerprint", "removed"]
    texts = {f"r{n}": t or "" for n, (_, t) in enumerate(ODD)}
    for r in kept.collect():
        marks[texts[r.removed]].add(bytes(r.fingerprint))
    assert all(len(v) == 1 for v in marks.values())
    assert edit_likeness(nothing).count() == 0
    assert edit_likeness(odd.where("doc_id = 7")).first().near_next == 1


def without_copies(rows, least=50):
    """Removes lines inside any run of enough words that occurs earlier too."""
    docs = []
    for i, t in sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        docs.append(((i, t), t.split("\n")))
    seen, gone = set(), defaultdict(set)
    for key, lines in docs:
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(lines[a:b])
                size = sum(max(1, len(x.split())) for x in run)
                if size >= least and size - max(1, len(run[0].split())) < least + 400:
                    if run in seen:
                        gone[key] |= set(range(a, b))
                    else:
                        seen.add(run)
    return {key: [n for n in range(len(lines)) if n not in gone[key]] for key, lines in docs}


def line_rows():
    rng = random.Random(9)
    passages = [prose(s, 90).split("\n") for s in range(6)]
    short = ["all rights reserved", "", "menu | home | about", "a b c d e f g h i j"]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randint(1, 5)):
            kind = rng.random()
            if kind < 0.4:
                lines += rng.choice(passages)[rng.randint(0, 2) :]
            elif kind < 0.7:
                lines += [rng.choice(short)] * rng.randint(1, 8)
            else:
                lines += prose(rng.randrange(10**6), 30).split("\n")
        rows.append((i, "\n".join(lines)))
    return rows


def test_line_dedup(spark, odd, nothing):
    rows = line_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    expected = without_copies(rows)
    for r in dedup_lines(docs).collect():
        lines = dict(rows)[r.doc_id].split("\n")
        stay = expected[r.doc_id, dict(rows)[r.doc_id]]
        assert r.text == "\n".join(lines[n] for n in stay)
        assert (r.n_lines, r.n_removed) == (len(lines), len(lines) - len(stay))
        assert sum(c.last_line - c.first_line + 1 for c in r.removed) == r.n_removed
    found = dedup_lines(odd).collect()
    assert len(found) == len(ODD)
    # Document 9 repeats document 8, whose repeated rows are one document.
    assert {r.doc_id for r in found if r.n_removed} == {9}
    assert [r.text for r in found if r.doc_id == 1] == [None]
    assert dedup_lines(nothing).count() == 0
