"""Quality, language and personal data, held against brute force or held-out labels."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD, prose
from pyspark.sql import functions as F

from airlag.llm import langid, pii, quality, queries


def test_chain_sums_over_all_labelings():
    rng = np.random.default_rng(2)
    counts = np.array([3, 1, 4])
    unary, pair = rng.normal(size=8), rng.normal(size=(2, 2))
    z, good, pairs, at = quality.forward_backward(unary, counts, pair)
    begin = 0
    for d, n in enumerate(counts):
        total, marginal = 0.0, np.zeros(n)
        for states in itertools.product((0, 1), repeat=int(n)):
            score = sum(unary[begin + i] for i, s in enumerate(states) if s)
            weight = math.exp(score + sum(pair[a, b] for a, b in itertools.pairwise(states)))
            total += weight
            marginal += weight * np.array(states)
        assert z[d] == pytest.approx(math.log(total))
        assert good[begin : begin + n] == pytest.approx(marginal / total)
        begin += n
    assert pairs.sum(axis=(1, 2)) == pytest.approx(1)
    assert at.tolist() == [1, 2, 5, 6, 7]


def test_line_features():
    texts = pa.array(["", "Ab ab ab\n\nx!", "é 1"], pa.large_string())
    lines = quality.line_features(texts)
    assert lines.counts.tolist() == [1, 3, 1]
    assert lines.lengths.tolist() == [0, 8, 0, 2, 4]
    assert lines.features[1, 0] == pytest.approx(5 / 8)
    assert lines.features[1, 8] == pytest.approx(1 / 3)


def test_quality_on_held_out_documents(spark, sf_dir):
    rows = queries.op9_quality(spark, "/root/testdata/sf0.01").collect()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    truth = {r.doc_id: r.quality for r in labels}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) > 0.95 * len(held)


def test_quality_fit_holds_repeated_ids_once(spark, monkeypatch):
    held = []
    monkeypatch.setattr(quality, "train", lambda lines, label, weight: held.append((label, weight)))
    # One id has half of the rows, with one text or with a text of its own each.
    for text, most in ((F.lit("the same line"), 9), (F.concat(F.lit("line "), F.col("id")), 80)):
        docs = spark.range(2_000).select(F.lit(0).alias("doc_id"), text.alias("text"))
        docs = docs.unionAll(spark.range(1, 9).select("id", F.lit("another\nline")))
        labels = spark.range(9).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
        quality.fit(docs, labels, rows=40)
        label, weight = held[-1]
        assert len(label) <= most
        assert [round(weight[label == k].sum(), 6) for k in (0, 1)] == [5, 4]
        if most == 9:
            assert weight[label == 0].max() == pytest.approx(5 * 2_000 / 2_004)


def test_quality_of_odd_texts(spark, odd, nothing):
    labels = spark.createDataFrame([(7, 1), (10, 0), (2, 0), (99, 1), (8, None)], "doc_id long, quality int")
    model = quality.fit(odd, labels)
    scored = quality.score_quality(odd, model, keep=["removed"])
    assert scored.columns == ["doc_id", "score", "removed"]
    assert scored.where("score between 0 and 1").count() == len(ODD)
    assert quality.fit(odd, labels.limit(0)) is None
    assert quality.score_quality(odd, None).where("score = 0.5").count() == len(ODD)
    assert quality.keep_good(odd, None).count() == len(ODD)
    assert quality.keep_good(odd, model).columns == odd.columns
    assert quality.score_quality(nothing, model).count() == 0
    assert quality.fit(nothing, labels) is None


def test_the_fitting_sample_is_bounded(spark):
    rows = [(i, prose(i, 12) if i % 2 else f"{i} $$$ ### %%%") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = quality.fit(docs, labels, rows=40)
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    assert all((s > 0.5) == (i % 2 == 1) for i, s in scores.items())


def test_languages_on_held_out_documents(spark):
    rows = queries.op10_language(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    truth = {r.doc_id: r.lang for r in docs}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.98 * len(held)


def naive_bayes(train, text, rows):
    def grams(t):
        low = re.sub(r"\s+", " ", "".join(c.lower() if c.isalpha() else " " for c in f" {t or ''} "))
        return low

    def of(t):
        line = grams(t)
        for n in langid.ORDERS:
            for i in range(len(line) - n + 1):
                yield line[i : i + n]

    counts = {k: Counter(g for t in v for g in of(t)) for k, v in train.items()}
    return {
        k: math.log(rows[k] / sum(rows.values()))
        + sum(math.log((counts[k][g] + 0.5) / (sum(counts[k].values()) + langid.BUCKETS / 2)) for g in of(text))
        for k in counts
    }


def test_language_model_is_naive_bayes(spark, odd, nothing):
    train = {"a": ["Der Hund und die Katze", "das ist gut"], "b": ["the dog and the cat", "this is good", None]}
    rows = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, v in train.items() for t in v)]
    rows += [(50, "unknown", None)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = ["und das", "the good dog", "12", "x", ""]
    best, score = model.score(pa.array(texts, pa.large_string()))
    for text, b, s in zip(texts, best, score, strict=True):
        logs = naive_bayes(train, text, {"a": 2, "b": 3})
        top = max(logs.values())
        assert logs[model.langs[b]] == pytest.approx(top, abs=1e-3)
        assert s == pytest.approx(1 / sum(math.exp(x - top) for x in logs.values()), abs=1e-3)
    found = langid.predict_language(odd, model).collect()
    assert len(found) == len(ODD)
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 3, 4)} == {"und"}
    assert {r.lang_pred for r in found if r.doc_id in (7, 8, 12)} <= {"a", "b"}
    assert langid.predict_language(nothing, model).count() == 0
    none = langid.fit(nothing)
    assert {r.lang_pred for r in langid.predict_language(odd, none).collect()} == {"und"}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 10 <= len(digits) <= 15
            ):
                found.append((m.start(), k, m.end()))
    return sorted(found)


def private_texts():
    import random

    rng = random.Random(4)
    texts = [t for _, t in ODD] + [
        "😀 a@b.com-x_y@d.org 1.2.3.4.5.6.7.8 999.1.1.1 256.1.1.1 0255.01.1.1 a@b a@b. x@-.-",
        "1 " * 20_000, "a" * 30_000 + "@x.de", "4111 1111 1111 1111 and 4111-1111-1111-1112",
        "+1 (706) 555-3138 call (706) 555-3139, +12, +1+2+3+14155552671",
    ]
    texts += ["".join(rng.choice("ab1234567890.@+- ()") for _ in range(120)) for _ in range(200)]
    texts += [f"Call me on ({200 + i}) 555-0{100 + i} or mail joe{i} [at] site{i} [dot] com" for i in range(40)]
    texts += [f"Reach +1 (2{i:02d}) 555-0100 or x{i}@mail.com at 10.0.0.{i}" for i in range(60)]
    return texts


def test_personal_data(spark, nothing):
    texts = private_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_pii(docs.withColumn("spans", F.lit(1))).collect()}
    for i, text in enumerate(texts):
        assert [tuple(s) for s in found[i].base] == base_spans(text)
        for s in found[i].added:
            assert not any(s.begin < e and b < s.end for b, _, e in base_spans(text))
    # The method finds spellings that the exact patterns leave out.
    loose = [found[i] for i, t in enumerate(texts) if t and t.startswith("Call me on")]
    assert sum(len(r.added) == 2 for r in loose) > 30
    assert pii.find_pii(nothing).count() == 0
    plain = pii.find_pii(docs.where("doc_id < 3"))
    assert plain.where("size(base) + size(added) = 0").count() == 3
    shown = plain.select(F.sha2(pii.joined(F.col("base")), 256)).first()[0]
    assert shown == hashlib.sha256(b"").hexdigest()


def test_no_python_on_the_way_to_personal_data(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for plan in (pii.candidates(docs), pii.find_pii(docs)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Exchange", text)


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(6)
    truth = rng.random(4000) < 0.3
    right = [0.95, 0.9, 0.85, 0.6, 0.8]
    votes = [np.where(rng.random(4000) < p, truth, ~truth) * 2 - 1 for p in right]
    counted = Counter(zip(*[v.tolist() for v in votes], strict=True))
    known = pii.estimate([(0, v, n) for v, n in sorted(counted.items())])
    assert known.share[0] == pytest.approx(0.3, abs=0.05)
    for p, table in zip(right, known.chance[0], strict=True):
        assert table[1][0] == pytest.approx(p, abs=0.06)
        assert table[-1][1] == pytest.approx(p, abs=0.06)


def test_personal_data_in_odd_texts(spark, odd):
    more = [(30, "write to a.b@c.org, or +1 (202) 555 0147"), (30, "write to a.b@c.org, or +1 (202) 555 0147"), (None, "x@y.zz")]
    docs = odd.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    docs = docs.withColumns({c: F.lit("clash") for c in ("base", "spans", "added", "likely", "kind")})
    rows = pii.find_pii(docs).collect()
    assert len(rows) == len(ODD) + 3
    of = Counter((r.doc_id, tuple((s.begin, s.kind, s.end) for s in r.base)) for r in rows)
    assert of[30, ((9, 0, 18), (23, 3, 40))] == 2 and of[None, ((0, 0, 6),)] == 1
    assert sum(len(r.base) for r in rows) == 5


def test_personal_data_in_long_texts(spark, monkeypatch):
    """Matches are placed in stretches; the work grows with their number."""
    words = [f"word user{i}@mail{i % 7}.example.com" if i % 4 else f"call 202-555-{i % 10000:04d} now" for i in range(20_000)]
    text = " ".join(words)
    docs = spark.createDataFrame([(1, text), (2, "no data"), (3, " ".join(words[:100]))], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_pii(docs).collect()}
    expected = [(m.start(), 0, m.end()) for m in re.finditer(r"user\S+", text)]
    assert [tuple(s) for s in found[1].base] == expected
    assert found[2].base == [] and len(found[3].base) == 75
    phones = {(m.start(), m.end()) for m in re.finditer(r"202-555-\d{4}", text)}
    assert all(s.kind == 3 and (s.begin, s.end) in phones for s in found[1].added)


def test_loose_matches_inside_base_spans_are_no_candidates(spark):
    docs = spark.createDataFrame([(1, "call +1 202 555 0147 or 303 555 0199")], "doc_id long, text string")
    every = pii.candidates(docs)
    kept = pii.clear_spans(every).first().spans
    assert len(every.first().spans) == 3
    assert [(s.begin, s.base) for s in sorted(kept, key=lambda s: s.begin)] == [(5, True), (24, False)]


def test_the_likeliest_of_overlapping_spans_stays(spark):
    spans = [(0.95, 0, 10, 0, True), (0.97, 5, 12, 1, True), (0.99, 11, 20, 2, False), (0.91, 30, 40, 0, True), (0.91, 35, 37, 3, False)]
    kind = "array<struct<p: double, begin: int, end: int, kind: int, exact: boolean>>"
    df = spark.createDataFrame([(1, spans), (2, [])], f"doc_id long, likely {kind}")
    found = {r.doc_id: [s.begin for s in r.added] for r in pii._best_of_overlapping(df).collect()}
    assert found == {1: [11, 30], 2: []}
