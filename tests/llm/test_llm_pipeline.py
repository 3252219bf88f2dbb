"""The pipeline's stages, each on what the stage before it kept."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from conftest_llm import ODD
from pyspark.sql import functions as F
from test_llm_matching import classes_by_brute_force
from tokenizers import Tokenizer

from airlag.llm import quality, queries
from airlag.llm.common import crc_remainder, materialize, read


def test_stages(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        found = materialize(stage(spark, docs, sf_dir))
        if name != "packing":
            assert found.dtypes == docs.dtypes
            ids = {r.doc_id for r in found.select("doc_id").collect()}
            assert ids <= {r.doc_id for r in docs.select("doc_id").collect()}
            kept[name] = len(ids)
            docs = found
        else:
            assert {r.doc_id for r in found.select("doc_id").collect()} == ids
    assert 100 < kept["decontamination"] < kept["quality"] < 200
    again = corpus_pipeline.run(spark, sf_dir)
    assert again.count() == found.count()


def test_stages_keep_clean_documents(spark, sf_dir):
    """Labelled good documents without repeats or benchmark passages all stay."""
    docs = read(spark, sf_dir, "documents")
    good = corpus_pipeline.good_quality(spark, docs, sf_dir)
    labels = read(spark, sf_dir, "labels").where("quality = 1")
    lost = docs.join(good, "doc_id", "left_anti").join(labels, "doc_id", "left_semi")
    assert lost.count() == 0


def test_empty_table(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        assert docs.count() == 0


def dedup_lines_by_sql(rows):
    """Documents after line dedup, by the SQL twin of its query."""
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r.doc_id for r in rows], "text": [r.text for r in rows]}))
    found = con.execute(f"SELECT doc_id, n_lines, removed FROM ({queries.OP7_SQL})").fetchall()
    gone = {i: (n, [tuple(map(int, x.split("-"))) for x in cut.split(",") if x]) for i, n, cut in found}
    kept = {}
    for r in rows:
        n, cuts = gone[r.doc_id]
        lines = [x for k, x in enumerate(r.text.split("\n")) if not any(a <= k <= b for a, b in cuts)]
        if lines or not n:
            kept[r.doc_id] = "\n".join(lines)
    return kept


def test_every_stage_against_brute_force(spark):
    """On 1,000 documents each stage gives what a plain version of it gives."""
    sf_dir = "/root/testdata/sf0.01"
    docs = read(spark, sf_dir, "documents")
    stage = dict(corpus_pipeline.STAGES)

    good = materialize(stage["quality"](spark, docs, sf_dir))
    labels = read(spark, sf_dir, "labels").where(crc_remainder() != 2)
    scores = quality.score_quality(docs, quality.fit(docs, labels)).collect()
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores if r.score >= 0.5}

    lines = materialize(stage["line_dedup"](spark, good, sf_dir))
    assert {r.doc_id: r.text for r in lines.collect()} == dedup_lines_by_sql(good.collect())

    near = materialize(stage["near_dedup"](spark, lines, sf_dir))
    classes = classes_by_brute_force([(r.doc_id, r.text) for r in lines.collect()])
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(classes.values()))
    assert near.exceptAll(lines).isEmpty()

    clean = materialize(stage["decontamination"](spark, near, sf_dir))
    con = duckdb.connect()
    con.register("documents", near.select("doc_id", "text").toArrow())
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{sf_dir}/benchmark.parquet'")
    hit = dict(con.execute(f"SELECT doc_id, contaminated FROM ({queries.OP2_SQL})").fetchall())
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, bad in hit.items() if not bad)
    assert any(hit.values()) and clean.exceptAll(near).isEmpty()

    pieces = stage["packing"](spark, clean, sf_dir).collect()
    library = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    ids = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 2] for r in clean.collect()}
    cut, ends = {}, {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        own = np.frombuffer(p.ids, "<u4").tolist()
        assert len(own) == p.length and cut.setdefault(p.doc_id, []) == ids[p.doc_id][: p.start]
        cut[p.doc_id] += own
    assert cut == ids
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0)
        ends[p.sequence_id] = p.offset + p.length
    assert max(ends.values()) <= 4096 and sum(ends.values()) > 0.9 * 4096 * len(ends)


def test_stages_of_odd_documents(spark, tmp_path):
    """Null and empty texts, null and repeated ids, repeated rows and columns
    whose names operators use: no stage fails, and clean documents stay."""
    rows = [(i, t, "en", "s", None if t is None else len(t), f"x{n}") for n, (i, t) in enumerate(ODD)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, removed string"
    docs = spark.createDataFrame(rows, schema).withColumn("score", F.lit(0.1)).withColumn("label", F.lit("a"))
    sf_dir = str(tmp_path)
    spark.createDataFrame([(99, 1, 0), (98, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf_dir}/labels.parquet")
    item = [(1, " ".join(ODD[8][1].split()[5:25])), (2, None), (3, "")]
    spark.createDataFrame(item, "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)
    # Without any labelled document nothing is rejected.
    good = materialize(stage["quality"](spark, docs, sf_dir))
    assert good.columns == docs.columns and good.exceptAll(docs).isEmpty() and good.count() == len(ODD)
    lines = materialize(stage["line_dedup"](spark, good, sf_dir))
    assert set(lines.columns) == set(docs.columns)
    near = materialize(stage["near_dedup"](spark, lines, sf_dir))
    assert Counter(r.text or "" for r in near.collect()).most_common(1)[0][1] == 1
    clean = materialize(stage["decontamination"](spark, near, sf_dir))
    assert {r.doc_id for r in near.collect()} - {r.doc_id for r in clean.collect()} == {8}
    pieces = stage["packing"](spark, clean, sf_dir)
    assert pieces.select("doc_id").distinct().count() == clean.select("doc_id").distinct().count()
    for name in stage:
        assert stage[name](spark, docs.limit(0), sf_dir).count() == 0
