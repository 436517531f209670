import collections

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import quality

from .test_scans import base_spans
from .test_text_joins import forms, roots, shingles

SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, steps[-1], SF).cache()
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        steps.append(out)
    start, good, lines, single, clean = [{r["doc_id"]: r for r in s.collect()} for s in steps]

    keep = {r["doc_id"] for r in quality.report(docs).where("keep").collect()}
    assert set(good) == keep and all(good[i] == start[i] for i in good)

    assert set(lines) == set(good)
    firsts, seen = collections.defaultdict(list), set()
    for i in sorted(good):  # equal lines: exactly the first occurrence stays
        for k, form in forms(good[i]["text"]):
            if form not in seen:
                firsts[i].append(form)
            seen.add(form)
    for i, r in lines.items():
        got = [f for _, f in forms(r["text"])]
        assert set(got) <= set(firsts[i]) and r["n_chars"] == len(r["text"])

    sets = {i: shingles(r["text"]) for i, r in lines.items()}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert set(single) == {i for i, root in roots(ids, links).items() if i == root}
    assert all(single[i] == lines[i] for i in single)

    assert set(clean) == set(single)
    for i, r in clean.items():
        assert not base_spans(r["text"])
        if not base_spans(single[i]["text"]) and "[secret]" not in r["text"]:
            assert r == single[i]

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = collections.defaultdict(list)
    for p in corpus_pipeline.STAGES[-1][1](spark, steps[-1], SF).collect():
        pieces[p["doc_id"]].append((p["start"], p["ids"]))
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in pieces.items()} == {
        i: tok.encode(r["text"], add_special_tokens=False).ids + [0] for i, r in clean.items()}


def test_no_document_is_lost_by_name(spark):
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    kept = {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).select("doc_id").collect()}
    assert all(i in kept for i, q in labels.items() if q)


def test_edge_tables_end_to_end(spark, tmp_path):
    """Repeated rows, null ids and texts, one id over two texts; no rows at all."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = [tuple(r) for r in docs.join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id"), "doc_id").orderBy("doc_id").limit(12).select(*docs.columns).collect()]
    own = {r[1].split("\n")[0] for r in good}
    rows = [*good, good[0], good[0], (None, *good[1][1:]), (good[2][0], *good[3][1:]), (10**9, None, "en", "s", 0), (10**9 + 1, "", None, None, None), (None, None, None, None, None)]
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{tmp_path}/documents.parquet")
    pieces = collections.defaultdict(list)
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces[p["doc_id"]].append(p)
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = tok.decode([x for ps in pieces.values() for p in sorted(ps, key=lambda p: p["start"]) for x in p["ids"]])
    assert {good[i][0] for i in (0, 4, 5)} <= set(pieces) and None in pieces
    assert sum(line in text for line in own) == len(own)
    assert 10**9 not in pieces  # without a word: not kept
    spark.createDataFrame([], docs.schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
