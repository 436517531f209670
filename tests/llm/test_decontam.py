import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window, span):
    out = []
    wins = {(name or "", tuple(w[i:i + window])) for name, text in items if (w := words(text)) for i in range(max(1, len(w) - window + 1))}
    for doc, text, *_ in docs:
        w = words(text)
        hit, found, near = set(), set(), set()
        for name, g in wins:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    found.add(name)
            if span and any(set(g) <= set(w[i:i + span]) for i in range(len(w))):
                near.add(name)
        out.append((doc, len(w), len(hit), sorted(found), sorted(near)))
    return sorted(out, key=str)


def run(spark, docs, rows, items, **how):
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id string, text string, row string, terms int")
    return sorted((tuple(r) for r in decontam.contamination(docs(rows).repartition(3), table, **how).collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    vocabulary = ["a", "b", "c", "der", "ÉTÉ", "x1", "don't", "\U0001f600", "Wort", "q_r"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(str(k), say(rng.randint(1, 14))) for k in range(25)]
    rows = [(k, say(rng.randint(0, 120))) for k in range(40)]
    rows += [(50 + k, f"{say(20)}, {items[k][1].upper()}\n{say(9)} {items[k + 1][1]}") for k in range(20)]
    rows += [(3, rows[4][1]), (3, rows[3][1]), (None, rows[52][1]), (70, None), (71, ""), (72, "... !"), (73, "\x00")]
    items += [("none", None), ("empty", "- -"), ("0", "a a a a a a a a a a a"), ("0", items[0][1]), (None, "unique words here")]
    rows += [(80, "some unique Words HERE too"), (81, " ".join(reversed(words(items[3][1]))))]
    return rows, items


@pytest.mark.parametrize("window, span", [(10, 15), (3, 5), (2, None), (4, 4), (5, 3), (1, 1)])
def test_phrases_and_proximity_of_brute_force(spark, docs, texts, window, span):
    rows, items = texts
    want = brute(rows, items, window, span)
    assert run(spark, docs, rows, items, window=window, span=span) == want
    assert any(r[2] for r in want)


def test_blocks_pieces_and_passes_change_nothing(spark, docs, texts):
    rows, items = texts
    rows = rows + [(90, " ".join(t for _, t in rows[:40] if t))]
    want = brute(rows, items, 4, 6)
    for how in ({"block_words": 50}, {"piece_words": 7, "block_words": 30}, {"piece_words": 1, "block_words": 1}, {"pass_words": 20}, {"pass_words": 1, "piece_words": 11}):
        assert run(spark, docs, rows, items, window=4, span=6, **how) == want, how


def test_small_steps(spark, docs, texts, monkeypatch):
    rows, items = texts
    monkeypatch.setattr(decontam, "AT_ONCE", 3)
    from tessera.llm import words as slices

    monkeypatch.setattr(slices, "SLICE", 40)
    assert run(spark, docs, rows, items, window=3, span=5) == brute(rows, items, 3, 5)


def test_empty_tables(spark, docs, texts):
    rows, items = texts
    assert run(spark, docs, [], items) == []
    assert run(spark, docs, rows, []) == brute(rows, [], 10, 15)


def test_report_columns(spark, docs, texts):
    import hashlib

    rows, items = texts
    table = spark.createDataFrame(items, "item_id string, text string")
    got = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"], r["n_near"]) for r in decontam.report(docs(rows), table).collect()}
    assert got == {(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0, len(c)) for d, n, h, i, c in brute(rows, items, 10, 15)}


def test_whole_text_of_a_long_document(spark, docs):
    item = "one two three four five six seven eight nine ten"
    long = "filler text " * 200_000 + item + " more" * 100
    assert run(spark, docs, [(1, long)], [("i", item)], piece_words=50_000) == [(1, 400_110, 10, ["i"], ["i"])]


def test_blocks_go_to_python_one_by_one(spark, docs, monkeypatch):
    """A block is a row of some MB; texts cross a few MB at a time."""
    keys = ["spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    before, seen, cut = [spark.conf.get(k) for k in keys], [], decontam.cut

    def rows(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"]) for b in batches)

    def counted(df):
        wide = spark.range(0, 4, 1, 1).select(F.expr("repeat('x', 3000000)").alias("text"))
        seen.append(max(r["n"] for r in wide.mapInArrow(rows, "n long").collect()))
        return cut(df)

    monkeypatch.setattr(decontam, "cut", counted)
    got = run(spark, docs, [(1, "a b c d"), (2, "b c")], [("i", "b c")], window=2, span=None)
    assert [(d, hit) for d, _, hit, *_ in got] == [(1, 2), (2, 2)]
    assert seen == [1, 1]  # of the texts and of the blocks
    assert [spark.conf.get(k) for k in keys] == before
