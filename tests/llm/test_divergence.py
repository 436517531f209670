import collections
import random
import re

import pytest

from tessera.llm import divergence

SCHEMA = "doc_id long, lang string, source string, text string, term string, gid int, p int, tile int, n int, value string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def brute(rows, top=200, min_docs=3):
    """The audit as its contract words it, one term at a time."""
    docs = [(lang or "", source or "", TERM.findall(lower(text or ""))) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = collections.Counter(t for _, _, terms in mine for t in set(terms))
        kept = [t for t, n in seen.items() if n >= min_docs]
        count = collections.defaultdict(collections.Counter)
        for _, source, terms in mine:
            count[source].update(t for t in terms if seen[t] >= min_docs)
        whole = sum(count.values(), collections.Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        def f(x, y):
            return (x - y) ** 2 // y

        for a in list(count):
            pairs = [(b, sum(f(p(count[a], t), p(count[b], t)) for t in kept)) for b in count if b != a]
            terms = [(t, f(p(count[a], t), p(whole, t))) for t in kept if count[a][t] and p(count[a], t) > p(whole, t)]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, a, part, i, v, r) for r, (i, v) in enumerate(items, 1) if part == "pair" or r <= top}
    return out


def run(spark, rows, **how):
    df = spark.createDataFrame([(n, *r, "x", 1, 1, 1, 1, "x") for n, r in enumerate(rows)], SCHEMA)
    got = [tuple(r) for r in divergence.audit(df.repartition(3), **how).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["the", "The", "of", "naïve", "ЖУК", "жук", "x1y", "zz-top", "Ä", "ä", "don't", "\U0001f600", "a\x00b"] + [f"w{chr(97 + k)}" for k in range(26)]
    out = []
    for n in range(220):
        source = f"s{min(9, int(rng.expovariate(0.5)))}"
        out.append((rng.choice(["en", "en", "de", None, ""]), source if n % 11 else None, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))))
    return out + [("en", "empty", None), ("en", "blank", "12 !!"), ("fr", "one", "mot mot"), ("fr", "two", "mot"), ("xx", "alone", "solo " * 3)] * 2


def test_all_values_and_ranks(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_tiles_and_blocks_change_nothing(spark, rows):
    assert run(spark, rows, tile=2, block=7) == brute(rows)


def test_ties_and_top(spark):
    rows = [("en", s, t) for s, t in (("a", "x y z é ü"), ("b", "x y z é ü"), ("c", "q"))] * 3
    assert run(spark, rows, top=2) == brute(rows, top=2)


def test_counts_in_parts(spark, monkeypatch, rows):
    monkeypatch.setattr(divergence, "HELD", 5)
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == set()


def test_long_text_and_long_term(spark, monkeypatch):
    from tessera.llm import words

    monkeypatch.setattr(words, "SLICE", 1000)
    long = "ab " * 5000 + "y" * 300_000 + " cd"
    assert list(words.word_slices(long.encode(), divergence.LETTERS))[0][0] == b"ab"
    assert [w for s in words.word_slices(long.encode(), divergence.LETTERS) for w in s] == [w.encode() for w in long.split()]
    rows = [("en", s, long) for s in "aab"] + [("en", "b", "ab")]
    assert run(spark, rows) == brute(rows)


def test_shares_of_huge_counts_are_exact(spark):
    from pyspark.sql import functions as F

    n, total, kept = 10**15 + 7, 10**18 + 11, 10**9
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(kept)).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (n + 1) // (total + kept)
