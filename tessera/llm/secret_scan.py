"""Secrets in texts: fixed forms and a randomness test battery, in DataFrame
functions only.

Fixed forms (``assign``, ``access``, ``hex``) are found by their patterns.
The battery looks at every run of 20 or more characters of an encoding: it
infers the alphabet and tests whether the run looks drawn from it at random,

* chi-squared against uniform use of the alphabet,
* Wald-Wolfowitz runs above and below the alphabet's middle,
* serial correlation of neighbours.

A run that fails any of them at `REJECT` standard deviations is no secret.
The others get a p-value against the hypothesis of ordinary words: the
probability that text, whose symbols coincide as letters of natural languages
do, shows so few coincidences. Short runs cannot reach small p-values, so the
false-discovery control (Benjamini-Hochberg at `RATE`) is done in classes of
length, over all runs of all texts; runs below their class's threshold are
spans of kind ``random``. The histogram of p-values has a fixed number of
bins, so one small row of thresholds is broadcast.

Positions are code points, end exclusive. A null text is empty and has no
spans; rows that repeat are scanned each; a null doc_id stays null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import boxed, unboxed

# The forms asked for and the least length of what they find.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "random"]

RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings, the narrowest first: its form and its alphabet in order.
ENCODINGS = [
    (r"^[0-9]+$", None), (r"^[0-9a-f]+$", DIGITS + "abcdef"), (r"^[0-9A-F]+$", DIGITS + "ABCDEF"), (r"^[a-z]+$", LOWER), (r"^[A-Z]+$", UPPER),
    (r"^[A-Z2-7]+$", UPPER + "234567"), (r"^[0-9a-z]+$", DIGITS + LOWER), (r"^[0-9A-Z]+$", DIGITS + UPPER), (r"^[A-Za-z]+$", UPPER + LOWER),
    (r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS), (r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"), (r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
    (r"", UPPER + LOWER + DIGITS + "+/-_"),
]
REJECT, RATE = 3.3, 0.01
# Of two letters of a text, so many are the same one (index of coincidence); of three, so many.
PAIR, TRIPLE = 0.07, 0.0064
BINS = 300  # tenths of -log10 p


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _found(text: Column, pattern: str) -> Column:
    """All matches with places: ``array<struct<start, end, body>>``.

    Places are running sums of what lies between matches and the matches; the
    sums are taken in blocks of 256, so many matches stay cheap.
    """
    none = F.array().cast("array<struct<start:int,end:int,body:string>>")

    def place(found: Column, gaps: Column) -> Column:
        steps = F.transform(found, lambda x, i: F.length(F.get(gaps, i)) + F.length(x))

        def ends(s: Column) -> Column:
            block = lambda b: F.aggregate(F.slice(s, b * 256 + 1, F.lit(256)), F.lit(0), lambda x, y: x + y)
            sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(s) - 1) / 256).cast("int")), block)

            def placed(t: Column) -> Column:
                base = F.transform(t, lambda _, b: F.aggregate(F.slice(t, F.lit(1), b), F.lit(0), lambda x, y: x + y))

                def row(x: Column, i: Column, at: Column) -> Column:
                    b = F.floor(i / 256).cast("int")
                    end = F.get(at, b) + F.aggregate(F.slice(s, b * 256 + 1, i - b * 256 + 1), F.lit(0), lambda u, v: u + v)
                    return F.struct((end - F.length(x)).alias("start"), end.alias("end"), x.alias("body"))

                return _let(base, lambda at: F.transform(found, lambda x, i: row(x, i, at)))

            return _let(sums, placed)

        return _let(steps, ends)

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(
        _let(F.split(text, pattern, -1), lambda gaps: place(found, gaps))))


def _as_spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def _tail(z: Column) -> Column:
    """-log10 of the normal probability beyond z."""
    density = F.exp(-z * z / 2) / F.lit(2.5066282746310002)
    far = density / (z + 1 / (z + 2 / (z + 3 / (z + 4))))
    near = 1 / (1 + F.exp(1.5976 * z + 0.070565992 * z * z * z))
    return F.when(z > 30, F.lit(float(BINS))).otherwise(-F.log10(F.when(z > 1, far).otherwise(near)))


def _p_bin(body: Column) -> Column:
    """The bin of a run's p-value; null if it fails a test or has no encoding."""
    plain = F.rtrim(body, F.lit("="))
    letters = F.lit(None).cast("string")
    for form, alphabet in reversed(ENCODINGS):
        letters = F.when(plain.rlike(form), F.lit(alphabet)).otherwise(letters)

    def tests(s: Column) -> Column:
        x, size, n = s["x"], s["size"].cast("double"), s["n"].cast("double")
        square = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda a, c: a + F.pow(F.size(F.filter(x, lambda d: d == c)).cast("double"), F.lit(2.0)))
        chi = (size / n * square - n - (size - 1)) / F.sqrt(2 * (size - 1))
        up = F.size(F.filter(x, lambda d: d * 2 >= size)).cast("double")
        pairs = F.arrays_zip(F.slice(x, F.lit(1), s["n"] - 1).alias("a"), F.slice(x, F.lit(2), s["n"] - 1).alias("b"))
        turns = 1 + F.size(F.filter(pairs, lambda p: (p["a"] * 2 >= size) != (p["b"] * 2 >= size)))
        mean = 2 * up * (n - up) / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        runs = F.when(spread > 0, (turns - mean) / F.sqrt(spread)).otherwise(F.lit(99.0))
        middle = F.aggregate(x, F.lit(0.0), lambda a, d: a + d) / n
        around = F.aggregate(x, F.lit(0.0), lambda a, d: a + (d - middle) * (d - middle))
        serial = F.when(around > 0, (F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - middle) * (p["b"] - middle)) / around + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0))
        two = F.greatest(F.lit(PAIR), 2 / size)
        three = F.greatest(F.lit(TRIPLE), 1.28 * two * two)
        variance = 2 * n * (n - 1) * two * (1 - two) + 4 * n * (n - 1) * (n - 2) * (three - two * two)
        natural = (n * (n - 1) * two - (square - n)) / F.sqrt(variance)
        passed = (chi <= REJECT) & (F.abs(runs) <= REJECT) & (F.abs(serial) <= REJECT)
        return F.when(passed, F.least(F.lit(BINS), F.greatest(F.lit(0), F.floor(10 * _tail(natural)).cast("int"))))

    numbers = lambda a: F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: F.call_function("instr", a, c) - 1)
    return _let(letters, lambda a: F.when(a.isNotNull(), _let(
        F.struct(numbers(a).alias("x"), F.length(a).alias("size"), F.length(plain).alias("n")), tests)))


def _runs(text: Column) -> Column:
    """Candidates of the battery: ``start, end, class`` (of length), ``bin``."""
    def row(x: Column) -> Column:
        width = F.least(F.lit(24), F.floor(4 * (F.log2(F.length(x["body"])) - 4)).cast("int"))
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), width.alias("class"), _p_bin(x["body"]).alias("bin"))

    return F.transform(_found(text, RUN), row)


def _thresholds(texts: DataFrame) -> DataFrame:
    """One row: the least bin that is a discovery, by class of length."""
    runs = texts.select(F.explode(_runs(F.col("text"))).alias("r")).select("r.class", F.coalesce("r.bin", F.lit(-1)).alias("bin"))
    counts = runs.groupBy("class", "bin").agg(F.count("*").alias("n"))  # at most classes x bins rows
    down = Window.partitionBy("class").orderBy(F.desc("bin"))
    steps = counts.withColumns({"found": F.sum("n").over(down), "all": F.sum("n").over(Window.partitionBy("class"))})
    good = steps.where((F.col("bin") >= 0) & (F.pow(F.lit(10.0), -F.col("bin") / 10) * F.col("all") <= RATE * F.col("found")))
    least = good.groupBy("class").agg(F.min("bin").alias("least"))
    return least.agg(F.map_from_entries(F.collect_list(F.struct("class", "least"))).alias("_least"))


def scan(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text, base, spans`` for each row of ``docs``: the row
    itself, and the spans of the fixed forms and of all kinds, as
    ``array<struct<start, kind, end>>`` in order."""
    src = boxed(docs).withColumn("text", F.coalesce("text", F.lit("")))
    text = F.col("text")
    least = F.broadcast(_thresholds(src.select("text")))  # one row of at most 25 entries
    valued = lambda x: F.length(F.regexp_extract(x["body"], ASSIGN, 1)) >= ASSIGN_LEAST
    base = F.concat(_as_spans(F.filter(_found(text, ASSIGN), valued), 0),
                    F.when(F.contains(text, F.lit("AKIA")), _as_spans(_found(text, ACCESS), 1)).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>")),
                    _as_spans(_found(text, HEX), 2))
    random = F.filter(_runs(text), lambda r: r["bin"] >= F.try_element_at("_least", r["class"]))
    out = src.crossJoin(least).withColumns({"base": F.sort_array(base), "random": _as_spans(random, 3)})
    return out.withColumn("spans", F.sort_array(F.concat("base", "random"))).drop("random", "_least")


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random``."""
    found = scan(docs.select("doc_id", "text"))
    count = lambda k, c: F.size(F.filter(c, lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0, "base").alias("n_assign"), count(1, "base").alias("n_access"), count(2, "base").alias("n_hex"),
                        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
                        count(3, "spans").alias("n_random"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark``, overlapping
    ones as one, and the new length in ``n_chars``."""
    found, text = scan(docs), F.col("text")
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, s: Column) -> Column:
        before = F.concat(F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit(mark))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= done["at"], F.concat(done["parts"], F.array(before))).otherwise(done["parts"]).alias("parts"))

    whole = lambda d: F.concat(F.array_join(d["parts"], ""), F.substring(text, d["at"] + 1, F.length(text)))
    clean = F.when(F.size("spans") == 0, text).otherwise(F.aggregate("spans", empty, step, whole))
    return unboxed(found.select("row", clean.alias("text")), docs, F.col("text"))
