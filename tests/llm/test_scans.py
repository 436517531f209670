"""Secret scan, fingerprints, pages, urls and quality on small fixtures."""

import collections
import hashlib
import math
import random
import re
import time

import duckdb
import numpy as np
import pytest

from tessera.llm import html_extract, link_graph, quality, secret_scan, winnow

FORM = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in FORM.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


@pytest.fixture(scope="module")
def secrets():
    rng = random.Random(8)
    bits = ["token", "secret", "PassWd", "api_key", "apikey", "=", ": ", " ", '"', "'", "é", "\U0001f600", "AKIA", "AKIAQQ", "ab" * 13, "0f" * 6, "x", "\n", "ABCDEFGH23456789", "ſecret"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 40)))) for i in range(300)]
    return rows + [(300, None), (301, ""), (302, "secret=token: abcdefgh"), (303, "token=" + "a1b2c3 token=" * 3000), (304, "plain words only. " * 5000), (304, "token=abcdef")]


def test_fixed_forms(docs, secrets):
    got = secret_scan.report(docs([*secrets, (None, "token=abcdef")])).collect()
    want = []
    for i, t in [*secrets, (None, "token=abcdef")]:
        spans = base_spans(t or "")
        listed = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want.append((i, *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(listed.encode()).hexdigest()))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    assert secret_scan.report(docs([])).count() == 0


def test_battery_adds_random_runs_only(docs):
    rng = random.Random(1)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = {i: "".join(rng.choice(letters) for _ in range(64)) for i in range(30)}
    rows = [(i, f"see {k} here") for i, k in keys.items()]
    rows += [(100 + i, "thisisaverylongwordmadeofwordsandmorewords the_name_of_a_variable_in_a_program 12345678901234567890123 xyxyxyxyxyxyxyxyxyxyxyxyxyxy") for i in range(30)]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.report(docs(rows)).collect()}
    assert sum(got[i] == "random:4:68" for i in keys) >= 27
    assert all(got[100 + i] == "" for i in range(30))


def battery(body):
    """The tests on one run in plain Python: -log10 p in tenths, or None if it
    fails one; the margin is how near a test came to the other answer."""
    plain = body.rstrip("=")
    alphabet = next(a for form, a in secret_scan.ENCODINGS if re.search(form, plain))
    if alphabet is None:
        return None, 9.0
    n, k, x = len(plain), len(alphabet), [alphabet.index(c) for c in plain]
    counts = collections.Counter(x)
    square = sum(c * c for c in counts.values())
    chi = (sum((counts.get(i, 0) - n / k) ** 2 / (n / k) for i in range(k)) - (k - 1)) / math.sqrt(2 * (k - 1))
    above = [2 * v >= k for v in x]
    up = sum(above)
    mean = 2 * up * (n - up) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    runs = (1 + sum(u != v for u, v in zip(above, above[1:])) - mean) / math.sqrt(spread) if spread > 0 else 99.0
    middle = sum(x) / n
    around = sum((v - middle) ** 2 for v in x)
    serial = (sum((u - middle) * (v - middle) for u, v in zip(x, x[1:])) / around + 1 / n) * math.sqrt(n) if around else 99.0
    margin = min(abs(secret_scan.REJECT - t) for t in (chi, abs(runs), abs(serial)))
    if chi > secret_scan.REJECT or abs(runs) > secret_scan.REJECT or abs(serial) > secret_scan.REJECT:
        return None, margin
    two = max(secret_scan.PAIR, 2 / k)
    three = max(secret_scan.TRIPLE, 1.28 * two * two)
    variance = 2 * n * (n - 1) * two * (1 - two) + 4 * n * (n - 1) * (n - 2) * (three - two * two)
    z = (n * (n - 1) * two - (square - n)) / math.sqrt(variance)
    p = math.erfc(z / math.sqrt(2)) / 2
    return min(secret_scan.BINS, max(0, math.floor(-10 * math.log10(p)) if p > 0 else secret_scan.BINS)), margin


def test_battery_and_thresholds_of_plain_python(spark):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    kinds = ["0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "eeeeaaiottnnssrrhldcumfpg"]
    bodies = []
    for _ in range(400):
        letters = rng.choice(kinds)
        body = [rng.choice(letters) for _ in range(rng.randint(20, 120))]
        if rng.random() < 0.3:  # neighbours alike
            body = [c for c in body for _ in range(rng.randint(1, 3))]
        if rng.random() < 0.2:
            body.sort()
        bodies.append("".join(body) + "=" * rng.choice([0, 0, 1, 2]))
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, text string")
    runs = df.select("i", "text", F.explode(secret_scan._runs(F.col("text"))).alias("r")).select("i", "text", "r.*").collect()
    assert len(runs) == len(bodies)
    passed = 0
    for r in runs:
        want, margin = battery(r["text"])
        if margin > 1e-9:
            assert (r["bin"] is None) == (want is None), r
        if want is not None and r["bin"] is not None:
            passed += 1
            assert abs(r["bin"] - want) <= 1, (r, want)
    assert 50 < passed < len(bodies)
    # Benjamini-Hochberg in each class, from the bins
    least = secret_scan._thresholds(df).first()["_least"]
    by_class = collections.defaultdict(list)
    for r in runs:
        by_class[r["class"]].append(-1 if r["bin"] is None else r["bin"])
    for c, bins in by_class.items():
        good = [b for b in set(bins) if b >= 0 and 10 ** (-b / 10) * len(bins) <= secret_scan.RATE * sum(x >= b for x in bins)]
        assert least.get(c) == (min(good) if good else None)


def test_redaction(docs, secrets):
    df = docs(secrets)
    out = secret_scan.redact(df)
    assert out.columns == df.columns
    for r in out.where("doc_id < 304").collect():
        text, at, want = dict(secrets)[r["doc_id"]] or "", 0, ""
        for a, _, b in base_spans(text):
            if a >= at:
                want += text[at:a] + "[secret]"
            at = max(at, b)
        assert r["text"] == want + text[at:] and r["n_chars"] == len(r["text"])


def brute_winnow(text, k, window):
    k = min(k, len(text))
    if not text:
        return []

    def gram(part):
        h = 0
        for c in part:
            h = (h * winnow.BASE + ord(c) + 1) & winnow.MASK
        h = (h ^ (h >> 33)) * 0xFF51AFD7ED558CCD & winnow.MASK
        return h ^ (h >> 29)

    hashes = [gram(text[i:i + k]) for i in range(len(text) - k + 1)]
    w = min(window, len(hashes))
    chosen = {max(j for j in range(i, i + w) if hashes[j] == min(hashes[i:i + w])) for i in range(len(hashes) - w + 1)}
    return [(j, hashes[j]) for j in sorted(chosen)]


@pytest.mark.parametrize("k,window", [(5, 4), (1, 1), (7, 13), (16, 16)])
def test_winnowing_chooses_the_rightmost_minimum(k, window):
    rng = random.Random(k)
    for text in ["", "a", "abc", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "é\U0001f600" * 30] + ["".join(rng.choice("ab") for _ in range(rng.randrange(90))) for _ in range(60)]:
        at, h = winnow.winnow(text, k, window)
        assert [(int(a), int(b)) for a, b in zip(at, h)] == brute_winnow(text, k, window)


def test_edit_trial(docs):
    rng = random.Random(3)
    rows = [(7 * i, "".join(rng.choice("abcdé ") for _ in range(rng.randrange(300)))) for i in range(150)] + [(2000, None), (2001, "x" * 200_000), (2002, "tail")]
    rng.shuffle(rows)
    order = sorted((i, t or "") for i, t in rows)
    got = {r["doc_id"]: r for r in winnow.edit_trial(docs(rows).repartition(7), buckets=9).collect()}
    assert len(got) == len(rows)
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == winnow.digest(*winnow.winnow(t)) and r["edited_fingerprint"] == winnow.digest(*winnow.winnow(edited))
    assert got[2000]["near_edited"] == 1.0 and got[2000]["near_next"] == 0.0


def test_edit_trial_of_few_rows(docs):
    assert winnow.edit_trial(docs([])).count() == 0
    (one,) = winnow.edit_trial(docs([(5, "abcd")])).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    got = winnow.edit_trial(docs([(None, "ab"), (5, "cd"), (5, "ce")]), buckets=3).collect()
    assert sorted((str(r["doc_id"]), r["edited_sha256"]) for r in got) == sorted(
        (str(i), hashlib.sha256(e).hexdigest()) for i, e in ((None, b"ac"), (5, b"cc"), (5, b"ca")))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="social"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="ad">Buy</div><aside>Side</aside><article class="post comments-open"><header><h1>Head &amp; line</h1></header><p>One <b>bold<br>two&nbsp;&lt;x&gt; 3 < 4<p>Three<!-- p --><script>var p="</p>";</script>
<form>Name <input></form><div class="share-buttons">Share</div><div hidden>no</div><ul><li>a<li>b</ul><footer>By me</footer></article><section id="comments"><article>Nice!</article></section><footer>&copy;</footer>"""


def test_marked_articles():
    assert html_extract.marked(list(html_extract.blocks(PAGE))) == ["Head & line", "One bold two <x> 3 < 4", "Three", "a", "b"]
    assert html_extract.marked(list(html_extract.blocks("<main><p>x</p></main>y"))) == ["x"]
    assert list(html_extract.blocks(None)) == [] and list(html_extract.blocks("a <b")) == [("open", "a")]


def test_suffix_array_and_repeats():
    rng = random.Random(5)
    for _ in range(40):
        pages = [[rng.choice("abc") for _ in range(rng.randrange(25))] for _ in range(4)]
        for page, marks in enumerate(html_extract.repeated(pages, 3)):
            others = {tuple(p[i:i + 3]) for j, p in enumerate(pages) if j != page for i in range(len(p) - 2)}
            own = pages[page]
            want = [any(tuple(own[k:k + 3]) in others for k in range(max(0, i - 2), i + 1) if k + 3 <= len(own)) for i in range(len(own))]
            assert marks.tolist() == want


def test_extraction(spark):
    menu = "<div>Home About Contact Imprint Help Login</div>"
    rows = [(1, "http://a.b/1", PAGE), (2, "http://h.x/1", f"<p>first own text</p>{menu}"), (3, "http://h.x/2", f"{menu}<p>second &amp; own text</p>"),
            (3, "http://h.x/2", f"{menu}<p>second &amp; own text</p>"), (4, None, None), (5, "u", ""), (None, "http://h.x/9", "<p>third</p><nav>x</nav>"), (6, "http://q/", "<nav>only menu</nav>")]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = [(1, "Head & line\n\nOne bold two <x> 3 < 4\n\nThree\n\na\n\nb"), (2, "first own text"), (3, "second & own text"), (3, "second & own text"),
            (4, ""), (5, ""), (6, ""), (None, "third")]
    assert sorted(((r["page_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_rules_and_propagation(spark):
    link = lambda *hosts: "".join(f'<a class=x href="https://{h}/p">t</a>' for h in hosts)
    rows = [(1, "http://good.com/a", link("friend.org", "FRIEND.org", "good.com")), (2, "http://friend.org/", link("far.org")), (3, "http://far.org/?q", ""),
            (4, "http://bad.net/es/1", ""), (5, "http://shill.org/x", link("bad.net")), (6, "http://shill.org", link("bad.net")), (7, "http://lone.org/", None),
            (8, None, None), (9, "no scheme", ""), (10, "HTTP://WWW.Example.COM/en/x?y#z", ""), (11, "http://a.example.com/en/", ""), (12, "http://net/fr/", ""), (13, "http://evilcom/", ""),
            (1, "http://good.com/a", "")]
    got = {r["page_id"]: r for r in link_graph.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {i: r["verdict"] for i, r in got.items()} == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "block", 7: "allow", 8: "allow", 9: "allow",
                                                        10: "allow", 11: "block", 12: "block", 13: "allow"}
    assert [got[i]["rule"] for i in (1, 3, 4, 8, 10, 11, 12, 13)] == ["com/", None, "net/es/", None, "www.example.com/en/", "example.com/en/", "net/fr/", None]
    assert (got[10]["host"], got[10]["path"], got[8]["host"], got[9]["path"]) == ("www.example.com", "/en/x", "", "")
    # the ranks of plain power iteration
    seeds = {"good.com": 2 / 3, "www.example.com": 1 / 3}
    rank = power({"good.com": {"friend.org": 1.0}, "friend.org": {"far.org": 1.0}}, seeds)
    assert all(abs(got[i]["trust"] - rank[h]) < 1e-6 for i, h in ((1, "good.com"), (2, "friend.org"), (3, "far.org")))
    assert link_graph.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def power(out, seeds):
    rank = dict(seeds)
    for _ in range(200):
        flow = {}
        for h, r in rank.items():
            for d, s in out.get(h, {}).items():
                flow[d] = flow.get(d, 0) + 0.85 * r * s
        rest = 1 - sum(flow.values())
        rank = {h: flow.get(h, 0) + rest * seeds.get(h, 0) for h in {*flow, *seeds}}
    return rank


def test_seeds_are_weighed_among_pages_under_rules(spark):
    """Hosts with mixed pages, links in circles, extra columns of clashing names."""
    rng = random.Random(9)
    hosts = ["a.com", "b.com", "mix.net", "kept.net", "free.org", "ring.org", "far.org"]
    rows, links = [], {}
    for n in range(60):
        host = rng.choice(hosts)
        to = [h for h in hosts if rng.random() < 0.25]
        path = rng.choice(["/es/x", "/x", "/x"]) if host == "mix.net" else rng.choice(["/x", "/de/y"])
        rows.append((n, f"https://{host}{path}", "".join(f"<a href=//{h}/p>" for h in to), "clash", 1.0))
        for h in to:
            if h != host:
                links[host, h] = links.get((host, h), 0) + 1
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, rank double")
    got = link_graph.judge(df).collect()
    ruled = {h: [r["verdict"] for r in got if r["host"] == h and r["rule"]] for h in hosts}
    assert "block" in ruled["mix.net"] and not ruled["kept.net"]

    def seeds(kind):
        w = {h: len(v) for h, v in ruled.items() if v and 2 * v.count(kind) > len(v)}
        return {h: n / sum(w.values()) for h, n in w.items()}

    def shares(turn):
        out = {}
        for (a, b), n in links.items():
            a, b = (b, a) if turn else (a, b)
            out.setdefault(a, {})[b] = n
        return {a: {b: n / sum(d.values()) for b, n in d.items()} for a, d in out.items()}

    trust, distrust = power(shares(False), seeds("allow")), power(shares(True), seeds("block"))
    for r in got:
        assert abs(r["trust"] - trust.get(r["host"], 0)) < 1e-6 and abs(r["distrust"] - distrust.get(r["host"], 0)) < 1e-6
        if not r["rule"]:
            want = "block" if distrust.get(r["host"], 0) >= trust.get(r["host"], 0) and r["distrust"] else "allow"
            assert r["verdict"] == want
    assert {r["verdict"] for r in got if r["host"] == "mix.net" and not r["rule"]} == {"block"}


def test_unclosed_tags_are_read_once(spark):
    html = "<a " * 40_000 + '<a href="//x.org/">'
    df = spark.createDataFrame([(1, "http://a.com/", html), (2, "http://x.org/", "")], "page_id long, url string, html string")
    start = time.time()
    got = {r["page_id"]: r["trust"] for r in link_graph.judge(df).collect()}
    assert got[2] > 0 and time.time() - start < 60


def test_quality_against_held_out_labels(spark):
    """The labels take no part in fitting."""
    sf = "/root/testdata/sf0.01"
    kept = {r["doc_id"]: r["keep"] for r in quality.report(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    labels = duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall()
    junk, good = [kept[i] for i, q in labels if not q], [kept[i] for i, q in labels if q]
    assert sum(junk) <= 0.1 * len(junk) and sum(good) >= 0.99 * len(good)


def test_quality_cases(docs):
    text = "The quick brown fox jumps over the lazy dog. It was a sunny day, and nobody was in a hurry at all. " * 5
    junk = "BUY!!! NOW!!! $$$ ### CHEAP@@@ *** !!! " * 20
    df = docs([(i, text + str(i)) for i in range(40)] + [(100 + i, junk + str(i)) for i in range(10)] + [(200, None), (201, " \n"), (None, text), (5, text + "5"), (202, "word " * 200_000)])
    got = {(r["doc_id"], r["keep"]) for r in quality.report(df).collect()}
    assert {(i, True) for i in range(40)} | {(None, True), (200, False), (201, False)} | {(100 + i, False) for i in range(10)} <= got
    kept = quality.keep(df)
    assert kept.columns == df.columns and kept.where("doc_id = 5").count() == 2
    assert quality.report(docs([])).count() == 0


def test_accuracies_of_known_heuristics():
    """Two kinds of junk, heuristics that err and abstain."""
    rng = random.Random(2)
    wrong, counts, truth = 0.02, {}, {}
    for _ in range(20000):
        kind = rng.choice([None] * 7 + [0, 1, 2])
        seen = {0: ("symbols", "decorated"), 1: ("capitals",), 2: ("echoes", "variety")}.get(kind, ())
        votes = []
        for h in quality.HEURISTICS:
            junk = (h in seen) != (rng.random() < wrong)
            votes.append(quality.NONE if rng.random() < 0.1 else quality.JUNK if junk else quality.GOOD)
        p = sum(v * 3 ** i for i, v in enumerate(votes))
        counts[p] = counts.get(p, 0) + 1
        truth[p] = truth.get(p, 0) + (kind is None)
    prior, table = quality.accuracies(counts)
    assert abs(prior[0] - 0.7) < 0.1 and table[0, :, quality.JUNK].max() < 0.06
    weak = quality.posteriors(counts)
    right = sum(truth[p] if weak[p] >= 0.5 else n - truth[p] for p, n in counts.items())
    assert right > 0.9 * 20000
    assert quality.posteriors({}) == {}


def test_html_boilerplate_on_two_pages_of_a_dealt_host(spark, monkeypatch):
    body = [" ".join(f"p{i}x{j}" for j in range(40)) for i in range(40)]
    passage = "seen on two pages of this host only"
    body[3], body[29] = f"{body[3]} {passage}", f"{passage} {body[29]}"
    rows = [(i, f"http://h.example/{i}", f"<html><body><p>{b}</p></body></html>") for i, b in enumerate(body)]
    rows.append((40, "http://h.example/again", rows[5][2]))  # a repeat is no other page
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: b.replace(passage, "").strip() for i, b in enumerate(body)} | {40: body[5]}
    for size in (html_extract.GROUP_BYTES, 300):
        monkeypatch.setattr(html_extract, "GROUP_BYTES", size)
        assert {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()} == want


def test_the_fit_makes_no_second_matrix():
    import tracemalloc

    x = np.random.default_rng(0).random((2000, 1000))
    good = (x[:, 0] > 0.5).astype(float)
    tracemalloc.start()
    w, b = quality.fit(x, good, rounds=3)
    assert tracemalloc.get_traced_memory()[1] < x.nbytes / 2
    tracemalloc.stop()
    ahead, step = np.zeros(1000), 1 / (0.25 * ((x * x).sum(axis=1).max() + 1) + 1e-3)
    one, _ = quality.fit(x, good, rounds=1)
    assert np.array_equal(one, ahead - step * (x.T @ (0.5 - good) / len(x) + 1e-3 * ahead))
