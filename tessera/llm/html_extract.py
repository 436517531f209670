"""Main text of pages, with boilerplate found by a suffix array per host.

Markup decides where it can. Scripts, styles, forms, menus, headers, footers,
sidebars, notices, adverts and reader comments are left out by element, role,
class or id; if a page marks its article (``article``, else ``main``), the
text is what remains of it.

On pages that mark none, the blocks left are *open*. For hosts with such
pages the token streams of open blocks and of what markup left out are
concatenated, a suffix array sorts them, and tokens covered by a substring of
at least `LEAST` tokens that also occurs on another page of the host are
boilerplate; the unique runs of the open blocks are kept. A host's pages are
dealt into groups of about `GROUP_BYTES`, so that a host with a third of all
pages is not one task. Tokens covered by such substrings are those covered by
runs of `LEAST` tokens that two pages have, so the runs of a dealt host's groups
are compared by hash across groups, and what repeats there is marked as well.

A marked article is not cut by repetition: on a host, passages that several
articles quote are text, not boilerplate.

Cases: null or empty html has the empty text. Rows that repeat are extracted
each (a repeat is no other page: it has the same html). Pages without a host
form one host. A page cut off in the middle ends there; an unfinished tag is
no text.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .link_graph import host_and_path
from .ngram_join import _mix

LEAST = 6  # tokens of a repeated substring
GROUP_BYTES = 8 << 20

# Elements and names by the part they play.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "audio", "video", "select", "button", "datalist"}
LEFT_OUT = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "fieldset"}
OUTSIDE_ONLY = {"header"}  # a page's header is left out, an article's own is text
BLOCKS = {"address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3",
          "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
          "th", "thead", "tr", "ul"} | LEFT_OUT
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent",
         "cookie", "cookies", "disqus", "footer", "gdpr", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination",
         "popup", "promo", "promotion", "related", "reply", "respond", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar"}
NAMES_OUTSIDE = {"header", "masthead", "topbar"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)")
_NAME = re.compile(r"[A-Za-z0-9]+")


def _attributes(text: str) -> dict[str, str]:
    return {(m[1] or m[5]).lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in reversed(list(_ATTR.finditer(text)))}


def _part(tag: str, text: str, inside: bool) -> bool:
    """Whether an element is left out with all that it holds."""
    if tag in LEFT_OUT or tag in OUTSIDE_ONLY and not inside:
        return True
    if not text.strip() or tag in ("body", "html", "main"):
        return False
    a = _attributes(text)
    if "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I):
        return True
    if a.get("role", "").lower() in ROLES:
        return True
    if tag == "article":  # its classes also tell what it is about: only whole names count
        return bool({*a.get("class", "").lower().split(), a.get("id", "").lower()} & NAMES)
    names = {n.lower() for key in ("class", "id") for n in _NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", a.get(key, "")))}
    return bool(names & NAMES) or not inside and bool(names & NAMES_OUTSIDE)


def blocks(page: str | None) -> Iterator[tuple[str, str]]:
    """The blocks of a page in order: ``place, text``; the place is
    ``article``, ``main``, ``open`` or ``out``."""
    page = page or ""
    stack: list[tuple[str, str, int]] = []  # containers that matter: element, what it does, open elements of its name
    words: list[str] = []
    at, end = 0, len(page)

    def place() -> str:
        kinds = {kind for _, kind, _ in stack}
        return "out" if "out" in kinds else "article" if "article" in kinds else "main" if "main" in kinds else "open"

    now = "open"

    def flush():
        text = " ".join(entities.unescape("".join(words)).split())
        words.clear()
        return text

    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            words.append(page[at:])
            break
        words.append(page[at:m.start()])
        at = m.end()
        if m[0].startswith("<![CDATA["):
            continue
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, rest = m[1] or m[4], m[3] if m[2] else m[6]
        if not m[0].endswith(">"):
            break  # the page ends in a tag
        if tag in RAW and not closing:
            if not rest.rstrip().endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(page, at)
                at = close.end() if close else end
            continue
        if tag == "br":
            words.append(" ")
            continue
        if tag in BLOCKS:
            if text := flush():
                yield now, text
        if tag in VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                name, kind, depth = stack[i]
                if name == tag:
                    if depth:
                        stack[i] = name, kind, depth - 1
                    else:
                        if tag not in BLOCKS and (text := flush()):
                            yield now, text
                        del stack[i:]
                    break
        else:
            kind = None
            if now != "out":
                inside = now in ("article", "main")
                if _part(tag, rest, inside):
                    kind = "out"
                elif tag == "article":
                    kind = "article"
                elif tag == "main" or 'role="main"' in rest:
                    kind = "main"
            if kind:
                if tag not in BLOCKS and (text := flush()):
                    yield now, text
                stack.append((tag, kind, 0))
            else:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        name, kind, depth = stack[i]
                        stack[i] = name, kind, depth + 1
                        break
        now = place()
    if text := flush():
        yield now, text


def marked(found: list[tuple[str, str]]) -> list[str] | None:
    """The blocks of the article that the page marks, if it does."""
    for place in ("article", "main"):
        if any(p == place for p, _ in found):
            return [t for p, t in found if p in (place, "article")]
    return None


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes of a token stream, and the length that each
    shares with the one before it in that order."""
    n = len(s)
    rank = np.unique(s, return_inverse=True)[1].astype(np.int64)
    size, order = 1, np.argsort(rank, kind="stable")
    while size < n:
        behind = np.full(n, -1, np.int64)
        behind[: n - size] = rank[size:]
        order = np.lexsort((behind, rank))
        first, second = rank[order], behind[order]
        rank_new = np.empty(n, np.int64)
        rank_new[order] = np.cumsum(np.concatenate([[0], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
        rank = rank_new
        if rank.max() == n - 1:
            break
        size *= 2
    shared, k = np.zeros(n, np.int64), 0  # Kasai's walk in the order of the text
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    for i in range(n):
        if where[i]:
            j = order[where[i] - 1]
            while i + k < n and j + k < n and s[i + k] == s[j + k]:
                k += 1
            shared[where[i]] = k
            k = max(0, k - 1)
        else:
            k = 0
    return order, shared


def repeated(streams: list[list[str]], least: int = LEAST) -> list[np.ndarray]:
    """For each page's tokens, which lie in a substring of at least ``least``
    tokens that occurs on another page too."""
    number: dict[str, int] = {}
    parts, owner = [], []
    for page, tokens in enumerate(streams):
        parts.append(np.array([number.setdefault(t, len(number)) for t in tokens] + [-1 - page], np.int64))
        owner.append(np.full(len(tokens) + 1, page))
    s, page_of = np.concatenate(parts), np.concatenate(owner)
    order, shared = suffix_array(s)
    n = len(s)
    reach = np.zeros(n, np.int64)  # longest substring from here that another page has too
    for step in (range(n), range(n - 1, -1, -1)):
        other, length, last = -1, 0, -1  # the nearest page before, what is shared with it, with the nearest other than it
        best_other = 0
        before = -1
        for k in step:
            i = order[k]
            link = shared[k] if step.step == 1 else (shared[k + 1] if k + 1 < n else 0)
            length, best_other = min(length, link), min(best_other, link)
            page = page_of[i]
            if before >= 0:
                got = length if last != page else best_other
                if got > reach[i]:
                    reach[i] = got
                if last != page:
                    best_other = length
            length, last, before = n, page, i
    covered = np.zeros(n + 1, np.int64)
    hit = reach >= least
    np.add.at(covered, np.flatnonzero(hit), 1)
    np.add.at(covered, np.minimum(np.flatnonzero(hit) + reach[hit], n), -1)
    inside = np.cumsum(covered)[:n] > 0
    ends = np.cumsum([len(p) for p in parts])
    return [inside[e - len(p):e - 1] for e, p in zip(ends, parts)]


def _texts(batches):
    """Pages whose article is marked, and pages that have no block."""
    for batch in batches:
        rows = []
        for i, page in enumerate(batch.column("html").to_pylist()):
            found = list(blocks(page))
            text = marked(found)
            if text is None and not any(p == "open" for p, _ in found):
                text = []
            if text is not None:
                rows.append((i, "\n\n".join(text)))
        at = pa.array([i for i, _ in rows], pa.int64())
        text = [t for _, t in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").take(at), batch.column("url").take(at), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def _streams(batches):
    """Every page's blocks outside a marked article; ``open`` are undecided."""
    for batch in batches:
        rows = []
        for i, page in enumerate(batch.column("html").to_pylist()):
            found = list(blocks(page))
            undecided = marked(found) is None and any(p == "open" for p, _ in found)
            rest = [(p == "open" and undecided, t) for p, t in found if p in ("open", "out")]
            rows.append((undecided, [o for o, _ in rest], [t for _, t in rest]))
        u, o, t = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(u, pa.bool_()),
                                          pa.array(o, pa.list_(pa.bool_())), pa.array(t, pa.list_(pa.string()))],
                                         names=["page_id", "url", "host", "undecided", "open", "blocks"])


def _runs(tokens: list[str], least: int, hashes: dict[str, int]) -> np.ndarray:
    """Hash of the ``least`` tokens from each place on."""
    n = max(0, len(tokens) - least + 1)
    for t in tokens:
        if t not in hashes:
            hashes[t] = int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
    h, total = np.array([hashes[t] for t in tokens], np.uint64), np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(least):
            total += h[j:j + n] * np.uint64(pow(0xC2B2AE3D27D4EB4F, j + 1, 1 << 64))
        return _mix(total).view(np.int64)


def _group_runs(least: int):
    """The different runs of a group, with the smallest and largest mark of its pages that have it."""
    def run(pdf):
        import pandas as pd

        pages, hashes = pdf.drop_duplicates("mark"), {}
        found = [np.unique(_runs([w for t in b for w in t.split()], least, hashes)) for b in pages.blocks]
        rows = pd.DataFrame({"run": np.concatenate(found), "mark": np.repeat(pages["mark"].to_numpy(), [len(f) for f in found])})
        rows = rows.groupby("run", as_index=False)["mark"].agg(lo="min", hi="max")
        return rows.assign(host=pdf.host.iloc[0], part=pdf.part.iloc[0])[["host", "part", "run", "lo", "hi"]]

    return run


def _unique_runs(least: int):
    def run(pdf, far):
        import pandas as pd

        same: dict[tuple, int] = {}
        first = [same.setdefault((tuple(o), tuple(b)), i) for i, (o, b) in enumerate(zip(pdf.open, pdf.blocks))]
        streams = [[w for t in b for w in t.split()] if first[i] == i else [] for i, b in enumerate(pdf.blocks)]
        marks = repeated(streams, least)
        if len(far):  # runs that pages of other groups have too
            hashes: dict[str, int] = {}
            for tokens, hit in zip(streams, marks):
                for at in np.flatnonzero(np.isin(_runs(tokens, least, hashes), far["run"].to_numpy())):
                    hit[at:at + least] = True
        out = []
        for i, (page, url, undecided, opened, texts) in enumerate(zip(pdf.page_id, pdf.url, pdf.undecided, pdf.open, pdf.blocks)):
            if not undecided:
                continue
            at, kept = 0, []
            for is_open, text in zip(opened, texts):
                words = text.split()
                hit = marks[first[i]][at:at + len(words)]
                at += len(words)
                if is_open and not hit.all():
                    kept.append(" ".join(w for w, h in zip(words, hit) if not h))
            text = "\n\n".join(kept)
            out.append((page, url, text, len(text)))
        return pd.DataFrame(out, columns=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``."""
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = "page_id long, url string, text string, n_chars long"
    decided = src.mapInArrow(_texts, kind)

    host, _ = host_and_path(F.col("url"))
    streams = src.select("page_id", "url", host.alias("host"), "html").mapInArrow(
        _streams, "page_id long, url string, host string, undecided boolean, open array<boolean>, blocks array<string>")
    streams = cut(streams.where("size(blocks) > 0"))
    hosts = streams.groupBy("host").agg(F.max("undecided").alias("any"), F.sum(F.length(F.array_join("blocks", " "))).alias("bytes"))
    hosts = cut(hosts.where("any").select("host", F.ceil(F.col("bytes") / F.lit(GROUP_BYTES)).alias("parts")))
    rows = streams.join(hosts, "host").withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.col("parts")))
    runs = rows.where("parts > 1").withColumn("mark", F.xxhash64("open", "blocks")).select("host", "part", "mark", "blocks")
    runs = cut(runs.groupBy("host", "part").applyInPandas(_group_runs(least), "host string, part long, run long, lo long, hi long"))
    across = runs.groupBy("host", "run").agg(F.count("*").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("n > 1 and lo < hi")
    far = runs.join(across, ["host", "run"], "left_semi").select("host", "part", "run")
    open_pages = rows.groupBy("host", "part").cogroup(far.groupBy("host", "part")).applyInPandas(_unique_runs(least), kind)
    return decided.unionByName(open_pages)
