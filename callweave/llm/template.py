"""Main text of web pages by deducing the template of each host.

Tokens of a page are its element paths (tag and first class, from the root)
and its text blocks. A token's occurrence vector over the host's distinct
pages is held as its number of pages and two sums of hashed (page, count)
pairs, so it forms by partial aggregation and no task sees a host. Tokens
with equal vectors form an equivalence class; a class of at least
``CLASS_TOKENS`` tokens on at least ``SUPPORT`` of ``PAGES`` or more pages is
valid. The paths of the valid classes nest into the template, one below the
other as on the pages; their text blocks are constant text. The text of a
block belongs to the slot of the deepest template path around it. A slot
whose text is all constant is part of the template; one whose other text is by
more than half of its words linked, over all pages of the host, is navigation
(an ``h1`` of an article or main is not); the others are free.

A page gives the blocks of its host's free slots, in page order, without excluded
regions (``DROP_TAGS``, ``DROP_ROLES``, ``DROP_NAMES``) and without constant
text. ``article`` and ``main`` elements decide only where the template does
not: on a page without a template, or for a slot that holds the page's
article and other text too; there, what lies outside the article gives no
text, and without an article the slots are the element paths of the page.
Constant text in a free slot inside an article goes
only where it is no paragraph, heading, item or quotation, and copies of one
page count once, so that repeated articles stay.

``DROP_NAMES`` are whole class or id names; of names of several words those
count that are made of ``DROP_HEADS`` and ``DROP_TAILS`` (comment-list,
ad-slot) or of ``DROP_OWNERS`` and ``DROP_THINGS`` (post-comments). They exclude no element that holds
the page's article or main or, over the host, ``MAIN_SHARE`` of the free
words, and ``header`` excludes nothing inside an article.

An excluded element that is never closed excludes nothing, but a script or
style that is never closed reaches to the end of the page. Null or empty
html: empty text. Null url: the pages without a host share one. Null
``page_id`` and repeated rows are kept. Other columns are not read.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.session import materialize

from .common import workers_import

CLASS_TOKENS = 2
SUPPORT = 0.6
PAGES = 8
CONSTANT_WORDS = 40
MAIN_SHARE = 0.6

SUMS = ("words", "linked", "hidden", "hidden_linked", "named")

# Element and attribute names of HTML.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROP_TAGS = frozenset("head title nav footer aside form button select textarea noscript template iframe object svg math canvas audio video menu dialog label input option datalist map".split())
MAIN_TAGS = frozenset("article main".split())
PROSE_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td dd".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
DROP_NAMES = re.compile(r"(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|topbar|footer|sidebar|aside|rail|ads?|advert\w*|adsbygoogle|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|popup|modal|overlay|alert|newsletter|subscribe|subscription|signup|login|comments?|commentlist|disqus|replies|respond|share|sharing|social|related|recommended|widget|pagination|pager|skip-link|toolbar|form|search)")

#: Names made of two or more words: what they begin with and what may follow, or what they are about and what it is.
DROP_HEADS = frozenset("comment comments commentlist reply replies ad ads advert adverts advertisement adsense sponsor sponsored promo cookie cookies consent gdpr privacy related recommended newsletter subscribe share sharing social disqus popup modal".split())
DROP_TAILS = frozenset("area list section box block slot unit banner bar posts post articles article links link buttons button icons widget wrap wrapper container form thread notice popup modal overlay signup body content contents text author item items holder space zone label top bottom left right inner outer tools news stories comment comments count title wide small large".split())
DROP_OWNERS = frozenset("post article entry page story user reader site blog".split())
DROP_THINGS = frozenset("comments replies share sharing social related ads nav navigation sidebar footer menu cookies newsletter".split())

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^<>]*)>")
_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in ("script", "style")}
_RAW_OPEN = re.compile(r"<(script|style)(?=[\s/>]|\Z)", re.I)
_ATTR = re.compile(r"([A-Za-z:_-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


@dataclass(slots=True)
class Block:
    text: str
    path: str
    paths: tuple[str, ...]
    tag: str
    dropped: bool
    main: str  # path of the outermost article or main around it, or empty
    linked: int
    named: tuple[str, ...]  # paths around it that DROP_NAMES tells of


def _attributes(s: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(s)} if "=" in s else {}


def _drops(tag: str, attrs: dict[str, str], raw: str) -> bool:
    if tag in DROP_TAGS or attrs.get("role", "").lower() in DROP_ROLES:
        return True
    if tag in ("html", "body") or tag in MAIN_TAGS:
        return False
    if tag in BLOCK_TAGS or tag in ("span", "a"):
        if re.search(r"\bhidden\b(?!=)", raw) and "aria-hidden" not in raw or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I):
            return True
    return False


def _named(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    if tag in ("html", "body") or tag in MAIN_TAGS or tag not in BLOCK_TAGS and tag not in ("span", "a"):
        return False
    for attribute in ("class", "id"):
        for name in attrs.get(attribute, "").lower().split():
            if DROP_NAMES.fullmatch(name) and not (in_main and name == "header"):
                return True
            head, *tail = re.split(r"[-_]+", name.strip("-_"))
            if tail and (head in DROP_HEADS and all(t in DROP_TAILS or t.isdigit() for t in tail) or len(tail) == 1 and head in DROP_OWNERS and tail[0] in DROP_THINGS):
                return True
    return False


def _tokens(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, tag, whether it closes, attributes) of the markup in order; comments, scripts and styles have
    no tag. One pass: where no closing mark lies ahead, nothing more is looked for. A script, style or comment
    that is never closed reaches to the end of the page, as in HTML."""
    at, n = 0, len(page)
    while True:
        at = page.find("<", at)
        if at < 0:
            return
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = n if end < 0 else end + 3
            yield at, end, "", False, ""
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at) + 1
            if not end:
                return
            yield at, end, "", False, ""
        elif raw := _RAW_OPEN.match(page, at):
            opened = page.find(">", at)
            closing = _RAW[raw[1].lower()].search(page, opened) if opened >= 0 else None
            end = closing.end() if closing else n
            yield at, end, "", False, ""
        elif m := _TAG.match(page, at):
            end = m.end()
            yield at, end, (m[2] or m[5]).lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        else:
            end = at + 1
        at = end


def blocks(page: str) -> tuple[list[Block], dict[str, int]]:
    """Text blocks in page order, and how often each element path occurs."""
    found, opened, closed = [], {}, {}
    for token in _tokens(page):
        found.append(token)
        tag, k = token[2], len(found) - 1
        if tag and tag not in VOID_TAGS:
            if not found[k][3]:
                opened.setdefault(tag, []).append(k)
            elif opened.get(tag):
                closed[opened[tag].pop()] = k
    ends = {v: k for k, v in closed.items()}
    mains = [k for k in closed if found[k][2] in MAIN_TAGS or "role" in found[k][4].lower() and _attributes(found[k][4]).get("role", "").lower() == "main"]
    articles = [k for k in mains if found[k][2] == "article"]
    widest = max((found[closed[k]][1] - found[k][0] for k in mains), default=0)

    def holds_main(k: int) -> bool:
        """Whether the element holds all article and main elements, or all articles and most of what is in main."""
        inside = lambda those: bool(those) and k < min(those) and closed[k] > max(closed[x] for x in those)
        return inside(mains) or inside(articles) and 2 * (found[closed[k]][1] - found[k][0]) > widest

    out: list[Block] = []
    paths: dict[str, int] = {}
    stack: list[tuple[int, str, str, bool, str, tuple[str, ...]]] = []  # token, path, tag, dropped, main, named
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                top = stack[-1] if stack else (-1, "", "", False, "", ())
                out.append(Block(text, top[1], tuple(s[1] for s in stack), top[2], top[3], top[4], linked, top[5]))
            parts.clear()
        linked = 0

    last = 0
    for k, (start, end, tag, is_close, raw) in enumerate(found):
        if start > last:
            piece = page[last:start]
            parts.append(piece)
            if links:
                linked += len(piece.split())
        last = end
        if not tag:
            continue
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            links = 0 if is_close else 1
        block = tag in BLOCK_TAGS
        if is_close:
            if block:
                flush()
            if k in ends:
                while stack and stack[-1][0] >= ends[k]:
                    stack.pop()
            continue
        attrs = _attributes(raw) if raw else {}
        dropped = k in closed and _drops(tag, attrs, raw)
        named = k in closed and not dropped and _named(tag, attrs, bool(stack and stack[-1][4])) and not holds_main(k)
        if not block and not dropped and not named and not (k in closed and tag in MAIN_TAGS):
            continue
        flush()
        if tag in VOID_TAGS:
            continue
        while stack and stack[-1][0] not in closed and (tag == stack[-1][2] or stack[-1][2] == "p"):
            stack.pop()
        up = stack[-1] if stack else (-1, "", "", False, "", ())
        name = (attrs.get("class", "").split() or [""])[0]
        path = f"{up[1]}/{tag}{'.' + name.replace('/', '|') if name else ''}"
        is_main = tag in MAIN_TAGS or attrs.get("role", "").lower() == "main"
        drop = up[3] or dropped or (tag == "header" and k in closed and not up[4])
        paths[path] = paths.get(path, 0) + 1
        stack.append((k, path, tag, drop, up[4] or (path if is_main and k in closed else ""), (*up[5], path) if named else up[5]))
        if tag in DROP_TAGS or not block:
            links = 0
    if last < len(page):
        parts.append(page[last:])
    flush()
    return out, paths


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _hash(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "replace")) >> 1


def _statistics(batches):
    """(host, kind, token, name, pages, x, y, words, linked, hidden, hidden_linked, named) of every token: kind 0 the page itself, 1 a path, 2 a text
    block, named by its path. Words of a path: in blocks that are not
    excluded, and (hidden) that only a name excludes; a path is named if a name excludes it."""
    for batch in batches:
        sums: dict[tuple[str, int, int], list] = {}
        for h, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found, paths = blocks(page)
            page_hash = _hash(page)
            tokens: dict[tuple[int, int], list] = {(0, 0): [1, "", 0, 0, 0, 0, 0]}
            for p, n in paths.items():
                tokens[1, _hash(p)] = [n, p, 0, 0, 0, 0, 0]
            for b in found:
                words = len(b.text.split())
                t = tokens.setdefault((2, _hash(b.path + "\n" + b.text)), [0, b.path, 0, 0, 0, 0, 0])
                t[0] += 1
                if not b.dropped:
                    linked = 0 if b.main and b.tag == "h1" else min(b.linked, words)
                    for t in ([t] if words <= CONSTANT_WORDS else []) + [tokens[1, _hash(p)] for p in set(b.paths)] + [tokens[0, 0]]:  # longer text is never constant
                        t[4 if b.named else 2] += words
                        t[5 if b.named else 3] += linked
                    for p in b.named:
                        tokens[1, _hash(p)][6] = 1
            for (kind, token), (n, name, *sums_of_page) in tokens.items():
                mixed = xxhash.xxh64_intdigest(f"{page_hash} {n}".encode())
                s = sums.setdefault((h, kind, token), [name, *[0] * 8])
                s[1] += 1
                s[2] += mixed & 0x7FFFFFFF
                s[3] += mixed >> 33
                for i, x in enumerate(sums_of_page, 4):
                    s[i] += x
        rows = [(*key, *s) for key, s in sums.items()]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 8]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["host", "kind", "token", "name", "pages", "x", "y", *SUMS])


def _slot(paths: tuple[str, ...], frame: frozenset[str]) -> str:
    """The deepest path of the template around a block."""
    return next((p for p in reversed(paths) if p in frame), "")


def _chain(path: str, frame: frozenset[str]) -> str:
    """The deepest path of the template that is ``path`` or lies around it."""
    while path and path not in frame:
        path = path[:path.rindex("/")]
    return path


def _closed(tokens: list[dict], total: int) -> tuple[list[str], list[str], list[str], list[int]]:
    """Of a host's valid tokens: the template's paths, those whose slot gives no text, those that their name does not
    exclude, and the constant text. ``total``: words of the host's blocks that no tag excludes."""
    paths = {t["name"]: t for t in tokens if t["kind"] == 1}
    texts = [t for t in tokens if t["kind"] == 2]
    frame = frozenset(paths)
    total -= sum(t["words"] + t["hidden"] for t in texts)
    lifted = []
    for p, t in paths.items():
        if t["named"]:
            hidden = t["hidden"] - sum(x["hidden"] for x in texts if (x["name"] + "/").startswith(p + "/"))
            if hidden > 0 and hidden >= MAIN_SHARE * total:
                lifted.append(p)
    # words and linked words of each slot that are not constant, and constant words
    free = {p: [t[c] for c in SUMS[:4]] for p, t in paths.items()}
    constant = {p: [0, 0] for p in frame}
    for t in tokens:
        path = t["name"]
        slot = _chain(path[:path.rindex("/")] if t["kind"] == 1 else path, frame)
        if slot:
            for i, c in enumerate(SUMS[:4]):
                free[slot][i] -= t[c]
            if t["kind"] == 2:
                constant[slot][0] += t["words"]
                constant[slot][1] += t["hidden"]
    skip = []
    for p, (words, linked, hidden, hidden_linked) in free.items():
        shown = any((p + "/").startswith(x + "/") for x in lifted)
        words, linked = (words + hidden, linked + hidden_linked) if shown else (words, linked)
        if (constant[p][0] + shown * constant[p][1] and words <= 0) or 2 * linked > words > 0:
            skip.append(p)
    return sorted(frame), sorted(skip), sorted(lifted), sorted(t["token"] for t in texts)


def _deduced(batches):
    for batch in batches:
        found = [_closed(*x) for x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        kinds = [*[pa.list_(pa.string())] * 3, pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)]], names=["host", "frame", "skip", "lifted", "constant"])


def templates(pages: DataFrame) -> DataFrame:
    """One row per host of ``pages`` (host, html) with a template: host, frame (its paths), skip (those whose slot gives no text), lifted (those that their name does not exclude), constant (hashes of constant text)."""
    distinct = pages.where("html <> ''").select("host", "html", F.xxhash64("host", "html").alias("key"))
    repeated = materialize(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("key"), "repeated-pages")
    # copies of a page count once: unrepeated pages go as they are, of each repeated one a single text
    once = distinct.join(repeated, "key", "left_anti").select("host", "html").unionByName(
        distinct.join(repeated, "key", "left_semi").groupBy("key").agg(F.first("host").alias("host"), F.first("html").alias("html")).select("host", "html"))
    tokens = once.mapInArrow(_statistics, "host string, kind int, token long, name string, pages long, x long, y long, " + ", ".join(f"{c} long" for c in SUMS))
    tokens = tokens.groupBy("host", "kind", "token").agg(F.max("name").alias("name"), *[F.sum(c).alias(c) for c in ("pages", "x", "y", *SUMS)]).where("pages > 1")
    tokens = materialize(tokens, "page-tokens")
    sizes = tokens.where("kind = 0").select("host", F.col("pages").alias("n"), (F.col("words") + F.col("hidden")).alias("all"))
    frequent = tokens.where("kind > 0").join(sizes, "host").where((F.col("n") >= PAGES) & (F.col("pages") >= SUPPORT * F.col("n")))
    # frequent tokens of a host: at most 1 / SUPPORT times what one page holds
    classes = frequent.groupBy("host", "pages", "x", "y").agg(F.first("all").alias("all"), F.count(F.lit(1)).alias("size"), F.collect_list(F.struct("kind", "token", "name", *SUMS)).alias("tokens"))
    by_host = classes.where(F.col("size") >= CLASS_TOKENS).groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"), F.first("all").alias("all"))
    return materialize(by_host.mapInArrow(_deduced, "host string, frame array<string>, skip array<string>, lifted array<string>, constant array<long>"), "templates")


def _unlinked(found: list[Block]) -> list[Block]:
    """Blocks of the element paths of which at most half of the words on the page are linked."""
    sums: dict[str, int] = {}
    for b in found:
        words = len(b.text.split())
        sums[b.path] = sums.get(b.path, 0) + words - 2 * min(b.linked, words)
    return [b for b in found if sums[b.path] >= 0]


def main_text(page: str, frame: frozenset[str], skip: frozenset[str], lifted: frozenset[str], constant: frozenset[int]) -> str:
    found, _ = blocks(page)
    seen = [b for b in found if not b.dropped and lifted.issuperset(b.named)]
    mains = {b.main for b in seen if b.main}
    if frame:
        kept = []
        for b in seen:
            slot = _slot(b.paths, frame)
            if b.main if any(m.startswith(slot + "/") for m in mains) else slot not in skip:
                kept.append(b)
        kept = kept or [b for b in seen if b.main]
    else:
        kept = [b for b in seen if b.main] if mains else _unlinked(seen)
    if constant:
        kept = [b for b in kept if (b.main and b.tag in PROSE_TAGS) or len(b.text.split()) > CONSTANT_WORDS or _hash(b.path + "\n" + b.text) not in constant]
    return "\n\n".join(b.text for b in kept)


def _extract(batches):
    for batch in batches:
        texts, known = [], {}
        for page, *lists in zip(batch.column(2).to_pylist(), *(batch.column(i) for i in (3, 4, 5, 6)), strict=True):
            key = tuple(tuple(x.as_py() or ()) for x in lists)
            held = known.setdefault(key, tuple(map(frozenset, key)))
            texts.append(main_text(page or "", *held))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    workers_import(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host(F.col("url").cast("string")).alias("host"))
    known = templates(rows.select("host", "html"))
    joined = rows.join(known, "host", "left").select("page_id", "url", "html", "frame", "skip", "lifted", "constant")
    return joined.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
