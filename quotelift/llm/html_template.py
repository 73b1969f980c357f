"""HTML extraction by template deduction from equivalence classes of tokens.

Pages of one host are filled-in copies of a template. A token is a tag or the text of a block
(between two tags that are not inline) together with the elements it stands in. Tokens that occur equally often on every page of a host (the same
occurrence vector) and on nearly all of its pages form a class; a class is valid if its tokens
come in the same order on all pages, once per round, and if all of it lies in one gap of the
root class (whose tokens come exactly once per page). The valid classes are the host's
template; what stands between their tokens are its slots. The main text of a page are the
blocks of its article, also those that all pages of the host share, or, without an article,
the blocks of the page in the innermost element around all slots: the template is only used to
tell the frame. Menus, headers, footers, sidebars, notices, adverts, forms and comments are
left out in both cases.

Occurrence vectors are never built: per (host, token) two sums of hashed (page, count) stand
for the vector, so they are aggregated before they are moved and a host with a third of all
pages is no special case. A host's template is bounded by the tokens of one page. Pages of
hosts with fewer than ``MIN_PAGES`` pages have no template and only lose the named parts.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelift.llm.common import materialize
from quotelift.llm.dart_minhash import mix
from quotelift.llm.url_filter import host_of

MIN_PAGES, MIN_TOKENS, SUPPORT = 8, 3, 0.9
REMEMBERED = 300_000

#: Elements whose content is never text of the page.
_RAW = "script|style|noscript|template|title|textarea|select|iframe|object|svg|canvas|audio|video"
_LEX = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)|([^<]+|<)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meta link "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that close an open one of their kind when the next begins.
_ONE_BY_ONE = frozenset("p li dt dd tr td th option".split())
_OTHER = frozenset("nav footer aside form button menu dialog head".split())
_MAIN = frozenset("article main".split())
_FRAME = frozenset("html body article main".split())
#: Names in class, id and role of a part which is not main text.
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement adsense banner sponsor sponsored promo promotion sidebar nav navbar "
    "navigation menu breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices notification "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments disqus respond reply replies widget widgets toolbar search copyright "
    "pagination pager complementary contentinfo dialog alert skip".split()
)
_HEAD_NAMES = frozenset("header masthead topbar".split())
#: Words that a name may be joined with ("cookie-notice", "ad-box") and still name such a part.
_JOINED = _NAMES | _HEAD_NAMES | frozenset(
    "site page main top bottom left right box bar area block wrapper container list posts buttons links".split()
)
_TEXT = frozenset("p h1 h2 h3 h4 h5 h6".split())
_LISTS = frozenset("ul ol dl menu".split())
_COMMENT_NAMES = frozenset("comment comments disqus respond reply replies".split())


def _names(attributes: str) -> tuple[set[str], set[str]]:
    """(all words of class, id and role, names of parts): a name is a whole class or id."""
    words: set[str] = set()
    names: set[str] = set()
    for name, value in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for whole in value.strip("\"'").split():
                own = re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", whole).lower())
                words.update(w for w in own if w.isalpha())
                if _JOINED.issuperset(own):
                    names.update(own)
    return words, names


class _Hashes(dict):
    def __missing__(self, text: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[text] = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))
        return value


def parse(page: str | None, hashes: _Hashes) -> tuple[np.ndarray, list[tuple[str, int, int, int]]]:
    """(tokens in page order, main blocks): a block is (text, place of its token, depth, common).

    ``depth`` counts the elements around the block, -1 within an article; ``common`` those that
    it shares with the block before.
    """
    stack: list[tuple[str, str, int]] = []  # (element, label, where: 0 text, 1 other, 2 comments)
    paths, words = [0], []
    tokens: list[int] = []
    blocks: list[tuple[str, int, bool, int, int, int, int]] = []  # linked words count in lists only
    piece: list[str] = []
    state = {"in_main": 0, "linked": 0, "in_link": False, "in_list": 0, "common": 0}

    def where() -> int:
        return stack[-1][2] if stack else 0

    def end_block() -> None:
        text = html.unescape("".join(piece)) if piece else ""
        piece.clear()
        words[:] = text.split()
        if words:
            text = " ".join(words)
            if where() == 0:
                blocks.append((text, len(tokens), state["in_main"] > 0, len(words), state["linked"] * (state["in_list"] > 0), len(stack), state["common"]))
                state["common"] = len(stack)
            tokens.append(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) ^ paths[-1])
        state["linked"] = 0

    def close(depth: int) -> None:
        end_block()
        while len(stack) > depth:
            name, label, _ = stack.pop()
            paths.pop()
            state["common"] = min(state["common"], len(stack))
            state["in_main"] -= name in _MAIN
            state["in_list"] -= name in _LISTS
            tokens.append(hashes["/" + label] ^ paths[-1])

    for m in _LEX.finditer(page or ""):
        if m.group(8) is not None:
            piece.append(m.group(8))
            if state["in_link"]:
                state["linked"] += len(m.group(8).split())
            continue
        closing, name, attributes = (m.group(i) or m.group(i + 3) or "" for i in (2, 3, 4))
        name = name.lower()
        if not name:
            continue
        if name in _INLINE:
            if name == "br":
                piece.append(" ")
            elif name == "a":
                state["in_link"] = not closing
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
            else:
                end_block()
            continue
        end_block()
        if name in _VOID:
            continue
        if name in _ONE_BY_ONE and stack and stack[-1][0] == name:
            close(len(stack) - 1)
        elif stack and stack[-1][0] == "p":  # a paragraph holds no other block
            close(len(stack) - 1)
            if name in _ONE_BY_ONE and stack and stack[-1][0] == name:
                close(len(stack) - 1)
        words_of, names = _names(attributes) if attributes else (set(), set())
        if state["in_main"] and name in _TEXT:
            names = set()
        state["in_link"] = False
        if name in _MAIN and where() == 1 and not names & _NAMES:
            # an article does not stand in a menu or a form: what was open was never closed
            close(next(i for i, e in enumerate(stack) if e[2] == 1))
        place = where()
        if not place and name not in _FRAME:
            if name in _OTHER or names & _NAMES or (name == "header" or names & _HEAD_NAMES) and not state["in_main"]:
                place = 2 if names & _COMMENT_NAMES else 1
        elif not place and name == "article" and names & _COMMENT_NAMES:
            place = 2
        label = name + "".join("." + n for n in sorted(words_of))
        stack.append((name, label, place))
        tokens.append(hashes[label] ^ paths[-1])
        paths.append(int(mix(np.array([(paths[-1] + hashes[label]) & 0xFFFFFFFFFFFFFFFF], np.uint64))[0]))
        state["in_main"] += name in _MAIN
        state["in_list"] += name in _LISTS
    end_block()
    size = sum(b[3] for b in blocks if b[2])
    only = size and sum(b[3] for b in blocks) <= 4 * size
    found, common = [], len(blocks) and blocks[0][6]
    for text, place, inside, n, linked, depth, shared in blocks:
        common = min(common, shared)
        # no article: list items that are mostly links are menus
        if inside or not only and linked <= 0.6 * n:
            found.append((text, place, -1 if inside else depth, common))
            common = depth
    return np.array(tokens, np.uint64), found


_PARSED = (
    "row_id long, page_id {id}, url string, host string, tokens array<long>, texts array<string>, places array<int>, "
    "depths array<int>, commons array<int>"
)


def parsed(pages: DataFrame) -> DataFrame:
    """Tokens and main blocks of every page; places has where the token of each block stands."""
    schema = _PARSED.format(id=dict(pages.dtypes)["page_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                found = [parse(h.as_py(), hashes) for h in part.column(4)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(4)),
                        pa.array([t.view(np.int64) for t, _ in found], pa.list_(pa.int64())),
                        pa.array([[b[0] for b in blocks] for _, blocks in found], pa.list_(pa.string())),
                        *(pa.array([[b[i] for b in blocks] for _, blocks in found], pa.list_(pa.int32())) for i in (1, 2, 3)),
                    ],
                    ["row_id", "page_id", "url", "host", "tokens", "texts", "places", "depths", "commons"],
                )

    rows = pages.select(
        F.monotonically_increasing_id().alias("row_id"),
        "page_id",
        "url",
        host_of(F.col("url")).alias("host"),
        F.col("html"),
    )
    return materialize(rows.mapInArrow(run, schema), "parsed-pages")


def _occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, low, high, support, once): sums that stand for occurrence vectors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for host, group in pdf.groupby("host"):
                keys, low, high, many = [], [], [], []
                for row, tokens in zip(group["row_id"], group["tokens"], strict=True):
                    token, n = np.unique(np.asarray(tokens, np.int64), return_counts=True)
                    sign = mix(mix(np.array([row], np.uint64)) + n.astype(np.uint64))
                    keys.append(token)
                    low.append((sign & np.uint64(0xFFFFFFFF)).astype(np.float64))
                    high.append((sign >> np.uint64(32)).astype(np.float64))
                    many.append(n > 1)
                token, place = np.unique(np.concatenate(keys), return_inverse=True)
                if len(token):
                    add = lambda x: np.bincount(place, weights=np.concatenate(x)).astype(np.int64)  # noqa: B023, E731
                    yield pd.DataFrame(
                        {
                            "host": host,
                            "token": token,
                            "low": add(low),
                            "high": add(high),
                            "support": np.bincount(place),
                            "many": add(many),
                        }
                    )

    rows = pages.select("host", "row_id", "tokens").mapInPandas(
        run, "host string, token long, low long, high long, support long, many long"
    )
    return rows.groupBy("host", "token").agg(*[F.sum(c).alias(c) for c in ("low", "high", "support", "many")])


def candidates(pages: DataFrame) -> DataFrame:
    """(host, classes): classes of tokens with one occurrence vector, on nearly all pages."""
    size = pages.groupBy("host").agg(F.count("*").alias("pages")).filter(F.col("pages") >= MIN_PAGES)
    common = _occurrences(pages).join(size, "host").filter(F.col("support") >= SUPPORT * F.col("pages"))
    # every member of a class stands on every page of its support: one page bounds the list
    classes = common.groupBy("host", "low", "high", "support").agg(
        F.sort_array(F.collect_list("token")).alias("tokens"), F.max("many").alias("many"), F.max("pages").alias("pages")
    )
    classes = classes.filter(F.size("tokens") >= MIN_TOKENS)
    root = (F.col("many") == 0) & (F.col("support") == F.col("pages"))
    one = F.struct(F.xxhash64("low", "high", "support").alias("id"), root.alias("root"), F.col("tokens"))
    return materialize(classes.groupBy("host").agg(F.collect_list(one).alias("classes")), "classes")


def _with_classes(pages: DataFrame, classes: DataFrame) -> DataFrame:
    return pages.join(classes, "host", "left")


def _arrays(classes) -> tuple[np.ndarray, np.ndarray, list]:
    """(sorted tokens, index of their class, [(id, root)])."""
    own = [] if classes is None else list(classes)
    token = np.concatenate([np.asarray(c["tokens"], np.int64) for c in own]) if own else np.empty(0, np.int64)
    kind = np.repeat(np.arange(len(own)), [len(c["tokens"]) for c in own]) if own else np.empty(0, np.int64)
    order = np.argsort(token)
    return token[order], kind[order], [(c["id"], c["root"], len(c["tokens"])) for c in own]


def _mark(tokens: np.ndarray, token: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The class of each token of a page, -1 for those in none."""
    if not len(token):
        return np.full(len(tokens), -1)
    spot = np.minimum(np.searchsorted(token, tokens), len(token) - 1)
    return np.where(token[spot] == tokens, kind[spot], -1)


def valid(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """(host, classes) that are ordered on all pages and nested in one gap of the root class."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for host, tokens, own in zip(pdf["host"], pdf["tokens"], pdf["classes"], strict=True):
                tokens = np.asarray(tokens, np.int64)
                token, kind, named = _arrays(own)
                at = _mark(tokens, token, kind)
                roots = np.flatnonzero(np.isin(at, [i for i, (_, root, _) in enumerate(named) if root]))
                for i, (number, root, size) in enumerate(named):
                    place = np.flatnonzero(at == i)
                    if not len(place):
                        continue
                    rounds = tokens[place[: len(place) // size * size]].reshape(-1, size)
                    regular = len(place) % size == 0 and bool((rounds == rounds[:1]).all())
                    order = xxhash.xxh64_intdigest(rounds[:1].tobytes()) >> 1
                    gap = np.searchsorted(roots, place[[0, -1]]) if not root else np.zeros(2, np.int64)
                    out.append((host, number, regular and gap[0] == gap[1], order, int(gap[0])))
            yield pd.DataFrame(out, columns=["host", "id", "regular", "order", "gap"])

    rows = _with_classes(pages.select("host", "tokens"), classes).filter("classes is not null")
    seen = rows.mapInPandas(run, "host string, id long, regular boolean, order long, gap long")
    good = seen.groupBy("host", "id").agg(
        (F.bool_and("regular") & (F.min("order") == F.max("order")) & (F.min("gap") == F.max("gap"))).alias("good")
    )
    good = good.filter("good").groupBy("host").agg(F.collect_set("id").alias("ids"))
    kept = classes.join(good, "host").select(
        "host", F.filter("classes", lambda c: F.array_contains(F.col("ids"), c["id"])).alias("classes")
    )
    return materialize(kept, "templates")


def _kept(slot: np.ndarray, depths: np.ndarray, commons: np.ndarray) -> np.ndarray:
    """Blocks of an article, and those in the innermost element around all other slots."""
    inside = depths < 0
    keep, own = inside.copy(), np.flatnonzero(slot & ~inside)
    if len(own):
        first, last = own[0], own[-1]
        around = min([*commons[first + 1 : last + 1], *(depths[own] - 1)])
        while first and commons[first] >= around:
            first -= 1
        while last + 1 < len(slot) and commons[last + 1] >= around:
            last += 1
        keep[first : last + 1] = True
    # a page without any slot is one of many equal pages, not an empty one
    return keep if keep.any() else np.ones(len(slot), bool)


def _extract(pages: DataFrame, templates: DataFrame) -> DataFrame:
    schema = f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for tokens, blocks, own, *lists in zip(
                *(pdf[c] for c in ("tokens", "texts", "classes", "places", "depths", "commons")), strict=True
            ):
                token, kind, _ = _arrays(own)
                places, depths, commons = (np.asarray(x, np.int64) for x in lists)
                slot = _mark(np.asarray(tokens, np.int64), token, kind)[places] < 0
                texts.append("\n".join(t for t, k in zip(blocks, _kept(slot, depths, commons), strict=True) if k))
            yield pd.DataFrame(
                {"page_id": pdf["page_id"], "url": pdf["url"], "text": texts, "n_chars": [len(t) for t in texts]}
            )

    rows = _with_classes(pages, templates).select(
        "page_id", "url", "tokens", "texts", "places", "depths", "commons", "classes"
    )
    return rows.mapInPandas(run, schema)


def extract(pages: DataFrame) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars.

    ``text`` has the blocks of the main text in page order, one per line, character references
    decoded and white space within a block turned into one space. NULL, empty and text-free
    pages have an empty text; a NULL or malformed url belongs to the host ''; repeated rows
    count as pages of their own. Other columns are not read. An empty table gives an empty
    result.
    """
    found = parsed(pages)
    return _extract(found, valid(found, candidates(found)))
