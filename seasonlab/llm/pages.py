"""Main text of web pages by a linear-chain random field over the blocks of the page."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonlab.llm.common import stored

TRAIN_PAGES = 300  # most pages that are learnt from
STEPS = 250

# Elements by how they shape a page, and names that pages give to its parts.
BLOCKS = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td textarea tfoot th thead tr ul iframe label input".split()
)
UNSEEN = ("script", "style", "template", "noscript", "head", "title", "svg", "object", "canvas")
EMPTY = {"hr", "input"}
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCKS - {"button", "option", "label", "input", "select", "textarea", "iframe", "body", "html"}
SCOPES = {"ul", "ol", "dl", "table", "menu", "select", "article", "section", "div", "body"}
ASIDE_TAGS = "nav header footer aside form button select option textarea label legend fieldset dialog menu iframe address".split()
ASIDE_NAMES = (
    "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs header masthead topbar footer bottom copyright legal sidebar side aside widget related recommended more "
    "popular trending notice notices cookie cookies consent gdpr alert warning popup modal overlay newsletter subscribe "
    "subscription signup login search form share sharing social comment comments reply replies discussion disqus respond "
    "feedback rating pagination pager tags toolbar skip toc"
).split()
MAIN_TAGS = "article main".split()
TELLING = {*ASIDE_TAGS, *MAIN_TAGS}
MAIN_NAMES = "article content main post entry story body text articlebody maincontent post-content blog news page".split()

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_ENDINGS = {name: re.compile(rf"</{name}\s*>", re.I) for name in UNSEEN}


@dataclass
class Block:
    """Text between two block tags, with its ancestors' tags and names."""

    tags: tuple[str, ...]
    names: frozenset[str]
    text: str
    linked: int  # characters inside links
    features: list[str] = field(default_factory=list)


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks in page order; references decoded, white space inside made one space."""
    stack: list[tuple[str, frozenset[str]]] = []
    out: list[Block] = []
    held: list[str] = []
    linked, in_link = 0, 0

    def close() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            out.append(Block(tuple(t for t, _ in stack), frozenset().union(*(n for _, n in stack)), text, linked))
        held.clear()
        linked = 0

    def leave(names: set[str], scope: set[str]) -> None:
        """Pop up to the nearest open element of ``names``, but not out of ``scope``."""
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in scope:
                return

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.match(page, at)
        at = found.end()
        name = found.group(2)
        if name is None:
            piece = found.group(0)
            if piece.startswith("<![CDATA["):
                piece = html.escape(piece[9:-3])
            elif piece.startswith(("<!", "<?")):
                continue
            held.append(piece)
            linked += len(piece) if in_link else 0
            continue
        name = name.lower()
        if name == "a":
            in_link = max(0, in_link + (-1 if found.group(1) else 1))
        elif name in _ENDINGS and not found.group(1) and not found.group(3).endswith("/"):
            close()
            ended = _ENDINGS[name].search(page, at)
            if ended is not None:
                at = ended.end()
            elif name != "head":
                at = size
        elif name == "br":
            held.append(" ")
        elif name in BLOCKS:
            close()
            in_link = 0
            if found.group(1):
                leave({name}, {"body"} if name != "body" else set())
                continue
            if name in ENDS_P:
                leave({"p"}, SCOPES)
            if name in CLOSES:
                leave(CLOSES[name], SCOPES)
            if name not in EMPTY:
                told = " ".join(x for m in _NAMES.findall(found.group(3)) for x in m)
                stack.append((name, frozenset(p.lower() for p in _PART.findall(told))))
    close()
    return out


def text_features(block: Block) -> list[str]:
    words = block.text.split()
    density = block.linked / max(1, len(block.text))
    return [
        f"words{min(8, len(words).bit_length())}",
        f"links{min(4, int(density * 5))}",
        "ends" if block.text[-1] in ".!?\"'”»" else "open",
        "sign" if "©" in block.text else "nosign",
        f"stops{min(3, sum(w[-1] in '.!?,;' for w in words))}",
        f"leaf-{block.tags[-1] if block.tags else ''}",
    ]


def place_features(block: Block) -> list[str]:
    return with_kinds([f"tag-{t}" for t in set(block.tags) if t in TELLING] + [f"name-{n}" for n in block.names])


def with_kinds(place: list[str]) -> list[str]:
    """Place features with what they have in common: a part to leave out, a main part."""
    own = set(place)
    return place + ["aside"] * (not own.isdisjoint(ASIDE_SET)) + ["main"] * (not own.isdisjoint(MAIN_SET))


ASIDE = [f"tag-{t}" for t in ASIDE_TAGS] + [f"name-{n}" for n in ASIDE_NAMES]
MAIN = [f"tag-{t}" for t in MAIN_TAGS] + [f"name-{n}" for n in MAIN_NAMES]
ASIDE_SET, MAIN_SET = frozenset(ASIDE), frozenset(MAIN)


def tells(page: str) -> bool:
    """Whether blocks of the page are in an article or main element."""
    return any("article" in b.tags or "main" in b.tags for b in blocks_of(page))


def labelled(page: str, rng: np.random.Generator) -> list[tuple[list[list[str]], list[int]]]:
    """Sequences to learn from: the blocks of a page whose own tags tell its parts.

    A page without an article or main element tells nothing. Besides the page as it is
    come two variants: one in which other names of the same kind stand for the parts,
    now and then a part to leave out inside the article, and one without names, so that
    the text features and the order of blocks are learnt too.
    """
    found = blocks_of(page)
    place = [place_features(b) for b in found]
    if not any("tag-article" in p or "tag-main" in p for p in place):
        return []
    main = [bool({*p} & {*MAIN[:2]}) and not {*p} & {*ASIDE} for p in place]
    text = [text_features(b) for b in found]
    labels = [int(m) for m in main]
    other, swapped = [], []
    kept, left = (f for f in (rng.choice(MAIN, 2), rng.choice(ASIDE, 3)))
    for k, m in enumerate(main):
        if k and main[k] != main[k - 1]:
            left = rng.choice(ASIDE, 3)
        inside = m and rng.random() < 0.4
        other.append(int(m and not inside))
        swapped.append(with_kinds([*(kept if m else left[:1]), *([rng.choice(ASIDE)] if inside else [])]))
    return [
        ([a + b for a, b in zip(place, text)], labels),
        ([a + b for a, b in zip(swapped, text)], other),
        (text, labels),
    ]


@dataclass
class Field:
    """Weights of features by label and of neighbouring labels."""

    index: dict[str, int]
    weights: np.ndarray  # (features + 1, 2), the last row is for the bias
    links: np.ndarray  # (3, 2): from the start, from 0, from 1

    def decode(self, found: list[Block]) -> list[int]:
        """Most probable labels of a page's blocks (Viterbi)."""
        best, back = self.links[0], []
        for k, b in enumerate(found):
            rows = [self.index[f] for f in place_features(b) + text_features(b) if f in self.index]
            unary = self.weights[rows].sum(axis=0) + self.weights[-1]
            if k:
                steps = best[:, None] + self.links[1:]
                back.append(steps.argmax(axis=0))
                best = steps.max(axis=0)
            best = best + unary
        if not found:
            return []
        out = [int(best.argmax())]
        for step in reversed(back):
            out.append(int(step[out[-1]]))
        return out[::-1]


def _by_length(sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pages of like length together: the block at each place of each page, and whether there is one.

    Lengths within a group differ by less than twofold, so a few very long pages widen no
    others, and all tables together have less than two places per block.
    """
    first = np.cumsum([0, *sizes])
    groups: dict[int, list[int]] = {}
    for i, n in enumerate(sizes):
        if n:
            groups.setdefault(n.bit_length(), []).append(i)
    out = []
    for _, own in sorted(groups.items()):
        n = np.array([sizes[i] for i in own])
        places = np.arange(n.max())
        live = places < n[:, None]
        out.append((np.where(live, first[own][:, None] + places, 0), live))
    return out


def forward_backward(unary: np.ndarray, links: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per page: the log of the sum over all labellings, each block's label chances, and
    the expected number of each pair of neighbouring labels over all pages."""
    n, longest = live.shape
    ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    ahead[:, 0] = links[0] + unary[:, 0]
    for k in range(1, longest):
        ahead[:, k] = np.where(live[:, k, None], np.logaddexp.reduce(ahead[:, k - 1, :, None] + links[1:], axis=1) + unary[:, k], ahead[:, k - 1])
    for k in range(longest - 2, -1, -1):
        step_on = np.logaddexp.reduce(links[1:] + (unary[:, k + 1] + behind[:, k + 1])[:, None, :], axis=2)
        behind[:, k] = np.where(live[:, k + 1, None], step_on, 0)
    whole = np.logaddexp.reduce(ahead[:, -1], axis=1)
    share = np.exp(ahead + behind - whole[:, None, None]) * live[..., None]
    pair = np.exp(ahead[:, :-1, :, None] + links[1:] + (unary[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None])
    return whole, share, (pair * live[:, 1:, None, None]).sum(axis=(0, 1))


def fit(sequences: list[tuple[list[list[str]], list[int]]], steps: int = STEPS, rate: float = 0.1, decay: float = 1e-4) -> Field:
    """Adam on the conditional likelihood, over pages grouped by length.

    What is held is a number per feature of a block and a few per block: a very long
    page costs what its blocks do.
    """
    index = {f: i for i, f in enumerate(sorted({f for x, _ in sequences for b in x for f in b} | {*ASIDE, *MAIN}))}
    n, size = len(sequences), len(index)
    w, links = np.zeros((size + 1, 2)), np.zeros((3, 2))
    of_block = [[*(index[f] for f in b), size] for x, _ in sequences for b in x]
    if of_block:
        count = np.array([len(b) for b in of_block])
        feature = np.concatenate([np.array(b) for b in of_block])
        starts, owner = np.cumsum(count) - count, np.repeat(np.arange(len(count)), count)
        truth = np.eye(2)[np.array([label for _, y in sequences for label in y])]
        groups = _by_length([len(y) for _, y in sequences])
        seen = sum(np.einsum("nka,nkb->ab", truth[at[:, :-1]] * live[:, 1:, None], truth[at[:, 1:]]) for at, live in groups)
        moments = [np.zeros_like(p) for p in (w, links, w, links)]
        for step in range(1, steps + 1):
            unary = np.add.reduceat(w[feature], starts, axis=0)
            gap, first, pairs = -truth, np.zeros(2), -seen
            for at, live in groups:
                _, share, pair = forward_backward(unary[at], links, live)
                gap[at[live]] += share[live]
                pairs = pairs + pair
                first += gap[at[:, 0]].sum(axis=0)
            g = np.stack([np.bincount(feature, weights=gap[owner, c], minlength=size + 1) for c in range(2)], axis=1)
            for i, (p, grad) in enumerate(((w, g / n + decay * w), (links, np.vstack([first, pairs]) / n + decay * links))):
                moments[i] += 0.1 * (grad - moments[i])
                moments[i + 2] += 0.001 * (grad * grad - moments[i + 2])
                p -= rate * (moments[i] / (1 - 0.9**step)) / (np.sqrt(moments[i + 2] / (1 - 0.999**step)) + 1e-8)
    else:
        w[size, 1] = 1  # nothing to learn from: all blocks are main text
    return Field(index, w, links)


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", rows: int = TRAIN_PAGES) -> Field:
    """A field from the first ``rows`` pages, by a hash of their id, that tell their parts.

    If not all of the first pages that name an article or main element do, all that name
    one are parsed to find those that do.
    """
    named = pages.select(F.col(id_col).cast("string").alias("key"), F.col(html_col).cast("string").alias("page"))
    named = named.where(F.col("page").rlike("(?i)<(article|main)"))
    order = [F.xxhash64("key", F.lit(5)), "key", F.xxhash64("page")]

    def telling(batches):
        import pyarrow as pa

        for batch in batches:
            yield batch.filter(pa.array([tells(p) for p in batch.column(1).to_pylist()], type=pa.bool_()))

    def sequences(batches):
        import pyarrow as pa

        for batch in batches:
            keys, made = [], []
            for key, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, (x, y) in enumerate(labelled(page, np.random.default_rng([5, len(page)]))):
                    keys.append((key, k))
                    made.append(([" ".join(sorted(b)) for b in x], y))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k for k, _ in keys], type=pa.string()),
                    pa.array([k for _, k in keys], type=pa.int32()),
                    pa.array([x for x, _ in made], type=pa.list_(pa.string())),
                    pa.array([y for _, y in made], type=pa.list_(pa.int32())),
                ],
                names=["key", "k", "x", "y"],
            )

    picked = stored(named.orderBy(*order).limit(rows), "first-pages")
    if picked.mapInArrow(telling, picked.schema).count() < min(rows, picked.count()):
        picked = stored(named.mapInArrow(telling, named.schema).orderBy(*order).limit(rows), "telling-pages")
    found = picked.mapInArrow(sequences, "key string, k int, x array<string>, y array<int>").collect()
    found = sorted(((r.key or "", r.k, r.x, r.y) for r in found))
    return fit([([b.split(" ") for b in x], y) for _, _, x, y in found])


def main_text(page: str | None, trained: Field) -> str:
    found = blocks_of(page or "")
    return "\n".join(b.text for b, label in zip(found, trained.decode(found)) if label)


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Blocks that the field labels as main text, in page order, joined by line ends; what
    is in them is neither cut nor changed. A page that is null, empty or without main
    text has an empty text; if no page of the table has an article or main element, all
    blocks are main text. Pages are parsed and decoded one by one in Arrow batches.
    """
    sent = pages.sparkSession.sparkContext.broadcast(learn(pages))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h, sent.value) for h in batch.column(2).to_pylist()]
            chars = pa.array([len(t) for t in texts], type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, type=pa.string()), chars], names=["page_id", "url", "text", "n_chars"])

    named = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return named.mapInArrow(run, "page_id long, url string, text string, n_chars long")
