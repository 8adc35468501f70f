"""Main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags.  A word scores by the kind of block it
stands in and by the landmark around it (nav, footer, aside, a div of class
``ad``), a tag by its name: words of an article are positive, words of menus
negative, and tags negative, the more so the less they occur in articles.  A name
alone makes no landmark of what holds the article (``has-sidebar``, a form round a
page): see ``Page._void``.  A
landmark of negative weight, tags included, costs `LANDMARK_COST` at most (as a
tag that tells nothing), so a long advert does not part an article from its lead
or its close.  One linear
scan finds the contiguous run with the greatest sum; its blocks, without those in
landmarks of negative weight, are the text.

Weights are log-odds of inside and outside, learned from labelled pages: pages
that mark their main content themselves, with exactly one ``article`` or
``main`` element (at most `TRAIN_PAGES` of them, those with the lowest hashes of
their ids).  In scoring those elements only tell which header and which blocks
belong to an article.  A small prior of names
(`PRIOR`) stands in for what the labelled pages do not show.

Null and empty pages give empty text; markup may be unclosed or cut off.  A line
break or an image parts words, other tags inside a block do not.  Scripts, styles, templates, head and comments are never text.  Repeated rows
give equal rows, null ids are kept, extra columns are ignored and an empty table
gives no rows.
"""
from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 2_000
CLIP = 4.0
WORD_CLIP = 2.0
LANDMARK_COST = math.log(2)
OUTSIDE = 20  # a named landmark of so many times the words outside all landmarks holds the article
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|svg|iframe|object|select|textarea|button|title)\b[^>]*(?:>.*?(?:</\1\s*>|\Z)|\Z)|"
                    r"<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    # attributes: a quote counts only at the start of a value, and only if another ends it
                    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+|=)*+)(?:>|\Z)", re.S | re.I)
_NAME = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_SPACE = re.compile(r"\s+")
#: Elements whose start and end break the text; those that hold text of one kind.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split())
LANDMARKS = frozenset("nav footer header aside form menu dialog".split())
CONTENT = frozenset(("article", "main"))
#: Names in class, id or role that mark what is not content.
NOT_CONTENT = re.compile(r"(?i)(?:^|[-_\s])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookie\w*|consent|notice|alert|popup|modal|newsletter|subscribe|signup|"
                         r"menu|navbar|navigation|nav|breadcrumbs?|sidebar|aside|widget|related|recommend\w*|share|social|comments?|discussions?|replies|footer|header|"
                         r"masthead|complementary|contentinfo|search|login)(?:$|[-_\s\d])")
#: Prior log-odds of kinds of blocks and landmarks.
PRIOR = {"block:p": 2.0, "block:h1": 2.0, "block:h2": 1.0, "block:h3": 1.0, "block:pre": 1.0, "block:blockquote": 1.0, "block:li": 0.3,
         "block:td": 0.3, "block:dd": 0.3, "block:dt": 0.3, "block:figcaption": 0.3, "block:": 0.5, "mark:": 0.0, "mark:other": -4.0}
PRIOR_WORDS = 50


#: Tags that part words, as white space does.
GAPS = frozenset(("br", "img"))


class _Landmark:
    """An open or closed landmark: what it is, where it stands and what it holds."""

    def __init__(self, above: int, label: str, by_name: bool, in_content: bool):
        self.above, self.label, self.by_name, self.in_content = above, label, by_name, in_content
        self.words = self.linked = 0
        self.headline = self.menu = self.main = False


class Page:
    """Words and tags of a page, in order: features of each, and the block that a word belongs to."""

    def __init__(self, html: str | None):
        self.features: list[tuple] = []  # ("word", block, landmark, words) or ("tag", name, landmark that it opens, closes or stands in)
        self.text: list[tuple[int, str, str] | None] = []  # (block number, raw text, landmark) of a run of words
        self.inside: list[bool] = []
        self.contents = 0
        self.landmarks = [_Landmark(-1, "", False, False)]  # the first is the page
        html = html or ""
        stack: list[tuple[str, int, bool]] = []  # element, landmark, inside content
        opened: Counter = Counter()
        number, at, kind, link = 0, 0, ("", 0, False), False
        for m in _TOKEN.finditer(html):
            number = self._words(html[at : m.start()], number, kind, link)
            at = m.end()
            if not m[3]:
                continue
            name = m[3].lower()
            tag, before = ("/" if m[2] else "") + name, kind[1]
            if name not in BLOCKS:
                link = not m[2] if name == "a" else link
                self.text.append((number, " ", before) if name in GAPS else None)
                self.features.append(("tag", tag, before))
                self.inside.append(kind[2])
                continue
            self.text.append(None)
            number += 1
            if m[2]:
                if opened[name]:
                    while True:
                        gone = stack.pop()[0]
                        opened[gone] -= 1
                        if gone == name:
                            break
            else:
                if stack and stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or stack and name in ("li", "dt", "dd", "td", "th", "tr") and stack[-1][0] == name:
                    opened[stack.pop()[0]] -= 1
                above = stack[-1] if stack else ("", 0, False)
                mark = self._landmark(name, m[4], above)
                self.contents += name in CONTENT
                self.landmarks[mark].main |= name == "main"
                self.landmarks[mark].headline |= name == "h1"
                self.landmarks[mark].menu |= name == "nav"
                if name != "hr":
                    stack.append((name, mark, above[2] or name in CONTENT))
                    opened[name] += 1
            kind = stack[-1] if stack else ("", 0, False)
            kind = (kind[0] if kind[0] not in ("article", "main", "section", "div", "body", "html") else "", kind[1], kind[2])
            self.features.append(("tag", tag, before or kind[1]))
            self.inside.append(kind[2])
        self._words(html[at:], number, kind, link)
        label = self._labels()
        self.features = [(*f[:2], label[f[2]], *f[3:]) for f in self.features]
        self.text = [t and (t[0], t[1], label[t[2]]) for t in self.text]

    def _landmark(self, name: str, attributes: str, above: tuple[str, int, bool]) -> int:
        """The number of the landmark that an element opens, or that it stands in."""
        if name in LANDMARKS and not (name == "header" and above[2]):
            self.landmarks.append(_Landmark(above[1], name, name in ("form", "header"), above[2]))
        elif attributes and name not in CONTENT and name not in ("body", "html"):
            names = " ".join(a or b or c for a, b, c in _NAME.findall(attributes))
            if not names or not NOT_CONTENT.search(names):
                return above[1]
            self.landmarks.append(_Landmark(above[1], f"{name}.{names.lower()[:40]}", True, above[2]))
        else:
            return above[1]
        return len(self.landmarks) - 1

    def _void(self, mark: _Landmark) -> bool:
        """Whether what makes *mark* a landmark (a class, an id, a form, a header) is only a name of what holds the article:
        its headline or its main element.  A header with a menu is the site's."""
        if not mark.by_name:
            return False
        if mark.label == "header":
            return mark.headline and not mark.menu
        return mark.headline or mark.main

    def _labels(self) -> list[str]:
        """Of each landmark, the label of the outermost one that it stands in and that counts; empty if none does."""
        marks = self.landmarks
        for mark in reversed(marks[1:]):
            up = marks[mark.above]
            up.words, up.linked, up.main = up.words + mark.words, up.linked + mark.linked, up.main or mark.main
            up.headline, up.menu = up.headline or mark.headline, up.menu or mark.menu or mark.label == "nav"
        void = {k for k, mark in enumerate(marks) if k and self._void(mark)}
        while True:
            label = [""]
            for k, mark in enumerate(marks[1:], 1):
                label.append(label[mark.above] or ("" if k in void else mark.label))
            outside = marks[0].words - sum(mark.words for k, mark in enumerate(marks) if k and label[k] and not label[mark.above])
            # a page with next to no text outside its landmarks: the largest one that has only a name, and text rather than links
            most = max((k for k, mark in enumerate(marks) if k and label[k] and not label[mark.above] and mark.by_name and not mark.in_content
                        and 2 * mark.linked < mark.words and OUTSIDE * outside < mark.words), key=lambda k: marks[k].words, default=0)
            if not most:
                return label
            void.add(most)

    def _words(self, raw: str, number: int, kind, link: bool) -> int:
        n = len(raw.split())
        if n or raw:
            mark = self.landmarks[kind[1]]
            mark.words += n
            mark.linked += n * link
            self.features.append(("word", kind[0], kind[1], n))
            self.text.append((number, raw, kind[1]))
            self.inside.append(kind[2])
        return number


class Weights:
    def __init__(self, counts: dict[str, tuple[float, float]]):
        """counts: feature -> (times inside, times outside); words and tags by their own totals."""
        self.odds = {}
        for group in ("block:", "mark:", "tag:"):
            own = {f: c for f, c in counts.items() if f.startswith(group)}
            total = [sum(c[k] for c in own.values()) for k in (0, 1)]
            for f, (inside, outside) in own.items():
                prior = PRIOR.get(f, PRIOR["mark:other"] if group == "mark:" and f != "mark:" else 0.0)
                lean = 1 / (1 + math.exp(-prior))
                own_odds = math.log((inside + PRIOR_WORDS * lean / max(len(own), 1) + 1e-9) / (total[0] + PRIOR_WORDS)) - math.log(
                    (outside + PRIOR_WORDS * (1 - lean) / max(len(own), 1) + 1e-9) / (total[1] + PRIOR_WORDS))
                self.odds[f] = max(-CLIP, min(CLIP, own_odds)) if total[0] and total[1] else prior

    def mark(self, landmark: str) -> float:
        if not landmark:
            return 0.0
        return self.odds.get(f"mark:{landmark}", PRIOR["mark:other"])

    def word(self, block: str, landmark: str) -> float:
        own = self.odds.get(f"block:{block}", PRIOR.get(f"block:{block}", 0.5))
        return max(-WORD_CLIP, min(WORD_CLIP, min(self.mark(landmark), own) if landmark else own))

    def tag(self, name: str) -> float:
        return -math.log1p(math.exp(-self.odds.get(f"tag:{name}", 0.0)))


def best_run(scores: np.ndarray) -> tuple[int, int]:
    """[begin, end) of the contiguous run with the greatest positive sum (the longest of equal ones); (0, 0) if none."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    gain = total - np.minimum.accumulate(total)
    end = int(np.argmax(gain))
    if gain[end] <= 0:
        return 0, 0
    least = np.minimum.accumulate(total)[end]
    return int(np.argmax(total[: end + 1] <= least)), end


def feature_scores(page: Page, weights: Weights) -> np.ndarray:
    """Score of each feature; a landmark of negative weight has its whole cost at its first."""
    scores = np.array([f[3] * weights.word(f[1], f[2]) if f[0] == "word" else weights.tag(f[1]) for f in page.features], float)
    at = 0
    for landmark, block in groupby(f[2] for f in page.features):
        end = at + sum(1 for _ in block)
        if weights.mark(landmark) < 0:
            cost = max(-LANDMARK_COST, float(scores[at:end].sum()))
            scores[at:end] = 0.0
            scores[at] = cost
        at = end
    return scores


def extract(html: str | None, weights: Weights) -> str:
    page = Page(html)
    begin, end = best_run(feature_scores(page, weights))
    parts: list[str] = []
    last = None
    for entry in page.text[begin:end]:
        if entry is None or weights.mark(entry[2]) < 0:
            continue
        number, raw, _ = entry
        if number != last:
            parts.append("")
            last = number
        parts[-1] += raw
    clean = (_SPACE.sub(" ", entities.unescape(p)).strip() for p in parts)
    return "\n\n".join(p for p in clean if p)


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", *, train_pages: int = TRAIN_PAGES) -> Weights:
    """Weights from the pages that mark their main content."""
    spark = pages.sparkSession
    marked = pages.where(F.col(id_col).isNotNull() & F.lower(html_col).rlike(r"<(article|main)\b"))
    chosen = marked.select(F.col(id_col).cast("long").alias("page")).orderBy(F.xxhash64("page"), "page").limit(train_pages).collect()
    ids = spark.sparkContext.broadcast(np.unique(np.array([r.page for r in chosen], np.int64)))

    def count(batches):
        inside, outside = Counter(), Counter()
        for batch in batches:
            page = np.asarray(batch.column(0))
            for html in batch.column(1).filter(pa.array(np.isin(page, ids.value))):
                p = Page(html.as_py())
                if p.contents != 1 or True not in p.inside:
                    continue
                for f, is_in in zip(p.features, p.inside, strict=True):
                    into = inside if is_in else outside
                    if f[0] == "tag":
                        if f[1].strip("/") not in CONTENT:
                            into[f"tag:{f[1]}"] += 1
                    elif f[3]:
                        into[f"mark:{f[2]}" if f[2] else f"block:{f[1]}"] += f[3]
        names = list(inside.keys() | outside.keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([inside[x] for x in names], pa.int64()),
                                          pa.array([outside[x] for x in names], pa.int64())], names=["feature", "inside", "outside"])

    rows = pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("page"), F.col(html_col).alias("html"))
    counts = rows.mapInArrow(count, "feature string, inside long, outside long").groupBy("feature").agg(
        F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return Weights({r.feature: (r.inside, r.outside) for r in counts})


def main_text(pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of *pages*: the id, the url, text and n_chars (code points)."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            text = [extract(h.as_py(), shared.value) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())], names=["page", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    out = rows.mapInArrow(run, "page long, url string, text string")
    return out.select(F.col("page").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
