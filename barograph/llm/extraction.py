"""The main text of web pages by a conditional random field over their leaf blocks.

A page is read into its blocks (``dom``). Each block has features of its ancestors, their tags and the words of their class
names, ids and roles, and of its own text: length, links, marks. A linear-chain field of two labels, article or not, scores
the whole sequence, in which blocks of one parent element hold together more than others, and the likeliest sequence of
labels is found by Viterbi's algorithm. The field is fitted on ``PAGES`` labelled pages (``labelled_pages``), which is the
bound of its training data; it doesn't depend on the pages that it reads.

Cases: a null or empty page, and one without any text of an article, has the empty text; pages of any length are read whole, each in
one task; rows alike are rows of their own; null ids and urls are kept as they are; of two equally likely labelings the one with
more of the last blocks is taken; broken markup is read leniently; no rows give no rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from barograph.llm import crf, dom
from barograph.llm.labelled_pages import MARK, labelled_pages

#: Labelled pages of the fit, and the least number of them in which a feature must stand.
PAGES, LEAST = 800, 3
#: Texts that a task holds before it hands them on.
HELD = 8 << 20

_NAMED = re.compile(r"""(?:^|\s)(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_UNHIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# Words of notices and forms, in blocks of at most NOTE characters.
NOTE = 200
NOTE_WORDS = re.compile(r"\b(cookies?|newsletters?|subscribe|advertisement|sponsored|copyright|rights reserved|javascript|reply|log in|sign up|accept all)\b")


# Elements that name a part of a page.
MEANINGFUL = {f"t:{tag}" for tag in "article aside dialog footer form header ins main menu nav noscript".split()}


def element_features(tag: str, attributes: str) -> frozenset[str]:
    """What an element tells about all that is inside it."""
    found = {f"t:{tag}"}
    if tag in ("html", "body"):
        return frozenset(found)
    for m in _NAMED.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "style":
            if _UNHIDDEN.search(value):
                found.add("hidden")
        elif name in ("hidden", "aria-hidden"):
            if name == "hidden" or value.lower() == "true":
                found.add("hidden")
        else:
            for token in value.split():
                whole = _HUMP.sub("-", token).lower()
                found.add(f"c:{whole}")
                for word in re.split(r"[^a-z]+", whole):
                    if word:
                        found.add(f"w:{word}")
                        if len(word) > 4:
                            found.add(f"b:{word[:5]}")
    return frozenset(found)


def nearest_features(own: frozenset[str], around: frozenset[str] | None) -> frozenset[str] | None:
    """The features of the innermost element that has a name or a meaning, marked as such: those of ``own``, or else as around it."""
    if any(f.startswith("c:") or f in MEANINGFUL for f in own):
        return frozenset(f"n:{f}" for f in own)
    return around


def block_features(block: dom.Block, text: str, titled: bool) -> list[str]:
    """What a block's own element and text tell. ``titled``: a heading of the first level has come."""
    words = text.count(" ") + 1
    found = [f"leaf:{block.tag}", f"size:{min(words, 128).bit_length()}", f"links:{min(3, 4 * block.linked // max(block.length, 1))}", "titled" if titled else "untitled"]
    if text[-1] in ".!?…:;\"”'»)。":
        found.append("stop")
    if text[0].isdigit():
        found.append("digit")
    if len(text) <= NOTE:
        low = text.lower()
        found += [x for x, there in (("rights", "©" in low), ("bars", "|" in low or "·" in low or "»" in low)) if there]
        found += [f"s:{w}" for w in set(NOTE_WORDS.findall(low))]
    return found


class Extractor(NamedTuple):
    """A fitted field; small, and the same in every task."""

    weights: dict[str, float]
    links: list
    ends: list


class _Inside(NamedTuple):
    """What is known inside an element: the features of all elements around, of the nearest telling one, and their sum."""

    features: frozenset[str]
    nearest: frozenset[str]
    score: float = 0.0


_OUTSIDE = _Inside(frozenset(), frozenset())


def _inside(state: _Inside, tag: str, attributes: str) -> _Inside:
    own = element_features(tag, attributes)
    return _Inside(state.features | own, nearest_features(own, state.nearest))


def kinds_of(blocks: list[dom.Block]) -> list[int]:
    """How a block lies to the one before: 0 if another kind of element names its part of the page, 1 if the same kind does, 2 if
    moreover both are like elements in the same one."""
    out = [0][: len(blocks)]
    for a, b in zip(blocks, blocks[1:], strict=False):
        same = a.state.nearest == b.state.nearest
        out.append(int(same) + int(same and a.parent == b.parent and a.state.features == b.state.features))
    return out


def titles(blocks: list[dom.Block]) -> list[bool]:
    """Whether a first-level heading has begun before or at each block."""
    seen, out = False, []
    for b in blocks:
        seen = seen or b.tag == "h1"
        out.append(seen)
    return out


@functools.lru_cache(maxsize=2)
def train(pages: int = PAGES, seed: int = 0) -> Extractor:
    """Fits the field on labelled pages."""
    known: dict[str, int] = {}
    read = []
    for page in labelled_pages(pages, seed):
        blocks = dom.read(page, _OUTSIDE, _inside)
        labels = [int(MARK in b.text) for b in blocks]
        features = [
            b.state.features | b.state.nearest | set(block_features(b, b.text.replace(MARK, "") or " ", t))
            for b, t in zip(blocks, titles(blocks), strict=True)
        ]
        for f in set().union(*features):
            known[f] = known.get(f, 0) + 1
        read.append((features, kinds_of(blocks), labels))
    names = {f: k for k, f in enumerate(sorted(f for f, n in known.items() if n >= LEAST))}
    chains = [crf.Chain([sorted(names[f] for f in own if f in names) for own in features], kinds, labels) for features, kinds, labels in read]
    model = crf.fit(chains, len(names), kinds=3)
    return Extractor({f: float(model.weights[k]) for f, k in names.items()}, model.links.tolist(), model.ends.tolist())


def main_blocks(page: str, model: Extractor) -> list[str]:
    """The texts of the page's article blocks, in order."""
    weights = model.weights
    of_element: dict[tuple[str, str], tuple[frozenset[str], frozenset[str] | None]] = {}

    def enter(state: _Inside, tag: str, attributes: str) -> _Inside:
        own = of_element.get((tag, attributes))
        if own is None:
            found = element_features(tag, attributes)
            nearest = nearest_features(found, None)
            own = frozenset(f for f in found if f in weights), None if nearest is None else frozenset(f for f in nearest if f in weights)
            if len(of_element) < 10_000:
                of_element[tag, attributes] = own
        new = own[0] - state.features
        if not new and own[1] is None:
            return state
        score = state.score + sum(weights[f] for f in sorted(new))
        if own[1] is None:
            return _Inside(state.features | new, state.nearest, score)
        near = sum(weights[f] for f in sorted(own[1])) - sum(weights[f] for f in sorted(state.nearest))
        return _Inside(state.features | new, own[1], score + near)

    blocks = dom.read(page, _OUTSIDE, enter)
    scores = [b.state.score + sum(weights.get(f, 0.0) for f in block_features(b, b.text, t)) for b, t in zip(blocks, titles(blocks), strict=True)]
    labels = crf.viterbi(scores, kinds_of(blocks), model.links, model.ends)
    return [b.text for b, label in zip(blocks, labels, strict=True) if label]


def extract_text(pages: DataFrame, model: Extractor | None = None) -> DataFrame:
    """page_id, url, text (article blocks, one per line) and n_chars of every row of ``pages`` (page_id, url, html)."""
    model = model or train()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, held, size = 0, [], 0
            for k, page in enumerate(batch.column("html")):
                text = "\n".join(main_blocks(page.as_py() or "", model))
                held.append(text)
                size += len(text)
                if size > HELD or k + 1 == batch.num_rows:
                    kept = batch.slice(begin, len(held))
                    counts = pa.array([len(t) for t in held], pa.int64())
                    yield pa.RecordBatch.from_arrays([kept.column("page_id"), kept.column("url"), pa.array(held, pa.string()), counts], ["page_id", "url", "text", "n_chars"])
                    begin, held, size = k + 1, [], 0

    own = pages.select("page_id", "url", "html")
    id_type = own.schema["page_id"].dataType.simpleString()
    return own.mapInArrow(extracted, f"page_id {id_type}, url string, text string, n_chars long")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
