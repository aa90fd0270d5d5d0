"""Suffix sorting in two stages, and which suffixes share a long prefix."""

from __future__ import annotations

import numpy as np

from barograph.llm.words import ragged


def falling(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True where a suffix is larger than its successor; a segment's end, of which ``ends`` tells, is smaller than all."""
    step = np.zeros(len(text), np.int16)
    step[:-1] = text[1:].astype(np.int16) - text[:-1]
    step[ends - 1] = -1
    step[ends] = -1
    decides = np.where(step != 0, np.arange(len(text)), len(text) - 1)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    return step[decides] < 0


def sort_suffixes(segments: np.ndarray, lengths: np.ndarray, wanted: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The text with one slot after each segment, and its wanted suffixes in order of their first ``depth`` bytes.

    ``wanted`` tells how many suffixes, from its first, each segment gives. Only suffixes smaller than their successors
    are sorted by comparison. A scan over the buckets of first bytes then places every other suffix: it comes in the
    order in which its successor was placed.
    """
    n = len(lengths)
    begins = np.cumsum(lengths + 1) - lengths - 1
    ends = begins + lengths
    text = np.zeros(int(ends[-1]) + 1, np.uint8)
    slot = np.zeros(len(text), bool)
    slot[ends] = True
    text[~slot] = segments
    falls = falling(text, ends)
    # A segment takes part up to the first rising suffix at or after its last wanted one, on which the last ones rest.
    rest = np.where(~falls | slot, np.arange(len(text)), len(text) - 1)
    rest = np.minimum.accumulate(rest[::-1])[::-1][begins + wanted - 1]
    part = np.zeros(len(text) + 1, np.int32)
    np.add.at(part, begins, 1)
    np.add.at(part, rest + 1, -1)
    part = np.cumsum(part[:-1]) > 0
    part[slot] = False

    rising = np.flatnonzero(part & ~falls)
    stop = np.minimum(rising + depth, ends[np.searchsorted(ends, rising)])
    chars = text.tobytes().decode("latin-1")
    keys = [chars[a:b] for a, b in zip(rising.tolist(), stop.tolist(), strict=True)]
    rising = rising[np.array(sorted(range(len(keys)), key=keys.__getitem__), dtype=np.int64)] if keys else rising
    del keys
    bounds = np.searchsorted(text[rising], np.arange(257))

    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    placed = []
    for c in range(-1, 256):
        if c < 0:
            bucket = ends
        else:
            run = np.concatenate(waiting[c]) if waiting[c] else rising[:0]
            runs = [run]
            while len(run):
                run = run[run > 0] - 1
                run = run[part[run] & falls[run] & (text[run] == c)]
                runs.append(run)
            bucket = np.concatenate([*runs, rising[bounds[c] : bounds[c + 1]]])
            placed.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[part[before] & falls[before]]
        first = text[before]
        above = first > c
        before, first = before[above], first[above]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for group in np.split(before, cuts) if len(before) else []:
            waiting[text[group[0]]].append(group)
    order = np.concatenate(placed)
    asked = np.zeros(len(text) + 1, np.int32)
    np.add.at(asked, begins, 1)
    np.add.at(asked, begins + wanted, -1)
    return text, order[np.cumsum(asked[:-1])[order] > 0]


def shared_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the next in order, in whole steps of 8 bytes up to ``depth``."""
    common = np.zeros(max(len(order) - 1, 0), np.int64)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.ndarray(len(text) + 1, np.dtype("<u8"), padded, 0, (1,))
    at = np.arange(len(common))
    for k in range(0, depth, 8):
        same = words[order[at] + k] == words[order[at + 1] + k]
        at = at[same]
        common[at] = k + 8
    return common


def repeated_suffixes(segments: np.ndarray, lengths: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """For the wanted suffixes, segment by segment: whether another one has the same first ``depth`` bytes.

    Every wanted suffix must have that many bytes; ``depth`` is a multiple of 8.
    """
    text, order = sort_suffixes(segments, lengths, wanted, depth)
    same = shared_prefixes(text, order, depth) >= depth
    hit = np.zeros(len(text), bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    begins = np.cumsum(lengths + 1) - lengths - 1
    return hit[ragged(begins, wanted)]
