"""Removal of byte strings that occur more than once, by suffix arrays.

A string is ``LENGTH`` bytes of one document. To bring equal strings together, each is filed under its anchor, the
smallest by hash of the ``GRAM``-byte strings inside it: equal strings have equal anchors, and neighbouring strings mostly
have the same one, so they travel as one segment. Strings whose anchor occurs once in the corpus occur once themselves
and stay where they are. Each group of anchors sorts the suffixes of its segments in two stages (``suffixes``) and marks
those that share ``LENGTH`` bytes with a neighbour in the order.

An anchor that occurs more than ``HOT`` times would gather too much in one group. Its strings are filed by a hash of the
whole string instead, and only those whose hash occurs twice are sent. A block sends equal segments once.

Cases: null counts as empty; texts shorter than a string keep all; rows alike are texts like any others, so both lose what
they share; a null doc_id stays null; a text is never cut, so one longer than a block is a block of its own, read whole by one
task; ties can't arise; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barograph.llm.blocks import Texts, packed_blocks, squeeze, stretch, text_bytes
from barograph.llm.suffixes import repeated_suffixes
from barograph.llm.words import mix, ragged, window_hashes
from barograph.session import WorkArea

LENGTH, GRAM, HOT = 200, 40, 2000
SLICE_BYTES = 32 << 20
_PIECE = 1 << 21
_PLACE_BITS = np.uint64(22)
#: Groups of segments that are sorted together have about 1 / _SUBS of a slice's text.
_SUBS = 32

_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


#: Kinds of rows that come to a block: its own runs, repeated anchors, hot anchors, repeated strings of hot anchors.
OWN_RUNS, COMMON, HOT_ANCHOR, HOT_STRING = range(-1, 3)


class Runs:
    """The block's strings by anchor: runs of neighbouring starts that have the same anchor at the same place."""

    def __init__(self, texts: Texts, anchor: np.ndarray, first: np.ndarray, count: np.ndarray):
        self.texts, self.anchor, self.first, self.count = texts, anchor, first, count

    @classmethod
    def scan(cls, texts: Texts) -> Runs:
        total = len(texts.data)
        steps = np.zeros(total + 1, np.int32)
        whole = np.diff(texts.offsets) >= LENGTH
        np.add.at(steps, texts.offsets[:-1][whole], 1)
        np.add.at(steps, texts.offsets[1:][whole] - LENGTH + 1, -1)
        is_start = np.cumsum(steps[:-1]) > 0
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for a in range(0, total, _PIECE):
            found.append(cls._piece(texts, a, is_start[a : a + _PIECE]))
        return cls(texts, *(np.concatenate(x) for x in zip(*found, strict=True)))

    @classmethod
    def read(cls, block: pd.DataFrame, reply: pd.DataFrame) -> Runs | None:
        """The runs that ``anchors`` found, from the block and the rows that came to it."""
        own = reply[reply["kind"] == OWN_RUNS]
        if block.empty or own.empty:
            return None
        anchor = np.frombuffer(own["keys"].iloc[0], np.uint64)
        return cls(Texts(block["packed"].iloc[0]), anchor, stretch(own["firsts"].iloc[0]), stretch(own["counts"].iloc[0]))

    @staticmethod
    def _piece(texts: Texts, a: int, is_start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = texts.data[a : a + _PIECE + LENGTH - 1]
        grams = window_hashes(_BYTE[data], GRAM, 3)
        n = len(data) - LENGTH + 1
        starts = np.flatnonzero(is_start[: max(n, 0)])
        if not len(starts):
            return np.zeros(0, np.uint64), starts, starts
        least = (grams >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
        width, size = 1, LENGTH - GRAM + 1
        while 2 * width <= size:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:n], least[size - width : size - width + n])
        place = (least & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        return grams[place[first]], starts[first] + a, np.diff(first, append=len(starts))

    def strings(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the runs' strings, one by one, and the strings' hashes."""
        starts = ragged(self.first[hot], self.count[hot])
        out = np.zeros(len(starts), np.uint64)
        for a in range(0, len(self.texts.data), _PIECE):
            low, high = np.searchsorted(starts, [a, a + _PIECE])
            if high > low:
                hashes = window_hashes(_BYTE[self.texts.data[a : a + _PIECE + LENGTH - 1]], LENGTH, 4)
                out[low:high] = hashes[starts[low:high] - a]
        return starts, out


def _by_part(keys: np.ndarray, slices: int) -> list[tuple[int, np.ndarray]]:
    """Indexes of the keys by the slice that they belong to."""
    part = (keys >> np.uint64(20)) % np.uint64(slices)
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(slices + 1))
    return [(k, order[a:b]) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]


def _key_messages(block: int, keys: np.ndarray, slices: int) -> list[tuple]:
    keys, counts = np.unique(keys, return_counts=True)
    return [(k, block, keys[x].tobytes(), squeeze(counts[x]), None) for k, x in _by_part(keys, slices)]


MESSAGES = "part int, block long, keys binary, counts binary, firsts binary"
MESSAGE = [c.split()[0] for c in MESSAGES.split(", ")]


def anchors(blocks: DataFrame, slices: int) -> DataFrame:
    """part, block, keys and counts: the anchors of each block.

    A row of part -1 keeps the block's runs, with ``firsts``, so that later steps needn't look for them again.
    """

    def rows(batches):
        for batch in batches:
            for block, packed in zip(batch["block"], batch["packed"], strict=True):
                runs = Runs.scan(Texts(packed))
                out = _key_messages(block, runs.anchor, slices)
                out.append((-1, block, runs.anchor.tobytes(), squeeze(runs.count), squeeze(runs.first)))
                yield pd.DataFrame(out, columns=MESSAGE)

    return blocks.select("block", "packed").mapInPandas(rows, MESSAGES)


def repeated_keys(messages: DataFrame, limit: int) -> DataFrame:
    """block, keys and hot: of each block's keys those that occur twice in the corpus, and whether too often to gather."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, np.uint64) for k in pdf["keys"]]
        all_, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, np.concatenate([stretch(c) for c in pdf["counts"]]))
        out, done = [], 0
        for block, own in zip(pdf["block"], keys, strict=True):
            n = total[at[done : done + len(own)]]
            done += len(own)
            for hot in (False, True):
                x = own[(n > 1) & ((n > limit) == hot)]
                if len(x):
                    out.append((block, x.tobytes(), hot))
        return pd.DataFrame(out, columns=["block", "keys", "hot"])

    return messages.groupBy("part").applyInPandas(group, "block long, keys binary, hot boolean")


def _keys(replies: pd.DataFrame) -> np.ndarray:
    return np.sort(np.frombuffer(b"".join(replies["keys"]), np.uint64))


def _among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(values), bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def hot_strings(blocks: DataFrame, replies: DataFrame, slices: int) -> DataFrame:
    """part, block, keys and counts: hashes of the strings that have a hot anchor."""

    def rows(key: tuple, block: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        out, hot = [], reply[reply["kind"] == HOT_ANCHOR]
        if len(hot):
            runs = Runs.read(block, reply)
            _, hashes = runs.strings(_among(runs.anchor, _keys(hot)))
            out = _key_messages(block["block"].iloc[0], hashes, slices)
        return pd.DataFrame(out, columns=MESSAGE)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(rows, MESSAGES)


def segments(blocks: DataFrame, replies: DataFrame, slices: int) -> DataFrame:
    """Messages to the groups: part, block, subs, wanted, starts and text of the segments, which differ from each other.

    A message of part -1 has starts only, of strings that the block itself has more than once.
    """
    columns = ["part", "block", "subs", "wanted", "starts", "text"]

    def send(key: tuple, block: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        runs, kind = Runs.read(block, reply), reply["kind"]
        if runs is None or not (kind != OWN_RUNS).any():
            return pd.DataFrame([], columns=columns)
        common = _among(runs.anchor, _keys(reply[kind == COMMON]))
        starts, hashes = runs.strings(_among(runs.anchor, _keys(reply[kind == HOT_ANCHOR])))
        twice = _among(hashes, _keys(reply[kind == HOT_STRING]))
        keys = np.concatenate([runs.anchor[common], hashes[twice]])
        first = np.concatenate([runs.first[common], starts[twice]])
        count = np.concatenate([runs.count[common], np.ones(int(twice.sum()), np.int64)])
        data = runs.texts.data.tobytes()
        block_id = block["block"].iloc[0]
        out, own = [], []
        for k, x in _by_part(keys, slices):
            x = x[np.argsort(keys[x], kind="stable")]
            seen: dict[bytes, int] = {}
            copied = set()
            for i, a, n in zip(x.tolist(), first[x].tolist(), count[x].tolist(), strict=True):
                text = data[a : a + n + LENGTH - 1]
                before = seen.setdefault(text, i)
                if before != i:
                    copied.add(before)
                    own.append((a, n))
            own += [(int(first[i]), int(count[i])) for i in copied]
            sent = np.fromiter(seen.values(), np.int64, len(seen))
            subs = (keys[sent] >> np.uint64(40)) % np.uint64(_SUBS)
            order = np.argsort(subs, kind="stable")
            texts = list(seen)
            text = zstandard.compress(b"".join(texts[i] for i in order.tolist()), 3)
            sent = sent[order]
            out.append((k, block_id, subs[order].astype(np.uint8).tobytes(), squeeze(count[sent]), squeeze(first[sent]), text))
        if own:
            places = np.array(own)
            places = np.sort(ragged(places[:, 0], places[:, 1]))
            out.append((-1, block_id, b"", b"", squeeze(places), b""))
        return pd.DataFrame(out, columns=columns)

    schema = "part int, block long, subs binary, wanted binary, starts binary, text binary"
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(send, schema)


def repeated_strings(messages: DataFrame, slices: int) -> DataFrame:
    """block and starts: places in the block where strings start that start elsewhere too."""

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        passed = pdf[pdf["part"] < 0]
        out = list(zip(passed["block"], passed["starts"], strict=True))
        pdf = pdf[pdf["part"] >= 0]
        if len(pdf):
            subs = [np.frombuffer(x, np.uint8) for x in pdf["subs"]]
            wanted, starts = ([stretch(x) for x in pdf[c]] for c in ("wanted", "starts"))
            raw = [zstandard.decompress(x) for x in pdf["text"]]
            reach = [np.concatenate([[0], np.cumsum(w + LENGTH - 1)]) for w in wanted]
            cuts = [np.searchsorted(s, np.arange(_SUBS + 1)) for s in subs]
            hits: list[list[np.ndarray]] = [[] for _ in raw]
            for k in range(_SUBS):
                own = [i for i, c in enumerate(cuts) if c[k + 1] > c[k]]
                if not own:
                    continue
                text = b"".join(raw[i][reach[i][cuts[i][k]] : reach[i][cuts[i][k + 1]]] for i in own)
                asked = np.concatenate([wanted[i][cuts[i][k] : cuts[i][k + 1]] for i in own])
                twice = repeated_suffixes(np.frombuffer(text, np.uint8), asked + LENGTH - 1, asked, LENGTH)
                at = 0
                for i in own:
                    w, s = wanted[i][cuts[i][k] : cuts[i][k + 1]], starts[i][cuts[i][k] : cuts[i][k + 1]]
                    n = int(w.sum())
                    hits[i].append(ragged(s, w)[twice[at : at + n]])
                    at += n
            for block, found in zip(pdf["block"], hits, strict=True):
                places = np.sort(np.concatenate(found))
                if len(places):
                    out.append((block, squeeze(places)))
        return pd.DataFrame(out, columns=["block", "starts"])

    group_of = F.when(F.col("part") < 0, F.pmod(F.col("block"), F.lit(slices)).cast("int")).otherwise(F.col("part"))
    return messages.withColumn("group_of", group_of).groupBy("group_of").applyInPandas(
        lambda pdf: group(pdf.drop(columns="group_of")), "block long, starts binary"
    )


def removed_spans(texts: Texts, starts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of the longest spans that strings from the given starts cover, none across rows."""
    begin = np.sort(np.concatenate([np.zeros(0, np.int64), *starts]))
    row = np.searchsorted(texts.offsets, begin, side="right") - 1
    new = np.ones(len(begin), bool)
    new[1:] = (np.diff(begin) > LENGTH) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begin))[: len(first)] - 1
    return begin[first], begin[last] + LENGTH, row[first]


def kept_bytes(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept, the bytes that no such string covers."""

    def keep(key: tuple, block: pd.DataFrame, reply: pd.DataFrame) -> pd.DataFrame:
        texts = Texts(block["packed"].iloc[0])
        begin, end, row = removed_spans(texts, [stretch(packed) for packed in reply["starts"]])
        stay = np.ones(len(texts.data), bool)
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            stay[a:b] = False
        n = len(texts.ids)
        removed, spans = np.bincount(row, end - begin, minlength=n).astype(np.int64), np.bincount(row, minlength=n)
        stays = texts.data[stay].tobytes()
        bounds = np.concatenate([[0], np.cumsum(np.diff(texts.offsets) - removed)]).tolist()
        rows = [stays[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        frame = pd.DataFrame({"doc_id": pd.array(texts.doc_ids(), dtype="Int64"), "n_bytes": np.diff(texts.offsets)})
        return frame.assign(n_removed=removed, n_spans=spans, kept=rows)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInPandas(keep, schema)


def without_repeated_bytes(spark: SparkSession, docs: DataFrame, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of each document."""
    area = WorkArea(spark)
    size = text_bytes(docs)
    slices = max(1, -(-size // SLICE_BYTES))
    blocks = packed_blocks(area, docs, size)
    told = area.stage(anchors(blocks, slices), "anchors")
    replies = area.stage(repeated_keys(told.filter("part >= 0"), hot), "repeated-anchors")
    runs = told.filter("part < 0").select("block", "keys", "counts", "firsts", F.lit(OWN_RUNS).alias("kind"))
    both = runs.unionByName(replies.select("block", "keys", F.col("hot").cast("int").alias("kind")), allowMissingColumns=True)
    if not replies.filter("hot").isEmpty():
        strings = area.stage(repeated_keys(hot_strings(blocks, both, slices), hot), "strings")
        both = both.unionByName(strings.select("block", "keys", F.lit(HOT_STRING).alias("kind")), allowMissingColumns=True)
    found = area.stage(repeated_strings(segments(blocks, both, slices), slices), "repeats")
    return kept_bytes(blocks, found)


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeated_bytes(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
