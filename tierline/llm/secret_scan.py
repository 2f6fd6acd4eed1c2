"""Secret scans: fixed patterns, and character Markov models of random and ordinary strings.

*Samples.*  The corpus gives the labels itself: *random* strings are the values that a base pattern
proves to be secrets, one sample a kind; *ordinary* strings are the letters and digits of all other runs of
key characters of at least ``MIN_WORD``.  Every document is counted (a bounded number of character pairs, summed by Spark).

*Models.*  First-order Markov models over letters and digits.  Of the ordinary strings a pair's probability is its
count mixed with what the pair's kinds (capital, small, digit) and its letters without their case say,
so an unseen capital pair is judged by the small one.  Each kind of random string has a model mixed with even odds,
and even odds are a model of their own, for alphabets that no sample has.  How much of the
mixture each count gets is chosen on strings held out by their hash.  A string's score is the log-likelihood
ratio of the likeliest random model against the ordinary one, a character.

*Threshold.*  Calibrated on the held-out strings: a quarter of the way from the score that one ordinary
string in ``1 / FALSE_RATE`` reaches to the score that all but ``LOST_RATE`` of the random ones do.

*Spans.*  Outside the base spans, segments of at least ``MIN_WORD`` letters and digits are scored; neighbours
inside one run of key characters (letters, digits and ``+/_=-``) that all pass, with shorter segments between them, make one
span, if it has ``MIN_RUN`` letters and digits.  So a key is found behind ``name=`` and inside a path, and a base64 key is one span.  Added spans never
touch base spans: what remains of a run beside one is scored by itself.

Cases: NULL or empty text has no span.  Without a random sample (no base match anywhere) the
models add nothing.  Repeated rows are scanned each by itself.  Only doc_id and text are
read, so other columns never clash.  A text is scanned whole, at any length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tierline.llm import common

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
KEY_CHARS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RUN = 16
MIN_WORD = 8
MIN_ASSIGN_VALUE = 12
FALSE_RATE = 0.0005
LOST_RATE = 0.02
#: Weights of the prior that the held-out strings choose from.
WEIGHTS = (1, 4, 16, 64, 256, 1024, 4096)
#: Held out: one string in so many.
FOLDS = 5
#: Scores are counted in steps of this size, up to this score on both sides.
STEP, RANGE = 0.02, 20.0

_CODE = np.full(256, -1, np.int64)  # 0 to 61: letters and digits; 62: other key characters
_CODE[np.frombuffer(KEY_CHARS, np.uint8)] = np.minimum(np.arange(len(KEY_CHARS)), 62)
_SIZE = 62
_START = 62
_KIND = np.repeat([0, 1, 2, 3], [26, 26, 10, 1])  # capital, small, digit, start
_LETTER = np.concatenate((np.arange(26), np.arange(26), np.full(11, 26)))
#: Least probability of a change of kind in an ordinary string.
CHANGE = 0.01


def key_runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of marked bytes; none crosses a document's border."""
    if not len(inside):
        return (np.empty(0, np.int64),) * 2
    first = np.zeros(len(inside) + 1, bool)
    first[off] = True  # a document's first byte, and the end
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, sorted.  ACCESS and HEX ask for the length inside the
    pattern, which finds the same spans: a failing maximal run holds no longer one."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def labelled(text: bytes) -> list[tuple[int, bytes]]:
    """(kind, value) of the random strings that the base patterns prove."""
    values = [(0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN_VALUE]
    return values + [(k, m[0]) for k, p in ((1, ACCESS), (2, HEX)) for m in p.finditer(text)]


def segments(codes: np.ndarray, free: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of letters and digits outside the base spans."""
    return key_runs(free & (codes >= 0) & (codes < _SIZE), off)


def pairs(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the characters of some segments, end to end: (previous, next) as one number, the previous of a
    segment's first being the start mark; and where each segment begins among them."""
    size = ends - starts
    begin = np.concatenate(([0], np.cumsum(size)))[:-1]
    place = np.arange(int(size.sum())) + np.repeat(starts - begin, size)
    before = codes[place - 1]
    before[begin] = _START
    return before * _SIZE + codes[place], begin


def held_out(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a segment's string is held out: equal strings always are alike."""
    total = np.concatenate(([0], np.cumsum((codes + 1) * 2654435761 % 1000003)))
    return (total[ends] - total[starts]) % FOLDS == 0


def blocks_of(batches):
    """(text, base spans, offset) of each document of a block, its character codes, which bytes no base span
    covers, and the documents' offsets."""
    for rows, data, off in common.blocks(batches):
        free = np.ones(len(data), bool)
        found = []
        for i in range(len(off) - 1):
            text = data[off[i]:off[i + 1]].tobytes()
            spans = base_spans(text) if len(text) else []
            for s, _, e in spans:
                free[off[i] + s:off[i] + e] = False
            found.append((text, spans, int(off[i])))
        yield rows, found, _CODE[data], free, off


@dataclass
class Model:
    """Log probabilities of character pairs, one row a random model and the ordinary one last, and
    the score that a segment has to reach."""

    tables: np.ndarray
    least: float = 0.0

    def scores(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        pair, begin = pairs(codes, starts, ends)
        sums = [np.add.reduceat(t[pair], begin) for t in self.tables]
        return (np.max(sums[:-1], axis=0) - sums[-1]) / (ends - starts)

    def score(self, value: bytes) -> float:
        """Of a string of letters and digits."""
        codes = _CODE[np.frombuffer(value, np.uint8)]
        return float(self.scores(codes, np.array([0]), np.array([len(codes)]))[0])


def _prior(n: np.ndarray) -> np.ndarray:
    """What kinds and letters without case say of the next character."""
    kinds = np.zeros((4, 3))
    np.add.at(kinds, (np.repeat(_KIND, _SIZE), np.tile(_KIND[:_SIZE], _SIZE + 1)), n.ravel())
    kinds = (kinds + 0.5) / (kinds + 0.5).sum(axis=1, keepdims=True)
    kinds = np.maximum(kinds, CHANGE)
    kinds /= kinds.sum(axis=1, keepdims=True)
    letters = np.zeros((27, 27))
    np.add.at(letters, (np.repeat(_LETTER, _SIZE), np.tile(_LETTER[:_SIZE], _SIZE + 1)), n.ravel())
    letters = letters[:, :26]
    letters[26] = letters.sum(axis=0)  # after no letter: all
    letters = (letters + 0.5) / (letters + 0.5).sum(axis=1, keepdims=True)
    own = np.where(_LETTER[None, :_SIZE] < 26, letters[_LETTER][:, np.minimum(_LETTER[:_SIZE], 25)], 0.1)
    return kinds[_KIND][:, _KIND[:_SIZE]] * own


def _even(n: np.ndarray) -> np.ndarray:
    return np.full((_SIZE + 1, _SIZE), 1 / _SIZE)


def _mixed(n: np.ndarray, prior, weight: float) -> np.ndarray:
    return (n + weight * prior(n)) / (n.sum(axis=1, keepdims=True) + weight)


def learned(kept: np.ndarray, out: np.ndarray, prior) -> np.ndarray:
    """Log probabilities from the pair counts, with the weight that the held-out counts choose."""
    gain = [(out * np.log(_mixed(kept, prior, w))).sum() for w in WEIGHTS]
    weight = WEIGHTS[int(np.argmax(gain))] if out.any() else WEIGHTS[-1]
    return np.log(_mixed(kept + out, prior, weight)).ravel()


def fit(docs: DataFrame) -> Model | None:
    """The models, from counts over all documents; None when the corpus holds no labelled secret."""
    size = (_SIZE + 1) * _SIZE

    def count(batches):
        total = np.zeros((4, 2, size), np.int64)  # three random kinds, ordinary; kept, held out

        def add(label, codes, starts, ends):
            out = held_out(codes, starts, ends)
            for fold in range(2):
                own = out == bool(fold)
                if own.any():
                    total[label, fold] += np.bincount(pairs(codes, starts[own], ends[own])[0], minlength=size)

        for _, found, codes, free, off in blocks_of(batches):
            starts, ends = segments(codes, free, off)
            runs, stops = key_runs(free & (codes >= 0), off)
            own = np.searchsorted(runs, starts, "right") - 1
            long = (stops - runs)[own] >= MIN_WORD
            add(3, codes, starts[long], ends[long])
            for text, spans, _ in found:
                for kind, value in labelled(text) if spans else []:
                    own = _CODE[np.frombuffer(value, np.uint8)]
                    add(kind, own, *segments(own, np.ones(len(own), bool), np.array([0, len(own)])))
        label, fold, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (label, fold, pair, total[label, fold, pair])],
                                         ["label", "fold", "pair", "n"])

    rows = (common.texts_of(docs).mapInArrow(count, "label long, fold long, pair long, n long")
            .groupBy("label", "fold", "pair").agg(F.sum("n").alias("n")).collect())  # 4 x 2 x 63 x 62 rows at most
    total = np.zeros((4, 2, _SIZE + 1, _SIZE))
    for r in rows:
        total[r["label"], r["fold"]].flat[r["pair"]] = r["n"]
    if not total[:3].any():
        return None
    model = Model(np.array([*(learned(*total[k], _even) for k in range(3)), np.log(_even(None)).ravel(),
                            learned(*total[3], _prior)]))
    model.least = threshold(docs, model)
    return model


def threshold(docs: DataFrame, model: Model) -> float:
    """The score a quarter of the way from the held-out ordinary strings to the held-out random ones, of
    ``MIN_RUN`` characters on."""
    bins = int(2 * RANGE / STEP)

    def count(batches):
        total = np.zeros((2, bins), np.int64)

        def add(label, codes, starts, ends):
            own = ends - starts >= MIN_RUN
            starts, ends = starts[own], ends[own]
            own = held_out(codes, starts, ends)
            score = model.scores(codes, starts[own], ends[own])
            np.add.at(total[label], np.clip(((score + RANGE) / STEP).astype(int), 0, bins - 1), 1)

        for _, found, codes, free, off in blocks_of(batches):
            add(0, codes, *segments(codes, free, off))
            for text, spans, _ in found:
                for _, value in labelled(text) if spans else []:
                    own = _CODE[np.frombuffer(value, np.uint8)]
                    add(1, own, *segments(own, np.ones(len(own), bool), np.array([0, len(own)])))
        label, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (label, place, total[label, place])], ["label", "place", "n"])

    rows = (common.texts_of(docs).mapInArrow(count, "label long, place long, n long")
            .groupBy("label", "place").agg(F.sum("n").alias("n")).collect())  # 2 x bins rows at most
    total = np.zeros((2, bins))
    for r in rows:
        total[r["label"], r["place"]] = r["n"]
    above = np.cumsum(total[0][::-1])[::-1]
    ordinary = (np.flatnonzero(above > FALSE_RATE * above[0]).max() + 1) * STEP - RANGE if above[0] else 0.0
    below = np.cumsum(total[1])
    random = np.flatnonzero(below > LOST_RATE * below[-1]).min() * STEP - RANGE if below[-1] else ordinary
    return ordinary + max(0.0, random - ordinary) / 4


def added_spans(model: Model, codes: np.ndarray, free: np.ndarray, off: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) in bytes of the block: neighbouring random segments of a run of key characters."""
    starts, ends = segments(codes, free, off)
    long = np.flatnonzero(ends - starts >= MIN_WORD)
    good = model.scores(codes, starts[long], ends[long]) >= model.least
    if not good.any():
        return []
    runs, _ = key_runs(free & (codes >= 0), off)
    run = np.searchsorted(runs, starts[long], "right")
    size = np.concatenate(([0], np.cumsum(ends - starts)))
    out = []
    for group in np.split(np.arange(len(long)), np.flatnonzero((np.diff(run) > 0) | ~good[1:] | ~good[:-1]) + 1):
        first, last = long[group[0]], long[group[-1]]
        if good[group[0]] and size[last + 1] - size[first] >= MIN_RUN:
            out.append((int(starts[first]), int(ends[last])))
    return out


def _points(text: bytes, spans):
    """Byte positions as code points."""
    if text.isascii():
        return spans
    at = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    point = lambda i: int(at[i - 1]) if i else 0
    return [(point(s), k, point(e)) for s, k, e in spans]


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, the number of base spans of each kind, and both span lists as text."""
    if model is None:
        model = fit(docs)
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(
        "n_assign long, n_access long, n_hex long, base string, spans string").fields])
    arrow = to_arrow_schema(schema)

    def show(spans):
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    def run(batches):
        for rows, found, codes, free, off in blocks_of(batches):
            more = added_spans(model, codes, free, off) if model else []
            of = np.searchsorted(off, [s for s, _ in more], "right") - 1
            own: dict = {}
            for i, (s, e) in zip(of.tolist(), more):
                own.setdefault(i, []).append((s, e))
            cols: list[list] = [[], [], [], [], []]
            for i, (text, base, at) in enumerate(found):
                kinds = [k for _, k, _ in base]
                for k in range(3):
                    cols[k].append(kinds.count(k))
                spans = sorted(base + [(s - at, 3, e - at) for s, e in own[i]]) if i in own else base
                cols[3].append(show(_points(text, base)) if base else "")
                cols[4].append(show(_points(text, spans)) if spans else "")
            yield pa.RecordBatch.from_arrays([rows.column(0).cast(arrow.field(0).type)] + [
                pa.array(c, type=arrow.field(j + 1).type) for j, c in enumerate(cols)], schema=arrow)

    return common.texts_of(docs).mapInArrow(run, schema)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
