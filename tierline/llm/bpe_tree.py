"""BPE encoding and decoding, long texts by tree concatenation.

Texts up to ``long_chars`` are encoded word by word: the tokenizer never joins across ASCII
blanks, so each different blank-free piece is encoded once and remembered by the worker, up to a bound.  A longer text is normalised once, cut into
halves, halves of halves and so on down to ``leaf_chars``; the leaves are rows of their own,
spread over all tasks.  Then neighbours are joined pairwise up the tree.  At each join a
window around the cut is encoded anew and grows until it agrees exactly with both sides:
until it has a token in common (same id, same place) with the left tokens before the cut
and one with the right tokens behind it.  The joined tokens are the left ones up to the first
common token, the window's up to the second, and the right ones from there.  A BPE encoding
is right exactly when each neighbouring pair of its tokens is, and every pair in the result
is a pair of one of the three encodings; a window that reaches both ends is the encoding
itself.  Special tokens written out in a text split it first, as the library does.

Cases: NULL is the empty text and has no token; so has blank text.  Repeated rows each get a
row.  Only doc_id and text are read.  The tokenizer file is a parameter; its content travels
to the workers.
"""

from __future__ import annotations

import hashlib
import re
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from tierline.llm.common import table, texts_of, with_columns, written

TOKENIZER = "word_bpe_49k.json"
LONG_CHARS = 1 << 16
LEAF_CHARS = 1 << 14
WINDOW = 64
#: Pieces that a worker remembers in each of two generations.  When the new one is full it becomes the old one, and
#: what is used of that is taken over: frequent pieces stay.  They lie beside the executor's heap, also between tasks
#: and while the worker does other work: about 300 bytes a piece.
CACHE_PIECES = 1 << 19
#: Characters of the pieces in a generation, for each piece that it may hold.
PIECE_CHARS = 16
#: Text bytes encoded at once.
BLOCK = 1 << 20
_BLANKS = "\t\n\x0b\x0c\r"


def tokenizer_json(name: str = TOKENIZER) -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


class Encoder:
    """The library's tokenizer, and the same one without its normalizer for parts of a text
    that is normalised already."""

    def __init__(self, content: str, digests: bool = False, pieces: int | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(content)
        self.whole.no_truncation()
        self.whole.no_padding()
        self._content = content
        special = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.special = special
        self.digests = digests
        self.pieces = pieces
        self.seen: dict[str, tuple] = {}
        self.older: dict[str, tuple] = {}
        self.chars = 0  # of the pieces in ``seen``
        self.numbers: dict[int, int] = {}  # one object for each id
        names = sorted(special, key=lambda s: (-len(s), s))
        self.split = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    @cached_property
    def part(self):
        """Loaded when the first leaf or window is encoded: most tasks see none."""
        from tokenizers import Tokenizer

        part = Tokenizer.from_str(self._content)
        part.no_truncation()
        part.no_padding()
        part.normalizer = None
        part.encode_special_tokens = True  # special tokens were split off before
        return part

    def encode_texts(self, texts: list[str]) -> list[tuple[list, list[str]]]:
        """For each text its pieces' ids (tuples, or text when ``digests``) and decoded text;
        pieces without a token are left out."""
        split = []
        for text in texts:
            for blank in _BLANKS:
                text = text.replace(blank, " ")
            split.append(text.split(" "))
        self._remember(split)
        out = []
        for own in split:
            ids, decoded = zip(*map(self.seen.__getitem__, own))
            if None in decoded:
                ids, decoded = [i for i in ids if i is not None], [d for d in decoded if d is not None]
            out.append((ids, decoded))
        return out

    def _remember(self, split: list[list[str]]) -> None:
        most = CACHE_PIECES if self.pieces is None else self.pieces
        wanted = set().union(*split) - self.seen.keys()
        chars = sum(map(len, wanted))
        if len(self.seen) + len(wanted) > most or self.chars + chars > most * PIECE_CHARS:
            self.older, self.seen, self.chars = self.seen, {}, 0
            wanted = set().union(*split)
            chars = sum(map(len, wanted))
        self.chars += chars
        again = wanted & self.older.keys()
        self.seen.update((piece, self.older[piece]) for piece in again)
        new = list(wanted - again)
        for i in range(0, len(new), 4096):
            some = new[i:i + 4096]
            ids = [e.ids for e in self.whole.encode_batch_fast(some, add_special_tokens=False)]
            decoded = self.whole.decode_batch(ids, skip_special_tokens=False)
            for piece, own, text in zip(some, ids, decoded):
                self.seen[piece] = (self._held(own), text) if own else (None, None)

    def _held(self, ids: list[int]) -> str | tuple:
        return " ".join(map(str, ids)) if self.digests else tuple(map(self.numbers.setdefault, ids, ids))

    def sections(self, text: str) -> list[tuple[int | None, str]]:
        """(special id, "") or (None, normalised text), in the order of the text."""
        parts = self.split.split(text) if self.split else [text]
        norm = self.whole.normalizer
        return [(self.special[p], "") if i % 2 else (None, norm.normalize_str(p) if norm else p)
                for i, p in enumerate(parts) if p]

    def tokens(self, text: str, at: int = 0) -> list[tuple]:
        """Units (ids, start, end) of a normalised text; tokens that share a character make
        one unit."""
        enc = self.part.encode(text, add_special_tokens=False)
        units: list = []
        for i, (s, e) in zip(enc.ids, enc.offsets):
            if units and s + at < units[-1][2]:
                ids, start, end = units[-1]
                units[-1] = (ids + (i,), start, max(end, e + at))
            else:
                units.append(((i,), s + at, e + at))
        return units

    def join(self, text: str, at: int, left: list, right: list, cut: int, end: int, window: int = WINDOW) -> list:
        """Units of text[at:end] from those of text[at:cut] and text[cut:end]."""
        while True:
            lo, hi = max(at, cut - window), min(end, cut + window)
            mid = self.tokens(text[lo:hi], lo)
            if lo == at:
                i = i_mid = 0
            else:
                place = {u: k for k, u in enumerate(mid)}
                i = _first(left, lo)
                while i < len(left) and (left[i] not in place or left[i][2] > cut):
                    i += 1
                i_mid = place[left[i]] if i < len(left) else None
            if hi == end:
                j, j_mid = len(right), len(mid)
            else:
                place = {u: k for k, u in enumerate(right[:_first(right, hi)])}
                j_mid = len(mid) - 1
                while j_mid >= 0 and (mid[j_mid] not in place or mid[j_mid][1] < cut):
                    j_mid -= 1
                j = place[mid[j_mid]] if j_mid >= 0 else None
            if i_mid is not None and j is not None and i_mid <= j_mid:
                return left[:i] + mid[i_mid:j_mid] + right[j:]
            window *= 2

    def build(self, text: str, at: int, end: int, leaf: int, leaves: dict, window: int = WINDOW) -> list:
        if end - at <= leaf:
            return leaves[at]
        cut = (at + end) // 2
        left = self.build(text, at, cut, leaf, leaves, window)
        return self.join(text, at, left, self.build(text, cut, end, leaf, leaves, window), cut, end, window)


@lru_cache(maxsize=1)
def worker_encoder(content: str, digests: bool = False, pieces: int | None = None) -> Encoder:
    """The encoder of this Python worker: loaded, and its pieces remembered, over the worker's tasks."""
    return Encoder(content, digests, pieces)


def _first(units: list, position: int) -> int:
    """Index of the first unit that starts at the position or behind it."""
    lo, hi = 0, len(units)
    while lo < hi:
        mid = (lo + hi) // 2
        if units[mid][1] < position:
            lo = mid + 1
        else:
            hi = mid
    return lo


def leaf_ranges(at: int, end: int, leaf: int) -> list[tuple[int, int]]:
    if end - at <= leaf:
        return [(at, end)]
    cut = (at + end) // 2
    return leaf_ranges(at, cut, leaf) + leaf_ranges(cut, end, leaf)


def encode_long(encoder: Encoder, text: str, leaf: int = LEAF_CHARS, window: int = WINDOW) -> list[int]:
    """The tree for one text in one place: what :func:`encode` does over rows."""
    ids: list[int] = []
    for special, part in encoder.sections(text):
        if special is not None:
            ids.append(special)
            continue
        leaves = {a: encoder.tokens(part[a:b], a) for a, b in leaf_ranges(0, len(part), leaf)}
        ids += [i for u in encoder.build(part, 0, len(part), leaf, leaves, window) for i in u[0]]
    return ids


def encode(docs: DataFrame, content: str | None = None, long_chars: int = LONG_CHARS,
           leaf_chars: int = LEAF_CHARS, digests: bool = False, pieces: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (array of int) and decoded (text); with ``digests`` the SHA-256 of
    the ids, written with one blank between, and of the decoded text in their place.  ``pieces`` is what a worker remembers in place of ``CACHE_PIECES``."""
    content = content or tokenizer_json()
    docs = docs.select("doc_id", "text")
    is_long = F.length("text") > long_chars
    fields = "n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")

    def row(ids: list, decoded: list[str]) -> tuple:
        """Output columns from pieces of ids and of decoded text."""
        text = " ".join(decoded)
        if not digests:
            flat = np.fromiter(chain.from_iterable(ids), np.int32)
            return len(flat), flat, text
        numbers = " ".join(ids)
        return (numbers.count(" ") + 1 if numbers else 0, hashlib.sha256(numbers.encode()).hexdigest(),
                hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())

    def start():
        enc = worker_encoder(content, digests, pieces)

        def handle(data, off):
            raw = data.tobytes()
            texts = [raw[off[i]:off[i + 1]].decode("utf-8", "replace") for i in range(len(off) - 1)]
            return list(zip(*(row(*found) for found in enc.encode_texts(texts))))
        return handle

    short = with_columns(docs.filter(~F.coalesce(is_long, F.lit(False))), start, fields, BLOCK)
    key = docs.schema["doc_id"].dataType
    leaf_schema = StructType.fromDDL("row long, section int, special int, at int, size int, text string").add("doc_id", key)
    leaf_arrow = to_arrow_schema(leaf_schema)

    def cut(batches):
        for batch in batches:
            enc = worker_encoder(content, digests, pieces)
            for doc, text, row in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                for k, (special, part) in enumerate(enc.sections(text)):
                    for a, b in leaf_ranges(0, len(part), leaf_chars) if special is None else [(0, 0)]:
                        rows.append({"row": row, "section": k, "special": special, "at": a, "size": len(part),
                                     "text": part[a:b], "doc_id": doc})
                yield pa.RecordBatch.from_pylist(rows, schema=leaf_arrow)

    long = texts_of(docs.filter(is_long)).withColumn("row", F.monotonically_increasing_id())
    leaves = written(long.mapInArrow(cut, leaf_schema), "bpe-leaves")
    unit_schema = StructType([*leaf_schema.fields, *StructType.fromDDL(
        "ids array<array<int>>, starts array<int>, ends array<int>").fields])
    unit_arrow = to_arrow_schema(unit_schema)

    def encode_leaves(batches):
        for batch in batches:
            enc = worker_encoder(content, digests, pieces)
            for i in range(batch.num_rows):  # one leaf at a time bounds the units held
                r = batch.slice(i, 1).to_pylist()[0]
                units = enc.tokens(r["text"], r["at"]) if r["special"] is None else []
                r |= {"ids": [list(u[0]) for u in units], "starts": [u[1] for u in units], "ends": [u[2] for u in units]}
                yield pa.RecordBatch.from_pylist([r], schema=unit_arrow)

    out_schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(fields).fields])
    out_arrow = to_arrow_schema(out_schema)

    def join(group):
        enc = worker_encoder(content, digests, pieces)
        ids: list[int] = []
        rows = group.sort_by([("section", "ascending"), ("at", "ascending")]).to_pylist()
        sections: dict[int, list] = {}
        for r in rows:
            sections.setdefault(r["section"], []).append(r)
        for own in sections.values():
            if own[0]["special"] is not None:
                ids.append(own[0]["special"])
                continue
            text = "".join(r["text"] for r in own)
            units = {r["at"]: [(tuple(i), s, e) for i, s, e in zip(r["ids"], r["starts"], r["ends"])] for r in own}
            ids += [i for u in enc.build(text, 0, len(text), leaf_chars, units) for i in u[0]]
        decoded = enc.whole.decode(ids, skip_special_tokens=False)
        found = row([" ".join(map(str, ids))] if digests else [ids], [decoded])
        return pa.table([[v] for v in (rows[0]["doc_id"], *found)], schema=out_arrow)

    # Given numbers: leaves and texts are few bytes and much work, so Spark must not coalesce their tasks.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    encoded = leaves.repartition(tasks, "row", "section", "at").mapInArrow(encode_leaves, unit_schema)
    return short.unionByName(encoded.repartition(tasks, "row").groupBy("row").applyInArrow(join, out_schema))


def op9_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), digests=True)
