"""Token counts by a count-only Viterbi search.

The vocabulary of a public tokenizer file is read as a unigram vocabulary (pieces and their
stored scores).  An Aho-Corasick automaton enumerates every piece at every place; dynamic
programming carries only the best score and its number of pieces to each place.  The rules
are those of the exact unigram tokenizer: blanks become the blank mark, one is put in front;
a character that is no piece itself costs the least score less 10 and counts its UTF-8 bytes
(byte fallback); among equal scores the piece that starts first wins, so a longer piece
beats a shorter one.  Scores are added as doubles, exactly for the integer scores of the file.

No piece of the vocabulary holds the blank mark behind another character, so the best path
falls apart at each blank and equal words are searched once a task.  For a vocabulary where
that is not so, the whole text is searched in one.

Cases: NULL and empty text have no token and score 0.  Repeated rows are counted each by
itself.  Only doc_id and text are read.  A text is searched whole, at any length.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tierline.llm.common import table, with_columns

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words that a task remembers; the memory starts anew beyond it.
CACHE_WORDS = 1 << 18


def load_vocabulary(name: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces, in the order of their ids."""
    import public_tokenizers
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())
            if not (m.is_control(i) or m.is_byte(i) or m.is_unknown(i) or m.is_unused(i))]


class CountViterbi:
    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in vocabulary if len(p) == 1}
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.splits = not any(MARK in p.lstrip(MARK) for p, _ in vocabulary)
        self.parts = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.seen: dict[str, tuple[float, int]] = {}

    def search(self, s: str) -> tuple[float, int]:
        """(best score, its pieces) of one marked string."""
        n = len(s)
        score: list = [None] * (n + 1)
        count = [0] * (n + 1)
        score[0] = 0.0
        done = 0  # places up to here are final

        def unknowns(upto):
            # The one-character fallback comes after all pieces that end at the same place.
            nonlocal done
            while done < upto:
                done += 1
                c = s[done - 1]
                if c not in self.single:
                    new = score[done - 1] + self.unknown
                    if score[done] is None or new > score[done]:
                        score[done], count[done] = new, count[done - 1] + len(c.encode("utf-8", "surrogatepass"))

        for last, (length, piece_score) in self.automaton.iter(s):  # by end, longest piece first
            end = last + 1
            if end - 1 > done:
                unknowns(end - 1)
            start = end - length
            new = score[start] + piece_score
            if score[end] is None or new > score[end]:
                score[end], count[end] = new, count[start] + 1
        unknowns(n)
        return score[n], count[n]

    def text(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        marked = MARK + text.replace(" ", MARK)
        if not self.splits:
            return self.search(marked)
        total, pieces, seen = 0.0, 0, self.seen
        for part in self.parts.findall(marked):
            found = seen.get(part)
            if found is None:
                if len(seen) >= CACHE_WORDS:
                    seen.clear()
                found = seen[part] = self.search(part)
            total += found[0]
            pieces += found[1]
        return total, pieces


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]] | None = None) -> DataFrame:
    """doc_id, n_tokens and score of the best segmentation."""
    vocabulary = vocabulary or load_vocabulary()

    def start():
        viterbi = CountViterbi(vocabulary)

        def handle(data, off):
            raw = data.tobytes()
            found = [viterbi.text(raw[off[i]:off[i + 1]].decode("utf-8", "replace")) for i in range(len(off) - 1)]
            return [[n for _, n in found], [s for s, _ in found]]
        return handle

    return with_columns(docs, start, "n_tokens long, score double")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
