"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over the pieces reports, in one pass over a text, every piece that ends at
a position: the longest first, then along the output links. Each of them relaxes the best way to reach
that position.

- Unigram models: the best way has the largest sum of piece scores (Viterbi). A character that is no
  piece stands alone.
- BPE models: scores are merge ranks, and their sum says nothing about merge order (the sums' best
  segmentation differs from the model's own in most longer words). The same pass then relaxes a
  position from the first piece that may follow the piece before it, that is, whose pair with it
  merges back into just these two. The pieces found so are the ones that merging in rank order gives.

The text is cut where no piece can lie across: before a space mark, at characters that are in no
longer piece, and between a word's letters and the punctuation after them, if no piece holds such a pair.
Each worker remembers the ids of a bounded number of such words. A narrow map over whole
texts: no exchange.

Characters outside the vocabulary become byte pieces where the model has them, else the unknown id.
Decoding gives back the normalised text; for models without normalisation that is the text itself,
save that the space mark U+2581 in a text comes back as a space.

Defined cases: null and empty texts have no ids and decode to an empty text; repeated rows are encoded
one by one; an empty table gives an empty result; input columns named like a result give way; ids
outside the vocabulary raise an error.
"""

from __future__ import annotations

import re
from functools import cache
from string import punctuation

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.arrays import append_columns
from tickloom.llm.recent import Computed
from tickloom.session import ship

SPACE = "▁"
MOST_WORDS = 150_000
MOST_PAIRS = 300_000


class Following(dict):
    """Of one piece, or of a word's start (-1): by id, whether that piece may follow it, computed when first asked for."""

    __slots__ = ("vocabulary", "id", "length")

    def __init__(self, vocabulary: Vocabulary, id: int, length: int):
        super().__init__()
        self.vocabulary, self.id, self.length = vocabulary, id, length

    def __missing__(self, right: int) -> bool:
        found = self.vocabulary.may_follow(self.id, right)
        self[right] = found
        return found


class Vocabulary:
    """Pieces and scores of a model file, read through the public library."""

    def __init__(self, path: str, kind: str | None = None):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        self.kind = kind or ("bpe" if model.trainer_spec.model_type == proto.TrainerSpec.BPE else "unigram")
        self.way = self._by_merges if self.kind == "bpe" else self._by_scores
        self.normalize = None
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            self.normalize = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString()).normalize
        self.prefix = SPACE if model.normalizer_spec.add_dummy_prefix else ""
        types = proto.ModelProto.SentencePiece
        usable = (types.NORMAL, types.USER_DEFINED, types.UNUSED)
        self.pieces = [p.piece for p in model.pieces]
        self.scores = [p.score for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in usable and p.piece}
        self.unknown = next((i for i, p in enumerate(model.pieces) if p.type == types.UNKNOWN), 0)
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == types.BYTE}
        silent = {i for i, p in enumerate(model.pieces) if p.type == types.CONTROL}
        self.spelled = [b"" if i in silent else p.encode() for i, p in enumerate(self.pieces)]  # what an id decodes to
        self.spelled[self.unknown] = " ⁇ ".encode()
        for b, i in self.bytes.items():
            self.spelled[i] = bytes([b])
        self.ranks = {p: self.scores[i] for p, i in self.ids.items()}
        self.letters = {p for p in self.ids if len(p) == 1}
        self.start = Following(self, -1, 0)
        self.follows = [self.start]
        self.pairs = 0
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.follows.append(Following(self, i, len(piece)))
            self.automaton.add_word(piece, (i, len(piece), self.follows[-1]))
        self.automaton.make_automaton()
        longer = "".join(p for p in self.ids if len(p) > 1)
        # white space other than the mark, if it is in no longer piece, stands alone
        alone = "".join(c for c in "\n\t\r" if c not in longer)
        inner = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        # letters and digits that stand before punctuation in a piece are not cut from it
        bound = {a for p in self.ids for a, b in zip(p, p[1:]) if a.isalnum() and b in punctuation}
        run = f"[^\\W_{''.join(sorted(bound))}]++(?=[{SPACE}{alone}{re.escape(punctuation)}]|\\Z)"
        whole = f"{SPACE}*(?:{run}|[^{SPACE}{alone}]+)|{SPACE}+|[{alone or chr(0)}]"
        self.words = None if inner else re.compile(whole, re.S)
        self.known = Computed(MOST_WORDS, self._word_ids)

    # -- one word -------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Pieces after merging the neighbours of the best score, leftmost first, as long as any merge."""
        rank, never = self.ranks, float("-inf")
        parts = list(text)
        scores = [rank.get(a + b, never) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > never:
            k = scores.index(best)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = rank.get(parts[k - 1] + parts[k], never)
            if k < len(scores):
                scores[k] = rank.get(parts[k] + parts[k + 1], never)
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' characters gives back the two pieces; -1 stands for a word's start."""
        if self.pairs >= MOST_PAIRS:
            for known in self.follows:
                known.clear()
            self.pairs = 0
        self.pairs += 1
        a, b = self.pieces[left] if left >= 0 else "", self.pieces[right]
        return self.merged(a + b) == ([a, b] if a else [b])

    def _by_merges(self, word: str) -> list[int]:
        """Of a word of known characters: each beginning has one last piece, the longest that may follow."""
        n = len(word)
        last = [None] * n + [self.start]  # by the place of its last character; a word's start is at -1
        for end, (i, length, piece) in self.automaton.iter(word):
            if last[end] is None and (before := last[end - length]) is not None and before[i]:
                last[end] = piece
        out, end = [], n - 1
        while end >= 0:
            piece = last[end]
            out.append(piece.id)
            end -= piece.length
        return out[::-1]

    def _by_scores(self, word: str) -> list[int]:
        """Of a word of known characters: the pieces with the largest sum of scores."""
        n, scores = len(word), self.scores
        best, last, size = [0.0] + [float("-inf")] * n, [0] * (n + 1), [0] * (n + 1)
        for end, (i, length, _) in self.automaton.iter(word):
            end += 1
            if (score := best[end - length] + scores[i]) > best[end]:
                best[end], last[end], size[end] = score, i, length
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        return out[::-1]

    def segment(self, word: str) -> list[int | str]:
        """Piece ids; a character that is no piece stands for itself."""
        way = self.way
        out: list[int | str] = []
        at = 0
        for k, c in enumerate(word):
            if c not in self.letters:
                out += way(word[at:k]) if k > at else []
                out.append(c)
                at = k + 1
        return out + (way(word[at:]) if at < len(word) else [])

    def _word_ids(self, word: str) -> bytes:
        if self.letters.issuperset(word):
            return np.array(self.way(word), "<u4").tobytes()
        ids = []
        for x in self.segment(word):
            if isinstance(x, int):
                ids.append(x)
            elif self.bytes:
                ids.extend(self.bytes[b] for b in x.encode("utf-8"))
            else:
                ids.append(self.unknown)
        return np.array(ids, "<u4").tobytes()

    # -- texts ----------------------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        if self.normalize:
            marked = self.normalize(text)
        else:
            marked = self.prefix + text.replace(" ", SPACE)
        words = self.words.findall(marked) if self.words else [marked]
        return np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4")

    def decode(self, ids) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


@cache
def vocabulary(path: str, kind: str | None = None) -> Vocabulary:
    return Vocabulary(path, kind)


def encode(docs: DataFrame, model: str, text: str = "text", kind: str | None = None) -> DataFrame:
    """`docs` with `ids` (little-endian 32-bit numbers) and `n_tokens`."""

    def rows(data: np.ndarray, offsets: np.ndarray, _: pa.RecordBatch) -> dict:
        coder, raw = vocabulary(model, kind), data.tobytes()
        ids = [coder.encode(raw[a:b].decode("utf-8")) for a, b in zip(offsets[:-1], offsets[1:])]
        return {"ids": pa.array([x.tobytes() for x in ids], pa.binary()), "n_tokens": pa.array([len(x) for x in ids], pa.int64())}

    return append_columns(docs, text, "ids binary, n_tokens long", rows)


def decode(docs: DataFrame, model: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`docs` with the text of binary ids, null where they are null."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def texts(column):
        coder = vocabulary(model)
        return column.map(lambda x: None if x is None else coder.decode(np.frombuffer(x, "<u4").tolist()))

    return docs.withColumn(out, texts(F.col(f"`{ids}`")))
