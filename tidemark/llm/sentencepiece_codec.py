"""SentencePiece BPE encoding and decoding with a merge-type prefix table.

For every prefix of a segment the last token of its encoding is unique. The
table holds that token: an Aho-Corasick automaton over the vocabulary reports
all tokens that end at a place, and the one that is compatible with the token
before it (BPE would keep the pair apart) is the one. The ids are then read
backwards from the end. Each prefix is decided once, so the time is linear in
the text, however long a segment is.

No token has a space mark after another character, so a text falls apart
before each run of space marks, and each distinct segment is encoded once per
task (the memo is bounded). Runs of space marks, whose tokens all have one
score, merge greedily from the left. Characters outside the vocabulary become
byte tokens and separate segments.

Defined results: NULL and empty text have no ids and decode to empty; decoding
gives the text back, except that U+2581 comes back as a space. Other columns
are not looked at. The model file is read by the driver (its path is a
parameter) and its vocabulary, of a fixed size, is broadcast.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty

SPACE = "▁"
MEMO = 250_000         # distinct segments remembered per task; others are encoded again
PAIRS = 4_000_000      # remembered answers of the pair test


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, the ids of the byte tokens, the scores, and the unknown id."""
    pieces: tuple[str, ...]
    byte_ids: tuple[int, ...]
    scores: tuple[float, ...]
    ordinary: tuple[bool, ...]
    unknown: int


def load_vocabulary(model_path: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = sp.get_piece_size()
    byte_ids = tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    ordinary = tuple(not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
                     for i in range(n))
    pieces = tuple(sp.id_to_piece(i) for i in range(n))
    if any(ok and SPACE in p.lstrip(SPACE) for p, ok in zip(pieces, ordinary, strict=True)):
        raise ValueError("a piece has a space mark after another character")
    return Vocabulary(pieces, byte_ids, tuple(sp.get_score(i) for i in range(n)), ordinary,
                      sp.unk_id())


class PrefixTableCodec:
    def __init__(self, vocab: Vocabulary):
        import ahocorasick

        self.vocab = vocab
        of = [i for i, ok in enumerate(vocab.ordinary) if ok]
        self.ids = {vocab.pieces[i]: i for i in of}
        self.rank = [0] * len(vocab.pieces)          # 0 merges first
        for r, i in enumerate(sorted(of, key=lambda i: (-vocab.scores[i], i))):
            self.rank[i] = r
        self.runs = sorted((len(p) for p in self.ids if set(p) == {SPACE}), reverse=True)
        self.chars = {p for p in self.ids if len(p) == 1}
        self.split: dict[int, tuple[int, int]] = {}  # token -> the pair it is merged from
        self.merged: dict[tuple[int, int], int] = {}
        self.pairs: dict[int, bool] = {}
        self.memo: dict[str, tuple[str, int, str]] = {}
        self.unknown = re.compile("[^" + re.escape("".join(sorted(self.chars))) + "]")
        self._learn_splits(of)
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if len(p) == 1 or i in self.split:
                self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        self.byte_of = {t: b for b, t in enumerate(vocab.byte_ids)}
        self.size = [len(p) for p in vocab.pieces]
        self.as_id = [str(i) for i in range(len(vocab.pieces))]
        self.as_text = [p.replace(SPACE, " ") if ok else "" for p, ok in
                        zip(vocab.pieces, vocab.ordinary, strict=True)]
        self.as_text[vocab.unknown] = " ⁇ "
        self.lone = self.as_id[self.ids[SPACE]]

    def _learn_splits(self, of: list[int]) -> None:
        """By rank: the two earlier tokens whose merge is the token's last one.
        Tokens that BPE can never reach have none and are left out."""
        for i in sorted(of, key=self.rank.__getitem__):
            p = self.vocab.pieces[i]
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if (a is not None and b is not None and self._usable(a) and self._usable(b)
                        and self.rank_or_char(a) < self.rank[i] and self.rank_or_char(b) < self.rank[i]
                        and self._compatible(a, b)):
                    self.split[i] = (a, b)
                    self.merged[a, b] = i
                    break

    def _usable(self, i: int) -> bool:
        return len(self.vocab.pieces[i]) == 1 or i in self.split

    def rank_or_char(self, i: int) -> int:
        """Single characters are there before any merge."""
        return -1 if len(self.vocab.pieces[i]) == 1 else self.rank[i]

    def _compatible(self, left: int, right: int) -> bool:
        """True if BPE of the two tokens' text ends as exactly these two. Both
        are taken apart in the reverse order of their merges; at no moment may
        the two at the border merge sooner than the merge taken back next. At
        equal rank the left one is first."""
        limit = 1 << 60
        a, b = left, right
        while True:
            m = self.merged.get((a, b))
            if m is not None and 2 * self.rank[m] < limit:
                return False
            ra = 2 * self.rank[a] if a in self.split else -1
            rb = 2 * self.rank[b] + 1 if b in self.split else -1
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, self.split[a][1]
            else:
                limit, b = rb, self.split[b][0]

    def _known(self, s: str) -> list[int]:
        """Encoding of a segment of known characters."""
        if s in self.ids and self._usable(self.ids[s]):
            return [self.ids[s]]
        n = len(s)
        token, start_of = [-1] * n, [0] * n          # last token of each prefix, where it starts
        size, pairs, vocab_size = self.size, self.pairs, len(self.size)
        for end, tok in self.automaton.iter(s):
            if token[end] >= 0:
                continue
            start = end - size[tok] + 1
            if start:
                prev = token[start - 1]
                if prev < 0:
                    continue
                key = prev * vocab_size + tok
                ok = pairs.get(key)
                if ok is None:
                    ok = self._compatible(prev, tok)
                    if len(pairs) < PAIRS:
                        pairs[key] = ok
                if not ok:
                    continue
            token[end] = tok
            start_of[end] = start
        out, at = [], n
        while at:
            out.append(token[at - 1])
            at = start_of[at - 1]
        out.reverse()
        return out

    def _segment(self, s: str) -> list[int]:
        """A segment whose only space mark, if any, is its first character."""
        if self.unknown.search(s) is None:
            return self._known(s)
        out, at = [], 0
        for m in self.unknown.finditer(s):
            if m.start() > at:
                out += self._known(s[at:m.start()])
            out += self._bytes(m.group())
            at = m.end()
        if at < len(s):
            out += self._known(s[at:])
        return out

    def _bytes(self, char: str) -> list[int]:
        ids = [self.vocab.byte_ids[b] for b in char.encode("utf-8")]
        return [self.vocab.unknown] if self.vocab.unknown in ids else ids

    def _run(self, n: int) -> list[int]:
        out = []
        for size in self.runs:
            k, n = divmod(n, size)
            out += [self.ids[SPACE * size]] * k
        return out

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for ids, _, _ in self._parts(text):
            out += map(int, ids.split(","))
        return out

    def _entry(self, ids: list[int]) -> tuple[str, int, str]:
        return ",".join([self.as_id[i] for i in ids]), len(ids), self._text(ids)

    def _parts(self, text: str) -> list[tuple[str, int, str]]:
        """Ids (joined), number of ids and decoded text of each segment."""
        if not text:
            return []
        memo = self.memo
        words = text.replace(SPACE, " ").split(" ")
        out, run = [], 0
        for w in words:
            e = memo.get(w)
            if e is None:
                if not w:
                    run += 1
                    continue
                e = self._entry(self._segment(SPACE + w))
                if len(memo) < MEMO:
                    memo[w] = e
            if run:
                head, _, rest = e[0].partition(",")
                if head == self.lone and e[1] > 1:   # the mark stays alone: part of the run
                    out.append(self._entry(self._run(run + 1)))
                    e = (rest, e[1] - 1, e[2][1:])
                else:
                    out.append(self._entry(self._run(run)))
                run = 0
            out.append(e)
        if run:
            out.append(self._entry(self._run(run)))
        return out

    def _text(self, ids: list[int]) -> str:
        """Text of ids, space marks as spaces, the first one not yet removed."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.as_text[i] for i in ids])
        out, held = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            out.append(self.as_text[i])
        if held:
            out.append(held.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self._text(ids)
        return text[1:] if text.startswith(" ") else text

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the joined ids, SHA-256 of the decoded text)."""
        parts = self._parts(text)
        ids = ",".join([p[0] for p in parts])
        back = "".join([p[2] for p in parts])
        back = back[1:] if back.startswith(" ") else back
        return (sum([p[1] for p in parts]), hashlib.sha256(ids.encode()).hexdigest(),
                hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())


def _shared(spark: SparkSession, model_path: str):
    return spark.sparkContext.broadcast(load_vocabulary(model_path))


def token_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    vocab = _shared(docs.sparkSession, model_path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = PrefixTableCodec(vocab.value)
        for texts in batches:
            yield pd.DataFrame([codec.digest(t) for t in texts],
                               columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col(id_col).alias("doc_id"),
                        digest(text_or_empty(F.col(text_col))).alias("d"))
            .select("doc_id", "d.*"))


def encode_texts(docs: DataFrame, model_path: str, text_col: str = "text",
                 out_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of each text in ``out_col``."""
    vocab = _shared(docs.sparkSession, model_path)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = PrefixTableCodec(vocab.value)
        for texts in batches:
            yield pd.Series([codec.encode(t) for t in texts])

    return docs.withColumn(out_col, encode(text_or_empty(F.col(text_col))))


def decode_ids(docs: DataFrame, model_path: str, ids_col: str = "ids",
               out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of each list of ids in ``out_col`` (NULL list: empty)."""
    vocab = _shared(docs.sparkSession, model_path)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = PrefixTableCodec(vocab.value)
        for lists in batches:
            yield pd.Series([codec.decode([] if x is None else [int(i) for i in x]) for x in lists],
                            dtype=object)

    return docs.withColumn(out_col, decode(F.col(ids_col)))
