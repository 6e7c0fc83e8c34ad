"""Quality rules as weak supervision.

Each rule votes on every document: good, bad, or abstain. Nobody says how far
a rule can be trusted: expectation-maximisation estimates, from the documents,
the share of good documents and for each rule how often it votes good, bad or
abstains on good and on bad documents. A document stays when its posterior
probability of being good reaches the threshold; one odd vote does not reject
it as an all-must-pass filter would, unless that vote is worth it.

What the estimation needs is the number of documents per pattern of votes, at
most 3^rules rows whatever the number of documents. The counts come from one
aggregation over all rows that pass the base rule; the others are rejected
anyway, and would teach what votes on short junk mean. Copies and near copies count
about once: what is counted are distinct min-hashes of five-word shingles, which
two texts share as often as their sets overlap. Priors say what is expected of any
rule (bad documents fail one or two of ten, good ones few) and weigh ``PRIOR_SHARE``
of the documents, so the data overrule them: a rule that votes bad at random on
both classes is estimated so, and its vote then moves the posterior little.

Defined results: NULL or empty text has no words, fails the base rule and is
rejected; repeated rows and ties get equal verdicts; an empty table gives no
rows (the estimates are then the priors); other columns, whatever their names,
are kept as they are. Texts are processed whole. Words are
runs of anything but ASCII white space.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, text_or_empty

BAD, ABSTAIN, GOOD = 0, 1, 2
THRESHOLD = 0.5
PRIOR_SHARE = 0.1                      # weight of the priors, as a share of the documents
EXPECTED = np.array([[0.15, 0.10, 0.75],       # bad, abstain, good votes on bad documents
                     [0.01, 0.09, 0.90]])      # and on good ones
GOOD_SHARE = 0.9
WINDOW = 8
SHINGLE = 5

STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "n_lines long, n_upper long, n_exclaim long, n_same_next long, n_distinct long, "
         "n_punct long, sketch long")
SYMBOLS = "#*$%&|<>"
PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3],
               dtype=np.uint64)


def repeated_window_words(ids: np.ndarray) -> int:
    """Words that lie in an 8-word window found twice or more, exactly. Word
    ids are first compared by a hash of each window; only if two hashes are
    equal are windows numbered exactly, by doubling (1, 2, 4, 8 words)."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    u = ids.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        h += (u[k:k + n] + np.uint64(1)) * MIX[k]
    h.sort()
    if not (h[1:] == h[:-1]).any():
        return 0
    width, names = 1, ids.astype(np.int64)
    while width < WINDOW:
        pair = names[:-width] * (int(names.max()) + 1) + names[width:]
        names = np.unique(pair, return_inverse=True)[1]
        width *= 2
    twice = np.bincount(names)[names] > 1
    cover = np.zeros(len(ids) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def near_copy_sketch(words: list[bytes], ids: np.ndarray) -> int:
    """The smallest hash of a five-word shingle (of fewer words, of all). ``words``
    are the distinct ones, ``ids`` their places."""
    if not len(ids):
        return 0
    u = np.fromiter(map(crc32, words), np.uint64, len(words))[ids]
    n = max(1, len(u) - SHINGLE + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(u))):
        h += (u[k:k + n] + np.uint64(1)) * MIX[k]
    h ^= h >> np.uint64(29)
    h *= MIX[5]
    return int(h.min().view(np.int64))


def text_stats(text: str | None) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()                      # ASCII white space, as bytes
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (len(words), len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r"),
            sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
            repeated_window_words(ids), len(lines), sum(map(bytes.isupper, words)),
            text.count("!"), int((ids[1:] == ids[:-1]).sum()), len(numbers),
            len(data) - len(data.translate(None, PUNCT)), near_copy_sketch(list(numbers), ids))


def stats_of(texts: pd.Series) -> pd.DataFrame:
    names = [x.split()[0] for x in STATS.split(", ")]
    return pd.DataFrame([text_stats(t) for t in texts], columns=names, dtype="int64")


@dataclass(frozen=True)
class Rule:
    """Bad if ``bad`` holds, else good if ``good`` holds, else it abstains
    (SQL over the columns of STATS)."""
    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 20", "n_words >= 50"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 12 * n_words",
         "word_chars between 4 * n_words and 7 * n_words"),
    Rule("symbols", "n_symbols > 0.2 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule("punctuation", "n_punct > 0.35 * word_chars", "n_punct <= 0.1 * word_chars"),
    Rule("shouting", "n_words >= 10 and n_upper > 0.6 * n_words", "n_upper <= 0.2 * n_words"),
    Rule("exclamation", "n_words >= 10 and n_exclaim > 0.5 * n_words",
         "n_exclaim <= 0.05 * n_words"),
    Rule("stutter", "n_words >= 10 and n_same_next > 0.25 * n_words",
         "n_same_next <= 0.08 * n_words"),
    Rule("vocabulary", "n_words >= 30 and n_distinct < 2 * sqrt(n_words)",
         "n_distinct > least(5 * sqrt(n_words), 0.7 * n_words)"),     # the second below 51 words
    # these two are seen on clean texts as well; what they are worth is estimated
    Rule("repeated_windows", "n_repeat_words > 0.1 * n_words", "n_repeat_words <= 0.02 * n_words"),
    Rule("repeated_lines", "n_lines >= 5 and n_dup_lines > 0.1 * n_lines", "n_dup_lines = 0"),
)
BASE_FAILED = "n_words < 20 or 100 * n_repeat_words > 30 * n_words"


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Whole rows (``row``), their statistics (``st``), the code of their votes
    in base 3 (``votes``) and whether they fail the base rule. The statistics are
    marked as not deterministic, or filters on them would compute them again."""
    stats = F.pandas_udf(stats_of, STATS).asNondeterministic()
    rows = docs.select(F.struct("*").alias("row"), stats(text_or_empty(F.col(text_col))).alias("st"))
    vote = " + ".join(f"{3 ** i} * (case when {r.bad} then {BAD} when {r.good} then {GOOD} "
                      f"else {ABSTAIN} end)" for i, r in enumerate(RULES))
    return (rows.select("row", "st", "st.*")
            .select("row", "st", F.expr(vote).cast("int").alias("votes"),
                    F.expr(BASE_FAILED).alias("base_failed")))


@dataclass(frozen=True)
class LabelModel:
    """``good``: the share of good documents. ``by_rule[i][c][v]``: how often
    rule i votes v on documents of class c (0 bad, 1 good)."""
    good: float
    by_rule: np.ndarray

    def logit(self, votes: Column) -> Column:
        """Log odds of being good, from the votes' code."""
        out = F.lit(math.log(self.good / (1 - self.good)))
        for i, table in enumerate(self.by_rule):
            odds = np.log(table[1] / table[0])
            vote = (F.floor(votes / 3 ** i) % 3 + 1).cast("int")
            out = out + F.element_at(F.array(*[F.lit(float(x)) for x in odds]), vote)
        return out


def fit_label_model(patterns: dict[int, float], n_rules: int, rounds: int = 500) -> LabelModel:
    """EM over counts of vote patterns, from the priors."""
    codes = np.array(sorted(patterns), dtype=np.int64)
    counts = np.array([patterns[c] for c in codes], dtype=float)
    votes = (codes[:, None] // 3 ** np.arange(n_rules)) % 3
    seen = np.stack([votes == v for v in (BAD, ABSTAIN, GOOD)], axis=2).astype(float)
    weight = max(PRIOR_SHARE * counts.sum(), 1.0)
    prior = weight * EXPECTED
    good, table = GOOD_SHARE, np.tile(EXPECTED, (n_rules, 1, 1))
    for _ in range(rounds):
        by_class = np.einsum("pjv,jcv->pc", seen, np.log(table)) + np.log([1 - good, good])
        by_class -= by_class.max(axis=1, keepdims=True) if len(codes) else 0
        post = np.exp(by_class)
        post = post / post.sum(axis=1, keepdims=True) * counts[:, None]
        new = np.einsum("pc,pjv->jcv", post, seen) + prior
        new /= new.sum(axis=2, keepdims=True)
        share = float((post[:, 1].sum() + weight * GOOD_SHARE) / (counts.sum() + weight))
        done = abs(share - good) < 1e-9 and np.abs(new - table).max() < 1e-9
        good, table = share, new
        if done:
            break
    return LabelModel(good, table)


def _fit(scored: DataFrame) -> LabelModel:
    patterns = (scored.filter(~F.col("base_failed")).groupBy("votes")
                .agg(F.countDistinct("st.sketch").alias("n")).collect())      # at most 3^rules rows
    return fit_label_model({r["votes"]: float(r["n"]) for r in patterns}, len(RULES))


def _kept(model: LabelModel, threshold: float) -> tuple[Column, Column]:
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-model.logit(F.col("votes"))))
    return p.alias("p_good"), (~F.col("base_failed") & (p >= threshold)).alias("kept")


def quality_verdicts(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, the statistics, base_failed, n_bad_votes, p_good and kept of every row."""
    scored = checkpointed(with_stats(docs.select(id_col, text_col), text_col)
                          .select(F.col(f"row.{id_col}").alias("doc_id"), "st", "votes", "base_failed"))
    p_good, kept = _kept(_fit(scored), threshold)
    bad = sum(((F.floor(F.col("votes") / 3 ** i) % 3 == BAD).cast("long") for i in range(len(RULES))), F.lit(0))
    return scored.select("doc_id", "st.*", "base_failed", bad.cast("long").alias("n_bad_votes"), p_good,
                         kept).drop("sketch")


def keep_good(docs: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the rules reject. The statistics are
    computed once in each of two passes (estimate, then judge) rather than storing
    or shuffling the texts in between."""
    p_good, kept = _kept(_fit(with_stats(docs.select(text_col), text_col)), threshold)
    return with_stats(docs, text_col).filter(kept).select("row.*")
