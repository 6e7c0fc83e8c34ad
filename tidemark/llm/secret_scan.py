"""Secret scan: fixed patterns, and a battery of randomness tests for tokens
that no pattern names. Built-in functions only.

Patterns, leftmost and non-overlapping per kind: assignments to a name such as
``token`` (value of 12 or more characters), access key ids (18 or more), and
lower-case hexadecimal runs (16 or more).

Every other token that would carry ``MIN_BITS`` of randomness if it were random is
tested: 11 characters of base64, 14 letters, 16 hexadecimal digits. Its encoding is
inferred from its characters. Under the hypothesis that it is uniformly random in
its alphabet, four tests give p-values: chi-squared uniformity over equal parts of
the alphabet, the Wald-Wolfowitz runs test about its middle, lag-1 serial
correlation, and a directed test of uniformity: how much likelier the token's pairs
of characters are among all long tokens of the corpus than in a random token, a sum
whose mean and variance under randomness are exact. Words, names and paths look
even to the first three when they are short; the last one tells them by their
spelling, whatever the language. The four are combined by Bonferroni.
Benjamini-Hochberg, per encoding and length class (tests of longer tokens have more
power), releases tokens as not random with a false-discovery rate of at most
``FDR``: of the tokens released, at most that share is expected to be random. What
is not released is added as spans of kind ``random``. Each distinct token counts
once, in the pair counts and in the procedure, so a text with many copies decides
nothing. p-values are counted in tenths of a decade, rounded up, so the step-up
procedure needs a table of bounded size only, counted over all tokens.

Positions are code points, the end exclusive. Defined results: NULL counts as
empty and has no spans; equal rows get equal spans; an empty table gives no
rows; other columns, whatever their names, are not read. Texts are scanned whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, text_or_empty

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
# a failing match of these two has no shorter part that could match, so the
# least length can stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN = 12
FDR = 0.01
MIN_BITS = 64
ALPHABETS = {        # name: (pattern, symbols)
    "hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "letters": (r"^(?:[A-Z]?[a-z]+|[A-Z]+)$", "abcdefghijklmnopqrstuvwxyz"),
    "base32": (r"^[A-Z2-7]+$", "abcdefghijklmnopqrstuvwxyz234567"),
    "base36": (r"^(?:[0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base64": (r"^[A-Za-z0-9+/_-]+$",
               "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
}

MIN_LENGTH = {name: math.ceil(MIN_BITS / math.log2(len(symbols))) for name, (_, symbols) in ALPHABETS.items()}
TOKEN = rf"[A-Za-z0-9+/_-]{{{min(MIN_LENGTH.values())},}}={{0,2}}"
FOLDED = "abcdefghijklmnopqrstuvwxyz0123456789+"      # pairs are counted without case
# The commonest letter pairs of English, commonest first; they stand in
# for spelling where a corpus has few long words
COMMON_PAIRS = ("th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le "
                "ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur").split()
PRIOR_WEIGHT = 20


def _hits(kind: str, pattern: str) -> Column:
    """Lengths of the text before each match, of the match, and of its value."""
    found = F.regexp_extract_all("t", F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all("t", F.lit(pattern), F.lit(2)) if kind == "assign" else found
    lengths = F.transform(F.split("t", pattern, -1), lambda x: F.length(x))
    text = found if kind == "random" else F.transform(found, lambda x: F.lit(None).cast("string"))
    hits = F.arrays_zip(F.slice(lengths, 1, F.size(found)).alias("gap"),
                        F.transform(found, lambda x: F.length(x)).alias("len"),
                        F.transform(value, lambda x: F.length(x)).alias("value"),
                        text.alias("token"))
    return F.struct(F.lit(kind).alias("kind"), F.when(F.col("t").rlike(pattern), hits).alias("hits"))


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rid, doc_id and, per kind with matches, their lengths; one scan."""
    by_kind = F.array(*[_hits(k, p) for k, p in zip(KINDS, (ASSIGN, ACCESS, HEX, TOKEN), strict=True)])
    return (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("t"))
            .select("doc_id", F.monotonically_increasing_id().alias("rid"),
                    F.filter(by_kind, lambda x: x["hits"].isNotNull()).alias("kinds")))


def _spans(found: DataFrame) -> DataFrame:
    """rid, kind, start, end, value length and token of every match."""
    rows = (found.select("rid", F.explode("kinds").alias("k"))
            .select("rid", "k.kind", F.posexplode("k.hits").alias("i", "h")))
    until = Window.partitionBy("rid", "kind").orderBy("i")
    end = F.sum(F.col("h.gap") + F.col("h.len")).over(until)
    return (rows.withColumn("end", end)
            .select("rid", "kind", (F.col("end") - F.col("h.len")).alias("start"), "end",
                    F.col("h.value").alias("value"), F.col("h.token").alias("token")))


def _upper_normal(z: Column) -> Column:
    """P(Z > z) for z >= 0 by a rational approximation (error below 1e-7)."""
    x = z / F.sqrt(F.lit(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = F.lit(1.061405429)
    for c in (-1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = poly * t + F.lit(c)
    return F.lit(0.5) * poly * t * F.exp(-x * x)


def _above(z: Column) -> Column:
    """P(Z > z)."""
    return F.when(z >= 0, _upper_normal(F.abs(z))).otherwise(1 - _upper_normal(F.abs(z)))


def _two_sided(z: Column) -> Column:
    return F.lit(2.0) * _upper_normal(F.abs(z))


def _folded(body: Column) -> Column:
    return F.translate(F.lower(body), "/_-", "+++")


def pair_table(tokens: DataFrame) -> dict[str, int]:
    """How often each pair of (folded) characters stands in the distinct tokens."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("f") - 1), lambda i: F.substring(F.col("f"), i, F.lit(2)))
    rows = (tokens.select(_folded(F.regexp_replace("token", "=+$", "")).alias("f"))
            .select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")))
    return {r["pair"]: r["n"] for r in rows.collect()}                 # at most 37 * 37 rows


def pair_scores(counts: dict[str, int]) -> dict[str, tuple[list[float], float, float, float]]:
    """Per encoding: the log ratio of each pair's share among ``counts`` (less the
    token's own) to its share in random tokens, and under randomness the ratio's
    mean, its variance and the covariance of two pairs that share a character."""
    weight = {a + b: 0.5 + counts.get(a + b, 0) + PRIOR_WEIGHT * (a + b in COMMON_PAIRS)
              for a in FOLDED for b in FOLDED}
    total = sum(weight.values())
    out = {}
    for name, (_, symbols) in ALPHABETS.items():
        share = {c: 0.0 for c in FOLDED}
        for x in symbols.lower().replace("/", "+"):
            share[x] += 1 / len(symbols)
        u = [share[c] for c in FOLDED]
        score = [[math.log(weight[a + b] / total / (u[i] * u[j])) if u[i] * u[j] else 0.0
                  for j, b in enumerate(FOLDED)] for i, a in enumerate(FOLDED)]
        n = range(len(FOLDED))
        mean = sum(u[i] * u[j] * score[i][j] for i in n for j in n)
        var = sum(u[i] * u[j] * (score[i][j] - mean) ** 2 for i in n for j in n)
        cov = sum(u[b] * sum(u[i] * score[i][b] for i in n) * sum(u[j] * score[b][j] for j in n)
                  for b in n) - mean ** 2
        # a token's own pair is among the counts: without it, or it would vouch for itself
        others = [math.log(max(weight[a + b] - 1, 0.5) / total / (u[i] * u[j])) if u[i] * u[j] else 0.0
                  for i, a in enumerate(FOLDED) for j, b in enumerate(FOLDED)]
        out[name] = others, mean, var, cov
    return out


def _numbers(values: list[float]) -> Column:
    """A constant array, folded once by the optimiser."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def with_p_values(tokens: DataFrame, counts: dict[str, int]) -> DataFrame:
    """Adds encoding, n, k, p (column ``token``); tokens too short for ``MIN_BITS`` in
    their alphabet drop out. Dashes and underscores between hexadecimal parts (a
    UUID) are not part of the token."""
    body = F.regexp_replace("token", "=+$", "")
    parts = F.regexp_replace(body, "[-_]", "")
    body = F.when(parts.rlike(ALPHABETS["hex"][0]), parts).otherwise(body)
    scores = pair_scores(counts)
    names = list(ALPHABETS)
    number = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(names))):
        number = F.when(F.col("body").rlike(ALPHABETS[name][0]), F.lit(i)).otherwise(number)
    pick = lambda values: F.element_at(values, F.col("number") + 1)
    plain = F.when(F.col("encoding") == "base64", F.translate("body", "-_", "+/")).otherwise(
        F.lower("body"))
    out = (tokens.withColumn("body", body).withColumn("number", number)
           .withColumn("encoding", pick(F.array(*[F.lit(x) for x in names])))
           .withColumn("symbols", pick(F.array(*[F.lit(ALPHABETS[x][1]) for x in names])))
           .withColumn("k", F.length("symbols")).withColumn("n", F.length("body"))
           .filter(F.col("n") * F.log2(F.col("k").cast("double")) >= MIN_BITS)
           .withColumn("plain", plain).withColumn("folded", _folded(F.col("body")))
           .withColumn("x", F.expr("transform(split(plain, ''), c -> instr(symbols, c) - 1)"))
           .withColumn("y", F.expr(f"transform(split(folded, ''), c -> instr('{FOLDED}', c) - 1)"))
           .withColumn("parts", F.expr("int(greatest(2, least(k, n div 5)))")))
    table, width = _numbers([x for name in names for x in scores[name][0]]), len(FOLDED)
    pairs = F.zip_with(F.slice("y", F.lit(1), F.col("n") - 1), F.slice("y", F.lit(2), F.col("n") - 1),
                       lambda a, b: F.element_at(table, F.col("number") * width ** 2 + a * width + b + 1))
    out = (out.withColumn("chi", F.expr(
        "aggregate(sequence(0, parts - 1), 0D, (acc, c) -> acc + "
        "power(size(filter(x, v -> v * parts div k = c)) - n / parts, 2) * parts / n)"))
           .withColumn("high", F.expr("transform(x, v -> v * 2 >= k)"))
           .withColumn("n1", F.expr("size(filter(high, v -> v))"))
           .withColumn("runs", F.expr(
               "1 + size(filter(zip_with(slice(high, 1, n - 1), slice(high, 2, n - 1), "
               "(a, b) -> a <> b), v -> v))"))
           .withColumn("mean", F.expr("aggregate(x, 0D, (acc, v) -> acc + v) / n"))
           .withColumn("var", F.expr("aggregate(x, 0D, (acc, v) -> acc + power(v - mean, 2))"))
           .withColumn("lag", F.expr(
               "aggregate(zip_with(slice(x, 1, n - 1), slice(x, 2, n - 1), "
               "(a, b) -> (a - mean) * (b - mean)), 0D, (acc, v) -> acc + v)"))
           .withColumn("pairs", F.aggregate(pairs, F.lit(0.0), lambda acc, v: acc + v)))
    df = F.col("parts") - 1
    cube = F.pow(F.col("chi") / df, F.lit(1.0 / 3))          # Wilson-Hilferty
    z_chi = (cube - (1 - F.lit(2.0) / (9 * df))) / F.sqrt(F.lit(2.0) / (9 * df))
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    n0 = n - n1
    mu = 2 * n1 * n0 / n + 1
    spread = (mu - 1) * (mu - 2) / (n - 1)
    p_runs = F.when((n1 == 0) | (n0 == 0) | (spread <= 0), F.lit(0.0)).otherwise(
        _two_sided((F.col("runs") - mu) / F.sqrt(spread)))
    p_lag = F.when(F.col("var") == 0, F.lit(0.0)).otherwise(
        _two_sided((F.col("lag") / F.col("var") + 1 / n) * F.sqrt(n)))
    mean, var, cov = (pick(_numbers([scores[name][i] for name in names])) for i in (1, 2, 3))
    pair_var = (n - 1) * var + 2 * (n - 2) * cov
    p_pairs = F.when(pair_var < 1e-9, F.lit(1.0)).otherwise(
        _above((F.col("pairs") - (n - 1) * mean) / F.sqrt(pair_var)))
    return out.withColumn("p", F.least(F.lit(1.0), 4 * F.least(_above(z_chi), p_runs, p_lag, p_pairs)))


def random_tokens(spans: DataFrame) -> DataFrame:
    """The rows of ``spans`` whose token the false-discovery procedure does not
    release as non-random. Tokens are tested once, however often they occur."""
    tokens = checkpointed(spans.select("token").distinct())
    tested = (checkpointed(with_p_values(tokens, pair_table(tokens)).select("token", "encoding", "n", "p"))
              .withColumn("length_class", F.floor(F.log2(F.col("n").cast("double"))).cast("int"))
              .withColumn("decade", F.floor(-10 * F.log10(F.greatest("p", F.lit(1e-10)))).cast("int")))
    stratum = ["encoding", "length_class"]
    table = tested.groupBy(*stratum, "decade").agg(F.count(F.lit(1)).alias("c"))
    smaller = Window.partitionBy(*stratum).orderBy(F.col("decade").desc())
    passes = F.pow(F.lit(10.0), -F.col("decade") / 10) <= (
        F.lit(FDR) * F.col("up_to") / F.col("m"))
    # at most 5 encodings x 31 length classes
    cut = (table.withColumn("up_to", F.sum("c").over(smaller))
           .withColumn("m", F.sum("c").over(Window.partitionBy(*stratum)))
           .filter(passes).groupBy(*stratum).agg(F.min("decade").alias("release_from")))
    kept = (tested.join(F.broadcast(cut), stratum, "left")
            .filter(F.col("release_from").isNull() | (F.col("decade") < F.col("release_from")))
            .select("token", "p"))
    return spans.join(checkpointed(kept), "token")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rid, kind, start, end of every span; ``docs`` a scan or checkpoint."""
    return _all_spans(checkpointed(matches(docs, id_col, text_col)))


def _all_spans(found: DataFrame) -> DataFrame:
    spans = checkpointed(_spans(found))
    base = spans.filter("kind = 'access' or kind = 'hex' or "
                        f"(kind = 'assign' and value >= {MIN_ASSIGN})")
    known = base.select("rid", "end").distinct()      # a token that a pattern has found already
    others = checkpointed(spans.filter("kind = 'random'").join(known, ["rid", "end"], "left_anti"))
    added = random_tokens(others)
    cols = ["rid", "kind", "start", "end"]
    return base.select(*cols).unionByName(added.select(*cols))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans of every row."""
    found = checkpointed(matches(docs, id_col, text_col))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    name = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    spans = (_all_spans(found)
             .groupBy("rid").agg(*[F.count_if(F.col("kind") == k).alias("n_" + k) for k in KINDS],
                                 F.array_sort(F.collect_list(F.struct(
                                     "start", order.alias("o"), "kind", name.alias("name")))).alias("s")))
    base = F.filter("s", lambda x: x["kind"] != "random")
    joined = (found.select("rid", "doc_id").join(spans, "rid", "left")
              .withColumn("base", F.coalesce(F.array_join(base["name"], ","), F.lit("")))
              .withColumn("spans", F.coalesce(F.array_join(F.col("s")["name"], ","), F.lit(""))))
    return joined.select("doc_id", *[F.coalesce("n_" + k, F.lit(0)).cast("long").alias("n_" + k)
                                     for k in KINDS],
                         F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
