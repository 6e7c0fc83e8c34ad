"""URL filter: allow and block rules in one broadcast trie.

A rule is (verdict, host, path). It fits its host and all subdomains, and
every path that starts with the rule's path. The trie's first level runs over
host labels from the right; at each host node a second trie runs over path
segments. All segments of a rule but the last must be equal; the last one is a
prefix. The longest fitting rule wins: the longest host first, then the
longest path.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased, as it is written (a port or user name stays). Path: from there up
to ``?``, ``#`` or the end. NULL or no ``://``: both empty.

Defined results: a URL that no rule fits gets the default verdict and a NULL
rule; of equal rules with different verdicts, building the trie fails. The
rules are configuration: at most ``MAX_RULE_BYTES`` are broadcast, more is an
error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, text_or_empty

Rule = tuple[str, str, str]

MAX_RULE_BYTES = 16 << 20
DEFAULT = "allow"


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(text_or_empty(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(text_or_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class UrlTrie:
    """Nested dicts. A host node maps labels to nodes and, under ``None``,
    holds its path trie; a path node maps segments to nodes and, under
    ``None``, the prefixes of a segment that end a rule, by their length."""

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        size = 0
        for verdict, host, path in rules:
            size += len(host.encode()) + len(path.encode())
            if size > MAX_RULE_BYTES:
                raise ValueError(f"more than {MAX_RULE_BYTES} bytes of URL rules")
            if verdict not in ("allow", "block"):
                raise ValueError(f"verdict {verdict!r}")
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            *whole, last = path.split("/")
            node = node.setdefault(None, {})
            for segment in whole:
                node = node.setdefault(segment, {})
            ends = node.setdefault(None, {}).setdefault(len(last), {})
            if ends.setdefault(last, (verdict, host + path)) != (verdict, host + path):
                raise ValueError(f"two verdicts for {host + path}")

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        """(verdict, rule) of the longest rule that fits."""
        paths, node = [], self.root
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if None in node:
                paths.append(node[None])
        for trie in reversed(paths):                   # longest host first
            if found := self._longest_path(trie, path.split("/")):
                return found
        return None

    @staticmethod
    def _longest_path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            for length, ends in sorted(node.get(None, {}).items(), reverse=True):
                if length <= len(segment) and (found := ends.get(segment[:length])):
                    best = found
                    break
            node = node.get(segment)
            if node is None:
                break
        return best


def judge_urls(pages: DataFrame, rules: Iterable[Rule], default: str = DEFAULT,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for hosts, paths in batches:
            found = [trie.find(h, p) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame({"rule": [f[1] if f else None for f in found],
                                "verdict": [f[0] if f else default for f in found]}, dtype=object)

    return (pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                         path_of(F.col(url_col)).alias("path"))
            .withColumn("found", judge("host", "path"))
            .select("page_id", "host", "path", "found.rule", "found.verdict"))
