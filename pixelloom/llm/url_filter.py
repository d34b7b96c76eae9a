"""Allow and block rules for URLs, held in a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rules whose trie may be broadcast (well under 1 KB a rule).
MAX_RULES = 1_000_000

Rule = tuple[str, str, str]


class UrlTrie:
    """Rules (verdict, host, path): a rule fits its host and subdomains when the URL's path starts with its path.

    Edges are host labels from the right, then path segments; a rule's last, maybe partial, segment stays at its node.
    Among the rules that fit, the one with most host labels wins, then the one with the longest path.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for verdict, host, path in rules:
            if verdict not in ("allow", "block"):
                raise ValueError(f"unknown verdict {verdict!r}")
            node = self.root
            for label in reversed(host.lower().split(".")) if host else ():
                node = node.setdefault(("h", label), {})
            *whole, tail = path.split("/")
            for segment in whole:
                node = node.setdefault(("p", segment), {})
            node.setdefault("ends", {})[tail] = (f"{host.lower()}{path}", verdict)

    def _in_path(self, node: dict, path: str) -> tuple[str, str] | None:
        best, at = None, 0
        while node is not None:
            rest = path[at:]
            fits = [t for t in node.get("ends", ()) if rest.startswith(t)]
            if fits:
                best = node["ends"][max(fits, key=len)]
            cut = path.find("/", at)
            if cut < 0:
                return best
            node, at = node.get(("p", path[at:cut])), cut + 1
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest rule that fits, or None."""
        node, best = self.root, self._in_path(self.root, path)
        for label in reversed(host.split(".")) if host else ():
            node = node.get(("h", label))
            if node is None:
                break
            best = self._in_path(node, path) or best
        return best


def judge_urls(pages: DataFrame, rules: Iterable[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row.

    Host: after the first :// up to /, ?, # or the end, A-Z lower-cased; path: from there up to ?, # or the end. A null
    URL or one without :// has an empty host and path. rule is null where none fits; the verdict then is default.
    Repeated rows and null ids keep their rows; other columns are ignored. No shuffle: the trie (at most MAX_RULES
    rules) goes to the tasks with the function.
    """
    rules = list(rules)
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(rules))
    rest = F.expr(f"CASE WHEN instr(`{url_col}`, '://') > 0 THEN substring(`{url_col}`, instr(`{url_col}`, '://') + 3) ELSE '' END")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    @F.pandas_udf("rule string, verdict string")
    def judged(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        found = [trie.value.match(h, p) or (None, default) for h, p in zip(hosts, paths, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"])

    split = pages.select(F.col(id_col).alias("page_id"), F.translate(host, upper, lower).alias("host"), path.alias("path"))
    return split.withColumn("j", judged("host", "path")).select("page_id", "host", "path", "j.rule", "j.verdict")
