"""URL rules found by their rarest literal token.

A rule allows or blocks a host with its subdomains, below a path prefix that
may hold ``*`` for any characters.  The whole tokens of a rule (runs of
letters and digits bounded on both sides) must occur in every URL it fits, so
it is filed under just one of them, the one that the fewest URLs of the corpus
have.  A URL's tokens fetch the rules filed under them, and only those are
tried as regular expressions.  Rules without a whole token are tried on all
URLs.  Token frequencies are counted over all URLs, for tokens of rules only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+"
_PY_TOKEN = re.compile("[A-Za-z0-9\x80-\U0010ffff]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` in lower case; ``path`` with its leading slash, or empty."""

    verdict: str
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path

    def regex(self) -> str:
        """Of "host?path" strings: neither host nor path holds a ``?``."""
        path = ".*".join(re.escape(x) for x in self.path.split("*"))
        return rf"(?s)(?:[^?]*\.)?{re.escape(self.host)}\?{path}"

    def tokens(self) -> list[str]:
        """Literal tokens that every URL the rule fits has whole.  A token
        that ends the path or touches a ``*`` may be part of a longer one."""
        found = ["h:" + m[0] for m in _PY_TOKEN.finditer(self.host)]
        for m in _PY_TOKEN.finditer(self.path):
            around = self.path[m.start() - 1 : m.start()] + self.path[m.end() : m.end() + 1]
            if m.end() < len(self.path) and "*" not in around:
                found.append("p:" + m[0])
        return list(dict.fromkeys(found))


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _tokens(host: str, path: str) -> Column:
    own = [F.transform(F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0)), lambda x, p=p: F.concat(F.lit(p), x)) for c, p in ((host, "h:"), (path, "p:"))]
    return F.array_distinct(F.concat(*own))


def rule_index(urls: DataFrame, rules: list[Rule]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; those without one under the empty token.
    The driver gets a count for each token of the rules, no more."""
    spark = urls.sparkSession
    tokens = sorted({t for r in rules for t in r.tokens()})
    if not tokens:
        return {"": list(rules)} if rules else {}
    wanted = spark.createDataFrame([(t,) for t in tokens], "token string")
    counts = urls.select(F.explode(_tokens("host", "path")).alias("token")).groupBy("token").count()
    seen = dict(tuple(r) for r in counts.join(wanted, "token").collect())
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        own = rule.tokens()
        index.setdefault(min(own, key=lambda t: (seen.get(t, 0), t)) if own else "", []).append(rule)
    return index


class Matcher:
    def __init__(self, index: dict[str, list[Rule]], default: str):
        self.index = {t: [(r, re.compile(r.regex())) for r in rules] for t, rules in index.items()}
        self.default = default

    def judge(self, host: str, path: str) -> tuple[str | None, str]:
        """The longest rule that fits, blocking first among equals, and the
        verdict."""
        keys = [""] + ["h:" + t for t in _PY_TOKEN.findall(host)] + ["p:" + t for t in _PY_TOKEN.findall(path)]
        best = None
        for key in dict.fromkeys(keys):
            for rule, regex in self.index.get(key, ()):
                if regex.match(f"{host}?{path}"):
                    rank = (len(rule.text), rule.verdict == "block", rule.text)
                    best = max(best, (rank, rule), key=lambda x: x[0]) if best else (rank, rule)
        return (best[1].text, best[1].verdict) if best else (None, self.default)


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """One row per row of ``pages`` (needs page_id, url; other columns are not
    read): page_id, host, path, rule, verdict.

    Null url or one without ``://``: host and path empty, so no rule fits and
    the verdict is ``default``, as for any URL that no rule fits.  Null
    page_ids are carried; repeated rows are judged each.  Empty table: no
    rows.  Of rules of equal length a blocking one wins.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    index = rule_index(urls, rules)

    def run(batches):
        matcher = Matcher(index, default)
        for batch in batches:
            found = [matcher.judge(h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            both = [pa.array(c, pa.string()) for c in (zip(*found, strict=True) if found else ([], []))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *both], ["page_id", "host", "path", "rule", "verdict"])

    return urls.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string")
