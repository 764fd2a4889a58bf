"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is compiled once into a regular expression and filed under one of
its literal tokens: the one that the fewest urls hold. A url's own tokens then
fetch the few rules filed under them, and only those run their expressions.
The index is a literal of hash buckets inside the plan, so the whole decision
happens in the row: no shuffle, no join, one scan.

Defined cases: a null url or one without ``://`` has an empty host and path
and gets the default verdict; repeated rows are judged each; other columns
travel along, also those named like this module's helpers; columns named like
one of the results, whose names the caller picks, are replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower

# A token: a run of anything but ASCII punctuation, white space and controls.
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Rules of one index literal; larger sets take several literals in turn.
RULES_PER_INDEX = 20_000
_INDEX = "array<array<struct<token:string,regex:string,rule:string,action:string,size:int,prefer:int>>>"


@dataclass(frozen=True)
class UrlRule:
    """``action`` for urls on ``host`` or its subdomains whose path starts with ``path`` (``*`` matches anything)."""

    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def regex(self) -> str:
        body = ".*".join(re.escape(p) for p in self.text.split("*"))
        return r"(?s)\A(?:[^/]*\.)?" + body

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that any matching url holds whole: not cut off by a wildcard or the open end."""
        t = self.text
        return [m[0] for m in re.finditer(TOKEN, t) if t[m.start() - 1:m.start()] != "*" and t[m.end():m.end() + 1] not in ("", "*")]


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(target, F.lit(TOKEN), 0))


def _listed(spark: SparkSession, values: Sequence[str]) -> DataFrame:
    """A column ``token`` of ``values``: one literal, however many there are."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(values)), "array<string>")).alias("token"))


def rarest_tokens(df: DataFrame, url: Column, rules: Sequence[UrlRule]) -> dict[UrlRule, str]:
    """For each rule the literal token that the fewest urls of ``df`` hold ("" if it has none).

    Counts only the rules' own tokens (a broadcast of the rules, which the
    driver holds anyway), so the result has at most one row a token.
    """
    tokens = {r: r.tokens for r in rules}
    wanted = sorted({t for of_rule in tokens.values() for t in of_rule})
    if not wanted:
        return {r: "" for r in rules}
    held = df.select(F.explode(_tokens(F.concat(host_of(url), path_of(url)))).alias("token"))
    counts = held.join(F.broadcast(_listed(df.sparkSession, wanted)), "token", "left_semi").groupBy("token").count()
    n = {r["token"]: r["count"] for r in counts.collect()}
    return {r: min(tokens[r], key=lambda t: (n.get(t, 0), t), default="") for r in rules}


def _hashes(spark: SparkSession, tokens: Sequence[str]) -> dict[str, int]:
    return {r["token"]: r["h"] for r in _listed(spark, tokens).select("token", F.xxhash64("token").alias("h")).collect()}


def _index(filed: dict[UrlRule, str], hashes: dict[str, int], buckets: int) -> Column:
    table: list[list[dict]] = [[] for _ in range(buckets)]
    for r, token in filed.items():
        table[hashes[token] % buckets].append({"token": token, "regex": r.regex, "rule": r.text, "action": r.action,
                                               "size": len(r.text), "prefer": int(r.action == "block")})
    return F.from_json(F.lit(json.dumps(table)), _INDEX)


def _free(df: DataFrame, *names: str) -> list[str]:
    """``names``, each prolonged until no column of ``df`` has it."""
    there = {c.lower() for c in df.columns}
    longest = max(map(len, there), default=0)
    return [n if n not in there else n + "_" * longest for n in names]


def judge(df: DataFrame, rules: Sequence[UrlRule], url: str = "url", default: str = "allow",
          host: str = "host", path: str = "path", rule: str = "rule", verdict: str = "verdict") -> DataFrame:
    """Add host, path, the winning rule (longest; on a tie block before allow, then the greatest text) and the verdict to every row."""
    u, best = F.col(url), None
    rules = list(dict.fromkeys(rules))
    filed = rarest_tokens(df, u, rules)
    hashes = _hashes(df.sparkSession, sorted(set(filed.values()))) if filed else {}
    hosts, paths, target, tokens, winner = _free(df, "__host", "__path", "__target", "__tokens", "__best")
    for at in range(0, len(rules), RULES_PER_INDEX):
        part = {r: filed[r] for r in rules[at:at + RULES_PER_INDEX]}
        buckets = 1 << max(2, len(part).bit_length())
        bucket = lambda t: F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int")  # noqa: B023, E731
        index = _index(part, hashes, buckets)
        fetched = F.flatten(F.transform(
            F.concat(F.array(F.lit("")), F.col(tokens)),
            lambda t: F.filter(F.element_at(index, bucket(t) + 1), lambda r: r["token"] == t)))  # noqa: B023
        hits = F.filter(fetched, lambda r: F.regexp_like(F.col(target), r["regex"]))
        longest = F.array_max(F.transform(hits, lambda r: F.struct(r["size"], r["prefer"], r["rule"], r["action"])))
        best = longest if best is None else F.greatest(best, longest)
    out = (df.withColumns({hosts: host_of(u), paths: path_of(u)})
           .withColumn(target, F.concat(hosts, paths)).withColumn(tokens, _tokens(F.col(target))))
    none = F.lit(None).cast("struct<size:int,prefer:int,rule:string,action:string>")
    out = out.withColumn(winner, none if best is None else best)
    return out.withColumns({host: F.col(hosts), path: F.col(paths), rule: F.col(winner)["rule"],
                            verdict: F.coalesce(F.col(winner)["action"], F.lit(default))}
                           ).drop(hosts, paths, target, tokens, winner)
