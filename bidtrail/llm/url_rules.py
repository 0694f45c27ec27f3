"""URL filter: pattern rules found by their rarest literal token.  DataFrame functions only, no shuffle of the URLs.

A rule is a regular expression over "host/path" with the literal tokens that every URL it matches must hold.  It is
filed under the one of them that is rarest in the URLs at hand.  The tokens of a URL fetch the rules filed under them,
and only those run their expression.  Rules are configuration, held by the caller; they travel inside the plan as one
constant, spread over slots by a hash of the token, so that what a URL costs does not follow the number of rules.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from dataclasses import dataclass
from typing import Any
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tuned

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """name is None for a default rule, which yields to every named one; among named rules the longest name wins."""

    action: str
    pattern: str
    tokens: tuple[str, ...]
    name: str | None = None


def site_rule(action: str, name: str) -> Rule:
    """A host with all its subdomains, and a path prefix: `example.net/en/`."""
    host, _, path = name.partition("/")
    whole = re.findall(r"[a-z0-9]+(?![a-z0-9])", host.lower())
    # The last piece of a path prefix may go on in the URL, so it is a token only if something closes it.
    whole += re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path.lower())
    return Rule(action, rf"^(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}", tuple(dict.fromkeys(whole)), name)


def host_word_rule(action: str, word: str) -> Rule:
    """A word or hyphenated words in the host, with something else or nothing on either side."""
    return Rule(action, rf"^(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?:[^a-z0-9]|$)", tuple(re.findall(r"[a-z0-9]+", word)))


# The named rules of the query.
NAMED_RULES = [site_rule("block", "net/"), site_rule("allow", "example.net/en/"), site_rule("block", "example.com/de/"), site_rule("allow", "org/fr/")]
# Default rules: words that mark gambling, adult, piracy and spam hosts.
BLOCKED_WORDS = (
    "adult bet bets betting bingo casino cracked escort free-bets free-spins jackpot nude pharma-deals payday-loans pills poker porn "
    "sex slots spam spam-farm torrent viagra warez xxx"
).split()
RULES = NAMED_RULES + [host_word_rule("block", w) for w in BLOCKED_WORDS]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ://, A-Z lowered; path up to ?, # or the end; both empty without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    lowered = F.translate(F.concat(host, path), UPPER, LOWER)
    return F.array_distinct(F.split(lowered, "[^a-z0-9]+"))


def constant(value: Any, kind: str) -> Column:
    """A nested value as one constant of the plan; a literal would be an expression per element."""
    return F.from_json(F.lit(json.dumps({"v": value})), f"v {kind}")["v"]


def in_slots(entries: list[tuple[str, Any]]) -> list[list[Any]]:
    """Values of tokens, spread over at least twice as many slots by the CRC of their token."""
    slots: list[list[Any]] = [[] for _ in range(max(2, 1 << (2 * len(entries)).bit_length()))]
    for token, value in entries:
        slots[crc32(token.encode()) % len(slots)].append(value)
    return slots


def slot_of(slots: Column, size: int, token: Column) -> Column:
    return F.element_at(slots, (F.crc32(token.cast("binary")) % size + 1).cast("int"))


def token_counts(urls: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """In how many URLs each literal token of the rules stands; the result is no longer than the rules."""
    wanted = sorted({t for r in rules for t in r.tokens})
    slots = in_slots([(t, t) for t in wanted])
    known = constant(slots, "array<array<string>>")
    host, path = host_and_path(F.col("url").cast("string"))
    found = F.filter(url_tokens(host, path), lambda t: F.array_contains(slot_of(known, len(slots), t), t))
    return {r[0]: r[1] for r in urls.select(F.explode(found).alias("token")).groupBy("token").count().collect()}


def judge(pages: DataFrame, rules: list[Rule] = RULES, default: str = "allow") -> DataFrame:
    """page_id, url, host, path, rule (name of the winning named rule, else null), verdict.

    Null URLs and those without :// have an empty host and path and get the default verdict.  Long, repeated and
    non-ASCII URLs are judged like others; an empty table gives an empty one; other columns are ignored.
    """
    tuned(pages.sparkSession)
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    counts = token_counts(rows, rules)
    index: dict[str, list[int]] = defaultdict(list)
    always = [i for i, r in enumerate(rules) if not r.tokens]
    for i, rule in enumerate(rules):
        if rule.tokens:
            index[min(rule.tokens, key=lambda t: (counts.get(t, 0), t))].append(i)
    slots = in_slots([(t, {"t": t, "r": numbers}) for t, numbers in index.items()])
    filed = constant(slots, "array<array<struct<t: string, r: array<int>>>>")
    # Of the named rules the longest name wins; failing those, any default rule.
    listed = constant([{"p": r.pattern, "w": len(r.name) if r.name is not None else -1, "n": r.name, "a": r.action} for r in rules], "array<struct<p: string, w: int, n: string, a: string>>")

    host, path = host_and_path(F.col("url"))
    split = rows.withColumn("host", host).withColumn("path", path)
    fetched = F.transform(
        url_tokens(F.col("host"), F.col("path")),
        lambda t: F.flatten(F.transform(F.filter(slot_of(filed, len(slots), t), lambda e: e["t"] == t), lambda e: e["r"])),
    )
    candidates = F.array_union(F.flatten(fetched), F.lit(always).cast("array<int>"))
    subject = F.concat("host", "path")
    matched = F.filter(candidates, lambda i: F.regexp(subject, F.element_at(listed, i + 1)["p"]))
    # Ties go to the first in the list.
    best = F.array_max(F.transform(matched, lambda i: F.struct(F.element_at(listed, i + 1)["w"].alias("w"), (-i).alias("n"))))
    judged = split.withColumn("best", best)
    winner = F.element_at(listed, 1 - F.col("best.n"))
    return judged.select(
        "page_id",
        "url",
        "host",
        "path",
        F.when(F.col("best.w") >= 0, winner["n"]).alias("rule"),
        F.when(F.col("best").isNotNull(), winner["a"]).otherwise(default).alias("verdict"),
    )
