"""URL filters: pattern rules, found through their rarest literal token.

A rule is a regular expression over a url's host and path, with an action. It is filed
under one token that every url it matches must hold, of several under the one that the
fewest urls of the table hold. The tokens of a url fetch the rules filed under them, and
only those run; rules without such a token are tried on every url. Named host rules come
before other patterns, and among either the longest wins; of equals, the earlier one.

Rules are kept inside the tasks in blocks of a bounded size, one pass over the urls for each
block, so a rule set of any size is covered.

Edge cases: a null url, or one without ``://``, has an empty host and path, and no rule with
a host fits it; repeated rows and rows without an id are judged each on its own; without
rules the default verdict holds; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treewatt.functions.tables import sized
from treewatt.llm.common import UPPER, Scratch, ascii_lower

BLOCK_BYTES = 8 << 20
TOKEN = re.compile("[a-z0-9]+")
LOWER = str.maketrans(UPPER, UPPER.lower())
SPECIAL = set("[(.*+?{|^$\\)")


@dataclass(frozen=True)
class Rule:
    """name is shown for host rules and null for patterns; tokens are all that must occur."""

    pattern: str
    action: str
    tokens: tuple[str, ...]
    name: str | None = None

    @property
    def rank(self) -> tuple[bool, int]:
        return self.name is not None, len(self.name or self.pattern)


def host_rule(host: str, path: str, action: str) -> Rule:
    """Fits a host and its subdomains, where the url's path starts with the rule's.

    The path is empty or starts with a slash.
    """
    text = (host + path).translate(LOWER)
    tokens = TOKEN.findall(text)
    if tokens and text[-1:].isalnum() and len(path):
        tokens = tokens[:-1]  # the path may go on inside the last token
    whole = re.escape(path) if path else r"(?=/|\Z)"
    pattern = r"\A(?:[^/]*\.)?" + re.escape(host) + whole
    return Rule(pattern, action, tuple(tokens), host + path)


def pattern_rule(pattern: str, action: str) -> Rule:
    return Rule(pattern, action, tuple(whole_tokens(pattern)))


def whole_tokens(pattern: str) -> list[str]:
    r"""Tokens that any match holds as whole tokens.

    Only letters and digits at the top level between two literal characters of another
    kind, \b or the ends of the text count; a pattern with alternatives at the top level
    or with inline flags has none.
    """
    out, word, depth, at = [], None, 0, 0  # word is None where a token may have begun before
    while at < len(pattern):
        char, at = pattern[at], at + 1
        kind = "text"
        if char == "\\" and at < len(pattern):
            char, at = pattern[at], at + 1
            kind = "edge" if char in "AbZ" else "other" if char.isalnum() else "text"
        elif char == "[":
            end = pattern.find("]", at + 1 + (pattern[at : at + 1] == "^"))
            at, kind = (end + 1 if end >= 0 else len(pattern)), "other"
        elif char in "^$":
            kind = "edge"
        elif char in SPECIAL:
            kind = "other"
            depth += (char == "(") - (char == ")")
            if char == "(" and re.match(r"\?[a-zA-Z]", pattern[at:]) or char == "|" and not depth:
                return []
        optional = pattern[at : at + 1] in ("*", "?", "+", "{") and kind != "edge"
        if depth or kind == "other" or optional:
            word = None
        elif kind == "text" and char.translate(LOWER) in "abcdefghijklmnopqrstuvwxyz0123456789":
            word = None if word is None else word + char.translate(LOWER)
        else:
            out += [word] if word else []
            word = ""
    return out


def _target(name: str) -> Column:
    """Lower-cased host and path, for its tokens."""
    url = F.col(name)
    place = F.locate("://", url)
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^?#]*", 0))


def token_counts_in(urls: DataFrame, url_col: str, tokens: list[str]) -> dict[str, int]:
    """How many urls hold each of the rules' tokens."""
    spark = urls.sparkSession
    wanted = spark.createDataFrame([(t,) for t in tokens], "token string")
    held = urls.select(F.col(url_col).cast("string").alias("url")).select(
        F.explode(
            F.array_distinct(F.regexp_extract_all(_target("url"), F.lit("([a-z0-9]+)")))
        ).alias("token")
    )
    counts = held.join(sized(wanted, len(tokens), 100_000), "token").groupBy("token").count()
    return {r.token: r["count"] for r in counts.collect()}


class RuleIndex:
    """Rules filed under their rarest token."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = {}
        self.always: list[tuple[Rule, re.Pattern]] = []
        for rule in rules:
            entry = (rule, re.compile(rule.pattern))
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(entry)
            else:
                self.always.append(entry)

    def best(self, target: str) -> Rule | None:
        """The first of the highest-ranked rules that match."""
        found = [rule for rule, pattern in self.always if pattern.search(target)]
        for token in set(TOKEN.findall(target.translate(LOWER))):
            for rule, pattern in self.by_token.get(token, ()):
                if pattern.search(target):
                    found.append(rule)
        return max(found, key=lambda rule: rule.rank) if found else None


def host_and_path(url: str | None) -> tuple[str, str]:
    before, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((p for p in map(rest.find, "/?#") if p >= 0), default=len(rest))
    path = rest[end:]
    stop = min((p for p in map(path.find, "?#") if p >= 0), default=len(path))
    return rest[:end].translate(LOWER), path[:stop]


def rule_blocks(rules: list[Rule], block_bytes: int) -> list[list[Rule]]:
    blocks: list[list[Rule]] = [[]]
    size = 0
    for rule in rules:
        if blocks[-1] and size + len(rule.pattern) > block_bytes:
            blocks.append([])
            size = 0
        blocks[-1].append(rule)
        size += len(rule.pattern)
    return blocks


def _judge(block: list[Rule], counts: dict[str, int]):
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(block, counts)
        for batch in batches:
            rows = []
            for url, name, pattern, action in zip(
                *(batch.column(i).to_pylist() for i in (1, 4, 5, 6)), strict=True
            ):
                host, path = host_and_path(url)
                best = index.best(host + path)
                had = (name is not None, len(name or pattern or "")) if action else (False, -1)
                if best and best.rank > had:
                    name, pattern, action = best.name, best.pattern, best.action
                rows.append((host, path, name, pattern, action))
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *arrays], batch.schema.names)

    return run


def judge_urls(
    urls: DataFrame,
    rules: list[Rule],
    keep: list[str],
    url_col: str = "url",
    default: str = "allow",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(keep, url, host, path, rule, pattern, verdict) per row; keep is a struct of columns.

    rule is the name of the host rule that decides, pattern the expression of any rule that
    does; both are null where the default holds.
    """
    scratch = Scratch(urls.sparkSession, "urls")
    tokens = sorted({t for rule in rules for t in rule.tokens})
    counts = token_counts_in(urls, url_col, tokens) if tokens else {}
    empty = F.lit(None).cast("string")
    state = urls.select(
        F.struct(*keep).alias("keep"),
        F.col(url_col).cast("string").alias("url"),
        *[empty.alias(c) for c in ("host", "path", "rule", "pattern", "action")],
    )
    for number, block in enumerate(rule_blocks(rules, block_bytes)):
        if number:
            state = scratch.write(state, f"pass-{number}")
            if number > 1:
                scratch.drop(f"pass-{number - 1}")
        state = state.mapInArrow(_judge(block, counts), state.schema)
    return state.select(
        "keep",
        "url",
        "host",
        "path",
        "rule",
        "pattern",
        F.coalesce("action", F.lit(default)).alias("verdict"),
    )


HOST_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
PATTERNS = (r"\bads-track\.", r"\bcasino\b", r"\bporn\b", r"\.zip\Z", r"\.exe\Z", r"\.apk\Z")


def production_rules() -> list[Rule]:
    """The host rules, and patterns that block advertising, adult pages and downloads."""
    return [host_rule(*r) for r in HOST_RULES] + [pattern_rule(p, "block") for p in PATTERNS]


def op2_url_rules(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    judged = judge_urls(pages, production_rules(), ["page_id"])
    return judged.select("keep.page_id", "host", "path", "rule", "verdict")


_VALUES = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in HOST_RULES)
_BLOCKS = " OR ".join(
    "regexp_matches(target, '{}')".format(p.replace(r"\Z", r"\z")) for p in PATTERNS
)
ORACLE_SQL = {
    "op2_url_rules": f"""
WITH rules(h, p, action) AS (VALUES {_VALUES}),
r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
        '{UPPER}', '{UPPER.lower()}') AS host,
        regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
      FROM r),
b AS (SELECT page_id, host, path, host || path AS target,
        (SELECT max_by(h || p, length(h || p)) FROM rules
         WHERE (u.host = h OR ends_with(u.host, '.' || h)) AND starts_with(u.path, p)) AS rule
      FROM u)
SELECT page_id, host, path, rule,
  coalesce((SELECT action FROM rules WHERE h || p = b.rule),
           CASE WHEN {_BLOCKS} THEN 'block' ELSE 'allow' END) AS verdict
FROM b
"""
}
