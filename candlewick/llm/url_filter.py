"""URL filters: pattern rules behind an index of literal tokens.

Every rule has a regular expression over ``//host/path``.  Its groups and
options are written out, and each of the ways it can match is filed under the
rarest token that it must contain (counted over all URLs): a whole token, or
the beginning of one where the expression goes on openly.  The tokens of a URL,
and their beginnings, fetch candidate rules and only those run.  The rules are
a parameter (their size, not the data, bounds what travels to the tasks), the
URL table is read twice: once for the token counts, combined map-side and
limited to tokens of rules, and once for the verdicts, row by row without a
shuffle.
"""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.rows import row_function

TOKEN = "[a-z0-9]+"

# Host rules (host, path, verdict): a host with its subdomains and the start of a path.
HOST_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
              ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
              ("net", "/fr/", "block")]

# Pattern rules for URLs that no host rule fits: regular expression over
# //host/path, and the verdict.
PATTERN_RULES = [
    # sites for sale, spam shops, gambling, adult and pirated content, by host
    (r"//[^/]*\bcheap-pills\b", "block"), (r"//[^/]*\bcasino[a-z0-9-]*\.", "block"),
    (r"//[^/]*\bfree-movies\b", "block"), (r"//[^/]*\bporn[a-z0-9-]*\.", "block"),
    (r"//[^/]*\bxxx\b", "block"), (r"//[^/]*\b(buy|cheap|order)-(viagra|cialis|xanax|levitra)\b", "block"),
    (r"//[^/]*\b(viagra|cialis|levitra|tramadol)[a-z0-9-]*\.", "block"),
    (r"//[^/]*\b(poker|roulette|slots?|jackpot|bingo)(-online|online)\b", "block"),
    (r"//[^/]*\bbet(365|win|ting)[a-z0-9-]*\.", "block"), (r"//[^/]*\b(escorts?|hentai|milf|camgirls?)\b", "block"),
    (r"//[^/]*\badult-(dating|video|chat)s?\b", "block"), (r"//[^/]*\btorrents?[a-z0-9-]*\.", "block"),
    (r"//[^/]*\b(warez|keygen|nulled|crackz)[a-z0-9-]*\.", "block"),
    (r"//[^/]*\bpayday-?loans?\b", "block"), (r"//[^/]*\b(replica|fake)-(watch|bag|shoe)e?s\b", "block"),
    (r"//[^/]*\b(seo|backlink|link-building)-services?\b", "block"), (r"//[^/]*\bdomain-?for-?sale\b", "block"),
    # advertising and tracking hosts
    (r"//(ads?|track(er|ing)?|banner)\.", "block"), (r"//(pixel|beacon|telemetry|analytics)\.", "block"),
    (r"//[^/]*\b(adserver|adservice|doubleclick|popunder)[a-z0-9-]*\.", "block"),
    # pages without an article, by path
    (r"//[^/]*/login\b", "block"), (r"//[^/]*/wp-admin/", "block"), (r"//[^/]*/wp-login\.php\b", "block"),
    (r"//[^/]*/(sign-?in|sign-?up|register|logout)\b", "block"), (r"//[^/]*/(cart|checkout|basket)\b", "block"),
    (r"//[^/]*/cgi-bin/", "block"), (r"//[^/]*/(password|account)/(reset|recover)\b", "block"),
    (r"//[^/]*/phpmyadmin\b", "block"), (r"//[^/]*/xmlrpc\.php\b", "block"),
    (r"//.*\.(exe|msi|apk|dmg|iso|zip|rar|7z|tar)(?=$)", "block"),
]
MOST_WAYS = 256  # ways to match that a rule is written out into
LEAST_PREFIX = 3  # letters of a beginning that a rule can be filed under


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/?#``, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                      F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?#``; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rule(host: str, path: str) -> str:
    """The regular expression of a host rule."""
    return rf"//([^/]*\.)?{re.escape(host)}(?=/|$){re.escape(path)}"


def host_rule_tokens(host: str, path: str) -> set[str]:
    """Whole tokens of every URL that the rule fits: those of the host, and
    those of the path that the rule itself ends with a separator."""
    return set(re.findall(TOKEN, host)) | {m[1] for m in re.finditer(rf"({TOKEN})(?=[^a-z0-9])", path)}


_OPEN = "\0"  # anything may stand here
_EDGE = "\1"  # a word boundary or the end


def ways(pattern: str) -> list[str] | None:
    """The literal shapes in which ``pattern`` can match: groups and options
    written out, word boundaries as ``_EDGE``, all that is not literal as
    ``_OPEN``.  None if they are too many or the pattern is not understood."""
    at = 0

    def either() -> list[str]:
        nonlocal at
        out = sequence()
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            out = out + sequence()
        return out

    def sequence() -> list[str]:
        out = [""]
        while at < len(pattern) and pattern[at] not in "|)":
            part = repeated(atom())
            out = [a + b for a in out for b in part]
            if len(out) > MOST_WAYS:
                raise OverflowError
        return out

    def atom() -> list[str]:
        nonlocal at
        c = pattern[at]
        at += 1
        if c == "(":
            if pattern.startswith("?=", at):  # what follows is not read: an edge if only ends do
                end = pattern.index(")", at)
                inner, at = pattern[at + 2:end], end + 1
                return [_EDGE if all(re.fullmatch(r"[^a-z0-9\\\[(.]|\$", x) for x in inner.split("|")) else _OPEN]
            if pattern.startswith("?", at):
                if not pattern.startswith("?:", at):
                    raise ValueError
                at += 2
            out = either()
            at += 1
            return out
        if c == "[":
            at = pattern.index("]", at + 1 + (pattern[at] == "^")) + 1
            return [_OPEN]
        if c == "\\":
            c = pattern[at]
            at += 1
            return [_EDGE if c == "b" else _OPEN if c.isalnum() else c]
        return [_EDGE if c in "^$" else _OPEN if c == "." else c]

    def repeated(part: list[str]) -> list[str]:
        nonlocal at
        m = re.compile(r"[*+?]|\{[0-9,]*\}").match(pattern, at)
        if not m:
            return part
        at = m.end()
        if pattern.startswith(("?", "+"), at):  # lazy or possessive
            at += 1
        return part + [""] if m[0] == "?" else [p + _OPEN for p in part] if m[0] == "+" else [_OPEN]

    try:
        out = either()
    except (OverflowError, ValueError, IndexError):
        return None
    return out if at == len(pattern) else None


def literal_tokens(pattern: str) -> list[set[str]]:
    """For each of the ways in which ``pattern`` can match the tokens that such
    a match holds: whole ones, and beginnings of tokens, marked by ``*``.  An
    empty set if none is certain; such a pattern is run on every URL."""
    found = []
    for way in ways(pattern) or [_OPEN]:
        own = set()
        for m in re.finditer(TOKEN, way):
            before, after = way[m.start() - 1:m.start()], way[m.end():m.end() + 1]
            if before and before != _OPEN:
                if after and after != _OPEN:
                    own.add(m[0])
                elif len(m[0]) >= LEAST_PREFIX:
                    own.add(m[0] + "*")
        found.append(own)
    return found


def _token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """URLs by token or beginning, for those of rules only (bounded by the rules)."""
    if not tokens:
        return {}
    own = F.regexp_extract_all(F.col("target"), F.lit(TOKEN), F.lit(0))
    starts = [F.transform(own, lambda t, n=n: F.concat(F.substring(t, 1, n), F.lit("*")))
              for n in sorted({len(t) - 1 for t in tokens if t.endswith("*")})]
    found = F.array_intersect(F.concat(own, *starts), F.array(*[F.lit(t) for t in sorted(tokens)]))
    rows = urls.select(F.explode(found).alias("t")).groupBy("t").count().collect()
    return {r["t"]: r["count"] for r in rows}


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", *,
                host_rules=HOST_RULES, pattern_rules=PATTERN_RULES,
                default: str = "allow") -> DataFrame:
    """Judge every URL.

    Returns one row per input row: ``id_col``, ``host``, ``path``, ``rule``
    (the longest host rule that fits, as host + path; else null), ``verdict``
    (that rule's; else that of the first pattern rule that matches; else
    ``default``), ``pattern`` (that pattern rule, else null) and ``tried``
    (expressions that ran on it).  Of host rules of equal length the longer
    host wins, then block.  Null URLs and URLs without ``://`` have an empty
    host and path and get ``default``; URLs of any length are read whole.
    Repeated rows give repeated results; no rows give no rows; other columns
    are not read.
    """
    ranked = sorted(host_rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[2] != "block"))
    rules = [(host_rule(h, p), f"{h}{p}", v) for h, p, v in ranked]
    rules += [(rx, None, v) for rx, v in pattern_rules]
    tokens = [[host_rule_tokens(h, p)] for h, p, _ in ranked]
    tokens += [literal_tokens(rx) for rx, _ in pattern_rules]
    base = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    base = base.withColumn("target", F.concat(F.lit("//"), "host", "path"))
    counts = _token_counts(base, {t for each in tokens for way in each for t in way})
    index, always = defaultdict(list), []
    for n, each in enumerate(tokens):
        if all(each):
            for t in {min(way, key=lambda t: (counts.get(t, 0), t)) for way in each}:
                index[t].append(n)
        else:
            always.append(n)
    index = dict(index)
    starts = sorted({len(t) - 1 for t in index if t.endswith("*")})

    def judge():
        split = re.compile(TOKEN)
        compiled = [re.compile(rx) for rx, _, _ in rules]

        def one(target):
            fetched = set(always)
            for t in set(split.findall(target)):
                fetched.update(index.get(t, ()))
                for n in starts:
                    fetched.update(index.get(t[:n] + "*", ()))
            for tried, n in enumerate(sorted(fetched), 1):  # in order of precedence
                if compiled[n].match(target):
                    rx, rule, verdict = rules[n]
                    return {"rule": rule, "verdict": verdict, "pattern": None if rule else rx, "tried": tried}
            return {"rule": None, "verdict": default, "pattern": None, "tried": len(fetched)}

        return one

    judged = row_function(judge, "struct<rule:string,verdict:string,pattern:string,tried:int>")
    return (base.withColumn("j", judged("target"))
            .select(F.col("id").alias(id_col), "host", "path", "j.rule", "j.verdict", "j.pattern",
                    "j.tried"))


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("tried")


def _sql() -> str:
    """Longest host rule by a CASE in order of length, then the first pattern."""
    ranked = sorted(HOST_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = lambda h, p: (f"(host = '{h}' OR host LIKE '%.{h}') "  # noqa: E731
                         f"AND starts_with(path, '{p}')")
    cases = "\n    ".join(f"WHEN {fits(h, p)} THEN {i}" for i, (h, p, _) in enumerate(ranked))
    rules = ", ".join(f"({i}, '{h}{p}', '{v}')" for i, (h, p, v) in enumerate(ranked))
    marks = "\n    ".join(f"WHEN regexp_matches('//' || host || path, '^{rx.replace('(?=$)', '$')}') THEN {i}"
                          for i, (rx, _) in enumerate(PATTERN_RULES))
    patterns = ", ".join(f"({i}, '{rx}', '{v}')" for i, (rx, v) in enumerate(PATTERN_RULES))
    return f"""
WITH u AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(i, rule, verdict) AS (VALUES {rules}),
q(i, pattern, verdict) AS (VALUES {patterns}),
m AS (SELECT *, CASE {cases} END AS i, CASE {marks} END AS j FROM u)
SELECT page_id, host, path, r.rule, coalesce(r.verdict, q.verdict, 'allow') AS verdict,
       CASE WHEN r.rule IS NULL THEN pattern END AS pattern
FROM m LEFT JOIN r ON r.i = m.i LEFT JOIN q ON q.i = m.j
"""


OP1_SQL = _sql()
