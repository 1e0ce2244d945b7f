"""URL filters: pattern rules fetched by their rarest literal token.

A rule is indexed under one literal token that every URL it fits must contain:
the one that the fewest rules have, ties to the longer and then the lesser. A
URL's own tokens fetch the candidate rules, and only those run their regular
expressions; rules without any literal token are candidates for every URL.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import free_name

_TOKEN = re.compile(r"[a-z0-9]+")
MAX_RULE_BYTES = 64 << 20  # text of the rules sent to a task


@dataclass(frozen=True)
class Rule:
    """``name`` is reported; ``regex`` is searched in ``host + path``; ``tokens``
    are literal tokens (whole runs of a-z and 0-9) of every URL it fits, in
    lower case."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...] = ()
    compiled: re.Pattern = field(init=False, compare=False, repr=False)

    def __post_init__(self):
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"verdict {self.verdict!r} of rule {self.name!r}")
        object.__setattr__(self, "compiled", re.compile(self.regex))


def host_path_rule(rule: str, verdict: str) -> Rule:
    """A rule ``host/path``: fits the host and all its subdomains where the
    URL's path starts with the rule's."""
    host, slash, path = rule.partition("/")
    end = "" if slash else r"(?=/|\Z)"
    regex = rf"\A(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}{end}"
    # The last run of the path may go on in the URL, so it is no whole token.
    whole = _TOKEN.findall(host) + _TOKEN.findall(path.lower())[: None if path and not path[-1].isalnum() else -1]
    if path != path.lower():
        whole = _TOKEN.findall(host)
    return Rule(rule, verdict, regex, tuple(whole))


def host_word_rule(word: str) -> Rule:
    """Block hosts in which the word (a-z, 0-9) stands between dots, hyphens or ends."""
    return Rule(word, "block", rf"\A(?:[^/]*[^a-z0-9/])?{re.escape(word)}(?![a-zA-Z0-9])", (word,))


# Words that hosts of betting, pill, adult, loan, spam and advert sites are named by.
HOST_WORDS = [
    "casino", "casinos", "poker", "roulette", "slots", "bet", "bets", "betting", "jackpot", "lottery",
    "pills", "pharmacy", "viagra", "cialis", "meds", "steroids",
    "adult", "porn", "xxx", "sex", "escort", "escorts", "cams", "nudes", "hookup",
    "loans", "payday", "forex", "spam", "phishing", "malware", "warez", "torrent", "torrents",
    "ad", "ads", "adserver", "adservice", "advert", "adverts", "banners", "popads", "popunder", "tracker", "trackers", "clickbait",
]


def filter_rule(line: str) -> Rule | None:
    """A rule in the syntax of public filter lists, or None where the line has none.

    ``||`` begins at a host's label, ``|`` at the beginning or the end, ``*`` stands for
    anything, ``^`` for a separator (no letter, digit, ``_ - . %``) or the end, ``/.../``
    is a regular expression, and ``@@`` makes an exception. Letters count in either
    case. What is matched is host and path: the scheme and the query are not. Comments,
    rules on page elements and rules with options are none.
    """
    rule = line.strip()
    verdict = "allow" if rule.startswith("@@") else "block"
    body = rule.removeprefix("@@")
    if not body or body.startswith(("!", "[")) or "##" in body or "#@#" in body or "#?#" in body:
        return None
    if len(body) > 2 and body[0] == body[-1] == "/":
        try:
            return Rule(rule, verdict, f"(?i:{body[1:-1]})")
        except re.error:
            return None
    if "$" in body:
        return None
    host = body.startswith("||")
    begin = host or body.startswith("|")
    end = len(body) > 1 and body.endswith("|")
    body = body.lstrip("|")
    body = (body[:-1] if end else body).lower()
    parts = {"*": ".*", "^": r"(?:[^a-z0-9_.%\-]|\Z)"}
    regex = "".join(parts.get(c) or re.escape(c) for c in body)
    regex = (r"\A(?:[^/]*\.)?" if host else r"\A" if begin else "") + regex + (r"\Z" if end else "")
    # A run of the body is a whole token of the URL unless it touches a wildcard or an open end.
    whole = [
        m.group()
        for m in _TOKEN.finditer(body)
        if (body[m.start() - 1] != "*" if m.start() else begin) and (body[m.end()] != "*" if m.end() < len(body) else end)
    ]
    return Rule(rule, verdict, f"(?i:{regex})", tuple(whole))


def read_rules(lines: DataFrame, column: str = "line", max_bytes: int = MAX_RULE_BYTES) -> list[Rule]:
    """The rules of a table of filter lines, each once. They go to every task, so
    their size is counted first; more than ``max_bytes`` of text is an error. NULL
    lines and lines without a rule are skipped."""
    distinct = lines.select(F.col(column).alias("line")).filter(F.col("line").isNotNull()).distinct()
    total = distinct.agg(F.coalesce(F.sum(F.octet_length("line")), F.lit(0))).first()[0]
    if total > max_bytes:
        raise ValueError(f"{total} bytes of rules; at most {max_bytes} are sent to the tasks")
    found = [filter_rule(r.line) for r in distinct.orderBy("line").collect()]
    return [r for r in found if r is not None]


class RuleIndex:
    """Rules by their rarest literal token."""

    def __init__(self, rules: list[Rule]):
        counts = Counter(t for r in rules for t in set(r.tokens))
        self.by_token: dict[str, list[Rule]] = defaultdict(list)
        self.always: list[Rule] = []
        for r in rules:
            if r.tokens:
                self.by_token[min(r.tokens, key=lambda t: (counts[t], -len(t), t))].append(r)
            else:
                self.always.append(r)

    def candidates(self, url: str) -> list[Rule]:
        """The rules whose regular expressions have to run on a host and path."""
        found = list(self.always)
        for token in set(_TOKEN.findall(url.lower())):
            found += self.by_token.get(token, ())
        return found

    def fitting(self, host: str, path: str) -> list[Rule]:
        url = host + path
        return [r for r in self.candidates(url) if r.compiled.search(url)]


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path). Host: after the first ``://`` up to ``/ ? #`` or the end,
    A-Z lower-cased; path: from there up to ``? #`` or the end. NULL or no
    ``://``: both empty."""
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    whole = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, slash, path = whole.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def judge_urls(
    pages: DataFrame, rules: list[Rule], fallback: list[Rule], url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """The columns of ``pages``, and host, path, rule and verdict.

    The longest fitting rule of ``rules`` decides (ties: the lesser name). Where
    none fits, rule is NULL and the verdict is block if a blocking rule of
    ``fallback`` fits and no excepting one, else ``default``. NULL and malformed URLs have empty
    host and path, and rules are tried on them as on any other. Repeated rows
    are judged each; an empty table gives no rows. Input columns called host,
    path, rule or verdict are replaced. Rules and fallback are sent with the task;
    ``read_rules`` bounds their size.
    """
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in added]
    url = pages[url_col].cast("string").alias(free_name(pages, "_url"))
    source = pages.select(*kept, url)
    text = F.lit("").cast("string")
    nullable = [F.when(F.lit(False), text).alias(c) for c in added]
    schema = pages.select(*kept, *nullable).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        main, back = RuleIndex(rules), RuleIndex(fallback)
        for batch in batches:
            out: list[tuple] = []
            for u in batch.column(len(kept)).to_pylist():
                host, path = split_url(u)
                best = min(main.fitting(host, path), key=lambda r: (-len(r.name), r.name), default=None)
                if best is not None:
                    out.append((host, path, best.name, best.verdict))
                else:
                    said = {r.verdict for r in back.fitting(host, path)}
                    out.append((host, path, None, "block" if said == {"block"} else default))
            cols = [pa.array([o[i] for o in out], pa.string()) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(kept))] + cols, names=kept + list(added))

    return source.mapInArrow(run, schema)
