"""Secrets in texts, by rules. A trigram index finds the texts that a rule can match at all.

Every rule is a regular expression with a Boolean query over trigrams derived from it: a literal that
any match holds is a conjunction of its trigrams, alternatives are a disjunction. Each record batch is
a segment of the index: postings of a trigram are the rows of the segment that hold it, queries
intersect and unite postings, and candidates are verified by the expression on their whole texts.
Rules without a mandatory trigram scan every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolumna.llm.common import map_batches


class Rule(NamedTuple):
    kind: str
    pattern: re.Pattern
    least: int = 0  #: code points that ``group`` of a match must have
    group: int = 0


BASE = (
    Rule("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE), 12, 2),
    Rule("access", re.compile(r"AKIA[A-Z0-9]+"), 18),
    Rule("hex", re.compile(r"[0-9a-f]{16,}"), 16),  # the runs of [0-9a-f]+ that are long enough
)

#: Further forms of published credentials.
MORE = (
    Rule("private_key", re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )?PRIVATE KEY-----")),
    Rule("web_token", re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    Rule("code_host", re.compile(r"\b(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}\b")),
    Rule("chat", re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}")),
    Rule("payment", re.compile(r"\b(?:sk|rk)_(?:live|test)_[A-Za-z0-9]{16,}\b")),
    Rule("map_key", re.compile(r"\bAIza[A-Za-z0-9_-]{35}")),
    Rule("url_login", re.compile(r"[a-z][a-z0-9+.-]{0,30}://[^\s:/@]+:[^\s:/@]+@[^\s/]+")),
    Rule("bearer", re.compile(r"\bBearer\x20+[A-Za-z0-9+/_.=-]{20,}")),
)


class Query(NamedTuple):
    """A Boolean trigram query: ``op`` is "all", "any" or "tri"; an empty "all" holds for every text."""

    op: str
    parts: tuple


ALWAYS = Query("all", ())


def _both(parts: list[Query], op: str) -> Query:
    if op == "any" and (not parts or ALWAYS in parts):
        return ALWAYS
    parts = list(dict.fromkeys(p for p in parts if p != ALWAYS))
    return parts[0] if len(parts) == 1 else Query(op, tuple(parts))


def _of_literal(text: str) -> Query:
    text = text.lower()
    return _both([Query("tri", (text[i : i + 3],)) for i in range(len(text) - 2)], "all")


#: Alternatives whose literals are spelled out; beyond it a part counts as anything.
MOST_SPELLINGS = 64


def trigram_query(pattern: re.Pattern) -> Query:
    """What the trigrams of a lower-cased text must satisfy for ``pattern`` to match anywhere in it.

    Runs of the expression whose strings can be listed are joined, so that literals reach across
    groups and options; what cannot be listed ends a run. The query is necessary, never sufficient.
    """
    return _query(re._parser.parse(pattern.pattern, pattern.flags))


def _query(nodes) -> Query:
    found: list[Query] = []
    spelled = [""]

    def close() -> None:
        found.append(_both([_of_literal(s) for s in spelled], "any"))
        spelled[:] = [""]

    for node in nodes:
        listed = _strings([node])
        if listed is not None and len(listed) * len(spelled) <= MOST_SPELLINGS:
            spelled[:] = [a + b for a in spelled for b in listed]
            continue
        close()
        op, value = str(node[0]), node[1]
        if op == "SUBPATTERN":
            found.append(_query(value[3]))
        elif op == "BRANCH":
            found.append(_both([_query(branch) for branch in value[1]], "any"))
        elif op in ("MAX_REPEAT", "MIN_REPEAT") and value[0] > 0:
            found.append(_query(value[2]))
    close()
    return _both(found, "all")


def _strings(nodes) -> list[str] | None:
    """All strings a list of nodes matches, lower-cased, or None if they are too many."""
    spelled = [""]
    for op, value in nodes:
        name = str(op)
        if name == "LITERAL":
            some: list[str] | None = [chr(value).lower()]
        elif name == "AT":
            some = [""]
        elif name == "SUBPATTERN":
            some = _strings(value[3])
        elif name == "BRANCH":
            branches = [_strings(branch) for branch in value[1]]
            some = None if None in branches else [s for branch in branches for s in branch]
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value):
            some = [chr(v).lower() for _, v in value]
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and value[1] == 1:
            inner = _strings(value[2])
            some = None if inner is None else [""] * (value[0] == 0) + inner
        else:
            some = None
        if some is None or len(some) * len(spelled) > MOST_SPELLINGS:
            return None
        spelled = list(dict.fromkeys(a + b for a in spelled for b in some))
    return spelled


class Segment:
    """Postings of one record batch, built for a trigram when a query asks for it first."""

    def __init__(self, texts: list[str]):
        self.texts = [t.lower() for t in texts]
        self.postings: dict[str, np.ndarray] = {}

    def rows(self, trigram: str) -> np.ndarray:
        if trigram not in self.postings:
            self.postings[trigram] = np.flatnonzero([trigram in t for t in self.texts])
        return self.postings[trigram]

    def candidates(self, query: Query) -> np.ndarray:
        if query.op == "tri":
            return self.rows(query.parts[0])
        found = [self.candidates(part) for part in query.parts]
        if query.op == "any":
            return np.unique(np.concatenate(found))
        result = np.arange(len(self.texts))
        for rows in found:
            result = np.intersect1d(result, rows, assume_unique=True)
        return result


def matches(text: str, rule: Rule) -> list[tuple[int, int, str]]:
    """Leftmost non-overlapping matches that are long enough, as (start, end, kind) in code points."""
    return [(m.start(), m.end(), rule.kind) for m in rule.pattern.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", base=BASE, more=MORE) -> DataFrame:
    """(doc_id, n_<kind> of each base rule, base_sha256, spans) of every row.

    ``spans`` lists kind:start:end of all rules by start, then by the order of the rules; the digest
    is of the base ones only. A null text is empty and has no span. Repeated rows and ids are treated
    alike, an empty table gives no row, extra columns are ignored, texts are read whole.
    """
    rules = (*base, *more)
    place = {rule.kind: i for i, rule in enumerate(rules)}
    queries = [trigram_query(rule.pattern) for rule in rules]
    joined: Callable = lambda spans: ",".join(f"{k}:{s}:{e}" for s, e, k in spans)

    def scan(batch: pa.RecordBatch) -> dict:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        segment, spans = Segment(texts), [[] for _ in texts]
        for rule, query in zip(rules, queries):
            for row in segment.candidates(query).tolist():
                spans[row] += matches(texts[row], rule)
        out: dict[str, list] = {"doc_id": batch.column(0)} | {f"n_{rule.kind}": [] for rule in base} | {"base_sha256": [], "spans": []}
        for found in spans:
            found.sort(key=lambda s: (s[0], place[s[2]], s[1]))
            own = [s for s in found if place[s[2]] < len(base)]
            for rule in base:
                out[f"n_{rule.kind}"].append(sum(k == rule.kind for _, _, k in own))
            out["base_sha256"].append(hashlib.sha256(joined(own).encode()).hexdigest())
            out["spans"].append(joined(found))
        return out

    counts = ", ".join(f"n_{rule.kind} long" for rule in base)
    picked = docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string"))
    return map_batches(picked, scan, f"doc_id long, {counts}, base_sha256 string, spans string")


def spans_sql(base=BASE, more=MORE) -> str:
    """The query's columns for ``documents`` in SQL: places follow from the lengths of matches and of what lies between them."""

    def expression(pattern: re.Pattern) -> str:
        text = pattern.pattern.replace("'", "''")
        if pattern.flags & re.IGNORECASE:  # spelled out, as other engines fold letters beyond A to Z
            text = re.sub(r"(?<![\\\[A-Za-z0-9-])[a-z]{3,}", lambda m: "".join(f"[{c}{c.upper()}]" for c in m.group()), text)
        return text

    found = "\nunion all ".join(
        f"""select doc_id, '{rule.kind}' as kind, {place} as place, {rule.least} as least, string_split_regex(t, '{expression(rule.pattern)}') as between,
        regexp_extract_all(t, '{expression(rule.pattern)}') as ms, regexp_extract_all(t, '{expression(rule.pattern)}', {rule.group}) as gs from texts"""
        for place, rule in enumerate((*base, *more))
    )
    counts = ", ".join(f"count(*) filter (kind = '{rule.kind}') as n_{rule.kind}" for rule in base)
    names = ", ".join(f"coalesce(n_{rule.kind}, 0) as n_{rule.kind}" for rule in base)
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as ({found}),
numbered as (select *, unnest(range(1, len(ms) + 1)) as k from found),
spans as (
    select doc_id, kind, place, length(ms[k]) as n, list_sum(list_transform(between[1:k], lambda x: length(x)))
        + coalesce(list_sum(list_transform(ms[1:k - 1], lambda x: length(x))), 0) as b
    from numbered where length(gs[k]) >= least
),
shown as (select *, concat(kind, ':', cast(b as bigint), ':', cast(b + n as bigint)) as span from spans),
sums as (
    select doc_id, {counts}, string_agg(span, ',' order by b, place) filter (place < {len(base)}) as own,
        string_agg(span, ',' order by b, place, n) as every from shown group by doc_id
)
select doc_id, {names}, sha256(coalesce(own, '')) as base_sha256, coalesce(every, '') as spans
from texts left join sums using (doc_id)"""
