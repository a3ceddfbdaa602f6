"""Personal data in texts by weak supervision.

Patterns give two sorts of spans. Those of the base kinds that pass their checks are always reported. All
pattern matches, with base matches that failed and looser ones such as local phone numbers, secrets and names
after a title, are candidates. Six labelers vote for or against each candidate or abstain: its strict format,
a gazetteer of prefixes and key words, words before it, words that speak against it, its shape, and
whether it stands alone. Spark counts the vote patterns of the whole corpus; their number is bounded by
kinds, votes and shapes. Expectation-maximisation on these counts estimates how reliable each
labeler is and how likely each pattern is to be personal data, and a logistic regression on votes and
shape is trained on those estimates. It decides about the candidates that are no base matches.

Offsets are code points, ends exclusive. Added spans never overlap base spans or each other; of
overlapping candidates the first wins, then the longest. Null or empty text has no spans. Rows that
repeat are treated one by one but count as often in the statistics. A null id is kept, other
columns are not read. Without candidates nothing is added.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketfold.llm.common import staged, whole_text

KINDS = ("email", "ip", "card", "phone", "iban", "person", "secret", "ssn")
BASE = 4
VOTES = 6

Span = tuple[int, int, int]

# The base patterns. Runs are matched from their first character on, which finds the
# same spans in time linear in the text.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
NO_DIGITS = re.compile(r"[^0-9]+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser patterns by kind.
LOOSE = {
    0: re.compile(r"\b[A-Za-z0-9._-]{2,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{2,63}(?: ?[\[(]dot[\])] ?[A-Za-z]{2,10})+"),
    3: re.compile(r"(?<![\w+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])"),
    4: re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    5: re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señora?|Madame)\b\.? [A-Z][a-z]{2,20}(?: [A-Z][a-z]{2,20})?"),
    6: re.compile(r"[A-Za-z0-9_+/-]{16,}|(?<=[=:])[^\s\"'=:]{8,}"),
    7: re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
}

GAZETTEER = {
    0: re.compile(r"\.(?:com|org|net|edu|gov|io|de|fr|es|uk|info)$", re.I),
    4: re.compile(r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|NL|NO|PL|PT|SE)"),
    5: re.compile(r"^(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señora?|Madame)\b"),
    6: re.compile(r"^(?:AKIA|ASIA|gh[pousr]_|sk-|xox[abps]-|AIza|eyJ)"),
}
KEY_WORDS = re.compile(
    r"(?:mail|contact|call|phone|tel|fax|mobile|card|visa|iban|account|konto|compte|cuenta|ssn|social|"
    r"password|passwd|pwd|passwort|token|secret|api.?key|key|login|user|server|host|ip|born|name)\W{0,6}$",
    re.I,
)
AGAINST = re.compile(
    r"(?:version|licen[sc]ed?|copyright|isbn|section|chapter|fig|table|vol|no|sha\d*|md5|commit|doi)\W{0,3}$|[$€£#]$",
    re.I,
)
# All kinds but secrets need one of these.
INTERESTING = re.compile(r"[0-9@=]|[\[(]at[\])]|\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Señora?|Madame)\b")


def emails(text: str) -> list[tuple[int, int]]:
    found, begin = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > begin and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at) if start < at else None
        if match:
            found.append((start, match.end()))
        begin = match.end() if match else at + 1
        at = text.find("@", begin)
    return found


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, whether its check passes) of all base pattern matches."""
    found = [(0, a, b, True) for a, b in emails(text)]
    for m in IP.finditer(text):
        parts = m[0].split(".")
        ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
        found.append((1, *m.span(), ok))
    for kind, pattern, low, high in ((2, CARD, 13, 19), (3, PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = NO_DIGITS.sub("", m[0])
            ok = low <= len(digits) <= high and (kind == 3 or luhn(digits))
            found.append((kind, *m.span(), ok))
    return found


def votes(text: str, kind: int, start: int, end: int, strict: bool | None) -> list[int]:
    """For (1), against (-1) or nothing (0), by labeler."""
    span, before = text[start:end], text[max(0, start - 40) : start]
    digits = sum(c.isdigit() for c in span) / len(span)
    entropy = _entropy(span)
    if kind == 6:
        mixed = 0.04 < digits < 0.9 and any(c.isalpha() for c in span)
        shape = 1 if mixed and entropy > 3 else -1
        strict = True if re.fullmatch(r"[0-9a-f]{18,}|AKIA[0-9A-Z]{16}", span) and mixed else None
        strict = False if digits < 0.02 else strict
    elif kind == 5:
        shape = 1 if span.count(" ") <= 2 else -1
    else:
        shape = -1 if len(set(span)) < 4 else 1
    listed = GAZETTEER.get(kind)
    gazetteer = 0 if listed is None else 1 if listed.search(span) else 0
    alone = not (start and text[start - 1].isalnum()) and not text[end : end + 1].isalnum()
    return [
        0 if strict is None else 1 if strict else -1,
        gazetteer,
        1 if KEY_WORDS.search(before) else 0,
        -1 if AGAINST.search(before) else 0,
        shape,
        1 if alone else -1,
    ]


def _entropy(span: str) -> float:
    share = np.unique(list(span), return_counts=True)[1] / len(span)
    return float(-(share * np.log2(share)).sum())


def find(text: str) -> tuple[list[Span], list[tuple[int, int, int, int, int]]]:
    """Base spans, and candidates as (kind, start, end, packed votes, shape)."""
    plain = not INTERESTING.search(text)
    matches = [] if plain else base_matches(text)
    base = sorted((k, a, b) for k, a, b, ok in matches if ok)
    possible = {(k, a, b): ok for k, a, b, ok in matches if k != 2 or ok or b - a > 12}
    for kind, pattern in LOOSE.items():
        if plain and kind != 6:
            continue
        for m in pattern.finditer(text):
            possible.setdefault((kind, *m.span()), None if kind in (5, 6) else True)
    candidates = []
    for (kind, a, b), strict in sorted(possible.items()):
        packed = 0
        for vote in votes(text, kind, a, b, strict):
            packed = packed * 3 + vote + 1
        shape = min(3, (b - a) // 12) * 2 + any(c.isupper() for c in text[a:b])
        candidates.append((kind, a, b, packed, shape))
    return base, candidates


def unpack(packed: int) -> list[int]:
    each = []
    for _ in range(VOTES):
        packed, vote = divmod(packed, 3)
        each.append(vote - 1)
    return each[::-1]


def vector(kind: int, packed: int, shape: int) -> np.ndarray:
    """Features of the span classifier: kind, votes for and against, shape, one."""
    x = np.zeros(len(KINDS) + 2 * VOTES + 8 + 1)
    x[kind] = 1
    for i, vote in enumerate(unpack(packed)):
        if vote:
            x[len(KINDS) + 2 * i + (vote > 0)] = 1
    x[len(KINDS) + 2 * VOTES + shape] = 1
    x[-1] = 1
    return x


@dataclass(frozen=True)
class Model:
    """Weights of the classifier, and what each labeler was found to be worth."""

    weights: np.ndarray | None = None
    reliability: np.ndarray | None = None

    def accepts(self, kind: int, packed: int, shape: int) -> bool:
        return self.weights is not None and float(vector(kind, packed, shape) @ self.weights) >= 0


def train(counts: list[tuple[int, int, int, int]], rounds: int = 60) -> Model:
    """From (kind, packed votes, shape, number) of all candidates."""
    if not counts:
        return Model()
    kind = np.array([c[0] for c in counts])
    cast = np.array([unpack(c[1]) for c in counts]) + 1
    n = np.array([c[3] for c in counts], float)
    yes = 1 / (1 + np.exp(-1.5 * (cast - 1).sum(axis=1)))
    for _ in range(rounds):
        prior, says = np.zeros(len(KINDS)), np.zeros((2, VOTES, 3))
        for k in range(len(KINDS)):
            own = kind == k
            prior[k] = ((n * yes)[own].sum() + 1) / (n[own].sum() + 2)
        for label, weight in ((0, n * (1 - yes)), (1, n * yes)):
            for i in range(VOTES):
                table = np.bincount(cast[:, i], weight, 3) + 1
                says[label, i] = table / table.sum()
        logs = np.log(says)
        score = np.log(prior / (1 - prior))[kind]
        for i in range(VOTES):
            score = score + logs[1, i, cast[:, i]] - logs[0, i, cast[:, i]]
        yes = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
    x = np.array([vector(*c[:3]) for c in counts])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (yes - p)) - 0.1 * weights
        curvature = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 0.1 * np.eye(len(weights))
        weights = weights + np.linalg.solve(curvature, gradient)
    return Model(weights, says[1] / (says[0] + says[1]))


def accepted(base: list[Span], candidates, model: Model) -> list[Span]:
    """Candidates the classifier takes that overlap nothing reported before, in order."""
    taken = sorted((a, b) for _, a, b in base)
    added = []
    end = 0
    at = 0
    for kind, a, b, packed, shape in sorted(candidates, key=lambda c: (c[1], -c[2], c[0])):
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        blocked = at < len(taken) and taken[at][0] < b
        # A base match that failed its check bears on the statistics, but stays out.
        failed = kind < BASE and unpack(packed)[0] < 0
        if not blocked and not failed and a >= end and model.accepts(kind, packed, shape):
            added.append((kind, a, b))
            end = b
    return added


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``base`` and ``added``, arrays of (kind, start, end).

    Texts are read once; what is counted and decided afterwards are the few candidates.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"))
    found = staged(texts.mapInArrow(_find, f"id {kind}, base {_ARRAY}, candidates {_CANDIDATES}"))
    each = found.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.shape")
    counts = [tuple(row) for row in each.groupBy("kind", "votes", "shape").count().collect()]
    model = train(sorted(counts))
    decided = found.mapInArrow(
        functools.partial(_decide, model=model), f"id {kind}, base {_ARRAY}, added {_ARRAY}"
    )
    return decided.withColumnRenamed("id", id_col)


_ARRAY = "array<struct<kind int, start int, end int>>"
_CANDIDATES = "array<struct<kind int, start int, end int, votes int, shape int>>"
_SPAN = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end")]))
_CANDIDATE = pa.list_(
    pa.struct([(n, pa.int32()) for n in ("kind", "start", "end", "votes", "shape")])
)


def _rows(spans, names) -> list[dict]:
    return [dict(zip(names, span, strict=True)) for span in spans]


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find(text) for text in batch["text"].to_pylist()]
        base = [_rows(b, ("kind", "start", "end")) for b, _ in found]
        candidates = [_rows(c, ("kind", "start", "end", "votes", "shape")) for _, c in found]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], pa.array(base, _SPAN), pa.array(candidates, _CANDIDATE)],
            ["id", "base", "candidates"],
        )


def _decide(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        added = []
        for base, candidates in zip(
            batch["base"].to_pylist(), batch["candidates"].to_pylist(), strict=True
        ):
            spans = [tuple(b.values()) for b in base]
            chosen = accepted(spans, [tuple(c.values()) for c in candidates], model)
            added.append(_rows(chosen, ("kind", "start", "end")))
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["base"], pa.array(added, _SPAN)], ["id", "base", "added"]
        )
