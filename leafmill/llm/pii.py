"""Personal data by weak supervision over labelers.

Candidates come from patterns: the four base kinds, which always count, and
further shapes (base shapes inside a match that failed as a whole, social
security numbers, national phone numbers, spelled-out addresses, credentials).
On each candidate, labelers vote yes, no or abstain: strict patterns,
checksums, gazetteers and context words. The further candidates' votes are
counted over all documents by kind; for each kind, expectation-maximisation over
that bounded table estimates what each labeler says of true and of false
candidates, its silence included. The posteriors train a logistic classifier on
kind and votes, which has the last word on the further candidates.

All scanning is linear in the text, whatever it holds.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices, spread

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ssn", "credential")
LABELERS = ("strict", "checksum", "gazetteer", "context", "counter_context", "borders")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NON_DIGIT = re.compile(r"[^0-9]+")

_FURTHER = (
    ("phone", re.compile(r"\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z+.])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<![0-9A-Za-z.-])[0-9]{14,19}(?![0-9A-Za-z])")),
    ("card", re.compile(r"(?<![0-9A-Za-z.-])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9A-Za-z])")),
    ("ssn", re.compile(r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])")),
)
_SPELLED = re.compile(r" (?:\(at\)|\[at\]) ([A-Za-z0-9-]{1,63}) (?:\(dot\)|\[dot\]|dot) ([A-Za-z]{2,24})\b")
_KEYED = re.compile(r"\b(?:[Pp]assword|PASSWORD|passwd|[Tt]oken|TOKEN|[Ss]ecret|SECRET|api_?key|API_?KEY)\s{0,3}[=:]\s{0,3}(\"?)([A-Za-z0-9_+/-]{8,}+)\1")
_ACCESS_KEY = re.compile(r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])")

_ENDINGS = frozenset("com org net edu gov mil int info biz io co de fr es uk us eu it nl ch at be ca au jp cn in br ru pl se no dk fi pt".split())
_CUES = {
    "email": "mail e-mail email contact write correo courriel",
    "ip": "ip address host server client login adresse dirección",
    "card": "card visa mastercard credit payment carte karte tarjeta iban account",
    "phone": "phone tel call mobile fax telephone telefon teléfono téléphone contact",
    "ssn": "ssn social security",
    "credential": "password token secret key login credentials",
}
_CUES = {k: frozenset(v.split()) for k, v in _CUES.items()}
_COUNTER = frozenset("version release section page chapter figure isbn issn order invoice build license clause".split())
_LETTERS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, @ and dotted domain, each character looked at a few times."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            after = m.end()
        else:
            after = max(after, at + 1)
        at = text.find("@", after)


def _ips(text: str) -> Iterator[tuple[int, int, bool]]:
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            yield start, end, all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 and len(p.lstrip("0")) == len(p[-3:].lstrip("0")) for p in four)
            start = end + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the four base kinds, by start and kind."""
    found = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        found += [("ip", a, b) for a, b, ok in _ips(text) if ok]
        for m in _CARD.finditer(text):
            d = _NON_DIGIT.sub("", m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NON_DIGIT.sub("", m.group())) <= 15:
                    found.append(("phone", *m.span()))
    return in_order(found)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Further spans that may be personal data, none overlapping another or a base span."""
    return _further(text, base_spans(text))


def _further(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    taken = sorted((a, b) for _, a, b in base)
    found = []
    if _DIGIT.search(text):
        for kind, pattern in _FURTHER:
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
    if "AKIA" in text:
        found += [("credential", *m.span()) for m in _ACCESS_KEY.finditer(text)]
    if "=" in text or ":" in text:
        found += [("credential", *m.span(2)) for m in _KEYED.finditer(text)]
    if "at" in text:
        for m in _SPELLED.finditer(text):
            start = m.start()
            while start > 0 and m.start() - start < 64 and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                found.append(("email", start, m.end()))
    out, free_from, k = [], 0, 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if a < free_from or (k < len(taken) and taken[k][0] < b):
            continue
        out.append((kind, a, b))
        free_from = b
    return out


def label(text: str, kind: str, start: int, end: int) -> str:
    """The LABELERS' votes on a span, one character each: y, n or - for abstaining."""
    body = text[start:end]
    digits = _NON_DIGIT.sub("", body) if kind != "credential" else ""
    if kind == "card":
        checksum = "y" if 14 <= len(digits) <= 19 and luhn(digits) else "n"
        strict = "y" if len(digits) in (15, 16) else "-"
        gazetteer = "y" if digits[:1] in "3456" else "n"
    elif kind == "phone":
        checksum = "y" if 10 <= len(digits) <= 15 else "n"
        strict = "y" if body[:1] == "+" else "-"
        gazetteer = "n" if len(set(digits)) == 1 else "-"
    elif kind == "ip":
        checksum, strict = "y", "y"
        gazetteer = "n" if body.startswith(("0.", "127.")) else "-"
    elif kind == "ssn":
        checksum = "n" if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else "y"
        strict, gazetteer = "y", "-"
    elif kind == "email":
        ending = re.split(r"[.\s]", body)[-1].lower()
        checksum = "-"
        strict = "y" if "@" in body else "-"
        gazetteer = "y" if ending in _ENDINGS else "n"
    else:
        kinds = sum(any(f(c) for c in body) for f in (str.isdigit, str.isalpha))
        checksum = "y" if kinds == 2 and len(set(body)) >= 6 else "n"
        strict = "y" if body.startswith("AKIA") or len(body) >= 16 else "-"
        gazetteer = "n" if body.lower() in ("password", "changeme", "placeholder") else "-"
    near = {w.lower() for w in _LETTERS.findall(text[max(0, start - 48) : start])[-5:]}
    context = "y" if near & _CUES[kind] else "-"
    counter = "n" if near & _COUNTER else "-"
    left, right = text[start - 1 : start], text[end : end + 1]
    borders = "n" if left.isalnum() or right.isalnum() else "y"
    return strict + checksum + gazetteer + context + counter + borders


VOTES = "yn-"
#: What labelers are expected to say (y, n, -) of true and of false candidates before any is seen, worth STRENGTH candidates.
#: A checksum can't fail on the real thing but for a slip, and one random number in ten passes it.
EXPECTED = {
    "strict": ((0.60, 0.05, 0.35), (0.40, 0.20, 0.40)),
    "checksum": ((0.75, 0.02, 0.23), (0.10, 0.67, 0.23)),
    "gazetteer": ((0.50, 0.10, 0.40), (0.30, 0.30, 0.40)),
    "context": ((0.40, 0.01, 0.59), (0.10, 0.01, 0.89)),
    "counter_context": ((0.01, 0.04, 0.95), (0.01, 0.20, 0.79)),
    "borders": ((0.90, 0.05, 0.05), (0.60, 0.35, 0.05)),
}
STRENGTH, ROUNDS = 20.0, 50
#: Candidates of each kind that the classifier learns from besides the corpus's: every pattern of votes, by its expected share.
IMAGINED = 20.0


@dataclass(frozen=True)
class SpanModel:
    """prior: share of true candidates by kind; says[kind][z, j, v]: P(labeler j says v) of false (z = 0) and true candidates; weights of the classifier."""

    prior: dict[str, float]
    says: dict[str, np.ndarray]
    weights: dict[str, float]

    def probability(self, kind: str, votes: str) -> float:
        return float(1 / (1 + np.exp(-sum(self.weights.get(f, 0.0) for f in features(kind, votes)))))


def features(kind: str, votes: str) -> list[str]:
    return [kind, *(f"{kind}:{n}={v}" for n, v in zip(LABELERS, votes, strict=True))]


def estimate(votes: list[str], n: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation for one kind: share of true candidates, what labelers say, and each pattern's posterior."""
    expected = np.array([[EXPECTED[name][1 - z] for name in LABELERS] for z in (0, 1)])
    at = np.array([[VOTES.index(v) for v in pattern] for pattern in votes], int).reshape(-1, len(LABELERS))
    j = np.arange(len(LABELERS))
    prior, says, post = 0.5, expected, np.zeros(len(votes))
    for _ in range(ROUNDS if len(votes) else 0):
        like = np.log([1 - prior, prior])[:, None] + np.log(says[:, j, at]).sum(axis=2)
        post = 1 / (1 + np.exp(like[0] - like[1]))
        prior = (n @ post + 0.5 * STRENGTH) / (n.sum() + STRENGTH)
        seen = np.zeros_like(says)
        for z, weight in ((0, n * (1 - post)), (1, n * post)):
            np.add.at(seen[z], (j, at), np.repeat(weight[:, None], len(LABELERS), axis=1))
        says = (seen + STRENGTH * expected) / (seen + STRENGTH * expected).sum(axis=2, keepdims=True)
    return float(prior), says, post


def train(table: list[tuple[str, str, int]], steps: int = 100) -> SpanModel:
    """Fit on (kind, votes, count) rows of further candidates: EM for each kind, then the classifier on the posteriors."""
    patterns = ["".join(p) for p in itertools.product(VOTES, repeat=len(LABELERS))]
    at = np.array([[VOTES.index(v) for v in p] for p in patterns])
    priors, says, weights = {}, {}, {}
    for kind in KINDS:
        own = sorted((v, c) for k, v, c in table if k == kind)
        n = np.array([c for _, c in own], float)
        priors[kind], says[kind], post = estimate([v for v, _ in own], n)
        both = np.stack([p * says[kind][z][np.arange(len(LABELERS)), at].prod(axis=1) for z, p in ((0, 1 - priors[kind]), (1, priors[kind]))])
        names = sorted({f for p in patterns for f in features(kind, p)})
        place = {f: i for i, f in enumerate(names)}
        x = np.zeros((len(own) + len(patterns), len(names)))
        for i, p in enumerate([v for v, _ in own] + patterns):
            x[i, [place[f] for f in features(kind, p)]] = 1
        y, share = np.concatenate((post, both[1] / both.sum(axis=0))), np.concatenate((n, IMAGINED * both.sum(axis=0)))
        w = np.zeros(len(names))
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hess = (x * (share * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(names))
            step = np.linalg.solve(hess, x.T @ (share * (y - p)) - 0.01 * w)
            w = w + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-7:
                break
        weights |= dict(zip(names, w.tolist(), strict=True))
    return SpanModel(priors, says, weights)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for whole in batches:
        for batch in slices(whole, "text"):
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update((k, label(text, k, a, b)) for k, a, b in candidates(text))
    keys = list(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in keys], pa.string()), pa.array([v for _, v in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())],
        ["kind", "votes", "n"],
    )


def fit(docs: DataFrame) -> SpanModel:
    """The span model of a corpus: every further candidate of every document is counted.

    The driver gets one row per kind and vote pattern, at most 6 * 3**6. Null
    texts have none; an empty table gives a model of what is expected alone.
    """
    counted = spread(docs.select("text")).mapInArrow(_votes, "kind string, votes string, n long")
    rows = counted.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()
    return train([(r["kind"], r["votes"], r["n"]) for r in rows])


def spans(text: str, model: SpanModel, threshold: float = 0.5) -> tuple[list, list]:
    """Base spans and all spans of a text: the base ones and those candidates that the classifier accepts."""
    base = base_spans(text)
    more = [s for s in _further(text, base) if model.probability(s[0], label(text, *s)) >= threshold]
    return base, in_order(base + more) if more else base


def written(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with each span, or union of overlapping spans, replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in found:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, model: SpanModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans and n_spans (their number), a row for each row.

    Null and empty texts have no span (the digest is that of the empty string).
    Repeated rows, and rows without an id, are treated like others; other
    columns aren't read, whatever their names; an empty table gives an empty
    result. Spans with one start come in the order of KINDS. Offsets are code
    points, ends exclusive; a text of any length is scanned whole.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = [spans(t, model, threshold) if t else ([], []) for t in batch.column("text").to_pylist()]
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in rows], pa.int64()) for k in BASE]
                digests = pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in rows], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *counts, digests, pa.array([written(s) for _, s in rows], pa.string()), pa.array([len(s) for _, s in rows], pa.int64())],
                    ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_spans"],
                )

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"
    return spread(docs.select("doc_id", "text")).mapInArrow(each, schema)


def redacted(docs: DataFrame, model: SpanModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced by kind names; all other columns, of any name, as they are.

    Every row stays, those without an id and repeated ones too; null texts stay
    null and empty ones empty; an empty table gives an empty result.
    """

    at = docs.columns.index("text")
    numbered = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))  # no name can be in the way

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, f"c{at}"):
                texts = [redact(t, spans(t, model, threshold)[1]) if t else t for t in batch.column(at).to_pylist()]
                yield batch.set_column(at, f"c{at}", pa.array(texts, pa.string()))

    return spread(numbered).mapInArrow(each, numbered.schema).toDF(*docs.columns)
