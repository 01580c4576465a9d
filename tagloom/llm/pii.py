"""Personal data by weak supervision (op1).

Base kinds (email, ip, card, phone) come from fixed patterns and checks and always stay. Looser
proposals add candidate spans of the same kinds and of secrets, account ids and names. Six labelers
vote on every candidate: its pattern, its checksum or form, a gazetteer, the words around it, its
characters, and its borders. Candidates are summed up as *signatures* (kind, votes, binned length and
digit share), so the whole corpus comes down to a table of at most ``SIGNATURES`` counts. Expectation
maximisation on that table estimates, for each kind, how reliable each labeler is; its posteriors
train the final classifier, a logistic regression over votes and shape, which accepts a candidate
from ``ACCEPT``. A candidate that holds more than base spans is voted on, and an accepted span stays
unless the spans before it already cover it whole; so spans may overlap, and masking takes overlapping
ones as one.

Defined results: null and empty texts have no spans; repeated rows and null ids are judged row by
row; a corpus without candidates has base spans only (there are none then). Offsets are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.batches import map_arrow, map_texts, strings
from tagloom.session import cut_lineage

KINDS = ("email", "ip", "card", "phone", "secret", "account", "name")
BASE_KINDS = 4
ACCEPT = 0.5
LABELERS = 6
LENGTHS, DIGITS = 8, 4
SIGNATURES = len(KINDS) * 3**LABELERS * LENGTHS * DIGITS
CONTEXT = 28  # code points before a span that the context labeler reads

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match can only begin where a run of digits does
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# looser proposals of the labelled kinds
_LOOSE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]++)++"),
    "phone": re.compile(r"(?<![\w+.-])(?:\([0-9]{2,4}\) ?|0[0-9]{1,4}[ /-]|[0-9]{3}[ .-])[0-9]{3,4}[ .-][0-9]{3,5}(?![\w-]|\.[0-9])"),
    # after the colon come blanks and at most three line ends; a quoted value runs to its closing quote, any other to its delimiter
    "secret": re.compile(r"(?i:\b(?:[a-z]++[_-])?(?:token|secret|password|passwd|pwd|apikey|api[_-]key|access[_-]key|private[_-]key)[\"']?)"
                         r"(?:[^\S\n]*+\n){0,3}+[^\S\n]*+[:=](?:[^\S\n]*+\n){0,3}+[^\S\n]*+"
                         r"(?:\"([^\"\n]{6,}+)\"|'([^'\n]{6,}+)'|[\"']?([^\s\"'<>,;]{6,}+))"),
    "account": re.compile(r"(?<!\w)(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?|[0-9]{3}-[0-9]{2}-[0-9]{4})(?!\w)"),
    "name": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sra?)\.? [^\W\d_a-z](?:\w|['’-]\w)++(?: [^\W\d_a-z](?:\w|['’-]\w)++)*+"),
}
_KEYWORD = re.compile(r"(?i)token|secret|passw|pwd|[_-]?key")
_CUES = {
    "email": re.compile(r"(?i)e-?mail|contact|write|schreib|courriel|correo|kontakt|from:|to:"),
    "ip": re.compile(r"(?i)\bip\b|address|host|server|from|client|adress|serveur|servidor"),
    "card": re.compile(r"(?i)card|visa|master|amex|karte|carte|tarjeta|pay"),
    "phone": re.compile(r"(?i)tel|phone|call|fax|mobil|cell|anruf|llam|appel|ruf"),
    "secret": re.compile(r"(?i)token|secret|passw|key|auth|credential"),
    "account": re.compile(r"(?i)iban|ssn|social|account|konto|compte|cuenta|bank"),
    "name": re.compile(r"(?i)name|dear|signed|sincerely|contact|herr|nom|nombre|from"),
}
_AGAINST = re.compile(r"(?i)version|isbn|figure|fig\.|table|page|section|chapter|§|price|order no|example|sample")
# fixed values: top-level domains and given names that the gazetteer labeler knows
_TOP_DOMAINS = frozenset("com org net edu gov mil int info biz name io co ai app dev me tv eu de fr es it uk us ca at ch be nl pl pt se no dk fi ie ru cn jp kr in br mx ar au nz".split())
_GIVEN_NAMES = frozenset(
    "james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth barbara susan "
    "jessica sarah karen anna maria peter paul hans klaus jürgen wolfgang heinz ursula monika petra sabine karin jean pierre michel "
    "philippe alain nicolas marie nathalie isabelle sylvie catherine françoise antonio josé manuel francisco juan javier carlos "
    "carmen ana isabel laura cristina marta lucía pablo luis miguel daniel mark george edward brian anthony kevin laura emma julia".split())


def luhn(digits: str) -> bool:
    """Whether a string of digits passes the Luhn check."""
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each base kind: leftmost matches that do not overlap, less those that fail their check."""
    emails = []
    at, last, before = text.find("@"), 0, 0
    while at >= 0:
        # the run of local characters that ends here, not before the last match
        low = max(last, before)
        start = low + len(text[low:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            emails.append((start, m.end()))
            last = m.end()
        before = at + 1
        at = text.find("@", max(before, last))
    ips = [m.span() for m in _IP.finditer(text) if all(map(_at_most_255, m[0].split(".")))]
    cards, phones = [], []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                phones.append(m.span())
    return [emails, ips, cards, phones]


def loose_spans(text: str, digits: bool) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the looser proposals."""
    out = []
    if "(at)" in text or "[at]" in text or "(AT)" in text or "[AT]" in text:
        out += [(0, *m.span()) for m in _LOOSE["email"].finditer(text)]
    if digits:
        out += [(3, *m.span()) for m in _LOOSE["phone"].finditer(text)]
        out += [(5, *m.span()) for m in _LOOSE["account"].finditer(text)]
    if ("=" in text or ":" in text) and _KEYWORD.search(text):
        out += [(4, *m.span(m.lastindex)) for m in _LOOSE["secret"].finditer(text)]
    out += [(6, *m.span()) for m in _LOOSE["name"].finditer(text)]
    return out


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(k / n * np.log2(k / n) for k in Counter(s).values())


def _iban(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(text: str, kind: int, start: int, end: int, base: bool) -> list[int]:
    """Each labeler's vote on a span: 1 personal, -1 not, 0 silent."""
    name, s = KINDS[kind], text[start:end]
    digits = _NOT_DIGIT.sub("", s)
    pattern = 1 if base or kind >= BASE_KINDS else 0
    if name == "card":
        form = 1 if luhn(digits) else -1
    elif name == "ip":
        form = -1 if s.split(".")[0].lstrip("0") in ("", "127", "255") else 1
    elif name == "phone":
        form = 1 if 9 <= len(digits) <= 15 else -1
    elif name == "account":
        form = (1 if _iban(s) else -1) if s[0].isalpha() else 0
    elif name == "secret":
        form = 1 if len(s) >= 16 else 0
    else:
        form = 0
    gazetteer = 0
    if name == "email":
        gazetteer = 1 if s.rsplit(".", 1)[-1].strip().lower() in _TOP_DOMAINS else -1
    elif name == "name":
        gazetteer = 1 if any(w.lower() in _GIVEN_NAMES for w in s.split()[1:]) else 0
    around = text[max(0, start - CONTEXT) : start]
    context = 1 if _CUES[name].search(around) else -1 if _AGAINST.search(around) else 0
    if name in ("secret", "email"):
        characters = 1 if name == "email" or _entropy(s) >= 3 else -1
    elif name == "name":
        characters = -1 if s.isupper() else 0
    else:
        characters = -1 if len(set(digits)) <= 2 else 1
    left, right = text[start - 1 : start], text[end : end + 1]
    borders = -1 if (s[0].isalnum() and left.isalnum()) or (s[-1].isalnum() and right.isalnum()) else 1
    return [pattern, form, gazetteer, context, characters, borders]


def signature(text: str, kind: int, start: int, end: int, base: bool) -> int:
    """kind, votes and binned shape of a span as one integer below SIGNATURES."""
    code = kind
    for v in votes(text, kind, start, end, base):
        code = 3 * code + v + 1
    size = end - start
    share = sum(c.isdigit() for c in text[start:end]) / size
    return (code * LENGTHS + min(LENGTHS - 1, size.bit_length() - 1)) * DIGITS + min(DIGITS - 1, int(share * DIGITS))


def unpack(signatures: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kinds, votes (-1, 0, 1 by labeler) and shape bins of signatures."""
    shape = signatures % (LENGTHS * DIGITS)
    code = signatures // (LENGTHS * DIGITS)
    v = np.stack([code // 3 ** (LABELERS - 1 - i) % 3 - 1 for i in range(LABELERS)], axis=1)
    return code // 3**LABELERS, v, shape


def reliabilities(kind: np.ndarray, vote: np.ndarray, count: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior probability of each signature, by expectation-maximisation within each kind.

    A labeler votes -1, 0 or 1 with probabilities that depend on the truth and the kind; they start
    from the majority vote and have a weak prior towards labelers being better than chance.
    """
    posterior = 1 / (1 + np.exp(-vote.sum(axis=1).astype(float)))
    for k in np.unique(kind):
        at = kind == k
        n, v = count[at].astype(float), vote[at]
        p = posterior[at]
        for _ in range(rounds):
            share = (np.dot(n, p) + 1) / (n.sum() + 2)
            score = np.full(len(n), np.log(share / (1 - share)))
            for i in range(LABELERS):
                table = np.zeros((2, 3))
                for truth, weight in ((1, n * p), (0, n * (1 - p))):
                    table[truth] = np.bincount(v[:, i] + 1, weights=weight, minlength=3) + ([1, 1, 4] if truth else [4, 1, 1])
                table /= table.sum(axis=1, keepdims=True)
                score += np.log(table[1, v[:, i] + 1] / table[0, v[:, i] + 1])
            p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        posterior[at] = p
    return posterior


def _design(kind: np.ndarray, vote: np.ndarray, shape: np.ndarray) -> np.ndarray:
    parts = [np.ones((len(kind), 1)), np.eye(len(KINDS))[kind]]
    parts += [np.eye(3)[vote[:, i] + 1] for i in range(LABELERS)]
    parts += [np.eye(LENGTHS)[shape // DIGITS], np.eye(DIGITS)[shape % DIGITS]]
    return np.concatenate(parts, axis=1)


@dataclass
class SpanClassifier:
    weights: np.ndarray | None = None

    @classmethod
    def fit(cls, signatures: np.ndarray, count: np.ndarray) -> SpanClassifier:
        """Logistic regression on the posteriors of all signatures, weighted by their counts (Newton steps)."""
        if not len(signatures):
            return cls()
        kind, vote, shape = unpack(signatures)
        target = reliabilities(kind, vote, count)
        x = _design(kind, vote, shape)
        n = count / count.sum() * len(count) + 0.05  # rare signatures keep a say
        w = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            g = x.T @ (n * (p - target)) + 0.01 * w
            h = (x * (n * (p * (1 - p) + 1e-4))[:, None]).T @ x + 0.01 * np.eye(len(w))
            step = np.linalg.solve(h, g)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        return cls(w)

    def accepts(self, signatures: list[int], at_least: float = ACCEPT) -> np.ndarray:
        if self.weights is None or not len(signatures):
            return np.zeros(len(signatures), bool)
        z = _design(*unpack(np.asarray(signatures, dtype=np.int64))) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))) >= at_least


def candidates(text: str) -> list[tuple[int, int, int, int, bool]]:
    """(kind, start, end, signature, base) of all candidate spans of a text, by kind and start."""
    digits = re.search("[0-9]", text) is not None
    base = base_spans(text) if digits or "@" in text else [[], [], [], []]
    out = [(k, a, b, signature(text, k, a, b, True), True) for k, spans in enumerate(base) for a, b in spans]
    taken = bytearray(max((x[2] for x in out), default=0))
    for _, a, b, _, _ in out:
        taken[a:b] = b"\x01" * (b - a)
    out += [(k, a, b, signature(text, k, a, b, False), False) for k, a, b in loose_spans(text, digits) if taken.count(1, a, b) < b - a]
    return sorted(out)


def resolve(found: list[tuple[int, int, int, bool]], taken: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of base spans and of accepted ones that the spans before them do not cover whole."""
    spans = [f[:3] for f in found if f[3]]
    used = bytearray(max((f[2] for f in found), default=0))
    for _, a, b in spans:
        used[a:b] = b"\x01" * (b - a)
    for (k, a, b, base), good in zip(found, taken):
        if not base and good and used.count(1, a, b) < b - a:
            spans.append((k, a, b))
            used[a:b] = b"\x01" * (b - a)
    return sorted(spans)


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_candidates(docs: DataFrame) -> DataFrame:
    """doc_id and the candidate spans of every row, as parallel arrays."""

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        found = [candidates(t) for t in strings(piece.column("text"))]
        columns = [pa.array([[x[i] for x in f] for f in found], pa.list_(t))
                   for i, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))]
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns],
                                          names=["doc_id", "kind", "start", "end", "signature", "base"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(rows, fn, "doc_id long, kind array<int>, start array<long>, end array<long>, signature array<long>, base array<boolean>")


def train(found: DataFrame) -> SpanClassifier:
    """The classifier from the counts of all signatures of the corpus (at most SIGNATURES rows)."""
    counts = found.select(F.explode("signature").alias("s")).groupBy("s").agg(F.count("*").alias("n")).collect()
    counts.sort()
    return SpanClassifier.fit(np.array([c[0] for c in counts], dtype=np.int64), np.array([c[1] for c in counts], dtype=np.int64))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of docs(doc_id, text)."""
    found = cut_lineage(find_candidates(docs), "candidates")
    model = train(found)

    def run(batches):
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("kind", "start", "end", "signature", "base"))))
            counts, sums, texts = [[] for _ in range(BASE_KINDS)], [], []
            for kind, start, end, sig, base in rows:
                spans = list(zip(kind, start, end, base))
                own = [s[:3] for s in spans if s[3]]
                for k in range(BASE_KINDS):
                    counts[k].append(sum(s[0] == k for s in own))
                sums.append(hashlib.sha256(listed(own).encode()).hexdigest())
                texts.append(listed(resolve(spans, model.accepts(sig))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(sums, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return map_arrow(found, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span (overlapping ones as one) replaced by its kind in brackets."""
    out, last, name = [], 0, None
    merged: list[list] = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, KINDS[k]])
    for a, b, name in merged:
        out += [text[last:a], f"[{name.upper()}]"]
        last = b
    return "".join([*out, text[last:]])


def redact(docs: DataFrame) -> DataFrame:
    """docs with personal data masked in ``text`` (and ``n_chars``, if there, recounted); all rows and columns stay."""
    found = cut_lineage(find_candidates(docs).select("signature").where(F.size("signature") > 0), "signatures")
    model = train(found)

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = piece.column("text").to_pylist()
        for i, text in enumerate(texts):
            if text:
                spans = candidates(text)
                if spans:
                    good = model.accepts([s[3] for s in spans])
                    texts[i] = masked(text, resolve([(*s[:3], s[4]) for s in spans], good))
        at = piece.schema.get_field_index("text")
        piece = piece.set_column(at, piece.schema.field(at), pa.array(texts, piece.schema.field(at).type))
        at = piece.schema.get_field_index("n_chars")
        if at >= 0:
            kind = piece.schema.field(at).type
            piece = piece.set_column(at, piece.schema.field(at), pa.array([None if t is None else len(t) for t in texts]).cast(kind))
        return piece

    return map_texts(docs, fn, docs.schema)
