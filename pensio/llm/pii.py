"""Personal data: overlapping candidates from generous generators, selected by boosted trees.

Spans that meet the base rules are always kept. Beside them, generous patterns propose spans that the base rules do not
read as personal data: addresses written with "(at)" and "[dot]", phone numbers without a plus sign, cards cut by dots,
and, as a kind of its own, secrets (long words of letters and digits). Boosted trees score such a span by its format and
the words around it; a span is added where its score reaches the threshold calibrated for its kind and it overlaps no
other.

The trees learn from a bounded sample of documents. Examples are the base spans in looser spellings; counter-examples
are the same spans broken - a digit that spoils the Luhn sum, a part above 255, a version number, a date, too few
digits, a host without a domain - in the same surroundings, and all candidates of the sample that fail the base rules.
A secret is an example where a word such as "token" or "password" stands before it or its format is a known one, and
once more without its surroundings; other long words are counter-examples. Thresholds come from a held-out third. A
kind without counter-examples, or whose held-out candidates never reach the wanted precision, gets no additions. Null
and empty texts have no spans; equal rows get equal results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from pensio.llm.boosting import Trees
from pensio.llm.common import map_batches

KINDS = ("email", "ip", "card", "phone")
ADDED = (*KINDS, "secret")  # kinds of the method; base spans have the first four
SAMPLE_DOCUMENTS = 4000  # documents the trees learn from, at most
SAMPLE_CANDIDATES = 20_000
PRECISION = 0.995
SURE = 20  # examples a kind needs

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_LOOSE = {
    "email": re.compile(
        r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,64}"
        r"(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z0-9-]{1,64}){0,8}"
    ),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\x20\.\x20|\.)[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{3,6}(?:[.\x20/_-]?[0-9]{2,6}){2,4}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])\(?[0-9]{1,4}\)?(?:[.\x20/-]\(?[0-9]{2,4}\)?){2,4}(?![0-9A-Za-z])"),
    "secret": re.compile(r"[A-Za-z0-9+/_-]{16,}"),
}
_HINTS = {
    "email": re.compile(r"e?-?mail|write|contact", re.I),
    "ip": re.compile(r"\bip\b|host|server|address", re.I),
    "card": re.compile(r"card|visa|credit|account", re.I),
    "phone": re.compile(r"phone|tel|call|mobile|fax", re.I),
    "secret": re.compile(r"(?:token|secret|passw(?:or)?d|pwd|key)\W{0,4}$", re.I),
}
#: Formats of access keys that say what they are. Fixed values.
_KNOWN = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches around each @: the longest run of local characters before it, none of an earlier match."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans by the base rules, by start and then kind."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
                if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                    out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[Span]:
    """Spans of the generous patterns; they may overlap each other and base spans."""
    out = []
    if "at)" in text or "at]" in text:
        out += [("email", *m.span()) for m in _LOOSE["email"].finditer(text)]
    if _DIGIT.search(text):
        for kind in KINDS[1:]:
            out += [(kind, *m.span()) for m in _LOOSE[kind].finditer(text)]
    out += [("secret", *m.span()) for m in _LOOSE["secret"].finditer(text)]
    return out


def features(kind: str, span: str, left: str, right: str) -> list[float]:
    """Format and context of a span: its kind, characters and groups, and what stands around it."""
    digits = [c for c in span if "0" <= c <= "9"]
    size = max(1, len(span))
    groups = re.split(r"[^0-9]+", span)
    groups = [g for g in groups if g] or [""]
    parts = [int(g) for g in groups if len(g) <= 4 and g] or [0]
    return [
        ADDED.index(kind),
        len(span),
        len(digits),
        len(digits) / size,
        sum("A" <= c <= "Z" for c in span) / size,
        sum("a" <= c <= "z" for c in span) / size,
        sum(c in "0123456789abcdefABCDEF" for c in span) / size,
        sum(("0" <= c <= "9") != ("0" <= d <= "9") for c, d in zip(span, span[1:])) / size,
        float(bool(_KNOWN.fullmatch(span))),
        len(groups),
        max(map(len, groups)),
        min(map(len, groups)),
        len(groups[0]),
        len(groups[-1]),
        max(parts),
        float(luhn("".join(digits))) if digits else 0.0,
        span.count("."),
        span.count(".") + span.count("dot"),
        span.count("-") + span.count("/"),
        span.count(" "),
        span.count("(") + span.count("["),
        float("@" in span or "at)" in span or "at]" in span),
        float("dot" in span),
        float(span[:1] in "+("),
        float(left[-1:].isalnum()),
        float(right[:1].isalnum()),
        float(left[-1:] in "=\"'#$/"),
        float(bool(_HINTS[kind].search(left))),
        float(left.rstrip()[-7:].lower() == "version" or left[-1:] in "vV"),
        float(right[:1] == "." and right[1:2].isdigit()),
        float(sum("0" <= c <= "9" for c in left + right)),
    ]


def _around(text: str, a: int, b: int) -> tuple[str, str, str]:
    return text[a:b], text[max(0, a - 16) : a], text[b : b + 8]


def _looser(kind: str, span: str) -> list[str]:
    """Other spellings of a base span, as the generous patterns read them."""
    if kind == "email":
        name, _, host = span.partition("@")
        return [f"{name} (at) {host}", f"{name}[at]{host.replace('.', '[dot]')}"]
    if kind == "ip":
        return [span.replace(".", "[.]")]
    if kind == "card":
        digits = re.sub(r"[^0-9]", "", span)
        return [sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)) for sep in (".", "/")]
    digits = re.sub(r"[^0-9]", "", span)
    return [span.lstrip("+"), f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}"]


def _broken(kind: str, span: str, left: str, right: str) -> list[tuple[str, str, str]]:
    """Spans made from a base span that look like one and are none, with what stands around them."""
    digits = re.sub(r"[^0-9]", "", span)
    if kind == "email":
        name, _, host = span.partition("@")
        first = host.split(".")[0]
        before, after = (re.findall(r"[A-Za-z0-9]+", x) or ["x"] for x in (left, right))
        spans = [f"{name} (at) {first}", f"{name}[at]{len(name)}.{len(host)}", f"{before[-1]} (at) {after[0]}"]
    elif kind == "ip":
        parts = span.split(".")
        high = [*parts[:1], str(256 + int(parts[1]) % 700), *parts[2:]]
        version = ".".join(str(int(x) % 10) for x in parts)
        return [("[.]".join(high), left, right), (".".join(high), left, right), (version, "version ", right), (version, left, ".1" + right[:6])]
    elif kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + int(digits[0]) % 8) % 10)
        spans = [*_looser("card", wrong), wrong]
    else:
        day = f"{1990 + int(digits[-2:]) % 40}", f"{1 + int(digits[-3:]) % 12:02d}", f"{1 + int(digits[:3]) % 28:02d}"
        spans = ["-".join(day), ".".join(reversed(day)), f"{digits[:2]} {digits[2:4]} {digits[4:6]}"]
    return [(s, left, right) for s in spans]


def plain(kind: str, span: str) -> str:
    """The usual spelling of a candidate."""
    if kind == "email":
        return re.sub(r"[\[(]dot[\])]", ".", re.sub(r"[\[(]at[\])]", "@", span)).replace(" ", "")
    if kind == "ip":
        return span.replace("[", "").replace("]", "").replace(" ", "")
    return re.sub(r"[^0-9]", "", span)


def examples(text: str) -> list[tuple[int, list[float]]]:
    """Labelled candidates of one text: base spans in looser spellings, the same broken, and other candidates that
    touch none."""
    base = base_spans(text)
    out = []
    for kind, a, b in base:
        span, left, right = _around(text, a, b)
        whole = _LOOSE[kind].fullmatch
        out += [(1, features(kind, s, left, right)) for s in _looser(kind, span) if whole(s)]
        out += [(0, features(kind, *near)) for near in _broken(kind, span, left, right) if whole(near[0])]
    for kind, a, b in candidates(text):
        if any(a < d and c < b for _, c, d in base):
            continue
        span, left, right = _around(text, a, b)
        if kind == "secret":
            sure = bool(_HINTS[kind].search(left) or _KNOWN.fullmatch(span))
            out.append((int(sure), features(kind, span, left, right)))
            if sure:
                out.append((1, features(kind, span, "", "")))
            continue
        usual = plain(kind, span)
        # What meets the base rule once it is spelled as usual speaks neither for nor against.
        if (kind, 0, len(usual)) not in base_spans(usual):
            out.append((0, features(kind, span, left, right)))
    return out


class Model:
    """Trees and a threshold for each kind; a threshold above 1 adds nothing."""

    def __init__(self, labels: np.ndarray, rows: np.ndarray, precision: float = PRECISION):
        self.trees: dict[str, Trees] = {}
        self.thresholds: dict[str, float] = {}
        for i, kind in enumerate(ADDED):
            own = rows[:, 0] == i
            x, y = rows[own], labels[own]
            held = np.arange(len(y)) % 3 == 0
            self.thresholds[kind] = 2.0
            if len(y) >= SURE and all(part.any() and not part.all() for part in (y[held], y[~held])):
                self.trees[kind] = Trees(x[~held], y[~held])
                self.thresholds[kind] = _threshold(self.trees[kind].probability(x[held]), y[held], precision)

    def score(self, kind: str, span: str, left: str, right: str) -> float:
        return float(self.trees[kind].probability([features(kind, span, left, right)])[0])

    def added(self, text: str, base: list[Span]) -> list[Span]:
        free = [
            c for c in candidates(text)
            if self.thresholds[c[0]] <= 1 and not any(c[1] < d and a < c[2] for _, a, d in base)
        ]
        scored = sorted(((-self.score(k, *_around(text, a, b)), a, k, b) for k, a, b in free))
        out: list[Span] = []
        for p, a, kind, b in scored:
            if -p >= self.thresholds[kind] and not any(a < d and c < b for _, c, d in out):
                out.append((kind, a, b))
        return out


def _threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest score from which on candidates have the wanted precision, half way down to the next candidate."""
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    right = np.cumsum(y) / np.arange(1, len(y) + 1)
    last = np.append(p[1:] != p[:-1], True)  # a threshold takes all candidates of one score
    good = np.flatnonzero((right >= precision) & last & (p >= 0.5))
    if not len(good):
        return 2.0
    after = p[good[-1] + 1] if good[-1] + 1 < len(p) else 0.0
    return max(0.5, float(p[good[-1]] + after) / 2)


def fit(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """A model from the ``sample`` documents whose doc_ids hash lowest. Documents without doc_id are not sampled."""
    order = F.xxhash64("doc_id")
    lowest = docs.where("doc_id is not null").select(order.alias("h")).distinct().orderBy("h").limit(sample)
    bound = lowest.agg(F.max("h")).first()[0]
    if bound is None:
        return Model(np.zeros(0), np.zeros((0, 1)))

    def make():
        def step(batch):
            rows = [x for text in batch.column("text").to_pylist() if text for x in examples(text)]
            return {"label": [y for y, _ in rows], "row": [x for _, x in rows]}

        return step

    chosen = docs.where((order <= bound) & F.col("doc_id").isNotNull()).select("text")
    # A bounded sample: at most ``sample`` distinct ids, and no more than a fixed number of candidates.
    found = map_batches(chosen, "label int, row array<double>", make)
    rows = found.orderBy(F.xxhash64("row"), "row", "label").limit(SAMPLE_CANDIDATES).collect()
    labels = np.array([r.label for r in rows], float)
    return Model(labels, np.array([r.row for r in rows], float).reshape(len(rows), -1) if rows else np.zeros((0, 1)))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text, spans): all spans of each text as structs kind, start, stop, base; code points, stop exclusive."""

    def make():
        def step(batch):
            texts = batch.column("text").to_pylist()
            spans = []
            for text in texts:
                base = base_spans(text) if text else []
                more = model.added(text, base) if text else []
                both = [(*s, True) for s in base] + [(*s, False) for s in more]
                both.sort(key=lambda s: (s[1], ADDED.index(s[0])))
                spans.append([dict(zip(("kind", "start", "stop", "base"), s)) for s in both])
            return {"doc_id": batch.column("doc_id"), "text": batch.column("text"), "spans": spans}

        return step

    schema = "doc_id long, text string, spans array<struct<kind:string,start:long,stop:long,base:boolean>>"
    return map_batches(docs.select("doc_id", "text"), schema, make)


def digests(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document the counts and hash of its base spans, and all spans as text."""
    model = model or fit(docs)

    def make():
        def step(batch):
            out = {n: [] for n in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
            for text in batch.column("text").to_pylist():
                base = base_spans(text) if text else []
                more = model.added(text, base) if text else []
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
                out["base_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
                both = sorted(base + more, key=lambda s: (s[1], ADDED.index(s[0])))
                out["spans"].append(",".join(f"{k}:{a}:{b}" for k, a, b in both))
            return out | {"doc_id": batch.column("doc_id")}

        return step

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_batches(docs.select("doc_id", "text"), schema, make)


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; of overlapping spans, the union by the first."""
    out, done = [], 0
    for kind, a, b in spans:
        if a >= done:
            out += [text[done:a], f"<{kind}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` counted anew where there is any."""
    model = model or fit(docs)
    columns = docs.columns
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def make():
        def step(batch):
            texts, sizes = [], batch.column("n_chars").to_pylist() if "n_chars" in columns else []
            for i, text in enumerate(batch.column("text").to_pylist()):
                base = base_spans(text) if text else []
                spans = sorted(base + (model.added(text, base) if text else []), key=lambda s: (s[1], ADDED.index(s[0])))
                texts.append(redacted(text, spans) if spans else text)
                if spans and sizes:
                    sizes[i] = len(texts[-1])
            out = {n: batch.column(n) for n in columns} | {"text": texts}
            return out | ({"n_chars": sizes} if "n_chars" in columns else {})

        return step

    return map_batches(docs, ", ".join(f"`{n}` {kinds[n]}" for n in columns), make)
