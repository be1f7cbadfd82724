"""Personal data by weak supervision.

Strict patterns give the base spans, which always stay.  Looser patterns give further candidates, and for
every candidate (base spans too) five labelers vote for (+1), against (-1) or abstain (0):

* pattern: the strict pattern and its check hold, or the check fails;
* gazetteer: top-level domains, calling codes, issuer digits, key names, country codes;
* context before: a cue word of the kind among the words before;
* context around: a sign that it is something else, such as a unit, a version or a decimal part;
* shape: grouping and length that are usual for the kind, or unusual.

Expectation-maximisation over the counts of vote patterns, for each kind, estimates how often every labeler
is right and with that the probability of each pattern.  A logistic span classifier is trained on these
probabilities with votes, kind, length and neighbouring characters as features, and decides on the candidates.

Votes and features take few values, so their combinations (at most PATTERNS) are counted over all documents in
one aggregate, and only that table reaches the driver.  Texts are read once; what follows works on spans.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, slices, utf8

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret")
LABELERS = ("pattern", "gazetteer", "before", "around", "shape")
# Length classes and classes of the characters beside a span.
LENGTHS, BESIDE = 8, 5
PATTERNS = len(KINDS) * 3 ** len(LABELERS) * LENGTHS * BESIDE * BESIDE
CUTOFF = 0.5

# The base patterns; e-mail addresses are read from their "@" outwards and dotted numbers part by part, which
# finds the same spans in time proportional to the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Looser candidates.
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]+ ?[\[(]at[\])] ?[A-Za-z0-9-]+(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]+)+", re.I)
_LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{2,5}\)|0[0-9]{1,4})[ ./-]{1,2}[0-9](?:[ ./-]?[0-9]){4,10}(?![0-9])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+=-]*[0-9])[A-Za-z0-9_/+-]{20,}={0,2}(?![A-Za-z0-9_/+-])")

# Short gazetteers and cue words.
TOP_DOMAINS = frozenset("com org net edu gov int info biz io co eu de fr es it uk us ch at be nl pt br mx ar ca au jp cn in ru pl se no dk fi ie".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "61", "62", "81", "82", "86", "91")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38")
IBAN_COUNTRIES = frozenset("AT BE CH CZ DE DK ES FI FR GB GR HU IE IT LU NL NO PL PT SE".split())
CUES = {
    "email": frozenset("mail email e-mail contact contacto correo courriel kontakt write schreiben an to from".split()),
    "ip": frozenset("ip host server address adresse dirección addr client login from gateway".split()),
    "card": frozenset("card visa mastercard amex credit karte kreditkarte tarjeta carte number nummer número numéro".split()),
    "phone": frozenset("tel telephone phone call fax mobile cell telefon handy anrufen teléfono llamar móvil téléphone portable appelez".split()),
    "iban": frozenset("iban account konto cuenta compte bank".split()),
    "secret": frozenset("token key apikey api_key api-key secret password passwort passwd pwd bearer auth access_key contraseña clave".split()),
}
AGAINST = frozenset("version v page pages seite página isbn issn art no nr § id ref figure fig table chapter kapitel".split())
UNITS = frozenset("% € $ £ ° km kg cm mm eur usd gb mb hz".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield start, end, True
        at = text.find("@", max(at + 1, end))


def ips(text: str) -> Iterator[tuple[int, int, bool]]:
    """Groups of four from every chain of dotted numbers."""
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            group = parts[k : k + 4]
            size = sum(map(len, group)) + 3
            yield at, at + size, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in group)
            at += size + 1


def cards(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        yield m.start(), m.end(), 12 <= len(d) <= 19 and luhn(d)


def phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _PHONE.finditer(text):
        yield m.start(), m.end(), 9 <= len(_digits(m[0])) <= 15


_STRICT = (emails, ips, cards, phones)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind number, end) of the strict matches, and of those that fail their check."""
    good, bad = [], []
    for kind, find in enumerate(_STRICT):
        for s, e, ok in find(text):
            (good if ok else bad).append((s, kind, e))
    return sorted(good), bad


def _loose(text: str, failed: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out = []
    for s, kind, e in failed:
        n = len(_digits(text[s:e]))
        if (kind == 2 and 13 <= n <= 19) or (kind == 3 and 7 <= n <= 17) or (kind == 1 and e - s <= 19):
            out.append((s, kind, e))
    lower = text.lower() if "[" in text or "(" in text else ""
    if "(at)" in lower or "[at]" in lower:
        out += [(m.start(), 0, m.end()) for m in _SPELLED.finditer(text)]
    out += [(m.start(), 3, m.end()) for m in _LOCAL_PHONE.finditer(text)]
    out += [(m.start(), 4, m.end()) for m in _IBAN.finditer(text)]
    out += [(m.start(), 5, m.end()) for m in _SECRET.finditer(text)]
    return out


def _words_before(text: str, start: int) -> list[str]:
    return [w.strip(".,:;()[]\"'=<>").lower() for w in text[max(0, start - 48) : start].replace(":", " ").replace("=", " ").split()[-3:]]


def _iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def votes(text: str, start: int, kind: int, end: int, strict: bool) -> tuple[int, ...]:
    """What each labeler says of a candidate."""
    span, name = text[start:end], KINDS[kind]
    digits = _digits(span)
    before = _words_before(text, start)
    pattern = 1 if strict else -1 if kind in (1, 2, 3) else 0
    gazetteer = shape = 0
    if name == "email":
        gazetteer = 1 if span.rsplit(".", 1)[-1].strip("]) ").lower() in TOP_DOMAINS else -1
        shape = 1 if 6 <= len(span) <= 64 and ".." not in span else -1
    elif name == "ip":
        parts = span.split(".")
        gazetteer = -1 if parts[0] in ("0", "127") or span.startswith(("255.", "224.")) else 0
        shape = -1 if all(len(p) == 1 for p in parts) or any(len(p) > 1 and p[0] == "0" for p in parts) else 1
    elif name == "card":
        gazetteer = 1 if digits.startswith(ISSUERS) else 0
        groups = re.split(r"[ -]", span)
        shape = 1 if len(digits) in (15, 16) and (len(groups) == 1 or [len(g) for g in groups] in ([4, 4, 4, 4], [4, 6, 5])) else -1
    elif name == "phone":
        gazetteer = (1 if digits.startswith(CALLING_CODES) else -1) if span[0] == "+" else 0
        shape = 1 if 8 <= len(digits) <= 13 and re.search(r"[ ().-]", span) else -1
    elif name == "iban":
        gazetteer = 1 if span[:2] in IBAN_COUNTRIES else -1
        pattern = 1 if _iban_ok(span) else -1
        shape = 1 if 15 <= len(span.replace(" ", "")) <= 34 else -1
    else:
        quoted = start > 0 and text[start - 1] in "\"'"
        gazetteer = 1 if span.startswith(("sk-", "pk_", "ghp_", "AKIA", "eyJ")) else 0
        spread = len(set(span))
        shape = 1 if spread >= 10 and 0.15 <= len(digits) / len(span) <= 0.9 else -1
        pattern = 1 if quoted or text[max(0, start - 3) : start].rstrip().endswith(("=", ":")) else 0
    cue = 1 if any(w in CUES[name] for w in before) else 0
    after = text[end : end + 12].split()
    around = 0
    if (before and before[-1] in AGAINST) or (after and (after[0].lower() in UNITS or after[0][0] in "%€$£°")):
        around = -1
    elif text[end : end + 1] in (",", ".") and text[end + 1 : end + 2].isdigit():
        around = -1
    elif start and text[start - 1] in "$€£#" or (start > 1 and text[start - 1] in ",." and text[start - 2].isdigit()):
        around = -1
    return pattern, gazetteer, cue, around, shape


def _beside(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def code(kind: int, vote: tuple[int, ...], length: int, left: str, right: str) -> int:
    """A candidate's kind, votes and features as one number below PATTERNS."""
    out = kind
    for v in vote:
        out = out * 3 + v + 1
    out = out * LENGTHS + min(LENGTHS - 1, (length - 1) // 6)
    return (out * BESIDE + _beside(left)) * BESIDE + _beside(right)


def decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, votes, [length, left, right]) of codes."""
    rest, right = np.divmod(codes, BESIDE)
    rest, left = np.divmod(rest, BESIDE)
    rest, length = np.divmod(rest, LENGTHS)
    vote = []
    for _ in LABELERS:
        rest, v = np.divmod(rest, 3)
        vote.append(v - 1)
    return rest, np.stack(vote[::-1], 1), np.stack([length, left, right], 1)


FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, starts array<int>, kinds array<int>, "
    "ends array<int>, codes array<int>, strict array<boolean>"
)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and further candidates of every text, with their codes."""
    nothing = hashlib.sha256(b"").hexdigest()
    sign = np.zeros(256, bool)
    sign[[*range(ord("0"), ord("9") + 1), ord("@"), ord("["), ord("(")]] = True
    for piece in slices(batches):
        raw, offsets = utf8(piece.column("text"))
        # Every span holds a digit, an "@" or a bracket; texts without any are done.
        some = np.diff(np.concatenate(([0], np.cumsum(sign[raw])))[offsets]) > 0
        rows = []
        for doc, text, look in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), some.tolist()):
            if not look:
                rows.append((doc, 0, 0, 0, 0, nothing, [], [], [], [], []))
                continue
            good, failed = base_spans(text)
            more = []
            # A candidate is no news where a base span lies.
            edge = sorted((s, e) for s, _, e in good)
            for s, k, e in sorted(_loose(text, failed), key=lambda x: (x[0], -x[2], x[1])):
                if not any(a < e and s < b for a, b in edge) and (not more or s >= more[-1][2]):
                    more.append((s, k, e))
            spans = [(*x, True) for x in good] + [(*x, False) for x in more]
            codes = [code(k, votes(text, s, k, e, ok), e - s, text[s - 1 : s] if s else "", text[e : e + 1]) for s, k, e, ok in spans]
            n = [sum(k == j for _, k, _ in good) for j in range(4)]
            rows.append((
                doc, *n, hashlib.sha256(written(good).encode()).hexdigest(),
                [x[0] for x in spans], [x[1] for x in spans], [x[2] for x in spans], codes, [x[3] for x in spans],
            ))
        ints = pa.list_(pa.int32())
        kinds = (pa.int64(), *[pa.int64()] * 4, pa.string(), ints, ints, ints, ints, pa.list_(pa.bool_()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[c.split()[0] for c in FOUND.split(", ")])


def reliabilities(vote: np.ndarray, count: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for one kind: the probability of each vote pattern, and for each labeler the
    chance of every vote (against, abstain, for) if the candidate is none (row 0) and if it is one (row 1).

    It starts from the majority; a pseudo-vote on the right side keeps every chance above zero and says that
    labelers are right more often than not.
    """
    p = 1 / (1 + np.exp(-1.5 * vote.sum(1)))
    table = np.zeros((vote.shape[1], 2, 3))
    for _ in range(rounds):
        prior = (count @ p + 1) / (count.sum() + 2)
        logit = np.full(len(p), np.log(prior / (1 - prior)))
        for j in range(vote.shape[1]):
            for y, w in ((0, count * (1 - p)), (1, count * p)):
                n = np.bincount(vote[:, j] + 1, weights=w, minlength=3) + np.array([[2.0, 1.0, 0.5], [0.5, 1.0, 2.0]][y])
                table[j, y] = n / n.sum()
            logit += np.log(table[j, 1, vote[:, j] + 1] / table[j, 0, vote[:, j] + 1])
        new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p, table


def _features(kind: np.ndarray, vote: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """One-hot features: kind, votes within the kind, length and neighbours."""
    one = [np.eye(len(KINDS))[kind]]
    for j in range(vote.shape[1]):
        one.append(np.eye(3 * len(KINDS))[kind * 3 + vote[:, j] + 1])
    for j, n in enumerate((LENGTHS, BESIDE, BESIDE)):
        one.append(np.eye(n * len(KINDS))[kind * n + shape[:, j]])
    return np.concatenate(one, 1)


def span_classifier(x: np.ndarray, target: np.ndarray, count: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic model for probabilities ``target`` of patterns that occur ``count`` times."""
    w = np.zeros(x.shape[1])
    weight = np.minimum(count, 1e6).astype(float)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (target - p)) - ridge * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        step *= min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(codes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, dict[str, dict[str, list[float]]]]:
    """The classifier's probability of every pattern, and the reliabilities of the labelers by kind."""
    kind, vote, shape = decode(codes)
    target, report = np.zeros(len(codes)), {}
    for k in range(len(KINDS)):
        own = np.flatnonzero(kind == k)
        if len(own):
            rows, at = np.unique(vote[own], axis=0, return_inverse=True)
            at = at.ravel()
            p, table = reliabilities(rows, np.bincount(at, weights=count[own]))
            target[own] = p[at]
            report[KINDS[k]] = {name: [float(table[j, 0, 0]), float(table[j, 1, 2])] for j, name in enumerate(LABELERS)}
    if not len(codes):
        return target, report
    x = _features(kind, vote, shape)
    x = x[:, x.any(0)]
    w = span_classifier(x, target, count)
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), report


def find(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, starts, kinds, ends) of every document.

    The counts and ``base_sha256`` are of the base spans; the arrays hold all spans, sorted.  A null or empty
    text has none; rows that repeat are treated alike; extra columns are ignored.
    """
    found = materialize(docs.select("doc_id", "text").mapInArrow(_finder, FOUND), "spans")
    counted = found.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).toPandas()
    codes = counted["code"].to_numpy(np.int64)
    p, _ = learn(codes, counted["n"].to_numpy(float))
    accepted = frozenset(codes[p >= cutoff].tolist())

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            starts, kinds, ends = [], [], []
            for s, k, e, c, ok in zip(*(b.column(x).to_pylist() for x in ("starts", "kinds", "ends", "codes", "strict"))):
                spans = sorted(x[:3] for x in zip(s, k, e, c, ok) if x[4] or x[3] in accepted)
                starts.append([x[0] for x in spans])
                kinds.append([x[1] for x in spans])
                ends.append([x[2] for x in spans])
            ints = pa.list_(pa.int32())
            first = [b.column(k) for k in range(6)]
            yield pa.RecordBatch.from_arrays([*first, *(pa.array(x, ints) for x in (starts, kinds, ends))], names=[*b.schema.names[:9]])

    return found.mapInArrow(keep, FOUND.split(", codes")[0])


def report(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The result of ``find`` with all spans written as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(
        F.arrays_zip("kinds", "starts", "ends"),
        lambda x: F.concat_ws(":", F.element_at(names, x["kinds"] + 1), x["starts"].cast("string"), x["ends"].cast("string")),
    )
    return find(docs, cutoff).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", F.concat_ws(",", spans).alias("spans"))


def redact(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, and ``n_chars``, if there, renewed.

    Texts are changed where their spans are found, row by row, so repeated rows and null ids need no key.
    Spans that overlap become one replacement, named by the first.  A null text stays null.
    """
    found = docs.select("text").mapInArrow(_codes_only, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    codes = found["code"].to_numpy(np.int64)
    p, _ = learn(codes, found["n"].to_numpy(float))
    accepted = frozenset(codes[p >= cutoff].tolist())
    schema = docs.schema

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            texts = piece.column("text").to_pylist()
            for found in _finder([pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()), piece.column("text")], names=["doc_id", "text"])]):
                cols = [found.column(x).to_pylist() for x in ("starts", "kinds", "ends", "codes", "strict")]
                out = []
                for text, s, k, e, c, ok in zip(texts, *cols):
                    spans = sorted(x[:3] for x in zip(s, k, e, c, ok) if x[4] or x[3] in accepted)
                    out.append(_replaced(text, spans) if spans else text)
            arrays = list(piece.columns)
            arrays[piece.schema.get_field_index("text")] = pa.array(out, piece.schema.field("text").type)
            yield pa.RecordBatch.from_arrays(arrays, schema=piece.schema)

    out = docs.mapInArrow(change, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for s, k, e in spans:
        if s < at:  # overlaps the one before: that one grows
            at = max(at, e)
            continue
        out += [text[at:s], f"<{KINDS[k]}>"]
        at = e
    return "".join(out) + text[at:]


def _codes_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for piece in slices(batches):
        for found in _finder([pa.RecordBatch.from_arrays([pa.nulls(len(piece), pa.int64()), piece.column("text")], names=["doc_id", "text"])]):
            codes = found.column("codes").flatten().to_numpy()
            total = np.bincount(codes, minlength=PATTERNS)[:PATTERNS] + (total if len(total) else 0)
    some = np.flatnonzero(total)
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))], names=["code", "n"])
