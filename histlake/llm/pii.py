"""Personal data: fixed base patterns, and further spans by weak supervision.

The base patterns (email, ip, card, phone) always hold. Further candidates, looser
shapes of the same kinds, secrets and bank account numbers (iban), are judged by labelers that vote for, against, or
abstain: shape (regular expression and checksum), gazetteer (known cue words, endings
and prefixes) and context (what stands before and after). How often each combination of
votes occurs is counted over all documents; expectation-maximisation finds per kind how
reliable each labeler is, without any labelled data. A logistic classifier over votes
and the candidate's form is then fitted to those posteriors and decides.

Votes and forms have few values, so the table of counts, which is all that reaches the
driver, has a fixed largest size whatever the input (`MAX_FORMS`).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import map_slices, texts, work_table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "iban")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never starts inside a run of digits; saying so keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Candidates beyond the base patterns.
# An address in words starts at its first part: not after another "dot", so that a long
# row of parts is read once. Parts are of any number and length.
DOT_WORD = r"(?: ?[\[({] ?(?:dot|DOT) ?[\])}] ?| dot | DOT )"
LOOSE_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+@-])(?<! dot )(?<! DOT )(?<!dot[\])}])(?<!DOT[\])}])(?<!dot[\])}] )(?<!DOT[\])}] )"
    rf"(?:[A-Za-z0-9._%+-]++{DOT_WORD})*+[A-Za-z0-9._%+-]{{2,}}+"
    r"(?: ?[\[({] ?(?:at|AT) ?[\])}] ?| at | AT |＠)"
    rf"[A-Za-z0-9-]{{2,}}+(?:(?:\.|{DOT_WORD})[A-Za-z0-9-]{{2,}}+)+(?![A-Za-z0-9@])"
)
LOOSE_NUMBER = re.compile(r"(?<![0-9A-Za-z.+])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?(?:[\x20./-]?[0-9]{2,4}){2,5}(?![0-9A-Za-z]|[.][0-9])")
SECRET = re.compile(r"(?<![A-Za-z0-9_/+=-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{20,}+(?![A-Za-z0-9_/+-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")

# Gazetteers.
CUES = {
    "email": frozenset("mail email e-mail contact write correo courriel kontakt".split()),
    "phone": frozenset("tel phone telephone call mobile cell fax whatsapp telefon teléfono téléphone handy anruf".split()),
    "card": frozenset("card visa mastercard amex credit debit iban account karte tarjeta carte konto".split()),
    "ip": frozenset("ip host server address from".split()),
    "iban": frozenset("iban bic account bank konto kontonummer cuenta compte conto rekening".split()),
    "secret": frozenset("token secret key apikey api_key password passwd pwd bearer auth credential".split()),
}
ENDINGS = frozenset("com org net edu gov info io de fr es eu uk us".split())
AGAINST = frozenset("version v no nr page pages chapter isbn issn doi figure table section year vol ver art".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "22", "23", "24", "25", "26", "27")

# Country codes of the single euro payments area.
IBAN_COUNTRIES = frozenset("AD AT BE BG CH CY CZ DE DK EE ES FI FR GB GI GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM VA".split())

VOTES = (-1, 0, 1)
LABELERS = 3
LENGTHS = (8, 12, 16, 24, 32, 40)  # bounds of the length classes of the form
MAX_FORMS = len(KINDS) * len(VOTES) ** LABELERS * (len(LENGTHS) + 1) * 2


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def iban_holds(text: str) -> bool:
    """ISO 13616: the first four characters moved to the end, letters as 10 to 35, leave 1 modulo 97."""
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL, found from each @ on: leftmost, not overlapping.

    A match needs an @ with local part before it. The first match at or after a place
    starts where the run of local characters before the first fitting @ starts.
    """
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := EMAIL.match(text, start)):
            yield m.span()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base matches by kind, then start; those that fail their check are dropped."""
    out = [("email", *s) for s in emails(text)]
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text) if text.count(".") >= 3 else ():
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:] or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, int, int]:
    """Votes of the labelers: shape, gazetteer, context."""
    found = text[start:end]
    before = text[max(0, start - 40) : start]
    words = re.findall(r"[^\W_][\w-]*", before.lower())[-3:]
    digits = re.sub(r"[^0-9]", "", found)
    shape = place = 0
    if kind == "email":
        shape = 1 if EMAIL.fullmatch(found) else 0 if re.search(r"[\[({]|＠", found) else -1
        place = 1 if found.rsplit(".", 1)[-1].rsplit(" ", 1)[-1].lower() in ENDINGS else -1
    elif kind == "ip":
        shape = 1
    elif kind == "card":
        shape = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        place = 1 if digits.startswith(CARD_PREFIXES) else 0
    elif kind == "iban":
        shape = 1  # others are no candidates
        place = 1 if found[:2] in IBAN_COUNTRIES else -1
    elif kind == "phone":
        shape = 1 if found[0] == "+" or re.fullmatch(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", found) else -1 if len(set(digits)) < 3 else 0
    else:
        classes = sum(bool(re.search(c, found)) for c in (r"[a-z]", r"[A-Z]", r"[0-9]"))
        shape = 1 if re.fullmatch(r"[0-9a-f]{32,}|[0-9A-F]{32,}", found) or classes == 3 else -1
    if any(w in CUES[kind] for w in words):
        place = 1
    context = 0
    if re.search(r"[=:]\s*[\"'(<]?$", before):
        context = 1
    elif words and words[-1] in AGAINST or re.match(r"\s?(?:%|€|\$|£|km|kg|cm|mm)", text[end : end + 3]) or re.search(r"[€$£#]\s?$", before):
        context = -1
    return shape, place, context


def form(kind: str, text: str) -> tuple[int, int]:
    """Length class, and whether the candidate has separators."""
    return sum(len(text) >= n for n in LENGTHS), int(bool(re.search(r"[ ().\[\]/-]", text)))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple]:
    """(kind, start, end, added, shape, gazetteer, context, length, separated).

    Base spans take part in the estimation with `added` false. Others don't overlap
    base spans or each other.
    """
    out = [(k, s, e, False, *votes(k, text, s, e), *form(k, text[s:e])) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    furthest = list(accumulate((e for _, e in taken), max))  # end of the base spans up to each
    finds, done = [], 0
    if " at " in text or " AT " in text or "＠" in text or re.search(r"[\[({] ?(?:at|AT)", text):
        finds += [("email", *m.span()) for m in LOOSE_EMAIL.finditer(text)]
    if DIGIT.search(text):
        finds += [("iban", *m.span()) for m in IBAN.finditer(text) if iban_holds(m[0])]
        finds += [("secret", *m.span()) for m in SECRET.finditer(text) if not m[0].isdigit()]
        for m in LOOSE_NUMBER.finditer(text):
            n = sum(c.isdigit() for c in m[0])
            if 7 <= n <= 12:
                finds.append(("phone", *m.span()))
            elif 13 <= n <= 19 and luhn("".join(filter(str.isdigit, m[0]))):  # else it can't be one
                finds.append(("card", *m.span()))
    for kind, s, e in sorted(finds, key=lambda x: (x[1], -x[2])):
        before = bisect_left(taken, (e,))  # base spans that start before the end
        if s >= done and (not before or furthest[before - 1] <= s):
            out.append((kind, s, e, True, *votes(kind, text, s, e), *form(kind, text[s:e])))
            done = e
    return out


SPANS = "array<struct<kind:string,start:int,stop:int,added:boolean,shape:int,place:int,context:int,length:int,separated:int>>"
SPAN_TYPE = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("added", pa.bool_())]
        + [(n, pa.int32()) for n in ("shape", "place", "context", "length", "separated")]
    )
)
NAMES = [f.name for f in SPAN_TYPE.value_type]


def find(df: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, spans) of every row: base spans and candidates with their votes."""

    def step():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [[dict(zip(NAMES, c)) for c in candidates(t, base_spans(t))] for t in texts(batch.column(2))]
            return pa.record_batch([batch.column(0), batch.column(1), pa.array(found, SPAN_TYPE)], ["id", "text_hash", "spans"])

        return work

    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_slices(rows, step, f"id {kind}, text_hash long, spans {SPANS}")


PATTERNS = np.array(list(product(VOTES, repeat=LABELERS)))
MOST = 0.9  # largest prior: a kind seldom seen otherwise would pass whatever the votes say


def estimate(counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior of each of PATTERNS, seen `counts` times, by EM over two classes.

    Labelers are independent given the class. The start is the balance of votes, and
    pseudo-counts say that labelers are better than chance, which fixes which class is
    which and decides patterns never seen.
    """
    posterior = 1 / (1 + np.exp(-1.5 * PATTERNS.sum(axis=1)))
    for _ in range(rounds):
        prior = min(MOST, (counts @ posterior + 1) / (counts.sum() + 2))
        logs = np.log(prior / (1 - prior)) + np.zeros(len(PATTERNS))
        for labeler in range(LABELERS):
            said = PATTERNS[:, labeler] + 1
            good = np.bincount(said, counts * posterior, minlength=3) + (0.5, 1.0, 2.0)
            bad = np.bincount(said, counts * (1 - posterior), minlength=3) + (2.0, 1.0, 0.5)
            logs += np.log(good / good.sum() * bad.sum() / bad)[said]
        new = 1 / (1 + np.exp(-np.clip(logs, -30, 30)))
        if np.abs(new - posterior).max() < 1e-9:
            break
        posterior = new
    return posterior


def inputs(rows: list[tuple]) -> np.ndarray:
    """Classifier inputs: kind, votes by kind, length class and separators."""
    out = np.zeros((len(rows), 1 + len(KINDS) * (1 + 2 * LABELERS) + len(LENGTHS) + 2))
    for r, (kind, *said, length, separated) in zip(out, rows):
        k = KINDS.index(kind)
        r[0] = r[1 + k] = 1
        for n, vote in enumerate(said):
            if vote:
                r[1 + len(KINDS) + 2 * (k * LABELERS + n) + (vote > 0)] = 1
        r[-2 - len(LENGTHS) + length - 1] = length > 0
        r[-1] = separated
    return out


def classifier(x: np.ndarray, weights: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic regression on soft targets (Newton steps, ridge penalty)."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weights * (p - target)) + 0.1 * w
        hess = (x.T * (weights * p * (1 - p))) @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def learn(found: DataFrame) -> list[tuple]:
    """Forms of candidates (kind, votes, length class, separators) judged to be personal data."""
    keys = ["kind", "shape", "place", "context", "length", "separated"]
    rows = found.select(F.explode("spans").alias("s")).groupBy(*(f"s.{k}" for k in keys)).count().limit(MAX_FORMS + 1).collect()
    seen = {tuple(r[k] for k in keys): r["count"] for r in rows}
    every = [(k, *v, n, s) for k in KINDS for v in PATTERNS.tolist() for n in range(len(LENGTHS) + 1) for s in (0, 1)]
    counts = np.array([seen.get(f, 0) for f in every], float)
    by_pattern = counts.reshape(len(KINDS), len(PATTERNS), -1)
    posterior = np.array([estimate(c.sum(axis=1)) for c in by_pattern])
    target = np.repeat(posterior.ravel(), by_pattern.shape[2])
    x = inputs(every)
    score = x @ classifier(x, 0.1 + np.log1p(counts), target)
    return [f for f, s in zip(every, score) if s >= 0]


def detect(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, spans) of every row: array of (kind, start, stop, added), by kind and start.

    Offsets are code points, the end is exclusive. Null texts have no spans; repeated
    rows each have theirs.
    """
    found = work_table(find(df, id_col=id_col, text_col=text_col))
    good = frozenset(learn(found))

    def step():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [chosen([tuple(s[k] for k in NAMES) for s in spans or ()], good) for spans in batch.column(2).to_pylist()]
            rows = [[dict(zip(NAMES, s[:4])) for s in spans] for spans in out]
            kind = pa.list_(pa.struct([SPAN_TYPE.value_type[k] for k in range(4)]))
            return pa.record_batch([batch.column(0), batch.column(1), pa.array(rows, kind)], ["id", "text_hash", "spans"])

        return work

    kind = found.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text_hash long, spans array<struct<kind:string,start:int,stop:int,added:boolean>>"
    return map_slices(found, step, schema).withColumnRenamed("id", id_col)


def chosen(spans: list[tuple], good: frozenset) -> list[tuple]:
    """Base spans and accepted candidates, by kind and start."""
    kept = [s for s in spans if not s[3] or (s[0], *s[4:]) in good]
    return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1]))


def digests(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text."""
    found = detect(df, id_col=id_col, text_col=text_col)

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")

    base = F.filter("spans", lambda s: ~s.added)
    return found.select(
        id_col,
        *(F.expr(f"cast(size(filter(spans, s -> not s.added and s.kind = '{k}')) as long)").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def mask(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df`, each span in the text replaced by its kind in angle brackets.

    Of overlapping spans the one that starts first (then the longer) names the kind and
    all are covered. Other columns, their order and null texts stay. Texts are read a
    second time instead of being joined with their spans, so no text is shuffled.
    """
    good = frozenset(learn(work_table(find(df, id_col=id_col, text_col=text_col))))
    place = df.columns.index(text_col)

    def step():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [t and masked(t, chosen(candidates(t, base_spans(t)), good)) for t in batch.column(place).to_pylist()]
            return batch.set_column(place, text_col, pa.array(out, pa.string()))

        return work

    return map_slices(df, step, df.schema)


def masked(text: str, spans: list[tuple]) -> str:
    out, at = [], 0
    for kind, start, stop, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, stop)
    return "".join([*out, text[at:]])
