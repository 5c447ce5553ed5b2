"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

Base spans come from four patterns (email, ip, card, phone), matched in linear time. The field
adds spans that the patterns can't: numbers without a plus sign, IPv6 addresses and the like.
It is trained on a small labelled table, EXAMPLES (frames with values from a seeded generator) or
any other rows of the same form, and labels words O, B-kind or I-kind. On lines of frames that it
hasn't seen (HELD_OUT_FRAMES, other values) tests hold it to a precision and a recall of 0.95. A word without digit and @ is O by definition, so a text falls
apart at such words into short runs that are decoded independently and exactly: by Viterbi
over numpy batches of runs of similar length. Spans of the field that touch a base span are
left out; base spans always stay. Words of personal names or streets are beyond it.

Offsets are code points, ends exclusive. Ids are integers (others are cast to long); a text of any length
is scanned whole by one task; other columns are not looked at. Null and empty texts have no spans; equal rows are
scanned each on its own; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """By kind as listed, then by start; leftmost and not overlapping within a kind."""
    found: list[Span] = []
    done = 0  # neither a local part nor what follows reaches behind this
    at = text.find("@")
    while at >= 0:
        before = text[done:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        done = at + 1
        if local and (m := _DOMAIN.match(text, at + 1)):
            found.append(("email", at - local, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


# The labelled table: a frame and values of the kinds that stand in it; {kind:span} marks what a reader would mark.
# P phone, I ip, C card, E email; the others are numbers that are none: N order or part, D date, T time, V version, Q amount, R range, K long id, X hash, M mac address.
FRAMES = (
    "call {P} now", "tel {P} or fax {P}", "phone: {P}", "ring {P} tomorrow", "mobile {P} only", "dial {P} for help", "my cell is {P}", "you can reach me at {P}.", "telephone {P} in the office", "or {P} after six", "fax {P}",
    "host {I} answered", "address {I} seen", "ping {I}, then wait", "peer {I} there", "from {I} to {I}", "the server listens on {I}", "logged in from {I}",
    "card {C} was charged", "paid with {C} on monday", "visa {C} expired", "number {C} declined", "they charged {C} again", "card no. {C}",
    "write to {E} for details", "mail {E} or call {P} today", "contact {E}, please", "users {E} {E} joined",
    "order {N} shipped", "invoice {N} is due", "ref {N}", "part {N} is out of stock", "order number {N}", "sku {N} {N}", "serial no. {N}", "case {N} is open", "batch {N}",
    "on {D} at {T}", "logged {D} {T}", "at {D} {T} and {D} {T}", "since {D}", "between {D} and {D}", "born {D}, died {D}", "at {T} and {T}", "due {D}", "version {V} came out on {D}", "section {V} of chapter {Q}", "see item {Q} and item {Q}", "release {V} and {V}", "released under {V} terms",
    "about {Q} people and {Q} percent", "price {Q} or {Q}", "a ratio of {R} or {R}", "pages {R} and {R}", "the years {R} passed", "scores {Q} {Q} {Q} {Q} {Q} {Q}", "in {Q} there were {Q} of them",
    "id {K} in the log", "ids {K} {K} differ", "sums {K} and {K}", "{K} rows", 'token = "{X}" is set', "commit {X} fixed it", "key {X} here", "mac {M} on port {Q}", "isbn 978-3-16-14{Q} is a book", "follow @someone and @other{Q}", "room {Q} in building {Q}b",
)
HELD_OUT_FRAMES = (
    "please call me back on {P} before lunch", "her phone number is {P}.", "office telephone: {P}", "the hotline, tel. {P}, is free", "mobile: {P}; fax: {P}", "just dial {P}",
    "the router at address {I} rebooted", "host {I} is unreachable", "packets from {I} were lost", "it answered a ping from {I}.",
    "we billed your card {C} twice", "visa {C}, please", "his card number is {C}", "charged {C} by mistake",
    "send it to {E}, not to {E}", "my mail is {E}.",
    "your order {N} has left us", "the invoice {N} was paid on {D}", "part {N} fits part {N}", "quote order number {N}", "ref {N}, case {N}",
    "the meeting of {D} moved to {D}", "open {T} to {T}", "installed version {V} on {D}", "it grew by {Q} percent in {Q}", "chapters {R}", "section {V}", "rows {K} {K}", "the id {K} is taken", 'the key "{X}" leaked', "price {Q}", "room {Q}",
)
_MARKED = {"P": "phone", "I": "ip", "C": "card", "E": "email"}


def _value(slot: str, r: random.Random) -> str:
    """A value of a slot, in one of its forms."""
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    some = lambda *forms: r.choice(forms)()
    hexes = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    area = str(r.randint(2, 9)) + d(2)
    date = r.randint(1950, 2030), r.randint(1, 12), r.randint(1, 28)
    if slot == "P":
        return some(
            lambda: f"({area}) 555-01{d(2)}", lambda: f"{area}-555-01{d(2)}", lambda: f"{area}.555.01{d(2)}", lambda: f"1-{area}-555-01{d(2)}", lambda: f"0{d(3)} {d(7)}", lambda: f"0{d(2)} 7946 0{d(3)}",
            lambda: f"0{d(4)} {d(6)}", lambda: f"+{r.randint(20, 99)} {d(2)} {d(3)} {d(4)}", lambda: f"+1 ({area}) 555-01{d(2)}", lambda: f"{area} 555 01{d(2)}",
        )
    if slot == "I":
        return some(lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)), lambda: ":".join(hexes(4) for _ in range(8)), lambda: f"2001:db8::{hexes(4)}:{hexes(3)}", lambda: f"fe80::{hexes(4)}:{hexes(4)}:{hexes(4)}:{hexes(4)}", lambda: f"2001:db8:{hexes(2)}::{hexes(1)}")
    if slot == "C":
        body = r.choice("456") + d(14)
        body += next(c for c in "0123456789" if luhn(body + c))
        parts = [body[k : k + 4] for k in range(0, 16, 4)]
        return r.choice((body, " ".join(parts), "-".join(parts), ".".join(parts)))
    if slot == "E":
        return some(lambda: f"{r.choice('abcxyz')}.{hexes(4)}@example.org", lambda: f"user{d(2)}@mail{d(1)}.example.com", lambda: f"{hexes(3)}_y%z@sub.example.co.uk")
    if slot == "N":
        return some(lambda: d(9), lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"{d(2)}-{d(5)}", lambda: f"A{d(4)}-{d(3)}", lambda: f"{d(4)}/{d(2)}", lambda: f"{d(3)}.{d(3)}.{d(4)}")
    if slot == "D":
        return r.choice(("{0:04d}-{1:02d}-{2:02d}", "{2:02d}/{1:02d}/{0:04d}", "{2}.{1}.{0}", "{1}/{2}/{0}", "{0:04d}{1:02d}{2:02d}")).format(*date)
    if slot == "T":
        return f"{r.randint(0, 23)}:{r.randint(10, 59)}"
    if slot == "V":
        return r.choice((f"{d(1)}.{d(1)}", f"{d(1)}.{d(2)}.{d(1)}", f"v{d(1)}.{d(1)}.{d(2)}", f"{d(2)}.{d(1)}"))
    if slot == "Q":
        return r.choice((d(1), d(2), d(3), d(4), f"{d(1)},{d(3)}", f"{d(2)}.{d(1)}", f"0.{d(3)}", f"{d(3)}.00"))
    if slot == "R":
        return r.choice((f"{d(2)}-{d(2)}", f"{d(3)}-{d(3)}", f"{d(2)}:{d(1)}", "1990 1991 1992 1993", f"{d(4)}-{d(4)}"))
    if slot == "K":
        while luhn(k := r.choice("123456789") + d(15)):
            pass
        return k
    return hexes(r.choice((7, 32, 40))) if slot == "X" else ":".join(hexes(2) for _ in range(6))


def labelled_table(frames: Sequence[str] = FRAMES, times: int = 4, seed: int = 1) -> tuple[str, ...]:
    """Lines of the labelled table: each frame so many times, with other values."""
    r = random.Random(seed)
    fill = lambda m: f"{{{_MARKED[m[1]]}:{_value(m[1], r)}}}" if m[1] in _MARKED else _value(m[1], r)
    return tuple(re.sub(r"\{([A-Z])\}", fill, f) for f in frames for _ in range(times))


EXAMPLES = labelled_table()
_CUES = {w: kind for kind, ws in {"phone": "phone tel telephone call fax mobile ring dial cell reach", "net": "ip host server address ping peer from", "card": "card visa charged paid billed", "mail": "mail email", "number": "number no is on at to", "item": "version section id ids order isbn token key invoice ref part sku serial case batch release rows item"}.items() for w in ws.split()}
_MARK = re.compile(r"\{(\w+):((?:[^{}])*)\}")


def busy(word: str) -> bool:
    """Words that the field may label; all others are O."""
    return any(c == "@" or "0" <= c <= "9" for c in word)


def shape(word: str) -> str:
    return "".join("9" if "0" <= c <= "9" else "x" if c.islower() else "X" if c.isupper() else c for c in word)


def features(words: list[str], cues: tuple[str, str]) -> list[list[str]]:
    """Features of each word of a run; cues are the two words before it."""
    out, whole = [], "".join(c for w in words for c in w if "0" <= c <= "9")
    known = [next((kind for c in cues[::-1] if (kind := _CUES.get(c.lower().strip(".,;:()"))) and kind != "number"), "-"), _CUES.get(cues[1].lower().strip(".,;:()"), "-")]
    for k, w in enumerate(words):
        s = shape(w)
        short = re.sub(r"(.)\1+", r"\1", s)
        digits = sum(c == "9" for c in s)
        sep = {"email": "@", "dash": "-", "dot": ".", "colon": ":", "paren": "(", "plus": "+", "slash": "/", "equal": "=", "quote": '"'}
        f = ["bias", f"short={short if len(short) <= 24 else 'long'}", f"start={s[:3]}", f"digits={min(digits, 20)}", f"exact={core if len(core := s.strip('.,;:')) <= 24 else 'long'}", f"first={k == 0}"]
        f += [f"has={n}" for n, c in sep.items() if c in w]
        f += [f"dots={min(w.strip('.,;').count('.'), 4)}", f"colons={min(w.count(':'), 6)}", f"hex={bool(re.search('[a-fA-F]', w)) and digits > 0}", f"pure={digits == len(w.strip('.,;:'))}"]
        before, after = (shape(words[i].strip(".,;:")) if 0 <= i < len(words) else "-" for i in (k - 1, k + 1))
        f += [f"cue={known[0]}", f"cue={known[1]},{k == 0}", f"cue={known[0]},short={short if len(short) <= 24 else 'long'}", f"before={before if len(before) <= 9 else 'long'}", f"after={after if len(after) <= 9 else 'long'}"]
        f += [f"run={min(len(words), 6)}", f"card={13 <= len(whole) <= 19 and luhn(whole)}", f"own={13 <= digits <= 19 and luhn(''.join(c for c in w if '0' <= c <= '9'))}"]
        out.append(f)
    return out


def runs(words: list[tuple[int, str]]) -> list[tuple[int, int]]:
    """Maximal index ranges of busy words."""
    out, start = [], None
    for k, (_, w) in enumerate([*words, (0, "")]):
        if busy(w):
            start = k if start is None else start
        elif start is not None:
            out.append((start, k))
            start = None
    return out


def _allowed() -> np.ndarray:
    ok = np.zeros((len(LABELS), len(LABELS)))
    for i, a in enumerate(LABELS):
        for j, b in enumerate(LABELS):
            if b[0] == "I" and a[2:] != b[2:]:
                ok[i, j] = -1e9
    return ok


class Field:
    """Weights of a linear-chain conditional random field."""

    def __init__(self, names: dict[str, int], unary: np.ndarray, pair: np.ndarray):
        self.names, self.unary, self.pair = names, unary, pair

    def scores(self, run: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(run), len(LABELS)))
        for k, f in enumerate(run):
            out[k] = self.unary[[self.names[x] for x in f if x in self.names]].sum(axis=0)
        out[0, [label[0] == "I" for label in LABELS]] = -1e9
        return out

    def decode(self, scored: list[np.ndarray]) -> list[np.ndarray]:
        """Viterbi over batches of runs whose lengths lie between two powers of two."""
        out: list[np.ndarray] = [np.empty(0, int)] * len(scored)
        sizes = np.array([len(s) for s in scored], int)
        step = self.pair + _allowed()
        for bucket in np.unique(np.ceil(np.log2(np.maximum(sizes, 1)))):
            members = np.flatnonzero(np.ceil(np.log2(np.maximum(sizes, 1))) == bucket)
            for part in np.array_split(members, -(-len(members) * int(2**bucket) // 65536)):
                longest = sizes[part].max()
                table = np.zeros((len(part), longest, len(LABELS)))
                for k, m in enumerate(part):
                    table[k, : sizes[m]] = scored[m]
                best, back = table[:, 0], np.zeros((len(part), longest, len(LABELS)), np.int8)
                for t in range(1, longest):
                    paths = best[:, :, None] + step[None]
                    live = (sizes[part] > t)[:, None]
                    back[:, t] = np.where(live, paths.argmax(axis=1), np.arange(len(LABELS)))
                    best = np.where(live, paths.max(axis=1) + table[:, t], best)
                label = best.argmax(axis=1)
                path = np.zeros((len(part), longest), int)
                for t in range(longest - 1, -1, -1):
                    path[:, t] = label
                    label = back[np.arange(len(part)), t, label] if t else label
                for k, m in enumerate(part):
                    out[m] = path[k, : sizes[m]]
        return out


def labelled(line: str) -> tuple[str, list[Span]]:
    """A line of the labelled table as text and spans."""
    text, spans, last = "", [], 0
    for m in _MARK.finditer(line):
        text += line[last : m.start()]
        spans.append((m[1], len(text), len(text) + len(m[2])))
        text += m[2]
        last = m.end()
    return text + line[last:], spans


@functools.cache
def train(lines: tuple[str, ...] = EXAMPLES, rounds: int = 60, rate: float = 0.15, decay: float = 1e-3) -> Field:
    """Adam on the mean log-likelihood of all runs; the same rows give the same weights. The table is small, and the driver learns it once."""
    data, names = [], {}
    for line in lines:
        text, spans = labelled(line)
        words = [(m.start(), m[0]) for m in _WORD.finditer(text)]
        for i, j in runs(words):
            f = features([w for _, w in words[i:j]], tuple(words[n][1] if n >= 0 else "" for n in (i - 2, i - 1)))
            y = []
            for at, w in words[i:j]:
                own = next(((k, s) for k, s, e in spans if at < e and at + len(w) > s), None)
                y.append(LABELS.index(f"{'B' if own[1] >= at else 'I'}-{own[0]}") if own else 0)
            data.append(([[names.setdefault(x, len(names)) for x in fs] for fs in f], y))
    n = len(LABELS)
    weights = [np.zeros((len(names), n)), np.zeros((n, n))]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    fixed, start = _allowed(), np.array([-1e9 if label[0] == "I" else 0.0 for label in LABELS])
    log_sum = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
    for r in range(1, rounds + 1):
        grads = [-decay * w for w in weights]
        for f, y in data:
            u = np.array([weights[0][k].sum(axis=0) for k in f])
            u[0] += start
            step = weights[1] + fixed
            fwd, bwd = [u[0]], [np.zeros(n)]
            for t in range(1, len(y)):
                fwd.append(log_sum(fwd[-1][:, None] + step, 0) + u[t])
            for t in range(len(y) - 1, 0, -1):
                bwd.insert(0, log_sum(step + (u[t] + bwd[0])[None], 1))
            z = log_sum(fwd[-1], 0)
            for t, k in enumerate(f):
                p = np.exp(fwd[t] + bwd[t] - z)
                p[y[t]] -= 1
                grads[0][k] -= p / len(data)
                if t:
                    q = np.exp(fwd[t - 1][:, None] + step + (u[t] + bwd[t])[None] - z)
                    q[y[t - 1], y[t]] -= 1
                    grads[1] -= q / len(data)
        for w, g, (m, v) in zip(weights, grads, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w += rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.999**r)) + 1e-8)
    return Field(names, *weights)


def field_spans(texts: list[str], field: Field) -> list[list[Span]]:
    """Spans that the field finds in each text, trimmed of punctuation around them."""
    places, scored = [], []
    for n, text in enumerate(texts):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        marks = np.flatnonzero(((codes >= 48) & (codes <= 57)) | (codes == 64))
        words, k = [], 0
        while k < len(marks):  # words around the marks
            at = int(marks[k])
            start = _start(text, at)
            m = _WORD.match(text, start)
            words.append((start, m[0]))
            k = int(np.searchsorted(marks, m.end()))
        i = 0
        while i < len(words):
            j = i + 1
            while j < len(words) and not text[words[j - 1][0] + len(words[j - 1][1]) : words[j][0]].strip(" \t\n\v\f\r"):
                j += 1
            near = _before(text, words[i][0])
            far = _before(text, near[0])
            places.append((n, words[i:j]))
            scored.append(field.scores(features([w for _, w in words[i:j]], (far[1], near[1]))))
            i = j
    out: list[list[Span]] = [[] for _ in texts]
    for (n, words), labels in zip(places, field.decode(scored), strict=True):
        k = 0
        while k < len(words):
            name = LABELS[labels[k]]
            stop = k + 1
            if name != "O":
                while stop < len(words) and LABELS[labels[stop]] == f"I-{name[2:]}":
                    stop += 1
                lo, hi = words[k][0], words[stop - 1][0] + len(words[stop - 1][1])
                span = texts[n][lo:hi]
                lo += len(span) - len(span.lstrip(".,;:<>[]{}\"'!?"))
                hi -= len(span) - len(span.rstrip(".,;:<>[]{}\"'!?"))
                if lo < hi:
                    out[n].append((name[2:], lo, hi))
            k = stop
    return out


def _start(text: str, at: int) -> int:
    """Where the word around place at begins."""
    width = 64
    while True:
        lo = max(0, at - width)
        piece = text[lo:at]
        cut = max(piece.rfind(c) for c in " \t\n\v\f\r")
        if cut >= 0 or lo == 0:
            return lo + cut + 1
        width *= 8


def _before(text: str, at: int) -> tuple[int, str]:
    """The word that ends before place at: its start, and itself; (0, "") if there is none."""
    while at and text[at - 1] in " \t\n\v\f\r":
        at -= 1
    start = _start(text, at) if at else 0
    return start, text[start:at]


def shown(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1])))


def find_pii(docs: DataFrame, examples: Iterable[str] = EXAMPLES, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of docs; the counts are of base spans."""
    field = train(tuple(examples))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            texts = [t or "" for t in b["text"]]
            for k in range(0, len(texts), 256):
                part = texts[k : k + 256]
                for t, more in zip(part, field_spans(part, field), strict=True):
                    base = base_spans(t)
                    taken = sorted((a, e) for _, a, e in base)
                    added = [s for s in more if not any(a < s[2] and s[1] < e for a, e in taken)] if taken else more
                    counts = [sum(s[0] == kind for s in base) for kind in KINDS]
                    rows.append((*counts, hashlib.sha256(shown(base).encode()).hexdigest(), shown(base + added)))
            names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            out = pd.DataFrame(rows, columns=names)
            yield pd.DataFrame({"doc_id": b["doc_id"].reset_index(drop=True)} | {n: out[n].astype(object if n in names[4:] else "int64") for n in names})

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, schema)
