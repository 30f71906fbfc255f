"""Personal data: fixed patterns, and a linear-chain conditional random field for what they cannot see.

The patterns find plain e-mail addresses, IPv4 addresses, card numbers and
international phone numbers. The field labels words as other, e-mail or phone
and finds written-out addresses ("jane dot doe at example dot com") and national
phone numbers ("(415) 555-0134"). Its features are the shapes of a word and of
its neighbours: digits and letters, brackets, dashes, dots, and a few cue words.
It is trained here by gradient descent on the table ``EXAMPLES``, spread out by
filling in names and numbers.

Decoding is Viterbi in numpy over a batch of texts. A word that no stretch of
labelled words could run through without losing to "other" is "other" in every
best path (an upper bound on each stretch's gain shows it); the chain falls
apart there, and only the short runs between are decoded, all runs of a length
at once.

Defined results: NULL text is empty and has no spans; a span of the field that
overlaps one of the patterns is dropped; offsets are code points, the end
exclusive; NULL and repeated ids are ordinary rows; an empty table gives no
rows; other columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm.textvec import SPACE, hashes, row_sums, slices, words
from capstream.session import shared_root

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", "email", "phone")

# ---------------------------------------------------------------------------
# Patterns
# ---------------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from each @ so that long runs stay linear."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every pattern's matches, sorted."""
    found = [(a, 0, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for kind, pattern, low, high in ((2, CARD, 14, 19), (3, PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if low <= len(digits) <= high and (kind == 3 or luhn(digits)):
                found.append((m.start(), kind, m.end()))
    return sorted(found)


# ---------------------------------------------------------------------------
# Word shapes
# ---------------------------------------------------------------------------

#: Cue words; "" is any other word.
CUES = ["", "at", "dot", "punkt", "point", "punto", "arroba", "underscore", "dash", "com", "org", "net", "edu", "gov", "de", "fr", "es", "uk",
        "io", "example", "mail", "email", "e-mail", "phone", "tel", "telephone", "telefon", "mobile", "cell", "call", "fax", "contact", "reach",
        "write", "ring", "number", "ext", "page", "pages", "version", "isbn", "on", "in", "the", "a", "of", "and", "is", "was", "me", "us"]


def _set(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[[ord(c) for c in chars]] = True
    return t


DIGIT = _set("0123456789")
LETTER = _set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 0x80)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
OPEN, CLOSE = _set("\"'<[{"), _set(".,;:!?\"'>]}")
ROUND = _set("()")
DIGITS = np.array([0, 1, 2, 3, 4, 5, 5, 6, 6, 6, 7, 7, 7, 7])
FLAGS = ("round", "dash", "dot", "at", "plus", "stop", "bracket")
#: Values of each part of a shape code.
RADIX = (len(CUES), 8, 3, *[2] * len(FLAGS))


@functools.lru_cache(1)
def cue_hashes() -> tuple[np.ndarray, np.ndarray]:
    text = " ".join(CUES[1:]).encode()
    data = np.frombuffer(text, np.uint8)
    begin, end, _ = words(data, np.array([0, len(data)]))
    h = hashes(data, begin, end)
    order = np.argsort(h)
    return h[order], order + 1


def shapes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end without outer quotes and stops, row, shape code) of every word."""
    begin, end, row = words(data, starts)
    if not len(begin):
        return begin, end, row, np.zeros(0, np.int64)
    stop = CLOSE[data[end - 1]]
    bracket = _set("[{<")[data[begin]]
    for _ in range(2):
        begin = begin + (OPEN[data[begin]] & (begin < end - 1))
        end = end - (CLOSE[data[end - 1]] & (begin < end - 1))
    inner_b = begin + ((data[begin] == 40) & (begin < end - 1))
    inner_e = end - ((data[end - 1] == 41) & (inner_b < end - 1))
    low = LOWER[data]
    table, names = cue_hashes()
    cue = np.zeros(len(begin), np.int64)
    short = np.flatnonzero(inner_e - inner_b <= 10)
    h = hashes(low, inner_b[short], inner_e[short])
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    cue[short] = np.where(table[at] == h, names[at], 0)

    def inside(mask: np.ndarray) -> np.ndarray:
        """How many of the (few) marked bytes lie in each word."""
        at = np.flatnonzero(mask)
        own = np.searchsorted(begin, at, "right") - 1
        return np.bincount(own[(own >= 0) & (at < end[own])], minlength=len(begin))

    digits, letters = inside(DIGIT[data]), end - begin - inside(~LETTER[data] & ~SPACE[data])
    parts = (cue, DIGITS[np.minimum(digits, len(DIGITS) - 1)], np.minimum(letters, 3) // 2 + (letters == 1) * 1,
             ROUND[data[begin]] | ROUND[data[end - 1]], inside(data == 45) > 0, inside(data == 46) > 0, inside(data == 64) > 0,
             inside(data == 43) > 0, stop, bracket)
    code = np.zeros(len(begin), np.int64)
    for p, n in zip(parts, RADIX, strict=True):
        code = code * n + np.minimum(p, n - 1)
    return begin, end, row, code


def _parts(codes: np.ndarray) -> list[np.ndarray]:
    out = []
    for n in reversed(RADIX):
        out.append(codes % n)
        codes = codes // n
    return out[::-1]


def features(codes: np.ndarray) -> np.ndarray:
    """Feature numbers of shape codes, one column per feature template; see ``FEATURES`` for their count."""
    cue, digits, letters, round_, dash, dot, at, plus, stop, bracket = _parts(codes)
    form = (((digits * 3 + letters) * 2 + round_) * 2 + dash) * 2 + dot
    mark = ((at * 2 + plus) * 2 + stop) * 2 + bracket
    columns, base = [], 0
    for value, n in ((cue, len(CUES)), (form, 8 * 3 * 8), (digits, 8), (letters * 2 + (cue > 0), 6), (mark, 16)):
        columns.append(value + base)
        base += n
    return np.stack(columns, 1)


FEATURES = len(CUES) + 8 * 3 * 8 + 8 + 6 + 16
CODES = int(np.prod(RADIX))
OUTSIDE = CODES  # beyond either end of a text

# ---------------------------------------------------------------------------
# Training table: [e ...] marks an address, [p ...] a phone number; {x} is filled in
# ---------------------------------------------------------------------------

EXAMPLES = """
reach me at [e {n} at {h} dot {t}] any time
write to [e {n} dot {m} at {h} dot {t}] today
my email is [e {n} (at) {h} (dot) {t}] thanks
{w} {w} [e {n} [at] {h} [dot] {t}] {w} {w}
{w} {w} [e {n} at {h} dot {t}] {w} {w}
mail [e {n}.{m} at {h} dot {t}] {w}
contact [e {n} underscore {m} at {h} dot {t}]. {w}
{w} [e {n} arroba {h} punto {t}] {w}
schreib an [e {n} punkt {m} at {h} punkt {t}] {w}
e-mail: [e {n} (at) {h}.{t}], {w}
call [p ({d3}) {d3}-{d4}] now
phone [p {d3}-{d3}-{d4}] or {w}
tel [p {d3}.{d3}.{d4}], {w}
{w} {w} [p ({d3}) {d3}-{d4}] {w} {w}
{w} {w} [p {d3}-{d3}-{d4}] {w} {w}
{w} {w} [p {d3}-{d3}-{d4}]. {w}
my number is [p {d3} {d3} {d4}] {w}
call me on [p 0{d3} {d3} {d4}] {w}
tel: [p 0{d2} {d4} {d4}] {w}
phone: [p {d3} {d3}-{d4}] {w}
fax [p ({d3}) {d3} {d4}] {w}
mobile [p 0{d4} {d3}{d3}] {w}
{w} [p +1 ({d3}) {d3}-{d4}] {w}
{w} [p ({d3}) {d3}-{d4}], {w} [p +1 ({d3}) {d3}-{d4}] {w}
call [p {d3}-{d3}-{d4}] or [p ({d3}) {d3}-{d4}] {w}
{w} [p {d3}.{d3}.{d4}] {w} [p {d3}-{d3}-{d4}] {w}
[e {n} dot {m} at {h} dot {t}], or call [p ({d3}) {d3}-{d4}] {w}
{w} [p +1 {d3} {d3} {d4}] {w}
{w} {w} {w} {w} {w} {w} {w}
{w}, {w} {w}. {w} {w} {w}
meet me at {d2} in the {w} of {w}
look at the {w} on page {d3}
{w} at {w} on the {w}. a dot
a red dot at the end of the {w}
at {h} we {w} dot by dot
the {w} was {d4}-{d2}-{d2} and {w}
{w} on {d4}-{d2}-{d2} {w}
{w} {d4}-{d2}-{d2} {d2}:{d2} {w}
the {w} on {d2}.{d2}.{d4} and {d2}-{d2}-{d4}
from {d4}-{d4} the {w} {w}
pages {d3}-{d3} of the {w}
{d2},{d3}.{d2} {w} and {d3} {w}
isbn 978-{d}-{d2}-{d3}{d3}-{d} {w}
version {d}.{d}.{d2} of {w}
{w} ({d2}) and ({d4}) {w}
{w} {d2}:{d2} {w} {d4} {w} {d3}
number {d3} and number {d4} {w}
call the {w} {d2} times in {d4}
{d3} {w} {d3} {w} {d4}
{d3} {d3} {w} of the {w}
{w} {d3}.{d3}.{d2}.{d2} {w}
{w} {n}@{h}.{t} {w} {w}
{w} {d4} {d4} {d4} {d4} {w}
{w}*** {w}### {w}&&& {w}$$$
{w} | {w} | {d3} | {w}
{W}!! {W}!! {W} {d2} {W}!!
licensed under the {w} license, version {d}.{d}.
{w} {d4}/{d2}/{d2} {w} {d3}-{w}
the {w} is at {w} and the {w} was in {w}
{d}. {w} {d2}. {w} {d3}. {w}
{w} de {w} es {w} in {w} a {w}
{w} at {t} {w} {w}
{w} at at of {w}
{w} at the {t} is {w}
{w} in at to {w}, at {w}
{w} at {t} at {w} at {t} {w}
{w} {t}, {t} at {t} of {w}
{w} dot {w} {w} dot {t} {w}
at {w} at {w}. {t} {t} {w}
de {w} on {w} com {w} net {w}
"""
NAMES = "jane john maria peter anna luis olga wei omar nina smith lopez meyer dubois khan rossi tanaka brown silva novak".split()
HOSTS = "example mailbox company university inbox webhost service provider gmail proton".split()
ENDS = "com org net edu de fr es io".split()
SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to io le is ou ar as de rt ve ción mente keit schen tion é".split()


def training_table(copies: int = 40, seed: int = 1, lines: list[str] | None = None) -> list[list[tuple[str, int]]]:
    """(word, label) lists: every example (of ``lines``, if given) filled in ``copies`` times."""
    r = np.random.default_rng(seed)

    def fill(m: re.Match) -> str:
        what = m.group(1)
        if what[0] == "d":
            return "".join(map(str, r.integers(0, 10, int(what[1:] or 1))))
        if what in "wW":
            word = "".join(r.choice(SYLLABLES, r.integers(1, 5)))
            return word.upper() if what == "W" else word.capitalize() if r.random() < 0.15 else word
        return str(r.choice({"n": NAMES, "m": NAMES, "h": HOSTS, "t": ENDS}[what]))

    out = []
    for line in lines or EXAMPLES.strip().split("\n"):
        for _ in range(copies):
            sentence, label = [], 0
            for word in re.sub(r"\{(\w+)\}", fill, line).split():
                if word in ("[e", "[p"):
                    label = 1 + (word == "[p")
                    continue
                closing = label and re.fullmatch(r".*\][.,]?", word) and not re.fullmatch(r"\[(at|dot)\]", word)
                sentence.append((re.sub(r"\]([.,]?)$", r"\1", word) if closing else word, label))
                label = 0 if closing else label
            out.append(sentence)
    return out


class Crf:
    """Weights of the three labels ("other" is zero): per word offset -1, 0, 1 and feature, and between labels."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray):
        self.weights, self.transitions = weights, transitions

    @functools.cached_property
    def tables(self) -> np.ndarray:
        """Score of every shape code (and of ``OUTSIDE``) by offset and label."""
        f = features(np.arange(CODES))
        out = np.zeros((3, CODES + 1, 3))
        for k in range(3):
            out[k, :CODES] = self.weights[k][f].sum(1)
        return out

    def emissions(self, code: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Scores of each word's labels."""
        new = np.ones(len(code), bool)
        new[1:] = row[1:] != row[:-1]
        before = np.where(new, OUTSIDE, np.roll(code, 1))
        after = np.where(np.roll(new, -1) if len(new) else new, OUTSIDE, np.roll(code, -1))
        return self.tables[0][before] + self.tables[1][code] + self.tables[2][after]

    def decode(self, code: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Best label of every word; texts are chains of their own, with "other" beyond both ends."""
        label = np.zeros(len(code), np.int8)
        if not len(code):
            return label
        e = self.emissions(code, row)
        t = self.transitions
        # a stretch of n labelled words beats "other" only if its words' advantages, n - 1 inner transitions and its two
        # outer ones gain together; the best stretch through each word bounds that (rows are kept apart by a deep drop)
        inner = (t[1:, 1:] - t[0, 0]).max()
        outer = (t[0, 1:] - t[0, 0]).max() + (t[1:, 0] - t[0, 0]).max()
        own = (e[:, 1:] - e[:, :1]).max(1) + inner
        drop = np.concatenate([[0.0], np.cumsum(np.where(row[1:] != row[:-1], 1e5, 0.0))])
        total = np.cumsum(own) - drop
        before = total - own
        ahead = np.maximum.accumulate(total[::-1])[::-1] - before  # best stretch from a word on
        behind = total - np.minimum.accumulate(before)  # best stretch up to a word
        open_ = ahead + behind - own - inner + outer >= -1e-6
        at = np.flatnonzero(open_)
        if not len(at):
            return label
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
        begin = at[first]
        length = np.diff(np.append(np.flatnonzero(first), len(at)))
        for n in np.unique(length):
            b = begin[length == n]
            label[b[:, None] + np.arange(n)] = self._viterbi(e[b[:, None] + np.arange(n)])
        return label

    def _viterbi(self, e: np.ndarray) -> np.ndarray:
        """Best paths through runs of equal length, "other" on both sides."""
        t = self.transitions
        best = t[0] + e[:, 0]
        back = []
        for i in range(1, e.shape[1]):
            step = best[:, :, None] + t
            back.append(step.argmax(1).astype(np.int8))
            best = step.max(1) + e[:, i]
        out = np.zeros(e.shape[:2], np.int8)
        out[:, -1] = (best + t[:, 0]).argmax(1)
        for i in range(e.shape[1] - 2, -1, -1):
            out[:, i] = back[i][np.arange(len(e)), out[:, i + 1]]
        return out


def train(table: list[list[tuple[str, int]]] | None = None, steps: int = 120, rate: float = 0.15, ridge: float = 2e-4) -> Crf:
    """Maximum likelihood by Adam; expectations from forward and backward sums over all sentences at once."""
    table = table or training_table()
    rows = [" ".join(w for w, _ in s).encode() for s in table]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    _, _, row, code = shapes(np.frombuffer(b"".join(rows), np.uint8), starts)
    gold = np.array([k for s in table for _, k in s])
    most = max(len(s) for s in table)
    place = np.arange(len(code)) - np.searchsorted(row, row)
    f = features(code)
    pad = np.zeros((3, len(code), f.shape[1]), np.int64)
    pad[0, 1:], pad[1], pad[2, :-1] = f[:-1], f, f[1:]
    inside = np.ones((3, len(code)), bool)
    inside[0, place == 0] = False
    inside[2, :-1] = row[1:] == row[:-1]
    inside[2, -1] = False
    n, length = len(table), np.bincount(row, minlength=len(table))
    w, t = np.zeros((3, FEATURES, 3)), np.zeros((3, 3))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    onehot = np.eye(3)[gold]
    gold_t = np.zeros((3, 3))
    before = np.where(place == 0, 0, np.roll(gold, 1))
    np.add.at(gold_t, (before, gold), 1)
    np.add.at(gold_t[:, 0], gold[np.cumsum(length) - 1], 1)
    for step in range(1, steps + 1):
        e = sum((w[k][pad[k]].sum(1) * inside[k][:, None]) for k in range(3))
        grid = np.full((n, most, 3), 0.0)
        grid[row, place] = e
        live = np.arange(most) < length[:, None]
        fwd, bwd = np.zeros((n, most + 1, 3)), np.zeros((n, most + 1, 3))
        fwd[:, 0] = t[0] + grid[:, 0]
        for i in range(1, most):
            s = fwd[:, i - 1, :, None] + t
            fwd[:, i] = np.where(live[:, i, None], np.logaddexp.reduce(s, axis=1) + grid[:, i], fwd[:, i - 1])
        bwd[:, most - 1] = t[:, 0]
        for i in range(most - 2, -1, -1):
            s = t + (grid[:, i + 1] + bwd[:, i + 1])[:, None, :]
            bwd[:, i] = np.where(live[:, i + 1, None], np.logaddexp.reduce(s, axis=2), t[:, 0])
        z = np.logaddexp.reduce(fwd[:, 0] + bwd[:, 0], axis=1)
        p = np.exp(fwd[:, :most] + bwd[:, :most] - z[:, None, None])[row, place]
        pair = np.zeros((3, 3))
        for i in range(1, most):
            s = fwd[:, i - 1, :, None] + t + (grid[:, i] + bwd[:, i])[:, None, :] - z[:, None, None]
            pair += np.exp(s[live[:, i]]).sum(0)
        pair[0] += p[place == 0].sum(0)
        pair[:, 0] += p[np.cumsum(length) - 1].sum(0)
        gap = onehot - p
        gw = np.zeros_like(w)
        for k in range(3):
            for c in range(f.shape[1]):
                np.add.at(gw[k], pad[k][inside[k], c], gap[inside[k]])
        gw = gw / n - ridge * w
        gw[:, :, 0] = 0
        gt = (gold_t - pair) / n - ridge * t
        for x, g, m, v in ((w, gw, moments[0], moments[1]), (t, gt, moments[2], moments[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Crf(w, t)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------

#: A written-out address has a word, an "at", a word, a dot (written or not) and a last word; a phone number 7 to 15 digits.
WRITTEN = re.compile(rb"\S+\s+[(\[]?(?:at|arroba)[)\]]?\s+\S+?(?:\s+[(\[]?(?:dot|punkt|point|punto)[)\]]?\s+|\.)[A-Za-z]", re.I)


def plausible(span: bytes, kind: int) -> bool:
    """The check a span of the field must pass, as pattern matches must pass theirs."""
    return 7 <= sum(48 <= c <= 57 for c in span) <= 15 if kind == 3 else WRITTEN.search(span) is not None


def kept(spark: SparkSession, copies: int = 40, seed: int = 1) -> Crf:
    """The field trained on ``training_table(copies, seed)``; its weights are kept under the shared folder and trained once for it."""
    table = training_table(copies, seed)
    name = hashlib.sha256(repr((table, FEATURES, RADIX)).encode()).hexdigest()[:24]
    if name not in _TRAINED:
        path = f"{shared_root(spark)}/pii-crf-{name}.json"
        try:
            told = json.loads(spark.read.text(path, wholetext=True).first()[0])  # one row of weights
            _TRAINED[name] = Crf(np.array(told["weights"]), np.array(told["transitions"]))
        except AnalysisException:  # not there yet
            model = _TRAINED[name] = train(table)
            text = json.dumps({"weights": model.weights.tolist(), "transitions": model.transitions.tolist()})
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return _TRAINED[name]


_TRAINED: dict[str, Crf] = {}


def field_spans(data: np.ndarray, starts: np.ndarray, model: Crf) -> dict[int, list[tuple[int, int, int]]]:
    """Row -> (start, kind number, end) in bytes of the row, of the field's spans."""
    begin, end, row, code = shapes(data, starts)
    label = model.decode(code, row)
    hit = np.flatnonzero(label)
    out: dict[int, list[tuple[int, int, int]]] = {}
    i = 0
    while i < len(hit):
        j = i + 1
        while j < len(hit) and hit[j] == hit[j - 1] + 1 and label[hit[j]] == label[hit[i]] and row[hit[j]] == row[hit[i]]:
            j += 1
        r, a, b = int(row[hit[i]]), int(begin[hit[i]]), int(end[hit[j - 1]])
        kind = KINDS.index(LABELS[label[hit[i]]])
        if plausible(data[a:b].tobytes(), kind):
            out.setdefault(r, []).append((a - int(starts[r]), kind, b - int(starts[r])))
        i = j
    return out


def text_spans(texts: pa.Array, model: Crf) -> Iterator[list[tuple[int, int, int, bool]]]:
    """(start, kind number, end, from a pattern) of every text, sorted, in code points."""
    for i, j, data, starts in slices(texts):
        added = field_spans(data, starts, model)
        digit = DIGIT[data]
        # texts without an @, four dotted numbers' worth of "digit . digit", 14 digits or a + have no match of that kind
        dotted = np.zeros(len(data), bool)
        dotted[1:-1] = (data[1:-1] == 46) & digit[:-2] & digit[2:]
        may = ((row_sums(data == 64, starts) > 0) | (row_sums(dotted, starts) > 2) | (row_sums(digit, starts) > 13)
               | (row_sums(data == 43, starts) > 0))
        for r in range(j - i):
            if not may[r] and r not in added:
                yield []
                continue
            raw = data[starts[r]:starts[r + 1]]
            base = pattern_spans(raw.tobytes().decode("utf-8", "replace")) if may[r] else []
            spans = [(a, k, b, True) for a, k, b in base]
            if r in added:
                points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                for a, k, b in added[r]:
                    a, b = int(points[a]), int(points[b])
                    if all(b <= x or y <= a for x, _, y in base):
                        spans.append((a, k, b, False))
            yield sorted(spans)


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find(df: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, base: found by a pattern) of every document."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    kind = to_arrow_type(_parse_datatype_string(SPANS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[{"kind": KINDS[k], "start": s, "end": e, "base": p} for s, k, e, p in x] for x in text_spans(b.column(1), model)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, f"doc_id long, spans {SPANS}")


def redact(df: DataFrame, model: Crf, text_col: str = "text") -> DataFrame:
    """``df`` with every span of ``text_col`` replaced by its kind in brackets (overlapping spans together)."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, changed = b.column(at), {}
            for i, spans in enumerate(text_spans(texts, model)):
                if spans:
                    text, out, done = texts[i].as_py(), [], 0
                    for s, k, e, _ in spans:
                        if s >= done:
                            out += [text[done:s], f"[{KINDS[k].upper()}]"]
                        done = max(done, e)
                    changed[i] = "".join([*out, text[done:]])
            if changed:
                new = pa.array([changed[i] if i in changed else texts[i].as_py() for i in range(len(texts))], texts.type)
                b = pa.RecordBatch.from_arrays([new if c == at else b.column(c) for c in range(b.num_columns)], schema=b.schema)
            yield b

    return df.mapInArrow(run, df.schema)
