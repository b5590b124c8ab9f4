"""Personal data: exact patterns, and spans added by a character BiLSTM with CRF transitions.

The patterns find emails, IP addresses, card and phone numbers. The model finds written-out and oddly
separated forms as well. It is trained in numpy, on the driver, from labelled spans: the patterns' own
spans in a bounded sample of texts (``SAMPLE_TEXTS`` texts of at most ``SAMPLE_CHARS`` characters, those
with the smallest hash), and written-out forms made from them by rule, set into those texts.

Overlapping windows, ``STRIDE`` characters apart from its beginning to its end, give one labelling of a whole
text: each character takes its label from the window in which it lies most central. Spans of that labelling
that a kind's rule accepts, and that overlap no other span, are added to the patterns'.

The spans are those of all windows, though windows that cannot matter are not computed. What a rule accepts
holds an at sign (or its written form), at least seven digits close together, four short numbers with plain or
written dots between them, or the beginning of an international number. The whole text is searched for these;
characters there are labelled, and from each labelled character on in both directions until one has no label,
however far that is. Any other run of labels holds nothing that a rule accepts.

Defined results: null and empty texts have no spans. Repeated rows are each searched. Other columns are
ignored, except by ``redacted``, which keeps them.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, table
from tidemark.llm.registry import query

KINDS = ("email", "ip", "card", "phone")
SAMPLE_TEXTS = 300
SAMPLE_CHARS = 8_000
WINDOW = 96
STRIDE = 48
MARGIN = 24  # characters read on either side of a place
HIDDEN = 16
EMBED = 10
STEPS = 140
BATCH = 96
DECODE_BATCH = 512

# The patterns, as they are asked for.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# A match can only begin where a run of digits begins; saying so keeps long runs from being tried at every digit.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Places that a span may be at: every form that ``accepted`` takes holds a match of one of these.
_DOT = r"(?:\s*\.\s*|\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s(?:dot|punkt|punto)\s)"
_AT = rf"[\[({{<]\s*at\s*[\])}}>]|\sat\s(?=\s*[\w-]+{_DOT}[\w-]|\S+\s+(?:dot|punkt|punto)\s)"
_IP_DOT = r"\s?[\[(]?(?:\.|dot)[\])]?\s?"
PLACES = [
    re.compile(p, re.I)
    for p in (
        rf"@|{_AT}",
        r"[0-9](?:[^0-9\n]{0,3}[0-9]){6,}",
        rf"[0-9]{{1,3}}(?:{_IP_DOT}[0-9]{{1,3}}){{3,}}",
        r"(?:\+|00)[1-9][ ().0-9/-]{6,20}[0-9]",
    )
]
PLACE = re.compile("|".join(p.pattern for p in PLACES), re.I)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    """As the whole pattern finds them from the left; looks back from each at sign only."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and EMAIL_LOCAL.match(text[start - 1]):
            start -= 1
        end = at + 1
        if start < at and (m := EMAIL_DOMAIN.match(text, at + 1)):
            end = free = m.end()
            found.append(("email", start, end))
        else:
            free = at + 1
        at = text.find("@", end)
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind as in ``KINDS``, then by start."""
    found = _emails(text)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


# The model. Labels: 0 outside, then begin and inside of each kind.

LABELS = 1 + 2 * len(KINDS)
_FORBIDDEN = -1e4


def _alphabet() -> dict[str, int]:
    return {chr(c): k + 3 for k, c in enumerate(range(32, 127))} | {"\n": 2}


_ID = _alphabet()
VOCABULARY = 98


def char_ids(text: str) -> list[int]:
    """0 stands for no character, 1 for one beyond ASCII."""
    return [_ID.get(c, 1) for c in text]


@dataclass
class Model:
    """Parameters by name; ``E`` embeds, ``f`` and ``b`` are the two directions, ``o`` the emissions, ``T`` transitions."""

    p: dict[str, np.ndarray]

    @classmethod
    def new(cls, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        p = {"E": rng.normal(0, 0.5, (VOCABULARY, EMBED))}
        for d in "fb":
            p[f"x{d}"] = rng.normal(0, 0.3, (EMBED, 4 * HIDDEN))
            p[f"h{d}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
            p[f"c{d}"] = np.zeros(4 * HIDDEN)
            p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1.0  # begin by remembering
        p["o"] = rng.normal(0, 0.3, (2 * HIDDEN, LABELS))
        p["oc"] = np.zeros(LABELS)
        p["T"] = np.zeros((LABELS, LABELS))
        return cls({k: v.astype(np.float32) for k, v in p.items()})


def _allowed() -> np.ndarray:
    """Inside labels follow only their own begin or inside label."""
    out = np.zeros((LABELS, LABELS), np.float32)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        out[:, inside] = _FORBIDDEN
        out[[inside - 1, inside], inside] = 0
    return out


ALLOWED = _allowed()


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x, w_h, keep: bool):
    """Hidden states over time of inputs already multiplied; time is the first axis."""
    steps, n, _ = x.shape
    h = c = np.zeros((n, HIDDEN), np.float32)
    hs, memory = np.empty((steps, n, HIDDEN), np.float32), []
    for t in range(steps):
        z = x[t] + h @ w_h
        gates = _sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        before_h, before_c = h, c
        c = f * c + i * g
        tc = np.tanh(c)
        h = hs[t] = o * tc
        if keep:
            memory.append((i, f, o, g, before_c, before_h, tc))
    return hs, memory


def _lstm_back(dh, w_h, memory):
    """Gradients of the inputs and of the recurrent weights."""
    dx, dw = np.empty((*dh.shape[:2], 4 * HIDDEN), np.float32), np.zeros_like(w_h)
    dc = back = np.zeros_like(dh[0])
    for t in range(len(dh) - 1, -1, -1):
        i, f, o, g, before_c, before_h, tc = memory[t]
        d = dh[t] + back
        dc = dc + d * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), d * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        dx[t] = dz
        dw += before_h.T @ dz
        back = dz @ w_h.T
        dc = dc * f
    return dx, dw


def emissions(model: Model, x: np.ndarray, keep: bool = False):
    """Label scores, time first, for windows of character ids (windows first)."""
    p = model.p
    e = p["E"][x.T]
    hf, mf = _lstm(e @ p["xf"] + p["cf"], p["hf"], keep)
    hb, mb = _lstm(e[::-1] @ p["xb"] + p["cb"], p["hb"], keep)
    h = np.concatenate([hf, hb[::-1]], 2)
    return h @ p["o"] + p["oc"], (e, h, mf, mb)


def _sum_exp(x, axis):
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def loss_gradients(model: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Negative log-likelihood of labels ``y`` under the CRF, and its gradients; both a window's mean."""
    p, (n, steps) = model.p, x.shape
    score, (e, h, mf, mb) = emissions(model, x, True)
    trans = p["T"] + ALLOWED
    alpha, beta = np.empty_like(score), np.empty_like(score)
    alpha[0] = score[0]
    for t in range(1, steps):
        alpha[t] = score[t] + _sum_exp(alpha[t - 1][:, :, None] + trans, 1)
    beta[-1] = 0
    for t in range(steps - 2, -1, -1):
        beta[t] = _sum_exp(trans + (score[t + 1] + beta[t + 1])[:, None, :], 2)
    whole = _sum_exp(alpha[-1], 1)
    rows, times = np.arange(n)[None, :], np.arange(steps)[:, None]
    gold = score[times, rows, y.T].sum(0) + trans[y[:, :-1], y[:, 1:]].sum(1)
    d = np.exp(alpha + beta - whole[:, None])
    d_trans = np.zeros_like(trans)
    for t in range(steps - 1):
        d_trans += np.exp(alpha[t][:, :, None] + trans + (score[t + 1] + beta[t + 1])[:, None, :] - whole[:, None, None]).sum(0)
    np.add.at(d_trans, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
    d[times, rows, y.T] -= 1
    d = (d / n).astype(np.float32)
    g = {"T": d_trans / n, "o": np.tensordot(h, d, ([0, 1], [0, 1])), "oc": d.sum((0, 1))}
    dh = d @ p["o"].T
    dxf, g["hf"] = _lstm_back(dh[:, :, :HIDDEN], p["hf"], mf)
    dxb, g["hb"] = _lstm_back(dh[::-1, :, HIDDEN:], p["hb"], mb)
    de = dxf @ p["xf"].T + (dxb @ p["xb"].T)[::-1]
    g["xf"], g["xb"] = np.tensordot(e, dxf, ([0, 1], [0, 1])), np.tensordot(e[::-1], dxb, ([0, 1], [0, 1]))
    g["cf"], g["cb"] = dxf.sum((0, 1)), dxb.sum((0, 1))
    g["E"] = np.zeros_like(p["E"])
    np.add.at(g["E"], x.T, de)
    return float((whole - gold).mean()), g


def decode(model: Model, x: np.ndarray) -> np.ndarray:
    """Best label path of every window."""
    score, _ = emissions(model, x)
    trans, best, back = model.p["T"] + ALLOWED, score[0], []
    for t in range(1, len(score)):
        step = best[:, :, None] + trans
        back.append(step.argmax(1))
        best = score[t] + step.max(1)
    out = np.empty(x.shape, np.int64)
    out[:, -1] = best.argmax(1)
    for t in range(len(score) - 1, 0, -1):
        out[:, t - 1] = back[t - 1][np.arange(len(x)), out[:, t]]
    return out


# Training examples.


def _written(kind: str, rng: random.Random) -> str:
    """A form of a kind, plain or written out, from made-up parts."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))
    if kind == "email":
        at = rng.choice(["@", "@", " [at] ", " (at) ", "[at]", "(at)", " at ", " @ "])
        dot = "." if at == "@" else rng.choice([" dot ", ".", " [dot] ", "(dot)", " dot "])
        dot = " dot " if at == " at " else dot
        local = rng.choice([word(), word() + "." + word(), number(2), word() + number(2)])
        return local + at + rng.choice([word(), word() + number(1)]) + dot + rng.choice(["com", "org", "net", "example" + dot + "com"])
    if kind == "ip":
        dot = rng.choice([".", ".", " . ", "[.]", "(.)", " dot "])
        return dot.join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        digits = number(15)
        digits += next(d for d in "0123456789" if luhn(digits + d))
        return rng.choice(["", "", " ", "-", ".", "/", "_"]).join(digits[k : k + 4] for k in range(0, 16, 4))
    sep = rng.choice([" ", "-", ".", ""])
    lead = rng.choice(["+", "+", "00", "tel: +"])
    form = f"{lead}{rng.choice(['1', '44', '49', '33', '34'])}{rng.choice([' ', '-', ' ('])}{number(3)}"
    return (form + (") " if "(" in form else sep) + number(3) + (sep or "-") + number(4)).removeprefix("tel: ")


def _distractor(rng: random.Random) -> str:
    """Digits that are nobody's data."""
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    return rng.choice(
        [number(rng.randint(5, 9)), f'token = "{hexes(40)}"', f"{number(4)}-{number(2)}-{number(2)}", f"{number(2)}:{number(2)}:{number(2)}",
         ", ".join(number(rng.randint(1, 4)) for _ in range(6)), f"v{number(1)}.{number(2)}.{number(1)}", f"{number(3)},{number(3)},{number(3)}.{number(2)}"]
    )


def labelled(text: str, spans: list[Span]) -> np.ndarray:
    y = np.zeros(len(text), np.int64)
    for kind, start, end in spans:
        k = 1 + 2 * KINDS.index(kind)
        y[start:end] = k + 1
        y[start] = k
    return y


def examples(texts: list[str], n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Windows of character ids and labels: the texts' own spans and forms set into the texts."""
    rng = random.Random(seed)
    texts = [t for t in texts if t] or ["nothing to see here, and more of it"]
    x, y = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    found = [(t, s) for t in texts for s in base_spans(t)]
    for k in range(n):
        turn = rng.random()
        if turn < 0.25 and found:
            text, (_, start, end) = rng.choice(found)
            whole = labelled(text, base_spans(text))
        else:
            text, form = rng.choice(texts), ""
            start = rng.randint(0, len(text))
            kind = rng.choice(KINDS)
            form = _written(kind, rng) if turn < 0.75 else _distractor(rng) if turn < 0.92 else ""
            left, right = text[max(0, start - WINDOW) : start], text[start : start + WINDOW]
            if form:
                left, right = left + rng.choice([" ", " ", "\n", ": "]), rng.choice([" ", " ", ". ", ", ", "\n"]) + right
            around = left + " " * len(form) + right
            text, start, end = left + form + right, len(left), len(left) + len(form)
            own = [(kind, start, end)] if form and turn < 0.75 else []
            whole = labelled(text, own + [s for s in base_spans(around) if s[2] <= start or s[1] >= end])
        first = max(0, min(len(text) - WINDOW, rng.randint(start - WINDOW + 8, max(start - WINDOW + 8, end - 8))))
        part = text[first : first + WINDOW]
        x[k, : len(part)] = char_ids(part)
        y[k, : len(part)] = whole[first : first + WINDOW]
    return x, y


def train(texts: list[str], steps: int = STEPS, batch: int = BATCH, rate: float = 0.02) -> Model:
    """Adam over ``steps`` batches; the same texts give the same model."""
    model = Model.new()
    x, y = examples(texts, steps * batch)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    for step in range(steps):
        at = slice(step * batch, (step + 1) * batch)
        _, grads = loss_gradients(model, x[at], y[at])
        norm = float(np.sqrt(sum((g**2).sum() for g in grads.values())))
        pace = rate * min(1.0, (steps - step) / (0.6 * steps))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            hat = first[k] / (1 - 0.9 ** (step + 1))
            model.p[k] = (model.p[k] - pace * hat / (np.sqrt(second[k] / (1 - 0.99 ** (step + 1))) + 1e-7)).astype(np.float32)
    return model


# Decoding texts.


_EDGE = (WINDOW - STRIDE) // 2  # where the next of two windows becomes the one in which a character lies deeper


def _last_window(length: int) -> int:
    return -(-max(0, length - WINDOW) // STRIDE) * STRIDE


def owned(length: int, start: int) -> tuple[int, int]:
    """First character and end, from a window's start, of those that take their labels from it."""
    return 0 if start == 0 else _EDGE, length - start if start == _last_window(length) else _EDGE + STRIDE


def windows_of(text: str) -> list[int]:
    """Starts of the windows that give the labels of every place and its margin."""
    starts, last_window = set(), _last_window(len(text))
    # each pattern by itself: a match of one may begin inside a match of another
    for first, last in (m.span() for p in PLACES for m in p.finditer(text)):
        ends = (max(0, first - MARGIN), min(len(text), last + MARGIN) - 1)
        low, high = (min(max(0, (at - _EDGE) // STRIDE * STRIDE), last_window) for at in ends)
        starts.update(range(low, high + 1, STRIDE))
    return sorted(starts)


def windows_beyond(length: int, decoded: dict[int, np.ndarray], new: list[int], reach: int) -> list[int]:
    """The next ``reach`` windows on each side where labels of ``new`` ones run up to what is not decoded."""
    wanted, last_window = set(), _last_window(length)
    for start in new:
        first, end = owned(length, start)
        for at, step in ((first, -STRIDE), (end - 1, STRIDE)):
            if decoded[start][at] and start + step not in decoded:
                wanted.update(k for k in range(start + step, start + (reach + 1) * step, step) if 0 <= k <= last_window)
    return sorted(wanted - decoded.keys())


def reconciled(length: int, starts: list[int], labels: np.ndarray) -> dict[int, int]:
    """Labels of labelled characters, from the windows in which they are farthest from an edge."""
    found = {}
    for start, path in zip(starts, labels.tolist(), strict=True):
        first, end = owned(length, start)
        found.update((start + k, path[k]) for k in range(first, end) if path[k])
    return found


def labels_of(texts: list[str], model: Model) -> list[dict[int, int]]:
    """Labels of every text's places, and of all runs of labels that begin, end or lie there, whole."""
    decoded: list[dict[int, np.ndarray]] = [{} for _ in texts]
    wanted, reach = [windows_of(t) for t in texts], 1
    while any(wanted):
        rows = [(n, start) for n, starts in enumerate(wanted) for start in starts]
        x = np.zeros((len(rows), WINDOW), np.int64)
        for row, (n, start) in enumerate(rows):
            ids = char_ids(texts[n][start : start + WINDOW])
            x[row, : len(ids)] = ids
        for k in range(0, len(x), DECODE_BATCH):
            for (n, start), path in zip(rows[k : k + DECODE_BATCH], decode(model, x[k : k + DECODE_BATCH])):
                decoded[n][start] = path
        wanted = [windows_beyond(len(t), d, new, reach) for t, d, new in zip(texts, decoded, wanted, strict=True)]
        reach *= 2
    return [reconciled(len(t), sorted(d), np.array([d[k] for k in sorted(d)])) for t, d in zip(texts, decoded, strict=True)]


_EMAIL_FORM = re.compile(r"[\w.%+-]+\s*(?:@|[\[({<]\s*at\s*[\])}>]|\sat\s)\s*[\w-]+(?:(?:\s*\.\s*|\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s(?:dot|punkt|punto)\s)[\w-]+)+", re.I)
_IP_FORM = re.compile(r"(?<![0-9])([0-9]{1,3})(?:\s?[\[(]?(?:\.|dot)[\])]?\s?([0-9]{1,3}))(?:\s?[\[(]?(?:\.|dot)[\])]?\s?([0-9]{1,3}))(?:\s?[\[(]?(?:\.|dot)[\])]?\s?([0-9]{1,3}))(?![0-9])", re.I)
_CARD_FORM = re.compile(r"[0-9](?:[ ./_-]{0,2}[0-9]){15,18}(?![0-9])")
_PHONE_FORM = re.compile(r"(?:\+|00)[1-9][ ().0-9/-]{6,20}[0-9]")


def accepted(kind: str, text: str) -> tuple[int, int] | None:
    """The part of a decoded span that is of its kind, or None."""
    form = {"email": _EMAIL_FORM, "ip": _IP_FORM, "card": _CARD_FORM, "phone": _PHONE_FORM}[kind]
    if not (m := form.search(text)):
        return None
    digits = _digits(m[0])
    right = {
        "email": True,
        "ip": kind == "ip" and all(int(g) <= 255 for g in m.groups()),
        "card": 16 <= len(digits) <= 19 and luhn(digits),
        "phone": 8 <= len(digits) <= 15,
    }
    return m.span() if right[kind] else None


def _model_spans(text: str, labels: dict[int, int]) -> list[Span]:
    """Runs of labels as spans."""
    out: list[list] = []
    for at, label in labels.items():
        kind, begins = (label - 1) // 2, label % 2 == 1
        if out and not begins and out[-1][0] == kind and out[-1][2] == at:
            out[-1][2] = at + 1
        else:
            out.append([kind, at, at + 1])
    found = []
    for kind, start, end in out:
        if part := accepted(KINDS[kind], text[start:end]):
            found.append((KINDS[kind], start + part[0], start + part[1]))
    return found


def find(texts: list[str | None], model: Model) -> list[tuple[list[Span], list[Span]]]:
    """Per text the patterns' spans, and all spans with the model's; both by kind, then start."""
    texts = [t or "" for t in texts]
    out = []
    for text, labels in zip(texts, labels_of(texts, model), strict=True):
        base = base_spans(text)
        spans = list(base)
        for span in _model_spans(text, labels):
            if all(span[2] <= s[1] or span[1] >= s[2] for s in spans):
                spans.append(span)
        out.append((base, sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))))
    return out


def fit(documents: DataFrame) -> Model:
    """Train on the sample of ``documents``: different texts of least hash; hashes choose them, then they are fetched."""
    short = documents.where(F.length("text") <= SAMPLE_CHARS).select("text", F.xxhash64("text").alias("at"))
    least = [r["at"] for r in short.select("at").distinct().orderBy("at").limit(SAMPLE_TEXTS).collect()]
    if not least:
        return train([])
    chosen = short.where(F.col("at") <= least[-1]).groupBy("at").agg(F.min("text").alias("text"))
    return train([r["text"] for r in chosen.orderBy("at").collect()])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end) of every document."""

    def scanned(ids, texts):
        found = find(texts, model)
        as_rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        return {"doc_id": ids, "base": [as_rows(f[0]) for f in found], "spans": [as_rows(f[1]) for f in found]}

    spans = "array<struct<kind: string, start: long, end: long>>"
    return map_rows(documents, scanned, f"doc_id long, base {spans}, spans {spans}", "doc_id", "text")


def redacted_text(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with personal data replaced in ``text``; ``n_chars``, if there, follows."""
    schema, names = documents.schema, documents.columns

    def replaced(*columns):
        by_name = dict(zip(names, columns, strict=True))
        found = find(by_name["text"], model)
        by_name["text"] = [redacted_text(t, f[1]) for t, f in zip(by_name["text"], found, strict=True)]
        if "n_chars" in by_name:
            by_name["n_chars"] = [n if t is None else len(t) for t, n in zip(by_name["text"], by_name["n_chars"], strict=True)]
        return by_name

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return map_rows(documents, replaced, types, *names)


@query()
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    joined_ = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    found = scan(documents, fit(documents))
    counts = [f"cast(size(filter(base, s -> s.kind = '{kind}')) AS long) AS n_{kind}" for kind in KINDS]
    return found.selectExpr(
        "doc_id", *counts, f"sha2({joined_.format('base')}, 256) AS base_sha256", f"{joined_.format('spans')} AS spans"
    )
