"""Personal data: exact patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns find what stands alone in its usual shape. The tagger, trained in a bounded sample from their spans and other
shapes of these, finds what they merge or cut, such as a card number right after a phone number, and what is written
otherwise: cards with dots, phones without a plus, IPv6. It reads overlapping windows; their scores are
stitched into one sequence for each stretch of text, which is decoded as a whole.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.common import Batches, map_batches, whole_texts

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + 2 * len(KINDS)  # 0: none; 1 + 2k: kind k begins; 2 + 2k: kind k goes on
WINDOW, STRIDE = 96, 48
#: Every kind has a digit or an at sign, so a window without either has nothing to find.
TELLTALE = re.compile(r"[0-9@]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# possessive, and from the first digit of a run only: the same matches in linear time
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    doubled = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def is_card(text: str) -> bool:
    digits = NOT_DIGIT.sub("", text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(NOT_DIGIT.sub("", text)) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping ``local@domain``, each local part read backwards from its at sign."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns by start, then kind."""
    if not TELLTALE.search(text):
        return []
    found = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    for kind, (pattern, good) in enumerate(((IP, is_ip), (CARD, is_card), (PHONE, is_phone)), 1):
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if good(m[0])]
    return sorted(found, key=lambda s: (s[0], s[2]))


def unsure(text: str) -> bool:
    """Whether a pattern matched something it then dropped: neither personal data nor its absence is sure."""
    dropped = any(not is_card(m[0]) and len(NOT_DIGIT.sub("", m[0])) >= 12 for m in CARD.finditer(text))
    return dropped or any(not is_phone(m[0]) for m in PHONE.finditer(text)) or any(not is_ip(m[0]) for m in IP.finditer(text))


# --- the tagger -----------------------------------------------------------------------------------

SYMBOLS = 100


def characters(text: str) -> np.ndarray:
    """One of ``SYMBOLS`` per character: printable ASCII as it is, white space, other letters, the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = np.where(points < 127, points - 32, np.where(points < 0x3000, 96, 97))
    return np.where(points < 32, 95, np.where(points == 127, 97, out))


def tags(size: int, spans: list[Span]) -> np.ndarray:
    labels = np.zeros(size, np.int64)
    for a, b, kind in spans:
        labels[max(a, 0) : b] = 2 + 2 * kind
        if a >= 0:
            labels[a] = 1 + 2 * kind
    return labels


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Tagger:
    """Weights for both directions at once (first axis), the output layer, and the CRF's transitions."""

    def __init__(self, width: int = 24, seed: int = 3):
        rng = np.random.default_rng(seed)
        scale = 1 / np.sqrt(width)
        self.width = width
        self.w = {
            "input": rng.normal(0, 0.3, (2, SYMBOLS, 4 * width)),
            "hidden": rng.normal(0, scale, (2, width, 4 * width)),
            "output": rng.normal(0, scale, (2, width, LABELS)),
            "bias": np.zeros(LABELS),
            "move": rng.normal(0, 0.1, (LABELS, LABELS)),
            "begin": np.zeros(LABELS),
        }
        self.w["input"][:, :, width : 2 * width] += 1.0  # remember by default

    def _states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Hidden states, (2, windows, length, width); the second direction reads from the end."""
        n, length = x.shape
        h = c = np.zeros((2, n, self.width), self.w["hidden"].dtype)
        out = np.empty((2, n, length, self.width), h.dtype)
        both = np.stack([x, x[:, ::-1]])
        k = self.width
        for t in range(length):
            gates = np.stack([self.w["input"][0][both[0, :, t]], self.w["input"][1][both[1, :, t]]]) + h @ self.w["hidden"]
            gates[..., : 3 * k] = _sigmoid(gates[..., : 3 * k])
            gates[..., 3 * k :] = np.tanh(gates[..., 3 * k :])
            i, f, o, g = (gates[..., j * k : (j + 1) * k] for j in range(4))
            before, c = c, f * c + i * g
            squashed = np.tanh(c)
            if keep is not None:
                keep.append((gates, before, squashed, h))
            h = o * squashed
            out[:, :, t] = h
        out[1] = out[1, :, ::-1].copy()
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        h = self._states(x)
        return h[0] @ self.w["output"][0] + h[1] @ self.w["output"][1] + self.w["bias"]

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        n, length = x.shape
        k, w, keep = self.width, self.w, []
        h = self._states(x, keep)
        e = h[0] @ w["output"][0] + h[1] @ w["output"][1] + w["bias"]
        forward, backward = np.empty_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0] + w["begin"]
        for t in range(1, length):
            forward[:, t] = _logsumexp(forward[:, t - 1, :, None] + w["move"], 1) + e[:, t]
        for t in range(length - 2, -1, -1):
            backward[:, t] = _logsumexp(w["move"] + (e[:, t + 1] + backward[:, t + 1])[:, None], 2)
        total = _logsumexp(forward[:, -1], 1)
        rows = np.arange(n)
        right = np.zeros_like(e)
        right[rows[:, None], np.arange(length), y] = 1
        d_e = (np.exp(forward + backward - total[:, None, None]) - right) / n
        pairs = np.exp(forward[:, :-1, :, None] + w["move"] + (e + backward)[:, 1:, None] - total[:, None, None, None]).sum((0, 1))
        np.subtract.at(pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        loss = (total - (e * right).sum((1, 2)) - w["begin"][y[:, 0]] - w["move"][y[:, :-1], y[:, 1:]].sum(1)).mean()
        g = {name: np.zeros_like(v) for name, v in w.items()}
        g["move"], g["begin"], g["bias"] = pairs / n, d_e[:, 0].sum(0), d_e.sum((0, 1))
        g["output"] = np.stack([np.einsum("nth,ntl->hl", h[d], d_e) for d in range(2)])
        d_h = np.stack([d_e @ w["output"][d].T for d in range(2)])
        d_h[1] = d_h[1, :, ::-1].copy()
        both = np.stack([x, x[:, ::-1]])
        next_h = next_c = np.zeros((2, n, k))
        for t in range(length - 1, -1, -1):
            gates, before, squashed, previous = keep[t]
            i, f, o, c = (gates[..., j * k : (j + 1) * k] for j in range(4))
            here = d_h[:, :, t] + next_h
            d_c = next_c + here * o * (1 - squashed**2)
            d_gates = np.concatenate([d_c * c * i * (1 - i), d_c * before * f * (1 - f), here * squashed * o * (1 - o), d_c * i * (1 - c**2)], -1)
            next_c = d_c * f
            next_h = d_gates @ w["hidden"].transpose(0, 2, 1)
            g["hidden"] += previous.transpose(0, 2, 1) @ d_gates
            for d in range(2):
                np.add.at(g["input"][d], both[d, :, t], d_gates[d])
        return float(loss), g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 250, batch: int = 64, rate: float = 0.02, seed: int = 5) -> Tagger:
        """Adam on the negative log-likelihood of the tag sequences."""
        rng = np.random.default_rng(seed)
        mean, square = ({n: np.zeros_like(v) for n, v in self.w.items()} for _ in range(2))
        for step in range(1, steps + 1 if len(x) else 1):
            part = rng.integers(0, len(x), batch)
            _, g = self._gradient(x[part], y[part])
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            now = rate * min(1.0, step / 30) * (1 - 0.9 * step / steps)
            for name, v in g.items():
                v = v * min(1.0, 5.0 / max(size, 1e-12))
                mean[name] += 0.1 * (v - mean[name])
                square[name] += 0.01 * (v * v - square[name])
                self.w[name] -= now * (mean[name] / (1 - 0.9**step)) / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-8)
        self.w = {n: v.astype(np.float32) for n, v in self.w.items()}
        return self

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Most likely tags of several sequences padded to one length (Viterbi)."""
        n, length, _ = scores.shape
        best = scores[:, 0] + self.w["begin"]
        back = np.zeros((n, length, LABELS), np.int8)
        rows = np.arange(n)
        for t in range(1, length):
            ways = best[:, :, None] + self.w["move"]
            back[:, t] = ways.argmax(1)
            new = ways.max(1) + scores[:, t]
            best = np.where((t < lengths)[:, None], new, best)
        out = np.zeros((n, length), np.int64)
        last = best.argmax(1)
        for t in range(length - 1, -1, -1):
            out[:, t] = last
            # beyond its end a sequence keeps its last tag
            last = np.where(t < lengths, back[rows, t, last], last)
        return out


def spans_of(labels: np.ndarray) -> list[Span]:
    """Runs of one kind that begin with its first tag."""
    found: list[Span] = []
    start, kind = -1, -1
    for i, tag in enumerate([*labels.tolist(), 0]):
        if start >= 0 and tag != 2 + 2 * kind:
            found.append((start, i, kind))
            start = -1
        if tag % 2:
            start, kind = i, tag // 2
    return found


def stretches(text: str) -> list[tuple[int, int]]:
    """Unions of the windows (of a fixed grid over the whole text) that hold a digit or an at sign."""
    found: list[tuple[int, int]] = []
    at = TELLTALE.search(text)
    while at:
        place = at.start()
        # windows k * STRIDE ... + WINDOW that cover the place
        first = max(0, (place - WINDOW) // STRIDE + 1) * STRIDE
        last = place // STRIDE * STRIDE + WINDOW
        if found and first <= found[-1][1]:
            found[-1] = found[-1][0], min(last, len(text))
        else:
            found.append((first, min(last, len(text))))
        # the next telltale beyond the last window's first half opens another window
        at = TELLTALE.search(text, max(place + 1, place // STRIDE * STRIDE + STRIDE))
    return found


_WEIGHT = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])


def tag_stretches(model: Tagger, texts: list[str], batch: int = 512) -> list[np.ndarray]:
    """Tags of whole stretches: windows are scored apart, joined with weight towards their middles, and each
    stretch is decoded as one sequence."""
    symbols = [characters(t) for t in texts]
    jobs = [(s, a) for s, x in enumerate(symbols) for a in range(0, max(1, len(x) - WINDOW + STRIDE), STRIDE)]
    sums = [np.zeros((len(x), LABELS), np.float32) for x in symbols]
    weights = [np.zeros((len(x), 1), np.float32) for x in symbols]
    for at in range(0, len(jobs), batch):
        part = jobs[at : at + batch]
        x = np.full((len(part), WINDOW), 95)
        for row, (s, a) in zip(x, part):
            piece = symbols[s][a : a + WINDOW]
            row[: len(piece)] = piece
        for e, (s, a) in zip(model.emissions(x), part):
            n = min(WINDOW, len(symbols[s]) - a)
            sums[s][a : a + n] += e[:n] * _WEIGHT[:n, None]
            weights[s][a : a + n] += _WEIGHT[:n, None]
    scores = [s / np.maximum(w, 1e-6) for s, w in zip(sums, weights)]
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
    order = sorted((i for i in range(len(texts)) if len(scores[i])), key=lambda i: len(scores[i]))
    at = 0
    while at < len(order):
        # together as many as fit when padded to the longest
        size = max(1, min(256, (1 << 18) // len(scores[order[min(at + 255, len(order) - 1)]])))
        part = order[at : at + size]
        lengths = np.array([len(scores[i]) for i in part])
        padded = np.zeros((len(part), int(lengths.max()), LABELS), np.float32)
        for row, i in zip(padded, part):
            row[: len(scores[i])] = scores[i]
        for i, labels in zip(part, model.decode(padded, lengths)):
            out[i] = labels[: len(scores[i])]
        at += size
    return out


CARD_LIKE = re.compile(r"[0-9](?:[\x20./_-]{0,2}[0-9])++")
PHONE_LIKE = re.compile(r"\+?\(?[0-9][\x20()./0-9-]*[0-9]")
DATE_LIKE = re.compile(r"(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}.*")


def may_be_ip(text: str) -> bool:
    if IP.fullmatch(text):
        return is_ip(text)
    try:
        return text.count(":") > 1 and ipaddress.IPv6Address(text) is not None
    except ValueError:
        return False


def may_be_phone(text: str) -> bool:
    """Nine to fifteen digits that are more than one plain number: with a plus, a leading zero or bracket, or in three groups."""
    if not PHONE_LIKE.fullmatch(text) or not is_phone(text) or IP.fullmatch(text) or DATE_LIKE.fullmatch(text):
        return False
    return text[0] in "+(0" or len(re.findall("[0-9]+", text)) > 2


#: What a tagged span has to be, by kind: looser than the patterns, which have found their own already.
_POSSIBLE = (lambda t: bool(re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", t)), may_be_ip, lambda t: bool(CARD_LIKE.fullmatch(t)) and is_card(t), may_be_phone)


def all_spans(model: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, spans added by the tagger) of each text.

    An added span is possible for its kind (digits, checksum, address) and overlaps no base span."""
    base = [base_spans(t) for t in texts]
    places = [(i, a, b) for i, t in enumerate(texts) for a, b in stretches(t)]
    added: list[list[Span]] = [[] for _ in texts]
    for (i, a, b), labels in zip(places, tag_stretches(model, [texts[i][a:b] for i, a, b in places])):
        for x, y, kind in spans_of(labels):
            piece = texts[i][a + x : a + y]
            x, y = x + len(piece) - len(piece.lstrip(" .,;:")), y - (len(piece) - len(piece.rstrip(" .,;:")))
            start, end = a + x, a + y
            if _POSSIBLE[kind](texts[i][start:end]):
                added[i].append((start, end, kind))
    for i, found in enumerate(added):
        if found and base[i]:
            ends = sorted((s, e) for s, e, _ in base[i])
            starts = np.array([s for s, _ in ends])
            reach = np.maximum.accumulate([e for _, e in ends])
            k = np.searchsorted(starts, [e for _, e, _ in found], side="left") - 1
            added[i] = [s for s, j in zip(found, k) if j < 0 or reach[j] <= s[0]]
    return list(zip(base, added))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2])))


# --- over tables ----------------------------------------------------------------------------------


def _examples(a_text: int = 2, seed: int = 17):
    """Up to ``a_text`` windows of each text with a telltale, at places that a hash picks, with the base spans inside."""

    def find(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                if not TELLTALE.search(text):
                    continue
                spans = base_spans(text)
                places = [s[0] for s in spans] or [m.start() for m in TELLTALE.finditer(text)]
                for k in range(a_text):
                    h = xxhash.xxh64_intdigest(text[:200] + text[-200:] + str(len(text)), seed + k)
                    begin = max(0, places[h % len(places)] - (h >> 20) % (WINDOW - 24))
                    piece = text[begin : begin + WINDOW]
                    if not unsure(text[max(0, begin - 40) : begin + WINDOW + 40]):
                        inside = [(a - begin, min(b - begin, WINDOW), kind) for a, b, kind in spans if a < begin + WINDOW and b > begin]
                        rows.append((h >> 1, bool(inside), piece, ",".join(f"{a}:{b}:{kind}" for a, b, kind in inside)))
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["h", "found", "text", "spans"])

    return find


def _varied(item: str, kind: int, rng: np.random.Generator) -> str:
    """A span of the same shape with other digits; card numbers now and then in groups of four."""
    pool = rng.integers(0, 10, int(rng.choice([1, 2, 10, 10, 10])))
    made = "".join(str(pool[int(rng.integers(len(pool)))]) if c.isdigit() and c.isascii() else c for c in item)
    if kind == 2 and made.isdigit() and rng.random() < 0.3:
        made = str(rng.choice([" ", "-"])).join(made[i : i + 4] for i in range(0, len(made), 4))
    return made


def _reshaped(item: str, kind: int, rng: np.random.Generator) -> str:
    """The same kind of thing in a shape that the patterns do not know."""
    d = NOT_DIGIT.sub("", item)
    if kind == 1:
        groups = [f"{int(g):x}" for g in rng.integers(0, 1 << 16, 8)]
        cut = int(rng.integers(1, 5))
        return ":".join(groups) if rng.random() < 0.5 else "::".join([":".join(groups[:cut]), ":".join(groups[cut + 2 :])])
    if kind == 2:
        return str(rng.choice([" ", "-", ".", "/"])).join(d[i : i + 4] for i in range(0, len(d), 4))
    if kind == 3 and len(d) >= 10:
        d = d[-10:]
        country = str(rng.integers(1, 99))
        return str(rng.choice([
            f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}",
            f"00{country} {d[:2]} {d[2:9]}", f"00{country}{d}", f"0{d[:3]}/{d[3:9]}", f"(0{d[:2]}) {d[2:5]} {d[5:]}",
        ]))
    return item


def _plain_number(rng: np.random.Generator) -> str:
    """A number that is nobody's."""
    n = lambda low, high: str(rng.integers(low, high))
    return str(rng.choice([
        f"{n(1900, 2030)}-{n(10, 13)}-{n(10, 29)}", f"{n(1, 29)}/{n(1, 13)}/{n(1990, 2030)}", f"{n(0, 24)}:{n(10, 60)}", f"{n(0, 10**6)}.{n(0, 100)}",
        f"{n(1, 999)},{n(100, 999)},{n(100, 999)}", n(10**5, 10**7), n(10**8, 10**12), f"v{n(0, 9)}.{n(0, 20)}.{n(0, 9)}", f"{n(1900, 2000)}-{n(2000, 2030)}",
        f"{n(1, 100)}%", f"#{n(10**3, 10**9)}", f"{n(1000, 9999)} {n(1000, 9999)}", n(10**15, 10**16),
    ]))


def training_windows(examples: list[tuple[str, list[Span]]], seed: int = 23) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of the examples, and of others in which two or three whole spans stand next to each other, some
    in other shapes, with numbers between them that are no personal data."""
    rng = np.random.default_rng(seed)
    whole = [(text[a:b], kind) for text, spans in examples for a, b, kind in spans if a >= 0 and b < len(text)]
    rows = [(text, spans) for text, spans in examples]
    by_kind = [[t for t, k in whole if k == kind] for kind in range(len(KINDS))]
    present = [k for k in range(len(KINDS)) if by_kind[k]]
    for text, _ in list(examples) if present else []:
        # words around without telltales, then two or three spans with a space between
        words = [w for w in text.split(" ") if not TELLTALE.search(w) and "(" not in w]
        made, spans = " ".join(words[: int(rng.integers(0, 8))])[:40], []
        made += " " * bool(made)
        for _ in range(int(rng.integers(2, 4))):
            kind = int(rng.choice(present))
            item = by_kind[kind][int(rng.integers(len(by_kind[kind])))]
            if kind != 1 and rng.random() < 0.5:
                item = _varied(item, kind, rng)
            if kind and rng.random() < 0.4:
                item = _reshaped(item, kind, rng)
            if rng.random() < 0.4:
                made += _plain_number(rng) + " "
            spans.append((len(made), len(made) + len(item), kind))
            made += item + " "
        made += " ".join(words[8:])
        rows.append((made[:WINDOW], [(a, min(b, WINDOW), k) for a, b, k in spans if a < WINDOW]))
    x, y = np.full((len(rows), WINDOW), 95), np.zeros((len(rows), WINDOW), np.int64)
    for i, (text, spans) in enumerate(rows):
        symbols = characters(text)[:WINDOW]
        x[i, : len(symbols)] = symbols
        y[i, : len(symbols)] = tags(len(symbols), spans)
    return x, y


def fit_tagger(docs: DataFrame, windows: int = 3000, steps: int = 300) -> Tagger:
    """Train on at most ``windows`` windows of text (a few hundred KB on the driver), two thirds with spans."""
    found = map_batches(whole_texts(docs), _examples(), "h long, found boolean, text string, spans string")
    rows = []
    for wanted, n in ((True, 2 * windows // 3), (False, windows // 3)):
        # of equal windows always the same one, so that a task that runs twice gives the same model
        one = found.where(F.col("found") == wanted).groupBy("text").agg(F.min(F.struct("h", "spans")).alias("first"))
        rows += one.select("text", "first.*").orderBy("h", "text").limit(n).collect()
    examples = [(r["text"], [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]) for r in rows]
    return Tagger().fit(*training_windows(examples), steps=steps)


def _spans_of_texts(model: Tagger, texts: list[str], at_once: int = 1000) -> list[tuple[list[Span], list[Span]]]:
    results: list = [([], [])] * len(texts)
    telling = [i for i, t in enumerate(texts) if TELLTALE.search(t)]
    for at in range(0, len(telling), at_once):
        part = telling[at : at + at_once]
        for i, found in zip(part, all_spans(model, [texts[i] for i in part])):
            results[i] = found
    return results


def find_personal_data(docs: DataFrame, model: Tagger) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone (base spans), n_added, base_sha256 and spans (all, in code
    points). One pass without a shuffle; rows and other columns stay. A NULL text counts as empty and has no spans.
    Texts of any length are read whole, in windows only where they have a digit or an at sign. Of spans of one kind the
    leftmost counts; where spans of two kinds begin together, ``spans`` has them in the order of the kinds."""
    added = [*(f"n_{k}" for k in KINDS), "n_added", "base_sha256", "spans"]
    docs = docs.drop(*added)
    names = docs.columns

    def find(batches: Batches) -> Batches:
        for batch in batches:
            results = _spans_of_texts(model, [t or "" for t in batch.column("text").to_pylist()])
            counts = [[sum(s[2] == k for s in base) for base, _ in results] for k in range(len(KINDS))]
            columns = [
                *counts, [len(more) for _, more in results],
                [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in results], [joined(base + more) for base, more in results],
            ]
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(columns, kinds))], [*names, *added])

    kinds = [T.LongType()] * 5 + [T.StringType()] * 2
    return map_batches(docs, find, T.StructType([*docs.schema.fields, *map(T.StructField, added, kinds)]))


def masked(text: str, spans: str) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans, the one that starts first."""
    out, at = [], 0
    for span in spans.split(",") if spans else []:
        kind, a, b = span.split(":")
        if int(a) >= at:
            out += [text[at : int(a)], f"[{kind}]"]
        else:
            out += [] if int(b) <= at else [f"[{kind}]"]
        at = max(at, int(b))
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, model: Tagger | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind, columns as before; ``n_chars`` follows the text."""
    names = docs.columns
    tagger = model or fit_tagger(docs)

    def mask(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = _spans_of_texts(tagger, [t or "" for t in texts])
            texts = [masked(t, joined(base + more)) if base or more else t for t, (base, more) in zip(texts, found)]
            columns = {n: batch.column(n) for n in names} | {"text": pa.array(texts, pa.string())}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return map_batches(docs, mask, docs.schema)
