"""Personal data: exact patterns, and a semi-Markov conditional random field that adds what the patterns miss.

The field scores whole candidate segments (digits, separators, checksum, words before), and dynamic programming over
segments of bounded length picks boundaries and kinds jointly. It finds what it would find in the whole text between the
patterns' matches, but looks only where a candidate can be, so plain prose costs one scan. It is trained here, on sentences from a seeded rule.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow_pass, rows_pass

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A failed start inside a run of digits fails as the run's first digit did, and a match ends where its run ends.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if k % 2:
            v = 2 * v - 9 * (v > 4)
        total += v
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @: the local part is all of the run before it that no match has used."""
    used, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > used and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            used = found.end()
            yield start, used
        at = text.find("@", used if found else at + 1)


def base_spans(text: str) -> list[Span]:
    """Matches of the four patterns that pass their checks, by start, then kind."""
    out: list[Span] = [(a, b, "email") for a, b in _emails(text)]
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    if "+" in text:
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# The field

LABELS = ("O", *KINDS)
#: Tokens of an entity at most, signs among them, and digits: a card has 19 at most.
LONGEST, MOST_DIGITS = 18, 19
#: Tokens that the field sees before and after what a candidate can be part of: three words of context, and one token outside.
BEFORE, AFTER = LONGEST + 3, LONGEST + 1
_TOKEN = re.compile(r"[^\W0-9_]+|[0-9]+|[^\w\s]|_")
#: What every candidate of digits lies in, but for signs before it, and the sign or word that every candidate of letters holds.
_NUMBERS = re.compile(r"[0-9](?:[0-9\s+().\-/_\[\]]|dot|DOT)*+")
_AT = re.compile(r"@|(?<![^\W0-9_])(?:at|AT)(?![^\W0-9_])")
_DOT = re.compile(r"\.|dot|DOT")
_CUES = {
    "phone": frozenset("phone tel telephone call mobile cell fax sms dial whatsapp".split()),
    "card": frozenset("card visa mastercard amex credit debit pay payment".split()),
    "email": frozenset("email mail contact write reach address".split()),
    "ip": frozenset("ip host server addr from ping".split()),
}
_NORTH = re.compile(r"\(?\d{3}\)?[ .-]{1,2}\d{3}[ .-]\d{4}")
_ATS, _DOTS = frozenset(("@", "at", "AT")), frozenset((".", "dot", "DOT"))
#: What may stand between the digits of an entity.
_JOINS = frozenset(("+", "(", ")", ".", "-", "/", "_", "[", "]", "dot", "DOT"))
_SHAPE = str.maketrans("123456789", "000000000")
#: Scores of shapes and features that a model remembers, and characters of a shape.
REMEMBERED, SHAPE = 100_000, 64
_TLD = frozenset("com org net edu gov io de fr es uk co info".split())


class Tokens:
    """Tokens of a stretch of text, with sums that make each segment's features cheap."""

    def __init__(self, text: str, start: int, end: int):
        self.text = text
        self.spans = [m.span() for m in _TOKEN.finditer(text, start, end)]
        self.words = [text[a:b] for a, b in self.spans]
        self.types = ["d" if w[0] in "0123456789" else "a" if w[0].isalpha() else "p" for w in self.words]
        self.start, self.form, self.cued = start, text[start:end].translate(_SHAPE), {}
        self.digits, self.numbers = [0], [0]
        for w, t in zip(self.words, self.types, strict=True):
            self.digits.append(self.digits[-1] + len(w) * (t == "d"))
            self.numbers.append(self.numbers[-1] + (t == "d"))
        #: Whether a spelled-out address can be here at all.
        self.addresses = not _ATS.isdisjoint(self.words) and not _DOTS.isdisjoint(self.words)

    def glued(self, i: int) -> bool:
        """Whether letters or digits run over the boundary before token i."""
        if not 0 < i < len(self.spans):
            return False
        return self.spans[i - 1][1] == self.spans[i][0] and "p" not in (self.types[i - 1], self.types[i])

    def four_bytes(self, i: int, j: int) -> bool:
        """Whether the numbers among tokens i to j - 1 are four bytes with dots between."""
        if self.numbers[j] - self.numbers[i] != 4:
            return False
        groups = [w for w, t in zip(self.words[i:j], self.types[i:j], strict=True) if t == "d"]
        return all(map(_byte, groups)) and sum(w in _DOTS for w in self.words[i:j]) >= 3

    def ending(self, j: int) -> list[int]:
        """Starts of the candidates that end with token j - 1, nearest first: enough digits and no words between, or an at sign
        and a dot in the midst of letters."""
        words, types, digits, out = self.words, self.types, self.digits, []
        if types[j - 1] == "d":
            for i in range(j - 1, max(-1, j - LONGEST - 1), -1):
                n = digits[j] - digits[i]
                if n > MOST_DIGITS or not (types[i] == "d" or words[i] in _JOINS):
                    break
                if (types[i] == "d" or words[i] in ("+", "(")) and (n >= 7 or n >= 4 and self.four_bytes(i, j)):
                    out.append(i)
        elif types[j - 1] == "a" and self.addresses:
            at = dot = False
            for i in range(j - 3, max(-1, j - LONGEST - 1), -1):
                inner = words[i + 1]
                if types[i + 1] == "p" and inner not in ".-_@()[]{}<>":
                    break
                at |= inner in _ATS
                dot |= inner in _DOTS
                if at and dot and types[i] != "p":
                    out.append(i)
        return out

    def candidate(self, i: int, j: int) -> bool:
        """Whether tokens i to j - 1 can be an entity."""
        return i in self.ending(j)

    def shape(self, i: int, j: int) -> tuple | None:
        """All that features() depends on, digits but for leading zeros left out; None for segments with letters."""
        if "a" in self.types[i:j]:
            return None
        a, b = self.spans[i][0], self.spans[j - 1][1]
        form, n = self.form[a - self.start : b - self.start], self.digits[j] - self.digits[i]
        if len(form) > SHAPE:
            return None
        text = self.text
        zeros = 0 if text[a] != "0" else 1 if text[a + 1 : a + 2] != "0" else 2
        check = luhn(_digits(text[a:b])) if 12 <= n <= 19 else None
        return form, zeros, check, self.four_bytes(i, j), self.glued(i) or self.glued(j), self.cues(i), self.more(j), self.less(i)

    def cues(self, i: int) -> tuple[str, ...]:
        """Kinds that the three words before token i speak of."""
        if (found := self.cued.get(i)) is None:
            before = [w.lower() for w in self.words[max(0, i - 3) : i]]
            found = self.cued[i] = tuple(kind for kind, cues in _CUES.items() if any(w in cues for w in before))
        return found

    def more(self, j: int) -> bool:
        """Whether digits follow at once."""
        return j < len(self.words) and self.types[j] == "d" and self.spans[j][0] - self.spans[j - 1][1] <= 1

    def less(self, i: int) -> bool:
        """Whether digits come right before."""
        return i > 0 and self.types[i - 1] == "d" and self.spans[i][0] - self.spans[i - 1][1] <= 1

    def features(self, i: int, j: int) -> tuple[str, ...]:
        """Of the whole segment."""
        text = self.text[self.spans[i][0] : self.spans[j - 1][1]]
        words, types, digits = self.words[i:j], self.types[i:j], _digits(text)
        n, out = len(digits), ["bias"]
        out.append(f"digits{n if n < 20 else 20}" if "a" not in types else "letters")
        if "a" not in types:
            seps = {c for c in text if not "0" <= c <= "9"}
            out.append("seps" + ("none" if not seps else "".join(sorted(seps)) if len(seps) == 1 else "paren" if "(" in seps else "mixed"))
            out.append("sizes" + "-".join(str(len(w)) for w, t in zip(words, types, strict=True) if t == "d"))
            if 12 <= n <= 19:
                out.append("luhn" if luhn(digits) else "noluhn")
            if _NORTH.fullmatch(text):
                out.append("north")
        if words[0] == "+" or text.startswith("00"):
            out.append("plus")
        elif text.startswith("0"):
            out.append("zero")
        if self.four_bytes(i, j):
            out.append("bytes")
        numbers = [k for k in range(i, j) if self.types[k] == "d"]
        joins = {self.text[self.spans[a][1] : self.spans[b][0]] for a, b in zip(numbers, numbers[1:], strict=False)}
        if len(joins) == 1 and "a" not in types:
            out.append(f"join{joins.pop()[:4]}")
        if "a" in types:
            ats = [k for k, w in enumerate(words) if w in _ATS]
            dots = [k for k, w in enumerate(words) if w in _DOTS]
            out.append(f"ats{min(len(ats), 2)}")
            if ats and dots and dots[-1] > ats[0]:
                out.append("tld" if words[-1].lower() in _TLD else "notld")
                bracket = any(k and words[k - 1] in "[({<" for k in ats)
                spoken = any(words[k] in ("dot", "DOT") for k in dots if k > ats[0])
                out.append(f"at{'bracket' if bracket else 'plain'}{'spoken' if spoken else 'sign'}")
                gaps = sum(self.spans[k][1] < self.spans[k + 1][0] for k in range(i, j - 1))
                want = sum(w in ("at", "AT", "dot", "DOT") for w in words) * 2
                out.append("stray" if gaps > want else "tight")
        if self.glued(i) or self.glued(j):
            out.append("glued")
        out += [f"cue-{kind}" for kind in self.cues(i)]
        if self.more(j):
            out.append("more")
        if self.less(i):
            out.append("less")
        return tuple(out)

    def outside(self, j: int) -> tuple[str, ...]:
        """Features of the lone token j - 1 outside of entities."""
        return (f"type-{self.types[j - 1]}",)

    def segments(self) -> list[list[tuple[int, str, tuple[str, ...]]]]:
        """By end: start, label and features of the segments that may end there; a lone token may always be outside."""
        out: list = [[]]
        for j in range(1, len(self.words) + 1):
            here = [(j - 1, "O", self.outside(j))]
            for i in self.ending(j):
                feats = self.features(i, j)
                here += [(i, kind, feats) for kind in KINDS]
            out.append(here)
        return out


def _sum(values: list[float]) -> float:
    top = max(values)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


class SemiCrf:
    """Weights by (label, feature) and (label before, label)."""

    def __init__(self) -> None:
        self.w: dict = defaultdict(float)
        self.known: dict[tuple, tuple[float, ...]] = {}

    def score(self, label: str, feats: tuple[str, ...]) -> float:
        return sum(self.w.get((label, f), 0.0) for f in feats)

    def gradient(self, segments: list, gold: dict[tuple[int, int], str]) -> dict:
        """Of the log-likelihood of the segmentation that has `gold` as its entities: counts seen minus counts expected."""
        n, grad = len(segments) - 1, defaultdict(float)
        fwd = [dict.fromkeys(LABELS, -math.inf) for _ in range(n + 1)]
        back = [dict.fromkeys(LABELS, -math.inf) for _ in range(n + 1)]
        fwd[0]["O"] = 0.0
        arcs = []
        for j in range(1, n + 1):
            into = defaultdict(list)
            for i, y, feats in segments[j]:
                score = self.score(y, feats)
                enter = _sum([fwd[i][x] + self.w.get((x, y), 0.0) for x in LABELS])
                into[y].append(enter + score)
                arcs.append((i, j, y, feats, score, enter))
            for y, values in into.items():
                fwd[j][y] = _sum(values)
        for y in LABELS:
            back[n][y] = 0.0
        total = _sum(list(fwd[n].values()))
        leaving = defaultdict(list)
        for arc in arcs:
            leaving[arc[0]].append(arc)
        for i in range(n - 1, -1, -1):
            for x in LABELS:
                back[i][x] = _sum([self.w.get((x, y), 0.0) + score + back[j][y] for _, j, y, _, score, _ in leaving[i]] or [-math.inf])
        for i, j, y, feats, score, enter in arcs:
            if (p := math.exp(enter + score + back[j][y] - total)) > 1e-6:
                for f in feats:
                    grad[y, f] -= p
                for x in LABELS:
                    if (q := math.exp(fwd[i][x] + self.w.get((x, y), 0.0) + score + back[j][y] - total)) > 1e-6:
                        grad[x, y] -= q
        j, before, starts = 0, "O", {a: (b, y) for (a, b), y in gold.items()}
        while j < n:
            end, y = starts.get(j, (j + 1, "O"))
            feats = next(f for i, label, f in segments[end] if i == j and label == y)
            for f in feats:
                grad[y, f] += 1
            grad[before, y] += 1
            j, before = end, y
        return grad

    def decode(self, segments: list[list[tuple[int, str, float]]]) -> list[tuple[int, int, str]]:
        """Entities (token start, token end, kind) of the best segmentation of (start, label, score) lists by end; ties go to the
        first found, outside before inside."""
        n = len(segments) - 1
        best: list[dict[str, tuple[float, tuple | None]]] = [{"O": (0.0, None)}]
        for j in range(1, n + 1):
            here: dict[str, tuple[float, tuple | None]] = {}
            for i, y, score in segments[j]:
                x, value = max(((x, v[0] + self.w.get((x, y), 0.0)) for x, v in best[i].items()), key=lambda p: p[1])
                value += score
                if y not in here or value > here[y][0]:
                    here[y] = value, (i, x)
            best.append(here)
        y, out, j = max(best[n], key=lambda k: best[n][k][0]), [], n
        while j:
            i, x = best[j][y][1]
            if y != "O":
                out.append((i, j, y))
            j, y = i, x
        return out[::-1]

    def kinds(self, tokens: Tokens, i: int, j: int) -> tuple[float, ...]:
        """Scores of the segment as each kind; those of shapes, or else of features, seen before are remembered."""
        shape = tokens.shape(i, j)
        if shape is not None and (found := self.known.get(shape)) is not None:
            return found
        feats = tokens.features(i, j)
        if (found := self.known.get(feats)) is None:
            found = tuple(self.score(kind, feats) for kind in KINDS)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[feats if shape is None else shape] = found
        return found

    def edge(self, kind: str) -> float:
        """The most that transitions into and out of a kind can be better than those into and out of a token outside."""
        w = lambda x, y: self.w.get((x, y), 0.0)
        return max(w(x, kind) - w(x, "O") for x in LABELS) + max(0.0, *(w(kind, y) - w("O", y) for y in LABELS))

    def entities(self, tokens: Tokens) -> list[tuple[int, int, str]]:
        """decode() of all segments of the tokens, on the parts alone where an entity can be.

        A segment that is worth less than its tokens outside, even with the best transitions, is in no best segmentation:
        putting its tokens outside would be better. Between the segments that are left all tokens are outside, so that each
        run of overlapping ones is decoded by itself, with one token outside after it.
        """
        n, away = len(tokens.words), self.w.get(("O", "O"), 0.0)
        free = {t: self.score("O", (f"type-{t}",)) for t in "dap"}
        outside = [0.0]
        for t in tokens.types:
            outside.append(outside[-1] + free[t] + away)
        edges = [self.edge(kind) for kind in KINDS]
        left: dict[int, list[tuple[int, str, float]]] = {}
        for j in range(1, n + 1):
            for i in tokens.ending(j):
                least = outside[j] - outside[i] - away - 1e-9
                for kind, score, edge in zip(KINDS, self.kinds(tokens, i, j), edges, strict=True):
                    if score + edge >= least:
                        left.setdefault(j, []).append((i, kind, score))
        runs: list[list[int]] = []
        for j in sorted(left, key=lambda j: min(i for i, _, _ in left[j])):
            i = min(i for i, _, _ in left[j])
            if runs and i <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], j)
            else:
                runs.append([i, j])
        out = []
        for a, b in runs:
            end = min(b + 1, n)
            segments = [[]] + [[(j - 1 - a, "O", free[tokens.types[j - 1]]), *((i - a, kind, score) for i, kind, score in left.get(j, ()) if i >= a)] for j in range(a + 1, end + 1)]
            out += [(i + a, j + a, kind) for i, j, kind in self.decode(segments)]
        return out


def _sentence(rng: random.Random) -> tuple[str, list[Span]]:
    """A sentence of invented words with entities in unusual spellings, or with look-alikes that are none."""
    vowels, consonants = "aeiou", "bdfgklmnprst"
    word = lambda: "".join(rng.choice(consonants) + rng.choice(vowels) for _ in range(rng.randint(1, 3)))
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card() -> str:
        d = rng.choice("3456") + num(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return rng.choice([".", "  ", " . ", "_", "/"]).join(d[k : k + 4] for k in range(0, 16, 4))

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{num(2)} {a} {b}{c}", f"({a}) {b} {c}", f"00{num(2)}-{num(3)}-{num(7)}", *(sep.join(["0" + rng.choice("123456789"), *(num(2) for _ in range(4))]) for sep in (" ", " ", "-"))])

    def email() -> str:
        at, dot = rng.choice([(" at ", " dot "), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" AT ", " DOT "), (" [at] ", "."), ("(at)", "."), (" at ", ".")])
        return word() + rng.choice(["", num(2), "." + word()]) + at + word() + dot + rng.choice(["com", "org", "net", "de", "fr", "io"])

    def ip() -> str:
        return rng.choice([" dot ", "[.]", "(.)", " . ", "[dot]"]).join(str(rng.choice([rng.randint(0, 255), rng.randint(0, 15)])) for _ in range(4))

    def other() -> str:
        bad = rng.choice("3456") + num(14)
        bad += next(c for c in "0123456789" if not luhn(bad + c))
        hexes = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 32, 40])))
        return rng.choice([
            f"{num(4)}-{num(2)}-{num(2)}", f"{num(2)}/{num(2)}/{num(4)}", f"{num(4)}-{num(2)}-{num(2)} {num(2)}:{num(2)}:{num(2)}", hexes, f"password={hexes[:18]}", "AKIA" + hexes[:16].upper(), f"v{num(1)}.{num(2)}.{num(3)}",
            num(8), num(10), num(rng.randint(7, 24)), bad, " ".join(num(rng.randint(1, 3)) for _ in range(6)), f"{num(3)},{num(3)},{num(3)}", f"{num(5)}.{num(5)}", f"{num(2)}.{num(2)}.{num(4)}", f"{num(4)} {num(4)} {num(4)}", f"{num(3)} - {num(5)}",
            f"{word()} at {word()} on dot {word()}", f"{word()} (at) {word()}", f"at the dot {word()}", f"{word()} at {word()} . {word()}", f"{num(9)}-{num(1)}", " | ".join(num(4) for _ in range(5)), ", ".join(num(4) for _ in range(4)),
            ". ".join("1234"), ", ".join(num(2) for _ in range(5)), " ".join(rng.choice("123456789") + num(1) for _ in range(5)), f"{word()} at {word()}.{word()}", f"{word()} at {word()}. {word()}", f"at {num(2)}.{num(1)}. {word()}",
        ])

    cues = {"card": ["card", "visa", "card number"], "phone": ["phone", "call", "tel"], "email": ["mail", "contact"], "ip": ["host", "ip"]}
    text, spans = " ".join(word() for _ in range(rng.randint(1, 4))) + " ", []
    for _ in range(rng.randint(1, 2)):
        kind = rng.choice([*KINDS, "run-on", "O", "O", "O", "O"])
        if kind == "O":
            text += other()
        elif kind == "run-on":  # a number right after another, which the patterns take for one that is too long
            for made, of in ((f"+{num(1)} ({num(3)}) {num(3)}-{num(4)}", "phone"), (card().translate(str.maketrans("", "", "._/ ")), "card")):
                spans.append((len(text), len(text) + len(made), of))
                text += made + " "
        else:
            text += f"{rng.choice(cues[kind])}{rng.choice([': ', ' '])}" if rng.random() < 0.5 else ""
            made = {"card": card, "phone": phone, "email": email, "ip": ip}[kind]()
            spans.append((len(text), len(text) + len(made), kind))
            text += made
        text += rng.choice([" ", ". ", ", "]) + " ".join(word() for _ in range(rng.randint(1, 3))) + " "
    return text, spans


@lru_cache(maxsize=1)
def trained(sentences: int = 500, epochs: int = 4, seed: int = 7) -> SemiCrf:
    """The field after AdaGrad ascent on the likelihood of `sentences` made-up sentences."""
    rng, model, seen = random.Random(seed), SemiCrf(), defaultdict(float)
    examples = []
    for _ in range(sentences):
        text, spans = _sentence(rng)
        tokens = Tokens(text, 0, len(text))
        starts, ends = {a: k for k, (a, _) in enumerate(tokens.spans)}, {b: k + 1 for k, (_, b) in enumerate(tokens.spans)}
        gold = {(starts[a], ends[b]): kind for a, b, kind in spans if a in starts and b in ends}
        if len(gold) < len(spans) or not all(tokens.candidate(i, j) and j - i <= LONGEST for i, j in gold):
            raise ValueError(f"an entity of a training sentence is no candidate: {text!r}")
        examples.append((tokens.segments(), gold))
    for _ in range(epochs):
        for segments, gold in examples:
            for key, g in model.gradient(segments, gold).items():
                g -= 0.002 * model.w[key]
                seen[key] += g * g
                model.w[key] += 0.4 * g / math.sqrt(seen[key] + 1e-6)
    model.w = dict(model.w)
    return model


def _step(found: Iterator[re.Match], tokens: int, at: int) -> int:
    """End of so many matches, or of all where there are fewer."""
    for m, _ in zip(found, range(tokens), strict=False):
        at = m.end()
    return at


def stretches(text: str) -> list[list[int]]:
    """Parts of a text that hold all candidates of the field and what it looks at around them; they start and end with tokens.

    Every candidate of digits lies in a run of digits, joins and blanks with four digits or more, every other one around an
    "at" near a dot. From there a part goes on by tokens, however long these are, in both directions.
    """
    marks = [(*m.span(), False) for m in _NUMBERS.finditer(text) if m.end() - m.start() >= 4 and len(_digits(m.group())) >= 4]
    marks += [(*m.span(), True) for m in _AT.finditer(text)]
    if not marks:
        return []
    out: list[list[int]] = []
    n, back = len(text), text[::-1]  # tokens read backwards are the same tokens
    for start, end, spoken in sorted(marks):
        a = n - _step(_TOKEN.finditer(back, n - start), BEFORE, n - start)
        b = _step(_TOKEN.finditer(text, end), AFTER, end)
        if spoken and not _DOT.search(text, a, b):
            continue
        if out and a <= out[-1][1]:
            out[-1][0], out[-1][1] = min(a, out[-1][0]), max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def added_spans(text: str, base: list[Span], model: SemiCrf) -> list[Span]:
    """Entities of the field between base spans: what it finds in each whole gap, looked for in the parts where anything can be."""
    gaps, last = [], 0
    for a, b, _ in base:
        if a > last:
            gaps.append((last, a))
        last = max(last, b)
    out = []
    for low, high in [*gaps, (last, len(text))]:
        gap = text[low:high]
        for a, b in stretches(gap):
            tokens = Tokens(gap, a, b)
            out += [(low + tokens.spans[i][0], low + tokens.spans[j - 1][1], kind) for i, j, kind in model.entities(tokens)]
    return out


def all_spans(text: str, model: SemiCrf) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, each by start, then kind."""
    base = base_spans(text)
    more = added_spans(text, base, model)
    return base, sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]))) if more else base


def listed(spans: list[Span]) -> str:
    """kind:start:end, comma-joined; offsets in code points, end exclusive."""
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first, in angle brackets."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def find_pii(docs: DataFrame, *keep: str, text: str = "text", redact: bool = False) -> DataFrame:
    """One row per document: `keep`, counts of base spans by kind, base_sha256, spans, and with `redact` the redacted text.

    A null text is empty: no spans (and stays null when redacted). Each row is judged alone; one pass without a shuffle,
    linear in the text's length. The field is trained on the driver and travels with the tasks: a few hundred weights.
    """
    model = trained()

    def find(value: str | None) -> tuple:
        base, every = all_spans(value or "", model)
        n = [sum(kind == k for _, _, kind in base) for k in KINDS]
        row = (*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(every))
        return (*row, value if value is None else redacted(value, every)) if redact else row

    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"] + ["redacted"] * redact
    types = [pa.int64()] * 4 + [pa.string()] * (2 + redact)
    plain = docs.select(*(F.col(c) for c in keep), F.col(text).alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema[:-1]), *(f"{n} {'long' if t == pa.int64() else 'string'}" for n, t in zip(names, types, strict=True))])
    return arrow_pass(plain, rows_pass(find, names, types, len(keep)), schema)
