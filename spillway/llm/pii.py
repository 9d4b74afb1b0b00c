"""Personal data: fixed rules, and a linear-chain conditional random field that adds spans.

The rules (``base_spans``) are patterns with checks. The field labels white-space
separated words O, B-kind or I-kind from word shapes of a word and its neighbours;
it is trained on a small labelled table (``labelled_table``) of templates filled by
rule. Its spans are added where they don't overlap a rule's span.

Decoding is exact and mostly skipped. A span on the best path gains over labelling
its words O. What a word can add to such a gain is bounded by its scores and the best
transitions around it; words that are in no stretch with a positive bound are O. What
remains are short runs, which advance together by length through Viterbi.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spillway.llm.common import arrow_map

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
#: Words whose features a worker remembers.
KEPT = 1 << 18

# Fixed patterns of the rules.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a match can't begin inside a run of digits
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = (ord(c) - 48) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, 0, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that pass their check, as (start, kind, end), sorted."""
    out = emails(text)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x) <= 3 and int(x) <= 255 for x in (p.lstrip("0") or "0" for p in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


# Words whose spelling counts, besides their shape.
_TOLD = frozenset("at dot call phone tel fax mobile mail email e-mail contact write ip host server address card visa pay number gateway ring".split())
_RUN = re.compile(r"[a-zß-öø-ÿ]+|[A-ZÀ-ÖØ-Þ]+|[0-9]+|\s+")
_LEFT, _RIGHT = ",;:.!?\"'<>{}*%&$#|=-", ",;:.!?\"'<>{}*%&$#|=-"
_AT = re.compile(r"[(\[{]at[)\]}]")


def bared(word: str) -> str:
    """A word without the punctuation around it."""
    return word.lstrip(_LEFT).rstrip(_RIGHT)


def shape(word: str) -> str:
    """Letters as x or X, digits as their number, up to 20 characters."""
    return _RUN.sub(lambda m: f"{min(len(m[0]), 6)}" if m[0][0].isdigit() else "x" if m[0].islower() else "X", word[:64])[:20]


def look(word: str) -> str:
    """What features are taken from: words of equal looks have equal features. Plain words of letters have few looks."""
    bare = bared(word)
    if bare.isalpha():
        low = bare.lower()
        bare = low if low in _TOLD else "x" if bare == low else "X" if bare.isupper() else "Xx"
    return bare + (",;" if word[-1:] in ",;:.!?" else "")


def own_features(word: str) -> list[str]:
    bare = bared(word)
    digits, low = sum(c.isdigit() for c in bare), bare.lower()
    return [
        f"s={shape(bare)}", f"n={min(digits, 8) if digits < 12 else 12}", f"w={low if low in _TOLD else '-'}", f"@={'@' in bare}", f".={min(bare.count('.'), 4)}",
        f"-={min(bare.count('-'), 4)}", f"x={any(c.isalpha() for c in bare)}", f"e={word[-1:] in ',;:.!?'}", f"+={bare[:1] == '+'}", f"p={'(' in bare}",
        f"at={_AT.search(low) is not None}",
    ]


def near_features(word: str) -> list[str]:
    bare = bared(word)
    digits, low = sum(c.isdigit() for c in bare), bare.lower()
    return [f"w={low if low in _TOLD else '-'}", f"d={min(digits, 5) if bare and digits == len(bare) else '-'}", f"m={0 < digits < len(bare)}"]


def labelled_table(rows: int = 400, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """Sentences of (words, labels): personal data in forms that the rules don't reach, and numbers that are none."""
    r = np.random.default_rng(seed)
    num = lambda n: "".join(map(str, r.integers(0, 10, n)))
    made = lambda: "".join(r.choice(list("abcdefghijklmnoprstuvwéñö"), r.integers(2, 9)))
    cased = lambda w: [w, w.capitalize(), w.upper()][r.choice(3, p=[0.7, 0.25, 0.05])]
    end = lambda: r.choice(["", "", "", ",", "."])

    def email():
        user, host, top = made() + r.choice(["", "." + made(), num(2)]), made(), r.choice(["com", "org", "net", "example", "fr", "de"])
        return [[f"{user}", "at", f"{host}", "dot", top], [f"{user}(at){host}.{top}"], [f"{user}[at]{host}.{top}"], [user, "@", f"{host}.{top}"], [f"{user}", "(at)", f"{host}.{top}"]][r.integers(5)]

    def phone():
        return [[f"{num(3)}-{num(3)}-{num(4)}"], [f"({num(3)})", f"{num(3)}-{num(4)}"], [num(3), num(3), num(4)], [f"{num(3)}.{num(3)}.{num(4)}"], [f"0{num(4)}", num(6)], [f"0{num(1)}", num(2), num(2), num(2), num(2)]][r.integers(6)]

    def ip():
        a = [str(x) for x in r.integers(0, 256, 4)]
        return [["[" + ".".join(a) + "]:" + num(4)], [a[0], "dot", a[1], "dot", a[2], "dot", a[3]], ["(.)".join(a)]][r.integers(3)]

    def card():
        return [[num(4), num(4), num(4), num(4)], [".".join(num(4) for _ in range(4))], ["/".join(num(4) for _ in range(4))]][r.integers(3)]

    cue = {"email": ["mail", "email", "contact", "write"], "phone": ["call", "phone", "tel", "ring", "mobile"], "ip": ["ip", "host", "server", "address"], "card": ["card", "visa", "pay"]}

    def other():
        return [[num(4)], [num(r.integers(1, 4))], [num(2), made()], [f"{num(1)}.{num(1)}.{num(1)}"], [f"{num(1)},{num(3)}"], [num(4) + "-" + num(2) + "-" + num(2)], ["token", "=", '"' + num(3) + made() + num(5) + made() + '"'],
                [made() + "=" + made() + num(6)], ["#" + num(5)], [num(r.integers(5, 20))], ["v" + num(1) + "." + num(2)], [made() + num(2)], [num(2) + ":" + num(2)], ["http://" + made() + ".example.net/" + num(3)], ["at"], ["dot"], [num(2) + "%"],
                [made() + "." + num(2) + "@" + made() + ".com"], [".".join(str(x) for x in r.integers(0, 256, 4))], ["+" + num(2), num(3), num(7)], [num(16)], [made() + r.choice(list("!*%&$#")) * 3],
                [made(), r.choice(list("|=&-*")), made(), "|"], [r.choice(["|", "=", "###", "***", "--", "&", "()", "[x]", "{"])]][r.integers(24)]

    out = []
    for _ in range(rows):
        words, labels = [], []

        def say(more, kind=None):
            if kind:
                more = [*more[:-1], more[-1] + end()]
            words.extend(more)
            labels.extend(["O"] * len(more) if kind is None else [f"B-{kind}"] + [f"I-{kind}"] * (len(more) - 1))

        for _ in range(r.integers(1, 4)):
            say([cased(made()) + end() for _ in range(r.integers(1, 8))])
            if r.random() < 0.55:
                kind = KINDS[r.integers(4)]
                if kind in ("card", "ip") or r.random() < 0.7:
                    say([cased(r.choice(cue[kind])) + r.choice(["", ":"])])
                say({"email": email, "phone": phone, "ip": ip, "card": card}[kind](), kind)
            else:
                say(other())
        say([cased(made()) + end() for _ in range(r.integers(0, 5))])
        out.append((words, labels))
    return out


@dataclass
class Field:
    """Weights by feature for a word and its neighbours, and of transitions (from, to)."""

    index: dict[str, int]
    own: np.ndarray
    moves: np.ndarray
    kept: dict[str, int] = field(default_factory=dict)
    looks: dict[str, int] = field(default_factory=dict)
    tables: np.ndarray | None = None

    @property
    def moves_gain(self) -> tuple[np.ndarray, float]:
        """The most that entering a label, and leaving a span, can add over staying at O."""
        m = self.moves
        return m.max(axis=0)[1:] - m[0, 0], max(0.0, float(m[1:, 0].max() - m[0, 0]))

    def open_words(self, e: np.ndarray) -> np.ndarray:
        """Words that may be in a span on the best path."""
        enter, leave = self.moves_gain
        most = (e[:, 1:] - e[:, :1] + enter).max(axis=1)
        if not (most + leave > 0).any():
            return np.zeros(len(e), bool)
        left = best_end(most)
        right = best_end(most[::-1])[::-1]
        return left + right - most + leave > 0

    def emissions(self, words: list[str]) -> np.ndarray:
        """(word, label) scores."""
        if len(self.kept) > KEPT or self.tables is None:
            self.kept, self.looks, self.tables = {}, {}, np.zeros((1, 3, len(LABELS)))  # row 0: no word
        for w in [w for w in {*words} if w not in self.kept]:
            seen = look(w)
            if seen not in self.looks:
                self.looks[seen] = len(self.looks) + 1
                self.tables = np.concatenate([self.tables, self.row(seen)[None]])
            self.kept[w] = self.looks[seen]
        at = np.fromiter(map(self.kept.__getitem__, words), np.int64, len(words))
        out = self.tables[at, 0].copy()
        out[1:] += self.tables[at[:-1], 1]
        out[:-1] += self.tables[at[1:], 2]
        return out

    def row(self, word: str) -> np.ndarray:
        return np.stack([self.own[ids(self.index, where, f(word))].sum(axis=0) for where, f in PARTS])


PARTS = (("", own_features), ("<", near_features), (">", near_features))


_ILLEGAL = -1e4


def ids(index: dict[str, int], where: str, features: list[str]) -> list[int]:
    return [index[where + f] for f in features if where + f in index]


def train(table: list[tuple[list[str], list[str]]], steps: int = 100, rate: float = 0.1, decay: float = 2e-4) -> Field:
    """Maximum conditional likelihood by Adam over the whole table; every sentence ends in O."""
    label = {x: k for k, x in enumerate(LABELS)}
    index: dict[str, int] = {}
    size, count = max(len(w) for w, _ in table), len(table)
    x = [[] for _ in range(3)]  # sentence, word, feature
    y, there = np.zeros((count, size), np.int64), np.zeros((count, size), bool)
    for s, (words, labels) in enumerate(table):
        y[s, : len(words)] = [label[z] for z in labels]
        there[s, : len(words)] = True
        for t in range(len(words)):
            for where, f in PARTS:
                k = t + {"": 0, "<": -1, ">": 1}[where]
                for z in f(look(words[k])) if 0 <= k < len(words) else ():
                    for col, v in zip(x, (s, t, index.setdefault(where + z, len(index)))):
                        col.append(v)
    s_at, t_at, f_at = (np.array(c) for c in x)
    n, flat = len(LABELS), s_at * size + t_at
    # I-kind only follows B-kind or I-kind.
    legal = np.array([[b[0] != "I" or a[2:] == b[2:] and a != "O" for b in LABELS] for a in LABELS])
    own, moves = np.zeros((len(index), n)), np.zeros((n, n))
    true = np.zeros((count, size, n))
    true[np.nonzero(there)[0], np.nonzero(there)[1], y[there]] = 1
    before = np.concatenate([np.zeros((count, 1), np.int64), y[:, :-1]], axis=1)  # sentences begin after O
    true_moves = np.zeros((n, n))
    np.add.at(true_moves, (before[there], y[there]), 1)
    state = [np.zeros_like(v) for v in (own, own, moves, moves)]
    for step in range(1, steps + 1):
        e = np.stack([np.bincount(flat, own[f_at, k], count * size) for k in range(n)], axis=1).reshape(count, size, n)
        m = np.where(legal, moves, _ILLEGAL)
        ahead, back = np.zeros((size, count, n)), np.zeros((size, count, n))
        ahead[0] = m[0] + e[:, 0]
        for t in range(1, size):
            new = log_sum(ahead[t - 1][:, :, None] + m, 1) + e[:, t]
            ahead[t] = np.where(there[:, t, None], new, ahead[t - 1])
        for t in range(size - 2, -1, -1):
            new = log_sum(m + (e[:, t + 1] + back[t + 1])[:, None, :], 2)
            back[t] = np.where(there[:, t + 1, None], new, back[t + 1])
        total = log_sum(ahead[-1], 1)
        p = np.exp(ahead + back - total[None, :, None]).transpose(1, 0, 2) * there[..., None]
        got = np.zeros((n, n))
        got[0] += p[:, 0].sum(axis=0)
        for t in range(1, size):
            pair = ahead[t - 1][:, :, None] + m + (e[:, t] + back[t])[:, None, :] - total[:, None, None]
            got += (np.exp(pair) * there[:, t, None, None]).sum(axis=0)
        d = ((p - true) / count)[s_at, t_at]
        g_own = np.stack([np.bincount(f_at, d[:, k], len(index)) for k in range(n)], axis=1) + decay * own
        g_moves = ((got - true_moves) / count + decay * moves) * legal
        for v, g, k in ((own, g_own, 0), (moves, g_moves, 2)):
            state[k] += 0.1 * (g - state[k])
            state[k + 1] += 0.01 * (g * g - state[k + 1])
            v -= rate * (state[k] / (1 - 0.9**step)) / (np.sqrt(state[k + 1] / (1 - 0.99**step)) + 1e-8)
    return Field(index, own, np.where(legal, moves, _ILLEGAL))


def best_end(gains: np.ndarray) -> np.ndarray:
    """For each place the best sum of a stretch that ends there."""
    sums = np.cumsum(gains)
    return sums - np.minimum.accumulate(np.r_[0, sums[:-1]])


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def viterbi(e: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best labels of runs (run, word, label) that stand between words labelled O."""
    runs, size, n = e.shape
    best, back = moves[0] + e[:, 0], np.zeros((size, runs, n), np.int64)
    for t in range(1, size):
        total = best[:, :, None] + moves
        back[t] = total.argmax(axis=1)
        best = total.max(axis=1) + e[:, t]
    out = np.zeros((runs, size), np.int64)
    out[:, -1] = (best + moves[:, 0]).argmax(axis=1)
    for t in range(size - 1, 0, -1):
        out[:, t - 1] = back[t, np.arange(runs), out[:, t]]
    return out


_MAIL = re.compile(r"\w+\s*(?:@|[(\[{]at[)\]}]|\bat\b)\s*\w+\s*(?:\.|\bdot\b)\s*\w+")


def enough(kind: int, text: str) -> bool:
    """What a span of the kind must at least hold."""
    digits = sum(c.isdigit() for c in text)
    return (_MAIL.search(text.lower()) is not None, 4 <= digits <= 20, 12 <= digits <= 19, 7 <= digits <= 15)[kind]


def field_spans(field_: Field, texts: list[str]) -> list[list[Span]]:
    """Spans that the field finds in each text."""
    runs, places = {}, []
    out: list[list[Span]] = [[] for _ in texts]
    for k, text in enumerate(texts):
        words = text.split()
        places.append(None)
        if not words:
            continue
        e = field_.emissions(words)
        hot = field_.open_words(e)
        if not hot.any():
            continue
        edge = np.diff(np.r_[0, hot.astype(np.int8), 0])
        for a, b in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist()):
            runs.setdefault(b - a, []).append((k, a, e[a:b]))
    for size, some in runs.items():
        for at in range(0, len(some), max(1, (1 << 16) // size)):
            part = some[at : at + max(1, (1 << 16) // size)]
            for (k, a, _), labels in zip(part, viterbi(np.stack([p[2] for p in part]), field_.moves)):
                if not labels.any():
                    continue
                if places[k] is None:
                    places[k] = [m.span() for m in re.finditer(r"\S+", texts[k])]
                begun = None
                for t, z in enumerate([*labels.tolist(), 0]):
                    # A span ends before O, a beginning or another kind.
                    if begun is not None and (z == 0 or z % 2 == 1 or (z - 1) // 2 != (labels[begun] - 1) // 2):
                        add(out[k], texts[k], places[k][a + begun][0], (labels[begun] - 1) // 2, places[k][a + t - 1][1])
                        begun = None
                    if z and begun is None:
                        begun = t
    return out


def add(spans: list[Span], text: str, start: int, kind: int, end: int) -> None:
    while start < end and text[start] in ",;:.!?\"'<>{}":
        start += 1
    while end > start and text[end - 1] in ",;:.!?\"'<>{}":
        end -= 1
    if enough(int(kind), text[start:end]):
        spans.append((start, int(kind), end))


def united(base: list[Span], more: list[Span]) -> list[Span]:
    """All base spans, and those others that overlap none of them nor each other."""
    out, reach = list(base), sorted((s, e) for s, _, e in base)
    starts, ends = [s for s, _ in reach], np.maximum.accumulate([e for _, e in reach]).tolist() if reach else []
    from bisect import bisect_left

    free = -1
    for s, k, e in sorted(more):
        i = bisect_left(starts, e)
        if s >= free and (i == 0 or ends[i - 1] <= s):
            out.append((s, k, e))
            free = e
    return sorted(out)


def find(docs: DataFrame, field_: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``base`` and ``spans``, arrays of (start, end, kind) in code points, sorted by start, then kind.

    ``base`` holds what the rules find, ``spans`` those and what the field adds. A null text counts as empty and holds nothing.
    Rows are read whole and one by one, repeated ones too; other columns are left out; an empty table gives an empty one.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(field_)  # of the size of the labelled table
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            spans = [united(x, y) for x, y in zip(base, field_spans(shared.value, texts))]
            cols = [pa.array([[{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in x] for x in c], kind) for c in (base, spans)]
            yield pa.RecordBatch.from_arrays([b.column("id"), *cols], ["id", "base", "spans"])

    spans = "array<struct<start: int, end: int, kind: string>>"
    return arrow_map(own, run, f"id {own.schema['id'].dataType.simpleString()}, base {spans}, spans {spans}").withColumnRenamed("id", id_col)
