"""Personal data by a linear-chain conditional random field over word shapes.

Method.  Base patterns find plain cases.  A CRF over the words of a line adds
spans that the patterns miss: obfuscated addresses, spaced ips, cards with other
separators, phone numbers without a country code.  Its features are the shapes of
a word and of its neighbours.  It is trained on a small labelled table
(``pii_lines``: lines labelled by hand, their digits redrawn) and on lines of a
bounded sample of the documents, labelled by the base patterns, by
forward-backward gradients, and decoded by Viterbi, both in numpy over batches of
lines.  A line on which leaving the outside label can't pay at any word, by a
bound on the whole path, needs no decoding and is outside throughout.

An added span stays if it reads as its kind: written plainly an email or ip
matches its base pattern, a card has 14 to 19 digits that pass Luhn (neighbouring
numbers are cut apart), a phone has 7 to 15 digits and nothing but digits and
separators.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import _powers, mix, pick, ranges, slices
from .pii_lines import LINES

KINDS = ("email", "ip", "card", "phone")
# Fixed base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Ways in which the signs of an address or ip are written out.
AT = re.compile(r"\s*[(\[{<]\s*(?:at|@)\s*[)\]}>]\s*|\s+at\s+|\s*@\s*", re.I)
DOT = re.compile(r"\s*[(\[{<]\s*(?:dot|\.)\s*[)\]}>]\s*|\s+dot\s+|\s*\.\s*", re.I)
PHONE_SIGNS = re.compile(r"[+(]?[0-9][0-9\x20()./-]*[0-9]")
DATE = re.compile(r"[0-9]{4}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./][0-9]{4}")

LABELS = 1 + len(KINDS)   # 0 is outside
SHAPES = 1 << 12          # hashed shapes
SIZES = 36                # digit count classes times length classes
SAMPLE_ROWS = 3000        # bound (in expectation) on the sampled documents
SAMPLE_CHARS = 5000       # only shorter texts are sampled for training
LINE_WORDS = 80           # longer lines are left out of the training sample
PART_WORDS = 20           # of an added span at most
TIMES = 8                 # each line of the labelled table, with other digits
STEPS, RATE = 80, 0.2


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, sorted."""
    out = []
    if "@" in text:
        out += [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    if "." in text:
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _classes() -> np.ndarray:
    """Class of each character below 256; others count as letters (1)."""
    out = np.full(256, 1, np.uint8)
    out[:128] = 9
    out[97:123], out[65:91], out[48:58] = 1, 2, 3
    for k, group in enumerate(("@", ".", "+", "()", "-", ":")):
        for c in group:
            out[ord(c)] = 10 + k
    out[[0x20, *range(0x09, 0x0E)]] = 0
    return out


class Words:
    """Words of a list of texts as arrays: text, line, first and end character, features."""

    def __init__(self, texts: list[str]):
        data = "\n".join(texts) + "\n"  # texts end in a line end, which belongs to none of them
        chars = np.frombuffer(data.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(t) + 1 for t in texts], np.int64)
        self.base = np.cumsum(size) - size
        kind = np.where(chars < 256, _classes()[np.minimum(chars, 255)], 1).astype(np.uint8)
        inside = kind > 0
        edge = np.diff(inside.astype(np.int8), prepend=0)
        self.first = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.text = np.searchsorted(self.base, self.first, side="right") - 1
        self.line = np.cumsum(chars == 10)[self.first] if len(self.first) else np.zeros(0, np.int64)
        n, count = len(chars), len(self.first)
        # collapsed shape: the classes of the runs in a word, hashed by prefix sums
        new = inside.copy()
        new[1:] &= kind[1:] != kind[:-1]
        run = np.cumsum(new)
        values = mix(np.arange(32, dtype=np.uint64) + np.uint64(99))
        with np.errstate(over="ignore"):
            at = np.flatnonzero(new)
            runs = np.concatenate([[np.uint64(0)], np.cumsum(values[kind[at]] * _powers(len(at), 0x9E3779B97F4A7C15))]) \
                if len(at) else np.zeros(1, np.uint64)
            if count:
                a, b = run[self.first] - 1, run[self.end - 1]
                back = _powers(len(at), pow(0x9E3779B97F4A7C15, -1, 1 << 64))[a]
                shape = mix((runs[b] - runs[a]) * back)
            else:
                shape = np.zeros(0, np.uint64)
        self.shape = (shape % np.uint64(SHAPES)).astype(np.int64)
        digits = np.concatenate([[0], np.cumsum(kind == 3)])
        d = digits[self.end] - digits[self.first]
        length = self.end - self.first
        self.size = np.digitize(d, (1, 2, 4, 8, 13)) * 6 + np.digitize(length, (2, 4, 8, 13, 20))
        new_line = np.ones(count, bool)
        new_line[1:] = self.line[1:] != self.line[:-1]
        self.line_at = np.append(np.flatnonzero(new_line), count)
        before, after = np.full(count, SHAPES), np.full(count, SHAPES)
        before[1:] = np.where(new_line[1:], SHAPES, self.shape[:-1])
        after[:-1] = np.where(new_line[1:], SHAPES, self.shape[1:])
        self.features = np.stack([self.shape, SHAPES + self.size, SHAPES + SIZES + before,
                                  2 * SHAPES + SIZES + 1 + after], axis=1)


FEATURES = 3 * SHAPES + SIZES + 2


class Crf:
    def __init__(self):
        self.weights = np.zeros((FEATURES, LABELS))
        self.weights[:, 0] = 0.05
        self.moves = np.zeros((LABELS, LABELS))  # from, to

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = self.weights[features[:, 0]]
        for k in range(1, features.shape[1]):
            out = out + self.weights[features[:, k]]
        return out

    def outside(self, emissions: np.ndarray, line_at: np.ndarray) -> np.ndarray:
        """For each line: can no word gain by another label, whatever the path?"""
        gain = max(0.0, float((self.moves - self.moves[0, 0]).max()))
        margin = emissions[:, 1:].max(axis=1) - emissions[:, 0] + 2 * gain
        return np.maximum.reduceat(margin, line_at[:-1]) < 0 if len(margin) else np.zeros(0, bool)

    def viterbi(self, emissions: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Best labels of the given lines (other words stay 0); all lines advance together."""
        out = np.zeros(len(emissions), np.int8)
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        if not len(first):
            return out
        score, back = emissions[first], []
        for t in range(1, int(length[0])):
            live = int(np.searchsorted(-length, -t, side="left"))
            total = score[:live, :, None] + self.moves
            back.append(total.argmax(axis=1).astype(np.int8))
            score[:live] = total.max(axis=1) + emissions[first[:live] + t]
        label = score.argmax(axis=1)
        for t in range(int(length[0]) - 1, -1, -1):
            live = int(np.searchsorted(-length, -t, side="left"))
            out[first[:live] + t] = label[:live]
            if t:
                label[:live] = back[t - 1][np.arange(live), label[:live]]
        return out

    def train(self, words: Words, labels: np.ndarray, steps: int = STEPS) -> None:
        """Adagrad on the mean log-likelihood; forward and backward passes over all lines together."""
        first, length = words.line_at[:-1], np.diff(words.line_at)
        if not len(first):
            return
        order = np.argsort(-length, kind="stable")
        first, length = first[order], length[order]
        longest, n = int(length[0]), len(words.features)
        live = [int(np.searchsorted(-length, -t, side="left")) for t in range(longest)]
        seen = [np.full((FEATURES, LABELS), 1e-2), np.full((LABELS, LABELS), 1e-2)]
        target = np.zeros((n, LABELS))
        target[np.arange(n), labels] = 1
        pairs = np.zeros((LABELS, LABELS))
        for t in range(1, longest):
            at = first[:live[t]] + t
            np.add.at(pairs, (labels[at - 1], labels[at]), 1)
        for _ in range(steps):
            e = self.emissions(words.features)
            grown, moves = np.exp(e - e.max(axis=1, keepdims=True)), np.exp(self.moves)
            ahead, behind = np.zeros((n, LABELS)), np.ones((n, LABELS))
            ahead[first] = grown[first] / grown[first].sum(axis=1, keepdims=True)
            for t in range(1, longest):
                at = first[:live[t]] + t
                x = (ahead[at - 1] @ moves) * grown[at]
                ahead[at] = x / x.sum(axis=1, keepdims=True)
            expected = np.zeros((LABELS, LABELS))
            for t in range(longest - 1, 0, -1):
                at = first[:live[t]] + t
                right = grown[at] * behind[at]
                x = right @ moves.T
                behind[at - 1] = x / x.sum(axis=1, keepdims=True)
                both = ahead[at - 1][:, :, None] * moves * right[:, None, :]
                expected += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            p = ahead * behind
            p /= p.sum(axis=1, keepdims=True)
            delta = target - p
            grad = np.zeros((FEATURES, LABELS))
            for k in range(words.features.shape[1]):
                for y in range(LABELS):
                    grad[:, y] += np.bincount(words.features[:, k], weights=delta[:, y], minlength=FEATURES)
            for value, g, s in ((self.weights, grad - 0.05 * self.weights, seen[0]), (self.moves, pairs - expected, seen[1])):
                s += g * g
                value += RATE * g / np.sqrt(s)


def labels_of(words: Words, spans: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """Label of each word from the spans that overlap it."""
    out = np.zeros(len(words.first), np.int64)
    for i, mine in enumerate(spans):
        for start, kind, end in mine:
            a = np.searchsorted(words.end, words.base[i] + start, side="right")
            b = np.searchsorted(words.first, words.base[i] + end, side="left")
            out[a:b] = kind + 1
    return out


def labelled_lines(texts: list[str]) -> tuple[list[str], list[list[tuple[int, int, int]]]]:
    """Lines with their base spans; each line with a phone number also comes with the
    country code left out and with other separators, labelled the same."""
    lines, spans = [], []
    for text in texts:
        for line in text.split("\n"):
            if not line.strip() or len(line.split()) > LINE_WORDS:
                continue
            found = base_spans(line)
            lines.append(line)
            spans.append(found)
            for start, kind, end in found:
                if kind != 3 or len(found) > 1:
                    continue
                number = line[start:end]
                for other in (re.sub(r"^\+[0-9]+[ .-]*", "", number), re.sub(r"[ ().-]+", "-", number.lstrip("+")).strip("-")):
                    lines.append(line[:start] + other + line[end:])
                    spans.append([(start, 3, start + len(other))])
    return lines, spans


_MARK = re.compile(r"\[(email|ip|card|phone) (.*?)\]\]")


def _redrawn(rng: random.Random, kind: int, text: str) -> str:
    """The text with other digits of the same number, and other letters in an email."""
    if kind == 0:
        return re.sub(r"[a-z0-9]+", lambda m: m[0] if m[0] in ("at", "dot", "com", "org", "net") else
                      "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in m[0]), text)
    if kind == 1:
        return re.sub("[0-9]+", lambda m: str(rng.randrange(256)), text)
    out = [c if not "0" <= c <= "9" else c if i == 0 or kind == 3 and c == "0" else rng.choice("0123456789") for i, c in enumerate(text)]
    if kind == 2:  # the last digit makes it pass Luhn
        last = max(i for i, c in enumerate(out) if c.isdigit())
        out[last] = next(c for c in "0123456789" if luhn(_digits("".join(out[:last]) + c)))
    return "".join(out)


def table_lines(times: int = TIMES, seed: int = 20240611) -> tuple[list[str], list[list[tuple[int, int, int]]]]:
    """The hand-labelled lines with their spans, each line with its digits redrawn several times."""
    rng, lines, spans = random.Random(seed), [], []
    for marked in LINES:
        for turn in range(times):
            line, found, at = "", [], 0
            for m in _MARK.finditer(marked):
                line += marked[at:m.start()]
                kind = KINDS.index(m[1])
                text = m[2] if turn == 0 else _redrawn(rng, kind, m[2])
                found.append((len(line), kind, len(line) + len(text)))
                line, at = line + text, m.end()
            line += marked[at:]
            if turn and not found:  # a decoy
                line = re.sub("[0-9]", lambda _: rng.choice("0123456789"), line)
            lines.append(line)
            spans.append(found)
    return lines, spans


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Crf:
    """Train on the labelled table and a bounded, hash-chosen sample of the documents' lines."""
    short = docs.where(F.length("text").between(1, SAMPLE_CHARS) & F.col("text").rlike("[0-9]")).select("text")
    # equal texts share their hash; the share of rows bounds the sample before equal ones are joined
    n = short.agg(F.approx_count_distinct(F.xxhash64("text", F.lit(3)), 0.02)).first()[0]
    share = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 20)) / float(1 << 20)
    texts = sorted(r["text"] for r in short.where(share < min(1.0, rows / max(1, n))).distinct().collect())
    lines, spans = labelled_lines(texts)
    more, marked = table_lines()
    words, crf = Words(lines + more), Crf()
    crf.train(words, labels_of(words, spans + marked))
    return crf


def crf_spans(crf: Crf, words: Words, n: int) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind, end) per text; neighbouring words of one kind make one span."""
    out: list[list] = [[] for _ in range(n)]
    if not len(words.first):
        return out
    e = crf.emissions(words.features)
    busy = np.flatnonzero(~crf.outside(e, words.line_at))
    first, length = words.line_at[:-1][busy], np.diff(words.line_at)[busy]
    label = crf.viterbi(e, first, length)
    at = ranges(first, length)
    at = at[label[at] > 0]
    if not len(at):
        return out
    cut = np.ones(len(at), bool)
    cut[1:] = (np.diff(at) > 1) | (label[at[1:]] != label[at[:-1]]) | (words.line[at[1:]] != words.line[at[:-1]])
    begin = np.flatnonzero(cut)
    last = np.append(begin[1:], len(at)) - 1
    for a, b in zip(at[begin].tolist(), at[last].tolist()):
        i = int(words.text[a])
        out[i].append((int(words.first[a] - words.base[i]), int(label[a]) - 1, int(words.end[b] - words.base[i])))
    return out


_TRIM = " \t,;:!?\"'"


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def reads_as(kind: int, text: str) -> bool:
    """Whether an added span, without marks at its ends, may stand as its kind."""
    if kind == 0:
        return EMAIL.fullmatch(DOT.sub(".", AT.sub("@", text))) is not None
    if kind == 1:
        plain = DOT.sub(".", text)
        return IP.fullmatch(plain) is not None and all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in plain.split("."))
    if kind == 2:
        number = _digits(text)
        return 14 <= len(number) <= 19 and luhn(number) and not re.search("[A-Za-z@]", text)
    return 7 <= len(_digits(text)) <= 15 and PHONE_SIGNS.fullmatch(text) is not None and DATE.fullmatch(text) is None


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without marks and unmatched brackets at its ends."""
    while start < end and text[start] in _TRIM + ").":
        start += 1
    while end > start and text[end - 1] in _TRIM + "(.":
        end -= 1
    own = text[start:end]
    if own.endswith(")") and own.count("(") < own.count(")"):
        end -= 1
    if own.startswith("(") and own.count("(") > own.count(")"):
        start += 1
    return start, end


def _parts(text: str, start: int, kind: int, end: int) -> list[tuple[int, int]]:
    """The longest runs of the span's words, from the left, that read as its kind."""
    words = [(start + m.start(), start + m.end()) for m in re.finditer(r"\S+", text[start:end])]
    out, i = [], 0
    while i < len(words):
        for j in range(min(len(words), i + PART_WORDS), i, -1):
            s, e = _trimmed(text, words[i][0], words[j - 1][1])
            if s < e and reads_as(kind, text[s:e]):
                out.append((s, e))
                i = j - 1
                break
        i += 1
    return out


def _merge(text: str, base, added):
    """Base spans, and the parts of the added ones that read as their kind and overlap no base span."""
    more = [(s, kind, e) for start, kind, end in added for s, e in _parts(text, start, kind, end)
            if all(e <= x or s >= y for x, _, y in base)]
    return sorted([*base, *more])


def _find_pass(crf: Crf):
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = pc.fill_null(batch.column("text"), "").to_pylist()
                added = crf_spans(crf, Words(texts), len(texts))
                rows = []
                for text, more in zip(texts, added):
                    base = base_spans(text)
                    own = set(base)
                    rows.append([{"kind": KINDS[k], "start": s, "end": e, "base": (s, k, e) in own}
                                 for s, k, e in (_merge(text, base, more) if more else base)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, span)], ["doc_id", "found"])
    return run


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id and found, an array of (kind, start, end, base).

    Offsets are code points, ends exclusive, sorted by start and kind.  Spans
    with base = true are the patterns' own, the others were added by the CRF and
    overlap none of those.  Null texts hold nothing; null and repeated ids are
    passed on; extra columns are ignored; an empty table gives no rows.
    """
    mine = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return mine.mapInArrow(_find_pass(fit(mine)), "doc_id bigint, found array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")


def personal_data_digests(docs: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, digest of the base spans and all spans as text."""
    found = find_personal_data(docs)
    base = F.filter("found", lambda x: x["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    of_kind = lambda kind: F.filter(base, lambda x: x["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"),
                        (F.size("found") - F.size(base)).cast("bigint").alias("n_added"))
